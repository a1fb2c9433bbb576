"""Quality rules on words, lines and tokeniser fertility."""

from __future__ import annotations

import math
from collections.abc import Mapping
from functools import lru_cache

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm.common import WORD, documents, query, ranked, stage
from shelfwise.llm.parts import Pieces, chunks, ranges, starts, word_codes
from shelfwise.llm.tokens import encoder, release, vocabulary

#: Bands of accepted values by script: tokens a word (at most), characters a token (at least, at most),
#: share of byte-fallback tokens (at most), token entropy in bits (at least).
#: Scripts without spaces have no bound on tokens a word.
SCRIPT_BANDS: dict[str, tuple[float | None, float, float, float, float]] = {
    "latin": (3.6, 1.3, 9.0, 0.05, 3.5),
    "greek": (7.0, 0.7, 8.0, 0.10, 3.5),
    "cyrillic": (5.0, 0.9, 8.0, 0.10, 3.5),
    "hebrew": (7.0, 0.6, 8.0, 0.30, 3.5),
    "arabic": (7.0, 0.6, 8.0, 0.30, 3.5),
    "devanagari": (9.0, 0.4, 8.0, 0.40, 3.5),
    "han": (None, 0.3, 4.0, 0.70, 3.5),
    "kana": (None, 0.4, 4.0, 0.40, 3.5),
    "hangul": (None, 0.3, 4.0, 0.70, 3.5),
    "other": (None, 0.2, 9.0, 1.00, 3.0),
}
#: Closer bounds where the language is given and no bands are fitted: lowest and highest value by measure.
LANGUAGE_BANDS = {
    "en": {"tokens_per_word": (0.0, 3.3)}, "de": {"tokens_per_word": (0.0, 3.4)}, "fr": {"tokens_per_word": (0.0, 3.55)}, "es": {"tokens_per_word": (0.0, 3.7)},
}
#: Ranges of code points by script, ends included.
SCRIPT_RANGES = {
    "latin": ((0x41, 0x5A), (0x61, 0x7A), (0xC0, 0x24F)),
    "greek": ((0x370, 0x3FF),),
    "cyrillic": ((0x400, 0x52F),),
    "hebrew": ((0x590, 0x5FF),),
    "arabic": ((0x600, 0x6FF), (0x750, 0x77F)),
    "devanagari": ((0x900, 0x97F),),
    "kana": ((0x3040, 0x30FF),),
    "han": ((0x3400, 0x4DBF), (0x4E00, 0x9FFF)),
    "hangul": ((0x1100, 0x11FF), (0xAC00, 0xD7AF)),
}
#: Measures with bands, and of those the ones that have an upper bound when bands are fitted: entropy grows with a text's length.
MEASURES = ("tokens_per_word", "chars_per_token", "byte_share", "token_entropy")
#: The share of good rows that a fitted bound may lose, and the good rows of a language that it takes.
LOSS, LEAST = 0.001, 100
_SYMBOLS = r"[#*$%&|<>]"
RESULT = (
    "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, script string, "
    "tokens_per_word double, chars_per_token double, chars_per_byte_token double, byte_share double, token_entropy double, failed array<string>, kept boolean"
)


class Fertility:
    """Tokens of words by two public vocabularies: one with byte fallback, one of byte pairs; a batch's distinct words are encoded once."""

    def __init__(self, pieces: str, pairs: str):
        import numpy as np

        self.pieces, self.pairs = Pieces(pieces), encoder(pairs)
        self.fallback = np.array([self.pieces.model.is_byte(i) for i in range(len(self.pieces.bytes))])
        # The script of each code point: its place in SCRIPT_RANGES, or one past them.
        self.scripts = np.full(0x110000, len(SCRIPT_RANGES), "uint8")
        for k, ranges_ in enumerate(SCRIPT_RANGES.values()):
            for low, high in ranges_:
                self.scripts[low : high + 1] = k


@lru_cache(maxsize=1)
def fertility(pieces: str, pairs: str) -> Fertility:
    return Fertility(pieces, pairs)


def repeated_words(codes, offsets, size: int = 3):
    """For each text of a batch, words inside windows of ``size`` words that occur twice or more in the text."""
    import numpy as np

    n = len(codes)
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    if n < size:
        return np.zeros(len(offsets) - 1, "int64")
    windows = n - size + 1
    # Texts first, so that windows of different texts never meet; a window that leaves its text does not count.
    code, whole = owner[:windows], owner[:windows] == owner[size - 1 :]
    for k in range(size):
        code = np.unique(code * np.int64(codes.max() + 1) + codes[k : windows + k], return_inverse=True)[1]
    twice = (np.bincount(code[whole], minlength=int(code.max()) + 1)[code] > 1) & whole
    first = np.flatnonzero(twice)
    cover = np.zeros(n + 1, "int64")
    np.add.at(cover, first, 1)
    np.add.at(cover, first + size, -1)
    return np.diff(starts(np.cumsum(cover[:n]) > 0)[offsets])


def repeated_lines(texts):
    """For each text, lines with a word that are equal to an earlier line."""
    import numpy as np
    import pyarrow.compute as pc

    lists = pc.split_pattern(texts, "\n")
    worded = np.asarray(pc.match_substring_regex(lists.values, WORD)).astype(bool)
    line = np.asarray(lists.values.dictionary_encode().indices).astype("int64")[worded]
    owner = np.repeat(np.arange(len(texts)), np.diff(np.asarray(lists.offsets)))[worded]
    if not len(line):
        return np.zeros(len(texts), "int64")
    distinct = np.unique(owner * np.int64(line.max() + 1) + line) // np.int64(line.max() + 1)
    return np.bincount(owner, minlength=len(texts)) - np.bincount(distinct, minlength=len(texts))


def measures(texts, tool: Fertility) -> dict:
    """All figures of a batch of texts, an array each; null is empty."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    texts = pc.fill_null(texts.cast(pa.string()), "")
    codes, words, at = word_codes(texts)
    n = np.diff(at)
    total = lambda each: np.diff(starts(each[codes])[at])
    ids, id_at = tool.pieces.spaced(words)
    sizes = np.diff(id_at)
    length = np.asarray(pc.utf8_length(words)).astype("int64")
    tokens, chars, pairs = total(sizes), total(length), total(np.diff(tool.pairs.spaced(words)[1]))
    fallback = total(np.diff(starts(tool.fallback[ids])[id_at]))
    # Letters of each script in each distinct word.
    points = tool.scripts[np.frombuffer("".join(words.to_pylist()).encode("utf-32-le", "replace"), "<u4")]
    kinds = len(SCRIPT_RANGES) + 1
    letters = np.bincount(np.repeat(np.arange(len(words)), length) * kinds + points, minlength=len(words) * kinds).reshape(-1, kinds)
    letters = np.stack([total(letters[:, k]) for k in range(kinds - 1)], axis=1) if len(words) else np.zeros((len(n), kinds - 1), "int64")
    flat, flat_at = ids[ranges(id_at[codes], sizes[codes])].astype("uint16"), starts(tokens)
    entropy = np.zeros(len(n))
    for k in np.flatnonzero(tokens):
        some = np.sort(flat[flat_at[k] : flat_at[k + 1]], kind="stable")
        share = np.diff(np.concatenate([[0], np.flatnonzero(np.diff(some)) + 1, [len(some)]])) / len(some)
        entropy[k] = -(share * np.log2(share)).sum()
    again = repeated_words(codes, at)
    names = np.array([*SCRIPT_RANGES, "other"], object)
    return {
        "n_words": n, "word_chars": chars, "n_symbols": np.asarray(pc.count_substring_regex(texts, _SYMBOLS)).astype("int64"), "n_dup_lines": repeated_lines(texts),
        "n_repeat_words": again, "base_failed": (n < 50) | (100 * again > 50 * n), "script": names[np.where(letters.max(axis=1, initial=0) > 0, letters.argmax(axis=1), kinds - 1)],
        "tokens_per_word": tokens / np.maximum(n, 1), "chars_per_token": chars / np.maximum(tokens, 1), "chars_per_byte_token": chars / np.maximum(pairs, 1),
        "byte_share": fallback / np.maximum(tokens, 1), "token_entropy": entropy,
    }


def verdicts(found: dict, langs: list, bands: Mapping, languages: Mapping) -> tuple[list, list]:
    """Names of the rules that each text fails, and whether it fails none."""
    import numpy as np

    # A language's own bands hold for texts in its script.
    key = [(lang if lang in languages and languages[lang].get("script", "latin") == script else None, script) for lang, script in zip(langs, found["script"], strict=True)]
    limits = {k: {**bounds_of(bands[k[1]]), **languages.get(k[0], {})} for k in set(key)}
    failed = [[] if not bad else ["base"] for bad in found["base_failed"]]
    for name in MEASURES:
        low, high = (np.array([limits[k][name][side] for k in key]) for side in (0, 1))
        for i in np.flatnonzero((found[name] < low) | (found[name] > high)):
            failed[i].append(name)
    return failed, [not f for f in failed]


def bounds_of(band: tuple) -> dict[str, tuple[float, float]]:
    """A script's band as bounds by measure."""
    most, low, high, fallback, least = band
    inf = float("inf")
    return {"tokens_per_word": (0.0, inf if most is None else most), "chars_per_token": (low, high), "byte_share": (0.0, fallback), "token_entropy": (least, inf)}


def fit_bands(docs: DataFrame, labels: DataFrame, pieces: str, pairs: str, id_col: str = "doc_id", lang_col: str = "lang", text_col: str = "text", loss: float = LOSS, least: int = LEAST) -> dict:
    """Bands by language from all rows labelled good (``quality`` 1), as ``bands_of`` gives them; only those rows are measured."""
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).where("lang is not null")
    rows = quality_rules(rows.join(good_ids(labels, id_col), "_id", "left_semi"), pieces, pairs)
    return bands_of(stage(rows.select("_id", "lang", "_quality"), "fertility-good"), loss, least)


def good_ids(labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Ids of the rows labelled good, each once, as ``_id``."""
    return labels.where("quality = 1").select(F.col(id_col).alias("_id")).where("_id is not null").distinct()


def bands_of(good: DataFrame, loss: float = LOSS, least: int = LEAST) -> dict:
    """Bands by language from measured rows ``_id, lang, _quality``: for each measure, what all but a share ``loss`` of the rows keep to on either side.

    Every row that passes the base rules counts, and the bounds are exact percentiles: values are ranked within language and
    measure over range partitions, and at most the four rows beside a measure's two bounds come to the driver. A language
    with fewer than ``least`` such rows has no band of its own. The share of fallback bytes keeps its script's upper bound where that is
    wider, and entropy, which grows with a text's length, has a lower bound only. Each bound loses about ``loss`` of the good rows of
    its language, so all of them lose less than one in a hundred. ``good`` is read several times.
    """
    good = good.where("lang is not null and not _quality.base_failed")
    sizes = good.groupBy("lang").agg(F.count("*").alias("n"), F.max("_quality.script").alias("script")).where(F.col("n") >= least).collect()
    places = {r["lang"]: [share * (r["n"] - 1) for share in (loss, 1 - loss)] for r in sizes}
    wanted = {(lang, rank) for lang, both in places.items() for at in both for rank in (math.floor(at), math.ceil(at))}
    if not wanted:
        return {}
    measure = F.explode(F.array(*[F.struct(F.lit(m).alias("_m"), F.col(f"_quality.{m}").alias("_v")) for m in MEASURES]))
    values = good.select("lang", F.xxhash64("_id").alias("_tie"), measure.alias("_one")).select("lang", "_tie", "_one.*")
    # At most four ranks a language.
    wanted = F.broadcast(good.sparkSession.createDataFrame(sorted(wanted), "lang string, _rank bigint"))
    beside = ranked(values, ["_v", "_tie"], ["lang", "_m"], purpose="fertility-ranks").join(wanted, ["lang", "_rank"])
    beside = {(r["lang"], r["_m"], r["_rank"]): r["_v"] for r in beside.collect()}
    bands = {}
    for r in sizes:
        own = {m: tuple(between({rank: v for (lang, name, rank), v in beside.items() if (lang, name) == (r["lang"], m)}, at) for at in places[r["lang"]]) for m in MEASURES}
        own["byte_share"] = (0.0, max(own["byte_share"][1], SCRIPT_BANDS[r["script"]][3]))
        own["token_entropy"] = (own["token_entropy"][0], float("inf"))
        own["script"] = r["script"]
        bands[r["lang"]] = own
    return bands


def between(values: Mapping[int, float], at: float) -> float:
    """The value at a place between two ranks, by their distances."""
    low, high = math.floor(at), math.ceil(at)
    return values[low] if values[low] == values[high] else (high - at) * values[low] + (at - low) * values[high]


def quality_rules(
    docs: DataFrame,
    pieces: str,
    pairs: str,
    text_col: str = "text",
    lang_col: str | None = "lang",
    bands: Mapping = SCRIPT_BANDS,
    languages: Mapping = LANGUAGE_BANDS,
    out: str = "_quality",
) -> DataFrame:
    """``docs`` with a struct of quality figures and the verdict ``kept``.

    Fertility is measured word by word with two public vocabularies: tokens a word, characters a
    token, share of byte-fallback tokens and the entropy of the text's tokens; the second gives
    characters a token of byte pairs. A text is kept that passes the base rules (50 words, at most half
    of the words in repeated windows) and lies within the bands of its language (``languages``, as ``fit_bands`` gives them), or of its
    main script where its language has none. Bands judge a text by itself, and nothing is shuffled.

    Defined cases: null and empty texts have zeros and are not kept; a null or unknown language uses the
    script's band; very long texts are a batch of their own; texts without letters are script ``other``; repeated rows get equal verdicts; no
    rows give no rows; other columns pass through (``out`` must be free).
    """

    def judged(batches):
        import pandas as pd
        import pyarrow as pa

        tool = fertility(pieces, pairs)
        names = [part.split()[0] for part in RESULT.split(", ")]
        for texts, langs in batches:
            column, out = pa.array(texts, pa.string()), []
            for i, n in chunks(column, 4 << 20):
                found = measures(column.slice(i, n), tool)
                found["failed"], found["kept"] = verdicts(found, langs.iloc[i : i + n].tolist(), bands, languages)
                out.append(pd.DataFrame({name: found[name] for name in names}))
            yield pd.concat(out, ignore_index=True) if out else pd.DataFrame(columns=names)
        del tool
        fertility.cache_clear()
        release()

    from collections.abc import Iterator

    import pandas as pd

    judged.__annotations__ = {"batches": Iterator[tuple[pd.Series, pd.Series]], "return": Iterator[pd.DataFrame]}
    verdict = F.pandas_udf(judged, RESULT).asNondeterministic()
    lang = F.col(lang_col) if lang_col else F.lit(None)
    return docs.withColumn(out, verdict(F.col(text_col), lang.cast("string")))


def judged_again(rows: DataFrame, languages: Mapping, bands: Mapping = SCRIPT_BANDS, lang_col: str = "lang", out: str = "_quality") -> DataFrame:
    """``rows`` of ``quality_rules`` with the verdict by other bands; texts are not read. A column named ``out`` with ``_verdict`` must be free."""
    given = ("script", "base_failed", *MEASURES)

    def judged(batches):
        import pandas as pd

        for langs, *figures in batches:
            failed, kept = verdicts({name: f.to_numpy() for name, f in zip(given, figures, strict=True)}, langs.tolist(), bands, languages)
            yield pd.DataFrame({"failed": failed, "kept": kept})

    from collections.abc import Iterator

    import pandas as pd

    judged.__annotations__ = {"batches": Iterator[tuple[pd.Series, ...]], "return": Iterator[pd.DataFrame]}
    verdict = F.pandas_udf(judged, "failed array<string>, kept boolean").asNondeterministic()
    names, new = [part.split()[0] for part in RESULT.split(", ")], f"{out}_verdict"
    rows = rows.withColumn(new, verdict(F.col(lang_col).cast("string"), *[F.col(f"{out}.{name}") for name in given]))
    return rows.withColumn(out, F.struct(*[F.col(f"{new if name in ('failed', 'kept') else out}.{name}").alias(name) for name in names])).drop(new)


def production(docs: DataFrame, labels: DataFrame | None = None, texts: bool = True) -> DataFrame:
    """The rules with the installed public vocabularies, and with bands fitted on ``labels`` where there are any; without the texts if not ``texts``.

    Each text is measured once: rows are staged with their figures, bands are fitted on the good ones among them, and the verdicts follow from the figures.
    """
    tools = vocabulary("piece_bpe_32k.model"), vocabulary("byte_bpe_50k.json")
    found = quality_rules(docs, *tools)
    found = found if texts else found.drop("text")
    if labels is None:
        return found
    found = stage(found, "fertility")
    good = found.select(F.col("doc_id").alias("_id"), "lang", "_quality").join(good_ids(labels), "_id", "left_semi")
    return judged_again(found, {**LANGUAGE_BANDS, **bands_of(good)})


def labels_of(spark: SparkSession, folder: str) -> DataFrame | None:
    """The folder's labels, or None where it has none."""
    try:
        return spark.read.parquet(f"{folder}/labels.parquet")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


@query("op6_fertility")
def op6_fertility(spark: SparkSession, folder: str) -> DataFrame:
    """Figures and verdicts of all documents."""
    q = production(documents(spark, folder).select("doc_id", "text", "lang"), labels_of(spark, folder), texts=False)
    names = [part.split()[0] for part in RESULT.split(", ")]
    return q.select("doc_id", *[F.col(f"_quality.{n}").alias(n) for n in names])

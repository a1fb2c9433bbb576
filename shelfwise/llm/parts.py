"""A batch of texts cut at spaces, so that each distinct part is encoded once.

Byte-level and sentence-piece vocabularies begin a token at a space that follows a character other than white
space and begins a word. Texts are cut before such spaces, the parts of a batch are dictionary-encoded, and
whatever is found out about a part is gathered back to texts with numpy.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

#: Bytes of text that are looked at together; a longer text is a batch of its own.
CHUNK_BYTES = 8 << 20
#: Parts encoded in one call, and the most characters of a part that shares a call.
JOINED, SHORT = 2000, 2000
#: Bytes of parts and ids that a worker keeps for each vocabulary.
KNOWN_BYTES = 24 << 20
#: White space of Unicode and what Python counts as such, as a class of RE2.
_BLANK = r"[\s\x0b\x1c-\x1f\x85\p{Z}]"
#: Texts in which a space stands first, last or beside other white space.
_ODD_TEXT = rf"^ | $| {_BLANK}|{_BLANK} "
#: Parts that are encoded by themselves: with a space, at white space, or with the sign that stands for a space.
_ODD_PART = rf" |^{_BLANK}|\x{{2581}}"
_CUT = re.compile(r"(?<=\S) (?=\S)")


def chunks(texts, most: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """(first row, number of rows) of runs of an array of strings with about ``most`` bytes each."""
    import numpy as np
    import pyarrow.compute as pc

    if not len(texts):
        return
    ends = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(texts), 0)).astype("int64"))
    at = 0
    while at < len(texts):
        before = int(ends[at - 1]) if at else 0
        to = max(int(np.searchsorted(ends, before + most, side="right")), at + 1)
        yield at, to - at
        at = to


@dataclass
class Parts:
    """``codes[offsets[i]:offsets[i + 1]]`` are text i's parts, as places in ``distinct``."""

    offsets: object
    codes: object
    distinct: object


def split(texts) -> Parts:
    """Parts of an array of strings; null and empty texts have none. A part is what follows a space, or a text's start."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    texts = pc.fill_null(texts.cast(pa.string()), "")
    odd = np.asarray(pc.match_substring_regex(texts, _ODD_TEXT)).astype(bool)
    plain = pc.if_else(pa.array(odd), "", texts) if odd.any() else texts
    lists = pc.split_pattern(plain, " ")
    sizes, values = np.diff(np.asarray(lists.offsets)), lists.values
    none = np.asarray(pc.equal(plain, "")).astype(bool)
    if none.any():
        values = values.filter(pa.array(~np.repeat(none, sizes)))
        sizes = np.where(none, 0, sizes)
    of = np.repeat(np.arange(len(texts)), sizes)
    if odd.any():
        rows = np.flatnonzero(odd)
        cut = [_CUT.split(t) for t in texts.filter(pa.array(odd)).to_pylist()]
        values = pa.concat_arrays([values, pa.array([p for c in cut for p in c], pa.string())])
        of = np.concatenate([of, np.repeat(rows, [len(c) for c in cut])])
    found = values.dictionary_encode()
    codes = np.asarray(found.indices).astype("int64")
    if odd.any():
        order = np.argsort(of, kind="stable")
        codes, of = codes[order], of[order]
    return Parts(np.searchsorted(of, np.arange(len(texts) + 1)), codes, found.dictionary)


def starts(sizes):
    """Running total of sizes from 0, one longer than they are."""
    import numpy as np

    return np.concatenate([[0], np.cumsum(sizes)]).astype("int64")


def ranges(first, sizes):
    """``first[i], first[i] + 1, ...`` (``sizes[i]`` of them) for each i, one after another."""
    import numpy as np

    at = starts(sizes)
    return np.arange(at[-1]) + np.repeat(first - at[:-1], sizes)


def encode_parts(words, together: Callable, alone: Callable, lead) -> tuple:
    """Ids of parts that follow a space each, flat, and their offsets.

    ``together(list of texts)`` gives arrays of ids of texts made of parts joined by spaces, ``alone(part)`` the ids of one
    part after a space; ``lead[id]`` says which ids begin at a space, so that a joined text's ids can be dealt to its parts.
    """
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    odd = np.asarray(pc.match_substring_regex(words, _ODD_PART)).astype(bool) | (np.asarray(pc.binary_length(words)) > SHORT)
    plain = words.filter(pa.array(~odd)).to_pylist()
    groups = [plain[i : i + JOINED] for i in range(0, len(plain), JOINED)]
    ids, sizes = [], []
    for group, some in zip(groups, together([" ".join(g) for g in groups]), strict=True):
        begin = np.flatnonzero(lead[some])
        if len(begin) != len(group) or begin[0]:
            each = [alone(p) for p in group]
            some, begin = np.concatenate(each), starts([len(x) for x in each])[:-1]
        ids.append(some)
        sizes.append(np.diff(np.append(begin, len(some))))
    rest = [alone(p) for p in words.filter(pa.array(odd)).to_pylist()]
    flat = np.concatenate([*ids, *rest, np.zeros(0, "int64")]).astype("uint32")
    counts = np.concatenate([*sizes, np.array([len(x) for x in rest], "int64"), np.zeros(0, "int64")]).astype("int64")
    if not odd.any():
        return flat, starts(counts)
    place = np.concatenate([np.flatnonzero(~odd), np.flatnonzero(odd)])
    back, at = np.argsort(place, kind="stable"), starts(counts)
    return flat[ranges(at[back], counts[back])], starts(counts[back])


class Known:
    """Parts of earlier batches, their ids, and where each part's begin: three flat arrays of ``KNOWN_BYTES`` at most."""

    def __init__(self):
        self.table = None

    def of(self, words, encode: Callable) -> tuple:
        """Ids of distinct parts, flat, and their offsets: looked up, and by ``encode`` where a part is new."""
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        known, known_ids, known_at = self.table or (words.slice(0, 0), np.zeros(0, "uint32"), np.zeros(1, "int64"))
        place = np.asarray(pc.fill_null(pc.index_in(words, value_set=known), -1)).astype("int64")
        new = place < 0
        place[new] = len(known) + np.arange(int(new.sum()))
        some = words.filter(pa.array(new))
        ids, at = encode(some)
        ids, at = np.concatenate([known_ids, ids]), np.concatenate([known_at, known_at[-1] + at[1:]])
        sizes = np.diff(at)[place]
        out = ids[ranges(at[place], sizes)], starts(sizes)
        # Beyond the bound only the parts of this batch are kept, beyond it by themselves none.
        for table in ((pa.concat_arrays([known, some]), ids, at), (pa.concat_arrays([words]), *out), None):
            if table is None or sum(x.nbytes for x in table) <= KNOWN_BYTES:
                self.table = table
                break
        return out


class Pieces:
    """Ids and bytes of parts by a sentence-piece vocabulary, which puts a space before a text."""

    def __init__(self, path: str):
        import numpy as np
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        one = [bytes([int(n[3:-1], 16)]) if self.model.is_byte(i) else n.replace("▁", " ").encode() for i, n in enumerate(names)]
        self.bytes = np.array(one, object)
        self.lead = np.array([n.startswith("▁") for n in names])
        self.known = Known()

    def _ids(self, texts: list[str]) -> list:
        from numpy import array

        return [array(ids, "int64") for ids in self.model.encode(texts, num_threads=1)]

    def spaced(self, words) -> tuple:
        """Ids of distinct parts after a space, flat, and their offsets."""
        return self.known.of(words, lambda some: encode_parts(some, self._ids, lambda p: self._ids([p])[0], self.lead))


def word_codes(texts) -> tuple:
    """Words of an array of strings: numbers, distinct words, and where each text's begin; words are cut at the six ASCII blanks."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    clean = pc.replace_substring_regex(pc.fill_null(texts.cast(pa.string()), ""), r"[\x09-\x0d\x20]+", " ")
    lists = pc.split_pattern(clean, " ")
    words = np.asarray(pc.not_equal(lists.values, "")).astype(bool)
    found = lists.values.filter(pa.array(words)).dictionary_encode()
    return np.asarray(found.indices).astype("int64"), found.dictionary, starts(words)[np.asarray(lists.offsets).astype("int64")]

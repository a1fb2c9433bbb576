"""WARC archives: writing records of pages, and assembling transactions read from archives."""

from __future__ import annotations

import base64
import hashlib
import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm.common import query, stage
from shelfwise.operators.skew import join_one
from shelfwise.session import shared_dir

VERSION = b"WARC/1.1"
#: Profile of a revisit with the same payload as an earlier response (a fixed value of the format).
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Bytes of payload of an archive, about.
ARCHIVE_BYTES = 256 << 20
#: Each capture's bytes end in the last byte of a gzip member, the high byte of its length: zero for
#: records below 16 MiB, as metadata records are. The text writer's line separator supplies it.
_LAST = "\x00"
RECORD = (
    "type string, record_id string, concurrent_to string, refers_to string, target_uri string, warc_date string, "
    "payload_digest string, payload_bytes bigint, fields map<string,string>, payload binary"
)


def record_id(key: str, kind: str) -> str:
    """A URN that follows from the capture's key and the record's kind: retried tasks write the same."""
    h = hashlib.sha1(f"{key}/{kind}".encode()).hexdigest()
    return f"<urn:uuid:{h[:8]}-{h[8:12]}-5{h[13:16]}-a{h[17:20]}-{h[20:32]}>"


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def member(kind: str, ident: str, headers: list[tuple[str, str]], block: bytes) -> bytes:
    """One record as a gzip member of its own."""
    head = [("WARC-Type", kind), ("WARC-Record-ID", ident), *headers, ("Content-Length", str(len(block)))]
    lines = b"".join(f"{k}: {v}\r\n".encode() for k, v in head)
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    return pack.compress(VERSION + b"\r\n" + lines + b"\r\n" + block + b"\r\n\r\n") + pack.flush()


def capture_members(key: str, uri: str, payload: bytes | None, size: int, digest: str, first_key: str, fields: dict[str, str], date: str) -> bytes:
    """Request, response or revisit (payload None), and metadata of one capture; the latter two name the response by WARC-Concurrent-To."""
    own = record_id(key, "response")
    about = [("WARC-Target-URI", uri), ("WARC-Date", date)]
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    path = "/" + uri.split("/", 3)[3] if uri.count("/") >= 3 else "/"
    ask = f"GET {path} HTTP/1.1\r\nHost: {uri.split('/')[2] if uri.count('/') >= 2 else ''}\r\n\r\n".encode()
    together = [("WARC-Concurrent-To", own)]
    out = [member("request", record_id(key, "request"), [*about, *together, ("Content-Type", "application/http;msgtype=request")], ask)]
    sums = [("WARC-Payload-Digest", f"sha1:{digest}"), ("Content-Type", "application/http;msgtype=response")]
    if payload is None:
        seen = [("WARC-Profile", SAME_PAYLOAD), ("WARC-Refers-To", record_id(first_key, "response"))]
        out.append(member("revisit", own, [*about, *seen, *sums], http))
    else:
        out.append(member("response", own, [*about, *sums], http + payload))
    note = "".join(f"{k}: {v}\r\n" for k, v in fields.items()).encode()
    out.append(member("metadata", record_id(key, "metadata"), [*about, *together, ("Content-Type", "application/warc-fields")], note))
    return b"".join(out)


def _line(text: str | None) -> str:
    """Header text on one line."""
    return " ".join((text or "").split())


def write_warc(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", least: int = 0, date: str = "2025-01-01T00:00:00Z") -> None:
    """Write a capture (request, response or revisit, metadata) for each row to gzipped archives below ``path``.

    Of rows with equal payloads of at least ``least`` bytes the one with the smallest id is a response, the others
    are revisits of it without payload; smaller ones are all responses. Digests and the first row of
    each are found on narrow rows, summed before the shuffle; the payload is shuffled once, by a key of its
    row, so that no group of equal payloads meets. Files are written by Spark's writer (its
    commit protocol; any file system), of about ``ARCHIVE_BYTES`` of payload at most.

    Defined cases: null payloads are empty; null ids come last; rows that repeat id, URL and payload are
    captures of their own, the first of them the response; a null URL is written empty.
    """
    payload = F.coalesce(F.col(payload_col).cast("string"), F.lit(""))
    rows = pages.select(F.col(id_col).alias("_id"), F.col(url_col).cast("string").alias("_url"), payload.alias("_payload"))
    key = F.sha1(F.concat(F.to_json(F.struct("_id", "_url"), {"ignoreNullFields": "false"}), F.sha1("_payload")))
    rows = rows.withColumns({"_digest": F.sha1("_payload"), "_size": F.octet_length("_payload").cast("long")}).withColumn("_key", key)
    narrow = stage(rows.groupBy("_key", "_digest", "_size", "_id").agg(F.count("*").alias("_n")), "warc-keys")
    order = F.struct(F.col("_id").isNull().alias("last"), F.col("_id").alias("id"), F.col("_key").alias("key"))
    first = stage(narrow.where(F.col("_size") >= least).groupBy("_digest").agg(F.min(order).alias("_first")), "warc-first")
    plan = join_one(narrow, first, ["_digest"]).select("_key", F.coalesce("_first.key", "_key").alias("_first"), (F.col("_size") >= least).alias("_joined"))
    plan = stage(plan, "warc-plan")
    # Rows of one key have to meet, however the plan is joined: they are numbered below.
    rows = rows.repartition("_key").join(plan, "_key").sortWithinPartitions("_key")
    # Files of about ARCHIVE_BYTES of payload, so that a reader never holds more of one.
    sums = narrow.agg(F.sum(F.col("_size") * F.col("_n")).alias("bytes"), F.sum("_n").alias("rows")).first()
    each = max(1, ARCHIVE_BYTES * (sums["rows"] or 1) // ((sums["bytes"] or 0) + 1000 * (sums["rows"] or 1)))

    def write(batches):
        import pandas as pd

        last, nth = None, 0
        for batch in batches:
            out = []
            for r in batch.itertuples(index=False):
                nth = nth + 1 if r.key == last else 0
                last = r.key
                body = r.payload.encode("utf-8", "replace")
                digest = digest_of(body)
                revisit = r.joined and (r.key != r.first or nth > 0)
                fields = {"page-id": r.id, "payload-bytes": str(len(body))}
                fields = {k: v for k, v in fields.items() if v is not None}
                unit = f"{r.key}.{nth}"
                data = capture_members(unit, _line(r.url), None if revisit else body, len(body), digest, f"{r.first}.0", fields, date)
                out.append(data[:-1])
            yield pd.DataFrame({"value": out})

    text = rows.select(
        F.col("_key").alias("key"), F.col("_id").cast("string").alias("id"), F.col("_url").alias("url"), F.col("_payload").alias("payload"),
        F.col("_first").alias("first"), F.col("_joined").alias("joined"),
    ).mapInPandas(write, "value binary")
    # A string column holds any bytes; the cast changes none of them.
    text.select(F.col("value").cast("string")).write.option("lineSep", _LAST).option("maxRecordsPerFile", each).text(path)


def parse_members(data: bytes):
    """(type, headers, block) of each record of a gzipped archive, one member at a time."""
    at = 0
    view = memoryview(data)
    while at < len(data):
        pack, blocks = zlib.decompressobj(31), []
        while not pack.eof and at < len(data):
            some = view[at : at + 32768]
            blocks.append(pack.decompress(some))
            at += len(some)
        at -= len(pack.unused_data)
        raw, inside = b"".join(blocks), 0
        while inside < len(raw):
            end = raw.index(b"\r\n\r\n", inside)
            lines = raw[inside:end].decode("utf-8", "replace").split("\r\n")[1:]
            headers = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
            size = int(headers["content-length"])
            yield headers, raw[end + 4 : end + 4 + size]
            inside = end + 4 + size + 4


def _row(headers: dict[str, str], block: bytes, keep_payload: bool) -> tuple:
    kind, fields, payload = headers.get("warc-type"), {}, None
    digest, size = (headers.get("warc-payload-digest") or "").removeprefix("sha1:") or None, None
    if kind in ("response", "revisit"):
        head, _, payload = block.partition(b"\r\n\r\n")
        fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in head.decode("utf-8", "replace").split("\r\n")[1:])}
        if kind == "response":
            size, digest = len(payload), digest_of(payload)
        else:
            size, payload = int(fields["content-length"]) if fields.get("content-length", "").isdigit() else None, None
    elif kind == "metadata":
        fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in block.decode("utf-8", "replace").split("\r\n") if x)}
    elif kind == "request":
        fields = {"request-line": block.partition(b"\r\n")[0].decode("utf-8", "replace")}
    return (
        kind, headers.get("warc-record-id"), headers.get("warc-concurrent-to"), headers.get("warc-refers-to"), headers.get("warc-target-uri"),
        headers.get("warc-date"), digest, size, fields, payload if keep_payload else None,
    )


def read_records(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """Records of the archives below ``path``; digests and sizes of responses are those of the payload read."""

    def parse(batches):
        import pandas as pd

        names = [part.split()[0] for part in RECORD.replace("map<string,string>", "map").split(", ")]
        for batch in batches:
            for data in batch["content"]:
                rows = []
                held = 0
                for headers, block in parse_members(data):
                    rows.append(_row(headers, block, payload))
                    held += len(block) if payload else 0
                    if len(rows) >= 2000 or held > 16 << 20:
                        yield pd.DataFrame(rows, columns=names)
                        rows, held = [], 0
                if rows:
                    yield pd.DataFrame(rows, columns=names)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).where("length > 0")
    return files.select("content").mapInPandas(parse, RECORD)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: ``capture_id, target_uri, response, request, metadata``.

    Request and metadata records name their response (or revisit) by WARC-Concurrent-To; the three meet in
    one aggregation by the response's record id. Of several requests or metadata records
    of a capture the one with the smallest record id counts; records that name no
    response that was read are left out, captures without request or metadata have nulls there.
    """
    capture = F.when(F.col("type").isin("response", "revisit"), F.col("record_id")).otherwise(F.col("concurrent_to"))
    body = F.struct("record_id", "type", "refers_to", "target_uri", "warc_date", "payload_digest", "payload_bytes", F.map_entries("fields").alias("fields"), "payload")
    parts = records.withColumns({"_capture": capture, "_body": body}).where("_capture is not null")
    kind = lambda *names: F.min(F.when(F.col("type").isin(*names), F.col("_body")))
    rows = parts.groupBy("_capture").agg(kind("response", "revisit").alias("response"), kind("request").alias("request"), kind("metadata").alias("metadata"))
    return rows.where("response is not null").select(F.col("_capture").alias("capture_id"), F.col("response.target_uri").alias("target_uri"), "response", "request", "metadata")


def with_referred(captures: DataFrame, capture: str = "capture_id", refers_to: str = "refers_to", page: str = "page_id") -> DataFrame:
    """``captures`` (a row each, with its response's record id) with ``referred``: the page id of the response that a revisit's WARC-Refers-To names.

    Record ids are resolved against the responses that were read, so archives of any writer will do. Many revisits of one response are spread
    over tasks. Defined cases: a response, and a revisit whose response was not read, have null; repeated rows stay; no rows give none.
    """
    known = captures.where("record_type = 'response'").groupBy(F.col(capture).alias(refers_to)).agg(F.min(page).alias("referred"))
    revisits = join_one(captures.where("record_type <> 'response'"), known, [refers_to])
    others = captures.where("record_type = 'response'").withColumn("referred", F.lit(None).cast(captures.schema[page].dataType))
    return others.unionByName(revisits)


def _field(record: str, name: str):
    return F.element_at(F.map_from_entries(F.col(f"{record}.fields")), name)


@query("op3_warc_transactions")
def op3_warc_transactions(spark: SparkSession, folder: str) -> DataFrame:
    """Every page written to archives, read back and assembled."""
    pages = spark.read.parquet(f"{folder}/pages.parquet")
    path = shared_dir(spark, "warc")
    write_warc(pages, path)
    kind = pages.schema["page_id"].dataType
    captures = assemble(read_records(spark, path, payload=False)).select(
        "capture_id", F.col("response.refers_to").alias("refers_to"),
        _field("metadata", "page-id").cast(kind).alias("page_id"),
        F.col("response.payload_bytes").alias("payload_bytes"),
        F.col("response.payload_digest").alias("payload_digest"),
        F.col("response.type").alias("record_type"),
        "target_uri",
        F.col("request.record_id").isNotNull().alias("has_request"),
    )
    found = with_referred(stage(captures, "warc-captures"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", F.col("referred").alias("refers_to"), "target_uri", "has_request")

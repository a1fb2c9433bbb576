import base64
import gzip
import hashlib

from shelfwise.llm.warc import assemble, digest_of, op3_warc_transactions, parse_members, read_records, with_referred, write_warc
from shelfwise.session import shared_dir
from tests.test_queries import FOLDER

PAGES = "page_id bigint, url string, html string, _key string"


def test_round_trip_of_all_pages(spark):
    rows = {r["page_id"]: r for r in op3_warc_transactions(spark, FOLDER).collect()}
    pages = spark.read.parquet(f"{FOLDER}/pages.parquet").collect()
    first = {}
    for p in sorted(pages, key=lambda p: p["page_id"]):
        first.setdefault((p["html"] or "").encode(), p["page_id"])
    assert len(rows) == len(pages)
    for p in pages:
        body, r = (p["html"] or "").encode(), rows[p["page_id"]]
        leader = first[body]
        assert r["payload_bytes"] == len(body) and r["payload_digest"] == base64.b32encode(hashlib.sha1(body).digest()).decode()
        assert (r["record_type"], r["refers_to"]) == (("response", None) if leader == p["page_id"] else ("revisit", leader))
        assert r["target_uri"] == " ".join((p["url"] or "").split()) and r["has_request"]


def captures(spark, rows, **options):
    path = shared_dir(spark, "warc-test")
    write_warc(spark.createDataFrame(rows, PAGES), path, **options)
    return path, assemble(read_records(spark, path)).collect()


def test_nested_rows_and_odd_pages(spark):
    rows = [(1, "http://a/x?q", "p", "k"), (2, "http://a/y", "p", "k"), (2, "http://a/y", "p", "k"), (3, None, None, None), (None, "u\r\nX: y", "", None), (None, None, None, None), (4, "http://q", "z\r\n\r\n\x00é" + "w" * 300_000, "k")]
    path, got = captures(spark, rows)
    assert len(got) == len(rows) and len({r["capture_id"] for r in got}) == len(rows)
    page = lambda r: dict(r["metadata"]["fields"]).get("page-id")
    by_record = {r["response"]["record_id"]: page(r) for r in got}
    kinds = sorted((str(page(r)), r["response"]["type"], by_record.get(r["response"]["refers_to"])) for r in got)
    assert kinds == [("1", "response", None), ("2", "revisit", "1"), ("2", "revisit", "1"), ("3", "response", None), ("4", "response", None), ("None", "revisit", "3"), ("None", "revisit", "3")]
    big = next(r for r in got if page(r) == "4")["response"]
    assert bytes(big["payload"]).decode() == rows[-1][2] and big["payload_digest"] == digest_of(rows[-1][2].encode())
    assert {r["target_uri"] for r in got} == {"http://a/x?q", "http://a/y", "", "u X: y", "http://q"}
    responses = {r["response"]["record_id"] for r in got if r["response"]["type"] == "response"}
    assert all(r["response"]["refers_to"] in responses for r in got if r["response"]["type"] == "revisit")


def test_revisits_are_resolved_by_record_ids(spark):
    rows = [("a", None, "response", 1), ("b", "a", "revisit", 2), ("c", "gone", "revisit", 3), ("d", "a", "revisit", None), ("e", None, "revisit", 5), ("a", None, "response", 0)]
    table = spark.createDataFrame(rows, "capture_id string, refers_to string, record_type string, page_id long")
    got = sorted((r["capture_id"], r["referred"]) for r in with_referred(table).collect())
    assert got == [("a", None), ("a", None), ("b", 0), ("c", None), ("d", 0), ("e", None)]
    assert with_referred(table.limit(0)).collect() == []


def test_archives_are_bounded(spark, monkeypatch):
    import glob

    from shelfwise.llm import warc

    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 30_000)
    path, got = captures(spark, [(i, f"http://h/{i}", f"body {i} " * 100, None) for i in range(100)])
    assert len(got) == 100 and len(glob.glob(f"{path.removeprefix('file://')}/part-*")) >= 5


def test_least_size(spark):
    _, got = captures(spark, [(1, "u", "ab", None), (2, "u", "ab", None), (3, "u", "abc", None), (4, "u", "abc", None)], least=3)
    assert sorted(r["response"]["type"] for r in got) == ["response"] * 3 + ["revisit"]


def test_files_are_plain_gzip(spark):
    path, _ = captures(spark, [(i, f"http://h/{i}", f"body {i}", None) for i in range(20)])
    import glob

    raw = [open(f, "rb").read() for f in glob.glob(f"{path.removeprefix('file://')}/part-*")]
    text = b"".join(gzip.decompress(x) for x in raw if x)
    assert text.count(b"WARC/1.1\r\n") == 60
    assert sum(len(list(parse_members(x))) for x in raw if x) == 60


def test_records_without_partners(spark):
    path, _ = captures(spark, [(1, "http://h/1", "a", None), (2, "http://h/2", "b", None)])
    records = read_records(spark, path)
    got = assemble(records.where("type <> 'request'")).collect()
    assert len(got) == 2 and all(r["request"] is None and r["metadata"] is not None for r in got)
    assert assemble(records.where("type = 'metadata'")).collect() == []


def test_no_pages(spark):
    assert captures(spark, [])[1] == []

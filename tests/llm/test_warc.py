import hashlib

from cases import rows
from millrace.llm import warc
from millrace.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.01"
BIG = "<p>é\r\n\r\nWARC/1.1\r\n</p>" * 100


def pages(spark, data):
    return spark.createDataFrame(data, "page_id long, url string, html string, copy string")


def test_round_trip_with_copies(spark, scratch):
    data = [(1, "u1", BIG, "a"), (2, "u2\r\nX: y", BIG, "a"), (2, "u2", BIG, "b"), (3, None, "small", "a"), (4, "u", "small", "a"), (5, "u", None, "a"), (6, "u", "", "a"), (None, "n", BIG, "a"), (7, "u", "y" * 1000, "a"), (8, "u", "y" * 1000, "a")]
    path = scratch("archives")
    resolved = warc.resolve(pages(spark, data))
    assert sorted(resolved.columns) == sorted(["page_id", "url", "html", "payload_digest", "payload_bytes", "record_type", "refers_to", "copy"])
    warc.write_archives(resolved, path)
    records = warc.read_archives(spark, path)
    kinds = sorted((r["record_id"], r["record_type"], r["refers_to"]) for r in records.collect() if r["payload_bytes"] >= 1000)
    assert kinds == sorted([
        ("<urn:page:1>", "revisit", "<urn:page:2>"), ("<urn:page:2>", "response", None), ("<urn:page:2:1>", "revisit", "<urn:page:2>"),
        ("<urn:page:null>", "revisit", "<urn:page:2>"), ("<urn:page:7>", "revisit", "<urn:page:8>"), ("<urn:page:8>", "response", None),
    ], key=lambda k: k[0])
    assert all(r["content"] == "" for r in records.filter("record_type = 'revisit'").collect())
    full = warc.with_payloads(records)
    assert full.columns == records.columns
    want = sorted((html or "", hashlib.sha1((html or "").encode()).hexdigest()) for _, _, html, _ in data)
    assert sorted((r["content"], r["payload_digest"]) for r in full.collect()) == want


def test_empty(spark, scratch):
    path = scratch("archives")
    warc.write_archives(warc.resolve(pages(spark, [])), path)
    assert warc.read_archives(spark, path).count() == 0


def test_query_equals_brute_force(spark):
    given = spark.read.parquet(f"{SF_DIR}/pages.parquet").collect()
    last, want = {}, []
    for p in given:
        last[p["html"]] = max(last.get(p["html"], p["page_id"]), p["page_id"])
    for p in given:
        body = (p["html"] or "").encode()
        again = len(body) >= 1000 and last[p["html"]] != p["page_id"]
        want.append((p["page_id"], len(body), hashlib.sha1(body).hexdigest(), "revisit" if again else "response", last[p["html"]] if again else None))
    assert rows(QUERIES["op3_revisit_resolution"](spark, SF_DIR)) == sorted(want, key=repr)

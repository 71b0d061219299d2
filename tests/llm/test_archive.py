"""WARC archives and the pipeline."""

import base64
import hashlib

import pytest

from curio.llm import warc

PAGES = [(3, "u3", "<p>same</p>", 1), (1, "u1", "<p>same</p>", 1), (2, None, None, 1), (4, "u\r\n4", "", 1), (5, "u5", "é" * 70_000, 1), (9, "u9", "other", 1)]
DDL = "page_id bigint, url string, html string, sha256 int"


def test_round_trip(spark):
    got = {r.page_id: r for r in warc.round_trip(spark.createDataFrame(PAGES, DDL)).collect()}
    first = {}
    for p in sorted(PAGES):
        first.setdefault(p[2] or "", p[0])
    for page, _, html, _ in PAGES:
        raw, own = (html or "").encode(), first[html or ""]
        r = got[page]
        assert (r.payload_bytes, r.payload_digest) == (len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode())
        assert (r.record_type, r.refers_to) == (("response", None) if page == own else ("revisit", own))
    assert warc.round_trip(spark.createDataFrame([], DDL)).count() == 0


def test_payloads_once_and_records_exact(spark):
    payloads, headers = warc.write_archive(spark.createDataFrame(PAGES, DDL))
    assert payloads.count() == 4 and headers.count() == len(PAGES)
    for r in warc.read_records(payloads, headers, parse=False).collect():
        fields, body = warc.parse_record(bytes(r.record))
        assert int(fields["X-Page-Id"]) == r.page_id
        assert body == b"" or hashlib.sha1(body).digest() == base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:"))


def test_small_payloads_are_responses(spark):
    payloads, headers = warc.write_archive(spark.createDataFrame(PAGES, DDL), least=100)
    assert {r.record_type for r in warc.read_records(payloads, headers).collect()} == {"response"}


def test_damage_is_found(spark):
    from pyspark.sql import functions as F

    payloads, headers = warc.write_archive(spark.createDataFrame(PAGES, DDL))
    with pytest.raises(Exception, match="damaged"):
        warc.read_records(payloads.withColumn("sha256", F.col("sha256")).withColumn("size", F.col("size") + 1), headers).collect()


def test_pipeline_stages(spark, sf):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    from curio.llm.common import materialise, table

    docs = table(spark, sf, "documents")
    cols = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = materialise(stage(spark, docs, sf), f"test-{name}")
        assert out.columns == cols and 0 < out.count() <= docs.count()
        docs = out
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, sf)
    assert {r.doc_id for r in pieces.select("doc_id").distinct().collect()} == {r.doc_id for r in docs.select("doc_id").collect()}


def test_null_and_repeated_keys(spark):
    pages = [(None, "a", "only without key"), (None, "b", "only without key"), (None, None, "held"), (7, "c", "held"), (8, "d", "one"), (8, "e", "two"), (8, "f", "two")]
    got = sorted(map(tuple, warc.round_trip(spark.createDataFrame(pages, "page_id bigint, url string, html string")).collect()), key=repr)
    kinds = [("response", None), ("response", None), ("revisit", 7)] + [("response", None)] * 3 + [("revisit", 8)]
    want = [(p, len(h), base64.b32encode(hashlib.sha1(h.encode()).digest()).decode(), *k) for (p, _, h), k in zip(pages, kinds, strict=True)]
    assert got == sorted(want, key=repr)
    payloads, headers = warc.write_archive(spark.createDataFrame(pages, "page_id bigint, url string, html string"))
    ids = [warc.parse_record(bytes(r.record))[0]["WARC-Record-ID"] for r in warc.read_records(payloads, headers, parse=False).collect()]
    assert len(set(ids)) == len(pages)
    responses = {f["WARC-Record-ID"] for f in (warc.parse_record(bytes(r.record))[0] for r in warc.read_records(payloads, headers, parse=False).collect()) if f["WARC-Type"] == "response"}
    assert all(f["WARC-Refers-To"] in responses for f in (warc.parse_record(bytes(r.record))[0] for r in warc.read_records(payloads, headers, parse=False).collect()) if f["WARC-Type"] == "revisit")

import base64
import gzip
import hashlib

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from shelfline.llm import arc as A
from shelfline.llm.common import new_folder
from tests.compare import compare
from tests.conftest import SF_SMALL


def sha(b):
    return base64.b32encode(hashlib.sha1(b).digest()).decode()


def test_query_matches_sql(spark, duck_small):
    q = E.queries()["op2_arc_to_warc"](spark, SF_SMALL)
    assert compare(q, duck_small, E.oracle_sql()["op2_arc_to_warc"]) is None


@pytest.mark.parametrize("version", [1, 2])
def test_arc_records_of_both_versions(version):
    records = [("http://a/%20b", "1.2.3.4", "20010203040506", "text/html", A.http_document(7, b"x\n\nfiledesc://")),
               ("http://b", "0.0.0.0", "20010203", "text/plain", b""), ("http://c", "0.0.0.0", "20010203040506", "text/html", "é\r\n".encode())]
    data = A.arc_file("f.arc", version, records)
    for raw in (data, gzip.compress(data)):
        got = list(A.arc_records(raw))
        assert [b for _, b in got] == [r[4] for r in records]
        assert [(h["URL"], h["IP-address"], h["Archive-date"], h["Content-type"], h["Archive-length"]) for h, _ in got] == [
            (*r[:4], str(len(r[4]))) for r in records]
        assert len(got[0][0]) == (5 if version == 1 else 10)
    if version == 2:
        offset = int(got[1][0]["Offset"])
        assert data[offset:].startswith(b"http://b ")
    with pytest.raises(ValueError):
        list(A.arc_records(data[:-5]))
    with pytest.raises(ValueError):
        list(A.arc_records(b"http://a 1.1.1.1 20010101000000 text/html 2\nxx\n"))


def test_a_given_archive_becomes_warc(spark):
    """Foreign ARC files: no HTTP header, short dates, several records a file; the files on disk are WARC."""
    files = [("one.arc", A.arc_file("one.arc", 1, [("http://a", "1.1.1.1", "2003", "text/html", b"plain"),
                                                   ("http://b", "1.1.1.1", "20030405", "text/html", A.http_document(3, b"plain"))])),
             ("two.arc.gz", gzip.compress(A.arc_file("two.arc", 2, [("http://c", "1.1.1.1", "20030405060708", "text/html",
                                                                     A.http_document(9, b"plain"))])))]
    arcs = spark.createDataFrame(files, "path string, content binary")
    folder = new_folder(spark, "t")
    A.write_warc(A.with_types(A.converted(arcs), A.converted(arcs, slim=True)).coalesce(1), folder)
    raw = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(folder).first().content
    found = {h["warc-target-uri"]: (h, b) for h, b in A.warc_records(bytes(raw))}
    assert found["http://a"][0]["warc-date"] == "2003-01-01T00:00:00Z" and found["http://b"][0]["warc-date"] == "2003-04-05T00:00:00Z"
    assert found["http://c"][0]["warc-type"] == "response" and found["http://c"][1].endswith(b"plain")
    for u in ("http://a", "http://b"):
        h, block = found[u]
        assert h["warc-type"] == "revisit" and not block.endswith(b"plain")
        assert h["warc-refers-to"] == found["http://c"][0]["warc-record-id"] and h["warc-refers-to-target-uri"] == "http://c"
        assert h["warc-payload-digest"] == "sha1:" + sha(b"plain") and h["warc-block-digest"] == "sha1:" + sha(block)
    rows = A.resolved(A.read_warc(spark, folder)).collect()
    assert sorted((r.page_id or 0, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows) == [
        (0, 5, sha(b"plain"), "revisit", 9), (3, 5, sha(b"plain"), "revisit", 9), (9, 5, sha(b"plain"), "response", None)]


def test_edges_of_the_input(spark):
    long = "WARC/1.0\r\n\r\n" + "é\n" * 2_000_000
    rows = [(1, "http://x y\n", None, 0), (2, None, "", 0), (5, "u", "same", 0), (4, "u", "same", 0), (5, "v", "same", 0), (None, "w", "same", 0),
            (None, "w", "lone", 0), (7, "u", "twice", 0), (7, "u", "twice", 0), (6, "u", "twice", 0), (8, "http://é", long, 0)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, record_id int")
    got = A.pages_round_trip(df).collect()
    assert len(got) == len(rows)
    key = lambda r: (r.page_id or 0, r.payload_bytes, r.record_type, r.refers_to or 0)
    assert sorted(map(key, got)) == sorted([
        (1, 0, "revisit", 2), (2, 0, "response", 0), (5, 4, "response", 0), (5, 4, "revisit", 5), (4, 4, "revisit", 5), (0, 4, "revisit", 5),
        (0, 4, "response", 0), (7, 5, "response", 0), (7, 5, "response", 0), (6, 5, "revisit", 7), (8, len(long.encode()), "response", 0)])
    assert {r.payload_digest for r in got if r.page_id == 8} == {sha(long.encode())}
    assert all(r.payload_digest == r.declared for r in got)
    assert A.pages_round_trip(df.limit(0)).count() == 0


def test_a_hot_payload(spark):
    df = spark.range(6000).select(F.col("id").alias("page_id"), F.concat(F.lit("http://h/"), "id").alias("url"),
                                  F.when(F.col("id") % 3 == 0, "<p>copy</p>").otherwise(F.sha2(F.col("id").cast("string"), 256)).alias("html"))
    got = A.pages_round_trip(df)
    assert got.where("record_type = 'revisit' AND refers_to = 5997").count() == 1999 and got.where("record_type = 'response'").count() == 4001

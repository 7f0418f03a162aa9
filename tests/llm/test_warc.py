"""WARC archives: round trip, format, SQL."""

import struct

import duckdb
import zstandard

import check
from pitpanel.llm import queries, warc
from pitpanel.llm.common import shared_folder
from pitpanel.llm.sql import SQL


def test_pack_round_trip():
    records = [b"record %d " % k + b"common text of all records " * 20 for k in range(400)]
    data = warc.pack(records)
    magic, size = struct.unpack("<II", data[:8])
    assert magic == warc.SKIPPABLE
    trained = zstandard.ZstdDecompressor().decompress(data[8 : 8 + size])
    assert struct.unpack("<I", trained[:4])[0] == warc.DICTIONARY
    assert list(warc.unpack(data)) == records
    plain = sum(len(zstandard.ZstdCompressor().compress(r)) for r in records)
    assert len(data) - 8 - size < plain
    assert list(warc.unpack(warc.pack([b"one"]))) == [b"one"]
    assert list(warc.unpack(b"")) == []


def test_rows(spark):
    big, same = "é<p>" * 30_000, "z" * 100
    rows = [(5, "http://a b/é\r\nX: 1", same, 1), (2, None, same, 2), (9, "u", same, 3), (9, "u", same, 4), (1, "u", "z" * 99, 5), (3, "u", "z" * 99, 6), (4, "u", None, 7),
            (6, "u", "", 8), (7, "u", big, 9), (None, "u", same, 10), (None, "u", "q" * 200, 11), (None, "u", "q" * 200, 12), (8, "u", "a\r\n\r\nb" * 50, 13)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, original int")
    found = warc.read(warc.write(df, shared_folder(spark, "test"))).collect()
    assert len(found) == len(rows) and all(r["intact"] for r in found)
    got = sorted((-1 if r["page_id"] is None else r["page_id"], r["payload_bytes"], r["record_type"], r["refers_to"] or 0) for r in found)
    assert got == sorted([(5, 100, "revisit", 2), (2, 100, "response", 0), (9, 100, "revisit", 2), (9, 100, "revisit", 2), (1, 99, "response", 0), (3, 99, "response", 0),
                          (4, 0, "response", 0), (6, 0, "response", 0), (7, 150_000, "response", 0), (-1, 100, "revisit", 2), (-1, 200, "response", 0), (-1, 200, "response", 0),
                          (8, 300, "response", 0)])
    assert {r["url"] for r in found if r["page_id"] == 5} == {"http://a%20b/%C3%A9%0D%0AX:%201"}
    empty = warc.write(df.limit(0), shared_folder(spark, "test"))
    assert empty.count() == 0 and warc.read(empty).count() == 0


def test_sql(spark, small):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{small}/pages.parquet'")
    df = queries.op5_warc(spark, small)
    res = con.execute(SQL["op5_warc"])
    names = [d[0] for d in res.description]
    assert check.canonical(df.columns, [tuple(r) for r in df.collect()]) == check.canonical(names, res.fetchall())

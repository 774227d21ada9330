"""WARC archives: round trips, members and offsets, broken streams, revisits, nulls, repeats, long payloads, empty tables."""

import base64
import gzip
import hashlib
import io
import json
import random
import zlib
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from sightline.llm import queries, warc
from sightline.llm.common import shared_folder

SCHEMA = "page_id long, url string, html string"


def sha1(data):
    return hashlib.sha1(data).digest()


def stream(rows):
    return b"".join(b"".join(warc.record(k, u, p, len(p or b""), sha1(p or b""), r)) for k, u, p, r in rows)


ROWS = [
    (1, "http://a/ü x", b"one", None), (2, None, b"", None), ("k%/>é", "http://b/\r\nX: y\x85", b"WARC/1.1\r\n\r\n\r\n", None), (None, "", bytes(range(256)) * 9, None),
    (3, "http://c", None, 1), ("", "http://d", random.Random(1).randbytes(3 << 20), None)
]


def normalised(data):
    sink, lines, error = io.BytesIO(), [], None
    try:
        for line in warc.normalise_stream(io.BytesIO(data), sink):
            lines.append(line)
    except warc.BrokenArchive as problem:
        error = str(problem)
    return sink.getvalue(), lines, error


@pytest.mark.parametrize("members", ["one", "each", "odd"])
def test_normalise_stream(members):
    plain = stream(ROWS)
    cuts = {"one": [0], "each": [len(stream(ROWS[:k])) for k in range(len(ROWS))], "odd": [0, 5, 400, 401, len(plain) - 3]}[members]
    data = b"".join(gzip.compress(plain[a:b]) for a, b in zip(cuts, [*cuts[1:], len(plain)]))
    out, lines, error = normalised(data)
    assert error is None and zlib.decompressobj(31).decompress(out) == stream(ROWS[:1]) and gzip.decompress(out) == plain
    assert [x["offset"] for x in lines] == [sum(x["length"] for x in lines[:k]) for k in range(len(lines))] and sum(x["length"] for x in lines) == len(out)
    for row, line in zip(ROWS, lines, strict=True):
        member = out[line["offset"] : line["offset"] + line["length"]]
        assert zlib.decompress(member, 31) == stream([row])
        key, _, payload, refers = row
        got = warc._read_member(member, True)
        assert got["id"] == (None if key is None else str(key)) and got["payload"] == payload and got["payload_bytes"] == len(payload or b"")
        assert got["refers_to"] == (None if refers is None else str(refers)) and got["record_type"] == line["type"] == ("revisit" if payload is None else "response")
        assert got["payload_digest"] == base64.b32encode(sha1(payload or b"")).decode() == line["digest"].removeprefix("sha1:")


def test_broken_streams():
    plain = stream(ROWS[:3])
    whole = len(stream(ROWS[:2]))
    data = gzip.compress(plain)
    assert normalised(b"") == (b"", [], None)
    for bad in (data[:-9], gzip.compress(plain[:-2]), gzip.compress(plain[: whole + 30]), gzip.compress(plain[:whole]) + b"rubbish", gzip.compress(plain[:whole] + b"no warc\r\n\r\n")):
        out, lines, error = normalised(bad)
        # Cut in the trailer, the last record was whole and is kept.
        assert error and len(lines) == (3 if bad == data[:-9] else 2) and gzip.decompress(out) == stream(ROWS[: len(lines)])
    assert normalised(b"not gzip")[2] and normalised(gzip.compress(b"x" * (3 << 20)))[2] == "a header without an end"
    changed = plain.replace(b"\r\n\r\none\r\n", b"\r\n\r\n0ne\r\n")
    out, lines, _ = normalised(gzip.compress(changed))
    with pytest.raises(warc.BrokenArchive):
        warc._read_member(out[: lines[0]["length"]], False)


def expected(rows, least=0):
    leaders = {}
    for key, _, html in rows:
        data = (html or "").encode()
        if len(data) >= least and key is not None:
            leaders[data] = max(key, leaders.get(data, key))
    out = Counter()
    for key, _, html in rows:
        data = (html or "").encode()
        leader = leaders.get(data)
        refers = leader if leader is not None and key != leader else None
        out[key, len(data), base64.b32encode(sha1(data)).decode(), "response" if refers is None else "revisit", refers] += 1
    return out


def got(df):
    return Counter((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in df.collect())


@pytest.mark.parametrize("least, parts", [(0, 1000), (3, 5), (0, 1)])
def test_round_trip(spark, monkeypatch, least, parts):
    monkeypatch.setattr(warc, "HOT_PARTS", parts)
    rng = random.Random(parts)
    rows = [(k, rng.choice([None, "http://x/é", "http://y\n"]), rng.choice([None, "", "ab", "É", "same", "same", f"own {k}", "long " * 40000])) for k in range(-40, 80)]
    rows += rows[:4] + [(None, "u", "same"), (None, None, None), (None, "u", "only null ids")] * 2
    table = spark.createDataFrame(rows, SCHEMA).repartition(4).withColumn("key", F.lit("k")).withColumn("leader", F.lit(9)).withColumn("size", F.lit("s"))
    assert got(warc.round_trip(table, least=least, archive_bytes=300_000)) == expected(rows, least)
    assert warc.round_trip(spark.createDataFrame([], SCHEMA)).count() == 0


def test_archives(spark):
    """Files of an archive: monolithic streams are gone, members follow the index, payloads and urls come back."""
    rows = [(k, f"http://h/{k}", f"page {k % 7}") for k in range(30)]
    reports = warc.archive(spark.createDataFrame(rows, SCHEMA).coalesce(1), archive_bytes=2000)
    files = reports.collect()
    assert len(files) > 1 and sum(r["records"] for r in files) == 30 and not any(r["error"] for r in files)
    types = Counter()
    for r in files:
        data, lines = open(r["path"], "rb").read(), [json.loads(x) for x in open(r["index"])]
        assert sum(x["length"] for x in lines) == len(data) and len(lines) == r["records"]
        types.update(x["type"] for x in lines)
        with pytest.raises(FileNotFoundError):
            warc._open(r["source"])
    assert types == {"response": 7, "revisit": 23}
    back = warc.read_records(warc.index_lines(reports), payloads=True).collect()
    assert {(r["id"], r["uri"]) for r in back} == {(str(k), u) for k, u, _ in rows}
    assert {(r["payload"].decode(), r["record_type"]) for r in back if r["payload"] is not None} == {(f"page {k}", "response") for k in range(7)}


def test_normalise_reports_broken_archives(spark):
    folder = f"{shared_folder(spark)}/warc-test".replace("file:", "")
    paths = []
    for name, data in (("good", gzip.compress(stream(ROWS))), ("cut", gzip.compress(stream(ROWS))[:-20]), ("empty", b"")):
        paths.append((f"{folder}/{name}",))
        with warc._create(paths[-1][0]) as out:
            out.write(data)
    reports = {r["source"].rpartition("/")[2]: (r["records"], r["error"] is None) for r in warc.normalise(spark.createDataFrame(paths, "path string"), f"{folder}/out").collect()}
    assert reports == {"good": (6, True), "cut": (5, False), "empty": (0, True)}


def test_op11_warc(spark):
    folder = "/root/testdata/sf0.01"
    connection = duckdb.connect()
    connection.sql(f"CREATE VIEW pages AS SELECT * FROM '{folder}/pages.parquet'")
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    want = connection.sql(f"SELECT {', '.join(names)} FROM ({queries.ORACLE['op11_warc']})").fetchall()
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/pages.parquet").select("page_id", "url", "html").collect()]
    assert got(queries.op11_warc(spark, folder)) == expected(rows) == Counter(want)

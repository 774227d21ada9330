"""The Merkle manifest against a plain one: run lengths, nulls, ties, repeats, empty tables, clashing names."""

import hashlib
import random
import zlib
from collections import defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from sightline.llm import merkle, queries

COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_leaf(row):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def climb(nodes, fanout):
    """The last node, and for each node its steps (left, right)."""
    steps, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for k, a in enumerate(at):
            lo = a // fanout * fanout
            steps[k].append(("".join(nodes[lo:a]), "".join(nodes[a + 1 : lo + fanout])))
        nodes = [h("".join(nodes[i : i + fanout])) for i in range(0, len(nodes), fanout)]
        at = [a // fanout for a in at]
    return nodes[0], steps


def plain_manifest(rows, fanout, tamper):
    groups = defaultdict(list)
    for row in rows:
        groups[row[1]].append(row)
    order, out = sorted(groups, key=lambda s: (s is not None, (s or "").encode())), []
    for source in order:
        groups[source].sort(key=lambda r: (r[0] is not None, r[0] or 0, plain_leaf(r)))
    lower = {s: climb([plain_leaf(r) for r in groups[s]], fanout) for s in order}
    root, upper = climb([lower[s][0] for s in order], fanout)
    for source, above in zip(order, upper):
        for row, steps in zip(groups[source], lower[source][1]):
            used = plain_leaf(tamper(row))
            for left, right in (*steps, *above):
                used = h(left + used + right)
            proof = h("".join(a + b for a, b in (*steps, *above)))
            out.append((row[0], plain_leaf(row), lower[source][0], root, proof, used, used == root))
    return out


def tampered(row):
    if row[0] is None or row[4] is None or zlib.crc32(str(row[0]).encode()) % 5:
        return row
    return (*row[:4], "".join(c.lower() if "A" <= c <= "Z" else c for c in row[4]))


def found(docs, fanout):
    lowered = F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    changed = [F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), F.coalesce(lowered, "text")]
    got = merkle.verified(merkle.manifest(docs, COLUMNS, "doc_id", "source", fanout, changed)).collect()
    return [(r["doc_id"], *(r[c].hex() for c in ("leaf", "subroot", "root", "proof", "folded_root")), r["verified"]) for r in got]


@pytest.mark.parametrize("fanout", [2, 3, 16])
def test_manifest(spark, fanout):
    rng, rows = random.Random(fanout), []
    for source, n in ((None, 17), ("", 1), ("b", 257 if fanout == 16 else 20), ("É", 16), ("a", 2), ("1", 33), ("0", 3)):
        for k in range(n):
            text = rng.choice([None, "", "Aa É", "x" * 20000 + "Y", "plain", f"T{k}"])
            rows.append((rng.choice([None, k, k, -k, 7]), source, rng.choice([None, "en"]), rng.choice([None, k]), text))
    rows += rows[:5] + [(3, "hot", "en", 1, "Same")] * 300  # repeated rows, a group of equal ones
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    docs = docs.withColumn("key", F.lit("k")).withColumn("idx", F.lit(1)).withColumn("hash", F.lit(0)).withColumn("path", F.lit("p")).withColumn("n", F.lit(2))
    key = lambda r: (r[0] is not None, r[0] or 0, *r[1:])
    assert sorted(found(docs, fanout), key=key) == sorted(plain_manifest(rows, fanout, tampered), key=key)


def test_small_tables(spark):
    assert found(spark.createDataFrame([], SCHEMA), 16) == []
    for rows in ([(None, None, None, None, None)], [(5, "a", "en", 1, "A")] * 2, [(1, "a", None, 1, "A"), (1, "b", None, 1, "A")]):
        assert sorted(found(spark.createDataFrame(rows, SCHEMA), 16), key=str) == sorted(plain_manifest(rows, 16, tampered), key=str)


def test_op13_merkle(spark):
    folder = "/root/testdata/sf0.01"
    connection = duckdb.connect()
    connection.sql(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet'")
    names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    want = connection.sql(f"SELECT {', '.join(names)} FROM ({queries.ORACLE['op13_merkle']})").fetchall()
    got = [tuple(r) for r in queries.op13_merkle(spark, folder).select(*names).collect()]
    docs = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select(*COLUMNS).collect()]
    assert sorted(got) == sorted(want) == sorted(plain_manifest(docs, 16, tampered))
    assert 0 < sum(not r[-1] for r in got) < len(got) / 4

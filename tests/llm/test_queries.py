"""The registered queries of the subpackage over whole tables, against brute force, libraries and held-out labels."""

import hashlib
import zlib

import duckdb
import numpy as np
import pytest
from test_llm import PIECES, WORDS, Labels, plain_fingerprint, plain_spans

from sightline.llm import pii, queries

SMALL, LARGER = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def texts(spark, sf_dir):
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}


def labelled(spark, sf_dir, column):
    return {r[0]: r[1] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", column).collect()}


def remainder(key, modulus):
    return zlib.crc32(str(key).encode()) % modulus


def test_op1_packing(spark):
    from tokenizers import Tokenizer

    tokenizer, docs = Tokenizer.from_file(WORDS), texts(spark, SMALL)
    rows = queries.op1_packing(spark, SMALL).collect()
    got = {(r["doc_id"], r["start"]): (r["length"], r["ids_crc32"], r["doc_tokens"]) for r in rows}
    want = {}
    for key, text in docs.items():
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], dtype="<u4")
        for at in range(0, len(ids), 2048):
            want[key, at] = (len(ids[at : at + 2048]), zlib.crc32(ids[at : at + 2048].tobytes()), len(ids))
    assert got == want and len(rows) == len(want)
    spans = sorted((r["sequence_id"], r["offset"], r["length"]) for r in rows)
    ends = {s: o + n for s, o, n in spans}
    assert all(a[1] + a[2] == b[1] if a[0] == b[0] else b[1] == 0 for a, b in zip(spans, spans[1:])) and max(ends.values()) <= 2048
    assert sum(ends.values()) / (2048 * len(ends)) > 0.95


@pytest.mark.parametrize("name, column, modulus, threshold, least", [("op2_quality", "quality", 5, 0.3, 0.97), ("op6_toxicity", "toxic", 5, 0.5, 0.9)])
def test_held_out_labels(spark, name, column, modulus, threshold, least):
    rows, labels = queries.QUERIES[name](spark, LARGER).collect(), labelled(spark, LARGER, column)
    assert {r["doc_id"] for r in rows} == set(texts(spark, LARGER)) and len({r["doc_id"] for r in rows}) == len(rows)
    assert all(
        r["held_out"] == (remainder(r["doc_id"], modulus) == 0) and 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= threshold) for r in rows
    )
    held = [r["predicted"] == labels[r["doc_id"]] for r in rows if r["held_out"] and labels.get(r["doc_id"]) in (0, 1)]
    print(f"{name}: {sum(held)} of {len(held)} held-out labels")
    assert len(held) > 30 and sum(held) / len(held) >= least


def test_op3_language(spark):
    docs = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{LARGER}/documents.parquet").collect()}
    rows = queries.op3_language(spark, LARGER).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(docs)
    assert all(r["held_out"] == (remainder(r["doc_id"], 4) == 2) and 0 <= r["score"] <= 1 for r in rows)
    held = [r["lang_pred"] == docs[r["doc_id"]] for r in rows if r["held_out"] and docs[r["doc_id"]]]
    print(f"op3_language: {sum(held)} of {len(held)} held-out languages")
    assert len(held) > 100 and sum(held) / len(held) >= 0.97


def test_op4_neighbours(spark):
    table = {r["vec_id"]: r["embedding"] for r in spark.read.parquet(f"{LARGER}/embeddings.parquet").collect()}
    ids, points = np.array(sorted(table)), np.array([table[k] for k in sorted(table)], dtype=np.float64)
    rows, hit = queries.op4_neighbours(spark, LARGER).collect(), 0
    for q in ids[ids % 100 == 0]:
        distance = np.sqrt(((points - points[ids == q]) ** 2).sum(axis=1))
        own = sorted((r["rank"], r["vec_id"], r["score"]) for r in rows if r["query_id"] == q)
        assert [r for r, _, _ in own] == list(range(1, 11)) and [(s, v) for _, v, s in own] == sorted((s, v) for _, v, s in own)
        assert all(abs(distance[ids == v][0] - s) < 1e-12 and v != q for _, v, s in own)
        best = [int(ids[k]) for k in np.lexsort((ids, distance)) if ids[k] != q][:10]
        hit += len(set(best) & {v for _, v, _ in own})
    assert hit / (10 * (ids % 100 == 0).sum()) >= 0.9


def test_op5_sentencepiece(spark):
    import sentencepiece

    model, docs = sentencepiece.SentencePieceProcessor(model_file=PIECES), texts(spark, SMALL)
    rows = queries.op5_sentencepiece(spark, SMALL).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(docs)
    for r in rows:
        ids = model.encode(docs[r["doc_id"]] or "")
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (len(ids), sha(",".join(map(str, ids))), sha(model.decode(ids)))


def test_op7_pii(spark):
    docs, rows = texts(spark, SMALL), queries.op7_pii(spark, SMALL).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(docs)
    for r in rows:
        base = plain_spans(docs[r["doc_id"]] or "")
        spelt = [f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in base]
        assert [r[f"n_{kind}"] for kind in pii.KINDS] == [sum(k == n for _, k, _ in base) for n in range(4)]
        assert r["base_sha256"] == sha(",".join(spelt))
        found = [tuple(s.split(":")) for s in r["spans"].split(",") if s]
        assert set(spelt) <= {":".join(s) for s in found}
        assert found == sorted(found, key=lambda s: (int(s[1]), pii.KINDS.index(s[0])))


def test_op8_embedding_dedup(spark):
    table = {r["vec_id"]: r["embedding"] for r in spark.read.parquet(f"{LARGER}/embeddings.parquet").collect()}
    ids, points = np.array(sorted(table)), np.array([table[k] for k in sorted(table)], dtype=np.float64)
    points /= np.linalg.norm(points, axis=1, keepdims=True)
    near, labels = points @ points.T >= 0.95, Labels(len(ids))
    labels.add(*np.nonzero(near))
    rows = sorted(queries.op8_embedding_dedup(spark, LARGER).collect())
    low = ids[labels.label]
    assert [(r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in rows] == [
        (int(i), int(n) - 1, int(c), bool(i == c)) for i, n, c in zip(ids, near.sum(axis=1), low)
    ]


def test_op9_simhash(spark):
    docs = texts(spark, SMALL)
    ids = sorted(docs)
    prints, labels = np.array([plain_fingerprint(docs[k]) for k in ids], dtype=np.uint64), Labels(len(ids))
    labels.add(*np.nonzero(np.bitwise_count(prints[:, None] ^ prints[None]) <= 2))
    rows = sorted(queries.op9_simhash(spark, SMALL).collect())
    assert [(r["doc_id"], r["fingerprint"], r["component_id"]) for r in rows] == [(k, f"{int(p):016x}", ids[c]) for k, p, c in zip(ids, prints, labels.label)]


def test_op10_url_rules(spark):
    connection = duckdb.connect()
    connection.sql(f"CREATE VIEW pages AS SELECT * FROM '{LARGER}/pages.parquet'")
    want = connection.sql(f"SELECT page_id, host, path, rule, verdict FROM ({queries.ORACLE['op10_url_rules']})").fetchall()
    got = queries.op10_url_rules(spark, LARGER).select("page_id", "host", "path", "rule", "verdict").collect()
    assert sorted(map(tuple, got)) == sorted(want)


def test_pipeline_run(spark):
    """Every piece that the pipeline packs is one of its last documents', whole; the documents are those that the stages keep one by one."""
    import corpus_pipeline
    from tokenizers import Tokenizer

    tokenizer, docs, sizes = Tokenizer.from_file(WORDS), spark.read.parquet(f"{SMALL}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, SMALL).collect(), docs.schema)
        sizes.append(docs.count())
    want = {}
    for r in docs.collect():
        ids = np.array([*tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, 1], dtype="<u4")
        want |= {(r["doc_id"], at): zlib.crc32(ids[at : at + 2048].tobytes()) for at in range(0, len(ids), 2048)}
    rows = corpus_pipeline.run(spark, SMALL).collect()
    assert {(r["doc_id"], r["start"]): r["ids_crc32"] for r in rows} == want and len(rows) == len(want)
    assert sizes[0] >= sizes[1] >= sizes[2] == sizes[3] > 0

"""Packing: first-fit decreasing with a tournament tree, in randomised groups of documents.

Token ids come from the word BPE tokenizer, by distinct word: a word's ids are looked up once
in a worker and joined as bytes. Documents are cut at multiples of the capacity; full pieces are
sequences of their own where they lie. Only the remainders, one a document at most, are shuffled into
groups and packed there, as plain integers.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import over_batches, small_batches, written

CAPACITY = 2048
END_ID = 1
#: Mean number of documents whose remainders one group packs together.
GROUP_DOCS = 20_000
#: Distinct words that a worker remembers, and characters of one that it does.
WORDS, WORD_LENGTH = 400_000, 64
#: Numbers of sequences of full pieces start here; those of groups lie below.
FULL = 1 << 62

#: Found where the library's normalisation is more than lower-casing, or a special token may stand.
_ODD = re.compile("[^\x00-\x1b\x20-\x7f\xc0-\xd6\xd8-\xf6\xf8-\xff]|<\\|")
#: The tokenizer's own split of lower-cased text, spelt for the other characters.
_WORD = re.compile("[a-z\xdf-\xf6\xf8-\xff]+|'(?:s|t|re|ve|m|ll|d)|[0-9]|[^\\s0-9a-z\xdf-\xf6\xf8-\xff]+")


@lru_cache(maxsize=1)
def word_encoder(path: str) -> Callable[[str], bytes]:
    """text -> its ids (no special tokens added) as little-endian unsigned 32-bit integers; a worker keeps it."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark has a task for each core
    from tokenizers import Tokenizer, pre_tokenizers

    tokenizer, plain = Tokenizer.from_file(path), Tokenizer.from_file(path)
    # For words that are split and lower-cased already: the same merges without the other steps.
    plain.normalizer = None
    plain.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
    final = np.zeros(tokenizer.get_vocab_size(), dtype=bool)
    final[[k for token, k in tokenizer.get_vocab().items() if token.endswith("</w>")]] = True
    known: dict[str, bytes] = {}

    def ids(text: str) -> np.ndarray:
        return np.array(tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4")

    def learn(words: list[str]) -> None:
        """Encode new words at once; each ends with a token that is marked as final."""
        found = np.array(plain.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, dtype="<u4")
        ends = np.flatnonzero(final[found]) + 1
        if len(ends) == len(words):
            data, last = found.tobytes(), 0
            for word, at in zip(words, (4 * ends).tolist()):
                known[word] = data[last:at]
                last = at
        else:
            known.update((w, ids(w).tobytes()) for w in words)

    def encode(text: str) -> bytes:
        if _ODD.search(text):
            return ids(text).tobytes()
        words = _WORD.findall(text.lower())
        try:
            return b"".join([known[w] for w in words])
        except KeyError:
            if len(known) > WORDS:
                known.clear()
            learn(list(set(words).difference(known)))
            out = b"".join([known[w] for w in words])
            for long in [w for w in set(words) if len(w) > WORD_LENGTH]:
                del known[long]  # so that the table is bounded in bytes too
            return out

    return encode


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, start, length, ids_crc32, doc_tokens, place) of each piece of each document; place tells rows apart that are alike."""
    small_batches(docs.sparkSession)
    end = np.array([end_id], dtype="<u4").tobytes()
    placed = docs.select(id_col, F.col(text_col).alias("__text"), F.monotonically_increasing_id().alias("__place"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        encode = word_encoder(tokenizer_path)
        source, start, length, crc, total = [], [], [], [], []
        for k, text in enumerate(batch.column(1).to_pylist()):
            data = encode(text or "") + end
            n = len(data) // 4
            for at in range(0, n, capacity):
                part = data[4 * at : 4 * (at + capacity)]
                source.append(k)
                start.append(at)
                length.append(len(part) // 4)
                crc.append(zlib.crc32(part))
                total.append(n)
        take = pa.array(source, pa.int64())
        return pa.RecordBatch.from_arrays(
            [batch.column(0).take(take), *(pa.array(x, pa.int64()) for x in (start, length, crc, total)), batch.column(2).take(take)],
            names=[id_col, "start", "length", "ids_crc32", "doc_tokens", "place"]
        )

    return over_batches(placed, placed.columns, run, f"{id_col} long, start long, length long, ids_crc32 long, doc_tokens long, place long")


def first_fit_decreasing(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each length, longest first, each into the first bin with room.

    A tournament tree over the bins holds in every node the most room below it, so the first
    fitting bin is found by one walk from the root.
    """
    n = len(lengths)
    leaves = 1 << max(1, n - 1).bit_length()
    room = [capacity] * (2 * leaves)
    bins, offsets = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
    for k in np.argsort(-lengths, kind="stable").tolist():
        need, node = int(lengths[k]), 1
        while node < leaves:
            node *= 2
            if room[node] < need:
                node += 1
        bins[k], offsets[k] = node - leaves, capacity - room[node]
        room[node] -= need
        node //= 2
        while node:
            most = max(room[2 * node], room[2 * node + 1])
            if room[node] == most:
                break
            room[node] = most
            node //= 2
    return bins, offsets


def pack(
    docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text",
    group_docs: int = GROUP_DOCS
) -> DataFrame:
    """Each piece with its `sequence_id` and `offset` (gapless from 0 in a sequence).

    A null or empty text is the end id alone. Repeated rows are packed each. An empty table
    gives no sequences. Groups are random in the place of a row, so that no source, length or
    repeated id shapes one; which rows share a sequence follows from how the table is split into files.
    """
    # Five numbers a piece, written once, as full pieces and remainders are read apart.
    cut = written(pieces(docs, tokenizer_path, capacity, end_id, id_col, text_col), "pieces")
    columns = [id_col, "start", "length", "ids_crc32", "doc_tokens"]
    rest = cut.where(F.col("length") < capacity)
    groups = max(1, round(rest.count() / group_docs))
    grouped = rest.withColumn("group", F.pmod(F.xxhash64(id_col, "place"), F.lit(groups)))

    def run(rows: pa.Table) -> pa.Table:
        length, crc, place = (rows.column(c).to_numpy() for c in ("length", "ids_crc32", "place"))
        rows = rows.take(pa.array(np.lexsort((place, crc, -length))))
        bins, offsets = first_fit_decreasing(rows.column("length").to_numpy(), capacity)
        # Sequences are numbered group by group; a group holds far fewer than 2 ** 32.
        numbers = (rows.column("group").to_numpy().astype(np.int64) << 32) + bins
        return rows.select(columns).append_column("sequence_id", pa.array(numbers)).append_column("offset", pa.array(offsets))

    packed = grouped.groupBy("group").applyInArrow(
        run, f"{id_col} long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    )
    # A full piece's number is that of its row in the written table: unique, and the same if a task runs anew.
    full = cut.where(F.col("length") == capacity).select(
        *columns, (F.lit(FULL) + F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    return packed.unionByName(full)

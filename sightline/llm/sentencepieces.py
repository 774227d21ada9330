"""SentencePiece encoding and decoding by a table of distinct chunks.

No piece of the model crosses from a letter to a following whitespace marker, so a text splits
before each run of markers into chunks that segment independently. A worker segments each
distinct chunk once, keeps its ids, their spelling and what they decode to in a table, and joins them
back by position.
"""

from __future__ import annotations

import hashlib
import re
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import over_batches, small_batches

#: Distinct chunks that a worker remembers before it starts its table anew, and characters of one that it does.
CHUNKS, CHUNK_LENGTH = 400_000, 64
#: Chunks that are segmented at once.
BLOCK = 1000
MARK = "▁"
_CHUNK = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")


def _numbers(spelt: bytes) -> list[int]:
    return list(map(int, spelt.split(b",")[:-1]))


class ChunkTable:
    """Ids of whole texts from a table of segmented chunks; texts are encoded whole where a model's pieces do not keep to chunks."""

    def __init__(self, model_path: str, limit: int = CHUNKS):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=model_path)
        pieces = [self.model.id_to_piece(k) for k in range(self.model.get_piece_size())]
        # The library puts one marker before any text. A line feed before the chunk takes it up:
        # it is a byte piece of its own that merges with nothing.
        self.lead = self.model.encode("\n")
        #: Whether chunks segment as they do within a text.
        self.apart = not any(re.search(f"[^{MARK}]{MARK}|\n.", p) for p in pieces)
        #: Whether line feeds keep many chunks apart in one text.
        self.feeds = bool(self.lead) and not any("\n" in p for p in pieces)
        self.limit = limit
        #: Of each chunk its ids as decimals with a comma after each, and what they decode to within a text.
        self.known: dict[str, tuple[bytes, bytes]] = {}

    def _learn(self, chunks: list[str]) -> None:
        plain = [c for c in chunks if "\n" not in c] if self.feeds else []
        for at in range(0, len(plain), BLOCK):
            self._learn_block(plain[at : at + BLOCK])
        for chunk in set(chunks).difference(plain):
            self._learn_block([chunk])

    def _learn_block(self, chunks: list[str]) -> None:
        """Segment chunks in one text, a line feed before each; behind it nothing is taken for the start of a text."""
        ids = self.model.encode("\n" + "\n".join(chunks))
        decoded = self.model.decode(ids)
        if ids[: len(self.lead)] != self.lead or decoded[:1] != "\n":
            raise ValueError("the model merges a line feed with what follows")
        if len(chunks) == 1:
            spelt, texts = [",".join(map(str, ids[len(self.lead) :]))], [decoded[1:]]
        else:
            spelt = ("," + ",".join(map(str, ids)) + ",").split(f",{self.lead[-1]},")[1:]
            spelt[-1] = spelt[-1][:-1]
            texts = decoded[1:].split("\n")
        if not len(spelt) == len(texts) == len(chunks):
            for chunk in chunks:
                self._learn_block([chunk])
            return
        for chunk, own, text in zip(chunks, spelt, texts):
            self.known[chunk] = (own.encode() + b"," if own else b"", text.encode("utf-8", "surrogatepass"))

    def _found(self, text: str) -> list[tuple[bytes, bytes]]:
        """The table's entries of a text's chunks."""
        chunks, known = _CHUNK.findall(self.model.normalize(text)), self.known
        try:
            return [known[c] for c in chunks]
        except KeyError:
            if len(known) > self.limit:
                known.clear()
            self._learn(list(set(chunks).difference(known)))
            found = [known[c] for c in chunks]
            for long in [c for c in set(chunks) if len(c) > CHUNK_LENGTH]:
                del known[long]  # so that the table is bounded in bytes too
            return found

    def encode(self, text: str) -> list[int]:
        if not text:
            return []
        if not self.apart:
            return self.model.encode(text)
        return _numbers(b"".join([f[0] for f in self._found(text)]))

    def spelt(self, text: str) -> tuple[int, bytes, bytes]:
        """(number of ids, the ids as decimals with commas between, what they decode to) of a text, all from the table."""
        if not text or not self.apart:
            ids = self.encode(text)
            return len(ids), ",".join(map(str, ids)).encode(), self.model.decode(ids).encode("utf-8", "surrogatepass")
        found = self._found(text)
        if not found:
            return 0, b"", b""
        ids = b"".join([f[0] for f in found])
        # The library drops the marker that it puts before a text, so the first chunk decodes as it would alone.
        first = self.model.decode(_numbers(found[0][0])).encode("utf-8", "surrogatepass")
        return ids.count(b","), ids[:-1], first + b"".join([f[1] for f in found[1:]])

    def decode(self, ids: list[int]) -> str:
        return self.model.decode(ids)


@lru_cache(maxsize=1)
def chunk_table(model_path: str) -> ChunkTable:
    """The table that a worker keeps from task to task."""
    return ChunkTable(model_path)


def encode_texts(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids array<int>, decoded string) of each whole text; null texts are empty."""
    return _over(docs, model_path, id_col, text_col, digests=False)


def encode_digests(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256) of each whole text, without moving the ids out of the worker."""
    return _over(docs, model_path, id_col, text_col, digests=True)


def _over(docs: DataFrame, model_path: str, id_col: str, text_col: str, digests: bool) -> DataFrame:
    small_batches(docs.sparkSession)

    def digested(number: int, ids: bytes, decoded: bytes) -> tuple[int, str, str]:
        return number, hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded).hexdigest()

    def whole(table: ChunkTable, text: str) -> tuple[list[int], str]:
        ids = table.encode(text)
        return ids, table.decode(ids)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        table = chunk_table(model_path)
        texts = (text or "" for text in batch.column(1).to_pylist())
        rows = [digested(*table.spelt(text)) if digests else whole(table, text) for text in texts]
        kinds = (pa.int64(), pa.string(), pa.string()) if digests else (pa.list_(pa.int32()), pa.string())
        columns = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), *columns], names=[id_col, *(["n_tokens", "ids_sha256", "decoded_sha256"] if digests else ["ids", "decoded"])]
        )

    return over_batches(
        docs, [id_col, text_col], run,
        f"{id_col} long, " + ("n_tokens long, ids_sha256 string, decoded_sha256 string" if digests else "ids array<int>, decoded string")
    )

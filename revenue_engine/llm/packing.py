"""Packing: concatenate all documents and cut the stream into fixed windows.

Documents are tokenised once into a stored table; each task numbers its own
tokens. Two passes of prefix sums follow: totals per task, then their running
sum, give every document its offset in the whole stream. Windows of
``max_tokens`` are cut from the stream; a document across a window edge
leaves one piece in each. Only the last window can be short.

Defined results: a null text is empty and gives the end id alone; repeated
rows are packed each; an empty table gives no piece; very long texts span as
many windows as they need. Other columns are ignored.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from revenue_engine.llm.common import stored

END_ID = 0
BATCH_CHARS = 4_000_000


class ByteBpe:
    """Ids of the byte-level BPE vocabulary, without added special tokens.

    Ordinary text is encoded from the vocabulary's ranks, which gives the same
    ids as the tokenizer file and is several times faster; a text that holds
    the string of a special token is encoded by the tokenizer file itself.
    """

    def __init__(self, json_path: str, ranks_path: str, pattern: str):
        import tiktoken

        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(t): int(i) for t, i in (line.split() for line in f if line.strip())}
        self.fast = tiktoken.Encoding("packing", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.json_path, self.exact = json_path, None

    def encode(self, text: str) -> list[int]:
        if "<|" in text:
            if self.exact is None:
                from tokenizers import Tokenizer

                self.exact = Tokenizer.from_file(self.json_path)
            return self.exact.encode(text, add_special_tokens=False).ids
        return self.fast.encode_ordinary(text)


def load_tokenizer(json_path: str | None = None, ranks_path: str | None = None) -> ByteBpe:
    import public_tokenizers as P

    return ByteBpe(json_path or P.path("byte_bpe_50k.json"), ranks_path or P.path("byte_bpe_50k.tiktoken"), P.PATTERN)


def tokenized(docs: DataFrame, json_path: str | None = None, ranks_path: str | None = None) -> DataFrame:
    """Stored table (doc_id, part, at, n, ids): ids as little-endian unsigned 32-bit, ``at`` counts within the task."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        tok, part, at = load_tokenizer(json_path, ranks_path), TaskContext.get().partitionId(), 0

        def batch(rows):
            return pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int64()), pa.array([part] * len(rows), pa.int32()),
                 pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.int64()),
                 pa.array([r[3] for r in rows], pa.binary())], names=["doc_id", "part", "at", "n", "ids"])

        for b in batches:
            rows, chars = [], 0
            for doc_id, text in zip(b.column(0), b.column(1)):
                text = text.as_py() or ""
                ids = tok.encode(text)
                ids.append(END_ID)
                rows.append((doc_id.as_py(), at, len(ids), np.array(ids, dtype="<u4").tobytes()))
                at += len(ids)
                chars += len(text)
                if chars > BATCH_CHARS:
                    yield batch(rows)
                    rows, chars = [], 0
            if rows:
                yield batch(rows)

    out = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, part int, at long, n long, ids binary")
    return stored(out, "pack-ids")


def pack_pieces(docs: DataFrame, max_tokens: int = 1024, json_path: str | None = None,
                ranks_path: str | None = None) -> DataFrame:
    """One row per piece: doc_id, start, length, ids (binary), doc_tokens, sequence_id, offset."""
    ids = tokenized(docs, json_path, ranks_path)
    # One row per task of the first pass, and the sums stay as small as that.
    totals = ids.groupBy("part").agg(F.sum("n").alias("total"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    w = F.lit(max_tokens).cast("long")
    placed = ids.join(F.broadcast(base), "part").withColumn("g", F.col("base") + F.col("at"))
    pieces = F.transform(
        F.sequence(F.expr(f"g div {max_tokens}"), F.expr(f"(g + n - 1) div {max_tokens}")), _piece(w))
    return (placed.select("doc_id", F.col("n").alias("doc_tokens"), F.explode(pieces).alias("p"))
            .select("doc_id", F.col("p.start").alias("start"), F.col("p.length").alias("length"), F.col("p.ids").alias("ids"),
                    "doc_tokens", F.col("p.sequence_id").alias("sequence_id"), F.col("p.offset").alias("offset")))


def _piece(w):
    def make(s):
        start = F.greatest(s * w - F.col("g"), F.lit(0).cast("long"))
        end = F.least((s + 1) * w - F.col("g"), F.col("n"))
        return F.struct(start.alias("start"), (end - start).alias("length"),
                        F.substring(F.col("ids"), (start * 4 + 1).cast("int"), ((end - start) * 4).cast("int")).alias("ids"),
                        s.alias("sequence_id"), (F.col("g") + start - s * w).alias("offset"))
    return make

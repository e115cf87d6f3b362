"""Ranked lexical search over posting lists in geometric blocks with maximum summaries.

The index is made of shards of up to ``SHARD_DOCS`` documents, so that a term in
a third of all documents has its list spread over all shards. In a shard every
posting list is clustered on its own: some documents of the list are its
representatives, and each document joins the one most similar to it (inner
product of random projections of the weighted terms). Each cluster is a block
with a summary: for every term the largest impact any of its documents has,
rounded up to a multiple of ``UNIT``.

A query's bound for a block is its weights times the summary: no document of
the block scores more. In a shard the lists whose largest impacts together stay
below the score of the k-th best document so far are left out; of the other
lists, blocks whose bound is below that score are skipped, and the documents of
the rest are scored in full from the shard's forward index. What is skipped
cannot be among the k best, so results are exact. Tasks go on from shard to
shard with the scores they have, and their best are merged.

Impacts and scores are 64-bit integers: with n terms in the document, tf
occurrences, N documents that have terms, L terms in all and df documents that
hold the term, ``m = 50 + (50*n*N) div L``, impact ``(10^9*tf) div (1000*tf +
20*m)`` and weight ``floor(1000*ln((2N+2)/(2df+1)))``.

Queries are taken in batches of about ``BATCH_TERMS`` terms. A batch's index
holds the terms of the batch, as no other term enters a score, a bound or a
similarity that matters to it; N, L, n and df count all terms and documents.

Defined results: terms are maximal runs of 0-9, A-Z, a-z and characters beyond
ASCII, only A-Z lower-cased; null and empty texts have none and match nothing;
rows that repeat a document id are documents of their own, null ids come last
among equal scores; rows that repeat a query id and its text are one query,
other texts of an id are queries of their own; empty tables give no rows; other
columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from math import floor, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from revenue_engine.llm.common import arrow_batches, drop_stored, stored
from revenue_engine.session import scratch_path

SHARD_DOCS = 1024
BLOCK_DOCS = 128  # documents a block is aimed at
DIMENSIONS = 32  # of the projections that similarity is taken from
UNIT = 4096  # summaries are rounded up to multiples, one byte each: 4096 * 255 is above every impact
BATCH_TERMS = 60_000
PIECE = 1 << 20  # bytes of a long text handled at once
BATCH_BYTES = 8 << 20  # of texts or shards handed to a worker at once
SLICE_DOCS = 128  # documents projected at once
CELLS = 1 << 18  # summary cells filled at once

_KEEP = b"0123456789abcdefghijklmnopqrstuvwxyz" + bytes(range(128, 256))
_FOLD = bytes(c if c in _KEEP else c + 32 if 65 <= c <= 90 else 32 for c in range(256))


def term_counts(text: str | None) -> tuple[int, Counter]:
    """Number of terms of a whole text, and how often each occurs (as UTF-8)."""
    raw = (text or "").encode("utf-8", "surrogatepass").translate(_FOLD)
    n, counts, at = 0, Counter(), 0
    while at < len(raw):
        end = raw.find(b" ", at + PIECE) if at + PIECE < len(raw) else -1
        end = len(raw) if end < 0 else end
        words = raw[at:end].split()
        n += len(words)
        counts.update(words)
        at = end
    return n, counts


@dataclass(frozen=True)
class Batch:
    """Queries (id, term numbers each), and the numbers of their terms."""
    queries: list[tuple[int | None, np.ndarray]]
    vocabulary: dict[bytes, int]


@dataclass(frozen=True)
class Statistics:
    n_docs: int
    n_terms: int
    weights: np.ndarray

    def impacts(self, n, tf: np.ndarray) -> np.ndarray:
        m = 50 + (50 * np.int64(n) * self.n_docs) // self.n_terms
        return (1_000_000_000 * tf) // (1000 * tf + 20 * m)


def weight(n_docs: int, df: int) -> int:
    return floor(1000 * log((2 * n_docs + 2) / (2 * df + 1)))


# ---- one shard --------------------------------------------------------------

def _ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All positions of the ranges, one range after the other."""
    total = int(lengths.sum())
    shift = starts - (np.cumsum(lengths) - lengths)
    return np.repeat(shift, lengths) + np.arange(total)


@dataclass
class Shard:
    """Forward index (ptr, tid, imp) of documents and the blocks of their posting lists."""
    ptr: np.ndarray
    tid: np.ndarray
    imp: np.ndarray
    block_term: np.ndarray
    block_ptr: np.ndarray
    block_doc: np.ndarray
    sum_ptr: np.ndarray
    sum_tid: np.ndarray
    sum_max: np.ndarray  # in units, rounded up


def stored_as(size: int) -> dict[str, str]:
    """How the arrays of a shard are stored, for ``size`` terms."""
    return {"ptr": "<i4", "tid": "<i4", "imp": "<i4", "block_term": "<i4", "block_ptr": "<i4", "block_doc": "<i4",
            "sum_ptr": "<i4", "sum_tid": "<u2" if size <= 1 << 16 else "<i4", "sum_max": "u1"}


def packed(shard: Shard, size: int) -> tuple[list[int], bytes]:
    """Lengths of the arrays in bytes, and the arrays, compressed: a row of the index stays small outside the task that uses it."""
    arrays = [getattr(shard, f).astype(kind).tobytes() for f, kind in stored_as(size).items()]
    return [len(a) for a in arrays], pa.compress(b"".join(arrays), "zstd", asbytes=True)


def unpacked(lengths: list[int], raw, size: int) -> Shard:
    data, at, arrays = pa.decompress(raw, sum(lengths), "zstd"), 0, {}
    for n, (f, kind) in zip(lengths, stored_as(size).items()):
        arrays[f] = np.frombuffer(data[at:at + n], kind)
        at += n
    return Shard(**arrays)


def _clustered(docs: np.ndarray, sketch: np.ndarray) -> list[np.ndarray]:
    """The blocks of one posting list."""
    if len(docs) <= BLOCK_DOCS:
        return [docs]
    n = -(-len(docs) // BLOCK_DOCS)
    heads = docs[(np.arange(n) * len(docs)) // n]
    cell = (sketch[docs] @ sketch[heads].T).argmax(axis=1)
    order = np.argsort(cell, kind="stable")
    return [x for x in np.split(docs[order], np.flatnonzero(np.diff(cell[order])) + 1) if len(x)]


def build_shard(ptr: np.ndarray, tid: np.ndarray, imp: np.ndarray, weights: np.ndarray) -> Shard:
    """Cluster the posting list of every term and summarise its blocks."""
    n_docs, size = len(ptr) - 1, len(weights)
    turn = np.random.default_rng(7).choice(np.array([-1, 1], np.float32), (size, DIMENSIONS))
    sketch = np.empty((n_docs, DIMENSIONS), np.float32)
    for a in range(0, n_docs, SLICE_DOCS):
        z = min(a + SLICE_DOCS, n_docs)
        own = slice(ptr[a], ptr[z])
        size_of = (weights[tid[own]] * imp[own]).astype(np.float32)
        sketch[a:z] = np.add.reduceat(turn[tid[own]] * size_of[:, None], ptr[a:z] - ptr[a], axis=0)
    sketch /= np.maximum(np.linalg.norm(sketch, axis=1, keepdims=True), 1e-30)
    doc = np.repeat(np.arange(n_docs), np.diff(ptr))
    order = np.argsort(tid, kind="stable")
    lists = np.split(doc[order], np.flatnonzero(np.diff(tid[order])) + 1)
    terms, blocks = [], []
    for t, docs in zip(np.unique(tid).tolist(), lists):
        for b in _clustered(docs, sketch):
            terms.append(t)
            blocks.append(b)
    counts = np.array([len(b) for b in blocks])
    block_ptr, members = np.concatenate([[0], np.cumsum(counts)]), np.concatenate(blocks)
    wide = np.diff(ptr)[members]
    at_once = max(1, CELLS // size)
    sum_ptr, sum_tid, sum_max = [0], [], []
    for a in range(0, len(blocks), at_once):
        z = min(a + at_once, len(blocks))
        m = slice(block_ptr[a], block_ptr[z])
        rows, widths = members[m], wide[m]
        at = _ranges(ptr[rows], widths)
        cell = np.repeat(np.repeat(np.arange(z - a) * size, counts[a:z]), widths)
        cell += tid[at]
        top = np.zeros((z - a) * size, np.int32)
        np.maximum.at(top, cell, imp[at])
        hit = np.flatnonzero(top)
        sum_tid.append((hit % size).astype(np.int32))
        sum_max.append((-(-top[hit] // UNIT)).astype(np.uint8))
        sum_ptr.append(np.bincount(hit // size, minlength=z - a))
    ends = np.cumsum(np.concatenate(sum_ptr[1:]))
    return Shard(ptr, tid, imp, np.array(terms), block_ptr, members, np.concatenate([[0], ends]), np.concatenate(sum_tid), np.concatenate(sum_max))


@dataclass
class Best:
    """The k best documents of a query so far."""
    k: int
    scores: np.ndarray
    docs: np.ndarray

    @staticmethod
    def none(k: int) -> Best:
        return Best(k, np.zeros(0, np.int64), np.zeros((0, 2), np.int64))

    @property
    def least(self) -> int:
        """No document of a smaller score can be among the k best."""
        return int(self.scores[-1]) if len(self.scores) == self.k else 1

    def add(self, scores: np.ndarray, docs: np.ndarray) -> None:
        ok = scores >= self.least
        scores, docs = np.concatenate([self.scores, scores[ok]]), np.concatenate([self.docs, docs[ok]])
        order = np.lexsort((docs[:, 1], docs[:, 0], -scores))[:self.k]
        self.scores, self.docs = scores[order], docs[order]


class Searcher:
    """A loaded shard."""

    def __init__(self, shard: Shard, docs: np.ndarray, weights: np.ndarray):
        self.s, self.docs, self.weights = shard, docs, weights
        n = len(weights)
        self.first = np.searchsorted(shard.block_term, np.arange(n + 1))
        self.most = np.zeros(n, np.int64)  # largest impact of a term in this shard
        np.maximum.at(self.most, shard.tid, shard.imp)
        self.own = np.zeros(n, np.int64)  # weights of the query at hand, zero elsewhere
        self.evaluated = self.blocks = 0

    def search(self, terms: np.ndarray, best: Best) -> None:
        s, own = self.s, self.own
        own[terms] = self.weights[terms]
        reach = own[terms] * self.most[terms]
        order = np.argsort(reach, kind="stable")
        lists = terms[order[np.cumsum(reach[order]) >= best.least]]  # those before, all together, stay below the least
        count = self.first[lists + 1] - self.first[lists]
        blocks = _ranges(self.first[lists], count)
        self.blocks += int((self.first[terms + 1] - self.first[terms]).sum())
        if len(blocks):
            size = s.sum_ptr[blocks + 1] - s.sum_ptr[blocks]
            at = _ranges(s.sum_ptr[blocks], size)
            bound = np.add.reduceat(own[s.sum_tid[at]] * s.sum_max[at], np.cumsum(size) - size) * UNIT
            seen = np.zeros(len(s.ptr) - 1, bool)
            order, step = np.argsort(-bound, kind="stable"), 2
            blocks, bound = blocks[order], bound[order]
            while len(blocks) and bound[0] >= best.least:
                some = blocks[:step][bound[:step] >= best.least]
                self.evaluated += len(some)
                docs = s.block_doc[_ranges(s.block_ptr[some], s.block_ptr[some + 1] - s.block_ptr[some])]
                docs = np.unique(docs[~seen[docs]])
                if len(docs):
                    seen[docs] = True
                    wide = s.ptr[docs + 1] - s.ptr[docs]
                    at = _ranges(s.ptr[docs], wide)
                    best.add(np.add.reduceat(own[s.tid[at]] * s.imp[at], np.cumsum(wide) - wide), self.docs[docs])
                blocks, bound, step = blocks[step:], bound[step:], step * 2
        own[terms] = 0


# ---- jobs -------------------------------------------------------------------

def forward_index(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """Stored (doc_id, n, tids, tfs) of every document that has terms; only terms of the vocabulary are listed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, ns, tids, tfs = [], [], [], []
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1)):
                n, counts = term_counts(text.as_py())
                if n:
                    own = sorted((vocabulary[t], counts[t]) for t in counts.keys() & vocabulary.keys())
                    ids.append(doc_id)
                    ns.append(n)
                    tids.append(np.array([x[0] for x in own], "<i4").tobytes())
                    tfs.append(np.array([x[1] for x in own], "<i4").tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(ns, pa.int64()), pa.array(tids, pa.binary()),
                                              pa.array(tfs, pa.binary())], names=["doc_id", "n", "tids", "tfs"])

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, n long, tids binary, tfs binary")
    return stored(rows, "search-forward")


def statistics(forward: DataFrame, size: int) -> Statistics:
    """Counts over all documents, and the weight of every term of the vocabulary."""
    total = forward.agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("terms")).first()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(size, np.int64)
        for b in batches:
            for raw in b.column(0):
                n[np.frombuffer(raw.as_buffer(), "<i4")] += 1
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(n[at])], names=["t", "n"])

    weights = np.zeros(size, np.int64)
    for r in forward.select("tids").mapInArrow(run, "t long, n long").groupBy("t").agg(F.sum("n").alias("n")).collect():
        weights[r["t"]] = weight(total["docs"], r["n"])
    return Statistics(total["docs"], total["terms"] or 1, weights)


def build_index(forward: DataFrame, stats: Statistics) -> DataFrame:
    """Stored shards, one a row: document ids and the packed arrays of ``Shard``."""
    size = len(stats.weights)

    def made(rows: list[tuple]) -> pa.RecordBatch:
        tids = [np.frombuffer(r[2], "<i4") for r in rows]
        tf = np.concatenate([np.frombuffer(r[3], "<i4") for r in rows]).astype(np.int64)
        ptr = np.concatenate([[0], np.cumsum([len(t) for t in tids])])
        n = np.repeat(np.array([r[1] for r in rows], np.int64), np.diff(ptr))
        shard = build_shard(ptr, np.concatenate(tids), stats.impacts(n, tf).astype(np.int32), stats.weights)
        lengths, raw = packed(shard, size)
        return pa.RecordBatch.from_arrays([pa.array([[r[0] for r in rows]], pa.list_(pa.int64())), pa.array([lengths], pa.list_(pa.int64())),
                                           pa.array([raw], pa.binary())], names=["docs", "lengths", "arrays"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for b in batches:
            for r in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), b.column(3).to_pylist()):
                rows.append(r)
                if len(rows) == SHARD_DOCS:
                    yield made(rows)
                    rows = []
        if rows:
            yield made(rows)

    shards = forward.where(F.octet_length("tids") > 0).mapInArrow(run, "docs array<long>, lengths array<long>, arrays binary")
    path = scratch_path(forward.sparkSession, "search-shards")
    # A row is a whole shard: row groups of one or a few keep what a reader holds at once small.
    (shards.write.option("compression", "none").option("parquet.block.size", 8 << 20)
     .option("parquet.page.size.row.check.min", 1).option("parquet.page.size.row.check.max", 1)
     .option("parquet.block.row.count.limit", 2).parquet(path))
    out = forward.sparkSession.read.schema(shards.schema).parquet(path)
    out._stored_path = path
    return out


def search_index(index: DataFrame, batch: Batch, weights: np.ndarray, k: int) -> DataFrame:
    """(query, doc_id, score): at least the k best documents of every query of the batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best.none(k) for _ in batch.queries]
        for b in batches:
            for row in range(b.num_rows):
                ids = b.column(0)[row].as_py()
                docs = np.array([(d is None, d or 0) for d in ids], np.int64)
                shard = Searcher(unpacked(b.column(1)[row].as_py(), b.column(2)[row].as_buffer(), len(weights)), docs, weights)
                for (_, terms), found in zip(batch.queries, best):
                    shard.search(terms, found)
        q = np.repeat(np.arange(len(best)), [len(f.scores) for f in best])
        docs = np.concatenate([f.docs for f in best])
        yield pa.RecordBatch.from_arrays(
            [pa.array(q, pa.int32()), pa.array(docs[:, 1], mask=docs[:, 0] > 0), pa.array(np.concatenate([f.scores for f in best]))],
            names=["query", "doc_id", "score"])

    return index.mapInArrow(run, "query int, doc_id long, score long")


def query_batches(queries: DataFrame, id_col: str, text_col: str) -> Iterator[Batch]:
    """Batches of queries of about ``BATCH_TERMS`` terms each, by hash; one batch at a time is on the driver."""
    rows = (queries.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
            .where("text is not null").distinct())
    size = rows.agg(F.sum(F.regexp_count("text", F.lit(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")))).first()[0] or 0
    n = -(-size // BATCH_TERMS)
    for i in range(n):
        part = rows.where(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == i).orderBy("id", "text").collect()
        terms = [(r["id"], sorted(term_counts(r["text"])[1])) for r in part]
        vocabulary = {t: j for j, t in enumerate(sorted({t for _, own in terms for t in own}))}
        got = [(q, np.array([vocabulary[t] for t in own], np.int64)) for q, own in terms if own]
        if got:
            yield Batch(got, vocabulary)


def top_documents(docs: DataFrame, queries: DataFrame, k: int = 50, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(id, rank, doc_id, score): the k best documents with a score above 0 of every query, ties to smaller doc_id."""
    spark, out = docs.sparkSession, []
    with arrow_batches(spark, BATCH_BYTES):
        for batch in query_batches(queries, id_col, text_col):
            forward = forward_index(docs, batch.vocabulary)
            stats = statistics(forward, len(batch.vocabulary))
            index = build_index(forward, stats)
            drop_stored(forward)
            found = search_index(index, batch, stats.weights, k)
            order = Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
            ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            ids = F.array(*[F.lit(q).cast("long") for q, _ in batch.queries])
            out.append(stored(ranked.select(F.get(ids, F.col("query")).alias("id"), "rank", "doc_id", "score"), "search-found"))
            drop_stored(index)
    if not out:
        return spark.createDataFrame([], "id long, rank int, doc_id long, score long")
    while len(out) > 1:
        out = [a.unionByName(b) for a, b in zip(out[::2], out[1::2])] + out[len(out) // 2 * 2:]
    return out[0]

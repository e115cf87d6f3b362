"""Repeated byte strings, removed by blockwise suffix sorting over a cover sample.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts earlier
(smaller doc_id and text hash, or earlier in the same document). Only the first ``LENGTH``
bytes of a suffix matter, so suffixes are sorted to that depth:

1. Cover sample. In every stretch of ``LENGTH`` bytes the position of its
   smallest ``GRAM``-byte name (by its upper half, the leftmost of equals) is sampled. Like a difference cover, the sample
   meets any two equal strings at the same offset; being chosen by content, it
   is a quarter as dense as a cover by residues. Each sampled position owns
   the suffixes that chose it.
2. Names that occur once are dropped: their suffixes repeat nowhere.
3. Places are carried as positions and fingerprints, no bytes. Places with the
   same surroundings are one class with its first place; the rest of the
   class is removed outright. Every suffix holds the name with the ``HALF``
   bytes before it, or with more than those after it, so a class that shares
   neither with another class repeats nowhere and leaves.
4. Suffix buckets. What is left gets its bytes, from another reading of the
   texts, and is bucketed by name. A bucket is sorted on its own: the names
   resolve the long common part of its suffixes, and fingerprints of the
   ``LENGTH`` bytes order the rest; of equal ones only the first stays.

Buckets with more than ``BUCKET_ROWS`` classes are spread by suffix instead of
by name, so no task holds an unbounded bucket. Equality of strings rests on
two 64-bit fingerprints and the offset, a chance of error below 1e-18 a pair.

Defined results: matches never cross documents; a null text is empty; texts
shorter than ``LENGTH`` are kept whole; rows that repeat an id and its text are
one document and get equal results, other texts of the id, or of none, are
documents of their own; null ids come last; an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revenue_engine.llm.common import drop_stored, stored

LENGTH = 100
GRAM = 24
HALF = (LENGTH - GRAM) // 2
BUCKET_ROWS = 20_000
BUCKETS_AT_ONCE = 2_000  # classes sorted in one call
LAST = (1 << 63) - 1

_rng = np.random.default_rng(20240607)
_BYTES = _rng.integers(0, 1 << 64, (2, 256), dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_MIX = np.uint64(0xBF58476D1CE4E5B9)


class _Powers:
    """Powers of the base and of its inverse modulo 2^64, as long as a text needs."""

    def __init__(self):
        self.up, self.down = np.ones(1, np.uint64), np.ones(1, np.uint64)

    def upto(self, n: int):
        if len(self.up) < n:
            size = max(n, 2 * len(self.up), 1 << 16)
            up, down = np.full(size, _BASE, np.uint64), np.full(size, _INVERSE, np.uint64)
            up[0] = down[0] = 1
            self.up, self.down = np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)
        return self.up[:n], self.down[:n]


def _names(raw: np.ndarray, width: int, powers: _Powers, which: int = 0) -> np.ndarray:
    """Fingerprint of every ``width`` bytes."""
    n = len(raw)
    up, down = powers.upto(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTES[which][raw] * up[:n], out=sums[1:], dtype=np.uint64)
    out = (sums[width:] - sums[:-width]) * down[:n - width + 1]
    out ^= out >> np.uint64(31)
    out *= _MIX
    out ^= out >> np.uint64(29)
    return out


def _owners(names: np.ndarray, width: int) -> np.ndarray:
    """For every window of ``width`` names the position of its smallest by the upper half, the leftmost of equals."""
    low, span = (names >> np.uint64(32) << np.uint64(32)) | np.arange(len(names), dtype=np.uint64), 1
    while span < width:
        step = min(span, width - span)
        low = np.minimum(low[:-step], low[step:])
        span += step
    return (low & np.uint64(0xFFFFFFFF)).astype(np.int64)


def cover_sample(raw: np.ndarray, powers: _Powers) -> tuple[np.ndarray, ...]:
    """(name, position, first and last owned start) of every sampled position."""
    if len(raw) < LENGTH:
        return (np.zeros(0, np.uint64),) + (np.zeros(0, np.int64),) * 3
    names = _names(raw, GRAM, powers)
    own = _owners(names, LENGTH - GRAM + 1)
    lo = np.flatnonzero(np.diff(own, prepend=-1))
    hi = np.append(lo[1:], len(own)) - 1
    return names[own[lo]], own[lo], lo, hi


def _packed(pos: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """A place of a text as one number, in order of ``lo``."""
    return lo << 16 | (pos - lo) << 8 | (hi - lo)


def _place(at: np.ndarray) -> tuple[np.ndarray, ...]:
    """(pos, lo, hi) of packed places."""
    lo = at >> 16
    return lo + (at >> 8 & 255), lo, lo + (at & 255)


def _raw(text) -> np.ndarray:
    return np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)


def _key(docs: DataFrame):
    """``id`` and ``rk``, the key of a document: doc_id, which gives the order, and a hash of the text."""
    return (F.coalesce(docs["doc_id"].cast("long"), F.lit(LAST)).alias("id"),
            F.xxhash64(F.coalesce(docs["text"].cast("string"), F.lit(""))).alias("rk"))


def _text(docs: DataFrame):
    return F.coalesce(docs["text"].cast("string"), F.lit("")).alias("text")


def _sampled(docs: DataFrame) -> DataFrame:
    """Stored (id, rk, at) of the sampled positions whose name occurs more than once."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        powers = _Powers()
        for b in batches:
            got = [((i, k), *cover_sample(_raw(t), powers)) for i, k, t in zip(b["id"], b["rk"], b["text"])]
            for a in range(0, len(got), 500):
                part = [g for g in got[a:a + 500] if len(g[1])]
                if part:
                    yield pd.DataFrame({"name": np.concatenate([g[1] for g in part]).view(np.int64),
                                        "id": np.repeat([g[0][0] for g in part], [len(g[1]) for g in part]),
                                        "rk": np.repeat([g[0][1] for g in part], [len(g[1]) for g in part]),
                                        "at": np.concatenate([_packed(*g[2:]) for g in part])})

    sample = stored(docs.select(*_key(docs), _text(docs)).mapInPandas(run, "name long, id long, rk long, at long"), "suffix-sample")
    twice = sample.groupBy("name").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("name")
    out = stored(sample.join(twice, "name").select("id", "rk", "at"), "suffix-repeated")
    drop_stored(sample)
    return out


def _with_texts(docs: DataFrame, places: DataFrame) -> DataFrame:
    """(id, rk, text, spots: array<long>): every text that has places, with them."""
    spots = places.groupBy("id", "rk").agg(F.collect_list("at").alias("spots"))
    texts = docs.select(*_key(docs), _text(docs)).dropDuplicates(["id", "rk"])
    return texts.join(spots, ["id", "rk"])


def _prints(sums: np.ndarray, down: np.ndarray, first: np.ndarray, end: np.ndarray, salt: np.ndarray) -> np.ndarray:
    """Fingerprint of the bytes of each range ``first`` to ``end``, and of ``salt``."""
    out = (sums[end] - sums[first]) * down[first]
    out ^= (salt + np.uint64(1)) * _MIX
    out ^= out >> np.uint64(31)
    out *= _MIX
    return out ^ (out >> np.uint64(29))


def _surroundings(docs: DataFrame, sample: DataFrame) -> DataFrame:
    """Stored (id, rk, at, c1, c2, left, right): the sampled places with fingerprints of all bytes of the suffixes they own.

    ``left`` and ``right`` are those of the bytes around the sampled name that every suffix starting
    ``HALF`` bytes or more before it holds, or every other one.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        powers = _Powers()
        for b in batches:
            parts = []
            for i, k, t, spots in zip(b["id"], b["rk"], b["text"], b["spots"]):
                raw, at = _raw(t), np.asarray(spots, np.int64)
                pos, lo, hi = _place(at)
                up, down = powers.upto(len(raw) + 1)
                sums = np.zeros((2, len(raw) + 1), np.uint64)
                for w in (0, 1):
                    np.cumsum(_BYTES[w][raw] * up[:len(raw)], out=sums[w, 1:], dtype=np.uint64)
                # Ranges of one length and offset have equal shape bits, others differ in them.
                shape = (at & 0xFFFF).astype(np.uint64)
                parts.append((np.full(len(at), i, np.int64), np.full(len(at), k, np.int64), at,
                              _prints(sums[0], down, lo, hi + LENGTH, shape), _prints(sums[1], down, lo, hi + LENGTH, shape),
                              _prints(sums[0], down, np.maximum(pos - HALF, 0), pos + GRAM, _LEFT),
                              _prints(sums[0], down, pos, np.minimum(pos + LENGTH - HALF + 1, len(raw)), _RIGHT)))
            if parts:
                cols = [np.concatenate(x) for x in zip(*parts)]
                yield pd.DataFrame(dict(zip(_SPOT, cols[:3] + [c.view(np.int64) for c in cols[3:]])))

    out = stored(_with_texts(docs, sample).mapInPandas(run, ", ".join(f"{c} long" for c in _SPOT)), "suffix-places")
    drop_stored(sample)
    return out


_LEFT, _RIGHT = np.array([1 << 20], np.uint64), np.array([1 << 21], np.uint64)
_SPOT = ["id", "rk", "at", "c1", "c2", "left", "right"]


def _meeting(classes: DataFrame) -> DataFrame:
    """(id, rk, at) of the classes that may share a suffix with another class: equal bytes on one side of the name."""
    before, span = F.shiftright("at", 8).bitwiseAND(F.lit(255)), F.col("at").bitwiseAND(F.lit(255))
    sides = F.array(F.when(before >= HALF, F.col("left")), F.when(before - span < HALF, F.col("right")))
    keys = classes.select("id", "rk", "at", F.explode(F.array_compact(sides)).alias("side"))
    shared = keys.groupBy("side").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("side")
    return keys.join(shared, "side", "left_semi").select("id", "rk", "at").distinct()


def _contents(docs: DataFrame, places: DataFrame) -> DataFrame:
    """(name, id, rk, at, bytes): the places with their names and all bytes of the suffixes they own."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        powers = _Powers()
        for b in batches:
            rows = []
            for i, k, t, spots in zip(b["id"], b["rk"], b["text"], b["spots"]):
                raw, at = _raw(t), np.asarray(spots, np.int64)
                pos, lo, hi = _place(at)
                names, whole = _names(raw, GRAM, powers)[pos].view(np.int64), raw.tobytes()
                rows += [(n, i, k, a, whole[x:y]) for n, a, x, y in zip(names.tolist(), at.tolist(), lo.tolist(), (hi + LENGTH).tolist())]
                if len(rows) > 20_000:
                    yield pd.DataFrame(rows, columns=_CONTENT)
                    rows = []
            if rows:
                yield pd.DataFrame(rows, columns=_CONTENT)

    return _with_texts(docs, places).mapInPandas(run, "name long, id long, rk long, at long, bytes binary")


_CONTENT = ["name", "id", "rk", "at", "bytes"]


def _suffixes(b: pd.DataFrame) -> tuple[np.ndarray, ...]:
    """All suffixes of the classes: row, start, and their sort key (name, offset from the sampled place, fingerprints)."""
    lens = np.array([len(x) for x in b["bytes"]])
    first = np.concatenate([[0], np.cumsum(lens)])
    raw = np.frombuffer(b"".join(b["bytes"]), np.uint8)
    powers = _Powers()
    count = lens - LENGTH + 1
    row = np.repeat(np.arange(len(b)), count)
    within = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    at = first[row] + within
    pos, lo, _ = _place(b["at"].to_numpy(np.int64))
    offset = lo[row] + within - pos[row]
    return (row, lo[row] + within, b["name"].to_numpy()[row], offset,
            _names(raw, LENGTH, powers, 0)[at], _names(raw, LENGTH, powers, 1)[at])


def _later(b: pd.DataFrame) -> pd.DataFrame:
    """Runs of suffix starts (id, rk, lo, hi) that are not the first of their equals, in a block of whole buckets."""
    row, start, name, offset, f0, f1 = _suffixes(b)
    ids, rks = b["id"].to_numpy()[row], b["rk"].to_numpy()[row]
    order = np.lexsort((start, rks, ids, f1, f0, offset, name))
    same = np.ones(len(order), bool)
    for x in (name, offset, f0, f1):
        s = x[order]
        same[1:] &= s[1:] == s[:-1]
    same[:1] = False
    # Equal suffixes of one document place and another row are the same place; the first place stays.
    out = order[same]
    return _runs(ids[out], rks[out], start[out])


def _runs(ids: np.ndarray, rks: np.ndarray, start: np.ndarray) -> pd.DataFrame:
    order = np.lexsort((start, rks, ids))
    ids, rks, start = ids[order], rks[order], start[order]
    new = np.ones(len(ids), bool)
    new[1:] = (ids[1:] != ids[:-1]) | (rks[1:] != rks[:-1]) | (start[1:] > start[:-1] + 1)
    at = np.flatnonzero(new)
    end = np.append(at[1:], len(ids)) - 1 if len(at) else at
    return pd.DataFrame({"id": ids[at].astype(np.int64), "rk": rks[at].astype(np.int64), "lo": start[at].astype(np.int64),
                         "hi": start[end].astype(np.int64)})


def later_starts(docs: DataFrame) -> DataFrame:
    """Stored (id, rk, lo, hi): runs of starts of ``LENGTH``-byte strings that also start earlier."""
    places = _surroundings(docs, _sampled(docs))
    # ``at`` orders the places of a text by their first start.
    classes = stored(places.groupBy("c1", "c2").agg(F.min(F.struct("id", "rk", "at")).alias("place"), F.min("left").alias("left"),
                                                    F.min("right").alias("right"))
                     .select("c1", "c2", "left", "right", "place.*"), "suffix-classes")
    lo = F.shiftright("at", 16)
    copies = stored(places.select("id", "rk", "at", "c1", "c2")
                    .join(classes.select("c1", "c2", F.struct("id", "rk", "at").alias("head")), ["c1", "c2"])
                    .where(F.struct("id", "rk", "at") != F.col("head"))
                    .select("id", "rk", lo.alias("lo"), (lo + F.col("at").bitwiseAND(F.lit(255))).alias("hi")), "suffix-copies")
    drop_stored(places)
    meeting = stored(_meeting(classes), "suffix-meeting")
    drop_stored(classes)
    met = stored(_contents(docs, meeting), "suffix-met")
    drop_stored(meeting)
    sizes = met.groupBy("name").agg(F.count(F.lit(1)).alias("rows"))
    large = stored(sizes.where(F.col("rows") > BUCKET_ROWS).select("name"), "suffix-large")
    total = met.count()
    blocks = max(1, -(-total // BUCKETS_AT_ONCE))
    small = met.join(large, "name", "left_anti")
    sorted_ = (small.withColumn("block", F.pmod(F.xxhash64("name"), F.lit(blocks)))
               .groupBy("block").applyInPandas(lambda b: _later(b), "id long, rk long, lo long, hi long"))
    if not large.isEmpty():
        sorted_ = sorted_.unionByName(_spread(met.join(large, "name", "left_semi")))
    out = stored(copies.unionByName(sorted_), "suffix-runs")
    for t in (copies, met, large):
        drop_stored(t)
    return out


def _spread(classes: DataFrame) -> DataFrame:
    """The same for large buckets, by a grouped minimum over their suffixes."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for a in range(0, len(b), BUCKETS_AT_ONCE):
                part = b.iloc[a:a + BUCKETS_AT_ONCE]
                row, start, name, offset, f0, f1 = _suffixes(part)
                yield pd.DataFrame({"name": name, "off": offset, "f0": f0.view(np.int64), "f1": f1.view(np.int64),
                                    "id": part["id"].to_numpy()[row], "rk": part["rk"].to_numpy()[row], "start": start})

    key = ["name", "off", "f0", "f1"]
    each = stored(classes.select("name", "id", "rk", "at", "bytes").mapInPandas(
        run, "name long, off long, f0 long, f1 long, id long, rk long, start long"), "suffix-spread")
    heads = each.groupBy(*key).agg(F.min(F.struct("id", "rk", "start")).alias("head"))
    return (each.join(heads, key).where(F.struct("id", "rk", "start") != F.col("head"))
            .select("id", "rk", F.col("start").alias("lo"), F.col("start").alias("hi")))


def without_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, kept: binary, n_bytes, n_removed, n_spans) for every row of ``docs``."""
    runs = (later_starts(docs).groupBy("id", "rk").agg(F.collect_list(F.struct("lo", "hi")).alias("runs"))
            .select("id", "rk", F.col("runs.lo").alias("lo"), F.col("runs.hi").alias("hi")))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for i, t, lo, hi in zip(b["doc_id"], b["text"], b["lo"], b["hi"]):
                raw = _raw(t)
                edge = np.zeros(len(raw) + 1, np.int32)
                if lo is not None:
                    np.add.at(edge, np.asarray(lo, np.int64), 1)
                    np.add.at(edge, np.asarray(hi, np.int64) + LENGTH, -1)
                gone = np.cumsum(edge[:-1]) > 0
                spans = int(np.count_nonzero(gone[1:] & ~gone[:-1])) + int(gone[:1].any())
                rows.append((i, raw[~gone].tobytes(), len(raw), int(gone.sum()), spans))
            yield pd.DataFrame(rows, columns=["doc_id", "kept", "n_bytes", "n_removed", "n_spans"]).astype({"doc_id": "Int64"})

    texts = docs.select(docs["doc_id"].cast("long").alias("doc_id"), *_key(docs), _text(docs))
    return texts.join(runs, ["id", "rk"], "left").select("doc_id", "text", "lo", "hi").mapInPandas(
        run, "doc_id long, kept binary, n_bytes long, n_removed long, n_spans long")

"""Approximate nearest neighbours: a neighbour graph by NN-descent, searched greedily.

Vectors get one more coordinate, ``sqrt(M^2 - |x|^2)``, so that the largest
inner product is the nearest point. Equal vectors are one node with its
members. The graph starts from neighbours inside groups around pivots; then
rounds of joins compare neighbours of neighbours: each node's neighbours and a
hashed choice of the nodes that link to it are compared with one another, and
what beats a node's worst link replaces it. A pair of which neither came with
the last round was compared before and is left out. Rounds end when few links
change. A query walks the graph from its own node and a few entry nodes: it
expands every unexpanded node of its beam, scores their links on the original
vectors, and stops when the beam holds no new node.

Nodes of near pivots make a block, at most about ``BLOCK``, and a node's code is
its block and its place in it. Blocks are rows of packed arrays and send
each other such rows, so that the tables have a row for two blocks that meet
and not one for each link. A block fetches a vector once a round; a search sends
the queries to the vectors and gets scores, and a block fetches the links of a
node that came into its queries' beams once.

Pivots are a sample of at most ``PIVOTS`` vectors by a hash of the id; every
row is in the graph. Nodes around a pivot are split evenly by hash, so that no
block and no group outgrows a task; reverse links of a hub are chosen by hash,
which bounds its list.

Defined results: see ``clean_vectors``; of equal vectors the smaller ids come
first; fewer than k candidates are all that is returned; an empty table gives
none.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from revenue_engine.llm.common import drop_stored, stored
from revenue_engine.llm.vectors import padded

PIVOTS = 1024
CELL = 1024        # nodes a pivot, about, while there are enough pivots
BLOCK = 4096       # most nodes of a block, about; fewer in a small table, so that tasks have some each
GROUP = 4096       # nodes compared at once at the start
NEAR = 3           # pivots in whose groups a node is compared at the start
LINKS = 48         # links of a node
TURNED = 24        # reverse links of a node that a round compares
ROUNDS = 12
SETTLED = 0.004    # share of changed links that ends the rounds
BEAM = 64
ENTRIES = 8        # nodes every query starts from besides its own
PAIRS = 1 << 20    # pairs that are held before the best of them are chosen

# A code is block << PLACE | place in the block; a key of two such numbers keeps the code below KEY bits.
PLACE, KEY = 20, 44
# Kinds of rows that blocks send: what a block holds itself, and what others ask or tell it.
OWN, OFFER, TURN, WANT, VECTORS, QUERIES, EXPANDED, ASK, REPLY = range(9)
FRESH = 1 << 62    # marks a code of a beam that is not expanded
_ROW = ["dst", "kind", "src", "a", "b", "c", "d"]
_ROWS = "dst long, kind int, src long, a binary, b binary, c binary, d binary"


def _lifted(v: np.ndarray, m2: float) -> np.ndarray:
    extra = np.sqrt(np.maximum(0.0, m2 - (v * v).sum(axis=1)))
    return np.hstack([v, extra[:, None]])


def _frame(rows: list) -> pd.DataFrame:
    """Rows for other blocks; missing arrays are null."""
    return pd.DataFrame([(*r, *[None] * (len(_ROW) - len(r))) for r in rows], columns=_ROW, dtype=None if rows else object)


def _array(values, dtype) -> np.ndarray:
    """The packed arrays of some rows as one."""
    return np.frombuffer(b"".join(values), dtype)


def _hashed(codes: np.ndarray) -> np.ndarray:
    x = codes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(34)


def _cut(sorted_keys: np.ndarray) -> Iterator[tuple[int, int]]:
    """Start and end of each run of equal keys."""
    heads = np.flatnonzero(np.diff(sorted_keys, prepend=sorted_keys[:1] - 1))
    return zip(heads.tolist(), np.append(heads[1:], len(sorted_keys)).tolist())


def _sent(kind: int, src: int, blocks: np.ndarray, *arrays: np.ndarray) -> list:
    """One row for each block of ``blocks``, with its part of the arrays."""
    order = np.argsort(blocks, kind="stable")
    to = blocks[order]
    return [(int(to[x]), kind, src, *[a[order[x:y]].tobytes() for a in arrays]) for x, y in _cut(to)]


def _ranks(sorted_keys: np.ndarray) -> np.ndarray:
    """Place of each entry in its run of equal keys."""
    new = np.diff(sorted_keys, prepend=sorted_keys[:1] - 1) != 0
    at = np.arange(len(sorted_keys))
    return at - np.maximum.accumulate(np.where(new, at, 0))


def _best(at: np.ndarray, codes: np.ndarray, sims: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k largest of each ``at``, in order; ties to smaller codes."""
    order = np.lexsort((codes, -sims, at))
    return order[_ranks(at[order]) < k]


def _first_of_each(at: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Positions of the first entry of each (at, code), in their order."""
    key = (at.astype(np.int64) << KEY) | codes
    return np.unique(key, return_index=True)[1]


def _meet(rows: DataFrame, blocks: int, work: Callable) -> DataFrame:
    """``work(block, rows)`` of every block that rows are for."""
    # A few blocks a task, whatever the number of partitions is.
    parts = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-blocks // 4))
    return rows.repartition(parts, "dst").groupBy("dst").applyInPandas(lambda key, p: work(int(key[0]), p), _ROWS)


def _each(blocks: DataFrame, make: Callable) -> DataFrame:
    """The rows that ``make(row)`` gives for every row."""
    def run(batches):
        for b in batches:
            for r in b.itertuples(index=False):
                yield _frame(make(r))
    return blocks.mapInPandas(run, _ROWS)


def build_graph(vectors: DataFrame, dim: int, m2: float) -> tuple[DataFrame, DataFrame, int, list[int]]:
    """Stored blocks (blk, ids, v, w, near), stored links as ``OWN`` rows, the number of blocks, and entry nodes.

    ``v``: packed 32-bit with the added coordinate; ``w``: the packed original; a block's nodes are in order of ids.
    """
    spark = vectors.sparkSession
    n = vectors.count()
    few = max(1, min(PIVOTS, -(-n // CELL)))
    picked = vectors.orderBy(F.xxhash64("node"), "node").limit(max(few, ENTRIES)).collect()
    centres = _lifted(padded([r["v"] for r in picked[:few]], dim), m2)
    near = min(NEAR, few)

    def near_pivots(batches):
        for b in batches:
            w = padded(b["v"], dim)
            v = _lifted(w, m2)
            p = np.argsort(-(v @ centres.T), axis=1, kind="stable")[:, :near]
            yield pd.DataFrame({"node": b["node"], "p": p[:, 0], "near": p.tolist(), "v": [x.tobytes() for x in v.astype("<f4")],
                                "w": [x.tobytes() for x in w]})

    placed = stored(vectors.select("node", "v").mapInPandas(
        near_pivots, "node long, p long, near array<int>, v binary, w binary"), "ann-placed")

    def counted(pivots):
        out = np.zeros(few, np.int64)
        for r in pivots.groupBy("p").agg(F.count(F.lit(1)).alias("n")).collect():  # one row a pivot
            out[r["p"]] = r["n"]
        return out

    cell_parts = -(-counted(placed.select(F.explode("near").alias("p"))) // GROUP)
    cells = np.cumsum(cell_parts) - cell_parts
    homes, n_blocks = _homes(counted(placed.select("p")), centres, min(BLOCK, max(CELL, n // 64)))
    table = spark.createDataFrame(homes, "p long, start long, parts long")

    def pack(key, p):
        p = p.sort_values("node")
        return pd.DataFrame([(key[0], p["node"].to_numpy().tobytes(), b"".join(p["v"]), b"".join(p["w"]),
                              np.array(p["near"].tolist(), "<i4").tobytes())], columns=["blk", "ids", "v", "w", "near"])

    # At most PIVOTS rows are broadcast.
    blocks = stored(placed.join(F.broadcast(table), "p")
                    .select((F.col("start") + F.pmod(F.xxhash64("node"), F.col("parts"))).alias("blk"), "node", "v", "w", "near")
                    .groupBy("blk").applyInPandas(pack, "blk long, ids binary, v binary, w binary, near binary"), "ann-blocks")
    drop_stored(placed)

    def spots(r):
        m = len(r.ids) // 8
        codes = np.repeat((r.blk << PLACE) + np.arange(m), near)
        p = np.frombuffer(r.near, "<i4")
        v = np.repeat(np.frombuffer(r.v, "<f4").reshape(m, -1), near, axis=0)
        # Dealt anew around each pivot, so that two nodes that are parted by one may meet at another.
        deal = (_hashed(codes * few + p) % cell_parts[p].astype(np.uint64)).astype(np.int64)
        return _sent(OWN, r.blk, cells[p] + deal, codes, v)

    def compare(cell, p: pd.DataFrame) -> pd.DataFrame:
        codes = _array(p["a"], np.int64)
        v = _array(p["b"], "<f4").reshape(len(codes), -1)
        k = min(LINKS, len(codes) - 1)
        at, to, sims = [], [], []
        for x in range(0, len(codes) if k else 0, 256):
            s = v[x:x + 256] @ v.T
            s[np.arange(len(s)), np.arange(x, x + len(s))] = -np.inf
            o = np.argpartition(s, len(codes) - k, axis=1)[:, -k:]
            at.append(np.repeat(codes[x:x + 256], k))
            to.append(codes[o].ravel())
            sims.append(np.take_along_axis(s, o, axis=1).ravel())
        if not at:
            return _frame([])
        return _frame(_offers(cell, np.concatenate(at), np.concatenate(to), np.concatenate(sims)))

    def alone(r):
        m = len(r.ids) // 8
        return [(r.blk, OWN, 0, np.full((m, LINKS), -1).tobytes(), np.full((m, LINKS), -np.inf, "<f4").tobytes(),
                 np.zeros((m, LINKS), np.uint8).tobytes())]

    offers = _meet(_each(blocks, spots), int(cell_parts.sum()), compare)
    graph = _merged(_each(blocks, alone), offers, n_blocks)
    for _ in range(ROUNDS if n > 1 else 0):
        old, graph = graph, _merged(graph, _round(blocks, graph, n_blocks), n_blocks)
        drop_stored(old)
        if graph.agg(F.sum("src")).first()[0] <= SETTLED * n * LINKS:
            break
    return blocks, graph, n_blocks, [r["node"] for r in picked[:ENTRIES]]


def _homes(counts: np.ndarray, centres: np.ndarray, most: int) -> tuple[list[tuple[int, int, int]], int]:
    """(pivot, first block, number of blocks) of every pivot's nodes, and the number of blocks; near pivots share one."""
    order = np.argsort((centres @ centres[:-(-len(counts) // 4)].T).argmax(axis=1), kind="stable")
    out, n_blocks, shared, held = [], 0, -1, most
    for p in order.tolist():
        c = int(counts[p])
        if c > most:
            out.append((p, n_blocks, -(-c // most)))
            n_blocks += out[-1][2]
            continue
        if held + c > most:
            shared, held, n_blocks = n_blocks, 0, n_blocks + 1
        out.append((p, shared, 1))
        held += c
    return out, n_blocks


def _offers(src: int, at: np.ndarray, to: np.ndarray, sims: np.ndarray) -> list:
    return _sent(OFFER, src, at >> PLACE, (at & ((1 << PLACE) - 1)).astype(np.int32), to, sims)


def _merged(graph: DataFrame, offers: DataFrame, n_blocks: int) -> DataFrame:
    """Stored ``OWN`` rows (links, similarities, whether new), each node's best first; ``src``: how many links are new."""

    def best(blk, p: pd.DataFrame) -> pd.DataFrame:
        own, got = p[p["kind"] == OWN], p[p["kind"] == OFFER]
        links = _array(own["a"], np.int64).reshape(-1, LINKS)
        m = len(links)
        at = np.concatenate([np.repeat(np.arange(m), LINKS), _array(got["a"], np.int32)])
        to = np.concatenate([links.ravel(), _array(got["b"], np.int64)])
        sims = np.concatenate([_array(own["b"], "<f4"), _array(got["c"], "<f4")])
        # Old links come first, so that an offer of one is none.
        fresh = np.arange(len(at)) >= links.size
        o = np.flatnonzero(to >= 0)
        o = o[_first_of_each(at[o], to[o])]
        o = o[_best(at[o], to[o], sims[o], LINKS)]
        rank = _ranks(at[o])
        out = [np.full((m, LINKS), -1), np.full((m, LINKS), -np.inf, "<f4"), np.zeros((m, LINKS), np.uint8)]
        for table, values in zip(out, (to, sims, fresh)):
            table[at[o], rank] = values[o]
        return _frame([(blk, OWN, int(fresh[o].sum()), *[x.tobytes() for x in out])])

    return stored(_meet(graph.unionByName(offers), n_blocks, best), "ann-graph")


def _round(blocks: DataFrame, graph: DataFrame, n_blocks: int) -> DataFrame:
    """Offers of one round."""

    def turned(r):
        """A block's links, its nodes' worst similarities, and each link told to the node it leads to."""
        links = np.frombuffer(r.a, np.int64).reshape(-1, LINKS)
        codes = np.repeat((r.dst << PLACE) + np.arange(len(links)), LINKS)
        held = np.flatnonzero(links.ravel() >= 0)
        to = links.ravel()[held]
        worst = np.frombuffer(r.b, "<f4").reshape(-1, LINKS)[:, -1]
        return [(r.dst, OWN, r.dst, r.a, worst.tobytes(), r.c),
                *_sent(TURN, r.dst, to >> PLACE, (to & ((1 << PLACE) - 1)).astype(np.int32), codes[held], np.frombuffer(r.c, np.uint8)[held])]

    def hoods(blk, p: pd.DataFrame) -> pd.DataFrame:
        own, got = p[p["kind"] == OWN], p[p["kind"] == TURN]
        links, fresh = _array(own["a"], np.int64), _array(own["c"], np.uint8)
        at, frm, new = _array(got["a"], np.int32), _array(got["b"], np.int64), _array(got["c"], np.uint8)
        o = np.lexsort((_hashed(frm), 1 - new, at))
        o = o[_ranks(at[o]) < TURNED]
        held = np.flatnonzero(links >= 0)
        at = np.concatenate([held // LINKS, at[o]])
        to, new = np.concatenate([links[held], frm[o]]), np.concatenate([fresh[held], new[o]])
        o = np.argsort(1 - new, kind="stable")
        o = o[_first_of_each(at[o], to[o])]
        at, to, new = at[o], to[o], new[o]
        # Where nothing is new all pairs were compared.
        count = np.bincount(at)
        live = (count > 1) & (np.bincount(at, new) > 0)
        keep = live[at] if len(at) else np.zeros(0, bool)
        to, new = to[keep], new[keep]
        wanted = np.unique(to)
        return _frame([(blk, OWN, blk, to.tobytes(), count[live].astype(np.int32).tobytes(), new.tobytes(), own["b"].iloc[0]),
                       *_sent(WANT, blk, wanted >> PLACE, (wanted & ((1 << PLACE) - 1)).astype(np.int32))])

    def vectors(blk, p: pd.DataFrame) -> pd.DataFrame:
        own = p[p["kind"] == OWN].iloc[0]
        worst = np.frombuffer(own["d"], "<f4")
        v = _array(p.loc[p["kind"] == VECTORS, "a"], "<f4").reshape(len(worst), -1)
        rows = [(blk, OWN, blk, own["a"], own["b"], own["c"])]
        for src, asked in p.loc[p["kind"] == WANT, ["src", "a"]].itertuples(index=False):
            at = np.frombuffer(asked, np.int32)
            rows.append((src, VECTORS, blk, ((blk << PLACE) + at.astype(np.int64)).tobytes(), v[at].tobytes(), worst[at].tobytes()))
        return _frame(rows)

    def compare(blk, p: pd.DataFrame) -> pd.DataFrame:
        own, got = p[p["kind"] == OWN].iloc[0], p[p["kind"] == VECTORS]
        counts = np.frombuffer(own["b"], np.int32)
        if not len(counts):
            return _frame([])
        codes = _array(got["a"], np.int64)
        order = np.argsort(codes)
        codes, v = codes[order], _array(got["b"], "<f4").reshape(len(order), -1)[order]
        worst, n = _array(got["c"], "<f4")[order], len(codes)
        members = np.searchsorted(codes, np.frombuffer(own["a"], np.int64))
        fresh = np.frombuffer(own["c"], np.uint8).astype(bool)
        pairs, sims, held = [], [], 0

        def reduced():
            pair, first = np.unique(np.concatenate(pairs), return_index=True)
            sim = np.concatenate(sims)[first]
            o = _best(pair // n, pair % n, sim, LINKS)
            return [pair[o]], [sim[o]], len(o)

        limit = PAIRS
        for x, y in zip((np.cumsum(counts) - counts).tolist(), np.cumsum(counts).tolist()):
            at, new = members[x:y], fresh[x:y]
            some, vs, floor = at[new], v[at], worst[at]
            s = vs[new] @ vs.T
            s[np.arange(len(some)), np.flatnonzero(new)] = -np.inf
            i, j = np.nonzero(s > floor[new][:, None])
            pairs.append(some[i] * n + at[j])
            sims.append(s[i, j])
            # Two new ones meet twice in ``s``, an old one and a new one once.
            i, j = np.nonzero((s > floor) & ~new)
            pairs.append(at[j] * n + some[i])
            sims.append(s[i, j])
            held += len(pairs[-2]) + len(pairs[-1])
            if held > limit:
                pairs, sims, held = reduced()
                limit = max(PAIRS, 2 * held)
        pairs, sims, _ = reduced()
        return _frame(_offers(blk, codes[pairs[0] // n], codes[pairs[0] % n], sims[0]))

    null = F.lit(None).cast("binary")
    own = blocks.select(F.col("blk").alias("dst"), F.lit(VECTORS).alias("kind"), F.col("blk").alias("src"), F.col("v").alias("a"),
                        null.alias("b"), null.alias("c"), null.alias("d"))
    wanted = _meet(_each(graph, turned), n_blocks, hoods)
    return _meet(_meet(wanted.unionByName(own), n_blocks, vectors), n_blocks, compare)


def search(blocks: DataFrame, graph: DataFrame, n_blocks: int, codes: DataFrame, queries: DataFrame, entries: list[int],
           dim: int, k: int) -> DataFrame:
    """(q, node, score) of each query's beam; ``queries``: (q) the nodes that ask, ``codes``: (node, code)."""
    width = max(BEAM, k + 1)
    null = F.lit(None).cast("binary")
    # Sizes of packed rows are guessed too low to choose a broadcast by.
    table = stored(blocks.select("blk", "w").hint("merge").join(graph.select(F.col("dst").alias("blk"), F.col("a").alias("links")), "blk")
                   .select(F.col("blk").alias("dst"), F.lit(OWN).alias("kind"), F.col("blk").alias("src"), F.col("w").alias("a"),
                           F.col("links").alias("b"), null.alias("c"), null.alias("d")), "ann-table")
    starts = np.array([r["code"] for r in codes.where(F.col("node").isin(entries)).orderBy("code").collect()], np.int64)

    def entry(r):
        at = starts[starts >> PLACE == r.dst] & ((1 << PLACE) - 1)
        return [(r.dst, OWN, r.dst, np.frombuffer(r.a, "<f8").reshape(-1, dim)[at].tobytes())] if len(at) else []

    # ENTRIES nodes in all.
    start_v = _array([bytes(r["a"]) for r in sorted(_each(table, entry).collect(), key=lambda r: r["dst"])], "<f8").reshape(-1, dim)

    def taken(blk, places, q, at, to, scores):
        """A block's queries with the best of what they have met, and requests for the links of what is not expanded.

        ``to``: codes, marked ``FRESH`` where they are not expanded; of a code that stands twice the first counts.
        """
        o = _first_of_each(at, to & (FRESH - 1))
        at, to, scores = at[o], to[o], scores[o]
        o = _best(at, to & (FRESH - 1), scores, width)
        at, to, scores = at[o], to[o], scores[o]
        rank = _ranks(at)
        beam, held = np.full((len(q), width), -1), np.full((len(q), width), -np.inf)
        beam[at, rank], held[at, rank] = to, scores
        wanted = np.unique(to[to >= FRESH]) - FRESH
        return _frame([(blk, QUERIES, blk, places.tobytes(), beam.tobytes(), held.tobytes(), q.tobytes()),
                       *_sent(WANT, blk, wanted >> PLACE, (wanted & ((1 << PLACE) - 1)).astype(np.int32))])

    def begin(blk, p: pd.DataFrame) -> pd.DataFrame:
        own, asked = p[p["kind"] == OWN].iloc[0], p[p["kind"] == QUERIES]
        if not len(asked):
            return _frame([])
        places = np.sort(_array(asked["a"], np.int32))
        q = np.frombuffer(own["a"], "<f8").reshape(-1, dim)[places]
        at = np.concatenate([np.arange(len(q)), np.repeat(np.arange(len(q)), len(starts))])
        to = np.concatenate([(blk << PLACE) + places.astype(np.int64), np.tile(starts, len(q))])
        return taken(blk, places, q, at, to + FRESH, np.concatenate([np.einsum("ij,ij->i", q, q), (q @ start_v.T).ravel()]))

    def passed(p: pd.DataFrame) -> list:
        return [tuple(r) for r in p[p["kind"] == QUERIES].itertuples(index=False)]

    def linked(blk, p: pd.DataFrame) -> pd.DataFrame:
        links = np.frombuffer(p.loc[p["kind"] == OWN, "b"].iloc[0], np.int64).reshape(-1, LINKS)
        rows = passed(p)
        for src, asked in p.loc[p["kind"] == WANT, ["src", "a"]].itertuples(index=False):
            at = np.frombuffer(asked, np.int32)
            rows.append((src, EXPANDED, blk, ((blk << PLACE) + at.astype(np.int64)).tobytes(), links[at].tobytes()))
        return _frame(rows)

    def expand(blk, p: pd.DataFrame) -> pd.DataFrame:
        own, got = p[p["kind"] == QUERIES].iloc[0], p[p["kind"] == EXPANDED]
        beam, held = np.frombuffer(own["b"], np.int64), np.frombuffer(own["c"], "<f8").reshape(-1, width)
        q = np.frombuffer(own["d"], "<f8").reshape(len(held), dim)
        new = np.flatnonzero(beam >= FRESH)
        full = np.flatnonzero(beam >= 0)
        beam = np.where(beam >= 0, beam & (FRESH - 1), beam)
        codes = _array(got["a"], np.int64)
        order = np.argsort(codes)
        links = _array(got["b"], np.int64).reshape(-1, LINKS)[order]
        rows = [(blk, QUERIES, blk, own["a"], beam.tobytes(), own["c"], own["d"])]
        cand = links[np.searchsorted(codes[order], beam[new])].ravel()
        ask = np.unique(((np.repeat(new // width, LINKS) << KEY) | cand)[cand >= 0])
        ask = ask[~np.isin(ask, (full // width << KEY) | beam[full])]
        who, cand = ask >> KEY, ask & ((1 << KEY) - 1)
        order = np.argsort(cand >> PLACE, kind="stable")
        who, cand = who[order], cand[order]
        for x, y in _cut(cand >> PLACE):
            some, which = np.unique(who[x:y], return_inverse=True)
            rows.append((int(cand[x] >> PLACE), ASK, blk, (cand[x:y] & ((1 << PLACE) - 1)).astype(np.int32).tobytes(),
                         which.astype(np.int32).tobytes(), some.astype(np.int32).tobytes(),
                         np.hstack([q[some], held[some, -1:]]).tobytes()))
        return _frame(rows)

    def score(blk, p: pd.DataFrame) -> pd.DataFrame:
        w = np.frombuffer(p.loc[p["kind"] == OWN, "a"].iloc[0], "<f8").reshape(-1, dim)
        rows = passed(p)
        for r in p[p["kind"] == ASK].itertuples(index=False):
            at, which, some = np.frombuffer(r.a, np.int32), np.frombuffer(r.b, np.int32), np.frombuffer(r.c, np.int32)
            q = np.frombuffer(r.d, "<f8").reshape(len(some), -1)
            s = np.concatenate([np.einsum("ij,ij->i", w[at[x:x + 16384]], q[which[x:x + 16384], :-1]) for x in range(0, len(at), 16384)])
            # What is below a full beam's worst cannot come in.
            good = np.flatnonzero(s >= q[which, -1])
            if len(good):
                rows.append((r.src, REPLY, blk, some[which[good]].tobytes(), ((blk << PLACE) + at[good].astype(np.int64)).tobytes(),
                             s[good].tobytes()))
        return _frame(rows)

    def step(blk, p: pd.DataFrame) -> pd.DataFrame:
        own, got = p[p["kind"] == QUERIES].iloc[0], p[p["kind"] == REPLY]
        places = np.frombuffer(own["a"], np.int32)
        beam, held = np.frombuffer(own["b"], np.int64), np.frombuffer(own["c"], "<f8")
        full = np.flatnonzero(beam >= 0)
        return taken(blk, places, np.frombuffer(own["d"], "<f8").reshape(len(places), dim),
                     np.concatenate([full // width, _array(got["a"], np.int32)]),
                     np.concatenate([beam[full], _array(got["b"], np.int64) + FRESH]),
                     np.concatenate([held[full], _array(got["c"], "<f8")]))

    def asking(key, p):
        return _frame([(key[0], QUERIES, key[0], (p["code"].to_numpy() & ((1 << PLACE) - 1)).astype(np.int32).tobytes())])

    asked = (queries.hint("merge").join(codes.withColumnRenamed("node", "q"), "q")
             .groupBy(F.shiftright("code", PLACE).alias("blk")).applyInPandas(asking, _ROWS))
    state = stored(_meet(table.unionByName(asked), n_blocks, begin), "ann-state")
    while not state.where(F.col("kind") == WANT).isEmpty():
        asks = _meet(_meet(table.unionByName(state), n_blocks, linked), n_blocks, expand)
        old, state = state, stored(_meet(_meet(table.unionByName(asks), n_blocks, score), n_blocks, step), "ann-state")
        drop_stored(old)

    def beams(batches):
        for b in batches:
            for r in b.itertuples(index=False):
                places, beam = np.frombuffer(r.a, np.int32), np.frombuffer(r.b, np.int64)
                full = np.flatnonzero(beam >= 0)
                yield pd.DataFrame({"start": (r.dst << PLACE) + places[full // width].astype(np.int64), "code": beam[full],
                                    "score": np.frombuffer(r.c, "<f8")[full]})

    found = state.where(F.col("kind") == QUERIES).mapInPandas(beams, "start long, code long, score double")
    return (found.hint("merge").join(codes, "code").drop("code")
            .join(codes.select(F.col("node").alias("q"), F.col("code").alias("start")).hint("merge"), "start").select("q", "node", "score"))


def nearest(vectors: DataFrame, is_query, k: int) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k best by inner product; ``vectors``: (id, v)."""
    spark = vectors.sparkSession
    first = Window.partitionBy("v").orderBy("id")
    # A query needs at most its own id and k more of one node's members.
    ranked = vectors.withColumn("r", F.row_number().over(first))
    nodes = stored(ranked.where(F.col("r") <= k + 1).groupBy("v").agg(
        F.min("id").alias("node"), F.sort_array(F.collect_list("id")).alias("members")), "ann-nodes")
    norm = F.aggregate("v", F.lit(0).cast("double"), lambda a, x: a + x * x)
    facts = nodes.agg(F.max(F.size("v")).alias("dim"), F.max(norm).alias("m2")).first()
    if facts["dim"] is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    blocks, graph, n_blocks, entries = build_graph(nodes, facts["dim"], facts["m2"])

    def coded(batches):
        for b in batches:
            for blk, ids in b.itertuples(index=False):
                ids = np.frombuffer(ids, np.int64)
                yield pd.DataFrame({"node": ids, "code": (blk << PLACE) + np.arange(len(ids))})

    codes = stored(blocks.select("blk", "ids").mapInPandas(coded, "node long, code long"), "ann-codes")
    asked = stored(vectors.where(is_query).select(F.col("id").alias("query_id"), "v")
                   .join(nodes.select("v", "node"), "v").select("query_id", "node"), "ann-asked")
    found = search(blocks, graph, n_blocks, codes, asked.select(F.col("node").alias("q")).distinct(), entries, facts["dim"], k)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (asked.select("query_id", F.col("node").alias("q")).join(found, "q")
            .join(nodes.select("node", "members"), "node")
            .select("query_id", F.explode("members").alias("vec_id"), "score").where("query_id <> vec_id")
            .withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))

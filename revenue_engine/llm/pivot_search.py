"""Exact top-k search with a pivot-distance index.

Largest inner product becomes nearest distance by one more coordinate,
``sqrt(M^2 - |x|^2)`` for rows and 0 for queries, with ``M`` the largest norm:
then ``|x' - q'|^2 = M^2 + |q|^2 - 2 <x, q>``. Every row is keyed by its nearest
pivot and the distance to it; rows sorted by that key are cut into annuli of
at most ``ANNULUS`` rows. By the triangle inequality an annulus ``[lo, hi]``
around a pivot at distance ``d`` from the query holds no row nearer than
``max(0, lo - d, d - hi)``. Queries expand annuli in the order of that bound,
in growing rounds, and stop once it exceeds the distance of their k-th score;
annuli that tie with it are still read, so ties resolve by id.

Pivots are a sample of at most ``PIVOTS`` rows by a hash of the id; they only
shape the index, every row is in it and results are exact. Queries meet an
annulus in lists of a bounded length. Distances carry a slack for rounding;
scores are exact integers as long as they fit a long.

Defined results: see ``clean_vectors``; shorter vectors count as filled with
zeros; fewer than k candidates are all returned; an empty table gives none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from revenue_engine.llm.common import stored
from revenue_engine.llm.vectors import matrix, padded

PIVOTS = 64
ANNULUS = 256
QUERIES_AT_ONCE = 128
FIRST_ROUNDS = (4, 24)  # annuli of the first rounds; the last round reads all that are left
SLACK = 1e-6

_EMPTY = "query_id long, vec_id long, score long"


def top_k(rows: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """(query_id, rank, vec_id, score) for integer vectors; ``rows`` and ``queries``: (id, v: array<long>)."""
    spark = rows.sparkSession
    rows = stored(rows, "pivot-rows")
    norm = F.aggregate("v", F.lit(0).cast("double"), lambda a, x: a + x.cast("double") * x)
    facts = rows.agg(F.max(F.size("v")).alias("dim"), F.max(norm).alias("m2")).first()
    if facts["dim"] is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    qdim = queries.agg(F.max(F.size("v")).alias("d")).first()["d"]
    dim, m2 = max(facts["dim"], qdim or 0), facts["m2"]
    exact_type = np.float64 if m2 < 2 ** 50 else np.int64  # products summed below 2^53 are exact in doubles

    def lifted(v: np.ndarray, row: bool) -> np.ndarray:
        extra = np.sqrt(np.maximum(0.0, m2 - (v * v).sum(axis=1))) if row else np.zeros(len(v))
        return np.hstack([v, extra[:, None]])

    def distances(v: np.ndarray) -> np.ndarray:
        d2 = (v * v).sum(axis=1)[:, None] + (centres * centres).sum(axis=1)[None, :] - 2 * (v @ centres.T)
        return np.sqrt(np.maximum(0.0, d2))

    picked = rows.orderBy(F.xxhash64("id"), "id").limit(PIVOTS).collect()
    centres = lifted(padded([r["v"] for r in picked], dim), True)

    def keyed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            v = padded(b["v"], dim)
            d = distances(lifted(v, True))
            cell = d.argmin(axis=1)
            yield pd.DataFrame({"id": b["id"], "cell": cell.astype("int32"), "d": d[np.arange(len(v)), cell],
                                "v": [x.tobytes() for x in v.astype("<i8")]})

    def annuli(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        made, part, rest = 0, TaskContext.get().partitionId(), None
        for b in batches:
            rest = b if rest is None else pd.concat([rest, b], ignore_index=True)
            out, rest = _cut(rest, part, made, last=False)
            made += len(out)
            if len(out):
                yield out
        if rest is not None and len(rest):
            out, _ = _cut(rest, part, made, last=True)
            yield out

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    index = stored(rows.mapInPandas(keyed, "id long, cell int, d double, v binary")
                   .repartitionByRange(parts, "cell", "d", "id").sortWithinPartitions("cell", "d", "id")
                   .mapInPandas(annuli, "annulus long, cell int, lo double, hi double, ids binary, vs binary"),
                   "pivot-index")

    def seen_from(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            v = padded(b["v"], dim)
            yield pd.DataFrame({"query_id": b["id"], "q2": (v * v).sum(axis=1), "ds": list(distances(lifted(v, False))),
                                "v": [x.tobytes() for x in v.astype("<i8")]})

    qs = stored(queries.mapInPandas(seen_from, "query_id long, q2 double, ds array<double>, v binary"), "pivot-queries")
    bound = F.greatest(F.lit(0.0), F.col("lo") - F.col("d"), F.col("d") - F.col("hi"))
    order = Window.partitionBy("query_id").orderBy("bound", "annulus")
    # The bounds of a stated query set against the index entries, one for up to ANNULUS rows.
    todo = stored(qs.select("query_id", "q2", F.posexplode("ds").alias("cell", "d"))
                  .join(index.select("annulus", "cell", "lo", "hi"), "cell")
                  .select("query_id", "q2", "annulus", bound.alias("bound"))
                  .withColumn("turn", F.row_number().over(order)), "pivot-bounds")
    groups = max(1, -(-qs.count() // QUERIES_AT_ONCE))

    def scored(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for ids, vs, qids, qvs in zip(b["ids"], b["vs"], b["qids"], b["qvs"]):
                rid = np.frombuffer(ids, "<i8")
                m = np.frombuffer(vs, "<i8").reshape(-1, dim).astype(exact_type)
                q = matrix(qvs, dim, "<i8").astype(exact_type)
                s = (q @ m.T).astype(np.int64)
                qid = np.asarray(qids, np.int64)
                out = []
                for i in range(len(qid)):
                    ok = rid != qid[i]
                    top = np.lexsort((rid[ok], -s[i][ok]))[:k]
                    out.append((np.full(len(top), qid[i]), rid[ok][top], s[i][ok][top]))
                yield pd.DataFrame({"query_id": np.concatenate([o[0] for o in out]),
                                    "vec_id": np.concatenate([o[1] for o in out]),
                                    "score": np.concatenate([o[2] for o in out])})

    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    found, start = spark.createDataFrame([], _EMPTY), 0
    for stop in (*FIRST_ROUNDS, None):
        turn = todo.where(F.col("turn") > start)
        if stop:
            turn = turn.where(F.col("turn") <= stop)
        kth = (found.withColumn("r", F.row_number().over(best)).where(F.col("r") == k)
               .select("query_id", F.col("score").alias("kth")))
        reach = F.sqrt(F.greatest(F.lit(0.0), m2 + F.col("q2") - 2.0 * F.col("kth")))
        need = (turn.join(kth, "query_id", "left")
                .where(F.col("kth").isNull() | (F.col("bound") <= reach * (1 + SLACK) + SLACK)))
        lists = (need.select("query_id", "annulus").join(qs.select("query_id", "v"), "query_id")
                 .groupBy("annulus", F.pmod(F.xxhash64("query_id"), F.lit(groups)).alias("g"))
                 .agg(F.collect_list(F.struct("query_id", "v")).alias("q"))
                 .select("annulus", F.col("q.query_id").alias("qids"), F.col("q.v").alias("qvs")))
        new = (lists.join(index.select("annulus", "ids", "vs"), "annulus").select("ids", "vs", "qids", "qvs")
               .mapInPandas(scored, _EMPTY))
        found = stored(found.unionByName(new).withColumn("r", F.row_number().over(best)).where(F.col("r") <= k)
                       .drop("r"), "pivot-found")
        start = stop
    return found.select("query_id", F.row_number().over(best).cast("int").alias("rank"), "vec_id", "score")


def _cut(rows: pd.DataFrame, part: int, made: int, last: bool) -> tuple[pd.DataFrame, pd.DataFrame]:
    """Annuli of one pivot each from sorted rows; rows of an annulus that may go on are handed back."""
    cells = rows["cell"].to_numpy()
    edges = [0, *(np.flatnonzero(np.diff(cells)) + 1).tolist(), len(rows)]
    spans = [(a, min(a + ANNULUS, hi)) for lo, hi in zip(edges, edges[1:]) for a in range(lo, hi, ANNULUS)]
    left = rows.iloc[len(rows):]
    if not last and spans and spans[-1][1] - spans[-1][0] < ANNULUS:
        a, _ = spans.pop()
        left = rows.iloc[a:]
    d, ids, vs = rows["d"].to_numpy(), rows["id"].to_numpy().astype("<i8"), rows["v"].tolist()
    out = pd.DataFrame([((part << 32) + made + i, int(cells[a]), float(d[a]), float(d[b - 1]), ids[a:b].tobytes(),
                         b"".join(vs[a:b])) for i, (a, b) in enumerate(spans)],
                       columns=["annulus", "cell", "lo", "hi", "ids", "vs"])
    return out, left

"""Mixing sources to target weights by entropy balancing.

Every source gets a share of the mix by its weight, at most ``CAP`` times its
own words; what a full source leaves is shared again by weight. Within a
source the document rates solve the maximum-entropy problem with the token
constraint ``sum(rate * size) = target`` and rates between 0 and ``CAP``: the
solution tilts the even rate exponentially in the document's size,
``rate = CAP * sigmoid(lambda * size / mean)``. The convex dual has one
unknown per source; all sources are solved at once by Newton steps, each one
grouped sum over the (source, size) counts. From zero the steps approach the
root from one side, so no line search is needed. Sums are decimal, hence the
same in every run.

Rates become whole copies by systematic rounding along (source, size): a
running sum of rates, in fixed point, gives each cell of equal documents its
copies. The error of a source stays below its longest document. Cells of more
than ``CELL_ROWS`` documents are split by a hash of the id, and the running
sum is taken in two passes over range partitions, so no source, however
large, meets in one task.

Defined results: a null source is a source of its own, last in order; a null
or blank text has size 0, one copy and no words; a source of no words has
target 0; ties in size are decided by a hash of doc_id; repeated rows each
count; an empty table gives an empty result; other columns pass through,
but for those named like a result column, which it replaces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from revenue_engine.llm.common import drop_stored, stored, word_count
from revenue_engine.operators.ordering import global_row_number

CAP = 2
WEIGHTS = (5, 2, 1)
SHARE = 1.5
CELL_ROWS = 512
ONE = 1 << 20  # fixed-point unit of a rate
TOLERANCE = 1e-9
MAX_STEPS = 200
RESULT = ("size", "source_size", "target", "copies", "taken")

_KEY = ["_null", "_src"]


def _keyed(df: DataFrame) -> DataFrame:
    src = F.col("source").cast("string")
    return df.withColumn("_null", src.isNull()).withColumn("_src", F.coalesce(src, F.lit("")))


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: int = CAP) -> DataFrame:
    """(_null, _src, source_size, docs, target) from (_null, _src, size, n)."""
    sums = stored(sizes.groupBy(*_KEY).agg(F.sum(F.col("size") * F.col("n")).alias("source_size"),
                                           F.sum(F.when(F.col("size") > 0, F.col("n")).otherwise(0)).alias("docs")),
                  "mix-sources")
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]),
                     ((F.col("_rank") - 1) % len(weights) + 1).cast("int"))
    ranked = stored(global_row_number(sums, _KEY, "_rank").withColumn("_w", w), "mix-ranked")
    total = ranked.agg(F.sum("source_size").alias("t")).first()["t"] or 0
    level = 0.0
    while total:
        # Sources whose share at this level is over their bound keep the bound; the rest share again.
        full = F.col("_w") * level >= F.col("source_size") * cap
        r = ranked.agg(F.sum(F.when(full, F.col("source_size") * cap).otherwise(0)).alias("held"),
                       F.sum(F.when(~full, F.col("_w")).otherwise(0.0)).alias("w")).first()
        if not r["w"] or (new := (share * total - r["held"]) / r["w"]) <= level:
            break
        level = new
    target = F.least(F.col("_w") * F.lit(level), (F.col("source_size") * cap).cast("double"))
    return ranked.select(*_KEY, "source_size", "docs", target.alias("target"))


def tilts(sizes: DataFrame, targets: DataFrame, cap: int = CAP) -> DataFrame:
    """Targets with the tilt ``lam`` of every source; null where all rates are ``cap``."""
    hist = sizes.where("size > 0")
    open_ = (F.col("target") > 0) & (F.col("target") < F.col("source_size") * cap)
    state = stored(targets.withColumn("mean", F.col("source_size") / F.greatest("docs", F.lit(1)))
                   .withColumn("lam", F.when(open_, F.lit(0.0)))
                   .withColumn("done", ~open_), "mix-state")
    for _ in range(MAX_STEPS):
        live = state.where(~F.col("done"))
        if live.isEmpty():
            break
        z = F.col("size") / F.col("mean")
        s = 1.0 / (1.0 + F.exp(-F.col("lam") * z))
        words = F.col("n") * F.col("size") * cap

        def dec(x):
            return F.sum(x.cast("decimal(28,6)")).cast("double")

        step = (hist.join(live.select(*_KEY, "lam", "mean"), _KEY)
                .groupBy(*_KEY).agg(dec(words * s).alias("got"), dec(words * s * (1.0 - s) * z).alias("slope")))
        lam = F.col("lam") + F.try_divide(F.col("target") - F.col("got"), F.col("slope"))
        met = F.abs(F.col("target") - F.col("got")) <= F.col("target") * TOLERANCE
        new = (state.join(step, _KEY, "left")
               .withColumn("_stop", met | (F.col("slope") <= 0))
               .select(*_KEY, "source_size", "docs", "target", "mean",
                       F.when(F.col("done") | F.col("_stop"), F.col("lam")).otherwise(lam).alias("lam"),
                       (F.col("done") | F.coalesce("_stop", F.lit(True))).alias("done")))
        old, state = state, stored(new, "mix-state")
        drop_stored(old)
    else:
        if not state.where(~F.col("done")).isEmpty():
            raise RuntimeError(f"the tilts of some sources did not converge in {MAX_STEPS} steps")
    return state


def prefix_sum(df: DataFrame, order: list[str], value: str, name: str) -> DataFrame:
    """``df`` with the running sum of ``value`` before each row, in two passes over range partitions."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = stored(df.repartitionByRange(parts, *order).withColumn("_pid", F.spark_partition_id()), name)
    # One row per range partition.
    sums = ranged.groupBy("_pid").agg(F.sum(value).alias("_sum"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    base = sums.select("_pid", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_base"))
    inner = Window.partitionBy("_pid").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (ranged.join(F.broadcast(base), "_pid")
            .withColumn("_before", F.col("_base") + F.coalesce(F.sum(value).over(inner), F.lit(0)))
            .drop("_pid", "_base"))


def balanced_copies(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: int = CAP) -> DataFrame:
    """Every row of ``docs`` with size, source_size, target, copies and taken."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in RESULT]).alias("_row"),
                       F.col("doc_id").cast("long").alias("_id"), F.col("source"), word_count(F.col("text")).alias("size"))
    rows = _keyed(rows).drop("source")
    narrow = stored(rows.select("_id", *_KEY, "size"), "mix-sizes")
    sizes = stored(narrow.groupBy(*_KEY, "size").agg(F.count(F.lit(1)).alias("n")), "mix-hist")
    targets = source_targets(sizes, weights, share, cap)
    solved = tilts(sizes, targets, cap)

    large = sizes.where(F.col("n") > CELL_ROWS).select(
        *_KEY, "size", F.ceil(F.col("n") / CELL_ROWS).cast("long").alias("_parts"))

    def celled(df):
        cell = F.pmod(F.xxhash64("_id"), F.coalesce("_parts", F.lit(1)))
        return df.join(large, [*_KEY, "size"], "left").withColumn("_cell", cell).drop("_parts")

    key = [*_KEY, "size", "_cell"]
    rate = F.when(F.col("size") == 0, F.lit(1.0)).when(F.col("lam").isNull(), F.lit(float(cap))) \
        .otherwise(cap / (1.0 + F.exp(-F.col("lam") * F.col("size") / F.col("mean"))))
    cells = (celled(narrow).groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
             .join(solved, _KEY).withColumn("_fixed", F.col("n") * F.round(rate * ONE).cast("long")))
    run = prefix_sum(cells, key, "_fixed", "mix-cells")

    def whole(x):
        return F.shiftright((x + ONE // 2).cast("long"), 20)

    run = run.select(*key, "n", "source_size", "target",
                     (whole(F.col("_before") + F.col("_fixed")) - whole(F.col("_before"))).alias("_copies"))
    first = Window.partitionBy(*key).orderBy(F.xxhash64("_id"), "_id")
    extra = (F.row_number().over(first) <= F.col("_copies") % F.col("n")).cast("long")
    copies = F.least(F.expr("_copies div n") + extra, F.lit(cap).cast("long"))
    return (celled(rows).join(run, key).withColumn("copies", copies)
            .select("_row.*", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken")))


def mixed(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: int = CAP) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as it has copies."""
    # Columns that are not read pass under other names, so that none is taken for one of the result.
    names = [c if c in ("doc_id", "source", "text") else f"_c{i}" for i, c in enumerate(docs.columns)]
    plain = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(docs.columns, names)])
    out = balanced_copies(plain, weights, share, cap).where("copies > 0")
    return (out.withColumn("_copy", F.explode(F.expr("sequence(1L, copies)")))
            .select(*[F.col(n).alias(c) for c, n in zip(docs.columns, names)]))

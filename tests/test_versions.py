"""Stored tables: all or nothing, replaced keys, deletes, conflicts."""

import hashlib
import os

import pytest
from pyspark.sql import functions as F

from revenue_engine.operators import versions as vs


def table(path):
    return vs.Table(path + "/t", "k string, d int, v int", ("k",))


def frame(spark, rows):
    return spark.createDataFrame(rows, "k string, d int, v int")


def rows(spark, t, at=None):
    return sorted(map(tuple, vs.read(spark, t, at).collect()))


def digests(t):
    out = {}
    for folder, _, names in os.walk(t.path + "/data"):
        out |= {os.path.join(folder, n): hashlib.sha256(open(os.path.join(folder, n), "rb").read()).hexdigest() for n in names}
    return out


def test_readers_keep_their_state_and_keys_are_replaced(spark, tmpdir_path):
    t = table(tmpdir_path)
    assert rows(spark, t) == []
    vs.write(t, frame(spark, [("a", 1, 1), ("a", 1, 2), ("b", 1, 3)]))
    before, files = vs.read(spark, t), digests(t)
    vs.write(t, frame(spark, [("a", 2, 9), ("c", 1, 4)]))
    assert sorted(map(tuple, before.collect())) == [("a", 1, 1), ("a", 1, 2), ("b", 1, 3)]  # opened before the load
    assert rows(spark, t) == [("a", 2, 9), ("b", 1, 3), ("c", 1, 4)]
    assert {k: v for k, v in digests(t).items() if k in files} == files
    # a load that accepts nothing clears its key
    vs.write(t, frame(spark, []), spark.createDataFrame([("b",)], "k string"))
    assert rows(spark, t) == [("a", 2, 9), ("c", 1, 4)]
    vs.compact(spark, t)
    assert rows(spark, t) == [("a", 2, 9), ("c", 1, 4)] and len(vs.snapshot(spark, t).parts) == 1
    assert vs.vacuum(spark, t, keep=1) == 3 and rows(spark, t) == [("a", 2, 9), ("c", 1, 4)]


def test_a_write_that_fails_is_never_seen(spark, tmpdir_path):
    t = table(tmpdir_path)
    vs.write(t, frame(spark, [("a", 1, 1)]))
    broken = frame(spark, [("a", 2, 2), ("b", 2, 2)]).withColumn(
        "v", F.when(F.col("k") == "b", F.raise_error(F.lit("lost")).cast("int")).otherwise(F.col("v")))
    with pytest.raises(Exception, match="lost"):
        vs.write(t, broken)
    with pytest.raises(Exception, match="a row without k"):
        vs.write(t, frame(spark, [(None, 1, 1)]))
    assert rows(spark, t) == [("a", 1, 1)]


def test_two_writers_on_one_state(spark, tmpdir_path):
    t = table(tmpdir_path)
    vs.write(t, frame(spark, [("a", 1, 1)]))
    base = vs.snapshot(spark, t)
    vs.write(t, frame(spark, [("a", 2, 2)]), base=base)
    with pytest.raises(vs.Conflict):
        vs.write(t, frame(spark, [("a", 3, 3)]), base=base)
    assert rows(spark, t) == [("a", 2, 2)]


def test_delete_touches_only_matching_keys(spark, tmpdir_path):
    t = table(tmpdir_path)
    vs.write(t, frame(spark, [("a", 1, 1), ("a", 2, 2), ("b", 3, None), ("c", 4, 5)]))
    files = digests(t)
    vs.delete(spark, t, F.col("v") < 2)
    assert rows(spark, t) == [("a", 2, 2), ("b", 3, None), ("c", 4, 5)]  # NULL is not TRUE
    part = vs.snapshot(spark, t).parts[-1]
    assert [tuple(r) for r in spark.read.parquet(f"{t.path}/keys/{part}").collect()] == [("a",)]
    assert files.items() <= digests(t).items()
    number = vs.snapshot(spark, t).number
    vs.delete(spark, t, F.col("v") > 100)
    assert vs.snapshot(spark, t).number == number


def test_many_parts_are_compacted(spark, tmpdir_path, monkeypatch):
    monkeypatch.setattr(vs, "MAX_PARTS", 3)
    t = table(tmpdir_path)
    for i in range(5):
        vs.write(t, frame(spark, [("a", i, i), (f"k{i}", i, i)]))
    assert rows(spark, t) == [("a", 4, 4)] + [(f"k{i}", i, i) for i in range(5)]
    assert len(vs.snapshot(spark, t).parts) <= 3

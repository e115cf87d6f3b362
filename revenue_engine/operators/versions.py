"""Stored tables with versions behind a pointer.

A table is a folder. Every write adds a *part*: ``data/<part>`` with rows and
``keys/<part>`` with the keys the part speaks for. A key's rows are those of
the latest part that names it, so a part can replace a key's rows, or clear
them by naming the key and holding none. ``pointers/<number>`` lists the parts
in order; a write becomes visible when its pointer file, written aside, is
renamed to the next number. The rename fails if that number exists, so of two
writers on one state one gets an error and nothing is mixed.

A reader resolves the newest pointer once: it sees all of a write or nothing,
and what it sees does not change while others write. Files of untouched keys
are never rewritten. Rows are not shuffled: the rows that later parts replaced
are left out by an anti-join against only the replaced keys. ``compact``
rewrites the live rows as one part; ``vacuum`` deletes parts that no kept
pointer lists. Lost executors are covered by Spark's own commit of each part.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from revenue_engine.session import drop_stored, stored

MAX_PARTS = 64  # a write beyond this compacts first


class Conflict(RuntimeError):
    """Another writer committed on the same state."""


@dataclass(frozen=True)
class Table:
    """A versioned table: its folder, schema (DDL) and key columns."""
    path: str
    schema: str
    keys: tuple[str, ...]


@dataclass(frozen=True)
class Snapshot:
    number: int
    parts: tuple[str, ...]


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _pointer_numbers(spark: SparkSession, table: Table) -> list[int]:
    fs, p = _fs(spark, f"{table.path}/pointers")
    if not fs.exists(p):
        return []
    names = (s.getPath().getName() for s in fs.listStatus(p))
    return sorted(int(n) for n in names if n.isdigit())


def _read_pointer(spark: SparkSession, table: Table, number: int) -> Snapshot:
    fs, p = _fs(spark, f"{table.path}/pointers/{number:010d}")
    stream = fs.open(p)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return Snapshot(number, tuple(json.loads(text)["parts"]))


def snapshot(spark: SparkSession, table: Table) -> Snapshot:
    """The newest state; number 0 without parts for a table that was never written."""
    numbers = _pointer_numbers(spark, table)
    return _read_pointer(spark, table, numbers[-1]) if numbers else Snapshot(0, ())


def _commit(spark: SparkSession, table: Table, base: Snapshot, parts: tuple[str, ...]) -> Snapshot:
    fs, aside = _fs(spark, f"{table.path}/pointers/.{uuid.uuid4().hex}")
    out = fs.create(aside, False)
    out.write(bytearray(json.dumps({"parts": list(parts)}).encode()))
    out.close()
    number = base.number + 1
    _, target = _fs(spark, f"{table.path}/pointers/{number:010d}")
    jvm = spark._jvm
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    none = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(fs.makeQualified(aside), fs.makeQualified(target), none)
    except Exception as e:
        fs.delete(aside, False)
        if "FileAlreadyExists" in str(e):
            raise Conflict(f"{table.path}: version {number} was committed by another writer") from e
        raise
    return Snapshot(number, parts)


def _parts_of(spark: SparkSession, table: Table, kind: str, schema: str, parts: tuple[str, ...]) -> DataFrame:
    """Rows of the parts with ``_part``, the part's place in the pointer."""
    name = F.regexp_extract("_metadata.file_path", rf"/{kind}/([0-9a-f]+)/", 1)
    rows = spark.read.schema(schema).parquet(*[f"{table.path}/{kind}/{p}" for p in parts])
    return rows.select("*", F.array_position(F.array(*[F.lit(p) for p in parts]), name).alias("_part"))


def _keys_schema(table: Table) -> str:
    fields = [f.strip() for f in table.schema.split(",")]
    return ", ".join(next(f for f in fields if f.split()[0] == k) for k in table.keys)


def read(spark: SparkSession, table: Table, at: Snapshot | None = None) -> DataFrame:
    """The rows of a state, by default the newest."""
    at = snapshot(spark, table) if at is None else at
    if not at.parts:
        return spark.createDataFrame([], table.schema)
    rows = _parts_of(spark, table, "data", table.schema, at.parts)
    if len(at.parts) > 1:
        named = _parts_of(spark, table, "keys", _keys_schema(table), at.parts)
        last = Window.partitionBy(*table.keys)
        replaced = (named.withColumn("_last", F.max("_part").over(last)).where(F.col("_part") < F.col("_last"))
                    .select(*table.keys, "_part"))
        rows = rows.join(replaced, [*table.keys, "_part"], "left_anti")
    return rows.select(*[f.split()[0] for f in table.schema.split(",")])


def write(table: Table, rows: DataFrame, keys: DataFrame | None = None, base: Snapshot | None = None) -> Snapshot:
    """Replace the rows of ``keys`` (by default the keys that occur in ``rows``) in one step.

    Rows whose key is not among ``keys`` must not be given; rows without a key are refused.
    """
    spark = rows.sparkSession
    base = snapshot(spark, table) if base is None else base
    if len(base.parts) >= MAX_PARTS:
        base = compact(spark, table)
    part = uuid.uuid4().hex
    columns = [f.split()[0] for f in table.schema.split(",")]
    whole = F.coalesce(*[F.when(F.col(k).isNull(), F.raise_error(F.lit(f"a row without {k}")).cast("boolean")) for k in table.keys],
                       F.lit(True))
    rows.select(*columns).where(whole).write.parquet(f"{table.path}/data/{part}")
    if keys is None:
        keys = spark.read.schema(table.schema).parquet(f"{table.path}/data/{part}")
    keys.select(*table.keys).distinct().write.parquet(f"{table.path}/keys/{part}")
    return _commit(spark, table, base, (*base.parts, part))


def delete(spark: SparkSession, table: Table, predicate: Column) -> Snapshot:
    """``DELETE … WHERE predicate``: only keys with a matching row get a new part.

    The predicate reaches the scan, so files whose statistics cannot match are not read for the search.
    """
    base = snapshot(spark, table)
    live = read(spark, table, base)
    hit = stored(live.where(predicate).select(*table.keys).distinct(), "delete-keys")
    if hit.isEmpty():
        drop_stored(hit)
        return base
    rest = live.join(hit, list(table.keys), "left_semi").where(~F.coalesce(predicate, F.lit(False)))
    out = write(table, rest, hit, base)
    drop_stored(hit)
    return out


def compact(spark: SparkSession, table: Table) -> Snapshot:
    """The live rows as one part."""
    base = snapshot(spark, table)
    part = uuid.uuid4().hex
    read(spark, table, base).write.parquet(f"{table.path}/data/{part}")
    rows = spark.read.schema(table.schema).parquet(f"{table.path}/data/{part}")
    rows.select(*table.keys).distinct().write.parquet(f"{table.path}/keys/{part}")
    return _commit(spark, table, base, (part,))


def vacuum(spark: SparkSession, table: Table, keep: int = 2) -> int:
    """Delete pointers but the last ``keep``, and parts that none of those lists; readers of older states end."""
    numbers = _pointer_numbers(spark, table)
    live = {p for n in numbers[-keep:] for p in _read_pointer(spark, table, n).parts}
    gone = 0
    for number in numbers[:-keep]:
        fs, p = _fs(spark, f"{table.path}/pointers/{number:010d}")
        fs.delete(p, False)
    for kind in ("data", "keys"):
        fs, p = _fs(spark, f"{table.path}/{kind}")
        for s in fs.listStatus(p) if fs.exists(p) else ():
            if s.getPath().getName() not in live:
                fs.delete(s.getPath(), True)
                gone += kind == "data"
    return gone

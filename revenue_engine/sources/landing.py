"""Landed headered CSV files as one distributed scan.

Semantics per file: the first record is the header; rows may be shorter or
longer than it; each header name maps to the field at its last header
position, present only when the row is wide enough; records are numbered
from 1 (the header) counting records, not lines; empty lines between records
are none; a quoted field may hold commas, doubled quotes and line breaks (a
carriage return before a line feed is dropped); a malformed record (stray or
unbalanced quote) fails the whole file, as does a header without every
required column or a file without any record.

Plan: the text is read once, into a staged table of (file, block, ordinal,
line); all passes work on that table, so neither the split layout of a later
read nor a file that lands meanwhile can change what they see.

* pass 1 aggregates one row per input split ``(file, block)``. Whether a line
  starts inside a quoted field depends on all quotes before it, but a split
  only turns that state over or keeps it: it turns it over if it holds an odd
  number of lines with an odd number of quotes. A running sum over that small
  table composes the splits and gives each its first state.
* splits that begin inside a field, hold a line that opens or closes one, or
  have empty lines are numbered line by line in a window over the split, at
  most one split's rows in a task. All other splits are *plain*: each line is
  a record, and its number is the split's offset plus its ordinal.
* pass 2 joins every staged line of a plain split to its block row. A line
  without one stops the job. Lines of records that span lines, also over split
  edges, share the record's number and are put together by it. Files with a
  malformed record are found before that, so a stray quote cannot make the
  rest of a file one record.

A file that holds a third of all rows is therefore split across as many
tasks as it has blocks; no step gathers one file into one task.
"""

from __future__ import annotations

import re
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from revenue_engine.session import drop_stored, listing_parallelism, stored

# The columns every revenue file must carry (exact case).
REQUIRED_COLUMNS = ("date", "revenue", "currency")

# One CSV field: a quoted field with doubled quotes inside, or a run without
# quotes and commas. Possessive quantifiers keep very long fields from
# exhausting the regex stack.
_FIELD = r'(?:"[^"]*+(?:""[^"]*+)*+"|[^",]*+)'
WELL_FORMED = rf"^{_FIELD}(?:,{_FIELD})*+$"
_TOKEN = rf",({_FIELD})"
# Lines of a record that spans lines: its first, one that closes its quoted field, one that closes it and opens
# another, and one inside a field.
_INSIDE = r'[^"]*+(?:""[^"]*+)*+'
OPENS = rf'^(?:{_FIELD},)*+"{_INSIDE}\z'
CLOSES = rf'^{_INSIDE}"(?:,{_FIELD})*+\z'
REOPENS = rf'^{_INSIDE}"(?:,{_FIELD}(?=,))*+,"{_INSIDE}\z'
WITHIN = rf'^{_INSIDE}\z'

# File outcome states and reasons.
EMPTY_FILE = "empty_file"
MALFORMED_HEADER = "malformed_header"
MISSING_COLUMN = "missing_required_column"
MALFORMED_RECORD = "malformed_record"


def csv_fields(line) -> Column:
    """Fields of one well-formed CSV record, quotes removed."""
    line = F.col(line) if isinstance(line, str) else line
    toks = F.regexp_extract_all(F.concat(F.lit(","), line), F.lit(_TOKEN), 1)
    return F.transform(toks, lambda t: F.when(
        t.startswith('"'), F.replace(F.substring(t, F.lit(2), F.length(t) - 2), F.lit('""'), F.lit('"'))
    ).otherwise(t))


def last_positions(header: Column) -> Column:
    """(name, position) of each header name, at its last position; computed once per block row."""
    e = F.transform(header, lambda k, i: F.struct(k.alias("k"), i.alias("i")))
    return F.filter(e, lambda z: ~F.exists(e, lambda y: (y["k"] == z["k"]) & (y["i"] > z["i"])))


def header_map(columns: Column, fields: Column) -> Column:
    """name → field for the positions inside the row."""
    keep = F.filter(columns, lambda z: z["i"] < F.size(fields))
    return F.map_from_entries(F.transform(keep, lambda z: F.struct(z["k"], F.get(fields, z["i"]))))


def decoded_path(path: Column) -> Column:
    """File metadata percent-encodes paths; this is the path as it is."""
    return F.try_url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def read_lines(spark: SparkSession, paths) -> DataFrame:
    """Physical lines with file, split offset and an ordinal without gaps inside a split."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    with listing_parallelism(spark):
        text = spark.read.option("lineSep", "\n").option("recursiveFileLookup", "true").text(paths)
    raw = (text.select(F.col("value"), decoded_path(F.col("_metadata.file_path")).alias("file_path"),
                   F.col("_metadata.file_block_start").alias("block_start")))
    line = F.when(F.col("value").endswith("\r"), F.expr("substring(value, 1, length(value) - 1)")
                  ).otherwise(F.col("value"))
    return raw.select(line.alias("line"), "file_path", "block_start", F.monotonically_increasing_id().alias("mid"))


def _odd_quotes() -> Column:
    return F.regexp_count("line", F.lit('"')) % 2 == 1


def split_table(lines: DataFrame) -> DataFrame:
    """Pass 1: one row per split: what it counts, and whether it starts inside a quoted field."""
    blank, odd = F.col("line") == "", _odd_quotes()
    bad = ~blank & ~odd & ~F.col("line").rlike(WELL_FORMED)
    splits = (lines.groupBy("file_path", "block_start")
              .agg(F.count_if(~blank).alias("n_lines"), F.min("mid").alias("m0"),
                   F.min_by("line", F.when(~blank, F.col("mid"))).alias("first_line"),
                   F.min(F.when(bad, F.col("mid"))).alias("bad_mid"),
                   F.count_if(blank).alias("n_blank"), F.count_if(odd).alias("n_odd")))
    by_file = Window.partitionBy("file_path")
    before = by_file.orderBy("block_start").rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("n_odd").over(before), F.lit(0)) % 2 == 1
    return (splits.withColumn("inside", inside)
            .withColumn("unclosed", F.sum("n_odd").over(by_file) % 2 == 1)
            .withColumn("plain", ~inside & (F.col("n_odd") == 0) & (F.col("n_blank") == 0)))


def spanning_lines(lines: DataFrame, splits: DataFrame) -> DataFrame:
    """Lines of the splits that are not plain: ``inside`` and ``stays`` say whether a line starts and ends inside a
    field, ``local`` numbers the record it belongs to in its split (0: begun in an earlier one)."""
    touched = lines.join(splits.where(~F.col("plain")).select("file_path", "block_start", F.col("inside").alias("_first")),
                         ["file_path", "block_start"])
    # Both windows cover one split, which the reader bounds.
    upto = Window.partitionBy("file_path", "block_start").orderBy("mid").rowsBetween(Window.unboundedPreceding, 0)
    odd = _odd_quotes()
    turns = F.sum(F.when(odd, 1).otherwise(0)).over(upto) + F.col("_first").cast("int")
    state = (touched.withColumn("stays", turns % 2 == 1)
             .withColumn("inside", F.col("stays") != odd)
             .withColumn("local", F.count_if(~F.col("inside") & (F.col("line") != "")).over(upto)))
    fits = (F.when(~F.col("inside") & ~F.col("stays"), F.col("line").rlike(WELL_FORMED))
            .when(~F.col("inside"), F.col("line").rlike(OPENS))
            .when(~F.col("stays"), F.col("line").rlike(CLOSES))
            .otherwise(F.col("line").rlike(WITHIN) | F.col("line").rlike(REOPENS)))
    return (state.where(F.col("inside") | (F.col("line") != ""))
            .select("file_path", "block_start", "mid", "line", "inside", "stays", "local", (~fits).alias("bad")))


def _stitched(parts: DataFrame, *keys) -> DataFrame:
    """``line``: the lines of each record, put together in order."""
    each = F.array_sort(F.collect_list(F.struct("block_start", "mid", "line")))
    return parts.groupBy(*keys).agg(F.array_join(F.transform(each, lambda x: x["line"]), "\n").alias("line"))


def block_table(lines: DataFrame, required=REQUIRED_COLUMNS, splits: DataFrame | None = None,
                spanning: DataFrame | None = None) -> DataFrame:
    """One row per (file, block) with offsets, header and file verdict; ``splits`` and ``spanning`` may be given stored."""
    splits = split_table(lines) if splits is None else splits
    spanning = spanning_lines(lines, splits) if spanning is None else spanning
    counts = spanning.groupBy("file_path", "block_start").agg(
        F.max("local").alias("n_begun"), F.min(F.when(F.col("bad"), F.col("local"))).alias("bad_local"))
    by_file = Window.partitionBy("file_path")
    ordered = by_file.orderBy("block_start")
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    b = (splits.join(counts, ["file_path", "block_start"], "left")
         .withColumn("n_rec", F.when(F.col("plain"), F.col("n_lines")).otherwise(F.coalesce("n_begun", F.lit(0))))
         .withColumn("rec_offset", F.coalesce(F.sum("n_rec").over(before), F.lit(0)))
         .withColumn("first_line", F.first("first_line", ignorenulls=True).over(
             ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
         .withColumn("n_records", F.sum("n_rec").over(by_file))
         .where(F.col("n_records") > 0)
         .withColumn("bad_line", F.col("rec_offset") + F.when(F.col("plain"), F.col("bad_mid") - F.col("m0") + 1)
                     .otherwise(F.col("bad_local")))
         .withColumn("first_bad_line", F.coalesce(F.min("bad_line").over(by_file),
                                                  F.when(F.col("unclosed"), F.col("n_records")))))
    header_ok = F.col("first_bad_line").isNull() | (F.col("first_bad_line") > 1)
    # A header of several lines: those of record 1, unless it is malformed.
    first = spanning.join(b.where(header_ok & (F.col("rec_offset") < 2)).select("file_path", "block_start", "rec_offset"),
                          ["file_path", "block_start"])
    whole = _stitched(first.where((F.col("rec_offset") + F.col("local") == 1) & (F.col("inside") | F.col("stays"))),
                      "file_path").withColumnRenamed("line", "whole")
    b = b.join(whole, "file_path", "left")
    header = F.when(header_ok, csv_fields(F.coalesce("whole", "first_line")))
    missing = F.array_except(F.array(*[F.lit(c) for c in required]), F.coalesce(header, F.array()))
    reason = (F.when(~header_ok, F.lit(MALFORMED_HEADER))
              .when(F.size(missing) > 0, F.lit(MISSING_COLUMN))
              .when(F.col("first_bad_line").isNotNull(), F.lit(MALFORMED_RECORD)))
    return (b.withColumn("header", header)
            .withColumn("columns", last_positions(F.col("header")))
            .withColumn("fail_reason", reason)
            .select("file_path", "block_start", "plain", "n_rec", "m0", "rec_offset", "header", "columns",
                    "n_records", "first_bad_line", "fail_reason"))


def file_outcomes(blocks: DataFrame, manifest: DataFrame | None = None) -> DataFrame:
    """One row per file — ``completed`` or ``failed`` with the reason.

    ``n_data_rows`` counts the data records before the first malformed one, at
    which reading ends; where fields may hold line breaks, what follows a stray
    quote has no defined number of records.
    Files without any record produce no text rows; pass the manifest
    (``list_files``) so they are reported as failed ``empty_file``.
    """
    per_file = (blocks.groupBy("file_path")
                .agg(F.first("n_records").alias("n_records"), F.first("first_bad_line").alias("first_bad_line"),
                     F.first("fail_reason").alias("fail_reason")))
    if manifest is not None:
        per_file = manifest.select("file_path").join(per_file, "file_path", "left")
    reason = F.when(F.col("n_records").isNull(), F.lit(EMPTY_FILE)).otherwise(F.col("fail_reason"))
    return (per_file.withColumn("reason", reason)
            .select("file_path",
                    F.when(F.col("reason").isNull(), F.lit("completed")).otherwise(F.lit("failed")).alias("status"),
                    "reason",
                    F.greatest(F.coalesce(F.least(F.col("n_records"), F.col("first_bad_line") - 1) - 1, F.lit(0)), F.lit(0))
                    .cast("long").alias("n_data_rows"),
                    "first_bad_line"))


def materialize_blocks(blocks: DataFrame) -> DataFrame:
    """The block table written once: later passes and a lost executor re-read it instead of running pass 1 again."""
    return stored(blocks, "csv-blocks")


def stage_lines(lines: DataFrame) -> DataFrame:
    """The text read once: ordinals and split offsets are fixed from here on."""
    return stored(lines, "csv-lines")


def number_lines(lines: DataFrame, blocks: DataFrame) -> DataFrame:
    """Pass 2: exact record number and file header on every line of a plain split.

    ``lines`` must be the rows that ``blocks`` was made of. A line without a
    block row, or outside its block's recorded range, stops the job instead of
    being lost or numbered wrongly.
    """
    b = blocks.select("file_path", "block_start", "plain", "n_rec", "m0", "rec_offset", "columns", "fail_reason")
    j = lines.where(F.col("line") != "").join(b, ["file_path", "block_start"], "left").where(F.coalesce("plain", F.lit(True)))
    local = F.col("mid") - F.col("m0")
    guard = F.when(F.col("n_rec").isNull() | (local < 0) | (local >= F.col("n_rec")),
                   F.raise_error(F.lit("split re-read does not match pass 1")))
    return (j.withColumn("line_number", F.coalesce(guard.cast("long"), F.col("rec_offset") + local + 1))
            .select("file_path", "line_number", "line", "columns", "fail_reason"))


def spanning_records(spanning: DataFrame, blocks: DataFrame) -> DataFrame:
    """Pass 2 for the other splits: records of one line as they are, those of several lines put together."""
    offsets = blocks.where(F.col("fail_reason").isNull()).select("file_path", "block_start", "rec_offset")
    numbered = (spanning.join(offsets, ["file_path", "block_start"])
                .withColumn("line_number", F.col("rec_offset") + F.col("local")))
    several = F.col("inside") | F.col("stays")
    records = (numbered.where(~several).select("file_path", "line_number", "line")
               .unionByName(_stitched(numbered.where(several), "file_path", "line_number")))
    heads = blocks.where(F.col("rec_offset") == 0).groupBy("file_path").agg(
        F.any_value("columns").alias("columns"), F.any_value("fail_reason").alias("fail_reason"))
    return records.join(heads, "file_path")


def scan_landed_csv(spark: SparkSession, paths, required=REQUIRED_COLUMNS):
    """Data records of every file that did not fail, plus the block table.

    Returns ``(rows, blocks)``: ``rows`` has ``file_path, line_number,
    payload map<string,string>``; ``blocks`` feeds ``file_outcomes``. Both
    read scratch tables: ``drop_scan`` deletes them once the rows are written.
    """
    lines = stage_lines(read_lines(spark, paths))
    splits = stored(split_table(lines), "csv-splits")
    spans = not splits.where(~F.col("plain")).isEmpty()
    spanning = stored(spanning_lines(lines, splits) if spans else spanning_lines(lines, splits).limit(0), "csv-spanning")
    blocks = materialize_blocks(block_table(lines, required, splits, spanning))
    drop_stored(splits)
    numbered = number_lines(lines, blocks)
    if spans:
        numbered = numbered.unionByName(spanning_records(spanning, blocks))
    # Fields are a column of their own, so that a row is parsed once and not once per header name.
    rows = (numbered.where((F.col("line_number") > 1) & F.col("fail_reason").isNull())
            .withColumn("fields", csv_fields("line"))
            .select("file_path", "line_number", header_map(F.col("columns"), F.col("fields")).alias("payload")))
    rows._stored = lines._stored + spanning._stored
    return rows, blocks


def drop_scan(rows: DataFrame, blocks: DataFrame) -> None:
    """Delete the staged text and tables of a scan, once what was made of it is written."""
    drop_stored(rows, blocks)


def list_files(spark: SparkSession, paths) -> DataFrame:
    """Every file with size and modification time, without reading content.

    Scans skip zero-byte files, so the path list comes from the file index
    the driver already holds for planning (``inputFiles``); sizes and times
    of non-empty files come from the ``binaryFile`` metadata columns.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    with listing_parallelism(spark):
        listing = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths)
    meta = listing.select(F.col("path").alias("file_path"), F.col("length").alias("size"),
                          F.col("modificationTime").alias("modified_at"))
    every = spark.createDataFrame([(_scan_path_form(p),) for p in listing.inputFiles()], "file_path string")
    return (every.join(meta, "file_path", "left")
            .select("file_path", F.coalesce(F.col("size"), F.lit(0).cast("long")).alias("size"), "modified_at"))


def _scan_path_form(uri: str) -> str:
    """``inputFiles`` gives URIs (``file:///x``, percent-encoded); scans give ``file:/x``."""
    uri = unquote(uri)
    return re.sub(r"^([A-Za-z][A-Za-z0-9+.-]*):///", r"\1:/", uri)


def payload_field(name: str) -> Column:
    """A payload value; a key missing from a short row reads as ``''``."""
    return F.coalesce(F.try_element_at(F.col("payload"), F.lit(name)), F.lit(""))

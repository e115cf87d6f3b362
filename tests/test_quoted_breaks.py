"""Quoted line breaks: records over lines and split edges, against Python's CSV reader."""

import csv
import io

from pyspark.sql import functions as F

from revenue_engine.sources import landing as ld
from tests.conftest import write_file


def scan(spark, root):
    rows, blocks = ld.scan_landed_csv(spark, root)
    outcomes = {r.file_path.rsplit("/", 1)[1]: r for r in ld.file_outcomes(blocks, ld.list_files(spark, root)).collect()}
    data = {}
    for r in rows.collect():
        data.setdefault(r.file_path.rsplit("/", 1)[1], []).append((r.line_number, dict(r.payload)))
    return {k: sorted(v, key=lambda x: x[0]) for k, v in data.items()}, outcomes


def expected(text):
    records = [r for r in csv.reader(io.StringIO(text.replace("\r\n", "\n"), newline="")) if r]
    return [(i, dict(zip(records[0], r))) for i, r in enumerate(records[1:], 2)]


HEAD = "date,revenue,currency,note\n"
GOOD = {
    "break.csv": HEAD + '2026-02-15,1,USD,"two\nlines"\n2026-02-15,2,USD,plain\n',
    "blank_inside.csv": HEAD + '\n2026-02-15,1,USD,"a\n\n\nb"\n\n\n2026-02-15,2,USD,x\n',
    "reopen.csv": HEAD + '2026-02-15,"1\n",USD,"a ""q"",\nb"\n"2\n","3,""\n",USD,"\n"\n',
    "crlf.csv": HEAD.replace("\n", "\r\n") + '2026-02-15,1,USD,"x\r\ny"\r\n2026-02-15,2,USD,z\r\n',
    "head.csv": 'date,revenue,currency,"no\nte"\n2026-02-15,1,USD,v\n',
    "only_quotes.csv": HEAD + '"","","",""""\n2026-02-15,1,USD,"""\n"""\n',
    "no_last_break.csv": HEAD + '2026-02-15,1,USD,"end\n of file"',
}
BAD = {  # reason and first malformed record
    "unclosed.csv": (HEAD + '2026-02-15,1,USD,a\n2026-02-15,1,USD,"open\nx\ny\n', ld.MALFORMED_RECORD, 3),
    "junk_after.csv": (HEAD + '2026-02-15,1,USD,"a\nb"c\n2026-02-15,1,USD,d\n', ld.MALFORMED_RECORD, 2),
    "stray.csv": (HEAD + '2026-02-15,1,USD,ok\n2026-02-15,x"1,USD,a\n2026-02-15,1,USD,"b\nc"\n', ld.MALFORMED_RECORD, 3),
    "head_open.csv": ('date,revenue,currency,"note\n2026-02-15,1,USD,x\n', ld.MALFORMED_HEADER, 1),
    "head_missing.csv": ('date,revenue,"curr\nency"\n2026-02-15,1,USD\n', ld.MISSING_COLUMN, None),
}


def test_records_over_lines(spark, tmpdir_path):
    for name, text in GOOD.items():
        write_file(tmpdir_path, f"a/{name}", text)
    for name, (text, _, _) in BAD.items():
        write_file(tmpdir_path, f"b/{name}", text)
    data, out = scan(spark, tmpdir_path)
    for name, text in GOOD.items():
        assert data[name] == expected(text), name
        assert (out[name].status, out[name].n_data_rows) == ("completed", len(expected(text)))
    for name, (_, reason, line) in BAD.items():
        assert name not in data and (out[name].reason, out[name].first_bad_line) == (reason, line), name


def test_split_edges_at_every_offset(spark, tmpdir_path):
    """Files that differ by one byte in the header, so that edges cut the records everywhere."""
    texts = {}
    for pad in range(64):
        body = "".join(f'2026-02-15,{i},USD,"a\n{"b" * (i % 9)}\n\n""{i}"""\n\n2026-02-16,{i},EUR,"{"c" * (i % 5)}"\n' for i in range(3))
        texts[f"{pad}.csv"] = "date,revenue,currency,note" + "x" * pad + "\n" + body
        write_file(tmpdir_path, f"a/{pad}.csv", texts[f"{pad}.csv"])
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64")
    spark.conf.set("spark.sql.files.openCostInBytes", "8")
    try:
        data, out = scan(spark, tmpdir_path)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    for name, text in texts.items():
        assert data[name] == expected(text), name
        assert (out[name].status, out[name].n_data_rows) == ("completed", 6)


def test_one_field_over_many_splits(spark, tmpdir_path):
    field = "\n".join("line %d, with ""quotes" % i for i in range(3000))
    write_file(tmpdir_path, "a/x.csv", HEAD + f'2026-02-15,1,USD,"{field}"\n2026-02-15,2,USD,after\n')
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        data, out = scan(spark, tmpdir_path)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert [(n, p["note"]) for n, p in data["x.csv"]] == [(2, field), (3, "after")]


def test_a_stray_quote_does_not_join_the_rest_of_the_file(spark, tmpdir_path):
    """The failed file leaves before records are put together, whatever its quotes open."""
    write_file(tmpdir_path, "a/x.csv", HEAD + '2026-02-15,a"b,USD,x\n' + "2026-02-15,1,USD,y\n" * 5000)
    lines = ld.stage_lines(ld.read_lines(spark, tmpdir_path))
    splits = ld.split_table(lines)
    spanning = ld.spanning_lines(lines, splits)
    blocks = ld.block_table(lines, splits=splits, spanning=spanning)
    assert ld.spanning_records(spanning, blocks).count() == 0
    assert blocks.select(F.max("first_bad_line")).first()[0] == 2


def test_scratch_tables_are_deleted(spark, tmpdir_path):
    import os
    write_file(tmpdir_path, "a/x.csv", GOOD["break.csv"])
    rows, blocks = ld.scan_landed_csv(spark, tmpdir_path)
    paths = [p.removeprefix("file:") for p in rows._stored + blocks._stored]
    assert all(os.path.exists(p) for p in paths)
    ld.drop_scan(rows, blocks)
    assert not any(os.path.exists(p) for p in paths)

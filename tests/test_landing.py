"""Edge cases of the ragged CSV scan, written as real files."""

from pyspark.sql import functions as F

from revenue_engine.sources import landing as ld
from tests.conftest import write_file


def scan(spark, root):
    rows, blocks = ld.scan_landed_csv(spark, root)
    outcomes = {r.file_path.rsplit("/", 1)[1]: r for r in
                ld.file_outcomes(blocks, ld.list_files(spark, root)).collect()}
    data = {}
    for r in rows.collect():
        data.setdefault(r.file_path.rsplit("/", 1)[1], []).append((r.line_number, dict(r.payload)))
    return {k: sorted(v) for k, v in data.items()}, outcomes


def test_edge_cases(spark, tmpdir_path):
    root = tmpdir_path
    write_file(root, "a/good.csv", "date,revenue,currency,product\n2026-02-15,1000.00,USD,WidgetA\n\n"
                                   "2026-02-15,850.00,EUR,WidgetB\r\n")
    write_file(root, "a/no_currency.csv", "date,revenue,product\n2026-02-15,1,x\n")
    write_file(root, "a/case.csv", "Date,revenue,currency\n2026-02-15,1,USD\n")
    write_file(root, "a/empty.csv", "")
    write_file(root, "a/blank_only.csv", "\n\n")
    write_file(root, "a/header_only.csv", "date,revenue,currency\n")
    write_file(root, "a/short_long.csv", "date,revenue,currency,product\n2026-02-15,5\n"
                                         "2026-02-15,6,USD,p,extra,more\n")
    write_file(root, "a/dup.csv", "k,date,revenue,currency,k\n1,2026-02-15,5,USD\n1,2026-02-15,5,USD,3\n")
    write_file(root, "a/stray.csv", "date,revenue,currency\n2026-02-15,1,USD\na\"b,1,USD\n")
    write_file(root, "a/quoted.csv", 'date,revenue,currency,product\n2026-02-15,"1.5",USD,"a, ""b"""\n')
    data, out = scan(spark, root)

    assert out["good.csv"].status == "completed" and out["good.csv"].n_data_rows == 2
    # blank lines are not records: the second data record is record 3
    assert data["good.csv"] == [(2, {"date": "2026-02-15", "revenue": "1000.00", "currency": "USD", "product": "WidgetA"}),
                                (3, {"date": "2026-02-15", "revenue": "850.00", "currency": "EUR", "product": "WidgetB"})]
    assert out["no_currency.csv"].reason == ld.MISSING_COLUMN and "no_currency.csv" not in data
    assert out["case.csv"].reason == ld.MISSING_COLUMN
    assert out["empty.csv"].reason == ld.EMPTY_FILE
    assert out["blank_only.csv"].reason == ld.EMPTY_FILE
    assert out["header_only.csv"].status == "completed" and out["header_only.csv"].n_data_rows == 0
    assert data["short_long.csv"] == [(2, {"date": "2026-02-15", "revenue": "5"}),
                                      (3, {"date": "2026-02-15", "revenue": "6", "currency": "USD", "product": "p"})]
    # repeated header name: the last position wins, and only if the row reaches it
    assert data["dup.csv"] == [(2, {"date": "2026-02-15", "revenue": "5", "currency": "USD"}),
                               (3, {"date": "2026-02-15", "revenue": "5", "currency": "USD", "k": "3"})]
    assert out["stray.csv"].status == "failed" and out["stray.csv"].reason == ld.MALFORMED_RECORD
    assert out["stray.csv"].first_bad_line == 3 and "stray.csv" not in data
    assert data["quoted.csv"] == [(2, {"date": "2026-02-15", "revenue": "1.5", "currency": "USD", "product": 'a, "b"'})]


def test_line_numbers_across_splits(spark, tmpdir_path):
    """A file split over many tasks keeps exact record numbers."""
    lines = ["date,revenue,currency"] + [f"2026-02-15,{i},USD" if i % 5 else "" for i in range(1, 20001)]
    write_file(tmpdir_path, "big/one.csv", "\n".join(lines) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")
    try:
        rows, blocks = ld.scan_landed_csv(spark, tmpdir_path)
        assert blocks.count() > 10
        got = rows.select("line_number", F.col("payload")["revenue"].alias("rev")).orderBy("line_number").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    expected_revs = [str(i) for i in range(1, 20001) if i % 5]
    assert [r.rev for r in got] == expected_revs
    assert [r.line_number for r in got] == list(range(2, 2 + len(expected_revs)))

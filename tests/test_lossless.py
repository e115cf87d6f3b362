"""Rows survive changed settings, odd paths and repeated keys."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from revenue_engine.functions.parsing import parse_amount, parse_date
from revenue_engine.operators import rates as rt
from revenue_engine.operators.convert import classify_rows
from revenue_engine.sources import landing as ld
from revenue_engine.sources import rate_payloads as rp
from tests.conftest import write_file

DAY = dt.date(2026, 2, 15)
KEYS = ("spark.sql.leafNodeDefaultParallelism", "spark.sql.files.minPartitionNum",
        "spark.sql.files.openCostInBytes", "spark.sql.files.maxPartitionBytes")


@pytest.fixture()
def settings(spark):
    yield spark.conf
    for k in KEYS:
        spark.conf.unset(k)


@pytest.mark.parametrize("before,after", [((1, 1, "64m", "128m"), (16, 16, "1k", "64k")),
                                          ((16, 16, "1k", "64k"), (1, 1, "64m", "128m"))])
def test_scan_keeps_every_row_when_split_settings_change(spark, settings, tmpdir_path, before, after):
    n = 20_000
    write_file(tmpdir_path, "a/big.csv", "date,revenue,currency\n" + "".join(f"2026-02-15,{i},USD\n" for i in range(n)))
    for k, v in zip(KEYS, before):
        settings.set(k, str(v))
    rows, _ = ld.scan_landed_csv(spark, tmpdir_path)
    write_file(tmpdir_path, "a/late.csv", "date,revenue,currency\n2026-02-15,1,USD\n")
    for k, v in zip(KEYS, after):
        settings.set(k, str(v))
    r = rows.agg(F.count(F.lit(1)).alias("n"), F.min("line_number").alias("lo"), F.max("line_number").alias("hi"),
                 F.count_if(F.col("payload.revenue").cast("long") != F.col("line_number") - 2).alias("wrong")).first()
    assert (r.n, r.lo, r.hi, r.wrong) == (n, 2, n + 1, 0)


def test_line_without_a_block_row_stops_the_job(spark, tmpdir_path):
    write_file(tmpdir_path, "a/x.csv", "date,revenue,currency\n2026-02-15,1,USD\n")
    lines = ld.read_lines(spark, tmpdir_path)
    blocks = ld.block_table(lines).where(F.lit(False))
    with pytest.raises(Exception, match="does not match"):
        ld.number_lines(lines, blocks).collect()


def test_paths_with_blanks_percent_and_plus_agree(spark, tmpdir_path):
    names = ["my source", "a%20b", "c+d"]
    for n in names:
        write_file(tmpdir_path, f"{n}/2026-02-15.csv", "date,revenue,currency\n2026-02-15,1,USD\n")
    rows, blocks = ld.scan_landed_csv(spark, tmpdir_path)
    out = ld.file_outcomes(blocks, ld.list_files(spark, tmpdir_path)).collect()
    assert sorted(r.file_path.split("/")[-2] for r in rows.collect()) == sorted(names)
    assert [(r.status, r.n_data_rows) for r in out] == [("completed", 1)] * 3


def test_wide_rows_keep_the_last_of_repeated_names(spark, tmpdir_path):
    head = ["date", "revenue", "currency"] + [f"c{i % 30}" for i in range(60)]
    row = ["2026-02-15", "1", "USD"] + [str(i) for i in range(60)]
    write_file(tmpdir_path, "a/w.csv", ",".join(head) + "\n" + ",".join(row) + "\n" + ",".join(row[:40]) + "\n")
    rows, _ = ld.scan_landed_csv(spark, tmpdir_path)
    full, short = [dict(r.payload) for r in rows.orderBy("line_number").collect()]
    assert full["c0"] == "30" and full["c29"] == "59" and len(full) == 33
    assert short["c0"] == "30" and "c29" not in short  # its last position lies outside the short row


def test_line_ends_are_no_part_of_an_amount_or_date(spark):
    df = spark.createDataFrame([("7.5\r",), ("7.5\n",), ("7.5",)], "s string")
    assert [r[0] for r in df.select(parse_amount("s")).collect()] == [None, None, 7.5]
    df = spark.createDataFrame([("2026-02-15\n",), ("2026-02-15",)], "s string")
    assert [r[0] for r in df.select(parse_date("s")).collect()] == [None, DAY]


def test_lookup_gives_the_same_rows_above_and_below_the_broadcast_bound(spark):
    raw = spark.createDataFrame([("2026-02-15", "abc", "USD"), ("2026-02-15", "2", "USD"), ("x", "1", None)],
                                "date_s string, revenue_s string, currency_s string")
    rates = spark.createDataFrame([("USD", DAY, 1.0)], "currency string, rate_date date, rate_to_usd double")
    got = [sorted(map(tuple, classify_rows(raw, rates, max_broadcast_rows=m).collect()), key=str) for m in (0, 10)]
    assert got[0] == got[1]


def test_payload_without_rates_still_writes_the_base_row(spark):
    payloads = spark.createDataFrame([(1, "USD", "2026-02-15", {}), (2, "USD", "2026-02-16", {"EUR": None, "GBP": 0.5})],
                                     "fetch_seq int, base string, date string, rates map<string,double>")
    api = rp.explode_rates(payloads, keep_empty=True)
    inc = {(r.currency, str(r.rate_date)): r.rate_to_usd for r in rt.incoming_rates(api).collect()}
    assert inc == {("USD", "2026-02-15"): 1.0, ("USD", "2026-02-16"): 1.0, ("GBP", "2026-02-16"): 2.0}
    stats = {r.fetch_seq: (r.rates_received, r.rates_upserted, r.rates_skipped) for r in rt.rate_load_stats(api).collect()}
    assert stats == {1: (0, 1, 0), 2: (2, 2, 1)}


def test_seed_with_repeated_keys_inserts_each_key_once(spark):
    cols = "currency string, rate_date date, rate_to_usd double"
    cur = spark.createDataFrame([("USD", DAY, 1.0)], cols)
    seed = spark.createDataFrame([("EUR", DAY, 1.08), ("EUR", DAY, 1.09), ("USD", DAY, 2.0)], cols)
    got = sorted(map(tuple, rt.insert_absent(cur, seed).collect()))
    assert got == [("EUR", DAY, 1.08), ("USD", DAY, 1.0)]

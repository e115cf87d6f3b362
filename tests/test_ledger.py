import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from revenue_engine.operators import ledger as lg
from revenue_engine.operators.ordering import global_row_number

AS_OF = "2026-02-15 12:00:00"


def files_df(spark):
    return spark.createDataFrame([
        ("f1", "s1", dt.date(2026, 2, 15), "processing", "c1", dt.datetime(2026, 2, 15, 11, 25)),  # 35 min: stuck
        ("f2", "s1", dt.date(2026, 2, 14), "processing", "c2", dt.datetime(2026, 2, 15, 11, 45)),  # 15 min
        ("f3", "s2", dt.date(2026, 2, 15), "completed", "c3", dt.datetime(2026, 2, 15, 9, 0)),
        ("f4", "s9", dt.date(2026, 2, 15), "downloaded", "c4", dt.datetime(2026, 2, 15, 9, 0)),
    ], "file_id string, source_id string, file_date date, status string, checksum string, created_at timestamp")


def test_stuck_scenario(spark):
    files = files_df(spark)
    events = spark.createDataFrame([("f1", "downloaded", 1), ("f1", "processing", 2)],
                                   "file_id string, status string, seq int")
    sources = spark.createDataFrame([("s1", "sample_revenue", "csv", True)],
                                    "source_id string, name string, file_type string, active boolean")
    out = lg.requeue_stuck(files, events, sources, AS_OF).collect()
    assert [(r.file_id, r.status, r.seq) for r in out] == [("f1", "downloaded", 3)]
    assert '"file_path":"/data/sample_revenue/2026-02-15.csv"' in out[0].job_json
    assert lg.stuck_count(files, AS_OF).first().n_stuck == 1
    assert [r.file_id for r in lg.orphan_files(files, sources).collect()] == ["f3", "f4"]


def test_register_first_wins_and_due(spark):
    ledger = files_df(spark)
    cand = spark.createDataFrame([("s1", dt.date(2026, 2, 16), 5, "x5"), ("s1", dt.date(2026, 2, 16), 3, "x3"),
                                  ("s2", dt.date(2026, 2, 15), 1, "y1")],
                                 "source_id string, file_date date, arrival int, checksum string")
    out = {r.file_id: (r.winner, r.checksum, r.n_candidates, r.outcome)
           for r in lg.register_files(cand, ledger, "arrival").collect()}
    assert out == {"s1/2026-02-16": (3, "x3", 2, "registered"), "s2/2026-02-15": (1, "y1", 1, "already_registered")}
    sources = spark.createDataFrame([("s1", "a", True), ("s2", "b", True), ("s3", "c", None)],
                                    "source_id string, name string, active boolean")
    assert [r.source_id for r in lg.sources_due(sources, ledger, "2026-02-15").collect()] == []
    assert sorted(r.source_id for r in lg.sources_due(sources, ledger, "2026-02-16").collect()) == ["s1", "s2"]


def test_global_row_number_matches_window(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5000).alias("k"), F.col("id"))
    ours = global_row_number(df, ["k", "id"], num_partitions=7)
    ref = df.withColumn("position", F.row_number().over(Window.orderBy("k", "id")))
    assert ours.exceptAll(ref.select(*ours.columns)).count() == 0
    assert ours.count() == 5000


def test_throughput(spark):
    ev = spark.createDataFrame([
        ("f1", "downloaded", dt.datetime(2026, 2, 15, 10, 0, 0)),
        ("f1", "processing", dt.datetime(2026, 2, 15, 10, 0, 0)),
        ("f1", "completed", dt.datetime(2026, 2, 15, 10, 0, 2)),
        ("f2", "processing", dt.datetime(2026, 2, 15, 10, 0, 0)),  # still running: no row
    ], "file_id string, status string, at timestamp")
    stats = spark.createDataFrame([("f1", 15000, 5000), ("f2", 1, 0)],
                                  "file_id string, total_rows long, skipped_rows long")
    out = lg.throughput(ev, stats).collect()
    assert [(r.file_id, r.seconds, r.rows, r.rows_per_sec) for r in out] == [("f1", 2.0, 20000, 10000.0)]


def test_every_constraint_check_fires(spark):
    from revenue_engine.operators import ledger as lg
    sources = spark.createDataFrame([("s1", "a", "u", "csv", "0"), ("s1", None, "u", "csv", "0"), (None, "c", None, None, None)],
                                    "source_id string, name string, download_url string, file_type string, schedule_time string")
    files = spark.createDataFrame([("f1", "s1", "2026-01-01", "completed"), ("f2", "s1", "2026-01-01", "odd"), ("f2", "s1", None, None),
                                   (None, None, "2026-01-02", "failed"), (None, "s2", "2026-01-02", "failed")],
                                  "file_id string, source_id string, file_date string, status string")
    rates = spark.createDataFrame([("EUR", "d", 1.0), ("EUR", "d", 2.0), ("EUR", "d", 3.0), (None, "d", 1.0), ("d", None, None)],
                                  "currency string, rate_date string, rate_to_usd double")
    got = sorted((r.table_name, r.constraint_name, r.key, r.n_rows) for r in lg.constraint_violations(sources, files, rates).collect())
    assert got == sorted([
        ("sources", "sources_pk", "s1", 2), ("sources", "name_not_null", "s1", 1), ("sources", "source_id_not_null", "", 1),
        ("sources", "download_url_not_null", "", 1), ("sources", "file_type_not_null", "", 1), ("sources", "schedule_time_not_null", "", 1),
        ("files", "files_pk", "f2", 2), ("files", "files_pk", "", 2), ("files", "files_source_date_unique", "s1|2026-01-01", 2),
        ("files", "status_domain", "f2", 1), ("files", "file_date_not_null", "f2", 1), ("files", "status_not_null", "f2", 1),
        ("files", "file_id_not_null", "", 1), ("files", "file_id_not_null", "", 1), ("files", "source_id_not_null", "", 1),
        ("exchange_rates", "exchange_rates_pk", "EUR|d", 3), ("exchange_rates", "currency_not_null", "d", 1),
        ("exchange_rates", "rate_date_not_null", "d", 1), ("exchange_rates", "rate_to_usd_not_null", "d", 1)])
    plan = lg.constraint_violations(sources, files, rates)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") + plan.count("LocalRelation") == 3

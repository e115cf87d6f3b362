"""Stream equals batch, fresh rates per micro-batch, replay is idempotent."""

import datetime as dt

from pyspark.sql import functions as F

from revenue_engine.operators import maintenance as mt
from revenue_engine.streaming import ingest as si
from tests.conftest import write_file

D1, D2 = dt.date(2026, 2, 15), dt.date(2026, 2, 16)


def keys(df):
    return (df.withColumn("source_id", F.regexp_extract("file_path", r"/([^/]+)/[^/]+$", 1))
            .withColumn("file_date", F.try_to_date(F.regexp_extract("file_path", r"([0-9-]{10})\.csv$", 1))))


def test_stream_ingest(spark, tmpdir_path):
    landing = tmpdir_path + "/landing"
    for i in range(5):
        write_file(landing, f"src{i}/2026-02-15.csv",
                   "date,revenue,currency\n2026-02-15,100,EUR\n2026-02-16,50,EUR\n2026-02-15,7,XXX\n")
    rates_path = tmpdir_path + "/rates"
    spark.createDataFrame([("EUR", 1.1, D1)], "currency string, rate_to_usd double, rate_date date") \
        .write.parquet(rates_path)
    table = tmpdir_path + "/revenues"
    loader = lambda: spark.read.parquet(rates_path)

    q = si.start_ingest(spark, landing, loader, table, tmpdir_path + "/ck1", keys,
                        max_files_per_trigger=2, available_now=True)
    q.awaitTermination()
    assert q.lastProgress is not None
    assert mt.read_revenues(spark, table).count() == 5          # only 2026-02-15 EUR has a rate

    # R2: a rate loaded later is seen by the next micro-batch
    spark.createDataFrame([("EUR", 1.2, D2)], "currency string, rate_to_usd double, rate_date date") \
        .write.mode("append").parquet(rates_path)
    write_file(landing, "src9/2026-02-15.csv", "date,revenue,currency\n2026-02-16,10,EUR\n")
    q = si.start_ingest(spark, landing, loader, table, tmpdir_path + "/ck1", keys, available_now=True)
    q.awaitTermination()
    assert mt.read_revenues(spark, table).count() == 6

    # Replay everything with a fresh checkpoint — partitions are replaced, no duplicates
    q = si.start_ingest(spark, landing, loader, table, tmpdir_path + "/ck2", keys, available_now=True)
    q.awaitTermination()
    back = mt.read_revenues(spark, table)
    assert back.count() == 11  # files re-read now see the 2026-02-16 rate as well
    assert back.select("revenue_id").distinct().count() == 11


def test_glob_characters_in_folder_names(spark, tmpdir_path):
    landing = tmpdir_path + "/landing"
    for name in ("a[1]", "a1", "b{x}*"):
        write_file(landing, f"{name}/2026-02-15.csv", "date,revenue,currency\n2026-02-15,100,EUR\n")
    rates = spark.createDataFrame([("EUR", 1.1, D1)], "currency string, rate_to_usd double, rate_date date")
    table = tmpdir_path + "/revenues"
    q = si.start_ingest(spark, landing, lambda: rates, table, tmpdir_path + "/ck", keys, available_now=True)
    q.awaitTermination()
    assert {r.source_id for r in mt.read_revenues(spark, table).collect()} == {"a[1]", "a1", "b{x}*"}


def _run(spark, tmp, landing, ck, **kw):
    rates = spark.createDataFrame([("EUR", 1.1, D1)], "currency string, rate_to_usd double, rate_date date")
    q = si.start_ingest(spark, landing, lambda: rates, tmp + "/table", tmp + ck, keys, outcomes_path=tmp + "/outcomes",
                        events_path=tmp + "/events", available_now=True, **kw)
    q.awaitTermination()


def test_first_file_of_a_key_wins_across_batches(spark, tmpdir_path):
    import os
    landing = tmpdir_path + "/landing"
    first = write_file(landing, "x/src1/2026-02-15.csv", "date,revenue,currency\n2026-02-15,1,EUR\n")
    os.utime(first, (1_000_000_000, 1_000_000_000))
    write_file(landing, "x/nodate.csv", "date,revenue,currency\n2026-02-15,9,EUR\n")
    _run(spark, tmpdir_path, landing, "/ck")
    write_file(landing, "y/src1/2026-02-15.csv", "date,revenue,currency\n2026-02-15,2,EUR\n2026-02-15,3,EUR\n")
    write_file(landing, "y/src2/2026-02-15.csv", 'date,revenue,currency\n2026-02-15,a"b,EUR\n')
    _run(spark, tmpdir_path, landing, "/ck")
    assert [r.original_value for r in mt.read_revenues(spark, tmpdir_path + "/table").collect()] == [1.0]
    out = {r.file_path.split("/landing/")[1]: (r.status, r.reason) for r in si.read_outcomes(spark, tmpdir_path + "/outcomes").collect()}
    assert out == {"x/src1/2026-02-15.csv": ("completed", None), "x/nodate.csv": ("failed", si.BAD_PATH),
                   "y/src1/2026-02-15.csv": ("failed", si.DUPLICATE), "y/src2/2026-02-15.csv": ("failed", "malformed_record")}
    events = si.read_events(spark, tmpdir_path + "/events")
    from revenue_engine.operators import ledger as lg
    assert {r.file_id: r.status for r in lg.current_status(events).collect()} == {"src1/2026-02-15": "completed", "src2/2026-02-15": "failed"}
    assert sorted(r.status for r in events.where("file_id like 'src1%'").collect()) == ["completed", "downloaded", "processing"]


def test_a_repeated_batch_leaves_one_outcome_per_file(spark, tmpdir_path):
    path = write_file(tmpdir_path + "/landing", "src1/2026-02-15.csv", "date,revenue,currency\n2026-02-15,1,EUR\n")
    rates = spark.createDataFrame([("EUR", 1.1, D1)], "currency string, rate_to_usd double, rate_date date")
    decided = spark.createDataFrame([("file:" + path, "src1", D1, "file:" + path)], si.DECISION_SCHEMA)
    for _ in range(2):  # killed after its writes and run again
        si.ingest_batch(spark, decided, rates, tmpdir_path + "/table", keys, tmpdir_path + "/outcomes", tmpdir_path + "/events", epoch=4)
    assert si.read_outcomes(spark, tmpdir_path + "/outcomes").count() == 1
    assert si.read_events(spark, tmpdir_path + "/events").count() == 3
    assert mt.read_revenues(spark, tmpdir_path + "/table").count() == 1


def test_a_replay_that_accepts_nothing_clears_the_file(spark, tmpdir_path):
    path = write_file(tmpdir_path + "/landing", "src1/2026-02-15.csv", "date,revenue,currency\n2026-02-15,1,EUR\n")
    rates = spark.createDataFrame([("EUR", 1.1, D1)], "currency string, rate_to_usd double, rate_date date")
    decided = spark.createDataFrame([("file:" + path, "src1", D1, "file:" + path)], si.DECISION_SCHEMA)
    for r, n in ((rates, 1), (rates.limit(0), 0)):
        si.ingest_batch(spark, decided, r, tmpdir_path + "/table", keys)
        assert mt.read_revenues(spark, tmpdir_path + "/table").count() == n

"""The documented end-to-end example: three rows, golden USD values, stats 3 / 0."""

import datetime as dt

from revenue_engine.operators import convert as cv
from revenue_engine.operators import maintenance as mt
from revenue_engine.sources import landing as ld
from tests.conftest import write_file

DAY = dt.date(2026, 2, 15)


def test_golden(spark, tmpdir_path):
    write_file(tmpdir_path, "landing/sample_revenue/2026-02-15.csv",
               "date,revenue,currency,product\n2026-02-15,1000.00,USD,WidgetA\n"
               "2026-02-15,850.00,EUR,WidgetB\n2026-02-15,500.00,GBP,WidgetC\n")
    rates = spark.createDataFrame(
        [("USD", 1.0, DAY), ("EUR", 1.08, DAY), ("GBP", 1.27, DAY), ("INR", 0.012, DAY), ("JPY", 0.0067, DAY)],
        "currency string, rate_to_usd double, rate_date date")
    rows, _ = ld.scan_landed_csv(spark, tmpdir_path + "/landing")
    from pyspark.sql import functions as F
    keyed = rows.withColumn("source_id", F.lit("sample")).withColumn("file_date", F.lit(DAY))
    classified = mt.classify_payload_rows(keyed, rates)
    got = {r.currency: round(r.usd_value, 2) for r in cv.accepted_rows(classified).collect()}
    assert got == {"USD": 1000.00, "EUR": 918.00, "GBP": 635.00}
    stats = cv.file_stats(classified).first()
    assert (stats.total_rows, stats.skipped_rows) == (3, 0)

    table = tmpdir_path + "/revenues"
    mt.write_revenues(mt.revenue_rows(classified), table)
    mt.write_revenues(mt.revenue_rows(classified), table)  # replay: partition replaced, not duplicated
    back = mt.read_revenues(spark, table)
    assert back.count() == 3
    import json
    payload = json.loads(back.where("currency = 'EUR'").first().raw_payload)
    assert payload == {"currency": "EUR", "date": "2026-02-15", "product": "WidgetB", "revenue": "850.00"}
    assert back.select("revenue_id").distinct().count() == 3

import datetime as dt

from revenue_engine.operators import rates as rt
from revenue_engine.sources import rate_payloads as rp

D1, D2 = dt.date(2026, 2, 15), dt.date(2026, 2, 16)


def test_payload_scan_invert_upsert(spark):
    text = spark.createDataFrame([
        (1, '{"base":"USD","date":"2026-02-15","rates":{"EUR":0.5,"USD":1.5,"ZZZ":0}}'),
        (2, '{"base":"USD","date":"2026-02-15","rates":{"EUR":0.25}}'),
        (3, '{"base":"USD","date":"15/02/2026","rates":{"EUR":2.0}}'),   # bad date: payload rejected
        (4, 'not json'),
    ], "fetch_seq int, payload string")
    payloads = rp.parse_rate_payloads(text)
    assert {r.fetch_seq for r in rp.rejected_payloads(payloads).collect()} == {3, 4}
    api = rp.explode_rates(payloads)
    inv = {(r.fetch_seq, r.currency): r.rate_to_usd for r in rt.invert_rates(api).collect()}
    assert ("ZZZ" not in {c for _, c in inv}) and inv[(1, "EUR")] == 2.0
    current = spark.createDataFrame([("EUR", 9.0, D1), ("GBP", 1.27, D1), ("EUR", 1.1, D2)],
                                    "currency string, rate_to_usd double, rate_date date")
    out = {(r.currency, r.rate_date): r.rate_to_usd
           for r in rt.upsert_rates(current, rt.incoming_rates(api)).collect()}
    assert out[("EUR", D1)] == 4.0          # last fetch wins
    assert out[("USD", D1)] == 1.0          # forced base row overrides the API's 1.5
    assert out[("GBP", D1)] == 1.27 and out[("EUR", D2)] == 1.1  # untouched keys stay
    stats = {r.fetch_seq: (r.rates_received, r.rates_upserted) for r in rt.rate_load_stats(api).collect()}
    assert stats[1] == (3, 3) and stats[2] == (1, 2)


def test_insert_absent(spark):
    current = spark.createDataFrame([("EUR", 1.08, D1)], "currency string, rate_to_usd double, rate_date date")
    seed = spark.createDataFrame([("EUR", 2.0, D1), ("JPY", 0.0067, D1)], "currency string, rate_to_usd double, rate_date date")
    out = {(r.currency): r.rate_to_usd for r in rt.insert_absent(current, seed).collect()}
    assert out == {"EUR": 1.08, "JPY": 0.0067}

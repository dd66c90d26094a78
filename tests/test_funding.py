from __future__ import annotations

from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tickweave.operators import funding, registry, validate, versions

H = datetime(2026, 1, 1, 8)
EST = "instrument_id long, funding_time timestamp, rate string, source_time timestamp, arrival long"


def at(spark, rows, hour=H, **options):
    estimates = spark.createDataFrame(rows, EST).withColumn("rate", F.col("rate").cast("decimal(38,18)"))
    hours = spark.createDataFrame([(1, hour)], "instrument_id long, hour timestamp")
    return [(x.funding_time, x.rate.normalize()) for x in funding.at_hours(estimates, hours, **options).collect()]


def s(n):
    return timedelta(seconds=n)


def test_settlement_value_wins_at_its_hour(spark):
    rows = [(1, H, "0.1", H - s(20), 1), (1, H + timedelta(hours=8), "0.2", H - s(1), 2)]
    assert at(spark, rows) == [(H, Decimal("0.1"))]


def test_next_period_never_stands_in(spark):
    rows = [(1, H, "0.1", H - s(300), 1), (1, H + timedelta(hours=8), "0.2", H - s(1), 2)]
    assert at(spark, rows) == []


def test_freshness_is_inclusive(spark):
    other = H + timedelta(hours=4)
    assert at(spark, [(1, other, "0.1", H - s(120), 1)]) and not at(spark, [(1, other, "0.1", H - s(121), 1)])
    assert at(spark, [(1, other, "0.1", H, 1)]) and not at(spark, [(1, other, "0.1", H + s(1), 1)])


def test_latest_of_a_settlement(spark):
    other = H + timedelta(hours=4)
    assert at(spark, [(1, other, "0.1", H - s(9), 1), (1, other, "0.3", H - s(9), 2), (1, other, "0.2", H - s(30), 3)]) == [(other, Decimal("0.3"))]


def test_unavailable(spark):
    down = spark.createDataFrame([(1, H - s(5), None)], "instrument_id long, from_time timestamp, to_time timestamp")
    assert at(spark, [(1, H, "0.1", H - s(20), 1)], unavailable=down) == []


def test_upsert_keeps_actuals(spark):
    schema = "instrument_id long, hour_time timestamp, funding_time timestamp, rate decimal(38,18), is_actual boolean, _ingest_seq long"
    stored = spark.createDataFrame([(1, H, H, Decimal("0.0001"), False, 1), (1, H, H, Decimal("0.0002"), True, 2)], schema)
    late = spark.createDataFrame([(1, H, H, Decimal("0.0003"), False, 3)], schema)
    same = spark.createDataFrame([(1, H, H, Decimal("0.0002"), True, 3)], schema)
    better = spark.createDataFrame([(1, H, H, Decimal("0.0009"), True, 3)], schema)
    assert [funding.upsert(stored, x).count() for x in (late, same, better)] == [0, 0, 1]
    assert versions.current(stored.unionByName(late), ["instrument_id", "hour_time"], version="is_actual").first().rate == Decimal("0.0002")


def test_pending(spark):
    schema = "instrument_id long, hour_time timestamp, funding_time timestamp, rate decimal(38,18), is_actual boolean, _ingest_seq long"
    rows = [(1, H - timedelta(hours=k), H, Decimal(0), False, k) for k in (1, 2)] + [(2, H, H, Decimal(0), True, 9), (3, H, H + s(1), Decimal(0), False, 10)]
    stored = spark.createDataFrame(rows, schema)
    when = F.lit(H)
    assert [(x.instrument_id, x.funding_time) for x in funding.pending(stored, when, when).collect()] == [(1, H)]


@pytest.mark.parametrize(("after", "attempt", "due"), [(1, 0, 2), (2, 0, 2), (10, 1, 10), (15, 2, 15), (120, 3, 120)])
def test_first_attempt(spark, after, attempt, due):
    a, d = funding.first_attempt(F.lit(H), F.lit(H + timedelta(minutes=after)))
    got = spark.range(1).select(a.alias("a"), d.alias("d")).first()
    assert (got.a, got.d) == (attempt, H + timedelta(minutes=due))


def test_slots_are_apart(spark):
    due = spark.createDataFrame([(1, H, "A", H), (2, H, "A", H), (3, H, "A", H + s(10)), (1, H, "B", H)], "instrument_id long, funding_time timestamp, exchange string, due timestamp")
    got = [(x.exchange, x.instrument_id, (x.start - H).seconds) for x in funding.request_slots(due).orderBy("exchange", "start").collect()]
    assert got == [("A", 1, 0), ("A", 2, 1), ("A", 3, 10), ("B", 1, 0)]
    assert [x.due - H for x in funding.attempts(due.where("exchange = 'B'")).orderBy("attempt").collect()] == [timedelta(minutes=m) for m in funding.DELAYS]


def test_tasks_and_confirmation(spark):
    times = [(1, H), (1, H), (1, H + timedelta(milliseconds=1))]
    tasks = funding.tasks(spark.createDataFrame(times, "instrument_id long, funding_time timestamp"))
    assert tasks.count() == 2
    answers = spark.createDataFrame([(1, H, Decimal("0.5")), (1, H + timedelta(milliseconds=1), None)], "instrument_id long, funding_time timestamp, rate decimal(38,18)")
    (row,) = funding.confirm(tasks, answers).collect()
    assert row.is_actual and row.funding_time == H


def test_backfill(spark):
    schema = "instrument_id long, hour_time timestamp, funding_time timestamp, rate decimal(38,18), is_actual boolean, _ingest_seq long"
    rows = spark.createDataFrame([(k, H, H, Decimal(0), False, k) for k in (1, 2, 999)] + [(1, H, H - timedelta(hours=30), Decimal(0), False, 5)], schema)
    dim = spark.createDataFrame([(1, "OKX", "perpetual", "A"), (2, "Binance", "spot", "B")], "instrument_id long, exchange string, market_type string, exchange_symbol string")
    now = F.lit(H + timedelta(minutes=6))
    rows = rows.where("_ingest_seq <> 5")
    got = funding.backfill(rows, now, dim, ["OKX"]).collect()
    assert [(x.instrument_id, x.attempt, x.due) for x in got] == [(1, 1, H + timedelta(minutes=6))]
    with pytest.raises(Exception, match="no worker"):
        funding.backfill(rows, now, dim, ["Binance"]).collect()


def test_rules(spark):
    bad = spark.createDataFrame([(0, H + s(1), H, None, True)], "instrument_id long, hour_time timestamp, funding_time timestamp, rate decimal(38,18), is_actual boolean")
    assert bad.select(validate.funding_rate().alias("x")).first().x == ["instrument_id", "hour_time", "rate"]
    good, held = validate.split(bad, validate.funding_rate())
    assert good.count() == 0 and held.first()[validate.VIOLATIONS]


def test_registry(spark):
    fields = ["a", "b"]
    known = spark.createDataFrame([(3, "x", None)], "instrument_id long, a string, b string")
    incoming = spark.createDataFrame([(0, "y", "z"), (1, "x", None), (2, "y", "z"), (3, "x", "z")], "pos int, a string, b string")
    got = [(x.pos, x.instrument_id, x.is_new) for x in registry.register(known, incoming, fields).orderBy("pos").collect()]
    assert got == [(0, 4, True), (1, 3, False), (2, 4, True), (3, 5, True)]
    empty = registry.register(known.where("false"), incoming, fields).orderBy("pos").collect()
    assert [x.instrument_id for x in empty] == [1, 2, 1, 3]
    names = spark.createDataFrame([("B",), ("A",)], "exchange_symbol string")
    assert [x.exchange_symbol for x in registry.select_in_order(names, ["B", "A"]).collect()] == ["B", "A"]
    for wrong in (["a"], ["A", "A"]):
        with pytest.raises((LookupError, ValueError)):
            registry.select_in_order(names, wrong)


def test_confirmation_is_written_back(spark):
    """Estimates of two settlements; one is answered, a late estimate doesn't replace it, and the other stays open."""
    from datetime import datetime, timedelta
    from decimal import Decimal

    from pyspark.sql import functions as F

    from tickweave import schemas
    from tickweave.sources import store

    store.init(spark, "confirmed")
    hour = datetime(2026, 3, 1, 8)
    rows = lambda rate, actual: spark.createDataFrame([(i, hour, hour, Decimal(rate), actual) for i in (1, 2)], schemas.FUNDING)
    store.upsert_rates(rows("0.0001", False), "confirmed", F.lit(1))
    tasks = spark.createDataFrame([(1, hour), (2, hour)], "instrument_id long, funding_time timestamp")
    answers = spark.createDataFrame([(1, hour, Decimal("0.0002")), (2, hour + timedelta(milliseconds=1), Decimal("0.0009"))], "instrument_id long, funding_time timestamp, rate decimal(38,18)")
    assert [x.instrument_id for x in store.confirm(tasks, answers, "confirmed", F.lit(2)).collect()] == [2]
    store.upsert_rates(rows("0.0003", False), "confirmed", F.lit(3))
    store.upsert_rates(rows("0.0003", False), "confirmed", F.lit(4))  # says the same again
    got = {x.instrument_id: (x.rate, x.is_actual) for x in store.read(spark, "confirmed", "funding_rate_hourly").collect()}
    assert got == {1: (Decimal("0.0002"), True), 2: (Decimal("0.0003"), False)}
    assert spark.table("confirmed.funding_rate_hourly").count() == 4


def _log(spark, rows):
    t = lambda s: None if s is None else datetime(2026, 1, 2) + timedelta(seconds=s)
    schema = "instrument_id long, conn_id long, kind string, arrival_seq long, arrival_time timestamp, funding_time timestamp, source_time timestamp"
    return spark.createDataFrame([(i, c, k, n, t(at), t(f), t(s)) for i, c, k, n, at, f, s in rows], schema)


def test_outages_as_intervals(spark):
    t = lambda s: datetime(2026, 1, 2) + timedelta(seconds=s)
    up = lambda n, at, source, target=28800, i=1: (i, 1, "estimate", n, at, target, source)
    down = lambda n, at, i=1: (i, 1, "unavailable", n, at, None, None)
    rows = [up(0, 10, 10), up(1, 20, 20), down(2, 30), down(3, 31), up(4, 40, 15), up(5, 50, 20), down(70_000, 60), up(140_000, 70, 1, 57600), down(5, 5, 2), (3, 1, "estimate", 1, 9, 28800, 9)]
    for width in (2, 1 << 16):
        got = sorted(((r.instrument_id, r.from_time, r.to_time) for r in funding.outages(_log(spark, rows), width).collect()), key=str)
        # an old estimate (15 after 20) ends nothing, an equal one does, and so does any of another settlement
        assert got == sorted([(1, None, t(10)), (1, t(30), t(50)), (1, t(60), t(70)), (2, None, None), (3, None, t(9))], key=str)
    hours = spark.createDataFrame([(i, datetime(2026, 1, 2, h)) for i in (1, 2, 3) for h in (0, 1, 2)], "instrument_id long, hour timestamp")
    spans = spark.createDataFrame([(1, datetime(2026, 1, 2, 0, 30), datetime(2026, 1, 2, 1)), (1, datetime(2026, 1, 2, 2), datetime(2026, 1, 2, 2, 0, 1)), (2, None, None), (3, None, datetime(2026, 1, 2, 0, 1)), (3, datetime(2026, 1, 2, 1, 1), None)], "instrument_id long, from_time timestamp, to_time timestamp")
    assert sorted((r.instrument_id, r.hour.hour) for r in funding.down_hours(spans, hours).collect()) == [(1, 2), (2, 0), (2, 1), (2, 2), (3, 0), (3, 2)]


def test_a_silent_connection_takes_all_its_instruments_down(spark):
    rows = [(1, 7, "estimate", 0, 0, 28800, 0), (2, 7, "estimate", 1, 100, 28800, 100), (1, 7, "estimate", 2, 220, 28800, 220), (2, 7, "estimate", 3, 341, 28800, 341), (3, 8, "estimate", 0, 0, 28800, 0)]
    log = _log(spark, rows)
    end = datetime(2026, 1, 2, 0, 6)
    found = funding.silences(log, 120, F.lit(end))
    at = sorted((r.instrument_id, r.conn_id, int((r.arrival_time - datetime(2026, 1, 2)).total_seconds())) for r in found.collect())
    assert at == [(1, 7, 340), (2, 7, 340), (3, 8, 120)]  # 120 seconds are not too long, 121 are
    both = log.select("instrument_id", "kind", "arrival_seq", "arrival_time", "funding_time", "source_time").unionByName(found.drop("conn_id"), allowMissingColumns=True)
    got = {(r.instrument_id, r.from_time, r.to_time) for r in funding.outages(both).where("from_time is not null").collect()}
    t = lambda s: datetime(2026, 1, 2) + timedelta(seconds=s)
    assert got == {(1, t(340), None), (2, t(340), t(341)), (3, t(120), None)}


def test_the_row_before_over_ranges(spark):
    from tickweave.operators import ordering

    rows = [(k, n * (k + 3), n % 3) for k in range(3) for n in range(200)]
    df = spark.createDataFrame(rows, "k int, n int, v int").repartition(5)
    got = {(r.k, r.n): r.p for r in ordering.previous(df, ["k"], "n", "v", "p", width=16).collect()}
    assert got == {(k, n, )[:2]: (None if n == 0 else (n // (k + 3) - 1) % 3) for k, n, _ in rows}


def test_ids_are_dense_over_many_ranges_and_all_or_nothing(spark):
    """As one writer would give them, one after the other; a row that breaks a rule refuses all."""
    import random

    rng = random.Random(5)
    incoming = [(pos, f"s{rng.randrange(60)}", rng.choice([None, "x"])) for pos in sorted(rng.sample(range(700_000), 150))]
    existing = [(n, f"s{n}", "x") for n in range(1, 20)]
    ids, want = {(a, b): n for n, a, b in existing}, {}
    for pos, a, b in incoming:
        want[pos] = ids.setdefault((a, b), max(ids.values()) + 1)
    fields = ["a", "b"]
    known = spark.createDataFrame(existing, "instrument_id long, a string, b string")
    rows = spark.createDataFrame(incoming, "pos int, a string, b string").repartition(4)
    assert {r.pos: r.instrument_id for r in registry.register(known, rows, fields).collect()} == want
    rules = validate.codes(a_text=~(F.col("a") != ""))
    assert {r.pos: r.instrument_id for r in registry.register(known, rows, fields, rules=rules).collect()} == want
    bad = rows.unionByName(spark.createDataFrame([(900_000, "", None)], rows.schema))
    with pytest.raises(Exception, match="1 rows break rules, the first one: a_text"):
        registry.register(known, bad, fields, rules=rules).collect()

"""Funding: estimates known at an hour, confirmation by actual rates, and what still lacks one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickweave.operators.ordering import WIDTH, previous
from tickweave.operators.registry import route_backfill
from tickweave.operators.versions import SEQ, current

MAX_AGE = "2 minutes"
RETENTION = "48 hours"
BACKFILL = "24 hours"
#: Minutes after a settlement at which its actual rate is asked for.
DELAYS = (2, 5, 15, 60)
#: Seconds between requests to one exchange.
SPACING = 1


def latest(estimates: DataFrame, arrival: str = "arrival") -> DataFrame:
    """The last estimate of each settlement; of equal source times the later arrival counts."""
    rest = [c for c in estimates.columns if c not in ("instrument_id", "funding_time")]
    newest = estimates.groupBy("instrument_id", "funding_time").agg(F.max_by(F.struct(*rest), F.struct("source_time", arrival)).alias("_row"))
    return newest.select("instrument_id", "funding_time", *[F.col("_row")[c].alias(c) for c in rest])


def _hour_after(c: str) -> Column:
    """The first whole hour that isn't before a time."""
    return F.timestamp_seconds(F.ceil(F.unix_micros(c) / F.lit(3_600_000_000)) * 3600)


def _chosen(found: DataFrame, hours: DataFrame, unavailable: DataFrame | None) -> DataFrame:
    """Of rows (instrument_id, hour, settlement, own, any) the estimate that stands at each hour that is asked for."""
    asked = hours.select("instrument_id", "hour").distinct()
    if unavailable is not None:
        asked = asked.join(down_hours(unavailable, asked), ["instrument_id", "hour"], "left_anti")
    chosen = found.select("instrument_id", "hour", "settlement", F.when(F.col("settlement"), F.col("own")).otherwise(F.col("any")).alias("r"))
    return chosen.where("r is not null").join(asked, ["instrument_id", "hour"], "left_semi").select("instrument_id", "hour", "settlement", "r.*")


def down_hours(unavailable: DataFrame, hours: DataFrame) -> DataFrame:
    """The whole hours within intervals (instrument_id, from_time, to_time), of those between the first and the last hour asked for.

    An interval holds its start and not its end; an absent start or end is
    open.  Intervals are spread over their hours, so they meet hours by
    equality and no instrument's intervals meet all of its hours.
    """
    span = hours.agg(F.min("hour").alias("_low"), F.max("hour").alias("_high"))
    within = unavailable.crossJoin(F.broadcast(span))  # one row
    low = F.greatest(F.coalesce(_hour_after("from_time"), F.col("_low")), F.col("_low"))
    high = F.least(F.coalesce(_hour_after("to_time") - F.expr("interval 1 hour"), F.col("_high")), F.col("_high"))
    return within.withColumn("hour", F.explode(F.when(low <= high, F.sequence(low, high, F.expr("interval 1 hour"))))).select("instrument_id", "hour").distinct()


def taken(log: DataFrame, arrival: str = "arrival_seq") -> DataFrame:
    """The estimates of a log that the store takes: not those that are older, by source time, than one of the same settlement before them."""
    settlement = Window.partitionBy("instrument_id", "_target").orderBy(arrival).rowsBetween(Window.unboundedPreceding, -1)
    rows = log.withColumn("_target", F.unix_millis("funding_time")).withColumn("_newest", F.max("source_time").over(settlement))
    return rows.where(F.col("_newest").isNull() | (F.col("source_time") >= F.col("_newest"))).drop("_target", "_newest")


def silences(messages: DataFrame, silence: int, until: Column | None = None) -> DataFrame:
    """Rows of kind ``unavailable`` for each instrument of a connection that was silent for longer than ``silence`` seconds.

    ``messages`` are a connection's (conn_id, arrival_seq, arrival_time,
    instrument_id); any message ends its silence.  The row comes ``silence``
    seconds after the last message and takes its place in the order;
    ``until``, up to which nothing more has arrived, ends the log.
    """
    order = Window.partitionBy("conn_id").orderBy("arrival_seq")
    gap = F.unix_micros(F.lead("arrival_time").over(order)) - F.unix_micros("arrival_time")
    limit = silence * 1_000_000
    late = F.coalesce(gap > limit, F.unix_micros(until) - F.unix_micros("arrival_time") >= limit if until is not None else F.lit(False), F.lit(False))
    once = messages.groupBy("conn_id", "arrival_seq").agg(F.first("arrival_time").alias("arrival_time"))
    ends = once.withColumn("_late", late).where("_late").select("conn_id", "arrival_seq", F.timestamp_micros(F.unix_micros("arrival_time") + limit).alias("arrival_time"))
    members = messages.select("conn_id", "instrument_id").distinct()
    return members.join(ends, "conn_id").select("instrument_id", "conn_id", "arrival_seq", "arrival_time", F.lit("unavailable").alias("kind"))


def outages(log: DataFrame, width: int = WIDTH) -> DataFrame:
    """Intervals (instrument_id, from_time, to_time) during which an instrument had no estimates to rely on.

    ``log`` has rows of kind ``estimate`` (funding_time, source_time) and
    ``unavailable``, in order of ``arrival_seq``; of equal places the estimate
    comes first.  An instrument is down at first (no from_time), again from
    each ``unavailable``, and up from the next estimate that is taken; one that
    is passed over as old ends nothing.  The last interval has no to_time if
    it goes on.
    """
    log = log.withColumn("_at", F.col("arrival_seq") * 2 + (F.col("kind") == "unavailable").cast("long"))
    up = taken(log.where("kind = 'estimate'"), "_at").select("instrument_id", "_at", "arrival_time", F.lit(True).alias("_up"))
    down = log.where("kind = 'unavailable'").select("instrument_id", "_at", "arrival_time", F.lit(False).alias("_up"))
    marked = previous(up.unionByName(down), ["instrument_id"], "_at", "_up", "_was", width)
    turns = marked.where("_up != coalesce(_was, false) or (_was is null and not _up)")  # few, whatever the log has
    order = Window.partitionBy("instrument_id").orderBy("_at")
    first = F.lag("_at").over(order).isNull()
    next_ = F.lead("arrival_time").over(order)
    each = turns.select("instrument_id", "arrival_time", "_up", first.alias("_first"), next_.alias("_next"))
    later = each.where("not _up and not _first").select("instrument_id", F.col("arrival_time").alias("from_time"), F.col("_next").alias("to_time"))
    start = each.where("_first").select("instrument_id", F.lit(None).cast("timestamp").alias("from_time"), F.when(F.col("_up"), F.col("arrival_time")).otherwise(F.col("_next")).alias("to_time"))
    return start.unionByName(later)


def at_hours(
    estimates: DataFrame, hours: DataFrame, max_age: str = MAX_AGE, retention: str = RETENTION, arrival: str = "arrival", unavailable: DataFrame | None = None
) -> DataFrame:
    """The estimate that stands at each (instrument_id, whole hour): rows of those that have one, with rate, funding_time and source_time.

    Known at an hour is what the feed had said by then, by its source times, of
    each settlement the latest.  If any known entry, fresh or not, settles in
    that very hour, only a fresh one that does so counts, so the next period
    never stands in for a settlement; else the freshest does.  Age bounds are
    inclusive.  ``at_store`` reads a store that keeps no history instead.

    Only the last estimate before each hour can stand, so estimates are first
    reduced to one for each instrument, settlement and hour, and these are
    carried on to the hours until the next, for ``retention`` at most.

    ``unavailable`` has intervals (instrument_id, from_time, to_time) during
    which a feed was down (``outages``): hours within have no estimate.
    """
    order = F.struct("source_time", arrival)
    last = estimates.withColumn("hour", _hour_after("source_time")).groupBy("instrument_id", "funding_time", "hour").agg(F.max_by(F.struct("source_time", "rate", arrival), order).alias("e"))
    next_ = F.lead("hour").over(Window.partitionBy("instrument_id", "funding_time").orderBy("hour"))
    until = F.date_trunc("hour", F.col("e.source_time") + F.expr(f"interval '{retention}'"))
    spans = last.withColumn("_to", F.least(until, next_ - F.expr("interval 1 hour"))).where("_to >= hour")
    each = spans.withColumn("hour", F.explode(F.sequence("hour", "_to", F.expr("interval 1 hour")))).drop("_to")
    fresh = F.expr(f"e.source_time >= hour - interval '{max_age}'")
    settles = F.date_trunc("hour", "funding_time") == F.col("hour")
    order = F.struct("e.source_time", f"e.{arrival}")
    row = F.struct("funding_time", "e.source_time", "e.rate")
    found = each.groupBy("instrument_id", "hour").agg(
        F.bool_or(settles).alias("settlement"),
        F.max_by(F.when(fresh & settles, row), F.when(fresh & settles, order)).alias("own"),
        F.max_by(F.when(fresh, row), F.when(fresh, order)).alias("any"),
    )
    return _chosen(found, hours, unavailable)


def at_store(store: DataFrame, hours: DataFrame, max_age: str = MAX_AGE, arrival: str = "arrival", unavailable: DataFrame | None = None) -> DataFrame:
    """The same from a store that keeps the latest estimate of each settlement alone (``latest``), as it is read afterwards.

    An entry whose source time is after the hour is no candidate, yet if it
    settles in that hour it rules the other settlements out: the earlier entry
    that it replaced is gone.
    """
    until = F.date_trunc("hour", F.col("source_time") + F.expr(f"interval '{max_age}'"))
    row, order = F.struct("funding_time", "source_time", "rate"), F.struct("source_time", arrival)
    own = F.date_trunc("hour", "funding_time")
    first = _hour_after("source_time")
    fresh = store.withColumn("hour", F.explode(F.when(until >= first, F.sequence(first, until, F.expr("interval 1 hour")))))
    fresh = fresh.select("instrument_id", "hour", (own == F.col("hour")).alias("settles"), row.alias("row"), order.alias("order"))
    flags = store.select("instrument_id", own.alias("hour"), F.lit(True).alias("settles"), F.lit(None).cast(fresh.schema["row"].dataType).alias("row"), F.lit(None).cast(fresh.schema["order"].dataType).alias("order"))
    settles = F.col("settles")
    found = fresh.unionByName(flags).groupBy("instrument_id", "hour").agg(
        F.bool_or("settles").alias("settlement"), F.max_by(F.when(settles, F.col("row")), F.when(settles, F.col("order"))).alias("own"), F.max_by("row", "order").alias("any")
    )
    return _chosen(found, hours, unavailable)


def hourly_rates(at_hour: DataFrame) -> DataFrame:
    """Rows of the hourly table from estimates at hours; a missing estimate makes no row."""
    return at_hour.select("instrument_id", F.col("hour").alias("hour_time"), "funding_time", "rate", F.lit(False).alias("is_actual"))


def upsert(stored: DataFrame, incoming: DataFrame, seq: str = SEQ) -> DataFrame:
    """Incoming rows that are to be appended: none over a stored actual by an estimate, none that changes nothing."""
    keys = ["instrument_id", "hour_time"]
    now = current(stored, keys, seq, "is_actual").select(*keys, F.struct("is_actual", "rate", "funding_time").alias("_now"))
    joined = incoming.join(now, keys, "left")
    late = F.col("_now.is_actual") & ~F.col("is_actual")
    same = F.struct("is_actual", "rate", "funding_time").eqNullSafe(F.col("_now"))
    return joined.where(F.col("_now").isNull() | ~(late | same)).select(incoming.columns)


def pending(stored: DataFrame, since: Column, through: Column, seq: str = SEQ) -> DataFrame:
    """Settlements from since to through, both included, of which no row has an actual rate; in order."""
    rows = current(stored, ["instrument_id", "hour_time"], seq, "is_actual")
    window = rows.where(F.unix_millis("funding_time").between(F.unix_millis(since), F.unix_millis(through)))
    found = window.groupBy("instrument_id", "funding_time").agg(F.max(F.col("is_actual").cast("int")).alias("_a")).where("_a = 0").drop("_a")
    return found.orderBy("funding_time", "instrument_id")


def tasks(settlements: DataFrame) -> DataFrame:
    """Each settlement once, told apart to the millisecond."""
    return settlements.select("instrument_id", F.timestamp_millis(F.unix_millis("funding_time")).alias("funding_time")).distinct()


def first_attempt(target: Column, now: Column, delays: tuple[int, ...] = DELAYS) -> tuple[Column, Column]:
    """(attempt, due): the last delay that has passed, at once; before any has, attempt 0 when it does."""
    passed = F.lit(0)
    for minutes in delays:
        passed = passed + F.when(target + F.expr(f"interval {minutes} minutes") <= now, 1).otherwise(0)
    attempt = F.greatest(passed - 1, F.lit(0))
    return attempt, F.when(passed > 0, now).otherwise(target + F.expr(f"interval {delays[0]} minutes"))


def attempts(settlements: DataFrame, delays: tuple[int, ...] = DELAYS) -> DataFrame:
    """Every attempt that a settlement may need: rows with attempt and due; after the last it is given up."""
    rows = settlements.select("*", F.posexplode(F.array(*[F.lit(m) for m in delays])).alias("attempt", "_m"))
    return rows.withColumn("due", F.col("funding_time") + F.make_interval(mins=F.col("_m"))).drop("_m")


def request_slots(due: DataFrame, exchange: str = "exchange", spacing: int = SPACING) -> DataFrame:
    """When each request starts if an exchange is asked one at a time, ``spacing`` seconds apart, in order of due time.

    Start k is the latest of due(j) + (k - j) * spacing over j up to k: a
    running maximum of due less place, plus place.  An exchange's requests are
    a second apart by law, so its window is short.
    """
    order = Window.partitionBy(exchange).orderBy("due", "instrument_id", "funding_time")
    place = (F.row_number().over(order) - 1) * spacing
    slotted = due.withColumn("_k", place).withColumn("_u", F.unix_micros("due") - F.col("_k") * 1_000_000)
    running = F.max("_u").over(order.rowsBetween(Window.unboundedPreceding, 0))
    return slotted.withColumn("start", F.timestamp_micros(running + F.col("_k") * 1_000_000)).drop("_k", "_u")


def backfill(stored: DataFrame, now: Column, instruments: DataFrame, exchanges: list[str], seq: str = SEQ) -> DataFrame:
    """What a start finds open: settlements of the last 24 hours, routed, each with its first attempt and when it is due."""
    open_ = pending(stored, now - F.expr(f"interval {BACKFILL}"), now, seq)
    attempt, due = first_attempt(F.col("funding_time"), now)
    return route_backfill(open_, instruments, exchanges).withColumn("attempt", attempt).withColumn("due", due)


def confirm(tasks_due: DataFrame, answers: DataFrame) -> DataFrame:
    """Hourly rows of tasks whose settlement an exchange's history has to the millisecond, with a rate; the others stay open."""
    found = tasks_due.select("instrument_id", "funding_time").join(answers.where("rate is not null"), ["instrument_id", "funding_time"])
    return found.select("instrument_id", F.date_trunc("hour", "funding_time").alias("hour_time"), "funding_time", "rate", F.lit(True).alias("is_actual"))

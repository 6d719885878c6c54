"""Time-ordered operators whose work per task is bounded by the calendar.

A plain ``Window.partitionBy(key)`` puts every row of a key into one task, and
one key may own a third of the table. That is done for keys of up to ``LIGHT`` rows
only. The rows of larger keys are first combined per key and second (with map-side
partial aggregation). Windows then run over

* the seconds of one key and day: at most 86,400 points (twice that with the
  points that leave the frame), and
* the days of one key: a few thousand rows for a history of many years,

and the result goes back to the rows through an equi-join on key and second.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimsight.functions.fields import DAY, day_of, epoch, square
from claimsight.session import materialize

SEC = "_sec"
DAYNO = "_day"

# A key of up to so many rows is one window; those of larger ones are cut by the calendar.
LIGHT = 4096


def with_second(df: DataFrame, at: str) -> DataFrame:
    return df.withColumn(SEC, epoch(at))


def large_keys(
    df: DataFrame, keys: list[str], *, at: str = "event_time", limit: int = LIGHT, store=materialize
) -> DataFrame:
    """Keys with more than ``limit`` timed rows, marked by ``_large``.

    Stored, so that their size is known. All other keys fit into one window each. ``store`` may
    be a ``session.WorkTables``, whose tables the caller removes.
    """
    timed = df.filter(F.col(at).isNotNull()).dropna(subset=keys)
    counts = timed.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))
    large = counts.filter(F.col("rows") > limit).select(*keys, F.lit(True).alias("_large"))
    return store(large, "large-keys")


def rolling_stats(
    df: DataFrame,
    keys: list[str],
    days: int,
    *,
    at: str = "event_time",
    cents: str = "amount_cents",
    kind: str | None = None,
    spread: bool = True,
) -> DataFrame:
    """Frame statistics over the last ``days`` days at every second of a key.

    The frame of second ``t`` holds the rows with a second in
    ``[t - days * 86400, t]``, rows of the same second included. Gives one row
    per key and second: ``_sec, n, total_cents, max_cents`` and, on request,
    ``squares`` (for the deviation) and ``kinds`` (exact distinct count of
    ``kind``). Rows without a time are left out.
    """
    timed = with_second(df, at).filter(F.col(SEC).isNotNull())
    sums = {"n": F.count(F.lit(1)), "total_cents": F.sum(cents)}
    if spread:
        sums["squares"] = F.sum(square(F.col(cents))).cast("decimal(35,0)")
    points = (
        timed.groupBy(*keys, SEC)
        .agg(*[v.alias(k) for k, v in sums.items()], F.max(cents).alias("max_cents"))
        .withColumn(DAYNO, day_of(SEC))
    )
    parts = [*sums, "max_cents"]
    own = points.select(
        *keys,
        DAYNO,
        SEC,
        *[F.col(p).alias(f"in_{p}") for p in parts],
        *[F.lit(None).cast(points.schema[p].dataType).alias(f"out_{p}") for p in parts],
        F.lit(0).cast("bigint").alias("step"),
    )
    # The frame's first day enters a second time, moved onto the frame's last
    # day: there the part still inside the frame is a suffix of it.
    shifted = points.select(
        *keys,
        (F.col(DAYNO) + days).alias(DAYNO),
        (F.col(SEC) + days * DAY).alias(SEC),
        *[F.lit(None).cast(points.schema[p].dataType).alias(f"in_{p}") for p in parts],
        *[F.col(p).alias(f"out_{p}") for p in parts],
        F.lit(0).cast("bigint").alias("step"),
    )
    line = own.unionByName(shifted)
    steps = None
    if kind is not None:
        steps = _distinct_steps(timed, keys, kind, days)
        line = line.unionByName(steps, allowMissingColumns=True)

    day = Window.partitionBy(*keys, DAYNO)
    up = day.orderBy(SEC).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    down = day.orderBy(F.col(SEC).desc()).rangeBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    heads = {p: F.max if p == "max_cents" else F.sum for p in parts}
    line = line.select(
        *keys,
        DAYNO,
        SEC,
        F.col("in_n").isNotNull().alias("own"),
        *[f(f"in_{p}").over(up).alias(f"in_{p}") for p, f in heads.items()],
        *[f(f"out_{p}").over(down).alias(f"out_{p}") for p, f in heads.items()],
        F.sum("step").over(up).alias("step"),
    ).filter("own")

    between = _days_between(points, keys, days, heads, steps)
    joined = line.join(between, [*keys, DAYNO], "left")
    merged = []
    for p in parts:
        three = [F.col(f"in_{p}"), F.col(f"mid_{p}"), F.col(f"out_{p}")]
        if p == "max_cents":
            merged.append(F.greatest(*three).alias(p))
        else:
            total = reduce(lambda a, b: a + b, [F.coalesce(c, F.lit(0)) for c in three])
            merged.append(total.cast(points.schema[p].dataType).alias(p))
    if kind is not None:
        merged.append((F.col("step") + F.coalesce("carried", F.lit(0))).alias("kinds"))
    return joined.select(*keys, SEC, *merged)


def _days_between(points, keys, days, heads, steps) -> DataFrame:
    """Totals of the whole days strictly inside the frame, per key and day."""
    daily = points.groupBy(*keys, DAYNO).agg(
        *[f(p).alias(p) for p, f in heads.items()]
    )
    if steps is not None:
        moved = steps.groupBy(*keys, DAYNO).agg(F.sum("step").alias("step"))
        daily = daily.unionByName(moved, allowMissingColumns=True)
        daily = daily.groupBy(*keys, DAYNO).agg(
            *[f(p).alias(p) for p, f in heads.items()], F.sum("step").alias("step")
        )
    by_day = Window.partitionBy(*keys).orderBy(DAYNO)
    if days > 1:
        inner = by_day.rangeBetween(-(days - 1), -1)
        mids = [f(p).over(inner).alias(f"mid_{p}") for p, f in heads.items()]
    else:
        mids = [
            F.lit(None).cast(daily.schema[p].dataType).alias(f"mid_{p}") for p in heads
        ]
    if steps is not None:
        before = by_day.rowsBetween(Window.unboundedPreceding, -1)
        mids.append(F.sum("step").over(before).alias("carried"))
    return daily.select(*keys, DAYNO, *mids)


def _distinct_steps(timed, keys, kind, days) -> DataFrame:
    """Changes of the number of kinds in the frame, as +1 and -1 at seconds.

    A kind is in the frame from each occurrence until ``days`` later. Gaps
    longer than that can only lie between days, so first and last second of
    each kind's days are enough.
    """
    reach = days * DAY
    spans = (
        timed.filter(F.col(kind).isNotNull())
        .withColumn(DAYNO, day_of(SEC))
        .groupBy(*keys, kind, DAYNO)
        .agg(F.min(SEC).alias("lo"), F.max(SEC).alias("hi"))
    )
    w = Window.partitionBy(*keys, kind).orderBy(DAYNO)
    before, after = F.lag("hi").over(w), F.lead("lo").over(w)
    spans = spans.select(
        *keys,
        "lo",
        "hi",
        (before.isNull() | (F.col("lo") - before > reach)).alias("opens"),
        (after.isNull() | (after - F.col("hi") > reach)).alias("closes"),
    )
    opened = F.when(
        F.col("opens"),
        F.struct(F.col("lo").alias("at"), F.lit(1).cast("bigint").alias("step")),
    )
    closed = F.when(
        F.col("closes"),
        F.struct(
            (F.col("hi") + reach + 1).alias("at"), F.lit(-1).cast("bigint").alias("step")
        ),
    )
    both = F.filter(F.array(opened, closed), lambda s: s.isNotNull())
    return spans.select(*keys, F.explode(both).alias("e")).groupBy(
        *keys, F.col("e.at").alias(SEC)
    ).agg(F.sum("e.step").alias("step")).withColumn(DAYNO, day_of(SEC))


def rolling_frame(
    df: DataFrame,
    keys: list[str],
    days: int,
    *,
    at: str = "event_time",
    cents: str = "amount_cents",
    kind: str | None = None,
    spread: bool = True,
    source: DataFrame | None = None,
    light: int = LIGHT,
) -> DataFrame:
    """Every row with the statistics of its own frame (rows without time: nulls).

    Keys of up to ``light`` rows are framed as they are, each in one window. Larger ones
    take :func:`rolling_stats`. Either way the rows are dealt once. ``source`` may be a
    stored or leaner frame with the same rows to take the statistics from.
    """
    lean = df if source is None else source
    large = large_keys(lean, keys, at=at, limit=light)
    stats = rolling_stats(
        lean.join(large, keys, "left_semi"), keys, days, at=at, cents=cents, kind=kind, spread=spread
    )
    names = [c for c in stats.columns if c not in (*keys, SEC)]
    held = stats.select(
        *keys, F.col(SEC).alias("_day_sec"), *[F.col(c).alias(f"_{c}") for c in names]
    )
    whole = [F.col(k).isNotNull() for k in (*keys, SEC)]
    small = reduce(lambda a, b: a & b, whole, F.col("_large").isNull())
    # The rows of a small key share a second of 0. Rows without a time are spread over
    # numbers that are no seconds: no window of all.
    spread_out = -(F.pmod(F.xxhash64(*df.columns), F.lit(1 << 20)) + F.lit(1 << 60))
    rows = with_second(df, at).join(large, keys, "left").withColumn("_small", small)
    second = F.when(F.col("_small"), 0).otherwise(F.coalesce(SEC, spread_out))
    rows = rows.withColumn("_day_sec", second)
    rows = rows.join(held, [*keys, "_day_sec"], "left")
    frame = (
        Window.partitionBy(*keys, "_day_sec").orderBy(SEC).rangeBetween(-days * DAY, Window.currentRow)
    )
    mine = F.when(F.col("_small"), F.col(cents))
    own = {
        "n": F.count(F.lit(1)).over(frame),
        "total_cents": F.sum(mine).over(frame),
        "squares": F.sum(square(mine)).over(frame).cast("decimal(35,0)"),
        "max_cents": F.max(mine).over(frame),
    }
    if kind is not None:
        kinds = F.when(F.col("_small"), F.col(kind))
        own["kinds"] = F.size(F.collect_set(kinds).over(frame)).cast("bigint")
    own["total_cents"] = F.coalesce(own["total_cents"], F.lit(0).cast(stats.schema["total_cents"].dataType))
    own["squares"] = F.coalesce(own["squares"], F.lit(0).cast("decimal(35,0)"))
    found = [
        F.when(F.col("_small"), own[c]).otherwise(F.col(f"_{c}")).alias(c) for c in names
    ]
    return rows.select(*df.columns, *found)


def running_totals(
    df: DataFrame,
    keys: list[str],
    ttl_days: int,
    *,
    order: list[str],
    at: str = "event_time",
    cents: str | None = "amount_cents",
    source: DataFrame | None = None,
    carry: DataFrame | None = None,
    slot_digits: int = 2,
    digest: Column | None = None,
    light: int = LIGHT,
    store=materialize,
) -> DataFrame:
    """Running count and sum per key that start anew after a pause.

    A row counts the rows of its key up to and including itself, in the total
    order (second, ``order`` columns). The count restarts at a row that comes
    ``ttl_days`` or more after its predecessor. Adds ``n`` and, if ``cents`` is
    given, ``total_cents``. Rows without a time or key stay, with null statistics.

    ``order`` starts with a hex digest of the row (``fields.row_digest``). Its
    first digits split the rows of one second into slots; rows are totalled per
    slot, slots ordered inside an hour, hours inside the key, so a task never
    holds more of one key than an hour's slots or one slot's rows. Equal rows
    share a slot: remove copies first (``quality.dedup``) or fold them with
    :func:`fold_copies`, whose ``copies`` column is then taken as the weight.

    ``source`` may be a leaner frame with the same rows to take the totals from.
    ``carry`` is the state that earlier rows left (:func:`closing_totals`): at most
    one row per key, with ``n``, ``total_cents`` and ``last_sec``.

    Only keys of more than ``light`` rows are cut into hours and slots; the rows of any
    other key run through one window. Either way the rows are dealt once. ``digest`` is
    the expression of the first order column: with it, that column is worked out again
    behind the shuffle and not sent along.
    """
    weight, value = _weight(df), F.col(cents) if cents else F.lit(0).cast("bigint")
    lean = df if source is None else source
    large = large_keys(lean, keys, at=at, limit=light, store=store)
    slots = _slots(lean.join(large, keys, "left_semi"), keys, order, at, cents, slot_digits)
    hours = _hour_offsets(slots, keys, ttl_days, carry)
    base = slots.join(hours.select(*keys, "_hour", "_hour_n", "_hour_total"), [*keys, "_hour"])
    earlier = Window.partitionBy(*keys, "_hour").orderBy(SEC, "_slot")
    base = base.select(
        *keys,
        F.col(SEC).alias("_slot_sec"),
        "_slot",
        (_before("_n", earlier) + F.col("_hour_n")).alias("_base_n"),
        (_before("_total", earlier) + F.col("_hour_total")).alias("_base_total"),
        F.lit(None).cast("bigint").alias("_carry_sec"),
    )
    if carry is not None:
        held = carry.join(large, keys, "left_anti").select(
            *keys,
            F.lit(0).cast("bigint").alias("_slot_sec"),
            F.lit("").alias("_slot"),
            F.col("n").alias("_base_n"),
            F.col("total_cents").alias("_base_total"),
            F.col("last_sec").alias("_carry_sec"),
        )
        base = base.unionByName(held)
    whole = [F.col(k).isNotNull() for k in (*keys, SEC)]
    small = reduce(lambda a, b: a & b, whole, F.col("_large").isNull())
    # Rows without a time meet no base. Their whole digest is their slot: no window of all.
    slot = F.when(F.col("_small"), "").when(F.col(SEC).isNull(), F.col(order[0]))
    rows = with_second(df, at).join(large, keys, "left").withColumn("_small", small)
    rows = rows.withColumns(
        {
            "_slot_sec": F.when(F.col("_small"), 0).otherwise(F.col(SEC)),
            "_slot": slot.otherwise(_slot(order, slot_digits)),
        }
    )
    if digest is not None:
        rows = rows.drop(order[0])
    rows = rows.join(base, [*keys, "_slot_sec", "_slot"], "left")
    if digest is not None:
        rows = rows.withColumn(order[0], digest)
    ordered = Window.partitionBy(*keys, "_slot_sec", "_slot").orderBy(SEC, *order)
    up_to = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    pause = F.col(SEC) - F.greatest(F.lag(SEC).over(ordered), F.col("_carry_sec"))
    fresh = F.col("_small") & ~F.coalesce(pause < ttl_days * DAY, F.lit(False))
    sums = {"_up_n": F.sum(weight).over(up_to), "_fresh": fresh}
    if cents:
        # A sum is null as long as the row's second and slot have had no value.
        place = F.struct(SEC, _slot(order, slot_digits))
        valued = F.last(F.when(value.isNotNull(), place), ignorenulls=True).over(up_to)
        sums["_up_total"] = F.coalesce(F.sum(value * weight).over(up_to), F.lit(0))
        sums["_valued"] = valued == place
    rows = rows.withColumns(sums)
    steps = {"_n": (F.col("_up_n"), weight)}
    if cents:
        steps["_total"] = (F.col("_up_total"), F.coalesce(value * weight, F.lit(0)))
    # What a run has to leave out: the totals before its first row.
    offs = {
        f"_off{k}": F.last(F.when(F.col("_fresh"), up - own), ignorenulls=True).over(up_to)
        for k, (up, own) in steps.items()
    }
    rows = rows.withColumns(offs)
    known = {
        k: F.when(F.col(f"_off{k}").isNotNull(), up - F.col(f"_off{k}")).otherwise(
            F.col(f"_base{k}") + up
        )
        for k, (up, _) in steps.items()
    }
    added = {"n": known["_n"]}
    if cents:
        added["total_cents"] = F.when(F.col("_valued"), known["_total"])
    return rows.select(*df.columns, *[v.alias(k) for k, v in added.items()])


def closing_totals(
    df: DataFrame,
    keys: list[str],
    ttl_days: int,
    *,
    order: list[str],
    at: str = "event_time",
    cents: str | None = "amount_cents",
    carry: DataFrame | None = None,
    slot_digits: int = 2,
) -> DataFrame:
    """State of :func:`running_totals` after all rows, for the keys that have rows.

    Gives ``keys, n, total_cents, last_sec``; with the state of earlier rows as ``carry``
    it includes that. An aggregation over the hours of a key.
    """
    hours = _hour_offsets(_slots(df, keys, order, at, cents, slot_digits), keys, ttl_days, carry)
    last = F.max(
        F.struct(
            "_hour",
            (F.col("_hour_n") + F.col("_n")).alias("n"),
            (F.col("_hour_total") + F.col("_total")).alias("total_cents"),
        )
    ).alias("_last")
    seen = F.max(F.greatest("_hi", "_carry_sec")).alias("last_sec")
    closed = hours.groupBy(*keys).agg(last, seen)
    return closed.select(*keys, "_last.n", "_last.total_cents", "last_sec")


def _weight(df: DataFrame) -> Column:
    return F.col("copies") if "copies" in df.columns else F.lit(1).cast("bigint")


def _slot(order: list[str], digits: int) -> Column:
    return F.substring(order[0], 1, digits)


def _slots(df, keys, order, at, cents, digits) -> DataFrame:
    """Rows and cents per key, second and slot."""
    weight, value = _weight(df), F.col(cents) if cents else F.lit(0).cast("bigint")
    timed = with_second(df, at).filter(F.col(SEC).isNotNull())
    return (
        timed.groupBy(*keys, SEC, _slot(order, digits).alias("_slot"))
        .agg(F.sum(weight).alias("_n"), F.sum(value * weight).alias("_total"))
        .withColumn("_hour", F.floor(F.col(SEC) / 3600).cast("bigint"))
    )


def _before(col: str, ordered) -> Column:
    """Sum over the rows before the current one."""
    frame = ordered.rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(col).over(frame), F.lit(0))


def _hour_offsets(
    slots: DataFrame, keys: list[str], ttl_days: int, carry: DataFrame | None = None
) -> DataFrame:
    """Hours of a key with the totals of the same run before each. Pauses only lie between hours.

    The run before the first restart goes on from the carried state. Rows that are older than
    that state's last second make no pause, as in a stream that handles rows when they come.
    """
    hours = slots.groupBy(*keys, "_hour").agg(
        F.sum("_n").alias("_n"),
        F.sum("_total").alias("_total"),
        F.min(SEC).alias("_lo"),
        F.max(SEC).alias("_hi"),
    )
    if carry is None:
        none = F.lit(None).cast("bigint")
        hours = hours.withColumns({"_carry_n": none, "_carry_total": none, "_carry_sec": none})
    else:
        held = carry.select(
            *keys,
            F.col("n").alias("_carry_n"),
            F.col("total_cents").alias("_carry_total"),
            F.col("last_sec").alias("_carry_sec"),
        )
        hours = hours.join(held, keys, "left")
    by_hour = Window.partitionBy(*keys).orderBy("_hour")
    pause = F.col("_lo") - F.greatest(F.lag("_hi").over(by_hour), F.col("_carry_sec"))
    fresh = F.when(pause < ttl_days * DAY, 0).otherwise(1)
    hours = hours.withColumn("_fresh", fresh).withColumn(
        "_run", F.sum("_fresh").over(by_hour)
    )
    of_run = Window.partitionBy(*keys, "_run").orderBy("_hour")
    goes_on = F.col("_run") == 0
    return hours.select(
        *keys,
        "_hour",
        "_n",
        "_total",
        "_hi",
        "_carry_sec",
        (_before("_n", of_run) + F.when(goes_on, F.col("_carry_n")).otherwise(0)).alias("_hour_n"),
        (_before("_total", of_run) + F.when(goes_on, F.col("_carry_total")).otherwise(0)).alias(
            "_hour_total"
        ),
    )


def fold_copies(df: DataFrame) -> DataFrame:
    """Equal rows as one row with their number in ``copies``."""
    return df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("copies"))


def unfold_copies(df: DataFrame, counted: dict[str, Column], chunk: int = 10_000) -> DataFrame:
    """One row per copy again.

    ``counted`` maps running columns to what each copy adds to them, so that the
    copies of a row get consecutive values. Large groups are cut into chunks and
    spread over the tasks before they are written out.
    """
    starts = F.expr(f"sequence(1L, copies, {chunk}L)")
    parts = df.select("*", F.explode(starts).alias("_first")).repartition(
        F.xxhash64(*[c for c in df.columns if c != "copies"], "_first")
    )
    last = F.least(F.col("copies"), F.col("_first") + chunk - 1)
    rows = parts.select("*", F.explode(F.sequence("_first", last)).alias("_copy"))
    missing = F.col("copies") - F.col("_copy")
    for name, step in counted.items():
        rows = rows.withColumn(name, F.col(name) - step * missing)
    return rows.drop("copies", "_first", "_copy")


def previous_second(
    df: DataFrame,
    keys: list[str],
    *,
    at: str = "event_time",
    name: str = "previous_sec",
    also: dict[str, Column] | None = None,
) -> DataFrame:
    """Every row with the last earlier second at which its key had a row.

    ``also`` names aggregates over the rows of the same key and second to go with it.
    """
    also = also or {}
    points = (
        with_second(df, at)
        .filter(F.col(SEC).isNotNull())
        .groupBy(*keys, SEC)
        .agg(F.count(F.lit(1)).alias("n"), *[v.alias(k) for k, v in also.items()])
        .withColumn(DAYNO, day_of(SEC))
    )
    days = points.groupBy(*keys, DAYNO).agg(F.max(SEC).alias("last"))
    days = days.select(
        *keys,
        DAYNO,
        F.lag("last").over(Window.partitionBy(*keys).orderBy(DAYNO)).alias("carried"),
    )
    inside = F.lag(SEC).over(Window.partitionBy(*keys, DAYNO).orderBy(SEC))
    points = (
        points.withColumn("inside", inside)
        .join(days, [*keys, DAYNO])
        .select(*keys, SEC, F.coalesce("inside", "carried").alias(name), *also)
    )
    return with_second(df, at).join(points, [*keys, SEC], "left").drop(SEC)


def as_of_join(
    df: DataFrame,
    history: DataFrame,
    keys: list[str],
    *,
    at: str = "event_time",
    history_at: str = "feature_time",
    max_age_seconds: int = DAY,
    prefix: str = "",
) -> DataFrame:
    """Left join with the newest history row not younger than the row itself.

    A history row older than ``max_age_seconds`` does not count. Both sides
    are reduced to one entry per key and second before any window sees them;
    of several history rows in one second the greatest (by value) is taken.
    """
    values = [c for c in history.columns if c not in keys]
    entry = F.struct(F.col(SEC).alias("at"), F.struct(*values).alias("row"))
    facts = (
        with_second(history, history_at)
        .filter(F.col(SEC).isNotNull())
        .groupBy(*keys, SEC)
        .agg(F.max(entry).alias("fact"))
    )
    probes = with_second(df, at).filter(F.col(SEC).isNotNull()).select(*keys, SEC).distinct()
    line = (
        facts.withColumn("probe", F.lit(False))
        .unionByName(probes.withColumn("probe", F.lit(True)), allowMissingColumns=True)
        .withColumn(DAYNO, day_of(SEC))
    )
    up_to = (
        Window.partitionBy(*keys, DAYNO)
        .orderBy(SEC)
        .rangeBetween(Window.unboundedPreceding, Window.currentRow)
    )
    # Latest fact of the same day up to the second, else of an earlier day.
    same_day = line.withColumn("near", F.max("fact").over(up_to)).filter("probe")
    days = line.groupBy(*keys, DAYNO).agg(F.max("fact").alias("last"))
    earlier = (
        Window.partitionBy(*keys).orderBy(DAYNO).rowsBetween(Window.unboundedPreceding, -1)
    )
    days = days.select(*keys, DAYNO, F.max("last").over(earlier).alias("far"))
    found = (
        same_day.join(days, [*keys, DAYNO])
        .withColumn("hit", F.coalesce("near", "far"))
        .filter(F.col(SEC) - F.col("hit.at") <= max_age_seconds)
        .select(*keys, SEC, *[F.col(f"hit.row.{v}").alias(f"{prefix}{v}") for v in values])
    )
    return with_second(df, at).join(found, [*keys, SEC], "left").drop(SEC)

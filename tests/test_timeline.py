"""Bounded time operators against brute force, with the edges that matter."""

import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from claimsight.operators import features as ft
from claimsight.operators.quantiles import exact_quantiles, with_rank_share
from claimsight.operators.scoring import arrival_order, running_profiles
from claimsight.operators.timeline import (
    as_of_join,
    fold_copies,
    previous_second,
    rolling_frame,
    running_totals,
    unfold_copies,
)

DAY = 86400


def make(spark, rows):
    """rows: (key, second, cents, kind, id)"""
    df = spark.createDataFrame(
        rows, "k string, sec bigint, amount_cents bigint, kind string, id bigint"
    )
    return df.withColumn("event_time", F.timestamp_seconds("sec"))


def random_rows(seed, n=160, start=-40 * DAY):
    rnd = random.Random(seed)
    anchors = [start + rnd.randrange(120 * DAY) for _ in range(12)]
    rows = []
    for i in range(n):
        # Many rows at the same second, exactly a window apart and a second off it.
        base = rnd.choice(anchors)
        shift = rnd.choice([0, 0, 1, -1, 30 * DAY, 30 * DAY + 1, 30 * DAY - 1, DAY, 7 * DAY])
        key = "hot" if rnd.random() < 0.6 else rnd.choice("abc")
        rows.append((key, base + shift, rnd.randrange(500), rnd.choice("pqrs"), i))
    return rows


@pytest.mark.parametrize("seed,days", [(1, 30), (2, 30), (3, 1), (4, 2)])
def test_rolling_frame_equals_brute_force(spark, seed, days):
    rows = random_rows(seed)
    df = rolling_frame(make(spark, rows), ["k"], days, kind="kind")
    got = {
        r.id: (r.n, r.total_cents, r.max_cents, int(r.squares), r.kinds) for r in df.collect()
    }
    for k, t, _, _, i in rows:
        frame = [r for r in rows if r[0] == k and t - days * DAY <= r[1] <= t]
        cents = [r[2] for r in frame]
        want = (
            len(frame),
            sum(cents),
            max(cents),
            sum(c * c for c in cents),
            len({r[3] for r in frame}),
        )
        assert got[i] == want, (k, t, i)


def test_rolling_frame_keeps_rows_without_time(spark):
    df = make(spark, [("a", 5, 1, "p", 1)]).unionByName(
        make(spark, [("a", 6, 1, "p", 2)]).withColumn("event_time", F.lit(None).cast("timestamp"))
    )
    got = {r.id: r.n for r in rolling_frame(df, ["k"], 30).collect()}
    assert got == {1: 1, 2: None}


@pytest.mark.parametrize("seed", [5, 6])
def test_latest_window_is_last_row_of_frame(spark, seed):
    rows = random_rows(seed)
    got = {
        (r.k, r.days): (r.n, r.total_cents, r.max_cents, int(r.squares), r.kinds)
        for r in ft.latest_window(make(spark, rows), ["k"], [1, 30], "kind").collect()
    }
    for k in {r[0] for r in rows}:
        last = max(r[1] for r in rows if r[0] == k)
        for days in (1, 30):
            frame = [r for r in rows if r[0] == k and last - days * DAY <= r[1] <= last]
            cents = [r[2] for r in frame]
            assert got[k, days] == (
                len(frame),
                sum(cents),
                max(cents),
                sum(c * c for c in cents),
                len({r[3] for r in frame}),
            )


def brute_running(rows, ttl):
    """rows: (key, second, order, cents, id) -> id: (n, total)"""
    out = {}
    for k in {r[0] for r in rows}:
        n = total = 0
        last = None
        for _, t, _, c, i in sorted(
            (r for r in rows if r[0] == k), key=lambda r: (r[1], r[2])
        ):
            if last is not None and t - last >= ttl * DAY:
                n = total = 0
            n, total, last = n + 1, total + c, t
            out[i] = (n, total)
    return out


@pytest.mark.parametrize("seed,slot_digits", [(7, 2), (8, 1), (9, 0)])
def test_running_totals_equals_brute_force(spark, seed, slot_digits):
    rows = random_rows(seed)
    df = make(spark, rows).withColumn("arrival", F.md5(F.col("id").cast("string")))
    got = running_totals(df, ["k"], 30, order=["arrival"], slot_digits=slot_digits).collect()
    want = brute_running([(r.k, r.sec, r.arrival, r.amount_cents, r.id) for r in got], 30)
    assert {r.id: (r.n, r.total_cents) for r in got} == want
    assert len(got) == len(rows)


def test_running_totals_restart_exactly_at_the_limit(spark):
    rows = [("a", 0, 5, "p", 1), ("a", 30 * DAY - 1, 5, "p", 2), ("a", 60 * DAY - 1, 5, "p", 3)]
    df = make(spark, rows).withColumn("arrival", F.md5(F.col("id").cast("string")))
    got = {r.id: r.n for r in running_totals(df, ["k"], 30, order=["arrival"]).collect()}
    assert got == {1: 1, 2: 2, 3: 1}


def test_copies_are_folded_and_counted_one_by_one(spark):
    one = make(spark, [("a", 10, 7, "p", 1)])
    many = one
    for _ in range(4):
        many = many.unionByName(many)
    df = many.unionByName(make(spark, [("a", 9, 1, "p", 2), ("a", 11, 2, "p", 3)]))
    df = df.withColumn("arrival", F.md5(F.col("id").cast("string")))
    totals = running_totals(fold_copies(df), ["k"], 30, order=["arrival"])
    rows = unfold_copies(
        totals, {"n": F.lit(1), "total_cents": F.col("amount_cents")}, chunk=5
    ).collect()
    assert sorted(r.n for r in rows) == list(range(1, 19))
    assert sorted(r.total_cents for r in rows if r.id == 1) == [1 + 7 * i for i in range(1, 17)]
    assert [r.total_cents for r in rows if r.id == 3] == [1 + 7 * 16 + 2]


def test_profiles_with_and_without_folding_agree(spark, claims):
    columns = ["claim_id", "amount_cents", "claim_count_30d", "avg_cents_30d"]
    plain = running_profiles(claims).select(columns)
    folded = running_profiles(claims, copies=True).select(columns)
    assert plain.exceptAll(folded).count() == 0
    assert folded.count() == claims.count()


def test_previous_second(spark):
    rows = random_rows(10)
    got = {r.id: r.previous_sec for r in previous_second(make(spark, rows), ["k"]).collect()}
    for k, t, _, _, i in rows:
        earlier = [r[1] for r in rows if r[0] == k and r[1] < t]
        assert got[i] == (max(earlier) if earlier else None)


@pytest.mark.parametrize("age", [DAY, 3 * 3600])
def test_as_of_join(spark, age):
    rows = random_rows(11)
    facts = random_rows(12, n=60)
    history = make(spark, facts).select(
        "k", F.col("event_time").alias("feature_time"), F.col("amount_cents").alias("v")
    )
    got = {
        r.id: r.v
        for r in as_of_join(make(spark, rows), history, ["k"], max_age_seconds=age).collect()
    }
    for k, t, _, _, i in rows:
        known = [r for r in facts if r[0] == k and r[1] <= t]
        want = None
        if known:
            newest = max(r[1] for r in known)
            if t - newest <= age:
                want = max(r[2] for r in known if r[1] == newest)
        assert got[i] == want


def test_quantiles_match_interpolation(spark):
    rnd = random.Random(13)
    values = [rnd.choice([0, 1, 7, 511, 512, 513, 10**6, 10**11, -5, -4096]) for _ in range(301)]
    values += [rnd.randrange(10**9) for _ in range(200)]
    df = spark.createDataFrame([("g", v) for v in values] + [("h", 3)], "g string, v bigint")
    qs = {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.95, "e": 1.0}
    got = {r.g: r for r in exact_quantiles(df, ["g"], "v", qs).collect()}
    ordered = sorted(values)
    for name, q in qs.items():
        pos = (len(ordered) - 1) * q
        lo = int(pos)
        hi = min(lo + 1, len(ordered) - 1)
        want = ordered[lo] + (ordered[hi] - ordered[lo]) * (pos - lo)
        assert got["g"][name] == pytest.approx(want)
        assert got["h"][name] == 3.0


def test_rank_share(spark):
    df = spark.createDataFrame([(1,), (5,), (5,), (9,)], "v bigint")
    got = sorted((r.v, r.s) for r in with_rank_share(df, "v", "s").collect())
    assert got == [(1, 0.0), (5, 1 / 3), (5, 1 / 3), (9, 1.0)]


def test_hot_key_windows_are_cut_by_time(spark, claims):
    """No window of the plan is partitioned by the provider alone over claim rows."""
    plan = rolling_frame(claims, ["provider_npi"], 30)._jdf.queryExecution().executedPlan()
    windows = [l for l in plan.toString().splitlines() if " Window [" in l]
    assert windows
    for line in windows:
        # Either cut by day, or over daily totals (frame over the day number).
        assert "_day" in line, line
    state = arrival_order(claims)
    text = (
        running_totals(state, ["provider_npi"], 30, order=["arrival"])
        ._jdf.queryExecution()
        .executedPlan()
        .toString()
    )
    for line in (l for l in text.splitlines() if " Window [" in l):
        assert "_hour" in line or "_slot" in line, line


@pytest.mark.parametrize("light", [0, 20, 4096])
def test_frames_of_light_and_large_keys_agree(spark, light):
    rows = random_rows(21) + [(None, 5, 1, "p", 900), ("a", None, 2, "q", 901), ("b", 7, None, None, 902)]
    df = make(spark, rows)
    plain = rolling_frame(df, ["k"], 30, kind="kind", light=0)
    got = rolling_frame(df, ["k"], 30, kind="kind", light=light)
    assert got.schema == plain.schema
    assert sorted(map(str, got.collect())) == sorted(map(str, plain.collect()))
    by_id = {r.id: r for r in got.collect()}
    assert by_id[900].n is None and by_id[901].n is None
    frame = [r for r in rows if r[0] == "b" and r[1] is not None and 7 - 30 * DAY <= r[1] <= 7]
    assert by_id[902].n == len(frame)
    assert by_id[902].total_cents == sum(r[2] or 0 for r in frame)


def stored(spark, name):
    """Folders of the work folder with this name."""
    import glob

    from claimsight.session import work_root

    return glob.glob(f"{work_root(spark).replace('file:', '')}/{name}-*")


def test_features_at_time_store_the_claims_once(spark, claims):
    """The second profile is not taken from rows that carry the first, worked out anew."""
    from suite.fixture import tokenized

    before = len(stored(spark, "timed-claims"))
    plan = ft.claim_features_at_time(tokenized(claims))._jdf.queryExecution().toString()
    assert len(stored(spark, "timed-claims")) == before + 1
    # Neither the frames nor their totals read the order lines again.
    assert "l_orderkey" not in plan


@pytest.mark.parametrize("light", [0, 20, 4096])
@pytest.mark.parametrize("digits", [0, 2])
def test_totals_of_light_and_large_keys_agree(spark, light, digits):
    rows = random_rows(22)
    df = make(spark, rows).withColumn("arrival", F.md5(F.col("id").cast("string")))
    carry = spark.createDataFrame(
        [("a", 3, 50, -60 * DAY), ("b", 4, 60, 10 * DAY), ("hot", 5, 70, -41 * DAY), ("z", 9, 9, 9)],
        "k string, n bigint, total_cents bigint, last_sec bigint",
    )
    options = dict(order=["arrival"], slot_digits=digits, light=light)
    got = running_totals(df, ["k"], 30, **options).collect()
    want = brute_running([(r.k, r.sec, r.arrival, r.amount_cents, r.id) for r in got], 30)
    assert {r.id: (r.n, r.total_cents) for r in got} == want
    lean = df.drop("arrival")
    digest = F.md5(F.col("id").cast("string"))
    odd = make(spark, [(None, 5, 1, "p", 900), ("a", None, 2, "q", 901), ("b", 7, None, None, 902)])
    odd = lean.unionByName(odd).withColumn("arrival", digest)
    carried = running_totals(odd, ["k"], 30, carry=carry, digest=digest, **options)
    large = running_totals(odd, ["k"], 30, carry=carry, order=["arrival"], slot_digits=digits, light=0)
    assert carried.schema == large.schema
    assert sorted(map(str, carried.collect())) == sorted(map(str, large.collect()))


@pytest.mark.parametrize("size,slide", [("30 days", "1 day"), ("25 hours", "6 hours")])
def test_sliding_profiles_of_a_batch(spark, size, slide):
    """Every window with a row, once; no row is copied for each of its windows."""
    from claimsight.streaming.flows import sliding_profiles

    rows = random_rows(31) + [(None, 5, 1, "p", 900), ("a", None, 2, "q", 901), ("c", 7, None, None, 902)]
    df = make(spark, rows)
    got = sliding_profiles(df, "k", size, slide)
    assert "Expand" not in got._jdf.queryExecution().executedPlan().toString()
    want = (
        df.groupBy(F.window("event_time", size, slide).alias("w"), "k")
        .agg(F.count(F.lit(1)).alias("claim_count"), F.sum("amount_cents"), F.max("amount_cents"))
        .select("w.start", "w.end", "k", "claim_count", "sum(amount_cents)", "max(amount_cents)")
    )
    if size == "30 days":  # else a slide is in a window as a whole or not at all
        assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    slid = df.groupBy(F.window("event_time", slide).alias("s"), "k").agg(
        F.count(F.lit(1)).alias("n"), F.sum("amount_cents").alias("t"), F.max("amount_cents").alias("m")
    )
    slid = slid.withColumn("at", F.window_time("s")).groupBy(F.window("at", size, slide).alias("w"), "k")
    slid = slid.agg(F.sum("n"), F.sum("t"), F.max("m")).select("w.start", "w.end", "k", "sum(n)", "sum(t)", "max(m)")
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, slid.collect()), key=str)

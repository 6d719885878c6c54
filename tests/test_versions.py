"""Tables that change in one step, and the state tables of streams."""

import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from claimsight.operators import graph
from claimsight.operators.scoring import arrival_order, running_profiles, score_claims
from claimsight.operators.tables import checksum, folders
from claimsight.operators.versions import VersionedTable
from claimsight.session import work_path
from claimsight.streaming.state import ClaimState

ROWS = [("a", "2024-01-01", 1), ("b", "2024-01-01", 2), ("c", "2024-01-02", 3), ("d", None, 4)]


def table_of(spark, rows=ROWS, kind="DATE"):
    df = spark.createDataFrame(rows, "k STRING, day STRING, v BIGINT").withColumn("day", F.col("day").cast(kind))
    return df


def held(t):
    return sorted(((r.k, str(r.day) if r.day else None, r.v) for r in t.read().collect()), key=str)


def test_changes_keep_untouched_folders(spark):
    t = VersionedTable(spark, work_path(spark, "versions"), "day")
    t.append(table_of(spark))
    first = t.current().folders
    t.upsert(table_of(spark, [("c", "2024-01-03", 30), ("e", "2024-01-03", 5)]), "k", ("v",))
    assert held(t) == sorted([ROWS[0], ROWS[1], ROWS[3], ("c", "2024-01-03", 30), ("e", "2024-01-03", 5)], key=str)
    # The first day and the null day stay where they were, the emptied day is gone.
    assert {f for f in first if "01-02" not in f} < set(t.current().folders)
    assert not any("01-02" in f for f in t.current().folders)
    t.insert_ignore(table_of(spark, [("a", "2024-01-09", 9), ("f", None, 6), ("f", None, 7)]), "k")
    assert [r[2] for r in held(t) if r[0] in "af"] == [1, 6]
    t.erase(spark.createDataFrame([("f",), ("b",), ("x",)], "k STRING"), "k")
    assert [r[0] for r in held(t)] == ["a", "c", "d", "e"]
    before = held(t)
    t.clean()
    assert held(t) == before
    assert {f"{v}/{p}" for v in folders(spark, t.path) for p in folders(spark, f"{t.path}/{v}")} == set(t.current().folders)


def test_a_stop_before_the_switch_changes_nothing(spark, monkeypatch):
    t = VersionedTable(spark, work_path(spark, "versions"), "day")
    t.append(table_of(spark))
    reader, before = t.read(), held(t)

    def stop(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(VersionedTable, "_switch", stop)
        with pytest.raises(KeyboardInterrupt):
            t.upsert(table_of(spark, [("a", "2024-01-01", 100)]), "k", ("v",))
    assert "version=2" in folders(spark, t.path)
    assert held(t) == before == sorted(((r.k, str(r.day) if r.day else None, r.v) for r in reader.collect()), key=str)
    t.upsert(table_of(spark, [("a", "2024-01-05", 7)]), "k", ("v",))
    assert ("a", "2024-01-05", 7) in held(t) and len(held(t)) == 4


def test_a_second_writer_is_refused(spark):
    path = work_path(spark, "versions")
    one, two = VersionedTable(spark, path, "day"), VersionedTable(spark, path, "day")
    one.append(table_of(spark))
    stale = two.current()
    one.append(table_of(spark, [("z", "2024-01-01", 9)]))
    with pytest.raises(RuntimeError, match="changed meanwhile"):
        two._publish(stale, stale.folders, table_of(spark, [("y", "2024-01-01", 9)]))
    assert len(held(one)) == 5


def test_retention_drops_whole_days(spark):
    t = VersionedTable(spark, work_path(spark, "versions"), "day")
    t.append(table_of(spark, [*ROWS, ("old", "2016-12-31", 0), ("edge", "2017-02-28", 0)]))
    t.expire(date(2024, 2, 29))
    assert [r[0] for r in held(t)] == ["a", "b", "c", "d", "edge"]


def test_compaction_leaves_large_files(spark):
    t = VersionedTable(spark, work_path(spark, "versions"), "day")
    big = [(f"{random.random()}", "2024-01-01", i) for i in range(20_000)]
    t.append(table_of(spark, big).coalesce(1))
    large = t.current().folders
    for i in range(4):
        t.append(table_of(spark, [(f"s{i}", "2024-01-01", i), (f"t{i}", "2024-01-02", i), (f"n{i}", None, i)]))
    before = checksum(t.read())
    rewritten = t.compact(target_bytes=100_000)
    assert set(rewritten).isdisjoint(large) and len(rewritten) == 12
    assert set(large) < set(t.current().folders) and len(t.current().folders) == 4
    assert checksum(t.read()) == before
    assert t.compact(target_bytes=100_000) == []
    # Larger target: the large file is small now, and its day is cut into pieces by bytes.
    assert large[0] in t.compact(target_bytes=10_000_000)
    assert checksum(t.read()) == before


# Stream state ------------------------------------------------------------------------------


def claim_rows(spark, rows):
    return spark.createDataFrame(
        rows,
        "claim_id STRING, provider_npi STRING, member_id STRING, procedure_code STRING,"
        " diagnosis_code STRING, amount_cents BIGINT, status STRING, event_time STRING",
    ).withColumn("event_time", F.to_timestamp("event_time"))


def random_claims(n, seed=4):
    random.seed(seed)
    rows = []
    for i in range(n):
        day, sec = random.choice([1, 2, 3, 60, 61, 150, 300]), random.choice([0, 0, 5, 4000])
        at = f"2024-{1 + day // 28:02d}-{1 + day % 28:02d} {sec // 3600:02d}:{sec % 3600 // 60:02d}:{sec % 60:02d}"
        provider = random.choice(["hot", "hot", "p", None])
        rows.append((f"c{i}", provider, random.choice("xyz"), "27447", "I10", random.randint(0, 900), "P", at))
    return rows


@pytest.mark.parametrize("merge_every", [2, 50])
def test_states_carry_over_batches(spark, merge_every):
    rows = sorted(random_claims(300), key=lambda r: r[-1])
    names = ["claim_id", "claim_count_30d", "avg_cents_30d", "member_claim_count_90d"]
    whole = running_profiles(claim_rows(spark, rows)).select(names)
    state = ClaimState(spark, work_path(spark, "state"), merge_every=merge_every)
    cuts = [0, 40, 41, 200, 300]
    # Whole seconds stay together: the order inside a second is by digest.
    cuts = [next((k for k in range(c, 300) if k == 0 or rows[k][-1] != rows[k - 1][-1]), 300) for c in cuts]
    parts = None
    for b, (lo, hi) in enumerate(zip(cuts, cuts[1:], strict=False)):
        batch = claim_rows(spark, rows[lo:hi])
        for _ in range(2):  # a batch that runs again starts from the same state
            got = running_profiles(batch, **state.before(b)).select(names).cache()
            state.keep(batch, b)
        parts = got if parts is None else parts.unionByName(got)
    assert checksum(parts) == checksum(whole)


def test_late_rows_go_on_with_the_state(spark):
    state = ClaimState(spark, work_path(spark, "state"))
    row = lambda i, at: (f"c{i}", "p", "m", "x", "y", 10, "P", at)
    batches = [[row(0, "2024-06-01")], [row(1, "2024-01-01"), row(2, "2024-06-20")], [row(3, "2024-07-15")]]
    got = {}
    for b, rows in enumerate(batches):
        batch = claim_rows(spark, rows)
        for r in running_profiles(batch, **state.before(b)).collect():
            got[r.claim_id] = r.claim_count_30d
        state.keep(batch, b)
    assert got == {"c0": 1, "c1": 2, "c2": 3, "c3": 4}


def test_a_hot_key_is_split_and_no_worker_runs_python(spark):
    claims = arrival_order(claim_rows(spark, random_claims(50)))
    state = ClaimState(spark, work_path(spark, "state"))
    state.keep(claims.drop("arrival"), 0)
    plan = score_claims(claims, carries=state.before(1))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "InPandas" not in plan
    # Every window over rows has the slot of a second among its keys, the others run over totals.
    for window in [line for line in plan.splitlines() if "windowspecdefinition" in line and "arrival" in line]:
        assert "_slot" in window


# Pairs of providers ------------------------------------------------------------------------


def plain_pairs(rows, least):
    from collections import Counter, defaultdict
    from itertools import combinations

    members = defaultdict(set)
    for p, m in rows:
        if p is not None and m is not None:
            members[m].add(p)
    counts = Counter(pair for ps in members.values() for pair in combinations(sorted(ps), 2))
    return {(*pair, n) for pair, n in counts.items() if n >= least}


@pytest.mark.parametrize("least", [1, 2, 3])
def test_pair_counts_equal_all_pairs(spark, least):
    random.seed(8)
    rows = [(random.choice([*"abcdefgh", None]), random.choice(["m1", "m2", "m3", "m4", "m5", None])) for _ in range(60)]
    df = spark.createDataFrame(rows, "provider_npi STRING, member_id STRING")
    got = {tuple(r) for r in graph.shared_member_pairs(df, least, chunk=3).collect()}
    assert got == plain_pairs(rows, least)


def test_a_member_of_all_providers_makes_no_pairs(spark):
    rows = [(f"p{i}", "everyone") for i in range(5000)] + [(f"p{i}", f"m{i // 2}") for i in range(1000)]
    df = spark.createDataFrame(rows, "provider_npi STRING, member_id STRING")
    got = {tuple(sorted((r.left, r.right))) for r in graph.shared_member_pairs(df, 2).collect()}
    assert got == {tuple(sorted((f"p{2 * i}", f"p{2 * i + 1}"))) for i in range(500)}

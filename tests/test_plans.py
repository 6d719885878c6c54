"""Batch plans, tables, sources and the shape of physical plans."""

import os
import subprocess
import sys
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from claimsight.operators import quality, tables
from claimsight.operators import features as ft
from claimsight.operators.graph import communities
from claimsight.plans.batch import run_gold, run_scoring, run_silver, silver
from claimsight.session import work_path
from claimsight.sources import changes as ch
from claimsight.sources import claims as src
from claimsight.sources import files
from suite.fixture import as_text_messages, tokenized

RUN = dict(run_date=date(2001, 8, 2), run_time=datetime(2001, 8, 2, 2))


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def write_bronze(spark, claims):
    root = work_path(spark, "bronze")
    m = as_text_messages(claims).withColumns(
        {"year": F.lit("2001"), "month": F.lit("08"), "day": F.lit("01")}
    )
    m.write.partitionBy("year", "month", "day").json(root)
    return root


def test_bronze_to_gold(spark, claims):
    bronze = write_bronze(spark, claims)
    with open(f"{bronze.replace('file:', '')}/year=2001/month=08/day=01/bad.json", "w") as f:
        f.write('{"claim_id": \n')
    silver_path, gold = work_path(spark, "silver"), work_path(spark, "gold")
    counts = run_silver(spark, bronze, silver_path, **RUN)
    assert counts["read"] == claims.count() + 1
    assert counts["read"] == counts["kept"] + counts["dropped"]
    stored = spark.read.parquet(silver_path)
    assert not set(stored.columns) & {"member_id", "provider_npi", "provider_name"}
    assert stored.groupBy("claim_id").count().filter("count > 1").count() == 0
    before = tables.checksum(stored)
    run_silver(spark, bronze, silver_path, **RUN)
    stored = spark.read.parquet(silver_path)
    assert tables.checksum(stored) == before
    made = run_gold(spark, silver_path, gold, RUN["run_time"])
    assert made["claim_features"].count() == stored.count()
    assert made["claim_features"].filter("claim_count_30d IS NULL").count() == 0
    # Small stored profiles are broadcast, by their size and not by a hint.
    again = ft.claim_features(
        stored,
        spark.read.parquet(f"{gold}/provider_features").drop("computed_at"),
        spark.read.parquet(f"{gold}/member_features").drop("computed_at"),
    )
    assert "BroadcastHashJoin" in plan_of(again)


def test_silver_keeps_claims_of_earlier_runs(spark, claims):
    """Two runs over overlapping dates; an id that moves to another date is there once."""
    from pyspark.sql import functions as F

    from claimsight.session import materialize

    days = claims.filter("event_time IS NOT NULL AND amount_cents > 0").orderBy("event_time", "claim_id").limit(60)
    rows = materialize(days.dropDuplicates(["claim_id"]), "rows")
    moved = rows.orderBy("claim_id").limit(5)
    moved = materialize(moved.withColumn("event_time", F.col("event_time") + F.expr("INTERVAL 400 DAYS")), "moved")
    target = work_path(spark, "silver-runs")
    first = write_bronze(spark, rows.filter("crc32(claim_id) % 2 = 0"))
    second = write_bronze(spark, rows.filter("crc32(claim_id) % 2 = 1").unionByName(moved))
    for bronze in (first, second, second):
        run_silver(spark, bronze, target, **RUN)
    stored = spark.read.parquet(target)
    assert stored.count() == rows.count() == stored.select("claim_id").distinct().count()
    late = {r[0] for r in moved.select("claim_id").collect()}
    newest = rows.agg(F.max("event_time")).first()[0]
    got = {r[0] for r in stored.filter(F.col("event_time") > newest).select("claim_id").collect()}
    assert got == late


def test_alerts_of_two_runs_accumulate(spark, claims):
    target = work_path(spark, "alerts-runs")
    _, first = run_scoring(claims, target, datetime(2001, 8, 2))
    for _ in range(2):
        _, second = run_scoring(claims, target, datetime(2001, 8, 3))
        assert second.count() == 0
        assert spark.read.parquet(f"{target}/alerts").count() == first.count() > 0


def test_erasure_of_null_and_escaped_partitions(spark):
    path = work_path(spark, "erase-odd")
    df = spark.createDataFrame(
        [("a", "t 10:00"), ("b", "t 10:00"), ("b", None), ("b", "x=y"), ("c", None)],
        "member_id_token string, part string",
    )
    df.write.partitionBy("part").parquet(path)
    gone = spark.createDataFrame([("b",)], "member_id_token string")
    tables.erase_in_table(path, gone, "member_id_token", "part")
    got = {tuple(r) for r in spark.read.parquet(path).select(*df.columns).collect()}
    assert got == {("a", "t 10:00"), ("c", None)}


def test_claims_without_a_time_are_scored(spark, claims):
    from pyspark.sql import functions as F

    from claimsight.operators.scoring import score_claims
    from claimsight.operators.quality import dedup

    c = dedup(claims).withColumn(
        "event_time", F.when(F.crc32("claim_id") % 7 != 0, F.col("event_time"))
    )
    scored = score_claims(c)
    assert scored.count() == c.count()
    untimed = scored.filter("event_time IS NULL")
    assert untimed.filter("rule_points IS NULL OR fraud_points IS NULL").count() == 0
    assert untimed.filter("claim_count_30d IS NOT NULL").count() == 0


def test_communities_do_not_depend_on_names(spark):
    from claimsight.operators.graph import group_links

    rows = [("a", "m1"), ("b", "m1"), ("b", "m2"), ("z", "m2"), ("z", "m3"), ("c", "m3"), ("d", "m4")]
    for name in ("z", "0"):
        df = spark.createDataFrame([(p.replace("z", name), m) for p, m in rows], "provider_npi string, m string")
        got = communities(group_links(df, ["m"]), "anchor", "provider").collect()
        nodes = {"a", "b", name, "c"}
        assert {(r.node, r.community) for r in got} == {(n, min(nodes)) for n in nodes}


def test_silver_has_no_python_and_no_window(spark, claims):
    clean, _ = silver(as_text_messages(claims), **RUN)
    text = plan_of(clean)
    assert "Python" not in text and "Window" not in text


def test_scoring_plan_writes_new_alerts(spark, claims):
    target = work_path(spark, "scored")
    scored, alerts = run_scoring(claims, target, datetime(2001, 8, 2))
    assert alerts.count() == scored.filter("fraud_score >= 0.65").count() > 0
    _, repeated = run_scoring(
        claims, work_path(spark, "scored"), datetime(2001, 8, 3), earlier_alerts=alerts
    )
    assert repeated.count() == 0


def test_filters_and_columns_reach_the_scan(spark, sf):
    from suite.fixture import table

    df = table(spark, sf, "lineitem").filter("l_discount > 0.05").select("l_orderkey")
    text = df._jdf.queryExecution().toString()
    assert "GreaterThan(l_discount,0.05)" in text
    assert "ReadSchema: struct<l_orderkey:bigint,l_discount:double>" in text


def test_corrupt_lines(spark):
    lines = spark.createDataFrame(
        [('{"claim_id": "a", "amount": 1.5}',), ("{bad",), ("17",), ("[1]",), ("",)],
        "value string",
    )
    good, bad = quality.split_parsed(src.parse_lines(lines))
    assert [r.claim_id for r in good.collect()] == ["a"]
    assert {r.value for r in bad.collect()} == {"{bad", "17", "[1]", ""}


def test_observed_counts(spark):
    rows = [("c", "m", "p", 1)] * 5 + [(None, "m", "p", 1), ("c", None, "p", 1)]
    df = spark.createDataFrame(rows, "claim_id string, member_id string, provider_npi string, amount int")
    kept, seen = quality.observe_malformed(df)
    assert kept.count() == 5
    assert seen.get == {"read": 7, "kept": 5, "dropped": 2}


def test_dedup_is_idempotent(claims):
    once = quality.dedup(claims)
    assert tables.checksum(quality.dedup(once)) == tables.checksum(once)


def test_change_samples(spark):
    row = '"claim_id":"CLM-A","provider_npi":"NPI-001","member_id":"M","amount":"362.50","status":"%s"'
    values = [
        '{"before":null,"after":{%s},"op":"c","ts_ms":1}' % (row % "PENDING"),
        '{%s,"__op":"u","__ts_ms":2}' % (row % "APPROVED"),
        None,
    ]
    df = spark.createDataFrame([(v,) for v in values], "value string")
    got = ch.read_changes(df).orderBy("ts_ms").collect()
    assert [(r.op, r.ts_ms, r.status, r.amount) for r in got] == [
        ("c", 1, "PENDING", "362.50"),
        ("u", 2, "APPROVED", "362.50"),
    ]
    gone = spark.createDataFrame(
        [('{"before":{%s},"after":null,"op":"d","ts_ms":3}' % (row % "APPROVED"),)], "value string"
    )
    feed = ch.read_changes(df.unionByName(gone))
    assert ch.state_as_of(feed, 2).first().status == "APPROVED"
    assert ch.state_as_of(feed, 3).count() == 0


def test_erase_rewrites_only_touched_partitions(spark):
    path = work_path(spark, "erasable")
    df = spark.createDataFrame(
        [("a", 1), ("b", 1), ("b", 2), ("c", 3)], "member_id_token string, day int"
    )
    df.repartition(1).write.partitionBy("day").parquet(path)
    files_before = {r[0] for r in spark.read.parquet(path).filter("day = 3").select(F.input_file_name()).collect()}
    gone = spark.createDataFrame([("b",)], "member_id_token string")
    tables.erase_in_table(path, gone, "member_id_token", "day")
    after = spark.read.parquet(path)
    assert sorted((r[0], r[1]) for r in after.collect()) == [("a", 1), ("c", 3)]
    assert files_before == {
        r[0] for r in after.filter("day = 3").select(F.input_file_name()).collect()
    }


def test_namespace_and_catalog_table(spark):
    tables.ensure_namespace(spark, "claims_zone")
    df = spark.range(10).withColumn("part", F.col("id") % 2)
    tables.write_table(df, "claims_zone.numbers", ["part"])
    assert src.read_table(spark, "claims_zone.numbers").count() == 10
    tables.write_table(df.limit(3), "claims_zone.numbers", ["part"])
    assert src.read_table(spark, "claims_zone.numbers").count() == 3
    spark.sql("DROP TABLE claims_zone.numbers")


def test_dimensions_from_files(spark):
    root = work_path(spark, "dims")
    spark.createDataFrame(
        [("NPI-001", "Clinic", "CARDIOLOGY", None, "ACTIVE", datetime(2020, 1, 1))],
        "npi string, name string, specialty string, license_no string, status string, created_at timestamp",
    ).write.parquet(f"{root}/providers")
    spark.createDataFrame(
        [("M", "GOLD", "ACTIVE", date(2020, 1, 1))],
        "member_id string, plan_id string, status string, enrolled_at date",
    ).write.parquet(f"{root}/members")
    p, m = src.read_dimensions(spark, root=root)
    assert p.first().npi == "NPI-001" and m.first().plan_id == "GOLD"


def test_media_files(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x.PDF").write_bytes(b"pdf")
    (tmp_path / "y.bin").write_bytes(b"12")
    got = {r.file_name: r for r in files.read_media(spark, str(tmp_path)).collect()}
    assert got["x.PDF"].kind == "document" and got["x.PDF"].size == 3
    assert got["y.bin"].kind == "other" and got["y.bin"].size == 2


def test_compact_keeps_rows(spark):
    source, target = work_path(spark, "small"), work_path(spark, "big")
    spark.range(500).withColumn("p", F.col("id") % 3).repartition(8).write.partitionBy("p").parquet(source)
    assert tables.compact(spark, source, target, ["p"])["rows"] == 500
    assert spark.read.parquet(target).select(F.input_file_name()).distinct().count() == 3


def test_communities_of_a_long_chain(spark):
    links = [(f"n{i:03d}", f"n{i + 1:03d}") for i in range(60)] + [("x1", "x2"), ("x2", "x3")]
    got = communities(spark.createDataFrame(links, "a string, b string"), "a", "b").collect()
    assert {r.node: r.community for r in got} == {
        **{f"n{i:03d}": "n000" for i in range(61)},
        "x1": "x1",
        "x2": "x1",
        "x3": "x1",
    }


def test_features_use_only_the_past(spark, claims):
    c = tokenized(claims)
    half = c.agg(F.expr("percentile(unix_seconds(event_time), 0.5)")).first()[0]
    early = c.filter(F.unix_seconds("event_time") <= half)
    columns = ["claim_id", "amount", "claim_count_30d", "total_amount_90d", "distinct_providers_90d"]
    whole = ft.claim_features_at_time(c).filter(F.unix_seconds("event_time") <= half)
    assert tables.checksum(whole.select(columns)) == tables.checksum(
        ft.claim_features_at_time(early).select(columns)
    )


def test_queries_can_be_listed_without_a_session():
    code = "import __spark_entry__ as e; assert set(e.oracle_sql()) < set(e.queries())"
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    subprocess.run([sys.executable, "-c", code], check=True, cwd=root)


def test_lines_and_changes_are_parsed_once(spark):
    """A filter on a parsed column neither parses the text again nor makes it again."""
    made = spark.range(3).select(F.to_json(F.struct(F.col("id").cast("string").alias("claim_id"))).alias("value"))
    good = src.parse_lines(made).filter("_corrupt_record IS NULL AND claim_id <> '1'")
    changes = ch.read_changes(made).filter("ts_ms > 0")
    for df in (good, changes):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("from_json(") == 1, plan
    assert sorted(r.claim_id for r in good.collect()) == ["0", "2"]


def test_flat_and_enveloped_changes_and_broken_ones(spark):
    lines = [
        '{"claim_id": "a", "amount": "1", "__op": "c", "__ts_ms": 5}',
        '{"before": {"claim_id": "b"}, "after": null, "op": "d", "ts_ms": 6}',
        '{"before": null, "after": {"claim_id": "c"}, "op": "u", "ts_ms": "bad"}',
        '{"claim_id": "d", "__op": "c", "__ts_ms": 7',
        "[1]",
        "",
        None,
        '{"claim_id": "e"}',
    ]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    got = {(r.claim_id, r.op, r.ts_ms) for r in ch.read_changes(df).collect()}
    assert {("a", "c", 5), ("b", "d", 6)} <= got
    from claimsight.schemas import CHANGE_ENVELOPE, CHANGE_FLAT

    # As two separate readings see the same lines.
    two = df.filter("value IS NOT NULL").select(
        F.from_json("value", CHANGE_ENVELOPE).alias("e"), F.from_json("value", CHANGE_FLAT).alias("f")
    )
    two = two.selectExpr(
        "CASE WHEN e.op IS NOT NULL THEN coalesce(e.after, e.before).claim_id ELSE f.claim_id END AS claim_id",
        "coalesce(e.op, f.__op) AS op",
        "coalesce(e.ts_ms, f.__ts_ms) AS ts_ms",
    ).filter("op IS NOT NULL")
    assert got == {tuple(r) for r in two.collect()}


def test_stored_frames_leave_no_shuffle_files(spark):
    import time

    from claimsight.session import WorkTables

    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffles():
        names = [files.getAllFiles().apply(i).getName() for i in range(files.getAllFiles().size())]
        return {n for n in names if n.startswith("shuffle_")}

    before, work = shuffles(), WorkTables()
    rows = spark.range(1000).selectExpr("id % 7 AS k").groupBy("k").count()
    kept = work(rows, "counts")
    for _ in range(100):
        if not (left := shuffles() - before):
            break
        time.sleep(0.1)
    assert not left
    assert sorted(map(tuple, kept.collect())) == sorted(map(tuple, rows.collect()))
    work.remove()


@pytest.mark.parametrize("name", ["claim_features", "deviating_claims", "billed_twice_24h", "prior_claims_24h"])
def test_claims_are_derived_once_and_stored(spark, sf, name):
    """What is left of the query reads work tables, not the order lines over and over."""
    from suite import load

    files = load().QUERIES[name](spark, sf).inputFiles()
    assert files and not any(sf in f for f in files)


def test_raw_claims_are_written_compressed(spark, sf):
    from suite import load

    files = load().QUERIES["read_bronze"](spark, sf).inputFiles()
    assert files and all(f.endswith(".json.gz") for f in files)


def test_first_profile_at_time_is_stored(spark, claims):
    """The second frame starts from a table: shuffle files of the first are gone by then."""
    from suite.fixture import tokenized

    from claimsight.operators.features import claim_features_at_time

    files = claim_features_at_time(tokenized(claims)).inputFiles()
    assert any("provider-timed" in f for f in files)

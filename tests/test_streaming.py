"""The stream gives what the batch gives, also over restarts."""

import os

import pytest
from pyspark.sql import functions as F

from claimsight.operators import models as md
from claimsight.operators import scoring as sc
from claimsight.operators.tables import checksum
from claimsight.session import work_path
from claimsight.sources.claims import read_claims_stream
from claimsight.streaming import flows

COLUMNS = [
    "claim_id",
    "amount_cents",
    "claim_count_30d",
    "avg_cents_30d",
    "member_claim_count_90d",
    "fraud_points",
    "risk_level",
]


@pytest.fixture(scope="module")
def ordered_files(spark, claims):
    """Claims in time order in four JSON files; whole seconds stay together."""
    at = F.unix_seconds("event_time")
    cuts = claims.select(at.alias("s")).approxQuantile("s", [0.25, 0.5, 0.75], 0.0)
    part = sum((at > c).cast("int") for c in cuts)
    text = claims.select(
        part.alias("part"),
        F.to_json(
            F.struct(
                "claim_id",
                "provider_npi",
                "member_id",
                "procedure_code",
                "diagnosis_code",
                "amount",
                F.col("service_date").cast("string").alias("service_date"),
                F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss").alias("submitted_at"),
                "status",
            )
        ).alias("value"),
    ).collect()
    parts = [[r.value for r in text if r.part == i] for i in range(4)]
    return parts


def drop_file(folder, i, lines):
    os.makedirs(folder, exist_ok=True)
    path = f"{folder}/{i}.jsonl"
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")
    # Files are read in the order of their times.
    os.utime(path, (1_700_000_000 + 60 * i,) * 2)


def local(path):
    return path.replace("file:", "")


def start(spark, folder, target, **options):
    lines = read_claims_stream(spark, path=folder, files_per_trigger=1)
    return flows.score_to(
        flows.typed_claims(lines),
        flows.table_writer(target),
        f"{target}/checkpoint",
        every=None,
        **options,
    )


def test_stream_equals_batch_over_a_restart(spark, claims, ordered_files):
    folder, target = local(work_path(spark, "feed")), local(work_path(spark, "scored"))
    for i in (0, 1):
        drop_file(folder, i, ordered_files[i])
    start(spark, folder, target, volume=20).awaitTermination()
    for i in (2, 3):
        drop_file(folder, i, [*ordered_files[i], "{broken", "42"])
    start(spark, folder, target, volume=20).awaitTermination()
    scored = spark.read.parquet(f"{target}/scored")
    assert scored.select("batch_id").distinct().count() == 4
    batch = sc.score_claims(claims, volume=20)
    assert checksum(scored.select(COLUMNS)) == checksum(batch.select(COLUMNS))
    alerts = spark.read.parquet(f"{target}/alerts")
    assert checksum(alerts.select(COLUMNS)) == checksum(
        sc.above_threshold(batch).select(COLUMNS)
    )


def test_a_repeated_batch_replaces_itself(spark, claims):
    target = work_path(spark, "twice")
    scored = sc.score_claims(claims)
    write = flows.table_writer(target)
    write(scored, 0)
    once = checksum(spark.read.parquet(f"{target}/scored"))
    write(scored, 0)
    assert checksum(spark.read.parquet(f"{target}/scored")) == once


def test_poison_is_archived_nowhere_and_kept_in_quarantine(spark, ordered_files):
    folder = local(work_path(spark, "feed"))
    drop_file(folder, 0, [*ordered_files[0][:20], "{broken", "[]"])
    archive, aside = work_path(spark, "archive"), work_path(spark, "aside")
    lines = read_claims_stream(spark, path=folder)
    flows.archive_raw(lines, archive, f"{archive}-c", every=None).awaitTermination()
    flows.quarantine(lines, aside, f"{aside}-c", every=None).awaitTermination()
    kept = spark.read.text(archive)
    assert {"year", "month", "day"} < set(kept.columns)
    assert {r.value for r in kept.collect()} == {*ordered_files[0][:20], "[]"}
    assert {r.value for r in spark.read.text(aside).collect()} == {"{broken", "[]"}


def test_state_restarts_after_the_pause(spark):
    folder, target = local(work_path(spark, "feed")), local(work_path(spark, "paused"))
    line = (
        '{"claim_id":"%s","provider_npi":"p","member_id":"m","procedure_code":"x",'
        '"diagnosis_code":"y","amount":1.00,"submitted_at":"%s","status":"PENDING"}'
    )
    days = ["2024-01-01", "2024-01-30", "2024-02-29", "2024-03-30", "2024-07-01"]
    for i, d in enumerate(days):
        drop_file(folder, i, [line % (f"c{i}", f"{d}T00:00:00")])
    start(spark, folder, target).awaitTermination()
    rows = spark.read.parquet(f"{target}/scored").orderBy("claim_id").collect()
    # 29 days, then 30 days or more each time for the provider (member: 90 days).
    assert [r.claim_count_30d for r in rows] == [1, 2, 1, 1, 1]
    assert [r.member_claim_count_90d for r in rows] == [1, 2, 3, 4, 1]


def test_model_scores_batch_and_stream_alike(spark, claims, ordered_files):
    ready = sc.model_inputs(sc.apply_rules(sc.running_profiles(claims), volume=20))
    rows = ready.select(
        F.when(F.col("rule_points") >= 8800, 1.0).otherwise(0.0).alias("label"),
        (F.col("amount_cents") / 100).alias("amount"),
        *md.FEATURES[1:],
    ).cache()
    path = work_path(spark, "model")
    model = md.load_or_train(path, rows, trees=3)
    again = md.load_or_train(path, rows, trees=3)
    assert md.evaluate(rows, again) == md.evaluate(rows, model) > 0.85
    folder, target = local(work_path(spark, "feed")), local(work_path(spark, "modelled"))
    for i, lines in enumerate(ordered_files):
        drop_file(folder, i, lines)
    start(spark, folder, target, model=model).awaitTermination()
    wanted = [*COLUMNS, "ml_points"]
    streamed = spark.read.parquet(f"{target}/scored").select(wanted)
    batch = sc.score_claims(claims, model).select(wanted)
    assert checksum(streamed) == checksum(batch)
    assert batch.filter("ml_points > 0").count() > 0


def test_search_and_promotion(spark, claims):
    ready = sc.model_inputs(sc.apply_rules(sc.running_profiles(claims)))
    rows = ready.select(
        F.when(F.col("rule_points") >= 8800, 1.0).otherwise(0.0).alias("label"),
        (F.col("amount_cents") / 100).alias("amount"),
        *md.FEATURES[1:],
    ).cache()
    best, table = md.search(rows, depths=(1, 3), rates=(0.1,), trees=2)
    assert len(table) == 2 and all(0.5 <= t["auc"] <= 1 for t in table)
    weak = md.train(rows.withColumn("label", F.round(F.rand(3))), trees=1, version="weak")
    chosen, gain = md.promote(weak, best, rows)
    assert chosen is best and gain > 0
    kept, gain = md.promote(best, weak, rows)
    assert kept is best and gain < 0


def test_raw_lines_are_kept_compressed(spark, sf):
    """The archive of valid lines, and the raw lines that the queries make for it."""
    from suite.streams import raw_lines

    folder = raw_lines(spark, sf)
    archive = work_path(spark, "archive")
    lines = read_claims_stream(spark, path=folder)
    flows.archive_raw(lines, archive, f"{archive}-c", every=None).awaitTermination()
    for path in (folder, archive):
        assert all(f.endswith(".gz") for f in spark.read.text(path).inputFiles())
    valid = spark.read.text(folder).filter("value LIKE '%}'")
    kept = spark.read.text(archive).select("value")
    assert kept.exceptAll(valid).isEmpty() and valid.exceptAll(kept).isEmpty()

"""Streaming flows over the given tables, and the classifier.

The order lines are read as a file stream and joined with the orders. What is
there is processed and the stream stops; results are read back from the tables
it wrote.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from claimsight.operators import evaluation as ev
from claimsight.operators import models as md
from claimsight.operators import quality
from claimsight.operators import reports as rp
from claimsight.operators import scoring as sc
from claimsight.session import materialize, work_path
from claimsight.sources.claims import read_claims_stream
from claimsight.streaming import flows
from claimsight.streaming.progress import ProgressLog
from suite.fixture import as_text_messages, claims, claims_from, result, table, with_claims
from suite.profiles import STATE_SQL
from suite.registry import SQL, query
from suite.scores import RULES_SQL, SCORED_SQL
from suite.summaries import TIMINGS_CTE, timings


def stream(spark, sf_dir, name, files=64):
    """The table's files as a stream; a glob, as the table may be one file or a folder."""
    schema = spark.read.parquet(f"{sf_dir}/{name}.parquet").schema
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files)
    return reader.parquet(f"{sf_dir}/{name}.parque[t]")


def claims_stream(spark, sf_dir):
    claims(spark, sf_dir)  # session settings
    return claims_from(stream(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders"))


def finish(started):
    """Wait for a stream that stops by itself; its failure is raised here."""
    started.awaitTermination()


def stored(spark, path):
    return spark.read.parquet(path)


# Claims in five parts by year. The last two parts come after a pause of 120 days each, longer
# than the time to live of both states.
PART = "least(4, greatest(0, {year} - 1995))"
PAUSE = 120
FEED_CTE = f""", parted AS (SELECT *, {PART.format(year="CAST(date_part('year', event_time) AS BIGINT)")} AS part FROM claims),
feed AS (SELECT * REPLACE (sec + greatest(0, part - 2) * {PAUSE * 86400} AS sec,
  event_time + to_days(CAST(greatest(0, part - 2) * {PAUSE} AS INT)) AS event_time) FROM parted)"""
STREAMED_SQL = FEED_CTE + STATE_SQL.replace("FROM claims)", "FROM feed)") + RULES_SQL


def feed(spark, sf_dir):
    """Claims with the part of the feed that brings them."""
    parted = claims(spark, sf_dir).withColumn("part", F.expr(PART.format(year="year(event_time)")))
    later = F.expr(f"make_dt_interval(cast(greatest(0, part - 2) * {PAUSE} AS INT))")
    return parted.withColumn("event_time", F.col("event_time") + later)


def played(spark, parts, run):
    """Hand the five parts over one after the other; ``run`` restarts the stream for each.

    ``parts`` has the column ``part``. Every part is one micro-batch, whatever the number of
    its files.
    """
    root = work_path(spark, "feed")
    kept = materialize(parts, "parts")
    schema = kept.drop("part").schema
    for k in range(5):
        kept.filter(F.col("part") == k).drop("part").write.mode("append").parquet(root)
        lines = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1_000_000).parquet(root)
        finish(run(lines))


def scored_feed(spark, sf_dir):
    target = work_path(spark, "scoring")

    def run(rows):
        return flows.score_to(
            rows, flows.table_writer(target), f"{target}/checkpoint", every=None, merge_every=2
        )

    played(spark, feed(spark, sf_dir), run)
    return target


@query(
    "scoring_stream",
    with_claims(
        STREAMED_SQL
        + """
SELECT claim_id, provider_npi, amount_cents, claim_count_30d, avg_cents_30d, member_claim_count_90d, fraud_score,
  risk_level, triggered_rules, part AS batch_id FROM tiered"""
    ),
)
def scoring_stream(spark, sf_dir):
    """Running state, rules and tiers over five micro-batches, restarts and pauses."""
    return result(
        stored(spark, f"{scored_feed(spark, sf_dir)}/scored"),
        "claim_id",
        "provider_npi",
        "amount_cents",
        "claim_count_30d",
        "avg_cents_30d",
        "member_claim_count_90d",
        "fraud_score",
        "risk_level",
        "triggered_rules",
        "batch_id",
    )


@query(
    "alert_stream",
    with_claims(
        STREAMED_SQL
        + """, alerts AS (SELECT *, min(part) OVER (PARTITION BY claim_id) AS first_part FROM tiered WHERE points >= 6500)
SELECT claim_id, risk_level, fraud_score, amount_cents, part AS batch_id FROM alerts WHERE part = first_part"""
    ),
)
def alert_stream(spark, sf_dir):
    """Alerts of the five micro-batches; a claim is alerted by one batch only."""
    alerts = stored(spark, f"{scored_feed(spark, sf_dir)}/alerts")
    return result(alerts, "claim_id", "risk_level", "fraud_score", "amount_cents", "batch_id")


# Lines of the feed with faults of every kind, told by the claim's number.
FAULT = "{claim} % 7"
FAULTS_SQL = FEED_CTE + f""", faulty AS (
SELECT claim_id, part, CAST(string_split(claim_id, '-')[2] AS BIGINT) % 7 AS fault, amount_cents, status FROM feed),
lines AS (SELECT *, CASE fault
    WHEN 0 THEN 'unreadable line' WHEN 1 THEN 'no member_id' WHEN 2 THEN 'no amount'
    WHEN 3 THEN 'no time' WHEN 4 THEN 'unreadable time' END AS reason FROM faulty)"""


def faulty_lines(spark, sf_dir):
    rows = feed(spark, sf_dir).withColumn(
        "fault", F.element_at(F.split("claim_id", "-"), 2).cast("bigint") % 7
    )
    fault = F.col("fault")
    at = F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss")
    message = F.to_json(
        F.struct(
            "claim_id",
            "provider_npi",
            F.when(fault != 1, F.col("member_id")).alias("member_id"),
            "procedure_code",
            "diagnosis_code",
            F.when(fault != 2, F.col("amount")).alias("amount"),
            F.when(fault == 4, F.lit("31/31/1995")).when(fault != 3, at).alias("submitted_at"),
            "status",
        )
    )
    cut = F.concat(F.substring(message, 1, 20), F.lit('","x":'))
    return rows.select("part", F.when(fault == 0, cut).otherwise(message).alias("value"))


@query(
    "stream_rejects",
    with_claims(
        FAULTS_SQL
        + """
SELECT part AS batch_id, reason, count(*) AS n, count(DISTINCT CASE WHEN fault <> 0 THEN claim_id END) AS claims
FROM lines GROUP BY 1, 2"""
    ),
)
def stream_rejects(spark, sf_dir):
    """Lines read per batch and reason; rejected ones from their table, scored ones from theirs."""
    target = work_path(spark, "rejects")

    def run(lines):
        return flows.score_lines_to(
            lines, flows.table_writer(target), f"{target}/rejects", f"{target}/checkpoint", every=None
        )

    played(spark, faulty_lines(spark, sf_dir), run)
    bad = stored(spark, f"{target}/rejects/lines").select(
        "batch_id", "reason", F.get_json_object("line", "$.claim_id").alias("claim_id")
    )
    good = stored(spark, f"{target}/scored").select(
        "batch_id", F.lit(None).cast("string").alias("reason"), "claim_id"
    )
    found = bad.unionByName(good).groupBy("batch_id", "reason").agg(F.countDistinct("claim_id").alias("claims"))
    counted = stored(spark, f"{target}/rejects/counts")
    both = counted.alias("a").join(
        found.alias("b"),
        (F.col("a.batch_id") == F.col("b.batch_id")) & F.col("a.reason").eqNullSafe(F.col("b.reason")),
    )
    return result(both.select("a.batch_id", "a.reason", "n", "claims"))


def raw_lines(spark, sf_dir):
    """Claims as text lines in a folder; those of pending claims are cut off."""
    m = as_text_messages(claims(spark, sf_dir))
    line = F.to_json(F.struct(*m.columns))
    cut = F.when(F.col("status") == "PENDING", F.substring(line, 1, 40)).otherwise(line)
    root = work_path(spark, "lines")
    m.select(cut.alias("value")).write.option("compression", "gzip").text(root)
    return root


@query(
    "archive_stream",
    with_claims(
        """
SELECT status, count(*) AS n, count(DISTINCT claim_id) AS claims FROM claims WHERE status <> 'PENDING' GROUP BY 1"""
    ),
)
def archive_stream(spark, sf_dir):
    """Raw lines archived as they came; unreadable ones are left out."""
    target = work_path(spark, "archive")
    lines = read_claims_stream(spark, path=raw_lines(spark, sf_dir))
    finish(flows.archive_raw(lines, target, f"{target}-checkpoint", every=None))
    kept = spark.read.text(target).select(
        F.get_json_object("value", "$.status").alias("status"),
        F.get_json_object("value", "$.claim_id").alias("claim_id"),
    )
    return result(
        kept.groupBy("status", "claim_id")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("status")
        .agg(F.sum("n").alias("n"), F.count("claim_id").alias("claims"))
    )


@query(
    "quarantine_stream",
    with_claims(
        "\nSELECT length(concat('{\"claim_id\":\"', claim_id)) AS head, count(*) AS n"
        " FROM claims WHERE status = 'PENDING' GROUP BY 1"
    ),
)
def quarantine_stream(spark, sf_dir):
    """Unreadable lines kept aside, counted by the length of their first field."""
    target = work_path(spark, "quarantine")
    lines = read_claims_stream(spark, path=raw_lines(spark, sf_dir))
    finish(flows.quarantine(lines, target, f"{target}-checkpoint", every=None))
    head = F.length(F.regexp_extract("value", r'^(\{"claim_id":"[^"]*)', 1)).alias("head")
    return result(
        spark.read.text(target).groupBy(head).agg(F.count(F.lit(1)).alias("n"))
    )


@query(
    "unrepeated_stream",
    with_claims(
        FEED_CTE
        + """, again AS (SELECT claim_id, event_time, amount_cents, part FROM feed
  UNION ALL SELECT claim_id, event_time, amount_cents, part + 3 FROM feed WHERE part < 2)
SELECT claim_id, strftime(event_time, '%Y-%m-%d %H:%M:%S') AS event_time, min(amount_cents) AS amount_cents,
  min(part) AS batch_id FROM again GROUP BY claim_id, event_time"""
    ),
)
def unrepeated_stream(spark, sf_dir):
    """First row per claim id; two parts of the feed come again years later."""
    rows = feed(spark, sf_dir).select("claim_id", "event_time", "amount_cents", "part")
    again = rows.filter("part < 2").withColumn("part", F.col("part") + 3)
    target = work_path(spark, "unrepeated")

    def run(claims):
        return flows.unrepeated_to(claims, target, f"{target}-checkpoint", every=None)

    played(spark, rows.unionByName(again), run)
    return result(stored(spark, target), "claim_id", "event_time", "amount_cents", "batch_id")


LATENESS = 400
LATE_SQL = f""", parted AS (SELECT *, CAST(string_split(claim_id, '-')[2] AS BIGINT) % 5 AS part FROM claims
  WHERE sec < epoch(DATE '1999-01-01') + 86400 * 365 * (CAST(string_split(claim_id, '-')[2] AS BIGINT) % 5 - 2)),
seen AS (SELECT part, max(sec) AS top FROM parted GROUP BY part),
marks AS (SELECT p.part, max(s.top) - {LATENESS * 86400} AS mark FROM seen p LEFT JOIN seen s ON s.part < p.part GROUP BY p.part)"""


@query(
    "late_rows",
    with_claims(
        LATE_SQL
        + """
SELECT part AS run, count(*) AS input_rows, count(*) FILTER (WHERE sec <= mark) AS late_rows
FROM parted JOIN marks USING (part) GROUP BY part"""
    ),
)
def late_rows(spark, sf_dir):
    """Rows behind the watermark, counted per part of a feed that is out of order."""
    target = work_path(spark, "late")
    number = F.element_at(F.split("claim_id", "-"), 2).cast("bigint")
    rows = claims(spark, sf_dir).withColumn("part", number % 5)
    limit = F.lit(915148800) + 86400 * 365 * (F.col("part") - 2)
    rows = rows.filter(F.unix_seconds("event_time") < limit).select("claim_id", "event_time", "part")
    log = ProgressLog(spark, f"{target}/progress")

    def run(claims):
        once = flows.unrepeated(claims, f"{LATENESS} days")
        writer = once.writeStream.format("parquet").option("path", f"{target}/rows")
        return flows._start(writer, f"{target}/checkpoint", None)

    try:
        played(spark, rows, run)
        reported = log.read()
    finally:
        log.close()
    # Batches with rows are the parts in their order; Spark adds empty ones to move on.
    ordered = Window.orderBy("batch_id")
    parts = reported.filter("input_rows > 0").withColumn("run", F.row_number().over(ordered) - 1)
    return result(parts, "run", "input_rows", "late_rows")


# Events in five parts of six days each, in the order of time.
EVENT_PART = "least(4, (day(ts) - 1) div 6)"


def played_slices(spark, rows, every, by):
    """Counts per time slice of a feed of five parts, read back after the last one."""
    target = work_path(spark, "slices")

    def run(feed):
        return flows.slices_to(feed, target, f"{target}-checkpoint", every, by, trigger=None)

    played(spark, rows.withColumn("part", F.expr(EVENT_PART)), run)
    return flows.read_slices(spark, target, rows, by)


@query("throughput_stream", SQL["throughput_per_minute"])
def throughput_stream(spark, sf_dir):
    """The panel of rows per minute, kept up to date by a stream."""
    label = F.when(F.col("event_type") == "error", "fraud").otherwise("legitimate")
    rows = timings(spark, sf_dir).select("ts", label.alias("result"))
    return result(played_slices(spark, rows, "1 minute", ["result"]), "window_start", "result", "n")


@query("alerts_30_minutes_stream", SQL["alerts_last_30_minutes"])
def alerts_30_minutes_stream(spark, sf_dir):
    """The panel of alerts in the last 30 minutes from slices that a stream keeps."""
    level = F.when(F.col("value") >= 30, "CRITICAL").when(F.col("value") >= 15, "HIGH")
    rows = table(spark, sf_dir, "events").select(
        F.col("ts").cast("timestamp").alias("ts"), level.alias("risk_level")
    )
    slices = played_slices(spark, rows.filter("risk_level IS NOT NULL"), "1 minute", ["risk_level"])
    return result(rp.over_slices(slices, "30 minutes", "1 minute", ["risk_level"]))


@query(
    "latency_stream",
    f"""WITH {TIMINGS_CTE}, bits AS (SELECT time_bucket(INTERVAL 2 MINUTE, ts) AS w, micros,
  greatest(0, length(bin(micros)) - 6)::INT AS shift FROM timings WHERE micros >= 0),
cells AS (SELECT w, (micros >> shift) << shift AS low, count(*) AS n FROM bits GROUP BY ALL),
sums AS (SELECT w, low, sum(n) OVER (PARTITION BY w ORDER BY low) AS upto, sum(n) OVER (PARTITION BY w) AS total FROM cells),
qs(quantile) AS (VALUES (0.5::DOUBLE), (0.95::DOUBLE), (0.99::DOUBLE))
SELECT strftime(w, '%Y-%m-%d %H:%M:%S') AS window_start, quantile, min(low)::BIGINT AS micros
FROM sums, qs WHERE upto >= quantile * total GROUP BY ALL""",
)
def latency_stream(spark, sf_dir):
    """Latency quantiles per two minutes from histograms that a stream keeps."""
    rows = timings(spark, sf_dir).filter("micros >= 0").select("ts", rp.log_bucket("micros").alias("low"))
    slices = played_slices(spark, rows, "2 minutes", ["low"])
    return result(rp.bucket_quantiles(slices, ["window_start"], "low", "n", [0.5, 0.95, 0.99], "micros"))


@query("sliding_profile_stream")
def sliding_profile_stream(spark, sf_dir):
    """Sliding provider windows of the stream: those closed by the watermark."""
    target = work_path(spark, "sliding")
    windows = flows.sliding_profiles(claims_stream(spark, sf_dir))
    writer = windows.writeStream.format("parquet").option("path", target)
    finish(flows._start(writer, f"{target}-checkpoint", None))
    rows = spark.read.schema(windows.schema).parquet(target)
    return result(rows, "window_start", "provider_npi", "claim_count", "total_cents")


def training_rows(spark, sf_dir):
    """Feature columns with a learnable label: extreme amount or code mismatch."""
    profiled = sc.running_profiles(quality.dedup(claims(spark, sf_dir)))
    ruled = sc.model_inputs(sc.apply_rules(profiled)).withColumn(
        "label", F.when(F.col("rule_points") >= 8800, 1.0).otherwise(0.0)
    )
    rows = ruled.select(
        "claim_id", "label", (F.col("amount_cents") / 100).alias("amount"), *md.FEATURES[1:]
    )
    split = ev.stratified_split(rows, "label", ["claim_id"])
    return materialize(split, "training")


@query("train_and_score")
def train_and_score(spark, sf_dir):
    """Classifier with its usual settings, scored on the held-out claims."""
    rows = training_rows(spark, sf_dir)
    model = md.train(rows.filter("is_train"))
    scored = md.with_probability_tier(md.predict(rows.filter("NOT is_train"), model))
    return result(
        scored, "claim_id", "label", "fraud_probability", "model_risk_level", "model_version"
    )


@query("parameter_search")
def parameter_search(spark, sf_dir):
    """Two tree depths tried on the training claims, with their quality."""
    rows = training_rows(spark, sf_dir).filter("is_train")
    _, tried = md.search(rows, depths=(2, 4), rates=(md.RATE,), trees=10)
    table_rows = [(int(t["maxDepth"]), float(t["stepSize"]), float(t["auc"])) for t in tried]
    return spark.createDataFrame(table_rows, "max_depth bigint, step_size double, auc double")


@query("promoted_scores")
def promoted_scores(spark, sf_dir):
    """A weak and a better model compared on held-out claims; the winner scores."""
    rows = training_rows(spark, sf_dir)
    fit, held_out = rows.filter("is_train"), rows.filter("NOT is_train")
    champion = md.train(fit, trees=1, version="gbt-one-tree")
    challenger = md.train(fit, trees=20, version="gbt-twenty-trees")
    chosen, _ = md.promote(champion, challenger, held_out, min_gain=0.0)
    return result(
        md.predict(held_out, chosen), "claim_id", "fraud_probability", "model_version"
    )


@query(
    "held_out_scores",
    with_claims(
        SCORED_SQL
        + """, labelled AS (SELECT claim_id, CASE WHEN points >= 8800 THEN 1.0 ELSE 0.0 END::DOUBLE AS label FROM tiered),
placed AS (SELECT *, CAST('0x' || substr(md5(claim_id), 1, 8) AS BIGINT) AS pos FROM labelled),
cuts AS (SELECT label, quantile_cont(pos, 0.8) AS cut FROM placed GROUP BY 1)
SELECT claim_id, label, 'gbt-v1' AS model_version, 'gbt-v1' AS kept_version, 1::BIGINT AS same_after_loading, 1::BIGINT AS tier_fits
FROM placed JOIN cuts USING (label) WHERE pos > cut"""
    ),
)
def held_out_scores(spark, sf_dir):
    """A classifier with its usual settings is saved, promoted, loaded and scores.

    The champion has learned labels drawn by hash, so the classifier must replace it, and must
    not be replaced by it. (A single tree on the right labels is no champion to beat: it ranks
    these claims as well.) Every held-out claim must get the same probability before and after
    loading, four decimals within 0 and 1, and the tier of that probability.
    """
    rows = training_rows(spark, sf_dir)
    fit, held_out = rows.filter("is_train"), rows.filter("NOT is_train")
    path = work_path(spark, "classifier")
    fresh = md.load_or_train(path, fit)
    drawn = F.pmod(F.xxhash64("claim_id"), F.lit(2)).cast("double")
    champion = md.train(fit.withColumn("label", drawn), trees=1, version="gbt-drawn")
    chosen, _ = md.promote(champion, fresh, held_out)
    kept, _ = md.promote(fresh, champion, held_out)
    loaded = md.load_or_train(path, fit)
    before = md.predict(held_out, chosen).withColumnRenamed("fraud_probability", "before").drop("model_version")
    both = md.with_probability_tier(md.predict(before, loaded))
    p = F.col("fraud_probability")
    # Lower bounds of the tiers, written out: the result must not depend on the tested function.
    tier = F.when(p >= 0.9, "CRITICAL").when(p >= 0.7, "HIGH").when(p >= 0.4, "MEDIUM").otherwise("LOW")
    fits = (F.col("model_risk_level") == tier) & p.between(0, 1) & (F.round(p, 4) == p)
    return result(
        both.select(
            "claim_id",
            "label",
            F.lit(chosen.version).alias("model_version"),
            F.lit(kept.version).alias("kept_version"),
            (p == F.col("before")).alias("same_after_loading"),
            fits.alias("tier_fits"),
        )
    )

"""Quality rules of documents and of the hosts they come from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimsight.session import materialize

#: What ends a word, what holds one, and the signs that count as symbols.
WHITE = r"[\x20\x09-\x0D]"
FILLED = r"[^\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"
#: Words of a window that may repeat; a power of two.
WINDOW = 8
#: A document's limits: words, percent of repeated words, symbols per 100 words, percent of
#: repeated lines, characters per word.
LEAST_WORDS = 20
MOST_REPEATED = 30
MOST_SYMBOLS = 30
MOST_DUP_LINES = 50
WORD_CHARS = (2, 15)
#: A host whose shrunken failure rate is above this loses all its documents.
MOST_FAILING = 0.5

MEASURES = "n_words word_chars n_symbols n_dup_lines n_repeat_words".split()


def words_of(text: Column) -> Column:
    """Words of a text as an array; none if it is null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), WHITE), "")


def lines_of(text: Column) -> Column:
    """Lines with a word."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: x.rlike(FILLED))


def next_hash(column: str, step: int) -> Column:
    """Hash of each element and the one ``step`` after it; short by ``step`` elements."""
    size = F.greatest(F.size(column) - step, F.lit(0))
    return F.zip_with(
        F.slice(column, 1, size), F.slice(column, step + 1, size), lambda a, b: F.xxhash64(a, b)
    )


def placed(hashes: Column) -> Column:
    """Windows with their positions, equal ones side by side."""
    return F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))


def repeated_at(rows: Column) -> Column:
    """Positions, in order, of the windows that equal a neighbour among the placed ones."""
    twice = F.filter(
        rows, lambda x, i: (F.get(rows, i - 1)["h"] == x["h"]) | (F.get(rows, i + 1)["h"] == x["h"])
    )
    return F.array_sort(F.transform(twice, lambda x: x["i"]))


def covered(at: Column) -> Column:
    """Words that windows of WINDOW words at these positions cover together."""
    return F.coalesce(
        F.aggregate(
            at,
            F.struct(F.lit(0).cast("long").alias("n"), F.lit(-WINDOW).alias("last")),
            lambda acc, i: F.struct(
                (acc["n"] + F.least(F.lit(WINDOW), i - acc["last"])).alias("n"), i.alias("last")
            ),
            lambda acc: acc["n"],
        ),
        F.lit(0),
    )


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds the measures of each whole text and ``n_lines``, its different lines with a word.

    A null text has no words and no lines.

    Repeated words compare 64-bit hashes of the windows of one text.
    """
    step = docs.withColumns({"__words": words_of(F.col(text)), "__lines": lines_of(F.col(text))})
    step = step.withColumns(
        {
            "n_words": F.size("__words").cast("long"),
            "word_chars": F.char_length(F.array_join("__words", "")).cast("long"),
            "n_symbols": F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(SYMBOLS)).cast("long"),
            "n_lines": F.size(F.array_distinct("__lines")).cast("long"),
            "n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"),
            "__1": F.transform("__words", lambda w: F.xxhash64(w)),
        }
    ).drop("__words", "__lines")
    # Hashes of windows of 2, 4 and 8 words from those of half the size.
    for size in (1, 2, 4):
        step = step.withColumn(f"__{2 * size}", next_hash(f"__{size}", size)).drop(f"__{size}")
    step = step.withColumnRenamed(f"__{WINDOW}", "__windows")
    # Most texts repeat no window: these are not sorted. Each step is a column of its own, as
    # an expression inside a lambda would be computed for every element.
    plain = F.size(F.array_distinct("__windows")) == F.size("__windows")
    empty = F.array().cast("array<struct<h:bigint,i:int>>")
    return (
        step.withColumn("__placed", F.when(plain, empty).otherwise(placed(F.col("__windows"))))
        .drop("__windows")
        .withColumn("__at", repeated_at(F.col("__placed")))
        .withColumn("n_repeat_words", covered(F.col("__at")).cast("long"))
        .drop("__placed", "__at")
    )


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")
    )


def rule_failed() -> Column:
    """A document fails a rule of its own: base rules, symbols, repeated lines, word length."""
    return (
        base_failed()
        | (100 * F.col("n_symbols") > MOST_SYMBOLS * F.col("n_words"))
        | (100 * F.col("n_dup_lines") > MOST_DUP_LINES * (F.col("n_dup_lines") + F.col("n_lines")))
        | (F.col("word_chars") < WORD_CHARS[0] * F.col("n_words"))
        | (F.col("word_chars") > WORD_CHARS[1] * F.col("n_words"))
    )


def host_rates(measured: DataFrame, host: str = "host") -> DataFrame:
    """Documents, failures and shrunken failure rate of each host.

    The beta prior is fitted to the hosts by moments: with mean m and variance v of their
    rates, its weight is m (1 - m) / v - 1, and at least 1. A host's rate is the posterior
    mean (failures + m * weight) / (documents + weight). The aggregation combines on the map
    side, so a hot host is no large group; only the prior's two numbers reach the driver.
    """
    hosts = materialize(
        measured.groupBy(host).agg(
            F.count("*").alias("documents"), F.sum(F.col("failed").cast("long")).alias("failures")
        ),
        "host-counts",
    )
    rate = F.col("failures") / F.col("documents")
    prior = hosts.agg(
        F.sum("failures") / F.sum("documents"), F.avg(rate), F.coalesce(F.var_pop(rate), F.lit(0.0))
    ).first()
    mean = prior[1] if prior[1] is not None else 0.0
    spread = prior[2]
    weight = max(1.0, mean * (1 - mean) / spread - 1) if spread > 0 else 1e6
    return hosts.withColumn(
        "rate", (F.col("failures") + mean * weight) / (F.col("documents") + weight)
    )


def judge(docs: DataFrame, text: str = "text", host: str = "source", key: str = "doc_id") -> DataFrame:
    """Measures and verdict of every document: key, measures, base_failed, kept.

    A document is kept if it passes its own rules and its host's shrunken failure rate is at
    most MOST_FAILING. Rows with a null host form one host. A null or empty text has no words
    and fails; repeated rows and null keys stay and count; an empty table gives no rows; other
    columns are ignored.
    """
    lean = docs.select(F.col(key).alias("doc_id"), F.col(host).cast("string").alias("host"), F.col(text).alias("text"))
    measured = measure(lean).drop("text")
    measured = measured.withColumns({"base_failed": base_failed(), "failed": rule_failed()})
    measured = materialize(measured, "quality")
    hosts = host_rates(measured).select(
        F.col("host").alias("__host"), (F.col("rate") <= MOST_FAILING).alias("good")
    )
    return measured.join(hosts, F.col("host").eqNullSafe(F.col("__host")), "left").select(
        "doc_id", *MEASURES, "base_failed", (~F.col("failed") & F.col("good")).alias("kept")
    )

"""Mixing sources to target weights by iterative proportional fitting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimsight.llm.rules import words_of
from claimsight.session import materialize

#: Values of a margin with targets of their own; the smaller ones of a longer margin share one.
MOST_VALUES = 200
OTHER = "(other)"
#: Rounds of raking over all margins, and how strongly shares are evened out by default.
ROUNDS = 40
TEMPERATURE = 0.7


def form() -> Column:
    """Class of a text by its size, for tables without a topic column."""
    return (
        F.when(F.col("tokens") < 50, "short").when(F.col("tokens") < 500, "medium").otherwise("long")
    )


def rake(
    cells: DataFrame, names: list[str], targets: dict[str, list[float]], even: tuple[str, ...] = ()
) -> DataFrame:
    """Factors per margin value so that the cells' weighted tokens meet all targets.

    ``cells`` has the index of each margin's value and the tokens. All cells are one array,
    bounded by the product of the margins' values. A step fits one margin: a value's factor is
    its target over the tokens of its cells weighted with the other margins' factors. A value
    whose cells have no tokens gets the mean factor, unless its target is 0 and it is listed
    (the last value of a margin never is, nor are those of the margins ``even``).
    """
    row = cells.agg(F.array_sort(F.collect_list(F.struct(*names, "tokens"))).alias("cells"))
    start = F.struct(*[F.array(*[F.lit(1.0)] * len(targets[n])).alias(n) for n in names])

    def fitted(acc: Column, name: str) -> Column:
        others = [n for n in names if n != name]

        def weighted(total, c):
            value = c["tokens"]
            for n in others:
                value = value * F.get(acc[n], c[n])
            return total + value

        def factor(target, k):
            mass = F.aggregate(F.filter("cells", lambda c: c[name] == k), F.lit(0.0), weighted)
            free = (target > 0) | (k == len(targets[name]) - 1) | F.lit(name in even)
            every = F.aggregate("cells", F.lit(0.0), weighted)
            mean = F.when(every > 0, 1 / every).otherwise(1.0)
            return F.when(mass > 0, target / mass).when(free, mean).otherwise(F.lit(0.0))

        return F.transform(F.array(*[F.lit(t) for t in targets[name]]), factor)

    def step(acc, s):
        return F.struct(
            *[
                F.when(s % len(names) == i, fitted(acc, n)).otherwise(acc[n]).alias(n)
                for i, n in enumerate(names)
            ]
        )

    steps = F.sequence(F.lit(0), F.lit(ROUNDS * len(names) - 1))
    factors = row.select("cells", F.aggregate(steps, start, step).alias("f"))
    weight = None
    one = factors.select(F.explode("cells").alias("c"), "f")
    for n in names:
        part = F.get(F.col(f"f.{n}"), F.col(f"c.{n}"))
        weight = part if weight is None else weight * part
    return one.select(*[F.col(f"c.{n}").alias(n) for n in names], weight.alias("weight"))


def listed_and_rest(listed: list[float], left: float, rest: float) -> list[float]:
    """Targets of the listed values that occur, then that of all others, now at share ``rest``.

    The others get what the listed shares leave of 1. If that is nothing, they keep their share.
    """
    if rest <= 1e-12:
        return [*listed, 0.0]
    if left > 1e-9:
        return [*listed, left]
    whole = sum(listed)
    return [(1 - rest) * x / whole if whole else 0.0 for x in listed] + [rest]


def mix(
    docs: DataFrame,
    margins: dict[str, float | dict[str, float]],
    text: str = "text",
    key: str = "doc_id",
    topic: str | None = None,
    seed: str = "mix",
) -> DataFrame:
    """Weight, probability and draw of every document so that token shares meet targets.

    ``margins`` maps a column (``topic`` may be derived) to target shares by value, or to a
    temperature t: target shares are then the present ones to the power t, but the small values
    together keep their share. Target shares that leave something of 1 leave it to the values
    that are not listed; if they leave nothing, these values keep their present share and the
    listed ones divide the rest. Tokens are words.
    Cells of margin values are raked to all targets; a document's ``probability`` is its cell's
    weight over the largest, so expected shares of the sample are the targets. A document is
    drawn if a hash of its id is below the probability: the draw is repeatable, and rows that
    repeat an id share it.

    Nulls and values without a target (with a temperature: all but the MOST_VALUES largest)
    are raked as one value. Null and values that fixed shares do not list are named OTHER. Texts that are null or empty have no tokens but are drawn like
    their cell, a value without any tokens at the mean rate. Null ids
    share one draw; an empty table gives no rows; other columns are ignored.

    Result: doc_id, tokens, one column per margin, probability, sampled.
    """
    names = list(margins)
    rows = docs.withColumn("tokens", F.size(words_of(F.col(text))).cast("long"))
    if "topic" in names and topic is None and "topic" not in docs.columns:
        rows = rows.withColumn("topic", form())
    elif topic is not None:
        rows = rows.withColumn("topic", F.col(topic))
    rows = materialize(
        rows.select(F.col(key).alias("doc_id"), "tokens", *[F.col(n).cast("string").alias(n) for n in names]),
        "mix-rows",
    )
    total = rows.agg(F.sum("tokens")).first()[0] or 0
    values: dict[str, list[str]] = {}
    targets: dict[str, list[float]] = {}
    for n in names:
        wanted = margins[n]
        shares = rows.groupBy(n).agg(F.sum("tokens").alias("t")).filter(F.col(n).isNotNull())
        if isinstance(wanted, dict):
            shares = shares.filter(F.col(n).isin(list(wanted)))
        else:
            shares = shares.orderBy(F.desc("t"), n).limit(MOST_VALUES)
        large = {r[n]: r["t"] / max(1, total) for r in shares.collect()}
        rest = max(0.0, 1 - sum(large.values()))
        values[n] = sorted(large)
        if isinstance(wanted, dict):
            goal = listed_and_rest([wanted[v] for v in values[n]], 1 - sum(wanted.values()), rest)
        else:
            even = sum(x**wanted for x in large.values() if x) or 1.0
            goal = [(1 - rest) * large[v] ** wanted / even if large[v] else 0.0 for v in values[n]]
            goal.append(rest if rest > 1e-12 else 0.0)
        whole = sum(goal)
        targets[n] = [g / whole if whole else 1.0 for g in goal]

    def index(n: str) -> Column:
        at = F.array_position(F.array(*[F.lit(v) for v in values[n]]).cast("array<string>"), F.col(n))
        return F.coalesce(F.when(at > 0, at - 1), F.lit(len(values[n]))).cast("int")

    marked = rows.select("*", *[index(n).alias(f"_{n}") for n in names])
    cells = marked.groupBy(*[F.col(f"_{n}").alias(n) for n in names]).agg(
        F.sum("tokens").cast("double").alias("tokens")
    )
    weights = rake(cells, names, targets, tuple(n for n in names if not isinstance(margins[n], dict)))
    weights = materialize(
        weights.withColumn("largest", F.max("weight").over(Window.partitionBy(F.lit(0)))).select(
            *[F.col(n).alias(f"_{n}") for n in names],
            F.when(F.col("largest") > 0, F.col("weight") / F.col("largest")).otherwise(1.0).alias("probability"),
        ),
        "mix-cells",
    )
    return marked.join(weights, [f"_{n}" for n in names], "left").select(
        "doc_id",
        "tokens",
        *[
            F.coalesce(F.when(F.lit(not isinstance(margins[n], dict)) | F.col(n).isin(values[n]), F.col(n)), F.lit(OTHER)).alias(n)
            for n in names
        ],
        F.round("probability", 6).alias("probability"),
        (draw(F.col("doc_id"), seed) < F.col("probability")).alias("sampled"),
    )


def draw(key: Column, seed: str) -> Column:
    """Uniform number in [0, 1) from the id."""
    text = F.concat(F.lit(seed + ":"), F.coalesce(key.cast("string"), F.lit("null")))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("long") / float(1 << 32)

"""Isolation forest: random trees on bounded samples, path lengths of all rows.

A tree splits a sample at random values until rows are alone; rows that few splits set apart
are unusual. A tree needs only a few hundred rows, so fitting reads one bounded sample, and
Spark grows the trees in parallel. Scoring is a map over all rows, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil, log, log2

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimsight.operators.quantiles import exact_quantiles
from claimsight.session import materialize

#: Trees of a forest and rows that each is grown from, as first published for this method.
TREES = 100
ROWS = 256
SEED = 42
#: Rows whose path lengths a task works out at once.
BLOCK = 1 << 14
MICRO = 1_000_000

_NODES = "tree long, feature array<int>, cut array<double>, left array<int>, length array<double>"


def usual_length(n: int) -> float:
    """Mean path length of an unsuccessful search in a binary tree of n values."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2 * (log(n - 1) + 0.5772156649015329) - 2 * (n - 1) / n


@dataclass(frozen=True)
class Forest:
    """Node arrays, one row per tree. Children of an inner node are ``left`` and ``left`` + 1.

    ``feature`` is -1 in leaves, whose ``length`` is their depth and what their rows would
    have added. ``rows`` is the size of a tree's sample.
    """

    columns: tuple[str, ...]
    rows: int
    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    length: np.ndarray

    def lengths(self, values: np.ndarray) -> np.ndarray:
        """Mean path length of each row of values."""
        total = np.zeros(len(values))
        rows = np.arange(len(values))
        for feature, cut, left, length in zip(self.feature, self.cut, self.left, self.length):
            at = np.zeros(len(values), np.int64)
            inner = rows
            while len(inner):
                here = at[inner]
                inner = inner[feature[here] >= 0]
                here = at[inner]
                at[inner] = left[here] + (values[inner, feature[here]] >= cut[here])
            total += length[at]
        return total / max(1, len(self.feature))

    def scores(self, values: np.ndarray) -> np.ndarray:
        """2 ** -(mean length / usual length): near 1 for rows that few splits set apart."""
        usual = usual_length(self.rows)
        if usual == 0.0 or not len(self.feature):
            return np.full(len(values), 0.5)
        return np.exp2(-self.lengths(values) / usual)


def grown(values: np.ndarray, tree: int, seed: int) -> dict[str, list]:
    """The nodes of a tree, breadth first. Constant columns are not split."""
    rng = np.random.default_rng([seed, tree])
    most = ceil(log2(max(2, len(values))))
    nodes = {"feature": [], "cut": [], "left": [], "length": []}
    todo = [(values, 0)]
    for part, depth in todo:  # grows while it is read
        low, high = part.min(0), part.max(0)
        wide = np.flatnonzero(high > low)
        if depth == most or not len(wide):
            feature, cut, left = -1, 0.0, 0
        else:
            feature = int(rng.choice(wide))
            # In (low, high]: both sides keep a row.
            share = rng.random()
            cut = float(high[feature] * (1 - share) + low[feature] * share)
            cut = cut if low[feature] < cut <= high[feature] else float(high[feature])
            left = len(todo)
            right = part[:, feature] >= cut
            todo += [(part[~right], depth + 1), (part[right], depth + 1)]
        for name, value in zip(nodes, (feature, cut, left, depth + usual_length(len(part)))):
            nodes[name].append(value)
    return nodes


def _values(df: DataFrame, columns: list[str]) -> list:
    """The columns as finite doubles: null, NaN and infinite values count as 0."""
    out = []
    for i, c in enumerate(columns):
        x = F.col(c).cast("double")
        out.append(F.when(F.abs(x) < F.lit(float("inf")), x).otherwise(0.0).alias(f"_x{i}"))
    return out


def fit(
    df: DataFrame, columns: list[str], key: list[str], trees: int = TREES, rows: int = ROWS, seed: int = SEED
) -> Forest:
    """A forest over numeric columns from the ``trees * rows`` rows with the smallest hash of the key.

    The sample is bounded whatever the size of the table, and the same in every run. Every tree
    gets about ``rows`` rows of its own; of a table with fewer rows, each is dealt out to several
    trees. An empty table gives a forest that finds nothing unusual.
    """
    drawn = df.select(F.xxhash64(F.lit(seed), *key).alias("h"), *_values(df, columns))
    names = [f"_x{i}" for i in range(len(columns))]
    drawn = materialize(drawn.orderBy("h", *names).limit(trees * rows), "forest-sample")
    n = drawn.count()
    size = min(rows, n)
    if not n:
        none = np.empty((0, 0))
        return Forest(tuple(columns), 0, none, none, none, none)

    def grow(group: pd.DataFrame) -> pd.DataFrame:
        tree = int(group["tree"].iloc[0])
        values = group.sort_values(["h", *names], kind="stable")[names].to_numpy(float)
        nodes = grown(values, tree, seed)
        return pd.DataFrame({"tree": [tree], **{k: [v] for k, v in nodes.items()}})

    copies = ceil(trees * size / n)  # more than 1 only if rows are few: then at most ``trees``
    dealt = drawn.withColumn("copy", F.explode(F.array(*[F.lit(i) for i in range(copies)])))
    tree = F.pmod(F.xxhash64("copy", F.lit(seed), "h", *names), F.lit(trees)).cast("long")
    grown_trees = dealt.withColumn("tree", tree).groupBy("tree").applyInPandas(grow, _NODES)
    found = grown_trees.orderBy("tree").collect()  # at most ``trees`` rows of 2 * rows nodes

    def table(name: str, kind: type) -> np.ndarray:
        out = np.zeros((len(found), max(len(r[name]) for r in found)), kind)
        for i, r in enumerate(found):
            out[i, : len(r[name])] = r[name]
        return out

    return Forest(
        tuple(columns), size, table("feature", np.int64), table("cut", float), table("left", np.int64), table("length", float)
    )


def score(df: DataFrame, forest: Forest, name: str = "isolation_micro") -> DataFrame:
    """Adds the score in millionths, 0 to 1,000,000, as a whole number."""
    df = df.drop(name)
    schema = T.StructType([*df.schema.fields, T.StructField(name, T.LongType())])
    held = df.sparkSession.sparkContext.broadcast(forest)
    values = [f"_x{i}" for i in range(len(forest.columns))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK):
                part = batch.slice(start, BLOCK)
                x = np.column_stack([part.column(v).to_numpy(zero_copy_only=False) for v in values])
                found = np.floor(held.value.scores(x) * MICRO).astype(np.int64)
                kept = part.select([c for c in part.schema.names if c not in values])
                yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(found)], names=[*kept.schema.names, name])

    return df.select("*", *_values(df, list(forest.columns))).mapInArrow(run, schema)


def isolation_anomalies(
    df: DataFrame, columns: list[str], key: list[str], share: float = 0.05, **options
) -> DataFrame:
    """Adds ``isolation_micro`` and ``anomaly``: above the score that all but ``share`` stay within.

    At most ``share`` of the rows are anomalies, fewer if rows tie at the cut.
    """
    scored = materialize(score(df, fit(df, columns, key, **options)), "forest-scores")
    cut = exact_quantiles(scored, [], "isolation_micro", {"_cut": 1 - share}).scalar()
    return scored.withColumn("anomaly", F.coalesce(F.col("isolation_micro") > cut, F.lit(False)))

"""Approximate nearest neighbours from low-dimensional stable projections."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimsight.session import materialize

#: Projected dimensions (even), and the chance with which a true neighbour must be seen.
DIMENSIONS = 12
CONFIDENCE = 0.96
#: Points of a cell, cells at most (hash parts split larger ones), rows the tree is fitted on.
CELL_POINTS = 4096
MOST_CELLS = 8192
SAMPLE_ROWS = 20_000
#: Queries of a block, points of a leaf inside a cell, leaves verified at once.
QUERY_BLOCK = 4096
LEAF_POINTS = 128
LEAVES_AT_ONCE = 8
#: Rounding of squared distances: copies of one vector are not exactly at distance 0.
SLACK = 1e-12

FOUND = "query_id long, vec_id long, score double"


def chi_square_quantile(p: float, dims: int) -> float:
    """x with P(chi-square of an even number of dimensions <= x) = p."""

    def below(x: float) -> float:
        term, total = 1.0, 1.0
        for i in range(1, dims // 2):
            term *= x / 2 / i
            total += term
        return 1 - math.exp(-x / 2) * total

    lo, hi = 0.0, 10.0 * dims + 100
    for _ in range(100):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if below(mid) < p else (lo, mid)
    return hi


def projection(dims: int, width: int, seed: int = 7) -> np.ndarray:
    """Gaussian (2-stable) directions: squared projected distances are chi-square times d²."""
    return np.random.default_rng(seed).standard_normal((width, dims))


@dataclass(frozen=True)
class Cells:
    """Top of the kd-tree as boxes in projected space that tile it."""

    low: np.ndarray
    high: np.ndarray

    def of(self, points: np.ndarray) -> np.ndarray:
        out = np.zeros(len(points), np.int64)
        for lo in range(0, len(points), 1024):
            part = points[lo : lo + 1024, None, :]
            out[lo : lo + 1024] = ((part >= self.low) & (part < self.high)).all(axis=2).argmax(axis=1)
        return out

    def squared(self, point: np.ndarray) -> np.ndarray:
        """Squared distance from a point to each box."""
        gap = np.maximum(np.maximum(self.low - point, point - self.high), 0)
        return (gap * gap).sum(axis=1)


def kd_split(points: np.ndarray, parts: int) -> list[np.ndarray]:
    """Row numbers of the leaves of a kd-tree: median splits along the widest side."""
    out, todo = [], [(np.arange(len(points)), parts)]
    while todo:
        rows, n = todo.pop()
        if n <= 1 or len(rows) <= 1:
            out.append(rows)
            continue
        sides = points[rows]
        axis = int((sides.max(axis=0) - sides.min(axis=0)).argmax())
        order = rows[np.argsort(sides[:, axis], kind="stable")]
        half = len(order) * (n // 2) // n
        todo += [(order[:half], n // 2), (order[half:], n - n // 2)]
    return out


def fit_cells(sample: np.ndarray, parts: int) -> Cells:
    """Boxes of a kd-tree over a bounded sample; copies of a value stay in one box."""
    width = sample.shape[1]
    out = []
    todo = [(sample, np.full(width, -np.inf), np.full(width, np.inf), parts)]
    while todo:
        rows, low, high, n = todo.pop()
        if n > 1 and len(rows) > 1:
            axis = int((rows.max(axis=0) - rows.min(axis=0)).argmax())
            at = float(np.quantile(rows[:, axis], (n // 2) / n))
            left = rows[:, axis] < at
            if left.any() and not left.all():
                mid_high, mid_low = high.copy(), low.copy()
                mid_high[axis] = mid_low[axis] = at
                todo += [(rows[left], low, mid_high, n // 2), (rows[~left], mid_low, high, n - n // 2)]
                continue
        out.append((low, high))
    return Cells(np.array([x[0] for x in out]), np.array([x[1] for x in out]))


def _matrix(column) -> np.ndarray:
    """Vectors as rows, each scaled by a power of two to components below 1.

    The scaling is exact and leaves cosines as they are, but no square over- or underflows.
    """
    return _scaled(np.array(column.tolist(), np.float64))


def _scaled(rows: np.ndarray) -> np.ndarray:
    if not rows.size:
        return rows
    return np.ldexp(rows, -np.frexp(np.abs(rows).max(axis=1))[1][:, None])


def search_cell(
    queries: pd.DataFrame, points: pd.DataFrame, axes: np.ndarray, stop: float, k: int
) -> pd.DataFrame:
    """The k nearest of a cell's points for each query, by incremental kd-tree search.

    Leaves are taken by rising projected distance and their points verified on the original
    vectors. With d the k-th distance so far, the search ends when a leaf's squared projected
    distance reaches d² times the chi-square quantile: a nearer point would be seen by then
    with the wanted confidence. ``bound`` is a k-th distance known from another cell.
    """
    vectors, ids = _matrix(points["vector"]), points["vec_id"].to_numpy(np.int64)
    norms = np.sqrt((vectors * vectors).sum(axis=1))
    flat = (vectors / norms[:, None]) @ axes
    leaves = kd_split(flat, -(-len(flat) // LEAF_POINTS))
    boxes = Cells(np.array([flat[r].min(axis=0) for r in leaves]), np.array([flat[r].max(axis=0) for r in leaves]))
    out_q, out_v, out_s = [], [], []
    for name, vector, bound in zip(queries["query_id"], queries["vector"], queries["bound"]):
        q = _scaled(np.asarray(vector, np.float64)[None])[0]
        norm = np.sqrt((q * q).sum())
        away = boxes.squared((q / norm) @ axes)
        order = np.argsort(away, kind="stable")
        best_s, best_v = np.empty(0), np.empty(0, np.int64)
        kth = bound
        for lo in range(0, len(order), LEAVES_AT_ONCE):
            if away[order[lo]] > stop * kth + SLACK:
                break
            rows = np.concatenate([leaves[i] for i in order[lo : lo + LEAVES_AT_ONCE]])
            score = (vectors[rows] * q).sum(axis=1) / (norms[rows] * norm)
            other = ids[rows] != name
            best_s = np.concatenate([best_s, score[other]])
            best_v = np.concatenate([best_v, ids[rows][other]])
            top = np.lexsort((best_v, -best_s))[:k]
            best_s, best_v = best_s[top], best_v[top]
            if len(top) == k:
                kth = min(kth, max(0.0, 2 - 2 * best_s[-1]))
        out_q += [name] * len(best_s)
        out_v += best_v.tolist()
        out_s += best_s.tolist()
    return pd.DataFrame({"query_id": out_q, "vec_id": out_v, "score": out_s}).astype(
        {"query_id": "int64", "vec_id": "int64", "score": "float64"}
    )


def usable(vector: str) -> Column:
    """Not null, not zero, and without null or non-finite components."""
    v = F.col(vector)
    return (
        v.isNotNull()
        & (F.size(v) > 0)
        & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists(v, lambda x: x != 0)
    )


def nearest(
    rows: DataFrame,
    is_query: Column,
    key: str = "vec_id",
    vector: str = "embedding",
    k: int = 5,
    dims: int = DIMENSIONS,
    confidence: float = CONFIDENCE,
) -> DataFrame:
    """The k nearest other rows by cosine of each row for which ``is_query`` holds.

    Vectors are scaled to length 1, where squared distance is 2 - 2 cosine, and projected. A
    kd-tree fitted on at most about SAMPLE_ROWS rows cuts the projected space into at most
    MOST_CELLS boxes; all rows are indexed, and a box with more than CELL_POINTS rows is split
    by a hash, so copies of one vector do not meet in one task. A query first searches its own
    box; its k-th distance and the chi-square test then tell which other boxes it must visit.
    Queries come in blocks, and points are sent once for each block.

    Result: query_id, rank, vec_id, score, nearest first, ties to the smaller id. Unusable
    vectors (null, empty, zero, with null or non-finite components), null ids and vectors of
    another width than most take no part. Rows that repeat an id are candidates each but one
    query. With fewer candidates than k all are returned; an empty table gives no rows.
    """
    spark = rows.sparkSession
    lean = rows.select(
        F.col(key).cast("long").alias("vec_id"),
        F.col(vector).cast("array<double>").alias("vector"),
        F.coalesce(is_query, F.lit(False)).alias("asks"),
    ).filter(F.col("vec_id").isNotNull() & usable("vector"))
    widths = lean.groupBy(F.size("vector").alias("width")).agg(F.count("*").alias("n"))
    common = widths.orderBy(F.desc("n"), F.desc("width")).first()
    if common is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    width, total = common["width"], common["n"]
    lean = lean.filter(F.size("vector") == width)
    axes = projection(dims, width)
    stop = chi_square_quantile(confidence, dims)

    draw = F.pmod(F.xxhash64("vec_id"), F.lit(1 << 20)) < math.ceil((1 << 20) * min(1.0, SAMPLE_ROWS / total))
    sample = lean.filter(draw).select(F.explode("vector").alias("x")).toArrow()["x"].to_numpy()
    sample = _scaled(sample.astype(np.float64).reshape(-1, width))
    sample = (sample / np.sqrt((sample * sample).sum(axis=1))[:, None]) @ axes
    parts = min(MOST_CELLS, max(1, len(sample) // 4), -(-total // CELL_POINTS))
    tiles = spark.sparkContext.broadcast(fit_cells(sample, parts) if len(sample) else Cells(
        np.full((1, dims), -np.inf), np.full((1, dims), np.inf)
    ))

    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if len(frame):
                v = _matrix(frame["vector"])
                v = (v / np.sqrt((v * v).sum(axis=1))[:, None]) @ axes
                frame["cell"] = tiles.value.of(v)
                yield frame

    placed = materialize(
        lean.mapInPandas(place, "vec_id long, vector array<double>, asks boolean, cell long"), "ann-points"
    )
    sizes = placed.groupBy("cell").agg(F.count("*").alias("n"))
    sizes = sizes.select("cell", F.ceil(F.col("n") / CELL_POINTS).alias("splits"))
    points = placed.join(F.broadcast(sizes), "cell").select(  # at most MOST_CELLS rows
        "vec_id", "vector", "cell", F.pmod(F.xxhash64("vec_id", "vector"), F.col("splits")).alias("part")
    )
    asked = (
        placed.filter("asks")
        .groupBy(F.col("vec_id").alias("query_id"))
        .agg(F.min_by(F.struct("vector", "cell"), F.struct("vector")).alias("x"))
        .select("query_id", "x.vector", "x.cell")
    )
    blocks = max(1, -(-asked.count() // QUERY_BLOCK))

    def run(queries: DataFrame) -> DataFrame:
        """Search the cell that each query row names."""
        sent = queries.join(F.broadcast(sizes), "cell").select(
            "query_id", "vector", "bound", "cell",
            F.explode(F.sequence(F.lit(0).cast("long"), F.col("splits") - 1)).alias("part"),
            F.pmod(F.xxhash64("query_id"), F.lit(blocks)).alias("block"),
        )
        held = points.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
        by = ("cell", "part", "block")
        return sent.groupBy(*by).cogroup(held.groupBy(*by)).applyInPandas(
            lambda q, p: search_cell(q, p, axes, stop, k) if len(q) and len(p) else _none(), FOUND
        )

    own = materialize(run(asked.withColumn("bound", F.lit(float("inf")))), "ann-own")
    known = own.groupBy("query_id").agg(
        F.sort_array(F.collect_list("score"), asc=False).alias("scores")
    ).select(
        "query_id",
        F.when(F.size("scores") >= k, F.greatest(F.lit(0.0), 2 - 2 * F.element_at("scores", k))).alias("bound"),
    )

    def route(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for name, vector, cell, bound in frame.itertuples(index=False):
                q = _scaled(np.asarray(vector, np.float64)[None])[0]
                away = tiles.value.squared((q / np.sqrt((q * q).sum())) @ axes)
                visit = np.flatnonzero(away <= stop * bound + SLACK)
                visit = visit[visit != cell]
                if len(visit):
                    yield pd.DataFrame({"query_id": name, "vector": [vector] * len(visit), "bound": bound, "cell": visit})

    more = (
        asked.join(known, "query_id", "left")
        .select("query_id", "vector", "cell", F.coalesce("bound", F.lit(float("inf"))).alias("bound"))
        .mapInPandas(route, "query_id long, vector array<double>, bound double, cell long")
    )
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        own.unionByName(run(more))
        .withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def _none() -> pd.DataFrame:
    return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype(
        {"query_id": "int64", "vec_id": "int64", "score": "float64"}
    )

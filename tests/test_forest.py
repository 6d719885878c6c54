"""Isolation forest against a plain walk of its trees, planted outliers, odd tables."""

import math
import random

import numpy as np

from claimsight.operators import forest as fo


def test_usual_length_is_the_mean_of_random_searches():
    assert [fo.usual_length(n) for n in (0, 1, 2)] == [0, 0, 1]
    harmonic = 2 * sum(1 / i for i in range(1, 256)) - 2 * 255 / 256
    assert abs(fo.usual_length(256) - harmonic) < 0.01


def walk(tree, row, at=0):
    """Path length of a row in the nodes of one tree, one node at a time."""
    if tree["feature"][at] < 0:
        return tree["length"][at]
    return walk(tree, row, tree["left"][at] + int(row[tree["feature"][at]] >= tree["cut"][at]))


def test_trees_keep_their_rows_and_lengths_equal_a_plain_walk():
    rng = np.random.default_rng(3)
    values = np.round(rng.normal(size=(300, 3)), 1)
    trees = [fo.grown(values[i * 60 : i * 60 + 60], i, 7) for i in range(5)]
    for i, tree in enumerate(trees):
        depths = {0: 0}
        for at, feature in enumerate(tree["feature"]):
            if feature >= 0:
                depths |= {tree["left"][at]: depths[at] + 1, tree["left"][at] + 1: depths[at] + 1}
        sizes = {}
        for row in values[i * 60 : i * 60 + 60]:
            at = 0
            while tree["feature"][at] >= 0:
                at = tree["left"][at] + int(row[tree["feature"][at]] >= tree["cut"][at])
            sizes[at] = sizes.get(at, 0) + 1
        leaves = {at for at, feature in enumerate(tree["feature"]) if feature < 0}
        assert set(sizes) == leaves and max(depths.values()) <= math.ceil(math.log2(60))
        for at in leaves:
            assert tree["length"][at] == depths[at] + fo.usual_length(sizes[at])
    n = max(len(t["feature"]) for t in trees)

    def table(name, kind):
        return np.array([t[name] + [0] * (n - len(t[name])) for t in trees], kind)

    forest = fo.Forest(("a", "b", "c"), 60, table("feature", int), table("cut", float), table("left", int), table("length", float))
    for row, got in zip(values, forest.scores(values)):
        mean = sum(walk(t, row) for t in trees) / 5
        assert abs(got - 2 ** (-mean / fo.usual_length(60))) < 1e-12


def test_planted_outliers_are_found(spark):
    rng = random.Random(2)
    rows = [(i, rng.gauss(0, 1), rng.gauss(5, 2), "x") for i in range(3000)]
    rows += [(3000 + i, 40.0 + i, -60.0 - i, "out") for i in range(20)]
    df = spark.createDataFrame(rows, "id long, a double, b double, anomaly string").repartition(5)
    again = [
        sorted(fo.isolation_anomalies(d, ["a", "b"], ["id"]).select("id", "isolation_micro", "anomaly").collect())
        for d in (df, df.repartition(2))
    ]
    assert again[0] == again[1]  # the order of rows and partitions does not matter
    found = {r[0] for r in again[0] if r[2]}
    assert set(range(3000, 3020)) <= found and len(found) <= 0.05 * len(rows)
    assert all(0 <= r[1] <= fo.MICRO for r in again[0]) and len(again[0]) == len(rows)


def test_odd_tables(spark):
    schema = "id long, a double, isolation_micro string"
    odd = [(None, None, "x"), (1, float("nan"), "x"), (1, float("inf"), "x"), (2, 1.0, "x"), (2, 1.0, "x"), (3, -1e308, "x"), (4, 1e308, "x")]
    got = fo.isolation_anomalies(spark.createDataFrame(odd, schema), ["a"], ["id"]).collect()
    assert len(got) == len(odd) and all(isinstance(r.isolation_micro, int) for r in got)
    none = fo.isolation_anomalies(spark.createDataFrame([], schema), ["a"], ["id"])
    assert none.collect() == [] and "anomaly" in none.columns
    same = fo.isolation_anomalies(spark.createDataFrame([(1, 2.0, "x")] * 50, schema), ["a"], ["id"]).collect()
    assert not any(r.anomaly for r in same)

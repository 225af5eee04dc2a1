from __future__ import annotations

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from trustgauge.operators import ranking, sampling


def hashed(seed, i):
    return hashlib.md5(f"{seed}:{i}".encode()).hexdigest()


def test_ten_rows_of_a_class_split_six_two_two(spark):
    df = spark.range(10).withColumn("target", F.lit(1))
    counts = {r["split"]: r["count"] for r in sampling.stratified_split(df).groupBy("split").count().collect()}
    assert counts == {"train": 6, "calibration": 2, "test": 2}


@pytest.mark.parametrize("partitions", [1, 4, 16])
def test_split_matches_brute_force(spark, partitions):
    df = spark.range(501).withColumn("target", (F.col("id") % 7 == 0).cast("int")).repartition(partitions)
    got = {r["id"]: r["split"] for r in sampling.stratified_split(df, seed=5).collect()}
    expected = {}
    for klass in (0, 1):
        ids = sorted((i for i in range(501) if int(i % 7 == 0) == klass), key=lambda i: (hashed(5, i), i))
        first, second = round(len(ids) * 0.6), round(len(ids) * 0.2)
        for place, i in enumerate(ids):
            expected[i] = "train" if place < first else "calibration" if place < first + second else "test"
    assert got == expected


@pytest.mark.parametrize("train, calibration", [(0.0, 0.2), (0.6, 0.0), (0.8, 0.2)])
def test_bad_fractions(spark, train, calibration):
    with pytest.raises(ValueError):
        sampling.stratified_split(spark.range(3), "id", "id", train, calibration)


def test_string_ids_and_tiny_classes(spark):
    df = spark.createDataFrame([("a", 1), ("b", 0), ("c", 0)], "id string, target int")
    assert sampling.stratified_split(df).count() == 3


def test_limit_rows(spark):
    df = spark.range(100).withColumn("split", F.when(F.col("id") < 30, "test").otherwise("train"))
    kept = sampling.limit_rows(df, 10)
    assert {r["split"]: r["count"] for r in kept.groupBy("split").count().collect()} == {"test": 10, "train": 10}
    expected = sorted(range(30), key=lambda i: hashed(42, i))[:10]
    assert {r["id"] for r in kept.where("split = 'test'").collect()} == set(expected)
    assert sampling.limit_rows(df, 0).count() == 100
    assert sampling.limit_rows(df, 50).count() == 80


def test_hash_rank_is_a_permutation_in_hash_order(spark):
    rows = ranking.hash_rank(spark.range(300).repartition(5), "id", 9).collect()
    expected = {i: r for r, i in enumerate(sorted(range(300), key=lambda i: (hashed(9, i), i)))}
    assert {r["id"]: r["rank"] for r in rows} == expected


def test_bootstrap_draws_n_rows_per_member(spark):
    drawn = sampling.bootstrap_multiplicities(spark.range(200), 4, seed=3).collect()
    assert len(drawn) == 200
    totals = np.array([r["multiplicities"] for r in drawn]).sum(axis=0)
    assert totals.tolist() == [200] * 4
    by_rank = {i: r for r, i in enumerate(sorted(range(200), key=lambda i: (hashed(3, i), i)))}
    counts = np.zeros((4, 200), dtype=int)
    for slot in range(800):
        draw = int(hashlib.md5(f"3:{slot}".encode()).hexdigest()[:15], 16) % 200
        counts[slot // 200, draw] += 1
    for r in drawn:
        assert r["multiplicities"] == counts[:, by_rank[r["id"]]].tolist()


def test_ordered_rank(spark):
    df = spark.range(500).select((F.col("id") * 37 % 500).alias("v")).repartition(7)
    rows = ranking.ordered_rank(df, [F.desc("v")]).collect()
    assert {r["v"]: r["idx"] for r in rows} == {v: 499 - v for v in range(500)}


@pytest.mark.parametrize("direct_rows", [10, 1_000_000])
def test_order_statistics_with_a_hot_value_and_a_hot_group(spark, direct_rows):
    rng = np.random.default_rng(4)
    values = {
        "hot": np.r_[np.full(900, 0.125), rng.random(800) ** 6, 1e-9 * rng.random(300)],
        "small": rng.random(11),
        "flat": np.full(50, 0.5),
    }
    rows = [(g, float(v)) for g, vs in values.items() for v in vs]
    df = spark.createDataFrame(rows, "g string, v double").repartition(6)
    shares = [0.01, 0.3, 0.5, 0.77, 1.0]
    ranks = {s: (lambda n, s=s: F.ceil(n * F.lit(s))) for s in shares}
    got = ranking.order_statistics(df, "g", "v", ranks, direct_rows=direct_rows).collect()
    assert len(got) == 15
    for r in got:
        ordered = np.sort(values[r["g"]])
        assert r["n"] == len(ordered)
        assert r["value"] == ordered[int(np.ceil(len(ordered) * r["tag"])) - 1]

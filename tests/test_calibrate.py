from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from trustgauge.operators import calibrate


def reference_blocks(x, y):
    """Quadratic isotonic fit over pooled x, by the max-min formula on touching points."""
    xs = np.unique(x)
    w = np.array([(x == v).sum() for v in xs], float)
    s = np.array([y[x == v].sum() for v in xs], float)
    cw, cs = np.r_[0, w.cumsum()], np.r_[0, s.cumsum()]
    blocks, start = [], 0
    for end in range(1, len(xs) + 1):
        up = max((cs[end] - cs[a]) / (cw[end] - cw[a]) for a in range(end))
        low = min(((cs[b] - cs[end]) / (cw[b] - cw[end]) for b in range(end + 1, len(xs) + 1)), default=np.inf)
        if up < low:
            blocks.append((xs[end - 1], (cs[end] - cs[start]) / (cw[end] - cw[start])))
            start = end
    return blocks


def test_separable_scores_take_the_smallest_temperature(predictions):
    z = [-4.0, -1.0, 1.0, 4.0]
    rows = predictions([(0, 0.1), (0, 0.2), (1, 0.8), (1, 0.9)], score=z)
    fitted = calibrate.fit_temperature(rows)
    assert fitted.first()["temperature"] == pytest.approx(10**-1.2)
    probs = [r["prob"] for r in calibrate.apply_temperature(rows, fitted).collect()]
    assert all(0.0 < p < 1.0 for p in probs)


def test_temperature_matches_brute_force(predictions):
    rng = np.random.default_rng(0)
    z = rng.normal(0, 3, 400)
    y = (rng.random(400) < 1 / (1 + np.exp(-z / 2))).astype(int)
    rows = predictions([(t, 0.5) for t in y], score=z.tolist())
    losses = []
    for t in calibrate.TEMPERATURES:
        p = np.clip(1 / (1 + np.exp(-z / t)), 1e-12, 1 - 1e-12)
        losses.append(-(y * np.log(p) + (1 - y) * np.log(1 - p)).mean())
    best = calibrate.TEMPERATURES[int(np.argmin(losses))]
    assert calibrate.fit_temperature(rows).first()["temperature"] == best


def test_platt_takes_one_step_on_few_rows(predictions):
    z, y = np.array([-4.0, -1.0, 1.0, 4.0]), np.array([0, 0, 1, 1])
    e = 1 / (1 + np.exp(-z)) - y
    row = calibrate.fit_platt(predictions([(t, 0.5) for t in y], score=z.tolist())).first()
    assert row["slope"] == pytest.approx(1 - 0.03 * ((e * z).mean() + 1e-4))
    assert row["intercept"] == pytest.approx(-0.03 * e.mean())


def test_platt_is_stationary_for_every_model(spark, predictions):
    rng = np.random.default_rng(1)
    data, frames = {}, []
    for name, (slope, shift, wide) in {"a/raw": (0.6, -0.4, 60), "b/raw": (3.0, 1.0, 9)}.items():
        z = np.r_[rng.normal(0, 2, 3000), rng.normal(0, wide, 200)]
        y = (rng.random(len(z)) < 1 / (1 + np.exp(-(slope * z + shift)))).astype(int)
        data[name] = z, y
        frames.append(predictions([(t, 0.5) for t in y], model=name, score=z.tolist()))
    for row in calibrate.fit_platt(frames[0].unionByName(frames[1])).collect():
        z, y = data[row["model"]]
        e = 1 / (1 + np.exp(-np.clip(row["slope"] * z + row["intercept"], -700, 700))) - y
        assert (e * z).mean() + 1e-4 * row["slope"] == pytest.approx(0, abs=1e-9)
        assert e.mean() == pytest.approx(0, abs=1e-9)


def test_platt_ends_on_separable_and_one_sided_targets(predictions):
    z = np.r_[np.linspace(-9, -1, 40), np.linspace(1, 9, 40)]
    for y in ((z > 0).astype(int), np.ones(len(z), dtype=int)):
        row = calibrate.fit_platt(predictions([(t, 0.5) for t in y], score=z.tolist())).first()
        assert np.isfinite(row["slope"]) and np.isfinite(row["intercept"])


def test_rows_without_a_fit_stay(predictions):
    fitted = predictions([(0, 0.2), (1, 0.8)] * 10, score=[-1.0, 1.0] * 10)
    other = predictions([(1, 0.7), (0, 0.4)], model="other/raw", score=[0.5, -0.5])
    family = calibrate.calibrated_family(
        fitted.unionByName(other), calibrate.fit_temperature(fitted),
        calibrate.isotonic_blocks(fitted), calibrate.fit_platt(fitted),
    )
    rows = family.where("base_model = 'other'").collect()
    assert sorted(r["prob"] for r in rows if r["method"] == "raw") == [0.4, 0.7]
    assert [r["prob"] for r in rows if r["method"] != "raw"] == [None] * 6


def test_isotonic_lookup_with_crowded_probabilities(predictions):
    rng = np.random.default_rng(5)
    x = np.where(rng.random(4000) < 0.9, 1 - rng.random(4000) * 1e-4, rng.random(4000))
    y = (rng.random(4000) < x).astype(int)
    rows = predictions(list(zip(y, x)))
    blocks = calibrate.isotonic_blocks(rows)
    ends = blocks.orderBy("hi").collect()
    got = {r["id"]: r["prob"] for r in calibrate.apply_isotonic(rows, blocks).collect()}
    for i, p in enumerate(x):
        want = next((e["value"] for e in ends if p <= e["hi"]), ends[-1]["value"])
        assert got[i] == min(max(want, 1e-12), 1 - 1e-12)


@pytest.mark.parametrize("bits", [1, 3, 7])
def test_tree_of_blocks_finds_every_block(spark, predictions, monkeypatch, bits):
    """Trees of many levels, models of different size, and what lies outside of all blocks."""
    monkeypatch.setattr(calibrate, "NODE_BITS", bits)
    ends = {"a": [k / 300 for k in range(1, 300)], "b": [0.5], "c": [0.2, 0.4, 0.6]}
    rows = [
        (m, None if k == 0 else e[k - 1], e[k], k == len(e) - 1, (k + 1) / (len(e) + 1))
        for m, e in ends.items() for k in range(len(e))
    ]
    blocks = spark.createDataFrame(rows, "model string, lo double, hi double, last boolean, value double")
    asked = [(m, p) for m in "abcd" for p in [None, 0.0, 1.0, 0.2, 0.2000001, 0.5, *[k / 97 for k in range(97)]]]
    probes = spark.createDataFrame(asked, "model string, prob double")
    got = calibrate.isotonic_lookup(probes, blocks).collect()
    assert len(got) == len(asked)
    for r in got:
        values = [v for m, _, hi, last, v in rows if m == r["model"] and r["prob"] is not None and (last or r["prob"] <= hi)]
        assert r["isotonic_prob"] == (values[0] if values else None)


@pytest.mark.parametrize("seed", range(4))
def test_bounds_hold_and_leave_the_grid_minimum(predictions, seed):
    """The bounds enclose every grid loss, and few steps are left open; clipped scores too."""
    rng = np.random.default_rng(seed)
    z = rng.normal(0, [1.0, 4.0, 40.0, 0.01][seed], 3000)
    y = (rng.random(3000) < 1 / (1 + np.exp(-z / 2))).astype(int)
    rows = predictions(list(zip(y, np.full(3000, 0.5))), score=z.tolist()).unionByName(
        predictions([(1, 0.5), (0, 0.5)], model="few/raw", score=[50.0, -50.0])
    )
    losses = {(r["model"], r["step"]): r for r in calibrate.temperature_losses(rows).collect()}
    bounds = calibrate.temperature_bounds(rows).collect()
    assert len(bounds) == len(losses) == 2 * 121
    for b in bounds:
        assert b["low"] <= losses[b["model"], b["step"]]["loss"] <= b["high"]
    own = [b for b in bounds if b["model"] == "toy/raw"]
    open_steps = sum(b["low"] <= min(o["high"] for o in own) for b in own)
    assert open_steps <= (8 if seed < 2 else 121)
    got = {r["model"]: r["temperature"] for r in calibrate.fit_temperature(rows).collect()}
    for model in got:
        best = min((r["loss"], r["step"]) for k, r in losses.items() if k[0] == model)[1]
        assert got[model] == calibrate.TEMPERATURES[best]


def test_isotonic_golden(predictions):
    rows = predictions(list(zip([0, 1, 0, 1, 1], [0.1, 0.2, 0.3, 0.4, 0.9])))
    blocks = calibrate.isotonic_blocks(rows)
    got = [(r["hi"], r["value"]) for r in blocks.orderBy("hi").collect()]
    assert got == [(0.1, 0.0), (0.3, 0.5), (0.9, 1.0)]  # equal steps are one block
    probe = predictions([(0, p) for p in (0.05, 0.15, 0.25, 0.35, 0.95)])
    applied = [r["prob"] for r in calibrate.apply_isotonic(probe, blocks).orderBy("id").collect()]
    assert applied == [1e-12, 0.5, 0.5, 1 - 1e-12, 1 - 1e-12]


@pytest.mark.parametrize("seed, decimals", [(0, 2), (1, 6), (2, 1)])
def test_isotonic_matches_brute_force(predictions, seed, decimals):
    rng = np.random.default_rng(seed)
    x = np.round(rng.random(600) ** 4, decimals)
    y = (rng.random(600) < x).astype(int)
    rows = predictions(list(zip(y, x))).repartition(5)
    got = [(r["hi"], r["value"]) for r in calibrate.isotonic_blocks(rows).orderBy("hi").collect()]
    assert got == reference_blocks(x, y)


def test_pooling_slices_first_changes_nothing():
    rng = np.random.default_rng(7)
    x = np.arange(5000, dtype=float)
    y = (rng.random(5000) < x / 5000).astype(float)
    whole = calibrate.pool_violators(x, np.ones(5000), y)
    parts = [calibrate.pool_violators(x[a : a + 70], np.ones(len(x[a : a + 70])), y[a : a + 70]) for a in range(0, 5000, 70)]
    joined = calibrate.pool_violators(*[np.concatenate(c) for c in zip(*parts)])
    for a, b in zip(whole, joined):
        assert np.array_equal(a, b)
    assert np.all(np.diff(whole[2] / whole[1]) >= 0)


def test_long_falling_input_is_one_block():
    n = 3000
    hi, weight, positives = calibrate.pool_violators(
        np.arange(n, dtype=float), np.ones(n), np.r_[np.ones(1500), np.zeros(1500)]
    )
    assert len(hi) == 1 and weight[0] == n and positives[0] == 1500


def test_family_holds_every_variant_once(predictions):
    rng = np.random.default_rng(3)
    z = rng.normal(0, 2, 200)
    y = (rng.random(200) < 0.5).astype(int)
    p = 1 / (1 + np.exp(-z))
    rows = predictions(list(zip(y, p)), score=z.tolist())
    family = calibrate.calibrated_family(
        rows, calibrate.fit_temperature(rows), calibrate.isotonic_blocks(rows), calibrate.fit_platt(rows)
    )
    counts = {r["model"]: r["count"] for r in family.groupBy("model").count().collect()}
    assert counts == {
        "toy/raw": 200, "toy/temperature_scaling": 200, "toy/isotonic_regression": 200, "toy/platt_scaling_extra": 200,
    }
    calibrated = family.where(F.col("method") != "raw")
    assert calibrated.where("prob <= 0 or prob >= 1").count() == 0

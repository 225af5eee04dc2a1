from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from trustgauge.operators import features, joint, linear, mlp, svm


@pytest.fixture
def prepared(toy_corpus):
    vocabulary = features.fit_vocabulary(toy_corpus, 1, 100)
    rows = features.tfidf(toy_corpus, vocabulary, keep=("id", "target"))
    vectors = features.to_vectors(rows, vocabulary.count(), ("id", "target"))
    return vocabulary, rows, vectors


def ordered(scored):
    return [r["prob"] for r in linear.with_probability(scored).orderBy("id").collect()]


def check(probs):
    assert len(probs) == 4 and all(0.0 <= p <= 1.0 for p in probs)
    assert np.mean(probs[:2]) > np.mean(probs[2:])


def test_naive_bayes(prepared):
    vocabulary, rows, _ = prepared
    model = linear.fit_naive_bayes(rows, vocabulary)
    check(ordered(linear.linear_scores(rows, model)))
    dense = np.zeros((4, vocabulary.count()))
    for r in rows.collect():
        for c in r["features"]:
            dense[r["id"], c["idx"]] = c["w"]
    sums = np.stack([dense[2:].sum(axis=0), dense[:2].sum(axis=0)]) + 1.0
    theta = np.log(sums / sums.sum(axis=1, keepdims=True))
    got = [r["weight"] for r in model.weights.orderBy("idx").collect()]
    assert np.allclose(got, theta[1] - theta[0])
    assert model.intercept == pytest.approx(0.0)


@pytest.mark.parametrize("fit", [linear.fit_logistic, linear.fit_smoothed_logistic])
def test_iterative_linear_models(prepared, fit):
    _, rows, vectors = prepared
    check(ordered(linear.linear_scores(rows, fit(vectors))))


def test_svm_scores_are_margins(prepared):
    vocabulary, rows, _ = prepared
    done = svm.fit(rows, vocabulary.count())
    check(ordered(linear.linear_scores(rows, done.model)))
    assert 0 <= done.gap <= svm.GAP


def svm_rows(spark, seed, n=160, size=40):
    """Sparse rows, some without features, some equal, with labels that no plane parts."""
    rng = np.random.default_rng(seed)
    x = rng.random((n, size)) * (rng.random((n, size)) < 0.15)
    x[:5] = 0.0
    x[5:9] = x[9]
    y = (x[:, 0] + 0.3 * rng.normal(size=n) > 0.05).astype(int)
    cells = [[(int(j), float(v[j])) for j in np.flatnonzero(v)] for v in x]
    rows = [(i, int(t), c or None) for i, (t, c) in enumerate(zip(y, cells))]
    schema = "id long, target int, features array<struct<idx:int,w:double>>"
    return x, 2.0 * y - 1, spark.createDataFrame(rows, schema)


@pytest.mark.parametrize(("seed", "parts", "reg", "gap"), [(0, 1, 0.01, 1e-4), (1, 3, 0.05, 1e-3)])
def test_svm_is_optimal(spark, seed, parts, reg, gap):
    """The certificate holds, and no point found by plain descent on the whole is better."""
    x, y, rows = svm_rows(spark, seed)
    done = svm.fit(rows.repartition(parts), x.shape[1], reg=reg, gap=gap)
    w = np.zeros(x.shape[1] + 1)
    for r in done.model.weights.collect():
        w[r["idx"]] = r["weight"]
    w[-1] = done.model.intercept
    wide = np.hstack([x, np.ones((len(x), 1))])

    def primal(w):
        return reg / 2 * w @ w + np.maximum(0.0, 1 - y * (wide @ w)).mean()

    assert done.primal == pytest.approx(primal(w), abs=1e-9) and done.gap <= gap
    a = np.zeros(len(x))
    for r in done.duals.collect():
        a[r["id"]] = r["a"]
    assert a.min() >= 0 and a.max() <= 1
    assert np.allclose(w, (a * y) @ wide / (reg * len(x)), atol=1e-9)
    assert done.dual == pytest.approx(a.mean() - reg / 2 * w @ w, abs=1e-9)
    found = svm.objective(rows.join(done.duals, "id"), reg).first()
    assert (found["primal"], found["dual"]) == pytest.approx((done.primal, done.dual), abs=1e-9)
    z = np.zeros_like(w)
    for t in range(1, 4000):
        z -= (reg * z - ((y * (wide @ z) < 1) * y) @ wide / len(x)) / (reg * (t + 100))
        assert primal(z) >= done.dual - 1e-9


def test_svm_without_rows_and_with_too_many_features(spark):
    _, _, rows = svm_rows(spark, 0)
    none = svm.fit(rows.limit(0), 3)
    assert none.model.intercept == 0.0 and none.model.weights.where("weight <> 0").isEmpty()
    with pytest.raises(ValueError, match="limit the vocabulary"):
        svm.fit(rows, linear.DENSE_WEIGHTS + 1)


def test_logistic_refuses_more_weights_than_a_driver_should_hold(prepared, monkeypatch):
    _, _, vectors = prepared
    monkeypatch.setattr(linear, "DENSE_WEIGHTS", 3)
    with pytest.raises(ValueError, match="limit the vocabulary"):
        linear.fit_logistic(vectors)


def test_smoothing_is_less_confident(prepared):
    _, rows, vectors = prepared
    hard = ordered(linear.linear_scores(rows, linear.fit_logistic(vectors, reg_param=1e-4)))
    soft = ordered(linear.linear_scores(rows, linear.fit_smoothed_logistic(vectors, reg_param=1e-4)))
    assert max(soft) < max(hard)


def test_members_are_fitted_together(spark):
    """Each of several losses ends where its own gradient vanishes, whatever the others do."""
    rng = np.random.default_rng(3)
    rows, wide = [], {}
    for m, (n, size) in enumerate([(60, 5), (90, 12)]):
        x = rng.random((n, size)) * (rng.random((n, size)) < 0.5)
        y, times = (x[:, 0] + 0.4 * rng.normal(size=n) > 0.3).astype(int), rng.integers(1, 4, n)
        wide[m] = x, y, times
        rows += [
            (m, int(y[i]), int(times[i]), [(int(j), float(x[i, j])) for j in np.flatnonzero(x[i])] or None) for i in range(n)
        ]
    frame = spark.createDataFrame(
        rows, "member int, target int, times long, features array<struct<idx:int,w:double>>"
    ).repartition(5)
    fits = joint.fit_many(frame, [5, 12, 3], 500, 0.01)
    for m, (x, y, times) in wide.items():
        weights, intercept = fits[m]
        w = np.zeros(x.shape[1])
        for r in weights.collect():
            w[r["idx"]] = r["weight"]
        error = times * (1 / (1 + np.exp(-(x @ w + intercept))) - y) / times.sum()
        assert np.abs(x.T @ error + 0.01 * w).max() < 1e-5 and abs(error.sum()) < 1e-5
    assert fits[2][1] == 0.0 and fits[2][0].where("weight <> 0").isEmpty()
    with pytest.raises(ValueError, match="limit the vocabularies"):
        joint.fit_many(frame, [joint.MOST_WEIGHTS, 1], 5, 0.01)


def test_ensemble_mean_lies_within_its_members(spark, toy_corpus):
    copies = toy_corpus.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(4))))
    many = copies.select((F.col("id") + 10 * F.col("copy")).alias("id"), "text", "target")
    members = linear.fit_ensemble(many, members=2, min_df=1, max_features=100, seed=1)
    scored = linear.ensemble_scores(toy_corpus, members).orderBy("id").collect()
    check([r["prob"] for r in scored])
    for r in scored:
        assert min(r["member_probs"]) - 1e-12 <= r["prob"] <= max(r["member_probs"]) + 1e-12


def test_mlp_gradient_matches_finite_differences():
    settings = mlp.MlpSettings(embedding_dim=3, hidden_dim=4)
    start = mlp.initial_model(5, settings)
    # Off the kink at zero that a document without tokens sits on at the start.
    shift = np.random.default_rng(0).normal(0, 0.3, start.table.shape)
    model = mlp.MlpModel(start.table + shift, 5, 4)
    ids, counts = np.array([0, 1, 1, 4, 2]), np.array([3, 0, 2])
    target = np.array([1.0, 0.0, 1.0])

    def loss(table):
        net = mlp.MlpModel(table, 5, 4)
        docs = mlp.mean_vectors(net.parts()[0], ids, counts)
        z = mlp._logits(net, docs)[1]
        return (np.log1p(np.exp(-np.abs(z))) + np.maximum(z, 0) - z * target).sum()

    total = np.zeros_like(model.table)
    mlp.add_gradient(model, total, ids, counts, target)
    for place in np.ndindex(model.table.shape):
        moved = model.table.copy()
        moved[place] += 1e-6
        back = model.table.copy()
        back[place] -= 1e-6
        assert total[place] == pytest.approx((loss(moved) - loss(back)) / 2e-6, abs=1e-6)


def test_forward_pass_equals_the_network(spark):
    """Joins and sums over weight tables against the same weights in one matrix."""
    rng = np.random.default_rng(2)
    model = mlp.MlpModel(rng.normal(0, 0.5, (9 + mlp._layer_rows(3, 4), 3)), 9, 4)
    rows = [(0, [1, 1, 8]), (1, []), (2, [0]), (3, [5, 6, 7, 5])]
    encoded = spark.createDataFrame(rows, "id long, token_ids array<int>")
    embeddings, w1, b1, w2, b2 = model.parts()
    vectors = spark.createDataFrame(
        [(i, list(map(float, v))) for i, v in enumerate(embeddings)], "idx int, vector array<double>"
    )
    layers = spark.createDataFrame(
        [(0, j, list(map(float, w1[:, j])), float(b1[j])) for j in range(4)] + [(1, 0, list(map(float, w2)), float(b2))],
        "layer int, unit int, weights array<double>, bias double",
    )
    whole = {r["id"]: r["score"] for r in mlp.mlp_scores(encoded, model).collect()}
    parts = {r["id"]: r["score"] for r in mlp.forward(encoded, vectors, layers, 3).collect()}
    assert parts.keys() == whole.keys() and all(parts[k] == pytest.approx(whole[k]) for k in whole)


def test_mlp_batches_cover_all_rows(spark, toy_corpus):
    vocabulary = features.fit_token_vocabulary(toy_corpus, 1, 100)
    encoded = features.encode(toy_corpus, vocabulary, ("id", "target"))
    many = encoded.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(9)))).withColumn(
        "id", F.col("id") * 100 + F.col("copy")
    )
    steps = mlp.batched(many, 3)
    ids = [sorted(r["id"] for r in step.collect()) for step in steps]
    assert sorted(sum(ids, [])) == sorted(r["id"] for r in many.collect()) and len(ids) == 3
    settings = mlp.MlpSettings(embedding_dim=8, hidden_dim=8, epochs=4, batches=3, seed=11)
    check(ordered(mlp.mlp_scores(encoded, mlp.fit_mlp(many, vocabulary.count(), settings))))


def test_mlp_trains_and_does_not_depend_on_partitions(toy_corpus):
    vocabulary = features.fit_token_vocabulary(toy_corpus, 1, 100)
    encoded = features.encode(toy_corpus, vocabulary, ("id", "target"))
    settings = mlp.MlpSettings(embedding_dim=8, hidden_dim=8, epochs=6, learning_rate=0.05, seed=11)
    one = mlp.fit_mlp(encoded.repartition(1), vocabulary.count(), settings)
    four = mlp.fit_mlp(encoded.repartition(4, "id"), vocabulary.count(), settings)
    assert np.allclose(one.table, four.table)
    check(ordered(mlp.mlp_scores(encoded, one)))


def test_mlp_chunks_cover_all_documents(monkeypatch):
    monkeypatch.setattr(mlp, "CHUNK_TOKENS", 5)
    counts = np.array([3, 3, 0, 11, 0, 2, 2])
    ranges = list(mlp._chunks(counts))
    assert ranges[0][0] == 0 and ranges[-1][1] == 7
    assert all(a[1] == b[0] for a, b in zip(ranges, ranges[1:]))


def test_one_pass_gives_the_rows_of_every_vocabulary(spark, toy_corpus):
    docs = toy_corpus.unionByName(spark.createDataFrame([(9, "", 0), (8, "coffee coffee zzz", 1)], toy_corpus.schema))
    known = [features.fit_vocabulary(docs, 1, n) for n in (3, 50)]
    together = linear.ensemble_rows(docs, known).collect()
    assert len(together) == 12
    for m, vocabulary in enumerate(known):
        alone = {r["id"]: r["features"] for r in features.tfidf(docs, vocabulary).collect()}
        got = {r["id"]: r["features"] for r in together if r["member"] == m}
        assert set(got) == set(alone)
        for i, cells in alone.items():
            assert [c["idx"] for c in got[i]] == [c["idx"] for c in cells]
            assert np.allclose([c["w"] for c in got[i]], [c["w"] for c in cells])


def test_network_reads_each_distinct_token_once(spark):
    rows = spark.createDataFrame([(1, 1, [3, 3, 0, 3]), (2, 0, []), (2, 1, [1])], "id long, target int, token_ids array<int>")
    packed = mlp.compressed(rows, 4)
    assert sorted((r["token_ids"], r["times"]) for r in packed.collect()) == [([], []), ([0, 3], [1, 3]), ([1], [1])]
    model = mlp.initial_model(4, mlp.MlpSettings(embedding_dim=3, hidden_dim=2))
    total = np.zeros_like(model.table)
    mlp.add_gradient(model, total, np.array([3, 3, 0, 3, 1]), np.array([4, 0, 1]), np.array([1.0, 0.0, 1.0]))
    assert np.allclose(mlp.gradient(packed, model), total) and np.allclose(mlp.gradient(rows, model), total)

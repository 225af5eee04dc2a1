from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from trustgauge.operators import features, linear, mlp
from trustgauge.plans import queries
from trustgauge.sources.workspace import by_key, in_place

DOCS = [
    (0, "fire fire storm"),
    (1, "storm at sea"),
    (2, ""),
    (3, "sea sea sea fire"),
    (4, "unknown"),
]


@pytest.fixture
def docs(spark):
    return spark.createDataFrame(DOCS, "id long, text string")


def brute_vocabulary(min_df, limit):
    tf, df = Counter(), Counter()
    for _, line in DOCS:
        words = line.split()
        terms = words + [f"{a} {b}" for a, b in zip(words, words[1:])]
        tf.update(terms)
        df.update(set(terms))
    chosen = sorted((t for t in df if df[t] >= min_df), key=lambda t: (-tf[t], t))
    chosen = chosen[:limit] if limit else chosen
    return {t: (i, math.log((1 + len(DOCS)) / (1 + df[t])) + 1) for i, t in enumerate(chosen)}


@pytest.mark.parametrize("min_df, limit", [(1, 0), (1, 3), (2, 15_000)])
def test_vocabulary_matches_brute_force(docs, min_df, limit):
    rows = features.fit_vocabulary(docs, min_df, limit).collect()
    expected = brute_vocabulary(min_df, limit)
    assert {r["term"]: r["idx"] for r in rows} == {t: i for t, (i, _) in expected.items()}
    for r in rows:
        assert r["idf"] == pytest.approx(expected[r["term"]][1])


def test_vocabulary_ties_are_in_term_order(spark):
    counts = spark.createDataFrame([("z", 2, 2), ("b", 2, 2), ("a", 1, 2)], "term string, tf long, df long")
    picked = features.select_vocabulary(counts, F.lit(4), min_df=1)
    assert [r["term"] for r in picked.orderBy("idx").collect()] == ["b", "z", "a"]


def test_idf(spark):
    row = spark.range(1).select(
        features.smoothed_idf(F.lit(4), F.lit(4)).alias("a"), features.smoothed_idf(F.lit(1), F.lit(4)).alias("b")
    ).first()
    assert row["a"] == pytest.approx(1.0)
    assert row["b"] == pytest.approx(math.log(2.5) + 1)


@pytest.mark.parametrize("partitions", [1, 4, 16])
def test_tfidf_matches_brute_force(docs, partitions):
    spread = docs.repartition(partitions, "id")
    vocabulary = features.fit_vocabulary(spread, 1, 6)
    got = {r["id"]: {c["idx"]: c["w"] for c in r["features"]} for r in features.tfidf(spread, vocabulary).collect()}
    known = brute_vocabulary(1, 6)
    assert set(got) == {i for i, _ in DOCS}
    for i, line in DOCS:
        words = line.split()
        counts = Counter(words + [f"{a} {b}" for a, b in zip(words, words[1:])])
        row = {known[t][0]: (1 + math.log(c)) * known[t][1] for t, c in counts.items() if t in known}
        norm = math.sqrt(sum(w * w for w in row.values()))
        assert got[i] == pytest.approx({k: w / norm for k, w in row.items()})


def test_encode_keeps_order_and_repeats(docs):
    vocabulary = features.fit_token_vocabulary(docs, 1, 3)
    index = {r["term"]: r["idx"] for r in vocabulary.collect()}
    assert index == {"sea": 0, "fire": 1, "storm": 2}
    got = {r["id"]: r["token_ids"] for r in features.encode(docs, vocabulary).collect()}
    assert got == {0: [1, 1, 2], 1: [2, 0], 2: [], 3: [0, 0, 0, 1], 4: []}


def test_zero_tokens_means_no_vocabulary(docs):
    vocabulary = features.fit_token_vocabulary(docs, 1, 0)
    assert vocabulary.count() == 0
    assert all(r["token_ids"] == [] for r in features.encode(docs, vocabulary).collect())


def test_vectors_match_rows(docs):
    vocabulary = features.fit_vocabulary(docs, 1, 6)
    rows = features.tfidf(docs, vocabulary)
    vectors = {r["id"]: r["features"] for r in features.to_vectors(rows, 6).collect()}
    for r in rows.collect():
        dense = np.zeros(6)
        for c in r["features"]:
            dense[c["idx"]] = c["w"]
        assert np.allclose(vectors[r["id"]].toArray(), dense)


def test_document_embeddings(docs):
    vocabulary = features.fit_token_vocabulary(docs, 1, 3)
    # More vectors than tokens may be named: the table's size is nobody's limit.
    spark = docs.sparkSession
    vectors = spark.range(12_000).select(
        F.col("id").cast("int").alias("idx"), F.array(F.col("id") * 2.0, F.col("id") * 2.0 + 1).alias("vector")
    )
    encoded = features.encode(docs, vocabulary)
    got = {r["id"]: r["embedding"] for r in mlp.document_embeddings(encoded, vectors, 2).collect()}
    assert got[0] == pytest.approx([(2 + 2 + 4) / 3, (3 + 3 + 5) / 3])
    assert got[2] == [0.0, 0.0]


def test_scoring_by_join_equals_scoring_by_array(docs, monkeypatch):
    vocabulary = features.fit_vocabulary(docs, 1, 6)
    rows = features.tfidf(docs, vocabulary)
    weights = vocabulary.select("idx", (F.col("idx") * 0.5 - 1.0).alias("weight"))
    model = linear.LinearModel(weights, 0.25, 6)
    dense = {r["id"]: r["score"] for r in linear.linear_scores(rows, model).collect()}
    monkeypatch.setattr(linear, "DENSE_WEIGHTS", 0)
    joined = {r["id"]: r["score"] for r in linear.linear_scores(rows, model).collect()}
    assert joined == pytest.approx(dense)
    assert dense[2] == 0.25


def exchanges(df):
    """Columns by which the plan of ``df`` deals rows out."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)


def test_lookups_leave_the_terms_where_they_are(spark, toy_corpus):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        docs = by_key(toy_corpus, "id")
        known = features.fit_vocabulary(docs, min_df=1)
        for found in (features.tfidf(docs, known), features.encode(docs, known)):
            assert [c.split("#")[0] for c in exchanges(found)] == ["id"]
        vectors = known.select("idx", F.array(F.lit(1.0), F.lit(2.0)).alias("vector"))
        means = mlp.document_embeddings(features.encode(docs, known), vectors, 2)
        assert {c.split("#")[0] for c in exchanges(means)} == {"id"}
        assert all(r["embedding"] == [1.0, 2.0] for r in means.collect())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_large_lookups_are_not_sent_about(spark, monkeypatch):
    monkeypatch.setattr(features, "SHARED_BYTES", 10)
    table = spark.createDataFrame([("fire", 0)], "term string, idx int")
    assert "broadcast" not in features.shared_terms(table)._jdf.queryExecution().logical().toString().lower()


ODD_TEXTS = [
    (1, "fire fire in the house"), (1, "the house on fire"), (2, None), (3, ""), (None, "fire in"),
    (4, "a b a b"), (4, "a b a b"), (5, "http://x.y @you the house"), (None, "the fire"),
]


def test_terms_are_counted_in_the_task_as_in_a_grouping(spark):
    docs = spark.createDataFrame(ODD_TEXTS, "id long, text string")
    plain = features.term_frequencies(features.term_counts(docs, (1, 3)))
    counted = features.text_frequencies(docs, (1, 3))
    assert sorted(map(tuple, counted.collect())) == sorted(map(tuple, plain.collect()))
    # No row per document and term.
    assert "Generate" not in counted._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("limit", [4, 50])
def test_rows_by_sent_and_by_joined_vocabulary_agree(spark, monkeypatch, limit):
    docs = spark.createDataFrame(ODD_TEXTS, "id long, text string")
    known = features.fit_vocabulary(docs, 1, limit)
    tokens = features.fit_token_vocabulary(docs, 1, limit)

    def found():
        rows = {r["id"]: [(c["idx"], round(c["w"], 12)) for c in r["features"]] for r in features.tfidf(docs, known).collect()}
        return rows, {r["id"]: r["token_ids"] for r in features.encode(docs, tokens).collect()}

    sent = found()
    assert "Generate" not in features.encode(docs, tokens)._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(features, "SHARED_BYTES", 0)
    assert sent == found()


@pytest.mark.parametrize("shared_bytes", [64_000_000, 100])
@pytest.mark.parametrize("unique", [True, False])
def test_vectors_come_to_the_documents_in_blocks(spark, monkeypatch, shared_bytes, unique):
    """However many vectors there are, no row per document and token and no partial sums of a document by vector."""
    monkeypatch.setattr(features, "SHARED_BYTES", shared_bytes)
    monkeypatch.setattr(mlp, "HELD_TOKENS", 4)
    rows = [(0, [1, 1, 8]), (1, []), (2, [0, 3]), (3, [5, None, 6, 5]), (None, [1]), (4, [20]), (5, [3])]
    rows += [] if unique else [(0, [2])]
    encoded = spark.createDataFrame(rows, "id long, token_ids array<int>").repartition(3)
    vectors = [(k, [float(k), 10.0 * k]) for k in range(9)] + [(8, [1.0, None]), (20, [None, 2.0]), (None, [9.0, 9.0])]
    vectors[3] = (3, None)
    table = spark.createDataFrame(vectors, "idx long, vector array<float>")
    found = mlp.document_embeddings(encoded, table, 2, unique=unique)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and not any(c.startswith("idx#") for c in exchanges(found))
    zero = [(1 + 1 + 8 + 1) / 4, (10 + 10 + 80) / 4] if unique else [(1 + 1 + 8 + 1 + 2) / 5, (10 + 10 + 80 + 20) / 5]
    want = {0: zero, 1: [0.0, 0.0], 2: [0.0, 0.0], 3: [16 / 3, 160 / 3], None: [0.0, 0.0], 4: [None, 2.0], 5: [None, None]}
    got = [(r["id"], r["embedding"]) for r in found.collect()]
    assert len(got) == len(rows)
    assert all(value == pytest.approx(want[i]) if None not in want[i] else value == want[i] for i, value in got)


def test_a_text_stays_where_it_is_unless_its_id_comes_again(spark):
    docs = spark.createDataFrame(ODD_TEXTS, "id long, text string").repartition(3, "text")
    apart = docs.where("id in (2, 3, 5)")
    none, some = features.repeated_ids(apart), features.repeated_ids(docs)
    assert none.isEmpty() and {r["id"] for r in some.collect()} == {1, 4, None}
    known = features.fit_token_vocabulary(docs, 1, 50, repeats=some)
    assert sorted(map(tuple, known.collect())) == sorted(map(tuple, features.fit_token_vocabulary(docs, 1, 50).collect()))
    for part, repeats in ((docs, some), (apart, none)):
        got, want = features.encode(part, known, repeats=repeats), features.encode(part, known)
        assert {r["id"]: r["token_ids"] for r in got.collect()} == {r["id"]: r["token_ids"] for r in want.collect()}
        assert got.count() == want.count()
    assert not [c for c in exchanges(features.encode(apart, known, repeats=none)) if c.startswith("id#")]


def test_rows_are_spread_only_when_few_tasks_hold_them(spark):
    even, lone = spark.range(0, 1000, 1, 8), spark.range(0, 1000, 1, 1)
    assert in_place(even, "id") is even
    assert exchanges(in_place(lone, "id"))


def test_document_embeddings_take_the_texts_as_they_are_read(spark, tmp_path):
    words = F.concat_ws(" ", F.lit("fire house"), F.col("doc_id").cast("string"))
    docs = spark.range(0, 800, 1, 8).withColumnRenamed("id", "doc_id").select("doc_id", words.alias("text"), F.lit("web").alias("source"))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    vectors = spark.range(3).select(F.col("id").alias("vec_id"), F.array(F.col("id").cast("float")).alias("embedding"))
    vectors.write.parquet(str(tmp_path / "embeddings.parquet"))
    found = queries.document_embeddings(spark, str(tmp_path))
    assert not exchanges(found)
    assert {(r["dim"], r["value"]) for r in found.collect()} == {(0, 1.0)} and found.count() == 800

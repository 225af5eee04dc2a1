from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from trustgauge.functions import rules, scalars, text
from trustgauge.operators import errors, external, phrases


def one(spark, column, **values):
    kinds = {str: "string", int: "int", float: "double", list: "array<double>"}
    schema = ", ".join(f"{k} {kinds[type(v)] if v is not None else 'string'}" for k, v in values.items())
    row = spark.createDataFrame([tuple(values.values())], schema).select(column.alias("r")).first()
    return row["r"]


@pytest.mark.parametrize("x, expected", [(0.0, 0.5), (2.0, 1 / (1 + math.exp(-2))), (-800.0, 0.0), (800.0, 1.0)])
def test_sigmoid(spark, x, expected):
    assert one(spark, scalars.sigmoid(F.col("x")), x=x) == pytest.approx(expected, abs=1e-15)


def test_labels_are_inclusive_and_answers_strict(spark):
    assert one(spark, scalars.predicted_label(F.col("p")), p=0.5) == 1
    assert one(spark, scalars.predicted_label(F.col("p")), p=0.4999) == 0
    assert one(spark, scalars.answered(F.col("p"), 0.75), p=0.75) is False
    assert one(spark, scalars.answered(F.col("p"), 0.75), p=0.2) is True


def test_clip_and_loss(spark):
    assert one(spark, scalars.clip_probability(F.col("p")), p=0.0) == 1e-12
    assert one(spark, scalars.clip_probability(F.col("p")), p=1.0) == 1.0 - 1e-12
    assert one(spark, scalars.log_loss(F.lit(1), F.col("p")), p=0.25) == pytest.approx(-math.log(0.25))
    assert one(spark, scalars.log_loss(F.lit(0), F.col("p")), p=0.25) == pytest.approx(-math.log(0.75))


def test_class_probability_rejects_other_classes(spark):
    assert one(spark, scalars.class_probability(F.col("p"), F.lit(0)), p=0.25) == 0.75
    with pytest.raises(Exception, match="class must be 0 or 1"):
        one(spark, scalars.class_probability(F.col("p"), F.lit(2)), p=0.25)


@pytest.mark.parametrize(
    "logits, score, prob",
    [([0.0, 0.0], 0.0, 0.5), ([2.0], 2.0, 1 / (1 + math.exp(-2))), ([1000.0, 1001.0, 0.0], 1.0, 1 / (1 + math.exp(-1)))],
)
def test_logits(spark, logits, score, prob):
    assert one(spark, scalars.logits_score(F.col("l")), l=logits) == pytest.approx(score)
    assert one(spark, scalars.logits_probability(F.col("l")), l=logits) == pytest.approx(prob)


def test_label_smoothing(spark):
    assert one(spark, scalars.smooth_label(F.col("y"), 0.1), y=1) == pytest.approx(0.95)
    assert one(spark, scalars.smooth_label(F.col("y"), 0.1), y=0) == pytest.approx(0.05)


@pytest.mark.parametrize("name, base, method", [("a/b/c", "a", "b/c"), ("a", "a", "raw"), ("a/raw", "a", "raw")])
def test_variant_names(spark, name, base, method):
    assert one(spark, scalars.base_model(F.col("m")), m=name) == base
    assert one(spark, scalars.method(F.col("m")), m=name) == method
    assert scalars.model_slug("vendor/model") == "vendor_model"


@pytest.mark.parametrize(
    "raw, expected",
    [
        ("Hi @żółw_1 see https://t.co/ABC a@b.com", "hi usertoken see urltoken a usertoken com"),
        ("WWW.x.y Don't #Run_2", "urltoken don't #run_2"),
        ("", ""),
        ("éàü", ""),
    ],
)
def test_tokens(spark, raw, expected):
    assert " ".join(one(spark, text.tokens(F.col("t")), t=raw)) == expected


def test_terms(spark):
    tokens = F.split("t", " ")
    assert one(spark, text.terms(tokens), t="a b c") == ["a", "b", "c", "a b", "b c"]
    assert one(spark, text.terms(tokens), t="a") == ["a"]
    assert one(spark, text.terms(tokens, (2, 3)), t="a b c") == ["a b", "b c", "a b c"]
    assert one(spark, text.terms(tokens, (0, 1)), t="a b") == ["a", "b"]
    assert one(spark, text.terms(tokens, (0, 0)), t="a b") == []


def test_compose_text(spark):
    both = text.compose_text(F.col("t"), F.col("k"))
    assert one(spark, both, t="A", k="forest%20fire") == "A  keyword: forest fire"
    assert one(spark, both, t="A", k=None) == "A  keyword: "
    assert one(spark, text.compose_text(F.col("t")), t="A") == "A"
    assert one(spark, text.clean_keyword(F.col("k")), k="  x%20 \t") == "x"


@pytest.mark.parametrize(
    "raw, expected",
    [("A  KEYWORD:  Forest Fire ", "forest fire"), ("nokeyword: x", ""), ("keyword: a\nb", ""), ("x", "")],
)
def test_extract_keyword(spark, raw, expected):
    assert one(spark, text.extract_keyword(F.col("t")), t=raw) == expected


@pytest.mark.parametrize(
    "raw, target, predicted, expected",
    [
        ("infant formula", 0, 1, "fiction_entertainment"),
        ("a hoax about a movie", 0, 1, "false_alarm_or_averted"),
        ("IDEAL", 0, 1, "commerce_or_spam"),
        ("we blew up", 0, 1, "metaphor_or_idiom"),
        ("see t.co/1", 0, 1, "news_link_or_policy_context"),
        ("zzz  keyword: crush", 0, 1, "keyword_trigger_false_positive"),
        ("zzz", 0, 1, "other_false_positive"),
        ("the wildfire news is on fire", 1, 0, "short_or_low_context_real_disaster"),
        ("a b c d e f g the town is on fire", 1, 0, "real_disaster_sounded_figurative"),
        ("a b c d e f g the news of a flood", 1, 0, "linked_real_event_underrecognized"),
        ("a b c d e f g flood in town", 1, 0, "missed_real_event_terms"),
        ("a b c d e f g h i", 1, 0, "other_false_negative"),
        ("movie", 1, 1, "correct"),
    ],
)
def test_categories(spark, raw, target, predicted, expected):
    category = rules.error_category(F.col("t"), F.lit(target), F.lit(predicted))
    assert one(spark, category, t=raw) == expected


def test_own_phrases(spark):
    category = rules.error_category(F.col("t"), F.lit(0), F.lit(1), {"commerce": ["a.b"]})
    assert one(spark, category, t="xa.bx") == "commerce_or_spam"
    assert one(spark, category, t="axb") == "other_false_positive"


def test_phrase_table_equals_contains(spark):
    """Every set with a phrase in the text, by one pass, against a search for each phrase."""
    import random

    rng = random.Random(4)
    letters = "abcü "
    rules = [(f"s{rng.randrange(7)}", "".join(rng.choice(letters) for _ in range(rng.randint(1, 4)))) for _ in range(60)]
    rules += [("empty", ""), (None, "a"), ("none", None), ("s1", "ab"), ("s1", "ab")]
    texts = ["".join(rng.choice(letters + "ABCÜ") for _ in range(rng.randint(0, 30))) for _ in range(200)] + [None, ""]
    rows = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    table = spark.createDataFrame(rules, "rule_set string, phrase string")
    got = {r["id"]: r["hits"] for r in phrases.phrase_hits(rows, table).collect()}
    for k, text in enumerate(texts):
        low = None if text is None else text.lower()
        assert got[k] == sorted({s for s, p in rules if s and p is not None and low is not None and p in low})
    assert [r["hits"] for r in phrases.phrase_hits(rows, table.limit(0)).take(2)] == [[], []]


def test_phrase_table_is_bounded(spark, monkeypatch):
    monkeypatch.setattr(phrases, "MOST_CHARS", 5)
    table = spark.createDataFrame([("a", "longer")], "rule_set string, phrase string")
    with pytest.raises(ValueError, match="exceed"):
        phrases.phrase_hits(spark.range(1).selectExpr("'x' AS text"), table)


def test_default_lists_as_a_table_give_the_same_categories(spark):
    from trustgauge.functions.rules import DEFAULT_PHRASES

    table = spark.createDataFrame(
        [(name, p) for name, own in DEFAULT_PHRASES.items() for p in own], "rule_set string, phrase string"
    )
    texts = ["A movie", "a hoax, averted", "reports say flood", "BUY this", "nothing here at all", None, "zzz  keyword: crush"]
    rows = spark.createDataFrame(
        [(t, y) for t in texts for y in (0, 1)], "text string, target int"
    ).selectExpr("*", "1 - target AS predicted")
    one = errors.with_category(rows, "target", "predicted").collect()
    two = errors.with_category_by_rules(rows, "target", "predicted", table).collect()
    assert [r["category"] for r in one] == [r["category"] for r in two]


def test_scoring_function(spark):
    """Whole inputs are scored; null, short and infinite ones are refused with their number."""
    given = [(1, [1.0, 2.0, 3.0]), (2, None), (3, [1.0]), (4, [1.0, None, 2.0]), (5, [9.0, 1.0, 1.0]), (6, [0.0, -1.0, 5.0])]
    rows = spark.createDataFrame(given, "id long, inputs array<double>")

    def load():
        return lambda inputs: np.where(inputs[:, :2] < 9, inputs[:, :2], np.inf)

    scored = external.score_batches(rows, load, 3)
    got = {r["id"]: r["logits"] for r in scored.collect()}
    assert got == {1: [1.0, 2.0], 2: None, 3: None, 4: None, 5: None, 6: [0.0, -1.0]}
    truth = rows.selectExpr("id", "1 AS target", "'test' AS split")
    with pytest.raises(ValueError, match="4 rows have no logits"):
        external.external_predictions(truth, scored.select("id", "logits"), "net")

"""Probability, label and score arithmetic on columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: probabilities are kept this far from 0 and 1 before a logarithm.
PROB_EPS = 1e-12

# A probability at or above the first is class 1, an error at or above the
# second counts as highly confident.
LABEL_THRESHOLD = 0.5
HIGH_CONFIDENCE = 0.90


def sigmoid(x: Column) -> Column:
    """Logistic function that never exponentiates a positive number."""
    tail = F.exp(-F.abs(x))
    return F.when(x >= 0, F.lit(1.0) / (F.lit(1.0) + tail)).otherwise(tail / (F.lit(1.0) + tail))


def clip_probability(p: Column) -> Column:
    held = F.least(F.greatest(p, F.lit(PROB_EPS)), F.lit(1.0 - PROB_EPS))
    return F.when(p.isNotNull(), held)


def predicted_label(p: Column, threshold: float = LABEL_THRESHOLD) -> Column:
    return (p >= F.lit(threshold)).cast("int")


def confidence(p: Column) -> Column:
    """Confidence in the chosen class, whichever it is."""
    return F.greatest(p, F.lit(1.0) - p)


def class_probability(p: Column, klass: Column) -> Column:
    return (
        F.when(klass == 1, p)
        .when(klass == 0, F.lit(1.0) - p)
        .otherwise(F.raise_error(F.lit("class must be 0 or 1")))
    )


def nonconformity(target: Column, p: Column) -> Column:
    """1 - probability of the true class. 1-(1-p) is kept: it differs from p in the last bit."""
    return F.lit(1.0) - F.when(target == 1, p).otherwise(F.lit(1.0) - p)


def log_loss(target: Column, p: Column) -> Column:
    """Per-row negative log likelihood of a 0/1 target."""
    safe = clip_probability(p)
    return -F.ln(F.when(target == 1, safe).otherwise(F.lit(1.0) - safe))


def smooth_label(target: Column, smoothing: float) -> Column:
    return target * F.lit(1.0 - smoothing) + F.lit(0.5 * smoothing)


def signed_label(target: Column) -> Column:
    return F.when(target == 1, 1.0).otherwise(-1.0)


def logits_score(logits: Column) -> Column:
    """Binary score of a logit array: the single logit, or class 1 minus class 0."""
    return F.when(F.size(logits) == 1, F.get(logits, F.lit(0))).otherwise(
        F.get(logits, F.lit(1)) - F.get(logits, F.lit(0))
    )


def logits_probability(logits: Column) -> Column:
    """Class-1 probability of a logit array: sigmoid for one logit, softmax for more."""
    top = F.array_max(logits)
    total = F.aggregate(logits, F.lit(0.0), lambda acc, x: acc + F.exp(x - top))
    return F.when(F.size(logits) == 1, sigmoid(F.get(logits, F.lit(0)))).otherwise(
        F.exp(F.get(logits, F.lit(1)) - top) / total
    )


def base_model(model: Column) -> Column:
    return F.get(F.split(model, "/", 2), F.lit(0))


def method(model: Column) -> Column:
    return F.coalesce(F.get(F.split(model, "/", 2), F.lit(1)), F.lit("raw"))


def model_slug(name: str) -> str:
    """External model names may hold slashes, which separate model and method here."""
    return name.replace("/", "_")


def answered(p: Column, tau: Column | float) -> Column:
    """A prediction is given only above the threshold; equality abstains."""
    return confidence(p) > (tau if isinstance(tau, Column) else F.lit(float(tau)))

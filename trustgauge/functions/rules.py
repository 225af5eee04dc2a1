"""Phrase rules that name the likely reason for a wrong prediction."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from trustgauge.functions.text import contains_any, extract_keyword, raw_token_count

# The phrase lists, the category names and the short-text limit.
FALSE_ALARM = ["false alarm", "hoax", "averted", "drill", "test alarm", "not a disaster"]
FICTION = [
    "movie", "film", "novel", "book", "chapter", "fan", "fans", "trailer", "episode", "game",
    "song", "music", "ibook", "bookboost", "fiction", "romance",
]
COMMERCE = [
    "sale", "shop", "coupon", "handbag", "purse", "ebay", "amazon", "product", "deal", "buy",
    "free shipping",
]
METAPHOR = [
    "on fire", "this is fire", "drowning in", "crushed", "blew up", "blown away", "exploded",
    "dead tired", "killed it", "disaster for my team", "crash again",
]
NEWS = [
    "http://", "https://", "t.co/", "via @", "reports", "news", "latest", "state actions",
    "potus", "policy", "verdict",
]
REAL_EVENT = [
    "evacuated", "evacuation", "injured", "killed", "rescue", "warning", "wildfire",
    "earthquake", "flood", "hurricane", "tornado", "explosion", "crash", "derailment",
]
DEFAULT_PHRASES: dict[str, list[str]] = {
    "false_alarm": FALSE_ALARM,
    "fiction": FICTION,
    "commerce": COMMERCE,
    "metaphor": METAPHOR,
    "news": NEWS,
    "real_event": REAL_EVENT,
}
FALSE_POSITIVE_RULES = [
    ("false_alarm", "false_alarm_or_averted"),
    ("fiction", "fiction_entertainment"),
    ("commerce", "commerce_or_spam"),
    ("metaphor", "metaphor_or_idiom"),
    ("news", "news_link_or_policy_context"),
]
FALSE_NEGATIVE_RULES = [
    ("metaphor", "real_disaster_sounded_figurative"),
    ("news", "linked_real_event_underrecognized"),
    ("real_event", "missed_real_event_terms"),
]
KEYWORD_FALSE_POSITIVE = "keyword_trigger_false_positive"
OTHER_FALSE_POSITIVE = "other_false_positive"
SHORT_FALSE_NEGATIVE = "short_or_low_context_real_disaster"
OTHER_FALSE_NEGATIVE = "other_false_negative"
NO_ERROR = "correct"
SHORT_TEXT_TOKENS = 8


def error_category(
    text: Column,
    target: Column,
    predicted: Column,
    phrases: Mapping[str, Sequence[str]] | None = None,
    lowered: Column | None = None,
    hits: Column | None = None,
) -> Column:
    """First rule that holds, in order, as one native expression.

    ``phrases`` replaces or extends the phrase lists by name. ``lowered`` is the text in lower
    case where the caller has it as a column: the expression names it once per phrase. Where the
    lists are a table, ``hits`` names those that the text holds, and no phrase is looked for here.
    """
    lowered = F.lower(text) if lowered is None else lowered
    lists = {**DEFAULT_PHRASES, **(phrases or {})}

    def holds(name: str) -> Column:
        return contains_any(lowered, lists[name]) if hits is None else F.array_contains(hits, name)

    false_positive = (target == 0) & (predicted == 1)
    false_negative = (target == 1) & (predicted == 0)

    # Wrong rows only reach the text rules: a when() stops at the first branch that holds.
    category = F.when(~(false_positive | false_negative), F.lit(NO_ERROR))
    for name, label in FALSE_POSITIVE_RULES:
        category = category.when(false_positive & holds(name), F.lit(label))
    category = category.when(
        false_positive & (extract_keyword(text) != ""), F.lit(KEYWORD_FALSE_POSITIVE)
    )
    category = category.when(false_positive, F.lit(OTHER_FALSE_POSITIVE))
    category = category.when(
        raw_token_count(text) <= SHORT_TEXT_TOKENS, F.lit(SHORT_FALSE_NEGATIVE)
    )
    for name, label in FALSE_NEGATIVE_RULES:
        category = category.when(holds(name), F.lit(label))
    return category.otherwise(F.lit(OTHER_FALSE_NEGATIVE))

"""Rules given as a table: which sets of phrases a text holds, in one pass over the text."""

from __future__ import annotations

import uuid

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trustgauge.sources.shipping import ship_package

# Characters of all phrases together, which go to every worker as one automaton (some 100 bytes each).
MOST_CHARS = 5_000_000

_machines: dict[str, tuple] = {}


def _machine(key: str, rules: list[tuple[str, list[int]]]):
    """The automaton of a rule table, built once in a worker; it yields the sets of each phrase it meets."""
    if key not in _machines:
        import ahocorasick

        machine = ahocorasick.Automaton()
        always = set()
        for phrase, sets in rules:
            if phrase:
                machine.add_word(phrase, tuple(sets))
            else:
                always.update(sets)
        if len(machine):
            machine.make_automaton()
        _machines.clear()
        _machines[key] = machine, always
    return _machines[key]


def phrase_hits(
    rows: DataFrame, rules: DataFrame, text_col: str = "text", hits_col: str = "hits"
) -> DataFrame:
    """Add the names of all rule sets with a phrase in the lower-case text, in order of name.

    ``rules`` has (rule_set, phrase). A phrase is met anywhere, inside words too, in lower case as it
    is given; an empty one is in every text, a null one in none. All phrases are looked for at
    once, so the time follows the length of the text, not their number. A null text has no hits.
    Their automaton goes to every worker: a table of more than MOST_CHARS characters is an error.
    """
    spark = rows.sparkSession
    ship_package(spark)
    known = rules.where("rule_set IS NOT NULL AND phrase IS NOT NULL").distinct()
    size = known.agg(F.coalesce(F.sum(F.length("phrase") + 1), F.lit(0))).first()[0]
    if size > MOST_CHARS:
        raise ValueError(f"{size} characters of phrases exceed {MOST_CHARS}")
    listed = known.groupBy("phrase").agg(F.sort_array(F.collect_list("rule_set")).alias("sets")).collect()
    names = sorted({s for r in listed for s in r["sets"]})
    number = {s: k for k, s in enumerate(names)}
    shared = spark.sparkContext.broadcast([(r["phrase"], [number[s] for s in r["sets"]]) for r in listed])
    key = uuid.uuid4().hex

    @F.pandas_udf("array<string>")
    def hits(texts: pd.Series) -> pd.Series:
        machine, always = _machine(key, shared.value)
        out = []
        for text in texts:
            found = set(always) if text is not None else set()
            if text and len(machine):
                for _, sets in machine.iter(text):
                    found.update(sets)
                    if len(found) == len(names):
                        break
            out.append([names[k] for k in sorted(found)])
        return pd.Series(out, dtype=object)

    return rows.withColumn(hits_col, hits(F.lower(F.col(text_col))))

"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trustgauge.llm.common import store


def _state(links: DataFrame) -> tuple:
    """Count and checksum of the distinct links: equal in two rounds when nothing moved.

    The checksum has 64 bits for any number of links, where a sum of hashes would overflow.
    """
    return tuple(
        links.agg(
            F.count(F.lit(1)).alias("n"),
            F.bit_xor(F.xxhash64("u", "v")).alias("s"),
        ).first()
    )




def components(links: DataFrame) -> DataFrame:
    """Smallest reachable id of every id that has a link: (id, label).

    ``links`` has (a, b). Each round first points all larger neighbours of an id at its least
    neighbour, then does the same for the smaller ones, until every id points at the least of
    its component; the number of rounds grows with the logarithm of the component's size.
    Only minima are gathered per id, never its list of neighbours, and both joins match many
    links with one row per id, which the optimizer can split for an id with many links.
    """
    pairs = store(
        links.where("a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct(),
        narrow=True,
    )
    before = _state(pairs)
    while True:
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        # Only the larger ends move, and those are the rows of ``pairs`` with u and v swapped.
        larger = pairs.select(F.col("v").alias("u"), F.col("u").alias("v"))
        large = larger.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        pairs = store(moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), narrow=True)
        after = _state(pairs)
        if after == before:
            break
        before = after
    return pairs.select(F.col("u").alias("id"), F.col("v").alias("label")).unionByName(
        pairs.select(F.col("v").alias("id"), F.col("v").alias("label")).distinct()
    )

"""Near-duplicate detection: MinHash with tensored banding, links verified on full sets."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trustgauge.llm import wordhash as wh
from trustgauge.llm.common import small_batches, store
from trustgauge.llm.components import components
from trustgauge.sources.shipping import ship_package

SLICE_BYTES = 2 << 20
_BASE = 0xA24BAED4963EE407


@dataclass(frozen=True)
class Settings:
    """Width of shingles, least similarity in percent, and the two hash collections.

    ``groups`` hashes per collection, of ``rows`` minhashes each, give groups^2 tables whose keys
    join one hash of either collection: 10 x 3 x 2 = 60 minhashes stand for 100 tables of 6. A
    pair at 0.85 shares some key with probability (1 - (1 - 0.85^3)^10)^2 > 0.9998, a pair at 0.8
    only with 0.9985, for which 14 groups give more than 0.9999.
    """

    shingle: int = 5
    percent: int = 80
    groups: int = 10
    rows: int = 3


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    sizes = np.cumsum(pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False))
    at = 0
    while at < batch.num_rows:
        seen = int(sizes[at - 1]) if at else 0
        to = max(at + 1, int(np.searchsorted(sizes, seen + SLICE_BYTES, "right")))
        yield batch.slice(at, to - at)
        at = to


def shingle_sets(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all texts, and where each text's begin.

    A text with fewer words than a shingle has its whole sequence as its only one.
    """
    words, first = wh.hash_words(texts, lower=True)
    rolled = wh.windows(words, width, _BASE)
    parts, sizes = [], np.zeros(len(first) - 1, dtype=np.int64)
    for k, (a, b) in enumerate(zip(first[:-1].tolist(), first[1:].tolist(), strict=True)):
        if b - a >= width:
            own = rolled[a : b - width + 1]
            own = np.sort(own)
            own = own[np.append(True, own[1:] != own[:-1])]
        elif b > a:
            own = wh.windows(words[a:b], b - a, _BASE)
        else:
            continue
        parts.append(own)
        sizes[k] = len(own)
    whole = np.concatenate(parts) if parts else np.empty(0, dtype=np.uint64)
    return whole, np.append(0, np.cumsum(sizes))


def _collections(hashes: np.ndarray, first: np.ndarray, groups: int, rows: int) -> np.ndarray:
    """Combined minhashes per text: 2 * groups columns, for texts with a shingle."""
    out = np.zeros((len(first) - 1, 2 * groups), dtype=np.uint64)
    full = np.flatnonzero(first[1:] > first[:-1])
    # Texts are taken in runs whose hashes fit the processor's cache.
    runs = np.flatnonzero(np.diff(first[full] >> 15)) + 1
    for run in np.split(full, runs):
        if not len(run):
            continue
        lo = first[run[0]]
        own, begins = hashes[lo : first[run[-1] + 1]], first[run] - lo
        for g in range(2 * groups):
            value = np.zeros(len(run), dtype=np.uint64)
            for r in range(rows):
                least = np.minimum.reduceat(wh.mix(own, 100 + g * rows + r), begins)
                value = wh.mix(value * np.uint64(31) + least, r)
            out[run, g] = value
    return out


def _fingerprints(hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two sums over each set; equal sets have equal sums whatever the order of words."""
    out = []
    for seed in (11, 12):
        total = np.append(np.uint64(0), np.cumsum(wh.mix(hashes, seed), dtype=np.uint64))
        out.append((total[first[1:]] - total[first[:-1]]).view(np.int64))
    return out[0], out[1]


def _signatures(settings: Settings):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch):
                hashes, first = shingle_sets(part.column("text"), settings.shingle)
                keys = _collections(hashes, first, settings.groups, settings.rows).view(np.int64)
                one, two = _fingerprints(hashes, first)
                halves = [
                    pa.FixedSizeListArray.from_arrays(pa.array(np.ascontiguousarray(h).reshape(-1)), settings.groups).cast(pa.list_(pa.int64()))
                    for h in np.split(keys, 2, axis=1)
                ]
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array(np.diff(first)), pa.array(one), pa.array(two), *halves],
                    ["id", "n", "f1", "f2", "a", "b"],
                )

    return run


def _full_sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch):
                hashes, first = shingle_sets(part.column("text"), width)
                listed = pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(hashes.view(np.int64)))
                yield pa.RecordBatch.from_arrays([part.column("id"), listed], ["id", "shingles"])

    return run


def _pairs(left: Column, right: Column) -> list[Column]:
    return [F.least(left, right).alias("a"), F.greatest(left, right).alias("b")]


class _Search:
    """Candidate pairs of classes, checked in rounds until every group is settled."""

    def __init__(self, docs: DataFrame, classes: DataFrame, settings: Settings):
        self.settings = settings
        self.sizes = classes.select("id", "n")
        g = settings.groups
        keys = F.flatten(
            F.transform(
                F.sequence(F.lit(0), F.lit(g - 1)),
                lambda i: F.transform(
                    F.col("b"), lambda y, j: F.xxhash64(i * g + j, F.get("a", i), y)
                ),
            )
        )
        members = classes.select(F.col("id").alias("member"), F.explode(keys).alias("key"))
        # Keys of a single class end here; a hot key is combined per task.
        shared = members.groupBy("key").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
        found = store(members.join(shared.select("key"), "key"))
        wanted = found.select(F.col("member").alias("id")).distinct()
        with small_batches(docs.sparkSession):
            self.sets = store(
                docs.join(wanted, "id", "left_semi").mapInArrow(
                    _full_sets(settings.shingle), "id long, shingles array<long>"
                )
            )
        self.groups = self._able(found)

    def _able(self, found: DataFrame) -> DataFrame:
        """Members that may have a link, by the leader of a key of theirs: (leader, m, r, member, n, s).

        ``s`` counts the shingles of a member that some other class with a shared key has too.
        A pair can share no more than the lesser ``s`` of the two, and its sets together are no
        smaller than the sizes less that. Members too far from the smallest set of their key
        under this bound go, which loses no link. The leader of a key is the member with the
        largest share of ``s``: of edited copies, the one nearest to all others, and so mostly
        the same in all their keys. Keys with one leader then count as one group, in which
        all pairs that share a key are found. ``m`` and ``r`` are the leader's size and ``s``.
        """
        percent = self.settings.percent
        single = (
            self.sets.select("id", F.explode("shingles").alias("g"))
            .groupBy("g")
            .agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("c"))
            .where("c = 1")
            .groupBy("id")
            .agg(F.count(F.lit(1)).alias("u"))
        )
        able = store(
            self.sizes.join(single, "id", "left")
            .select(
                F.col("id").alias("member"), "n",
                (F.col("n") - F.coalesce("u", F.lit(0))).alias("s"),
            )
            .where(F.col("s") * 100 >= F.col("n") * percent)
        )
        rows = found.join(able, "member")
        lows = rows.groupBy("key").agg(F.min("n").alias("low"), F.count(F.lit(1)).alias("c")).where("c > 1")
        near = store(
            rows.join(lows.select("key", "low"), "key")
            .where(F.col("s") * (100 + percent) >= (F.col("n") + F.col("low")) * percent)
            .drop("low")
        )
        rank = F.struct(
            (F.col("s") / F.col("n")).alias("share"), (-F.col("member")).alias("id"), "n", "s"
        )
        leaders = near.groupBy("key").agg(F.max(rank).alias("best"), F.count(F.lit(1)).alias("c"))
        leaders = leaders.where("c > 1").select(
            "key", (-F.col("best.id")).alias("leader"), F.col("best.n").alias("m"), F.col("best.s").alias("r")
        )
        return store(
            near.join(leaders, "key")
            .where("member <> leader")
            .select("leader", "m", "r", "member", "n", "s")
            .distinct()
        )

    def first_pairs(self) -> DataFrame:
        """Every member with its leaders."""
        return self.groups.where(self._may()).select(*_pairs(F.col("leader"), F.col("member"))).distinct()

    def _may(self) -> Column:
        """Can sets of sizes n and m with s and r shared shingles be similar enough?"""
        most = F.least("s", "r")
        return most * 100 >= (F.col("n") + F.col("m") - most) * self.settings.percent

    def verified(self, pairs: DataFrame) -> DataFrame:
        """Pairs (a, b) whose full sets are similar enough."""
        left = self.sets.select(F.col("id").alias("a"), F.col("shingles").alias("sa"))
        right = self.sets.select(F.col("id").alias("b"), F.col("shingles").alias("sb"))
        met = pairs.select("a", "b").join(right, "b").join(left, "a")
        common = F.size(F.array_intersect("sa", "sb")).cast("long")
        union = F.size("sa") + F.size("sb") - common
        return met.where(common * 100 >= union * self.settings.percent).select("a", "b")

    def _still_open(self, members: DataFrame, labels: DataFrame) -> DataFrame:
        """Members (key, member, ...) of groups that hold two components: with ``label`` and ``still``.

        ``still`` is the component with most members of the group.
        """
        labelled = members.join(labels.toDF("member", "label"), "member", "left").withColumn(
            "label", F.coalesce("label", "member")
        )
        shares = labelled.groupBy("key", "label").agg(F.count(F.lit(1)).alias("c"))
        still = (
            shares.groupBy("key")
            .agg(F.max(F.struct("c", "label")).alias("most"), F.count(F.lit(1)).alias("k"))
            .where("k > 1")
            .select("key", F.col("most.label").alias("still"))
        )
        return labelled.join(still, "key")

    def _overlap(self, sizes: Column) -> Column:
        """Shingles that two sets of so many together must share to be linked."""
        percent = self.settings.percent
        return F.ceil(sizes * percent / F.lit(float(100 + percent)) - 1e-6)

    def measured(self, labels: DataFrame) -> DataFrame:
        """Members of open groups against their leader: (key, member, n, s, label, k, extras, low).

        ``k`` shingles are the leader's too, ``extras`` are not; ``low`` is the size of the group's
        smallest set. Pairs with the leader are done, so the leader, which names the group, is
        left out.
        """
        members = self.groups.select(F.col("leader").alias("key"), "member", "n", "s")
        opened = store(self._still_open(members, labels).drop("still"))
        lows = opened.groupBy("key").agg(F.min("n").alias("low"))
        own = self.sets.select(F.col("id").alias("member"), F.col("shingles").alias("own"))
        leading = self.sets.select(F.col("id").alias("key"), F.col("shingles").alias("leading"))
        extras = F.array_except("own", "leading")
        return store(
            opened.join(lows, "key").join(own, "member").join(leading, "key")
            .select("key", "member", "n", "s", "label", "low", extras.alias("extras"))
            .withColumn("k", F.col("n") - F.size("extras"))
        )

    def extra_pairs(self, measured: DataFrame) -> DataFrame:
        """Pairs of a group that may be linked only if they share some of their extras.

        Two sets share no more of the leader's shingles than the lesser ``k``; what is missing to
        the overlap they need, they must share outside of the leader's set. Extras that are found
        once in the group go. Of the rest, the rarest first, a set is looked up by so many that
        two sets with enough in common meet in one of them; that loses no link. Copies of a text
        whose edits differ have few extras in common, however many they are.
        """
        own = self._overlap(F.col("n") + F.col("low")) - F.col("k")
        wide = measured.withColumn("need", F.greatest(own, F.lit(1))).where(F.size("extras") >= F.col("need"))
        wide = store(wide.select("key", "member", "n", "k", "label", "need", F.explode("extras").alias("g")))
        shared = wide.groupBy("key", "g").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
        member = Window.partitionBy("key", "member")
        kept = (
            wide.join(shared, ["key", "g"])
            .withColumn("e", F.count(F.lit(1)).over(member))
            .withColumn("turn", F.row_number().over(member.orderBy("c", "g")))
            .where(F.col("turn") <= F.col("e") - F.col("need") + 1)
        )
        kept = store(kept.select("key", "g", "member", "n", "k", "label", "e"))
        one, two = (kept.select("key", "g", *[F.col(c).alias(c + x) for c in ("member", "n", "k", "label", "e")]) for x in "12")
        missing = self._overlap(F.col("n1") + F.col("n2")) - F.least("k1", "k2")
        met = one.join(two, ["key", "g"]).where(
            (F.col("member1") < F.col("member2")) & (F.col("label1") != F.col("label2"))
            & (F.least("e1", "e2") >= missing)
        )
        return met.select(F.col("member1").alias("a"), F.col("member2").alias("b")).distinct()

    def later_pairs(
        self, opened: DataFrame, width: int, central: bool
    ) -> tuple[DataFrame, bool]:
        """Pairs of open members that may be linked without extras, and whether these are all.

        Both then have enough of the leader's shingles, though neither need be linked to it: they
        are smaller. The component with most members in a group keeps still; up to ``width``
        others, those that share most first, are held against all members of other components. A
        ``central`` round holds the ``width`` members that share most, whatever their component,
        against the rest.
        """
        turn = F.row_number().over(Window.partitionBy("key").orderBy(F.desc("s"), "member"))
        rest = opened if central else opened.where("label <> still")
        tried = rest.withColumn("turn", turn).where(F.col("turn") <= width).select(
            "key", F.col("member").alias("other"), F.col("n").alias("m"), F.col("s").alias("r"),
            F.col("k").alias("j"), F.col("label").alias("other_label"),
        )
        enough = self._overlap(F.col("n") + F.col("m")) <= F.least("k", "j")
        found = opened.join(tried, "key").where((F.col("label") != F.col("other_label")) & self._may() & enough)
        pairs = found.select(*_pairs(F.col("other"), F.col("member"))).distinct()
        if central:
            return pairs, False
        others = rest.groupBy("key").agg(F.count(F.lit(1)).alias("c"))
        return pairs, (others.agg(F.max("c")).first()[0] or 0) <= width

    def labels(self) -> DataFrame:
        """Component of every class that has a link: (id, label)."""
        seen = store(self.first_pairs(), narrow=True)
        labels = components(self.verified(seen))
        measured = self.measured(labels)
        if measured.isEmpty():
            return labels
        near = store(
            measured.where(self._overlap(F.col("n") + F.col("low")) <= F.col("k")).select("key", "member", "n", "s", "k")
        )
        width, central, last = 4, True, False
        pairs = self.extra_pairs(measured)
        while True:
            fresh = store(pairs.join(seen, ["a", "b"], "left_anti"), narrow=True)
            more = store(self.verified(fresh))
            if not more.isEmpty():
                # An id and its label are linked; new links join such stars.
                labels = components(labels.toDF("a", "b").unionByName(more))
            opened = store(self._still_open(near, labels), narrow=True)
            if last or opened.isEmpty():
                return labels
            seen = store(seen.unionByName(fresh))
            pairs, last = self.later_pairs(opened, width, central)
            width, central = (width, False) if central else (width * 8, False)


def near_groups(
    docs: DataFrame,
    settings: Settings = Settings(),
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Class and component of every row: (id, n_shingles, class_id, component_id, kept).

    Words are runs of characters other than white space, with A-Z lower-cased. Rows with equal
    shingle sets form a class, named by its least id, so a large group of copies enters the
    search once. Classes that share a key of some table meet the key's most central class.
    Whatever is then not connected although it shares a key is compared by what it has beyond
    that class: only pairs that an exact bound on shared shingles rules out are left out. Every
    link is confirmed on the two full sets.
    ``component_id`` is the least id reachable over links; ``kept`` marks it.

    A null or blank text has an empty set and no links, neither has a row without id (its
    component is null, and it is kept); rows sharing an id count as one; an empty table gives
    an empty result.
    """
    ship_package(docs.sparkSession)
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )
    with small_batches(docs.sparkSession):
        signed = store(
            rows.mapInArrow(
                _signatures(settings), "id long, n long, f1 long, f2 long, a array<long>, b array<long>"
            )
        )
    full = signed.where("n > 0 and id is not null")
    print_ = ["n", "f1", "f2"]
    classes = store(
        full.groupBy(*print_).agg(F.min(F.struct("id", "a", "b")).alias("r")).select(
            *print_, "r.id", "r.a", "r.b"
        )
    )
    labels = _Search(rows, classes.select("id", "n", "a", "b"), settings).labels()
    named = classes.select(*print_, F.col("id").alias("class_id")).join(
        labels.withColumnRenamed("id", "class_id"), "class_id", "left"
    ).select(*print_, "class_id", F.coalesce("label", "class_id").alias("label"))
    found = full.select("id", *print_).join(named, print_).select("id", "n", "class_id", "label")
    alone = signed.where("n = 0 or id is null").select(
        "id", "n", F.col("id").alias("class_id"), F.col("id").alias("label")
    )
    return found.unionByName(alone).select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "class_id",
        F.col("label").alias("component_id"), F.col("id").eqNullSafe(F.col("label")).alias("kept"),
    )


def keep_one(
    docs: DataFrame, settings: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Rows of ``docs`` without near-duplicates, all columns kept; the least id of a component stays."""
    gone = store(
        near_groups(docs, settings, id_col, text_col).where("not kept").select(F.col(id_col).alias("_gone"))
    )
    return docs.join(gone, F.col(id_col) == F.col("_gone"), "left_anti")

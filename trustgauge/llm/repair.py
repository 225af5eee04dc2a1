"""Repair of conversations: the cheapest edits that make roles alternate, by branch and bound."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trustgauge.llm.common import BLANKS, store
from trustgauge.sources.shipping import ship_package

# Costs of the edits, and of a truncated row that stays.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
# Rows of one conversation that are searched at a time: 2 to the power of this.
BLOCK_BITS = 10

# What the last kept row is: none yet, system, user, assistant. The only role that may follow.
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
ROLES = {USER: "user", ASSISTANT: "assistant"}
ENDS = (START, ASSISTANT)
# A row's code: its role's initial, in capitals if truncated; a digit if it has to go.
CODES = {"s": "sS1", "u": "uU2", "a": "aA3", "x": "xX0"}
ROLE_OF = {code: role for role, codes in CODES.items() for code in codes}
KEPT_AS = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()

_SCRIPTS = "key string, block long, alone boolean, illegal long, entry int, exit int, cost long, audit string"
ROWS = "key string, place long, edit string, role string, text string"
FLUSH_BYTES = 4 << 20


def _edits(code: str, kind: int) -> list[tuple[int, str, int]]:
    """What may be done with a row after a kept row of some kind: (cost, edit, kind then)."""
    found = [(DELETE, "D", kind)]
    if not code.isdigit():
        own, stays = KEPT_AS.get(code.lower()), TRUNCATED if code.isupper() else 0
        if own == NEXT[kind] or (own == SYSTEM and kind == START):
            found.append((stays, "K", own))
        if own != NEXT[kind]:
            found.append((stays + REROLE, "R", NEXT[kind]))
    return found


EDITS = {(code, kind): _edits(code, kind) for code in ROLE_OF for kind in range(4)}


def suffix_bounds(codes: str, ends: tuple[int, ...], closing: bool) -> list[list[float]]:
    """Least cost of all that follows, by rows done and last kept kind; from the end backwards.

    Ties are left open: a bound tells what must still be paid, not by which edits.
    """
    bounds: list[list[float]] = [[0.0 if kind in ends else math.inf for kind in range(4)]]
    for i in range(len(codes), -1, -1):
        if i < len(codes):
            after = bounds[-1]
            bounds.append([min(fee + after[to] for fee, _, to in EDITS[codes[i], kind]) for kind in range(4)])
        if i < len(codes) or closing:
            # Inserted rows come back to the same kind after two.
            own = bounds[-1]
            once = [min(own[kind], INSERT + own[NEXT[kind]]) for kind in range(4)]
            bounds[-1] = [min(own[kind], INSERT + once[NEXT[kind]]) for kind in range(4)]
    bounds.reverse()
    return bounds


def search(codes: str, entry: int, ends: tuple[int, ...], closing: bool, bounds=None) -> tuple[int, str] | None:
    """Cost and audit of the cheapest edits of a run of rows, the least audit among equals.

    The run starts after a row of kind ``entry`` and has to end in one of ``ends``; a
    ``closing`` run may insert after its last row. Depth first over an explicit stack, the most
    promising edit on top, the lesser initial on a tie. A node is a number of rows done and the
    last kept kind. A prefix is dropped when its cost and its suffix bound exceed the
    incumbent's cost, or equal it while its audit exceeds the incumbent's; or when its node has been
    reached with a lower (cost, audit): both prefixes have the same continuations, and of two
    equally dear ones neither begins with the other. The incumbent is proved when the stack is
    empty. None if no edits reach ``ends``.
    """
    size = len(codes)
    bounds = bounds or suffix_bounds(codes, ends, closing)
    incumbent: tuple[int, str] | None = None
    reached: dict[tuple[int, int], tuple[int, str]] = {}
    stack = [(0, entry, 0, "")] if bounds[0][entry] < math.inf else []
    while stack:
        i, kind, cost, audit = stack.pop()
        known = reached.get((i, kind))
        if known is not None and known <= (cost, audit):
            continue
        if incumbent and (cost + bounds[i][kind], audit) > (incumbent[0], incumbent[1][: len(audit)]):
            continue
        reached[i, kind] = cost, audit
        if i == size and kind in ends and (incumbent is None or (cost, audit) < incumbent):
            incumbent = cost, audit
        moves = []
        if i < size or closing:
            moves.append((cost + INSERT + bounds[i][NEXT[kind]], "I", i, NEXT[kind], cost + INSERT))
        if i < size:
            moves += [
                (cost + fee + bounds[i + 1][to], edit, i + 1, to, cost + fee)
                for fee, edit, to in EDITS[codes[i], kind]
            ]
        for least, edit, row, to, paid in sorted(moves, reverse=True):
            if least < math.inf:
                stack.append((row, to, paid, audit + edit))
    return incumbent


def _illegal(codes: str) -> int:
    roles = "".join(ROLE_OF[c] for c in codes)
    return sum(roles[k : k + 2] not in ("su", "ua", "au") for k in range(len(roles) - 1))


def _searches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Best edits of every block by the kinds it may start after and end in."""
    names = [c.split()[0] for c in _SCRIPTS.split(", ")]
    kinds = [pa.string(), pa.int64(), pa.bool_(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.string()]
    for batch in batches:
        rows = []
        for r in batch.to_pylist():
            illegal, alone = _illegal(r["before"] + r["codes"]), r["first"] and r["last"]
            for ends in (ENDS,) if r["last"] else [(k,) for k in range(4)]:
                bounds = suffix_bounds(r["codes"], ends, r["last"])
                for entry in (START,) if r["first"] else range(4):
                    best = search(r["codes"], entry, ends, r["last"], bounds)
                    if best:
                        rows.append((r["key"], r["block"], alone, illegal, entry, ends[-1], *best))
        columns = list(zip(*rows, strict=True)) if rows else [()] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def _joined(chain) -> str:
    parts = []
    while chain:
        row, chain = chain
        parts.append(row["audit"])
    return "".join(parts)


def _less(one, two) -> bool:
    """Is the audit of chain ``one`` less? Mostly their first blocks tell."""
    a, b = one[0]["audit"], two[0]["audit"]
    if a.startswith(b) or b.startswith(a):
        a, b = _joined(one), _joined(two)
    return a < b


def _chain(table: pa.Table) -> pa.Table:
    """The best chain of one conversation's blocks, from its end backwards."""
    blocks: dict[int, list[dict]] = {}
    for r in table.to_pylist():
        blocks.setdefault(r["block"], []).append(r)
    after: dict[int, tuple] = {end: (0, None) for end in range(4)}
    for k in sorted(blocks, reverse=True):
        found: dict[int, tuple] = {}
        for r in blocks[k]:
            if r["exit"] in after:
                cost, rest = after[r["exit"]]
                cost, chain = r["cost"] + cost, (r, rest)
                best = found.get(r["entry"])
                if best is None or cost < best[0] or (cost == best[0] and _less(chain, best[1])):
                    found[r["entry"]] = cost, chain
        after = found
    rows, chain = [], after[START][1]
    while chain:
        row, chain = chain
        rows.append(row)
    return pa.Table.from_pylist(rows, schema=table.schema)


def faults(rows: DataFrame) -> DataFrame:
    """Rows with their first fault and their code: (key, pos, turn, role, digest, fault, code).

    ``rows`` has (key, pos, turn, role, text, digest). A row is blank without a character other
    than white space, duplicate if its role and text came before in the conversation,
    truncated if it does not end in a full stop, an exclamation or a question mark.
    """
    bare = F.rtrim("text", F.lit(BLANKS))
    narrow = store(
        rows.select(
            "key", "pos", "turn", "role", "digest", (bare == "").alias("blank"),
            (~F.substring(bare, -1, 1).isin(".", "!", "?")).alias("cut"),
        )
    )
    same = ["key", "role", "digest"]
    firsts = narrow.where("not blank").groupBy(*same).agg(
        F.min("pos").alias("first"), F.count(F.lit(1)).alias("c")
    )
    repeated = store(firsts.where("c > 1").drop("c"))
    initial = F.substring("role", 1, 1)
    role = F.when(initial.isin("s", "u", "a"), initial).otherwise("x")
    gone = F.col("fault").isin("blank", "duplicate")
    fault = (
        F.when(F.col("blank"), "blank").when(F.col("pos") > F.col("first"), "duplicate").when(F.col("cut"), "truncated")
    )
    code = F.when(gone, F.translate(role, "suax", "1230")).when(F.col("cut"), F.upper(role)).otherwise(role)
    return (
        narrow.join(repeated, same, "left")
        .withColumn("fault", fault)
        .withColumn("code", F.when(F.col("fault").isNull(), role).otherwise(code))
        .select("key", "pos", "turn", "fault", "code")
    )


def placed(rows: DataFrame) -> DataFrame:
    """Rows in order of (conversation, turn): (key, pos, turn, role, text, digest), written once.

    The order is cut by range, so a conversation with a third of all rows spans many parts;
    ``pos`` rises through all of them and counts up by one within a part.
    """
    full = rows.withColumn("digest", F.sha2("text", 256))
    order = [F.col("key"), F.asc_nulls_first("turn"), F.col("role"), F.col("digest")]
    ordered = full.repartitionByRange(*order).sortWithinPartitions(*order)
    return store(
        ordered.withColumn("pos", F.monotonically_increasing_id()).select(
            "key", "pos", "turn", "role", "text", "digest"
        )
    )


def scripts_of(coded: DataFrame) -> DataFrame:
    """The chosen edits of every block of rows: (key, block, alone, illegal, entry, exit, cost, audit).

    Blocks hold up to 2^BLOCK_BITS rows of a conversation and are searched apart from each other.
    The blocks of a longer conversation are searched for each kind of row they may follow and
    end in, and chained from the end: of its rows, no more than sixteen bytes each meet there,
    where the audit that is asked for has one.
    """
    listed = F.sort_array(F.collect_list(F.struct("pos", "code")))
    blocks = (
        coded.groupBy("key", F.shiftright("pos", BLOCK_BITS).alias("block"))
        .agg(listed.alias("rows"))
        .select("key", "block", F.array_join(F.col("rows")["code"], "").alias("codes"))
    )
    own = Window.partitionBy("key").orderBy("block")
    told = blocks.select(
        "key", "block", "codes",
        F.coalesce(F.lag(F.substring("codes", -1, 1)).over(own), F.lit("")).alias("before"),
        F.lag("block").over(own).isNull().alias("first"),
        F.lead("block").over(own).isNull().alias("last"),
    )
    found = store(told.mapInArrow(_searches, _SCRIPTS))
    chained = found.where("not alone").groupBy("key").applyInArrow(_chain, _SCRIPTS)
    return store(found.where("alone").unionByName(chained))


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(key, place, edit, role, text) in order, from blocks that begin with their script.

    Only one batch and one script are held.
    """
    key, audit, done, kind, place = None, "", 0, START, 0

    def inserts():
        nonlocal done, kind, place
        while done < len(audit) and audit[done] == "I":
            done, kind, place = done + 1, NEXT[kind], place + 1
            yield key, place, "I", ROLES[kind], ""

    names = ["key", "block", "entry", "audit", "role", "text"]
    for batch in batches:
        for own, block, entry, script, role, text in zip(*(batch.column(c).to_pylist() for c in names), strict=True):
            yield from inserts()
            if script is not None:
                # A block's edits leave at most its rows and as many inserted ones, and two more.
                key, audit, done, kind, place = own, script, 0, entry, block << (BLOCK_BITS + 2)
                continue
            edit, done = audit[done], done + 1
            if edit == "D":
                continue
            kind = SYSTEM if edit == "K" and kind == START and role[:1] == "s" else NEXT[kind]
            place += 1
            yield key, place, edit, role if edit == "K" else ROLES[kind], text
    yield from inserts()


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in ROWS.split(", ")]
    kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string()]

    def flushed(rows):
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names
        )

    held, size = [], 0
    for row in _edited(batches):
        held.append(row)
        size += len(row[-1]) + 100
        if size >= FLUSH_BYTES:
            yield flushed(held)
            held, size = [], 0
    if held:
        yield flushed(held)


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    last, running = None, None
    keys, sums = [], []
    for key, _, _, role, text in _edited(batches):
        if key != last:
            if running:
                keys.append(last)
                sums.append(running.hexdigest())
            last, running = key, hashlib.sha256()
        else:
            running.update(b"\n")
        running.update(f"{role}:{text}".encode())
        if len(keys) == 10_000:
            yield pa.RecordBatch.from_pydict({"key": keys, "sha256": sums})
            keys, sums = [], []
    if running:
        keys.append(last)
        sums.append(running.hexdigest())
    yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(sums, pa.string())], ["key", "sha256"])


class Repair:
    """Repaired conversations: a report, the rows, and a digest of the rows.

    ``rows`` has a conversation, a turn, a role and a text. Rows are taken by turn, nulls first,
    then by role and by the digest of the text. A null conversation, role or text is one
    space, so rows without a conversation form one. Each row's first fault counts: blank,
    duplicate, truncated. The edits of a conversation are the cheapest that leave an optional
    system row and then user and assistant rows in turn, or nothing: keep a row, give it
    another role, delete it (which blank and duplicate rows need), insert an empty row. Among
    equally dear ones, the least audit, the edits' initials in order, is taken. Equal rows are
    duplicates of the first of them; an empty table gives empty results; other columns are
    not read.

    Rows are put in order by a cut into ranges, which parts a long conversation, searched by
    blocks of rows and dealt by block again to be edited. Only the digest, which is one sum over a
    whole conversation, is taken by one task from start to end, holding one batch.
    """

    def __init__(
        self,
        rows: DataFrame,
        conv_col: str = "conv_id",
        turn_col: str = "turn",
        role_col: str = "role",
        text_col: str = "text",
    ):
        ship_package(rows.sparkSession)
        self.conv_col, self.conv_type = conv_col, rows.schema[conv_col].dataType
        self.rows = placed(
            rows.select(
                key_of(conv_col).alias("key"),
                F.col(turn_col).alias("turn"),
                *[
                    F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(name)
                    for c, name in ((role_col, "role"), (text_col, "text"))
                ],
            )
        )
        self.coded = store(faults(self.rows))
        self.scripts = scripts_of(self.coded)

    def report(self) -> DataFrame:
        """(key, gaps, blank, duplicate, truncated, illegal, cost, audit) of every conversation."""
        counts = [
            F.count_if(F.col("fault") == name).alias(name) for name in ("blank", "duplicate", "truncated")
        ]
        missing = F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")
        found = self.coded.groupBy("key").agg(
            F.coalesce(missing.cast("long"), F.lit(0).cast("long")).alias("gaps"), *counts
        )
        audit = F.sort_array(F.collect_list(F.struct("block", "audit")))["audit"]
        edits = self.scripts.groupBy("key").agg(
            F.sum("illegal").alias("illegal"), F.sum("cost").alias("cost"), F.array_join(audit, "").alias("audit")
        )
        return found.join(edits, "key")

    def repaired(self) -> DataFrame:
        """(key, place, edit, role, text) of every row that is left, ordered by ``place``."""
        return self._blocks("key", "block").mapInArrow(_rows, ROWS)

    def digests(self) -> DataFrame:
        """(key, sha256) of ``role:text`` lines, of conversations with a row left."""
        return self._blocks("key").mapInArrow(_hashes, "key string, sha256 string")

    def _blocks(self, *spread: str) -> DataFrame:
        """Rows by conversation and block, after the script of their block."""
        none = F.lit(None)
        scripts = self.scripts.select(
            "key", "block", F.lit(-1).cast("long").alias("pos"), "entry", "audit",
            none.cast("string").alias("role"), none.cast("string").alias("text"),
        )
        rows = self.rows.select(
            "key", F.shiftright("pos", BLOCK_BITS).alias("block"), "pos", none.cast("int").alias("entry"),
            none.cast("string").alias("audit"), "role", "text",
        )
        return scripts.unionByName(rows).repartition(*spread).sortWithinPartitions("key", "block", "pos")


def key_of(conv_col: str) -> Column:
    return F.coalesce(F.col(conv_col).cast("string"), F.lit(" "))


def damaged(conversations: DataFrame) -> DataFrame:
    """Conversations with faults put in by crc32(`conv_id:turn`) % 20, for tests of the repair.

    0 drops a row, 1 empties its text, 2 removes full stops, exclamation and question marks, 3
    repeats it, 4 makes its role user. A null is one space.
    """
    space = F.lit(" ")
    key = F.concat(key_of("conv_id"), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    hit, text = F.col("hit"), F.col("text")
    return (
        conversations.select(
            "conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"),
            (F.crc32(key.cast("binary")) % 20).alias("hit"),
        )
        .where(hit != 0)
        .select(
            "conv_id", "turn", F.when(hit == 4, "user").otherwise(F.col("role")).alias("role"),
            F.when(hit == 1, "").when(hit == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
            F.explode(F.when(hit == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
        )
        .drop("copy")
    )

"""Conversation repair against an exhaustive search, in blocks, and over edge cases."""

from __future__ import annotations

import hashlib
import random
import re

import pytest

from trustgauge.llm import repair
from trustgauge.llm.repair import Repair, search

PATTERN = re.compile(r"(s?(ua)+)?\Z")


def exhaustive(codes):
    """Least (cost, audit) over all edits that give a right order, kept rows first to last."""
    best = {(0, ""): (0, "")}  # (rows done, roles so far) -> (cost, audit)
    done = None
    for i in range(len(codes) + 1):
        layer = {roles: v for (k, roles), v in best.items() if k == i}
        for _ in range(2):
            for roles, (cost, audit) in list(layer.items()):
                for role in "ua":
                    new = roles + role
                    if re.fullmatch(r"s?(ua)*u?", new):
                        layer[new] = min(layer.get(new, (10**9, "")), (cost + 5, audit + "I"))
        if i == len(codes):
            done = min(v for roles, v in layer.items() if PATTERN.match(roles))
            break
        code = codes[i]
        for roles, (cost, audit) in layer.items():
            moves = [(roles, 2, "D")]
            if not code.isdigit():
                more = 5 if code.isupper() else 0
                own = code.lower()
                moves += [(roles + own, more, "K")] if own != "x" else []
                moves += [(roles + r, more + 1, "R") for r in "ua" if r != own]
            for new, fee, edit in moves:
                if re.fullmatch(r"s?(ua)*u?", new):
                    at = (i + 1, new)
                    best[at] = min(best.get(at, (10**9, "")), (cost + fee, audit + edit))
    return done


@pytest.mark.parametrize("seed", range(150))
def test_search_is_exhaustive(seed):
    rng = random.Random(seed)
    codes = "".join(rng.choice(["suax", "suaxSUAX1230", "uuuaUA1"][seed % 3]) for _ in range(rng.randint(0, 9)))
    assert search(codes, repair.START, repair.ENDS, True) == exhaustive(codes)


@pytest.mark.parametrize("codes", ["u" * 1024, "x" * 1024, "a" * 1023, "UA" * 512, "s" * 1024, "ssuu" * 256, "1" * 1024])
def test_long_runs_are_searched_quickly(codes):
    found = {
        end: search(codes, entry, (end,), False) for entry in range(4) for end in range(4)
    }
    assert found[repair.ASSISTANT][0] >= 0


def python_repair(rows):
    """The whole operator for the rows of one conversation, by plain loops."""
    rows = sorted(
        ((t is not None, t or 0, " " if r is None else r, " " if x is None else x) for t, r, x in rows),
        key=lambda v: (v[0], v[1], v[2].encode(), hashlib.sha256(v[3].encode()).hexdigest()),
    )
    seen, codes, faults = set(), "", []
    for _, _, role, text in rows:
        bare = text.rstrip(" \t\n\x0b\x0c\r")
        own = role[:1] if role[:1] in ("s", "u", "a") else "x"
        fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else ""
        seen.add((role, text))
        faults.append(fault)
        codes += dict(zip("suax", "1230"))[own] if fault in ("blank", "duplicate") else own.upper() if fault else own
    cost, audit = search(codes, repair.START, repair.ENDS, True)
    lines, k, last = [], 0, ""
    for edit in audit:
        want = "assistant" if last == "u" else "user"
        if edit == "I":
            lines.append(f"{want}:")
            last = want[0]
            continue
        _, _, role, text = rows[k]
        k += 1
        if edit != "D":
            role = role if edit == "K" else want
            lines.append(f"{role}:{text}")
            last = role[0]
    turns = [t for there, t, _, _ in rows if there]
    initials = [r[:1] for _, _, r, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    counts = [faults.count(n) for n in ("blank", "duplicate", "truncated")]
    return (gaps, *counts, illegal, cost, audit), lines


def conversations(seed, long):
    rng = random.Random(seed)
    texts = ["Yes.", "No!", "Why?", "cut", " ", "", None, "Ok. \n", "Ünd so.", "a:b\nc."]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None, "User"]
    sizes = {None: 5, 0: long, 1: 1} | {c: rng.randint(1, 12) for c in range(2, 40)}
    return {
        c: [
            (rng.choice([None, k, k, k, k + 3]), rng.choice(roles), f"{rng.choice(texts)}" + (f"{k}." if k % 3 else ""))
            if k % 7 else (k, rng.choice(roles), rng.choice(texts))
            for k in range(n)
        ]
        for c, n in sizes.items()
    }


@pytest.mark.parametrize(("bits", "long"), [(10, 300), (2, 90)])
def test_repair_by_plain_loops(spark, monkeypatch, bits, long):
    """With blocks of four rows nearly every conversation is chained from several."""
    monkeypatch.setattr(repair, "BLOCK_BITS", bits)
    given = conversations(bits, long)
    rows = [(c, t, r, x, "clash", 1) for c, own in given.items() for t, r, x in own]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, key string, pos int")
    done = Repair(df)
    report = {r["key"]: tuple(r)[1:] for r in done.report().collect()}
    lines = {}
    for r in sorted(done.repaired().collect(), key=lambda r: (r["key"], r["place"])):
        lines.setdefault(r["key"], []).append(f"{r['role']}:{r['text']}")
    digests = {r["key"]: r["sha256"] for r in done.digests().collect()}
    for c, own in given.items():
        key = " " if c is None else str(c)
        expected, text = python_repair(own)
        assert report.pop(key) == expected
        assert lines.get(key, []) == text
        assert digests.get(key, repair.EMPTY_SHA256) == hashlib.sha256("\n".join(text).encode()).hexdigest()
        assert PATTERN.match("".join(t[0] for t in text))
    assert not report


def test_empty_table_and_a_long_text(spark):
    schema = "conv_id long, turn long, role string, text string"
    done = Repair(spark.createDataFrame([], schema))
    assert done.report().count() == done.repaired().count() == done.digests().count() == 0
    whole = [(1, 0, "user", "word " * 400_000 + "."), (1, 1, "assistant", "Yes.")]
    done = Repair(spark.createDataFrame(whole, schema))
    assert done.report().first()["audit"] == "KK"


def test_damage(spark):
    rows = [(c, t, "system", "A. b!") for c in range(40) for t in (0, 1, None)]
    df = spark.createDataFrame([*rows, (None, None, None, None)], "conv_id long, turn long, role string, text string")
    import zlib

    expected = []
    for c, t, r, x in [*rows, (None, None, " ", " ")]:
        hit = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        if hit == 0:
            continue
        row = (c, t, "user" if hit == 4 else r, "" if hit == 1 else x.replace(".", "").replace("!", "") if hit == 2 else x)
        expected += [row] * (2 if hit == 3 else 1)
    assert sorted(map(repr, map(tuple, repair.damaged(df).collect()))) == sorted(map(repr, expected))

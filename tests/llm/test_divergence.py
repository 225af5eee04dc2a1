"""Source divergence audit by brute force, over edge cases and small blocks."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import pytest

from trustgauge.llm import divergence


def brute(rows, s):
    counts, docs, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        groups[lang].add(source)
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lowered)
        counts[lang, source].update(terms)
        docs[lang].update(set(terms))
    out = set()
    for lang, sources in groups.items():
        kept = [t for t, n in docs[lang].items() if n >= s.min_docs]
        every = Counter()
        for source in sources:
            every.update(counts[lang, source])

        def shares(count):
            total = sum(count[t] for t in kept) + s.smoothing * len(kept)
            return {t: 1 + s.scale * (count[t] + s.smoothing) // total for t in kept}

        p = {source: shares(counts[lang, source]) for source in sources}
        q = shares(every)
        for a in sources:
            far = [(-sum(abs(p[a][t] - p[b][t]) for t in kept), b.encode(), b) for b in sources if b != a]
            out |= {(lang, a, "pair", b, -v, k + 1) for k, (v, _, b) in enumerate(sorted(far))}
            own = [(q[t] - p[a][t], t.encode(), t) for t in kept if counts[lang, a][t] and p[a][t] > q[t]]
            out |= {(lang, a, "term", t, -v, k + 1) for k, (v, _, t) in enumerate(sorted(own)[: s.top])}
    return out


WORDS = "alpha Beta gamma été Ωmega ΩMEGA 中文 delta's x1y a-b zz".split()


def corpus(n):
    rows = [
        (["en", "fr", None][i % 3], ["s1", "s2", "", None, "s3"][i % 5], " ".join(WORDS[(i * k) % 11] for k in range(i % 17)))
        for i in range(n)
    ]
    return rows + [("de", "s1", "only once"), ("de", "s2", None), ("it", "s1", ""), ("en", "hot", "alpha " * 5000)]


@pytest.mark.parametrize(("held", "bucket", "block"), [(200_000, 200_000, 256), (7, 5, 2)])
def test_audit_by_brute_force(spark, monkeypatch, held, bucket, block):
    monkeypatch.setattr(divergence, "BUCKET_ROWS", bucket)
    rows = corpus(200)
    docs = spark.createDataFrame(
        [(*r, "clash", 3) for r in rows], "lang string, source string, text string, term string, n int"
    )
    settings = divergence.Settings(min_docs=6, top=4)
    got = divergence.audit(docs, settings).collect()
    assert {tuple(r) for r in got} == brute(rows, settings) and len(got) == len(set(got))


def test_small_blocks_give_the_same(monkeypatch):
    """The comparison of one bucket, its sources in blocks and its terms in short runs."""
    import pyarrow as pa

    left = pa.table({"source": ["a", "b", "a", "c"], "term": ["t", "t", "u", "v"], "p": [9, 4, 7, 1]})
    whole = {}
    for block in (256, 1):
        monkeypatch.setattr(divergence, "SOURCE_BLOCK", block)
        monkeypatch.setattr(divergence, "DENSE_CELLS", 3)
        out = []
        for k in range(1 if block == 256 else 3):
            right = pa.table({"lang": ["x"] * 3, "block": [k] * 3, "source": ["a", "b", "c"], "none": [1, 2, 3]})
            out += divergence._compare(left, right).to_pylist()
        whole[block] = {(r["source"], r["item"]): r["value"] for r in out}
    assert whole[1] == whole[256]
    assert whole[1]["a", "b"] == abs(9 - 4) + abs(7 - 2) + abs(1 - 2)


def test_flushes_lose_nothing(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(divergence, "HELD", 2)
    batch = pa.RecordBatch.from_pydict(
        {"lang": ["e"] * 3, "source": ["s"] * 3, "text": pa.array([b"a b c A", b"a", "É b\x00b".encode()], pa.binary())}
    )
    n, d = Counter(), Counter()
    for out in divergence._count(iter([batch])):
        for r in out.to_pylist():
            n[r["term"]] += r["n"]
            d[r["term"]] += r["d"]
    assert n == {"a": 3, "b": 3, "c": 1, "É": 1} and d == {"a": 2, "b": 2, "c": 1, "É": 1}


def test_empty_table(spark):
    docs = spark.createDataFrame([], "lang string, source string, text string")
    assert divergence.audit(docs).count() == 0

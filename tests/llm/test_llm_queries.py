"""Queries of the subpackage against SQL or brute force, on the smallest tables."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest
from conftest import SMALL

import corpus_pipeline
from trustgauge.llm import oracle, queries

TABLES = "documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SMALL}/{name}.parquet'")
    return connection


@pytest.fixture(scope="module")
def docs(duck):
    return duck.execute("SELECT doc_id, coalesce(text, ''), source FROM documents").fetchall()


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text)


@pytest.mark.parametrize("name", sorted(oracle.statements()))
def test_query_equals_sql(spark, duck, name):
    result = queries.registry()[name](spark, SMALL)
    columns = sorted(result.columns)
    got = sorted(repr(tuple(r[c] for c in columns)) for r in result.collect())
    cursor = duck.execute(oracle.statements()[name])
    named = [d[0] for d in cursor.description]
    assert columns == sorted(named)
    assert got == sorted(repr(tuple(r[named.index(c)] for c in columns)) for r in cursor.fetchall())


def test_url_verdicts(spark, duck):
    rows = queries.op4_url_filters(spark, SMALL).collect()
    urls = dict(duck.execute("SELECT page_id, url FROM pages").fetchall())
    assert sorted(r.page_id for r in rows) == sorted(urls)
    rules = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}
    for r in rows:
        rest = urls[r.page_id].split("://", 1)[1]
        host = re.split("[/?#]", rest)[0]
        path = re.split("[?#]", rest[len(host):])[0]
        host = host.lower()
        fits = [
            k for k in rules
            if (host == (h := k.split("/")[0]) or host.endswith("." + h)) and path.startswith(k[len(h):])
        ]
        rule = max(fits, key=len, default=None)
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == (rules[rule] if rule else r.verdict)
        assert r.verdict in ("allow", "block")


def test_shards_hold_every_row_and_the_mixture(spark, docs):
    rows = queries.op5_sharding(spark, SMALL).collect()
    text = {d: t for d, t, _ in docs}
    assert sorted(r.doc_id for r in rows) == sorted(text)
    for r in rows:
        assert (r.size, r.text_crc32) == (len(text[r.doc_id].encode()) + 8, zlib.crc32(text[r.doc_id].encode()))
    counts = Counter(r.shard for r in rows)
    assert set(counts) == set(range(24)) and max(counts.values()) - min(counts.values()) <= 1
    for shard, n in counts.items():
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(n))


def test_packed_pieces(spark, docs):
    import numpy as np
    from tokenizers import Tokenizer

    rows = queries.op7_best_fit_packing(spark, SMALL).collect()
    tokenizer = Tokenizer.from_file(queries.tokenizer())
    got = {(r.doc_id, r.piece): r for r in rows}
    assert len(got) == len(rows)
    n = 0
    for doc, text, _ in docs:
        ids = tokenizer.encode(text, add_special_tokens=False).ids + [1]
        for piece, start in enumerate(range(0, len(ids), 4096)):
            own = np.array(ids[start : start + 4096], dtype="<u4")
            r = got[doc, piece]
            assert (r.start, r.length, r.ids_crc32) == (start, len(own), zlib.crc32(own.tobytes()))
            n += 1
    assert n == len(rows)
    filled = check_sequences((r.sequence_id, r.offset, r.length) for r in rows)
    assert len(filled) <= math.ceil(sum(r.length for r in rows) / 4096) + 1


def check_sequences(places):
    found = defaultdict(list)
    for sequence, offset, length in places:
        found[sequence].append((offset, length))
    for own in found.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 4096
    return found


def test_mix_meets_its_targets(spark, docs):
    rows = queries.op8_mixing(spark, SMALL).collect()
    size = {d: len(words(t)) for d, t, _ in docs}
    source = {d: s for d, _, s in docs}
    assert {r.doc_id: r["size"] for r in rows} == size
    totals = Counter()
    for d, n in size.items():
        totals[source[d]] += n
    names = sorted(totals, key=lambda s: (s is None, s))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    left, target, open_ = 1.5 * sum(totals.values()), {}, set(names)
    while open_:
        scale = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if weight[s] * scale > 2 * totals[s]}
        if not full:
            target |= {s: weight[s] * scale for s in open_}
            break
        for s in full:
            target[s] = 2.0 * totals[s]
            left -= target[s]
        open_ -= full
    taken = Counter()
    for r in rows:
        assert r.source_size == totals[source[r.doc_id]]
        assert r.target == pytest.approx(target[source[r.doc_id]])
        assert r.taken in {0, r["size"], 2 * r["size"]}
        taken[source[r.doc_id]] += r.taken
    for s in names:
        assert abs(taken[s] - target[s]) <= max(n for d, n in size.items() if source[d] == s)
    again = {r.doc_id: r.taken for r in queries.op8_mixing(spark, SMALL).collect()}
    assert again == {r.doc_id: r.taken for r in rows}


def test_pipeline_against_brute_force(spark, docs):
    """Each stage's result follows from its input by the plain definition."""
    from trustgauge.llm import mixing
    from trustgauge.llm.common import store

    frame = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns = frame.columns
    kept = [store(frame)]
    for _, stage in corpus_pipeline.STAGES:
        kept.append(store(stage(spark, kept[-1], SMALL)))
    assert all(k.columns == columns for k in kept[:-1])
    start, good, exact, near, mixed, packed = [k.collect() for k in kept]

    judged = queries.op9_quality_rules(spark, SMALL).where("kept").collect()
    assert sorted(r.doc_id for r in good) == sorted(r.doc_id for r in judged)
    fold = lambda t: t.encode().lower()  # noqa: E731  bytes.lower folds A-Z only
    last = {fold(r.text): r.doc_id for r in sorted(good)}
    assert sorted(r.doc_id for r in exact) == sorted(last.values())

    def shingles(text):
        w = fold(text).split()
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    sets = [(r.doc_id, shingles(r.text)) for r in sorted(exact)]
    least = {d: d for d, _ in sets}

    def root(d):
        while least[d] != d:
            d = least[d]
        return d

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                p, q = sorted((root(a), root(b)))
                least[q] = p
    assert sorted(r.doc_id for r in near) == sorted(d for d in least if root(d) == d)

    plan = mixing.mix_plan_of(kept[3]).collect()
    want = Counter({r.id: r.epochs + r.chosen for r in plan if r["size"]})
    assert Counter(r.doc_id for r in mixed) == +want
    assert Counter((r.doc_id, r.piece) for r in packed if r.piece == 0) == Counter((r.doc_id, 0) for r in mixed)
    check_sequences((r.sequence_id, r.offset, r.length) for r in packed)
    whole = corpus_pipeline.run(spark, SMALL)
    assert Counter((r.doc_id, r.piece, r.length) for r in whole.collect()) == Counter(
        (r.doc_id, r.piece, r.length) for r in packed
    )

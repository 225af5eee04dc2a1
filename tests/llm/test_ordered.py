"""Order-preserving packing: plans against brute force, ids against the tokenizer."""

from __future__ import annotations

import zlib

import duckdb
import numpy as np
import pytest
from conftest import SMALL
from tokenizers import Tokenizer

from trustgauge.llm import ordered, queries

COLUMNS = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def least_cost(places, prices, settings):
    at, best = [0, *places], [0] + [float("inf")] * len(places)
    for j in range(1, len(at)):
        for i in range(j):
            size = at[j] - at[i]
            if size <= settings.capacity:
                pad = 0 if bin(size).count("1") == 1 else settings.capacity - size
                best[j] = min(best[j], best[i] + settings.padding * pad + settings.window + prices[j - 1])
    return best[-1]


@pytest.mark.parametrize("seed", range(60))
def test_plan_costs_the_least(seed):
    rng = np.random.default_rng(seed)
    settings = ordered.Settings(capacity=32, window=int(rng.integers(0, 5)))
    places = np.cumsum(rng.integers(1, 20, int(rng.integers(1, 120))))
    prices = rng.choice([0, 2, 8, 16], len(places))
    cuts = ordered.plan_cuts(places, prices, settings)
    sizes = np.diff(places[cuts], prepend=0)
    assert cuts[-1] == len(places) - 1 and sizes.max() <= 32
    cost = sum(settings.padding * ordered.padded(int(n), 32) + settings.window for n in sizes) + prices[cuts].sum()
    assert cost == least_cost(places.tolist(), prices.tolist(), settings)


def test_equal_plans_keep_the_earliest_start():
    """Two plans of equal cost: the padded window reaches back as far as it can."""
    settings = ordered.Settings(capacity=8, window=0)
    places, prices = np.array([3, 6, 9, 12]), np.zeros(4, dtype=np.int64)
    assert ordered.plan_cuts(places, prices, settings) == [1, 3]
    assert ordered.plan_cuts(np.array([8, 16]), np.zeros(2, dtype=np.int64), settings) == [0, 1]


def check(rows, texts, capacity, end_id=0):
    """Every id in one piece, pieces equal to the tokenizer's ids, places gapless."""
    encoder = Tokenizer.from_file(queries.tokenizer("byte_bpe_50k.json"))
    ids = {k: encoder.encode(t or "", add_special_tokens=False).ids + [end_id] for k, t in texts.items()}
    pieces, windows = {k: [] for k in ids}, {}
    for r in rows:
        own = ids[r["doc_id"]]
        assert r["doc_tokens"] == len(own) and r["length"] > 0
        part = np.array(own[r["start"] : r["start"] + r["length"]], dtype="<u4")
        assert zlib.crc32(part.tobytes()) == r["ids_crc32"]
        pieces[r["doc_id"]].append((r["start"], r["length"]))
        windows.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for k, found in pieces.items():
        at = 0
        for start, length in sorted(found):
            assert start == at
            at += length
        assert at == len(ids[k])
    for found in windows.values():
        at = 0
        for offset, length in sorted(found):
            assert offset == at
            at += length
        assert at <= capacity
    sizes = [sum(n for _, n in w) for w in windows.values()]
    return sum(ordered.padded(n, capacity) for n in sizes), sum(map(len, ids.values()))


def test_query_by_brute_force(spark):
    rows = queries.op12_ordered_packing(spark, SMALL).collect()
    assert sorted(rows[0].asDict()) == sorted(COLUMNS)
    texts = dict(duckdb.sql(f"SELECT doc_id, text FROM '{SMALL}/documents.parquet'").fetchall())
    padding, total = check(rows, texts, 1024)
    assert padding < 0.01 * total


def test_blocks_and_odd_texts(spark):
    texts = {
        1: None, 2: "", 3: " ", 4: "a" * 9000, 5: " " * 5000 + "x", 6: "é ŀ中文。" * 400, 7: "One. Two!\nThree " * 700,
        8: "<|endoftext|> x <|endoftext|>", 9: "\n" * 3000, 10: "ok.",
    }
    docs = spark.createDataFrame(
        [(k, t, "z", 5) for k, t in texts.items()], "doc_id long, text string, id string, length int"
    ).coalesce(1)
    settings = ordered.Settings(capacity=64, block=1 << 11)
    out = ordered.pack_in_order(docs, queries.tokenizer("byte_bpe_50k.json"), settings, with_ids=True)
    rows = out.withColumnRenamed("id", "doc_id").collect()
    padding, total = check(rows, texts, 64)
    assert padding < 0.05 * total
    assert all(len(r["ids"]) == r["length"] for r in rows)
    # The order of the documents is that of the windows.
    places = sorted((r["sequence_id"], r["offset"], r["doc_id"], r["start"]) for r in rows)
    assert [p[2:] for p in places] == sorted(p[2:] for p in places)


def test_repeated_and_missing_ids_and_empty_tables(spark):
    path = queries.tokenizer("byte_bpe_50k.json")
    docs = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, "a b")], "doc_id long, text string")
    rows = ordered.pack_in_order(docs, path).collect()
    assert sum(r["length"] for r in rows) == 9 and sum(r["id"] is None for r in rows) >= 1
    assert ordered.pack_in_order(docs.limit(0), path).count() == 0
    assert ordered.pack_in_order(docs, path, order_by="doc_id").count() >= 3


def test_encoder_equals_the_tokenizer_for_every_letter():
    path = queries.tokenizer("byte_bpe_50k.json")
    quick, whole = ordered._encoder(path), Tokenizer.from_file(path)
    letters = [chr(c) for c in range(0x20000) if not 0xD800 <= c <= 0xDFFF]
    texts = [" ".join(f"a{c}1 {c}{c}b{c}!{c} 2{c}  {c}" for c in letters[k : k + 64]) for k in range(0, len(letters), 64)]
    for text, own in zip(texts, whole.encode_batch(texts, add_special_tokens=False), strict=True):
        assert quick.ids(text).tolist() == own.ids
    assert len(quick.ids(" " * 2_000_000 + "x")) == len(whole.encode(" " * 2_000_000 + "x").ids)

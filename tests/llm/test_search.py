"""Ranked search against brute force: shards, blocks of queries, ties, odd rows."""

import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from dqspark.llm import search as module
from dqspark.llm.search import search

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOW))


def brute(docs, items, k=20):
    """``(item_id, rank, doc_id, score)`` of lists of ``(id, text)``; each row of ``docs`` is a document."""
    words = [(i, terms(t)) for i, t in docs]
    n, total = sum(bool(w) for _, w in words), sum(len(w) for _, w in words)
    out = []
    for item, text in set(items):
        found = []
        for doc, own in words:
            score = 0
            for term in terms(text):
                df = sum(term in w for _, w in words)
                if tf := own.count(term):
                    weight = math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))
                    score += weight * (1000000000 * tf // (1000 * tf + 12 * (75 + 25 * len(own) * n // total)))
            if score > 0:
                found.append((-score, doc is None, doc, score))
        found.sort(key=lambda r: (r[0], r[1], r[2] if r[2] is not None else 0))
        out += [(item, rank, r[2], r[3]) for rank, r in enumerate(found[:k], 1)]
    return sorted(out, key=str)


def run(spark, docs, items, **options):
    found = search(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), **options
    )
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted((tuple(r) for r in found.collect()), key=str)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(11)
    vocabulary = [f"Wort{i}" for i in range(60)] + ["ÄÖ", "naïve", "x1"]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]
    docs = [(i, " ".join(rng.choices(vocabulary, weights, k=rng.choice([0, 1, 3, 8, 40, 400])))) for i in range(150)]
    docs += [(500 + i, docs[7][1]) for i in range(30)]  # copies: ties beyond the limit
    docs += [(3, docs[3][1]), (None, docs[7][1]), (900, None), (901, ""), (902, " \n!? ")]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([1, 2, 5, 30])))) for i in range(12)]
    items += [items[0], (50, None), (51, ""), (52, "absent words"), (53, docs[7][1]), (None, "wort1 WORT1 wort2")]
    return docs, items


def test_search_equals_brute_force(spark, corpus):
    assert run(spark, *corpus) == brute(*corpus)
    assert run(spark, *corpus, k=3) == brute(*corpus, k=3)


def test_small_shards_and_blocks_change_nothing(spark, corpus, monkeypatch):
    monkeypatch.setattr(module, "BLOCK_TERMS", 20)
    docs, items = corpus
    assert run(spark, docs[::2], items) == brute(docs[::2], items)


def test_reads_in_blocks_settle_all_scores():
    rng = np.random.default_rng(4)
    size, vocabulary = 3000, 6
    queries = module.Queries(np.array([0]), np.array([0, 6]), np.arange(6), np.array([1, 1, 2, 1, 1, 3]), np.arange(6).astype(np.uint64))
    queries.weights, queries.n_docs, queries.n_terms = np.array([4000, 3000, 2000, 700, 100, 0]), size, 40 * size
    doc = np.concatenate([np.sort(rng.choice(size, n, replace=False)) for n in (40, 400, 900, 2500, 2900, 2999)])
    term = np.repeat(np.arange(vocabulary), [40, 400, 900, 2500, 2900, 2999])
    tf, n = rng.integers(1, 6, len(doc)), rng.integers(5, 80, size)
    shard = module.Shard(queries, doc, term, tf, n)
    whole = np.zeros(size, np.int64)
    np.add.at(whole, doc, queries.impacts(term, tf, n[doc]) * queries.times[term])
    at, score = shard.best(queries.terms, queries.times, 20, 1)
    best = np.sort(whole)[-20]
    assert set(at) >= set(np.flatnonzero(whole >= best)) and (score == whole[at]).all()
    at, _ = shard.best(queries.terms, queries.times, 20, int(whole.max()) + 1)
    assert not len(at)


def test_empty_tables_and_clashing_columns(spark, odd, nothing):
    items = spark.createDataFrame([(1, "quick fox", 2, 3)], "item_id long, text string, rank int, score long")
    found = search(odd, items).collect()
    assert {(r["rank"], r["doc_id"]) for r in found} == {(1, 7), (2, 8)}
    assert search(nothing, items).collect() == []
    assert search(odd, items.limit(0)).collect() == []


def test_text_ids_are_kept(spark):
    docs = spark.createDataFrame([("b", "one two"), ("a", "one two"), (None, "one two")], "doc_id string, text string")
    items = spark.createDataFrame([("q", "one three")], "item_id string, text string")
    extra = docs.unionAll(docs.select(F.lit("z"), F.lit("other words")))
    assert [(r["item_id"], r["rank"], r["doc_id"]) for r in search(extra, items).orderBy("rank").collect()] == [
        ("q", 1, "a"), ("q", 2, "b"), ("q", 3, None),
    ]

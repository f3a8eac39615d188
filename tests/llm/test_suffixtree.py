import glob
import os
import random
import time

import numpy as np
import pytest

from dqspark.llm import suffixtree
from dqspark.plans import storage


@pytest.fixture(scope="module")
def texts(spark):
    rng = random.Random(4)
    rows = [(i, " ".join(f"w{int(rng.paretovariate(0.8)) % 400}" for _ in range(300))) for i in range(80)]
    return spark.createDataFrame([*rows, (80, None), (81, "w1 w2 w3")], "doc_id long, text string")


def scores(texts, tree, unigrams):
    return {r["doc_id"]: (r["base_score"], r["score"]) for r in suffixtree.score_documents(texts, tree, unigrams).collect()}


def test_the_most_frequent_grams_are_local(texts, monkeypatch):
    """A tree with more grams than may be sent whole still has the frequent ones where the texts are."""
    tree, unigrams = suffixtree.fit_tree(texts)
    all_scores = scores(texts, tree, unigrams)
    assert tree.bits is None and len(tree.grams) > 60
    monkeypatch.setattr(suffixtree, "LOCAL_GRAMS", 50)
    monkeypatch.setattr(suffixtree, "WORD_PART", 4)
    few, unigrams = suffixtree.fit_tree(texts)
    assert 0 < len(few.grams) <= 50 and set(few.grams) < set(tree.grams)
    assert len(few.grams) + few.rare.count() == len(tree.grams)
    again = scores(texts, few, unigrams)
    assert all(again[i] == pytest.approx(all_scores[i]) for i in all_scores)


def test_tables_of_the_fit_are_deleted(texts, spark, monkeypatch, tmp_path):
    monkeypatch.setattr(storage, "shared_dir", lambda _: str(tmp_path))
    tree, unigrams = suffixtree.fit_tree(texts)
    assert sorted(n.split("-")[0] for n in os.listdir(tmp_path / "dqspark")) == ["tree", "unigrams"]
    assert unigrams.count() > 0 and len(tree.grams) > 0


def test_shuffles_of_the_fit_are_dropped(texts, spark):
    root = os.path.dirname(os.path.dirname(spark.sparkContext._temp_dir))
    files = lambda: set(glob.glob(f"{root}/blockmgr-*/*/shuffle_*.data"))
    before, key = files(), suffixtree.DROP_SHUFFLES
    texts.groupBy("doc_id").count().write.format("noop").mode("overwrite").save()
    assert files() - before
    before, setting = files(), spark.conf.get(key)
    suffixtree.fit_tree(texts)
    for _ in range(50):
        if not files() - before:
            break
        time.sleep(0.2)
    assert not files() - before and spark.conf.get(key) == setting


def test_rare_tokens_and_repeated_rows(texts, monkeypatch):
    """Tokens are sent up to a number, not by their share; rows of one id and text keep scores of their own."""
    monkeypatch.setattr(suffixtree, "WORD_PART", 4)
    tree, unigrams = suffixtree.fit_tree(texts)
    assert tree.whole and len(tree.frequent) == unigrams.count()
    all_scores = scores(texts, tree, unigrams)
    monkeypatch.setattr(suffixtree, "LOCAL_GRAMS", 50)
    few, unigrams = suffixtree.fit_tree(texts)
    assert not few.whole and 0 < len(few.frequent) <= 50
    rows = suffixtree.score_documents(texts.unionAll(texts), few, unigrams).collect()
    assert len(rows) == 2 * len(all_scores)
    for r in rows:
        assert (r["base_score"], r["score"]) == pytest.approx(all_scores[r["doc_id"]])
        assert r["n_known"] == r["n_tokens"]


def test_lookups_and_order_against_numpy():
    values = np.random.default_rng(5).integers(0, 2**64, 5000, dtype=np.uint64)
    close = np.uint64(7 << 60) + np.arange(40, dtype=np.uint64)
    values = np.concatenate([values, values[:900], close[::-1], np.array([0, 2**64 - 1], np.uint64)])
    assert (values[suffixtree.ordered(values)] == np.sort(values)).all()
    for table in (np.unique(values[::2]), np.unique(values)[:-1], values[:0], values[:1], close[::3]):
        at, place = suffixtree.Lookup(table)(values)
        assert (at == np.flatnonzero(np.isin(values, table))).all() and (table[place] == values[at]).all()


def test_weights_are_asked_for_by_blocks(texts, monkeypatch, tmp_path):
    """Rare words and grams are asked for in lists, without a row for each of them and without a stored copy."""
    tree, unigrams = suffixtree.fit_tree(texts)
    all_scores = scores(texts, tree, unigrams)
    for name, value in {"WORD_PART": 4, "LOCAL_GRAMS": 50, "ASKED_TOKENS": 4096, "BLOCK": 700, "CHUNK": 5000}.items():
        monkeypatch.setattr(suffixtree, name, value)
    few, unigrams = suffixtree.fit_tree(texts)
    assert not few.whole and few.bits is not None
    monkeypatch.setattr(storage, "shared_dir", lambda _: str(tmp_path))
    scored = suffixtree.score_documents(texts.unionAll(texts).repartition(3), few, unigrams)
    plan = scored._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Generate" not in plan
    rows = scored.collect()
    assert not os.path.exists(tmp_path / "dqspark") and len(rows) == 2 * len(all_scores)
    for r in rows:
        assert (r["base_score"], r["score"]) == pytest.approx(all_scores[r["doc_id"]])
        assert r["n_known"] == r["n_tokens"]


def test_ids_may_be_null(spark, texts):
    tree, unigrams = suffixtree.fit_tree(texts)
    rows = spark.createDataFrame([(None, "w1 w2"), (3, "w1 w2"), (None, None)], "doc_id long, text string")
    found = [(r["doc_id"], r["n_tokens"]) for r in suffixtree.score_documents(rows, tree, unigrams).collect()]
    assert sorted(found, key=str) == [(3, 3), (None, 1), (None, 3)]


def test_runs_of_numbered_words():
    tokens = np.random.default_rng(6).integers(1, 2**64, 200, dtype=np.uint64)
    numbered = suffixtree.Numbered(np.sort(tokens[:190]), np.arange(190) % 7)
    numbers = numbered(tokens)
    assert (numbers[190:] == -1).all() and (numbered.words[numbers[:190]] == tokens[:190]).all()
    runs = suffixtree.grams(tokens, np.array([200]), 4)
    for size in (2, 3, 4):
        first, last = numbered.ends(np.stack([numbers[i : 191 - size + i] for i in range(size)], 1))
        assert (first == runs[size - 2][size - 2 : 189]).all() and (last == runs[size - 2][size - 1 : 190]).all()


def test_packed_values_are_unpacked():
    for values in (np.arange(700, dtype=np.uint32), np.array([0, 2**64 - 1, 5], np.uint64), np.array([0.5, -3.25]), np.zeros(0, np.uint64)):
        assert (suffixtree.unpacked(suffixtree.packed(values), values.dtype.type) == values).all()

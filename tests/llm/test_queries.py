"""Registered queries against their SQL over whole small tables, and against brute force where there is none."""

import collections
import hashlib
import math
import re
import zlib

import duckdb
import pandas as pd
import public_tokenizers
import pytest
import tiktoken

from dqspark.llm.bpe import read_ranks
from dqspark.llm.queries import ORACLES, QUERIES
from tests.llm.conftest import words
from workloads.check import TABLES, row_counter

TINY = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs():
    return pd.read_parquet(f"{TINY}/documents.parquet")


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_its_sql(spark, name):
    db = duckdb.connect()
    for table in TABLES:
        db.sql(f"CREATE VIEW {table} AS SELECT * FROM '{TINY}/{table}.parquet'")
    result = QUERIES[name](spark, TINY)
    relation = db.sql(ORACLES[name])
    assert sorted(relation.columns) == sorted(result.columns)
    assert row_counter(result.columns, result.collect()) == row_counter(relation.columns, relation.fetchall())


def test_fingerprints_of_edits(spark, docs):
    rows = {r["doc_id"]: r for r in QUERIES["op3_document_fingerprints"](spark, TINY).collect()}
    texts = dict(zip(docs.doc_id, docs.text.fillna(""), strict=True))
    ids = sorted(texts)
    by_text = collections.defaultdict(set)
    for i, after in zip(ids, ids[1:] + ids[:1], strict=True):
        quarter = len(texts[i]) // 4
        edited = texts[i][: len(texts[i]) - quarter] + texts[after][:quarter]
        assert rows[i]["n_chars"] == len(texts[i])
        assert rows[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= rows[i]["near_next"] <= 1 and 0 <= rows[i]["near_edited"] <= 1
        by_text[texts[i]].add(rows[i]["fingerprint"])
        by_text[edited].add(rows[i]["edited_fingerprint"])
    assert all(len(found) == 1 for found in by_text.values())
    near = [rows[i]["near_edited"] for i in ids]
    far = [rows[i]["near_next"] for i in ids]
    assert sum(near) / len(near) > 0.6 > 0.35 > sum(far) / len(far)


def test_tokens_equal_the_library(spark, docs):
    ranks = read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rows = {r["doc_id"]: r for r in QUERIES["op5_byte_bpe"](spark, TINY).collect()}
    sizes = collections.Counter()
    for i, text in zip(docs.doc_id, docs.text.fillna(""), strict=True):
        ids = library.encode_ordinary(text)
        packed = b"".join(x.to_bytes(4, "little") for x in ids)
        assert rows[i]["n_tokens"] == len(ids)
        assert rows[i]["ids_sha256"] == hashlib.sha256(packed).hexdigest()
        assert rows[i]["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        sizes[len(ids)] += 1
    report = {r["n_tokens"]: r for r in QUERIES["op6_token_counts"](spark, TINY).collect()}
    assert {k: r["n_docs"] for k, r in report.items()} == sizes
    for limit, r in report.items():
        assert r["docs_over"] == sum(n for k, n in sizes.items() if k > limit)
        assert r["truncated_tokens"] == sum(min(k, limit) * n for k, n in sizes.items())
        assert r["share"] == pytest.approx(sum(n for k, n in sizes.items() if k <= limit) / sum(sizes.values()))


def test_languages_of_held_out_documents(spark, docs):
    rows = QUERIES["op7_language_id"](spark, TINY).toPandas().merge(docs, on="doc_id")
    assert len(rows) == len(docs)
    assert (rows.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in rows.doc_id]).all()
    assert rows.score.between(0, 1).all()
    held = rows[rows.held_out]
    assert (held.lang_pred == held.lang).mean() > 0.95


def test_scores_of_the_suffix_tree(spark, docs):
    rows = QUERIES["op8_lm_scoring"](spark, TINY).toPandas().set_index("doc_id")
    tokens = {i: [*words(t), None] for i, t in zip(docs.doc_id, docs.text, strict=True)}
    held = {i: zlib.crc32(str(i).encode()) % 5 == 1 for i in tokens}
    counts = collections.Counter(w for i in tokens if not held[i] for w in tokens[i])
    total, scale = sum(counts.values()), math.log10(sum(counts.values()) + 0.5 * (len(counts) + 1))
    for i, own in tokens.items():
        base = sum(math.log10(counts[w] + 0.5) - scale for w in own)
        assert rows.base_score[i] == pytest.approx(base)
        assert (rows.n_tokens[i], rows.n_known[i]) == (len(own), sum(counts[w] > 0 for w in own))
        assert rows.train_tokens[i] == total and rows.held_out[i] == held[i]
    test = rows[rows.held_out]
    assert test.score.sum() > test.base_score.sum()


def test_mix_comes_near_its_targets(spark, docs):
    rows = QUERIES["op9_mix_sources"](spark, TINY).toPandas().merge(docs[["doc_id", "source"]], on="doc_id")
    assert (rows["size"] == [len(words(t)) for t in docs.set_index("doc_id").text[rows.doc_id]]).all()
    sizes = rows.groupby("source")["size"].sum()
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sorted(sizes.index, key=lambda s: s.encode()))}
    left, goal, target = set(weights), 1.5 * sizes.sum(), {}
    while left:
        level = (goal - sum(target.values())) / sum(weights[s] for s in left)
        full = {s for s in left if level * weights[s] > 2 * sizes[s]}
        target |= {s: 2.0 * sizes[s] for s in full} if full else {s: level * weights[s] for s in left}
        left = left - full if full else set()
    for source, own in rows.groupby("source"):
        assert (own.source_size == sizes[source]).all()
        assert own.target.iloc[0] == pytest.approx(target[source])
        assert abs(own.taken.sum() - target[source]) <= max(0.02 * target[source], 600)
    assert (rows.taken <= 2 * rows["size"]).all()
    again = QUERIES["op9_mix_sources"](spark, TINY).toPandas().set_index("doc_id").taken
    assert (again[rows.doc_id].to_numpy() == rows.taken.to_numpy()).all()


def test_pages_keep_their_articles(spark):
    import html

    pages = pd.read_parquet(f"{TINY}/pages.parquet").set_index("page_id")
    for r in QUERIES["op10_html_extraction"](spark, TINY).collect():
        article = re.search(r"<article>(.*?)(</article>|\Z)", pages.html[r["page_id"]], re.S)[1]
        blocks = re.sub(r"<[^>]*>?", "", re.sub(r"<br>", " ", re.sub(r"</?(p|h1)>", "\n", article))).split("\n")
        kept = [re.sub(r"\s+", " ", html.unescape(b)).strip() for b in blocks]
        assert r["text"] == "\n".join(b for b in kept if b)
        assert r["n_chars"] == len(r["text"])


def test_texts_of_no_language_are_rejected_and_clean_ones_kept(spark):
    import random

    from dqspark.llm.langid import fit_languages, identify_languages

    docs = spark.read.parquet(f"{TINY.replace('sf0.001', 'sf0.01')}/documents.parquet")
    rng = random.Random(1)
    scripts = [(97, 122), (0x3B1, 0x3C9), (0x430, 0x44F), (0x4E00, 0x9FA5), (0x627, 0x64A)]

    def made(low, high, n):
        return " ".join("".join(chr(rng.randint(low, high)) for _ in range(rng.randint(2, 9))) for _ in range(n))

    strange = [(made(*script, n), f"{n}") for script in scripts for n in (20, 60, 250, 500)]
    # Ids are not looked at, and thousands of copies of one text are one text of the sample.
    copies = docs.limit(1).select("text", "lang").crossJoin(spark.range(3000)).drop("id")
    labelled = docs.select("text", "lang").unionAll(copies)
    model = fit_languages(labelled)
    assert model.languages == sorted(r["lang"] for r in docs.select("lang").distinct().collect() if r["lang"])
    assert all(r["rejected"] for r in identify_languages(spark.createDataFrame(strange, "text string, n string"), model).collect())
    kept = identify_languages(docs.filter("lang IS NOT NULL"), model).collect()
    assert [(r["doc_id"], len(r["text"]), r["score"]) for r in kept if r["rejected"]] == []
    assert sum(r["lang"] == r["lang_pred"] for r in kept) >= 0.99 * len(kept)


def test_bounds_of_lengths():
    import numpy as np

    from dqspark.llm.langid import BANDS, BINS, LEAST_TEXTS, SLACK, least_cosines

    seen = np.zeros((2, BANDS, BINS), int)
    seen[0, 3, 50], seen[0, 5, 100], seen[1, 5, 200] = LEAST_TEXTS, LEAST_TEXTS, 5 * LEAST_TEXTS
    bounds = least_cosines(seen)
    assert not bounds[:, :3].any() and np.allclose(bounds[:, 3:5], SLACK * 50 / BINS)
    assert np.allclose(bounds[:, 5:], SLACK * np.array([[100], [200]]) / BINS)

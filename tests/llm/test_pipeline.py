import corpus_pipeline
import pandas as pd
import pytest

from tests.llm.conftest import words
from tests.llm.test_edge_cases import components

TINY = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What each stage returns, written and read again."""
    kept = [spark.read.parquet(f"{TINY}/documents.parquet")]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("stages") / str(i))
        stage(spark, kept[-1], TINY).write.parquet(path)
        kept.append(spark.read.parquet(path))
    return [k.toPandas() for k in kept]


def test_stages_keep_the_columns(stages):
    assert all(list(s.columns) == ["doc_id", "text", "lang", "source", "n_chars"] for s in stages[:-1])


def test_stages_one_after_the_other(stages):
    docs, named, lines, groups, mix, tokens = stages
    lettered = docs[[any(c.isalpha() for c in t) for t in docs.text.fillna("")]]
    assert len(named) >= 0.99 * len(lettered)
    keys = [
        {k.strip(" \t\n\x0b\x0c\r") for k in t.split("\n")} for t in named.text
    ]
    assert len(lines) == len(named) and lines.text.str.len().sum() < named.text.str.len().sum() and keys
    roots = components(dict(zip(lines.doc_id, lines.text, strict=True)))
    assert sorted(groups.doc_id) == sorted(i for i, (_, root) in roots.items() if i == root)
    assert set(mix.doc_id) <= set(groups.doc_id) and mix.doc_id.value_counts().max() <= 2
    size = {i: len(words(t)) for i, t in zip(groups.doc_id, groups.text, strict=True)}
    assert sum(size[i] for i in mix.doc_id) == pytest.approx(1.5 * sum(size.values()), rel=0.15)
    assert sorted(tokens.doc_id) == sorted(mix.doc_id) and (tokens.n_tokens > 0).all()


def test_run_gives_the_last_stage(spark, stages):
    got = corpus_pipeline.run(spark, TINY).toPandas()
    assert corpus_pipeline.ORACLE_SQL is None
    order = ["doc_id", "ids_sha256"]
    pd.testing.assert_frame_equal(
        got.sort_values(order, ignore_index=True), stages[-1].sort_values(order, ignore_index=True)
    )


def test_texts_of_one_id_are_told_apart(spark):
    near = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen"
    rows = [
        (1, near), (5, near + " more"), (5, "a wholly different text that stays where it is for good"), (5, near + " more"),
        (6, near), (7, None), (7, "another text"), (None, near), (8, ""), (8, ""),
    ]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.one_of_each_group(spark, docs, "")
    assert kept.columns == docs.columns
    assert sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str) == sorted(
        [(1, near), (5, rows[2][1]), (7, None), (7, "another text"), (None, near), (8, ""), (8, "")], key=str
    )


def test_stages_of_an_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES:
        made = stage(spark, docs, TINY)
        assert made.collect() == []
        docs = made if made.columns == docs.columns else docs

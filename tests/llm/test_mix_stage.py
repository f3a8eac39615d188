"""The mixing stage of the pipeline against the target of each source."""

import pytest
from corpus_pipeline import mixed
from pyspark.sql import functions as F

from dqspark.llm.mixing import mix_sources
from tests.llm.test_edge_cases import mixed_sources


def test_copies_meet_targets_of_any_source(spark):
    docs = mixed_sources(spark)
    target = {r["source"]: r["target"] for r in mix_sources(docs).select("source", "target").distinct().collect()}
    copies = mixed(spark, docs, "")
    assert copies.columns == docs.columns and copies.filter("doc_id is null").count() > 0
    assert copies.filter("doc_id <> 7").groupBy("doc_id").count().agg(F.max("count")).first()[0] <= 2
    words_of = copies.groupBy("source").agg(F.sum(F.size(F.split("text", " "))).alias("n")).collect()
    assert {r["source"]: r["n"] for r in words_of} == pytest.approx(target, rel=0.02)

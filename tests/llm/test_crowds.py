import random
import re

from dqspark.llm import jaccard
from tests.llm.test_edge_cases import components


def test_members_of_crowded_signatures_are_joined_once(spark, monkeypatch, capsys):
    """A passage shared by texts of different components: their rows meet the leaders once and the open signatures once."""
    rng = random.Random(8)
    passage = " ".join(f"p{i}" for i in range(50))
    texts = {i: passage + " " + " ".join(f"{i // 2}x{j}" for j in range(rng.randint(3, 60))) for i in range(120)}
    store = jaccard.stored

    def explained(df, name):
        df.explain()
        return store(df, name)

    monkeypatch.setattr(jaccard, "stored", explained)
    got = jaccard.jaccard_components(spark.createDataFrame(list(texts.items()), "doc_id long, text string"))
    plans = capsys.readouterr().out
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got.collect()} == components(texts)
    joins = re.findall(r"Join \[signature#\d+L?\], \[signature#\d+L?\], (\w+)", plans)
    assert sorted(joins) == ["Inner", "LeftSemi"]

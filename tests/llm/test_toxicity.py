"""The grammar's marks, what is learned from labels, held-out accuracy, and odd rows."""

import random
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from dqspark.llm._arrow import LOWER, SpanHasher, chunks, runs
from dqspark.llm.queries import QUERIES
from dqspark.llm.toxicity import SYMBOLS, ToxicityModel, fit_toxicity, grammar, letters, reported_speech, score_toxicity, threat

SMALL = "/root/testdata/sf0.01"


def hashes(*names):
    data = " ".join(names).encode()
    low = LOWER[np.frombuffer(data, np.uint8)]
    starts, ends, _ = runs(letters(low), np.array([0, len(low)]))
    return np.sort(SpanHasher(low)(starts, ends))


@pytest.fixture(scope="module")
def model():
    return ToxicityModel({0: (hashes("idiot", "scum"), np.array([4.0, 4.0])), 5: (hashes("trott"), np.array([2.0]))}, np.array([-6.0, 3.0, 1.0]))


def clause_scores(model, text):
    """By row, the sum of its clauses' scores and the best."""
    ((_, _, data, at),) = chunks(pa.array([text], pa.string()))
    return tuple(float(v) for v in np.expm1(model.features(data, at)[0, 1:]).round(6))


@pytest.mark.parametrize(
    ("text", "score"),
    [
        ("A plain idiot somewhere.", 4.0),
        ("you are an IDIOT", 6.0),
        ("idiot, that one, you know", 4.0),
        ("an idiot you", 6.0),
        ("this is not an idiot.", 4 * 0.3),
        ("Anna said an idiot came", 4 * 0.5),
        ('Anna read "what scum" aloud', 4 * 0.5),
        ("Anna read “what scum” aloud", 4 * 0.5),
        ("they are not idiot", 4 * 0.3 * 1.5),
        ("never. A scum", 4.0),
        ("du bist ein Trottelchen", 3.0),
        ("i will kill you", 4 * 1.5),
        ("kill you", 4.0),
        ("kill time. You rest", 0.0),
        ("idiotic scumbag", 0.0),
    ],
)
def test_marks_of_a_clause(model, text, score):
    assert clause_scores(model, text)[0] == pytest.approx(score)


def test_clauses_add_up_once_each(model):
    assert clause_scores(model, "an idiot. A scum\nan idiot scum") == pytest.approx((16.0, 8.0))
    assert clause_scores(model, "an idiot. " * 50) == pytest.approx((4.0, 4.0))


def test_quotes_end_with_their_line(model):
    assert clause_scores(model, '"open quote\na scum')[0] == pytest.approx(4.0)
    assert clause_scores(model, '"open quote. A scum')[0] == pytest.approx(2.0)


def test_composition_marks_as_its_parts():
    rng = random.Random(1)
    rows, state = grammar()
    said, harm = reported_speech(), threat()
    a, b = said.start, harm.start
    for _ in range(5000):
        symbol = rng.randrange(len(SYMBOLS))
        state, marks = rows[state][symbol]
        a, first = said.step(a, SYMBOLS[symbol])
        b, second = harm.step(b, SYMBOLS[symbol])
        assert ("reported" in marks) == ("reported" in first) and ("threat" in marks) == ("threat" in second)


def test_chunks_and_rows_do_not_touch(model):
    texts = ["not", "an idiot", "", None, 'a "quote', "scum", "x " * 400_000 + "you idiot", "trottel"]
    one = [clause_scores(model, t) for t in texts]
    together = [r for _, _, data, at in chunks(pa.array(texts)) for r in np.expm1(model.features(data, at)[:, 1:])]
    assert np.allclose(together, one)


def learned(spark):
    rng = random.Random(2)
    plain = [f"w{a}{b}" for a in "aeiou" for b in "bcdfghklmn"]
    rows, labels = [], []
    for i in range(600):
        own = rng.choices(plain, k=40)
        if bad := i % 5 == 0:
            for _ in range(4):
                own[rng.randrange(40)] = rng.choice(["grobian", "flegeln", "flegelig", "flegelei", "flegelhaft", "flegeltum"])
        rows.append((i, " ".join(own)))
        labels.append((i, int(bad)))
    # Copies of one toxic text say nothing of its other words.
    rows += [(1000 + i, "mumble grumble tumble grobian rumble") for i in range(40)]
    labels += [(1000 + i, 1) for i in range(40)] + [(7, None), (None, 1), (9999, 1)]
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_insults_and_beginnings_are_learned(spark):
    docs, labels = learned(spark)
    model = fit_toxicity(docs, labels)
    texts = ["wab web grobian wib wob flegelig", "wab web wib wob", "mumble tumble rumble", "flegelartig wab flegelsam flegelnd"]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    made = {r["doc_id"]: r["predicted"] for r in score_toxicity(rows, model).collect()}
    assert made == {0: 1, 1: 0, 2: 0, 3: 1}


def test_odd_rows_and_empty_tables(spark, odd, nothing):
    docs, labels = learned(spark)
    model = fit_toxicity(docs, labels)
    scored = score_toxicity(odd.withColumnRenamed("key", "score").withColumnRenamed("size", "predicted"), model)
    rows = scored.collect()
    assert len(rows) == odd.count() and all(0 <= r["score"] < 0.7 and r["predicted"] == 0 for r in rows)
    assert score_toxicity(nothing, model).collect() == []
    for bare in (fit_toxicity(nothing, labels), fit_toxicity(docs, labels.filter("toxic = 1")), fit_toxicity(docs, labels.limit(0))):
        assert {r["predicted"] for r in score_toxicity(odd, bare).collect()} == {0}


def test_held_out_accuracy(spark):
    found = {r["doc_id"]: r for r in QUERIES["op12_toxicity"](spark, SMALL).collect()}
    db = duckdb.connect()
    assert len(found) == db.sql(f"select count(*) from '{SMALL}/documents.parquet'").fetchall()[0][0]
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in found.items())
    marks = db.sql(f"select doc_id, toxic from '{SMALL}/labels.parquet' where toxic is not null").fetchall()
    mine = [(found[i], t) for i, t in marks if i in found and found[i]["held_out"]]
    assert sum(r["predicted"] for r, t in mine if t) >= 0.7 * sum(t for _, t in mine)
    assert sum(r["predicted"] for r, t in mine if not t) <= 0.02 * len(mine)

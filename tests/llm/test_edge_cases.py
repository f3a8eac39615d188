"""Nulls, empty and long texts, repeated rows, clashing columns and empty tables for every operator."""

import hashlib
import itertools
import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from dqspark.llm._arrow import CHUNK_BYTES
from dqspark.llm.bpe import Encoder, Prefixes, encode_documents, read_ranks, token_digests
from dqspark.llm.components import connected_components
from dqspark.llm.exact import exact_duplicates
from dqspark.llm.fingerprints import added, fingerprint_edits, lanes, paragraph_hashes, removed
from dqspark.llm.html import extract_pages
from dqspark.llm.jaccard import jaccard_components
from dqspark.llm.langid import fit_languages, identify_languages
from dqspark.llm.lengths import length_histogram, length_report
from dqspark.llm.lines import LineRuns, dedup_batch, dedup_lines
from dqspark.llm.mixing import apportion, mix_sources
from dqspark.llm.suffixtree import fit_tree, score_documents
from tests.llm.conftest import LONG, ODD, words

RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def shingles(text):
    w = words(text)
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def components(texts):
    sets = {i: shingles(t) for i, t in texts.items()}
    root = {i: i for i in texts}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in itertools.combinations(texts, 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= 75 * len(sets[a] | sets[b]):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {i: (len(sets[i]), find(i)) for i in texts}


def test_jaccard_equals_brute_force(spark):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(400)]
    texts, passage = {}, [f"p{i}" for i in range(60)]
    for family in range(25):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([3, 6, 9, 20, 27, 40, 90, 300, 1500]))]
        for _ in range(40 if family == 3 else rng.randint(1, 6)):
            own = list(base)
            for _ in range(rng.randint(0, max(1, len(own) // 25))):
                own[rng.randrange(len(own))] = rng.choice(vocabulary)
            if rng.random() < 0.3:
                own = own[: rng.randint(len(own) * 3 // 4, len(own))]
            if family % 4 == 0:
                own = passage + own
            texts[len(texts)] = " ".join(own)
    got = jaccard_components(spark.createDataFrame(list(texts.items()), "doc_id long, text string"))
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got.collect()} == components(texts)


def test_jaccard_of_a_crowd(spark):
    """One passage in many documents and a group of near copies larger than a light signature."""
    rng = random.Random(6)
    passage = " ".join(f"p{i}" for i in range(50))
    texts = {i: passage + " " + " ".join(f"{i}x{j}" for j in range(rng.randint(3, 60))) for i in range(120)}
    base = [f"b{i}" for i in range(80)]
    for i in range(200, 320):
        own = list(base)
        for _ in range(rng.randint(0, 4)):
            own[rng.randrange(80)] = f"e{rng.randrange(10**6)}"
        texts[i] = " ".join(own)
    got = jaccard_components(spark.createDataFrame(list(texts.items()), "doc_id long, text string"))
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got.collect()} == components(texts)


def test_jaccard_of_odd_rows(odd, nothing):
    got = [tuple(r) for r in jaccard_components(odd).collect()]
    assert len(got) == len(ODD)
    by = {r[0]: r[1:] for r in got}
    assert by[4] == (0, 4) and by[5] == (0, 5) and by[6] == (0, 6)
    assert by[7][1] == by[8][1] == 7 and by[1][1] == 1
    assert jaccard_components(nothing).count() == 0


@pytest.mark.parametrize("n", [1, 2, 3, 4])
def test_jaccard_of_chunks_of_few_words(spark, n):
    """A document of fewer words than a shingle alone in its table, and alone in a chunk between two very long ones."""
    short = " ".join("abcd"[:n])
    alone = spark.createDataFrame([(1, short)], "doc_id long, text string")
    assert [tuple(r)[:3] for r in jaccard_components(alone).select("doc_id", "n_shingles", "component_id").collect()] == [(1, 1, 1)]
    if n in (2, 3):
        long = "word " * (CHUNK_BYTES // 5 + 10)
        rows = spark.createDataFrame([(1, long), (2, short), (3, long + "end")], "doc_id long, text string").coalesce(1)
        got = {r["doc_id"]: r["n_shingles"] for r in jaccard_components(rows).collect()}
        assert got == {1: 1, 2: 1, 3: 2}


def test_components_of_a_path(spark):
    links = spark.range(60).selectExpr("id a", "id + 1 b").unionAll(spark.createDataFrame([(100, 101), (5, 5), (None, 3)], "a long, b long"))
    got = {r["node"]: r["root"] for r in connected_components(links).collect()}
    assert got == {i: 0 for i in range(61)} | {100: 100, 101: 100}


def test_exact_duplicates_of_odd_rows(odd, nothing):
    got = exact_duplicates(odd).collect()
    assert len(got) == len(ODD) and sum(r["kept"] for r in got) == len({r["text_sha256"] for r in got})
    blank = {r["doc_id"]: r for r in got if r["text_sha256"] == hashlib.sha256(b"").hexdigest()}
    assert set(blank) == {4, 5, 6} and all(r["keep_id"] == 6 and r["group_size"] == 3 for r in blank.values())
    assert [r["kept"] for r in got if r["doc_id"] == 3].count(True) == 1
    assert exact_duplicates(nothing).count() == 0


def test_lines_of_odd_rows(odd, nothing):
    got = dedup_lines(odd)
    assert got.columns == [*odd.columns, "n_lines", "n_dropped"]
    by = {r["doc_id"]: r for r in got.collect()}
    assert (by[1]["text"], by[1]["n_lines"], by[1]["n_dropped"]) == ("x", 3, 2)
    assert by[3]["n_dropped"] == 0 and by[3]["text"] == ODD[2][1]
    assert by[4]["text"] is None and by[4]["n_lines"] == 1
    assert by[6]["n_lines"] == 2 and got.count() == len(ODD)
    assert dedup_lines(nothing).count() == 0


def test_line_runs_take_batches(spark):
    runs = LineRuns(spark, fan=2)
    line = "this very line is in each of the batches"
    for b in range(5):
        batch = spark.createDataFrame([(b, f"{line}\nonly batch number {b} has this line")], "doc_id long, text string")
        new = dedup_batch(runs, batch)
        assert new.count() == (2 if b == 0 else 1)
    assert len(runs.levels) == 3 and runs.keys().agg(F.max("n_docs")).first()[0] == 5


def test_fingerprints_add_up(spark):
    df = spark.createDataFrame([("one, two.\nthree\nfour", "four\none, two.\nthree", "three\nfour", "one, two.")], "a string, b string, c string, d string")
    made = df.select(*[paragraph_hashes(F.col(c)).alias(c) for c in "abcd"])
    made = made.select(*[lanes(F.col(c)).alias(c) for c in "abcd"])
    row = made.select("*", added(F.col("c"), F.col("d")).alias("sum"), removed(F.col("a"), F.col("d")).alias("rest")).first()
    assert row["a"] == row["b"] == row["sum"] and row["rest"] == row["c"] != row["a"]


def test_fingerprints_of_odd_rows(odd, nothing):
    got = fingerprint_edits(odd).collect()
    assert len(got) == len(ODD)
    by = {r["doc_id"]: r for r in got}
    last = ODD[10][1]
    assert by[4]["fingerprint"] == by[5]["fingerprint"] and by[4]["near_next"] == 1.0
    assert by[10]["edited_sha256"] == hashlib.sha256((last[: len(last) - len(last) // 4] + ODD[0][1][: len(last) // 4]).encode()).hexdigest()
    assert fingerprint_edits(nothing).count() == 0


def test_prefix_tables():
    import tiktoken

    ranks = read_ranks(RANKS)
    encoder = Encoder(ranks, PATTERN)
    library = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(1)
    parts = ["a", "B", " ", "  ", "\n", "\t", "'s", "'ll", "\x1c", "\x85", "\xa0", "é", "1", "²", "中", "😀", "́", "-", "...", "the", "ing", "\x00"]
    for _ in range(400):
        s, more = ("".join(rng.choice(parts) for _ in range(rng.randint(0, n))) for n in (14, 4))
        ids = encoder.encode(s)
        assert ids == b"".join(i.to_bytes(4, "little") for i in library.encode_ordinary(s))
        assert encoder.decode(ids) == s.encode() and encoder.append(s, ids, more) == encoder.encode(s + more)
    piece = Prefixes(encoder.vocabulary, b" " * 300 + b"thingaaaabb" * 40)
    piece.append(b"ings")
    piece.replace(310, 315, b"zzthe")
    assert piece.last == Prefixes(encoder.vocabulary, piece.data).last


def test_tokens_of_odd_rows(odd, nothing):
    got = {r["doc_id"]: r for r in token_digests(odd, RANKS, PATTERN).collect()}
    assert got[4]["n_tokens"] == got[5]["n_tokens"] == 0 and got[7]["n_tokens"] > 5000
    assert got[10]["decoded_sha256"] == hashlib.sha256(ODD[10][1].encode()).hexdigest()
    assert token_digests(odd, RANKS, PATTERN).count() == len(ODD)
    assert encode_documents(nothing, RANKS, PATTERN).count() == token_digests(nothing, RANKS, PATTERN).count() == 0
    assert length_report(length_histogram(nothing, RANKS, PATTERN)).count() == 0
    assert length_histogram(odd, RANKS, PATTERN).agg(F.sum("n_docs")).first()[0] == len(ODD)


def test_languages_of_odd_rows(odd, nothing):
    model = fit_languages(odd)
    got = identify_languages(odd.withColumn("score", F.lit("old")), model)
    by = {r["doc_id"]: r for r in got.collect()}
    assert got.count() == len(ODD) and set(odd.columns) < set(got.columns)
    assert {by[i]["lang_pred"] for i in (4, 5, 6, 9)} == {"und"} and by[7]["lang_pred"] == "en" and by[10]["lang_pred"] == "de"
    assert identify_languages(nothing, model).count() == 0
    assert {r["lang_pred"] for r in identify_languages(odd, fit_languages(nothing)).collect()} == {"und"}


def test_scores_of_odd_rows(odd, nothing):
    tree, unigrams = fit_tree(odd)
    got = score_documents(odd, tree, unigrams).collect()
    by = {r["doc_id"]: r for r in got}
    assert len(got) == len(ODD) and by[4]["n_tokens"] == by[5]["n_tokens"] == 1
    assert by[3]["n_known"] == by[3]["n_tokens"] == len(words(ODD[2][1])) + 1
    assert by[7]["score"] > by[7]["base_score"]
    assert score_documents(nothing, tree, unigrams).count() == 0
    tree, unigrams = fit_tree(nothing)
    assert {r["score"] for r in score_documents(odd, tree, unigrams).collect()} == {0.0}


def test_tree_is_a_distribution(spark):
    """After any context, the probabilities of all known words and of one unknown add up to one."""
    import numpy as np

    from dqspark.llm.suffixtree import token_streams

    tree, unigrams = fit_tree(spark.createDataFrame([(LONG,), ("the lazy fox",)], "text string"))
    vocabulary = [*sorted(set(words(LONG))), "unheard"]
    for context in ("", "the ", "over the ", "old woods. "):
        texts = spark.createDataFrame([(i, context + w) for i, w in enumerate([*vocabulary, ""])], "doc_id long, text string")
        got = {r["doc_id"]: r["score"] for r in score_documents(texts, tree, unigrams).collect()}
        # The last row ends after the context; the others go on to an end that is divided out.
        data = np.frombuffer(context.encode(), np.uint8)
        before = tree.score(*token_streams(data, np.array([0, len(data)])))[0][:-1].sum()
        total = 10 ** (got[len(vocabulary)] - before)
        for i, w in enumerate(vocabulary):
            own = np.frombuffer((context + w).encode(), np.uint8)
            known, frequent, _ = tree.score(*token_streams(own, np.array([0, len(own)])))
            total += 10 ** (got[i] - before - known[-1])
        assert total == pytest.approx(1, abs=1e-6)


def test_tree_learns_contexts_of_any_share(spark):
    """Three words of context that are a small part of the corpus, and the same scores by the join as on the driver."""
    import numpy as np

    from dqspark.llm import suffixtree

    rng = random.Random(9)
    noise = [(" ".join(f"n{rng.randrange(3000)}" for _ in range(2000)),) for _ in range(20)]
    pair = [(f"{a} key lock {b} {rng.random()}",) for a, b in (("red", "opens"), ("blue", "shuts")) for _ in range(40)]
    texts = spark.createDataFrame([(1, "red key lock opens"), (2, "red key lock shuts")], "doc_id long, text string")
    tree, unigrams = fit_tree(spark.createDataFrame(noise + pair, "text string"))
    got = {r["doc_id"]: r["score"] for r in score_documents(texts, tree, unigrams).collect()}
    assert got[1] > got[2] + 0.5
    before = suffixtree.WORD_PART, suffixtree.LOCAL_GRAMS
    suffixtree.WORD_PART, suffixtree.LOCAL_GRAMS = 4, 0
    try:
        few, unigrams = fit_tree(spark.createDataFrame(noise + pair, "text string"))
    finally:
        suffixtree.WORD_PART, suffixtree.LOCAL_GRAMS = before
    assert len(few.grams) == 0 and few.rare.count() == len(tree.grams)
    again = {r["doc_id"]: r["score"] for r in score_documents(texts, few, unigrams).collect()}
    assert again == pytest.approx(got)
    data = np.frombuffer(b"red key lock opens", np.uint8)
    known = tree.score(*suffixtree.token_streams(data, np.array([0, len(data)])))[0]
    assert known.sum() == pytest.approx(got[1])


def test_mix_of_odd_rows(odd, nothing):
    got = mix_sources(odd).collect()
    assert len(got) == len(ODD) and all(0 <= r["taken"] <= 2 * r["size"] for r in got)
    assert {r["taken"] for r in got if r["size"] == 0} == {0}
    assert mix_sources(nothing).count() == 0


def mixed_sources(spark):
    """A large source that leaves two small ones at twice their size: one of short documents, one of few."""
    kind = "case when id < 6000 then 'a' when id < 6600 then 'b' when id < 6620 then 'c' end"
    size = "case when id < 6000 then 20 + id % 200 when id < 6600 then 3 + id % 15 else 200 end"
    rows = spark.range(6900).selectExpr("nullif(id, 3) doc_id", f"{kind} source", f"array_join(array_repeat('w', int({size})), ' ') text")
    return rows.unionAll(rows.filter("doc_id = 7"))


def test_mix_meets_targets_of_any_source(spark):
    rows = mix_sources(mixed_sources(spark)).groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target"))
    got = rows.collect()
    assert len(got) == 4 and all(abs(r["taken"] - r["target"]) <= 2 for r in got)


def test_seats_go_to_the_highest_quotients(spark):
    rng = random.Random(3)
    for seats in (1, 7, 40, 1000):
        weights = {i: rng.choice([0, 1, 3, 50, 1000]) * rng.random() for i in range(12)} | {12: 5.0}
        quotients = sorted(((-w / (2 * k + 1), i) for i, w in weights.items() for k in range(seats) if w > 0))[:seats]
        won = {i: sum(j == i for _, j in quotients) for i in weights}
        cells = spark.createDataFrame([("g", i, w) for i, w in weights.items()], "g string, i int, w double")
        got = apportion(cells, ["g"], "w", F.lit(float(seats)), ["i"], "seats")
        assert {r["i"]: r["seats"] for r in got.collect()} == won


PAGE = (
    "<html><head><title>T</title><script>var a='</p>'</script></head><body><div class='x'>Site of all things</div>"
    "<nav><a>Home</a></nav><div id=cookie-notice>We use cookies</div>{}<aside>More</aside>"
    "<div class='comments'><p>First!</p></div><form>Name</form><footer>&copy; us</footer></body></html>"
)


def test_pages_of_odd_rows(spark):
    article = "<article><h1>A &amp; B</h1><p>One\n  <b>two</b><br>three<div class='ad'>Buy</div><p>Four<ul><li>5<li>6</ul></article>"
    plain = "<div><p>Only text number {}</p>and <span>more {}</span></div>"
    rows = [(i, f"http://h.example/{i}", PAGE.format(plain.format(i, i)), "k") for i in range(5)]
    rows += [(10, "http://a.example/", PAGE.format(article), "k"), (11, None, PAGE.format(article), None)]
    rows += [(12, "http://a.example/2", None, "k"), (13, "x", "", "k"), (14, "http://b.example", "<p>open <a href='", "k"), (14, "http://b.example", "<p>open <a href='", "k")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, n_chars string")
    got = extract_pages(pages)
    by = {r["page_id"]: r["text"] for r in got.collect()}
    assert by[10] == by[11] == "A & B\nOne two three\nFour\n5\n6"
    assert by[3] == "Only text number 3\nand more 3"  # the site's name is in the template
    assert by[12] == by[13] == "" and by[14] == "open" and got.count() == len(rows)
    assert extract_pages(pages.limit(0)).count() == 0

"""The source audit against whole-number arithmetic in plain Python."""

import collections
import random
import re

import numpy as np

from dqspark.llm import divergence as module
from dqspark.llm.divergence import audit_sources, shares

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
NAMES = ["lang", "source", "part", "item", "value", "rank"]


def terms(text):
    return re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOW))


def brute(rows, least=3, top=200):
    rows = [(lang or "", source or "", terms(text)) for lang, source, text in rows]
    out = []
    for lang in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == lang]
        having = collections.Counter(t for r in mine for t in set(r[2]))
        kept = {t for t, n in having.items() if n >= least}
        counts = {s: collections.Counter() for s in {r[1] for r in mine}}
        for _, s, ts in mine:
            counts[s].update(t for t in ts if t in kept)

        def p(count, n, kept=kept):
            return 1 + 10**9 * (count + 1) // (n + len(kept))

        whole = sum(counts.values(), collections.Counter())
        for g, own in counts.items():
            pairs = []
            for h, other in counts.items():
                if g != h:
                    n, m = own.total(), other.total()
                    pairs.append((h, sum((p(own[t], n) - p(other[t], m)) ** 2 // p(other[t], m) for t in kept)))
            found = []
            for t, c in own.items():
                a, q = p(c, own.total()), p(whole[t], whole.total())
                if c and a > q:
                    found.append((t, (a - q) ** 2 // q))
            for part, values in (("pair", pairs), ("term", found)):
                values.sort(key=lambda v: (-v[1], v[0].encode()))
                out += [(lang, g, part, *v, i) for i, v in enumerate(values, 1) if part == "pair" or i <= top]
    return sorted(out)


def run(spark, rows, **options):
    docs = spark.createDataFrame(rows, "lang string, source string, text string")
    found = audit_sources(docs, **options)
    assert found.columns == NAMES
    return sorted(tuple(r) for r in found.collect())


def corpus():
    rng = random.Random(3)
    words = [f"{a}{b}" for a in "abcdeÄöß" for b in ("x", "Yy", "z", "é", "日本")]
    rows = []
    for i in range(160):
        source = rng.choice(["s1", "s2", "s3", "s3", "s3", None, ""])
        weights = [1 + (j * (i % 7)) % 11 for j in range(len(words))]
        rows.append((rng.choice(["en", "de", None]), source, " ,\n9".join(rng.choices(words, weights, k=rng.randint(0, 60)))))
    return [*rows, rows[4], ("xx", "alone", "one two"), ("yy", "s1", None), ("yy", "s2", "12 !?"), ("en", "mute", None), (None, None, None)]


def test_audit_equals_brute_force(spark):
    rows = corpus()
    assert run(spark, rows) == brute(rows)


def test_shards_and_flushed_counts_change_nothing(spark, monkeypatch):
    rows = corpus()
    for name, value in (("SHARD_ROWS", 16), ("CELLS", 8), ("HELD_ROWS", 4), ("CHUNK_BYTES", 64)):
        monkeypatch.setattr(module, name, value)
    assert run(spark, rows, terms=5) == brute(rows, top=5)


def test_shares_beyond_64_bits():
    counts = np.array([0, 5, 10**14, 3 * 10**14])
    total = int(counts.sum())
    assert shares(counts, np.int64(total), 4).tolist() == [1 + 10**9 * (c + 1) // (total + 4) for c in counts.tolist()]


def test_odd_rows_and_empty_table(spark, odd, nothing):
    rows = [(r["lang"], r["source"], r["text"]) for r in odd.collect()]
    assert sorted(tuple(r) for r in audit_sources(odd).collect()) == brute(rows)
    assert audit_sources(nothing).collect() == []

"""LM scoring by a probabilistic suffix tree over words.

A state is a context of up to ``DEPTH`` preceding words. Contexts and next symbols that occur ``LEAST`` times are
candidates, whatever the size of the corpus; a context is retained if its next-symbol distribution diverges from
its parent's by enough for its count. A state keeps the counts of its next symbols, less a discount; what is left
over goes to the parent in proportion, down to the smoothed unigrams.

A context and a context with its next symbol are both runs of words, "grams". The probability of a token after its
longest retained suffix is its unigram's, times the left-over share of every retained suffix before it, times, for
every retained suffix that has the token as a symbol, the factor by which it raises what its parent says. So the
tree is a table of grams with the logarithms of these, partitioned by the hash of the gram, and the score of a text
is the sum over its grams. It grows with the corpus and is joined, as the unigrams are. The most frequent words and
grams, a bounded number, are sent to every executor; a bitmap of fixed size tells there which other grams may be in the table.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dqspark.llm._arrow import chunks, mix, word_hashes
from dqspark.plans.storage import Scratch, stored

DEPTH = 3
LEAST = 4
"""Occurrences of a context or of a symbol after it below which neither is counted."""
BITS = 26
"""Bitmaps have ``2 ** BITS`` bits. They only keep rows from the shuffles, no result depends on them."""
BUCKET_TOKENS = 2**18
"""Grams are counted in buckets, one for so many tokens of the corpus, of which a task holds one at a time."""
ASKED_TOKENS = 2**22
"""Weights are looked up in buckets, one for so many tokens of the corpus."""
BLOCK = 2**19
"""Rows are scored in blocks, each of which asks for about so many weights."""
LOCAL_GRAMS = 2**20
"""At most so many grams of the tree and so many words, the most frequent ones, are sent to every executor."""
WORD_PART = 2**18
"""Words and grams that are one in so many of all tokens are sent in any case."""
DISCOUNT = 0.75
LEAST_DIVERGENCE = 10.0
"""Nats gained over the parent, times the context's count, for a context to be retained."""
END = mix(np.array([0x5E3D], np.uint64))[0]
SECOND = np.uint64(0xA0761D6478BD642F)
CHUNK = 1 << 21
SPAN = 1 << 18
"""Words are hashed in runs of rows of about this many bytes, whose working arrays stay in the processor's cache."""
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def token_streams(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the tokens of each row, its words and then the end, and their number by row."""
    row, out = 0, []
    while row < len(at) - 1:
        end = max(row + 1, int(np.searchsorted(at, at[row] + SPAN, "right")) - 1)
        out.append(_tokens(data[at[row] : at[end]], at[row : end + 1] - at[row]))
        row = end
    if not out:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate([tokens for tokens, _ in out]), np.concatenate([counts for _, counts in out])


def _tokens(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    words, counts = word_hashes(data, at)
    ends = np.cumsum(counts + 1) - 1
    tokens = np.full(len(words) + len(counts), END, np.uint64)
    inside = np.ones(len(tokens), bool)
    inside[ends] = False
    tokens[inside] = words
    return tokens, counts + 1


def grams(tokens: np.ndarray, counts: np.ndarray, size: int) -> list[np.ndarray]:
    """The hashes of the runs of 1 to ``size`` tokens that end at each token; 0 where a row has too few before it.

    The hash of a run is that of the run without its last token and of the run without its first.
    """
    first = np.zeros(len(tokens), bool)
    first[np.cumsum(counts) - counts] = True
    out = [tokens]
    for _ in range(size - 1):
        own, last = np.zeros(len(tokens), np.uint64), out[-1]
        own[1:] = np.where((last[1:] != 0) & (last[:-1] != 0), pair(last[:-1], last[1:]), 0)
        own[first] = 0
        out.append(own)
    return out


def pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mix(a * SECOND + b)


def ordered(values: np.ndarray) -> np.ndarray:
    """Places of the values in ascending order: sorts their first bits with the place as one number, which is faster."""
    bits = np.uint64(max(len(values) - 1, 1).bit_length())
    places = np.arange(len(values), dtype=np.uint64)
    order = np.sort((values >> bits << bits) | places) & ((np.uint64(1) << bits) - np.uint64(1))
    order = order.astype(np.int64)
    found = values[order]
    # Different values may share their first bits.
    return order if (found[1:] >= found[:-1]).all() else np.argsort(values, kind="stable")


def packed(values: np.ndarray) -> bytes:
    """The first bytes of all values, then the second ones and so on, which leaves runs of zeros for Spark to compress."""
    return values.view(np.uint8).reshape(-1, values.itemsize).T.tobytes()


def unpacked(data: bytes, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, -1).T).view(kind).ravel()


class Lookup:
    """Finds values in a sorted table of hashes, from the place where those of the same first bits begin."""

    def __init__(self, table: np.ndarray):
        self.table = table
        self.first: np.ndarray | None = None

    def __getstate__(self) -> dict:
        return {"table": self.table, "first": None}

    def __call__(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which values are there, and their places in the table."""
        if not len(self.table):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        if self.first is None:
            bits = len(self.table).bit_length() + 1
            self.shift, self.some_shift = np.uint64(64 - bits), np.uint64(61 - bits)
            self.first = np.searchsorted(self.table, np.arange(2**bits, dtype=np.uint64) << self.shift).astype(np.int32)
            self.some = np.zeros(2 ** (bits + 3), bool)
            self.some[self.table >> self.some_shift] = True
            self.ended = np.append(self.table, np.uint64(2**64 - 1))
        at = np.flatnonzero(self.some[values >> self.some_shift])
        own = values[at]
        place = self.first[own >> self.shift]
        left = np.flatnonzero(self.ended[place] < own)
        while len(left):
            place[left] += 1
            left = left[self.ended[place[left]] < own[left]]
        found = (self.ended[place] == own) & (place < len(self.table))
        return at[found], place[found]


class Numbered:
    """Frequent words by number, the more frequent ones first."""

    def __init__(self, words: np.ndarray, often: np.ndarray):
        self.words = words[np.argsort(-often, kind="stable")]
        self.numbers = np.argsort(self.words).astype(np.int32)
        self.places = Lookup(self.words[self.numbers])

    def __call__(self, tokens: np.ndarray) -> np.ndarray:
        """The numbers of tokens, -1 for others."""
        out = np.full(len(tokens), -1, np.int32)
        for first in range(0, len(tokens), SPAN):
            at, place = self.places(tokens[first : first + SPAN])
            out[first + at] = self.numbers[place]
        return out

    def ends(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The hashes of runs of words, one to a row, without their last and without their first word."""
        own = list(self.words[numbers].T)
        while len(own) > 2:
            own = [pair(a, b) for a, b in zip(own[:-1], own[1:], strict=True)]
        return own[0], own[1]


@contextmanager
def _shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Within, Spark deletes the shuffle files of each query when it ends: the fit reads only what it has stored."""
    before = spark.conf.get(DROP_SHUFFLES, None)
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(DROP_SHUFFLES)
        else:
            spark.conf.set(DROP_SHUFFLES, before)


def _unigrams(texts: DataFrame) -> DataFrame:
    """``(token, n)``: how often the tokens of a table of texts occur."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, at in chunks(batch.column(0), CHUNK * 4):
                tokens, n = np.unique(token_streams(data, at)[0], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(tokens.view(np.int64)), pa.array(n)], ["token", "n"])

    return texts.mapInArrow(read, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))


def bitmap(rows: DataFrame, column: str) -> np.ndarray:
    """Two bits for each hash in a column, of ``2 ** BITS``, so what reaches the driver is bounded."""
    both = [c.bitwiseAND(F.lit(2**BITS - 1)).cast("int") for c in (F.col(column), F.shiftrightunsigned(column, BITS))]
    places = rows.select(F.explode(F.array(*both)).alias("place"))
    bits = places.select(F.shiftright("place", 5).alias("at"), F.expr("shiftleft(1, place & 31)").alias("bit"))
    found = bits.groupBy("at").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(2 ** (BITS - 5), np.uint32)
    out[found["at"].to_numpy()] = found["bits"].to_numpy().view(np.uint32)
    return out


def may_have(bits: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Whether the values may be among those of a bitmap; false only for those that aren't."""

    def has(values: np.ndarray) -> np.ndarray:
        at = (values & np.uint64(2**BITS - 1)).astype(np.uint32)
        return (bits[at >> np.uint32(5)] >> (at & np.uint32(31))) & np.uint32(1) > 0

    out = has(values)
    first = np.flatnonzero(out)
    out[first] = has(values[first] >> np.uint64(BITS))
    return out


class SuffixTree:
    """The frequent part of a tree as sorted arrays, and ``rare``, the table ``(gram, weight)`` of its other grams.

    ``symbols`` is what a frequent gram adds to the log10 probability of its last token, ``states`` what it adds
    to that of the next one. ``frequent`` are the tokens that have the log10 of their unigram here, those that
    occur ``least`` times; ``whole`` tells that there are no others.
    """

    def __init__(self, total: int, distinct: int, words: np.ndarray, counts: np.ndarray, least: int = 0):
        order = np.argsort(words)
        self.frequent, self.least, self.whole = words[order], least, len(words) == distinct
        self.total, self.scale = total, math.log10(total + 0.5 * (distinct + 1))
        self.logs = np.log10(counts[order] + 0.5) - self.scale
        self.words = Lookup(self.frequent)
        self.hold(np.zeros(0, np.uint64), np.zeros(0), np.zeros(0))
        self.bits: np.ndarray | None = None
        self.rare: DataFrame | None = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"rare": None}

    def hold(self, ids: np.ndarray, symbols: np.ndarray, states: np.ndarray) -> None:
        """Takes the frequent grams."""
        order = np.argsort(ids)
        self.grams, self.symbols, self.states = ids[order], symbols[order], states[order]
        self.places = Lookup(self.grams)

    @property
    def unknown(self) -> float:
        """log10 of the unigram of a token that isn't in the corpus."""
        return math.log10(0.5) - self.scale

    def score(
        self, tokens: np.ndarray, counts: np.ndarray, runs: list[np.ndarray] | None = None
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """By token: log10 of what is known of its probability here, whether it is frequent, and log10 of its unigram.

        That of a token that isn't frequent is what its frequent states leave to their parents. Its unigram and
        the weights of the grams that aren't frequent are left for the join. ``runs`` are the grams, if made before.
        """
        base, frequent = np.zeros(len(tokens)), np.zeros(len(tokens), bool)
        at, place = self.words(tokens)
        base[at], frequent[at] = self.logs[place], True
        known = base.copy()
        for own in runs or grams(tokens, counts, DEPTH + 1):
            at, place = self.places(own)
            known[at] += self.symbols[place]
            # A gram that ends in the end of a text is no state, so this adds nothing to the next row.
            after = at + 1 < len(tokens)
            known[at[after] + 1] += self.states[place[after]]
        return known, frequent, base

    def others(self, runs: list[np.ndarray], frequent: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places and hashes of the tokens that aren't frequent but may be in the corpus, and of the grams that may be in the table."""
        at, found = [], []
        for size, own in enumerate(runs, 1):
            wanted = may_have(self.bits, own) & (own != 0) if self.bits is not None else np.zeros(len(own), bool)
            if size == 1 and not self.whole:
                wanted |= ~frequent
            here = np.flatnonzero(wanted)
            at.append(here)
            found.append(own[here])
        return np.concatenate(at), np.concatenate(found)


def fit_tree(texts: DataFrame, text: str = "text") -> tuple[SuffixTree, DataFrame]:
    """The tree and the table ``(token, n)`` of unigrams, which has a row for each distinct token.

    Counts cover all rows; tasks add up their own before the shuffle. A gram occurs ``LEAST`` times only if
    the grams without its first and without its last token do, so bitmaps of these leave out most others
    before the shuffle. Frequent tokens and grams come to the driver: by their part of the total, there are at most
    ``WORD_PART`` of each length, else of tokens and of grams no more than ``LOCAL_GRAMS``.
    """
    with _shuffles_dropped(texts.sparkSession):
        return _fit(texts, text)


def _fit(texts: DataFrame, text: str) -> tuple[SuffixTree, DataFrame]:
    rows = texts.select(F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    unigrams = stored(_unigrams(rows), "unigrams")
    total, distinct = unigrams.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    tree, empty = _frequent(unigrams, total, distinct)
    if empty:
        return tree, unigrams
    with Scratch(texts.sparkSession) as scratch:
        weights = _weights(rows, unigrams, tree, scratch)
        if not weights:
            return tree, unigrams
        table = reduce(DataFrame.unionAll, weights).groupBy("gram").agg(
            F.sum("symbol").alias("symbol"), F.sum("state").alias("state"), F.max("size").alias("n")
        )
        table = stored(table, "tree")
    local = F.col("n") >= _least_local(table, total)
    top = table.filter(local).select("gram", "symbol", "state").toArrow()
    tree.hold(top["gram"].to_numpy().view(np.uint64), top["symbol"].to_numpy(), top["state"].to_numpy())
    tree.rare = table.filter(~local).select("gram", (F.col("symbol") + F.col("state")).alias("weight"))
    if not tree.rare.isEmpty():
        tree.bits = bitmap(tree.rare, "gram")
    return tree, unigrams


def _least_local(table: DataFrame, total: int) -> int:
    """The count ``n`` from which on a gram or token is frequent: the least of some, by which no more than ``LOCAL_GRAMS`` are.

    The last of them is one in ``WORD_PART`` of all tokens, which by itself bounds their number.
    """
    last = -(-total // WORD_PART)
    least = [0, LEAST]
    while least[-1] < last:
        least.append(-(-least[-1] * 5 // 4))
    least = [n for n in least if n < last] + [last]
    found = table.agg(*[F.count_if(F.col("n") >= n) for n in least]).first()
    return next((n for n, count in zip(least, found, strict=True) if count <= LOCAL_GRAMS), last)


def _weights(rows: DataFrame, unigrams: DataFrame, tree: SuffixTree, scratch: Scratch) -> list[DataFrame]:
    """``(gram, symbol, state, size)`` of the retained states and of their symbols, by length."""
    # The log10 probability of the last token of each gram after the others.
    known = unigrams.filter(F.col("n") >= LEAST).select(
        F.col("token").alias("gram"), "n", (F.log10(F.col("n") + 0.5) - tree.scale).alias("p")
    )
    known = scratch.stored(known, "grams")
    words = rows.sparkSession.sparkContext.broadcast(Numbered(tree.frequent, tree.logs))
    weights = []
    for level in range(1, DEPTH + 1):
        with Scratch(rows.sparkSession) as own:
            bits = rows.sparkSession.sparkContext.broadcast(bitmap(known, "gram"))
            found = own.stored(_grams_of(rows, bits, words, level, tree.total), "counted")
            bits.destroy()
            if found.isEmpty():
                break
            states, known = _level(found, known, tree.total, own, scratch)
        weights += [
            states.select("gram", F.lit(0.0).alias("symbol"), F.log10("rest").alias("state"), "size"),
            known.filter("rest is not null").select(
                "gram", (F.col("p") - F.col("below") - F.log10("rest")).alias("symbol"), F.lit(0.0).alias("state"),
                F.col("n").alias("size"),
            ),
        ]
    words.destroy()
    return weights


def _grams_of(rows: DataFrame, bits: Broadcast[np.ndarray], words: Broadcast[Numbered], level: int, total: int) -> DataFrame:
    """``(gram, prefix, suffix, n)`` of the grams of ``level + 1`` tokens that occur often enough.

    Tasks send what they have counted as lists, one for each bucket of hashes, so the shuffle has few rows. A gram of
    frequent words only is sent as their numbers, any other as the hashes ``prefix`` and ``suffix`` with the count ``m``.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(parts, total // BUCKET_TOKENS + 1)
    names = ["bucket", "low", "high", "n", "prefix", "suffix", "m"]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, at in chunks(batch.column(0), CHUNK * 4):
                tokens, counts = token_streams(data, at)
                own = grams(tokens, counts, level + 1)[level - 1 :]
                ends, whole = own[0], own[1] != 0
                held = may_have(bits.value, ends)
                at = np.flatnonzero(whole[1:] & held[1:] & held[:-1]) + 1
                if not len(at):
                    continue
                found = own.pop()[at]
                order = ordered(found)
                found, at = found[order], at[order]
                starts = np.flatnonzero(np.append(True, found[1:] != found[:-1]))
                n = np.diff(np.append(starts, len(found)))
                found, at = found[starts], at[starts]
                bucket = (((found >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int32)
                sent = bucket[np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))]
                numbers = words.value(tokens)
                runs = np.stack([numbers[at - i] for i in range(level, -1, -1)], 1)
                whole = (runs >= 0).all(1)
                runs, others = runs[whole].ravel(), at[~whole]
                columns = [
                    (whole, (runs & 0xFFFF).astype(np.uint16).view(np.int16), level + 1),
                    (whole, (runs >> 16).astype(np.int8), level + 1),
                    (whole, n[whole].astype(np.int32), 1),
                    (~whole, ends[others - 1].view(np.int64), 1),
                    (~whole, ends[others].view(np.int64), 1),
                    (~whole, n[~whole].astype(np.int32), 1),
                ]
                lists = [
                    pa.ListArray.from_arrays(pa.array((np.searchsorted(bucket[of], np.append(sent, buckets)) * wide).astype(np.int32)), v)
                    for of, v, wide in columns
                ]
                yield pa.RecordBatch.from_arrays([pa.array(sent), *lists], names)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []
        current = -1

        def flush() -> Iterator[pa.RecordBatch]:
            if held:
                low, high, n, prefix, suffix, m = (np.concatenate(c) for c in zip(*held, strict=True))
                numbers = low.view(np.uint16).astype(np.int32) | high.astype(np.int32) << 16
                first, last = words.value.ends(numbers.reshape(-1, level + 1))
                prefix, suffix = np.append(first.view(np.int64), prefix), np.append(last.view(np.int64), suffix)
                n = np.append(n, m)
                gram = pair(prefix.view(np.uint64), suffix.view(np.uint64))
                order = ordered(gram)
                starts = np.flatnonzero(np.append(True, gram[order][1:] != gram[order][:-1]))
                n = np.add.reduceat(n[order].astype(np.int64), starts)
                at = order[starts[n >= LEAST]]
                values = gram[at].view(np.int64), prefix[at], suffix[at], n[n >= LEAST]
                held.clear()
                yield pa.RecordBatch.from_arrays([pa.array(v) for v in values], ["gram", "prefix", "suffix", "n"])

        for batch in batches:
            bucket = batch.column(0).to_numpy()
            for begin in np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(bucket) else ():
                if bucket[begin] != current:
                    yield from flush()
                    current = int(bucket[begin])
                end = int(np.searchsorted(bucket, current, "right"))
                held.append([c.slice(begin, end - begin).flatten().to_numpy() for c in batch.columns[1:]])
        yield from flush()

    kinds = "array<short>, array<byte>, array<int>, array<long>, array<long>, array<int>".split(", ")
    schema = ", ".join(f"{a} {b}" for a, b in zip(names, ["int", *kinds], strict=True))
    sent = rows.mapInArrow(count, schema)
    sent = sent.repartitionById(parts, F.col("bucket") % parts).sortWithinPartitions("bucket")
    return sent.mapInArrow(add, "gram long, prefix long, suffix long, n long")


def _by_gram(rows: DataFrame, table: DataFrame, key: str, total: int) -> DataFrame:
    """Inner join with ``table``, which has a row and the count ``size`` of each gram.

    A gram of ``size`` occurrences is in ``size / LEAST`` rows at most. So only the frequent ones, of which there are
    ``WORD_PART`` at most, might fill a task; they are broadcast.
    """
    often = F.col("size") * WORD_PART >= total
    few = F.broadcast(table.filter(often))
    rest = rows.join(few.select(key), key, "left_anti").join(table.filter(~often), key)
    return rows.join(few, key).unionAll(rest)


def _level(found: DataFrame, known: DataFrame, total: int, own: Scratch, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """The retained states ``(gram, rest, size)`` of one length, and ``(gram, n, p, below, rest)`` of their symbols.

    ``p`` is the log10 probability of a gram's last token after the others, ``below`` that of the parent. Grams of
    states that aren't retained have no ``rest`` and the parent's ``p``. What is read later is in ``scratch``.
    """
    parents = known.select(F.col("gram").alias("suffix"), F.col("p").alias("below"), F.col("n").alias("size"))
    both = own.stored(_by_gram(found, parents, "suffix", total).drop("suffix", "size"), "below")
    sizes = known.select(F.col("gram").alias("prefix"), F.col("n").alias("size"))
    shares = both.groupBy("prefix").agg(
        F.sum(F.col("n") - DISCOUNT).alias("held"), F.sum(F.pow(F.lit(10.0), F.col("below"))).alias("other")
    )
    shares = shares.join(sizes, "prefix")
    shares = own.stored(shares.select("prefix", "size", (1 - F.col("held") / F.col("size")).alias("rest"), "other"), "shares")
    below = F.pow(F.lit(10.0), F.col("below"))
    mixed = (F.col("n") - DISCOUNT) / F.col("size") + F.col("rest") * below
    tried = own.stored(_by_gram(both, shares, "prefix", total).withColumn("mixed", mixed), "tried")
    states = tried.groupBy("prefix").agg(
        F.first("size").alias("size"), F.first("rest").alias("rest"), F.first("other").alias("other"),
        F.sum("mixed").alias("sum"), F.sum(F.col("mixed") * F.log(F.col("mixed") / below)).alias("gain"),
    )
    lost, left = F.greatest(1 - F.col("sum"), F.lit(1e-12)), F.greatest(1 - F.col("other"), F.lit(1e-12))
    gain = F.col("size") * (F.col("gain") + lost * F.log(lost / left))
    states = states.filter(gain >= LEAST_DIVERGENCE).select(F.col("prefix").alias("gram"), "rest", "size")
    states = scratch.stored(states, "states")
    often = F.col("size") * WORD_PART >= total
    kept = [states.filter(c).select(F.col("gram").alias("prefix"), F.lit(True).alias("kept")) for c in (often, ~often)]
    marked = tried.filter(often).join(F.broadcast(kept[0]), "prefix", "left")
    marked = marked.unionAll(tried.filter(~often).join(kept[1], "prefix", "left"))
    symbols = marked.select(
        "gram", "n", F.when(F.col("kept"), F.log10("mixed")).otherwise(F.col("below")).alias("p"), "below",
        F.when(F.col("kept"), F.col("rest")).alias("rest"),
    )
    return states, scratch.stored(symbols, "grams")


def _frequent(unigrams: DataFrame, total: int, distinct: int) -> tuple[SuffixTree, bool]:
    least = _least_local(unigrams, total)
    top = unigrams.filter(F.col("n") >= least).toArrow()
    return SuffixTree(total, distinct, top["token"].to_numpy().view(np.uint64), top["n"].to_numpy(), least), total == 0


def score_documents(docs: DataFrame, tree: SuffixTree, unigrams: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, n_tokens, n_known, train_tokens, base_score, score)`` of every row; other columns aren't read.

    ``base_score`` is the log10 probability by smoothed unigrams, ``score`` that by the longest suffix states. Frequent
    tokens are scored where the text is. The others and the grams that may be in the table are asked for by blocks of
    rows, in lists by bucket of hashes; each bucket sends its sums by row back to the block. Rows are numbered in their
    block, so repeated rows have scores of their own. NULL and empty texts are one token, the end. Without any training
    token, every token has the probability 1 of the one unknown type. An empty table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(tree)
    buckets = tree.total // ASKED_TOKENS + 1
    # A row has what is known of a block, or else what it asks of a bucket.
    own = "id array<long>, n_tokens array<long>, known array<long>, base array<double>, part array<double>"
    names = [c.split()[0] for c in own.split(", ")]

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, block, rows, held, asked = shared.value, -1, 0, [], []

        def flush() -> pa.RecordBatch:
            at, keys = (np.concatenate(c) for c in zip(*asked, strict=True))
            order = ordered(keys)
            at, keys = at[order], keys[order]
            new = np.ones(len(keys), bool)
            new[1:] = (keys[1:] != keys[:-1]) | (at[1:] != at[:-1])
            starts = np.flatnonzero(new)
            times = np.diff(np.append(starts, len(keys))).astype(np.uint32)
            at, keys = at[starts], keys[starts]
            bucket = (((keys >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int32)
            cuts = np.append(np.flatnonzero(np.diff(bucket, prepend=-1)), len(bucket))
            out = [
                (packed(at[a:b]), packed(np.diff(keys[a:b], prepend=np.uint64(0))), packed(times[a:b]))
                for a, b in zip(cuts[:-1], cuts[1:], strict=True)
            ]
            lists = [pa.concat_arrays(c) for c in zip(*held, strict=True)]
            lists = [pa.ListArray.from_arrays(pa.array([0, rows], pa.int32()), c) for c in lists]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(np.append(bucket[cuts[:-1]], block % buckets).astype(np.int32)),
                    pa.array(np.full(len(cuts), block)),
                    *[pa.array([*c, None], pa.binary()) for c in (zip(*out, strict=True) if out else [()] * 3)],
                    *[pa.concat_arrays([pa.nulls(len(out), c.type), c]) for c in lists],
                ],
                ["bucket", "block", "rows", "gaps", "times", *names],
            )

        for batch in batches:
            for first, end, data, at in chunks(batch.column(2), CHUNK):
                # Of the partition's number and that of the block in it.
                block = batch.column(0)[0].as_py() << 32 if block < 0 else block
                tokens, counts = token_streams(data, at)
                row = np.repeat(np.arange(len(counts)), counts)
                runs = grams(tokens, counts, DEPTH + 1)
                known, frequent, base = tree.score(tokens, counts, runs)
                sums = [np.bincount(row, weights=w, minlength=len(counts)) for w in (known, base, frequent)]
                # For the others, the buckets add what their unigrams have more than that of an unknown token.
                missed = (counts - sums[2]) * tree.unknown
                values = counts.astype(np.int64), sums[2].astype(np.int64), sums[1] + missed, sums[0] + missed
                held.append([batch.column(1)[first:end], *map(pa.array, values)])
                place, others = tree.others(runs, frequent)
                asked.append(((row[place] + rows).astype(np.uint32), others))
                rows += len(counts)
                if max(rows, sum(len(keys) for _, keys in asked)) >= BLOCK:
                    yield flush()
                    block, rows, held, asked = block + 1, 0, [], []
        if held:
            yield flush()

    def answer(asks: pa.Table, table: pa.Table) -> pa.Table:
        tokens, n = table["key"].to_numpy().view(np.uint64), table["n"].to_numpy()
        keys, place = np.unique(tokens, return_inverse=True)
        # A token is also the gram of its length, so a key may have a row of either kind.
        known, base = (np.bincount(place, w, len(keys)) for w in (n > 0, np.log10(n + 0.5) - math.log10(0.5)))
        weight = base + np.bincount(place, table["weight"].to_numpy(), len(keys))
        block, out = [], []
        for row in asks.filter(pc.is_valid(asks["rows"])).select(["block", "rows", "gaps", "times"]).to_pylist() if len(keys) else ():
            at, times = unpacked(row["rows"], np.uint32), unpacked(row["times"], np.uint32)
            wanted = np.cumsum(unpacked(row["gaps"], np.uint64), dtype=np.uint64)
            place = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
            hit = keys[place] == wanted
            at, times, place = at[hit], times[hit], place[hit]
            at, slot = np.unique(at, return_inverse=True)
            sums = [np.bincount(slot, times * w[place], len(at)) for w in (known, base, weight)]
            block.append(row["block"])
            out.append((packed(at), packed(sums[0].astype(np.uint32)), packed(sums[1]), packed(sums[2])))
        sent = asks.filter(pc.is_null(asks["rows"])).select(["block", *names])
        found = pa.table([pa.array(block, pa.int64()), *[pa.array(c, pa.binary()) for c in (zip(*out, strict=True) if out else [()] * 4)]],
                         ["block", "rows", "more", "base_more", "part_more"])
        return pa.concat_tables([sent, found], promote_options="default")

    def merge(sent: pa.Table) -> pa.Table:
        whole = sent.filter(pc.is_null(sent["rows"]))
        doc, tokens, known, base, part = (whole[c].combine_chunks().flatten() for c in names)
        known, base, part = (c.to_numpy().copy() for c in (known, base, part))
        for row in sent.filter(pc.is_valid(sent["rows"])).select(["rows", "more", "base_more", "part_more"]).to_pylist():
            at = unpacked(row["rows"], np.uint32)
            known[at] += unpacked(row["more"], np.uint32)
            base[at] += unpacked(row["base_more"], np.float64)
            part[at] += unpacked(row["part_more"], np.float64)
        return pa.table([doc, tokens, *map(pa.array, (known, base, part))], ["doc_id", "n_tokens", "n_known", "base_score", "score"])

    source = docs.select(
        F.spark_partition_id().alias("at"), F.col(doc_id).cast("long").alias("id"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    )
    asks = source.mapInArrow(ask, f"bucket int, block long, rows binary, gaps binary, times binary, {own}")
    table = unigrams.filter(F.col("n") < tree.least).select(F.col("token").alias("key"), "n", F.lit(0.0).alias("weight"))
    if tree.bits is not None:
        table = table.unionAll(tree.rare.select(F.col("gram").alias("key"), F.lit(0).cast("long").alias("n"), "weight"))
    bucket = F.shiftright(F.shiftrightunsigned("key", 32) * F.lit(buckets), 32).cast("int")
    sent = asks.groupBy("bucket").cogroup(table.withColumn("bucket", bucket).groupBy("bucket")).applyInArrow(
        answer, f"block long, {own}, rows binary, more binary, base_more binary, part_more binary"
    )
    scored = sent.groupBy("block").applyInArrow(
        merge, "doc_id long, n_tokens long, n_known long, base_score double, score double"
    )
    return scored.select("doc_id", "n_tokens", "n_known", F.lit(tree.total).cast("long").alias("train_tokens"), "base_score", "score")

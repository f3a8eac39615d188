"""Source divergence audit: how far the words of each source are from those of other sources and of its language.

Texts go through Arrow kernels inside each task: ``ascii_lower``, ``split_pattern_regex``, ``dictionary_encode`` and
a hash ``group_by`` give partial counts by language, source and term, added up within the task before they are
shuffled. The counts of the kept terms are then dealt by term into shards of bounded size; a shard holds all counts
of its terms as columns of one array, works out its part of every divergence with whole numbers, and its best terms.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dqspark.plans.joins import quoted
from dqspark.plans.storage import stored

LEAST_DOCUMENTS = 3
TERMS = 200
ONE = 10**9
NO_LETTERS = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
CHUNK_BYTES = 4 << 20
HELD_ROWS = 1 << 18
"""A task sends its partial counts on when it holds so many."""
SHARD_ROWS = 1 << 17
"""Counts in a shard, about; a term's counts stay together, one for each source."""
CELLS = 1 << 21
COUNTS = "lang string, source string, term string, n long, docs long"


def text_slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Runs of rows whose texts are about ``CHUNK_BYTES``, or one row, so that the kernels' output stays small."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(2)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    row, before = 0, 0
    while row < batch.num_rows:
        end = max(row + 1, int(np.searchsorted(sizes, before + CHUNK_BYTES, "right")))
        yield batch.slice(row, end - row)
        row, before = end, sizes[end - 1]


def counted(rows: pa.RecordBatch) -> pa.Table:
    """Partial counts ``(lang, source, term, n, docs)`` of some documents.

    Each (lang, source) has a row with a NULL term and the number 0 besides, so that none is lost for want of terms.
    """
    words = pc.split_pattern_regex(pc.ascii_lower(rows.column(2)), pattern=NO_LETTERS)
    groups = pa.table({"lang": rows.column(0), "source": rows.column(1)}).group_by(["lang", "source"], use_threads=False).aggregate([])
    empty = pa.nulls(groups.num_rows, pa.string())
    zeros = pa.array(np.zeros(groups.num_rows, np.int64))
    none = groups.append_column("term", empty).append_column("n", zeros).append_column("docs", zeros)
    term = pc.list_flatten(words).dictionary_encode()
    by_row = pa.table({"row": pc.list_parent_indices(words), "term": term.indices, "one": pa.repeat(1, len(term))})
    by_row = by_row.group_by(["row", "term"], use_threads=False).aggregate([("one", "sum")])
    each = pa.table({
        "lang": rows.column(0).take(by_row["row"]),
        "source": rows.column(1).take(by_row["row"]),
        "term": by_row["term"],
        "n": by_row["one_sum"],
    })
    each = each.group_by(["lang", "source", "term"], use_threads=False).aggregate([("n", "sum"), ("n", "count")])
    each = each.rename_columns(["lang", "source", "term", "n", "docs"])
    # The split leaves an empty piece before and after separators at either end.
    each = each.set_column(2, "term", pc.take(term.dictionary, each["term"]))
    return pa.concat_tables([each.filter(pc.not_equal(each["term"], "")), none])


def merged(tables: list[pa.Table]) -> pa.Table:
    both = pa.concat_tables(tables).group_by(["lang", "source", "term"], use_threads=False)
    both = both.aggregate([("n", "sum"), ("docs", "sum")])
    return both.rename_columns(["lang", "source", "term", "n", "docs"])


def _partial_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[pa.Table] = []
    size = 0
    for batch in batches:
        for rows in text_slices(batch):
            held.append(counted(rows))
            size += held[-1].num_rows
            if size > 2 * HELD_ROWS:
                held = [merged(held)]
                size = held[0].num_rows
                if size > HELD_ROWS:
                    yield from held[0].to_batches()
                    held, size = [], 0
    if held:
        yield from merged(held).to_batches()


def term_counts(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """``(lang, source, term, n, docs)``: occurrences, and documents, of each term in each group.

    Terms are runs of ASCII letters and of characters beyond ASCII, with A-Z lower-cased. Every group has a row with a
    NULL term. NULL is the empty text.
    """
    columns = [F.coalesce(F.col(quoted(c)).cast("string"), F.lit("")) for c in (lang, source, text)]
    rows = docs.select(*[c.alias(n) for c, n in zip(columns, ("lang", "source", "text"), strict=True)])
    parts = rows.mapInArrow(_partial_counts, COUNTS)
    # Dealt by term, not by group: a term's groups meet, and no task gets all of a large language or source.
    parts = parts.repartition(F.col("lang"), F.col("term"))
    return parts.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def shares(counts: np.ndarray, totals: np.ndarray, kept: int) -> np.ndarray:
    """``1 + floor(10^9 (count + 1) / (total + kept))``, digit by digit: no product leaves 64 bits."""
    below = totals + kept
    out, rest = np.divmod(counts + 1, below)
    for _ in range(3):
        more, rest = np.divmod(rest * 1000, below)
        out = out * 1000 + more
    return out + 1


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // q


def _shard(
    key: tuple, table: pa.Table, sources: dict[str, list[str]], totals: dict[str, np.ndarray], kept: dict[str, int], terms: int
) -> pa.Table:
    """A shard's part of the divergences of each pair of sources, and its best terms by source.

    Rows are ``(lang, source, part, item, value)``. Values of part ``pair`` are to be added up over shards.
    """
    lang = key[0].as_py()
    names, all_of, size = sources[lang], totals[lang], kept[lang]
    encoded = table["term"].combine_chunks().dictionary_encode()
    column = pc.index_in(table["source"].combine_chunks(), value_set=pa.array(names, pa.string())).to_numpy()
    row, n = encoded.indices.to_numpy(), table["n"].to_numpy()
    pairs = np.zeros((len(names), len(names)), np.int64)
    found = []
    step = max(1, CELLS // len(names))
    order = np.argsort(row, kind="stable")
    row, column, n = row[order], column[order], n[order]
    for at in range(0, len(encoded.dictionary), step):
        end = min(at + step, len(encoded.dictionary))
        a, b = np.searchsorted(row, [at, end])
        counts = np.zeros((len(names), end - at), np.int64)
        counts[column[a:b], row[a:b] - at] = n[a:b]
        p = shares(counts, all_of[:-1, None], size)
        for h in range(len(names)):
            pairs[:, h] += divergence(p, p[h]).sum(axis=1)
        whole = shares(counts.sum(axis=0), all_of[-1], size)
        over = (counts > 0) & (p > whole)
        value = divergence(p, whole)
        for g in range(len(names)):
            which = np.flatnonzero(over[g])
            best = pa.table({"item": encoded.dictionary.take(pa.array(which + at)), "value": value[g, which]})
            found.append(best.append_column("source", pa.repeat(names[g], len(which))))
    best = pa.concat_tables(found).sort_by([("source", "ascending"), ("value", "descending"), ("item", "ascending")])
    starts = pc.index_in(best["source"], value_set=pc.unique(best["source"])).to_numpy()
    place = np.arange(len(starts)) - np.searchsorted(starts, starts)
    best = best.filter(pa.array(place < terms))
    g, h = np.nonzero(~np.eye(len(names), dtype=bool))
    own = pa.array(names, pa.string())
    both = pa.table({"item": own.take(pa.array(h)), "value": pairs[g, h], "source": own.take(pa.array(g))})
    out = pa.concat_tables([both, best])
    part = pa.array(np.where(np.arange(out.num_rows) < both.num_rows, "pair", "term"), pa.string())
    out = out.append_column("part", part).append_column("lang", pa.repeat(lang, out.num_rows))
    return out.select(["lang", "source", "part", "item", "value"])


def audit_sources(
    docs: DataFrame,
    least_documents: int = LEAST_DOCUMENTS,
    terms: int = TERMS,
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
) -> DataFrame:
    """``(lang, source, part, item, value, rank)``: for each source of a language, how its share of terms differs.

    A language keeps the terms that at least ``least_documents`` of its documents have. With ``V`` of them, and ``N`` their
    occurrences in a group, a term that occurs ``c`` times there has the share ``p = 1 + floor(10^9 (c + 1) / (N + V))``.
    Part ``pair`` has a row for each other source of the language, valued at the sum of ``floor((p - q)^2 / q)`` over
    all kept terms, 0 if there are none. Part ``term`` has the ``terms`` kept terms of most value among those that the
    source has, with a share above ``q``, the whole language's. ``rank`` is from 1, by value descending and then item.

    NULL texts, languages and sources are empty strings. Rows are documents, repeated ones too. An empty table
    gives an empty result; other columns aren't read. The number of sources of one language is taken to be such
    that its square is a size a result may have: each task holds one number for each pair. The list of groups with
    their totals comes to the driver. This runs jobs: counts and shards' parts are stored.
    """
    spark = docs.sparkSession
    counts = stored(term_counts(docs, text, lang, source), "counts")
    kept = counts.filter("term is not null").groupBy("lang", "term").agg(F.sum("docs").alias("docs"))
    kept = kept.filter(F.col("docs") >= least_documents).select("lang", "term")
    rows = stored(counts.filter("term is not null").join(kept, ["lang", "term"], "left_semi").select("lang", "term", "source", "n"), "kept")
    groups = sorted((r["lang"], r["source"]) for r in counts.filter("term is null").select("lang", "source").distinct().collect())
    sizes = {(r["lang"], r["source"]): r["n"] for r in rows.groupBy("lang", "source").agg(F.sum("n").alias("n")).collect()}
    vocabulary = {r["lang"]: r["n"] for r in rows.select("lang", "term").distinct().groupBy("lang").agg(F.count("*").alias("n")).collect()}
    sources: dict[str, list[str]] = {}
    for name, own in groups:
        sources.setdefault(name, []).append(own)
    totals = {}
    for name, own in sources.items():
        each = [sizes.get((name, s), 0) for s in own]
        totals[name] = np.array([*each, sum(each)], np.int64)

    shards = max(1, math.ceil(rows.count() / SHARD_ROWS))
    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("term"), F.lit(shards)))
    work = partial(_shard, sources=sources, totals=totals, kept=vocabulary, terms=terms)
    parts = dealt.groupBy("lang", "shard").applyInArrow(
        lambda key, table: work(key, table), "lang string, source string, part string, item string, value long"
    )
    parts = stored(parts, "parts")
    # Groups of a language without kept terms are in no shard, and differ by nothing.
    bare = spark.createDataFrame([g for g in groups if g[0] not in vocabulary], "lang string, source string")
    nothing = bare.join(bare.withColumnRenamed("source", "item"), "lang").filter("item <> source")
    nothing = nothing.select("lang", "source", "item", F.lit(0).cast("long").alias("value"))
    pairs = parts.filter("part = 'pair'").select("lang", "source", "item", "value").unionAll(nothing)
    pairs = pairs.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    best = parts.filter("part = 'term'").withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= terms)
    pairs = pairs.withColumn("part", F.lit("pair")).withColumn("rank", F.row_number().over(order))
    names = ["lang", "source", "part", "item", "value", "rank"]
    return pairs.select(names).unionAll(best.select(names))

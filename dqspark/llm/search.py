"""Ranked lexical search by NRA: sequential reads of impact-sorted lists, with score intervals per document.

The documents are dealt into shards of bounded size, as Spark partitions and batches them. A shard has a list of
``(document, impact)`` for each term of the queries, highest impact first. For one query the lists of its terms
are read side by side, in blocks. What a document has got from the lists so far is the lower end of its score; the
upper end adds, for each list that hasn't shown it, the impact at which that list stands now. Reading goes on until
every document whose upper end reaches the k-th lower end has both ends equal: then membership, ties and scores are
all settled. The best of the shards are ranked once more by Spark. Later shards of a task start from the k-th score
of the earlier ones, so most end after a few blocks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from dqspark.llm._arrow import LOWER, chunks, span_hashes, word_spans
from dqspark.plans.storage import stored

NO_TERM = np.zeros(256, bool)
NO_TERM[[*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = True
SHARD_ROWS = 8192
SHARD_POSTINGS = 1 << 20
"""A shard has at most so many documents and, unless one document has more, postings."""
FIRST_BLOCK = 64
"""Entries of each list in the first round of reads; every round reads as many again as all before it."""
BLOCK_TERMS = 1 << 18
"""Queries are answered in blocks that have about so many (query, term) pairs, which are sent to every executor."""


def term_hashes(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the terms of each row, A-Z lower-cased, in order, and their number by row."""
    low = LOWER[data]
    starts, ends, counts = word_spans(low, at, NO_TERM)
    return span_hashes(low, starts, ends), counts


@dataclass
class Queries:
    """A block of queries over its sorted ``vocabulary`` of term hashes.

    Query ``i`` has the id ``ids[i]`` and the terms ``terms[cuts[i]:cuts[i + 1]]``, as places in the vocabulary,
    ``times`` each. ``weights`` are those of the terms, ``n_docs`` and ``n_terms`` the totals of the documents.
    """

    ids: np.ndarray
    cuts: np.ndarray
    terms: np.ndarray
    times: np.ndarray
    vocabulary: np.ndarray
    weights: np.ndarray | None = None
    n_docs: int = 0
    n_terms: int = 0

    def impacts(self, term: np.ndarray, tf: np.ndarray, n: np.ndarray) -> np.ndarray:
        """What a term that occurs ``tf`` times in a document of ``n`` terms adds to the score of a query."""
        m = 75 + (25 * n * self.n_docs) // self.n_terms
        return self.weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 12 * m))


class Shard:
    """The impact-sorted lists of some documents."""

    def __init__(self, queries: Queries, doc: np.ndarray, term: np.ndarray, tf: np.ndarray, n: np.ndarray):
        impact = queries.impacts(term, tf, n[doc])
        order = np.lexsort((-impact, term))
        self.docs, self.impacts = doc[order], impact[order]
        self.starts = np.searchsorted(term[order], np.arange(len(queries.vocabulary) + 1))
        self.size = len(n)

    def best(self, terms: np.ndarray, times: np.ndarray, k: int, least: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents and exact scores, among them all of the ``k`` best and their ties, that reach ``least``.

        ``least`` is at least 1. There may be more than ``k`` if scores are equal.
        """
        begins, ends = self.starts[terms], self.starts[terms + 1]
        # What is left of all lists together bounds every score: often that is the end of it.
        held = begins < ends
        begins, ends, times = begins[held], ends[held], times[held]
        heads = self.impacts[begins] * times
        lower = np.zeros(self.size, np.int64)
        read, block = begins.copy(), FIRST_BLOCK
        frontier = heads
        while True:
            if frontier.sum() < least and not lower.any():
                return np.zeros(0, np.int64), np.zeros(0, np.int64)
            upto = np.minimum(read + block, ends)
            for a, b, t in zip(read, upto, times, strict=True):
                lower[self.docs[a:b]] += self.impacts[a:b] * t
            read, block = upto, block * 2
            # A list that is read to its end has nothing more for any document.
            frontier = np.where(read < ends, self.impacts[np.minimum(read, ends - 1)] * times, 0)
            shown = np.zeros(self.size, np.int64)
            for i in np.flatnonzero(frontier):
                shown[self.docs[begins[i] : read[i]]] += frontier[i]
            upper = lower + (frontier.sum() - shown)
            bound = max(least, int(np.partition(lower, -k)[-k])) if self.size > k else least
            open_ = np.flatnonzero(upper >= bound)
            if (upper[open_] == lower[open_]).all():
                return open_, lower[open_]


def postings(docs: DataFrame, vocabulary: np.ndarray, text: str, doc_id: str) -> DataFrame:
    """``(doc_id, n, terms, times)`` of each document: all its terms, and those in ``vocabulary`` with their counts."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            for first, end, data, at in chunks(batch.column(1)):
                hashes, counts = term_hashes(data, at)
                place = np.searchsorted(known, hashes)
                place[place == len(known)] = 0
                found = known[place] == hashes if len(known) else np.zeros(len(hashes), bool)
                row = np.repeat(np.arange(len(counts)), counts)[found]
                pairs, times = np.unique(row * max(len(known), 1) + place[found], return_counts=True)
                row, term = np.divmod(pairs, max(len(known), 1))
                cuts = pa.array(np.append(0, np.cumsum(np.bincount(row, minlength=len(counts)))).astype(np.int32))
                lists = [pa.ListArray.from_arrays(cuts, pa.array(v.astype(np.int32))) for v in (term, times)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[first:end], pa.array(counts.astype(np.int64)), *lists], ["doc_id", "n", "terms", "times"]
                )

    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    rest = StructType.fromDDL("n long, terms array<int>, times array<int>")
    return source.mapInArrow(read, StructType([StructField("doc_id", source.schema[0].dataType), *rest.fields]))


def document_frequencies(lists: DataFrame, size: int) -> np.ndarray:
    """In how many documents each term of the vocabulary is; each task adds up its own."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(size, np.int64)
        for batch in batches:
            df += np.bincount(batch.column(0).flatten().to_numpy(), minlength=size)
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(df[at])], ["term", "df"])

    found = lists.select("terms").mapInArrow(read, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).toArrow()
    out = np.zeros(size, np.int64)
    out[found["term"].to_numpy()] = found["df"].to_numpy()
    return out


def search(
    docs: DataFrame,
    items: DataFrame,
    k: int = 20,
    text: str = "text",
    doc_id: str = "doc_id",
    item_text: str = "text",
    item_id: str = "item_id",
) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: the ``k`` best documents for each item, ``rank`` from 1.

    Terms are runs of ASCII letters and digits and of characters beyond ASCII, with A-Z lower-cased. Scores above 0
    only; equal scores go by ascending id, NULL ids last. Every row of ``docs`` is a document of its own, also one that
    repeats an id. Rows of ``items`` with the same id and text are one query. NULL and empty texts have no terms:
    such documents are found by no query and do not count, such items find nothing. An empty table on either side
    gives an empty result. Other columns aren't read. Both ids keep their types.

    This runs jobs: queries are taken in blocks of about ``BLOCK_TERMS`` terms, and each block stores the postings of its
    terms, reads them twice, for the frequencies and for the search, and stores its ranks.
    """
    spark = docs.sparkSession
    asked = items.select(F.col(item_id).alias("item_id"), F.coalesce(F.col(item_text).cast("string"), F.lit("")).alias("text"))
    asked = asked.withColumn("query", F.xxhash64("item_id", "text")).dropDuplicates(["query"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, _, data, at in chunks(batch.column(1)):
                hashes, counts = term_hashes(data, at)
                row = np.repeat(np.arange(len(counts)) + first, counts)
                order = np.lexsort((hashes, row))
                row, hashes = row[order], hashes[order]
                new = np.flatnonzero(np.append(True, (row[1:] != row[:-1]) | (hashes[1:] != hashes[:-1]))[: len(row)])
                times = np.diff(np.append(new, len(row)))
                ids = batch.column(0).take(pa.array(row[new]))
                yield pa.RecordBatch.from_arrays([ids, pa.array(hashes[new].view(np.int64)), pa.array(times)], ["query", "term", "times"])

    pairs = stored(asked.select("query", "text").mapInArrow(read, "query long, term long, times long"), "queries")
    blocks = max(1, math.ceil(pairs.count() / BLOCK_TERMS))
    answers = None
    for b in range(blocks):
        mine = pairs.filter(F.pmod("query", F.lit(blocks)) == b).toArrow()
        found = _search_block(docs, _queries(mine), k, text, doc_id)
        answers = found if answers is None else answers.unionAll(found)
    names = asked.select("query", "item_id").filter(F.length("text") > 0)
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    top = answers.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    top = stored(top.select("query", "rank", "doc_id", "score"), "found")
    return top.join(names, "query").select("item_id", "rank", "doc_id", "score")


def _queries(pairs: pa.Table) -> Queries:
    query, term, times = (pairs[c].to_numpy() for c in ("query", "term", "times"))
    term = term.view(np.uint64)
    order = np.lexsort((term, query))
    query, term, times = query[order], term[order], times[order]
    ids, starts = np.unique(query, return_index=True)
    vocabulary, place = np.unique(term, return_inverse=True)
    return Queries(ids, np.append(starts, len(query)), place, times, vocabulary)


def _search_block(docs: DataFrame, queries: Queries, k: int, text: str, doc_id: str) -> DataFrame:
    """``(query, doc_id, score)``: the ``k`` best of each shard and those that tie with them."""
    lists = stored(postings(docs, queries.vocabulary, text, doc_id), "postings")
    queries.n_docs, queries.n_terms = lists.agg(
        F.coalesce(F.sum((F.col("n") > 0).cast("long")), F.lit(0)), F.coalesce(F.sum("n"), F.lit(0))
    ).first()
    df = document_frequencies(lists, len(queries.vocabulary))
    queries.weights = np.array([math.floor(1000 * math.log((2 * queries.n_docs + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)
    shared = docs.sparkSession.sparkContext.broadcast(queries)

    def shards(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        cuts = batch.column(2).offsets.to_numpy()
        row = 0
        while row < batch.num_rows:
            end = int(np.searchsorted(cuts, cuts[row] + SHARD_POSTINGS, "right")) - 1
            end = min(max(end, row + 1), row + SHARD_ROWS, batch.num_rows)
            yield batch.slice(row, end - row)
            row = end

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = shared.value
        known = [np.zeros(0, np.int64) for _ in asked.ids]
        for part in (s for batch in batches for s in shards(batch)):
            terms, times = part.column(2), part.column(3)
            doc = np.repeat(np.arange(part.num_rows), np.diff(terms.offsets.to_numpy()))
            if not len(doc):
                continue
            shard = Shard(asked, doc, terms.flatten().to_numpy(), times.flatten().to_numpy().astype(np.int64), part.column(1).to_numpy())
            by_id = np.empty(part.num_rows, np.int64)
            by_id[pc.sort_indices(part.column(0), null_placement="at_end").to_numpy()] = np.arange(part.num_rows)
            made = []
            for i in range(len(asked.ids)):
                of = slice(asked.cuts[i], asked.cuts[i + 1])
                least = max(1, int(known[i][0])) if len(known[i]) == k else 1
                at, score = shard.best(asked.terms[of], asked.times[of], k, least)
                if len(at):
                    order = np.lexsort((by_id[at], -score))[:k]
                    at, score = at[order], score[order]
                    known[i] = np.sort(np.append(known[i], score))[-k:]
                    made.append((np.full(len(at), asked.ids[i]), at, score))
            if made:
                query, at, score = (np.concatenate(x) for x in zip(*made, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(query), part.column(0).take(pa.array(at)), pa.array(score)], ["query", "doc_id", "score"]
                )

    kind = lists.schema["doc_id"].dataType
    made = StructType.fromDDL("query long, score long")
    return lists.select("doc_id", "n", "terms", "times").mapInArrow(
        read, StructType([made["query"], StructField("doc_id", kind), made["score"]])
    )

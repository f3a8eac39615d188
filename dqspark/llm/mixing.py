"""Mixing sources to target weights by Sainte-Laguë apportionment of words, taken in blocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dqspark.plans.bounds import is_bounded
from dqspark.plans.joins import lookup_join
from dqspark.plans.storage import stored

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
BLOCK = 32
"""Words of a block."""
UNIT = 2**20
"""Parts of a copy in which fractions of documents are added up."""
STEP = 2**31 - 1
"""A prime: multiples of it visit all blocks of a shard in another order."""


def word_count(text: Column) -> Column:
    """The number of runs of characters outside ``[\\x20\\x09-\\x0D]``; NULL has none."""
    words = F.regexp_count(F.coalesce(text.cast("string"), F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"))
    return words.cast("long")


def apportion(cells: DataFrame, group: list[str], weight: str, seats: Column, order: list[str], name: str) -> DataFrame:
    """``cells`` with ``name``, whole seats of each cell by the highest quotients w / 1, w / 3, w / 5, ...

    ``seats`` is the number of seats of a group. A divisor of W / (seats - cells / 2) gives no cell too many and
    one of W / (seats + cells / 2) none too few, so only the seats between, at most about two a cell, are
    ranked by their quotients; the others are sure. Cells of equal quotients go by ``order``.
    """
    all_ = Window.partitionBy(*group)
    cells = cells.withColumns({
        "_w": F.col(weight).cast("double"),
        "_sum": F.sum(F.col(weight).cast("double")).over(all_),
        "_half": F.count("*").over(all_) / 2,
        "_seats": seats,
    })
    share = F.when(F.col("_sum") > 0, F.col("_w") / F.col("_sum")).otherwise(0.0)
    low = F.floor(share * F.greatest(F.col("_seats") - F.col("_half"), F.lit(0.0)) + 0.5 - 1e-9)
    high = F.floor(share * (F.col("_seats") + F.col("_half")) + 0.5 + 1e-9)
    cells = cells.withColumns({"_low": F.greatest(low, F.lit(0)), "_high": F.when(share > 0, high).otherwise(0)})
    open_ = cells.filter("_high > _low").select(
        *group, *order, "_w", "_seats", F.explode(F.sequence(F.col("_low") + 1, F.col("_high"))).alias("_k")
    )
    sure = cells.groupBy(*group).agg(F.sum("_low").alias("_sure"))
    ranked = open_.withColumn(
        "_rank",
        F.row_number().over(
            Window.partitionBy(*group).orderBy(F.desc(F.col("_w") / (2 * F.col("_k") - 1)), *order, "_k")
        ),
    )
    won = _null_safe(ranked, sure, group).filter("_rank <= _seats - _sure")
    won = won.groupBy(*group, *order).agg(F.count("*").alias("_won"))
    keys = list(dict.fromkeys([*group, *order]))
    out = _null_safe(cells, won, keys, "left")
    return out.withColumn(name, F.col("_low") + F.coalesce("_won", F.lit(0))).drop(
        "_w", "_sum", "_half", "_seats", "_low", "_high", "_won"
    )


def _null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    right = right.select(*[F.col(k).alias(f"_r{i}") for i, k in enumerate(keys)], *[c for c in right.columns if c not in keys])
    condition = None
    for i, k in enumerate(keys):
        equal = F.col(k).eqNullSafe(F.col(f"_r{i}"))
        condition = equal if condition is None else condition & equal
    return left.join(right, condition, how).drop(*[f"_r{i}" for i in range(len(keys))])


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """``(source, source_size, weight, target)`` of a table ``(source, source_size)``, one row a source.

    Targets are in proportion to the weights, but at most ``most`` times the size. Sources fill up in
    the order of size / weight: with the first j full, the level of the others is what is left over by
    their weights, and the right j is the first whose level the next source's limit does not fall
    below. The table has one row a source; one task ranks them.
    """
    by_name = Window.partitionBy(F.lit(0)).orderBy(F.asc_nulls_last("source"))
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    rows = sizes.withColumn("weight", F.element_at(cycle, (F.row_number().over(by_name) - 1) % len(weights) + 1))
    rows = rows.withColumn("_cap", F.col("source_size") * float(most))
    by_limit = Window.partitionBy(F.lit(0)).orderBy(F.col("_cap") / F.col("weight"), F.asc_nulls_last("source"))
    before = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    all_ = Window.partitionBy(F.lit(0))
    rows = rows.withColumns({
        "_full": F.coalesce(F.sum("_cap").over(before), F.lit(0.0)),
        "_open": F.sum("weight").over(by_limit.rowsBetween(Window.currentRow, Window.unboundedFollowing)),
        "_goal": F.sum("source_size").over(all_) * share,
    })
    level = (F.col("_goal") - F.col("_full")) / F.col("_open")
    rows = rows.withColumn("_level", F.when(level * F.col("weight") <= F.col("_cap"), level))
    # Every source after the first that isn't full has the same level.
    rows = rows.withColumn("_level", F.first("_level", ignorenulls=True).over(by_limit.rowsBetween(Window.unboundedPreceding, 0)))
    target = F.coalesce(F.least(F.col("_level") * F.col("weight"), F.col("_cap")), F.col("_cap"))
    return rows.select("source", "source_size", "weight", target.alias("target"))


def mix_sources(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    block: int = BLOCK,
    seed: int = 0,
) -> DataFrame:
    """``(doc_id, source, size, source_size, target, taken)`` for every row; other columns are not read.

    Sources by code point, NULL last, weigh 5, 2, 1, repeating, and share 150 % of all words; no target is
    above twice its source's size. The words of a source are dealt to its shards by a seeded hash of the id, about
    the square root of the source's own number of documents over two, so that no shard is a large part of a
    source. A shard's documents follow each other in a seeded order and are cut into blocks of ``block`` words,
    the last one shorter. Words go to sources by the highest quotients of their targets, and a source's to its
    shards by the highest quotients of their sizes; a shard takes all its words as often as its quota allows and
    the remainder from blocks in a seeded order, the last of these in part, at most twice each. So every source
    takes its target to the word, whatever the sizes of the table and of the source. ``taken`` is the number of
    a document's words in the taken blocks, so it is at most twice ``size``, and reruns give the same.

    NULL, empty and blank texts have no words and take none. Rows of one id follow each other by size;
    equal rows are interchangeable. An empty table gives an empty result.
    """
    mixed = _mixed(docs.select(*_slim(doc_id, text, source)), block, seed)
    return mixed.select(F.col("id").alias("doc_id"), "source", "size", "source_size", "target", "taken")


def mix_copies(docs: DataFrame, block: int = BLOCK, seed: int = 0) -> DataFrame:
    """``docs``, with ``doc_id``, ``text`` and ``source``, each row as often as the mix takes it: none, one or two.

    The words that ``mix_sources`` takes of a document are a fraction of its size. Along each source, by bands
    of sizes from long to short and shards in a band, the fractions add up and a document is repeated once
    for every whole number that they pass. What is left over goes on, so the copies of a source differ from
    its taken words by about its longest document and less than a tenth of one for each band and shard. Rows
    without an id or a source count as any other. Rows equal in id, source and text share their copies.
    """
    names = docs.columns
    key = F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))
    mixed = stored(_mixed(docs.select(*_slim("doc_id", "text", "source"), key.alias("digest")), block, seed), "mixed")
    share = F.when(F.col("size") > 0, F.round(F.col("taken") * UNIT / F.col("size"))).otherwise(0).cast("long")
    band = F.when(F.col("size") > 0, F.floor(F.log2("size") * 8)).otherwise(-1)
    mixed = mixed.withColumns({"_share": share, "_band": band})
    shards = mixed.groupBy("source", "_band", "shard").agg(F.sum("_share").alias("_all"))
    earlier = Window.partitionBy("source").orderBy(F.desc("_band"), "shard").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.pmod(F.xxhash64(F.lit(seed), F.lit("copies"), "source"), F.lit(UNIT))
    shards = shards.withColumn("_from", F.coalesce(F.sum("_all").over(earlier), F.lit(0)) + offset).drop("_all")
    mixed = _null_safe(mixed, shards, ["source", "_band", "shard"])
    tape = Window.partitionBy("source", "_band", "shard").orderBy(F.desc("size"), "place", "id", "digest", "end")
    to = F.col("_from") + F.sum("_share").over(tape.rowsBetween(Window.unboundedPreceding, 0))
    mixed = mixed.withColumn("_to", to)
    copies = F.floor(F.col("_to") / UNIT) - F.floor((F.col("_to") - F.col("_share")) / UNIT)
    found = mixed.groupBy("id", "source", "size", "digest").agg(
        F.sum(copies).cast("int").alias("_copies"), F.count("*").cast("int").alias("_equal")
    )
    found = stored(found.filter("_copies > 0"), "copies").withColumnsRenamed({"id": "_id", "source": "_of", "digest": "_key"})
    found = found.drop("size")
    found = F.broadcast(found) if is_bounded(found) else found
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & F.col("source").cast("string").eqNullSafe(F.col("_of"))
    rows = docs.withColumn("_digest", key).join(found, same & (F.col("_digest") == F.col("_key")))
    # Of several equal rows, the first have one copy more than the others.
    equal = Window.partitionBy("_id", "_of", "_key").orderBy(F.xxhash64(*[F.col(c) for c in names]))
    several = rows.filter("_equal > 1").withColumn("_number", F.row_number().over(equal))
    own = F.floor(F.col("_copies") / F.col("_equal")) + (F.col("_number") <= F.col("_copies") % F.col("_equal")).cast("int")
    rows = rows.filter("_equal = 1").unionByName(several.withColumn("_copies", own.cast("int")).drop("_number"))
    rows = rows.filter("_copies > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
    return rows.select(names)


def _slim(doc_id: str, text: str, source: str) -> list[Column]:
    return [F.col(doc_id).alias("id"), F.col(source).cast("string").alias("source"), word_count(F.col(text)).alias("size")]


def _mixed(slim: DataFrame, block: int, seed: int) -> DataFrame:
    """``slim``, a table of ``(id, source, size)`` and more, with its shard, place and taken words."""
    kept = slim.columns
    slim = stored(slim, "sizes")
    found = slim.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("_rows"))
    found = stored(found, "sources")
    targets = source_targets(found.select("source", "source_size"))
    total = Window.partitionBy(F.lit(0))
    targets = targets.withColumn("_one", F.lit(0)).withColumn("_words", F.round(F.sum("target").over(total)))
    targets = apportion(targets, ["_one"], "target", F.col("_words"), ["source"], "quota")
    targets = _null_safe(targets.select("source", "source_size", "target", "quota"), found.drop("source_size"), ["source"])
    targets = targets.withColumn("quota", F.least("quota", F.col("source_size") * MOST))
    targets = targets.withColumn("shards", F.greatest(F.ceil(F.sqrt("_rows") / 2), F.lit(1))).drop("_rows")
    targets = stored(targets, "targets")

    shards = targets.select("source", "shards")
    dealt = lookup_join(slim, shards, ["source"], "inner")
    placed = dealt.select(
        *kept,
        F.xxhash64(F.lit(seed), F.lit("order"), "id").alias("place"),
        F.pmod(F.xxhash64(F.lit(seed), F.lit("shard"), "id", "size"), F.col("shards")).alias("shard"),
    )
    tape = Window.partitionBy("source", "shard").orderBy("place", "id", "size")
    placed = placed.withColumn("end", F.sum("size").over(tape.rowsBetween(Window.unboundedPreceding, 0)))
    placed = stored(placed, "tapes")
    cells = placed.groupBy("source", "shard").agg(F.sum("size").alias("length"))
    cells = _null_safe(cells, targets.drop("shards"), ["source"])
    cells = apportion(cells, ["source"], "length", F.col("quota").cast("double"), ["shard"], "words")
    cells = cells.select("source", "shard", "source_size", "target", "length", "words")
    mixed = _null_safe(placed, cells, ["source", "shard"])
    return mixed.withColumn("taken", _taken(block, seed)).drop("length", "words")


def _taken(block: int, seed: int) -> Column:
    """Words of a document in its shard's taken blocks."""
    length = F.greatest(F.col("length"), F.lit(1))
    number = F.ceil(length / block)
    quota = F.least(F.col("words"), MOST * F.col("length"))
    rounds, rest = F.floor(quota / length), quota % length
    start, end = F.col("end") - F.col("size"), F.col("end")
    first, last = F.floor(start / block), F.floor((end - 1) / block)
    offset = F.pmod(F.xxhash64(F.lit(seed), F.lit("blocks"), "source", "shard"), number)

    def rank(j: Column) -> Column:
        return (j * STEP + offset) % number

    short = number * block - length

    def words(j: Column) -> Column:
        before = rank(j) * block - F.when(rank(number - 1) < rank(j), short).otherwise(0)
        more = F.least(F.greatest(rest - before, F.lit(0)), F.lit(block))
        own = F.least(end, (j + 1) * block) - F.greatest(start, j * block)
        again = F.greatest(F.least(end, j * block + more) - F.greatest(start, j * block), F.lit(0))
        return own * rounds + again

    spread = F.transform(F.sequence(first, last), words)
    summed = F.aggregate(spread, F.lit(0).cast("long"), lambda a, x: a + x.cast("long"))
    return F.when(F.col("size") > 0, summed).otherwise(0).cast("long")

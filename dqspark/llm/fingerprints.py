"""Document fingerprints: a homomorphic multiset hash of paragraphs, and the likeness of two of them.

A paragraph is a line; its clauses are what stands between punctuation marks. The fingerprint of a
document is a wide vector summed over its paragraphs, each lane modulo a power of two: 63 lanes
modulo 2^20 count the clauses whose hash has a bit set, one lane modulo 2^20 counts the clauses, and
three lanes modulo 2^62 sum hashes of whole paragraphs. The order of paragraphs has no part in it,
and paragraphs are added or taken away by adding or subtracting their vectors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dqspark.plans.storage import stored

FIELD = 21
"""Three counters of 20 bits in a 64-bit word, with a bit between them for the carry."""
COUNTERS = sum((2**20 - 1) << (FIELD * i) for i in range(3))
UNITS = sum(1 << (FIELD * i) for i in range(3))
WIDE = 2**62 - 1
N_COUNTERS = 21
N_WIDE = 3
LANES = N_COUNTERS + 1 + N_WIDE
CLAUSE_ENDS = r"(?<=[.,;:!?、。，！？])\s*"


def _summed(hashes: Column, part: int, mask: int) -> Column:
    """A word of counters over an array of hashes: their bits ``part``, + 21 and + 42."""
    zero = F.lit(0).cast("long")
    return F.aggregate(
        hashes, zero,
        lambda a, h: (a + F.shiftrightunsigned(h, part).bitwiseAND(F.lit(UNITS))).bitwiseAND(F.lit(mask)),
    )


def _wide_sum(hashes: Column, part: int) -> Column:
    zero = F.lit(0).cast("long")
    value = lambda h: F.xxhash64(h, F.lit(part)).bitwiseAND(F.lit(WIDE))
    return F.aggregate(hashes, zero, lambda a, h: (a + value(h)).bitwiseAND(F.lit(WIDE)))


def paragraph_hashes(text: Column) -> Column:
    """The hashes of a text's clauses and paragraphs; NULL and empty texts have none.

    Empty paragraphs have no part in it, so texts that differ only in them have one fingerprint.
    """
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n", -1), lambda p: p != "")
    clauses = F.flatten(F.transform(lines, lambda p: F.filter(F.split(p, CLAUSE_ENDS), lambda c: c != "")))
    return F.struct(
        F.transform(clauses, lambda c: F.xxhash64(c)).alias("clauses"),
        F.transform(lines, lambda p: F.xxhash64(F.lit(2), p)).alias("lines"),
    )


def lanes(hashes: Column) -> Column:
    """The fingerprint of a text from its ``paragraph_hashes``: an array of 64-bit words."""
    clauses, lines = hashes.getField("clauses"), hashes.getField("lines")
    words = [_summed(clauses, i, COUNTERS) for i in range(N_COUNTERS)]
    words.append((F.size(clauses) % 2**20).cast("long"))
    words += [_wide_sum(lines, i) for i in range(N_WIDE)]
    return F.array(*words)


def added(a: Column, b: Column) -> Column:
    """The fingerprint of the paragraphs of both."""
    return _combined(a, b, lambda x, y: x + y)


def removed(a: Column, b: Column) -> Column:
    """The fingerprint of ``a`` without the paragraphs of ``b``, which must be among its own."""
    # Borrow from the free bit above each counter, then clear it.
    spare = sum(1 << (FIELD * i + 20) for i in range(3))
    return _combined(a, b, lambda x, y: (x.bitwiseOR(F.lit(spare)) - y), WIDE + 1)


def _combined(a: Column, b: Column, by, lift: int = 0) -> Column:
    words = []
    for i in range(LANES):
        x, y = F.element_at(a, i + 1), F.element_at(b, i + 1)
        if i < N_COUNTERS:
            words.append(by(x, y).bitwiseAND(F.lit(COUNTERS)))
        elif lift:
            words.append((x + F.lit(lift) - y).bitwiseAND(F.lit(2**20 - 1 if i == N_COUNTERS else WIDE)))
        else:
            words.append((x + y).bitwiseAND(F.lit(2**20 - 1 if i == N_COUNTERS else WIDE)))
    return F.array(*words)


def likeness(a: Column, b: Column) -> Column:
    """The cosine of two fingerprints' counters as sums of signs, from 0 to 1: an estimate of that of
    their multisets of clauses. 1 for equal fingerprints, 0 if just one is that of no text."""

    def signs(v: Column) -> Column:
        words = [F.element_at(v, i + 1) for i in range(N_COUNTERS)]
        n = F.element_at(v, N_COUNTERS + 1)
        counts = [F.shiftrightunsigned(w, FIELD * k).bitwiseAND(F.lit(2**20 - 1)) for w in words for k in range(3)]
        return F.array(*[(c * 2 - n).cast("double") for c in counts])

    def dot(x: Column, y: Column) -> Column:
        return F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda s, p: s + p)

    x, y = signs(a), signs(b)
    cosine = F.try_divide(dot(x, y), F.sqrt(dot(x, x)) * F.sqrt(dot(y, y)))
    return F.when(a == b, 1.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(cosine, F.lit(0.0)))))


def as_text(lanes: Column) -> Column:
    return F.array_join(F.transform(lanes, lambda w: F.lpad(F.hex(w), 16, "0")), "")


def next_ids(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``(id, next_id, next_hash)``: the id after each and the hash of that document's text, in a circle.

    Ids are range-partitioned and each part is ordered by itself; only the least id of each part, one
    row a part, goes through one task and a broadcast.
    """
    ids = docs.groupBy(F.col(doc_id).alias("id")).agg(F.min(F.xxhash64(_whole(text))).alias("hash")).filter("id is not null")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ids = stored(ids.repartitionByRange(parts, "id").withColumn("part", F.spark_partition_id()), "ids")
    heads = ids.groupBy("part").agg(F.min(F.struct("id", "hash")).alias("head"))
    all_ = Window.partitionBy(F.lit(0)).orderBy("part")
    after = F.coalesce(
        F.lead("head").over(all_), F.first("head").over(all_.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    )
    heads = heads.select("part", after.alias("after"))
    within = F.lead(F.struct("id", "hash")).over(Window.partitionBy("part").orderBy("id"))
    rows = ids.select("id", "part", within.alias("next")).join(F.broadcast(heads), "part")
    nxt = F.coalesce("next", "after")
    return rows.select("id", nxt.getField("id").alias("next_id"), nxt.getField("hash").alias("next_hash"))


def _whole(text: str) -> Column:
    return F.coalesce(F.col(text).cast("string"), F.lit(""))


def fingerprint_edits(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness to each other and to the next's.

    The edited text has its last quarter of code points, rounded down, replaced by as many of the first of
    the next document's (all, if it has fewer), by ascending id; the last document is followed by the first.
    Returns ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``, one
    row for each row; other columns are not read.

    NULL counts as empty. Of rows with one id, all have the same next document, and the one whose text has
    the least hash is the next of the one before. A row without an id has no next: nothing is put in, and
    ``near_next`` is the likeness to no text. A single document is its own next. An empty table gives
    an empty result.
    """
    rows = docs.select(F.col(doc_id).alias("id"), _whole(text).alias("t"))
    links = stored(next_ids(docs, doc_id, text), "next")
    quarter = F.floor(F.char_length("t") / 4).cast("int")
    most = rows.groupBy("id").agg(F.max(quarter).alias("most"))
    wanted = links.join(most, "id").select(F.col("id").alias("of"), F.col("next_id").alias("id"), "next_hash", "most")
    # The same rows and key in both joins, so that texts are shuffled once.
    known = rows.filter("id is not null")
    heads = known.join(wanted, "id").filter(F.xxhash64("t").bitwiseXOR(F.col("next_hash")) == 0)
    heads = heads.select(F.col("of").alias("id"), F.expr("left(t, most)").alias("head")).dropDuplicates(["id"])
    edited = F.concat(
        F.expr("left(t, char_length(t) - quarter)"), F.coalesce(F.expr("left(head, quarter)"), F.lit(""))
    )
    both = known.join(heads, "id", "left").unionByName(rows.filter("id is null"), allowMissingColumns=True)
    both = both.withColumn("quarter", quarter).withColumn("edited", edited)
    hashed = both.select(
        "id",
        F.xxhash64("t").alias("hash"),
        F.char_length("t").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        paragraph_hashes(F.col("t")).alias("h"),
        paragraph_hashes(F.col("edited")).alias("he"),
    )
    made = hashed.select("id", "hash", "n_chars", "edited_sha256", lanes(F.col("h")).alias("f"), lanes(F.col("he")).alias("fe"))
    made = stored(made, "fingerprints")
    own = links.join(
        made.select(F.col("id").alias("next_id"), F.col("hash").alias("next_hash"), F.col("f").alias("fn")),
        ["next_id", "next_hash"],
    ).select("id", "fn").dropDuplicates(["id"])
    empty = F.array(*[F.lit(0).cast("long")] * LANES)
    return made.join(own, "id", "left").select(
        F.col("id").alias("doc_id"),
        "n_chars",
        "edited_sha256",
        as_text(F.col("f")).alias("fingerprint"),
        as_text(F.col("fe")).alias("edited_fingerprint"),
        likeness(F.col("f"), F.col("fe")).alias("near_edited"),
        likeness(F.col("f"), F.coalesce("fn", empty)).alias("near_next"),
    )

"""N-gram Jaccard join of documents by PartEnum signatures.

A document is the set of its five-word shingles, as 64-bit hashes. The domain of hashes is cut into
equal intervals, and a set signs every interval by a hash of its elements there. Two sets of sizes s and
t with a similarity of 3/4 differ in at most (s + t) / 7 elements, so of more intervals than that they
agree on the rest. Sizes are banded by 4/3; a set signs for its own band and for the next one, so that
any two sets that may be similar meet in a band with one number of intervals (PartEnum with two
second-level partitions, of which each subset of one is signed).

Signatures shared by few sets give candidate pairs. Those shared by many (``LIGHT``) give none as they
stand: a set whose empty and crowded signatures are fewer than the intervals it must agree on with any
partner is sure to meet it in a light one. Only sets without that surety ("hard" ones: near copies in large
groups, texts made of a common passage) are compared within crowded signatures, first with the least of
them, then with those of other components. Every candidate is verified on the whole sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dqspark.llm._arrow import chunks, mix, word_hashes
from dqspark.llm.components import connected_components
from dqspark.plans.storage import stored

WORDS = 5
SMALL = 24
"""Sets of at most this size, and those with too many empty intervals, sign single elements."""
SLACK = 1.2
LIGHT = 16
MAX_SIZE = 2**31
FIXED = 8
"""64-bit words of the sketches of one size, which are compared first."""
BLOCK = 1024
BUCKETS = 64
"""Least number of parts in which a set's signatures are sent, whatever the number of partitions."""
MAX_SENT_IDS = 1_000_000
NO_ID = 2**63 - 1
"""Stands for the id of a class of which no row has one."""
ONE = np.uint64(1)


def band_tops() -> np.ndarray:
    tops = [SMALL]
    while tops[-1] < MAX_SIZE:
        tops.append(tops[-1] * 4 // 3)
    return np.array(tops, np.int64)


TOPS = band_tops()
INTERVALS = np.concatenate([[0], (SLACK * 2 * TOPS[1:] / 7).astype(np.int64) + 3])


def shingle_sets(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each row, one row after the other, and their number by row."""
    words, counts = word_hashes(data, at)
    ends = np.cumsum(counts)
    rolled = np.zeros(len(words), np.uint64)
    for j in range(WORDS):
        rolled[: max(len(words) - j, 0)] += words[j:] * np.uint64(2 * j + 1) ^ (words[j:] >> np.uint64(17 + j))
    rolled = mix(rolled)
    found, sizes = [], np.zeros(len(counts), np.int64)
    for i, n in enumerate(counts):
        if n >= WORDS:
            own = np.sort(rolled[ends[i] - n : ends[i] - WORDS + 1])
            own = own[np.concatenate([[True], own[1:] != own[:-1]])]
        elif n:
            own = words[ends[i] - n : ends[i]]
            own = mix(np.sum(mix(own + np.arange(n, dtype=np.uint64)), keepdims=True) + np.uint64(n))
        else:
            continue
        found.append(own)
        sizes[i] = len(own)
    return (np.concatenate(found) if found else np.zeros(0, np.uint64)), sizes


def set_keys(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """One hash for each set; 0 for empty ones."""
    keys = np.zeros(len(sizes), np.uint64)
    full = sizes > 0
    if full.any():
        starts = (np.cumsum(sizes) - sizes)[full]
        sums = np.add.reduceat(mix(values * np.uint64(0xDA942042E4DD58B5)), starts)
        keys[full] = mix(sums + sizes[full].astype(np.uint64))
    return keys


def bands(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The band of each size and whether a partner may lie in the next band."""
    own = np.searchsorted(TOPS, sizes)
    return own, sizes * 4 // 3 > TOPS[own]


def signed(values: np.ndarray, sizes: np.ndarray, level: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Signatures of the sets for a band each: hashes, the row of each, and each row's allowance.

    The allowance is the number of crowded signatures up to which a set is sure to share another one
    with any partner; below zero its empty intervals alone may hide a partner.
    The lowest bit of a signature is that of its band.
    """
    rows = np.repeat(np.arange(len(sizes)), sizes)
    of = level[rows]
    parts = INTERVALS[of].astype(np.uint64)
    interval = ((values >> np.uint64(32)) * parts) >> np.uint64(32)
    tagged = mix(values ^ (of.astype(np.uint64) << np.uint64(48)))
    new = np.ones(len(values), bool)
    if len(values):
        new[1:] = (rows[1:] != rows[:-1]) | (interval[1:] != interval[:-1])
    starts = np.flatnonzero(new)
    banded = level > 0
    sums = np.add.reduceat(tagged, starts) if len(starts) else np.zeros(0, np.uint64)
    sums = mix(sums + interval[starts] * np.uint64(0x9FB21C651E98DF25) + parts[starts])
    row = rows[starts]
    filled = np.bincount(row, minlength=len(sizes))
    partner = np.minimum(TOPS[level], sizes * 4 // 3)
    allow = INTERVALS[level] - (sizes + partner) // 7 - 1 - (INTERVALS[level] - filled)
    single = ~banded | (allow < 0)
    allow = np.where(banded, allow, (3 * sizes + 3) // 4 - 1)
    keep, alone = banded[row], single[rows]
    hashes = np.concatenate([sums[keep], mix(tagged[alone] + ONE)])
    row = np.concatenate([row[keep], rows[alone]])
    return (hashes & ~ONE) | (level[row].astype(np.uint64) & ONE), row, allow


def document_sets(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, text_hash, n_shingles, key, ...)``: the size and the hash of every document's set, and the
    allowances in its own and in the next band."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, at in chunks(batch.column(1)):
                values, sizes = shingle_sets(data, at)
                own, up = bands(sizes)
                allowed = [signed(values, sizes, level)[2] for level in (own, own + 1)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0)[first:end],
                        batch.column(2)[first:end],
                        pa.array(sizes),
                        pa.array(set_keys(values, sizes).view(np.int64)),
                        pa.array((own & 1).astype(np.int32)),
                        pa.array(allowed[0].astype(np.int32)),
                        pa.array(np.where(up, allowed[1], 0).astype(np.int32)),
                    ],
                    ["doc_id", "text_hash", "n_shingles", "key", "parity", "allow_own", "allow_next"],
                )

    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return texts.withColumn("text_hash", F.xxhash64("text")).mapInArrow(
        read, "doc_id long, text_hash long, n_shingles long, key long, parity int, allow_own int, allow_next int"
    )


def signatures(docs: DataFrame, text: str, buckets: int) -> DataFrame:
    """``(bucket, key, signatures)``: a set's signatures, dealt by their high bits to so many buckets.

    Of a signature the low 32 bits are sent, which with the bucket tell it from others: the number of buckets
    follows that of partitions. Two that agree by chance only make a candidate more.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, at in chunks(batch.column(0)):
                values, sizes = shingle_sets(data, at)
                own, up = bands(sizes)
                keys = set_keys(values, sizes)
                hashes, row = signed(values, sizes, own)[:2]
                more = np.repeat(up, sizes)
                h2, r2, _ = signed(values[more], sizes[up], own[up] + 1)
                hashes, row = np.concatenate([hashes, h2]), np.concatenate([row, np.flatnonzero(up)[r2]])
                if not len(hashes):
                    continue
                bucket = ((hashes >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
                cell = row * buckets + bucket.astype(np.int64)
                order = np.argsort(cell, kind="stable")
                cell, hashes = cell[order], hashes[order]
                starts = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]]))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array((cell[starts] % buckets).astype(np.int32)),
                        pa.array(keys[cell[starts] // buckets].view(np.int64)),
                        pa.ListArray.from_arrays(
                            pa.array(np.append(starts, len(cell)).astype(np.int32)),
                            pa.array(hashes.astype(np.uint32).view(np.int32)),
                        ),
                    ],
                    ["bucket", "key", "signatures"],
                )

    return docs.select(F.col(text).cast("string").alias("text")).mapInArrow(
        read, "bucket int, key long, signatures array<int>"
    )


def meetings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by signature and key: the pairs that meet in a light signature as ``(NULL, a, b)``,
    and the members of crowded ones as ``(signature, key, NULL)``. Holds one batch, the last signature's
    first ``LIGHT`` keys and a bounded set of pairs."""
    held_sig = held_key = np.zeros(0, np.int64)
    crowded: int | None = None
    pairs: list[np.ndarray] = []

    def crowd(sig: np.ndarray, key: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(sig), pa.array(key), pa.nulls(len(sig), pa.int64())], ["signature", "a", "b"]
        )

    def flush() -> Iterator[pa.RecordBatch]:
        if pairs:
            both = np.unique(np.concatenate(pairs), axis=0)
            pairs.clear()
            for k in range(0, len(both), 50_000):
                part = np.ascontiguousarray(both[k : k + 50_000].T)
                yield pa.RecordBatch.from_arrays(
                    [pa.nulls(part.shape[1], pa.int64()), pa.array(part[0]), pa.array(part[1])],
                    ["signature", "a", "b"],
                )

    def settle(sig: np.ndarray, key: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Whole runs of a signature."""
        starts = np.flatnonzero(np.concatenate([[True], sig[1:] != sig[:-1]])) if len(sig) else np.zeros(0, int)
        lengths = np.diff(np.append(starts, len(sig)))
        many = np.repeat(lengths > LIGHT, lengths)
        if many.any():
            yield crowd(sig[many], key[many])
        for n in range(2, LIGHT + 1):
            of = starts[lengths == n]
            if len(of):
                i, j = np.triu_indices(n, 1)
                pairs.append(np.stack([key[of[:, None] + i].ravel(), key[of[:, None] + j].ravel()], axis=1))
        if sum(map(len, pairs)) > 400_000:
            yield from flush()

    for batch in batches:
        sig, key = (batch.column(c).to_numpy(zero_copy_only=False) for c in (0, 1))
        sig, key = np.concatenate([held_sig, sig]), np.concatenate([held_key, key])
        new = np.ones(len(sig), bool)
        new[1:] = (sig[1:] != sig[:-1]) | (key[1:] != key[:-1])
        sig, key = sig[new], key[new]
        if not len(sig):
            continue
        if crowded is not None:
            n = int(np.searchsorted(sig, crowded, "right"))
            if n:
                yield crowd(sig[:n], key[:n])
            if n == len(sig):
                held_sig, held_key = sig[:0], key[:0]
                continue
            sig, key, crowded = sig[n:], key[n:], None
        last = int(np.searchsorted(sig, sig[-1], "left"))
        yield from settle(sig[:last], key[:last])
        held_sig, held_key = sig[last:], key[last:]
        if len(held_sig) > LIGHT:
            crowded = int(held_sig[0])
            yield crowd(held_sig, held_key)
            held_sig, held_key = held_sig[:0], held_key[:0]
    yield from settle(held_sig, held_key)
    yield from flush()


def _may_be_near() -> Column:
    """Whether sets a and b, of sizes ``na`` and ``nb`` and sketches ``sa`` and ``sb``, may have a similarity of 3/4.

    The bits in which two sketches differ are no more than the elements in which the sets do, so no link
    is lost. Sketches of one size for all sets come first, as plain columns; then those that grow with the
    set, the larger folded onto the size of the other one.
    """
    fixed = sum((F.bit_count(F.col(f"w{i}a").bitwiseXOR(F.col(f"w{i}b"))) for i in range(FIXED)), F.lit(0))
    halves = lambda x, y: F.when(F.size(x) <= F.size(y), F.col(x)).otherwise(
        F.zip_with(F.slice(x, 1, F.size(y)), F.slice(x, F.size(y) + 1, F.size(y)), lambda u, v: u.bitwiseXOR(v))
    )
    differ = F.aggregate(
        F.zip_with(halves("sa", "sb"), halves("sb", "sa"), lambda u, v: F.bit_count(u.bitwiseXOR(v))),
        F.lit(0), lambda total, n: total + n,
    )
    sizes = 4 * F.least("na", "nb") >= 3 * F.greatest("na", "nb")
    most = F.col("na") + F.col("nb")
    return sizes & (7 * fixed <= most) & (7 * differ <= most)


def _sketched(rows: DataFrame, side: str) -> DataFrame:
    """``key``, sizes and sketches of one side, ``a`` or ``b``, under the names of the conditions."""
    renamed = {"key": side, "root": f"r{side}", "sketch": f"s{side}", "n": f"n{side}"}
    renamed |= {f"w{i}": f"w{i}{side}" for i in range(FIXED)}
    return rows.withColumnsRenamed(renamed)


def near_pairs(pairs: DataFrame, bits: DataFrame) -> DataFrame:
    """The pairs of keys whose sketches allow a link."""
    joined = pairs.join(_sketched(bits, "a"), "a").join(_sketched(bits, "b"), "b")
    return joined.filter(_may_be_near()).select("a", "b").distinct()


def _texts_of(docs: DataFrame, doc_id: str, text: str, keys: DataFrame, classes: DataFrame) -> DataFrame:
    """``(doc_id, text)`` of the least document of each key; the ids are broadcast if a count allows it."""
    ids = stored(keys.join(classes, "key").select(F.col("least").alias("doc_id")).distinct(), "ids")
    ids = F.broadcast(ids) if ids.count() <= MAX_SENT_IDS else ids
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.join(ids, "doc_id", "left_semi")


def _linked(near: DataFrame, docs: DataFrame, doc_id: str, text: str, classes: DataFrame) -> DataFrame:
    """The pairs that link, by the whole sets of their members, which are read once more."""
    keys = near.select(F.col("a").alias("key")).unionAll(near.select(F.col("b").alias("key"))).distinct()
    arrays = stored(whole_sets(_texts_of(docs, doc_id, text, keys, classes)), "arrays")
    return verified(near, arrays).distinct()


def verified(pairs: DataFrame, arrays: DataFrame) -> DataFrame:
    """The pairs of keys whose sets have a similarity of 3/4 or more, with the least documents of both."""
    a, b = (
        arrays.select(F.col("key").alias(k), F.col("doc_id").alias(f"doc_{k}"), F.col("shingles").alias(f"s{k}")) for k in "ab"
    )
    common = F.size(F.array_intersect("sa", "sb"))
    union = F.size("sa") + F.size("sb") - common
    both = pairs.join(a, "a").join(b, "b")
    return both.filter(100 * common >= 75 * union).select("a", "b", "doc_a", "doc_b")


def _across(tied: DataFrame, parts: int) -> DataFrame:
    """Pairs of keys in one signature but in different components, if their fixed sketches allow a link.

    ``tied`` has a signature's number of ``members`` in each of its rows. The members are dealt to blocks of about
    ``BLOCK``, and every two blocks of a signature meet in a cell, so a task holds two blocks at most, however many
    members there are.
    """
    words = [f"w{i}" for i in range(FIXED)]
    cells = (
        tied.withColumn("blocks", F.ceil(F.col("members") / BLOCK))
        .withColumn("block", F.pmod(F.xxhash64("key"), F.col("blocks")))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        .select(
            "signature", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"),
            "block", "key", "root", F.col("n").cast("long").alias("n"), *words,
        )
    )
    return (
        cells.repartition(parts, "signature", "lo", "hi")
        .sortWithinPartitions("signature", "lo", "hi")
        .mapInArrow(_compare_cells, "a long, b long")
        .distinct()
    )


def _compare_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Near pairs of the cells of rows sorted by cell, of which one is held at a time."""
    held: np.ndarray | None = None
    pairs: list[np.ndarray] = []

    def flush() -> Iterator[pa.RecordBatch]:
        both = np.unique(np.concatenate(pairs), axis=0) if pairs else np.zeros((0, 2), np.int64)
        pairs.clear()
        if len(both):
            yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in both.T], ["a", "b"])

    def compare(cell: np.ndarray) -> None:
        # Only members outside the most common component can be in a pair that is asked for on one side.
        roots, at, n = np.unique(cell[:, 5], return_inverse=True, return_counts=True)
        odd = np.flatnonzero(at != n.argmax())
        for begin in range(0, len(odd), 64):
            x = cell[odd[begin : begin + 64]]
            apart = (x[:, None, 5] != cell[None, :, 5]) & ((cell[0, 1] == cell[0, 2]) | (x[:, None, 3] != cell[None, :, 3]))
            differ = np.bitwise_count(x[:, None, 7:] ^ cell[None, :, 7:]).sum(axis=2, dtype=np.int64)
            total = x[:, None, 6] + cell[None, :, 6]
            near = apart & (7 * differ <= total) & (7 * np.minimum(x[:, None, 6], cell[None, :, 6]) >= 3 * total)
            i, j = np.nonzero(near)
            both = np.stack([x[i, 4], cell[j, 4]], axis=1)
            pairs.append(np.unique(np.sort(both, axis=1), axis=0))

    for batch in batches:
        rows = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns], axis=1)
        rows = rows if held is None else np.concatenate([held, rows])
        if not len(rows):
            continue
        starts = np.flatnonzero(np.append(True, (rows[1:, :3] != rows[:-1, :3]).any(axis=1)))
        for begin, end in zip(starts[:-1], starts[1:], strict=True):
            compare(rows[begin:end])
        held = rows[starts[-1] :]
        if sum(map(len, pairs)) > 200_000:
            yield from flush()
    if held is not None:
        compare(held)
    yield from flush()


def sketches(values: np.ndarray, sizes: np.ndarray, fixed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """For each set a row of bits, at least as many as it has elements, a power of two from 64 (or ``fixed`` words):
    the parity of the number of elements whose hash points to each. As 64-bit words, and their number by row."""
    words = 1 << np.maximum(np.ceil(np.log2(np.maximum(sizes, 1))).astype(np.int64) - 6, 0)
    words = np.full(len(sizes), fixed) if fixed else words
    row = np.repeat(np.arange(len(sizes)), sizes)
    bit = (mix(values) & (words[row] * 64 - 1).astype(np.uint64)).astype(np.int64)
    parity = np.bincount((np.cumsum(words) - words)[row] * 64 + bit, minlength=int(words.sum()) * 64) & 1
    return np.packbits(parity.astype(bool), bitorder="little").view(np.int64), words


def whole_sets(texts: DataFrame) -> DataFrame:
    """``(doc_id, key, shingles)`` of every row of ``(doc_id, text)``."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, at in chunks(batch.column(1)):
                values, sizes = shingle_sets(data, at)
                cuts = pa.array(np.append(0, np.cumsum(sizes)).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0)[first:end],
                        pa.array(set_keys(values, sizes).view(np.int64)),
                        pa.ListArray.from_arrays(cuts, pa.array(values.view(np.int64))),
                    ],
                    ["doc_id", "key", "shingles"],
                )

    return texts.mapInArrow(read, "doc_id long, key long, shingles array<long>")


def document_sketches(texts: DataFrame) -> DataFrame:
    """``(key, n, sketch, w0, w1, ...)``, the size and the sketches of every row's set."""
    names = ["key", "n", "sketch", *(f"w{i}" for i in range(FIXED))]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, at in chunks(batch.column(0)):
                values, sizes = shingle_sets(data, at)
                bits, words = sketches(values, sizes)
                first_bits = sketches(values, sizes, FIXED)[0].reshape(-1, FIXED)
                cuts = pa.array(np.append(0, np.cumsum(words)).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(set_keys(values, sizes).view(np.int64)),
                        pa.array(sizes),
                        pa.ListArray.from_arrays(cuts, pa.array(bits)),
                        *(pa.array(np.ascontiguousarray(first_bits[:, i])) for i in range(FIXED)),
                    ],
                    names,
                )

    schema = "key long, n long, sketch array<long>" + "".join(f", w{i} long" for i in range(FIXED))
    return texts.select("text").mapInArrow(read, schema)


def jaccard_components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` for every row of ``docs``, as by :func:`components_of_texts`."""
    return components_of_texts(docs, doc_id, text).drop("text_hash")


def components_of_texts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, n_shingles, component_id, text_hash)`` for every row of ``docs``; other columns are not read.

    Documents link when their sets of five-word shingles (A-Z lower-cased; all words as one shingle
    where there are fewer) have a similarity of 0.75 or more; ``component_id`` is the least document
    that links reach. NULL, empty and blank texts have an empty set and link with nothing, also not with
    each other. Equal texts link as any others. A row with a NULL ``doc_id`` links but is never the
    least one. Repeated rows give repeated rows; rows of one id with different texts, which ``text_hash`` (Spark's
    ``xxhash64``) tells apart, each have their own component. Ids are whole numbers. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    sets = stored(document_sets(docs, doc_id, text), "sets")
    # Equal sets are one class from here on.
    classes = sets.filter("n_shingles > 0").groupBy("key", "n_shingles").agg(
        F.min("doc_id").alias("least"),
        F.first("parity").alias("parity"),
        F.first("allow_own").alias("allow_own"),
        F.first("allow_next").alias("allow_next"),
    )
    classes = stored(classes, "classes")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    met = (
        signatures(docs, text, max(parts, BUCKETS))
        .repartitionById(parts, F.col("bucket") % parts)
        .select("bucket", "key", F.explode("signatures").alias("low"))
        .select(F.shiftleft(F.col("bucket").cast("long"), 32).bitwiseOR(F.col("low").cast("long").bitwiseAND(F.lit(2**32 - 1))).alias("signature"), "key")
        .sortWithinPartitions("signature", "key")
        .mapInArrow(meetings, "signature long, a long, b long")
    )
    met = stored(met, "meetings")
    light = met.filter("signature is null").select("a", "b")
    hard = _hard_members(met.filter("signature is not null").select("signature", F.col("a").alias("key")), classes)
    hard = stored(hard, "hard")
    # Of near copies, the one that shares the most signatures is near to most others.
    leaders = hard.groupBy("signature").agg(F.max(F.struct("crowded", "key")).alias("leader"), F.count("*").alias("members"))
    leaders = leaders.select("signature", F.col("leader.key").alias("leader"), "members")
    led = stored(hard.join(leaders, "signature").drop("crowded"), "led")
    starred = led.filter("key <> leader").select(F.least("key", "leader").alias("a"), F.greatest("key", "leader").alias("b"))
    pairs = stored(light.unionAll(starred).distinct(), "pairs")

    wanted = pairs.select(F.col("a").alias("key")).unionAll(pairs.select(F.col("b").alias("key")))
    wanted = wanted.unionAll(led.select("key")).distinct()
    bits = stored(document_sketches(_texts_of(docs, doc_id, text, wanted, classes)), "sketches")
    near = stored(near_pairs(pairs, bits), "near")
    links = stored(_linked(near, docs, doc_id, text, classes), "verified")
    roots = stored(_components(links), "roots")
    # Within crowded signatures, members of different components have not met: compare them all. Rows of members are
    # joined once with what is known of their signature, once with their component and once with the open signatures.
    rooted = led.join(roots.select("key", F.col("root.key").alias("root")), "key", "left")
    rooted = stored(rooted.select("signature", "key", "members", F.coalesce("root", "key").alias("root")), "rooted")
    open_ = rooted.groupBy("signature").agg(F.min("root").alias("r0"), F.max("root").alias("r1")).filter("r0 < r1")
    tied = rooted.join(open_.select("signature"), "signature", "left_semi").join(bits.drop("sketch"), "key")
    rest = stored(_across(tied, parts).join(pairs, ["a", "b"], "left_anti"), "rest")
    rest = _linked(stored(near_pairs(rest, bits), "near"), docs, doc_id, text, classes)
    more = stored(links.unionAll(rest.select(links.columns)), "links")
    named = classes.join(_components(more), "key", "left").select(
        "key", "n_shingles", F.nullif(F.coalesce("root.least", "least"), F.lit(NO_ID)).alias("component_id")
    )
    return sets.join(named, ["key", "n_shingles"], "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"), "text_hash"
    )


def _components(links: DataFrame) -> DataFrame:
    """``(key, root)`` of the classes in links. A node is a class's least document and its key, so that the root of a
    component has its least document, and texts that share an id are nodes of their own."""
    nodes = [F.struct(F.coalesce(f"doc_{k}", F.lit(NO_ID)).alias("least"), F.col(k).alias("key")).alias(k) for k in "ab"]
    return connected_components(links.select(*nodes)).select(F.col("node.key").alias("key"), "root")


def _hard_members(crowded: DataFrame, classes: DataFrame) -> DataFrame:
    """Members of crowded signatures that may hide a partner: more of them than the set's allowance."""
    parity = F.col("signature").bitwiseAND(F.lit(1)).cast("int")
    counts = crowded.groupBy("key", parity.alias("bit")).agg(F.count("*").alias("crowded"))
    allow = F.when(F.col("bit") == F.col("parity"), F.col("allow_own")).otherwise(F.col("allow_next"))
    hard = counts.join(classes, "key").filter(F.col("crowded") > allow).select("key", "bit", "crowded")
    return crowded.withColumn("bit", parity).join(hard, ["key", "bit"]).select("signature", "key", "crowded")

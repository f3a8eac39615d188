"""Language identification by the nearest of several centroids of byte n-gram vectors.

A text is rejected if it is too far from its nearest centroid. How far that is depends on the length, as short texts have
few n-grams in common with any centroid, and is learned from the cosines of all labelled texts and of pieces of them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from dqspark.llm._arrow import mix

DIMENSIONS = 8192
N = 3
SAMPLE_PER_LANGUAGE = 1000
"""About so many different labelled texts of each language, chosen by a hash of the text, place its centroids."""
CENTROIDS = 3
ROUNDS = 10
BANDS = 24
"""Lengths are told apart by the binary logarithm of the number of n-grams."""
BINS = 256
"""Cosines are counted in so many bins."""
TAIL = 0.001
SLACK = 0.7
"""A text is rejected below ``SLACK`` of the cosine that all but ``TAIL`` of the labelled texts of its length reach."""
LEAST_TEXTS = 100
"""Labelled texts of a length, from which a centroid, or else all together, say what is too far."""
LETTER = regex.compile(r"\p{L}")
ROWS = 256
LETTERS = bytes(c if c >= 128 or chr(c).isalpha() else 32 for c in range(256))
"""Digits, marks and blanks of ASCII become blanks."""


def held_out(doc_id: Column, folds: int = 5, fold: int = 0) -> Column:
    """Whether crc32 of the id as text leaves ``fold`` modulo ``folds``; a NULL id is never held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(False))


def gram_slots(data: bytes) -> np.ndarray:
    """The slots of the hashed byte n-grams of a text's words, lower-cased, with one blank between them."""
    chars = np.frombuffer(data, np.uint8)
    blank = chars == 32
    chars = chars[~(blank & np.append(False, blank[:-1]))].astype(np.uint64)
    if len(chars) < N:
        return np.zeros(0, np.int64)
    gram = chars[:-2] << np.uint64(16) | chars[1:-1] << np.uint64(8) | chars[2:]
    return (mix(gram) >> np.uint64(64 - (DIMENSIONS - 1).bit_length())).astype(np.int64)


def slots_of(texts: list[str | None]) -> list[np.ndarray]:
    return [gram_slots(f" {(t or '').lower()} ".encode("utf-8", "replace").translate(LETTERS)) for t in texts]


def gram_counts(texts: list[str | None]) -> np.ndarray:
    """Counts of each text's n-grams by slot."""
    return counts_of(slots_of(texts))


def counts_of(slots: list[np.ndarray]) -> np.ndarray:
    counts = np.zeros((len(slots), DIMENSIONS), np.float32)
    for row, mine in zip(counts, slots, strict=True):
        row[:] = np.bincount(mine, minlength=DIMENSIONS)
    return counts


def band_of(n_grams: np.ndarray) -> np.ndarray:
    return np.minimum(np.log2(np.maximum(n_grams, 1)).astype(int), BANDS - 1)


def vectors(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Normalised TF-IDF vectors with dampened counts; a text without n-grams has a zero vector."""
    weighted = np.log1p(counts) * idf
    norms = np.linalg.norm(weighted, axis=1, keepdims=True)
    return weighted / np.where(norms > 0, norms, 1)


@dataclass
class LanguageModel:
    """Languages, IDF weights, unit centroids with the language of each, and the least cosine by centroid and band."""

    languages: list[str]
    idf: np.ndarray
    centroids: np.ndarray
    of: np.ndarray
    bounds: np.ndarray

    def nearest(self, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest centroid of each row of counts and its cosine, from 0 to 1."""
        cosines = vectors(counts, self.idf) @ self.centroids.T
        best = cosines.argmax(axis=1)
        return best, np.clip(cosines[np.arange(len(best)), best], 0.0, 1.0)

    def predict(self, texts: list[str | None]) -> list[tuple[str, float, bool]]:
        """The language of the nearest centroid, its cosine, and whether that is too far to be believed."""
        if not self.languages:
            return [("und", 0.0, True) for _ in texts]
        counts = gram_counts(texts)
        best, scores = self.nearest(counts)
        bounds = self.bounds[best, band_of(counts.sum(axis=1))]
        out = []
        for text, near, score, bound in zip(texts, best, scores, bounds, strict=True):
            if not text or not LETTER.search(text):
                out.append(("und", 0.0, True))
            else:
                out.append((self.languages[self.of[near]], float(score), bool(score < bound)))
        return out


def least_cosines(seen: np.ndarray) -> np.ndarray:
    """By centroid and band, the cosine below which a text is too far, from counts by centroid, band and bin.

    A centroid without enough texts in a band takes the bound of all centroids together; where these have too few as
    well, that of the next shorter band holds, as longer texts come nearer. The shortest have none.
    """

    def bound(bins: np.ndarray) -> float | None:
        n = bins.sum()
        if n < LEAST_TEXTS:
            return None
        return SLACK * float(np.searchsorted(np.cumsum(bins), TAIL * n, side="right")) / BINS

    bounds = np.zeros(seen.shape[:2])
    for c in range(seen.shape[0]):
        for band in range(seen.shape[1]):
            shorter = bounds[c, band - 1] if band else 0.0
            found = [b for b in (bound(seen[c, band]), bound(seen[:, band].sum(axis=0))) if b is not None]
            bounds[c, band] = found[0] if found else shorter
    return bounds


def clustered(rows: np.ndarray, k: int) -> np.ndarray:
    """Centroids of unit vectors by cosine, begun with rows far from each other; the same on each run."""
    centres = [rows.mean(axis=0)]
    centres[0] /= max(np.linalg.norm(centres[0]), 1e-12)
    while len(centres) < min(k, len(rows)):
        centres.append(rows[np.max(rows @ np.array(centres).T, axis=1).argmin()])
    centres = np.array(centres)
    for _ in range(ROUNDS):
        nearest = (rows @ centres.T).argmax(axis=1)
        for c in range(len(centres)):
            if (nearest == c).any():
                mean = rows[nearest == c].mean(axis=0)
                centres[c] = mean / max(np.linalg.norm(mean), 1e-12)
    return centres


def fit_languages(labelled: DataFrame, text: str = "text", lang: str = "lang") -> LanguageModel:
    """Learn from rows with a language and a text. This runs four jobs.

    Document frequencies cover all rows; each task adds up its own, so one row of ``DIMENSIONS`` numbers
    a task reaches the shuffle. The centroids of a language come from a sample of about ``SAMPLE_PER_LANGUAGE``
    different texts, taken by a hash of the text; copies count once in it. How far a text may be from its centroid comes from
    all different texts, each as a whole and by a piece of it whose length a hash of the text tells, so that all lengths
    occur: counts by centroid, length band and cosine. Ids are not looked at and may be NULL. The number of languages is taken
    to be small. No labelled row gives a model without languages, which predicts ``und``.
    """
    rows = labelled.filter(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang")
    )

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, n = np.zeros(DIMENSIONS, np.int64), 0
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                texts = batch.column(0).slice(at, ROWS).to_pylist()
                seen += (gram_counts(texts) > 0).sum(axis=0)
                n += len(texts)
        both = np.append(seen, n)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(both))), pa.array(both)], ["slot", "n"])

    spread = rows.select("text").mapInArrow(frequencies, "slot long, n long")
    found = dict(spread.groupBy("slot").agg(F.sum("n").alias("n")).collect())
    seen = np.array([found.get(i, 0) for i in range(DIMENSIONS)], float)
    idf = np.log((1 + found.get(DIMENSIONS, 0)) / (1 + seen)).astype(np.float32) + 1

    different = F.approx_count_distinct(F.xxhash64("text"))
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(different.alias("n")).collect()}
    languages = sorted(sizes)
    empty = LanguageModel([], idf, np.zeros((0, DIMENSIONS)), np.zeros(0, int), np.zeros((0, BANDS)))
    if not languages:
        return empty
    parts = [(k, min(1.0, SAMPLE_PER_LANGUAGE / sizes[k])) for k in languages]
    part = F.create_map(*[F.lit(x) for pair in parts for x in pair])
    place = F.pmod(F.xxhash64("text", F.lit("sample")), F.lit(1_000_003)) / 1_000_003
    chosen = rows.filter(place < F.element_at(part, F.col("lang")))
    sample = chosen.withColumn("key", F.xxhash64("text", "lang")).dropDuplicates(["key"])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                some = batch.slice(at, ROWS)
                made = [np.unique(s, return_counts=True) for s in slots_of(some.column(0).to_pylist())]
                slots = pa.array([s.astype(np.uint16).tobytes() for s, _ in made], pa.binary())
                counts = pa.array([n.astype(np.uint32).tobytes() for _, n in made], pa.binary())
                yield pa.RecordBatch.from_arrays([some.column(1), some.column(2), slots, counts], ["lang", "key", "slots", "counts"])

    found = sample.select("text", "lang", "key").mapInArrow(
        counted, "lang string, key long, slots binary, counts binary"
    ).toArrow().sort_by("key")
    centroids, of = [], []
    for k, name in enumerate(languages):
        mine = found.filter(pc.equal(found["lang"], name))
        if not mine.num_rows:
            continue
        counts = np.zeros((mine.num_rows, DIMENSIONS), np.float32)
        for row, slots, n in zip(counts, mine["slots"].to_pylist(), mine["counts"].to_pylist(), strict=True):
            row[np.frombuffer(slots, np.uint16)] = np.frombuffer(n, np.uint32)
        own = clustered(vectors(counts, idf), CENTROIDS)
        centroids.append(own)
        of += [k] * len(own)
    if not centroids:
        return empty
    model = LanguageModel(languages, idf, np.concatenate(centroids).astype(np.float32), np.array(of, int), np.zeros((0, 0)))
    model.bounds = least_cosines(cosine_counts(rows, model))
    return model


def pieces(texts: list[str], slots: list[np.ndarray]) -> list[np.ndarray]:
    """A run of n-grams of each text, its length (less than the text's) and its place told by a hash of the text."""
    out = []
    for text, mine in zip(texts, slots, strict=True):
        key = xxhash.xxh64_intdigest(text.encode("utf-8", "replace"))
        bands = max(1, len(mine).bit_length() - 1)
        low = 1 << (key % bands)
        n = min(len(mine), low + (key >> 8) % low)
        start = (key >> 32) % (len(mine) - n + 1)
        out.append(mine[start : start + n])
    return out


def cosine_counts(rows: DataFrame, model: LanguageModel) -> np.ndarray:
    """How many labelled texts, and pieces of them, have each cosine with their nearest centroid, by centroid and band; only
    those count that are nearest to a centroid of their own language, and copies of a text once. Two hashes of a text
    with their places are shuffled."""
    shape = (len(model.centroids), BANDS, BINS)
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        names = np.array(model.languages)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                texts, langs, keys = (batch.column(i).slice(at, ROWS) for i in range(3))
                texts, langs, keys = texts.to_pylist(), np.array(langs.to_pylist()), keys.to_numpy(zero_copy_only=False)
                whole = slots_of(texts)
                for slots in (whole, pieces(texts, whole)):
                    counts = counts_of(slots)
                    best, score = model.nearest(counts)
                    sizes = counts.sum(axis=1)
                    right = (names[model.of[best]] == langs) & (sizes > 0)
                    bins = np.minimum((score * BINS).astype(int), BINS - 1)
                    places = np.ravel_multi_index((best, band_of(sizes), bins), shape)[right]
                    yield pa.RecordBatch.from_arrays([pa.array(places), pa.array(keys[right])], ["place", "key"])

    spread = rows.select("text", "lang", F.xxhash64("text").alias("key")).mapInArrow(measured, "place long, key long")
    found = spread.distinct().groupBy("place").agg(F.count("*").alias("n")).toArrow()
    out = np.zeros(int(np.prod(shape)), np.int64)
    out[found["place"].to_numpy()] = found["n"].to_numpy()
    return out.reshape(shape)


def identify_languages(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` and ``rejected``.

    ``lang_pred`` is the language of the nearest centroid and ``score`` its cosine, from 0 to 1; NULL texts
    and those without a letter are ``und`` with score 0. ``rejected`` is true for ``und`` and where the
    nearest centroid is too far for a text of that length. Only the text is looked at. Repeated rows give equal predictions, an
    empty table an empty result; columns named as the results are replaced. The model's size, the
    languages times their centroids, bounds what is sent to executors.
    """
    docs = docs.drop("lang_pred", "score", "rejected")
    names = [*docs.columns, "lang_pred", "score", "rejected"]
    at_text = docs.columns.index(text)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                made = shared.value.predict(batch.column(at_text).to_pylist())
                lang, score, rejected = zip(*made, strict=True)
                new = [pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(rejected, pa.bool_())]
                yield pa.RecordBatch.from_arrays([*batch.columns, *new], names)

    made = StructType.fromDDL("lang_pred string, score double, rejected boolean")
    return docs.mapInArrow(predict, StructType(docs.schema.fields + made.fields))

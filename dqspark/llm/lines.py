"""Line dedup over levelled sorted runs of line hashes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dqspark.plans.storage import scratch_path, stored

BLANKS = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LEAST_POINTS = 20
LEAST_DOCUMENTS = 3
FAN = 4
BATCHES = 4
RUN = "lo long, hi long, n_docs long, last_doc long"


def line_key(line: Column) -> Column:
    """The line stripped of ``[\\x20\\x09-\\x0D]`` at both ends with A-Z lower-cased."""
    bare = F.btrim(line, F.lit(BLANKS))
    ascii_only = F.char_length(bare) == F.octet_length(bare)
    return F.when(ascii_only, F.lower(bare)).otherwise(F.translate(bare, UPPER, UPPER.lower()))


class LineRuns:
    """A store of line keys as sorted runs in levels.

    A run is a table of key hashes (two of 64 bits), each once, sorted within hash partitions, with the
    number of documents that hold the key and the greatest of them. A batch adds a run to level 0; ``FAN``
    runs of a level are merged into one of the next, so that after n batches there are at most
    ``FAN`` runs a level and log n levels, and a key is rewritten log n times. Documents of one id must
    come in one batch.
    """

    def __init__(self, spark: SparkSession, fan: int = FAN):
        self.spark, self.fan = spark, fan
        self.levels: list[list[str]] = []

    def add(self, keys: DataFrame) -> None:
        """Add a batch of ``(lo, hi, doc)``, with repeats or without."""
        once = keys.groupBy("lo", "hi", "doc").agg(F.lit(1).alias("one"))
        run = once.groupBy("lo", "hi").agg(F.count("*").alias("n_docs"), F.max("doc").alias("last_doc"))
        self._place(run, 0)

    def _place(self, run: DataFrame, level: int) -> None:
        path = scratch_path(self.spark, "run")
        run.sortWithinPartitions("lo", "hi").write.parquet(path)
        if len(self.levels) == level:
            self.levels.append([])
        self.levels[level].append(path)
        if len(self.levels[level]) >= self.fan:
            merged = self._merged(self.levels[level])
            self.levels[level] = []
            self._place(merged, level + 1)

    def _merged(self, paths: list[str]) -> DataFrame:
        rows = self.spark.read.schema(RUN).parquet(*paths)
        return rows.groupBy("lo", "hi").agg(F.sum("n_docs").alias("n_docs"), F.max("last_doc").alias("last_doc"))

    def keys(self) -> DataFrame:
        """All keys with their counts over the runs."""
        paths = [p for level in self.levels for p in level]
        return self._merged(paths) if paths else self.spark.createDataFrame([], RUN)

    def unseen(self, keys: DataFrame) -> DataFrame:
        """The rows of a batch whose key no run holds: a merge anti-join with the runs."""
        return keys.join(self.keys().select("lo", "hi"), ["lo", "hi"], "left_anti")


def keyed_lines(docs: DataFrame, doc_id: str, text: str, least: int = LEAST_POINTS) -> DataFrame:
    """``(lo, hi, doc, text_hash, place)`` of every line whose key has ``least`` code points."""
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    lines = docs.select(
        F.coalesce(F.col(doc_id).cast("long"), F.lit(-(2**63))).alias("doc"),
        F.xxhash64(t).alias("text_hash"),
        F.posexplode(F.split(t, "\n", -1)).alias("place", "line"),
    ).filter(F.char_length("line") >= least)
    keyed = lines.select("doc", "text_hash", "place", line_key(F.col("line")).alias("key")).filter(F.char_length("key") >= least)
    return keyed.select(F.xxhash64("key").alias("lo"), F.xxhash64(F.lit(1), "key").alias("hi"), "doc", "text_hash", "place")


def dedup_batch(runs: LineRuns, batch: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The lines of a new batch whose key no earlier batch had, as ``(lo, hi, doc, text_hash, place)``; the
    batch's own keys are then in the runs. This runs jobs."""
    keys = stored(keyed_lines(batch, doc_id, text), "lines")
    new = stored(runs.unseen(keys), "lines")
    runs.add(keys.select("lo", "hi", "doc"))
    return new


def dedup_lines(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    least_documents: int = LEAST_DOCUMENTS,
    batches: int = BATCHES,
) -> DataFrame:
    """``docs`` with its text less repeated lines, and ``n_lines`` and ``n_dropped``.

    A text is cut at ``\\n``; a line's key is the line stripped of blanks with A-Z lower-cased. Keys
    of at least 20 code points in at least ``least_documents`` documents lose all their lines but those in
    the greatest ``doc_id`` that has the key, where every repeat stays. Other lines stay as they are,
    joined by ``\\n``. The documents come in ``batches`` by a hash of the id, each of which adds a run; a
    key's count is that over all of them. Crowded keys are joined by hash after being counted before the
    shuffle.

    A NULL or empty text is one empty line and stays. Rows with a NULL id are one
    document, the smallest. Repeated rows count once and keep or lose the same lines. An empty table
    gives an empty result. Columns of ``docs`` named ``n_lines`` or ``n_dropped`` are replaced.
    """
    spark = docs.sparkSession
    keys = stored(keyed_lines(docs, doc_id, text), "lines")
    runs = LineRuns(spark)
    for b in range(batches):
        runs.add(keys.filter(F.pmod(F.xxhash64("doc"), F.lit(batches)) == b).select("lo", "hi", "doc"))
    common = runs.keys().filter(F.col("n_docs") >= least_documents).select("lo", "hi", "last_doc")
    lost = keys.join(common, ["lo", "hi"]).filter("doc < last_doc")
    lost = lost.groupBy("doc", "text_hash").agg(F.collect_set("place").alias("lost"))
    lost = stored(lost.toDF("_doc", "_hash", "_lost"), "lost")

    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    joined = docs.withColumns({
        "_doc": F.coalesce(F.col(doc_id).cast("long"), F.lit(-(2**63))),
        "_hash": F.xxhash64(t),
    }).join(lost, ["_doc", "_hash"], "left").drop("n_lines", "n_dropped")
    joined = joined.withColumn("_lines", F.split(t, "\n", -1))
    places = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), "_lost")
    kept = F.transform(places, lambda i: F.element_at("_lines", i + 1))
    return joined.withColumns({
        "n_lines": F.size("_lines").cast("long"),
        "n_dropped": F.coalesce(F.size("_lost"), F.lit(0)).cast("long"),
        text: F.when(F.col("_lost").isNull(), F.col(text)).otherwise(F.array_join(kept, "\n")),
    }).drop("_doc", "_hash", "_lost", "_lines")

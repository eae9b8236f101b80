"""Line dedup with levelled runs of line hashes.

The state is a set of runs: Parquet files sorted by line hash, with the number of documents that hold
the line. A batch of documents first anti-joins the settled run, the keys already known to be common,
then adds a run of its own at level 0. When a level holds `fan_in` runs they are merged into one of
the next level, so that a key is rewritten a logarithmic number of times; keys that reach the limit
leave the runs and become settled.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shelfline.llm.common import BLANKS, ascii_lower
from shelfline.session import freeze, run_dir

HASHES = ["h1", "h2"]
MIN_DOCS = 10
BATCHES = 4
FAN_IN = 3
# Keys that are broadcast: 16 bytes each, some 50 MB in a hash relation. Beyond it the join shuffles.
BROADCAST_KEYS = 500_000


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def keys_of(text: Column) -> Column:
    """The key of each line: A-Z in lower case, then no blanks at either end."""
    return F.transform(lines_of(ascii_lower(F.coalesce(text, F.lit("")))), lambda x: F.btrim(x, F.lit(BLANKS)))


def hashes(key: str) -> list[Column]:
    """128 bits of a key."""
    return [F.xxhash64(key).alias("h1"), F.xxhash64(F.lit("line"), key).alias("h2")]


class LineRuns:
    """Levelled runs below a folder that every executor can reach."""

    def __init__(self, spark: SparkSession, folder: str, min_docs: int = MIN_DOCS, fan_in: int = FAN_IN):
        self.spark, self.folder, self.min_docs, self.fan_in = spark, folder, min_docs, fan_in
        self.levels: list[list[str]] = []
        self.settled: list[str] = []
        self.written = 0

    def _write(self, rows: DataFrame) -> str:
        path, self.written = f"{self.folder}/{self.written:05d}", self.written + 1
        rows.sortWithinPartitions(*HASHES).write.parquet(path)
        return path

    def _read(self, paths: list[str]) -> DataFrame:
        return self.spark.read.schema("h1 long, h2 long, n long").parquet(*paths)

    def add(self, docs: DataFrame, text_column: str) -> None:
        """Counts in how many documents of the batch each line occurs; a line counts once a document."""
        keys = docs.select(F.explode_outer(  # outer: a plain explode would compute its array once more, as a filter
            F.array_distinct(keys_of(F.col(text_column)))).alias("key")).where("key != ''")
        counts = keys.select(*hashes("key")).groupBy(*HASHES).agg(F.count("*").alias("n"))
        if self.settled:
            counts = counts.join(self._read(self.settled).select(*HASHES), HASHES, "left_anti")
        self._place(self._write(counts), 0)

    def _place(self, path: str, level: int) -> None:
        if level == len(self.levels):
            self.levels.append([])
        self.levels[level].append(path)
        if len(self.levels[level]) >= self.fan_in:
            merged = self._merge(self.levels[level])
            self.levels[level] = []
            self._place(merged, level + 1)

    def _merge(self, runs: list[str]) -> str:
        """One run of several; keys over the limit go to the settled ones."""
        rows = freeze(self._read(runs).groupBy(*HASHES).agg(F.sum("n").alias("n")), "merged")
        self.settled.append(self._write(rows.where(F.col("n") >= self.min_docs)))
        return self._write(rows.where(F.col("n") < self.min_docs))

    def common(self) -> DataFrame:
        """All keys in at least `min_docs` documents: merges what is left, whatever its level."""
        left = [path for level in self.levels for path in level]
        if left:
            self.levels = [[self._merge(left)]]
        return self._read(self.settled).select(*HASHES) if self.settled else self.spark.createDataFrame(
            [], "h1 long, h2 long")


def batches_of(docs: DataFrame, id_column: str, n: int) -> list[DataFrame]:
    """The documents in `n` ranges of ids of about equal size, as they would arrive; null ids are in the
    first. Readers skip the row groups outside a range where files follow the ids."""
    cuts = docs.select(F.percentile_approx(id_column, [k / n for k in range(1, n)], 1000)).first()[0] if n > 1 else None
    cuts = sorted(set(cuts or []))
    edges = [None, *cuts, None]
    found = []
    for low, high in zip(edges, edges[1:]):
        rule = F.lit(True)
        if low is not None:
            rule &= F.col(id_column) > low
        if high is not None:
            rule &= F.col(id_column) <= high
        found.append(docs.where(rule | F.col(id_column).isNull() if low is None else rule))
    return found


def line_dedup(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", min_docs: int = MIN_DOCS,
               batches: int = BATCHES) -> DataFrame:
    """The rows of `docs` with `text_column` cut down, and `n_lines`, `n_dropped`.

    Lines whose key (blanks at both ends gone, A-Z in lower case) is in at least `min_docs` documents
    are dropped from every document; the others stay, joined by a line feed. Empty keys stay. A null or
    empty text is one empty line; it comes back empty. Each row is a document: rows that repeat an id or
    a whole row count each. All columns of `docs` pass through; columns named n_lines or n_dropped are
    replaced.
    """
    spark = docs.sparkSession
    runs = LineRuns(spark, run_dir(spark, "line_runs"), min_docs)
    for batch in batches_of(docs, id_column, batches):
        runs.add(batch, text_column)
    return drop_lines(docs, runs.common(), id_column, text_column)


def drop_lines(docs: DataFrame, common: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """Drops the lines whose hash is in `common`. Rows are matched by id and text, null ids too; rows
    alike in both lose the same lines."""
    named = docs.select(*[F.col(c).alias(f"_in_{k}") for k, c in enumerate(docs.columns)],
                        F.col(id_column).alias("_id"), F.col(text_column).alias("_text"))
    named = named.withColumn("_th", F.xxhash64(F.coalesce("_text", F.lit(""))))
    found = named.select("_id", "_th", F.posexplode_outer(keys_of(F.col("_text"))).alias("_at", "_key")).where("_key != ''")
    found = found.select("_id", "_th", "_at", *hashes("_key"))
    small = common.count() <= BROADCAST_KEYS
    dropped = (found.join(F.broadcast(common) if small else common, HASHES, "left_semi")
               .groupBy("_id", "_th").agg(F.collect_set("_at").alias("_drop")))
    dropped = dropped.select(F.col("_id").alias("_d_id"), F.col("_th").alias("_d_th"), "_drop")
    # The texts are the wide side: they are shuffled once, and neither sorted nor held.
    joined = named.join(dropped.hint("shuffle_hash"), F.col("_id").eqNullSafe(F.col("_d_id")) & (F.col("_th") == F.col("_d_th")), "left")
    # 1 at each dropped position, so that a line is kept or not by one look at an array.
    flags = F.aggregate(F.sort_array("_drop"), F.array().cast("array<int>"), lambda acc, at: F.concat(
        acc, F.array_repeat(F.lit(0), at - F.size(acc)), F.array(F.lit(1))))
    pairs = F.zip_with(lines_of(F.col("_text")), flags, lambda line, gone: F.when(F.coalesce(gone, F.lit(0)) == 0, line))
    kept = F.when(F.col("_drop").isNull(), F.coalesce("_text", F.lit(""))).otherwise(
        F.array_join(pairs, "\n"))   # without the nulls
    out = [kept.alias(c) if c == text_column else F.col(f"_in_{k}").alias(c)
           for k, c in enumerate(docs.columns) if c not in ("n_lines", "n_dropped")]
    return joined.select(*out, F.size(lines_of(F.col("_text"))).cast("long").alias("n_lines"),
                         F.coalesce(F.size("_drop"), F.lit(0)).cast("long").alias("n_dropped"))

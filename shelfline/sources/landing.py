"""Landing files to raw tables."""

from __future__ import annotations

import csv
import re
from functools import reduce
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from shelfline.operators import tables
from shelfline.session import STORED, shuffles_dropped
from shelfline.sources.contracts import CATALOG_COLUMNS, CDC_SOURCE_COLUMNS, POS_COLUMNS


def relative_file(base_dir: str | None) -> Column:
    """Path of the source file below `base_dir`, the whole path without one."""
    path = F.col("_metadata.file_path")
    if not base_dir:
        return path
    base = base_dir.rstrip("/").split(":", 1)[-1].lstrip("/") + "/"
    return F.substring_index(path, base, -1)


def with_load_metadata(df: DataFrame, base_dir: str | None = None) -> DataFrame:
    """Adds _file and _loaded_at (one value per load) to a frame read from files."""
    return df.withColumn("_file", relative_file(base_dir)).withColumn("_loaded_at", F.current_timestamp())


def as_record(df: DataFrame) -> Column:
    return F.to_variant_object(F.struct(*[F.col(c) for c in df.columns])).alias("record")


def to_raw(df: DataFrame, record: Column, base_dir: str | None) -> DataFrame:
    return df.select(record, relative_file(base_dir).alias("_file"), F.current_timestamp().alias("_loaded_at"))


def cdc_schema(table: str) -> str:
    return f"{POS_COLUMNS[table]}, {CDC_SOURCE_COLUMNS}"


def landed_schema(spark: SparkSession, path: str | list[str], contract: str) -> StructType:
    """The contract's columns, and after them whatever else the files under `path` have."""
    known = StructType.fromDDL(contract)
    paths = [path] if isinstance(path, str) else path
    try:
        found = _reader(spark, False).option("mergeSchema", "true").parquet(*paths)
    except AnalysisException:   # no such file yet
        return known
    names = {n.lower() for n in known.names}
    return StructType([*known.fields, *(f for f in found.schema.fields if f.name.lower() not in names)])


def _reader(spark: SparkSession, streaming: bool):
    return (spark.readStream if streaming else spark.read).option("recursiveFileLookup", "true")


def read_cdc_parquet(
    spark: SparkSession, path: str, schema: str | None = None, streaming: bool = False, base_dir: str | None = None
) -> DataFrame:
    """Change files to (record, _file, _loaded_at); the row keeps its types inside the variant.

    Without a schema a batch read takes all columns that any file has; a stream needs one.
    """
    reader = _reader(spark, streaming)
    reader = reader.schema(schema) if schema else reader.option("mergeSchema", "true")
    rows = reader.parquet(path)
    return to_raw(rows, as_record(rows), base_dir)


def read_events_json(
    spark: SparkSession, path: str, streaming: bool = False, base_dir: str | None = None
) -> DataFrame:
    """JSON lines, plain or gzip, to (record, _file, _loaded_at)."""
    rows = _reader(spark, streaming).format("json").option("singleVariantColumn", "record").load(path)
    return to_raw(rows, F.col("record"), base_dir)


# ---------------------------------------------------------------- CSV by column name
CSV = (".csv", ".csv.gz")    # endings of its files, plain or gzip


def first_lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(path, line): the first line of each file that is not blank; files without one are left out.

    One job for all files: lines keep their order inside a block, and blocks are ordered by their start.
    """
    lines = spark.read.text(paths).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"),
        F.regexp_replace("value", "^\ufeff", "").alias("line"), F.monotonically_increasing_id().alias("nth"))
    return lines.where("trim(line) != ''").groupBy("path").agg(F.min_by("line", F.struct("block", "nth")).alias("line"))


def csv_headers(spark: SparkSession, paths: list[str]) -> dict[str, tuple[str, ...]]:
    """Header of each file, empty for a file without any text."""
    if not paths:
        return {}
    plain = lambda p: unquote(p.split(":", 1)[-1].lstrip("/"))
    found = {plain(r.path): tuple(next(csv.reader([r.line]))) for r in first_lines(spark, paths).collect()}
    return {p: found.get(plain(p), ()) for p in paths}


def read_csv_by_name(
    spark: SparkSession, paths: list[str], target: str = CATALOG_COLUMNS, base_dir: str | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """CSV files with a header, matched to the target columns by name, whatever case and order.

    Missing columns and short rows give null, and all values are read as text first, so '0042' stays
    '0042'. What has no target column, and what does not parse as its column's type, is kept in `_rescued`, a
    variant object from header name to text, null where nothing was left over. Files with the same header are
    read together. Line breaks inside quotes need `multi_line`, which makes each file one task.
    """
    schema = StructType.fromDDL(target)
    by_header: dict[tuple, list[str]] = {}
    for path, header in csv_headers(spark, paths).items():
        if header:
            by_header.setdefault(header, []).append(path)

    def group(header: tuple, files: list[str]) -> DataFrame:
        names = [f"c{i}" for i in range(len(header))]
        texts = StructType([StructField(n, StringType()) for n in names])
        rows = (
            spark.read.schema(texts).option("header", "true").option("enforceSchema", "true")
            .option("escape", '"').option("multiLine", multi_line).csv(files)
        )
        place = {}
        for i, h in enumerate(header):
            place.setdefault(h.strip().lower(), names[i])
        typed = {
            place[f.name.lower()]: F.col(place[f.name.lower()]).try_cast(f.dataType)
            for f in schema.fields if f.name.lower() in place
        }
        columns = [
            (typed[place[f.name.lower()]] if f.name.lower() in place else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in schema.fields
        ]
        left_over = [
            F.when((F.trim(n) != "") & (typed[n].isNull() if n in typed else F.lit(True)), F.col(n)) for n in names
        ]
        return rows.select(*columns, rescued([h.strip() for h in header], left_over),
                           relative_file(base_dir).alias("_file"), F.current_timestamp().alias("_loaded_at"))

    parts = [group(h, files) for h, files in sorted(by_header.items())]
    if not parts:
        return spark.createDataFrame([], StructType.fromDDL(f"{target}, {RESCUED} VARIANT, _file STRING, _loaded_at TIMESTAMP"))
    return reduce(DataFrame.unionByName, parts)


RESCUED = "_rescued"


def rescued(names: list[str], values: list[Column]) -> Column:
    """A variant object of the values that are not null; null if all are. A name that a header has twice
    is numbered from the second on."""
    told = [n if n not in names[:i] else f"{n} {names[:i].count(n) + 1}" for i, n in enumerate(names)]
    pairs = F.array(*[F.struct(F.lit(n).alias("key"), v.alias("value")) for n, v in zip(told, values)])
    kept = F.filter(pairs, lambda p: p["value"].isNotNull())
    return F.when(F.size(kept) > 0, F.to_variant_object(F.map_from_entries(kept))).alias(RESCUED)


def check_schema_drift(spark: SparkSession, paths: list[str], expected: str = CATALOG_COLUMNS,
                       base_dir: str | None = None) -> DataFrame:
    """file, missing, extra: the files whose header differs from the expected names."""
    want = [f.name.lower() for f in StructType.fromDDL(expected).fields]
    rows = []
    for path, header in sorted(csv_headers(spark, paths).items()):
        have = [h.strip().lower() for h in header]
        missing, extra = [w for w in want if w not in have], [h for h in have if h not in want]
        if missing or extra:
            name = path.split(base_dir.rstrip("/") + "/")[-1] if base_dir else path
            rows.append((name, ",".join(missing), ",".join(extra)))
    return spark.createDataFrame(rows, "file STRING, missing STRING, extra STRING")


# ---------------------------------------------------------------- exactly-once loading
def ingest_new_files(
    spark: SparkSession, src_dir: str, table_dir: str, fmt: str, ledger_dir: str, schema: str | None = None,
    max_files_per_batch: int = 10_000,
) -> int:
    """Loads every landing file once, however often it is called; returns the number of new files.

    For Parquet and JSON a stream lists the files, without their content, until none is left; its checkpoint is
    the ledger. A batch's files are then read with the columns that they themselves have, so a late file keeps all of
    its columns, whatever its time, and written as a partition of the load day and the batch, which a
    batch that is run again replaces. Later runs read only the days after their watermark. CSV needs each
    file's own header, so it is a batch load with a partition per file, and a ledger of the files, whether they
    had rows or not.
    """
    if not tables.list_names(spark, src_dir):
        return 0
    if fmt == "csv":
        return _ingest_csv(spark, src_dir, table_dir, ledger_dir, schema or CATALOG_COLUMNS)
    counts: list[int] = []

    def load(batch: DataFrame, number: int) -> None:
        files = [_literal(r.path) for r in batch.select("path").collect()]   # file names only
        if not files:
            return
        session = batch.sparkSession
        if fmt == "parquet":
            rows = session.read.schema(landed_schema(session, files, schema)).parquet(*files)
            raw = to_raw(rows, as_record(rows), src_dir)
        else:
            rows = session.read.format("json").option("singleVariantColumn", "record").load(files)
            raw = to_raw(rows, F.col("record"), src_dir)
        tables.remove_matching(session, f"{table_dir}/_load_date=*/_batch={number}")
        (raw.select(F.unix_micros("_loaded_at").alias(LOADED_US), "*", F.to_date("_loaded_at").alias("_load_date"),
                    F.lit(number).alias("_batch"))
         .write.mode("append").partitionBy("_load_date", "_batch").parquet(table_dir, compression=STORED))
        counts.append(len(files))

    # A file is never too old to be new; the names of all files ever loaded are what the stream has to remember.
    listed = (_reader(spark, True).option("maxFilesPerTrigger", max_files_per_batch).option("maxFileAge", "36500d").format("binaryFile")
              .schema("path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY").load(src_dir))
    (listed.select("path").writeStream.foreachBatch(load).option("checkpointLocation", ledger_dir)
     .trigger(availableNow=True).start().awaitTermination())
    return sum(counts)


def _literal(path: str) -> str:
    """A path in which no character stands for others."""
    return re.sub(r"([\\\[\]{}*?])", r"\\\1", path)


# The load time as a number: Parquet footers hold the largest one, unlike that of timestamps. It is the first column, as
# Spark finds the statistics by a column's place, which nested columns before it would shift.
LOADED_US = "_loaded_us"
RAW_COLUMNS = f"{LOADED_US} BIGINT, record VARIANT, _file STRING, _loaded_at TIMESTAMP, _load_date DATE"


def read_raw(spark: SparkSession, table_dir: str) -> DataFrame:
    if not tables.list_names(spark, table_dir):
        return spark.createDataFrame([], RAW_COLUMNS)
    return spark.read.schema(f"{RAW_COLUMNS}, _batch BIGINT").parquet(table_dir).drop("_batch")


def newest_load(spark: SparkSession, table_dir: str) -> DataFrame:
    """One row with the newest _loaded_at of a raw table, null without rows. Spark answers it from the
    footers of the files of the newest load day; no data page is read."""
    spark.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    names = tables.list_names(spark, table_dir)
    if not any("=" in n for n in names):
        return spark.createDataFrame([(None,)], "_loaded_at TIMESTAMP")
    days = [n.split("=")[1] for n in names if n.startswith("_load_date=")]
    before = spark.conf.get("spark.sql.sources.useV1SourceList")
    try:   # only the newer Parquet source pushes aggregates down
        spark.conf.set("spark.sql.sources.useV1SourceList", ",".join(x for x in before.split(",") if x != "parquet"))
        rows = spark.read.schema(f"{LOADED_US} BIGINT, _load_date DATE").parquet(table_dir)
    finally:
        spark.conf.set("spark.sql.sources.useV1SourceList", before)
    rows = rows.where(F.col("_load_date") == F.lit(max(days)).cast("date")) if days else rows
    return rows.agg(F.max(LOADED_US).alias("us")).select(F.timestamp_micros("us").alias("_loaded_at"))


def read_catalog(spark: SparkSession, table_dir: str, target: str = CATALOG_COLUMNS) -> DataFrame:
    """Loaded CSV rows; they are stored in a partition per file."""
    if not tables.list_names(spark, table_dir):
        return read_csv_by_name(spark, [], target)
    return spark.read.schema(f"{target}, {RESCUED} VARIANT, _loaded_at TIMESTAMP, _file STRING").parquet(table_dir).select(
        *StructType.fromDDL(target).names, RESCUED, "_file", "_loaded_at")


def _ingest_csv(spark: SparkSession, src_dir: str, table_dir: str, ledger_dir: str, target: str) -> int:
    """A file counts as loaded once its name is in the ledger. Its rows are a partition of their own, which a run
    after one that died before that overwrites."""
    listed = tables.list_files(spark, src_dir, CSV)
    base = src_dir.rstrip("/").split(":", 1)[-1].lstrip("/") + "/"
    by_name = {f.split(base)[-1]: f for f in listed}
    names = spark.createDataFrame([(n,) for n in by_name], "_file STRING")
    if tables.list_names(spark, ledger_dir):
        names = names.join(spark.read.schema("_file STRING").parquet(ledger_dir), "_file", "left_anti")
    new = sorted(r[0] for r in names.collect())  # file names only
    if not new:
        return 0
    rows = read_csv_by_name(spark, [by_name[n] for n in new], target, src_dir)
    rows = rows.select(F.unix_micros("_loaded_at").alias(LOADED_US), "*")
    with shuffles_dropped(spark):
        rows.hint("rebalance", "_file").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
            "_file").parquet(table_dir, compression=STORED)
    spark.createDataFrame([(n,) for n in new], "_file STRING").coalesce(1).write.mode("append").parquet(ledger_dir)
    return len(new)


def materialize(df: DataFrame, target: str, how: str = "view") -> DataFrame:
    """A lazy view under the given name, or a full rebuild of the table at the given path."""
    if how == "view":
        df.createOrReplaceTempView(target)
        return df
    if how == "overwrite":
        return tables.overwrite_table(df.sparkSession, target, df)
    raise ValueError(f"unknown way to materialize: {how}")

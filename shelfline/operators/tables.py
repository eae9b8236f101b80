"""Keyed upsert into Parquet tables partitioned by day; plain Parquet has no MERGE.

A table is a folder with four others, all of them written and read by Spark's own Parquet source:

* `rows`: the rows, partitioned by `_day`; a key stays under the day that it was first filed under;
* `keys/<columns>`: which days hold rows of a key, a narrow table bucketed by the key, so that a lookup
  shuffles the keys asked for and never the table;
* `schema`: an empty file with all columns, so that older partitions read new ones as null;
* `marks`: one short row per write, with the highest load time and number so far.

An upsert looks up the days of the keys it brings, compares its rows with those stored there, and overwrites
the partitions in which something changes (dynamic partition overwrite), no others. New keys are entered
before the rows and the mark after them: a run that died half way is repaired by running it again, and until
then readers can see some days before and some after it. One writer at a time.
"""

from __future__ import annotations

import datetime as dt
import hashlib
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StructType, TimestampType

from shelfline.operators.skew import BROADCAST_ROWS
from shelfline.session import STORED, freeze, shuffles_dropped

DEFAULT_BUCKETS = 16      # of a key table
MOST_FILES = 64           # per bucket of a key table, before it is written anew
KEPT_MARKS = 8
LOADED, DAY, CAME = "_loaded_at", "_day", "_came"
NO_DAY = dt.date(1970, 1, 1)   # where rows without a key or any day are filed


# ---------------------------------------------------------------- file system helpers
def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def list_names(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def list_files(spark: SparkSession, path: str, suffix: str | tuple[str, ...]) -> list[str]:
    """All files below a folder with one of the endings, full paths."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    found, walk = [], fs.listFiles(p, True)
    while walk.hasNext():
        name = walk.next().getPath().toString()
        if name.endswith(suffix):
            found.append(name)
    return sorted(found)


def _remove(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def remove_matching(spark: SparkSession, pattern: str) -> None:
    fs, p = _fs(spark, pattern)
    for found in fs.globStatus(p) or ():
        fs.delete(found.getPath(), True)


# ---------------------------------------------------------------- reading
def table_schema(spark: SparkSession, path: str) -> StructType | None:
    return spark.read.parquet(f"{path}/schema").schema if list_names(spark, f"{path}/schema") else None


def stored_days(spark: SparkSession, path: str) -> list[dt.date]:
    return [dt.date.fromisoformat(n.split("=")[1]) for n in list_names(spark, f"{path}/rows") if n.startswith(f"{DAY}=")]


def read_days(spark: SparkSession, path: str, days: list[dt.date] | None = None) -> DataFrame:
    """The rows with their `_day`; with `days`, from those partitions alone."""
    schema = table_schema(spark, path)
    full = StructType(schema.fields).add(DAY, "date")
    have = stored_days(spark, path)
    if days is None and have:
        return spark.read.schema(full).parquet(f"{path}/rows")
    found = sorted(set(have) & set(days or ()))
    if not found:
        return spark.createDataFrame([], full)
    return spark.read.schema(full).option("basePath", f"{path}/rows").parquet(*[f"{path}/rows/{DAY}={d}" for d in found])


def read_table(spark: SparkSession, path: str) -> DataFrame | None:
    schema = table_schema(spark, path)
    return None if schema is None else read_days(spark, path).select(*schema.names)


def rows_of(spark: SparkSession, path: str, keys: DataFrame) -> DataFrame:
    """The rows with the given keys (their columns are those of a key table), read from their days alone."""
    if table_schema(spark, path) is None:
        raise ValueError(f"no table at {path}")
    days = _days(_known(spark, path, keys))
    return read_days(spark, path, days).join(keys, keys.columns, "left_semi").drop(DAY)


# ---------------------------------------------------------------- key tables
def _key_table(spark: SparkSession, path: str, columns: list[str]) -> tuple[str, str] | None:
    """Catalog name and folder of the newest complete key table; the folders alone hold all there is."""
    base = f"{path}/keys/{'-'.join(columns)}"
    made = [n for n in list_names(spark, base) if "_SUCCESS" in list_names(spark, f"{base}/{n}")]
    return (_register(spark, f"{base}/{made[-1]}"), f"{base}/{made[-1]}") if made else None


def _register(spark: SparkSession, folder: str, kind: str | None = None, columns: list[str] | None = None, buckets: int = 0) -> str:
    name = f"keys_{hashlib.md5(folder.encode()).hexdigest()}"
    if not spark.catalog.tableExists(name):
        if kind is None:   # written by another session: columns and buckets are in its files and folder
            kind = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in spark.read.parquet(folder).schema.fields)
            columns = folder.split("/")[-2].split("-")
            buckets = int(folder.rsplit("of", 1)[1])
        names = ", ".join(columns)
        spark.sql(f"CREATE TABLE {name} ({kind}) USING parquet CLUSTERED BY ({names}) SORTED BY ({names}) "
                  f"INTO {buckets} BUCKETS LOCATION '{folder}'")
    return name


def _write_keys(spark: SparkSession, path: str, columns: list[str], pairs: DataFrame, buckets: int) -> None:
    """A new generation of a key table, complete once its job has committed; the older ones go."""
    base = f"{path}/keys/{'-'.join(columns)}"
    old = list_names(spark, base)
    number = 1 + max([int(n[1:].split("of")[0]) for n in old], default=0)
    folder = f"{base}/g{number:06d}of{buckets}"
    kind = ", ".join(f"{c} {pairs.schema[c].dataType.simpleString()}" for c in [*columns, DAY])
    name = _register(spark, folder, kind, columns, buckets)
    with shuffles_dropped(spark):
        pairs.select(*columns, DAY).repartition(buckets, *columns).write.mode("append").insertInto(name)
    for n in old:
        spark.sql(f"DROP TABLE IF EXISTS keys_{hashlib.md5(f'{base}/{n}'.encode()).hexdigest()}")
        _remove(spark, f"{base}/{n}")


def _known(spark: SparkSession, path: str, keys: DataFrame) -> DataFrame:
    """Keys and the days that can hold them. Only the keys asked for are shuffled or broadcast."""
    found = _key_table(spark, path, keys.columns)
    if found is None:
        return spark.createDataFrame([], StructType([*keys.schema.fields]).add(DAY, "date"))
    return spark.table(found[0]).join(keys, keys.columns, "left_semi").distinct()


def _enter_keys(spark: SparkSession, path: str, columns: list[str], rows: DataFrame, buckets: int,
                known: DataFrame | None = None) -> None:
    """Adds the pairs of key and day that the key table lacks; `known`, if given, are those that it has of these keys."""
    pairs = rows.dropna(subset=columns).select(*columns, DAY).distinct()
    found = _key_table(spark, path, columns)
    if found is None:
        return _write_keys(spark, path, columns, pairs, buckets)
    name, folder = found
    buckets = int(folder.rsplit("of", 1)[1])
    known = _known(spark, path, pairs.select(*columns)) if known is None else known
    pairs.join(known, [*columns, DAY], "left_anti").coalesce(1 if buckets <= 64 else buckets // 64).write.mode(
        "append").insertInto(name)
    if len(list_names(spark, folder)) > MOST_FILES * buckets:
        _write_keys(spark, path, columns, freeze(spark.table(name), "keys"), buckets)


def _days(df: DataFrame) -> list[dt.date]:
    return sorted(r[0] for r in df.select(DAY).distinct().collect())   # at most one row per day


# ---------------------------------------------------------------- marks
def _mark(spark: SparkSession, path: str, loaded: dt.datetime | None, number: int | None) -> None:
    """Marks only grow, so the highest of the rows is what holds; a few of the newest files stay."""
    before = marks(spark, path)
    high = [max([x for x in pair if x is not None], default=None) for pair in zip(before, (loaded, number))]
    old = list_files(spark, f"{path}/marks", ".parquet")
    spark.createDataFrame([tuple(high)], "loaded TIMESTAMP, number BIGINT").coalesce(1).write.mode("append").parquet(f"{path}/marks")
    if len(old) > KEPT_MARKS:
        for file in old:    # the new one holds all that they say
            _remove(spark, file)


def marks(spark: SparkSession, path: str) -> tuple[dt.datetime | None, int | None]:
    """Highest load time and highest number that were ever written."""
    if not list_files(spark, f"{path}/marks", ".parquet"):
        return None, None
    return tuple(spark.read.schema("loaded TIMESTAMP, number BIGINT").parquet(f"{path}/marks").agg(
        F.max("loaded"), F.max("number")).first())


class _Seen:
    """What is told of the rows of a write, counted as they pass: how many there are, the highest load time and number,
    and how many lack a value in some column of each of `groups`."""

    def __init__(self, number: str | None, groups: dict[str, list[str]] | None = None):
        self.number, self.groups, self.metrics = number, groups or {}, Observation()

    def watch(self, df: DataFrame) -> DataFrame:
        told = [F.count(F.lit(1)).alias("rows"), *[F.count_if(_any_null(g)).alias(n) for n, g in self.groups.items()]]
        if LOADED in df.columns:
            top, self.kind = F.max(LOADED), df.schema[LOADED].dataType
            told.append((F.unix_micros(top) if isinstance(self.kind, TimestampType) else top.cast("string")).alias("loaded"))
        if self.number in df.columns:
            told.append(F.max(self.number).alias("number"))
        return df.observe(self.metrics, *told)

    def count(self, what: str = "rows") -> int:
        return self.metrics.get.get(what, 0)    # a plan known to be empty has no metrics

    def highest(self) -> tuple[dt.datetime | None, int | None]:
        top, number = self.metrics.get.get("loaded"), self.metrics.get.get("number")
        if top is None:
            return None, number
        return (self.kind.fromInternal(top) if isinstance(self.kind, TimestampType) else dt.datetime.fromisoformat(top)), number


# ---------------------------------------------------------------- writing
def _filed(df: DataFrame, day: Column | str | None, index: list[str], known: Column | None = None, grain: str = "DAY") -> DataFrame:
    """Adds `_day`: where the key is known, else the given day, else the day of the load."""
    given = F.col(day) if isinstance(day, str) else day
    loaded = F.col(LOADED) if LOADED in df.columns else None
    period = lambda c: F.date_trunc(grain, c.cast("timestamp_ntz")).cast("date")
    options = [period(c) for c in (known, given, loaded) if c is not None]
    found = F.coalesce(*options, F.lit(NO_DAY))
    return df.withColumn(DAY, F.when(_any_null(index), F.lit(NO_DAY)).otherwise(found) if index else found)


def _write_schema(spark: SparkSession, path: str, schema: StructType) -> None:
    if table_schema(spark, path) != schema:
        spark.createDataFrame([], schema).coalesce(1).write.mode("overwrite").parquet(f"{path}/schema")


def _write_rows(df: DataFrame, path: str, mode: str) -> None:
    """AQE splits a large day over several files and joins small ones."""
    with shuffles_dropped(df.sparkSession):
        df.hint("rebalance", DAY).write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy(DAY).parquet(
            f"{path}/rows", compression=STORED)


def _replace_days(spark: SparkSession, path: str, df: DataFrame, days: list[dt.date]) -> None:
    """Overwrites the given partitions; one for which there are no rows any more is removed."""
    files = lambda d: list_names(spark, f"{path}/rows/{DAY}={d}")
    before = {d: files(d) for d in days}
    _write_rows(df, path, "dynamic")
    for d in days:
        if before[d] and files(d) == before[d]:
            _remove(spark, f"{path}/rows/{DAY}={d}")


def overwrite_table(spark: SparkSession, path: str, df: DataFrame, index: list[str] = (), day: Column | str | None = None,
                    buckets: int = DEFAULT_BUCKETS, also: list[list[str]] = (), number: str | None = None,
                    grain: str = "DAY") -> DataFrame:
    """Replaces the whole content. `df` must not read the table itself; `freeze` it first if it does."""
    index, schema, seen = list(index), df.schema, _Seen(number)
    if table_schema(spark, path) is not None:
        _write_schema(spark, path, schema)
    _write_rows(_filed(seen.watch(df), day, index, grain=grain), path, "static")
    if table_schema(spark, path) is None:
        _write_schema(spark, path, schema)
    for columns in [index, *also] if index else []:
        pairs = read_days(spark, path).dropna(subset=columns).select(*columns, DAY).distinct()
        _write_keys(spark, path, columns, pairs, buckets)
    _mark(spark, path, *seen.highest())
    return read_table(spark, path)


def replace_values(spark: SparkSession, path: str, df: DataFrame, column: str, values: list, grain: str = "DAY") -> DataFrame:
    """Replaces the rows whose date `column` is one of `values` (null is one) by `df`, in a table filed by that column.
    Only the partitions of those dates are written."""
    dates = spark.createDataFrame([(v,) for v in values], f"{column} DATE")
    days = _days(_filed(dates, column, [], grain=grain))
    known = [v for v in values if v is not None]
    hit = F.coalesce(F.col(column).isin(known), F.lit(None in values))
    kept = read_days(spark, path, days).where(~hit)
    _replace_days(spark, path, kept.unionByName(_filed(freeze(df, "replaced"), column, [], grain=grain)), days)
    return read_table(spark, path)


def append_table(spark: SparkSession, path: str, df: DataFrame) -> DataFrame:
    """Adds rows. Columns that the table lacks are added to it; old rows read them as null."""
    _write_schema(spark, path, _both(table_schema(spark, path), df.schema))
    _filed(df, None, []).coalesce(1).write.mode("append").partitionBy(DAY).parquet(f"{path}/rows", compression=STORED)
    return read_table(spark, path)


def _both(old: StructType | None, new: StructType) -> StructType:
    have = {n.lower() for n in old.names} if old else set()
    return StructType([*(old.fields if old else []), *(f for f in new.fields if f.name.lower() not in have)])


@dataclass
class Merge:
    """A table after a merge, and its rows that came or went; None where the table is new."""

    table: DataFrame
    changed: DataFrame | None


def upsert(spark: SparkSession, path: str, src: DataFrame, keys: list[str], **how) -> DataFrame:
    """Merges `src` into the table and returns it; `how` as for `merge_rows`."""
    return merge_rows(spark, path, src, keys, **how).table


def merge_rows(
    spark: SparkSession,
    path: str,
    src: DataFrame,
    keys: list[str],
    replace_by: list[str] | None = None,
    index: list[str] | None = None,
    day: Column | str | None = None,
    buckets: int = DEFAULT_BUCKETS,
    also: list[list[str]] = (),
    number: str | None = None,
    grain: str = "DAY",
    resolve: Callable[[DataFrame], DataFrame] | None = None,
    check: bool = False,
) -> Merge:
    """Merges `src` into the table: a stored row whose `replace_by` columns (default: the keys)
    occur in `src` is replaced, other rows stay, new columns are appended.

    `index` (among `replace_by`; default: all of them) and each of `also` name the columns of a key table; `day` is
    the day that a new key is filed under; a table of few rows a day takes `grain` MONTH or YEAR, whose first day
    then stands for all of it. `resolve`, if given, decides instead of "the source wins": it maps stored and
    source rows together to one row per key. `number` is a column whose highest value is to be kept. With
    `check`, a source with two rows of a key is refused. Partitions in which no row changes are left as they are.
    """
    by = list(replace_by or keys)
    index = list(index or by)
    seen = _Seen(number, {"index": index, "by": by})
    staged = freeze(seen.watch(src), "staged")
    loaded, top = seen.highest()
    if check and not staged.groupBy(*keys).count().where("count > 1").isEmpty():
        raise ValueError(f"the source holds more than one row for a value of {keys}")
    old = table_schema(spark, path)
    if old is None:
        first = staged if resolve is None else resolve(staged)
        return Merge(overwrite_table(spark, path, first, index, day, buckets, also, number, grain), None)
    if not seen.count():
        return Merge(read_table(spark, path), spark.createDataFrame([], old))
    schema = _both(old, staged.schema)
    lacking = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields if f.name not in staged.columns]
    # Keys of much news are shuffled: narrow columns make small files, which the planner takes for small tables to broadcast.
    keyed = lambda df: df.hint("merge") if seen.count() > BROADCAST_ROWS else df
    known = freeze(_known(spark, path, keyed(staged.select(*index).dropna())), "known")
    first = keyed(known.groupBy(*index).agg(F.min(DAY).alias("_known")))
    news = _filed(staged.select("*", *lacking).join(first, index, "left"), day, index, F.col("_known"), grain).select(
        *schema.names, DAY)

    # Stored rows of the same keys, where the key table says that they can be: as many as the news has, or chains of it.
    touched = {*_days(known), *([NO_DAY] if seen.count("index") else [])}
    _write_schema(spark, path, schema)
    arriving, nulls = keyed(staged.select(*by)), seen.count("by") > 0
    rivals = _matching(read_days(spark, path, list(touched)), arriving, by, "left_semi", nulls)
    winners = news
    if resolve is not None:
        rivals = freeze(rivals, "rivals")
        winners = freeze(resolve(news.unionByName(rivals)), "winners")
    # Taken once: it decides which partitions are written, and those who read this table ask for it again.
    changed = freeze(_difference(winners, rivals), "changed")
    days = _days(changed)
    if number:
        _mark(spark, path, None, top)   # numbers are taken before rows hold them
    if days:
        came = changed.where(CAME)      # what is stored already was entered before it was
        for columns in [index, *also]:
            _enter_keys(spark, path, columns, came, buckets, known if columns == index else None)
        kept = _matching(read_days(spark, path, days), arriving, by, "left_anti", nulls)
        _replace_days(spark, path, kept.unionByName(winners.where(F.col(DAY).isin(days))), days)
    _mark(spark, path, loaded, None)
    return Merge(read_table(spark, path), changed.drop(DAY, CAME))


def _difference(new: DataFrame, old: DataFrame) -> DataFrame:
    """The distinct rows that only one of two frames has, with `_came`: whether it is the new one. Both are shuffled once;
    two EXCEPTs would shuffle and sort each of them twice."""
    sides = new.withColumn(CAME, F.lit(True)).unionByName(old.withColumn(CAME, F.lit(False)))
    found = sides.groupBy(*new.columns).agg(F.bool_or(CAME).alias(CAME), F.bool_and(CAME).alias("_alone"))
    return found.where(F.col(CAME) == F.col("_alone")).drop("_alone")


def _any_null(columns: list[str]) -> Column:
    return reduce(Column.__or__, [F.col(c).isNull() for c in columns])


def _matching(df: DataFrame, keys: DataFrame, by: list[str], how: str, nulls: bool = True) -> DataFrame:
    """Semi or anti join in which null equals null; without `nulls` among the keys a plain comparison does."""
    named = keys.withColumnsRenamed({c: f"_by{i}" for i, c in enumerate(by)})
    same = [F.col(c).eqNullSafe(F.col(f"_by{i}")) if nulls else F.col(c) == F.col(f"_by{i}") for i, c in enumerate(by)]
    return df.join(named, reduce(Column.__and__, same), how)


# ---------------------------------------------------------------- watermarks
def watermark(target: DataFrame | None, lookback: dt.timedelta = dt.timedelta(0)) -> dt.datetime | None:
    """max(_loaded_at) less the lookback; None for a missing or empty target, which means load all."""
    if target is None:
        return None
    top = target.agg(F.max(LOADED)).first()[0]
    return None if top is None else top - lookback


def table_watermark(spark, path: str, lookback: dt.timedelta = dt.timedelta(0)) -> dt.datetime | None:
    """The same from the table's marks, without a scan."""
    top = marks(spark, path)[0]
    return None if top is None else top - lookback


def loaded_after(df: DataFrame, since: dt.datetime | None) -> DataFrame:
    """Rows loaded after a watermark, as literals that reach the scan and its load-date folders."""
    if since is None:
        return df
    rows = df.where(F.col(LOADED) > F.lit(since))
    if "_load_date" in df.columns:
        rows = rows.where(F.col("_load_date") >= F.lit(since.date() - dt.timedelta(days=1)))
    return rows

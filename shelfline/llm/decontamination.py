"""Benchmark decontamination: a broadcast hash set of the benchmark's word windows.

The windows of a document are hashed by doubling: pairs of words, pairs of pairs and so on, so that
each length costs a few additions to one array instead of a slice per position. Positions whose hash
is in the set are compared word by word; what is left are hits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from shelfline.llm.common import ascii_lower
from shelfline.session import freeze

WINDOW = 13
# Fixed value: words are parted by ASCII that is neither a digit nor a lower-case letter.
PARTING = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# Windows and bytes of the benchmark that are broadcast; beyond either the join shuffles by hash.
BROADCAST_WINDOWS = 1_000_000
BROADCAST_BYTES = 64_000_000


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), PARTING, -1), "")


def _paired(a: Column, shift: int) -> Column:
    """hash(a[i], a[i + shift]) for all i where both exist."""
    n = F.greatest(F.size(a) - shift, F.lit(0))
    return F.zip_with(F.slice(a, 1, n), F.slice(a, shift + 1, n), lambda x, y: F.xxhash64(x, y))


def with_windows(df: DataFrame, words: str, lengths: list[int]) -> DataFrame:
    """Adds an array `_w<L>` for each L: the hash of the window of L words at each position."""
    df = df.withColumn("_g1", F.transform(F.col(words), lambda w: F.xxhash64(w)))
    size = 1
    while 2 * size <= max(lengths, default=1):
        df = df.withColumn(f"_g{2 * size}", _paired(F.col(f"_g{size}"), size))
        size *= 2
    for n in lengths:
        half = 1 << (n.bit_length() - 1)
        df = df.withColumn(f"_w{n}", F.col(f"_g{half}") if half == n else _paired(F.col(f"_g{half}"), n - half))
    return df.drop(*[f"_g{1 << k}" for k in range(8)])


def benchmark_windows(benchmark: DataFrame, item_column: str, text_column: str, window: int = WINDOW) -> DataFrame:
    """(hash, length, words, items): each different window once, with all items that have it."""
    items = benchmark.select(F.col(item_column).cast("string").alias("item"), words_of(F.col(text_column)).alias("all"))
    items = items.where("size(all) > 0")
    at = items.withColumn("n", F.least(F.size("all"), F.lit(window)))
    each = at.select("item", "n", F.explode(F.transform(
        F.sequence(F.lit(1), F.size("all") - F.col("n") + 1), lambda i: F.slice(F.col("all"), i, F.col("n")))).alias("seq"))
    return each.groupBy("seq", "n").agg(F.collect_set("item").alias("items"))


def candidates(docs: DataFrame, benchmark: DataFrame, id_column: str, text_column: str, item_column: str,
               item_text: str, window: int) -> DataFrame:
    """(_id, _th, found) for each id and text that holds the hash of a window: where, and which window."""
    windows = freeze(benchmark_windows(benchmark, item_column, item_text, window), "windows")
    size = windows.agg(F.count("*"), F.sum(F.octet_length(F.array_join("seq", " "))), F.collect_set("n")).first()
    small = size[0] <= BROADCAST_WINDOWS and (size[1] or 0) <= BROADCAST_BYTES
    lengths = sorted(size[2])
    read = docs.select(F.col(id_column).alias("_id"), F.xxhash64(F.coalesce(F.col(text_column), F.lit(""))).alias("_th"),
                       words_of(F.col(text_column)).alias("_words"))
    read = with_windows(read, "_words", lengths).drop("_words")
    found = read.select("_id", "_th", F.lit(0).alias("at"), F.lit(0).alias("n"),
                        F.array().cast("array<string>").alias("seq"),
                        F.array().cast("array<string>").alias("items")).where("false")
    for n in lengths:   # outer: a plain explode would have its array computed once more, as a filter
        at = read.select("_id", "_th", F.posexplode_outer(f"_w{n}").alias("at", "_h")).where("_h is not null")
        mine = with_windows(windows.where(F.col("n") == n), "seq", [n])
        mine = mine.select(F.get(f"_w{n}", F.lit(0)).alias("_h"), "n", "seq", "items")
        found = found.unionByName(at.join(F.broadcast(mine) if small else mine, "_h").drop("_h"))
    return found.groupBy("_id", "_th").agg(F.collect_set(F.struct("at", "n", "seq", "items")).alias("found"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                  item_column: str = "item_id", item_text: str = "text", window: int = WINDOW,
                  per_hit: int = 20) -> DataFrame:
    """The rows of `docs` with `n_words`, `n_hit`, `n_items`, `items`, `hits` and `contaminated`.

    `hits` are the positions of the words that windows cover, `items` the items, as text and in order.
    A document is contaminated when hit words make up at least one in `per_hit` of its words. A null text
    has no words. Items without words have no windows; one of fewer words than `window` is one window. A
    null item id is left out of the lists, though its windows hit. Rows that repeat an id or a whole row
    are each judged by their own text; a null id is an id like any other. Columns of `docs` with the
    names of the added ones are replaced.
    """
    added = ["n_words", "n_hit", "n_items", "items", "hits", "contaminated"]
    found = candidates(docs, benchmark, id_column, text_column, item_column, item_text, window)
    found = found.select(F.col("_id").alias("_f_id"), F.col("_th").alias("_f_th"), F.col("found").alias("_found"))
    named = docs.select(*[F.col(c).alias(f"_in_{k}") for k, c in enumerate(docs.columns)], F.col(id_column).alias("_id"),
                        F.xxhash64(F.coalesce(F.col(text_column), F.lit(""))).alias("_th"),
                        F.col(text_column).alias("_text"),
                        F.size(words_of(F.col(text_column))).cast("long").alias("n_words"))
    # The texts are the wide side: they are shuffled once, and neither sorted nor held.
    joined = named.join(found.hint("shuffle_hash"),
                        F.col("_id").eqNullSafe(F.col("_f_id")) & (F.col("_th") == F.col("_f_th")), "left")
    joined = joined.withColumn("_words", F.when(F.col("_found").isNotNull(), words_of(F.col("_text"))))
    joined = joined.withColumn("_true", F.filter("_found", lambda f: F.slice("_words", f["at"] + 1, f["n"]) == f["seq"]))
    none = lambda kind: F.array().cast(f"array<{kind}>")
    joined = joined.withColumn("hits", F.coalesce(F.array_sort(F.array_distinct(F.flatten(F.transform(
        "_true", lambda f: F.sequence(f["at"], f["at"] + f["n"] - 1))))), none("int")))
    joined = joined.withColumn("items", F.coalesce(F.array_sort(F.array_distinct(F.flatten(F.transform(
        "_true", lambda f: f["items"])))), none("string")))
    n_hit = F.size("hits").cast("long")
    return joined.select(
        *[F.col(f"_in_{k}").alias(c) for k, c in enumerate(docs.columns) if c not in added],
        "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), "items", "hits",
        ((n_hit > 0) & (per_hit * n_hit >= F.col("n_words"))).alias("contaminated"))


def without_spans(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """Takes the hit words out of the texts that `decontaminate` has marked: the other words stay, as
    words joined by one space; a text without hits stays as it is."""
    words = words_of(F.col(text_column))
    keep = F.array_except(F.sequence(F.lit(0), F.size(words) - 1), F.col("hits"))
    cut = F.array_join(F.transform(keep, lambda i: F.get(words, i)), " ")
    return docs.withColumn(text_column, F.when(F.size("hits") > 0, cut).otherwise(F.col(text_column)))

"""Token counts of a byte-level BPE vocabulary by a two-tier lookup on the map side.

The vocabulary splits a text into pre-tokens and encodes each on its own, so a text's count is the
sum over its pre-tokens. First tier: a broadcast table of the corpus's frequent pre-tokens and their
numbers of tokens, of bounded size. Second tier: misses are encoded once per worker and kept in a
bounded cache. No pre-token is shuffled; each task of the counting pass sends a bounded summary.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F, types as T

from shelfline.llm.common import map_arrow, per_row

# Fixed value: the pattern that splits text before the merges of byte-level vocabularies.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SPLIT = regex.compile(PATTERN)
# Letters and digits that Unicode took up of late are classed differently by library versions. All
# below this are settled; a text with any other character is split by the tokenizer itself.
UNSETTLED = regex.compile("[^\u0000-՗]")

TABLE_SIZE = 1 << 16      # pre-tokens in the broadcast table
LONGEST = 48              # characters of a pre-token there and in the worker caches
SUMMARY = 1 << 12         # pre-tokens that a task of the counting pass reports
COUNTERS = 1 << 17        # pre-tokens that it counts at once
CACHE = 1 << 20           # pre-tokens in a worker's cache, some 120 MB

ADDED = T.StructType([T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType()),
                      T.StructField("over_limit", T.BooleanType())])


@lru_cache(maxsize=4)
def tokenizer(path: str):
    from tokenizers import Tokenizer
    made = Tokenizer.from_file(path)
    made.no_truncation()
    made.no_padding()
    return made


@lru_cache(maxsize=4)
def special_strings(path: str) -> regex.Pattern | None:
    names = [t.content for t in tokenizer(path).get_added_tokens_decoder().values()]
    return regex.compile("|".join(map(regex.escape, names))) if names else None


def encoded_length(path: str, text: str) -> int:
    return len(tokenizer(path).encode(text, add_special_tokens=False).ids)


def _byte_alphabet() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level vocabularies: printable
    Latin-1 for itself, the other bytes from U+0100 on in order."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = (b for b in range(256) if b not in plain)
    return {b: chr(b) for b in plain} | {b: chr(0x100 + k) for k, b in enumerate(others)}


BYTES = _byte_alphabet()


def piece_length(path: str, piece: str) -> int:
    """Tokens of one pre-token: the merges alone, as it needs no splitting."""
    return len(tokenizer(path).model.tokenize(piece.encode().decode("latin-1").translate(BYTES)))


def whole(path: str, text: str) -> bool:
    """Whether the tokenizer has to see the text whole: special strings, or unsettled characters."""
    special = special_strings(path)
    return bool(UNSETTLED.search(text) or special and special.search(text))


class Lengths(dict):
    """A worker's cache of what the broadcast table lacks: emptied when full, without long entries."""

    def __init__(self, path: str, table: dict[str, int]):
        self.path, self.table = path, table

    def __missing__(self, piece: str) -> int:
        n = self.table.get(piece)
        if n is None:
            n = piece_length(self.path, piece)
            if len(piece) <= LONGEST:
                if len(self) >= CACHE:
                    self.clear()
                self[piece] = n
        return n


_caches: dict[str, Lengths] = {}


def lengths(path: str, table: dict[str, int]) -> Lengths:
    """The cache lives as long as the worker, across tasks; the table is this query's."""
    kept = _caches.setdefault(path, Lengths(path, table))
    kept.table = table
    return kept


def count_tokens(path: str, text: str, known: Lengths) -> int:
    return encoded_length(path, text) if whole(path, text) else sum(map(known.__getitem__, SPLIT.findall(text)))


def frequent_pretokens(docs: DataFrame, text_column: str = "text", size: int = TABLE_SIZE) -> DataFrame:
    """The frequent pre-tokens of all texts, with lower bounds of their counts: `size` rows at most.

    Each task counts with a bounded number of counters, after the frequent-items scheme of Misra and
    Gries: when they run over, all counts fall by the same amount. It reports its highest ones.
    """
    out = T.StructType([T.StructField("piece", T.StringType()), T.StructField("n", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                if text:
                    counts.update(SPLIT.findall(text))
                if len(counts) > COUNTERS:
                    floor = sorted(counts.values())[-COUNTERS // 2]
                    counts = Counter({k: v - floor for k, v in counts.items() if v > floor})
        top = [(k, v) for k, v in counts.most_common(SUMMARY) if len(k) <= LONGEST]
        yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in top], pa.string()),
                                          pa.array([v for _, v in top], pa.int64())], names=out.names)

    seen = map_arrow(docs.select(text_column), run, out)
    return seen.groupBy("piece").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "piece").limit(size)


def token_counts(docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text",
                 limit: int = 512) -> DataFrame:
    """One row per row of `docs`: its id, UTF-8 bytes, tokens, and whether they are more than `limit`.

    `path` is a tokenizers file with byte-level BPE. Counts are those of the tokenizer on the whole
    text, without tokens added at the ends; special strings inside a text are its special tokens.
    A null text counts as empty: 0 bytes, 0 tokens. Repeated rows give a row each; other columns are
    not read. The table only saves time: whatever it holds, the counts are the same.

    The table has `TABLE_SIZE` entries of `LONGEST` characters at most, some 10 MB.
    """
    spark = docs.sparkSession
    frequent = [r.piece for r in frequent_pretokens(docs, text_column).collect()]
    table = spark.sparkContext.broadcast({p: piece_length(path, p) for p in frequent})

    def rows(given):
        known = lengths(path, table.value)
        for text, in given:
            text = text or ""
            n = count_tokens(path, text, known)
            yield len(text.encode()), n, n > limit

    return per_row(docs, [text_column], ADDED, rows, keep=[id_column])

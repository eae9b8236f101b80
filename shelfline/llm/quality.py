"""Quality rules: plain counts, and bands of how far a text compresses.

Text that repeats itself compresses far better than prose of its length, and noise far worse. Each
document is compressed whole and in fixed chunks; the ratio of compressed to plain bytes has to lie
in the band of its length. The chunks find a stretch of filler in a long text of otherwise usual
prose: the share of chunks outside the chunk band has a limit too.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import zstandard
from pyspark.sql import DataFrame, types as T

from shelfline.llm.common import BLANKS, per_row

SYMBOLS = "#*$%&|<>"
ADDED = T.StructType([
    T.StructField("n_words", T.LongType()), T.StructField("word_chars", T.LongType()),
    T.StructField("n_symbols", T.LongType()), T.StructField("n_dup_lines", T.LongType()),
    T.StructField("n_repeat_words", T.LongType()), T.StructField("base_failed", T.BooleanType()),
    T.StructField("kept", T.BooleanType()), T.StructField("ratio", T.DoubleType()),
    T.StructField("worst_chunk", T.DoubleType()), T.StructField("best_chunk", T.DoubleType()),
    T.StructField("odd_chunks", T.LongType()), T.StructField("reason", T.StringType()),
])


@dataclass(frozen=True)
class Bands:
    """Limits of the compression ratio.

    `whole` lists (least UTF-8 bytes, lowest ratio, highest ratio) in ascending order; the last entry
    that a text reaches holds. Texts shorter than the first have no band: a frame of zstandard
    outweighs them. A text longer than a chunk has chunks of `chunk` bytes (a rest of under half a
    chunk belongs to the one before); more than `odd_share` of them outside `chunk_band` rejects it.
    """

    whole: tuple[tuple[int, float, float], ...] = (
        (256, 0.35, 0.95), (512, 0.30, 0.85), (1024, 0.25, 0.78), (4096, 0.20, 0.70), (16384, 0.15, 0.66),
        (65536, 0.10, 0.64))
    chunk: int = 4096
    chunk_band: tuple[float, float] = (0.15, 0.72)
    odd_share: float = 0.5
    level: int = 3

    def limits(self, n_bytes: int) -> tuple[float, float] | None:
        found = None
        for least, low, high in self.whole:
            if n_bytes >= least:
                found = (low, high)
        return found


@dataclass(frozen=True)
class Rules:
    min_words: int = 20
    window: int = 8
    max_repeat_percent: int = 30
    bands: Bands = field(default_factory=Bands)


def repeated_words(words: list[bytes], window: int) -> int:
    """Words covered by windows of so many words that occur twice or more in the list."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter(map(number.setdefault, words, range(len(words))), np.uint64, len(words))
    key = np.zeros(n, np.uint64)
    for k in range(window):
        key = key * np.uint64(0x9E3779B97F4A7C15) + (ids[k:k + n] + np.uint64(1)) * np.uint64(0xD1B54A32D192ED03)
        key ^= key >> np.uint64(29)
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    if not same.any():
        return 0
    twin = np.zeros(n, bool)
    twin[order[1:][same]] = twin[order[:-1][same]] = True
    seen: dict[tuple, int] = {}  # equal hashes are only candidates
    covered = np.zeros(len(words), bool)
    for i in np.flatnonzero(twin):
        first = seen.setdefault(tuple(ids[i:i + window].tolist()), i)
        if first != i:
            covered[i:i + window] = covered[first:first + window] = True
    return int(covered.sum())


def repeated_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [x for x in text.split("\n") if x.strip(BLANKS)]
    return len(lines) - len(set(lines))


def chunks(data: bytes, size: int) -> Iterator[bytes]:
    n = max(1, (len(data) + size // 2) // size)
    for k in range(n):
        yield data[k * size:(k + 1) * size if k < n - 1 else len(data)]


def verdict(data: bytes, bands: Bands, press: zstandard.ZstdCompressor) -> tuple:
    """(ratio, worst and best chunk, chunks outside the band, why it is rejected or None)."""
    limits = bands.limits(len(data))
    if limits is None:
        return None, None, None, 0, None
    ratio = len(press.compress(data)) / len(data)
    each = [ratio]
    if len(data) > bands.chunk:
        each = [len(press.compress(x)) / len(x) for x in chunks(data, bands.chunk)]
    low, high = bands.chunk_band
    odd = sum(not low <= x <= high for x in each) if len(data) > bands.chunk else 0
    why = ("repetitive" if ratio < limits[0] else "incompressible" if ratio > limits[1]
           else "odd chunks" if odd > bands.odd_share * len(each) else None)
    return ratio, max(each), min(each), odd, why


def quality(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", rules: Rules = Rules()) -> DataFrame:
    """One row per row of `docs`: its id, the counts, the ratios, whether it is kept and why not.

    A null text counts as empty: no words, so the base rules reject it. Repeated rows and ids give a
    row each; other columns of `docs` are not read. Every text is counted and compressed whole.
    """
    def rows(given):
        press = zstandard.ZstdCompressor(level=rules.bands.level)
        for text, in given:
            text = text or ""
            data = text.encode()
            words = data.split()
            n = len(words)
            repeats = repeated_words(words, rules.window)
            failed = n < rules.min_words or 100 * repeats > rules.max_repeat_percent * n
            ratio, worst, best, odd, why = verdict(data, rules.bands, press)
            yield (n, len(text) - sum(map(text.count, BLANKS)), sum(map(text.count, SYMBOLS)), repeated_lines(text),
                   repeats, failed, not failed and why is None, ratio, worst, best, odd,
                   "base" if failed else why)

    return per_row(docs, [text_column], ADDED, rows, keep=[id_column])

"""Substring dedup: repeated word windows found over a compacted De Bruijn graph.

A window of k words is an edge from its first k - 1 words to its last. Each window has an anchor, the
least hash of the short word runs inside it; consecutive windows of a document with the same anchor are
a path, and paths are compacted before anything is shuffled: one row stands for up to `k - anchor + 1`
edges. A path whose anchor leads to no other path is nonbranching; it is judged whole, by one join on
the hash of all its words. Only where an anchor has several paths (at the ends of a repeated passage)
are the first copies of these paths opened into edges and judged one by one. Source coordinates
(document, position) tell which copy is first, and give the spans to remove.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from shelfline.llm.common import BLANKS, map_arrow
from shelfline.session import discard, freeze

WINDOW = 20
ANCHOR = 5           # words of an anchor
SLICE_BYTES = 8 << 20
ONE = np.uint64(1)
_FACTOR = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))
LONG = 64            # bytes of a word; longer ones are hashed one by one
_FIRST = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)   # the first k of eight bytes
_IN_WORD = np.array([chr(k) not in BLANKS for k in range(256)])


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def run_hashes(h: np.ndarray, size: int, factor: np.uint64) -> np.ndarray:
    """Hash of the `size` words from each position on, for all positions that have them."""
    n = len(h) - size + 1
    total = np.zeros(max(n, 0), np.uint64)
    for k in range(size):
        total = total * factor + h[k:k + n]
    return mixed(total)


def _powers(factor: np.uint64, n: int) -> np.ndarray:
    """The powers of a factor from 0 to n, modulo 2**64."""
    powers = np.full(n + 1, factor)
    powers[0] = 1
    return np.cumprod(powers, dtype=np.uint64)


def span_hashes(h: np.ndarray, start: np.ndarray, size: np.ndarray, factor: np.uint64) -> np.ndarray:
    """Hash of `size` words from each start on, of different sizes: the difference of two sums, brought back to the
    start by the inverse of the odd factor."""
    sums = np.zeros(len(h) + 1, np.uint64)
    np.cumsum(h * _powers(factor, max(len(h) - 1, 0))[:len(h)], out=sums[1:])
    total = (sums[start + size] - sums[start]) * _powers(np.uint64(pow(int(factor), -1, 1 << 64)), len(h))[start]
    return mixed(total + size.astype(np.uint64) * _FACTOR[0])


def repeats(of: np.ndarray, s: np.ndarray, s2: np.ndarray) -> np.ndarray:
    """Which spans have the same row `of` and the same hashes as one before them."""
    same = np.zeros(len(of), bool)
    key = s + mixed(of.astype(np.uint64) * _FACTOR[1])
    order = np.argsort(key, kind="stable")
    equal = lambda x: x[order[1:]] == x[order[:-1]]
    alike = equal(of) & equal(s) & equal(s2)
    if (alike != equal(key)).any():   # one key for several spans
        order = np.lexsort((s2, s, of))
        alike = equal(of) & equal(s) & equal(s2)
    same[order[1:]] = alike
    return same


def paths_of(h: np.ndarray, sizes: np.ndarray, window: int, anchor: int) -> tuple[np.ndarray, ...]:
    """The compacted paths of documents laid end to end: (document, start, windows, anchor hash), where
    `h` are the word hashes and `sizes` the words of each document."""
    none = np.empty(0, np.int64)
    if len(h) < window:
        return none, none, none, none.astype(np.uint64)
    of = np.repeat(np.arange(len(sizes)), sizes)
    shorts = run_hashes(h, anchor, _FACTOR[0])
    reach = window - anchor + 1
    n = len(h) - window + 1
    least, at, wide = shorts, np.arange(len(shorts)), 1
    while wide < reach:         # leftmost of the least of ever more runs
        step = min(wide, reach - wide)
        lower = least[step:] < least[:-step]
        least, at = np.where(lower, least[step:], least[:-step]), np.where(lower, at[step:], at[:-step])
        wide += step
    whole = of[:n] == of[window - 1:]          # windows of one document
    first = whole.copy()
    first[1:] &= ~((at[1:] == at[:-1]) & whole[:-1] & (of[1:n] == of[:n - 1]))
    start = np.flatnonzero(first)
    number = np.cumsum(first)[whole] - 1
    count = np.bincount(number, minlength=len(start))
    return of[start], start, count, least[start]


def _flat(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of texts laid end to end, and the words of each."""
    import xxhash
    split = [t.encode().split() for t in texts]
    sizes = np.fromiter(map(len, split), np.int64, len(split))
    # A hash takes less time than a look at what is known of so many words.
    return np.fromiter(map(xxhash.xxh3_64_intdigest, chain.from_iterable(split)), np.uint64, int(sizes.sum())), sizes


def word_hashes(text: bytes, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Hash of the words at these places, eight bytes of all of them at a time; of one and the same length up to
    eight bytes no two are alike."""
    import xxhash
    eight = np.lib.stride_tricks.as_strided(np.frombuffer(text + bytes(8), np.uint64, 1), (len(text) + 1,), (1,))
    total = mixed(size.astype(np.uint64) * _FACTOR[1])
    rest = np.flatnonzero(size <= LONG)
    at, left = start[rest], size[rest]
    while len(rest):
        total[rest] = mixed((total[rest] + (eight[at] & _FIRST[np.minimum(left, 8)])) * _FACTOR[0])
        more = left > 8
        rest, at, left = rest[more], at[more] + 8, left[more] - 8
    for k in np.flatnonzero(size > LONG).tolist():
        total[k] = xxhash.xxh3_64_intdigest(text[start[k]:start[k] + size[k]])
    return total


def flat_words(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """As `_flat`, by other hashes and without an object for each word: paths take all words of a table twice."""
    encoded = [t.encode() for t in texts]
    text = b" ".join([b"", *encoded, b""])
    inside = _IN_WORD[np.frombuffer(text, np.uint8)]
    edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1   # a blank stands at both ends
    start, end = edges[::2], edges[1::2]
    ends = np.cumsum(np.fromiter(map(len, encoded), np.int64, len(encoded)) + 1)
    return word_hashes(text, start, end - start), np.diff(np.searchsorted(start, ends + 1), prepend=0)


def _slices(texts: list[str]) -> Iterator[tuple[int, int]]:
    first = total = 0
    for k, text in enumerate(texts):
        if total and total + len(text) > SLICE_BYTES:
            yield first, k
            first, total = k, 0
        total += len(text)
    if first < len(texts):
        yield first, len(texts)


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def paths(docs: DataFrame, window: int, anchor: int) -> DataFrame:
    """(id, t, start, windows, m, s, s2) of rows (id, text, t): each path's anchor, and 128 bits of all its words. A
    path that the same row holds earlier has `again`."""
    out = T.StructType([docs.schema["id"], T.StructField("t", T.IntegerType()), T.StructField("start", T.IntegerType()), T.StructField("windows", T.IntegerType()),
                        T.StructField("m", T.LongType()), T.StructField("s", T.LongType()), T.StructField("s2", T.LongType()),
                        T.StructField("again", T.BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for a, b in _slices(texts):
                h, sizes = flat_words(texts[a:b])
                of, start, count, least = paths_of(h, sizes, window, anchor)
                words = count + window - 1
                s, s2 = (span_hashes(h, start, words, f) for f in _FACTOR)
                same = repeats(of, s, s2)
                offset = np.cumsum(sizes) - sizes
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(of + a)), batch.column(2).take(pa.array(of + a)), pa.array((start - offset[of]).astype(np.int32)),
                     pa.array(count.astype(np.int32)), _signed(least), _signed(s), _signed(s2), pa.array(same)],
                    names=out.names)

    return map_arrow(docs, run, out)


def edges(docs: DataFrame, window: int) -> DataFrame:
    """(id, t, at, e, e2, again) of rows (id, text, opened, t), where `opened` lists (start, windows): one row
    for each window in them, with 128 bits of its words. A window that the same row holds at an earlier
    place has `again`."""
    out = T.StructType([docs.schema["id"], T.StructField("t", T.IntegerType()), T.StructField("at", T.IntegerType()), T.StructField("e", T.LongType()),
                        T.StructField("e2", T.LongType()), T.StructField("again", T.BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for a, b in _slices(texts):
                h, sizes = _flat(texts[a:b])
                offset = np.cumsum(sizes) - sizes
                opened = batch.column(2).slice(a, b - a)
                start, windows = (opened.flatten().field(c).to_numpy() for c in ("start", "windows"))
                start = start + np.repeat(offset, opened.value_lengths().to_numpy())
                first = np.cumsum(windows) - windows
                at = np.unique(np.repeat(start - first, windows) + np.arange(int(windows.sum())))
                of = np.searchsorted(offset, at, side="right") - 1
                size = np.full(len(at), window, np.int64)
                e, e2 = (span_hashes(h, at, size, f) for f in _FACTOR)
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).take(pa.array(of + a)) for c in (0, 3)), pa.array((at - offset[of]).astype(np.int32)), _signed(e),
                     _signed(e2), pa.array(repeats(of, e, e2))], names=out.names)

    return map_arrow(docs, run, out)


def repeated_spans(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """(id, t, spans): for (id, text, t) the starts and numbers of windows whose words also start earlier."""
    found = paths(docs, window, anchor)
    # The first document of each path; and the anchors that several paths share.
    first = freeze(found.where("not again").groupBy("m", "s", "s2").agg(F.min("id").alias("first"), F.count("*").alias("docs")), "paths")
    branching = first.groupBy("m").agg(F.count("*").alias("paths")).where("paths > 1").select("m", F.lit(True).alias("branching"))
    known = first.join(branching, "m", "left").where("docs > 1 or branching").select(
        "s", "s2", "first", F.coalesce("branching", F.lit(False)).alias("branching"))
    known = freeze(known, "known_paths")
    discard(first)
    met = found.join(known, ["s", "s2"], "left").where("again or first is not null")
    met = freeze(met.select("id", "t", "start", "windows", "branching", (F.col("again") | (F.col("first") < F.col("id"))).alias("later")), "met_paths")
    discard(known)
    # First copies of branching paths, edge by edge.
    opened = met.where("branching and not later").groupBy("id", "t").agg(F.collect_list(F.struct("start", "windows")).alias("opened"))
    single = freeze(edges(docs.join(opened.hint("shuffle_hash"), ["id", "t"]).select("id", "text", "opened", "t"), window), "edges")
    earliest = single.where("not again").groupBy("e", "e2").agg(F.min("id").alias("first"), F.count("*").alias("docs")).where("docs > 1")
    late = single.join(earliest.select("e", "e2", "first"), ["e", "e2"], "left").where("again or first < id")
    spans = met.where("later").select("id", "t", "start", "windows").unionAll(late.select("id", "t", F.col("at").alias("start"), F.lit(1).alias("windows")))
    return spans.groupBy("id", "t").agg(F.collect_set(F.struct("start", "windows")).alias("spans"))


def substring_dedup(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", window: int = WINDOW,
                    anchor: int = ANCHOR) -> DataFrame:
    """(id, n_words, n_removed, kept) for each row of `docs`; `kept` are the words left, joined by a space.

    A word goes if a window of `window` words covers it whose words also start earlier: in a document of
    smaller id, or further on top in the same one; windows are those of the input. A null, empty or
    short text has no windows. Rows that share an id share a place: copies between them stay, whether their
    texts are equal or not. Rows whose id is null come after all others, and likewise share a place. Words are parted by space and U+0009 to U+000D. Other
    columns are not read. Equality is that of 128-bit hashes.
    """
    last = 2**63 - 1
    read = docs.select(F.coalesce(F.col(id_column).cast("long"), F.lit(last)).alias("id"), F.col(text_column).alias("text"),
                       F.hash(text_column).alias("t"))
    spans = repeated_spans(read, window, anchor)
    joined = read.join(spans.hint("shuffle_hash"), ["id", "t"], "left")
    out = T.StructType([T.StructField(id_column, T.LongType()), T.StructField("n_words", T.LongType()),
                        T.StructField("n_removed", T.LongType()), T.StructField("kept", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                words = (text or "").encode().split()
                gone = np.zeros(len(words) + 1, np.int64)
                for x in spans or ():
                    if x["start"] < len(words):
                        gone[x["start"]] += 1
                        gone[min(x["start"] + x["windows"] + window - 1, len(words))] -= 1
                stays = np.cumsum(gone[:-1]) <= 0
                kept = words if not spans else [w for w, s in zip(words, stays.tolist()) if s]
                rows.append((len(words), len(words) - len(kept), b" ".join(kept)))
            n, removed, kept = (list(c) for c in zip(*rows)) if rows else ([], [], [])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(removed, pa.int64()),
                                              pa.array(kept, pa.binary())], names=out.names)

    made = map_arrow(joined.select("id", "text", "spans"), run, out)
    return made.withColumn(id_column, F.when(F.col(id_column) != last, F.col(id_column)))

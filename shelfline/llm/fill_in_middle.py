"""Fill-in-the-middle texts: a document's prefix, suffix and middle in another order, between sentinels.

A text is cut into units, a word with the blanks before it or the blanks at the end. One full match of
the repeated unit keeps every repetition, so that the ends of its captures are all places where a
cut may be; the document's id decides which two are taken, and in which form the text is written.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, functions as F, types as T

from shelfline.llm.common import map_arrow, slices

# A unit of the contract, and the sentinels. Both parts are possessive: a unit never
# gives characters back, so the match runs once over a text and keeps no way back.
UNITS = regex.compile(r"((?>[\x20\x09-\x0D]*+[^\x20\x09-\x0D]++|[\x20\x09-\x0D]++))*+")
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
SLICE = 8 << 20     # bytes of text that are worked on and handed back at once
MATCHED = 1 << 20   # characters in one match, as a capture takes some 220 bytes; longer texts go on at the next word's end
TO_WORD_END = regex.compile(r"[\x20\x09-\x0D]*+[^\x20\x09-\x0D]*+")

ADDED = T.StructType([
    T.StructField("n", T.LongType()), T.StructField("form", T.StringType()), T.StructField("prefix_chars", T.LongType()),
    T.StructField("middle_chars", T.LongType()), T.StructField("output", T.StringType()),
])


@dataclass(frozen=True)
class Rates:
    """Of a hundred documents, how many are rearranged, and how many of those have the suffix first."""

    rearranged: int = 50
    suffix_first: int = 80
    seed: int = 42


def draws(seed: int, doc_id) -> tuple[int, int, int, int]:
    """Four numbers below 2**32 from the document's id; a null id counts as the empty text."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return tuple(int(digest[k:k + 8], 16) for k in (0, 8, 16, 24))


def unit_ends(text: str) -> list[int]:
    """Where each unit ends, from the captures of one match; one match for each stretch of a very long text."""
    ends, start = [], 0
    while len(text) - start >= MATCHED:
        end = TO_WORD_END.match(text, start + MATCHED).end()
        ends += UNITS.fullmatch(text, start, end).ends(1)
        start = end
    return ends + UNITS.fullmatch(text, start).ends(1)


def rearranged(doc_id, text: str, rates: Rates) -> tuple[int, str, int | None, int | None, str]:
    ends = unit_ends(text)
    n = len(ends)
    h1, h2, h3, h4 = draws(rates.seed, doc_id)
    if not text or h3 % 100 >= rates.rearranged or any(s in text for s in (PREFIX, SUFFIX, MIDDLE)):
        return n, PLAIN, None, None, text
    a, b = (ends[k - 1] if k else 0 for k in sorted((h1 % (n + 1), h2 % (n + 1))))
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h4 % 100 < rates.suffix_first:
        return n, SPM, a, b - a, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return n, PSM, a, b - a, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def fill_in_middle(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                   rates: Rates = Rates()) -> DataFrame:
    """One row per row of `docs`: its id, units, form, lengths of prefix and middle, and the text in that form.

    A null text counts as empty. Empty texts, and texts that hold a sentinel themselves, stay plain, with null
    lengths. Either cut may be at an end of the text or at the same place as the other: parts can be
    empty. Rows of one id and text come out alike; a null id draws its numbers as the empty text would.
    Other columns are not read. Every row is worked on by itself, in slices of `SLICE` bytes, so that a
    task holds little more than its longest text.
    """
    out = T.StructType([docs.schema[id_column], *ADDED.fields])
    types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in slices(batches, 1, SLICE):
            made = [rearranged(i, t or "", rates) for i, t in zip(ids.to_pylist(), texts.to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [ids, *(pa.array(v, t) for v, t in zip(zip(*made), types))], names=out.names)

    return map_arrow(docs.select(id_column, text_column), run, out)


def restored(output: Column, form: Column) -> Column:
    """The text from its output and form alone. A sentinel occurs once in a rearranged text and never
    across the edge of a part, as it starts with a character that it has nowhere else."""
    head, middle = F.substring_index(output, MIDDLE, 1), F.substring_index(output, MIDDLE, -1)
    first = lambda mark: F.substr(F.substring_index(head, mark, 1), F.lit(len(PREFIX) + 1))
    last = lambda mark: F.substring_index(head, mark, -1)
    return (F.when(form == PSM, F.concat(first(SUFFIX), middle, last(SUFFIX)))
            .when(form == SPM, F.concat(last(PREFIX), middle, first(PREFIX))).otherwise(output))

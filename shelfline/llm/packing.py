"""Packing of documents' tokens into sequences, by the sum of squares.

A window is a sequence that is not full yet. A document goes into the fill level, or into a new
window, for which the sum over levels of the squared number of windows at that level is least after it:
levels stay evenly filled, so that most documents find a window that they fill to the last token. The
counts are one array with a place for each level. What a document has beyond whole windows fills
sequences of its own.

Every task packs the documents that it reads, as they come; nothing is shuffled. Windows still open at
a task's end, or beyond a number that bounds its memory, are filled up by cutting.
"""

from __future__ import annotations

import json
import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, types as T

from shelfline.llm.common import map_arrow, only, slices
from shelfline.llm.token_counts import BYTES, UNSETTLED, special_strings, tokenizer

SLICE = 8 << 20         # bytes of text that are tokenized before their pieces are handed on
STRETCH = 1 << 18       # characters of a text that are tokenized at once
OPEN = 1 << 14          # windows open in a task before all of them are filled up: 64 MB of ids at most
CACHED = 160 << 20      # bytes of pre-tokens and ids in a worker's cache
END = 0                 # the id after each document
ROWS = 1 << 16          # pieces handed back at once
WIDTH = 4               # bytes of an id

# Fixed value: the pattern of byte-level vocabularies. Contractions start with a sign that no word starts with, so
# that the most frequent kinds can be tried first.
SPLIT = regex.compile(r" ?\p{L}+| ?\p{N}+|'(?:[stmd]|re|ve|ll)| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")

# A text can be tokenized in stretches that end before a space or line break which follows a character that
# is no blank in any Unicode version: no pre-token goes across such a place, and no special string without blanks.
CUT = regex.compile(rf"(?s:.{{{STRETCH}}}.*?)[!-~、-﻾](?=[ \n])")
BLANK = regex.compile(r"[ \n]")

PIECE = T.StructType([
    T.StructField(name, T.LongType())
    for name in ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
])


def piece_coder(path: str) -> Callable[[bytes], list[int]]:
    """The merges of a pre-token's bytes. A vocabulary whose ids rise in the order of its merges is one of ranks, for
    which tiktoken has the faster code with the same outcome; any other goes to the tokenizer's own model."""
    with open(path, encoding="utf-8") as file:
        model = json.load(file)["model"]
    vocab = model["vocab"]
    merged = [vocab.get("".join(m.split(" ") if isinstance(m, str) else m), -1) for m in model["merges"]]
    own = tokenizer(path).model
    special = {t.content for t in tokenizer(path).get_added_tokens_decoder().values()}
    byte = {c: b for b, c in BYTES.items()}
    ranks = {bytes(byte[c] for c in t): i for t, i in vocab.items() if t not in special and set(t) <= set(byte)}
    plain = not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
    if plain and all(a < b for a, b in zip([-1, *merged], merged)) and all(bytes([b]) in ranks for b in range(256)):
        import tiktoken
        return tiktoken.Encoding("pieces", pat_str=r"\p{L}", mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_single_piece
    return lambda piece: [t.id for t in own.tokenize(piece.decode("latin-1").translate(BYTES))]


class Ids(dict):
    """A worker's cache of pre-tokens' ids, as bytes; emptied when it holds more than `CACHED` bytes."""

    def __init__(self, path: str):
        self.coded, self.held = piece_coder(path), 0

    def __missing__(self, piece: str) -> bytes:
        ids = packed(self.coded(piece.encode()))
        if len(piece) <= 64:
            if self.held > CACHED:
                self.clear()
                self.held = 0
            self.held += 250 + len(piece) * 2 + len(ids)   # with what Python adds
            self[piece] = ids
        return ids


def packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def stretches(path: str, text: str) -> Iterator[str]:
    special, start = special_strings(path), 0
    while not (special and BLANK.search(special.pattern)) and (found := CUT.match(text, start)):
        yield text[start:found.end()]
        start = found.end()
    yield text[start:]


def token_ids(path: str, text: str) -> bytes:
    """The ids of a text as the tokenizer gives them whole, as little-endian 32-bit integers.

    A stretch of settled characters without special strings is the sum of its pre-tokens; any other
    stretch goes to the tokenizer.
    """
    known = only(("ids", path), lambda: Ids(path))
    special, out = special_strings(path), []
    for part in stretches(path, text):
        if UNSETTLED.search(part) or special and special.search(part):
            out.append(packed(tokenizer(path).encode(part, add_special_tokens=False).ids))
        else:
            out += map(known.__getitem__, SPLIT.findall(part))
    return b"".join(out)


class Windows:
    """The open windows of one task, and the number of windows at each fill level.

    Pieces are (doc, start, ids, doc_tokens, offset); `take` returns those of sequences that are full.
    """

    def __init__(self, size: int, first_id: int, most_open: int = OPEN):
        self.size, self.next_id, self.most_open = size, first_id, most_open
        self.counts = np.zeros(size + 1, np.int64)       # windows at each level; none at 0, none at the full size
        self.at: list[list[list[tuple]]] = [[] for _ in range(size)]
        self.open = 0

    def level_for(self, length: int) -> int:
        """The level of least sum of squares after `length` more; 0 stands for a new window.

        The sum changes by 1 - 2 n for the level that loses a window and by 1 + 2 n for the one that gains it. Of
        equals the fullest level is taken.
        """
        levels = np.arange(self.size - length + 1)
        gain = 2 * self.counts[length:] + 1
        gain[-1] = 0                                       # full windows are no level
        loss = 1 - 2 * self.counts[levels]
        loss[0] = 0                                        # there are always empty windows
        change = np.where((levels > 0) & (self.counts[levels] == 0), np.iinfo(np.int64).max, gain + loss)
        return int(levels[::-1][np.argmin(change[::-1])])

    def take(self, doc, start: int, ids: bytes, total: int) -> Iterator[tuple]:
        """Places one piece of at most a window's size."""
        length = len(ids) // WIDTH
        level = self.level_for(length) if length < self.size else 0
        window = []
        if level:
            window = self.at[level].pop()
            self.counts[level] -= 1
            self.open -= 1
        window.append((doc, start, ids, total, level))
        level += length
        if level == self.size:
            yield from self.close(window)
        else:
            self.keep(window, level)
        if self.open > self.most_open:
            rest = yield from self.fill_up()
            if rest:
                self.keep(rest, sum(len(p[2]) for p in rest) // WIDTH)

    def keep(self, window: list[tuple], level: int) -> None:
        self.at[level].append(window)
        self.counts[level] += 1
        self.open += 1

    def close(self, window: list[tuple]) -> Iterator[tuple]:
        for doc, start, ids, total, offset in window:
            yield doc, start, len(ids) // WIDTH, zlib.crc32(ids), total, self.next_id, offset
        self.next_id += 1

    def moved(self, window: list[tuple], level: int, size: int, spare: list[tuple]) -> int:
        """Moves pieces of `spare`, cut where needed, to a window until it has `size` ids or none is left."""
        while level < size and spare:
            doc, start, ids, total, _ = spare.pop()
            room = (size - level) * WIDTH
            window.append((doc, start, ids[:room], total, level))
            level += min(len(ids), room) // WIDTH
            if len(ids) > room:
                spare.append((doc, start + room // WIDTH, ids[room:], total, 0))
        return level

    def fill_up(self) -> Iterator[tuple]:
        """Closes all open windows: the emptiest ones are cut to fill the fullest ones. Returns what is left at last."""
        windows = [w for level in self.at for w in level]
        self.at = [[] for _ in range(self.size)]
        self.counts[:] = 0
        self.open = low = 0
        spare: list[tuple] = []      # pieces of the emptiest windows
        while low < len(windows):
            window = windows.pop()
            level = window[-1][-1] + len(window[-1][2]) // WIDTH
            while (level := self.moved(window, level, self.size, spare)) < self.size and low < len(windows):
                spare, low = windows[low], low + 1
            if level < self.size:
                return window
            yield from self.close(window)
        rest: list[tuple] = []
        self.moved(rest, 0, self.size, spare)
        return rest

    def finish(self) -> Iterator[tuple]:
        """Fills up the windows and cuts the rest at powers of two, lengths that need no padding."""
        spare = yield from self.fill_up()
        while spare:
            left = sum(len(p[2]) for p in spare) // WIDTH
            window: list[tuple] = []
            self.moved(window, 0, min(self.size, 1 << left.bit_length() - 1), spare)
            yield from self.close(window)


def pack(docs: DataFrame, path: str, size: int = 1024, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per piece: its document, where it starts there, its length, its ids' CRC-32, the document's ids,
    its sequence and its place there.

    `path` is a tokenizers file with byte-level BPE; a document's ids are those of the tokenizer on the whole text,
    without tokens added at the ends, and then id 0. A null text counts as empty and has that id alone.
    Repeated rows are packed each; a null id is returned as null; other columns are not read. Every id lies
    in exactly one piece. Documents are cut into whole sequences and a rest; rests stay whole but for those
    that fill up the windows left open at a task's end (or beyond `OPEN` of them). Of a task, at most one
    sequence for each power of two below `size` is shorter than `size`, and none of another length.

    A sequence's id holds its task's partition, so that tasks number their sequences alone; a task that
    is run again over the same rows gives the same rows.
    """
    out = T.StructType([docs.schema[id_column], *PIECE.fields])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
        windows = Windows(size, TaskContext.get().partitionId() << 40)
        width, made = size * WIDTH, []
        for ids, texts in slices(batches, 1, SLICE):
            for k, text in enumerate(texts.to_pylist()):
                tokens = token_ids(path, text or "") + packed([END])
                total = len(tokens) // WIDTH
                for start in range(0, len(tokens), width):
                    made += windows.take(ids[k], start // WIDTH, tokens[start:start + width], total)
            if len(made) >= ROWS:
                yield made
                made = []
        made += windows.finish()
        if made:
            yield made

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for made in rows(batches):
            first, *others = zip(*made)
            kind = first[0].type
            yield pa.RecordBatch.from_arrays(
                [pa.array([v.as_py() for v in first], kind), *(pa.array(v, pa.int64()) for v in others)], names=out.names)

    return map_arrow(docs.select(id_column, text_column), run, out)

"""Byte-level BPE encoding and decoding by recursive DuckDB queries, one connection per Python worker.

A task splits its texts into pre-tokens and hands the distinct ones it has not met to DuckDB as rows
(word, position, token, next token). The recursive query joins them with the merge table, contracts
each word's leftmost pair of lowest rank, and goes on with the words that had one until none has.
Decoding joins token rows with the vocabulary; in the order of words and positions, the bytes of the rows
end to end are those of the words.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, types as T

from shelfline.llm.common import map_arrow, only

SLICE_BYTES = 2 << 20      # text that is split at once; a longer text is taken alone
WORDS = 20_000             # words in one recursive query
PAIRS = 2 << 20            # and squares of their bytes, as the query keeps the rows of every round
LONG = 256                 # bytes from which a word is contracted at all places of a pair at once
CACHE = 1 << 18            # pre-tokens in a worker's cache, some 70 MB; half of them are those met last
END = 65_535               # "next token" of a word's last one: in no vocabulary of 16 bits

# Each step moves a word's rows up by one place behind the pair; the pair's left row goes, its right
# row takes the merged token. Positions have 20 bits, so rank and place compare as one number.
SHORT_STEP = """
WITH RECURSIVE step AS (
  SELECT w, 0 AS round, idx, tok, nxt FROM start
  UNION ALL
  SELECT s.w, s.round + 1,
         CASE WHEN s.idx > b.place THEN s.idx - 1 ELSE s.idx END,
         CASE WHEN s.idx = b.place + 1 THEN b.merged ELSE s.tok END,
         CASE WHEN s.idx = b.place - 1 THEN b.merged ELSE s.nxt END
  FROM step s JOIN (SELECT w, (best >> 20)::INT AS merged, (best & 1048575)::INT AS place FROM (
    SELECT w, min((merged << 20) | idx) AS best
    FROM step JOIN merges ON pair = (tok::UINTEGER << 16) | nxt::UINTEGER GROUP BY w)) b ON b.w = s.w
  WHERE s.idx <> b.place)
SELECT w, idx, tok FROM step JOIN (SELECT w, max(round) AS round FROM step GROUP BY w) USING (w, round)
"""

# A long word has the same pair in many places. They all come before any other pair, from the left
# without overlap: in a run of equal tokens every second place counts. Only the newest rows are kept
# (a row's key is its place); places that have gone keep an older, larger length n.
LONG_STEP = """
WITH RECURSIVE step(w, idx, n, tok, nxt) USING KEY (w, idx) AS (
  SELECT w, idx, count(*) OVER (PARTITION BY w), tok, nxt FROM start
  UNION
  SELECT w, idx - before, n - total, CASE WHEN lag_taken THEN best ELSE tok END, CASE WHEN lead_taken THEN best ELSE nxt END
  FROM (
    SELECT *, coalesce(sum(taken::INT) OVER (PARTITION BY w ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before,
           sum(taken::INT) OVER (PARTITION BY w)::BIGINT AS total,
           coalesce(lag(taken) OVER (PARTITION BY w ORDER BY idx), false) AS lag_taken,
           coalesce(lead(taken) OVER (PARTITION BY w ORDER BY idx), false) AS lead_taken
    FROM (
      SELECT *, hit AND (row_number() OVER (PARTITION BY w, hit, run ORDER BY idx)) % 2 = 1 AS taken
      FROM (
        SELECT *, idx - row_number() OVER (PARTITION BY w, hit ORDER BY idx) AS run
        FROM (
          SELECT *, coalesce(merged = best, false) AS hit
          FROM (SELECT s.*, m.merged, min(m.merged) OVER (PARTITION BY s.w) AS best
                FROM step s LEFT JOIN merges m ON m.pair = (s.tok * 65536 + s.nxt)::UINTEGER)
          WHERE best IS NOT NULL))))
  WHERE NOT taken)
SELECT w, idx, tok FROM (SELECT *, min(n) OVER (PARTITION BY w) AS newest FROM step) WHERE n = newest AND idx < n
"""

GATHER = "SELECT w, tok, bytes FROM ({rows}) JOIN vocabulary ON id = tok ORDER BY w, idx"


def chunks(mine: list[int], words: list[bytes]) -> Iterator[list[int]]:
    """Runs of at most `WORDS` words and `PAIRS` squares of lengths, or a single word."""
    start, squares = 0, 0
    for k, i in enumerate(mine):
        square = min(len(words[i]), LONG) ** 2
        if k > start and (k - start == WORDS or squares + square > PAIRS):
            yield mine[start:k]
            start, squares = k, 0
        squares += square
    if start < len(mine):
        yield mine[start:]


class Coder:
    """A rank file in DuckDB, and what a worker has encoded so far."""

    def __init__(self, path: str, pattern: str):
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
        if max(ranks.values()) >= END:
            raise ValueError(f"ranks have to be below {END}")
        self.split = regex.compile(pattern).findall
        self.byte = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        self.whole = {t for t in ranks if len(t) > 1}
        self.ranks = ranks
        pairs = [(ranks[t[:k]] * 65536 + ranks[t[k:]], i) for t, i in ranks.items()
                 for k in range(1, len(t)) if t[:k] in ranks and t[k:] in ranks]
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "384MB", "temp_directory": ""})
        self._table("merges", pair=np.array([p for p, _ in pairs], np.uint32), merged=np.array([m for _, m in pairs], np.int64))
        self._table("vocabulary", id=np.array(list(ranks.values()), np.int32), bytes=pa.array(list(ranks), pa.binary()))
        self.known: dict[str, tuple[bytes, bytes]] = {}
        self.older: dict[str, tuple[bytes, bytes]] = {}

    def _table(self, name: str, **columns) -> None:
        self.db.register("given", pa.table(columns))
        self.db.execute(f"CREATE TABLE {name} AS SELECT * FROM given")
        self.db.unregister("given")

    def _gather(self, rows: str, table: pa.Table, n: int) -> list[tuple[bytes, bytes]]:
        """(ids, bytes) of the words 0 to n - 1 of a query's rows (w, idx, tok)."""
        self.db.register("start", table)
        found = self.db.sql(GATHER.format(rows=rows)).to_arrow_table()
        self.db.unregister("start")
        ids = found["tok"].to_numpy().astype("<u4").tobytes()
        text = b"".join(found["bytes"].to_pylist())
        first = np.searchsorted(found["w"].to_numpy(), np.arange(n + 1))
        place = np.append(0, np.cumsum(pc.binary_length(found["bytes"]).to_numpy()))[first].tolist()
        first = (first * 4).tolist()
        return [(ids[first[k]:first[k + 1]], text[place[k]:place[k + 1]]) for k in range(n)]

    def encode_words(self, words: list[bytes]) -> list[tuple[bytes, bytes]]:
        """(ids, decoded bytes) of each word. A word that is a token is that token."""
        found: list = [None] * len(words)
        for k, word in enumerate(words):
            if word in self.whole:
                found[k] = (np.array([self.ranks[word]], "<u4").tobytes(), word)
        for step, mine in ((SHORT_STEP, [k for k, w in enumerate(words) if found[k] is None and len(w) <= LONG]),
                           (LONG_STEP, [k for k, w in enumerate(words) if found[k] is None and len(w) > LONG])):
            for chunk in chunks(mine, words):
                size = np.fromiter((len(words[k]) for k in chunk), np.int64, len(chunk))
                tokens = self.byte[np.frombuffer(b"".join(words[k] for k in chunk), np.uint8)]
                of = np.repeat(np.arange(len(chunk)), size)
                ends = np.cumsum(size)
                following = np.append(tokens[1:], END)
                following[ends - 1] = END
                columns = {"w": of, "idx": np.arange(len(tokens)) - (ends - size)[of], "tok": tokens, "nxt": following}
                if step is SHORT_STEP:
                    columns = {c: v.astype(np.int32) for c, v in columns.items()}
                for k, coded in zip(chunk, self._gather(step, pa.table(columns), len(chunk))):
                    found[k] = coded
        return found

    def decode(self, coded: list[bytes]) -> list[bytes]:
        """The bytes of lists of ids, each as little-endian unsigned 32-bit integers."""
        size = np.fromiter((len(c) // 4 for c in coded), np.int64, len(coded))
        of = np.repeat(np.arange(len(coded)), size)
        rows = pa.table({"w": of, "idx": np.arange(len(of)), "tok": np.frombuffer(b"".join(coded), "<u4").astype(np.int64)})
        return [text for _, text in self._gather("SELECT w, idx, tok FROM start", rows, len(coded))]

    def encode(self, texts: list[str]) -> list[tuple[bytes, bytes]]:
        """(ids, decoded bytes) of each text: its words' in their order."""
        split = [self.split(t) for t in texts]
        distinct = set().union(*split)
        fresh = distinct.difference(self.known)
        if len(self.known) + len(fresh) > CACHE // 2:
            self.older, self.known, fresh = self.known, {}, distinct
        missing = [w for w in fresh if w not in self.older]
        self.known.update((w, self.older[w]) for w in fresh if w in self.older)
        self.known.update(zip(missing, self.encode_words([w.encode() for w in missing])))
        out = []
        for words in split:
            coded = list(map(self.known.__getitem__, words))
            out.append((b"".join([c[0] for c in coded]), b"".join([c[1] for c in coded])))
        if len(self.known) > CACHE:
            self.known = {}
        else:
            for w in missing:
                if len(w) > LONG:
                    del self.known[w]
        return out


def coder(path: str, pattern: str) -> Coder:
    return only(("coder", path, pattern), lambda: Coder(path, pattern))


def slices(texts: list[str]) -> Iterator[tuple[int, int]]:
    first = total = 0
    for k, text in enumerate(texts):
        if total and total + len(text) > SLICE_BYTES:
            yield first, k
            first, total = k, 0
        total += len(text)
    if first < len(texts):
        yield first, len(texts)


def encode(docs: DataFrame, path: str, pattern: str, text_column: str = "text", keep: list[str] | None = None) -> DataFrame:
    """One row per row of `docs`: the columns `keep` (default: all), `ids` and `decoded`.

    `path` is a rank file (base64 of a token's bytes and its rank on each line), `pattern` what splits a
    text into words; each word is encoded on its own. `ids` are little-endian unsigned 32-bit integers;
    `decoded` are the bytes that the ids stand for. No special tokens: their strings are ordinary text. A
    null or empty text has no ids. Repeated rows give a row each. A text column among `keep` stays as it
    is; kept columns named ids or decoded give way to the new ones.
    """
    keep = [c for c in (docs.columns if keep is None else keep) if c not in ("ids", "decoded")]
    out = T.StructType([*(docs.schema[c] for c in keep), T.StructField("ids", T.BinaryType()),
                        T.StructField("decoded", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with_ranks = coder(path, pattern)
        for batch in batches:
            texts = [t or "" for t in batch.column(batch.schema.get_field_index(text_column)).to_pylist()]
            for first, stop in slices(texts):
                coded = with_ranks.encode(texts[first:stop])
                kept = [batch.column(batch.schema.get_field_index(c)).slice(first, stop - first) for c in keep]
                yield pa.RecordBatch.from_arrays(
                    [*kept, pa.array([c[0] for c in coded], pa.binary()), pa.array([c[1] for c in coded], pa.binary())],
                    names=out.names)

    return map_arrow(docs.select(*dict.fromkeys([*keep, text_column])), run, out)


def decode(coded: DataFrame, path: str, pattern: str, ids_column: str = "ids", keep: list[str] | None = None) -> DataFrame:
    """One row per row: the columns `keep` (default: all but the ids) and `decoded`, the bytes of the ids.
    Null ids are no ids."""
    keep = [c for c in (coded.columns if keep is None else keep) if c not in (ids_column, "decoded")]
    out = T.StructType([*(coded.schema[c] for c in keep), T.StructField("decoded", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with_ranks = coder(path, pattern)
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                part = batch.slice(first, 256)
                ids = [i or b"" for i in part.column(part.schema.get_field_index(ids_column)).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(part.schema.get_field_index(c)) for c in keep),
                     pa.array(with_ranks.decode(ids), pa.binary())], names=out.names)

    return map_arrow(coded.select(*dict.fromkeys([*keep, ids_column])), run, out)

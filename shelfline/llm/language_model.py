"""A hierarchical Pitman-Yor language model, seated by Gibbs sampling and averaged over samples.

Each document is a restaurant of its own: a word that is new to it is drawn from the restaurant of the word
before it, one that it has had is likelier there. The restaurants of the words before share one parent, the
corpus: a table of a document is a customer of the restaurant of its word before, and a table there is a
customer of the corpus. The corpus's base measure spells words: letters are served in the restaurants
of their contexts (the letters before), and the restaurants of contexts that differ only in their first
letter share a parent, the context without it, down to the empty context and a uniform base. A table of
the corpus restaurant is a customer of the letter restaurants, a table of a letter restaurant a customer
of its parent. A sweep re-seats all customers of a level, the training documents' tokens among
them, given the levels around it. Word probabilities
are averaged over the samples after burn-in. A text is scored from its first word on, each word given
those before it: over the known words and one outcome for all others, and over all words as spelled.

All tables are DataFrames; nothing of the corpus passes through the driver. Texts are packed into chunks
first: a chunk's distinct words and its documents as word numbers, so that texts are read once. Words lie in
blocks by their hash, so that a chunk's words in order of hash are in order of the blocks too, and pairs (word
before, word) in groups, all as packed columns. Chunks, blocks and groups exchange packed
columns too, one for each two of them that share words or pairs, and both ends know their order: chunks tell
groups the customers of their pairs, groups tell chunks the seats there, and blocks tell both what
their words have. Letters are rows keyed by (context, letter).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame, functions as F, types as T

from shelfline.llm.common import give_back, let_go, map_arrow, with_package
from shelfline.session import discard, freeze

END = "\n"                 # the token at the end of a text, and the letter at the end of a word; in no word
ORDER = 3                  # letters of the longest context
BURN_IN, SAMPLES = 1, 2    # sweeps before and while probabilities are averaged
DISCOUNT, STRENGTH = 0.5, 1.0      # of letter restaurants
WORD_DISCOUNT, WORD_STRENGTH = 0.6, 100.0   # of the corpus
PAIR_DISCOUNT, PAIR_STRENGTH = 0.75, 10.0   # of the restaurant of a word before
TEXT_DISCOUNT, TEXT_STRENGTH = 0.4, 100.0   # of a document
START = -1                 # stands before the first word of a text
LETTERS = 0x110000         # the uniform base: every code point alike
CHUNK_BYTES = 6 << 20
GROUP_TOKENS = 1 << 20     # for each so many tokens a block of words and a group of pairs
CHUNK = ("chunk long, total long, words binary, counts binary, ids array<long>, held array<boolean>, sizes array<int>, "
         "tokens binary")


def held_out(id_: int | None, remainder: int = 1, folds: int = 5) -> bool:
    return crc32(("" if id_ is None else str(id_)).encode()) % folds == remainder


def hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(crc32, words), np.int64, len(words))


def word_order(words: list[bytes]) -> np.ndarray:
    """The order of distinct words by hash, and by the words themselves where hashes are equal."""
    crc = hashes(words)
    order = np.argsort(crc, kind="stable")
    crc = crc[order]
    for same in np.unique(crc[1:][crc[1:] == crc[:-1]]):
        a, z = np.searchsorted(crc, [same, same + 1])
        order[a:z] = sorted(order[a:z], key=words.__getitem__)
    return order


def listed(words: pa.Array) -> list[bytes]:
    """The words of an array; one empty word if there are none."""
    whole = pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words)
    return pc.binary_join(whole, "\n")[0].as_py().encode().split(b"\n")


def ranks(order: np.ndarray) -> np.ndarray:
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    return rank


def tokenized(texts: list[str]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Distinct words in `word_order`, the texts' tokens as places among them, and the texts' sizes. The empty word
    stands for the end of a text; blanks in a row leave empty words too, which are no tokens."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(pa.array(texts, pa.string())))
    flat = split.flatten()
    coded = flat.dictionary_encode()
    of = np.repeat(np.arange(len(texts)), pc.list_value_length(split).to_numpy())
    is_word = pc.greater(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
    of, words = of[is_word], listed(coded.dictionary)
    if b"" not in words:
        words.append(b"")
    sizes = np.bincount(of, minlength=len(texts)) + 1
    tokens = np.full(len(of) + len(texts), words.index(b""), np.int64)
    tokens[np.arange(len(of)) + of] = coded.indices.to_numpy()[is_word]
    order = word_order(words)
    return [words[k] for k in order], ranks(order)[tokens], sizes


def chunks(docs: DataFrame) -> DataFrame:
    """Packs (id, text): one row per `CHUNK_BYTES` of text. `words` are in `word_order`, `counts` their tokens in the
    training texts, `total` is all tokens."""
    out = T._parse_datatype_string(CHUNK)

    def chunk_row(ids: list, texts: list[str], chunk: int) -> pa.RecordBatch:
        words, tokens, sizes = tokenized(texts)
        held = np.array([held_out(id_) for id_ in ids])
        counts = np.bincount(tokens[np.repeat(~held, sizes)], minlength=len(words))
        row = [[chunk], [len(tokens)], [pack_words(words)], [pack(counts, np.int64)], [ids], [held], [sizes], [pack(tokens, np.uint32)]]
        kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.list_(pa.int32()),
                 pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, kinds)], names=out.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        task, made, ids, texts, total = TaskContext.get().partitionId(), 0, [], [], 0
        for batch in batches:
            given = pc.fill_null(batch.column(1), "")
            for id_, text, size in zip(batch.column(0).to_pylist(), given.to_pylist(), pc.binary_length(given).to_pylist()):
                if total and total + size > CHUNK_BYTES:
                    yield chunk_row(ids, texts, task << 32 | made)
                    made, ids, texts, total = made + 1, [], [], 0
                ids.append(id_)
                texts.append(text)
                total += size
        if ids:
            yield chunk_row(ids, texts, task << 32 | made)

    return map_arrow(docs, run, out)


def seat(customers: np.ndarray, table_mass: np.ndarray, base: np.ndarray, discount: float,
         rng: np.random.Generator) -> np.ndarray:
    """Tables of each dish after its customers have been seated anew, one after the other.

    A customer opens a table with a chance in proportion to `table_mass` (strength and discount times the
    restaurant's tables) times the base probability, and joins one in proportion to the dish's customers
    less their discount. Steps of customers, of a sixteenth of those seated, are drawn as one binomial.
    """
    tables = (customers > 0).astype(np.int64)
    at = np.flatnonzero(customers > 1)    # of dishes with customers left
    n, opening = customers[at], (table_mass * base)[at]
    seated, mine = np.ones(len(at), np.int64), np.ones(len(at), np.int64)
    while len(at):
        step = np.minimum(n - seated, np.maximum(1, seated // 16))
        chance = opening / np.maximum(opening + seated - discount * mine, 1e-12)
        mine += rng.binomial(step, np.clip(chance, 0.0, 1.0))
        seated += step
        left = seated < n
        if not left.all():
            tables[at[~left]] = mine[~left]
            at, n, opening, seated, mine = (v[left] for v in (at, n, opening, seated, mine))
    return tables


def block_seed(turn: int, words: list) -> np.random.Generator:
    """The same numbers whenever a block is seated again in the same turn."""
    return np.random.default_rng([turn, len(words), crc32(str(words[0]).encode()) if len(words) else 0])


# ---------------------------------------------------------------- packed columns
def pack(values: np.ndarray, kind=np.int32) -> bytes:
    """Whole numbers from 0 take as few bytes each as the largest needs, all lowest bytes first; others are kept as
    they are."""
    values = np.ascontiguousarray(values, kind)
    if values.dtype.kind in "iu" and values.min(initial=0) >= 0:
        width = max(1, (int(values.max(initial=0)).bit_length() + 7) // 8)
        whole = values.astype("<u4" if width <= 4 else "<u8")
        return zstandard.compress(bytes([width]) + whole.view(np.uint8).reshape(len(values), whole.itemsize).T[:width].tobytes(), 1)
    return zstandard.compress(values.dtype.char.encode() + values.tobytes(), 1)


def unpacked(values: bytes, kind=np.int32) -> np.ndarray:
    raw = zstandard.decompress(values)
    if raw[0] > 8:
        return np.frombuffer(raw, chr(raw[0]), offset=1).astype(kind)
    parts = np.frombuffer(raw, np.uint8, offset=1).reshape(raw[0], -1)
    if len(parts) == 1:
        return parts[0].astype(kind)
    whole = np.zeros((parts.shape[1], 4 if len(parts) <= 4 else 8), np.uint8)
    whole[:, :len(parts)] = parts.T
    return whole.view(f"<u{whole.shape[1]}")[:, 0].astype(kind)


def pack_rising(values: np.ndarray) -> bytes:
    return pack(np.diff(values, prepend=0), np.int64)


def rising(values: bytes) -> np.ndarray:
    return np.cumsum(unpacked(values, np.int64))


def pack_words(words: list[bytes]) -> bytes:
    return zstandard.compress(b"\n".join(words), 1)


def unpacked_words(words: bytes) -> list[bytes]:
    return zstandard.decompress(words).split(b"\n")


def joined(rows: pa.Table, by: str, column: str, kind=np.int64) -> np.ndarray:
    """The packed columns of the rows one after the other, in the order of `by`."""
    order = np.argsort(rows[by].to_numpy(), kind="stable")
    parts = [unpacked(rows[column][int(k)].as_py(), kind) for k in order]
    return np.concatenate(parts) if parts else np.empty(0, kind)


def runs(of: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(value, start, end) of the runs of equal values."""
    starts = np.flatnonzero(np.diff(of, prepend=of[:1] - 1))
    yield from zip(of[starts].tolist(), starts.tolist(), [*starts[1:].tolist(), len(of)])


KINDS = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}


def table(rows: list[tuple], schema: str) -> pa.Table:
    """A table of rows, for tasks that give packed columns."""
    names, kinds = zip(*(field.split() for field in schema.split(", ")))
    columns = list(zip(*rows)) or [()] * len(names)
    return pa.table([pa.array(c, KINDS[t]) for c, t in zip(columns, kinds)], names=names)


# ---------------------------------------------------------------- words, in blocks
BLOCK_WORDS = 1 << 24   # numbers that a block has for its words: its own number times this, and the place in the block
BLOCK = ("block long, seen array<long>, counts array<long>, tables array<long>, base array<double>, c_b array<long>, t_b array<long>, "
         "was array<long>, totals array<long>, known double")
BLOCK_COLUMNS = ["block", "seen", "counts", "tables", "base", "c_b", "t_b", "was", "totals", "known"]


def block_row(block: int, seen, counts, tables, base, c_b, t_b, was=()) -> pa.Table:
    """`was` are the customers that the tables were drawn for, once `counts` are others; `totals` are the sums of
    `root_totals`; `known` is the known words' sum of `base`."""
    known = seen > 0
    totals = np.array([v.sum() for v in (seen, known, counts, tables)])
    whole = lambda v, t: pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), pa.array(v, t))
    kinds = (*[pa.int64()] * 3, pa.float64(), *[pa.int64()] * 4)
    return pa.table([pa.array([block], pa.int64()), *(whole(v, t) for v, t in zip((seen, counts, tables, base, c_b, t_b, was, totals), kinds)),
                     pa.array([base[known].sum()], pa.float64())], names=BLOCK_COLUMNS)


def of_block(block: pa.Table, *columns: str, row: int = 0) -> list[np.ndarray]:
    return [block[c][row].values.to_numpy(zero_copy_only=False) for c in columns]


WORDS = "block long, chunk long, words binary, seen binary, at binary"


def word_rows(packed: DataFrame, blocks: int) -> DataFrame:
    """Of each block: all its words in `word_order` and their training tokens `seen`; for each chunk the places of
    the chunk's words there, in order, and their `seen`."""
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, words, counts in zip(*(c.to_pylist() for c in batch.columns)):
                words, counts = unpacked_words(words), unpacked(counts, np.int64)
                rows = [(block, chunk, pack_words(words[a:z]), pack(counts[a:z], np.int64), None)
                        for block, a, z in runs(hashes(words) * blocks >> 32)]
                yield from table(rows, WORDS).to_batches()

    def merge(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("chunk")
        block, given = rows["block"][0].as_py(), [unpacked_words(w) for w in rows["words"].to_pylist()]
        sizes = [len(w) for w in given]
        coded = pa.array([w for words in given for w in words], pa.binary()).cast(pa.string()).dictionary_encode()
        words = listed(coded.dictionary)
        order = word_order(words)
        place = ranks(order)[coded.indices.to_numpy()]
        seen = np.bincount(place, weights=np.concatenate([unpacked(c, np.int64) for c in rows["seen"].to_pylist()])).astype(np.int64)
        made = [(block, -1, pack_words([words[k] for k in order]), pack(seen, np.int64), None)]
        for chunk, at in zip(rows["chunk"].to_pylist(), np.split(place, np.cumsum(sizes)[:-1])):
            made.append((block, chunk, None, pack(seen[at], np.int64), pack_rising(at)))
        return table(made, WORDS)

    schema = T._parse_datatype_string(WORDS)
    return map_arrow(packed.select("chunk", "words", "counts"), deal, schema).groupBy("block").applyInArrow(merge, schema)


def word_blocks(words: DataFrame) -> DataFrame:
    """All words: `seen` are the training tokens, `counts` the corpus's customers, at first one at one table;
    `base` is the probability of the word as spelled in the last sweep; `c_b` and `t_b` are customers and
    tables of the word's own restaurant, where it is the word before."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, seen in zip(*(c.to_pylist() for c in batch.columns)):
                seen = unpacked(seen, np.int64)
                first, none = (seen > 0).astype(np.int64), np.zeros(len(seen), np.int64)
                yield from block_row(block, seen, first, first, none.astype(float), none, none).to_batches()

    return map_arrow(words.where("chunk = -1").select("block", "seen"), run, T._parse_datatype_string(BLOCK))


def numbered(blocks: DataFrame, *columns: str) -> DataFrame:
    """One row per word: its number, which is its place among all blocks, and `columns` of the blocks."""
    return blocks.select("block", F.posexplode(F.arrays_zip(*columns)).alias("pos", "w")).select(
        (F.col("block") * BLOCK_WORDS + F.col("pos")).alias("x"), *[F.col(f"w.{c}").alias(c) for c in columns])


# ---------------------------------------------------------------- pairs of words, in groups
LOCATED = "chunk long, ids array<long>, held array<boolean>, sizes array<int>, tokens binary, numbers binary, seen binary"
PAIRS_OF = 1 << 21   # tokens of a word before for which its pairs take another group
START_WAYS = 64      # groups that share the pairs at the start of a text


def locate(packed: DataFrame, words: DataFrame) -> DataFrame:
    """Chunks with their words by number, which are in order, and the words' training tokens in place of the words."""
    out = T._parse_datatype_string(LOCATED)

    def run(chunk: pa.Table, words: pa.Table) -> pa.Table:
        words = words.sort_by("block")
        x = [block * BLOCK_WORDS + rising(at) for block, at in zip(words["block"].to_pylist(), words["at"].to_pylist())]
        made = chunk.select(out.names[:5])
        for name, value in (("numbers", pack_rising(np.concatenate(x))), ("seen", pack(joined(words, "block", "seen"), np.int64))):
            made = made.append_column(name, pa.array([value], pa.binary()))
        return made

    return beside(packed.select(*out.names[:5]), words.where("chunk >= 0").select("block", "chunk", "seen", "at"), "chunk", run, LOCATED)


def in_order(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of pairs (a, b) of numbers from 0, equal ones as they come, and where another pair begins in it."""
    a, b = a.astype(np.int64), b.astype(np.int64)
    b_bits, bits = int(b.max(initial=0)).bit_length(), len(a).bit_length()
    fresh = np.ones(len(a), bool)
    if int(a.max(initial=0)).bit_length() + b_bits + bits < 64:   # numbers that hold their place sort faster than places do
        keys = a << b_bits + bits | b << bits | np.arange(len(a))
        keys.sort()
        order = keys & (1 << bits) - 1
        keys >>= bits
        np.not_equal(keys[1:], keys[:-1], out=fresh[1:])
    else:
        order = np.lexsort((b, a))
        fresh[1:] = (a[order[1:]] != a[order[:-1]]) | (b[order[1:]] != b[order[:-1]])
    return order, fresh


def in_document(tokens: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each token: its document, its number among the (document, word), and how often it came before."""
    of = np.repeat(np.arange(len(sizes)), sizes)
    order, fresh = in_order(of, tokens)
    run = np.flatnonzero(fresh)
    kind, before = np.empty(len(tokens), np.int64), np.empty(len(tokens), np.int64)
    number = np.cumsum(fresh) - 1
    kind[order] = number
    before[order] = np.arange(len(tokens)) - run[number]
    return of, kind, before


def in_pairs(tokens: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word before, word) of the chunk's distinct pairs, the first -1 at the start of a text, and the pair
    of each token."""
    last = np.empty(len(tokens), np.int64)
    last[1:] = tokens[:-1]
    last[np.cumsum(sizes) - sizes] = -1
    order, fresh = in_order(last + 1, tokens)
    pair = np.empty(len(tokens), np.int64)
    pair[order] = np.cumsum(fresh) - 1
    first = order[fresh]
    return last[first], tokens[first].astype(np.int64), pair


class Chunk:
    """A chunk's tokens and distinct pairs: by (word before, word), and the order in which they are dealt to groups."""

    def __init__(self, row: dict, groups: int):
        self.id, self.ids, self.sizes = row["chunk"], row["ids"], np.array(row["sizes"], np.int64)
        self.tokens, self.learned = unpacked(row["tokens"], np.uint32), ~np.array(row["held"], bool)
        self.numbers, self.seen = rising(row["numbers"]), unpacked(row["seen"], np.int64)
        self.last, self.word, self.pair = in_pairs(self.tokens, self.sizes)
        self.b = np.where(self.last < 0, START, self.numbers[self.last])
        self.x = self.numbers[self.word]
        ways = np.where(self.last < 0, START_WAYS, 1 + self.seen[self.last] // PAIRS_OF)
        group = (self.b * 64 + self.x % ways).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        group = ((group ^ (group >> np.uint64(32))) % np.uint64(groups)).astype(np.uint16 if groups <= 1 << 16 else np.int64)
        self.order = np.argsort(group, kind="stable")
        self.dealt = list(runs(group[self.order].astype(np.int64)))

    def pairs_of(self, mail: pa.Table, column: str) -> np.ndarray:
        """What the groups say of the pairs."""
        values = np.empty(len(self.word), np.int64)
        values[self.order] = joined(mail, "g", column, np.int32)
        return values


def chunk_of(texts: pa.Table, groups: int) -> Chunk:
    return Chunk(texts.slice(0, 1).to_pylist()[0], groups)


LAYOUT = "g long, chunk long, u binary, b binary, x binary, c binary, at binary"
# `kind` is what `key` is: a chunk, the block of words, or the group itself.
SEATS = ("g long, kind string, key long, pos binary, c binary, t binary, s binary, start_c long, start_t long")
MAIL = "kind string, key long, g long, block long, p binary, c binary, t binary"


def layout(located: DataFrame, groups: int) -> DataFrame:
    """Of each group: the words in its pairs `u`, the pairs (b, x) as places there, b from 1 on, in order, 0 at the start of a text,
    and the tables `c` if each text seats a word at one table, opened where the word comes first. For each chunk
    the places of its pairs."""
    out = T._parse_datatype_string("g long, chunk long, b binary, x binary, c binary")

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                chunk = Chunk(batch.slice(k, 1).to_pylist()[0], groups)
                of, _, before = in_document(chunk.tokens, chunk.sizes)
                c = np.bincount(chunk.pair[chunk.learned[of] & (before == 0)], minlength=len(chunk.word))
                for g, start, end in chunk.dealt:
                    some = chunk.order[start:end]
                    rows = [(g, chunk.id, pack_rising(chunk.b[some] - START), pack(chunk.x[some], np.int64), pack(c[some]))]
                    yield from table(rows, "g long, chunk long, b binary, x binary, c binary").to_batches()

    def merge(rows: pa.Table) -> pa.Table:
        b, x, c = ([read(v) for v in rows[k].to_pylist()] for k, read in (
            ("b", rising), ("x", lambda v: unpacked(v, np.int64)), ("c", unpacked)))
        sizes = [len(v) for v in b]
        b, x, c = np.concatenate(b) + START, np.concatenate(x), np.concatenate(c)
        heads = b[np.flatnonzero(np.diff(b, prepend=START))]
        u = np.unique(np.concatenate([heads[heads != START], x]))
        b, x = np.where(b == START, -1, np.searchsorted(u, b)), np.searchsorted(u, x)
        order, fresh = in_order(b + 1, x)
        place = np.empty(len(b), np.int64)
        place[order] = np.cumsum(fresh) - 1
        first = order[fresh]
        g = rows["g"][0].as_py()
        made = [(g, -1, pack_rising(u), pack_rising(b[first] + 1), pack(x[first]), pack(np.bincount(place, weights=c)), None)]
        for chunk, at in zip(rows["chunk"].to_pylist(), np.split(place, np.cumsum(sizes)[:-1])):
            made.append((g, chunk, None, None, None, None, pack_rising(at)))
        return table(made, LAYOUT)

    return map_arrow(located, deal, out).groupBy("g").applyInArrow(merge, T._parse_datatype_string(LAYOUT))


def asked(needs: DataFrame) -> DataFrame:
    """(block, kind, key, pos): the words of a block that a chunk or a group needs, in order; `needs` are (kind, key, words)."""
    schema = "block long, kind string, key long, pos binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for kind, key, words in zip(*(c.to_pylist() for c in batch.columns)):
                words = rising(words)
                rows = [(block, kind, key, pack_rising(words[start:end] % BLOCK_WORDS)) for block, start, end in runs(words // BLOCK_WORDS)]
                yield from table(rows, schema).to_batches()

    return map_arrow(needs, run, T._parse_datatype_string(schema))


CHANCE = np.float32   # of probabilities that only seat customers


def word_mail(blocks: DataFrame, asks: DataFrame, totals: tuple[int, int]) -> DataFrame:
    """MAIL of blocks to chunks and groups: the words' probabilities in the corpus and what their restaurants hold."""
    def run(block: pa.Table, asks: pa.Table) -> pa.Table:
        if not block.num_rows:
            return table([], MAIL)
        counts, tables, base, c, t = of_block(block, "counts", "tables", "base", "c_b", "t_b")
        p = sum(word_parts(counts, tables, base, totals))
        made = []
        for kind, key, pos in zip(*(asks[k].to_pylist() for k in ("kind", "key", "pos"))):
            pos = rising(pos)
            made.append((kind, key, None, block["block"][0].as_py(), pack(p[pos], CHANCE), pack(c[pos], np.int64), pack(t[pos], np.int64)))
        return table(made, MAIL)

    return beside(blocks.select("block", "counts", "tables", "base", "c_b", "t_b"), asks, "block", run, MAIL)


def seats_mail(seats: DataFrame) -> DataFrame:
    """MAIL of groups to chunks, and of a group to itself: what is seated."""
    none = F.lit(None)
    return seats.where("kind != 'block'").select("kind", "key", "g", none.cast("long").alias("block"), none.cast("binary").alias("p"), "c", "t")


def seat_texts(tokens: np.ndarray, sizes: np.ndarray, base: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Which tokens open a table of their document, all customers seated anew in the order of their words'
    tokens: the first of a word does, a later one with a chance as in `seat`. `base` is each token's
    probability given the word before. Steps of a sixteenth of a word's tokens are drawn at a time."""
    of, kind, before = in_document(tokens, sizes)
    opened = before == 0
    tables, in_text = np.ones(kind.max(initial=-1) + 1, np.int64), np.bincount(of[opened], minlength=len(sizes))
    again = np.flatnonzero(before)
    order = again[np.argsort(before[again], kind="stable")]
    turn, at = before[order], 0
    while at < len(order):
        seated = int(turn[at])
        step = max(1, seated // 16)
        end = int(np.searchsorted(turn, seated + step))
        some = order[at:end]
        opening = (TEXT_STRENGTH + TEXT_DISCOUNT * in_text[of[some]]) * base[some]
        joining = seated - TEXT_DISCOUNT * tables[kind[some]]
        new = some[rng.random(len(some)) * (opening + joining) < opening]
        opened[new] = True
        if step == 1:   # each word of a document once
            tables[kind[new]] += 1
        else:
            np.add.at(tables, kind[new], np.ones(len(new), np.int64))
        np.add.at(in_text, of[new], np.ones(len(new), np.int64))
        at = end
    return opened


def pair_masses(words: pa.Table, start: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Customers and tables of the words' restaurants; last those of the start of a text."""
    return tuple(np.append(joined(words, "block", k), v) for k, v in zip(("c", "t"), start))


def opening_mass(t_b):
    return PAIR_STRENGTH + PAIR_DISCOUNT * t_b


def text_sweep(located: DataFrame, mail: DataFrame, start: tuple[int, int], groups: int, turn: int) -> DataFrame:
    """MAIL of chunks to groups: the training documents' customers seated anew, given the probabilities of the
    pairs; their tables are the pairs' customers `c`."""
    def run(texts: pa.Table, mail: pa.Table) -> pa.Table:
        if not texts.num_rows:
            return table([], MAIL)
        chunk = chunk_of(texts, groups)
        words = mail.filter(pc.is_valid(mail["block"]))
        mail = mail.filter(pc.is_valid(mail["g"]))
        p = joined(words, "block", "p", CHANCE)
        c_b, t_b = pair_masses(words, start)
        c, t = chunk.pairs_of(mail, "c"), chunk.pairs_of(mail, "t")
        base = (c - PAIR_DISCOUNT * t + opening_mass(t_b[chunk.last]) * p[chunk.word]) / (PAIR_STRENGTH + c_b[chunk.last])
        in_training = np.repeat(chunk.learned, chunk.sizes)
        pair = chunk.pair[in_training]
        opened = seat_texts(chunk.tokens[in_training], chunk.sizes[chunk.learned], base[pair], np.random.default_rng([turn, chunk.id]))
        c = np.bincount(pair[opened], minlength=len(base))[chunk.order]
        return table([("group", g, chunk.id, None, None, pack(c[first:end]), None) for g, first, end in chunk.dealt], MAIL)

    return beside(located, mail.where("kind = 'chunk'").withColumnRenamed("key", "chunk"), "chunk", run, MAIL)


def pair_sweep(laid: DataFrame, mail: DataFrame | None, start: tuple[int, int], turn: int) -> DataFrame:
    """SEATS anew, given the pairs' customers in all chunks and the words' probabilities in the corpus; the mass of a
    restaurant's new tables is that of the sweep before. Without mail the first seats: a table for each pair that has customers."""
    def run(laid: pa.Table, mail: pa.Table) -> pa.Table:
        own, *members = sorted(laid.to_pylist(), key=lambda r: r["chunk"])
        g, u, b, x = own["g"], rising(own["u"]), rising(own["b"]) - 1, unpacked(own["x"])
        if mail.num_rows:
            words = mail.filter(pc.is_valid(mail["block"]))
            told = mail.filter(pc.is_valid(mail["g"]))
            told = dict(zip(told["g"].to_pylist(), told["c"].to_pylist()))
            c = np.zeros(len(b), np.int64)
            for row in members:
                c[rising(row["at"])] += unpacked(told[row["chunk"]])
            mass = opening_mass(pair_masses(words, start)[1])[b]
            t = seat(c, mass, joined(words, "block", "p", CHANCE)[x], PAIR_DISCOUNT, np.random.default_rng([turn, g]))
        else:
            c = unpacked(own["c"]).astype(np.int64)
            t = (c > 0).astype(np.int64)
        first = b < 0
        made = [(g, "group", g, None, None, None, None, int(c[first].sum()), int(t[first].sum()))]
        for row in members:
            at = rising(row["at"])
            made.append((g, "chunk", row["chunk"], None, pack(c[at]), pack(t[at]), None, None, None))
        add = lambda k, v: np.bincount(k, weights=v, minlength=len(u)).astype(np.int64)
        c_b, t_b, s = add(b[~first], c[~first]), add(b[~first], t[~first]), add(x, t)
        for block, a, z in runs(u // BLOCK_WORDS):
            made.append((g, "block", block, pack_rising(u[a:z] % BLOCK_WORDS), *(pack(v[a:z], np.int64) for v in (c_b, t_b, s)), None, None))
        return table(made, SEATS)

    if mail is None:
        mail = laid.sparkSession.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in T._parse_datatype_string(MAIL)])
    # In mail to a group `g` is the chunk that it came from.
    mail = mail.where("kind = 'group'").select(F.col("key").alias("group"), "g", "block", "p", "c", "t")
    return freeze(beside(laid.withColumn("group", F.col("g")), mail, "group", run, SEATS), "seats")


def start_masses(seats: DataFrame) -> tuple[int, int]:
    """Customers and tables of the restaurant of the start of a text."""
    found = seats.agg(F.sum("start_c"), F.sum("start_t")).first()
    return tuple(x or 0 for x in found)


def with_customers(blocks: DataFrame, seats: DataFrame) -> DataFrame:
    """Blocks with the pairs' tables as the corpus's customers, and what the words' own restaurants hold."""
    def run(block: pa.Table, mail: pa.Table) -> pa.Table:
        if not block.num_rows:
            return block.select(BLOCK_COLUMNS)
        seen, tables, base, was = of_block(block, "seen", "tables", "base", "counts")
        found = np.zeros((3, len(seen)), np.int64)
        for pos, *told in zip(*(mail[k].to_pylist() for k in ("pos", "s", "c", "t"))):
            pos = rising(pos)
            for mine, more in zip(found, told):
                mine[pos] += unpacked(more, np.int64)
        counts, c_b, t_b = found
        return block_row(block["block"][0].as_py(), seen, counts, tables, base, c_b, t_b, was)

    mail = seats.where("kind = 'block'").select(F.col("key").alias("block"), "pos", "s", "c", "t")
    return beside(blocks, mail, "block", run, BLOCK)


def beside(left: DataFrame, right: DataFrame, key: str, run, out: str) -> DataFrame:
    """`run` on the rows of each key."""
    def whole(left: pa.Table, right: pa.Table) -> pa.Table:
        let_go()
        made = run(left, right)
        del left, right
        give_back()
        return made

    with_package(left.sparkSession)
    return left.groupBy(key).cogroup(right.groupBy(key)).applyInArrow(whole, T._parse_datatype_string(out))


# ---------------------------------------------------------------- letters
SPELLING = "block long, words binary, letters binary, sizes binary, u array<string>, x array<string>"


def spelled(words: list[str]) -> tuple[list[str], list[str], np.ndarray, np.ndarray]:
    """Distinct (context, letter) along the words; which of them each letter is, word after word; and the words' letters.
    A tab stands before a word and a line feed after it."""
    text = "".join([f"\t{w}{END}" for w in words])
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
    points, used = np.frombuffer(text.encode("utf-32-le"), np.uint32), np.zeros(LETTERS, np.int64)
    used[points] = 1
    number = np.cumsum(used)
    code, kinds = number[points], int(number[-1]) + 1
    tabs = np.cumsum(sizes + 1) - sizes - 1
    place = np.arange(len(text)) - np.repeat(tabs, sizes + 1)
    at = np.flatnonzero(place)
    far = [np.where(place[at] >= k, code[at - k], 0) for k in range(ORDER + 1)]   # 0 before the word
    order, fresh = in_order(far[3] * kinds + far[2], far[1] * kinds + far[0])
    which = np.empty(len(at), np.int64)
    which[order] = np.cumsum(fresh) - 1
    first = at[order[fresh]]
    u = [text[k - min(n, ORDER):k] for k, n in zip(first.tolist(), place[first].tolist())]
    return u, [text[k] for k in first.tolist()], which, sizes


def spelling(words: DataFrame) -> DataFrame:
    """Of each block: its words, the distinct (u, x) of its letters, which of them each letter is and how many a word has."""
    out = T._parse_datatype_string(SPELLING)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, words in zip(*(c.to_pylist() for c in batch.columns)):
                u, x, letters, sizes = spelled([w.decode() or END for w in unpacked_words(words)])
                yield pa.RecordBatch.from_arrays([
                    pa.array([block], pa.int64()), *(pa.array([v], pa.binary()) for v in (words, pack(letters), pack(sizes))),
                    *(pa.array([v], pa.list_(pa.string())) for v in (u, x))], names=out.names)

    return map_arrow(words.where("chunk = -1").select("block", "words"), run, out)


def letter_rows(spelt: DataFrame, blocks: DataFrame) -> DataFrame:
    """(u, x, c): the letters that words need, with the words' tables as customers. Words that no table serves need
    theirs too, with no customer."""
    schema = "u string, x string, c long"

    def run(spelt: pa.Table, block: pa.Table) -> pa.Table:
        (tables,) = of_block(block, "tables")
        u, x = (spelt[k].chunk(0).flatten() for k in "ux")
        letters, sizes = (unpacked(spelt[k][0].as_py()) for k in ("letters", "sizes"))
        c = np.bincount(letters, weights=np.repeat(tables, sizes), minlength=len(u)).astype(np.int64)
        return pa.table([u, x, pa.array(c)], names=["u", "x", "c"])

    return beside(spelt.drop("words"), blocks.select("block", "tables"), "block", run, schema).groupBy("u", "x").agg(F.sum("c").alias("c"))


def _level(rows: DataFrame, n: int) -> DataFrame:
    return rows.where(F.char_length("u") == n)


def parent(u: Column) -> Column:
    return F.substring(u, 2, ORDER)


def with_mass(rows: DataFrame) -> DataFrame:
    """(u, x, c, t) with the customers and tables of the restaurant."""
    whole = rows.groupBy("u").agg(F.sum("c").alias("c_u"), F.sum("t").alias("t_u"))
    return rows.join(whole, "u")


def letter_probabilities(levels: list[DataFrame]) -> DataFrame:
    """(u, x, c, t, c_u, t_u, p) of all levels: what the dishes of a restaurant leave goes to its parent."""
    done, above = None, None
    for n, rows in enumerate(levels):
        rows = with_mass(rows)
        base = F.lit(1.0 / LETTERS)
        if n:
            rows = rows.withColumn("up", parent(F.col("u"))).join(
                above.select(F.col("u").alias("up"), "x", F.col("p").alias("base")), ["up", "x"]).drop("up")
            base = F.col("base")
        rows = rows.withColumn("p", (F.col("c") - DISCOUNT * F.col("t") + (STRENGTH + DISCOUNT * F.col("t_u")) * base)
                               / (STRENGTH + F.col("c_u"))).select("u", "x", "c", "t", "c_u", "t_u", "p")
        above = rows
        done = rows if done is None else done.unionByName(rows)
    return done


def letter_sweep(leaves: DataFrame, before: DataFrame | None, turn: int) -> list[DataFrame]:
    """Seats all letters, from the longest contexts to the empty one; each level's tables are its parents'
    customers. `before` is the last sweep's state; the first sweep serves each dish at one table."""
    levels: list[DataFrame] = []
    rows = None
    out = T._parse_datatype_string("u string, x string, c long, t long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            c, mass, base = (batch.column(k).to_numpy(zero_copy_only=False) for k in (2, 3, 4))
            tables = seat(c, mass, base, DISCOUNT, block_seed(turn, batch.column(0).to_pylist()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(tables)], names=out.names)

    for n in range(ORDER, -1, -1):
        mine = _level(leaves, n)
        if rows is not None:
            mine = mine.unionByName(rows.select(parent(F.col("u")).alias("u"), "x", F.col("t").alias("c")))
        mine = mine.groupBy("u", "x").agg(F.sum("c").alias("c"))
        if before is None:
            mine = mine.withColumn("t", (F.col("c") > 0).cast("long"))
        else:
            mass = before.select("u", (STRENGTH + DISCOUNT * F.col("t_u")).alias("mass")).distinct()
            base = before.select(F.col("u").alias("up"), "x", F.col("p").alias("base"))
            mine = mine.join(mass, "u", "left").withColumn("mass", F.coalesce("mass", F.lit(STRENGTH)))
            if n:
                mine = mine.withColumn("up", parent(F.col("u"))).join(base, ["up", "x"], "left").drop("up")
            else:
                mine = mine.withColumn("base", F.lit(None).cast("double"))
            mine = mine.select("u", "x", "c", "mass", F.coalesce("base", F.lit(1.0 / LETTERS)).alias("base"))
            mine = map_arrow(mine.sortWithinPartitions("u", "x"), run, out)
        rows = freeze(mine, f"letters_{n}")   # seats once drawn stay
        levels.insert(0, rows)
    return levels


def new_table(customers: int, tables: int) -> float:
    """The chance that the next customer of the corpus opens a table."""
    return (WORD_STRENGTH + WORD_DISCOUNT * tables) / (WORD_STRENGTH + customers)


def word_sweep(blocks: DataFrame, spelt: DataFrame, letters: DataFrame, totals: tuple[int, int], turn: int) -> DataFrame:
    """Blocks with their words seated anew; `totals` are customers and tables of the root restaurant."""
    _, n_tables = totals
    given = spelt.select("block", F.posexplode(F.arrays_zip("u", "x")).alias("k", "l")).select(F.col("block").alias("block"), "k", "l.u", "l.x").join(
        letters.select("u", "x", "p"), ["u", "x"]).select("block", "k", "p")

    def run(block: pa.Table, given: pa.Table) -> pa.Table:
        seen, counts, c_b, t_b = of_block(block, "seen", "counts", "c_b", "t_b")
        letters, sizes = (unpacked(block[k][0].as_py()) for k in ("letters", "sizes"))
        logs = np.empty(given.num_rows)
        logs[given["k"].to_numpy()] = np.log(given["p"].to_numpy())
        base = np.exp(np.add.reduceat(logs[letters], np.cumsum(sizes) - sizes))
        mass = np.full(len(seen), WORD_STRENGTH + WORD_DISCOUNT * n_tables)
        number = block["block"][0].as_py()
        tables = seat(counts, mass, base, WORD_DISCOUNT, np.random.default_rng([turn, number]))
        return block_row(number, seen, counts, tables, base, c_b, t_b)

    both = spelt.select("block", "letters", "sizes").join(blocks.select("block", "seen", "counts", "c_b", "t_b"), "block")
    return beside(both, given, "block", run, BLOCK)


def word_parts(counts, tables, base, totals: tuple[int, int]):
    """The two parts of a word's probability: its own customers, and its share of a new table. With the tables as
    they are now, all words together have probability 1. For arrays and for columns."""
    customers, all_tables = totals
    return (counts - WORD_DISCOUNT * tables) / (WORD_STRENGTH + customers), base * new_table(customers, all_tables)


def word_probabilities(blocks: DataFrame, totals: tuple[int, int]) -> DataFrame:
    """(x, seen, served, spelt): one row per word."""
    parts = word_parts(F.col("was"), F.col("tables"), F.col("base"), totals)
    return numbered(blocks, "seen", "was", "tables", "base").select("x", "seen", *[c.alias(n) for c, n in zip(parts, ("served", "spelt"))])


def words_of(spelt: DataFrame) -> DataFrame:
    """(x, word)."""
    out = T._parse_datatype_string("x long, word string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, words in zip(*(c.to_pylist() for c in batch.columns)):
                words = [w.decode() or END for w in unpacked_words(words)]
                yield pa.RecordBatch.from_arrays([
                    pa.array(block * BLOCK_WORDS + np.arange(len(words))), pa.array(words, pa.string())], names=out.names)

    return map_arrow(spelt.select("block", "words"), run, out)


def root_totals(blocks: DataFrame) -> tuple[int, ...]:
    """(training tokens, distinct ones, customers of the corpus, their tables)."""
    found = blocks.agg(*[F.sum(F.col("totals")[k]) for k in range(4)]).first()
    return tuple(x or 0 for x in found)


@dataclass(frozen=True)
class Sample:
    """A state: the words as seated and their restaurants after it, the pairs' seats, and what the driver knows of it."""

    blocks: DataFrame
    seats: DataFrame
    totals: tuple[int, int]
    start: tuple[int, int]


@dataclass(frozen=True)
class Fitted:
    """Training tokens, distinct ones; the words, the chunks, what they ask of the blocks, the number of groups, the
    samples, and the averaged chance of a new table and sum of the known words as spelled."""

    n_words: int
    distinct: int
    spelt: DataFrame
    located: DataFrame
    asks: DataFrame
    groups: int
    samples: list[Sample]
    opening: float
    known: float


def fit(packed: DataFrame) -> tuple[DataFrame, int, int]:
    """((word, c, open, closed), training tokens, distinct ones) of the corpus."""
    model = fitted(packed)
    words = reduce(DataFrame.unionByName, [word_probabilities(s.blocks, s.totals) for s in model.samples]).groupBy("x").agg(
        F.first("seen").alias("c"), (F.sum("served") / SAMPLES).alias("served"),
        (F.sum("spelt") / SAMPLES).alias("spelt")).join(words_of(model.spelt), "x")
    share = F.when(F.col("c") > 0, F.col("spelt") / model.known * (model.distinct / (model.distinct + 1))).otherwise(1 / (model.distinct + 1))
    return words.select("word", "c", (F.col("served") + F.col("spelt")).alias("open"),
                        (F.col("served") + model.opening * share).alias("closed")), model.n_words, model.distinct


def known_spelt(sample: Sample) -> float:
    """The share of a new table that the known words have."""
    return (sample.blocks.agg(F.sum("known")).first()[0] or 0.0) * new_table(*sample.totals)


def fitted(packed: DataFrame, keep: bool = True) -> Fitted:
    """The seated restaurants; the tables of chunks and of the words go once they are read, unless they are to be kept.

    `open` is the averaged probability of a word as spelled, over all words there can be. `closed` is over
    the known words and one outcome for the others, as in the base score: that outcome has one share in
    `distinct` + 1 of a new table, and the known words share the rest as they are spelled.
    """
    groups = max(1, -(-(packed.agg(F.sum("total")).first()[0] or 0) // GROUP_TOKENS))
    words = freeze(word_rows(packed, groups), "dealt")
    located = freeze(locate(packed, words), "located")
    if not keep:
        discard(packed)
    counted, spelt = freeze(word_blocks(words), "words"), freeze(spelling(words), "spelling")
    discard(words)
    laid = freeze(layout(located, groups), "layout")
    asks = {"chunk": freeze(asked(located.select(F.lit("chunk").alias("kind"), "chunk", "numbers")), "asks"),
            "group": freeze(asked(laid.where("chunk = -1").select(F.lit("group").alias("kind"), "g", "u")), "asks")}
    seats = pair_sweep(laid, None, (0, 0), 0)
    start = start_masses(seats)
    blocks = freeze(with_customers(counted, seats), "words")
    discard(counted)
    letters, samples = None, []
    for turn in range(BURN_IN + SAMPLES):
        n_words, distinct, customers, tables = root_totals(blocks)
        leaves = freeze(letter_rows(spelt, blocks), "letters_needed")
        levels = letter_sweep(leaves, letters, turn)
        before, letters = letters, freeze(letter_probabilities(levels), "letters")
        discard(before, leaves, *levels)
        # The customers seated this turn stand for all but their own change of the total tables.
        before, seated = blocks, freeze(word_sweep(blocks, spelt, letters, (customers, tables), turn), "words")
        discard(*([before] if all(before is not s.blocks for s in samples) else []), *([] if keep or turn < BURN_IN + SAMPLES - 1 else [spelt]))
        totals = root_totals(seated)[2:]
        words = {kind: word_mail(seated, asked_of, totals) for kind, asked_of in asks.items()}
        customers_of = freeze(text_sweep(located, words["chunk"].unionByName(seats_mail(seats)), start, groups, turn), "customers")
        last, seats = seats, pair_sweep(laid, words["group"].unionByName(customers_of), start, turn)
        discard(customers_of, *([last] if all(last is not s.seats for s in samples) else []))
        start = start_masses(seats)
        blocks = freeze(with_customers(seated, seats), "words")
        discard(seated)
        if turn >= BURN_IN:
            samples.append(Sample(blocks, seats, totals, start))
    discard(letters, laid, asks["group"])
    return Fitted(n_words, distinct, spelt, located, asks["chunk"], groups, samples, sum(new_table(*s.totals) for s in samples) / SAMPLES,
                  sum(map(known_spelt, samples)) / SAMPLES or 1.0)


def in_sequence(tokens: np.ndarray, sizes: np.ndarray, *corpora: tuple[np.ndarray, np.ndarray]) -> list[np.ndarray]:
    """log10 of each token's probability given the tokens before it in its document: those of its own
    kind, less a discount for their table, and the restaurant of the word before for what is left. For each
    of `corpora`: the probabilities there, and the tokens that may gain by their own kind."""
    of, _, before = in_document(tokens, sizes)
    starts = np.cumsum(sizes) - sizes
    place = np.arange(len(tokens)) - starts[of]
    new = (before == 0).astype(np.int64)
    served = np.cumsum(new) - new
    served -= served[starts][of]
    own = np.where(before > 0, before - TEXT_DISCOUNT, 0.0)
    return [np.log10((own * gains + (TEXT_STRENGTH + TEXT_DISCOUNT * served) * corpus) / (TEXT_STRENGTH + place))
            for corpus, gains in corpora]


def averaged_mail(model: Fitted) -> DataFrame:
    """(chunk, block, served, spelt, and `c` and `t` of each sample): the averaged parts of the words' probabilities, and what
    their restaurants hold in the samples."""
    totals = [s.totals for s in model.samples]
    of_samples = ", ".join(f"c{k} binary, t{k} binary" for k in range(SAMPLES))
    out = f"chunk long, block long, served binary, spelt binary, {of_samples}"
    rows = [s.blocks.select("block", F.lit(k).alias("sample"), "was", "tables", "base", "c_b", "t_b") for k, s in enumerate(model.samples)]

    def run(blocks: pa.Table, asks: pa.Table) -> pa.Table:
        if not blocks.num_rows:
            return table([], out)
        at = {s: k for k, s in enumerate(blocks["sample"].to_pylist())}
        parts = [word_parts(*of_block(blocks, "was", "tables", "base", row=at[k]), totals[k]) for k in range(SAMPLES)]
        served, spelt = (sum(p) / SAMPLES for p in zip(*parts))
        masses = [v for k in range(SAMPLES) for v in of_block(blocks, "c_b", "t_b", row=at[k])]
        made = []
        for key, pos in zip(asks["key"].to_pylist(), asks["pos"].to_pylist()):
            pos = rising(pos)
            made.append((key, blocks["block"][0].as_py(), *(pack(v[pos], np.float64) for v in (served, spelt)),
                         *(pack(v[pos], np.int64) for v in masses)))
        return table(made, out)

    return beside(reduce(DataFrame.unionAll, rows), model.asks, "block", run, out)


def scored(model: Fitted, id_column: str) -> DataFrame:
    out = (f"`{id_column}` long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, "
           "score double, open_score double")
    names = [f.name for f in T._parse_datatype_string(out)]
    n_words, distinct, groups = model.n_words, model.distinct, model.groups
    opening, known = model.opening, model.known
    starts_of = [s.start for s in model.samples]

    def run(texts: pa.Table, mail: pa.Table) -> pa.Table:
        if not texts.num_rows:
            return pa.table([pa.array([], t) for t in (pa.int64(), pa.bool_(), *[pa.int64()] * 3, *[pa.float64()] * 3)], names=names)
        chunk = chunk_of(texts, groups)
        words = mail.filter(pc.is_valid(mail["block"]))
        # What the pair's own customers have, and the corpus's share of what its word before leaves.
        own = left = 0.0
        for k, start in enumerate(starts_of):
            seats = mail.filter(pc.equal(mail["sample"], k))
            c_b, t_b = (np.append(joined(words, "block", f"{n}{k}"), v)[chunk.last] for n, v in zip("ct", start))
            c, t = (chunk.pairs_of(seats, f"{n}0") for n in "ct")
            own = own + (c - PAIR_DISCOUNT * t) / (PAIR_STRENGTH + c_b) / SAMPLES
            left = left + opening_mass(t_b) / (PAIR_STRENGTH + c_b) / SAMPLES
        served, spelt = (joined(words, "block", n, np.float64) for n in ("served", "spelt"))
        share = np.where(chunk.seen > 0, spelt / known * (distinct / (distinct + 1)), 1 / (distinct + 1))
        spelt, closed = ((own + left * p[chunk.word])[chunk.pair] for p in (served + spelt, served + opening * share))
        count = chunk.seen[chunk.tokens]
        base = np.log10((count + 0.5) / (n_words + 0.5 * (distinct + 1)))
        log, log_open = in_sequence(chunk.tokens, chunk.sizes, (closed, count > 0), (spelt, np.ones(len(count), bool)))
        starts = np.cumsum(chunk.sizes) - chunk.sizes
        add = lambda v: np.add.reduceat(v, starts)
        return pa.table([
            pa.array(chunk.ids, pa.int64()), pa.array(~chunk.learned), pa.array(chunk.sizes), pa.array(add((count > 0).astype(np.int64))),
            pa.array(np.full(len(starts), n_words)), pa.array(add(base)), pa.array(add(log)), pa.array(add(log_open))], names=names)

    mail = freeze(averaged_mail(model), "averaged")
    discard(model.asks, *(s.blocks for s in model.samples))
    for k, s in enumerate(model.samples):
        seats = s.seats.where("kind = 'chunk'").select(F.col("key").alias("chunk"), "g", F.lit(k).alias("sample"), F.col("c").alias("c0"), F.col("t").alias("t0"))
        mail = mail.unionByName(seats, allowMissingColumns=True)
    return beside(model.located, mail, "chunk", run, out)


def language_model_scores(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of `docs`: id, held_out, n_tokens, n_known, train_tokens, base_score, score, open_score.

    Tokens are the words of the text, A-Z in lower case, and an end. The model learns from all rows whose
    crc32 of the id as text is not 1 modulo 5 (a null id counts as the empty text). A null or empty text is
    its end alone. Repeated rows give a row each and are learned from each time. Without training texts
    the model is its base measure. Scores are log10 probabilities of whole texts: `score` over the outcomes
    of the base score, the known words and one for all others (such a word gains nothing by having come
    before); `open_score` over all words as they are spelled. Ids have to be integers; other columns are
    not read.
    """
    read = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"))
    packed = freeze(chunks(read), "chunks")
    return scored(fitted(packed, keep=False), id_column)

"""Repair of damaged conversations at the least cost of edits, with the edits as an audit.

A conversation is to read as an optional system turn and then pairs of user and assistant. Its rows are kept,
given another role or deleted, and turns are inserted. A node is a row together with how far the order
has come; an arc is an edit. A pass from the end gives the least cost of each node, and what lies on a
cheapest way are the optimal arcs. Their audits are compared by prefix doubling: arcs are ranked by their
first letter, then by the ranks of the arc and of the one that its pointer leads to, over one, two, four and
more letters, while the pointers are doubled. Ranks choose the arc at the start and after every arc;
the doubled pointers give the way from there.

Conversations of up to `ROWS` rows and `BYTES` bytes are repaired each in one piece. A longer one is sorted and
cut into blocks over many tasks: a block's least costs between its ends are a small matrix, the matrices
are added up along the conversation, and each block then finds its part of the least way.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F, types as T

from shelfline.llm.common import BLANKS, map_arrow, slices
from shelfline.session import freeze

ROWS, BYTES = 4096, 4 << 20          # of a conversation, or a block of one, in one piece
BROADCAST_IDS = 100_000              # long conversations whose ids are broadcast, at most 256 bytes each
SALTS = 1 << 20
SLICE, ROW_BYTES = 16 << 20, 400     # of conversations worked on at once, counting so many bytes for a row besides its text

# Fixed values of the contract: what edits cost, their letters in ASCII order, and the roles that they give.
DELETE, INSERT, REROLE, TRUNCATED = 2, 5, 1, 5
LETTERS = "\0DIKR"
END, D, I, K, R = range(5)
START, SYSTEM, USER, PAIR = range(4)             # how far the order has come
INTO = np.array([USER, USER, PAIR, USER])        # where an inserted or renamed turn leads
GIVES = ["user", "user", "assistant", "user"]
INITIALS = {"s": 1, "u": 2, "a": 3}
KEEPS = np.array([[-1, SYSTEM, USER, -1], [-1, -1, USER, -1], [-1, -1, -1, PAIR], [-1, -1, USER, -1]])
LEGAL = {"su", "ua", "au"}
FAR = 1 << 50
ACCEPTED = np.array([0, FAR, FAR, 0])

EDITED = [T.StructField(n, T.LongType()) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
PART = T.StructType([T.StructField("block", T.LongType()), *EDITED, T.StructField("audit", T.StringType()),
                     T.StructField("repaired", T.StringType())])
BLOCK = T.StructType([T.StructField("block", T.LongType()), T.StructField("turns", T.ArrayType(T.LongType())),
                      T.StructField("roles", T.ArrayType(T.StringType())), T.StructField("texts", T.ArrayType(T.StringType())),
                      T.StructField("faults", T.ArrayType(T.IntegerType())), T.StructField("keys", T.ArrayType(T.BinaryType()))])
BLANK, DUPLICATE, CUT = 1, 2, 3                  # a row's first fault; 0 for none


# ---------------------------------------------------------------- damage
def damage(conversations: DataFrame) -> DataFrame:
    """Rows with planted faults by a checksum of conversation and turn: `copies` is 0 for a dropped row, 2 for a
    repeated one. Null roles and texts are one space, as null ids and turns are in the checksum."""
    space = F.lit(" ")
    text = lambda c: F.coalesce(F.col(c).cast("string"), space)
    fault = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn")).cast("binary")) % 20
    return conversations.select("conv_id", "turn", F.when(fault == 4, "user").otherwise(text("role")).alias("role"),
                                F.when(fault == 1, "").when(fault == 2, F.translate(text("text"), ".!?", ""))
                                .otherwise(text("text")).alias("text"),
                                F.when(fault == 0, 0).when(fault == 3, 2).otherwise(1).alias("copies"))


# ---------------------------------------------------------------- rows of one conversation
def row_key(role: str, text: str) -> bytes:
    return hashlib.blake2b(f"{len(role)}:{role}{text}".encode(), digest_size=16).digest()


def first_fault(text: str, known: bool) -> int:
    words = text.strip(BLANKS)
    return BLANK if not words else DUPLICATE if known else CUT if words[-1] not in ".!?" else 0


def pair_counts(turns: list, roles: list[str], turn_before, role_before) -> tuple[int, int]:
    """Gaps between turns, and neighbours whose roles do not follow each other, from the row before the
    first on. The gaps between neighbouring turns add up to those of the whole."""
    gaps = illegal = 0
    for turn, role in zip(turns, roles):
        if turn is not None:
            if turn_before is not None and turn > turn_before:
                gaps += turn - turn_before - 1
            turn_before = turn
        illegal += role_before is not None and role_before[:1] + role[:1] not in LEGAL
        role_before = role
    return gaps, illegal


# ---------------------------------------------------------------- least costs and the least way
class Blocks:
    """Runs of rows side by side. Block b has rows at[b] to at[b+1] and one node more than rows; a node has a
    place for each state, so that place 4 n + q is node n in state q."""

    def __init__(self, sizes: list[int], kinds: list[int], faults: list[int]):
        self.sizes = np.array(sizes, np.int64)
        self.at = np.concatenate([[0], np.cumsum(self.sizes)])
        self.first = self.at[:-1] + np.arange(len(sizes))
        self.last = self.first + self.sizes
        self.kinds, faults = np.array(kinds, np.int64), np.array(faults, np.int64)
        self.stays = (faults != BLANK) & (faults != DUPLICATE)
        self.extra = np.where(faults == CUT, TRUNCATED, 0)

    def edits(self, rows: np.ndarray, after: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """What it costs from each state to delete, keep and rename rows, with the costs after them."""
        kept, extra = KEEPS[:, self.kinds[rows]].T, self.extra[rows, None]
        keep = np.where(kept >= 0, np.take_along_axis(after, np.maximum(kept, 0), 1) + extra, FAR)
        rename = after[:, INTO] + REROLE + extra
        stays = self.stays[rows, None]
        return after + DELETE, np.where(stays, keep, FAR), np.where(stays, rename, FAR)

    def costs(self, ends: np.ndarray, closing: np.ndarray) -> np.ndarray:
        """The least cost from every node, given those at the blocks' ends. Only where a conversation ends are
        turns inserted after a block; elsewhere the next block does that."""
        best = np.full((self.at[-1] + len(self.sizes), 4), FAR)
        best[self.last] = np.where(closing[:, None], inserted(ends), ends)
        by_size = np.argsort(-self.sizes, kind="stable")
        for back in range(1, int(self.sizes.max(initial=0)) + 1):
            b = by_size[:np.searchsorted(-self.sizes[by_size], -back, "right")]
            node = self.last[b] - back
            best[node] = inserted(np.minimum.reduce(self.edits(self.at[b + 1] - back, best[node + 1])))
        return best

    def arcs(self, best: np.ndarray, ends: np.ndarray, closing: np.ndarray) -> Arcs:
        """The optimal arcs of all nodes."""
        state, nodes = np.arange(4), len(best)
        is_last = np.zeros(nodes, bool)
        is_last[self.last] = True
        inner = np.flatnonzero(~is_last)
        found = []
        delete, keep, rename = self.edits(np.arange(self.at[-1]), best[inner + 1])
        kept = KEEPS[:, self.kinds].T
        for letter, cost, to in ((D, delete, state), (K, keep, kept), (R, rename, INTO)):
            hit, q = np.nonzero((cost == best[inner]) & (cost < FAR))
            target = np.broadcast_to(to, cost.shape)[hit, q]
            found.append((inner[hit] * 4 + q, letter, (inner[hit] + 1) * 4 + target))
        may = ~is_last
        may[self.last[closing]] = True
        hit, q = np.nonzero((best[:, INTO] + INSERT == best) & may[:, None] & (best < FAR))
        found.append((hit * 4 + q, I, hit * 4 + INTO[q]))
        hit, q = np.nonzero((ends == best[self.last]) & (ends < FAR))
        place = self.last[hit] * 4 + q
        found.append((place, END, place))
        return Arcs(4 * nodes, found)


def inserted(best: np.ndarray) -> np.ndarray:
    """Least costs where turns may be inserted first; after two of them a state comes back."""
    for _ in range(2):
        best = np.minimum(best, best[:, INTO] + INSERT)
    return best


class Arcs:
    """Optimal arcs, ranked by their least audits. An edit's letter fixes the state that it leads to, so the
    arcs of a place differ in their letters; an end leads to itself."""

    def __init__(self, places: int, found: list[tuple]):
        self.source = np.concatenate([s for s, _, _ in found])
        letter = np.concatenate([np.full(len(s), c) for s, c, _ in found])
        self.target = np.concatenate([t for _, _, t in found])
        order = np.lexsort((letter, self.source))
        self.source, self.letter, self.target = self.source[order], letter[order], self.target[order]
        self.starts = np.flatnonzero(np.r_[True, self.source[1:] != self.source[:-1]]) if len(order) else order
        self.group = np.full(places, -1)
        self.group[self.source[self.starts]] = np.arange(len(self.starts))
        self.rank = self.letter
        self.jumps = [self.least()[self.group[self.target]]]
        while len(order) and (self.letter[self.jumps[-1]] != END).any():
            jump = self.jumps[-1]
            self.rank = np.unique(self.rank * (self.rank.max() + 1) + self.rank[jump], return_inverse=True)[1]
            self.jumps.append(jump[jump])

    def least(self) -> np.ndarray:
        """Of each place's arcs, the one of the least rank so far."""
        if not len(self.source):
            return self.source
        sizes = np.diff(np.append(self.starts, len(self.source)))
        low = np.repeat(np.minimum.reduceat(self.rank, self.starts), sizes)
        hits = np.flatnonzero(self.rank == low)
        return hits[np.searchsorted(hits, self.starts)]

    def way(self, start: int) -> np.ndarray:
        """The arcs of the least audit from an arc on, with the end: pointers double the known part."""
        known = np.array([start])
        for jump in self.jumps:
            if self.letter[known[-1]] == END:
                break
            known = np.append(known, jump[known])
        return known[:np.argmax(self.letter[known] == END) + 1]

    def ways(self, places: np.ndarray) -> list[np.ndarray]:
        return [self.way(a) for a in self.least()[self.group[places]]]


def lines_of(way: np.ndarray, arcs: Arcs, roles: list[str], texts: list[str]) -> tuple[str, list[str]]:
    """The audit of a way and the lines of the repaired rows."""
    row, audit, lines = 0, [], []
    for letter, place in zip(arcs.letter[way[:-1]].tolist(), arcs.source[way[:-1]].tolist()):
        audit.append(LETTERS[letter])
        if letter == I:
            lines.append(f"{GIVES[place % 4]}:")
            continue
        if letter != D:
            lines.append(f"{roles[row] if letter == K else GIVES[place % 4]}:{texts[row]}")
        row += 1
    return "".join(audit), lines


def repaired(turns: list[list], roles: list[list[str]], texts: list[list[str]], faults: list[list[int]],
             ends: np.ndarray, closing: np.ndarray, entry: np.ndarray, before: list[tuple]) -> list[tuple]:
    """For each block its counts, cost, audit and repaired lines."""
    blocks = Blocks([len(r) for r in roles], [INITIALS.get(r[:1], 0) for b in roles for r in b], [x for b in faults for x in b])
    best = blocks.costs(ends, closing)
    arcs = blocks.arcs(best, ends, closing)
    starts, out = blocks.first * 4 + entry, []
    for b, way in enumerate(arcs.ways(starts)):
        audit, lines = lines_of(way, arcs, roles[b], texts[b])
        left = ends[b][arcs.source[way[-1]] % 4]
        count = [faults[b].count(x) for x in (BLANK, DUPLICATE, CUT)]
        gaps, illegal = pair_counts(turns[b], roles[b], *before[b])
        out.append((gaps, *count, illegal, int(best.flat[starts[b]] - left), audit, "\n".join(lines) if lines else None))
    return out


# ---------------------------------------------------------------- conversations in one piece
def _whole(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[pa.RecordBatch]:
    for ids, _, given in slices(batches, 1, SLICE):
        rows = [[r for r in conv for _ in range(r["copies"])] for conv in given.to_pylist()]
        roles, texts = [[r["role"] for r in c] for c in rows], [[r["text"] for r in c] for c in rows]
        faults = []
        for pair in zip(roles, texts):
            seen: set[bytes] = set()
            faults.append([])
            for role, text in zip(*pair):
                key = row_key(role, text)
                faults[-1].append(first_fault(text, key in seen))
                seen.add(key)
        n = len(rows)
        made = repaired([[r["turn"] for r in c] for c in rows], roles, texts, faults, np.tile(ACCEPTED, (n, 1)),
                        np.ones(n, bool), np.zeros(n, np.int64), [(None, None)] * n)
        yield _rows(ids, [(0, *m) for m in made], names)


def _rows(ids: pa.Array, made: list[tuple], names: list[str]) -> pa.RecordBatch:
    columns = list(zip(*made))
    arrays = [pa.array(v, pa.int64()) for v in columns[:-2]] + [pa.array(v, pa.string()) for v in columns[-2:]]
    return pa.RecordBatch.from_arrays([ids, *arrays], names=names)


def _in_one_piece(rows: DataFrame) -> DataFrame:
    row = F.struct("turn", "role", F.md5("text").alias("mark"), "text", "copies")
    grouped = rows.groupBy("conv_id").agg(
        F.sum(F.col("copies") * (F.octet_length("text") + ROW_BYTES)).alias("size"),
        F.sort_array(F.collect_list(F.when(F.col("copies") > 0, row))).alias("rows"))
    out = T.StructType([rows.schema["conv_id"], *PART.fields])
    return map_arrow(grouped, lambda batches: _whole(batches, out.names), out)


# ---------------------------------------------------------------- longer conversations
def _blocks(rows: DataFrame) -> DataFrame:
    """Rows in order over all tasks, cut into blocks; a block's number has its place in the order.

    Of the rows of one role and text that a task has of a conversation, the first is marked as no copy.
    """
    kind = rows.schema["conv_id"]
    out = T.StructType([kind, *BLOCK.fields])
    order = ["conv_id", F.col("turn").asc_nulls_first(), "role", F.md5("text"), "salt"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = (TaskContext.get().partitionId() << 32) + 1
        held: list[tuple] = []
        size, seen, of = 0, set(), None

        def block() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([of.as_py()], of.type), pa.array([number], pa.int64()),
                 *(pa.array([list(v)], t) for v, t in zip(zip(*held), (
                     pa.list_(pa.int64()), pa.list_(pa.string()), pa.list_(pa.string()), pa.list_(pa.int32()),
                     pa.list_(pa.binary()))))], names=out.names)

        for batch in batches:
            ids = batch.column(0)
            for k, (turn, role, text, copies) in enumerate(zip(*(batch.column(c).to_pylist() for c in range(1, 5)))):
                other = of is None or not ids[k].equals(of)
                if held and (other or len(held) >= ROWS or size >= BYTES):
                    yield block()
                    number, held, size = number + 1, [], 0
                if other:
                    of, seen = ids[k], set()
                key = row_key(role, text)
                for _ in range(copies):
                    held.append((turn, role, text, first_fault(text, key in seen), key))
                    size += len(text)
                    seen.add(key)
        if held:
            yield block()

    sent = (rows.where("copies > 0").withColumn("salt", F.monotonically_increasing_id() % SALTS)
            .repartitionByRange(*order).sortWithinPartitions(*order))
    return map_arrow(sent.select("conv_id", "turn", "role", "text", "copies"), run, out)


def _with_copies(blocks: DataFrame) -> DataFrame:
    """Marks rows of a role and text that an earlier task's part of the conversation has; a row is looked
    up once for each task that has it, not once for each time."""
    firsts = blocks.select("conv_id", "block", F.shiftright("block", 32).alias("part"),
                           F.posexplode(F.arrays_zip("faults", "keys")).alias("place", "row")).where(f"row.faults not in ({BLANK}, {DUPLICATE})")
    later = (firsts.groupBy("conv_id", "row.keys").agg(F.min("part").alias("part"), F.count(F.lit(1)).alias("times"))
             .where("times > 1").alias("e").join(firsts.alias("f"), F.expr(
                 "e.conv_id <=> f.conv_id and e.keys = f.row.keys and f.part > e.part"))
             .groupBy("f.block").agg(F.collect_set("f.place").alias("copies")))
    fault = lambda x, k: F.when(F.array_contains("copies", k), DUPLICATE).otherwise(x)
    return (blocks.join(later, "block", "left")
            .withColumn("faults", F.when(F.col("copies").isNull(), F.col("faults")).otherwise(F.transform("faults", fault)))
            .select("conv_id", "block", "turns", "roles", "texts", "faults"))


def _initials(batch: pa.RecordBatch, column: int) -> list[list[int]]:
    return [[INITIALS.get(r, 0) for r in block] for block in batch.column(column).to_pylist()]


def _per_block(frame: DataFrame, added: str, rows: Callable[[pa.RecordBatch], list[list]]) -> DataFrame:
    """Columns made from a batch of blocks, beside its first two."""
    out = T.StructType([*frame.schema.fields[:2], *T._parse_datatype_string(added).fields])
    from pyspark.sql.pandas.types import to_arrow_schema
    types = to_arrow_schema(out).types

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 16):     # at most 16 blocks in Python at once
                part = batch.slice(k, 16)
                made = rows(part)
                yield pa.RecordBatch.from_arrays([*part.columns[:2], *(pa.array(v, t) for v, t in zip(made, types[2:]))], names=out.names)

    return map_arrow(frame, run, out)


def _along(frame: DataFrame, added: str, start: Callable[[], tuple], step: Callable, ascending: bool) -> DataFrame:
    """Adds columns that depend on the blocks before or after, in one pass over each conversation's blocks. A
    block is a small row here; a task holds one of them at a time.

    `step` takes what was carried and a row's other columns, and returns what is carried on and the new columns.
    """
    out = T.StructType([*frame.schema.fields[:2], *T._parse_datatype_string(added).fields])
    from pyspark.sql.pandas.types import to_arrow_schema
    types = to_arrow_schema(out).types

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = carried = None
        for batch in batches:
            made = []
            ids, rest = batch.column(0), zip(*(c.to_pylist() for c in batch.columns[2:]))
            for k, row in enumerate(rest):
                if of is None or not ids[k].equals(of):
                    of, carried = ids[k], start()
                carried, values = step(carried, *row)
                made.append(values)
            if made:
                yield pa.RecordBatch.from_arrays([*batch.columns[:2], *(pa.array(v, t) for v, t in zip(zip(*made), types[2:]))], names=out.names)

    by = [F.col("conv_id"), F.col("block") if ascending else F.col("block").desc()]
    return map_arrow(frame.repartition("conv_id").sortWithinPartitions(*by), run, out)


def _in_blocks(rows: DataFrame) -> DataFrame:
    blocks = freeze(_with_copies(freeze(_blocks(rows), "blocks")), "blocks")
    codes = blocks.select("conv_id", "block", F.transform("roles", lambda r: F.substr(r, F.lit(1), F.lit(1))).alias("roles"),
                          "faults", F.try_element_at(F.filter("turns", lambda t: t.isNotNull()), F.lit(-1)).alias("turn"))

    def matrices(batch: pa.RecordBatch) -> list[list]:
        kinds, faults = _initials(batch, 2), batch.column(3).to_pylist()
        run = Blocks([len(k) for k in kinds], [x for b in kinds for x in b], [x for b in faults for x in b])
        open_ = np.zeros(len(kinds), bool)
        unit = np.where(np.eye(4, dtype=bool), 0, FAR)
        costs = np.stack([run.costs(np.tile(u, (len(kinds), 1)), open_)[run.first] for u in unit], 2)
        return [costs.reshape(-1, 16).tolist()]

    def backward(after, matrix):
        ends = ACCEPTED if after is None else after
        known = inserted(ends[None])[0] if after is None else ends
        return np.minimum.reduce(np.array(matrix).reshape(4, 4) + known, axis=1), (ends.tolist(), after is None)

    ends = freeze(_along(_per_block(codes, "matrix array<bigint>", matrices), "ends array<bigint>, closing boolean",
                         lambda: None, backward, ascending=False), "ends")

    def exits(batch: pa.RecordBatch) -> list[list]:
        kinds, faults = _initials(batch, 2), batch.column(3).to_pylist()
        turns, at_end, closing = batch.column(4).to_pylist(), np.array(batch.column(5).to_pylist()), np.array(batch.column(6).to_pylist())
        run = Blocks([len(k) for k in kinds], [x for b in kinds for x in b], [x for b in faults for x in b])
        arcs = run.arcs(run.costs(at_end, closing), at_end, closing)
        places = (run.first[:, None] * 4 + np.arange(4)).ravel()
        states = [int(arcs.source[w[-1]] % 4) for w in arcs.ways(places)]
        initials = [r[-1] for r in batch.column(2).to_pylist()]
        return [[states[k:k + 4] for k in range(0, len(states), 4)], turns, initials]

    def forward(carried, out, turn, initial):
        entry, turn_before, role_before = carried
        kept = turn_before if turn is None else turn
        return (out[entry], kept, initial), (entry, turn_before, role_before)

    planned = codes.join(ends.drop("conv_id"), "block")
    leaves = _per_block(planned.select("conv_id", "block", "roles", "faults", "turn", "ends", "closing"),
                        "exits array<bigint>, turn bigint, initial string", exits)
    entries = freeze(_along(leaves, "entry bigint, turn_before bigint, role_before string",
                            lambda: (START, None, None), forward, ascending=True), "entries")

    def edited(batch: pa.RecordBatch) -> list[list]:
        turns, roles, texts, faults, at_end, closing, entry, turn_before, role_before = (c.to_pylist() for c in batch.columns[2:])
        made = repaired(turns, roles, texts, faults, np.array(at_end), np.array(closing), np.array(entry),
                        list(zip(turn_before, role_before)))
        return list(zip(*made))

    full = blocks.join(ends.drop("conv_id"), "block").join(entries.drop("conv_id"), "block")
    done = _per_block(full.select("conv_id", "block", "turns", "roles", "texts", "faults", "ends", "closing", "entry",
                                  "turn_before", "role_before"),
                      ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in PART.fields[1:]), edited)
    return done.select("conv_id", *PART.names)


# ---------------------------------------------------------------- the operator
def repair(rows: DataFrame) -> DataFrame:
    """Repaired conversations in blocks: conv_id, block, counts, cost and audit of its edits, repaired lines.

    `rows` has conv_id, turn, role, text and copies, roles and texts not null (`damage` gives that). A conversation's rows are
    in order of turn, nulls first; rows of one turn by role and the text's MD5, which only serves to have
    an order. A conversation of up to `ROWS` rows and `BYTES` bytes is one block, with number 0; one without rows is a block with
    empty audit; blocks of a longer one have rising numbers, and their counts, costs and audits add up. `repaired` has
    `role:text` lines joined by newlines, null if no line is left. Null ids are one conversation. Other columns are not read.
    """
    whole, long = repair_apart(rows)
    return whole if long is None else whole.unionByName(long)


def repair_apart(rows: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """The same as two frames: conversations in one block, and blocks of longer ones if there are any."""
    rows = rows.select("conv_id", "turn", "role", "text", "copies")
    size = F.sum(F.col("copies") * F.octet_length("text"))
    long = freeze(rows.groupBy("conv_id").agg(F.sum("copies").alias("n"), size.alias("bytes"))
                  .where(f"n > {ROWS} or bytes > {BYTES}").select(F.col("conv_id").alias("long_id")), "long")
    number, widest = long.agg(F.count(F.lit(1)), F.max(F.octet_length(F.col("long_id").cast("string")))).first()
    if not number:
        return _in_one_piece(rows), None
    ids = F.broadcast(long) if number <= BROADCAST_IDS and (widest or 0) <= 256 else long
    same: Column = rows["conv_id"].eqNullSafe(ids["long_id"])
    return _in_one_piece(rows.join(ids, same, "left_anti")), _in_blocks(rows.join(ids, same, "left_semi"))


def summaries(whole: DataFrame, long: DataFrame | None) -> DataFrame:
    """One row per conversation of `repair_apart`: the sums of its blocks, its audit, and the digest of its repaired lines.

    A conversation in one block is digested where it is. Of a longer one, the blocks pass through one task
    in order, one at a time: a digest has to see all lines in order, and the audit is one value.
    """
    counts = [f.name for f in EDITED]
    single = whole.select(
        "conv_id", *counts, "audit", F.sha2(F.coalesce("repaired", F.lit("")), 256).alias("repaired_sha256"))
    if long is None:
        return single
    out = single.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, held = None, None

        def row() -> pa.RecordBatch:
            sums, audit, digest, _ = held
            return pa.RecordBatch.from_arrays(
                [pa.array([of.as_py()], of.type), *(pa.array([s], pa.int64()) for s in sums),
                 pa.array(["".join(audit)]), pa.array([digest.hexdigest()])], names=out.names)

        for batch in batches:
            ids = batch.column(0)
            for k in range(batch.num_rows):
                *sums, audit, lines = (c[k].as_py() for c in batch.columns[1:])
                if of is None or not ids[k].equals(of):
                    if of is not None:
                        yield row()
                    of, held = ids[k], ([0] * len(counts), [], hashlib.sha256(), [False])
                held[0][:] = [a + b for a, b in zip(held[0], sums)]
                held[1].append(audit)
                if lines is not None:
                    held[2].update((("\n" if held[3][0] else "") + lines).encode())
                    held[3][0] = True
        if of is not None:
            yield row()

    parts = long.repartition("conv_id").sortWithinPartitions("conv_id", "block")
    return single.unionByName(map_arrow(parts.select("conv_id", *counts, "audit", "repaired"), run, out))

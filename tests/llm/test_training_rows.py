"""Conversation repair, fill-in-middle and packing against plain Python."""

import random
import zlib
from collections import defaultdict

import brute
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from shelfline.llm import conversation_repair, fill_in_middle, packing
from shelfline.llm.queries import QUERIES

JSON = public_tokenizers.path("byte_bpe_50k.json")
DIR = "/root/testdata/sf0.001"
CONVERSATIONS = "conv_id long, turn long, role string, text string, id long, block string, copies string, rows string"
COUNTS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]


def conversations(seed, n, longest):
    """Conversations of few roles and texts, so that copies, ties, gaps, nulls and blanks are frequent."""
    rng, rows = random.Random(seed), []
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", None, "unit"]
    texts = ["Yes.", "No!", "Why? ", "cut off", "", " \n", None, "a. b", "Ok.\t", *(f"Text {k}." for k in range(30))]
    for conv in range(n):
        turn = rng.choice([0, 0, 5, -2])
        for _ in range(rng.randrange(longest + 1)):
            rows.append((None if conv == 3 else conv, None if rng.random() < 0.05 else turn, rng.choice(roles), rng.choice(texts)))
            turn += rng.choice([1, 1, 1, 0, 3])
    return rows


def plain_repairs(rows):
    by_conv = {conv: [] for conv, *_ in rows}
    for conv, *row in brute.damaged(rows):
        by_conv[conv].append(row)
    return {(conv, *found[:7], brute.sha(found[7])) for conv, found in ((c, brute.conversation(r)) for c, r in by_conv.items())}


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "b", "c", "r") for r in rows], CONVERSATIONS).repartition(3)


def repairs(spark, rows):
    parts = conversation_repair.repair_apart(conversation_repair.damage(frame(spark, rows)))
    return {tuple(r) for r in conversation_repair.summaries(*parts).select(*COUNTS, "repaired_sha256").collect()}


# ---------------------------------------------------------------- 11 conversation repair
def test_conversations(spark):
    rows = conversations(1, 300, 12)
    assert repairs(spark, rows) == plain_repairs(rows)
    assert repairs(spark, []) == set()


def test_long_conversations(spark, monkeypatch):
    """The same results when nearly all conversations are cut into blocks over several tasks."""
    monkeypatch.setattr(conversation_repair, "ROWS", 7)
    rows = conversations(2, 30, 20) + [(100, *r[1:]) for r in conversations(3, 60, 12)]
    assert repairs(spark, rows) == plain_repairs(rows)
    monkeypatch.setattr(conversation_repair, "BROADCAST_IDS", 0)
    monkeypatch.setattr(conversation_repair, "BYTES", 40)
    assert repairs(spark, rows) == plain_repairs(rows)


def test_one_conversation_of_many_equal_rows(spark, monkeypatch):
    monkeypatch.setattr(conversation_repair, "ROWS", 50)
    rows = [(1, None, "user", "Hello.")] * 700 + [(1, 2, "assistant", "Yes.")] * 300
    assert repairs(spark, rows) == plain_repairs(rows)


def test_repaired_lines(spark):
    rows = spark.createDataFrame([(1, 0, "user", "Hi.", 1), (1, 1, "user", "Hi.", 1), (2, 0, "assistant", "Cut", 1)],
                                 "conv_id long, turn long, role string, text string, copies int")
    found = {r.conv_id: (r.audit, r.repaired, r.cost) for r in conversation_repair.repair(rows).collect()}
    assert found == {1: ("DD", None, 4), 2: ("D", None, 2)}


def test_arcs_choose_the_least_audit():
    """Where keeping with an insert costs as much as other ways, letters decide from the left."""
    rng = random.Random(5)
    for _ in range(200):
        rows = [(k, rng.choice(["user", "assistant", "system"]), f"t{k}" + rng.choice([".", ".", ""])) for k in range(rng.randrange(9))]
        plain = brute.conversation(rows)
        faults = [3 if t[-1] != "." else 0 for _, _, t in rows]
        made = conversation_repair.repaired(
            [[t for t, _, _ in rows]], [[r for _, r, _ in rows]], [[x for _, _, x in rows]], [faults],
            conversation_repair.ACCEPTED[None], np.ones(1, bool), np.zeros(1, np.int64), [(None, None)])
        assert made[0][:7] == plain[:7] and (made[0][7] or "") == plain[7]


# ---------------------------------------------------------------- 12 fill in middle
def test_fill_in_middle(spark, docs, rows, empty, unnamed):
    made = fill_in_middle.fill_in_middle(docs)
    found = made.withColumn("back", fill_in_middle.restored(F.col("output"), F.col("form"))).collect()
    assert sorted((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in found if r.doc_id != 8) == sorted(
        (i, *brute.middle(i, t)) for i, t in rows if i != 8)
    texts = defaultdict(list)
    for i, t in rows:
        texts[i].append(t or "")
    assert all(r.back in texts[r.doc_id] for r in found) and len(found) == len(rows)
    assert fill_in_middle.fill_in_middle(empty).count() == 0 and fill_in_middle.fill_in_middle(unnamed).count() == 4


def test_sentinels_and_cuts(spark):
    texts = ["a <P> b", "<S>", "<", "<P", "x <", "> y", " lead and trail  ", "\n", "ß é x", "S> <P", "a <P b S> <M"] * 12
    given = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    made = fill_in_middle.fill_in_middle(given, rates=fill_in_middle.Rates(rearranged=100, suffix_first=50))
    found = made.withColumn("back", fill_in_middle.restored(F.col("output"), F.col("form"))).collect()
    assert all(r.back == texts[r.doc_id] for r in found)
    assert {r.form for r in found} == {"plain", "psm", "spm"} and all((r.form == "plain") == ("<P>" in texts[r.doc_id] or "<S>" in texts[r.doc_id]) for r in found)


def test_units_of_very_long_texts(monkeypatch):
    text = " ab  c\n\n" * 300_000 + "   "
    assert len(text) > 2 * fill_in_middle.MATCHED
    ends = fill_in_middle.unit_ends(text)
    assert len(ends) == 600_001 and ends[:3] == [3, 6, 11] and ends[-1] == len(text)


# ---------------------------------------------------------------- 13 packing
def check_packing(pieces, texts, size=1024):
    """Every id of every document in one piece, sequences without holes, and no padding."""
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(JSON)
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append((p.start, p.length, p.ids_crc32, p.doc_tokens))
        by_sequence[p.sequence_id].append((p.offset, p.length))
    for doc, text in texts.items():
        ids = np.array(library.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        place = 0
        for start, length, crc, total in sorted(by_doc[doc]):
            assert start == place and length > 0 and total == len(ids)
            assert zlib.crc32(ids[start:start + length].tobytes()) == crc
            place += length
        assert place == len(ids)
    for parts in by_sequence.values():
        place = 0
        for offset, length in sorted(parts):
            assert offset == place
            place += length
        assert place == size or place < size and place & (place - 1) == 0


def test_packing(spark, docs, rows, empty, unnamed):
    texts = {k: t for k, (_, t) in enumerate(rows)}
    texts |= {100: "日本語 テキスト " * 400, 101: "a<|endoftext|>b", 102: "don't  I'LL \x85  x"}
    given = spark.createDataFrame([(t, i, 1) for i, t in texts.items()], "text string, doc_id long, start int").repartition(3)
    check_packing(packing.pack(given, JSON).collect(), texts)
    check_packing(packing.pack(given, JSON, size=64).collect(), texts, 64)
    assert packing.pack(empty, JSON).count() == 0
    assert packing.pack(unnamed, JSON).agg(F.sum("length")).first()[0] > 0
    assert packing.pack(docs, JSON).agg(F.countDistinct("doc_id")).first()[0] == len({i for i, _ in rows})


def test_packing_of_the_query(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{DIR}/documents.parquet").collect()}
    check_packing(QUERIES["op13_packing"](spark, DIR).collect(), texts)


def test_stretches_of_long_texts(monkeypatch):
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(JSON)
    monkeypatch.setattr(packing, "CUT", packing.regex.compile(packing.CUT.pattern.replace(str(packing.STRETCH), "40")))
    for text in ("ab  cd\n\n x,y. z" * 50, "日本語。 x\n" * 60, "\x1c \x85 a　 b c" * 60, "<|endoftext|> a" * 40, "nospace" * 100):
        assert len(list(packing.stretches(JSON, text))) > 1 or "nospace" in text
        assert packing.token_ids(JSON, text) == packing.packed(library.encode(text, add_special_tokens=False).ids)


def test_pieces_are_coded_as_the_tokenizer_does(tmp_path):
    """By ranks where ids rise in the order of merges, else by the tokenizer's own model."""
    import json
    own = packing.tokenizer(JSON).model
    rng = random.Random(2)
    plain = lambda b: [t.id for t in own.tokenize(b.decode("latin-1").translate(packing.BYTES))]
    pieces = [bytes(rng.randrange(256) for _ in range(rng.randrange(1, 9))) for _ in range(2000)]
    pieces += [w.encode() for w in (" the", "antidisestablishment", "naïveté", " ßß", "\u3000日本", "a" * 300, "ab" * 200)]
    by_ranks = packing.piece_coder(JSON)
    assert [by_ranks(b) for b in pieces] == [plain(b) for b in pieces] and "encode_single_piece" in repr(by_ranks)
    made = json.load(open(JSON))
    made["model"]["merges"].reverse()
    (tmp_path / "t.json").write_text(json.dumps(made))
    assert "encode_single_piece" not in repr(packing.piece_coder(str(tmp_path / "t.json")))


@pytest.mark.parametrize("most_open", [20, 1 << 14])
@pytest.mark.parametrize("lengths", [lambda r: r.randint(1, 1024), lambda r: 600, lambda r: r.choice([1, 500, 524, 1023])])
def test_windows(lengths, most_open):
    rng = random.Random(3)
    windows, out, total = packing.Windows(1024, 0, most_open), [], 0
    for doc in range(1500):
        n = lengths(rng)
        out += windows.take(doc, 0, bytes(4 * n), n)
        total += n
        assert windows.open <= most_open and windows.open == windows.counts.sum()
    out += windows.finish()
    by_sequence = defaultdict(int)
    for _, _, length, _, _, sequence, _ in out:
        by_sequence[sequence] += length
    assert sum(by_sequence.values()) == total
    assert sum(n < 1024 for n in by_sequence.values()) <= 10 and all(n == 1024 or n & (n - 1) == 0 for n in by_sequence.values())


def test_level_of_least_sum_of_squares():
    windows = packing.Windows(16, 0)
    rng = random.Random(9)
    for _ in range(400):
        windows.counts[1:16] = [rng.choice([0, 0, 1, 2, 5]) for _ in range(15)]
        length = rng.randint(1, 15)

        def squares(level):
            c = windows.counts.copy()
            c[level] -= level > 0
            c[level + length] += level + length < 16
            return int((c ** 2).sum())

        options = [0] + [v for v in range(1, 17 - length) if windows.counts[v]]
        assert squares(windows.level_for(length)) == min(map(squares, options))

"""What workers keep from text to text."""

from __future__ import annotations

import re
from pathlib import Path
from types import SimpleNamespace

import public_tokenizers
import pyarrow as pa
import xxhash
from pyspark.sql import types as T

from shelfline.llm import byte_bpe, common, near_dedup, substring_dedup, toxicity

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def test_a_full_cache_of_pre_tokens_keeps_those_met_last(monkeypatch):
    monkeypatch.setattr(byte_bpe, "CACHE", 64)
    coder = byte_bpe.Coder(RANKS, public_tokenizers.PATTERN)
    asked, plain = [], coder.encode_words
    monkeypatch.setattr(coder, "encode_words", lambda words: asked.extend(words) or plain(words))
    texts = [" common" + "".join(f" q{k}x{j}" for j in "abcdefgh") for k in range(40)]
    coded = [coder.encode([t])[0] for t in texts]
    assert asked.count(b" common") == 1
    assert len(coder.known) + len(coder.older) <= 64
    assert [c[1].decode() for c in coded] == texts


def test_a_text_without_digits_and_signs_is_not_searched_for_disguises(monkeypatch):
    find = toxicity.Finder(toxicity.Trie({"idiot": 2.0}, {}))
    plain, searched = toxicity.disguises, []
    monkeypatch.setattr(toxicity, "disguises", lambda text: searched.append(text) or plain(text))
    assert [h[:2] for h in toxicity.hits("You are (as they say) an idiot, it's so. Quite!", find)] == [(2.0, 0)]
    assert searched == []
    for text in ("an id1ot here", "an i.d.i.o.t!", "an i d i o t here", "so (1d10t) #2", "xx,id*ot", "i-d-i-o-t"):
        assert [h[:2] for h in toxicity.hits(text, find)] == [(2.0, 1)] * (text != "so (1d10t) #2"), text


def test_words_are_hashed_without_a_table_of_all_words():
    texts = [" ".join(f"w{k}" for k in range(j, j + 30)) for j in range(3)]
    h, sizes = substring_dedup._flat(texts)
    assert sizes.tolist() == [30] * 3 and h.tolist() == [xxhash.xxh3_64_intdigest(w.encode()) for t in texts for w in t.split()]
    assert common._held.get("word hashes") is None


def test_words_of_paths_have_one_hash_wherever_they_stand():
    words = [w * n for n in (1, 2, 5, 8, 30, 63, 64, 65, 200) for w in ("a", "b", "\0", "é", "日本")] + ["a\0", "ab", "ba", "abcdefgh", "abcdefg"]
    texts = ["", " \t", *words, " ".join(words), "x" * 3 + "\x0b\x0c" + "\n".join(reversed(words)) + " "]
    h, sizes = substring_dedup.flat_words(texts)
    assert sizes.tolist() == [len(t.encode().split()) for t in texts]
    found = {}
    for w, x in zip((w for t in texts for w in t.encode().split()), h.tolist()):
        assert found.setdefault(w, x) == x
    assert len(set(found.values())) == len(found)
    assert substring_dedup.flat_words([""])[1].tolist() == [0]


def test_spans_have_the_same_hash_wherever_they_start():
    import numpy as np
    h = np.random.default_rng(1).integers(0, 2**64, 50, np.uint64)
    h[30:45] = h[5:20]
    for factor in substring_dedup._FACTOR:
        a, b = (substring_dedup.span_hashes(h, np.array(at), np.array([15, 14, 1]), factor) for at in ([5, 5, 5], [30, 30, 30]))
        assert a.tolist() == b.tolist() and len(set(a.tolist())) == 3
    of, same = np.array([0, 0, 0, 1, 1]), np.array([3, 3, 4, 3, 3], np.uint64)
    assert substring_dedup.repeats(of, same, same).tolist() == [False, True, False, False, True]
    assert substring_dedup.repeats(of, same, np.arange(5, dtype=np.uint64)).tolist() == [False] * 5


def test_windows_of_many_documents_are_hashed_together(monkeypatch):
    """Each document had a batch and a pass of its own."""
    monkeypatch.setattr(substring_dedup, "map_arrow", lambda df, run, out: run)
    docs = type("", (), {"schema": T.StructType([T.StructField("id", T.LongType()), T.StructField("text", T.StringType())])})()
    texts = ["", *(" ".join(f"w{k % 7}" for k in range(j, j + 40)) for j in range(30))]
    opened = [[], *([{"start": 2, "windows": 9}, {"start": 5, "windows": 8}],) * 30]
    batch = pa.RecordBatch.from_arrays([
        pa.array(range(31)), pa.array(texts), pa.array(opened, pa.list_(pa.struct([("start", pa.int32()), ("windows", pa.int32())]))),
        pa.array([0] * 31, pa.int32())], names=["id", "text", "opened", "t"])
    made = list(substring_dedup.edges(docs, 20)(iter([batch])))
    assert len(made) == 1
    rows = made[0].to_pylist()
    assert [(r["id"], r["at"]) for r in rows] == [(k, at) for k in range(1, 31) for at in range(2, 13)]
    assert all(r["again"] == (r["at"] >= 9) for r in rows) and len({(r["e"], r["e2"]) for r in rows}) == 7


def test_near_dedup_lets_go_of_what_a_worker_held_for_another_operator(monkeypatch):
    monkeypatch.setattr(near_dedup, "map_arrow", lambda df, run, out: run)
    docs = SimpleNamespace(schema=T.StructType([T.StructField("id", T.LongType()), T.StructField("text", T.StringType())]))
    batch = pa.RecordBatch.from_pydict({"id": [1], "text": ["a few words"]})
    for run in (near_dedup.fingerprints(docs, 3), near_dedup.shingle_sets(docs, 3)):
        common.only("another operator", dict)
        assert sum(made.num_rows for made in run(iter([batch]))) == 1
        assert not common._held and not hasattr(near_dedup, "_words")


def test_a_worker_gives_back_what_it_held_for_another_operator():
    def resident() -> int:
        return int(re.search(r"VmRSS:\s+(\d+)", Path("/proc/self/status").read_text())[1]) >> 10

    kept = []

    def scattered() -> list[bytearray]:
        made = [bytearray(5_000) for _ in range(60_000)]
        kept.extend(made[::100])     # what stays lies among what goes
        return made

    common.only("an operator", scattered)
    before = resident()
    common.let_go()
    assert before - resident() > 150


def test_a_worker_gives_back_memory_at_the_end_of_a_task(monkeypatch):
    given = []
    monkeypatch.setattr(common, "give_back", lambda: given.append(1))
    monkeypatch.setattr(common, "with_package", lambda spark: None)
    docs = SimpleNamespace(sparkSession=None, mapInArrow=lambda run, schema: run)
    run = common.map_arrow(docs, lambda batches: batches, None)(iter([1, 2]))
    assert next(run) == 1 and not given
    assert list(run) == [2] and given


def test_imports_of_the_driver_are_small():
    """A pattern with a large repeat took 220 MB when it was compiled, in the driver of every query."""
    import re
    import subprocess
    import sys
    from pathlib import Path
    code = "import __spark_entry__; __spark_entry__.queries(); print(open('/proc/self/smaps_rollup').read())"
    said = subprocess.run([sys.executable, "-c", code], cwd=Path(__file__).resolve().parents[2], capture_output=True, text=True, check=True).stdout
    assert sum(map(int, re.findall(r"Pss_Anon:\s+(\d+)", said))) < 180 << 10

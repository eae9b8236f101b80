"""Each operator against plain Python, on rows of every awkward kind."""

import base64

import brute
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from shelfline.llm import (
    byte_bpe, decontamination, language_model, line_dedup, near_dedup, personal_data, quality, substring_dedup,
    token_counts, toxicity,
)

JSON, RANKS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


def got(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


def want(rows):
    return sorted(map(tuple, rows), key=repr)


# ---------------------------------------------------------------- 1 token counts
def test_token_counts(docs, rows, empty, unnamed):
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(JSON)
    plain = [(i, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for i, t in rows]
    assert got(token_counts.token_counts(docs, JSON), "doc_id", "n_bytes", "n_tokens", "over_limit") == want(
        (i, b, n, n > 512) for i, b, n in plain)
    assert token_counts.token_counts(empty, JSON).count() == 0
    assert token_counts.token_counts(unnamed, JSON).count() == 4


def test_token_counts_of_odd_texts():
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(JSON)
    known = token_counts.lengths(JSON, {})
    for text in ("a<|endoftext|>b", "日本語 テキスト", "\U0001f600 x͸y", "a b c", "  \n\n x", "don't I'LL", "\x1c\x85"):
        assert token_counts.count_tokens(JSON, text, known) == len(library.encode(text, add_special_tokens=False).ids)


# ---------------------------------------------------------------- 2 substring dedup
def test_substring_dedup(docs, rows, empty, unnamed):
    plain = brute.substring({i: t for i, t in rows}.items())
    found = got(substring_dedup.substring_dedup(docs), "doc_id", "n_words", "n_removed", "kept")
    assert found == want((i, *plain[i][:2], plain[i][2].encode()) for i, _ in rows)
    assert substring_dedup.substring_dedup(empty).count() == 0
    # Null ids come after all others, so that both lose what row 20 has; a copy among themselves stays.
    assert got(substring_dedup.substring_dedup(unnamed), "doc_id", "n_words", "n_removed") == want(
        [(20, 200, 0), (None, 200, 200), (None, 200, 200), (None, 0, 0)])


def test_substring_windows_inside_one_document(spark):
    words = [f"a{k}" for k in range(30)]
    rows = [(1, " ".join(words + ["b"] + words)), (2, "z " * 100), (3, " ".join(["q"] + words[5:28] + ["r"]))]
    plain = brute.substring(rows)
    found = substring_dedup.substring_dedup(spark.createDataFrame(rows, "doc_id long, text string"))
    assert got(found, "doc_id", "n_words", "n_removed", "kept") == want(
        (i, plain[i][0], plain[i][1], plain[i][2].encode()) for i, _ in rows)
    assert plain[1][1] == 30 and plain[3][1] == 23


def test_substring_rows_of_one_id_with_other_texts(spark):
    """One document by its id: copies between its rows stay; another document loses what any of them has."""
    words = [f"a{k}" for k in range(60)]
    rows = [(7, " ".join(words)), (7, "short"), (7, " ".join(["x", *words[10:40]])), (7, None), (9, " ".join(words[10:40])), (3, "q " * 50)]
    found = substring_dedup.substring_dedup(spark.createDataFrame(rows, "doc_id long, text string"))
    assert got(found, "doc_id", "n_words", "n_removed") == want(
        [(7, 60, 0), (7, 1, 0), (7, 31, 0), (7, 0, 0), (9, 30, 30), (3, 50, 49)])


# ---------------------------------------------------------------- 3 language model
def test_language_model(docs, rows, empty, unnamed):
    found = {(r.doc_id, r.n_tokens): r for r in language_model.language_model_scores(docs).collect()}
    from collections import Counter
    held = language_model.held_out
    texts = [(i, brute.WORD.findall((t or "").translate(brute.LOWER)) + ["\n"]) for i, t in rows]
    counts = Counter(w for i, ws in texts if not held(i) for w in ws)
    total, distinct = sum(counts.values()), len(counts)
    for i, words in texts:
        r = found[i, len(words)]
        assert (r.held_out, r.n_known, r.train_tokens) == (held(i), sum(w in counts for w in words), total)
        base = sum(np.log10((counts[w] + 0.5) / (total + 0.5 * (distinct + 1))) for w in words)
        assert r.base_score == pytest.approx(base, rel=1e-9)
        assert np.isfinite(r.score) and r.score < 0
    assert language_model.language_model_scores(empty).count() == 0
    assert language_model.language_model_scores(unnamed).count() == 4


def test_probabilities_add_up(spark):
    """The corpus's probabilities of known words leave room for words never seen, and no more than 1."""
    rows = [(k, " ".join(f"w{j % (k + 2)}" for j in range(60))) for k in range(12)]
    packed = language_model.freeze(language_model.chunks(spark.createDataFrame(rows, "id long, text string")), "chunks")
    words, _, _ = language_model.fit(packed)
    total = words.where("c > 0").agg(F.sum("open"), F.sum("closed"), F.count("*")).first()
    unknown = words.where("c = 0").agg(F.max("closed")).first()[0]
    assert 0.5 < total[0] < 1 and 0.9 < total[1] < 1
    assert unknown is None or total[1] + unknown == pytest.approx(1)


def test_order_of_words_counts(spark):
    """A held-out text in the order of the training texts is likelier than its words in another order."""
    import random
    rng = random.Random(5)
    phrases = [[f"w{p}x{k}" for k in range(6)] for p in range(30)]
    text = lambda: [w for _ in range(8) for w in rng.choice(phrases)]
    held = [i for i in range(400) if language_model.held_out(i)][:20]
    rows = [(i, " ".join(text())) for i in range(300) if not language_model.held_out(i)]
    for a, b in zip(held[::2], held[1::2]):
        words = text()
        rows += [(a, " ".join(words)), (b, " ".join(rng.sample(words, len(words))))]
    found = {r.doc_id: r for r in language_model.language_model_scores(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for a, b in zip(held[::2], held[1::2]):
        assert found[a].base_score == pytest.approx(found[b].base_score)
        assert found[a].score > found[b].score + 10 and found[a].open_score > found[b].open_score + 10


def test_repeats_in_a_document_open_tables():
    """Repeats open tables by chance, more of them where the base is likelier, and a sweep seats them anew."""
    tokens, sizes = np.array([0] * 5000 + [1, 0, 0, 1], np.uint32), np.array([5001, 3])
    tables = [[int(language_model.seat_texts(tokens, sizes, np.full(5004, p), np.random.default_rng(k))[:5000].sum()) for k in range(3)]
              for p in (1e-9, 0.01, 0.5)]
    assert tables[0] == [1, 1, 1] and 1 < min(tables[1]) <= max(tables[1]) < min(tables[2]) < 5000
    assert len(set(tables[2])) > 1
    assert language_model.seat_texts(tokens, sizes, np.full(5004, 1e-9), np.random.default_rng(0)).sum() == 4


def test_multiplicity_reaches_the_corpus(spark):
    """A word used often in one document outweighs a word used once in one."""
    learned = [i for i in range(100) if not language_model.held_out(i)][:20]
    rows = [(i, " ".join(f"w{i}x{k}" for k in range(50)) + (" often x y" * 2000 + " once" if i == learned[0] else "")) for i in learned]
    packed = language_model.freeze(language_model.chunks(spark.createDataFrame(rows, "id long, text string")), "chunks")
    found = {r.word: r.open for r in language_model.fit(packed)[0].where("word in ('often', 'once')").collect()}
    assert found["often"] > 1.5 * found["once"]


def test_pairs_are_kept_packed(spark, monkeypatch):
    """No stored table has a row for each pair of words."""
    import random
    rng, kept = random.Random(3), {}
    freeze = language_model.freeze

    def counted(df, name):
        kept.setdefault(name, []).append((out := freeze(df, name)).count())
        return out

    monkeypatch.setattr(language_model, "freeze", counted)
    rows = [(i, " ".join(f"w{rng.randrange(300)}" for _ in range(200))) for i in range(60)]
    found = language_model.language_model_scores(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(found) == 60 and all(np.isfinite(r.score) for r in found)
    assert max(max(n) for name, n in kept.items() if not name.startswith(("letters", "spelling"))) < 200


def test_pairs_meet_in_one_group():
    """Chunks deal a pair to the same group, each pair once, also those after a word that takes many groups."""
    numbers, seen = np.arange(50) * 7, np.where(np.arange(50) < 2, 40 * language_model.PAIRS_OF, 3)
    rng, groups, ways = np.random.default_rng(1), {}, {}
    for id_ in range(4):
        some = np.sort(rng.choice(50, 30, replace=False))
        some[:2] = 0, 1
        row = {"chunk": id_, "ids": [0, 1], "held": [False, True], "sizes": [400, 100], "tokens": language_model.pack(rng.integers(0, 30, 500), np.uint32),
               "numbers": language_model.pack_rising(numbers[np.unique(some)]), "seen": language_model.pack(seen[np.unique(some)], np.int64)}
        row["tokens"] = language_model.pack(language_model.unpacked(row["tokens"], np.uint32) % len(np.unique(some)), np.uint32)
        chunk = language_model.Chunk(row, 16)
        assert sorted(chunk.order) == list(range(len(chunk.word)))
        for g, start, end in chunk.dealt:
            for b, x in zip(chunk.b[chunk.order[start:end]], chunk.x[chunk.order[start:end]]):
                assert groups.setdefault((b, x), g) == g
                ways.setdefault(b, set()).add(g)
    assert len(ways[0]) > 3 and len(ways[language_model.START]) > 1 and all(len(g) == 1 for b, g in ways.items() if b > 7)


def test_sequence_probabilities():
    """Given any beginning, the next tokens of a document have probabilities that add up to the corpus's."""
    corpus = np.array([0.5, 0.3, 0.2])
    start = [0, 0, 1]
    total = 0.0
    for k in range(3):
        tokens = np.array([*start, k], np.uint32)
        total += 10 ** language_model.in_sequence(tokens, np.array([4]), (corpus[tokens], np.ones(4, bool)))[0][-1]
    assert total == pytest.approx(1)


def test_seating_grows_as_the_process_does():
    rng = np.random.default_rng(0)
    n = np.array([0, 1, 2, 1000, 100_000])
    tables = language_model.seat(n, np.full(5, 50.0), np.full(5, 0.2), 0.5, rng)
    assert tables[0] == 0 and tables[1] == 1 and (tables <= n).all() and 30 < tables[3] < tables[4] < 1000


def test_packed_columns_are_narrow():
    """Packed numbers take the bytes that the largest needs, and come back as they were."""
    import zstandard
    for values in ([0, 1, 255], [0, 256], [70_000], [1 << 40], [-1, 5], []):
        for kind in (np.int64, np.float64):
            assert language_model.unpacked(language_model.pack(np.array(values, kind), kind), kind).tolist() == values
    assert len(zstandard.decompress(language_model.pack(np.full(1000, 3), np.int64))) < 1100
    assert len(zstandard.decompress(language_model.pack_rising(np.arange(1000) * 200))) < 1100


def test_tokens_of_chunks():
    """Blanks are those of the contract; words are in order of hash, also two of one hash."""
    texts = ["", " a\x0bB\x0cc\td\n\re\x1cf\x85g\u2028h  i ", "plumless buckeroo É é", "\n\n"]
    words, tokens, sizes = language_model.tokenized(texts)
    found = [words[k] for k in tokens]
    want_words = [w.encode() for t in texts for w in [*brute.WORD.findall(t.translate(brute.LOWER)), ""]]
    assert found == want_words and sizes.tolist() == [1, 7, 5, 1]
    assert language_model.crc32(b"plumless") == language_model.crc32(b"buckeroo")
    assert words == sorted(set(found), key=lambda w: (language_model.crc32(w), w))


def test_letters_of_words():
    """Every letter of a word with the letters before it, three at most."""
    words = ["a", "abcab", "zażółć", "\U0001F600b", "\n", "aaaaaa"]
    u, x, letters, sizes = language_model.spelled(words)
    want_letters = []
    for w in words:
        padded = "\t" + w + "\n"
        want_letters += [(padded[max(0, k - 3):k], padded[k]) for k in range(1, len(padded))]
    assert [(u[k], x[k]) for k in letters] == want_letters and len(set(zip(u, x))) == len(u)
    assert sizes.tolist() == [len(w) + 1 for w in words]


def test_tables_go_when_read(spark, monkeypatch):
    """When texts are scored, only chunks, the words' averages and a table of seats for each sample are left."""
    freeze, discard, kept = language_model.freeze, language_model.discard, {}

    def made(df, name):
        out = freeze(df, name)
        kept[out._frozen_at] = name
        return out

    def gone(*frames):
        for df in frames:
            kept.pop(getattr(df, "_frozen_at", None), None)
        discard(*frames)

    monkeypatch.setattr(language_model, "freeze", made)
    monkeypatch.setattr(language_model, "discard", gone)
    found = language_model.language_model_scores(spark.createDataFrame([(k, f"a b {k} a") for k in range(9)], "doc_id long, text string"))
    assert found.count() == 9
    assert sorted(kept.values()) == ["averaged", "located", *["seats"] * language_model.SAMPLES]


# ---------------------------------------------------------------- 4 decontamination
def test_decontamination(docs, rows, empty, unnamed, benchmark):
    found = decontamination.decontaminate(docs, benchmark)
    items = [(r.item_id, r.text) for r in benchmark.collect()]
    assert got(found, "doc_id", "n_words", "n_hit", "items", "contaminated") == want(brute.contamination(rows, items))
    assert decontamination.decontaminate(empty, benchmark).count() == 0
    assert decontamination.decontaminate(unnamed, benchmark).count() == 4
    none = decontamination.decontaminate(docs, benchmark.where("false"))
    assert none.count() == docs.count() and none.where("n_hit > 0").isEmpty()


def test_decontamination_beyond_the_broadcast_limit(docs, rows, benchmark, monkeypatch):
    monkeypatch.setattr(decontamination, "BROADCAST_WINDOWS", 0)
    test_decontamination(docs, rows, docs.where("false"), docs.limit(4), benchmark)


def test_spans_can_be_removed(docs, benchmark):
    cut = decontamination.without_spans(decontamination.decontaminate(docs, benchmark))
    again = decontamination.decontaminate(cut.select("doc_id", "text"), benchmark)
    assert cut.where("doc_id = 62").first().text.count(" ") == 899 and again.where("contaminated").isEmpty()


# ---------------------------------------------------------------- 5 toxicity
def test_trie_finds_terms_one_edit_away():
    trie = toxicity.Trie({"stupid": 2.0, "moron": 1.0}, {"vequ": 3.0})
    found = {w: trie.find(w) for w in ("stupid", "stupd", "stuupid", "stopid", "tupid", "stupids", "stpd", "vequabc", "moran", "mo", "")}
    assert found == {"stupid": (2.0, 0), "stupd": (2.0, 1), "stuupid": (2.0, 1), "stopid": (2.0, 1), "tupid": (2.0, 1),
                     "stupids": (2.0, 1), "stpd": None, "vequabc": (3.0, 0), "moran": (1.0, 1), "mo": None, "": None}


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i, *(0 for _ in b)] if (old := row) else []
        for j, y in enumerate(b, 1):
            row[j] = min(old[j] + 1, row[j - 1] + 1, old[j - 1] + (x != y))
    return row[-1]


def test_trie_agrees_with_edit_distance():
    import random
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abc") for _ in range(rng.randrange(5, 8)))
    terms = {word(): 1.0 for _ in range(30)}
    trie = toxicity.Trie(terms, {})
    for _ in range(2000):
        w = word()
        best = min(distance(w, t) for t in terms)
        assert (trie.find(w) or (0, 2))[1] == min(best, 2)


def test_toxicity_held_out(spark):
    from shelfline.llm.queries import op5_toxicity
    d = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{d}/labels.parquet")
    judged = op5_toxicity(spark, d).join(labels, "doc_id").where("held_out").cache()
    hit = judged.where("predicted = 1 and toxic = 1").count()
    assert judged.where("(score >= 0.5) != (predicted = 1) or score < 0 or score > 1").isEmpty()
    assert hit >= 0.85 * judged.where("toxic = 1").count() and hit >= 0.9 * judged.where("predicted = 1").count()


def test_disguised_terms():
    """Digits, signs, spaces and swaps hide no term; short terms need a swap, a doubled letter or a sign."""
    find = toxicity.Finder(toxicity.Trie({"stupid": 2.0, "idiot": 1.0, "moron": 1.0, "scum": 3.0}, {}))
    for text in ("an id1ot here", "you m0r0n!", "so st*pid.", "s t u p i d", "a s.t.u.p.i.d one", "an idoit", "sc*m", "$cum", "scuum",
                 "scmu", "you m*r*n", "stu-pid", "u r s c u m"):
        assert [e for _, e, _, _ in toxicity.hits(text, find)] == [1], text
    for text in ("a scam, a slum", "in 2010 a b c d", "b2b mp3 covid-19 win10", "e.g. it's well-known", "1.5 x 10", "**** ....", "sum scm"):
        assert toxicity.hits(text, find) == [], text
    assert [e for _, e, _, _ in toxicity.hits("stupid-looking idiot", find)] == [0, 0]


def test_learned_terms_are_found_disguised():
    bad = [f"you stupid moron number{chr(97 + k)} go away idiot" for k in range(12)]
    fine = [f"the river walked{chr(97 + k)} through the evening stone" for k in range(12)]
    model = toxicity.fit(bad + fine, [1] * 12 + [0] * 12)
    find = toxicity.Finder(model.trie)
    for text in ("st*pid m0ron 1diot", "s t u p i d and m o r o n", "you idoit, you stupdi mroon"):
        assert toxicity.hits(text, find), text


def test_toxicity_of_odd_rows(spark, docs, empty, unnamed):
    model = toxicity.fit(["you idiot clown"] * 3 + ["fine words here"] * 3, [1] * 3 + [0] * 3)
    assert toxicity.toxicity(docs, model).count() == docs.count()
    assert toxicity.toxicity(empty, model).count() == 0 and toxicity.toxicity(unnamed, model).count() == 4
    for texts, marks in (([], []), (["a"], [0]), (["a", None], [1, 0])):
        r = toxicity.toxicity(docs.where("doc_id = 1"), toxicity.fit(texts, marks)).first()
        assert 0 <= r.score <= 1
    nothing = toxicity.learn(docs, spark.createDataFrame([], "doc_id long, toxic int"))
    assert toxicity.toxicity(docs, nothing).where("predicted = 1").isEmpty()


# ---------------------------------------------------------------- 6 byte-level BPE
def test_byte_bpe(docs, rows, empty, unnamed):
    import tiktoken
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    plain = [(i, np.array(library.encode_ordinary(t or ""), "<u4").tobytes(), (t or "").encode()) for i, t in rows]
    coded = byte_bpe.encode(docs, RANKS, public_tokenizers.PATTERN, keep=["doc_id", "n_words"])
    assert got(coded, "doc_id", "ids", "decoded") == want(plain)
    back = byte_bpe.decode(coded.select("doc_id", "ids"), RANKS, public_tokenizers.PATTERN)
    assert got(back, "doc_id", "decoded") == want((i, d) for i, _, d in plain)
    assert byte_bpe.encode(empty, RANKS, public_tokenizers.PATTERN).count() == 0
    assert byte_bpe.encode(unnamed, RANKS, public_tokenizers.PATTERN).columns == [*unnamed.columns, "ids", "decoded"]


@pytest.mark.parametrize("text", ["a" * 700, "ab" * 400, "xyzzy" * 300 + "q", "日本語" * 200, "\x00\xff" * 50, "=" * 257])
def test_long_words(text):
    import tiktoken
    coder = byte_bpe.coder(RANKS, public_tokenizers.PATTERN)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=coder.ranks, special_tokens={})
    (ids, decoded), = coder.encode([text])
    assert np.frombuffer(ids, "<u4").tolist() == library.encode_ordinary(text) and decoded == text.encode()


# ---------------------------------------------------------------- 7 line dedup
@pytest.mark.parametrize("batches", [1, 4])
def test_line_dedup(docs, rows, empty, unnamed, batches):
    found = line_dedup.line_dedup(docs, batches=batches)
    assert got(found, "doc_id", "n_lines", "n_dropped", "text") == want(brute.lines(rows))
    assert found.columns == [*docs.columns, "n_lines", "n_dropped"]
    assert line_dedup.line_dedup(empty, batches=batches).count() == 0
    assert line_dedup.line_dedup(unnamed, batches=batches).where("n_dropped = 0").count() == 4


def test_lines_beyond_the_broadcast_limit(docs, rows, monkeypatch):
    monkeypatch.setattr(line_dedup, "BROADCAST_KEYS", -1)
    assert got(line_dedup.line_dedup(docs), "doc_id", "n_lines", "n_dropped", "text") == want(brute.lines(rows))


# ---------------------------------------------------------------- 8 personal data
def test_personal_data(docs, rows, empty, unnamed):
    found = personal_data.personal_data(docs)
    base = F.filter("spans", lambda s: s["rank"] < 4)
    assert got(found.select("doc_id", personal_data.listed(base).alias("b")), "doc_id", "b") == want(
        (i, brute.personal(t)) for i, t in rows)
    assert personal_data.personal_data(empty).count() == 0 and personal_data.personal_data(unnamed).count() == 4


def test_checksums_and_context(spark):
    rows = [(1, "transfer to GB82 WEST 1234 5698 7654 32 now"), (2, "transfer to GB82 WEST 1234 5698 7654 33 now"),
            (3, "social security 123-45-6789"), (4, "part 123-45-6789"), (5, "card 4111 1111 1111 1111, example a@b.org")]
    found = {r.doc_id: {s.kind: s.score for s in r.spans}
             for r in personal_data.personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert "iban" in found[1] and "iban" not in found[2]
    assert "identity" in found[3] and "identity" not in found[4]
    assert found[5]["email"] < 0.9 and "card" in found[5]


@pytest.mark.parametrize("number", ["DE89370400440532013000", "DE89 3704 0044 0532 0130 00", "GB82 WEST 1234 5698 7654 32",
                                    "NO93 8601 1117 947", "FR1420041010050500013M02606", "MT84MALT011000012345MTLCAST001S"])
def test_iban_before_other_words(spark, number):
    """A number ends where its country's length does, whatever follows."""
    after = ["Please pay", "BIC COBADEFF", "I said", "12 EUR", "(bank)", "and", "", "NO93 8601 1117 947 A"]
    rows = [(k, f"pay {number} {a}".rstrip()) for k, a in enumerate(after)] + [(99, f"pay {number}X9 now"), (98, f"pay X{number}")]
    found = {r.doc_id: [(s.start, s.stop) for s in r.spans if s.kind == "iban"]
             for r in personal_data.personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all((4, 4 + len(number)) in found[k] for k in range(len(after))) and not found[99] and not found[98]
    assert len(found[7]) == 2


def test_redaction(spark):
    df = spark.createDataFrame([(1, "mail é a@b.org or 10.0.0.1!"), (2, "none")], "doc_id long, text string")
    cut = personal_data.redacted(personal_data.personal_data(df))
    assert got(cut, "doc_id", "text") == [(1, "mail é [email] or [ip]!"), (2, "none")]


# ---------------------------------------------------------------- 9 near duplicates
@pytest.mark.parametrize("shingle, percent", [(3, 85), (5, 80)])
def test_near_duplicates(docs, rows, empty, shingle, percent):
    found = near_dedup.near_duplicates(docs, shingle=shingle, percent=percent)
    assert got(found, "doc_id", "n_shingles", "component_id", "kept") == want(
        (i, n, c, i == c) for i, n, c in brute.near(rows, shingle, percent))
    assert near_dedup.near_duplicates(empty).count() == 0


def test_near_duplicates_with_null_ids(unnamed):
    found = near_dedup.near_duplicates(unnamed)
    assert got(found, "doc_id", "component_id", "kept") == want(
        [(20, 20, True), (None, None, True), (None, None, True), (None, None, True)])


@pytest.mark.parametrize("least, most", [(1, 5), (3, 8)])
def test_a_large_group_of_edits_is_compared_in_blocks(spark, monkeypatch, least, most):
    """Texts that are edits of one text, most of them too far from each other: few pairs become rows."""
    import random
    rng = random.Random(3)
    base = [f"w{k}" for k in range(100)]
    rows = []
    for i in range(240):
        words = list(base)
        for k in rng.sample(range(100), rng.randint(least, most)):
            words[k] = f"x{rng.randrange(400)}"
        rows.append((i, " ".join(words)))
    rows += [(1000 + k, None) for k in range(2)] + [(i, None) for i in (5, 9)]
    tested, confirmed = [], near_dedup.confirmed
    monkeypatch.setattr(near_dedup, "confirmed", lambda pairs, *rest: tested.append(pairs.count()) or confirmed(pairs, *rest))
    monkeypatch.setattr(near_dedup, "BLOCK", 32, raising=False)
    found = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), shingle=3, percent=85)
    wanted = {i: c for i, _, c in brute.near(rows[:240], 3, 85)}
    assert {r.doc_id: r.component_id for r in found.where("n_shingles > 0").collect()} == wanted
    assert sum(tested) <= 8 * len(rows), tested


def test_chains_of_near_duplicates(spark):
    """Neighbours are linked, the ends of the chain are not; a large group with a few far members."""
    import random
    rng = random.Random(5)
    base = [f"w{rng.randrange(900)}" for _ in range(120)]
    rows = [(k, " ".join(base[:2 * k] + [f"new{j}" for j in range(2 * k, 0, -1)] + base[2 * k:])) for k in range(1)]
    for k in range(1, 12):
        rows.append((k, " ".join([f"x{j}" for j in range(3 * k)] + base[3 * k:])))
    for k in range(100, 180):
        own = list(base)
        for _ in range(rng.randrange(6)):
            own[rng.randrange(len(own))] = f"e{rng.randrange(10_000)}"
        rows.append((k, " ".join(["g1", "g2", "g3", *own])))
    found = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), shingle=3, percent=85)
    assert got(found, "doc_id", "n_shingles", "component_id") == want(brute.near(rows, 3, 85))


# ---------------------------------------------------------------- 10 quality rules
def test_quality(docs, rows, empty, unnamed):
    found = quality.quality(docs)
    assert got(found, "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed") == want(
        (i, *brute.quality(t)) for i, t in rows)
    assert found.where("base_failed and kept").isEmpty()
    assert quality.quality(empty).count() == 0 and quality.quality(unnamed).count() == 4


def test_compression_bands():
    import random
    import zstandard
    press, rng = zstandard.ZstdCompressor(level=3), random.Random(1)
    prose = " ".join(rng.choice(["the", "of", "river", "walked", "evening", "through", "letters", "stone"]) + rng.choice("abcde")
                     for _ in range(800)).encode()
    noise = bytes(rng.randrange(256) for _ in range(6000))
    judge = lambda data: quality.verdict(data, quality.Bands(), press)[-1]
    assert judge(prose) is None and judge(b"spam and eggs " * 400) == "repetitive" and judge(noise) == "incompressible"
    assert judge(b"") is None and judge(noise[:100]) is None
    assert b"".join(quality.chunks(noise, 4096)) == noise

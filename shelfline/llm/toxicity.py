"""Toxicity: a lexicon trie met with Levenshtein automata, and scores of the words around each hit.

Training labels give the lexicon: terms and stems (beginnings of words) that occur far more often in
toxic documents than in others. A word of a text is looked up by running a Levenshtein automaton of
the word over the trie, so a misspelled term is found without comparing the word to every term.
What stands around a hit decides how much it counts: quotation marks and words that report speech
speak against abuse. A logistic model weighs the hits into a score.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter, defaultdict
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import regex
from pyspark.sql import DataFrame, functions as F, types as T

from shelfline.llm.common import fold, only, per_row

WORD = regex.compile(r"\p{L}+(?:['’]\p{L}+)*")
QUOTES = frozenset("\"'“”„«»‘’`")
SIGNS = r"*@$!#%&+_.|~\-"
# Runs of letters, digits and signs with one that is no letter; single letters with spaces or signs between.
DISGUISED = regex.compile(rf"(?<![\p{{L}}\p{{N}}{SIGNS}])\p{{L}}*+[\p{{N}}{SIGNS}][\p{{L}}\p{{N}}{SIGNS}]*+")
SPACED = regex.compile(rf"(?<![\p{{L}}\p{{N}}])\p{{L}}(?:[ {SIGNS}]\p{{L}}(?![\p{{L}}\p{{N}}])){{3,}}+")
# In every text that `SPACED` finds something in: two of the letters inside, with what stands around them.
SINGLE = re.compile(rf"[ {SIGNS}][^\n {SIGNS}][ {SIGNS}][^\n {SIGNS}][ {SIGNS}]")
EDGES = "!#%&+_.|~-"       # signs that are no part of a word at its ends
AROUND = EDGES + ",;:?\"'()"   # what is no part of a disguise at the ends of a token
KEPT_UP_TO = 64            # characters of a token that a worker keeps
STANDS_FOR = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "gq",
              "@": "a", "$": "s", "!": "il"}   # other signs stand for any letter
DISGUISE_UP_TO = 40        # characters of a disguised word
TRAINING_ROWS = 8_000   # documented bound: labelled documents the model is fitted on
MAX_TERMS = 5_000        # bound of the lexicon, and so of what is broadcast
STEMS = range(4, 8)      # lengths of the beginnings of words that can be entries
MIN_DOCS = 5             # toxic training documents that a term needs, copies aside
MIN_ENDINGS = 8          # a stem needs more different words than this
MIN_LIFT = 8.0           # times as frequent in toxic documents as in others
FUZZY_FROM = 5           # letters a term must have for one edit to be forgiven
SHORT = 4                # letters of terms that only a swap, a doubled letter or a sign is forgiven
WITHOUT_HITS = -1.0      # most log odds of a text without hits, so that no evidence is no verdict
REACH = 4                # words of context on either side
MIN_CONTEXT = 5          # hits that a context word must have been seen with
CACHE = 1 << 18          # words in a worker's cache, some 40 MB

ADDED = T.StructType([
    T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType()),
    T.StructField("n_hits", T.LongType()), T.StructField("n_misspelled", T.LongType()),
    T.StructField("n_quoted", T.LongType()),
])


class Trie:
    """Entries by letter; an entry is a whole term or a stem that any ending may follow."""

    def __init__(self, terms: dict[str, float], stems: dict[str, float]):
        self.root: dict = {}
        self.ordinary: set[str] = set()   # words near a term that clean texts use: no misspellings
        for entries, mark in ((terms, "="), (stems, "*")):
            for entry, weight in entries.items():
                node = self.root
                for letter in entry:
                    node = node.setdefault(letter, {})
                node[mark] = (weight, len(entry))

    def find(self, word: str) -> tuple[float, int] | None:
        """(weight, edits) of the best entry for a word: least edits, then highest weight."""
        best = self._exact(word)
        return (best, 0) if best is not None else self._near(word)

    def look(self, word: str) -> tuple[float, int] | None:
        """As `find`, and two neighbouring letters swapped are one edit; terms of `SHORT` letters are found
        with a swap behind the first letter or a letter doubled."""
        found = self.find(word)
        if found is not None or not SHORT <= len(word) or word in self.ordinary:
            return found
        best, node = None, self.root
        for k in range(len(word) - 1):
            a, b, end = word[k], word[k + 1], None
            if a == b:
                if len(word) == SHORT + 1:
                    end = _walk(node, word[k + 1:])
            elif b in node and a in node[b] and (k or len(word) >= FUZZY_FROM):
                end = _walk(node[b][a], word[k + 2:])
            if end is not None and (best is None or end[0] > best):
                best = end[0]
            node = node.get(a)
            if node is None:
                break
        return None if best is None else (best, 1)

    def disguised(self, word: str) -> tuple[float, int] | None:
        """The best term for a word with digits and signs: each stands for a letter, or the signs are left
        out. Three letters and half of the word have to be letters."""
        letters = sum(map(str.isalpha, word))
        if word in self.ordinary or letters < 3:
            return None
        ends = []
        if 2 * letters >= len(word) >= SHORT:
            nodes = [self.root]
            for sign in word:
                if sign.isalpha():
                    nodes = [n[sign] for n in nodes if sign in n]
                else:
                    may = STANDS_FOR.get(sign)
                    nodes = [c for n in nodes for x, c in n.items() if x not in "=*" and (may is None or x in may)]
            ends += [n["="] for n in nodes if "=" in n]
        if not any(map(str.isdigit, word)):
            ends.append(_walk(self.root, "".join(filter(str.isalpha, word))))
        found = [weight for weight, length in filter(None, ends) if length >= SHORT]
        return (max(found), 1) if found else None

    def spaced(self, word: str) -> tuple[float, int] | None:
        """The best term among letters that stand alone: a term may have other single letters beside it."""
        letters = "".join(filter(str.isalpha, word))
        if letters in self.ordinary or len(letters) > DISGUISE_UP_TO:
            return None
        ends = [_walk(self.root, letters[i:j]) for i in range(len(letters)) for j in range(i + SHORT, len(letters) + 1)]
        found = [weight for weight, _ in filter(None, ends)]
        return (max(found), 1) if found else self.look(letters)

    def _exact(self, word: str) -> float | None:
        node, best = self.root, None
        for letter in word:
            node = node.get(letter)
            if node is None:
                return best
            if "*" in node and (best is None or node["*"][0] > best):
                best = node["*"][0]
        return node["="][0] if "=" in node else best

    def _near(self, word: str) -> tuple[float, int] | None:
        """Terms one edit away. The Levenshtein automaton of the word, with states (letters read,
        edits made), runs along the trie: its states without an edit are the word's own path; each
        edit leaves that path, and from there on only the rest of the word itself is accepted."""
        if len(word) < FUZZY_FROM or word in self.ordinary:
            return None
        best, node = None, self.root
        for k in range(len(word) + 1):
            here, after = word[k:], word[k + 1:]
            first, second = here[:1] or "=", after[:1] or "="     # what has to follow in the trie
            ends = [_walk(node, after)] if here and second in node else []    # a letter too many
            for letter, child in node.items():
                if letter not in "=*":
                    if first in child:
                        ends.append(_walk(child, here))           # a letter missing
                    if here and second in child and letter != first:
                        ends.append(_walk(child, after))          # another letter
            for weight, length in filter(None, ends):
                if length >= FUZZY_FROM and (best is None or weight > best):
                    best = weight
            node = node.get(here[:1])
            if node is None:
                break
        return None if best is None else (best, 1)


def _walk(node: dict, rest: str) -> tuple[float, int] | None:
    for letter in rest:
        node = node.get(letter)
        if node is None:
            return None
    return node.get("=")


@dataclass
class Model:
    trie: Trie
    context: dict[str, float]   # word -> log odds of abuse against mention, near a hit
    quoted: float               # the same for quotation marks around a hit
    coefficients: list[float]
    bias: float


def is_quoted(text: str, start: int, end: int) -> bool:
    return start > 0 and end < len(text) and text[start - 1] in QUOTES and text[end] in QUOTES


class Finder(dict):
    """What the trie has for a word, or for a disguised one behind a mark; a worker looks each up once, and
    starts anew when full."""

    def __init__(self, trie: Trie):
        self.trie = trie

    def __missing__(self, word: str):
        if len(self) >= CACHE:
            self.clear()
        kind = {"\0": self.trie.disguised, "\1": self.trie.spaced, "\2": self._hides}.get(word[:1])
        found = self[word] = kind(word[1:]) if kind else self.trie.look(word)
        return found

    def _hides(self, token: str) -> bool:
        return any(self.trie.disguised(word) is not None for _, _, word in parts(token))

    def hidden(self, text: str) -> bool:
        """Whether there is any term with digits, signs or spaces in it; or there may be, for those with spaces. A
        disguised word has no blanks in it, and a token of letters only none of its signs."""
        for token in set(text.split()):
            if not token.strip(AROUND).isalpha() and (
                    self["\2" + token] if len(token) <= KEPT_UP_TO else self._hides(token)):
                return True
        return SINGLE.search(text) is not None


def finder(model: Model) -> Finder:
    """One for all tasks of a worker with this model, which it holds."""
    return only(("finder", id(model.trie)), lambda: Finder(model.trie))


def parts(text: str) -> list[tuple[int, int, str]]:
    """(start, end, word) of what may be a term with digits or signs in it."""
    found = []
    for m in DISGUISED.finditer(text):
        word = m[0].strip(EDGES)
        if 3 < len(word) <= DISGUISE_UP_TO and not word.isalpha():
            start = m.start() + len(m[0]) - len(m[0].lstrip(EDGES))
            found.append((start, start + len(word), word))
    return found


def disguises(text: str) -> list[tuple[int, int, str]]:
    """(start, end, marked word) of what may be a term with digits, signs or spaces in it."""
    return [(a, b, "\0" + word) for a, b, word in parts(text)] + [(*m.span(), "\1" + m[0]) for m in SPACED.finditer(text)]


def hits(text: str, find: Finder) -> list[tuple[float, int, bool, list[str]]]:
    """(weight, edits, between quotation marks, context words) of each hit of a text."""
    text = text.lower()
    words = WORD.findall(text)
    at = [k for k, found in enumerate(map(find.__getitem__, words)) if found is not None]
    hidden = [d for d in disguises(text) if find[d[2]] is not None] if find.hidden(text) else []
    if not at and not hidden:
        return []
    spans = [m.span() for m in WORD.finditer(text)]
    where = [(*spans[k], words[k]) for k in at]
    for start, end, word in hidden:
        if all(end <= a or b <= start for a, b, _ in where):
            where.append((start, end, word))
    starts, found = [a for a, _ in spans], []
    for start, end, word in sorted(where):
        before, after = bisect_left(starts, start), bisect_left(starts, end)
        found.append((*find[word], is_quoted(text, start, end), words[max(0, before - REACH):before] + words[after:after + REACH]))
    return found


def features(found: list, n_words: int, model: Model) -> list[float]:
    """Weight of plain and of misspelled hits, each scaled by its context's odds of abuse."""
    exact = near = mentioned = 0.0
    for weight, edits, quoted, around in found:
        odds = sum(model.context.get(w, 0.0) for w in around) + (model.quoted if quoted else 0.0)
        share = 1 / (1 + math.exp(-max(-30.0, min(30.0, odds + 2.0))))
        if edits:
            near += weight * share
        else:
            exact += weight * share
        mentioned += 1 - share
    return [math.log1p(exact), math.log1p(near), math.log1p(mentioned), (exact + near) / max(n_words, 20)]


def family(words: list[str]) -> int:
    """The same for most copies of a text with small changes: the least hash of three words in a row."""
    return min((crc32(" ".join(words[k:k + 3]).encode()) for k in range(max(1, len(words) - 2))), default=0)


def lexicon(texts: list[str], toxic: list[int]) -> tuple[dict[str, float], dict[str, float]]:
    """Terms and stems with their log lifts. Copies count once: a hundred copies of one toxic text say
    no more about its words than one. A stem needs several endings, else its term says it all; it is
    dropped below a shorter stem."""
    shared: dict[str, str] = {}
    families: dict[int, defaultdict] = {0: defaultdict(set), 1: defaultdict(set)}
    for text, label in zip(texts, toxic):
        words = WORD.findall((text or "").lower())
        families[label][family(words)].update(shared.setdefault(w, w) for w in words)

    def stems_of(words: set[str]) -> set[str]:
        return {w[:k] for w in words for k in STEMS if len(w) > k}

    n1, n0 = max(1, len(families[1])), max(1, len(families[0]))

    def best(items) -> dict[str, float]:
        bad: Counter = Counter()
        for words in families[1].values():
            bad.update(items(words))
        bad = {i: n for i, n in bad.items() if n >= MIN_DOCS}
        clean: Counter = Counter()
        for words in families[0].values():
            clean.update(i for i in items(words) if i in bad)
        lift = {i: (n / n1) / ((clean[i] + 0.5) / n0) for i, n in bad.items()}
        top = sorted((i for i in lift if lift[i] >= MIN_LIFT), key=lambda i: (-lift[i] * math.sqrt(bad[i]), i))[:MAX_TERMS]
        return {i: math.log(lift[i]) for i in top}

    terms, stems = best(lambda words: words), best(stems_of)
    endings: defaultdict[str, set] = defaultdict(set)
    for words in families[1].values():
        for w in words:
            for k in STEMS:
                if len(w) > k and w[:k] in stems:
                    endings[w[:k]].add(w)
    stems = {s: v for s, v in stems.items() if len(endings[s]) > MIN_ENDINGS}
    stems = {s: v for s, v in stems.items() if not any(s[:k] in stems for k in STEMS if k < len(s))}
    return terms, stems


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, rounds: int = 30) -> tuple[list[float], float]:
    """Newton's method; the classes weigh alike, so 0.5 separates them whatever their shares."""
    if not len(y) or y.min() == y.max():
        return [0.0] * x.shape[1], 4.0 if len(y) and y[0] else -4.0
    a = np.c_[x, np.ones(len(x))]
    weight = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    keep = np.r_[np.full(x.shape[1], ridge), 1e-6]
    b = np.zeros(a.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a @ b, -30, 30)))
        step = np.linalg.solve((a * (weight * p * (1 - p))[:, None]).T @ a / len(y) + np.diag(keep),
                               a.T @ (weight * (p - y)) / len(y) + keep * b)
        b -= step
        if np.abs(step).max() < 1e-8:
            break
    return b[:-1].tolist(), float(b[-1])


def fit(texts: list[str], toxic: list[int]) -> Model:
    """Lexicon, context odds and weights, from labelled texts."""
    terms, stems = lexicon(texts, toxic)
    trie = Trie(terms, stems)
    find = Finder(trie)
    near: defaultdict[str, set] = defaultdict(set)
    for text, label in zip(texts, toxic):
        if not label:
            text = (text or "").lower()
            words = WORD.findall(text)
            for w in {w for w in [*words, *(d for _, _, d in disguises(text))] if (find[w] or (0, 0))[1]}:
                near["".join(filter(str.isalpha, w)) if w[0] == "\1" else w.lstrip("\0")].add(family(words))
    trie.ordinary = {w for w, groups in near.items() if len(groups) > 1}
    find = Finder(trie)
    found = [hits(t or "", find) for t in texts]
    seen = {0: Counter(), 1: Counter()}
    total, quoted = Counter(), Counter()
    for one, label in zip(found, toxic):
        for _, _, marked, around in one:
            total[label] += 1
            quoted[label] += marked
            seen[label].update(set(around))

    def odds(n1: int, n0: int) -> float:
        return math.log((n1 + 1) / (total[1] + 2)) - math.log((n0 + 1) / (total[0] + 2))

    enough = total[0] >= MIN_CONTEXT   # without hits in clean documents nothing tells a mention
    context = {w: odds(seen[1][w], seen[0][w]) for w in {*seen[0], *seen[1]}
               if enough and seen[0][w] + seen[1][w] >= MIN_CONTEXT and abs(odds(seen[1][w], seen[0][w])) > 1}
    model = Model(trie, context, odds(quoted[1], quoted[0]) if enough else -1.0, [], 0.0)
    x = np.array([features(f, len(WORD.findall(t or "")), model) for f, t in zip(found, texts)], float).reshape(-1, 4)
    model.coefficients, bias = logistic(x, np.array(toxic, float))
    model.bias = min(bias, WITHOUT_HITS)
    return model


def training_rows(docs: DataFrame, labels: DataFrame, id_column: str, text_column: str, label_column: str,
                  rows: int = TRAINING_ROWS) -> DataFrame:
    """Labelled documents outside the held-out fold, `rows` at most: those with the lowest hash of the
    id, which are a sample without regard to order or source. Of repeated ids one row counts."""
    marked = (labels.select(F.col(id_column).alias("_id"), F.col(label_column).cast("int").alias("_toxic"))
              .where("_id is not null and _toxic is not null").where(fold("_id") != 0)
              .groupBy("_id").agg(F.max("_toxic").alias("_toxic"))
              .orderBy(F.xxhash64("_id"), "_id").limit(rows))
    texts = docs.select(F.col(id_column).alias("_id"), F.col(text_column).alias("_text")).where("_text is not null")
    return (texts.join(F.broadcast(marked), "_id").groupBy("_id")
            .agg(F.min("_text").alias("_text"), F.first("_toxic").alias("_toxic")).orderBy("_id"))


def learn(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text",
          label_column: str = "toxic", rows: int = TRAINING_ROWS) -> Model:
    found = training_rows(docs, labels, id_column, text_column, label_column, rows).toArrow()
    return fit(found["_text"].to_pylist(), [int(y > 0) for y in found["_toxic"].to_pylist()])


def toxicity(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text",
             keep: list[str] | None = None) -> DataFrame:
    """One row per row of `docs`: the columns `keep` (default: the id), the score and what it rests on.

    Only the text is looked at. A null or empty text has no hits and the score of a text without
    any. Repeated rows give a row each. A model without toxic training texts scores all alike, low.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def rows(given):
        model = shared.value
        find = finder(model)
        for text, in given:
            found = hits(text or "", find)
            x = features(found, len(WORD.findall(text or "")) if found else 0, model)
            z = model.bias + sum(a * b for a, b in zip(model.coefficients, x))
            score = 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))
            yield (score, int(score >= 0.5), len(found), sum(e > 0 for _, e, _, _ in found),
                   sum(q for _, _, q, _ in found))

    return per_row(docs, [text_column], ADDED, rows, keep=keep or [id_column])

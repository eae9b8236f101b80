"""Plain values of the contracts, row by row in Python."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
BLANKS = " \t\n\x0b\x0c\r"


def sha(x: str | bytes) -> str:
    return hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


def substring(docs, window=20):
    first, out = {}, {}
    for i, text in sorted(docs, key=lambda r: r[0]):
        words, gone = WORD.findall(text or ""), set()
        for a in range(len(words) - window + 1):
            k = tuple(words[a:a + window])
            if k in first:
                gone.update(range(a, a + window))
            first.setdefault(k, i)
        out[i] = (len(words), len(gone), " ".join(w for j, w in enumerate(words) if j not in gone))
    return out


def contamination(docs, items, window=13):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    known = defaultdict(set)
    for item, text in items:
        words = word.findall((text or "").translate(LOWER))
        n = min(window, len(words))
        for i in range(len(words) - n + 1 if n else 0):
            known[tuple(words[i:i + n])].add(item)
    out = []
    for i, text in docs:
        words, hit, found = word.findall((text or "").translate(LOWER)), set(), set()
        for n in {len(k) for k in known}:
            for a in range(len(words) - n + 1):
                if tuple(words[a:a + n]) in known:
                    found |= known[tuple(words[a:a + n])]
                    hit.update(range(a, a + n))
        out.append((i, len(words), len(hit), sorted(str(x) for x in found if x is not None),
                    bool(hit) and 20 * len(hit) >= len(words)))
    return out


def lines(docs, min_docs=10):
    key = lambda x: x.strip(BLANKS).translate(LOWER)
    seen = Counter()
    for _, text in docs:
        seen.update({key(x) for x in (text or "").split("\n")})
    out = []
    for i, text in docs:
        own = (text or "").split("\n")
        kept = [x for x in own if not (key(x) and seen[key(x)] >= min_docs)]
        out.append((i, len(own), len(own) - len(kept), "\n".join(kept)))
    return out


def luhn(number: str) -> bool:
    doubled = [int(c) * (1 + k % 2) for k, c in enumerate(reversed(number))]
    return sum(v - 9 if v > 9 else v for v in doubled) % 10 == 0


def personal(text):
    text, spans = text or "", []
    only = lambda m: re.sub("[^0-9]", "", m.group())
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        spans.append((m.start(), 0, m.end(), "email"))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m.group().split(".")):
            spans.append((m.start(), 1, m.end(), "ip"))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        if 12 <= len(only(m)) <= 19 and luhn(only(m)):
            spans.append((m.start(), 2, m.end(), "card"))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(only(m)) <= 15:
            spans.append((m.start(), 3, m.end(), "phone"))
    return ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(spans))


def near(docs, shingle, percent):
    """{id: (size, least id reachable)}; rows of one id are one document with several texts."""
    texts = []
    for i, text in docs:
        words = WORD.findall((text or "").translate(LOWER))
        n = min(shingle, len(words))
        texts.append((i, frozenset(tuple(words[a:a + n]) for a in range(len(words) - n + 1)) if n else frozenset()))
    parent = {i: i for i, _ in texts}

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    holders = defaultdict(list)
    for k, (_, s) in enumerate(texts):
        for x in s:
            holders[x].append(k)
    common = Counter((a, b) for ks in holders.values() for a in ks for b in ks if a < b)
    for (a, b), n in common.items():
        (i, s), (j, t) = texts[a], texts[b]
        if 100 * n >= percent * (len(s) + len(t) - n):
            x, y = find(i), find(j)
            parent[max(x, y)] = min(x, y)
    return [(i, len(s), find(i)) for i, s in texts]


def quality(text):
    text = text or ""
    words, seen, again = WORD.findall(text), set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            again += line in seen
            seen.add(line)
    at = defaultdict(list)
    for a in range(len(words) - 7):
        at[tuple(words[a:a + 8])].append(a)
    repeated = {p for places in at.values() if len(places) > 1 for a in places for p in range(a, a + 8)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), again, len(repeated),
            len(words) < 20 or 100 * len(repeated) > 30 * len(words))


def damaged(conversations):
    """(conv_id, turn, role, text) after damage, in the order of their turns."""
    out = []
    for conv, turn, role, text in conversations:
        name = lambda x: " " if x is None else str(x)
        fault = zlib.crc32(f"{name(conv)}:{name(turn)}".encode()) % 20
        role, text = name(role), name(text)
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        out += [(conv, turn, "user" if fault == 4 else role, text)] * {0: 0, 3: 2}.get(fault, 1)
    return sorted(out, key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.md5(r[3].encode()).hexdigest()))


def conversation(rows):
    """Counts, cost, audit and repaired lines of one conversation's (turn, role, text)."""
    seen, faults = set(), []
    for _, role, text in rows:
        words = text.strip(BLANKS)
        faults.append("b" if not words else "d" if (role, text) in seen else "t" if words[-1] not in ".!?" else "")
        seen.add((role, text))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    # From the end: the least (cost, audit, lines) by how many rows are done and what has been given.
    expects = {"": "user", "s": "user", "u": "assistant", "a": "user"}
    after = {q: (0, "", []) if q in ("", "a") else None for q in expects}
    least = lambda xs: min((x for x in xs if x), key=lambda x: x[:2], default=None)
    plus = lambda cost, letter, lines, x: x and (cost + x[0], letter + x[1], lines + x[2])

    def with_inserts(at):
        for _ in range(3):
            at = {q: least([at[q], plus(5, "I", [expects[q] + ":"], at[expects[q][0]])]) for q in at}
        return at

    after = with_inserts(after)
    for (_, role, text), fault in zip(rows[::-1], faults[::-1]):
        at = {}
        for q, gives in expects.items():
            options = [plus(2, "D", [], after[q])]
            if fault in ("", "t"):
                extra = 5 if fault else 0
                if role[:1] == gives[0] or q == "" and role[:1] == "s":
                    options.append(plus(extra, "K", [f"{role}:{text}"], after[role[:1]]))
                options.append(plus(1 + extra, "R", [f"{gives}:{text}"], after[gives[0]]))
            at[q] = least(options)
        after = with_inserts(at)
    cost, audit, lines = after[""]
    return (gaps, faults.count("b"), faults.count("d"), faults.count("t"), illegal, cost, audit, "\n".join(lines))


def middle(doc_id, text):
    text, h = text or "", sha(f"42:{'' if doc_id is None else doc_id}")
    units = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text)
    n, (h1, h2, h3, h4) = len(units), (int(h[k:k + 8], 16) for k in range(0, 32, 8))
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or re.search("<[PSM]>", text) or h3 % 100 >= 50:
        return n, "plain", None, None, text
    if h4 % 100 < 80:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"

"""Small tables with every awkward case, and brute-force versions of the operators."""

import hashlib
import random
import re

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, p int, block long, label string"


def rows(texts):
    """(doc_id, text) pairs with the other columns, whose names clash with those the operators make."""
    return [(i, t, "en", f"s{(i or 0) % 3}", len(t or ""), 7, 8, "x") for i, t in texts]


def docs(spark, texts):
    return spark.createDataFrame(rows(texts), SCHEMA)


def sample(seed=1, n=60):
    """Copies, near copies, shared passages and lines, long words, few words, other scripts, blank and null texts."""
    r = random.Random(seed)
    words = [f"w{k}" for k in range(40)] + ["Ünder", "naïve", "日本語", "x" * 70, "THE", "the"]
    say = lambda k: " ".join(r.choice(words) for _ in range(k))
    passage, line = say(60), say(9)
    out = [(0, None), (1, ""), (2, "   \n\t "), (3, "one"), (4, "one two"), (5, "one"), (6, "a a a a a a a a a a a a a a a a a a a a")]
    for i in range(7, n):
        lines = [say(r.randint(1, 25)) for _ in range(r.randint(1, 6))]
        if r.random() < 0.3:
            lines.insert(r.randrange(len(lines) + 1), passage)
        if r.random() < 0.4:
            lines[r.randrange(len(lines)) :] = [line, lines[0], line, lines[0]]
        text = "\n".join(lines)
        if r.random() < 0.3 and len(out) > 8:
            text = r.choice(out[7:])[1] if len(out) > 8 else text
            if r.random() < 0.6:
                own = text.split(" ")
                own[r.randrange(len(own))] = "changed"
                text = " ".join(own)
        out.append((i * 3, text))
    out += [(1000, say(4000)), (1001, "ab" * 700), (1002, "x" * 500 + " " + "x" * 300)]
    return out


def split(text):
    return [w.decode() for w in (text or "").encode().split()]


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def words_removed(texts, width=13):
    first = {}
    for i, t in sorted(texts, key=lambda x: x[0]):
        w = split(t)
        for k in range(len(w) - width + 1):
            first.setdefault(tuple(w[k : k + width]), i)
    out = {}
    for i, t in texts:
        w = split(t)
        lost = [False] * len(w)
        for k in range(len(w) - width + 1):
            if first[tuple(w[k : k + width])] < i:
                lost[k : k + width] = [True] * width
        out[i] = (len(w), sum(lost), " ".join(x for x, y in zip(w, lost) if not y))
    return out


def bytes_removed(texts, width=100):
    seen, out = set(), {}
    for i, t in sorted(texts, key=lambda x: x[0]):
        b = (t or "").encode()
        lost = bytearray(len(b))
        for k in range(len(b) - width + 1):
            if b[k : k + width] in seen:
                lost[k : k + width] = b"\1" * width
            seen.add(b[k : k + width])
        spans = sum(1 for k in range(len(b)) if lost[k] and (k == 0 or not lost[k - 1]))
        out[i] = (len(b), sum(lost), spans, bytes(x for x, y in zip(b, lost) if not y))
    return out


def lines_removed(texts, run=3, words=None):
    seen, out = set(), {}
    for i, t in sorted(texts, key=lambda x: x[0]):
        raw = (t or "").split("\n")
        said = [(k, x.strip(" \t\n\r\x0b\x0c")) for k, x in enumerate(raw) if x.encode().split()]
        lost = [False] * len(said)
        for width in range(1, run + 1):
            for k in range(len(said) - width + 1):
                key = tuple(x for _, x in said[k : k + width])
                if width < run and (words is None or sum(len(x.encode().split()) for x in key) <= words):
                    continue
                if key in seen:
                    lost[k : k + width] = [True] * width
                seen.add(key)
        drop = {said[k][0] for k in range(len(said)) if lost[k]}
        runs = sum(1 for k in range(len(said)) if lost[k] and (k == 0 or not lost[k - 1]))
        out[i] = (len(said), len(drop), runs, "\n".join(x for k, x in enumerate(raw) if k not in drop))
    return out


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def shingles(text, width):
    w = split(lower(text))
    if not w:
        return set()
    return {tuple(w[k : k + width]) for k in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)}


def near(texts, width, percent):
    sets = [(i, shingles(t, width)) for i, t in texts]
    root = {i: i for i, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, (i, s) in enumerate(sets):
        for j, t in sets[:a]:
            if s and t and 100 * len(s & t) >= percent * len(s | t):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return {i: (len(s), find(i)) for i, s in sets}

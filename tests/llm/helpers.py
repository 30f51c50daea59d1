"""Brute-force versions and small tables for the tests of the operators."""

from __future__ import annotations

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def ascii_lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def simhash(text, shingle=4):
    from xxhash import xxh64
    ws = WORD.findall(ascii_lower(text or ""))
    if not ws:
        return 0
    grams = [" ".join(ws[i:i + shingle]) for i in range(max(1, len(ws) - shingle + 1))]
    hashes = [xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(fps, most=4):
    """For each fingerprint the place of the first one that is reachable from it."""
    parent = list(range(len(fps)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= most:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def corpus(n=120, seed=3):
    """Small documents with exact and near copies, shared passages, junk and odd rows."""
    rnd = random.Random(seed)
    vocab = ["".join(rnd.choice("abcdeéntrsoiu") for _ in range(rnd.randint(2, 8))) for _ in range(400)]
    passage = "\n".join(" ".join(rnd.choice(vocab) for _ in range(12)) for _ in range(7))
    long_line = " ".join(rnd.choice(vocab) for _ in range(60))
    texts = []
    for i in range(n):
        text = "\n".join(" ".join(rnd.choice(vocab) for _ in range(rnd.randint(6, 20)))
                         for _ in range(rnd.randint(2, 8)))
        if i % 10 == 3:
            text = texts[i - 3]
        elif i % 10 == 4:
            ws = texts[i - 4].split(" ")
            ws[len(ws) // 2] = "changed"
            text = " ".join(ws)
        elif i % 10 == 5:
            text += "\n" + passage + "\n" + text[:30]
        elif i % 10 == 6:
            text = text + "\n" + long_line
        elif i % 10 == 7:
            text = " ".join(w.upper() + "!!" for w in text.split())
        texts.append(text)
    out = [(i, t, "en", None if i % 13 == 0 else f"s{i % 5}", len(t)) for i, t in enumerate(texts)]
    return out + [(n, None, None, None, None), (n + 1, "", "en", "s1", 0), (n + 2, " \n\t ", "en", "s2", 4),
                  (None, "no id here but words", "en", "s0", 20), (n + 3, "ab " * 5000, "de", "s3", 15000)]

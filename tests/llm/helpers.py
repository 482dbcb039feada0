"""Small documents and brute-force versions for the operator tests."""

from __future__ import annotations

import random
import re

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
VOWELS = ["ta", "ri", "on", "es", "mu", "lo", "ke", "pa", "ve", "ni"]


def words(rng: random.Random, n: int) -> list[str]:
    return ["".join(rng.choice(VOWELS) for _ in range(rng.randint(1, 4))) for _ in range(n)]


def documents(spark, texts, first=0, lang="en", source="s"):
    rows = [(first + k, t, lang, source, None if t is None else len(t)) for k, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


def lower(text: str) -> str:
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text)


def split(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", lower(text or ""))


def shingles(text: str | None) -> frozenset:
    w = split(text)
    return frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()


def jaccard_components(rows: list[tuple[int, str | None]]) -> dict[int, tuple[int, int]]:
    sets = {d: shingles(t) for d, t in rows}
    up = {d: d for d in sets}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            same = len(sets[a] & sets[b])
            if same and 100 * same >= 75 * (len(sets[a]) + len(sets[b]) - same):
                x, y = find(a), find(b)
                up[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), find(d)) for d in sets}

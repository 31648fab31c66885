"""Small tables and plain (brute-force) versions of the operators."""

from __future__ import annotations

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(rng: random.Random, n: int, vocab: int = 4000) -> list[str]:
    return [f"w{rng.randrange(vocab)}" for _ in range(n)]


def corpus(seed: int = 1, n: int = 120) -> list[tuple]:
    """Texts with exact copies, near copies, chains of near copies, shared lines and short texts."""
    rng = random.Random(seed)
    shared = ["This boiler plate line stands in very many documents, word for word.",
              "Another line that many documents share; it is long enough to count too."]
    texts = []
    for i in range(n):
        kind = i % 6
        if kind == 0 or len(texts) < 6:
            texts.append("\n".join(" ".join(words(rng, rng.randrange(3, 60))) for _ in range(4)))
        elif kind == 1:
            texts.append(rng.choice(texts))
        elif kind in (2, 3):
            own = rng.choice(texts).split(" ")
            for _ in range(max(1, len(own) // 60)):
                own[rng.randrange(len(own))] = f"x{rng.randrange(9999)}"
            texts.append(" ".join(own))
        elif kind == 4:
            texts.append("\n".join([*words(rng, 3), rng.choice(shared), "  " + rng.choice(shared).upper()]))
        else:
            texts.append(" ".join(words(rng, rng.randrange(0, 6))))
    return [(i, t, "en", f"s{i % 3 and 0}", len(t)) for i, t in enumerate(texts)]


def odd_rows() -> list[tuple]:
    """Nulls in every column, empty, blank and long texts, and repeated rows."""
    long = " ".join(f"word{i % 7919}" for i in range(60_000))
    return [
        (1, None, None, None, None), (2, "", "en", "a", 0), (3, " \t\n ", "en", "a", 4),
        (4, long, "en", None, len(long)), (5, "one two", "en", "a", 7), (5, "one two", "en", "a", 7),
        (None, "no id but words enough for a set of them", "en", "a", 40), (None, None, None, None, None),
        (6, "one two", "de", "b", 7), (7, "\n\n", "en", "b", 2),
        (8, "é" * 50 + "\n" + "é" * 50, "fr", "b", 101), (-3, "a b c d e f", "en", "b", 11),
    ]


def shingle_set(text: str | None, n: int) -> frozenset:
    own = (text or "").encode().lower().split()
    if not own:
        return frozenset()
    if len(own) < n:
        return frozenset([tuple(own)])
    return frozenset(tuple(own[i:i + n]) for i in range(len(own) - n + 1))


def near_components(rows: dict[int, str], n: int, percent: int) -> dict[int, int]:
    sets = {i: shingle_set(t, n) for i, t in rows.items()}
    root = {i: i for i in rows}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(rows)
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                p, q = sorted((find(a), find(b)))
                root[q] = p
    return {i: find(i) for i in ids}


def deduped_lines(rows: list[tuple[int, str]], min_chars: int = 40, min_docs: int = 5) -> dict[int, tuple]:
    blank = " \t\n\v\f\r"
    lower = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
    key = lambda line: line.strip(blank).translate(lower)
    holders: dict[str, set[int]] = {}
    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders.setdefault(key(line), set()).add(i)
    out = {}
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(holders.get(key(x), ())) < min_docs or max(holders[key(x)]) == i]
        out[i] = (len(lines), len(lines) - len(kept), "\n".join(kept))
    return out

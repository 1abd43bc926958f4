"""Small tables with the odd cases, and brute-force twins in plain Python."""

from __future__ import annotations

import random
import re

FIELDS = "doc_id long, text string, lang string, source string, n_chars long, _row string, n string"
WORDS = [f"w{chr(97 + i % 26)}{i}" for i in range(300)]


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) for _ in range(n))


def edited(text: str, seed: int, edits: int) -> str:
    rng, words = random.Random(seed), text.split(" ")
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
    return " ".join(words)


def odd_rows() -> list[tuple]:
    """(doc_id, text, source): nulls, empties, ties, repeats, near copies, a long text."""
    base, rows = prose(1, 200), []
    texts = [
        base, base, base.upper(), edited(base, 2, 2), edited(base, 3, 4), edited(base, 4, 9),
        edited(base, 5, 14), edited(edited(base, 6, 5), 7, 5), None, "", " \t\n", "one two three",
        "One  two\tthree", "a b c d", "a b c d", prose(8, 60), prose(9, 49), prose(10, 5000),
        "é ü ß 漢字 　 wide", "end<|endoftext|>end", "line\nline\n\nline x\n",
        ("same words again " * 40).strip(), "\x1c odd \x1f separators   here", "$$$ *** " * 60,
    ]
    for i, text in enumerate(texts):
        rows.append((i * 3, text, None if i % 7 == 0 else f"s{i % 3}"))
    rows.append((3, base, "s1"))  # a whole row again
    rows.append((None, prose(11, 80), "s2"))
    rows.append((None, base, "s2"))
    return rows


def frame(spark, rows):
    full = [(i, t, "en", s, len(t or ""), "clash", "clash") for i, t, s in rows]
    return spark.createDataFrame(full, FIELDS)


def words(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def folded(text: str | None) -> str:
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def shingle_set(text: str | None, size: int) -> set:
    found = words(folded(text))
    if not found:
        return set()
    if len(found) < size:
        return {tuple(found)}
    return {tuple(found[i : i + size]) for i in range(len(found) - size + 1)}


def groups(texts: list, size: int, percent: int) -> list[int]:
    """Least index of each text's component, by comparing all pairs."""
    sets = [shingle_set(t, size) for t in texts]
    parent = list(range(len(sets)))

    def find(x: int) -> int:
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(sets)):
        for j in range(i):
            shared = len(sets[i] & sets[j])
            union = len(sets[i]) + len(sets[j]) - shared
            if union and 100 * shared >= percent * union:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(sets))]

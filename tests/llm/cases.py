"""Documents with nulls, empty and long texts, ties, repeated rows and clashing columns."""

from __future__ import annotations

import random
import re

from salesweft.session import importable

BLANK = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row long, key string, score double, shard int"


def sentence(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 7))) for _ in range(n))


def texts(seed: int = 1) -> list[tuple]:
    rng = random.Random(seed)
    base = [sentence(rng, 60) + ".\n" + sentence(rng, 40) + "." for _ in range(25)]
    near = []
    for k in range(6):
        words = base[0].split(" ")
        words[5 + k] = "changed"
        near.append(" ".join(words))
    odd = [None, "", " \t\n", "one", "one two three", "é 😀 " * 30, base[1], base[1].replace(" ", "\n  "), sentence(rng, 12_000), "x" * 50_000]
    return [(i, t) for i, t in enumerate([*base, *near, *odd])] + [(None, base[2]), (None, None), (3, base[3]), (3, base[3]), (-7, base[4])]


def documents(spark, rows: list[tuple] | None = None, parts: int = 3):
    """The rows as a frame whose other columns have names that operators could use themselves."""
    importable(spark)
    rows = texts() if rows is None else rows
    full = [(i, t, None if n % 5 == 0 else "en", f"s{n % 3}", 1, 5, "k", 0.1, 2) for n, (i, t) in enumerate(rows)]
    return spark.createDataFrame(full, SCHEMA).repartition(parts)


def plain(text: str | None) -> str:
    return re.sub(BLANK, "", text or "")


def words(text: str | None) -> list[str]:
    return re.findall(WORD, text or "")


def shingles(text: str | None, n: int = 5) -> set[tuple]:
    found = words(text)
    return {tuple(found[k : k + n]) for k in range(len(found) - n + 1)} or ({tuple(found)} if found else set())


def groups(nodes: list, links: list[tuple]) -> dict:
    """The component of every node, as a set."""
    of = {n: {n} for n in nodes}
    for a, b in links:
        if of[a] is not of[b]:
            of[a] |= of[b]
            for x in of[b]:
                of[x] = of[a]
    return of

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from salesweft.llm import ranked_search
from salesweft.session import importable

DOCS = "doc_id long, text string, row long, norm double, terms string, n long, item int, rank int, score long, id string"
ITEMS = "item_id long, text string, query long, item string, score long, doc_id long, row int"


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", "".join(c.lower() if c.isascii() else c for c in text or ""))


def data(seed=1, n=120):
    rng = random.Random(seed)
    names = [f"w{i}" for i in range(40)] + ["É", "é", "Straße", "ÇA", "x1", "日本", "K"]
    draw = lambda k: rng.choice([" ", ", ", "\n", "-"]).join(rng.choice(names[: rng.randint(3, len(names))]) for _ in range(k))
    docs = [(i, draw(rng.randint(1, 40))) for i in range(n)]
    docs += [(500 + i, docs[3][1]) for i in range(30)] + [(None, docs[3][1]), (7, docs[7][1]), (7, docs[7][1]), (600, None), (601, ""), (602, " .,;"), (603, draw(30_000)), (-5, docs[3][1].upper())]
    items = [(i, draw(rng.randint(1, 25))) for i in range(25)] + [(25, None), (26, ""), (27, "nowhere"), (None, "w1 w2"), (3, "w1 W1 w1"), (3, "w1 W1 w1"), (28, docs[3][1])]
    return docs, items


def brute(docs, items, top):
    counts = [(i, Counter(terms(t))) for i, t in docs]
    n_docs = sum(1 for _, c in counts if c)
    n_terms = sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in items:
        scores = []
        for place, (i, c) in enumerate(counts):
            m = 10 + (90 * sum(c.values()) * n_docs) // n_terms if n_terms else 0
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * c[t]) // (1000 * c[t] + 8 * m)) for t in set(terms(text)) if c[t])
            if s > 0:
                scores.append((-s, i is None, i or 0, place))
        out += [(item, k + 1, None if null else i, -s) for k, (s, null, i, _) in enumerate(sorted(scores)[:top])]
    return Counter(out)


def frames(spark, docs, items, parts=4):
    importable(spark)
    rng = random.Random(0)
    d = spark.createDataFrame([(i, t, rng.randint(0, 3), 0.5, "t", 1, 2, 3, 4, "i") for i, t in docs], DOCS).repartition(parts)
    return d, spark.createDataFrame([(i, t, 1, "x", 2, 3, 4) for i, t in items], ITEMS)


def rows(found):
    return Counter((r.item_id, r["rank"], r.doc_id, r.score) for r in found.collect())


@pytest.mark.parametrize("seed, top", [(1, 10), (2, 3)])
def test_matches_brute_force(spark, seed, top):
    docs, items = data(seed)
    assert rows(ranked_search.ranked(*frames(spark, docs, items), top=top)) == brute(docs, items, top)


def test_small_buckets_blocks_and_focus(spark, monkeypatch):
    docs, items = data(3)
    monkeypatch.setattr(ranked_search, "BLOCK_ITEMS", 9)
    monkeypatch.setattr(ranked_search, "FOCUS", 2)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        found = rows(ranked_search.ranked(*frames(spark, docs, items)))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert found == brute(docs, items, 10)


def test_bounds_prune_and_keep_the_best():
    """Random vectors in one bucket: what the bounds drop never reaches the threshold."""
    rng = np.random.default_rng(1)
    dropped = 0
    for _ in range(50):
        x = rng.integers(0, 500, (60, 20)) * (rng.random((60, 20)) < 0.3)
        weights = np.sort(rng.integers(1, 9000, 12))[::-1]
        at = rng.permutation(20)[:12]
        exact = x[:, at] @ weights
        threshold = int(np.sort(exact)[-3])
        owner, term = np.nonzero(x)
        order = np.argsort(term, kind="stable")
        cuts = np.searchsorted(term[order], np.arange(21))
        found, scores = ranked_search._answers(at, weights, threshold, np.sqrt((x**2).sum(axis=1).astype(float)), owner[order], x[owner, term][order], cuts)
        assert set(found) == set(np.flatnonzero(exact >= threshold)) and (exact[found] == scores).all()
        dropped += 60 - len(found)
    assert dropped > 0


def test_vocabulary_compares_bytes():
    known, held = ranked_search.vocabulary(["ab cd", None, "cd ef cd"])
    assert [len(h) for h in held] == [2, 0, 2]
    raw, starts, ends, owner = ranked_search._terms(pa.array(["CD x ef", None, "ab-cdd"], pa.large_string()))
    span, term = known.find(raw, starts, ends)
    assert [raw[starts[s] : ends[s]].tobytes() for s in span] == [b"cd", b"ef", b"ab"]
    assert all(raw[starts[s] : ends[s]].tobytes() == known.data[known.places[t] :][: known.lengths[t]].tobytes() for s, t in zip(span, term))
    same = ranked_search.Vocabulary(known.hashes, known.lengths, known.places, known.data[::-1].copy())
    assert len(same.find(raw, starts, ends)[0]) == 0


def test_empty_tables(spark):
    docs, items = frames(spark, *data())
    for d, i in ((docs.limit(0), items), (docs, items.limit(0)), (docs.where("text IS NULL"), items)):
        found = ranked_search.ranked(d, i)
        assert found.columns == ["item_id", "rank", "doc_id", "score"] and found.count() == 0

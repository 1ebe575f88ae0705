from collections import Counter
from itertools import combinations

import numpy as np
import pytest

from salesweft.llm import components, ngram_join
from tests.llm import cases


def brute(rows):
    sets = [cases.shingles(t) for _, t in rows]
    links = [(a, b) for a, b in combinations(range(len(rows)), 2) if sets[a] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    of = cases.groups(list(range(len(rows))), links)
    count = Counter(x for pair in links for x in pair)
    smallest = lambda g: min((rows[x][0] for x in g if rows[x][0] is not None), default=None)
    return Counter((rows[n][0], smallest(of[n]), count[n]) for n in range(len(rows))), {id(g): g for g in of.values()}


@pytest.mark.parametrize("block", [1024, 3])
def test_links_match_brute_force(spark, block, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK_ROWS", block)
    rows = cases.texts()
    found = ngram_join.joined(cases.documents(spark, rows)).collect()
    want, groups = brute(rows)
    assert Counter((r.doc_id, r.class_id, r.n_links) for r in found) == want
    assert sum(r.kept for r in found) == len(groups)


def test_group_of_many_near_copies_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK_ROWS", 16)
    base = cases.texts()[0][1].split(" ")
    rows = [(k, " ".join([*base[: k % 90], f"w{k}", *base[k % 90 :]])) for k in range(80)]
    found = ngram_join.joined(cases.documents(spark, rows)).collect()
    want, _ = brute(rows)
    assert Counter((r.doc_id, r.class_id, r.n_links) for r in found) == want


def test_stage_keeps_columns(spark):
    rows = cases.texts()
    docs = cases.documents(spark, rows)
    kept = ngram_join.deduplicated(docs)
    assert kept.columns == docs.columns
    assert kept.count() == len(brute(rows)[1])


def test_empty_table(spark):
    docs = cases.documents(spark).limit(0)
    assert ngram_join.joined(docs).count() == 0
    assert ngram_join.deduplicated(docs).count() == 0


def test_least_matches_follow_the_posterior():
    least = ngram_join.least_matches()
    rng = np.random.default_rng(1)
    rate = rng.random(200_000)
    for n in (16, 128):
        matches = rng.binomial(n, rate)
        assert (rate[matches < least[n] - 1] < 0.8).mean() > 0.9999
    assert list(least.values()) == sorted(least.values())


def test_matrix_and_single_counts_agree():
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 400, 120).astype(np.uint64)) for _ in range(40)]
    bounds, found = np.concatenate([[0], np.cumsum([len(s) for s in sets])]), np.concatenate(sets)
    left, right = np.array(list(combinations(range(40), 2))).T
    want = [len(np.intersect1d(sets[a], sets[b])) for a, b in zip(left, right)]
    assert ngram_join._common(left, right, found, bounds).tolist() == want
    assert ngram_join._common(left[:5], right[:5], found, bounds).tolist() == want[:5]


def test_components_of_chains_and_hubs(spark):
    edges = [(k, k + 1) for k in range(100, 160)] + [(7, k) for k in range(200, 260)] + [(1, 2), (2, 1), (5, 5)]
    found = {r.node: r.component for r in components.connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    of = cases.groups(sorted({x for e in edges for x in e}), edges)
    assert found == {n: min(g) for n, g in of.items() if len(g) > 1}

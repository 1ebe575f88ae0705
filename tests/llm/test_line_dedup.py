import random
import re
from collections import Counter

import numpy as np
import pytest

from salesweft.llm import line_dedup
from tests.llm import cases


def lines(text, sentences):
    parts = re.split(r"(?<=\n)|(?<=[.!?] )", text or "") if sentences else re.split(r"(?<=\n)", text or "")
    return [x for x in (p.strip(" \t\n\x0b\x0c\r") for p in parts) if x]


def shared_rows(seed=3):
    rng = random.Random(seed)
    passages = [[cases.sentence(rng, rng.randint(1, 30)) for _ in range(rng.randint(1, 6))] for _ in range(8)]
    rows = []
    for i in range(60):
        parts = []
        for _ in range(rng.randint(1, 5)):
            parts += rng.choice(passages) if rng.random() < 0.5 else [cases.sentence(rng, 9)]
            if rng.random() < 0.4:
                parts.append("Read more")
        rows.append((i, "\n".join(parts)))
    return rows


def test_texts_are_cut_and_columns_stay(spark):
    passage = cases.sentence(random.Random(1), 60)
    rows = [(1, f"Intro one.\n{passage}\nend"), (2, f"é other intro\n{passage}\nlast é line"), (3, "Intro one.\nnothing else"), (4, None), (5, passage)]
    docs = cases.documents(spark, rows)
    kept = line_dedup.deduplicated(docs, sentences=False)
    assert kept.columns == docs.columns
    assert {r.doc_id: r.text for r in kept.collect()} == {1: rows[0][1], 2: "é other intro\nlast é line", 3: rows[2][1], 4: None, 5: ""}


def test_common_passage_is_cut_from_all_but_the_first(spark):
    rng = random.Random(2)
    passage = " ".join(cases.sentence(rng, 12) + "." for _ in range(5))
    rows = [(k, cases.sentence(rng, 15) + ". " + passage + " " + cases.sentence(rng, 15) + ".") for k in range(300)]
    found = line_dedup.removed_lines(cases.documents(spark, rows, 8)).collect()
    assert {r.doc_id: r.removed_words for r in found} == {k: 60 if k else 0 for k in range(300)}


def test_one_of_equal_rows_keeps_its_lines(spark):
    rows = [(3, cases.texts()[0][1])] * 4
    assert sorted(r.n_removed > 0 for r in line_dedup.removed_lines(cases.documents(spark, rows)).collect()) == [False, True, True, True]


def test_empty_table(spark):
    docs = cases.documents(spark).limit(0)
    assert line_dedup.removed_lines(docs).count() == 0
    assert line_dedup.deduplicated(docs).count() == 0


@pytest.mark.parametrize("seed", range(40))
def test_patience_deals_unique_lines_to_chains(seed):
    rng = random.Random(seed)
    a = [rng.randint(0, rng.choice([5, 200])) for _ in range(rng.randint(0, 60))]
    b = [x for x in a if rng.random() < 0.8] + [rng.randint(0, 200) for _ in range(rng.randint(0, 10))]
    if seed % 4 == 0:
        rng.shuffle(b)
    chains = line_dedup.patience(a, b)
    unique = {x for x in a if a.count(x) == 1 == b.count(x)}
    assert sorted(a[i] for c in chains for i, _ in c) == sorted(unique) and all(a[i] == b[j] for c in chains for i, j in c)
    assert all(p[0] < q[0] and p[1] < q[1] for c in chains for p, q in zip(c, c[1:]))
    # As few chains as the longest falling run needs.
    places = [a.index(x) for x in b if x in unique]
    best = [1] * len(places)
    for n, i in enumerate(places):
        best[n] = 1 + max((best[m] for m in range(n) if places[m] > i), default=0)
    assert len(chains) == max(best, default=0)


@pytest.mark.parametrize("seed", range(20))
def test_longest_runs(seed):
    rng = random.Random(seed)
    a, b = ([rng.randrange(3) for _ in range(rng.randint(0, 30))] for _ in range(2))
    held = {tuple(a[i:k]) for i in range(len(a)) for k in range(i + 1, len(a) + 1)}
    want = [max((n for n in range(1, j + 2) if tuple(b[j + 1 - n : j + 1]) in held), default=0) for j in range(len(b))]
    assert line_dedup.longest_runs(a, b) == want


def test_alignment_carries_the_result(monkeypatch):
    """Without its chains, passages of unique lines stay; without the exact part, those of repeated lines."""
    a, b = list("abcdxyzPQPQ"), list("uxyzvabcdwPQPQ")
    words = [10] * len(b)
    assert line_dedup.common_blocks(a, b, words, 30) == [1, 2, 3, 5, 6, 7, 8, 10, 11, 12, 13]
    monkeypatch.setattr(line_dedup, "longest_runs", lambda a, b: [0] * len(b))
    assert line_dedup.common_blocks(a, b, words, 30) == [1, 2, 3, 5, 6, 7, 8]
    monkeypatch.undo()
    monkeypatch.setattr(line_dedup, "patience", lambda a, b: [])
    assert line_dedup.common_blocks(a, b, words, 30) == [10, 11, 12, 13]


def common_runs(earlier, later, words, min_words):
    """Lines of the later list in any run that the earlier list holds too."""
    gone = set()
    for i in range(len(earlier)):
        for j in range(len(later)):
            n = 0
            while i + n < len(earlier) and j + n < len(later) and earlier[i + n] == later[j + n]:
                n += 1
            if sum(words[j : j + n]) >= min_words:
                gone |= set(range(j, j + n))
    return sorted(gone)


@pytest.mark.parametrize("earlier, later, gone", [
    ("xPQyPQz", "uPQv", [1, 2]),
    ("uPQv", "xPQyPQz", [1, 2, 4, 5]),
    ("xPQyPQz", "uPQvPQw", [1, 2, 4, 5]),
    ("PQabc", "aPQxbyc", [1, 2]),
])
def test_repeated_and_moved_passages_are_found(earlier, later, gone):
    words = [15 if x in "PQ" else 2 for x in later]
    assert line_dedup.common_blocks(list(earlier), list(later), words, 20) == gone


@pytest.mark.parametrize("seed", range(60))
def test_blocks_match_all_common_runs(seed):
    rng = random.Random(seed)
    size = [rng.randint(1, 12) for _ in range(8)]
    a, b = ([rng.randrange(rng.choice([2, 8])) for _ in range(rng.randint(0, 40))] for _ in range(2))
    words = [size[x] for x in b]
    for least in (1, 8, 20):
        assert line_dedup.common_blocks(a, b, words, least) == common_runs(a, b, words, least)


def test_passage_repeated_in_one_document_is_cut(spark):
    rng = random.Random(5)
    x, y, z, u, v = (cases.sentence(rng, 9) for _ in range(5))
    passage = "\n".join(cases.sentence(rng, 15) for _ in range(4))
    rows = [(1, "\n".join([x, passage, y, passage, z])), (2, "\n".join([u, passage, v])), (3, "\n".join([v, passage, u, passage]))]
    found = {r.doc_id: r.removed_words for r in line_dedup.removed_lines(cases.documents(spark, rows)).collect()}
    assert found == {1: 0, 2: 60, 3: 129}


def all_earlier(rows, sentences, min_words):
    """Every document against every earlier one."""
    order = sorted(range(len(rows)), key=lambda n: (rows[n][0] is None, rows[n][0] or 0, n))
    found = [lines(rows[n][1], sentences) for n in order]
    out = []
    for k, part in enumerate(found):
        words = [len(cases.words(x)) for x in part]
        gone = set()
        for before in found[:k]:
            if set(before) & set(part):
                gone |= set(common_runs(before, part, words, min_words))
        out.append((rows[order[k]][0], len(part), str(sorted(gone)), sum(words[g] for g in gone)))
    return Counter(out)


@pytest.mark.parametrize("sentences, min_words", [(False, 20), (True, 20), (False, 5)])
def test_matches_every_earlier_document(spark, sentences, min_words):
    rows = [r for r in cases.texts() + [(500 + i, t) for i, t in shared_rows()] if r[0] != 3]
    found = line_dedup.removed_lines(cases.documents(spark, rows, 1), sentences=sentences, min_words=min_words).collect()
    assert Counter((r.doc_id, r.n_lines, str(r.removed_lines), r.removed_words) for r in found) == all_earlier(rows, sentences, min_words)


def test_passage_of_lines_first_seen_alone_is_cut(spark):
    rng = random.Random(6)
    passage = [cases.sentence(rng, 12) for _ in range(5)]
    alone = [(k, f"{cases.sentence(rng, 9)}\n{line}\n{cases.sentence(rng, 9)}") for k, line in enumerate(passage)]
    rows = [*alone, *((10 + k, "\n".join([cases.sentence(rng, 9), *passage, cases.sentence(rng, 9)])) for k in range(2))]
    found = {r.doc_id: r.removed_words for r in line_dedup.removed_lines(cases.documents(spark, rows)).collect()}
    assert found == {k: 60 if k == 11 else 0 for k, _ in rows}


@pytest.mark.parametrize("seed", range(20))
def test_window_hashes_are_those_of_windows(seed):
    rng = random.Random(seed)
    lists = [[rng.randrange(6) for _ in range(rng.randint(0, 15))] for _ in range(6)]
    size = [rng.randint(1, 9) for _ in range(6)]
    cuts = np.cumsum([0, *map(len, lists)])
    flat = [x for part in lists for x in part]
    doc, found, start, end = line_dedup.window_hashes(np.array(flat, np.uint64), np.array([size[x] for x in flat], np.int32), cuts, 10)
    want = [(k, tuple(part[i:j])) for k, part in enumerate(lists) for i, j in line_dedup.windows([size[x] for x in part], 10)]
    assert Counter(doc.tolist()) == Counter(k for k, _ in want)
    assert Counter(Counter(found.tolist()).values()) == Counter(Counter(w for _, w in want).values())
    spans = {(k, i, j) for k, part in enumerate(lists) for i, j in line_dedup.windows([size[x] for x in part], 10)}
    assert set(zip(doc.tolist(), start.tolist(), end.tolist())) == spans


def test_long_first_holder_sends_the_shared_lines_only(spark):
    rng = random.Random(8)
    passage = [cases.sentence(rng, 12) for _ in range(3)]
    long = [cases.sentence(rng, 6) for _ in range(400)]
    rows = [(0, "\n".join([*long[:200], *passage, *long[200:]])), *((k, "\n".join([cases.sentence(rng, 9), *passage])) for k in range(1, 30))]
    found = line_dedup.removed_lines(cases.documents(spark, rows), sentences=False).collect()
    assert {r.doc_id: r.removed_words for r in found} == {k: 36 if k else 0 for k in range(30)}

import hashlib
from collections import Counter, defaultdict

import pytest

from salesweft.llm import exact_dedup
from tests.llm import cases


def brute(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[cases.plain(t)].append((-len(t or ""), i is None, i, t))
    out = Counter()
    for text, found in groups.items():
        found.sort(key=lambda r: r[:2] + (r[2] or 0,))
        for n, (_, _, i, _) in enumerate(found):
            out[(i, found[0][2], len(found), n == 0, hashlib.sha256(text.encode()).hexdigest())] += 1
    return out


@pytest.mark.parametrize("runs, fan_in", [(64, 4), (8, 2), (1, 4)])
def test_decisions_match_brute_force(spark, runs, fan_in, monkeypatch):
    monkeypatch.setattr(exact_dedup, "RUNS", runs)
    monkeypatch.setattr(exact_dedup.merged_runs, "__defaults__", (runs, fan_in))
    rows = cases.texts()
    found = exact_dedup.decisions(cases.documents(spark, rows)).collect()
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in found) == brute(rows)


def test_one_of_each_group_stays_with_its_columns(spark):
    rows = cases.texts()
    docs = cases.documents(spark, rows)
    kept = exact_dedup.deduplicated(docs)
    assert kept.columns == docs.columns
    found = Counter(r.doc_id for r in kept.collect())
    want = Counter()
    for (i, _, _, stays, _), n in brute(rows).items():
        want[i] += n * stays
    assert found == +want


def test_large_group_keeps_the_smallest_id(spark):
    docs = spark.range(3000).selectExpr("id AS doc_id", "'same  text' AS text").repartition(8)
    found = exact_dedup.decisions(docs).collect()
    assert {r.keep_id for r in found} == {0} and sum(r.kept for r in found) == 1 and {r.group_size for r in found} == {3000}


def test_empty_table(spark):
    docs = cases.documents(spark).limit(0)
    assert exact_dedup.decisions(docs).count() == 0
    assert exact_dedup.deduplicated(docs).count() == 0

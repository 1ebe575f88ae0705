"""Baskets, itemsets and rules on literal frames, against brute force."""

import itertools
import random

from salesweft.operators import baskets as B

DATA = [
    ["a", "b", "c"], ["a", "b"], ["a", "b", "b"], ["b", "c"], ["a", "c", "d"], ["d"], [],
]


def frame(spark, data):
    return spark.createDataFrame([(i, x) for i, x in enumerate(data)], "id long, items array<string>")


def brute(data, min_support, max_length):
    sets = [set(x) for x in data if x]
    items = sorted(set().union(*sets))
    found = {}
    for k in range(1, max_length + 1):
        for c in itertools.combinations(items, k):
            n = sum(set(c) <= s for s in sets)
            if n and n / len(sets) >= min_support:
                found[c] = n
    return found


def as_dict(df):
    return {tuple(r["items"]): r["n"] for r in df.collect()}


def test_itemsets_match_brute_force(spark):
    random.seed(3)
    data = [random.sample("abcdefgh", random.randint(0, 6)) for _ in range(300)]
    for support, length in ((0.05, 4), (0.3, 3), (0.9, 3)):
        want = brute(data, support, length)
        assert as_dict(B.frequent_itemsets(frame(spark, data), support, length)) == want
    assert as_dict(B.fpgrowth_itemsets(frame(spark, data), 0.05, 4)) == brute(data, 0.05, 4)


def test_repeated_items_and_empty_baskets(spark):
    got = as_dict(B.frequent_itemsets(frame(spark, DATA), 0.3, 3))
    assert got == brute(DATA, 0.3, 3)
    assert got[("b",)] == 4


def test_pair_candidates_and_their_supports(spark):
    singles = spark.createDataFrame([(["a"],), (["b"],), (["c"],)], "items array<string>")
    pairs = sorted(tuple(r["items"]) for r in B.candidate_itemsets(singles, 2).collect())
    assert pairs == [("a", "b"), ("a", "c"), ("b", "c")]
    counted = as_dict(B.itemset_supports(frame(spark, DATA), B.candidate_itemsets(singles, 2)))
    assert counted == {("a", "b"): 3, ("a", "c"): 2, ("b", "c"): 2}


def test_candidate_d_is_pruned(spark):
    # c-d is not frequent, so a-c-d and b-c-d are no candidates; a-b-d is.
    sets = spark.createDataFrame(
        [(list(p),) for p in ("ab", "ac", "ad", "bc", "bd")], "items array<string>"
    )
    got = sorted("".join(r["items"]) for r in B.candidate_itemsets(sets, 3).collect())
    assert got == ["abc", "abd"]


def test_rule_metrics(spark):
    itemsets = B.frequent_itemsets(frame(spark, DATA), 0.1, 3)
    rules = {(tuple(r["antecedent"]), tuple(r["consequent"])): r for r in B.association_rules(itemsets, 0.0).collect()}
    r = rules[(("a",), ("b",))]
    assert abs(r["support"] - 3 / 6) < 1e-12 and abs(r["confidence"] - 3 / 4) < 1e-12
    assert abs(r["lift"] - (3 / 4) / (4 / 6)) < 1e-12
    assert abs(r["leverage"] - (3 / 6 - 4 / 6 * 4 / 6)) < 1e-12
    assert abs(r["conviction"] - (1 - 4 / 6) / (1 - 3 / 4)) < 1e-12
    # Always together: confidence 1, conviction infinite.
    assert rules[(("a", "d"), ("c",))]["conviction"] == float("inf")
    assert len(rules) == sum(2 ** len(s) - 2 for s in brute(DATA, 0.1, 3) if len(s) > 1)


def test_no_frequent_sets(spark):
    itemsets = B.frequent_itemsets(frame(spark, DATA), 0.95, 3)
    assert itemsets.count() == 0 and B.association_rules(itemsets).count() == 0


def test_one_content_in_a_third_of_baskets(spark):
    data = [["x", "y", "z"]] * 1000 + [[random.choice("abc"), "q"] for _ in range(2000)]
    assert B.merged_baskets(frame(spark, data)).count() == 4
    assert as_dict(B.frequent_itemsets(frame(spark, data), 0.3, 3))[("x", "y", "z")] == 1000


def test_basket_limit_is_off_by_default(spark):
    df = frame(spark, DATA)
    assert B.limit_baskets(df, None).count() == 7 and B.limit_baskets(df, 2, "id").count() == 2
    assert B.long_baskets(df, ["id"]).count() == 13

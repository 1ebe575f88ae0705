import math
import random
import re
from collections import Counter

from pyspark.sql import functions as F

from salesweft.llm import quality_rules
from tests.llm import cases


def brute(text):
    text = text or ""
    words = cases.words(text)
    windows = Counter(tuple(words[k : k + 3]) for k in range(len(words) - 2))
    covered = {k + d for k in range(len(words) - 2) if windows[tuple(words[k : k + 3])] > 1 for d in range(3)}
    lines = [x for x in text.split("\n") if cases.words(x)]
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), failed


def test_base_counts_match_brute_force(spark):
    rows = cases.texts() + [(90, "a b c " * 40), (91, "a b c a b c x"), (92, "# $%\n# $%\n \n \nx|<>&"), (93, "same same same same"), (94, "\x0bé\x0c日本 \x85 x")]
    found = quality_rules.quality_rules(cases.documents(spark, rows)).collect()
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in found) == Counter((i, *brute(t)) for i, t in rows)
    assert not any(r.kept and r.base_failed for r in found)


def test_distance_is_jensen_shannon(spark):
    p, q = [0.5, 0.25, 0.25, 0.0], [0.1, 0.0, 0.4, 0.5]
    m = [(a + b) / 2 for a, b in zip(p, q)]
    want = math.sqrt(sum((a * math.log2(a / c) if a else 0) + (b * math.log2(b / c) if b else 0) for a, b, c in zip(p, q, m)) / 2)
    row = spark.range(1).select(quality_rules.distance(F.array(*map(F.lit, p)), q).alias("d"), quality_rules.distance(F.array(*map(F.lit, q)), q).alias("same")).first()
    assert abs(row.d - want) < 1e-8 and row.same == 0


def test_foreign_histograms_fail(spark):
    common = "the and of to a in is it that was".split()
    rng = random.Random(4)
    good = [(i, " ".join(w for k in range(40) for w in (common[rng.randrange(10)], cases.sentence(rng, 1)))) for i in range(60)]
    bad = [(100, " ".join(f"{k}#$%&{k}*|" for k in range(120))), (101, "THE AND OF!!! " + " ".join(f"SHOUT{k}!!!" for k in range(120)))]
    docs = spark.createDataFrame([(i, t, "en") for i, t in good + bad], "doc_id long, text string, lang string")
    found = {r.doc_id: r for r in quality_rules.quality_rules(docs).collect()}
    assert not found[100].kept and not found[101].kept
    assert all(found[i].kept or found[i].base_failed for i, _ in good)
    assert sum(found[i].kept for i, _ in good) > 40


def test_no_language_and_empty_table(spark):
    docs = cases.documents(spark)
    assert quality_rules.quality_rules(docs.withColumn("lang", F.lit(None).cast("string"))).count() == docs.count()
    assert quality_rules.quality_rules(docs.limit(0)).count() == 0


def test_references_cover_all_documents_and_languages(spark):
    rng = random.Random(7)
    words = [f"w{k}" for k in range(30)]
    rows = [(i, " ".join(rng.choice(words) for _ in range(80)), "en") for i in range(3000)]
    rows += [(5000 + i, " ".join(f"{i}x{rng.randrange(9)}" for _ in range(80)), f"l{i}") for i in range(36)]
    found = quality_rules.language_references(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert set(found.classes) == {r[2] for r in rows}
    seen = Counter(w for _, t, lang in rows if lang == "en" for w in t.split())
    top = {w for w, _ in sorted(seen.items(), key=lambda x: (-x[1], x[0]))[:12]}
    total = sum(seen[w] for w in found.vocabulary)
    assert top <= set(found.vocabulary)
    assert all(abs(p - seen[w] / total) < 1e-12 for w, p in zip(found.vocabulary, found.common["en"]))


def test_language_without_reference_abstains(spark):
    docs = spark.createDataFrame([(1, " ".join(f"{k}#{k}$%" for k in range(120)), lang) for lang in ("en", "xx", None)], "doc_id long, text string, lang string")
    references = quality_rules.References([], {"en": [0.0, 0.0, 0.0, 0.0, 0.2, 0.0, 0.8]}, {"en": []})
    found = {r.kept for r in quality_rules.judged(docs.where("lang = 'xx'"), references).collect()}
    assert found == {True}
    assert not any(r.kept for r in quality_rules.judged(docs.where("lang = 'en' OR lang IS NULL"), references).collect())

"""Quality classifier and language identification: held-out accuracy, folds and odd rows."""

import math
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from salesweft.llm import language_id, quality_model
from tests.llm import cases


def fold(i, parts):
    return zlib.crc32(str(i).encode()) % parts


def labelled(n=600, seed=5):
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        good = rng.random() < 0.7
        words = cases.sentence(rng, rng.randint(20, 80)).split()
        docs.append((i, " ".join(words) if good else " ".join(w + rng.choice(["!!", "$$$", " |"]) for w in words)))
        labels.append((i, int(good), 0))
    return docs, labels


def test_held_out_accuracy_and_folds(spark):
    docs, labels = labelled()
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    found = {r.doc_id: r for r in quality_model.quality_scores(cases.documents(spark, docs), table).collect()}
    truth = {i: q for i, q, _ in labels}
    assert all(r.held_out == (fold(i, 3) == 1) for i, r in found.items())
    held = [i for i in truth if found[i].held_out]
    assert sum(found[i].predicted == truth[i] for i in held) > 0.95 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in found.values())


def test_held_out_labels_are_not_read(spark):
    docs, labels = labelled(200)
    frame = cases.documents(spark, docs)
    flipped = [(i, 1 - q if fold(i, 3) == 1 else q, t) for i, q, t in labels]
    one, two = ({r.doc_id: r.score for r in quality_model.quality_scores(frame, spark.createDataFrame(x, "doc_id long, quality int, toxic int")).collect()} for x in (labels, flipped))
    assert one == two


def test_odd_rows_get_scores(spark):
    rows = cases.texts()
    labels = spark.createDataFrame([(0, 1, 0), (0, 0, 0), (1, None, 0), (None, 1, 0), (2, 1, 0)], "doc_id long, quality int, toxic int")
    docs = cases.documents(spark, rows)
    assert quality_model.quality_scores(docs, labels).count() == len(rows)
    assert {r.score for r in quality_model.quality_scores(docs, labels.limit(0)).collect()} == {0.5}
    assert quality_model.quality_scores(docs.limit(0), labels).count() == 0
    kept = quality_model.scored(docs.drop("score"), np.zeros((1 << quality_model.BITS) + 1))
    assert kept.columns == [*docs.drop("score").columns, "score"]


def test_features_do_not_depend_on_the_batch():
    texts = [t for _, t in cases.texts()]
    owner, found, value = quality_model.features(pa.array(texts))
    for n in (0, 5, len(texts) - 1, 27):
        alone = quality_model.features(pa.array([texts[n]]))
        assert sorted(zip(found[owner == n], value[owner == n])) == sorted(zip(alone[1], alone[2]))


def test_ftrl_separates():
    rng = np.random.default_rng(1)
    rows = [(float(y), np.array([y, 5]), np.ones(2, np.float32)) for y in rng.integers(0, 2, 400)]
    w = quality_model.ftrl(rows)
    assert w[1] + w[5] + w[-1] > 1 and w[0] + w[5] + w[-1] < -1


LANGUAGES = {"aa": "abcd", "bb": "éfgh", "cc": "мнопр"}


def language_rows(n=300, seed=6):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        lang = rng.choice(list(LANGUAGES))
        letters = LANGUAGES[lang] + "xyz"
        out.append((i, " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 8))) for _ in range(rng.randint(3, 60))), lang))
    return out


def test_languages_held_out_and_und(spark):
    rows = language_rows()
    extra = [(1001, None, "aa"), (1002, "12 34 !?", "bb"), (1003, "", None), (None, "abcd abcd", "aa"), (1004, rows[0][1], None), (1005, "ABCD ABAB", None)]
    cases.importable(spark)
    docs = spark.createDataFrame(rows + extra, "doc_id long, text string, lang string")
    found = language_id.language_ids(docs).collect()
    by = {r.doc_id: r for r in found}
    assert len(found) == len(rows) + len(extra)
    held = [r for r in rows if fold(r[0], 5) == 0]
    assert held and all(by[i].held_out for i, _, _ in held)
    assert sum(by[i].lang_pred == lang for i, _, lang in held) > 0.95 * len(held)
    assert all(by[i].lang_pred == "und" and by[i].score == 0 for i in (1001, 1002, 1003))
    assert by[1005].lang_pred == "aa"
    assert all(0 <= r.score <= 1 for r in found)


def test_nothing_learned_and_empty_table(spark):
    docs = cases.documents(spark)
    found = language_id.language_ids(docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r.lang_pred for r in found} == {"und"}
    assert language_id.language_ids(docs.limit(0)).count() == 0


def plain_ftrl(rows, epochs=quality_model.EPOCHS, alpha=0.5, beta=1.0, l1=0.02, l2=0.05):
    """One feature at a time, with dictionaries."""
    z, n = {}, {}

    def weight(f):
        s = z.get(f, 0.0)
        if abs(s) <= l1:
            return 0.0
        return (math.copysign(l1, s) - s) / ((beta + math.sqrt(n.get(f, 0.0))) / alpha + l2)

    for _ in range(epochs):
        for label, features in rows:
            x = {**features, "bias": 1.0}
            w = {f: weight(f) for f in x}
            p = 1 / (1 + math.exp(-max(-35.0, min(35.0, sum(w[f] * v for f, v in x.items())))))
            for f, v in x.items():
                g = (p - label) * v
                step = (math.sqrt(n.get(f, 0.0) + g * g) - math.sqrt(n.get(f, 0.0))) / alpha
                z[f] = z.get(f, 0.0) + g - step * w[f]
                n[f] = n.get(f, 0.0) + g * g
    return {f: weight(f) for f in z if weight(f)}


def sparse_rows(texts):
    owner, found, value = quality_model.features(pa.array(texts))
    rows = [{} for _ in texts]
    for o, f, v in zip(owner.tolist(), found.tolist(), value.tolist()):
        rows[o][f] = rows[o].get(f, 0.0) + v
    return rows


def test_ftrl_equals_plain_updates():
    docs, labels = labelled(60)
    rows = sparse_rows([t for _, t in docs])
    got = quality_model.ftrl([(q, np.array(list(r), np.int64), np.array(list(r.values()))) for (_, q, _), r in zip(labels, rows)])
    want = plain_ftrl([(q, r) for (_, q, _), r in zip(labels, rows)])
    assert np.isclose(got[-1], want.pop("bias"))
    used = np.flatnonzero(got[:-1])
    assert set(used) == set(want) and np.allclose(got[used], [want[f] for f in used])
    scores = quality_model.scores(pa.array([t for _, t in docs]), got)
    for s, r in zip(scores, rows):
        assert np.isclose(s, 1 / (1 + math.exp(-(got[-1] + sum(got[f] * v for f, v in r.items())))))


def test_trained_weights_are_the_mean_of_plain_shards(spark):
    docs, labels = labelled(90)
    got = quality_model.train(cases.documents(spark, docs), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    keys = spark.createDataFrame(docs, "id long, text string").selectExpr("id", "text", "pmod(xxhash64(2, id), 8) AS shard", "xxhash64(3, id, text) AS place")
    truth = {i: q for i, q, _ in labels}
    shards = {}
    for r in keys.orderBy("place").collect():
        shards.setdefault(r["shard"], []).append((truth[r["id"]], sparse_rows([r["text"]])[0]))
    total = {}
    for rows in shards.values():
        for f, w in plain_ftrl(rows).items():
            total[f] = total.get(f, 0.0) + w / len(shards)
    assert np.isclose(got[-1], total.pop("bias"), atol=1e-5)
    used = np.flatnonzero(np.abs(got[:-1]) > 1e-6)
    assert np.allclose(got[used], [total.get(int(f), 0.0) for f in used], atol=1e-4)


def languages(n=24, per=6, seed=8):
    """Documents of many invented languages, each with an alphabet of its own, and some that share one."""
    rng = random.Random(seed)
    letters = [chr(0x3B1 + k) for k in range(24)] + list("abcdefghijklmnopqrstuvwxyz")
    alphabets = [rng.sample(letters, 9) for _ in range(n)]
    say = lambda a: " ".join("".join(rng.choice(a) for _ in range(rng.randint(2, 7))) for _ in range(rng.randint(30, 60)))
    return [(k * per + i, say(a), f"l{k:03d}") for k, a in enumerate(alphabets) for i in range(per)]


def plain_bayes(train, text):
    """Log posterior per language with dictionaries of bucket counts."""
    counts, docs = {}, {}
    for t, lang in train:
        docs[lang] = docs.get(lang, 0) + 1
        for _, b in zip(*language_id.ngram_buckets(pa.array([t.lower()]))):
            counts.setdefault(lang, {})[int(b)] = counts.get(lang, {}).get(int(b), 0) + 1
    out = {}
    for lang, seen in counts.items():
        total = sum(seen.values()) + language_id.SMOOTHING * (1 << language_id.BITS)
        log = math.log(docs[lang])
        for _, b in zip(*language_id.ngram_buckets(pa.array([text.lower()]))):
            log += math.log((seen.get(int(b), 0) + language_id.SMOOTHING) / total)
        out[lang] = log
    return out


def test_bayes_equals_plain_counts_on_odd_tables(spark):
    rows = languages(6) + [(500, None, "l000"), (501, "", "l001"), (502, "x" * 30_000, "l002"), (None, "αβγ δε", "l003"), (504, "Tie tie", None), (503, "123 !", "l004")]
    frame = spark.createDataFrame([(i, t, l, "a", 1, 0.5) for i, t, l in rows], "doc_id long, text string, lang string, id string, bucket int, score double").repartition(3)
    model = language_id.train(frame)
    known = [(t, l) for _, t, l in rows if t is not None and l is not None]
    got = {r["doc_id"]: r for r in language_id.identified(frame, model).collect()}
    assert len(got) == len(rows) and got[500]["lang_pred"] == got[501]["lang_pred"] == got[503]["lang_pred"] == "und"
    for i, t, _ in [*rows[::7], rows[-2]]:
        logs = plain_bayes(known, t)
        best = max(sorted(logs), key=lambda x: logs[x])
        assert got[i]["lang_pred"] == best
        assert np.isclose(got[i]["score"], 1 / sum(math.exp(v - logs[best]) for v in logs.values()), atol=1e-3)


def test_every_language_is_learned(spark, monkeypatch):
    rows = languages(90)
    frame = cases.documents(spark, [(i, t) for i, t, _ in rows]).drop("lang").join(spark.createDataFrame([(i, l) for i, _, l in rows], "doc_id long, lang string"), "doc_id")
    model = language_id.train(frame)
    assert len(model.languages) == 90
    truth = {i: l for i, _, l in rows}
    found = language_id.identified(frame, model).collect()
    assert sum(r.lang_pred == truth[r.doc_id] for r in found) > 0.97 * len(found)
    monkeypatch.setattr(language_id, "MAX_LANGUAGES", 89)
    with pytest.raises(ValueError, match="languages"):
        language_id.train(frame)


def test_a_batch_size_of_the_session_stays(spark):
    from salesweft import session

    before = spark.conf.get(session.BATCH_BYTES)
    try:
        spark.conf.set(session.BATCH_BYTES, "64m")
        session.importable(spark)
        assert spark.conf.get(session.BATCH_BYTES) == "64m"
        assert language_id.language_ids(cases.documents(spark)).count() == len(cases.texts())
        spark.conf.set(session.BATCH_BYTES, "64m")
        spark.conf.unset(session.BATCH_BYTES)
        session.importable(spark)
        assert spark.conf.get(session.BATCH_BYTES) in ("8388608", "8388608b")
    finally:
        spark.conf.set(session.BATCH_BYTES, before)

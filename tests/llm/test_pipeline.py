from collections import Counter

import corpus_pipeline
from salesweft.llm import queries
from salesweft.llm.columns import table
from salesweft.session import written
from tests.llm import cases
from tests.llm.test_exact_dedup import brute as exact
from tests.llm.test_ngram_join import brute as near


def test_stages_against_brute_force(spark, data):
    docs = table(spark, data, "documents")
    columns, frames = docs.columns, {"documents": docs}
    for name, stage in corpus_pipeline.STAGES:
        docs = frames[name] = written(stage(spark, docs, data), "test-stage")
        if name != "pack":
            assert docs.columns == columns
    names = list(frames)
    rows = {n: [(r.doc_id, r.text) for r in frames[n].collect()] for n in names[:-1]}
    # Each stage keeps some of its predecessor's rows, unchanged.
    for before, after in zip(names, names[1:-1]):
        assert not Counter(rows[after]) - Counter(rows[before])
        assert 0 < len(rows[after]) <= len(rows[before])
    labels = {r.doc_id: r for r in table(spark, data, "labels").collect()}
    kept = {i for i, _ in rows["quality_filter"]}
    good = [i for i, r in labels.items() if r.quality == 1]
    assert sum(i in kept for i in good) > 0.97 * len(good)
    assert {i for i, _ in rows["drop_copies"]} == {i for i, _, _, stays, _ in exact(rows["quality_filter"]) if stays}
    assert len(rows["drop_near_copies"]) == len(near(rows["drop_copies"])[1])
    clean = {i for i, r in labels.items() if r.quality == 1 and r.toxic == 0} & {i for i, _ in rows["drop_near_copies"]}
    mixed = {i for i, _ in rows["mix_domains"]}
    assert len(clean & mixed) > 0.97 * len(clean)
    assert {r.doc_id for r in frames["pack"].collect()} == mixed
    whole = corpus_pipeline.run(spark, data).collect()
    key = lambda r: (r.doc_id, r.piece, r.length, r.ids_crc32)
    assert Counter(map(key, whole)) == Counter(map(key, frames["pack"].collect()))


def test_rejected_documents_go(spark):
    folder = "/root/testdata/sf0.01"
    kept = {r.doc_id for r in corpus_pipeline.quality_filter(spark, table(spark, folder, "documents"), folder).collect()}
    labels = table(spark, folder, "labels").collect()
    low, good = ({r.doc_id for r in labels if r.quality == q} for q in (0, 1))
    assert len(low & kept) < 0.3 * len(low) and len(good & kept) > 0.97 * len(good)


def test_one_query_per_operator():
    numbers = sorted(int(name[2:].split("_")[0]) for name in queries.QUERIES)
    assert numbers == list(range(1, 14)) and set(queries.SQL) <= set(queries.QUERIES)


def test_stages_take_an_empty_table(spark, data):
    docs = table(spark, data, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, data).count() == 0
    assert cases.documents(spark).count()

import os

import corpus_pipeline
from habispark.llm import minhash
from habispark.llm.oracles import ORACLES
from habispark.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"


def test_stages_keep_the_columns_of_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, left = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.stored(stage(spark, docs, SMALL), name.replace(" ", "-"))
        assert docs.columns == columns
        assert docs.count() <= left
        left = docs.count()
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL)
    assert {r.doc_id for r in packed.select("doc_id").collect()} == {r.doc_id for r in docs.select("doc_id").collect()}
    assert sorted(map(str, corpus_pipeline.run(spark, SMALL).collect())) == sorted(map(str, packed.collect()))


def test_one_query_per_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
    assert set(ORACLES) <= set(QUERIES)
    assert os.path.isdir(SMALL)


def test_near_copies_at_eighty_percent_go(spark):
    docs = []
    for k in range(40):
        words = [f"a{k}x{i}" for i in range(104)]
        # 12 of 100 shingles differ on each side: 88 of 112 is below 80 %; 11 of 100: 89 of 111 is just above.
        for n, place in enumerate((100, 11, 12)):
            text = list(words)
            if n:
                text[:place] = [f"b{k}x{i}" for i in range(place)]
            docs.append((10 * k + n, " ".join(text)))
    table = spark.createDataFrame([d for d in docs if d[0] % 10 < 2], "doc_id long, text string")
    left = {r.doc_id for r in corpus_pipeline.drop_near_copies(spark, table, SMALL).collect()}
    assert left == {10 * k for k in range(40)}
    table = spark.createDataFrame([d for d in docs if d[0] % 10 != 1], "doc_id long, text string")
    left = {r.doc_id for r in corpus_pipeline.drop_near_copies(spark, table, SMALL).collect()}
    assert left == {10 * k + n for k in range(40) for n in (0, 2)}


def test_bands_follow_the_threshold():
    for threshold in (70, 80, 85, 95):
        bands, rows = minhash.banding(threshold)
        assert (1 - (threshold / 100) ** rows) ** bands <= 1e-6
    assert minhash.banding(85) == (36, 7)

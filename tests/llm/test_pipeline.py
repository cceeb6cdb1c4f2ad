import os

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as C
from shelfrisk.llm import mixing, queries
from tests.llm import test_jaccard, test_suffixdup

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables not present")


def test_each_stage_against_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    before = {r.doc_id: r for r in docs.collect()}
    for number, (name, stage) in enumerate(C.STAGES):
        stage(spark, docs, FOLDER).write.parquet(f"{tmp_path}/{number}")
        docs = spark.read.parquet(f"{tmp_path}/{number}")
        rows = docs.collect()
        if name != "bpe":
            assert docs.columns == C.COLUMNS and docs.dtypes == spark.read.parquet(f"{FOLDER}/documents.parquet").dtypes
        if name == "toxicity":
            verdict = {r.doc_id: r.predicted for r in queries.op4_toxicity(spark, FOLDER).collect()}
            assert {r.doc_id for r in rows} == {d for d, p in verdict.items() if not p} and all(before[r.doc_id] == r for r in rows)
        elif name == "ngram_jaccard":
            classes = test_jaccard.brute([(r.doc_id, r.text) for r in before.values()], 5, 80)
            assert {r.doc_id for r in rows} == {d for d, (_, least) in classes.items() if d == least}
        elif name == "suffix_dedup":
            kept = test_suffixdup.brute([(r.doc_id, r.text) for r in before.values()], 100)
            assert {r.doc_id: r.text for r in rows} == {d: k[0].decode(errors="ignore") for d, k in kept.items()}
        elif name == "mix_sources":
            assert {r.doc_id for r in rows} <= set(before) and all(before[r.doc_id] == r for r in rows)
        else:
            assert {(r.doc_id, r.n_bytes) for r in rows} == {(d, len((t.text or "").encode())) for d, t in before.items()}
        before = {r.doc_id: r for r in rows}
    assert C.run(spark, FOLDER).count() == len(rows)


def test_empty_documents_and_null_rows(spark, tmp_path):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    schema = spark.read.parquet(f"{FOLDER}/documents.parquet").schema
    for number, rows in enumerate(([], [(None, None, None, None, None), (1, "a b", "en", "s", 3), (1, "a b", "en", "s", 3)])):
        docs = spark.createDataFrame(rows, schema)
        for _, stage in C.STAGES[1:]:
            docs = stage(spark, docs, str(tmp_path))
        assert {r.n_tokens for r in docs.collect()} == ({2} if rows else set())


def test_near_copies_go_by_five_words(spark):
    """Fifty words with one changed share 80.4 % of their five-word shingles and 84.3 % of their four-word shingles."""
    text = [f"w{i}" for i in range(50)]
    rows = [(1, " ".join(text), "en", "s", 1), (2, " ".join([*text[:25], "edited", *text[26:]]), "en", "s", 1), (3, "quite another text", "en", "s", 1)]
    assert {d: least for d, (_, least) in test_jaccard.brute([r[:2] for r in rows], 4, 85).items()} == {1: 1, 2: 2, 3: 3}
    classes = test_jaccard.brute([r[:2] for r in rows], 5, 80)
    docs = spark.createDataFrame(rows, spark.read.parquet(f"{FOLDER}/documents.parquet").schema)
    got = {r.doc_id for r in C.one_of_each_group(spark, docs, FOLDER).collect()}
    assert got == {d for d, (_, least) in classes.items() if d == least} == {1, 3}


def test_mixing_tells_missing_ids_and_leaves_apart(spark):
    """A language of weight 0 stays out, also rows of it that share an id with taken ones; a missing id is not -1."""
    schema = spark.read.parquet(f"{FOLDER}/documents.parquet").schema
    rows = [(None, "a b c d", "en", "s1", 7), (-1, "a b c d", "xx", "s1", 7), (7, "e f g h", "en", "s1", 7), (7, "e f g h", "xx", "s1", 7)]
    docs = spark.createDataFrame(rows, schema)
    weights = {"lang": {"xx": 0}}
    taken = mixing.mix(docs.withColumn("domain", F.expr(queries.DOMAIN)), ["domain", "lang", "source"], weights)
    assert {(r.doc_id, r.lang) for r in taken.collect()} == {(None, "en"), (7, "en")}
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(C, "WEIGHTS", weights)
        got = C.mix_sources(spark, docs, FOLDER).collect()
    assert {(r.doc_id, r.lang) for r in got} == {(None, "en"), (7, "en")} and len(got) == taken.count()

import pytest
from corpus import documents, rows
from pyspark.sql import functions as F
from test_decontaminate import brute as overlaps
from test_exact_dedup import digest
from test_ngram_join import expected as components

import corpus_pipeline
from quadrille.llm.queries import toxicity_model
from quadrille.llm.toxicity import score_toxicity

NAMES = ["reject_toxic", "exact_dedup", "near_dedup", "decontaminate", "mix"]


def test_stages_against_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    assert [n for n, _ in corpus_pipeline.STAGES] == NAMES
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = spark.createDataFrame(stage(spark, docs, sf_dir).toPandas(), docs.schema)
        assert out.columns == docs.columns
        before = {r["doc_id"]: r["text"] for r in docs.collect()}
        after = {r["doc_id"] for r in out.collect()}
        if name == "reject_toxic":
            model = toxicity_model(spark, docs, sf_dir)
            want = {r["doc_id"] for r in score_toxicity(docs, model).where("predicted = 0").collect()}
        elif name == "exact_dedup":
            first = {}
            for i in sorted(before):
                first.setdefault(digest(before[i]), i)
            want = set(first.values())
        elif name == "near_dedup":
            want = {i for i, (_, c) in components(list(before.items())).items() if c == i}
        else:
            want = set()
            for i, t in before.items():
                n, hit, _, _ = overlaps(t, items)
                if not (hit > 0 and 20 * hit >= n):
                    want.add(i)
        assert after == want, name
        docs = out
    mixed = corpus_pipeline.run(spark, sf_dir).collect()
    assert {r["doc_id"] for r in mixed} == {r["doc_id"] for r in docs.collect()}
    assert all(r["taken"] <= 2 * r["size"] for r in mixed)


@pytest.mark.parametrize("name", NAMES)
def test_awkward_and_empty_documents(spark, sf_dir, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    docs = documents(spark)
    out = stage(spark, docs, sf_dir)
    if name != "mix":
        assert out.columns == docs.columns
    assert 0 < out.count() <= len(rows())
    assert stage(spark, docs.where(F.lit(False)), sf_dir).count() == 0


INNER = "__maybe __at __again __won __nth __digest __own __gone __lost __id __word __bit __part __pair __best __source doc row sha c0 c1 text_hi grp".split()


@pytest.mark.parametrize("stage", [s for s in corpus_pipeline.STAGES if s[0] != "mix"], ids=lambda s: s[0])
def test_stages_keep_columns_of_any_name(spark, sf_dir, stage):
    given = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(60)
    docs = given.select(*[F.concat(F.lit(f"{n}-"), F.col("doc_id").cast("string")).alias(n) for n in INNER], "*")
    plain = {r["doc_id"] for r in stage[1](spark, given, sf_dir).collect()}
    out = stage[1](spark, docs, sf_dir)
    assert out.columns == docs.columns
    found = out.collect()
    assert {r["doc_id"] for r in found} == plain and len(found) == len(plain)
    assert all(r[n] == f"{n}-{r['doc_id']}" for r in found for n in INNER)

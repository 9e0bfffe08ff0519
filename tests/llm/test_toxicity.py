import math
import random

import numpy as np
import pyarrow as pa
import pytest
from corpus import SCHEMA, documents, rows

from quadrille.llm import toxicity
from quadrille.llm.toxicity import SIZES, drop_toxic, fit, fit_on, score_toxicity, scores


def toy(n=300, seed=4):
    draw = random.Random(seed)
    texts, labels = [], []
    for i in range(n):
        w = ["".join(draw.choice("abcde") for _ in range(draw.randint(2, 7))) for _ in range(30)]
        labels.append(int(i % 4 == 0))
        if labels[-1]:
            w[draw.randrange(30)] = draw.choice(["vileword", "NASTYism"])
        texts.append(" ".join(w))
    return texts, np.array(labels)


def test_separates_and_matches_brute_force():
    texts, labels = toy()
    model = fit(pa.array(texts), labels, np.ones(len(texts)))
    probe, truth = toy(seed=9)
    probe += ["", "vile", "\tVILEWORD\n", "x" * 3000]
    (_, found), = scores(pa.array(probe), model)
    keys = {int(k): float(w) for k, w in zip(model.keys, model.weights, strict=True)}
    for t, s in zip(probe, found, strict=True):
        data = bytes(32 if b in range(9, 14) else b + 32 if 65 <= b <= 90 else b for b in t.encode())
        grams = {int.from_bytes(data[i : i + n], "little") | n << 56 for n in SIZES for i in range(len(data) - n + 1)}
        z = model.bias + sum(keys[g] for g in grams if g in keys)
        assert s == pytest.approx(1 / (1 + math.exp(-z)), rel=1e-6)
    assert ((found[: len(truth)] >= 0.5) == truth).mean() > 0.97


def test_cases(spark):
    texts, labels = toy(80)
    model = fit(pa.array(texts), labels, np.ones(len(texts)))
    found = score_toxicity(documents(spark), model).collect()
    assert len(found) == len(rows()) and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in found)
    left = drop_toxic(documents(spark), model)
    assert left.columns == documents(spark).columns and left.count() == sum(1 - r["predicted"] for r in found)
    none = spark.createDataFrame([], SCHEMA)
    assert score_toxicity(none, model).collect() == [] and drop_toxic(none, model).collect() == []


def test_fit_without_both_labels(spark):
    docs = documents(spark)
    for marks in ([], [(1, 0), (2, 0)], [(1, None), (None, 1)], [(1, 1), (1, 0)]):
        model = fit_on(docs, spark.createDataFrame(marks, "doc_id bigint, toxic int"))
        assert len(model.keys) == 0
        assert score_toxicity(docs, model).count() == len(rows())


def test_held_out_auc(spark, sf_dir):
    from quadrille.llm.queries import op4_toxicity

    big = sf_dir.replace("sf0.001", "sf0.1")
    marks = spark.read.parquet(f"{big}/labels.parquet").select("doc_id", "toxic")
    found = op4_toxicity(spark, big).where("held_out").join(marks, "doc_id").select("score", "toxic").toPandas()
    rank = found["score"].rank()
    ones = found["toxic"] == 1
    auc = (rank[ones].sum() - ones.sum() * (ones.sum() + 1) / 2) / (ones.sum() * (~ones).sum())
    assert auc > 0.95
    assert (found["score"][~ones] >= 0.5).mean() < 0.02


def test_fit_against_plain_newton():
    """The kept n-grams' log-count ratios from their definition, and the regression's optimum in double precision."""
    texts, labels = toy(240)
    weight = np.where(labels == 1, 0.4, 1.7)
    model = fit(pa.array(texts), labels, weight, features=80)
    sets = []
    for t in texts:
        data = t.lower().encode()
        sets.append({int.from_bytes(data[i : i + n], "little") | n << 56 for n in SIZES for i in range(len(data) - n + 1)})
    keys = [int(k) for k in model.keys]
    assert 10 < len(keys) <= 80 and all(any(k in s for s in sets) for k in keys)
    w = weight / weight.mean()
    held = np.array([[k in s for k in keys] for s in sets], float)
    p, q = (1 + (w * (labels == k)) @ held for k in (1, 0))
    ones, zeros = w[labels == 1].sum(), w[labels == 0].sum()
    ratio = np.log((p / (ones + 2)) / (q / (zeros + 2)))
    x = np.column_stack([held * ratio, np.ones(len(texts))])
    penalty = np.append(np.full(len(keys), 2.0), 1e-6)
    beta = np.zeros(len(penalty))
    for _ in range(200):
        mu = 1 / (1 + np.exp(-x @ beta))
        slope = x.T @ (w * (mu - labels)) + penalty * beta
        beta -= 0.5 * np.linalg.solve((x * (w * mu * (1 - mu))[:, None]).T @ x + np.diag(penalty), slope)
    assert model.bias == pytest.approx(beta[-1], abs=0.02)
    assert model.weights == pytest.approx(beta[:-1] * ratio, abs=0.02)


def test_labels_of_long_texts_alone_are_learned(spark):
    good, bad = "calm and kind words here " * 45_000, "vile hateful filth there " * 45_000
    docs = spark.createDataFrame([(i, good if i % 2 else bad) for i in range(16)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, (i + 1) % 2) for i in range(16)], "doc_id bigint, toxic int")
    model = toxicity.fit_on(docs, labels)
    asked = spark.createDataFrame([(1, "kind words, calm words"), (2, "hateful filth, vile")], "doc_id bigint, text string")
    found = {r["doc_id"]: r["score"] for r in toxicity.score_toxicity(asked, model).collect()}
    assert found[1] < 0.5 < found[2]

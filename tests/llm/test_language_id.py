import math
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
from corpus import SCHEMA, documents, rows
from pyspark.sql import functions as F

from quadrille.llm.language_id import code_lengths, fit, fit_on, identify

TRAIN = {"xx": ["the cat sat on the mat", "a cat", ""], "yy": ["der hund saß auf der Matte", "ein Hund"], "zz": ["q"]}


class Brute:
    """Order-3 PPM, method C with exclusions, one byte at a time."""

    def __init__(self, texts):
        self.counts = defaultdict(Counter)
        for t in texts:
            data = [None] * 3 + list(t.lower().encode()) if t.isascii() else [None] * 3 + list(bytes(b + 32 if 65 <= b <= 90 else b for b in t.encode()))
            for i in range(3, len(data)):
                for order in range(4):
                    self.counts[tuple(data[i - order : i])][data[i]] += 1

    def bits(self, text):
        data = [None] * 3 + list(bytes(b + 32 if 65 <= b <= 90 else b for b in text.encode()))
        total = 0.0
        for i in range(3, len(data)):
            gone, p = set(), 1.0
            for order in (3, 2, 1, 0):
                c = {s: n for s, n in self.counts.get(tuple(data[i - order : i]), {}).items() if s not in gone}
                if not c:
                    continue
                n, d = sum(c.values()), len(c)
                if data[i] in c:
                    p *= c[data[i]] / (n + d)
                    break
                p *= d / (n + d)
                gone |= set(c)
            else:
                p /= 256 - len(gone)
            total -= math.log2(p)
        return total


def test_code_lengths_against_brute_force():
    model = fit(TRAIN)
    brutes = {k: Brute(v) for k, v in TRAIN.items()}
    probe = ["the cat", "der Hund", "", "qqq", "Zebra ß 日本", "saß auf THE mat " * 5]
    (first, bits), = code_lengths(pa.array(probe), model)
    assert first == 0
    for i, t in enumerate(probe):
        for k, lang in enumerate(model.langs):
            assert bits[i, k] == pytest.approx(brutes[lang].bits(t), rel=1e-5, abs=1e-4)


def test_predictions_and_cases(spark):
    model = fit(TRAIN)
    docs = spark.createDataFrame([(1, "the mat"), (2, "der hund"), (3, None), (4, "123 !"), (5, ""), (5, "")], "doc_id int, text string")
    found = {r["doc_id"]: r for r in identify(docs, model).collect()}
    assert found[1]["lang_pred"] == "xx" and found[2]["lang_pred"] == "yy"
    assert all(found[i]["lang_pred"] == "und" and found[i]["score"] == 0 for i in (3, 4, 5))
    assert all(0 <= r["score"] <= 1 for r in found.values())
    assert identify(documents(spark), model).count() == len(rows())
    assert identify(spark.createDataFrame([], SCHEMA), model).collect() == []
    assert {r["lang_pred"] for r in identify(docs, fit({})).collect()} == {"und"}


def test_fit_learns_every_language_from_bounded_samples(spark):
    docs = spark.createDataFrame([(i, f"text number {i}", "a" if i % 50 else "b") for i in range(400)] + [(900, "c", None)], "doc_id int, text string, lang string")
    assert [m.langs for m in fit_on(docs, rows=20)] == [["a", "b"]]
    assert [m.langs for m in fit_on(docs, rows=20, together=1)] == [["a"], ["b"]]
    assert list(fit_on(docs.where(F.lit(False)))) == []


def test_languages_are_scored_alike_in_one_table_or_several(spark):
    langs = {k: TRAIN[v] + [f"only {k}"] for k, v in zip("edcba", ["xx", "yy", "zz", "xx", "yy"], strict=True)}
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(["the mat", "der hund Saß", "only c", "q ß 日", "123", None] * 3)], "doc_id int, text string")
    whole = sorted(identify(docs, fit(langs)).collect(), key=lambda r: r["doc_id"])
    parts = sorted(identify(docs, [fit({k: v}) for k, v in langs.items()]).collect(), key=lambda r: r["doc_id"])
    for a, b in zip(whole, parts, strict=True):
        assert a["lang_pred"] == b["lang_pred"] and a["score"] == pytest.approx(b["score"], rel=1e-4)
        assert a["bits_per_byte"] == pytest.approx(b["bits_per_byte"], rel=1e-5)


def test_held_out_accuracy(spark, sf_dir):
    from quadrille.llm.queries import op2_language_id

    found = op2_language_id(spark, sf_dir.replace("sf0.001", "sf0.01"))
    truth = spark.read.parquet(f"{sf_dir.replace('sf0.001', 'sf0.01')}/documents.parquet").select("doc_id", "lang")
    row = found.where("held_out").join(truth, "doc_id").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")).alias("a")).first()
    assert row["a"] > 0.98


def test_language_of_long_texts_alone(spark):
    given = [(i, "the quick brown fox jumps over the lazy dog " * 3, "en") for i in range(5)]
    given += [(9, "der schnelle braune fuchs springt über den faulen hund " * 22_000, "de")]
    given += [(10, "über den faulen hund springt der fuchs", None), (11, "over the lazy dog jumps the fox", None)]
    docs = spark.createDataFrame(given, "doc_id bigint, text string, lang string")
    model = list(fit_on(docs))
    assert [m.langs for m in model] == [["de", "en"]]
    found = {r["doc_id"]: r["lang_pred"] for r in identify(docs, model).collect()}
    assert found == {**dict.fromkeys(range(5), "en"), 9: "de", 10: "de", 11: "en"}

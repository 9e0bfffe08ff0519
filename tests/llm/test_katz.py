import functools
import math
import time
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from corpus import SCHEMA, documents, rows, space_words
from pyspark.sql import functions as F

from quadrille.llm.katz import END, LARGE, START, K, Level, _pack, discounts, score_katz


class Brute:
    """The model from its definition, by recursion down the histories."""

    def __init__(self, texts, order=2):
        self.order = order
        self.grams = [Counter() for _ in range(order)]
        self.after = defaultdict(Counter)
        for t in texts:
            w = ["<s>"] * (order - 1) + [*space_words(t), "</s>"]
            for i in range(order - 1, len(w)):
                for k in range(order):
                    self.grams[k][tuple(w[i - k : i + 1])] += 1
                    self.after[tuple(w[i - k : i])][w[i]] += 1
        self.uni = Counter({g[0]: n for g, n in self.grams[0].items()})
        self.n = sum(self.uni.values())
        self.d = [discounts([list(g.values()).count(r) for r in range(1, K + 2)]) for g in self.grams]
        self.unknown = 1 - sum(self.p(w, ()) for w in self.uni) if self.n else 1.0

    @functools.cache
    def p(self, w, h):
        a = self.after.get(h)
        if not a:
            return self.p(w, h[1:]) if h else 1.0
        total, d = sum(a.values()), self.d[len(h)]
        if a[w]:
            return d[min(a[w], K + 1) - 1] * a[w] / total
        if not h:
            return self.unknown
        left = 1 - sum(d[min(c, K + 1) - 1] * c / total for c in a.values() if c)
        return left / (1 - sum(self.p(x, h[1:]) for x, c in a.items() if c)) * self.p(w, h[1:])

    def score(self, t):
        out, h = 0.0, ("<s>",) * (self.order - 1)
        for w in [*space_words(t), "</s>"]:
            out += math.log10(self.p(w, h))
            h = (*h, w)[1:]
        return out


def learn(i):
    return i % 3 != 0


def check(spark, given, order=2, **options):
    found = score_katz(documents(spark, given), F.col("doc_id") % 3 != 0, order=order, **options).collect()
    known = [r for r in given if r[0] is not None]
    model = Brute([r[1] for r in known if learn(r[0])], order)
    assert len(found) == len(given)
    want = defaultdict(list)
    for i, t, *_ in known:
        tokens = [*space_words(t), "</s>"]
        base = sum(math.log10((model.uni[w] + 1) / (model.n + len(+model.uni) + 1)) for w in tokens)
        want[i].append((len(tokens), sum(model.uni[w] > 0 for w in tokens), base, model.score(t)))
    got = defaultdict(list)
    for r in found:
        if r["doc_id"] is None:
            assert r["score"] is None
            continue
        assert r["train_tokens"] == model.n
        got[r["doc_id"]].append((r["n_tokens"], r["n_known"], r["base_score"], r["score"]))
    assert set(got) == set(want)
    for i in want:
        assert sorted(got[i]) == [pytest.approx(x, rel=1e-9) for x in sorted(want[i])], i
    return model


@pytest.mark.parametrize("order", [2, 3, 4])
def test_against_brute_force(spark, order):
    model = check(spark, rows(), order)
    for h in ["<s>", "alpha", "w3", "nowhere"]:
        h = ("<s>",) * (order - 2) + (h,)
        total = sum(model.p(w, h) for w in list(model.uni) if model.uni[w]) + model.p("never seen", h)
        assert total == pytest.approx(1, rel=1e-9)


@pytest.mark.parametrize("order", [2, 3])
def test_small_tables_and_parts_give_the_same_scores(spark, order):
    check(spark, rows(2), order, part_tokens=500, hot=8)


def test_rows_that_repeat_an_id_have_their_own_scores(spark):
    rest = rows()[0][2:]
    given = rows() + [(7, "alpha beta gamma", *rest), (7, "another text of seven", *rest), (1000, "not null", *rest), (5, rows()[5][1], *rest)]
    check(spark, given, 3)


def test_packing_does_not_depend_on_the_number_of_partitions(spark):
    column, train = pa.array([" ".join(f"w{i * j % 977}" for j in range(60)) for i in range(3000)]), pa.array([True] * 3000)
    ids = pa.array(range(3000), pa.int64())
    batch = pa.RecordBatch.from_arrays([ids, ids, column, train], ["key", "doc_id", "text", "train"])
    words = np.array([END, START])
    words.sort()
    none = [Level(x, np.zeros(len(x), np.int64), x, np.zeros(len(x), np.int64)) for x in (words, words[:0])]

    class Shared:
        value = none

    took = {}
    for parts in (100, 100_000):
        began = time.perf_counter()
        found = list(_pack(Shared, 2, parts)(iter([batch])))
        took[parts] = time.perf_counter() - began
        tokens = sum(len(x.as_py()) for f in found for x in f.column(1))
        assert tokens == 3000 * 61 and all(f.num_rows <= tokens for f in found)
    assert took[100_000] < 5 * took[100] + 1


def test_nothing_to_learn_from(spark):
    found = score_katz(documents(spark), F.lit(False)).where("doc_id is not null").collect()
    assert all(r["score"] == pytest.approx(0) and r["base_score"] == pytest.approx(0) and r["train_tokens"] == 0 for r in found)
    assert score_katz(spark.createDataFrame([], SCHEMA), F.lit(True)).collect() == []


def test_good_turing_discounts():
    assert all(0 < d < 1 for d in discounts([100, 40, 20, 12, 8, 6]))
    assert discounts([1, 0, 0, 0, 0, 0]).tolist() == [0.5, 0.75, 2.5 / 3, 3.5 / 4, 0.9, LARGE]

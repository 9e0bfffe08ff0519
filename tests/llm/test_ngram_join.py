import random

import pytest
from corpus import SCHEMA, documents, rows, space_words

from quadrille.llm import ngram_join
from quadrille.llm.ngram_join import drop_near_duplicates, link_components


def shingles(text):
    w = space_words(text)
    if len(w) < 5:
        return {tuple(w)} if w else set()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def expected(given):
    sets = {r[0]: shingles(r[1]) for r in given if r[0] is not None}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            met = len(sets[a] & sets[b])
            if met and 100 * met >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {i: (len(sets[i]), root(i)) for i in ids}


def check(spark, given):
    found = link_components(documents(spark, given)).collect()
    want = expected(given)
    assert len(found) == len(given)
    for r in found:
        if r["doc_id"] is None:
            assert r["component_id"] is None
        else:
            assert (r["n_shingles"], r["component_id"]) == want[r["doc_id"]], r


def test_against_brute_force(spark):
    check(spark, rows())


def test_many_near_copies_and_shared_passages(spark):
    draw = random.Random(5)
    base = [f"b{i}" for i in range(60)]
    passage = " ".join(f"p{i}" for i in range(40))
    given = []
    for i in range(90):
        w = list(base)
        for _ in range(draw.choice([0, 1, 1, 2, 3])):
            w[draw.randrange(60)] = f"n{i}x{draw.randrange(10**6)}"
        given.append((i, " ".join(w)))
    for i in range(90, 150):
        own = [f"o{draw.randrange(10**6)}" for _ in range(draw.choice([3, 5, 6, 9, 14]))]
        given.append((i, passage + " " + " ".join(own)))
    rest = rows()[0][2:]
    check(spark, [(i, t, *rest) for i, t in given])


def test_the_order_does_not_change_the_rows(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "COMMON_MIN", 2)
    check(spark, rows(3))
    monkeypatch.setattr(ngram_join, "COMMON_MIN", 10**9)
    check(spark, rows(3))


@pytest.mark.parametrize("least", [2, 6, 10**9])
def test_families_of_copies_near_the_threshold(spark, monkeypatch, least):
    monkeypatch.setattr(ngram_join, "COMMON_MIN", least)
    draw = random.Random(least)
    given = []
    for family in range(6):
        base = [f"f{family}w{i}" for i in range(draw.choice([40, 70, 90]))]
        for _ in range(60):
            w = list(base)
            for _ in range(draw.choice([0, 1, 2, 2, 3, 3, 4])):
                at = draw.randrange(len(w))
                kind = draw.random()
                if kind < 0.4:
                    w[at] = f"n{draw.randrange(40)}"
                elif kind < 0.7:
                    del w[at : at + draw.choice([1, 1, 5])]
                else:
                    w[at:at] = [f"m{draw.randrange(9)}" for _ in range(draw.choice([1, 2, 8]))]
            given.append((len(given), " ".join(w), *rows()[0][2:]))
    draw.shuffle(given)
    check(spark, given)


def test_drop_leaves_the_smallest_id_of_each_component(spark):
    out = drop_near_duplicates(documents(spark))
    assert out.columns == documents(spark).columns
    want = expected(rows())
    stay = sorted(r[0] for r in rows() if r[0] is not None and want[r[0]][1] == r[0])
    left = [r["doc_id"] for r in out.collect()]
    assert sorted(i for i in left if i is not None) == stay
    assert left.count(None) == 2


def test_empty_table(spark):
    assert link_components(spark.createDataFrame([], SCHEMA)).collect() == []

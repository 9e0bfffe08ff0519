import random
import re

import numpy as np
from corpus import SCHEMA, documents, lower, rows

from quadrille.llm.decontaminate import _slices, drop_contaminated, find_overlaps, suffix_array


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text or ""))


def brute(text, items):
    w, hit, found, best = words(text), set(), set(), 0
    for item_id, item in items:
        iw = words(item)
        size = min(13, len(iw))
        for s in range(max(1, len(iw) - 12) if iw else 0):
            for p in range(len(w) - size + 1):
                if w[p : p + size] == iw[s : s + size]:
                    hit |= set(range(p, p + size))
                    found.add("null" if item_id is None else str(item_id))
                    n = size
                    while p + n < len(w) and s + n < len(iw) and w[p + n] == iw[s + n]:
                        n += 1
                    best = max(best, n)
    return len(w), len(hit), sorted(found), best


def case():
    draw = random.Random(3)
    items = [(i, " ".join(draw.choice("abcdefg") for _ in range(n))) for i, n in enumerate([1, 2, 5, 12, 13, 14, 20, 30])]
    items += [(10, None), (11, "..."), (None, "Zulu Yankee"), (9, items[7][1]), (9, items[7][1])]
    texts = []
    for i in range(60):
        parts = [" ".join(draw.choice("abcdefghijk") for _ in range(draw.choice([0, 3, 8, 20])))]
        if draw.random() < 0.6:
            w = (draw.choice(items[3:8])[1]).upper().split()
            a = draw.randrange(len(w))
            parts += [", ".join(w[a:]), " ".join(w[:a])]
        texts.append(" ".join(parts))
    texts += ["zulu-YANKEE", None, "", "é1 日本"]
    return items, texts


def test_against_brute_force(spark):
    items, texts = case()
    rest = rows()[0][2:]
    docs = documents(spark, [(i, t, *rest) for i, t in enumerate(texts)])
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    for options in ({}, {"slice_words": 20, "shard_bytes": 300}):
        found = find_overlaps(docs, bench, **options).collect()
        assert len(found) == len(texts)
        for r in found:
            assert (r["n_words"], r["n_hit"], r["items"], r["longest"]) == brute(texts[r["doc_id"]], items), (r, texts[r["doc_id"]])
    left = {r["doc_id"] for r in drop_contaminated(docs, bench).collect()}
    for i, t in enumerate(texts):
        n, hit, _, _ = brute(t, items)
        assert (i in left) == (not (hit > 0 and 20 * hit >= n))


def test_awkward_rows_and_empty_tables(spark):
    bench = spark.createDataFrame([(1, "alpha beta")], "item_id bigint, text string")
    assert find_overlaps(documents(spark), bench).count() == len(rows())
    assert find_overlaps(spark.createDataFrame([], SCHEMA), bench).collect() == []
    none = find_overlaps(documents(spark), bench.limit(0))
    assert none.where("n_hit > 0").count() == 0 and none.count() == len(rows())
    assert drop_contaminated(documents(spark), bench.limit(0)).count() == len(rows())


def test_suffix_array_is_sorted():
    draw = np.random.default_rng(1)
    h = draw.integers(0, 3, 200).astype(np.uint64)
    bounds = [0, 50, 51, 120, 200]
    ends = np.concatenate([np.full(b - a, b) for a, b in zip(bounds, bounds[1:], strict=False)])
    order = suffix_array(h, ends, 200)
    suffixes = [tuple(h[i : ends[i]].tolist()) for i in order]
    assert suffixes == sorted(suffixes) and sorted(order) == list(range(200))


def brute_longest(text, items):
    """(words, place, item) of the longest run: first in the document, then in the benchmark."""
    w, best = words(text), (0, None, None)
    for p in range(len(w)):
        for item_id, item in items:
            iw = words(item)
            size = min(13, len(iw))
            for s in range(max(1, len(iw) - 12) if iw else 0):
                n = 0
                while p + n < len(w) and s + n < len(iw) and w[p + n] == iw[s + n]:
                    n += 1
                if n >= size and n > best[0]:
                    best = (n, p, str(item_id))
    return best


def test_repeating_texts_against_brute_force(spark):
    draw = random.Random(5)
    items = [(0, "x " * 40), (1, "x y " * 20), (2, "x " * 15 + "z"), (3, "x"), (4, "y x " * 9 + "y y"), (5, "x " * 40), (6, "z " * 5)]
    texts = ["x " * 100, "x y " * 40, "a " + "x " * 60 + "z z z z z z", "y " + "x " * 14 + "z", "x " * 12, "z " * 4 + "x", "q"]
    texts += [" ".join(draw.choice("xxxxxyz") for _ in range(60)) for _ in range(15)] + [" ".join([draw.choice(["x", "x y", "x x z"]) * 3] * 6) for _ in range(6)]
    docs = documents(spark, [(i, t, *rows()[0][2:]) for i, t in enumerate(texts)])
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    for options in ({}, {"slice_words": 30, "shard_bytes": 100}):
        for r in find_overlaps(docs, bench, **options).collect():
            text = texts[r["doc_id"]]
            assert (r["n_words"], r["n_hit"], r["items"], r["longest"]) == brute(text, items), text
            size, place, item = brute_longest(text, items)
            assert (r["longest"], r["longest_at"], r["longest_item"]) == (size, -1 if place is None else place, item), text


def test_many_equal_words_take_time_in_proportion(spark):
    import time

    docs = documents(spark, [(i, "word " * 100_000, *rows()[0][2:]) for i in range(3)])
    bench = spark.createDataFrame([(i, "word " * 1_000) for i in range(5)], "item_id bigint, text string")
    began = time.perf_counter()
    found = find_overlaps(docs, bench).collect()
    assert time.perf_counter() - began < 60
    assert {(r["n_hit"], r["longest"], r["longest_at"], r["longest_item"], len(r["items"])) for r in found} == {(100_000, 1_000, 0, "0", 5)}
    assert drop_contaminated(docs, bench).count() == 0


def test_slices_are_written_in_the_order_of_ids(spark):
    text = " ".join(f"w{k}" for k in range(20))
    bench = spark.createDataFrame([(i, text if i % 2 else f"{text} x{i}") for i in range(9, 0, -1)], "item_id bigint, text string")
    docs = documents(spark, [(1, f"a {text} b", *rows()[0][2:])])
    for words_ in (10, 100, 1000):
        slices = _slices(bench, "item_id", "text", 13, words_)
        read = slices.in_turn()
        for _ in range(2):
            held = list(read())
            assert len(held) == slices.count and [i for t in held for i in t.ids] == [str(i) for i in range(1, 10)]
        found = find_overlaps(docs, bench, slice_words=words_).first()
        assert (found["longest"], found["longest_item"], found["longest_at"]) == (20, "1", 1)
        assert found["items"] == [str(i) for i in range(1, 10)]
    none = _slices(bench.limit(0), "item_id", "text", 13, 10)
    assert none.count == 0 and list(none.in_turn()()) == []

import hashlib
from collections import Counter

import pytest
from corpus import SCHEMA, documents, lower
from pyspark.sql import functions as F

from quadrille.llm import line_dedup
from quadrille.llm.line_dedup import LineRuns, drop_common_lines, mark_common_lines

SPACES = " \t\n\x0b\x0c\r"


def key(line):
    return lower(line.strip(SPACES))


def clean(texts, least_docs=10, least_length=1):
    """What is left of each text, and how many lines it had and lost."""
    lines = [(t or "").split("\n") for t in texts]
    found = Counter(k for ls in lines for k in {key(x) for x in ls})
    common = {k for k, n in found.items() if n >= least_docs and len(k) >= least_length}
    return ["\n".join(x for x in ls if key(x) not in common) for ls in lines], [len(ls) for ls in lines], [sum(key(x) in common for x in ls) for ls in lines]


def given():
    texts = [f"Shared Line\nown {i}\n  shared line \n{'rare' if i < 9 else 'frequent'}\n\nx  end {i % 3}" for i in range(40)]
    texts += [None, "", "\n\n\n", "SHARED LINE", "shared line ", "shared\x0bline", "ends with feed\n", "\r\nshared line\r\n", "É shared", "é shared", "shared line\n" * 3000 + "last"]
    texts += ["same text\nin all copies"] * 12 + ["9 times\nonly"] * 9 + ["twice in one\ntwice in one"] * 5
    return texts


def rows(texts):
    return [(i, t, "en", "s", len(t or ""), 1, 2, "t", True, "b", 3, 4, 5, 6) for i, t in enumerate(texts)]


@pytest.mark.parametrize("settings", [{}, {"batches": 1}, {"batches": 9, "fanout": 2}, {"least_docs": 3, "least_length": 5}, {"least_docs": 1}])
def test_against_brute_force(spark, settings):
    texts = given()
    kept, sizes, dropped = clean(texts, settings.get("least_docs", 10), settings.get("least_length", 1))
    found = mark_common_lines(documents(spark, rows(texts)), **settings).collect()
    assert sorted((r.doc_id, r.n_lines, r.n_dropped, r.kept) for r in found) == sorted(zip(range(len(texts)), sizes, dropped, kept, strict=True))


def test_repeated_rows_and_null_ids_are_documents(spark):
    rest = rows(["x"])[0][2:]
    docs = documents(spark, [(None, "common\nmine", *rest)] * 6 + [(5, "common\nyours", *rest)] * 4)
    found = mark_common_lines(docs).collect()
    assert Counter((r.doc_id, r.kept, r.n_dropped) for r in found) == {(None, "mine", 1): 6, (5, "yours", 1): 4}


def test_empty_table(spark):
    assert mark_common_lines(documents(spark, [])).collect() == []
    assert drop_common_lines(documents(spark, [])).columns == documents(spark).columns


def test_drop_keeps_columns_of_any_name(spark):
    names = ["row", "hi", "lo", "text_hi", "maybe", "gone", "lines", "kept", "batch", "first", "pos", "n", "__word", "__bit", "a.b", "n_lines"]
    texts = given()
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string").select(
        *[F.concat(F.lit(f"{n}-"), F.col("doc_id").cast("string")).alias(n) for n in names], "text", "doc_id"
    )
    out = drop_common_lines(docs)
    assert out.columns == docs.columns
    kept = clean(texts)[0]
    found = out.collect()
    assert len(found) == len(texts)
    for r in found:
        assert r.text == kept[r.doc_id]
        assert [r[n] for n in names] == [f"{n}-{r.doc_id}" for n in names]


def test_runs_of_earlier_batches_decide(spark, tmp_path):
    runs = LineRuns(spark, str(tmp_path / "runs"), least_docs=4, fanout=2, buckets=3)
    every, levels = [], []
    for day in range(5):
        texts = [f"daily\nday {day}\nown {day} {i}" for i in range(2)]
        every += texts
        found = {r.doc_id: r.kept for r in mark_common_lines(documents(spark, rows(texts)), least_docs=4, runs=runs).collect()}
        expected = clean(every, least_docs=4)[0][-2:]
        assert [found[0], found[1]] == expected
        levels.append(runs.live())
    assert levels == [[(0, 0)], [(0, 1)], [(0, 1), (2, 2)], [(0, 3)], [(0, 3), (4, 4)]]
    assert runs.common().count() == 1


def test_runs_survive_a_repeated_batch_and_an_interrupted_compaction(spark, tmp_path):
    hashes = lambda words: spark.createDataFrame([(w,) for w in words], "w string").select(F.xxhash64("w").alias("hi"), F.xxhash64(F.lit(1), "w").alias("lo"))
    runs = LineRuns(spark, str(tmp_path / "runs"), least_docs=3, fanout=3, buckets=2)
    runs.add(hashes(["a", "a", "b"]), 0)
    runs.add(hashes(["a", "b", "c"]), 1)
    runs.add(hashes(["a", "b", "c"]), 1)  # again: no effect
    assert sorted(r.n for r in runs._summed(runs.live()).collect()) == [1, 2, 3]
    assert runs.common().count() == 1
    # The compacted run is written, the old ones are not deleted yet.
    runs._write(runs._summed([(0, 0), (1, 1)]), (0, 1))
    runs.close()
    later = LineRuns(spark, str(tmp_path / "runs"), least_docs=3, fanout=3, buckets=2)
    assert later.live() == [(0, 1)]
    assert later.common().count() == 1
    later.add(hashes(["b", "c", "d"]))
    assert later.live() == [(0, 1), (2, 2)]
    assert sorted(r.n for r in later._summed(later.live()).collect()) == [1, 2, 3, 3]
    assert later.common().count() == 2
    with pytest.raises(ValueError):
        later.add(hashes(["z"]), 9)


def test_settled_keys_are_not_added_again(spark, tmp_path):
    runs = LineRuns(spark, str(tmp_path / "runs"), least_docs=2, fanout=9, buckets=2)
    same = spark.createDataFrame([(1, 1)] * 5 + [(2, 2)], "hi bigint, lo bigint")
    for _ in range(3):
        runs.add(same)
    assert [runs.read(r).count() for r in runs.live()] == [2, 1, 1]
    assert sorted(tuple(r) for r in runs.common().collect()) == [(1, 1), (2, 2)]


def test_runs_are_merged_without_shuffling_them(spark, tmp_path):
    runs = LineRuns(spark, str(tmp_path / "runs"), buckets=4)
    runs.add(spark.range(1000).selectExpr("id AS hi", "-id AS lo"))
    batch = spark.range(1000).selectExpr("id AS hi", "-id AS lo")
    plan = batch.join(runs.read((0, 0)).hint("merge"), line_dedup.KEY, "left_anti")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1, plan


def test_digest_of_what_is_left(spark):
    docs = documents(spark, rows(["gone\n" * 3] * 10))
    found = mark_common_lines(docs).select(F.sha2("kept", 256).alias("h"), "n_lines", "n_dropped").distinct().collect()
    # The empty line after the last feed stays.
    assert [tuple(r) for r in found] == [(hashlib.sha256(b"").hexdigest(), 4, 3)]

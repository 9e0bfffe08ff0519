import hashlib
import re
from collections import defaultdict

from corpus import SCHEMA, documents, rows
from pyspark.sql import functions as F

from quadrille.llm.exact_dedup import drop_exact_duplicates, mark_exact_duplicates


def digest(text):
    return hashlib.sha256(re.sub(r"[\x20\x09-\x0D]+", " ", text or "").encode()).hexdigest()


def expected(given):
    groups = defaultdict(list)
    for r in given:
        groups[digest(r[1])].append(r[0])
    return groups


def check(found, given):
    groups, kept = expected(given), defaultdict(int)
    assert len(found) == len(given)
    for r in found:
        ids = groups[r["text_sha256"]]
        known = [i for i in ids if i is not None]
        assert r["group_size"] == len(ids)
        assert r["keep_id"] == (min(known) if known else None)
        if r["kept"]:
            assert r["doc_id"] == r["keep_id"]
        kept[r["text_sha256"]] += r["kept"]
    assert set(kept.values()) <= {1} and len(kept) == len(groups)


def test_against_brute_force(spark):
    check(mark_exact_duplicates(documents(spark)).collect(), rows())


def test_heavy_groups_take_the_other_way_to_the_same_rows(spark):
    given = rows() + [(2000 + i % 90, "very common", *rows()[0][2:]) for i in range(300)]
    check(mark_exact_duplicates(documents(spark, given), heavy_min=8).collect(), given)
    check(mark_exact_duplicates(documents(spark, given), heavy_min=10**9).collect(), given)


def test_drop_keeps_one_row_of_each_group(spark):
    out = drop_exact_duplicates(documents(spark))
    assert out.columns == documents(spark).columns
    left = out.collect()
    groups = expected(rows())
    assert len(left) == len(groups)
    assert {digest(r["text"]) for r in left} == set(groups)


def test_drop_with_heavy_groups_and_repeated_rows(spark):
    rest = rows()[0][2:]
    given = rows() + [(2000 + i % 90, "very common", *rest) for i in range(300)] + [(None, "very common", *rest)] * 3
    given += [(None, "only null ids", *rest)] * 4 + [(2000, "another text", *rest)] * 2
    for heavy_min in (8, 10**9):
        left = drop_exact_duplicates(documents(spark, given), heavy_min=heavy_min).collect()
        groups = expected(given)
        assert len(left) == len(groups) and {digest(r["text"]) for r in left} == set(groups)
        for r in left:
            known = [i for i in groups[digest(r["text"])] if i is not None]
            assert r["doc_id"] == (min(known) if known else None)


def test_drop_leaves_odd_column_names_alone(spark):
    docs = documents(spark).withColumn("__sha", F.lit("own")).withColumn("a.b", F.lit(1)).withColumn("__digests", F.lit(2))
    left = drop_exact_duplicates(docs)
    assert left.columns == docs.columns
    assert {r["__sha"] for r in left.collect()} == {"own"}


def test_empty_table(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert mark_exact_duplicates(none).collect() == []
    assert drop_exact_duplicates(none).collect() == []

import hashlib
import math
import re
import zlib
from collections import Counter

import pytest
from corpus import documents, lower, rows

from quadrille.llm.resampling import bucket_gains, resample


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text or ""))


def features(text, orders, buckets):
    w = words(text)
    return [zlib.crc32(" ".join(w[i : i + n]).encode()) % buckets for n in range(1, orders + 1) for i in range(len(w) - n + 1)]


def brute(given, targets, orders=3, buckets=10_000, least_words=20, percent=5, seed=42):
    docs = [(r[0], r[1]) for r in given]
    s, t = Counter(), Counter()
    for _, text in docs:
        s.update(features(text, orders, buckets))
    for text in targets:
        t.update(features(text, orders, buckets))
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets))))
    out = []
    for doc_id, text in docs:
        f = features(text, orders, buckets)
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        weight = sum(map(gain, f))
        out.append((doc_id, len(words(text)), len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((r for r in out if r[1] >= least_words), key=lambda r: (-r[4], r[0] is None, r[0] or 0, -r[3]))
    drawn = able[: len(able) * percent // 100]
    ranked = Counter((*r, k + 1) for k, r in enumerate(drawn))
    return ranked + Counter((*r, None) for r in (Counter(out) - Counter(drawn)).elements())


TARGETS = ["Alpha beta gamma, delta!", None, "", "omicron pi rho sigma tau" * 3, "日本 語 é"]


def targets(spark, given=None):
    return spark.createDataFrame([(t, 1, "w") for t in (TARGETS if given is None else given)], "text string, bucket int, w1 string")


@pytest.mark.parametrize("settings", [{}, {"orders": 1, "buckets": 7}, {"orders": 4, "percent": 50, "least_words": 5}, {"percent": 100, "least_words": 0, "seed": 7}])
def test_against_brute_force(spark, settings):
    given = rows()
    found = resample(documents(spark, given), targets(spark), **settings).collect()
    assert Counter(map(tuple, found)) == brute(given, TARGETS, **settings)


def test_ties_go_to_the_smaller_id_and_repeated_rows_are_documents(spark):
    rest = rows()[0][2:]
    given = [(i, "one two three four five " * 5, *rest) for i in [3, 3, 1, 2, None] * 20]
    found = resample(documents(spark, given), targets(spark), percent=30).collect()
    assert Counter(map(tuple, found)) == brute(given, TARGETS, percent=30)
    assert sorted(r["rank"] for r in found if r["rank"]) == list(range(1, 31))


def test_reruns_and_other_partitions_draw_the_same(spark):
    docs = documents(spark)
    once, twice = (Counter(map(tuple, resample(d, targets(spark), percent=40).collect())) for d in (docs.repartition(2), docs.repartition(11)))
    assert once == twice


def test_empty_tables(spark):
    assert resample(documents(spark, []), targets(spark)).collect() == []
    given = rows()
    found = resample(documents(spark, given), targets(spark, [])).collect()
    assert Counter(map(tuple, found)) == brute(given, [])


def test_every_bucket_has_a_gain(spark):
    counts = spark.createDataFrame([(0, 5), (3, 2)], "bucket int, n bigint")
    found = {r.bucket: r.gain for r in bucket_gains(counts, counts.limit(0), 4).collect()}
    assert found == {b: math.floor(1000 * math.log((7 + 4) / ((s + 1) * 4))) for b, s in ((0, 5), (1, 0), (2, 0), (3, 2))}


def test_words_are_not_shuffled(spark):
    """One exchange of documents below the position table; none of its rows."""
    from quadrille.llm.resampling import position_table

    docs = documents(spark).selectExpr("doc_id AS row", "doc_id", "coalesce(text, '') AS text")
    plan = position_table(docs, 3, 100)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") + plan.count("Exchange REPARTITION") <= 1 and plan.index("Generate posexplode") < plan.index("Exchange"), plan

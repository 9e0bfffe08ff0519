from collections import Counter, defaultdict

import pytest
import xxhash
from corpus import SCHEMA, documents, rows, space_words

from quadrille.llm.source_mix import mix_sources


def targets(sizes, weights=(3, 1, 2), share=1.5, cap=2.0):
    """Shares again by weight until no target is above its cap."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    capped: set = set()
    while True:
        left = share * sum(sizes.values()) - sum(cap * sizes[s] for s in capped)
        over = sum(weight[s] for s in names if s not in capped)
        out = {s: cap * sizes[s] if s in capped else left * weight[s] / over for s in names}
        more = {s for s in names if s not in capped and out[s] >= cap * sizes[s]}
        if not more:
            return out
        capped |= more


def check(spark, given, **options):
    found = mix_sources(documents(spark, given), **options).collect()
    sizes, biggest, taken = Counter(), Counter(), Counter()
    for r in given:
        n = len(space_words(r[1]))
        sizes[r[3]] += n
        biggest[r[3]] = max(biggest[r[3]], n)
    want = targets(sizes)
    by_id = defaultdict(set)
    for r in given:
        by_id[r[0]].add(len(space_words(r[1])))
    assert len(found) == len(given)
    for r in found:
        s = r["source"]
        assert r["size"] in by_id[r["doc_id"]] and r["source_size"] == sizes[s]
        assert r["target"] == pytest.approx(want[s])
        assert r["taken"] == r["copies"] * r["size"] and 0 <= r["copies"] <= 2
        rate = want[s] / sizes[s] if sizes[s] else 0
        assert r["size"] == 0 or int(rate) <= r["copies"] <= int(rate) + (rate % 1 > 0)
        taken[s] += r["taken"]
    for s in sizes:
        assert abs(taken[s] - want[s]) <= biggest[s]
    return sorted(map(tuple, found), key=str)


def test_targets_bounds_and_reruns(spark):
    first = check(spark, rows())
    assert check(spark, list(reversed(rows()))) == first
    assert check(spark, rows(), seed=5) != first


def test_deep_trees(spark):
    rest = rows()[0][4:]
    given = [(i, "w " * (1 + i * 7 % 23), "en", "abc"[i % 10 // 8 + i % 2], *rest) for i in range(700)]
    check(spark, given, fan_in=4)


def spark_hash(*values):
    """Spark's xxhash64 of long (or, as (n,), int) values; null is skipped."""
    h = 42
    for v in values:
        if v is not None:
            small = isinstance(v, tuple)
            h = xxhash.xxh64_intdigest((v[0] if small else v).to_bytes(4 if small else 8, "little", signed=True), h)
    return h


def uniform(*values):
    return (spark_hash(*values) >> 11) * 2.0**-53


def pivotal(units, blocks, fan_in, seed):
    """(id, size, base, mass) of one source's documents -> copies by id."""
    copies, level, signed = {}, 0, lambda h: h - (h >> 63 << 64)
    held = [(signed(spark_hash(u[0], 1, u[1], (seed,))) % blocks, u) for u in units]
    while True:
        left = []
        for block in sorted({b for b, _ in held}):
            own = sorted((u for b, u in held if b == block), key=lambda u: (-u[1], signed(spark_hash(u[0], 1, (seed + 1,))), u[0]))
            a = None
            for b in own:
                if a is None:
                    a = b
                    continue
                gain_a, gain_b = min(a[1] - a[3], b[3]), min(a[3], b[1] - b[3])
                if uniform((seed,), (level,), a[0], 1, b[0], 1) * (gain_a + gain_b) < gain_b:
                    win, lose, gain = a, b, gain_a
                else:
                    win, lose, gain = b, a, gain_b
                win, lose = (*win[:3], win[3] + gain), (*lose[:3], lose[3] - gain)
                if win[3] >= win[1] * (1 - 1e-12):
                    copies[win[0]], a = win[2] + 1, lose
                else:
                    copies[lose[0]], a = lose[2], win
            left.append((block, a))
        if blocks <= 1:
            last = left[0][1]
            copies[last[0]] = last[2] + (uniform((seed,), (-1,), last[0], 1) * last[1] < last[3])
            return copies
        held, blocks, level = [(b // fan_in, u) for b, u in left], -(-blocks // fan_in), level + 1


def fractional():
    """Three sources whose targets are no whole multiples of their sizes."""
    rest = rows()[0][4:]
    return [(i, "w " * (1 + i * 5 % 7), "en", "aaaabbbc"[i % 8], *rest) for i in range(61)]


def test_copies_are_those_of_the_pivotal_fold(spark):
    given = fractional()
    sizes, by = Counter(), defaultdict(list)
    for r in given:
        sizes[r[3]] += len(space_words(r[1]))
        by[r[3]].append((r[0], len(space_words(r[1]))))
    want = targets(sizes, cap=9.0)
    found = {r["doc_id"]: r["copies"] for r in mix_sources(documents(spark, given), fan_in=4, cap=9.0, seed=11).collect()}
    some = 0
    for s, docs in by.items():
        rate = want[s] / sizes[s]
        assert rate % 1 > 0.01
        units = [(i, n, int(rate), (rate - int(rate)) * n) for i, n in docs]
        copies = pivotal(units, -(-len(units) // 4), 4, 11)
        assert {i: found[i] for i, _ in docs} == copies
        some += len(set(copies.values())) > 1
    assert some == 3


def test_chances_are_kept():
    """Over many seeds of the plain fold, which the operator's copies equal, each document's mean is its rate."""
    units, runs = [(i, 1 + i * 5 % 7, 0, 0.35 * (1 + i * 5 % 7)) for i in range(30)], 3000
    total = Counter()
    for seed in range(runs):
        total.update(pivotal(units, 8, 4, seed * 7))
    # Four standard errors and a little.
    assert all(abs(total[u[0]] / runs - 0.35) < 0.04 for u in units)


def test_one_id_repeated_falls_into_many_blocks(spark):
    rest = rows()[0][4:]
    given = [(5, "a b c", "en", "ab"[i % 3 > 0], *rest) for i in range(900)] + [(6, "a", "en", "c", *rest)] * 40
    first = sorted(map(tuple, mix_sources(documents(spark, given), fan_in=8).collect()))
    assert len(first) == len(given)
    assert first == sorted(map(tuple, mix_sources(documents(spark, given[::-1]).repartition(7), fan_in=8).collect()))
    words = {"a": 900, "b": 1800, "c": 40}
    want, taken = targets(words), Counter()
    for r in first:
        taken[r[1]] += r[-1]
    assert all(abs(taken[s] - want[s]) <= 3 for s in words)


def test_many_sources(spark):
    rest = rows()[0][4:]
    given = [(i, "w " * (1 + i % 5), "en", f"s{i % 97}" if i % 50 else None, *rest) for i in range(400)]
    check(spark, given)


def test_empty_and_wordless(spark):
    assert mix_sources(spark.createDataFrame([], SCHEMA)).collect() == []
    given = [(1, None, "en", "a", *rows()[0][4:]), (2, "", "en", None, *rows()[0][4:])]
    assert [(r["size"], r["target"], r["taken"]) for r in mix_sources(documents(spark, given)).collect()] == [(0, 0, 0)] * 2

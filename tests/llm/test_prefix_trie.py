import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from quadrille.llm import prefix_trie, queries
from quadrille.llm.prefix_trie import build_trie, end_hashes, ordered_turns, shared_starts, with_texts

SCHEMA = "conv_id bigint, turn bigint, role string, text string, depth int, digest string, before string, pos string"


def turn_key(role, text):
    role, text = role or "", text or ""
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()


def ordered(rows):
    out = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            out[conv].append(((turn is not None, turn or 0), turn_key(role, text), (role or "", text or "")))
    return {c: [t[2] for t in sorted(ts)] for c, ts in out.items()}


def rebuilt(rows):
    own = ordered(rows)
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        start = c - (abs(c) % 5) * (1 if c >= 0 else -1)
        out[c] = own.get(start, [])[:h] + turns[h:]
    return out


def brute_trie(convs):
    """Every column of every node, from the definition."""
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    out = []
    for node, ids in members.items():
        below = [n for n in members if n[: len(node)] == node]
        ends = sorted(c for c in ids if len(convs[c]) == len(node))
        out.append(
            (
                min(ids),
                len(node),
                min(members[node[:-1]]) if node else None,
                len(ids),
                sum(len(n) == len(node) + 1 for n in below),
                sum(not any(len(m) == len(n) + 1 and m[: len(n)] == n for m in below) for n in below),
                sum((len(members[n]) - 1) * len(n[-1][1].encode()) for n in below if n),
                hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
            )
        )
    return sorted(out, key=str)


def random_rows(seed):
    draw = random.Random(seed)
    rows = []
    for c in [*range(0, 60), *range(-7, 0), 10**12]:
        for t in range(draw.choice([1, 2, 3, 8, 12])):
            rows.append((c, draw.choice([t, t, t, 3, None]), draw.choice(["user", "assistant", None]), draw.choice(["hello", "hello", "", None, "grüß dich", "user"])))
    rows += [(None, 1, "user", "no id")] * 2 + [(4, 1, "user", "twice")] * 3
    return [(*r, 7, "d", "b", "p") for r in rows]


def found_rows(spark, rows):
    trie = build_trie(shared_starts(ordered_turns(spark.createDataFrame(rows, SCHEMA).repartition(5))))
    hashes = {bytes(r.digest): r.ends_sha256 for r in end_hashes(trie.ends).collect()}
    empty = hashlib.sha256(b"").hexdigest()
    out = [
        (r.conv_id, r.depth, r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved, hashes.get(bytes(r.digest), empty)) for r in trie.nodes.collect()
    ]
    return sorted(out, key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed):
    rows = random_rows(seed)
    assert found_rows(spark, rows) == brute_trie(rebuilt(rows))


def test_rebuilt_conversations(spark):
    rows = random_rows(3)
    found = defaultdict(list)
    for r in shared_starts(ordered_turns(spark.createDataFrame(rows, SCHEMA))).collect():
        found[r.conv_id].append((r.pos, r.turn and bytes(r.turn)))
    expected = {c: [None, *(turn_key(*t) for t in turns)] for c, turns in rebuilt(rows).items()}
    assert {c: [t for _, t in sorted(ts, key=lambda x: x[0])] for c, ts in found.items()} == expected


def test_copies_own_nothing_and_end_lists_keep_every_id(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "PIECE", 64)
    turns = [(c, p, b"" if p == 0 else hashlib.sha256(str(p).encode()).digest(), 0 if p == 0 else 10) for c in range(500) for p in range(4)]
    rows = spark.createDataFrame([(c, p, None if p == 0 else t, b) for c, p, t, b in turns], "conv_id bigint, pos bigint, turn binary, bytes bigint")
    trie = build_trie(rows)
    nodes = {r.depth: r for r in trie.nodes.collect()}
    assert [(d, nodes[d].n_convs, nodes[d].n_leaves, nodes[d].saved, nodes[d].conv_id) for d in range(4)] == [(d, 500, 1, 499 * 10 * (3 if d == 0 else 4 - d), 0) for d in range(4)]
    [ends] = end_hashes(trie.ends.repartition(7)).collect()
    assert ends.ends_sha256 == hashlib.sha256(",".join(map(str, range(500))).encode()).hexdigest()


def test_long_conversation_makes_rows_in_proportion(spark):
    rows = [(5, t, "user", f"turn {t}", 0, "", "", "") for t in range(3000)] + [(6, t, "user", f"turn {t}", 0, "", "", "") for t in range(3000)]
    trie = build_trie(shared_starts(ordered_turns(spark.createDataFrame(rows, SCHEMA))))
    assert trie.nodes.count() == 3001
    last = trie.nodes.where("depth = 3000").first()
    assert (last.n_convs, last.n_leaves, last.conv_id) == (2, 1, 5)


def test_empty_table(spark):
    assert found_rows(spark, []) == []


def test_turnless_conversation_is_a_member_of_the_root(spark):
    # crc32("6") % 9 turns come from conversation 5, which is absent; 6 has fewer turns of its own.
    h = zlib.crc32(b"6") % 9
    assert h > 1
    [root] = found_rows(spark, [(6, 0, "user", "hi", 0, "", "", "")])
    assert root == (6, 0, None, 1, 0, 1, 0, hashlib.sha256(b"6").hexdigest())


def test_texts_of_nodes(spark):
    rows = random_rows(4)
    conversations = spark.createDataFrame(rows, SCHEMA)
    trie = build_trie(shared_starts(ordered_turns(conversations)))
    found = with_texts(trie.nodes, conversations).collect()
    assert len(found) == trie.nodes.count()
    for r in found:
        assert r.depth == 0 if r.turn is None else turn_key(r.role, r.text) == bytes(r.turn)


def test_query_columns(spark, sf_dir):
    out = queries.op12_prefix_trie(spark, sf_dir)
    assert dict(out.dtypes) == {c: "bigint" for c in "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens".split()} | {"ends_sha256": "string"}
    assert out.where(F.col("depth") == 0).count() == 1

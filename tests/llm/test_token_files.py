import numpy as np
import pytest
from corpus import SCHEMA, documents, rows, space_words

from quadrille.llm.token_files import ID_DIGITS, count_tokens, told_id, write_word_ids


def brute(ids, end):
    out, start = [], 0
    for i, x in enumerate(ids):
        if x == end:
            out.append((start, i - start))
            start = i + 1
    if start < len(ids):
        out.append((start, len(ids) - start))
    return out


@pytest.mark.parametrize("width", [2, 4])
def test_files_of_their_own(spark, tmp_path, width):
    draw = np.random.default_rng(width)
    want = set()
    for name, n in [("a", 0), ("b", 1), ("c", 500), ("d", 4000)]:
        ids = draw.integers(0, 9, n)
        (tmp_path / name).write_bytes(ids.astype(f"<u{width}").tobytes())
        want |= {(name, *x) for x in brute(ids.tolist(), 3)}
    found = count_tokens(spark, str(tmp_path), width=width, end_id=3, block=64)
    got = [(r["path"].rsplit("/", 1)[1], r["start"], r["n_tokens"]) for r in found.collect()]
    assert len(got) == len(want) and set(got) == want


def test_one_stream_over_many_files(spark, tmp_path):
    draw = np.random.default_rng(7)
    ids = draw.integers(1, 40, 3000)
    ids[draw.integers(0, 3000, 60)] = 0
    cuts = [0, 0, 10, 11, 700, 701, 702, 1500, 1500, 2999, 3000]
    for i, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
        (tmp_path / f"f{i:02d}").write_bytes(ids[a:b].astype("<u2").tobytes())
    want = brute(ids.tolist(), 0)
    found = count_tokens(spark, str(tmp_path), header=3, one_stream=True, block=16).collect()
    assert sorted(r["n_tokens"] for r in found) == sorted(n for _, n in want)
    assert sorted(map(list, (r["head"] for r in found))) == sorted(ids[a : a + min(3, n)].tolist() for a, n in want)


def test_documents_across_blocks_and_wide_ids(spark, tmp_path):
    """Documents that run through three blocks and more, ends at the very edges of blocks, ids of 64 bits."""
    ids = np.arange(1, 2001, dtype=np.uint64)
    ids[0], ids[1] = 2**63, 2**64 - 1
    ids[[7, 8, 15, 16, 63, 64, 71, 127, 400, 1999]] = 5
    ids[4] = 6
    (tmp_path / "wide").write_bytes(ids.tobytes())
    want = brute(ids.tolist(), 5)
    for one_stream in (False, True):
        found = count_tokens(spark, str(tmp_path), width=8, end_id=5, header=3, one_stream=one_stream, block=8).collect()
        assert sorted((r["start"], r["n_tokens"]) for r in found) == want
        heads = {r["start"]: [x % 2**64 for x in r["head"]] for r in found}
        assert heads == {a: ids[a : a + min(3, n)].tolist() for a, n in want}


def test_one_stream_of_files_without_ends(spark, tmp_path):
    for i, part in enumerate([[1, 2], [3], [], [4, 5, 6], [0], [7], [0, 0]]):
        (tmp_path / f"f{i}").write_bytes(np.array(part, "<u2").tobytes())
    found = count_tokens(spark, str(tmp_path), header=5, one_stream=True, block=2).collect()
    assert sorted((r["n_tokens"], r["head"]) for r in found) == [(0, []), (1, [7]), (6, [1, 2, 3, 4, 5])]


def test_half_ids_are_an_error(spark, tmp_path):
    (tmp_path / "x").write_bytes(b"abc")
    with pytest.raises(Exception, match="no whole number of ids"):
        count_tokens(spark, str(tmp_path)).collect()


def test_round_trip_of_documents(spark, tmp_path):
    write_word_ids(documents(spark), str(tmp_path / "ids"))
    found = count_tokens(spark, str(tmp_path / "ids"), header=ID_DIGITS, one_stream=True)
    got = [(r[0], r[1] - ID_DIGITS) for r in found.select(told_id(), "n_tokens").collect()]
    want = [(r[0], len(space_words(r[1]))) for r in rows()]
    key = lambda x: (x[0] is None, x)
    assert sorted(got, key=key) == sorted(want, key=key)
    some = (0, -1, 2**40, -(2**40), 2**63 - 1, -(2**63), 2**63 - 2, 9222900000000000000, -9222900000000000000, 8192, 8193, -8193)
    big = [(i, "a b", *rows()[0][2:]) for i in some]
    write_word_ids(documents(spark, big), str(tmp_path / "big"))
    found = count_tokens(spark, str(tmp_path / "big"), header=ID_DIGITS, one_stream=True)
    assert sorted(r[0] for r in found.select(told_id()).collect()) == sorted(r[0] for r in big)
    write_word_ids(spark.createDataFrame([], SCHEMA), str(tmp_path / "none"))
    assert count_tokens(spark, str(tmp_path / "none"), one_stream=True).collect() == []

import random
import re
import time
from dataclasses import replace

from corpus import SCHEMA, documents, rows

from quadrille.llm.secret_scan import BASE_RULES, RULES, scan_secrets

ASSIGN = re.compile(
    r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"""
    r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)


def brute(text):
    out = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [("access", m.start(), m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    return out + [("hex", m.start(), m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]


def texts():
    draw = random.Random(8)
    bits = ["password", "token", "API_KEY", "apikey", "Secret", "passwd", ":", "=", " = ", '"', "'", "abc", "abcdef", "deadbeef" * 3, "0f" * 11, "0f" * 12]
    bits += ["AKIA", "AKIA" + "Z9" * 8, "AKIA" + "Z9" * 7, "token:token:abcdefgh", "é", "日", "\U0001f600", " ", "\n", "secret", "-----BEGIN RSA PRIVATE KEY-----"]
    out = ["".join(draw.choice(bits) for _ in range(draw.randrange(14))) for _ in range(400)]
    return out + ["\U0001f600token=abcdefgh", "ſecret=abcdefgh", "toKen=abcdefgh", "password=" + "a" * 60_000]


def test_base_spans_against_brute_force(spark):
    given = [(i, t, *rows()[0][2:]) for i, t in enumerate(texts())]
    found, _ = scan_secrets(documents(spark, given))
    got = found.collect()
    assert len(got) == len(given)
    kinds = [r.kind for r in RULES]
    base = {r.kind for r in BASE_RULES}
    for r in got:
        spans = [(s["kind"], s["start"], s["end"]) for s in r["spans"]]
        assert spans == sorted(spans, key=lambda s: (s[1], kinds.index(s[0])))
        assert sorted(s for s in spans if s[0] in base) == sorted(brute(given[r["doc_id"]][1])), given[r["doc_id"]][1]


def test_ledger_scans_only_what_is_new(spark):
    docs = documents(spark)
    more = documents(spark, rows() + [(5000, "token = abcdefgh", *rows()[0][2:])])
    first, ledger = scan_secrets(docs)
    pairs = ledger.count()
    assert pairs == len(RULES) * ledger.select("blob").distinct().count()
    # A ledger that claims other findings is believed, so known pairs aren't read again.
    from pyspark.sql import functions as F

    marked = ledger.withColumn("spans", F.expr("array(named_struct('start', 1L, 'end', 2L))"))
    found, grown = scan_secrets(more, ledger=marked)
    assert grown.count() == pairs + len(RULES)
    by = {r["doc_id"]: r["spans"] for r in found.where("doc_id is not null").collect()}
    assert [s["kind"] for s in by[5000]] == ["assign"] and len(by[3]) == len(RULES)
    # A new version of one rule is scanned alone.
    newer = [replace(r, version=2) if r.kind == "hex" else r for r in RULES]
    _, grown = scan_secrets(docs, ledger=ledger, rules=newer)
    assert grown.count() == pairs + pairs // len(RULES)
    assert grown.where("kind = 'hex' and version = 2").count() == pairs // len(RULES)


def test_awkward_rows_and_empty_table(spark):
    found, _ = scan_secrets(documents(spark))
    assert found.count() == len(rows())
    none, ledger = scan_secrets(spark.createDataFrame([], SCHEMA))
    assert none.collect() == [] and ledger.collect() == []


def test_long_credentials(spark):
    token = "github_pat_" + "A1b2" * 5 + "C3_" + "d4E5" * 14 + "f6G"
    assert len(token) == 93
    given = [f"see https://me:{token}@host.org/x", f"http://{'u' * 70}:{'p' * 100_000}@h", "ftp://a:bc@h", f"x://u:{'p' * 300} @h", f"({token})", "github_pat_short"]
    found, _ = scan_secrets(documents(spark, [(i, t, *rows()[0][2:]) for i, t in enumerate(given)]))
    got = {r["doc_id"]: [(s["kind"], given[r["doc_id"]][s["start"] : s["end"]]) for s in r["spans"]] for r in found.collect()}
    kinds = ("userinfo", "forge")
    assert {i: [s for s in spans if s[0] in kinds] for i, spans in got.items()} == {
        0: [("userinfo", f"https://me:{token}@"), ("forge", token)],
        1: [("userinfo", given[1][:-1])],
        2: [],
        3: [],
        4: [("forge", token)],
        5: [],
    }


def test_a_text_of_many_matches(spark):
    """100,000 matches of one rule, and of another, in a text; time in proportion to them."""
    text = "".join(f"é token=abcdef{i % 7}{'x' * (i % 3)} {'0f' * 12}\n" for i in range(100_000))
    given = [(1, text, *rows()[0][2:]), (2, text[: len(text) // 2], *rows()[0][2:])]
    began = time.perf_counter()
    found, _ = scan_secrets(documents(spark, given))
    got = {r["doc_id"]: [(s["kind"], s["start"], s["end"]) for s in r["spans"]] for r in found.collect()}
    took = time.perf_counter() - began
    for i, t, *_ in given:
        assert sorted(got[i]) == sorted(brute(t))
    assert len(got[1]) == 200_000 and took < 60, took


def test_rows_repeated_in_id_and_text_are_scanned_once(spark):
    given = [(i, "token=abcdefgh", *rows()[0][2:]) for i in (None, None, 3, 3, 4)]
    found, ledger = scan_secrets(documents(spark, given))
    assert [len(r["spans"]) for r in found.collect()] == [1] * 5
    assert ledger.count() == len(RULES)

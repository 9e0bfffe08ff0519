"""Secret scans over an incremental ledger of content-addressed blobs.

A blob is a distinct text, addressed by its SHA-256.  The ledger holds, for
every blob and rule version that were ever scanned together, the spans found.
A scan addresses all rows, leaves out the pairs that the ledger has, moves and
reads the text of each remaining blob once (from one of its rows), and joins the
ledger's spans back to every row.  A text shared by thousands of rows is scanned once; a
new version of one rule rescans that rule alone.

DataFrame functions only.  Positions come from splitting a text at the matches:
the code points of the pieces and of the matches add up to every start and end.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quadrille.llm._marks import marks, with_mark
from quadrille.llm._store import Scratch


@dataclass(frozen=True)
class Rule:
    """A pattern (Java syntax), and the least length of one group that a match must have to stay."""

    kind: str
    version: int
    pattern: str
    group: int = 0
    least: int = 1


BASE_RULES = (
    Rule(
        "assign",
        1,
        r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        6,
    ),
    # A run that is too short holds no long enough one, so the least length stands in the pattern.
    Rule("access", 1, r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", 1, r"[0-9a-f]{24,}"),
)
MORE_RULES = (
    Rule("pem", 1, r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("forge", 2, r"\b(?:gh[opsur]_[A-Za-z0-9]{36,}|github_pat_[A-Za-z0-9_]{36,})"),
    Rule("jwt", 1, r"\beyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("bearer", 1, r"\b[Bb]earer\x20+[A-Za-z0-9._~+/-]{20,}=*"),
    Rule("userinfo", 2, r"\b[a-z][a-z0-9+.-]{1,20}://[^\x00-\x20/:@]+:[^\x00-\x20/:@]{3,}@"),
)
RULES = BASE_RULES + MORE_RULES

SPAN = "struct<start:bigint,rank:int,end:bigint,kind:string>"
SPANS = "array<struct<start:bigint,end:bigint>>"
#: Matches whose running sums are made together.
_BLOCK = 128
LEDGER = "blob string, kind string, version int, spans array<struct<start:bigint,end:bigint>>"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is evaluated once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _spans(text: Column, rule: Rule) -> Column:
    """Leftmost non-overlapping matches as array<struct<start,end>>, in code points, end exclusive.

    The pieces between matches and the matches are taken from the text once.
    Their running sums are made in blocks of _BLOCK matches, then over blocks, so
    that a text of many matches takes time in proportion to them.
    """
    pattern = F.lit(rule.pattern)
    sizes = lambda xs: F.transform(xs, lambda x: F.char_length(x).cast("long"))
    found = sizes(F.regexp_extract_all(text, pattern, F.lit(0)))
    held = sizes(F.regexp_extract_all(text, pattern, F.lit(rule.group))) if rule.group else found
    # One more piece than matches: the last has no size.
    pieces = F.arrays_zip(sizes(F.split(text, rule.pattern, -1)).alias("gap"), found.alias("size"), held.alias("held"))

    def block(piece: Column, number: Column) -> Column:
        start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(SPANS).alias("spans"))

        def step(acc: Column, x: Column) -> Column:
            begin = acc["at"] + x["gap"]
            end = begin + F.coalesce(x["size"], F.lit(0).cast("long"))
            span = F.array(F.struct(begin.alias("start"), end.alias("end")))
            stays = F.coalesce(x["held"] >= rule.least, F.lit(False))
            return F.struct(end.alias("at"), F.when(stays, F.concat(acc["spans"], span)).otherwise(acc["spans"]).alias("spans"))

        return F.aggregate(F.slice(piece, number * _BLOCK + 1, F.lit(_BLOCK)), start, step)

    def shifted(blocks: Column) -> Column:
        ends = F.aggregate(
            blocks, F.array(F.lit(0).cast("long")), lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x["at"]))
        )
        move = lambda by: lambda s: F.struct((s["start"] + by).alias("start"), (s["end"] + by).alias("end"))
        return _let(ends, lambda at: F.flatten(F.transform(blocks, lambda x, i: F.transform(x["spans"], move(F.get(at, i))))))

    walk = lambda p: F.transform(F.sequence(F.lit(0), F.floor((F.size(p) - 1) / _BLOCK).cast("int")), lambda i: block(p, i))
    walked = _let(_let(pieces, walk), shifted)
    return F.when(F.regexp_like(text, pattern), walked).otherwise(F.array().cast(SPANS))


def scan_secrets(
    docs: DataFrame,
    *,
    ledger: DataFrame | None = None,
    rules: Sequence[Rule] = RULES,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> tuple[DataFrame, DataFrame]:
    """-> (findings, ledger).

    findings: one row per input row with doc_id, blob and ``spans``, an array of
    struct(start, rank, end, kind) sorted by start and then by the rule's place
    in ``rules``.  ledger: every (blob, kind, version) scanned so far, old rows
    and new ones, with ``spans``; pass it to the next scan.  Null text counts as
    empty; rows without a match have an empty array.  Repeated rows and equal
    texts share one blob.  Null ids are kept.  Texts of any length and number of
    matches are scanned whole.  Other columns are ignored; an
    empty table gives no findings and adds nothing to the ledger.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "secrets")
    text = F.coalesce(F.col(text_col), F.lit(""))
    texts = docs.select(F.col(id_col).alias("doc_id"), text.alias("text")).withColumn("blob", F.sha2("text", 256))
    paths = scratch.save(texts.select("doc_id", "blob"), "paths")

    wanted = spark.createDataFrame([(r.kind, r.version) for r in rules], "kind string, version int")
    known = ledger if ledger is not None else spark.createDataFrame([], LEDGER)
    # One row of each blob lends its text: the one of the smallest id (null where all ids are null).
    blobs = paths.groupBy("blob").agg(F.min("doc_id").alias("reader"))
    seen = (
        known.join(F.broadcast(wanted), ["kind", "version"], "left_semi")
        .groupBy("blob")
        .agg(F.collect_set("kind").alias("seen"))
    )
    reader = lambda of: F.concat_ws(":", F.col("blob"), F.col(of).cast("string"))
    todo = (
        blobs.join(seen, "blob", "left")
        .withColumn("todo", F.array_except(F.array(*[F.lit(r.kind) for r in rules]), F.coalesce("seen", F.array().cast("array<string>"))))
        .where(F.size("todo") > 0)
        .select(reader("reader").alias("__key"), "todo")
    )
    todo = scratch.save(todo, "todo")
    # Only texts that may be unread are moved, and of rows repeated in id and text one is scanned.
    maybe = with_mark(texts.select(reader("doc_id").alias("key"), "blob", "text"), F.col("key"), marks(todo, F.col("__key")), "maybe").where("maybe")
    unread = maybe.join(todo, F.col("key") == F.col("__key")).groupBy("key").agg(*[F.first(c).alias(c) for c in ("blob", "text", "todo")])
    scans = F.array(
        *[
            F.struct(
                F.lit(r.kind).alias("kind"),
                F.lit(r.version).alias("version"),
                F.when(F.array_contains("todo", r.kind), _spans(F.col("text"), r)).alias("spans"),
            )
            for r in rules
        ]
    )
    fresh = (
        unread.select("blob", F.explode(scans).alias("s"))
        .select("blob", "s.kind", "s.version", "s.spans")
        .where("spans is not null")
    )
    fresh = scratch.save(fresh, "fresh")
    ledger_now = known.select("blob", "kind", "version", "spans").unionByName(fresh)

    rank = F.create_map(*[x for i, r in enumerate(rules) for x in (F.lit(r.kind), F.lit(i))])
    hits = (
        ledger_now.join(F.broadcast(wanted), ["kind", "version"], "left_semi")
        .where(F.size("spans") > 0)
        .withColumn("kind_rank", rank[F.col("kind")])
        .select(
            "blob",
            F.explode(
                F.expr("transform(spans, s -> named_struct('start', s.start, 'rank', kind_rank, 'end', s.end, 'kind', kind))")
            ).alias("span"),
        )
        .groupBy("blob")
        .agg(F.array_sort(F.collect_list("span")).alias("spans"))
    )
    hits = scratch.save(hits, "hits")
    findings = paths.join(hits, "blob", "left").select(
        "doc_id", "blob", F.coalesce("spans", F.array().cast(f"array<{SPAN}>")).alias("spans")
    )
    return findings, ledger_now


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of every span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

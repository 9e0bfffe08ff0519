"""Small corpora with awkward rows, shared by the tests of the operators."""

from __future__ import annotations

import random
import re

from pyspark.sql import DataFrame, SparkSession

SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, "
    # names that the operators use inside
    "size bigint, grp bigint, token string, kept boolean, blob string, n bigint, spot bigint, h bigint, id bigint"
)
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau".split()


def lower(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def space_words(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", lower(text or ""))


def rows(seed: int = 1, count: int = 120) -> list[tuple]:
    """Random texts with exact and near copies, and the awkward cases."""
    draw = random.Random(seed)
    out: list[tuple[int | None, str | None, str | None]] = []
    for i in range(count):
        kind = draw.random()
        if out and kind < 0.15:
            text = draw.choice(out)[1]
        elif out and kind < 0.5:
            text = " ".join(draw.choice(WORDS) if draw.random() < 0.04 else w for w in (draw.choice(out)[1] or "").split(" "))
        else:
            text = " ".join(draw.choice(WORDS) + draw.choice("abcdefgh") for _ in range(draw.choice([1, 3, 4, 5, 6, 20, 60])))
        out.append((i, text, draw.choice(["s1", "s2", "S3", None])))
    out += [
        (1000, None, "s1"),
        (1001, "", "s2"),
        (1002, " \t\n ", None),
        (1003, "One", "s1"),
        (1004, "ONE", "s1"),
        (1005, "x" * 50_000, "s2"),
        (1006, " ".join(f"w{i % 977}" for i in range(30_000)), "hot"),
        (1007, "é ü\u00a0ß \u3000 日本 語\x0bfive\x0csix", "s1"),
        (1008, "A\x00B  c\r\nd", "s1"),
        (7, out[7][1], out[7][2]),
        (None, "no id at all here", "s1"),
        (None, "no id at all here", "s1"),
    ]
    return [(i, t, "en", s, len(t or ""), 1, 2, "t", True, "b", 3, 4, 5, 6) for i, t, s in out]


def documents(spark: SparkSession, given: list[tuple] | None = None) -> DataFrame:
    return spark.createDataFrame(rows() if given is None else given, SCHEMA).repartition(3)

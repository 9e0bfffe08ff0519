"""Folds by checksum, and bounded samples for fitting on the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Texts of more bytes are scored like all others but not sampled whole for fitting.
LONGEST_SAMPLED = 1 << 20


def in_fold(doc_id: Column, folds: int, fold: int) -> Column:
    """Whether the checksum of the id as text falls in the fold; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(False))


def sample_by(rows: DataFrame, key: str, most_rows: int, most_bytes: int, seed: int = 17) -> tuple[DataFrame, dict]:
    """(sample, totals): rows with doc_id, text and ``key`` whose hash is under their key's threshold.

    Thresholds come from counts of all rows, so that a key's sample is expected
    to hold at most ``most_rows`` rows and ``most_bytes`` bytes.  ``totals`` has
    the number of all rows by key.
    """
    rows = rows.where((F.octet_length("text") <= LONGEST_SAMPLED) & F.col(key).isNotNull())
    counts = rows.groupBy(key).agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("b")).collect()
    share = {r[key]: min(1.0, most_rows / r["n"], most_bytes / max(1, r["b"])) for r in counts}
    if not share:
        return rows.limit(0), {}
    limits = F.create_map(*[x for k, v in sorted(share.items()) for x in (F.lit(k), F.lit(int(v * 2**31)))])
    picked = F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(2**31)) < limits[F.col(key)]
    return rows.where(picked), {r[key]: r["n"] for r in counts}

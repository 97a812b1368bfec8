"""Portable seeded buckets.

``bucket(seed, salt, *keys)`` is a pure function of its arguments, so a sample,
split or fold never depends on how the data happens to be partitioned, and the
same number comes out of any engine that has md5:

    Spark : cast(conv(substr(md5(concat_ws('|', seed, salt, k...)), 1, 8), 16, 10) as bigint)
    DuckDB: ('0x' || substr(md5(concat_ws('|', seed, salt, k...)), 1, 8))::bigint

The value lies in [0, 2^32).  Fractions are compared as integers against
``cut(p) = round(p * 2^32)``; never as a float ratio.  Each operator uses its own
salt so that, e.g., a 25 % sample is not nested inside the first 60 % of a split.
Keys must be non-null (``concat_ws`` skips nulls) and integral or string typed.

md5 costs about 3 us per row and core.  Where reproducing the buckets in
another engine does not matter, pass ``method="xxhash64"``: the bucket becomes
``xxhash64(seed, salt, keys) mod 2^32``, several times cheaper, with the same
fractions and salts (but other rows).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACE = 1 << 32

# Fixed salts, one per operator.
SALT_SAMPLE = "sample"
SALT_SPLIT = "split"
SALT_TEST = "test"
SALT_FOLD = "fold"
SALT_ROW = "row"
SALT_HALF = "half"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def bucket(seed: int, salt: str, *keys, method: str = "md5") -> Column:
    """Seeded 32-bit bucket of ``keys`` as a bigint column, by ``md5`` (portable)
    or ``xxhash64`` (cheaper)."""
    if not keys:
        raise ValueError("bucket needs at least one key column")
    if method not in ("md5", "xxhash64"):
        raise ValueError(f"method must be md5 or xxhash64, got {method!r}")
    if method == "xxhash64":
        # keys as strings, so int and bigint ids of one entity share a bucket
        return F.pmod(F.xxhash64(F.lit(str(seed)), F.lit(salt), *[_col(k).cast("string") for k in keys]),
                      F.lit(SPACE))
    parts = [F.lit(str(seed)), F.lit(salt)] + [_col(k).cast("string") for k in keys]
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, 8), 16, 10).cast("bigint")


def bucket_sql(seed: int, salt: str, *keys: str) -> str:
    """DuckDB text of the same bucket (used by the oracle queries)."""
    parts = ", ".join([f"'{seed}'", f"'{salt}'"] + [f"CAST({k} AS VARCHAR)" for k in keys])
    return f"('0x' || substr(md5(concat_ws('|', {parts})), 1, 8))::BIGINT"


def cut(p: float) -> int:
    """Integer threshold for fraction ``p``: bucket < cut(p) holds a share p."""
    if not 0.0 <= p <= 1.0:
        raise ValueError(f"fraction must lie in [0, 1], got {p}")
    return int(round(p * SPACE))


def cumulative_cuts(weights) -> list[int]:
    """Cuts for consecutive shares; weights are normalised like randomSplit."""
    w = [float(x) for x in weights]
    if not w or any(x < 0 for x in w) or sum(w) <= 0:
        raise ValueError(f"weights must be non-negative with a positive sum, got {weights}")
    total, acc, out = sum(w), 0.0, []
    for x in w[:-1]:
        acc += x
        out.append(cut(acc / total))
    out.append(SPACE)
    return out

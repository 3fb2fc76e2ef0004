"""Deterministic per-row randomness from a hash, reproducible in any SQL engine.

``uniform(parts)`` = first 32 bits of md5('p1|p2|...') / 2^32, a multiple of
2^-32 in [0, 1).  ``poisson1(u)`` inverts the Poisson(1) CDF on it (the
Poisson bootstrap weight).  No state, no driver-side RNG, the same draw on
every retry of a task.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_32 = 4294967296.0


def hash_key(*parts: Column | str) -> Column:
    cols = [F.col(p) if isinstance(p, str) else p for p in parts]
    return F.concat_ws("|", *[c.cast("string") for c in cols])


def hex32_uniform(hex8: Column) -> Column:
    """8 hex digits (32 bits) -> uniform multiple of 2^-32 in [0, 1)."""
    return F.conv(hex8, 16, 10).cast("bigint") / F.lit(TWO_32)


def uniform(*parts: Column | str) -> Column:
    return hex32_uniform(F.substring(F.md5(hash_key(*parts)), 1, 8))


DRAWS_PER_MD5 = 4   # 128 bits = four 32-bit uniforms


def poisson1_thresholds() -> list[float]:
    """CDF of Poisson(1) at k = 0, 1, ... until it passes the largest uniform."""
    out, term, cdf, k = [], math.exp(-1.0), 0.0, 0
    top = 1.0 - 1.0 / TWO_32
    while True:
        cdf += term
        out.append(cdf)
        if cdf > top:
            return out
        k += 1
        term /= k


def poisson1(u: Column) -> Column:
    """Smallest k with u < CDF(k)."""
    th = poisson1_thresholds()
    expr = F.when(u < F.lit(th[0]), F.lit(0))
    for k, t in enumerate(th[1:], start=1):
        expr = expr.when(u < F.lit(t), F.lit(k))
    return expr.otherwise(F.lit(len(th)))


def sql_uniform(parts_sql: str, slot_sql: str = "0") -> str:
    """DuckDB text of ``uniform`` (32-bit slot ``slot_sql`` of the md5) for a '|'-joined string."""
    return (f"(CAST(CAST('0x' || substr(md5({parts_sql}), 8 * ({slot_sql}) + 1, 8) AS BIGINT) AS DOUBLE) "
            f"/ CAST({TWO_32!r} AS DOUBLE))")


def sql_poisson1(u_sql: str) -> str:
    th = poisson1_thresholds()
    whens = " ".join(f"WHEN {u_sql} < CAST('{t:.17e}' AS DOUBLE) THEN {k}" for k, t in enumerate(th))
    return f"(CASE {whens} ELSE {len(th)} END)"

"""Money sums that keep every amount.

Amounts are summed as ``decimal(38, MONEY_SCALE)`` and cast back to double, so
the total does not depend on the order in which partial aggregates arrive.
Twelve decimals keep sub-cent amounts; rounding belongs to the reports.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY_SCALE = 12


def money(c: Column | str) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return col.cast(f"decimal(38,{MONEY_SCALE})")


def money_sum(c: Column | str) -> Column:
    """``sum`` of a money column as a decimal; no amounts sum to 0."""
    return F.coalesce(F.sum(money(c)), F.lit(0).cast(f"decimal(38,{MONEY_SCALE})"))

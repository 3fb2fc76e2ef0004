"""Key lookup in a GA4 ``event_params`` array (operator F1).

The reference runs a correlated scalar subquery over ``unnest(event_params)``.
Here it stays inside the row: the position of the key in ``event_params.key``,
then the element at that position of ``event_params.value.<field>``.  No explode,
no shuffle, no self-join.

The array is named once, as the variable of a lambda.  Named several times, whatever
derives it is repeated as often when a filter on the value moves below it, and the
compiled stage grows beyond the method size that the JVM translates to machine code.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

VALUE_FIELDS = ("string_value", "int_value", "float_value", "double_value")


def param_value(params: Column | str, key: str, field: str = "int_value",
                strict: bool = True) -> Column:
    """Value ``field`` of the entry whose ``key`` matches.

    No entry gives NULL.  Several entries with the same key fail the task, like
    a scalar subquery that returns more than one row; without ``strict`` the
    first one wins.
    """
    if field not in VALUE_FIELDS:
        raise ValueError(f"unknown value field {field!r}")
    arr = F.col(params) if isinstance(params, str) else params

    def lookup(entries: Column) -> Column:
        keys = entries.getField("key")
        pos = F.array_position(keys, F.lit(key))     # 1-based, 0 when absent
        value = F.get(entries.getField("value").getField(field), pos - 1)   # NULL when pos = 0
        if not strict:
            return value
        matches = F.size(keys) - F.size(F.array_remove(keys, F.lit(key)))
        return F.when(matches > 1,
                      F.raise_error(F.lit(f"more than one event_params entry with key '{key}'"))
                      ).otherwise(value)

    return F.get(F.transform(F.array(arr), lookup), F.lit(0))

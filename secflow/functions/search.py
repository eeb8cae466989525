"""Search inside sorted arrays of a row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def count_at_most(array: str, field: str, value: str) -> Column:
    """How many structs of ``array``, sorted by ``field``, have a field of at most ``value``: by halving.

    All three are SQL names; a null array or value counts nothing.
    """
    # the count grows by falling powers of two; a place behind the end is null and adds nothing
    highest = f"cast(ceil(log2(coalesce(nullif(size({array}), -1), 0) + 1)) as int)"
    return F.expr(
        f"aggregate(sequence({highest}, 0, -1), 0, (n, k) -> "
        f"IF(get({array}, n + shiftleft(1, k) - 1).{field} <= {value}, n + shiftleft(1, k), n))")

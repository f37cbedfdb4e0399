"""Set membership with SQL's NULL rules."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def not_in(left: DataFrame, column: str, right: DataFrame, key: str) -> DataFrame:
    """``column NOT IN (right.key)``: one NULL on the right leaves nothing, a NULL on the
    left never qualifies, an empty right side keeps everything.

    Spark's own NOT IN must broadcast the right side; this is a shuffled anti join after
    two cheap looks at the right side.
    """
    values = right.select(F.col(key).alias(column)).distinct()
    if right.isEmpty():
        return left
    if not right.where(F.col(key).isNull()).isEmpty():
        return left.where(F.lit(False))
    return left.where(F.col(column).isNotNull()).join(values, column, "left_anti")

"""Small helpers shared by the query catalogue."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DIGITS = 6
# Half-way cases are common (means of two-decimal inputs); a tiny bias far
# below the rounding unit but far above last-bit summation noise makes every
# engine round them the same way.
BIAS = 3.3e-9


def rounded(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Round every DOUBLE column (engines differ in the last bits of sums)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(F.round(F.col(f.name) + F.lit(BIAS), digits).alias(f.name))
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            cols.append(F.col(f.name).cast("bigint").alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)

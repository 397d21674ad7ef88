"""Arrays and objects inside a variant column, as rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def exploded(df: DataFrame, column: str, prefix: str) -> DataFrame:
    """df with a row for every element of the variant array (or field of the object) in column: prefix_pos, prefix_key,
    prefix_value. Rows whose variant is null, empty or a scalar have none. It may be done twice on one column."""
    elements = df.sparkSession.tvf.variant_explode(F.col(column).outer())
    return df.lateralJoin(elements.select(*[F.col(c).alias(f"{prefix}_{c}") for c in ("pos", "key", "value")]))


def element_pairs(df: DataFrame, column: str) -> DataFrame:
    """df with a row for every ordered pair of different places of the array in column: a_pos, a_value, b_pos, b_value."""
    return exploded(exploded(df, column, "a"), column, "b").where("a_pos <> b_pos").drop("a_key", "b_key")

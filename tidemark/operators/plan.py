"""A plan-shaping helper shared by the operators."""
from pyspark.sql import DataFrame, functions as F


def settle(df: DataFrame, **columns) -> DataFrame:
    """Add columns that are computed once here. Plain projections would be merged into every later
    expression and filter that mentions them; a one-row generator keeps its output as it is."""
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))

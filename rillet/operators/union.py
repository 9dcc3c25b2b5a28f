"""Tagged union of input and derived rows, and the split back.

For windowing the two tables need no tag: both are computed from the same
DataFrame and windowed on the same time column. The tagged form is for
callers that want one table holding both kinds of row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TAG = "tag"
INPUT_TAG = 1
OUTPUT_TAG = 2


def tagged_union(input_rows: DataFrame, output_rows: DataFrame, tag: str = TAG) -> DataFrame:
    """Input rows tagged 1 and output rows tagged 2, columns matched by name."""
    return (input_rows.withColumn(tag, F.lit(INPUT_TAG))
            .unionByName(output_rows.withColumn(tag, F.lit(OUTPUT_TAG)), allowMissingColumns=True))


def split_tagged(df: DataFrame, input_cols, output_cols, tag: str = TAG):
    """The two tables back from a tagged union."""
    return (df.where(F.col(tag) == INPUT_TAG).select(*input_cols),
            df.where(F.col(tag) == OUTPUT_TAG).select(*output_cols))

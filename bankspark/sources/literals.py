"""Tables written in code."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


def literal_table(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType) -> DataFrame:
    """Rows as a local relation, so that Spark knows the exact size when it picks a join."""
    columns = list(zip(*rows)) if rows else [[] for _ in schema.fields]
    arrow_schema = to_arrow_schema(schema)
    arrays = [pa.array(values, field.type) for values, field in zip(columns, arrow_schema)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, schema=arrow_schema), schema)

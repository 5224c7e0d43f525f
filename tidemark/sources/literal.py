"""Small tables written down in code."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def literal_table(spark: SparkSession, rows: Sequence[tuple], schema: str | T.StructType) -> DataFrame:
    """Rows given in code as a table whose exact size the optimizer knows.

    Going through Arrow makes it a local relation: a join with it is broadcast
    because it is measurably small, with no hint, and a list too large for that
    is not.
    """
    fields = (T.StructType.fromDDL(schema) if isinstance(schema, str) else schema).fields
    columns = {f.name: [row[i] for row in rows] for i, f in enumerate(fields)}
    table = spark.createDataFrame(pa.table(columns))
    return table.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in fields])

"""Small config tables as inline VALUES (a LocalRelation).

``createDataFrame`` on Python rows yields an RDD scan whose size the planner
does not know; an inline table carries exact statistics, so broadcast
decisions on config sides need no extra job and the optimizer can fold it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _lit(v, t: T.DataType) -> str:
    if v is None:
        return f"CAST(NULL AS {t.simpleString()})"
    if isinstance(t, T.StringType):
        return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"
    if isinstance(t, T.BooleanType):
        return "true" if v else "false"
    if isinstance(t, (T.IntegerType, T.LongType, T.ShortType, T.ByteType)):
        return f"CAST({int(v)} AS {t.simpleString()})"
    if isinstance(t, (T.DoubleType, T.FloatType)):
        return f"CAST('{float(v)!r}' AS {t.simpleString()})"
    if isinstance(t, T.ArrayType):
        if not v:
            return f"CAST(array() AS {t.simpleString()})"
        return "array(" + ", ".join(_lit(x, t.elementType) for x in v) + ")"
    if isinstance(t, T.StructType):
        vals = v.asDict() if hasattr(v, "asDict") else (
            v if isinstance(v, dict) else dict(zip(t.fieldNames(), v)))
        return "named_struct(" + ", ".join(f"'{f.name}', {_lit(vals.get(f.name), f.dataType)}"
                                           for f in t.fields) + ")"
    raise TypeError(f"unsupported literal type {t}")


def local_table(spark: SparkSession, rows: list, schema: T.StructType) -> DataFrame:
    names = schema.fieldNames()
    if not rows:
        return spark.createDataFrame([], schema)
    values = ", ".join("(" + ", ".join(_lit(r[i] if not isinstance(r, dict) else r[n], f.dataType)
                                       for i, (n, f) in enumerate(zip(names, schema.fields))) + ")"
                       for r in rows)
    df = spark.sql(f"SELECT * FROM VALUES {values} AS t({', '.join(f'`{n}`' for n in names)})")
    return df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields])

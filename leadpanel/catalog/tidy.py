"""Plain output types: 64-bit integers, doubles rounded alike, text."""

from pyspark.sql import DataFrame, functions as F, types as T

WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.BooleanType)


def tidy(df: DataFrame, digits: int = 6) -> DataFrame:
    out = []
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, WHOLE):
            c = c.cast("bigint")
        elif isinstance(field.dataType, (T.FloatType, T.DoubleType, T.DecimalType)):
            c = F.round(c.cast("double"), digits) + F.lit(0.0)  # + 0.0 turns -0.0 into 0.0
        elif isinstance(field.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            c = c.cast("string")
        out.append(c.alias(field.name))
    return df.select(*out)

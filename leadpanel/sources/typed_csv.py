"""CSV files whose column types are found from the cells, with an account of the cells that do not fit.

All cells are read as text once. One pass counts, per column, how many cells each
type could hold; the first type that holds nearly all of them is taken. Rows with
a cell outside its column's type, or with too many or too few cells, go to an
error table instead of turning into nulls.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from leadpanel.session import pin

BAD_RECORD = "_corrupt_record"
#: Share of a column's filled cells that a type must hold.
MOST = 0.9
#: Types in the order in which they are tried; text holds everything.
WHOLE = r"^[+-]?(0|[1-9][0-9]{0,17})$"
NUMBER = r"^[+-]?(0|[1-9][0-9]*)?(\.[0-9]+)?([eE][+-]?[0-9]+)?$"
DATE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
TYPES = ("bigint", "double", "date", "boolean", "string")


def fits(cell: Column, kind: str) -> Column:
    """Whether a trimmed cell is of the type. A number with leading zeros is a code, and so text."""
    text = F.trim(cell)
    if kind == "bigint":
        return text.rlike(WHOLE)
    if kind == "double":
        return text.rlike(NUMBER) & text.try_cast("double").isNotNull()
    if kind == "date":
        return text.rlike(DATE) & F.try_to_date(text, "yyyy-MM-dd").isNotNull()
    if kind == "boolean":
        return F.lower(text).isin("true", "false")
    return F.lit(True)


@dataclass(frozen=True)
class TypedCsv:
    """What a file holds."""

    rows: DataFrame  # the rows whose cells all fit, typed
    errors: DataFrame  # one row per bad row: column (null for ragged rows), value, error, record
    types: dict[str, str]


def header_of(spark: SparkSession, path: str, options: dict[str, str]) -> list[str]:
    return spark.read.options(**options).option("inferSchema", False).csv(path).columns


def read_typed_csv(spark: SparkSession, path: str, multi_line: bool = True, most: float = MOST, **options) -> TypedCsv:
    """The typed rows of a CSV file with a header, and an error row for each row that is left out.

    Empty cells are null and fit every type; a column without any is text. ``multi_line`` lets quoted cells
    span lines, at the cost of one task per file.
    """
    settings = {"header": "true", "multiLine": str(multi_line).lower(), "mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD_RECORD,
                "escape": '"', **options}
    names = header_of(spark, path, settings)
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, BAD_RECORD]])
    cells = pin(spark.read.options(**settings).schema(schema).csv(path))
    col = lambda n: F.col(f"`{n}`")
    whole = cells.where(col(BAD_RECORD).isNull())
    filled = lambda n: col(n).isNotNull() & (F.trim(col(n)) != "")
    counts = whole.agg(*[  # one row: for each column the filled cells, and those each type could hold
        F.array(F.count_if(filled(n)), F.count_if(filled(n) & F.trim(col(n)).rlike("^[+-]?0[0-9]")),
                *[F.count_if(filled(n) & fits(col(n), kind)) for kind in TYPES]).alias(f"c{i}") for i, n in enumerate(names)]).first()

    def type_of(found: list[int]) -> str:
        n, coded, *held = found
        if not n or coded:
            return "string"
        # Whole numbers that do for nearly all must do for all numbers, else the column holds fractions.
        if held[0] >= most * n and held[0] == held[1]:
            return "bigint"
        return next(kind for kind, k in zip(TYPES[1:], held[1:]) if k >= most * n)

    types = {n: type_of(counts[i]) for i, n in enumerate(names)}
    bad = {n: filled(n) & ~F.coalesce(fits(col(n), kind), F.lit(False)) for n, kind in types.items() if kind != "string"}
    # The first bad cell of a row stands for it.
    first = F.coalesce(*[F.when(test, F.struct(F.lit(n).alias("column"), col(n).alias("value"), F.lit(f"no {types[n]}").alias("error")))
                         for n, test in bad.items()], F.lit(None).cast("struct<column:string,value:string,error:string>"))
    ragged = F.struct(F.lit(None).cast("string").alias("column"), F.lit(None).cast("string").alias("value"), F.lit("wrong number of cells").alias("error"))
    found = F.when(col(BAD_RECORD).isNotNull(), ragged).otherwise(first)
    record = F.coalesce(col(BAD_RECORD), F.to_csv(F.struct(*[col(n) for n in names])))
    errors = cells.select(found.alias("e"), record.alias("record")).where("e IS NOT NULL").select("e.*", "record")

    def typed(n: str, kind: str) -> Column:
        text = F.when(filled(n), col(n)) if kind == "string" else F.when(filled(n), F.trim(col(n)))
        return (F.try_to_date(text, "yyyy-MM-dd") if kind == "date" else text.try_cast(kind)).alias(n)

    rows = whole.where(first.isNull()).select(*[typed(n, kind) for n, kind in types.items()])
    return TypedCsv(rows, errors, types)


def error_report(files: dict[str, TypedCsv], spark: SparkSession) -> DataFrame:
    """``check, error``: one row per file, column and kind of error with how many rows it took; joins the validation report."""
    out = spark.createDataFrame([], "check string, error string")
    for name, file in files.items():
        counted = file.errors.groupBy("column", "error").agg(F.count(F.lit(1)).alias("n"))
        text = F.concat_ws(" ", c_text("n", "rows left out:"), F.col("error"), F.concat(F.lit("in column "), F.col("column")))
        out = out.unionByName(counted.select(F.lit(name).alias("check"), text.alias("error")))
    return out


def c_text(number: str, words: str) -> Column:
    return F.concat(F.col(number).cast("string"), F.lit(" "), F.lit(words))

"""S2 / S12 / Q13 — declared schemas on scans: what does not fit becomes a typed reject.

A file is parsed once. Lines that do not fit the declared columns keep their text
and are told apart afterwards (quote left open, number of fields, a field's value);
columns that differ from the declaration are rejects without a source id. The
rest of the load goes on. Rejects have the shape of the error table.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carestar.operators import rejects as R
from carestar.sources.sinks import scratch_table

UNCLOSED_QUOTE, FIELD_COUNT, BAD_VALUE, CORRUPT_ROW = "UNCLOSED_QUOTE", "FIELD_COUNT", "BAD_VALUE", "CORRUPT_ROW"
MISSING_VALUE = "MISSING_VALUE"
COLUMN_MISSING, COLUMN_EXTRA, COLUMN_TYPE = "COLUMN_MISSING", "COLUMN_EXTRA", "COLUMN_TYPE"
RAW = "_raw_line"
OPTIONS = {"quote": '"', "escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": RAW, "columnPruning": False}
ERROR_SHAPE = "source_table string, source_id long, error_type string, error_message string, field_name string, field_value string"


def _column_rejects(spark: SparkSession, table: str, found: dict[str, str], declared: T.StructType, typed: bool) -> DataFrame:
    """What the columns of a file (name to type) have in too little, too much or another type."""
    rows = [(table, None, COLUMN_MISSING, f"Column {f.name} is not in the source", f.name, None)
            for f in declared.fields if f.name not in found]
    rows += [(table, None, COLUMN_EXTRA, f"Column {c} is not declared", c, None) for c in found if c not in declared.fieldNames()]
    if typed:
        rows += [(table, None, COLUMN_TYPE, f"Column {f.name} is {found[f.name]}, declared {f.dataType.simpleString()}", f.name, found[f.name])
                 for f in declared.fields if f.name in found and found[f.name] != f.dataType.simpleString()]
    return spark.createDataFrame(rows, ERROR_SHAPE)


def _missing_values(df: DataFrame, table: str, id_col: str, declared: T.StructType, unless: dict[str, Column] | None = None) -> list[DataFrame]:
    """One reject per null in a column that is declared to have none."""
    need = [f.name for f in declared.fields if not f.nullable]
    nulls = [(c, F.col(c).isNull() & ~(unless or {}).get(c, F.lit(False))) for c in need]
    return [R.reject_rows(df.filter(cond), table, id_col, MISSING_VALUE, F.lit(f"{c} is missing"), c, F.lit(None).cast("string"))
            for c, cond in nulls]


def _complete(df: DataFrame, declared: T.StructType) -> DataFrame:
    need = [F.col(f.name).isNotNull() for f in declared.fields if not f.nullable]
    return df.filter(reduce(lambda a, b: a & b, need)) if need else df


def load_csv(spark: SparkSession, path: str, declared: T.StructType, table: str, id_col: str,
             columns: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """The rows that fit, with the declared columns, and the rejects.

    Columns are matched by the names of the header (of one file: those of a load are written alike) or, for files without
    one, by ``columns``, so their order does not matter; a declared column that is missing is null, one that is not
    declared is left out.
    """
    header = columns or spark.read.options(header=True, quote='"', escape='"').csv(path).columns
    types = {f.name: f.dataType for f in declared.fields}
    as_read = T.StructType([T.StructField(c, types.get(c, T.StringType())) for c in header] + [T.StructField(RAW, T.StringType())])
    parsed = scratch_table(spark.read.schema(as_read).options(**OPTIONS, header=columns is None).csv(path), "csv")        # one pass over the text
    whole = parsed.filter(F.col(RAW).isNull())
    rows = whole.select(*[(F.col(f.name) if f.name in header else F.lit(None).cast(f.dataType)).alias(f.name) for f in declared.fields])

    plain = F.regexp_replace(F.col(RAW), r'"(?:[^"]|"")*"', "")                # without what is quoted
    fields = F.length(plain) - F.length(F.replace(plain, F.lit(","), F.lit(""))) + 1
    texts = F.from_csv(F.col(RAW), ", ".join(f"`{c}` string" for c in header), {"quote": '"', "escape": '"'})
    bad = parsed.filter(F.col(RAW).isNotNull()).select(RAW, texts.alias("t"), plain.contains('"').alias("open"), fields.alias("fields"))
    unfit = F.coalesce(*[F.when(F.col("t")[c].isNotNull() & F.col("t")[c].try_cast(types[c]).isNull(), F.lit(c))
                         for c in header if c in types and not isinstance(types[c], T.StringType)], F.lit(None).cast("string"))
    bad = bad.withColumn("unfit", unfit)
    kind = (F.when(F.col("open"), UNCLOSED_QUOTE).when(F.col("fields") != len(header), FIELD_COUNT)
            .when(F.col("unfit").isNotNull(), BAD_VALUE).otherwise(CORRUPT_ROW))
    value = reduce(lambda rest, c: F.when(F.col("unfit") == c, F.col("t")[c]).otherwise(rest), header, F.lit(None).cast("string"))
    bad = bad.withColumn("error_type", kind)
    field = F.when(F.col("error_type") == BAD_VALUE, F.col("unfit"))
    lines = bad.select(
        F.lit(table).alias("source_table"), F.col("t")[id_col].try_cast("long").alias("source_id"), "error_type",
        F.when(F.col("error_type") == UNCLOSED_QUOTE, "A quote is not closed")
        .when(F.col("error_type") == FIELD_COUNT, F.concat(F.col("fields").cast("string"), F.lit(f" fields in place of {len(header)}")))
        .when(F.col("error_type") == BAD_VALUE, F.concat(F.lit("No valid "), F.col("unfit"))).otherwise("The line cannot be read").alias("error_message"),
        field.alias("field_name"), F.when(F.col("error_type") == BAD_VALUE, value).otherwise(F.col(RAW)).alias("field_value"))
    rejects = [lines, _column_rejects(spark, table, dict.fromkeys(header, ""), declared, False), *_missing_values(rows, table, id_col, declared)]
    return _complete(rows, declared), reduce(DataFrame.unionByName, rejects)


def load_declared(found: DataFrame, declared: T.StructType, table: str, id_col: str) -> tuple[DataFrame, DataFrame]:
    """The rows of a scanned table in the declared columns and types, and the rejects.

    Columns of another type are cast; a row with a value that cannot be is rejected, once per such value.
    """
    spark, types = found.sparkSession, {f.name: f.dataType.simpleString() for f in found.schema.fields}
    fits = {f.name: (F.col(f"`{f.name}`").try_cast(f.dataType) if f.name in types else F.lit(None).cast(f.dataType)) for f in declared.fields}
    cast = [f.name for f in declared.fields if f.name in types and types[f.name] != f.dataType.simpleString()]
    lost = {c: F.col(f"`{c}`").isNotNull() & fits[c].isNull() for c in cast}
    any_lost = reduce(lambda a, b: a | b, lost.values(), F.lit(False))
    rows = found.filter(~any_lost).select(*[v.alias(c) for c, v in fits.items()])
    values = [found.filter(cond).select(
        F.lit(table).alias("source_table"), fits[id_col].cast("long").alias("source_id"), F.lit(BAD_VALUE).alias("error_type"),
        F.lit(f"No valid {c}").alias("error_message"), F.lit(c).alias("field_name"), F.col(f"`{c}`").cast("string").alias("field_value"))
        for c, cond in lost.items()]
    rejects = [_column_rejects(spark, table, types, declared, True), *values, *_missing_values(rows, table, id_col, declared)]
    return _complete(rows, declared), reduce(DataFrame.unionByName, rejects)

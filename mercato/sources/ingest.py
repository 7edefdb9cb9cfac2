"""Bronze ingest (S1-S9): typed CSV sources, declared tables, full overwrite.

* ``read_csv_text`` - header on, schema inference off: every declared column
  is read as text (S1), projected by name in declared order (S2).  A line with
  more or fewer fields than the header is malformed: strict mode raises,
  lenient mode keeps the whole line in a column of its own.
* ``typed`` - per-column casts (S3).  Strict mode keeps Spark's ANSI casts
  (malformed text raises); lenient mode uses ``try_cast`` and returns the
  rejected rows (malformed lines, or text present but not convertible) separately.
* ``create_namespace`` / ``create_table`` - ``CREATE DATABASE/TABLE IF NOT
  EXISTS`` from the declared ``StructType`` with column comments (S6, S7).
* ``overwrite`` - positional overwrite of an existing table, with the loaded
  row count taken from an ``Observation`` of the write itself (S4, S5; no
  second read of the source).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mercato.schemas import BRONZE


#: A malformed line as it stands in the file; null for every other line.
LINE = "_malformed_line"


def read_csv_text(spark: SparkSession, path: str, columns: Sequence[str], strict: bool = True) -> DataFrame:
    """All columns as strings, header on, no inference, projected by name.

    Columns may stand in any order and others may stand beside them; a
    declared column that the header lacks raises, and so does a header with
    unnamed or repeated columns, or a file whose header is another one.

    The parser is told to parse whole lines although columns are pruned: only
    then does it compare a line's fields with the header's.  strict: a
    malformed line fails the job.  lenient: such lines stand in ``LINE``
    beside the declared columns.
    """
    header = spark.read.option("header", "true").option("inferSchema", "false").csv(path).columns
    lost = [c for c in columns if c not in header]
    if lost:
        raise ValueError(f"{path}: no column {', '.join(lost)} in the header {header}")
    reader = (spark.read.option("header", "true").option("enforceSchema", "false").option("columnPruning", "false")
              .option("mode", "FAILFAST" if strict else "PERMISSIVE").option("columnNameOfCorruptRecord", LINE))
    fields = [T.StructField(c, T.StringType()) for c in header if c != LINE]
    df = reader.schema(T.StructType(fields if strict else [*fields, T.StructField(LINE, T.StringType())])).csv(path)
    return df.select(*[F.col(f"`{c}`") for c in columns], *([] if strict else [LINE]))


def typed(df: DataFrame, schema: T.StructType, strict: bool = True) -> tuple[DataFrame, DataFrame | None]:
    """Cast text columns to the declared types.

    strict: ANSI ``cast`` - a malformed value fails the job.
    lenient: ``try_cast``; rows with a non-NULL text that did not convert go
    to the second (reject) DataFrame with the offending column names, and
    malformed lines go there with the line and without columns.
    """
    casts = [F.col(f.name).cast(f.dataType).alias(f.name) if strict
             else F.expr(f"try_cast(`{f.name}` AS {f.dataType.simpleString()})").alias(f.name)
             for f in schema.fields]
    if strict:
        return df.select(*casts), None
    raw = [F.col(f.name).alias(f"_raw_{f.name}") for f in schema.fields]
    line = F.col(LINE) if LINE in df.columns else F.lit(None).cast("string")
    both = df.select(*casts, *raw, line.alias("_line"))
    whole = F.col("_line").isNull()
    bad = [F.when(whole & F.col(f"_raw_{f.name}").isNotNull() & F.col(f.name).isNull(), F.lit(f.name))
           for f in schema.fields]
    both = both.withColumn("_bad", F.array_compact(F.array(*bad)))
    fine = whole & (F.size("_bad") == 0)
    good = both.where(fine).select(*[f.name for f in schema.fields])
    rejects = both.where(~fine).select(
        *[F.when(whole, F.col(f"_raw_{f.name}")).alias(f.name) for f in schema.fields],
        F.col("_bad").alias("rejected_columns"), F.col("_line").alias("rejected_line"))
    return good, rejects


def create_namespace(spark: SparkSession, *databases: str) -> None:
    for db in databases:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}")


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def create_table(spark: SparkSession, name: str, schema: T.StructType, location: str | None = None) -> None:
    cols = ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}"
        + (f" COMMENT {_quoted(f.metadata['comment'])}" if f.metadata.get("comment") else "")
        for f in schema.fields)
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING parquet{loc}")


def overwrite(df: DataFrame, table: str) -> int:
    """Replace all rows of an existing table (positional), return the count."""
    obs = Observation(f"load_{table.replace('.', '_')}")
    df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").insertInto(table)
    return obs.get["rows"]


def ingest_csv(spark: SparkSession, data_path: str, database: str = "bronze",
               strict: bool = True) -> dict[str, int]:
    """Load the four source CSVs (``<table>.csv``) into ``database``.

    Returns the loaded rows per table.  With ``strict=False`` rows that do not
    convert are stored as text in ``<table>_rejects``, with the names of the
    offending columns, malformed lines as they stand, and both counted there.
    """
    create_namespace(spark, database)
    counts = {}
    for table, schema in BRONZE.items():
        name = f"{database}.{table}"
        create_table(spark, name, schema)
        text = read_csv_text(spark, f"{data_path.rstrip('/')}/{table}.csv", [f.name for f in schema.fields], strict)
        good, rejects = typed(text, schema, strict)
        counts[table] = overwrite(good, name)
        if rejects is not None:
            obs = Observation(f"rejects_{table}")
            (rejects.observe(obs, F.count(F.lit(1)).alias("rows"))
             .write.mode("overwrite").format("parquet").saveAsTable(f"{name}_rejects"))
            counts[f"{table}_rejects"] = obs.get["rows"]
    return counts


def export_csv(df: DataFrame, path: str) -> None:
    """Write a table as header CSV text (the source format of the ingest)."""
    df.write.mode("overwrite").option("header", "true").csv(path)

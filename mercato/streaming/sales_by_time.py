"""Sales-by-time kept up to date with Structured Streaming.

The batch mart (``mercato.plans.marts.sales_by_time``) is recomputed from the
whole sales table.  Here new sales files are consumed as a stream:

* source: ``readStream`` over a folder of sales files (schema given, no
  inference), ``maxFilesPerTrigger`` bounds a micro-batch;
* state: one row per (day, hour, channel, customer) with count, units and
  revenue, which is what exact distinct customers need, kept as a log of parts
  (``deltas``): each micro-batch writes its own sums, not the whole state;
* a part is never changed in place: a reader sees whole batches only, and a
  batch that is run again after a failure writes the same rows or nothing;
* progress lives in the checkpoint folder, so a restarted query resumes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mercato.functions import columns as C
from mercato.schemas import GOLD, conform
from mercato.streaming.deltas import DeltaState

CELL = ["data", "hora", "canal_venda"]


def buyer_totals(sales: DataFrame) -> DataFrame:
    """Sales -> one row per cell and customer."""
    return (sales.withColumn("data", F.to_date("data_venda")).withColumn("hora", F.hour("data_venda"))
            .groupBy(*CELL, "id_cliente")
            .agg(F.count(F.lit(1)).alias("n"), F.sum("quantidade").alias("q"),
                 F.sum("receita").cast("decimal(20,2)").alias("r")))


def cells(buyers: DataFrame) -> DataFrame:
    """One row per cell and customer -> the mart."""
    out = buyers.groupBy(*CELL).agg(
        F.sum("n").alias("total_vendas"), F.sum("q").alias("itens_vendidos"), F.sum("r").alias("receita"),
        F.count("id_cliente").alias("clientes_unicos"))
    out = out.withColumn("dia_semana_num", F.dayofweek("data"))
    return conform(out.withColumn("dia_semana", C.weekday_name(F.col("dia_semana_num"))), GOLD["sales_by_time"])


def merged(buyers: DataFrame) -> DataFrame:
    """Rows of several parts -> one row per cell and customer."""
    return buyers.groupBy(*CELL, "id_cliente").agg(
        F.sum("n").alias("n"), F.sum("q").alias("q"), F.sum("r").cast("decimal(20,2)").alias("r"))


def run(spark: SparkSession, source_dir: str, schema: T.StructType, to_sales,
        checkpoint: str, table_path: str, glob: str | None = None,
        files_per_trigger: int = 100) -> DataFrame:
    """Consume every file now in ``source_dir`` (``availableNow``), keep the
    state, and return the mart from its last parts.

    ``to_sales`` maps a source frame to sales columns (data_venda, canal_venda,
    id_cliente, quantidade, receita).
    """
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    state = DeltaState(spark, table_path, merged)
    q = (to_sales(reader.parquet(source_dir)).writeStream
         .foreachBatch(lambda batch, epoch: state.append(buyer_totals(batch), epoch))
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    buyers = state.read()
    if buyers is None:
        buyers = buyer_totals(to_sales(spark.createDataFrame([], schema)))
    return cells(merged(buyers))

"""Incremental fund summary over yearly files as they arrive.

The batch pipeline re-reads every yearly file when a new one lands. Here a
file-source stream picks up only new files, joins each row to the static
rate table (stream-static left join, no state), and keeps the per
(year, municipality) fund sums as streaming aggregation state. Each trigger
rewrites the long, filtered summary as a snapshot table, so a restarted job
(same checkpoint) resumes exactly where it stopped.

State is one row per (year, municipality): it grows with the number of
years and municipalities, not with the number of parcels.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fundflow.functions import clean
from fundflow.plans import pipeline as pl
from fundflow.plans.domain import Domain
from fundflow.sources import all_string_schema


def read_yearly_stream(spark: SparkSession, input_dir: str, columns: Sequence[str],
                       pattern: str | None = None, null_token: str = "NA",
                       max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming all-text CSV read of the files landing in ``input_dir``."""
    r = (spark.readStream.schema(all_string_schema(columns)).option("header", True)
         .option("nullValue", null_token))
    if pattern:
        r = r.option("pathGlobFilter", pattern)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.csv(input_dir).withColumn("SourceFile", F.col("_metadata.file_name"))


def tif_fund_stream(raw: DataFrame, rates: DataFrame, dom: Domain, scope: str | None = None,
                    amount: str = "DivertedTownship") -> DataFrame:
    """Streaming wide fund sums (TaxYear, Municipality, General, Fire, Road)."""
    src = raw.filter(clean.trim_ws("Township") == F.lit(scope)) if scope else raw
    app = pl.apportion_sum_rates(pl.tif_fact(src, dom, amount), rates, dom, amount)
    return pl.fund_wide(app, dom)


def abatement_fund_stream(raw: DataFrame, rates: DataFrame, dom: Domain,
                          amount: str = "ForegoneTownship") -> DataFrame:
    app = pl.apportion_total_rate(pl.abatement_fact(raw, dom, amount), rates, dom, amount)
    return pl.fund_wide(app, dom)


def start_summary(wide_stream: DataFrame, dom: Domain, value_name: str, output_path: str,
                  checkpoint: str, available_now: bool = True,
                  processing_time: str | None = None) -> StreamingQuery:
    """Run the stream; each trigger overwrites ``output_path`` with the long,
    filtered summary of everything seen so far (idempotent per epoch)."""

    def snapshot(batch: DataFrame, epoch_id: int) -> None:
        pl.fund_long(batch, dom, value_name).write.mode("overwrite").parquet(output_path)

    w = (wide_stream.writeStream.outputMode("complete").foreachBatch(snapshot)
         .option("checkpointLocation", checkpoint))
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start()

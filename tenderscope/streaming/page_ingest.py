"""Incremental paged ingest (S2 over newly landed files).

The stream moves landed pages, as they are, into a bronze table with one
partition per micro-batch; a batch that is replayed after a failure overwrites
its own partition, so no page is there twice.  The stop page of a key is found
on reading (``assembled``), over all its pages, whichever batches they came in.
``availableNow`` processes what has landed and stops, so the job can run on a
schedule like the batch pull it replaces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..sources.files import with_ingest_ts
from ..sources.pages import assemble_pages

PAGE_SCHEMA = "org STRING, `mes/ano` STRING, page_no INT, status INT, body STRING"


def start_page_ingest(spark: SparkSession, landing_dir: str, bronze_dir: str, checkpoint_dir: str,
                      available_now: bool = True, max_files_per_trigger: int = 1000, schema: str = PAGE_SCHEMA):
    """Start the stream; returns the ``StreamingQuery``."""
    pages = (spark.readStream.schema(schema)
             .option("maxFilesPerTrigger", max_files_per_trigger)
             .json(landing_dir))

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        with_ingest_ts(batch).write.mode("overwrite").parquet(f"{bronze_dir}/lote={batch_id}")

    w = pages.writeStream.option("checkpointLocation", checkpoint_dir).foreachBatch(write_batch)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def assembled(spark: SparkSession, bronze_dir: str, record_schema: StructType, keys=("org", "mes/ano")) -> DataFrame:
    """The records of all pages ingested so far."""
    return assemble_pages(spark.read.parquet(bronze_dir), list(keys), record_schema)

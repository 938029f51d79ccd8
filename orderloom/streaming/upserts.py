"""New and changed rows, as they arrive, into an incremental table."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from orderloom.sources.tables import upsert_table


def stream_upsert(
    spark: SparkSession,
    src_dir: str,
    schema: StructType,
    target: str,
    keys: Sequence[str],
    partition_by: Sequence[str],
    checkpoint: str,
    *,
    transform: Callable[[DataFrame], DataFrame] = lambda df: df,
    order_by: Sequence[str | Column],
    old_rows_in: Column | str | None = None,
    ignore: Sequence[str] = (),
    file_format: str = "parquet",
    max_files_per_trigger: int | None = None,
    **reader_options: str,
) -> StreamingQuery:
    """Read files not seen before, stage them with ``transform``, and upsert each micro-batch.

    A changed record arrives as a new row with an old key and takes the old row's place. A record that
    arrives as it is stored (``ignore`` columns apart) rewrites nothing, and a batch replayed after a failure changes
    nothing. Every micro-batch reads the index buckets of its keys and the partitions it changes. With ``old_rows_in`` it
    instead searches the keys of the partitions that satisfy it. The stream processes
    all that is there and stops; running it again goes on from ``checkpoint``. ``read_changes`` hands on
    what the micro-batches have changed.
    """
    reader = spark.readStream.schema(schema).format(file_format).options(**reader_options)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)

    def load(batch: DataFrame, _batch_id: int) -> None:
        upsert_table(
            transform(batch), target, keys, partition_by, order_by=order_by, old_rows_in=old_rows_in, ignore=ignore
        )

    return (
        reader.load(src_dir)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )

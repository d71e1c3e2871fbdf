"""New files as a stream: each run takes what arrived since the last one and merges it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.operators import lifecycle as L
from tradeloom.operators.store import LayerStore
from tradeloom.plans.ingest import LAYER0_LINEAGE


def ingest_new_files(
    store: LayerStore,
    table: str,
    folder: str,
    schema: str,
    checkpoint: str,
    file_format: str = "parquet",
    files_per_batch: int | None = None,
    **options,
) -> int:
    """Merge every file of ``folder`` that no earlier run has seen; returns the number of merges.

    The stream's checkpoint remembers the files. A batch that is repeated after a failure merges again under
    the same label, which changes nothing, because known rows are matched by their fingerprint.
    """
    merges = 0

    def merge(batch: DataFrame, number: int) -> None:
        nonlocal merges
        label = f"batch-{number}"
        layer = store.read_or_empty(table, LAYER0_LINEAGE + schema)
        store.publish(table, L.snapshot_merge(layer, batch, label), label)
        merges += 1

    reader = store.spark.readStream.schema(schema).format(file_format).options(**options)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    query = (
        reader.load(folder)
        .writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return merges


def arrived_since(store: LayerStore, table: str, batch: int) -> DataFrame:
    """Rows first seen in ``batch`` or later."""
    number = F.substring_index("datafile_created", "-", -1).cast("int")
    return store.read(table).where(number >= batch)

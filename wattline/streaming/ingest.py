"""Ingesting documents as they arrive.

The stream remembers in its checkpoint which files it has delivered. Each micro-batch is
ingested like any other batch, named by its number, so a micro-batch that is delivered a
second time after a failure leaves the same tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from wattline.plans.ingest import ingest
from wattline.schemas import Dataset


def ingest_stream(
    documents: DataFrame,
    dataset: Dataset | str,
    root: str,
    checkpoint: str,
    interval: str | None = None,
) -> StreamingQuery:
    """Starts ingesting a stream of ``(source_object_name, content, arrived_at)``.

    Without ``interval`` it takes everything that is there and ends. Documents are
    independent of each other and a revision is picked later, so no state or watermark is
    held: late documents need none.
    """

    def one_batch(rows: DataFrame, number: int) -> None:
        ingest(rows.sparkSession, rows, dataset, root, f"stream-{number}")

    writer = documents.writeStream.foreachBatch(one_batch).option("checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if interval is None else {"processingTime": interval}
    return writer.trigger(**trigger).start()

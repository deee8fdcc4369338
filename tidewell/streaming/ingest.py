"""Bronze ingestion of new files only: the batch step driven by a file stream that stops when it is level."""

from __future__ import annotations

from tidewell.plans.pipeline import Lakehouse, load_bronze
from tidewell.plans.silver import Feed
from tidewell.sources.json_feed import MALFORMED, with_malformed, without_nan


def ingest_new_files(house: Lakehouse, feed: Feed, folder: str, run_id: str, files_per_batch: int = 1000) -> None:
    """Upsert every record-per-line file of ``folder`` that no earlier run has taken.

    The stream checkpoint remembers the files.  A batch that is repeated after a failure changes
    nothing, because the upsert replaces rows by key.
    """
    reader = house.spark.readStream.schema(with_malformed(feed.layout)).option("columnNameOfCorruptRecord", MALFORMED)
    arrivals = without_nan(reader.option("maxFilesPerTrigger", files_per_batch).json(folder), feed.layout)
    query = (
        arrivals.writeStream.trigger(availableNow=True)
        .option("checkpointLocation", f"{house.root}/progress/{feed.name}")
        .foreachBatch(lambda batch, _: load_bronze(house, feed, batch, run_id))
        .start()
    )
    query.awaitTermination()

"""Links records of B as they arrive to a fixed table of A."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from weft.functions.text import normalised
from weft.plans import model as models
from weft.plans import pipeline


def link_stream(arriving: DataFrame, a: DataFrame, model: PipelineModel, config: models.Config, path: str, checkpoint: str, dictionary: dict[str, str] | None = None) -> StreamingQuery:
    """Starts a query that appends the matches of each micro-batch of raw ``arriving`` records to the table at ``path``.

    One A for each B holds within a batch by itself, as each record comes in one batch. Term frequencies and competition
    are those of the batch. A batch that is run again overwrites its own folder, so results are written once."""

    def each(batch: DataFrame, number: int) -> None:
        found = pipeline.link(a, normalised(batch, dictionary), model, config)
        found.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return arriving.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

"""Loading a dimension from a stream of source files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from dimflow.operators.cleaning import clean, dedup_latest
from dimflow.plans.pipeline import apply_scd
from dimflow.sources.tables import overwrite_table
from dimflow.spec import PipelineSpec, check_specs


def feed_dimension(source: DataFrame, spec: PipelineSpec, checkpoint: str, as_of: str | None = None) -> StreamingQuery:
    """Merge each micro-batch of raw rows as one load. A batch repeated after a failure finds nothing changed."""
    check_specs([spec])
    if not spec.merges:
        raise ValueError("a feed adds to what is there: use load='merge'")

    def load(batch: DataFrame, batch_id: int) -> None:
        rows = clean(batch, spec)
        if spec.dedup_order:
            rows = dedup_latest(rows, [spec.key], spec.dedup_order)
        apply_scd(overwrite_table(rows, spec.staging_table), spec, as_of)

    return (source.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())

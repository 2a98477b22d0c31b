"""Record-at-a-time scoring as a stateless stream.

A prediction request is one record in, one record out.  As a stream that is the same
plan as batch scoring: no state, no watermark, no shuffle.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..ml.models import PROBABILITY, event_probability
from ..operators import scoring

RECORD_COLUMNS = ["risk_score", "risk_category", "adverse_event_flag", "threshold_used", "clinical_message"]


def scored_records(pipeline: PipelineModel, info: dict, records: DataFrame, ids: list[str]) -> DataFrame:
    """Works on a batch or a streaming frame alike.

    A record outside the input bounds is not scored: its result columns are null and
    ``reasons`` names the offending fields.
    """
    checked = scoring.with_reasons(records)
    valid = F.size("reasons") == 0
    risky = scoring.risk_records(event_probability(pipeline, checked), info["optimal_threshold"], PROBABILITY)
    results = {c: F.when(valid, F.col(c)) for c in RECORD_COLUMNS}
    return risky.withColumns(results).select(*ids, *RECORD_COLUMNS, "reasons")


def score_stream(
    pipeline: PipelineModel,
    info: dict,
    records: DataFrame,
    ids: list[str],
    path: str,
    checkpoint: str,
    once: bool = True,
) -> StreamingQuery:
    """Append scored records to parquet; the checkpoint makes a restart exactly-once."""
    writer = (
        scored_records(pipeline, info, records, ids)
        .writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )
    return (writer.trigger(availableNow=True) if once else writer).start()

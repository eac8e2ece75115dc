"""Event ingestion with Structured Streaming: append raw events by type and ingestion day."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from stratalake.functions import column
from stratalake.plans.literacy_tables import EVENTS
from stratalake.sources.events import RAW_PAYLOAD, TYPE_COLUMN
from stratalake.sources.writers import ingestion_columns

# Fixed value: where the type stands in an event.
TYPE_PATH = "$.tipo_mensagem"
UNKNOWN_TYPE = "unknown"
# How often a stream writes unless told otherwise: each write makes files per task, type and day.
TRIGGER = {"processingTime": "1 minute"}
PARTITION_COLUMNS = (TYPE_COLUMN, "ingest_year", "ingest_month", "ingest_day")


def envelope(raw: DataFrame, payload: str = "body", known_types: Collection[str] = tuple(EVENTS)) -> DataFrame:
    """Raw text, type and ingestion time of each event. Events whose type is none of ``known_types`` are "unknown".

    Types become folder names, so text of the payload may not choose them freely. Works on batch and streaming frames; ``payload`` may be binary or text. The payload is kept whole.
    """
    text = column(payload).cast("string")
    kind = F.get_json_object(text, TYPE_PATH)
    known = F.when(kind.isin(*known_types), kind)
    return raw.select(
        text.alias(RAW_PAYLOAD),
        F.coalesce(known, F.lit(UNKNOWN_TYPE)).alias(TYPE_COLUMN),
        *[value.alias(name) for name, value in ingestion_columns().items()],
    )


def start_ingest(
    raw: DataFrame,
    path: str,
    checkpoint: str,
    payload: str = "body",
    trigger: dict | None = None,
    known_types: Collection[str] = tuple(EVENTS),
) -> StreamingQuery:
    """Start appending the streaming frame ``raw`` to ``path``.

    The checkpoint records what was read and committed, so a restart continues without repeating rows.
    ``trigger`` holds the keyword of ``DataStreamWriter.trigger``, such as ``{"availableNow": True}``; by default a
    batch is written every minute.
    The query keeps no state and does not shuffle.
    """
    writer = (
        envelope(raw, payload, known_types)
        .writeStream.format("json")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .partitionBy(*PARTITION_COLUMNS)
    )
    return writer.trigger(**(trigger or TRIGGER)).start(path)

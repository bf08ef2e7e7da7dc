"""The device event rules on a stream of landed JSON files.

All of them are stateless, so the stream needs no watermark: each micro-batch is joined with the
device table as it is at that moment.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from aforo.functions.timestamps import convert_tz
from aforo.operators.events import only_authorised, vehicle_events, with_gate

EVENT_SCHEMA = T.StructType(
    [
        T.StructField("event_identifier", T.StringType()),
        T.StructField("device_source_id", T.StringType()),
        T.StructField("device_mac_address", T.StringType()),
        T.StructField("date_detection", T.StringType()),
        T.StructField("vehicle_license_plate", T.StringType()),
    ]
)


def read_events(spark: SparkSession, path: str, files_per_trigger: int = 1000) -> DataFrame:
    return (
        spark.readStream.schema(EVENT_SCHEMA)
        .option("maxFilesPerTrigger", files_per_trigger)
        .json(path)
    )


def accept_events(
    events: DataFrame,
    devices: DataFrame,
    from_tz: str,
    to_tz: str,
    plate_required: bool = False,
) -> DataFrame:
    """Events of registered devices with gate, plate rule and detection time in the target zone."""
    known = with_gate(only_authorised(events, devices), devices)
    plated = vehicle_events(known, "vehicle_license_plate", plate_required)
    return convert_tz(plated, ["date_detection"], from_tz, to_tz)


def start_intake(accepted: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append to a Parquet table; the file sink and its checkpoint give each event once."""
    return (
        accepted.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )

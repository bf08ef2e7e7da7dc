"""Device events: authorisation, gate lookup, vehicle rules, deletes with their dependants."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aforo.functions.keys import UNKNOWN
from aforo.operators.joins import fits_broadcast, lookup_join, reduced_join

DEVICE, MAC, SUBTYPE, GATE = "device_source_id", "device_mac_address", "device_subtype", "gate_id"
NOT_APPLICABLE = "Not Applicable"
WITH_NULLS = {"ignoreNullFields": "false"}


def authorise(
    events: DataFrame, devices: DataFrame, device: str = DEVICE, mac: str = MAC, subtype: str = SUBTYPE
) -> DataFrame:
    """Add ``authorised`` and the device's subtype, ``Not Applicable`` for unknown devices.

    A device registered several times counts once, with the greatest of its subtypes.
    """
    known = devices.groupBy(device, mac).agg(
        F.max(subtype).alias(subtype), F.lit(True).alias("authorised")
    )
    small = fits_broadcast(devices.select(device, mac, subtype))
    joined = reduced_join(events, known, [(device, device), (mac, mac)], small)
    label = F.when(F.col("authorised"), F.col(subtype)).otherwise(F.lit(NOT_APPLICABLE))
    return joined.withColumns(
        {subtype: label, "authorised": F.coalesce("authorised", F.lit(False))}
    )


def only_authorised(
    events: DataFrame, devices: DataFrame, device: str = DEVICE, mac: str = MAC
) -> DataFrame:
    """Events whose device and address are registered."""
    return lookup_join(
        events, devices.select(device, mac), [(device, device), (mac, mac)], "left_semi"
    )


def with_gate(
    events: DataFrame, devices: DataFrame, device: str = DEVICE, gate: str = GATE
) -> DataFrame:
    """Add the gate of the device, NULL where unknown; several gates give the least."""
    gates = devices.groupBy(device).agg(F.min(gate).alias(gate))
    small = fits_broadcast(devices.select(device, gate))
    return reduced_join(events, gates, [(device, device)], small)


def vehicle_events(
    df: DataFrame, plate: str, plate_required: bool = False, unknown: str = UNKNOWN
) -> DataFrame:
    """Missing plate becomes ``unknown``; with ``plate_required`` such rows are dropped."""
    if plate_required:
        return df.filter(F.col(plate) != F.lit(unknown))
    return df.withColumn(plate, F.coalesce(F.col(plate), F.lit(unknown)))


def deletion_audit(
    df: DataFrame,
    keys: DataFrame,
    id_column: str,
    schema_name: str,
    table_name: str,
    category: str,
    reason: str,
    username: str,
) -> DataFrame:
    """One audit row per deleted row: the whole record as JSON, and who removed it and why."""
    doomed = lookup_join(df, keys.select(id_column), [(id_column, id_column)], "left_semi")
    return doomed.select(
        F.lit(schema_name).alias("schema_name"),
        F.lit(table_name).alias("table_name"),
        F.lit(id_column).alias("id_column"),
        F.col(id_column).cast("string").alias("id_value"),
        F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), WITH_NULLS).alias(
            "record_json"
        ),
        F.lit(category).alias("category"),
        F.lit(reason).alias("reason"),
        F.lit(username).alias("username"),
    )


def without_keys(df: DataFrame, keys: DataFrame, column: str, small: bool | None = None) -> DataFrame:
    """Rows whose ``column`` is not among the keys; a NULL value stays."""
    return lookup_join(df, keys.select(column), [(column, column)], "left_anti", small)


def delete_with_audit(
    df: DataFrame, keys: DataFrame, id_column: str, **meta: str
) -> tuple[DataFrame, DataFrame]:
    """(audit rows, remaining rows). Write the audit before the remainder replaces the table."""
    return deletion_audit(df, keys, id_column, **meta), without_keys(df, keys, id_column)


def clear_references(
    df: DataFrame, keys: DataFrame, reference: str, key: str, also: Sequence[str] = ()
) -> DataFrame:
    """Set ``reference`` and the columns ``also`` to NULL where they point to a removed key."""
    removed = keys.select(F.col(key).alias("__removed_key")).distinct()
    removed = removed.withColumn("__removed", F.lit(True))
    small = fits_broadcast(keys.select(key))
    joined = reduced_join(df, removed, [(reference, "__removed_key")], small)
    cleared = {
        c: F.when(F.col("__removed").isNull(), F.col(c)) for c in (reference, *also)
    }
    return joined.withColumns(cleared).drop("__removed")


def cascade_delete(
    tables: Mapping[str, DataFrame],
    keys: DataFrame,
    key: str,
    images: str = "camera_event_images",
    predictions: str = "image_predictions",
    image_name: str = "image_name",
) -> dict[str, DataFrame]:
    """Remaining rows of the event tables after deleting by device or event.

    Predictions hang on image names, which are taken from the image table as it was before. The keys are measured
    once, and the image names by the image table that bounds them.
    """
    small = fits_broadcast(keys.select(key))
    out = {
        name: without_keys(df, keys, key, small) for name, df in tables.items() if name != predictions
    }
    if predictions in tables:
        doomed = lookup_join(tables[images], keys.select(key), [(key, key)], "left_semi", small)
        few = fits_broadcast(tables[images].select(image_name))
        out[predictions] = without_keys(tables[predictions], doomed, image_name, few)
    return out


def link_registration(
    vehicles: DataFrame, registrations: DataFrame, id_column: str, reference: str = "reference_id"
) -> DataFrame:
    """Put the registration's id on the vehicle rows of its reference; the latest id wins.

    Vehicle rows without a registration keep the id they have. Ids are reduced to one per reference
    before the join, so no vehicle row can multiply.
    """
    latest = (
        registrations.filter(F.col(reference).isNotNull())
        .groupBy(reference)
        .agg(F.max(id_column).alias("__linked"))
    )
    small = fits_broadcast(registrations.select(reference, id_column))
    joined = reduced_join(vehicles, latest, [(reference, reference)], small)
    return joined.withColumn(id_column, F.coalesce("__linked", id_column)).drop("__linked")

"""Open-data catalogue: one row per resource."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PACKAGE_COLUMNS = ("package_id", "package_name", "package_title", "package_notes")
ORGANIZATION_COLUMNS = ("inst_title", "inst_name", "inst_id")


def flatten_catalogue(packages: DataFrame) -> DataFrame:
    """One row per resource with its package and organisation; packages without resources vanish.

    Organisation columns are NULL where the organisation is absent or null. A resource field named
    like a package column gives way to it.
    """
    organized = "organization" in packages.columns

    def of_organization(field: str):
        return F.col(f"organization.{field}") if organized else F.lit(None).cast("string")

    rows = packages.select(
        F.explode("resources").alias("resource"),
        F.col("id").alias("package_id"),
        F.col("name").alias("package_name"),
        F.col("title").alias("package_title"),
        F.col("notes").alias("package_notes"),
        of_organization("title").alias("inst_title"),
        of_organization("name").alias("inst_name"),
        of_organization("id").alias("inst_id"),
    )
    taken = {*PACKAGE_COLUMNS, *ORGANIZATION_COLUMNS}
    fields = [f for f in rows.schema["resource"].dataType.fieldNames() if f not in taken]
    return rows.select(
        *[F.col(f"resource.`{f}`").alias(f) for f in fields],
        *PACKAGE_COLUMNS,
        *ORGANIZATION_COLUMNS,
    )

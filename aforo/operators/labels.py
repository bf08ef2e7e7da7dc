"""Code labelling: one dimension may serve several role columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aforo.operators.joins import fits_broadcast, lookup_join

UNKNOWN_CODE = -1

# Spark's own limit for whole-stage code (spark.sql.codegen.maxFields).
WIDE = 100


@dataclass(frozen=True)
class Role:
    """The code column ``code`` is labelled from ``dimension`` into the column ``label``."""

    code: str
    dimension: str
    label: str


# The role lists of the two trade tables.
IMPORT_ROLES = (
    Role("ADU", "aduana", "aduana_nombre"),
    Role("CL_COMPRA", "clausula_compra", "clausula_compra_nombre"),
    Role("TIPO_DOCTO", "documento_ingreso", "documento_ingreso_nombre"),
    Role("MONEDA", "monedas", "moneda_nombre"),
    Role("PA_ORIG", "pais", "pais_nombre_origen"),
    Role("PA_ADQ", "pais", "pais_nombre_adquisicion"),
    Role("CODPAISCON", "pais", "pais_nombre_consignante"),
    Role("CODPAISCIA", "pais", "pais_nombre_cia_transporte"),
    Role("PTO_EMB", "puertos", "puerto_nombre_embarque"),
    Role("PTO_DESEM", "puertos", "puerto_nombre_desembarque"),
    Role("VIA_TRAN", "transporte", "transporte_nombre"),
    Role("MEDIDA", "unidad", "unidad_nombre"),
)
EXPORT_ROLES = (
    Role("ADUANA", "aduana", "aduana_nombre"),
    Role("VIATRANSPORTE", "transporte", "transporte_nombre"),
    Role("PAISCIATRANSP", "pais", "paisciatransp_nombre"),
    Role("MONEDA", "monedas", "moneda_nombre"),
    Role("UNIDADMEDIDA", "unidad", "unidad_nombre"),
)


def label_codes(
    df: DataFrame,
    dims: Mapping[str, DataFrame],
    roles: Sequence[Role],
    unknown_code: int = UNKNOWN_CODE,
) -> DataFrame:
    """Add one label column per role by left joins.

    A NULL code takes the label of ``unknown_code``; a code the dimension does not know takes NULL.
    Each dimension is two columns, code and name, in this order; its size is checked once however
    many roles it serves.

    Above ``WIDE`` columns Spark leaves whole-stage code and copies every column once per join. Such
    a row is packed into one struct, which the joins hand on as a single value, and unpacked after
    the last. Columns that nobody reads are still pruned from the scan.
    """
    used = {r.dimension: dims[r.dimension] for r in roles}
    small = {name: fits_broadcast(dim) for name, dim in used.items()}
    codes = {
        f"__code_{i}": F.coalesce(F.col(r.code), F.lit(unknown_code)) for i, r in enumerate(roles)
    }
    wide = len(df.columns) > WIDE
    if wide:
        packed = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("__row")
        df = df.select(packed, *[code.alias(name) for name, code in codes.items()])
        codes = {name: F.col(name) for name in codes}
    for role, code in zip(roles, codes.values(), strict=True):
        dim = used[role.dimension].toDF("code", role.label)
        df = lookup_join(df, dim, [(code, "code")], "left", small=small[role.dimension])
    return df.select("__row.*", *[r.label for r in roles]) if wide else df


def label_imports(df: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    return label_codes(df, dims, IMPORT_ROLES)


def label_exports(df: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    return label_codes(df, dims, EXPORT_ROLES)

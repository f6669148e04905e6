"""The eight source tables of the job and their ingest normalisation.

The source system compares text under a case-insensitive collation that ignores
trailing blanks.  Spark compares bytes, so code and label columns are
upper-cased and right-trimmed once at ingest; all later predicates are then
plain equality and stay inside whole-stage codegen.
"""

from __future__ import annotations

from dataclasses import dataclass, fields, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Columns of each table and the type they are kept as.  Campaign and sale codes are digit strings and stay as they are;
# prices are doubles, whatever the source stores.
COLUMNS = {
    "country": {"CodPais": "string"},
    "product": {"PKProducto": "bigint", "CodCUC": "string", "DesMarca": "string", "CodCategoria": "string",
                "DesCategoria": "string", "DesUnidadNegocio": "string"},
    "offer_type": {"PKTipoOferta": "bigint", "CodTipoOferta": "string", "CodTipoProfit": "string"},
    "sales": {"AnioCampana": "string", "AnioCampanaRef": "string", "PKProducto": "bigint", "PKTipoOferta": "bigint",
              "RealUUVendidas": "bigint", "RealUUFaltantes": "bigint"},
    "plan": {"AnioCampana": "string", "PKProducto": "bigint", "PKTipoOferta": "bigint", "CodVenta": "string",
             "DesTipoCatalogo": "string", "DesUbicacionCatalogo": "string", "DesLadoPag": "string",
             "DesExposicion": "string", "NroPaginas": "bigint", "PaginaCatalogo": "bigint", "FotoProducto": "string",
             "FotoModelo": "string", "FlagDiscover": "int", "PrecioOferta": "double"},
    "estimates": {"AnioCampana": "string", "AnioCampanaRef": "string", "PKProducto": "bigint",
                  "PKTipoOferta": "bigint", "EstUUVendidas": "bigint", "PrecioOfertaDol": "double",
                  "PrecioNormalDol": "double", "PrecioNormalMN": "double"},
    "support": {"AnioCampana": "string", "PKProductoApoyador": "bigint", "PKProductoApoyado": "bigint",
                "PKTipoOfertaApoyador": "bigint"},
    "orders": {"AnioCampana": "string", "RealNroPedidos": "bigint"},
}
# Text columns compared against constants (normalised at ingest).
_CODE_COLUMNS = {
    "country": ("CodPais",),
    "product": ("DesUnidadNegocio", "DesCategoria"),
    "offer_type": ("CodTipoOferta", "CodTipoProfit"),
    "plan": ("DesTipoCatalogo", "DesUbicacionCatalogo", "DesLadoPag", "DesExposicion", "FotoProducto", "FotoModelo"),
}
# Facts, stored partitioned by campaign.
PARTITIONED = ("sales", "plan", "estimates", "support")

# Table name in the source system, per field of Tables.
SOURCE_NAMES = {
    "country": "DPais",
    "product": "DPRODUCTO",
    "offer_type": "DTIPOOFERTA",
    "sales": "FVTAPROEBECAMC01",
    "plan": "DMATRIZCAMPANA",
    "estimates": "FVTAPROCAMMES",
    "support": "DAPOYOPRODUCTO",
    "orders": "FNUMPEDCAM",
}


@dataclass(frozen=True)
class Tables:
    country: DataFrame      # DPais: CodPais
    product: DataFrame      # DPRODUCTO: PKProducto, CodCUC, DesMarca, CodCategoria, DesCategoria, DesUnidadNegocio
    offer_type: DataFrame   # DTIPOOFERTA: PKTipoOferta, CodTipoOferta, CodTipoProfit
    sales: DataFrame        # FVTAPROEBECAMC01: AnioCampana, AnioCampanaRef, PKProducto, PKTipoOferta, RealUUVendidas, RealUUFaltantes
    plan: DataFrame         # DMATRIZCAMPANA: page plan of the printed catalogues
    estimates: DataFrame    # FVTAPROCAMMES: estimated units and prices
    support: DataFrame      # DAPOYOPRODUCTO: supporting / supported product pairs
    orders: DataFrame       # FNUMPEDCAM: AnioCampana, RealNroPedidos

    def normalised(self) -> "Tables":
        """Every table with its columns, types and text normalisation; raises where a column is missing."""
        return replace(self, **{f.name: normalise(getattr(self, f.name), f.name) for f in fields(self)})

    def with_country(self, country: DataFrame) -> "Tables":
        return replace(self, country=country)


def _require(df: DataFrame, name: str) -> None:
    missing = [c for c in COLUMNS[name] if c not in df.columns]
    if missing:
        raise ValueError(f"{SOURCE_NAMES[name]} lacks {', '.join(missing)}")


def normalise(df: DataFrame, name: str) -> DataFrame:
    """The table's columns in their types; code and label texts upper-cased and right-trimmed."""
    _require(df, name)
    code = _CODE_COLUMNS.get(name, ())
    return df.select(*[(F.upper(F.rtrim(F.col(c).cast("string"))) if c in code else F.col(c).cast(kind)).alias(c)
                       for c, kind in COLUMNS[name].items()])


def store_tables(t: Tables, root: str, names: tuple[str, ...] = tuple(SOURCE_NAMES)) -> None:
    """Ingest: write the normalised tables (or those of ``names``) as parquet below ``root``, facts partitioned by campaign.

    Later runs read them with ``normalised=True`` and filter the stored columns, which reach the parquet scan.
    """
    for name, df in [(f.name, normalise(getattr(t, f.name), f.name)) for f in fields(t) if f.name in names]:
        if name in PARTITIONED:
            # small campaigns are coalesced, a large one is split over several tasks and files
            df.hint("rebalance", "AnioCampana").write.partitionBy("AnioCampana").parquet(f"{root}/{SOURCE_NAMES[name]}")
        else:
            df.write.parquet(f"{root}/{SOURCE_NAMES[name]}")


def read_stored(spark: SparkSession, root: str, name: str) -> DataFrame:
    """One table as ``store_tables`` wrote it."""
    return spark.read.schema(", ".join(f"{c} {k}" for c, k in COLUMNS[name].items())).parquet(f"{root}/{SOURCE_NAMES[name]}")


def read_tables(spark: SparkSession, root: str, fmt: str = "parquet", normalised: bool = False) -> Tables:
    """Read the eight tables stored as ``<root>/<SOURCE_NAME>``.

    ``normalised`` says that ``store_tables`` wrote them: the columns are then used as stored.
    """
    if normalised:
        return Tables(**{name: read_stored(spark, root, name) for name in SOURCE_NAMES})
    return Tables(**{name: spark.read.format(fmt).load(f"{root}/{src}") for name, src in SOURCE_NAMES.items()}).normalised()


def catalog_tables(spark: SparkSession, database: str | None = None) -> Tables:
    """Tables registered in the session catalog under their source names."""
    prefix = f"{database}." if database else ""
    return Tables(**{name: spark.table(prefix + src) for name, src in SOURCE_NAMES.items()}).normalised()

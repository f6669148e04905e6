"""Hand-made source tables for unit tests (a few rows each)."""

from __future__ import annotations

from vitrina.sources.tables import Tables

PRODUCT = "PKProducto bigint, CodCUC string, DesMarca string, CodCategoria string, DesCategoria string, DesUnidadNegocio string"
OFFER = "PKTipoOferta int, CodTipoOferta string, CodTipoProfit string"
SALES = ("AnioCampana string, AnioCampanaRef string, PKProducto bigint, PKTipoOferta bigint, "
         "RealUUVendidas bigint, RealUUFaltantes bigint")
PLAN = ("AnioCampana string, PKProducto bigint, PKTipoOferta bigint, CodVenta string, DesTipoCatalogo string, "
        "DesUbicacionCatalogo string, DesLadoPag string, DesExposicion string, NroPaginas bigint, "
        "PaginaCatalogo bigint, FotoProducto string, FotoModelo string, FlagDiscover int, PrecioOferta double")
EST = ("AnioCampana string, AnioCampanaRef string, PKProducto bigint, PKTipoOferta bigint, EstUUVendidas bigint, "
       "PrecioOfertaDol double, PrecioNormalDol double, PrecioNormalMN double")
SUPPORT = "AnioCampana string, PKProductoApoyador bigint, PKProductoApoyado bigint, PKTipoOfertaApoyador bigint"
ORDERS = "AnioCampana string, RealNroPedidos bigint"

CAT = "CUIDADO PERSONAL"
# offer keys: 1 = 011 (catalogue), 2 = 003 (magazine), 3 = 008 (set, catalogue), 4 = 013 (catalogue)
OFFERS = [(1, "011", "01"), (2, "003", "01"), (3, "008", "01"), (4, "013", "01")]


def product(pk, cuc, brand="ESIKA", cat=CAT, unit="COSMETICOS"):
    return (pk, cuc, brand, "0", cat, unit)


def sale(camp, pk, pkto, sold=10, short=1, ref=None):
    return (camp, ref or camp, pk, pkto, sold, short)


def plan(camp, pk, pkto, price=10.0, placement="CARATULA", side="LADO DERECHO", catalogue="CATALOGO ESIKA",
         exposure="50%", pages=2, page=5, sale_code="12345", foto="S", modelo="N", discover=1):
    return (camp, pk, pkto, sale_code, catalogue, placement, side, exposure, pages, page, foto, modelo, discover,
            price)


def est(camp, pk, pkto, units=5, dol=1.0, normal_dol=2.0, normal=20.0, ref=None):
    return (camp, ref or camp, pk, pkto, units, dol, normal_dol, normal)


def tables(spark, products, sales=(), plans=(), ests=(), supports=(), orders=None, country="PE",
           offers=OFFERS) -> Tables:
    df = spark.createDataFrame
    if orders is None:
        camps = sorted({r[0] for r in list(sales) + list(plans)})
        orders = [(c, 100) for c in camps]
    return Tables(
        country=df([(country,)], "CodPais string"),
        product=df(list(products), PRODUCT),
        offer_type=df(list(offers), OFFER),
        sales=df(list(sales), SALES),
        plan=df(list(plans), PLAN),
        estimates=df(list(ests), EST),
        support=df(list(supports), SUPPORT),
        orders=df(list(orders), ORDERS),
    ).normalised()

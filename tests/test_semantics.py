"""Hand-made fixtures for the semantics of the source batch (FIXTURES.md §C)."""

import math

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from vitrina.functions.columns import exposure, exposure_is_bad
from vitrina.operators import base as base_ops
from vitrina.operators import discounts, smoothing, tactics
from vitrina.operators.dims import prepare_dims
from vitrina.params import Params
from vitrina.plans.feature_job import build, feature_table
from vitrina.sources.country import country_code

import world as w

CLOSED, CLOSED2, OPEN = "201401", "201403", "201716"


def rows(df, *cols):
    """Rows as tuples, sorted with nulls first."""
    key = lambda t: tuple((v is not None, v if v is not None else 0) for v in t)
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=key)


def test_country_recode_and_single_row(spark):
    for raw, clean in [("S2", "SV"), ("G2", "GT"), ("PE", "PE")]:
        assert country_code(spark.createDataFrame([(raw,)], "CodPais string")) == clean
    with pytest.raises(ValueError):
        country_code(spark.createDataFrame([("PE",), ("BO",)], "CodPais string"))
    with pytest.raises(ValueError):
        country_code(spark.createDataFrame([], "CodPais string"))


def test_exposure_texts(spark):
    texts = [("SIN EXPOSICION", 2), ("50%", 2), ("EXPOSICION  100%", 2), (None, 2), ("", 2),
             ("EXPOSICION 50%", 2), ("100.0%", 2), ("50%", None), ("NAN%", 2), ("INF", 2), ("50D", 2), ("1F", 2),
             ("1E3%", 2), ("-5%", 2), (".5%", 2), (".", 2)]
    df = spark.createDataFrame(texts, "t string, n bigint").select(
        exposure(F.col("t"), F.col("n")).alias("e"), exposure_is_bad(F.col("t")).alias("bad"))
    got = [(r.e, bool(r.bad)) for r in df.collect()]
    assert got == [(0.0, False), (1.0, False), (2.0, False), (0.0, False), (0.0, False),
                   (0.0, True), (0.0, False), (None, False), (0.0, True), (0.0, True), (0.0, True), (0.0, True),
                   (0.0, True), (-0.1, False), (0.01, False), (0.0, True)]


def _offers(spark, data):
    schema = ("AnioCampana string, CodCUC string, CodTipoOferta string, PrecioOferta double, "
              "PrecioNormalMN double, Descuento double, Exposicion double, FlagCatalogo int, FlagRevista int")
    return spark.createDataFrame(data, schema)


def _keys(spark, data=()):
    return spark.createDataFrame(list(data), "AnioCampana string, CodCUC string")


def test_set_rule_averages_the_lowest_price(spark):
    o = _offers(spark, [(CLOSED, "A", "008", 5.0, 10.0, 0.5, 1.0, 1, 0),
                        (CLOSED, "A", "011", 7.0, 10.0, 0.3, 1.0, 1, 0),
                        (CLOSED, "A", "013", 9.0, 10.0, 0.1, 1.0, 1, 0)])
    out = smoothing.set_price_smoothing(o, _keys(spark))
    assert rows(out, "CodTipoOferta", "PrecioOferta", "Descuento") == [
        ("008", 7.0, pytest.approx(0.3)), ("011", 7.0, 0.3), ("013", 9.0, 0.1)]


def test_set_not_at_minimum_is_unchanged(spark):
    o = _offers(spark, [(CLOSED, "A", "008", 7.0, 10.0, 0.3, 1.0, 1, 0),
                        (CLOSED, "A", "011", 5.0, 10.0, 0.5, 1.0, 1, 0)])
    out = smoothing.set_price_smoothing(o, _keys(spark))
    assert rows(out, "CodTipoOferta", "PrecioOferta") == [("008", 7.0), ("011", 5.0)]


def test_support_rule(spark):
    o = _offers(spark, [(CLOSED, "A", "011", 5.0, 10.0, 0.5, 1.0, 1, 0),
                        (CLOSED, "A", "013", 7.0, 10.0, 0.3, 1.0, 1, 0),
                        (CLOSED, "B", "011", 5.0, 10.0, 0.5, 1.0, 1, 0),
                        (CLOSED, "B", "013", 7.0, 10.0, 0.3, 1.0, 1, 0)])
    out = smoothing.set_price_smoothing(o, _keys(spark, [(CLOSED, "A")]))
    assert rows(out, "CodCUC", "PrecioOferta") == [("A", 6.0), ("A", 7.0), ("B", 5.0), ("B", 7.0)]


def test_support_count_below_ten(spark):
    products = [w.product(1, "A")] + [w.product(10 + i, f"S{i}") for i in range(10)]
    supports = [(CLOSED, 1, 10 + i, 1) for i in range(9)] + [(CLOSED2, 1, 10 + i, 1) for i in range(10)]
    t = w.tables(spark, products, supports=supports)
    out = tactics_support(t)
    assert rows(out, "AnioCampana", "CodCUC", "NroApoyados") == [(CLOSED, "A", 9)]


def tactics_support(t):
    from vitrina.operators import support
    return support.supported_products(t, Params(), prepare_dims(t, Params()))


def test_zero_fills_in_order(spark):
    # exposure 0 takes the lowest positive one; price 0 takes the lowest positive price and the
    # lowest discount among positively priced offers
    o = _offers(spark, [(CLOSED, "A", "011", 0.0, 10.0, 1.0, 0.0, 1, 0),
                        (CLOSED, "A", "013", 3.0, 10.0, 0.7, 0.5, 1, 0),
                        (CLOSED, "A", "003", 5.0, 10.0, 0.5, 1.0, 0, 1)])
    out = smoothing.zero_price_fill(smoothing.zero_exposure_fill(o))
    assert rows(out, "CodTipoOferta", "PrecioOferta", "Descuento", "Exposicion") == [
        ("003", 5.0, 0.5, 1.0), ("011", 3.0, 0.5, 0.5), ("013", 3.0, 0.7, 0.5)]


def test_null_cuc_never_corrected(spark):
    o = _offers(spark, [(CLOSED, None, "011", 0.0, 10.0, 1.0, 0.0, 1, 0),
                        (CLOSED, None, "013", 3.0, 10.0, 0.7, 0.5, 1, 0)])
    out = smoothing.zero_price_fill(smoothing.zero_exposure_fill(o))
    assert rows(out, "CodTipoOferta", "PrecioOferta", "Exposicion") == [("011", 0.0, 0.0), ("013", 3.0, 0.5)]


def test_channel_discounts(spark):
    o = _offers(spark, [(CLOSED, "A", "003", 5.0, 10.0, 0.5, 1.0, 0, 1),
                        (CLOSED, "B", "003", 5.0, None, None, 1.0, 0, 1),
                        (CLOSED, "B", "011", 5.0, None, None, 1.0, 1, 0)])
    parts = discounts.with_channel_parts(o).groupBy("CodCUC").agg(*discounts.channel_parts_agg())
    got = {r.CodCUC: r for r in parts.select("CodCUC", *[c.alias(n) for n, c in discounts.channel_columns().items()]).collect()}
    a, b = got["A"], got["B"]
    assert (a.MaxDescuentoRevista, a.MaxDescuentoCatalogo, a.FactorDemoCatalogo, a.FlagMaxDescuentoRevista) == (
        0.5, 0.0, 0.0, 1)
    assert (b.MaxDescuentoRevista, b.MaxDescuentoCatalogo, b.FactorDemoCatalogo, b.FlagMaxDescuentoRevista) == (
        None, None, None, 0)


def test_estimates_absent_zero_and_null(spark):
    base = spark.createDataFrame([(CLOSED, "A"), (CLOSED, "B"), (CLOSED, "C")], "AnioCampana string, CodCUC string")
    est = spark.createDataFrame([(CLOSED, "B", 0, 1.0, 20.0), (CLOSED, "C", None, 1.0, None)],
                                "AnioCampana string, CodCUC string, NroEstimados bigint, "
                                "PrecioOfertaDol double, PrecioNormalMN double")
    out = base_ops.apply_estimates(base, est)
    assert rows(out, "CodCUC", "PrecioNormalMN") == [("A", 0.0), ("C", None)]


def _world(spark, plans, sales=None, ests=None, orders=None, country="PE", products=None):
    products = products or [w.product(1, "A")]
    sales = sales if sales is not None else [w.sale(CLOSED, 1, 1), w.sale(CLOSED, 1, 2)]
    ests = ests if ests is not None else [w.est(CLOSED, 1, 1), w.est(CLOSED, 1, 2), w.est(OPEN, 1, 1)]
    return w.tables(spark, products, sales=sales, plans=plans, ests=ests, orders=orders, country=country)


def test_price_of_a_code_is_its_lowest(spark):
    # codes 003 on keys 2 and 5: both tactics take the lowest price of the code
    offers = w.OFFERS + [(5, "003", "01")]
    t = w.tables(spark, [w.product(1, "A")], plans=[w.plan(CLOSED, 1, 2, price=8.0), w.plan(CLOSED, 1, 5, price=9.0)],
                 offers=offers)
    clean = tactics.clean_tactics(t, Params(), prepare_dims(t, Params()))
    assert rows(clean, "PKTipoOferta", "PrecioOferta") == [(2, 8.0), (5, 8.0)]


def test_open_zero_price_and_null_price(spark):
    t = _world(spark, [w.plan(OPEN, 1, 1, price=0.0), w.plan(OPEN, 1, 1, price=10.0, page=6),
                       w.plan(OPEN, 1, 2, price=None), w.plan(OPEN, 1, 4, price=None),
                       w.plan(OPEN, 1, 4, price=10.0)])
    clean = tactics.clean_tactics(t, Params(), prepare_dims(t, Params()))
    # key 1: tactic on page 5 has price 0 -> deleted, page 6 keeps 10; key 2 null stays; key 4: min(null, 10) = 10
    assert rows(clean, "PKTipoOferta", "PaginaCatalogo", "PrecioOferta") == [
        (1, 6, 10.0), (2, 5, None), (4, 5, 10.0)]


def test_magazine_pages(spark):
    plans = [w.plan(CLOSED, 1, 2, catalogue="REVISTA BELCORP", page=pg) for pg in (None, 0, 1, 99, 100)]
    plans += [w.plan(CLOSED, 1, 1, catalogue="CATALOGO ESIKA", page=pg) for pg in (None, 0, 1, 99, 100)]
    t = _world(spark, plans)
    clean = tactics.clean_tactics(t, Params(), prepare_dims(t, Params()))
    got = rows(clean, "DesTipoCatalogo", "PaginaCatalogo")
    assert [pg for cat, pg in got if cat == "REVISTA BELCORP"] == [1, 99]
    assert [pg for cat, pg in got if cat == "CATALOGO ESIKA"] == [None, 0, 1, 99, 100]


def test_duplicate_exposure_texts_merge(spark):
    t = _world(spark, [w.plan(CLOSED, 1, 1, exposure="50%"), w.plan(CLOSED, 1, 1, exposure="EXPOSICION   50%")])
    clean = tactics.clean_tactics(t, Params(), prepare_dims(t, Params()))
    assert clean.count() == 1
    totals = tactics.tactic_totals(clean)
    assert rows(totals, "PKTipoOferta", "Exposicion") == [(1, 1.0)]


def test_feature_row_end_to_end(spark):
    t = _world(spark, [w.plan(CLOSED, 1, 1, price=12.0), w.plan(CLOSED, 1, 2, price=8.0, placement="POSTER")])
    out = feature_table(t, Params()).collect()
    assert len(out) == 1
    r = out[0]
    assert (r.CodPais, r.AnioCampana, r.CodCUC, r.NCampaign, r.N_Records_SKU) == ("PE", CLOSED, "A", 1, 1)
    assert (r.PrecioOfertaMin, r.PrecioOfertaMax, r.PrecioOfertaProm) == (8.0, 12.0, 10.0)
    assert r.PrecioOfertaMinInverso == pytest.approx(1 / 8)
    assert (r.NroTipoOfertas, r.NroTipoOfertasCatalogo, r.NroTipoOfertasRevista) == (2, 1, 1)
    assert r.RealUUDemandadas == 22 and r.PUP == pytest.approx(0.22)
    assert (r.UbicacionCaratula, r.UbicacionPoster, r.LadoDerecho, r.FotoProducto, r.FlagDiscover) == (1, 1, 1, 1, 1)
    assert (r.TO_011_OfertasPrincipales, r.TO_003_OfertaConsultora, r.FlagC01, r.Development) == (1, 1, 1, 1)
    assert r.ExposicionTotal == pytest.approx(2.0) and r.NroPaginas == 4
    assert r.MaxDescuentoCatalogo == pytest.approx(0.4) and r.MaxDescuentoRevista == pytest.approx(0.6)
    assert r.FlagMaxDescuentoRevista == 1


def test_null_cuc_absent_from_result(spark):
    products = [w.product(1, "A"), w.product(2, None)]
    t = _world(spark, [w.plan(CLOSED, 1, 1), w.plan(CLOSED, 2, 1)], products=products,
               sales=[w.sale(CLOSED, 1, 1), w.sale(CLOSED, 2, 1)])
    out = feature_table(t, Params())
    assert rows(out, "CodCUC") == [("A",)]


def test_orders_missing_double_and_zero(spark):
    plans = [w.plan(CLOSED, 1, 1), w.plan(CLOSED2, 1, 1), w.plan(OPEN, 1, 1)]
    sales = [w.sale(CLOSED, 1, 1), w.sale(CLOSED2, 1, 1)]
    ests = [w.est(c, 1, 1) for c in (CLOSED, CLOSED2, OPEN)]
    orders = [(CLOSED, 10), (CLOSED, 20), (CLOSED2, 0)]
    t = _world(spark, plans, sales=sales, ests=ests, orders=orders)
    out = rows(feature_table(t, Params()), "AnioCampana", "RealNroPedidos", "PUP")
    assert out == [(CLOSED, 10, pytest.approx(1.1)), (CLOSED, 20, pytest.approx(0.55)), (CLOSED2, 0, None)]


def test_two_brands_share_flags_and_sequence(spark):
    products = [w.product(1, "A", brand="ESIKA"), w.product(2, "A", brand="LBEL")]
    t = _world(spark, [w.plan(CLOSED, 1, 1), w.plan(CLOSED, 2, 1)], products=products,
               sales=[w.sale(CLOSED, 1, 1), w.sale(CLOSED, 2, 1)])
    out = feature_table(t, Params()).collect()
    assert sorted(r.DesMarca for r in out) == ["ESIKA", "LBEL"]
    assert {(r.UbicacionCaratula, r.N_Records_SKU, r.NCampaign) for r in out} == {(1, 1, 1)}


def test_sequences(spark):
    products = [w.product(1, "A"), w.product(2, "B")]
    plans = [w.plan(CLOSED, 1, 1), w.plan(CLOSED2, 1, 1), w.plan(CLOSED2, 2, 1)]
    sales = [w.sale(CLOSED, 1, 1), w.sale(CLOSED2, 1, 1), w.sale(CLOSED2, 2, 1)]
    ests = [w.est(c, pk, 1) for c, pk in ((CLOSED, 1), (CLOSED2, 1), (CLOSED2, 2))]
    t = _world(spark, plans, sales=sales, ests=ests, products=products)
    out = rows(feature_table(t, Params()), "AnioCampana", "CodCUC", "NCampaign", "N_Records_SKU")
    assert out == [(CLOSED, "A", 1, 1), (CLOSED2, "A", 2, 2), (CLOSED2, "B", 2, 1)]


def test_dollar_country_overwrites_offer_price(spark):
    t = _world(spark, [w.plan(CLOSED, 1, 1, price=12.0), w.plan(CLOSED, 1, 2, price=8.0)],
               ests=[w.est(CLOSED, 1, 1, dol=0.0), w.est(CLOSED, 1, 2, dol=3.0)], country="BO")
    st = build(t, Params())
    got = rows(st.offers, "PKTipoOferta", "PrecioOferta", "Descuento", "PrecioNormalMN")
    # normal price is the dollar normal price (2.0); discount from the local price is kept
    assert got == [(1, 0.0, pytest.approx(-5.0), 2.0), (2, 3.0, pytest.approx(-3.0), 2.0)]
    fixed = rows(st.corrected, "PKTipoOferta", "PrecioOferta", "Descuento")
    assert fixed == [(1, 3.0, pytest.approx(-3.0)), (2, 3.0, pytest.approx(-3.0))]


def test_text_hygiene_at_ingest(spark):
    products = [w.product(1, "A", unit="cosmeticos ", cat="cuidado personal  ")]
    t = w.tables(spark, products, sales=[w.sale(CLOSED, 1, 1)], plans=[w.plan(CLOSED, 1, 1)],
                 ests=[w.est(CLOSED, 1, 1)], country="BO  ")
    assert country_code(t.country) == "BO"
    assert base_ops.closed_sales_base(t, Params(), prepare_dims(t, Params())).count() == 1


def test_strict_mode_rejects_bad_exposure(spark):
    t = _world(spark, [w.plan(CLOSED, 1, 1, exposure="EXPOSICION 50%")])
    with pytest.raises(PySparkException, match="unparsable exposure text"):
        tactics.clean_tactics(t, Params(strict=True), prepare_dims(t, Params())).collect()
    assert tactics.clean_tactics(t, Params(), prepare_dims(t, Params())).count() == 1


def test_params_validate():
    with pytest.raises(ValueError):
        Params(closed_from="2014")
    with pytest.raises(ValueError):
        Params(closed_from="201801", closed_to="201701")
    with pytest.raises(ValueError):
        Params(open_from="201710")
    assert Params().max_campaigns() == 500
    assert not math.isnan(Params().max_campaigns())


def test_flags_see_offer_types_outside_the_base(spark):
    # key 5 = code 001: not a base code, so no offer row; its tactic still sets the macro flag (Q9)
    offers = w.OFFERS + [(5, "001", "01")]
    t = w.tables(spark, [w.product(1, "A")], sales=[w.sale(CLOSED, 1, 1)],
                 plans=[w.plan(CLOSED, 1, 1), w.plan(CLOSED, 1, 5, placement="INSERTO")],
                 ests=[w.est(CLOSED, 1, 1)], offers=offers)
    r = feature_table(t, Params()).collect()
    assert len(r) == 1
    assert (r[0].FlagTacticaMacro, r[0].UbicacionInserto, r[0].NroTipoOfertas) == (1, 1, 1)


def test_strict_mode_rejects_zero_orders(spark):
    t = _world(spark, [w.plan(CLOSED, 1, 1)], orders=[(CLOSED, 0)])
    assert feature_table(t, Params()).collect()[0].PUP is None
    with pytest.raises(PySparkException, match="order count 0"):
        feature_table(t, Params(strict=True)).collect()


def test_ingest_types_and_missing_columns(spark):
    from vitrina.sources.tables import normalise
    orders = normalise(spark.createDataFrame([(201401, 5)], "AnioCampana int, RealNroPedidos int"), "orders")
    assert orders.dtypes == [("AnioCampana", "string"), ("RealNroPedidos", "bigint")] and orders.first()[0] == "201401"
    priced = spark.createDataFrame([(1,)], "x int").select(*[
        (F.lit("1.25").cast("decimal(9,2)") if kind == "double" else F.lit(None).cast(kind)).alias(c)
        for c, kind in __import__("vitrina.sources.tables", fromlist=["COLUMNS"]).COLUMNS["estimates"].items()])
    out = normalise(priced, "estimates")
    assert dict(out.dtypes)["PrecioOfertaDol"] == "double" and out.first().PrecioOfertaDol == 1.25
    with pytest.raises(ValueError, match="DesLadoPag"):
        normalise(spark.createDataFrame([("201401",)], "AnioCampana string"), "plan")


def test_compared_values_keep_their_digits(spark):
    from vitrina.plans.catalog import significant
    values = [1 / 1437.31, 1 / 1437.32, 1.44e10, 9.3e18, 0.0, -2.5, 1e-9, float(96001) ** 2]
    got = [r[0] for r in spark.createDataFrame([(v,) for v in values], "v double").select(significant(F.col("v"))).collect()]
    assert got[0] != got[1] and got[2:] == values[2:]
    assert got[0] == pytest.approx(values[0], rel=1e-9)

"""Facts stored with their dimensions' columns and bucketed by (campaign, CUC) give the same rows without the exchanges."""

import re
import uuid

import pytest

import world as w
from test_exact_sum import many_facts
from vitrina.operators.dims import prepare_dims
from vitrina.params import Params
from vitrina.plans.feature_job import build, feature_table
from vitrina.plans.quality import quality_metrics
from vitrina.plans.settings import job_session
from vitrina.sources.colocated import attach_dimensions, colocated_tables, store_colocated
from vitrina.sources.fixtures import fixture_tables

from conftest import SMALL_SF

# hash exchanges of the core plan, where plain tables have 12 (test_sink_quality): those behind unions of closed and open rows are left
MOST_EXCHANGES = 4


@pytest.fixture
def database(spark):
    name = f"stored_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name}")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def rows(df):
    return sorted(map(repr, df.collect()))


def odd_facts():
    """Many facts, with products that have no CUC or stand twice, and facts of products and offer types that don't exist."""
    products, sales, plans, ests, supports = many_facts(8)
    first = products[0]
    products = [*products, first, w.product(9001, None), w.product(9002, None, cat="FRAGANCIAS")]
    camp = sales[0][0]
    sales = [*sales, w.sale(camp, 9001, 1), w.sale(camp, 7777, 1), w.sale(camp, first[0], 99)]
    plans = [*plans, w.plan(camp, 9001, 1), w.plan(camp, 9002, 1), w.plan(camp, 7777, 1), w.plan(camp, first[0], 99)]
    ests = [*ests, w.est(camp, 9001, 1), w.est(camp, 7777, 1), w.est(camp, first[0], 99)]
    supports = [*supports, (camp, 9001, first[0], 1), (camp, first[0], 9001, 1), (camp, first[0], 7777, 1), (camp, first[0], 9002, 99)]
    return products, sales, plans, ests, supports


@pytest.mark.parametrize("country, p", [("PE", Params()), ("BO", Params(categories=(w.CAT, "FRAGANCIAS"))), ("SV", Params())])
def test_features_equal_those_of_the_plain_tables(spark, database, country, p):
    own = job_session(spark)
    plain = w.tables(own, *odd_facts(), country=country)
    store_colocated(plain, 4, database)
    stored = colocated_tables(own, database)
    expected = rows(feature_table(plain, p))
    assert expected and rows(feature_table(stored, p)) == expected
    assert rows(quality_metrics(stored, Params(), prepare_dims(stored, Params()))) == rows(
        quality_metrics(plain, Params(), prepare_dims(plain, Params())))


def test_unscoped_stages_keep_products_without_a_cuc(spark):
    from vitrina.operators import base, estimates, support, tactics
    plain = w.tables(spark, *odd_facts())
    attached = attach_dimensions(plain)
    p = Params()
    for stage in (base.closed_sales_base, base.open_plan_base, tactics.clean_tactics, support.supported_products,
                  estimates.dollar_offer_price, lambda t, p, d: estimates.estimate_summary(t, p, d, "PE")):
        expected, got = (stage(t, p, prepare_dims(t, p)) for t in (plain, attached))
        assert rows(got.select(*expected.columns)) == rows(expected)
    assert any("CodCUC=None" in r for r in rows(base.closed_sales_base(attached, p, prepare_dims(attached, p))))


def test_core_plan_finds_its_rows_in_place(spark, database):
    """Few exchanges are left, no fact is joined with a product, and category and offer codes reach the fact scans."""
    own = job_session(spark)
    store_colocated(fixture_tables(own, SMALL_SF), 4, database)
    core = build(colocated_tables(own, database), Params()).core
    plan = core._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") <= MOST_EXCHANGES
    assert not re.search(r"FileScan parquet \S*dproducto", plan)
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    pushed = re.findall(r"PushedFilters: .*", core._jdf.queryExecution().explainString(mode))
    assert any("DesCategoria" in f and "CodTipoOferta" in f and "AnioCampana" in f for f in pushed)
    assert any("SelectedBucketsCount" in line for line in core._jdf.queryExecution().explainString(mode).splitlines())


def test_new_campaigns_are_appended(spark, database):
    own = job_session(spark)
    products, sales, plans, ests, supports = odd_facts()
    whole = w.tables(own, products, sales, plans, ests, supports)
    last = max(r[0] for r in sales + plans)
    for mode, keep in (("error", lambda c: c < last), ("append", lambda c: c == last)):
        part = [[r for r in facts if keep(r[0])] for facts in (sales, plans, ests, supports)]
        store_colocated(w.tables(own, products, *part, orders=[(c, 100) for c in sorted({r[0] for r in sales + plans})]), 4, database, mode)
    assert rows(feature_table(colocated_tables(own, database))) == rows(feature_table(whole))


def test_plain_tables_are_refused(spark, database):
    from vitrina.sources.tables import SOURCE_NAMES
    t = w.tables(spark, [w.product(1, "A")])
    for name, source in SOURCE_NAMES.items():
        getattr(t, name).write.saveAsTable(f"{database}.{source}")
    with pytest.raises(ValueError, match="store_colocated"):
        colocated_tables(spark, database)

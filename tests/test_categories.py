"""One run for several categories gives the rows of a run for each."""

import pytest

from test_exact_sum import many_facts
import world as w
from vitrina.params import Params
from vitrina.plans.feature_job import build, feature_table
from vitrina.plans.settings import job_session

CATEGORIES = (w.CAT, "FRAGANCIAS", "MAQUILLAJE")


@pytest.mark.parametrize("country", ["PE", "BO"])
def test_one_run_equals_a_run_for_each(spark, country):
    """CUCs here have products of two categories, which share tactics, support and flags but not prices, estimates or numbers."""
    products, sales, plans, ests, supports = many_facts(8)
    t = w.tables(job_session(spark), products, sales, plans, ests, supports, country=country)
    rows = lambda p: sorted(map(repr, feature_table(t, p).collect()))
    together = rows(Params(categories=CATEGORIES))
    assert together == sorted(r for c in CATEGORIES for r in rows(Params(category=c)))
    assert len({r.split("DesCategoria=")[1].split(",")[0] for r in together}) == 2


def test_one_run_scans_the_plan_twice(spark):
    t = w.tables(job_session(spark), *many_facts())
    names = build(t, Params(categories=CATEGORIES)).core._jdf.queryExecution().optimizedPlan().toString()
    assert names.count("DesTipoCatalogo#") and len({line for line in names.splitlines() if "DesTipoCatalogo" in line and "LocalRelation" in line}) <= 2


def test_a_category_is_named_once():
    with pytest.raises(ValueError):
        Params(categories=(w.CAT, w.CAT))

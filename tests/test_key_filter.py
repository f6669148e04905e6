"""The key filter by itself, and at the fact scans of the job."""

import pytest
from pyspark.sql import functions as F

import world as w
from test_exact_sum import many_facts
from vitrina.functions.key_filter import KeyFilter
from vitrina.operators import base as base_ops
from vitrina.operators import tactics
from vitrina.operators.dims import prepare_dims
from vitrina.params import Params
from vitrina.plans.feature_job import feature_table
from vitrina.plans.settings import job_session
from vitrina.sources.fixtures import fixture_tables

from conftest import SMALL_SF


@pytest.fixture
def shuffled(spark):
    """The job's session with broadcasting off."""
    job = job_session(spark)
    for key in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
        job.conf.set(key, "-1")
    return job


def test_every_key_and_few_others_pass(spark):
    keys = spark.range(0, 40_000, 4).withColumnRenamed("id", "k").union(spark.createDataFrame([(None,)], "k bigint"))
    found = KeyFilter(keys, "k", 1 << 17)
    rows = spark.range(0, 40_000).withColumnRenamed("id", "k").where(found.might_hold(F.col("k")))
    got = {r.k for r in rows.collect()}
    assert set(range(0, 40_000, 4)) <= got and len(got) < 10_000 + 0.01 * 30_000
    assert spark.createDataFrame([(None,)], "k bigint").where(found.might_hold(F.col("k"))).count() == 0
    assert spark.range(100).where(KeyFilter(keys.limit(0), "k", 64).might_hold(F.col("id"))).count() == 0
    for bits in (0, 100, 1 << 32):
        with pytest.raises(ValueError):
            KeyFilter(keys, "k", bits)




def test_scans_drop_other_categories_before_the_shuffle(shuffled):
    t = fixture_tables(shuffled, SMALL_SF)
    whole, filtered = Params(), Params(key_filter_bits=1 << 20)
    d = prepare_dims(t, filtered)
    share = d.products_in_scope.count() / t.product.count()
    in_window = t.plan.filter(F.col("AnioCampana").between(*whole.closed))
    left = d.in_scope(in_window).count()
    assert left <= (share + 0.02) * in_window.count() + 50 and share < 0.3
    # the filter stands right on the scan of the page plan, so in its stage
    lines = tactics.closed_tactic_groups(t, filtered, d, True)._jdf.queryExecution().optimizedPlan().toString().splitlines()
    at = next(i for i, line in enumerate(lines) if "Filter" in line and "shiftright" in line)
    depth = lines[at].index("Filter")
    below = next(line for line in lines[at + 1:] if line[depth:depth + 3] == "+- ")
    assert "Relation" in below and "DesTipoCatalogo" in below


def test_rows_are_the_same_with_filters(shuffled):
    t = fixture_tables(shuffled, SMALL_SF)
    p, filtered = Params(), Params(key_filter_bits=1 << 16)
    rows = lambda q: sorted(map(repr, base_ops.closed_sales_base(t, q, prepare_dims(t, q)).collect()))
    assert rows(p) == rows(filtered)
    t = w.tables(shuffled, *many_facts(5))
    rows = lambda q: sorted(map(repr, feature_table(t, q).collect()))
    assert rows(p) == rows(filtered)

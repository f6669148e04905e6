"""Sums that do not depend on the order of the rows: by themselves, and in the job."""

import math
import random

import pytest

import world as w
from vitrina.functions.exact_sum import exact_avg, exact_sum
from vitrina.params import Params
from vitrina.plans.feature_job import build
from vitrina.plans.settings import job_session


def values(seed):
    draw = random.Random(seed)
    rows = [(g, draw.choice([1, -1]) * draw.random() * 10 ** draw.randint(-12, 14)) for g in range(40) for _ in range(draw.randint(1, 60))]
    # groups that cancel, that end at one place, and the values the limbs don't hold
    rows += [(50, 2.0 ** 50), (50, -2.0 ** 50), (50, 1e-9), (51, 2.0 ** 20), (51, -(2.0 ** 20 - 2.0 ** -32)), (52, None), (53, 1.5), (53, None),
             (54, float("nan")), (54, 1.0), (55, float("inf")), (55, 3.0), (56, 1e300), (56, 1.0), (57, -0.1), (58, 0.0)]
    return rows


def test_sum_and_average_are_exact_and_equal_in_every_order(spark):
    rows = values(1)
    seen = set()
    for n in (1, 7, 50):
        random.Random(n).shuffle(rows)
        df = spark.createDataFrame(rows, "g int, v double").repartition(n)
        got = {r.g: (r.s, r.a) for r in df.groupBy("g").agg(exact_sum("v").alias("s"), exact_avg("v").alias("a")).collect()}
        over = {r.g: r.s for r in df.select("g", exact_sum("v", "OVER (PARTITION BY g)").alias("s")).collect()}
        assert repr(sorted((g, s) for g, (s, _) in got.items())) == repr(sorted(over.items()))
        seen.add(repr(sorted(got.items())))
    assert len(seen) == 1
    for g in range(40):
        own = [v for h, v in rows if h == g]
        assert abs(got[g][0] - math.fsum(own)) <= math.ulp(math.fsum(own)) + len(own) * 2.0 ** -77
        assert got[g][1] == got[g][0] / len(own)
    assert got[51][0] == 2.0 ** -32 and abs(got[50][0] - 1e-9) < 2.0 ** -76
    assert got[52] == (None, None) and got[53] == (1.5, 1.5) and math.isnan(got[54][0])
    assert got[55][0] == math.inf and got[56][0] == 1e300 and got[57] == (-0.1, -0.1) and got[58][0] == 0.0


def many_facts(seed=3):
    draw = random.Random(seed)
    products = [w.product(pk, f"C{pk // 6}", cat="FRAGANCIAS" if pk % 5 == 0 else w.CAT) for pk in range(24)]
    camps = ["201401", "201402", "201716"]
    key = lambda: (draw.choice(camps), draw.randrange(24), draw.randint(1, 4))
    plans = [w.plan(*key(), price=draw.choice([0.0, draw.random() * 30, 7.3]), exposure=draw.choice(["10%", "33%", "70%", "SIN EXPOSICION"]),
                    pages=draw.choice([1, 2, 3, None]), page=draw.randrange(1, 90), side=draw.choice(["LADO DERECHO", "LADO IZQUIERDO"]),
                    placement=draw.choice(["CARATULA", "POSTER", "INSERTO"])) for _ in range(900)]
    sales = [w.sale(*key()) for _ in range(400)]
    ests = [w.est(*key(), normal=draw.choice([20.1, 31.7, 0.0]), units=draw.choice([0, 5])) for _ in range(60)]
    supports = [(draw.choice(camps), draw.randrange(24), draw.randrange(24), draw.randint(1, 4)) for _ in range(200)]
    return products, sales, plans, ests, supports


@pytest.fixture(scope="module")
def job(spark):
    return job_session(spark)


def test_features_are_bit_equal_over_partition_counts(job):
    products, sales, plans, ests, supports = many_facts()
    seen = set()
    for n in (1, 7, 50):
        for rows in (sales, plans, ests, supports):
            random.Random(n).shuffle(rows)
        job.conf.set("spark.sql.shuffle.partitions", str(n))
        job.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        st = build(w.tables(job, products, sales, plans, ests, supports), Params())
        columns = ["AnioCampana", "CodCUC", "ExposicionTotal", "PrecioOfertaProm", "PrecioNormalMN", "PrecioOfertaMin", "MaxDescuento"]
        seen.add(repr(sorted(map(repr, st.core.select(*columns).collect()))))
    assert len(seen) == 1 and len(next(iter(seen))) > 500


def test_core_plan_collects_no_list(job):
    st = build(w.tables(job, *many_facts()), Params())
    assert "collect_list" not in st.core._jdf.queryExecution().optimizedPlan().toString()

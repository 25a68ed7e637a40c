"""Property tests: summary invariants, row preservation, the status rule."""

import math
import os

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from runlens.functions.status import health_status
from runlens.operators import summaries as sm
from runlens.plans.context import AS_OF, build

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")
def test_summary_invariants(spark):
    t = build(spark, SF)
    for df in (sm.platform_summary(t.classified, AS_OF), sm.app_hourly(sm.app_run_status(t.classified))):
        bad = df.where(
            (F.col("total_runs") != F.col("critical_runs") + F.col("warning_runs") + F.col("healthy_runs"))
            | (F.col("pass_rate") < 0) | (F.col("pass_rate") > 100)
            | (F.abs(F.col("pass_rate") - F.lit(100.0) * (F.col("healthy_runs") + F.col("warning_runs"))
                     / F.col("total_runs")) > 1e-9)
        )
        assert bad.count() == 0
    assert t.enriched.count() == t.classified.count()          # windows keep every row
    runs = sm.run_status(t.classified)
    assert runs.agg(F.sum("total_metrics")).first()[0] == t.classified.count()


def _rule(v, hib, crit, warn):
    """The status rule stated directly: NaN/None compare false, equality is on the better side."""
    if v is None or math.isnan(v):
        return "healthy"
    if hib:
        return "critical" if v < crit else "warning" if v < warn else "healthy"
    return "critical" if v > crit else "warning" if v > warn else "healthy"


finite = st.floats(min_value=-1e6, max_value=1e6, allow_nan=False).map(lambda x: round(x, 2))
case = st.tuples(st.one_of(finite, st.just(float("nan")), st.none(), st.sampled_from([1.0, 2.0, 3.0])),
                 st.booleans(), st.sampled_from([1.0, 2.0, 3.0]), st.sampled_from([1.0, 2.0, 3.0]))
SCHEMA = T.StructType([T.StructField("v", T.DoubleType()), T.StructField("hib", T.BooleanType()),
                       T.StructField("crit", T.DoubleType()), T.StructField("warn", T.DoubleType())])


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(case, min_size=1, max_size=60))
def test_status_rule_matches_statement(spark, cases):
    df = spark.createDataFrame(cases, SCHEMA)
    v = F.nanvl(F.col("v"), F.lit(None).cast("double"))
    got = [r[0] for r in df.select(health_status(v, F.col("hib"), F.col("crit"), F.col("warn"))).collect()]
    assert got == [_rule(*c) for c in cases]


keys = st.lists(st.sampled_from(["model", "Model", "MODEL", "lr", "LR", "epochs", "Seed", "seed"]),
                unique=True, max_size=8)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(keys, min_size=1, max_size=20))
def test_lower_keys_matches_statement(spark, maps):
    from runlens.functions.maps import lower_keys

    rows = [(i, ks, [f"v{i}-{j}" for j in range(len(ks))]) for i, ks in enumerate(maps)]
    df = spark.createDataFrame(rows, "i int, k array<string>, v array<string>")
    got = {r["i"]: r["m"] for r in df.select("i", lower_keys(F.map_from_arrays("k", "v")).alias("m")).collect()}
    for i, ks, vs in rows:
        want = {}
        for k, v in zip(ks, vs):
            want[k.lower()] = v
        assert got[i] == want

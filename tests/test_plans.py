"""Plan rules: no cross joins and no row-at-a-time Python in any query with
an exact SQL twin (the model-fitting queries are audited by
scripts/explain_plans.py)."""

from table_paths import SF_SMALL

import __spark_entry__ as E

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython")


def test_no_cross_joins_or_row_udfs(spark):
    q = E.queries()
    bad = {}
    for name in sorted(E.oracle_sql()):
        plan = q[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
        hits = [f for f in FORBIDDEN if f in plan]
        if hits:
            bad[name] = hits
    assert bad == {}

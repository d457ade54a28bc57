"""Every registered query against its SQL on the smallest tables; the others must give rows.

No plan may hold a join without keys.
"""

from __future__ import annotations

import pytest

import __spark_entry__ as spark_entry
from oracle import compare, connect

JOBS = spark_entry.queries()
SQL = spark_entry.oracle_sql()
# Model fits need more positives than the smallest tables hold; tests/test_risk.py covers them.
MODELS = {
    "logit_folds", "logit_significance", "gbt_risk", "gbt_tuning", "feature_importance", "text_clusters",
    "cluster_rate", "mlp_risk", "batch_score", "feature_matrix",
}


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(set(JOBS) - MODELS))
def test_query(spark, con, sf_dir, name):
    frame = JOBS[name](spark, sf_dir)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    problem, _ = compare(con, frame, SQL.get(name))
    assert problem is None


def test_entry(spark):
    frame = spark_entry.entry(spark)
    assert frame.columns == ["numero", "pressao_fila_7d"]
    assert frame.count() > 0


def test_every_oracle_has_a_query():
    assert set(SQL) <= set(JOBS)

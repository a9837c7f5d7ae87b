"""Plans of the registered queries: no pairs of everything, no table in one task, native queries without Python."""

import re

import pytest

from cohortflow.llm.queries import QUERIES
from cohortflow.session import ship_package

SF = "/root/testdata/sf0.001"
NATIVE = ("op6_", "op8_", "op9_")
PYTHON = ("ArrowEvalPython", "BatchEvalPython", "MapInPandas", "MapInArrow", "FlatMapGroups", "FlatMapCoGroups")


@pytest.fixture
def plans(spark, monkeypatch):
    """The plans of all tables that a query writes on its way, and of its result."""
    from cohortflow.sources import scratch

    ship_package(spark)
    seen = []

    def settle(df, label):
        seen.append(df._jdf.queryExecution().executedPlan().toString())
        return scratch.settle(df, label)

    for module in ("embedding_dedup", "components", "blocks", "simhash", "scaled_sketch", "mixing", "language", "clustering", "top_k", "merkle"):
        monkeypatch.setattr(f"cohortflow.llm.{module}.settle", settle, raising=False)
    return seen


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if n.startswith("op")))
def test_plans(spark, plans, name):
    plans.append(QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString())
    for plan in plans:
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
        if name.startswith(NATIVE):
            assert not any(node in plan for node in PYTHON)
        lines = plan.splitlines()
        for i, line in enumerate(lines):
            # Whole texts, vectors and digests never go to a single task; sizes of ranges and groups may. (A number of
            # tasks that is worked out from that of the rows is one for a table as small as this.)
            if "Exchange SinglePartition" in line and "REPARTITION_BY_NUM" not in line:
                below = " ".join(lines[i + 1 : i + 6])
                assert not re.search(r"\b(text|embedding|v|x|leaf|digest|words)#", below.split("Scan")[0]), line

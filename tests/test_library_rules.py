"""What holds for every registered query of the reference's operators."""

import os

import pytest

from docroll.plans import catalog, stateful  # noqa: F401 (stateful adds to the catalog)
from docroll.session import checkpoint_dir

SMALL = "/root/testdata/sf0.001"
#: Queries whose state or step is a user's Python function.
USER_WRITTEN = {"combine_user_mean", "combine_user_distinct", "running_balance", "balance_by_customer"}


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="driver tables not present")
@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_no_python_rdd_or_single_task_in_the_plan(spark, name):
    plan = catalog.QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    # inline rows are the schema listing's only; there, rows come from Python by design
    for marker in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "CartesianProduct"):
        assert marker not in plan
    assert ("MapInArrow" in plan) == (name in USER_WRITTEN)
    limits = {"rollup_top100", "order_top100", "scan_head"}
    assert ("Limit" in plan or "TakeOrdered" in plan) == (name in limits)


def test_a_cluster_needs_a_shared_folder(spark):
    """A named folder wins; without one only a local master may make its own."""

    class Conf:
        def get(self, *args):
            return None

    class Context:
        master = "spark://somewhere:7077"
        getConf = staticmethod(Conf)
        getCheckpointDir = staticmethod(lambda: None)

    class Session:
        sparkContext = Context
        conf = Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_dir(Session)
    assert checkpoint_dir(spark)

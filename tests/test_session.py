import pytest
from pyspark.sql import functions as F

from asphalt import session
from asphalt.checks.queries import QUERIES


class Context:
    master, folder = "yarn", None

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


class Session:
    def __init__(self, named=None):
        self.sparkContext, self.conf = Context(), {} if named is None else {"spark.checkpoint.dir": named}


def test_a_cluster_must_name_its_checkpoint_folder():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_ready(Session())
    named = Session("hdfs:///shared")
    session.checkpoint_ready(named)
    assert named.sparkContext.folder == "hdfs:///shared"


def test_broadcast_only_below_the_counted_bound(spark):
    df = spark.range(10)
    hinted = session.broadcast_if_small(df, 10 * 32)
    assert "ResolvedHint" in hinted._jdf.queryExecution().analyzed().toString()
    assert "ResolvedHint" not in session.broadcast_if_small(df, 9 * 32)._jdf.queryExecution().analyzed().toString()


@pytest.mark.parametrize("name", ["zone_agg", "quand_month", "cond_delta_raw", "concentration", "priority_zones", "zone_history"])
def test_plans_have_no_cross_join_and_no_python(spark, name):
    plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "ArrowEvalPython", "BatchEvalPython"):
        assert unwanted not in plan


def test_wide_rows_count_for_more(spark):
    wide = spark.range(10).select(*[F.lit("x").alias(f"c{i}") for i in range(20)])
    assert "ResolvedHint" not in session.broadcast_if_small(wide, 10 * 32)._jdf.queryExecution().analyzed().toString()


def test_zone_scan_reads_only_what_it_needs(spark):
    plan = QUERIES["quand_year"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "l_extendedprice" not in plan and "l_comment" not in plan

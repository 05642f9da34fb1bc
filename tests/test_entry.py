import importlib

from bandstand import runtime
from bandstand.checks import QUERIES


def test_entry_points(spark):
    entry = importlib.import_module("__spark_entry__")
    assert entry.entry(spark).count() > 0
    queries, oracle = entry.queries(), entry.oracle_sql()
    assert set(oracle) <= set(queries)
    # Every query outside the text operators has SQL.
    assert not [q for q in QUERIES if q not in oracle]


def test_shared_folder_is_the_one_the_session_names(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    assert runtime.shared_dir(spark) == named
    assert runtime.scratch_path(spark, "x").startswith(named) and runtime.scratch_path(spark, "x") != runtime.scratch_path(spark, "x")
    runtime.cut_lineage(spark.range(3)).count()
    assert spark.sparkContext.getCheckpointDir().removeprefix("file:").startswith(named)

"""Staged tables, the shared folder and the plans they lead to."""

import os
import time
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from parcelion import session
from parcelion.operators import gold, segments, silver

from .data import bronze, sale


class _Conf(dict):
    def get(self, key, default=None):
        return super().get(key, default)


class _Cluster:
    """As much of a session as the choice of the shared folder looks at."""

    def __init__(self, conf):
        self.conf = _Conf(conf)
        self.sparkContext = self
        self.master = "yarn"

    def getCheckpointDir(self):
        return None


def test_the_shared_folder_is_the_one_the_cluster_names():
    assert session.shared_dir(_Cluster({"spark.checkpoint.dir": "hdfs:///shared/"})) == "hdfs:///shared"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(_Cluster({}))


def test_staged_tables_keep_rows_and_types_and_can_be_released(spark):
    df = spark.createDataFrame([(1, "a", None), (2, "", 0.5)], "i int, s string, d double")
    with session.released_after(spark):
        staged = session.stage_table(df)
        path = staged.inputFiles()[0].rsplit("/", 1)[0]
        assert sorted(map(tuple, staged.collect()), key=str) == sorted(map(tuple, df.collect()), key=str)
        assert staged.dtypes == df.dtypes
        local = "/" + path.removeprefix("file:").lstrip("/")
        assert os.path.isdir(local)
    assert not os.path.exists(local)


def test_a_kept_table_goes_with_the_block_around_its_own(spark):
    with session.released_after(spark):
        with session.released_after(spark):
            kept = session.kept_table(spark.range(3))
        assert kept.count() == 3
        local = "/" + kept.inputFiles()[0].rsplit("/", 1)[0].removeprefix("file:").lstrip("/")
    assert not os.path.exists(local)


def test_blocks_side_by_side_release_their_own_tables(spark):
    def flow(number):
        with session.released_after(spark):
            first = session.stage_table(spark.range(number))
            time.sleep(0.5 * number)
            return first.count()

    with ThreadPoolExecutor(2) as pool:
        assert list(pool.map(flow, (1, 3))) == [1, 3]


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_small_dimensions_are_broadcast_and_large_ones_are_not(spark):
    base = session.stage_table(silver.to_silver(bronze(spark, [sale(), sale(commune="LYON")]), 2021, 2024))
    star = gold.build_star(base)
    assert _plan(star.transactions).count("BroadcastHashJoin") == 3
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    try:
        wide = gold.transactions(base, star.communes, star.types_locaux, star.natures_mutation)
        assert "BroadcastHashJoin" not in _plan(wide) and "SortMergeJoin" in _plan(wide)
        assert wide.count() == 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_segments_need_one_scan_and_no_python(spark):
    base = session.stage_table(bronze(spark, [sale(price=470_000.0)]))
    plan = _plan(segments.price_segments(segments.cut(base)))
    assert plan.count("FileScan") == 1 and "Python" not in plan and "Union" not in plan
    assert "LessThanOrEqual(valeur_fonciere,2000000.0)" in plan


def test_only_needed_columns_are_read(spark):
    base = session.stage_table(silver.to_silver(bronze(spark, [sale()]), 2021, 2024))
    plan = _plan(gold.sales_cube(base).where(F.col("commune") == "PARIS"))
    read = plan[plan.index("ReadSchema"):].split("\n")[0]
    assert "id_unique" not in read and "code_postal" not in read and "EqualTo(commune,PARIS)" in plan

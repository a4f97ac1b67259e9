"""Sales of units after decisions: what is shuffled grows with applications and sales, not with their pairs."""

import datetime
import uuid

import pytest
from pyspark.sql import functions as F

from lotline.plans import projects as P
from lotline.registry import QUERIES
from tests.test_larger_tables import SMALL

#: Ten copies whose lots share their streets.
COPIES = {"customer": {"c_custkey": 6_000}, "orders": {"o_custkey": 6_000, "o_orderkey": 6_001, "o_totalprice": 1}}


def shuffled_rows(spark, run) -> int:
    """How many rows the stages of run() write for others to read."""
    sc, group = spark.sparkContext, uuid.uuid4().hex
    sc.setJobGroup(group, group)
    run()
    sc.setLocalProperty("spark.jobGroup.id", None)
    infos = [sc.statusTracker().getJobInfo(j) for j in sc.statusTracker().getJobIdsForGroup(group)]
    done = 0
    for stage in {s for i in infos for s in i.stageIds}:
        try:
            done += sc._jsc.sc().statusStore().lastStageAttempt(stage).shuffleWriteRecords()
        except Exception:  # a stage that was skipped has no attempt
            pass
    return done


@pytest.fixture(scope="module")
def crowded(spark, tmp_path_factory):
    at = tmp_path_factory.mktemp("crowded")
    for t in ("customer", "orders", "supplier", "lineitem"):
        rows = spark.read.parquet(f"{SMALL}/{t}.parquet")
        if t in COPIES:
            rows = rows.crossJoin(spark.range(10).withColumnRenamed("id", "i")).withColumns({c: F.col(c) + F.col("i") * n for c, n in COPIES[t].items()}).drop("i")
        rows.coalesce(1).write.parquet(f"{at}/{t}.parquet")
    return str(at)


@pytest.fixture(scope="module")
def n_pairs(spark, crowded):
    return QUERIES["unit_sales"](spark, crowded).count()


@pytest.mark.parametrize("name", ["unit_sales", "project_status", "nested_unit_sales"])
def test_pairs_are_not_shuffled(spark, crowded, n_pairs, name):
    assert n_pairs > 100_000
    n = shuffled_rows(spark, lambda: QUERIES[name](spark, crowded).write.format("noop").mode("overwrite").save())
    assert n < n_pairs


def test_ids_in_several_rows(spark):
    day = lambda n: datetime.date(2000, 1, n)
    apps = spark.createDataFrame([(1, "a", day(5)), (1, "b", day(5)), (1, "a", day(3)), (2, "a", day(5)), (None, "a", day(3)), (None, "b", day(3)), (3, "a", None), (4, None, day(3))], "id long, street_address string, decision_date date")
    units = spark.createDataFrame([(10, "a", "1", "x"), (11, "a", "1", "x"), (12, "b", "1", "x"), (13, "b", "2", "y")], "id long, street_address string, unit_number string, display_address string")
    sales = spark.createDataFrame([(p, day(9), 100, True) for p in (10, 11, 12)] + [(13, day(4), 50, True), (13, day(2), 90, True), (10, day(8), None, True), (10, day(12), 500, False)], "domain_property_id long, event_date date, event_price long, is_sold boolean")
    got = sorted((tuple(r) for r in P.unit_sales(apps, units, sales).collect()), key=repr)
    assert got == sorted([(1, "1", "x", 100, day(9)), (2, "1", "x", 100, day(9)), (None, "1", "x", 100, day(9)), (None, "2", "y", 90, day(4))], key=repr)

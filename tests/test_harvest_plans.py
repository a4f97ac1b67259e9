"""Letters are read once: no filter that Spark infers reads them a second time below the group that makes their rows."""

from lotline.plans import harvest as H
from lotline.queries.people import written
from lotline.registry import QUERIES
from tests.test_larger_tables import SMALL


def test_letters_are_read_once(spark):
    plan = H.emissions(written(spark, SMALL))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Council of the City of Gold Coast") < 10  # 59 with filters that read letters


def test_chosen_letters_are_read_once(spark):
    docs = written(spark, SMALL)
    plan = H.emissions(docs.join(docs.where("doc_id % 2 = 0").select("doc_id"), "doc_id", "left_semi"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Council of the City of Gold Coast") < 10


def test_found_names_are_worked_out_once(spark):
    plan = QUERIES["resolved_prints"](spark, SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_extract_all" not in plan  # texts are cut into tokens before, for what is written

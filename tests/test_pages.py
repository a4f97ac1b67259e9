"""Words on pages: worked out page by page without a shuffle of words, and right where documents share an id or have none."""

import pytest

from lotline.registry import QUERIES
from tests.test_larger_tables import SMALL, same  # noqa: F401
from tests.test_unit_sales import shuffled_rows

NAMES = ["entity_boxes", "label_values", "labelled_lines"]


@pytest.mark.parametrize("name", NAMES)
def test_words_are_not_shuffled(spark, name):
    n_words = sum(len(r.text.split(" ")) for r in spark.read.parquet(f"{SMALL}/documents.parquet").where("text <> ''").collect())
    n = shuffled_rows(spark, lambda: QUERIES[name](spark, SMALL).write.format("noop").mode("overwrite").save())
    assert n < n_words / 20


@pytest.mark.parametrize("name", NAMES)
def test_documents_without_an_id_of_their_own(same, name):  # noqa: F811
    made = "select * replace (case when doc_id % 10 = 3 then null when doc_id % 10 = 4 then doc_id - 1 when doc_id % 10 = 5 then doc_id - 1 else doc_id end as doc_id) from documents where doc_id < 40 and length(text) < 3000"
    if name == "labelled_lines":
        made = made.replace("when doc_id % 10 = 3 then null ", "")
    assert same(name, documents=made) > 10

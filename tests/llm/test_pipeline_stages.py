"""Single stages of the corpus pipeline on odd corpora: what is clean stays as it is."""

import re

from pyspark.sql import functions as F

import corpus_pipeline
from lotline.llm.substring_dedup import substring_dedup

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
SF = "/root/testdata/sf0.001"


def corpus(spark, texts):
    """Rows of (doc_id, text) with a language and a source."""
    return spark.createDataFrame([(i, t, "en", "src0", len(t or "")) for i, t in texts], SCHEMA)


def test_passages_are_cut_out_of_an_unchanged_text(spark):
    passage = " ".join(f"p{i}" for i in range(20))
    texts = [(1, f"first é\n\n\tindented  twice\r\n{passage}\nend\n"), (2, f"  other\n{passage.replace(' ', chr(10))}\t\n  日本 tail "), (3, "\tclean\n\n  text \n"), (4, passage)]
    got = {r.doc_id: (r.text, r.n_chars) for r in corpus_pipeline.drop_passages(spark, corpus(spark, texts), SF).collect()}
    second = "  other\n\t\n  日本 tail "
    assert got == {1: (texts[0][1], len(texts[0][1])), 2: (second, len(second)), 3: (texts[2][1], len(texts[2][1]))}
    rows = substring_dedup(spark.read.parquet(f"{SF}/documents.parquet"), carry=("text",), rest=True).collect()
    assert all(r.rest == (r.text or "") for r in rows if not r.n_removed) and any(r.n_removed for r in rows)
    assert all(" ".join(re.findall(r"[^\x20\x09-\x0D]+", r.rest)) == r.kept for r in rows)


def test_readable_documents_stay_without_labels(spark):
    texts = [(1, "some words"), (2, "日本"), (3, None), (4, "123 !?"), (5, ""), (None, "no id")]
    docs = corpus(spark, texts).withColumn("lang", F.lit(None).cast("string"))
    got = corpus_pipeline.drop_unreadable(spark, docs, SF).collect()
    assert sorted(r.text for r in got) == ["no id", "some words", "日本"]


def test_near_copies_with_null_and_repeated_ids(spark):
    def words(k, n=40):
        return " ".join(f"{k}{i}" for i in range(n))

    copied = words("a")
    texts = [(1, copied), (2, copied + " more"), (3, words("b")), (3, words("c")), (3, words("c")), (4, words("c") + " more"), (5, copied), (5, words("d")), (6, words("e")), (6, words("e") + " more")]
    nulls = [(None, words("f")), (None, words("f")), (None, words("g")), (None, words("h")), (None, words("h") + " more"), (None, copied)]
    got = sorted((r.doc_id, r.text) for r in corpus_pipeline.drop_near_copies(spark, corpus(spark, texts + nulls), SF).collect() if r.doc_id is not None)
    assert got == [(1, copied), (3, words("b")), (3, words("c")), (5, words("d")), (6, words("e")), (6, words("e") + " more")]
    rows = [r for r in corpus_pipeline.drop_near_copies(spark, corpus(spark, texts + nulls), SF).collect() if r.doc_id is None]
    assert sorted(r.text.split()[0] for r in rows) == ["f0", "g0", "h0"] and all(r.lang == "en" and r.n_chars == len(r.text) or r.text.endswith("more") for r in rows)

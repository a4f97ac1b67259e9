"""Null and very large ids next to each other: no operator may round or lose one."""

from pyspark.sql import functions as F

from lotline.llm import bpe, langid, packing, toxicity
from lotline.llm.substring_dedup import substring_dedup
from lotline.llm.suffix_dedup import suffix_dedup

BIG = (1 << 53) + 1


def test_null_ids_come_last_and_large_ids_are_not_rounded(spark):
    passage = " ".join(f"w{i}" for i in range(20))
    texts = [(None, passage), (BIG, passage), (BIG + 1, passage), (BIG + 2, "short"), (None, "short")]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    got = sorted(((r.doc_id, r.n_removed) for r in substring_dedup(docs).collect()), key=repr)
    assert got == sorted([(None, 20), (BIG, 0), (BIG + 1, 20), (BIG + 2, 0), (None, 0)], key=repr)
    got = sorted((r.doc_id for r in suffix_dedup(docs).collect()), key=repr)
    assert got == sorted([i for i, _ in texts], key=repr)


def test_ids_pass_models_tokens_and_bins(spark):
    import public_tokenizers

    ids = [None, BIG, BIG + 1, None, BIG + 2]
    docs = spark.createDataFrame([(i, f"some words {k}", BIG + k if k else None, "s") for k, i in enumerate(ids)], "doc_id long, text string, n_chars long, source string")
    want = sorted(ids, key=repr)
    net = langid.train([b"the", b"der"] * 10, ["en", "de"] * 10, epochs=1)
    for out in (toxicity.toxicity(docs, None, carry=("n_chars",)), langid.identify(docs, net, carry=("text", "n_chars"))):
        rows = out.collect()
        assert sorted((r.doc_id for r in rows), key=repr) == want
        assert sorted((r.n_chars for r in rows), key=repr) == sorted([None, BIG + 1, BIG + 2, BIG + 3, BIG + 4], key=repr)
    assert sorted((r.doc_id for r in bpe.bpe_round_trip(docs, public_tokenizers.path("byte_bpe_50k.json")).collect()), key=repr) == want
    assert sorted((r.doc_id for r in packing.best_fit_pack(docs, F.lit(3), F.lit(None)).collect()), key=repr) == want

import tracemalloc

import numpy as np

from lotline.llm import langid, toxicity
from lotline.llm.common import by_text


def test_windows_are_read_once_a_direction(monkeypatch):
    """States kept while windows settle give the labels: no position is read twice, and the sums are those of a second reading."""
    net = langid.train([b"the cat and", b"der hund und", b"le chat et"] * 20, ["en", "de", "fr"] * 20, epochs=2)
    texts = [f"der hund {i} und le chat the cat ".encode() * (1 + i % 40) for i in range(langid.WIDE * 3)]
    texts = [t[: langid.BODY * (1 + i % 2)].ljust(langid.BODY, b".") for i, t in enumerate(texts)]
    read = []
    run = langid.BiGRU.run
    monkeypatch.setattr(langid.BiGRU, "run", lambda self, x, *a, **k: read.append(x.size) or run(self, x, *a, **k))
    got = langid.pooled(net, texts)
    once = 2 * langid.BODY * sum(-(-len(t) // langid.BODY) for t in texts)
    assert sum(read) == once
    monkeypatch.setattr(langid, "KEPT", 0)
    read.clear()
    again = langid.pooled(net, texts)
    assert sum(read) == 2 * once
    assert np.allclose(got, again, rtol=1e-6, atol=1e-4)


def peak(work) -> int:
    """The most bytes that work() holds at once."""
    tracemalloc.start()
    try:
        work()
        return tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_memory_of_a_batch_is_bounded():
    """A full batch takes a worker little memory: of settled states only what they add to four labels, of scored texts a few arrays."""
    net = langid.BiGRU.fresh(["de", "en", "es", "fr"], langid.HIDDEN, 1)
    text = "der hund und le chat the cat and " * 60
    texts = [text[: 300 + i % 1700] for i in range(langid.BATCH_CHARS // 1150)]
    n = sum(map(len, texts))
    assert 0.9 * langid.BATCH_CHARS < n < 1.1 * langid.BATCH_CHARS
    assert peak(lambda: langid.pooled(net, [t.encode() for t in texts])) < 48 * n
    texts = texts[: toxicity.BATCH_CHARS // 1150]
    assert peak(lambda: toxicity.Features(["hund"], [1.0]).rows(texts)) < 64 << 20


def test_states_read_from_a_guess_are_not_judged(monkeypatch):
    """Texts read in order, all at once, and again: the sums are those of a second reading of settled windows."""
    net = langid.train([b"the cat and", b"der hund und", b"le chat et"] * 20, ["en", "de", "fr"] * 20, epochs=2)
    net.w[:, : langid.HIDDEN, : langid.PAD] += 1
    texts = [b"", *[f"der hund {i} und le chat the cat ".encode() * (1 + i * i % 90) for i in range(80)]]
    got = langid.pooled(net, texts)
    monkeypatch.setattr(langid, "KEPT", 0)
    assert np.allclose(got, langid.pooled(net, texts), rtol=1e-5, atol=1e-2)


def test_batches_of_texts_with_nulls(spark):
    """Texts reach the work cut by characters, not bytes; nulls and empty texts count for nothing; a table of none stays empty."""
    rows = [(1, "\u65e5" * 4), (2, None), (3, "a" * 6), (4, ""), (5, "b" * 30), (6, None), (7, "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    made = by_text(docs, "n long, batch long", lambda: lambda texts: [[len(t) if t else None for t in texts], [len(texts)] * len(texts)], 10)
    assert sorted(map(tuple, made.collect())) == [(1, 4, 2), (2, None, 2), (3, 6, 2), (4, None, 2), (5, 30, 3), (6, None, 3), (7, 1, 3)]
    assert by_text(docs.where("doc_id < 0"), "n long", lambda: lambda texts: [[0] * len(texts)], 10).count() == 0

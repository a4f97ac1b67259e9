import contextlib
import io

import pytest

from lotline.llm import warc


def segment(origin, number, block, total=None):
    kind, rid = ("response", origin) if number == 1 else ("continuation", f"{origin}{number}")
    return (rid, kind, None, "u", None, None, None, origin if number > 1 else None, number, total, block)


def test_archives_are_parsed_once(spark, tmp_path, monkeypatch):
    """What follows reads staged rows, and only segments that stand in different files are left to meet."""
    pages = [(i, f"http://{i}", f"{i} é" * (900 * i)) for i in range(12)] + [(20, "u", "3 é" * 2700)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").coalesce(1)
    monkeypatch.setattr(warc, "RECORDS_PER_FILE", 10)
    warc.write_warc(df, str(tmp_path / "w"))
    got = warc.read_warc(spark, str(tmp_path / "w"))
    plan = io.StringIO()
    with contextlib.redirect_stdout(plan):
        got.explain("formatted")
    assert "binaryFile" not in plan.getvalue()
    payloads = {r.page_id: bytes(r.payload) for r in got.collect() if r.record_type == "response"}
    assert payloads == {p: h.encode() for p, _, h in pages[:-1]}
    sizes = {r.page_id: (r.payload_bytes, r.payload, r.refers_to) for r in warc.read_warc(spark, str(tmp_path / "w"), payloads=False).collect()}
    assert sizes == {p: (len(h.encode()), None, 3 if p == 20 else None) for p, _, h in pages}
    written = warc.read_records(spark, str(tmp_path / "w")).where("segment is not null").count()
    loose = warc.read_once(spark, str(tmp_path / "w"), False).where("segment is not null").count()
    assert 0 < loose < written


def test_segments_of_a_file(monkeypatch):
    a = [segment("a", 1, b"ab"), segment("a", 2, b"cd"), segment("a", 3, b"e", 5)]
    b = [segment("b", 1, b"x"), segment("b", 2, b"y", 2)]
    blocks = lambda rows: sorted((r[0], r[warc.NUMBER], r[warc.BLOCK]) for r in warc.gathered(iter(rows)))
    one = lambda rows: sorted((r[0], r[warc.NUMBER], r[warc.BLOCK]) for r in rows)
    assert blocks([a[2], b[0], a[0], b[1], a[1]]) == [("a", None, b"abcde"), ("b", None, b"xy")]
    assert blocks(a + a) == [("a", None, b"abcde")] * 2
    assert blocks([a[0], a[0], a[1], a[1], a[2], a[2]]) == one(a + a)
    assert blocks(a[1:]) == one(a[1:])
    with pytest.raises(ValueError, match="segments"):
        blocks([b[0], segment("b", 2, b"yz", 2)])
    monkeypatch.setattr(warc, "WAITING", 3)
    assert blocks(a) == one(a)
    assert blocks([*b, *a]) == [*one(a)[:1], *one(a)[1:], ("b", None, b"xy")]

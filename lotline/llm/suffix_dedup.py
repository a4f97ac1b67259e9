"""Operator 5: byte-level dedup by maximal repeats of an enhanced suffix array.

Candidate segments come from `anchors.settle`. Each shard sorts the suffixes of its distinct
segments (a segment that occurs twice or more is entered twice) at which a maximal repeat can begin,
takes the longest common prefixes of neighbours, and scans them with a stack for common-prefix intervals. Intervals of
at least the threshold whose occurrences have two or more different left neighbours are the maximal
repeats of the segments, and together they cover every repeated window: what is removed follows.
A segment is a run of windows that share an anchor, and a longer repeat spans several. `repeat_groups` puts
out the maximal repeats of whole texts: the removed passages that share windows meet in one suffix array.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotline.llm import anchors
from lotline.llm.common import U, gram_hashes, sliding_min, staged, table
from lotline.llm.near_dedup import components
from lotline.llm.substring_dedup import covered, runs_of

LENGTH = 200
GRAM = 32
CHUNK = 1 << 16
SCHEMA = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary, spans array<struct<start:long,stop:long>>"


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All texts, a zero byte after each, other bytes raised by one (UTF-8 has no 0xFF); starts of the texts."""
    starts = np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts])))
    raw = np.frombuffer(b"\xff".join(texts) + b"\xff", np.uint8) + np.uint8(1)
    return raw, starts


def suffix_array(raw: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The sorted suffixes at which a maximal repeat can begin, neighbours' common prefixes, left neighbours.

    A suffix is left out if its first `length` bytes stand nowhere else, or have the same byte to
    their left wherever they stand: then every repeat that begins there can be extended to the left.
    """
    texts = len(starts) - 1
    ends = np.repeat((starts[1:] - 1).astype(np.int32), np.diff(starts))
    n = len(raw) - length + 1
    window = np.concatenate([gram_hashes(raw[c : min(c + CHUNK, n) + length - 1].astype(U), length) for c in range(0, n, CHUNK)] or [np.zeros(0, U)])
    at = np.flatnonzero(np.arange(len(window), dtype=np.int32) + length <= ends[: len(window)]).astype(np.int32)
    left = np.empty(len(raw), np.int32)
    left[1:] = raw[:-1]
    left[starts[:-1]] = 256 + np.arange(texts)  # nothing stands to the left: differs from all
    h = window[at]
    del window
    order = np.argsort(h)
    at, h = at[order], h[order]
    del order
    first = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1]))) if len(h) else np.zeros(0, np.int64)
    if len(first):
        low, high = np.minimum.reduceat(left[at], first), np.maximum.reduceat(left[at], first)
        at = np.sort(at[np.repeat(low != high, np.diff(np.append(first, len(h))))]).astype(np.int64)
    if not len(at):
        return at, at, at
    width = int((ends[at] - at).max())
    padded = np.concatenate((raw, np.zeros(width, np.uint8)))
    rows = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(padded, width)[at])
    rows[np.arange(width)[None, :] >= (ends[at] - at)[:, None]] = 0
    order = np.argsort(rows.view(f"S{width}").ravel(), kind="stable")
    rows, at = rows[order], at[order]
    same = (rows[1:] == rows[:-1]) & (rows[1:] > 0)
    lcp = np.concatenate(([0], np.where(same.all(axis=1), width, np.argmin(same, axis=1))))
    return at, lcp, left[at]


def intervals(order: np.ndarray, lcp: np.ndarray, left: np.ndarray, length: int) -> list[tuple[int, np.ndarray]]:
    """(length, suffixes) of the common-prefix intervals of `length` or more with two different left neighbours, by one scan with a stack."""
    if not len(order):
        return []
    differs = np.concatenate(([0], np.cumsum(left[1:] != left[:-1])))
    out = []
    stack: list[tuple[int, int]] = []  # (common prefix, first suffix) of the open intervals
    for i, h in enumerate([*np.where(lcp >= length, lcp, 0)[1:].tolist(), 0]):
        first = i
        while stack and stack[-1][0] > h:
            size, first = stack.pop()
            if differs[i] != differs[first]:
                out.append((size, order[first : i + 1]))
        if h and (not stack or stack[-1][0] < h):
            stack.append((h, first))
    return out


def maximal_repeats(texts: list[bytes], length: int) -> list[tuple[int, np.ndarray]]:
    """(length, starts in the joined texts) of every maximal repeat of at least `length` bytes; for many short texts."""
    return intervals(*suffix_array(*joined(texts), length), length)


def doubled_ranks(raw: np.ndarray, starts: np.ndarray) -> list[np.ndarray]:
    """Ranks of all places by their next 1, 2, 4, ... bytes; the end of each text is a letter of its own."""
    rank = raw.astype(np.int64)
    rank[starts[1:] - 1] = 257 + np.arange(len(starts) - 1)
    _, rank = np.unique(rank, return_inverse=True)
    out, step = [rank], 1
    while step < len(raw) and rank.max() < len(raw) - 1:
        ahead = np.zeros(len(raw), np.int64)
        ahead[:-step] = rank[step:] + 1
        _, rank = np.unique(rank * (len(raw) + 1) + ahead, return_inverse=True)
        out.append(rank)
        step *= 2
    return out


def whole_repeats(texts: list[bytes], length: int) -> list[tuple[int, np.ndarray]]:
    """As maximal_repeats, for texts of any length: the suffixes are ranked by doubling, not laid out as rows.

    Common prefixes of neighbours are read off the ranks, from the longest step down.
    """
    raw, starts = joined(texts)
    n = len(raw) - length + 1
    window = np.concatenate([gram_hashes(raw[c : min(c + CHUNK, n) + length - 1].astype(U), length) for c in range(0, n, CHUNK)] or [np.zeros(0, U)])
    ends = np.repeat(starts[1:] - 1, np.diff(starts))
    at = np.flatnonzero(np.arange(len(window)) + length <= ends[: len(window)])
    _, kind, count = np.unique(window[at], return_inverse=True, return_counts=True)
    at = at[count[kind] > 1]  # only there can a repeat begin
    if not len(at):
        return []
    ranks = doubled_ranks(raw, starts)
    left = np.empty(len(raw), np.int64)
    left[1:] = raw[:-1]
    left[starts[:-1]] = 256 + np.arange(len(texts))
    order = at[np.argsort(ranks[-1][at], kind="stable")]
    a, b = order[:-1].copy(), order[1:].copy()
    for k in range(len(ranks) - 1, -1, -1):
        inside = np.maximum(a, b) < len(raw)
        same = np.zeros(len(a), bool)
        same[inside] = ranks[k][a[inside]] == ranks[k][b[inside]]
        a[same] += 1 << k
        b[same] += 1 << k
    return intervals(order, np.concatenate(([0], a - order[:-1])), left[order], length)


GROUP = np.dtype([("offset", "<i4"), ("length", "<i4"), ("group", "<i8")])


def solve_groups(length: int):
    """Per segment its places in the shard's repeat groups; a group is named by a hash of its bytes."""

    def shard(contents: list[bytes], counts: np.ndarray, least: np.ndarray) -> list[bytes | None]:
        texts = [*contents, *[contents[i] for i in np.flatnonzero(counts > 1)]]
        at = np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts])))
        found: list[list[tuple[int, int, int]]] = [[] for _ in contents]
        for size, places in maximal_repeats(texts, length):
            owner = np.searchsorted(at, places, "right") - 1
            first = int(places[0] - at[owner[0]])
            name = anchors.hash_bytes(texts[owner[0]][first : first + size]) - (1 << 63)
            for t, p in zip(owner.tolist(), places.tolist()):
                if t < len(contents):  # the second entry of a segment stands for its further places
                    found[t].append((p - int(at[t]), size, name))
        return [np.array(x, GROUP).tobytes() if x else None for x in found]

    return shard


def list_groups(block: anchors.Block | None, answers) -> pd.DataFrame:
    rows = []
    for at, answer in answers:
        d = int(np.searchsorted(block.base, at, "right")) - 1
        for offset, size, name in np.frombuffer(answer, GROUP).tolist():
            rows.append((name, size, d, at - int(block.base[d]) + offset))
    out = pd.DataFrame(rows, columns=["group_id", "length", "doc", "start"])
    ids = block.own_ids[out.pop("doc").to_numpy(np.int64)] if block is not None else pd.array([], "Int64")
    return out.assign(doc_id=ids)[["group_id", "length", "doc_id", "start"]]


def segment_groups(docs: DataFrame, length: int) -> DataFrame:
    """group_id, length, doc_id, start of repeats that are maximal inside an anchor segment: long ones come in overlapping pieces."""
    return anchors.settle(docs, False, length, min(GRAM, length), solve_groups(length), list_groups, "group_id long, length int, doc_id long, start long").distinct()


#: Bytes of different repeated passages that hang together and are searched in one task.
TOGETHER_BYTES = 4 << 20


def run_anchors(length: int):
    """h1, anchor: the anchors of a passage's windows; passages with a common window have a common anchor."""
    gram = min(GRAM, length)

    def run(batches):
        for pdf in batches:
            for h, data in zip(pdf["h1"].tolist(), pdf["run"]):
                g = gram_hashes(np.frombuffer(data, np.uint8).astype(U), gram)
                own = np.unique(sliding_min(g, length - gram + 1)).view(np.int64)
                yield pd.DataFrame({"a": np.int64(h), "b": own})

    return run


def solve_runs(length: int):
    def run(key, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["h1", "h2"])
        runs = [bytes(x) for x in pdf["run"]]
        texts = [*runs, *[r for r, k in zip(runs, pdf["copies"]) if k > 1]]  # a passage that stands twice is a repeat itself
        at = np.cumsum([0] + [len(t) + 1 for t in texts])
        rows = []
        for size, places in whole_repeats(texts, length):
            owner = np.searchsorted(at, places, "right") - 1
            first = int(places[0] - at[owner[0]])
            name = anchors.hash_bytes(texts[owner[0]][first : first + size]) - (1 << 63)
            rows += [(int(t), int(p - at[t]), size, name) for t, p in zip(owner.tolist(), places.tolist()) if t < len(runs)]
        out = pd.DataFrame(rows, columns=["t", "offset", "length", "group_id"])
        own = out.pop("t").to_numpy(np.int64)
        return out.assign(h1=pdf["h1"].to_numpy()[own], h2=pdf["h2"].to_numpy()[own])[["h1", "h2", "group_id", "length", "offset"]]

    return run


def repeat_groups(docs: DataFrame, length: int = LENGTH, together: int = TOGETHER_BYTES) -> DataFrame:
    """group_id, length, doc_id, start: every occurrence (in bytes) of every maximal repeat of `length` bytes or more.

    docs: doc_id, text. A repeat is maximal if it can be made longer neither to the left nor to the right at all its
    places. All repeats lie inside the passages that suffix_dedup removes. Equal passages are searched once; those that
    share a window, directly or over others, meet in one enhanced suffix array. Only where more than
    `together` bytes of different passages hang together are their repeats given in pieces (segment_groups), which
    cover the same windows. Null text counts as empty; equal rows are occurrences of their own, listed
    once if their ids are equal; an empty table gives an empty result.
    """
    cut = suffix_dedup(docs, length, carry=("text",)).where("n_spans > 0").select("doc_id", F.encode("text", "UTF-8").alias("raw"), F.explode("spans").alias("s"))
    run = F.expr("substring(raw, cast(s.start as int) + 1, cast(s.stop - s.start as int))")
    cut = cut.select("doc_id", "s.start", run.alias("run")).withColumns({"h1": F.xxhash64("run"), "h2": F.xxhash64("run", F.lit(1))})
    cut = staged(cut, "passages")
    kinds = staged(cut.groupBy("h1", "h2").agg(F.first("run").alias("run"), F.count(F.lit(1)).alias("copies")), "kinds")
    labels = components(kinds.select("h1", "run").mapInPandas(run_anchors(length), "a long, b long"))
    kinds = kinds.join(labels.select(F.col("rep").alias("h1"), "label"), "h1")
    size = kinds.groupBy("label").agg(F.sum(F.octet_length("run")).alias("bytes"))
    kinds = staged(kinds.join(size, "label"), "kinds")
    found = kinds.where(F.col("bytes") <= together).groupBy("label").applyInPandas(solve_runs(length), "h1 long, h2 long, group_id long, length int, offset long")
    out = cut.select("doc_id", "start", "h1", "h2").join(found, ["h1", "h2"]).select("group_id", "length", "doc_id", (F.col("start") + F.col("offset")).alias("start"))
    large = kinds.where(F.col("bytes") > together)
    if not large.isEmpty():
        inside = cut.join(large.select("h1", "h2"), ["h1", "h2"], "left_semi").select(F.col("doc_id").alias("of"), F.col("start").alias("first"), (F.col("start") + F.octet_length("run")).alias("stop"))
        pieces = segment_groups(docs, length).join(inside, F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("start") >= F.col("first")) & (F.col("start") < F.col("stop")), "left_semi")
        out = out.unionByName(pieces)
    return out.distinct()


def solve(length: int):
    def shard(contents: list[bytes], counts: np.ndarray, least: np.ndarray) -> list[bytes | None]:
        twice = np.flatnonzero(counts > 1)
        texts = [*contents, *[contents[i] for i in twice]]
        at = np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts])))
        marks = np.zeros(at[-1] + 1, np.int64)
        for size, places in maximal_repeats(texts, length):
            np.add.at(marks, places, 1)
            np.add.at(marks, places + (size - length + 1), -1)
        repeated = np.cumsum(marks) > 0
        out: list[bytes | None] = []
        for i, c in enumerate(contents):
            own = repeated[at[i] : at[i] + len(c) - length + 1]
            out.append(np.packbits(own).tobytes() if own.any() else None)
        return out

    return shard


def apply(length: int, n_carry: int):
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept", "spans", *[f"carry_{i}" for i in range(n_carry)]]

    def spans(block: anchors.Block | None, answers) -> pd.DataFrame:
        if block is None:
            return pd.DataFrame({c: [] for c in names})
        hits = [at + np.flatnonzero(np.unpackbits(np.frombuffer(answer, np.uint8))) for at, answer in answers]
        gone = covered(np.concatenate(hits) if hits else np.zeros(0, np.int64), length, len(block.raw))
        rows = []
        for d, raw in enumerate(block.raws):
            a = int(block.base[d])
            mask = gone[a : a + len(raw)]
            runs = runs_of(mask)
            kept = np.frombuffer(raw, np.uint8)[~mask].tobytes()
            rows.append((len(raw), int(mask.sum()), len(runs), kept, [{"start": x, "stop": y} for x, y in runs]))
        out = pd.DataFrame(rows, columns=names[1:6])
        out.insert(0, "doc_id", block.own_ids)
        for c in names[6:]:
            out[c] = block.pdf[c].to_numpy()
        return out

    return spans


def suffix_dedup(docs: DataFrame, length: int = LENGTH, carry: tuple[str, ...] = ()) -> DataFrame:
    """Remove every byte covered by a string of `length` bytes that starts anywhere else too.

    docs: doc_id, text; other columns are ignored unless named in `carry` (returned as strings).
    Returns doc_id, n_bytes, n_removed, n_spans, kept (bytes left), spans (removed runs, as byte
    positions). Null text counts as empty. Equal rows are two occurrences, so both lose what they
    share. Matches within one text count, overlapping ones too. An empty table gives an empty result.
    """
    schema = SCHEMA + "".join(f", carry_{i} string" for i in range(len(carry)))
    out = anchors.settle(docs, False, length, min(GRAM, length), solve(length), apply(length, len(carry)), schema, carry)
    return out.withColumnsRenamed({f"carry_{i}": c for i, c in enumerate(carry)})


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


OP5_SQL = """
with d as materialized (
  select row_number() over () as r, doc_id, hex(encode(coalesce(text, ''))) as h from documents
), c as (
  select r, a, substr(h, 2 * a + 1, 910) as p from (select r, h, unnest(range(0, greatest(length(h) // 2 - 199, 0), 256)) as a from d)
), s as (
  select r, a + i as i, hash(substr(p, 2 * i + 1, 400)) as g from (select r, a, p, unnest(range(0, least(256, length(p) // 2 - 199))) as i from c)
), rep as (
  select r, i, lag(i) over (partition by r order by i) as before, lead(i) over (partition by r order by i) as after
  from s where g in (select g from s group by g having count(*) > 1)
), lost as (
  select r, cast(sum(least(200, coalesce(after - i, 200))) as bigint) as n_removed, count(*) filter (where before is null or i - before > 200) as n_spans from rep group by r
), cuts as (
  select r, i as stop, coalesce(before + 200, 0) as start from rep where before is null or i - before > 200
  union all select r, null, max(i) + 200 from rep group by r
), kept as (
  select r, string_agg(case when stop is null then substr(h, 2 * start + 1) else substr(h, 2 * start + 1, 2 * (stop - start)) end, '' order by start) as k from cuts join d using (r) group by r
)
select doc_id, length(h) // 2 as n_bytes, coalesce(n_removed, 0) as n_removed, coalesce(n_spans, 0) as n_spans, sha256(unhex(coalesce(k, h))) as kept_sha256
from d left join lost using (r) left join kept using (r)
"""

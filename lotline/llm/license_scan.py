"""Operator 11: license scans by an exact set-similarity join of text blocks with license templates.

Text is read as words and cut into overlapping blocks; a template is a set of words. A block holds a
template if it has at least `threshold` of the template's words. Words of templates are put in one global
order, rarest in the corpus first, and every set is a list in that order. With `need` words to be shared,

* prefix filter: one of the first size - need + 1 words of both lists is shared;
* length filter: a block with fewer than `need` template words is out;
* positional filter: a first shared word at places i and j leaves at most 1 + min(rest of both lists).

An inverted index over the templates' prefixes, which is as small as the templates, travels with the task;
blocks probe it where they are, so nothing but counts of template words is shuffled. What passes the
filters is counted exactly. Words outside all templates can never be shared and are not put in lists.

Phrases are templates that must be held whole; where a block holds one, the places at which its words
stand one after another are read off (an exact check after the join).
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lotline.llm.common import by_text, table

#: Words in a block and from one block's start to the next's: a passage of up to BLOCK - STEP words lies whole in a block.
BLOCK, STEP = 64, 32
#: Characters scanned together in a task.
BATCH_CHARS = 2_000_000
THRESHOLD = 0.8
# The phrases of the query's contract, and openings of published license notices.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
NOTICES = {
    "apache-2.0": "licensed under the apache license version 2 0",
    "bsd": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "cc-by": "this work is licensed under a creative commons attribution 4 0 international license",
    "cc-by-nc": "licensed under cc by nc 4 0",
    "gpl-3.0": "licensed under the gnu general public license version 3",
    "gpl-notice": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license",
    "isc": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files",
    "mit-named": "released under the mit license",
    "mpl-2.0": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "unlicense": "this is free and unencumbered software released into the public domain",
}
#: Bytes to lower case; 0 where a byte is in no word. All bytes of non-ASCII characters are in words.
LOWER = np.zeros(256, np.uint8)
for _a, _b in ((48, 58), (97, 123), (128, 256)):
    LOWER[_a:_b] = np.arange(_a, _b)
LOWER[65:91] = np.arange(97, 123)


@dataclass(frozen=True)
class Template:
    """A label with its words; `phrase`: all words, one after another; else the share `threshold` of its distinct words."""

    label: str
    words: tuple[str, ...]
    threshold: float
    phrase: bool

    @property
    def need(self) -> int:
        size = len(set(self.words))
        return size if self.phrase else max(1, math.ceil(self.threshold * size - 1e-9))


def templates_of(notices: dict[str, str], phrases: dict[str, str], threshold: float) -> list[Template]:
    """Templates in a fixed order. A template longer than a block's overlap could be cut by every block: refused."""
    out = [Template(label, tuple(text.split()), threshold, False) for label, text in sorted(notices.items())]
    out += [Template(label, tuple(text.split()), 1.0, True) for text, label in sorted(phrases.items())]
    for t in out:
        if not 0 < len(t.words) <= BLOCK - STEP:
            raise ValueError(f"template {t.label}: 1 to {BLOCK - STEP} words")
    return out


class Words:
    """Finds the words of a fixed vocabulary in texts."""

    def __init__(self, vocabulary: list[str]) -> None:
        raws = [w.encode() for w in vocabulary]
        self.width = max((len(r) for r in raws), default=1)
        padded = np.array([list(r.ljust(self.width, b"\0")) for r in raws], np.uint8).reshape(len(raws), self.width)
        keys = np.ascontiguousarray(padded).view(f"S{self.width}").ravel()
        self.order = np.argsort(keys)
        self.keys = keys[self.order]
        self.shape = np.zeros((256, self.width + 1), bool)
        for r in raws:
            self.shape[r[0], len(r)] = True

    def find(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(first word of each text and the number of all words, places of found words, their vocabulary numbers)."""
        raws = [(t or "").encode("utf-8", "replace") for t in texts]
        raw = LOWER[np.frombuffer(b"\n".join(raws) + b"\n", np.uint8)]
        edge = np.flatnonzero(np.diff(raw != 0, prepend=False, append=False))
        starts, ends = edge[::2], edge[1::2]
        base = np.cumsum([0] + [len(r) + 1 for r in raws])
        size = np.minimum(ends - starts, self.width + 1)
        at = np.flatnonzero((size <= self.width) & self.shape[raw[starts], np.minimum(size, self.width)])
        inside = np.arange(self.width)[None, :] < size[at][:, None]
        chars = np.where(inside, raw[np.minimum(starts[at][:, None] + np.arange(self.width), len(raw) - 1)], 0).astype(np.uint8)
        have = np.ascontiguousarray(chars).view(f"S{self.width}").ravel()
        to = np.minimum(np.searchsorted(self.keys, have), len(self.keys) - 1)
        good = self.keys[to] == have
        return np.searchsorted(starts, base), at[good], self.order[to[good]]


class Joiner:
    """The join of a batch of texts with the templates, given each vocabulary word's place in the global order."""

    def __init__(self, templates: list[Template], vocabulary: list[str], rank: list[int]) -> None:
        self.templates, self.words, self.rank = templates, Words(vocabulary), np.array(rank)
        number = {w: rank[i] for i, w in enumerate(vocabulary)}
        self.size = len(vocabulary)
        self.lists = [np.array(sorted(number[w] for w in set(t.words))) for t in templates]
        self.sequence = [np.array([number[w] for w in t.words]) for t in templates]
        self.need = np.array([t.need for t in templates])
        self.length = np.array([len(x) for x in self.lists])
        index = sorted((int(r), t, i) for t, x in enumerate(self.lists) for i, r in enumerate(x[: len(x) - self.need[t] + 1]))
        self.of, self.template, self.place = (np.array([e[k] for e in index]) for k in range(3))

    def candidates(self, block: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Pairs (block, template) that pass the three filters, and the blocks' lists as sorted keys and starts.

        block, rank: the template words of every block, sorted, each once per block.
        """
        first = np.flatnonzero(np.diff(block, prepend=-1))
        size = np.diff(np.append(first, len(block)))
        own = np.repeat(np.arange(len(first)), size)
        j, length = np.arange(len(block)) - first[own], size[own]
        lo, hi = np.searchsorted(self.of, rank), np.searchsorted(self.of, rank, "right")
        n = hi - lo
        probe = np.repeat(np.arange(len(rank)), n)
        entry = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)
        t, i, need = self.template[entry], self.place[entry], self.need[self.template[entry]]
        j, length = j[probe], length[probe]
        ok = (length >= need) & (j <= length - need) & (1 + np.minimum(self.length[t] - i - 1, length - j - 1) >= need)
        pair = np.unique(block[probe][ok] * len(self.templates) + t[ok])
        return pair // len(self.templates), pair % len(self.templates), block * self.size + rank, size

    def join(self, texts: list[str | None]) -> list[pa.Array]:
        """Per text: number of words, notices held by its blocks, places of phrases."""
        bounds, at, found = self.words.find(texts)
        rank, doc = self.rank[found], np.searchsorted(bounds, at, "right") - 1
        n_words = np.diff(bounds)
        place = at - bounds[doc]
        base = np.cumsum(np.append(0, -(-n_words // STEP)))
        home = base[doc] + place // STEP
        both = np.concatenate((home, home[place >= STEP] - 1)), np.concatenate((rank, rank[place >= STEP]))
        key = np.unique(both[0] * self.size + both[1])
        block, t, keys, _ = self.candidates(key // self.size, key % self.size)
        held = np.zeros(len(block), np.int64)
        for k, words in enumerate(self.lists):  # templates are few; blocks are counted all at once
            own = np.flatnonzero(t == k)
            want = block[own][:, None] * self.size + words
            held[own] = (keys[np.minimum(np.searchsorted(keys, want), len(keys) - 1)] == want).sum(axis=1) if len(keys) else 0
        good = held >= self.need[t]
        block, t, held = block[good], t[good], held[good]
        owner = np.searchsorted(base, block, "right") - 1
        start = (block - base[owner]) * STEP
        phrase = np.array([x.phrase for x in self.templates])[t]
        notices = self.listed(owner[~phrase], len(texts), {
            "label": pa.array([self.templates[k].label for k in t[~phrase]], pa.string()),
            "start": pa.array(start[~phrase], pa.int64()),
            "n_words": pa.array(np.minimum(BLOCK, n_words[owner[~phrase]] - start[~phrase]), pa.int32()),
            "held": pa.array(held[~phrase], pa.int32()),
            "size": pa.array(self.length[t[~phrase]], pa.int32()),
        })
        where, label = self.places(bounds, at, rank, owner[phrase], start[phrase], t[phrase])
        of = np.searchsorted(bounds, where, "right") - 1
        places = self.listed(of, len(texts), {"label": pa.array(label, pa.string()), "at": pa.array(where - bounds[of], pa.int64())})
        return [pa.array(n_words, pa.int64()), notices, places]

    def places(self, bounds: np.ndarray, at: np.ndarray, rank: np.ndarray, owner: np.ndarray, start: np.ndarray, t: np.ndarray) -> tuple[np.ndarray, list[str]]:
        """Words at which a phrase stands, inside the blocks that hold all its words; each place once."""
        ranks = np.full(bounds[-1] + BLOCK, -1)
        ranks[at] = rank
        out, labels = [np.zeros(0, np.int64)], [np.zeros(0, object)]
        for k in np.unique(t):
            own = t == k
            a = bounds[owner[own]] + start[own]
            b = np.minimum(a + BLOCK, bounds[owner[own] + 1])
            n = len(self.sequence[k])
            steps = np.arange(BLOCK)[None, :]
            cells = (a[:, None] + steps)[steps + n <= (b - a)[:, None]]
            fit = np.ones(len(cells), bool)
            for i, r in enumerate(self.sequence[k]):
                fit &= ranks[cells + i] == r
            out.append(np.unique(cells[fit]))
            labels.append(np.full(len(out[-1]), self.templates[k].label, object))
        where, label = np.concatenate(out), np.concatenate(labels)
        order = np.argsort(where, kind="stable")
        return where[order], label[order].tolist()

    @staticmethod
    def listed(owner: np.ndarray, n: int, fields: dict[str, pa.Array]) -> pa.Array:
        """Rows, sorted by their text, as one list of structs per text."""
        offsets = np.searchsorted(owner, np.arange(n + 1))
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays(list(fields.values()), list(fields)))


def word_order(docs: DataFrame, vocabulary: list[str]) -> list[int]:
    """Each vocabulary word's place in the global order: rarer in all of docs first, then by spelling.

    One pass over the texts; every task sends one count per vocabulary word.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, total = Words(vocabulary), np.zeros(len(vocabulary), np.int64)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            size = np.cumsum([len(t or "") for t in texts]) // BATCH_CHARS
            for part in np.unique(size):
                a, b = np.searchsorted(size, part), np.searchsorted(size, part, "right")
                total += np.bincount(words.find(texts[a:b])[2], minlength=len(vocabulary))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(vocabulary)), pa.int32()), pa.array(total)], ["word", "n"])

    counts = docs.select("text").mapInArrow(count, "word int, n long").groupBy("word").agg(F.sum("n").alias("n"))
    n = {r.word: r.n for r in counts.collect()}  # as many rows as the templates have words
    order = sorted(range(len(vocabulary)), key=lambda w: (n.get(w, 0), vocabulary[w]))
    rank = [0] * len(order)
    for place, w in enumerate(order):
        rank[w] = place
    return rank


def license_scan(docs: DataFrame, notices: dict[str, str] | None = None, phrases: dict[str, str] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """docs without text, with n_words and what the blocks of every text hold.

    notices, phrases: label to words, and words to label (lower case, one blank between words); by default
    those above. New columns: n_words long; notices, one entry per block (start in words, n_words) and notice
    with the words of it that the block holds and has in all; places, one entry per place of a phrase. A
    null text has no words. Rows are read one by one: repeated rows, null ids and any other columns stay as
    they are. Columns named like the new ones are replaced.
    """
    templates = templates_of(NOTICES if notices is None else notices, PHRASES if phrases is None else phrases, threshold)
    vocabulary = sorted({w for t in templates for w in t.words})
    rank = word_order(docs, vocabulary)
    made = ["n_words", "notices", "places"]

    def start() -> Callable[[list[str | None]], list]:
        return Joiner(templates, vocabulary, rank).join

    fields = "n_words long, notices array<struct<label: string, start: long, n_words: int, held: int, size: int>>, places array<struct<label: string, at: long>>"
    return by_text(docs.drop(*made), fields, start, BATCH_CHARS)


def joined(*lists: Column) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(F.concat(*lists))), ",")


def op11_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """score: 1 where a phrase stands, else the greatest share of a notice that a block holds, if it is at least THRESHOLD."""
    found = license_scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    at, base, own = F.col("places.at"), F.col("places.label"), F.col("notices.label")
    best = F.array_max(F.transform("notices", lambda x: x["held"] / x["size"]))
    return found.select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"), F.array_min(at).alias("first_word"), F.array_max(at).alias("last_word"),
        joined(base).alias("base_labels"), joined(base, own).alias("labels"),
        F.when(F.size("places") > 0, 1.0).otherwise(F.coalesce(best, F.lit(0.0))).alias("score"), F.size(F.array_distinct(F.col("notices.start"))).cast("long").alias("n_blocks"),
    )


def license_sql() -> str:
    """The query in SQL: phrases by comparing words in a row, notices by intersecting every block's words."""
    phrases = ", ".join(f"('{label}', {text.split()!r})" for text, label in sorted(PHRASES.items()))
    notices = ", ".join(f"('{label}', {sorted(set(text.split()))!r})" for label, text in sorted(NOTICES.items()))
    return f"""
with d as (
  select row_number() over () as row, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w
  from documents
), p(label, words) as (values {phrases}), t(label, words) as (values {notices}),
places as (
  select row, label, unnest(list_filter(range(len(w) - len(words) + 1), lambda i: w[i + 1 : i + len(words)] = words)) as place
  from d, p where len(w) >= len(words)
), blocks as (
  select row, start, w[start + 1 : start + {BLOCK}] as w from (select row, w, unnest(range(0, len(w), {STEP})) as start from d)
), held as (
  select row, start, label, len(list_intersect(list_distinct(w), words)) / len(words) as share
  from blocks, t where len(list_intersect(list_distinct(w), words)) >= {THRESHOLD} * len(words) - 1e-9
), b as (
  select row, count(*) as n_base, min(place) as first_word, max(place) as last_word, list(distinct label) as labels from places group by row
), h as (
  select row, max(share) as share, list(distinct label) as labels, count(distinct start) as n_blocks from held group by row
)
select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_base, 0) as n_base, first_word, last_word,
  array_to_string(list_sort(coalesce(b.labels, [])), ',') as base_labels,
  array_to_string(list_sort(list_distinct(list_concat(coalesce(b.labels, []), coalesce(h.labels, [])))), ',') as labels,
  case when n_base > 0 then 1.0 else coalesce(cast(share as double), 0.0) end as score, coalesce(n_blocks, 0) as n_blocks
from d left join b using (row) left join h using (row)
"""


OP11_SQL = license_sql()

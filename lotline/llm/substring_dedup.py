"""Operator 1: word-level substring dedup by matching statistics over suffix automata.

The reference of a document is every document with a smaller doc_id. Candidate passages are found
by `anchors.settle`; each of its shards is one bounded reference shard. A suffix automaton is built
over the shard's distinct passages, every state knows the least doc_id its strings occur in, and the
passages are streamed through it: where the matching statistic reaches the threshold, the window's
first document is read off the automaton.

The automata go to the tasks that hold the matching candidates, not to every executor: a reference
that is the corpus itself has no size bound, so it may not be broadcast.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotline.llm import anchors
from lotline.llm.common import table

WINDOW = 13
GRAM = 6
NO_DOC = np.iinfo(np.int64).max
SCHEMA = "doc_id long, n_words long, n_removed long, kept string, spans array<struct<start:long,stop:long>>"


class SuffixAutomaton:
    """Of several word sequences; `least` of a state: the least label of a sequence that has its strings."""

    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.size = [0]
        self.least = [NO_DOC]

    def _state(self, size: int, moves: dict[int, int], link: int) -> int:
        self.next.append(moves)
        self.link.append(link)
        self.size.append(size)
        self.least.append(NO_DOC)
        return len(self.link) - 1

    def _split(self, p: int, w: int, q: int) -> int:
        """The state of p's strings followed by w, cut off from q if q also has longer ones."""
        if self.size[q] == self.size[p] + 1:
            return q
        copy = self._state(self.size[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = copy
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = copy
            p = self.link[p]
        return copy

    def add(self, words: list[int], label: int) -> None:
        last = 0
        for w in words:
            q = self.next[last].get(w)
            if q is not None:
                last = self._split(last, w, q)
            else:
                new, p = self._state(self.size[last] + 1, {}, 0), last
                while p >= 0 and w not in self.next[p]:
                    self.next[p][w] = new
                    p = self.link[p]
                if p >= 0:
                    self.link[new] = self._split(p, w, self.next[p][w])
                last = new
            if label < self.least[last]:
                self.least[last] = label

    def close(self) -> None:
        """Hand each state's least label on to the states of its strings' suffixes."""
        least, link = self.least, self.link
        for v in np.argsort(np.array(self.size), kind="stable")[::-1].tolist():
            up = link[v]
            if up >= 0 and least[v] < least[up]:
                least[up] = least[v]

    def first_labels(self, words: list[int], length: int) -> list[int]:
        """The least label of each window of `length` words, from the matching statistics."""
        state, have, out = 0, 0, []
        nxt, link, size = self.next, self.link, self.size
        for i, w in enumerate(words):
            while state and w not in nxt[state]:
                state = link[state]
                have = size[state]
            to = nxt[state].get(w)
            if to is None:
                state = have = 0
            else:
                state, have = to, have + 1
            while size[link[state]] >= length:
                state = link[state]
                have = size[state]
            if i + 1 >= length:
                out.append(self.least[state] if have >= length else NO_DOC)
        return out


def solve(length: int):
    def shard(contents: list[bytes], counts: np.ndarray, least: np.ndarray) -> list[bytes | None]:
        codes: dict[bytes, int] = {}
        seqs = [[codes.setdefault(w, len(codes)) for w in c.split(b" ")] for c in contents]
        automaton = SuffixAutomaton()
        for seq, label in zip(seqs, least.tolist()):
            automaton.add(seq, label)
        automaton.close()
        out: list[bytes | None] = []
        for seq, n, own in zip(seqs, counts.tolist(), least.tolist()):
            first = np.array(automaton.first_labels(seq, length), "<i8")
            out.append(first.tobytes() if n > 1 or (first < own).any() else None)
        return out

    return shard


def covered(starts: np.ndarray, length: int, n: int) -> np.ndarray:
    """Which of n units the windows at `starts` cover."""
    edges = np.zeros(n + length + 1, np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + length, -1)
    return np.cumsum(edges[:n]) > 0


def runs_of(mask: np.ndarray) -> list[tuple[int, int]]:
    edge = np.flatnonzero(np.diff(np.concatenate(([0], mask.view(np.int8), [0])))).tolist()
    return list(zip(edge[::2], edge[1::2]))


def cut_out(raw: bytes, bounds: list[tuple[int, int]]) -> bytes:
    """raw without the bytes between each two bounds, which come in order."""
    edges = [0, *[x for b in bounds for x in b], len(raw)]
    return b"".join([raw[x:y] for x, y in zip(edges[::2], edges[1::2])])


def apply(length: int, n_carry: int, rest: bool = False):
    names = ["doc_id", "n_words", "n_removed", "kept", "spans", *["rest"] * rest, *[f"carry_{i}" for i in range(n_carry)]]

    def spans(block: anchors.Block | None, answers) -> pd.DataFrame:
        if block is None:
            return pd.DataFrame({c: [] for c in names})
        hits = []
        for at, answer in answers:
            first = np.frombuffer(answer, "<i8")
            doc = np.searchsorted(block.first, at, "right") - 1
            while block.n_units[doc] == 0 or block.first[doc] + block.n_units[doc] <= at:
                doc += 1
            hits.append(at + np.flatnonzero(first < block.ids[doc]))
        gone = covered(np.concatenate(hits) if hits else np.zeros(0, np.int64), length, len(block.starts))
        rows = []
        for d, raw in enumerate(block.raws):
            a = int(block.first[d])
            b = a + int(block.n_units[d])
            mask = gone[a:b]
            s, e = block.starts[a:b] - block.base[d], block.ends[a:b] - block.base[d]
            kept = b" ".join([b" ".join(raw[s[x] : e[y - 1]].split()) for x, y in runs_of(~mask)])
            runs = runs_of(mask)
            row = (b - a, int(mask.sum()), kept.decode("utf-8", "surrogatepass"), [{"start": x, "stop": y} for x, y in runs])
            rows.append((*row, cut_out(raw, [(s[x], e[y - 1]) for x, y in runs]).decode("utf-8", "surrogatepass")) if rest else row)
        out = pd.DataFrame(rows, columns=names[1 : 5 + rest])
        out.insert(0, "doc_id", block.own_ids)
        for c in names[5 + rest :]:
            out[c] = block.pdf[c].to_numpy()
        return out

    return spans


def substring_dedup(docs: DataFrame, length: int = WINDOW, carry: tuple[str, ...] = (), rest: bool = False) -> DataFrame:
    """Remove words covered by a window of `length` words that also starts in a smaller doc_id.

    docs: doc_id, text; other columns are ignored unless named in `carry` (returned as strings).
    Returns doc_id, n_words, n_removed, kept (words left, joined by one space), spans (removed runs,
    as word positions); with rest=True also rest: the text as it stands, with only the characters
    of the removed runs cut out. Null or empty text: no words, kept and rest ''. Texts of any length
    are used whole.
    Rows with equal doc_id are never each other's reference; a null doc_id counts as larger than
    any other. An empty table gives an empty result.
    """
    schema = SCHEMA + ", rest string" * rest + "".join(f", carry_{i} string" for i in range(len(carry)))
    out = anchors.settle(docs, True, length, min(GRAM, length), solve(length), apply(length, len(carry), rest), schema, carry)
    return out.withColumnsRenamed({f"carry_{i}": c for i, c in enumerate(carry)})


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.encode("kept", "UTF-8"), 256).alias("kept_sha256"))


OP1_SQL = r"""
with w as (
  select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws from documents
), win as (
  select doc_id, i, array_to_string(ws[i:i + 12], ' ') as g
  from (select doc_id, ws, unnest(range(1, len(ws) - 11)) as i from w)
), f as (
  select g, min(doc_id) as first from win group by g
), gone as (
  select distinct win.doc_id, unnest(range(win.i, win.i + 13)) as p from win join f on win.g = f.g where f.first < win.doc_id
), lost as (
  select doc_id, list(p) as ps, count(*) as n from gone group by doc_id
)
select w.doc_id, cast(len(ws) as bigint) as n_words, cast(coalesce(n, 0) as bigint) as n_removed,
  sha256(coalesce(array_to_string(list_filter(ws, lambda x, i: not list_contains(coalesce(ps, []), i)), ' '), '')) as kept_sha256
from w left join lost on w.doc_id = lost.doc_id
"""

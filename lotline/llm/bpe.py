"""Operator 8: byte-level BPE encoding and decoding with a pair occurrence index.

Each task splits its texts into pre-tokens and encodes the distinct new ones of an Arrow batch
together: every pair of neighbouring symbols maps to all its places in that batch of words, ranks
are taken in ascending order from a heap, and a merge updates the lists of the pairs it makes.
Merging never crosses a pre-token, so a pre-token's ids do not depend on its neighbours and are kept.
"""

from __future__ import annotations

import heapq
import json
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotline.llm.common import by_text, table

#: Fixed value: the split pattern of the byte-level tokenizers.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Pre-tokens kept, and characters encoded together, in one task.
CACHE = 300_000
CHARS = 6_000_000


def byte_alphabet() -> dict[str, int]:
    """The printable character that the vocabulary file writes for each byte: itself if printable, else from U+0100 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteBPE:
    """Encoder and decoder over a tokenizer file's vocabulary, merges and added tokens."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.check(spec)
        letters = byte_alphabet()
        vocab = spec["model"]["vocab"]
        self.ids = {bytes(letters[c] for c in s): i for s, i in vocab.items()}
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes_of = {i: b for b, i in self.ids.items()} | {i: s.encode() for s, i in self.added.items()}
        self.byte_id = np.array([self.ids[bytes([b])] for b in range(256)], np.int64)
        self.nothing = max(self.bytes_of) + 1  # stands for no symbol
        self.width = self.nothing + 1
        self.merges: list[tuple[int, int, int]] = []
        made: dict[int, int] = {}
        for r, pair in enumerate(spec["model"]["merges"]):
            a, b = (bytes(letters[c] for c in s) for s in (pair if isinstance(pair, list) else pair.split(" ")))
            left, right, new = self.ids[a], self.ids[b], self.ids[a + b]
            if max(made.get(left, -1), made.get(right, -1)) >= r or new in made:
                raise ValueError(f"merge {r} does not come after the merges that make its parts")
            made[new] = r
            self.merges.append((left, right, new))
        keys = np.array([left * self.width + right for left, right, _ in self.merges], np.int64)
        self.pair_ranks = np.argsort(keys)
        self.pair_keys = keys[self.pair_ranks]
        self.split = regex.compile(PATTERN)
        self.special = regex.compile("(" + "|".join(regex.escape(s) for s in sorted(self.added, key=len, reverse=True)) + ")") if self.added else None
        self.known: dict[str, bytes] = {}

    @staticmethod
    def check(spec: dict) -> None:
        """Refuse what this encoder does not do: normalizers, other pre-tokenizers, fallbacks, added tokens with options."""
        model, pre, odd = spec["model"], spec.get("pre_tokenizer") or {}, []
        odd += ["normalizer"] if spec.get("normalizer") else []
        odd += ["model"] if model.get("type", "BPE") != "BPE" or model.get("byte_fallback") or model.get("dropout") or model.get("ignore_merges") or model.get("end_of_word_suffix") or model.get("continuing_subword_prefix") else []
        odd += ["pre_tokenizer"] if pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True) else []
        odd += ["added_tokens"] if any(t.get(k) for t in spec["added_tokens"] for k in ("single_word", "lstrip", "rstrip")) else []
        if odd:
            raise ValueError(f"tokenizer file uses {', '.join(odd)} in a way that is not supported")

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words, joined, and where each word's begin: one pair occurrence index for all."""
        lens = np.fromiter((len(w) for w in words), np.int64, len(words))
        heads = np.concatenate(([0], np.cumsum(lens)))
        n = int(heads[-1])
        sym = self.byte_id[np.frombuffer(b"".join(words), np.uint8)]
        nxt = np.arange(1, n + 1)
        nxt[heads[1:] - 1] = n  # n: nothing there
        prev = np.arange(-1, n - 1)
        prev[heads[:-1]] = n
        sym = np.append(sym, self.nothing)
        nxt, prev = np.append(nxt, n), np.append(prev, n)
        places: dict[int, list[np.ndarray]] = {}
        active: list[int] = []

        def enter(at: np.ndarray) -> None:
            """Index the pairs that begin at these places, by rank."""
            rank = self.ranks_of(sym[at], sym[nxt[at]])
            at, rank = at[rank >= 0], rank[rank >= 0]
            if not len(at):
                return
            order = np.argsort(rank, kind="stable")
            at, rank = at[order], rank[order]
            cut = np.flatnonzero(rank[1:] != rank[:-1]) + 1
            for r, part in zip(rank[np.concatenate(([0], cut))].tolist(), np.split(at, cut) if len(cut) else [at]):
                if r in places:
                    places[r].append(part)
                else:
                    places[r] = [part]
                    heapq.heappush(active, r)

        enter(np.arange(n))
        while active:
            r = heapq.heappop(active)
            left, right, new = self.merges[r]
            lists = places.pop(r)
            i = lists[0] if len(lists) == 1 else np.unique(np.concatenate(lists))
            i = i[(sym[i] == left) & (sym[nxt[i]] == right)]
            if left == right:
                free, kept = -1, []
                for x, y in zip(i.tolist(), nxt[i].tolist()):
                    if x != free:
                        kept.append(x)
                        free = y
                i = np.array(kept, np.int64)
            if not len(i):
                continue
            j = nxt[i]
            k = nxt[j]
            sym[i], sym[j] = new, self.nothing
            nxt[i] = k
            prev[k] = i
            prev[n] = n
            h = prev[i]
            enter(np.unique(np.concatenate((i, h[h < n]))))
        live = sym[:n] != self.nothing
        return sym[:n][live].astype("<u4"), np.concatenate(([0], np.cumsum(live)))[heads]

    def ranks_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, -1 if it never merges."""
        key = left.astype(np.int64) * self.width + right
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == key, self.pair_ranks[at], -1)

    def learn(self, tokens: set[str]) -> None:
        """Encode the pre-tokens not seen yet; what is kept is bounded."""
        new = [t for t in tokens if t not in self.known]
        if len(self.known) + len(new) > CACHE:
            self.known.clear()
            new = list(tokens)
        ids, at = self.merge([t.encode("utf-8", "surrogatepass") for t in new])
        data, at = ids.tobytes(), (at * 4).tolist()
        for t, a, b in zip(new, at, at[1:]):
            self.known[t] = data[a:b]

    def pieces(self, text: str) -> list[str]:
        """Pre-tokens, added tokens standing for themselves."""
        if self.special is None or not self.special.search(text):
            return self.split.findall(text)
        out: list[str] = []
        for i, part in enumerate(self.special.split(text)):
            out += [part] if i % 2 else self.split.findall(part)
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids as little-endian 32-bit integers, per text."""
        added = {s: i.to_bytes(4, "little") for s, i in self.added.items()}
        parts = [self.pieces(t) for t in texts]
        distinct = set().union(*parts)
        self.learn(distinct - added.keys())
        known = self.known | added if distinct & added.keys() else self.known
        return [b"".join([known[p] for p in ps]) for ps in parts]

    def decode(self, ids: bytes) -> str:
        return b"".join([self.bytes_of[i] for i in memoryview(ids).cast("I")]).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def tokenizer(path: str) -> ByteBPE:
    return ByteBPE(path)


def bpe_round_trip(docs: DataFrame, path: str) -> DataFrame:
    """Encode each whole text and decode it again.

    docs: doc_id, text; other columns are ignored. path: a tokenizer file that every executor has.
    Returns doc_id, n_tokens, ids (little-endian unsigned 32-bit), decoded. Null or empty text: no
    tokens, decoded ''. Added tokens inside a text count as such. Repeated rows give repeated rows.
    """

    def start():
        bpe = tokenizer(path)

        def work(texts: list[str | None]) -> list:
            ids = bpe.encode([t or "" for t in texts])
            return [pa.array([len(x) // 4 for x in ids], pa.int64()), ids, [bpe.decode(x) for x in ids]]

        return work

    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return by_text(own, "n_tokens long, ids binary, decoded string", start, CHARS)


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    out = bpe_round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return out.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"))

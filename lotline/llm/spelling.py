"""Operator 13: spelling variants by sorted-list dynamic programming over the vocabulary.

Two words of one edit's distance, the shorter of m letters, differ first at some place p, and one edit
there makes them equal. All words that can differ first inside an interval [lo, hi) share the letters
before lo and the last m - hi letters: that pair, with m and the interval, is the key under which they
meet. Every word starts with both halves of [0, m] for m its own length and one less. A key with too many
words has its interval halved, again and again; with one place left, at most one letter (or two, of the
longer words) is free, so the alphabet bounds the group. No key, however common the stem, is held by one task.

Under a key the words lie sorted. A word is compared with those behind it by a banded edit matrix, one row
per letter; the rows of the prefix that a word shares with the one before it (their common prefix length)
are used again. Where the row of a prefix already exceeds one edit, all words with that prefix are skipped
in one step. A pair is reported only under the key whose interval holds its first difference, so once.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lotline.llm.common import forget, staged, table

# Runs of these letters are words; one letter of a run is lost where CRC divides its checksum.
LETTERS = "[A-Za-zÀ-ÿ]+"
CRC = 199
SHORTEST, FEWEST, FACTOR = 6, 5, 5
#: Words under one key before its interval is halved.
CROWD = 256
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def word_counts(docs: DataFrame, shortest: int = SHORTEST, fewest: int = FEWEST) -> DataFrame:
    """(word, n): the words of all texts. A run in a document with a null id keeps all its letters; a null text has none."""
    runs = docs.select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(f"({LETTERS})"), 1)).alias("run"))
    runs = runs.where(F.length("run") >= shortest).select("doc_id", F.translate("run", UPPER, LOWER).alias("run"))
    h = F.crc32(F.encode(F.concat(F.col("doc_id").cast("string"), F.lit(":"), "run"), "UTF-8"))
    at = (h % F.length("run")).cast("int")
    cut = F.concat(F.expr("substring(run, 1, at)"), F.expr("substring(run, at + 2)"))
    words = runs.withColumns({"lost": F.coalesce(h % CRC == 0, F.lit(False)), "at": at}).select(F.when(F.col("lost"), cut).otherwise(F.col("run")).alias("word"))
    return words.where(F.length("word") >= shortest).groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= fewest)


def with_key(places: DataFrame) -> DataFrame:
    """places (word, n, m, lo, hi) with the key of each: what all words of the interval share."""
    tail = F.expr("right(word, greatest(m - hi, 0))")
    return places.withColumn("key", F.concat_ws("\t", F.col("m").cast("string"), F.col("lo").cast("string"), F.col("hi").cast("string"), F.expr("substring(word, 1, lo)"), tail))


def first_places(words: DataFrame, shortest: int = SHORTEST) -> DataFrame:
    """Every word under both halves of the places of its own length and of one letter less."""
    m = F.explode(F.filter(F.array(F.length("word"), F.length("word") - 1), lambda x: x >= shortest))
    own = words.select("word", "n", m.alias("m")).withColumn("half", F.floor(F.col("m") / 2).cast("int"))
    interval = F.explode(F.array(F.struct(F.lit(0).alias("lo"), F.col("half").alias("hi")), F.struct(F.col("half").alias("lo"), (F.col("m") + 1).alias("hi"))))
    return with_key(own.withColumn("i", interval).select("word", "n", "m", "i.lo", "i.hi"))


def halved(places: DataFrame) -> DataFrame:
    """The same words under both halves of their interval."""
    mid = F.floor((F.col("lo") + F.col("hi")) / 2).cast("int")
    interval = F.explode(F.array(F.struct("lo", mid.alias("hi")), F.struct(mid.alias("lo"), "hi")))
    return with_key(places.withColumn("i", interval).select("word", "n", "m", "i.lo", "i.hi"))


def shared_prefix(a: str, b: str) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    i = 0
    while a[i] == b[i]:
        i += 1
    return i


def scan(words: list[str]) -> Iterator[tuple[int, int, int]]:
    """(i, j, first difference) of all i < j with exactly one edit between words[i] and words[j]; words are sorted and distinct.

    rows[d] holds the distances of the first d letters of the list's word from the first d - 1, d and d + 1
    letters of words[i]: the band that one edit can reach; 2 stands for anything beyond one edit.
    """
    n = len(words)
    lcp = [0] * n + [-1]
    beyond, stack = [n] * (n + 1), []  # the next place with a smaller common prefix
    for j in range(1, n + 1):
        if j < n:
            lcp[j] = shared_prefix(words[j - 1], words[j])
        while stack and lcp[j] < lcp[stack[-1]]:
            beyond[stack.pop()] = j
        stack.append(j)
    for i in range(n - 1):
        q = words[i]
        size = len(q)
        rows = [(2, 0, 1)] + [(1, 0, 1)] * (size - 1) + [(1, 0, 2)]  # words[i] against itself
        depth, j = size, i + 1
        while j < n:
            w, d = words[j], min(depth, lcp[j])
            left, mid, right = rows[d]
            while d < len(w):
                c = w[d]
                a = min(left + (d < 1 or q[d - 1] != c), mid + 1) if d <= size else 2
                b = min(mid + (q[d] != c), right + 1, a + 1) if d < size else 2
                right = min(right + (q[d + 1] != c), b + 1) if d + 1 < size else 2
                left, mid, d = a, b, d + 1
                rows[d:] = [(left, mid, right)]
                if left > 1 and mid > 1 and right > 1:
                    break
            depth, gap = d, size - len(w)
            if left > 1 and mid > 1 and right > 1:
                j += 1
                while lcp[j] >= d:  # all of these begin with the prefix given up
                    j = beyond[j]
                continue
            if -1 <= gap <= 1 and (left, mid, right)[gap + 1] == 1:
                yield i, j, shared_prefix(q, w)
            j += 1


NEAR = "word string, near string, near_n long"


def near_under_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Both directions of every near pair. Rows (key, word, n, m, lo, hi) come sorted by key and word; one key's are held at a time."""
    out: list[tuple[str, str, int]] = []

    def settle(group: list[tuple]) -> None:
        m, lo, hi = group[0][2:]
        for i, j, first in scan([g[0] for g in group]):
            (a, a_n), (b, b_n) = group[i][:2], group[j][:2]
            if lo <= first < hi and min(len(a), len(b)) == m:
                out.extend(((a, b, b_n), (b, a, a_n)))

    def flushed() -> pa.RecordBatch:
        batch = pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], t) for i, t in enumerate((pa.string(), pa.string(), pa.int64()))], ["word", "near", "near_n"])
        out.clear()
        return batch

    key, group = None, []
    for batch in batches:
        for k, *row in zip(*(batch.column(c).to_pylist() for c in ("key", "word", "n", "m", "lo", "hi"))):
            if k != key:
                if len(group) > 1:
                    settle(group)
                key, group = k, []
            group.append(tuple(row))
        yield flushed()
    if len(group) > 1:
        settle(group)
    yield flushed()


def near_pairs(words: DataFrame, shortest: int = SHORTEST, crowd: int = CROWD) -> DataFrame:
    """(word, near, near_n): both directions of all pairs of distinct words with exactly one edit between them.

    words: word, n; distinct words of at least `shortest` letters. crowd only splits the work.
    """
    places, found = first_places(words, shortest), []
    while True:
        crowds = places.where("hi - lo > 1").groupBy("key").agg(F.count(F.lit(1)).alias("k")).where(F.col("k") > crowd).select("key")
        calm = places.join(crowds, "key", "left_anti").select("key", "word", "n", "m", "lo", "hi")
        found.append(calm.repartition("key").sortWithinPartitions("key", "word").mapInArrow(near_under_keys, NEAR))
        rest = staged(halved(places.join(crowds, "key", "left_semi")), "crowded")
        if rest.isEmpty():  # at the latest when every interval is one place
            break
        places = rest
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): forms (word, form) followed to the last, doubling the steps taken.

    A form's n is FACTOR times its word's, so chains end after fewer than 28 steps: 5 rounds at most.
    """
    at = staged(forms.select("word", F.col("form").alias("root")), "steps")
    while True:
        ahead = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        if at.join(ahead, "root", "left_semi").isEmpty():
            return at
        longer = staged(at.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "steps")
        forget(at)
        at = longer


def spelling_variants(docs: DataFrame, shortest: int = SHORTEST, fewest: int = FEWEST, factor: int = FACTOR, crowd: int = CROWD) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of at least `shortest` letters and `fewest` occurrences.

    docs: doc_id, text (other columns are ignored). n_near counts the words with exactly one inserted,
    deleted or replaced letter; form is the one of largest n, ties to the first in code-point order, if that n
    is at least `factor` (2 or more) times the word's own, else null with form_n; root follows forms to the
    last, the word itself if it has none. Null texts have no words; repeated rows count again; empty in, empty out.
    """
    if factor < 2:
        raise ValueError("factor must be 2 or more")
    words = staged(word_counts(docs, shortest, fewest), "words")
    best = near_pairs(words, shortest, crowd).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    ahead = F.coalesce(-F.col("best.less") >= factor * F.col("n"), F.lit(False))
    own = words.join(best, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(ahead, F.col("best.near")).alias("form"), F.when(ahead, -F.col("best.less")).alias("form_n"))
    own = staged(own, "forms")
    last = roots(own.where("form is not null"))
    return own.join(last, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"))


def crc_table() -> list[int]:
    """Remainders of the reflected CRC-32 polynomial for the 16 values of half a byte."""
    out = []
    for v in range(16):
        for _ in range(4):
            v = v >> 1 ^ (0xEDB88320 if v & 1 else 0)
        out.append(v)
    return out


#: Half bytes of a text, low half first, and their checksum by list_reduce.
HALVES = "list_transform(range(2 * octet_length(encode({s}))), lambda i: strpos('123456789ABCDEF', substring(hex(encode({s})), i + case when i % 2 = 0 then 2 else 0 end, 1)))"
OP13_SQL = f"""
with runs as materialized (
  select cast(doc_id as varchar) || ':' || run as named, run, count(*) as k from (
    select doc_id, translate(unnest(regexp_extract_all(text, '{LETTERS}')), '{UPPER}', '{LOWER}') as run from documents)
  where length(run) >= {SHORTEST} group by doc_id, run
), sums as (
  select run, k, list_reduce({HALVES.format(s="named")}, lambda c, x: xor(c >> 4, {crc_table()}[cast(xor(c, x) & 15 as integer) + 1]), 4294967295) as c from runs
), lost as (
  select case when xor(c, 4294967295) % {CRC} = 0
    then left(run, cast(xor(c, 4294967295) % length(run) as integer)) || substring(run, cast(xor(c, 4294967295) % length(run) as integer) + 2) else run end as word, k from sums
), words as materialized (
  select word, cast(sum(k) as bigint) as n from lost where length(word) >= {SHORTEST} group by word having sum(k) >= {FEWEST}
), places as (
  select word, n, unnest(range(length(word))) as p from words
), masked as (
  select word, n, left(word, p) || '_' || substring(word, p + 2) as key, left(word, p) || substring(word, p + 2) as short from places
), near as (
  select distinct a.word, b.word as near, b.n as near_n from masked a join masked b on a.key = b.key and a.word <> b.word
  union select distinct m.word, w.word, w.n from masked m join words w on m.short = w.word
  union select distinct w.word, m.word, m.n from masked m join words w on m.short = w.word
), best as (
  select word, count(*) as n_near, max(near_n) as most, arg_min(near, struct_pack(a := -near_n, b := near)) as form from near group by word
), own as materialized (
  select word, n, coalesce(n_near, 0) as n_near, case when most >= {FACTOR} * n then form end as form, case when most >= {FACTOR} * n then most end as form_n from words left join best using (word)
), chain as (
  with recursive c(word, last, step) as (select word, word, 0 from own union all select c.word, o.form, step + 1 from c join own o on c.last = o.word where o.form is not null)
  select word, arg_max(last, step) as root from c group by word
)
select word, form, root, n, n_near, form_n from own join chain using (word)
"""

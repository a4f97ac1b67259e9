"""Ordered work inside groups: first and last, ranks, streaks, ranges, timelines, tags."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def nth(df: DataFrame, keys: list[str], order: list[Column], n: int = 1) -> DataFrame:
    """The first n rows of each group."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("_n") <= n).drop("_n")


def first_last_docs(docs: DataFrame) -> DataFrame:
    """application_id, id, position: each application's first and last document; undated ones last in both; a single one is 'first'."""
    have = docs.where("file_path is not null").select("application_id", "id", "published_at")
    first = F.min(F.struct(F.col("published_at").isNull().alias("u"), "published_at", "id"))
    last = F.max(F.struct(F.col("published_at").isNotNull().alias("d"), "published_at", "id"))
    both = have.groupBy("application_id").agg(first["id"].alias("a"), last["id"].alias("b"))
    ends = F.when(F.col("a") == F.col("b"), F.array(F.struct(F.col("a").alias("id"), F.lit("first").alias("position")))).otherwise(F.array(F.struct(F.col("a").alias("id"), F.lit("first").alias("position")), F.struct(F.col("b").alias("id"), F.lit("last").alias("position"))))
    return both.select("application_id", F.inline(ends))


# Document types worth a second look, best first.
TIER2_TYPES = ["Specialist Reports", "Stamped Approved Plans", "Plans", "Amended DA Form 1", "Supporting Documents", "Cover Letter"]


def tier2_docs(docs: DataFrame, done: DataFrame, n: int = 3) -> DataFrame:
    """Up to n documents per application by type, then date, then id, leaving out those done."""
    place = F.array_position(F.array(*map(F.lit, TIER2_TYPES)), F.col("doc_type"))
    left = docs.where("file_path is not null").join(done.select(F.col("document_id").alias("id")), "id", "left_anti").withColumn("_place", place).where("_place > 0")
    return nth(left, ["application_id"], [F.col("_place"), F.col("published_at").asc_nulls_first(), F.col("id")], n).drop("_place")


def select_downloads(docs: DataFrame, types: list[str] | None = None, max_bytes: int | None = None) -> DataFrame:
    """The first and last document of each application in time, then those of the wanted types and size."""
    order = Window.partitionBy("application_id")
    up = F.row_number().over(order.orderBy(F.col("published_at").asc_nulls_last(), "id"))
    down = F.row_number().over(order.orderBy(F.col("published_at").desc_nulls_first(), F.desc("id")))
    ends = docs.withColumns({"_a": up, "_b": down}).where("_a = 1 or _b = 1").drop("_a", "_b")
    ends = ends.where(F.col("doc_type").isin(types)) if types else ends
    return ends.where(F.col("file_size") <= max_bytes) if max_bytes else ends


def failure_streaks(df: DataFrame, keys: list[str], order: list[str], failed: Column, k: int) -> DataFrame:
    """Per group the row at which k failures in a row are reached for the first time."""
    w = Window.partitionBy(*keys).orderBy(*order)
    flagged = df.withColumn("_fail", F.coalesce(failed, F.lit(False))).withColumn("_island", F.sum(F.when(~F.col("_fail"), 1).otherwise(0)).over(w))
    run = F.count_if(F.col("_fail")).over(Window.partitionBy(*keys, "_island").orderBy(*order))
    hits = flagged.withColumn("_run", run).where(F.col("_fail") & (F.col("_run") == k))
    return nth(hits, keys, [F.col(c) for c in order]).drop("_fail", "_island", "_run")


def format_ranges(df: DataFrame, keys: list[str], page: str) -> DataFrame:
    """Per group the distinct page numbers as '1-3,5'."""
    rows = df.select(*keys, page).distinct().withColumn("_i", F.col(page) - F.row_number().over(Window.partitionBy(*keys).orderBy(page)))
    runs = rows.groupBy(*keys, "_i").agg(F.min(page).alias("a"), F.max(page).alias("b"))
    text = F.when(F.col("a") == F.col("b"), F.col("a").cast("string")).otherwise(F.concat_ws("-", "a", "b"))
    return runs.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("a", text.alias("t")))).alias("r")).select(*keys, F.array_join(F.col("r.t"), ",").alias("ranges"))


STAGES = ["submission", "amendment", "ir_council", "ir_response", "further_info", "decision", "other"]


def entity_timeline(links: DataFrame, docs: DataFrame, stage: Column) -> DataFrame:
    """application_id, stage, role, company_id, is_new: each role and company once per stage; new if the company stands in no earlier stage or row.

    Rows are dealt once by application and company, which serves the grouping and the order both.
    """
    place = F.array_position(F.array(*map(F.lit, STAGES)), F.col("stage"))
    joined = links.select("application_id", "role", "company_id", "source_doc_id").join(docs.select(F.col("id").alias("source_doc_id"), stage.alias("stage")), "source_doc_id")
    rows = joined.repartition("application_id", "company_id").groupBy("application_id", "stage", "role", "company_id").agg(F.min("source_doc_id").alias("doc")).withColumn("_place", place)
    first = F.row_number().over(Window.partitionBy("application_id", "company_id").orderBy("_place", "doc", "role"))
    return rows.withColumn("is_new", first == 1).drop("_place", "doc")


def stage_recall(links: DataFrame, docs: DataFrame, stage: Column) -> DataFrame:
    """Per stage: documents, and those with an entity."""
    have = links.select(F.col("source_doc_id").alias("id")).distinct().withColumn("_hit", F.lit(True))
    return docs.select("id", stage.alias("stage")).join(have, "id", "left").groupBy("stage").agg(F.count(F.lit(1)).alias("n_docs"), F.count("_hit").alias("n_with_entities"))


def mark_primary(links: DataFrame) -> DataFrame:
    """is_primary: the first applicant row of each document."""
    n = F.row_number().over(Window.partitionBy("source_doc_id", "role").orderBy("company_id"))
    return links.withColumn("is_primary", (F.col("role") == "applicant") & (n == 1))


def bio_tags(overlaps: DataFrame) -> DataFrame:
    """doc_id, page, word, tag: the first word of an entity B-, the rest I-; later entities overwrite earlier ones."""
    n = F.row_number().over(Window.partitionBy("doc_id", "page", "entity").orderBy("word"))
    tagged = overlaps.withColumn("tag", F.concat(F.when(n == 1, "B-").otherwise("I-"), F.upper("role")))
    return tagged.groupBy("doc_id", "page", "word").agg(F.max_by("tag", "entity").alias("tag"))


def dedupe_window(rows: DataFrame, keys: list[str], time: str, hours: int) -> DataFrame:
    """keys and times of the rows stored when a row is stored only if its key's last stored one is at least `hours` old.

    Rows are dealt by key and sorted by time, and each partition is read as a stream that remembers one
    key and its last stored time: no key's rows are held together, however many there are.
    """
    micros = hours * 3600 * 1_000_000
    key = F.to_json(F.struct(*keys))
    dealt = rows.where(F.col(time).isNotNull()).select(*keys, time, key.alias("_key"), F.unix_micros(F.col(time).cast("timestamp")).alias("_at"))
    dealt = dealt.repartition("_key").sortWithinPartitions("_key", "_at")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last_key, last = None, 0
        for batch in batches:
            names, at = batch.column("_key").to_pylist(), batch.column("_at").to_numpy()
            edges = [0, *(i for i in range(1, len(names)) if names[i] != names[i - 1]), len(names)] if names else [0]
            kept = []
            for a, b in zip(edges, edges[1:]):
                i = a if names[a] != last_key else a + int(np.searchsorted(at[a:b], last + micros))
                while i < b:
                    kept.append(i)
                    last_key, last = names[a], int(at[i])
                    i = a + int(np.searchsorted(at[a:b], last + micros))
            yield batch.select([*keys, time]).take(pa.array(kept, pa.int64()))

    return dealt.mapInArrow(run, rows.select(*keys, time).schema)

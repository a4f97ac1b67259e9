"""What is left to do: summaries, companies, targets, built checks; and pairs of applications on one lot."""

from __future__ import annotations

import datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotline.functions.classify import is_approved, target_kind_predicate
from lotline.functions.urls import confidence, website_score
from lotline.operators.joins import suburb_matches, unit_evidence
from lotline.operators.ordered import nth


def pending_summaries(apps: DataFrame, summaries: DataFrame, needed: int = 2) -> DataFrame:
    """Applications with fewer than `needed` first-tier summaries."""
    have = summaries.where("doc_position in ('first', 'last')").groupBy(F.col("application_id").alias("id")).agg(F.count(F.lit(1)).alias("n_done"))
    return apps.select("id").join(have, "id", "left").withColumn("n_done", F.coalesce("n_done", F.lit(0))).where(F.col("n_done") < needed)


def pending_escalations(summaries: DataFrame, docs: DataFrame, done: DataFrame) -> DataFrame:
    """Applications whose summary is not complete and that have a document the second tier has not read."""
    unread = docs.where("file_path is not null").select("application_id", F.col("id").alias("document_id")).join(done.select("document_id"), "document_id", "left_anti")
    return summaries.where("status = 'incomplete'").select("application_id").join(unread, "application_id", "left_semi")


def pending_chunks(chunks: DataFrame, done: DataFrame) -> DataFrame:
    """Chunks (doc_id, chunk_index) of documents that are not done yet."""
    return chunks.join(done.select("doc_id", "chunk_index"), ["doc_id", "chunk_index"], "left_anti")


def score_websites(candidates: DataFrame, keep: int = 5) -> DataFrame:
    """Per business and role the best link, its confidence, and the `keep` best links; equal scores by link.

    Only the best `keep` of each group and partition are shuffled, so no group is gathered whole.
    """
    scored = candidates.select("name", "role", "url", website_score(F.col("url"), F.col("name"), F.col("role")).alias("score"))
    best = nth(scored, ["name", "role"], [F.desc("score"), F.col("url")], keep)
    ranked = F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("order"), "url")))  # at most `keep` links
    out = best.groupBy("name", "role").agg(ranked.alias("r"))
    return out.select("name", "role", F.col("r")[0]["url"].alias("url"), (-F.col("r")[0]["order"]).alias("score"), confidence(-F.col("r")[0]["order"]).alias("confidence"), F.col("r.url").alias("top"))


def select_targets(apps: DataFrame, covered: DataFrame, kind: str) -> DataFrame:
    """Applications of a kind at streets that are not covered yet."""
    return apps.where(target_kind_predicate(kind, F.col("description"))).join(covered.select("street_address").distinct(), "street_address", "left_anti")


def target_states(targets: DataFrame, properties: dict[str, DataFrame], attempts: DataFrame) -> DataFrame:
    """targets with `state`: whether each source covers them, and how.

    targets: street, suburb, search_address. properties: per source its display_address. attempts: source,
    display_address, result. A source covers a target that one of its properties' addresses begins with (street type
    written out, suburb behind it), or whose search address it was asked for with result found or not_found, in any case
    of letters. skipped: all sources have properties; skipped_by_attempt: all cover it, some only by an
    attempt; partial: some cover it, kept to fill in the rest; open: none does.
    """
    out = targets.withColumn("_asked", F.lower("search_address"))
    tried = attempts.where(F.col("result").isin("found", "not_found")).select("source", F.lower("display_address").alias("_asked")).distinct()
    marks = []
    for n, (source, df) in enumerate(properties.items()):
        seen = suburb_matches(targets.select("street", "suburb").distinct(), df.select("display_address")).select("street", "suburb").distinct()
        out = out.join(seen.withColumn(f"_has{n}", F.lit(True)), ["street", "suburb"], "left").join(tried.where(F.col("source") == source).select("_asked", F.lit(True).alias(f"_tried{n}")), "_asked", "left")
        marks.append((F.coalesce(f"_has{n}", F.lit(False)), F.coalesce(f"_has{n}", f"_tried{n}", F.lit(False))))
    has, covered = ([m[i] for m in marks] for i in (0, 1))
    every = lambda cs: reduce(lambda x, y: x & y, cs)
    state = F.when(every(has), "skipped").when(every(covered), "skipped_by_attempt").when(reduce(lambda x, y: x | y, covered), "partial").otherwise("open")
    return out.withColumn("state", state).select(*targets.columns, "state")


def coverage_label(streets: DataFrame, first: DataFrame, second: DataFrame) -> DataFrame:
    """street_address, coverage: both, first, second or none of two sources."""
    mark = lambda df, c: df.select("street_address").distinct().withColumn(c, F.lit(True))
    out = streets.select("street_address").distinct().join(mark(first, "a"), "street_address", "left").join(mark(second, "b"), "street_address", "left")
    return out.select("street_address", F.when(F.col("a") & F.col("b"), "both").when(F.col("a"), "first").when(F.col("b"), "second").otherwise("none").alias("coverage"))


def builtcheck_candidates(apps: DataFrame, urls: DataFrame, as_of: datetime.date, months: int = 12) -> DataFrame:
    """id, unit_address: units of approved multi-dwelling applications, old enough, whose street has no evidence yet."""
    old = apps.where(is_approved(F.col("decision_outcome")) & (F.col("decision_date") <= F.date_sub(F.lit(as_of), months * 30)) & (F.col("dwelling_count") > 1) & (F.col("street_address") != ""))
    left = old.join(unit_evidence(old, urls).select("street_address").distinct(), "street_address", "left_anti")
    return left.select("id", F.explode(F.sequence(F.lit(1), F.col("dwelling_count"))).alias("unit"), "street_address").select("id", F.concat_ws("/", F.col("unit").cast("string"), "street_address").alias("unit_address"))


def collapse_paired(apps: DataFrame) -> DataFrame:
    """One row per lot and lodgement day: the least id, and how many applications it stands for."""
    return apps.groupBy("lot_on_plan", "lodged_date").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("n_applications"))


def redev_signal(apps: DataFrame) -> DataFrame:
    """Per lot the earliest dual-occupancy application of type MCU."""
    hits = apps.where(F.col("application_id").startswith("MCU/") & F.col("description").rlike(r"(?i)dual\s+occupancy|duplex"))
    return hits.groupBy("lot_on_plan").agg(F.min_by(F.struct("id", "lodged_date"), F.struct("lodged_date", "id")).alias("f")).select("lot_on_plan", "f.id", "f.lodged_date")


def match_lot_then_address(left: DataFrame, right: DataFrame) -> DataFrame:
    """id, match_id, matched_by: by lot and plan, else by address; of several the least id."""
    one = lambda key, c: right.where(F.col(key).isNotNull()).groupBy(key).agg(F.min("id").alias(c))
    out = left.join(one("lot_on_plan", "_lot"), "lot_on_plan", "left").join(one("street_address", "_address"), "street_address", "left")
    return out.select("id", F.coalesce("_lot", "_address").alias("match_id"), F.when(F.col("_lot").isNotNull(), "lot").when(F.col("_address").isNotNull(), "address").alias("matched_by"))


def pipeline_status(summaries: DataFrame) -> DataFrame:
    """Counters per position: rows, applications, distinct names, rows without a usable name."""
    usable = F.when(~F.col("builder_name").isin("", "unknown"), F.col("builder_name"))
    return summaries.groupBy("doc_position").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("application_id").alias("n_applications"), F.count_distinct(usable).alias("n_names"), F.count_if(usable.isNull()).alias("n_skipped"))


def progress_counters(doc_rows: DataFrame, summaries: DataFrame, roles: list[str]) -> DataFrame:
    """measure, label, n: documents by tier and by method, summaries by status and confidence, distinct names over all roles."""
    by = lambda df, c: df.groupBy(F.coalesce(F.col(c).cast("string"), F.lit("none")).alias("label")).agg(F.count(F.lit(1)).alias("n")).select(F.lit(c).alias("measure"), "label", "n")
    names = summaries.select(*roles).unpivot([], roles, "role", "name").where("name <> ''").agg(F.count_distinct("name").alias("n")).select(F.lit("names").alias("measure"), F.lit("distinct").alias("label"), "n")
    return reduce(DataFrame.unionByName, [by(doc_rows, "tier"), by(doc_rows, "extraction_method"), by(summaries, "status"), by(summaries, "confidence"), names])

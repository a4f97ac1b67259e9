"""Lookups and selections by key: pages, documents to read, context of documents, status of companies."""

from __future__ import annotations

import datetime
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Types of documents that name parties, and the greatest file read for them.
PARTY_TYPES = ["decision notice", "confirmation notice", "information request", "cover letter", "response to ir", "plans", "drawings"]
MOST_BYTES = 10 * 1024 * 1024


def dedupe_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key in order; aggregated before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    best = F.min_by(F.struct(*rest), F.struct(*order))
    return df.groupBy(*keys).agg(best.alias("_r")).select(*keys, "_r.*")


def fresh_pages(pages: DataFrame, max_age_hours: int, as_of: datetime.datetime) -> DataFrame:
    """Per source and link the newest page fetched within the last hours, ties to the greater page id."""
    since = as_of - datetime.timedelta(hours=max_age_hours)
    rest = [c for c in pages.columns if c not in ("source", "url_hash")]
    newest = F.max_by(F.struct(*rest), F.struct("fetched_at", "page_id"))
    return pages.where(F.col("fetched_at") >= F.lit(since).cast(pages.schema["fetched_at"].dataType)).groupBy("source", "url_hash").agg(newest.alias("_r")).select("source", "url_hash", "_r.*")


def lookup_page(rows: DataFrame, pages: DataFrame) -> DataFrame:
    """rows (url_hash, content_hash) with the page of that link and body (of several the greatest), else the link's least page; null links find none."""
    exact = pages.groupBy("url_hash", "content_hash").agg(F.max("page_id").alias("_exact"))
    link = pages.groupBy("url_hash").agg(F.min("page_id").alias("_link"))
    out = rows.join(exact, ["url_hash", "content_hash"], "left").join(link, "url_hash", "left")
    return out.withColumn("page_id", F.coalesce("_exact", "_link")).drop("_exact", "_link")


def listings_by_suburb(listings: DataFrame) -> DataFrame:
    """Listings per suburb, postcode and source; unknown places count as '?'."""
    known = lambda c: F.coalesce(F.nullif(c, F.lit("")), F.lit("?")).alias(c)
    return listings.groupBy(known("suburb"), known("postcode"), "source").agg(F.count(F.lit(1)).alias("n_listings"))


def candidate_docs(docs: DataFrame, apps: DataFrame, type_codes: list[str] | None = None, max_docs: int | None = None, max_bytes: int = MOST_BYTES) -> DataFrame:
    """Documents with a file whose type can name parties, not over max_bytes; of the given application types, and of applications with few documents."""
    t = F.lower("doc_type")
    out = docs.where(F.col("file_path").isNotNull() & reduce(or_, [t.contains(p) for p in PARTY_TYPES]) & (F.coalesce("file_size", F.lit(0)) <= max_bytes))
    if type_codes:
        own = apps.where(F.substring_index("application_id", "/", 1).isin(type_codes)).select(F.col("id").alias("application_id"))
        out = out.join(own, "application_id", "left_semi")
    if max_docs:
        few = docs.groupBy("application_id").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") <= max_docs)
        out = out.join(few, "application_id", "left_semi")
    return out


def doc_metadata(docs: DataFrame, apps: DataFrame, councils: DataFrame) -> DataFrame:
    """Documents (id, application_id, doc_type, doc_kind) with council, vendor and state; unknown councils have the state 'unknown'."""
    own = apps.select(F.col("id").alias("application_id"), F.col("council_slug").alias("council"), "vendor")
    out = docs.join(own, "application_id").join(councils.select(F.col("slug").alias("council"), F.lower("state").alias("state")), "council", "left")
    known = lambda c, other: F.coalesce(F.nullif(c, F.lit("")), F.lit(other))
    return out.select(F.col("id").alias("doc_id"), "application_id", known("doc_kind", "other").alias("kind"), known("doc_type", "unknown").alias("type"), "council", F.coalesce("state", F.lit("unknown")).alias("state"), "vendor")


def context_tags(meta: DataFrame) -> DataFrame:
    """meta with `tags`: its fields as bracketed words to set before a document."""
    tag = lambda name, c: F.concat(F.lit(f"[{name}: "), F.col(c), F.lit("]"))
    return meta.withColumn("tags", F.array(*[tag(c.upper(), c) for c in ("kind", "type", "council", "state", "vendor")]))


def company_status(companies: DataFrame, top: int = 10) -> DataFrame:
    """measure, label, n: companies, those enriched and registered, and the most frequent localities; ties to the name."""
    total = companies.agg(F.count(F.lit(1)).alias("total"), F.count("registry_fetched_at").alias("enriched"), F.count_if(F.coalesce(F.col("registry_status") == "Registered", F.lit(False))).alias("registered"))
    counts = total.unpivot([], ["total", "enriched", "registered"], "label", "n").select(F.lit("companies").alias("measure"), "label", "n")
    places = companies.where("locality is not null").groupBy(F.col("locality").alias("label")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "label").limit(top)
    return counts.unionByName(places.select(F.lit("locality").alias("measure"), "label", "n"))


def reclassified(docs: DataFrame, kind, only_null: bool = False) -> tuple[DataFrame, DataFrame]:
    """(docs with doc_kind worked out anew, one row: scanned, updated). only_null leaves documents that have a kind."""
    use = F.col("doc_kind").isNull() if only_null else F.lit(True)
    report = docs.agg(F.count_if(use).alias("scanned"), F.count_if(use & ~F.col("doc_kind").eqNullSafe(kind)).alias("updated"))
    return docs.withColumn("doc_kind", F.when(use, kind).otherwise(F.col("doc_kind"))), report

"""Aggregations: per suburb, month, application, company, document."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotline.functions.classify import classify_kind, doc_kind, is_approved_exactly, kind_predicate
from lotline.operators.joins import matched


def count_where(condition: Column, name: str) -> Column:
    """How many rows meet a condition; null counts as no."""
    return F.count_if(matched(condition)).alias(name)


def suburb_stats(apps: DataFrame, as_of: datetime.date, kind: str | None = None, limit: int = 40) -> DataFrame:
    """Per suburb: all applications, those of the kind, and of these the last 30 and the 30 days before."""
    day = F.lit(as_of)
    hit = kind_predicate(kind, F.col("description"), F.col("approved_units"))
    hit = F.lit(True) if hit is None else matched(hit)
    recent, before = F.date_sub(day, 30), F.date_sub(day, 60)
    out = apps.where("suburb <> ''").groupBy(F.upper("suburb").alias("suburb")).agg(
        F.count(F.lit(1)).alias("n_total"), count_where(hit, "n_kind"), count_where(hit & (F.col("lodged_date") >= recent), "n_last_30d"),
        count_where(hit & (F.col("lodged_date") >= before) & (F.col("lodged_date") < recent), "n_prev_30d"),
    )
    return out.where("n_kind > 0").orderBy(F.desc("n_kind"), F.desc("n_last_30d"), "suburb").limit(min(max(limit, 1), 200))


def trend_stats(apps: DataFrame, suburb: str | None = None, date_from: datetime.date | None = None, date_to: datetime.date | None = None) -> DataFrame:
    """Per month of lodgement: counts by kind filter (they overlap), exactly approved ones, and all."""
    df = apps.where("lodged_date is not null")
    df = df.where(F.upper("suburb") == suburb.upper()) if suburb else df
    df = df.where(F.col("lodged_date") >= F.lit(date_from)) if date_from else df
    df = df.where(F.col("lodged_date") <= F.lit(date_to)) if date_to else df
    kinds = [count_where(kind_predicate(k, F.col("description"), F.col("approved_units")), f"n_{k}") for k in ("granny", "duplex", "big_dev", "other")]
    return df.groupBy(F.trunc("lodged_date", "month").alias("bucket_start")).agg(*kinds, count_where(is_approved_exactly(F.col("decision_outcome")), "n_approved"), F.count(F.lit(1)).alias("n_total"))


def approved_share(trends: DataFrame) -> DataFrame:
    return trends.select("bucket_start", F.when(F.col("n_total") > 0, F.col("n_approved") / F.col("n_total") * 100).otherwise(0.0).alias("approved_pct"))


def entities_by_role(links: DataFrame, companies: DataFrame) -> DataFrame:
    """Per application the greatest name (and more for the applicant) of each role, each attribute by itself."""
    df = links.join(companies.select(F.col("id").alias("company_id"), "display_name", "acn", "entity_type"), "company_id", "left")
    top = lambda role, col, name: F.max(F.when(F.col("role") == role, F.col(col))).alias(name)
    names = [top(r, "display_name", f"{n}_name") for r, n in (("applicant", "applicant"), ("agent", "applicant_agent"), ("builder", "builder"), ("architect", "architect"), ("owner", "owner"))]
    return df.groupBy("application_id").agg(*names, top("applicant", "acn", "applicant_acn"), top("applicant", "entity_type", "applicant_entity_type"), top("applicant", "company_id", "applicant_company_id"))


def docs_rollup(docs: DataFrame) -> DataFrame:
    """Per application: documents, bytes, information requests and amendments by stage."""
    kind = doc_kind(F.col("doc_type"))
    return docs.groupBy("application_id").agg(
        F.count(F.lit(1)).alias("n_docs"), F.coalesce(F.sum("file_size"), F.lit(0)).alias("total_bytes"),
        count_where(kind.isin("ir_council", "ir_response"), "n_info_requests"), count_where(kind.isin("amendment", "further_info"), "n_amendments"),
    )


def process_stats(docs: DataFrame) -> DataFrame:
    """The older rollup by words of the document type; first and last day over downloaded documents only."""
    t, have = F.lower("doc_type"), F.col("file_path").isNotNull()
    return docs.groupBy("application_id").agg(
        F.count(F.lit(1)).alias("n_docs"), count_where(have, "n_downloaded"), F.coalesce(F.sum("file_size"), F.lit(0)).alias("total_bytes"),
        count_where(t.contains("information request"), "n_information_requests"), count_where(t.contains("amended"), "n_amendments"), count_where(t.contains("specialist"), "n_specialist"),
        F.min(F.when(have, F.to_date("published_at"))).alias("first_doc"), F.max(F.when(have, F.to_date("published_at"))).alias("last_doc"),
    )


def developer_counts(links: DataFrame) -> DataFrame:
    """Applications per company in the applicant role, over all links."""
    return links.where("role = 'applicant' and company_id is not null").groupBy("company_id").agg(F.count_distinct("application_id").alias("n_projects"))


def current_rates(rates: DataFrame, anchor: str = "FILRHLBVD") -> DataFrame:
    """One row: each series at the anchor series' latest month."""
    latest = rates.where(F.col("series_id") == anchor).agg(F.max("month").alias("month"))
    series = {"FILRHLBVD": "variable_oo_pct", "FILRHLBVDI": "variable_inv_pct", "FILRHL3YF": "fixed_3yr_oo_pct", "FILRHL3YFI": "fixed_3yr_inv_pct"}
    return rates.join(latest, "month").agg(F.max("month").alias("as_of_month"), *[F.max(F.when(F.col("series_id") == s, F.col("rate_pct"))).alias(n) for s, n in series.items()])


def latest_rate(rates: DataFrame, order: tuple[str, ...] = ("FILRHLBVD", "FILRHL3YF", "FILRHLBVS")) -> DataFrame:
    """One row: the newest rate, series earlier in `order` first."""
    place = F.array_position(F.array(*map(F.lit, order)), F.col("series_id"))
    return rates.where(F.col("series_id").isin(*order)).agg(F.max_by("rate_pct", F.struct("month", -place)).alias("rate_pct"))


def status_counts(apps: DataFrame, docs: DataFrame) -> DataFrame:
    a = apps.agg(F.count(F.lit(1)).alias("apps_total"), F.count("detail_fetched_at").alias("apps_with_detail"))
    d = docs.agg(F.count(F.lit(1)).alias("docs_total"), F.count("file_path").alias("docs_downloaded"), F.coalesce(F.sum("file_size"), F.lit(0)).alias("docs_total_bytes"))
    return a.select("*", *[d.select(c).scalar().alias(c) for c in d.columns])


def per_council(apps: DataFrame) -> DataFrame:
    """Applications per council and vendor, with the first and last day of lodgement."""
    return apps.groupBy("council_slug", "vendor").agg(F.count(F.lit(1)).alias("n"), F.min("lodged_date").alias("first_lodged"), F.max("lodged_date").alias("last_lodged"))


def modal_value(df: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    """The most frequent value per group, of equally frequent ones the least."""
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy(*keys).agg(F.min_by(F.col(value), F.struct((-F.col("n")).alias("n"), F.col(value))).alias(name), F.max("n").alias("n"))


def priority_merge(rows: DataFrame, fields: dict[str, list[str]], position: str = "doc_position", doc: str = "document_id") -> DataFrame:
    """One row per application: per field the first usable value in its own order of positions, and its document.

    Null, '' and 'unknown' are not usable; within a position the smallest document decides.
    """
    out = []
    for name, order in fields.items():
        rank = F.array_position(F.array(*map(F.lit, order)), F.col(position))
        usable = F.when((F.col(name) != "") & (F.col(name) != "unknown") & (rank > 0), F.struct(rank.alias("rank"), F.col(doc).alias("doc"), F.col(name).alias("value")))
        out.append(F.min(usable).alias(f"_{name}"))
    merged = rows.groupBy("application_id").agg(*out)
    return merged.select("application_id", *[c for n in fields for c in (F.col(f"_{n}.value").alias(n), F.col(f"_{n}.doc").alias(f"{n}_doc"))])


def longest_in_priority(rows: DataFrame, text: str, order: list[str], cut: int = 1000, position: str = "doc_position", doc: str = "document_id") -> DataFrame:
    """Per application the longest text of the first position that has any, cut to `cut` characters."""
    rank = F.array_position(F.array(*map(F.lit, order)), F.col(position))
    best = F.min(F.when((F.col(text) != "") & (rank > 0), F.struct(rank.alias("rank"), (-F.length(text)).alias("size"), F.col(doc).alias("doc"), F.col(text).alias("value"))))
    return rows.groupBy("application_id").agg(best.alias("_b")).select("application_id", F.left(F.col("_b.value"), F.lit(cut)).alias(text))


def collapse_duplicates(parent: DataFrame, children: DataFrame, natural: list[str], fk: str) -> tuple[DataFrame, DataFrame]:
    """Parents reduced to the greatest id per natural key, and children re-pointed at them."""
    keeper = parent.groupBy(*natural).agg(F.max("id").alias("_keep"))
    ids = parent.select(F.col("id").alias(fk), *natural).join(keeper, natural).select(fk, "_keep")
    kept = parent.join(keeper.select(F.col("_keep").alias("id")), "id", "left_semi")
    moved = children.join(ids, fk, "left").withColumn(fk, F.coalesce("_keep", fk)).drop("_keep")
    return kept, moved


def house_and_units(properties: DataFrame, applications: DataFrame, key: str = "match_key") -> DataFrame:
    """match_key, n_parent, n_units of lots with a parent row and a unit row that no application stands for yet."""
    per = properties.groupBy(key).agg(count_where(F.col("unit_number") == "", "n_parent"), count_where(F.col("unit_number") != "", "n_units"))
    return per.where("n_parent > 0 and n_units > 0").join(applications.select(key).distinct(), key, "left_anti")


def analysis_candidates(apps: DataFrame, docs: DataFrame, done: DataFrame) -> DataFrame:
    """Applications with a plan and a supporting document that are not summarised yet, with how rich they are."""
    t = F.lower("doc_type")
    per = docs.groupBy(F.col("application_id").alias("id")).agg(count_where(t.contains("plan"), "n_plans"), count_where(t.contains("specialist") | t.contains("form"), "n_supporting"), F.count(F.lit(1)).alias("n_docs"))
    per = per.where("n_plans > 0 and n_supporting > 0").join(done.select(F.col("application_id").alias("id")), "id", "left_anti")
    return apps.select("id", "lodged_date").join(per, "id").withColumn("richness", F.col("n_plans") + F.col("n_supporting"))


def kind_counts(apps: DataFrame) -> DataFrame:
    return apps.groupBy(classify_kind(F.col("description"), F.col("approved_units")).alias("kind")).agg(F.count(F.lit(1)).alias("n"))


def doc_text_features(pages: DataFrame) -> DataFrame:
    """Per document: pages, characters, and mean characters a page by whole-number division."""
    return pages.groupBy("doc_id").agg(F.count(F.lit(1)).alias("page_count"), F.sum(F.length("text")).alias("total_chars")).withColumn("mean_chars", F.expr("total_chars div page_count"))

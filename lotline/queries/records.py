"""Queries over documents, pages, events and keyed writes, with their SQL twins."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotline.functions import entities as E
from lotline.functions import text as T
from lotline.functions import urls as U
from lotline.functions.classify import da_status, doc_kind, is_approved, target_kind_predicate, treatment
from lotline.functions.hashing import page_hashes as hash_columns
from lotline.operators import ordered as O
from lotline.operators import quality as Q
from lotline.operators import spine as S
from lotline.operators import writes as W
from lotline.operators.joins import asof_prev, overlap_join, remap_fk
from lotline.operators.rollups import collapse_duplicates
from lotline.plans import companies as P
from lotline.sources import pages as G
from lotline.sources.adapters import tables, twin

DOC_KIND_SQL = "case doc_type when 'DA Form 1' then 'submission' when 'Plans' then 'submission' when 'Information Request' then 'ir_council' when 'Response to IR Cover Letter' then 'ir_response' when 'Amended Plans' then 'amendment' when 'Specialist Reports' then 'submission' else 'decision' end"
PAGES_SQL = "pg as (select doc_id, p as page, substr(text, (p - 1) * 400 + 1, 400) as text from (select doc_id, text, unnest(range(1, cast(ceil(length(text) / 400) as bigint) + 1)) as p from documents where text <> ''))"


def one(spark: SparkSession, d: str, name: str) -> DataFrame:
    return tables(spark, d, name)[name]


def token_fingerprints(spark: SparkSession, d: str) -> DataFrame:
    return E.fingerprints(one(spark, d, "documents").where("text is not null"), ["doc_id"])


def token_places(spark: SparkSession, d: str) -> DataFrame:
    """The first place of every token in whole texts."""
    return E.fingerprint_spans(one(spark, d, "documents").where("text is not null"), ["doc_id"]).where("kind in ('email', 'phone')")


def page_fingerprints(spark: SparkSession, d: str) -> DataFrame:
    """Links and e-mail addresses in whole web pages."""
    return E.fingerprints(one(spark, d, "pages").where("html is not null"), ["page_id"], "html").groupBy("kind", "normalized_value").agg(F.count(F.lit(1)).alias("n_pages"))


def document_stages(spark: SparkSession, d: str) -> DataFrame:
    return one(spark, d, "documents_meta").groupBy("doc_type", doc_kind(F.col("doc_type")).alias("doc_kind")).agg(F.count(F.lit(1)).alias("n"))


def text_treatment(spark: SparkSession, d: str) -> DataFrame:
    f = G.text_features(G.doc_pages(one(spark, d, "documents")))
    return f.withColumn("treatment", treatment(F.lit(0), F.col("total_chars"), F.col("page_count"), F.col("mean_chars")))


def page_chunks(spark: SparkSession, d: str) -> DataFrame:
    out = G.chunk_pages(G.doc_pages(one(spark, d, "documents")))
    return out.select("doc_id", "chunk_index", "page_start", "page_end", F.length("text").alias("n"))


def packed_paragraphs(spark: SparkSession, d: str) -> DataFrame:
    rows = one(spark, d, "documents").where("text is not null").select("doc_id", F.posexplode(G.pack_paragraphs(F.col("text"))).alias("page", "text"))
    return rows.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_pages"), F.sum(F.length("text") + 1).alias("n_chars"))


def picked_pages(spark: SparkSession, d: str) -> DataFrame:
    return one(spark, d, "documents_meta").select("id", F.array_join(F.transform(G.pick_pages(F.col("doc_type"), F.pmod("id", F.lit(12)).cast("int")), lambda x: x.cast("string")), ",").alias("pages"))


def name_rules(spark: SparkSession, d: str) -> DataFrame:
    """Rejections by rule over the words of all documents as candidate names."""
    words = one(spark, d, "documents").where("text is not null").select("doc_id", F.explode(F.array_distinct(F.split("text", " "))).alias("candidate_name"))
    rows = E.filter_entities(words.withColumn("status", F.lit("predicted")), "v1")
    return rows.where("rule is not null").groupBy("rule").agg(F.count(F.lit(1)).alias("n"))


def first_last_docs(spark: SparkSession, d: str) -> DataFrame:
    return O.first_last_docs(one(spark, d, "documents_meta"))


def tier2_docs(spark: SparkSession, d: str) -> DataFrame:
    t = tables(spark, d, "documents_meta", "doc_summaries")
    return O.tier2_docs(t["documents_meta"], t["doc_summaries"].where("builder_name is null"), 2).select("application_id", "id", "doc_type")


def downloads(spark: SparkSession, d: str) -> DataFrame:
    return O.select_downloads(one(spark, d, "documents_meta"), ["Plans", "DA Form 1", "Decision Notice"], 50_000).select("application_id", "id")


def error_streaks(spark: SparkSession, d: str) -> DataFrame:
    ev = one(spark, d, "events")
    return O.failure_streaks(ev, ["user_id"], ["ts", "event_id"], F.col("event_type") == "error", 3).select("user_id", "event_id")


def page_ranges(spark: SparkSession, d: str) -> DataFrame:
    return O.format_ranges(one(spark, d, "lineitem"), ["l_orderkey"], "l_linenumber")


def entity_timeline(spark: SparkSession, d: str) -> DataFrame:
    t = tables(spark, d, "application_entities", "documents_meta")
    return O.entity_timeline(t["application_entities"], t["documents_meta"], doc_kind(F.col("doc_type")))


def stage_recall(spark: SparkSession, d: str) -> DataFrame:
    t = tables(spark, d, "application_entities", "documents_meta")
    return O.stage_recall(t["application_entities"].where("role = 'applicant'"), t["documents_meta"], doc_kind(F.col("doc_type")))


def primary_links(spark: SparkSession, d: str) -> DataFrame:
    return O.mark_primary(one(spark, d, "application_entities")).where("is_primary").select("source_doc_id", "company_id")


def events_dedupe(spark: SparkSession, d: str) -> DataFrame:
    return O.dedupe_window(one(spark, d, "events"), ["user_id", "event_type"], "ts", 24)


def last_purchase(spark: SparkSession, d: str) -> DataFrame:
    ev = one(spark, d, "events")
    buys = ev.where("event_type = 'purchase'").select("user_id", F.col("ts").alias("buy_ts"), F.col("event_id").alias("buy_id"), F.col("value").alias("buy_value"))
    return asof_prev(ev.select("event_id", "user_id", "ts"), buys, ["user_id"], ["event_id"], "ts", "buy_ts", "buy_id", ["buy_id", "buy_value"])


def address_keys(spark: SparkSession, d: str) -> DataFrame:
    a = T.normalize_address(F.expr("substring_index(display_address, ',', 1)"), F.col("suburb"), F.lit("4220"))
    return one(spark, d, "domain_properties").select("id", a.alias("a")).select("id", "a.unit_number", "a.street_number", "a.street_norm", "a.match_key")


def council_addresses(spark: SparkSession, d: str) -> DataFrame:
    raw = F.concat("lot_on_plan", F.lit(", "), "street_address", F.lit(", PALM BEACH QLD 4221"))
    return one(spark, d, "applications").select("id", T.split_council_address(raw).alias("a"), T.repair_street_address(raw, F.expr("concat(regexp_replace(street_address, '^[0-9]+ ', ''), ', Palm Beach, QLD 4221')")).alias("repaired")).select("id", "a.*", "repaired")


def stated_units(spark: SparkSession, d: str) -> DataFrame:
    return one(spark, d, "applications").select("id", T.approved_units(F.col("description")).alias("units"), da_status(F.col("decision_outcome"), F.lit("Withdrawn")).alias("da_status"), is_approved(F.col("decision_outcome")).alias("approved"), F.coalesce(target_kind_predicate("redev", F.col("description")), F.lit(False)).alias("redev"))


def listing_prices(spark: SparkSession, d: str) -> DataFrame:
    text = F.concat(F.lit("Offers $"), (F.col("p_partkey") % 900 + 100).cast("string"), F.lit(",000 - $1."), (F.col("p_partkey") % 9).cast("string"), F.lit("m"))
    return one(spark, d, "part").select("p_partkey", T.price_range(text).alias("p"), T.price_first(text).alias("first"), T.is_rental(F.when(F.col("p_size") % 2 == 0, "$500 per week").otherwise(text)).alias("rental")).select("p_partkey", "p.*", "first", "rental")


def company_names(spark: SparkSession, d: str) -> DataFrame:
    return one(spark, d, "companies").select("id", T.company_norm(F.col("display_name")).alias("norm_name"), T.digits_of(F.col("acn"), 9).alias("acn9"))


def resolved_companies(spark: SparkSession, d: str) -> DataFrame:
    c = one(spark, d, "companies")
    m = c.select(F.col("id").alias("mention_id"), F.upper("display_name").alias("name"), F.when(F.col("id") % 2 == 0, F.col("acn")).alias("acn"))
    found, every = P.resolve_companies(m, c.where("id % 5 <> 0"))
    new = every.where("id < 0").select(F.col("id").alias("company_id"), F.col("display_name").alias("new_name"), F.col("acn").alias("new_acn"))
    return found.select("mention_id", "company_id").join(new, "company_id", "left").select("mention_id", F.when(F.col("company_id") >= 0, F.col("company_id")).alias("company_id"), "new_name", "new_acn")


def enriched_companies(spark: SparkSession, d: str) -> DataFrame:
    c = one(spark, d, "companies")
    registry = c.select(F.coalesce("acn", F.lpad(F.col("id").cast("string"), 9, "9")).alias("acn"), F.initcap(F.lower("display_name")).alias("name"), F.lit("Registered").alias("status")).where("id % 2 = 0")
    return P.enrich_companies(c, registry)


def url_kinds(spark: SparkSession, d: str) -> DataFrame:
    return one(spark, d, "pages").select("page_id", U.classify_url(F.col("url")).alias("kind"), U.clean_url(F.col("url")).alias("clean"), U.host(F.col("url")).alias("host"), U.is_third_party(F.col("url")).alias("third_party"), U.website_score(F.col("url"), F.lit("Thth Homes"), F.lit("builder")).alias("score"))


def json_listings(spark: SparkSession, d: str) -> DataFrame:
    return G.parse_listings(one(spark, d, "json_pages"))


def page_hashes(spark: SparkSession, d: str) -> DataFrame:
    return one(spark, d, "pages").select("page_id", *hash_columns(F.col("url"), F.col("html")))


def span_overlaps(spark: SparkSession, d: str) -> DataFrame:
    """Order-level spans: line items as words, quantities as character spans."""
    rows = one(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_quantity").cast("long").alias("a"), (F.col("l_quantity") + F.col("l_linenumber")).cast("long").alias("b")).distinct()
    left = rows.where("l_linenumber <= 2").select("l_orderkey", F.col("l_linenumber").alias("n1"), F.col("a").alias("a1"), F.col("b").alias("b1"))
    right = rows.where("l_linenumber > 2").select("l_orderkey", F.col("l_linenumber").alias("n2"), F.col("a").alias("a2"), F.col("b").alias("b2"))
    return overlap_join(left, right, ["l_orderkey"], ("a1", "b1"), ("a2", "b2"))


def halves(spark: SparkSession, d: str) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    t = tables(spark, d, "customer", "orders")
    c = t["customer"].select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"), F.col("c_acctbal").alias("balance"))
    o = t["orders"].select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("customer_id"), F.concat(F.lit("O"), F.col("o_orderkey").cast("string")).alias("natural_key"))
    a = {"customers": c.where("id % 3 <> 0"), "orders": o.where("id % 3 <> 0")}
    b = {"customers": c.where("id % 3 <> 1").withColumn("id", F.col("id") + 10_000_000), "orders": o.where("id % 3 <> 1").withColumns({"id": F.col("id") + 10_000_000, "customer_id": F.col("customer_id") + 10_000_000})}
    return a, b


def upserted_customers(spark: SparkSession, d: str) -> DataFrame:
    a, b = halves(spark, d)
    return W.upsert(b["customers"], a["customers"].withColumns({"segment": F.when(F.col("id") % 2 == 0, F.lower("segment")), "balance": -F.col("balance")}), ["name"], preserve=("id",), fill=("segment",))


def patched_customers(spark: SparkSession, d: str) -> DataFrame:
    a, b = halves(spark, d)
    return W.patch_update(b["customers"], a["customers"].withColumn("segment", F.when(F.col("id") % 2 == 0, "")), ["name"], ["segment"], ["balance"])


STORE = [("customers", ["name"], {}), ("orders", ["natural_key"], {"customer_id": "customers"})]


def merged_stores(spark: SparkSession, d: str) -> DataFrame:
    a, b = halves(spark, d)
    slim = lambda s: {"customers": s["customers"].select("id", "name"), "orders": s["orders"]}
    return P.merge_stores(slim(a), slim(b), STORE, 20_000_000)["orders"]


def remapped_orders(spark: SparkSession, d: str) -> DataFrame:
    a, b = halves(spark, d)
    return remap_fk(a["orders"], a["customers"], b["customers"], ["name"], "customer_id", True)


def replaced_children(spark: SparkSession, d: str) -> DataFrame:
    o = one(spark, d, "orders").select("o_custkey", "o_orderkey")
    return W.replace_children(o, o.where("o_custkey % 10 = 0 and o_orderkey % 2 = 0"), "o_custkey")


def missing_customers(spark: SparkSession, d: str) -> DataFrame:
    a, b = halves(spark, d)
    return Q.missing_keys(a["customers"], b["customers"], ["name"])


#: Child table, its key, and the parent table of every reference among the given tables' entities.
FOREIGN_KEYS = [
    ("domain_sales", "domain_property_id", "domain_properties"), ("realestate_sales", "realestate_property_id", "realestate_properties"), ("application_entities", "company_id", "companies"), ("application_entities", "application_id", "applications"),
    ("application_entities", "source_doc_id", "documents_meta"), ("documents_meta", "application_id", "applications"), ("doc_summaries", "application_id", "applications"), ("doc_summaries", "document_id", "documents_meta"), ("build_features", "application_id", "applications"),
]


def fk_report(spark: SparkSession, d: str) -> DataFrame:
    """Every reference, with some applications and companies taken away so that not all of them hold."""
    t = tables(spark, d, *{x for c, _, p in FOREIGN_KEYS for x in (c, p)})
    t["applications"], t["companies"] = t["applications"].where("id % 101 <> 0"), t["companies"].where("id % 7 <> 3")
    return Q.fk_report(t, [(c, k, p, "id") for c, k, p in FOREIGN_KEYS])


def store_cardinality(spark: SparkSession, d: str) -> DataFrame:
    a, b = halves(spark, d)
    return Q.cardinality_report({k: (a[k], b[k]) for k in ("customers", "orders")})


def collapsed_lots(spark: SparkSession, d: str) -> DataFrame:
    t = tables(spark, d, "domain_properties", "domain_sales")
    _, moved = collapse_duplicates(t["domain_properties"], t["domain_sales"], ["street_number", "street_name", "suburb"], "domain_property_id")
    return moved.groupBy("domain_property_id").agg(F.count(F.lit(1)).alias("n_sales"))


def month_coverage(spark: SparkSession, d: str) -> DataFrame:
    t = tables(spark, d, "windows", "applications")
    spine = S.month_spine(spark, datetime.date(1994, 11, 5), datetime.date(2001, 12, 1))
    return S.month_coverage(spine, t["windows"].withColumn("date_to", F.last_day("date_to")), t["applications"])


def window_times(spark: SparkSession, d: str) -> DataFrame:
    return S.scrape_windows(one(spark, d, "windows"), datetime.datetime(2002, 1, 1)).select("slug", "date_from", "status", "elapsed_s")


QUERIES = {
    f.__name__: f
    for f in (
        token_fingerprints, token_places, page_fingerprints, document_stages, text_treatment, page_chunks, packed_paragraphs, picked_pages, name_rules, first_last_docs, tier2_docs, downloads, error_streaks, page_ranges,
        entity_timeline, stage_recall, primary_links, events_dedupe, last_purchase, address_keys, council_addresses, stated_units, listing_prices, company_names, resolved_companies, enriched_companies,
        url_kinds, json_listings, page_hashes, span_overlaps, upserted_customers, patched_customers, merged_stores, remapped_orders, replaced_children, missing_customers, fk_report, store_cardinality,
        collapsed_lots, month_coverage, window_times,
    )
}

A_SQL = "a as (select c_custkey as id, c_name as name, c_mktsegment as segment, c_acctbal as balance from customer where c_custkey % 3 <> 0), b as (select c_custkey + 10000000 as id, c_name as name, c_mktsegment as segment, c_acctbal as balance from customer where c_custkey % 3 <> 1), ao as (select o_orderkey as id, o_custkey as customer_id, 'O' || o_orderkey as natural_key from orders where o_orderkey % 3 <> 0), bo as (select o_orderkey + 10000000 as id, o_custkey + 10000000 as customer_id, 'O' || o_orderkey as natural_key from orders where o_orderkey % 3 <> 1)"



#: The parents that fk_report takes rows away from.
LESS = {"applications": "apps_", "companies": "companies_"}
FEWER = "with apps_ as (select * from applications where id % 101 <> 0), companies_ as (select * from companies where id % 7 <> 3) "


def fingerprints_sql(table: str, key: str, text: str) -> str:
    """Every kind's matches, normalised, each once per row."""
    digits = "regexp_replace(v, '[^0-9]', '', 'g')"
    value = {"url": "regexp_replace(lower(v), '^www\\.', '')", "email": "lower(v)", "phone": digits, "acn": digits, "abn": digits}
    ignored = ", ".join(f"'{h}'" for h in E.IGNORED_HOSTS)
    keep = {"url": f"n not in ({ignored})", "email": f"split_part(n, '@', 2) not in ({ignored})", "phone": "length(n) >= 8", "acn": "length(n) = 9", "abn": "length(n) = 11"}
    parts = []
    for kind, (pattern, group) in E.PATTERNS.items():
        found = f"select {key}, unnest(regexp_extract_all({text}, '{pattern}', {group})) as v from {table}"
        normal = value.get(kind, "upper(regexp_replace(v, '\\s+', '', 'g'))")
        kept = keep.get(kind, "regexp_matches(n, '[0-9]')")
        parts.append(f"select distinct {key}, '{kind}' as kind, n as normalized_value from (select {key}, {normal} as n from ({found})) where {kept}")
    return " union all ".join(parts)


ORACLE_SQL = {
    "token_fingerprints": fingerprints_sql("documents", "doc_id", "text"),
    "page_fingerprints": f"select kind, normalized_value, count(*) as n_pages from ({fingerprints_sql('pages', 'page_id', 'html')}) group by 1, 2",
    "enriched_companies": "select s_suppkey as id, case when s_suppkey % 2 = 0 then coalesce(acn, lpad(cast(s_suppkey as varchar), 9, '9')) else acn end as acn, case when s_suppkey % 2 = 0 then 'Supplier' || substr(display_name, 9, 10) || case s_suppkey % 3 when 0 then ' Pty Ltd' when 1 then ' Pty. Limited' else '' end else display_name end as display_name, case when s_suppkey % 2 = 0 then 'Registered' end as registry_status from (select s_suppkey, case when s_suppkey % 3 = 0 then null else lpad(cast(s_suppkey as varchar), 9, '0') end as acn, s_name || case s_suppkey % 3 when 0 then ' PTY LTD' when 1 then ' Pty. Limited' else '' end as display_name from supplier)",
    "document_stages": twin(f"select doc_type, {DOC_KIND_SQL} as doc_kind, count(*) as n from documents_meta group by 1, 2", "documents_meta"),
    "text_treatment": f"with {PAGES_SQL}, f as (select doc_id, count(*) as page_count, cast(sum(length(text)) as bigint) as total_chars from pg group by 1) select *, total_chars // page_count as mean_chars, case when total_chars < 200 then 'image_only' when page_count = 1 and total_chars // page_count < 1500 then 'titleblock' when page_count >= 6 and total_chars // page_count >= 1500 then 'narrative_long' else 'narrative_short' end as treatment from f",
    "picked_pages": twin("select id, array_to_string(case when doc_type = 'Decision Notice' then list_sort(list_distinct(list_concat(range(0, least(3, n)), range(greatest(n - 2, 0), n)))) when doc_type = 'Specialist Reports' then range(0, least(8, n)) when doc_type = 'Plans' then [0] when doc_type in ('DA Form 1', 'Amended Plans') then range(0, least(6, n)) else list_concat(range(0, least(5, n)), case when n > 6 then [n - 1] else [] end) end, ',') as pages from (select *, greatest(id % 12, 1) as n from documents_meta)", "documents_meta"),
    "first_last_docs": twin("with h as (select application_id, id, row_number() over (partition by application_id order by published_at is null, published_at, id) as a, row_number() over (partition by application_id order by published_at is null, published_at desc, id desc) as b from documents_meta where file_path is not null) select application_id, id, 'first' as position from h where a = 1 union all select application_id, id, 'last' from h where b = 1 and a <> 1", "documents_meta"),
    "tier2_docs": twin("select application_id, id, doc_type from (select *, row_number() over (partition by application_id order by case doc_type when 'Specialist Reports' then 1 else 3 end, published_at nulls first, id) as r from documents_meta where file_path is not null and doc_type in ('Specialist Reports', 'Plans') and id not in (select document_id from doc_summaries where builder_name is null)) where r <= 2", "documents_meta", "doc_summaries"),
    "downloads": twin("select application_id, id from (select *, row_number() over (partition by application_id order by published_at nulls last, id) as a, row_number() over (partition by application_id order by published_at desc nulls first, id desc) as b from documents_meta) where (a = 1 or b = 1) and doc_type in ('Plans', 'DA Form 1', 'Decision Notice') and file_size <= 50000", "documents_meta"),
    "error_streaks": "with e as (select *, sum(case when event_type = 'error' then 0 else 1 end) over (partition by user_id order by ts, event_id) as island from events), r as (select *, count(*) over (partition by user_id, island order by ts, event_id) - case when island = 0 then 0 else 1 end as run from e) select user_id, event_id from (select *, row_number() over (partition by user_id order by ts, event_id) as n from r where event_type = 'error' and run = 3) where n = 1",
    "page_ranges": "with r as (select distinct l_orderkey, l_linenumber as p from lineitem), i as (select *, p - row_number() over (partition by l_orderkey order by p) as g from r), s as (select l_orderkey, g, min(p) as a, max(p) as b from i group by 1, 2) select l_orderkey, string_agg(case when a = b then cast(a as varchar) else a || '-' || b end, ',' order by a) as ranges from s group by 1",
    "entity_timeline": twin(f"with r as (select e.application_id, {DOC_KIND_SQL} as stage, role, company_id, min(source_doc_id) as doc from application_entities e join documents_meta m on m.id = e.source_doc_id group by 1, 2, 3, 4) select application_id, stage, role, company_id, row_number() over (partition by application_id, company_id order by case stage when 'submission' then 1 when 'amendment' then 2 when 'ir_council' then 3 when 'ir_response' then 4 when 'further_info' then 5 when 'decision' then 6 else 7 end, doc, role) = 1 as is_new from r", "application_entities", "documents_meta"),
    "stage_recall": twin(f"select {DOC_KIND_SQL} as stage, count(*) as n_docs, count(*) filter (where id in (select source_doc_id from application_entities where role = 'applicant')) as n_with_entities from documents_meta group by 1", "application_entities", "documents_meta"),
    "primary_links": twin("select source_doc_id, min(company_id) as company_id from application_entities where role = 'applicant' group by 1", "application_entities"),
    "last_purchase": "select e.event_id, max_by(b.event_id, (b.ts, b.event_id)) as buy_id, max_by(b.value, (b.ts, b.event_id)) as buy_value from events e join events b on b.user_id = e.user_id and b.event_type = 'purchase' and b.ts < e.ts group by 1",
    "address_keys": twin("select id, unit_number, street_number, norm as street_norm, street_number || '|' || norm || '|' || lower(suburb) || '|4220' as match_key from (select *, case street_name when 'Oak' then 'oak st' when 'Elm' then 'elm pde' when 'Sea' then 'sea view rd' else 'hill ct' end as norm from domain_properties)", "domain_properties"),
    "council_addresses": twin("select id, street_address as street, 'Palm Beach' as suburb, '4221' as postcode, 'QLD' as state, street_address || ', Palm Beach QLD 4221' as repaired from applications", "applications"),
    "stated_units": twin("select id, case id % 9 when 0 then 2 when 2 then 3 when 3 then 4 when 6 then 6 when 7 then 2 end as units, case when lower(decision_outcome) like '%approv%' then 'approved' when lower(decision_outcome) like '%refus%' then 'refused' else 'withdrawn' end as da_status, coalesce(lower(decision_outcome) like '%approv%', false) as approved, coalesce(id % 9 in (0, 2, 4, 6, 7) and description is not null, false) as redev from applications", "applications"),
    "listing_prices": "select p_partkey, least((p_partkey % 900 + 100) * 1000, cast(floor((1 + (p_partkey % 9) / 10.0) * 1000000) as bigint)) as low, greatest((p_partkey % 900 + 100) * 1000, cast(floor((1 + (p_partkey % 9) / 10.0) * 1000000) as bigint)) as high, (p_partkey % 900 + 100) * 1000 as first, p_size % 2 = 0 as rental from part",
    "company_names": "select s_suppkey as id, lower(s_name) as norm_name, case when s_suppkey % 3 = 0 then null else lpad(cast(s_suppkey as varchar), 9, '0') end as acn9 from supplier",
    "resolved_companies": twin("select id as mention_id, case when id % 5 <> 0 then id end as company_id, case when id % 5 = 0 then upper(display_name) end as new_name, case when id % 5 = 0 and id % 2 = 0 then acn end as new_acn from companies", "companies"),
    "json_listings": twin("select page_id, cast(page_id as varchar) as listing_id, 'sold' as listing_type, '$' || (page_id % 90 + 10) || ',000' as price_text, (page_id % 90 + 10) * 1000 as price_low, (page_id % 90 + 10) * 1000 as price_high, cast(page_id % 6 as int) as beds from pages"),
    "page_hashes": "select page_id, sha256(url) as url_hash, sha256(html) as content_hash from pages",
    "span_overlaps": "with r as (select distinct l_orderkey, l_linenumber, cast(floor(l_quantity) as bigint) as a, cast(floor(l_quantity + l_linenumber) as bigint) as b from lineitem) select x.l_orderkey, x.l_linenumber as n1, x.a as a1, x.b as b1, y.l_linenumber as n2, y.a as a2, y.b as b2 from r x join r y on x.l_orderkey = y.l_orderkey where x.l_linenumber <= 2 and y.l_linenumber > 2 and x.a < y.b and y.a < x.b",
    "upserted_customers": f"with {A_SQL} select coalesce(b.id, a.id) as id, coalesce(b.name, a.name) as name, case when a.id is null then b.segment when b.id is null then case when a.id % 2 = 0 then lower(a.segment) end else coalesce(case when a.id % 2 = 0 then lower(a.segment) end, b.segment) end as segment, case when a.id is null then b.balance else -a.balance end as balance from b full join a on a.name = b.name",
    "patched_customers": f"with {A_SQL} select b.id, b.name, b.segment, coalesce(a.balance, b.balance) as balance from b left join a on a.name = b.name",
    "merged_stores": f"with {A_SQL}, c as (select id, name from b union all select id + 20000000, name from a where name not in (select name from b)) select * from bo union all select ao.id + 20000000, c.id, ao.natural_key from ao join a on a.id = ao.customer_id join c on c.name = a.name where ao.natural_key not in (select natural_key from bo)",
    "remapped_orders": f"with {A_SQL} select ao.id, b.id as customer_id, ao.natural_key from ao join a on a.id = ao.customer_id join b on b.name = a.name",
    "replaced_children": "select o_custkey, o_orderkey from orders where o_custkey not in (select o_custkey from orders where o_custkey % 10 = 0 and o_orderkey % 2 = 0) union all select o_custkey, o_orderkey from orders where o_custkey % 10 = 0 and o_orderkey % 2 = 0",
    "missing_customers": f"with {A_SQL} select name from a except select name from b",
    "fk_report": twin(FEWER + " union all ".join(f"select '{c}' as child, '{k}' as fk, '{p}' as parent, count(*) as total, count({k}) as non_null, count(*) filter (where {k} not in (select id from {LESS.get(p, p)})) as dangling, min(cast({k} as varchar)) filter (where {k} not in (select id from {LESS.get(p, p)})) as sample from {c}" for c, k, p in FOREIGN_KEYS), *sorted({x for c, _, p in FOREIGN_KEYS for x in (c, p)})),
    "store_cardinality": f"with {A_SQL} select *, n_b >= n_a as ok from (select 'customers' as name, (select count(*) from a) as n_a, (select count(*) from b) as n_b union all select 'orders', (select count(*) from ao), (select count(*) from bo))",
    "collapsed_lots": twin("with k as (select id, max(id) over (partition by street_number, street_name, suburb) as keep from domain_properties) select coalesce(keep, domain_property_id) as domain_property_id, count(*) as n_sales from domain_sales left join k on k.id = domain_property_id group by 1", "domain_properties", "domain_sales"),
    "month_coverage": twin("with m as (select cast(x as date) as date_from, last_day(cast(x as date)) as date_to from (select unnest(generate_series(timestamp '1994-11-01', timestamp '2001-12-01', interval 1 month)) as x)), w as (select date_from, last_day(date_to) as date_to, max_by(status, case status when 'completed' then 4 when 'running' then 3 when 'failed' then 2 else 1 end) as status from windows group by 1, 2), c as (select cast(date_trunc('month', lodged_date) as date) as date_from, count(*) as apps, count(detail_fetched_at) as detail from applications group by 1) select m.date_from, m.date_to, coalesce(status, 'pending') as status, coalesce(apps, 0) as apps, coalesce(detail, 0) as detail from m left join w using (date_from, date_to) left join c on c.date_from = m.date_from", "windows", "applications"),
    "window_times": twin("select slug, date_from, status, date_diff('second', started_at, coalesce(finished_at, timestamp '2002-01-01')) as elapsed_s from windows", "windows"),
    "page_chunks": f"with {PAGES_SQL}, l as (select doc_id, list(text order by page) as ps, count(*) as n from pg group by 1), w as (select *, unnest(range(0, greatest(0, cast(ceil((n - 5) / 4.0) as bigint)) + 1)) as w from l), t as (select doc_id, w, w * 4 + 1 as page_start, least(w * 4 + 5, n) as page_end, trim(substr(array_to_string(list_filter(ps[w * 4 + 1:w * 4 + 5], lambda p: p <> ''), chr(10) || chr(10)), 1, 18000), ' ' || chr(10) || chr(9) || chr(13)) as x from w) select doc_id, row_number() over (partition by doc_id order by w) - 1 as chunk_index, page_start, page_end, length(x) as n from t where length(x) >= 200",
    "packed_paragraphs": "with l as (select doc_id, length(text) + 1 as n_chars, list_transform(string_split(text, chr(10)), lambda p: {'pages': 1, 'n': length(p) + 1}) as ps from documents where text is not null) select doc_id, list_reduce(ps, lambda a, x: case when a.n + x.n > 3000 then {'pages': a.pages + 1, 'n': x.n} else {'pages': a.pages, 'n': a.n + x.n} end).pages as n_pages, n_chars from l",
    "name_rules": "with w as (select doc_id, unnest(list_distinct(string_split(text, ' '))) as c from documents where text is not null), n as (select trim(c) as n from w), r as (select case when length(n) < 4 then 'too_short' when regexp_matches(n, '^[0-9]+$') then 'all_digits' when not regexp_matches(n, '\\p{L}') then 'no_alpha' when upper(n) in (" + ", ".join(f"'{x}'" for x in E.HEADER_WORDS) + ") then 'header_token' when upper(n) in (" + ", ".join(f"'{x}'" for x in E.STREET_WORDS) + ") then 'street_suffix_only' when regexp_matches(n, '(?i)^(?:(?:see|refer|ph|fax|tel|email|web|po\\s*box|p\\.?o)(?:[^\\p{L}\\p{N}_]|$)|(?:p\\.?o\\.|c/-)[\\p{L}\\p{N}_])') then 'admin_phrase_prefix' when length(n) > 80 then 'enormous' end as rule from n) select rule, count(*) as n from r where rule is not null group by 1",
    "events_dedupe": "with recursive k as (select user_id, event_type, min(ts) as ts from events group by 1, 2 union all select k.user_id, k.event_type, min(e.ts) from k join events e on e.user_id = k.user_id and e.event_type = k.event_type and e.ts >= k.ts + interval 24 hour group by k.user_id, k.event_type) select * from k",
    "url_kinds": "select page_id, cast(null as varchar) as kind, regexp_replace(regexp_replace(url, '[?#].*$', ''), '/+$', '') as clean, lower(regexp_extract(url, '^https?://([^/?#]+)', 1)) as host, true as third_party, case when contains(replace(h, '.', ''), 'ththhomes') then 3 else 0 end + case when regexp_matches(h, 'build|construct|homes|developments|projects') then 2 else 0 end + case when h like '%.com.au' then 1 else 0 end as score from (select *, regexp_replace(lower(regexp_extract(url, '^https?://([^/?#]+)', 1)), '^www\\.', '') as h from pages)",
    "token_places": " union all ".join(f"select doc_id, '{kind}' as kind, v as raw_value, n as normalized_value, cast(instr(text, v) - 1 as int) as span_start, cast(instr(text, v) - 1 + length(v) as int) as span_end from (select distinct on (doc_id, n) doc_id, text, v, n from (select doc_id, text, unnest(vs) as v, unnest(list_transform(vs, lambda v: {norm})) as n, unnest(range(len(vs))) as i from (select doc_id, text, regexp_extract_all(text, '{E.PATTERNS[kind][0]}', {E.PATTERNS[kind][1]}) as vs from documents)) where {keep} order by doc_id, n, i)" for kind, norm, keep in (("email", "lower(v)", "true"), ("phone", "regexp_replace(v, '[^0-9]', '', 'g')", "length(n) >= 8"))),
}

"""Queries over planning applications, properties, sales, entities and documents, with their SQL twins."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotline.functions import classify as C
from lotline.functions.hashing import DEFAULT_CENTRE, SCATTER, hash_bucket, with_coordinates
from lotline.functions.text import normalize_address
from lotline.operators import joins as J
from lotline.operators import rollups as A
from lotline.plans import projects as P
from lotline.sources.adapters import tables, twin

AS_OF = datetime.date(2001, 9, 1)
AS_OF_SQL = "date '2001-09-01'"
PROJECT_TABLES = ["applications", "domain_properties", "realestate_properties", "domain_sales", "realestate_sales", "documents_meta", "application_entities", "companies", "build_features", "discovered_urls"]

GRANNY = "regexp_matches(description, '(?i)secondary\\s+dwelling|granny\\s+flat|auxiliary\\s+dwelling|ancillary\\s+dwelling')"
DUPLEX = "(regexp_matches(description, '(?i)dual\\s+occupancy|duplex') and not regexp_matches(description, '(?i)triplex|fourplex|quadruplex|multi[\\s-]+unit|multi[\\s-]+dwelling'))"
BIG = "(approved_units >= 3 or regexp_matches(description, '(?i)triplex|fourplex|quadruplex|multi[\\s-]+unit|multi[\\s-]+dwelling|townhouse'))"
OTHER = "(not regexp_matches(description, '(?i)secondary\\s+dwelling|granny\\s+flat|dual\\s+occupancy|duplex|triplex|fourplex|multi[\\s-]+unit|multi[\\s-]+dwelling'))"
COUNT_SQL = f"case when approved_units is not null then approved_units when regexp_matches(description, '(?i)dual\\s+occupancy|duplex') then 2 when regexp_matches(description, '(?i)triplex') then 3 when regexp_matches(description, '(?i)fourplex|quadruplex') then 4 when {GRANNY} then 1 end"
DKIND_SQL = f"case when {GRANNY} then 'granny' when {BIG} then 'big_dev' when regexp_matches(description, '(?i)dual\\s+occupancy|duplex') then 'duplex' end"
KIND_SQL = "case when approved_units >= 3 then 'big_dev' when regexp_matches(coalesce(description, ''), '(?i)\\b(secondary\\s+dwelling|granny\\s+flat|auxiliary\\s+dwelling|ancillary\\s+dwelling)\\b') then 'granny' when regexp_matches(coalesce(description, ''), '(?i)\\b(triplex|fourplex|quadruplex|multi[\\s-]?(unit|dwelling|residential)|townhouse|apartment\\s+building|\\d+\\s*x?\\s*(unit|dwelling|townhouse|apartment)s?)\\b') then 'big_dev' when regexp_matches(coalesce(description, ''), '(?i)\\b(dual\\s+occupancy|duplex)\\b') then 'duplex' else 'other' end"
DOC_KIND_SQL = "case doc_type when 'DA Form 1' then 'submission' when 'Plans' then 'submission' when 'Information Request' then 'ir_council' when 'Response to IR Cover Letter' then 'ir_response' when 'Amended Plans' then 'amendment' when 'Specialist Reports' then 'submission' else 'decision' end"
# Street matches, their units, and what the list needs of them; each twin below takes the parts it names.
PARTS = {
    "streets": "select distinct street_address from applications where street_address <> ''",
    "dm": "select s.street_address, p.* from streets s join domain_properties p on lower(p.display_address) like lower(s.street_address) || '%'",
    "rm": "select s.street_address, p.* from streets s join realestate_properties p on lower(p.display_address) like lower(s.street_address) || '%'",
    "du": "select distinct m.street_address, u.* from dm m join domain_properties u using (street_number, street_name, suburb) where m.unit_number = '' and u.unit_number <> ''",
    "ru": "select distinct m.street_address, u.* from rm m join realestate_properties u using (street_number, street_name, suburb) where m.unit_number = '' and u.unit_number <> ''",
    "dpre": "select a.id, max_by(s.event_price, (s.event_date, s.id)) as price, max(s.event_date) as day from applications a join dm m using (street_address) join domain_sales s on s.domain_property_id = m.id where s.event_date < a.lodged_date and s.event_date >= a.lodged_date - interval 10 year and s.is_sold and s.event_price is not null group by a.id",
    "rpre": "select a.id, max_by(s.event_price, (s.event_date, s.id)) as price, max(s.event_date) as day from applications a join rm m using (street_address) join realestate_sales s on s.realestate_property_id = m.id where s.event_date < a.lodged_date and s.event_date >= a.lodged_date - interval 10 year and s.event_type = 'sold' and s.event_price is not null group by a.id",
    "dpost": "select a.id, sum(case when s.is_sold then s.event_price end) as total, count(*) filter (where s.is_sold and s.event_price is not null) as n from applications a join du u using (street_address) join domain_sales s on s.domain_property_id = u.id where s.event_date > a.decision_date group by a.id",
    "rpost": "select distinct a.id from applications a join ru u using (street_address) join realestate_sales s on s.realestate_property_id = u.id where s.event_date > a.decision_date",
    "upost": "select distinct a.id from applications a join discovered_urls d on regexp_matches(d.search_address, '^[0-9]+/') and regexp_replace(d.search_address, '^[0-9]+/', '') like split_part(a.street_address, ',', 1) || '%' where d.url_kind is not null and d.discovered_at > a.decision_date",
    "dsite": "select street_address, max(land_area_m2) as land, max(bedrooms) as beds, max(bathrooms) as baths, max(property_type) as kind from dm where unit_number = '' group by 1",
    "rsite": "select street_address, max(land_area_m2) as land, max(bedrooms) as beds, max(bathrooms) as baths from rm where unit_number = '' group by 1",
    "drooms": "select street_address, sum(b) as beds, count(b) as n_beds, sum(t) as baths, count(t) as n_baths, count(*) as n_units from (select street_address, unit_number, max(bedrooms) as b, max(bathrooms) as t from du group by 1, 2) group by 1",
    "rrooms": "select street_address, sum(b) as beds, count(b) as n_beds, sum(t) as baths, count(t) as n_baths, count(*) as n_units from (select street_address, unit_number, max(bedrooms) as b, max(bathrooms) as t from ru group by 1, 2) group by 1",
    "feat": "select application_id as id, max(site_area_m2) filter (where site_area_m2 > 0) as land, max(bedrooms) filter (where template_key = 'build_features_drawings' and bedrooms > 0) as beds, max(bathrooms) filter (where template_key = 'build_features_drawings' and bathrooms > 0) as baths from build_features group by 1",
    "ents": "select application_id as id, max(case when role = 'applicant' then display_name end) as applicant_name, max(case when role = 'agent' then display_name end) as applicant_agent_name, max(case when role = 'builder' then display_name end) as builder_name, max(case when role = 'architect' then display_name end) as architect_name, max(case when role = 'owner' then display_name end) as owner_name, max(case when role = 'applicant' then acn end) as applicant_acn, max(case when role = 'applicant' then entity_type end) as applicant_entity_type, max(case when role = 'applicant' then company_id end) as applicant_company_id from application_entities e left join companies c on c.id = e.company_id group by 1",
    "dev": "select company_id, count(distinct application_id) as n_projects from application_entities where role = 'applicant' and company_id is not null group by 1",
    "droll": f"select application_id as id, count(*) as n_docs, coalesce(sum(file_size), 0) as total_bytes, count(*) filter (where {DOC_KIND_SQL} in ('ir_council', 'ir_response')) as n_info_requests, count(*) filter (where {DOC_KIND_SQL} in ('amendment', 'further_info')) as n_amendments from documents_meta group by 1",
    "apps2": f"select *, {COUNT_SQL} as dwelling_count, {DKIND_SQL} as dwelling_kind, {KIND_SQL} as kind from applications",
}


def parts(*names: str) -> str:
    return "with " + ",\n".join(f"{n} as ({PARTS[n]})" for n in names)


def rooms_sql(c: str) -> str:
    return f"cast(coalesce(case when d.n_{c} >= dwelling_count then d.{c} end, case when r.n_{c} >= dwelling_count then r.{c} end, f.{c} * nullif(dwelling_count, 0)) as bigint)"


PROJECTS_SQL = (
    parts("apps2", "streets", "dm", "rm", "du", "ru", "dpre", "rpre", "dpost", "rpost", "upost", "dsite", "rsite", "drooms", "rrooms", "feat", "ents", "dev", "droll")
    + f"""
select a.id, council_slug, application_id, a.kind, suburb, a.street_address, decision_outcome, lodged_date, decision_date, approved_units, description, lot_on_plan,
  applicant_name, applicant_acn, applicant_entity_type, applicant_agent_name, dev.n_projects as developer_project_count, builder_name, architect_name,
  dwelling_count, dwelling_kind, case when applicant_company_id is not null or n_docs > 0 then 'derived' end as insight_status,
  n_docs, n_info_requests, n_amendments, cast(total_bytes as bigint) as total_bytes, date_diff('day', lodged_date, decision_date) as days_lodge_to_decide,
  cast(coalesce(ds.land, rs.land, f.land) as bigint) as site_area_m2, case when ds.land is not null then 'domain' when rs.land is not null then 'realestate' when f.land is not null then 'da_docs' end as site_area_source,
  coalesce(dpre.price, rpre.price) as pre_price, coalesce(dpre.day, rpre.day) as pre_date, case when dpre.id is not null then 'domain' else 'realestate' end as pre_source,
  cast(nullif(coalesce(dpost.total, 0), 0) as bigint) as post_total, coalesce(dpost.n, 0) as n_post_sales, cast(nullif(coalesce(dpost.total, 0), 0) - coalesce(dpre.price, rpre.price) as bigint) as gross_spread,
  coalesce(ds.beds, rs.beds) as pre_bedrooms, coalesce(ds.baths, rs.baths) as pre_bathrooms, ds.kind as pre_property_type,
  {rooms_sql("beds")} as post_bedrooms, {rooms_sql("baths")} as post_bathrooms,
  case when coalesce(d.n_units, 0) >= dwelling_count then 'domain' when coalesce(r.n_units, 0) >= dwelling_count then 'realestate' when coalesce(f.beds, f.baths) is not null and dwelling_count > 0 then 'da_docs' end as post_rooms_source,
  case when lower(coalesce(decision_outcome, '')) not like '%approv%' then null when coalesce(dpost.n, 0) > 0 then 'built_sold' when dpost.id is not null or rpost.id is not null or upost.id is not null then 'built_unsold'
    when decision_date < {AS_OF_SQL} - interval 3 year then 'abandoned_likely' else 'unknown' end as built_status
from apps2 a left join ents on ents.id = a.id left join dev on dev.company_id = ents.applicant_company_id left join droll on droll.id = a.id
  left join dsite ds on ds.street_address = a.street_address left join rsite rs on rs.street_address = a.street_address
  left join drooms d on d.street_address = a.street_address left join rrooms r on r.street_address = a.street_address
  left join feat f on f.id = a.id left join dpre on dpre.id = a.id left join rpre on rpre.id = a.id left join dpost on dpost.id = a.id left join rpost on rpost.id = a.id left join upost on upost.id = a.id
where coalesce(dpre.price, rpre.price) is not null
"""
)


def projects(spark: SparkSession, d: str) -> DataFrame:
    return P.projects(tables(spark, d, *PROJECT_TABLES), AS_OF, limit=None)


def projects_page(spark: SparkSession, d: str) -> DataFrame:
    return P.projects(tables(spark, d, *PROJECT_TABLES), AS_OF, analyzed_only=True, kind="duplex", limit=50)


def suburb_leaderboard(spark: SparkSession, d: str) -> DataFrame:
    return A.suburb_stats(tables(spark, d, "applications")["applications"], AS_OF, "duplex")


def monthly_trends(spark: SparkSession, d: str) -> DataFrame:
    return A.trend_stats(tables(spark, d, "applications")["applications"])


def approved_share(spark: SparkSession, d: str) -> DataFrame:
    return A.approved_share(monthly_trends(spark, d))


def prefix_matches(spark: SparkSession, d: str) -> DataFrame:
    t = tables(spark, d, "applications", "domain_properties")
    return J.prefix_join(t["applications"].select(F.col("id").alias("app_id"), "street_address"), t["domain_properties"].select("id", "display_address"), "street_address", "display_address").select("app_id", "id")


def lot_units(spark: SparkSession, d: str) -> DataFrame:
    t = tables(spark, d, "applications", "domain_properties")
    return J.unit_children(J.lot_matches(t["applications"], t["domain_properties"]), t["domain_properties"]).select("street_address", "id", "unit_number")


def pre_sales(spark: SparkSession, d: str) -> DataFrame:
    t = tables(spark, d, "applications", "domain_properties", "domain_sales")
    m = J.lot_matches(t["applications"], t["domain_properties"])
    return P.pre_sale(t["applications"], m, t["domain_sales"], "domain_property_id", F.col("is_sold"))


def sale_units(t: dict[str, DataFrame]) -> DataFrame:
    return J.unit_children(J.lot_matches(t["applications"], t["domain_properties"]), t["domain_properties"])


def unit_sales(spark: SparkSession, d: str) -> DataFrame:
    t = tables(spark, d, "applications", "domain_properties", "domain_sales")
    return P.unit_sales(t["applications"], sale_units(t), t["domain_sales"])


def nested_unit_sales(spark: SparkSession, d: str) -> DataFrame:
    """Every listed project with its unit sales in order, as one line each and how many there are."""
    t = tables(spark, d, *PROJECT_TABLES)
    rows = P.with_unit_sales(P.listed(t), t["applications"], sale_units(t), t["domain_sales"])
    line = lambda u: F.concat_ws("|", u["unit_number"], u["display_address"], u["sold_price"].cast("string"), u["sold_date"].cast("string"))
    return rows.select("id", F.size("unit_sales").cast("long").alias("n_units"), F.array_join(F.transform("unit_sales", line), "; ").alias("units"))


def role_pivot(spark: SparkSession, d: str) -> DataFrame:
    t = tables(spark, d, "application_entities", "companies")
    return A.entities_by_role(t["application_entities"], t["companies"])


def document_rollup(spark: SparkSession, d: str) -> DataFrame:
    return A.docs_rollup(tables(spark, d, "documents_meta")["documents_meta"])


def process_stats(spark: SparkSession, d: str) -> DataFrame:
    return A.process_stats(tables(spark, d, "documents_meta")["documents_meta"])


def developer_projects(spark: SparkSession, d: str) -> DataFrame:
    return A.developer_counts(tables(spark, d, "application_entities")["application_entities"])


def current_rates(spark: SparkSession, d: str) -> DataFrame:
    return A.current_rates(tables(spark, d, "rates")["rates"])


def latest_rate(spark: SparkSession, d: str) -> DataFrame:
    return A.latest_rate(tables(spark, d, "rates")["rates"])


def status_counters(spark: SparkSession, d: str) -> DataFrame:
    t = tables(spark, d, "applications", "documents_meta")
    return A.status_counts(t["applications"], t["documents_meta"])


def council_counts(spark: SparkSession, d: str) -> DataFrame:
    vendor = F.when(F.col("id") % 3 == 0, "b").otherwise("a")
    return A.per_council(tables(spark, d, "applications")["applications"].withColumn("vendor", vendor))


def kind_counts(spark: SparkSession, d: str) -> DataFrame:
    return A.kind_counts(tables(spark, d, "applications")["applications"])


def derived_dwellings(spark: SparkSession, d: str) -> DataFrame:
    desc, n = F.col("description"), F.col("approved_units")
    return tables(spark, d, "applications")["applications"].select("id", C.dwelling_count(desc, n).alias("dwelling_count"), C.dwelling_kind(desc, n).alias("dwelling_kind"), C.classify_kind(desc, n).alias("kind"), C.type_code(F.col("application_id")).alias("type_code"))


def filtered_applications(spark: SparkSession, d: str) -> DataFrame:
    apps = tables(spark, d, "applications")["applications"]
    return P.filter_applications(apps, kind="other", suburb="suburb 3", type_code="mcu", date_from=datetime.date(1996, 1, 1), date_to=datetime.date(2000, 12, 31), q="OPERA").select("id", "application_id", "suburb", "lodged_date")


def map_points(spark: SparkSession, d: str) -> DataFrame:
    desc, n = F.col("description"), F.col("approved_units")
    apps = tables(spark, d, "applications")["applications"]
    shown = F.coalesce(C.kind_predicate("granny", desc, n), F.lit(False)) | F.coalesce(C.kind_predicate("duplex", desc, n), F.lit(False)) | F.coalesce(C.kind_predicate("big_dev", desc, n), F.lit(False))
    top = apps.where(shown).orderBy(F.desc("lodged_date"), F.desc("id")).limit(2000)
    out = with_coordinates(top, "application_id", "suburb")
    return out.select("application_id", "council_slug", C.classify_kind(desc, n).alias("kind"), F.round("lat", 6).alias("lat"), F.round("lng", 6).alias("lng"), "suburb")


def application_details(spark: SparkSession, d: str) -> DataFrame:
    t = tables(spark, d, "applications", "documents_meta")
    out = P.application_detail(t["applications"].select("id", "application_id"), t["documents_meta"])
    return out.select("id", "application_id", F.array_join(F.transform("documents", lambda x: x["id"].cast("string")), ",").alias("document_ids"))


def supply_delta(spark: SparkSession, d: str) -> DataFrame:
    return P.supply_delta(projects(spark, d))


def project_status(spark: SparkSession, d: str) -> DataFrame:
    t = tables(spark, d, *PROJECT_TABLES)
    return P.project_status(P.projects(t, AS_OF, limit=None), P.unit_sale_counts(t["applications"], sale_units(t), t["domain_sales"]), AS_OF)


def project_timing(spark: SparkSession, d: str) -> DataFrame:
    return P.project_timing(projects(spark, d), unit_sales(spark, d).groupBy("id").agg(F.min("sold_date").alias("first_sold")))


def scenario_profit(spark: SparkSession, d: str) -> DataFrame:
    t = tables(spark, d, "orders", "rates")
    s = t["orders"].select(F.col("o_orderkey").alias("scenario_id"), F.col("o_totalprice").alias("purchase_price"), (F.col("o_totalprice") * 0.6).alias("build_cost"), F.expr("o_totalprice * case when o_orderkey % 10 = 0 then 0 else 1.9 end").alias("sale_price"), F.expr("6 + o_orderkey % 20").alias("hold_months"), F.lit(None).cast("double").alias("rate_pct"), F.lit(None).cast("double").alias("acquisition_costs_pct"), F.lit(None).cast("double").alias("sale_costs_pct"))
    out = P.profitability(s, t["rates"])
    return out.select("scenario_id", "error", *[F.round(c, 2).alias(c) for c in ("rate_pct_used", "interest_cost", "total_cost", "profit", "margin_pct", "annualised_return_pct", "breakeven_sale_price")], "verdict")


def business_city_hint(spark: SparkSession, d: str) -> DataFrame:
    t = tables(spark, d, "application_entities", "applications")
    rows = t["application_entities"].join(t["applications"].select(F.col("id").alias("application_id"), "suburb"), "application_id").where("suburb <> ''")
    return A.modal_value(rows, ["company_id", "role"], "suburb", "city")


def merged_summaries(spark: SparkSession, d: str) -> DataFrame:
    return A.priority_merge(tables(spark, d, "doc_summaries")["doc_summaries"], {"builder_name": ["last", "tier2", "first"], "dwelling_kind": ["first", "tier2", "last"]})


def longest_summary(spark: SparkSession, d: str) -> DataFrame:
    return A.longest_in_priority(tables(spark, d, "doc_summaries")["doc_summaries"], "builder_name", ["tier2", "first", "last"])


def candidate_lots(spark: SparkSession, d: str) -> DataFrame:
    t = tables(spark, d, "domain_properties", "applications")
    key = lambda df, street: df.withColumn("match_key", normalize_address(F.substring_index(street, ",", 1), F.col("suburb"), F.lit("4220"))["match_key"])
    return A.house_and_units(key(t["domain_properties"], "display_address"), key(t["applications"].where("id % 50 = 0"), "street_address"))


def analysis_candidates(spark: SparkSession, d: str) -> DataFrame:
    t = tables(spark, d, "applications", "documents_meta", "doc_summaries")
    return A.analysis_candidates(t["applications"], t["documents_meta"], t["doc_summaries"].where("builder_name <> ''"))


def work_buckets(spark: SparkSession, d: str) -> DataFrame:
    return tables(spark, d, "companies")["companies"].groupBy(hash_bucket(F.lower("display_name"), 7).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


QUERIES = {
    f.__name__: f
    for f in (
        projects, projects_page, suburb_leaderboard, monthly_trends, approved_share, prefix_matches, lot_units, pre_sales, unit_sales, nested_unit_sales, role_pivot, document_rollup, process_stats,
        developer_projects, current_rates, latest_rate, status_counters, council_counts, kind_counts, derived_dwellings, filtered_applications, map_points, application_details,
        supply_delta, project_status, project_timing, scenario_profit, business_city_hint, merged_summaries, longest_summary, candidate_lots, analysis_candidates, work_buckets,
    )
}

FIRST = PROJECTS_SQL.strip()
INNER = "p as (select * from (" + FIRST[FIRST.rindex("\nselect a.id, council_slug") + 1 :] + "))"
PROJECTS_CTE = FIRST[: FIRST.rindex("\nselect a.id, council_slug")] + ",\n" + INNER
UNIT_SALES_CTE = "us as (select distinct a.id, u.unit_number, u.display_address, l.sold_price, l.sold_date from applications a join du u using (street_address) join (select domain_property_id, max(event_date) as sold_date, max(event_price) as sold_price from domain_sales where is_sold and event_price is not null group by 1) l on l.domain_property_id = u.id where l.sold_date > a.decision_date)"

ORACLE_SQL = {
    "projects": twin(PROJECTS_SQL, *PROJECT_TABLES),
    "projects_page": twin(PROJECTS_CTE + f"\nselect * from p where id in (select e.id from ents e) and {DUPLEX} order by lodged_date desc, id desc limit 50", *PROJECT_TABLES),
    "suburb_leaderboard": twin(f"select upper(suburb) as suburb, count(*) as n_total, count(*) filter (where {DUPLEX}) as n_kind, count(*) filter (where {DUPLEX} and lodged_date >= {AS_OF_SQL} - 30) as n_last_30d, count(*) filter (where {DUPLEX} and lodged_date >= {AS_OF_SQL} - 60 and lodged_date < {AS_OF_SQL} - 30) as n_prev_30d from applications where suburb <> '' group by 1 having n_kind > 0 order by n_kind desc, n_last_30d desc, 1 limit 40", "applications"),
    "monthly_trends": twin(f"select cast(date_trunc('month', lodged_date) as date) as bucket_start, count(*) filter (where {GRANNY}) as n_granny, count(*) filter (where {DUPLEX}) as n_duplex, count(*) filter (where {BIG}) as n_big_dev, count(*) filter (where {OTHER}) as n_other, count(*) filter (where lower(decision_outcome) in ('approved', 'approved with conditions')) as n_approved, count(*) as n_total from applications where lodged_date is not null group by 1", "applications"),
    "approved_share": twin("select cast(date_trunc('month', lodged_date) as date) as bucket_start, count(*) filter (where lower(decision_outcome) in ('approved', 'approved with conditions')) / count(*) * 100 as approved_pct from applications where lodged_date is not null group by 1", "applications"),
    "prefix_matches": twin("select a.id as app_id, p.id from applications a join domain_properties p on lower(p.display_address) like lower(a.street_address) || '%' where a.street_address <> ''", "applications", "domain_properties"),
    "lot_units": twin(parts("streets", "dm", "du") + " select street_address, id, unit_number from du", "applications", "domain_properties"),
    "pre_sales": twin(parts("streets", "dm", "dpre") + " select id, price as event_price, day as event_date from dpre", "applications", "domain_properties", "domain_sales"),
    "unit_sales": twin(parts("streets", "dm", "du") + ", " + UNIT_SALES_CTE + " select * from us", "applications", "domain_properties", "domain_sales"),
    "role_pivot": twin(parts("ents") + " select id as application_id, * exclude (id) from ents", "application_entities", "companies"),
    "document_rollup": twin(parts("droll") + " select id as application_id, n_docs, cast(total_bytes as bigint) as total_bytes, n_info_requests, n_amendments from droll", "documents_meta"),
    "process_stats": twin("select application_id, count(*) as n_docs, count(file_path) as n_downloaded, cast(coalesce(sum(file_size), 0) as bigint) as total_bytes, count(*) filter (where lower(doc_type) like '%information request%') as n_information_requests, count(*) filter (where lower(doc_type) like '%amended%') as n_amendments, count(*) filter (where lower(doc_type) like '%specialist%') as n_specialist, min(cast(published_at as date)) filter (where file_path is not null) as first_doc, max(cast(published_at as date)) filter (where file_path is not null) as last_doc from documents_meta group by 1", "documents_meta"),
    "developer_projects": twin(parts("dev") + " select * from dev", "application_entities"),
    "current_rates": twin("select max(month) as as_of_month, max(case when series_id = 'FILRHLBVD' then rate_pct end) as variable_oo_pct, max(case when series_id = 'FILRHLBVDI' then rate_pct end) as variable_inv_pct, max(case when series_id = 'FILRHL3YF' then rate_pct end) as fixed_3yr_oo_pct, max(case when series_id = 'FILRHL3YFI' then rate_pct end) as fixed_3yr_inv_pct from rates where month = (select max(month) from rates where series_id = 'FILRHLBVD')", "rates"),
    "latest_rate": twin("select rate_pct from rates where series_id in ('FILRHLBVD', 'FILRHL3YF', 'FILRHLBVS') order by month desc, case series_id when 'FILRHLBVD' then 1 when 'FILRHL3YF' then 2 else 3 end limit 1", "rates"),
    "status_counters": twin("select * from (select count(*) as apps_total, count(detail_fetched_at) as apps_with_detail from applications), (select count(*) as docs_total, count(file_path) as docs_downloaded, cast(coalesce(sum(file_size), 0) as bigint) as docs_total_bytes from documents_meta)", "applications", "documents_meta"),
    "council_counts": twin("select council_slug, case when id % 3 = 0 then 'b' else 'a' end as vendor, count(*) as n, min(lodged_date) as first_lodged, max(lodged_date) as last_lodged from applications group by 1, 2", "applications"),
    "kind_counts": twin(f"select {KIND_SQL} as kind, count(*) as n from applications group by 1", "applications"),
    "derived_dwellings": twin(f"select id, {COUNT_SQL} as dwelling_count, {DKIND_SQL} as dwelling_kind, {KIND_SQL} as kind, upper(nullif(regexp_extract(application_id, '^([A-Za-z]{{2,4}})/', 1), '')) as type_code from applications", "applications"),
    "filtered_applications": twin(f"select id, application_id, suburb, lodged_date from applications where {OTHER} and upper(suburb) = 'SUBURB 3' and application_id like 'MCU/%' and lodged_date between date '1996-01-01' and date '2000-12-31' and lower(description) like '%opera%'", "applications"),
    "application_details": twin("select a.id, a.application_id, string_agg(cast(m.id as varchar), ',' order by m.published_at is null, m.published_at, m.id) as document_ids from applications a left join documents_meta m on m.application_id = a.id group by 1, 2", "applications", "documents_meta"),
    "supply_delta": twin(PROJECTS_CTE + "\nselect id, dwelling_count - case when lower(coalesce(pre_property_type, '')) in ('land', 'vacant', 'vacant land') then 0 else 1 end as dwellings_delta, post_bedrooms - case when lower(coalesce(pre_property_type, '')) in ('land', 'vacant', 'vacant land') then 0 else pre_bedrooms end as bedrooms_delta, post_bathrooms - case when lower(coalesce(pre_property_type, '')) in ('land', 'vacant', 'vacant land') then 0 else pre_bathrooms end as bathrooms_delta, coalesce(built_status = 'built_sold', false) as finished, coalesce(post_rooms_source = 'da_docs', false) as projected from p", *PROJECT_TABLES),
    "nested_unit_sales": twin(PROJECTS_CTE + ", " + UNIT_SALES_CTE + """, n as (select id, count(*) as n_units, string_agg(unit_number || '|' || display_address || '|' || sold_price || '|' || sold_date, '; ' order by unit_number, display_address, sold_price, sold_date) as units from us group by 1)
select p.id, coalesce(n_units, 0) as n_units, coalesce(units, '') as units from p left join n using (id)""", *PROJECT_TABLES),
    "project_status": twin(PROJECTS_CTE + ", " + UNIT_SALES_CTE + f", n as (select id, count(sold_price) as n_sold from us group by 1)\nselect p.id, case when lower(coalesce(decision_outcome, '')) not like '%approv%' then null when coalesce(n_sold, 0) > 0 and dwelling_count > 0 and round(n_sold / dwelling_count * 100) <> 100 then 'Sold ' || cast(cast(round(n_sold / dwelling_count * 100) as bigint) as varchar) || '%' when coalesce(n_sold, 0) > 0 then 'Sold' when built_status = 'built_unsold' then 'Rented' when built_status = 'abandoned_likely' then 'Dormant' when date_diff('day', decision_date, {AS_OF_SQL}) / 30.44 < 15 then 'Building' else 'Unknown' end as project_status from p left join n on n.id = p.id", *PROJECT_TABLES),
    "project_timing": twin(PROJECTS_CTE + ", " + UNIT_SALES_CTE + ", n as (select id, min(sold_date) as first_sold from us group by 1)\nselect p.id, date_diff('day', pre_date, coalesce(case when lower(decision_outcome) like '%approv%' then decision_date end, lodged_date)) as prep_days, date_diff('day', case when lower(decision_outcome) like '%approv%' then decision_date end, first_sold) as project_days from p left join n on n.id = p.id", *PROJECT_TABLES),
    "scenario_profit": twin("""with s as (select o_orderkey as scenario_id, o_totalprice as buy, o_totalprice * 0.6 as build, o_totalprice * cast(case when o_orderkey % 10 = 0 then 0 else 1.9 end as double) as sale, cast(6 + o_orderkey % 20 as double) as months, coalesce((select max_by(rate_pct, month) from rates where series_id = 'FILRHLBVD'), 6.0) as rate from orders),
c as (select *, not (buy > 0 and sale > 0 and months > 0) as bad, buy * 0.055 as acq, (buy + build + buy * 0.055) * (rate / 100) * (months / 12) as interest from s),
t as (select *, buy + build + acq + interest + sale * 0.025 as total from c)
select scenario_id, case when bad then 'purchase_price, sale_price and hold_months must be above 0' end as error, case when not bad then round(rate, 2) end as rate_pct_used, case when not bad then round(interest, 2) end as interest_cost, case when not bad then round(total, 2) end as total_cost, case when not bad then round(sale - total, 2) end as profit,
  case when not bad then round((sale - total) / total * 100, 2) end as margin_pct, case when not bad then round((sale - total) / total / (months / 12) * 100, 2) end as annualised_return_pct, case when not bad then round(total - sale * 0.025 + total * 0.025, 2) end as breakeven_sale_price,
  case when bad then null when sale - total < 0 or (sale - total) / total * 100 < 5 then 'grasshopper' when (sale - total) / total * 100 >= 18 and (sale - total) / total / (months / 12) * 100 >= 15 then 'bull' else 'marginal' end as verdict from t""", "rates"),
    "business_city_hint": twin("select company_id, role, suburb as city, n from (select company_id, role, suburb, count(*) as n, row_number() over (partition by company_id, role order by count(*) desc, suburb) as r from application_entities e join applications a on a.id = e.application_id where suburb <> '' group by 1, 2, 3) where r = 1", "application_entities", "applications"),
    "merged_summaries": twin("""select application_id, b[3] as builder_name, cast(b[2] as bigint) as builder_name_doc, k[3] as dwelling_kind, cast(k[2] as bigint) as dwelling_kind_doc from (select application_id,
  min([case doc_position when 'last' then '1' when 'tier2' then '2' else '3' end, lpad(cast(document_id as varchar), 20, '0'), builder_name]) filter (where builder_name not in ('', 'unknown')) as b,
  min([case doc_position when 'first' then '1' when 'tier2' then '2' else '3' end, lpad(cast(document_id as varchar), 20, '0'), dwelling_kind]) filter (where dwelling_kind not in ('', 'unknown')) as k from doc_summaries group by 1)""", "doc_summaries"),
    "longest_summary": twin("select application_id, left(max_by(builder_name, (case doc_position when 'tier2' then 3 when 'first' then 2 else 1 end, length(builder_name), -document_id)) filter (where builder_name <> ''), 1000) as builder_name from doc_summaries group by 1", "doc_summaries"),
    "candidate_lots": twin(f"with n as (select *, case street_name when 'Oak' then 'oak st' when 'Elm' then 'elm pde' when 'Sea' then 'sea view rd' else 'hill ct' end as norm from domain_properties), k as (select unit_number, street_number || '|' || norm || '|' || lower(suburb) || '|4220' as match_key from n), a as (select split_part(street_address, ' ', 1) || '|' || case split_part(street_address, ' ', 2) when 'Oak' then 'oak st' when 'Elm' then 'elm pde' when 'Sea' then 'sea view rd' else 'hill ct' end || '|' || lower(suburb) || '|4220' as match_key from applications where id % 50 = 0) select match_key, count(*) filter (where unit_number = '') as n_parent, count(*) filter (where unit_number <> '') as n_units from k where match_key not in (select match_key from a) group by 1 having n_parent > 0 and n_units > 0", "domain_properties", "applications"),
    "analysis_candidates": twin("select a.id, lodged_date, n_plans, n_supporting, n_docs, n_plans + n_supporting as richness from applications a join (select application_id as id, count(*) filter (where lower(doc_type) like '%plan%') as n_plans, count(*) filter (where lower(doc_type) like '%specialist%' or lower(doc_type) like '%form%') as n_supporting, count(*) as n_docs from documents_meta group by 1) m on m.id = a.id where n_plans > 0 and n_supporting > 0 and a.id not in (select application_id from doc_summaries where builder_name <> '')", "applications", "documents_meta", "doc_summaries"),
    "work_buckets": twin("select cast(('0x' || left(md5(lower(display_name)), 8))::bigint % 7 as bigint) as bucket, count(*) as n from companies group by 1", "companies"),
    "map_points": twin(f"with t as (select * from applications where coalesce({GRANNY}, false) or coalesce({DUPLEX}, false) or coalesce({BIG}, false) order by lodged_date desc, id desc limit 2000), h as (select *, list_reduce(list_prepend(cast(14695981039346656037 as hugeint), list_transform(string_split(application_id, ''), lambda c: cast(ascii(c) as hugeint))), lambda h, b: (xor(h, b) * 1099511628211) % 18446744073709551616) as h from t) select application_id, council_slug, {KIND_SQL} as kind, round({DEFAULT_CENTRE[0]} + (cast(h // 4294967296 as double) / 4294967295.0 * 2.0 - 1.0) * {SCATTER}, 6) as lat, round({DEFAULT_CENTRE[1]} + (cast(h % 4294967296 as double) / 4294967295.0 * 2.0 - 1.0) * {SCATTER}, 6) as lng, suburb from h", "applications"),
}

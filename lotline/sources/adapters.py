"""Reference-shaped views over the supplied tables, in SQL that Spark and DuckDB both read.

One lot stands for three customers (a parent property and its units 1 and 2); orders are planning
applications and sale events, line items are their documents, entities and extracted features.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

BASE = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "pages", "labels", "conversations", "benchmark"]


def _text(x: str) -> str:
    return f"cast({x} as varchar(20))"


def _lot(key: str) -> str:
    return f"cast(floor({key} / 3) as bigint)"


def _number(key: str) -> str:
    return _text(f"1 + {_lot(key)} % 2000")


def _street(key: str) -> str:
    return f"case {_lot(key)} % 4 when 0 then 'Oak Street' when 1 then 'Elm Parade' when 2 then 'Sea View Road' else 'Hill Court' end"


def _properties(shift: int, no_area: int, where: str) -> str:
    k = "c_custkey"
    return f"""select {k} + {shift} as id, case when {k} % 3 = 0 then '' else {_text(f"{k} % 3")} end as unit_number,
  {_number(k)} as street_number, split_part({_street(k)}, ' ', 1) as street_name,
  (case when {k} % 3 = 0 then '' else {_text(f"{k} % 3")} || '/' end) || {_number(k)} || ' ' || {_street(k)} || ', Suburb ' || {_text(f"{_lot(k)} % 10")} || ' QLD 4220' as display_address,
  'Suburb ' || {_text(f"{_lot(k)} % 10")} as suburb,
  case when {k} % {no_area} = 0 then null else cast(300 + {k} % 700 as int) end as land_area_m2,
  case when {k} % 7 = 0 then null else cast(1 + {k} % 5 as int) end as bedrooms, cast(1 + {k} % 3 as int) as bathrooms,
  case when {_lot(k)} % 8 = 0 then 'Land' else 'House' end as property_type from customer where {where}"""


VIEWS = {
    "applications": f"""select o_orderkey as id, 'c' || {_text("o_custkey % 3")} as council_slug,
  (case o_orderkey % 4 when 0 then 'MCU' when 1 then 'COM' when 2 then 'ROL' else 'OPW' end) || '/' || {_text("extract(year from o_orderdate)")} || '/' || {_text("o_orderkey")} as application_id,
  case o_orderkey % 9 when 0 then 'Code Assessment DUAL OCCUPANCY' when 1 then 'Dwelling House (Secondary  Dwelling)' when 2 then 'Triplex development' when 3 then 'MCU - 4 dwellings on small lot' when 4 then 'Multi-unit residential' when 5 then 'Operational works' when 6 then '6 townhouses' when 7 then 'duplex and granny flat' else null end as description,
  case when o_orderkey % 11 = 0 then cast(o_orderkey % 7 as int) else null end as approved_units,
  case o_orderkey % 5 when 0 then 'Approved' when 1 then 'Approved with conditions' when 2 then 'Refused' when 3 then 'approved in part' else null end as decision_outcome,
  cast(o_orderdate as date) as lodged_date, case when o_orderkey % 6 = 0 then null else cast(o_orderdate as date) + cast(o_orderkey % 300 as int) end as decision_date,
  'Lot ' || {_text(_lot("o_custkey"))} || ' RP' || {_text(_lot("o_custkey") + " * 7")} as lot_on_plan,
  {_number("o_custkey")} || ' ' || {_street("o_custkey")} as street_address,
  case when {_lot("o_custkey")} % 10 = 9 then '' else 'Suburb ' || {_text(_lot("o_custkey") + " % 10")} end as suburb,
  case when o_orderkey % 8 = 0 then null else o_orderdate end as detail_fetched_at from orders""",
    "domain_properties": _properties(0, 5, "c_custkey % 13 <> 5"),
    "realestate_properties": _properties(1_000_000, 4, "c_custkey % 2 = 0"),
    "domain_sales": "select o_orderkey as id, o_custkey as domain_property_id, cast(o_orderdate as date) as event_date, case when o_orderkey % 17 = 0 then null else cast(floor(o_totalprice) as bigint) end as event_price, o_orderstatus <> 'P' as is_sold from orders",
    "realestate_sales": "select o_orderkey as id, o_custkey + 1000000 as realestate_property_id, cast(o_orderdate as date) as event_date, cast(floor(o_totalprice) + 1 as bigint) as event_price, case when o_orderkey % 3 = 0 then 'listed' else 'sold' end as event_type from orders",
    "documents_meta": f"""select l_orderkey * 10 + l_linenumber as id, l_orderkey as application_id,
  case l_linenumber when 1 then 'DA Form 1' when 2 then 'Plans' when 3 then 'Information Request' when 4 then 'Response to IR Cover Letter' when 5 then 'Amended Plans' when 6 then 'Specialist Reports' else 'Decision Notice' end as doc_type,
  case when min(l_partkey) % 4 = 0 then null else 'p/' || {_text("min(l_partkey)")} end as file_path, cast(floor(max(l_extendedprice)) as bigint) as file_size,
  case when min(l_suppkey) % 7 = 0 then null else min(l_shipdate) end as published_at from lineitem group by l_orderkey, l_linenumber""",
    "application_entities": "select l_orderkey as application_id, min(l_suppkey) as company_id, case l_linenumber when 1 then 'applicant' when 2 then 'agent' when 3 then 'builder' when 4 then 'architect' else 'owner' end as role, min(l_orderkey * 10 + l_linenumber) as source_doc_id from lineitem group by l_orderkey, l_linenumber",
    "companies": f"select s_suppkey as id, case when s_suppkey % 3 = 0 then null else lpad({_text('s_suppkey')}, 9, '0') end as acn, s_name || case s_suppkey % 3 when 0 then ' PTY LTD' when 1 then ' Pty. Limited' else '' end as display_name, case s_suppkey % 4 when 0 then 'unknown' else 'company' end as entity_type from supplier",
    "rates": "select case o_custkey % 4 when 0 then 'FILRHLBVD' when 1 then 'FILRHLBVDI' when 2 then 'FILRHL3YF' else 'FILRHL3YFI' end as series_id, cast(date_trunc('month', o_orderdate) as date) as month, cast(2 + max(o_orderkey) % 60 / 10.0 as double) as rate_pct from orders group by 1, 2",
    "doc_summaries": f"select l_orderkey as application_id, l_orderkey * 10 + l_linenumber as document_id, case l_linenumber when 1 then 'first' when 7 then 'last' else 'tier2' end as doc_position, case min(l_partkey) % 4 when 0 then null when 1 then '' else 'Builder ' || {_text('min(l_partkey) % 50')} end as builder_name, case min(l_suppkey) % 5 when 0 then 'unknown' when 1 then 'duplex' when 2 then 'granny' else null end as dwelling_kind from lineitem where l_linenumber in (1, 2, 6, 7) group by l_orderkey, l_linenumber",
    "build_features": "select l_orderkey as application_id, case when l_linenumber = 2 then 'build_features_drawings' else 'build_features_design_report' end as template_key, cast(max(l_quantity) as int) % 6 as bedrooms, cast(max(l_quantity) as int) % 4 as bathrooms, cast(max(l_quantity) as int) * 20 as site_area_m2 from lineitem where l_linenumber in (2, 6) group by l_orderkey, l_linenumber",
    "discovered_urls": f"select '1/' || {_number('c_custkey')} || ' ' || {_street('c_custkey')} as search_address, case when c_custkey % 2 = 0 then 'domain_property' else null end as url_kind, cast('1999-06-01' as date) as discovered_at from customer where c_custkey % 15 = 0",
    "windows": "select 'c' || cast(extract(month from o_orderdate) % 3 as varchar(9)) as slug, cast(date_trunc('month', o_orderdate) as date) as date_from, max(cast(o_orderdate as date)) as date_to, case cast(extract(month from o_orderdate) as int) % 4 when 0 then 'completed' when 1 then 'running' when 2 then 'failed' else 'aborted' end as status, count(*) as apps, min(o_orderdate) as started_at, case when cast(extract(month from o_orderdate) as int) % 4 = 1 then null else max(o_orderdate) end as finished_at from orders group by 1, 2, 4, extract(month from o_orderdate)",
    "json_pages": f"""select page_id, url, '<html><script id="__NEXT_DATA__" type="application/json">{{"query":{{"listingType":"sold"}},"listings":{{"' || {_text("page_id")} || '":{{"price":"$' || {_text("page_id % 90 + 10")} || ',000","beds":' || {_text("page_id % 6")} || '}}}}}}</script></html>' as html from pages""",
}


def tables(spark: SparkSession, sf_dir: str, *names: str) -> dict[str, DataFrame]:
    """The named base tables and views, as DataFrames; only tables that are asked for are read."""
    out = {}
    for name in names:
        if name in VIEWS:
            for base in BASE:
                if f"from {base}" in VIEWS[name]:
                    spark.read.parquet(f"{sf_dir}/{base}.parquet").createOrReplaceTempView(base)
            out[name] = spark.sql(VIEWS[name])
        else:
            out[name] = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return out


def twin(sql: str, *views: str) -> str:
    """SQL with the named views in front, for the oracle."""
    head = ",\n".join(f"{v} as ({VIEWS[v]})" for v in views)
    if not head:
        return sql
    body = sql.strip()
    return f"with {head},\n{body[5:]}" if body.lower().startswith("with ") else f"with {head}\n{body}"

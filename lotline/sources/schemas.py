"""Typed scans of the entity tables: fixed schemas, with missing columns as nulls and wrong types as errors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

PLACE = "display_address string, unit_number string, street_number string, street_name string, suburb string, postcode string, state string, lat decimal(9,6), lng decimal(9,6)"
ROOMS = "property_type string, bedrooms int, bathrooms int"
VALUES = "valuation_low bigint, valuation_mid bigint, valuation_high bigint, valuation_confidence string, rent_estimate_weekly int, rent_yield_pct decimal(5,2)"
NAMES = "applicant_name string, applicant_acn string, applicant_abn string, applicant_entity_type string, applicant_agent_name string, builder_name string, architect_name string, owner_name string, owner_acn string, owner_abn string, owner_entity_type string, dwelling_count int, dwelling_kind string, project_description string, lot_on_plan string, street_address string"
LISTED = "url string, listing_kind string, listing_status string, display_address string, property_type string, price_text string, sold_price bigint, sold_date date, sale_method string, bedrooms int, bathrooms int, car_spaces int, land_area_m2 int, agency_name string, agent_name string, description string, raw_listing_json string, fetched_at timestamp_ntz"
#: The columns of each entity table. Money and ids are long, JSON stays text.
SCHEMAS = {
    "raw_pages": "id bigint, source string, page_type string, url string, url_hash binary, suburb string, postcode string, page_index int, http_status int, fetched_at timestamp_ntz, content_hash binary, body_gz binary, headers_json string, parsed_at timestamp_ntz, parse_error string",
    "properties": "id bigint, match_key string, unit_number string, street_number string, street_name string, street_norm string, suburb string, suburb_norm string, postcode string, state string, property_type string, lat decimal(9,6), lng decimal(9,6), first_seen_at timestamp_ntz",
    "listings": "id bigint, property_id bigint, source string, source_listing_id string, raw_page_id bigint, listing_kind string, status string, price_text string, price_min bigint, price_max bigint, beds int, baths int, parking int, property_type string, land_size_m2 int, agent_name string, agency_name string, url string, first_seen_at timestamp_ntz, last_seen_at timestamp_ntz",
    "sales": "id bigint, property_id bigint, source string, source_listing_id string, raw_page_id bigint, sold_date date, sold_price bigint, sale_method string",
    "applications": "id bigint, council_slug string, vendor string, application_id string, application_url string, type_code string, application_type string, description string, approved_units int, status string, decision_outcome string, decision_authority string, lodged_date date, decision_date date, n_submissions int, conditions_count int, internal_property_id string, lot_on_plan string, raw_address string, street_address string, suburb string, postcode string, state string, match_key string, raw_listing_row string, raw_detail_fields string, list_first_seen_at timestamp_ntz, detail_fetched_at timestamp_ntz, docs_fetched_at timestamp_ntz, summarised_at timestamp_ntz, last_seen_at timestamp_ntz",
    "documents_meta": "id bigint, application_id bigint, doc_oid string, doc_type string, doc_kind string, title string, source_url string, file_path string, content_hash binary, mime_type string, file_size bigint, page_count int, extracted_text string, downloaded_at timestamp_ntz, published_at timestamp_ntz",
    "windows": "id bigint, slug string, vendor string, backend_name string, date_from date, date_to date, started_at timestamp_ntz, finished_at timestamp_ntz, status string, pages_walked int, apps_yielded int, error string",
    "rates": "series_id string, series_label string, month date, rate_pct decimal(6,3), source string, fetched_at timestamp_ntz",
    "domain_properties": f"id bigint, raw_page_id bigint, domain_property_id string, domain_apollo_id string, url_slug string, url string, {PLACE}, street_type string, lot_number string, plan_number string, {ROOMS}, parking_spaces int, land_area_m2 int, internal_area_m2 int, {VALUES}, valuation_date date, raw_property_json string, fetched_at timestamp_ntz",
    "domain_sales": "id bigint, domain_property_id bigint, raw_page_id bigint, event_date date, event_price bigint, category string, price_description string, is_sold boolean, is_major_event boolean, days_on_market int, agency_name string, agency_profile_url string, raw_event_json string",
    "realestate_properties": f"id bigint, raw_page_id bigint, rea_property_id bigint, url_slug string, url string, pca_property_url string, {PLACE}, {ROOMS}, car_spaces int, land_area_m2 int, floor_area_m2 int, year_built int, status_label string, market_status string, {VALUES}, raw_property_json string, fetched_at timestamp_ntz",
    "realestate_sales": "id bigint, realestate_property_id bigint, raw_page_id bigint, event_date date, event_price bigint, price_text string, event_type string, agency_name string, listing_url string, raw_event_json string",
    "domain_listings": f"id bigint, raw_page_id bigint, domain_property_id bigint, domain_listing_id bigint, {LISTED}",
    "realestate_listings": f"id bigint, raw_page_id bigint, realestate_property_id bigint, rea_listing_id bigint, {LISTED}, floor_area_m2 int",
    "discovered_urls": "id bigint, search_address string, search_query string, url string, url_hash binary, url_kind string, search_engine string, discovered_at timestamp_ntz, fetched_at timestamp_ntz",
    "property_scrape_attempts": "id bigint, source string, display_address string, url string, http_status int, result string, error_message string, attempted_at timestamp_ntz",
    "doc_summaries": f"id bigint, document_id bigint, application_id bigint, doc_type string, doc_position string, tier int, model string, prompt_version string, summarised_at timestamp_ntz, template_key string, text_chars int, text_sha256 binary, pages_used string, extraction_method string, {NAMES}, confidence string, raw_response_json string",
    "summaries": f"application_id bigint, {NAMES}, source_doc_ids map<string,bigint>, applicant_company_id bigint, applicant_agent_company_id bigint, builder_company_id bigint, architect_company_id bigint, owner_company_id bigint, n_docs int, n_docs_downloaded int, total_bytes bigint, total_pages int, n_information_requests int, status string",
    "companies": "id bigint, display_name string, norm_name string, acn string, abn string, entity_type string, registry_status string, registry_fetched_at timestamp_ntz, locality string",
    "application_entities": "application_id bigint, company_id bigint, role string, is_primary boolean, source_doc_id bigint, source_field string, extractor string, confidence string, extracted_at timestamp_ntz",
    "entity_evidence": "application_id bigint, source_doc_id bigint, extractor string, span_start int, span_end int, candidate_name string, candidate_role string, confidence string, layout string, status string, truth_role string, rule string, rule_version string",
    "doc_fingerprints": "application_id bigint, source_doc_id bigint, kind string, raw_value string, normalized_value string, span_start int, span_end int, page_index int, layout string, resolved_company_id bigint, resolved_via string",
}


def schema_of(spark: SparkSession, name: str) -> StructType:
    return spark.createDataFrame([], SCHEMAS[name]).schema


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """An entity table from Parquet in its fixed schema; only its columns are read.

    Columns that the files lack are null. A column of a type that does not widen to the schema's is an
    error when it is read.
    """
    return spark.read.schema(schema_of(spark, name)).parquet(f"{folder}/{name}.parquet")


def conformed(df: DataFrame, name: str) -> DataFrame:
    """df in the table's schema: columns in its order, missing ones null, others left out."""
    wanted = schema_of(df.sparkSession, name)
    return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in wanted])

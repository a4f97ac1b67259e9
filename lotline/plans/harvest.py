"""Jobs that turn document text into entities: harvest, fingerprint resolution, application summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lotline.functions.entities import firm_seed, name_candidates
from lotline.functions.letters import applicant_emissions, brand_blocks, client_role, council_emissions, is_entity_value, label_role, title_block
from lotline.functions.text import repair_street_address, split_council_address, squeezed
from lotline.operators.joins import lookup_company
from lotline.operators.rollups import longest_in_priority, priority_merge, process_stats
from lotline.operators.staging import settled
from lotline.plans.companies import keyed, match_existing, resolve_companies, summary_status
from lotline.plans.spans import label_value_pairs

PLAN_FIELDS = "struct<name:string,role:string,acn:string,abn:string,licence:string,confidence:string,span_start:int,span_end:int>"


def emissions(docs: DataFrame) -> DataFrame:
    """doc_id, application_id, nth, extractor, name, role, source_field, confidence, entity_type, acn, abn, span_start, span_end.

    docs: doc_id, application_id, doc_type, text. Plans and drawings give the firms of their title blocks;
    other documents what a council's letter names, or else the firm and signatory of an applicant's
    letter. The span is where the name stands in the text, null if it is not there word for word.
    """
    t = F.lower(F.coalesce("doc_type", F.lit("")))
    is_plan = t.contains("plan") | t.contains("drawing")
    rows = docs.select("doc_id", "application_id", "text", is_plan.alias("is_plan")).where("text is not null")
    blocks = lambda c, field: F.transform(c.cast(f"array<{PLAN_FIELDS}>"), lambda b: F.struct(F.lit("plans_title_regex").alias("extractor"), b["name"].alias("name"), b["role"].alias("role"), F.lit(field).alias("source_field"), b["confidence"].alias("confidence"), F.lit("company").alias("entity_type"), b["acn"].alias("acn"), b["abn"].alias("abn"), b["span_start"].alias("span_start"), b["span_end"].alias("span_end")))
    # Outer, as of a plain explode Spark infers a filter that reads every text a second time, below the joins and groups that made it.
    plans = rows.where("is_plan").select("doc_id", "application_id", F.posexplode_outer(F.concat(blocks(title_block(F.col("text")), "plans_title_block"), blocks(brand_blocks(F.col("text")), "plans_url_inferred"))).alias("nth", "e")).where("nth is not null")
    letters = rows.where("not is_plan").withColumn("council", council_emissions(F.col("text"))).withColumn("by_council", F.size("council") > 0)
    letters = letters.withColumns({"own": F.when(F.col("by_council"), F.col("council")).otherwise(applicant_emissions(F.col("text"))), "extractor": F.when(F.col("by_council"), "correspondence_regex").otherwise("applicant_letter_regex")})
    found = letters.select("doc_id", "application_id", "extractor", "text", F.posexplode_outer("own").alias("nth", "e")).where("nth is not null")
    at = F.expr("locate(e.name, text)")
    found = found.select("doc_id", "application_id", "nth", "extractor", "e.*", F.when(at > 0, at - 1).alias("span_start")).withColumns({"span_end": F.col("span_start") + F.length("name"), "acn": F.lit(None).cast("string"), "abn": F.lit(None).cast("string")})
    return found.unionByName(plans.select("doc_id", "application_id", "nth", "e.*"))


def tabular_entities(labels_and_spans: DataFrame) -> DataFrame:
    """doc_id, page, name, role, span: values next to role labels of title blocks. Spans: doc_id, page, span, text and a box."""
    spans = labels_and_spans.withColumn("role", label_role(F.col("text")))
    values = labels_and_spans.where(is_entity_value(F.col("text")))
    labels = spans.where("role is not null")
    pairs = label_value_pairs(labels.drop("role"), values)
    out = pairs.join(labels.select("doc_id", "page", F.col("span").alias("l_span"), "role"), ["doc_id", "page", "l_span"])
    first = out.groupBy("doc_id", "page", F.lower("v_text").alias("key")).agg(F.min_by(F.struct("v_text", "role", "v_span"), F.struct("l_span")).alias("b"))
    return first.select("doc_id", "page", F.col("b.v_text").alias("name"), F.when(F.col("b.role") == "client", client_role(F.col("b.v_text"))).otherwise(F.col("b.role")).alias("role"), F.col("b.v_span").alias("span"))


def emission_stats(every: DataFrame) -> DataFrame:
    """Per extractor: documents, emissions, and emissions that stand in their text. Companies take no part."""
    return every.groupBy("extractor").agg(F.count_distinct("doc_id").alias("n_docs"), F.count(F.lit(1)).alias("n_emissions"), F.count("span_start").alias("n_evidence"))


def harvest_entities(docs: DataFrame, companies: DataFrame) -> dict[str, DataFrame]:
    """evidence (one row per emission that stands in its text), links (per application, company, role, document and extractor), companies with the new ones, stats.

    The first applicant a document names is its primary one. Of emissions of one link the last counts.
    """
    every = emissions(docs)
    first = F.min(F.when(F.col("role") == "applicant", F.col("nth"))).over(Window.partitionBy("doc_id"))
    every = every.withColumn("is_primary", (F.col("role") == "applicant") & (F.col("nth") == first))
    resolved, all_companies = resolve_companies(every, companies)
    links = resolved.groupBy("application_id", "company_id", "role", F.col("doc_id").alias("source_doc_id"), "extractor").agg(F.max_by(F.struct("source_field", "confidence"), "nth").alias("e"), F.bool_or(F.coalesce("is_primary", F.lit(False))).alias("is_primary"))
    evidence = every.where("span_start is not null").select("application_id", F.col("doc_id").alias("source_doc_id"), "extractor", "span_start", "span_end", F.col("name").alias("candidate_name"), F.col("role").alias("candidate_role"), "confidence", F.lit("predicted").alias("status"))
    return {"evidence": evidence, "links": links.select("application_id", "company_id", "role", "source_doc_id", "extractor", "e.*", "is_primary"), "companies": all_companies, "stats": emission_stats(every)}


def firm_words(prints: DataFrame) -> DataFrame:
    """application_id, source_doc_id, kind, normalized_value, seed: fingerprints that hint at a firm."""
    return prints.withColumn("seed", firm_seed(F.col("kind"), F.col("normalized_value"))).where("seed is not null")


#: Letters and digits that belong together; keys that one row of an application holds.
TOKEN = r"[\p{L}\p{Nd}_]+"
MOST_KEYS = 1000


def tokens_of(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN), F.lit(0))


def texts_with_keys(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """application_id, doc_id, text, key: which of its application's keys a text holds; every text is cut into tokens once.

    wanted: application_id, key; a key is one token or two with a blank between. The keys of an application
    come as sets of bounded size; a text's tokens and pairs of neighbours are intersected with a set at once.
    """
    own = wanted.select("application_id", "key").distinct()
    many = own.groupBy("application_id").agg(F.ceil(F.count(F.lit(1)) / MOST_KEYS).alias("sets"))
    sets = own.join(many, "application_id").groupBy("application_id", F.pmod(F.xxhash64("key"), F.col("sets")).alias("set")).agg(F.collect_set("key").alias("keys"))
    read = docs.select("application_id", "doc_id", "text").where("text <> ''").join(sets.drop("set"), "application_id").withColumn("words", tokens_of(F.col("text")))
    pairs = F.zip_with("words", F.slice("words", 2, F.size("words")), lambda a, b: F.concat(a, F.lit(" "), b))
    read = read.withColumn("grams", F.concat("words", pairs))
    return read.select("application_id", "doc_id", "text", F.explode(F.array_intersect("grams", "keys")).alias("key"))


def names_in_siblings(prints: DataFrame, docs: DataFrame) -> DataFrame:
    """application_id, seed, name: the firm's name as another document of the application spells it.

    Documents that carry a fingerprint of the seed themselves are not read. Candidate spellings go in
    order, then documents by id; between the words of a spelling anything but letters and digits may
    stand. Texts are searched for the first one or two tokens of all spellings at once; the whole spelling
    is looked for only where they stand.
    """
    seeds = firm_words(prints)
    spelled = seeds.select("application_id", "seed").distinct().select("application_id", "seed", F.posexplode(name_candidates(F.col("seed"))).alias("place", "candidate"))
    wanted = spelled.withColumn("key", F.concat_ws(" ", F.slice(tokens_of(F.col("candidate")), 1, 2))).where("key <> ''")
    pairs = texts_with_keys(docs, wanted).join(wanted, ["application_id", "key"])
    own = seeds.select("application_id", "seed", F.col("source_doc_id").alias("doc_id")).distinct()
    pairs = pairs.join(own, ["application_id", "seed", "doc_id"], "left_anti")
    pattern = F.concat(F.lit(r"(?i)\b\Q"), F.replace("candidate", F.lit(" "), F.lit(r"\E\b\W*\b\Q")), F.lit(r"\E\b"))
    found = pairs.withColumn("name", squeezed(F.call_function("regexp_extract", F.col("text"), pattern, F.lit(0)))).where("name <> ''")
    return found.groupBy("application_id", "seed").agg(F.min_by("name", F.struct("place", "doc_id")).alias("name"))


def resolve_fingerprints(prints: DataFrame, docs: DataFrame, links: DataFrame, companies: DataFrame) -> dict[str, DataFrame]:
    """prints with company_id, and new links of the companies that no link of the application has yet.

    A found name goes to a company linked to the application whose name holds it or is held by it, else
    to the company of that name, else to a new one.
    """
    found = settled(names_in_siblings(prints, docs), "found")
    linked = links.select("application_id", "company_id").distinct().join(companies.select(F.col("id").alias("company_id"), "display_name"), "company_id")
    known = match_existing(found.select("application_id", "name").distinct(), linked)
    rest = found.join(known.select("application_id", "name"), ["application_id", "name"], "left_anti").select("application_id", "name", F.lit(None).cast("string").alias("acn")).distinct()
    resolved, all_companies = resolve_companies(rest, companies)
    named = found.join(known.unionByName(resolved.select("application_id", "name", "company_id")), ["application_id", "name"])
    bound = firm_words(prints).join(named, ["application_id", "seed"])
    new = bound.join(links.select("application_id", "company_id"), ["application_id", "company_id"], "left_anti")
    new = new.groupBy("application_id", "company_id").agg(F.min("source_doc_id").alias("source_doc_id"))
    return {"prints": bound.select("application_id", "source_doc_id", "kind", "normalized_value", "name", "company_id"), "links": new.withColumns({"role": F.lit("architect"), "extractor": F.lit("fingerprint_resolver_v1"), "confidence": F.lit("medium")}), "companies": all_companies}


# In which order the positions of documents decide each field of a summary.
SUMMARY_ORDERS = {
    "applicant_name": ["first", "tier2", "last"], "applicant_acn": ["first", "tier2", "last"], "builder_name": ["first", "tier2", "last"], "architect_name": ["tier2", "first", "last"], "owner_name": ["first", "tier2", "last"],
    "lot_on_plan": ["first", "last", "tier2"], "street_address": ["first", "last", "tier2"], "dwelling_kind": ["last", "tier2", "first"], "dwelling_count": ["last", "tier2", "first"],
}
DESCRIPTION_ORDER = ["tier2", "first", "last"]


def application_summaries(rows: DataFrame, docs: DataFrame, apps: DataFrame, companies: DataFrame) -> DataFrame:
    """One row per application with summarised documents: merged fields and their documents, description, address, process counts, status, applicant company.

    rows: application_id, document_id, doc_position, project_description and the fields of SUMMARY_ORDERS.
    apps: id, raw_address, lodged_date, decision_date. The street comes from the raw address where that
    splits, else from the documents, with its number put back.
    """
    texts = rows.select(*[F.col(c).cast("string").alias(c) if c in SUMMARY_ORDERS else F.col(c) for c in rows.columns])
    out = priority_merge(texts, SUMMARY_ORDERS)
    out = out.join(longest_in_priority(rows, "project_description", DESCRIPTION_ORDER), "application_id", "left").join(process_stats(docs), "application_id", "left")
    tier = rows.groupBy("application_id").agg(F.bool_or(F.col("doc_position") == "tier2").alias("has_tier2"), F.count(F.lit(1)).alias("n_docs_summarised"))
    own = apps.select(F.col("id").alias("application_id"), "raw_address", F.datediff("decision_date", "lodged_date").alias("days_lodge_to_decide"))
    out = out.join(tier, "application_id").join(own, "application_id", "left")
    a = split_council_address(F.col("raw_address"))
    street = F.when(a["street"].isNotNull(), F.concat(a["street"], F.lit(", "), a["suburb"], F.lit(" "), a["state"], F.lit(" "), a["postcode"])).otherwise(repair_street_address(F.col("raw_address"), F.col("street_address")))
    missing = F.when(F.col("dwelling_count").isNull() | F.col("dwelling_kind").isNull() | F.col("applicant_name").isNull() | F.coalesce("builder_name", "architect_name").isNull(), 1).otherwise(0)
    out = out.withColumns({"street_address": street, "status": summary_status(missing, F.col("has_tier2"))}).drop("raw_address", "has_tier2")
    names = out.where("applicant_name is not null").select("application_id", F.col("applicant_name").alias("name"), F.col("applicant_acn").alias("acn"))
    found = lookup_company(keyed(names, "name"), keyed(companies)).select("application_id", F.col("company_id").alias("applicant_company_id"))
    return out.join(found, "application_id", "left")

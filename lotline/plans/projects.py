"""The projects list: every application with its people, documents, site, sales before and after, and status.

Streets are matched with each portal's properties once, and the matches are written to the shared
folder; each fact is worked out from them for all applications, by street, and joined at the end.
Nothing is looked up row by row.
"""

from __future__ import annotations

import datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotline.functions.classify import classify_kind, dwelling_count, dwelling_kind, every, is_approved, kind_predicate
from lotline.operators.joins import asof_prev, coalesce_sources, events_after, lot_matches, matched, totals_after, unit_children, unit_evidence
from lotline.operators.rollups import developer_counts, docs_rollup, entities_by_role
from lotline.operators.staging import settled

LOOKBACK_MONTHS = 120
#: The portals, best first, and what makes a sale event of theirs a sale.
PORTALS = {"domain": "is_sold", "realestate": "event_type = 'sold'"}


def stacked(tables: dict[str, DataFrame]) -> DataFrame:
    """Tables of several portals as one, with `portal`."""
    return reduce(DataFrame.unionByName, [df.withColumn("portal", F.lit(p)) for p, df in tables.items()])


def filter_applications(apps: DataFrame, kind: str | None = None, suburb: str | None = None, type_code: str | None = None, date_from: datetime.date | None = None, date_to: datetime.date | None = None, q: str | None = None) -> DataFrame:
    """The list filters; each is left out unless given. q is looked for in description, street and id, in any case."""
    needle = (q or "").lower()
    return apps.where(
        every(
            kind_predicate(kind, F.col("description"), F.col("approved_units")),
            F.upper("suburb") == suburb.upper() if suburb else None,
            F.upper(F.substring_index("application_id", "/", 1)) == type_code.upper() if type_code else None,
            F.col("lodged_date") >= F.lit(date_from) if date_from else None,
            F.col("lodged_date") <= F.lit(date_to) if date_to else None,
            F.lower("description").contains(needle) | F.lower("street_address").contains(needle) | F.lower("application_id").contains(needle) if q else None,
        )
    )


def site_facts(matches: DataFrame) -> DataFrame:
    """Per street and portal, over the parent rows: land area, rooms, property type, as d_... and r_...

    matches: the portals' street matches in one table, with `portal`.
    """
    of = lambda p, c: F.max(F.when(F.col("portal").startswith(p), F.col(c)))
    facts = {"land": "land_area_m2", "beds": "bedrooms", "baths": "bathrooms", "kind": "property_type"}
    return matches.where("unit_number = ''").groupBy("street_address").agg(*[of(p, c).alias(f"{p}_{a}") for p in "dr" for a, c in facts.items()])


def unit_rooms(units: DataFrame) -> DataFrame:
    """Per street and portal: rooms summed over units (each unit's greatest count), and how many units have one, as du_... and ru_...

    A portal without a unit on the street counts 0 and sums to null.
    """
    per = units.groupBy("street_address", "portal", "unit_number").agg(F.max("bedrooms").alias("b"), F.max("bathrooms").alias("t"))
    here = lambda p: F.col("portal").startswith(p)
    of = lambda p, c: F.when(here(p), F.col(c))
    own = lambda p: [F.sum(of(p, "b")).alias(f"{p}u_beds"), F.count(of(p, "b")).alias(f"{p}u_n_beds"), F.sum(of(p, "t")).alias(f"{p}u_baths"), F.count(of(p, "t")).alias(f"{p}u_n_baths"), F.count_if(here(p)).alias(f"{p}u_n_units")]
    return per.groupBy("street_address").agg(*own("d"), *own("r"))


def pre_sale(apps: DataFrame, matches: DataFrame, sales: DataFrame, fk: str, sold) -> DataFrame:
    """Per application the last priced sale at its address before lodgement, at most ten years back."""
    events = matches.select("street_address", F.col("id").alias(fk)).join(sales.where(sold & F.col("event_price").isNotNull()).withColumnRenamed("id", "sale_id"), fk)
    return asof_prev(apps, events, ["street_address"], ["id"], "lodged_date", "event_date", "sale_id", ["event_price", "event_date"], LOOKBACK_MONTHS)


SALE = ["unit_number", "display_address", "sold_price", "sold_date"]


def street_sales(units: DataFrame, sales: DataFrame) -> DataFrame:
    """Per street each sold unit's latest date and greatest price, each by itself; like rows once."""
    latest = sales.where(F.col("is_sold") & F.col("event_price").isNotNull()).groupBy("domain_property_id").agg(F.max("event_date").alias("sold_date"), F.max("event_price").alias("sold_price"))
    rows = units.select("street_address", F.col("id").alias("domain_property_id"), "unit_number", "display_address").join(latest, "domain_property_id")
    return settled(rows.select("street_address", *SALE).distinct(), "street_sales")


def by_repetition(apps: DataFrame) -> tuple[DataFrame, DataFrame]:
    """id, street_address, decision_date of the ids that stand in one row, and of the others."""
    key = apps.select("id", "street_address", "decision_date")
    repeated = settled(key.groupBy(F.col("id").alias("_id")).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_id"), "repeated")
    same = F.col("id").eqNullSafe(F.col("_id"))
    return key.join(repeated, same, "left_anti"), key.join(repeated, same, "left_semi")


def unit_sales(apps: DataFrame, units: DataFrame, sales: DataFrame) -> DataFrame:
    """Per application and sold unit the latest date and the greatest price, each by itself, if after the decision.

    Like sales of a street become one before they meet its applications, so that only the rows of repeated ids are
    compared afterwards: what is put out is not shuffled.
    """
    of_street = street_sales(units, sales)
    later = lambda rows: events_after(rows, of_street, ["street_address"], "decision_date", "sold_date").select("id", *SALE)
    once, more = by_repetition(apps)
    return later(once).unionByName(later(more).distinct())


def unit_sale_counts(apps: DataFrame, units: DataFrame, sales: DataFrame) -> DataFrame:
    """id, n_sold: how many rows unit_sales has, worked out without making them but for repeated ids."""
    of_street = street_sales(units, sales)
    once, more = by_repetition(apps)
    n = totals_after(once, of_street, ["street_address"], ["id"], "decision_date", "sold_date", {"n_sold": F.lit(1).cast("long")})
    rest = events_after(more, of_street, ["street_address"], "decision_date", "sold_date").select("id", *SALE).distinct()
    return n.unionByName(rest.groupBy("id").agg(F.count(F.lit(1)).alias("n_sold")))


def portal_properties(t: dict[str, DataFrame]) -> DataFrame:
    fields = ["id", "unit_number", "street_number", "street_name", "suburb", "display_address", "land_area_m2", "bedrooms", "bathrooms", "property_type"]
    return stacked({p: t[f"{p}_properties"].select(fields) for p in PORTALS})


def pre_sales(t: dict[str, DataFrame], key: DataFrame, matches: DataFrame) -> DataFrame:
    """id, pre, pre_source: per application (id, street_address, lodged_date) the last sale before lodgement, of the first portal that has one."""
    sales = stacked({p: t[f"{p}_sales"].where(F.expr(s) & F.col("event_price").isNotNull()).select(F.col(f"{p}_property_id").alias("property_id"), F.col("id").alias("sale_id"), "event_price", "event_date") for p, s in PORTALS.items()})
    events = matches.select("portal", "street_address", F.col("id").alias("property_id")).join(sales, ["portal", "property_id"])
    lodged = key.select("id", "street_address", "lodged_date").withColumn("portal", F.explode(F.array(*map(F.lit, PORTALS))))
    pre = asof_prev(lodged, events, ["street_address", "portal"], ["id", "portal"], "lodged_date", "event_date", "sale_id", ["event_price", "event_date"], LOOKBACK_MONTHS)
    return coalesce_sources(pre, ["id"], F.struct("event_price", "event_date"), "portal", list(PORTALS)).withColumnsRenamed({"value": "pre", "source": "pre_source"})


def listed(t: dict[str, DataFrame]) -> DataFrame:
    """id, street_address and decision_date of every application on the list: what projects(limit=None) puts out, without the other facts."""
    key = t["applications"].select("id", "street_address", "lodged_date", "decision_date")
    matches = settled(lot_matches(key.select("street_address").distinct(), portal_properties(t)), "matches")
    return key.drop("lodged_date").join(pre_sales(t, key, matches).select("id"), "id")


def projects(t: dict[str, DataFrame], as_of: datetime.date, analyzed_only: bool = False, limit: int | None = 50, offset: int = 0, **filters) -> DataFrame:
    """The list, newest lodgement first. limit=None gives all rows (for further work), else 1 to 500."""
    apps = filter_applications(t["applications"], **filters)
    desc, n = F.col("description"), F.col("approved_units")
    apps = apps.withColumns({"dwelling_count": dwelling_count(desc, n), "dwelling_kind": dwelling_kind(desc, n), "kind": classify_kind(desc, n)})
    key = apps.select("id", "street_address", "lodged_date", "decision_date")
    streets = key.select("street_address").distinct()
    # Both portals go through one plan; what several facts read is worked out once.
    props = portal_properties(t)
    matches = settled(lot_matches(streets, props), "matches")
    units = settled(unit_children(matches, props, ("portal",)), "units")
    own_events = lambda p, sales: units.where(F.col("portal") == p).select("street_address", F.col("id").alias(f"{p}_property_id")).join(sales, f"{p}_property_id")

    # Facts of a street are worked out per street and meet the applications' ids; the wide rows come in last, once.
    sold = own_events("domain", t["domain_sales"].select("domain_property_id", "event_date", "event_price", "is_sold"))
    listed = own_events("realestate", t["realestate_sales"].select("realestate_property_id", "event_date"))
    seen = unit_evidence(streets, t["discovered_urls"])
    signs = [df.select("street_address", F.col(c).cast("timestamp").alias("at")) for df, c in ((listed, "event_date"), (seen, "discovered_at"))]
    last_sign = signs[0].unionByName(signs[1]).groupBy("street_address").agg(F.max("at").alias("last_sign"))
    narrow = key.drop("lodged_date")
    for facts in (site_facts(matches), unit_rooms(units), last_sign):
        narrow = narrow.join(facts, "street_address", "left")

    pre = pre_sales(t, key, matches)
    narrow = narrow.join(pre, "id").withColumn("s_later", F.col("last_sign") > F.col("decision_date")).drop("street_address", "decision_date", "last_sign")
    priced = F.when(F.col("is_sold"), F.col("event_price"))
    after = totals_after(key.select("id", "street_address", "decision_date"), sold, ["street_address"], ["id"], "decision_date", "event_date", {"post_total": priced, "n_post_sales": priced.isNotNull().cast("long")})
    narrow = narrow.join(after.withColumn("d_later", F.lit(True)), "id", "left")

    ents = entities_by_role(t["application_entities"], t["companies"])
    counts = developer_counts(t["application_entities"]).select(F.col("company_id").alias("applicant_company_id"), F.col("n_projects").alias("developer_project_count"))
    narrow = narrow.join(ents.join(counts, "applicant_company_id", "left").withColumnRenamed("application_id", "id"), "id", "inner" if analyzed_only else "left")
    narrow = narrow.join(docs_rollup(t["documents_meta"]).withColumnRenamed("application_id", "id"), "id", "left")
    drawings = F.col("template_key") == "build_features_drawings"
    top = lambda c, where: F.max(F.when(where & (F.col(c) > 0), F.col(c)))
    features = t["build_features"].groupBy(F.col("application_id").alias("id")).agg(top("site_area_m2", F.lit(True)).alias("f_land"), top("bedrooms", drawings).alias("f_beds"), top("bathrooms", drawings).alias("f_baths"))
    out = apps.join(narrow.join(features, "id", "left"), "id")

    units_done = lambda p, c: F.when(F.col(f"{p}u_{c}") >= F.col("dwelling_count"), F.col(f"{p}u_{c.removeprefix('n_')}"))
    rooms = lambda c: F.coalesce(units_done("d", f"n_{c}"), units_done("r", f"n_{c}"), F.col(f"f_{c}") * F.nullif("dwelling_count", F.lit(0))).cast("long")
    area = [("d_land", "domain"), ("r_land", "realestate"), ("f_land", "da_docs")]
    enough = lambda p: matched(F.coalesce(F.col(f"{p}u_n_units"), F.lit(0)) >= F.col("dwelling_count"))
    n_post = F.coalesce("n_post_sales", F.lit(0))
    post = F.nullif(F.coalesce("post_total", F.lit(0)), F.lit(0))
    status = (
        F.when(~is_approved(F.col("decision_outcome")), None).when(n_post > 0, "built_sold").when(F.coalesce("d_later", F.lit(False)) | F.coalesce("s_later", F.lit(False)), "built_unsold")
        .when(F.col("decision_date") < F.add_months(F.lit(as_of), -36), "abandoned_likely").otherwise("unknown")
    )
    out = out.select(
        "id", "council_slug", "application_id", "kind", "suburb", "street_address", "decision_outcome", "lodged_date", "decision_date", "approved_units", "description", "lot_on_plan",
        "applicant_name", "applicant_acn", "applicant_entity_type", "applicant_agent_name", "developer_project_count", "builder_name", "architect_name",
        "dwelling_count", "dwelling_kind", F.when(F.col("applicant_company_id").isNotNull() | (F.col("n_docs") > 0), "derived").alias("insight_status"),
        "n_docs", "n_info_requests", "n_amendments", "total_bytes", F.datediff("decision_date", "lodged_date").alias("days_lodge_to_decide"),
        F.coalesce(*[F.col(c) for c, _ in area]).cast("long").alias("site_area_m2"), F.coalesce(*[F.when(F.col(c).isNotNull(), s) for c, s in area]).alias("site_area_source"),
        F.col("pre.event_price").alias("pre_price"), F.col("pre.event_date").alias("pre_date"), "pre_source",
        post.alias("post_total"), n_post.alias("n_post_sales"), (post - F.col("pre.event_price")).alias("gross_spread"),
        F.coalesce("d_beds", "r_beds").alias("pre_bedrooms"), F.coalesce("d_baths", "r_baths").alias("pre_bathrooms"), F.col("d_kind").alias("pre_property_type"),
        rooms("beds").alias("post_bedrooms"), rooms("baths").alias("post_bathrooms"),
        F.when(enough("d"), "domain").when(enough("r"), "realestate").when(F.coalesce("f_beds", "f_baths").isNotNull() & (F.col("dwelling_count") > 0), "da_docs").alias("post_rooms_source"),
        status.alias("built_status"),
    )
    if limit is None:
        return out
    return out.orderBy(F.desc("lodged_date"), F.desc("id")).offset(offset).limit(min(max(limit, 1), 500))


def with_unit_sales(rows: DataFrame, apps: DataFrame, units: DataFrame, sales: DataFrame) -> DataFrame:
    """rows (id, street_address and decision_date of applications) with unit_sales: an array of structs in order of unit number.

    A street's sales are nested once, and each row takes those after its decision. Only rows of ids that
    several applications share collect theirs from unit_sales' rows.
    """
    of_street = street_sales(units, sales)
    listed = F.array_sort(F.collect_list(F.struct(*SALE)))
    none = F.array().cast("array<struct<unit_number:string,display_address:string,sold_price:bigint,sold_date:date>>")
    once, more = by_repetition(apps)
    ids = more.select(F.col("id").alias("_id")).distinct()
    same = F.col("id").eqNullSafe(F.col("_id"))
    whole = of_street.groupBy("street_address").agg(listed.alias("_every"))
    own = rows.join(ids, same, "left_anti").join(whole, "street_address", "left")
    own = own.withColumn("unit_sales", F.coalesce(F.filter("_every", lambda u: u["sold_date"] > F.col("decision_date")), none)).drop("_every")
    pairs = events_after(more, of_street, ["street_address"], "decision_date", "sold_date").select(F.col("id").alias("_id"), *SALE).distinct()
    shared = rows.join(ids, same, "left_semi").join(pairs.groupBy("_id").agg(listed.alias("unit_sales")), same, "left").drop("_id")
    return own.unionByName(shared.withColumn("unit_sales", F.coalesce("unit_sales", none)))


def application_detail(apps: DataFrame, docs: DataFrame) -> DataFrame:
    """Applications with their documents nested in order of publication, unpublished ones last."""
    entry = F.struct(F.col("published_at").isNull().alias("undated"), "published_at", "id", "doc_type", "file_size", F.col("file_path").isNotNull().alias("has_file"))
    nested = docs.groupBy(F.col("application_id").alias("id")).agg(F.array_sort(F.collect_list(entry)).alias("documents"))
    return apps.join(nested, "id", "left")


def supply_delta(rows: DataFrame) -> DataFrame:
    """Dwellings and rooms after minus before; a vacant site begins at none. finished: all units are sold or rooms come from listings."""
    vacant = F.lower(F.coalesce("pre_property_type", F.lit(""))).isin("land", "vacant", "vacant land")
    before = lambda c: F.when(vacant, 0).otherwise(F.col(c))
    return rows.select(
        "id", (F.col("dwelling_count") - F.when(vacant, 0).otherwise(1)).alias("dwellings_delta"), (F.col("post_bedrooms") - before("pre_bedrooms")).alias("bedrooms_delta"),
        (F.col("post_bathrooms") - before("pre_bathrooms")).alias("bathrooms_delta"), matched(F.col("built_status") == "built_sold").alias("finished"), matched(F.col("post_rooms_source") == "da_docs").alias("projected"),
    )


def project_status(rows: DataFrame, n_sold: DataFrame, as_of: datetime.date) -> DataFrame:
    """The label shown for an approved project: sold (with a share), rented, dormant, building or unknown; null unless approved."""
    sold = F.coalesce("n_sold", F.lit(0))
    share = F.when(F.col("dwelling_count") > 0, F.round(sold / F.col("dwelling_count") * 100).cast("long"))
    months = F.datediff(F.lit(as_of), "decision_date") / 30.44
    label = (
        F.when(~is_approved(F.col("decision_outcome")), None).when((sold > 0) & share.isNotNull() & (share != 100), F.concat(F.lit("Sold "), share.cast("string"), F.lit("%"))).when(sold > 0, "Sold")
        .when(F.col("built_status") == "built_unsold", "Rented").when(F.col("built_status") == "abandoned_likely", "Dormant").when(months < 15, "Building").otherwise("Unknown")
    )
    return rows.join(n_sold, "id", "left").select("id", label.alias("project_status"))


def project_timing(rows: DataFrame, first_sale: DataFrame) -> DataFrame:
    """Days from purchase to approval (else lodgement), and from approval to the first unit sale."""
    approved = F.when(is_approved(F.col("decision_outcome")), F.col("decision_date"))
    return rows.join(first_sale, "id", "left").select("id", F.datediff(F.coalesce(approved, "lodged_date"), "pre_date").alias("prep_days"), F.datediff("first_sold", approved).alias("project_days"))


def profitability(scenarios: DataFrame, rates: DataFrame) -> DataFrame:
    """Costs, profit and verdict per scenario; invalid scenarios get an error instead.

    scenarios: scenario_id, purchase_price, build_cost, sale_price, hold_months, rate_pct, acquisition_costs_pct,
    sale_costs_pct (the last three may be null: the newest owner rate or 6, 5.5 and 2.5 are used).
    """
    newest = rates.where("series_id = 'FILRHLBVD'").agg(F.max_by("rate_pct", "month").alias("_rate"))
    s = scenarios.withColumn("_rate", newest.scalar())
    buy, build, sale, months = (F.col(c).cast("double") for c in ("purchase_price", "build_cost", "sale_price", "hold_months"))
    bad = ~matched((buy > 0) & (sale > 0) & (months > 0))
    s = s.withColumns({"error": F.when(bad, "purchase_price, sale_price and hold_months must be above 0"), "rate_pct_used": F.coalesce("rate_pct", "_rate", F.lit(6.0)), "_sale_pct": F.coalesce("sale_costs_pct", F.lit(2.5)) / 100})
    s = s.withColumn("acquisition_cost", buy * (F.coalesce("acquisition_costs_pct", F.lit(5.5)) / 100))
    years = months / 12
    s = s.withColumn("interest_cost", (buy + build + F.col("acquisition_cost")) * (F.col("rate_pct_used") / 100) * years).withColumn("sale_cost", sale * F.col("_sale_pct"))
    s = s.withColumn("total_cost", buy + build + F.col("acquisition_cost") + F.col("interest_cost") + F.col("sale_cost"))
    s = s.withColumn("profit", sale - F.col("total_cost"))
    ratio = F.col("profit") / F.nullif("total_cost", F.lit(0.0))
    s = s.withColumns({"margin_pct": ratio * 100, "annualised_return_pct": ratio / F.nullif(years, F.lit(0.0)) * 100, "breakeven_sale_price": F.col("total_cost") - F.col("sale_cost") + F.col("total_cost") * F.col("_sale_pct")})
    verdict = F.when((F.col("profit") < 0) | (F.col("margin_pct") < 5), "grasshopper").when((F.col("margin_pct") >= 18) & (F.col("annualised_return_pct") >= 15), "bull").otherwise("marginal")
    names = ["rate_pct_used", "acquisition_cost", "interest_cost", "sale_cost", "total_cost", "profit", "margin_pct", "annualised_return_pct", "breakeven_sale_price"]
    return s.select("scenario_id", "error", *[F.when(F.col("error").isNull(), F.col(c)).alias(c) for c in names], F.when(F.col("error").isNull(), verdict).alias("verdict"))

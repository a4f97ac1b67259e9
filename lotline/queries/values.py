"""Queries over single values: dates, sizes, prices, addresses, links, names, boxes; and the rules of pages, months and checks, with their SQL twins."""

from __future__ import annotations

import datetime
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lotline.functions import entities as E
from lotline.functions import text as T
from lotline.functions import urls as U
from lotline.functions.classify import type_allowed
from lotline.functions.hashing import page_hashes
from lotline.operators import joins as J
from lotline.operators import quality as Q
from lotline.operators import spine as S
from lotline.operators import writes as W
from lotline.operators.joins import remap_tagged
from lotline.operators.staging import shared_folder
from lotline.plans import pending as P
from lotline.plans import spans as Sp
from lotline.plans.projects import pre_sale
from lotline.queries.records import A_SQL, halves
from lotline.sources import pages as G
from lotline.sources.adapters import tables, twin
from lotline.sources.schemas import conformed, read_table


def one(spark: SparkSession, d: str, name: str) -> DataFrame:
    return tables(spark, d, name)[name]


def text_of(*parts) -> Column:
    return F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])


def read_dates(spark: SparkSession, d: str) -> DataFrame:
    """Dates of line items written in the forms of councils and portals, and read back; some are impossible."""
    li = one(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate").distinct()
    day = F.col("l_shipdate")
    odd = F.col("l_orderkey") % 5 == 0
    au, shown, iso = F.date_format(day, "d/M/yyyy"), F.date_format(day, "d MMM yyyy"), F.date_format(day, "yyyy-MM-dd'T'HH:mm:ss")
    tag = F.when(F.col("l_linenumber") == 1, text_of("Sold by auction ", shown)).when(F.col("l_linenumber") == 2, text_of("Sold on ", shown)).otherwise(text_of("Leased ", shown))
    out = li.select("l_orderkey", "l_linenumber", "l_shipdate", T.au_date(F.when(odd, F.regexp_replace(au, r"^\d+/\d+", "31/02")).otherwise(text_of(" ", au, " "))).alias("au"), T.display_date(F.when(odd, F.regexp_replace(shown, r"^\d+ \w+", "30 Foo")).otherwise(shown)).alias("shown"), T.iso_date(F.when(odd, "soon").otherwise(iso)).alias("iso"), T.sold_tag(tag).alias("t"))
    return out.select("l_orderkey", "l_linenumber", "l_shipdate", "au", "shown", "iso", "t.sold_date", "t.method")


def read_sizes(spark: SparkSession, d: str) -> DataFrame:
    """Sizes of files and land of all parts, in their units."""
    n, k = F.col("p_size"), F.col("p_partkey")
    size = text_of(n.cast("string"), F.when(k % 2 == 0, ".5").otherwise(""), " ", F.element_at(F.array(*map(F.lit, ["b", "KB", "Mb", "GB", "TB"])), (k % 5 + 1).cast("int")))
    unit = F.element_at(F.array(*map(F.lit, ["m²", "ha", "acres", ""])), (k % 4 + 1).cast("int"))
    return one(spark, d, "part").select("p_partkey", T.size_bytes(size).alias("n_bytes"), T.land_m2((n - 10).cast("string"), unit).alias("land_m2"), T.price_digits(text_of("$", F.format_number(k * 1000, 0), " neg.")).alias("price"), T.room_count((n * 3 - 5).cast("string")).alias("rooms"))


def street_forms(spark: SparkSession, d: str) -> DataFrame:
    """Street types written out, addresses split, slugs built."""
    p = one(spark, d, "domain_properties")
    street = F.regexp_replace(F.substring_index("display_address", ",", 1), "^[^/]*/", "")
    short = F.regexp_replace(F.regexp_replace(F.regexp_replace(street, "Street$", "st"), "Parade$", "Pde"), "Court$", "CRT")
    free = T.split_address(text_of(short, ", ", F.col("suburb"), F.when(F.col("id") % 3 == 0, "").otherwise(" QLD 4220")))
    raw = text_of("Unit 5, ", F.when(F.col("id") % 4 == 0, "").otherwise(street), ", ", F.col("suburb"))
    return p.select("id", free.alias("a"), T.street_only(raw).alias("shown"), U.portal_slug(street, F.col("suburb"), F.lit("QLD"), F.lit("4220")).alias("slug"), T.canonical_long_form(F.element_at(F.split(short, " "), -1)).alias("kind")).select("id", "a.*", "shown", "slug", "kind")


def link_kinds(spark: SparkSession, d: str) -> DataFrame:
    """Links of both portals, classified, cleaned, and held against addresses."""
    p = one(spark, d, "domain_properties")
    i = F.col("id")
    slug = U.portal_slug(F.regexp_replace(F.substring_index("display_address", ",", 1), "^[^/]*/", ""), F.col("suburb"), F.lit("QLD"), F.lit("4220"))
    url = (
        F.when(i % 6 == 0, text_of("https://www.realestate.com.au/property/", slug)).when(i % 6 == 1, text_of("https://www.domain.com.au/property-profile/", slug, "?x=1")).when(i % 6 == 2, text_of("https://www.realestate.com.au/sold/house-", F.replace(F.lower("suburb"), F.lit(" "), F.lit("-")), "-123456#top"))
        .when(i % 6 == 3, text_of("https://www.domain.com.au/unit-7-", slug, "-2020299115).")).when(i % 6 == 4, text_of("https://www.domain.com.au/99-other-street-nowhere-qld-4220-2020299115")).otherwise("https://plans.example.com/a.pdf\\n")
    )
    address = F.regexp_replace(F.col("display_address"), "^[^/]*/", "")
    return p.select("id", U.classify_url(U.clean_url(url)).alias("kind"), U.clean_url(url).alias("clean"), U.slug_matches(U.clean_url(url), address, F.col("suburb")).alias("matches"), U.is_third_party(url).alias("third_party"))


def page_links(spark: SparkSession, d: str) -> DataFrame:
    """Links and content of all pages: kind, clean form, host, score, hashes."""
    u, h = page_hashes(F.col("url"), F.col("html"))
    return one(spark, d, "pages").select("page_id", U.classify_url(F.col("url")).alias("kind"), U.clean_url(F.col("url")).alias("clean"), U.host(F.col("url")).alias("host"), U.is_third_party(F.col("url")).alias("third_party"), U.website_score(F.col("url"), F.lit("Thth Homes"), F.lit("builder")).alias("score"), u, h)


def firm_seeds(spark: SparkSession, d: str) -> DataFrame:
    """Firm words of links and mail addresses made from nations and suppliers, and how many spellings each has."""
    s = one(spark, d, "supplier")
    k = F.col("s_suppkey")
    host = F.element_at(F.array(*map(F.lit, ["borisdesign.com.au", "gmail.com", "abc.net.au", "www-metricon.org", "sub.oakstudio.com"])), (k % 5 + 1).cast("int"))
    box = F.element_at(F.array(*map(F.lit, ["info", "auski.design", "no-reply", "jo"])), (k % 4 + 1).cast("int"))
    kind = F.when(k % 3 == 0, "url").otherwise("email")
    value = F.when(k % 3 == 0, host).otherwise(text_of(box, "@", host))
    return s.select("s_suppkey", E.firm_seed(kind, value).alias("seed"), F.get(E.name_candidates(E.firm_seed(kind, value)), F.lit(0)).alias("first_spelling"))


def scaled_boxes(spark: SparkSession, d: str) -> DataFrame:
    """Boxes of all words scaled to a page, some outside it or the wrong way round."""
    w = Sp.word_spans(one(spark, d, "documents"))
    box = F.array("x1", "y0", "x0", F.col("y1") + 150)
    return w.select("doc_id", "span", E.norm_bbox(box, F.lit(420.0), F.lit(200.0)).alias("b")).groupBy("doc_id").agg(*[F.sum(F.col("b")[i]).alias(f"b{i}") for i in range(4)])


def allowed_types(spark: SparkSession, d: str) -> DataFrame:
    return one(spark, d, "applications").where(type_allowed(F.col("application_id"), ["mcu", "ROL"])).select("id", "application_id")


def rates_lines(spark: SparkSession, d: str) -> DataFrame:
    """A rates sheet per order year: banner, header rows, then a row per month, with blanks and an impossible date."""
    r = one(spark, d, "rates")
    wide = r.groupBy("month").pivot("series_id", ["FILRHLBVD", "FILRHL3YF"]).agg(F.first("rate_pct"))
    year = F.year("month").cast("string")
    data = wide.select(year.alias("file"), (F.month("month") + 10).alias("n"), text_of(F.when(F.month("month") == 2, "31").otherwise("1"), F.date_format("month", "/MM/yyyy,"), F.coalesce(F.col("FILRHLBVD").cast("string"), F.lit("")), F.when(F.month("month") == 3, "").otherwise(text_of(",", F.coalesce(F.col("FILRHL3YF").cast("string"), F.lit("n/a"))))).alias("line"))
    heads = [(1, "F5 INDICATOR LENDING RATES"), (2, "Title,Variable; banks ,Fixed"), (3, "Units,Per cent,Per cent"), (4, "Series ID, FILRHLBVD,FILRHL3YF")]
    banner = wide.select(year.alias("file")).distinct().select("file", F.inline(F.array(*[F.struct(F.lit(n).alias("n"), F.lit(x).alias("line")) for n, x in heads])))
    return data.unionByName(banner.withColumn("n", F.col("n").cast("int")))


def melted_rates(spark: SparkSession, d: str) -> DataFrame:
    return G.read_rates(rates_lines(spark, d))


def suburb_scope(spark: SparkSession, d: str) -> DataFrame:
    """Applications matched with portal properties by street and suburb, with council spellings of street types."""
    t = tables(spark, d, "applications", "domain_properties")
    street = F.regexp_replace(F.regexp_replace("street_address", "Street$", "St"), "Parade$", "pde")
    targets = t["applications"].where("suburb <> ''").select(F.col("id").alias("app_id"), street.alias("street"), "suburb")
    return J.suburb_matches(targets, t["domain_properties"].select(F.col("id").alias("property_id"), "display_address")).select("app_id", "property_id")


def postcode_councils(spark: SparkSession, d: str) -> DataFrame:
    n = one(spark, d, "nation")
    councils = n.groupBy(text_of("council-", F.col("n_regionkey").cast("string")).alias("slug")).agg(F.collect_list((F.col("n_nationkey") + 4200).cast("string")).alias("postcodes"))
    c = one(spark, d, "customer").select("c_custkey", F.when(F.col("c_custkey") % 6 == 0, "9999").otherwise((F.col("c_nationkey") + 4200).cast("string")).alias("postcode"))
    return Sp.council_for_postcode(c, councils, F.col("postcode")).select("c_custkey", "postcode", "slug")


def routed_windows(spark: SparkSession, d: str) -> DataFrame:
    w = one(spark, d, "windows").select("slug", "date_from", "date_to").distinct()
    backends = spark.createDataFrame([("old", None, datetime.date(1996, 3, 15)), ("new", datetime.date(1996, 3, 10), datetime.date(1998, 1, 1)), ("open", datetime.date(2000, 5, 20), None)], "name string, valid_from date, valid_to date")
    return S.route_windows(w, backends).select("slug", "date_from", "date_to", "name", "clip_from", "clip_to")


def done_months(spark: SparkSession, d: str) -> DataFrame:
    w = one(spark, d, "windows").withColumn("date_to", F.last_day("date_to"))
    return S.completed_months(S.month_spine(spark, datetime.date(1994, 11, 5), datetime.date(2001, 12, 1)), w).select("slug", "date_from", "finished_at")


def pending_work(spark: SparkSession, d: str) -> DataFrame:
    """Applications to escalate, and chunks still to read, counted."""
    t = tables(spark, d, "doc_summaries", "documents_meta", "documents")
    i = F.col("application_id")
    summaries = t["doc_summaries"].select("application_id").distinct().withColumn("status", F.when(i % 3 == 0, "complete").otherwise("incomplete"))
    left = P.pending_escalations(summaries, t["documents_meta"], t["documents_meta"].where("id % 10 <= 3").select(F.col("id").alias("document_id")))
    chunks = t["documents"].select("doc_id", F.explode(F.sequence(F.lit(0), F.lit(3))).alias("chunk_index"))
    rest = P.pending_chunks(chunks, chunks.where("chunk_index = 0 or doc_id % 2 = 0"))
    return left.select(F.lit("escalate").alias("rule"), "application_id").unionByName(rest.select(F.lit("chunk").alias("rule"), (F.col("doc_id") * 10 + F.col("chunk_index")).alias("application_id")))


def gates(spark: SparkSession, d: str) -> DataFrame:
    """Duplex applications with a sale before lodgement in two stores; the second must have as many, and some."""
    t = tables(spark, d, "applications", "domain_properties", "domain_sales")

    def usable(apps: DataFrame) -> DataFrame:
        pre = pre_sale(apps, J.lot_matches(apps, t["domain_properties"]), t["domain_sales"], "domain_property_id", F.col("is_sold"))
        return apps.join(pre.select("id"), "id", "left_semi")

    return Q.gate_report(usable(t["applications"].where("id % 3 <> 0")), usable(t["applications"]))


def merge_reasons(spark: SparkSession, d: str) -> DataFrame:
    """What becomes of one store's orders when their customers are looked for in another: counts that the remap itself gives.

    Some orders name no customer, some one that their own store lacks. Read as required and as optional.
    """
    a, b = halves(spark, d)
    k = F.col("id")
    orders = a["orders"].withColumn("customer_id", F.when(k % 11 == 0, None).when(k % 13 == 0, -k).otherwise(F.col("customer_id")))
    named = a["customers"].withColumn("name", F.when(k % 17 != 0, F.col("name")))
    counts = [Q.resolution_counts(remap_tagged(orders, named, b["customers"], ["name"], "customer_id", need), "outcome").withColumn("required", F.lit(need)) for need in (True, False)]
    return counts[0].unionByName(counts[1])


def evidence_store(spark: SparkSession, d: str) -> DataFrame:
    """Evidence written again: verification stays, a missing layout keeps the old one."""
    li = one(spark, d, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.max("l_suppkey").alias("s"))
    base = li.select(F.lit("rx").alias("extractor"), F.col("l_orderkey").alias("source_doc_id"), F.col("l_linenumber").alias("span_start"), (F.col("l_linenumber") + 5).alias("span_end"), text_of("Name ", F.col("s").cast("string")).alias("candidate_name"), F.when(F.col("s") % 2 == 0, "box").alias("layout"), F.when(F.col("s") % 3 == 0, "verified").otherwise("predicted").alias("status"), F.when(F.col("s") % 3 == 0, "owner").alias("truth_role"))
    target = base.where("span_start <= 3")
    fresh = base.where("span_start >= 2").withColumns({"candidate_name": F.upper("candidate_name"), "layout": F.when(F.col("span_start") % 2 == 0, "new"), "status": F.lit("predicted"), "truth_role": F.lit(None).cast("string")})
    return W.upsert_evidence(target, fresh)


def typed_tables(spark: SparkSession, d: str) -> DataFrame:
    """Entity tables written in their fixed schemas and scanned again, with how many of their columns are filled."""
    folder = f"{shared_folder(spark)}/lotline-{uuid.uuid4().hex}"
    out = []
    for name in ("applications", "domain_properties", "realestate_sales", "documents_meta", "companies"):
        conformed(one(spark, d, name), name).write.parquet(f"{folder}/{name}.parquet")
        t = read_table(spark, folder, name)
        out.append(t.agg(F.lit(name).alias("name"), F.count(F.lit(1)).alias("n_rows"), F.count("id").alias("n_ids"), F.sum("id").alias("sum_ids"), F.lit(len(t.columns)).alias("n_columns")))
    return reduce(DataFrame.unionByName, out)


def labelled_lines(spark: SparkSession, d: str) -> DataFrame:
    """Training records of every page written as JSON lines and read as text."""
    docs, repeated = Sp.by_repetition(one(spark, d, "documents"))
    heads = F.filter("spans", lambda s: F.lower(s["text"]).isin("the", "der", "les", "las"))
    overlaps = F.transform(heads, lambda s: F.struct(s["span"].alias("entity"), (s["span"] + 1).alias("word"), F.lit("owner").alias("role")))
    labels = Sp.page_labels(Sp.page_words(docs).withColumn("overlaps", overlaps))
    if repeated is not None:
        spans = Sp.word_spans(repeated)
        heads = spans.where("lower(text) in ('the', 'der', 'les', 'las')").select("doc_id", "page", F.col("span").alias("entity"), (F.col("span") + 1).alias("word"), F.lit("owner").alias("role"))
        labels = labels.unionByName(Sp.export_labels(spans, heads))
    at = f"{shared_folder(spark)}/lotline-{uuid.uuid4().hex}/labels"
    W.write_jsonl(Sp.split_by_doc(labels, 0.2), at, "gzip")
    lines = spark.read.text(at)
    get = lambda path: F.get_json_object("value", path)
    rows = lines.select(get("$.doc_id").cast("long").alias("doc_id"), get("$.page").cast("long").alias("page"), F.size(F.from_json(get("$.words"), "array<string>")).alias("n_words"), F.size(F.filter(F.from_json(get("$.tags"), "array<string>"), lambda t: t != "O")).alias("n_tagged"), get("$.fold").alias("fold"))
    folds = F.size(F.collect_set("fold").over(Window.partitionBy("doc_id")))
    return rows.select("doc_id", "page", "n_words", "n_tagged", folds.alias("n_folds"))


def replaced_links(spark: SparkSession, d: str) -> DataFrame:
    """Links replaced by name and role, then those of every seventh wiped."""
    c = one(spark, d, "customer").select(F.col("c_custkey").alias("id"), "c_name", F.when(F.col("c_custkey") % 2 == 0, "builder").otherwise("architect").alias("role"), F.lit("old").alias("url"))
    fresh = c.where("id % 4 < 2").withColumn("url", F.lit("new"))
    return W.purge(W.replace_rows(c, fresh, ["c_name", "role"]), c.where("id % 7 = 0"), ["id"])


QUERIES = {f.__name__: f for f in (read_dates, read_sizes, street_forms, link_kinds, page_links, firm_seeds, scaled_boxes, allowed_types, melted_rates, suburb_scope, postcode_councils, routed_windows, done_months, pending_work, gates, merge_reasons, evidence_store, typed_tables, labelled_lines, replaced_links)}

LONG_TYPE = "case street_name when 'Oak' then 'street' when 'Elm' then 'parade' when 'Sea' then 'road' else 'court' end"
STREET = "regexp_replace(split_part(display_address, ',', 1), '^[^/]*/', '')"
SLUG = f"lower(replace({STREET}, ' ', '-')) || '-' || lower(replace(suburb, ' ', '-')) || '-qld-4220'"
SCORE = "(case when contains(replace(h, '.', ''), 'ththhomes') then 3 else 0 end + case when regexp_matches(h, 'build|construct|homes|developments|projects') then 2 else 0 end + case when h like '%.com.au' then 1 else 0 end)"
ORACLE_SQL = {
    "read_dates": "select distinct l_orderkey, l_linenumber, l_shipdate, case when l_orderkey % 5 <> 0 then cast(l_shipdate as date) end as au, case when l_orderkey % 5 <> 0 then cast(l_shipdate as date) end as shown, case when l_orderkey % 5 <> 0 then cast(l_shipdate as date) end as iso, case when l_linenumber <= 2 then cast(l_shipdate as date) end as sold_date, case when l_linenumber = 1 then 'auction' end as method from lineitem",
    "read_sizes": "select p_partkey, cast(case p_partkey % 5 when 4 then null else floor((p_size + case when p_partkey % 2 = 0 then 0.5 else 0 end) * [1, 1024, 1048576, 1073741824][p_partkey % 5 + 1]) end as bigint) as n_bytes, case when p_size > 10 then cast(floor((p_size - 10) * [1.0, 10000.0, 4046.8564, 1.0][p_partkey % 4 + 1]) as bigint) end as land_m2, p_partkey * 1000 as price, case when p_size * 3 - 5 between 0 and 99 then cast(p_size * 3 - 5 as int) end as rooms from part",
    "street_forms": twin(f"select id, {STREET}[:length({STREET}) - length(split_part({STREET}, ' ', -1))] || {LONG_TYPE} as street, suburb, case when id % 3 = 0 then '' else 'QLD' end as state, case when id % 3 = 0 then '' else '4220' end as postcode, case when id % 4 = 0 then 'Unit 5' else {STREET} end as shown, {SLUG} as slug, {LONG_TYPE} as kind from domain_properties", "domain_properties"),
    "link_kinds": twin(f"with l as (select id, {SLUG} as slug, lower(replace(suburb, ' ', '-')) as place from domain_properties) select id, case id % 6 when 0 then 'rea_pdp' when 1 then 'domain_pdp' when 2 then 'rea_sold' when 3 then 'domain_listing' when 4 then 'domain_listing' end as kind, case id % 6 when 0 then 'https://www.realestate.com.au/property/' || slug || '/' when 1 then 'https://www.domain.com.au/property-profile/' || slug when 2 then 'https://www.realestate.com.au/sold/house-' || place || '-123456' when 3 then 'https://www.domain.com.au/unit-7-' || slug || '-2020299115' when 4 then 'https://www.domain.com.au/99-other-street-nowhere-qld-4220-2020299115' else 'https://plans.example.com/a.pdf' end as clean, id % 6 <> 4 as matches, id % 6 = 5 as third_party from l", "domain_properties"),
    "page_links": f"select page_id, cast(null as varchar) as kind, regexp_replace(regexp_replace(url, '[?#].*$', ''), '/+$', '') as clean, lower(regexp_extract(url, '^https?://([^/?#]+)', 1)) as host, true as third_party, {SCORE} as score, sha256(url) as url_hash, sha256(html) as content_hash from (select *, regexp_replace(lower(regexp_extract(url, '^https?://([^/?#]+)', 1)), '^www\\.', '') as h from pages)",
    "firm_seeds": "with s as (select s_suppkey, s_suppkey % 3 = 0 as is_url, ['borisdesign', null, null, 'www-metricon', 'sub'][s_suppkey % 5 + 1] as stem, s_suppkey % 5 = 1 as generic, ['info', 'auskidesign', 'noreply', 'jo'][s_suppkey % 4 + 1] as box from supplier), k as (select s_suppkey, case when generic and not is_url then case when box = 'auskidesign' then box end when length(stem) >= 4 then stem end as seed from s) select *, case seed when 'borisdesign' then 'Boris Design' when 'auskidesign' then 'Auski Design' when 'www-metricon' then 'Ww Wmetricon' end as first_spelling from k",
    "scaled_boxes": "with sp as (select doc_id, s % 10 * 50 as x0, s // 10 % 10 * 20 as y0, s % 10 * 50 + 40 as x1, s // 10 % 10 * 20 + 10 as y1 from (select doc_id, unnest(range(0, len(string_split(text, ' ')))) as s from documents where text <> '')) select doc_id, cast(sum(least(1000, cast(floor(x0 / 420 * 1000) as int))) as bigint) as b0, cast(sum(least(1000, cast(floor(y0 / 200 * 1000) as int))) as bigint) as b1, cast(sum(least(1000, cast(floor(x1 / 420 * 1000) as int))) as bigint) as b2, cast(sum(least(1000, cast(floor((y1 + 150) / 200 * 1000) as int))) as bigint) as b3 from sp group by 1",
    "allowed_types": twin("select id, application_id from applications where split_part(application_id, '/', 1) in ('MCU', 'ROL')", "applications"),
    "melted_rates": twin("select series_id, case series_id when 'FILRHLBVD' then 'Variable; banks' else 'Fixed' end as series_label, month, rate_pct from rates where series_id in ('FILRHLBVD', 'FILRHL3YF') and extract(month from month) <> 2 and not (series_id = 'FILRHL3YF' and extract(month from month) = 3)", "rates"),
    "suburb_scope": twin("select a.id as app_id, p.id as property_id from applications a join domain_properties p on lower(p.display_address) like lower(a.street_address || ', ' || a.suburb) || '%' where a.suburb <> ''", "applications", "domain_properties"),
    "postcode_councils": "select c_custkey, case when c_custkey % 6 = 0 then '9999' else cast(c_nationkey + 4200 as varchar) end as postcode, case when c_custkey % 6 <> 0 then 'council-' || n_regionkey end as slug from customer left join nation on n_nationkey = c_nationkey",
    "routed_windows": twin("with b as (select * from (values ('old', cast(null as date), date '1996-03-15'), ('new', date '1996-03-10', date '1998-01-01'), ('open', date '2000-05-20', cast(null as date))) as t(name, f, t)) select distinct slug, date_from, date_to, name, greatest(date_from, coalesce(f, date_from)) as clip_from, least(date_to, coalesce(t, date_to)) as clip_to from windows join b on (t is null or date_from <= t) and (f is null or date_to >= f)", "windows"),
    "done_months": twin("select slug, date_from, max(finished_at) as finished_at from windows where status = 'completed' group by 1, 2, last_day(date_to)", "windows"),
    "pending_work": twin("select 'escalate' as rule, application_id from (select distinct application_id from doc_summaries) where application_id % 3 <> 0 and application_id in (select application_id from documents_meta where file_path is not null and id % 10 > 3) union all select 'chunk', doc_id * 10 + c from (select doc_id, unnest([1, 2, 3]) as c from documents where doc_id % 2 = 1)", "doc_summaries", "documents_meta"),
    "gates": twin("with d as (select distinct a.id from applications a join domain_properties m on lower(m.display_address) like lower(a.street_address) || '%' join domain_sales s on s.domain_property_id = m.id where a.street_address <> '' and regexp_matches(description, '(?i)dual\\s+occupancy|duplex') and not regexp_matches(description, '(?i)triplex|fourplex|quadruplex|multi[\\s-]+unit|multi[\\s-]+dwelling') and s.event_date < a.lodged_date and s.event_date >= a.lodged_date - interval 10 year and s.is_sold and s.event_price is not null) select 'duplex' as gate, count(*) filter (where id % 3 <> 0) as n_a, count(*) as n_b, count(*) > 0 as ok from d", "applications", "domain_properties", "domain_sales"),
    "merge_reasons": f"""with {A_SQL}, o as (select id, case when id % 11 = 0 then null when id % 13 = 0 then -id else customer_id end as k from ao),
w as (select case when k is null then 'no_key' when a.id is null then 'no_old_parent' when a.id % 17 = 0 then 'no_natural_key' when b.id is null then 'no_new_parent' else 'remapped' end as outcome from o left join a on a.id = k left join b on b.name = a.name)
select case when required and outcome <> 'remapped' then 'dropped:' || outcome else outcome end as outcome, count(*) as n, required from w, (values (true), (false)) t(required) group by 1, 3""",
    "evidence_store": "with b as (select l_orderkey, l_linenumber, max(l_suppkey) as s from lineitem group by 1, 2) select 'rx' as extractor, l_orderkey as source_doc_id, l_linenumber as span_start, l_linenumber + 5 as span_end, case when l_linenumber >= 2 then 'NAME ' || s else 'Name ' || s end as candidate_name, case when l_linenumber >= 2 and l_linenumber % 2 = 0 then 'new' when l_linenumber <= 3 and s % 2 = 0 then 'box' end as layout, case when l_linenumber <= 3 and s % 3 = 0 then 'verified' else 'predicted' end as status, case when l_linenumber <= 3 and s % 3 = 0 then 'owner' end as truth_role from b",
    "replaced_links": "select c_custkey as id, c_name, case when c_custkey % 2 = 0 then 'builder' else 'architect' end as role, case when c_custkey % 4 < 2 then 'new' else 'old' end as url from customer where c_custkey % 7 <> 0",
    "typed_tables": twin(" union all ".join(f"select '{t}' as name, count(*) as n_rows, count(id) as n_ids, cast(sum(id) as bigint) as sum_ids, {n} as n_columns from {t}" for t, n in (("applications", 31), ("domain_properties", 33), ("realestate_sales", 10), ("documents_meta", 15), ("companies", 9))), "applications", "domain_properties", "realestate_sales", "documents_meta", "companies"),
    "labelled_lines": "with sp as (select doc_id, s // 100 as page, s as span, w as text from (select doc_id, unnest(string_split(text, ' ')) as w, unnest(range(0, len(string_split(text, ' ')))) as s from documents where text <> '')), t as (select doc_id, page, span + 1 as span from sp where lower(text) in ('the', 'der', 'les', 'las')) select sp.doc_id, sp.page, count(*) as n_words, count(t.span) as n_tagged, 1 as n_folds from sp left join t using (doc_id, page, span) group by 1, 2",
}

"""Letters, title blocks, portal pages and lookups on odd forms."""

import datetime

from pyspark.sql import functions as F

from lotline.functions import entities as E
from lotline.functions import letters as L
from lotline.operators import lookups as K
from lotline.plans import harvest as H
from lotline.sources import portals as G


def one(spark, text, *columns):
    return spark.createDataFrame([(text,)], "t string").select(*columns).first()


def test_letters_without_parts(spark):
    t = F.col("t")
    for text in (None, "", "Our reference: X", "Our reference: X\n\nDear Sir", "Yours sincerely", "Our reference: X\nDj\nMIAMI QLD 4220"):
        r = one(spark, text, L.recipient_block(t).alias("r"), L.applicant_fields(t).alias("a"), L.refer_by_name(t).alias("n"), L.council_emissions(t).alias("c"), L.applicant_emissions(t).alias("e"), L.title_block(t).alias("b"), L.brand_blocks(t).alias("u"))
        assert (r.r is None or r.r.name is None) and r.a is None and r.n is None and not r.c and not r.e and not r.b and not r.u


def test_sign_off_layouts(spark):
    t = F.col("t")
    firm_first = one(spark, "x\nKind regards,\nHPC Planning Pty Ltd\nDr Rodney Ronalds (BE, MIEAust)\nDirector,\nP: 07", L.sign_off(t).alias("s")).s
    assert (firm_first.name, firm_first.role, firm_first.company) == ("Dr Rodney Ronalds", "Director", "HPC Planning Pty Ltd")
    last = one(spark, "Regards\nOld Name\n\nYours faithfully,\n\nDominee Rye, RPEQ MEIAust\nMobile 04", L.sign_off(t).alias("s")).s
    assert (last.name, last.role) == ("Dominee Rye", None)


def test_client_and_names(spark):
    names = spark.createDataFrame([("GOLD COAST PTY ltd",), ("g.j. o'brien",), ("smith-JONES & co",)], "t string").select(L.clean_name(F.col("t")).alias("n"))
    assert [r.n for r in names.collect()] == ["Gold Coast PTY LTD", "G.J. O'Brien", "Smith-Jones & Co"]


def test_harvest_of_nothing(spark):
    docs = spark.createDataFrame([(1, 1, None, 5, None), (2, 1, "Plans", 5, "nothing"), (3, 2, "Letter", 5, "")], "doc_id long, application_id long, doc_type string, file_size long, text string")
    companies = spark.createDataFrame([], "id long, acn string, display_name string")
    assert H.harvest_entities(docs, companies)["links"].count() == 0 and H.emissions(docs).count() == 0


def test_portal_pages_without_data(spark):
    pages = spark.createDataFrame([(1, None), (2, ""), (3, "<script>window.ArgonautExchange = {broken"), (4, '<script id="__NEXT_DATA__" type="application/json">{"props":{}}</script>'), (5, 'window.ArgonautExchange = {"a":1};')], "page_id long, html string")
    for f in (G.listings_a, G.listings_b, G.profiles_a, G.profiles_b, G.registry_results, G.registry_details):
        assert f(pages).count() == 0
    links = pages.withColumn("url", F.concat(F.lit("https://p/sold/x-123456"), F.col("page_id")))
    assert G.listing_details_a(links).where("price_text is null").count() == 5 and G.listing_details_b(links).where("listing_kind = 'sold'").count() == 5


def test_nested_json_opens_all_the_way(spark):
    nested = '{"outer":"{\\"inner\\":\\"[1,2,3]\\"}","odd":"{not json"}'
    assert one(spark, nested, G.resolved("t").alias("j")).j == '{"outer":{"inner":[1,2,3]},"odd":"{not json"}'
    assert one(spark, "nope", G.resolved("t").alias("j")).j is None


def test_firm_seeds(spark):
    rows = [("url", "gmail.com", None), ("url", "borisdesign.com.au", "borisdesign"), ("email", "info@gmail.com", None), ("email", "auski.design@gmail.com", "auskidesign"), ("email", "x@oak.com", None), ("email", "broken", None), ("phone", "0755551234", None)]
    df = spark.createDataFrame(rows, "k string, v string, want string").select("want", E.firm_seed(F.col("k"), F.col("v")).alias("got"))
    assert all(r.got == r.want for r in df.collect())


def test_page_lookups(spark):
    pages = spark.createDataFrame([(1, "a", "x", datetime.datetime(2024, 1, 1)), (2, "a", "y", datetime.datetime(2024, 1, 2)), (3, "b", "x", datetime.datetime(2023, 1, 1))], "page_id long, url_hash string, content_hash string, fetched_at timestamp").withColumn("source", F.lit("s"))
    assert [r.page_id for r in K.fresh_pages(pages, 48, datetime.datetime(2024, 1, 3)).collect()] == [2]
    rows = spark.createDataFrame([(1, "a", "y"), (2, "a", "z"), (3, None, "x"), (4, "c", "x")], "i long, url_hash string, content_hash string")
    assert {r.i: r.page_id for r in K.lookup_page(rows, pages.select("page_id", "url_hash", "content_hash")).collect()} == {1: 2, 2: 1, 3: None, 4: None}


def test_bodies_that_are_not_utf8(spark):
    import gzip

    rows = [(1, b"plain \xff\xfe"), (2, gzip.compress("é".encode())), (3, None), (4, b""), (5, gzip.compress(b"\x80x"))]
    got = {r.i: r.t for r in spark.createDataFrame(rows, "i long, b binary").select("i", G.unzipped("b").alias("t")).collect()}
    assert got == {1: "plain \ufffd\ufffd", 2: "é", 3: None, 4: "", 5: "\ufffdx"}

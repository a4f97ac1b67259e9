"""Expected values of the column functions."""

import datetime

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from lotline.functions import classify as C
from lotline.functions import entities as E
from lotline.functions import hashing as H
from lotline.functions import text as T
from lotline.functions import urls as U


def values(spark, expression, rows, schema="x string"):
    return [r[0] for r in spark.createDataFrame([x if isinstance(x, tuple) else (x,) for x in rows], schema).coalesce(1).select(expression).collect()]


def test_approved_units(spark):
    cases = {"Code Assessment DUAL OCCUPANCY": 2, "Triplex development": 3, "Residential (3 units)": 3, "4 dwellings": 4, "8 townhouses": 8, "Multi-unit residential": None, "": None, None: None, "99 units duplex": 2}
    assert values(spark, T.approved_units(F.col("x")), cases) == list(cases.values())


def test_ids_and_dates(spark):
    assert values(spark, T.internal_property_id(F.col("x")), ["PN62487/01", "PN 12345", "none", None]) == ["PN62487", "PN12345", None, None]
    assert values(spark, C.type_code(F.col("x")), ["MCU/2017/973", "notavalidformat", None]) == ["MCU", None, None]
    assert values(spark, T.au_date(F.col("x")), ["4/12/2025", "31/02/2020", "x", None]) == [datetime.date(2025, 12, 4), None, None, None]
    assert values(spark, T.display_date(F.col("x")), ["4 Dec 2025", "04 december 2025", "4 Foo 2025"]) == [datetime.date(2025, 12, 4)] * 2 + [None]
    assert values(spark, T.size_bytes(F.col("x")), ["1.5 MB", "10kb", "7 b", "x"]) == [1572864, 10240, 7, None]
    assert values(spark, T.sold_tag(F.col("x")), ["Sold by private treaty 03 Dec 2025", "x"]) == [Row(sold_date=datetime.date(2025, 12, 3), method="private treaty"), Row(sold_date=None, method=None)]


def test_rentals_and_prices(spark):
    cases = {"$980 per week": True, "$1,200/wk": True, "$1500 p.w.": True, "$3500 pcm": True, "$980,000": False, "$1.5M": False, "Contact agent": False, None: False, "": False}
    assert values(spark, T.is_rental(F.col("x")), cases) == list(cases.values())
    assert values(spark, T.price_range(F.col("x")), ["Offers $505k - $1.2m", "$500,000,000", "none"]) == [Row(low=505000, high=1200000), Row(low=None, high=None), Row(low=None, high=None)]


@pytest.mark.parametrize("street,unit,key", [("17 Third Avenue", "", "17|third ave|palm beach|4221"), ("2/17 Third Avenue", "2", "17|third ave|palm beach|4221"), ("17A Third Avenue", "a", "17|third ave|palm beach|4221"), ("3/17a Third Av.", "3a", "17|third ave|palm beach|4221"), ("88 Hooker Boulevard", "", "88|hooker bvd|palm beach|4221")])
def test_match_keys(spark, street, unit, key):
    got = values(spark, T.normalize_address(F.col("x"), F.lit("Palm Beach"), F.lit("4221")), [street])[0]
    assert (got["unit_number"], got["match_key"]) == (unit, key)


def test_addresses(spark):
    got = values(spark, T.split_council_address(F.col("x")), ["Lot 61 RP172633, 22 Viscount Drive, TALLAI QLD 4213", "22 Viscount Drive", None])
    assert got[0] == Row(street="22 Viscount Drive", suburb="Tallai", postcode="4213", state="QLD") and got[1]["street"] is None and got[2]["street"] is None
    pairs = [("Lot 2 SP304034, 15 Matasha Crescent, PIMPAMA QLD 4209", "Matasha Crescent, Pimpama, QLD 4209"), ("x", "15 Matasha Crescent, Pimpama QLD 4209"), (None, "A (b), C")]
    assert values(spark, T.repair_street_address(F.col("a"), F.col("b")), pairs, "a string, b string") == ["15 Matasha Crescent, Pimpama QLD 4209", "15 Matasha Crescent, Pimpama QLD 4209", "A (b), C"]
    assert values(spark, T.canonical_long_form(F.col("x")), ["Boulevarde", "pde", "unknown"]) == ["boulevard", "parade", "unknown"]


def test_kinds(spark):
    rows = [("secondary dwelling", None), ("Dual Occupancy", None), ("x", 8), ("6 Multi-unit Dwelling", None), ("Operational Works", None), (None, None)]
    assert values(spark, C.classify_kind(F.col("d"), F.col("n")), rows, "d string, n int") == ["granny", "duplex", "big_dev", "big_dev", "other", "other"]
    assert values(spark, C.kind_predicate("other", F.col("d"), F.col("n")), rows, "d string, n int")[-1] is None
    assert C.kind_predicate("all", F.lit(""), F.lit(1)) is None
    assert values(spark, C.doc_kind(F.col("x")), ["Response to IR Cover Letter", "Cover Letter", "Amended Plans", None]) == ["ir_response", "decision", "amendment", "other"]


def test_companies_and_rules(spark):
    assert values(spark, T.company_norm(F.col("x")), ["Acme (Qld) Homes  PTY. LTD.", "Foo Limited"]) == ["acme homes", "foo"]
    assert values(spark, T.digits_of(F.col("x"), 9), ["652 330 928", "12", None]) == ["652330928", None, None]
    assert values(spark, E.reject_rule(F.col("x")), ["P", "12 345", "Court", "PROJECT", "See plan", "Boris Design"]) == ["too_short", "all_digits", "street_suffix_only", "header_token", "admin_phrase_prefix", None]
    assert values(spark, E.firm_seed(F.col("k"), F.col("v")), [("url", "borisdesign.com.au"), ("email", "auskidesign@gmail.com"), ("email", "info@gmail.com")], "k string, v string") == ["borisdesign", "auskidesign", None]
    assert values(spark, E.name_candidates(F.col("x")), ["bradruddelldesign"])[0][:4] == ["Bradruddell Design", "Br Adruddell Design", "Bra Druddell Design", "Brad Ruddell Design"]


def test_hashes(spark):
    got = values(spark, H.fnv64(F.col("x")), ["MCU/2025/64", "OPW/2025/123"])
    assert [(r["high"], r["low"]) for r in got] == [(1375591545, 2576732389), (543525026, 3501361720)]
    at = H.with_coordinates(spark.createDataFrame([("MCU/2025/64", "Surfers Paradise")], "a string, s string"), "a", "s").first()
    assert -28.2 < at["lat"] < -27.85 and 153.3 < at["lng"] < 153.55


def test_links(spark):
    links = ["https://www.realestate.com.au/property/1-oak-st-palm-beach-qld-4221/", "https://www.domain.com.au/1-2-oak-street-palm-beach-qld-4221-2019876543", "https://x.org"]
    assert values(spark, U.classify_url(F.col("x")), links) == ["rea_pdp", "domain_listing", None]
    assert values(spark, U.slug_matches(F.col("x"), F.lit("2 Oak Street"), F.lit("Palm Beach")), links) == [False, True, True]
    assert values(spark, U.clean_url(F.col("x")), ["https://a.com/b?x=1#y)", "https://www.realestate.com.au/property/a-b"]) == ["https://a.com/b", "https://www.realestate.com.au/property/a-b/"]


def test_parties(spark):
    from lotline.functions import parties as N

    cases = {
        "Peter Dawson and Noela Roberts": ["Peter Dawson", "Noela Roberts"], "Daniel and Amber Knapp": ["Daniel Knapp", "Amber Knapp"], "Mark & Skye Rustin": ["Mark Rustin", "Skye Rustin"],
        "John Badaloff, Wendy Ann Badaloff": ["John Badaloff", "Wendy Ann Badaloff"], "Storey and Castle Planning": ["Storey and Castle Planning"], "Homecorp Constructions": ["Homecorp Constructions"],
        "The JNP Trust & Darren and Karen Mealing": ["The JNP Trust", "Darren Mealing", "Karen Mealing"], "Bob Builder Pty Ltd and Jane Smith": ["Bob Builder Pty Ltd", "Jane Smith"], " ; ": [], None: None,
    }
    assert values(spark, N.split_parties(F.col("x")), cases) == list(cases.values())
    assert values(spark, N.care_of(F.col("x")), ["A B C/- Planit Pty Ltd", "A B"]) == [Row(party="A B", agent="Planit Pty Ltd"), Row(party="A B", agent=None)]
    assert values(spark, N.without_contact(F.col("x")), ["Urbis Pty Ltd (Attention: M R)", "P/L Att: E"]) == ["Urbis Pty Ltd", "P/L"]
    assert values(spark, N.entity_type(F.col("x")), ["A Pty Ltd", "DAWSON & ROBERTS", "Jane Smith"]) == ["company", "unknown", "individual"]
    letter = "Our reference: X1\n\nJane Smith\nC/- Plan Pty Ltd\n1 A St\n\nDear Sir\nInformation Request\n"
    assert values(spark, N.recipient(F.col("x")), [letter, "none"]) == [Row(name="Jane Smith", agent="Plan Pty Ltd"), Row(name=None, agent=None)]
    assert values(spark, N.letter_kind(F.col("x")), [letter, "x"]) == ["information_request", None]

    def fnv(text):
        h = 0x811C9DC5
        for b in text.encode():
            h = (h ^ b) * 0x01000193 % 2**32
        return h

    h = fnv("165787173")
    a, b = h % 48, (h >> 8) % 48
    want = "-".join([N.ADJECTIVES[a], N.ADJECTIVES[(b + 1) % 48 if a == b else b], N.NOUNS[fnv("165787173:noun") % len(N.NOUNS)]])
    assert values(spark, N.codename(F.col("x")), ["165787173", "", None]) == [want, "unknown", "unknown"]

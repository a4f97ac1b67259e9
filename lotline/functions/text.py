"""Values read out of free text: counts, dates, sizes, prices, names, addresses. Null in, null out."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

STATES = "QLD|NSW|VIC|TAS|WA|SA|NT|ACT"
# Street types and their abbreviation; the first spelling longer than the abbreviation is the long form.
STREET_TYPES = {
    "ave": ["avenue", "ave", "av"], "st": ["street", "st"], "rd": ["road", "rd"], "dr": ["drive", "dr", "drv"],
    "ct": ["court", "ct", "crt"], "pde": ["parade", "pde", "pd"], "tce": ["terrace", "tce", "ter"],
    "cres": ["crescent", "cres", "cr"], "bvd": ["boulevard", "boulevarde", "bvd", "blvd"], "hwy": ["highway", "hwy"],
    "pl": ["place", "pl"], "ln": ["lane", "ln"], "cl": ["close", "cl"], "way": ["way", "wy"],
    "cct": ["circuit", "cct", "cir"], "esp": ["esplanade", "esp"], "prom": ["promenade", "prom"], "gr": ["grove", "gr"],
    "rise": ["rise"], "row": ["row"], "view": ["view"], "sq": ["square", "sq"], "loop": ["loop"],
}
WORD_UNITS = {"dual": 2, "duplex": 2, "triple": 3, "triplex": 3, "fourplex": 4, "quadruplex": 4}
# The patterns of rents, prices, sales, dates, sizes and company forms, and the greatest price taken for one.
RENTAL = r"(?i)per\s+(week|month)|/\s*w(k|eek)?\b|\bp\.?\s*/?\s*w\.?\b|\bpcm\b|\bweekly\b"
PRICE = r"\$([\d,]+(?:\.\d+)?)\s*([kKmM]?)"
SOLD_TAG = r"^Sold(?: by (\w+(?:\s\w+)?))?\s+(?:on\s+)?(\d{1,2}\s+\w+\s+\d{4})$"
SHOWN_DATE = r"^(\d{1,2})\s+(\w{3,9})\s+(\d{4})$"
FILE_SIZE = r"(?i)^([\d.]+)\s*([KMG]?b)$"
COMPANY_FORM = r"\b(pty\.?\s*ltd\.?|pty\.?\s*limited|limited|inc\.?|corp\.?|llc|ltd\.?)\b\.?\s*$"
PRICE_LIMIT = 200_000_000


def let(value: Column, body) -> Column:
    """body(value) with value worked out once, however often body uses it; keeps large expressions small."""
    return F.element_at(F.transform(F.array(value), body), 1)


def mapping(pairs: dict) -> Column:
    return F.create_map(*[F.lit(x) for kv in pairs.items() for x in kv])


SHORT = {word: short for short, words in STREET_TYPES.items() for word in words}
LONG = {short: next((w for w in words if len(w) > len(short)), short) for short, words in STREET_TYPES.items()}


def first_match(text: Column, pattern: str, group: int = 1) -> Column:
    """The group of the first match; null if there is none or it is empty."""
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))


def matches(text: Column, pattern: str, group: int = 1) -> Column:
    """array<struct(value, at, to, value_at)>: every match with its places (from 0) in the text."""
    values, rest = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)), F.split(text, pattern)
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<value:string,at:int,to:int,value_at:int>>").alias("found"))

    def step(s: Column, x: Column) -> Column:
        """x: the text before a match, the match, its value."""
        hit = lambda at: F.struct(x["value"].alias("value"), at.alias("at"), (at + F.length(x["whole"])).alias("to"), (at + F.call_function("locate", x["value"], x["whole"]) - 1).alias("value_at"))
        return let((s["at"] + F.length(x["before"])).cast("int"), lambda at: F.struct((at + F.length(x["whole"])).alias("at"), F.concat(s["found"], F.array(hit(at))).alias("found")))

    rows = lambda whole: F.transform(whole, lambda w, i: F.struct(F.get(rest, i).alias("before"), w.alias("whole"), F.get(values, i).alias("value")))
    return F.aggregate(let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), rows), start, step)["found"]


def approved_units(description: Column) -> Column:
    """A stated number from 2 to 50, else the number a word stands for; 'multi-unit' alone stays null."""
    stated = first_match(description, r"(?i)\b(\d+)\s*x?\s*(?:unit|dwelling|townhouse|apartment|lot)s?\b").try_cast("int")
    number = F.when(stated.between(2, 50), stated)
    words = mapping(WORD_UNITS)
    named = [F.element_at(words, F.lower(first_match(description, p))) for p in (r"(?i)\b(dual|triple|fourplex|quadruplex)\b", r"(?i)\b(duplex|triplex)\b")]
    return F.coalesce(number, *named)


def internal_property_id(description: Column) -> Column:
    return F.concat(F.lit("PN"), first_match(description, r"(?i)\bPN\s*(\d{4,7})\b"))


def real_date(year: Column, month: Column, day: Column) -> Column:
    """The date, or null if there is no such day."""
    return F.try_to_date(F.concat_ws("-", F.lpad(year, 4, "0"), F.lpad(month, 2, "0"), F.lpad(day, 2, "0")), "yyyy-MM-dd")


def au_date(text: Column) -> Column:
    """D/M/YYYY."""
    p = r"^(\d{1,2})/(\d{1,2})/(\d{4})$"
    t = F.trim(text)
    return F.when(t.rlike(p), real_date(*[F.regexp_extract(t, p, g) for g in (3, 2, 1)]))


def display_date(text: Column) -> Column:
    """'4 Dec 2025', month names short or whole."""
    p, t = SHOWN_DATE, F.trim(text)
    names = "january february march april may june july august september october november december".split()
    months = mapping({n: str(i) for i, name in enumerate(names, 1) for n in (name, name[:3])})
    return F.when(t.rlike(p), real_date(F.regexp_extract(t, p, 3), F.element_at(months, F.lower(F.regexp_extract(t, p, 2))), F.regexp_extract(t, p, 1)))


def iso_date(text: Column) -> Column:
    return F.try_to_date(F.substring(text, 1, 10), "yyyy-MM-dd")


def size_bytes(text: Column) -> Column:
    """'1.5 MB' to bytes."""
    p = FILE_SIZE
    unit = F.lower(F.regexp_extract(F.trim(text), p, 2))
    factor = F.when(unit == "kb", 1024).when(unit == "mb", 1024**2).when(unit == "gb", 1024**3).otherwise(1)
    return F.when(F.trim(text).rlike(p), F.floor(F.regexp_extract(F.trim(text), p, 1).try_cast("double") * factor))


def amounts(text: Column, limit: int | None = PRICE_LIMIT) -> Column:
    """All dollar amounts with their k or m suffix, as whole numbers not above the limit, if there is one."""
    pairs = F.arrays_zip(F.regexp_extract_all(text, F.lit(PRICE), F.lit(1)).alias("n"), F.regexp_extract_all(text, F.lit(PRICE), F.lit(2)).alias("s"))
    scale = lambda s: F.when(F.lower(s) == "k", 1e3).when(F.lower(s) == "m", 1e6).otherwise(1.0)
    values = F.transform(pairs, lambda x: F.floor(F.replace(x["n"], F.lit(","), F.lit("")).try_cast("double") * scale(x["s"])).cast("long"))
    return F.filter(values, lambda v: v.isNotNull() if limit is None else v.isNotNull() & (v <= limit))


def price_range(text: Column, limit: int | None = PRICE_LIMIT) -> Column:
    """struct(low, high) of the amounts."""
    return F.struct(F.array_min(amounts(text, limit)).alias("low"), F.array_max(amounts(text, limit)).alias("high"))


def price_first(text: Column) -> Column:
    return F.replace(first_match(text, r"\$([\d,]+)"), F.lit(","), F.lit("")).try_cast("long")


def price_digits(text: Column) -> Column:
    return F.regexp_replace(text, r"\D", "").try_cast("long")


def is_rental(text: Column) -> Column:
    return F.coalesce(text.rlike(RENTAL), F.lit(False))


def sold_tag(text: Column) -> Column:
    """struct(sold_date, method) of 'Sold by auction 03 Dec 2025'."""
    p, t = SOLD_TAG, F.trim(text)
    return F.struct(display_date(first_match(t, p, 2)).alias("sold_date"), first_match(t, p, 1).alias("method"))


def land_m2(value: Column, unit: Column) -> Column:
    """Whole square metres of a size given in m2, hectares or acres; null unless positive."""
    u = F.lower(F.coalesce(unit, F.lit("")))
    n = value.try_cast("double")
    factor = F.when(u.contains("m"), 1.0).when(u.contains("ha"), 10_000.0).when(u.contains("ac"), 4046.8564).otherwise(1.0)
    return F.when(n > 0, F.floor(n * factor).cast("long"))


def room_count(value: Column) -> Column:
    n = F.floor(value.try_cast("double")).cast("int")
    return F.when(n.between(0, 99), n)


def company_norm(name: Column) -> Column:
    """Lower case, without bracketed notes and a closing company form, blanks squeezed."""
    text = F.regexp_replace(F.trim(F.lower(name)), r"\([^)]*\)", "")
    text = F.trim(F.regexp_replace(text, COMPANY_FORM, ""))
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def digits_of(text: Column, n: int) -> Column:
    """The digits, if there are exactly n of them (9 for an ACN, 11 for an ABN)."""
    digits = F.regexp_replace(text, r"\D+", "")
    return F.when(F.length(digits) == n, digits)


def canonical_long_form(street_type: Column) -> Column:
    """Any spelling of a street type to its long form; unknown ones pass through."""
    s = F.trim(F.lower(street_type))
    return F.coalesce(F.element_at(mapping(LONG), F.coalesce(F.element_at(mapping(SHORT), s), s)), street_type)


def squeezed(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def normalize_address(street: Column, suburb: Column, postcode: Column) -> Column:
    """struct(unit_number, street_number, street_norm, suburb_norm, match_key).

    '2/17 Third Avenue' and '17A Third Avenue' share the match key of '17 Third Avenue': what stands
    before a slash, and letters after the number, belong to the unit. Unit and number keep 16 characters.
    """
    punct = r"[^\w\s/]+"
    plain = lambda c: F.lower(F.trim(F.regexp_replace(c, punct, "")))
    raw = squeezed(F.coalesce(street, F.lit("")))
    slash = raw.contains("/")
    unit = F.when(slash, F.left(plain(F.substring_index(raw, "/", 1)), F.lit(16))).otherwise("")
    rest = F.when(slash, F.trim(F.regexp_replace(raw, "^[^/]*/", ""))).otherwise(raw)
    number = plain(F.substring_index(rest, " ", 1))
    name = squeezed(F.lower(F.regexp_replace(F.when(rest.contains(" "), F.regexp_replace(rest, r"^\S*\s", "")).otherwise(""), punct, "")))
    lettered = number.rlike(r"^\d+[a-z]+$")
    last = F.element_at(F.split(name, " "), -1)
    norm = F.concat(F.left(name, F.length(name) - F.length(last)), F.coalesce(F.element_at(mapping(SHORT), last), last))
    unit = F.when(lettered, F.left(F.concat(unit, F.regexp_extract(number, "([a-z]+)$", 1)), F.lit(16))).otherwise(unit)
    number = F.left(F.when(lettered, F.regexp_extract(number, r"^(\d+)", 1)).otherwise(number), F.lit(16))
    place = squeezed(F.lower(F.regexp_replace(F.coalesce(suburb, F.lit("")), punct, "")))
    key = F.concat_ws("|", number, norm, place, F.trim(F.coalesce(postcode, F.lit(""))))
    return F.struct(unit.alias("unit_number"), number.alias("street_number"), norm.alias("street_norm"), place.alias("suburb_norm"), key.alias("match_key"))


def split_council_address(raw: Column) -> Column:
    """struct(street, suburb, postcode, state); all null unless the upper-case suburb, state and postcode close the text."""
    p = rf",\s*([^,]+?),\s*([A-Z][A-Z \-']+)\s+({STATES})\s+(\d{{4}})\s*$"
    part = lambda g: F.nullif(F.trim(F.regexp_extract(raw, p, g)), F.lit(""))
    return F.struct(part(1).alias("street"), F.initcap(F.lower(part(2))).alias("suburb"), part(4).alias("postcode"), part(3).alias("state"))


def split_address(address: Column) -> Column:
    """struct(street, suburb, state, postcode) of 'street, suburb STATE postcode'; the street's type is written out.

    Without a comma all of it is the street, as it is; without state and postcode these are ''.
    """
    pieces = F.filter(F.transform(F.split(address, ","), lambda p: F.trim(p)), lambda p: p != "")
    tail = r"^(.+?)\s+([A-Z]{2,3})\s+(\d{4})$"

    def read(ps: Column) -> Column:
        rest, whole = F.array_join(F.slice(ps, 2, F.greatest(F.size(ps), F.lit(1))), " "), F.size(ps) > 1
        words = F.split(F.get(ps, F.lit(0)), r"\s+")
        street = F.array_join(F.concat(F.slice(words, 1, F.size(words) - 1), F.array(canonical_long_form(F.element_at(words, -1)))), " ")
        return F.struct(F.when(whole, street).otherwise(F.trim(address)).alias("street"), F.when(rest.rlike(tail), F.trim(F.regexp_extract(rest, tail, 1))).otherwise(rest).alias("suburb"), F.regexp_extract(rest, tail, 2).alias("state"), F.regexp_extract(rest, tail, 3).alias("postcode"))

    return let(pieces, read)


def repair_street_address(raw: Column, street: Column) -> Column:
    """Put back a street number that stands before the street name in the raw address; drop the comma before state and postcode."""
    name = F.trim(F.substring_index(street, ",", 1))
    number = F.call_function("regexp_extract", raw, F.concat(F.lit(r"(?i)(\d+[A-Za-z]?(?:[-/]\d+[A-Za-z]?)?)\s+\Q"), name, F.lit(r"\E")), F.lit(1))
    fixed = F.when(street.rlike(r"^\s*\d") | (name == "") | F.coalesce(number == "", F.lit(True)), street).otherwise(F.concat(number, F.lit(" "), street))
    return F.regexp_replace(fixed, rf"(?i),\s*({STATES})\s+(\d{{4}})\s*$", " $1 $2")


def street_only(raw: Column) -> Column:
    """The first comma part that begins with a number, else the first part."""
    parts = F.transform(F.split(raw, ","), lambda p: F.trim(p))
    return F.coalesce(F.get(F.filter(parts, lambda p: p.rlike(r"^\d")), F.lit(0)), F.get(parts, F.lit(0)))

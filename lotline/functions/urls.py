"""Links: kind, clean form, host, match with an address, slugs, website scores."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Shapes of portal links, hosts left out of general search, keywords and host lists of the score.
URL_KINDS = {
    "rea_pdp": r"^https?://www\.realestate\.com\.au/property/[a-z0-9-]+/?$",
    "rea_sold": r"^https?://www\.realestate\.com\.au/sold/[^?#]+?-(\d{6,})\b",
    "rea_buy": r"^https?://www\.realestate\.com\.au/(?:property-|buy/)[^?#]+?-(\d{6,})\b",
    "domain_pdp": r"^https?://www\.domain\.com\.au/property-profile/[a-z0-9-]+/?$",
    "domain_listing": r"^https?://www\.domain\.com\.au/(?!property-profile/)[a-z0-9-]+-(\d{6,})\b",
}
DENIED_HOSTS = ["google.com", "www.google.com", "policies.google.com", "support.google.com", "maps.google.com", "translate.google.com", "accounts.google.com", "schema.org", "www.w3.org", "gstatic.com", "www.gstatic.com", "googleusercontent.com", "googleapis.com", "www.realestate.com.au", "realestate.com.au", "www.domain.com.au", "domain.com.au"]
ROLE_WORDS = {"builder": "build|construct|homes|developments|projects", "architect": "architect|design|studio|drafting"}
DIRECTORIES = ["truelocal.com.au", "yellowpages.com.au", "hotfrog.com.au", "yelp.com.au", "oneflare.com.au", "australia.com", "localsearch.com.au", "businesslistingsaustralia.com", "searchfrog.com.au", "australianbusinessesonline.com.au", "homely.com.au", "houzz.com.au"]
SOCIAL = ["linkedin.com", "facebook.com", "instagram.com", "twitter.com", "x.com", "youtube.com", "tiktok.com"]
PROFILE_SLUG = r"/(?:property|property-profile)/([a-z0-9][a-z0-9-]*)/?"
LISTING_SLUG = r"(?i)^https?://www\.domain\.com\.au/(?!property-profile/)([a-z0-9-]+?)-\d{6,}\b"
SOLD_SLUG = r"(?i)^https?://www\.realestate\.com\.au/sold/([a-z0-9+-]+?)-\d{6,}\b"
BARE_PROFILE = r"^https?://www\.realestate\.com\.au/property/[a-z0-9-]+$"


def classify_url(url: Column) -> Column:
    out = None
    for kind, pattern in URL_KINDS.items():
        out = F.when(url.rlike(pattern), kind) if out is None else out.when(url.rlike(pattern), kind)
    return out


def clean_url(url: Column) -> Column:
    """Cut at a backslash, fragment or query; closing punctuation dropped; profile links end with a slash."""
    text = F.substring_index(url, "\\", 1)
    text = F.substring_index(F.substring_index(F.replace(text, F.lit("&amp;"), F.lit("&")), "#", 1), "?", 1)
    text = F.regexp_replace(text, r"""[/.,;)>'"]+$""", "")
    return F.when(text.rlike(BARE_PROFILE), F.concat(text, F.lit("/"))).otherwise(text)


def host(url: Column) -> Column:
    return F.lower(F.nullif(F.regexp_extract(url, r"^https?://([^/?#]+)", 1), F.lit("")))


def is_third_party(url: Column) -> Column:
    h = host(url)
    return F.coalesce(~h.isin(DENIED_HOSTS) & ~h.endswith(".google.com") & ~h.endswith(".googleusercontent.com"), F.lit(False))


def bare_host(url: Column) -> Column:
    return F.regexp_replace(host(url), r"^www\.", "")


def on_any(h: Column, hosts: list[str]) -> Column:
    return F.coalesce(h.rlike(r"(^|\.)(" + "|".join(x.replace(".", r"\.") for x in hosts) + ")$"), F.lit(False))


def website_score(url: Column, name: Column, role: Column) -> Column:
    """+3 for the name in the host, +2 for a word of the role, +1 for .com.au, -2 for directories, -1 for social sites."""
    h = bare_host(url)
    slug = F.left(F.regexp_replace(F.lower(name), "[^a-z0-9]+", ""), F.lit(12))
    words = F.when(role == "builder", h.rlike(ROLE_WORDS["builder"])).when(role == "architect", h.rlike(ROLE_WORDS["architect"]))
    score = F.when((slug != "") & F.replace(h, F.lit("."), F.lit("")).contains(slug), 3).otherwise(0) + F.when(words, 2).otherwise(0) + F.when(h.endswith(".com.au"), 1).otherwise(0)
    return F.when(h.isNull(), -10).otherwise(score - F.when(h.isin(DIRECTORIES), 2).otherwise(0) - F.when(on_any(h, SOCIAL), 1).otherwise(0))


def confidence(score: Column) -> Column:
    return F.when(score >= 5, "high").when(score >= 3, "medium").when(score >= 1, "low").otherwise("no_match")


def slug_matches(url: Column, address: Column, suburb: Column) -> Column:
    """Whether a link can be about the address: its number after a unit prefix, and the suburb; links of unknown shape pass."""
    number = F.nullif(F.regexp_extract(address, r"^\s*(\d+)\b", 1), F.lit(""))
    place = F.replace(F.lower(suburb), F.lit(" "), F.lit("-"))
    profile = F.nullif(F.regexp_extract(url, PROFILE_SLUG, 1), F.lit(""))
    listing = F.nullif(F.lower(F.regexp_extract(url, LISTING_SLUG, 1)), F.lit(""))
    sold = F.nullif(F.lower(F.regexp_extract(url, SOLD_SLUG, 1)), F.lit(""))
    body = F.regexp_replace(F.regexp_replace(F.coalesce(profile, listing), r"^unit-\d+[a-z]?-", ""), r"^\d+[a-z]?-(?=\d+-)", "")
    same = (F.regexp_extract(body, r"^(\d+)[a-z]?-", 1) == number) & F.coalesce(body.contains(place), F.lit(True))
    return F.when(F.coalesce(profile, listing).isNotNull(), F.coalesce(number.isNull() | same, F.lit(True))).when(sold.isNotNull(), F.coalesce(sold.contains(place), F.lit(True))).otherwise(True)


def portal_slug(street: Column, suburb: Column, state: Column, postcode: Column) -> Column:
    """'12-oak-street-palm-beach-qld-4221'."""
    text = F.lower(F.concat_ws(" ", street, suburb, state, postcode))
    return F.regexp_replace(F.regexp_replace(text, r"[^a-z0-9]+", "-"), r"^-+|-+$", "")

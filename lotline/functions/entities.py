"""Identifying tokens, firm names and name rules, as column expressions over page text."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotline.functions.text import matches

# Patterns of identifying tokens and the group that holds the value.
LICENCE_TAIL = r"\s*(?:LICEN[CS]E|LIC\.?(?:\s*NO\.?)?)[^\n]{0,40}?(?:N[°o]?|No\.?|NUMBER|#)?\.?\s*[:.\-]?\s*(\d[\d\s]*[A-Z]?)"
PATTERNS: dict[str, tuple[str, int]] = {
    "url": (r"(?i)\b(?:https?://)?(?:www\.)?([a-z][a-z0-9\-]+(?:\.[a-z][a-z0-9\-]+)*\.(?:com\.au|net\.au|org\.au|com|net|org|design|architects?))\b(?:/[^\s]*)?", 1),
    "email": (r"(?i)\b([a-z0-9._%+\-]+@[a-z0-9.\-]+\.[a-z]{2,})\b", 1),
    "phone": (r"\b(?:\(0[2-9]\)\s*\d{4}\s*\d{4}|0[2-9]\s*\d{4}\s*\d{4}|04\d{2}\s*\d{3}\s*\d{3}|1[38]00\s*\d{3}\s*\d{3})\b", 0),
    "qbcc": (r"(?i)\bQ\.?B\.?C\.?C\.?" + LICENCE_TAIL, 1),
    "qbsa": (r"(?i)\bQ\.?B\.?S\.?A\.?" + LICENCE_TAIL, 1),
    "bsa": (r"(?i)\bBSA\s+(?:LICEN[CS]E|LIC\.?)\s*[:.\-]?\s*(\d[\d\s]*[A-Z]?)", 1),
    "vba": (r"(?i)\bVBA\s+(?:LICEN[CS]E|LIC\.?)\s*(?:NUMBER|N[°o]?|No\.?|#)?\.?\s*[:.\-]?\s*([A-Z]{1,4}[-\s]?[A-Z]{0,4}\s*\d[\d\s]*)", 1),
    "licence_other": (r"(?i)\b(?:NSW\s+)?BUILDERS?\s+LICEN[CS]E\s*(?:N[°o]?|No\.?|NUMBER|#)?\.?\s*[:.\-]?\s*(\d[\d\s]*[A-Z]?)", 1),
    "acn": (r"(?i)\bA\.?\s*C\.?\s*N\.?\s*[:.]?\s*(\d{3}\s*\d{3}\s*\d{3})\b", 1),
    "abn": (r"(?i)\bA\.?\s*B\.?\s*N\.?\s*[:.]?\s*(\d{2}\s*\d{3}\s*\d{3}\s*\d{3})\b", 1),
}
#: How the hosts of the url pattern end, plurals and countries aside.
HOST_ENDINGS = ["com", "net", "org", "design", "architect"]
IGNORED_HOSTS = ["goldcoast.qld.gov.au", "qld.gov.au", "gov.au", "asic.gov.au", "energex.com.au", "ergon.com.au", "urbanutilities.com.au", "qldwater.com.au", "australia.com", "google.com", "youtube.com", "facebook.com", "instagram.com", "linkedin.com"]
GENERIC_MAIL_HOSTS = ["gmail.com", "googlemail.com", "hotmail.com", "hotmail.com.au", "hotmail.co.uk", "yahoo.com", "yahoo.com.au", "outlook.com", "outlook.com.au", "live.com", "live.com.au", "msn.com", "icloud.com", "me.com", "mac.com", "bigpond.com", "bigpond.com.au", "bigpond.net.au", "bigpond.net", "iinet.net.au", "internode.on.net", "tpg.com.au", "optusnet.com.au", "optus.com.au", "westnet.com.au", "dodo.com.au"]
GENERIC_MAILBOXES = ["info", "admin", "administrator", "contact", "hello", "mail", "email", "sales", "support", "office", "enquiries", "enquiry", "team", "staff", "reception", "general", "noreply", "no-reply"]
FIRM_ENDINGS = ["architecture", "architects", "architect", "design", "designs", "designer", "designers", "studio", "studios", "planning", "planners", "consulting", "consultancy", "consultants", "homes", "constructions", "construction", "builders", "group", "holdings", "developments", "development", "drafting", "drafts", "surveying", "surveyors", "surveys", "survey", "engineering", "engineers", "engineer"]
HEADER_WORDS = ["PROJECT", "ADDRESS", "LOT", "DATE", "AMENDMENTS", "CHKD", "CHECKED", "AREA", "SITE", "TLF", "PH", "FAX", "PO BOX", "SHEET", "DRG", "DESCRIPTION", "TITLE", "CLIENT", "NOTES", "ISSUE", "DESIGN", "SCALE", "PLAN", "APPROVED", "REJECTED", "BUILDER", "BUILDERS", "ARCHITECT", "OWNER", "APPLICANT", "AGENT", "SHEETS", "REV", "REVISION", "ORIGINAL", "COPY", "SIGNED", "WITNESS", "PRINT", "NAME", "ROLE", "JOB", "REF", "FILE", "DRAWING", "DRAWN", "AUTH", "PROPOSED", "EXISTING", "AMEND", "LEVEL", "TBC", "TBA", "NTS", "QLD", "NSW", "VIC", "TAS", "WA", "SA", "NT", "ACT"]
STREET_WORDS = ["STREET", "ROAD", "AVENUE", "DRIVE", "COURT", "PLACE", "LANE", "PARADE", "TERRACE", "CRESCENT", "BOULEVARD", "BOULEVARDE", "WAY", "HIGHWAY", "CIRCUIT", "ESPLANADE", "PROMENADE", "CLOSE", "GROVE", "ROW", "VIEW", "SQUARE", "LOOP", "RISE"]


def normal_value(kind: str, value: Column) -> Column:
    """The form to join by; null if the value is not one of its kind."""
    digits = F.regexp_replace(value, r"\D", "")
    if kind == "url":
        host = F.regexp_replace(F.lower(value), r"^www\.", "")
        return F.when(~host.isin(IGNORED_HOSTS), host)
    if kind == "email":
        return F.when(~F.substring_index(F.lower(value), "@", -1).isin(IGNORED_HOSTS), F.lower(value))
    if kind == "phone":
        return F.when(F.length(digits) >= 8, digits)
    if kind in ("acn", "abn"):
        return F.when(F.length(digits) == (9 if kind == "acn" else 11), digits)
    return F.when(digits != "", F.upper(F.regexp_replace(value, r"\s+", "")))


#: The gate column of each kind; the licences have one in common.
GATES = {"url": "_host", "email": "_at", "phone": "_digits", "acn": "_digits", "abn": "_digits"}


def gated(pages: DataFrame, keys: list[str], text: str) -> DataFrame:
    """keys, text, and cheap tests that it can hold tokens of a kind: patterns are only run where they pass.

    Each test is a column of its own, so that it is made once for all the kinds that read it.
    """
    low = pages.select(*keys, F.col(text).alias("_text"), F.lower(text).alias("_low"))
    host = reduce(or_, (F.col("_low").contains("." + e) for e in HOST_ENDINGS))
    licence = F.col("_low").contains("lic") & F.col("_low").rlike("[0-9]")
    return low.select(*keys, "_text", host.alias("_host"), F.col("_low").contains("@").alias("_at"), F.col("_low").rlike("[0-9]{3}").alias("_digits"), licence.alias("_licence"))


def fingerprints(pages: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """keys, kind, normalized_value: each identifying token once per page."""
    every = []
    for kind, (pattern, group) in PATTERNS.items():
        found = F.when(F.col(GATES.get(kind, "_licence")), F.regexp_extract_all("_text", F.lit(pattern), F.lit(group))).otherwise(F.array().cast("array<string>"))
        every.append(F.transform(F.array_distinct(F.filter(_normalised(kind, found), lambda v: v.isNotNull())), _tagged(kind)))
    rows = gated(pages, keys, text).where("_host or _at or _digits or _licence")
    return rows.select(*keys, F.explode(F.concat(*every)).alias("f")).select(*keys, "f.*")


def fingerprint_spans(pages: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """keys, kind, raw_value, normalized_value, span_start, span_end (from 0): the first place of each identifying token on a page."""
    every = []
    for kind, (pattern, group) in PATTERNS.items():
        hits = F.when(F.col(GATES.get(kind, "_licence")), matches(F.col("_text"), pattern, group))
        every.append(F.transform(F.coalesce(hits, F.array().cast("array<struct<value:string,at:int,to:int,value_at:int>>")), _placed(kind)))
    rows = gated(pages, keys, text).select(*keys, F.explode(F.concat(*every)).alias("f")).select(*keys, "f.*").where("normalized_value is not null")
    first = F.min_by(F.struct("raw_value", "span_start", "span_end"), "span_start")
    return rows.groupBy(*keys, "kind", "normalized_value").agg(first.alias("_f")).select(*keys, "kind", "_f.raw_value", "normalized_value", "_f.span_start", "_f.span_end")


def _placed(kind: str):
    return lambda m: F.struct(F.lit(kind).alias("kind"), m["value"].alias("raw_value"), normal_value(kind, m["value"]).alias("normalized_value"), m["at"].alias("span_start"), m["to"].alias("span_end"))


def _normalised(kind: str, values: Column) -> Column:
    return F.transform(values, lambda v: normal_value(kind, v))


def _tagged(kind: str):
    return lambda v: F.struct(F.lit(kind).alias("kind"), v.alias("normalized_value"))


def firm_seed(kind: Column, value: Column) -> Column:
    """The word a firm's name is made from: the host's first part, or the mailbox at a generic host; null if none or short.

    Links to generic mail hosts and mailboxes like info@ at them hint at no firm.
    """
    host, box = F.substring_index(value, "@", -1), F.regexp_replace(F.substring_index(value, "@", 1), r"[._\-+]", "")
    stem = F.substring_index(F.regexp_replace(host, r"\.(com\.au|net\.au|org\.au|com|net|org)$", ""), ".", 1)
    generic = host.isin(GENERIC_MAIL_HOSTS)
    mail = F.when(~generic, stem).when(~box.isin(GENERIC_MAILBOXES), box)
    seed = F.when((kind == "url") & ~generic, stem).when((kind == "email") & value.contains("@"), mail)
    return F.when(F.length(seed) >= 4, seed)


def name_candidates(seed: Column) -> Column:
    """Spellings to look for, likeliest first: split before a known ending, then inside the stem, else anywhere; the plain word last."""
    word = F.replace(F.lower(seed), F.lit("-"), F.lit(""))
    ending = F.regexp_extract(word, "^.+?(" + "|".join(sorted(FIRM_ENDINGS, key=len, reverse=True)) + ")$", 1)
    stem = F.left(word, F.length(word) - F.length(ending))
    halves = lambda w, tail: F.transform(F.when(F.length(w) > 3, F.sequence(F.lit(2), F.length(w) - 2)).otherwise(F.array().cast("array<int>")), lambda i: F.initcap(F.concat_ws(" ", F.left(w, i), F.substr(w, i + 1), tail)))
    known = F.concat(F.array(F.initcap(F.concat_ws(" ", stem, ending))), halves(stem, ending), F.when(F.length(stem) >= 3, F.array(F.initcap(stem))).otherwise(F.array().cast("array<string>")))
    spelled = F.when(ending != "", known).otherwise(halves(word, F.lit(None).cast("string")))
    every = F.concat(spelled, F.array(F.initcap(F.lower(seed)), F.upper(seed)))
    return F.filter(every, lambda c, i: F.array_position(F.transform(every, lambda x: F.lower(x)), F.lower(c)) == i + 1)


def reject_rule(name: Column) -> Column:
    """The first rule by which a candidate name is rejected; null if none."""
    n = F.trim(F.coalesce(name, F.lit("")))
    up = F.upper(n)
    long_word = F.exists(F.split(n, r"\s+"), lambda w: F.length(w) > 12)
    return (
        F.when(F.length(n) < 4, "too_short").when(F.replace(n, F.lit(" "), F.lit("")).rlike(r"^\d+$"), "all_digits").when(~n.rlike(r"\p{L}"), "no_alpha").when(up.isin(HEADER_WORDS), "header_token")
        .when(up.isin(STREET_WORDS), "street_suffix_only").when(n.rlike(r"(?i)^(?:see|refer|ph|fax|tel|email|web|po\s*box|p\.?o\.?|c/-)\b"), "admin_phrase_prefix")
        .when((F.length(n) > 35) & (n == up) & n.contains(" ") & long_word, "all_uppercase_long").when(F.length(n) > 80, "enormous")
    )


def filter_entities(evidence: DataFrame, version: str) -> DataFrame:
    """Predicted evidence that breaks a rule becomes rejected, with the rule and version; other statuses stay."""
    rule = F.when(F.col("status") == "predicted", reject_rule(F.col("candidate_name")))
    return evidence.withColumns({"rule": rule, "rule_version": F.when(rule.isNotNull(), version), "status": F.when(rule.isNotNull(), "rejected").otherwise(F.col("status"))})


def norm_bbox(box: Column, width: Column, height: Column) -> Column:
    """[x0, y0, x1, y1] scaled to 0..1000, clamped and put in order."""
    scaled = lambda v, size: F.greatest(F.lit(0), F.least(F.lit(1000), F.floor(v / size * 1000))).cast("int")
    x0, y0, x1, y1 = scaled(box[0], width), scaled(box[1], height), scaled(box[2], width), scaled(box[3], height)
    return F.array(F.least(x0, x1), F.least(y0, y1), F.greatest(x0, x1), F.greatest(y0, y1))

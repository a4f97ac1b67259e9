"""Kinds of planning applications, documents and outcomes, as column expressions.

Three classifiers of a description exist side by side and differ on purpose: `classify_kind` (row
label), `kind_predicate` (list filter, three-valued on null descriptions) and `dwelling_kind`.
"""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# The word patterns that stand for each kind.
SECONDARY = ["secondary", "granny", "auxiliary", "ancillary"]
KIND_TOKENS = {"granny": "granny", "duplex": "duplex", "big_dev": "big_dev", "big-dev": "big_dev", "bigdev": "big_dev", "other": "other"}
APPROVED_EXACT = ["approved", "approved with conditions"]
LABEL_GRANNY = r"(?i)\b(secondary\s+dwelling|granny\s+flat|auxiliary\s+dwelling|ancillary\s+dwelling)\b"
LABEL_DUPLEX = r"(?i)\b(dual\s+occupancy|duplex)\b"
LABEL_BIG = r"(?i)\b(triplex|fourplex|quadruplex|multi[\s-]?(unit|dwelling|residential)|townhouse|apartment\s+building|\d+\s*x?\s*(unit|dwelling|townhouse|apartment)s?)\b"
FILTER_GRANNY = r"(?i)secondary\s+dwelling|granny\s+flat|auxiliary\s+dwelling|ancillary\s+dwelling"
FILTER_DUPLEX = r"(?i)dual\s+occupancy|duplex"
FILTER_LARGER = r"(?i)triplex|fourplex|quadruplex|multi[\s-]+unit|multi[\s-]+dwelling"
FILTER_NOT_OTHER = r"(?i)secondary\s+dwelling|granny\s+flat|dual\s+occupancy|duplex|triplex|fourplex|multi[\s-]+unit|multi[\s-]+dwelling"


def classify_kind(description: Column, units: Column) -> Column:
    """granny, duplex, big_dev or other; three or more units decide before any word does."""
    text = F.coalesce(description, F.lit(""))
    return F.when(units >= 3, "big_dev").when(text.rlike(LABEL_GRANNY), "granny").when(text.rlike(LABEL_BIG), "big_dev").when(text.rlike(LABEL_DUPLEX), "duplex").otherwise("other")


def kind_predicate(kind: str | None, description: Column, units: Column) -> Column | None:
    """Filter for a kind token; None for no filter. Null descriptions give null, also for 'other'."""
    name = KIND_TOKENS.get((kind or "").lower())
    if name == "granny":
        return description.rlike(FILTER_GRANNY)
    if name == "duplex":
        return description.rlike(FILTER_DUPLEX) & ~description.rlike(FILTER_LARGER)
    if name == "big_dev":
        return (units >= 3) | description.rlike(FILTER_LARGER) | description.rlike("(?i)townhouse")
    if name == "other":
        return ~description.rlike(FILTER_NOT_OTHER)
    return None


def has_phrase(text: Column, *phrases: str) -> Column:
    """Whether lower-case text holds one of the phrases."""
    return reduce(or_, [F.lower(text).contains(p) for p in phrases])


def is_approved(outcome: Column) -> Column:
    """Any wording that holds 'approv'; null outcomes are not approved."""
    return F.coalesce(has_phrase(outcome, "approv"), F.lit(False))


def is_approved_exactly(outcome: Column) -> Column:
    return F.coalesce(F.lower(outcome).isin(APPROVED_EXACT), F.lit(False))


def da_status(outcome: Column, status: Column) -> Column:
    """approved or refused by the outcome, withdrawn by the status, else awaiting."""
    return F.when(has_phrase(outcome, "approv"), "approved").when(has_phrase(outcome, "refus"), "refused").when(has_phrase(status, "withdrawn"), "withdrawn").otherwise("awaiting")


def type_code(application_id: Column) -> Column:
    """Two to four leading letters before a slash, upper-cased; else null."""
    return F.upper(F.nullif(F.regexp_extract(application_id, r"^([A-Za-z]{2,4})/", 1), F.lit("")))


def type_allowed(application_id: Column, codes: list[str]) -> Column:
    return F.substring_index(application_id, "/", 1).isin([c.upper() for c in codes])


def target_kind_predicate(kind: str, description: Column) -> Column:
    """Batch target kinds: duplex without larger words, big_dev, granny, or redev (both multi-dwelling kinds)."""
    duplex, larger = description.rlike(FILTER_DUPLEX), description.rlike(FILTER_LARGER)
    return {"duplex": duplex & ~larger, "big_dev": larger | description.rlike("(?i)townhouse"), "granny": description.rlike(FILTER_GRANNY), "redev": duplex | larger | description.rlike("(?i)townhouse")}[kind]


def every(*conditions: Column | None) -> Column:
    """Conjunction of the conditions that are given."""
    return reduce(and_, [c for c in conditions if c is not None], F.lit(True))


def dwelling_count(description: Column, units: Column) -> Column:
    """Stated units, else what the first matching word stands for, else null."""
    return (
        F.when(units.isNotNull(), units)
        .when(description.rlike(FILTER_DUPLEX), 2)
        .when(description.rlike("(?i)triplex"), 3)
        .when(description.rlike("(?i)fourplex|quadruplex"), 4)
        .when(description.rlike(FILTER_GRANNY), 1)
    )


def dwelling_kind(description: Column, units: Column) -> Column:
    """granny, then big_dev, then duplex, else null: here granny words come before the unit count."""
    return F.when(description.rlike(FILTER_GRANNY), "granny").when((units >= 3) | description.rlike(FILTER_LARGER + "|townhouse"), "big_dev").when(description.rlike(FILTER_DUPLEX), "duplex")


# Phrases that mark the stage of a document type, in order of precedence.
DOC_STAGES = {
    "ir_response": ["response to information", "response to ir"],
    "further_info": ["further information", "further info"],
    "ir_council": ["information request", "action notice"],
    "decision": ["confirmation notice", "decision notice", "decision_notice", "decision cover letter", "cover letter decision", "delegated planner", "planner delegated", "planners delegated", "delegated report", "stamped approved", "final icn", "infrastructure charge", "completion certificate"],
    "amendment": ["amended ", "revised"],
    "submission": ["form", "supporting document", "plan", "drawing", "specialist report", "code assessment", "landscape intent", "attachment", "section 1", "section 2", "section 3", "section 4", "owner consent", "owners consent", "owner's consent", "engineers certificate", "qleave", "application package", "operational works", "notice of intention", "notice of compliance"],
    "decision_late": ["cover letter", "delegated"],
}


def doc_kind(doc_type: Column) -> Column:
    """Workflow stage of a document type; 'other' if nothing matches or the type is empty."""
    text = F.trim(F.lower(F.coalesce(doc_type, F.lit(""))))
    out = F.when(text == "", "other")
    for stage, phrases in DOC_STAGES.items():
        hit = has_phrase(text, *phrases)
        out = out.when(hit | text.startswith("amended") if stage == "amendment" else hit, stage.removesuffix("_late"))
    return out.otherwise("other")


def treatment(widgets: Column, chars: Column, pages: Column, mean_chars: Column) -> Column:
    """How a document is read, from its text features."""
    return F.when(widgets >= 3, "acroform_filled").when((chars < 200) & (widgets == 0), "image_only").when((pages == 1) & (mean_chars < 1500), "titleblock").when((pages >= 6) & (mean_chars >= 1500), "narrative_long").otherwise("narrative_short")

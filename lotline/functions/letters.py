"""What letters and plan title blocks say about parties, as column expressions over a document's text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lotline.functions.entities import IGNORED_HOSTS, PATTERNS
from lotline.functions.parties import FIRM, care_of, entity_type, is_letter, parts, split_parties, without_contact
from lotline.functions.text import digits_of, first_match, let, matches, squeezed

# The shapes of letter heads, closings, firm lines, plan anchors and licences, and their word lists.
POSTAL = r"^([A-Z][A-Z\s'\-]+?)\s+(?:QLD|NSW|VIC|ACT|SA|WA|TAS|NT)\s+(\d{4})$"
OUR_REFERENCE = r"(?m)^\s*Our reference:\s*\S.*$"
DEAR = r"^Dear\s+(?:Sir|Madam|Mr|Mrs|Ms|Mx|All)"
BODY_STARTS = r"(?i)^(?:i refer to|please find|this letter|applicant name:)"
CARE_OF = r"^[Cc]\s*/\s*-?\s*(.+?)$"
APPLICANT_BLOCK = r"(?is)Applicant\s+name:\s*\n\s*(.+?)\s*\n\s*Applicant\s+contact\s+details:\s*\n\s*(.+?)(?=\n\s*\n|\n\s*Application\s+(?:details|number)|\n\s*Application\b|$)"
REFER_BY_NAME = r"(?i)I\s+refer\s+to\s+the\s+development\s+application\s+lodged\s+by:\s*\n(?:Applicant\s+name:\s*\n)?(.+?)\s*\n(?:Applicant\s+contact\s+details:[\s\S]*?\n)?(?:.*?\n){0,8}?\s*in\s+relation\s+to\s+development\s+of\s+land"
SIGN_OFF = r"(?i)\bYours\s+(?:sincerely|faithfully|truly)\b|\bKind\s+regards\b|\bBest\s+regards\b|\bWarm\s+regards\b|\bRegards\b"
COUNCIL_HEAD = r"(?i)\bOur\s+reference\s*:\s*(?:MCU|COM|ROL|EDA|EXA|PDA|FDA|OPW|RDA|SBA)/\d"
COUNCIL_FOOT = r"(?i)For\s+the\s+(?:Chief\s+Executive\s+Officer|Mayor)"
FIRM_SUFFIX = r"Pty\s*Ltd|Pty\s*Limited|Pty\.\s*Ltd\.?|Limited|Ltd|Group|Consulting|Consultants|Engineering|Engineers|Architects|Architecture|Planning|Planners"
FIRM_LINE = r"\b([A-Z][A-Za-z'&\-,\.\s]{3,80}?\s+(?:" + FIRM_SUFFIX + r"))(?:\s|$|,|\n)"
ABN_LINE = r"(?i)\bABN[:\s.]*\d{2}\s*\d{3}\s*\d{3}\s*\d{3}\b"
CONTACT_LINE = r"(?i)^(?:P\s*[:.]|E\s*[:.]|W\s*[:.]|M\s*[:.]|Phone|Email|Web|Mobile|Tel|Fax|Direct|Address)\b"
ROLE_CONTACT_LINE = r"(?i)^(?:P\s*[:.]|E\s*[:.]|W\s*[:.]|M\s*[:.]|Phone|Email|Web|Mobile|Tel|Fax|Direct)\b"
NO_FIRM_LINE = r"(?i)^\d|^(?:Your|Our|Ref)\s+|\bP\.?O\.?\s*Box\b"
TEMPLATE_WORDS = r"(?i)\b(?:Chief|Executive|Officer|Branch|Department)\b"
OWNS_COPYRIGHT = r"(?im)^\s*([A-Z][\w\s&\-\.,'/]+?)\s+owns\s+copyright\b"
PROPERTY_OF = r"(?i)©\s*(?:THIS\s+)?(?:DRAWING|DESIGN|PLAN)S?[\s\S]{0,80}?\bPROPERTY\s+OF\s+([A-Z][\w\s&\-\.,'/]+?)\.\s*(?=\n|$|REPRODUCTION\b|ANY\s+UN)"
GENERIC_NAMES = ["the author", "the owner", "the proprietor", "the designer", "the copyright holder", "the company", "the builder"]
PLAN_ACN = r"(?i)\bA\.?\s*C\.?\s*N\.?\s*[:.]?\s*(\d{3}\s*\d{3}\s*\d{3})\b"
PLAN_ABN = r"(?i)\bA\.?\s*B\.?\s*N\.?\s*[:.]?\s*(\d{2}\s*\d{3}\s*\d{3}\s*\d{3})\b"
PLAN_LICENCE = r"(?i)\b(?:Q\.?B\.?S\.?A\.?|Q\.?B\.?C\.?C\.?|BSA|BCC|BUILDERS?)\s*\.?\s*(?:LICEN[CS]E|LIC\.?(?:\s*NO\.?)?)[^\n]{0,40}?(?:N[°o]?|No\.?|#)?\.?\s*[:.]?\s*(\d[\d ]*[A-Z]?)"
DESIGN_NAME = r"(?i)\b(architects?|architecture|design(?:ers?)?)\b"
KEEP_UPPER = ["PTY", "LTD", "INC", "ABN", "ACN", "ACT", "NSW", "VIC", "QLD", "SA", "WA", "TAS", "NT", "AU", "USA", "UK", "GST", "AUS", "BSA", "QBSA", "QBCC", "BCC", "I", "II", "III", "IV"]
LICENCE_WINDOW = 350

EMISSION = "array<struct<name:string,role:string,source_field:string,confidence:string,entity_type:string>>"


def none_of(kind: str) -> Column:
    return F.array().cast(kind)


def stripped(text: Column) -> Column:
    """Without blanks and line ends at both ends."""
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def nullable(text: Column, least: int = 1) -> Column:
    """Null unless the text has at least so many characters."""
    return F.when(F.length(text) >= least, text)


def until(items: Column, stop) -> Column:
    """The items before the first one that `stop` is true of."""
    at = F.array_position(F.transform(items, lambda x: F.coalesce(stop(x), F.lit(False))), True).cast("int")
    return let(at, lambda n: F.slice(items, 1, F.when(n > 0, n - 1).otherwise(F.size(items))))


def since(items: Column, start) -> Column:
    """The items from the first one that `start` is true of."""
    at = F.array_position(F.transform(items, lambda x: F.coalesce(start(x), F.lit(False))), True).cast("int")
    return let(at, lambda n: F.slice(items, F.greatest(n, F.lit(1)), F.when(n > 0, F.size(items)).otherwise(0)))


def lines_of(text: Column) -> Column:
    return F.transform(F.split(text, r"\r?\n"), stripped)


def agent_line(line: Column) -> Column:
    return nullable(without_contact(F.regexp_extract(line, CARE_OF, 1)), 4)


def recipient_block(text: Column) -> Column:
    """struct(name, agent, address_lines, suburb, postcode) of the address block behind 'Our reference:'.

    The block ends at a blank line, at 'Dear ...' or where the body begins, and its last line must be
    suburb, state and postcode; else the struct is null.
    """
    rest = F.get(F.split(text, OUR_REFERENCE, 2), F.lit(1))

    def read(block: Column) -> Column:
        return let(F.slice(block, 1, F.greatest(F.size(block) - 1, F.lit(0))), lambda body: F.when(F.try_element_at(block, F.lit(-1)).rlike(POSTAL), fields(body, F.element_at(block, -1))))

    def fields(body: Column, last: Column) -> Column:
        second = F.get(body, F.lit(1))
        cared = F.coalesce(second.rlike(CARE_OF), F.lit(False))
        return F.struct(
            nullable(without_contact(F.get(body, F.lit(0))), 4).alias("name"), F.when(cared, agent_line(second)).alias("agent"),
            F.slice(body, F.when(cared, 3).otherwise(2), F.greatest(F.size(body), F.lit(1))).alias("address_lines"), F.initcap(F.lower(F.regexp_extract(last, POSTAL, 1))).alias("suburb"), F.regexp_extract(last, POSTAL, 2).alias("postcode"),
        )

    lines = F.coalesce(lines_of(rest), none_of("array<string>"))
    return let(lines, lambda every: let(since(every, lambda x: x != ""), lambda tail: let(until(tail, lambda x: (x == "") | x.rlike(DEAR) | x.rlike(BODY_STARTS)), read)))


def applicant_fields(text: Column) -> Column:
    """struct(name, agent, contact_lines) of the 'Applicant name:' block of notices; null if there is none."""

    def read(details: Column) -> Column:
        cared = F.coalesce(F.get(details, F.lit(0)).rlike(CARE_OF), F.lit(False))
        return F.struct(nullable(without_contact(F.regexp_extract(text, APPLICANT_BLOCK, 1)), 4).alias("name"), F.when(cared, agent_line(F.get(details, F.lit(0)))).alias("agent"), F.when(cared, F.slice(details, 2, F.greatest(F.size(details), F.lit(1)))).otherwise(details).alias("contact_lines"))

    return F.when(text.rlike(APPLICANT_BLOCK), let(parts(F.regexp_extract(text, APPLICANT_BLOCK, 2), "\n"), read))


def refer_by_name(text: Column) -> Column:
    return let(first_match(text, REFER_BY_NAME), lambda name: F.when(~F.lower(name).startswith("applicant contact"), nullable(without_contact(name), 4)))


def emission(name: Column, role: str, field: str, confidence: str, kind: Column) -> Column:
    return F.struct(name.alias("name"), F.lit(role).alias("role"), F.lit(field).alias("source_field"), F.lit(confidence).alias("confidence"), kind.alias("entity_type"))


def parties_of(name: Column, agent: Column, field: str, confidence: str) -> Column:
    """Emissions of a joint name and its agent; an agent on the name's own line goes before the given one."""

    def read(own: Column) -> Column:
        people = F.transform(F.coalesce(split_parties(own["party"]), none_of("array<string>")), lambda p: emission(p, "applicant", field, confidence, entity_type(p)))
        firm = F.coalesce(own["agent"], agent)
        acting = F.when(firm.isNotNull() & own["party"].isNotNull(), F.array(emission(firm, "agent", field, confidence, F.lit("company")))).cast(EMISSION)
        return F.concat(people.cast(EMISSION), F.coalesce(acting, none_of(EMISSION)))

    return let(name, lambda n: let(care_of(n), read))


def council_emissions(text: Column) -> Column:
    """Everyone a council's letter names: the recipient, the applicant block, the one it refers to."""
    of = lambda block, field: let(block, lambda b: parties_of(b["name"], b["agent"], field, "high"))
    every = F.concat(of(recipient_block(text), "recipient_block"), of(applicant_fields(text), "applicant_name_field"), parties_of(refer_by_name(text), F.lit(None).cast("string"), "refer_by_name", "medium"))
    return F.when(is_letter(text), every).otherwise(none_of(EMISSION))


def is_applicant_letter(text: Column) -> Column:
    """A closing, a firm line or ABN at the top, and none of the marks of a council's own letter."""
    head = F.left(text, F.lit(1500))
    council = F.left(text, F.lit(1000)).rlike(COUNCIL_HEAD) | F.right(text, F.lit(1500)).rlike(COUNCIL_FOOT)
    return F.coalesce(text.rlike(SIGN_OFF) & ~council & (head.rlike(FIRM_LINE) | head.rlike(ABN_LINE)), F.lit(False))


def person_name(line: Column) -> Column:
    """The line as a person's name without qualifications; null if it cannot be one."""
    s = F.regexp_replace(line, r"\s*\(.*$", "")
    s = stripped(F.regexp_replace(F.regexp_replace(s, r",\s+[A-Z][A-Z\s]+.*$", ""), r",+\s*$", ""))
    odd = (line == "") | (F.length(line) > 80) | line.rlike(CONTACT_LINE) | line.rlike(r"\d") | line.rlike(r"(?i)\b(?:" + FIRM_SUFFIX + r")\b")
    fits = lambda words: F.size(words).between(2, 5) & F.forall(words, lambda w: w.rlike(r"^\p{Lu}"))
    return F.when(~odd, let(s, lambda name: F.when(let(F.split(F.regexp_replace(name, r"^(?:Dr|Mr|Mrs|Ms)\.?\s+", ""), r"\s+"), fits), name)))


def firm_line(line: Column) -> Column:
    """The line if it is a firm's name."""
    return let(stripped(F.regexp_replace(line, r",+\s*$", "")), lambda s: F.when((F.length(s) <= 100) & s.rlike("^" + FIRM_LINE[2:]), s))


def first_of(items: Column, f) -> Column:
    """The first non-null f(item)."""
    return F.get(F.filter(F.transform(items, f), lambda x: x.isNotNull()), F.lit(0))


def sign_off(text: Column) -> Column:
    """struct(name, role, company) behind the last closing in the last 4000 characters."""
    after = F.element_at(F.split(F.right(text, F.lit(4000)), SIGN_OFF), -1)
    after = F.regexp_replace(F.regexp_replace(after, r"^,+", ""), r"^\s+", "")
    used = F.filter(F.slice(F.transform(F.split(after, "\n"), stripped), 1, 12), lambda x: ~x.rlike(r"(?i)^[\s\W]*$|^Digitally\s+signed"))

    def read(lines: Column) -> Column:
        """Lines of the closing, then the place of the person among the first six (0: none)."""
        people = F.transform(F.slice(lines, 1, 6), lambda x: person_name(x).isNotNull())
        return let(F.array_position(people, True).cast("int"), lambda at: let(F.regexp_replace(F.get(lines, at), r",+$", ""), lambda role: fields(lines, at, role)))

    def fields(lines: Column, at: Column, role: Column) -> Column:
        company = F.coalesce(first_of(F.slice(lines, 1, F.when(at > 0, at).otherwise(6)), firm_line), F.when(at > 0, first_of(F.slice(lines, at + 1, 4), firm_line)))
        given = (at > 0) & (F.length(role) <= 80) & (role != "") & ~role.rlike(ROLE_CONTACT_LINE)
        return F.struct(F.when(at > 0, person_name(F.get(lines, at - 1))).alias("name"), F.when(given, role).alias("role"), company.alias("company"))

    return let(used, read)


def letterhead(text: Column) -> Column:
    """The firm above the ABN in the first 1500 characters, else the first firm line; null if it is a template's text."""

    def read(head: Column) -> Column:
        above = F.slice(F.reverse(parts(F.get(F.split(head, ABN_LINE, 2), F.lit(0)), "\n")), 1, 3)
        near = F.regexp_replace(F.get(F.filter(above, lambda x: ~x.rlike(NO_FIRM_LINE)), F.lit(0)), r",+\s*$", "")
        return F.coalesce(F.when(head.rlike(ABN_LINE), near), stripped(first_match(head, FIRM_LINE)))

    return let(let(F.left(text, F.lit(1500)), read), lambda name: F.when(~name.rlike(TEMPLATE_WORDS) & ~name.contains("\n"), name))


def applicant_emissions(text: Column) -> Column:
    """The firm in the letterhead, the firm and the person of the closing: all act as agents."""

    def every(head: Column, s: Column) -> Column:
        own = F.array(emission(head, "agent", "letterhead", "high", F.lit("company")), emission(F.when(~s["company"].eqNullSafe(head), s["company"]), "agent", "signoff_company", "high", F.lit("company")), emission(s["name"], "agent", "signoff_name", "high", F.lit("individual")))
        return F.filter(own, lambda e: e["name"].isNotNull()).cast(EMISSION)

    return F.when(is_applicant_letter(text), let(letterhead(text), lambda head: let(sign_off(text), lambda s: every(head, s)))).otherwise(none_of(EMISSION))


def clean_name(raw: Column) -> Column:
    """Title case, but initials and known short forms stay in capitals."""
    words = F.split(F.regexp_replace(squeezed(raw), r"^[ ,.;:\-]+|[ ,.;:\-]+$", ""), " ")
    title = lambda w: F.array_join(F.transform(F.regexp_extract_all(w, F.lit(r"\p{L}+|[^\p{L}]+"), F.lit(0)), lambda p: F.initcap(F.lower(p))), "")
    return F.array_join(F.transform(words, lambda w: F.when(w.rlike(r"^(?:[A-Z]\.){2,}[A-Z]?\.?$") | F.upper(w).isin(KEEP_UPPER), F.upper(w)).otherwise(title(w))), " ")


def nearest_licence(licences: Column, at: Column, to: Column) -> Column:
    """The licence number closest to a place, at most LICENCE_WINDOW characters away."""
    far = lambda m: F.when(m["at"].between(at, to), 0).when(m["at"] < at, at - m["to"]).otherwise(m["at"] - to)
    near = F.filter(licences, lambda m: (m["at"] >= at - LICENCE_WINDOW) & (m["to"] <= to + LICENCE_WINDOW))
    return F.array_min(F.transform(near, lambda m, i: F.struct(far(m).alias("far"), i.alias("i"), F.replace(m["value"], F.lit(" "), F.lit("")).alias("licence"))))["licence"]


def firm_role(name: Column, licence: Column) -> Column:
    return F.when(name.rlike(DESIGN_NAME), "architect").when(licence.isNotNull(), "builder").otherwise("unknown")


def each_once(hits: Column) -> Column:
    """The first of hits with one name, in any letter case."""
    return let(F.transform(hits, lambda h: F.lower(h["name"])), lambda names: F.filter(hits, lambda h, i: F.array_position(names, F.lower(h["name"])) == i + 1))


def page_numbers(text: Column) -> Column:
    """struct(acn, abn) of a page."""
    return F.struct(digits_of(first_match(text, PLAN_ACN), 9).alias("acn"), digits_of(first_match(text, PLAN_ABN), 11).alias("abn"))


def block(name: Column, role: Column, acn: Column, abn: Column, licence: Column, confidence: Column, at: Column, to: Column) -> Column:
    return F.struct(name.alias("name"), role.alias("role"), acn.alias("acn"), abn.alias("abn"), licence.alias("licence"), confidence.alias("confidence"), at.alias("span_start"), to.alias("span_end"))


def title_block(text: Column) -> Column:
    """Firms a plan page names by its copyright anchors: name, role, acn, abn, licence, confidence, span_start, span_end.

    Each name once, copyright holders first. The page's ACN goes to the first firm with a licence, its
    ABN to the first such firm without the ACN.
    """

    def read(licences: Column) -> Column:
        hits = F.transform(F.concat(matches(text, OWNS_COPYRIGHT), matches(text, PROPERTY_OF)), lambda m: F.struct(clean_name(m["value"]).alias("name"), nearest_licence(licences, m["at"], m["to"]).alias("licence"), m["value_at"].alias("at"), (m["value_at"] + F.length(m["value"])).alias("to")))
        named = let(hits, lambda hs: F.filter(hs, lambda h: (h["name"] != "") & ~F.lower(h["name"]).isin(GENERIC_NAMES)))
        return let(let(named, each_once), lambda once: let(page_numbers(text), lambda own: F.transform(once, lambda h, i: numbered(once, own, h, i))))

    def numbered(once: Column, own: Column, h: Column, i: Column) -> Column:
        nth = F.when(h["licence"].isNotNull(), F.size(F.filter(F.slice(once, 1, i + 1), lambda x: x["licence"].isNotNull())))
        acn, abn = F.when(nth == 1, own["acn"]), F.when(nth == F.when(own["acn"].isNotNull(), 2).otherwise(1), own["abn"])
        confidence = F.when(acn.isNotNull() & h["licence"].isNotNull(), "high").when(acn.isNotNull() | h["licence"].isNotNull(), "medium").otherwise("low")
        return block(h["name"], firm_role(h["name"], h["licence"]), acn, abn, h["licence"], confidence, h["at"], h["to"])

    return let(matches(text, PLAN_LICENCE), read)


def brand_blocks(text: Column) -> Column:
    """Lines that spell the brand of a link on the same page, whole or its beginning: the same fields."""
    hosts = F.transform(F.regexp_extract_all(text, F.lit(PATTERNS["url"][0]), F.lit(1)), lambda h: F.regexp_replace(F.lower(h), r"^www\.", ""))
    stems = F.array_distinct(F.filter(F.transform(F.filter(hosts, lambda h: ~h.isin(IGNORED_HOSTS)), lambda h: F.substring_index(h, ".", 1)), lambda s: F.length(s) >= 5))
    fits = lambda s, n: (s == n) | (s.startswith(n) & (F.length(s) >= F.length(n) + 3))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<name:string,plain:string,at:int>>").alias("spans"))

    def step(s: Column, line: Column) -> Column:
        """Lines with where their text begins."""
        name = stripped(line)
        span = F.struct(name.alias("name"), F.regexp_replace(F.lower(name), "[^a-z0-9]", "").alias("plain"), (s["at"] + F.length(line) - F.length(F.regexp_replace(line, r"^\s+", ""))).cast("int").alias("at"))
        return F.struct((s["at"] + F.length(line) + 1).cast("int").alias("at"), F.concat(s["spans"], F.array(span)).alias("spans"))

    def read(own: Column) -> Column:
        spans = F.filter(F.aggregate(F.split(text, "\n"), start, step)["spans"], lambda s: (F.length(s["name"]) >= 4) & (s["plain"] != "") & F.exists(own, lambda t: fits(t, s["plain"])))
        return let(matches(text, PLAN_LICENCE), lambda licences: let(page_numbers(text), lambda page: F.transform(let(spans, each_once), lambda s: firm(own, licences, page, s))))

    def firm(own: Column, licences: Column, page: Column, s: Column) -> Column:
        stem = F.array_min(F.filter(own, lambda t: fits(t, s["plain"])))
        shown = F.when(F.array_contains(own, s["plain"]), s["name"]).otherwise(F.concat_ws(" ", s["name"], F.substr(stem, F.length(s["plain"]) + 1, F.length(stem))))
        return let(nearest_licence(licences, s["at"], s["at"] + F.length(s["name"])), lambda licence: block(s["name"], firm_role(shown, licence), page["acn"], page["abn"], licence, F.lit("medium"), s["at"], s["at"] + F.length(s["name"])))

    return let(stems, lambda own: F.when(F.size(own) > 0, read(own)).otherwise(F.array().cast("array<struct<name:string,role:string,acn:string,abn:string,licence:string,confidence:string,span_start:int,span_end:int>>")))


# Labels of plan title blocks that name a role, labels that name none, and values that are no names.
ROLE_LABEL = r"(?i)^.{0,3}?(client|builder|architect|designer|designed?\s+by|drawn?\s+by|drafted?\s+by|engineer|developer|owner|principal)\s*:\s*$"
LABEL_ROLES = {"client": "client", "builder": "builder", "architect": "architect", "designer": "architect", "designed by": "architect", "engineer": "engineer", "developer": "developer", "owner": "owner"}
OTHER_LABEL = r"(?i)^.{0,3}?(?:date|title|scale|paper|north|status|revision|rev|issue|sheet(?:\s*no)?|drawing(?:\s*no)?|project(?:\s*no)?|job(?:\s*no)?|order(?:\s*no)?|file|amend(?:ment)?s?|chk|check(?:ed)?(?:\s*by)?|approved(?:\s*by)?|address|north\s*point)\s*:?\s*$"
NO_NAME = r"(?i)^\s*(\d[\d\s.,]*[a-z]?|\d{1,4}[/\-.]\d{1,4}([/\-.]\d{2,4})?|[A-Z]{1,3}|sheet\s+\d+|page\s+\d+|\d+\s*:\s*\d+|a\d+(?:[-_]\d+)?|on\s+a\d+|job\s*(?:no|number)|order\s*(?:no|number)|rev(?:ision)?|status|paper|north|date|title|scale)\s*$"
STREET_VALUE = r"(?i)^\s*(?:\d+\s+\S.*\b|\S+(?:\s+\S+)*\s+)(st|street|rd|road|av|ave|avenue|cct|circuit|cl|close|cr|cres|crescent|dr|drive|hwy|highway|la|lane|pde|parade|pl|place|tce|terrace|wy|way|ct|court|sq|square|esp|esplanade|bvd|boulevard|grn|green)\b\s*$"
LABEL_RESIDUE = r"(?i)^\s*\w+\s+(?:no\.?|number|reference|ref\.?|code|id)\.?\s*$"


def label_role(text: Column) -> Column:
    """The role a title-block label asks for; null for other text and for labels that name nobody."""
    label = F.lower(squeezed(F.regexp_extract(text, ROLE_LABEL, 1)))
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in LABEL_ROLES.items() for x in kv]), label)


def is_entity_value(text: Column) -> Column:
    """Whether a title-block value can be a party's name."""
    letters = F.length(F.regexp_replace(text, r"[^\p{L}]", ""))
    words = F.size(F.regexp_extract_all(text, F.lit(r"\b[A-Za-z]+\b"), F.lit(0)))
    odd = text.rlike(ROLE_LABEL) | text.rlike(OTHER_LABEL) | text.rlike(NO_NAME) | text.rlike(STREET_VALUE) | text.contains(":") | text.rlike(LABEL_RESIDUE)
    return ~odd & (F.length(text) >= 5) & (letters >= F.length(text) * 0.5) & ((words >= 2) | text.rlike(FIRM))


def client_role(name: Column) -> Column:
    """A client that is a firm is the builder, else the owner."""
    return F.when(name.rlike(FIRM), "builder").otherwise("owner")


# The roles of training labels, and other roles that are folded into them (the rest is dropped).
ROLES = ["applicant", "agent", "owner", "builder", "architect", "engineer", "surveyor", "landscape"]
FOLDED = {"consultant": "agent", "developer": "applicant"}


def training_role(status: Column, truth: Column, candidate: Column) -> Column:
    """The verified role where there is one, else the candidate's, folded; null if it is not trained on."""
    raw = F.lower(F.trim(F.when(status.isin("verified", "corrected"), truth).otherwise(candidate)))
    return F.when(raw.isin(ROLES), raw).otherwise(F.try_element_at(F.create_map(*[F.lit(x) for kv in FOLDED.items() for x in kv]), raw))


def bad_name(name: Column) -> Column:
    """Names that training leaves out: short, on several lines, or with a contact person."""
    n, low = stripped(F.coalesce(name, F.lit(""))), F.lower(F.coalesce(name, F.lit("")))
    return (F.length(n) < 4) | n.contains("\n") | low.contains("(attention:") | low.contains("(attn:") | low.contains(" att: ") | low.contains(" attn: ")


# Treatments that are not read, and prompt templates by words of the document type.
SKIPPED_TREATMENTS = ["image_only", "unsupported"]


def by_type(doc_type: Column, other: Column | str) -> Column:
    t = F.lower(F.coalesce(doc_type, F.lit("")))
    return F.when(t.contains("decision notice") | t.contains("delegated report"), "decision_notice").when(t.contains("specialist"), "specialist").when(t.contains("stamped approved plan") | (t == "plans"), "plans").when(t.contains("supporting") | t.contains("cover letter"), "supporting").otherwise(other)


def template_key(treatment: Column, doc_type: Column) -> Column:
    """The template a document is read with: by its form, else by its type, else by its length; null if it is not read."""
    narrative = by_type(doc_type, F.when(treatment == "narrative_long", "specialist").otherwise("generic"))
    return F.when(treatment.isin(SKIPPED_TREATMENTS), None).when(treatment == "acroform_filled", "da_form_1").when(treatment == "titleblock", "plans").otherwise(narrative)


def type_template_key(doc_type: Column) -> Column:
    """The same by type alone."""
    t = F.lower(F.coalesce(doc_type, F.lit("")))
    return F.when(t.contains("da form 1") | (t == "forms"), "da_form_1").otherwise(by_type(doc_type, "generic"))


def build_template_key(doc_type: Column) -> Column:
    t = F.lower(F.coalesce(doc_type, F.lit("")))
    return F.when(t.contains("drawing") | t.contains("plan"), "build_features_drawings").otherwise("build_features_design_report")

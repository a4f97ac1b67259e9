"""Names of parties: splitting of joint names, agents, kinds of letters, entity types, codenames."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lotline.functions.hashing import fnv32
from lotline.functions.text import first_match, let, squeezed

# Words that mark a firm, those that always mark a legal entity of its own, and letter kinds in order of precedence.
FIRM = r"(?i)\b(pty\s*ltd|pty\s*limited|limited|ltd|inc|corp|p\s*/\s*l|p/l|trust|group|holdings|developments?|constructions?|builders?|homes?|planning|consult(?:ing|ants?)|architects?|&\s*co|&\s*sons|&\s*partners)\b"
ENTITY = r"(?i)\b(pty\s*ltd|pty\s*limited|limited|ltd|inc|corp|p\s*/\s*l|p/l|trust|holdings|partnership)\b"
LETTERS = {
    "decision_notice_cover_letter": r"(?ms)^\s*Decision Notice\s*$.*Please find enclosed the decision notice",
    "decision_notice": r"Decision notice\s*[—-]\s*(?:approval|Express Development Application)",
    "confirmation_notice": r"Confirmation Notice\s*[–-]\s*Assessment Manager",
    "information_request": r"(?m)^\s*Information Request\s*$",
    "response_to_ir_cover_letter": r"Response to (?:Information Request|IR)",
}
LETTERHEAD = r"(?i)\bCouncil of the City of Gold Coast\b|\b07\s*5582\s*8866\b|\bmail@goldcoast\.qld\.gov\.au\b|\bCity Development Branch\b|\bPlanning\s*&\s*Environment Directorate\b"
CARE_OF = r"(?is)^(.*?)\s+(?:c\s*/\s*[\-o]|care\s+of)\s+(.*)$"
RECIPIENT = r"(?s)Our reference:[^\n]*\n\s*(\S.*?)(?:\n\s*\n|\n\s*Dear\s|$)"
AGENT_LINE = r"(?i)^c\s*/\s*[-o]?\s*"
ADJECTIVES = "bright calm gentle lush golden mighty noble swift vivid witty zesty cosmic earthy lively mellow happy lucky royal silver steel fancy jolly dapper eager glowing pure fiery jade mystic nimble olive quick frosty indigo hardy keen sunny sandy breezy coral dewy peachy rosy pink mossy plucky amber scarlet".split()
NOUNS = "kookaburra koala kangaroo wombat wallaby possum echidna platypus dingo quokka numbat goanna gecko magpie emu lyrebird bilby brumby pademelon cassowary galah cockatoo lorikeet currawong kingfisher ibis rosella bandicoot wagtail fairywren dunnart antechinus yabby potoroo waratah banksia bottlebrush wattle grevillea paperbark boronia hakea callistemon frangipani jacaranda eucalypt telopea kurrajong vegemite lamington pavlova billabong esky didgeridoo boomerang bunyip milo anzac tinnie snag".split()


def is_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(LETTERHEAD), F.lit(False))


def letter_kind(text: Column) -> Column:
    return F.coalesce(*[F.when(text.rlike(p), kind) for kind, p in LETTERS.items()])


def care_of(raw: Column) -> Column:
    """struct(party, agent) of 'Party C/- Agent' on one line; agent is null if there is none."""
    p = CARE_OF
    return F.struct(F.when(raw.rlike(p), F.trim(F.regexp_extract(raw, p, 1))).otherwise(raw).alias("party"), F.nullif(F.trim(F.regexp_extract(raw, p, 2)), F.lit("")).alias("agent"))


def without_contact(name: Column) -> Column:
    """The firm's name without '(Attention: person)' and what follows."""
    return F.regexp_replace(F.trim(F.regexp_replace(name, r"(?is)\s*[(]?\s*att(?:ention|n)?\s*:.*$", "")), r"[\s,;:.\-]+$", "")


def words(name: Column) -> Column:
    return F.size(F.split(squeezed(name), " "))


def parts(text: Column, pattern: str) -> Column:
    return F.filter(F.transform(F.split(text, pattern), lambda p: F.trim(p)), lambda p: p != "")


def split_parties(raw: Column) -> Column:
    """Array of the parties of a joint name; null in, null out.

    'Daniel and Amber Knapp' gives both their surname (that of the longest personal name). A list with
    commas is split only if every part is a personal name of two words or more. A firm's own 'and' is
    kept, unless a part is a legal entity by itself; then every part stands alone.
    """
    def split(s: Column) -> Column:
        return let(parts(s, ","), lambda listed: let(parts(s, r"(?i)\s+(?:and|&)\s+"), lambda joint: choose(s, listed, joint)))

    def choose(s: Column, listed: Column, joint: Column) -> Column:
        people_list = (F.size(listed) >= 2) & F.forall(listed, lambda p: (words(p) >= 2) & ~p.rlike(FIRM))
        whole = (F.size(joint) < 2) | (~F.exists(joint, lambda p: p.rlike(ENTITY)) & s.rlike(FIRM))
        return F.when(s == "", F.array().cast("array<string>")).when(people_list, listed).when(whole, F.array(s)).otherwise(let(surname(joint), lambda n: named(joint, n)))

    def surname(joint: Column) -> Column:
        ranked = F.array_sort(F.transform(F.filter(joint, lambda p: ~p.rlike(ENTITY)), lambda p, i: F.struct((-words(p)).alias("n"), i.alias("i"), p.alias("p"))))
        return let(F.get(ranked, F.lit(0)), lambda x: F.when(x["n"] <= -2, F.element_at(F.split(squeezed(x["p"]), " "), -1)))

    def named(joint: Column, name: Column) -> Column:
        return F.transform(joint, lambda p: F.when(p.rlike(ENTITY) | (words(p) >= 2) | name.isNull(), p).otherwise(F.concat_ws(" ", p, name)))

    return let(F.regexp_replace(F.trim(raw), r"[\s,;:.\-]+$", ""), split)


def entity_type(name: Column) -> Column:
    """company, unknown for short names all in capitals, else individual."""
    return F.when(name.rlike(FIRM), "company").when((name == F.upper(name)) & name.rlike(r"\p{L}") & (words(name) <= 3), "unknown").otherwise("individual")


def recipient(text: Column) -> Column:
    """struct(name, agent) of the address block that follows 'Our reference:'; nulls if there is none."""
    block = first_match(text, RECIPIENT)
    lines = parts(block, "\n")
    agent = F.get(F.filter(lines, lambda x: x.rlike(AGENT_LINE + r"\S")), F.lit(0))
    own = care_of(F.get(lines, F.lit(0)))
    return F.struct(without_contact(own["party"]).alias("name"), F.coalesce(F.regexp_replace(agent, AGENT_LINE, ""), own["agent"]).alias("agent"))


def codename(seed: Column) -> Column:
    """'adjective-adjective-noun' from hashes of an ASCII seed; 'unknown' without one."""
    n = len(ADJECTIVES)
    h, h2 = fnv32(seed), fnv32(F.concat(seed, F.lit(":noun")))
    pick = lambda xs, i: F.get(F.array(*map(F.lit, xs)), i.cast("int"))
    a, b = h % n, F.shiftrightunsigned(h, 8) % n
    b = F.when(a == b, (b + 1) % n).otherwise(b)
    return F.when(F.coalesce(seed, F.lit("")) == "", "unknown").otherwise(F.concat_ws("-", pick(ADJECTIVES, a), pick(ADJECTIVES, b), pick(NOUNS, h2 % len(NOUNS))))


# Fixed value: how many colours a suburb can be shown in.
COLOURS = 16


def colour_index(suburb: Column) -> Column:
    """The colour a suburb is shown in, from 0, by a hash of its name; null without one."""
    name = F.nullif(F.trim(F.lower(suburb)), F.lit(""))
    return F.when(name.isNotNull(), fnv32(name) % COLOURS)


def applicant_seed(acn: Column, name: Column) -> Column:
    return F.coalesce(F.nullif(acn, F.lit("")), F.nullif(squeezed(F.lower(name)), F.lit("")))

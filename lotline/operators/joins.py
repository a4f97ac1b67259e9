"""Joins of the redevelopment data: address prefixes, units of a lot, as-of events, fallbacks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lotline.functions.text import canonical_long_form


def leading_words(text: Column, n: int) -> Column:
    return F.substring_index(text, " ", n)


def prefix_join(left: DataFrame, right: DataFrame, prefix: str, text: str) -> DataFrame:
    """Rows where right.text begins with left.prefix, in any letter case; null and empty prefixes match nothing.

    All words of a prefix but its last stand whole at the head of the text, so the join is an equi-join
    on the first two of them (a house number and the beginning of the street's name), or on the first
    where there is only one, with the prefix test on top. Each text is sent once per key length. Prefixes
    of one word, which are rare, meet on their first one to three characters those texts that begin with
    a letter such a prefix begins with; these letters are broadcast: there are no more of them than
    characters.
    """
    p, t = F.lower(F.col(prefix)), F.lower(F.col(text))
    lhs = left.where(F.col(prefix) != "").withColumn("_p", p).withColumn("_n", F.least(F.size(F.split("_p", " ")) - 1, F.lit(2)))
    rhs = right.where(F.col(text).isNotNull()).withColumn("_t", t)
    by_words = lhs.where("_n > 0").withColumn("_key", F.when(F.col("_n") == 1, leading_words(F.col("_p"), 1)).otherwise(leading_words(F.col("_p"), 2)))
    words = rhs.withColumn("_key", F.explode(F.array_distinct(F.array(leading_words(F.col("_t"), 1), leading_words(F.col("_t"), 2)))))
    worded = by_words.join(words, "_key").where(F.col("_t").startswith(F.col("_p")))
    letters = lhs.where("_n = 0").select(F.left("_p", F.lit(1)).alias("_letter")).distinct()
    few = rhs.join(F.broadcast(letters), F.left("_t", F.lit(1)) == F.col("_letter"), "left_semi").withColumn("_key", F.explode(F.array_distinct(F.transform(F.sequence(F.lit(1), F.lit(3)), lambda n: F.left("_t", n)))))
    short = lhs.where("_n = 0").withColumn("_key", F.left("_p", F.lit(3))).join(few, "_key").where(F.col("_t").startswith(F.col("_p")))
    return worded.unionByName(short).drop("_p", "_n", "_t", "_key")


def lot_matches(streets: DataFrame, properties: DataFrame) -> DataFrame:
    """(street_address, property columns) of every property whose display address begins with a street."""
    return prefix_join(streets.select("street_address").distinct(), properties, "street_address", "display_address")


def suburb_matches(targets: DataFrame, properties: DataFrame, street: str = "street", suburb: str = "suburb") -> DataFrame:
    """targets (their columns) with the properties whose display address begins with 'street, suburb'.

    The street's type is written out first, as the portals do: councils shorten it in many ways.
    """
    kind = F.element_at(F.split(street, " "), -1)
    whole = F.concat(F.left(street, F.length(street) - F.length(kind)), canonical_long_form(kind))
    return prefix_join(targets.withColumn("_prefix", F.concat(whole, F.lit(", "), suburb)), properties, "_prefix", "display_address").drop("_prefix")


def unit_children(matches: DataFrame, properties: DataFrame, within: tuple[str, ...] = ()) -> DataFrame:
    """(street_address, unit columns): units with the number, street and suburb (and columns of `within`) of a matched parent, each once."""
    keys = ["street_number", "street_name", "suburb", *within]
    parents = matches.where("unit_number = ''").select("street_address", *keys).distinct()
    return properties.where("unit_number <> ''").join(parents, keys)


def asof_prev(left: DataFrame, right: DataFrame, on: list[str], key: list[str], ltime: str, rtime: str, rid: str, take: list[str], months: int | None = None) -> DataFrame:
    """Per left row, the latest right row strictly before it (and not older than `months`), ties to the greater id.

    Both sides are laid out in one order of time per key, and each left row takes the last right row
    before it: no pairs are made, so a key with very many rows on both sides costs one sort. Left rows
    without an event, or with a null key or time, are left out.
    """
    given = lambda cols: F.forall(F.array(*[F.col(c).isNull() for c in cols]), lambda x: ~x)
    events = right.where(given([*on, rtime])).select(*on, F.col(rtime).alias("_t"), F.lit(1).alias("_side"), F.col(rid).alias("_rid"), F.struct(F.col(rtime).alias("_at"), *take).alias("_e"))
    rows = left.where(given([*on, ltime])).select(*on, F.col(ltime).alias("_t"), F.lit(0).alias("_side"), F.struct(*key).alias("_key"))
    order = Window.partitionBy(*on).orderBy("_t", "_side", "_rid").rowsBetween(Window.unboundedPreceding, 0)
    met = rows.unionByName(events, allowMissingColumns=True).withColumn("_prev", F.last("_e", ignorenulls=True).over(order)).where("_side = 0 and _prev is not null")
    if months is not None:
        met = met.where(F.col("_prev._at") >= F.add_months("_t", -months))
    return met.select("_key.*", *[F.col(f"_prev.{c}").alias(c) for c in take])


def events_after(left: DataFrame, right: DataFrame, on: list[str], ltime: str, rtime: str) -> DataFrame:
    """Pairs of left rows and right events strictly after them. Where only totals are asked for, see totals_after."""
    return left.join(right, on).where(F.col(rtime) > F.col(ltime))


def totals_after(left: DataFrame, right: DataFrame, on: list[str], key: list[str], ltime: str, rtime: str, totals: dict[str, Column]) -> DataFrame:
    """key of every left row with an event strictly after it, and over those events the sum of each of totals.

    Both sides are laid out from the newest row to the oldest per key, left rows before events of the same
    time, and sums run along: no pairs are made, so many rows on both sides of one key cost one sort.
    """
    given = lambda cols: F.forall(F.array(*[F.col(c).isNull() for c in cols]), lambda x: ~x)
    events = right.where(given([*on, rtime])).select(*on, F.col(rtime).alias("_t"), F.lit(1).alias("_side"), *[c.alias(f"_{n}") for n, c in totals.items()])
    rows = left.where(given([*on, ltime])).select(*on, F.col(ltime).alias("_t"), F.lit(0).alias("_side"), F.struct(*key).alias("_key"))
    order = Window.partitionBy(*on).orderBy(F.desc("_t"), "_side").rowsBetween(Window.unboundedPreceding, 0)
    met = rows.unionByName(events, allowMissingColumns=True).withColumns({"_later": F.sum("_side").over(order), **{n: F.sum(f"_{n}").over(order) for n in totals}})
    return met.where("_side = 0 and _later > 0").select("_key.*", *totals)


def coalesce_sources(rows: DataFrame, key: list[str], value: Column, source: str, names: list[str]) -> DataFrame:
    """key, value, source: per key the value of the first source of `names` that has one; other sources count as none."""
    place = F.nullif(F.array_position(F.array(*map(F.lit, names)), F.col(source)), F.lit(0))
    have = rows.select(*key, value.alias("value"), place.alias("_place")).where("value is not null and _place is not null")
    first = have.groupBy(*key).agg(F.min_by("value", "_place").alias("value"), F.min("_place").alias("_place"))
    return first.select(*key, "value", F.element_at(F.array(*map(F.lit, names)), F.col("_place").cast("int")).alias("source"))


def has_any(df: DataFrame, other: DataFrame, on: list[str]) -> DataFrame:
    return df.join(other.select(*on), on, "left_semi")


def without(df: DataFrame, other: DataFrame, on: list[str]) -> DataFrame:
    return df.join(other.select(*on), on, "left_anti")


def unit_evidence(streets: DataFrame, urls: DataFrame) -> DataFrame:
    """(street_address, discovered_at) of classified links whose search address is '<number>/<street...'."""
    found = urls.where(F.col("url_kind").isNotNull() & F.col("search_address").rlike("^[0-9]+/")).withColumn("_rest", F.regexp_replace("search_address", "^[0-9]+/", ""))
    own = streets.select("street_address", F.substring_index("street_address", ",", 1).alias("_street")).distinct()
    return prefix_join(own, found, "_street", "_rest").select("street_address", "discovered_at")


def cells_of(span: tuple[str, str], level: Column) -> Column:
    """The cells of 2**level whole numbers that a span touches (its first place at least)."""
    start, end = (F.floor(F.col(c)).cast("long") for c in span)
    last = F.greatest(start, F.ceil(F.col(span[1])).cast("long") - 1)
    return F.sequence(F.call_function("shiftright", start, level), F.call_function("shiftright", last, level))


def overlap_join(a: DataFrame, b: DataFrame, on: list[str], a_span: tuple[str, str], b_span: tuple[str, str]) -> DataFrame:
    """Pairs whose half-open spans overlap, within equal keys.

    A span's level is the power of two that covers its length. Spans meet in cells of the longer one's level,
    of which either touches two at most, and a pair is reported in the cell in which its overlap begins: only
    spans near each other meet, not all of a key. Spans are sent to the levels that their key has on the other side.
    """
    level = lambda span: F.greatest(F.ceil(F.log2(F.greatest(F.ceil(F.col(span[1])) - F.floor(F.col(span[0])), F.lit(1)))), F.lit(0)).cast("int")
    shown = [*on, *(c for c in a.columns if c not in on), *(c for c in b.columns if c not in on)]
    # Columns of one name on both sides stay apart, as in a plain join.
    sides = []
    for name, df, span in (("a", a, a_span), ("b", b, b_span)):
        rest = [c for c in df.columns if c not in on]
        given = df.where(F.col(span[0]).isNotNull() & F.col(span[1]).isNotNull())
        sides.append(given.select(*on, F.col(span[0]).alias(f"_{name}0"), F.col(span[1]).alias(f"_{name}1"), level(span).alias(f"_{name}_level"), F.struct(*rest).alias(f"_{name}_row")))
    at = lambda name, lev: F.explode(cells_of((f"_{name}0", f"_{name}1"), F.col(lev))).alias("_cell")

    def met(low: str, high: str, strict: bool) -> DataFrame:
        """Pairs in which `high` has the greater level (or the same, unless strict)."""
        lo, hi = (sides[0], sides[1]) if low == "a" else (sides[1], sides[0])
        levels = hi.groupBy(*on).agg(F.collect_set(f"_{high}_level").alias("_levels"))  # one number per power of two
        above = F.filter("_levels", lambda x: x > F.col(f"_{low}_level") if strict else x >= F.col(f"_{low}_level"))
        sent = lo.join(levels, on).withColumn("_level", F.explode(above)).drop("_levels")
        sent = sent.select("*", at(low, "_level"))
        own = hi.withColumn("_level", F.col(f"_{high}_level")).select("*", at(high, "_level"))
        return sent.join(own, [*on, "_level", "_cell"]).select(*on, "_a0", "_a1", "_b0", "_b1", "_a_row", "_b_row", "_level", "_cell")

    pairs = met("a", "b", False).unionByName(met("b", "a", True))
    begin = F.call_function("shiftright", F.floor(F.greatest("_a0", "_b0")).cast("long"), F.col("_level"))
    hit = pairs.where((F.col("_a0") < F.col("_b1")) & (F.col("_b0") < F.col("_a1")) & (begin == F.col("_cell")))
    return hit.select(*on, "_a_row.*", "_b_row.*").toDF(*shown)


def remap_tagged(child: DataFrame, old_parents: DataFrame, new_parents: DataFrame, natural: list[str], fk: str, required: bool) -> DataFrame:
    """child with fk re-pointed, and `outcome`: what became of every row, in one pass.

    remapped: the new parent's id (of several the greatest). Else fk is null, and the row is kept unless the parent is
    required: no_key (fk was null), no_old_parent (fk points nowhere), no_natural_key (the old parent has a null
    in it), no_new_parent. A row that goes has the outcome with 'dropped:' before it.
    """
    new = new_parents.groupBy(*natural).agg(F.max("id").alias("_new"))
    whole = F.forall(F.array(*[F.col(c).isNull() for c in natural]), lambda x: ~x)
    old = old_parents.groupBy(F.col("id").alias(fk)).agg(F.max(F.struct(*natural)).alias("_n")).select(fk, "_n.*").withColumn("_whole", whole)
    ids = old.join(new, natural, "left").select(F.col(fk).alias("_fk"), "_new", "_whole")
    why = F.when(F.col(fk).isNull(), "no_key").when(F.col("_whole").isNull(), "no_old_parent").when(~F.col("_whole"), "no_natural_key").otherwise("no_new_parent")
    outcome = F.when(F.col("_new").isNotNull(), "remapped").otherwise(F.concat(F.lit("dropped:"), why) if required else why)
    out = child.join(ids, F.col(fk) == F.col("_fk"), "left").withColumn("outcome", outcome)
    return out.withColumn(fk, F.col("_new")).select(*child.columns, "outcome")


def remap_fk(child: DataFrame, old_parents: DataFrame, new_parents: DataFrame, natural: list[str], fk: str, required: bool) -> DataFrame:
    """The kept rows of remap_tagged."""
    return remap_tagged(child, old_parents, new_parents, natural, fk, required).where(~F.col("outcome").startswith("dropped:")).drop("outcome")


def lookup_company(df: DataFrame, companies: DataFrame) -> DataFrame:
    """df (acn, abn, norm_name) with company_id of the company found by ACN, else ABN, else name; of several the greatest id."""
    out = df
    for key in ("acn", "abn", "norm_name"):
        ids = companies.where(F.col(key).isNotNull()).groupBy(key).agg(F.max("id").alias(f"_by_{key}"))
        out = out.join(ids, key, "left")
    return out.withColumn("company_id", F.coalesce("_by_acn", "_by_abn", "_by_norm_name")).drop("_by_acn", "_by_abn", "_by_norm_name")


def matched(condition: Column) -> Column:
    """A condition that is false where it would be null."""
    return F.coalesce(condition, F.lit(False))

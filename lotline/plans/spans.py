"""Words with places on pages: label and value pairs, entity boxes, tags, label export, re-anchoring."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotline.operators.joins import overlap_join
from lotline.operators.ordered import bio_tags
from lotline.operators.staging import settled


def word_spans(docs: DataFrame, per_line: int = 10, lines: int = 10) -> DataFrame:
    """doc_id, page, span, text, x0, y0, x1, y1: the words of a text laid out in lines and pages of fixed size."""
    words = docs.where("text <> ''").select("doc_id", F.posexplode(F.split("text", " ")).alias("span", "text"))
    col, line = F.pmod("span", F.lit(per_line)), F.floor(F.col("span") / per_line)
    row = F.pmod(line, F.lit(lines))
    return words.select("doc_id", F.floor(line / lines).alias("page"), "span", "text", (col * 50).alias("x0"), (row * 20).alias("y0"), (col * 50 + 40).alias("x1"), (row * 20 + 10).alias("y1"))


def by_repetition(docs: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """Documents whose id no other row has, and the others (None if there are none), whose pages lie over each other; a null id counts among these."""
    repeated = settled(docs.groupBy(F.col("doc_id").alias("_id")).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1 or _id is null").select("_id"), "repeated")
    if repeated.isEmpty():
        return docs, None
    same = F.col("doc_id").eqNullSafe(F.col("_id"))
    return docs.join(repeated, same, "left_anti"), docs.join(repeated, same, "left_semi")


def page_words(docs: DataFrame, per_line: int = 10, lines: int = 10) -> DataFrame:
    """doc_id, page, spans: the words of word_spans, those of a page as one array in order (span, text and box), without a shuffle."""
    size = per_line * lines
    # Bound by lambdas, so that a text is cut into words once, not once a page.
    pages = lambda words: F.transform(F.sequence(F.lit(0), F.floor((F.size(words) - 1) / size).cast("int")), lambda p: F.struct(p.cast("long").alias("page"), F.slice(words, p * size + 1, F.lit(size)).alias("texts")))
    rows = docs.where("text <> ''").select("doc_id", F.explode(F.transform(F.array(F.split("text", " ")), pages)[0]).alias("p")).select("doc_id", "p.*")
    col, row = (lambda i: F.pmod(i, F.lit(per_line))), (lambda i: F.floor(i / per_line))
    span = lambda text, i: F.struct((F.col("page") * size + i).cast("int").alias("span"), text.alias("text"), (col(i) * 50).alias("x0"), (row(i) * 20).alias("y0"), (col(i) * 50 + 40).alias("x1"), (row(i) * 20 + 10).alias("y1"))
    return rows.select("doc_id", "page", F.transform("texts", span).alias("spans"))


#: How far a value may stand from its label. To the right: at most ROW points up or down. Below: at most
#: DOWN points down and ASIDE sideways; BELOW points are added to the distance of values below.
ROW, DOWN, ASIDE, BELOW = 3, 25, 60, 5
#: Width of the first ring of cells to a label's right; each ring is GROWTH times as wide as the one before.
RING, GROWTH = 64, 4


def near_in_cells(labels: DataFrame, spans: DataFrame, x: tuple[Column, Column], y: tuple[Column, Column], width: float, height: float) -> DataFrame:
    """Pairs of labels and spans of a page with x0 and y0 of the span in cells that the label's window x, y touches."""
    cell = lambda v, size: F.floor(v / size).cast("long")
    window = labels.withColumn("_cx", F.explode(F.sequence(cell(x[0], width), cell(x[1], width)))).withColumn("_cy", F.explode(F.sequence(cell(y[0], height), cell(y[1], height))))
    return window.join(spans.withColumns({"_cx": cell(F.col("x0"), width), "_cy": cell(F.col("y0"), height)}), ["doc_id", "page", "_cx", "_cy"]).where("span <> l_span").drop("_cx", "_cy")


def label_value_pairs(labels: DataFrame, spans: DataFrame) -> DataFrame:
    """Each label span's nearest value span: to the right on its row, or below within 25 points and 60 points sideways (5 points further off).

    labels and spans carry doc_id, page, span, text and a box; rows with a null in the box take no part. Equal
    distances go to the smaller span. Spans meet labels in cells of the page: below in cells of the window's size; to
    the right in rings, each four times as wide as the last, which only labels that found nothing to their right go on to.
    """
    box = ["span", "text", "x0", "y0", "x1", "y1"]
    whole = F.forall(F.array(*[F.col(c).isNull() for c in ("x0", "y0", "x1", "y1")]), lambda v: ~v)
    spans = settled(spans.where(whole).select("doc_id", "page", *box), "spans")
    labels = settled(labels.where(whole).select("doc_id", "page", *[F.col(c).alias(f"l_{c}") for c in box]), "labels")
    right = (F.abs(F.col("y0") - F.col("l_y0")) <= ROW) & (F.col("x0") >= F.col("l_x1"))
    down = F.col("y0") - F.col("l_y1")
    below = down.between(0, DOWN) & (F.abs(F.col("x0") - F.col("l_x0")) <= ASIDE)
    distance = F.when(right, F.col("x0") - F.col("l_x1")).when(below, down + BELOW)
    key = ["doc_id", "page", "l_span"]
    value = F.struct(F.col("span").alias("v_span"), F.col("text").alias("v_text"), "distance")
    nearest = lambda df: df.withColumn("distance", distance).groupBy(*key).agg(F.min_by(value, F.struct("distance", "span")).alias("b"))
    under = near_in_cells(labels, spans, (F.col("l_x0") - ASIDE, F.col("l_x0") + ASIDE), (F.col("l_y1"), F.col("l_y1") + DOWN), 2 * ASIDE + 8, 2 * DOWN).where(below)
    found = [nearest(under)]
    most, least = spans.agg(F.max("x0")).first()[0] or 0, labels.agg(F.min("l_x1")).first()[0] or 0
    reach, width, before, rest = most - least, RING, 0, labels
    while True:
        window = (F.col("l_x1") + before, F.col("l_x1") + width)
        ring = near_in_cells(rest, spans, window, (F.col("l_y0") - ROW, F.col("l_y0") + ROW), width, 4 * ROW).where(right & (F.col("x0") <= F.col("l_x1") + width))
        found.append(settled(nearest(ring), "ring"))
        if width >= reach:
            break
        rest = settled(rest.join(found[-1].select(*key), key, "left_anti"), "rest")
        before, width = width, width * GROWTH
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out.groupBy(*key).agg(F.min_by("b", F.struct("b.distance", "b.v_span")).alias("b")).select(*key, "b.*")


def page_label_values(pages: DataFrame) -> DataFrame:
    """label_value_pairs of pages (doc_id, page, labels, spans) that hold their labels and spans as arrays: each is worked out by itself.

    Every label of a page looks at every span of it: for pages of a bounded size. Boxes are whole.
    """
    right = lambda l, s: (F.abs(s["y0"] - l["y0"]) <= ROW) & (s["x0"] >= l["x1"])  # noqa: E731, E741
    below = lambda l, s: (s["y0"] - l["y1"]).between(0, DOWN) & (F.abs(s["x0"] - l["x0"]) <= ASIDE)  # noqa: E731, E741
    distance = lambda l, s: F.when(right(l, s), s["x0"] - l["x1"]).otherwise(s["y0"] - l["y1"] + BELOW)  # noqa: E731, E741
    near = lambda l: F.filter("spans", lambda s: (right(l, s) | below(l, s)) & (s["span"] != l["span"]))  # noqa: E731, E741
    value = lambda l: F.array_min(F.transform(near(l), lambda s: F.struct(distance(l, s).alias("distance"), s["span"].alias("v_span"), s["text"].alias("v_text"))))  # noqa: E731, E741
    rows = pages.where(F.size("labels") > 0).select("doc_id", "page", F.explode(F.transform("labels", lambda l: F.struct(l["span"].alias("l_span"), value(l).alias("b")))).alias("l"))  # noqa: E741
    return rows.where("l.b is not null").select("doc_id", "page", "l.l_span", "l.b.v_span", "l.b.v_text", "l.b.distance")


def union_bbox(entities: DataFrame, spans: DataFrame) -> DataFrame:
    """doc_id, page, entity, box, n_words, font: the box round all word spans that an entity's characters overlap, and the first one's font (if spans carry it)."""
    hits = overlap_join(entities, spans, ["doc_id", "page"], ("e_start", "e_end"), ("char_start", "char_end"))
    font = F.min_by(F.col("font") if "font" in spans.columns else F.lit(None).cast("string"), "char_start").alias("font")
    return hits.groupBy("doc_id", "page", "entity").agg(F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1"), F.count(F.lit(1)).alias("n_words"), font)


def page_boxes(pages: DataFrame) -> DataFrame:
    """union_bbox of pages (doc_id, page, entities, spans) that hold their entities and spans as arrays: each is worked out by itself.

    Every entity of a page looks at every span of it: for pages of a bounded size. Spans carry a font.
    """
    hit = lambda e: lambda s: (e["e_start"] < s["char_end"]) & (s["char_start"] < e["e_end"])
    rows = pages.where(F.size("entities") > 0).select("doc_id", "page", F.explode(F.transform("entities", lambda e: F.struct(e["entity"].alias("entity"), F.filter("spans", hit(e)).alias("hits")))).alias("e"))
    rows = rows.select("doc_id", "page", F.col("e.entity").alias("entity"), F.col("e.hits").alias("h")).where(F.size("h") > 0)
    font = F.array_min(F.transform("h", lambda s: F.struct(s["char_start"].alias("char_start"), s["font"].alias("font"))))["font"]
    return rows.select("doc_id", "page", "entity", F.array_min("h.x0").alias("x0"), F.array_min("h.y0").alias("y0"), F.array_max("h.x1").alias("x1"), F.array_max("h.y1").alias("y1"), F.size("h").cast("long").alias("n_words"), font.alias("font"))


def export_labels(spans: DataFrame, overlaps: DataFrame) -> DataFrame:
    """One row per page: words and tags in order; words of no entity are O."""
    tags = bio_tags(overlaps).withColumnRenamed("word", "span")
    rows = spans.join(tags, ["doc_id", "page", "span"], "left")
    listed = F.array_sort(F.collect_list(F.struct("span", "text", F.coalesce("tag", F.lit("O")).alias("tag"))))
    return rows.groupBy("doc_id", "page").agg(listed.alias("w")).select("doc_id", "page", F.col("w.text").alias("words"), F.col("w.tag").alias("tags"))


def page_labels(pages: DataFrame) -> DataFrame:
    """export_labels of pages (doc_id, page, spans, overlaps) that hold their spans and overlaps (entity, word, role) as arrays: each is worked out by itself.

    Every span of a page looks at every overlap of it: for pages of a bounded size.
    """
    begins = lambda own, o: o["word"] == F.array_min(F.transform(F.filter(own, lambda x: x["entity"] == o["entity"]), lambda x: x["word"]))
    tagged = lambda own: F.transform(own, lambda o: F.struct(o["word"].alias("word"), o["entity"].alias("entity"), F.concat(F.when(begins(own, o), "B-").otherwise("I-"), F.upper(o["role"])).alias("tag")))
    of_span = lambda tags, s: F.coalesce(F.array_max(F.filter(tags, lambda t: t["word"] == s["span"]))["tag"], F.lit("O"))
    # Bound by a lambda, so that the tags are worked out once, not once a span.
    tags = F.transform(F.array(tagged(F.col("overlaps"))), lambda tags: F.transform("spans", lambda s: of_span(tags, s)))[0]
    return pages.select("doc_id", "page", F.col("spans.text").alias("words"), tags.alias("tags"))


def split_by_doc(df: DataFrame, share: float, seed: int = 0) -> DataFrame:
    """fold: 'eval' for about `share` of the documents, else 'train'; all rows of a document go together."""
    return df.withColumn("fold", F.when(F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(10_000)) < int(share * 10_000), "eval").otherwise("train"))


def reanchor(evidence: DataFrame, docs: DataFrame, pages: DataFrame | None = None) -> DataFrame:
    """Evidence with its saved text found again: new span_start and span_end, null if it is gone.

    evidence: doc_id, saved_text, and span_start, where it stood (else the first place is taken). Of several
    places the one nearest to the old start counts, the earlier of two: the next one after and the last one
    before it are looked for, the latter in the reversed text, so no list of places is made. With pages
    (doc_id, page, start) also page, the last one to begin at or before the new start, and page_start, page_end
    inside it. A saved text that is empty or null is nowhere.
    """
    if "span_start" not in evidence.columns:
        evidence = evidence.withColumn("span_start", F.lit(0))
    n, size, old = F.length("text"), F.length("saved_text"), F.greatest(F.coalesce("span_start", F.lit(0)), F.lit(0))
    found = evidence.join(docs.select("doc_id", "text"), "doc_id", "left").withColumns({"_old": old, "_n": n, "_size": size})
    found = found.withColumns({"_next": F.expr("locate(saved_text, text, cast(_old as int) + 1)"), "_back": F.expr("locate(reverse(saved_text), reverse(text), cast(greatest(_n - _old - _size + 2, 1) as int))")})
    ahead = F.when(F.col("_next") > 0, F.col("_next") - 1)
    behind = F.when((F.col("_back") > 0) & (F.col("_old") > 0), F.col("_n") - F.col("_size") - F.col("_back") + 1)
    nearer = F.when(behind.isNull() | (ahead - F.col("_old") < F.col("_old") - behind), ahead).otherwise(behind)
    start = F.when(F.col("_size") > 0, F.coalesce(nearer, ahead)).cast("int")
    out = found.withColumn("span_start", start).withColumn("span_end", F.col("span_start") + F.col("_size")).drop("text", "_old", "_n", "_size", "_next", "_back")
    if pages is None:
        return out
    begins = pages.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("start", "page"))).alias("_pages"))
    own = F.element_at(F.filter("_pages", lambda p: p["start"] <= F.col("span_start")), -1)
    out = out.join(begins, "doc_id", "left").withColumn("_page", F.when(F.size(F.filter("_pages", lambda p: p["start"] <= F.col("span_start"))) > 0, own))
    return out.withColumns({"page": F.col("_page.page"), "page_start": F.col("span_start") - F.col("_page.start"), "page_end": F.col("span_end") - F.col("_page.start")}).drop("_pages", "_page")


def council_for_postcode(df: DataFrame, councils: DataFrame, postcode: Column) -> DataFrame:
    """df with the slug of the council that covers the postcode; councils (slug, postcodes array)."""
    own = councils.select("slug", F.explode("postcodes").alias("_pc")).groupBy("_pc").agg(F.min("slug").alias("slug"))
    return df.withColumn("_pc", postcode).join(own, "_pc", "left").drop("_pc")

"""Looking at predictions: token tables, highlighted segments, HTML."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adsieve.functions.text import SPACE, cut, let, pages
from adsieve.operators.spans import KEY

# Tokens that aren't shown, and the colours (fill, border) of each type.
HIDDEN = ["<s>", "</s>", "<pad>"]
COLOURS = {"PER": ("#ffdad9", "#ffb4ab"), "ORG": ("#d7e3ff", "#abc7ff"), "ADDR": ("#e9dff7", "#d0bcff"), "O": ("#f5f5f5", "#cccccc")}


def fixed_label(label: Column) -> Column:
    """The digit 0 stands for O."""
    return F.when(label == "0", "O").otherwise(label)


def token_table(tokens: DataFrame) -> DataFrame:
    """A row for each token of (doc_id, chunk_id, i, token, token_id, label, confidence); labels aren't repaired."""
    tag = fixed_label(F.col("label"))
    return tokens.select(
        "doc_id", (F.col("chunk_id") + 1).alias("chunk_no"), F.col("i").alias("index"), "token", "token_id", tag.alias("predicted_tag"),
        F.round("confidence", 4).alias("confidence"), F.when((tag != "O") & ~F.col("token").isin(HIDDEN), "✅").otherwise("").alias("is_entity"),
    )


def segments(text: Column, entities: Column) -> Column:
    """The text in order as (text, label): gaps have no label; overlapping entities repeat text; blank text gives none."""
    empty = F.array().cast("array<struct<text:string,label:string>>")
    none = F.lit(None).cast("string")
    ordered = F.array_sort(F.transform(entities, lambda e, i: F.struct(e["start"].alias("start"), i.alias("i"), e["end"].alias("end"), e["label"].alias("label"))))

    def pieces(given: Column) -> Column:
        own, n, paged = given["own"], given["n"], given["pages"]
        part = lambda a, b, label: F.struct(cut(paged, a, b).alias("text"), label.alias("label"))

        def one(e: Column, i: Column) -> Column:
            """An entity after the gap between it and the end of the one before."""
            cursor = F.when(i > 0, F.least(F.get(own, i - 1)["end"], n)).otherwise(F.lit(0))
            start, end = F.greatest(e["start"], F.lit(0)), F.least(e["end"], n)
            gap = F.when(start > cursor, F.array(part(F.greatest(cursor, F.lit(0)), F.least(start, n), none))).otherwise(empty)
            return F.concat(gap, F.when(end > start, F.array(part(start, end, e["label"]))).otherwise(empty))

        last = F.when(F.size(own) > 0, F.greatest(F.least(F.try_element_at(own, F.lit(-1))["end"], n), F.lit(0))).otherwise(F.lit(0))
        rest = F.when(last < n, F.array(part(last, n, none))).otherwise(empty)
        return F.filter(F.concat(F.flatten(F.transform(own, one)), rest), lambda s: s["text"] != "")

    given = F.struct(ordered.alias("own"), F.length(text).alias("n"), pages(text).alias("pages"))
    return F.when(text.rlike(f"[^{SPACE[1:-1]}]"), let(given, pieces)).otherwise(empty)


def _escaped(text: Column) -> Column:
    for raw, safe in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        text = F.replace(text, F.lit(raw), F.lit(safe))
    return text


def _frame(label: Column) -> tuple[Column, Column]:
    """What stands before a token's confidence and after its text: the same for all tokens of a label."""
    kind = F.when(label.contains("-"), F.substring_index(label, "-", -1)).otherwise(label)
    pick = lambda k: F.coalesce(F.element_at(F.create_map(*[F.lit(x) for t, c in COLOURS.items() for x in (t, c[k])]), kind), F.lit(COLOURS["O"][k]))
    style = F.concat(F.lit("display:inline-block;margin:3px;padding:4px 8px;color:#333333;background-color:"), pick(0), F.lit(";border:1px solid "), pick(1))
    return F.concat(F.lit('<div style="'), style, F.lit('" title="Tag: '), _escaped(label), F.lit(" | Conf: ")), F.concat(F.lit("</span><span>"), _escaped(label), F.lit("</span></div>"))


def _framed(token: Column, confidence: Column, before: Column, after: Column) -> Column:
    return F.concat(before, F.format_string('%.4f"><span>', confidence), _escaped(token), after)


def token_html(token: Column, label: Column, confidence: Column) -> Column:
    """A coloured block for one token; text is escaped."""
    return _framed(token, confidence, *_frame(label))


def page_html(tokens: Column) -> Column:
    """I6 on a document's tokens (token, label, confidence) in order: its page, of those that are shown.

    A label's frame is made once; a token of no label gives no block.
    """
    shown = F.filter(tokens, lambda t: ~t["token"].isin(HIDDEN) & t["label"].isNotNull())

    def body(own: Column) -> Column:
        labels = F.array_distinct(F.transform(own, lambda t: t["label"]))
        frame = lambda label: F.struct(*[c.alias(n) for n, c in zip(("before", "after"), _frame(fixed_label(label)))])
        block = lambda t, f: _framed(t["token"], t["confidence"], f["before"], f["after"])
        return let(F.map_from_arrays(labels, F.transform(labels, frame)), lambda frames: F.array_join(F.transform(own, lambda t: let(F.element_at(frames, t["label"]), lambda f: block(t, f))), ""))

    return F.concat(F.lit('<div style="font-family:sans-serif;line-height:2.5;">'), let(shown, body), F.lit("</div>"))


def document_html(tokens: DataFrame) -> DataFrame:
    """(doc_id, html) of all shown tokens in order of chunk and place. Tokens are gathered, not their far larger blocks."""
    shown = tokens.where(~F.col("token").isin(HIDDEN))
    ordered = F.array_sort(F.collect_list(F.struct(KEY[1], "i", "token", "label", "confidence")))
    return shown.groupBy("doc_id").agg(ordered.alias("tokens")).select("doc_id", page_html(F.col("tokens")).alias("html"))

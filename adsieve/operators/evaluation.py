"""Entity-level precision, recall and F1, and token accuracy."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adsieve.functions import tags
from adsieve.functions.text import let
from adsieve.schemas import IGNORED, TAGS, TYPES


def without_ignored(tokens: DataFrame) -> DataFrame:
    """M1: tokens whose gold label doesn't count go."""
    return tokens.where(F.col("gold_id") != IGNORED)


def named(ids: DataFrame) -> DataFrame:
    """Tags of (gold_id, predicted_id)."""
    names = F.array(*map(F.lit, TAGS))
    return ids.withColumns({"gold": F.get(names, F.col("gold_id")), "predicted": F.get(names, F.col("predicted_id"))})


def gathered(tokens: DataFrame, repair: bool) -> DataFrame:
    """(i, gold, predicted) as arrays of a chunk, of (doc_id, chunk_id, i, gold, predicted), if asked after the three repair rules."""
    order = F.array_sort(F.collect_list(F.struct("i", "gold", "predicted")))
    rows = tokens.groupBy("doc_id", "chunk_id").agg(order.alias("t"))
    return fixed(rows.select("doc_id", "chunk_id", F.col("t.i").alias("i"), F.col("t.gold").alias("gold"), F.col("t.predicted").alias("predicted")), repair)


def fixed(chunks: DataFrame, repair: bool) -> DataFrame:
    return chunks.withColumns({c: tags.repair_all(F.col(c)) for c in ("gold", "predicted")}) if repair else chunks


def repaired(tokens: DataFrame) -> DataFrame:
    """Both tag columns of (doc_id, chunk_id, i, gold, predicted) after the three repair rules."""
    return gathered(tokens, True).select("doc_id", "chunk_id", F.inline(F.arrays_zip("i", "gold", "predicted")))


def entity_keys(tagged: Column) -> Column:
    """``label:first:end`` of each entity of an array of tags, by place; an I tag that follows no tag of its type begins one."""
    def found(own: Column) -> Column:
        borders = F.filter(F.transform(own, lambda t, i: F.when(~t.startswith("I-"), i)), lambda i: i.isNotNull())
        key = lambda marks: lambda i, k: F.concat_ws(":", tags.type_of(F.get(own, i)), i.cast("string"), F.coalesce(F.get(marks, k + 1), F.size(own)).cast("string"))
        begun = lambda marks: lambda i, k: F.when(F.get(own, i).startswith("B-"), key(marks)(i, k))
        return F.filter(let(borders, lambda marks: F.transform(marks, begun(marks))), lambda x: x.isNotNull())

    return let(tags.repair_starts(tagged), found)


def _rate(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def scores(tokens: DataFrame, repair: bool = False) -> DataFrame:
    """M2, M3: (label, precision, recall, f1, accuracy) overall and for each type, of (doc_id, chunk_id, i, gold, predicted).

    A chunk's tags gather once. ``repair``: after the three repair rules.
    """
    return chunk_scores(gathered(tokens, repair))


def chunk_scores(chunks: DataFrame, repair: bool = False) -> DataFrame:
    """The same of rows with ``gold`` and ``predicted``, the tags of a chunk as arrays.

    Entities, hits and equal tags are counted on the arrays, for all types at a time, and one sum is left. Accuracy is
    that of tags with other types masked.
    """
    keys = fixed(chunks, repair).select("gold", "predicted", entity_keys(F.col("gold")).alias("g"), entity_keys(F.col("predicted")).alias("p"))
    masked = lambda tag, t: F.when(tags.type_of(tag) == t, tag).otherwise("O") if t else tag

    def counts(pair: Column, hit: Column, t: str | None) -> list[Column]:
        of = lambda found: F.size(F.filter(found, lambda k: k.startswith(f"{t}:"))) if t else F.size(found)
        same = F.size(F.filter(pair, lambda x: masked(x["gold"], t) == masked(x["predicted"], t)))
        name = t or "overall"
        return [of(F.col("g")).alias(f"{name}_gold"), of(F.col("p")).alias(f"{name}_predicted"), of(hit).alias(f"{name}_hit"), same.alias(f"{name}_same")]

    every = lambda x: F.struct(F.size("gold").alias("n"), *[c for t in (None, *TYPES) for c in counts(x["pair"], x["hit"], t)])
    both = F.struct(F.arrays_zip("gold", "predicted").alias("pair"), F.array_intersect("g", "p").alias("hit"))
    each = keys.select(let(both, every).alias("c")).select("c.*")
    summed = each.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in each.columns])
    p, r = (lambda t: _rate(F.col(f"{t}_hit"), F.col(f"{t}_predicted"))), (lambda t: _rate(F.col(f"{t}_hit"), F.col(f"{t}_gold")))
    row = lambda t: F.struct(F.lit(t).alias("label"), p(t).alias("precision"), r(t).alias("recall"), F.when(p(t) + r(t) > 0, 2 * p(t) * r(t) / (p(t) + r(t))).otherwise(0.0).alias("f1"), _rate(F.col(f"{t}_same"), F.col("n")).alias("accuracy"))
    return summed.select(F.inline(F.array(*map(row, ("overall", *TYPES)))))


def as_lines(found: DataFrame) -> DataFrame:
    """Metrics as text lines, one a figure."""
    each = [F.concat(F.col("label"), F.lit(f"_{m}: "), F.format_number(m, 4)) for m in ("precision", "recall", "f1", "accuracy")]
    return found.select(F.explode(F.array(*each)).alias("value"))

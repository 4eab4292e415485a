"""Mixing sources to target weights: temperature, then budgeted block permutations.

Source token shares are raised to an exponent and normalised. The exponent is bisected: either the
largest one whose weights reach a target entropy, or the smallest one (the flattest mix) at which
no source is repeated more often than a limit. A token budget is split by these weights. A source
repeats whole as often as its budget allows; the rest comes from one more permutation of its
blocks (hash buckets of about ``block_tokens`` tokens): blocks are taken in order until the rest
is spent, and the last block is taken document by document, so that every source meets its budget
within one document.

Up to ``max_sources`` sources, their token counts are weighed on the driver and broadcast; more stay
a table: the exponent is bisected by aggregates over it, and it is joined with salt, so that a hot
source is spread. Documents are mapped where they lie; only the one border block of each source is
sorted. Blocks before the border are summed in two steps, by ranges of their keys and within the
one range that holds the border, so that no task sorts all blocks of a source.

Defined results: a null source is a source of its own; a null or empty text has 0 tokens, and a
source without tokens has weight 0 and each of its documents once if the mix covers everything,
else none; repeated rows count each by itself; an empty table gives an empty result; other columns
are carried along, but for those named like the mix's own four, which it replaces.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adsieve.llm.storage import keep

SEED = 17


def token_count(text: Column) -> Column:
    """Words: runs of characters other than ASCII white space (0 for null)."""
    stripped = F.regexp_replace(text, r"[^\x20\x09-\x0D]+", "x")
    return F.coalesce(F.length(F.translate(stripped, " \t\n\x0b\f\r", "")), F.lit(0)).cast("long")


def weights_at(tokens: dict, exponent: float) -> dict:
    total = math.fsum(tokens.values())
    raised = {k: (n / total) ** exponent if n else 0.0 for k, n in tokens.items()}
    norm = math.fsum(raised.values())
    return {k: v / norm for k, v in raised.items()} if norm else dict.fromkeys(tokens, 0.0)


def entropy(weights: dict) -> float:
    return -math.fsum(w * math.log(w) for w in weights.values() if w > 0)


def _bisected(fine, flat_is_fine: bool, steps: int = 60) -> float:
    """The border in [0, 1] of a condition that holds at one end only (0 if ``flat_is_fine``)."""
    low, high = 0.0, 1.0
    for _ in range(steps):
        middle = (low + high) / 2
        if fine(middle) == flat_is_fine:
            low = middle
        else:
            high = middle
    return low if flat_is_fine else high


def choose_exponent(tokens: dict, budget_of, target_entropy: float | None = None, max_repeats: float | None = None) -> float:
    """The exponent for one of the two targets; an unreachable target gives the nearest end of [0, 1]."""
    if (target_entropy is None) == (max_repeats is None):
        raise ValueError("give target_entropy or max_repeats")
    if target_entropy is not None:
        fine = lambda a: entropy(weights_at(tokens, a)) >= target_entropy
        return 1.0 if fine(1.0) else _bisected(fine, True)

    def fine(a: float) -> bool:
        weights = weights_at(tokens, a)
        budget = budget_of(weights)
        return all(weights[k] * budget <= max_repeats * n * (1 + 1e-12) for k, n in tokens.items() if n)

    return 0.0 if fine(0.0) else _bisected(fine, False)


MIX = ["mix_tokens", "mix_weight", "mix_epoch", "mix_block"]
PLAN = "plan_source string, mix_weight double, plan_passes long, plan_rest long, plan_blocks long"
SALT = 16


def _local_plan(tokens: dict, target_entropy: float | None, max_repeats: float | None, budget: float | None, block_tokens: int) -> list[tuple]:
    total = math.fsum(tokens.values())

    def budget_of(weights: dict) -> float:
        return total * budget if budget is not None else max((n / weights[k] for k, n in tokens.items() if n), default=0.0)

    exponent = choose_exponent(tokens, budget_of, target_entropy, max_repeats) if total else 1.0
    weights = weights_at(tokens, exponent) if total else dict.fromkeys(tokens, 0.0)
    whole = budget_of(weights) if total else 0.0
    rows = []
    for k, n in tokens.items():
        own = round(weights[k] * whole)
        passes, rest = (own // n, own % n) if n else (int(budget is None), 0)
        rows.append((k, weights[k], passes, rest, 1 + n // block_tokens))
    return rows


def _spread_plan(sources: DataFrame, target_entropy: float | None, max_repeats: float | None, budget: float | None, block_tokens: int) -> DataFrame:
    """The same plan of (source, n) as a table. The share of a source that repeats most is the smallest, and
    that of the one that bounds a covering budget the largest, so sums over the sources tell all of an exponent."""
    facts = sources.agg(F.sum("n").alias("total"), F.min(F.when(F.col("n") > 0, F.col("n"))).alias("least"), F.max("n").alias("most")).first()
    total = facts["total"] or 0
    share = F.col("n") / F.lit(float(max(1, total)))
    live = sources.where("n > 0")

    def sums(exponents: list[float]) -> list[tuple[float, float]]:
        each = [F.struct(F.sum(F.pow(share, F.lit(a))), F.sum(F.pow(share, F.lit(a)) * F.log(share))).alias(f"s{k}") for k, a in enumerate(exponents)]
        row = live.agg(*each).first()
        return [tuple(row[k]) for k in range(len(exponents))]

    def whole_at(a: float, norm: float) -> float:
        return total * budget if budget is not None else facts["most"] * norm / (facts["most"] / total) ** a

    def fine(a: float, norm: float, logs: float) -> bool:
        if target_entropy is not None:
            return math.log(norm) - a * logs / norm >= target_entropy
        return (facts["least"] / total) ** a / norm * whole_at(a, norm) <= max_repeats * facts["least"] * (1 + 1e-12)

    flat_is_fine, low, high = target_entropy is not None, 0.0, 1.0
    if not total:
        exponent = 1.0
    elif fine(end := float(flat_is_fine), *sums([end])[0]):
        exponent = end
    else:
        for _ in range(15):  # sixteen parts a round: as far as 60 halvings
            marks = [low + (high - low) * k / 16 for k in range(1, 16)]
            good = [fine(a, *f) for a, f in zip(marks, sums(marks))]
            k = sum(g == flat_is_fine for g in good)
            low, high = [low, *marks][k], [*marks, high][k]
        exponent = low if flat_is_fine else high
    norm = sums([exponent])[0][0] if total else 1.0
    weight = F.when(F.col("n") > 0, F.pow(share, F.lit(exponent)) / norm).otherwise(F.lit(0.0))
    own = F.bround(weight * F.lit(float(whole_at(exponent, norm) if total else 0))).cast("long")
    passes = F.when(F.col("n") > 0, F.floor(own / F.col("n"))).otherwise(F.lit(int(budget is None)))
    rest = F.when(F.col("n") > 0, own - passes * F.col("n")).otherwise(F.lit(0))
    return sources.select(F.col("source").cast("string").alias("plan_source"), weight.alias("mix_weight"), passes.cast("long").alias("plan_passes"), rest.cast("long").alias("plan_rest"), (1 + F.floor(F.col("n") / block_tokens)).cast("long").alias("plan_blocks"))


def _beside(rows: DataFrame, small: DataFrame, own: str, key: str, few: bool, how: str) -> DataFrame:
    """Join a table of one row a source: broadcast while sources are few, else dealt with salt."""
    if few:
        return rows.join(F.broadcast(small), F.col(own).eqNullSafe(F.col(key)), how)
    salted = small.withColumn("key_salt", F.explode(F.array(*map(F.lit, range(SALT)))))
    dealt = rows.withColumn("row_salt", F.pmod(F.col("mix_hash"), F.lit(SALT)).cast("int"))
    return dealt.join(salted, F.col(own).eqNullSafe(F.col(key)) & (F.col("row_salt") == F.col("key_salt")), how).drop("key_salt", "row_salt")


def mix(
    docs: DataFrame,
    target_entropy: float | None = None,
    max_repeats: float | None = None,
    budget: float | None = 1.0,
    block_tokens: int = 1_000_000,
    max_sources: int = 100_000,
    source_column: str = "source",
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """The documents of the mix, a row for each copy, with ``mix_tokens``, ``mix_weight``, ``mix_epoch`` and ``mix_block``.

    ``budget``: tokens of the mix as a multiple of those of ``docs``; None: the least with which
    every document appears (the mix covers everything and only repeats). ``mix_epoch`` counts the
    copies of a document from 0 and ``mix_block`` orders the blocks of an epoch of a source.
    ``max_sources``: up to how many sources the plan is made on the driver; the result is the same.
    """
    if (target_entropy is None) == (max_repeats is None):
        raise ValueError("give target_entropy or max_repeats")
    spark = docs.sparkSession
    column = lambda name: F.col(f"`{name}`")
    kept = [c for c in docs.columns if c not in MIX]
    given = [F.xxhash64(F.lit(SEED), column(id_column), column(text_column)).alias("mix_hash"), F.xxhash64(F.lit(SEED + 1), column(id_column), column(text_column)).alias("mix_order")]
    measured = docs.select(
        F.struct(*[column(c) for c in kept]).alias("row"), column(source_column).cast("string").alias("mix_source"), column(id_column).alias("mix_id"), *given,
        token_count(column(text_column)).alias("mix_tokens"),
    )
    by_source = measured.groupBy(F.col("mix_source").alias("source")).agg(F.sum("mix_tokens").alias("n"))
    counted = by_source.limit(max_sources + 1).collect()
    few = len(counted) <= max_sources
    targets = (target_entropy, max_repeats, budget, block_tokens)
    plan = spark.createDataFrame(_local_plan({r["source"]: r["n"] for r in counted}, *targets), PLAN) if few else _spread_plan(keep(by_source, "sources"), *targets)
    planned = _beside(measured, plan, "mix_source", "plan_source", few, "inner")
    block = F.pmod("mix_hash", F.col("plan_blocks"))
    keyed = planned.withColumn("plan_key", F.xxhash64(F.lit(SEED), F.coalesce("plan_source", F.lit("")), block))
    blocks = keyed.where("plan_rest > 0").groupBy("plan_source", "plan_key").agg(F.sum("mix_tokens").alias("n"), F.first("plan_rest").alias("rest"))
    cut = keep(blocks.withColumn("key_range", F.shiftright("plan_key", 52)), "blocks")
    sums = lambda *by: F.sum("n").over(Window.partitionBy(*by[:-1]).orderBy(by[-1])) - F.col("n")
    ranges = cut.groupBy("plan_source", "key_range").agg(F.sum("n").alias("n"), F.first("rest").alias("rest")).withColumn("before", sums("plan_source", "key_range"))
    border_range = ranges.where("before < rest AND before + n >= rest").select(F.col("plan_source").alias("range_source"), F.col("key_range").alias("border"), "before")
    inside = cut.join(border_range, F.col("plan_source").eqNullSafe(F.col("range_source")) & (F.col("key_range") == F.col("border")))
    border = inside.withColumn("before", F.col("before") + sums("plan_source", "key_range", "plan_key")).where("before < rest AND before + n >= rest")
    edges = border.select(F.col("plan_source").alias("edge_source"), F.col("plan_key").alias("edge_key"), (F.col("rest") - F.col("before")).alias("edge_rest"))  # one a source at most
    placed = _beside(keyed, edges, "plan_source", "edge_source", few, "left")
    at_edge = F.coalesce(F.col("plan_key") == F.col("edge_key"), F.lit(False))
    plain = placed.where(~at_edge).withColumn("copies", F.col("plan_passes") + F.coalesce((F.col("plan_key") < F.col("edge_key")).cast("long"), F.lit(0)))
    shuffled = Window.partitionBy("plan_source").orderBy("mix_order", "mix_id").rowsBetween(Window.unboundedPreceding, 0)
    sliced = placed.where(at_edge).withColumn("taken", F.sum("mix_tokens").over(shuffled) - F.col("mix_tokens"))
    border_docs = sliced.withColumn("copies", F.col("plan_passes") + (F.col("taken") < F.col("edge_rest")).cast("long")).drop("taken")
    found = plain.unionByName(border_docs).where("copies > 0")
    copied = found.withColumn("mix_epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
    permuted = F.xxhash64(F.lit(SEED) + F.col("mix_epoch"), F.coalesce("plan_source", F.lit("")), "plan_key")
    return copied.select(*[F.col(f"row.`{c}`").alias(c) for c in kept], "mix_tokens", "mix_weight", "mix_epoch", permuted.alias("mix_block"))


def in_order(mixed: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of a mix in its order: epoch by epoch, the sources' blocks interleaved, documents of a block by a hash.

    Partitions are ranges of that order, sorted, so copies of a document are as far apart as their epochs.
    """
    place = ["mix_epoch", "mix_block", "mix_place"]
    placed = mixed.withColumn("mix_place", F.xxhash64(F.lit(SEED + 2) + F.col("mix_epoch"), id_column, text_column))
    return placed.repartitionByRange(*place).sortWithinPartitions(*place).drop("mix_place")

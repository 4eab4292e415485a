"""Sentence boundaries learned from the corpus (N1): abbreviations, sentence starters and collocations by log-likelihood.

The statistics are those published for unsupervised multilingual boundary detection (Kiss and Strunk
2006): a type is an abbreviation if a period follows it far more often than chance, weighed by its
length and inner periods; a word starts sentences, or follows an abbreviation or number as its
collocate, if the two occur together more often than chance. All counts are aggregates over the
words of all texts; the learned lists, whole, are literals (hashed sets) of the expressions that
decide each boundary inside the JVM.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adsieve.functions.text import SPACE, let
from adsieve.operators.chunking import AFTER_MARK, tiled

# Fixed values of the published method: least scores, and the share of periods after an abbreviation.
ABBREVIATION, STARTER, COLLOCATION, ALWAYS = 0.3, 30.0, 7.88, 0.99
OPENERS, CLOSERS = r"[\"'“‘«(\[{]", r"[\"'”’»)\]},;:]"
NUMBER = r"^[0-9][0-9.,]*$"


def bare(word: Column) -> Column:
    """A word in small letters without quotes and brackets around it; its periods stay."""
    return F.lower(F.regexp_replace(word, f"^{OPENERS}+|{CLOSERS}+$", ""))


def type_of(bare_word: Column) -> Column:
    return F.regexp_replace(bare_word, r"\.+$", "")


def has_period(bare_word: Column) -> Column:
    return bare_word.endswith(".") & ~bare_word.endswith("..")


def tallies(documents: DataFrame) -> DataFrame:
    """(type, dot, next, followed, n): how often a type stands, by whether one period follows it and by the next word's type, if a mark ends it.

    Words are counted as they are written, in one pass over the texts; patterns then meet each different word once.
    The tallies are checkpointed: conditions on them would else move below the counting, each in a pass of its own.
    """
    words = F.array_remove(F.split("text", f"{SPACE}+"), "")
    each = let(words, lambda own: F.arrays_zip(own, F.slice(own, F.lit(2), F.size(own))))
    rows = documents.select(F.explode_outer(each).alias("w")).where("w IS NOT NULL").select("w.*").toDF("word", "after")
    shown = lambda c: F.coalesce(c, F.lit(""))  # noqa: E731  no word is empty
    ends = F.col("word").rlike(f"[.!?…]{CLOSERS}*$")  # as its bare form does
    written = rows.select(shown(F.col("word")).alias("word"), shown(F.when(ends, F.col("after"))).alias("next"))
    counted = written.groupBy("word", "next").agg(F.count(F.lit(1)).alias("n"))
    own = counted.select(bare(F.col("word")).alias("word"), type_of(bare(F.col("next"))).alias("next"), (F.col("next") != "").alias("followed"), "n")
    typed = own.select(type_of(F.col("word")).alias("type"), has_period(F.col("word")).alias("dot"), "next", "followed", "n")
    found = typed.groupBy("type", "dot", "next", "followed").agg(F.sum("n").alias("n"))
    return found.checkpoint() if documents.sparkSession.sparkContext.getCheckpointDir() else found.localCheckpoint()


def _times(count: Column, share: Column) -> Column:
    return F.when(count > 0, count * F.ln(share)).otherwise(F.lit(0.0))


def association(a: Column, b: Column, both: Column, n: Column) -> Column:
    """Log-likelihood ratio of two words that occur ``a`` and ``b`` times, ``both`` times together, among ``n``."""
    p, p1, p2 = b / n, both / a, (b - both) / (n - a)
    apart = _times(both, p1) + _times(a - both, 1 - p1) + _times(b - both, p2) + _times(n - a - b + both, 1 - p2)
    return 2 * (apart - _times(b, p) - _times(n - b, 1 - p))


def abbreviation_score(dot: Column, plain: Column, kind: Column, p: Column) -> Column:
    chance = _times(dot, p) + _times(plain, 1 - p)
    always = dot * F.ln(F.lit(ALWAYS)) + plain * F.ln(F.lit(1 - ALWAYS))
    letters = F.length(F.replace(kind, F.lit("."), F.lit("")))
    return -2 * (chance - always) * F.exp(-letters) * (F.length(kind) - letters + 1) * F.pow(letters, -plain)


def is_numeral(kind: Column) -> Column:
    return kind.rlike(NUMBER)


@dataclass
class Boundaries:
    """What the corpus has taught; ``split`` is a splitter for ``chunking.chunks``."""

    abbreviations: list[str] = field(default_factory=list)
    starters: list[str] = field(default_factory=list)
    collocations: list[str] = field(default_factory=list)

    def joined(self, piece: Column, following: Column) -> Column:
        """Does the mark at the end of a piece leave its sentence open?"""
        last = bare(F.regexp_extract(F.substring(piece, -80, 80), f"([^{SPACE[1:-1]}]+)$", 1))
        first = F.regexp_extract(F.substring(following, 1, 80), f"^([^{SPACE[1:-1]}]+)", 1)

        def decided(word: Column, after: Column) -> Column:
            kind, head = type_of(word), F.regexp_replace(after, f"^{OPENERS}+", "")
            small = head.rlike(r"^\p{Ll}")
            following_type = type_of(bare(after))
            ellipsis = word.endswith("..") | word.endswith("…")
            start = head.rlike(r"^\p{Lu}") & following_type.isin(self.starters)
            collocation = F.concat(kind, F.lit(" "), following_type).isin(self.collocations)
            initial = kind.rlike(r"^\p{L}$")
            number = is_numeral(kind) & (small | head.rlike("^[0-9]"))
            return F.when(ellipsis, small).when(has_period(word), collocation | initial | number | (kind.isin(self.abbreviations) & ~start)).otherwise(False)

        return let(F.struct(last.alias("last"), first.alias("first")), lambda w: decided(w["last"], w["first"]))

    def split(self, text: Column) -> Column:
        return tiled(text, AFTER_MARK, joined=self.joined)


def statistics(documents: DataFrame) -> DataFrame:
    """(kind, item, n, score) of the abbreviations, starters and collocations that (text) of all documents shows.

    ``n`` is how often an abbreviation has its period, a starter begins a sentence, a pair stands together.
    """
    words = tallies(documents)
    of = lambda dot: F.sum(F.when(dot, F.col("n")).otherwise(F.lit(0)))
    counts = words.groupBy("type").agg(of(F.col("dot")).alias("dot"), of(~F.col("dot")).alias("plain"))
    totals = counts.agg(F.sum(F.col("dot") + F.col("plain")).alias("n"), F.sum("dot").alias("dots"))
    known = counts.crossJoin(F.broadcast(totals))  # one row
    score = abbreviation_score(F.col("dot"), F.col("plain"), F.col("type"), F.col("dots") / F.col("n"))
    scored = known.where((F.col("dot") > 0) & F.col("type").rlike(r"\p{L}")).select("type", "dot", score.alias("score")).where(F.col("score") >= ABBREVIATION)
    abbreviations = scored.select(F.lit("abbreviation").alias("kind"), F.col("type").alias("item"), F.col("dot").alias("n"), "score")

    pairs = words.where("followed").select("type", "dot", "next", F.col("n").alias("both"))
    marked = pairs.join(scored.select("type", F.lit(True).alias("short")), "type", "left")
    held = F.col("dot") & (F.coalesce("short", F.lit(False)) | is_numeral(F.col("type")) | F.col("type").rlike(r"^\p{L}$"))
    begun = marked.where(~held).groupBy("next").agg(F.sum("both").alias("both"))
    breaks = begun.agg(F.sum("both").alias("breaks"))
    whole = known.select(F.col("type").alias("next"), (F.col("dot") + F.col("plain")).alias("b"), F.col("n").alias("all"))
    first = begun.crossJoin(F.broadcast(breaks)).join(whole, "next").where(F.col("next").rlike(r"\p{L}"))
    starts = first.select(F.lit("starter").alias("kind"), F.col("next").alias("item"), F.col("both").alias("n"), association(F.col("breaks"), F.col("b"), F.col("both"), F.col("all")).alias("score"), (F.col("both") / F.col("breaks") > F.col("b") / F.col("all")).alias("often"))
    starters = starts.where((F.col("score") >= STARTER) & F.col("often")).drop("often")
    met = marked.where(held & (F.col("both") > 1)).join(counts.select("type", F.col("dot").alias("a")), "type").join(whole, "next")
    together = met.select(F.lit("collocation").alias("kind"), F.concat_ws(" ", "type", "next").alias("item"), F.col("both").alias("n"), association(F.col("a"), F.col("b"), F.col("both"), F.col("all")).alias("score"), (F.col("both") / F.col("a") > F.col("b") / F.col("all")).alias("often"))
    collocations = together.where((F.col("score") >= COLLOCATION) & F.col("often")).drop("often")
    return abbreviations.unionByName(starters).unionByName(collocations)


def learn(documents: DataFrame) -> Boundaries:
    """Boundaries from the statistics of all documents: every item of each kind that its score lets pass."""
    lists = {kind: [] for kind in ("abbreviation", "starter", "collocation")}
    for row in statistics(documents).select("kind", "item").collect():  # one pass over the texts
        lists[row["kind"]].append(row["item"])
    return Boundaries(*map(sorted, lists.values()))

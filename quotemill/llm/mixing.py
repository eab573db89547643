"""Mixing sources to target weights by Pareto order sampling.

A source's target share of words over its size is the number of copies its documents
get on average. The whole part is certain: every document gets that many copies. The
rest is a sample of fixed size in words without replacement: each document draws a
uniform number u from its key, is ranked by the odds of u over the odds of its
inclusion probability, and the lowest ranks are taken until their words reach what
the source still lacks.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quotemill.llm.shared import IdBitmap, land, row_key, whole_row
from quotemill.operators.numbering import positions

#: Fixed values of the mix.
WEIGHTS = (5, 2, 1)
SHARE_PCT = 150
MAX_COPIES = 2

SEED = 20240229
#: A rank is cut into levels of so many bins; two levels leave a handful of documents per source.
BINS = 4096

N_WORDS = r"[^\x20\x09-\x0D]+"

#: The order of a source's ranking.
PLACE = ("_rank", "_id", "_key", "_salt")


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(N_WORDS)).cast("long"), F.lit(0).cast("long"))


def targets(
    sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share_pct: int = SHARE_PCT,
    max_copies: int = MAX_COPIES,
) -> DataFrame:
    """``sizes`` (source, source_size; one row per source) with each source's target.

    Sources in code point order, null last, take ``weights`` in turn. Targets share
    ``share_pct`` percent of all words by weight, none above ``max_copies`` times its source's
    size. Sources fill up in the order of size over weight; one is full if, with all
    later ones still open, its share of what the full ones before it leave exceeds its limit.
    The windows have one row per source.
    """
    w = F.element_at(
        F.array(*(F.lit(float(x)) for x in weights)),
        (F.pmod(F.row_number().over(Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))) - 1, F.lit(len(weights))) + 1),
    )
    total = F.sum("source_size").over(Window.partitionBy()) * F.lit(share_pct / 100)
    limit = (F.col("source_size") * max_copies).cast("double")
    ranked = sizes.select("source", "source_size", w.alias("w"), limit.alias("limit"), total.alias("total"))
    fill = Window.orderBy(F.col("limit") / F.col("w"), "w", F.col("source").isNull(), "source")
    before, onward = fill.rowsBetween(Window.unboundedPreceding, -1), fill.rowsBetween(0, Window.unboundedFollowing)
    left = F.col("total") - F.coalesce(F.sum("limit").over(before), F.lit(0.0))
    level = left / F.sum("w").over(onward)
    opened = ranked.withColumn("level", level).withColumn("full", F.col("level") * F.col("w") > F.col("limit"))
    # The first source that is not full sets the level of all that follow.
    common = F.min(F.when(~F.col("full"), F.struct(F.col("limit") / F.col("w"), "level"))).over(Window.partitionBy())
    target = F.when(F.col("full"), F.col("limit")).otherwise(
        F.least(F.col("limit"), common["level"] * F.col("w"))
    )
    return opened.select("source", "source_size", target.alias("target"))


def _keyed(docs: DataFrame, *more: Column) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("long").alias("_id"), row_key().alias("_key"), F.col("source").alias("_source"),
        n_words(F.col("text")).alias("_size"), *more,
    )


def _salted(keyed: DataFrame) -> DataFrame:
    """Keyed rows with ``_salt``: 0, and for rows equal in doc_id, text and source their number among these.

    Only such rows are shuffled, by ranges of their whole order, so a hot one is cut into many.
    """
    same = ["_id", "_key", "_source"]
    named = [f"{c}_again" for c in same]
    again = keyed.groupBy(*same).agg(F.count("*").alias("n")).where("n > 1").select(*same)
    again = land(again.toDF(*named), "again")
    none = F.lit(0).cast("long").alias("_salt")
    if again.isEmpty():
        return keyed.select("*", none)
    equal = reduce(lambda a, b: a & b, (F.col(a).eqNullSafe(F.col(b)) for a, b in zip(same, named)))
    maybe = IdBitmap(F.struct(*named), again).has(F.struct(*same))
    some = keyed.where(maybe)
    numbered = positions(land(some.join(again, equal, "left_semi"), "repeated"), same, "_at", land_input=False)
    first = numbered.groupBy(*same).agg(F.min("_at").alias("_first")).toDF(*named, "_first")
    salted = numbered.join(first, equal).select(*keyed.columns, (F.col("_at") - F.col("_first")).alias("_salt"))
    rest = keyed.where(~maybe).unionByName(some.join(again, equal, "left_anti"))
    return rest.select("*", none).unionByName(salted)


def _drawn(rows: DataFrame, plan: DataFrame, seed: int) -> DataFrame:
    """``rows`` with their source's line of ``plan``, their rank and its two bins.

    The rank is Pareto's, odds of the draw over odds of inclusion, as a number in (0, 1).
    """
    draw = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), "_id", "_key", "_source", "_salt"), 11) + 0.5) / float(1 << 53)
    odds = draw / (1 - draw) * (1 - F.col("chance")) / F.col("chance")
    cell = F.col("_rank") * BINS
    return (
        rows.join(plan, rows["_source"].eqNullSafe(plan["source_of_plan"])).drop("source_of_plan")
        .withColumn("_rank", F.when((F.col("chance") > 0) & (F.col("_size") > 0), odds / (1 + odds)))
        .withColumn("_bin", F.floor(cell).cast("int"))
        .withColumn("_sub", F.floor((cell - F.floor(cell)) * BINS).cast("int"))
    )


def cut_points(
    docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share_pct: int = SHARE_PCT,
    max_copies: int = MAX_COPIES, seed: int = SEED,
) -> DataFrame:
    """One row per source: certain copies, and how far down its ranking the sample reaches.

    The cut is found by adding up words per bin of the rank, then per bin within the bin that
    holds the cut; only the rows in that small bin are ordered.
    """
    return _cut_points(_salted(land(_keyed(docs), "keyed")), weights, share_pct, max_copies, seed)


def _cut_points(
    rows: DataFrame, weights: tuple[float, ...] = WEIGHTS, share_pct: int = SHARE_PCT,
    max_copies: int = MAX_COPIES, seed: int = SEED,
) -> DataFrame:
    base = land(rows.select("_id", "_key", "_source", "_size", "_salt"), "mix")
    sizes = base.groupBy(F.col("_source").alias("source")).agg(F.sum("_size").alias("source_size"))
    goals = land(targets(sizes, weights, share_pct, max_copies), "targets")
    copies = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    whole = F.least(F.floor(copies), F.lit(max_copies)).cast("long")
    plan = goals.select(
        F.col("source").alias("source_of_plan"), "source_size", "target", whole.alias("whole"),
        (copies - whole).alias("chance"),
        F.round(F.col("target") - whole * F.col("source_size")).cast("long").alias("lack"),
    )
    drawn = _drawn(base, plan, seed).where("_bin is not null")
    first = _cut(drawn.groupBy("_source", "_bin").agg(F.sum("_size").alias("words"), F.max("lack").alias("lack")), "_bin")
    at_cut = _with(drawn, first).where(F.col("_bin") == F.col("cut_bin"))
    rest = F.col("lack") - F.col("words_before_bin")
    inner = at_cut.groupBy("_source", "_sub").agg(F.sum("_size").alias("words"), F.max(rest).alias("lack"))
    second = _cut(inner, "_sub")
    edge = _with(at_cut, second).where(F.col("_sub") == F.col("cut_sub"))
    here = F.struct(*PLACE)
    order = Window.partitionBy("_source").orderBy(*PLACE).rowsBetween(Window.unboundedPreceding, -1)
    edge = edge.select(
        "_source", "_size", here.alias("here"), (rest - F.col("words_before_sub")).alias("rest"),
        F.coalesce(F.sum("_size").over(order), F.lit(0)).alias("before"),
    )
    # A document is taken while that brings the words nearer to what the source lacks.
    near = edge.where(2 * F.col("before") + F.col("_size") <= 2 * F.col("rest"))
    last = near.groupBy("_source").agg(F.max("here").alias("last"))
    named = plan.withColumn("_source", F.col("source_of_plan"))
    for more in (first.drop("words_before_bin"), second.drop("words_before_sub"), last):
        named = _with(named, more, "left")
    return land(named.drop("_source"), "cuts")


def _copies(rows: DataFrame, cuts: DataFrame, seed: int) -> DataFrame:
    """All keyed rows with ``_copies``. The cuts have one row per source; Spark broadcasts them if small."""
    here = F.struct(*PLACE)
    chosen = (F.col("_bin") < F.col("cut_bin")) | (
        (F.col("_bin") == F.col("cut_bin"))
        & ((F.col("_sub") < F.col("cut_sub")) | ((F.col("_sub") == F.col("cut_sub")) & (here <= F.col("last"))))
    )
    extra = F.coalesce(chosen, F.lit(False)).cast("long")
    return _drawn(rows, cuts, seed).withColumn("_copies", F.col("whole") + extra)


def mix(
    docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share_pct: int = SHARE_PCT,
    max_copies: int = MAX_COPIES, seed: int = SEED,
) -> DataFrame:
    """doc_id, source, size, source_size, target, copies and taken words of every row.

    A row's draw is a hash of its doc_id, text and source, and for rows equal in all three of their
    number, so a rerun takes the same and repeated rows are drawn one by one. A null text has no words and is never
    needed to reach a target; the null source is a source. Extra columns are ignored. An empty
    table gives no rows.
    """
    rows = land(_salted(land(_keyed(docs), "keyed")), "salted")
    mixed = _copies(rows, _cut_points(rows, weights, share_pct, max_copies, seed), seed)
    return mixed.select(
        F.col("_id").alias("doc_id"), F.col("_source").alias("source"), F.col("_size").alias("size"), "source_size",
        "target", F.col("_copies").alias("copies"), (F.col("_copies") * F.col("_size")).alias("taken"),
    )


def mixed_documents(docs: DataFrame, seed: int = SEED, **options) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it.

    Nulls, ties and repeated rows are as for ``mix``. Columns may have any names; an empty
    table gives no rows.
    """
    rows = _salted(_keyed(docs, whole_row(docs).alias("_row")))
    mixed = _copies(rows, _cut_points(rows, seed=seed, **options), seed).where(F.col("_copies") > 0)
    return mixed.select("_row", F.explode(F.sequence(F.lit(1), F.col("_copies")))).select("_row.*")


def _with(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    return left.join(right, left["_source"].eqNullSafe(right["_source"]), how).drop(right["_source"])


def _cut(bins: DataFrame, name: str) -> DataFrame:
    """Per source the last bin that the lacking words reach into, and the words before it."""
    order = Window.partitionBy("_source").orderBy(name).rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("words").over(order), F.lit(0))
    reached = bins.withColumn("before", before).where(F.col("before") < F.col("lack"))
    last = reached.groupBy("_source").agg(F.max(F.struct(F.col(name), F.col("before"))).alias("m"))
    return last.select(
        "_source", F.col("m")[name].alias(f"cut{name}"), F.col("m")["before"].alias(f"words_before{name}")
    )

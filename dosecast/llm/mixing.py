"""Mixing sources to target weights by capped water-filling (operator 7).

Every source gets ``min(cap, level * weight)`` words: the level is raised
until the targets add up to the wanted total, so a source that would exceed
its cap (``max_epochs`` times its size) is clamped and its excess goes to the
others by weight.  Ordered by cap over weight, the clamped sources come first,
so the level follows from running sums over the sources.

A source's target over its size gives the repetitions: each document is taken
whole the whole number of times; for the fraction, documents are taken in the
order of a seeded hash until the fraction's words are reached, and the one
document at the cut is taken in part.  The cut is found in two steps so that a
large source is never one group: words by slice of the hash range first, then
the documents of the one slice that holds the cut.

DataFrame functions only.  Defined cases: a null text has size 0; a null
source is a source, last in order; rows are taken one by one (rows that agree
in all columns that matter share the words at the cut); sources of size 0 have
target 0; an empty table gives an empty result; other columns are passed
through (``mix``) or not read (``plan``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dosecast.llm.common import SPACE, WORD, need, sealed, unsealed
from dosecast.session import materialize

SLICES = 4096
HASH_BITS = 60
WEIGHTS = (3, 1, 2)


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def place(seed: int, doc_id: Column, text: Column) -> Column:
    """A document's place in its source's seeded order, 0 to 2^60."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.concat(F.lit("-"), F.coalesce(text, F.lit("")))))
    return F.conv(F.substring(F.md5(key), 1, HASH_BITS // 4), 16, 10).cast("long")


def sized(docs: DataFrame, seed: int) -> DataFrame:
    """``docs`` with ``_size`` and ``_place``."""
    return (docs.withColumn("_size", n_words(F.col("text")))
                .withColumn("_place", place(seed, F.col("doc_id"), F.col("text"))))


def source_targets(sizes: DataFrame, weights=WEIGHTS, share_percent: int = 150, max_epochs: int = 2) -> DataFrame:
    """source, source_size, weight, target.  ``sizes``: source, source_size (a row for each source).  The
    windows run over that table only."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    s = sizes.withColumn("weight", w).withColumn("cap", (max_epochs * F.col("source_size")).cast("double"))
    all_of = Window.partitionBy()
    # Sources in the order in which the rising level clamps them.
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    here_on = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    s = (s.withColumn("total", F.least(F.sum("source_size").over(all_of) * share_percent / 100.0, F.sum("cap").over(all_of)))
          .withColumn("level", (F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(here_on))
          .withColumn("free", F.col("level") * F.col("weight") <= F.col("cap")))
    # The level is that of the first source that stays under its cap; those computed after it are lower.
    level = F.max(F.when(F.col("free"), F.col("level"))).over(all_of)
    target = F.least(F.col("cap"), F.coalesce(level, F.lit(float("inf"))) * F.col("weight"))
    return s.select("source", "source_size", "weight", target.alias("target"))


def cuts(docs: DataFrame, targets: DataFrame) -> DataFrame:
    """source, source_size, target, whole (repetitions), cut (place), rest (words of the rows at the cut).
    ``docs``: source, _size, _place."""
    t = targets.select(
        "source", "source_size", "target",
        F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long").alias("whole"))
    t = t.withColumn("fraction", F.round(F.col("target") - F.col("whole") * F.col("source_size")).cast("long"))
    slice_of = F.shiftright(F.col("_place"), HASH_BITS - 12)
    slices = docs.groupBy("source", slice_of.alias("slice")).agg(F.sum("_size").alias("words"))
    up_to = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    s = (slices.withColumn("through", F.sum("words").over(up_to))
         .join(t.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s"))).drop("_s"))
    # The slice in which the fraction ends: through - words < fraction <= through.
    cut_slice = s.where((F.col("through") >= F.col("fraction")) & (F.col("through") - F.col("words") < F.col("fraction"))).select(
        F.col("source").alias("_s"), "slice", (F.col("fraction") - (F.col("through") - F.col("words"))).alias("need"))
    one = (docs.select("source", "_size", "_place").withColumn("slice", slice_of)
           .join(cut_slice.withColumnRenamed("slice", "_slice"),
                 F.col("source").eqNullSafe(F.col("_s")) & (F.col("slice") == F.col("_slice")))
           .groupBy("source", "need", "_place").agg(F.sum("_size").alias("words"), F.count(F.lit(1)).alias("rows")))
    run = Window.partitionBy("source").orderBy("_place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    hit = (one.withColumn("through", F.sum("words").over(run))
           .where((F.col("through") >= F.col("need")) & (F.col("through") - F.col("words") < F.col("need")))
           .select(F.col("source").alias("_s"), F.col("_place").alias("cut"),
                   F.floor((F.col("need") - (F.col("through") - F.col("words"))) / F.col("rows")).cast("long").alias("rest")))
    return t.join(hit, F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s", "fraction")


def plan(docs: DataFrame, seed: int = 7, **how) -> DataFrame:
    """The cuts of ``docs`` (doc_id, source, text), a row for each source, as a written table."""
    d = materialize(sized(need(docs, "doc_id", "source", "text"), seed).select("source", "_size", "_place"), "mix_sizes")
    sizes = d.groupBy("source").agg(F.sum("_size").alias("source_size"))
    return materialize(cuts(d, source_targets(sizes, **how)), "mix_cuts")


def with_plan(docs: DataFrame, cut_table: DataFrame, seed: int = 7) -> DataFrame:
    """``docs`` with ``_size``, ``_whole``, ``_part`` (words of the partial repetition), ``_target``, ``_source_size``."""
    c = cut_table.select(F.col("source").alias("_s"), F.col("source_size").alias("_source_size"), F.col("target").alias("_target"),
                         F.col("whole").alias("_whole"), F.col("cut").alias("_cut"), F.col("rest").alias("_rest"))
    part = (F.when(F.col("_cut").isNull(), 0).when(F.col("_place") < F.col("_cut"), F.col("_size"))
             .when(F.col("_place") == F.col("_cut"), F.least(F.col("_rest"), F.col("_size"))).otherwise(0)).cast("long")
    return (sized(docs, seed).join(c, F.col("source").eqNullSafe(F.col("_s")), "left")
            .withColumn("_part", part).drop("_s", "_cut", "_rest", "_place"))


def taken(docs: DataFrame, seed: int = 7, **how) -> DataFrame:
    """doc_id, size, source_size, target, taken."""
    d = need(docs, "doc_id", "source", "text")
    return with_plan(d, plan(d, seed, **how), seed).select(
        "doc_id", F.col("_size").alias("size"), F.col("_source_size").alias("source_size"), F.col("_target").alias("target"),
        (F.col("_whole") * F.col("_size") + F.col("_part")).alias("taken"))


def first_words(text: Column, k: Column) -> Column:
    """A text's beginning up to its ``k``-th word, white space as it was (all of it if it has no more words)."""
    from_word = F.regexp_replace(text, "^" + SPACE, "")
    rest = F.element_at(F.split(from_word, SPACE, (k + 1).cast("int")), -1)
    return F.when(n_words(text) <= k, text).otherwise(
        F.regexp_replace(F.substring(text, F.lit(1), F.length(text) - F.length(rest)), SPACE + "$", ""))


def mix(docs: DataFrame, seed: int = 7, **how) -> DataFrame:
    """The mix itself: every document as often as it is taken, a partial repetition cut after its words.
    Columns as in ``docs``; ``n_chars``, if there, is that of the new text.  Documents without words are not
    taken."""
    own = ("doc_id", "source", "text", "n_chars")
    p = with_plan(sealed(docs, *own), plan(docs, seed, **how), seed)
    copies = F.concat(F.array_repeat(F.col("_size"), F.col("_whole").cast("int")),
                      F.when(F.col("_part") > 0, F.array(F.col("_part"))).otherwise(F.array().cast("array<bigint>")))
    p = p.where(F.col("_size") > 0).withColumn("_take", F.explode(copies))
    cut = F.col("_take") < F.col("_size")
    p = p.withColumn("text", F.when(cut, first_words(F.col("text"), F.col("_take"))).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        p = p.withColumn("n_chars", F.when(cut, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return unsealed(p, docs, *own)

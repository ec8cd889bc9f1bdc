"""Mixing sources to target weights by Pareto order sampling, in SQL functions only.

Every document of a source is wanted ``target / source_size`` times. The whole part of that
number is given to each document as certain copies. The words left over are sampled with
unequal probabilities: p is a factor times the document's size, and 1 for those that would
come above it, the factor being such that the expected words are those left over. Documents
with p = 1 get one more certain copy. The others are ranked by random odds over inclusion odds,
``(u / (1 - u)) / (p / (1 - p))``, and the first ones are taken until the words are used up (the
sample is of fixed size in words). The last place goes to the document whose size comes nearest
to what is then missing.

Edge cases. Null texts have size 0; documents of size 0 get the whole copies alone. Null sources form one source, which sorts last. An empty
table gives an empty result. Rows that repeat (same id, source and text) share one random
number and are taken or left together. ``u`` is a hash of the row, so reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..workdir import materialized

# Fixed values of the task: word pattern, weights in the order of sources, most copies.
WORDS = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
MOST = 3
# Ranks are summed in so many steps, then exactly inside the one step that holds the cut.
STEPS = 65536


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("long")


def random_hash(doc_id: Column, source: Column, text: Column) -> Column:
    """52 bits that depend on the row alone."""
    parts = [F.coalesce(doc_id.cast("string"), F.lit("~")), F.coalesce(source, F.lit("~")), F.md5(F.coalesce(text, F.lit("")).cast("binary"))]
    return F.conv(F.substring(F.sha2(F.concat_ws("|", *parts), 256), 1, 13), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """Targets of sources (``source``, ``source_size``), one row a source.

    All sizes are shared out by weight. A source that would get more than ``most`` times its
    size stops there; its excess goes to the others by weight. Sorted by size over weight,
    those that stop come first, so one running sum settles all rounds of sharing.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights)))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn + 1).cast("int"))
    cap = (F.col("source_size") * most).cast("double")
    ordered = Window.orderBy((F.col("_cap") / F.col("_weight")).asc(), F.col("source").asc_nulls_last())
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    after = ordered.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing).orderBy(F.lit(1))
    share = (F.sum("source_size").over(everything) - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))) / F.sum("_weight").over(after)
    shared = sizes.withColumn("_weight", weight).withColumn("_cap", cap).withColumn("_share", share)
    # The share a unit of weight gets once all sources that stop have stopped.
    last = F.max(F.when(F.col("_cap") > F.col("_weight") * F.col("_share"), F.col("_share"))).over(everything)
    target = F.when(F.col("_cap") > F.col("_weight") * F.col("_share"), F.col("_weight") * F.col("_last")).otherwise(F.col("_cap"))
    return shared.withColumn("_last", last).select("source", "source_size", target.alias("target"))


def size_factors(counts: DataFrame, rests: DataFrame) -> DataFrame:
    """``_source``, ``_factor``, ``_most``: p is ``_factor * size`` up to size ``_most``, 1 beyond.

    ``counts`` has a row for each size of a source (``source, size, n``), ``rests`` the words
    left over (``_source, _rest``). From the largest size down, sizes stop being certain at the
    first whose factor, worked out with all above it certain, gives less than 1. Sums are exact.
    A window holds the distinct sizes of a source, fewer than the root of twice its words.
    """
    upto = Window.partitionBy("source").orderBy("size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    above = Window.partitionBy("source").orderBy("size").rowsBetween(1, Window.unboundedFollowing)
    words = F.coalesce(F.sum(F.col("n") * F.col("size")).over(above), F.lit(0)).cast("double")
    squares = F.sum(F.col("size").cast("decimal(20,0)") * F.col("size") * F.col("n")).over(upto).cast("double")
    sums = counts.select("source", "size", words.alias("_words"), squares.alias("_squares"))
    known = sums.join(rests, F.col("source").eqNullSafe(F.col("_source"))).withColumn("_factor", (F.col("_rest") - F.col("_words")) / F.col("_squares"))
    return known.where(F.col("_factor") * F.col("size") < 1).groupBy("_source").agg(F.max_by("_factor", "size").alias("_factor"), F.max("size").alias("_most"))


def mix_sources(docs: DataFrame, *, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, work_dir: str | None = None) -> DataFrame:
    """One row per document: ``doc_id, source, size, source_size, target, copies, taken, row_hash``.

    Sources are joined on plain equi keys with both sides shuffled for the join alone, so
    adaptive execution splits a source that holds a third of all rows. No window sees more
    than STEPS rows of a source, or the rows of one step.
    """
    rows = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), random_hash(F.col("doc_id"), F.col("source"), F.col("text")).alias("row_hash"))
    rows = materialized(rows, "mix-rows", work_dir)
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    plan = source_targets(sizes, weights, most)
    wanted = F.coalesce(F.try_divide(F.col("target"), F.col("source_size")), F.lit(0.0))
    plan = plan.withColumn("_whole", F.floor(wanted)).withColumn("_rest", F.col("target") - F.floor(wanted) * F.col("source_size"))
    plan = materialized(plan.withColumnRenamed("source", "_source"), "mix-targets", work_dir)
    factors = size_factors(rows.where("size > 0").groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")), plan.select("_source", "_rest").where("_rest > 0"))
    factors = factors.withColumnRenamed("_source", "_name")
    plan = plan.join(factors, F.col("_source").eqNullSafe(F.col("_name")), "left").drop("_name")
    plan = materialized(plan, "mix-plan", work_dir)

    def with_plan(df: DataFrame, other: DataFrame) -> DataFrame:
        return df.join(other, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")

    u = (F.col("row_hash") + F.lit(0.5)) / F.lit(float(1 << 52))
    p = F.col("_factor") * F.col("size")
    odds = (u / (1 - u)) / (p / (1 - p))
    # Certain ones have a step of their own before all others; their words are within the rest.
    certain = F.col("size") > F.coalesce("_most", F.lit(0))
    drawn = (F.col("_rest") > 0) & (F.col("size") > 0)
    ranked = with_plan(rows, plan).withColumn("_rank", F.when(drawn, F.when(certain, 0.0).otherwise(odds / (1 + odds))))
    ranked = ranked.withColumn("_step", F.when(drawn, F.when(certain, -1).otherwise(F.least(F.floor(F.col("_rank") * STEPS), F.lit(STEPS - 1)))))

    steps = ranked.where(F.col("_step").isNotNull()).groupBy("source", "_step").agg(F.sum("size").alias("_sum"), F.first("_rest").alias("_rest"))
    upto = Window.partitionBy("source").orderBy("_step").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    steps = steps.withColumn("_upto", F.sum("_sum").over(upto))
    # The first step that no longer fits; all before it are taken whole.
    cut = steps.where(F.col("_upto") > F.col("_rest")).groupBy(F.col("source").alias("_source")).agg(F.min("_step").alias("_cut"), F.min(F.col("_upto") - F.col("_sum")).alias("_before"))
    cut = materialized(cut, "mix-cut", work_dir)
    whole = ranked.join(cut, F.col("source").eqNullSafe(F.col("_source")), "left").drop("_source")
    whole = materialized(whole, "mix-ranked", work_dir)
    fits = F.col("_cut").isNull() | (F.col("_step") < F.col("_cut"))

    inside = whole.where(F.col("_step") == F.col("_cut")).groupBy("source", "row_hash").agg(F.sum("size").alias("_unit"), F.first("_rank").alias("_rank"), F.first("_before").alias("_before"), F.first("_rest").alias("_rest"))
    upto = Window.partitionBy("source").orderBy("_rank", "row_hash").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = inside.withColumn("_upto", F.col("_before") + F.sum("_unit").over(upto))
    inside = inside.select(F.col("source").alias("_source"), F.col("row_hash").alias("_hash"), "_unit", (F.col("_upto") <= F.col("_rest")).alias("_in"))
    inside = materialized(inside, "mix-inside", work_dir)
    same = F.col("source").eqNullSafe(F.col("_source"))
    marked = whole.join(inside.select("_source", "_hash", "_in"), same & (F.col("row_hash") == F.col("_hash")), "left").drop("_source", "_hash")
    marked = marked.withColumn("_extra", F.when(F.col("_step").isNull(), False).otherwise(fits | F.coalesce("_in", F.lit(False))))
    marked = materialized(marked.drop("_in"), "mix-marked", work_dir)

    # What is still missing, and the unit of rows left out that comes nearest to it.
    gap = marked.where(F.col("_step").isNotNull()).groupBy(F.col("source").alias("_source")).agg((F.first("_rest") - F.sum(F.when(F.col("_extra"), F.col("size")).otherwise(0))).alias("_gap"))
    left = marked.where(F.col("_step").isNotNull() & ~F.col("_extra")).groupBy("source", "row_hash").agg(F.sum("size").alias("_unit"), F.first("_rank").alias("_rank"))
    left = left.where(F.col("_unit") > 0).join(gap, same).drop("_source").where(F.abs(F.col("_gap") - F.col("_unit")) < F.col("_gap"))
    last = left.groupBy(F.col("source").alias("_source")).agg(F.min(F.struct(F.abs(F.col("_gap") - F.col("_unit")).alias("d"), F.col("_rank").alias("r"), F.col("row_hash").alias("h"))).alias("_last"))
    last = materialized(last.select("_source", F.col("_last.h").alias("_last")), "mix-last", work_dir)
    done = marked.join(last, same, "left").drop("_source")
    extra = F.col("_extra") | F.coalesce(F.col("row_hash") == F.col("_last"), F.lit(False))
    copies = (F.col("_whole") + F.when(extra, 1).otherwise(0)).cast("long")
    done = done.withColumn("copies", copies)
    return done.select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"), "row_hash")


SQL = r"""
WITH rows AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
    ('0x' || substr(sha256(concat_ws('|', coalesce(doc_id::VARCHAR, '~'), coalesce(source, '~'), md5(coalesce(text, '')))), 1, 13))::BIGINT AS h
  FROM documents),
sizes AS (SELECT source, sum(size)::BIGINT AS source_size FROM rows GROUP BY source),
weighed AS (
  SELECT *, [5.0, 2.0, 1.0][1 + (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3]::DOUBLE AS w,
    (3 * source_size)::DOUBLE AS cap FROM sizes),
shared AS (
  SELECT *, (sum(source_size) OVER ()::DOUBLE - coalesce(sum(cap) OVER (ORDER BY cap / w, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(w) OVER (ORDER BY cap / w, source ASC NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS share FROM weighed),
targets AS (
  SELECT source, source_size, CASE WHEN cap > w * share THEN w * max(CASE WHEN cap > w * share THEN share END) OVER () ELSE cap END AS target FROM shared),
plan AS (
  SELECT *, floor(coalesce(target / nullif(source_size, 0), 0)) AS whole,
    target - floor(coalesce(target / nullif(source_size, 0), 0)) * source_size AS rest FROM targets),
counts AS (SELECT source, size, count(*) AS n FROM rows WHERE size > 0 GROUP BY source, size),
sums AS (
  SELECT source, size, coalesce(sum(n * size) OVER (PARTITION BY source ORDER BY size ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), 0)::DOUBLE AS words,
    (sum(size::HUGEINT * size * n) OVER (PARTITION BY source ORDER BY size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))::DOUBLE AS squares FROM counts),
tried AS (
  SELECT s.source, s.size, (rest - words) / squares AS factor FROM sums s JOIN plan ON s.source IS NOT DISTINCT FROM plan.source WHERE rest > 0),
factors AS (SELECT source, arg_max(factor, size) AS factor, max(size) AS most FROM tried WHERE factor * size < 1 GROUP BY source),
odds AS (
  SELECT r.*, source_size, target, whole, rest, CASE WHEN rest > 0 AND size > 0 THEN CASE WHEN size > coalesce(most, 0) THEN 0
    ELSE (((h + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE) / (1 - (h + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE)) / ((factor * size) / (1 - factor * size)) END END AS o
  FROM rows r JOIN plan ON r.source IS NOT DISTINCT FROM plan.source LEFT JOIN factors ON r.source IS NOT DISTINCT FROM factors.source),
units AS (
  SELECT source, h, sum(size) AS unit, min(o) AS o, any_value(rest) AS rest FROM odds WHERE o IS NOT NULL GROUP BY source, h),
upto AS (SELECT *, sum(unit) OVER (PARTITION BY source ORDER BY o, h ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) <= rest AS fits FROM units),
gaps AS (SELECT *, rest - sum(CASE WHEN fits THEN unit ELSE 0 END) OVER (PARTITION BY source) AS gap FROM upto),
last AS (
  SELECT source, h FROM gaps WHERE NOT fits AND unit > 0 AND abs(gap - unit) < gap
  QUALIFY row_number() OVER (PARTITION BY source ORDER BY abs(gap - unit), o, h) = 1)
SELECT r.doc_id, r.size, r.source_size, r.target,
  ((r.whole + CASE WHEN u.fits OR last.h IS NOT NULL THEN 1 ELSE 0 END) * r.size)::BIGINT AS taken
FROM odds r LEFT JOIN upto u ON r.o IS NOT NULL AND r.source IS NOT DISTINCT FROM u.source AND r.h = u.h
LEFT JOIN last ON r.source IS NOT DISTINCT FROM last.source AND r.h = last.h
"""

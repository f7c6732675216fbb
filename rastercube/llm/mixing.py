"""Time-varying curriculum: sources mixed to target weights, documents placed on a training axis."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rastercube.llm.shared import BUCKETS, before, bucket_of, seeded

#: Words are maximal runs of bytes that are not ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: Sequence[int] = (1, 2, 3), cap: int = 3) -> DataFrame:
    """Targets of sources (source, source_size) by water filling.

    Sources by code point, null last, weigh ``weights`` in turn and share the sum of all
    sizes; no target exceeds cap * source_size, and what is cut off is shared again by weight
    until none is above. With sources in the order of cap * size / weight, a prefix of them
    is cut off; the others share what is left in proportion to their weight. One row a source.
    """
    one = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(int(x)) for x in weights]), ((F.row_number().over(one) - 1) % len(weights) + 1).cast("int")).cast("long")
    rows = sizes.withColumn("_w", w).withColumn("_limit", F.col("source_size") * cap)
    by_ratio = Window.orderBy((F.col("_limit") / F.col("_w")), F.col("source").asc_nulls_last())
    done = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    every = by_ratio.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rest = F.sum("source_size").over(every) - F.coalesce(F.sum("_limit").over(done), F.lit(0))
    left = F.sum("_w").over(every) - F.coalesce(F.sum("_w").over(done), F.lit(0))
    rows = rows.withColumn("_rest", rest).withColumn("_left", left)
    # the first source, in that order, whose share of the rest is within its limit ends the prefix
    fits = F.col("_rest") * F.col("_w") <= F.col("_limit") * F.col("_left")
    rows = rows.withColumn("_level", F.first(F.when(fits, F.struct("_rest", "_left")), ignorenulls=True).over(every)).withColumn("_cut", F.sum(F.when(fits, 1).otherwise(0)).over(by_ratio.rowsBetween(Window.unboundedPreceding, Window.currentRow)) == 0)
    share = (F.col("_level._rest") * F.col("_w")).cast("double") / F.col("_level._left").cast("double")
    return rows.select("source", "source_size", F.when(F.col("_cut"), F.col("_limit").cast("double")).otherwise(share).alias("target"))


def curriculum(docs: DataFrame, weights: Sequence[int] = (1, 2, 3), cap: int = 3, tilt: float = 0.5, seed: int = 11, carry: Sequence[str] = ()) -> DataFrame:
    """Which documents a mix takes, how often, and where on the training axis they stand.

    Each source's weight runs linearly over training time u in [0, 1]: its demand per time is
    target * (1 + s - 2*s*u), with s from -tilt to tilt in even steps over the sources'
    order, so early sources fade and late ones grow; the integral over all of it is the
    target. A source's documents, in a seeded order, form a stream that repeats; a copy of a
    document is taken if its middle word is within the target, so the words taken miss the
    target by half of one document at most, and none is taken more than cap times. The copy's position is the time at which the integrated demand reaches the
    words before it: the inverse of u * (1 + s) - s * u^2.

    Prefix sums are counted in hash buckets inside a source, so a hot source is spread over
    4096 of them. Returns one row a document: doc_id, source, size, source_size, target,
    taken (size * copies), positions (array of one double for each copy). Null texts and
    texts without words have size 0 and no copies; a null source is a source; repeated rows
    stay apart; of equal hashes doc_id, checksum and size decide; a very long text is one
    document, whose words are counted whole; an empty table gives no rows. Columns named in ``carry`` come along with their
    row; others are ignored.
    """
    carried = [F.col(c).alias(f"_carry{i}") for i, c in enumerate(carry)]
    rows = docs.select(*carried, "doc_id", "source", word_count(F.col("text")).alias("size"), F.crc32(F.coalesce(F.col("text").cast("binary"), F.lit(b""))).alias("_c"))
    sizes = rows.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    goal = targets(sizes, weights, cap)
    order = Window.orderBy(F.col("source").asc_nulls_last())
    n = F.count("*").over(Window.partitionBy())
    slope = F.lit(-tilt) + F.lit(2 * tilt) * (F.row_number().over(order) - 1) / F.greatest(n - 1, F.lit(1))
    goal = goal.select(F.col("source").alias("_s"), "source_size", "target", slope.alias("_slope"))
    rows = rows.withColumn("_h", seeded(seed, F.col("doc_id"))).withColumn("_b", bucket_of(F.col("_h")))
    rows = before(rows, ["source"], "_b", F.col("size"), [F.col("_h"), F.col("doc_id"), F.col("_c"), F.col("size")], "_before")
    rows = rows.join(goal, rows["source"].eqNullSafe(goal["_s"]))
    # copy e starts at e * source_size + _before words
    starts = F.expr(f"filter(transform(sequence(0, {cap - 1}), e -> (e * source_size + _before)), x -> size > 0 and 2 * x + size <= 2 * target)")
    share = "(x / target)"
    # u(1+s) - s u^2 = y, in a form that is stable for s near 0
    inverse = f"2 * {share} / ((1 + _slope) + sqrt(greatest(0D, (1 + _slope) * (1 + _slope) - 4 * _slope * {share})))"
    rows = rows.withColumn("_starts", starts)
    return rows.select("doc_id", "source", "size", "source_size", "target", (F.col("size") * F.size("_starts")).cast("long").alias("taken"), F.expr(f"transform(_starts, x -> {inverse})").alias("positions"), *[F.col(f"_carry{i}").alias(c) for i, c in enumerate(carry)])


def training_ranks(mix: DataFrame) -> DataFrame:
    """The copies of curriculum()'s rows, range-sorted by position: all its columns, copy, position and training_rank.

    training_rank counts the copies that come earlier, by (position, doc_id, copy); documents
    without copies keep one row with nulls. Positions are dealt into ranges of equal length,
    which hold about as many words each; a range is sorted by one task, and what comes before
    it is a running sum over one row a range.
    """
    copies = mix.select("*", F.posexplode_outer("positions").alias("copy", "position"))
    copies = copies.withColumn("_range", F.coalesce(F.floor(F.least(F.col("position"), F.lit(1.0)) * BUCKETS).cast("int"), F.lit(BUCKETS + 1)))
    # documents without copies come last, in as many ranges
    copies = copies.withColumn("_range", F.when(F.col("position").isNull(), F.col("_range") + F.pmod(F.xxhash64("doc_id"), F.lit(BUCKETS)).cast("int")).otherwise(F.col("_range")))
    ranked = before(copies, [], "_range", F.lit(1).cast("long"), [F.col("position"), F.col("doc_id"), F.col("copy")], "training_rank")
    return ranked.withColumn("training_rank", F.when(F.col("position").isNotNull(), F.col("training_rank"))).drop("_range")

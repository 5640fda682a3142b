"""Mixing sources to target weights along a time-varying curriculum, in DataFrame functions only.

Targets: the mix holds ``share`` times all words.  Sources share it by weight, none takes
more than ``most`` times its own size, and what is over goes to the others by weight.  In
closed form (water filling): with the sources in order of limit/weight, the first ones
are at their limit and the rest get one common level times their weight.

Taking: every document is taken ``floor(target / size of its source)`` times; the rest of
the target goes to the documents that come first in a pseudo-random order of their source
(md5 of the id), those whose middle word still lies within it.  So no document is taken
more than ``most`` times and a source misses its target by half a document at most.

Order: source s gets words at the rate w_s(t) at training time t in [0, 1], a
piecewise-linear schedule over ``knots``.  Its integral is the source's cumulative word
demand; a taken document starts where the demand reaches the words its source has
delivered before it.  Inverting the integral (a quadratic on each piece) gives the
document's position, and ``training_order`` range-sorts by it.  ``ordered`` stores that
order as a table, and ``folded`` reads it back to one row per document.

Scale: the running sums never need a source in one task.  Ids hash into ``BUCKETS``
ranges of md5; sums by (source, range) give each range its offset, and the window runs
within a range only.  Only tables with one row per source or per (source, range) pass
through small windows.

Defined results: a null source is a source of its own, last in order.  A null text or one
without words has size 0: it is never counted as taken.  Rows with equal ids are taken in
order of size; equal rows share their result.  An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

#: md5 starts with two hex digits of range and one more: 4096 ranges of each source.
RANGE_DIGITS = 3
WEIGHTS = (3.0, 1.0, 2.0)
SHARE, MOST = 1.5, 2
KNOTS = (0.0, 0.5, 1.0)
#: The rate at each knot, as a multiple of the source's mean rate, by the source's place in order:
#: falling, rising, and highest in the middle.  Each has the mean 1.
SCHEDULES = ((1.5, 1.0, 0.5), (0.5, 1.0, 1.5), (0.6, 1.4, 0.6))


def words_in(text: Column) -> Column:
    """Number of words of a text (runs of anything but ASCII white space); 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """(source, source_size, place, target) from (source, source_size); one row per source."""
    in_order, alone = Window.orderBy(F.asc_nulls_last("source")), Window.partitionBy(F.lit(0))
    place = F.row_number().over(in_order) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(place, F.lit(len(weights))) + 1).cast("int"))
    by_limit = Window.orderBy(F.col("limit") / F.col("weight"), "place")
    ahead = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    behind = by_limit.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    left = F.col("wanted") - F.coalesce(F.sum("limit").over(ahead), F.lit(0.0))
    level = left / F.sum("weight").over(behind)
    return (sizes.select("source", "source_size", place.alias("place"), weight.alias("weight"),
                         (F.lit(float(most)) * F.col("source_size")).alias("limit"),
                         (F.lit(share) * F.sum("source_size").over(alone)).alias("wanted"))
            .withColumn("level", level)
            .withColumn("free", F.col("level") * F.col("weight") <= F.col("limit"))
            # the first source below its limit sets the level of all that follow
            .withColumn("common", F.min(F.when(F.col("free"), F.struct(F.col("limit") / F.col("weight"), "place", "level"))).over(alone))
            .withColumn("target", F.when(F.col("free") | (F.struct(F.col("limit") / F.col("weight"), F.col("place")) >= F.struct(
                F.col("common.col1"), F.col("common.place"))), F.col("common.level") * F.col("weight")).otherwise(F.col("limit")))
            .select("source", "source_size", "place", "target"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights=WEIGHTS, share: float = SHARE, most: int = MOST, row_col: str | None = None) -> DataFrame:
    """(id, row, source, size, source_size, place, target, before, times, taken), one row per document.

    ``before``: words of the source ahead of the document in its order; ``times``: how often it is taken.
    Texts are read once, for their sizes, which are kept as a table of their own.  row: ``row_col``, else null."""
    order = F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary"))
    row = (F.col(row_col) if row_col else F.lit(None).cast("long")).alias("row")
    rows = stored(docs.select(F.col(id_col).alias("doc_id"), row, F.col(source_col).alias("source"),
                              words_in(F.col(text_col)).alias("size"), order.alias("order"),
                              F.substring(order, 1, RANGE_DIGITS).alias("range")), "mixing-sizes")
    by_range = rows.groupBy("source", "range").agg(F.sum("size").alias("range_size"))
    sized = targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, most)
    ranges = Window.partitionBy("source").orderBy("range")
    offsets = (by_range.withColumn("range_before", F.sum("range_size").over(ranges) - F.col("range_size"))
               .withColumnRenamed("source", "o_source").withColumnRenamed("range", "o_range").drop("range_size"))
    sized = sized.withColumnRenamed("source", "s_source")
    offsets = offsets.join(sized, F.col("o_source").eqNullSafe(F.col("s_source"))).drop("s_source")
    within = Window.partitionBy("source", "range").orderBy("order", "size", "row").rowsBetween(Window.unboundedPreceding, 0)
    placed = (rows.withColumn("upto", F.sum("size").over(within))
              .join(offsets, F.col("source").eqNullSafe(F.col("o_source")) & (F.col("range") == F.col("o_range")))
              .withColumn("before", F.col("range_before") + F.col("upto") - F.col("size")))
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    rest = F.col("target") - F.col("whole") * F.col("source_size")
    return (placed.withColumn("whole", whole.cast("long"))
            .withColumn("times", F.when(F.col("size") == 0, 0).otherwise(
                F.col("whole") + F.when(F.col("before") + F.col("size") / F.lit(2.0) <= rest, 1).otherwise(0)).cast("long"))
            .select(F.col("doc_id").alias(id_col), "row", "source", "size", "source_size", "place", "target", "before",
                    "times", (F.col("size") * F.col("times")).alias("taken")))


def position(delivered: Column, total: Column, place: Column, knots=KNOTS, schedules=SCHEDULES) -> Column:
    """Training time in [0, 1] at which a source's demand, ``total`` over the whole run, reaches ``delivered`` words."""
    part = F.when(total > 0, F.least(F.greatest(delivered / total, F.lit(0.0)), F.lit(1.0))).otherwise(F.lit(0.0))
    out = F.lit(float(knots[-1]))
    for s, rates in enumerate(schedules):
        area = sum((rates[i] + rates[i + 1]) / 2 * (knots[i + 1] - knots[i]) for i in range(len(knots) - 1))
        mine, start = F.lit(float(knots[-1])), 0.0
        pieces = []
        for i in range(len(knots) - 1):
            a, b, width = rates[i] / area, rates[i + 1] / area, knots[i + 1] - knots[i]
            end = start + (a + b) / 2 * width
            pieces.append((start, end, a, (b - a) / width, knots[i]))
            start = end
        for p_start, p_end, a, slope, at in reversed(pieces):  # part = p_start + a x + slope x^2 / 2
            need = F.greatest(part - F.lit(p_start), F.lit(0.0))
            x = need / F.lit(a) if slope == 0 else F.lit(2.0) * need / (
                F.lit(a) + F.sqrt(F.greatest(F.lit(a * a) + F.lit(2 * slope) * need, F.lit(0.0))))
            mine = F.when(part <= F.lit(p_end), F.lit(at) + x).otherwise(mine)
        out = F.when(F.pmod(place, F.lit(len(schedules))) == s, mine).otherwise(out)
    return out


def taken_copies(mixed: DataFrame, knots=KNOTS, schedules=SCHEDULES) -> DataFrame:
    """One row per taken copy of a document, with ``copy`` and ``position``.

    The passes of a source follow one another: copy c starts ``c`` source sizes later."""
    copies = mixed.where(F.col("times") > 0).withColumn("copy", F.explode(F.sequence(F.lit(0), (F.col("times") - 1).cast("int"))))
    delivered = F.col("before") + F.col("copy") * F.col("source_size")
    return copies.withColumn("position", position(delivered.cast("double"), F.col("target"), F.col("place"), knots, schedules))


def training_order(mixed: DataFrame, knots=KNOTS, schedules=SCHEDULES) -> DataFrame:
    """``taken_copies``, range-sorted by position."""
    return taken_copies(mixed, knots, schedules).orderBy("position", "place", "before", "copy")


def ordered(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> tuple[DataFrame, DataFrame]:
    """(``mix`` of the documents, with ``row``; its ``training_order``, stored: one row per taken copy, files in order)."""
    numbered = docs.select(id_col, text_col, source_col, F.monotonically_increasing_id().alias("mixing_row"))
    mixed = mix(numbered, id_col, text_col, source_col, row_col="mixing_row")
    return mixed, stored(training_order(mixed).select(id_col, "row", "source", "size", "copy", "position"), "mixing-order")


def folded(mixed: DataFrame, order: DataFrame) -> DataFrame:
    """``mixed`` with ``taken`` (words) and ``positions`` (ascending) of the copies in a stored order; one row per document."""
    copies = order.groupBy("row").agg(F.sum("size").alias("taken"), F.array_sort(F.collect_list("position")).alias("positions"))
    return (mixed.drop("taken").join(copies, "row", "left").withColumn("taken", F.coalesce("taken", F.lit(0)).cast("long"))
            .withColumn("positions", F.coalesce("positions", F.array().cast("array<double>"))))

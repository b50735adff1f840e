"""Mixing sources to target weights by capped water-filling.

The sources share the total size by weight; one whose share exceeds `epochs`
times its own size is clamped there and the excess goes to the others by weight
until none is above.  Repeated clamping clamps sources in the order of
cap / weight, so the fixed point is found from one sorted pass over the
source table: the shortest prefix of that order after which every other
source's share fits.

A source's documents are then taken floor(target / size) whole times, and the
fractional rest goes to the documents that come first in a seeded order, up to
the document whose middle passes the wanted size.  That document is found by
two rounds of histograms over the order's leading bits, so no source, however
hot, is sorted in one task; only the documents of one of 2^24 cells are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stage

WORD = r"[^\x20\x09-\x0D]+"          # fixed: what counts as a word
CELL_BITS = 12                       # bits of the order that each histogram round resolves
BROADCAST_SOURCES = 100_000          # source tables up to this many rows may be broadcast


def word_count(text: str | Column) -> Column:
    """Words of a text; null: 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def place(id_col: str, seed: int) -> Column:
    """Position of a row in the seeded order: 60 bits of the id's MD5."""
    key = F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("null")), F.lit(f":{seed}"))
    return F.conv(F.substring(F.md5(key), 1, 15), 16, 10).cast("long")


def water_fill(sizes: DataFrame, weights: list[int], epochs: int, source: str = "source") -> DataFrame:
    """`sizes` (source, source_size, ...) with `weight` and `target` per source.

    Weights repeat over the sources in code point order, null last.
    """
    by_name = Window.orderBy(F.col(source).asc_nulls_last())
    turn = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights)))
    s = sizes.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (turn + 1).cast("int")).cast("long"))
    s = s.withColumn("__cap", F.col("source_size") * epochs)
    order = Window.orderBy(F.col("__cap") / F.col("weight"), F.col(source).asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(0, Window.unboundedFollowing)
    # this source's share if all before it in the order are clamped
    s = s.withColumn("__left", F.sum("source_size").over(Window.partitionBy())
                     - F.coalesce(F.sum("__cap").over(before), F.lit(0)))
    s = s.withColumn("__weights", F.sum("weight").over(onward))
    s = s.withColumn("__fits", F.col("weight") * F.col("__left") <= F.col("__cap") * F.col("__weights"))
    s = s.withColumn("__first", F.first(F.when(F.col("__fits"), F.struct("__left", "__weights")), ignorenulls=True)
                     .over(order.rowsBetween(Window.unboundedPreceding, 0)))
    share = F.col("weight") * F.col("__first.__left").cast("double") / F.col("__first.__weights")
    return s.withColumn("target", F.when(F.col("__first").isNull(), F.col("__cap").cast("double")).otherwise(share)) \
            .drop("__cap", "__left", "__weights", "__fits", "__first")


def _small(per_source: DataFrame) -> DataFrame:
    """One row per source: broadcast while that is a proven small table."""
    return F.broadcast(per_source) if per_source.count() <= BROADCAST_SOURCES else per_source


def _keyed(docs: DataFrame, seed: int, id_col: str, source: str) -> DataFrame:
    """`__h`: place in the order.  `__k`: the source as a join key that null has
    too (quoted, so that a source named 'null' stays apart)."""
    return (docs.withColumn("__h", place(id_col, seed))
            .withColumn("__k", F.coalesce(F.concat(F.lit("'"), F.col(source).cast("string")), F.lit("null"))))


def _crossing(docs: DataFrame, per: DataFrame, level: int) -> DataFrame:
    """Narrow each source's crossing cell by CELL_BITS more bits of the order.

    `per` (__k, want, start, prefix): the wanted size, the size before the cell,
    the cell so far.  A source whose wanted size lies past its last document
    has no crossing cell."""
    shift = 60 - CELL_BITS * level
    inside = docs.join(_small(per), "__k").where(F.shiftright("__h", shift + CELL_BITS) == F.col("prefix"))
    hist = inside.groupBy("__k", "want", "start", F.shiftright("__h", shift).alias("cell")) \
                 .agg(F.sum("size").alias("in_cell"))
    hist = hist.withColumn("end", F.col("start") + F.sum("in_cell").over(Window.partitionBy("__k").orderBy("cell")))
    first = F.min_by(F.struct("want", (F.col("end") - F.col("in_cell")).alias("start"),
                              F.col("cell").alias("prefix")), "cell")
    return hist.where("end > want").groupBy("__k").agg(first.alias("s")).select("__k", "s.*")


def fit(docs: DataFrame, weights: list[int], epochs: int, seed: int, id_col: str = "doc_id",
        source: str = "source", size: str = "size") -> DataFrame:
    """One row per source: its size, target, whole repetitions, and the last
    place (and id) that the fractional rest reaches."""
    docs = stage(_keyed(docs.select(id_col, source, F.coalesce(size, F.lit(0)).cast("long").alias("size")),
                        seed, id_col, source), "mix-docs")
    sizes = docs.groupBy("__k", source).agg(F.sum("size").alias("source_size"))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    fill = stage(water_fill(sizes, weights, epochs, source)
                 .withColumn("whole", F.floor(rate))
                 .withColumn("want", (rate - F.floor(rate)) * F.col("source_size")), "mix-sources")
    per = fill.where("want > 0").select("__k", "want", F.lit(0).cast("long").alias("start"),
                                        F.lit(0).cast("long").alias("prefix"))
    for level in (1, 2):
        per = stage(_crossing(docs, per, level), "mix-cells")
    # the last cell's documents; rows that share an id share a place
    last = docs.join(_small(per), "__k").where(F.shiftright("__h", 60 - 2 * CELL_BITS) == F.col("prefix")) \
               .groupBy("__k", "want", "start", "__h", F.col(id_col).alias("__id")).agg(F.sum("size").alias("size"))
    ahead = Window.partitionBy("__k").orderBy("__h", F.col("__id").asc_nulls_first()) \
                  .rowsBetween(Window.unboundedPreceding, -1)
    middle = F.col("start") + F.coalesce(F.sum("size").over(ahead), F.lit(0)) + F.col("size") / 2
    # every source with a crossing cell has a row here: `reach` is null if even its first document is too much
    reach = last.withColumn("fits", middle <= F.col("want")).groupBy("__k").agg(
        F.max(F.when(F.col("fits"), F.struct("__h", F.col("__id").isNotNull().alias("named"), "__id"))).alias("reach"),
        F.min("__h").alias("first_h"))
    return stage(fill.join(reach, "__k", "left"), "mix-fill")


def apply(docs: DataFrame, fitted: DataFrame, seed: int, id_col: str = "doc_id",
          source: str = "source", size: str = "size") -> DataFrame:
    """`docs` with source_size, target, copies and taken (= size * copies).

    copies = whole repetitions + 1 for the documents that the rest reaches."""
    d = _keyed(docs, seed, id_col, source)
    d = d.join(_small(fitted.select("__k", "source_size", "target", "whole", "want", "reach", "first_h")), "__k")
    here = F.struct("__h", F.col(id_col).isNotNull().alias("named"), F.col(id_col).alias("__id"))
    extra = (F.when(F.col("want") <= 0, False)
             .when(F.col("first_h").isNull(), True)                   # no crossing cell: the rest reaches all
             .when(F.col("reach").isNull(), F.col("__h") < F.col("first_h"))
             .otherwise(here <= F.col("reach")))
    copies = (F.col("whole") + extra.cast("long")).cast("long")
    return (d.withColumn("copies", copies)
            .withColumn("taken", F.coalesce(size, F.lit(0)).cast("long") * F.col("copies"))
            .drop("__k", "__h", "whole", "want", "reach", "first_h"))


def mix(docs: DataFrame, weights: list[int], epochs: int, seed: int, id_col: str = "doc_id",
        source: str = "source", text: str = "text") -> DataFrame:
    """The mixed corpus: each row of `docs` as often as the mix takes it.

    Null sources form one source, last in order; null texts have size 0; rows
    that share an id are taken alike; a source without words gets target 0 and
    none of its rows are taken; an empty table gives no rows; all columns are
    carried along, columns named like the working ones are replaced.
    """
    sized = docs.withColumn("__size", word_count(text))
    fitted = fit(sized.select(id_col, source, F.col("__size").alias("size")), weights, epochs, seed, id_col, source)
    taken = apply(sized.select(F.struct(*docs.columns).alias("__row"), F.col(id_col), F.col(source),
                               F.col("__size").alias("size")), fitted, seed, id_col, source)
    return (taken.where("copies > 0").withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
            .select("__row.*"))

"""Mixing sources to target weights by systematic sampling, in DataFrame operations only.

Sources in code-point order (null last) get the weights 3, 1, 2, repeating, and share ``share`` times all words; a
target stops at ``most`` times the words of its source, and the excess is shared again by weight until none is above.
Of a source with the rate r = target / words, each document is expected r times. Documents are numbered within their
source by (words, a hash cell, doc_id); the prefix sum of expected copies is then number * r, and with one offset u in
[0, 1) per source a document is emitted once per integer in ((number - 1) * r + u, number * r + u]. No document is
emitted more than ceil(r) times, and because sizes rise along the numbering, the words taken differ from the
target by about one longest document at most.

Numbers come from counts: a source is ordered by its distinct sizes, a size by 256 hash cells, and only the
rows of one (source, size, cell) are sorted together, so a source that holds a third of all rows is not one group.
The one window without a key runs over one row per source.

Defined results: null text has size 0 and is taken 0 times its words; the null source is a source of its own; rows that
repeat doc_id, source and size are separate documents; without words all targets are 0; reruns agree, since the
offset derives from ``seed`` and the source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airpanel.llm.batches import stored, text_or_empty, unused

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
CELL_DIGITS = 2  # hex digits of a hash: 256 cells for each size of a source


def n_words(name: str = "text") -> Column:
    return F.regexp_count(text_or_empty(name), F.lit(WORD)).cast("long")


def _hex(text: Column, digits: int) -> Column:
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, digits), 16, 10).cast("long")


def source_targets(sized: DataFrame, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """(source, source_size, target, rate) of each source; ``sized`` has source and size."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), ((F.row_number().over(order) - 1) % len(WEIGHTS) + 1).cast("int"))
    ratio = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = ratio.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(F.lit(1))
    sources = (sized.groupBy("source").agg(F.sum("size").alias("source_size"))
               .withColumn("weight", weight).withColumn("cap", F.col("source_size") * F.lit(most))
               .withColumn("all_words", F.sum("source_size").over(everything) * F.lit(share))
               .withColumn("all_weight", F.sum("weight").over(everything)))
    # In order of cap per weight, a source is full if the level that is left for it and the later ones reaches its cap.
    left = F.col("all_words") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    open_weight = F.col("all_weight") - F.coalesce(F.sum("weight").over(before), F.lit(0))
    full = sources.withColumn("full", left * F.col("weight") >= open_weight * F.col("cap"))
    capped = F.sum(F.when(F.col("full"), F.col("cap")).otherwise(0.0)).over(everything)
    level_weight = F.sum(F.when(F.col("full"), 0).otherwise(F.col("weight"))).over(everything)
    target = F.when(F.col("full"), F.col("cap")).otherwise(F.col("weight") * (F.col("all_words") - capped) / level_weight)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    return full.withColumn("target", target).select("source", "source_size", "target", rate.alias("rate"))


def mixed(docs: DataFrame, seed: str = "mix", share: float = 1.5, most: float = 2.0) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies) per row of ``docs``."""
    sized = stored(docs.select("doc_id", F.col("source").cast("string").alias("source"), n_words().alias("size")), "mix-sizes")
    cell = _hex(F.concat(F.lit("c"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), CELL_DIGITS)
    # A struct compares equal with its nulls, so the null source joins like any other.
    rows = sized.withColumn("place", F.struct(F.struct("source").alias("s"), "size", cell.alias("cell")))
    rows = rows.withColumn("nth", F.row_number().over(Window.partitionBy("place").orderBy("doc_id")))
    cells = sized.groupBy(F.struct(F.struct("source").alias("s"), "size", cell.alias("cell")).alias("place")).agg(
        F.count(F.lit(1)).alias("n"))
    sizes = cells.groupBy(F.col("place.s").alias("s"), F.col("place.size").alias("size")).agg(F.sum("n").alias("n"))
    upto = Window.unboundedPreceding, -1
    smaller = sizes.select("s", "size", F.coalesce(F.sum("n").over(
        Window.partitionBy("s").orderBy("size").rowsBetween(*upto)), F.lit(0)).alias("smaller"))
    in_size = cells.select("place", F.coalesce(F.sum("n").over(
        Window.partitionBy("place.s", "place.size").orderBy("place.cell").rowsBetween(*upto)), F.lit(0)).alias("earlier"))
    targets = source_targets(sized, share, most).withColumn("s", F.struct("source")).drop("source")
    offset = _hex(F.concat(F.lit(seed), F.when(F.col("s.source").isNull(), "n").otherwise("s"),
                           F.coalesce(F.col("s.source"), F.lit(""))), 8) / F.lit(4294967296.0)
    cells_at = (in_size.withColumn("s", F.col("place.s")).withColumn("size", F.col("place.size"))
                .join(smaller, ["s", "size"]).join(targets, "s")
                .select("place", (F.col("smaller") + F.col("earlier")).alias("base"), "source_size", "target", "rate",
                        offset.alias("offset")))
    number = F.col("base") + F.col("nth")
    crossed = F.floor(number * F.col("rate") + F.col("offset")) - F.floor((number - 1) * F.col("rate") + F.col("offset"))
    return rows.join(cells_at, "place").select(
        "doc_id", "source", "size", "source_size", "target", crossed.cast("long").alias("copies"))


def mix_sources(docs: DataFrame, seed: str = "mix", share: float = 1.5, most: float = 2.0) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it; all columns as they are."""
    own_key, copies, nth, again = unused(docs, "own_key", "copies", "nth", "again")
    key = F.struct(F.col("doc_id").alias("a"), F.col("source").alias("b"), F.col("size").alias("c"))
    plan = (mixed(docs, seed, share, most).groupBy(key.alias(own_key))
            .agg(F.sort_array(F.collect_list("copies")).alias(copies)))  # one entry but for rows with the same id
    own = F.struct(F.col("doc_id").alias("a"), F.col("source").cast("string").alias("b"), n_words().alias("c"))
    same = Window.partitionBy(own_key).orderBy(own_key)
    times = F.array_repeat(F.lit(0), F.element_at(copies, F.col(nth)).cast("int"))
    return (docs.withColumn(own_key, own).join(plan, own_key).withColumn(nth, F.row_number().over(same))
            .withColumn(again, F.explode(times)).select(*docs.columns))

"""Mixing sources to target weights along a time-varying curriculum, in DataFrame operations only.

Every source has a share of the training words and a weight that changes over the run. The integral of the
weight over training time is the source's share; its inverse turns a place in the source's own stream of words
into a training position between 0 and 1. Documents repeat or are left out so that the words taken from a source
come within half a document of its target. Documents are then range-sorted by position.

Defined cases: a null text has no words; null is a source of its own, sorted last; a document without words is
taken with none; repeated rows are documents of their own; an empty table gives an empty mix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from silverline.llm.common import checkpointed, running_total, split_count

WEIGHTS = (1, 2, 3)  # by rank of the source, repeating
SLOPES = (-0.5, 0.0, 0.5)  # how the weight changes from start to end: w(t) = w * (1 + slope * (2t - 1))
MAX_REPEATS = 3


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MAX_REPEATS) -> DataFrame:
    """Targets of sources ``(source, source_size)``: shares by weight, each at most ``most`` times the source's size.

    Sharing the excess again by weight ends at one level L with ``target = min(most * size, L * weight)``. Sources
    in order of ``most * size / weight`` reach their limit one after another; L is where the first stays below its own.
    One row per source is held in one task, none per document.
    """
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (rank % len(weights) + 1).cast("int"))
    ranked = sizes.select("source", "source_size", rank.alias("rank"), weight.cast("long").alias("weight"))
    limited = ranked.withColumn("limit", F.col("source_size") * most)
    by_limit = Window.orderBy(F.col("limit") / F.col("weight"), "rank").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    levels = limited.withColumns(
        {
            "level": (F.sum("source_size").over(everything) - F.coalesce(F.sum("limit").over(by_limit), F.lit(0)))
            / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(by_limit), F.lit(0))),
        }
    )
    fits = F.when(F.col("limit") >= F.col("level") * F.col("weight"), F.struct(F.col("limit") / F.col("weight"), "rank", "level"))
    level = F.min(fits).over(everything)["level"]
    share = F.coalesce(level, F.lit(float("inf"))) * F.col("weight")
    target = F.least(F.col("limit").cast("double"), share)
    total = F.coalesce(F.sum("source_size").over(everything), F.lit(0))
    return levels.select("source", "source_size", "rank", "weight", target.alias("target"), total.alias("total"))


def mix_plan(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Each document with its size, source's size and target, copies, words taken, and place in the source's stream.

    ``keep`` names columns of the input to carry along. The order of a source is that of the MD5 of the document id,
    so it does not depend on how the table is stored, and a source with a third of all rows is split into many buckets.
    Without other columns to carry, words are counted once and the sizes kept; else they are counted in each of three
    readings of the input, which is less than writing its texts once more.
    """
    narrow_only = keep is None
    keep = ["doc_id"] if keep is None else keep
    kept = [F.col(c).alias(f"__keep_{i}") for i, c in enumerate(keep)]
    sized = docs.select(
        *kept, F.col("doc_id").alias("__id"), F.col("source").alias("__source"), word_count(F.col("text")).alias("size")
    ).withColumn("__key", F.md5(F.coalesce(F.col("__id").cast("string"), F.lit(""))))
    if narrow_only:
        sized = checkpointed(sized)
        narrow, rows = sized.select(F.col("__source").alias("source"), "size"), sized.count()
    else:
        narrow, rows = docs.select("source", word_count(F.col("text")).alias("size")), docs.count()
    targets = source_targets(narrow.groupBy("source").agg(F.sum("size").alias("source_size")))
    buckets = split_count(rows)
    spread = F.conv(F.substring("__key", 1, 8), 16, 10).cast("long")
    bucket = F.floor(spread * buckets / F.lit(2**32)).cast("int")
    order = [F.col("__key"), F.col("__id"), F.col("size")]
    placed = running_total(sized, ["__source"], bucket, order, F.col("size"), "before")
    joined = placed.join(F.broadcast(targets), F.col("__source").eqNullSafe(F.col("source")))  # one row per source
    rounds = F.ceil((F.col("target") - F.col("before") - F.col("size") / 2) / F.col("source_size"))
    copies = F.when(F.col("source_size") > 0, F.greatest(rounds, F.lit(0))).otherwise(F.lit(0)).cast("int")
    return joined.select(
        *[F.col(f"__keep_{i}") for i in range(len(keep))],
        "size", "source_size", "target", "total", "rank", "before", copies.alias("copies"),
        (copies.cast("long") * F.col("size")).alias("taken"),
    )


def position(copy: Column) -> Column:
    """Training position of a copy (0, 1, …): where the integral of the source's weight reaches its place in the stream."""
    reached = (F.col("before") + copy * F.col("source_size") + F.col("size") / 2) / F.col("target")
    slope = F.element_at(F.array(*[F.lit(s) for s in SLOPES]), (F.col("rank") % len(SLOPES) + 1).cast("int"))
    # slope * t^2 + (1 - slope) * t = reached, solved without cancellation
    root = F.sqrt(F.greatest((1 - slope) * (1 - slope) + 4 * slope * reached, F.lit(0.0)))
    return 2 * reached / ((1 - slope) + root)


def mix_sources(docs: DataFrame) -> DataFrame:
    """The result per document, range-sorted by position: sizes, target, words taken, copies and the position of each copy.

    ``word_positions`` are the positions on the scale of all words of the table, in whole words. Documents that are left out have no position and stand last, in the order of their sources' streams.
    """
    plan = mix_plan(docs)
    taken = F.col("copies") > 0
    positions = F.when(taken, F.transform(F.sequence(F.lit(0), F.col("copies") - 1), position)).otherwise(F.array().cast("array<double>"))
    in_words = F.transform(positions, lambda p: F.floor(p * F.col("total")))
    placed = plan.withColumns({"positions": positions, "word_positions": in_words, "first_position": F.when(taken, position(F.lit(0)))})
    order = [F.col("first_position").asc_nulls_last(), "before", "__keep_0"]  # those left out go to many partitions too
    ordered = placed.repartitionByRange(*order).sortWithinPartitions(*order)
    columns = ["size", "source_size", "target", "taken", "copies", "first_position", "positions", "word_positions"]
    return ordered.select(F.col("__keep_0").alias("doc_id"), *columns)


def training_order(docs: DataFrame) -> DataFrame:
    """The documents of the mix with all their columns, one row per copy, range-sorted by training position."""
    plan = mix_plan(docs, keep=docs.columns)
    copies = plan.where("copies > 0").withColumn("__copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
    placed = copies.withColumn("__position", position(F.col("__copy")))
    kept = [F.col(f"__keep_{i}").alias(c) for i, c in enumerate(docs.columns)]
    return placed.repartitionByRange("__position").sortWithinPartitions("__position").select(*kept)

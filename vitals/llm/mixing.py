"""Mixing sources to target weights along a curriculum that changes over training.

Each source has a weight schedule: its weight at every moment of training, linear from ``start`` to
``end``. The integral of the schedule is the source's weight. Weights share ``budget`` times the words
of all documents; a source takes ``max_repeats`` times its own words at most, and what it cannot take is
shared by weight among the others until none is above.

Within its source a document has a place by a hash of its key and text. Its words lie on a line of one pass over
the source after the other; a copy of the document is taken when its middle lies before the target.
A taken copy's training position is found by inverting the source's cumulative demand for words
(the integral of its schedule, scaled to the target) at the copy's middle. Results are sorted by range of
the first position.

A null text counts as empty: size 0, nothing taken, no position. Null is a source of its own, last in
order. A null key counts as empty in the place; rows that repeat key and text follow one another in
any order, as they are alike. Where all sizes are 0, all targets are 0. An empty table gives an empty
result. Only the named columns are read.

Everything is DataFrame operations. Running sums are taken in two levels, so a source with a third of all
rows is cut into ``SLICES`` windows; sizes are summed per slice before they meet. The table of sources
has one row per source and is the one thing ordered in a single task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, digested, one_of_each, row_digest, stored

SLICES = 4096
POSITION = "training_position"
#: Weight, and its schedule's start and end, of the sources in order, repeating.
CYCLE = ((3.0, 4.0, 2.0), (1.0, 0.5, 1.5), (2.0, 2.0, 2.0))


def size_in_words(text: str | Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def targets(sizes: DataFrame, cycle=CYCLE, budget: float = 1.5, max_repeats: float = 2.0) -> DataFrame:
    """(source, source_size, weight, start, end, target) from (source, source_size), one row per source.

    With the level L that makes min(max_repeats * size, L * weight) add up to the budget, resharing ends.
    Sources reach their limits in the order of limit over weight, so L follows from running sums.
    """
    everything = Window.orderBy(F.col("source").isNull(), "source")
    pick = lambda i: F.element_at(F.array(*[F.lit(c[i]) for c in cycle]), F.col("turn"))
    ranked = sizes.select(
        "source", "source_size", (F.pmod(F.row_number().over(everything) - 1, F.lit(len(cycle))) + 1).alias("turn")
    ).select(
        "source", "source_size", pick(0).alias("weight"), pick(1).alias("start"), pick(2).alias("end"),
        (max_repeats * F.col("source_size")).alias("most"),
    )
    order = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").isNull(), "source")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.partitionBy()
    levelled = ranked.withColumn(
        "level",
        (budget * F.sum("source_size").over(whole) - F.coalesce(F.sum("most").over(before), F.lit(0.0)))
        / F.sum("weight").over(after),
    )
    # The first source, in that order, that the level does not fill sets the level of all.
    is_open = F.col("level") * F.col("weight") <= F.col("most")
    opened = F.struct(F.col("most") / F.col("weight"), F.col("source").isNull(), "source", "level")
    open_level = F.min(F.when(is_open, opened)).over(whole)["level"]
    return levelled.select(
        "source", "source_size", "weight", "start", "end",
        F.coalesce(F.least("most", open_level * F.col("weight")), F.col("most")).alias("target"),
    )


def _moment(demand: Column, start: Column, end: Column) -> Column:
    """When the share ``demand`` of a source's words has been asked for: the inverse of the integral.

    The integral of start + (end - start) t is start t + (end - start) t^2 / 2; its whole is the mean.
    """
    bend, wanted = (end - start) / 2, demand * (start + end) / 2
    return F.when(bend == 0, demand).otherwise(
        (F.sqrt(F.greatest(start * start + 4 * bend * wanted, F.lit(0.0))) - start) / (2 * bend)
    )


def mix(
    documents: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
    cycle=CYCLE, budget: float = 1.5, max_repeats: int = 2, row: Column | None = None,
) -> DataFrame:
    """Per row: key, size, source_size, target, taken, positions (one per taken copy), in order of position.

    Where ``row`` is given, it is a last column, and the order of rows that share a key.
    """
    marked = [] if row is None else ["row"]
    # With the text in it, rows without key or of one repeated key have places of their own.
    place = F.md5(F.concat(F.coalesce(F.col(key).cast("string"), F.lit("")), F.lit(":"), F.coalesce(F.col(text), F.lit(""))))
    sized = stored(
        documents.select(
            F.col(key).alias("id"), F.col(source).alias("source"), size_in_words(text).alias("size"), place.alias("place"),
            *([] if row is None else [row.alias("row")]),
        ).withColumn("slice", F.conv(F.substring("place", 1, 3), 16, 10).cast("int")),
        "mixing-sizes",
    )
    slices = stored(sized.groupBy("source", "slice").agg(F.sum("size").alias("slice_size")), "mixing-slices")
    earlier = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    begun = slices.withColumn("begin", F.coalesce(F.sum("slice_size").over(earlier), F.lit(0)))
    planned = targets(slices.groupBy("source").agg(F.sum("slice_size").alias("source_size")), cycle, budget, max_repeats)
    plan = stored(
        begun.alias("b").join(planned.alias("p"), F.expr("b.source <=> p.source"))
        .select("b.source", "slice", "begin", "source_size", "start", "end", "target"),
        "mixing-plan",
    )
    within = Window.partitionBy("source", "slice").orderBy("place", "id", *marked)
    offset = F.coalesce(F.sum("size").over(within.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = (
        sized.withColumn("offset", offset).alias("d")
        .join(plan.alias("p"), F.expr("d.source <=> p.source AND d.slice = p.slice"))
        .select("d.*", "begin", "source_size", "start", "end", "target")
    )
    passes = F.array(*[F.lit(float(n)) for n in range(max_repeats)])
    middle = F.col("begin") + F.col("offset") + F.col("size") / 2
    placed = placed.withColumn(
        "middles",
        F.filter(
            F.transform(passes, lambda n: n * F.col("source_size") + middle),
            lambda m: (F.col("size") > 0) & (m <= F.col("target")),
        ),
    )
    positions = F.transform("middles", lambda m: _moment(m / F.col("target"), F.col("start"), F.col("end")))
    mixed = placed.select(
        F.col("id").alias(key), "size", "source_size", "target",
        (F.size("middles") * F.col("size")).alias("taken"), positions.alias("positions"), *marked,
    )
    first = F.coalesce(F.get("positions", F.lit(0)), F.lit(2.0))
    return mixed.repartitionByRange(first, F.xxhash64(key)).sortWithinPartitions(first, F.xxhash64(key))


def curriculum(documents: DataFrame, key: str = "doc_id", **options) -> DataFrame:
    """The taken documents with all columns, once per taken copy, and ``training_position``, in its order.

    The position says where a copy comes in training, from 0 to 1; files of a stored table are read in any order,
    so it is a column (one that documents have of that name gives way to it). Positions are joined back by a
    digest of the row, so rows that share a key, or have none, have each their own.
    """
    documents = documents.drop(POSITION)
    row = row_digest(documents)
    taken = mix(documents, key, row=row, **options).filter(F.col("taken") > 0)
    # Rows alike in all columns are one row with the positions of all.
    copies = stored(
        taken.groupBy("row").agg(F.flatten(F.collect_list("positions")).alias("positions")),
        "mixing-taken",
    )
    repeated = stored(documents.groupBy(row.alias("row")).count().filter("count > 1").select("row"), "mixing-repeated")
    placed = one_of_each(digested(documents, row), repeated).join(copies.select("row", "positions"), "row").select(
        "doc", F.explode("positions").alias("position"), F.xxhash64("row").alias("tie")
    )
    sorted_ = placed.repartitionByRange("position", "tie").sortWithinPartitions("position", "tie")
    return sorted_.select("doc.*", F.col("position").alias(POSITION))

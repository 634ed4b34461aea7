"""Running totals and row numbers that never put one hot group in one task."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradeloom.functions.relations import same_keys
from tradeloom.functions.staging import settle

#: Slices for each shuffle partition, and rows that are looked at to place a slice's bound.
SLICES, SAMPLED = 4, 50


def exclusive_prefix(
    totals: DataFrame, group: Sequence[str], levels: Sequence[str], measures: Sequence[str]
) -> DataFrame:
    """Sum of each measure over all earlier rows of the group.

    ``totals`` has one row per (group, levels). Levels go from coarse to fine
    and order like the rows do. Each window only spans one value of the coarser
    levels; the sums of those are carried down by a join, one level at a time.
    """
    *coarse, fine = levels
    window = (
        Window.partitionBy(*group, *coarse)
        .orderBy(F.col(fine).asc_nulls_first())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    inner = totals.withColumns(
        {f"_before_{m}": F.coalesce(F.sum(m).over(window), F.lit(0)) for m in measures}
    )
    if not coarse:
        return inner
    keys = [*group, *coarse]
    sums = totals.groupBy(*keys).agg(*[F.sum(m).alias(m) for m in measures])
    upper = exclusive_prefix(sums, group, coarse, measures).select(
        *[F.col(k).alias(f"_u_{k}") for k in keys],
        *[F.col(f"_before_{m}").alias(f"_u_before_{m}") for m in measures],
    )
    joined = inner.join(upper, same_keys({k: f"_u_{k}" for k in keys}), "left")
    return joined.withColumns(
        {f"_before_{m}": F.col(f"_before_{m}") + F.col(f"_u_before_{m}") for m in measures}
    ).select(*inner.columns)


def in_slices(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """The rows range-partitioned and sorted, with their slice and place, as a written table.

    ``_slice`` numbers the partitions in the given order and ``_place`` the rows of
    a slice, from 0. Written, so both stay with the row.
    """
    ascending = [F.col(c).asc_nulls_first() for c in order]
    sliced = (
        df.repartitionByRange(*ascending)
        .sortWithinPartitions(*ascending)
        .withColumn("_place", F.monotonically_increasing_id())
    )
    return settle(sliced, "slices").withColumns(
        {
            "_slice": F.shiftright("_place", 33),
            "_place": F.col("_place").bitwiseAND(F.lit((1 << 33) - 1)),
        }
    )


def slice_of(df: DataFrame, order: Sequence[Column], rows: int) -> Column:
    """The number of the row's slice in the given order (nulls first), as an expression over ``df``.

    Bounds come from a small sample, like those of a range shuffle; they only decide how even
    the slices are. Rows of equal order lie in one slice. ``rows`` is the size of ``df``.
    """
    spark = df.sparkSession
    slices = SLICES * int(spark.conf.get("spark.sql.shuffle.partitions"))
    key = F.struct(*[c.alias(f"c{i}") for i, c in enumerate(order)])
    few = df if rows <= SAMPLED * slices else df.sample(SAMPLED * slices / rows, 7)
    few = few.select(key.alias("key"))
    place = F.ntile(slices).over(Window.orderBy("key"))  # over the sample only
    bounds = few.withColumn("n", place).groupBy("n").agg(F.min("key").alias("key"))
    found = bounds.agg(F.to_json(F.collect_set("key")).alias("all")).first()["all"]
    # a time shortened by the text is a bound as well, if they are sorted again
    kind = F.lit(few.schema["key"].dataType.simpleString())
    bounds = F.sort_array(F.from_json(F.lit(found), F.concat(F.lit("array<"), kind, F.lit(">"))))
    size = slices.bit_length()
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(size))])

    def search(at: Column) -> Column:
        def step(place: Column, width: Column) -> Column:
            return F.when(F.get(bounds, place + width - 1) <= at, place + width).otherwise(place)

        return F.aggregate(steps, F.lit(0), step)

    # the key is made once a row, not at each step
    return F.get(F.transform(F.array(key), search), F.lit(0))


def number_rows(
    df: DataFrame, order: Sequence[str], key: str, start: int = 0
) -> DataFrame:
    """Add ``start`` + the 1-based position of each row in the given order.

    The position inside a slice of the global order is settled with the row; slice
    sizes (one row per partition) then give the offsets.
    """
    placed = in_slices(df, order)
    before = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_slice")
        .agg(F.count("*").alias("_rows"))
        .select("_slice", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    # one row per partition of the range shuffle, hence safe to broadcast
    return placed.join(F.broadcast(offsets), "_slice").select(
        (F.lit(start) + F.col("_offset") + F.col("_place") + 1).cast("bigint").alias(key),
        *df.columns,
    )

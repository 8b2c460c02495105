"""Row numbers and pseudonymous identifiers without a single-task sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from landrecon.operators.lookups import attach
from landrecon.session import stage
from landrecon.sources import versions

BLOCK = 1_000_000


def number_rows(df: DataFrame, order_by: list[str], id_col: str = "id") -> DataFrame:
    """Number all rows 1..n in the order of ``order_by``, which must be all of its columns
    or at least a set of columns that tells rows apart up to exact copies.

    Copies are counted before the shuffle. The distinct rows are range-partitioned, so each
    task sorts one slice; a slice's first number is the count of rows in the slices before
    it. Slices are written once, since a second sampling could cut them elsewhere. Copies
    are then laid out in blocks, so that no task emits more than one block of them.
    """
    counted = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_copies"))
    order = [F.col(c).asc_nulls_first() for c in order_by]
    slices = stage(
        counted.repartitionByRange(*order).withColumn("_slice", F.spark_partition_id()), "slices"
    )
    # One row per slice: as many rows as there are shuffle partitions, never more.
    starts = (
        slices.groupBy("_slice")
        .agg(F.sum("_copies").alias("_rows"))
        .withColumn(
            "_before",
            F.coalesce(
                F.sum("_rows").over(
                    Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
                ),
                F.lit(0),
            ),
        )
        .drop("_rows")
    )
    inside = Window.partitionBy("_slice").orderBy(*order)
    last = F.col("_before") + F.sum("_copies").over(
        inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    numbered = slices.join(F.broadcast(starts), "_slice").withColumn(
        "_first", last - F.col("_copies") + 1
    )
    single = numbered.filter("_copies = 1").withColumn(id_col, F.col("_first"))
    blocks = (
        numbered.filter("_copies > 1")
        .withColumn(
            "_block", F.explode(F.sequence(F.lit(0), F.floor((F.col("_copies") - 1) / BLOCK)))
        )
        .repartition("_first", "_block")
    )
    begin = F.col("_first") + F.col("_block") * BLOCK
    end = F.least(begin + BLOCK, F.col("_first") + F.col("_copies")) - 1
    copies = blocks.withColumn(id_col, F.explode(F.sequence(begin, end)))
    columns = [*df.columns, F.col(id_col).cast("bigint").alias(id_col)]
    return single.select(*columns).unionByName(copies.select(*columns))


def prefix_id(col: Column, prefix: str) -> Column:
    """Mark an id by origin; an id that already bears the mark stays as it is."""
    text = col.cast("string")
    return F.when(text.contains(prefix), text).otherwise(F.concat(F.lit(prefix), text))


def extended_link(values: DataFrame, column: str, known: DataFrame | None = None) -> DataFrame:
    """The link table (value, surrogate_id) with new values added: known values keep their ids, new
    ones get the numbers after the largest, in their own order. NULL has no id.

    Only the new values are sorted; the known ones are looked up.
    """
    distinct = values.select(column).filter(F.col(column).isNotNull()).distinct()
    if known is None:
        return number_rows(distinct, [column], "surrogate_id")
    new = number_rows(attach(distinct, known.select(column), [column], "left_anti"), [column], "surrogate_id")
    last = F.coalesce(known.agg(F.max("surrogate_id")).scalar(), F.lit(0))
    return known.select(column, "surrogate_id").unionByName(new.select(column, (F.col("surrogate_id") + last).alias("surrogate_id")))


def _replaced(df: DataFrame, column: str, link: DataFrame) -> DataFrame:
    joined = attach(df, link, [column])
    return joined.select(*[F.col("surrogate_id").alias(c) if c == column else F.col(c) for c in df.columns])


def surrogate_ids(
    df: DataFrame, columns: list[str], link: str = "link", known: dict[str, DataFrame] | None = None
) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Replace private values by incrementing integers and return the link table per column.

    NULL stays NULL. ``known`` has the link tables of earlier deliveries, whose ids stay. The link
    tables are written once and used for both results.
    """
    links = {}
    for column in columns:
        links[column] = stage(extended_link(df, column, (known or {}).get(column)), link)
        df = _replaced(df, column, links[column])
    return df, links


def delivered_ids(df: DataFrame, columns: list[str], folder: str, batch: str) -> DataFrame:
    """The same against link tables kept in a folder, one versioned table a column. They are extended
    by the delivery's new values in one commit each; the same batch again finds its values known."""
    spark = df.sparkSession
    for column in columns:
        path = f"{folder}/{column}"
        seen = versions.current(spark, path)
        if seen is None or batch not in seen.batches:
            known = None if seen is None else versions.read(spark, path)
            extended = extended_link(df, column, known)
            new = extended if known is None else attach(extended, known.select(column), [column], "left_anti")
            versions.append(new, path, batch)
        link = versions.read(spark, path)
        df = _replaced(df, column, link)
    return df

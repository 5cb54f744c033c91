"""Window-shaped operators of sequential readers.  All need an explicit order column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stemma.session import cut


def global_row_number(df: DataFrame, order: list[Column], out: str, start: int | Column = 0, partitions: int | None = None) -> DataFrame:
    """Numbers from ``start + 1`` in a total order without gathering the rows in one task.

    Rows are range-partitioned and sorted; the partition sizes give each its offset.
    """
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # written once: the bounds are sampled and would differ if computed again
    parted = cut(df.repartitionByRange(n, *order).withColumn("__p", F.spark_partition_id()))
    sizes = parted.groupBy("__p").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("__p", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__o"))
    w = Window.partitionBy("__p").orderBy(*order)
    numbered = parted.withColumn("__r", F.row_number().over(w)).join(F.broadcast(offsets), "__p")
    return numbered.withColumn(out, F.col("__r") + F.col("__o") + start).drop("__p", "__r", "__o")


def spread(df: DataFrame, partition: list[str], order: str, partitions: int | None = None) -> DataFrame:
    """Add ``__p``: the rows in ranges of (partition, order), so that a slice of any size is many tasks."""
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return cut(df.repartitionByRange(n, *partition, order).withColumn("__p", F.spark_partition_id()))


def _with_carried(rows: DataFrame, summary: DataFrame, partition: list[str], carried: dict[str, Column]) -> DataFrame:
    """Join to every chunk what ``carried`` makes of the chunks before it; summary: one row per chunk."""
    names = [f"__k{i}" for i in range(len(partition))]
    s = summary.select(*[F.col(c).alias(n) for c, n in zip(partition, names)], F.col("__p").alias("__q"), *[c.alias(n) for n, c in carried.items()])
    on = F.col("__p") == F.col("__q")
    for c, n in zip(partition, names):
        on = on & F.col(c).eqNullSafe(F.col(n))
    return rows.join(s, on, "left").drop(*names, "__q")


def _chunks_before(partition: list[str]):
    return Window.partitionBy(*partition).orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)


def fill_forward(df: DataFrame, value: str, partition: list[str], order: str, out: str, inclusive: bool = True) -> DataFrame:
    """Add ``out``: the last value up to the row, or before it (a page break counts from the next record on).

    A chunk fills itself; the last value of the chunks before it fills its start.
    """
    rows = spread(df, partition, order)
    inside = Window.partitionBy(*partition, "__p").orderBy(order).rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    ends = rows.groupBy(*partition, "__p").agg(F.max(F.when(F.col(value).isNotNull(), F.struct(order, value)))[value].alias("__end"))
    carry = F.last("__end", ignorenulls=True).over(_chunks_before(partition))
    filled = rows.withColumn(out, F.last(F.col(value), ignorenulls=True).over(inside))
    return _with_carried(filled, ends, partition, {"__carry": carry}).withColumn(out, F.coalesce(out, "__carry")).drop("__p", "__carry")


def row_number_in(df: DataFrame, partition: list[str], order: str, out: str) -> DataFrame:
    """Add ``out``: the place of the row in its partition, from 1; partitions may be of any size."""
    rows = spread(df, partition, order)
    sizes = rows.groupBy(*partition, "__p").agg(F.count(F.lit(1)).alias("__n"))
    carry = F.coalesce(F.sum("__n").over(_chunks_before(partition)), F.lit(0))
    numbered = rows.withColumn(out, F.row_number().over(Window.partitionBy(*partition, "__p").orderBy(order)))
    return _with_carried(numbered, sizes, partition, {"__carry": carry}).withColumn(out, F.col(out) + F.col("__carry")).drop("__p", "__carry")


def running_sum(df: DataFrame, value: str, partition: list[str], order: str, out: str) -> DataFrame:
    """Add ``out``: the sum of ``value`` up to the row; partitions may be of any size."""
    rows = spread(df, partition, order)
    sums = rows.groupBy(*partition, "__p").agg(F.coalesce(F.sum(value), F.lit(0)).alias("__s"))
    carry = F.coalesce(F.sum("__s").over(_chunks_before(partition)), F.lit(0))
    inside = Window.partitionBy(*partition, "__p").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    summed = rows.withColumn(out, F.coalesce(F.sum(value).over(inside), F.lit(0)))
    return _with_carried(summed, sums, partition, {"__carry": carry}).withColumn(out, F.col(out) + F.col("__carry")).drop("__p", "__carry")


def run_ids(df: DataFrame, value: str, partition: list[str], order: str, out: str) -> DataFrame:
    """Add ``out``: the number of the run of equal neighbouring values; null equals null."""
    rows = spread(df, partition, order)
    inside = Window.partitionBy(*partition, "__p").orderBy(order)
    start = F.row_number().over(inside) == 1
    rows = rows.withColumn("__new", F.when(start, None).otherwise((~F.lag(value).over(inside).eqNullSafe(F.col(value))).cast("int")))
    ends = rows.groupBy(*partition, "__p").agg(
        F.sum("__new").alias("__inner"), F.min(F.struct(order, F.col(value).alias("x")))["x"].alias("__first"), F.max(F.struct(order, F.col(value).alias("x")))["x"].alias("__last")
    )
    chunks = Window.partitionBy(*partition).orderBy("__p")
    opens = F.when((F.row_number().over(chunks) == 1) | ~F.lag("__last").over(chunks).eqNullSafe(F.col("__first")), 1).otherwise(0)
    ends = ends.withColumn("__opens", opens)
    carry = F.col("__opens") + F.coalesce(F.sum(F.coalesce("__inner", F.lit(0)) + F.col("__opens")).over(_chunks_before(partition)), F.lit(0))
    joined = _with_carried(rows, ends, partition, {"__carry": carry})
    return joined.withColumn(out, F.col("__carry") + F.coalesce(F.sum("__new").over(inside), F.lit(0))).drop("__p", "__carry", "__new")


def renumber_homonyms(df: DataFrame, partition: list[str], order: str, lemma: str, is_main: Column, out: str = "sense_num") -> DataFrame:
    """Main rows of one run of a lemma are numbered from 1 where there are several, else null."""
    runs = run_ids(df, lemma, partition, order, "__run").withColumn("__main", is_main)
    in_run = Window.partitionBy(*partition, "__run")
    number = F.sum(F.col("__main").cast("int")).over(in_run.orderBy(order))
    mains = F.sum(F.col("__main").cast("int")).over(in_run)
    return runs.withColumn(out, F.when(F.col("__main") & (mains > 1), number)).drop("__main", "__run")


def number_senses(df: DataFrame, partition: list[str], entry: str, order: str) -> DataFrame:
    """sense_no through the slice and h_number n{entry}.{k}, k from 0; stored values are kept."""
    inside = Window.partitionBy(*partition, entry).orderBy(order)
    h = F.concat(F.lit("n"), F.col(entry).cast("string"), F.lit("."), (F.row_number().over(inside) - 1).cast("string"))
    return row_number_in(df, partition, order, "sense_no").withColumn("h_filled", F.coalesce("h_number", h))


def nearest_shallower(df: DataFrame, partition: list[str], order: str, level: Column, key: str, levels: int, out: str) -> DataFrame:
    """Key of the nearest earlier row with a smaller level: of the last row of each level the latest."""
    w = Window.partitionBy(*partition).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    tagged = df.withColumn("__lv", level)
    last = [F.last(F.when(F.col("__lv") == i, F.struct(F.col(order).alias("o"), F.col(key).alias("k"))), ignorenulls=True).over(w) for i in range(levels)]
    tagged = tagged.withColumn("__last", F.array(*last))
    above = F.filter(F.slice("__last", F.lit(1), F.greatest(F.col("__lv"), F.lit(0))), lambda s: s.isNotNull())
    return tagged.withColumn(out, F.array_max(above)["k"]).drop("__lv", "__last")


def outline_labels(df: DataFrame, partition: list[str], order: str, level: str, label: str, out: str) -> DataFrame:
    """Labels like I.A.2: per partition an ordered fold that pads skipped levels with X and truncates."""
    step = F.struct(F.col(order).alias("o"), F.col(level).alias("lv"), F.coalesce(F.col(label), F.lit("X")).alias("lb"))
    rows = df.groupBy(*partition).agg(F.array_sort(F.collect_list(step)).alias("rows"))

    def extend(acc, row):
        kept = F.slice(acc["path"], F.lit(1), F.greatest(row["lv"] - 1, F.lit(0)))
        pad = F.array_repeat(F.lit("X"), F.greatest(row["lv"] - 1 - F.size(kept), F.lit(0)))
        path = F.concat(kept, pad, F.array(row["lb"]))
        return F.struct(path.alias("path"), F.concat(acc["out"], F.array(F.struct(row["o"].alias("o"), F.array_join(path, ".").alias("l")))).alias("out"))

    order_type = df.schema[order].dataType.simpleString()
    start = F.struct(F.array().cast("array<string>").alias("path"), F.array().cast(f"array<struct<o:{order_type},l:string>>").alias("out"))
    folded = rows.withColumn("folded", F.aggregate("rows", start, extend)["out"])
    return folded.select(*partition, F.inline("folded")).toDF(*partition, order, out)


def shifted_id(c: Column, thresholds: tuple[int, ...] = (20214, 77575, 78758, 98366, 99905)) -> Column:
    """Ids minus one for every threshold (fixed values) they lie above."""
    return c - sum((c > t).cast("int") for t in thresholds)


def unique_or_ambiguous(key: list[str]) -> Column:
    n = F.count(F.lit(1)).over(Window.partitionBy(*key))
    return F.when(n == 1, "unique").otherwise("ambiguous")


def promote_first(df: DataFrame, partition: list[str], order: str, filled: str) -> DataFrame:
    """Mark the first sense of entries whose main text is blank: it moves up to the entry."""
    w = Window.partitionBy(*partition).orderBy(order)
    return df.withColumn("promoted", (F.row_number().over(w) == 1) & F.col(filled).isNull())

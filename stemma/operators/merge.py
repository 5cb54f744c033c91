"""Updates and merges over immutable tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def update_from(target: DataFrame, source: DataFrame, key: list[str], columns: dict[str, str], clear_unmatched: bool = False, order: str | None = None) -> DataFrame:
    """Take ``columns`` (target: source) from the source row with the same key.

    Several source rows of one key: the smallest value of ``order`` (or of the columns) counts.  Target
    rows without one keep their values, or lose them with ``clear_unmatched``.
    """
    picked = [F.col(c).alias(f"__s_{t}") for t, c in columns.items()]
    lead = [F.col(order).alias("__o")] if order else []
    one = source.groupBy(*key).agg(F.min(F.struct(*lead, *picked)).alias("__s"), F.lit(True).alias("__hit"))
    joined = target.join(one, key, "left")
    for t in columns:
        new = F.col(f"__s.__s_{t}")
        joined = joined.withColumn(t, F.when(F.col("__hit"), new) if clear_unmatched else F.when(F.col("__hit"), new).otherwise(F.col(t)))
    return joined.select(*target.columns)


def ambiguous_keys(source: DataFrame, key: list[str]) -> DataFrame:
    return source.groupBy(*key).agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")


def slice_overwrite(current: DataFrame, incoming: DataFrame, slice_column: str) -> DataFrame:
    """The slices present in ``incoming`` replace those of ``current``; the others stay."""
    slices = incoming.select(slice_column).distinct()
    return current.join(slices, slice_column, "left_anti").select(*current.columns).unionByName(incoming.select(*current.columns))


def write_slices(incoming: DataFrame, path: str, slice_column: str) -> None:
    """The same on disk: dynamic partition overwrite touches the delivered slices only."""
    incoming.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(slice_column).parquet(path)


def staged_overwrite(spark, path: str, incoming: DataFrame, slice_column: str, checks: dict[str, str]) -> dict[str, int]:
    """Replace the delivered slices of a table of folders only if the new rows pass: written aside, checked, swapped in.

    path: folder of parquet versions; ``current_version`` names the one in force.  checks: name -> condition no row
    may meet.  Returns the number of rows that fail each check; with any, nothing changes.  Readers see
    the old version or the new one, never a mixture, for one small file decides.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs
    folder = hadoop.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    version = current_version(spark, path)
    staged = f"{path}/v{version + 1}"
    now = incoming if version < 0 else slice_overwrite(spark.read.parquet(f"{path}/v{version}"), incoming, slice_column)
    now.write.mode("overwrite").parquet(staged)
    bad = spark.read.parquet(staged).agg(F.count(F.lit(1)).alias("rows"), *[F.count_if(F.expr(c)).alias(n) for n, c in checks.items()]).first().asDict()
    failed = {n: bad[n] for n in checks if bad[n]}
    if failed:
        fs.delete(hadoop.Path(staged), True)
        return failed
    # a renamed marker is there or not
    marker = hadoop.Path(f"{path}/_next-{version + 1}")
    fs.create(marker).close()
    fs.rename(marker, hadoop.Path(f"{path}/_version-{version + 1}"))
    return {}


def current_version(spark, path: str) -> int:
    hadoop = spark._jvm.org.apache.hadoop.fs
    folder = hadoop.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return -1
    names = [x.getPath().getName() for x in fs.listStatus(folder)]
    return max((int(n.removeprefix("_version-")) for n in names if n.startswith("_version-")), default=-1)


def append_new(current: DataFrame, incoming: DataFrame, key: list[str]) -> tuple[DataFrame, DataFrame]:
    """(table with the rows appended, rows refused because their key is taken)."""
    refused = incoming.join(current.select(*key).distinct(), key, "left_semi")
    fresh = incoming.join(current.select(*key).distinct(), key, "left_anti")
    return current.unionByName(fresh.select(*current.columns)), refused


def move_rows(source: DataFrame, target: DataFrame, condition: str) -> tuple[DataFrame, DataFrame]:
    """(source without, target with) the rows that meet the condition; null conditions stay."""
    hit = F.coalesce(F.expr(condition), F.lit(False))
    return source.where(~hit), target.unionByName(source.where(hit))


def dangling(links: DataFrame, targets: DataFrame, link_key: list[str], target_key: list[str]) -> DataFrame:
    """Links whose target no longer exists."""
    on = [F.col(f"l.{a}") == F.col(f"t.{b}") for a, b in zip(link_key, target_key)]
    present = F.lit(True)
    for k in link_key:
        present = present & F.col(k).isNotNull()
    return links.where(present).alias("l").join(targets.select(*target_key).distinct().alias("t"), on, "left_anti")


def altered(df: DataFrame, add: dict[str, str] | None = None, retype: dict[str, str] | None = None, drop: list[str] | None = None) -> DataFrame:
    """The table under a changed schema: columns taken out, others cast (null where that fails), new ones null at the end."""
    out = df.drop(*(drop or []))
    for name, kind in (retype or {}).items():
        out = out.withColumn(name, F.col(name).try_cast(kind))
    for name, kind in (add or {}).items():
        out = out.withColumn(name, F.lit(None).cast(kind))
    return out


def unique_key(df: DataFrame, key: list[str]) -> bool:
    """Whether the columns may be a primary key: no null, no value twice."""
    no_null = df.where(" or ".join(f"`{k}` is null" for k in key)).limit(1).count() == 0
    return no_null and ambiguous_keys(df, key).limit(1).count() == 0


def stamped(df: DataFrame, at: str, editor: str) -> DataFrame:
    """Set last_updated and editor; the time is given, so that a run can be repeated."""
    return df.withColumn("last_updated", F.lit(at).cast("timestamp")).withColumn("editor", F.lit(editor))


def moved_behind(df: DataFrame, columns: list[str], anchor: str) -> DataFrame:
    """The columns, in the order given, right behind another one."""
    rest = [c for c in df.columns if c not in columns]
    at = rest.index(anchor) + 1
    return df.select(*rest[:at], *columns, *rest[at:])

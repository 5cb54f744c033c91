"""Session helpers: table access and lineage cutting."""

from __future__ import annotations

import re
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the Python workers this package, once per application.

    The archive lies in the shared folder; where that is no plain path the package is taken to be
    installed on the executors.
    """
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    _SHIPPED.add(sc.applicationId)
    folder = shared_folder(spark)
    if "://" in folder.removeprefix("file://") or (":" in folder and not folder.startswith("file:")):
        return
    root = Path(__file__).resolve().parent
    target = Path(re.sub("^file:/*", "/", folder)) / f"package-{uuid.uuid4().hex}" / "stemma.zip"
    target.parent.mkdir(parents=True)
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    sc.addPyFile(str(target))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names for checkpoints; a local one only where none is set (tests)."""
    sc = spark.sparkContext
    named = sc._jsc.sc().getCheckpointDir()
    if named.isDefined():
        return named.get()
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        shared = tempfile.mkdtemp(prefix="stemma-checkpoint-")
    sc.setCheckpointDir(shared)
    return sc._jsc.sc().getCheckpointDir().get()


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and cut its lineage: what is read back survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Most bytes of strings and numbers that a broadcast table may hold.
BROADCAST_BYTES = 64 << 20


def _width(df: DataFrame):
    """Bytes of a row: strings as long as they are, arrays by their number of elements, others eight."""
    parts = []
    for name, kind in df.dtypes:
        c = F.col(f"`{name}`")
        parts.append(F.octet_length(c) if kind == "string" else F.size(c) * 16 if kind.startswith("array") else F.lit(8))
    return sum((F.coalesce(p, F.lit(0)) for p in parts), F.lit(16))


def is_small(kept: DataFrame, most_rows: int = 200_000) -> bool:
    """Whether a written table is measured to have at most ``most_rows`` and ``BROADCAST_BYTES``."""
    rows, size = kept.limit(most_rows + 1).agg(F.count(F.lit(1)), F.coalesce(F.sum(_width(kept)), F.lit(0))).first()
    return rows <= most_rows and size <= BROADCAST_BYTES


def broadcast_if_small(df: DataFrame, most_rows: int = 200_000) -> DataFrame:
    """``df``, written once and marked for broadcast if it ``is_small``."""
    kept = cut(df)
    return F.broadcast(kept) if is_small(kept, most_rows) else kept


#: Rows of one key that one task may join.
HOT = 500_000


def spread_join(left: DataFrame, right: DataFrame, keys: list[tuple[str, str]], by: list[str], how: str = "left", hot: int | None = None) -> DataFrame:
    """``left`` joined to ``right`` on ``keys`` (pairs of names), with the rows of frequent keys spread over several tasks.

    Keys of more than ``hot`` left rows are counted first; their left rows are divided by a hash of the columns
    ``by``, and their right rows repeated once for each part.  Null keys meet nothing and are spread likewise.
    """
    hot = hot or HOT
    names = [a for a, _ in keys]
    known = F.lit(True)
    for a in names:
        known = known & F.col(a).isNotNull()
    counts = left.where(known).groupBy(*names).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > hot)
    counts = broadcast_if_small(counts.select(*[F.col(a).alias(f"__h{i}") for i, a in enumerate(names)], F.ceil(F.col("__n") / hot).cast("int").alias("__parts")))
    on_hot = lambda side: [F.col(side[i]) == F.col(f"__h{i}") for i in range(len(names))]
    held = [f"__h{i}" for i in range(len(names))]
    part = F.when(known, F.pmod(F.xxhash64(*by), F.coalesce("__parts", F.lit(1)))).otherwise(F.pmod(F.xxhash64(*by), F.lit(1 << 20)))
    a = left.join(counts, on_hot(names), "left").withColumn("__part", part).drop(*held, "__parts")
    b = right.join(counts, on_hot([y for _, y in keys]), "left")
    b = b.withColumn("__of", F.explode(F.sequence(F.lit(0), F.coalesce("__parts", F.lit(1)) - 1))).withColumn("__of", F.col("__of").cast("long")).drop(*held, "__parts")
    on = [F.col(x) == F.col(y) for x, y in keys] + [F.col("__part") == F.col("__of")]
    return a.join(b, on, how).drop("__part", "__of")

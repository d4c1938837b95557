"""Sinks, get-or-compute artifacts and the keyed upsert."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def write_parquet(frame: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """``ignore`` keeps what is there, ``errorifexists`` refuses, ``overwrite`` rebuilds."""
    frame.write.mode(mode).parquet(path)


def write_csv(
    frame: DataFrame, path: str, header: bool = False, mode: str = "errorifexists"
) -> None:
    frame.write.mode(mode).option("header", header).csv(path)


def write_baskets(baskets: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One basket per line, items joined by commas.

    Items with commas, quotes or outer spaces are quoted, so that the file reads
    back as it was. A line break in an item becomes a space, as a basket is one line.
    """

    def quoted(item: Column) -> Column:
        line = F.regexp_replace(item, r"\r\n|\r|\n", " ")
        return F.when(line.rlike('[,"]|^ | $'), F.concat(F.lit('"'), F.replace(line, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(line)

    baskets.select(F.array_join(F.transform("items", quoted), ",").alias("value")).write.mode(mode).text(path)


def write_report(metrics: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write the few (name, value) rows of a report as one file."""
    metrics.coalesce(1).write.mode(mode).csv(path)


def _file_system(spark: SparkSession, path: str):
    location = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), location


def fingerprint(spark: SparkSession, inputs: Iterable[str], settings: str = "") -> str:
    """A digest of the files under the input paths (place, length, time of change) and of the settings."""
    lines = [settings]
    for path in inputs:
        files, location = _file_system(spark, path)
        found, under = files.listFiles(location, True), []
        while found.hasNext():
            one = found.next()
            under.append(f"{one.getPath()} {one.getLen()} {one.getModificationTime()}")
        lines += [path, *sorted(under)]
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()[:32]


def _only_spark_output(files, location) -> bool:
    names = [child.getPath().getName() for child in files.listStatus(location)]
    return all(n.startswith(("part-", "_", ".")) or "=" in n for n in names)


def materialize(
    spark: SparkSession,
    path: str,
    build: Callable[[], DataFrame],
    inputs: Iterable[str] = (),
    settings: str = "",
) -> DataFrame:
    """Read the artifact at ``path``; build and write it first when it is absent, half-written or stale.

    It is stale when the files of ``inputs`` or the ``settings`` changed since
    it was built; without either, what is complete stays. A build goes to
    ``<path>._staged``, gets a mark, and takes its place by one rename (atomic
    where the file system's renames are), so readers never see half of it. A
    job that stopped between mark and rename goes on from the staged files.
    One job at a time may build a path. A folder with other files than Spark
    writes is never replaced, and failures of reading are raised.
    """
    inputs = list(inputs)
    mark = f"_artifact-{fingerprint(spark, inputs, settings)}"
    files, target = _file_system(spark, path)
    staged_path = f"{path.rstrip('/')}._staged"
    staged = _file_system(spark, staged_path)[1]
    child = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fixed = not inputs and not settings
    if files.exists(child(target, mark)) or (fixed and files.exists(child(target, "_SUCCESS"))):
        return spark.read.parquet(path)
    if files.exists(target) and not _only_spark_output(files, target):
        raise ValueError(f"{path} holds files that are no artifact")
    if not files.exists(child(staged, mark)):
        write_parquet(build(), staged_path, "overwrite")
        files.create(child(staged, mark)).close()
    files.delete(target, True)
    if not files.rename(staged, target):
        raise OSError(f"could not move {staged_path} to {path}")
    return spark.read.parquet(path)


def missing_paths(spark: SparkSession, paths: Iterable[str]) -> list[str]:
    """Those of the given input paths that do not exist in their file system."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    missing = []
    for path in paths:
        location = jvm.org.apache.hadoop.fs.Path(path)
        if not location.getFileSystem(conf).exists(location):
            missing.append(path)
    return missing


def build_dimensions(
    blocks: DataFrame, locations: DataFrame, folder: str, resolution: str = "country"
) -> None:
    """Drop and rebuild the geo dimension tables of one resolution."""
    if resolution != "country":
        raise ValueError(f"unsupported resolution {resolution!r}: only 'country' is known")
    write_parquet(blocks, f"{folder}/ip_blocks", mode="overwrite")
    write_parquet(locations, f"{folder}/country_locations", mode="overwrite")


def upsert(
    current: DataFrame, changes: DataFrame, key: str, order: str | None = None
) -> DataFrame:
    """``current`` with the rows of ``changes`` inserted or replaced by ``key``.

    ``order`` names the column that tells which of several changes to one key
    was written last. It is used to choose and then dropped.
    """
    payload = [c for c in changes.columns if c not in (key, order)]
    values = F.struct(*payload)
    rank = F.struct(*([order] if order else []), *payload)
    latest = (
        changes.groupBy(key)
        .agg(F.max_by(values, rank).alias("_latest"))
        .select(key, *[F.col("_latest")[c].alias(c) for c in payload])
    )
    kept = current.join(latest.select(key), key, "left_anti")
    return kept.unionByName(latest.select(*current.columns))


def persist(frame: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> DataFrame:
    return frame.persist(level)

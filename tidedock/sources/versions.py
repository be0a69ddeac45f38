"""Tables in committed versions: a version is the list of partitions it consists of, published by one rename.

Below the table's folder, ``data/commit=<id>/...`` holds what single writes have added and is never changed, ``manifests/<id>``
is a table of the partitions a version reads, and ``versions/<number>`` is a one-line file that names a manifest. A writer
writes data, then the manifest, then renames its version file into place. The rename fails if the number is
taken, so two writers that start from one version cannot both publish. Before it readers see the old version, behind it the
new one; a writer that is lost in between leaves files that nothing reads until ``expire`` deletes them.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class VersionConflict(RuntimeError):
    """Another writer has published the next version first; read again and repeat."""


def append(rows: DataFrame, path: str, partition_by: list[str], base: int | None) -> int:
    """The version after ``base``, from which the caller has read: all that it has, and ``rows``."""
    return _commit(rows, path, partition_by, base, lambda live, new: live)


def append_some(rows: DataFrame, path: str, partition_by: list[str], base: int | None) -> int:
    """``append`` that publishes nothing if there are no rows; returns how many there are, counted where they were written."""
    commit, written = _write(rows, path, partition_by)
    count = written.count()
    if count:
        _list(rows, written, path, partition_by, base, commit, lambda live, new: live)
    return count


def replace(rows: DataFrame, path: str, partition_by: list[str], base: int | None) -> int:
    """The version after ``base``: partitions that occur in ``rows`` consist of ``rows`` alone, others stay."""
    return _commit(rows, path, partition_by, base, lambda live, new: _matching(live, new, partition_by, "left_anti"))


def overwrite(rows: DataFrame, path: str, base: int | None) -> int:
    """The version after ``base``: ``rows`` alone."""
    return _commit(rows, path, [], base, lambda live, new: None)


def read(spark: SparkSession, path: str, schema: T.StructType, partition_by: list[str], version: int | None = None) -> DataFrame:
    """One version, by default the newest; an absent table raises ``FileNotFoundError``."""
    version = current(spark, path) if version is None else version
    if version is None:
        raise FileNotFoundError(f"no version of {path}")
    manifest = _manifest(spark, path, version, partition_by, schema)
    commits = [r[0] for r in manifest.select("commit").distinct().collect()]
    stored = T.StructType([*schema.fields, T.StructField("commit", T.StringType())])
    # Only folders of live commits are listed; which of their partitions are live is decided on folder names.
    folders = [f"{path}/data/commit={c}" for c in commits]
    if not folders:
        return spark.createDataFrame([], schema)
    table = spark.read.schema(stored).option("basePath", f"{path}/data").parquet(*folders)
    if partition_by:
        table = _matching(table, manifest, ["commit", *partition_by], "left_semi")
    return table.select(*schema.fieldNames())


def current(spark: SparkSession, path: str) -> int | None:
    """Number of the newest version."""
    return max(_versions(spark, path), default=None)


def expire(spark: SparkSession, path: str, partition_by: list[str], schema: T.StructType, keep: int = 2) -> int:
    """Delete all versions but the newest ``keep``, and what only they or lost writers have written; no writer may be at work."""
    numbers = sorted(_versions(spark, path))
    kept = numbers[-keep:]
    manifests = {_named(spark, path, n) for n in kept}
    commits = {r[0] for n in kept for r in _manifest(spark, path, n, partition_by, schema).select("commit").distinct().collect()}
    gone = [f"{path}/versions/{_file(n)}" for n in numbers[:-keep]]
    gone += [f"{path}/manifests/{m}" for m in _children(spark, f"{path}/manifests") if m not in manifests]
    gone += [f"{path}/data/{c}" for c in _children(spark, f"{path}/data") if c.removeprefix("commit=") not in commits]
    for target in gone:
        at, fs = _file_system(spark, target)
        fs.delete(at, True)
    return len(gone)


def _matching(left: DataFrame, right: DataFrame, columns: list[str], how: str) -> DataFrame:
    """Semi or anti join on columns whose nulls are equal, as they are in folder names."""
    other = right.select(*[F.col(c).alias(f"_{c}") for c in columns])
    return left.join(other, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in columns], how)


def _commit(rows: DataFrame, path: str, partition_by: list[str], base: int | None, keeps) -> int:
    commit, written = _write(rows, path, partition_by)
    return _list(rows, written, path, partition_by, base, commit, keeps)


def _write(rows: DataFrame, path: str, partition_by: list[str]) -> tuple[str, DataFrame]:
    """Id of a new commit and a scan of its data; no version names it yet."""
    commit = uuid.uuid4().hex
    folder = f"{path}/data/commit={commit}"
    if partition_by:
        # Rebalancing gathers a partition into few files, instead of one per task, and splits one that is much larger.
        rows.hint("rebalance", *partition_by).write.partitionBy(*partition_by).parquet(folder)
    else:
        rows.write.parquet(folder)
    return commit, rows.sparkSession.read.schema(rows.schema).parquet(folder)


def _list(rows: DataFrame, written: DataFrame, path: str, partition_by: list[str], base: int | None, commit: str, keeps) -> int:
    """Publishes the version after ``base`` with a written commit."""
    spark = rows.sparkSession
    new = written.select(*partition_by).distinct() if partition_by else spark.range(1).select()
    new = new.withColumn("commit", F.lit(commit))
    kept = None if base is None else keeps(_manifest(spark, path, base, partition_by, rows.schema), new)
    live = new if kept is None else new.unionByName(kept)
    live.coalesce(1).write.parquet(f"{path}/manifests/{commit}")
    _publish(spark, path, (base or 0) + 1, commit)
    return (base or 0) + 1


def _publish(spark: SparkSession, path: str, version: int, manifest: str) -> None:
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    pending, fs = _file_system(spark, f"{path}/pending/{manifest}")
    out = fs.create(pending, False)
    out.write(manifest.encode())
    out.close()
    target, _ = _file_system(spark, f"{path}/versions/{_file(version)}")
    fs.mkdirs(target.getParent())
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), conf)
    kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    never = spark.sparkContext._gateway.new_array(kind, 1)
    never[0] = kind.NONE
    try:
        files.rename(pending, target, never)
    except Exception as error:
        if "FileAlreadyExistsException" in str(error):
            raise VersionConflict(f"version {version} of {path} exists") from error
        raise


def _file(version: int) -> str:
    return f"{version:012d}"


def _versions(spark: SparkSession, path: str) -> list[int]:
    return [int(name) for name in _children(spark, f"{path}/versions") if name.isdigit()]


def _named(spark: SparkSession, path: str, version: int) -> str:
    return spark.read.text(f"{path}/versions/{_file(version)}").first()[0]


def _manifest(spark: SparkSession, path: str, version: int, partition_by: list[str], schema: T.StructType) -> DataFrame:
    """(partition columns, commit) of the partitions of a version: one row per folder."""
    fields = [f for f in schema.fields if f.name in partition_by]
    kinds = T.StructType([*fields, T.StructField("commit", T.StringType())])
    return spark.read.schema(kinds).parquet(f"{path}/manifests/{_named(spark, path, version)}")


def _file_system(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _children(spark: SparkSession, path: str) -> list[str]:
    target, fs = _file_system(spark, path)
    return [f.getPath().getName() for f in fs.listStatus(target)] if fs.exists(target) else []

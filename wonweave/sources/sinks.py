"""Writing results: whole or not at all, in a fixed order, and safe to embed."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wonweave.functions.columns import col


def shared_path(spark: SparkSession, name: str) -> str:
    """In spark.checkpoint.dir, which driver and executors share; where that is unset, as in tests, a local folder, but on a cluster that is an error."""
    top = spark.conf.get("spark.checkpoint.dir", None)
    if not top:
        context = spark.sparkContext
        if context._jsc.sc().getCheckpointDir().isEmpty():
            if not re.fullmatch(r"local(\[.*\])?", context.master):
                raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
            context.setCheckpointDir(tempfile.mkdtemp(prefix="wonweave-"))
        top = context._jsc.sc().getCheckpointDir().get()
    return f"{top.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str = "stage") -> DataFrame:
    """Written to shared storage and read back: cuts the lineage of iterative plans."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Incomplete(Exception):
    pass


POINTER, COUNTS = "CURRENT", "_counts"


def publish(tables: Mapping[str, DataFrame], issues: DataFrame, path: str, order: Mapping[str, list[str]] | None = None) -> str:
    """Writes all tables as a new version below `path`, or none if there are issues, and returns where.

    A small file names the version that counts. It is put in place by one rename over the old one,
    so readers see the old version or the new one, whenever the writer stops. Versions before the
    last are removed. What was written is counted, see counts().
    """
    found = issues.limit(5).collect()
    if found:
        raise Incomplete(str(found))
    spark, top, version = issues.sparkSession, path.rstrip("/"), f"v-{uuid.uuid4().hex}"
    rows = []
    for name, df in tables.items():
        keys = (order or {}).get(name)
        (df.orderBy(*keys) if keys else df).write.parquet(f"{top}/{version}/{name}")
        rows.append((name, spark.read.parquet(f"{top}/{version}/{name}").count()))  # from the files' footers
    spark.createDataFrame(rows, "name string, rows long").coalesce(1).write.parquet(f"{top}/{version}/{COUNTS}")
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    place = jvm.org.apache.hadoop.fs.Path
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(place(top).getFileSystem(conf).getUri(), conf)
    fs = place(top).getFileSystem(conf)
    before = published(spark, path)
    written = fs.create(place(f"{top}/{version}.new"), True)
    written.write(bytearray(version.encode()))
    written.close()
    how = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    how[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    files.rename(fs.makeQualified(place(f"{top}/{version}.new")), fs.makeQualified(place(f"{top}/{POINTER}")), how)
    kept = {version, before and before.rpartition("/")[2]}
    for status in fs.listStatus(place(top)):
        name = status.getPath().getName()
        if name.startswith("v-") and name not in kept:
            fs.delete(status.getPath(), True)
    return f"{top}/{version}"


def published(spark: SparkSession, path: str) -> str | None:
    """The folder of the version that counts; None if there is none."""
    top, jvm = path.rstrip("/"), spark._jvm
    pointer = jvm.org.apache.hadoop.fs.Path(f"{top}/{POINTER}")
    fs = pointer.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(pointer):
        return None
    read = fs.open(pointer)
    try:
        return f"{top}/{bytes(read.readAllBytes()).decode()}"
    finally:
        read.close()


def counts(spark: SparkSession, path: str) -> DataFrame:
    """name, rows of the tables of the version that counts, as they were written."""
    return spark.read.schema("name string, rows long").parquet(f"{published(spark, path)}/{COUNTS}")


def json_lines(df: DataFrame, order: list[str]) -> DataFrame:
    """One JSON object a row, fields in order of their names, rows in order; NaN and infinity are null."""
    plain = [F.when(F.isnan(c) | (F.abs(F.col(c)) == float("inf")), None).otherwise(F.col(c)).alias(c) if t in ("double", "float") else F.col(c) for c, t in sorted(df.dtypes)]
    return df.orderBy(*order).select(F.to_json(F.struct(*plain), {"ignoreNullFields": "false"}).alias("value"))


def for_html(c: Column | str) -> Column:
    """JSON that can stand in a script element."""
    x = col(c)
    for mark, code in (("&", "\\u0026"), ("<", "\\u003c"), (">", "\\u003e"), ("\u2028", "\\u2028"), ("\u2029", "\\u2029")):
        x = F.replace(x, F.lit(mark), F.lit(code))
    return x


def html_page(df: DataFrame, title: str, order: list[str]) -> DataFrame:
    """One row: a page that embeds the rows of a table of bounded size as inert JSON."""
    rows = json_lines(df, order).agg(F.array_join(F.collect_list("value"), ",").alias("v"))
    return rows.select(F.concat(F.lit(f"<!DOCTYPE html><meta charset=utf-8><title>{title}</title><script type=application/json id=data>["), for_html("v"), F.lit("]</script>")).alias("value"))


def tagged(df: DataFrame, path: str, tag: str) -> None:
    """Rows under a partition of their own; writing a tag again replaces that tag alone."""
    df.withColumn("tag", F.lit(tag)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("tag").parquet(path)


def aliased(df: DataFrame, path: str, year: int) -> None:
    """The same rows under the plain name and under the year's."""
    for p in (path, f"{path}_{year}"):
        df.write.mode("overwrite").parquet(p)

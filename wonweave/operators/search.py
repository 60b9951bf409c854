"""Searches over a precomputed haystack."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def squeeze(text: str) -> str:
    return re.sub(r"[^0-9a-z가-힣]+", "", text.lower())


def haystack(*cols: Column) -> Column:
    """What is searched: all columns, lower case, letters and digits only, one after the other with a bar between."""
    return F.array_join(F.array(*[F.regexp_replace(F.lower(F.coalesce(c.cast("string"), F.lit(""))), "[^0-9a-z가-힣]+", "") for c in cols]), "|")


def search(df: DataFrame, text: str, order: Sequence[Column | str], limit: int = 10, hay: str = "haystack", **equal: str) -> DataFrame:
    """The first `limit` rows in order whose haystack holds the text (all rows if it is empty) and whose columns equal `equal`."""
    found = df.filter(F.col(hay).contains(squeeze(text))) if squeeze(text) else df
    for c, v in equal.items():
        found = found.filter(F.col(c) == v)
    return found.orderBy(*order).limit(limit)


def facet(df: DataFrame, c: str) -> DataFrame:
    return df.select(c).distinct().orderBy(c)


def lookup(df: DataFrame, id_: str, wanted: str, default: str) -> DataFrame:
    """The row of the wanted id, else that of the default."""
    rows = df.filter(F.col(id_).isin(wanted, default))
    return rows.withColumn("__o", (F.col(id_) != wanted).cast("int")).orderBy("__o", id_).limit(1).drop("__o")


def default_id(df: DataFrame, id_: str, preferred: Column, order: str) -> DataFrame:
    """One row: the first preferred id, else the first."""
    return df.agg(F.min_by(id_, F.struct((~preferred).alias("a"), F.col(order).alias("b"))).alias(id_))


def evidence_of(nodes: DataFrame, evidence: DataFrame) -> DataFrame:
    return nodes.join(evidence, "evidence_id", "left")

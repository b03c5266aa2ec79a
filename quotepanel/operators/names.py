"""Name dimension and the enriched panel."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from quotepanel.functions.text import label


def name_dim(staging: DataFrame) -> DataFrame:
    """Lexically greatest name per code."""
    return staging.groupBy("cur_unit").agg(F.max("cur_nm").alias("cur_nm"))


def enrich(mart: DataFrame, staging: DataFrame) -> DataFrame:
    """Mart rows with their name, NULL where there is none.

    No broadcast hint: the dimension grows with the codes. A mart fresh from
    its window is already partitioned by code, as is the dimension.
    """
    return mart.join(name_dim(staging), "cur_unit", "left")


def labelled(panel: DataFrame) -> DataFrame:
    """Enriched panel with ``cur_unit`` replaced by ``CODE(NAME)``."""
    return panel.withColumn("cur_unit", label(F.col("cur_unit"), F.col("cur_nm")))


def display(rows: DataFrame, panel: DataFrame, *order: Column) -> DataFrame:
    """Result rows under their labels, sorted by ``order`` and label, for the edge where people read them."""
    named = labelled(enrich(rows, panel)).drop("cur_nm")
    return named.orderBy(*order, F.asc("cur_unit")) if order else named


def display_pairs(pairs: DataFrame, panel: DataFrame) -> DataFrame:
    """Pairs of codes under their labels on both sides, in the order of the labels."""
    named = pairs
    for side in ("code_a", "code_b"):
        names = name_dim(panel).select(F.col("cur_unit").alias("of"), "cur_nm")
        joined = named.join(names, F.col(side) == F.col("of"), "left")
        named = joined.withColumn(side, label(F.col(side), F.col("cur_nm"))).select(*pairs.columns)
    return named.orderBy("code_a", "code_b")

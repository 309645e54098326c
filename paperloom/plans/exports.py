"""Queries over raw recognition exports (problem 4)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.nested import export_objects, typed_objects
from ..session import table


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return export_objects(table(spark, d, "ocr_exports"), values=False).select("export_id", "path", "parent_path")


def p4_objects(spark: SparkSession, d: str) -> DataFrame:
    """Every object with its own members, geometry in one form."""
    return typed_objects(export_objects(table(spark, d, "ocr_exports")))


QUERIES = {"p4_found": p4_found, "p4_objects": p4_objects}

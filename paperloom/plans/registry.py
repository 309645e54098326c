"""Every core query by name, with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import documents, exports, relational

FLAGSHIP = "resolve_lines"
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {**documents.QUERIES, **relational.QUERIES, **exports.QUERIES}
SQL: dict[str, str] = {**documents.SQL, **relational.SQL}

"""The registered queries and, where SQL can express them, the same in SQL for an independent engine."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable
from functools import wraps
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


def ship(spark: SparkSession) -> None:
    """Gives the executors this package, once a session, so that its functions can be loaded there."""
    sc = spark.sparkContext
    if getattr(sc, "_clipstrata", False):
        return
    root = Path(__file__).resolve().parent.parent
    path = Path(tempfile.mkdtemp(prefix="clipstrata-")) / "clipstrata.zip"  # the driver serves it from here
    with zipfile.ZipFile(path, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    sc.addPyFile(str(path))
    sc._clipstrata = True


def shipped(f: Query) -> Query:
    @wraps(f)
    def run(spark: SparkSession, where: str) -> DataFrame:
        ship(spark)
        return f(spark, where)

    return run


class Registry:
    """Queries by name, each with its SQL or none."""

    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.sql: dict[str, str] = {}

    def add(self, name: str, sql: str | None = None) -> Callable[[Query], Query]:
        def put(f: Query) -> Query:
            if name in self.queries:
                raise ValueError(f"two queries are named {name}")
            self.queries[name] = shipped(f)
            if sql:
                self.sql[name] = sql
            return f

        return put

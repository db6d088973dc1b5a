"""All registered queries of the library's own operators, with the SQL that gives the same rows.

A query's inputs are derived from the given tables by SQL that both engines read; the operators of the
library work on them in Spark, the oracle repeats the whole in SQL.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def derive(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    """A SELECT whose {table} names are the given tables."""
    names = set(re.findall(r"\{(\w+)\}", text))
    return spark.sql(text, **{n: table(spark, sf_dir, n) for n in names})


def plain(text: str) -> str:
    """The same SELECT for the oracle."""
    return re.sub(r"\{(\w+)\}", r"\1", text)


def query(sql: str | None = None, **views: str) -> Callable:
    """Registers a function under its name; views are put in front of the oracle as common tables."""

    def add(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            head = ", ".join(f"{n} AS ({plain(t)})" for n, t in views.items())
            body = sql.strip()
            if head:
                body = f"WITH {head}, {body[4:].lstrip()}" if body[:4].upper() == "WITH" else f"WITH {head} {body}"
            ORACLES[fn.__name__] = plain(body).replace("@@", "{}")  # @@ stands for the braces of format()
        return fn

    return add


from stintlake.plans import q_features, q_ledger, q_sources, q_values  # noqa: E402, F401

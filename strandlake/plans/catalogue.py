"""Registry of queries: a name, a Spark callable and, where SQL can say it, its SQL.

The driver tables play these parts: ``events`` is a sensor log (user = episode,
type = topic, value and props.k = a two-element state), ``embeddings`` a table
of vectors (label = episode, vec_id = frame), ``conversations`` ragged episodes
with text, ``orders`` and ``lineitem`` fact tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import micros

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}

#: Common table of the events' SQL.
EVENTS = "e AS (SELECT event_id, user_id, event_type, value, epoch_us(ts) AS t, CAST(json_extract(props, '$.k') AS DOUBLE) AS k FROM events)"
MINUTE = 60_000_000
BY, ON, ORDER = ["user_id"], "t", ["event_id"]


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function's name."""

    def wrap(fn: Query) -> Query:
        key = name or fn.__name__
        if key in QUERIES:
            raise ValueError(f"query {key!r} is there already")
        QUERIES[key] = fn
        if sql:
            ORACLE_SQL[key] = sql.replace("$EVENTS", EVENTS)
        return fn

    return wrap


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select("event_id", "user_id", "event_type", "value", micros(F.col("ts")).alias("t"), F.get_json_object("props", "$.k").cast("double").alias("k"))


def topic(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    return events(spark, sf_dir).filter(F.col("event_type") == kind)


def r6(c):
    return F.round(c, 6)

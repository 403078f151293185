"""Names of the queries, their builders and the SQL each is checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gleaner.sources.tables import Tables, with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, views: tuple[str, ...] = ()):
    """Register ``build(tables) -> DataFrame`` under its function name. ``sql`` may use the
    derived ``views``; without ``sql`` only the shape of the result can be checked."""

    def register(build: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            # epoch texts and calendar days are defined in UTC, whatever the caller's session says
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return build(Tables(spark, sf_dir))

        run.__doc__ = build.__doc__
        QUERIES[build.__name__] = run
        if sql is not None:
            text = sql.strip()
            if views:
                prefix = with_views(*views)
                if text.upper().startswith("WITH RECURSIVE"):
                    text = "WITH RECURSIVE" + prefix[len("WITH"):] + ", " + text[len("WITH RECURSIVE"):]
                elif text.upper().startswith("WITH"):
                    text = prefix + ", " + text[len("WITH"):]
                else:
                    text = prefix + " " + text
            ORACLES[build.__name__] = text
        return build

    return register

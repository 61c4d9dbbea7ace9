"""Where queries are listed with the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Lists a function as a query under its name; ``sql`` gives the same rows in DuckDB."""

    def put(f: Query) -> Query:
        if f.__name__ in QUERIES:
            raise ValueError(f"{f.__name__} is listed already")
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return put


def record_sql(column: str) -> str:
    """SQL: the readable record in a text column, also out of a JSON string."""
    j = f"TRY_CAST({column} AS JSON)"
    return f"(CASE WHEN json_type({j}) = 'VARCHAR' THEN TRY_CAST(json_extract_string({j}, '$') AS JSON) ELSE {j} END)"


def spelled_asset_sql(column: str) -> str:
    """SQL: the canonical spelling of an asset's uid."""
    return rf"nullif(replace(regexp_replace(regexp_replace(lower(regexp_replace({column}, '^\s+|\s+$', '', 'g')), '\.glb$', ''), '^objaverse[:/]', ''), '-', ''), '')"


def spelled_scene_sql(column: str) -> str:
    """SQL: the canonical spelling of a scene's id."""
    return rf"nullif(replace(regexp_replace(regexp_replace(lower(trim({column})), '^.*[/\\]', ''), '(\.scene_instance)?\.json$', ''), '_', '-'), '')"

"""The SQL surface: stored tables as views, and functions that SQL defines and Catalyst inlines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ratingloom.functions.scalars import MILLISECONDS_FROM
from ratingloom.sources.versions import names_below

#: Scalar functions by name: parameters, type and body. They say what ``functions.scalars`` says.
SCALARS = {
    "norm_epoch": ("ts bigint", "bigint", f"case when ts >= {MILLISECONDS_FROM} then floor(ts / 1000) else ts end"),
    "year_month": (
        "ts bigint",
        "int",
        "year(date_from_unix_date(cast(floor({p}norm_epoch(ts) / 86400) as int))) * 100"
        " + month(date_from_unix_date(cast(floor({p}norm_epoch(ts) / 86400) as int)))",
    ),
    "half_star_bin": ("score double", "double", "floor(score / 0.5D + 0.5D) / 2"),
    "contains_ci": ("text string, part string", "boolean", "contains(lower(text), lower(part))"),
    "dot": (
        "a array<double>, b array<double>",
        "double",
        "aggregate(zip_with(a, b, (x, y) -> x * y), 0D, (total, x) -> total + x)",
    ),
    "cosine": ("a array<double>, b array<double>", "double", "try_divide({p}dot(a, b), sqrt({p}dot(a, a)) * sqrt({p}dot(b, b)))"),
    "log10_count": ("n bigint", "double", "log10(cast(greatest(1, coalesce(n, 1)) as double))"),
}

#: Table functions over the views ``rating`` and ``movie``: parameters, columns and body.
TABLES = {
    "rate_more": ("", "mid int, count bigint", "select mid, count(*) as count from {p}rating group by mid"),
    "rating_months": (
        "",
        "mid int, score double, yearmonth int",
        "select mid, score, {p}year_month(ts) as yearmonth from {p}rating",
    ),
    "rate_more_recently": (
        "",
        "mid int, num bigint, yearmonth int",
        "select mid, count(*) as num, yearmonth from {p}rating_months() group by yearmonth, mid",
    ),
    "average_score": ("", "mid int, avg double", "select mid, avg(score) as avg from {p}rating group by mid"),
    "items_of_genre": (
        "genre string",
        "mid int, name string, avg double",
        "select m.mid, m.name, a.avg from {p}movie m join {p}average_score() a on a.mid = m.mid"
        " where {p}contains_ci(m.genres, genre)",
    ),
}


def register_functions(spark: SparkSession, prefix: str = "") -> list[str]:
    """Temporary SQL functions for the session; returns their names."""
    for name, (parameters, kind, body) in SCALARS.items():
        text = body.replace("{p}", prefix)
        spark.sql(f"create or replace temporary function {prefix}{name}({parameters}) returns {kind} return {text}")
    return [f"{prefix}{name}" for name in SCALARS]


def register_table_functions(spark: SparkSession, prefix: str = "") -> list[str]:
    """Temporary table functions over the session's views ``rating`` and ``movie``; returns their names."""
    for name, (parameters, columns, body) in TABLES.items():
        text = body.replace("{p}", prefix)
        spark.sql(f"create or replace temporary function {prefix}{name}({parameters}) returns table({columns}) return {text}")
    return [f"{prefix}{name}" for name in TABLES]


def register_views(spark: SparkSession, tables: dict[str, DataFrame] | str, prefix: str = "") -> list[str]:
    """Expose tables as temporary views for SQL; returns their names.

    ``tables`` are frames by name, or a folder whose Parquet files and folders are the tables.
    """
    if isinstance(tables, str):
        names = [n for n in names_below(spark, tables) if not n.startswith(("_", "."))]
        tables = {n.removesuffix(".parquet"): spark.read.parquet(f"{tables}/{n}") for n in names}
    for name, table in tables.items():
        table.createOrReplaceTempView(f"{prefix}{name}")
    return sorted(f"{prefix}{name}" for name in tables)

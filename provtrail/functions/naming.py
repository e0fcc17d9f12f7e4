"""Job names as native column expressions (no UDF)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

MAX_LENGTH = 64
HASH_LENGTH = 8


def sanitized(text: Column | str) -> Column:
    """ASCII letters and digits; runs of separators become one ``_``; the rest is dropped."""
    kept = F.regexp_replace(text, "[^A-Za-z0-9_\\- .,;]", "")
    return F.regexp_replace(F.regexp_replace(kept, "[_\\- .,;]+", "_"), "^_|_$", "")


def sanitize(df: DataFrame, col: str, out: str = "part") -> DataFrame:
    return df.withColumn(out, sanitized(F.col(col)))


def short_hash(query: Column | str, fallback: Column | str | None = None) -> Column:
    """First eight hex digits of SHA-256 of the query text, or of ``fallback`` without one."""
    text = F.col(query) if isinstance(query, str) else query
    if fallback is not None:
        text = F.coalesce(text, F.col(fallback) if isinstance(fallback, str) else fallback)
    return F.substring(F.sha2(text, 256), 1, HASH_LENGTH)


def query_hash(df: DataFrame, query: str, fallback: str | None = None, out: str = "hash8") -> DataFrame:
    return df.withColumn(out, short_hash(query, fallback))


def job_name(statement: Column | str, tables: Column | str, hash8: Column | str,
             max_length: int = MAX_LENGTH) -> Column:
    """``TYPE[_table...]_hash8``.

    Table parts are added while the prefix fits; the first that does not fit ends the list.
    Parts that are empty after sanitizing are skipped.
    """
    statement, tables, hash8 = (F.col(c) if isinstance(c, str) else c for c in (statement, tables, hash8))
    room = max_length - HASH_LENGTH - 1
    parts = F.filter(F.transform(tables, sanitized), lambda p: p != "")
    start = F.struct(statement.alias("name"), F.lit(False).alias("full"))

    def add(acc, part):
        full = acc["full"] | (F.length(acc["name"]) + 1 + F.length(part) > room)
        return F.struct(
            F.when(full, acc["name"]).otherwise(F.concat_ws("_", acc["name"], part)).alias("name"), full.alias("full"))

    prefix = F.aggregate(F.coalesce(parts, F.array().cast("array<string>")), start, add, lambda a: a["name"])
    return F.concat_ws("_", prefix, hash8)

"""Dataset identity as native column expressions (no UDF)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F

from provtrail.functions.binding import let

# Fixed values.
OBJECT_STORE_SCHEMES = ("s3", "gs", "abfss", "wasbs", "hdfs")
MEMORY_NAMES = (":memory:", "duckdb_memory")
PLACEHOLDER = "-__PLACEHOLDER__"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _dataset(namespace: Column, name: Column) -> Column:
    return F.struct(namespace.alias("namespace"), name.alias("name"))


def split_path(path: Column | str) -> Column:
    """Path or URI to a struct (namespace, name)."""
    return let(F.coalesce(_col(path), F.lit("")), _split_path)


def _split_path(path: Column) -> Column:
    at = F.locate("://", path)
    scheme = F.when(F.substring_index(path, "://", 1) == "s3a", "s3").otherwise(
        F.substring_index(path, "://", 1))
    rest = path.substr(at + 3, F.length(path))
    slash = F.locate("/", rest)
    authority = F.substring_index(rest, "/", 1)
    key = F.when(slash == 0, "").otherwise(rest.substr(slash + 1, F.length(rest)))
    file_ns = F.lit("file")
    return (
        F.when(path == "", _dataset(file_ns, F.lit("unknown")))
        .when(at == 0, _dataset(file_ns, path))
        .when(scheme == "file", _dataset(file_ns, rest))
        .when(scheme.isin(*OBJECT_STORE_SCHEMES), _dataset(F.concat(scheme, F.lit("://"), authority), key))
        .otherwise(_dataset(file_ns, path))
    )


def normalize_paths(df: DataFrame, col: str) -> DataFrame:
    """Add ``namespace`` and ``name`` for the raw path in ``col``."""
    return df.withColumn("_id", split_path(col)).withColumns(
        {"namespace": F.col("_id.namespace"), "name": F.col("_id.name")}).drop("_id")


def qualified_name(*parts: Column | str) -> Column:
    """``catalog.schema.table``; a NULL part makes the name NULL."""
    cols = [_col(p) for p in parts]
    return F.concat(*[c for i, p in enumerate(cols) for c in ([F.lit(".")] if i else []) + [p]])


def qualified_name_dropping(*parts: Column | str) -> Column:
    """As ``qualified_name`` but NULL or empty parts are left out (DROP and ALTER)."""
    return F.concat_ws(".", *[F.when(_col(p) != "", _col(p)) for p in parts])


def qualify(df: DataFrame, catalog: str, schema: str, table: str, drop_null_catalog: bool = False) -> DataFrame:
    """Add ``name``: the qualified dataset name of each row."""
    fn = qualified_name_dropping if drop_null_catalog else qualified_name
    return df.withColumn("name", fn(catalog, schema, table))


def is_connection_string(text: Column | str) -> Column:
    """True for ``postgres:`` texts and for texts with host= and port= at a word start.

    Only the first occurrence of each key counts.
    """
    text = _col(text)

    def word_start(key):
        at = F.locate(key, text)
        return (at > 0) & ((at == 1) | (text.substr(at - 1, F.lit(1)) == " "))

    return text.startswith("postgres:") | (word_start("host=") & word_start("port="))


def redact_connection(text: Column | str) -> Column:
    """Connection string to ``postgres://host[:port][/db]``: no user, no password.

    Without a host the text comes back as it is but for its user and password.
    """
    text = _col(text)
    body = F.when(text.startswith("postgres:"), text.substr(F.lit(10), F.length(text))).otherwise(text)
    tokens = F.transform(F.split(body, " ", -1), lambda t: F.regexp_replace(t, "^\t+", ""))

    def value(key):
        # The last non-empty assignment of a key wins.
        hits = F.filter(tokens, lambda t: t.rlike(f"^{key}[\t\r\n]*=(?s:.)"))
        raw = F.get(F.reverse(hits), F.lit(0))
        return F.nullif(F.regexp_replace(
            raw.substr(F.locate("=", raw) + 1, F.length(raw)), "^[ \t\r\n]+|[ \t\r\n]+$", ""), F.lit(""))

    host, port, db = value("host"), value("port"), value("dbname")
    uri = F.concat(
        F.lit("postgres://"), host,
        F.coalesce(F.concat(F.lit(":"), port), F.lit("")),
        F.coalesce(F.concat(F.lit("/"), db), F.lit("")))
    return F.coalesce(uri, F.regexp_replace(without_login(text), SECRETS, "$1"))


# A user or a password in a connection string, quoted or not.
SECRETS = r"(?i)(^|[ :])[ ]*(?:user|password|passfile|sslpassword)[\t\r\n]*=(?:'(?:[^'\\]|\\.)*'|[^ ]*)"


def without_login(uri: Column) -> Column:
    """A URI without ``user:password@``, and for databases also without ``user@``.

    Stores that name a container before the ``@`` (``abfss://container@account``) keep it.
    """
    plain = F.regexp_replace(uri, r"^((?:[a-z]+:)?(?:postgres|postgresql|mysql|mariadb|mongodb|redis)://)[^?#\s]*@", "$1")
    return F.regexp_replace(plain, r"^([A-Za-z][A-Za-z0-9+.:-]*://)[^/@:]*:[^/]*@", "$1")


def redact_conn_strings(df: DataFrame, col: str, out: str = "uri") -> DataFrame:
    """Rewrite the connection strings in ``col``; other texts stay as they are."""
    return df.withColumn(out, F.when(is_connection_string(col), redact_connection(col)).otherwise(F.col(col)))


def source_uri(path: Column | str) -> Column:
    """Data-source path to URI."""
    path = _col(path)
    return (
        F.when((path == "") | path.isin(*MEMORY_NAMES), path)
        .when(is_connection_string(path), redact_connection(path))
        .when(path.contains("://"), without_login(path))
        .otherwise(F.concat(F.lit("file://"), path))
    )


def metadata_uri(path: Column | str) -> Column:
    """Catalog metadata path to URI; ``x:`` before the first ``/`` is kept as a scheme."""
    path = _col(path)
    colon, slash = F.locate(":", path), F.locate("/", path)
    return (
        F.when(path == "", path)
        .when(is_connection_string(path), redact_connection(path))
        .when(path.contains("://"), without_login(path))
        .when((colon > 0) & ((slash == 0) | (colon < slash)), path)
        .otherwise(F.concat(F.lit("file://"), path))
    )


def format_source_uri(df: DataFrame, col: str, out: str = "uri") -> DataFrame:
    return df.withColumn(out, source_uri(col))


def format_metadata_uri(df: DataFrame, col: str, out: str = "uri") -> DataFrame:
    return df.withColumn(out, metadata_uri(col))


def split_location(location: Column | str, table: Column | str, schema: Column | str) -> Column:
    """Warehouse location of a table to a struct (namespace, name).

    The table folder and then a database folder are taken off the end; what is left is the
    namespace and what was taken off is the name.
    """
    location, table, schema = _col(location), _col(table), F.coalesce(_col(schema), F.lit(""))
    clean = F.regexp_replace(F.regexp_replace(F.substring_index(location, PLACEHOLDER, 1), "^s3a://", "s3://"), "/$", "")

    def without_last(parts: Column, test) -> Column:
        take = F.when((F.size(parts) > 2) & test(F.element_at(parts, -1)), 1).otherwise(0)
        return F.slice(parts, F.lit(1), F.size(parts) - take)

    def named(parts: Column, kept: Column) -> Column:
        bucket = F.concat(F.element_at(kept, 1), F.lit("//"), F.get(kept, F.lit(2)))
        # Two parts left over hold no bucket.
        namespace = F.when(F.size(kept) < 3, F.array_join(kept, "/")).otherwise(F.array_join(
            F.concat(F.array(bucket), F.slice(kept, F.lit(4), F.greatest(F.size(kept) - 3, F.lit(0)))), "/"))
        return _dataset(namespace, F.array_join(F.slice(parts, F.size(kept) + 1, F.size(parts)), "/"))

    def of_parts(parts: Column) -> Column:
        kept = let(
            without_last(parts, lambda s: s.contains(table)),
            lambda rest: without_last(rest, lambda s: s.endswith(".db") | ((schema != "") & (s == schema))))
        return F.when(F.size(parts) >= 3, let(kept, lambda k: named(parts, k))).otherwise(
            _dataset(F.array_join(parts, "/"), table))

    return let(F.split(clean, "/", -1), of_parts)


def split_table_location(df: DataFrame, location: str, table: str, schema: str) -> DataFrame:
    """Add ``namespace`` and ``name`` for a warehouse table location."""
    return df.withColumn("_id", split_location(location, table, schema)).withColumns(
        {"namespace": F.col("_id.namespace"), "name": F.col("_id.name")}).drop("_id")


def namespace_of(data_path: Column | str, default: str) -> Column:
    """Data path without one trailing slash, else the default namespace."""
    path = _col(data_path)
    return F.coalesce(F.nullif(F.regexp_replace(path, "/$", ""), F.lit("")), F.lit(default))


def resolve_namespace(df: DataFrame, data_path: str, default: str) -> DataFrame:
    return df.withColumn("namespace", namespace_of(data_path, default))


def classify_catalogs(df: DataFrame, framework: str = "spark") -> DataFrame:
    """Classify catalogs of a registry table.

    Input columns: name, kind (system, temporary, native, lake or an extension's own name;
    NULL when it could not be read), db_path, in_memory, is_initial, is_read_only, data_path.
    """
    special = F.col("kind").isin("system", "temporary")
    memory = F.coalesce(F.col("in_memory"), F.lit(True)) | (F.coalesce(F.col("db_path"), F.lit("")) == "") | (
        F.col("db_path") == ":memory:")
    kind = (
        F.when(special, F.col("kind"))
        .when(memory, "memory")
        .when(F.col("kind").isNull(), "unknown")
        .when(F.col("kind") != "native", F.col("kind"))
        .when(F.col("is_initial"), "native")
        .when(F.col("is_read_only"), "attached_readonly")
        .otherwise("attached")
    )
    uri = (
        F.when(kind == "system", F.concat(F.lit(framework), F.lit(":system")))
        .when(kind.isin("temporary", "memory"), F.concat(F.lit(framework), F.lit(":memory")))
        .when(kind != "unknown", metadata_uri("db_path"))
    )
    native = kind.isin("native", "attached", "attached_readonly")
    warehouse = F.when(native, uri).when(
        kind == "lake", F.nullif(F.regexp_replace("data_path", "/$", ""), F.lit("")))
    return df.select(
        "*", F.lit(framework).alias("framework"), kind.alias("type"), uri.alias("metadata_uri"),
        warehouse.alias("warehouse_uri"), F.lit(framework).alias("source"))


def parse_prefixes(text: str | Iterable[str]) -> list[str]:
    """Comma list of prefixes: trimmed, empty ones dropped."""
    parts = text.split(",") if isinstance(text, str) else list(text)
    return [p for p in (q.strip(" \t\r\n") for q in parts) if p]

"""Writes that leave a trace: a plan-log row before, a run row after."""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from provtrail.functions.ids import split_path
from provtrail.plans.capture import capture, plan_log

RUN_DDL = """query_id string, run_id string, started timestamp, ended timestamp, event_type string,
    row_count bigint, size_bytes bigint, error string"""


@dataclass
class TraceLog:
    """A folder with the plan log and the run outcomes of traced writes."""

    spark: SparkSession
    root: str

    def plans(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/plan_log")

    def runs(self) -> DataFrame:
        return self.spark.read.schema(RUN_DDL).parquet(f"{self.root}/runs")

    def _traced(
        self, df: DataFrame, op: str, namespace: str | None, name: str, query: str | None, write,
        size=None, overwrites: bool = False, prev_name: str | None = None,
    ) -> dict:
        """Log the plan, run ``write`` on the observed frame, log the outcome.

        ``size()`` gives the bytes under the sink; what a write added is told by asking before and after.
        """
        query_id, run_id = str(uuid.uuid4()), str(uuid.uuid4())
        started = _now()
        row = capture(df, query_id, query, op, namespace, name, started, prev_name=prev_name)
        plan_log(self.spark, [row]).coalesce(1).write.mode("append").parquet(f"{self.root}/plan_log")
        seen = Observation()
        kind, rows, written, error = "COMPLETE", None, None, None
        try:
            before = 0 if overwrites or not size else size()
            write(df.observe(seen, F.count(F.lit(1)).alias("n")))
            if size:
                rows, written = seen.get.get("n"), size() - before
        except Exception as e:
            kind, error = "FAIL", str(e)
            raise
        finally:
            outcome = (query_id, run_id, started, _now(), kind, rows, written, error)
            self.spark.createDataFrame([outcome], RUN_DDL).coalesce(1).write.mode("append").parquet(f"{self.root}/runs")
        return {"query_id": query_id, "run_id": run_id, "row_count": rows, "size_bytes": written}

    def write(self, df: DataFrame, path: str, fmt: str = "parquet", query: str | None = None, **options) -> dict:
        """Export to files: the output is overwritten."""
        def run(d):
            d.write.mode("overwrite").format(fmt).options(**options).save(path)

        dataset = self.spark.range(1).select(split_path(F.lit(path)).alias("d")).first().d
        return self._traced(df, "COPY", dataset.namespace, dataset.name, query, run, lambda: self._bytes(path), overwrites=True)

    def append(self, df: DataFrame, table: str, query: str | None = None) -> dict:
        """Insert into an existing table."""
        return self._traced(
            df, "INSERT", None, self._qualified(table), query, lambda d: d.write.mode("append").saveAsTable(table),
            lambda: self._table_bytes(table))

    def create(self, df: DataFrame, table: str, query: str | None = None, fmt: str = "parquet", **options) -> dict:
        """Create a table from a query."""
        return self._traced(df, "CREATE_TABLE", None, self._qualified(table), query,
                            lambda d: d.write.format(fmt).options(**options).saveAsTable(table), lambda: self._table_bytes(table))

    def create_view(self, name: str, query: str, temporary: bool = False) -> dict:
        """Define a view by a query, or define it anew; its columns are traced like those of a table."""
        kind = "TEMPORARY VIEW" if temporary else "VIEW"
        return self._traced(self.spark.sql(query), "CREATE_VIEW", None, name if temporary else self._qualified(name), query,
                            lambda _: self.spark.sql(f"CREATE OR REPLACE {kind} {name} AS {query}"))

    def rename(self, table: str, new_name: str) -> dict:
        """Rename a table; the event names the previous one."""
        return self._statement("RENAME", new_name, f"ALTER TABLE {table} RENAME TO {new_name}", self._qualified(table))

    def drop(self, name: str, view: bool = False) -> dict:
        return self._statement("DROP_VIEW" if view else "DROP", name, f"DROP {'VIEW' if view else 'TABLE'} {name}")

    def truncate(self, table: str) -> dict:
        return self._statement("TRUNCATE", table, f"TRUNCATE TABLE {table}")

    def delete(self, table: str, condition: str) -> dict:
        """Delete rows, where the table's format can."""
        return self._statement("DELETE", table, f"DELETE FROM {table} WHERE {condition}")

    def update(self, table: str, assignments: str, condition: str = "true") -> dict:
        """Update rows, where the table's format can."""
        return self._statement("UPDATE", table, f"UPDATE {table} SET {assignments} WHERE {condition}")

    def _statement(self, op: str, name: str, statement: str, prev_name: str | None = None) -> dict:
        """Run a statement that writes no query's rows. Its plan has the table's columns and reads nothing."""
        source = prev_name or name
        fields = self.spark.table(source).schema.fields if self.spark.catalog.tableExists(source) else []
        columns = ", ".join(f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`" for f in fields)
        return self._traced(self.spark.sql(f"SELECT {columns or 'NULL'}"), op, None, self._qualified(name), statement,
                            lambda _: self.spark.sql(statement), prev_name=prev_name)

    def _table_bytes(self, table: str) -> int:
        if not self.spark.catalog.tableExists(table):
            return 0
        rows = self.spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter("col_name = 'Location'").collect()
        return self._bytes(rows[0].data_type) if rows else 0

    def _bytes(self, path: str) -> int:
        """Size of the files under a path, as Spark lists them; no content is read."""
        files = self.spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
        return files.agg(F.sum("length")).first()[0] or 0

    def _qualified(self, table: str) -> str:
        """``catalog.schema.table``, as scans name the table."""
        parts = table.replace("`", "").split(".")
        here = [self.spark.catalog.currentCatalog(), self.spark.catalog.currentDatabase()]
        return ".".join(here[:max(0, 3 - len(parts))] + parts)


def _now() -> datetime:
    return datetime.now(timezone.utc)

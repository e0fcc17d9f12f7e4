"""Fixed schemas and constants of run events and plan logs."""

from __future__ import annotations

PRODUCER = "https://example.org/provtrail"

# Facet schema URLs published by the OpenLineage specification.
EVENT_SCHEMA_URL = "https://openlineage.io/spec/2-0-2/OpenLineage.json#/$defs/RunEvent"
FACET_SCHEMA_URLS = {
    "sql": "https://openlineage.io/spec/job/sql/1-0-0.json",
    "parent": "https://openlineage.io/spec/facets/1-0-0/ParentRunFacet.json",
    "errorMessage": "https://openlineage.io/spec/facets/1-0-0/ErrorMessageRunFacet.json",
    "processing_engine": "https://openlineage.io/spec/facets/1-1-1/ProcessingEngineRunFacet.json",
    "outputStatistics": "https://openlineage.io/spec/facets/1-0-0/OutputStatisticsOutputDatasetFacet.json",
    "schema": "https://openlineage.io/spec/facets/1-0-0/SchemaDatasetFacet.json",
    "symlinks": "https://openlineage.io/spec/facets/1-0-1/SymlinksDatasetFacet.json",
    "dataSource": "https://openlineage.io/spec/facets/1-0-0/DatasourceDatasetFacet.json",
    "catalog": "https://openlineage.io/spec/facets/1-0-0/CatalogDatasetFacet.json",
    "lifecycleStateChange": "https://openlineage.io/spec/facets/1-0-0/LifecycleStateChangeDatasetFacet.json",
    "datasetType": "https://openlineage.io/spec/facets/1-0-0/DatasetTypeDatasetFacet.json",
    "columnLineage": "https://openlineage.io/spec/facets/1-1-1/ColumnLineageDatasetFacet.json",
}

EVENT_TYPES = ("START", "COMPLETE", "FAIL")
DEFAULT_NAMESPACE = "spark"

_HEAD = "_producer: string, _schemaURL: string"
FIELD = "struct<name: string, type: string>"
COLUMN_SOURCE = "struct<namespace: string, name: string, field: string>"
DATASET_FACETS = f"""struct<
    schema: struct<{_HEAD}, fields: array<{FIELD}>>,
    dataSource: struct<{_HEAD}, name: string, uri: string>,
    catalog: struct<{_HEAD}, framework: string, type: string, name: string,
        metadataUri: string, warehouseUri: string, source: string>,
    datasetType: struct<{_HEAD}, datasetType: string, subType: string>,
    lifecycleStateChange: struct<{_HEAD}, lifecycleStateChange: string,
        previousIdentifier: struct<namespace: string, name: string>>,
    symlinks: struct<{_HEAD}, identifiers: array<struct<namespace: string, name: string, type: string>>>,
    columnLineage: struct<{_HEAD}, fields: map<string,
        struct<inputFields: array<{COLUMN_SOURCE}>, transformationType: string>>>>"""
OUTPUT_FACETS = f"struct<outputStatistics: struct<{_HEAD}, rowCount: bigint, sizeInBytes: bigint>>"
INPUT_DATASET = f"struct<namespace: string, name: string, facets: {DATASET_FACETS}>"
OUTPUT_DATASET = (
    f"struct<namespace: string, name: string, facets: {DATASET_FACETS}, outputFacets: {OUTPUT_FACETS}>"
)
RUN_FACETS = f"""struct<
    parent: struct<{_HEAD}, run: struct<runId: string>, job: struct<namespace: string, name: string>>,
    errorMessage: struct<{_HEAD}, message: string, programmingLanguage: string>,
    processing_engine: struct<{_HEAD}, version: string, name: string, openlineageAdapterVersion: string>>"""

JOB_FACETS = f"struct<sql: struct<{_HEAD}, query: string>>"

EVENT_DDL = f"""
    eventType string, eventTime string, producer string, schemaURL string,
    run struct<runId: string, facets: {RUN_FACETS}>,
    job struct<namespace: string, name: string, facets: {JOB_FACETS}>,
    inputs array<{INPUT_DATASET}>,
    outputs array<{OUTPUT_DATASET}>
"""

# One row per captured query. ``files`` lists, per scan leaf in plan order, its paths; ``sink_fields``
# are the columns written; ``prev_ns`` and ``prev_name`` are what the sink was called before a rename.
PLAN_LOG_DDL = """
    query_id string, query string, plan_json string,
    files array<struct<leaf: int, paths: array<string>>>,
    sink_op string, sink_ns string, sink_name string, event_time timestamp,
    sink_fields array<struct<name: string, type: string>>, prev_ns string, prev_name string
"""

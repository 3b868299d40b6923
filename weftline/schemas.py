"""Explicit schemas of the JSON documents the library reads."""

_INPUT_FIELD = "STRUCT<namespace: STRING, name: STRING, field: STRING, transformations: ARRAY<STRUCT<type: STRING, subtype: STRING, description: STRING>>>"
_DATASET = (
    "STRUCT<namespace: STRING, name: STRING, facets: STRUCT<"
    "schema: STRUCT<fields: ARRAY<STRUCT<name: STRING, type: STRING>>>, "
    f"columnLineage: STRUCT<fields: MAP<STRING, STRUCT<inputFields: ARRAY<{_INPUT_FIELD}>>>>, "
    "dataQualityAssertions: STRUCT<assertions: ARRAY<STRUCT<assertion: STRING, column: STRING, success: BOOLEAN>>>>>"
)
RUN_EVENT = (
    "eventType STRING, eventTime STRING, run STRUCT<runId: STRING, facets: MAP<STRING, STRING>>, "
    "job STRUCT<namespace: STRING, name: STRING, facets: MAP<STRING, STRING>>, "
    f"inputs ARRAY<{_DATASET}>, outputs ARRAY<{_DATASET}>, producer STRING, schemaURL STRING"
)
#: The same with every facet as a variant under its name.
_OPEN_DATASET = "STRUCT<namespace: STRING, name: STRING, facets: MAP<STRING, VARIANT>>"
OPEN_RUN_EVENT = (
    "eventType STRING, eventTime STRING, run STRUCT<runId: STRING, facets: MAP<STRING, VARIANT>>, "
    "job STRUCT<namespace: STRING, name: STRING, facets: MAP<STRING, VARIANT>>, "
    f"inputs ARRAY<{_OPEN_DATASET}>, outputs ARRAY<{_OPEN_DATASET}>, producer STRING, schemaURL STRING"
)
MANIFEST = (
    "nodes MAP<STRING, STRUCT<name: STRING, resource_type: STRING, depends_on: STRUCT<nodes: ARRAY<STRING>>, columns: MAP<STRING, STRING>>>, "
    "sources MAP<STRING, STRUCT<name: STRING, source_name: STRING>>, "
    "exposures MAP<STRING, STRUCT<name: STRING, type: STRING>>, parent_map MAP<STRING, ARRAY<STRING>>"
)
SNAPSHOT_LOG = (
    "table STRING, snapshots ARRAY<STRUCT<`snapshot-id`: BIGINT, `timestamp-ms`: BIGINT, operation: STRING, summary: MAP<STRING, STRING>>>"
)
STATES = ["START", "RUNNING", "COMPLETE", "FAIL", "ABORT"]
EVENT_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"

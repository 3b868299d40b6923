"""Run events: reading, counting bad ones, and turning them into node, edge and column rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.schemas import OPEN_RUN_EVENT, RUN_EVENT


def read_run_events(spark: SparkSession, path: str, all_facets: bool = False) -> DataFrame:
    """Newline-delimited run events; a malformed line keeps its text in ``_corrupt_record``.

    Datasets come with the facets the graph operators read, as structs. With ``all_facets`` every facet of runs, jobs and
    datasets comes as a variant under its name instead (see ``facets``).
    """
    return (
        spark.read.schema((OPEN_RUN_EVENT if all_facets else RUN_EVENT) + ", _corrupt_record STRING")
        .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record").json(path)
    )


def facets(events: DataFrame) -> DataFrame:
    """(job_namespace, job, owner, id, facet, body): a row for each facet of events read with ``all_facets``.

    ``owner`` is run, job, input or output, ``id`` the run id or the name with its namespace, ``body`` JSON with its keys in order.
    """
    def of(owner: str, id_: str, found: str) -> str:
        return f"transform(map_entries(coalesce({found}, map())), f -> named_struct('owner', '{owner}', 'id', {id_}, 'facet', f.key, 'body', to_json(f.value)))"

    def sides(owner: str, column: str) -> str:
        return f"flatten(transform(coalesce({column}, array()), d -> {of(owner, 'd.namespace || ' + chr(39) + '/' + chr(39) + ' || d.name', 'd.facets')}))"

    job = entity_id("job.namespace", "job.name")
    lists = f"concat({of('run', 'run.runId', 'run.facets')}, {of('job', job, 'job.facets')}, {sides('input', 'inputs')}, {sides('output', 'outputs')})"
    return events.selectExpr("job.namespace AS job_namespace", "job.name AS job", f"inline({lists})")


def facet(owner: str, name: str, path: str, kind: str) -> Column:
    """The value at ``path`` of one facet of a run, job or dataset column read with ``all_facets``; null where it is missing or of another kind."""
    return F.try_variant_get(F.col(f"{owner}.facets")[name], path, kind)


def parse_run_events(docs: DataFrame, column: str = "doc") -> DataFrame:
    """The same from a text column; other columns are kept.

    The parsed struct goes through a generator, so a later filter on its fields reads the
    result instead of parsing the text once more per field.
    """
    parsed = F.from_json(F.col(column), RUN_EVENT + ", _corrupt_record STRING", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
    return docs.select(*[c for c in docs.columns if c != column], F.inline(F.array(parsed)))


def well_formed(events: DataFrame) -> DataFrame:
    return events.filter("_corrupt_record IS NULL").drop("_corrupt_record")


def ingest_counts(events: DataFrame) -> DataFrame:
    """One row: events that can be processed and events that cannot."""
    return events.agg(
        F.count_if(F.col("_corrupt_record").isNull()).alias("success"),
        F.count_if(F.col("_corrupt_record").isNotNull()).alias("failed"))


def entity_id(namespace: str, name: str) -> str:
    return f"coalesce({namespace}, 'default') || '/' || coalesce({name}, 'unknown')"


def event_entities(events: DataFrame) -> DataFrame:
    """One row per job or dataset mention of an event."""
    job = ("array(named_struct('type', 'job', 'role', 'job', 'namespace', coalesce(job.namespace, 'default'), "
           "'name', coalesce(job.name, 'unknown'), 'n_fields', CAST(NULL AS INT)))")

    def datasets(side: str, role: str) -> str:
        return (f"transform(coalesce({side}, array()), d -> named_struct('type', 'dataset', 'role', '{role}', "
                "'namespace', coalesce(d.namespace, 'default'), 'name', coalesce(d.name, 'unknown'), 'n_fields', size(d.facets.schema.fields)))")

    return events.selectExpr(
        "eventType AS state", "eventTime AS event_time", "run.runId AS run_id",
        f"inline(concat({job}, {datasets('inputs', 'input')}, {datasets('outputs', 'output')}))",
    ).selectExpr("namespace || '/' || name AS id", "*")


def event_nodes(events: DataFrame) -> DataFrame:
    """One node for each id: the latest event wins, first and last sighting are kept.

    Events of one time are put in the order of their run, state, type and number of fields, so that the winner
    doesn't depend on the order of rows. Namespace and name follow from the id that they make up.
    """
    last = F.struct("event_time", "run_id", "state", "type", "n_fields")
    return event_entities(events).groupBy("id").agg(
        F.max_by("type", last).alias("type"), F.max_by("namespace", last).alias("namespace"), F.max_by("name", last).alias("name"),
        F.max_by("state", last).alias("last_state"),
        F.max_by("n_fields", last).alias("n_fields"),
        F.max(F.when(F.col("n_fields").isNotNull(), F.struct("event_time", "n_fields")))["n_fields"].alias("known_fields"),
        F.min("event_time").alias("created_at"), F.max("event_time").alias("updated_at"), F.count("*").alias("n_events"))


def event_edge_log(events: DataFrame) -> DataFrame:
    """input -> job and job -> output rows, one per mention."""
    job = entity_id("job.namespace", "job.name")
    return events.selectExpr(
        "eventType AS state", "eventTime AS event_time",
        f"inline(concat(transform(coalesce(inputs, array()), d -> named_struct('src', {entity_id('d.namespace', 'd.name')}, 'dst', {job}, 'type', 'CONSUMED_BY')), "
        f"transform(coalesce(outputs, array()), d -> named_struct('src', {job}, 'dst', {entity_id('d.namespace', 'd.name')}, 'type', 'PRODUCED_BY'))))")


def event_edges(events: DataFrame) -> DataFrame:
    return event_edge_log(events).groupBy("src", "dst", "type").agg(F.count("*").alias("n_events"))


def relationships(events: DataFrame) -> DataFrame:
    """(src, relation, dst): job READS / WRITES dataset and run OF_JOB job."""
    reads = event_edge_log(events).selectExpr(
        "CASE WHEN type = 'CONSUMED_BY' THEN dst ELSE src END AS src",
        "CASE WHEN type = 'CONSUMED_BY' THEN 'READS' ELSE 'WRITES' END AS relation",
        "CASE WHEN type = 'CONSUMED_BY' THEN src ELSE dst END AS dst")
    runs = events.selectExpr("run.runId AS src", "'OF_JOB' AS relation", f"{entity_id('job.namespace', 'job.name')} AS dst")
    return reads.unionByName(runs).distinct()


def latest_run_states(events: DataFrame) -> DataFrame:
    return events.groupBy(F.col("run.runId").alias("run_id")).agg(
        F.max_by("eventType", F.struct("eventTime", "eventType")).alias("state"), F.max("eventTime").alias("event_time"))


def schema_columns(events: DataFrame) -> DataFrame:
    """Distinct (dataset, column_name, column_type) named by schema facets; no type reads as ''."""
    mentions = events.selectExpr("explode(concat(coalesce(inputs, array()), coalesce(outputs, array()))) AS d")
    return mentions.selectExpr(f"{entity_id('d.namespace', 'd.name')} AS dataset", "inline(d.facets.schema.fields)").selectExpr(
        "dataset", "name AS column_name", "coalesce(type, '') AS column_type").distinct()


def facet_column_edges(events: DataFrame) -> DataFrame:
    """Column edges of columnLineage facets, one for each transformation; an undescribed one reads as IDENTITY."""
    fields = events.selectExpr("inline(outputs)").selectExpr(
        f"{entity_id('namespace', 'name')} AS dst_ds", "explode(facets.columnLineage.fields) AS (dst_col, lineage)")
    return fields.selectExpr("dst_ds", "dst_col", "inline(lineage.inputFields)").selectExpr(
        f"{entity_id('namespace', 'name')} AS src_ds", "field AS src_col", "dst_ds", "dst_col",
        "explode_outer(transformations.description) AS step").selectExpr(
        "src_ds", "src_col", "dst_ds", "dst_col", "coalesce(step, 'IDENTITY') AS transformation").distinct()


def run_states(events: DataFrame) -> DataFrame:
    """Run lifecycle: first START, last terminal event, latest state and duration."""
    ended = F.col("state").isin("COMPLETE", "FAIL", "ABORT")
    return events.groupBy("run_id").agg(
        F.max_by("state", F.struct("ts", "event_id")).alias("state"),
        F.min(F.when(F.col("state") == "START", F.col("ts"))).alias("started_at"),
        F.max(F.when(ended, F.col("ts"))).alias("ended_at"),
    ).withColumn("duration_ms", F.expr("timestampdiff(MILLISECOND, started_at, ended_at)"))

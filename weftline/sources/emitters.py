"""Run-event documents built as columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from weftline.schemas import EVENT_TIME_FORMAT


def event_time(column: str) -> Column:
    return F.date_format(column, EVENT_TIME_FORMAT)


def dataset(namespace, name, **facets: Column) -> Column:
    """A dataset entry; facets are given as columns under their keys."""
    parts = [_col(namespace).alias("namespace"), _col(name).alias("name")]
    if facets:
        parts.append(F.struct(*[c.alias(k) for k, c in facets.items()]).alias("facets"))
    return F.struct(*parts)


def schema_facet(fields: Column) -> Column:
    """Every field typed STRING."""
    return F.struct(F.transform(fields, lambda f: F.struct(f.alias("name"), F.lit("STRING").alias("type"))).alias("fields"))


def job_type(processing: str, integration: str, kind) -> Column:
    return F.struct(F.lit(processing).alias("processingType"), F.lit(integration).alias("integration"), _col(kind).alias("jobType"))


def run_event(state, when: Column, namespace, name, inputs: Column, outputs: Column, run_id=None, job_facets=None, run_facets=None, producer=None) -> Column:
    """A run event as JSON text."""
    job = [_col(namespace).alias("namespace"), _col(name).alias("name")]
    if job_facets:
        job.append(F.struct(*[c.alias(k) for k, c in job_facets.items()]).alias("facets"))
    parts = [_col(state).alias("eventType"), when.alias("eventTime"), F.struct(*job).alias("job")]
    run = []
    if run_id is not None:
        run.append(_col(run_id).alias("runId"))
    if run_facets:
        run.append(F.struct(*[c.alias(k) for k, c in run_facets.items()]).alias("facets"))
    if run:
        parts.append(F.struct(*run).alias("run"))
    parts += [inputs.alias("inputs"), outputs.alias("outputs")]
    if producer is not None:
        parts.append(F.lit(producer).alias("producer"))
    return F.to_json(F.struct(*parts))


def _col(value) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def observed(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """A frame that counts its own rows while some later action runs over it."""
    watch = Observation(name)
    return df.observe(watch, F.count(F.lit(1)).alias("rows")), watch


def run_node_logged(name: str, inputs: dict[str, DataFrame], node, output: str, path: str) -> DataFrame:
    """Run ``node(**inputs)``, write its result and return the START / COMPLETE log rows.

    Row counts come from the same job that writes the output, so no input is read twice.
    """
    spark = next(iter(inputs.values())).sparkSession
    watched = {k: observed(df, f"{name}-{k}") for k, df in inputs.items()}
    result, out_watch = observed(node(**{k: df for k, (df, _) in watched.items()}), f"{name}-{output}")
    columns = {k: len(df.columns) for k, df in inputs.items()} | {output: len(result.columns)}
    result.write.mode("overwrite").parquet(path)
    rows = [("START", name, k, "input", 0, columns[k]) for k in inputs]
    rows += [("COMPLETE", name, k, "input", watch.get["rows"], columns[k]) for k, (_, watch) in watched.items()]
    rows.append(("COMPLETE", name, output, "output", out_watch.get["rows"], columns[output]))
    return spark.createDataFrame(rows, "state STRING, node STRING, dataset STRING, role STRING, n_rows BIGINT, n_columns INT")

"""Lineage tables derived from the driver tables.

Every frame is a lazy expression over the Parquet tables, so its size follows theirs.
``plans/oracle_tables.py`` states the same derivations in SQL.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.session import cut_lineage

# Names of the five derived columns and the eight ways a column is derived.
COLUMN_NAMES = ["customer_id", "email", "first_name", "amount", "order_date"]
TRANSFORMATIONS = ["IDENTITY", "RENAME", "CAST", "EXPRESSION", "AGGREGATION", "CONDITIONAL", "FILTER", "JOIN_KEY"]
SCHEMA_NAMES = [
    "customer_id", "email", "first_name", "last_name", "phone", "date_of_birth", "zip_code", "city",
    "ssn", "order_id", "amount", "order_date", "region", "hotel_id", "email_hash", "capacity",
]
STATE_OF = {"signup": "START", "view": "RUNNING", "purchase": "COMPLETE", "error": "FAIL", "click": "ABORT"}
MODEL_NAMES = ["gpt-4-turbo", "gpt-4o", "gpt-3.5-turbo", "claude-3-opus", "claude-3-sonnet"]


SCRIPT_SHAPES = [
    "create table if not exists {o} as select * from {a}",
    "create or replace view {o} as select * from {a}",
    "insert overwrite table {o} select * from {a}, {b} where {a}.id = {b}.id",
    "merge into {o} using {a} s on {o}.id = s.id when matched then update set v = 1",
    "with c(x, y) as (select * from {a}) insert into {o} select * from c join {b} on true",
    "insert into {o} select extract(year from ts) from {a} where note = 'it''s; drop from zz'",
    "-- from nowhere\ninsert into {o} select * from {a} /* join\nnothing; */ join {b} using (id)",
    "CREATE OR REPLACE TEMPORARY VIEW {o} AS SELECT * FROM {a} x, {b} AS y",
    "insert into {o} select * from {a} where k is distinct from 1",
    'insert into "{o}" select * from `{a}`',
    "create materialized view {o} as (select trim(both from name), f from {a}, unnest(xs))",
    "update {o} set v = 1; delete from {b}; insert into {o} select * from {a}",
]


def sql_array(values: list[str]) -> str:
    return "array(" + ", ".join(f"'{v}'" for v in values) + ")"


def sql_case(subject: str, mapping: dict[str, str]) -> str:
    return f"CASE {subject} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in mapping.items()) + " END"


def node_table(edges: DataFrame) -> DataFrame:
    """id, type and namespace of every end of an edge."""
    return (
        edges.selectExpr("explode(array(src, dst)) AS id")
        .distinct()
        .selectExpr(
            "id",
            "CASE WHEN startswith(id, 'job_') THEN 'job' ELSE 'dataset' END AS type",
            "CASE WHEN startswith(id, 'job_') THEN 'ns_' ELSE 'wh_' END || split_part(id, '_', 2) AS namespace",
        )
    )


class Tables:
    """The given tables of one scale factor and the lineage tables derived from them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def scale(self) -> int:
        # Parquet footers answer this count; no column is read.
        return max(self.read("events").count() // 1000, 1)

    # run events -------------------------------------------------------------
    def runs(self) -> DataFrame:
        """One row per run-state change; the graph widens with the event count."""
        s = self.scale
        jobs, datasets = 60 * s, 24 * s
        return (
            self.read("events")
            .selectExpr(
                "event_id", "ts", "user_id", "event_type", "value",
                "CAST(get_json_object(props, '$.k') AS BIGINT) AS k",
                "event_id div 4 AS run_no",
            )
            .selectExpr("*", f"run_no % {jobs} AS job_no")
            .selectExpr("*", "job_no % 5 AS layer")
            .selectExpr(
                "*",
                "'run_' || run_no AS run_id",
                "'job_' || layer || '_' || job_no AS job_name",
                "'ns_' || layer AS job_ns",
                "'wh_' || layer AS in_ns",
                "'wh_' || (layer + 1) AS out_ns",
                sql_case("event_type", STATE_OF) + " AS state",
                f"'ds_' || layer || '_' || ((job_no * 7 + run_no % 3) % {datasets}) AS in_a",
                f"'ds_' || layer || '_' || ((job_no * 11 + 5) % {datasets}) AS in_b",
                f"'ds_' || (layer + 1) || '_' || ((job_no * 13 + run_no % 2) % {datasets}) AS out_a",
            )
        )

    def event_docs(self) -> DataFrame:
        """Run events as JSON text: some lack a job namespace or name, some are cut off."""
        cols = sql_array(COLUMN_NAMES)
        doc = (
            "to_json(named_struct('eventType', state, 'eventTime', date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\"), 'run', named_struct('runId', run_id), "
            "'job', named_struct('namespace', if(k = 1, NULL, job_ns), 'name', if(k = 2, NULL, job_name)), "
            "'inputs', array(named_struct('namespace', in_ns, 'name', in_a), named_struct('namespace', in_ns, 'name', in_b)), "
            "'outputs', array(named_struct('namespace', out_ns, 'name', out_a, 'facets', named_struct("
            "'schema', named_struct('fields', array(named_struct('name', c1, 'type', 'STRING'), named_struct('name', c2, 'type', CAST(NULL AS STRING)))), "
            "'columnLineage', named_struct('fields', map(c1, named_struct('inputFields', array(named_struct('namespace', in_ns, 'name', in_a, 'field', c2, "
            "'transformations', array(named_struct('description', if(event_id % 2 = 0, 'SUM(x)', NULL)))))))), "
            "'dataQualityAssertions', named_struct('assertions', array(named_struct('assertion', 'chk_' || (event_id % 3), 'column', c1, 'success', event_type <> 'error'))))))))"
        )
        return (
            self.runs()
            .selectExpr("*", f"element_at({cols}, CAST(event_id % 5 AS INT) + 1) AS c1", f"element_at({cols}, CAST((event_id + 2) % 5 AS INT) + 1) AS c2")
            .selectExpr("event_id", "k", f"{doc} AS doc")
            .selectExpr("event_id", "CASE WHEN k = 3 THEN left(doc, 40) ELSE doc END AS doc")
        )

    def edge_log(self) -> DataFrame:
        """Three edges per run event, repeats kept."""
        return self.runs().selectExpr(
            "event_id", "ts", "run_no", "job_no", "value", "k",
            "inline(array("
            "named_struct('src', in_a, 'dst', job_name, 'type', 'CONSUMED_BY'),"
            "named_struct('src', in_b, 'dst', job_name, 'type', 'CONSUMED_BY'),"
            "named_struct('src', job_name, 'dst', out_a, 'type', 'PRODUCED_BY')))",
        )

    def edges(self) -> DataFrame:
        return self.edge_log().select("src", "dst", "type").distinct()

    def nodes(self) -> DataFrame:
        return node_table(self.edges())

    @cached_property
    def graph(self) -> tuple[DataFrame, DataFrame]:
        """Edges and nodes, materialised once so that loops do not rescan the events."""
        edges = cut_lineage(self.edges())
        return edges, cut_lineage(node_table(edges))

    def triples(self) -> DataFrame:
        """Distinct (input, job, output) hops."""
        return self.runs().selectExpr(
            "explode(array(in_a, in_b)) AS input", "job_name", "job_no", "layer", "out_a AS output"
        ).distinct()

    def entity_layers(self) -> list[DataFrame]:
        """Row-level lineage, an edge table for each layer: part/supplier -> order -> customer -> nation -> region."""
        items = self.read("lineitem").selectExpr(
            "explode(array('part:' || l_partkey, 'supplier:' || l_suppkey)) AS src", "'order:' || l_orderkey AS dst"
        ).distinct()
        orders = self.read("orders").selectExpr("'order:' || o_orderkey AS src", "'customer:' || o_custkey AS dst")
        customers = self.read("customer").selectExpr("'customer:' || c_custkey AS src", "'nation:' || c_nationkey AS dst")
        nations = self.read("nation").selectExpr("'nation:' || n_nationkey AS src", "'region:' || n_regionkey AS dst")
        return [items, orders, customers, nations]

    def entity_keys(self) -> list[DataFrame]:
        """The layers by number instead of by name: parts are even, suppliers odd, and each layer has keys of its own."""
        items = self.read("lineitem").selectExpr("explode(array(l_partkey * 2, l_suppkey * 2 + 1)) AS src", "l_orderkey AS dst").distinct()
        orders = self.read("orders").selectExpr("o_orderkey AS src", "o_custkey AS dst")
        customers = self.read("customer").selectExpr("c_custkey AS src", "c_nationkey AS dst")
        return [items, orders, customers, self.read("nation").selectExpr("n_nationkey AS src", "n_regionkey AS dst")]

    def entity_edges(self) -> DataFrame:
        items, *others = self.entity_layers()
        for layer in others:
            items = items.unionByName(layer)
        return items

    # columns ----------------------------------------------------------------
    def column_edges(self) -> DataFrame:
        return (
            self.triples()
            .selectExpr("*", "explode(sequence(0, 4)) AS i")
            .selectExpr(
                "input AS src_ds",
                f"element_at({sql_array(COLUMN_NAMES)}, i + 1) AS src_col",
                "output AS dst_ds",
                f"element_at({sql_array(COLUMN_NAMES)}, CAST((i * 3 + job_no) % 5 AS INT) + 1) AS dst_col",
                f"element_at({sql_array(TRANSFORMATIONS)}, CAST((job_no + i) % 8 AS INT) + 1) AS transformation",
                "job_name", "layer",
            )
            .selectExpr(
                "src_ds || '.' || src_col AS src", "dst_ds || '.' || dst_col AS dst", "src_ds", "src_col",
                "dst_ds", "dst_col", "transformation", "job_name",
                "src_col IN ('email', 'first_name') AND layer = 0 AS is_pii",
            )
        )

    def dataset_columns(self) -> DataFrame:
        names = sql_array(SCHEMA_NAMES)
        return (
            self.nodes().filter("type = 'dataset'")
            .selectExpr("id AS dataset", "CAST(split_part(id, '_', 2) AS BIGINT) AS layer",
                        "CAST(split_part(id, '_', 3) AS BIGINT) AS ds_no", "explode(sequence(0, 5)) AS ordinal")
            .selectExpr("dataset", f"element_at({names}, CAST((layer * 24 + ds_no + 5 * ordinal) % 16 AS INT) + 1) AS column_name",
                        "ordinal", "layer", "ds_no")
        )

    # measurements -------------------------------------------------------------
    def quality_checks(self) -> DataFrame:
        return self.runs().selectExpr(
            "event_id", "out_a AS dataset", "'chk_' || (event_id % 3) AS check_name",
            "event_type <> 'error' AS passed", "value", "CAST(50.0 AS DOUBLE) AS threshold", "ts AS checked_at",
        )

    def metric_history(self) -> DataFrame:
        return self.runs().selectExpr(
            "event_id", "'p_' || layer AS pipeline", "job_name AS stage", "ts AS recorded_at",
            "stack(3, 'row_count', value, 'duration_sec', CAST(k * 3 AS DOUBLE), 'completed', "
            "CAST(CASE WHEN event_type <> 'error' THEN 1 ELSE 0 END AS DOUBLE)) AS (metric, metric_value)",
        )

    def versioned_edges(self) -> DataFrame:
        from weftline.operators.temporal import close_versions

        opened = self.edge_log().groupBy("src", "dst", F.expr("run_no div 500 AS version"), "job_no").agg(F.min("ts").alias("valid_from"))
        end = self.read("events").agg(F.max("ts"))
        return close_versions(opened, removed_when=F.expr("job_no % 7 = 0"), removed_at=end).select(
            "src", "dst", "valid_from", "valid_to"
        )

    def access_log(self) -> DataFrame:
        cols = sql_array(COLUMN_NAMES)
        return self.runs().selectExpr(
            "event_id", "'u_' || user_id AS user_name", "in_a AS dataset",
            f"array(element_at({cols}, CAST(event_id % 5 AS INT) + 1), element_at({cols}, CAST((event_id + 2) % 5 AS INT) + 1)) AS columns",
            "CASE event_type WHEN 'view' THEN 'SELECT' WHEN 'signup' THEN 'INSERT' WHEN 'click' THEN 'UPDATE' "
            "WHEN 'error' THEN 'DELETE' ELSE 'SELECT' END AS access_type",
            "md5(CAST(event_id AS STRING)) AS query_hash", "ts AS accessed_at",
        )

    def query_log(self) -> DataFrame:
        """One statement per hop in six shapes, with call counts and total time."""
        hops = self.runs().groupBy("job_no", "job_name", "in_a", "in_b", "out_a").agg(
            F.count("*").alias("calls"), F.round(F.sum("value"), 2).alias("total_exec_time"), F.max("ts").alias("start_time"))
        return hops.selectExpr(
            "job_name", "job_no", "in_a", "in_b", "out_a", "calls", "total_exec_time", "start_time",
            "CASE job_no % 6 "
            "WHEN 0 THEN 'insert into ' || out_a || ' select a.amount from ' || in_a || ' a join ' || in_b || ' b on a.id = b.id' "
            "WHEN 1 THEN 'create table ' || out_a || ' as select * from ' || in_a || ' where amount > 0' "
            "WHEN 2 THEN 'insert into ' || out_a || ' with recent as (select * from ' || in_a || ') select * from recent join ' || in_b || ' using (id)' "
            "WHEN 3 THEN 'insert into ' || out_a || ' select * from ' || in_a || ' where id in (select id from ' || in_b || ')' "
            "WHEN 4 THEN 'insert into ' || out_a || ' select id from ' || in_a || ' union all select id from ' || in_b "
            "ELSE 'create view ' || out_a || ' as select * from ' || in_a || '; delete from ' || in_b END AS statement",
        )

    def script_log(self) -> DataFrame:
        """One script per hop in twelve shapes that name the same tables in other ways."""
        shapes = F.array(*[F.lit(x) for x in SCRIPT_SHAPES])
        hops = self.runs().select("job_name", "job_no", "in_a", "in_b", "out_a").distinct()
        text = F.element_at(shapes, (F.col("job_no") % len(SCRIPT_SHAPES)).cast("int") + 1)
        for mark, column in (("{o}", "out_a"), ("{a}", "in_a"), ("{b}", "in_b")):
            text = F.replace(text, F.lit(mark), F.col(column))
        return hops.withColumn("statement", text)

    # products, features, models -------------------------------------------------
    def products(self) -> DataFrame:
        return self.runs().selectExpr(
            "job_no AS reg_order", "job_name AS product", "'d_' || layer AS domain", "'team_' || layer AS owner",
            "array(in_ns || '/' || in_a, in_ns || '/' || in_b) AS input_ports", "array(out_ns || '/' || out_a) AS output_ports",
            "CAST(6 + 6 * layer AS BIGINT) AS sla_hours",
        ).distinct()

    def features(self) -> DataFrame:
        m, cols = 24 * self.scale, sql_array(COLUMN_NAMES)
        return self.read("part").selectExpr(
            "p_partkey AS feature_no", "'feature_' || p_partkey AS feature",
            f"array('ds_0_' || (p_partkey % {m}), 'ds_0_' || ((p_partkey * 5) % {m})) AS source_tables",
            f"array(element_at({cols}, CAST(p_partkey % 5 AS INT) + 1), element_at({cols}, CAST((p_partkey + 2) % 5 AS INT) + 1)) AS source_columns",
            "p_retailprice AS metric",
        )

    def models(self) -> DataFrame:
        m = 24 * self.scale
        return self.read("supplier").selectExpr(
            "'model_' || s_suppkey AS model", "CAST(1 + s_suppkey % 3 AS STRING) AS version", "s_suppkey AS model_no",
            f"'ds_1_' || (s_suppkey % {m}) AS training_dataset", "'pred_' || s_suppkey AS predictions",
            "s_nationkey AS nation", "s_acctbal AS score",
        )

    def model_features(self) -> DataFrame:
        """Which features a model consumes, one row each; hot models stay many rows. No model takes an eleventh of the features."""
        return self.read("lineitem").filter("l_partkey % 11 <> 0").selectExpr(
            "'model_' || l_suppkey AS model", "'feature_' || l_partkey AS feature").distinct()

    def model_keys(self) -> tuple[DataFrame, DataFrame, DataFrame]:
        """Feature sources (root, node), usage (feature, model) and training (root, node) by number instead of by name.

        Source tables of features are even, training tables odd. Usage keeps repeats and models that aren't declared.
        """
        m = 24 * self.scale
        sources = self.read("part").selectExpr(f"explode(array(p_partkey % {m} * 2, (p_partkey * 5) % {m} * 2)) AS root", "p_partkey AS node")
        usage = self.read("lineitem").filter("l_partkey % 11 <> 0").selectExpr("l_partkey AS feature", "l_suppkey AS model")
        return sources, usage, self.read("supplier").selectExpr(f"s_suppkey % {m} * 2 + 1 AS root", "s_suppkey AS node")

    # text ---------------------------------------------------------------------------
    def chunks(self) -> DataFrame:
        from weftline.operators.rag import chunk_documents

        return chunk_documents(self.read("documents"), size=200)

    @cached_property
    def n_docs(self) -> int:
        return self.read("documents").count()

    @cached_property
    def n_vectors(self) -> int:
        return self.read("embeddings").count()

    def rag_events(self) -> DataFrame:
        """One row per interaction; ``docs`` are the two documents whose first chunk was retrieved."""
        n = self.n_docs
        return self.runs().filter("event_type IN ('view', 'click')").selectExpr(
            "event_id", "ts", f"array(event_id % {n}, (event_id * 7) % {n}) AS docs",
            f"element_at({sql_array(MODEL_NAMES)}, CAST(event_id % 5 AS INT) + 1) AS model",
            "value AS latency_ms", "k * 10 AS prompt_tokens", "k AS completion_tokens", "event_type", "run_no",
        )

    def change_stream(self) -> DataFrame:
        return self.read("events").selectExpr(
            "event_id", "user_id AS key", "ts", "value",
            "CASE event_type WHEN 'signup' THEN 'INSERT' WHEN 'error' THEN 'DELETE' ELSE 'UPDATE' END AS operation",
        )

"""Data products, their ports and lineage across domains."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.operators.traversal import reach


def product_ports(products: DataFrame) -> DataFrame:
    """(product, domain, reg_order, role, port) with one row per declared port."""
    return products.selectExpr(
        "product", "domain", "reg_order",
        "inline(concat(transform(input_ports, p -> named_struct('role', 'input', 'port', p)), transform(output_ports, p -> named_struct('role', 'output', 'port', p))))")


def product_edges(products: DataFrame) -> DataFrame:
    """port -> product for inputs and product -> port for outputs."""
    ports = product_ports(products)
    incoming = F.col("role") == "input"
    return ports.select(F.when(incoming, F.col("port")).otherwise(F.col("product")).alias("src"), F.when(incoming, F.col("product")).otherwise(F.col("port")).alias("dst")).distinct()


def matched_ports(products: DataFrame) -> DataFrame:
    """(port, role, product) of ports that are somebody's output and somebody's input.

    The port stays the meeting point of its producers and consumers, which keeps every link
    without a row per producer and consumer pair.
    """
    ports = product_ports(products).select("port", "role", "product").distinct()
    shared = ports.groupBy("port").agg(F.bool_or(F.col("role") == "output").alias("written"), F.bool_or(F.col("role") == "input").alias("read"))
    return ports.join(shared.filter("written AND read").select("port"), "port", "left_semi")


def stitch_last(products: DataFrame) -> DataFrame:
    """(producer, consumer, port) for the latest registered producer and consumer of each port."""
    last = F.max_by("product", F.struct("reg_order", "product"))
    ports = product_ports(products)
    ends = ports.groupBy("port").pivot("role", ["output", "input"]).agg(last)
    return ends.filter("output IS NOT NULL AND input IS NOT NULL").select(F.col("output").alias("producer"), F.col("input").alias("consumer"), "port")


def trace_products(edges: DataFrame, products: DataFrame, roots: DataFrame, direction: str) -> DataFrame:
    """(root, product) reached through ports; ports themselves are left out."""
    names = products.select(F.col("product").alias("node")).distinct()
    return reach(edges, roots, direction).join(names, "node", "left_semi").select("root", F.col("node").alias("product"), "depth")


def federated_edges(local_edges: DataFrame, cross_edges: DataFrame, registered: DataFrame) -> DataFrame:
    """(src, dst, cross_domain): local edges of registered domains and declared cross-domain
    edges that leave one. ``local_edges`` and ``cross_edges`` carry the domain of src."""
    local = local_edges.join(registered, "domain", "left_semi").select("src", "dst", F.lit(False).alias("cross_domain"))
    return local.unionByName(cross_edges.join(registered, "domain", "left_semi").select("src", "dst", F.lit(True).alias("cross_domain")))


def affected_domains(reached: DataFrame, domain: Column) -> DataFrame:
    """(root, domain, n_nodes) over well-formed names; ``domain`` is empty for others."""
    return reached.withColumn("domain", domain).filter("domain <> ''").groupBy("root", "domain").agg(F.count("*").alias("n_nodes"))


def leaving_edges(reached: DataFrame, roots: DataFrame, edges: DataFrame) -> DataFrame:
    """(root, src, dst) cross-domain edges that start in the affected set or at the root."""
    inside = reached.select("root", F.col("node").alias("src")).unionByName(roots.select("root", F.col("root").alias("src"))).distinct()
    return edges.filter("cross_domain").join(inside, "src").select("root", "src", "dst")


def freshness_contract(products: DataFrame, observed: DataFrame) -> DataFrame:
    """Observed age of each output port against the product's promise; unseen ports break it."""
    ports = products.select("product", "sla_hours", F.explode("output_ports").alias("port"))
    age = F.coalesce(F.col("age_hours") <= F.col("sla_hours"), F.lit(False))
    return ports.join(observed, "port", "left").select("product", "port", "sla_hours", "age_hours", age.alias("met"))


def name_conflicts(datasets: DataFrame) -> DataFrame:
    """(name, n_domains) of dataset names used in more than one domain."""
    return datasets.groupBy("name").agg(F.countDistinct("domain").alias("n_domains")).filter("n_domains > 1")


def contract_violations(contracts: DataFrame) -> DataFrame:
    """(product, message) from declared_in, declared_out, actual_in and actual_out arrays."""
    undeclared = F.array_sort(F.array_except("actual_in", "declared_in"))
    missing = F.array_sort(F.array_except("declared_out", "actual_out"))
    messages = F.array(
        F.when(F.size(undeclared) > 0, F.concat(F.lit("Undeclared inputs: "), F.array_join(undeclared, ", "))),
        F.when(F.size(missing) > 0, F.concat(F.lit("Missing outputs: "), F.array_join(missing, ", "))))
    return contracts.select("product", F.explode(F.filter(messages, lambda m: m.isNotNull())).alias("message"))

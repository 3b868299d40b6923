"""Quality, privacy, federation and text operators on worked examples."""

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from weftline.operators import federation, governance, profiling, quality, rag


def test_health_needs_the_latest_five_checks(spark):
    passed = {"good": [1] * 6, "late": [1, 1, 1, 1, 0], "early": [0, 1, 1, 1, 1], "old": [0, 1, 1, 1, 1, 1]}
    checks = [(ds, i, i, bool(p)) for ds, ps in passed.items() for i, p in enumerate(ps)]
    df = spark.createDataFrame(checks, "dataset string, checked_at int, event_id int, passed boolean")
    names = spark.createDataFrame([(n,) for n in [*passed, "none"]], "dataset string")
    assert dict(rows(quality.dataset_health(df, names))) == {"good": "HEALTHY", "late": "DEGRADED", "early": "WARNING", "old": "HEALTHY", "none": "UNKNOWN"}


def test_trust_counts_every_path(spark, edges_of):
    edges = edges_of([("s", "a"), ("s", "b"), ("a", "t"), ("b", "t")])
    reports = spark.createDataFrame([("s", False), ("a", True), ("t", True)], "id string, passed boolean")
    got = dict(rows(quality.trust_scores(edges, reports)))
    # a once at depth 1, s twice at depth 2.
    assert got["t"] == pytest.approx(0.6 + 0.4 * (1 / 2) / (1 / 2 + 2 / 3))
    assert got["a"] == pytest.approx(0.6) and got["b"] == 0.5 and got["s"] == 0.0


def test_status_propagation_keeps_failures(spark, edges_of):
    edges = edges_of([("a", "b"), ("b", "c"), ("c", "d")])
    status = spark.createDataFrame([("a", "PASS"), ("b", "FAIL"), ("c", "PASS"), ("d", "FAIL")], "id string, status string")
    assert [r[2] for r in rows(quality.propagate_status(edges, status))] == ["PASS", "FAIL", "DEGRADED", "FAIL"]


def test_sla_messages(spark):
    metrics = spark.createDataFrame([("d", 30.0, 5, {"email": 0.125, "id": 0.0})], "dataset string, freshness_hours double, row_count bigint, null_rates map<string,double>")
    sla = spark.createDataFrame([("d", 24.0, 10, 0.05)], "dataset string, freshness_max_hours double, min_row_count int, max_null_rate double")
    assert [m for _, m in rows(quality.sla_violations(metrics, sla))] == [
        "Freshness SLA violated: 30.0h > 24.0h", "Null rate for 'email': 12.50% > 5.00%", "Row count below minimum: 5 < 10"]


def test_quality_suite_counts_failures(spark):
    df = spark.createDataFrame([(i % 90, None if i % 10 == 0 else "x") for i in range(120)], "order_id int, note string")
    found = {(r["check"], r["column_name"]): r["passed"] for r in profiling.quality_suite(df, "t").collect()}
    assert found == {("completeness", "order_id"): True, ("completeness", "note"): False, ("uniqueness", "order_id"): False, ("volume", ""): True}
    assert profiling.quality_suite(df, "t").first()["failed_checks"] == 2


def test_column_names_that_look_personal(spark):
    names = ["email_hash", "hotel_id", "first_name", "capacity", "order_id", "e_mail_phone"]
    df = spark.createDataFrame([("d", n) for n in names], "dataset string, column_name string")
    assert [(c, k) for _, c, k in rows(governance.first_pii_type(df))] == [("e_mail_phone", "EMAIL"), ("email_hash", "EMAIL"), ("first_name", "NAME"), ("hotel_id", "PHONE")]
    assert ("d", "e_mail_phone", "PHONE") in rows(governance.all_pii_types(df))
    wide = dict(rows(governance.auto_classify(df).select("column_name", "classification")))
    assert wide["capacity"] == "RESTRICTED" or wide["capacity"] == "INTERNAL"
    assert wide["order_id"] == "INTERNAL"


def test_text_with_personal_data(spark):
    df = spark.createDataFrame([(1, "My email is john@example.com and SSN is 123-45-6789"), (2, "call 555-123-4567 or pay 4111 1111 1111 1111"), (3, "nothing here")], "id int, text string")
    assert rows(governance.scan_text(df, "id", "text")) == [(1, "email", 1, "REDACT"), (1, "ssn", 1, "REDACT"), (2, "credit_card", 1, "REDACT"), (2, "phone", 1, "REDACT")]
    assert df.select(governance.redact("text")).first()[0] == "My email is [EMAIL] and SSN is [SSN]"


def test_erasure_actions(spark, edges_of):
    edges = edges_of([("raw", "j"), ("j", "mart"), ("mart", "k"), ("k", "board")])
    nodes = spark.createDataFrame([("raw", "dataset"), ("j", "job"), ("mart", "dataset"), ("k", "job"), ("board", "dataset")], "id string, type string")
    columns = spark.createDataFrame([("raw", "email"), ("mart", "phone"), ("board", "total")], "dataset string, column_name string")
    subject = spark.createDataFrame([("raw",)], "id string")
    plan = governance.erasure_by_dataset(governance.pii_flow(edges, nodes, subject), subject, governance.first_pii_type(columns))
    assert {r["dataset"]: r["action"] for r in plan.collect()} == {"raw": "DELETE", "mart": "ANONYMIZE", "board": "NOTIFY"}
    tags = governance.propagate_tags(edges, governance.first_pii_type(columns))
    assert ("board", "EMAIL", True) in rows(tags) and ("raw", "EMAIL", False) in rows(tags)


def test_ports_and_contracts(spark):
    products = spark.createDataFrame(
        [("orders", "sales", 1, ["wh/raw"], ["wh/orders"]), ("seg", "crm", 2, ["wh/orders"], ["wh/seg"]), ("dash", "bi", 3, ["wh/orders", "wh/seg"], ["wh/dash"])],
        "product string, domain string, reg_order int, input_ports array<string>, output_ports array<string>")
    assert rows(federation.stitch_last(products)) == [("orders", "dash", "wh/orders"), ("seg", "dash", "wh/seg")]
    assert federation.matched_ports(products).count() == 5
    contract = spark.createDataFrame([("p", ["a"], ["a", "b"], ["x", "y"], ["x"])], "product string, declared_in array<string>, actual_in array<string>, declared_out array<string>, actual_out array<string>")
    assert [m for _, m in rows(federation.contract_violations(contract))] == ["Missing outputs: y", "Undeclared inputs: b"]


def test_chunks_cover_the_whole_text(spark):
    text = " ".join(f"w{i}" for i in range(450))
    docs = spark.createDataFrame([(1, "s", text), (2, "s", ""), (3, "s", "one\ttwo\n\nthree")], "doc_id bigint, source string, text string")
    chunks = rag.chunk_documents(docs).collect()
    assert [c["n_words"] for c in sorted((c for c in chunks if c["doc_id"] == 1), key=lambda c: c["chunk_index"])] == [200, 200, 50]
    assert " ".join(c["chunk_text"] for c in sorted((c for c in chunks if c["doc_id"] == 1), key=lambda c: c["chunk_index"])) == text
    assert [c["chunk_text"] for c in chunks if c["doc_id"] == 3] == ["one two three"]
    assert not [c for c in chunks if c["doc_id"] == 2]


def test_attribution_and_cost(spark):
    df = spark.createDataFrame([(1, "Paris is big. Zebras fly purple skies", "paris is a big city")], "id int, response string, context string")
    row = rag.attribution(df).first()
    assert (row["total_claims"], row["supported"], row["faithfulness"]) == (2, 1, 0.5)
    costs = spark.createDataFrame([("gpt-4o", 1000, 1000), ("other", 1000, 1000)], "model string, prompt_tokens int, completion_tokens int")
    assert [round(r[0], 6) for r in costs.select(rag.trace_cost()).collect()] == [0.02, 0.04]
    same = spark.createDataFrame([([1.0, 0.0], [2.0, 0.0])], "a array<double>, b array<double>")
    assert same.select(rag.cosine("a", "b")).first()[0] == 1.0

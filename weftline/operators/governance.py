"""Personal data in columns and text, erasure, access and classification."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.operators.traversal import reach, roots_of

# Column-name patterns per kind of personal data, in the order they are tried.
BASIC_PATTERNS = {
    "EMAIL": ["email", "e_mail"],
    "PHONE": ["phone", "tel", "mobile"],
    "SSN": ["ssn", "social_security"],
    "NAME": ["first_name", "last_name", "full_name"],
    "ADDRESS": ["address", "street", "zip_code", "postal"],
    "DOB": ["dob", "date_of_birth", "birth_date"],
}
STORE_PATTERNS = {**BASIC_PATTERNS, "ADDRESS": ["address", "street", "zip", "postal"]}
WIDE_PATTERNS = {
    "EMAIL": ["email", "e_mail", "email_addr"],
    "PHONE": ["phone", "tel", "mobile", "cell"],
    "SSN": ["ssn", "social_security", "sin"],
    "NAME": ["first_name", "last_name", "full_name", "customer_name"],
    "ADDRESS": ["address", "street", "city", "zip", "postal"],
    "DOB": ["dob", "birth_date", "date_of_birth", "birthday"],
    "IP_ADDRESS": ["ip_addr", "ip_address", "client_ip"],
    "FINANCIAL": ["credit_card", "account_num", "iban", "routing"],
}
# Patterns of personal data in running text, with ASCII classes so that every engine agrees.
TEXT_PATTERNS = {
    "email": r"[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}",
    "phone": r"\b[0-9]{3}[-.]?[0-9]{3}[-.]?[0-9]{4}\b",
    "ssn": r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b",
    "credit_card": r"\b[0-9]{4}[- \t\r\n]?[0-9]{4}[- \t\r\n]?[0-9]{4}[- \t\r\n]?[0-9]{4}\b",
}
CLASSIFICATIONS = ["PUBLIC", "INTERNAL", "CONFIDENTIAL", "RESTRICTED"]


def matching_types(column: str, patterns: dict[str, list[str]]) -> Column:
    """Kinds of personal data a column name matches, in pattern order."""
    name = F.lower(column)
    hits = [F.when(name.rlike("|".join(words)), F.lit(kind)) for kind, words in patterns.items()]
    return F.filter(F.array(*hits), lambda k: k.isNotNull())


def first_pii_type(columns: DataFrame, patterns: dict[str, list[str]] = BASIC_PATTERNS) -> DataFrame:
    """(dataset, column_name, pii_type): the first kind that matches."""
    return columns.select("dataset", "column_name", F.get(matching_types("column_name", patterns), F.lit(0)).alias("pii_type")).filter("pii_type IS NOT NULL")


def all_pii_types(columns: DataFrame, patterns: dict[str, list[str]] = STORE_PATTERNS) -> DataFrame:
    """(dataset, column_name, pii_type): one row per kind that matches."""
    return columns.select("dataset", "column_name", F.explode(matching_types("column_name", patterns)).alias("pii_type"))


def auto_classify(columns: DataFrame, patterns: dict[str, list[str]] = WIDE_PATTERNS) -> DataFrame:
    """Tags: RESTRICTED for a column that matches anything, else INTERNAL."""
    tagged = columns.withColumn("pii_types", matching_types("column_name", patterns))
    return tagged.withColumn("classification", F.when(F.size("pii_types") > 0, "RESTRICTED").otherwise("INTERNAL"))


def classification_rank(column: str) -> Column:
    return F.array_position(F.array(*[F.lit(c) for c in CLASSIFICATIONS]), F.col(column))


def highest_classification(datasets: DataFrame, tags: DataFrame) -> DataFrame:
    """(dataset, classification): the strictest tag; no tags means PUBLIC."""
    top = tags.groupBy("dataset").agg(F.max_by("classification", classification_rank("classification")).alias("classification"))
    return datasets.join(top, "dataset", "left").select("dataset", F.coalesce("classification", F.lit("PUBLIC")).alias("classification"))


def pii_flow(edges: DataFrame, nodes: DataFrame, sources: DataFrame, datasets_only: bool = True) -> DataFrame:
    """(root, node, depth) below datasets (id) that hold personal data."""
    kept = nodes.filter("type = 'dataset'") if datasets_only else nodes
    return reach(edges, roots_of(sources)).join(kept.select(F.col("id").alias("node")), "node", "left_semi").select("root", "node", "depth")


def tagged_downstream(edges: DataFrame, sources: DataFrame, tags: DataFrame) -> DataFrame:
    """(root, dataset, column_name) of tagged personal-data columns in datasets below each source."""
    marked = tags.filter("size(pii_types) > 0").select("dataset", "column_name")
    return reach(edges, roots_of(sources)).select("root", F.col("node").alias("dataset")).join(marked, "dataset").select("root", "dataset", "column_name")


def pii_locations(tags: DataFrame, pii_type: str | Column) -> DataFrame:
    return tags.filter(F.array_contains("pii_types", pii_type)).select("dataset", "column_name", "classification", "masked")


def erasure_by_dataset(flow: DataFrame, subjects: DataFrame, findings: DataFrame) -> DataFrame:
    """(root, dataset, action, n_columns): DELETE at the root, ANONYMIZE where personal data
    arrived, NOTIFY elsewhere. Column names stay in ``findings``."""
    counts = findings.groupBy("dataset").agg(F.count("*").alias("n_columns"))
    rows = subjects.select(F.col("id").alias("root"), F.col("id").alias("dataset"), F.lit(True).alias("is_root")).unionByName(
        flow.select("root", F.col("node").alias("dataset"), F.lit(False).alias("is_root")))
    action = F.when(F.col("is_root"), "DELETE").when(F.col("n_columns") > 0, "ANONYMIZE").otherwise("NOTIFY")
    return rows.join(counts, "dataset", "left").select("root", "dataset", action.alias("action"), F.coalesce("n_columns", F.lit(0)).alias("n_columns"))


def erasure_by_type(tags: DataFrame) -> DataFrame:
    """Plan rows per kind of personal data: delete what is readable, check what is masked.

    A request names kinds, and its plan is the rows of those kinds; they are kept once, not
    once per request.
    """
    return tags.select("dataset", "column_name", "masked", F.explode("pii_types").alias("pii_type")).select(
        "pii_type", "dataset", "column_name", F.when(F.col("masked"), "verify_masked").otherwise("delete").alias("action"),
        F.when(F.col("masked"), "low").otherwise("high").alias("priority"))


def erasure_audit(requests: DataFrame, plan: DataFrame, deletions: DataFrame, as_of: Column, deadline_days: int = 30) -> DataFrame:
    """Per request: planned and done deletions, status, deadline and whether it is overdue.

    ``requests`` has one row per (request_id, pii_type) with requested_at.
    """
    sizes = plan.groupBy("pii_type").agg(F.count("*").alias("size"))
    planned = requests.join(sizes, "pii_type", "left").groupBy("request_id").agg(
        F.min("requested_at").alias("requested_at"), F.coalesce(F.sum("size"), F.lit(0)).alias("planned"))
    done = deletions.groupBy("request_id").agg(F.count("*").alias("done"))
    joined = planned.join(done, "request_id", "left").fillna(0, ["done"])
    status = F.when((F.col("planned") > 0) & (F.col("done") >= F.col("planned")), "completed").when(F.col("planned") > 0, "in_progress").otherwise("pending")
    return joined.withColumn("status", status).withColumn("deadline", F.date_add(F.to_date("requested_at"), deadline_days)).withColumn(
        "overdue", (F.col("status") != "completed") & (as_of > F.col("deadline")))


def erase_subjects(table: DataFrame, key: str, subjects: DataFrame) -> DataFrame:
    """The table without the rows of the subjects (column ``key``)."""
    return table.join(subjects.select(key), key, "left_anti")


def erase_everywhere(tables: dict[str, tuple[DataFrame, str, str]], subjects: DataFrame) -> DataFrame:
    """(dataset, row_id) of what is left in every affected dataset once the ``subjects`` (subject) are gone.

    ``tables`` gives for each dataset its frame, the column that names the subject and the column that names the row.
    """
    gone, left = subjects.select("subject").distinct(), None
    for name, (table, key, row) in tables.items():
        kept = table.join(gone, table[key] == gone["subject"], "left_anti").select(F.lit(name).alias("dataset"), F.col(row).cast("long").alias("row_id"))
        left = kept if left is None else left.unionByName(kept)
    return left


def mask_subjects(table: DataFrame, key: str, subjects: DataFrame, columns: list[str]) -> DataFrame:
    """The table with the personal columns of the subjects replaced by a hash."""
    marked = table.join(subjects.select(key, F.lit(True).alias("_subject")).distinct(), key, "left")
    masked = {c: F.when(F.col("_subject"), F.sha2(F.col(c).cast("string"), 256)).otherwise(F.col(c).cast("string")) for c in columns}
    return marked.withColumns(masked).drop("_subject")


def accesses(log: DataFrame, dataset: str | None = None, since: Column | None = None) -> DataFrame:
    kept = log if dataset is None else log.filter(F.col("dataset") == dataset)
    return kept if since is None else kept.filter(F.col("accessed_at") >= since)


def pii_accessed(log: DataFrame, pii_columns: list[str]) -> DataFrame:
    """Accesses that touched personal-data columns, with those columns."""
    touched = F.array_intersect("columns", F.array(*[F.lit(c) for c in pii_columns]))
    return log.withColumn("pii", touched).filter(F.size("pii") > 0)


def propagate_tags(edges: DataFrame, findings: DataFrame) -> DataFrame:
    """(dataset, tag, inherited): own kinds of personal data and those of every ancestor.

    Each kind walks down from all of its datasets at once, so the work follows kinds and
    nodes instead of pairs of datasets.
    """
    own = findings.select(F.col("pii_type").alias("root"), F.col("dataset").alias("node")).distinct()
    return reach(edges, own, include_root=True).select(F.col("node").alias("dataset"), F.col("root").alias("tag"), (F.col("depth") > 0).alias("inherited"))


def apply_policies(tags: DataFrame, policies: DataFrame, owners: DataFrame) -> DataFrame:
    """(dataset, tag, inherited, masking, retention_days, owner): the policy (tag, masking, retention_days) of every tag
    of a dataset. Tags without a policy are to be reviewed and have 0 days; datasets without an owner (dataset, owner) have ''."""
    return tags.join(policies, "tag", "left").join(owners, "dataset", "left").select(
        "dataset", "tag", "inherited", F.coalesce("masking", F.lit("REVIEW")).alias("masking"), F.coalesce("retention_days", F.lit(0)).alias("retention_days"), F.coalesce("owner", F.lit("")).alias("owner"))


def notifications(actions: DataFrame) -> DataFrame:
    """(recipient, dataset, tag): who hears of a policy, the data owner and the governance team."""
    told = F.explode(F.array(F.col("owner"), F.lit("governance"))).alias("recipient")
    return actions.select(told, "dataset", "tag").filter("recipient <> ''").distinct()


def scan_text(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, pii_type, n, action) of kinds with at least one match in the whole text."""
    kinds = ", ".join(f"'{k}', {k}" for k in TEXT_PATTERNS)
    counted = docs.select(key, *[F.regexp_count(text, F.lit(p)).alias(k) for k, p in TEXT_PATTERNS.items()])
    return counted.selectExpr(key, f"stack({len(TEXT_PATTERNS)}, {kinds}) AS (pii_type, n)").filter("n > 0").withColumn("action", F.lit("REDACT"))


def redact(text: str) -> Column:
    out = F.col(text)
    for kind, pattern in TEXT_PATTERNS.items():
        out = F.regexp_replace(out, pattern, f"[{kind.upper()}]")
    return out

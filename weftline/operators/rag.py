"""Documents, chunks, retrieval events and model traces."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.functions.ordered import positions, quantiles, top_rows, values_at_ranks

# Prices per 1000 prompt and completion tokens, and the price of any other model.
RATES = {
    "gpt-4-turbo": (0.01, 0.03),
    "gpt-4o": (0.005, 0.015),
    "gpt-3.5-turbo": (0.0005, 0.0015),
    "claude-3-opus": (0.015, 0.075),
    "claude-3-sonnet": (0.003, 0.015),
}
DEFAULT_RATE = (0.01, 0.03)
# Price per token by model-name fragment, first match counts.
CHAIN_RATES = [("gpt-4", 0.00003, 0.00006), ("gpt-3.5", 0.0000005, 0.0000015)]


def words(column: str) -> Column:
    return F.filter(F.split(column, r"[ \t\r\n]+"), lambda w: w != "")


def chunk_documents(docs: DataFrame, size: int = 200, overlap: int = 0) -> DataFrame:
    """Chunks of ``size`` words over whole texts, each ``size - overlap`` words after the one before.

    The identifier hashes the document and the word offset.
    """
    step = size - overlap
    if step <= 0:
        raise ValueError("overlap must be smaller than size")
    split = docs.select("doc_id", "source", words("text").alias("w")).filter(F.size("w") > 0)
    offsets = F.transform(F.sequence(F.lit(0), F.floor((F.size("w") - 1) / step).cast("int")), lambda i: i * step)
    pieces = split.select("doc_id", "source", F.posexplode(F.transform(offsets, lambda o: F.struct(o.alias("offset"), F.slice("w", o + 1, size).alias("part")))).alias("chunk_index", "c"))
    return pieces.select(
        "doc_id", "source", F.left(F.md5(F.concat_ws(":", F.col("doc_id").cast("string"), F.col("c.offset").cast("string"))), F.lit(12)).alias("chunk_id"),
        F.col("chunk_index").cast("long").alias("chunk_index"), F.array_join("c.part", " ").alias("chunk_text"), F.size("c.part").cast("long").alias("n_words"))


def content_hash(column: str) -> Column:
    return F.left(F.sha2(F.col(column), 256), F.lit(16))


def retrieved_chunks(events: DataFrame, chunks: DataFrame) -> DataFrame:
    """(event_id, rank_in, doc_id, source, chunk_id, chunk_index): chunks behind each event, unknown ids ignored.

    Events name chunks by document and number; the short chunk id is for display, as it isn't unique in a large corpus.
    """
    asked = events.select("event_id", F.posexplode("chunk_refs").alias("rank_in", "ref")).select("event_id", "rank_in", "ref.doc_id", "ref.chunk_index")
    return asked.join(chunks.select("chunk_id", "doc_id", "source", "chunk_index"), ["doc_id", "chunk_index"]).select(
        "event_id", "rank_in", "doc_id", "source", "chunk_id", "chunk_index")


def response_sources(retrieved: DataFrame) -> DataFrame:
    return retrieved.select("event_id", "doc_id").distinct()


def document_usage(retrieved: DataFrame) -> DataFrame:
    """Responses each document contributed to, once per response. Repeats go before the count,
    so a document behind a third of all responses is summed in parts."""
    return response_sources(retrieved).groupBy("doc_id").agg(F.count("*").alias("n_responses"))


def stale_documents(registered: DataFrame, current: DataFrame) -> DataFrame:
    """Registered documents (doc_id, doc_hash) whose current non-empty hash differs."""
    now = current.select("doc_id", F.col("doc_hash").alias("now_hash"))
    return registered.join(now, "doc_id").filter("now_hash <> '' AND now_hash <> doc_hash").select("doc_id")


def reembedding_plan(stale: DataFrame, chunks: DataFrame) -> DataFrame:
    """One row: stale documents that are known and the calls needed to embed their chunks again."""
    per = chunks.groupBy("doc_id").agg(F.count("*").alias("n"))
    return stale.join(per, "doc_id").agg(F.count("*").alias("documents"), F.coalesce(F.sum("n"), F.lit(0)).alias("api_calls"))


def trace_cost() -> Column:
    prompt, completion = F.lit(DEFAULT_RATE[0]), F.lit(DEFAULT_RATE[1])
    for model, (p, c) in RATES.items():
        prompt = F.when(F.col("model") == model, p).otherwise(prompt)
        completion = F.when(F.col("model") == model, c).otherwise(completion)
    return F.col("prompt_tokens") / 1000 * prompt + F.col("completion_tokens") / 1000 * completion


def trace_summary(traces: DataFrame, last_n: int = 100) -> DataFrame:
    """One row over the ``last_n`` latest traces; ``has_context`` marks retrieval."""
    recent = traces.orderBy(F.desc("ts"), F.desc("event_id")).limit(last_n).withColumn("cost", trace_cost()).withColumn("all_rows", F.lit(1))
    tail = values_at_ranks(recent, ["all_rows"], "latency_ms", {"p99_latency_ms": F.floor(F.col("n") * F.lit(0.99))}).select("all_rows", "p99_latency_ms")
    totals = recent.groupBy("all_rows").agg(
        F.count("*").alias("total_requests"), F.avg("latency_ms").alias("avg_latency_ms"), F.sum("cost").alias("total_cost"), F.avg("cost").alias("avg_cost"),
        F.avg("prompt_tokens").alias("avg_prompt_tokens"), F.avg("completion_tokens").alias("avg_completion_tokens"),
        F.array_join(F.sort_array(F.collect_set("model")), ",").alias("models_used"), (F.avg(F.col("has_context").cast("double")) * 100).alias("rag_percentage"))
    return totals.join(tail, "all_rows").drop("all_rows")


def latency_totals(events: DataFrame) -> DataFrame:
    one = events.agg(F.count("*").alias("total_events"), F.coalesce(F.sum("latency_ms"), F.lit(0.0)).alias("total_latency_ms"))
    return one.withColumn("avg_latency_ms", F.col("total_latency_ms") / F.greatest("total_events", F.lit(1)))


def chain_totals(steps: DataFrame) -> DataFrame:
    """Per chain: tokens, latency and cost."""
    cost = F.lit(0.0)
    for fragment, prompt, completion in reversed(CHAIN_RATES):
        cost = F.when(F.col("model").contains(fragment), F.col("input_tokens") * prompt + F.col("output_tokens") * completion).otherwise(cost)
    return steps.groupBy("chain_id").agg(
        F.sum(F.col("input_tokens") + F.col("output_tokens")).alias("total_tokens"), F.sum("latency_ms").alias("total_latency_ms"), F.sum(cost).alias("total_cost"))


def chain_lines(steps: DataFrame, steps_per_bucket: int = 1000) -> DataFrame:
    """(chain_id, part, step, line) of a sequence diagram per chain."""
    placed = positions(steps, ["chain_id"], ["step"], F.floor(F.col("step") / steps_per_bucket)).withColumn("i", F.col("position") - 1)
    ends = placed.groupBy("chain_id").agg(F.max("i").alias("i"))
    row = lambda part, line: F.struct(F.lit(part).alias("part"), F.col("i").alias("step"), line.alias("line"))
    previous = F.when(F.col("i") == 0, "U").otherwise(F.concat(F.lit("S"), F.col("i") - 1))
    per_step = placed.select("chain_id", F.inline(F.array(
        row(2, F.format_string("    participant S%d as %s", "i", "step_name")),
        row(3, F.format_string("    %s->>S%d: %s...", previous, F.col("i"), F.left("input_text", F.lit(30)))),
        row(4, F.format_string("    Note over S%d: %s<br/>%dms", "i", "model", "latency_ms")))))
    header = ends.select("chain_id", F.inline(F.array(row(0, F.lit("sequenceDiagram")), row(1, F.lit("    participant U as User")), row(5, F.format_string("    S%d-->>U: Final response", "i")))))
    return header.unionByName(per_step)


def interaction_graph(events: DataFrame, retrieved: DataFrame, top_k: int) -> tuple[DataFrame, DataFrame]:
    """Nodes and edges of each retrieval interaction: five fixed steps and one node per chunk."""
    node = lambda i, kind, label: F.struct(F.lit(i).alias("id"), F.lit(kind).alias("type"), label.alias("label"))
    fixed = events.select("event_id", F.inline(F.array(
        node("query", "query", F.left("query_text", F.lit(50))), node("retrieval", "process", F.lit(f"Retrieve top-{top_k}")), node("prompt", "process", F.lit("Assemble prompt")),
        node("llm", "model", F.col("model")), node("response", "output", F.left("response_text", F.lit(50))))))
    chunks = retrieved.select("event_id", F.concat(F.lit("doc_"), "chunk_id").alias("id"), F.lit("document").alias("type"), F.format_string("%s [chunk %d]", "source", "chunk_index").alias("label"))
    steps = [("query", "retrieval"), ("retrieval", "prompt"), ("query", "prompt"), ("prompt", "llm"), ("llm", "response")]
    flow = events.select("event_id", F.inline(F.array(*[F.struct(F.lit(a).alias("source"), F.lit(b).alias("target")) for a, b in steps])))
    links = retrieved.select("event_id", F.concat(F.lit("doc_"), "chunk_id").alias("source"), F.lit("retrieval").alias("target"))
    return fixed.unionByName(chunks), flow.unionByName(links)


def attribution(responses: DataFrame, threshold: float = 0.3) -> DataFrame:
    """Per response (response, context): sentences whose words occur in the context, and their share."""
    sentences = F.split("response", r"\. ")
    context = F.lower("context")

    def supported(sentence: Column) -> Column:
        terms = F.array_distinct(F.filter(F.split(F.lower(sentence), r"[ \t\r\n]+"), lambda w: w != ""))
        return F.size(F.filter(terms, lambda w: F.contains(context, w))) / F.greatest(F.size(terms), F.lit(1)) > threshold

    keys = [c for c in responses.columns if c not in ("response", "context")]
    judged = responses.select(*keys, F.size(sentences).alias("total_claims"), F.size(F.filter(sentences, supported)).alias("supported"))
    return judged.withColumn("unsupported", F.col("total_claims") - F.col("supported")).withColumn(
        "faithfulness", F.col("supported") / F.greatest("total_claims", F.lit(1)))


def cosine(left: str, right: str) -> Column:
    def total(values: Column) -> Column:
        return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)

    dot = total(F.zip_with(left, right, lambda x, y: x.cast("double") * y.cast("double")))
    norm = lambda c: F.sqrt(total(F.transform(c, lambda x: x.cast("double") * x.cast("double"))))
    return F.try_divide(dot, norm(left) * norm(right))


def rank_retrieved(scored: DataFrame, top_k: int) -> DataFrame:
    """The ``top_k`` retrieved chunks of each query by similarity."""
    return top_rows(scored, ["event_id"], [F.desc("score"), F.col("doc_id")], top_k)


def dashboard(traces: DataFrame) -> DataFrame:
    """Per model: latency percentiles, token throughput, quality means, cost and error rate."""
    tails = quantiles(traces, ["model"], "latency_ms", {"p50_latency": 0.5, "p99_latency": 0.99}).drop("n")
    costed = traces.withColumn("cost", trace_cost())
    sums = costed.groupBy("model").agg(
        F.count("*").alias("requests"), F.try_divide(F.sum(F.col("prompt_tokens") + F.col("completion_tokens")), F.sum("latency_ms") / 1000).alias("tokens_per_second"),
        F.avg("relevance").alias("mean_relevance"), F.avg("cost").alias("cost_per_request"), F.avg((F.col("finish_reason") != "stop").cast("double")).alias("error_rate"))
    return sums.join(tails, "model")

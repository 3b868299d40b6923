"""Registered document, chunk, retrieval and trace queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from weftline.fixtures import MODEL_NAMES, sql_array
from weftline.operators import rag
from weftline.plans.registry import query


@query("m10_chunking", "SELECT doc_id, chunk_id, chunk_index, n_words, md5(chunk_text) AS text_hash FROM chunks")
def m10(t):
    return t.chunks().select("doc_id", "chunk_id", "chunk_index", "n_words", F.md5("chunk_text").alias("text_hash"))


@query("m10_chunking_overlap", r"""SELECT doc_id, left(md5(doc_id || ':' || (idx * 150)), 12) AS chunk_id, idx AS chunk_index, md5(array_to_string(words[idx * 150 + 1 : idx * 150 + 200], ' ')) AS text_hash FROM (
    SELECT doc_id, words, unnest(range(0, (len(words) - 1) // 150 + 1)) AS idx FROM (SELECT doc_id, list_filter(string_split_regex(text, '[ \t\r\n]+'), lambda x: x <> '') AS words FROM documents))""")
def m10_overlap(t):
    return rag.chunk_documents(t.read("documents"), size=200, overlap=50).select("doc_id", "chunk_id", "chunk_index", F.md5("chunk_text").alias("text_hash"))


@query("m11_content_hash", "SELECT doc_id, left(sha256(text), 16) AS content_hash FROM documents")
def m11(t):
    return t.read("documents").select("doc_id", rag.content_hash("text").alias("content_hash"))


def interactions(t):
    return t.rag_events().select("*", F.transform("docs", lambda d: F.struct(d.alias("doc_id"), F.lit(0).cast("long").alias("chunk_index"))).alias("chunk_refs"))


def retrieved(t):
    return rag.retrieved_chunks(interactions(t), t.chunks())


_GOT = "SELECT event_id, unnest(docs) AS doc_id FROM rag_events"


@query("m12_response_sources", "SELECT DISTINCT event_id, doc_id FROM got WHERE doc_id IN (SELECT doc_id FROM documents)", got=_GOT)
def m12(t):
    return rag.response_sources(retrieved(t))


@query("a19_document_usage", "SELECT doc_id, count(DISTINCT event_id) AS n_responses FROM got WHERE doc_id IN (SELECT doc_id FROM documents) GROUP BY doc_id", got=_GOT)
def a19(t):
    return rag.document_usage(retrieved(t))


def hashed(t):
    docs = t.read("documents")
    registered = docs.select("doc_id", rag.content_hash("text").alias("doc_hash"))
    changed = F.when(F.col("lang") == "en", "").when(F.col("n_chars") > 500, F.concat("text", F.lit(" edited"))).otherwise(F.col("text"))
    current = docs.select("doc_id", changed.alias("text")).select("doc_id", F.when(F.col("text") == "", "").otherwise(rag.content_hash("text")).alias("doc_hash"))
    return registered, current


@query("m13_stale_documents", "SELECT doc_id FROM documents WHERE lang <> 'en' AND n_chars > 500")
def m13(t):
    return rag.stale_documents(*hashed(t))


@query("a24_reembedding_plan", "SELECT count(DISTINCT doc_id) AS documents, count(*) AS api_calls FROM chunks WHERE doc_id IN (SELECT doc_id FROM documents WHERE lang <> 'en' AND n_chars > 500)")
def a24(t):
    return rag.reembedding_plan(rag.stale_documents(*hashed(t)), t.chunks())


_RATE = """CASE model {0} ELSE {1} END"""
_PROMPT = _RATE.format(" ".join(f"WHEN '{m}' THEN {p}::DOUBLE" for m, (p, _) in rag.RATES.items()), f"{rag.DEFAULT_RATE[0]}::DOUBLE")
_COMPLETION = _RATE.format(" ".join(f"WHEN '{m}' THEN {c}::DOUBLE" for m, (_, c) in rag.RATES.items()), f"{rag.DEFAULT_RATE[1]}::DOUBLE")
_TRACES = f"SELECT *, prompt_tokens / 1000 * {_PROMPT} + completion_tokens / 1000 * {_COMPLETION} AS cost, event_type = 'view' AS has_context, CASE WHEN event_id % 10 = 0 THEN 'length' ELSE 'stop' END AS finish_reason FROM rag_events"


def traces(t):
    return t.rag_events().withColumns({
        "has_context": F.col("event_type") == "view", "finish_reason": F.when(F.col("event_id") % 10 == 0, "length").otherwise("stop"), "relevance": F.col("completion_tokens") / 100})


@query("m14_trace_cost", "SELECT event_id, model, round(cost, 8) AS cost FROM traces", traces=_TRACES)
def m14(t):
    return traces(t).select("event_id", "model", F.round(rag.trace_cost(), 8).alias("cost"))


@query("a16_trace_summary", """SELECT count(*) AS total_requests, round(avg(latency_ms), 6) AS avg_latency_ms, list_sort(list(latency_ms))[CAST(floor(count(*) * CAST(0.99 AS DOUBLE)) AS BIGINT) + 1] AS p99_latency_ms, round(sum(cost), 6) AS total_cost, round(avg(cost), 6) AS avg_cost,
    round(avg(prompt_tokens), 6) AS avg_prompt_tokens, round(avg(completion_tokens), 6) AS avg_completion_tokens, string_agg(DISTINCT model, ',' ORDER BY model) AS models_used, round(avg(CASE WHEN has_context THEN 1.0 ELSE 0.0 END) * 100, 6) AS rag_percentage
    FROM (SELECT * FROM traces ORDER BY ts DESC, event_id DESC LIMIT 100)""", traces=_TRACES)
def a16(t):
    return rag.trace_summary(traces(t)).withColumns({c: F.round(c, 6) for c in ("avg_latency_ms", "total_cost", "avg_cost", "avg_prompt_tokens", "avg_completion_tokens", "rag_percentage")})


@query("a17_latency_summary", "SELECT count(*) AS total_events, round(sum(latency_ms), 4) AS total_latency_ms, round(sum(latency_ms) / greatest(count(*), 1), 6) AS avg_latency_ms FROM rag_events")
def a17(t):
    return rag.latency_totals(t.rag_events()).select("total_events", F.round("total_latency_ms", 4).alias("total_latency_ms"), F.round("avg_latency_ms", 6).alias("avg_latency_ms"))


@query("a26_trace_dashboard", """SELECT model, count(*) AS requests, round(sum(prompt_tokens + completion_tokens) / (sum(latency_ms) / 1000), 6) AS tokens_per_second, round(avg(completion_tokens / 100), 6) AS mean_relevance, round(avg(cost), 6) AS cost_per_request,
    round(avg(CASE WHEN finish_reason <> 'stop' THEN 1.0 ELSE 0.0 END), 6) AS error_rate, round(quantile_cont(latency_ms, 0.5), 6) AS p50_latency, round(quantile_cont(latency_ms, 0.99), 6) AS p99_latency FROM traces GROUP BY model""", traces=_TRACES)
def a26(t):
    out = rag.dashboard(traces(t))
    return out.select("model", "requests", *[F.round(c, 6).alias(c) for c in out.columns if c not in ("model", "requests")])


_STEPS = f"""SELECT conv_id AS chain_id, turn AS step, role AS step_name, {sql_array(MODEL_NAMES)[5:].replace('(', '[').replace(')', ']')}[conv_id % 5 + 1] AS model, length(text) AS input_tokens, turn * 10 AS output_tokens, conv_id % 7 * 100 + turn AS latency_ms, text AS input_text FROM conversations"""


def chain_steps(t):
    return t.read("conversations").selectExpr(
        "conv_id AS chain_id", "turn AS step", "role AS step_name", f"element_at({sql_array(MODEL_NAMES)}, CAST(conv_id % 5 AS INT) + 1) AS model", "length(text) AS input_tokens",
        "turn * 10 AS output_tokens", "conv_id % 7 * 100 + turn AS latency_ms", "text AS input_text")


@query("a18_chain_totals", """SELECT chain_id, sum(input_tokens + output_tokens)::BIGINT AS total_tokens, sum(latency_ms)::BIGINT AS total_latency_ms, round(sum(CASE WHEN contains(model, 'gpt-4') THEN input_tokens * 0.00003::DOUBLE + output_tokens * 0.00006::DOUBLE
    WHEN contains(model, 'gpt-3.5') THEN input_tokens * 0.0000005::DOUBLE + output_tokens * 0.0000015::DOUBLE ELSE 0 END), 9) AS total_cost FROM steps GROUP BY chain_id""", steps=_STEPS)
def a18(t):
    return rag.chain_totals(chain_steps(t)).withColumn("total_cost", F.round("total_cost", 9))


@query("p24_chain_diagram", """SELECT chain_id, part, step, line FROM (
    SELECT chain_id, 0 AS part, max(i) AS step, 'sequenceDiagram' AS line FROM placed GROUP BY chain_id UNION ALL SELECT chain_id, 1, max(i), '    participant U as User' FROM placed GROUP BY chain_id
    UNION ALL SELECT chain_id, 2, i, '    participant S' || i || ' as ' || step_name FROM placed
    UNION ALL SELECT chain_id, 3, i, '    ' || CASE WHEN i = 0 THEN 'U' ELSE 'S' || (i - 1) END || '->>S' || i || ': ' || left(input_text, 30) || '...' FROM placed
    UNION ALL SELECT chain_id, 4, i, '    Note over S' || i || ': ' || model || '<br/>' || latency_ms || 'ms' FROM placed
    UNION ALL SELECT chain_id, 5, max(i), '    S' || max(i) || '-->>U: Final response' FROM placed GROUP BY chain_id)""",
       steps=_STEPS, placed="SELECT *, row_number() OVER (PARTITION BY chain_id ORDER BY step) - 1 AS i FROM steps")
def p24(t):
    return rag.chain_lines(chain_steps(t))


_LABELLED = "SELECT event_id, 'query ' || event_id AS query_text, model, 'response of run ' || run_no AS response_text FROM rag_events"
_CHUNK_ROWS = "SELECT event_id, chunk_id, source, chunk_index FROM got JOIN chunks USING (doc_id) WHERE chunk_index = 0"


def labelled(t):
    return interactions(t).selectExpr("event_id", "'query ' || event_id AS query_text", "model", "'response of run ' || run_no AS response_text", "chunk_refs")


@query("p23_interaction_nodes", """SELECT event_id, 'query' AS id, 'query' AS type, left(query_text, 50) AS label FROM labelled UNION ALL SELECT event_id, 'retrieval', 'process', 'Retrieve top-2' FROM labelled UNION ALL SELECT event_id, 'prompt', 'process', 'Assemble prompt' FROM labelled
    UNION ALL SELECT event_id, 'llm', 'model', model FROM labelled UNION ALL SELECT event_id, 'response', 'output', left(response_text, 50) FROM labelled UNION ALL SELECT event_id, 'doc_' || chunk_id, 'document', source || ' [chunk ' || chunk_index || ']' FROM chunk_rows""",
       labelled=_LABELLED, got=_GOT, chunk_rows=_CHUNK_ROWS)
def p23(t):
    return rag.interaction_graph(labelled(t), retrieved(t), top_k=2)[0]


@query("p23_interaction_edges", """SELECT event_id, unnest(['query', 'retrieval', 'query', 'prompt', 'llm']) AS source, unnest(['retrieval', 'prompt', 'prompt', 'llm', 'response']) AS target FROM labelled UNION ALL SELECT event_id, 'doc_' || chunk_id, 'retrieval' FROM chunk_rows""",
       labelled=_LABELLED, got=_GOT, chunk_rows=_CHUNK_ROWS)
def p23_edges(t):
    return rag.interaction_graph(labelled(t), retrieved(t), top_k=2)[1]


@query("v16_source_attribution", r"""SELECT conv_id, turn, len(s) AS total_claims, len(list_filter(s, lambda x: x)) AS supported, len(s) - len(list_filter(s, lambda x: x)) AS unsupported, round(len(list_filter(s, lambda x: x)) / greatest(len(s), 1), 6) AS faithfulness FROM (
    SELECT conv_id, turn, list_transform(string_split(response, '. '), lambda q: len(list_filter(list_distinct(list_filter(string_split_regex(lower(q), '[ \t\r\n]+'), lambda w: w <> '')), lambda w: contains(ctx, w)))
      / greatest(len(list_distinct(list_filter(string_split_regex(lower(q), '[ \t\r\n]+'), lambda w: w <> ''))), 1) > 0.3) AS s
    FROM (SELECT a.conv_id, a.turn, a.text AS response, lower(b.text) AS ctx FROM conversations a JOIN conversations b ON b.conv_id = a.conv_id AND b.turn = a.turn - 1 WHERE a.role = 'assistant'))""")
def v16(t):
    turns = t.read("conversations")
    before = turns.select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("text").alias("context"))
    answers = turns.filter("role = 'assistant'").select("conv_id", "turn", F.col("text").alias("response")).join(before, ["conv_id", "turn"])
    judged = rag.attribution(answers)
    return judged.select("conv_id", "turn", *[F.col(c).cast("long").alias(c) for c in ("total_claims", "supported", "unsupported")], F.round("faithfulness", 6).alias("faithfulness"))


_CANDIDATES = 9


@query("w09_retrieval_ranking", f"""SELECT event_id, doc_id, round(score, 6) AS score, position FROM (SELECT *, CAST(row_number() OVER (PARTITION BY event_id ORDER BY score DESC, doc_id) AS INTEGER) AS position FROM (
    SELECT g.event_id, g.doc_id, list_cosine_similarity(q.embedding::DOUBLE[], d.embedding::DOUBLE[]) AS score FROM candidates g, (SELECT count(*) AS n FROM embeddings) c JOIN embeddings q ON q.vec_id = g.event_id % n JOIN embeddings d ON d.vec_id = g.doc_id % n)) WHERE position <= 5""",
       candidates=f"SELECT DISTINCT event_id, (event_id * (2 * i + 3) + i * i) % n AS doc_id FROM rag_events, (SELECT count(*) AS n FROM documents), range({_CANDIDATES}) r(i)")
def w09(t):
    """The five best of the nine candidates that the retriever recorded for each query."""
    n, documents = t.n_vectors, t.read("documents").count()
    recorded = F.transform(F.sequence(F.lit(0), F.lit(_CANDIDATES - 1)), lambda i: (F.col("event_id") * (2 * i + 3) + i * i) % documents)
    asked = t.rag_events().select("event_id", F.explode(F.array_distinct(recorded)).alias("doc_id")).selectExpr("*", f"event_id % {n} AS q_id", f"doc_id % {n} AS d_id")
    vectors = t.read("embeddings")
    queries = vectors.select(F.col("vec_id").alias("q_id"), F.col("embedding").alias("q"))
    docs = vectors.select(F.col("vec_id").alias("d_id"), F.col("embedding").alias("d"))
    scored = asked.join(queries, "q_id").join(docs, "d_id").select("event_id", "doc_id", rag.cosine("q", "d").alias("score"))
    return rag.rank_retrieved(scored, 5).select("event_id", "doc_id", F.round("score", 6).alias("score"), F.col("rank").alias("position"))

"""One query per operator over the whole supplied tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from annalist.llm import repair_sql

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def query(fn: Query) -> Query:
    _QUERIES[fn.__name__] = fn
    return fn


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from annalist.llm.ngram_join import jaccard_components

    return jaccard_components(table(spark, sf_dir, "documents"), k=3, num=90, den=100)


@query
def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digest of the documents, cut into 24 shards with the mixture of sources of the whole."""
    from annalist.llm.sharding import interleave

    blob = F.encode("text", "UTF-8")
    docs = table(spark, sf_dir, "documents").select(
        "doc_id",
        "source",
        (F.coalesce(F.length(blob), F.lit(0)) + 8).cast("long").alias("size"),
        F.coalesce(F.crc32(blob), F.lit(0)).cast("long").alias("text_crc32"),
    )
    return interleave(docs, "source", ["doc_id", "text_crc32"], n_shards=24).select(
        "doc_id",
        "source",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query
def op9_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from annalist.llm.decontaminate import contamination

    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def tokenizer_file(name: str) -> str:
    """A public vocabulary file of the installation."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from annalist.llm.wordpiece import token_counts

    return token_counts(table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"))


@query
def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from annalist.llm.packing import pack

    return pack(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"), capacity=2048, end_id=0)


@query
def op7_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from annalist.llm.vector_dedup import near_vectors

    return near_vectors(table(spark, sf_dir, "embeddings"), least=0.98)


@query
def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learns from three quarters of the labelled documents and predicts all."""
    from annalist.llm import langid

    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = langid.fold("doc_id", 4) == 2
    model = langid.fit(docs.filter(~held_out))
    return langid.predict(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")


@query
def op3_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from annalist.llm.suffix_dedup import shared_passages

    return shared_passages(table(spark, sf_dir, "documents"))


@query
def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learns from four fifths of the documents and scores all."""
    from annalist.llm import kneser_ney
    from annalist.llm.langid import fold

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = fold("doc_id", 5) == 1
    return kneser_ney.score(docs, kneser_ney.train(docs.filter(~held_out)), held_out)


@query
def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damages the conversations and repairs them."""
    from annalist.llm import repair

    return repair.repair_report(repair.damage(table(spark, sf_dir, "conversations")))


_SQL["op11_conversation_repair"] = repair_sql.DUCKDB


@query
def op12_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    from annalist.llm.main_text import main_text

    found = main_text(table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"), "n_blocks")


@query
def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    from annalist.llm.collocations import collocations

    return collocations(table(spark, sf_dir, "documents"), least=10, share=50, top=2000)


_SQL["op13_phrase_collocations"] = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
), words AS (
    SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces
), places AS (
    SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM words
), counted AS (
    SELECT lang, size, array_to_string(w[i:i + size - 1], ' ') AS phrase, min(w[i:i + size - 1]) AS ws, count(*) AS f
    FROM places, (VALUES (1), (2), (3)) sizes(size) WHERE i + size - 1 <= len(w) GROUP BY ALL
    HAVING size = 1 OR f >= 10
), totals AS (
    SELECT lang, sum(f)::BIGINT AS n FROM counted WHERE size = 1 GROUP BY lang
), candidates AS (
    SELECT * FROM counted WHERE size > 1 AND f >= 10
), cuts AS (
    SELECT c.lang, c.size, c.phrase, c.f AS a, x.size AS k, x.f AS l, y.f AS r,
        (1000000::HUGEINT * c.f * c.f) // (x.f::HUGEINT * y.f) AS score
    FROM candidates c JOIN counted x ON x.lang = c.lang AND x.size < c.size AND x.phrase = array_to_string(c.ws[:x.size], ' ')
    JOIN counted y ON y.lang = c.lang AND y.size = c.size - x.size AND y.phrase = array_to_string(c.ws[x.size + 1:], ' ')
), least_cut AS (
    SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS nth FROM cuts
), kept AS (
    SELECT * FROM least_cut s WHERE nth = 1 AND NOT EXISTS (
        SELECT 1 FROM candidates c WHERE c.lang = s.lang AND s.size = 2 AND c.size = 3 AND 100 * c.f >= 50 * s.a
        AND (array_to_string(c.ws[1:2], ' ') = s.phrase OR array_to_string(c.ws[2:3], ' ') = s.phrase))
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase,
    a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score::BIGINT AS score
FROM kept JOIN totals USING (lang) QUALIFY rank <= 2000
"""


#: what the tools of the conversations take: argument, kind, required
TOOLS = {
    "search": [("query", "string", True), ("limit", "integer", False)],
    "translate": [("text", "string", True), ("target", "string", True)],
    "measure": [("text", "string", True), ("exact", "boolean", False), ("scale", "number", True)],
}


def _tool(name: str, arguments: list[tuple[str, str, bool]]) -> Column:
    fields = ("argument", "kind", "required")
    wanted = [F.struct(*[F.lit(v).alias(f) for f, v in zip(fields, a, strict=True)]) for a in arguments]
    return F.struct(F.lit(name).alias("name"), F.array(*wanted).alias("arguments"))


def _json_text(c: str) -> Column:
    one = F.to_json(F.array(c))
    return F.substring(one, F.lit(2), F.length(one) - 2)


@query
def op5_tool_call_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User turns read as tool calls that go on from the last one; the next assistant turn is the result."""
    from annalist.llm.chat import link_tool_calls

    turns = table(spark, sf_dir, "conversations")
    at = lambda shift: F.concat_ws(":", "conv_id", (F.col("turn") - shift).cast("string"))
    n = F.length("text")
    name = F.element_at(F.array(*map(F.lit, ["search", "translate", "measure", "browse"])), (n % 4 + 1).cast("int"))
    text = _json_text("text")
    limit = F.when(n % 5 == 0, F.lit('"many"')).otherwise((n % 50).cast("string"))
    target = F.when(n % 7 == 0, F.lit("")).otherwise(F.concat(F.lit(', "target": "'), F.lit("l"), (n % 9).cast("string"), F.lit('"')))
    more = F.when(n % 11 == 0, F.lit(', "verbose": [1, {"b": null, "a": true}]')).otherwise("")
    arguments = (
        F.when(n % 13 == 0, F.concat(F.lit('{"text": '), text))
        .when(n % 4 == 0, F.concat(F.lit('{"query": '), text, F.lit(', "limit": '), limit, more, F.lit("}")))
        .when(n % 4 == 1, F.concat(F.lit('{"text": '), text, target, more, F.lit("}")))
        .otherwise(F.concat(F.lit('{ "text" : '), text, F.lit(', "scale": '), (n % 3).cast("string"), F.lit('.5, "exact": true'), more, F.lit(" }")))
    )
    calls = turns.filter("role = 'user'").select(
        "conv_id", at(0).alias("call_id"), at(2).alias("parent_id"), name.alias("name"), arguments.alias("arguments")
    )
    results = turns.filter("role = 'assistant'").select(at(1).alias("call_id"), "turn", F.col("text").alias("content"))
    schemas = spark.range(1).select(F.inline(F.array(*[_tool(t, a) for t, a in TOOLS.items()])))
    return link_tool_calls(calls, results, schemas)


_SQL["op5_tool_call_linking"] = """
WITH c AS (
    SELECT conv_id, turn, conv_id || ':' || turn AS call_id, conv_id || ':' || (turn - 2) AS parent_id,
        min(text) AS text, count(*) AS n_calls, min(length(text)) AS n
    FROM conversations WHERE role = 'user' GROUP BY conv_id, turn
), chains AS (
    SELECT *, turn // 2 - row_number() OVER (PARTITION BY conv_id, turn % 2 ORDER BY turn) AS chain FROM c
), deep AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id, turn % 2, chain ORDER BY turn) - 1 AS depth FROM chains
), results AS (
    SELECT conv_id || ':' || (turn - 1) AS call_id, count(*) AS n_results, min(text) AS content
    FROM conversations WHERE role = 'assistant' GROUP BY conv_id, turn
), parts AS (
    SELECT d.*, coalesce(r.n_results, 0) AS n_results, r.content,
        ['search', 'translate', 'measure', 'browse'][n % 4 + 1] AS name,
        CASE WHEN n % 11 = 0 THEN ',"verbose":[1,{"a":true,"b":null}]' ELSE '' END AS more
    FROM deep d LEFT JOIN results r USING (call_id)
), args AS (
    SELECT *, CASE WHEN n % 13 = 0 THEN NULL
        WHEN n % 4 = 0 THEN '{"limit":' || CASE WHEN n % 5 = 0 THEN '"many"' ELSE (n % 50)::VARCHAR END
            || ',"query":' || to_json(text) || more || '}'
        WHEN n % 4 = 1 THEN '{' || CASE WHEN n % 7 = 0 THEN '' ELSE '"target":"l' || (n % 9) || '",' END
            || '"text":' || to_json(text) || more || '}'
        ELSE '{"exact":true,"scale":' || (n % 3) || '.5,"text":' || to_json(text) || more || '}' END AS arguments
    FROM parts
)
SELECT conv_id, call_id, row_number() OVER (PARTITION BY conv_id ORDER BY depth, call_id) - 1 AS position,
    depth, n_calls, n_results,
    CASE WHEN name = 'browse' THEN 'unknown_tool' WHEN arguments IS NULL THEN 'invalid_json'
        WHEN name = 'translate' AND n % 7 = 0 THEN 'missing_argument'
        WHEN name = 'search' AND n % 5 = 0 THEN 'wrong_type'
        WHEN n % 11 = 0 THEN 'unknown_argument' WHEN n_results = 0 THEN 'missing_result'
        WHEN n_results > 1 THEN 'several_results' ELSE 'ok' END AS status,
    '{"arguments":' || coalesce(arguments, 'null') || ',"id":"' || call_id || '","name":"' || name
        || '","parent":"' || parent_id || '","result":' || coalesce(to_json(content)::VARCHAR, 'null') || '}' AS record
FROM args
"""

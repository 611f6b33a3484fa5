"""The numbered queries, with SQL counterparts where SQL can say the same."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    block_names,
    bottom_k,
    covering_simhash,
    id_files,
    mixing,
    piece_counts,
    tag_paths,
    tool_calls,
    toxic_passages,
    turn_repair,
    url_filter,
    whitening,
    word_automaton,
)
from .shared import Workspace, read, text_or_empty

#: Fixed values: (host, path, verdict).
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Null and odd urls have an empty host and path and no rule; equal rows are judged alike, an empty table gives none. Other columns are not read."""
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filter.judge_urls(read(spark, sf_dir, "pages"), rules)


OP1_SQL = """
WITH rules(host, path, verdict) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'),
  ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
parts AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
parsed AS (SELECT page_id,
  translate(regexp_extract(rest, '^([^/?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(rest, '^[^/?#]*([^?#]*)', 1, 's') AS path FROM parts),
fits AS (SELECT p.page_id, r.host || r.path AS rule, r.verdict,
  row_number() OVER (PARTITION BY p.page_id ORDER BY length(r.host || r.path) DESC, length(r.host) DESC) AS k
  FROM parsed p JOIN rules r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path))
SELECT p.page_id, p.host, p.path, f.rule, coalesce(f.verdict, 'allow') AS verdict
FROM parsed p LEFT JOIN fits f ON f.page_id = p.page_id AND f.k = 1
"""


def op4_document_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Null texts are empty; of one doc_id, the order among rows is that of the operator. A table of one row is its own next one; an empty table gives none."""
    docs = read(spark, sf_dir, "documents")
    text = text_or_empty()
    near = bottom_k.with_next(docs, [text.alias("text"), bottom_k.sketch(text).alias("sketch")])
    changed = near.select(
        "doc_id",
        F.length("row.text").cast("long").alias("n_chars"),
        F.col("row.sketch").alias("sketch"),
        F.col("next.sketch").alias("next_sketch"),
        bottom_k.edited(F.col("row.text"), F.col("next.text")).alias("edited"),
    )
    sketched = changed.select(
        "doc_id", "n_chars", "sketch", "next_sketch",
        F.sha2("edited", 256).alias("edited_sha256"),
        bottom_k.sketch(F.col("edited")).alias("edited_sketch"),
    )
    return sketched.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        bottom_k.as_text(F.col("sketch")).alias("fingerprint"),
        bottom_k.as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        bottom_k.resemblance(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        bottom_k.resemblance(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
    )


def op6_source_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A null source is a source of its own; rows of one doc_id are drawn alike. All columns stay; an empty table gives none."""
    return mixing.mix(read(spark, sf_dir, "documents"), power=0.5, seed=1)


OP6_SQL = """
WITH RECURSIVE counts AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
rates AS (SELECT source, sqrt(n::DOUBLE) / (SELECT sum(sqrt(n::DOUBLE)) FROM counts)
  * (SELECT sum(n)::DOUBLE FROM counts) / n AS rate FROM counts),
cdf(source, rate, n, p, below) AS (
  SELECT source, rate, 0, exp(-rate), exp(-rate) FROM rates
  UNION ALL SELECT source, rate, n + 1, p * rate / (n + 1), below + p * rate / (n + 1) FROM cdf
  WHERE n < ceil(rate + 12 * sqrt(rate) + 30)),
drawn AS (SELECT d.*, ('0x' || substr(md5('1|' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS u
  FROM documents d),
counted AS (SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars,
  (SELECT count(*) FROM cdf c WHERE c.source IS NOT DISTINCT FROM d.source AND c.below <= d.u) AS copies FROM drawn d),
copied AS (SELECT doc_id, text, lang, source, n_chars, unnest(range(1, copies + 1))::INTEGER AS copy FROM counted)
SELECT doc_id, text, lang, source, n_chars, copy,
  ('0x' || substr(md5('order1|' || coalesce(doc_id::VARCHAR, '') || '|' || copy::VARCHAR), 1, 15))::BIGINT AS shuffle_key
FROM copied
"""


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Null texts are empty; a null doc_id counts as smallest, and of rows equal in doc_id and text one is kept. An empty table gives none."""
    return block_names.copy_classes(read(spark, sf_dir, "documents"))


OP7_SQL = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
  doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
"""

#: Schemas of the tools that op2's derived calls name; ``count`` is left out, so its calls are of an unknown tool.
TOOL_SCHEMAS = {
    "search": {
        "properties": {"query": {"type": "string", "minLength": 1, "maxLength": 400}, "limit": {"type": "integer", "minimum": 1}},
        "required": ["query", "limit"],
        "additionalProperties": False,
    },
    "translate": {
        "properties": {"text": {"type": "string"}, "formal": {"type": "boolean"}},
        "required": ["text"],
    },
}


def derived_tool_calls(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results derived from turns, since the table has no tool turns.

    Each assistant turn stands for a call whose arguments hold its text, each other turn for the result of the call one
    turn before. Turns without conversation or number have no identifier, so they stay unlinked. A call depends on the assistant turn two turns before, except on every fourth. Some calls lack
    results, some results lack calls, some arguments break their schema.
    """
    turn = F.col("turn")
    identifier = lambda t: F.concat(F.lit("call-"), F.col("conv_id").cast("string"), F.lit("-"), t.cast("string"))
    kind = F.pmod(turn + F.col("conv_id"), F.lit(5))
    calls = conversations.where("role = 'assistant'").select(
        "conv_id",
        identifier(turn).alias("call_id"),
        "turn",
        F.when(kind < 2, "search").when(kind < 4, "translate").otherwise("count").alias("name"),
        F.when(kind < 2, F.to_json(F.struct(F.length("text").alias("limit"), F.col("text").alias("query"))))
        .otherwise(F.to_json(F.struct(F.col("text").alias("text"), (turn % 4 == 1).alias("formal")))).alias("arguments"),
        F.when(turn % 8 < 2, F.array().cast("array<string>")).otherwise(F.array(identifier(turn - 2))).alias("depends_on"),
    )
    results = conversations.where("role IS DISTINCT FROM 'assistant'").select(
        "conv_id", identifier(turn - 1).alias("call_id"), F.col("text").alias("content")
    )
    return calls, results


def op2_tool_call_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every turn is a call or a result. Turns without conversation or number match nothing; a null text leaves its argument or content out."""
    calls, results = derived_tool_calls(read(spark, sf_dir, "conversations"))
    return tool_calls.link_calls(calls, results, TOOL_SCHEMAS)


def op3_toxic_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Empty and null texts get the score of texts without a toxic passage; a row per row, null doc_ids too (held out by the checksum of no text: never)."""
    found = toxic_passages.toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return found.select(
        "doc_id", "held_out", "score", (F.col("score") >= 0.3).cast("int").alias("predicted"),
        "n_tokens", F.size("passages").alias("n_passages"),
    )


def op5_covering_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Null, empty and white texts have fingerprint zero and are linked; a null doc_id is an id only where a component has no other."""
    return covering_simhash.near_classes(read(spark, sf_dir, "documents"), words=4, radius=4)


def op8_tag_path_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Null and empty pages have an empty text; repeated rows are read again, an empty table gives none."""
    found = tag_paths.extract_articles(read(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op9_piece_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Null texts are empty and have no tokens; a row per row, in no order."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    counted = piece_counts.count_tokens(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return counted.withColumn("over_limit", F.col("n_tokens") > 4096)


def op10_word_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Null texts are empty: no ids, the digests of the empty text. Equal rows give equal rows."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    ws = Workspace(spark, "encode")
    return word_automaton.encode(ws, docs, public_tokenizers.path("word_bpe_49k.json"), digests=True)


def damaged(conversations: DataFrame) -> DataFrame:
    """Turns after damage by the checksum of ``conv_id:turn`` (nulls: one space): a twentieth each is dropped, emptied,
    stripped of sentence ends, repeated or given to the user."""
    space = F.lit(" ")
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    marked = conversations.select(
        "conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"), (F.crc32(name) % 20).alias("fault")
    )
    fault = F.col("fault")
    return marked.where(fault != 0).select(
        "conv_id",
        "turn",
        F.when(fault == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(fault == 1, "").when(fault == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.when(fault == 3, 2).otherwise(1).alias("copies"),
    )


def op11_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conv_id gets a row, a null one too; rows of one turn are ordered by role and text."""
    conversations = read(spark, sf_dir, "conversations")
    return turn_repair.audit(Workspace(spark, "turns"), damaged(conversations), conversations)


def op12_id_range_coder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Null texts have the end id alone; null doc_ids come first; equal rows are all written. Files stay for the reader."""
    folder = f"{Workspace(spark, 'ids').root}/ids"
    id_files.write_ids(read(spark, sf_dir, "documents"), folder, public_tokenizers.path("byte_bpe_50k.json"), end=0)
    return id_files.read_documents(spark, folder)


def op13_contour_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows without a finite vector are left out; null and repeated vec_ids are kept as they are."""
    return whitening.whiten(read(spark, sf_dir, "embeddings"), components=32)


QUERIES = {
    f.__name__: f
    for f in (
        op1_url_filter, op2_tool_call_linking, op3_toxic_passages, op4_document_sketches, op5_covering_simhash,
        op6_source_mixture, op7_exact_dedup, op8_tag_path_text, op9_piece_counts, op10_word_automaton,
        op11_turn_repair, op12_id_range_coder, op13_contour_whitening,
    )
}
SQL = {"op1_url_filter": OP1_SQL, "op6_source_mixture": OP6_SQL, "op7_exact_dedup": OP7_SQL}

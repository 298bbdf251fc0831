"""The registered queries of this subpackage: ``op<N>_<name>`` with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillon.llm import byte_bpe, chat_format, decontaminate, frames, line_dedup, quality_rules, secret_scan, sharding, simhash, substring_dedup, token_counts

BYTE_BPE = "byte_bpe_50k.tiktoken"
PIECE_BPE = "piece_bpe_32k.model"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: What the exchanges of `conversations` have to satisfy; long prompts and late turns do not.
REPLY = {
    "reply": {
        "type": "object",
        "properties": {
            "prompt": {
                "type": "object",
                "properties": {"text": {"type": "string", "minLength": 1, "maxLength": 400}, "tags": {"type": "array", "items": {"enum": ["user"]}}},
                "required": ["text", "tags"],
                "additionalProperties": False,
            },
            "turn": {"type": "integer", "minimum": 0, "maximum": 5},
        },
        "required": ["prompt", "turn"],
        "additionalProperties": False,
    }
}


def marked_up(messages: DataFrame) -> DataFrame:
    """`conversations`, which hold no tool calls, as messages with marked-up ones; every row becomes one or two.

    A user turn calls ``reply`` with its text as a nested argument and waits
    for the two exchanges before it; the assistant turn after it is the result;
    a system turn is a result that nobody asked for.  In one conversation of 50
    the exchanges wait for the next one too, which closes cycles; in one of
    seven each call is marked twice.
    """
    conv, turn, role = F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.col("role")
    name = lambda k: F.concat(F.lit("c"), k.cast("string"))
    mark = lambda tag, x: F.concat(F.lit(f"<{tag}>"), F.replace(F.to_json(x), F.lit("<"), F.lit("\\u003c")), F.lit(f"</{tag}>"))
    after = F.array_compact(F.array(name(turn - 2), name(turn - 4), F.when(conv % 50 == 3, name(turn + 2))))
    arguments = F.struct(F.struct("text", F.array(role).alias("tags")).alias("prompt"), turn.alias("turn"))
    call = mark("tool_call", F.struct(name(turn).alias("id"), F.lit("reply").alias("name"), arguments.alias("arguments"), after.alias("after")))
    result = lambda of: mark("tool_result", F.struct(of.alias("id"), F.struct("text").alias("content")))
    text = F.when(role == "user", F.when(conv % 7 == 0, F.concat(call, F.lit(" again: "), call)).otherwise(call))
    text = text.when(role == "assistant", result(name(turn - 1))).otherwise(result(F.concat(F.lit("s"), turn.cast("string"))))
    return messages.select(conv.alias("conv_id"), turn.alias("turn"), F.when(role == "user", "assistant").otherwise("tool").alias("role"), text.alias("text"))


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every exchange of `conversations` parsed, linked, ordered, validated and serialised."""
    linked = chat_format.link(*chat_format.parse(marked_up(table(spark, sf_dir, "conversations"))), REPLY)
    return linked.select("conv_id", "call_id", "turn", "result_turn", "status", "level", F.size("errors").alias("n_errors"), F.sha2("canonical_json", 256).alias("json_sha256"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = line_dedup.dedup_lines(docs, min_docs=10)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    made = byte_bpe.encode(docs, public_tokenizers.path(BYTE_BPE), public_tokenizers.PATTERN)
    return made.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), words=3, lanes=1, limit=3)


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contaminated documents only: doc_id, item_id and the coverage of the item."""
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.dedup_substrings(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rated = quality_rules.rate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return rated.select("doc_id", *quality_rules.STATS, "base_failed", "kept")


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"), shards=24)


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Starts from an empty cache of its own, so that every call does the whole work."""
    cache = frames.scratch(spark, "token-counts")
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(PIECE_BPE), cache)


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every candidate of `documents` with its score and whether it is a secret; trained on the built-in labelled findings."""
    docs = table(spark, sf_dir, "documents")
    corpus = secret_scan.learn_corpus(docs)
    model = secret_scan.train(secret_scan.seed_findings(spark, secret_scan.frequent(corpus)), corpus)
    return secret_scan.scan(docs, model)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_chat_format, op2_line_dedup, op3_byte_bpe, op4_simhash, op5_decontaminate, op6_substring_dedup, op7_quality_rules, op8_sharding, op9_token_counts, op10_secret_scan)
}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: DuckDB SQL for the queries that SQL can express.
ORACLES: dict[str, str] = {
    # Levels come from islands of turns, not from the calls' own links.
    "op1_chat_format": """WITH gaps AS (SELECT *, coalesce(turn - lag(turn) OVER w > 4, TRUE) AS fresh FROM conversations WHERE role = 'user' WINDOW w AS (PARTITION BY conv_id, turn % 2 ORDER BY turn)),
 islands AS (SELECT *, sum(CASE WHEN fresh THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id, turn % 2 ORDER BY turn) AS island FROM gaps),
 places AS (SELECT *, row_number() OVER w - 1 AS place, count(*) OVER (PARTITION BY conv_id, turn % 2, island) AS size FROM islands WINDOW w AS (PARTITION BY conv_id, turn % 2, island ORDER BY turn)),
 asked AS (SELECT conv_id, turn, 'c' || turn AS call_id, text, CASE WHEN conv_id % 50 <> 3 OR size = 1 THEN place END AS level,
 CASE WHEN length(text) BETWEEN 1 AND 400 THEN 0 ELSE 1 END + CASE WHEN turn > 5 THEN 1 ELSE 0 END AS n_errors FROM places),
 told AS (SELECT conv_id, turn AS result_turn, text AS content, CASE WHEN role = 'assistant' THEN 'c' || (turn - 1) ELSE 's' || turn END AS call_id FROM conversations WHERE role <> 'user'),
 j AS (SELECT conv_id, call_id, turn, result_turn, level, coalesce(n_errors, 0) AS n_errors, text, content,
 CASE WHEN turn IS NULL THEN 'orphan' WHEN result_turn IS NULL THEN 'unanswered' ELSE 'linked' END AS status FROM asked FULL OUTER JOIN told USING (conv_id, call_id)
 UNION ALL SELECT conv_id, call_id, turn, NULL, NULL, n_errors, text, NULL, 'repeated' FROM asked WHERE conv_id % 7 = 0)
 SELECT conv_id, call_id, turn, result_turn, status, CAST(level AS INT) AS level, CAST(n_errors AS INT) AS n_errors, sha256('{"arguments":' ||
 CASE WHEN turn IS NULL THEN 'null' ELSE '{"prompt":{"tags":["user"]' || coalesce(',"text":' || CAST(to_json(text) AS VARCHAR), '') || '},"turn":' || turn || '}' END ||
 ',"id":"' || call_id || '","name":' || CASE WHEN turn IS NULL THEN 'null' ELSE '"reply"' END ||
 ',"result":' || CASE WHEN result_turn IS NULL THEN 'null' ELSE '{' || coalesce('"text":' || CAST(to_json(content) AS VARCHAR), '') || '}' END ||
 ',"status":"' || status || '","valid":' || CASE WHEN n_errors = 0 THEN 'true' ELSE 'false' END || '}') AS json_sha256 FROM j""",
    "op2_line_dedup": f"""WITH split AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
 l AS (SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS place FROM split),
 k AS (SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{_UPPER}', '{_LOWER}') AS key FROM l),
 hot AS (SELECT key FROM (SELECT DISTINCT doc_id, key FROM k WHERE key <> '') GROUP BY key HAVING count(*) >= 10)
 SELECT doc_id, count(*) AS n_lines, count(hot.key) AS n_dropped, sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE hot.key IS NULL), '')) AS kept_sha256
 FROM k LEFT JOIN hot ON k.key = hot.key GROUP BY doc_id""",
    "op6_substring_dedup": r"""WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
 p AS (SELECT doc_id, unnest(range(len(ws))) AS i, unnest(ws) AS word FROM w),
 g AS (SELECT doc_id, i, string_agg(word, ' ') OVER s AS win, count(*) OVER s AS n FROM p WINDOW s AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 12 FOLLOWING)),
 f AS (SELECT win, min(doc_id) AS m FROM g WHERE n = 13 GROUP BY win), hit AS (SELECT g.doc_id, g.i FROM g JOIN f ON g.win = f.win WHERE g.n = 13 AND f.m < g.doc_id),
 gone AS (SELECT DISTINCT hit.doc_id, hit.i + r.k AS i FROM hit, range(13) r(k))
 SELECT w.doc_id, count(p.i) AS n_words, count(gone.i) AS n_removed, sha256(coalesce(string_agg(p.word, ' ' ORDER BY p.i) FILTER (WHERE gone.i IS NULL), '')) AS kept_sha256
 FROM w LEFT JOIN p ON w.doc_id = p.doc_id LEFT JOIN gone ON p.doc_id = gone.doc_id AND p.i = gone.i GROUP BY w.doc_id""",
}

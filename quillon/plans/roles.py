"""The driver's tables cast in the roles that the operators work on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from quillon.operators.ranking import group_places


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records: an order with its customer."""
    joined = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    return joined.selectExpr(
        "concat('exp_', o_orderkey) AS experiment_id", "o_orderkey AS ordinal", "concat('arm_', o_custkey % 50) AS name", "c_mktsegment AS model_type",
        "CASE o_orderstatus WHEN 'F' THEN 'failed' WHEN 'O' THEN 'completed' ELSE 'partial' END AS status",
        "CASE WHEN o_orderkey % 20 = 0 THEN 'sweep_aggregate' WHEN o_orderkey % 20 = 1 THEN 'sweep_failure' ELSE 'training' END AS record_type",
        "date_format(o_orderdate, 'yyyy-MM-dd') AS created_at", "concat('sw_', o_custkey % 40) AS sweep_id",
        "md5(concat(o_custkey % 300, '|', o_orderkey % 3)) AS fingerprint", "md5(concat(o_custkey % 300, '|', o_orderkey % 6)) AS provenance_hash",
        "o_totalprice / 500000D AS metric_a", "CASE WHEN o_orderkey % 7 != 0 THEN ((o_orderkey * 37) % 1000) / 1000D END AS metric_b",
        "split(o_orderpriority, '-') AS tags", "CAST(o_orderkey % 600 AS DOUBLE) AS duration_seconds", "o_orderkey % 4 AS seed",
    )


LEDGER = """ledger AS (SELECT 'exp_' || o_orderkey AS experiment_id, o_orderkey AS ordinal, 'arm_' || (o_custkey % 50) AS name, c_mktsegment AS model_type,
 CASE o_orderstatus WHEN 'F' THEN 'failed' WHEN 'O' THEN 'completed' ELSE 'partial' END AS status,
 CASE WHEN o_orderkey % 20 = 0 THEN 'sweep_aggregate' WHEN o_orderkey % 20 = 1 THEN 'sweep_failure' ELSE 'training' END AS record_type,
 strftime(o_orderdate, '%Y-%m-%d') AS created_at, 'sw_' || (o_custkey % 40) AS sweep_id,
 md5((o_custkey % 300) || '|' || (o_orderkey % 3)) AS fingerprint, md5((o_custkey % 300) || '|' || (o_orderkey % 6)) AS provenance_hash,
 o_totalprice / CAST(500000 AS DOUBLE) AS metric_a, CASE WHEN o_orderkey % 7 != 0 THEN ((o_orderkey * 37) % 1000) / CAST(1000 AS DOUBLE) END AS metric_b,
 string_split(o_orderpriority, '-') AS tags, CAST(o_orderkey % 600 AS DOUBLE) AS duration_seconds, o_orderkey % 4 AS seed
 FROM orders JOIN customer ON o_custkey = c_custkey)"""

ORDER = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount", "l_tax", "l_shipdate")


def trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trades of cells (return flag, line status): seed, pnl, idx within cell and trade_idx within seed."""
    lines = table(spark, sf_dir, "lineitem")
    cell = ["l_returnflag", "l_linestatus"]
    rows = lines.select(*cell, (F.col("l_suppkey") % 5).alias("seed"), (F.col("l_extendedprice") * (F.col("l_discount") - 0.05) / 100000).alias("pnl"), *[c for c in ORDER])
    idx = F.row_number().over(Window.partitionBy(*cell).orderBy(*ORDER)) - 1
    own = F.row_number().over(Window.partitionBy(*cell, "seed").orderBy(*ORDER)) - 1
    return rows.select(F.col("l_returnflag").alias("model"), F.col("l_linestatus").alias("ret"), "seed", "pnl", idx.cast("long").alias("idx"), own.cast("long").alias("trade_idx"))


def numbered_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All trades as (model, ret, seed, value, idx), idx from 0 without gaps in each cell; numbered over ranges, not by cell."""
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("model"), F.col("l_linestatus").alias("ret"), *ORDER)
    value = F.col("l_extendedprice") * (F.col("l_discount") - 0.05) / 100000
    return group_places(rows, ["model", "ret"], ORDER, [(F.col("l_suppkey") % 5).alias("seed"), value.alias("value")])


TRADES = """trades AS (SELECT l_returnflag AS model, l_linestatus AS ret, l_suppkey % 5 AS seed, l_extendedprice * (l_discount - CAST(0.05 AS DOUBLE)) / 100000 AS pnl,
 row_number() OVER (PARTITION BY l_returnflag, l_linestatus ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity, l_discount, l_tax, l_shipdate) - 1 AS idx,
 row_number() OVER (PARTITION BY l_returnflag, l_linestatus, l_suppkey % 5 ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity, l_discount, l_tax, l_shipdate) - 1 AS trade_idx FROM lineitem)"""


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Epochs of runs: the lines of an order."""
    lines = table(spark, sf_dir, "lineitem")
    epoch = F.row_number().over(Window.partitionBy("l_orderkey").orderBy(*ORDER[1:])) - 1
    loss = F.when((F.col("l_orderkey") % 11) != 0, F.col("l_extendedprice") / F.col("l_quantity"))
    return lines.select(F.col("l_orderkey").alias("experiment_id"), epoch.cast("long").alias("epoch"), loss.alias("val_loss"), F.col("l_discount").alias("val_macro_f1"))


HISTORY = """history AS (SELECT l_orderkey AS experiment_id, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity, l_discount, l_tax, l_shipdate) - 1 AS epoch,
 CASE WHEN l_orderkey % 11 != 0 THEN l_extendedprice / l_quantity END AS val_loss, l_discount AS val_macro_f1 FROM lineitem)"""


def signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Treatments (event types) whose predictions share the label of ``view`` events at the same place."""
    e = table(spark, sf_dir, "events").select("event_type", "value", (F.row_number().over(Window.partitionBy("event_type").orderBy("ts", "event_id")) - 1).cast("long").alias("sample_idx"))
    label = e.filter("event_type = 'view'").select("sample_idx", F.col("value").alias("label"))
    shared = e.groupBy("sample_idx").agg(F.count("*").alias("k")).filter("k = 5").select("sample_idx")
    rows = e.filter("event_type <> 'view'").join(shared, "sample_idx").join(label, "sample_idx")
    return rows.select(F.col("event_type").alias("treatment"), "sample_idx", "label", (F.col("value") + F.col("label") * (F.length("event_type") - 4) / 10).alias("pred"))


SIGNALS = """e AS (SELECT event_type, value, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) - 1 AS sample_idx FROM events),
 shared AS (SELECT sample_idx FROM e GROUP BY sample_idx HAVING count(*) = 5),
 signals AS (SELECT a.event_type AS treatment, a.sample_idx, v.value AS label, a.value + v.value * (length(a.event_type) - 4) / CAST(10 AS DOUBLE) AS pred
 FROM e a JOIN e v ON v.event_type = 'view' AND v.sample_idx = a.sample_idx JOIN shared s ON s.sample_idx = a.sample_idx WHERE a.event_type <> 'view')"""


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three raters of documents' quality, and the label."""
    joined = table(spark, sf_dir, "labels").join(table(spark, sf_dir, "documents").select("doc_id", "n_chars", "lang"), "doc_id")
    return joined.selectExpr("doc_id AS sample_idx", "CAST(quality AS INT) AS label", "lang", "CAST(n_chars > 900 AS INT) AS p1", "CAST(n_chars % 3 > 0 AS INT) AS p2", "CAST(1 - toxic AS INT) AS p3", "CAST(n_chars % 100 AS DOUBLE) / 100 AS confidence")


PREDICTIONS = """predictions AS (SELECT l.doc_id AS sample_idx, CAST(quality AS INT) AS label, lang, CAST(n_chars > 900 AS INT) AS p1, CAST(n_chars % 3 > 0 AS INT) AS p2,
 CAST(1 - toxic AS INT) AS p3, CAST(n_chars % 100 AS DOUBLE) / 100 AS confidence FROM labels l JOIN documents d ON l.doc_id = d.doc_id)"""


def raters(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = predictions(spark, sf_dir)
    return p.selectExpr("sample_idx", "label", "lang", "confidence", "stack(3, 'p1', p1, 'p2', p2, 'p3', p3) AS (rater, prediction)")


RATERS = PREDICTIONS + """, raters AS (SELECT sample_idx, label, lang, confidence, 'p1' AS rater, p1 AS prediction FROM predictions UNION ALL
 SELECT sample_idx, label, lang, confidence, 'p2', p2 FROM predictions UNION ALL SELECT sample_idx, label, lang, confidence, 'p3', p3 FROM predictions)"""


def cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").selectExpr("md5(url) AS cache_key", "CAST(page_id AS DOUBLE) AS mtime", "CAST(length(html) AS BIGINT) AS size_bytes", "page_id % 11 = 0 AS pinned")


CACHE = "cache AS (SELECT md5(url) AS cache_key, CAST(page_id AS DOUBLE) AS mtime, CAST(length(html) AS BIGINT) AS size_bytes, page_id % 11 = 0 AS pinned FROM pages)"


def verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Discoveries: documents, some with the fingerprint of a ledger record."""
    d = table(spark, sf_dir, "documents")
    return d.selectExpr(
        "concat('probe_', doc_id) AS probe_id", "doc_id AS ordinal", "md5(concat(doc_id % 400, '|', doc_id % 3)) AS fingerprint", "concat('study_', lang) AS name",
        "CASE doc_id % 4 WHEN 0 THEN 'GO' WHEN 1 THEN 'REFUTE' WHEN 2 THEN 'INDETERMINATE' END AS verdict", "doc_id % 5 = 0 AS edge",
        "concat('0.', doc_id % 3, '.', doc_id % 7, CASE WHEN doc_id % 2 = 0 THEN '-dev' ELSE '' END) AS stats_version",
        "CASE WHEN doc_id % 10 < 8 THEN '1.0' WHEN doc_id % 10 = 8 THEN '0.9' END AS schema_version",
        "CASE WHEN doc_id % 13 = 0 THEN array('late field', 'odd unit') ELSE array() END AS parse_warnings",
    )


VERDICTS = """verdicts AS (SELECT 'probe_' || doc_id AS probe_id, doc_id AS ordinal, md5((doc_id % 400) || '|' || (doc_id % 3)) AS fingerprint, 'study_' || lang AS name,
 CASE doc_id % 4 WHEN 0 THEN 'GO' WHEN 1 THEN 'REFUTE' WHEN 2 THEN 'INDETERMINATE' END AS verdict, doc_id % 5 = 0 AS edge,
 '0.' || (doc_id % 3) || '.' || (doc_id % 7) || CASE WHEN doc_id % 2 = 0 THEN '-dev' ELSE '' END AS stats_version,
 CASE WHEN doc_id % 10 < 8 THEN '1.0' WHEN doc_id % 10 = 8 THEN '0.9' END AS schema_version, doc_id % 13 = 0 AS warned FROM documents)"""


def attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An attempt log: events of a user are attempts of a task."""
    e = table(spark, sf_dir, "events")
    return e.selectExpr("user_id AS task_id", "ts", "event_id", "CASE WHEN event_type = 'purchase' THEN 'success' ELSE 'failed' END AS status", "CASE event_type WHEN 'error' THEN 'oom' WHEN 'signup' THEN 'io_error' WHEN 'click' THEN 'assertion' WHEN 'view' THEN 'gpu_acquire_timeout' END AS error_kind")


ATTEMPTS = """log AS (SELECT user_id AS task_id, ts, event_id, CASE WHEN event_type = 'purchase' THEN 'success' ELSE 'failed' END AS status,
 CASE event_type WHEN 'error' THEN 'oom' WHEN 'signup' THEN 'io_error' WHEN 'click' THEN 'assertion' WHEN 'view' THEN 'gpu_acquire_timeout' END AS error_kind FROM events),
 stamped AS (SELECT *, row_number() OVER (PARTITION BY task_id ORDER BY ts, event_id) AS attempt FROM log)"""


def axes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three axes: regions, nations, market segments."""
    w = lambda c: (F.row_number().over(Window.orderBy(c)) - 1).cast("long")  # noqa: E731  tables of a few rows
    entry = lambda k, v: F.map_from_arrays(F.array(F.lit(k)), F.array(v.cast("string")))
    r = table(spark, sf_dir, "region").select(F.lit("region").alias("axis"), F.lit(0).alias("axis_pos"), F.replace(F.replace(F.col("r_name"), F.lit(" "), F.lit("_")), F.lit("."), F.lit("_")).alias("label"), w("r_regionkey").alias("value_pos"), entry("data.region", F.col("r_regionkey")).alias("overrides"))
    n = table(spark, sf_dir, "nation").select(F.lit("nation").alias("axis"), F.lit(1).alias("axis_pos"), F.col("n_name").alias("label"), w("n_nationkey").alias("value_pos"), entry("model.nation", F.col("n_nationkey")).alias("overrides"))
    m = table(spark, sf_dir, "customer").select("c_mktsegment").distinct().select(F.lit("segment").alias("axis"), F.lit(2).alias("axis_pos"), F.col("c_mktsegment").alias("label"), w("c_mktsegment").alias("value_pos"), entry("train.segment", F.col("c_mktsegment")).alias("overrides"))
    return r.unionByName(n).unionByName(m)

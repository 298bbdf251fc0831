"""The registered queries over the driver's tables, each with DuckDB SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillon.functions import scalars as S
from quillon.functions.semantics import choose
from quillon.operators.ranking import asof
from quillon.operators import gates, grid, identity, monitor, records, reduce, scheduling, stats, validation
from quillon.plans import roles as R
from quillon.plans.roles import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

REPS = 1000  # replicates of registered bootstrap queries; operators default to 10,000
PLAIN_REPS = 100  # of the plain bootstrap over all trades, which draws every trade in every replicate


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def rounded(df: DataFrame, *columns: str, digits: int = 8) -> DataFrame:
    """Rounds, and turns a negative zero into zero, so that engines which sum in another order agree."""
    return df.withColumns({c: F.round(F.col(c), digits) + F.lit(0.0) for c in columns})


# --- records ----------------------------------------------------------------


@query(f"""WITH {R.LEDGER}, hits AS (SELECT * FROM ledger WHERE status = 'completed' AND record_type = 'training' AND created_at >= '1996-01-01'),
 ranked AS (SELECT experiment_id, model_type AS "group", metric_a, metric_b, row_number() OVER (ORDER BY metric_b DESC NULLS LAST, ordinal) AS "rank" FROM hits)
 SELECT experiment_id, "group", round(metric_a, 8) AS metric_a, round(metric_b, 8) AS metric_b, "rank" FROM ranked WHERE "rank" <= 25""")
def rank_topk_grouped(spark, sf_dir):
    """Filter, project, rank nulls-last, keep 25, label groups."""
    wanted = records.RecordFilter(status="completed", created_after="1996-01-01")
    rows = records.filter_records(records.without_kinds(R.ledger(spark, sf_dir), "sweep_aggregate", "sweep_failure"), wanted)
    return rounded(records.compare(rows, ["metric_a", "metric_b"], "metric_b", k=25, group_by="model_type"), "metric_a", "metric_b")


@query(f"""WITH {R.LEDGER} SELECT experiment_id, name, status FROM ledger WHERE list_contains(tags, 'HIGH') AND model_type = 'BUILDING' AND status = 'failed'
 AND created_at >= '1995-02-01' AND created_at <= '1999-12-31' AND coalesce(metric_b, 0) >= 0.25""")
def filter_records(spark, sf_dir):
    wanted = records.RecordFilter(tags=["HIGH"], model_type="BUILDING", status="failed", created_after="1995-02-01", created_before="1999-12-31", floors={"metric_b": 0.25})
    return records.filter_records(R.ledger(spark, sf_dir), wanted).select("experiment_id", "name", "status")


@query(f"""WITH {R.LEDGER}, hits AS (SELECT * FROM ledger WHERE record_type = 'training' AND model_type = 'MACHINERY' AND status = 'completed'),
 best AS (SELECT * FROM hits WHERE metric_b IS NOT NULL ORDER BY metric_b DESC, ordinal LIMIT 1)
 SELECT experiment_id, round(metric_b, 8) AS metric_b, n_matches FROM (SELECT count(*) AS n_matches FROM hits) LEFT JOIN best ON TRUE WHERE n_matches > 0""")
def prior_best(spark, sf_dir):
    best = records.prior_best(R.ledger(spark, sf_dir), "metric_b", {"model_type": "MACHINERY", "status": "completed", "sweep_id": ""})
    return rounded(best.select("experiment_id", "metric_b", "n_matches"), "metric_b")


@query(f"""WITH {R.LEDGER}, t AS (SELECT unnest(tags) AS key, ordinal, unnest(range(len(tags))) AS place FROM ledger),
 top AS (SELECT key, count(*) AS n FROM t GROUP BY key ORDER BY n DESC, min(ordinal * 10 + place) LIMIT 10)
 SELECT 'total' AS section, 'all' AS key, count(*) AS n FROM ledger UNION ALL SELECT 'status', status, count(*) FROM ledger GROUP BY status
 UNION ALL SELECT 'model_type', model_type, count(*) FROM ledger GROUP BY model_type UNION ALL SELECT 'tag', key, n FROM top""")
def ledger_summary(spark, sf_dir):
    return records.summary(R.ledger(spark, sf_dir))


@query(f"""WITH {R.LEDGER} SELECT sweep_id AS run_id, CASE WHEN bool_or(status = 'failed' AND duration_seconds > 590) THEN 'failed' WHEN bool_and(status <> 'partial' OR duration_seconds < 595) THEN 'completed' ELSE 'partial' END AS status
 FROM ledger GROUP BY sweep_id""")
def run_status(spark, sf_dir):
    s = choose(((F.col("status") == "failed") & (F.col("duration_seconds") > 590), "failed"), ((F.col("status") != "partial") | (F.col("duration_seconds") < 595), "completed"), otherwise="partial")
    return records.run_status(R.ledger(spark, sf_dir).select(F.col("sweep_id").alias("run_id"), s.alias("status")))


def _long(df: DataFrame) -> DataFrame:
    """A record as (experiment_id, section, path, value)."""
    parts = [("config", "model_type"), ("config", "sweep_id"), ("metrics", "metric_a"), ("metrics", "metric_b"), ("hash", "fingerprint"), ("metrics", "duration_seconds")]
    value = lambda c: F.round(F.col(c), 6).cast("string") if c.startswith("metric") or c.startswith("duration") else F.col(c)
    return df.select("experiment_id", F.inline(F.array(*[F.struct(F.lit(s).alias("section"), F.lit(c).alias("path"), value(c).alias("value")) for s, c in parts])))


@query(f"""WITH {R.LEDGER}, pair AS (SELECT max(CASE WHEN ordinal = 8 THEN metric_a END) AS a0, max(CASE WHEN ordinal = 9 THEN metric_a END) AS a1, max(CASE WHEN ordinal = 8 THEN metric_b END) AS b0,
 max(CASE WHEN ordinal = 9 THEN metric_b END) AS b1, max(CASE WHEN ordinal = 8 THEN duration_seconds END) AS d0, max(CASE WHEN ordinal = 9 THEN duration_seconds END) AS d1,
 max(CASE WHEN ordinal = 8 THEN model_type END) AS m0, max(CASE WHEN ordinal = 9 THEN model_type END) AS m1, max(CASE WHEN ordinal = 8 THEN sweep_id END) AS s0, max(CASE WHEN ordinal = 9 THEN sweep_id END) AS s1,
 max(CASE WHEN ordinal = 8 THEN fingerprint END) AS f0, max(CASE WHEN ordinal = 9 THEN fingerprint END) AS f1 FROM ledger WHERE ordinal IN (8, 9)),
 diffs AS (SELECT 'metrics/metric_a' AS path, CAST(NULL AS VARCHAR) AS a, CAST(NULL AS VARCHAR) AS b, round(a1, 6) - round(a0, 6) AS delta, round(a1, 6) IS DISTINCT FROM round(a0, 6) AS bad FROM pair
 UNION ALL SELECT 'metrics/metric_b', NULL, NULL, round(b1, 6) - round(b0, 6), round(b1, 6) IS DISTINCT FROM round(b0, 6) FROM pair UNION ALL SELECT 'metrics/duration_seconds', NULL, NULL, d1 - d0, d1 IS DISTINCT FROM d0 FROM pair
 UNION ALL SELECT 'config/model_type', m0, m1, NULL, m0 IS DISTINCT FROM m1 FROM pair UNION ALL SELECT 'config/sweep_id', s0, s1, NULL, s0 IS DISTINCT FROM s1 FROM pair
 UNION ALL SELECT 'hash/fingerprint', f0, f1, NULL, f0 IS DISTINCT FROM f1 FROM pair)
 SELECT path, a, b, round(delta, 6) AS delta FROM diffs WHERE bad""")
def diff_records(spark, sf_dir):
    out = records.diff_records(_long(R.ledger(spark, sf_dir)), "exp_8", "exp_9")
    text = lambda c: F.when(~F.col("path").startswith("metrics"), F.col(c))
    return out.select("path", text("a").alias("a"), text("b").alias("b"), F.when(F.col("path").startswith("metrics"), F.round("delta", 6) + 0.0).alias("delta"))


@query(f"""WITH {R.LEDGER}, cand AS (SELECT experiment_id, fingerprint FROM ledger WHERE created_at >= '1998-01-01'), old AS (SELECT * FROM ledger WHERE created_at < '1996-06-01')
 SELECT experiment_id, fingerprint FROM cand c WHERE NOT EXISTS (SELECT 1 FROM old o WHERE o.fingerprint = c.fingerprint AND o.record_type <> 'sweep_failure')""")
def dedup_new_only(spark, sf_dir):
    all_ = R.ledger(spark, sf_dir)
    cand = all_.filter("created_at >= '1998-01-01'").select("experiment_id", "fingerprint")
    return records.new_only(cand, all_.filter("created_at < '1996-06-01'")).select("experiment_id", "fingerprint")


@query(f"""WITH {R.LEDGER}, cells AS (SELECT DISTINCT name, seed FROM ledger WHERE status = 'completed' AND metric_b > 0.985), expected AS (SELECT 'arm_' || a.i AS name, s.i AS seed FROM range(50) a(i), range(4) s(i))
 SELECT name, seed FROM expected WHERE NOT EXISTS (SELECT 1 FROM cells c WHERE c.name = expected.name AND c.seed = expected.seed)""")
def expected_missing(spark, sf_dir):
    expected = spark.range(50).select(F.concat(F.lit("arm_"), "id").alias("name"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(3).cast("long"))).alias("seed"))
    return records.expected_missing(expected, R.ledger(spark, sf_dir).filter("status = 'completed' AND metric_b > 0.985"), ["name", "seed"])


@query(f"""WITH {R.LEDGER} SELECT 'metric_a' AS metric, count(metric_a) = 0 AS unresolved FROM ledger UNION ALL SELECT 'metric_b', count(CASE WHEN ordinal % 7 = 0 THEN metric_b END) = 0 FROM ledger""")
def unresolved_metrics(spark, sf_dir):
    return records.unresolved_metrics(R.ledger(spark, sf_dir).withColumn("metric_b", F.when(F.col("ordinal") % 7 == 0, F.col("metric_b"))), ["metric_a", "metric_b"])


@query("""SELECT event_type, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, count(*) AS n, count(json_extract_string(props, '$.absent')) AS n_absent FROM events GROUP BY event_type, k""")
def json_projection(spark, sf_dir):
    rows = records.project(table(spark, sf_dir, "events"), {"k": ("$.k", "bigint"), "absent": ("$.absent", "string")}, "props")
    return rows.groupBy("event_type", "k").agg(F.count("*").alias("n"), F.count("absent").alias("n_absent"))


@query(f"""WITH {R.LEDGER}, m AS (SELECT experiment_id, CASE WHEN ordinal % 5 <> 0 THEN metric_b END AS x, CASE WHEN ordinal % 3 <> 0 THEN metric_a END AS y, duration_seconds AS z, record_type FROM ledger)
 SELECT experiment_id, CASE WHEN record_type = 'training' THEN CASE WHEN x IS NOT NULL THEN 'x' WHEN y IS NOT NULL THEN 'y' END ELSE CASE WHEN z IS NOT NULL THEN 'z' END END AS name,
 round(CASE WHEN record_type = 'training' THEN coalesce(x, y) ELSE z END, 8) AS value FROM m""")
def headline_metric(spark, sf_dir):
    rows = R.ledger(spark, sf_dir)
    metrics = F.create_map(F.lit("x"), F.when(F.col("ordinal") % 5 != 0, F.col("metric_b")), F.lit("y"), F.when(F.col("ordinal") % 3 != 0, F.col("metric_a")), F.lit("z"), F.col("duration_seconds"))
    name, value = monitor.headline(F.col("record_type"), {"training": ["x", "y"]}, ["z"], F.col("m"))
    return rounded(rows.withColumn("m", metrics).select("experiment_id", name.alias("name"), value.alias("value")), "value")


@query(f"""WITH {R.LEDGER}, {R.VERDICTS}, last AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY fingerprint ORDER BY ordinal DESC) AS n FROM verdicts) WHERE n = 1),
 flags AS (SELECT DISTINCT name FROM ledger WHERE status = 'completed' AND record_type NOT IN ('sweep_aggregate', 'sweep_failure') GROUP BY name HAVING count(DISTINCT fingerprint) > 40)
 SELECT experiment_id, l.name, l.fingerprint, v.verdict, v.edge, 'ledger' AS source, CASE WHEN f.name IS NOT NULL THEN 'divergence' ELSE '' END AS kinds FROM ledger l LEFT JOIN last v ON l.fingerprint = v.fingerprint LEFT JOIN flags f ON l.name = f.name
 UNION ALL SELECT NULL, v.name, v.fingerprint, v.verdict, v.edge, 'discovery', '' FROM last v WHERE NOT EXISTS (SELECT 1 FROM ledger l WHERE l.fingerprint = v.fingerprint)""")
def fused_monitor(spark, sf_dir):
    led = R.ledger(spark, sf_dir)
    found = reduce.divergence(led).filter("kind = 'config' AND n > 40")
    flags = found.select(F.lit("name").alias("key_name"), F.col("name").alias("key"), F.lit("divergence").alias("kind"))
    rows = monitor.fused(led.select("experiment_id", "ordinal", "name", "fingerprint"), R.verdicts(spark, sf_dir), flags, ["verdict", "edge"], ["name"])
    return rows.select("experiment_id", "name", "fingerprint", "verdict", "edge", "source", F.array_join("kinds", ",").alias("kinds"))


# --- reductions -------------------------------------------------------------


@query(f"""WITH {R.HISTORY} SELECT experiment_id, 'best_val_loss' AS metric, round(min(val_loss), 8) AS value FROM history GROUP BY experiment_id HAVING min(val_loss) IS NOT NULL
 UNION ALL SELECT experiment_id, 'best_val_macro_f1', round(max(val_macro_f1), 8) FROM history GROUP BY experiment_id""")
def best_epochs(spark, sf_dir):
    h = R.history(spark, sf_dir).selectExpr("experiment_id", "epoch", "stack(2, 'val_loss', val_loss, 'val_macro_f1', val_macro_f1) AS (metric, value)")
    return rounded(reduce.best_epochs(h), "value")


@query(f"""WITH {R.HISTORY}, flagged AS (SELECT *, count(val_loss) OVER (PARTITION BY experiment_id) > 0 AS has_loss, count(*) OVER (PARTITION BY experiment_id) AS n FROM history),
 ranked AS (SELECT *, row_number() OVER (PARTITION BY experiment_id ORDER BY CASE WHEN has_loss THEN val_loss ELSE -val_macro_f1 END NULLS LAST, epoch) AS b, row_number() OVER (PARTITION BY experiment_id ORDER BY epoch DESC) AS z FROM flagged)
 SELECT experiment_id, max(CASE WHEN b = 1 THEN epoch END) AS best_epoch, round(max(CASE WHEN b = 1 THEN val_loss END), 8) AS best_val_loss, round(max(CASE WHEN b = 1 THEN val_macro_f1 END), 8) AS best_val_macro_f1,
 round(max(CASE WHEN z = 1 THEN val_loss END), 8) AS final_val_loss, round(max(CASE WHEN z = 1 THEN val_macro_f1 END), 8) AS final_val_macro_f1, max(n) AS n_epochs FROM ranked GROUP BY experiment_id""")
def history_summary(spark, sf_dir):
    return rounded(reduce.history_summary(R.history(spark, sf_dir)), "best_val_loss", "best_val_macro_f1", "final_val_loss", "final_val_macro_f1")


@query("""WITH t AS (SELECT o_custkey AS run, o_orderkey AS ordinal, o_orderstatus = 'F' AS zero_dte, CASE WHEN o_orderkey % 3 > 0 THEN o_totalprice / 100 END AS opt, CASE WHEN o_orderkey % 13 > 0 THEN o_totalprice / 1000 END AS tot FROM orders),
 s AS (SELECT *, CASE WHEN bool_or(zero_dte) OVER (PARTITION BY run) AND count(opt) OVER (PARTITION BY run) > 0 THEN opt ELSE tot END AS score FROM t), r AS (SELECT *, row_number() OVER (PARTITION BY run ORDER BY coalesce(score, CAST('-Infinity' AS DOUBLE)) DESC, ordinal) AS n FROM s)
 SELECT run, ordinal, round(score, 6) AS score FROM r WHERE n = 1""")
def best_threshold(spark, sf_dir):
    t = table(spark, sf_dir, "orders").selectExpr("o_custkey AS run", "o_orderkey AS ordinal", "o_orderstatus = 'F' AS zero_dte", "CASE WHEN o_orderkey % 3 > 0 THEN o_totalprice / 100 END AS option_return", "CASE WHEN o_orderkey % 13 > 0 THEN o_totalprice / 1000 ELSE double('NaN') END AS total_return")
    return rounded(reduce.best_threshold(t, "run", "ordinal").select("run", "ordinal", "score"), "score", digits=6)


@query(f"""WITH {R.TRADES} SELECT model, ret, count(*) AS n, round(avg(pnl), 8) AS mean FROM trades GROUP BY model, ret""")
def pooled_mean(spark, sf_dir):
    return rounded(reduce.pooled(R.trades(spark, sf_dir), ["model", "ret"]), "mean")


@query(f"""WITH {R.TRADES}, r AS (SELECT *, row_number() OVER (PARTITION BY model, ret, seed ORDER BY abs(pnl) DESC, trade_idx DESC) AS n FROM trades),
 s AS (SELECT model, ret, seed, coalesce(avg(CASE WHEN n > 5 THEN pnl END), 0) AS t FROM r GROUP BY model, ret, seed) SELECT model, ret, round(avg(t), 8) AS trimmed_mean, count(*) AS n_seeds FROM s GROUP BY model, ret""")
def trimmed_mean(spark, sf_dir):
    return rounded(reduce.trimmed_means(R.trades(spark, sf_dir), ["model", "ret"], 5), "trimmed_mean")


@query(f"""WITH {R.LEDGER} SELECT sweep_id, 'sweep_' || sweep_id AS sweep_name, count(*) AS n_children, count(*) FILTER (WHERE status = 'completed') AS n_completed, count(*) FILTER (WHERE status = 'failed') AS n_failed, sum(duration_seconds) AS duration_seconds,
 CASE WHEN count(*) FILTER (WHERE status = 'completed') > 0 AND count(*) FILTER (WHERE status = 'failed') = 0 THEN 'completed' WHEN count(*) FILTER (WHERE status = 'completed') > 0 THEN 'partial'
 WHEN count(*) FILTER (WHERE status = 'failed') > 0 THEN 'failed' ELSE 'unknown' END AS status,
 sha256('{{"children": [' || string_agg('"' || fingerprint || '"', ', ' ORDER BY fingerprint) || '], "sweep_name": "sweep_' || sweep_id || '"}}') AS fingerprint FROM ledger GROUP BY sweep_id""")
def sweep_rollup(spark, sf_dir):
    return reduce.rollup(R.ledger(spark, sf_dir).withColumn("sweep_name", F.concat(F.lit("sweep_"), "sweep_id")))


@query(f"""WITH {R.LEDGER} SELECT name, seed, count(*) AS n_rows, count(DISTINCT fingerprint) AS n_distinct, count(DISTINCT fingerprint) = 1 AS identical, count(DISTINCT fingerprint) = count(*) AS all_distinct, TRUE AS populated FROM ledger GROUP BY name, seed""")
def invariants(spark, sf_dir):
    return reduce.invariants(R.ledger(spark, sf_dir), ["name", "seed"], "fingerprint")


@query(f"""WITH {R.LEDGER}, d AS (SELECT DISTINCT fingerprint, model_type FROM ledger) SELECT fingerprint, string_agg(model_type, ',' ORDER BY model_type) AS members FROM d GROUP BY fingerprint HAVING count(*) > 1""")
def collisions(spark, sf_dir):
    return reduce.collisions(R.ledger(spark, sf_dir), "fingerprint", "model_type").withColumn("members", F.array_join("members", ","))


@query(f"""WITH {R.LEDGER}, c AS (SELECT *, min(fingerprint) OVER w = max(fingerprint) OVER w AS same, row_number() OVER (PARTITION BY sweep_id, created_at ORDER BY ordinal) AS n FROM ledger WINDOW w AS (PARTITION BY sweep_id, created_at))
 SELECT experiment_id FROM c WHERE NOT same OR n = 1""")
def representatives(spark, sf_dir):
    return reduce.representatives(R.ledger(spark, sf_dir), ["sweep_id", "created_at"], "fingerprint", "ordinal").select("experiment_id")


@query(f"""WITH {R.LEDGER}, c AS (SELECT model_type, name, count(*) AS n, avg(metric_b) AS mean FROM ledger GROUP BY model_type, name)
 SELECT model_type, round(avg(CASE WHEN n >= 10 THEN mean END), 8) AS mean, count(CASE WHEN n >= 10 THEN mean END) AS n_cells FROM c GROUP BY model_type""")
def equal_weight_mean(spark, sf_dir):
    cells = R.ledger(spark, sf_dir).groupBy("model_type", "name").agg(F.count("*").alias("n"), F.avg("metric_b").alias("mean"))
    return rounded(reduce.equal_weight(cells, ["model_type"]), "mean")


@query(f"""WITH {R.LEDGER}, runs AS (SELECT * FROM ledger WHERE status = 'completed' AND record_type NOT IN ('sweep_aggregate', 'sweep_failure'))
 SELECT name, '' AS fingerprint, 'config' AS kind, count(DISTINCT fingerprint) AS n FROM runs GROUP BY name HAVING count(DISTINCT fingerprint) > 1
 UNION ALL SELECT name, fingerprint, 'provenance', count(DISTINCT provenance_hash) FROM runs GROUP BY name, fingerprint HAVING count(DISTINCT provenance_hash) > 1""")
def divergence(spark, sf_dir):
    return reduce.divergence(R.ledger(spark, sf_dir))


@query(f"""WITH {R.LEDGER} SELECT model_type, seed, count(metric_b) AS n, round(avg(metric_b), 8) AS mean, round(stddev_samp(metric_b), 8) AS std_sample, round(stddev_pop(metric_b), 8) AS std_population FROM ledger GROUP BY model_type, seed""")
def seed_statistics(spark, sf_dir):
    return rounded(reduce.seed_statistics(R.ledger(spark, sf_dir), ["model_type", "seed"], "metric_b"), "mean", "std_sample", "std_population")


@query(f"""WITH {R.RATERS} SELECT rater, count(*) AS n, count(*) FILTER (WHERE prediction = 0) AS n_0, count(*) FILTER (WHERE prediction = 1) AS n_1, round(quantile_cont(confidence, 0.25), 8) AS q25, round(quantile_cont(confidence, 0.5), 8) AS q50,
 round(quantile_cont(confidence, 0.75), 8) AS q75 FROM raters GROUP BY rater""")
def class_profile(spark, sf_dir):
    return rounded(reduce.class_profile(R.raters(spark, sf_dir), ["rater"], [0, 1]), "q25", "q50", "q75")


@query(f"""WITH {R.LEDGER}, m AS (SELECT model_type, seed, avg(metric_b) AS v FROM ledger GROUP BY model_type, seed), s AS (SELECT *, lag(v) OVER (PARTITION BY model_type ORDER BY seed) AS p, row_number() OVER (PARTITION BY model_type ORDER BY seed) AS n FROM m)
 SELECT model_type, bool_and(n = 1 OR v < p) AS decays, count(*) AS n FROM s GROUP BY model_type""")
def monotone_decay(spark, sf_dir):
    m = R.ledger(spark, sf_dir).groupBy("model_type", "seed").agg(F.avg("metric_b").alias("v"))
    return reduce.strictly_decreasing(m, ["model_type"], "seed", "v")


@query(f"""WITH {R.LEDGER}, w AS (SELECT name, avg(CASE WHEN model_type = 'BUILDING' THEN metric_b END) AS numerator, avg(CASE WHEN model_type = 'MACHINERY' THEN metric_b END) AS denominator FROM ledger GROUP BY name)
 SELECT name, round(numerator, 8) AS numerator, round(denominator, 8) AS denominator, round(CASE WHEN denominator > 1e-6 THEN numerator / denominator END, 8) AS ratio FROM w""")
def baseline_ratio(spark, sf_dir):
    m = R.ledger(spark, sf_dir).groupBy("name", "model_type").agg(F.avg("metric_b").alias("v"))
    return rounded(reduce.baseline_ratio(m, ["name"], "model_type", "v", "BUILDING", "MACHINERY"), "numerator", "denominator", "ratio")


@query(f"""WITH {R.CACHE}, t AS (SELECT *, sum(CASE WHEN NOT pinned THEN size_bytes ELSE 0 END) OVER () AS total, coalesce(sum(CASE WHEN NOT pinned THEN size_bytes ELSE 0 END) OVER (ORDER BY mtime, cache_key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM cache)
 SELECT cache_key, CAST(mtime AS BIGINT) AS mtime, size_bytes, NOT pinned AND total - before > 500000 AND 300 - mtime > 100 AS evict FROM t""")
def cache_evictions(spark, sf_dir):
    out = reduce.evictions(R.cache(spark, sf_dir), 500_000, max_age=100.0, now=300.0)
    return out.select("cache_key", F.col("mtime").cast("long").alias("mtime"), "size_bytes", "evict")


# --- statistics -------------------------------------------------------------

_BLOCKS = """sizes AS (SELECT {cell}, count(*) AS n FROM {src} GROUP BY {cell}), plan0 AS (SELECT *, CAST(ceil(pow(n, CAST(1.0 AS DOUBLE) / 3) - CAST(1e-9 AS DOUBLE)) AS BIGINT) AS c FROM sizes),
 plan AS (SELECT *, {length} AS len FROM plan0), draws AS (SELECT p.*, r.i AS rep, b.i AS block, CAST('0x' || substr(md5('42|' || {cellkey} || '|' || r.i || '|' || b.i), 1, 8) AS BIGINT) % (n - len + 1) AS start
 FROM plan p, range({reps}) r(i), range(100000) b(i) WHERE b.i < ceil(n / CAST(len AS DOUBLE))), places AS (SELECT {dcell}, rep, start + k.i AS idx FROM draws d, range(100000) k(i) WHERE k.i < len AND block * len + k.i < n)"""


def _bootstrap_sql(cell: str, src: str, key: str, reps: int, length: str) -> str:
    names = cell.split(", ")
    return _BLOCKS.format(cell=cell, src=src, cellkey=key, reps=reps, length=length, dcell=", ".join(f"d.{c}" for c in names))


def _means_sql(cell: str, src: str, key: str, reps: int, length: str, value: str = "value") -> str:
    """CTEs sizes .. m (cell, rep, m): means of block resamples, each block's sum by two running sums."""
    names = cell.split(", ")
    on = lambda t: " AND ".join(f"{t}.{c} = d.{c}" for c in names)
    own = ", ".join(f"d.{c}" for c in names)
    return f"""sizes AS (SELECT {cell}, count(*) AS n FROM {src} GROUP BY {cell}), plan0 AS (SELECT *, CAST(ceil(pow(n, CAST(1.0 AS DOUBLE) / 3) - CAST(1e-9 AS DOUBLE)) AS BIGINT) AS c FROM sizes),
 plan AS (SELECT *, {length} AS len FROM plan0), run AS (SELECT {cell}, idx, sum({value}) OVER w - ({value}) AS before, sum({value}) OVER w AS upto FROM {src} WINDOW w AS (PARTITION BY {cell} ORDER BY idx)),
 reps AS (SELECT *, unnest(range({reps})) AS rep FROM plan), blocks AS (SELECT *, unnest(range(CAST(ceil(n / CAST(len AS DOUBLE)) AS BIGINT))) AS block FROM reps),
 draws AS (SELECT *, CAST('0x' || substr(md5('42|' || {key} || '|' || rep || '|' || block), 1, 8) AS BIGINT) % (n - len + 1) AS start FROM blocks),
 m AS (SELECT {own}, d.rep, sum(e.upto - s.before) / any_value(d.n) AS m FROM draws d JOIN run s ON {on("s")} AND s.idx = d.start JOIN run e ON {on("e")} AND e.idx = d.start + least(d.len, d.n - d.block * d.len) - 1 GROUP BY {own}, d.rep)"""


_CUBE = "CASE WHEN floor(n / CAST(c AS DOUBLE)) < 5 THEN greatest(1, CAST(floor(n / CAST(5 AS DOUBLE)) AS BIGINT)) ELSE c END"
_KEY = "model || '/' || ret"


@query(f"""WITH {R.TRADES}, {_means_sql("model, ret", "trades", _KEY, REPS, _CUBE, "pnl")}, pt AS (SELECT model, ret, count(*) AS n, avg(pnl) AS mean FROM trades GROUP BY model, ret)
 SELECT pt.model, pt.ret, pt.n, round(mean, 7) AS mean, round(quantile_cont(m, 0.025), 7) AS lo, round(quantile_cont(m, 0.975), 7) AS hi FROM pt JOIN m ON m.model = pt.model AND m.ret = pt.ret GROUP BY pt.model, pt.ret, pt.n, mean""")
def bootstrap_mean(spark, sf_dir):
    """Intervals of the mean of all trades of a cell."""
    out = stats.enough_data(stats.bootstrap_mean(R.numbered_trades(spark, sf_dir), ["model", "ret"], REPS))
    return rounded(out.select("model", "ret", "n", "mean", "lo", "hi"), "mean", "lo", "hi", digits=7)


@query(f"""WITH {R.TRADES}, {_means_sql("model, ret", "trades", _KEY, PLAIN_REPS, "1", "pnl + 1")}, pt AS (SELECT model, ret, count(*) AS n, avg(pnl + 1) AS mean FROM trades GROUP BY model, ret)
 SELECT pt.model, pt.ret, pt.n, round(2 / mean, 7) AS ratio, round(quantile_cont(2 / m, 0.025), 7) AS lo, round(quantile_cont(2 / m, 0.975), 7) AS hi FROM pt JOIN m ON m.model = pt.model AND m.ret = pt.ret GROUP BY pt.model, pt.ret, pt.n, mean""")
def bootstrap_ratio(spark, sf_dir):
    """Intervals of a ratio to the mean of all trades of a cell, by the plain bootstrap."""
    values = R.numbered_trades(spark, sf_dir).withColumn("value", F.col("value") + 1)
    out = stats.bootstrap_ratio(values, ["model", "ret"], F.lit(2.0), PLAIN_REPS)
    return rounded(out.select("model", "ret", "n", "ratio", "lo", "hi"), "ratio", "lo", "hi", digits=7)


@query(f"""WITH {R.SIGNALS}, r AS (SELECT treatment, rank() OVER (PARTITION BY treatment ORDER BY pred) + (count(*) OVER (PARTITION BY treatment, pred) - 1) / CAST(2 AS DOUBLE) AS x, rank() OVER (PARTITION BY treatment ORDER BY label) + (count(*) OVER (PARTITION BY treatment, label) - 1) / CAST(2 AS DOUBLE) AS y FROM signals)
 SELECT treatment, round(corr(x, y), 8) AS ic, count(*) AS n FROM r GROUP BY treatment""")
def spearman_ic(spark, sf_dir):
    return rounded(stats.spearman(R.signals(spark, sf_dir), ["treatment"], "pred", "label"), "ic")


@query(f"""WITH {R.SIGNALS}, base AS (SELECT DISTINCT sample_idx AS idx, 'all' AS cell FROM signals), {_bootstrap_sql("cell", "base", "cell", stats.REPLICATES, _CUBE)},
 joined AS (SELECT p.rep, s.treatment, s.pred, s.label FROM places p JOIN signals s ON s.sample_idx = p.idx),
 rk AS (SELECT rep, treatment, rank() OVER (PARTITION BY rep, treatment ORDER BY pred) + (count(*) OVER (PARTITION BY rep, treatment, pred) - 1) / CAST(2 AS DOUBLE) AS x, rank() OVER (PARTITION BY rep, treatment ORDER BY label) + (count(*) OVER (PARTITION BY rep, treatment, label) - 1) / CAST(2 AS DOUBLE) AS y FROM joined),
 ic AS (SELECT rep, treatment, corr(x, y) AS ic FROM rk GROUP BY rep, treatment), d AS (SELECT a.treatment AS treatment_a, b.treatment AS treatment_b, a.ic - b.ic AS d FROM ic a JOIN ic b ON a.rep = b.rep AND a.treatment < b.treatment),
 t AS (SELECT treatment_a, treatment_b, quantile_cont(d, 0.025) AS lo, quantile_cont(d, 0.975) AS hi, least(1, 2 * least((1 + count(*) FILTER (WHERE d <= 0)) / CAST(count(*) + 1 AS DOUBLE), (1 + count(*) FILTER (WHERE d >= 0)) / CAST(count(*) + 1 AS DOUBLE))) AS p FROM d GROUP BY treatment_a, treatment_b),
 wr AS (SELECT treatment, rank() OVER (PARTITION BY treatment ORDER BY pred) + (count(*) OVER (PARTITION BY treatment, pred) - 1) / CAST(2 AS DOUBLE) AS x, rank() OVER (PARTITION BY treatment ORDER BY label) + (count(*) OVER (PARTITION BY treatment, label) - 1) / CAST(2 AS DOUBLE) AS y FROM signals),
 pt AS (SELECT treatment, corr(x, y) AS ic FROM wr GROUP BY treatment), br AS (SELECT *, rank() OVER (ORDER BY p) + count(*) OVER (PARTITION BY p) - 1 AS k, count(*) OVER () AS n FROM t), bh AS (SELECT *, least(1, min(p * n / k) OVER (ORDER BY k DESC RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS q FROM br)
 SELECT treatment_a, treatment_b, round(a.ic - b.ic, 7) AS delta, round(lo, 7) AS lo, round(hi, 7) AS hi, round(p, 7) AS p, round(q, 7) AS q, q <= 0.05 AND (lo > 0 OR hi < 0) AS significant FROM bh JOIN pt a ON a.treatment = treatment_a JOIN pt b ON b.treatment = treatment_b""")
def compare_pairs(spark, sf_dir):
    """All pairs of treatments, with the operator's own number of replicates."""
    out = stats.compare_pairs(stats.paired_mask(R.signals(spark, sf_dir)))
    return rounded(out.select("treatment_a", "treatment_b", "delta", "lo", "hi", "p", "q", "significant"), "delta", "lo", "hi", "p", "q", digits=7)


@query(f"""WITH {R.LEDGER}, t AS (SELECT name, (min(ordinal) * 7919 % 1000 + 1) / CAST(20000 AS DOUBLE) AS p FROM ledger GROUP BY name), r AS (SELECT *, rank() OVER (ORDER BY p) + count(*) OVER (PARTITION BY p) - 1 AS k, count(*) OVER () AS m FROM t)
 SELECT name, round(p, 8) AS p, round(least(1, min(p * m / k) OVER (ORDER BY k DESC RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)), 8) AS q FROM r""")
def benjamini_hochberg(spark, sf_dir):
    t = R.ledger(spark, sf_dir).groupBy("name").agg(((F.min("ordinal") * 7919 % 1000 + 1) / 20000).alias("p"))
    return rounded(stats.adjust(t), "p", "q")


@query(f"""WITH {R.RATERS}, c AS (SELECT rater, count(*) FILTER (WHERE prediction = 1) AS n_predicted, count(*) FILTER (WHERE prediction = 1 AND label = 1) AS n_hit, count(*) FILTER (WHERE label = 1) AS n_true FROM raters GROUP BY rater),
 w AS (SELECT *, n_hit / CAST(n_predicted AS DOUBLE) AS p, CAST(n_predicted AS DOUBLE) AS n, CAST(1.959963984540054 AS DOUBLE) AS z FROM c)
 SELECT rater, n_predicted, n_hit, n_true, round(p, 8) AS precision, round(n_hit / CAST(n_true AS DOUBLE), 8) AS recall, round((p + z * z / (2 * n) - z * sqrt(p * (1 - p) / n + z * z / (4 * n * n))) / (1 + z * z / n), 8) AS lo,
 round((p + z * z / (2 * n) + z * sqrt(p * (1 - p) / n + z * z / (4 * n * n))) / (1 + z * z / n), 8) AS hi FROM w""")
def wilson_precision(spark, sf_dir):
    return rounded(stats.precision(R.raters(spark, sf_dir), ["rater"], 1), "precision", "recall", "lo", "hi")


@query(f"""WITH {R.PREDICTIONS}, f AS (SELECT lang, p1 = label AS x, p2 = label AS y FROM predictions), c AS (SELECT lang, count(*) FILTER (WHERE x AND y) AS a, count(*) FILTER (WHERE x AND NOT y) AS b, count(*) FILTER (WHERE NOT x AND y) AS c, count(*) FILTER (WHERE NOT x AND NOT y) AS d FROM f GROUP BY lang)
 SELECT *, b + c < 25 AS exact, round(CASE WHEN b + c > 0 THEN power(greatest(abs(b - c) - 1, 0), 2) / CAST(b + c AS DOUBLE) ELSE 0 END, 8) AS chi2 FROM c""")
def mcnemar_counts(spark, sf_dir):
    p = R.predictions(spark, sf_dir).withColumns({"x": F.col("p1") == F.col("label"), "y": F.col("p2") == F.col("label")})
    return rounded(stats.mcnemar_counts(p, ["lang"], "x", "y"), "chi2")


@query()
def mcnemar_p(spark, sf_dir):
    p = R.predictions(spark, sf_dir).withColumns({"x": F.col("p1") == F.col("label"), "y": F.col("p2") == F.col("label")})
    return stats.mcnemar(p, ["lang"], "x", "y")


@query(f"""WITH {R.RATERS}, b AS (SELECT x.rater AS rater_a, y.rater AS rater_b, x.prediction AS pa, y.prediction AS pb FROM raters x JOIN raters y ON x.sample_idx = y.sample_idx AND x.rater < y.rater),
 k AS (SELECT rater_a, rater_b, count(*) AS n, avg(CASE WHEN pa = pb THEN 1 ELSE 0 END) AS o, (sum(pa) * sum(pb) + sum(1 - pa) * sum(1 - pb)) / (CAST(count(*) AS DOUBLE) * count(*)) AS e FROM b GROUP BY rater_a, rater_b)
 SELECT rater_a, rater_b, n, round(o, 8) AS observed, round(CASE WHEN abs(1 - e) < 1e-12 THEN 0 ELSE (o - e) / (1 - e) END, 8) AS kappa FROM k""")
def cohen_kappa(spark, sf_dir):
    return rounded(stats.kappa(R.raters(spark, sf_dir), "rater", "sample_idx", "prediction"), "observed", "kappa")


@query(f"""WITH {R.RATERS}, v AS (SELECT sample_idx, prediction, count(*) AS votes FROM raters WHERE rater <> 'p3' GROUP BY sample_idx, prediction), r AS (SELECT *, row_number() OVER (PARTITION BY sample_idx ORDER BY votes DESC, prediction) AS n FROM v)
 SELECT sample_idx, prediction AS vote, votes FROM r WHERE n = 1""")
def majority_vote(spark, sf_dir):
    return stats.majority(R.raters(spark, sf_dir).filter("rater <> 'p3'"), "sample_idx")


@query("""WITH long AS (SELECT vec_id, label, vec_id % 4 AS fold, unnest(range(64)) AS feature, unnest(embedding) AS x FROM embeddings),
 r AS (SELECT feature, rank() OVER (PARTITION BY feature ORDER BY x) + (count(*) OVER (PARTITION BY feature, x) - 1) / CAST(2 AS DOUBLE) AS a, rank() OVER (PARTITION BY feature ORDER BY label) + (count(*) OVER (PARTITION BY feature, label) - 1) / CAST(2 AS DOUBLE) AS b FROM long),
 f AS (SELECT feature, fold, rank() OVER (PARTITION BY feature, fold ORDER BY x) + (count(*) OVER (PARTITION BY feature, fold, x) - 1) / CAST(2 AS DOUBLE) AS a, rank() OVER (PARTITION BY feature, fold ORDER BY label) + (count(*) OVER (PARTITION BY feature, fold, label) - 1) / CAST(2 AS DOUBLE) AS b FROM long),
 ic AS (SELECT feature, corr(a, b) AS ic, count(*) AS n FROM r GROUP BY feature), fo AS (SELECT feature, fold, corr(a, b) AS ic FROM f GROUP BY feature, fold), fs AS (SELECT feature, avg(ic) AS fold_mean, stddev_pop(ic) AS fold_std FROM fo GROUP BY feature)
 SELECT ic.feature, round(ic, 7) AS ic, n, round(fold_mean, 7) AS fold_mean, round(fold_std, 7) AS fold_std FROM ic JOIN fs ON ic.feature = fs.feature""")
def feature_gate(spark, sf_dir):
    long = table(spark, sf_dir, "embeddings").select("vec_id", "label", (F.col("vec_id") % 4).alias("fold"), F.posexplode("embedding").alias("feature", "x"))
    per, _ = stats.feature_gate_long(long.withColumns({"x": F.col("x").cast("double"), "feature": F.col("feature").cast("long")}), "label", "fold")
    return rounded(per.select("feature", "ic", "n", "fold_mean", "fold_std"), "ic", "fold_mean", "fold_std", digits=7)


@query()
def feature_gate_report(spark, sf_dir):
    long = table(spark, sf_dir, "embeddings").select("label", (F.col("vec_id") % 4).alias("fold"), F.posexplode("embedding").alias("feature", "x"))
    return stats.feature_gate_long(long.withColumn("x", F.col("x").cast("double")), "label", "fold")[1]


@query()
def deflated_proportion(spark, sf_dir):
    """One-sided p of directional hits below a coin, with effective trials."""
    rows = R.ledger(spark, sf_dir).groupBy("model_type").agg(F.count_if(F.col("metric_b") > 0.52).alias("k"), F.count("metric_b").alias("n"))
    return rows.withColumn("p", F.round(stats.deflated_p(F.col("k"), F.col("n"), F.lit(0.3)), 6))


# --- gates and verdicts -----------------------------------------------------


def _checks(spark, sf_dir) -> DataFrame:
    rows = R.ledger(spark, sf_dir).filter("record_type = 'training'")
    a = [
        ("floor", gates.floor_check(F.col("metric_b"), 0.3)),
        ("prior", gates.prior_check(F.col("metric_b"), F.col("metric_a") - 0.2, 0.9)),
        ("cost", gates.cost_check(F.when(F.col("ordinal") % 2 == 0, 0.0).otherwise(F.col("metric_a")), F.col("metric_b"), 0.5)),
        ("sign", gates.sign_flip_check(F.col("metric_b"), 0.6, F.col("metric_a"), F.col("duration_seconds") / 10000)),
    ]
    return rows.select("experiment_id", F.inline(F.array(*[F.struct(F.lit(n).alias("check"), c.alias("status")) for n, c in a])))


_CHECKS = (
    R.LEDGER
    + """, c AS (SELECT experiment_id, CASE WHEN metric_b IS NULL THEN 'skip' WHEN metric_b >= 0.3 THEN 'pass' ELSE 'fail' END AS floor,
 CASE WHEN metric_b IS NULL THEN 'skip' WHEN metric_a - 0.2 = 0 OR (metric_a - 0.2 < 0 AND metric_b >= metric_a - 0.2) THEN 'pass' WHEN metric_a - 0.2 < 0 THEN 'fail' WHEN metric_b / (metric_a - 0.2) >= 0.9 THEN 'pass' ELSE 'fail' END AS prior,
 CASE WHEN ordinal % 2 = 0 AND metric_b IS NULL THEN 'skip' WHEN CASE WHEN ordinal % 2 = 0 THEN metric_b ELSE metric_a END >= 0.5 THEN 'pass' ELSE 'warn' END AS cost,
 CASE WHEN metric_b IS NULL OR metric_b < 0.6 THEN 'skip' WHEN metric_a < 0.5 AND duration_seconds / 10000 < 0.05 THEN 'warn' ELSE 'pass' END AS sign FROM ledger WHERE record_type = 'training')"""
)


@query(f"""WITH {_CHECKS} SELECT experiment_id, CASE WHEN floor = 'fail' OR prior = 'fail' THEN 'abort' WHEN cost = 'warn' OR sign = 'warn' THEN 'warn' ELSE 'pass' END AS status, floor || ',' || prior || ',' || cost || ',' || sign AS detail FROM c""")
def gate_roll_up(spark, sf_dir):
    checks = _checks(spark, sf_dir)
    wide = checks.groupBy("experiment_id").agg(*[F.max(F.when(F.col("check") == c, F.col("status"))).alias(c) for c in ("floor", "prior", "cost", "sign")])
    return gates.roll_up(checks, ["experiment_id"], on_regression="abort").join(wide, "experiment_id").select("experiment_id", "status", F.concat_ws(",", "floor", "prior", "cost", "sign").alias("detail"))


_CASES = """c AS (SELECT ordinal, CASE ordinal % 7 WHEN 0 THEN CAST('NaN' AS DOUBLE) WHEN 1 THEN NULL ELSE ((ordinal * 31) % 40 - 15) / CAST(1000 AS DOUBLE) END AS mean, ((ordinal * 17) % 21 - 10) / CAST(1000 AS DOUBLE) AS lo,
 ((ordinal * 13) % 17 - 9) / CAST(1000 AS DOUBLE) AS trim, ordinal % 5 > 0 AS control, CASE ordinal % 9 WHEN 0 THEN NULL WHEN 1 THEN FALSE ELSE TRUE END AS inv, ordinal % 4 AS arms, ordinal % 3 > 0 AS x, ordinal % 2 > 0 AS y FROM (SELECT o_orderkey AS ordinal FROM orders))"""


@query(f"""WITH {_CASES}, n AS (SELECT *, CASE WHEN isnan(mean) THEN NULL ELSE mean END AS m FROM c) SELECT ordinal,
 CASE WHEN NOT coalesce(inv, FALSE) THEN 'ABORT' WHEN coalesce(m >= 0.01, FALSE) AND lo > 0 AND trim > 0 AND control THEN 'GO' WHEN coalesce(m > 0 AND m < 0.01, FALSE) AND lo <= 0 AND trim > -0.005 AND trim < 0 THEN 'INDETERMINATE' ELSE 'REFUTE' END AS seeds,
 CASE WHEN NOT coalesce(inv, FALSE) THEN 'ABORT' WHEN x AND y AND control THEN 'GO' WHEN arms < 2 THEN 'REFUTE' WHEN arms = 2 THEN 'INDETERMINATE' ELSE 'REFUTE' END AS horizons,
 CASE WHEN NOT coalesce(inv, FALSE) THEN 'ABORT' WHEN x AND y AND control THEN 'GO' WHEN NOT x AND control AND y THEN 'INDETERMINATE' ELSE 'REFUTE' END AS points,
 CASE WHEN NOT coalesce(inv, FALSE) THEN 'ABORT_INVARIANT' WHEN arms < 1 THEN 'INSUFFICIENT' WHEN coalesce(m >= 0.005, FALSE) AND lo > 0.005 AND trim <= 0.004 THEN 'GO' WHEN coalesce(m >= 0.005, FALSE) AND trim > 0.004 THEN 'UNSTABLE' WHEN coalesce(m >= 0.005, FALSE) THEN 'WEAK' ELSE 'REFUTE' END AS precision_
 FROM n""")
def verdicts(spark, sf_dir):
    """The verdict state machines over generated cases, missing and NaN ones too."""
    n = F.col("ordinal")
    c = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("ordinal"))
    mean = F.when(n % 7 == 0, float("nan")).when(n % 7 == 1, F.lit(None)).otherwise(((n * 31) % 40 - 15) / 1000)
    c = c.withColumns({"mean": mean, "lo": ((n * 17) % 21 - 10) / 1000, "trim": ((n * 13) % 17 - 9) / 1000, "control": n % 5 > 0, "inv": F.when(n % 9 == 0, F.lit(None)).otherwise(n % 9 != 1), "arms": n % 4, "x": n % 3 > 0, "y": n % 2 > 0})
    k = {name: F.col(name) for name in c.columns}
    return c.select(
        "ordinal",
        gates.verdict_seeds(k["mean"], k["lo"], k["trim"], k["control"], k["inv"]).alias("seeds"),
        gates.verdict_horizons(k["x"], k["y"], k["control"], k["inv"], k["arms"]).alias("horizons"),
        gates.verdict_points(k["x"], k["y"], k["control"], k["inv"], k["control"]).alias("points"),
        gates.verdict_precision(k["mean"], k["trim"], k["lo"], k["arms"], k["inv"], 0.005, 0.004, 1).alias("precision_"),
    )


# --- scalars ----------------------------------------------------------------


@query(f"""WITH {R.VERDICTS}, p AS (SELECT probe_id, stats_version, CAST(split_part(stats_version, '.', 2) AS INT) AS mi, CAST(split_part(split_part(stats_version, '.', 3), '-', 1) AS INT) AS pa, CASE WHEN stats_version LIKE '%-dev' THEN 0 ELSE 1 END AS rel FROM verdicts)
 SELECT probe_id, mi <> 1 AS minor_differs, mi < 1 OR (mi = 1 AND (pa < 4 OR (pa = 4 AND rel < 1))) AS older FROM p""")
def versions(spark, sf_dir):
    v = F.col("stats_version")
    return R.verdicts(spark, sf_dir).select("probe_id", S.minor_differs(v, F.lit("0.1.9")).alias("minor_differs"), (S.version_key(v) < S.version_key(F.lit("0.1.4"))).alias("older"))


@query("""SELECT p_partkey, lower(replace(replace(trim(p_type || '_' || p_name), '_', ''), '-', '')) AS folded, CASE WHEN p_size % 3 = 0 THEN p_brand || '_v2' ELSE p_brand || '_v' || (p_size + 1) END AS next_name,
 regexp_matches(p_name, '^[a-zA-Z0-9_-]+$') AS valid, 'axis=' || p_brand || '__size=' || p_size AS label, substr(md5(p_name), 1, 12) AS short,
 CASE p_size % 4 WHEN 0 THEN 'oom' WHEN 1 THEN 'validation_error' WHEN 2 THEN 'contract_error' ELSE 'unknown' END AS kind, CASE p_size % 3 WHEN 0 THEN 'trainer_cwd' WHEN 1 THEN 'pipeline_root' ELSE 'none' END AS base,
 4 * p_size + CASE WHEN p_size % 2 = 0 THEN 8 ELSE 0 END + 36 AS features, CASE WHEN p_size = 0 THEN 0 ELSE p_size % 7 END AS pos FROM part""")
def scalar_functions(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    n, brand = F.col("p_size"), F.col("p_brand")
    text = lambda *xs: F.element_at(F.array(*[F.lit(x) for x in xs]), n % len(xs) + 1)
    return p.select(
        "p_partkey",
        S.fold_name(F.concat_ws("_", "p_type", "p_name")).alias("folded"),
        S.next_version_name(F.when(n % 3 == 0, brand).otherwise(F.concat(brand, F.lit("_v"), n))).alias("next_name"),
        S.valid_label(F.col("p_name")).alias("valid"),
        S.treatment_label(F.create_map(F.lit("size"), n.cast("string"), F.lit("axis"), brand), F.lit("x")).alias("label"),
        S.short_hash(F.lit(""), F.lit(None).cast("string"), F.md5("p_name")).alias("short"),
        S.error_kind(text("Killed by host", "invalid manifest", "contract schema 3", "function missing"), F.lit("at line 3")).alias("kind"),
        S.slot_base(text("stages.training.overrides.data.data_dir", "stages.backtesting.script", "experiment.name")).alias("base"),
        S.feature_count(n, n % 2 == 0, F.lit(True), F.lit(False)).alias("features"),
        S.position_of(F.array(*[F.lit(i) for i in range(7)]), n % 7).cast("int").alias("pos"),
    )


# --- identity, grid, validation ---------------------------------------------


@query("""WITH r AS (SELECT r_regionkey AS v, replace(replace(r_name, ' ', '_'), '.', '_') AS l, row_number() OVER (ORDER BY r_regionkey) - 1 AS p FROM region), n AS (SELECT n_nationkey AS v, n_name AS l, row_number() OVER (ORDER BY n_nationkey) - 1 AS p FROM nation),
 m AS (SELECT l, l AS v, row_number() OVER (ORDER BY l) - 1 AS p FROM (SELECT DISTINCT c_mktsegment AS l FROM customer)) SELECT (r.p * (SELECT count(*) FROM n) + n.p) * (SELECT count(*) FROM m) + m.p AS point, 'sweep__' || r.l || '_' || n.l || '_' || m.l AS name,
 'data.region=' || r.v || ',model.nation=' || n.v || ',train.segment=' || m.v AS overrides FROM r, n, m""")
def grid_expand(spark, sf_dir):
    out = grid.expand(R.axes(spark, sf_dir), "sweep")
    pairs = F.array_join(F.array_sort(F.transform(F.map_entries("overrides"), lambda e: F.concat_ws("=", e["key"], e["value"]))), ",")
    return out.select("point", "name", pairs.alias("overrides"))


@query("""SELECT 'error' AS severity, 'label' AS rule, 'bad label nation=NATION 2' AS message UNION ALL SELECT 'error', 'shared_key', 'key data.region set by nation and region' UNION ALL SELECT 'error', 'strategy', 'reserved strategy: zip'""")
def grid_findings(spark, sf_dir):
    """A sweep with three planted faults."""
    a = R.axes(spark, sf_dir)
    second = (F.col("axis") == "nation") & (F.col("label") == "NATION_2")
    a = a.withColumn("overrides", F.when(second, F.map_from_arrays(F.array(F.lit("data.region")), F.array(F.lit("9")))).otherwise(F.col("overrides"))).withColumn("label", F.when(second, "NATION 2").otherwise(F.col("label")))
    return grid.findings(a, "zip")


@query("""WITH k AS (SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN 'train.lr' WHEN 1 THEN 'extraction.levels' WHEN 2 THEN 'backtest.fee' WHEN 3 THEN 'experiment.name' ELSE 'export.dir' END AS key FROM part)
 SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN 'training' WHEN 1 THEN 'extraction' WHEN 2 THEN 'backtesting' WHEN 3 THEN 'experiment' ELSE 'signal_export' END AS target, CASE p_partkey % 5 WHEN 0 THEN 'train.lr' WHEN 1 THEN 'levels' WHEN 2 THEN 'fee' WHEN 3 THEN 'experiment.name' ELSE 'dir' END AS path FROM k""")
def override_routing(spark, sf_dir):
    n = F.col("p_partkey")
    key = F.element_at(F.array(*[F.lit(x) for x in ("train.lr", "extraction.levels", "backtest.fee", "experiment.name", "export.dir")]), (n % 5 + 1).cast("int"))
    return grid.route(table(spark, sf_dir, "part").select("p_partkey", key.alias("key"))).select("p_partkey", "target", "path")


@query(f"""WITH {R.LEDGER}, f AS (SELECT experiment_id, 'model.type' AS path, model_type AS value FROM ledger UNION ALL SELECT experiment_id, 'model.seed', CAST(seed AS VARCHAR) FROM ledger WHERE seed <> 0)
 SELECT experiment_id, sha256('[' || string_agg('{{"path":"' || path || '","value":"' || value || '"}}', ',' ORDER BY path) || ']') AS fingerprint FROM f GROUP BY experiment_id""")
def config_fingerprint(spark, sf_dir):
    """Observed keys and defaults leave the hash alone."""
    flat = R.ledger(spark, sf_dir).select("experiment_id", F.inline(F.array(*[F.struct(F.lit(p).alias("path"), v.alias("value")) for p, v in (("model.type", F.col("model_type")), ("model.seed", F.col("seed").cast("string")), ("experiment.name", F.col("name")), ("data.tags.x", F.col("status")))])))
    return identity.fingerprints(flat, "experiment_id", defaults={"model.seed": "0"}).select("experiment_id", "fingerprint")


@query("""WITH s AS (SELECT p_brand AS name, list_sort(list_distinct(list(CAST(p_size AS INT)))) AS ix FROM part GROUP BY p_brand) SELECT name, sha256('{"contract_version": "1.2", "feature_indices": [' || array_to_string(ix, ', ') || '], "source_feature_count": 128}') AS content_hash, len(ix) AS n FROM s""")
def feature_set_hash(spark, sf_dir):
    rows = table(spark, sf_dir, "part").groupBy(F.col("p_brand").alias("name")).agg(F.collect_list("p_size").alias("ix"))
    return rows.select("name", identity.set_hash(F.col("ix"), F.lit(128), F.lit("1.2")).alias("content_hash"), F.size(identity.selection(F.col("ix"))).cast("long").alias("n"))


@query()
def canonical_hash(spark, sf_dir):
    """Byte-exact canonical JSON hashes; tested against Python's own."""
    return table(spark, sf_dir, "events").select("event_id", identity.canonical_hash(F.col("props")).alias("hash"))


@query(f"""WITH {R.CACHE} SELECT cache_key, CASE WHEN mtime % 17 = 0 THEN 'bypass' WHEN mtime % 5 = 0 THEN 'miss' WHEN mtime % 7 = 0 THEN 'malformed' WHEN pinned THEN 'poisoned' ELSE 'hit' END AS state FROM cache""")
def cache_state(spark, sf_dir):
    """Pages may share a url, so an entry is named by its time as well."""
    c = R.cache(spark, sf_dir)
    entries = c.filter("mtime % 5 <> 0").select("cache_key", "mtime", (F.col("mtime") % 7 != 0).alias("has_manifest"), (~F.col("pinned")).alias("intact"))
    return identity.cache_state(c.select("cache_key", "mtime", (F.col("mtime") % 17 == 0).alias("bypass")), entries, ["cache_key", "mtime"]).select("cache_key", "state")


@query(f"""WITH {R.LEDGER} SELECT 'warn' AS severity, 'contract' AS rule, 'no contract version' AS message, experiment_id AS context FROM ledger WHERE ordinal % 50 = 0 UNION ALL SELECT 'error', 'contract', 'contract version 2.1.0', experiment_id FROM ledger WHERE ordinal % 50 = 1
 UNION ALL SELECT 'error', 'min_features', 'BUILDING needs more features', experiment_id FROM ledger WHERE model_type = 'BUILDING' AND ordinal % 60 < 10 UNION ALL SELECT 'error', 'min_features', 'MACHINERY needs more features', experiment_id FROM ledger WHERE model_type = 'MACHINERY' AND ordinal % 60 = 0 UNION ALL SELECT 'error', 'max_features', 'BUILDING takes fewer features', experiment_id FROM ledger WHERE model_type = 'BUILDING' AND ordinal % 60 > 50
 UNION ALL SELECT 'warn', 'model', 'unknown model ' || model_type, experiment_id FROM ledger WHERE model_type NOT IN ('BUILDING', 'MACHINERY') AND ordinal % 60 > 0
 UNION ALL SELECT 'error', 'positive', model_type || ' needs features and a sequence', experiment_id FROM ledger WHERE model_type NOT IN ('BUILDING', 'MACHINERY') AND ordinal % 60 = 0""")
def validation_findings(spark, sf_dir):
    rows = R.ledger(spark, sf_dir)
    n = F.col("ordinal")
    version = F.when(n % 50 == 0, "").when(n % 50 == 1, "2.1.0").otherwise("2.2.7")
    models = spark.sql("SELECT * FROM VALUES ('BUILDING', 10, 50, 1, array('any')), ('MACHINERY', CAST(NULL AS INT), CAST(NULL AS INT), 1, array('a')) AS t(model, min_features, max_features, min_sequence_length, sources)")
    runs = rows.select(F.col("experiment_id").alias("run_id"), F.col("model_type").alias("model"), (n % 60).alias("n_features"), F.lit(5).alias("sequence_length"), F.lit("a").alias("source"))
    return validation.together(validation.contract_version(rows.withColumn("contract_version", version), "2.2.0", key="experiment_id"), validation.input_contracts(runs, models))


@query("""WITH l AS (SELECT p_partkey, p_size % 4 AS k FROM part) SELECT p_partkey, CASE k WHEN 0 THEN 'same' WHEN 1 THEN 'differs' WHEN 2 THEN 'unknown' ELSE 'differs' END AS verdict, CASE k WHEN 1 THEN 'name' WHEN 3 THEN 'type,horizon' ELSE '' END AS differs FROM l""")
def label_identity(spark, sf_dir):
    k = F.col("p_size") % 4
    pick = lambda *xs: F.element_at(F.array(*[F.lit(x).cast("string") for x in xs]), k + 1)
    rows = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("run_id"), pick("SmoothedReturn", "smoothed_return", None, "x").alias("scored_name"), pick("smoothed_return", "point_return", "a", "X").alias("fitted_name"), pick("a", None, "", "point").alias("scored_type"), pick("a", "b", "b", "peak").alias("fitted_type"), pick("10", "10", None, "10").alias("scored_horizon"), pick("10", None, "60", "60").alias("fitted_horizon"))
    return validation.label_identity(rows).select(F.col("run_id").alias("p_partkey"), "verdict", F.array_join("differs", ",").alias("differs"))


# --- monitor and scheduling -------------------------------------------------


@query(f"""WITH {R.LEDGER}, {R.VERDICTS}, p AS (SELECT *, CAST(split_part(stats_version, '.', 2) AS INT) AS mi, CAST(split_part(split_part(stats_version, '.', 3), '-', 1) AS INT) AS pa, CASE WHEN stats_version LIKE '%-dev' THEN 0 ELSE 1 END AS rel FROM verdicts)
 SELECT 'info' AS severity, 'stale_version' AS kind, 'probe_id' AS key_name, probe_id AS key, stats_version AS detail FROM p WHERE mi < 2 OR (mi = 2 AND (pa < 3 OR (pa = 3 AND rel < 1)))
 UNION ALL SELECT 'info', 'schema', 'experiment_id', experiment_id, '2.1.0' FROM ledger WHERE ordinal % 50 = 1 UNION ALL SELECT 'info', 'parse', 'probe_id', probe_id, 'late field; odd unit' FROM verdicts WHERE warned
 UNION ALL SELECT 'warn', 'index_count', 'table', 'index', (SELECT count(*) FROM ledger) || ' vs ' || (SELECT count(*) FROM ledger WHERE ordinal % 100 > 0)""")
def drift_flags(spark, sf_dir):
    v, led = R.verdicts(spark, sf_dir), R.ledger(spark, sf_dir)
    n = F.col("ordinal") % 50
    led = led.withColumn("contract_version", F.when(n == 0, "").when(n == 1, "2.1.0").otherwise("2.2.7"))
    return monitor.all_drift(monitor.stale_versions(v, "0.2.3"), monitor.schema_drift(led, v, "2.2.7"), monitor.count_drift(led, led.filter("ordinal % 100 > 0")))


@query(f"""WITH {R.ATTEMPTS}, settled AS (SELECT task_id, min(attempt) AS attempt FROM stamped WHERE status = 'success' OR NOT coalesce(error_kind IN ('oom', 'gpu_acquire_timeout', 'broken_process_pool', 'subprocess_nonzero', 'io_error'), FALSE) OR attempt >= 3 GROUP BY task_id)
 SELECT s.task_id, CAST(s.attempt AS INT) AS attempts, s.status, s.error_kind FROM stamped s JOIN settled t ON s.task_id = t.task_id AND s.attempt = t.attempt UNION ALL SELECT DISTINCT task_id, NULL, 'pending', NULL FROM stamped WHERE task_id NOT IN (SELECT task_id FROM settled)""")
def retry_outcomes(spark, sf_dir):
    return scheduling.outcomes(scheduling.stamp_attempts(R.attempts(spark, sf_dir)), "retry", 2)


@query(f"""WITH {R.ATTEMPTS}, f AS (SELECT * FROM stamped WHERE attempt = 1) SELECT count(*) FILTER (WHERE status = 'success') AS completed, count(*) FILTER (WHERE status = 'failed') AS failed, CAST(0 AS BIGINT) AS duplicates, CAST(0 AS BIGINT) AS not_processed FROM f""")
def sweep_counters(spark, sf_dir):
    return scheduling.counters(scheduling.outcomes(scheduling.stamp_attempts(R.attempts(spark, sf_dir)), "continue"))


# --- analyzers --------------------------------------------------------------


@query(f"""WITH {R.TRADES}, {_means_sql("model, ret", "trades", _KEY, REPS, _CUBE, "pnl")},
 ci AS (SELECT model, ret, quantile_cont(m, 0.025) AS lo FROM m GROUP BY model, ret), pt AS (SELECT model, ret, avg(pnl) AS mean FROM trades GROUP BY model, ret),
 r AS (SELECT *, row_number() OVER (PARTITION BY model, ret, seed ORDER BY abs(pnl) DESC, trade_idx DESC) AS n FROM trades), s AS (SELECT model, ret, seed, coalesce(avg(CASE WHEN n > 5 THEN pnl END), 0) AS t FROM r GROUP BY model, ret, seed), tr AS (SELECT model, ret, avg(t) AS trim FROM s GROUP BY model, ret)
 SELECT pt.model, pt.ret, CASE WHEN mean >= 0.01 AND lo > 0 AND trim > 0 AND pt.ret = 'F' THEN 'GO' WHEN mean > 0 AND mean < 0.01 AND lo <= 0 AND trim > -0.005 AND trim < 0 THEN 'INDETERMINATE' ELSE 'REFUTE' END AS verdict FROM pt JOIN ci ON ci.model = pt.model AND ci.ret = pt.ret JOIN tr ON tr.model = pt.model AND tr.ret = pt.ret""")
def analyze_seeds(spark, sf_dir):
    """Cells to verdicts: pool, resample, trim, gate."""
    from quillon.plans.analyzers import analyze_cells

    t = R.numbered_trades(spark, sf_dir)  # places in a cell are in the order of the places in its seeds
    trades = t.select("model", "ret", "seed", F.col("idx").alias("trade_idx"), F.col("value").alias("pnl"))
    return analyze_cells(t.drop("seed"), trades, ["model", "ret"], control=F.col("ret") == "F", replicates=REPS).select("model", "ret", "verdict")


# --- features the engine adds to what records need --------------------------


@query("""SELECT l_returnflag, l_linestatus, count(*) AS n, round(sum(l_quantity), 2) AS qty FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus)""")
def cube_rollup(spark, sf_dir):
    """Extension: grouping sets."""
    return table(spark, sf_dir, "lineitem").cube("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"), F.round(F.sum("l_quantity"), 2).alias("qty"))


@query("""WITH p AS (SELECT user_id, event_id, ts FROM events WHERE event_type = 'purchase'), c AS (SELECT user_id, event_id, ts FROM events WHERE event_type = 'click'), j AS (SELECT p.event_id, c.event_id AS click_id, row_number() OVER (PARTITION BY p.event_id ORDER BY c.ts DESC, c.event_id DESC) AS n FROM p JOIN c ON p.user_id = c.user_id AND c.ts <= p.ts)
 SELECT p.event_id, j.click_id FROM p LEFT JOIN j ON p.event_id = j.event_id AND n = 1""")
def asof_join(spark, sf_dir):
    """Extension: the last click at or before each purchase, by one window over both."""
    e = table(spark, sf_dir, "events")
    clicks = e.filter("event_type = 'click'").withColumn("click_id", F.col("event_id"))
    return asof(e.filter("event_type = 'purchase'"), clicks, ["user_id"], "ts", "click_id", ties=["event_id"]).select("event_id", "click_id")


@query("""SELECT date_trunc('hour', ts) AS window_start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2""")
def windowed_counts(spark, sf_dir):
    """Extension: the streaming roll-up, run over the finished table."""
    from quillon.streaming.rollup import windowed_counts as counts

    return counts(table(spark, sf_dir, "events")).withColumn("total", F.round("total", 4))


@query("""WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS new FROM events), s AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM g)
 SELECT user_id, count(*) AS n, min(ts) AS session_start FROM s GROUP BY user_id, k""")
def user_sessions(spark, sf_dir):
    """Extension: session windows."""
    from quillon.streaming.rollup import sessions

    return sessions(table(spark, sf_dir, "events")).select("user_id", "n", "session_start")

"""What a scheduler's attempt log says: retries, transience, outcomes, slots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillon.functions.scalars import TRANSIENT
from quillon.functions.semantics import choose

#: Order of the stages of a run.
STAGES = ("extraction", "raw_analysis", "dataset_analysis", "validation", "training", "post_training_gate", "signal_export", "backtesting")


def is_transient(kind: Column) -> Column:
    return F.coalesce(kind.isin(*TRANSIENT), F.lit(False))


def stamp_attempts(log: DataFrame, task: str = "task_id", order: str = "ts", tie: str = "event_id") -> DataFrame:
    """Numbers each task's attempts from 1."""
    return log.withColumn("attempt", F.row_number().over(Window.partitionBy(task).orderBy(order, tie)))


def outcomes(log: DataFrame, policy: str, retries: int = 0, task: str = "task_id") -> DataFrame:
    """The final status of each task under a failure policy, from its attempts (task, attempt, status, error_kind).

    Under retry only transient failures are tried again, ``retries`` times at
    most; attempts beyond the one that settles a task do not count.
    """
    last = retries + 1 if policy == "retry" else 1
    settles = (F.col("status") == "success") | ~is_transient(F.col("error_kind")) | (F.col("attempt") >= last)
    first = log.filter(settles).groupBy(task).agg(F.min("attempt").alias("attempt"))
    done = log.join(first, [task, "attempt"]).select(task, F.col("attempt").alias("attempts"), F.col("status"), "error_kind")
    return done.unionByName(log.select(task).distinct().join(first, task, "left_anti").select(task, F.lit(None).cast("int").alias("attempts"), F.lit("pending").alias("status"), F.lit(None).cast("string").alias("error_kind")))


def after_abort(tasks: DataFrame, order: str = "grid_index") -> DataFrame:
    """Under abort every task after the first failure is cancelled."""
    first = tasks.filter(F.col("status") == "failed").agg(F.min(order).alias("_stop"))
    return tasks.crossJoin(first).withColumn("status", F.when(F.col(order) > F.col("_stop"), "cancelled").otherwise(F.col("status"))).drop("_stop")  # one row


def counters(tasks: DataFrame) -> DataFrame:
    """Completed, failed, duplicate and unprocessed tasks of a sweep."""
    n = lambda s: F.count_if(F.col("status") == s)
    return tasks.agg(n("success").alias("completed"), n("failed").alias("failed"), n("skipped").alias("duplicates"), F.count_if(~F.col("status").isin("success", "failed", "skipped")).alias("not_processed"))


def failure_records(tasks: DataFrame) -> DataFrame:
    """Records of failed tasks: they share the fingerprint of what failed and carry its kind, attempts and transience."""
    info = F.struct(F.col("error_kind"), F.col("attempts").alias("attempt"), is_transient(F.col("error_kind")).alias("transient"))
    return tasks.filter(F.col("status") == "failed").select("task_id", "fingerprint", F.lit("sweep_failure").alias("record_type"), F.lit("failed").alias("status"), info.alias("sweep_failure_info"))


def device(slot: Column, n_devices: int) -> Column:
    """Round robin over devices; null without any."""
    return (slot % n_devices).cast("int") if n_devices else F.lit(None).cast("int")


def cpu_slice(budget: int, parallel: int) -> int:
    return max(1, budget // parallel)


def stage_order(stages: DataFrame, name: str = "stage") -> DataFrame:
    """Adds the place of a stage in a run; null for a name that is no stage."""
    place = choose(*[(F.col(name) == s, i) for i, s in enumerate(STAGES)])
    return stages.withColumn("stage_pos", place)


def postconditions(results: DataFrame, violations: DataFrame, key: tuple[str, ...] = ("run_id", "stage")) -> DataFrame:
    """Completed stages whose outputs break a postcondition have failed.

    ``results``: key, status, error_message.  ``violations``: key, violation;
    a check that could not run is a violation too.  Stages that were skipped or
    failed before stay as they are; the violations of the others, sorted, come
    after their message and in ``output_validation_errors``.
    """
    found = violations.filter("violation IS NOT NULL").groupBy(*key).agg(F.array_sort(F.collect_list("violation")).alias("_found"))
    out = results.join(found, list(key), "left")
    broken = (F.col("status") == "completed") & F.col("_found").isNotNull()
    told = F.concat(F.lit("outputs are not as promised ("), F.size("_found").cast("string"), F.lit("): "), F.array_join("_found", "; "))
    return out.withColumns({
        "error_message": F.when(broken, F.concat_ws("\n", F.nullif("error_message", F.lit("")), told)).otherwise(F.col("error_message")),
        "output_validation_errors": F.when(broken, F.col("_found")),
        "status": F.when(broken, "failed").otherwise(F.col("status")),
    }).drop("_found")

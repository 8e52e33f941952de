"""Work that is tried again: a queue in the order of due times, exponential backoff, timeouts as rows, and a table of what failed for good.

Each attempt is a DataFrame over what is due; nothing waits in a thread. Times are seconds from the start of the run, so a schedule can be told and
tested without a clock.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Attempts in all, seconds before the second one, the least and the most that is waited, and seconds that an attempt may take.
ATTEMPTS, BASE, LEAST, MOST, TIMEOUT = 3, 1.0, 1.0, 10.0, 120.0
QUEUE = "due double, attempt int"


def backoff(attempt: Column, base: float = BASE, least: float = LEAST, most: float = MOST) -> Column:
    """Seconds to wait after the attempt with this number (from 1): base, doubled for each one before."""
    return F.greatest(F.lit(least), F.least(F.lit(most), F.lit(base) * F.pow(F.lit(2.0), attempt - 1)))


def queued(work: DataFrame, at: Column | None = None) -> DataFrame:
    """work with due (seconds; 0 if not given) and attempt (1)."""
    return work.withColumn("due", F.lit(0.0) if at is None else at.cast("double")).withColumn("attempt", F.lit(1))


def take(queue: DataFrame, now: float, k: int, key: str) -> DataFrame:
    """The k rows that have been due the longest, at the time now."""
    return queue.filter(F.col("due") <= now).orderBy("due", key).limit(k)


def judged(results: DataFrame, timeout: float = TIMEOUT) -> DataFrame:
    """results (due, attempt, took: seconds, error) with status `completed`, `failed` or `timeout`, and ended (seconds). What takes longer than `timeout`,
    or has never come back (took is null), ends as a timeout then."""
    late = F.coalesce(F.col("took") > timeout, F.lit(True))
    status = F.when(late, "timeout").when(F.col("error").isNotNull(), "failed").otherwise("completed")
    return results.withColumn("status", status).withColumn("error", F.when(late, "timeout").otherwise(F.col("error"))).withColumn("ended", F.col("due") + F.when(late, timeout).otherwise(F.col("took")))


@dataclass
class Outcome:
    """attempts: a row each, with status, error, due and ended. done: rows that were completed. dead: rows that failed ATTEMPTS times, with the last error."""

    attempts: DataFrame
    done: DataFrame
    dead: DataFrame


def run(work: DataFrame, attempt: Callable[[DataFrame], DataFrame], keep: Callable[[DataFrame], DataFrame], most: int = ATTEMPTS, timeout: float = TIMEOUT) -> Outcome:
    """Try each row of work until it is completed, `most` times at most. attempt() gets rows with due and attempt, and gives them back with took and error (null
    where it went well); rows that it leaves out are timeouts. work has no columns of the names that are added, and no equal rows.

    keep() materialises each attempt: what has been tried is not tried again when a later step is.
    """
    queue, rows = queued(work), None
    names = [*work.columns, "due", "attempt"]
    for n in range(1, most + 1):
        came = attempt(queue).select(*names, "took", "error")
        whole = queue.alias("q").join(came.alias("c"), [F.col(f"q.{c}").eqNullSafe(F.col(f"c.{c}")) for c in names], "left").select(*[F.col(f"q.{c}") for c in names], "c.took", "c.error")
        tried = keep(judged(whole, timeout))
        rows = tried if rows is None else rows.unionByName(tried)
        again = tried.filter("status <> 'completed'")
        if n == most or again.isEmpty():
            break
        queue = again.withColumn("due", F.col("ended") + backoff(F.col("attempt"))).withColumn("attempt", F.col("attempt") + 1).select(*names)
    return Outcome(rows, rows.filter("status = 'completed'"), rows.filter((F.col("status") != "completed") & (F.col("attempt") == most)))

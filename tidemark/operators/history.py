"""Query history, run evaluation and error classification."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.functions.columns import contains_ignoring_case
from tidemark.operators.sets import recall

HISTORY_SCHEMA = (
    "id string, session_id string, user_query string, query_plan string, sql_generated string, "
    "execution_success int, retry_count int, validation_passed int, summary string, "
    "user_feedback string, confidence_score double, created_at string"
)

# Error category -> phrases that mark it, most specific first.
# "does not exist" fits tables, operators and columns; the object word decides.
ERROR_PHRASES = [
    ("PERMISSION_ERROR", [r"access ?denied", r"permission denied", r"not authorized", r"\b403\b"]),
    ("TIMEOUT", [r"timeout", r"timed out", r"exceeded", r"query exhausted resources", r"cancelled"]),
    ("EMPTY_RESULT", [r"returned 0 rows", r"empty result"]),
    ("TYPE_ERROR", [r"cannot be applied to", r"type mismatch", r"cannot cast", r"incompatible types",
                    r"operator does not exist"]),
    ("JOIN_ERROR", [r"ambiguous column", r"cartesian product", r"column is ambiguous", r"is ambiguous"]),
    ("MISSING_TABLE", [r"table not found", r"(relation|table)\b.*does not exist", r"hive_metastore_error"]),
    ("MISSING_COLUMN", [r"column[ _]not[ _]found", r"cannot (be )?resolved?", r"unknown column", r"does not exist"]),
    ("SYNTAX_ERROR", [r"syntax error", r"unexpected token", r"mismatched input", r"encountered", r"parse error"]),
]


def append_history(rows: DataFrame, path: str) -> None:
    """Add finished runs to the log."""
    rows.select(*StructType.fromDDL(HISTORY_SCHEMA).names).write.mode("append").parquet(path)


def search_history(log: DataFrame, text: str, limit: int = 5) -> DataFrame:
    """Newest successful queries whose text contains ``text``, ignoring case."""
    hit = contains_ignoring_case("user_query", text) & (F.col("execution_success") == 1)
    return log.filter(hit).orderBy(F.desc("created_at"), "id").limit(limit)


def recent_history(log: DataFrame, session: str | None = None, limit: int = 10) -> DataFrame:
    chosen = log.filter(F.col("session_id") == session) if session else log
    return chosen.orderBy(F.desc("created_at"), "id").limit(limit)


def scored_runs(runs: DataFrame) -> DataFrame:
    """Table recall and share of expected SQL fragments per evaluation run."""
    fragments = F.col("expected_sql_contains")
    sql = F.lower("generated_sql")
    present = F.filter(fragments, lambda f: F.contains(sql, F.lower(f)))
    none_expected = F.coalesce(F.size(fragments), F.lit(0)) <= 0
    return runs.withColumns(
        {
            "discovery_accuracy": recall(F.col("expected_tables"), F.col("discovered_tables")),
            "fragment_share": F.when(none_expected, F.col("execution_success").cast("double")).otherwise(
                F.size(present) / F.size(fragments)
            ),
        }
    )


def evaluation_report(runs: DataFrame) -> DataFrame:
    """Means over all runs; "sql_correctness" is the share of runs that executed."""
    flag = lambda c: F.avg(F.col(c).cast("double"))
    return scored_runs(runs).agg(
        F.count("*").alias("total_queries"),
        F.avg("discovery_accuracy").alias("discovery_accuracy"),
        F.avg("fragment_share").alias("fragment_share"),
        flag("execution_success").alias("sql_correctness"),
        F.avg("retry_count").alias("retry_rate"),
        flag("validation_passed").alias("validation_pass_rate"),
        F.avg("latency_seconds").alias("avg_latency_seconds"),
        flag("human_escalated").alias("human_escalation_rate"),
        F.avg("confidence_score").alias("avg_confidence"),
    )


def error_category(message: Column) -> Column:
    """Exactly one category per message; UNKNOWN when no phrase fits."""
    text = F.lower(message)
    chain = reduce(
        lambda c, item: c.when(text.rlike("|".join(item[1])), F.lit(item[0])),
        ERROR_PHRASES,
        F.when(text.isNull(), F.lit("UNKNOWN")),
    )
    return chain.otherwise(F.lit("UNKNOWN"))

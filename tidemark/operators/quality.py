"""Record rules, column profiles, key checks and the scorecard."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, NumericType, StringType, StructType

from tidemark.functions.columns import number_or_null
from tidemark.functions.numbers import money

# Allowed subscriptions and age bounds (both bounds pass).
SUBSCRIPTIONS = ("Basic", "Standard", "Premium")
MIN_AGE, MAX_AGE = 18, 100
# Name parts of columns that should never be negative.
POSITIVE_NAMES = ("revenue", "amount", "count", "price", "total", "quantity")
MAX_NULL_SHARE = 0.5
MAX_Z = 4.0
# Weight of each check and the two confidence bounds.
CHECK_WEIGHTS = {"schema": "0.15", "logic": "0.30", "data": "0.25", "business": "0.30"}
PROCEED_ABOVE, RETRY_FROM = "0.7", "0.4"


def first_failure(rules: Sequence[tuple[str, Column]]) -> Column:
    """Name of the first rule that fails; NULL when all hold.

    A rule holds only when it is true, so a NULL operand fails it.
    """
    checks = [F.when(~F.coalesce(holds, F.lit(False)), F.lit(name)) for name, holds in rules]
    return F.coalesce(*checks)


def subscriber_rules() -> list[tuple[str, Column]]:
    return [
        ("age", F.col("age").between(MIN_AGE, MAX_AGE)),
        ("subscription_type", F.col("subscription_type").isin(*SUBSCRIPTIONS)),
    ]


def order_rules(now: Column) -> list[tuple[str, Column]]:
    return [
        ("order_id", F.length(F.col("order_id").cast("string")) > 0),
        ("amount", F.col("amount") > 0),
        ("order_date", F.try_to_timestamp(F.col("order_date").cast("string"), F.lit("yyyy-MM-dd")) <= now),
    ]


def validated(df: DataFrame, rules: Sequence[tuple[str, Column]]) -> DataFrame:
    return df.withColumn("reason", first_failure(rules)).withColumn("passed", F.col("reason").isNull())


def with_status(df: DataFrame, now: Column) -> DataFrame:
    """Order messages with their processing time and SUCCESS or FAILURE."""
    checked = df.withColumn("reason", first_failure(order_rules(now)))
    return checked.withColumn(
        "processed_timestamp", F.date_format(now, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    ).withColumn("status", F.when(F.col("reason").isNull(), "SUCCESS").otherwise("FAILURE"))


def status_counts(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count_if(F.col("status") == "SUCCESS").alias("success_count"),
        F.count_if(F.col("status") == "FAILURE").alias("failure_count"),
    )


def _as_number(df: DataFrame, name: str) -> Column:
    kind = df.schema[name].dataType
    if isinstance(kind, StringType):
        return number_or_null(F.col(f"`{name}`"), "double")
    if isinstance(kind, NumericType | BooleanType):
        return F.col(f"`{name}`").cast("double")
    return F.lit(None).cast("double")


def profile(df: DataFrame) -> DataFrame:
    """One row per column with its null share, z-score and sign issues.

    Everything comes from a single aggregate over the input; the largest
    |z| follows from the minimum and the maximum. The flags: more than half
    NULL; some |z| above 4 among at least 3 numbers (population deviation);
    a negative value in a column named like a quantity or money.
    """
    measures = [F.count("*").alias("rows")]
    for i, name in enumerate(df.columns):
        number = _as_number(df, name)
        measures += [
            F.count(F.col(f"`{name}`")).alias(f"present{i}"),
            F.count(number).alias(f"numbers{i}"),
            F.avg(number).alias(f"mean{i}"),
            F.stddev_pop(number).alias(f"deviation{i}"),
            F.min(number).alias(f"min{i}"),
            F.max(number).alias(f"max{i}"),
        ]
    per_column = []
    for i, name in enumerate(df.columns):
        low, high = F.col(f"min{i}"), F.col(f"max{i}")
        mean, deviation = F.col(f"mean{i}"), F.col(f"deviation{i}")
        usable = (F.col(f"numbers{i}") >= 3) & (deviation > 0) & ~F.isnan(deviation)
        z = F.when(usable, F.greatest((high - mean) / deviation, (mean - low) / deviation))
        positive = any(part in name.lower() for part in POSITIVE_NAMES)
        per_column.append(
            F.struct(
                F.lit(name).alias("column"),
                F.col("rows"),
                F.try_divide(F.col("rows") - F.col(f"present{i}"), F.col("rows")).alias("null_share"),
                mean.alias("mean"),
                deviation.alias("deviation"),
                z.alias("max_z"),
                F.coalesce((low < 0) & F.lit(positive), F.lit(False)).alias("has_negative"),
            )
        )
    rows = df.agg(*measures).select(F.explode(F.array(*per_column)).alias("p")).select("p.*")
    return rows.withColumns(
        {
            "too_many_nulls": F.coalesce(F.col("null_share") > MAX_NULL_SHARE, F.lit(False)),
            "has_outlier": F.coalesce(F.col("max_z") > MAX_Z, F.lit(False)),
        }
    )


def result_issues(df: DataFrame) -> DataFrame:
    """Issues of a result set as rows ``(column, issue)``; an empty result is one issue."""
    p = profile(df)
    named = F.filter(
        F.array(
            F.when(F.col("rows") == 0, F.lit("EMPTY_RESULT")),
            F.when(F.col("too_many_nulls"), F.lit("NULLS")),
            F.when(F.col("has_outlier"), F.lit("OUTLIER")),
            F.when(F.col("has_negative"), F.lit("NEGATIVE")),
        ),
        lambda x: x.isNotNull(),
    )
    issues = p.select(F.col("column"), F.explode(named).alias("issue"))
    return issues.select(
        F.when(F.col("issue") != "EMPTY_RESULT", F.col("column")).alias("column"), "issue"
    ).distinct()


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("copies")).filter("copies > 1")


def not_null_violations(df: DataFrame, required: Sequence[str]) -> DataFrame:
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in required])
    return counts.select(
        F.explode(
            F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("nulls")) for c in required])
        ).alias("v")
    ).select("v.*")


def schema_differences(df: DataFrame, expected: StructType) -> DataFrame:
    """Rows ``(column, problem, expected_type, actual_type)`` against a declared schema."""
    actual = {f.name.lower(): f for f in df.schema.fields}
    wanted = {f.name.lower(): f for f in expected.fields}
    rows = []
    for key, field in wanted.items():
        if key not in actual:
            rows.append((field.name, "missing", field.dataType.simpleString(), None))
        elif actual[key].dataType != field.dataType:
            rows.append(
                (field.name, "type", field.dataType.simpleString(), actual[key].dataType.simpleString())
            )
    rows += [(f.name, "extra", None, f.dataType.simpleString()) for k, f in actual.items() if k not in wanted]
    return df.sparkSession.createDataFrame(
        rows, "column string, problem string, expected_type string, actual_type string"
    )


def unreferenced_tables(statements: DataFrame, tables: Sequence[str], sql: str = "sql") -> DataFrame:
    """Schema tables whose name does not occur in the SQL text of a row."""
    names = F.array(*[F.lit(t) for t in tables])
    missing = F.filter(names, lambda t: ~F.contains(F.lower(sql), F.lower(t)))
    return statements.withColumn("table_name", F.explode(missing))


def join_fanout(right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """How far a join to ``right`` on ``keys`` would multiply rows."""
    per_key = right.groupBy(*keys).agg(F.count("*").alias("n"))
    return per_key.agg(
        F.max("n").alias("max_per_key"),
        F.count_if(F.col("n") > 1).alias("repeated_keys"),
        F.count("*").alias("distinct_keys"),
    )


def sanity_rules(
    df: DataFrame, today: Column, percent: Sequence[str] = (), counts: Sequence[str] = (),
    dates: Sequence[str] = (), texts: Sequence[str] = (), max_rows: int | None = None,
) -> DataFrame:
    """Rows ``(rule, column, violations)``, all counted in one pass."""
    checks: list[tuple[str, str, Column]] = []
    checks += [("percent_range", c, F.count_if(~F.col(c).between(0, 100))) for c in percent]
    checks += [("whole_count", c, F.count_if(F.col(c) != F.floor(c))) for c in counts]
    checks += [("future_date", c, F.count_if(F.to_date(c) > today)) for c in dates]
    checks += [("null_text", c, F.count_if(F.lower(F.trim(c)) == "null")) for c in texts]
    if max_rows is not None:
        checks.append(("row_bound", "*", F.greatest(F.count("*") - F.lit(max_rows), F.lit(0)).cast("bigint")))
    counted = df.agg(*[c.alias(f"v{i}") for i, (_, _, c) in enumerate(checks)])
    rows = F.array(
        *[
            F.struct(F.lit(rule).alias("rule"), F.lit(name).alias("column"), F.col(f"v{i}").alias("violations"))
            for i, (rule, name, _) in enumerate(checks)
        ]
    )
    return counted.select(F.explode(rows).alias("r")).select("r.*")


def scorecard(results: DataFrame, run: Sequence[str]) -> DataFrame:
    """Confidence and recommendation per run from rows ``(run.., check, passed)``.

    Decimal arithmetic: weights are subtracted exactly, so two failed checks of
    0.30 leave 0.40 and mean "retry". A NULL outcome counts as passed for the
    confidence but not for "all passed".
    """
    def dec(text: str) -> Column:
        return F.lit(text).cast("decimal(6,4)")

    weight = reduce(
        lambda w, item: w.when(F.col("check") == item[0], dec(item[1])),
        CHECK_WEIGHTS.items(),
        F.when(F.lit(False), dec("0")),
    )
    lost = F.coalesce(F.sum(F.when(~F.col("passed"), weight)), dec("0"))
    scored = results.groupBy(*run).agg(
        F.coalesce(F.bool_and(F.coalesce("passed", F.lit(False))), F.lit(False)).alias("all_passed"),
        F.greatest(dec("0"), F.least(dec("1"), dec("1") - lost)).alias("confidence"),
    )
    advice = (
        F.when(F.col("all_passed") & (F.col("confidence") > dec(PROCEED_ABOVE)), F.lit("proceed"))
        .when(F.col("confidence") >= dec(RETRY_FROM), F.lit("retry"))
        .otherwise(F.lit("escalate"))
    )
    return scored.withColumn("recommendation", advice)


def reconcile(expected: DataFrame, supplied: DataFrame, keys: Sequence[str], measure: str, tolerance: float = 0.0) -> DataFrame:
    """Differences between a recomputed metric and a supplied result."""
    e = expected.select(*keys, F.col(measure).alias("expected"))
    s = supplied.select(*keys, F.col(measure).alias("supplied"))
    joined = e.join(s, list(keys), "full")
    gap = F.abs(F.col("expected") - F.col("supplied"))
    return joined.withColumn("difference", gap).filter(F.coalesce(gap > tolerance, F.lit(True)))


def line_mismatches(df: DataFrame, quantity: str, unit_price: str, total: str) -> DataFrame:
    """Lines whose total is not quantity times unit price."""
    expected = (F.col(quantity).cast("decimal(10,0)") * money(unit_price)).cast("decimal(18,2)")
    return df.filter(expected != money(total))

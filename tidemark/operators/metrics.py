"""Approved metric definitions and the aggregate queries built from them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import ratio
from tidemark.functions.times import grain_start
from tidemark.operators.dimensions import one_row_per_key
from tidemark.operators.joins import JOIN_TYPES

METRIC_SCHEMA = (
    "name string, definition string, sql_expression string, table string, filters string, "
    "approved boolean, last_updated string, updated_by string"
)


@dataclass(frozen=True)
class Metric:
    """An aggregate expression over one table with the filter it requires."""

    name: str
    expression: str
    table: str
    filters: str = ""
    approved: bool = True


@dataclass(frozen=True)
class Request:
    """A structured question: metrics by dimensions, filtered, sorted, limited."""

    metrics: Sequence[Metric]
    dimensions: Sequence[str] = ()
    filters: Sequence[tuple[str, str, object]] = ()
    joins: Sequence[tuple[str, str, str, str]] = ()  # table, left key, right key, kind
    time_column: str | None = None
    grain: str | None = None
    sort: tuple[str, str] | None = None
    limit: int | None = None
    tie_break: Sequence[str] = field(default=())


# Filter operators a request may name.
OPERATORS = {
    "=": lambda c, v: c == v,
    "!=": lambda c, v: c != v,
    ">": lambda c, v: c > v,
    "<": lambda c, v: c < v,
    ">=": lambda c, v: c >= v,
    "<=": lambda c, v: c <= v,
    "between": lambda c, v: c.between(v[0], v[1]),
    "in": lambda c, v: c.isin(*v),
    "like": lambda c, v: c.like(v),
    "is null": lambda c, v: c.isNull(),
    "is not null": lambda c, v: c.isNotNull(),
}


def predicate(name: str, operator: str, value: object) -> Column:
    return OPERATORS[operator.lower()](F.col(name), value)


def metric_query(tables: Mapping[str, DataFrame], request: Request) -> DataFrame:
    """Evaluate approved metrics of one table by the requested dimensions."""
    refused = [m.name for m in request.metrics if not m.approved]
    if refused:
        raise ValueError(f"metrics are not approved: {refused}")
    bases = {(m.table, m.filters) for m in request.metrics}
    if len(bases) != 1:
        raise ValueError("metrics of one request must share table and filter")
    base, required = bases.pop()

    df = tables[base]
    if required:
        df = df.filter(required)
    for other, left, right, kind in request.joins:
        df = df.join(tables[other], F.col(left) == F.col(right), JOIN_TYPES[kind.upper()])
    if request.filters:
        df = df.filter(reduce(lambda a, b: a & b, [predicate(*f) for f in request.filters]))
    groups: list[Column] = [F.col(d) for d in request.dimensions]
    if request.grain and request.time_column:
        groups.append(grain_start(request.time_column, request.grain).alias("period"))
    out = df.groupBy(*groups).agg(*[F.expr(m.expression).alias(m.name) for m in request.metrics])
    if request.sort:
        name, order = request.sort
        out = out.orderBy(F.col(name).desc() if order == "desc" else F.col(name).asc(), *request.tie_break)
    return out.limit(request.limit) if request.limit else out


def compare_values(result: DataFrame, dimension: str, first: str, second: str, metric: str) -> DataFrame:
    """Two values of a dimension side by side with difference and percent change."""
    side = lambda v: F.max(F.when(F.col(dimension) == v, F.col(metric)))
    return result.agg(side(first).alias("first_value"), side(second).alias("second_value")).withColumns(
        {
            "difference": F.col("second_value") - F.col("first_value"),
            "change_pct": ratio((F.col("second_value") - F.col("first_value")) * 100.0, F.col("first_value")),
        }
    )


def lookup_metric(store: DataFrame, name: str) -> DataFrame:
    return store.filter(F.col("name") == name.lower())


def approved_metrics(store: DataFrame) -> DataFrame:
    return store.filter("approved")


def _last_per_name(changes: DataFrame, newest: Sequence[Column | str]) -> DataFrame:
    return one_row_per_key(changes.withColumn("name", F.lower("name")), "name", newest)


def upsert_metrics(store: DataFrame, changes: DataFrame, today: Column, newest: Sequence[Column | str] = ()) -> DataFrame:
    """Add or replace definitions by lower-cased name; of a repeated name the first in ``newest`` order counts."""
    lowered = _last_per_name(changes, newest)
    attributes = [c for c in store.columns if c not in ("name", "last_updated")]
    kept = store.join(lowered.select("name"), "name", "left_anti")
    dated = lowered.select("name", *attributes).withColumn("last_updated", today.cast("string"))
    return kept.unionByName(dated)


def suggest_metrics(store: DataFrame, suggestions: DataFrame, today: Column, newest: Sequence[Column | str] = ()) -> DataFrame:
    """Add unapproved definitions, each name once; known names are left alone."""
    fresh = (
        _last_per_name(suggestions, newest)
        .join(store.select("name"), "name", "left_anti")
        .withColumns(
            {
                "approved": F.lit(False),
                "updated_by": F.lit("auto_suggested"),
                "last_updated": today.cast("string"),
            }
        )
    )
    return store.unionByName(fresh.select(*store.columns))


def apply_feedback(store: DataFrame, feedback: DataFrame) -> DataFrame:
    """Approve on ``correct``, flag for review on ``incorrect``, ignore other text.

    ``feedback`` holds ``(seq, metric, feedback)``; the last usable entry per
    metric counts.
    """
    verdict = F.lower("feedback")
    last = (
        feedback.filter(verdict.isin("correct", "incorrect"))
        .groupBy(F.lower("metric").alias("name"))
        .agg(F.max_by(verdict, F.col("seq")).alias("_verdict"))
    )
    joined = store.join(last, "name", "left")
    approve = (F.col("_verdict") == "correct") & ~F.col("approved")
    review = F.col("_verdict") == "incorrect"
    return joined.withColumns(
        {
            "updated_by": F.when(approve, F.lit("user_feedback"))
            .when(review, F.lit("needs_review"))
            .otherwise(F.col("updated_by")),
            "approved": F.when(approve, F.lit(True)).when(review, F.lit(False)).otherwise(F.col("approved")),
        }
    ).select(*store.columns)

"""Declarative assertions per model, evaluated with one scan per kind and model.

The registry plays the role of a test file: unique key, not-NULL shares, accepted values and
boolean expressions.  ``check_model`` turns them into rows (model, check, target, failed, passed).
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.functions.expressions import AsOf, as_of_ts
from eventloom.functions.measures import rows
from eventloom.operators.quality import failures_of, unpivot_row
from eventloom.sources.schemas import DEVICE_TYPES, EVENT_TYPES, PLATFORMS, TIERS

AT_LEAST = 0.99


@dataclass(frozen=True)
class Assertions:
    unique: tuple[str, ...]
    present: tuple[str, ...]
    non_negative: tuple[str, ...] = ()
    ranges: dict[str, int] = field(default_factory=dict)  # column -> upper bound, lower bound 0
    booleans: tuple[str, ...] = ()
    accepted: dict[str, tuple[str, ...]] = field(default_factory=dict)
    expressions: tuple[str, ...] = ()  # :now is the run time

    def conditions(self, as_of: AsOf) -> dict[str, Column]:
        out = {f"{c} >= 0": F.col(c) >= 0 for c in self.non_negative}
        out |= {f"0 <= {c} <= {top}": F.col(c).between(0, top) for c, top in self.ranges.items()}
        out |= {f"{c} is boolean": F.col(c).isin(True, False) for c in self.booleans}
        stamp = f"timestamp'{as_of}'"
        return out | {e: F.expr(e.replace(":now", stamp)) for e in self.expressions}


MODELS: dict[str, Assertions] = {
    "stg_events": Assertions(
        unique=("event_id", "event_timestamp"),
        present=("event_id", "user_id", "event_type", "event_timestamp"),
        accepted={"event_type": EVENT_TYPES, "platform": PLATFORMS, "device_type": DEVICE_TYPES},
        expressions=("amount is null or amount >= 0", "event_timestamp <= :now"),
        booleans=("is_valid",),
    ),
    "stg_users": Assertions(
        unique=("user_id",),
        present=("user_id", "email", "created_at"),
        accepted={"subscription_tier_standardized": TIERS},
        expressions=("created_at <= :now", "updated_at is null or updated_at >= created_at"),
        non_negative=("days_since_registration",),
        booleans=("is_valid",),
    ),
    "user_metrics": Assertions(
        unique=("user_id", "date"),
        present=("user_id", "date"),
        non_negative=("total_events", "total_purchases", "total_revenue", "unique_event_types", "total_sessions"),
        expressions=("avg_purchase_amount is null or avg_purchase_amount >= 0",),
        booleans=("is_active_today", "made_purchase_today"),
    ),
    "event_metrics": Assertions(
        unique=("event_type", "date"),
        present=("event_type", "date"),
        non_negative=(
            "total_events", "unique_users", "unique_sessions", "total_revenue",
            "web_events", "mobile_events", "avg_events_per_user", "avg_events_per_session",
        ),
    ),
    "ml_features": Assertions(
        unique=("user_id", "feature_date"),
        present=("user_id", "feature_date"),
        non_negative=(
            "events_last_7_days", "events_last_30_days", "purchases_last_7_days",
            "purchases_last_30_days", "revenue_last_7_days", "revenue_last_30_days",
        ),
        ranges={"engagement_score_7d": 100, "engagement_score_30d": 100, "platform_diversity_score": 1},
        booleans=("is_active_7d", "is_active_30d", "purchased_7d", "purchased_30d"),
    ),
    "user_analytics": Assertions(
        unique=("user_id", "date"),
        present=("user_id", "date"),
        non_negative=("total_events", "lifetime_events", "lifetime_purchases", "lifetime_revenue"),
        ranges={"engagement_score_7d": 100, "engagement_score_30d": 100},
        booleans=("is_active_today", "is_active_this_week", "is_active_this_month"),
    ),
    "business_metrics": Assertions(
        unique=("date",),
        present=("date",),
        non_negative=(
            "daily_active_users", "new_users", "daily_revenue", "daily_purchases", "total_events",
            "avg_events_per_user", "premium_users", "basic_users", "revenue_per_user",
        ),
        ranges={"pct_premium_users": 100, "pct_basic_users": 100, "purchase_conversion_rate": 100},
    ),
}


def check_model(df: DataFrame, model: str, as_of: AsOf) -> DataFrame:
    """All assertions of one model as rows; two scans, one of them of the key columns only."""
    spec = MODELS[model]
    conditions = list(spec.conditions(as_of).items())
    accepted = [(c, ~F.col(c).isin(*vals)) for c, vals in spec.accepted.items()]
    counted = df.agg(
        rows().alias("n"),
        *failures_of({f"e{i}": c for i, (_, c) in enumerate(conditions)}),
        *[F.count_if(bad).alias(f"a{i}") for i, (_, bad) in enumerate(accepted)],
        *[F.count_if(F.col(c).isNull()).alias(f"p{i}") for i, c in enumerate(spec.present)],
    )

    def row(kind: str, target: str, failed: Column, passed: Column) -> dict[str, Column]:
        return {
            "model": F.lit(model),
            "check_type": F.lit(kind),
            "target": F.lit(target),
            "failed_rows": failed.cast("long"),
            "passed": passed,
        }

    def counted_row(kind: str, target: str, name: str) -> dict[str, Column]:
        return row(kind, target, F.col(name), F.col(name) == 0)

    entries = [counted_row("expression_is_true", text, f"e{i}") for i, (text, _) in enumerate(conditions)]
    entries += [counted_row("accepted_values", c, f"a{i}") for i, (c, _) in enumerate(accepted)]
    entries += [
        row("not_null_proportion", c, F.col(f"p{i}"), F.col("n") - F.col(f"p{i}") >= F.col("n") * AT_LEAST)
        for i, c in enumerate(spec.present)
    ]
    repeated = df.groupBy(*spec.unique).agg(rows().alias("k")).agg(F.count_if(F.col("k") > 1).alias("u"))
    unique = unpivot_row(repeated, [counted_row("unique_combination", ", ".join(spec.unique), "u")])
    return unpivot_row(counted, entries).unionByName(unique)


def check_models(tables: dict[str, DataFrame], as_of: AsOf) -> DataFrame:
    parts = [check_model(df, name, as_of) for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)

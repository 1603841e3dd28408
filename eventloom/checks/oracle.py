"""The same answers in SQL, written from the metric definitions and not from the Spark code.

``ORACLES`` maps a query name to one statement over the given tables.  Statements are assembled
from the named building blocks in ``CTES``; ``rounded`` brings doubles to 6 places on this side.
"""

from __future__ import annotations

AS_OF = "TIMESTAMP '2024-01-31 00:00:00'"
TODAY = "DATE '2024-01-31'"
# The e-mail pattern and the accepted event types.
EMAIL = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"
ACCEPTED = (
    "'purchase','page_view','signup','login','logout','click','scroll','search','filter','sort',"
    "'error','exception','crash','session_start','session_end'"
)

CTES: dict[str, str] = {}

CTES["raw_events"] = """
SELECT CAST(event_id AS VARCHAR) AS event_id,
       CASE WHEN event_id % 97 = 0 THEN '' ELSE CAST(user_id AS VARCHAR) END AS user_id,
       CASE WHEN event_type = 'view' THEN 'page_view'
            WHEN event_type = 'click' AND event_id % 11 = 0 THEN 'login'
            ELSE event_type END AS event_type,
       CAST(ts AS TIMESTAMP) AS event_timestamp,
       CASE WHEN event_id % 53 = 0 THEN NULL
            ELSE user_id::VARCHAR || '-' || CAST(ts AS DATE)::VARCHAR || '-' || (hour(ts) // 6)::VARCHAR END AS session_id,
       ['desktop', 'mobile', 'tablet', 'other'][event_id % 4 + 1] AS device_type,
       ['ios', 'web', 'mobile', 'web', NULL][event_id % 5 + 1] AS platform,
       '1.0.0' AS app_version,
       CASE WHEN event_type = 'purchase' AND event_id % 20 = 0
              THEN format('{{"currency": "USD", "product_id": "prod_{}"}}', event_id % 10)
            WHEN event_type = 'purchase'
              THEN '{"amount": ' || value::VARCHAR || ', "currency": "' || ['USD', 'EUR', 'GBP', 'CAD'][event_id % 4 + 1]
                   || format('", "product_id": "prod_{}", "category": "cat_{}"}}', event_id % 10, event_id % 6)
            WHEN event_type = 'view'
              THEN format('{{"page": "/p{}", "category": "cat_{}"}}', event_id % 5, event_id % 6)
            ELSE props END AS metadata,
       CAST(ts AS TIMESTAMP) + INTERVAL 1 MINUTE AS created_at,
       CAST(ts AS DATE) AS event_date
FROM events"""

CTES["raw_users"] = """
SELECT CAST(c_custkey AS VARCHAR) AS user_id,
       CASE c_custkey % 50 WHEN 7 THEN 'not-an-email' WHEN 9 THEN NULL
            ELSE lower(replace(c_name, '#', '.')) || '@example.com' END AS email,
       born AS created_at,
       CASE WHEN c_custkey % 3 <> 0 THEN born + to_days(CAST(c_custkey % 20 AS INTEGER)) END AS updated_at,
       CASE WHEN c_custkey % 6 <> 0 THEN 'Cust' END AS first_name,
       substring(c_name, 10) AS last_name,
       ['US', ' ca ', 'uk', 'DE', NULL][c_nationkey % 5 + 1] AS country,
       'UTC' AS timezone,
       CASE c_mktsegment WHEN 'MACHINERY' THEN 'Premium' WHEN 'BUILDING' THEN 'basic'
            WHEN 'AUTOMOBILE' THEN 'enterprise' WHEN 'FURNITURE' THEN NULL ELSE ' BASIC ' END AS subscription_tier,
       '{"source": "' || ['organic', 'ads', 'social'][c_custkey % 3 + 1] || '", "campaign": "c' || (c_custkey % 4)::VARCHAR
         || '", "referral_code": null, "platform": {"os": "x"}}' AS metadata,
       CAST(born AS DATE) AS user_date
FROM (SELECT *, CAST(DATE '2023-10-01' + CAST(c_custkey % 120 AS INTEGER) AS TIMESTAMP) AS born FROM customer)"""

CTES["ev"] = """
SELECT r.*,
       coalesce(event_id, '') <> '' AND coalesce(user_id, '') <> '' AND coalesce(event_type, '') <> ''
         AND event_timestamp IS NOT NULL AS is_valid,
       concat_ws(',', CASE WHEN coalesce(event_id, '') = '' THEN 'missing_event_id' END,
                      CASE WHEN coalesce(user_id, '') = '' THEN 'missing_user_id' END,
                      CASE WHEN coalesce(event_type, '') = '' THEN 'missing_event_type' END,
                      CASE WHEN event_timestamp IS NULL THEN 'missing_event_timestamp' END) AS validation_errors,
       TRY_CAST(metadata ->> '$.amount' AS DOUBLE) AS amount,
       metadata ->> '$.currency' AS currency,
       metadata ->> '$.product_id' AS product_id,
       metadata ->> '$.category' AS category,
       metadata ->> '$.page' AS page,
       metadata ->> '$.source' AS source,
       metadata ->> '$.campaign' AS campaign,
       CAST(length(coalesce(event_id, '')) AS INTEGER) AS event_id_length,
       CAST(length(coalesce(user_id, '')) AS INTEGER) AS user_id_length,
       CAST(length(coalesce(event_type, '')) AS INTEGER) AS event_type_length
FROM raw_events r"""

CTES["good"] = "SELECT * FROM ev WHERE is_valid"

CTES["us"] = f"""
SELECT user_id, email, created_at, updated_at, first_name, last_name,
       concat_ws(' ', first_name, last_name) AS full_name,
       country, upper(trim(coalesce(country, ''))) AS country_standardized,
       timezone, subscription_tier,
       lower(trim(coalesce(subscription_tier, 'basic'))) AS subscription_tier_standardized,
       metadata, user_date,
       coalesce(user_id, '') <> '' AND created_at IS NOT NULL
         AND coalesce(regexp_matches(email, '{EMAIL}'), FALSE) AS is_valid,
       concat_ws(',', CASE WHEN coalesce(user_id, '') = '' THEN 'missing_user_id' END,
                      CASE WHEN coalesce(email, '') = '' THEN 'missing_email' END,
                      CASE WHEN created_at IS NULL THEN 'missing_created_at' END,
                      CASE WHEN NOT regexp_matches(email, '{EMAIL}') THEN 'invalid_email_format' END) AS validation_errors,
       metadata ->> '$.source' AS source,
       metadata ->> '$.referral_code' AS referral_code,
       metadata ->> '$.campaign' AS campaign,
       CASE WHEN json_type(metadata, '$.platform') NOT IN ('OBJECT', 'ARRAY') THEN metadata ->> '$.platform' END AS platform,
       CAST(length(user_id) AS INTEGER) AS user_id_length,
       CAST(coalesce(length(email), 0) AS INTEGER) AS email_length,
       CAST({TODAY} - CAST(created_at AS DATE) AS INTEGER) AS days_since_registration,
       CAST({TODAY} - CAST(updated_at AS DATE) AS INTEGER) AS days_since_last_update
FROM raw_users"""

_PAID = "event_type = 'purchase' AND amount IS NOT NULL"

CTES["um"] = f"""
SELECT d.user_id, d.date, u.country_standardized AS country, u.subscription_tier_standardized AS user_tier,
       u.days_since_registration, d.* EXCLUDE (user_id, date),
       round(total_revenue / total_events, 4) AS revenue_per_event,
       CASE WHEN total_sessions > 0 THEN round(CAST(total_events AS DOUBLE) / total_sessions, 2) ELSE 0.0::DOUBLE END AS events_per_session,
       total_events > 0 AS is_active_today,
       total_purchases > 0 AS made_purchase_today
FROM (SELECT user_id, event_date AS date,
             count(*) AS total_events,
             count(DISTINCT event_type) AS unique_event_types,
             count(DISTINCT session_id) AS unique_sessions,
             count(*) FILTER (event_type = 'purchase') AS total_purchases,
             coalesce(sum(amount) FILTER ({_PAID}), 0.0::DOUBLE) AS total_revenue,
             avg(amount) FILTER ({_PAID}) AS avg_purchase_amount,
             count(*) FILTER (platform = 'web') AS web_events,
             count(*) FILTER (platform = 'mobile') AS mobile_events,
             count(*) FILTER (device_type = 'desktop') AS desktop_events,
             count(*) FILTER (device_type = 'mobile') AS mobile_device_events,
             count(*) FILTER (event_type = 'page_view') AS page_views,
             count(*) FILTER (event_type = 'signup') AS signups,
             count(*) FILTER (event_type = 'login') AS logins,
             count(DISTINCT product_id) AS unique_products_viewed,
             count(DISTINCT category) AS unique_categories_viewed,
             count(DISTINCT session_id) AS total_sessions,
             round(CAST(count(*) AS DOUBLE) / nullif(count(DISTINCT session_id), 0), 2) AS avg_events_per_session,
             coalesce(sum(amount) FILTER ({_PAID} AND currency = 'USD'), 0.0::DOUBLE) AS revenue_usd,
             coalesce(sum(amount) FILTER ({_PAID} AND currency = 'EUR'), 0.0::DOUBLE) AS revenue_eur,
             count(*) FILTER (event_type = 'purchase' AND amount IS NULL) AS purchases_without_amount,
             count(*) FILTER (event_type = 'purchase' AND product_id IS NULL) AS purchases_without_product
      FROM good GROUP BY ALL) d
LEFT JOIN (SELECT * FROM us WHERE is_valid) u USING (user_id)"""

CTES["em"] = f"""
SELECT event_type, date,
       CASE WHEN event_type = 'purchase' THEN 'revenue'
            WHEN event_type IN ('page_view', 'click', 'scroll') THEN 'engagement'
            WHEN event_type IN ('signup', 'login', 'logout') THEN 'authentication'
            WHEN event_type IN ('search', 'filter', 'sort') THEN 'discovery'
            WHEN event_type IN ('error', 'exception', 'crash') THEN 'technical' ELSE 'other' END AS event_category,
       CASE WHEN event_type = 'purchase' THEN CASE WHEN total_revenue > 0 THEN 'high_value' WHEN total_revenue = 0 THEN 'low_value' ELSE 'other' END
            WHEN event_type IN ('page_view', 'click') THEN 'engagement' ELSE 'other' END AS value_category,
       d.* EXCLUDE (event_type, date),
       lag(total_events) OVER prior AS prev_day_events,
       lag(unique_users) OVER prior AS prev_day_users,
       lag(total_revenue) OVER prior AS prev_day_revenue,
       round(100.0::DOUBLE * (total_events - prev_day_events) / nullif(prev_day_events, 0), 2) AS events_growth_rate,
       round(100.0::DOUBLE * (unique_users - prev_day_users) / nullif(prev_day_users, 0), 2) AS users_growth_rate,
       CASE WHEN prev_day_revenue > 0 THEN round(100.0::DOUBLE * (total_revenue - prev_day_revenue) / prev_day_revenue, 2) END AS revenue_growth_rate
FROM (SELECT event_type, event_date AS date,
             count(*) AS total_events,
             count(DISTINCT user_id) AS unique_users,
             count(DISTINCT session_id) AS unique_sessions,
             coalesce(sum(amount) FILTER ({_PAID}), 0.0::DOUBLE) AS total_revenue,
             avg(amount) FILTER ({_PAID}) AS avg_revenue_per_event,
             min(amount) FILTER ({_PAID}) AS min_revenue_per_event,
             max(amount) FILTER ({_PAID}) AS max_revenue_per_event,
             count(*) FILTER (platform = 'web') AS web_events,
             count(*) FILTER (platform = 'mobile') AS mobile_events,
             count(*) FILTER (device_type = 'desktop') AS desktop_events,
             count(*) FILTER (device_type = 'mobile') AS mobile_device_events,
             count(*) FILTER (device_type = 'tablet') AS tablet_events,
             count(DISTINCT product_id) AS unique_products,
             count(DISTINCT category) AS unique_categories,
             coalesce(sum(amount) FILTER ({_PAID} AND currency = 'USD'), 0.0::DOUBLE) AS revenue_usd,
             coalesce(sum(amount) FILTER ({_PAID} AND currency = 'EUR'), 0.0::DOUBLE) AS revenue_eur,
             coalesce(sum(amount) FILTER ({_PAID} AND currency = 'GBP'), 0.0::DOUBLE) AS revenue_gbp,
             count(*) FILTER (event_type = 'purchase' AND amount IS NULL) AS purchases_without_amount,
             count(*) FILTER (event_type = 'purchase' AND product_id IS NULL) AS purchases_without_product,
             count(*) FILTER (event_type IN ('page_view', 'purchase') AND category IS NULL) AS events_without_category,
             round(CAST(count(*) AS DOUBLE) / count(DISTINCT user_id), 2) AS avg_events_per_user,
             round(CAST(count(*) AS DOUBLE) / nullif(count(DISTINCT session_id), 0), 2) AS avg_events_per_session
      FROM good GROUP BY ALL) d
WINDOW prior AS (PARTITION BY event_type ORDER BY date)"""

_W7 = "(PARTITION BY user_id ORDER BY date ROWS 6 PRECEDING)"
_W30 = "(PARTITION BY user_id ORDER BY date ROWS 29 PRECEDING)"
_EVER = "(PARTITION BY user_id ORDER BY date ROWS UNBOUNDED PRECEDING)"


def _total(column: str, frame: str, name: str) -> str:
    return f"CAST(sum({column}) OVER {frame} AS BIGINT) AS {name}"


_ROLLING = ",\n       ".join(
    [_total(f"total_{k}", w, f"{k}_last_{n}_days") for k in ("events", "purchases", "sessions") for w, n in ((_W7, 7), (_W30, 30))]
    + [f"sum(total_revenue) OVER {w} AS revenue_last_{n}_days" for w, n in ((_W7, 7), (_W30, 30))]
    + [_total("total_events", _EVER, "lifetime_events"), _total("total_purchases", _EVER, "lifetime_purchases"),
       f"sum(total_revenue) OVER {_EVER} AS lifetime_revenue"]
)
_SCORES = """least(greatest(2 * events_last_7_days + 10 * purchases_last_7_days + 3 * sessions_last_7_days, 0), 100) AS engagement_score_7d,
       least(greatest(events_last_30_days + 5 * purchases_last_30_days + 2 * sessions_last_30_days, 0), 100) AS engagement_score_30d"""
_TIER = """CASE WHEN lifetime_revenue >= 1000 THEN 'high_value' WHEN lifetime_revenue >= 100 THEN 'medium_value'
            WHEN lifetime_revenue > 0 THEN 'low_value' ELSE 'no_revenue' END"""


def _safe(num: str, den: str, digits: int, default: str) -> str:
    return f"coalesce(round(CAST({num} AS DOUBLE) / nullif({den}, 0), {digits}), {default}::DOUBLE)"


CTES["rolled"] = f"""
SELECT um.*,
       {_ROLLING},
       avg(total_revenue) OVER {_W7} AS avg_revenue_last_7_days,
       avg(total_revenue) OVER {_W30} AS avg_revenue_last_30_days,
       {_total('page_views', _W30, 'page_views_last_30_days')},
       {_total('signups', _W30, 'signups_last_30_days')},
       {_total('logins', _W30, 'logins_last_30_days')},
       {_total('web_events', _W30, 'web_events_last_30_days')},
       {_total('mobile_events', _W30, 'mobile_events_last_30_days')},
       max(unique_products_viewed) OVER {_W30} AS max_products_viewed_30d,
       max(unique_categories_viewed) OVER {_W30} AS max_categories_viewed_30d,
       stddev_samp(total_events) OVER {_W30} AS activity_consistency_30d
FROM um"""

CTES["mf"] = f"""
SELECT user_id, date AS feature_date, country, user_tier, days_since_registration,
       CASE WHEN days_since_registration <= 7 THEN 'new' WHEN days_since_registration <= 30 THEN 'recent'
            WHEN days_since_registration <= 90 THEN 'established' ELSE 'mature' END AS lifecycle_stage,
       {_TIER} AS value_tier,
       CAST({TODAY} - date AS INTEGER) AS days_since_last_event,
       CAST({TODAY} - date AS INTEGER) AS days_since_last_purchase,
       events_last_7_days, events_last_30_days, purchases_last_7_days, purchases_last_30_days,
       sessions_last_7_days, sessions_last_30_days, lifetime_events, lifetime_purchases,
       revenue_last_7_days, revenue_last_30_days, lifetime_revenue,
       avg_revenue_last_7_days, avg_revenue_last_30_days,
       {_safe('revenue_last_7_days', 'events_last_7_days', 4, '0.0')} AS revenue_per_event_7d,
       {_safe('revenue_last_30_days', 'events_last_30_days', 4, '0.0')} AS revenue_per_event_30d,
       {_safe('revenue_last_7_days', 'purchases_last_7_days', 2, '0.0')} AS avg_purchase_amount_7d,
       {_safe('revenue_last_30_days', 'purchases_last_30_days', 2, '0.0')} AS avg_purchase_amount_30d,
       {_SCORES},
       page_views_last_30_days, signups_last_30_days, logins_last_30_days,
       max_products_viewed_30d, max_categories_viewed_30d,
       web_events_last_30_days, mobile_events_last_30_days,
       {_safe('2 * least(web_events_last_30_days, mobile_events_last_30_days)', '(web_events_last_30_days + mobile_events_last_30_days)', 3, '0.0')} AS platform_diversity_score,
       activity_consistency_30d,
       {_safe('30', 'purchases_last_30_days', 1, '999.0')} AS avg_days_between_purchases_30d,
       events_last_7_days > 0 AS is_active_7d, events_last_30_days > 0 AS is_active_30d,
       purchases_last_7_days > 0 AS purchased_7d, purchases_last_30_days > 0 AS purchased_30d
FROM rolled"""

CTES["ua"] = f"""
SELECT user_id, date, country, user_tier, days_since_registration,
       is_active_today, events_last_7_days > 0 AS is_active_this_week, events_last_30_days > 0 AS is_active_this_month,
       total_events, unique_event_types, events_last_7_days, events_last_30_days, lifetime_events,
       total_purchases, total_revenue, avg_purchase_amount, purchases_last_7_days, purchases_last_30_days,
       lifetime_purchases, lifetime_revenue,
       {_safe('lifetime_revenue', 'lifetime_purchases', 2, '0.0')} AS avg_lifetime_purchase_amount,
       total_sessions, avg_events_per_session, sessions_last_7_days, sessions_last_30_days,
       {_SCORES},
       CASE WHEN events_last_7_days * 10 > events_last_30_days * 4 THEN 'increasing'
            WHEN events_last_7_days * 10 < events_last_30_days THEN 'decreasing' ELSE 'stable' END AS engagement_trend,
       CASE sign(web_events - mobile_events) WHEN 1 THEN 'web' WHEN -1 THEN 'mobile'
            ELSE CASE WHEN web_events > 0 THEN 'balanced' ELSE 'unknown' END END AS preferred_platform,
       CASE WHEN page_views * 10 > total_events * 7 THEN 'browser' WHEN total_purchases > 0 THEN 'buyer'
            WHEN signups > 0 THEN 'new_user' ELSE 'explorer' END AS user_behavior_type,
       {_TIER} AS value_segment,
       CASE WHEN events_last_7_days > 0 THEN 'active' WHEN events_last_30_days > 0 THEN 'at_risk'
            WHEN lifetime_events > 0 THEN 'churned' ELSE 'inactive' END AS churn_risk_status,
       web_events, mobile_events, page_views, signups, logins, unique_products_viewed, unique_categories_viewed
FROM rolled"""

CTES["bm"] = """
SELECT day.date, daily_active_users, new_users, new_users_this_week, new_users_this_month,
       wau.n AS weekly_active_users, mau.n AS monthly_active_users,
       daily_revenue, daily_purchases, avg_purchase_amount,
       avg(daily_revenue) OVER (ORDER BY day.date ROWS 6 PRECEDING) AS weekly_avg_revenue,
       avg(daily_revenue) OVER (ORDER BY day.date ROWS 29 PRECEDING) AS monthly_avg_revenue,
       day.total_events, avg_events_per_user, avg_events_per_user AS avg_events_per_active_user,
       users_us, users_ca, users_uk, users_other,
       round(100.0::DOUBLE * users_us / daily_active_users, 2) AS pct_users_us,
       round(100.0::DOUBLE * users_ca / daily_active_users, 2) AS pct_users_ca,
       round(100.0::DOUBLE * users_uk / daily_active_users, 2) AS pct_users_uk,
       premium_users, basic_users,
       round(100.0::DOUBLE * premium_users / daily_active_users, 2) AS pct_premium_users,
       round(100.0::DOUBLE * basic_users / daily_active_users, 2) AS pct_basic_users,
       revenue_premium, revenue_basic,
       round(100.0::DOUBLE * revenue_premium / nullif(daily_revenue, 0), 2) AS pct_revenue_premium,
       round(100.0::DOUBLE * revenue_basic / nullif(daily_revenue, 0), 2) AS pct_revenue_basic,
       round(100.0::DOUBLE * daily_purchases / daily_active_users, 2) AS purchase_conversion_rate,
       round(100.0::DOUBLE * new_users / daily_active_users, 2) AS new_user_rate,
       round(daily_revenue / daily_active_users, 2) AS revenue_per_user,
       round(revenue_premium / nullif(premium_users, 0), 2) AS revenue_per_premium_user,
       round(revenue_basic / nullif(basic_users, 0), 2) AS revenue_per_basic_user,
       lag(daily_active_users) OVER byday AS prev_day_dau,
       lag(daily_revenue) OVER byday AS prev_day_revenue,
       lag(daily_purchases) OVER byday AS prev_day_purchases,
       round(100.0::DOUBLE * (daily_active_users - prev_day_dau) / nullif(prev_day_dau, 0), 2) AS dau_growth_rate,
       round(100.0::DOUBLE * (daily_revenue - prev_day_revenue) / nullif(prev_day_revenue, 0), 2) AS revenue_growth_rate
FROM (SELECT date,
             count(DISTINCT user_id) AS daily_active_users,
             count(DISTINCT user_id) FILTER (days_since_registration = 0) AS new_users,
             count(DISTINCT user_id) FILTER (days_since_registration BETWEEN 1 AND 7) AS new_users_this_week,
             count(DISTINCT user_id) FILTER (days_since_registration BETWEEN 1 AND 30) AS new_users_this_month,
             sum(total_revenue) AS daily_revenue,
             CAST(sum(total_purchases) AS BIGINT) AS daily_purchases,
             avg(total_revenue / total_purchases) FILTER (total_purchases > 0) AS avg_purchase_amount,
             CAST(sum(total_events) AS BIGINT) AS total_events,
             avg(total_events) AS avg_events_per_user,
             count(DISTINCT user_id) FILTER (country = 'US') AS users_us,
             count(DISTINCT user_id) FILTER (country = 'CA') AS users_ca,
             count(DISTINCT user_id) FILTER (country = 'UK') AS users_uk,
             count(DISTINCT user_id) FILTER (country NOT IN ('US', 'CA', 'UK')) AS users_other,
             count(DISTINCT user_id) FILTER (user_tier = 'premium') AS premium_users,
             count(DISTINCT user_id) FILTER (user_tier = 'basic') AS basic_users,
             coalesce(sum(total_revenue) FILTER (user_tier = 'premium'), 0.0::DOUBLE) AS revenue_premium,
             coalesce(sum(total_revenue) FILTER (user_tier = 'basic'), 0.0::DOUBLE) AS revenue_basic
      FROM um GROUP BY date) day
JOIN (SELECT date_trunc('week', date + 1) AS w, count(DISTINCT user_id) AS n FROM um GROUP BY 1) wau
  ON wau.w = date_trunc('week', day.date + 1)
JOIN (SELECT date_trunc('month', date) AS m, count(DISTINCT user_id) AS n FROM um GROUP BY 1) mau
  ON mau.m = date_trunc('month', day.date)
WINDOW byday AS (ORDER BY day.date)"""

CTES["ses"] = """
SELECT session_id, arg_min(user_id, (event_timestamp, event_id)) AS user_id,
       min(event_timestamp) AS started_at, max(event_timestamp) AS ended_at,
       CAST(floor(epoch_us(max(event_timestamp) - min(event_timestamp)) / 1000000) AS BIGINT) AS duration_seconds,
       count(*) FILTER (event_type = 'page_view') AS page_views, count(*) AS events_count,
       arg_min(device_type, (event_timestamp, event_id)) AS device_type,
       (arg_min({'p': platform}, (event_timestamp, event_id))).p AS platform,
       CAST(NULL AS VARCHAR) AS country, '{}' AS metadata,
       CAST(min(event_timestamp) AS DATE) AS session_date
FROM raw_events GROUP BY session_id"""

_NEEDS = {
    "ev": ["raw_events"], "good": ["ev"], "us": ["raw_users"], "um": ["good", "us"], "em": ["good"],
    "rolled": ["um"], "mf": ["rolled"], "ua": ["rolled"], "bm": ["um"], "ses": ["raw_events"],
}


def _order(names: list[str], seen: list[str]) -> list[str]:
    for n in names:
        _order(_NEEDS.get(n, []), seen)
        if n not in seen:
            seen.append(n)
    return seen


def exact(sql: str) -> str:
    """Make every round() decimal: to 9 places first, then half away from zero.

    On binary doubles 80.475 has no defined side; both engines agree on the decimal.
    """
    out, at = "", 0
    while (start := sql.find("round(", at)) >= 0:
        depth, end = 1, start + len("round(")
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[end], 0)
            end += 1
        value, digits = sql[start + len("round("):end - 1].rsplit(",", 1)
        out += sql[at:start] + f"CAST(round(CAST({exact(value)} AS DECIMAL(38, 9)),{digits}) AS DOUBLE)"
        at = end
    return out + sql[at:]


def statement(body: str, *blocks: str, **local: str) -> str:
    parts = [f"{n} AS ({CTES[n]})" for n in _order(list(blocks), [])]
    parts += [f"{n} AS ({q})" for n, q in local.items()]
    return exact(f"WITH {', '.join(parts)}\n{body}")


def over(raw: str, body: str, *blocks: str) -> str:
    """Like ``statement``, with the raw events replaced by a query over them (``given``)."""
    parts = [f"given AS ({CTES['raw_events']})", f"raw_events AS ({raw})"]
    parts += [f"{n} AS ({CTES[n]})" for n in _order(list(blocks), []) if n != "raw_events"]
    return exact(f"WITH {', '.join(parts)}\n{body}")


_TIMED = "event_id::BIGINT % 101 <> 7"
GAPS = f"""SELECT * REPLACE (CASE WHEN {_TIMED} THEN event_timestamp END AS event_timestamp, CASE WHEN {_TIMED} THEN event_date END AS event_date,
  CASE WHEN event_id::BIGINT % 107 = 11 THEN '' WHEN event_id::BIGINT % 103 <> 9 THEN event_id END AS event_id) FROM given"""


def rounded(source: str, *doubles: str, without: str = "") -> str:
    fixes = ", ".join(f"round({d}, 6) AS {d}" for d in doubles)
    drop = f" EXCLUDE ({without})" if without else ""
    return f"SELECT *{drop}" + (f" REPLACE ({fixes})" if fixes else "") + f" FROM {source}"


_DAY = f"{TODAY} - 1"
O: dict[str, str] = {}

# --- sources, sinks, maintenance
for _name in ("src_events", "write_clustered", "csv_roundtrip", "json_roundtrip"):
    O[_name] = statement("SELECT * FROM raw_events", "raw_events")
O["append_day"] = over(GAPS, "SELECT * FROM raw_events")
O["src_users"] = O["load_replace"] = statement("SELECT * FROM raw_users", "raw_users")
O["src_sessions"] = O["sessions_from_events"] = statement("SELECT * FROM ses", "ses")
_MOVED = """event_timestamp + INTERVAL 1 DAY AS event_timestamp, event_date + 1 AS event_date"""
O["upsert_events"] = over(GAPS, f"""SELECT * FROM raw_events WHERE coalesce(event_date < DATE '2024-01-25', TRUE) OR coalesce(event_id, '') = ''
UNION ALL
SELECT * REPLACE ({_MOVED}, '2.0.0' AS app_version) FROM raw_events WHERE event_date >= DATE '2024-01-25'
UNION ALL
SELECT * REPLACE ({_MOVED}, '1.9.0' AS app_version, created_at - INTERVAL 1 HOUR AS created_at)
FROM raw_events WHERE event_date >= DATE '2024-01-25' AND coalesce(event_id, '') = ''""")
O["schema_sync"] = statement(
    "SELECT * EXCLUDE (timezone), CAST(NULL AS VARCHAR) AS locale FROM raw_users", "raw_users")
O["retention"] = over(GAPS, f"SELECT * FROM raw_events WHERE coalesce({TODAY} - event_date <= 14, TRUE)")
_DAILY_RAW = f"""SELECT * EXCLUDE (moves) REPLACE (CASE WHEN moves THEN event_timestamp + INTERVAL 4 DAY ELSE event_timestamp END AS event_timestamp,
  CASE WHEN moves THEN event_date + 4 ELSE event_date END AS event_date)
FROM (SELECT *, coalesce(event_date = DATE '2024-01-22' AND TRY_CAST(event_id AS BIGINT) % 7 = 0, FALSE) AS moves FROM ({GAPS}))"""


def _per_day(table: str, cte: str, day: str, measure: str) -> str:
    return f"SELECT '{table}' AS table_name, CAST({day} AS VARCHAR) AS day, count(*) AS n_rows, round(CAST({measure} AS DOUBLE), 4) AS measure FROM {cte} GROUP BY 2"


O["daily_run"] = over(_DAILY_RAW, " UNION ALL ".join([
    _per_day("stg_events", "ev", "event_date", "count(*) FILTER (is_valid)"),
    _per_day("user_metrics", "um", "date", "sum(total_revenue)"),
    _per_day("event_metrics", "em", "date", "sum(total_events * unique_users + coalesce(prev_day_events, 0))"),
    _per_day("ml_features", "mf", "feature_date", "sum(events_last_30_days)"),
    _per_day("user_analytics", "ua", "date", "sum(lifetime_events)"),
    _per_day("business_metrics", "bm", "date", "sum(monthly_active_users)"),
]), "ev", "um", "em", "mf", "ua", "bm")
O["pruned_scan"] = statement(
    "SELECT * FROM raw_events WHERE event_date BETWEEN DATE '2024-01-10' AND DATE '2024-01-12'", "raw_events")
O["incr_filter_events"] = statement(
    """SELECT event_id, event_date FROM raw_events
WHERE event_date >= (SELECT max(event_date) FROM raw_events WHERE event_date <= DATE '2024-01-25')""", "raw_events")
O["incr_filter_users"] = statement(
    """SELECT user_id, user_date, updated_at FROM raw_users, held
WHERE user_date >= held.d OR updated_at > held.u - INTERVAL 5 DAY""", "raw_users",
    held="SELECT max(user_date) AS d, max(updated_at) AS u FROM raw_users WHERE user_date <= DATE '2024-01-10'")

# --- datasets
O["stg_events"] = O["stream_staging"] = statement(rounded("ev", "amount"), "ev")
O["stg_users"] = statement("SELECT * FROM us", "us")
O["stg_sessions"] = statement(
    """SELECT *, coalesce(session_id, '') <> '' AND coalesce(user_id, '') <> '' AND started_at IS NOT NULL
         AND coalesce(ended_at >= started_at, TRUE) AS is_valid,
       concat_ws(',', CASE WHEN coalesce(session_id, '') = '' THEN 'missing_session_id' END,
                      CASE WHEN coalesce(user_id, '') = '' THEN 'missing_user_id' END,
                      CASE WHEN started_at IS NULL THEN 'missing_started_at' END,
                      CASE WHEN ended_at < started_at THEN 'negative_duration' END) AS validation_errors
FROM ses""", "ses")
O["user_metrics"] = statement(
    rounded("um", "total_revenue", "avg_purchase_amount", "avg_events_per_session", "revenue_usd", "revenue_eur",
            "revenue_per_event", "events_per_session"), "um")
O["event_metrics"] = statement(
    rounded("em", "total_revenue", "avg_revenue_per_event", "min_revenue_per_event", "max_revenue_per_event",
            "revenue_usd", "revenue_eur", "revenue_gbp", "prev_day_revenue"), "em")
O["ml_features"] = statement(
    rounded("mf", "revenue_last_7_days", "revenue_last_30_days", "lifetime_revenue", "avg_revenue_last_7_days",
            "avg_revenue_last_30_days", "activity_consistency_30d"), "mf")
O["user_analytics"] = statement(
    rounded("ua", "total_revenue", "avg_purchase_amount", "lifetime_revenue"), "ua")
O["business_metrics"] = statement(
    rounded("bm", "daily_revenue", "avg_purchase_amount", "weekly_avg_revenue", "monthly_avg_revenue",
            "avg_events_per_user", "avg_events_per_active_user", "revenue_premium", "revenue_basic",
            "prev_day_revenue"), "bm")
O["ml_training"] = statement(
    f"""SELECT f.user_id, f.feature_date,
       CASE WHEN f.feature_date + 7 <= (SELECT max(date) FROM um) THEN
         EXISTS (FROM um p WHERE p.user_id = f.user_id AND p.total_purchases > 0
                 AND p.date > f.feature_date AND p.date <= f.feature_date + 7) END AS will_purchase_next_7_days,
       CASE WHEN f.feature_date + 30 <= (SELECT max(date) FROM um) THEN
         NOT EXISTS (FROM um p WHERE p.user_id = f.user_id AND p.date > f.feature_date
                     AND p.date <= f.feature_date + 30) END AS will_churn_next_30_days,
       f.days_since_last_event,
       CAST({TODAY} - (SELECT max(p.date) FROM um p WHERE p.user_id = f.user_id AND p.total_purchases > 0
                       AND p.date <= f.feature_date) AS INTEGER) AS days_since_last_purchase,
       f.days_since_registration,
       f.events_last_7_days AS events_7d, f.events_last_30_days AS events_30d,
       f.purchases_last_7_days AS purchases_7d, f.purchases_last_30_days AS purchases_30d,
       round(f.revenue_last_7_days, 6) AS revenue_7d, round(f.revenue_last_30_days, 6) AS revenue_30d,
       round(f.lifetime_revenue, 6) AS lifetime_revenue, f.avg_purchase_amount_30d AS avg_purchase_amount,
       f.sessions_last_7_days AS sessions_7d, f.sessions_last_30_days AS sessions_30d,
       round((SELECT avg(s.seconds) FROM lasted s WHERE s.user_id = f.user_id AND s.day <= f.feature_date), 6) AS avg_session_duration,
       f.platform_diversity_score AS platform_diversity
FROM mf f""", "mf",
    lasted="""SELECT session_id, arg_min(user_id, (event_timestamp, event_id)) AS user_id,
              CAST(min(event_timestamp) AS DATE) AS day,
              floor(epoch_us(max(event_timestamp) - min(event_timestamp)) / 1000000) AS seconds
              FROM good WHERE session_id IS NOT NULL GROUP BY 1""")
O["user_rolling_calendar"] = statement(
    """SELECT a.user_id, a.date,
       CAST(sum(b.total_events) FILTER (b.date > a.date - 7) AS BIGINT) AS events_last_7_days,
       CAST(sum(b.total_events) AS BIGINT) AS events_last_30_days,
       CAST(sum(b.total_purchases) FILTER (b.date > a.date - 7) AS BIGINT) AS purchases_last_7_days,
       CAST(sum(b.total_sessions) AS BIGINT) AS sessions_last_30_days,
       least(100, 2 * events_last_7_days + 10 * purchases_last_7_days
             + 3 * CAST(sum(b.total_sessions) FILTER (b.date > a.date - 7) AS BIGINT)) AS engagement_score_7d,
       CASE WHEN events_last_7_days * 10 > events_last_30_days * 4 THEN 'increasing'
            WHEN events_last_7_days * 10 < events_last_30_days THEN 'decreasing' ELSE 'stable' END AS engagement_trend
FROM um a JOIN um b ON b.user_id = a.user_id AND b.date > a.date - 30 AND b.date <= a.date
GROUP BY a.user_id, a.date""", "um")

# --- views
O["recent_events"] = statement(
    f"""SELECT event_id, user_id, event_type, event_timestamp, session_id, device_type, platform,
       round(amount, 6) AS amount, currency, product_id, category
FROM good WHERE event_date >= {TODAY} - 30""", "good")
O["active_users"] = statement(
    f"""SELECT u.user_id, u.email, u.created_at, u.country, u.subscription_tier, max(e.event_timestamp) AS last_activity
FROM us u JOIN good e USING (user_id) WHERE u.is_valid AND e.event_date >= {TODAY} - 30 GROUP BY ALL""", "us", "good")
_DAILY = f"""SELECT user_id, event_date, count(*) AS total_events, count(DISTINCT event_type) AS unique_event_types,
       count(DISTINCT session_id) AS unique_sessions,
       count(*) FILTER (event_type = 'purchase') AS purchase_events,
       count(*) FILTER (event_type = 'page_view') AS page_view_events,
       count(*) FILTER (event_type = 'signup') AS signup_events,
       round(coalesce(sum(amount) FILTER ({_PAID}), 0.0::DOUBLE), 6) AS total_revenue,
       count(*) FILTER (platform = 'web') AS web_events, count(*) FILTER (platform = 'mobile') AS mobile_events
FROM good GROUP BY user_id, event_date"""
O["daily_user_events"] = statement(_DAILY, "good")
O["user_daily_lookup"] = statement(
    f"""SELECT user_id, event_date, total_events, unique_event_types, total_revenue FROM daily
WHERE user_id = '1' AND event_date >= {TODAY} - 30""", "good", daily=_DAILY)
_SUMMARY = """SELECT user_id, count(DISTINCT event_date) AS active_days, min(event_date) AS first_activity_date,
       max(event_date) AS last_activity_date,
       CAST(max(event_date) - min(event_date) + 1 AS INTEGER) AS total_days_in_range,
       round(CAST(count(DISTINCT event_date) AS DOUBLE) / (max(event_date) - min(event_date) + 1), 3) AS activity_rate,
       CASE WHEN active_days < 5 THEN 'rarely_active' WHEN active_days < 10 THEN 'occasionally_active'
            WHEN active_days < 20 THEN 'moderately_active' ELSE 'highly_active' END AS activity_category
FROM good GROUP BY user_id"""
O["user_activity_summary"] = statement(_SUMMARY, "good")
O["user_active_days_lookup"] = statement(
    """SELECT user_id, active_days, total_days_in_range, activity_rate, activity_category FROM summary
WHERE user_id IN ('1', '2', '3') AND first_activity_date >= DATE '2024-01-01' AND last_activity_date <= DATE '2024-01-31'""",
    "good", summary=_SUMMARY)
O["active_days_in_range"] = statement(
    """SELECT user_id, count(DISTINCT event_date) AS active_days FROM good
WHERE event_date BETWEEN DATE '2024-01-08' AND DATE '2024-01-21' GROUP BY user_id""", "good")
O["user_event_preferences"] = statement(
    """SELECT user_id, CAST(pos AS INTEGER) AS rank, event_type, event_count,
       round(100.0::DOUBLE * event_count / sum(event_count) OVER (PARTITION BY user_id), 2) AS percentage
FROM ranked WHERE pos <= 3""", "good",
    ranked="""SELECT user_id, event_type, count(*) AS event_count,
              row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, event_type) AS pos
              FROM good GROUP BY user_id, event_type""")
_DAU = """SELECT event_date, count(DISTINCT user_id) AS daily_active_users,
       count(DISTINCT session_id) AS daily_active_sessions, count(*) AS total_events,
       round(CAST(count(*) AS DOUBLE) / count(DISTINCT user_id), 2) AS avg_events_per_user
FROM good GROUP BY event_date"""
_REVENUE = f"""SELECT event_date, count(DISTINCT user_id) AS purchasing_users, count(*) AS total_purchases,
       round(sum(amount), 6) AS total_revenue, round(avg(amount), 6) AS avg_purchase_amount,
       min(amount) AS min_purchase_amount, max(amount) AS max_purchase_amount
FROM good WHERE {_PAID} GROUP BY event_date"""
O["daily_active_users"] = statement(_DAU, "good")
O["revenue_metrics"] = statement(_REVENUE, "good")
O["registered_views"] = statement(
    "SELECT event_date, daily_active_users, purchasing_users, total_revenue FROM dau LEFT JOIN rev USING (event_date)",
    "good", dau=_DAU, rev=_REVENUE)
O["user_cohorts"] = statement(
    """SELECT CAST(c AS DATE) AS cohort_month, count(DISTINCT user_id) AS cohort_size,
       count(DISTINCT user_id) FILTER (m = c) AS month_0_retention,
       count(DISTINCT user_id) FILTER (m = c + INTERVAL 1 MONTH) AS month_1_retention,
       count(DISTINCT user_id) FILTER (m = c + INTERVAL 2 MONTH) AS month_2_retention,
       count(DISTINCT user_id) FILTER (m = c + INTERVAL 3 MONTH) AS month_3_retention
FROM (SELECT user_id, date_trunc('month', min(event_date)) AS c FROM good GROUP BY 1)
LEFT JOIN (SELECT DISTINCT user_id, date_trunc('month', event_date) AS m FROM good) USING (user_id) GROUP BY c""", "good")
O["ml_user_features"] = statement(
    f"""SELECT user_id, event_date, CAST({TODAY} - event_date AS INTEGER) AS days_since_last_event,
       events_today, unique_event_types_today, round(revenue_today, 6) AS revenue_today,
       events_last_7_days, round(r7, 6) AS revenue_last_7_days, events_last_30_days, round(r30, 6) AS revenue_last_30_days,
       round(r7 / events_last_7_days, 2) AS avg_revenue_per_event_7d,
       round(r30 / events_last_30_days, 2) AS avg_revenue_per_event_30d
FROM (SELECT *, CAST(sum(events_today) OVER w7 AS BIGINT) AS events_last_7_days, sum(revenue_today) OVER w7 AS r7,
             CAST(sum(events_today) OVER w30 AS BIGINT) AS events_last_30_days, sum(revenue_today) OVER w30 AS r30
      FROM (SELECT user_id, event_date, count(*) AS events_today, count(DISTINCT event_type) AS unique_event_types_today,
                   coalesce(sum(amount) FILTER ({_PAID}), 0.0::DOUBLE) AS revenue_today
            FROM good GROUP BY ALL)
      WINDOW w7 AS (PARTITION BY user_id ORDER BY event_date ROWS 6 PRECEDING),
             w30 AS (PARTITION BY user_id ORDER BY event_date ROWS 29 PRECEDING))""", "good")
O["pruned_purchases"] = statement(
    f"""SELECT user_id, event_type, count(*) AS event_count, round(sum(coalesce(amount, 0)), 6) AS total_revenue
FROM good WHERE event_date >= {TODAY} - 7 AND user_id IN ('1', '2', '3') AND event_type = 'purchase' GROUP BY ALL""", "good")
O["data_quality_summary"] = statement(
    """SELECT 'events' AS table_name, count(*) AS total_rows, count(*) FILTER (is_valid) AS valid_rows,
       count(*) FILTER (NOT is_valid) AS invalid_rows,
       round(100.0::DOUBLE * count(*) FILTER (is_valid) / nullif(count(*), 0), 2) AS validity_percentage,
       count(DISTINCT user_id) AS unique_users, count(DISTINCT event_type) AS unique_event_types,
       min(event_date) AS earliest_date, max(event_date) AS latest_date FROM ev
UNION ALL
SELECT 'users', count(*), count(*) FILTER (is_valid), count(*) FILTER (NOT is_valid),
       round(100.0::DOUBLE * count(*) FILTER (is_valid) / nullif(count(*), 0), 2),
       count(DISTINCT user_id), NULL, min(user_date), max(user_date) FROM us""", "ev", "us")
O["trial_daily_events"] = statement(
    """SELECT CAST(event_timestamp AS DATE) AS date, count(*) AS total_events, count(DISTINCT user_id) AS unique_users
FROM raw_events GROUP BY 1 ORDER BY 1 DESC LIMIT 10""", "raw_events")
O["trial_user_activity"] = statement(
    """SELECT user_id, count(*) AS total_events, count(DISTINCT event_type) AS unique_event_types
FROM raw_events GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""", "raw_events")
O["trial_event_types"] = statement(
    'SELECT event_type, count(*) AS "count", count(DISTINCT user_id) AS unique_users FROM raw_events GROUP BY 1', "raw_events")
O["kpi_last_30d"] = statement(
    f"""SELECT date, daily_active_users, round(daily_revenue, 6) AS daily_revenue FROM bm WHERE date >= {TODAY} - 30""", "bm")
O["engagement_report"] = statement(
    f"""SELECT user_id, engagement_score_7d, engagement_score_30d, preferred_platform, value_segment
FROM ua WHERE date = {_DAY}""", "ua")
O["feature_read"] = statement(
    f"""SELECT user_id, feature_date, events_last_7_days, events_last_30_days,
       round(revenue_last_7_days, 6) AS revenue_last_7_days, round(revenue_last_30_days, 6) AS revenue_last_30_days,
       engagement_score_7d, engagement_score_30d, platform_diversity_score
FROM mf WHERE feature_date = {_DAY}""", "mf")
O["dag_quality_check"] = statement(
    f"""SELECT 'events' AS table_name, count(*) AS total_rows, count(*) FILTER (is_valid) AS valid_rows,
       round(100.0::DOUBLE * count(*) FILTER (is_valid) / nullif(count(*), 0), 2) AS validity_percentage
FROM ev WHERE event_date = {_DAY}
UNION ALL
SELECT 'users', count(*), count(*) FILTER (is_valid),
       round(100.0::DOUBLE * count(*) FILTER (is_valid) / nullif(count(*), 0), 2)
FROM us WHERE user_date = {_DAY}""", "ev", "us")
O["user_type_daily"] = statement(
    """SELECT user_id, event_type, event_date, count(*) AS event_count, round(sum(amount), 6) AS total_amount
FROM ev GROUP BY ALL""", "ev")

_STEPS = ("page_view", "click", "signup", "purchase")


def _funnel(key: str) -> tuple[str, dict[str, str]]:
    """One self-join per step; key is what a funnel run belongs to besides the user."""
    local = {"t1": f"SELECT user_id, {key} AS k, min(event_timestamp) AS t FROM good WHERE event_type = '{_STEPS[0]}' GROUP BY ALL"}
    for i, s in enumerate(_STEPS[1:], 2):
        local[f"t{i}"] = (
            f"SELECT g.user_id, p.k, min(g.event_timestamp) AS t FROM good g JOIN t{i - 1} p ON p.user_id = g.user_id "
            f"AND {key.replace('event_date', 'g.event_date')} = p.k AND g.event_timestamp >= p.t WHERE g.event_type = '{s}' GROUP BY ALL"
        )
    days = f"(SELECT DISTINCT {key} AS k FROM good) d"
    rows = []
    for i, s in enumerate(_STEPS, 1):
        n, before, first = (f"(SELECT count(*) FROM t{j} WHERE t{j}.k = d.k)" for j in (i, max(i - 1, 1), 1))
        rows.append(
            f"SELECT d.k, {i} AS step, '{s}' AS event_type, {n} AS users, "
            f"round(100.0::DOUBLE * {n} / nullif({before}, 0), 2) AS step_rate, "
            f"round(100.0::DOUBLE * {n} / nullif({first}, 0), 2) AS overall_rate FROM {days}"
        )
    return " UNION ALL ".join(rows), local


_body, _local = _funnel("0")
O["conversion_funnel"] = statement(f"SELECT * EXCLUDE (k) FROM ({_body})", "good", **_local)
_body, _local = _funnel("event_date")
O["conversion_funnel_daily"] = statement(f"SELECT * RENAME (k AS event_date) FROM ({_body})", "good", **_local)

# --- quality
O["invalid_types"] = f"""
SELECT CAST(event_id AS VARCHAR) AS event_id, event_type FROM events WHERE event_type NOT IN ({ACCEPTED})"""
O["dq_unique_combination"] = statement(
    "SELECT session_id, event_type, count(*) AS n_rows FROM ev GROUP BY ALL HAVING count(*) > 1", "ev")
O["dq_not_null_proportion"] = statement(
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, round(CAST(count({c}) AS DOUBLE) / count(*), 6) AS proportion, "
        f"CAST(count({c}) AS DOUBLE) / count(*) >= 0.98 AS passed FROM ev"
        for c in ("event_id", "session_id", "platform", "amount")), "ev")
O["dq_accepted_values"] = statement(
    """SELECT 'platform' AS column_name, platform AS value, count(*) AS n_rows FROM raw_events
WHERE platform NOT IN ('web', 'mobile', 'desktop', 'tablet') GROUP BY ALL""", "raw_events")
O["dq_unique_not_null"] = statement(
    """SELECT 'email' AS column_name, 'unique' AS test_name, count(*) AS failed_rows
FROM (SELECT email FROM raw_users WHERE email IS NOT NULL GROUP BY 1 HAVING count(*) > 1)
UNION ALL SELECT 'email', 'not_null', count(*) FROM raw_users WHERE email IS NULL""", "raw_users")


def _check(model: str, test: str, cte: str, bad: str) -> str:
    return f"SELECT '{model}' AS model_name, '{test}' AS test_name, count(*) FILTER ({bad}) AS failed_rows FROM {cte}"


O["quality_checks"] = statement(
    " UNION ALL ".join([
        _check("stg_events", "null_event_ids", "ev", "coalesce(event_id, '') = ''"),
        _check("stg_events", "null_user_ids", "ev", "coalesce(user_id, '') = ''"),
        _check("stg_events", "null_event_types", "ev", "coalesce(event_type, '') = ''"),
        _check("stg_events", "stale_data", "ev", f"event_date < {TODAY} - 7"),
        _check("stg_events", "invalid_event_types", "ev", f"event_type NOT IN ({ACCEPTED})"),
        _check("stg_events", "negative_amounts", "ev", "amount < 0"),
        _check("stg_events", "future_event_timestamps", "ev", f"event_timestamp > {AS_OF}"),
        _check("stg_users", "null_user_ids", "us", "coalesce(user_id, '') = ''"),
        _check("stg_users", "null_emails", "us", "coalesce(email, '') = ''"),
        _check("stg_users", "invalid_emails", "us", f"NOT regexp_matches(email, '{EMAIL}')"),
        _check("stg_users", "future_created_at", "us", f"created_at > {AS_OF}"),
        _check("user_metrics", "negative_events", "um", "total_events < 0"),
        _check("user_metrics", "negative_revenue", "um", "total_revenue < 0"),
        _check("user_metrics", "inconsistent_purchases", "um", "total_purchases > 0 AND total_revenue = 0"),
        _check("business_metrics", "missing_dau", "bm", "coalesce(daily_active_users, -1) < 0"),
        _check("ml_features", "invalid_engagement_scores", "mf",
               "engagement_score_7d NOT BETWEEN 0 AND 100 OR engagement_score_30d NOT BETWEEN 0 AND 100"),
        "SELECT 'stg_events', 'duplicate_event_ids', count(*) - count(DISTINCT event_id) FROM ev",
        "SELECT 'stg_users', 'duplicate_user_ids', count(*) - count(DISTINCT user_id) FROM us",
    ]), "ev", "us", "um", "bm", "mf")


def _fresh(table: str, cte: str, column: str) -> str:
    hours = f"CAST(floor(epoch({AS_OF} - max(CAST({column} AS TIMESTAMP))) / 3600) AS BIGINT)"
    return (
        f"SELECT '{table}' AS table_name, max(CAST({column} AS TIMESTAMP)) AS latest, {hours} AS hours_behind, "
        f"CASE WHEN {hours} > 4 THEN 'warning' ELSE 'success' END AS status FROM {cte}"
    )


_FRESH = " UNION ALL ".join([
    _fresh("stg_events", "ev", "event_timestamp"), _fresh("stg_users", "us", "created_at"),
    _fresh("user_metrics", "um", "date"), _fresh("event_metrics", "em", "date"), _fresh("business_metrics", "bm", "date"),
])
O["dq_freshness"] = statement(_FRESH, "ev", "us", "um", "em", "bm")


def _nulls(users_day: str) -> str:
    parts = [
        f"SELECT '{t}' AS table_name, '{c}' AS column_name, count(*) AS total_rows, count(*) FILTER ({c} IS NULL) AS null_count, "
        f"round(100.0::DOUBLE * count(*) FILTER ({c} IS NULL) / nullif(count(*), 0), 2) AS null_percentage FROM {cte} WHERE {day} = {_DAY}"
        for t, cte, day, cols in (
            ("stg_events", "ev", "event_date", ("user_id", "event_id", "event_type", "event_timestamp")),
            ("stg_users", "us", users_day, ("user_id",)),
        )
        for c in cols
    ]
    return " UNION ALL ".join(parts)


O["dq_null_profile"] = statement(_nulls("user_date + 2"), "ev", "us")
O["dq_duplicates"] = statement(
    """SELECT 'events' AS table_name, CAST(sum(n) AS BIGINT) AS total_rows, count(*) AS unique_rows,
       CAST(sum(n) - count(*) AS BIGINT) AS duplicate_count
FROM (SELECT twice.*, count(*) AS n FROM twice GROUP BY ALL)""", "raw_events",
    twice=f"""SELECT * FROM raw_events WHERE event_date = {_DAY}
              UNION ALL SELECT * FROM raw_events WHERE event_date = {_DAY} AND event_type = 'purchase'""")
_RULES = f"""SELECT 'negative_revenue' AS rule, count(*) FILTER (total_revenue < 0) AS violations FROM um WHERE date = {_DAY}
UNION ALL SELECT 'future_timestamp', count(*) FILTER (event_timestamp > {AS_OF}) FROM ev WHERE event_date = {_DAY}
UNION ALL SELECT 'invalid_event_types', count(*) FILTER (event_type NOT IN ({ACCEPTED})) FROM ev WHERE event_date = {_DAY}"""
O["dq_business_rules"] = statement(_RULES, "ev", "um")
_REPORT = f"""SELECT table_name || '_freshness' AS check_name, 'hours_behind' AS item, CAST(hours_behind AS DOUBLE) AS value, status FROM fresh
UNION ALL SELECT table_name || '_quality', 'null_' || column_name, CAST(null_count AS DOUBLE), 'success' FROM nulls
UNION ALL SELECT 'stg_events_quality', 'duplicate_rows', CAST(count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM ev WHERE event_date = {_DAY})) AS DOUBLE), 'success' FROM ev WHERE event_date = {_DAY}
UNION ALL SELECT 'stg_users_quality', 'duplicate_rows', CAST(count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM us WHERE user_date = {_DAY})) AS DOUBLE), 'success' FROM us WHERE user_date = {_DAY}
UNION ALL SELECT 'business_rules', rule, CAST(violations AS DOUBLE), CASE WHEN violations > 0 THEN 'warning' ELSE 'success' END FROM rules"""
_REPORT_PARTS = dict(fresh=_FRESH, nulls=_nulls("user_date"), rules=_RULES)
O["quality_report"] = statement(_REPORT, "ev", "us", "um", "em", "bm", **_REPORT_PARTS)
O["quality_alerts"] = statement(
    f"SELECT * FROM ({_REPORT}) WHERE status <> 'success'", "ev", "us", "um", "em", "bm", **_REPORT_PARTS)
O["dq_layer_sla"] = statement(
    " UNION ALL ".join(
        f"SELECT '{layer}' AS layer, '{t}' AS table_name, m AS minutes_behind, {limit} AS max_minutes, m <= {limit} AS within_sla "
        f"FROM (SELECT CAST(floor(epoch({AS_OF} - max(CAST({c} AS TIMESTAMP))) / 60) AS BIGINT) AS m FROM {cte})"
        for layer, t, cte, c, limit in (
            ("raw", "events", "raw_events", "event_timestamp", 15), ("staging", "stg_events", "ev", "event_timestamp", 60),
            ("curated", "user_metrics", "um", "date", 240), ("mart", "business_metrics", "bm", "date", 360),
        )), "raw_events", "ev", "um", "bm")
O["dq_anomalies"] = statement(
    """SELECT date, n_rows, round(mean, 6) AS expected, round((n_rows - mean) / nullif(spread, 0), 6) AS z_score,
       coalesce(CASE WHEN spread = 0 THEN n_rows <> mean ELSE abs((n_rows - mean) / spread) > 3 END, FALSE) AS is_anomaly
FROM (SELECT date, n_rows, avg(n_rows) OVER w AS mean, stddev_samp(n_rows) OVER w AS spread
      FROM (SELECT c.date, count(event_date) AS n_rows
            FROM (SELECT CAST(unnest(generate_series(min(event_date), max(event_date), INTERVAL 1 DAY)) AS DATE) AS date FROM ev) c
            LEFT JOIN ev ON event_date = c.date GROUP BY 1)
      WINDOW w AS (ORDER BY date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING))""", "ev")
O["dq_schema_change"] = """
SELECT '*' AS column_name, CASE WHEN kept = total THEN 'same_rows' ELSE 'row_count' END AS change,
       CAST(total AS VARCHAR) AS old_type, CAST(kept AS VARCHAR) AS new_type
FROM (SELECT count(*) AS total, count(*) FILTER (event_type <> 'error') AS kept FROM events)
UNION ALL SELECT 'app_version', 'removed', 'string', NULL
UNION ALL SELECT 'os', 'added', NULL, 'string'
UNION ALL SELECT 'event_date', 'retyped', 'date', 'string'"""

# --- declarative assertions
_ASSERTED = {
    "stg_events": ("ev", "event_id, event_timestamp"), "stg_users": ("us", "user_id"), "user_metrics": ("um", "user_id, date"),
    "event_metrics": ("em", "event_type, date"), "ml_features": ("mf", "user_id, feature_date"),
    "user_analytics": ("ua", "user_id, date"), "business_metrics": ("bm", "date"),
}
_BAD = {
    "stg_events": {
        "amount is null or amount >= 0": "amount < 0", "event_timestamp <= :now": f"event_timestamp > {AS_OF}",
        "is_valid is boolean": "FALSE",
    },
    "stg_users": {
        "created_at <= :now": f"created_at > {AS_OF}", "updated_at is null or updated_at >= created_at": "updated_at < created_at",
        "days_since_registration >= 0": "days_since_registration < 0", "is_valid is boolean": "FALSE",
    },
    "user_metrics": {
        "avg_purchase_amount is null or avg_purchase_amount >= 0": "avg_purchase_amount < 0",
        "is_active_today is boolean": "FALSE", "made_purchase_today is boolean": "FALSE",
    },
    "event_metrics": {},
    "ml_features": {f"{c} is boolean": "FALSE" for c in ("is_active_7d", "is_active_30d", "purchased_7d", "purchased_30d")},
    "user_analytics": {f"is_active_{c} is boolean": "FALSE" for c in ("today", "this_week", "this_month")},
    "business_metrics": {},
}
for _m, _cols in {
    "user_metrics": "total_events total_purchases total_revenue unique_event_types total_sessions",
    "event_metrics": "total_events unique_users unique_sessions total_revenue web_events mobile_events avg_events_per_user avg_events_per_session",
    "ml_features": "events_last_7_days events_last_30_days purchases_last_7_days purchases_last_30_days revenue_last_7_days revenue_last_30_days",
    "user_analytics": "total_events lifetime_events lifetime_purchases lifetime_revenue",
    "business_metrics": "daily_active_users new_users daily_revenue daily_purchases total_events avg_events_per_user premium_users basic_users revenue_per_user",
}.items():
    _BAD[_m] |= {f"{c} >= 0": f"{c} < 0" for c in _cols.split()}
for _m, _tops in {
    "ml_features": {"engagement_score_7d": 100, "engagement_score_30d": 100, "platform_diversity_score": 1},
    "user_analytics": {"engagement_score_7d": 100, "engagement_score_30d": 100},
    "business_metrics": {"pct_premium_users": 100, "pct_basic_users": 100, "purchase_conversion_rate": 100},
}.items():
    _BAD[_m] |= {f"0 <= {c} <= {t}": f"{c} < 0 OR {c} > {t}" for c, t in _tops.items()}
_VALUES = {
    "stg_events": {"event_type": ACCEPTED, "platform": "'web','mobile','desktop','tablet'", "device_type": "'desktop','mobile','tablet','other'"},
    "stg_users": {"subscription_tier_standardized": "'basic','premium','enterprise'"},
}
_REQUIRED = {"stg_events": "event_id user_id event_type event_timestamp", "stg_users": "user_id email created_at"}


def _assertions() -> str:
    parts = []

    def add(model: str, kind: str, target: str, failed: str, passed: str = "f = 0") -> None:
        parts.append(
            f"SELECT '{model}' AS model, '{kind}' AS check_type, '{target}' AS target, f AS failed_rows, {passed} AS passed "
            f"FROM (SELECT count(*) FILTER ({failed}) AS f, count(*) AS n FROM {_ASSERTED[model][0]})"
        )

    for model, (cte, key) in _ASSERTED.items():
        for text, bad in _BAD[model].items():
            add(model, "expression_is_true", text, bad)
        for column, values in _VALUES.get(model, {}).items():
            add(model, "accepted_values", column, f"{column} NOT IN ({values})")
        for column in _REQUIRED.get(model, key.replace(",", "")).split():
            add(model, "not_null_proportion", column, f"{column} IS NULL", "(n - f) >= n * 0.99")
        parts.append(
            f"SELECT '{model}', 'unique_combination', '{key}', count(*), count(*) = 0 "
            f"FROM (SELECT {key} FROM {cte} GROUP BY ALL HAVING count(*) > 1)"
        )
    return " UNION ALL ".join(parts)


O["dq_expressions"] = statement(_assertions(), "ev", "us", "um", "em", "mf", "ua", "bm")

# --- streaming: what is final once the watermark (newest event - 1 hour) has passed
_MARK = "(SELECT max(event_timestamp) - INTERVAL 1 HOUR FROM good)"
O["stream_dedup"] = statement("SELECT * FROM raw_events", "raw_events")
O["stream_event_metrics"] = statement(
    f"""SELECT event_type, event_date AS date, count(*) AS total_events, count(DISTINCT user_id) AS unique_users,
       round(coalesce(sum(amount) FILTER ({_PAID}), 0.0::DOUBLE), 6) AS total_revenue,
       count(*) FILTER (event_type = 'purchase') AS total_purchases
FROM good WHERE CAST(event_date + 1 AS TIMESTAMP) <= {_MARK} GROUP BY ALL""", "good")
_GAPS = """SELECT user_id, count(*) AS events_count, count(*) FILTER (event_type = 'page_view') AS page_views,
       min(event_timestamp) AS started_at, max(event_timestamp) AS ended_at
FROM (SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY event_timestamp, event_id) AS s
      FROM (SELECT *, CASE WHEN event_timestamp - lag(event_timestamp) OVER (PARTITION BY user_id ORDER BY event_timestamp, event_id)
                                <= INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS opens FROM good))
GROUP BY user_id, s"""
O["batch_sessions"] = statement(_GAPS, "good")
O["stream_sessions"] = statement(
    f"SELECT * FROM gaps WHERE ended_at + INTERVAL 30 MINUTE <= {_MARK}", "good", gaps=_GAPS)
O["stream_sessions_live"] = O["batch_sessions"]
O["stream_event_metrics_live"] = statement(
    f"""SELECT event_type, event_date AS date, count(*) AS total_events, count(DISTINCT user_id) AS unique_users,
       round(coalesce(sum(amount) FILTER ({_PAID}), 0.0::DOUBLE), 6) AS total_revenue,
       count(*) FILTER (event_type = 'purchase') AS total_purchases
FROM good GROUP BY ALL""", "good")
O["expire_partitions"] = over(GAPS, "SELECT * FROM raw_events WHERE coalesce(DATE '2031-01-10' - event_date <= 2555, TRUE)")
O["schema_sync_stored"] = statement(
    """SELECT * EXCLUDE (timezone), CASE WHEN user_date >= DATE '2024-01-10' THEN 1.5::DOUBLE ELSE CAST(length(user_id) AS DOUBLE) END AS score,
       CASE WHEN user_date >= DATE '2024-01-10' THEN 'en' END AS locale FROM raw_users""", "raw_users")
O["daily_run_moving"] = statement(" UNION ALL ".join(
    f"SELECT '{table}' AS table_name, CAST({day} AS VARCHAR) AS day, count(*) AS n_rows, CAST({measure} AS BIGINT) AS measure FROM {cte} GROUP BY 2"
    for table, cte, day, measure in (
        ("stg_users", "us", "user_date", "sum(days_since_registration)"),
        ("user_metrics", "um", "date", "sum(total_events) + sum(coalesce(days_since_registration, 0)) + count(country)"),
        ("ml_features", "mf", "feature_date", "sum(lifetime_events) + sum(days_since_last_event) + count(*) FILTER (lifecycle_stage = 'new') + count(user_tier)"),
        ("user_analytics", "ua", "date", "sum(events_last_7_days) + sum(coalesce(days_since_registration, 0))"),
        ("business_metrics", "bm", "date", "sum(new_users_this_month * 1000 + new_users_this_week * 100 + users_us)"),
    )), "us", "um", "mf", "ua", "bm")

ORACLES = O

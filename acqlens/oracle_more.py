"""DuckDB twins of the operator, data-quality, report and extra queries (see ``acqlens.oracle``)."""
from __future__ import annotations

from acqlens.oracle import CHANNEL_ALIASES, cents, q, ratio, sql_channel, statement

RAW = ("appsflyer", "singular", "skan", "backend")


# The declared checks, stated here on their own.
CHANNELS = tuple(CHANNEL_ALIASES)
BACKEND_EVENTS, REVENUE_EVENTS, INSTALL_EVENT = ("purchase", "subscribe"), ("af_purchase", "af_subscribe"), "install"
FRESHNESS_WARN_DAYS, FRESHNESS_ERROR_DAYS, FRESHNESS_AS_OF = 2, 7, "2024-03-03 12:00:00"
NOT_NULL = """stg_appsflyer.appsflyer_id stg_appsflyer.channel stg_appsflyer_events.appsflyer_id
stg_appsflyer_events.event_revenue stg_singular.spend_date stg_singular.channel stg_backend.user_id stg_backend.event
rec_revenue_discrepancy.channel rec_revenue_discrepancy.activity_date rec_attribution_gap.event_date
rec_attribution_gap.unattributed_events dim_date.date_day dim_channel.channel_key dim_campaign.campaign_key
dim_geo.country_code fct_installs.channel_key fct_events.channel_key fct_spend.channel_key
mart_marketing_unified.activity_date mart_retention.cohort_size mart_growth_metrics.campaign_key
mart_growth_metrics.channel_key mart_privacy_roas_gap.campaign_key""".split()
UNIQUE = """stg_appsflyer.appsflyer_id dim_date.date_day dim_channel.channel_key dim_campaign.campaign_key
dim_geo.country_code mart_growth_metrics.campaign_key mart_privacy_roas_gap.campaign_key""".split()
ACCEPTED = {
    "stg_appsflyer.channel": CHANNELS, "stg_appsflyer.platform": ("ios", "android"), "stg_appsflyer.is_paid": (0, 1),
    "stg_appsflyer_events.event_name": REVENUE_EVENTS, "stg_singular.channel": CHANNELS,
    "stg_skan.postback_sequence_index": (0, 1, 2), "stg_skan.cv_band": ("none", "low", "medium", "high", "unknown"),
    "stg_backend.event": BACKEND_EVENTS, "stg_backend.is_attributed": (0, 1), "stg_backend.is_late_event": (0, 1),
    "rec_revenue_discrepancy.is_discrepancy_flag": (0, 1), "dim_channel.is_paid": (0, 1),
    "mart_privacy_roas_gap.has_crowd_anonymity": (0, 1)}
RELATIONSHIPS = """stg_appsflyer_events.appsflyer_id>stg_appsflyer.appsflyer_id
fct_installs.channel_key>dim_channel.channel_key fct_installs.campaign_key>dim_campaign.campaign_key
fct_installs.country_code>dim_geo.country_code fct_installs.install_date>dim_date.date_day
fct_events.channel_key>dim_channel.channel_key fct_events.campaign_key>dim_campaign.campaign_key
fct_events.event_date>dim_date.date_day fct_spend.channel_key>dim_channel.channel_key
fct_spend.campaign_key>dim_campaign.campaign_key mart_growth_metrics.channel_key>dim_channel.channel_key""".split()
# rows of a check that looks at one row at a time: (model, broken condition) each
BROKEN = {
    "assert_no_negative_revenue": [("stg_appsflyer_events", "sign(event_revenue) = -1"), ("stg_backend", "sign(revenue) = -1")],
    "assert_retention_monotonic": [("mart_retention", "NOT (retained_d1 >= retained_d7 AND retained_d7 >= retained_d30)")],
    "assert_skan_conversion_value_in_range": [("stg_skan", "conversion_value NOT BETWEEN 0 AND 63")],
    "assert_singular_installs_without_spend": [("stg_singular", "network_installs > 0 AND NOT coalesce(cost > 0, false)")],
    "assert_singular_spend_without_installs": [("stg_singular", "cost > 0 AND network_installs = 0")],
}
WARNINGS = ("assert_singular_installs_without_spend", "assert_singular_spend_without_installs")


def _lit(v) -> str:
    return q(v) if isinstance(v, str) else str(v)


def _checks() -> list[tuple[str, str, str, str | None, str]]:
    """(name, kind, model, column, failures as a scalar query) of every check."""
    out = []
    for field in NOT_NULL:
        m, c = field.split(".")
        out.append((f"not_null_{m}_{c}", "not_null", m, c, f"SELECT count(*) - count({c}) FROM {m}"))
    for field in UNIQUE:
        m, c = field.split(".")
        out.append((f"unique_{m}_{c}", "unique", m, c,
                    f"SELECT count(*) FILTER (n > 1) FROM (SELECT count({c}) AS n FROM {m} GROUP BY {c}) g"))
    for field, values in ACCEPTED.items():
        m, c = field.split(".")
        out.append((f"accepted_values_{m}_{c}", "accepted_values", m, c,
                    f"SELECT count(DISTINCT {c}) FILTER ({c} NOT IN ({', '.join(map(_lit, values))})) FROM {m}"))
    for pair in RELATIONSHIPS:
        (m, c), (pm, pc) = (side.split(".") for side in pair.split(">"))
        out.append((f"relationships_{m}_{c}__{pc}__{pm}", "relationships", m, c,
                    f"SELECT count(*) FROM (SELECT {c} AS k FROM {m}) ch ANTI JOIN (SELECT {pc} AS k FROM {pm}) pa USING (k) "
                    f"WHERE k IS NOT NULL"))
    out.append(("assert_backend_no_duplicates", "custom", "stg_backend", None,
                "SELECT count(*) FILTER (n > 1) FROM (SELECT count(*) AS n FROM stg_backend "
                "GROUP BY user_id, event, event_time) g"))
    for name, parts in BROKEN.items():
        out.append((name, "custom", "+".join(m for m, _ in parts), None, "SELECT " + " + ".join(
            f"(SELECT count(*) FILTER ({broken}) FROM {m})" for m, broken in parts)))
    return out


def _checks_sql(kind: str | None = None, name: str | None = None) -> str:
    rows = []
    for n, k, model, column, failures in _checks():
        if kind in (None, k) and name in (None, n):
            rows.append(f"SELECT {q(n)} AS check_name, {q(k)} AS check_type, {q(model)} AS model, "
                        f"CAST({'NULL' if column is None else q(column)} AS VARCHAR) AS column_name, "
                        f"{q('warn' if n in WARNINGS else 'error')} AS severity, CAST(({failures}) AS BIGINT) AS failures")
    return ("SELECT *, CASE WHEN failures = 0 THEN 'pass' ELSE severity END AS status FROM ("
            + "\nUNION ALL ".join(rows) + ") x")


def _broken_spend(name: str) -> str:
    return ("SELECT spend_date, channel, campaign, country_code, cost, network_installs FROM stg_singular WHERE "
            + BROKEN[name][0][1])


EXTRA: dict[str, str] = {}
EXTRA["dq_all"] = _checks_sql()

EXTRA["channel_sheet"] = """
SELECT channel_key AS channel, sum(cost) AS paid, sum(installs) AS installed, sum(ios_installs) AS ios, sum(paying_users) AS payers,
  sum(mmp_revenue_d30) AS claimed, sum(backend_revenue_d30) AS confirmed, sum(skan_postbacks) AS posts,
  sum(skan_null_cv) AS hidden, count(*) FILTER (has_crowd_anonymity = 1) AS crowded
FROM mart_privacy_roas_gap JOIN (SELECT channel_key, campaign_key, paying_users FROM mart_growth_metrics) g
  USING (channel_key, campaign_key)
GROUP BY ALL"""

EXTRA["report_roas_q"] = f"""
SELECT channel, CAST(paid AS DECIMAL(38,2)) AS cost, CAST(installed AS BIGINT) AS installs,
  CAST(payers AS BIGINT) AS paying_users, CAST(claimed AS DECIMAL(38,2)) AS revenue_d30,
  CASE WHEN paid <> 0 THEN {ratio(cents('claimed'), cents('paid'), 10, 4)} END AS roas_d30,
  CASE WHEN installed <> 0 THEN {ratio(cents('paid'), '100 * installed', 10, 2)} END AS cpi,
  CASE WHEN payers <> 0 THEN {ratio(cents('paid'), '100 * payers', 10, 2)} END AS cac
FROM channel_sheet"""

EXTRA["report_discrepancy_q"] = """
SELECT channel, CAST(sum(amount) FILTER (which = 'mmp_revenue') AS DECIMAL(38,2)) AS mmp_revenue,
  CAST(sum(amount) FILTER (which = 'backend_revenue') AS DECIMAL(38,2)) AS backend_revenue,
  count(*) FILTER (which = 'mmp_revenue' AND is_discrepancy_flag = 1) AS flagged_days,
  count(DISTINCT activity_date) AS total_days
FROM (UNPIVOT rec_revenue_discrepancy ON mmp_revenue, backend_revenue INTO NAME which VALUE amount) u
GROUP BY ALL"""

EXTRA["sk_anon"] = """
SELECT source_identifier,
  CASE WHEN count(*) OVER (PARTITION BY source_identifier) < 15 THEN NULL ELSE conversion_value END AS cv
FROM sk_base"""

EXTRA["anomaly_daily"] = """
SELECT channel_key, activity_date, sum(cost) AS cost, sum(revenue) AS revenue, sum(installs) AS installs
FROM mart_marketing_unified GROUP BY channel_key, activity_date"""

EXTRA["anomaly_cal"] = """
SELECT channel_key, CAST(unnest(generate_series(d0, d1, INTERVAL 1 DAY)) AS DATE) AS activity_date
FROM (SELECT channel_key, min(activity_date) AS d0, max(activity_date) AS d1 FROM anomaly_daily
      GROUP BY channel_key) sp"""

EXTRA["load_counts_q"] = "\nUNION ALL ".join(
    f"SELECT 'raw.{s}' AS table_name, count(*) AS row_count FROM raw_{s}" for s in RAW)

_registry_values = ", ".join([f"('appsflyer', {q(e)})" for e in (INSTALL_EVENT, *REVENUE_EVENTS)]
                             + [f"('backend', {q(e)})" for e in BACKEND_EVENTS])


def _freshness() -> str:
    asof = f"TIMESTAMP '{FRESHNESS_AS_OF}'"
    parts = [f"SELECT '{s}' AS source_name, max(_loaded_at) AS max_loaded_at, "
             f"CAST(datediff('second', max(_loaded_at), {asof}) AS BIGINT) AS age_seconds FROM raw_{s}" for s in RAW]
    return (f"SELECT source_name, max_loaded_at, age_seconds, CASE WHEN age_seconds IS NULL "
            f"OR age_seconds > {FRESHNESS_ERROR_DAYS} * 86400 THEN 'error' WHEN age_seconds > {FRESHNESS_WARN_DAYS} "
            f"* 86400 THEN 'warn' ELSE 'pass' END AS status FROM (" + " UNION ALL ".join(parts) + ") f")


HARD_TEXT = {"appsflyer": "af_ad", "singular": "campaign", "skan": "source_identifier", "backend": "event"}
COLUMNS = {
    "appsflyer": "appsflyer_id media_source campaign af_adset af_ad install_time attributed_touch_time attributed_touch_type "
                 "event_name event_revenue event_time country_code platform",
    "singular": "date source campaign country impressions clicks installs cost",
    "skan": "ad_network_id source_identifier conversion_value postback_sequence_index redownload",
    "backend": "user_id event revenue event_time"}


def _digest(table: str) -> str:
    values = []
    for c in COLUMNS[table].split():
        v = f"{c} || ', \"so to say\"' || chr(10) || 'and on'" if c == HARD_TEXT[table] else f"CAST({c} AS VARCHAR)"
        values.append(f"coalesce('=' || {v}, '-')")
    return (f"SELECT 'raw.{table}' AS table_name, count(*) AS row_count, CAST(coalesce(sum(CAST('0x' || "
            f"substr(md5(concat_ws(chr(31), {', '.join(values)})), 1, 15) AS BIGINT)), 0) AS DECIMAL(38,0)) AS rows_digest "
            f"FROM raw_{table}")


# the faults that are planted in each source: (fault, which rows)
PLANTED = {
    "appsflyer": [("country_code: longer than 2", "minute(install_time) = 7"),
                  ("appsflyer_id: missing", "minute(install_time) = 8"),
                  ("attributed_touch_time: not a datetime", "minute(install_time) = 9"),
                  ("platform: longer than 10", "minute(install_time) = 10")],
    "singular": [("impressions: not within -2147483648 and 2147483647", "day(date) = 3"),
                 ("clicks: not a whole number", "day(date) = 3"), ("cost: over 12 digits", "day(date) = 4")],
    "skan": [("conversion_value: not within 0 and 255", "redownload = 1"),
             ("redownload: not within 0 and 1", "conversion_value = 17")],
    "backend": [("revenue: not a number", "second(event_time) = 5"), ("event_time: not a datetime", "second(event_time) = 6")],
}


def _reject_counts(table: str) -> str:
    faults = ", ".join(f"CASE WHEN {rows} THEN {q(fault)} END" for fault, rows in PLANTED[table])
    return (f"SELECT {q(table)} AS source_name, fault, count(*) AS n_rows FROM (SELECT unnest(CASE WHEN len(f) = 0 THEN [''] "
            f"ELSE f END) AS fault FROM (SELECT list_filter([{faults}], lambda x: x IS NOT NULL) AS f FROM raw_{table}) a) b GROUP BY ALL")


_times = {"appsflyer": "coalesce(event_time, install_time)", "singular": "CAST(date AS TIMESTAMP)", "backend": "event_time"}
EXTRA["timed_rows"] = "\nUNION ALL ".join(
    f"SELECT '{t}' AS source_name, {x} AS t, 1 + CAST(coalesce({x} >= TIMESTAMP '2024-01-20', false) AS INTEGER) "
    f"+ CAST(coalesce({x} >= TIMESTAMP '2024-01-27', false) AS INTEGER) AS nth FROM raw_{t}" for t, x in _times.items())
EXTRA["marks_by_load"] = """
SELECT nth, source_name, (SELECT max(t) FROM timed_rows x WHERE x.source_name = s.source_name AND x.nth <= l.nth) AS high_water
FROM (VALUES (1), (2), (3)) l(nth), (VALUES ('appsflyer'), ('singular'), ('skan'), ('backend')) s(source_name)"""
EXTRA["lags_by_load"] = """
SELECT *, datediff('second', high_water, max(high_water) OVER (PARTITION BY nth)) AS behind,
  lag(high_water) OVER (PARTITION BY source_name ORDER BY nth) AS was FROM marks_by_load"""
EXTRA["arrived_rows"] = """
SELECT event_time, least(2, (event_time >= TIMESTAMP '2024-01-11')::INT + (event_time >= TIMESTAMP '2024-01-21')::INT
  + (user_id LIKE '%7')::INT) AS nth FROM raw_backend"""
EXTRA["stream_marks"] = """
SELECT nth, max(max(event_time)) OVER (ORDER BY nth) AS high_water, count(*) AS n_rows FROM arrived_rows GROUP BY nth"""
EXTRA["stream_limits"] = """
SELECT *, lag(high_water) OVER (ORDER BY nth) - INTERVAL 2 DAY AS too_old FROM stream_marks"""


def selects() -> dict[str, str]:
    s: dict[str, str] = {}
    s["load_counts"] = "SELECT * FROM load_counts_q"
    s["load_idempotent"] = ("SELECT table_name, row_count AS rows_first_load, row_count AS rows_second_load "
                            "FROM load_counts_q")
    s["freshness"] = _freshness()
    s["csv_round_trip"] = "\nUNION ALL ".join(_digest(t) for t in RAW)
    s["load_rejects"] = "\nUNION ALL ".join(_reject_counts(t) for t in RAW)
    s["load_freshness"] = """
SELECT 'load-' || nth AS load_id, source_name, high_water, CAST(behind AS BIGINT) AS lag_seconds,
  CAST(datediff('second', was, high_water) AS BIGINT) AS advanced_seconds,
  CASE WHEN high_water IS NULL THEN 'no clock' WHEN behind > 7 * 86400 THEN 'error' WHEN behind > 2 * 86400 THEN 'warn'
       ELSE 'pass' END AS status
FROM lags_by_load"""
    s["channel_standardize"] = f"""
SELECT raw_value, {sql_channel('raw_value')} AS channel, count(*) AS row_count
FROM (SELECT media_source AS raw_value FROM raw_appsflyer UNION ALL SELECT source FROM raw_singular) t
GROUP BY raw_value"""
    s["event_taxonomy_map"] = """
SELECT coalesce(m.event, b.event) AS event, CAST(coalesce(m.mmp_events, 0) AS BIGINT) AS mmp_events,
  CAST(coalesce(m.mmp_revenue, 0) AS DECIMAL(38,2)) AS mmp_revenue,
  CAST(coalesce(b.backend_events, 0) AS BIGINT) AS backend_events,
  CAST(coalesce(b.backend_revenue, 0) AS DECIMAL(38,2)) AS backend_revenue
FROM (SELECT CASE event_name WHEN 'af_purchase' THEN 'purchase' WHEN 'af_subscribe' THEN 'subscribe' END AS event,
        count(*) AS mmp_events, sum(event_revenue) AS mmp_revenue FROM stg_appsflyer_events GROUP BY 1) m
FULL OUTER JOIN (SELECT event, count(*) AS backend_events, sum(revenue) AS backend_revenue FROM stg_backend
                 WHERE is_attributed = 1 GROUP BY event) b ON m.event = b.event"""
    s["backend_dedup"] = "SELECT * FROM bk_dedup"
    s["cv_band_distribution"] = """
SELECT cv_band, count(*) AS postbacks, CAST(min(conversion_value) AS INTEGER) AS min_value,
  CAST(max(conversion_value) AS INTEGER) AS max_value
FROM stg_skan GROUP BY cv_band"""
    s["cohort_revenue"] = """
SELECT channel_key, campaign_key, CAST(claimed AS DECIMAL(38,2)) AS revenue_total, CAST(claimed_7 AS DECIMAL(38,2)) AS revenue_d7,
  CAST(claimed_30 AS DECIMAL(38,2)) AS revenue_d30, payers AS paying_users
FROM campaign_ledger WHERE payers > 0"""
    s["paying_users"] = """
SELECT event_date AS activity_date, channel_key, count(DISTINCT appsflyer_id) AS paying_users,
  CAST(sum(event_count) AS BIGINT) AS revenue_events, CAST(sum(event_revenue) AS DECIMAL(38,2)) AS revenue
FROM fct_events GROUP BY event_date, channel_key"""
    s["ltv_projection"] = f"""
SELECT channel_key, campaign_key, installed AS installs, CAST(claimed_30 AS DECIMAL(38,2)) AS revenue_d30,
  {ratio(cents('claimed_30'), '100 * installed', 12, 2)} AS arpu_d30, CAST(1.4 AS DECIMAL(6,2)) AS ltv_factor,
  {ratio(cents('claimed_30') + ' * 14', '1000 * installed', 12, 2)} AS predicted_ltv_d90
FROM campaign_ledger"""
    # data quality
    s["dq_not_null"] = _checks_sql(kind="not_null")
    s["dq_unique"] = _checks_sql(kind="unique")
    s["dq_accepted_values"] = _checks_sql(kind="accepted_values")
    s["dq_relationships"] = _checks_sql(kind="relationships")
    s["dq_backend_no_duplicates"] = _checks_sql(name="assert_backend_no_duplicates")
    s["dq_no_negative_revenue"] = _checks_sql(name="assert_no_negative_revenue")
    s["dq_retention_monotonic"] = _checks_sql(name="assert_retention_monotonic")
    s["dq_skan_range"] = _checks_sql(name="assert_skan_conversion_value_in_range")
    s["dq_installs_without_spend"] = _broken_spend("assert_singular_installs_without_spend")
    s["dq_spend_without_installs"] = _broken_spend("assert_singular_spend_without_installs")
    s["dq_summary"] = "SELECT * FROM dq_all"
    s["dq_verdict"] = """
SELECT count(*) AS checks, CAST(sum(CASE WHEN status = 'pass' THEN 1 ELSE 0 END) AS BIGINT) AS passed,
  CAST(sum(CASE WHEN status = 'warn' THEN 1 ELSE 0 END) AS BIGINT) AS warned,
  CAST(sum(CASE WHEN status = 'error' THEN 1 ELSE 0 END) AS BIGINT) AS errors
FROM dq_all"""
    # reports
    s["report_roas"] = "SELECT * FROM report_roas_q"
    s["report_roas_paid"] = "SELECT * FROM report_roas_q WHERE roas_d30 IS NOT NULL"
    s["report_discrepancy"] = "SELECT * FROM report_discrepancy_q"
    s["report_privacy"] = f"""
SELECT channel, CAST(installed AS BIGINT) AS installs, CAST(ios AS BIGINT) AS ios_installs, CAST(posts AS BIGINT) AS skan_postbacks,
  CAST(hidden AS BIGINT) AS skan_null_cv, crowded AS campaigns_anonymized,
  CASE WHEN paid <> 0 THEN {ratio(cents('claimed'), cents('paid'), 10, 4)} END AS mmp_roas,
  CASE WHEN paid <> 0 THEN {ratio(cents('confirmed'), cents('paid'), 10, 4)} END AS backend_roas
FROM channel_sheet"""
    s["report_kpi"] = f"""
SELECT CAST(g.total_cost AS DECIMAL(38,2)) AS total_cost, CAST(g.total_installs AS BIGINT) AS total_installs,
  CAST(g.revenue_d30 AS DECIMAL(38,2)) AS revenue_d30,
  CASE WHEN r.m <> 0 THEN {ratio('100 * (' + cents('r.m') + ' - ' + cents('r.b') + ')', cents('r.m'), 8, 2)} END
      AS mmp_overstatement_pct
FROM (SELECT sum(cost) AS total_cost, sum(installs) AS total_installs, sum(revenue_d30) AS revenue_d30
      FROM mart_growth_metrics) g,
     (SELECT sum(mmp_revenue) AS m, sum(backend_revenue) AS b FROM rec_revenue_discrepancy) r"""
    s["report_revenue_unpivot"] = """
SELECT channel, 'mmp_revenue' AS source, mmp_revenue AS revenue FROM report_discrepancy_q
UNION ALL SELECT channel, 'backend_revenue', backend_revenue FROM report_discrepancy_q"""
    # re-aimed jobs
    s["skan_k_anonymity"] = """
SELECT source_identifier AS campaign, count(*) AS postbacks,
  CAST(sum(CASE WHEN cv IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS withheld_values, count(cv) AS visible_values
FROM sk_anon GROUP BY source_identifier"""
    s["ios_paid_installs"] = """
SELECT channel, campaign, count(*) AS ios_installs FROM stg_appsflyer
WHERE platform = 'ios' AND is_paid = 1 GROUP BY channel, campaign"""
    s["ctit_by_channel"] = f"""
SELECT channel, attributed_touch_type, count(*) AS installs, CAST(min(m) AS BIGINT) AS min_ctit_minutes,
  CAST(max(m) AS BIGINT) AS max_ctit_minutes, {ratio('sum(m)', 'count(*)', 12, 2)} AS avg_ctit_minutes
FROM (SELECT channel, attributed_touch_type, datediff('second', attributed_touch_time, install_time) // 60 AS m
      FROM stg_appsflyer WHERE attributed_touch_time IS NOT NULL AND install_time IS NOT NULL) t
GROUP BY channel, attributed_touch_type"""
    s["spend_funnel"] = f"""
SELECT channel, CAST(sum(impressions) AS BIGINT) AS impressions, CAST(sum(clicks) AS BIGINT) AS clicks,
  CAST(sum(network_installs) AS BIGINT) AS network_installs, CAST(sum(cost) AS DECIMAL(38,2)) AS cost,
  CASE WHEN sum(impressions) > 0 THEN {ratio('sum(clicks)', 'sum(impressions)', 12, 4)} END AS ctr,
  CASE WHEN sum(clicks) > 0 THEN {ratio('sum(network_installs)', 'sum(clicks)', 12, 4)} END AS click_to_install,
  CASE WHEN sum(network_installs) > 0 THEN {ratio(cents('sum(cost)'), '100 * sum(network_installs)', 12, 2)} END
      AS network_cpi
FROM stg_singular GROUP BY channel"""
    back, mmp = "coalesce(s.backend_revenue, 0)", "coalesce(m.mmp_revenue, 0)"
    s["defect_profile"] = f"""
SELECT r.raw_backend_rows, s.dedup_rows, r.raw_backend_rows - s.dedup_rows AS duplicate_rows,
  CASE WHEN r.raw_backend_rows > 0 THEN {ratio('100 * (r.raw_backend_rows - s.dedup_rows)', 'r.raw_backend_rows', 6, 2)} END
      AS duplicate_pct,
  CAST(s.unattributed_events AS BIGINT) AS unattributed_events,
  CASE WHEN s.dedup_rows > 0 THEN {ratio('100 * s.unattributed_events', 's.dedup_rows', 6, 2)} END AS unattributed_pct,
  CAST(s.late_events AS BIGINT) AS late_events,
  CASE WHEN s.dedup_rows > 0 THEN {ratio('100 * s.late_events', 's.dedup_rows', 6, 2)} END AS late_pct,
  CAST({mmp} AS DECIMAL(38,2)) AS mmp_revenue, CAST({back} AS DECIMAL(38,2)) AS backend_attributed_revenue,
  CASE WHEN {mmp} > 0 THEN {ratio('100 * (' + cents(back) + ' - ' + cents(mmp) + ')', cents(mmp), 8, 2)} END
      AS revenue_drift_pct
FROM (SELECT count(*) AS raw_backend_rows FROM raw_backend) r,
     (SELECT count(*) AS dedup_rows, sum(1 - is_attributed) AS unattributed_events, sum(is_late_event) AS late_events,
        sum(CASE WHEN is_attributed = 1 THEN revenue END) AS backend_revenue FROM stg_backend) s,
     (SELECT sum(event_revenue) AS mmp_revenue FROM stg_appsflyer_events) m"""
    m_, n_ = "coalesce(a.mmp_installs, 0)", "coalesce(b.network_installs, 0)"
    s["install_discrepancy"] = f"""
SELECT coalesce(a.channel, b.channel) AS channel, coalesce(a.activity_date, b.activity_date) AS activity_date,
  CAST({m_} AS BIGINT) AS mmp_installs, CAST({n_} AS BIGINT) AS network_installs,
  CAST({n_} - {m_} AS BIGINT) AS install_delta,
  CASE WHEN {m_} <> 0 THEN {ratio(f'100 * ({n_} - {m_})', m_, 8, 2)} END AS install_delta_pct,
  CASE WHEN {m_} = 0 AND {n_} > 0 THEN 1 WHEN {m_} = 0 THEN 0
       WHEN abs({n_} - {m_}) * 100 > {m_} * 5 THEN 1 ELSE 0 END AS is_discrepancy_flag
FROM (SELECT channel, install_date AS activity_date, count(*) AS mmp_installs FROM stg_appsflyer GROUP BY 1, 2) a
FULL OUTER JOIN (SELECT channel, spend_date AS activity_date, sum(network_installs) AS network_installs
                 FROM stg_singular GROUP BY 1, 2) b
  ON a.channel = b.channel AND a.activity_date = b.activity_date"""
    s["cv_decode"] = """
SELECT campaign, revenue_tier, engagement_tier, retained_flag, count(*) AS postbacks FROM (
  SELECT campaign, CAST(conversion_value AS INTEGER) & 7 AS revenue_tier,
    (CAST(conversion_value AS INTEGER) >> 3) & 3 AS engagement_tier,
    (CAST(conversion_value AS INTEGER) >> 5) & 1 AS retained_flag
  FROM stg_skan WHERE conversion_value IS NOT NULL) t
GROUP BY ALL"""
    s["skan_windows"] = """
SELECT campaign, count(*) FILTER (WHERE postback_sequence_index = 0) AS window_0,
  count(*) FILTER (WHERE postback_sequence_index = 1) AS window_1,
  count(*) FILTER (WHERE postback_sequence_index = 2) AS window_2
FROM stg_skan GROUP BY campaign"""
    s["taxonomy_lint"] = f"""
SELECT s.source, s.event_name, s.row_count FROM (
  SELECT 'appsflyer' AS source, event_name, count(*) AS row_count FROM raw_appsflyer GROUP BY event_name
  UNION ALL SELECT 'backend', event, count(*) FROM raw_backend GROUP BY event) s
LEFT JOIN (VALUES {_registry_values}) reg(source, event_name)
  ON s.source = reg.source AND s.event_name = reg.event_name
WHERE reg.source IS NULL"""
    s["threshold_alerts"] = f"""
SELECT 'revenue_discrepancy' AS alert_type, r.activity_date, r.channel, c.campaign,
  CAST(r.revenue_delta_pct AS DECIMAL(8,2)) AS metric_pct
FROM rec_revenue_discrepancy r
JOIN (SELECT channel, event_date AS activity_date, campaign FROM stg_appsflyer_events
      UNION SELECT channel, event_date, campaign FROM stg_backend WHERE is_attributed = 1) c
  ON r.channel = c.channel AND r.activity_date = c.activity_date
WHERE r.is_discrepancy_flag = 1
UNION ALL
SELECT 'attribution_gap', activity_date, CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR),
  {ratio('100 * ' + cents('gap'), cents('total'), 8, 2)}
FROM (SELECT event_date AS activity_date, sum(CASE WHEN is_attributed = 0 THEN revenue ELSE 0 END) AS gap,
        sum(revenue) AS total FROM stg_backend GROUP BY event_date) d
WHERE total > 0 AND gap * 100 > total * 10"""
    roas = "CASE WHEN d.cost > 0 THEN CAST(d.revenue AS DOUBLE) / CAST(d.cost AS DOUBLE) END"
    cpi = "CASE WHEN d.installs > 0 THEN CAST(d.cost AS DOUBLE) / CAST(d.installs AS DOUBLE) END"
    on = "c.channel_key = d.channel_key AND c.activity_date = d.activity_date"
    s["metric_anomalies"] = f"""
SELECT channel_key, activity_date, metric, n_prior,
  CASE WHEN v IS NOT NULL AND n_prior >= 2 AND sd > 0 AND abs(v - mu) > sd * 3 THEN 1 ELSE 0 END AS is_anomaly
FROM (
  SELECT *, avg(v) OVER w AS mu, stddev_samp(v) OVER w AS sd, count(v) OVER w AS n_prior
  FROM (
    SELECT c.channel_key, c.activity_date, 'roas' AS metric, {roas} AS v
    FROM anomaly_cal c LEFT JOIN anomaly_daily d ON {on}
    UNION ALL
    SELECT c.channel_key, c.activity_date, 'cpi', {cpi}
    FROM anomaly_cal c LEFT JOIN anomaly_daily d ON {on}) s
  WINDOW w AS (PARTITION BY channel_key, metric ORDER BY activity_date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)) x"""
    s["rolling_payers"] = """
SELECT d.event_date AS activity_date, d.channel_key,
  count(DISTINCT e.appsflyer_id) FILTER (d.event_date - e.event_date < 7) AS payers_7d,
  count(DISTINCT e.appsflyer_id) AS payers_30d
FROM (SELECT DISTINCT event_date, channel_key FROM fct_events) d
JOIN (SELECT DISTINCT event_date, channel_key, appsflyer_id FROM fct_events) e
  ON e.channel_key = d.channel_key AND e.event_date BETWEEN d.event_date - 29 AND d.event_date
GROUP BY ALL"""
    for key, model in (("refresh_retention", "mart_retention"), ("refresh_growth", "mart_growth_metrics"),
                       ("refresh_privacy_gap", "mart_privacy_roas_gap"), ("stream_dedup", "bk_dedup")):
        s[key] = f"SELECT * FROM {model}"
    s["stream_late_rows"] = """
SELECT CAST(nth AS BIGINT) AS batch, high_water, n_rows,
  (SELECT count(*) FROM arrived_rows a WHERE a.nth = l.nth AND a.event_time < l.too_old) AS n_late
FROM stream_limits l"""
    return s


def statements() -> dict[str, str]:
    return {k: statement(v, EXTRA) for k, v in selects().items()}

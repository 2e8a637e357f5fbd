"""DuckDB SQL for the queries of ``demo.lake``."""

from __future__ import annotations

from demo.oracles import _LABEL, _MARKET, _METRICS, ORACLES, _micros, _places, _sql
from demo.views import NOW

#: Silver keeps candles whose low is positive too.
_KEPT = "FROM events WHERE value > 0 AND CAST(value - 5 AS DECIMAL(18, 2)) > 0"


def _from_silver(sql: str) -> str:
    return sql.replace("FROM events WHERE value > 0", _KEPT)


_GOLD = f"""SELECT f.token_address, {_micros("event_timestamp")}, {_places("close", "return_1h", "return_4h", "return_24h", "sma_20", "volatility_20", "rsi_14", "ema_fast", "ema_slow", "macd_signal")},
    round(ema_fast - ema_slow, 6) AS macd FROM featured f JOIN averaged a USING (event_id)"""


def _training(kind: str, label: str, complete: str) -> str:
    return _sql(
        "featured",
        f"""SELECT token_address, '{kind}' AS model_type, CAST(max(last_train) AS BIGINT) AS n_train,
              CAST(count(*) - max(last_train) AS BIGINT) AS n_test,
              round(avg(label) FILTER (place <= last_train), 6) AS positive_rate_train,
              round(avg(label) FILTER (place > last_train), 6) AS positive_rate_test, true AS converged
            FROM (SELECT *, row_number() OVER (PARTITION BY token_address ORDER BY event_timestamp, event_id) AS place,
                         floor(count(*) OVER (PARTITION BY token_address) * CAST(0.8 AS DOUBLE)) AS last_train
                  FROM (SELECT *, {label} FROM featured {_LABEL})
                  WHERE label IS NOT NULL AND {complete})
            GROUP BY token_address HAVING count(*) >= 20 AND count(DISTINCT label) FILTER (place <= last_train) = 2""",
    )


_LADDER = " ".join(
    f"WHEN lead(close, {k}) OVER w >= close * 1.01 THEN 1 WHEN lead(close, {k}) OVER w <= close * 0.99 THEN 0" for k in range(1, 7)
)
_ENTRY = _training(
    "entry",
    f"CAST(CASE WHEN lead(rn, 6) OVER w IS NULL THEN NULL {_LADDER} ELSE 0 END AS DOUBLE) AS label",
    "return_24h IS NOT NULL AND sma_20 IS NOT NULL AND volatility_20 IS NOT NULL AND rsi_14 IS NOT NULL",
)
_EXIT = _training(
    "exit",
    """CAST(CASE WHEN lead(rn, 3) OVER w IS NULL THEN NULL WHEN (least(lead(close, 1) OVER w, lead(close, 2) OVER w,
       lead(close, 3) OVER w) - close) / close <= -0.01 THEN 1 ELSE 0 END AS DOUBLE) AS label""",
    "return_4h IS NOT NULL AND volatility_20 IS NOT NULL AND rsi_14 IS NOT NULL",
)
_SECURITY = """
    SELECT *, CASE WHEN vendor >= 0.8 THEN 50 WHEN vendor >= 0.6 THEN 40 WHEN vendor >= 0.4 THEN 30 WHEN vendor >= 0.2 THEN 15 ELSE 0 END
        + CASE WHEN outflow THEN 25 ELSE 0 END + CASE WHEN mint THEN 20 ELSE 0 END + CASE WHEN frozen THEN 15 ELSE 0 END AS total
    FROM (SELECT CAST(p_partkey AS VARCHAR) AS token_address, CASE WHEN p_size % 5 <> 0 THEN p_size * 2.0 / 100 END AS vendor,
                 CASE p_size % 4 WHEN 3 THEN NULL ELSE p_size % 4 < 2 END AS mint,
                 CASE p_size % 4 WHEN 3 THEN NULL ELSE p_size % 4 = 0 END AS frozen,
                 CASE WHEN p_size IN (SELECT l_suppkey FROM lineitem) THEN coalesce(recent, false) END AS outflow
          FROM part LEFT JOIN (SELECT l_suppkey, l_partkey, max(l_shipdate) >= TIMESTAMP '1998-12-01' - INTERVAL 24 HOUR AS recent
                               FROM lineitem WHERE l_linestatus = 'O' AND l_tax > 0 GROUP BY ALL)
               ON l_suppkey = p_size AND l_partkey = p_partkey)"""
_SCANNED = """
    SELECT *, CASE WHEN liquidity IS NULL OR liquidity <= 0 THEN 'bad_liquidity' WHEN volume_24h_usd IS NULL OR volume_24h_usd < 0 THEN 'bad_volume'
                   WHEN volume_24h_usd / liquidity > 50 THEN 'volume_to_liquidity' ELSE 'valid' END AS outcome FROM candidates"""

LAKE_ORACLES: dict[str, str] = {
    "bronze_table": """SELECT 'market' AS domain, strftime(ts, '%Y-%m-%d') AS dt, 4 * count(*) AS events, count(*) AS ids, true AS has_files
        FROM events GROUP BY ALL""",
    "silver_table": f"""SELECT token_address, event_timestamp, strftime(make_timestamp(event_timestamp), '%Y-%m-%d') AS event_date,
        value AS open, value AS high, low, value AS close, volume, 'usd' AS currency FROM ({_MARKET}) WHERE value > 0 AND low > 0 AND volume >= 0""",
    "silver_quarantine_table": ORACLES["silver_quarantine"],
    "silver_counts": f"""SELECT count(*) FILTER (value > 0 AND low > 0 AND volume >= 0) AS valid,
        count(*) FILTER (NOT (value > 0 AND low > 0 AND volume >= 0)) AS quarantined FROM ({_MARKET})""",
    "gold_table": _from_silver(_sql("featured averaged", _GOLD)),
    "backtest_table": _from_silver(_sql("drawn", _METRICS)),
    "positions_table": ORACLES["position_ledger"],
    "sales_table": ORACLES["position_sales"],
    "rejections_table": ORACLES["position_rejections"],
    "position_changes": ORACLES["position_ledger"],
    "holder_report": _sql(
        "concentration",
        """SELECT CAST(p_partkey AS VARCHAR) AS token_address, coalesce(holder_count, 0) AS holder_count, round(coalesce(top10_share, 0), 6) AS top10_share,
           round(coalesce(hhi, 0), 6) AS hhi, CASE WHEN top10_share >= 0.8 THEN 'CRITICAL' WHEN top10_share >= 0.6 THEN 'VERY_HIGH'
             WHEN top10_share >= 0.4 THEN 'HIGH' WHEN top10_share >= 0.2 THEN 'MODERATE' ELSE 'LOW' END AS risk_tier,
           CASE WHEN p_size % 5 <> 0 THEN p_size * 2.0::DOUBLE END AS top10_hold_percent, p_size::BIGINT AS total_holders,
           round(coalesce(CASE WHEN p_size % 5 <> 0 THEN p_size * 2.0 / 100 END, top10_share, 0), 6) AS verdict_share,
           CASE WHEN p_size % 5 <> 0 THEN 'supply' ELSE 'sample' END AS verdict_basis,
           CASE WHEN coalesce(CASE WHEN p_size % 5 <> 0 THEN p_size * 2.0 / 100 END, top10_share, 0) >= 0.8 THEN 'CRITICAL'
                WHEN coalesce(CASE WHEN p_size % 5 <> 0 THEN p_size * 2.0 / 100 END, top10_share, 0) >= 0.6 THEN 'VERY_HIGH'
                WHEN coalesce(CASE WHEN p_size % 5 <> 0 THEN p_size * 2.0 / 100 END, top10_share, 0) >= 0.4 THEN 'HIGH'
                WHEN coalesce(CASE WHEN p_size % 5 <> 0 THEN p_size * 2.0 / 100 END, top10_share, 0) >= 0.2 THEN 'MODERATE' ELSE 'LOW' END AS verdict_tier,
           CASE WHEN p_size % 5 = 0 THEN NULL WHEN p_size >= 40 THEN 'CRITICAL' WHEN p_size >= 30 THEN 'VERY_HIGH' WHEN p_size >= 20 THEN 'HIGH'
                WHEN p_size >= 10 THEN 'MODERATE' ELSE 'LOW' END AS supply_tier
           FROM part LEFT JOIN concentration ON token_address = CAST(p_partkey AS VARCHAR)""",
    ),
    "held_amounts": _sql(
        "holdings",
        "SELECT token_address, owner, round(amount, 6) AS amount FROM holdings WHERE token_address IN (SELECT CAST(p_partkey AS VARCHAR) FROM part)",
    ),
    "outflow_report_job": ORACLES["outflow_report"],
    "security_report": f"""SELECT token_address, least(total, 100)::BIGINT AS rug_risk_score,
        CASE WHEN least(total, 100) >= 81 THEN 'CRITICAL' WHEN total >= 61 THEN 'VERY_HIGH' WHEN total >= 41 THEN 'HIGH'
             WHEN total >= 21 THEN 'MODERATE' ELSE 'LOW' END AS risk_tier,
        concat_ws('; ', CASE WHEN vendor IS NULL THEN 'holder concentration data unavailable' END,
          CASE WHEN outflow IS NULL THEN 'dev-wallet outflow data unavailable' END,
          CASE WHEN mint IS NULL THEN 'mint authority status unavailable' END,
          CASE WHEN frozen IS NULL THEN 'freeze authority status unavailable' END) AS data_gaps FROM ({_SECURITY})""",
    "security_metadata": """SELECT 'birdeye' AS source, 'security' AS domain, CAST(p_partkey AS VARCHAR) AS token_address,
        CASE WHEN p_size > 1 THEN p_size::BIGINT END AS size, CASE WHEN p_size > 1 THEN p_name END AS name FROM part""",
    "discovered": _sql("candidates", f"SELECT token_address, symbol, round(volume_24h_usd, 6) AS volume_24h_usd, holder, outcome FROM ({_SCANNED})"),
    "watchlist_scan": _sql(
        "candidates",
        f"""SELECT epoch_us(TIMESTAMP '{NOW}') AS scan_timestamp, token_address, 'INFO' AS severity,
            CASE WHEN strong AND s_nationkey < 16 THEN 'WATCHLIST' ELSE 'HOLD' END AS action,
            CASE WHEN strong AND s_nationkey < 16 THEN 0.5::DOUBLE ELSE 0.3::DOUBLE END AS confidence
            FROM (SELECT token_address, volume_24h_usd >= 50000 AND liquidity >= 20000 AND holder >= 100 AND trade_24h_count >= 200 AS strong
                  FROM ({_SCANNED}) WHERE outcome = 'valid')
            JOIN supplier ON CAST(s_suppkey AS VARCHAR) = token_address""",
    ),
    "landed_rejects": """SELECT CASE WHEN user_id % 3 = 0 THEN 'malformed' ELSE 'no_response' END AS reason, count(*) AS lines
        FROM events WHERE user_id % 3 = 0 OR user_id % 5 = 0 GROUP BY 1""",
    "news_posts": "SELECT lang AS token_address, doc_id FROM documents",
    "rss_items": """SELECT 'rss' AS source, CASE doc_id % 2 WHEN 0 THEN 'cointelegraph.com' ELSE 'coindesk.com' END AS token_address,
        doc_id * 60000000 AS event_timestamp, doc_id FROM documents
        QUALIFY row_number() OVER (PARTITION BY doc_id % 2 ORDER BY doc_id) <= 10""",
    "feed_times": "SELECT event_id, CAST(epoch_us(date_trunc('second', ts)) AS BIGINT) AS time FROM events",
    "news_report": "SELECT CASE WHEN doc_id % 3 = 0 THEN 'hack' ELSE 'other' END AS event_type, count(*) AS n FROM documents GROUP BY 1",
    "exchanged_envelopes": "SELECT CAST(user_id AS VARCHAR) AS token_address, 2 * count(*) AS messages, count(*) AS ids FROM events GROUP BY 1",
    "dead_letter_table": """SELECT CASE event_type WHEN 'signup' THEN 'time' ELSE 'price' END AS problem, count(*) AS messages
        FROM events WHERE event_type IN ('signup', 'error') GROUP BY 1""",
    "train_entry_counts": _ENTRY,
    "train_exit_counts": _EXIT,
    "fit_optimality": f"SELECT token_address, 0.0::DOUBLE AS gradient FROM ({_ENTRY})",
    "score_champion": _sql(
        "candles",
        f"""SELECT token_address, count(*) AS rows, CASE WHEN token_address IN (SELECT token_address FROM ({_ENTRY})) THEN true END AS has_model
            FROM candles GROUP BY 1""",
    ),
    "prices_as_of_all": _sql(
        "ticks",
        """SELECT a.event_id AS request_id, a.token_address, round(q.price, 6) AS price
           FROM (SELECT event_id, token_address, ts - INTERVAL 1 MINUTE AS ts FROM ticks) a
           ASOF LEFT JOIN ticks q ON a.token_address = q.token_address AND a.ts >= q.ts""",
    ),
    "scan_counts": _sql(
        "candidates",
        f"""SELECT epoch_us(TIMESTAMP '{NOW}') + poll * 3600000000 AS event_timestamp, count(*) AS received,
            count(*) FILTER (liquidity > 0 AND volume >= 0 AND volume / liquidity <= 50) AS valid
            FROM (SELECT liquidity, poll, volume_24h_usd * CASE poll WHEN 0 THEN 0.5 ELSE 1 END AS volume FROM candidates, range(2) t(poll)) GROUP BY 1""",
    ),
    "decision_reasons": _sql(
        "decided",
        """SELECT token_address, CASE act
            WHEN 'tier' THEN 'SECURITY OVERRIDE: rug-risk tier is ' || risk_tier || ' (score ' || points || '/100) - this overrides any other bullish signal'
            WHEN 'news' THEN 'SECURITY OVERRIDE: recent news classified as ' || chr(39) || news_event_type || chr(39) || ' (source credibility: ' || news_credibility
              || ') - this overrides any other bullish signal, regardless of source credibility, since even an unconfirmed report of this severity warrants caution until verified'
            ELSE concat_ws('; ', CASE WHEN risk_tier = 'LOW' THEN 'Rug-risk tier is LOW (score ' || points || '/100)' END,
              CASE WHEN prob IS NULL THEN 'Entry model probability unavailable' END,
              CASE WHEN act = 'WATCHLIST' THEN 'Discovery screening metrics (volume, liquidity, holders, trade count) are strong - this is a raw-data heuristic, NOT a model prediction, and does not by itself justify BUY' END,
              CASE WHEN act = 'BUY' THEN 'Entry model probability is ' || printf('%.2f', CAST(prob AS DOUBLE)) || ' (bullish)'
                   WHEN act = 'HOLD' AND prob IS NOT NULL THEN 'Entry model probability is ' || printf('%.2f', CAST(prob AS DOUBLE)) || ' (not strongly bullish or bearish)' END)
            END AS reasons FROM decided""",
    ),
    "promotion_reasons": _sql(
        "latest champions",
        """SELECT token_address, model_type, CASE
            WHEN first THEN 'No existing champion - promoting first model'
            WHEN gain IS NULL THEN 'Cannot compare: roc_auc missing from champion or challenger metrics'
            WHEN gain < 0.02 THEN 'ROC-AUC improvement (' || printf('%+.4f', gain) || ') is below the required minimum (0.02) - challenger is not clearly better, keeping current champion'
            ELSE 'ROC-AUC improved by ' || printf('%+.4f (%.4f -> %.4f)', gain, old_auc, auc) || '; ' || CASE
              WHEN loss > 0.01 THEN 'REJECTED despite ROC-AUC improvement: calibration (Brier score) regressed by ' || printf('%+.4f', loss)
                || ', exceeding the allowed tolerance (0.01) - the challenger may be gaming ROC-AUC via overconfident predictions'
              WHEN loss IS NOT NULL THEN 'Calibration (Brier score) did not regress meaningfully (' || printf('%+.4f', loss) || ')'
              ELSE 'Brier score unavailable for one or both models - calibration check skipped, promotion decision based on ROC-AUC alone' END
            END AS reasons
            FROM (SELECT token_address, model_type, c.run_id IS NULL AS first, l.roc_auc AS auc, c.roc_auc AS old_auc,
                         l.roc_auc - c.roc_auc AS gain, l.brier_score - c.brier_score AS loss
                  FROM latest l LEFT JOIN champions c USING (token_address, model_type))""",
    ),
    "position_values": _sql(
        "positions",
        """SELECT position_id, round(remaining_size * price, 6) AS position_value
           FROM positions LEFT JOIN (SELECT token_address, arg_max(price, event_timestamp) AS price FROM ledger
             WHERE kind = 'price' GROUP BY 1) USING (token_address) WHERE status = 'OPEN'""",
    ),
    "ema_long_series": """
        WITH RECURSIVE lagged AS (
            SELECT event_type AS token_address, CAST(event_id AS VARCHAR) AS event_id, value AS close,
                   row_number() OVER (PARTITION BY event_type ORDER BY ts, CAST(event_id AS VARCHAR)) AS rn FROM events
        ), averaged AS (
            SELECT token_address, rn, event_id, close AS ema_fast, close AS ema_slow, CAST(0 AS DOUBLE) AS macd_signal FROM lagged WHERE rn = 1
            UNION ALL
            SELECT n.token_address, n.rn, n.event_id, n.close * 2 / 13 + p.ema_fast * 11 / 13, n.close * 2 / 27 + p.ema_slow * 25 / 27,
                   0.2 * ((n.close * 2 / 13 + p.ema_fast * 11 / 13) - (n.close * 2 / 27 + p.ema_slow * 25 / 27)) + 0.8 * p.macd_signal
            FROM averaged p JOIN lagged n ON n.token_address = p.token_address AND n.rn = p.rn + 1
        )
        SELECT event_id, round(ema_fast, 6) AS ema_fast, round(ema_slow, 6) AS ema_slow, round(ema_fast - ema_slow, 6) AS macd,
               round(macd_signal, 6) AS macd_signal FROM averaged""",
}

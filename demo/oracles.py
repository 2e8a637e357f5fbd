"""DuckDB SQL for the registered queries, written from the definitions and not from the Spark code."""

from __future__ import annotations

from demo.views import DOMAINS, HEADLINES, NOW

# The categories, outlets and acute kinds of news as the definition has them, written out here so that a
# wrong word in the library shows.
NEWS_KEYWORDS = (
    ("hack", ("hack", "hacked", "hacker", "compromised")),
    ("exploit", ("exploit", "exploited", "vulnerability", "drained")),
    ("rug_allegations", ("rug pull", "rugpull", "rugged", "scam alert")),
    ("security_incident", ("security incident", "breach", "unauthorized access")),
    ("lawsuit", ("lawsuit", "sued", "sec charges", "class action")),
    ("regulation", ("regulation", "regulator", "sec ", "compliance", "banned")),
    ("delisting", ("delist", "delisting", "removed from")),
    ("exchange_listing", ("lists ", "listing", "now available on", "added to")),
    ("network_outage", ("outage", "downtime", "network down", "halted")),
    ("whale_activity", ("whale", "large transfer", "moved $")),
    ("partnership", ("partnership", "partners with", "collaborat")),
    ("developer_announcement", ("roadmap", "mainnet", "testnet", "upgrade", "release")),
    ("token_launch", ("launches", "launch of", "airdrop", "new token")),
)
CREDIBLE_DOMAINS = ("coindesk.com", "cointelegraph.com", "theblock.co", "decrypt.co", "reuters.com", "bloomberg.com")
ACUTE_NEWS = ("hack", "exploit", "rug_allegations", "security_incident")

CTES = {
    "candles": """
        SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS VARCHAR) AS token_address, ts AS event_timestamp,
               value AS close, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS volume
        FROM events WHERE value > 0""",
    "lagged": """
        SELECT *, lag(close, 1) OVER w AS l1, lag(close, 4) OVER w AS l4, lag(close, 24) OVER w AS l24,
               row_number() OVER w AS rn
        FROM candles WINDOW w AS (PARTITION BY token_address ORDER BY event_timestamp, event_id)""",
    "moved": """
        SELECT *, (close - l1) / l1 AS return_1h, (close - l4) / l4 AS return_4h, (close - l24) / l24 AS return_24h,
               coalesce(close - l1, 0) AS change
        FROM lagged""",
    "featured": """
        SELECT *,
          CASE WHEN count(close) OVER w20 >= 20 THEN avg(close) OVER w20 END AS sma_20,
          CASE WHEN count(return_1h) OVER w20 >= 20 THEN stddev_samp(return_1h) OVER w20 END AS volatility_20,
          CASE WHEN count(change) OVER w14 >= 14 THEN 100 - 100 / (1 + avg(greatest(change, 0)) OVER w14
            / CASE WHEN max(greatest(-change, 0)) OVER w14 = 0 THEN 1e-9 ELSE avg(greatest(-change, 0)) OVER w14 END)
          END AS rsi_14
        FROM moved
        WINDOW w20 AS (PARTITION BY token_address ORDER BY event_timestamp, event_id ROWS 19 PRECEDING),
               w14 AS (PARTITION BY token_address ORDER BY event_timestamp, event_id ROWS 13 PRECEDING)""",
    "averaged": """
        SELECT token_address, rn, event_id, close AS ema_fast, close AS ema_slow, CAST(0 AS DOUBLE) AS macd_signal
        FROM lagged WHERE rn = 1
        UNION ALL
        SELECT n.token_address, n.rn, n.event_id,
               n.close * 2 / 13 + p.ema_fast * 11 / 13, n.close * 2 / 27 + p.ema_slow * 25 / 27,
               0.2 * ((n.close * 2 / 13 + p.ema_fast * 11 / 13) - (n.close * 2 / 27 + p.ema_slow * 25 / 27))
                 + 0.8 * p.macd_signal
        FROM averaged p JOIN lagged n ON n.token_address = p.token_address AND n.rn = p.rn + 1""",
    "signalled": """
        SELECT *, CASE WHEN rsi_14 < 30 THEN 'BUY' WHEN rsi_14 > 70 THEN 'SELL' ELSE 'HOLD' END AS signal FROM featured""",
    "latched": """
        SELECT *, coalesce(last_value(CASE signal WHEN 'BUY' THEN 1 WHEN 'SELL' THEN 0 END IGNORE NULLS) OVER (
            PARTITION BY token_address ORDER BY event_timestamp, event_id
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS position
        FROM signalled""",
    "charged": """
        SELECT *, CASE WHEN position <> coalesce(lag(position) OVER (
            PARTITION BY token_address ORDER BY event_timestamp, event_id), 0) THEN CAST(0.001 AS DOUBLE) ELSE 0 END AS cost
        FROM latched""",
    "earned": """
        SELECT *, position * coalesce(return_1h, 0) - cost AS strategy_return FROM charged""",
    "curved": """
        SELECT *, 1000 * product(1 + strategy_return) OVER w AS equity,
               1000 * product(1 + coalesce(return_1h, 0)) OVER w AS buy_hold_equity
        FROM earned
        WINDOW w AS (PARTITION BY token_address ORDER BY event_timestamp, event_id
                     ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
    "drawn": """
        SELECT *, (equity - max(equity) OVER w) / max(equity) OVER w AS drawdown FROM curved
        WINDOW w AS (PARTITION BY token_address ORDER BY event_timestamp, event_id
                     ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
    "standard": """
        SELECT token_address, (close - avg(close) OVER t) / stddev_pop(close) OVER t AS z, avg(close) OVER t AS mean,
               stddev_pop(close) OVER t AS scale, count(*) OVER t AS n_train,
               CASE WHEN CAST(volume AS BIGINT) % 3 = 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS y
        FROM candles WINDOW t AS (PARTITION BY token_address)""",
    "newton": """
        SELECT DISTINCT token_address, mean, scale, n_train, 0 AS step, 0.0::DOUBLE AS w, 0.0::DOUBLE AS b FROM standard
        UNION ALL
        SELECT token_address, mean, scale, n_train, step + 1,
               w - (hbb * (w + sw) - hwb * gb) / (hww * hbb - hwb * hwb), b - (hww * gb - hwb * (w + sw)) / (hww * hbb - hwb * hwb)
        FROM (SELECT token_address, mean, scale, n_train, step, w, b, sum((p - y) * z) AS sw, sum(p - y) AS gb,
                     1 + sum(p * (1 - p) * z * z) AS hww, sum(p * (1 - p) * z) AS hwb, sum(p * (1 - p)) AS hbb
              FROM (SELECT n.token_address, n.mean, n.scale, n.n_train, n.step, n.w, n.b, s.z, s.y, 1 / (1 + exp(-(n.w * s.z + n.b))) AS p
                    FROM newton n JOIN standard s ON s.token_address = n.token_address WHERE n.step < 40)
              GROUP BY ALL)""",
    "holdings": """
        SELECT CAST(l_partkey AS VARCHAR) AS token_address, CAST(l_suppkey AS VARCHAR) AS owner,
               sum(l_quantity) AS amount
        FROM lineitem GROUP BY ALL""",
    "shares": """
        SELECT *, row_number() OVER (PARTITION BY token_address ORDER BY amount DESC, owner) AS place
        FROM holdings""",
    "concentration": """
        SELECT token_address, count(*) AS holder_count, sum(amount) FILTER (place <= 10) / sum(amount) AS top10_share,
               sum(amount * amount) / (sum(amount) * sum(amount)) AS hhi
        FROM shares GROUP BY token_address""",
    "verdicts": """
        SELECT c.token_address, c.top10_share,
               CASE WHEN p_size % 5 <> 0 THEN p_size * 2.0 / 100 END AS vendor
        FROM concentration c JOIN part p ON c.token_address = CAST(p.p_partkey AS VARCHAR)""",
    "sent": """
        SELECT CAST(l_suppkey AS VARCHAR) AS wallet, CAST(l_partkey AS VARCHAR) AS token_address,
               CASE WHEN l_returnflag <> 'N' THEN l_quantity END AS amount,
               CASE WHEN l_tax > 0 THEN l_shipdate END AS sent_at
        FROM lineitem WHERE l_linestatus = 'O'
        UNION ALL
        SELECT CAST(l_suppkey AS VARCHAR), 'fee', l_tax, CASE WHEN l_tax > 0 THEN l_shipdate END FROM lineitem""",
    "flows": f"""
        SELECT wallet, token_address, coalesce(sum(amount), 0) AS total_outflow, count(*) AS outflow_count,
               max(sent_at) AS latest_outflow,
               coalesce(max(sent_at) >= TIMESTAMP '{NOW}' - INTERVAL 30 DAY, false) AS has_recent_outflow
        FROM sent GROUP BY wallet, token_address""",
    "scored": """
        SELECT *, CASE WHEN points >= 81 THEN 'CRITICAL' WHEN points >= 61 THEN 'VERY_HIGH' WHEN points >= 41 THEN 'HIGH'
                       WHEN points >= 21 THEN 'MODERATE' ELSE 'LOW' END AS risk_tier
        FROM (SELECT *, least(100, coalesce(tier_points, 0) + CASE WHEN outflow THEN 25 ELSE 0 END
                + CASE WHEN mint THEN 20 ELSE 0 END + CASE WHEN frozen THEN 15 ELSE 0 END) AS points
              FROM (SELECT *, CASE tier WHEN 'CRITICAL' THEN 50 WHEN 'VERY_HIGH' THEN 40 WHEN 'HIGH' THEN 30
                                        WHEN 'MODERATE' THEN 15 WHEN 'LOW' THEN 0 END AS tier_points FROM facts))""",
    "facts": """
        SELECT CAST(p_partkey AS VARCHAR) AS token_address, p_partkey, p_size,
               'src' || (p_partkey % 23) AS symbol,
               CASE WHEN vendor >= 0.8 THEN 'CRITICAL' WHEN vendor >= 0.6 THEN 'VERY_HIGH' WHEN vendor >= 0.4 THEN 'HIGH'
                    WHEN vendor >= 0.2 THEN 'MODERATE' WHEN vendor IS NOT NULL THEN 'LOW' END AS tier,
               f.outflow,
               CASE p_size % 4 WHEN 3 THEN NULL ELSE p_size % 4 < 2 END AS mint,
               CASE p_size % 4 WHEN 3 THEN NULL ELSE p_size % 4 = 0 END AS frozen
        FROM part p
        LEFT JOIN verdicts v ON v.token_address = CAST(p.p_partkey AS VARCHAR)
        LEFT JOIN (SELECT token_address, bool_or(has_recent_outflow) AS outflow FROM flows GROUP BY 1) f
               ON f.token_address = CAST(p.p_partkey AS VARCHAR)""",
    "news": f"""
        SELECT doc_id, source AS topic,
               lower(text || ' ' || (list_value({", ".join(f"'{h}'" for h in HEADLINES)}))[doc_id % {len(HEADLINES)} + 1] || ' ') AS body,
               (list_value({", ".join(f"'{d}'" for d in DOMAINS)}))[doc_id % {len(DOMAINS)} + 1] AS domain,
               doc_id % {len(DOMAINS)} AS feed_rank
        FROM documents""",
    "classified": "SELECT *, CASE "
    + " ".join(
        f"""WHEN {" OR ".join(f"contains(body, '{k}')" for k in words)} THEN '{name}'""" for name, words in NEWS_KEYWORDS
    )
    + """ ELSE 'other' END AS event_type,
        CASE WHEN regexp_replace(lower(domain), '^www\\.', '') IN ("""
    + ", ".join(f"'{d}'" for d in CREDIBLE_DOMAINS)
    + ") THEN 'HIGH' ELSE 'UNKNOWN' END AS credibility FROM news",
    "topics": """
        SELECT topic, event_type AS news_event_type, credibility AS news_credibility FROM classified
        WHERE event_type <> 'other'
        QUALIFY row_number() OVER (PARTITION BY topic ORDER BY feed_rank, doc_id) = 1""",
    "decided": f"""
        SELECT *, CASE WHEN act IN ('tier', 'news') THEN true ELSE false END AS override_triggered,
          CASE act WHEN 'tier' THEN 'AVOID' WHEN 'news' THEN 'AVOID' WHEN 'weak' THEN 'AVOID' ELSE act END AS action,
          CASE act WHEN 'tier' THEN 0.9 WHEN 'news' THEN 0.75 WHEN 'WATCHLIST' THEN 0.5 WHEN 'BUY' THEN least(prob, 0.85)
                   WHEN 'weak' THEN 0.6 ELSE CASE WHEN prob IS NULL THEN 0.3 ELSE 0.4 END END AS confidence
        FROM (
          SELECT *, CASE
              WHEN risk_tier IN ('CRITICAL', 'VERY_HIGH') THEN 'tier'
              WHEN news_event_type IN ({", ".join(f"'{n}'" for n in ACUTE_NEWS)}) THEN 'news'
              WHEN prob IS NULL AND p_size % 3 = 0 AND risk_tier IN ('LOW', 'MODERATE') THEN 'WATCHLIST'
              WHEN prob IS NULL THEN 'HOLD'
              WHEN prob >= 0.6 AND risk_tier IN ('LOW', 'MODERATE') THEN 'BUY'
              WHEN prob <= 0.3 OR risk_tier = 'HIGH' THEN 'weak'
              ELSE 'HOLD' END AS act
          FROM (SELECT s.*, t.news_event_type, t.news_credibility,
                       CASE WHEN p_partkey % 4 <> 0 THEN (p_partkey * 37 % 100) / 100.0 END AS prob
                FROM scored s LEFT JOIN topics t ON s.symbol = t.topic))""",
    "candidates": """
        SELECT CAST(s_suppkey AS VARCHAR) AS token_address, s_name AS symbol, s_acctbal * 100 AS liquidity,
               CASE WHEN s_nationkey <> 3 THEN volume / 10 END AS volume_24h_usd, holder, trade_24h_count
        FROM supplier LEFT JOIN (SELECT l_suppkey, sum(l_extendedprice) AS volume, count(DISTINCT l_orderkey) AS holder,
                                        count(*) AS trade_24h_count FROM lineitem GROUP BY 1) ON l_suppkey = s_suppkey""",
    "judged": """
        SELECT *, CASE WHEN liquidity IS NULL OR liquidity <= 0 THEN 'bad_liquidity'
                       WHEN volume_24h_usd IS NULL OR volume_24h_usd < 0 THEN 'bad_volume'
                       WHEN volume_24h_usd / liquidity > 50 THEN 'volume_to_liquidity' ELSE 'valid' END AS outcome
        FROM candidates""",
    "runs": """
        SELECT CAST(o_custkey AS VARCHAR) AS token_address, CASE WHEN o_orderkey % 2 = 0 THEN 'entry' ELSE 'exit' END AS model_type,
               CAST(o_orderkey AS VARCHAR) AS run_id, o_orderdate AS start_time, o_custkey,
               CASE WHEN o_orderkey % 11 <> 0 THEN 0.4 + (o_orderkey * 7919 % 500) / CAST(1000 AS DOUBLE) END AS roc_auc,
               CASE WHEN o_orderkey % 13 <> 0 THEN 0.1 + (o_orderkey * 104729 % 40) / CAST(1000 AS DOUBLE) END AS brier_score
        FROM orders""",
    "latest": """
        SELECT * FROM runs
        QUALIFY row_number() OVER (PARTITION BY token_address, model_type ORDER BY start_time DESC, run_id DESC) = 1""",
    "champions": """
        SELECT * FROM runs WHERE o_custkey % 3 <> 0 AND start_time < TIMESTAMP '1998-01-01'
        QUALIFY row_number() OVER (PARTITION BY token_address, model_type ORDER BY start_time DESC, run_id DESC) = 1""",
    "judgements": """
        SELECT l.*, c.run_id IS NULL AS first, l.roc_auc - c.roc_auc AS gain, l.brier_score - c.brier_score AS loss
        FROM latest l LEFT JOIN champions c USING (token_address, model_type)""",
    "promotions": """
        SELECT *, first OR (coalesce(gain >= 0.02, false) AND NOT coalesce(loss > 0.01, false)) AS promote,
               CASE WHEN first OR gain IS NULL OR gain < 0.02 THEN 1 ELSE 2 END AS n_reasons
        FROM judgements""",
    "ledger": """
        SELECT user_id AS position_id, 'token-' || (user_id % 7) AS token_address, ts AS event_timestamp,
               CAST(event_id AS VARCHAR) AS event_id, value AS price,
               CASE WHEN n = 1 THEN 'open' WHEN event_type IN ('purchase', 'error') THEN 'sell' ELSE 'price' END AS kind,
               CASE WHEN n > 1 AND event_type IN ('purchase', 'error') THEN
                 CASE WHEN k % 10 = 0 THEN 0.0 WHEN event_type = 'error' AND k % 3 = 0 THEN 1.0 ELSE 0.2 END END AS f,
               first_value(value) OVER (PARTITION BY user_id ORDER BY ts, CAST(event_id AS VARCHAR)) AS entry,
               first_value(ts) OVER (PARTITION BY user_id ORDER BY ts, CAST(event_id AS VARCHAR)) AS opened
        FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
                     row_number() OVER (PARTITION BY user_id ORDER BY ts, CAST(event_id AS VARCHAR)) AS n FROM events)""",
    "stated": """
        SELECT *, coalesce(bool_or(f = 1.0) OVER before, false) AS was_closed,
               10 * coalesce(product(CASE WHEN f > 0 THEN 1 - f END) OVER before, 1) AS held
        FROM ledger WINDOW before AS (PARTITION BY position_id ORDER BY event_timestamp, event_id
                                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""",
    "reviewed": """
        SELECT *, CASE WHEN kind = 'open' AND NOT entry > 0 THEN 'bad_open' WHEN NOT entry > 0 THEN 'no_position'
                       WHEN kind = 'sell' AND NOT f > 0 THEN 'bad_sell'
                       WHEN was_closed THEN 'closed' END AS reason
        FROM stated""",
    "sold": """
        SELECT position_id, event_id, f AS sell_fraction, held * f AS amount_sold,
               held * f * (price - entry) AS realized_pnl, held - held * f AS remaining_size
        FROM reviewed WHERE kind = 'sell' AND reason IS NULL""",
    "positions": """
        SELECT r.position_id, min(token_address) AS token_address, min(entry) AS entry_price, min(opened) AS opened,
               coalesce(min(remaining_size), 10) AS remaining_size,
               max(CASE WHEN kind IN ('open', 'price') THEN price END) AS highest_price,
               coalesce(sum(realized_pnl), 0) AS realized_pnl, count(remaining_size) AS sales,
               CASE WHEN coalesce(min(remaining_size), 10) <= 1e-12 THEN 'CLOSED' ELSE 'OPEN' END AS status
        FROM reviewed r LEFT JOIN sold s USING (position_id, event_id) WHERE reason IS NULL GROUP BY r.position_id""",
    "ticks": """
        SELECT CAST(event_id AS VARCHAR) AS event_id, event_type AS token_address, ts, value AS price FROM events""",
    "windowed": """
        SELECT *, first_value(price) OVER w AS base, first_value(ts) OVER w AS base_ts, count(*) OVER w AS n
        FROM ticks WINDOW w AS (PARTITION BY token_address ORDER BY ts RANGE BETWEEN INTERVAL 6 HOUR PRECEDING AND CURRENT ROW)""",
    "alerts": """
        SELECT *, (price - base) / base AS change FROM windowed WHERE n >= 2 AND base <> 0""",
}

NEEDS = {
    "lagged": ["candles"],
    "moved": ["lagged"],
    "featured": ["moved"],
    "averaged": ["lagged"],
    "signalled": ["featured"],
    "latched": ["signalled"],
    "charged": ["latched"],
    "earned": ["charged"],
    "curved": ["earned"],
    "drawn": ["curved"],
    "standard": ["candles"],
    "newton": ["standard"],
    "shares": ["holdings"],
    "concentration": ["shares"],
    "verdicts": ["concentration"],
    "flows": ["sent"],
    "facts": ["verdicts", "flows"],
    "scored": ["facts"],
    "classified": ["news"],
    "topics": ["classified"],
    "decided": ["scored", "topics"],
    "judged": ["candidates"],
    "latest": ["runs"],
    "champions": ["runs"],
    "judgements": ["latest", "champions"],
    "promotions": ["judgements"],
    "stated": ["ledger"],
    "reviewed": ["stated"],
    "sold": ["reviewed"],
    "positions": ["reviewed", "sold"],
    "windowed": ["ticks"],
    "alerts": ["windowed"],
}


def _chain(name: str, done: list[str]) -> list[str]:
    for need in NEEDS.get(name, []):
        _chain(need, done)
    if name not in done:
        done.append(name)
    return done


def _sql(tables: str, select: str) -> str:
    """``select`` behind the CTEs it needs."""
    done: list[str] = []
    for name in tables.split():
        _chain(name, done)
    body = ",\n".join(f"{n} AS ({CTES[n]})" for n in done)
    return f"WITH RECURSIVE {body}\n{select}"


def _micros(name: str, alias: str | None = None) -> str:
    return f"epoch_us({name}) AS {alias or name}"


def _places(*names: str) -> str:
    return ", ".join(f"round({n}, 6) AS {n}" for n in names)


_MARKET = """
    SELECT CAST(user_id AS VARCHAR) AS token_address, epoch_us(ts) AS event_timestamp, value,
           CAST(CAST(value - 5 AS DECIMAL(18, 2)) AS DOUBLE) AS low,
           CAST(json_extract_string(props, '$.k') AS DOUBLE) AS volume FROM events"""
_METRICS = """
    SELECT token_address, round(total, 6) AS total_return, round(hold, 6) AS buy_hold_return,
           round(total - hold, 6) AS return_vs_buy_hold,
           round(CASE WHEN sd > 0 THEN mean / sd * sqrt(8760) ELSE 0 END, 6) AS sharpe_ratio,
           round(CASE WHEN down > 0 THEN mean / down * sqrt(8760) ELSE 0 END, 6) AS sortino_ratio,
           round(max_drawdown, 6) AS max_drawdown,
           round(CASE WHEN active > 0 THEN wins / active ELSE 0 END, 6) AS win_rate,
           CASE WHEN losses > 0 THEN round(won / abs(lost), 6) WHEN wins > 0 THEN CAST('Infinity' AS DOUBLE) ELSE 0 END AS profit_factor,
           round(mean, 6) AS expected_value_per_period, active AS num_active_periods
    FROM (SELECT token_address, arg_max(equity, rn) / 1000 - 1 AS total, arg_max(buy_hold_equity, rn) / 1000 - 1 AS hold,
                 avg(strategy_return) AS mean, stddev_samp(strategy_return) AS sd,
                 stddev_samp(strategy_return) FILTER (strategy_return < 0) AS down, min(drawdown) AS max_drawdown,
                 count(*) FILTER (position = 1) AS active,
                 count(*) FILTER (position = 1 AND strategy_return > 0) AS wins,
                 count(*) FILTER (position = 1 AND strategy_return < 0) AS losses,
                 sum(strategy_return) FILTER (position = 1 AND strategy_return > 0) AS won,
                 sum(strategy_return) FILTER (position = 1 AND strategy_return < 0) AS lost
          FROM drawn GROUP BY token_address)"""
_LABEL = "WINDOW w AS (PARTITION BY token_address ORDER BY event_timestamp, event_id)"
_LADDER = " ".join(
    f"WHEN lead(close, {k}) OVER w >= close * (1 + 0.01) THEN 1 WHEN lead(close, {k}) OVER w <= close * (1 - 0.01) THEN 0"
    for k in range(1, 7)
)
_ENTRY = f"CAST(CASE WHEN lead(rn, 6) OVER w IS NULL THEN NULL {_LADDER} ELSE 0 END AS DOUBLE) AS label"
_ALERTS = f"""
    SELECT token_address, event_id, change AS pct_change, base AS window_start_price,
           price AS current_price, {_micros("base_ts", "window_start_time")}, {_micros("ts", "alert_time")},
           CASE WHEN abs(change) >= 0.2 THEN 'CRITICAL' WHEN abs(change) >= 0.1 THEN 'HIGH'
                WHEN abs(change) >= 0.05 THEN 'WARNING' ELSE 'WATCH' END AS severity
    FROM alerts WHERE abs(change) >= 0.02"""
_VERDICT = """CASE WHEN {0} >= 0.8 THEN 'CRITICAL' WHEN {0} >= 0.6 THEN 'VERY_HIGH' WHEN {0} >= 0.4 THEN 'HIGH'
    WHEN {0} >= 0.2 THEN 'MODERATE' WHEN {0} IS NOT NULL THEN 'LOW' END"""
_MATCHED = (
    "CASE event_type "
    + " ".join(
        f"WHEN '{name}' THEN array_to_string(list_filter([{', '.join(repr(w) for w in words)}], lambda x: contains(body, x)), ',')"
        for name, words in NEWS_KEYWORDS
    )
    + " ELSE '' END"
)

_RISKS = """CASE act WHEN 'tier' THEN 'Rug-risk tier: ' || risk_tier WHEN 'news' THEN 'News event: ' || news_event_type
             ELSE concat_ws('; ', CASE WHEN risk_tier IN ('HIGH', 'MODERATE') THEN 'Rug-risk tier is ' || risk_tier || ' (score ' || points || '/100)' END,
               CASE WHEN act = 'weak' AND prob <= 0.3 THEN 'Entry model probability is ' || printf('%.2f', CAST(prob AS DOUBLE)) || ' (bearish)' END) END"""

ORACLES: dict[str, str] = {
    "silver_valid": f"""SELECT token_address, event_timestamp, value AS open, value AS high, low, value AS close, volume, 'usd' AS currency
        FROM ({_MARKET}) WHERE value > 0 AND low > 0 AND volume >= 0""",
    "silver_quarantine": f"""SELECT token_address, event_timestamp, low, value AS close,
        CASE WHEN value > 0 THEN 'low_out_of_range' ELSE 'open_out_of_range,high_out_of_range,low_out_of_range,close_out_of_range' END AS reasons
        FROM ({_MARKET}) WHERE NOT (value > 0 AND low > 0 AND volume >= 0)""",
    "event_dedup": """SELECT CAST(user_id AS VARCHAR) AS token_address, epoch_us(ts) AS event_timestamp,
        epoch_us(ts) + 60000000 AS ingestion_timestamp FROM events""",
    "event_id_hash": """SELECT event_id AS row_id, sha256('demo|' || user_id || '|' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%f')
        || '+00:00|' || sha256('{"props":{"k":' || json_extract_string(props, '$.k') || '},"type":"' || event_type || '"}')) AS event_key
        FROM events""",
    "bronze_partition_counts": """SELECT 'market' AS domain, strftime(ts, '%Y-%m-%d') AS dt, CAST(user_id AS VARCHAR) AS token_address,
        2 * count(*) AS events FROM events GROUP BY ALL""",
    "latest_partition": """SELECT event_id, strftime(ts, '%Y-%m-%d') AS dt, value FROM events
        WHERE CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events)""",
    "returns": _sql("moved", "SELECT event_id, return_1h, return_4h, return_24h FROM moved"),
    "sma": _sql("featured", f"SELECT event_id, {_places('sma_20')} FROM featured"),
    "volatility": _sql("featured", f"SELECT event_id, {_places('volatility_20')} FROM featured"),
    "rsi": _sql("featured", f"SELECT event_id, {_places('rsi_14')} FROM featured"),
    "ema_macd": _sql(
        "averaged",
        """SELECT event_id, round(ema_fast, 6) AS ema_fast, round(ema_slow, 6) AS ema_slow,
           round(ema_fast - ema_slow, 6) AS macd, round(macd_signal, 6) AS macd_signal FROM averaged""",
    ),
    "token_features": _sql(
        "featured averaged",
        f"""SELECT f.event_id, f.token_address, {_micros("event_timestamp")}, return_1h, return_4h, return_24h, {_places("close", "volume", "sma_20", "volatility_20", "rsi_14", "ema_fast", "ema_slow", "macd_signal")},
            round(ema_fast - ema_slow, 6) AS macd FROM featured f JOIN averaged a USING (event_id)""",
    ),
    "rsi_signals": _sql("signalled", "SELECT event_id, signal FROM signalled"),
    "positions_latch": _sql("latched", "SELECT event_id, signal, CAST(position AS BIGINT) AS position FROM latched"),
    "equity_curve": _sql(
        "drawn", f"SELECT event_id, {_places('cost', 'strategy_return', 'equity', 'buy_hold_equity', 'drawdown')} FROM drawn"
    ),
    "backtest_metrics": _sql("drawn", _METRICS),
    "triple_barrier": _sql("lagged", f"SELECT event_id, {_ENTRY} FROM lagged {_LABEL}"),
    "exit_label": _sql(
        "lagged",
        f"""SELECT event_id, CAST(CASE WHEN lead(rn, 3) OVER w IS NULL THEN NULL
            WHEN (least(lead(close, 1) OVER w, lead(close, 2) OVER w, lead(close, 3) OVER w) - close) / close <= -0.01 THEN 1 ELSE 0 END AS DOUBLE) AS exit_label
            FROM lagged {_LABEL}""",
    ),
    "simulated_position_features": _sql(
        "lagged",
        """SELECT event_id, (close - l4) / l4 AS unrealized_return, CAST(4 AS BIGINT) AS periods_held,
           (close - max(close) OVER h) / max(close) OVER h AS drawdown_from_high
           FROM lagged WINDOW h AS (PARTITION BY token_address ORDER BY event_timestamp, event_id ROWS 3 PRECEDING)""",
    ),
    "chronological_split": _sql(
        "lagged",
        """SELECT event_id, rn <= floor(count(*) OVER (PARTITION BY token_address) * CAST(0.8 AS DOUBLE)) AS is_train FROM lagged""",
    ),
    "training_ready": _sql(
        "featured",
        f"""SELECT token_address, count(*) AS n_rows, count(*) FILTER (place <= last_train) AS n_train
            FROM (SELECT *, row_number() OVER (PARTITION BY token_address ORDER BY event_timestamp, event_id) AS place,
                         floor(count(*) OVER (PARTITION BY token_address) * CAST(0.8 AS DOUBLE)) AS last_train
                  FROM (SELECT *, {_ENTRY} FROM featured {_LABEL})
                  WHERE label IS NOT NULL AND return_24h IS NOT NULL AND sma_20 IS NOT NULL AND volatility_20 IS NOT NULL AND rsi_14 IS NOT NULL)
            GROUP BY token_address HAVING count(*) >= 20 AND count(DISTINCT label) FILTER (place <= last_train) = 2""",
    ),
    "fit_model": _sql(
        "newton",
        """SELECT token_address, round(mean, 9) AS mean, round(scale, 6) AS scale, round(w, 6) AS coef, round(b, 6) AS intercept, n_train
           FROM newton WHERE step = 40""",
    ),
    "score_model": _sql(
        "candles",
        """SELECT event_id, round(1 / (1 + exp(-(0.1 + 0.5 * (close - avg(close) OVER t) / stddev_pop(close) OVER t
           - 0.25 * (volume - avg(volume) OVER t) / stddev_pop(volume) OVER t))), 6) AS probability
           FROM candles WINDOW t AS (PARTITION BY token_address)""",
    ),
    "classifier_metrics": """
        WITH s AS (SELECT event_type AS token_address, value / (value + 40) AS p,
                          CASE WHEN CAST(json_extract_string(props, '$.k') AS INTEGER) % 3 = 0 THEN 1 ELSE 0 END AS y FROM events),
        r AS (SELECT *, rank() OVER (PARTITION BY token_address ORDER BY p)
                + (count(*) OVER (PARTITION BY token_address, p) - 1) / 2.0 AS mid FROM s),
        a AS (SELECT token_address, count(*) AS n_test, count(*) FILTER (p > 0.5 AND y = 1) AS tp,
                     count(*) FILTER (p > 0.5 AND y = 0) AS fp, count(*) FILTER (p <= 0.5 AND y = 1) AS fn,
                     avg((p - y) * (p - y)) AS brier, avg(y) AS rate, sum(mid) FILTER (y = 1) AS ranks,
                     sum(y) AS pos, count(*) - sum(y) AS neg FROM r GROUP BY 1)
        SELECT token_address, round(CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END, 6) AS precision,
               round(CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END, 6) AS recall,
               round(CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0 END, 6) AS f1,
               round((ranks - pos * (pos + 1) / 2) / (pos * neg), 6) AS roc_auc, round(brier, 6) AS brier_score,
               round(rate, 6) AS positive_rate_test, n_test FROM a""",
    "promotion_decisions": _sql(
        "promotions", f"SELECT token_address, model_type, run_id, {_places('roc_auc')}, promote, n_reasons FROM promotions"
    ),
    "champion_upsert": _sql(
        "promotions",
        f"""SELECT token_address, model_type, run_id, {_places("roc_auc", "brier_score")} FROM promotions WHERE promote
            UNION ALL
            SELECT token_address, model_type, c.run_id, round(c.roc_auc, 6), round(c.brier_score, 6)
            FROM champions c LEFT JOIN (SELECT * FROM promotions WHERE promote) p USING (token_address, model_type) WHERE p.run_id IS NULL""",
    ),
    "holder_concentration": _sql(
        "concentration",
        f"SELECT token_address, holder_count, top10_share, hhi, {_VERDICT.format('top10_share')} AS risk_tier FROM concentration",
    ),
    "holder_tiers": _sql(
        "verdicts",
        f"""SELECT token_address, round(coalesce(vendor, top10_share), 6) AS verdict_share,
            CASE WHEN vendor IS NULL THEN 'sample' ELSE 'supply' END AS verdict_basis,
            {_VERDICT.format("coalesce(vendor, top10_share)")} AS verdict_tier, {_VERDICT.format("vendor")} AS supply_tier FROM verdicts""",
    ),
    "wallet_outflows": _sql(
        "flows",
        f"SELECT wallet, token_address, {_places('total_outflow')}, outflow_count, {_micros('latest_outflow')}, has_recent_outflow FROM flows",
    ),
    "mint_flags": """SELECT CAST(p_partkey AS VARCHAR) AS token_address,
        CASE WHEN p_size % 4 <> 3 THEN p_size % 4 < 2 END AS mint_active,
        CASE WHEN p_size % 4 <> 3 THEN p_size % 4 = 0 END AS freeze_active FROM part""",
    "rug_score": _sql(
        "scored",
        """SELECT token_address, CAST(points AS BIGINT) AS rug_risk_score, risk_tier,
           CASE WHEN tier_points > 0 OR outflow OR mint OR frozen THEN concat_ws('; ',
             CASE WHEN tier_points > 0 THEN 'Holder concentration is ' || tier || ' (+' || tier_points || ' points)' END,
             CASE WHEN outflow THEN 'Monitored wallet sent tokens out within the last 24h (+25 points)' END,
             CASE WHEN mint THEN 'Mint authority is still active - supply can be increased at will (+20 points)' END,
             CASE WHEN frozen THEN 'Freeze authority is still active - holder accounts can be frozen (+15 points)' END)
           ELSE 'No red flags detected in the signals that were available' END AS reasons,
           concat_ws('; ', CASE WHEN tier IS NULL THEN 'holder concentration data unavailable' END,
             CASE WHEN outflow IS NULL THEN 'dev-wallet outflow data unavailable' END,
             CASE WHEN mint IS NULL THEN 'mint authority status unavailable' END,
             CASE WHEN frozen IS NULL THEN 'freeze authority status unavailable' END) AS data_gaps FROM scored""",
    ),
    "news_events": _sql("classified", f"SELECT doc_id, event_type, {_MATCHED} AS matched_keywords FROM classified"),
    "news_credibility": _sql("classified", "SELECT doc_id, credibility FROM classified"),
    "url_domains": r"""SELECT page_id, regexp_replace(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1), '^www\.', '') AS domain FROM pages""",
    "news_signal": _sql("topics", "SELECT * FROM topics"),
    "screen_candidates": _sql(
        "candidates",
        f"""SELECT token_address, symbol, {_places("liquidity", "volume_24h_usd")}, holder, trade_24h_count FROM candidates
            WHERE liquidity >= 5000 AND liquidity <= 900000 AND volume_24h_usd >= 10000 AND holder >= 20 AND trade_24h_count >= 50
            ORDER BY candidates.volume_24h_usd DESC, token_address LIMIT 25 OFFSET 5""",
    ),
    "candidate_quality": _sql("judged", "SELECT token_address, outcome FROM judged"),
    "candidate_counts": _sql("judged", "SELECT outcome, count(*) AS n FROM judged GROUP BY outcome"),
    "momentum": _sql(
        "candidates",
        """SELECT token_address, CASE
             WHEN volume_24h_usd >= 50000 AND liquidity >= 20000 AND holder >= 100 AND trade_24h_count >= 200 THEN 'STRONG'
             WHEN volume_24h_usd >= 10000 AND liquidity >= 5000 AND holder >= 50 AND trade_24h_count >= 50 THEN 'MODERATE' END AS momentum_tier
           FROM candidates""",
    ),
    "top_candidates": _sql(
        "candidates",
        f"SELECT token_address, {_places('volume_24h_usd')} FROM candidates ORDER BY coalesce(candidates.volume_24h_usd, 0) DESC, token_address LIMIT 10",
    ),
    "decisions": _sql(
        "decided",
        f"""SELECT token_address, action, round(CAST(confidence AS DOUBLE), 6) AS confidence, override_triggered,
           CAST(CASE WHEN act IN ('tier', 'news') THEN 1 ELSE
             CASE WHEN risk_tier = 'LOW' THEN 1 ELSE 0 END + CASE WHEN prob IS NULL THEN 1 ELSE 0 END
             + CASE WHEN act = 'WATCHLIST' OR act = 'BUY' OR (act = 'HOLD' AND prob IS NOT NULL) THEN 1 ELSE 0 END END AS BIGINT) AS n_reasons,
           {_RISKS} AS risks
           FROM decided""",
    ),
    "watchlist_ranked": _sql(
        "decided",
        """SELECT row_number() OVER (ORDER BY CASE severity WHEN 'CRITICAL' THEN 1 WHEN 'HIGH' THEN 2 WHEN 'WARNING' THEN 3 WHEN 'WATCH' THEN 4 ELSE 5 END,
             confidence DESC, token_address) AS rank, token_address, severity, round(confidence, 6) AS confidence
           FROM (SELECT token_address, CAST(confidence AS DOUBLE) AS confidence,
                   CASE WHEN override_triggered AND confidence >= 0.85 THEN 'CRITICAL' WHEN override_triggered THEN 'HIGH'
                        WHEN action = 'BUY' AND confidence >= 0.7 THEN 'WATCH' ELSE 'INFO' END AS severity FROM decided)""",
    ),
    "watchlist_union": _sql(
        "judged",
        """SELECT CAST(n_nationkey AS VARCHAR) AS token_address, 'manual' AS source FROM nation
           UNION ALL SELECT token_address, 'discovered' FROM judged
           WHERE outcome = 'valid' AND token_address NOT IN (SELECT CAST(n_nationkey AS VARCHAR) FROM nation)""",
    ),
    "position_ledger": _sql(
        "positions",
        f"""SELECT position_id, token_address, {_places("entry_price")}, {_micros("opened", "entry_timestamp")}, CAST(10 AS DOUBLE) AS initial_size,
            {_places("remaining_size", "highest_price", "realized_pnl")}, sales, status FROM positions""",
    ),
    "position_sales": _sql(
        "sold",
        f"SELECT position_id, event_id, CAST(sell_fraction AS DOUBLE) AS sell_fraction, {_places('amount_sold', 'realized_pnl', 'remaining_size')} FROM sold",
    ),
    "position_rejections": _sql("reviewed", "SELECT position_id, event_id, reason FROM reviewed WHERE reason IS NOT NULL"),
    "open_positions_pnl": _sql(
        "positions",
        """SELECT position_id, round(remaining_size, 6) AS remaining_size, round(price, 6) AS current_price,
           round(remaining_size * (price - entry_price), 6) AS unrealized_pnl,
           round((price - entry_price) / entry_price, 6) AS unrealized_pnl_pct
           FROM positions LEFT JOIN (SELECT token_address, arg_max(price, event_timestamp) AS price FROM ledger
             WHERE kind = 'price' AND token_address <> 'token-3' GROUP BY 1) USING (token_address) WHERE status = 'OPEN'""",
    ),
    "prices_as_of": _sql(
        "ticks",
        """SELECT a.event_id AS request_id, round(q.price, 6) AS price
           FROM (SELECT * FROM ticks WHERE token_address = 'purchase') a
           ASOF LEFT JOIN (SELECT * FROM ticks WHERE token_address = 'view') q ON a.ts >= q.ts""",
    ),
    "price_alerts": _sql("alerts", _ALERTS),
    "price_alerts_stream": _sql("alerts", _ALERTS),
    "late_ticks": """
        WITH s AS (SELECT event_type, ts, floor((epoch_us(ts) - min(epoch_us(ts)) OVER ()) * 4
                          / (max(epoch_us(ts)) OVER () - min(epoch_us(ts)) OVER () + 1)) AS part FROM events)
        SELECT event_type AS token_address, count(*) AS late FROM s
        WHERE part = 2 AND ts < (SELECT max(ts) FROM s WHERE part <> 2) - INTERVAL 1 MINUTE GROUP BY 1""",
    "backfill_chunks": """
        WITH spans AS (SELECT CAST(o_custkey AS VARCHAR) AS token_address, CAST(epoch(min(o_orderdate)) AS BIGINT) AS a,
                              CAST(epoch(max(o_orderdate)) AS BIGINT) AS b FROM orders GROUP BY 1)
        SELECT token_address, '4H' AS interval, i AS chunk, a + i * 12960000 AS time_from, least(a + (i + 1) * 12960000, b) AS time_to
        FROM spans, unnest(range(0, CAST(ceil((b - a) / 12960000.0) AS BIGINT))) AS t(i) WHERE a < b""",
    "landed_candles": """SELECT 'birdeye' AS source, 'market' AS domain, CAST(user_id AS VARCHAR) AS token_address,
        CAST(epoch_us(date_trunc('second', ts)) AS BIGINT) AS event_timestamp, value AS close FROM events""",
    "landed_prices": """SELECT CAST(user_id AS VARCHAR) AS token_address,
        CASE WHEN event_type = 'signup' THEN epoch_us(ts) + 60000000 ELSE epoch_us(date_trunc('second', ts)) END AS event_timestamp,
        value AS price FROM events WHERE event_type <> 'error'""",
    "screened_tokens": f"""SELECT 'discovery' AS domain, CAST(s_suppkey AS VARCHAR) AS token_address,
        epoch_us(TIMESTAMP '{NOW}') + 60000000 AS event_timestamp,
        '{{"address":"' || s_suppkey || '","extensions":null,"liquidity":' || CAST(round(s_acctbal * 100) AS BIGINT) || '}}' AS payload FROM supplier""",
    "decoded_ticks": """SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS VARCHAR) AS token_address,
        CASE WHEN event_type <> 'signup' THEN epoch_us(date_trunc('second', ts)) END AS event_timestamp,
        CASE WHEN event_type <> 'error' THEN value END AS price,
        CASE event_type WHEN 'signup' THEN 'time' WHEN 'error' THEN 'price' END AS problem FROM events""",
    "feed_items": """SELECT doc_id, feed, CAST(item_rank AS INTEGER) AS item_rank
        FROM (SELECT doc_id, source AS feed, text, lang, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS item_rank FROM documents)
        WHERE item_rank <= 10 AND contains(lower(text || ' ' || lang), 'en')""",
    "latest_prices": """SELECT event_type AS token_address, arg_max(value, ts) AS price, epoch_us(max(ts)) AS price_time FROM events GROUP BY 1""",
    "latest_runs": _sql(
        "latest", f"SELECT token_address, model_type, run_id, {_micros('start_time')}, {_places('roc_auc', 'brier_score')} FROM latest"
    ),
    "outflow_report": _sql(
        "flows",
        f"""SELECT CAST(p_size AS VARCHAR) AS wallet, CAST(p_partkey AS VARCHAR) AS token_address, round(coalesce(total_outflow, 0), 6) AS total_outflow,
            coalesce(outflow_count, 0) AS outflow_count, {_micros("latest_outflow")}, coalesce(has_recent_outflow, false) AS has_recent_outflow
            FROM part LEFT JOIN flows ON wallet = CAST(p_size AS VARCHAR) AND token_address = CAST(p_partkey AS VARCHAR)""",
    ),
    "candidate_lines": _sql(
        "candidates",
        """SELECT token_address, substr(token_address, 1, 8) AS label, coalesce(symbol, '?') AS symbol,
           round(coalesce(volume_24h_usd, 0), 6) AS volume_24h_usd, round(coalesce(liquidity, 0), 6) AS liquidity FROM candidates""",
    ),
    "watchlist_records": _sql(
        "decided",
        f"""SELECT epoch_us(TIMESTAMP '{NOW}') AS scan_timestamp, token_address,
            CASE WHEN override_triggered AND confidence >= 0.85 THEN 'CRITICAL' WHEN override_triggered THEN 'HIGH'
                 WHEN action = 'BUY' AND confidence >= 0.7 THEN 'WATCH' ELSE 'INFO' END AS severity,
            action, round(CAST(confidence AS DOUBLE), 6) AS confidence, override_triggered,
            override_triggered AS would_emergency_exit_if_held, {_RISKS} AS risks FROM decided""",
    ),
    "watchlist_view": _sql(
        "decided judged candles",
        """SELECT w.token_address, source, price, action
           FROM (SELECT CAST(n_nationkey AS VARCHAR) AS token_address, 'manual' AS source FROM nation
                 UNION ALL
                 SELECT token_address, 'discovered' FROM
                   (SELECT token_address FROM judged WHERE outcome = 'valid' ORDER BY volume_24h_usd DESC, token_address LIMIT 10)
                 WHERE token_address NOT IN (SELECT CAST(n_nationkey AS VARCHAR) FROM nation)) w
           LEFT JOIN (SELECT token_address, arg_max(close, event_timestamp) AS price FROM candles GROUP BY 1) c USING (token_address)
           LEFT JOIN decided d USING (token_address)""",
    ),
}

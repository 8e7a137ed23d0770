"""Indicators, risk measures, gaps and interpolation."""

from registry.core import AS_OF, END, START, query
from tidemark.operators import gaps, indicators, risk

_KNOWN = f"time <= TIMESTAMP '{AS_OF}'"
_TRAILING = f"{_KNOWN} AND time >= TIMESTAMP '{AS_OF}' - INTERVAL 30 DAY"


def _newest(count: int) -> str:
    return f"""SELECT * FROM (
        SELECT symbol, time, price, row_number() OVER (PARTITION BY symbol ORDER BY time DESC) AS rn
        FROM price_ticks WHERE {_KNOWN}) WHERE rn <= {count}"""


@query(
    "moving_averages",
    f"""SELECT entity_id, time, value,
           avg(value) OVER (PARTITION BY entity_id ORDER BY time
                            ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) AS sma,
           coalesce(value * (2.0 / 11) + lag(value) OVER (PARTITION BY entity_id ORDER BY time)
                    * (1 - 2.0 / 11), value) AS ema
    FROM records WHERE time >= TIMESTAMP '{START}' AND time < TIMESTAMP '{END}'""",
    "value sma ema",
)
def _(t):
    return indicators.moving_averages(t.records, 10, START, END)


@query("sma", f"SELECT symbol, avg(price) AS sma FROM ({_newest(20)}) GROUP BY symbol", "sma")
def _(t):
    return indicators.sma(t.price_ticks, 20, AS_OF)


def _ema_sql(order: str) -> str:
    return f"""newest AS ({_newest(20)}),
    steps AS (SELECT symbol, price, row_number() OVER (PARTITION BY symbol ORDER BY rn {order}) AS step
              FROM newest),
    folded AS (
        SELECT symbol, 0::BIGINT AS step, avg(price) AS ema FROM newest GROUP BY symbol
        UNION ALL
        SELECT f.symbol, f.step + 1, s.price * (2.0::DOUBLE / 21) + f.ema * (1 - 2.0::DOUBLE / 21)
        FROM folded f JOIN steps s ON s.symbol = f.symbol AND s.step = f.step + 1)
    SELECT symbol, arg_max(ema, step) AS ema FROM folded GROUP BY symbol"""


@query("ema", "WITH RECURSIVE " + _ema_sql("ASC"), "ema")
def _(t):
    return indicators.ema(t.price_ticks, 20, AS_OF)


@query("ema_oldest_first", "WITH RECURSIVE " + _ema_sql("DESC"), "ema")
def _(t):
    return indicators.ema(t.price_ticks, 20, AS_OF, oldest_first=True)


_RSI = f"""SELECT symbol, CASE WHEN loss = 0 THEN 100 ELSE 100 - 100 / (1 + gain / loss) END AS rsi
    FROM (SELECT symbol, avg(CASE WHEN change > 0 THEN change ELSE 0 END) AS gain,
                 avg(CASE WHEN change < 0 THEN -change ELSE 0 END) AS loss
          FROM (SELECT symbol, price - lag(price) OVER (PARTITION BY symbol ORDER BY time) AS change,
                       row_number() OVER (PARTITION BY symbol ORDER BY time DESC) AS rn
                FROM price_ticks WHERE {_KNOWN})
          WHERE rn <= 15 AND change IS NOT NULL GROUP BY symbol)"""


@query("rsi", _RSI, "rsi")
def _(t):
    return indicators.rsi(t.price_ticks, AS_OF)


@query(
    "rsi_signal",
    f"""SELECT *, CASE WHEN rsi >= 70 THEN 'overbought' WHEN rsi <= 30 THEN 'oversold'
    ELSE 'neutral' END AS signal FROM ({_RSI})""",
    "rsi",
)
def _(t):
    return indicators.rsi_signal(t.price_ticks, AS_OF)


_BANDS = f"""SELECT symbol, middle_band, middle_band + 2 * dev AS upper_band,
           middle_band - 2 * dev AS lower_band,
           coalesce((cur - (middle_band - 2 * dev)) / nullif(4 * dev, 0), 0.5) AS price_position,
           4 * dev / middle_band AS bandwidth
    FROM (SELECT symbol, avg(price) AS middle_band, stddev_samp(price) AS dev,
                 arg_max(price, time) AS cur FROM ({_newest(20)}) GROUP BY symbol)"""


@query("bollinger", _BANDS, "middle_band upper_band lower_band price_position bandwidth")
def _(t):
    return indicators.bollinger(t.price_ticks, AS_OF)


@query("bollinger_bandwidth", f"SELECT symbol, bandwidth FROM ({_BANDS})", "bandwidth")
def _(t):
    return indicators.bollinger(t.price_ticks, AS_OF).select("symbol", "bandwidth")


_DAILY = f"""SELECT symbol, CAST(time AS DATE) AS day, arg_min(price, time) AS o,
    arg_max(price, time) AS c FROM price_ticks WHERE {_TRAILING} GROUP BY 1, 2"""


@query(
    "volatility",
    f"""SELECT symbol, stddev_samp(r) * sqrt(252) AS volatility FROM (
        SELECT symbol, ln(c / lag(c) OVER (PARTITION BY symbol ORDER BY day)) AS r FROM ({_DAILY}))
    GROUP BY symbol""",
    "volatility",
)
def _(t):
    return risk.volatility(t.price_ticks, AS_OF)


@query(
    "value_at_risk",
    f"""SELECT symbol, quantile_cont((c - o) / o, 0.05) AS value_at_risk FROM ({_DAILY})
    WHERE o > 0 GROUP BY symbol""",
    "value_at_risk",
)
def _(t):
    return risk.value_at_risk(t.price_ticks, AS_OF)


@query(
    "vwap",
    f"""SELECT symbol, sum(price * volume) / sum(volume) AS vwap FROM price_ticks
    WHERE time >= TIMESTAMP '{START}' AND time <= TIMESTAMP '{END}' AND volume > 0 GROUP BY symbol""",
    "vwap",
)
def _(t):
    return indicators.vwap(t.price_ticks, START, END)


@query(
    "obv",
    f"""SELECT symbol, sum(coalesce(sign(price - before), 0) * coalesce(volume, 0)) AS obv
    FROM (SELECT *, lag(price) OVER (PARTITION BY symbol ORDER BY time) AS before
          FROM price_ticks WHERE {_TRAILING}) GROUP BY symbol""",
    "obv",
)
def _(t):
    return indicators.obv(t.price_ticks, AS_OF)


@query(
    "support_resistance",
    f"""SELECT symbol, price_level,
           CASE WHEN price_level > current_price THEN 'resistance' ELSE 'support' END AS level_type,
           touch_count, touch_count / 10.0 AS strength,
           abs(price_level - current_price) AS distance
    FROM (SELECT symbol, round(price, 2) AS price_level, count(*) AS touch_count
          FROM price_ticks WHERE {_TRAILING} GROUP BY 1, 2 HAVING count(*) >= 3)
    JOIN (SELECT symbol, arg_max(price, time) AS current_price FROM price_ticks WHERE {_KNOWN}
          GROUP BY 1) USING (symbol)""",
    "price_level strength distance",
)
def _(t):
    return indicators.support_resistance(t.price_ticks, AS_OF)


@query(
    "correlate_symbols",
    f"""SELECT 'CLICK' AS symbol1, 'VIEW' AS symbol2, corr(a.r, b.r) AS correlation,
           count(*) AS days
    FROM (SELECT day, (c - o) / o AS r FROM ({_DAILY}) WHERE symbol = 'CLICK') a
    JOIN (SELECT day, (c - o) / o AS r FROM ({_DAILY}) WHERE symbol = 'VIEW') b USING (day)""",
    "correlation",
)
def _(t):
    return risk.correlate_symbols(t.price_ticks, "CLICK", "VIEW", AS_OF)


@query(
    "value_gaps",
    """SELECT entity_id, time, next_time, (epoch_us(next_time) - epoch_us(time)) / 1e6 AS gap_seconds
    FROM (SELECT entity_id, time, lead(time) OVER (PARTITION BY entity_id ORDER BY time) AS next_time
          FROM records)
    WHERE epoch_us(next_time) - epoch_us(time) > 600 * 60 * 1000000::BIGINT""",
    "gap_seconds",
)
def _(t):
    return gaps.value_gaps(t.records, 600)


_LINE = ", ".join(
    f"CASE WHEN step = 0 THEN {v} ELSE before_{v} + ({v} - before_{v}) * (step * 21600000000 / span) "
    f"END AS {v}"
    for v in ("value", "value2", "value3", "value4")
)
_BEFORE = ", ".join(
    f"lag({v}) OVER w AS before_{v}" for v in ("value", "value2", "value3", "value4")
)


@query(
    "fill_interpolate",
    f"""SELECT entity_id, CASE WHEN step = 0 THEN time ELSE before + step * INTERVAL 6 HOUR END AS time,
           {_LINE}, step > 0 AS interpolated
    FROM (
        SELECT *, unnest(generate_series(0, CASE WHEN span > 43200000000
               THEN CAST(ceil(span / 21600000000) AS BIGINT) - 1 ELSE 0 END)) AS step
        FROM (SELECT *, epoch_us(time) - epoch_us(before) AS span
              FROM (SELECT *, lag(time) OVER w AS before, {_BEFORE} FROM records
                    WINDOW w AS (PARTITION BY entity_id ORDER BY time))))""",
    "value value2 value3 value4",
)
def _(t):
    return gaps.fill_interpolate(t.records, 21600, 43200)


@query(
    "completeness",
    """SELECT entity_id, coalesce(n, 0) AS record_count, 60 AS expected_count,
           coalesce(n, 0) < 54 AS is_incomplete
    FROM entities LEFT JOIN (
        SELECT entity_id, count(*) AS n FROM records
        WHERE time >= TIMESTAMP '2024-01-01' AND time < TIMESTAMP '2024-01-29' GROUP BY 1)
    USING (entity_id)""",
)
def _(t):
    return gaps.completeness(t.records, t.entities, "2024-01-01", "2024-01-29", 60)


@query(
    "stale_entities",
    """SELECT entity_id, max(time) AS last_seen FROM records
    WHERE entity_id LIKE 'user_%' AND time <= TIMESTAMP '2024-01-30 00:00:00' GROUP BY entity_id
    HAVING max(time) <= TIMESTAMP '2024-01-30 00:00:00' - INTERVAL 600 MINUTE""",
)
def _(t):
    return gaps.stale_entities(t.records, 600, "2024-01-30", "user_%")

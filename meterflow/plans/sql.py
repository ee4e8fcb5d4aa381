"""DuckDB text of the oracle queries: shared pieces.

Each oracle states the same semantics as the Spark plan, written
independently in plain SQL over the pre-registered test tables.
"""

from __future__ import annotations

# Fixed values, stated here a second time so that a wrong one in the package shows: the
# progressive tariff (from, to, price per kWh) and the advice of each alert level.
TARIFF_SQL = """(VALUES (0, 100, 1893), (100, 200, 2271), (200, 400, 2860), (400, 700, 3407),
    (700, 1000000000000, 3786))"""
ADVICE_SQL = """(CASE {level} WHEN 'INFO' THEN 'Hệ thống ổn định.'
    WHEN 'WARNING' THEN 'Tiêu thụ cao, cân nhắc tắt bớt thiết bị.'
    WHEN 'CRITICAL' THEN 'NGUY HIỂM! Quá tải hệ thống, hãy kiểm tra ngay!' END)"""


def tier_sql(x: str) -> str:
    """Cost of ``x`` kWh: every tier that begins below ``x``, its kWh up to ``x`` times its price."""
    return f"""(CASE WHEN {x} <= 0 THEN 0 WHEN {x} IS NULL THEN NULL ELSE round_even((SELECT sum((least({x}, upto) - since) * price)
        FROM {TARIFF_SQL} AS tariff(since, upto, price) WHERE since < {x}), 0) END)"""


def level_sql(kw: str = "kw", warn: float = 3.0, crit: float = 4.0) -> str:
    return (f"(CASE WHEN {kw} IS NULL THEN NULL WHEN {kw} < {warn} THEN 'INFO' "
            f"WHEN {kw} < {crit} THEN 'WARNING' ELSE 'CRITICAL' END)")


def advice_sql(level: str) -> str:
    return ADVICE_SQL.format(level=level)


def share_sql(sub: str, kw: str = "kw") -> str:
    total = f"({kw} * 1000 / 60)"
    return (f"(CASE WHEN {kw} IS NULL THEN NULL WHEN isnan({total}) OR {total} <= 0 THEN 0.0::DOUBLE "
            f"ELSE coalesce({sub}, 0.0::DOUBLE) / {total} * 100 END)")


def readings_sql(house: bool = False) -> str:
    meter = "'house'" if house else "user_id"
    return f"""
    SELECT {meter} AS meter_id, ts AS event_time, event_id AS tie, value / 25 AS kw,
           CAST(CAST(value / 25 AS DECIMAL(18,6)) * CAST(1.5 AS DECIMAL(18,6)) AS DECIMAL(20,6)) AS kwh,
           CAST(json_extract_string(props, '$.k') AS INTEGER) * 0.1::DOUBLE AS sub1,
           CAST(json_extract_string(props, '$.k') AS INTEGER) * 0.05::DOUBLE AS sub2,
           (99 - CAST(json_extract_string(props, '$.k') AS INTEGER)) * 0.1::DOUBLE AS sub3
    FROM events"""


#: Years of readings of seven meters, one for each line number; many share an instant.
LINE_METERS_SQL = """
    SELECT 'm' || l_linenumber AS meter_id, CAST(l_shipdate AS TIMESTAMP) AS event_time, l_orderkey * 8 + l_linenumber AS tie,
           l_quantity AS kw, CAST(CAST(l_quantity AS DECIMAL(18,6)) * CAST(1.5 AS DECIMAL(18,6)) AS DECIMAL(20,6)) AS kwh,
           0.0::DOUBLE AS sub1, 0.0::DOUBLE AS sub2, 0.0::DOUBLE AS sub3
    FROM lineitem"""


SUPPLY_METERS_SQL = LINE_METERS_SQL.replace("'m' || l_linenumber", "'s' || (l_suppkey % 97)")


def cycle_sql(cycle: str, ts: str = "event_time") -> str:
    if cycle == "calendar_month":
        return f"strftime({ts}, '%Y-%m')"
    return f"('demo-' || CAST(hour({ts}) AS VARCHAR) || '-' || CAST(minute({ts}) // 3 AS VARCHAR))"


def billed_sql(house: bool = False, cycle: str = "calendar_month", source: str | None = None) -> str:
    """CTEs ``r`` (readings, with month_key) and ``b`` (billed readings)."""
    return f"""
    r AS (SELECT *, {cycle_sql(cycle)} AS month_key FROM ({source or readings_sql(house)})),
    b AS (
      SELECT *, {level_sql()} AS alert_level,
             {tier_sql('cum')} AS vnd_dec,
             {share_sql('sub1')} AS sub1_pct, {share_sql('sub2')} AS sub2_pct,
             {share_sql('sub3')} AS sub3_pct
      FROM (SELECT *, SUM(kwh) OVER (PARTITION BY meter_id, month_key ORDER BY event_time, tie
                                     ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum
            FROM r))"""


def power_usage_sql(house: bool = False, cycle: str = "calendar_month") -> str:
    return f"""
    WITH {billed_sql(house, cycle)}
    SELECT meter_id, tie, date_trunc('second', event_time) AS time, alert_level, kw,
           CAST(cum AS DOUBLE) AS kwh_cumulative, CAST(vnd_dec AS DOUBLE) AS vnd_cumulative,
           sub1_pct, sub2_pct, sub3_pct, {advice_sql('alert_level')} AS suggestion,
           month_key
    FROM b"""


# --- point tables as CTEs ------------------------------------------------------------

def usage_cte(house: bool = False, cycle: str = "calendar_month") -> str:
    """CTE ``pu``: the power_usage point table (plus month_key) as the Spark query returns it."""
    return f"""{billed_sql(house, cycle)},
    pu AS (
      SELECT meter_id, tie, event_time, date_trunc('second', event_time) AS time, alert_level, kw,
             CAST(cum AS DOUBLE) AS kwh_cumulative, CAST(vnd_dec AS DOUBLE) AS vnd_cumulative,
             sub1_pct, sub2_pct, sub3_pct, {advice_sql('alert_level')} AS suggestion, month_key,
             kwh
      FROM b)"""


def interp_sql(src: str, keys: str, t: str, tnum: str, v: str, out: str | None = None) -> str:
    """Linear fill of NULL ``v`` between known neighbours (numpy's order of operations)."""
    out = out or v
    part = f"PARTITION BY {keys}" if keys else ""
    prev = f"OVER ({part} ORDER BY {t} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    nxt = f"OVER ({part} ORDER BY {t} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
    return f"""(SELECT * EXCLUDE (_pt, _pv, _nt, _nv, {v}),
            CASE WHEN {v} IS NOT NULL THEN {v}
                 ELSE (_nv - _pv) / (_nt - _pt) * ({tnum} - _pt) + _pv END AS {out}
     FROM (SELECT *,
             last_value(CASE WHEN {v} IS NOT NULL THEN {tnum} END IGNORE NULLS) {prev} AS _pt,
             last_value({v} IGNORE NULLS) {prev} AS _pv,
             first_value(CASE WHEN {v} IS NOT NULL THEN {tnum} END IGNORE NULLS) {nxt} AS _nt,
             first_value({v} IGNORE NULLS) {nxt} AS _nv
           FROM {src}))"""


def meter_lines_sql(digits: tuple[int, int] = (4, 2)) -> str:
    """The mixed TXT/CSV rendering of ``events`` (see sources.tables)."""
    return f"""
    SELECT tie, CASE WHEN event_type IN ('view', 'purchase')
        THEN concat_ws(',', strftime(ts, '%Y-%m-%d %H:%M:%S'), kwt, '0.100', '240.000', '1.000', s1, s2, s3)
        ELSE concat_ws(';', strftime(ts, '%-d/%-m/%Y'), strftime(ts, '%H:%M:%S'), kwt, '0.100',
                       '240.000', '1.000', s1, s2, s3) END AS line
    FROM (SELECT event_id AS tie, event_type, ts,
            CASE WHEN event_type = 'error' THEN '?' ELSE printf('%.{digits[0]}f', value / 25) END AS kwt,
            CASE WHEN event_type = 'purchase' THEN 'x' ELSE printf('%.{digits[1]}f', k * 0.1::DOUBLE) END AS s1,
            CASE WHEN event_type = 'signup' THEN '?' ELSE printf('%.{digits[1]}f', k * 0.05::DOUBLE) END AS s2,
            CASE WHEN event_type = 'click' THEN '' ELSE printf('%.{digits[1]}f', (99 - k) * 0.1::DOUBLE) END AS s3
          FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events))"""


def fields_sql(digits: tuple[int, int] = (4, 2)) -> str:
    """Split each rendered line by its dialect (1-based lists)."""
    return f"""
    SELECT tie, line, dia, len(p) AS np,
           CASE WHEN dia = 'txt' THEN p[3] ELSE p[2] END AS kwt,
           CASE WHEN dia = 'txt' THEN p[7] ELSE p[6] END AS s1t,
           CASE WHEN dia = 'txt' THEN p[8] ELSE p[7] END AS s2t,
           CASE WHEN dia = 'txt' THEN p[9] ELSE p[8] END AS s3t,
           CASE WHEN dia = 'txt' THEN try_strptime(p[1] || ' ' || p[2], '%d/%m/%Y %H:%M:%S')
                ELSE try_strptime(trim(p[1]), '%Y-%m-%d %H:%M:%S') END AS event_time,
           trim(p[1]) IN ('Date', 'datetime') AS header
    FROM (SELECT *, CASE WHEN dia = 'txt' THEN string_split(line, ';')
                         ELSE string_split(line, ',') END AS p
          FROM (SELECT tie, trim(line) AS line,
                       CASE WHEN line LIKE '%;%' THEN 'txt' WHEN line LIKE '%,%' THEN 'csv' END AS dia
                FROM ({meter_lines_sql(digits)})))"""


def round_sql(x: str, digits: int) -> str:
    """A double to ``digits`` decimals by its exact value, ties to even: the product and its exact rest, then the sign of both."""
    f = f"{10**digits}.0::DOUBLE"
    return f"""(SELECT CASE WHEN over + rest > 0 OR over + rest = 0 AND down % 2 = 1 THEN (down + 1) / {f} ELSE down / {f} END FROM (
        SELECT floor(p) AS down, p - floor(p) - 0.5::DOUBLE AS over, (h * {f} - p) + (v - h) * {f} AS rest FROM (
        SELECT v, v * {f} AS p, 134217729.0::DOUBLE * v - (134217729.0::DOUBLE * v - v) AS h FROM (SELECT {x} AS v))))"""


LINEITEM_SQL = "SELECT 'lineitem' AS meter_id, CAST(l_shipdate AS TIMESTAMP) AS event_time, l_quantity AS kw FROM lineitem"


def daily_sql(house: bool, min_readings: int, source: str | None = None, factor_text: str = "0.016666666666666666") -> str:
    return f"""
    SELECT meter_id, CAST(event_time AS DATE) AS ds,
           CAST(sum(CAST(kw AS DECIMAL(18,6))) AS DOUBLE) * {factor_text}::DOUBLE AS y, count(*) AS n
    FROM ({source or readings_sql(house)}) GROUP BY ALL HAVING count(*) >= {min_readings}"""


def daily_series_sql(house: bool, min_readings: int, source: str | None = None) -> str:
    """CTE body: densified + interpolated daily series (meter_id, ds, y)."""
    return f"""
    SELECT meter_id, ds, y FROM {interp_sql(f"""(
      SELECT s.meter_id, s.ds, d.y, CAST(s.ds - DATE '1970-01-01' AS DOUBLE) AS tn
      FROM (SELECT meter_id, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS ds
            FROM (SELECT meter_id, min(ds) AS lo, max(ds) AS hi
                  FROM ({daily_sql(house, min_readings, source)}) GROUP BY meter_id)) s
      LEFT JOIN ({daily_sql(house, min_readings, source)}) d ON d.meter_id = s.meter_id AND d.ds = s.ds)""",
      'meter_id', 'ds', 'tn', 'y')}"""


REFINE_STEPS = (0.1, 0.05, 0.025, 0.0125, 0.00625)


def holt_winters_sql(series_sql: str, alpha: float | None = None, beta: float | None = None, gamma: float | None = None,
                     horizon: int = 7, z: float = 1.96, scale: float = 1.0, now: str | None = None) -> str:
    """Additive Holt-Winters (weekly season) as recursive CTEs.

    Without parameters they are searched: a 5 x 5 x 5 grid, then the
    neighbours of the best point at each of REFINE_STEPS. ``now``: step h is
    the minute of ``now`` plus h minutes; else the last day plus h days.
    """
    s1 = " + ".join(f"ys[{i}]" for i in range(1, 8))
    s2 = " + ".join(f"ys[{i}]" for i in range(8, 15))
    err = "(d.y - (r.l + r.b + r.s[1]))"
    lnew = "(r.pa * (d.y - r.s[1]) + (1.0::DOUBLE - r.pa) * (r.l + r.b))"
    mnew = f"(r.mean + ({err} - r.mean) / (r.t + 1))"

    def fold(name, params):
        return f"""{name} AS (
      SELECT i.meter_id, n, last_ds, pa, pb, pg, 0::BIGINT AS t, l0 AS l, b0 AS b,
             [{", ".join(f"ys[{i}] - l0" for i in range(1, 8))}] AS s,
             0.0::DOUBLE AS sse, 0.0::DOUBLE AS mean, 0.0::DOUBLE AS m2
      FROM ini2 i JOIN {params} p ON p.meter_id = i.meter_id
      UNION ALL
      SELECT r.meter_id, r.n, r.last_ds, r.pa, r.pb, r.pg, r.t + 1,
             {lnew},
             r.pb * ({lnew} - r.l) + (1.0::DOUBLE - r.pb) * r.b,
             list_append(r.s[2:7], r.pg * (d.y - r.l - r.b) + (1.0::DOUBLE - r.pg) * r.s[1]),
             r.sse + {err} * {err},
             {mnew},
             r.m2 + ({err} - r.mean) * ({err} - {mnew})
      FROM {name} r JOIN dt d ON d.meter_id = r.meter_id AND d.t = r.t)"""

    ctes = []
    if alpha is not None:
        ctes.append(f"par AS (SELECT meter_id, {float(alpha)}::DOUBLE AS pa, {float(beta)}::DOUBLE AS pb, {float(gamma)}::DOUBLE AS pg FROM ini2)")
        ctes.append(fold("rec", "par"))
    else:
        axis = "(VALUES (0.1::DOUBLE), (0.3::DOUBLE), (0.5::DOUBLE), (0.7::DOUBLE), (0.9::DOUBLE))"
        ctes.append(f"""par0 AS (SELECT meter_id, a.v AS pa, b.v AS pb, g.v AS pg FROM ini2,
            {axis} a(v), {axis} b(v), {axis} g(v))""")
        for k, step in enumerate([*REFINE_STEPS, None]):
            ctes.append(fold(f"try{k}", f"par{k}"))
            ctes.append(f"""best{k} AS (SELECT meter_id, pa, pb, pg FROM try{k} WHERE t = n QUALIFY row_number() OVER
                (PARTITION BY meter_id ORDER BY sse, pa, pb, pg) = 1)""")
            if step is not None:
                near = f"(VALUES (-{step}::DOUBLE), (0.0::DOUBLE), ({step}::DOUBLE))"
                moved = lambda x: f"round({x}, 6)"
                ctes.append(f"""par{k + 1} AS (SELECT meter_id, {moved("pa + a.v")} AS pa, {moved("pb + b.v")} AS pb, {moved("pg + g.v")} AS pg
                    FROM best{k}, {near} a(v), {near} b(v), {near} g(v)
                    WHERE {moved("pa + a.v")} BETWEEN 0 AND 1 AND {moved("pb + b.v")} BETWEEN 0 AND 1 AND {moved("pg + g.v")} BETWEEN 0 AND 1)""")
        ctes.append(fold("rec", f"best{len(REFINE_STEPS)}"))
    time = f"date_trunc('minute', TIMESTAMP '{now}') + step * INTERVAL 1 MINUTE" if now else "last_ds + CAST(step AS INTEGER)"
    chosen = ",\n    ".join(ctes)
    return f"""
    WITH RECURSIVE
    dt AS (SELECT meter_id, ds, y, row_number() OVER (PARTITION BY meter_id ORDER BY ds) - 1 AS t,
                  count(*) OVER (PARTITION BY meter_id) AS n
           FROM ({series_sql})),
    ini AS (SELECT meter_id, n, max(ds) AS last_ds, list(y ORDER BY t) AS ys
            FROM dt GROUP BY meter_id, n HAVING n >= 14),
    ini2 AS (SELECT *, (0.0::DOUBLE + {s1}) / 7.0::DOUBLE AS l0,
                    ((0.0::DOUBLE + {s2}) / 7.0::DOUBLE - (0.0::DOUBLE + {s1}) / 7.0::DOUBLE) / 7.0::DOUBLE AS b0
             FROM ini),
    {chosen},
    fit AS (SELECT meter_id, last_ds, l, b, s, sqrt(m2 / (t - 1)) AS sigma FROM rec WHERE t = n),
    fc AS (SELECT meter_id, last_ds, sigma, h AS step,
                  l + CAST(h AS DOUBLE) * b + s[((h - 1) % 7) + 1] AS yh
           FROM fit, range(1, {horizon + 1}) AS hr(h))
    SELECT meter_id, step, {time} AS time,
           CASE WHEN yh * {scale}::DOUBLE < 0 THEN 0.0::DOUBLE ELSE yh * {scale}::DOUBLE END AS yhat,
           CASE WHEN yh * {scale}::DOUBLE - {z}::DOUBLE * (sigma * {scale}::DOUBLE) < 0 THEN 0.0::DOUBLE
                ELSE yh * {scale}::DOUBLE - {z}::DOUBLE * (sigma * {scale}::DOUBLE) END AS yhat_lower,
           yh * {scale}::DOUBLE + {z}::DOUBLE * (sigma * {scale}::DOUBLE) AS yhat_upper
    FROM fc"""

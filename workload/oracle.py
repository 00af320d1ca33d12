"""Oracle SQL for the registered queries."""

from millrace.schemas import DEVICE, RAW_VALUE, TIME, VALUE

AS_OF = "TIMESTAMP '2024-01-31 00:00:00'"

EVENTS = f"""events_clean AS (
  SELECT user_id AS {DEVICE}, ts AS {TIME}, value AS {RAW_VALUE}, value AS {VALUE},
         event_type = 'error' AS is_outlier FROM events)"""
LINEITEM = f"""lineitem_clean AS (
  SELECT l_suppkey AS {DEVICE}, l_shipdate AS {TIME}, l_extendedprice AS {VALUE},
         l_returnflag = 'R' AS is_outlier FROM lineitem)"""
ORDERS = f"""orders_clean AS (
  SELECT o_custkey AS {DEVICE}, o_orderdate AS {TIME}, o_totalprice AS {VALUE},
         o_orderstatus = 'P' AS is_outlier, o_orderkey FROM orders)"""
CUSTOMERS = f"""devices AS (
  SELECT c_custkey AS {DEVICE}, c_name AS name, c_mktsegment AS location, c_acctbal > 0 AS is_active FROM customer)"""
SUPPLIERS = f"""devices AS (SELECT s_suppkey AS {DEVICE}, s_name AS name, s_acctbal > 0 AS is_active FROM supplier)"""
CUSTOMER_COLUMNS = f"{DEVICE}, name, location, is_active"


def r6(x: str) -> str:
    return f"round({x} + 3e-8, 6)"


def stats(source: str) -> str:
    means = ",\n".join(
        f"avg({VALUE}) FILTER (WHERE {TIME} >= last_measurement - INTERVAL {span}) AS {name}"
        for name, span in [("avg_24h", "24 HOUR"), ("avg_7d", "7 DAY"), ("avg_30d", "30 DAY"), ("avg_360d", "360 DAY")]
    )
    return f"""base AS (SELECT * FROM {source} WHERE {VALUE} IS NOT NULL AND NOT coalesce(is_outlier, false)),
extent AS (SELECT {DEVICE}, count(*) AS total_measurements, min({TIME}) AS first_measurement,
                  max({TIME}) AS last_measurement FROM base GROUP BY ALL),
stats AS (SELECT {DEVICE}, total_measurements, first_measurement, last_measurement, {means},
                 avg({VALUE}) AS avg_all_time
          FROM base JOIN extent USING ({DEVICE}) GROUP BY ALL)"""


STATS_OUT = f"""{DEVICE}, total_measurements, first_measurement, last_measurement, {r6('avg_24h')} AS avg_24h,
{r6('avg_7d')} AS avg_7d, {r6('avg_30d')} AS avg_30d, {r6('avg_360d')} AS avg_360d,
{r6('avg_all_time')} AS avg_all_time"""


def daily(source: str) -> str:
    return f"""daily AS (SELECT {DEVICE}, CAST({TIME} AS DATE) AS giorno, avg({VALUE}) AS flow_avg_day
FROM {source} WHERE {VALUE} IS NOT NULL GROUP BY ALL)"""


def curve(source: str, devices: str = "devices") -> str:
    return f"""{daily(source)},
curve AS (SELECT *, m / (n + 1)::DOUBLE * 100 AS p_exceed FROM (
  SELECT *, row_number() OVER (PARTITION BY {DEVICE} ORDER BY flow_avg_day DESC, giorno) AS m,
         count(*) OVER (PARTITION BY {DEVICE}) AS n
  FROM daily WHERE {DEVICE} IN (SELECT {DEVICE} FROM {devices})))"""


CURVE_OUT = f"{DEVICE}, giorno, {r6('flow_avg_day')} AS flow_avg_day, m, n, {r6('p_exceed')} AS p_exceed"


def histogram(source: str, bins: int, where: str = "true", upper: bool = False, name: str = "hist") -> str:
    index = f"CAST(floor(({VALUE} - min_v) / (max_v - min_v) * {bins}) AS INTEGER) + 1"
    if upper:
        index = f"least({index}, {bins})"
    return f"""{name}_data AS (SELECT {DEVICE}, {VALUE} FROM {source} WHERE {VALUE} IS NOT NULL AND {where}),
{name}_ranges AS (SELECT {DEVICE}, min({VALUE}) AS min_v, max({VALUE}) AS max_v FROM {name}_data GROUP BY ALL),
{name}_counts AS (SELECT {DEVICE}, bin_index, count(*) AS n FROM (
   SELECT {DEVICE}, CASE WHEN max_v = min_v THEN 1 ELSE {index} END AS bin_index
   FROM {name}_data JOIN {name}_ranges USING ({DEVICE})) GROUP BY ALL),
{name} AS (SELECT {DEVICE}, bin_index,
   CASE WHEN max_v = min_v THEN min_v ELSE min_v + (bin_index - 1) * ((max_v - min_v) / {bins}) END AS range_start,
   CASE WHEN max_v = min_v THEN max_v ELSE min_v + bin_index * ((max_v - min_v) / {bins}) END AS range_end,
   coalesce(n, 0) AS count
   FROM (SELECT *, CAST(unnest(range(1, {bins + 1})) AS INTEGER) AS bin_index FROM {name}_ranges)
   LEFT JOIN {name}_counts USING ({DEVICE}, bin_index))"""


def histogram_out(start: str = "TIMESTAMP '1970-01-01'", end: str = "NULL::TIMESTAMP") -> str:
    return f"""SELECT {DEVICE}, {start} AS window_start, {end} AS window_end, bin_index,
{r6('range_start')} AS range_start, {r6('range_end')} AS range_end, count, {AS_OF} AS updated_at FROM hist"""


def rolling(source: str, v: str, radius: int, order: str = TIME) -> str:
    """Sorted frame, its median, sorted distances, their median."""
    def middle(a: str) -> str:
        return f"({a}[(len({a}) + 1) // 2] + {a}[len({a}) // 2 + 1]) / 2"

    return f"""framed AS (SELECT *, list_sort(list({v}) FILTER (WHERE {v} IS NOT NULL) OVER (
    PARTITION BY {DEVICE} ORDER BY {order} ROWS BETWEEN {radius} PRECEDING AND {radius} FOLLOWING)) AS a,
    row_number() OVER (PARTITION BY {DEVICE} ORDER BY {order}) AS place, count(*) OVER (PARTITION BY {DEVICE}) AS size
  FROM {source}),
medians AS (SELECT *, {middle('a')} AS med FROM framed),
distances AS (SELECT *, list_sort(list_transform(a, lambda x: abs(x - med))) AS b FROM medians),
mads AS (SELECT *, {middle('b')} AS mad FROM distances)"""


def hampel(source: str = "events_clean", v: str = RAW_VALUE, window: int = 49, n_sigma: float = 3.5,
           order: str = TIME, extra: str = "", keep_edge: bool = False) -> str:
    radius = window // 2
    inner = f"place > {radius} AND place <= size - {radius}" if keep_edge else "true"
    return f"""{rolling(source, v, radius, order)},
judged AS (SELECT *, mad * ({n_sigma} * 1.4826) AS thr,
  coalesce(abs({v} - med) > mad * ({n_sigma} * 1.4826), false) AND {inner} AS bad FROM mads)
SELECT {DEVICE}, {TIME}, {extra} {r6(v)} AS {RAW_VALUE}, {r6(f'CASE WHEN bad THEN med ELSE {v} END')} AS {VALUE},
  bad AS is_outlier, {r6('med')} AS window_median, {r6('thr')} AS thresholds FROM judged"""


def series_range(span: str | None, limit: int = 5) -> str:
    where = "true" if span is None else f"{TIME} BETWEEN latest - INTERVAL {span} AND latest"
    return f"""WITH {ORDERS},
ranged AS (SELECT * FROM (SELECT *, max({TIME}) OVER (PARTITION BY {DEVICE}) AS latest FROM orders_clean) WHERE {where}),
placed AS (SELECT *, row_number() OVER (PARTITION BY {DEVICE} ORDER BY {TIME}, o_orderkey) - 1 AS place,
   count(*) OVER (PARTITION BY {DEVICE}) AS size FROM ranged)
SELECT {DEVICE}, {TIME}, {VALUE}, is_outlier, o_orderkey FROM placed
WHERE size <= {limit} OR place % greatest(1, size // {limit}) = 0"""


def gaps(source: str, threshold: str) -> str:
    return f"""SELECT {DEVICE}, {TIME} AS gap_start, nxt AS gap_end FROM (
SELECT {DEVICE}, {TIME}, lead({TIME}) OVER (PARTITION BY {DEVICE} ORDER BY {TIME}) AS nxt FROM {source})
WHERE nxt - {TIME} > INTERVAL {threshold}"""


def gap_markers(threshold: str | None) -> str:
    points = f"SELECT {DEVICE}, {TIME}, {VALUE}, false AS is_gap FROM events_clean"
    if threshold is None:
        return f"WITH {EVENTS} {points}"
    return f"""WITH {EVENTS} {points}
UNION ALL SELECT {DEVICE}, make_timestamp(epoch_us({TIME}) + (epoch_us(nxt) - epoch_us({TIME}) + 1) // 2), NULL, true
FROM (SELECT *, lead({TIME}) OVER w AS nxt, lead({VALUE}) OVER w AS nxt_value FROM events_clean
      WINDOW w AS (PARTITION BY {DEVICE} ORDER BY {TIME}))
WHERE nxt - {TIME} > INTERVAL {threshold} AND nxt_value IS NOT NULL"""


THROTTLE = f"""WITH RECURSIVE {EVENTS},
kept AS (SELECT {DEVICE}, min({TIME}) AS {TIME} FROM events_clean GROUP BY {DEVICE}
  UNION ALL
  SELECT k.{DEVICE}, min(e.{TIME}) FROM kept k JOIN events_clean e
    ON e.{DEVICE} = k.{DEVICE} AND e.{TIME} >= k.{TIME} + INTERVAL 1 DAY GROUP BY k.{DEVICE}, k.{TIME})
SELECT {DEVICE}, {TIME}, {VALUE} FROM kept JOIN events_clean USING ({DEVICE}, {TIME})"""


def lttb(samples: int, threshold: int) -> str:
    return f"""WITH RECURSIVE {EVENTS},
placed AS (SELECT {DEVICE}, {TIME}, {VALUE} AS y, epoch_us({TIME}) / 1000.0 AS x,
  row_number() OVER (PARTITION BY {DEVICE} ORDER BY {TIME}) - 1 AS p, count(*) OVER (PARTITION BY {DEVICE}) AS n
  FROM events_clean),
pts AS (SELECT *, CASE WHEN p = 0 THEN 0 WHEN p = n - 1 THEN {samples - 1}
  ELSE (p * {samples - 2} - 1) // (n - 2) + 1 END AS b FROM placed WHERE n > {threshold} AND n > {samples}),
means AS (SELECT {DEVICE}, b, avg(x) AS mx, avg(y) AS my FROM pts GROUP BY ALL),
walk AS (SELECT {DEVICE}, b, {TIME}, x, y FROM pts WHERE b = 0
  UNION ALL
  SELECT {DEVICE}, b, {TIME}, x, y FROM (
    SELECT c.{DEVICE}, c.b, c.{TIME}, c.x, c.y, row_number() OVER (PARTITION BY c.{DEVICE} ORDER BY
      abs((a.x - m.mx) * (c.y - a.y) - (a.x - c.x) * (m.my - a.y)) DESC, c.p) AS r
    FROM walk a JOIN pts c ON c.{DEVICE} = a.{DEVICE} AND c.b = a.b + 1
    JOIN means m ON m.{DEVICE} = c.{DEVICE} AND m.b = c.b + 1) WHERE r = 1)
SELECT {DEVICE}, {TIME}, y AS {VALUE} FROM walk
UNION ALL SELECT {DEVICE}, {TIME}, y FROM pts WHERE b = {samples - 1}
UNION ALL SELECT {DEVICE}, {TIME}, y FROM placed WHERE NOT (n > {threshold} AND n > {samples})"""


def keyed_table(first: str) -> str:
    """Stored and new orders per (customer, date); ``first`` orders the copies of a key."""
    return f"""stored AS (SELECT o_custkey, o_orderdate, o_totalprice, o_orderkey, o_orderstatus FROM orders
  WHERE o_orderstatus <> 'F' QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderdate ORDER BY {first}) = 1),
new AS (SELECT o_custkey, o_orderdate, o_totalprice, o_orderkey, o_orderstatus FROM orders
  WHERE o_orderstatus = 'F' QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderdate ORDER BY {first}) = 1)"""


DAY_MS = "epoch_ms(date_trunc('day', ts))"
PIVOT = ", ".join(f"max(value) FILTER (WHERE event_type = '{m}') AS \"{m}\""
                  for m in ("click", "error", "purchase", "signup", "view"))
LONG_EVENTS = """SELECT CAST(user_id AS VARCHAR) AS device_id, '' AS group_name,
  epoch_us(ts) // 1000000 AS parent_timestamp, epoch_us(ts) // 1000 AS "parent_timestampMsec", event_type AS measure_name,
  value AS raw_data, CAST(1 AS INTEGER) AS status, epoch_us(ts) // 1000000 AS measure_timestamp,
  epoch_us(ts) // 1000 AS "measure_timestampMsec" FROM """


def oracle_sql() -> dict[str, str]:
    customers, suppliers = CUSTOMERS, SUPPLIERS
    device_rows = f"SELECT {CUSTOMER_COLUMNS}, CASE WHEN is_active THEN 'Attivo' ELSE 'Non attivo' END AS status FROM devices"
    return {
        "device_stats": f"WITH {EVENTS}, {stats('events_clean')} SELECT {STATS_OUT}, {AS_OF} AS updated_at FROM stats",
        "device_stats_orders":
            f"WITH {ORDERS}, {stats('orders_clean')} SELECT {STATS_OUT}, {AS_OF} AS updated_at FROM stats",
        "series_extent": f"""WITH {LINEITEM} SELECT {DEVICE}, count(*) AS total_measurements,
            min({TIME}) AS first_measurement, max({TIME}) AS last_measurement FROM lineitem_clean GROUP BY ALL""",
        "daily_mean": f"""WITH {LINEITEM}, {daily('lineitem_clean')}
            SELECT {DEVICE}, giorno, {r6('flow_avg_day')} AS flow_avg_day FROM daily""",
        "duration_curve": f"WITH {EVENTS}, {customers}, {curve('events_clean')} SELECT {CURVE_OUT} FROM curve",
        "duration_curve_suppliers": f"""WITH {LINEITEM}, {suppliers},
            active AS (SELECT * FROM devices WHERE is_active), {curve('lineitem_clean', 'active')}
            SELECT {CURVE_OUT} FROM curve""",
        "curve_at_80": f"""WITH {EVENTS}, {customers}, {curve('events_clean')},
            sides AS (SELECT {DEVICE}, max(p_exceed) FILTER (WHERE p_exceed <= 80) AS x0,
              arg_max(flow_avg_day, p_exceed) FILTER (WHERE p_exceed <= 80) AS y0,
              min(p_exceed) FILTER (WHERE p_exceed >= 80) AS x1,
              arg_min(flow_avg_day, p_exceed) FILTER (WHERE p_exceed >= 80) AS y1 FROM curve GROUP BY ALL)
            SELECT {DEVICE}, {r6('CASE WHEN x1 = 80 THEN y1 ELSE y0 + (y1 - y0) * (80 - x0) / (x1 - x0) END')} AS y_at_x
            FROM sides""",
        "curve_floor": f"""WITH {LINEITEM}, {daily('lineitem_clean')}
            SELECT {DEVICE}, giorno, {r6('flow_avg_day')} AS flow_avg_day FROM daily WHERE flow_avg_day >= 40000""",
        "curve_thinned": f"""WITH {EVENTS}, {customers}, {curve('events_clean')}
            SELECT {DEVICE}, m, {r6('flow_avg_day')} AS flow_avg_day, {r6('p_exceed')} AS p_exceed FROM curve
            WHERE n <= 7 OR (m - 1) % greatest(1, n // 7) = 0""",
        "curves_all_devices": f"""WITH {EVENTS}, {customers}, {curve('events_clean')}
            SELECT {DEVICE}, {r6('flow_avg_day')} AS flow_avg_day, {r6('p_exceed')} AS p_exceed
            FROM devices LEFT JOIN curve USING ({DEVICE})""",
        "value_range": f"""WITH {LINEITEM} SELECT {DEVICE}, min({VALUE}) AS min_v, max({VALUE}) AS max_v
            FROM lineitem_clean GROUP BY ALL""",
        "flow_histogram": f"WITH {EVENTS}, {histogram('events_clean', 100)} {histogram_out()}",
        "flow_histogram_suppliers": f"WITH {LINEITEM}, {histogram('lineitem_clean', 100)} {histogram_out()}",
        "histogram_upper": f"WITH {EVENTS}, {histogram('events_clean', 10, upper=True)} {histogram_out()}",
        "histogram_windowed": f"""WITH {EVENTS},
            {histogram('events_clean', 25, f"{TIME} >= TIMESTAMP '2024-01-21' AND {TIME} < TIMESTAMP '2024-01-31'")}
            {histogram_out("TIMESTAMP '2024-01-21'", "TIMESTAMP '2024-01-31'")}""",
        "histogram_percent": f"""WITH {EVENTS}, {histogram('events_clean', 100)},
            totals AS (SELECT {DEVICE}, sum(count) AS total FROM hist GROUP BY ALL)
            SELECT {DEVICE}, bin_index, count,
              {r6('CASE WHEN total > 0 THEN count / total * 100 ELSE 0 END')} AS percent
            FROM hist JOIN totals USING ({DEVICE})""",
        "histogram_midpoint": f"""WITH {EVENTS}, {histogram('events_clean', 20)}
            SELECT {DEVICE}, bin_index, {r6('(range_start + range_end) / 2')} AS mid, count FROM hist""",
        "histogram_latest": f"""WITH {EVENTS},
            {histogram('events_clean', 20, f"{TIME} >= TIMESTAMP '2024-01-01' AND {TIME} < TIMESTAMP '2024-01-21'",
                       name='older')},
            {histogram('events_clean', 20, f"{TIME} >= TIMESTAMP '2024-01-21' AND {TIME} < TIMESTAMP '2024-01-31'",
                       name='newer')},
            both_ AS (SELECT *, TIMESTAMP '2024-01-21' AS updated_at FROM older
                      UNION ALL SELECT *, {AS_OF} FROM newer),
            newest AS (SELECT * FROM both_ QUALIFY updated_at = max(updated_at) OVER (PARTITION BY {DEVICE}))
            SELECT {DEVICE}, bin_index, {r6('range_start')} AS range_start, {r6('range_end')} AS range_end, count,
              updated_at, {r6(f'''CASE WHEN sum(count) OVER (PARTITION BY {DEVICE}) > 0
              THEN count / sum(count) OVER (PARTITION BY {DEVICE}) * 100 ELSE 0 END''')} AS percent FROM newest""",
        "rolling_median": f"""WITH {EVENTS}, {rolling('events_clean', RAW_VALUE, 12)}
            SELECT {DEVICE}, {TIME}, {r6('med')} AS window_median FROM medians""",
        "rolling_mad": f"""WITH {EVENTS}, {rolling('events_clean', RAW_VALUE, 24)}
            SELECT {DEVICE}, {TIME}, {r6('med')} AS window_median, {r6('mad')} AS window_mad,
            {r6('mad * (3.5 * 1.4826)')} AS thresholds FROM mads""",
        "hampel": f"WITH {EVENTS}, {hampel()}",
        "hampel_offline_params": f"WITH {EVENTS}, {hampel(window=50, n_sigma=3.0)}",
        "hampel_edge_keep": f"WITH {EVENTS}, {hampel(window=15, n_sigma=2.0, keep_edge=True)}",
        "hampel_blocked": f"WITH {EVENTS}, {hampel()}",
        "hampel_orders": f"""WITH {ORDERS},
            {hampel('orders_clean', VALUE, 7, 2.0, f'{TIME}, o_orderkey', 'o_orderkey,')}""",
        "hampel_incremental": f"WITH {EVENTS}, {hampel()}",
        "reclean": f"WITH {EVENTS}, {hampel()}",
        "pivot_measures": f"""SELECT user_id AS device_id, {DAY_MS} AS "parent_timestampMsec", {PIVOT}
            FROM events GROUP BY 1, 2""",
        "explode_events": f"{LONG_EVENTS} events WHERE event_type NOT IN ('error', 'signup')",
        "malformed_events": """SELECT CASE event_type WHEN 'error' THEN 'event' WHEN 'signup' THEN 'device'
            ELSE 'measure' END AS part, count(*) AS dropped FROM events
            WHERE event_type IN ('error', 'signup', 'purchase') GROUP BY 1""",
        "dedupe_time": f"""WITH {LINEITEM} SELECT {DEVICE}, {TIME}, {VALUE}, is_outlier FROM lineitem_clean
            QUALIFY row_number() OVER (PARTITION BY {DEVICE}, {TIME} ORDER BY {VALUE}, is_outlier) = 1""",
        "dedupe_time_value": f"""SELECT l_suppkey AS {DEVICE}, l_shipdate AS {TIME}, l_quantity AS {VALUE},
            min(l_extendedprice) AS price FROM lineitem GROUP BY 1, 2, 3""",
        "merge_series": f"""WITH united AS (
              SELECT o_custkey AS {DEVICE}, o_orderdate AS {TIME}, o_totalprice AS {VALUE}, o_orderkey AS line,
                     NULL::VARCHAR AS kind FROM orders WHERE o_orderstatus <> 'P'
              UNION ALL SELECT user_id, date_trunc('second', ts), value, event_id, event_type FROM events)
            SELECT * FROM united QUALIFY row_number() OVER (PARTITION BY {DEVICE}, {TIME} ORDER BY line) = 1""",
        "series_24h": series_range("24 HOUR"),
        "series_7d": series_range("7 DAY"),
        "series_1m": series_range("30 DAY"),
        "series_6m": series_range("182 DAY"),
        "series_1y": series_range("365 DAY"),
        "series_all": series_range(None),
        "stride_blocked": f"""WITH {ORDERS}, placed AS (SELECT *,
              row_number() OVER (PARTITION BY {DEVICE} ORDER BY {TIME}, o_orderkey) - 1 AS place,
              count(*) OVER (PARTITION BY {DEVICE}) AS size FROM orders_clean)
            SELECT {DEVICE}, {TIME}, {VALUE}, o_orderkey FROM placed
            WHERE size <= 3 OR place % greatest(1, size // 3) = 0""",
        "time_bounds": f"""WITH {EVENTS}, ranged AS (SELECT * FROM events_clean
              QUALIFY {TIME} >= max({TIME}) OVER (PARTITION BY {DEVICE}) - INTERVAL 7 DAY)
            SELECT {DEVICE}, min({TIME}) AS x_min, max({TIME}) AS x_max FROM ranged GROUP BY ALL""",
        "value_bounds": f"""SELECT c_nationkey AS {DEVICE},
              {r6('CASE WHEN min(c_acctbal) < 0 THEN -50.0 ELSE 0.0 END')} AS y_min,
              {r6('greatest(0, max(c_acctbal), avg(c_acctbal) * 3) * 1.1')} AS y_max,
              {r6('least(min(c_acctbal), 0)')} AS curve_min, {r6('greatest(0, max(c_acctbal)) * 1.1')} AS curve_max
            FROM customer GROUP BY 1""",
        "mean_line": f"""WITH {EVENTS}, {stats('events_clean')}, ranged AS (SELECT * FROM events_clean
              QUALIFY {TIME} >= max({TIME}) OVER (PARTITION BY {DEVICE}) - INTERVAL 7 DAY)
            SELECT {DEVICE}, {TIME}, {r6('avg_7d')} AS mean FROM ranged JOIN stats USING ({DEVICE})
            WHERE avg_7d IS NOT NULL""",
        "gap_ranges": f"WITH {EVENTS} {gaps('events_clean', '2 HOUR')}",
        "gap_ranges_long": f"""WITH {ORDERS}, times AS (SELECT DISTINCT {DEVICE}, {TIME} FROM orders_clean)
            {gaps('times', '3 DAY')}""",
        "gap_ranges_blocked": f"WITH {EVENTS} {gaps('events_clean', '3 DAY')}",
        "gap_markers_short": gap_markers("2 HOUR"),
        "gap_markers_long": gap_markers("3 DAY"),
        "gap_markers_none": gap_markers(None),
        "throttle": THROTTLE,
        "throttle_blocked": THROTTLE,
        "lttb": lttb(12, 20),
        "lttb_blocked": lttb(12, 20),
        "rolling_mean_24h": f"""WITH {EVENTS} SELECT {DEVICE}, {TIME}, {r6(f'''avg({VALUE}) OVER (
            PARTITION BY {DEVICE} ORDER BY {TIME} RANGE BETWEEN INTERVAL 24 HOUR PRECEDING AND CURRENT ROW)''')}
            AS rolling_mean FROM events_clean""",
        "rolling_mean_dense": f"""WITH dense AS (SELECT l_returnflag AS {DEVICE}, l_quantity AS {VALUE},
              make_timestamp((1700000000 + l_orderkey * 8 + l_linenumber) * 1000000) AS {TIME} FROM lineitem)
            SELECT {DEVICE}, {TIME}, {r6(f'''avg({VALUE}) OVER (PARTITION BY {DEVICE} ORDER BY {TIME}
            RANGE BETWEEN INTERVAL 1 HOUR PRECEDING AND CURRENT ROW)''')} AS rolling_mean FROM dense""",
        "latest_per_device": f"""SELECT user_id AS {DEVICE}, max(ts) AS latest_measurement FROM events GROUP BY 1""",
        "devices_in": f"SELECT DISTINCT user_id AS {DEVICE} FROM events",
        "freshness": f"""WITH {customers}, last AS (SELECT user_id, max(ts) AS latest_measurement FROM events GROUP BY 1)
            SELECT {DEVICE}, latest_measurement, CASE WHEN latest_measurement IS NULL THEN 'status-gray'
              WHEN {AS_OF} - latest_measurement > INTERVAL 6 HOUR THEN 'status-red'
              WHEN {AS_OF} - latest_measurement > INTERVAL 2 HOUR THEN 'status-orange'
              ELSE 'status-green' END AS status
            FROM devices LEFT JOIN last ON user_id = {DEVICE}""",
        "device_detail": f"""WITH {EVENTS}, {customers}, {stats('events_clean')}
            SELECT {CUSTOMER_COLUMNS}, s.* EXCLUDE ({DEVICE})
            FROM devices LEFT JOIN (SELECT {STATS_OUT} FROM stats) s USING ({DEVICE})""",
        "device_search": f"""WITH {customers} SELECT {CUSTOMER_COLUMNS} FROM devices WHERE is_active
            AND (name ILIKE '%ing%' OR location ILIKE '%ing%' OR CAST({DEVICE} AS VARCHAR) ILIKE '%ing%')
            AND (name ILIKE '%customer#%' OR location ILIKE '%customer#%')""",
        "devices_active": f"WITH {customers} {device_rows} WHERE is_active",
        "devices_inactive": f"WITH {customers} {device_rows} WHERE NOT is_active",
        "devices_on_map": f"""SELECT s_suppkey AS {DEVICE}, s_name AS name, s_nationkey::DOUBLE AS latitude,
            s_acctbal AS longitude, printf('%.6f', s_nationkey::DOUBLE) AS lat_text,
            printf('%.6f', s_acctbal) AS lon_text FROM supplier WHERE s_acctbal > 0 AND s_nationkey <> 0""",
        "insert_ignore": f"""WITH {keyed_table('o_orderkey')} SELECT * FROM stored
            UNION ALL SELECT * FROM new ANTI JOIN stored USING (o_custkey, o_orderdate)""",
        "upsert_latest": f"""WITH {keyed_table('o_orderkey DESC')} SELECT * FROM new
            UNION ALL SELECT * FROM stored ANTI JOIN new USING (o_custkey, o_orderdate)""",
        "incremental_filter": """SELECT event_id, user_id, ts, value FROM events
            WHERE ts > TIMESTAMP '2024-01-20 00:00:00'""",
        "batch_mark": f"SELECT max({DAY_MS}) AS max_ts FROM events",
        "advance_mark": f"""SELECT event_type AS job_name, max({DAY_MS})
              + CASE WHEN event_type = 'view' THEN (SELECT max({DAY_MS}) + 1 FROM events) - max({DAY_MS}) ELSE 0 END
              AS last_parent_timestampmsec FROM events GROUP BY 1""",
        "check_unique": """SELECT l_suppkey, l_shipdate, count(*) AS copies FROM lineitem GROUP BY 1, 2
            HAVING count(*) > 1""",
        "check_not_null": f"""WITH {EVENTS}, {customers}, {stats('events_clean')}
            SELECT {DEVICE}, 'total_measurements,avg_24h' AS null_columns FROM devices ANTI JOIN stats USING ({DEVICE})""",
        "check_fk": f"""SELECT user_id AS {DEVICE}, count(*) AS orphans FROM events
            WHERE user_id NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0) GROUP BY 1""",
        "not_outlier": f"""SELECT user_id AS {DEVICE}, ts AS {TIME}, value AS {VALUE} FROM events
            WHERE event_type <> 'error'""",
        "registered_only": f"""SELECT user_id AS {DEVICE}, ts AS {TIME}, value AS {VALUE} FROM events
            WHERE user_id IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)""",
        "scalar_numbers": """SELECT o_orderkey, least(greatest(o_totalprice, 50000.0), 200000.0) AS clamped,
            CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS "finite", o_totalprice AS "decimal",
            printf('%.2f', o_totalprice) AS text FROM orders""",
        "scalar_times": """SELECT event_id, epoch_us(ts) // 1000 AS ms, make_timestamp((epoch_us(ts) // 1000) * 1000) AS back,
            date_trunc('hour', ts) AS hour, ts - INTERVAL 30 DAY AS month_before,
            strftime(ts, '%Y-%m-%dT%H:%M:%S') || CASE WHEN epoch_us(ts) % 1000000 = 0 THEN ''
              ELSE '.' || strftime(ts, '%f') END || 'Z' AS iso,
            strftime(ts, '%d-%m-%y %H:%M:%S') AS short, strftime(ts, '%d/%m/%Y %H:%M:%S') AS full,
            strftime(ts - INTERVAL 7 DAY, '%d-%m-%y %H:%M:%S') || ' -> ' || strftime(ts, '%d-%m-%y %H:%M:%S')
              || ' (7d)' AS label,
            CASE WHEN event_type <> 'error' THEN date_trunc('second', ts) END AS parsed FROM events""",
        "scalar_labels": f"""SELECT c_custkey AS {DEVICE}, CASE WHEN c_acctbal > 0 THEN 'Attivo' ELSE 'Non attivo' END
            AS status, CASE WHEN c_mktsegment = 'BUILDING' THEN 'Non specificata' ELSE c_mktsegment END AS place
            FROM customer""",
        "stream_throttle": THROTTLE,
        # The watermark ends 17 days before the last event, in whole milliseconds.
        "stream_throttle_late": f"""{THROTTLE} WHERE epoch_us({TIME}) // 1000
            < (SELECT max(epoch_us(ts)) // 1000 FROM events) - 17 * 86400000""",
        "stream_pivot": f"""SELECT user_id AS device_id, date_trunc('day', ts) AS ts_s, {PIVOT} FROM events GROUP BY 1, 2""",
        "stream_daily_mean": f"""WITH {EVENTS}, {daily('events_clean')}
            SELECT {DEVICE}, giorno, {r6('flow_avg_day')} AS flow_avg_day FROM daily""",
        "stream_latest": f"SELECT user_id AS {DEVICE}, max(ts) AS latest_measurement FROM events GROUP BY 1",
        "stream_dedupe": f"SELECT user_id AS {DEVICE}, ts AS {TIME}, value AS {VALUE} FROM events",
        "stream_decode": f"""WITH RECURSIVE heard AS (SELECT * FROM events WHERE event_type NOT IN ('error', 'signup')),
            kept AS (SELECT user_id, min(epoch_us(ts) // 1000) AS ms FROM heard GROUP BY 1
              UNION ALL SELECT k.user_id, min(epoch_us(e.ts) // 1000) FROM kept k JOIN heard e
                ON e.user_id = k.user_id AND epoch_us(e.ts) // 1000 >= k.ms + 86400000 GROUP BY k.user_id, k.ms)
            {LONG_EVENTS} heard SEMI JOIN kept ON heard.user_id = kept.user_id AND epoch_us(heard.ts) // 1000 = kept.ms""",
    }

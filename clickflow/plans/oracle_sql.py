"""Independent DuckDB SQL for every registered query (the correctness oracle).

The adapters below re-derive the click-log tables from the provided tables in
DuckDB's dialect; each oracle is ``WITH <adapters>, <own ctes> SELECT …``.
Aggregates are cast to the Spark result types (DuckDB sums are 128-bit).
"""

from __future__ import annotations

from clickflow.params import DEFAULT_PARAMS, TaskParams

ADAPTERS = """
ev AS (
  SELECT event_id, ts, user_id, event_type,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS k
  FROM events
),
user_visit_action AS (
  SELECT strftime(ts, '%Y-%m-%d') AS date,
         user_id,
         user_id || '_' || strftime(ts, '%Y%m%d') AS session_id,
         event_id % 10 AS page_id,
         strftime(date_trunc('day', ts)::TIMESTAMP
                  + to_seconds(date_diff('second', date_trunc('day', ts)::TIMESTAMP, ts) // 40),
                  '%Y-%m-%d %H:%M:%S') AS action_time,
         CASE WHEN event_type = 'view' THEN 'kw' || (k % 10) END AS search_keyword,
         CASE WHEN event_type = 'click' THEN k ELSE -1 END AS click_category_id,
         CASE WHEN event_type = 'click' THEN event_id % 100 ELSE -1 END AS click_product_id,
         CASE WHEN event_type = 'signup' THEN k || ',' || ((k + 7) % 100) END AS order_category_ids,
         CASE WHEN event_type = 'signup' THEN CAST(event_id % 100 AS VARCHAR) END AS order_product_ids,
         CASE WHEN event_type = 'purchase' THEN CAST(k AS VARCHAR) END AS pay_category_ids,
         CASE WHEN event_type = 'purchase' THEN CAST(event_id % 100 AS VARCHAR) END AS pay_product_ids,
         event_id % 12 AS city_id,
         event_id
  FROM ev
),
user_info AS (
  SELECT c_custkey AS user_id, 'user' || c_custkey AS username, c_name AS name,
         CAST((7 * c_custkey) % 60 AS INTEGER) AS age, c_mktsegment AS professional,
         'city' || c_nationkey AS city,
         CASE WHEN c_custkey % 2 = 0 THEN 'male' ELSE 'female' END AS sex
  FROM customer
),
product_info AS (
  SELECT p_partkey AS product_id, p_name AS product_name,
         '{"product_status": ' || (p_size % 2) || '}' AS extend_info
  FROM part
),
ad_log AS (
  SELECT concat_ws(' ', epoch_us(ts) // 1000, user_id % 10, user_id % 10, user_id, k % 20) AS value
  FROM ev
),
ad_click AS (
  SELECT CAST(split_part(value, ' ', 1) AS BIGINT) AS ts_millis,
         strftime(epoch_ms(CAST(split_part(value, ' ', 1) AS BIGINT)), '%Y%m%d') AS date,
         split_part(value, ' ', 2) AS province,
         split_part(value, ' ', 3) AS city,
         CAST(split_part(value, ' ', 4) AS BIGINT) AS userid,
         CAST(split_part(value, ' ', 5) AS BIGINT) AS adid
  FROM ad_log
)"""


# Fixed values, written out here so that the oracle does not read the library's own tables.
CITY_CTE = """city_area_info AS (SELECT * FROM (VALUES
  (0, '北京', '华北'),
  (1, '上海', '华东'),
  (2, '南京', '华东'),
  (3, '广州', '华南'),
  (4, '三亚', '华南'),
  (5, '武汉', '华中'),
  (6, '长沙', '华中'),
  (7, '西安', '西北'),
  (8, '成都', '西南'),
  (9, '哈尔滨', '东北')
) AS t(city_id, city_name, area))"""

AREA_LEVEL_CASE = """CASE WHEN area IN ('华北', '华东') THEN 'A_Level' WHEN area IN ('华中', '华南') THEN 'B_Level'
 WHEN area IN ('西南', '西北') THEN 'C_Level' ELSE 'D_Level' END"""

# Condition of each bucket.
VISIT_BUCKET_SQL = {
    "1s_3s": "BETWEEN 1 AND 3",
    "4s_6s": "BETWEEN 4 AND 6",
    "7s_9s": "BETWEEN 7 AND 9",
    "10s_30s": "BETWEEN 10 AND 30",
    "30s_60s": "BETWEEN 31 AND 60",
    "1m_3m": "BETWEEN 61 AND 180",
    "3m_10m": "BETWEEN 181 AND 600",
    "10m_30m": "BETWEEN 601 AND 1800",
    "30m": "> 1800",
}
STEP_BUCKET_SQL = {
    "1_3": "BETWEEN 1 AND 3",
    "4_6": "BETWEEN 4 AND 6",
    "7_9": "BETWEEN 7 AND 9",
    "10_30": "BETWEEN 10 AND 30",
    "30_60": "BETWEEN 31 AND 60",
    "60": "> 60",
}


def with_(*ctes: str) -> str:
    parts = [ADAPTERS.strip(), CITY_CTE, *[c.strip() for c in ctes]]
    return "WITH " + ",\n".join(parts)


def _in_list(values: str) -> str:
    return ", ".join(f"'{v.strip()}'" for v in values.split(","))


def ratio_sql(count: str, total: str, scale: int = 2) -> str:
    p = 10**scale
    return (
        f"CASE WHEN {total} > 0 THEN CAST(floor(({count} * {2 * p} + {total}) / ({total} * 2)) AS DOUBLE) / {p} END"
    )


# ------------------------------------------------------------ session block

def actions_cte(p: TaskParams = DEFAULT_PARAMS) -> str:
    return f"""actions AS (
  SELECT * FROM user_visit_action WHERE date BETWEEN '{p.start_date}' AND '{p.end_date}'
)"""


SESSION_SUMMARY_CTE = """summary AS (
  SELECT session_id,
         min(user_id) AS user_id,
         strftime(min(CAST(action_time AS TIMESTAMP)), '%Y-%m-%d %H:%M:%S') AS start_time,
         date_diff('second', min(CAST(action_time AS TIMESTAMP)), max(CAST(action_time AS TIMESTAMP))) AS visit_length,
         count(*) AS step_length,
         coalesce(array_to_string(list_sort(list_distinct(
             list(search_keyword) FILTER (WHERE search_keyword IS NOT NULL AND search_keyword <> ''))), ','), '')
           AS search_keywords,
         coalesce(array_to_string(list_sort(list_distinct(
             list(click_category_id) FILTER (WHERE click_category_id <> -1))), ','), '') AS click_category_ids
  FROM actions GROUP BY session_id
)"""

FULL_INFO_CTE = """full_info AS (
  SELECT s.session_id, s.user_id, s.start_time, s.visit_length, s.step_length, s.search_keywords,
         s.click_category_ids, u.age, u.professional, u.city, u.sex
  FROM summary s JOIN user_info u ON s.user_id = u.user_id
)"""


def session_where(p: TaskParams) -> str:
    conds = []
    if p.start_age is not None and p.end_age is not None:
        conds.append(f"coalesce(age BETWEEN {p.start_age} AND {p.end_age}, false)")
    if p.professionals:
        conds.append(f"coalesce(professional IN ({_in_list(p.professionals)}), false)")
    if p.cities:
        conds.append(f"coalesce(city IN ({_in_list(p.cities)}), false)")
    if p.sex:
        conds.append(f"coalesce(sex = '{p.sex}', false)")
    if p.keywords:
        conds.append(f"coalesce(list_has_any(string_split(search_keywords, ','), [{_in_list(p.keywords)}]), false)")
    if p.category_ids:
        conds.append(
            f"coalesce(list_has_any(string_split(click_category_ids, ','), [{_in_list(p.category_ids)}]), false)"
        )
    return " AND ".join(conds) if conds else "true"


def filtered_cte(p: TaskParams) -> str:
    return f"filtered AS (SELECT * FROM full_info WHERE {session_where(p)})"


def session_base(p: TaskParams = DEFAULT_PARAMS, *extra: str) -> str:
    return with_(actions_cte(p), SESSION_SUMMARY_CTE, FULL_INFO_CTE, filtered_cte(p), *extra)


# ----------------------------------------------------------- category block

FA_CTE = "fa AS (SELECT * FROM actions WHERE session_id IN (SELECT session_id FROM filtered))"

CAT_EVENTS_CTE = """cat_events AS (
  SELECT session_id, category_id, kind FROM (
    SELECT session_id, click_category_id AS category_id, 1 AS kind FROM fa WHERE click_category_id <> -1
    UNION ALL
    SELECT session_id, TRY_CAST(trim(x) AS BIGINT), 2 FROM (
      SELECT session_id, unnest(string_split(order_category_ids, ',')) AS x FROM fa WHERE order_category_ids IS NOT NULL)
    UNION ALL
    SELECT session_id, TRY_CAST(trim(x) AS BIGINT), 3 FROM (
      SELECT session_id, unnest(string_split(pay_category_ids, ',')) AS x FROM fa WHERE pay_category_ids IS NOT NULL)
  ) WHERE category_id IS NOT NULL
)"""

FULL_COUNT_CTE = """full_count AS (
  SELECT category_id,
         count(*) FILTER (WHERE kind = 1) AS click_count,
         count(*) FILTER (WHERE kind = 2) AS order_count,
         count(*) FILTER (WHERE kind = 3) AS pay_count
  FROM cat_events GROUP BY category_id
)"""

TOP10_CTE = """top10 AS (
  SELECT * FROM full_count ORDER BY click_count DESC, order_count DESC, pay_count DESC, category_id ASC LIMIT 10
)"""


def category_base(p: TaskParams = DEFAULT_PARAMS, *extra: str) -> str:
    return session_base(p, FA_CTE, CAT_EVENTS_CTE, FULL_COUNT_CTE, TOP10_CTE, *extra)


# -------------------------------------------------------------- funnel block

TRANSITIONS_CTE = """transitions AS (
  SELECT session_id, from_event_id, from_page_id, to_page_id FROM (
    SELECT session_id, event_id AS from_event_id, page_id AS from_page_id,
           lead(page_id) OVER w AS to_page_id, lead(event_id) OVER w AS to_event_id
    FROM actions
    WINDOW w AS (PARTITION BY session_id ORDER BY CAST(action_time AS TIMESTAMP), event_id)
  ) WHERE to_event_id IS NOT NULL
)"""


def flow_values(p: TaskParams) -> str:
    rows = ", ".join(f"({pos}, {a}, {b})" for pos, a, b in p.page_pairs)
    return f"flow AS (SELECT CAST(pos AS INTEGER) AS pos, CAST(a AS BIGINT) AS from_page_id, CAST(b AS BIGINT) AS to_page_id FROM (VALUES {rows}) AS t(pos, a, b))"


PAIR_COUNT_CTE = """pair_count AS (
  SELECT t.from_page_id || '_' || t.to_page_id AS pair, t.from_page_id, t.to_page_id, count(*) AS pair_count
  FROM transitions t JOIN flow f ON t.from_page_id = f.from_page_id AND t.to_page_id = f.to_page_id
  GROUP BY ALL
)"""


def funnel_base(p: TaskParams = DEFAULT_PARAMS, *extra: str) -> str:
    return with_(actions_cte(p), TRANSITIONS_CTE, flow_values(p), PAIR_COUNT_CTE, *extra)


# ---------------------------------------------------------------- area block

AREA_CTES = (
    "clicks AS (SELECT city_id, click_product_id FROM actions WHERE click_product_id <> -1)",
    """basic AS (
  SELECT c.city_id, ci.city_name, ci.area, c.click_product_id AS pid
  FROM clicks c JOIN city_area_info ci ON c.city_id = ci.city_id
)""",
    """area_count AS (
  SELECT area, pid, count(*) AS click_count,
         coalesce(array_to_string(list_sort(list_distinct(list(city_id || ':' || city_name))), ','), '') AS city_infos
  FROM basic GROUP BY area, pid
)""",
    """area_info AS (
  SELECT a.area, a.city_infos, a.pid, p.product_name,
         CASE WHEN json_extract_string(p.extend_info, '$.product_status') = '0' THEN 'Self' ELSE 'Third Party' END
           AS product_status,
         a.click_count
  FROM area_count a JOIN product_info p ON a.pid = p.product_id
)""",
    """area_ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY area ORDER BY click_count DESC, pid ASC) AS INTEGER) AS rank
  FROM area_info
)""",
)


def area_base(p: TaskParams = DEFAULT_PARAMS, *extra: str) -> str:
    return with_(actions_cte(p), *AREA_CTES, *extra)




# ------------------------------------------------------------------ ad block

def ad_ctes(threshold: int, src: str = "ad_click", pre: str = "") -> tuple[str, ...]:
    """Ad statistics over ``src``; CTE names get the prefix ``pre``."""
    return (
        f"{pre}user_counts AS (SELECT date, userid, adid, count(*) AS click_count FROM {src} GROUP BY ALL)",
        f"{pre}blacklist AS (SELECT DISTINCT userid FROM {pre}user_counts WHERE click_count > {threshold})",
        f"{pre}clean AS (SELECT * FROM {src} WHERE userid NOT IN (SELECT userid FROM {pre}blacklist))",
        f"""{pre}city_counts AS (
  SELECT date, province, city, adid, count(*) AS click_count FROM {pre}clean GROUP BY ALL
)""",
        f"""{pre}province_counts AS (
  SELECT date, province, adid, CAST(sum(click_count) AS BIGINT) AS click_count FROM {pre}city_counts GROUP BY ALL
)""",
        f"""{pre}province_top3 AS (
  SELECT date, province, adid, click_count FROM (
    SELECT *, row_number() OVER (PARTITION BY date, province ORDER BY click_count DESC, adid ASC) AS rank
    FROM {pre}province_counts) WHERE rank <= 3
)""",
        f"""{pre}trend AS (
  SELECT substr(k, 1, 8) AS date, substr(k, 9, 2) AS hour, substr(k, 11, 2) AS minute, adid, count(*) AS click_count
  FROM (SELECT strftime(epoch_ms(ts_millis), '%Y%m%d%H%M') AS k, adid FROM {pre}clean) GROUP BY ALL
)""",
    )


def ad_base(threshold: int, *extra: str) -> str:
    return with_(*ad_ctes(threshold), *extra)


def ad_slice(pre: str, condition: str, threshold: int) -> tuple[str, ...]:
    """Ad statistics over the clicks whose event time satisfies ``condition``."""
    return (
        f"{pre}ad_click AS (SELECT * FROM ad_click WHERE epoch_ms(ts_millis) {condition})",
        *ad_ctes(threshold, f"{pre}ad_click", pre),
    )


# --------------------------------------------------------- helpers, sampling

def kv_field_sql(field: str) -> str:
    """Value of a field of a ``k=v|k=v`` record: split, keep the field's part, cut its name."""
    parts = f"[p FOR p IN string_split(record, '|') IF starts_with(p, '{field}=')]"
    return f"nullif(substr(({parts})[1], {len(field) + 2}), '')"


RECORD_SQL = (
    "'sessionid=' || session_id || '|searchKeywords=' || search_keywords || '|clickCategoryIds=' || "
    "click_category_ids || '|visitLength=' || visit_length || '|stepLength=' || step_length || "
    "'|startTime=' || start_time"
)

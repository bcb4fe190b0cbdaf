"""DuckDB SQL of the derived views (FIXTURES.md §2), for the oracles.

The oracle of every query starts from the driver's base tables; these
CTEs restate the derived click-log views in plain SQL, independently of
the DataFrame code in ``shoplens.sources.tables``.
"""

from __future__ import annotations


def _actions(d: int) -> str:
    return f"""
  SELECT event_id AS action_id,
         CAST(ts AS DATE) AS date,
         user_id,
         CASE WHEN user_id % 5 = 0 THEN CAST(user_id AS VARCHAR) || '_m' || CAST(month(ts) AS VARCHAR)
              WHEN user_id % 5 = 1 THEN CAST(user_id AS VARCHAR) || '_w' || CAST((day(ts) - 1) // 7 AS VARCHAR)
              ELSE CAST(user_id AS VARCHAR) || '_d' || CAST(day(ts) AS VARCHAR) END AS session_id,
         k % 10 AS page_id,
         CAST(CAST(ts AS DATE) AS TIMESTAMP)
           + to_seconds(CAST((hour(ts) * 3600 + minute(ts) * 60 + second(ts)) // {d} AS BIGINT)) AS action_time,
         CASE WHEN event_type = 'view' THEN 'kw' || CAST(k % 12 AS VARCHAR) END AS search_keyword,
         CASE WHEN event_type = 'click' THEN k END AS click_category_id,
         CASE WHEN event_type = 'click' THEN (event_id * 7 + k) % 200 END AS click_product_id,
         CASE WHEN event_type = 'signup' THEN CAST(k AS VARCHAR) || ',' || CAST((k * 7 + 1) % 100 AS VARCHAR) END
           AS order_category_ids,
         CASE WHEN event_type = 'purchase' THEN CAST(k AS VARCHAR) || ',' || CAST((k * 3 + 2) % 100 AS VARCHAR) END
           AS pay_category_ids,
         event_id % 25 AS city_id
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events) e"""


VIEWS = {
    "users": """
  SELECT c.c_custkey AS user_id, c.c_name AS username, c.c_name AS name,
         CAST(c.c_custkey % 60 AS INTEGER) AS age, c.c_mktsegment AS professional,
         n.n_name AS city, CASE WHEN c.c_custkey % 2 = 0 THEN 'male' ELSE 'female' END AS sex
  FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey""",
    "products": """
  SELECT p_partkey AS product_id, p_name AS product_name,
         '{"product_status": ' || CAST(p_size % 2 AS VARCHAR) || '}' AS extend_info
  FROM part""",
    "cities": """
  SELECT CAST(n.n_nationkey AS BIGINT) AS city_id, n.n_name AS city_name, r.r_name AS area_name
  FROM nation n LEFT JOIN region r ON n.n_regionkey = r.r_regionkey""",
    "ad_lines": """
  SELECT e.event_id,
         concat_ws(' ', CAST(epoch_us(e.ts) // 1000 AS VARCHAR), CAST(n.n_regionkey AS VARCHAR),
                   CAST(c.c_nationkey AS VARCHAR), CAST(e.user_id AS VARCHAR),
                   CAST(CAST(json_extract_string(e.props, '$.k') AS BIGINT) % 20 AS VARCHAR)) AS value
  FROM events e
  LEFT JOIN customer c ON e.user_id = c.c_custkey
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
  WHERE e.event_type = 'click'""",
    "ad_parsed": """
  SELECT event_id, value, p,
         len(p) >= 5 AND TRY_CAST(p[4] AS BIGINT) IS NOT NULL AND TRY_CAST(p[5] AS BIGINT) IS NOT NULL
           AND coalesce(TRY_CAST(p[1] AS BIGINT) BETWEEN -62135596800000 AND 253402300799999, false) AS is_valid
  FROM (SELECT event_id, value, string_split(value, ' ') AS p FROM ad_lines) x""",
    "ad_events": """
  SELECT event_id,
         CAST(p[1] AS BIGINT) AS time_ms, p[2] AS province,
         p[3] AS city, CAST(p[4] AS BIGINT) AS user_id, CAST(p[5] AS BIGINT) AS ad_id,
         strftime(epoch_ms(CAST(p[1] AS BIGINT)), '%Y-%m-%d') AS date,
         strftime(epoch_ms(CAST(p[1] AS BIGINT)), '%H') AS hour,
         strftime(epoch_ms(CAST(p[1] AS BIGINT)), '%M') AS minute
  FROM ad_parsed WHERE is_valid""",
}

# Views that other views read, in dependency order.
_DEPS = {"ad_parsed": ["ad_lines"], "ad_events": ["ad_lines", "ad_parsed"]}


def with_views(views, ctes: list[tuple[str, str]] | None = None, d: int = 1) -> str:
    """``WITH`` clause holding the named derived views, then ``ctes``."""
    names: list[str] = []
    for v in views:
        for dep in _DEPS.get(v, []) + [v]:
            if dep not in names:
                names.append(dep)
    parts = []
    for n in names:
        body = _actions(d) if n == "actions" else VIEWS[n]
        parts.append(f"{n} AS ({body}\n)")
    for n, body in ctes or []:
        parts.append(f"{n} AS (\n{body}\n)")
    return "WITH " + ",\n".join(parts) + "\n" if parts else ""


def sql(views, body: str, ctes: list[tuple[str, str]] | None = None, d: int = 1) -> str:
    """Full oracle statement: derived views + extra CTEs + final SELECT."""
    return with_views(views, ctes, d) + body

"""Two-stream operators, rule enrichment and functions.

Left stream = ``view`` events, right stream = ``purchase`` events of the same
user (the reference's create / pay pair).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalar as U
from ..operators import joins as J
from ..sources.tables import events, read_table
from .registry import query

ORDER = ["ts", "event_id"]


def _sides(spark, sf_dir, left_type="view", right_type="purchase"):
    ev = events(spark, sf_dir).select("event_id", "user_id", "ts", "event_type")
    left = ev.filter(F.col("event_type") == left_type).select(
        "user_id", F.col("event_id").alias("l_event_id"), F.col("ts").alias("l_ts"))
    right = ev.filter(F.col("event_type") == right_type).select(
        "user_id", F.col("event_id").alias("r_event_id"), F.col("ts").alias("r_ts"))
    return left, right


_IJ = """
SELECT l.user_id, l.event_id AS l_event_id, l.ts AS l_ts, r.event_id AS r_event_id, r.ts AS r_ts
FROM events l JOIN events r
  ON l.user_id = r.user_id AND r.ts BETWEEN l.ts + INTERVAL {lo} SECOND AND l.ts + INTERVAL {hi} SECOND
WHERE l.event_type = 'view' AND r.event_type = 'purchase'
"""


@query("interval_join", _IJ.format(lo=1000, hi=5000))
def interval_join(spark, sf_dir):
    """Purchases 1000..5000 s after a view of the same user."""
    left, right = _sides(spark, sf_dir)
    return J.interval_join(left, right, ["user_id"], "l_ts", "r_ts", 1000, 5000)


@query("interval_join_wide", _IJ.format(lo=3600, hi=86400))
def interval_join_wide(spark, sf_dir):
    """J1 with wide bounds: purchases 1..24 h after a view."""
    left, right = _sides(spark, sf_dir)
    return J.interval_join(left, right, ["user_id"], "l_ts", "r_ts", "1 hour", "24 hours")


@query("window_join", """
SELECT l.user_id, time_bucket(INTERVAL 1 DAY, l.ts) AS window_start,
       time_bucket(INTERVAL 1 DAY, l.ts) + INTERVAL 1 DAY AS window_end,
       l.event_id AS l_event_id, l.ts AS l_ts, r.event_id AS r_event_id, r.ts AS r_ts
FROM events l JOIN events r
  ON l.user_id = r.user_id AND time_bucket(INTERVAL 1 DAY, l.ts) = time_bucket(INTERVAL 1 DAY, r.ts)
WHERE l.event_type = 'view' AND r.event_type = 'purchase'
""")
def window_join(spark, sf_dir):
    """View x purchase pairs of a user in the same 1-day window."""
    left, right = _sides(spark, sf_dir)
    return J.window_join(left, right, ["user_id"], "l_ts", "r_ts", "1 day")


_TAGGED = """
SELECT user_id, time_bucket(INTERVAL 1 DAY, ts) AS window_start,
       time_bucket(INTERVAL 1 DAY, ts) + INTERVAL 1 DAY AS window_end,
       CASE WHEN event_type = 'view' THEN 'left' ELSE 'right' END AS side, event_id AS element_id
FROM events WHERE event_type IN ('view', 'purchase')"""

_GROUPS = f"""
SELECT user_id, window_start, window_end,
       count(CASE WHEN side = 'left' THEN 1 END) AS n_left,
       count(CASE WHEN side = 'right' THEN 1 END) AS n_right,
       min(CASE WHEN side = 'left' THEN element_id END) AS left_first,
       max(CASE WHEN side = 'left' THEN element_id END) AS left_last,
       min(CASE WHEN side = 'right' THEN element_id END) AS right_first,
       max(CASE WHEN side = 'right' THEN element_id END) AS right_last
FROM ({_TAGGED}) GROUP BY 1, 2, 3"""


@query("window_cogroup", _GROUPS)
def window_cogroup(spark, sf_dir):
    """Views and purchases co-grouped per (user, day), also one-sided groups."""
    left, right = _sides(spark, sf_dir)
    return J.window_cogroup(left, right, ["user_id"], "l_ts", "r_ts", "l_event_id", "r_event_id", "1 day")


@query("window_cogroup_members", f"""
SELECT t.user_id, t.window_start, t.window_end, t.side, t.element_id, g.n_left, g.n_right
FROM ({_TAGGED}) t JOIN ({_GROUPS}) g ON t.user_id = g.user_id AND t.window_start = g.window_start
""")
def window_cogroup_members(spark, sf_dir):
    """J3 element form: every co-grouped element with its side and group sizes."""
    left, right = _sides(spark, sf_dir)
    return J.window_cogroup_members(left, right, ["user_id"], "l_ts", "r_ts",
                                    "l_event_id", "r_event_id", "1 day")


@query("reconcile", """
SELECT coalesce(l.user_id, r.user_id) AS user_id, l.event_id AS l_event_id, l.ts AS l_ts,
       r.event_id AS r_event_id, r.ts AS r_ts,
       CASE WHEN l.event_id IS NULL THEN 'right_only' WHEN r.event_id IS NULL THEN 'left_only'
            ELSE 'matched' END AS status
FROM (SELECT * FROM events WHERE event_type = 'view') l
FULL JOIN (SELECT * FROM events WHERE event_type = 'purchase') r
  ON l.user_id = r.user_id AND r.ts BETWEEN l.ts - INTERVAL 5 HOUR AND l.ts + INTERVAL 5 HOUR
""")
def reconcile(spark, sf_dir):
    """Reconcile views and purchases of a user within 5 h of each other."""
    left, right = _sides(spark, sf_dir)
    return J.reconcile(left, right, ["user_id"], "l_ts", "r_ts", "l_event_id", "r_event_id", "5 hours")


@query("reconcile_one_to_one", """
WITH RECURSIVE e AS (
  SELECT user_id, event_id, ts, event_type = 'view' AS l,
         row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn
  FROM events WHERE event_type IN ('view', 'purchase')),
-- waiting rows are of one side at a time: a row joins them or takes the oldest
walk AS (
  SELECT user_id, rn, l AS side, [{'id': event_id, 'ts': ts}] AS q, NULL::STRUCT(id BIGINT, ts TIMESTAMP) AS took,
         [{'id': event_id, 'ts': ts}][1:0] AS failed
  FROM e WHERE rn = 1
  UNION ALL
  SELECT user_id, rn,
         CASE WHEN len(open) = 0 THEN l ELSE side END,
         CASE WHEN len(open) = 0 THEN [{'id': event_id, 'ts': ts}]
              WHEN l = side THEN list_append(open, {'id': event_id, 'ts': ts}) ELSE open[2:] END,
         CASE WHEN len(open) > 0 AND l <> side THEN open[1] END, failed
  FROM (SELECT e.user_id, e.rn, e.event_id, e.ts, e.l, w.side,
               list_filter(w.q, lambda x: x.ts + INTERVAL 5 HOUR >= e.ts) AS open,
               list_filter(w.q, lambda x: x.ts + INTERVAL 5 HOUR < e.ts) AS failed
        FROM walk w JOIN e ON e.user_id = w.user_id AND e.rn = w.rn + 1)),
pairs AS (SELECT e.user_id, e.event_id, e.ts, e.l, w.took.id AS o_id, w.took.ts AS o_ts
          FROM walk w JOIN e ON e.user_id = w.user_id AND e.rn = w.rn WHERE w.took IS NOT NULL),
used AS (SELECT event_id AS id FROM pairs UNION ALL SELECT o_id FROM pairs)
SELECT user_id, CASE WHEN l THEN event_id ELSE o_id END AS l_event_id, CASE WHEN l THEN ts ELSE o_ts END AS l_ts,
       CASE WHEN l THEN o_id ELSE event_id END AS r_event_id, CASE WHEN l THEN o_ts ELSE ts END AS r_ts,
       'matched' AS status
FROM pairs
UNION ALL
SELECT user_id, CASE WHEN l THEN event_id END, CASE WHEN l THEN ts END, CASE WHEN NOT l THEN event_id END,
       CASE WHEN NOT l THEN ts END, CASE WHEN l THEN 'left_only' ELSE 'right_only' END
FROM e WHERE event_id NOT IN (SELECT id FROM used)
""")
def reconcile_one_to_one(spark, sf_dir):
    """J4 one-to-one: in time order, a view takes the oldest waiting purchase of the
    user (and vice versa) if that is at most 5 h older; the rest are alone."""
    left, right = _sides(spark, sf_dir)
    return J.reconcile_one_to_one(left, right, ["user_id"], "l_ts", "r_ts", "l_event_id", "r_event_id", "5 hours")


# The rule stream of the enrichment query (start time, previous
# event type, next event type).
RULES = [("2024-01-01 00:00:00", "view", "purchase"),
         ("2024-01-10 00:00:00", "click", "error")]


def rules_frame(spark):
    values = ", ".join(f"(TIMESTAMP_NTZ'{t}', '{a}', '{b}')" for t, a, b in RULES)
    return spark.sql(f"SELECT * FROM VALUES {values} AS r(rule_ts, rule_prev, rule_next)")


@query("prev_event_rule", """
WITH e AS (
  SELECT event_id, user_id, ts, event_type,
         lag(event_id) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev_event_id,
         lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev_event_type
  FROM events),
rules AS (
  SELECT * FROM (VALUES (TIMESTAMP '2024-01-01 00:00:00', 'view', 'purchase'),
                        (TIMESTAMP '2024-01-10 00:00:00', 'click', 'error')) t(rule_ts, rule_prev, rule_next))
SELECT e.event_id, e.user_id, e.ts, e.event_type, e.prev_event_id, e.prev_event_type,
       r.rule_prev, r.rule_next,
       coalesce(e.prev_event_type = r.rule_prev AND e.event_type = r.rule_next, false) AS matched
FROM e ASOF LEFT JOIN rules r ON e.ts >= r.rule_ts
""")
def prev_event_rule(spark, sf_dir):
    """J5 + V1 + V3: previous event of the user, the rule in force, and whether
    (previous type, current type) equals the rule."""
    ev = events(spark, sf_dir).select("event_id", "user_id", "ts", "event_type")
    out = J.previous_with_rule(ev, rules_frame(spark), ["user_id"], ORDER, "ts",
                               ["event_id", "event_type"])
    return out.select(
        "event_id", "user_id", "ts", "event_type",
        F.col("prev.event_id").alias("prev_event_id"), F.col("prev.event_type").alias("prev_event_type"),
        F.col("rule.rule_prev").alias("rule_prev"), F.col("rule.rule_next").alias("rule_next"),
        F.coalesce((F.col("prev.event_type") == F.col("rule.rule_prev"))
                   & (F.col("event_type") == F.col("rule.rule_next")), F.lit(False)).alias("matched"))


@query("connect_map", r"""
SELECT 'first' AS src, CAST(xor(o_orderkey & 4294967295, 2147483648) - 2147483648 AS INTEGER) AS v
FROM orders
UNION ALL
SELECT 'second' AS src, CAST(regexp_extract(c_name, '(-?\d+)', 1) AS INTEGER) AS v FROM customer
""")
def connect_map(spark, sf_dir):
    """Long keys (wrapped to Int) and String names (digits to Int) merged."""
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey")
    cust = read_table(spark, sf_dir, "customer").select("c_name")
    return J.connect_map(orders, cust, U.wrap_int("o_orderkey"), U.digits_to_int("c_name"))


def _duck_hash(col: str) -> str:
    """The JVM string hash in DuckDB, over UTF-16 units like the Spark expression."""
    unit = (f"list_reduce(list_transform(string_split({col}, ''), lambda c: ord(c)), lambda h, u: "
            "CASE WHEN u < 65536 THEN (h * 31 + u) % 4294967296 "
            "ELSE ((h * 31 + 55296 + (u - 65536) // 1024) * 31 + 56320 + (u - 65536) % 1024) % 4294967296 END, 0::BIGINT)")
    h = f"(CASE WHEN coalesce({col}, '') = '' THEN 0 ELSE {unit} END)"
    return f"CASE WHEN {col} IS NULL THEN NULL ELSE CAST((CASE WHEN {h} >= 2147483648 THEN {h} - 4294967296 ELSE {h} END) AS INTEGER) END"


@query("udf_hash", f"SELECT c_custkey, c_name, {_duck_hash('c_name')} AS h FROM customer")
def udf_hash(spark, sf_dir):
    """The JVM string hash of customer names, as a native expression."""
    cust = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return cust.select("c_custkey", "c_name", U.java_hash("c_name").alias("h"))


@query("text_hash", f"SELECT doc_id, {_duck_hash('text')} AS h FROM documents")
def text_hash(spark, sf_dir):
    """U1 on whole document texts (long, several scripts)."""
    return read_table(spark, sf_dir, "documents").select("doc_id", U.java_hash("text").alias("h"))


@query("lateral_first_char", f"""
SELECT c_custkey, c_name, {_duck_hash('c_name')} AS name_hash, left(c_name, 1) AS first_char,
       CAST(length(left(c_name, 1)) AS INTEGER) AS n_chars
FROM customer
""")
def lateral_first_char(spark, sf_dir):
    """J7 + U2 + U3: a registered scalar function, and per customer the rows of a
    registered table function, joined laterally in SQL."""
    U.register_sql_functions(spark)
    return spark.sql("""
        SELECT c.c_custkey, c.c_name, jvm_hash(c.c_name) AS name_hash, f.first_char, f.n_chars
        FROM {customer} AS c JOIN LATERAL leading_char(c.c_name) AS f""",
                     customer=read_table(spark, sf_dir, "customer"))

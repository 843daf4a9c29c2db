"""DuckDB SQL for the registered queries, over the same Parquet tables."""

from __future__ import annotations

# FIXTURES.md, part 2, in DuckDB's spelling.
INPUTS = """
WITH c AS (
  SELECT c_custkey AS id, c_name AS name,
         lower(replace(c_name, '#', '.')) || '@' || lower(c_mktsegment) || '.example.com' AS email,
         TIMESTAMP '1995-01-01 00:00:00' AS created_at
  FROM customer
  UNION ALL
  SELECT c_custkey + 10000000, c_name || '.idle',
         'idle.' || lower(replace(c_name, '#', '.')) || '@' || lower(c_mktsegment) || '.example.com',
         TIMESTAMP '1995-01-01 00:00:00'
  FROM customer WHERE c_custkey % 3 = 0
), o AS (
  SELECT o_orderkey AS id, o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS order_date,
         CAST(o_totalprice AS DECIMAL(10,2)) AS amount,
         CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'pending' ELSE 'shipped' END AS status,
         o_orderdate AS created_at
  FROM orders
), c3 AS (
  SELECT id AS customer_id, email, name, created_at, created_at AS updated_at FROM c
), p AS (
  SELECT p_partkey AS product_id, 'PROD-' || CAST(p_partkey AS VARCHAR) AS sku, p_name AS name,
         CAST(p_retailprice AS DECIMAL(10,2)) AS price, p_type AS category,
         TIMESTAMP '1995-01-01 00:00:00' AS created_at
  FROM part
), o3 AS (
  SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderkey % 200 AS product_id,
         o_orderkey % 5 + 1 AS quantity, CAST(o_totalprice AS DECIMAL(10,2)) AS total_amount,
         o_orderstatus AS order_status, o_orderdate AS created_at, o_orderdate AS updated_at
  FROM orders
), chg AS (
  SELECT 'INSERT' AS mod_type, CAST(1 AS BIGINT) AS seq, id, customer_id, order_date, amount, status, created_at,
         created_at AS commit_ts FROM o
  UNION ALL
  SELECT 'UPDATE', CAST(2 AS BIGINT), id,
         CASE WHEN id % 9 = 0 THEN GREATEST(customer_id - 1, 1) ELSE customer_id END, order_date, CAST(amount * 1.1 AS DECIMAL(10,2)), 'delivered',
         created_at, created_at + INTERVAL '1' DAY FROM o WHERE id % 3 = 0
  UNION ALL
  SELECT 'DELETE', CAST(3 AS BIGINT), id, customer_id, order_date, amount, status, created_at,
         created_at + INTERVAL '2' DAY FROM o WHERE id % 5 = 0
), chg_c AS (
  SELECT 'INSERT' AS mod_type, CAST(1 AS BIGINT) AS seq, id, name, email, created_at, created_at AS commit_ts FROM c
  UNION ALL
  SELECT 'UPDATE', CAST(2 AS BIGINT), id, name, 'updated.' || email, created_at, created_at + INTERVAL '1' DAY
  FROM c WHERE id % 4 = 0
  UNION ALL
  SELECT 'DELETE', CAST(3 AS BIGINT), id, name, email, created_at, created_at + INTERVAL '2' DAY
  FROM c WHERE id % 21 = 0
), o_bad AS (
  SELECT id, customer_id, order_date, amount, status, created_at FROM o
  UNION ALL SELECT id, customer_id, order_date, amount, status, created_at FROM o WHERE id % 100 = 0
  UNION ALL SELECT id + 10000000, CAST(-1 AS BIGINT), order_date, amount, status, created_at FROM o WHERE id % 101 = 0
  UNION ALL SELECT id + 20000000, customer_id, order_date, amount, CAST(NULL AS VARCHAR), created_at
  FROM o WHERE id % 97 = 0
), o_final AS (
  SELECT id, customer_id, order_date, amount, status, created_at FROM (
    SELECT *, row_number() OVER (PARTITION BY id ORDER BY commit_ts DESC, seq DESC) AS rn FROM chg)
  WHERE rn = 1 AND mod_type <> 'DELETE'
), o_updated AS (
  SELECT id, customer_id, order_date, amount, status, created_at FROM (
    SELECT *, row_number() OVER (PARTITION BY id ORDER BY commit_ts DESC, seq DESC) AS rn FROM chg
    WHERE mod_type <> 'DELETE')
  WHERE rn = 1
), env AS (
  SELECT 'mysql-cdc.appdb.sales' AS topic, id AS "offset", 'c' AS kind,
         '{"id":' || id || ',"qty":' || (id % 5 + 1) || ',"price":"' || amount || '"}' AS after,
         '{"before":null,"after":{"id":' || id || ',"qty":' || (id % 5 + 1) || ',"price":"' || amount
           || '"},"op":"c"}' AS value FROM o
  UNION ALL
  SELECT 'mysql-cdc.appdb.sales', id + 1000000, 'd', NULL, '{"before":{"id":' || id || '},"after":null,"op":"d"}'
  FROM o WHERE id % 5 = 0
), c_final AS (
  SELECT id, name, email, created_at FROM (
    SELECT *, row_number() OVER (PARTITION BY id ORDER BY commit_ts DESC, seq DESC) AS rn FROM chg_c)
  WHERE rn = 1 AND mod_type <> 'DELETE'
)"""

# The models, over the tables as given or as they are after all changes.
MODEL_VIEWS = """, co AS (
  SELECT o.id AS order_id, o.customer_id, c.name AS customer_name, c.email AS customer_email, o.amount,
         o.order_date, o.status, o.created_at AS order_created_at
  FROM {o} o JOIN {c} c ON o.customer_id = c.id
), summary AS (
  SELECT c.id AS customer_id, c.name AS customer_name, c.email AS customer_email, COUNT(o.id) AS order_count,
         CAST(COALESCE(SUM(o.amount), 0) AS DECIMAL(20,2)) AS total_spent,
         CASE WHEN COUNT(o.amount) = 0 THEN CAST(0 AS DOUBLE)
              ELSE CAST(SUM(o.amount) AS DOUBLE) / COUNT(o.amount) END AS avg_order_amount,
         MAX(o.order_date) AS last_order_date
  FROM {c} c LEFT JOIN {o} o ON c.id = o.customer_id GROUP BY c.id, c.name, c.email
), tiers AS (
  SELECT customer_id, customer_name, customer_email, total_spent, order_count,
         CASE WHEN total_spent < 1500000 THEN 'Bronze' WHEN total_spent < 2500000 THEN 'Silver' ELSE 'Gold' END
           AS customer_tier
  FROM summary
), dashboard AS (
  SELECT status, COUNT(*) AS order_count, CAST(SUM(amount) AS DECIMAL(20,2)) AS total_amount,
         CAST(SUM(amount) AS DOUBLE) / COUNT(amount) AS avg_amount,
         MIN(order_date) AS earliest_order, MAX(order_date) AS latest_order
  FROM {o} o GROUP BY status
), daily AS (
  SELECT date_trunc('day', created_at) AS metric_date, COUNT(*) AS total_orders,
         CAST(SUM(amount) AS DECIMAL(20,2)) AS daily_revenue,
         CAST(SUM(amount) AS DOUBLE) / COUNT(amount) AS avg_order_value,
         COUNT(DISTINCT customer_id) AS unique_customers
  FROM {o} o GROUP BY 1
), spending AS (
  SELECT c.name, COUNT(o.id) AS order_count, CAST(SUM(o.amount) AS DECIMAL(20,2)) AS total_spent
  FROM {c} c JOIN {o} o ON c.id = o.customer_id GROUP BY c.name
), days AS (
  SELECT order_date, COUNT(*) AS orders, CAST(SUM(amount) AS DECIMAL(20,2)) AS revenue FROM {o} o GROUP BY order_date
)
"""

# Row images as JSON text.
ORDER_JSON = """'{"id":' || id || ',"customer_id":' || customer_id || ',"order_date":"' || order_date
        || '","amount":' || amount || ',"status":"' || status || '","created_at":"'
        || strftime(created_at, '%Y-%m-%d %H:%M:%S') || '"}'"""
CUSTOMER_JSON = """'{"id":' || id || ',"name":"' || name || '","email":"' || email || '","created_at":"'
        || strftime(created_at, '%Y-%m-%d %H:%M:%S') || '"}'"""
SHOP_JSON = """SELECT 'customers' AS table_name, '{"customer_id":' || customer_id || ',"email":"' || email || '","name":"'
          || name || '","created_at":"' || strftime(created_at, '%Y-%m-%d %H:%M:%S') || '","updated_at":"'
          || strftime(updated_at, '%Y-%m-%d %H:%M:%S') || '"}' AS data FROM c3
        UNION ALL SELECT 'products', '{"product_id":' || product_id || ',"sku":"' || sku || '","name":"' || name
          || '","price":' || price || ',"category":"' || category || '","created_at":"'
          || strftime(created_at, '%Y-%m-%d %H:%M:%S') || '"}' FROM p
        UNION ALL SELECT 'orders', '{"order_id":' || order_id || ',"customer_id":' || customer_id || ',"product_id":'
          || product_id || ',"quantity":' || quantity || ',"total_amount":' || total_amount || ',"order_status":"'
          || order_status || '","created_at":"' || strftime(created_at, '%Y-%m-%d %H:%M:%S') || '","updated_at":"'
          || strftime(updated_at, '%Y-%m-%d %H:%M:%S') || '"}' FROM o3"""
FEED_JSON = """'{"customer_id":"' || customer_id || '","product_id":' || product_id || ',"quantity":"' || quantity
        || '","total_amount":"' || CASE WHEN order_id % 17 = 0 THEN 'n/a' ELSE CAST(total_amount AS VARCHAR) END || '"'
        || CASE WHEN order_id % 7 = 0 THEN ',"coupon":"X1"' ELSE '' END || ',"order_status":"' || order_status || '"'
        || CASE WHEN order_id % 3 = 0 THEN '' ELSE
             ',"created_at":"' || strftime(created_at, '%Y-%m-%d %H:%M:%S') || '"' END || '}'"""
# Rows before (b) and after (a) each change; no row stands before an insert or after a delete.
IMAGES = """SELECT id, mod_type, seq, commit_ts, lag(a_amount) OVER w AS b_amount, lag(a_status) OVER w AS b_status,
        lag(a_customer) OVER w AS b_customer, a_amount, a_status, a_customer FROM (SELECT *,
          CASE WHEN mod_type <> 'DELETE' THEN customer_id END AS a_customer, CASE WHEN mod_type <> 'DELETE' THEN amount END AS a_amount,
          CASE WHEN mod_type <> 'DELETE' THEN status END AS a_status FROM chg)
        WINDOW w AS (PARTITION BY id ORDER BY commit_ts, seq)"""

BODIES: dict[str, str] = {
    # models
    "stg_customers": """SELECT id AS customer_id, name AS customer_name, email AS customer_email,
        created_at AS customer_created_at FROM c""",
    "stg_orders": """SELECT id AS order_id, customer_id, order_date, amount, status,
        created_at AS order_created_at FROM o""",
    "int_customer_orders": "SELECT * FROM co",
    "customer_order_summary": "SELECT * FROM summary",
    "high_value_orders": "SELECT * FROM co WHERE amount >= 400000",
    "order_status_dashboard": "SELECT * FROM dashboard",
    "daily_order_metrics": "SELECT * FROM daily",
    "customer_spending_tier": "SELECT * FROM tiers",
    "recent_orders": """SELECT customer_id, customer_name, order_id, amount, status, order_created_at AS created_at,
        row_number() OVER (PARTITION BY customer_id ORDER BY order_created_at DESC, order_id DESC) AS rank FROM co""",
    # projections and filters
    "select_all_orders": "SELECT * FROM o",
    "filter_high_value": """SELECT c.name, o.id, o.amount, o.status, o.order_date FROM c JOIN o ON c.id = o.customer_id
        WHERE o.amount > 400000 ORDER BY o.amount DESC, o.id""",
    "filter_pending": """SELECT c.name, o.id, o.amount, o.order_date FROM c JOIN o ON c.id = o.customer_id
        WHERE o.status = 'pending' ORDER BY o.order_date, o.id""",
    "filter_date_range": """SELECT * FROM o WHERE order_date BETWEEN DATE '1996-01-15' AND DATE '1996-03-17'
        ORDER BY order_date, amount, id""",
    "filter_in_list": """SELECT * FROM o WHERE amount > 250000 AND status IN ('completed', 'shipped')
        ORDER BY amount DESC, id""",
    "filter_like": "SELECT * FROM c WHERE name LIKE '%77%'",
    "case_tier": """SELECT id, amount, CASE WHEN amount < 150000 THEN 'Bronze' WHEN amount < 350000 THEN 'Silver'
        ELSE 'Gold' END AS tier FROM o""",
    "update_expr": """SELECT id, amount AS old_amount, CAST(amount * 1.1 AS DECIMAL(10,2)) AS amount,
        'delivered' AS status FROM o""",
    # joins
    "left_join_totals": """SELECT c.name, COUNT(o.id) AS order_count,
        CAST(COALESCE(SUM(o.amount), 0) AS DECIMAL(20,2)) AS total
        FROM c LEFT JOIN o ON c.id = o.customer_id GROUP BY c.name ORDER BY total DESC, c.name""",
    "customers_without_orders": """SELECT c.name, c.email FROM c LEFT JOIN o ON c.id = o.customer_id
        WHERE o.id IS NULL""",
    "self_join_same_amount": """SELECT a.event_id AS id_1, min(b.event_id) AS id_2, a.value AS amount,
        COUNT(*) AS later_matches
        FROM events a JOIN events b ON a.value = b.value AND a.event_id < b.event_id GROUP BY a.event_id, a.value""",
    "orders_above_own_avg": """SELECT c.name, o.id, o.amount, ca.avg_order FROM c JOIN o ON c.id = o.customer_id
        JOIN (SELECT c.id, CAST(SUM(o.amount) AS DOUBLE) / COUNT(o.amount) AS avg_order
              FROM c JOIN o ON c.id = o.customer_id GROUP BY c.id) ca ON c.id = ca.id
        WHERE CAST(o.amount AS DOUBLE) > ca.avg_order ORDER BY o.amount DESC, o.id""",
    "customers_above_avg_spend": """SELECT name, total_spent AS total FROM spending WHERE CAST(total_spent AS DOUBLE) >
        (SELECT CAST(SUM(total_spent) AS DOUBLE) / COUNT(*) FROM spending) ORDER BY total DESC, name""",
    # aggregates
    "revenue_by_customer": "SELECT name, order_count, total_spent FROM spending ORDER BY total_spent DESC, name",
    "summary_by_name_email": """SELECT c.name, c.email, COUNT(o.id) AS order_count,
        CAST(COALESCE(SUM(o.amount), 0) AS DECIMAL(20,2)) AS total_spent,
        CASE WHEN COUNT(o.amount) = 0 THEN CAST(0 AS DOUBLE)
             ELSE CAST(SUM(o.amount) AS DOUBLE) / COUNT(o.amount) END AS avg_order
        FROM c LEFT JOIN o ON c.id = o.customer_id GROUP BY c.name, c.email""",
    "revenue_by_status": """SELECT status, order_count AS orders, total_amount AS revenue, avg_amount AS avg_order
        FROM dashboard ORDER BY revenue DESC, status""",
    "daily_revenue": "SELECT * FROM days ORDER BY order_date",
    "spending_tier_adhoc": """SELECT name, total_spent, CASE WHEN total_spent < 1500000 THEN 'Bronze'
        WHEN total_spent < 2500000 THEN 'Silver' ELSE 'Gold' END AS tier FROM spending""",
    "tier_rollup": """SELECT customer_tier AS tier, COUNT(*) AS customer_count,
        CAST(ROUND(SUM(total_spent), 2) AS DECIMAL(20,2)) AS tier_revenue FROM tiers GROUP BY customer_tier
        ORDER BY CASE customer_tier WHEN 'Gold' THEN 1 WHEN 'Silver' THEN 2 ELSE 3 END""",
    "pivot_status_revenue": """SELECT c.name,
        CAST(COALESCE(SUM(CASE WHEN o.status = 'completed' THEN o.amount END), 0) AS DECIMAL(20,2)) AS completed_revenue,
        CAST(COALESCE(SUM(CASE WHEN o.status = 'pending' THEN o.amount END), 0) AS DECIMAL(20,2)) AS pending_revenue,
        CAST(COALESCE(SUM(CASE WHEN o.status = 'shipped' THEN o.amount END), 0) AS DECIMAL(20,2)) AS shipped_revenue,
        CAST(SUM(o.amount) AS DECIMAL(20,2)) AS total_revenue
        FROM c LEFT JOIN o ON c.id = o.customer_id GROUP BY c.name""",
    "having_count": """SELECT c.name, COUNT(o.id) AS order_count FROM c JOIN o ON c.id = o.customer_id GROUP BY c.name
        HAVING COUNT(o.id) > 10 ORDER BY order_count DESC, c.name""",
    "having_sum": """SELECT status, CAST(SUM(amount) AS DECIMAL(20,2)) AS revenue FROM o GROUP BY status
        HAVING SUM(amount) > 200000000 ORDER BY revenue DESC, status""",
    "distinct_amounts": "SELECT DISTINCT amount FROM o ORDER BY amount DESC",
    "unique_customers": "SELECT COUNT(DISTINCT customer_id) AS unique_customers FROM o",
    "row_counts": """SELECT 'customers_cdc' AS source, COUNT(*) AS row_count FROM c
        UNION ALL SELECT 'orders_cdc', COUNT(*) FROM o""",
    # windows
    "customer_spend_rank": "SELECT name, total_spent, RANK() OVER (ORDER BY total_spent DESC) AS rank FROM spending",
    "cumulative_revenue": """SELECT order_date, revenue AS daily_revenue,
        CAST(SUM(revenue) OVER (ORDER BY order_date) AS DECIMAL(20,2)) AS cumulative_revenue FROM days""",
    "top2_per_customer": """SELECT * FROM (SELECT c.name, o.id, o.amount, o.status,
        ROW_NUMBER() OVER (PARTITION BY c.id ORDER BY o.amount DESC, o.id) AS rn
        FROM c JOIN o ON c.id = o.customer_id) WHERE rn <= 2""",
    "amount_percent_rank": "SELECT id, amount, PERCENT_RANK() OVER (ORDER BY amount) AS percentile FROM o",
    "moving_avg_revenue": """SELECT order_date, revenue,
        CAST(SUM(revenue) OVER w AS DOUBLE) / COUNT(revenue) OVER w AS moving_avg FROM days
        WINDOW w AS (ORDER BY order_date ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)""",
    "recent_orders_top5": """SELECT customer_id, customer_name, order_id, CAST(ROUND(amount, 2) AS DECIMAL(20,2)) AS amount,
        status, created_at, rank FROM (SELECT *, order_created_at AS created_at, row_number() OVER
        (PARTITION BY customer_id ORDER BY order_created_at DESC, order_id DESC) AS rank FROM co) WHERE rank <= 5""",
    # sort, top-k, sets
    "order_multi": """SELECT c.name, o.amount, o.status, o.id FROM c JOIN o ON c.id = o.customer_id
        ORDER BY c.name ASC, o.amount DESC, o.id""",
    "inner_join_sorted": """SELECT c.name, o.id, o.amount, o.status FROM c JOIN o ON c.id = o.customer_id
        ORDER BY c.name, o.amount DESC, o.id""",
    "top5_orders": "SELECT * FROM o ORDER BY amount DESC, id LIMIT 5",
    "top10_customers": """SELECT customer_id, customer_name, order_count, total_spent,
        CAST(ROUND(CAST(avg_order_amount AS DECIMAL(28,6)), 2) AS DECIMAL(20,2)) AS avg_amount, last_order_date
        FROM summary ORDER BY total_spent DESC, customer_id LIMIT 10""",
    "last7_days": """SELECT metric_date AS date, total_orders, daily_revenue AS revenue,
        CAST(ROUND(CAST(avg_order_value AS DECIMAL(28,6)), 2) AS DECIMAL(20,2)) AS avg_value, unique_customers
        FROM daily ORDER BY metric_date DESC LIMIT 7""",
    "high_value_dashboard": """SELECT order_id, customer_name, CAST(ROUND(amount, 2) AS DECIMAL(20,2)) AS amount, status,
        CAST(order_created_at AS DATE) AS order_date FROM co WHERE amount >= 400000
        ORDER BY co.amount DESC, order_id LIMIT 10""",
    "dashboard_rounded": """SELECT status, order_count, CAST(ROUND(total_amount, 2) AS DECIMAL(20,2)) AS total_amount,
        CAST(ROUND(CAST(avg_amount AS DECIMAL(28,6)), 2) AS DECIMAL(20,2)) AS avg_amount FROM dashboard""",
    "union_distinct_names": """SELECT DISTINCT c.name FROM c JOIN o ON c.id = o.customer_id WHERE o.amount > 450000
        UNION SELECT name FROM c WHERE name LIKE '%77%'""",
    # scalar functions
    "scalar_dates": """SELECT id, date_trunc('day', created_at) AS day, date_trunc('month', created_at) AS month
        FROM o""",
    "revenue_by_dow": """SELECT order_date, DAYOFWEEK(order_date) AS day_of_week, orders, revenue FROM days""",
    "scalar_days_ago": """SELECT id, order_date, DATE '2025-01-31' - order_date AS days_ago,
        CAST(DATE_TRUNC('month', order_date) AS TIMESTAMP) AS month FROM o""",
    "email_domain": "SELECT name, email, SPLIT_PART(email, '@', 2) AS email_domain FROM c",
    "tumbling_daily": """SELECT date_trunc('day', created_at) AS window_start,
        date_trunc('day', created_at) + INTERVAL '1' DAY AS window_end, COUNT(*) AS total_orders,
        CAST(SUM(amount) AS DECIMAL(20,2)) AS daily_revenue FROM o GROUP BY 1, 2""",
    # decoding
    "kafka_envelope_rows": "SELECT topic, 0 AS partition, \"offset\", value FROM env",
    "envelope_after": """SELECT topic, "offset", CASE WHEN kind = 'c' THEN 'c' ELSE 'd' END AS op, after FROM env""",
    "snapshot_as_changes": """SELECT 'customers' AS table_name, 'INSERT' AS mod_type, id, name, email, created_at,
        TIMESTAMP '2000-01-01 00:00:00' AS commit_ts, CAST(0 AS BIGINT) AS seq FROM c""",
    "snapshot_all_tables": f"""SELECT table_name, 'INSERT' AS mod_type, data,
        TIMESTAMP '2000-01-01 00:00:00' AS commit_ts, CAST(0 AS BIGINT) AS seq,
        'ecommerce.' || table_name AS target_table FROM ({SHOP_JSON})""",
    "mod_type_normalize": f"""SELECT id, seq, raw_type, mod_type, mod_type IS NULL AS rejected FROM (
        SELECT id, seq, raw_type, CASE WHEN raw_type IS NULL THEN 'INSERT'
          WHEN upper(raw_type) LIKE '%INSERT%' THEN 'INSERT'
          WHEN upper(raw_type) LIKE '%UPDATE%' OR upper(raw_type) LIKE '%REPLACE%' THEN 'UPDATE'
          WHEN upper(raw_type) LIKE '%DELETE%' THEN 'DELETE' END AS mod_type
        FROM (SELECT id, seq, CASE id % 9 WHEN 0 THEN 'INSERT' WHEN 1 THEN 'insert' WHEN 2 THEN 'REPLACE_ROW'
          WHEN 3 THEN 'row_delete' WHEN 4 THEN 'row_update' WHEN 5 THEN 'zzz' WHEN 6 THEN 'Delete'
          WHEN 7 THEN 'insert_or_update' END AS raw_type FROM chg))""",
    "change_records": f"""SELECT 'orders' AS table_name, mod_type, {ORDER_JSON} AS data, commit_ts, seq,
        'ecommerce.orders' AS target_table FROM chg""",
    "change_audit_images": f"""SELECT id, mod_type, seq, b_amount AS before_amount, b_status AS before_status,
        a_amount AS after_amount, a_status AS after_status FROM ({IMAGES})""",
    "change_audit_diff": f"""SELECT id, commit_ts, seq, concat_ws(',',
        CASE WHEN b_customer IS DISTINCT FROM a_customer THEN 'customer_id' END,
        CASE WHEN b_amount IS DISTINCT FROM a_amount THEN 'amount' END,
        CASE WHEN b_status IS DISTINCT FROM a_status THEN 'status' END) AS changed
        FROM ({IMAGES}) WHERE mod_type = 'UPDATE'""",
    "route_targets": f"""SELECT 'orders' AS table_name, mod_type, seq, {ORDER_JSON} AS data,
        'ecommerce.orders' AS target_table FROM chg
        UNION ALL SELECT 'customers', mod_type, seq, {CUSTOMER_JSON}, 'ecommerce.customers' FROM chg_c""",
    "route_counts": """SELECT 'ecommerce.customers' AS target_table, COUNT(*) AS records FROM c3
        UNION ALL SELECT 'ecommerce.products', COUNT(*) FROM p UNION ALL SELECT 'ecommerce.orders', COUNT(*) FROM o3
        UNION ALL SELECT 'analytics.orders', COUNT(*) FROM chg
        UNION ALL SELECT 'analytics.customers', COUNT(*) FROM chg_c""",
    "route_unknown": """SELECT CASE WHEN id % 10 = 3 THEN 'invoices' END AS table_name, id, seq, mod_type FROM chg
        WHERE id % 10 IN (3, 4)""",
    "typed_rows": """SELECT order_id, customer_id, product_id, quantity, total_amount, order_status,
        CASE WHEN order_id % 3 = 0 THEN created_at + INTERVAL '1' HOUR ELSE created_at END AS created_at,
        created_at + INTERVAL '1' HOUR AS updated_at
        FROM o3 WHERE order_id % 13 <> 0 AND order_id % 11 <> 0 AND order_id % 17 <> 0""",
    "default_timestamps": """SELECT order_id,
        CASE WHEN order_id % 3 <> 0 THEN created_at ELSE created_at + INTERVAL '1' HOUR END AS created_at,
        CASE WHEN order_id % 4 <> 0 THEN updated_at ELSE created_at + INTERVAL '1' HOUR END AS updated_at,
        created_at + INTERVAL '1' HOUR AS commit_ts FROM o3""",
    "missing_key_rejects": f"""SELECT order_id AS seq, CASE WHEN order_id % 17 = 0
        THEN 'missing order_id; bad total_amount' ELSE 'missing order_id' END AS reason, {FEED_JSON} AS data
        FROM o3 WHERE order_id % 13 <> 0 AND order_id % 11 = 0""",
    "corrupt_rows": """SELECT order_id AS seq, 'not json' AS reason,
        '{{"order_id":"' || CAST(order_id AS VARCHAR) AS data FROM o3 WHERE order_id % 13 = 0""".replace("{{", "{"),
    "bad_value_rejects": """SELECT order_id AS seq, CASE WHEN order_id % 11 = 0
        THEN 'missing order_id; bad total_amount' ELSE 'bad total_amount' END AS reason
        FROM o3 WHERE order_id % 13 <> 0 AND order_id % 17 = 0""",
    "schema_project": """SELECT order_id, customer_id, product_id, quantity, total_amount, order_status, created_at,
        CAST(NULL AS TIMESTAMP) AS updated_at FROM o3""",
    "primary_key_text": """SELECT 'customers' AS table_name, 'customer_id=' || CAST(customer_id AS VARCHAR) AS primary_key
        FROM c3 UNION ALL SELECT 'products', 'product_id=' || CAST(product_id AS VARCHAR) FROM p
        UNION ALL SELECT 'orders', 'order_id=' || CAST(order_id AS VARCHAR) FROM o3""",
    "insert_defaults": """SELECT id, customer_id,
        CASE WHEN id % 4 <> 0 THEN order_date ELSE DATE '2025-01-31' END AS order_date, amount,
        CASE WHEN id % 3 <> 0 THEN status ELSE 'pending' END AS status,
        CASE WHEN id % 5 <> 0 THEN created_at ELSE TIMESTAMP '2025-01-31 12:00:00' END AS created_at FROM o""",
    # applying changes
    "latest_per_key": """SELECT id, amount, status, mod_type, commit_ts FROM (SELECT *, row_number() OVER
        (PARTITION BY id ORDER BY commit_ts DESC, seq DESC) AS rn FROM chg) WHERE rn = 1""",
    "apply_changes_final": "SELECT * FROM o_final",
    "deleted_keys": """SELECT id, MAX(commit_ts) AS deleted_at FROM chg
        WHERE id IN (SELECT id FROM chg WHERE mod_type = 'DELETE') GROUP BY id""",
    "dedup_changes": "SELECT * FROM chg",
    "late_changes_final": "SELECT * FROM o_final",
    "snapshot_then_changes": "SELECT * FROM o_final",
    # lake tables and streams
    "cdc_customers_state": "SELECT * FROM c_final",
    "cdc_orders_state": "SELECT * FROM o_final",
    "upsert_orders_final": "SELECT * FROM o_final",
    "append_sink_rows": "SELECT after FROM env WHERE kind = 'c'",
    "lake_scan_latest": "SELECT * FROM o_final",
    "lake_scan_glob": "SELECT * FROM o_updated",
    "lake_readback_orders": "SELECT * FROM o_final",
    "lake_as_of_version": "SELECT * FROM o_updated",
    "lake_snapshots": """SELECT CAST(v AS BIGINT) AS version, CAST(par AS BIGINT) AS parent, op AS operation,
        CAST(CASE WHEN v = 1 THEN (SELECT COUNT(*) FROM chg WHERE mod_type = 'INSERT') ELSE 0 END AS BIGINT) AS inserted,
        CAST(CASE WHEN v = 2 THEN (SELECT COUNT(*) FROM chg WHERE mod_type = 'UPDATE') ELSE 0 END AS BIGINT) AS updated,
        CAST(CASE WHEN v = 4 THEN (SELECT COUNT(*) FROM chg WHERE mod_type = 'DELETE') ELSE 0 END AS BIGINT) AS deleted
        FROM (VALUES (0, NULL, 'create'), (1, 0, 'merge'), (2, 1, 'merge'), (3, 2, 'compact'), (4, 3, 'merge'))
          AS t(v, par, op)""",
    "lake_snapshot_summary": """SELECT CAST(4 AS BIGINT) AS version, 'merge' AS operation,
        CAST(0 AS BIGINT) AS inserted, CAST(0 AS BIGINT) AS updated,
        COUNT(*) AS deleted FROM chg WHERE mod_type = 'DELETE'""",
    "lake_file_rows": """SELECT 'base' AS layer, COUNT(*) AS rows FROM o
        UNION ALL SELECT 'delta', COUNT(*) FROM o WHERE id % 5 = 0""",
    # exports
    "export_csv_roundtrip": "SELECT * FROM c",
    "export_json_roundtrip": "SELECT * FROM o",
    "export_parquet_roundtrip": "SELECT c.name, o.amount, o.status FROM c JOIN o ON c.id = o.customer_id",
    # models in full and kept current
    "all_models_counts": """SELECT 'stg_customers' AS model, 'staging' AS layer, COUNT(*) AS row_count FROM c
        UNION ALL SELECT 'stg_orders', 'staging', COUNT(*) FROM o
        UNION ALL SELECT 'int_customer_orders', 'intermediate', COUNT(*) FROM co
        UNION ALL SELECT 'fct_customer_order_summary', 'marts', COUNT(*) FROM summary
        UNION ALL SELECT 'fct_high_value_orders', 'marts', COUNT(*) FROM co WHERE amount >= 400000
        UNION ALL SELECT 'fct_order_status_dashboard', 'marts', COUNT(*) FROM dashboard
        UNION ALL SELECT 'fct_daily_order_metrics', 'marts', COUNT(*) FROM daily
        UNION ALL SELECT 'dim_customer_spending_tier', 'marts', COUNT(*) FROM tiers
        UNION ALL SELECT 'recent_orders', 'marts', COUNT(*) FROM co""",
    "kept_fct_customer_order_summary": "SELECT * FROM summary",
    "kept_dim_customer_spending_tier": "SELECT * FROM tiers",
    "kept_fct_order_status_dashboard": "SELECT * FROM dashboard",
    "kept_fct_daily_order_metrics": "SELECT * FROM daily",
    "kept_fct_high_value_orders": "SELECT * FROM co WHERE amount >= 400000",
    "kept_recent_orders": """SELECT * FROM (SELECT customer_id, customer_name, order_id, amount, status,
        order_created_at AS created_at, row_number() OVER (PARTITION BY customer_id
        ORDER BY order_created_at DESC, order_id DESC) AS rank FROM co) WHERE rank <= 10""",
    "full_vs_incremental_diff": """SELECT 'fct_customer_order_summary' AS view, COUNT(*) AS rows,
        CAST(0 AS BIGINT) AS mismatches FROM summary
        UNION ALL SELECT 'dim_customer_spending_tier', COUNT(*), 0 FROM tiers
        UNION ALL SELECT 'fct_order_status_dashboard', COUNT(*), 0 FROM dashboard
        UNION ALL SELECT 'fct_daily_order_metrics', COUNT(*), 0 FROM daily
        UNION ALL SELECT 'fct_high_value_orders', COUNT(*), 0 FROM co WHERE amount >= 400000
        UNION ALL SELECT 'recent_orders', CAST(SUM(least(n, 10)) AS BIGINT), 0 FROM
          (SELECT COUNT(*) AS n FROM co GROUP BY customer_id)""",
    # quality
    "dq_unique": "SELECT id AS value, COUNT(*) AS n FROM o_bad GROUP BY id HAVING COUNT(*) > 1",
    "dq_not_null": """SELECT 'id' AS column_name, COUNT(*) FILTER (WHERE id IS NULL) AS n_failed FROM o_bad
        UNION ALL SELECT 'customer_id', COUNT(*) FILTER (WHERE customer_id IS NULL) FROM o_bad
        UNION ALL SELECT 'amount', COUNT(*) FILTER (WHERE amount IS NULL) FROM o_bad
        UNION ALL SELECT 'status', COUNT(*) FILTER (WHERE status IS NULL) FROM o_bad""",
    "dq_relationships": """SELECT b.id, b.customer_id FROM o_bad b LEFT JOIN c ON b.customer_id = c.id
        WHERE c.id IS NULL AND b.customer_id IS NOT NULL""",
    "dq_expression": """SELECT id, amount, status FROM o_bad
        WHERE NOT coalesce(amount >= 5000 AND status <> 'shipped', false)""",
    "dq_summary": """SELECT 'unique_customers_cdc_id' AS rule,
          (SELECT COUNT(*) FROM (SELECT id FROM c GROUP BY id HAVING COUNT(*) > 1)) AS n_failed
        UNION ALL SELECT 'not_null_customers_cdc_id', COUNT(*) FROM c WHERE id IS NULL
        UNION ALL SELECT 'not_null_customers_cdc_name', COUNT(*) FROM c WHERE name IS NULL
        UNION ALL SELECT 'unique_customers_cdc_email',
          (SELECT COUNT(*) FROM (SELECT email FROM c GROUP BY email HAVING COUNT(*) > 1))
        UNION ALL SELECT 'not_null_customers_cdc_email', COUNT(*) FROM c WHERE email IS NULL
        UNION ALL SELECT 'unique_orders_cdc_id',
          (SELECT COUNT(*) FROM (SELECT id FROM o_bad GROUP BY id HAVING COUNT(*) > 1))
        UNION ALL SELECT 'not_null_orders_cdc_id', COUNT(*) FROM o_bad WHERE id IS NULL
        UNION ALL SELECT 'not_null_orders_cdc_customer_id', COUNT(*) FROM o_bad WHERE customer_id IS NULL
        UNION ALL SELECT 'relationships_orders_cdc_customer_id', COUNT(*) FROM o_bad
          WHERE customer_id NOT IN (SELECT id FROM c)
        UNION ALL SELECT 'not_null_orders_cdc_amount', COUNT(*) FROM o_bad WHERE amount IS NULL
        UNION ALL SELECT 'not_null_orders_cdc_status', COUNT(*) FROM o_bad WHERE status IS NULL
        UNION ALL SELECT 'unique_fct_customer_order_summary_customer_id', 0
        UNION ALL SELECT 'not_null_fct_customer_order_summary_customer_id', COUNT(*) FROM summary
          WHERE customer_id IS NULL
        UNION ALL SELECT 'not_null_fct_customer_order_summary_total_spent', COUNT(*) FROM summary
          WHERE total_spent IS NULL
        UNION ALL SELECT 'expression_fct_high_value_orders', COUNT(*) FROM co WHERE amount >= 400000 AND amount < 100
        UNION ALL SELECT 'not_null_dim_customer_spending_tier_customer_tier', COUNT(*) FROM tiers
          WHERE customer_tier IS NULL
        UNION ALL SELECT 'not_null_fct_daily_order_metrics_metric_date', COUNT(*) FROM daily WHERE metric_date IS NULL
        UNION ALL SELECT 'not_null_fct_daily_order_metrics_daily_revenue', COUNT(*) FROM daily
          WHERE daily_revenue IS NULL""",
    "reconcile_counts": """SELECT 'source' AS stage, COUNT(*) AS rows FROM o
        UNION ALL SELECT 'cdc', COUNT(*) FROM o_final UNION ALL SELECT 'sink', COUNT(*) FROM o_final""",
    "random_customers": "SELECT * FROM c ORDER BY md5('7:' || CAST(id AS VARCHAR)), id LIMIT 2",
    "retained_orders_state": """SELECT id, customer_id, order_date, amount, status, created_at FROM o_final WHERE id % 7 <> 0
        UNION ALL SELECT id, customer_id, order_date, amount, 'late', created_at FROM o WHERE id % 7 = 0 AND id % 5 <> 0""",
    "retained_tombstones": """SELECT id, commit_ts AS deleted_at FROM chg WHERE mod_type = 'DELETE'
        AND commit_ts >= (SELECT max(commit_ts) FROM chg) - INTERVAL 300 DAY""",
    "retention_rejects": """SELECT 'orders' AS table_name, 'older than the deletes that are kept' AS reason, id,
        created_at + INTERVAL 36 HOUR AS commit_ts, CAST(9 AS BIGINT) AS seq FROM o
        WHERE id % 35 = 0 AND created_at + INTERVAL 2 DAY < (SELECT max(commit_ts) FROM chg) - INTERVAL 300 DAY""",
    "stream_dedup": "SELECT id, seq, mod_type, commit_ts FROM chg",
    "envelope_state": """SELECT id, customer_id, order_date, amount,
        CASE WHEN id % 6 = 0 THEN 'returned' ELSE status END AS status, created_at FROM o_final""",
    "envelope_rejects": f"""SELECT 'orders' AS table_name, 'unknown mod type; not json' AS reason, '{{"op":"c","after":' AS data,
        created_at AS commit_ts, id + 10000000 AS seq FROM o WHERE id % 17 = 0
        UNION ALL SELECT 'orders', 'unknown mod type', '{{"id":' || id || ',"customer_id":' || customer_id || ',"order_date":"'
          || order_date || '","amount":"' || amount || '","status":"' || status || '","created_at":"'
          || strftime(created_at, '%Y-%m-%d %H:%M:%S') || '"}}', created_at, id + 20000000 FROM o WHERE id % 19 = 0
        UNION ALL SELECT 'orders', 'unknown mod type; not json', NULL, created_at, id + 30000000 FROM o WHERE id % 23 = 0""",
    "kept_dq_summary": """SELECT 'unique_customers_cdc_id' AS rule, CAST(0 AS BIGINT) AS n_failed
        UNION ALL SELECT 'not_null_customers_cdc_id', 0 UNION ALL SELECT 'not_null_customers_cdc_name', 0
        UNION ALL SELECT 'unique_customers_cdc_email',
          (SELECT COUNT(*) FROM (SELECT email FROM c_final GROUP BY email HAVING COUNT(*) > 1))
        UNION ALL SELECT 'not_null_customers_cdc_email', 0 UNION ALL SELECT 'unique_orders_cdc_id', 0
        UNION ALL SELECT 'not_null_orders_cdc_id', 0 UNION ALL SELECT 'not_null_orders_cdc_customer_id', 0
        UNION ALL SELECT 'relationships_orders_cdc_customer_id', COUNT(*) FROM o_final WHERE customer_id NOT IN (SELECT id FROM c_final)
        UNION ALL SELECT 'not_null_orders_cdc_amount', 0 UNION ALL SELECT 'not_null_orders_cdc_status', 0""",
    "kept_dq_failures": """SELECT 'relationships_orders_cdc_customer_id' AS rule, CAST(customer_id AS VARCHAR) AS value, COUNT(*) AS n
        FROM o_final WHERE customer_id NOT IN (SELECT id FROM c_final) GROUP BY customer_id""",
    "reconcile_diff": """SELECT id, CASE WHEN id % 5 = 0 THEN 'only_left' ELSE 'changed' END AS finding FROM o
        WHERE id % 5 = 0 OR id % 3 = 0""",
    "pipeline_latency": """SELECT mod_type, COUNT(*) AS n, CAST(SUM(ms) AS DOUBLE) / COUNT(*) AS avg_ms,
        quantile_disc(ms, 0.5) AS p50_ms, quantile_disc(ms, 0.95) AS p95_ms, quantile_disc(ms, 0.99) AS p99_ms,
        MAX(ms) AS max_ms FROM (SELECT mod_type, CAST((id % 100) * 50 AS BIGINT) AS ms FROM chg) GROUP BY mod_type""",
}

#: Queries whose models stand over the tables after all changes.
OVER_FINAL = {
    "kept_fct_customer_order_summary",
    "kept_dim_customer_spending_tier",
    "kept_fct_order_status_dashboard",
    "kept_fct_daily_order_metrics",
    "kept_fct_high_value_orders",
    "kept_recent_orders",
    "full_vs_incremental_diff",
    "marts_backfilled",
}
BODIES["marts_backfilled"] = BODIES["full_vs_incremental_diff"]
BODIES["reconcile_buckets"] = BODIES["reconcile_diff"]


def oracle(name: str) -> str:
    c, o = ("c_final", "o_final") if name in OVER_FINAL else ("c", "o")
    return INPUTS + MODEL_VIEWS.format(c=c, o=o) + BODIES[name]

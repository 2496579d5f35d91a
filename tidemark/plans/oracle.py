"""The registered queries as SQL over the supplied tables, for checking."""

from __future__ import annotations

import re

from tidemark.plans.queries import INGEST_KEY, NAMESPACE

STAMP = "'%Y-%m-%d %H:%M:%S.%f'"


def _history(name: str, feed: str) -> str:
    return f"""
        SELECT md5({name}_id::VARCHAR || '|' || strftime(moment, {STAMP})) AS {name}_sk, {name}_id,
               moment AS valid_from, lead(moment) OVER (PARTITION BY {name}_id ORDER BY moment) AS valid_to
        FROM ({feed})"""


def _first_of_period(table: str, key: str, moment: str, unit: str, name: str) -> str:
    return f"SELECT {key} AS {name}_id, min({moment}) AS moment FROM {table} GROUP BY {key}, date_trunc('{unit}', {moment})"


def _pit(fact: str, name: str, moment: str, until: str | None = None, key: str | None = None) -> str:
    return (
        f"LEFT JOIN {name}_history ON {fact}.{key or name + '_id'} = {name}_history.{name}_id "
        f"AND {fact}.{moment} >= {name}_history.valid_from "
        f"AND {fact}.{until or moment} < coalesce({name}_history.valid_to, TIMESTAMP '9999-12-31') "
    )


CTES: dict[str, str] = {
    "raw_lines": """
        SELECT l_orderkey * 10 + l_linenumber AS transaction_line_id,
               l_orderkey * 2 + CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS transaction_id,
               l_linenumber AS line_number, l_partkey AS product_id, l_suppkey AS supplier_id,
               l_quantity::INTEGER AS quantity, l_extendedprice::DECIMAL(18,4) AS gross, l_shipdate AS moment
        FROM lineitem""",
    "lines": """
        SELECT * FROM raw_lines QUALIFY row_number() OVER (
            PARTITION BY transaction_line_id ORDER BY moment DESC, product_id DESC, supplier_id DESC) = 1""",
    "headers": """
        SELECT o_orderkey * 2 + kind AS transaction_id, md5((o_orderkey * 2 + kind)::VARCHAR) AS transaction_uuid,
               left(o_orderpriority, 1)::INTEGER AS channel_id, o_custkey AS customer_id,
               (o_totalprice::DECIMAL(18,4) * 0.08::DECIMAL(4,2))::DECIMAL(18,4) AS tax,
               CASE kind WHEN 0 THEN 'Purchase' ELSE 'Return' END AS transaction_type,
               CASE kind WHEN 1 THEN o_orderkey * 2 END AS original_transaction_id, o_orderdate AS moment
        FROM orders, (VALUES (0), (1)) AS kinds(kind)""",
    "raw_discounts": """
        SELECT (l_orderkey * 10 + l_linenumber) * 2 AS transaction_discount_id, l_suppkey AS promotion_id,
               l_orderkey * 10 + l_linenumber AS transaction_line_id, NULL::BIGINT AS transaction_id,
               l_quantity::INTEGER AS discounted_units,
               (l_extendedprice::DECIMAL(18,4) * l_discount::DECIMAL(6,2))::DECIMAL(18,4) AS discount_amount,
               l_shipdate AS moment
        FROM lineitem WHERE l_discount > 0
        UNION ALL
        SELECT o_orderkey * 2 + 1, o_custkey % 10, NULL, o_orderkey * 2, NULL,
               (o_totalprice::DECIMAL(18,4) * 0.05::DECIMAL(4,2))::DECIMAL(18,4), o_orderdate
        FROM orders WHERE o_orderpriority = '1-URGENT'""",
    "discounts": """
        SELECT * FROM raw_discounts QUALIFY row_number() OVER (
            PARTITION BY transaction_discount_id ORDER BY moment DESC, promotion_id DESC, discount_amount DESC) = 1""",
    "payments": """
        SELECT o_orderkey * 10 + n AS transaction_payment_id, o_orderkey * 2 AS transaction_id,
               n::INTEGER AS payment_type_id, (o_totalprice / (o_orderkey % 3 + 1))::DECIMAL(18,4) AS amount_paid,
               o_orderdate AS moment
        FROM orders, LATERAL (SELECT unnest(range(1, o_orderkey % 3 + 2)) AS n)""",
    "customer_feed": """
        SELECT o_custkey AS customer_id, o_orderpriority AS status, o_orderdate AS moment FROM orders
        QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderdate ORDER BY o_orderkey DESC) = 1""",
    "customer_history": _history("customer", "SELECT * FROM customer_feed"),
    "product_history": _history("product", _first_of_period("lineitem", "l_partkey", "l_shipdate", "year", "product")),
    "supplier_history": _history(
        "supplier", _first_of_period("lineitem", "l_suppkey", "l_shipdate", "year", "supplier")),
    "promotion_history": _history(
        "promotion", _first_of_period("lineitem", "l_suppkey", "l_shipdate", "quarter", "promotion")),
    "channel_history": _history(
        "channel",
        "SELECT left(priority, 1)::INTEGER AS channel_id, moment FROM (SELECT o_orderpriority AS priority, "
        "min(o_orderdate) AS moment FROM orders GROUP BY o_orderpriority, date_trunc('year', o_orderdate))"),
    "payment_type_history": _history(
        "payment_type", "SELECT payment_type_id, min(moment) AS moment FROM payments GROUP BY payment_type_id, year(moment)"),
    "bridge": """
        SELECT l_suppkey AS supplier_id, l_partkey AS product_id, min(l_shipdate) AS added_at,
               max(l_shipdate) AS modified_at,
               CASE WHEN sum(l_linenumber) % 3 = 0 THEN max(l_shipdate) END AS date_removed,
               CASE WHEN sum(l_linenumber) % 5 = 0 THEN max(l_shipdate) END AS date_deleted
        FROM lineitem GROUP BY l_partkey, l_suppkey""",
    "staged_bridge": """
        SELECT supplier_id, product_id, added_at, modified_at, coalesce(date_deleted, date_removed) AS removed_at,
               CASE WHEN date_deleted IS NOT NULL THEN 'deleted'
                    WHEN date_removed IS NOT NULL THEN 'removed' END AS removal_reason
        FROM bridge""",
    "days": """
        SELECT unnest(range((SELECT min(o_orderdate) FROM orders), (SELECT max(l_shipdate) FROM lineitem)
                            + INTERVAL 1 DAY, INTERVAL 1 DAY))::DATE AS d""",
    "dates": """
        SELECT d, strftime(d, '%Y%m%d')::INTEGER AS date_key, isodow(d) - 1 AS dow,
               CASE strftime(d, '%m-%d') WHEN '12-25' THEN 'Christmas Day' WHEN '01-01' THEN 'New Year''s Day' END
                   AS holiday
        FROM days""",
    "line_off": """
        SELECT transaction_line_id, sum(discount_amount) AS off FROM discounts
        WHERE transaction_line_id IS NOT NULL GROUP BY ALL""",
    "order_off": """
        SELECT transaction_id, sum(discount_amount)::DECIMAL(18,4) AS off FROM discounts
        WHERE transaction_id IS NOT NULL GROUP BY ALL""",
    "netted": """
        SELECT lines.*, coalesce(off, 0)::DECIMAL(18,4) AS line_discount,
               (gross - coalesce(off, 0))::DECIMAL(18,4) AS net
        FROM lines LEFT JOIN line_off USING (transaction_line_id)""",
    "subtotals": "SELECT transaction_id, sum(net)::DECIMAL(18,4) AS subtotal FROM netted GROUP BY ALL",
    "shared": """
        SELECT n.*, transaction_uuid, transaction_type, original_transaction_id, customer_id, channel_id,
               coalesce((n.net::DOUBLE / nullif(subtotal, 0)::DOUBLE * coalesce(o.off::DOUBLE, 0))::DECIMAL(18,4), 0)
                   ::DECIMAL(18,4) AS pro_discount,
               coalesce((n.net::DOUBLE / nullif(subtotal, 0)::DOUBLE * coalesce(tax::DOUBLE, 0))::DECIMAL(18,4), 0)
                   ::DECIMAL(18,4) AS pro_tax
        FROM netted n LEFT JOIN subtotals USING (transaction_id) LEFT JOIN order_off o USING (transaction_id)
        LEFT JOIN headers USING (transaction_id)""",
    "prorated": """
        SELECT transaction_line_id, transaction_id, line_number, transaction_uuid, transaction_type,
               original_transaction_id, customer_id, channel_id, product_id, quantity, gross AS gross_line_total,
               line_discount AS line_discount_amount, pro_discount AS prorated_discount_amount,
               line_discount + pro_discount AS total_discount_amount, net - pro_discount AS pretax_net_amount,
               pro_tax AS prorated_tax_amount, net - pro_discount + pro_tax AS net_amount, moment
        FROM shared""",
    "totals": """
        SELECT transaction_id, min(transaction_uuid) AS transaction_uuid, min(transaction_type) AS transaction_type,
               min(original_transaction_id) AS original_transaction_id, min(customer_id) AS customer_id,
               min(channel_id) AS channel_id, min(moment) AS line_created_at, max(moment) AS modified_at,
               sum(sign * gross_line_total) AS gross, sum(sign * total_discount_amount) AS off,
               sum(sign * prorated_tax_amount) AS tax, sum(sign * net_amount) AS net
        FROM (SELECT *, 1 AS sign FROM prorated WHERE transaction_type = 'Purchase'
              UNION ALL SELECT *, -1 FROM prorated WHERE transaction_type = 'Return')
        GROUP BY transaction_id""",
    "discount_lines": "SELECT * FROM lines WHERE transaction_line_id IN (SELECT transaction_line_id FROM discounts)",
    "discount_headers": """
        SELECT * FROM headers WHERE transaction_id IN (SELECT transaction_id FROM discounts)
        OR transaction_id IN (SELECT transaction_id FROM discount_lines)""",
    "discount_keys": """
        SELECT d.*, l.product_id, coalesce(a.customer_id, b.customer_id) AS customer_id,
               CASE WHEN d.transaction_id IS NOT NULL THEN 'Order'
                    WHEN d.transaction_line_id IS NOT NULL THEN 'Line Item' END AS discount_level
        FROM discounts d LEFT JOIN discount_lines l ON d.transaction_line_id = l.transaction_line_id
        LEFT JOIN discount_headers a ON l.transaction_id = a.transaction_id
        LEFT JOIN discount_headers b ON d.transaction_id = b.transaction_id""",
    "members": "SELECT regexp_extract(p_brand, '(\\d+)', 1)::INTEGER AS category_id, p_partkey AS product_id FROM part",
    "eligible": """
        SELECT product_id, category_id + 100 AS promotion_group_id FROM members WHERE category_id % 2 = 0
        UNION
        SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN regexp_extract(p_brand, '(\\d+)', 1)::INTEGER
                               ELSE p_size END + 100
        FROM part WHERE p_size > 25""",
    "words": """
        SELECT p_partkey, CASE word WHEN 'hot' THEN 'warm' ELSE word END AS word
        FROM (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS word FROM part)""",
    "word_ids": "SELECT word, row_number() OVER (ORDER BY word) AS word_id FROM (SELECT DISTINCT word FROM words)",
}


def _with(select: str, ctes: dict[str, str] = CTES) -> str:
    """Prefix a select with the expressions it names, directly or not."""
    if select.lstrip().startswith("WITH"):
        return select
    needed: list[str] = []

    def visit(text: str) -> None:
        for name, body in ctes.items():
            if name not in needed and re.search(rf"\b{name}\b", text):
                visit(body)
                if name not in needed:
                    needed.append(name)

    visit(select)
    if not needed:
        return select
    return "WITH " + ", ".join(f"{n} AS ({ctes[n]})" for n in needed) + " " + select


def _money(*names: str) -> str:
    return ", ".join(f"{n}::DOUBLE AS {n}" for n in names)


_MEASURES = _money(
    "gross_line_total", "line_discount_amount", "prorated_discount_amount", "total_discount_amount",
    "pretax_net_amount", "prorated_tax_amount", "net_amount")


def _sk(*names: str) -> str:
    return ", ".join(f"coalesce({n}_sk, '-1') AS {n}_sk" for n in names)


def _date_key(out: str) -> str:
    return f"coalesce(date_key::VARCHAR, '-1') AS {out}"


def _line_fact(kind: str, columns: str) -> str:
    return (
        f"SELECT {columns} FROM (SELECT * FROM prorated WHERE transaction_type = '{kind}') p "
        + _pit("p", "product", "moment") + _pit("p", "customer", "moment") + _pit("p", "channel", "moment")
        + "LEFT JOIN dates ON p.moment::DATE = dates.d"
    )


def _window(start: str, end: str) -> str:
    return (
        "SELECT l_orderkey, l_linenumber, l_extendedprice, l_shipdate FROM lineitem "
        f"WHERE l_shipdate >= '{start}' AND l_shipdate < '{end}'"
    )


def _bridge(until: str) -> str:
    return (
        "SELECT md5(coalesce(product_sk, '_null_') || '-' || coalesce(supplier_sk, '_null_')) AS product_supplier_sk,"
        " product_sk, supplier_sk, added_at AS relationship_started_at, modified_at AS relationship_modified_at,"
        " removed_at AS relationship_ended_at, removal_reason AS relationship_end_reason FROM staged_bridge b "
        + _pit("b", "product", "added_at", until) + _pit("b", "supplier", "added_at", until)
    )


_RETURNS = (
    "SELECT transaction_line_id, transaction_id, product_id, net_amount::DOUBLE AS net_amount,"
    " moment AS line_created_at, moment AS modified_at FROM prorated WHERE transaction_type = 'Return'"
)
_HISTORY = """SELECT customer_sk AS scd_id, customer_history.customer_id, status, valid_from, valid_to
    FROM customer_history JOIN customer_feed
    ON customer_history.customer_id = customer_feed.customer_id AND valid_from = moment"""
_LATEST_EVENT = """SELECT event_id, user_id, event_type, value, ts FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1"""
_EVENTS = "SELECT event_id, user_id, ts FROM events"
_LATEST = """SELECT transaction_line_id, transaction_id, product_id, supplier_id, gross::DOUBLE AS gross_line_total,
    moment AS date_modified FROM lines"""


def _uuid() -> str:
    digest = f"sha1(unhex('{NAMESPACE.hex}') || encode(c_name))"
    return f"""SELECT c_custkey, h[1:8] || '-' || h[9:12] || '-5' || h[14:16] || '-'
        || ('89ab')[1 + (('0x' || h[17])::INTEGER % 4)] || h[18:20] || '-' || h[21:32] AS customer_uuid
        FROM (SELECT c_custkey, {digest} AS h FROM customer)"""


def _bounds() -> str:
    parts = []
    for grain, unit, step in (("hourly", "hour", "1 HOUR"), ("daily", "day", "1 DAY"),
                              ("weekly", "week", "7 DAY"), ("monthly", "month", "1 MONTH")):
        start = f"date_trunc('{unit}', ts)"
        parts.append(
            f"SELECT '{grain}' AS grain, {start}::TIMESTAMP AS start_at, ({start} + INTERVAL {step})::TIMESTAMP"
            " AS end_at, count(*) AS n_rows FROM events GROUP BY ALL")
    return " UNION ALL ".join(parts)


_DATE_DIM = """SELECT date_key, d AS full_date, year(d)::INTEGER AS year_number, month(d)::INTEGER AS month_number,
    day(d)::INTEGER AS day_of_month, dow::INTEGER AS day_of_week_number, dayname(d) AS day_of_week_name,
    left(dayname(d), 3) AS day_of_week_short_name, dayofyear(d)::INTEGER AS day_of_year,
    weekofyear(d)::INTEGER AS iso_week_number, isoyear(d)::INTEGER AS iso_year,
    ((dayofyear(d) - 1) // 7 + 1)::INTEGER AS us_week_of_year, monthname(d) AS month_name,
    left(monthname(d), 3) AS month_short_name, strftime(d, '%Y%m')::INTEGER AS year_month_number,
    year(d)::VARCHAR || '-' || monthname(d) AS year_month_name,
    date_trunc('month', d)::DATE AS first_day_of_month, last_day(d) AS last_day_of_month,
    day(last_day(d))::INTEGER AS days_in_month, quarter(d)::INTEGER AS quarter_number,
    'Q' || quarter(d)::VARCHAR AS quarter_name,
    (year(d)::VARCHAR || quarter(d)::VARCHAR)::INTEGER AS year_quarter_number,
    year(d)::VARCHAR || '-Q' || quarter(d)::VARCHAR AS year_quarter_name,
    date_trunc('quarter', d)::DATE AS first_day_of_quarter,
    (date_trunc('quarter', d) + INTERVAL 3 MONTH - INTERVAL 1 DAY)::DATE AS last_day_of_quarter,
    make_date(year(d), 1, 1) AS first_day_of_year, make_date(year(d), 12, 31) AS last_day_of_year,
    (year(d) % 4 = 0 AND (year(d) % 100 <> 0 OR year(d) % 400 = 0)) AS is_leap_year,
    dow < 5 AS is_weekday, dow >= 5 AS is_weekend, holiday IS NOT NULL AS is_holiday, holiday AS holiday_name,
    dow < 5 AND holiday IS NULL AS is_workday,
    CASE WHEN day(d) BETWEEN 11 AND 13 THEN 'th' WHEN day(d) % 10 = 1 THEN 'st' WHEN day(d) % 10 = 2 THEN 'nd'
         WHEN day(d) % 10 = 3 THEN 'rd' ELSE 'th' END AS day_suffix,
    (d + (5 - dow)::INTEGER)::DATE AS week_ending_date_saturday,
    (d + (6 - dow)::INTEGER)::DATE AS week_ending_date_sunday,
    (year(d) + CASE WHEN month(d) >= 10 THEN 1 ELSE 0 END)::INTEGER AS fiscal_year_number,
    ((month(d) + 2) % 12 // 3 + 1)::INTEGER AS fiscal_quarter_number,
    ((month(d) + 2) % 12)::INTEGER AS fiscal_month_offset FROM dates"""

_PRICE = "(product_id % 97 + 3)::DECIMAL(18,4)"
_VALUE = "(line_number * 9)::DECIMAL(18,4)"

SELECTS: dict[str, str] = {
    "window_extract_day": _window("1997-03-05", "1997-03-06"),
    "window_extract_week": _window("1997-03-03", "1997-03-10"),
    "window_extract_month": _window("1997-03-01", "1997-04-01"),
    "window_extract_hour": _EVENTS.replace("event_id, user_id, ts", "event_id, ts, user_id")
    + " WHERE ts >= '2024-01-10 05:00:00' AND ts < '2024-01-10 06:00:00'",
    "partition_bounds": _bounds(),
    "lake_layout_counts": """
        SELECT 'daily' AS layout, year(l_shipdate)::INTEGER AS year, month(l_shipdate)::INTEGER AS month,
               day(l_shipdate)::INTEGER AS day, NULL::INTEGER AS week, count(*) AS n_rows FROM lineitem GROUP BY ALL
        UNION ALL
        SELECT 'weekly', isoyear(l_shipdate)::INTEGER, NULL, NULL, weekofyear(l_shipdate)::INTEGER, count(*)
        FROM lineitem GROUP BY ALL""",
    "ingest_run": """SELECT o_orderkey, o_custkey, o_orderdate FROM orders
        WHERE o_orderdate >= '1996-02-01' AND o_orderdate < '1996-04-01'""",
    "ingest_backfill": """SELECT year(l_shipdate)::INTEGER AS year, month(l_shipdate)::INTEGER AS month,
        count(*) AS n_rows, sum(l_extendedprice::DECIMAL(18,4))::DOUBLE AS amount FROM lineitem GROUP BY ALL""",
    "conform_schema": """
        SELECT l_orderkey, l_linenumber, (cents // 10 + CASE WHEN cents % 10 >= 5 THEN 1 ELSE 0 END) / 10.0::DOUBLE
                   AS half_up,
               (cents // 10 + CASE WHEN cents % 10 > 5 OR (cents % 10 = 5 AND cents // 10 % 2 = 1) THEN 1 ELSE 0 END)
                   / 10.0::DOUBLE AS half_even
        FROM (SELECT l_orderkey, l_linenumber, round(l_extendedprice * 100)::BIGINT AS cents FROM lineitem)""",
    "csv_scan": "SELECT p_partkey, p_name, p_size FROM part",
    "json_scan": "SELECT s_suppkey, s_nationkey FROM supplier",
    "topk_parts": "SELECT p_partkey, p_retailprice FROM part ORDER BY p_retailprice DESC, p_partkey LIMIT 500",
    "sample_orders": """SELECT o_orderkey, o_custkey FROM orders WHERE o_orderdate < '2000-01-01 12:00:00'
        ORDER BY md5('7|' || o_orderkey::VARCHAR), o_orderkey LIMIT 1000""",
    "dense_id": """SELECT p_name, p_brand, row_number() OVER (ORDER BY p_name, p_brand) AS name_id
        FROM (SELECT DISTINCT p_name, p_brand FROM part)""",
    "continued_ids": """SELECT l_partkey, l_suppkey, (SELECT max(o_orderkey) FROM orders)
        + row_number() OVER (ORDER BY l_partkey, l_suppkey) AS pair_id
        FROM (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem)""",
    "surrogate_keys": """SELECT DISTINCT l_partkey, l_suppkey, md5(l_partkey::VARCHAR || '-'
        || CASE WHEN l_suppkey % 7 = 0 THEN '_null_' ELSE l_suppkey::VARCHAR END) AS pair_sk FROM lineitem""",
    "uuid_v5_keys": _uuid(),
    "latest_line": """SELECT transaction_line_id, transaction_id, product_id, supplier_id, quantity,
        gross::DOUBLE AS gross_line_total, moment AS date_modified FROM lines""",
    "latest_event_per_user": _LATEST_EVENT,
    "customer_history_scd2": _HISTORY,
    "customer_history_incremental": _HISTORY,
    "customer_current_scd1": f"SELECT customer_id, status, valid_from FROM ({_HISTORY}) WHERE valid_to IS NULL",
    "pit_customer_key": "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, o_custkey, "
    + _sk("customer")
    + " FROM (SELECT * FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey) f "
    + _pit("f", "customer", "l_shipdate", key="o_custkey"),
    "date_key_lookup": f"SELECT o_orderkey, {_date_key('order_date_key')} FROM orders "
    "LEFT JOIN dates ON o_orderdate::DATE = d AND holiday IS NULL",
    "removal_resolution": "SELECT supplier_id, product_id, added_at, modified_at, removed_at, removal_reason FROM staged_bridge",
    "soft_delete_filter": """SELECT product_id, supplier_id, added_at, date_removed IS NULL AS is_current_record,
        greatest(modified_at, coalesce(date_removed, TIMESTAMP '1970-01-01')) AS changed_at
        FROM bridge WHERE date_deleted IS NULL""",
    "bridge_part_supplier": _bridge("modified_at"),
    "bridge_part_supplier_by_start": _bridge("added_at"),
    "semi_join_reduction": """SELECT transaction_line_id, product_id, moment AS date_modified,
        gross::DOUBLE AS gross_line_total FROM raw_lines
        WHERE transaction_line_id IN (SELECT transaction_line_id FROM raw_discounts)""",
    "disjunctive_membership": "SELECT transaction_id, customer_id, transaction_type FROM discount_headers",
    "two_path_lookup": """SELECT transaction_discount_id, transaction_line_id, transaction_id, product_id, customer_id,
        discount_level FROM discount_keys""",
    "affected_key_expansion": """SELECT transaction_line_id, transaction_id, product_id, moment AS date_modified
        FROM raw_lines WHERE transaction_id IN (SELECT transaction_id FROM raw_lines
            WHERE moment::DATE >= DATE '1998-06-01' - 3 AND moment::DATE < '1998-06-08')""",
    "union_distinct_eligibility": "SELECT product_id, promotion_group_id FROM eligible",
    "first_group_of_product":
        "SELECT product_id, min(promotion_group_id) AS promotion_group_id FROM eligible GROUP BY product_id",
    "incremental_window": """SELECT transaction_line_id, product_id, moment AS date_modified FROM raw_lines
        WHERE moment::DATE >= DATE '1998-06-01' - 3 AND moment::DATE < '1998-06-15'""",
    "watermark_lookback": """SELECT transaction_line_id, product_id, moment AS date_modified FROM raw_lines
        WHERE moment::DATE >= (SELECT max(o_orderdate)::DATE - 3 FROM orders)""",
    "clean_window": _EVENTS + " WHERE ts >= TIMESTAMP '2024-01-10' - INTERVAL 1 DAY AND ts < '2024-01-12'",
    "upsert_result": _LATEST,
    "proration": f"""SELECT transaction_line_id, transaction_id, line_number, transaction_uuid, transaction_type,
        original_transaction_id, customer_id, channel_id, product_id, quantity, {_MEASURES}, moment AS line_created_at,
        moment AS modified_at FROM prorated""",
    "line_discount_totals": "SELECT transaction_line_id, off::DOUBLE AS line_discount_amount FROM line_off",
    "proration_balance": """SELECT transaction_id, sum(gross_line_total - line_discount_amount)::DOUBLE AS subtotal,
        sum(prorated_discount_amount)::DOUBLE AS allocated_discount,
        sum(prorated_tax_amount)::DOUBLE AS allocated_tax FROM prorated GROUP BY transaction_id""",
    "sales_fact": _line_fact(
        "Purchase",
        "transaction_line_id, transaction_id, line_number, transaction_uuid, " + _sk("customer", "channel", "product")
        + f", quantity, {_MEASURES}, {_date_key('sale_date_key')}, moment AS sale_event_ts, moment AS source_modified_at"),
    "returns_fact": _line_fact(
        "Return",
        "transaction_line_id, line_number, transaction_id, transaction_uuid, original_transaction_id, "
        + _sk("customer", "channel", "product")
        + f", quantity, {_MEASURES}, {_date_key('return_date_key')}, moment AS line_created_at, moment AS source_modified_at"),
    "transactions_fact": f"""SELECT transaction_id, transaction_uuid, transaction_type, original_transaction_id,
        {_sk('customer', 'channel')}, {_date_key('transaction_date_key')}, gross::DOUBLE AS gross_subtotal_amount,
        off::DOUBLE AS total_discount_amount, tax::DOUBLE AS total_tax_amount, net::DOUBLE AS net_amount,
        (net + tax)::DOUBLE AS total_amount, net::DOUBLE AS total_amount_tax_once, line_created_at, modified_at
        FROM totals t """ + _pit("t", "customer", "line_created_at") + _pit("t", "channel", "line_created_at")
    + "LEFT JOIN dates ON line_created_at::DATE = d",
    "union_signed": """SELECT customer_id, sum(gross)::DOUBLE AS gross, sum(net)::DOUBLE AS net,
        count(*) AS n_transactions FROM totals GROUP BY customer_id""",
    "payments_fact": """SELECT transaction_payment_id, payment_type_sk, transaction_id, p.payment_type_id,
        NULL::VARCHAR AS payment_provider_reference, amount_paid::DOUBLE AS amount_paid, moment AS payment_event_ts,
        moment AS source_updated_at FROM payments p """ + _pit("p", "payment_type", "moment"),
    "discounts_fact": f"""SELECT transaction_discount_id, {_sk('customer', 'product', 'promotion')},
        {_date_key('discount_date_key')}, transaction_id, transaction_line_id, discount_level, discounted_units,
        discount_amount::DOUBLE AS discount_amount, 1 AS discount_sequence, moment AS discount_event_ts,
        moment AS source_modified_at FROM discount_keys k """
    + _pit("k", "promotion", "moment") + _pit("k", "customer", "moment") + _pit("k", "product", "moment")
    + "LEFT JOIN dates ON moment::DATE = d",
    "discount_by_pool": f"""
        SELECT transaction_line_id, product_id, supplier_id, moment AS date_modified, (CASE supplier_id % 5
            WHEN 0 THEN ({_PRICE} - greatest({_VALUE}, 0)) * quantity
            WHEN 1 THEN ({_PRICE} * least({_VALUE} / 100, 1)) * quantity
            WHEN 2 THEN least({_PRICE}, {_VALUE}) * quantity
            WHEN 3 THEN ({_PRICE} * least({_VALUE} / 100, 1)) * (quantity // 2)
            ELSE 0 END)::DECIMAL(18,4)::DOUBLE AS discount_amount FROM raw_lines""",
    "order_tax_totals": """
        SELECT transaction_id, g::DOUBLE AS gross_subtotal, off::DOUBLE AS line_discounts,
               order_off::DOUBLE AS order_discount, n::DOUBLE AS net_total, tax::DOUBLE AS tax_amount,
               (n + tax)::DOUBLE AS total_amount
        FROM (SELECT *, (n * 0.12::DECIMAL(4,2))::DECIMAL(18,4) AS tax FROM (
            SELECT *, greatest(g - off - order_off, 0)::DECIMAL(18,4) AS n FROM (
                SELECT transaction_id, g, off, (CASE channel_id WHEN 1 THEN (customer_id % 120)::DECIMAL(18,4)
                    WHEN 2 THEN ((g - off) * least(customer_id % 120, 100)::DECIMAL(5,0) * 0.01::DECIMAL(4,2))
                        ::DECIMAL(18,4) ELSE 0 END)::DECIMAL(18,4) AS order_off
                FROM (SELECT transaction_id, sum(gross)::DECIMAL(18,4) AS g,
                             coalesce(sum(discount_amount), 0)::DECIMAL(18,4) AS off
                      FROM lines LEFT JOIN (SELECT transaction_line_id, discount_amount FROM discounts
                                            WHERE transaction_line_id IS NOT NULL) USING (transaction_line_id)
                      GROUP BY transaction_id)
                LEFT JOIN headers USING (transaction_id))))""",
    "payment_split": """SELECT o_orderkey, n::INTEGER AS payment_number,
        (o_totalprice / (o_orderkey % 3 + 1))::DECIMAL(18,4)::DOUBLE AS amount_paid
        FROM orders, LATERAL (SELECT unnest(range(1, o_orderkey % 3 + 2)) AS n)""",
    "safe_ratios": """SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate,
        l_tax / nullif(l_discount, 0) AS tax_per_discount FROM lineitem""",
    "date_dim": _DATE_DIM,
    "seasonality_factor": """WITH days AS (SELECT o_orderdate::DATE AS day, count(*) AS n_orders FROM orders GROUP BY o_orderdate::DATE),
        w AS (SELECT isodow(day) AS d, sum(n_orders)::DOUBLE / count(*) AS m FROM days GROUP BY 1),
        v AS (SELECT weekofyear(day) AS d, sum(n_orders)::DOUBLE / count(*) AS m FROM days GROUP BY 1),
        a AS (SELECT sum(n_orders)::DOUBLE / count(*) AS m FROM days)
        SELECT day, n_orders, round(w.m / a.m * (v.m / a.m), 6) AS factor
        FROM days JOIN w ON isodow(day) = w.d JOIN v ON weekofyear(day) = v.d, a""",
    "daily_growth": """WITH daily AS (
            SELECT o_custkey, o_orderdate::DATE AS day, sum(o_totalprice::DECIMAL(18,4)) AS s FROM orders GROUP BY ALL),
        seen AS (SELECT o_custkey, date_diff('day', min(day), max(day))::INTEGER AS days, arg_min(s, day)::DOUBLE AS f, sum(s)::DOUBLE AS a FROM daily GROUP BY o_custkey)
        SELECT o_custkey, days, CASE WHEN days > 0 THEN round(pow(a / f, 1.0::DOUBLE / days) - 1, 6) END AS growth FROM seen""",
    "normalise_list_dimension": f"""SELECT word_id, word, h[1:8] || '-' || h[9:12] || '-5' || h[14:16] || '-'
        || ('89ab')[1 + (('0x' || h[17])::INTEGER % 4)] || h[18:20] || '-' || h[21:32] AS word_uuid
        FROM (SELECT *, sha1(unhex('{NAMESPACE.hex}') || encode(word_id::VARCHAR)) AS h FROM word_ids)""",
    "normalise_list_bridge": "SELECT p_partkey, word_id FROM words JOIN word_ids USING (word)",
    "unique_values": "SELECT DISTINCT p_brand FROM part ORDER BY p_brand",
    "audit_not_null": """
        SELECT 'not_null' AS check_name, 'transaction_id' AS column_name, 0::BIGINT AS violations
        UNION ALL SELECT 'not_null', 'customer_id', count(*) FILTER (customer_id IS NULL) FROM headers
        UNION ALL SELECT 'not_null', 'original_transaction_id',
            count(*) FILTER (original_transaction_id IS NULL) FROM headers""",
    "audit_unique": """SELECT 'unique' AS check_name, 'transaction_line_id' AS column_name, count(*) AS violations
        FROM (SELECT transaction_line_id FROM raw_lines GROUP BY ALL HAVING count(*) > 1)""",
    "audit_relationships": """SELECT 'relationships' AS check_name, 'user_id' AS column_name, count(*) AS violations
        FROM events WHERE user_id NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)""",
    "audit_checks": """
        SELECT 'check' AS check_name, 'line_or_order' AS column_name,
               count(*) FILTER ((transaction_line_id IS NULL) = (transaction_id IS NULL)) AS violations
        FROM raw_discounts
        UNION ALL SELECT 'check', 'units_on_lines_only',
               count(*) FILTER ((transaction_line_id IS NULL) <> (discounted_units IS NULL)) FROM raw_discounts
        UNION ALL SELECT 'check', 'amount_at_least_100', count(*) FILTER (discount_amount < 100)
        FROM raw_discounts""",
    "wap_publish": _RETURNS,
    "revert_table": _RETURNS,
    "expired_partitions": "SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate >= '1999-07-01'",
    "stream_append": _EVENTS,
    "stream_upsert": _LATEST_EVENT,
    "stream_scd2": _HISTORY,
    "stream_dedupe": _EVENTS,
    "stream_enrich": "SELECT o_orderkey, o_custkey, o_orderdate, customer_sk FROM orders o "
    + _pit("o", "customer", "o_orderdate", key="o_custkey"),
}
SELECTS["audit_marts"] = f"""
    SELECT 'not_null' AS check_name, 'transaction_line_id' AS column_name,
           count(*) FILTER (transaction_line_id IS NULL) AS violations FROM ({SELECTS['sales_fact']})
    UNION ALL SELECT 'unique', 'transaction_line_id', count(*) - count(DISTINCT transaction_line_id)
        FROM ({SELECTS['sales_fact']})
    UNION ALL SELECT 'relationships', 'customer_sk', count(*) FILTER (customer_sk = '-1') FROM ({SELECTS['sales_fact']})
    UNION ALL SELECT 'relationships', 'product_sk', count(*) FILTER (product_sk = '-1') FROM ({SELECTS['sales_fact']})
    UNION ALL SELECT 'relationships', 'channel_sk', count(*) FILTER (channel_sk = '-1') FROM ({SELECTS['sales_fact']})"""


_CHANGED = {
    **CTES, "first_headers": CTES["headers"], "first_discounts": CTES["discounts"],
    "headers": """SELECT * REPLACE ((CASE WHEN transaction_id % 2 = 0 AND transaction_id // 2 % 11 = 0 THEN tax * 2 ELSE tax END)::DECIMAL(18,4) AS tax)
        FROM first_headers""",
    "discounts": """SELECT * REPLACE ((CASE WHEN transaction_discount_id % 13 = 0 THEN discount_amount + 1 ELSE discount_amount END)::DECIMAL(18,4)
        AS discount_amount) FROM first_discounts""",
}
SELECTS["incremental_facts"] = _with("""SELECT transaction_id, transaction_type, customer_id, gross::DOUBLE AS gross_subtotal_amount,
    off::DOUBLE AS total_discount_amount, tax::DOUBLE AS total_tax_amount, net::DOUBLE AS net_amount FROM totals""", _CHANGED)


def _ingested() -> str:
    """Rows of each source table in the month of the ingest run."""
    first = "SELECT {c}, min({m}) AS moment FROM {t} GROUP BY {c}, date_trunc('{u}', {m})".format
    line = lambda c, u: first(c=c, m="l_shipdate", t="lineitem", u=u)
    shipped = "SELECT l_shipdate AS moment FROM lineitem"
    feeds = {
        "authors": line("l_suppkey", "month"), "publishers": line("l_linenumber", "month"), "promotion_groups": line("l_partkey", "month"),
        "categories": line("l_quantity", "month"), "products": line("l_partkey", "year"), "suppliers": line("l_suppkey", "year"),
        "promotions": line("l_suppkey", "quarter"), "channels": first(c="o_orderpriority", m="o_orderdate", t="orders", u="year"),
        "payment_types": "SELECT min(moment) AS moment FROM payments GROUP BY payment_type_id, year(moment)",
        "customers": "SELECT o_orderdate AS moment FROM orders", "suppliers_products": "SELECT modified_at AS moment FROM bridge",
        **dict.fromkeys(("authors_products", "publishers_products", "promotion_groups_products", "categories_products"), shipped),
        "transaction_headers": "SELECT moment FROM headers", "transaction_lines": "SELECT moment FROM raw_lines",
        "transaction_discounts": "SELECT moment FROM raw_discounts", "transaction_payments": "SELECT moment FROM payments",
    }
    inside = f"moment >= TIMESTAMP '{INGEST_KEY}' AND moment < TIMESTAMP '{INGEST_KEY}' + INTERVAL 1 MONTH"
    return " UNION ALL ".join(
        f"SELECT '{n}' AS table_name, count(*) AS n_rows, max(moment) AS newest FROM ({feed}) WHERE {inside}" for n, feed in feeds.items())


SELECTS["ingest_all"] = _ingested()


def _source_checks() -> str:
    """The constraints of the event tables, one by one."""
    tables = {"transaction_headers": "headers", "transaction_lines": "lines", "transaction_discounts": "discounts", "transaction_payments": "payments"}
    # Columns that the stand-ins fill from `moment` or a total count as filled where those are.
    filled = {
        "transaction_headers": {"transaction_id": "", "transaction_uuid": "", "channel_id": "", "customer_id": "", "gross_subtotal_amount": "tax",
                                "total_tax_amount": "tax", "total_amount": "tax", "transaction_date": "moment"},
        "transaction_lines": {"transaction_line_id": "", "transaction_id": "", "line_number": "", "product_id": "", "quantity": "",
                              "unit_price": "gross", "gross_line_total": "gross", "transaction_date": "moment"},
        "transaction_discounts": {"transaction_discount_id": "", "promotion_id": "", "discount_amount": "", "date_applied": "moment"},
        "transaction_payments": {"transaction_payment_id": "", "transaction_id": "", "payment_type_id": "", "amount_paid": "", "payment_date": "moment"},
    }
    unique = [("transaction_headers", "transaction_id"), ("transaction_headers", "transaction_uuid"), ("transaction_lines", "transaction_line_id"),
              ("transaction_discounts", "transaction_discount_id"), ("transaction_payments", "transaction_payment_id")]
    links = [
        ("transaction_headers", "channel_id", "channel_history"), ("transaction_headers", "customer_id", "(SELECT c_custkey AS customer_id FROM customer)"),
        ("transaction_lines", "transaction_id", "headers"), ("transaction_lines", "product_id", "product_history"),
        ("transaction_discounts", "promotion_id", "promotion_history"), ("transaction_discounts", "transaction_line_id", "lines"),
        ("transaction_discounts", "transaction_id", "headers"), ("transaction_payments", "transaction_id", "headers"),
        ("transaction_payments", "payment_type_id", "payment_type_history"),
    ]
    broken = [
        ("transaction_headers", "transaction_type", "transaction_type NOT IN ('Purchase', 'Return')"),
        ("transaction_headers", "return_has_original", "transaction_type <> 'Purchase' AND original_transaction_id IS NULL"),
        ("transaction_lines", "gross_not_negative", "gross < 0"), ("transaction_payments", "amount_not_negative", "amount_paid < 0"),
        ("transaction_discounts", "line_or_order", "(transaction_line_id IS NULL) = (transaction_id IS NULL)"),
        ("transaction_discounts", "units_on_lines_only", "(transaction_line_id IS NULL) <> (discounted_units IS NULL)"),
    ]
    row = "SELECT '{t}' AS table_name, '{k}' AS check_name, '{c}' AS column_name, count(*) AS violations FROM {f}".format
    parts = [row(t=t, k="not_null", c=c, f=f"{tables[t]} WHERE {of or c} IS NULL") for t, columns in filled.items() for c, of in columns.items()]
    parts += [row(t=t, k="unique", c=c, f=f"(SELECT {c} FROM {tables[t]} WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1)") for t, c in unique]
    parts += [row(t=t, k="relationships", c=c, f=f"{tables[t]} c WHERE c.{c} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {p} p WHERE p.{c} = c.{c})")
              for t, c, p in links]
    parts += [row(t=t, k="check", c=c, f=f"{tables[t]} WHERE {where}") for t, c, where in broken]
    return " UNION ALL ".join(parts)


SELECTS["audit_source_tables"] = _source_checks()
SELECTS["reject_negative_lines"] = "SELECT transaction_id, sum(gross)::DOUBLE AS gross_subtotal FROM lines GROUP BY transaction_id"
SELECTS["stream_late_counts"] = """SELECT * FROM (SELECT date_trunc('day', ts)::TIMESTAMP AS window_start, event_type, count(*) AS rows
    FROM events WHERE ts IS NOT NULL GROUP BY 1, 2)
    WHERE window_start + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL 3 DAY"""
SELECTS["history_publish_after_delete"] = """
    SELECT customer_id, status, moment AS valid_from_ts, until AS valid_to_ts, until IS NULL AS is_current_record,
           customer_id % 11 <> 0 AS in_current
    FROM (SELECT *, lead(moment) OVER (PARTITION BY customer_id ORDER BY moment) AS until FROM (
        SELECT customer_id, status, moment, FALSE AS gone FROM customer_feed
        QUALIFY row_number() OVER (PARTITION BY customer_id, moment < TIMESTAMP '1998-01-01' ORDER BY moment DESC) = 1
        UNION ALL SELECT DISTINCT customer_id, NULL, TIMESTAMP '2035-01-01', TRUE FROM customer_feed WHERE customer_id % 11 = 0))
    WHERE NOT gone"""
# Other ways to the same rows.
SELECTS["pit_customer_key_merge"] = SELECTS["pit_customer_key"]


def oracle_sql() -> dict[str, str]:
    return {name: _with(select) for name, select in SELECTS.items()}

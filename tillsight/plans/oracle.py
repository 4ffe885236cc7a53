"""The registered queries as plain SQL over the warehouse tables, for comparison."""

from __future__ import annotations

_TRANSACTIONS = """
joined AS (
  SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
    concat(l_orderkey, '-', l_linenumber, '-', l_partkey, '-', l_suppkey) AS transaction_id,
    CAST(o_custkey AS VARCHAR) AS user_id,
    concat('PID_', lpad(CAST(l_partkey AS VARCHAR), 8, '0')) AS product_id,
    CASE WHEN mod(l_partkey, 101) = 0 THEN NULL ELSE p_type END AS category,
    p_brand AS sub_category,
    l_extendedprice / l_quantity AS price,
    CAST(l_quantity AS INT) AS quantity,
    l_extendedprice AS total_amount,
    CASE mod(o_orderkey, 4) WHEN 0 THEN 'CreditCard' WHEN 1 THEN 'DebitCard'
      WHEN 2 THEN 'PayPal' ELSE 'CashOnDelivery' END AS payment_method,
    CAST(l_shipdate AS VARCHAR) AS "timestamp",
    CASE mod(o_custkey, 3) WHEN 0 THEN 'Desktop' WHEN 1 THEN 'Mobile'
      ELSE 'Tablet' END AS user_device,
    n_name AS user_city,
    CASE WHEN mod(o_custkey, 97) = 0 THEN NULL
      ELSE CAST(18 + mod(o_custkey * 7, 53) AS INT) END AS user_age,
    CASE mod(o_custkey, 5) WHEN 0 THEN 'Other' WHEN 1 THEN 'M' WHEN 2 THEN 'F'
      WHEN 3 THEN 'M' ELSE 'F' END AS user_gender,
    CAST(10000 + mod(o_custkey * 7919, 190001) AS INT) AS user_income
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  JOIN part ON l_partkey = p_partkey
),
scored AS (
  SELECT *, 5
    + CASE WHEN price > 2000 THEN 10 ELSE 0 END
    + CASE WHEN payment_method IN ('CreditCard', 'PayPal') THEN 5 ELSE 0 END
    + CASE WHEN user_age < 25 THEN 5 ELSE 0 END
    - CASE WHEN user_income > 150000 THEN 5 ELSE 0 END
    + CASE WHEN category IN ('PROMO', 'LARGE') THEN 5 ELSE 0 END AS risk
  FROM joined
),
labelled AS (
  SELECT *, CAST(CASE WHEN
      mod(l_orderkey * 31 + l_partkey * 17 + l_suppkey * 7 + l_linenumber, 100) < risk
    THEN 1 ELSE 0 END AS INT) AS fraud_label,
    CASE WHEN user_age < 20 THEN 'Under 20' WHEN user_age < 30 THEN '20-29'
      WHEN user_age < 40 THEN '30-39' WHEN user_age < 50 THEN '40-49'
      WHEN user_age >= 50 THEN '50+' END AS age_group,
    CASE WHEN user_income < 20000 THEN 'Under 20k' WHEN user_income < 60000 THEN '20k-59k'
      WHEN user_income < 100000 THEN '60k-99k' WHEN user_income < 140000 THEN '100k-139k'
      WHEN user_income >= 140000 THEN '140k+' END AS income_group
  FROM scored
)"""

_DIRTY = _TRANSACTIONS + """,
dirty AS (
  SELECT * REPLACE (
    CASE WHEN mod(l_orderkey, 223) = 0 THEN NULL
      ELSE concat(l_orderkey, '-', l_linenumber) END AS transaction_id,
    CASE WHEN mod(l_partkey, 113) = 0 THEN total_amount + 1.0
      ELSE total_amount END AS total_amount)
  FROM labelled
)"""

_COLUMNS = """transaction_id, user_id, product_id, category, sub_category, price, quantity,
  total_amount, payment_method, "timestamp", user_device, user_city, user_age, user_gender,
  user_income, fraud_label"""

_FRAUD_COUNT = "count(CASE WHEN fraud_label = 1 THEN 1 END)"
_PERCENTAGE = f"{_FRAUD_COUNT} / nullif(count(transaction_id), 0) * 100"
_FRAUD = f"""{_FRAUD_COUNT} AS fraud_count, count(transaction_id) AS total_transactions,
  {_PERCENTAGE} AS fraud_percentage"""
_AVERAGE = "CAST(round(CAST(avg(total_amount) AS DECIMAL(20, 8)), 4) AS DOUBLE)"
_AMOUNTS = f"""{_AVERAGE} AS avg_transaction_amount,
  count(transaction_id) AS transaction_count,
  max(total_amount) AS max_transaction_amount, min(total_amount) AS min_transaction_amount"""
_COUNT = "count(transaction_id) AS transaction_count"

# The text cells of the detail table, in the order of the columns above.
_FAMILIES = {
    "transaction_data": ["user_id", "product_id", "category", "sub_category", "price",
                         "quantity", "total_amount", "payment_method", "timestamp"],
    "customer_data": ["user_device", "user_city", "user_age", "user_gender", "user_income",
                      "fraud_label"],
}


def _from(selection, ctes=_TRANSACTIONS, table="labelled", rest=""):
    return f"WITH {ctes} SELECT {selection} FROM {table} {rest}"


def _group(dimension, measures):
    return _from(f"{dimension}, {measures}", rest=f"GROUP BY {dimension}")


def _cell(name):
    return f"coalesce(CAST(\"{name}\" AS VARCHAR), '')"


def _share(dimension):
    grouped = _group(dimension, _COUNT)
    share = "transaction_count / sum(transaction_count) OVER () * 100"
    return f"SELECT *, {share} AS share, round({share}, 1) AS share_rounded FROM ({grouped})"


def _series(labels, dimension, values):
    def joined(column):
        text = f"coalesce(CAST({column} AS VARCHAR), 'NULL')"
        return f"string_agg({text}, '|' ORDER BY {dimension} NULLS FIRST)"

    decimal = "round(CAST({} AS DECIMAL(20, 8)), 4)"
    columns = [f"{joined(dimension)} AS {labels}"]
    for name, (expression, is_double) in values.items():
        columns.append(f"{joined(decimal.format(expression) if is_double else expression)} AS {name}")
    grouped = _group(
        dimension,
        f"{_COUNT}, avg(total_amount) AS avg_amount, {_PERCENTAGE} AS fraud_percentage",
    )
    return f"SELECT {', '.join(columns)} FROM ({grouped})"


def _counted(labels, dimension, values):
    return _series(labels, dimension, {f'"{values}"': ("transaction_count", False)})


def _rated(labels, dimension):
    return _series(labels, dimension, {"fraud_percentages": ("fraud_percentage", True)})


def _cells():
    rows = ", ".join(
        f"{{'family': '{family}', 'qualifier': '{name}', 'value': {_cell(name)}}}"
        for family, names in _FAMILIES.items()
        for name in names
    )
    inner = _from(f"transaction_id AS row_key, unnest([{rows}]) AS cell")
    return f"SELECT row_key, cell.family, cell.qualifier, cell.value FROM ({inner})"


def _upsert():
    cells = ", ".join(
        f'{_cell(name)} AS "{name}"' for names in _FAMILIES.values() for name in names
    )
    amount = "CASE WHEN fraud_label = 1 THEN 0.0 ELSE total_amount END AS total_amount"
    latest = _from(f"* REPLACE ({amount})")
    return f"SELECT transaction_id AS row_key, {cells} FROM ({latest})"


def _one_pass():
    dimensions = ["payment_method", "age_group", "category", "user_city", "user_device",
                  "income_group", "user_income"]
    parts = [
        f"SELECT '{name}' AS dimension, CAST({name} AS VARCHAR) AS key, {_AMOUNTS}, {_FRAUD} "
        f"FROM labelled GROUP BY {name}"
        for name in dimensions
    ]
    return f"WITH {_TRANSACTIONS} " + " UNION ALL ".join(parts)


def _published_tables():
    none = "CAST(NULL AS {}) AS {}"
    amounts = ["avg_transaction_amount", "transaction_count", "max_transaction_amount", "min_transaction_amount"]
    frauds = ["fraud_count", "total_transactions", "fraud_percentage"]
    whole = {"transaction_count", "fraud_count", "total_transactions"}
    empty = lambda names: ", ".join(none.format("BIGINT" if n in whole else "DOUBLE", n) for n in names)
    columns = f"insight, key, {', '.join(amounts + frauds)}"
    return f"""WITH {_TRANSACTIONS}
    SELECT {columns} FROM (SELECT 'category' AS insight, category AS key, {_AMOUNTS}, {empty(frauds)}
      FROM labelled GROUP BY category)
    UNION ALL
    SELECT {columns} FROM (SELECT 'fraud_category' AS insight, category AS key, {empty(amounts)}, {_FRAUD}
      FROM labelled GROUP BY category)"""


def _fraud_long():
    dimensions = ["category", "payment_method", "user_device", "user_city", "age_group",
                  "income_group"]
    parts = [
        f"SELECT '{name}' AS dimension, {name} AS key, {_FRAUD} FROM labelled GROUP BY {name}"
        for name in dimensions
    ]
    return f"WITH {_TRANSACTIONS} " + " UNION ALL ".join(parts)


def _sales_long():
    """Five sales tables by their count, and the fraud table by its percentage."""
    counted = {"category": "category", "payment_method": "payment_method",
               "age_group": "age_group", "city": "user_city", "device": "user_device"}
    parts = [
        f"SELECT '{name}' AS insight, {column} AS key, CAST(count(transaction_id) AS DOUBLE) AS value "
        f"FROM labelled GROUP BY {column}"
        for name, column in counted.items()
    ]
    parts.append(f"SELECT 'fraud' AS insight, category AS key, {_PERCENTAGE} AS value "
                 "FROM labelled GROUP BY category")
    return f"WITH {_TRANSACTIONS} " + " UNION ALL ".join(parts)


_NUMERIC = ["price", "quantity", "total_amount", "user_age", "user_income"]
_CATEGORICAL = ["category", "sub_category", "payment_method", "user_device", "user_city",
                "user_gender"]
_COMPLETE = " AND ".join(f"{name} IS NOT NULL" for name in _NUMERIC + _CATEGORICAL)


def _index(name, table):
    return f"""SELECT {name}, count(*) AS occurrences,
      CAST(row_number() OVER (ORDER BY count(*) DESC, {name}) - 1 AS DOUBLE) AS {name}_index
      FROM {table} WHERE {name} IS NOT NULL GROUP BY {name}"""


def _features():
    ctes = _TRANSACTIONS + f", complete AS (SELECT * FROM labelled WHERE {_COMPLETE})"
    numbers = ", ".join(f"CAST({name} AS DOUBLE) AS {name}" for name in _NUMERIC)
    indexes = ", ".join(f"{name}_index" for name in _CATEGORICAL)
    joins = " ".join(
        f"JOIN ({_index(name, 'complete')}) AS {name}_counts USING ({name})"
        for name in _CATEGORICAL
    )
    return _from(f"transaction_id, {numbers}, {indexes}", ctes, "complete", joins)


def _split():
    names = ["transaction_id", *_CATEGORICAL, "quantity", "user_age", "user_income"]
    record = f"concat_ws('|', {', '.join(names)})"
    draw = f"CAST('0x' || substr(md5({record}), 1, 8) AS BIGINT)"
    part = f"CASE WHEN {draw} < 3435973836 THEN 'training' ELSE 'test' END AS part"
    return _from(f"transaction_id, {part}", rest=f"WHERE {_COMPLETE}")


def _test_part(selection):
    names = ["transaction_id", *_CATEGORICAL, "quantity", "user_age", "user_income"]
    draw = f"CAST('0x' || substr(md5(concat_ws('|', {', '.join(names)})), 1, 8) AS BIGINT)"
    return _from(selection, rest=f"WHERE {_COMPLETE} AND {draw} >= 3435973836")


def _auc():
    return f"""WITH {_TRANSACTIONS},
    groups AS (
      SELECT risk, count(*) FILTER (WHERE fraud_label = 1) AS pos,
        count(*) FILTER (WHERE fraud_label <> 1) AS neg
      FROM labelled GROUP BY risk
    ),
    ranked AS (SELECT *, sum(neg) OVER (ORDER BY risk) - neg AS below FROM groups)
    SELECT round(CAST(sum(pos * (below + neg / 2)) AS DOUBLE)
      / (CAST(sum(pos) AS DOUBLE) * CAST(sum(neg) AS DOUBLE)), 8) AS area_under_roc FROM ranked"""


def _domain():
    return f"""WITH {_DIRTY}
    SELECT transaction_id, 'user_city' AS field, user_city AS value FROM dirty
    WHERE user_city NOT IN (SELECT n_name FROM nation WHERE n_regionkey < 4)
    UNION ALL
    SELECT transaction_id, 'category/sub_category' AS field,
      category || '/' || sub_category AS value
    FROM dirty
    WHERE category IS NOT NULL AND NOT EXISTS (
      SELECT 1 FROM part WHERE p_type = category AND p_brand = sub_category
        AND (p_type <> 'PROMO' OR p_brand < 'Brand#3'))
    UNION ALL
    SELECT transaction_id, 'payment_method' AS field, payment_method AS value FROM dirty
    WHERE payment_method NOT IN ('CreditCard', 'DebitCard', 'PayPal')
    UNION ALL
    SELECT transaction_id, 'user_device' AS field, user_device AS value FROM dirty
    WHERE user_device NOT IN ('Desktop', 'Mobile')
    UNION ALL
    SELECT transaction_id, 'user_gender' AS field, user_gender AS value FROM dirty
    WHERE user_gender NOT IN ('M', 'F')"""


def _ranges():
    bounds = [("quantity", 1, 5), ("user_age", 18, 70), ("user_income", 20000, 200000),
              ("price", 1.0, 999.99)]
    parts = [
        f"SELECT '{name}' AS field, CAST({low} AS DOUBLE) AS low, CAST({high} AS DOUBLE) AS high, "
        f"count({name}) AS checked, "
        f"count(*) FILTER (WHERE {name} < {low} OR {name} > {high}) AS violations FROM dirty"
        for name, low, high in bounds
    ]
    return f"WITH {_DIRTY} " + " UNION ALL ".join(parts)


def _mismatch():
    expected = "round(price * quantity, 2)"
    return _from(
        f"transaction_id, total_amount, {expected} AS expected_amount, "
        f"round(abs(total_amount - {expected}), 4) AS difference",
        _DIRTY,
        "dirty",
        f"WHERE abs(total_amount - {expected}) > 0.005",
    )


def _quarantine():
    fields = ", ".join(
        f'CASE WHEN mod(l_orderkey, 211) <> 0 THEN "{name}" END AS "{name}"'
        for name in ["user_id", "product_id", "timestamp", "total_amount"]
    )
    reason = "CASE WHEN mod(l_orderkey, 211) = 0 THEN 'unreadable' ELSE 'missing_id' END AS reason"
    return _from(
        f"{reason}, {fields}", _DIRTY, "dirty",
        "WHERE mod(l_orderkey, 211) = 0 OR transaction_id IS NULL",
    )


def _judged():
    """All messages of the faulty feed; the id of an unreadable one is lost."""
    fields = ", ".join(
        f'CASE WHEN mod(l_orderkey, 211) <> 0 THEN "{name}" END AS "{name}"'
        for name in ["transaction_id", "user_id", "product_id", "timestamp", "total_amount"]
    )
    reason = "CASE WHEN mod(l_orderkey, 211) = 0 THEN 'unreadable' WHEN transaction_id IS NULL THEN 'missing_id' END AS reason"
    return _from(f"{reason}, {fields}", _DIRTY, "dirty")


def _load_counts():
    good = "mod(l_orderkey, 211) <> 0 AND transaction_id IS NOT NULL"
    stored = f"count(DISTINCT transaction_id) FILTER (WHERE {good})"
    return _from(
        f"count(*) AS rows_read, {stored} AS stored, count(*) FILTER (WHERE {good}) - {stored} "
        f"AS replaced, count(*) FILTER (WHERE NOT ({good})) AS refused", _DIRTY, "dirty",
    )


_RECORDS = _from(_COLUMNS)
_BY_CATEGORY = _group("category", _FRAUD)

ORACLE = {
    "decode_roundtrip": _RECORDS,
    "csv_roundtrip": _RECORDS,
    "csv_reordered":
        _from(_COLUMNS.replace("user_city", "CAST(NULL AS VARCHAR) AS user_city")),
    "typed_transactions": _RECORDS,
    "decode_events_props":
        "SELECT event_id, CAST(json_extract(props, '$.k') AS INT) AS k FROM events",
    "total_rows": _from("count(*) AS total_rows"),
    "detail_cells": _cells(),
    "detail_cells_large": _from(
        "transaction_id, CAST(price * 1e6 AS VARCHAR) AS price, "
        "CAST(floor(price) / 1e7 AS VARCHAR) AS total_amount"
    ),
    "detail_upsert": _upsert(),
    "detail_incremental": _upsert(),
    "detail_quarantine": _quarantine(),
    "detail_counts": _load_counts(),
    "publish_insight": _BY_CATEGORY,
    "insight_latest": _BY_CATEGORY,
    "category_analytics": _group("category", _AMOUNTS),
    "payment_method_distribution": _group("payment_method", _COUNT),
    "age_distribution": _group("age_group", _COUNT),
    "city_transaction_count": _group("user_city", _COUNT),
    "device_usage": _group("user_device", _COUNT),
    "income_spending":
        _group("user_income", f"{_AVERAGE} AS avg_transaction_amount"),
    "fraud_analytics": _group("category", f"{_PERCENTAGE} AS fraud_percentage"),
    "fraud_category": _BY_CATEGORY,
    "fraud_payment": _group("payment_method", _FRAUD),
    "fraud_device": _group("user_device", _FRAUD),
    "fraud_city": _group("user_city", _FRAUD),
    "fraud_age": _group("age_group", _FRAUD),
    "fraud_income": _group("income_group", _FRAUD),
    "insights_one_pass": _one_pass(),
    "insights_incremental": _one_pass(),
    "insights_incremental_published": _published_tables(),
    "payment_method_share": _share("payment_method"),
    "device_share": _share("user_device"),
    "series_payment_method": _counted("labels", "payment_method", "values"),
    "series_age_group": _counted("labels", "age_group", "values"),
    "series_device": _counted("labels", "user_device", "values"),
    "series_city": _counted("cities", "user_city", "transaction_counts"),
    "series_category": _series("categories", "category", {
        "transaction_counts": ("transaction_count", False),
        "avg_amounts": ("avg_amount", True),
    }),
    "series_fraud": _rated("categories", "category"),
    "series_fraud_category": _rated("categories", "category"),
    "series_fraud_payment": _rated("payment_methods", "payment_method"),
    "series_fraud_device": _rated("devices", "user_device"),
    "series_fraud_city": _rated("cities", "user_city"),
    "series_fraud_age": _rated("age_groups", "age_group"),
    "series_fraud_income": _rated("income_groups", "income_group"),
    "series_empty": "SELECT '' AS categories, '' AS fraud_percentages",
    "rule_risk_score": _from("transaction_id, risk, fraud_label"),
    "risk_calibration": _group("risk", _FRAUD),
    "score_auc": _auc(),
    "dq_amount_mismatch": _mismatch(),
    "dq_domain_violations": _domain(),
    "dq_duplicate_ids": _from(
        "transaction_id, count(*) AS occurrences", _DIRTY, "dirty",
        "WHERE transaction_id IS NOT NULL GROUP BY transaction_id HAVING count(*) > 1",
    ),
    "dq_range_violations": _ranges(),
    "quarantine_rows": _quarantine(),
    "string_index_category": f"WITH {_TRANSACTIONS} {_index('category', 'labelled')}",
    "fraud_features": _features(),
    "train_test_split": _split(),
    "stream_payment_method": _group("payment_method", _COUNT),
    "stream_fraud_category": _BY_CATEGORY,
    "stream_category": _group("category", _AMOUNTS),
    "stream_insights": _fraud_long(),
    "stream_sales": _sales_long(),
    "stream_two_queries": _group("payment_method", f"{_COUNT}, 2 AS runs"),
    "insight_latest_empty_run":
        f"SELECT 0 AS latest_groups, count(*) AS all_groups FROM ({_BY_CATEGORY})",
    "fraud_model_predict": _test_part("transaction_id, fraud_label, true AS probability_holds, "
                                      "true AS prediction_holds"),
    "fraud_model_auc": _test_part("count(*) FILTER (WHERE fraud_label = 1) AS positives, "
                                  "count(*) FILTER (WHERE fraud_label <> 1) AS negatives, "
                                  "true AS area_holds"),
    "stream_decode": _RECORDS,
    "stream_quarantine": _judged(),
    "stream_detail": _upsert(),
}

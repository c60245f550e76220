"""The catalogue's queries as plain SQL over the test tables, written independently of Spark."""

from txnrisk.schemas import CATEGORICAL_FEATURES, GOLD_COLUMNS, NUMERIC_FEATURES, RAW_COLUMNS

RAW = """
raw_transactions AS (
  SELECT
    CASE (l.l_partkey + l.l_suppkey) % 211
         WHEN 0 THEN NULL WHEN 1 THEN '   ' WHEN 2 THEN ''
         ELSE concat('T', CAST(l.l_orderkey AS VARCHAR), '-', CAST(l.l_linenumber AS VARCHAR))
    END AS transaction_id,
    l.l_shipdate AS timestamp,
    concat('C', CAST(o.o_custkey AS VARCHAR)) AS payor_id,
    concat('S', CAST(l.l_suppkey AS VARCHAR)) AS payee_id,
    CASE (l.l_partkey + l.l_suppkey) % 211
         WHEN 3 THEN NULL WHEN 4 THEN CAST(0 AS DOUBLE) WHEN 5 THEN -l.l_extendedprice
         ELSE l.l_extendedprice END AS amount,
    CASE l.l_linenumber % 3 WHEN 0 THEN 'USD' WHEN 1 THEN 'EUR' ELSE 'GBP' END AS currency,
    o.o_orderpriority AS payment_method,
    l.l_linestatus AS status,
    CAST(5000 + p.p_size AS BIGINT) AS merchant_mcc,
    concat('dev-', CAST(l.l_partkey % 500 AS VARCHAR)) AS device_id,
    concat('10.0.', CAST(l.l_suppkey % 256 AS VARCHAR), '.', CAST(l.l_partkey % 256 AS VARCHAR))
      AS ip_address,
    CASE WHEN l.l_returnflag = 'N' THEN CAST(NULL AS BIGINT)
         WHEN (l.l_extendedprice > 50000 AND o.o_orderpriority IN ('1-URGENT', '2-HIGH'))
              = (l.l_partkey % 20 <> 0) THEN CAST(1 AS BIGINT)
         ELSE CAST(0 AS BIGINT) END AS is_fraud
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN part p ON l.l_partkey = p.p_partkey
)"""

LOOKUPS = """
dim_payers AS (
  SELECT concat('C', CAST(c.c_custkey AS VARCHAR)) AS payor_id, c.c_name AS payor_name,
         CASE WHEN c.c_custkey % 51 = 0 THEN NULL ELSE n.n_name END AS payor_country,
         CASE WHEN c.c_custkey % 53 = 0 THEN NULL ELSE (10000 - c.c_acctbal) / 11000 END
           AS payor_risk_score
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
  WHERE c.c_custkey % 50 <> 0
),
dim_payees AS (
  SELECT concat('S', CAST(s.s_suppkey AS VARCHAR)) AS payee_id, s.s_name AS payee_name,
         CASE WHEN s.s_suppkey % 11 = 0 THEN NULL ELSE n.n_name END AS payee_country,
         CASE WHEN s.s_suppkey % 13 = 0 THEN NULL ELSE (10000 - s.s_acctbal) / 11000 END
           AS payee_risk_score,
         CASE s.s_suppkey % 4 WHEN 0 THEN 'Retail' WHEN 1 THEN 'Travel' WHEN 2 THEN 'Gaming'
           ELSE NULL END AS payee_category
  FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey
  WHERE s.s_suppkey % 10 <> 0
)"""

SILVER = """
valid_ids AS (
  SELECT * FROM raw_transactions WHERE transaction_id IS NOT NULL AND trim(transaction_id) <> ''
),
ranked AS (
  SELECT *, row_number() OVER (
    PARTITION BY transaction_id
    ORDER BY timestamp DESC NULLS LAST, amount DESC NULLS LAST, payee_id NULLS LAST,
             device_id NULLS LAST, ip_address NULLS LAST, payor_id NULLS LAST,
             currency NULLS LAST, payment_method NULLS LAST, status NULLS LAST,
             merchant_mcc NULLS LAST, is_fraud NULLS LAST) AS row_num
  FROM valid_ids
),
stg_transactions AS (SELECT * EXCLUDE (row_num) FROM ranked WHERE row_num = 1)"""

INVALID = """
invalid_transactions AS (
  SELECT *, TIMESTAMP '2026-01-01 00:00:00' AS quarantined_at,
         CASE WHEN transaction_id IS NULL OR trim(transaction_id) = ''
              THEN 'MISSING_TRANSACTION_ID' ELSE 'INVALID_AMOUNT' END AS quarantine_reason
  FROM raw_transactions
  WHERE transaction_id IS NULL OR trim(transaction_id) = '' OR amount IS NULL OR amount <= 0
)"""

GOLD = """
enriched_transactions AS (
  SELECT t.transaction_id, t.timestamp, t.amount, t.currency, t.payment_method, t.status,
         t.merchant_mcc, t.device_id, t.ip_address, t.payor_id, p.payor_name,
         coalesce(p.payor_country, 'UNKNOWN') AS payor_country,
         coalesce(p.payor_risk_score, 0.0) AS payor_risk_score, t.payee_id, e.payee_name,
         coalesce(e.payee_country, 'UNKNOWN') AS payee_country,
         coalesce(e.payee_risk_score, 0.0) AS payee_risk_score,
         coalesce(e.payee_category, 'General') AS payee_category, t.is_fraud
  FROM stg_transactions t
  LEFT JOIN dim_payers p ON t.payor_id = p.payor_id
  LEFT JOIN dim_payees e ON t.payee_id = e.payee_id
)"""

SCORED = """
scored AS (
  SELECT *, amount / 100000 AS fraud_probability,
         CASE WHEN amount / 100000 >= 0.5 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction
  FROM enriched_transactions WHERE amount IS NOT NULL
)"""

ALERTS = """
review_queue AS (
  SELECT transaction_id, amount, currency, device_id, ip_address, merchant_mcc, payee_id,
         payment_method, payor_id, status, timestamp, payor_name, payor_country,
         payor_risk_score, payee_name, payee_country, payee_risk_score, payee_category,
         CAST(prediction AS BIGINT) AS is_fraud, prediction
  FROM scored WHERE is_fraud IS NULL AND fraud_probability >= 0.5
)"""

CURVE = """
per_score AS (
  SELECT fraud_probability AS score, count(*) FILTER (WHERE is_fraud = 1) AS pos,
         count(*) FILTER (WHERE is_fraud = 0) AS neg
  FROM scored WHERE is_fraud IS NOT NULL GROUP BY fraud_probability
),
curve AS (
  SELECT *, sum(pos) OVER (ORDER BY score DESC) AS tp, sum(neg) OVER (ORDER BY score DESC) AS fp,
         sum(pos) OVER () AS positives, sum(neg) OVER () AS negatives
  FROM per_score
),
points AS (
  SELECT *, tp / (tp + fp) AS prec, lag(tp / (tp + fp), 1, tp / (tp + fp))
              OVER (ORDER BY score DESC) AS prec_before,
         tp / positives AS tpr, lag(tp / positives, 1, 0.0) OVER (ORDER BY score DESC) AS tpr_before,
         fp / negatives AS fpr, lag(fp / negatives, 1, 0.0) OVER (ORDER BY score DESC) AS fpr_before
  FROM curve
)"""

OUTCOMES = """
outcomes AS (
  SELECT count(*) FILTER (WHERE is_fraud = 1 AND prediction = 1) AS tp,
         count(*) FILTER (WHERE is_fraud = 0 AND prediction = 1) AS fp,
         count(*) FILTER (WHERE is_fraud = 1 AND prediction = 0) AS fn,
         count(*) FILTER (WHERE is_fraud = 0 AND prediction = 0) AS tn
  FROM scored WHERE is_fraud IS NOT NULL
),
per_class AS (
  SELECT 'Legitimate' AS class, tn / (tn + fn) AS precision, tn / (tn + fp) AS recall,
         tn + fp AS support FROM outcomes
  UNION ALL
  SELECT 'Fraud', tp / (tp + fp), tp / (tp + fn), tp + fn FROM outcomes
),
classes AS (
  SELECT *, 2 * precision * recall / (precision + recall) AS f1_score FROM per_class
)"""

_LAYERS = [RAW, LOOKUPS, SILVER, INVALID, GOLD, SCORED, ALERTS]


def _over(select: str, *extra: str) -> str:
    """The select with all layers defined before it; unused ones cost nothing."""
    return "WITH" + ",".join([*_LAYERS, *extra]) + select


def _key_tests(table: str, key: str, columns: list[str], name: str | None = None) -> str:
    name = name or table
    tests = [
        f"SELECT 'unique_{name}_{key}' AS test, count(*) AS failures FROM (SELECT {key} FROM {table}"
        f" WHERE {key} IS NOT NULL GROUP BY {key} HAVING count(*) > 1)"
    ]
    tests += [
        f"SELECT 'not_null_{name}_{c}' AS test, count(*) AS failures FROM {table} WHERE {c} IS NULL"
        for c in columns
    ]
    return " UNION ALL ".join(tests)


def _tests(*parts: str) -> str:
    union = " UNION ALL ".join(parts)
    return _over(f" SELECT test, failures, failures = 0 AS passed FROM ({union})")


def _all(table: str) -> str:
    return _over(f" SELECT * FROM {table}")


def _sample(table: str, columns: list[str], n: int = 100) -> str:
    order = ", ".join(f"{c} ASC NULLS LAST" for c in columns)
    return _over(f" SELECT {', '.join(columns)} FROM {table} ORDER BY {order} LIMIT {n}")


_CUT_LINE = "merchant_mcc % 50 = 7"
_READABLE = f"SELECT * FROM raw_transactions WHERE NOT ({_CUT_LINE})"

# Raw rows as text, some of it unreadable, and what is left of it as numbers.
_ODD = """
odd_text AS (
  SELECT * REPLACE (
    CASE merchant_mcc % 9 WHEN 0 THEN 'n/a' WHEN 1 THEN '1,234.50' WHEN 2 THEN '12d'
      WHEN 3 THEN '1e999' WHEN 4 THEN '0x1p4'
      ELSE CAST(CAST(round(amount * 100) AS BIGINT) AS VARCHAR) END AS amount,
    CASE WHEN merchant_mcc % 5 = 0 THEN 'code' ELSE CAST(merchant_mcc AS VARCHAR) END AS merchant_mcc,
    CASE WHEN currency = 'GBP' AND is_fraud = 1 THEN 'maybe' ELSE CAST(is_fraud AS VARCHAR) END
      AS is_fraud),
    merchant_mcc % 9 < 5 AS odd, payment_method = '5-LOW' AS no_time
  FROM raw_transactions
),
odd_states AS (
  SELECT *, CASE WHEN transaction_id IS NULL OR trim(transaction_id) = ''
                 THEN 'MISSING_TRANSACTION_ID'
                 WHEN odd OR amount IS NULL OR CAST(amount AS BIGINT) <= 0 THEN 'INVALID_AMOUNT'
                 ELSE 'VALID' END AS record_state
  FROM odd_text
)"""

ORACLE: dict[str, str] = {
    "quarantine_text": _over(
        """
        SELECT transaction_id, amount, merchant_mcc, is_fraud, record_state AS quarantine_reason
        FROM odd_states WHERE record_state <> 'VALID'""",
        _ODD,
    ),
    "odd_amounts": _over(
        """
        SELECT CASE WHEN odd THEN amount END AS amount, record_state, count(*) AS n
        FROM odd_states GROUP BY 1, 2""",
        _ODD,
    ),
    "parse_losses": _over(
        """
        SELECT 'timestamp' AS column, count(*) FILTER (no_time) AS lost FROM odd_text
        UNION ALL SELECT 'amount', count(*) FILTER (odd) FROM odd_text
        UNION ALL SELECT 'merchant_mcc', count(*) FILTER (merchant_mcc = 'code') FROM odd_text
        UNION ALL SELECT 'is_fraud', count(*) FILTER (is_fraud = 'maybe') FROM odd_text""",
        _ODD,
    ),
    "labels_all": _over(
        """
        SELECT label AS is_fraud, CAST(sum(n) AS BIGINT) AS n FROM (
          SELECT CAST(CASE WHEN merchant_mcc % 9 = 0 THEN 7 ELSE is_fraud END AS BIGINT) AS label,
                 1 AS n FROM enriched_transactions
          UNION ALL SELECT 0, 0 UNION ALL SELECT 1, 0)
        WHERE label IS NOT NULL GROUP BY label"""
    ),
    "random_split": _over(
        """
        SELECT split, is_fraud, count(*) AS n FROM (
          SELECT is_fraud, CASE WHEN CAST(('0x' || substr(md5('42:' || transaction_id), 1, 8)) AS BIGINT)
                                     < 4 * 4294967296 // 5 THEN 'train' ELSE 'test' END AS split
          FROM enriched_transactions WHERE is_fraud IS NOT NULL)
        GROUP BY split, is_fraud"""
    ),
    "split_rows": _over(
        """
        SELECT is_fraud, 'train' AS split, 4 * count(*) // 5 AS n FROM enriched_transactions
        WHERE is_fraud IS NOT NULL GROUP BY is_fraud
        UNION ALL
        SELECT is_fraud, 'test', count(*) - 4 * count(*) // 5 FROM enriched_transactions
        WHERE is_fraud IS NOT NULL GROUP BY is_fraud"""
    ),
    "one_hot": _over(
        " UNION ALL ".join(
            f"""
            SELECT '{c}' AS feature, value, array_to_string(list_transform(range(n),
                     lambda i: CASE WHEN i = place THEN '1' ELSE '0' END), ',') AS hot
            FROM (SELECT {c} AS value, row_number() OVER (ORDER BY count(*) DESC, {c}) - 1 AS place,
                         count(*) OVER () AS n
                  FROM enriched_transactions WHERE is_fraud IS NOT NULL GROUP BY {c})"""
            for c in CATEGORICAL_FEATURES
        )
    ),
    "scaled_features": _over(
        " SELECT transaction_id, "
        + ", ".join(f"round({c} / stddev_samp({c}) OVER (), 6) AS {c}" for c in NUMERIC_FEATURES)
        + " FROM enriched_transactions WHERE is_fraud IS NOT NULL AND amount IS NOT NULL"
    ),
    "fraud_probability": _over(
        """
        SELECT transaction_id, CASE WHEN merchant_mcc % 11 IN (0, 1) THEN 0.0::DOUBLE
                                    ELSE fraud_probability END AS fraud_probability
        FROM scored"""
    ),
    "score_checks": _over(
        """
        SELECT transaction_id, true AS is_probability, true AS follows
        FROM enriched_transactions WHERE is_fraud IS NULL"""
    ),
    "queue_checks": _over(
        " SELECT transaction_id, true AS right FROM enriched_transactions WHERE is_fraud IS NULL"
    ),
    "queue_append_repeats": _all("review_queue"),
    "queue_append_pruned": _over(
        """
        SELECT CAST(1 AS BIGINT) AS version, transaction_id, amount FROM review_queue
        WHERE payor_country = 'UNKNOWN'
        UNION ALL SELECT 2, transaction_id, amount FROM review_queue"""
    ),
    "table_versions": _over(
        """
        SELECT CAST(version AS BIGINT) AS version, transaction_id, amount, payment_method
        FROM enriched_transactions, (VALUES (1), (2), (3)) AS v(version)
        WHERE CASE version WHEN 1 THEN is_fraud IS NOT NULL WHEN 2 THEN true
              ELSE payor_country = 'UNKNOWN' END"""
    ),
    "connector_round_trip": _all("enriched_transactions"),
    "enriched_without_payers": _over(
        """
        SELECT * REPLACE (CAST(NULL AS VARCHAR) AS payor_name, 'UNKNOWN' AS payor_country,
                          CAST(0 AS DOUBLE) AS payor_risk_score)
        FROM enriched_transactions"""
    ),
    "inputs_missing": _over(
        """
        SELECT 'log' AS input, count(*) AS rows FROM raw_transactions
        UNION ALL SELECT 'payees', count(*) FROM dim_payees
        UNION ALL SELECT unnest(['empty_log', 'missing_payers', 'no_payers']), 0"""
    ),
    "extra_fields": _over(
        """
        , wide AS (
          SELECT coalesce(transaction_id, '') AS id, merchant_mcc AS mcc,
                 concat('{"id":"', device_id, '"}') AS cell
          FROM raw_transactions
        ),
        fields AS (
          SELECT id, 'channel' AS field, 'STRING' AS type, '"web"' AS value FROM wide WHERE mcc % 3 = 0
          UNION ALL SELECT id, 'channel', 'VOID', 'null' FROM wide WHERE mcc % 3 = 1
          UNION ALL SELECT id, 'geo', 'OBJECT',
            concat('{"at":[1.5,true],"cell":', cell, ',"zone":', mcc % 7, '}') FROM wide WHERE mcc % 2 = 0
          UNION ALL SELECT id, 'geo.at', 'ARRAY', '[1.5,true]' FROM wide WHERE mcc % 2 = 0
          UNION ALL SELECT id, 'geo.cell', 'OBJECT', cell FROM wide WHERE mcc % 2 = 0
          UNION ALL SELECT id, 'geo.cell.id', 'STRING', cell[7:-2] FROM wide WHERE mcc % 2 = 0
          UNION ALL SELECT id, 'geo.zone', 'BIGINT', CAST(mcc % 7 AS VARCHAR) FROM wide WHERE mcc % 2 = 0
          UNION ALL SELECT id, 'retries', 'BIGINT', CAST(mcc % 4 AS VARCHAR) FROM wide WHERE mcc % 5 = 0
          UNION ALL SELECT id, 'retries', 'STRING', '"n/a"' FROM wide WHERE mcc % 5 = 1
        )
        SELECT field, type, count(*) AS rows,
               CAST(sum(CAST(concat('0x', substr(md5(concat(id, '=', value)), 1, 8)) AS BIGINT)) AS BIGINT)
                 AS digest
        FROM fields GROUP BY field, type"""
    ),
    "enriched_bucketed": _all("enriched_transactions"),
    "category_ranks": _over(
        """
        SELECT device_id AS value, count(*) AS n,
               row_number() OVER (ORDER BY count(*) DESC, device_id) - 1 AS position
        FROM enriched_transactions WHERE device_id IS NOT NULL GROUP BY device_id"""
    ),
    "category_codes": _over(
        """
        , known AS (
          SELECT payor_id, row_number() OVER (ORDER BY count(*) DESC, payor_id) - 1 AS position
          FROM enriched_transactions WHERE is_fraud IS NOT NULL GROUP BY payor_id
        )
        SELECT position AS payor_id_position, count(*) AS n
        FROM enriched_transactions t LEFT JOIN known k ON t.payor_id = k.payor_id GROUP BY position"""
    ),
    "exact_medians": _over(
        ", labelled AS (SELECT *, transaction_id = min(transaction_id) OVER () AS is_first"
        " FROM enriched_transactions WHERE is_fraud IS NOT NULL)"
        + " UNION ALL ".join(
            f" SELECT '{c}' AS \"column\", count({c}) AS n, round(CAST(median({c}) AS DOUBLE), 9) AS median,"
            f" '{part}' AS part FROM labelled WHERE {rows}"
            for c in NUMERIC_FEATURES
            for part, rows in (("all", "true"), ("all_but_one", "NOT is_first"))
        )
    ),
    "stored_counts": _over(
        """
        SELECT 'staging' AS layer, count(*) AS n FROM stg_transactions
        UNION ALL SELECT 'quarantine', count(*) FROM invalid_transactions
        UNION ALL SELECT 'gold', count(*) FROM enriched_transactions"""
    ),
    "stage_plan": """
        SELECT stage, stale, reason, after, CAST(0 AS BIGINT) AS ran_again FROM (VALUES
          ('ingestion', false, '', 'two stages'), ('transform', false, '', 'two stages'),
          ('training', true, 'never done', 'two stages'), ('inference', true, 'never done', 'two stages'),
          ('ingestion', true, 'not as left: dim_payers', 'a change'),
          ('transform', true, 'made anew: raw, dim_payers, dim_payees', 'a change'),
          ('training', true, 'never done', 'a change'), ('inference', true, 'never done', 'a change')
        ) AS planned(stage, stale, reason, after)""",
    "forest_rescored": _over(
        " SELECT transaction_id, true AS same FROM enriched_transactions WHERE is_fraud IS NULL"
    ),
    "forest_shape": """
        SELECT CAST(tree AS BIGINT) AS tree, true AS complete, true AS rows_add_up, true AS within_depth,
               true AS splits
        FROM range(50) AS trees(tree)""",
    "raw_scan": _all("raw_transactions"),
    "dim_payers": _all("dim_payers"),
    "dim_payees": _all("dim_payees"),
    "typed_rows": _over(
        """
        SELECT * REPLACE (
          CASE WHEN payment_method = '5-LOW' THEN NULL ELSE timestamp END AS timestamp,
          CASE WHEN merchant_mcc % 7 IN (0, 1) THEN NULL ELSE amount END AS amount,
          CASE WHEN merchant_mcc % 5 = 0 THEN NULL ELSE merchant_mcc END AS merchant_mcc)
        FROM raw_transactions"""
    ),
    "json_ingest": _over(f" {_READABLE}"),
    "json_line_states": _over(
        f"""
        SELECT record_state, count(*) AS n FROM (
          SELECT CASE WHEN {_CUT_LINE} THEN 'CORRUPT_LINE'
                      WHEN transaction_id IS NULL OR trim(transaction_id) = ''
                      THEN 'MISSING_TRANSACTION_ID'
                      WHEN amount IS NULL OR amount <= 0 THEN 'INVALID_AMOUNT'
                      ELSE 'VALID' END AS record_state
          FROM raw_transactions) GROUP BY record_state"""
    ),
    "csv_payers": _all("dim_payers"),
    "csv_payees": _over(
        " SELECT * REPLACE (nullif(payee_category, 'Travel') AS payee_category) FROM dim_payees"
    ),
    "table_overwrite": _all("enriched_transactions"),
    "table_by_state": _all("valid_ids"),
    "silver_view": _all("stg_transactions"),
    "valid_id_rows": _all("valid_ids"),
    "ranked_rows": _over(" SELECT * FROM ranked WHERE row_num <= 3"),
    "stg_dedup_latest": _all("stg_transactions"),
    "quarantine": _all("invalid_transactions"),
    "quarantine_by_reason": _over(
        " SELECT quarantine_reason, count(*) AS n FROM invalid_transactions"
        " GROUP BY quarantine_reason"
    ),
    "payer_lookup": _all("dim_payers"),
    "payee_lookup": _all("dim_payees"),
    "enriched": _all("enriched_transactions"),
    "enriched_by_shuffle": _all("enriched_transactions"),
    "dup_count": _over(
        " SELECT count(*) - count(DISTINCT transaction_id) AS duplicate_count FROM raw_transactions"
    ),
    "null_id_count": _over(
        " SELECT count(*) AS null_count FROM raw_transactions WHERE transaction_id IS NULL"
    ),
    "dq_report": _tests(
        _key_tests("stg_transactions", "transaction_id", ["transaction_id"]),
        _key_tests("enriched_transactions", "transaction_id", ["transaction_id", "amount"]),
    ),
    "dq_raw_keys": _tests(
        _key_tests("raw_transactions", "transaction_id", ["transaction_id", "amount"])
    ),
    "dq_lookups": _tests(
        _key_tests("dim_payers", "payor_id", []), _key_tests("dim_payees", "payee_id", [])
    ),
    "raw_count": _over(" SELECT count(*) AS row_count FROM raw_transactions"),
    "layer_counts": _over(
        """
        SELECT (SELECT count(*) FROM raw_transactions) AS raw,
               (SELECT count(*) FROM stg_transactions) AS staging,
               (SELECT count(*) FROM invalid_transactions) AS quarantine,
               (SELECT count(*) FROM enriched_transactions) AS gold,
               (SELECT count(*) FROM review_queue) AS queue"""
    ),
    "ingestion_summary": _over(
        """
        SELECT (SELECT count(*) FROM raw_transactions) AS total,
               (SELECT count(*) FROM (SELECT DISTINCT payment_method FROM raw_transactions))
                 AS payment_methods,
               (SELECT count(*) FROM raw_transactions WHERE is_fraud IS NOT NULL) AS labeled,
               (SELECT count(*) FROM raw_transactions WHERE is_fraud IS NULL) AS unlabeled"""
    ),
    "class_distribution": _over(
        " SELECT is_fraud, count(*) AS n FROM enriched_transactions"
        " WHERE is_fraud IS NOT NULL GROUP BY is_fraud"
    ),
    "labeled_rows": _over(" SELECT * FROM enriched_transactions WHERE is_fraud IS NOT NULL"),
    "unlabeled_rows": _over(" SELECT * FROM enriched_transactions WHERE is_fraud IS NULL"),
    "unlabeled_or_first_2500": _over(
        " SELECT * FROM enriched_transactions WHERE is_fraud IS NOT NULL"
        " ORDER BY transaction_id LIMIT 2500"
    ),
    "layer_sample_raw": _sample("raw_transactions", RAW_COLUMNS),
    "layer_sample_stg": _sample("stg_transactions", RAW_COLUMNS),
    "layer_sample_invalid": _sample(
        "invalid_transactions", [*RAW_COLUMNS, "quarantined_at", "quarantine_reason"]
    ),
    "layer_sample_gold": _sample("enriched_transactions", GOLD_COLUMNS),
    "layer_sample_payers": _sample(
        "dim_payers", ["payor_id", "payor_name", "payor_country", "payor_risk_score"]
    ),
    "layer_sample_payees": _sample(
        "dim_payees",
        ["payee_id", "payee_name", "payee_country", "payee_risk_score", "payee_category"],
    ),
    "proxy_scores": _over(" SELECT transaction_id, fraud_probability, prediction FROM scored"),
    "proxy_alerts": _all("review_queue"),
    "queue_existing_columns": _over(
        """
        SELECT transaction_id, amount, currency, device_id, ip_address, merchant_mcc, payee_id,
               payment_method, payor_id, status, timestamp, is_fraud
        FROM stg_transactions"""
    ),
    "queue_append_twice": _all("review_queue"),
    "queue_replace": _all("review_queue"),
    "queue_filter": _over(
        " SELECT * FROM review_queue"
        " WHERE payor_country IN ('NATION_3', 'NATION_19', 'UNKNOWN') AND amount >= 60000"
    ),
    "queue_formatted": _over(
        """
        SELECT * REPLACE (
          concat('$', format('{:,.2f}', amount)) AS amount,
          printf('%.2f%%', payor_risk_score * 100) AS payor_risk_score,
          printf('%.2f%%', payee_risk_score * 100) AS payee_risk_score)
        FROM review_queue"""
    ),
    "alert_sample": _sample(
        "review_queue", ["transaction_id", "payor_name", "payee_name", "amount", "prediction"], 5
    ),
    "alerts_by_country": _over(
        " SELECT payor_country, count(*) AS alerts FROM review_queue"
        " GROUP BY payor_country ORDER BY alerts DESC, payor_country"
    ),
    "alerts_by_method": _over(
        """
        SELECT payment_method, count(*) AS alerts,
               round(count(*) / (SELECT count(*) FROM review_queue), 9) AS share
        FROM review_queue GROUP BY payment_method"""
    ),
    "country_options": _over(
        " SELECT DISTINCT payor_country FROM review_queue WHERE payor_country IS NOT NULL"
    ),
    "feature_frame": _over(
        """
        SELECT amount, payor_risk_score, payee_risk_score, merchant_mcc, payment_method, currency,
               payor_country, payee_country, payee_category, CAST(is_fraud AS INTEGER) AS is_fraud
        FROM enriched_transactions WHERE is_fraud IS NOT NULL"""
    ),
    "category_index": _over(
        " UNION ALL ".join(
            f"""
            SELECT '{c}' AS feature, {c} AS value,
                   row_number() OVER (ORDER BY count(*) DESC, {c}) - 1 AS position
            FROM enriched_transactions WHERE is_fraud IS NOT NULL GROUP BY {c}"""
            for c in CATEGORICAL_FEATURES
        )
    ),
    "stratified_split": _over(
        """
        SELECT transaction_id, is_fraud,
               CASE WHEN 5 * row_number() OVER (PARTITION BY is_fraud ORDER BY md5(transaction_id))
                         <= 4 * count(*) OVER (PARTITION BY is_fraud)
                    THEN 'train' ELSE 'test' END AS split
        FROM enriched_transactions WHERE is_fraud IS NOT NULL"""
    ),
    "roc_auc": _over(
        " SELECT round(sum((fpr - fpr_before) * (tpr + tpr_before) / 2), 9) AS roc_auc FROM points",
        CURVE,
    ),
    "avg_precision": _over(
        " SELECT round(sum((tpr - tpr_before) * prec), 9) AS average_precision FROM points",
        CURVE,
    ),
    "pr_auc": _over(
        " SELECT round(sum((tpr - tpr_before) * (prec + prec_before) / 2), 9) AS pr_auc FROM points",
        CURVE,
    ),
    "accuracy": _over(
        " SELECT round(avg(CASE WHEN is_fraud = prediction THEN 1.0 ELSE 0.0 END), 9) AS accuracy"
        " FROM scored WHERE is_fraud IS NOT NULL"
    ),
    "classification_report": _over(
        """
        SELECT class, round(precision, 9) AS precision, round(recall, 9) AS recall,
               round(f1_score, 9) AS f1_score, support FROM classes
        UNION ALL
        SELECT 'accuracy', NULL, NULL, round((tp + tn) / (tp + fp + fn + tn), 9),
               tp + fp + fn + tn FROM outcomes
        UNION ALL
        SELECT 'macro avg', round(avg(precision), 9), round(avg(recall), 9),
               round(avg(f1_score), 9), CAST(sum(support) AS BIGINT) FROM classes
        UNION ALL
        SELECT 'weighted avg', round(sum(precision * support) / sum(support), 9),
               round(sum(recall * support) / sum(support), 9),
               round(sum(f1_score * support) / sum(support), 9),
               CAST(sum(support) AS BIGINT) FROM classes""",
        OUTCOMES,
    ),
    "roc_curve": _over(
        """
        SELECT CAST(g.point AS BIGINT) AS point, round(g.point / 99, 9) AS fpr,
               round(coalesce(max(c.tpr), 0.0), 9) AS tpr, round(min(c.score), 9) AS threshold
        FROM range(100) AS g(point) LEFT JOIN points c ON c.fp * 99 <= g.point * c.negatives
        GROUP BY g.point""",
        CURVE,
    ),
    "stage_counts": _over(
        """
        SELECT (SELECT count(*) FROM raw_transactions) AS raw,
               (SELECT count(*) FROM stg_transactions) AS staging,
               (SELECT count(*) FROM invalid_transactions) AS quarantine,
               (SELECT count(*) FROM enriched_transactions) AS gold"""
    ),
}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)

"""The registered queries as plain SQL for another engine, over the same tables.

Written on their own, with windows and set operations, as a check on the DataFrame code. The raw
tables and the models are common table expressions; each query selects from them.
"""

RAW_TABLES = {
    "raw_customers": """
        SELECT c_custkey AS id,
          CASE c_custkey % 20 WHEN 0 THEN 'PT ' || c_name WHEN 1 THEN 'CV ' || c_name WHEN 2 THEN 'UD ' || c_name
               WHEN 3 THEN 'pt ' || c_name ELSE c_name END AS name,
          CASE c_custkey % 9 WHEN 5 THEN replace(d, '-', '/')
               WHEN 6 THEN substr(d,9,2) || '/' || substr(d,6,2) || '/' || substr(d,1,4)
               WHEN 7 THEN CASE c_custkey % 4 WHEN 0 THEN '1900-01-01' WHEN 1 THEN '2001-02-30' WHEN 2 THEN 'unknown' ELSE '1900/01/01' END
               WHEN 8 THEN NULL ELSE d END AS dob,
          TIMESTAMP '2025-03-01 00:00:00' AS created_at
        FROM (SELECT c_custkey, c_name,
                CAST(DATE '1950-01-01' + CAST(c_custkey * 37 % 18000 AS INT) AS STRING) AS d FROM customer) t""",
    "raw_sales": """
        WITH b AS (SELECT o_orderkey, o_custkey, o_orderdate, CAST(round(o_totalprice * 1000) AS BIGINT) AS p FROM orders),
        s AS (SELECT 'V' || CAST(o_orderkey AS STRING) AS vin, o_custkey AS customer_id,
          CASE o_orderkey % 4 WHEN 0 THEN 'RAIZA' WHEN 1 THEN 'RANGGO' WHEN 2 THEN 'INNAVO' ELSE 'VELOS' END AS model,
          CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS invoice_date,
          CASE WHEN o_orderkey % 101 = 0 THEN 'N/A' ELSE
            CAST(CAST(floor(p / 1000000) AS BIGINT) AS STRING)
            || '.' || lpad(CAST(CAST(floor(p / 1000) AS BIGINT) % 1000 AS STRING), 3, '0')
            || '.' || lpad(CAST(p % 1000 AS STRING), 3, '0') END AS price,
          o_orderdate AS created_at, o_orderkey FROM b)
        SELECT vin, customer_id, model, invoice_date, price, created_at FROM s
        UNION ALL
        SELECT vin || 'R', customer_id, model, invoice_date, price, created_at + INTERVAL '1' HOUR FROM s WHERE o_orderkey % 25 = 0""",
    "raw_after_sales": """
        WITH t AS (SELECT l_orderkey, l_linenumber, min(l_shipdate) AS d FROM lineitem GROUP BY l_orderkey, l_linenumber)
        SELECT 'T' || CAST(t.l_orderkey AS STRING) || '-' || CAST(t.l_linenumber AS STRING) AS service_ticket,
          CASE WHEN t.l_orderkey % 50 = 7 THEN 'X' ELSE 'V' END || CAST(o.o_orderkey AS STRING) AS vin,
          o.o_custkey AS customer_id,
          CASE o.o_orderkey % 4 WHEN 0 THEN 'RAIZA' WHEN 1 THEN 'RANGGO' WHEN 2 THEN 'INNAVO' ELSE 'VELOS' END AS model,
          CAST(t.d AS DATE) AS service_date,
          CASE t.l_linenumber % 3 WHEN 0 THEN 'BP' WHEN 1 THEN 'PM' ELSE 'GR' END AS service_type,
          t.d AS created_at
        FROM t JOIN orders o ON o.o_orderkey = t.l_orderkey - t.l_orderkey % 20""",
    "raw_customer_addresses": """
        SELECT CAST(c_custkey * 3 + k AS STRING) AS id, CAST(c_custkey AS STRING) AS customer_id,
          CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE 'Jl ' || CAST(k AS STRING) || ' No ' || CAST(c_custkey AS STRING) END AS address,
          '  ' || n_name || ' ' AS city, ' ' || r_name || '  ' AS province,
          CAST(DATE '2025-03-01' + CAST(k * 10 AS INT) AS STRING) || ' 14:24:40' AS created_at
        FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
        CROSS JOIN (SELECT 0 AS k UNION ALL SELECT 1 UNION ALL SELECT 2) ks
        WHERE c_custkey % 13 <> 0 AND k <= c_custkey % 3""",
}

# The same with an address for every customer.
EVERY_ADDRESS = RAW_TABLES["raw_customer_addresses"].replace("c_custkey % 13 <> 0 AND ", "")

MODELS = {
    "stg_customers": """
        SELECT id AS customer_id, name AS customer_name,
          coalesce(
            CAST(try_strptime(CASE WHEN regexp_full_match(dob, '[0-9]{4}-[0-9]{2}-[0-9]{2}') THEN dob END, '%Y-%m-%d') AS DATE),
            CAST(try_strptime(CASE WHEN regexp_full_match(dob, '[0-9]{4}/[0-9]{2}/[0-9]{2}') THEN dob END, '%Y/%m/%d') AS DATE),
            CAST(try_strptime(CASE WHEN regexp_full_match(dob, '[0-9]{2}/[0-9]{2}/[0-9]{4}') THEN dob END, '%d/%m/%Y') AS DATE)
          ) AS date_of_birth,
          coalesce(dob, '1900-01-01') = '1900-01-01' AS is_dob_suspect,
          if(dob IS NULL OR coalesce(left(name, 3) IN ('PT ', 'CV ', 'UD '), false), 'corporate', 'individual') AS customer_type,
          created_at
        FROM raw_customers WHERE id IS NOT NULL""",
    "stg_sales": """
        SELECT vin, customer_id, model, invoice_date, TRY_CAST(replace(price, '.', '') AS BIGINT) AS price,
          count(*) OVER same_sale > 1 AS is_duplicate_suspect, created_at
        FROM raw_sales WHERE vin IS NOT NULL
        WINDOW same_sale AS (PARTITION BY customer_id, model, invoice_date)""",
    "stg_after_sales": """
        SELECT service_ticket, vin, customer_id, model, service_date, service_type,
          NOT EXISTS (SELECT 1 FROM raw_sales r WHERE r.vin = t.vin) AS is_vin_not_in_sales,
          coalesce(service_date > DATE '2001-06-01', false) AS is_future_date, created_at
        FROM raw_after_sales t WHERE service_ticket IS NOT NULL""",
    "stg_customer_addresses": """
        SELECT TRY_CAST(id AS BIGINT) AS address_id, TRY_CAST(customer_id AS BIGINT) AS customer_id, address,
          trim(city) AS city, trim(province) AS province, created_at
        FROM raw_customer_addresses
        QUALIFY row_number() OVER (PARTITION BY raw_customer_addresses.customer_id
                                   ORDER BY created_at DESC NULLS LAST, id DESC NULLS LAST) = 1""",
    "int_customer_enriched": """
        SELECT c.customer_id, customer_name, date_of_birth, is_dob_suspect, customer_type, address, city, province,
          ifnull(address || ', ' || city || ', ' || province, 'Alamat tidak tersedia') AS full_address, c.created_at
        FROM stg_customers c LEFT JOIN stg_customer_addresses a ON a.customer_id = c.customer_id""",
    "int_sales_enriched": """
        SELECT s.vin, s.customer_id, c.customer_name, c.customer_type, s.model, s.invoice_date, s.price,
          CASE WHEN s.price BETWEEN 100000000 AND 250000000 THEN 'LOW' WHEN s.price BETWEEN 250000001 AND 400000000 THEN 'MEDIUM'
               WHEN s.price > 400000000 THEN 'HIGH' ELSE 'UNDEFINED' END AS price_class,
          strftime(s.invoice_date, '%Y-%m') AS periode, s.is_duplicate_suspect, s.created_at,
          row_number() OVER (PARTITION BY s.customer_id, s.model, s.invoice_date
                             ORDER BY s.created_at ASC NULLS FIRST, s.vin ASC) = 1 AS is_canonical
        FROM stg_sales s LEFT JOIN stg_customers c ON c.customer_id = s.customer_id
        WHERE s.invoice_date IS NOT NULL""",
    "dim_customer": "SELECT * EXCLUDE (address) FROM int_customer_enriched",
    "dim_vehicle": """
        SELECT *, CASE WHEN avg_price > 400000000 THEN 'HIGH' WHEN avg_price BETWEEN 250000001 AND 400000000 THEN 'MEDIUM'
                       WHEN avg_price BETWEEN 100000000 AND 250000000 THEN 'LOW' ELSE 'UNDEFINED' END AS default_price_class
        FROM (SELECT model, min(price) AS min_price, max(price) AS max_price, avg(price) AS avg_price
              FROM int_sales_enriched WHERE is_canonical GROUP BY model)""",
    "dim_date": """
        SELECT CAST(day AS DATE) AS date_id
        FROM (SELECT unnest(generate_series(DATE '2024-01-01', DATE '2027-12-31', INTERVAL 1 DAY)) AS day)""",
    "dim_service_type": """
        SELECT * FROM (VALUES ('BP', 'Body Paint', 'Perbaikan body dan cat kendaraan'),
          ('PM', 'Periodic Maintenance', 'Servis berkala rutin sesuai jadwal'),
          ('GR', 'General Repair', 'Perbaikan umum di luar jadwal berkala')
        ) v(service_type_code, service_type_name, description)""",
    "fact_sales": """
        SELECT vin, customer_id, model, invoice_date, price, price_class, periode, customer_name, customer_type,
          is_duplicate_suspect, created_at
        FROM int_sales_enriched WHERE is_canonical""",
    "fact_after_sales": """
        SELECT service_ticket, vin, customer_id, model, service_date AS date_id, service_type AS service_type_code,
          is_vin_not_in_sales, is_future_date, created_at
        FROM stg_after_sales""",
    "mart_sales_summary": """
        SELECT periode, price_class AS class, model, CAST(sum(price) AS BIGINT) AS total, count(*) AS total_transactions
        FROM fact_sales GROUP BY ALL""",
    "mart_aftersales_priority": """
        SELECT s.periode, s.vin, c.customer_name, c.full_address AS address, s.count_service,
          CASE WHEN s.count_service > 10 THEN 'HIGH' WHEN s.count_service >= 5 THEN 'MED' ELSE 'LOW' END AS priority
        FROM (SELECT CAST(year(date_id) AS BIGINT) AS periode, vin, customer_id, count(service_ticket) AS count_service
              FROM fact_after_sales WHERE NOT (is_vin_not_in_sales OR is_future_date) GROUP BY ALL) s
        LEFT JOIN dim_customer c ON c.customer_id = s.customer_id""",
}

CHECKED = {
    "unique": [
        ("raw_customers", "id"), ("raw_sales", "vin"), ("raw_after_sales", "service_ticket"),
        ("stg_customers", "customer_id"), ("stg_sales", "vin"), ("stg_after_sales", "service_ticket"),
        ("dim_customer", "customer_id"), ("dim_vehicle", "model"), ("dim_date", "date_id"),
        ("dim_service_type", "service_type_code"), ("fact_sales", "vin"), ("fact_after_sales", "service_ticket"),
    ],
    "not_null": [
        ("raw_customers", "id"), ("raw_sales", "vin"), ("raw_after_sales", "service_ticket"),
        ("stg_customers", "customer_id"), ("stg_sales", "vin"), ("stg_sales", "price"),
        ("stg_after_sales", "service_ticket"), ("stg_customer_addresses", "customer_id"),
        ("int_customer_enriched", "customer_id"), ("int_sales_enriched", "vin"),
        ("dim_customer", "customer_id"), ("dim_vehicle", "model"), ("dim_date", "date_id"),
        ("dim_service_type", "service_type_code"), ("fact_sales", "vin"), ("fact_sales", "customer_id"),
        ("fact_sales", "price"), ("fact_after_sales", "service_ticket"), ("mart_sales_summary", "total"),
    ],
    "accepted_values": [
        ("stg_customers", "customer_type", "'individual', 'corporate'"),
        ("int_sales_enriched", "price_class", "'LOW', 'MEDIUM', 'HIGH', 'UNDEFINED'"),
        ("mart_aftersales_priority", "priority", "'HIGH', 'MED', 'LOW'"),
    ],
}

INVALID = "(is_vin_not_in_sales OR is_future_date)"


def _with_models(select: str) -> str:
    tables = {**RAW_TABLES, **MODELS}
    return "WITH " + ",\n".join(f"{name} AS ({sql})" for name, sql in tables.items()) + "\n" + select


def _failures(name: str, offenders: str, number: str = "count(*)") -> str:
    return f"SELECT '{name}' AS check_name, CAST(coalesce({number}, 0) AS BIGINT) AS failures FROM ({offenders})"


def _unique() -> str:
    return " UNION ALL ".join(
        _failures(f"unique_{t}_{c}", f"SELECT {c} FROM {t} WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1")
        for t, c in CHECKED["unique"]
    )


def _not_null() -> str:
    return " UNION ALL ".join(
        _failures(f"not_null_{t}_{c}", f"SELECT {c} FROM {t} WHERE {c} IS NULL") for t, c in CHECKED["not_null"]
    )


def _accepted_values() -> str:
    return " UNION ALL ".join(
        _failures(f"accepted_values_{t}_{c}", f"SELECT DISTINCT {c} FROM {t} WHERE {c} NOT IN ({values})")
        for t, c, values in CHECKED["accepted_values"]
    )


def _flag_rates() -> str:
    flags = [
        ("stg_customers", "is_dob_suspect"), ("stg_sales", "is_duplicate_suspect"),
        ("stg_after_sales", "is_vin_not_in_sales"), ("stg_after_sales", "is_future_date"),
    ]
    return " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS n_rows, '{f}' AS flag, count(*) FILTER ({f}) AS flagged, "
        f"avg(CAST({f} AS INT)) AS share FROM {t}"
        for t, f in flags
    )


def _titled(odd: str, even: str) -> str:
    """Title case of one text for odd ids and of another for even ids."""
    text = f"lower(trim(CASE WHEN CAST(id AS BIGINT) % 2 = 1 THEN {odd} ELSE {even} END))"
    runs = rf"regexp_extract_all({text}, '\p{{L}}+|[^\p{{L}}]+')"
    return f"array_to_string(list_transform({runs}, lambda run: upper(run[1]) || run[2:]), '')"


SELECTS = {
    **{f"q_{name}": f"SELECT * FROM {name}" for name in MODELS if name not in ("dim_date", "dim_service_type")},
    "q_dim_date": """
        SELECT d AS date_id, year(d) AS year, month(d) AS month, quarter(d) AS quarter, strftime(d, '%Y-%m') AS year_month,
          monthname(d) AS month_name, dayname(d) AS day_name, dayofweek(d) + 1 AS day_of_week, dayofweek(d) IN (0, 6) AS is_weekend
        FROM (SELECT CAST(unnest(generate_series(min(invoice_date), max(invoice_date), INTERVAL 1 DAY)) AS DATE) AS d FROM stg_sales)""",
    "q_dim_service_type": """
        SELECT service_type_code, service_type_name, description,
          (SELECT count(*) FROM fact_after_sales f WHERE f.service_type_code = d.service_type_code) AS n_tickets
        FROM dim_service_type d""",
    "q_mart_sales_summary": "SELECT * FROM mart_sales_summary ORDER BY periode, class, model",
    "q_mart_aftersales_priority": """
        SELECT * FROM mart_aftersales_priority ORDER BY periode NULLS FIRST, count_service DESC, vin, customer_name""",
    "q_dq_unique": _unique(),
    "q_dq_not_null": _not_null(),
    "q_dq_accepted_values": _accepted_values(),
    "q_dq_relationships": _failures(
        "relationships_fact_sales_customer_id",
        "SELECT 1 FROM fact_sales f WHERE customer_id IS NOT NULL "
        "AND NOT EXISTS (SELECT 1 FROM dim_customer d WHERE d.customer_id = f.customer_id)",
    ),
    "q_dq_revenue": _failures("revenue_non_negative", "SELECT 1 FROM fact_sales WHERE price < 0"),
    "q_dq_serving_inner": _failures(
        "serving_without_invalid_pairs",
        f"SELECT m.vin FROM mart_aftersales_priority m JOIN (FROM fact_after_sales WHERE {INVALID}) f USING (vin)",
    ),
    "q_dq_serving_exists": _failures(
        "serving_without_invalid_rows",
        f"SELECT 1 FROM mart_aftersales_priority WHERE vin IN (SELECT vin FROM fact_after_sales WHERE {INVALID})",
    ),
    "q_dq_flag_rates": _flag_rates(),
    "q_dq_readiness": " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS n_rows, count(*) > 0 AS is_ready FROM {name}" for name in RAW_TABLES
    ),
    "q_dq_missing_price_rows": "SELECT * FROM stg_sales WHERE price IS NULL",
    "q_dq_serving_inner_rows": f"""
        SELECT vin, count(*) AS n_rows
        FROM mart_aftersales_priority JOIN (SELECT vin FROM fact_after_sales WHERE {INVALID}) USING (vin) GROUP BY vin""",
    "q_dq_serving_exists_rows": f"""
        SELECT * FROM mart_aftersales_priority WHERE vin IN (SELECT vin FROM fact_after_sales WHERE {INVALID})""",
    "q_addr_title_case": f"""
        SELECT id, {_titled("upper(city)", "' rt/rw ' || lower(city)")} AS city,
          {_titled("'o''neil-' || lower(province)", "NULL")} AS province
        FROM ({EVERY_ADDRESS})""",
    "q_landing_timestamps": """
        SELECT o_orderkey, CASE WHEN o_orderkey % 13 IN (0, 2, 3, 4, 9, 11) THEN date_trunc('second', o_orderdate)
            WHEN o_orderkey % 13 = 6 AND day(o_orderdate) <= 12 THEN make_timestamp(year(o_orderdate), day(o_orderdate), month(o_orderdate),
                hour(o_orderdate), minute(o_orderdate), 0)
            WHEN o_orderkey % 13 IN (6, 7) THEN date_trunc('minute', o_orderdate)
            WHEN o_orderkey % 13 IN (1, 8, 10) THEN date_trunc('day', o_orderdate) END AS created_at, CAST(o_orderdate AS DATE) AS day
        FROM orders""",
    "q_landing_pending_files": """
        SELECT d AS day, n AS n_rows, 'customer_addresses_' || strftime(d, '%Y%m%d') || '.csv' AS source_file
        FROM (SELECT CAST(o_orderdate AS DATE) AS d, count(*) AS n FROM orders GROUP BY 1)
        WHERE day(d) <> 1 AND NOT (day(d) % 2 = 0 AND day(d) <> 2 AND month(d) % 3 <> 0)""",
}

ORACLE_SQL = {name: _with_models(select) for name, select in SELECTS.items()}

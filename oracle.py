"""SQL statements of every query for an independent engine (DuckDB).

Each statement is self-contained: the chain from the supplied tables to the star
schema is spelled out as common table expressions and a query takes what it
needs of it. The package never reads this file.
"""

# The raw lines; see tillstar/sources/feed.py.
FEED = """
base AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_returnflag, o_custkey, o_orderdate,
         p_name, p_type, p_retailprice, n_nationkey,
         (l_returnflag = 'R' AND l_orderkey % 10 = 0) OR o_custkey % 103 = 0 AS returned
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  JOIN part ON l_partkey = p_partkey
),
once AS (
  SELECT * FROM base
  UNION ALL
  SELECT * FROM base WHERE (l_orderkey * 7 + l_linenumber) % 53 = 0
),
feed AS (
  SELECT
    CASE WHEN returned THEN 'C' ELSE '' END || CAST(l_orderkey AS VARCHAR) AS invoice_no,
    'P' || CAST(l_partkey AS VARCHAR) AS stock_code,
    CASE WHEN l_partkey % 50 = 0 THEN NULL
         WHEN l_partkey % 7 = 0 THEN p_name
         WHEN l_orderkey % 13 = 0 THEN p_name || ' SET OF ' || p_type
         ELSE p_type || ' ' || p_name END AS description,
    CAST(CASE WHEN returned THEN -l_quantity
              WHEN l_orderkey % 997 = 0 THEN l_quantity * 100
              ELSE l_quantity END AS INTEGER) AS quantity,
    CASE WHEN l_orderkey % 211 = 0 THEN 'not-a-date'
         ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS invoice_date,
    CASE WHEN l_orderkey % 89 = 0 THEN NULL
         ELSE CAST(round(p_retailprice, 2) AS DECIMAL(18,4)) END AS unit_price,
    CASE WHEN o_custkey % 101 = 0 THEN NULL ELSE CAST(o_custkey AS VARCHAR) END AS customer_id,
    CASE n_nationkey
      WHEN 0 THEN 'United Kingdom' WHEN 1 THEN 'Germany' WHEN 2 THEN 'France' WHEN 3 THEN 'EIRE'
      WHEN 4 THEN 'Spain' WHEN 5 THEN 'Netherlands' WHEN 6 THEN 'Belgium' WHEN 7 THEN 'Switzerland'
      WHEN 8 THEN 'Portugal' WHEN 9 THEN 'Australia' WHEN 10 THEN 'Norway' WHEN 11 THEN 'Italy'
      WHEN 12 THEN 'Channel Islands' WHEN 13 THEN 'Finland' WHEN 14 THEN 'Cyprus'
      WHEN 15 THEN 'Sweden' WHEN 16 THEN 'Austria' WHEN 17 THEN 'Denmark' WHEN 18 THEN 'Japan'
      WHEN 19 THEN 'Poland' WHEN 20 THEN 'United States' WHEN 21 THEN 'Canada'
      WHEN 22 THEN 'Singapore' WHEN 23 THEN 'Unspecified' WHEN 24 THEN 'New Zealand'
    END AS country
  FROM once
)"""

PARSED = """
parsed AS (
  SELECT * REPLACE (try_strptime(invoice_date, '%Y-%m-%d %H:%M:%S') AS invoice_date) FROM feed
)"""

FILLED = """
medians AS (
  SELECT quantile_cont(CAST(quantity AS DOUBLE), 0.5) AS quantity,
         quantile_cont(CAST(unit_price AS DOUBLE), 0.5) AS unit_price
  FROM parsed
),
filled AS (
  SELECT coalesce(invoice_no, 'Unknown') AS invoice_no,
         coalesce(stock_code, 'Unknown') AS stock_code,
         coalesce(description, 'Unknown') AS description,
         coalesce(quantity, CAST(round((SELECT quantity FROM medians)) AS INTEGER)) AS quantity,
         invoice_date,
         coalesce(unit_price, CAST((SELECT unit_price FROM medians) AS DECIMAL(18,4))) AS unit_price,
         coalesce(customer_id, 'Unknown') AS customer_id,
         coalesce(country, 'Unknown') AS country
  FROM parsed
)"""

UNIQUE = """
uniq AS (SELECT DISTINCT * FROM filled)"""

BOUNDS = """
quartiles AS (
  SELECT 'quantity' AS column_name,
         quantile_cont(CAST(quantity AS DOUBLE), 0.25) AS q1,
         quantile_cont(CAST(quantity AS DOUBLE), 0.75) AS q3 FROM uniq
  UNION ALL
  SELECT 'unit_price',
         quantile_cont(CAST(unit_price AS DOUBLE), 0.25),
         quantile_cont(CAST(unit_price AS DOUBLE), 0.75) FROM uniq
),
bounds AS (
  SELECT column_name, q1, q3,
         q1 - 1.5 * (q3 - q1) AS lower_bound, q3 + 1.5 * (q3 - q1) AS upper_bound
  FROM quartiles
)"""

CLEAN = """
clean AS (
  SELECT u.*,
         CASE WHEN CAST(u.quantity AS DOUBLE) < bq.lower_bound
                OR CAST(u.quantity AS DOUBLE) > bq.upper_bound
                OR CAST(u.unit_price AS DOUBLE) < bp.lower_bound
                OR CAST(u.unit_price AS DOUBLE) > bp.upper_bound THEN 0 ELSE 1 END AS is_valid,
         TIMESTAMP '2024-01-01 00:00:00' AS created_at
  FROM uniq u
  JOIN bounds bq ON bq.column_name = 'quantity'
  JOIN bounds bp ON bp.column_name = 'unit_price'
)"""

AMOUNTS = """
amounts AS (
  SELECT *, CAST(quantity * unit_price AS DECIMAL(29,4)) AS total_amount FROM clean
)"""

SEGMENTS = """
totals AS (
  SELECT customer_id, coalesce(sum(total_amount), 0) AS total_sales, count(*) AS n
  FROM amounts WHERE customer_id IS NOT NULL GROUP BY customer_id
),
cuts AS (
  SELECT quantile_cont(CAST(total_sales AS DOUBLE), 0.33) AS q33,
         quantile_cont(CAST(total_sales AS DOUBLE), 0.67) AS q67 FROM totals
),
segments AS (
  SELECT customer_id, total_sales,
         CASE WHEN total_sales <= 0 THEN NULL
              WHEN CAST(total_sales AS DOUBLE) <= q33 THEN 'Low'
              WHEN CAST(total_sales AS DOUBLE) <= q67 THEN 'Medium'
              ELSE 'High' END AS customer_segment
  FROM totals, cuts
)"""

# Fixed values below: shape and default of a product category.
PROCESSED = """
proc AS (
  SELECT a.*,
         CAST(year(invoice_date) AS INTEGER) AS invoice_year,
         CAST(month(invoice_date) AS INTEGER) AS invoice_month,
         CAST(day(invoice_date) AS INTEGER) AS invoice_day,
         CAST(isodow(invoice_date) - 1 AS INTEGER) AS invoice_day_of_week,
         CAST(quarter(invoice_date) AS INTEGER) AS invoice_quarter,
         s.customer_segment,
         coalesce(nullif(regexp_extract(description, '([A-Z]{2,})', 1), ''), 'OTHER') AS product_category,
         CAST(sum(total_amount) OVER w AS DOUBLE) / nullif(count(total_amount) OVER w, 0)
           AS rolling_7d_sales
  FROM amounts a LEFT JOIN segments s ON a.customer_id = s.customer_id
  WINDOW w AS (PARTITION BY country
               ORDER BY invoice_date NULLS LAST, invoice_no, stock_code, description, quantity,
                        unit_price, a.customer_id
               ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)
)"""

# Fixed values below: names and words of the regions.
DIMS = """
dim_customer AS (
  SELECT customer_id, customer_segment, country,
         TIMESTAMP '2024-01-01 00:00:00' AS created_at, TIMESTAMP '2024-01-01 00:00:00' AS updated_at
  FROM (SELECT *, row_number() OVER (PARTITION BY customer_id
                                     ORDER BY invoice_date NULLS LAST, country) AS rn
        FROM proc WHERE customer_id IS NOT NULL)
  WHERE rn = 1
),
dim_date AS (
  SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_id, d AS date,
         CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month,
         CAST(day(d) AS INTEGER) AS day, CAST(quarter(d) AS INTEGER) AS quarter,
         CAST(isodow(d) - 1 AS INTEGER) AS day_of_week,
         strftime(d, '%A') AS day_name, strftime(d, '%B') AS month_name,
         CASE WHEN isodow(d) >= 6 THEN 1 ELSE 0 END AS is_weekend,
         TIMESTAMP '2024-01-01 00:00:00' AS created_at
  FROM (SELECT DISTINCT CAST(invoice_date AS DATE) AS d FROM proc WHERE invoice_date IS NOT NULL)
),
dim_product AS (
  SELECT stock_code AS product_id, stock_code, description, product_category,
         TIMESTAMP '2024-01-01 00:00:00' AS created_at
  FROM (SELECT *, row_number() OVER (PARTITION BY stock_code
                                     ORDER BY invoice_date NULLS LAST, description) AS rn
        FROM proc WHERE stock_code IS NOT NULL)
  WHERE rn = 1
),
dim_country AS (
  SELECT CAST(row_number() OVER (ORDER BY country) AS INTEGER) AS country_id,
         country AS country_name,
         CASE
           WHEN lower(country) LIKE '%united kingdom%' OR lower(country) LIKE '%germany%'
             OR lower(country) LIKE '%france%' OR lower(country) LIKE '%italy%'
             OR lower(country) LIKE '%spain%' OR lower(country) LIKE '%netherlands%'
             OR lower(country) LIKE '%belgium%' OR lower(country) LIKE '%switzerland%'
             OR lower(country) LIKE '%austria%' OR lower(country) LIKE '%sweden%'
             OR lower(country) LIKE '%norway%' OR lower(country) LIKE '%denmark%'
             OR lower(country) LIKE '%finland%' THEN 'Europe'
           WHEN lower(country) LIKE '%united states%' OR lower(country) LIKE '%canada%'
             OR lower(country) LIKE '%mexico%' THEN 'North America'
           WHEN lower(country) LIKE '%japan%' OR lower(country) LIKE '%china%'
             OR lower(country) LIKE '%india%' OR lower(country) LIKE '%singapore%'
             OR lower(country) LIKE '%south korea%' OR lower(country) LIKE '%thailand%'
             OR lower(country) LIKE '%malaysia%' THEN 'Asia'
           WHEN lower(country) LIKE '%australia%' OR lower(country) LIKE '%new zealand%' THEN 'Oceania'
           ELSE 'Other' END AS region,
         TIMESTAMP '2024-01-01 00:00:00' AS created_at, TIMESTAMP '2024-01-01 00:00:00' AS updated_at
  FROM (SELECT DISTINCT country FROM proc WHERE country IS NOT NULL)
)"""

FACTS = """
fact_sales AS (
  SELECT c.customer_id, d.date_id, p.product_id, k.country_id, quantity, unit_price, total_amount,
         invoice_no, rolling_7d_sales, is_valid, TIMESTAMP '2024-01-01 00:00:00' AS created_at,
         -- The order of facts.
         proc.invoice_date, proc.stock_code, proc.description, proc.country
  FROM proc
  JOIN dim_customer c ON proc.customer_id = c.customer_id AND c.customer_id <> ''
  JOIN dim_date d ON CAST(proc.invoice_date AS DATE) = d.date
  JOIN dim_product p ON proc.stock_code = p.product_id AND p.product_id <> ''
  JOIN dim_country k ON proc.country = k.country_name
)"""

# Two loads: undated lines and those from a date on, then a day later the older ones, in
# which some customers have another country.
LOADS = """
early AS (SELECT * REPLACE (CASE WHEN customer_id LIKE '%7' THEN 'Old ' || country ELSE country END AS country)
          FROM proc WHERE invoice_date < TIMESTAMP '1995-06-01 00:00:00'),
late AS (SELECT * FROM proc WHERE invoice_date >= TIMESTAMP '1995-06-01 00:00:00' OR invoice_date IS NULL),
every AS (SELECT * FROM late UNION ALL SELECT * FROM early)"""
_FIRST_LOAD, _SECOND_LOAD = "TIMESTAMP '2024-01-01 00:00:00'", "TIMESTAMP '2024-01-02 00:00:00'"

_TO_PARSED = [FEED, PARSED]
_TO_FILLED = [*_TO_PARSED, FILLED]
_TO_UNIQUE = [*_TO_FILLED, UNIQUE]
_TO_BOUNDS = [*_TO_UNIQUE, BOUNDS]
_TO_CLEAN = [*_TO_BOUNDS, CLEAN]
_TO_AMOUNTS = [*_TO_CLEAN, AMOUNTS]
_TO_SEGMENTS = [*_TO_AMOUNTS, SEGMENTS]
_TO_PROCESSED = [*_TO_SEGMENTS, PROCESSED]
_TO_DIMS = [*_TO_PROCESSED, DIMS]
_TO_FACTS = [*_TO_DIMS, FACTS]

_LINE = "invoice_no, stock_code, description, quantity, invoice_date, CAST(unit_price AS DOUBLE) AS unit_price, customer_id, country"
_DATE_PARTS = ", ".join(
    f"CAST(invoice_{p} AS DOUBLE) AS invoice_{p}"
    for p in ("year", "month", "day", "day_of_week", "quarter")
)
_FACT = """customer_id, date_id, product_id, country_id, quantity,
           CAST(unit_price AS DOUBLE) AS unit_price, CAST(total_amount AS DOUBLE) AS total_amount,
           invoice_no, round(rolling_7d_sales, 6) AS rolling_7d_sales, is_valid, created_at"""


# Columns and types of the processed lines.
_PROCESSED_TYPES = (
    ("invoice_no", "string"), ("stock_code", "string"), ("description", "string"), ("quantity", "int"),
    ("invoice_date", "timestamp_ntz"), ("unit_price", "decimal(18,4)"), ("customer_id", "string"),
    ("country", "string"), ("is_valid", "int"), ("created_at", "timestamp_ntz"),
    ("total_amount", "decimal(29,4)"), ("invoice_year", "int"), ("invoice_month", "int"),
    ("invoice_day", "int"), ("invoice_day_of_week", "int"), ("invoice_quarter", "int"),
    ("customer_segment", "string"), ("product_category", "string"), ("rolling_7d_sales", "double"),
)


def _sql(ctes: list[str], select: str) -> str:
    return "WITH " + ",".join(ctes) + "\n" + select


def _pct(part: str, total: str = "count(*)") -> str:
    return (
        f"CASE WHEN {total} > 0 THEN round(CAST({part} AS DOUBLE) / {total} * 100, 2) ELSE 0.0 END"
    )


def _sales(column: str = "total_amount") -> str:
    return f"CAST(coalesce(sum({column}), 0) AS DOUBLE)"


_MEAN_PRICE = "round(coalesce(CAST(sum(unit_price) AS DOUBLE) / nullif(count(unit_price), 0), 0), 6)"

_BY_COUNTRY = f"""
SELECT country_name, count(*) AS {{count}}, {_sales()} AS total_sales, {_MEAN_PRICE} AS avg_unit_price
FROM fact_sales fs JOIN dim_country dc ON fs.country_id = dc.country_id
WHERE fs.is_valid = 1 GROUP BY country_name
ORDER BY total_sales DESC, country_name LIMIT 10"""

_COMPLETENESS = f"""
SELECT count(*) AS total_rows,
  count(CASE WHEN country IS NULL THEN 1 END) AS missing_country,
  count(CASE WHEN invoice_date IS NULL THEN 1 END) AS missing_date,
  count(CASE WHEN customer_id IS NULL THEN 1 END) AS missing_customer_id,
  count(CASE WHEN stock_code IS NULL THEN 1 END) AS missing_stock_code,
  count(CASE WHEN total_amount IS NULL THEN 1 END) AS missing_total_amount,
  {_pct("count(CASE WHEN country IS NULL THEN 1 END)")} AS missing_country_pct,
  {_pct("count(CASE WHEN invoice_date IS NULL THEN 1 END)")} AS missing_date_pct,
  {_pct("count(CASE WHEN customer_id IS NULL THEN 1 END)")} AS missing_customer_id_pct,
  {_pct("count(CASE WHEN stock_code IS NULL THEN 1 END)")} AS missing_stock_code_pct,
  {_pct("count(CASE WHEN total_amount IS NULL THEN 1 END)")} AS missing_total_amount_pct
FROM {{table}}"""

_CONSISTENCY = f"""
SELECT count(*) AS total_facts,
  count(CASE WHEN total_amount < 0 THEN 1 END) AS negative_amounts,
  count(CASE WHEN unit_price < 0 THEN 1 END) AS negative_prices,
  count(CASE WHEN quantity < 0 THEN 1 END) AS negative_quantities,
  {_pct("count(CASE WHEN total_amount < 0 THEN 1 END)")} AS negative_amounts_pct,
  {_pct("count(CASE WHEN unit_price < 0 THEN 1 END)")} AS negative_prices_pct,
  {_pct("count(CASE WHEN quantity < 0 THEN 1 END)")} AS negative_quantities_pct
FROM fact_sales"""

# Raw lines with an amount, where customer ids are still missing.
_RAW_AMOUNTS = """
raw_amounts AS (SELECT *, quantity * unit_price AS total_amount FROM parsed)"""


def _recommendations(table: str) -> str:
    # Advice texts and their limits.
    return f"""
SELECT position, recommendation FROM (
  SELECT 1 AS position,
         'High percentage of missing customer data - consider data source validation' AS recommendation,
         (SELECT {_pct("count(CASE WHEN customer_id IS NULL THEN 1 END)")} > 5 FROM {table}) AS found
  UNION ALL
  SELECT 2, 'Negative amounts found - implement data validation rules',
         (SELECT {_pct("count(CASE WHEN total_amount < 0 THEN 1 END)")} > 0 FROM fact_sales)
  UNION ALL
  SELECT 3, 'Negative prices detected - review data processing logic',
         (SELECT {_pct("count(CASE WHEN unit_price < 0 THEN 1 END)")} > 0 FROM fact_sales))
WHERE found ORDER BY position"""


def _validate_input() -> str:
    columns = [
        ("invoice_no", "string", "categorical"), ("stock_code", "string", "categorical"),
        ("description", "string", "categorical"), ("quantity", "int", "numeric"),
        ("invoice_date", "string", "categorical"), ("unit_price", "decimal(18,4)", "numeric"),
        ("customer_id", "string", "categorical"), ("country", "string", "categorical"),
    ]
    return "\nUNION ALL ".join(
        f"""SELECT (SELECT count(*) FROM feed) AS total_rows,
       (SELECT count(*) FROM feed) - (SELECT count(*) FROM (SELECT DISTINCT * FROM feed)) AS duplicates,
       {i} AS position, '{name}' AS column_name, '{kind}' AS data_type, '{group}' AS kind,
       (SELECT count(*) FROM feed WHERE {name} IS NULL) AS missing_values"""
        for i, (name, kind, group) in enumerate(columns)
    )


def _numeric_summary() -> str:
    numbers = [
        "quantity", "unit_price", "is_valid", "total_amount", "invoice_year", "invoice_month",
        "invoice_day", "invoice_day_of_week", "invoice_quarter", "rolling_7d_sales",
    ]
    exprs = [(n, f"CAST({n} AS DOUBLE)", True) for n in numbers]
    exprs += [(n, f"CAST(epoch({n}) AS DOUBLE)", False) for n in ("invoice_date", "created_at")]
    return "\nUNION ALL ".join(
        f"""SELECT '{name}' AS column_name, count(v) AS count, round(avg(v), 6) AS mean,
       {"round(stddev_samp(v), 6)" if std else "CAST(NULL AS DOUBLE)"} AS std,
       round(min(v), 6) AS min, round(quantile_cont(v, 0.25), 6) AS q25,
       round(quantile_cont(v, 0.5), 6) AS q50, round(quantile_cont(v, 0.75), 6) AS q75,
       round(max(v), 6) AS max
FROM (SELECT {expr} AS v FROM proc)"""
        for name, expr, std in exprs
    )


def _categorical_summary() -> str:
    columns = [
        "invoice_no", "stock_code", "description", "customer_id", "country", "customer_segment",
        "product_category",
    ]
    return "\nUNION ALL ".join(
        f"""SELECT '{c}' AS column_name, {c} AS value, count(*) AS count
FROM proc WHERE {c} IS NOT NULL GROUP BY {c}"""
        for c in columns
    )


def _star_stats() -> str:
    return """
SELECT 'dim_customer_count' AS stat, count(*) AS value FROM dim_customer
UNION ALL SELECT 'dim_date_count', count(*) FROM dim_date
UNION ALL SELECT 'dim_product_count', count(*) FROM dim_product
UNION ALL SELECT 'dim_country_count', count(*) FROM dim_country
UNION ALL SELECT 'fact_sales_count', count(*) FROM fact_sales
UNION ALL SELECT 'valid_facts_count', count(*) FROM fact_sales WHERE is_valid = 1
UNION ALL SELECT 'invalid_facts_count', count(*) FROM fact_sales WHERE is_valid = 0"""


def _key_checks() -> str:
    keys = [
        ("dim_customer", "customer_id"), ("dim_date", "date_id"),
        ("dim_product", "product_id"), ("dim_country", "country_id"),
    ]
    parts = [
        f"""SELECT 'primary key' AS "check", '{t}' AS table_name, '{k}' AS column_name,
       CAST(coalesce(sum(n), 0) AS BIGINT) AS violations
FROM (SELECT {k}, count(*) AS n FROM {t} GROUP BY {k} HAVING count(*) > 1 OR {k} IS NULL)"""
        for t, k in keys
    ]
    # The row number of a fact cannot repeat; stated for the shape of the result.
    parts.append("SELECT 'primary key', 'fact_sales', 'fact_id', CAST(0 AS BIGINT)")
    parts += [
        f"""SELECT 'foreign key', 'fact_sales', '{k}', count(*)
FROM fact_sales f WHERE NOT EXISTS (SELECT 1 FROM {t} x WHERE x.{k} = f.{k})"""
        for t, k in keys
    ]
    parts += [
        f"SELECT 'not null', '{t}', '{c}', count(*) FROM {t} WHERE {c} IS NULL"
        for t, c in (("dim_date", "date"), ("dim_country", "country_name"))
    ]
    return "\nUNION ALL ".join(parts)


def _loaded(key: str, attributes: list[str], has_update: bool) -> str:
    """A dimension after both loads: the earliest values of all lines, and when they came."""
    names = ", ".join(attributes)

    def earliest(lines: str) -> str:
        order = ", ".join(f"{a} NULLS FIRST" for a in attributes)
        return f"""(SELECT {key}, {names} FROM (SELECT *, row_number() OVER (
            PARTITION BY {key} ORDER BY invoice_date NULLS LAST, {order}) AS rn FROM {lines} WHERE {key} IS NOT NULL)
            WHERE rn = 1)"""

    same = " AND ".join(f"a.{x} IS NOT DISTINCT FROM b.{x}" for x in attributes)
    kept = f"CASE WHEN b.{key} IS NULL THEN {_SECOND_LOAD} ELSE {_FIRST_LOAD} END AS created_at"
    updated = f", CASE WHEN b.{key} IS NOT NULL AND {same} THEN {_FIRST_LOAD} ELSE {_SECOND_LOAD} END AS updated_at"
    return f"""SELECT a.*, {kept}{updated if has_update else ""}
FROM {earliest("every")} a LEFT JOIN {earliest("late")} b USING ({key})"""


def statements() -> dict[str, str]:
    """Query name -> SQL."""
    return {
        # Sources and layers
        "scan_raw": _sql([FEED], f"SELECT {_LINE} FROM feed"),
        "scan_raw_quoted": _sql(
            [FEED],
            """SELECT invoice_no, stock_code,
       description || chr(10) || '"quoted", ' || stock_code AS description, quantity, invoice_date,
       CAST(unit_price AS DOUBLE) AS unit_price, coalesce(customer_id, '  ') AS customer_id,
       ' ' || country || ' ' AS country FROM feed""",
        ),
        "layer_tables": _sql(
            _TO_FACTS,
            " UNION ALL ".join(
                f"SELECT '{layer}' AS layer, '{table}' AS table_name, count(*) AS n FROM {source}"
                for layer, table, source in (
                    ("raw", "raw_data", "feed"),
                    ("processed", "processed_data", "proc"),
                    *[
                        ("warehouse", t, t)
                        for t in ("dim_country", "dim_customer", "dim_date", "dim_product", "fact_sales")
                    ],
                )
            ),
        ),
        "layer_roundtrip": _sql([FEED], f"SELECT {_LINE} FROM feed"),
        "layer_append": _sql(
            [FEED], f"SELECT {_LINE} FROM feed UNION ALL SELECT {_LINE} FROM feed"
        ),
        # Cleaning
        **{
            key: _sql(_TO_PARSED, f"SELECT {_LINE} FROM parsed")
            for key in ("clean_parse_dates", "clean_parse_dates_typed", "clean_parse_dates_us")
        },
        "clean_impute_numeric": _sql(
            _TO_FILLED,
            """SELECT invoice_no, stock_code, description,
       coalesce(quantity, CAST(round((SELECT quantity FROM medians)) AS INTEGER)) AS quantity,
       invoice_date,
       CAST(coalesce(unit_price, CAST((SELECT unit_price FROM medians) AS DECIMAL(18,4))) AS DOUBLE)
         AS unit_price,
       customer_id, country FROM parsed""",
        ),
        "clean_impute_string": _sql(
            _TO_PARSED,
            """SELECT coalesce(invoice_no, 'Unknown') AS invoice_no,
       coalesce(stock_code, 'Unknown') AS stock_code, coalesce(description, 'Unknown') AS description,
       quantity, invoice_date, CAST(unit_price AS DOUBLE) AS unit_price,
       coalesce(customer_id, 'Unknown') AS customer_id, coalesce(country, 'Unknown') AS country
FROM parsed""",
        ),
        "clean_dedupe": _sql(_TO_UNIQUE, f"SELECT {_LINE} FROM uniq"),
        "outlier_bounds": _sql(
            _TO_BOUNDS,
            """SELECT column_name, round(q1, 6) AS q1, round(q3, 6) AS q3,
       round(lower_bound, 6) AS lower_bound, round(upper_bound, 6) AS upper_bound FROM bounds""",
        ),
        "flag_outliers": _sql(_TO_CLEAN, f"SELECT {_LINE}, is_valid FROM clean"),
        # Derived columns
        "derive_amount": _sql(
            _TO_AMOUNTS,
            f"SELECT {_LINE}, CAST(total_amount AS DOUBLE) AS total_amount FROM amounts",
        ),
        "derive_date_parts": _sql(
            _TO_PROCESSED,
            f"SELECT invoice_no, stock_code, invoice_date, {_DATE_PARTS} FROM proc",
        ),
        "derive_product_category": _sql(
            _TO_PROCESSED, "SELECT invoice_no, stock_code, description, product_category FROM proc"
        ),
        "customer_totals": _sql(
            _TO_SEGMENTS,
            "SELECT customer_id, CAST(total_sales AS DOUBLE) AS total_sales, n FROM totals",
        ),
        **{
            key: _sql(_TO_SEGMENTS, "SELECT round(q33, 6) AS q33, round(q67, 6) AS q67 FROM cuts")
            for key in ("segment_cutoffs", "segment_cutoffs_by_range")
        },
        **{
            key: _sql(
                _TO_PROCESSED,
                "SELECT invoice_no, stock_code, customer_id, customer_segment FROM proc",
            )
            for key in ("derive_customer_segment", "derive_customer_segment_spread")
        },
        **{
            key: _sql(
                _TO_PROCESSED,
                """SELECT invoice_no, stock_code, customer_id, country, invoice_date,
       CAST(total_amount AS DOUBLE) AS total_amount,
       round(rolling_7d_sales, 6) AS rolling_7d_sales FROM proc""",
            )
            for key in ("rolling_sales", "rolling_sales_by_range")
        },
        **{
            key: _sql(
                _TO_PROCESSED,
                f"""SELECT {_LINE}, is_valid, created_at, CAST(total_amount AS DOUBLE) AS total_amount,
       {_DATE_PARTS},
       customer_segment, product_category, round(rolling_7d_sales, 6) AS rolling_7d_sales
FROM proc""",
            )
            for key in ("processed_data", "processed_data_by_range")
        },
        "processed_without_price": _sql(
            [
                *_TO_PARSED,
                """
uniq AS (
  SELECT DISTINCT coalesce(invoice_no, 'Unknown') AS invoice_no,
         coalesce(stock_code, 'Unknown') AS stock_code,
         coalesce(description, 'Unknown') AS description,
         coalesce(quantity, CAST(round((SELECT quantile_cont(CAST(quantity AS DOUBLE), 0.5) FROM parsed))
                                 AS INTEGER)) AS quantity,
         invoice_date, coalesce(customer_id, 'Unknown') AS customer_id,
         coalesce(country, 'Unknown') AS country
  FROM parsed
),
fence AS (
  SELECT quantile_cont(CAST(quantity AS DOUBLE), 0.25) AS q1,
         quantile_cont(CAST(quantity AS DOUBLE), 0.75) AS q3 FROM uniq
)""",
            ],
            """SELECT invoice_no, stock_code, description, quantity, invoice_date, customer_id, country,
       CASE WHEN quantity < q1 - 1.5 * (q3 - q1) OR quantity > q3 + 1.5 * (q3 - q1) THEN 0 ELSE 1 END
         AS is_valid,
       TIMESTAMP '2024-01-01 00:00:00' AS created_at,
       CAST(year(invoice_date) AS DOUBLE) AS invoice_year,
       CAST(month(invoice_date) AS DOUBLE) AS invoice_month,
       CAST(day(invoice_date) AS DOUBLE) AS invoice_day,
       CAST(isodow(invoice_date) - 1 AS DOUBLE) AS invoice_day_of_week,
       CAST(quarter(invoice_date) AS DOUBLE) AS invoice_quarter,
       coalesce(nullif(regexp_extract(description, '([A-Z]{2,})', 1), ''), 'OTHER') AS product_category
FROM uniq, fence""",
        ),
        # Star schema
        "dim_customer": _sql(_TO_DIMS, "SELECT * FROM dim_customer"),
        "dim_date": _sql(_TO_DIMS, "SELECT * REPLACE (CAST(date AS VARCHAR) AS date) FROM dim_date"),
        "dim_product": _sql(_TO_DIMS, "SELECT * FROM dim_product"),
        "dim_country": _sql(_TO_DIMS, "SELECT * FROM dim_country"),
        **{
            key: _sql(
                _TO_FACTS,
                f"""SELECT row_number() OVER (ORDER BY invoice_date, invoice_no, stock_code, description,
                              quantity, unit_price, fact_sales.customer_id, country) AS fact_id,
       {_FACT} FROM fact_sales""",
            )
            for key in ("fact_sales", "fact_sales_lookup", "fact_sales_lookup_spread", "load_fact_sales")
        },
        "load_dim_customer": _sql([*_TO_PROCESSED, LOADS], _loaded("customer_id", ["country", "customer_segment"], True)),
        "load_dim_product": _sql(
            [*_TO_PROCESSED, LOADS],
            f"SELECT stock_code AS product_id, * FROM ({_loaded('stock_code', ['description', 'product_category'], False)})",
        ),
        "load_dim_country": _sql(
            [*_TO_PROCESSED, LOADS, DIMS.replace("dim_", "plain_").replace("FROM proc", "FROM every"), f"""
first_names AS (SELECT country, row_number() OVER (ORDER BY country) AS i FROM (SELECT DISTINCT country FROM late)),
new_names AS (SELECT country, row_number() OVER (ORDER BY country) + (SELECT max(i) FROM first_names) AS i
              FROM (SELECT DISTINCT country FROM early WHERE country NOT IN (SELECT country FROM first_names))),
numbered AS (SELECT *, {_FIRST_LOAD} AS loaded FROM first_names UNION ALL SELECT *, {_SECOND_LOAD} FROM new_names)"""],
            """SELECT CAST(i AS INTEGER) AS country_id, country_name, region, loaded AS created_at, loaded AS updated_at
FROM numbered JOIN plain_country ON country = country_name""",
        ),
        "load_dim_date": _sql(
            [*_TO_PROCESSED, LOADS, DIMS],
            f"""SELECT * REPLACE (CAST(date AS VARCHAR) AS date, CASE WHEN date IN (
       SELECT CAST(invoice_date AS DATE) FROM late) THEN {_FIRST_LOAD} ELSE {_SECOND_LOAD} END AS created_at)
FROM dim_date""",
        ),
        "fact_ids": _sql(
            _TO_PROCESSED,
            """SELECT row_number() OVER (ORDER BY invoice_date, invoice_no, stock_code, description,
                                  quantity, unit_price, customer_id, country) AS fact_id,
       invoice_no, stock_code, customer_id, country, CAST(total_amount AS DOUBLE) AS total_amount
FROM proc WHERE invoice_date IS NOT NULL AND customer_id <> '' AND stock_code <> ''
  AND country IS NOT NULL""",
        ),
        "check_keys": _sql(_TO_FACTS, _key_checks()),
        # Profiles and quality
        "validate_input": _sql([FEED], _validate_input()),
        "summary_shape": _sql(
            _TO_PROCESSED,
            """SELECT count(*) AS rows, 19 AS columns,
       'invoice_no,stock_code,description,quantity,invoice_date,unit_price,customer_id,country,'
       || 'is_valid,created_at,total_amount,invoice_year,invoice_month,invoice_day,'
       || 'invoice_day_of_week,invoice_quarter,customer_segment,product_category,rolling_7d_sales'
         AS column_names
FROM proc""",
        ),
        "summary_numeric": _sql(_TO_PROCESSED, _numeric_summary()),
        "summary_top_values": _sql(
            _TO_PROCESSED,
            f"""SELECT column_name, CAST(position AS INTEGER) AS position, value, count FROM (
SELECT *, row_number() OVER (PARTITION BY column_name ORDER BY count DESC, value) AS position
FROM ({_categorical_summary()})) WHERE position <= 10""",
        ),
        "summary_categorical": _sql(_TO_PROCESSED, _categorical_summary()),
        "q_raw_stats": _sql(
            _TO_PARSED,
            """SELECT count(*) AS total_rows, count(DISTINCT country) AS unique_countries,
       count(DISTINCT invoice_date) AS unique_dates, min(invoice_date) AS earliest_date,
       max(invoice_date) AS latest_date, count(DISTINCT customer_id) AS unique_customers,
       count(DISTINCT stock_code) AS unique_products FROM parsed""",
        ),
        "q_processed_stats": _sql(
            _TO_PROCESSED,
            f"""SELECT count(*) AS total_rows,
       count(CASE WHEN is_valid = 1 THEN 1 END) AS valid_rows,
       count(CASE WHEN is_valid = 0 THEN 1 END) AS invalid_rows,
       count(DISTINCT country) AS unique_countries, count(DISTINCT invoice_date) AS unique_dates,
       count(DISTINCT customer_id) AS unique_customers, count(DISTINCT stock_code) AS unique_products,
       {_sales()} AS total_sales, {_MEAN_PRICE} AS avg_unit_price,
       {_pct("count(CASE WHEN is_valid = 1 THEN 1 END)")} AS data_quality_percentage
FROM proc""",
        ),
        # Reports
        "report_summary": _sql(
            _TO_FACTS,
            """SELECT 'Completed' AS pipeline_status, '2024-01-01T00:00:00' AS timestamp,
       'order tables' AS data_source, (SELECT count(*) FROM feed) AS raw_rows,
       (SELECT count(*) FROM proc) AS processed_rows, (SELECT count(*) FROM fact_sales) AS fact_rows""",
        ),
        "report_columns": _sql(
            _TO_PROCESSED,
            " UNION ALL ".join(
                f"SELECT {i} AS position, '{name}' AS column_name, '{kind}' AS data_type, "
                f"count(*) - count({name}) AS missing_values FROM proc"
                for i, (name, kind) in enumerate(_PROCESSED_TYPES)
            ),
        ),
        "report_validation": _sql(_TO_FACTS, _BY_COUNTRY.format(count="records")),
        "report_quality": _sql(
            _TO_PROCESSED,
            "SELECT total_rows, missing_country_pct, missing_date_pct, missing_customer_id_pct, "
            "missing_stock_code_pct, missing_total_amount_pct FROM ("
            + _COMPLETENESS.format(table="proc") + ")",
        ),
        "q_star_stats": _sql(_TO_FACTS, _star_stats()),
        "q_completeness": _sql(_TO_PROCESSED, _COMPLETENESS.format(table="proc")),
        "q_completeness_raw": _sql(
            [*_TO_PARSED, _RAW_AMOUNTS], _COMPLETENESS.format(table="raw_amounts")
        ),
        "q_consistency": _sql(_TO_FACTS, _CONSISTENCY),
        "q_recommendations": _sql(_TO_FACTS, _recommendations("proc")),
        # Sales analysis
        "q_top_countries": _sql(_TO_FACTS, _BY_COUNTRY.format(count="records")),
        "q_total_sales_by_country": _sql(_TO_FACTS, _BY_COUNTRY.format(count="transaction_count")),
        "q_customer_distribution": _sql(
            _TO_FACTS,
            f"""SELECT customer_segment, count(*) AS transaction_count, {_sales()} AS total_sales
FROM fact_sales fs JOIN dim_customer dc ON fs.customer_id = dc.customer_id
WHERE fs.is_valid = 1 GROUP BY customer_segment ORDER BY total_sales DESC, customer_segment""",
        ),
        "q_customer_segment_analysis": _sql(
            _TO_FACTS,
            f"""SELECT customer_segment, count(DISTINCT dc.customer_id) AS unique_customers,
       count(*) AS total_transactions, {_sales()} AS total_sales,
       round(CAST(sum(total_amount) AS DOUBLE) / nullif(count(total_amount), 0), 6)
         AS avg_transaction_value
FROM fact_sales fs JOIN dim_customer dc ON fs.customer_id = dc.customer_id
WHERE fs.is_valid = 1 GROUP BY customer_segment ORDER BY total_sales DESC, customer_segment""",
        ),
        "q_segment_counts": _sql(
            _TO_FACTS,
            """SELECT customer_segment, count(*) AS transaction_count
FROM fact_sales fs JOIN dim_customer dc ON fs.customer_id = dc.customer_id
WHERE fs.is_valid = 1 GROUP BY customer_segment""",
        ),
        "q_monthly_trends": _sql(
            _TO_FACTS,
            f"""SELECT year, month, month_name, count(*) AS transaction_count,
       {_sales()} AS total_sales, {_MEAN_PRICE} AS avg_unit_price
FROM fact_sales fs JOIN dim_date dd ON fs.date_id = dd.date_id
WHERE fs.is_valid = 1 GROUP BY year, month, month_name ORDER BY year, month""",
        ),
        "q_sales_trends_by_month": _sql(
            _TO_FACTS,
            f"""SELECT year, month_name, count(*) AS transaction_count,
       {_sales()} AS total_sales, {_MEAN_PRICE} AS avg_unit_price
FROM fact_sales fs JOIN dim_date dd ON fs.date_id = dd.date_id
WHERE fs.is_valid = 1 GROUP BY year, month_name ORDER BY year, min(month)""",
        ),
        "q_month_totals": _sql(
            _TO_FACTS,
            f"""SELECT year, month_name, {_sales()} AS monthly_sales
FROM fact_sales fs JOIN dim_date dd ON fs.date_id = dd.date_id
WHERE fs.is_valid = 1 GROUP BY year, month_name""",
        ),
        "q_country_totals": _sql(
            _TO_FACTS,
            f"""SELECT country_name, {_sales()} AS total_sales
FROM fact_sales fs JOIN dim_country dc ON fs.country_id = dc.country_id
WHERE fs.is_valid = 1 GROUP BY country_name ORDER BY total_sales DESC, country_name""",
        ),
        "q_sql_text": _sql(
            _TO_FACTS,
            f"""SELECT region, count(*) AS records, {_sales()} AS total_sales
FROM fact_sales fs JOIN dim_country dc ON fs.country_id = dc.country_id
WHERE fs.is_valid = 1 GROUP BY region""",
        ),
        "q_top_products": _sql(
            _TO_FACTS,
            f"""SELECT dp.stock_code, dp.description, count(*) AS transaction_count,
       {_sales()} AS total_sales, {_MEAN_PRICE} AS avg_unit_price
FROM fact_sales fs JOIN dim_product dp ON fs.product_id = dp.product_id
WHERE fs.is_valid = 1 GROUP BY dp.stock_code, dp.description
ORDER BY total_sales DESC, dp.stock_code, dp.description LIMIT 10""",
        ),
    }

"""The stand-in tables F1–F11 as DuckDB common table expressions, so each
oracle query rebuilds exactly the rows the Spark fixtures produce."""

from __future__ import annotations

M_COUNTS = ",\n    ".join(f"count(*) FILTER (WHERE part = {k}) AS m{k}" for k in range(1, 14))
M_COALESCE = ", ".join(f"coalesce(mc.m{k}, 0) AS m{k}" for k in range(1, 14))

# Fixed value: the Keras tokenizer's default filter characters (see
# tessera.functions.text.TOKEN_FILTERS); single quotes doubled for SQL.
_FILTERS_SQL = '!"#$%&()*+,-./:;<=>?@[\\]^_`{|}~' + "\t\n"

CTE = {
    "tx": """tx AS (
  SELECT c.c_custkey AS customer_id, o.o_orderkey AS invoice_no, l.l_partkey AS stock_code,
         o.o_orderdate AS invoice_ts, n.n_name AS country, l.l_quantity AS quantity
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey)""",
    "ratings": """ratings AS (
  SELECT CAST(customer_id AS VARCHAR) AS user_id, CAST(stock_code AS VARCHAR) AS item_id,
         sum(quantity) AS rating,
         CASE WHEN (customer_id + stock_code) % 11 = 0 THEN CAST('NaN' AS DOUBLE)
              ELSE CAST((customer_id * 7 + stock_code * 13) % 101 AS DOUBLE) / 100 END AS prediction
  FROM tx GROUP BY customer_id, stock_code)""",
    "loans": f"""first2 AS (
  SELECT o_custkey, o_orderdate, o_orderpriority, o_totalprice,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn
  FROM orders),
order_summary AS (
  SELECT o_custkey,
         max(CASE WHEN rn = 1 THEN o_orderpriority END) AS loan_purpose,
         max(CASE WHEN rn = 1 THEN o_orderdate END) AS origination_date,
         max(CASE WHEN rn = 2 THEN o_orderdate END) AS first_payment_date,
         max(CASE WHEN rn = 1 THEN o_totalprice END) / 1000.0 AS loan_to_value
  FROM first2 WHERE rn <= 2 GROUP BY o_custkey),
marks AS (
  SELECT o.o_custkey,
         CAST(floor(((year(o.o_orderdate) - 1995) * 12 + month(o.o_orderdate) - 1) * 13 / 80) AS INTEGER) + 1 AS part
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  WHERE l.l_returnflag = 'R' AND l.l_linestatus = 'F' AND l.l_quantity > 45),
month_counts AS (
  SELECT o_custkey,
    {M_COUNTS}
  FROM marks GROUP BY o_custkey),
loans AS (
  SELECT c.c_custkey AS loan_id, c.c_mktsegment AS source, n.n_name AS financial_institution,
         s.loan_purpose, r.r_name AS insurance_type, s.origination_date, s.first_payment_date,
         c.c_acctbal AS unpaid_principal_bal, s.loan_to_value, {M_COALESCE}
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
  LEFT JOIN order_summary s ON s.o_custkey = c.c_custkey
  LEFT JOIN month_counts mc ON mc.o_custkey = c.c_custkey)""",
    "attrition": """attrition AS (
  SELECT o.o_orderkey AS emp_id,
         CASE WHEN o.o_orderstatus = 'F' THEN 'Yes' ELSE 'No' END AS attrition,
         CASE WHEN o.o_orderkey % 97 = 0 THEN NULL ELSE o.o_totalprice END AS monthly_income,
         CAST(o.o_custkey % 10 AS INTEGER) AS num_companies_worked,
         CASE WHEN o.o_orderkey % 97 = 0 THEN NULL ELSE c.c_mktsegment END AS business_travel,
         CASE WHEN o.o_orderkey % 97 = 0 THEN NULL ELSE o.o_orderpriority END AS education,
         CAST(o.o_custkey % 40 + 20 AS INTEGER) AS age,
         CAST(year(o.o_orderdate) - 1990 AS INTEGER) AS years_at_company,
         c.c_acctbal AS account_balance
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey)""",
    "hourly": """hourly AS (
  SELECT date_trunc('hour', ts) AS ts, count(*) AS count,
         strftime(date_trunc('hour', ts), '%d-%m-%Y %H:%M') AS datetime_text
  FROM events GROUP BY date_trunc('hour', ts))""",
    "hourly_by_type": """hourly_by_type AS (
  SELECT date_trunc('hour', ts) AS ts, event_type AS series_id, count(*) AS count,
         strftime(date_trunc('hour', ts), '%d-%m-%Y %H:%M') AS datetime_text
  FROM events GROUP BY date_trunc('hour', ts), event_type)""",
    "reviews": """reviews AS (SELECT doc_id, text AS review, lang AS label FROM documents)""",
    "messages": """messages AS (
  SELECT d.doc_id, CASE WHEN l.toxic = 1 THEN 'spam' ELSE 'ham' END AS v1, d.text AS v2
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id)""",
    "binary": """binary_pts AS (
  SELECT vec_id, CAST(embedding[1] AS DOUBLE) AS x1, CAST(embedding[2] AS DOUBLE) AS x2,
         CAST(embedding[3] AS DOUBLE) AS x3, CAST(embedding[4] AS DOUBLE) AS x4, label % 2 AS y
  FROM embeddings)""",
    "parts": """parts AS (
  SELECT p_partkey AS part_id, p_retailprice AS wt, p_size AS mpg, p_type AS gear, p_brand AS cyl
  FROM part)""",
    "points": """points AS (SELECT vec_id, embedding AS features, label FROM embeddings)""",
    "review_tokens": """review_tokens AS (
  SELECT doc_id, label, list_filter(string_split(translate(lower(review), '{f}', '{s}'), ' '),
                                    lambda x: x <> '') AS tokens
  FROM reviews)""".replace("{f}", _FILTERS_SQL.replace("'", "''")).replace("{s}", " " * len(_FILTERS_SQL)),
    "vocab": """vocab AS (
  SELECT word, count(*) AS word_count,
         row_number() OVER (ORDER BY count(*) DESC, word) AS word_index
  FROM (SELECT unnest(tokens) AS word FROM review_tokens) GROUP BY word)""",
    "word_vectors": """word_vectors AS (
  SELECT v.word, e.embedding AS vector
  FROM vocab v JOIN (SELECT embedding, row_number() OVER (ORDER BY vec_id) AS word_index
                     FROM embeddings) e ON v.word_index = e.word_index)""",
}

DEPS = {
    "ratings": ["tx"],
    "review_tokens": ["reviews"],
    "vocab": ["reviews", "review_tokens"],
    "word_vectors": ["reviews", "review_tokens", "vocab"],
}


def with_fixtures(sql: str, *names: str, ctes: list[str] = ()) -> str:
    """Prefix ``sql`` with the CTEs it uses (dependencies first), then any
    query-specific ``ctes``."""
    order: list[str] = []
    for n in names:
        for d in DEPS.get(n, []) + [n]:
            if d not in order:
                order.append(d)
    return "WITH " + ",\n".join([CTE[n] for n in order] + list(ctes)) + "\n" + sql

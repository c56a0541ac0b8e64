"""Stand-in tables F1–F11 derived from the driver's parquet tables.

Each builder reads only the columns it needs (Catalyst prunes the scan) and is
lazy except F10, whose rank pairing needs a global numbering. The same tables
are spelled out in DuckDB SQL in ``tessera.plans.fixture_sql`` for the oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.sources.tables import load_table

N_PERIODS = 13          # m1..m13
N_MONTHS = 80           # 1995-01 .. 2001-08
FIRST_YEAR = 1995


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """one row per order line with customer, invoice, item, time, country."""
    l = load_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    o = load_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    c = load_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = load_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return (l.join(o, l.l_orderkey == o.o_orderkey)
            .join(c, o.o_custkey == c.c_custkey)
            .join(n, c.c_nationkey == n.n_nationkey)
            .select(F.col("c_custkey").alias("customer_id"),
                    F.col("o_orderkey").alias("invoice_no"),
                    F.col("l_partkey").alias("stock_code"),
                    F.col("o_orderdate").alias("invoice_ts"),
                    F.col("n_name").alias("country"),
                    F.col("l_quantity").alias("quantity")))


def train_part(tx: DataFrame) -> DataFrame:
    """Training customers of F1: even customer ids."""
    return tx.where(F.col("customer_id") % 2 == 0)


def test_part(tx: DataFrame) -> DataFrame:
    """Test customers of F1: odd customer ids (disjoint from training)."""
    return tx.where(F.col("customer_id") % 2 == 1)


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(user, item) with rating = total quantity and a fixed-formula
    prediction that is NaN on some rows."""
    tx = transactions(spark, sf_dir)
    g = tx.groupBy("customer_id", "stock_code").agg(F.sum("quantity").alias("rating"))
    c, s = F.col("customer_id"), F.col("stock_code")
    pred = (F.when((c + s) % 11 == 0, F.lit(float("nan")))
            .otherwise(((c * 7 + s * 13) % 101).cast("double") / 100.0))
    return g.select(c.cast("string").alias("user_id"), s.cast("string").alias("item_id"),
                    "rating", pred.alias("prediction"))


def loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """one loan per customer; m1..m13 count returned, finished lines with
    quantity > 45 in 13 equal parts of the 80 months from 1995-01."""
    o = load_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority", "o_totalprice")
    l = load_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_returnflag", "l_linestatus", "l_quantity")
    c = load_table(spark, sf_dir, "customer").select(
        "c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    n = load_table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = load_table(spark, sf_dir, "region").select("r_regionkey", "r_name")

    # First and second order per customer. The rn <= 2 filter lets Spark apply a
    # partial per-key limit before the shuffle, so a hot customer ships 2 rows
    # per map task, not all its orders.
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    first2 = o.withColumn("rn", F.row_number().over(w)).where("rn <= 2")
    summary = first2.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.max(F.when(F.col("rn") == 1, F.col("o_orderpriority"))).alias("loan_purpose"),
        F.max(F.when(F.col("rn") == 1, F.col("o_orderdate"))).alias("origination_date"),
        F.max(F.when(F.col("rn") == 2, F.col("o_orderdate"))).alias("first_payment_date"),
        (F.max(F.when(F.col("rn") == 1, F.col("o_totalprice"))) / 1000.0).alias("loan_to_value"))

    month_index = (F.year("o_orderdate") - FIRST_YEAR) * 12 + F.month("o_orderdate") - 1
    part = (F.floor(month_index * N_PERIODS / N_MONTHS) + 1).cast("int")
    marks = (l.where((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F")
                     & (F.col("l_quantity") > 45))
             .join(o.select("o_orderkey", "o_custkey", "o_orderdate"),
                   F.col("l_orderkey") == F.col("o_orderkey"))
             .select("o_custkey", part.alias("part")))
    counts = marks.groupBy(F.col("o_custkey").alias("c_custkey")).agg(*[
        F.count_if(F.col("part") == k).alias(f"m{k}") for k in range(1, N_PERIODS + 1)])

    base = (c.join(n, c.c_nationkey == n.n_nationkey)
            .join(r, n.n_regionkey == r.r_regionkey))
    out = base.join(summary, "c_custkey", "left").join(counts, "c_custkey", "left")
    return out.select(
        F.col("c_custkey").alias("loan_id"),
        F.col("c_mktsegment").alias("source"),
        F.col("n_name").alias("financial_institution"),
        "loan_purpose",
        F.col("r_name").alias("insurance_type"),
        "origination_date", "first_payment_date",
        F.col("c_acctbal").alias("unpaid_principal_bal"),
        "loan_to_value",
        *[F.coalesce(F.col(f"m{k}"), F.lit(0).cast("long")).alias(f"m{k}")
          for k in range(1, N_PERIODS + 1)])


M_COLS = [f"m{k}" for k in range(1, N_PERIODS + 1)]


def attrition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """one row per order with an attrition label and some injected nulls."""
    o = load_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
        "o_orderpriority")
    c = load_table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    hole = F.col("o_orderkey") % 97 == 0
    return (o.join(c, o.o_custkey == c.c_custkey)
            .select(F.col("o_orderkey").alias("emp_id"),
                    F.when(F.col("o_orderstatus") == "F", "Yes").otherwise("No").alias("attrition"),
                    F.when(hole, None).otherwise(F.col("o_totalprice")).alias("monthly_income"),
                    (F.col("o_custkey") % 10).cast("int").alias("num_companies_worked"),
                    F.when(hole, None).otherwise(F.col("c_mktsegment")).alias("business_travel"),
                    F.when(hole, None).otherwise(F.col("o_orderpriority")).alias("education"),
                    (F.col("o_custkey") % 40 + 20).cast("int").alias("age"),
                    (F.year("o_orderdate") - 1990).cast("int").alias("years_at_company"),
                    F.col("c_acctbal").alias("account_balance")))


def hourly_series(spark: SparkSession, sf_dir: str, by_type: bool = False) -> DataFrame:
    """events counted per hour (optionally per event type), with the
    day-first text form of the hour."""
    e = load_table(spark, sf_dir, "events").select("ts", "event_type")
    hour = F.date_trunc("hour", F.col("ts")).cast("timestamp_ntz")
    keys = [hour.alias("ts")] + ([F.col("event_type").alias("series_id")] if by_type else [])
    g = e.groupBy(*keys).agg(F.count(F.lit(1)).alias("count"))
    return g.withColumn("datetime_text", F.date_format("ts", "dd-MM-yyyy HH:mm"))


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """review text with its class (the document language)."""
    d = load_table(spark, sf_dir, "documents")
    return d.select("doc_id", F.col("text").alias("review"), F.col("lang").alias("label"))


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """labelled messages, spam when the document is marked toxic."""
    d = load_table(spark, sf_dir, "documents").select("doc_id", "text")
    lb = load_table(spark, sf_dir, "labels").select("doc_id", "toxic")
    return (d.join(lb, "doc_id")
            .select("doc_id", F.when(F.col("toxic") == 1, "spam").otherwise("ham").alias("v1"),
                    F.col("text").alias("v2")))


def binary_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F8: four numeric features and a 0/1 label."""
    e = load_table(spark, sf_dir, "embeddings")
    return e.select("vec_id", *[F.col("embedding")[i].cast("double").alias(f"x{i + 1}")
                                for i in range(4)],
                    (F.col("label") % 2).alias("y"))


def parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """a numeric pair and two categories per part."""
    p = load_table(spark, sf_dir, "part")
    return p.select(F.col("p_partkey").alias("part_id"), F.col("p_retailprice").alias("wt"),
                    F.col("p_size").alias("mpg"), F.col("p_type").alias("gear"),
                    F.col("p_brand").alias("cyl"))


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """embedding vectors with their label."""
    e = load_table(spark, sf_dir, "embeddings")
    return e.select("vec_id", F.col("embedding").alias("features"), "label")


def word_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """the F6 vocabulary paired by frequency rank with the embedding
    vectors ranked by id (as many pairs as the shorter side has)."""
    from tessera.operators.ordering import global_row_number
    from tessera.operators.text import vocabulary

    vocab = vocabulary(reviews(spark, sf_dir), "review")
    vecs = global_row_number(load_table(spark, sf_dir, "embeddings").select("vec_id", "embedding"),
                             ["vec_id"], out="word_index")
    return (vocab.join(vecs, "word_index")
            .select("word", F.col("embedding").alias("vector")))

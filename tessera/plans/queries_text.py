"""Registered queries: metrics (E1–E9), text operators (P6, C10,
M11–M15, J6) and file round trips (S1–S7)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import scalars as S
from tessera.functions import text as T
from tessera.operators import metrics as E
from tessera.operators import text as TX
from tessera.plans.common import r6
from tessera.plans.fixture_sql import with_fixtures as W
from tessera.plans.registry import register
from tessera.session import scratch_path
from tessera.sources import files as IO
from tessera.sources import fixtures as FX

LLR = ("(SELECT loan_id, source, CAST(m13 > 0 AS INTEGER) AS actual, CAST(m12 > 0 AS INTEGER) AS pred, "
       "CAST(m12 > 0 OR greatest(m1, m2, m3, m4, m5, m6, m7, m8, m9, m10, m11) > 0 AS INTEGER) AS pred2 FROM loans)")


def _scored_loans(spark, d):
    lo = FX.loans(spark, d)
    return lo.select("loan_id", "source", (F.col("m13") > 0).cast("int").alias("actual"),
                     S.LOAN_RULES["m12_positive"]().alias("pred"),
                     S.LOAN_RULES["m12_or_history"]().alias("pred2"))


# Fixed rule classifier over the review text used to exercise the
# multi-class metrics: a few very common words per language.
_LANG_RULE_SQL = """CASE WHEN review LIKE '% the %' THEN 'en' WHEN review LIKE '% der %' OR review LIKE '% die %' THEN 'de'
 WHEN review LIKE '% el %' OR review LIKE '% los %' THEN 'es' ELSE 'fr' END"""


def _lang_rule():
    r = F.col("review")
    return (F.when(r.like("% the %"), "en")
            .when(r.like("% der %") | r.like("% die %"), "de")
            .when(r.like("% el %") | r.like("% los %"), "es").otherwise("fr"))


@register("E1_confusion_counts", W(f"""
SELECT count(*) FILTER (WHERE actual = 1 AND pred = 1) AS tp, count(*) FILTER (WHERE actual = 0 AND pred = 1) AS fp,
       count(*) FILTER (WHERE actual = 0 AND pred = 0) AS tn, count(*) FILTER (WHERE actual = 1 AND pred = 0) AS fn
FROM {LLR}""", "loans"))
def e1(spark, d):
    return E.confusion_counts(_scored_loans(spark, d), "actual", "pred")


@register("E2_binary_scores", W(f"""
SELECT tp, fp, tn, fn, round(tp / nullif(tp + fp, 0), 6) AS precision, round(tp / nullif(tp + fn, 0), 6) AS recall,
       round(2 * tp / nullif(2 * tp + fp + fn, 0), 6) AS f1, round((tp + tn) / nullif(tp + tn + fp + fn, 0), 6) AS accuracy
FROM (SELECT count(*) FILTER (WHERE actual = 1 AND pred2 = 1) AS tp, count(*) FILTER (WHERE actual = 0 AND pred2 = 1) AS fp,
       count(*) FILTER (WHERE actual = 0 AND pred2 = 0) AS tn, count(*) FILTER (WHERE actual = 1 AND pred2 = 0) AS fn
      FROM {LLR})""", "loans"))
def e2(spark, d):
    return r6(E.binary_scores(_scored_loans(spark, d), "actual", "pred2"))


@register("E3_confusion_matrix", W(f"""
SELECT label AS actual, {_LANG_RULE_SQL} AS predicted, count(*) AS count FROM reviews GROUP BY 1, 2""", "reviews"))
def e3(spark, d):
    r = FX.reviews(spark, d).withColumn("pred", _lang_rule())
    return E.confusion_matrix(r, "label", "pred")


@register("E4_classification_report", W(f"""
SELECT * FROM (
SELECT cls AS label, round(coalesce(tp / nullif(n_pred, 0), 0.0), 6) AS precision,
       round(coalesce(tp / nullif(support, 0), 0.0), 6) AS recall,
       round(coalesce(2 * tp / nullif(n_pred + support, 0), 0.0), 6) AS f1, CAST(support AS BIGINT) AS support
FROM (SELECT cls, count(*) FILTER (WHERE is_actual = 1) AS support, count(*) FILTER (WHERE is_actual = 0) AS n_pred,
             count(*) FILTER (WHERE is_actual = 1 AND hit = 1) AS tp
      FROM (SELECT label AS cls, 1 AS is_actual, CAST(label = p AS INTEGER) AS hit FROM (SELECT label, {_LANG_RULE_SQL} AS p FROM reviews)
            UNION ALL SELECT p, 0, 0 FROM (SELECT {_LANG_RULE_SQL} AS p FROM reviews)) GROUP BY cls)) c
UNION ALL
SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6), CAST(sum(support) AS BIGINT) FROM (
  SELECT coalesce(tp / nullif(n_pred, 0), 0.0) AS precision, coalesce(tp / nullif(support, 0), 0.0) AS recall,
         coalesce(2 * tp / nullif(n_pred + support, 0), 0.0) AS f1, support
  FROM (SELECT cls, count(*) FILTER (WHERE is_actual = 1) AS support, count(*) FILTER (WHERE is_actual = 0) AS n_pred,
               count(*) FILTER (WHERE is_actual = 1 AND hit = 1) AS tp
        FROM (SELECT label AS cls, 1 AS is_actual, CAST(label = p AS INTEGER) AS hit FROM (SELECT label, {_LANG_RULE_SQL} AS p FROM reviews)
              UNION ALL SELECT p, 0, 0 FROM (SELECT {_LANG_RULE_SQL} AS p FROM reviews)) GROUP BY cls))
UNION ALL
SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6), round(sum(recall * support) / sum(support), 6),
       round(sum(f1 * support) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM (
  SELECT coalesce(tp / nullif(n_pred, 0), 0.0) AS precision, coalesce(tp / nullif(support, 0), 0.0) AS recall,
         coalesce(2 * tp / nullif(n_pred + support, 0), 0.0) AS f1, support
  FROM (SELECT cls, count(*) FILTER (WHERE is_actual = 1) AS support, count(*) FILTER (WHERE is_actual = 0) AS n_pred,
               count(*) FILTER (WHERE is_actual = 1 AND hit = 1) AS tp
        FROM (SELECT label AS cls, 1 AS is_actual, CAST(label = p AS INTEGER) AS hit FROM (SELECT label, {_LANG_RULE_SQL} AS p FROM reviews)
              UNION ALL SELECT p, 0, 0 FROM (SELECT {_LANG_RULE_SQL} AS p FROM reviews)) GROUP BY cls))
UNION ALL
SELECT 'accuracy', NULL, NULL, round(avg(CAST(label = {_LANG_RULE_SQL} AS DOUBLE)), 6), count(*) FROM reviews""", "reviews"))
def e4(spark, d):
    r = FX.reviews(spark, d).withColumn("pred", _lang_rule())
    return r6(E.classification_report(r, "label", "pred"))


@register("E5_accuracy", W(f"SELECT round(avg(CAST(actual = pred AS DOUBLE)), 6) AS accuracy FROM {LLR}", "loans"))
def e5(spark, d):
    return r6(E.accuracy(_scored_loans(spark, d), "actual", "pred"))


@register("E6_rmse", W("""
SELECT round(sqrt(avg(pow(rating - prediction, 2))), 6) AS rmse FROM ratings WHERE NOT isnan(prediction)""", "ratings"))
def e6(spark, d):
    return r6(E.rmse(FX.ratings(spark, d), "rating", "prediction"))


@register("E7_mean_percentile_rank", W("""
SELECT round(avg(weighted_sum / rating_sum), 6) AS mpr FROM (
  SELECT user_id, sum(rating * pr) AS weighted_sum, sum(rating) AS rating_sum FROM (
    SELECT user_id, rating, percent_rank() OVER (PARTITION BY user_id ORDER BY prediction DESC) AS pr
    FROM ratings WHERE NOT isnan(prediction)) GROUP BY user_id)""", "ratings"))
def e7(spark, d):
    return r6(E.mean_percentile_rank(FX.ratings(spark, d), "user_id", "rating", "prediction"))


@register("E8_error_count", W(f"SELECT count(*) FILTER (WHERE actual IS DISTINCT FROM pred) AS n_errors FROM {LLR}", "loans"))
def e8(spark, d):
    return E.error_count(_scored_loans(spark, d), "actual", "pred")


@register("E9_disagreement_slice", W(f"""
SELECT actual, count(*) AS count FROM {LLR} WHERE pred <> pred2 GROUP BY actual""", "loans"))
def e9(spark, d):
    return E.disagreement_slice(_scored_loans(spark, d), F.col("pred") != F.col("pred2"), "actual")


# ---------------------------------------------------------------- text
@register("P6_filter_by_word_count", W("""
SELECT doc_id, label FROM reviews WHERE len(string_split(review, ' ')) <= 300""", "reviews"))
def p6(spark, d):
    return TX.filter_by_word_count(FX.reviews(spark, d), "review", 300).select("doc_id", "label")


@register("P6_count_over_word_limit", W("""
SELECT count(*) FILTER (WHERE len(string_split(review, ' ')) > 300) AS n_over, count(*) AS n_rows FROM reviews""", "reviews"))
def p6b(spark, d):
    return TX.count_over_word_limit(FX.reviews(spark, d), "review", 300)


@register("M11_vocabulary", W("SELECT word, word_count, word_index FROM vocab", "vocab"))
def m11(spark, d):
    return TX.vocabulary(FX.reviews(spark, d), "review")


_SEQ_SQL = """(SELECT t.doc_id, list(v.word_index ORDER BY t.pos) AS seq
  FROM (SELECT doc_id, unnest(tokens) AS word, generate_subscripts(tokens, 1) AS pos FROM review_tokens) t
  JOIN vocab v ON v.word = t.word AND v.word_index < 1000 GROUP BY t.doc_id)"""


@register("M12_texts_to_sequences", W(f"""
SELECT r.doc_id, CAST(coalesce(len(s.seq), 0) AS INTEGER) AS n_ids, coalesce(array_to_string(s.seq, ' '), '') AS ids
FROM reviews r LEFT JOIN {_SEQ_SQL} s USING (doc_id)""", "vocab"))
def m12(spark, d):
    r = FX.reviews(spark, d)
    vocab = TX.vocabulary(r, "review", num_words=1000)
    s = TX.texts_to_sequences(r, "doc_id", "review", vocab)
    return s.select("doc_id", F.size("sequence").alias("n_ids"), F.array_join("sequence", " ").alias("ids"))


@register("M12_sequences_to_text", W(f"""
SELECT r.doc_id, coalesce(b.text, '') AS text FROM reviews r LEFT JOIN (
  SELECT s.doc_id, string_agg(v.word, ' ' ORDER BY u.pos) AS text
  FROM {_SEQ_SQL} s, unnest(s.seq) WITH ORDINALITY AS u(word_index, pos)
  JOIN vocab v ON v.word_index = u.word_index GROUP BY s.doc_id) b USING (doc_id)""", "vocab"))
def m12b(spark, d):
    r = FX.reviews(spark, d)
    vocab = TX.vocabulary(r, "review", num_words=1000)
    s = TX.texts_to_sequences(r, "doc_id", "review", vocab)
    return TX.sequences_to_text(s, "doc_id", "sequence", vocab)


def _padded_sql(n):
    return f"""array_to_string(CASE WHEN len(coalesce(s.seq, [])) >= {n} THEN s.seq[len(s.seq) - {n - 1}:]
       ELSE list_concat(list_transform(range({n} - len(coalesce(s.seq, []))), lambda x: 0), coalesce(s.seq, [])) END, ' ')"""


# the notebooks pad to 150 (messages) and 300 (reviews)
@register("C10_pad_sequence", W(f"""
SELECT r.doc_id, {_padded_sql(150)} AS padded_150, {_padded_sql(300)} AS padded_300
FROM reviews r LEFT JOIN {_SEQ_SQL} s USING (doc_id)""", "vocab"))
def c10(spark, d):
    r = FX.reviews(spark, d)
    vocab = TX.vocabulary(r, "review", num_words=1000)
    s = TX.texts_to_sequences(r, "doc_id", "review", vocab)
    return s.select("doc_id", *[F.array_join(T.pad_sequence("sequence", n), " ").alias(f"padded_{n}") for n in (150, 300)])


@register("M13_embedding_table", W("""
SELECT v.word_index, v.word, w.vector IS NOT NULL AS known,
       round(coalesce(list_sum(list_transform(w.vector, lambda x: CAST(x AS DOUBLE))), 0.0), 4) AS vector_sum,
       CAST(coalesce(len(w.vector), 64) AS INTEGER) AS dim
FROM vocab v LEFT JOIN word_vectors w ON w.word = v.word""", "word_vectors"))
def m13(spark, d):
    r = FX.reviews(spark, d)
    vocab = TX.vocabulary(r, "review")
    emb = TX.embedding_table(vocab, FX.word_vectors(spark, d), 64)
    return emb.select("word_index", "word", "known",
                      F.round(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x.cast("double")), 4)
                      .alias("vector_sum"), F.size("vector").alias("dim"))


_TFIDF_SQL = """(SELECT doc_id, term, tf, df, raw / sqrt(sum(raw * raw) OVER (PARTITION BY doc_id)) AS weight
 FROM (SELECT t.doc_id, t.term, t.tf, f.df, t.tf * (ln((1 + n.n) / (1 + f.df)) + 1) AS raw
       FROM (SELECT doc_id, term, count(*) AS tf FROM (
               SELECT doc_id, unnest(regexp_extract_all(lower(review), '[\\p{L}\\p{N}_]{2,}')) AS term FROM reviews)
             GROUP BY 1, 2) t
       JOIN (SELECT term, count(*) AS df FROM (SELECT DISTINCT doc_id, unnest(regexp_extract_all(lower(review), '[\\p{L}\\p{N}_]{2,}')) AS term FROM reviews) GROUP BY 1) f USING (term),
       (SELECT count(*) AS n FROM reviews) n))"""


@register("M14_tf_idf", W(f"SELECT doc_id, term, tf, df, round(weight, 6) AS weight FROM {_TFIDF_SQL}", "reviews"))
def m14(spark, d):
    return r6(TX.tf_idf(FX.reviews(spark, d), "doc_id", "review"))


@register("M15_top_keywords", W(f"""
SELECT doc_id, keyword_rank, term, round(weight, 6) AS weight FROM (
  SELECT doc_id, term, weight, row_number() OVER (PARTITION BY doc_id ORDER BY weight DESC, term) AS keyword_rank
  FROM {_TFIDF_SQL}) WHERE keyword_rank <= 20""", "reviews"))
def m15(spark, d):
    return r6(TX.top_keywords(FX.reviews(spark, d), "doc_id", "review", 20))


@register("J6_left_lookup", W("""
SELECT v.word_index, round(coalesce(list_sum(list_transform(w.vector, lambda x: CAST(x AS DOUBLE))), 0.0), 4) AS vector_sum
FROM vocab v LEFT JOIN word_vectors w ON w.word = v.word""", "word_vectors"))
def j6(spark, d):
    from tessera.operators.relational import left_lookup
    vocab = TX.vocabulary(FX.reviews(spark, d), "review").select("word_index", "word")
    j = left_lookup(vocab, FX.word_vectors(spark, d), "word",
                    {"vector": F.array_repeat(F.lit(0.0).cast("float"), 64)})
    return j.select("word_index", F.round(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x.cast("double")), 4)
                    .alias("vector_sum"))


# ---------------------------------------------------------------- files
@register("S1_scan_csv_roundtrip", W("""
SELECT customer_id, invoice_no, stock_code, invoice_ts, country, quantity FROM tx""", "tx"))
def s1(spark, d):
    path = scratch_path(spark, "s1")
    IO.write_csv(FX.transactions(spark, d), path)
    schema = ("customer_id long, invoice_no long, stock_code long, invoice_ts timestamp_ntz, "
              "country string, quantity double")
    return IO.scan_csv(spark, path, schema=schema)


@register("S2_scan_tsv_roundtrip", W("SELECT doc_id, review, label FROM reviews", "reviews"))
def s2(spark, d):
    path = scratch_path(spark, "s2")
    IO.write_csv(FX.reviews(spark, d), path, sep="\t")
    return IO.scan_csv(spark, path, schema="doc_id long, review string, label string", sep="\t", multiline=True)


# Latin-1 has no sign for other characters: they are written as question marks
@register("S3_scan_latin1", W("""
SELECT doc_id, v1, regexp_replace(v2, '[^\\x{00}-\\x{FF}]', '?', 'g') AS v2 FROM messages""", "messages"))
def s3(spark, d):
    path = scratch_path(spark, "s3")
    m = FX.messages(spark, d)
    IO.write_csv(m, path, encoding="ISO-8859-1")
    return IO.scan_csv(spark, path, schema="doc_id long, v1 string, v2 string", encoding="ISO-8859-1", multiline=True)


@register("S4_scan_ratings", W("""
SELECT user_id, item_id,
       CASE WHEN (CAST(user_id AS BIGINT) + CAST(item_id AS BIGINT)) % 13 = 0 THEN NULL ELSE round(rating, 6) END AS rating
FROM ratings""", "ratings"))
def s4(spark, d):
    """Ratings rendered as text lines, a rule-chosen few with an unparsable
    rating ("n/a"), read back: those ratings are NULL."""
    path = scratch_path(spark, "s4")
    r = FX.ratings(spark, d)
    bad = (F.col("user_id").cast("long") + F.col("item_id").cast("long")) % 13 == 0
    text = F.when(bad, F.lit("n/a")).otherwise(F.col("rating").cast("string"))
    IO.write_text_lines(r.select(F.concat_ws(",", "user_id", "item_id", text)), path)
    return r6(IO.scan_ratings(spark, path))


@register("S5_scan_word_vectors", W("""
SELECT word, CAST(len(vector) AS INTEGER) AS dim, round(list_sum(list_transform(vector, lambda x: CAST(x AS DOUBLE))), 4) AS vector_sum
FROM word_vectors""", "word_vectors"))
def s5(spark, d):
    path = scratch_path(spark, "s5")
    wv = FX.word_vectors(spark, d)
    IO.write_text_lines(wv.select(F.concat_ws(" ", F.col("word"), F.array_join(
        F.col("vector").cast("array<string>"), " "))), path)
    back = IO.scan_word_vectors(spark, path)
    return back.select("word", F.size("vector").alias("dim"),
                       F.round(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x.cast("double")), 4)
                       .alias("vector_sum"))


@register("S6_write_csv_submission", W("""
SELECT loan_id, CAST(m12 <> 0 AS INTEGER) AS m13 FROM loans""", "loans"))
def s6(spark, d):
    path = scratch_path(spark, "s6")
    sub = FX.loans(spark, d).select("loan_id", S.LOAN_RULES["m12_nonzero"]().alias("m13"))
    IO.write_csv(sub, path)
    return IO.scan_csv(spark, path, schema="loan_id long, m13 int")


@register("S7_write_csv_append", W("""
SELECT user_id, item_id FROM ratings UNION ALL SELECT user_id, item_id FROM ratings""", "ratings"))
def s7(spark, d):
    path = scratch_path(spark, "s7")
    r = FX.ratings(spark, d).select("user_id", "item_id")
    IO.write_csv(r, path, header=False, mode="append")
    IO.write_csv(r, path, header=False, mode="append")
    return IO.scan_csv(spark, path, schema="user_id string, item_id string", header=False)

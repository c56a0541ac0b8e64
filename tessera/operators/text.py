"""Text operators: word-count filter, vocabulary, id sequences, embedding
lookup, TF-IDF and top keywords (P6, M11–M15).

Documents are exploded into (document, position, token) rows, so every step
is a join or grouping Spark distributes; no document list or vocabulary passes
through the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.text import tokenize, word_count
from tessera.operators.ordering import global_row_number
from tessera.operators.skew import BROADCAST_ROWS, split_join

# Fixed value: the token pattern of the scikit-learn TF-IDF vectorizer
# (two or more word characters), written with Unicode classes.
TFIDF_TOKEN = r"[\p{L}\p{N}_]{2,}"


def filter_by_word_count(df: DataFrame, col: str, max_words: int) -> DataFrame:
    """Keep texts of at most ``max_words`` space-separated words."""
    return df.where(word_count(col) <= max_words)


def count_over_word_limit(df: DataFrame, col: str, max_words: int) -> DataFrame:
    """Number of texts longer than ``max_words`` words, and of all texts."""
    return df.agg(F.count_if(word_count(col) > max_words).alias("n_over"),
                  F.count(F.lit(1)).alias("n_rows"))


def token_rows(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, pos, word) per token of the tokenised text."""
    return df.select(id_col, F.posexplode(tokenize(text_col)).alias("pos", "word"))


def vocabulary(df: DataFrame, text_col: str, num_words: int | None = None) -> DataFrame:
    """Words by falling total count, index from 1, ties by word.

    With ``num_words`` only indices below it are kept (the tokenizer rule).
    The count is a partial aggregation, so frequent words do not skew it; the
    index comes from a distributed global numbering.
    """
    words = df.select(F.explode(tokenize(text_col)).alias("word"))
    counts = words.groupBy("word").agg(F.count(F.lit(1)).alias("word_count"))
    vocab = global_row_number(counts, [F.col("word_count").desc(), F.col("word")],
                              out="word_index")
    if num_words is not None:
        vocab = vocab.where(F.col("word_index") < num_words)
    return vocab


def texts_to_sequences(df: DataFrame, id_col: str, text_col: str, vocab: DataFrame,
                       out: str = "sequence") -> DataFrame:
    """Words to ids in text order, unknown words dropped (M12). Texts with no
    known word get an empty sequence. Frequent words meet their ids without a
    shuffle (``split_join``), so a word in a third of all tokens is no one task's."""
    toks = token_rows(df, id_col, text_col)
    known = split_join(toks, vocab.select("word", "word_index"), "word")
    seqs = known.groupBy(id_col).agg(
        F.array_sort(F.collect_list(F.struct("pos", "word_index"))).alias("_s"))
    seqs = seqs.select(id_col, F.transform("_s", lambda s: s["word_index"]).cast("array<int>").alias(out))
    return (df.select(id_col).join(seqs, id_col, "left")
            .select(id_col, F.coalesce(F.col(out), F.array().cast("array<int>")).alias(out)))


def sequences_to_text(df: DataFrame, id_col: str, seq_col: str, vocab: DataFrame,
                      out: str = "text") -> DataFrame:
    """Ids back to words joined by spaces (M12); id 0 (padding) is skipped."""
    ids = df.select(id_col, F.posexplode(seq_col).alias("pos", "word_index"))
    words = split_join(ids, vocab.select("word", F.col("word_index").cast("int").alias("word_index")), "word_index")
    back = words.groupBy(id_col).agg(F.array_sort(F.collect_list(F.struct("pos", "word"))).alias("_w"))
    back = back.select(id_col, F.array_join(F.transform("_w", lambda s: s["word"]), " ").alias(out))
    return (df.select(id_col).join(back, id_col, "left")
            .select(id_col, F.coalesce(F.col(out), F.lit("")).alias(out)))


def embedding_table(vocab: DataFrame, vectors: DataFrame, dim: int) -> DataFrame:
    """word_index -> vector; words without a vector get zeros."""
    zero = F.array_repeat(F.lit(0.0).cast("float"), dim)
    return (vocab.select("word_index", "word")
            .join(vectors.select("word", "vector"), "word", "left")
            .select("word_index", "word", F.coalesce(F.col("vector"), zero).alias("vector"),
                    F.col("vector").isNotNull().alias("known")))


def tf_idf(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Smoothed TF-IDF with an L2 norm per document, long form
    (id, term, tf, df, weight) (M14).

    idf = ln((1 + n) / (1 + df)) + 1; weight = tf * idf / ||tf * idf||.

    The terms of a document are counted once and written as one row a document.
    From there rows are dealt by document: the most frequent terms' document
    frequencies (``BROADCAST_ROWS`` at most) are broadcast, and the norm is a
    window that needs no further shuffle. Only the pairs of other terms, which
    are rare, may be shuffled by term.
    """
    from tessera.session import materialize
    found = F.explode(F.regexp_extract_all(F.lower(F.col(text_col)), F.lit(TFIDF_TOKEN), 0)).alias("term")
    counted = (df.select(id_col, text_col).repartition(F.col(id_col)).select(id_col, found)
               .groupBy(id_col, "term").agg(F.count(F.lit(1)).alias("tf")))
    packed = materialize(counted.groupBy(id_col).agg(F.collect_list(F.struct("term", "tf")).alias("_t")), "tf")
    tf = packed.repartition(F.col(id_col)).select(id_col, F.inline("_t"))
    dfreq = materialize(packed.select(F.inline("_t")).groupBy("term").agg(F.count(F.lit(1)).alias("df")), "df")
    n_docs = df.select(F.count(F.lit(1))).scalar()
    most = dfreq
    if dfreq.count() > BROADCAST_ROWS:
        most = materialize(dfreq.orderBy(F.desc("df"), "term").limit(BROADCAST_ROWS), "df-most")
    w = tf.join(F.broadcast(most), "term").select(id_col, "term", "tf", "df")
    if most is not dfreq:
        rare = dfreq.join(F.broadcast(most.select("term")), "term", "left_anti")
        pairs = tf.join(F.broadcast(most.select("term")), "term", "left_anti")
        w = w.unionByName(pairs.join(rare, "term").select(id_col, "term", "tf", "df").repartition(F.col(id_col)))
    raw = F.col("tf") * (F.ln((F.lit(1) + n_docs) / (F.col("df") + 1)) + 1)
    w = w.withColumn("_raw", raw)
    norm = F.sqrt(F.sum(F.col("_raw") * F.col("_raw")).over(Window.partitionBy(id_col)))
    return w.select(id_col, "term", "tf", "df", (F.col("_raw") / norm).alias("weight"))


def top_keywords(df: DataFrame, id_col: str, text_col: str, k: int = 20) -> DataFrame:
    """The k highest TF-IDF terms per document, ties by term.

    ``row_number() <= k`` lets Spark keep only k rows per document before the
    shuffle (window group limit).
    """
    w = tf_idf(df, id_col, text_col)
    win = Window.partitionBy(id_col).orderBy(F.col("weight").desc(), F.col("term"))
    return (w.withColumn("keyword_rank", F.row_number().over(win).cast("long"))
            .where(F.col("keyword_rank") <= k)
            .select(id_col, "keyword_rank", "term", "weight"))

"""Registered queries of the training-data operators."""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline

from .chat import conversation_digests, format_conversations
from .collocations import collocations
from .common import crc_mod, load
from .decontaminate import decontaminate
from .embedding_dedup import embedding_dedup
from .language import identify, train
from .line_dedup import dedup_lines
from .ngram_join import ngram_join
from .packing import pack_documents
from .periodic_runs import periodic_runs
from .phrase_automata import remove_phrases
from .sharding import shard_rows
from .suffix_dedup import remove_repeats
from .toxicity import learn_lexicon, score_toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# Components below are the transitive closure of the links.
_CLOSURE = """reach(a, b) AS (
  SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)"""


@register("op1_spherical_cap_dedup", f"""
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links(a, b) AS (
  SELECT p.vec_id, q.vec_id FROM v p JOIN v q ON p.vec_id <> q.vec_id AND len(p.e) = len(q.e)
  WHERE list_cosine_similarity(p.e, q.e) >= 0.95),
{_CLOSURE}
SELECT e.vec_id,
  (SELECT count(*) FROM links l WHERE l.a = e.vec_id) AS n_links,
  coalesce((SELECT min(b) FROM reach r WHERE r.a = e.vec_id), e.vec_id) AS component_id,
  e.vec_id = coalesce((SELECT min(b) FROM reach r WHERE r.a = e.vec_id), e.vec_id) AS kept
FROM embeddings e""")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup(load(spark, sf_dir, "embeddings"))


@register("op2_greedy_string_tiling")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))


@register("op3_language_svm")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    found = identify(docs, train(docs, crc_mod("doc_id", 3) != 1))
    return found.select("doc_id", F.coalesce(crc_mod("doc_id", 3) == 1, F.lit(False)).alias("held_out"),
                        "lang_pred", "score")


@register("op4_chat_windows")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    told = r"\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", told), (-7, 1, "assistant", told)],
                                  "conv_id long, turn long, role string, text string")
    turns = load(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return conversation_digests(format_conversations(turns)).withColumnRenamed("conv", "conv_id")


@register("op5_hypergeometric_shards")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    sharded = shard_rows(load(spark, sf_dir, "documents"), shards=16)
    text = F.coalesce("text", F.lit(""))
    return sharded.select("doc_id", (F.octet_length(text).cast("long") + 1).alias("size"),
                          F.crc32(text).alias("text_crc32"), F.lit("rows").alias("law"),
                          F.col("shard").cast("int").alias("shard"), "slot",
                          F.lit(None).cast("int").alias("grown_shard"))


@register("op6_best_fit_packing")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = pack_documents(load(spark, sf_dir, "documents"))
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", "proven")


@register("op7_ngram_jaccard_join", f"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '\\s+'), lambda w: w <> '') AS w FROM documents),
sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM words),
grams AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
links(a, b) AS (
  SELECT p.doc_id, q.doc_id FROM grams p JOIN grams q ON p.g = q.g AND p.doc_id <> q.doc_id
  GROUP BY p.doc_id, q.doc_id, p.n, q.n HAVING count(*) >= 0.8 * (p.n + q.n - count(*)) - 1e-9),
{_CLOSURE}
SELECT d.doc_id,
  coalesce((SELECT min(o.doc_id) FROM sets o WHERE len(o.s) > 0 AND list_sort(o.s) = list_sort(d.s)), d.doc_id) AS class_id,
  (SELECT count(*) FROM links l WHERE l.a = d.doc_id) AS n_links,
  coalesce((SELECT min(b) FROM reach r WHERE r.a = d.doc_id), d.doc_id) AS component_id
FROM sets d""")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join(load(spark, sf_dir, "documents"))


@register("op8_toxicity_lexicon")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels")
    scored = score_toxicity(docs, learn_lexicon(docs, labels, crc_mod("doc_id", 5) != 0))
    return scored.select("doc_id", F.coalesce(crc_mod("doc_id", 5) == 0, F.lit(False)).alias("held_out"),
                         "score", "predicted")


@register("op9_fuzzy_line_dedup")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs).select("doc_id", "text", F.size(F.split("text", "\n")).alias("n_lines"))


@register("op10_suffix_array_dedup")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = remove_repeats(load(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@register("pipeline")
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


_PHRASES = r"""
pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
words AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[ \t]+'), lambda w: w <> '') AS w FROM pieces),
total AS (SELECT lang, sum(len(w))::BIGINT AS n FROM words GROUP BY lang),
places AS (SELECT lang, w, s.size AS size, unnest(range(1, len(w) - s.size + 2)) AS i
  FROM words, (VALUES (1), (2), (3), (4)) s(size) WHERE len(w) >= s.size),
counts AS (
  SELECT lang, size, array_to_string(w[i:i + size - 1], ' ') AS phrase, count(*) AS a
  FROM places GROUP BY ALL HAVING count(*) >= 30),
cuts AS (SELECT lang, size, phrase, a, string_split(phrase, ' ') AS w, unnest(range(1, size)) AS k FROM counts WHERE size > 1),
scored AS (
  SELECT c.lang, c.size, c.phrase, c.a, k, l.a AS l, r.a AS r, (2000000::HUGEINT * c.a) // (l.a + r.a) AS score
  FROM cuts c JOIN counts l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[:k], ' ')
  JOIN counts r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[k + 1:], ' ')),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
held AS (
  SELECT s.lang, s.phrase FROM best s JOIN counts q ON q.lang = s.lang AND q.size > s.size
    AND contains(' ' || q.phrase || ' ', ' ' || s.phrase || ' ') AND 100::HUGEINT * q.a >= 80::HUGEINT * s.a)"""


@register("op11_phrase_collocations", f"""
WITH {_PHRASES}
SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, phrase) AS rank,
  phrase, a, l, r, n, score::BIGINT AS score
FROM best b JOIN total USING (lang)
WHERE NOT EXISTS (SELECT 1 FROM held h WHERE h.lang = b.lang AND h.phrase = b.phrase)
QUALIFY rank <= 2000""")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(load(spark, sf_dir, "documents"))


def repeat_tails(docs: DataFrame) -> DataFrame:
    """The contract's input of op12: with h = crc32(doc_id as text), one
    document in ten (h % 10 = 0) repeats the first words of its tail."""
    def repeated(batches):
        for batch in batches:
            texts = []
            for at, text in zip(batch["id"], batch["text"]):
                h = zlib.crc32(at.encode()) if at is not None else 1
                words = text.split() if h % 10 == 0 and text else []
                if words:
                    n, g = len(words), h // 10
                    a = g % n
                    p = 1 + (n - a) // (3 + g % 8)
                    text = b" ".join(words[:a] + (words[a:a + p] * ((n - a) // p + 1))[:n - a])
                texts.append(text)
            yield batch.assign(text=texts)

    src = docs.select(F.col("doc_id").cast("string").alias("id"), F.col("text").cast("binary").alias("text"))
    kind = docs.schema["doc_id"].dataType
    return src.mapInPandas(repeated, "id string, text binary").select(F.col("id").cast(kind).alias("doc_id"), "text")


@register("op12_periodic_runs")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(repeat_tails(load(spark, sf_dir, "documents")))
    of = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    # by falling length / period, in whole numbers; then start, then period
    steeper = F.array_sort("runs", lambda x, y: F.coalesce(*[
        F.when(low != high, F.when(low < high, -1).otherwise(1)) for low, high in (
            (y["length"] * x["period"], x["length"] * y["period"]), (x["start"], y["start"]),
            (x["period"], y["period"]))], F.lit(0)))
    best = F.get(steeper, 0)
    lines = F.concat(F.array_join(of, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), lines.alias("lines"), "collapsed", best.alias("best")).select(
        "doc_id", "n_runs", "best.start", "best.length", "best.period",
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2("lines", 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


@register("op13_phrase_automata", r"""
WITH texts AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
places AS (SELECT doc_id, unnest(range(1, len(w) - 33)) AS i, w FROM texts WHERE len(w) >= 35),
windows AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 34], ' ')) AS t FROM places),
again AS (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY t) > 1),
gone AS (SELECT DISTINCT doc_id, i + unnest(range(0, 35)) AS k FROM again),
kept AS (
  SELECT p.doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p.k) AS kept
  FROM (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS k FROM texts) p
  LEFT JOIN gone g ON g.doc_id = p.doc_id AND g.k = p.k WHERE g.k IS NULL GROUP BY p.doc_id)
SELECT t.doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed,
  sha256(coalesce(kept, '')) AS kept_sha256
FROM texts t LEFT JOIN kept USING (doc_id)""")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = remove_phrases(load(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))

"""N-gram Jaccard join by MinHash banding (operator 7)."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.session import materialize

from .bucketjoin import bucket_links, shared_counts
from .common import bits, mix, shingle_hashes, words_of


def choose_bands(similarity: float, recall: float, rows: int = 5) -> tuple[int, int]:
    """(bands, rows per band): the fewest bands of ``rows`` minhashes with
    which a pair at exactly ``similarity`` shares one with probability
    ``recall`` or more; closer pairs share one more surely."""
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - similarity ** rows))), rows


def band_hashes(grams: np.ndarray, bands: int, rows: int, seed: int) -> np.ndarray:
    """One 64-bit hash per band of the set's minhashes."""
    rng = np.random.default_rng(seed)
    keys = rng.integers(1, 1 << 63, bands * rows, np.uint64) | np.uint64(1)
    least = np.empty(bands * rows, np.uint64)
    for k, m in enumerate(keys):  # odd multipliers permute the 64-bit values
        least[k] = (grams * m ^ (m >> np.uint64(7))).min()
    table = least.reshape(bands, rows)
    out = np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for r in range(rows):
        out = mix(out ^ table[:, r])
    return out


def grams_of(text: str | None, n: int) -> np.ndarray:
    """The distinct n-grams of a text as sorted 64-bit hashes."""
    return np.unique(shingle_hashes(words_of(text), n))


def _signatures(batches, n: int, bands: int, rows: int, seed: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        keys, hashes = [], []
        for t in b.column(1):
            g = grams_of(t.as_py(), n)
            keys.append(xxhash.xxh3_128_digest(g.tobytes()) if len(g) else None)
            hashes.append(bits(band_hashes(g, bands, rows, seed)) if len(g) else None)
        yield pa.RecordBatch.from_arrays(
            [b.column(0), pa.array(keys, pa.binary()), pa.array(hashes, pa.list_(pa.int64()))], names=["id", "k", "bands"])


def ngram_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 5, similarity: float = 0.8,
               recall: float = 0.9999, rows: int = 5, seed: int = 3) -> DataFrame:
    """Join of all texts whose sets of word ``n``-grams have a Jaccard
    similarity of ``similarity`` or more.

    Words are lower-cased and split at white space. Texts with the same set
    are one class (their key is a 128-bit hash of it), so copies are compared
    once. Candidates are classes that share a band; every pair is then
    verified on the full sets, read again for the classes that have
    candidates.

    One row per input row: ``id_col``, class_id (smallest id with the same
    set), n_links (other rows within the similarity, copies included),
    component_id (smallest id reachable by links). Null and empty texts have
    no n-grams: class_id and component_id are their own id, n_links 0. A text
    of fewer than ``n`` words has one n-gram, all its words. A null id is
    smaller than none: classes take the smallest non-null one. Repeated rows
    are copies; an empty table gives no rows; other columns are ignored.
    """
    bands, rows = choose_bands(similarity, recall, rows)
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = src.schema["id"].dataType.simpleString()
    signed = materialize(src.mapInArrow(lambda it: _signatures(it, n, bands, rows, seed),
                                        f"id {kind}, k binary, bands array<long>"), "signatures")
    classes = (signed.where("k is not null").groupBy("k")
               .agg(F.count("*").alias("copies"), F.min("id").alias("class_id"), F.first("bands").alias("bands")))
    classes = materialize(classes, "classes")
    members = classes.select(F.explode("bands").alias("bucket"), "k")
    # candidates: classes that share a band; their sets are computed again from the text
    shared = members.groupBy("bucket").agg(F.count("*").alias("m")).where("m > 1").select("bucket")
    members = materialize(members.join(shared, "bucket"), "candidates")
    wanted = classes.join(members.select("k").distinct(), "k", "left_semi").select("class_id", "k", "copies")

    def sets(batches) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 256):
                part = b.slice(lo, 256)
                g = [grams_of(t, n) for t in part.column(2).to_pylist()]
                ok = [len(x) > 0 and xxhash.xxh3_128_digest(x.tobytes()) == k
                      for x, k in zip(g, part.column(0).to_pylist())]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array([bits(x) for x in g], pa.list_(pa.int64()))],
                    names=["k", "copies", "grams"]).filter(pa.array(ok, pa.bool_()))

    # ids may repeat with other texts: the key decides which row's set it is
    texts = (src.join(wanted, src["id"].eqNullSafe(wanted["class_id"])).select("k", "copies", "text")
             .mapInArrow(sets, "k binary, copies long, grams array<long>"))
    payload = texts.dropDuplicates(["k"]) if _may_repeat(src) else texts

    def linked(x: list[np.ndarray], y: list[np.ndarray]) -> np.ndarray:
        both = shared_counts(x, y)
        total = np.array([len(a) for a in x])[:, None] + np.array([len(b) for b in y])[None, :] - both
        if y is x:
            np.fill_diagonal(total, 1)
        return both >= similarity * total - 1e-9

    links = bucket_links(members.select("bucket", "k"), payload, linked, "grams")
    linked_classes = (classes.select("k", "class_id", "copies").join(links, "k", "left")
                      .withColumn("root", F.coalesce("root", "k")))
    low = linked_classes.groupBy("root").agg(F.min("class_id").alias("component_id"))
    found = linked_classes.join(low, "root").select(
        "k", "class_id", "component_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    return signed.select("id", "k").join(found, "k", "left").select(
        F.col("id").alias(id_col), F.coalesce("class_id", "id").alias("class_id"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("component_id", "id").alias("component_id"))


def _may_repeat(src: DataFrame) -> bool:
    """Whether some id occurs more than once (then a class's text may be found
    more than once)."""
    return src.groupBy("id").count().where("count > 1").limit(1).count() > 0


def keep_one_per_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` whose id is their component's smallest; rows
    without n-grams stay. Rows that repeat an id and text stay together."""
    joined = ngram_join(docs, id_col, text_col, **options)
    gone = (joined.where(F.col(id_col) != F.col("component_id")).select(F.col(id_col).alias("_gone")).distinct())
    return docs.join(gone, docs[id_col] == gone["_gone"], "left_anti")

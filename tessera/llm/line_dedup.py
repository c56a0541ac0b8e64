"""Fuzzy line deduplication (operator 9), in DataFrame operations only.

Near-equal lines of the whole corpus are linked: MinHash signatures of
character shingles, banding, exact Jaccard similarity of the candidates'
shingle sets, connected components. One line of each component stays.
"""

from __future__ import annotations

import random
from functools import reduce
from operator import add, and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.session import materialize

from .common import discard, freed_shuffles
from .components import connected_components

# A line's shingles: all its windows of 5 characters; a shorter line is its only one.
SIZE = 5
_LINE = "\n"


def _norm(line: Column) -> Column:
    return F.trim(F.lower(line))


def _places(wide: Column) -> Column:
    """Where the shingles of a line begin; ``wide`` has 4 bytes a character."""
    return F.sequence(F.lit(0), F.greatest((F.length(wide) / 4).cast("int") - SIZE, F.lit(0)))


def _gram(wide: Column, at: Column) -> Column:
    return F.xxhash64(F.substring(wide, at * 4 + 1, F.lit(4 * SIZE)))


def shingles(norm: Column) -> Column:
    """Hashes of a line's distinct shingles. The places of characters are found
    at once in UTF-32; the array of one element holds it for all of them."""
    wide = F.array(F.encode(norm, "UTF-32"))
    return F.array_distinct(F.transform(wide, lambda w: F.transform(_places(w), lambda at: _gram(w, at)))[0])


def _lines(src: DataFrame, *more: Column) -> DataFrame:
    """id, no, norm of every line that is not blank."""
    return (src.select("id", *more, F.posexplode(F.split("text", _LINE)).alias("no", "line"))
            .select("id", *[c for c in src.columns if c not in ("id", "text")], "no", _norm(F.col("line")).alias("norm"))
            .where("norm <> ''"))


def _keyed(lines: DataFrame) -> DataFrame:
    """A line's key: 128 bits of hash of its normal form."""
    return lines.withColumns({"h1": F.xxhash64("norm"), "h2": F.xxhash64(F.lit(17), "norm")})


def _least(gram: Column, n: int, seed: int) -> list[Column]:
    """The minhashes m0 ... of a group's shingle hashes: each orders their
    upper 31 bits by the product with an odd number of its own, modulo 2^31
    (xor with a constant would keep the hashes' common prefixes together, and
    the minhashes of a pair would depend on each other)."""
    rng = random.Random(seed)
    x, low = F.shiftrightunsigned(gram, 33), F.lit((1 << 31) - 1)
    return [F.min((x * F.lit(rng.getrandbits(31) | 1)).bitwiseAND(low)).alias(f"m{k}") for k in range(n)]


def _bands(bands: int, rows: int) -> list[Column]:
    return [F.xxhash64(F.lit(b), *[F.col(f"m{b * rows + r}") for r in range(rows)]) for b in range(bands)]


#: Words of 64 bits in a line's bitmap of shingles; unrelated lines of up to some 1500 characters differ in enough of its bits.
BITMAP = 16


def _bitmap(gram: Column) -> list[Column]:
    """The bits of a group's shingles, from the lower half of their hashes."""
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), gram.bitwiseAND(F.lit(63)).cast("int"))
    word = F.shiftrightunsigned(gram, 6).bitwiseAND(F.lit(BITMAP - 1))
    return [F.bit_or(F.when(word == k, bit).otherwise(F.lit(0).cast("long"))).alias(f"b{k}") for k in range(BITMAP)]


def _may_be_similar(similarity: float) -> Column:
    """Whether two lines (b0 ... and size; c0 ... and size_b) can be similar:
    each bit in which they differ needs a shingle that only one of them has,
    and similar lines have few of those. Never false for similar lines."""
    differ = reduce(add, [F.bit_count(F.col(f"b{k}").bitwiseXOR(F.col(f"c{k}"))) for k in range(BITMAP)])
    return differ <= (1 - similarity) / (1 + similarity) * (F.col("size") + F.col("size_b")) + 1e-9


def _line_components(docs: DataFrame, id_col: str, text_col: str, similarity: float = 0.8,
                     bands: int = 6, rows: int = 3, seed: int = 9, broadcast_rows: int = 1_000_000) -> DataFrame:
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    wide = _keyed(_lines(src)).select("id", "h1", "h2", F.encode("norm", "UTF-32").alias("wide"))
    grams = (wide.select("id", "h1", "h2", "wide", F.explode(_places(F.col("wide"))).alias("at"))
             .select("id", "h1", "h2", (F.col("at") == 0).cast("long").alias("one"), _gram(F.col("wide"), F.col("at")).alias("g")))
    signed = grams.groupBy("h1", "h2").agg(F.sum("one").alias("copies"), F.min("id").alias("first_id"), F.count("*").alias("all"),
                                         *_bitmap(F.col("g")), *_least(F.col("g"), bands * rows, seed))
    bits = [f"b{k}" for k in range(BITMAP)]
    # bands as 32-bit numbers: a chance meeting costs a look at two bitmaps
    band = [b.bitwiseAND(F.lit(0xFFFFFFFF)) for b in _bands(bands, rows)]
    lines = signed.select("h1", "h2", "copies", "first_id", (F.col("all") / F.col("copies")).cast("int").alias("size"), *bits,
                          F.array(*band).alias("bands"))
    lines = materialize(lines.withColumn("n", F.monotonically_increasing_id()), "lines")
    keys = materialize(lines.select("n", "h1", "h2", "copies", "first_id"), "keys")  # outlive the bitmaps
    members = lines.select(F.explode("bands").alias("bucket"), "n").withColumnRenamed("n", "a")
    shared = (members.groupBy("bucket").agg(F.min("a").alias("low"), F.max("a").alias("high"))
              .where("low <> high").select("bucket", "low"))  # buckets with two lines or more
    held = materialize(members.join(shared, "bucket"), "held")

    def similar(pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) that are similar, by all their shingles. The texts
        of their lines come from the first document that has them."""
        pairs = materialize(pairs, "pairs")
        wanted = pairs.select(F.explode(F.array("a", "b")).alias("n")).distinct()
        wanted = materialize(keys.join(wanted, "n").select("n", "h1", "h2", "first_id"), "wanted")
        ids = wanted.select(F.col("first_id").alias("wanted_id")).distinct()
        if ids.count() <= broadcast_rows:  # 8 MB of ids; beyond that the documents are shuffled
            ids = F.broadcast(ids)
        some = src.join(ids, F.col("id").eqNullSafe(F.col("wanted_id")), "left_semi")
        texts = _keyed(_lines(some)).join(wanted, ["h1", "h2"]).where(F.col("id").eqNullSafe(F.col("first_id")))
        texts = materialize(texts.select("n", "norm").dropDuplicates(["n"]), "texts")
        x, y = (texts.select(F.col("n").alias(side), F.col("norm").alias(name)) for side, name in (("a", "x"), ("b", "y")))
        sets = pairs.join(x, "a").join(y, "b").select("a", "b", shingles(F.col("x")).alias("x"), shingles(F.col("y")).alias("y"))
        both = F.size(F.array_intersect("x", "y"))
        found = (sets.select("a", "b", both.alias("both"), (F.size("x") + F.size("y")).alias("sum"))
                 .where(F.col("both") >= similarity * (F.col("sum") - F.col("both")) - 1e-9).select("a", "b"))
        found = materialize(found, "similar")
        discard(pairs, wanted, texts)
        return found

    near = _may_be_similar(similarity)
    signs = lines.select("n", "size", *bits)
    others = signs.select(F.col("n").alias("b"), F.col("size").alias("size_b"), *[F.col(f"b{k}").alias(f"c{k}") for k in range(BITMAP)])
    # first the bucket's first line with each other one ...
    star = held.where("a <> low").select("a", F.col("low").alias("b")).distinct()
    star = similar(star.join(signs.withColumnRenamed("n", "a"), "a").join(others, "b").where(near).select("a", "b"))
    roots = materialize(connected_components(star), "roots")
    # ... then, in buckets that still hold several components, lines of different ones
    placed = held.join(roots, F.col("a") == F.col("node"), "left").withColumn("root", F.coalesce("root", "a")).drop("node")
    several = (placed.groupBy("bucket").agg(F.min("root").alias("least"), F.max("root").alias("most"))
               .where("least <> most").select("bucket"))
    open_ = placed.join(several, "bucket").where("a <> low").drop("low")  # the first ones are compared already
    open_ = materialize(open_.join(signs.withColumnRenamed("n", "a"), "a"), "open")
    discard(held, lines, roots)
    right = open_.select("bucket", F.col("a").alias("b"), F.col("root").alias("root_b"), F.col("size").alias("size_b"),
                         *[F.col(f"b{k}").alias(f"c{k}") for k in range(BITMAP)])
    cross = open_.join(right, "bucket").where((F.col("a") < F.col("b")) & (F.col("root") != F.col("root_b")) & near)
    cross = similar(cross.select("a", "b").distinct())
    comps = connected_components(star.unionByName(cross))
    key = F.struct("h1", "h2")
    marked = (keys.select("n", key.alias("key"), "copies", "first_id").join(comps, F.col("n") == F.col("node"), "left")
              .where(F.col("root").isNotNull() | (F.col("copies") > 1)).withColumn("root", F.coalesce("root", "n")))
    first = marked.groupBy("root").agg(F.min("first_id").alias("first_id"), F.min("key").alias("low"))
    out = materialize(marked.select("key", "root").join(first, "root")
                      .select("key.h1", "key.h2", F.col("low.h1").alias("r1"), F.col("low.h2").alias("r2"), "first_id"), "components")
    discard(open_, star, cross, keys)
    return out


def line_components(docs: DataFrame, id_col: str, text_col: str, **options) -> DataFrame:
    """h1, h2 (key of a line's normal form), r1, r2 (smallest key of its
    component), first_id (smallest id of a document with a line of the
    component): for every normal form that occurs more than once or is similar
    to another one."""
    with freed_shuffles(docs.sparkSession):
        return _line_components(docs, id_col, text_col, **options)


def removed_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """id, key (hash of the text), removed: the numbers (from 0, rising) of
    the lines to drop of each document that loses any. Of a component the first
    line of the smallest id stays."""
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    marked = line_components(docs, id_col, text_col, **options)
    src = src.withColumn("key", F.xxhash64("text"))  # rows may repeat an id with another text
    seen = (_keyed(_lines(src, F.col("key"))).select("id", "key", "no", "h1", "h2").join(marked, ["h1", "h2"])
            .select("id", "key", "no", "r1", "r2", F.col("id").eqNullSafe(F.col("first_id")).alias("first")))
    with freed_shuffles(docs.sparkSession):
        seen = materialize(seen, "occurrences")
    discard(marked)
    stays = seen.where("first").groupBy("r1", "r2").agg(F.min("no").alias("stay"))
    first = seen.where("first").join(stays, ["r1", "r2"]).where("no <> stay").select("id", "key", "no")
    gone = seen.where("not first").select("id", "key", "no").unionByName(first)
    return gone.groupBy("id", "key").agg(F.array_sort(F.collect_set("no")).alias("removed"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with all its rows and columns, the text without the lines
    whose component has an earlier line (by id, then line number).

    A line's normal form is lower-case without spaces at the ends; two are
    similar when the Jaccard similarity of all their 5-character shingles
    is ``similarity`` or more. Candidates share one of
    ``bands`` hashes of ``rows`` minhashes each: with 6 and 3 a pair at
    exactly 0.8 is found with probability 0.986, at 0.9 with 0.9996, whatever
    the lines' length. Blank lines are kept and never compared. Texts are split
    at line feeds only.

    Null texts stay null, empty ones empty; a text may lose all its lines and
    is then empty. Ids order the copies (a null id comes last); rows that
    repeat an id and text are one document and keep the same lines. An empty
    table stays empty. Other columns, whatever their names, are carried along.
    """
    gone = removed_lines(docs, id_col, text_col, **options).select(
        F.col("id").alias("gone_id"), F.col("key").alias("gone_key"), "removed")
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    text = F.col("row").getField(text_col)

    def kept(lines: Column) -> Column:
        """The stretches of lines between the removed ones: linear in both."""
        ends = F.concat("removed", F.array(F.size(lines)))
        return F.flatten(F.transform(ends, lambda end, k: F.slice(
            lines, F.when(k > 0, F.get("removed", k - 1) + 2).otherwise(1),
            end - F.when(k > 0, F.get("removed", k - 1) + 1).otherwise(0))))

    # the split text is the one element of an array, so that it is made once
    new = F.transform(F.array(F.split(text, _LINE)), lambda lines: F.array_join(kept(lines), _LINE))[0]
    new = F.when(F.col("removed").isNull(), text).otherwise(new)
    joined = row.join(gone, F.col("row").getField(id_col).eqNullSafe(F.col("gone_id"))
                      & (F.xxhash64(text.cast("string")) == F.col("gone_key")), "left")
    return joined.select(*[(new if c == text_col else F.col("row").getField(c)).alias(c) for c in docs.columns])

"""Operator 6: document fingerprints as bottom-k sketches of word shingles.

A sketch is the ascending array of the k smallest distinct hashes of the
five-word shingles of a text (A-Z lower-cased, words split at ASCII white
space). Sketches of parts merge into the sketch of the whole, and two sketches
estimate resemblance, containment and the number of distinct shingles. A text
of fewer than five words has its whole word sequence as its only shingle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from torque.llm.columns import let, lower_ascii, stored, words

SHINGLE_WORDS = 5
SKETCH_SIZE = 128


def shingle_hashes(text: Column, size: int = SHINGLE_WORDS) -> Column:
    """Hashes of all shingles of a text, in order, repeats included."""
    hashed = F.transform(words(lower_ascii(text)), lambda w: F.xxhash64(w))
    return let(hashed, lambda h: (
        F.when(F.size(h) >= size, F.transform(
            F.sequence(F.lit(0), F.greatest(F.size(h) - size, F.lit(0))),
            lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(size)])))
        .when(F.size(h) > 0, F.array(F.xxhash64(h)))
        .otherwise(F.array().cast("array<bigint>"))))


def bottom_k(hashes: Column, k: int = SKETCH_SIZE) -> Column:
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, k)


def sketch(text: Column, k: int = SKETCH_SIZE) -> Column:
    return bottom_k(shingle_hashes(text), k)


def merge(a: Column, b: Column, k: int = SKETCH_SIZE) -> Column:
    """Sketch of the union of two parts; associative and commutative."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def resemblance(a: Column, b: Column, k: int = SKETCH_SIZE) -> Column:
    """Estimated Jaccard similarity; two empty sketches resemble by 1."""
    def of(both: Column) -> Column:
        shared = F.filter(F.array_intersect(a, b), lambda h: h <= F.element_at(both, -1))
        return F.when(F.size(both) == 0, F.lit(1.0)).otherwise(
            F.size(shared).cast("double") / F.size(both))
    return let(merge(a, b, k), of)


def distinct_shingles(a: Column, k: int = SKETCH_SIZE) -> Column:
    """Estimated number of distinct shingles; exact below k."""
    share = (F.element_at(a, -1).cast("double") + F.lit(2.0 ** 63)) / F.lit(2.0 ** 64)
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise(F.lit(float(k - 1)) / share)


def containment(a: Column, b: Column, k: int = SKETCH_SIZE) -> Column:
    """Estimated share of a's shingles that b has; 1 for an empty a."""
    both = distinct_shingles(merge(a, b, k), k) * resemblance(a, b, k)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(
        F.least(F.lit(1.0), both / distinct_shingles(a, k)))


def as_text(a: Column) -> Column:
    """16 lowercase hex digits per hash."""
    return F.array_join(F.transform(a, lambda h: F.lower(F.lpad(F.hex(h), 16, "0"))), "")


def following(ids: DataFrame) -> DataFrame:
    """(doc_id, next_id): the next smaller distinct id; the largest after the last.

    Ids are dealt into ranges; each range finds its neighbours by itself and
    the ranges' ends (one row per range) are linked afterwards.
    """
    spread = stored(ids.filter(F.col("doc_id").isNotNull()).distinct()
                    .repartitionByRange("doc_id").select(
                        "doc_id", F.spark_partition_id().alias("range")))
    inside = Window.partitionBy("range").orderBy("doc_id")
    ends = spread.groupBy("range").agg(F.max("doc_id").alias("top"))
    over = Window.orderBy("range")         # a row per range, not per document
    ends = ends.select("range", F.coalesce(
        F.lag("top").over(over),
        F.max("top").over(over.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    ).alias("below"))
    return (spread.withColumn("before", F.lag("doc_id").over(inside))
            .join(F.broadcast(ends), "range")
            .select("doc_id", F.coalesce("before", "below").alias("next_id")))


def document_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                          k: int = SKETCH_SIZE) -> DataFrame:
    """Fingerprint every whole text and its edited form.

    The edited text has its last floor(n_chars / 3) code points replaced by as
    many from the start of the next document's text (all of it if shorter);
    next is by descending id, the first after the last. Returns doc_id,
    n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited and
    near_next (estimated resemblances, 0 to 1).

    Null texts count as empty; empty texts have empty fingerprints, and two
    empty ones resemble by 1. Rows that share an id each get a row; as a next
    document they count with their smallest text. A document without id has
    no next document (null near_next) and an edited text that is only cut. An
    empty table gives an empty result; other columns are not read.
    """
    own_id = F.col(id_col) if id_col == "doc_id" else F.col(id_col).alias("doc_id")
    rows = docs.select(own_id, F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    links = following(rows.select("doc_id"))
    third = F.floor(F.char_length("text") / F.lit(3)).cast("int")
    # What each document's predecessor takes over from it: at most its whole text.
    need = rows.groupBy("doc_id").agg(F.max(third).alias("need"))
    wanted = (links.join(need, "doc_id")
              .select(F.col("next_id"), F.col("doc_id").alias("by"), "need"))
    # one filter for both joins, so that the texts are dealt out by id only once
    known = rows.filter(F.col("doc_id").isNotNull())
    heads = (known.join(wanted, known["doc_id"] == F.col("next_id"))
             .select(F.col("by").alias("head_id"), F.struct(
                 F.expr("substring(text, 1, need)").alias("head"),
                 sketch(F.col("text"), k).alias("sketch")).alias("next"))
             .groupBy("head_id").agg(F.min("next").alias("next")))
    empty = F.array().cast("array<bigint>")
    own = F.coalesce(F.col("sketch"), empty)
    paired = known.join(heads, known["doc_id"] == F.col("head_id"), "left").select(
        "doc_id", "text", "next").unionByName(rows.filter(F.col("doc_id").isNull()).select(
            "doc_id", "text", F.lit(None).cast(heads.schema["next"].dataType).alias("next")))
    return (paired
            .select("doc_id", F.char_length("text").cast("long").alias("n_chars"),
                    sketch(F.col("text"), k).alias("sketch"),
                    F.concat(F.expr("substring(text, 1, char_length(text) - "
                                    "cast(floor(char_length(text) / 3) as int))"),
                             F.coalesce(F.expr("substring(next.head, 1, "
                                               "cast(floor(char_length(text) / 3) as int))"),
                                        F.lit(""))).alias("edited"),
                    F.col("next.sketch").alias("next_sketch"))
            .select("doc_id", "n_chars", F.sha2(F.encode("edited", "UTF-8"), 256)
                    .alias("edited_sha256"), own.alias("sketch"),
                    sketch(F.col("edited"), k).alias("edited_sketch"), "next_sketch")
            .select("doc_id", "n_chars", "edited_sha256",
                    as_text(F.col("sketch")).alias("fingerprint"),
                    as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
                    resemblance(F.col("sketch"), F.col("edited_sketch"), k).alias("near_edited"),
                    resemblance(F.col("sketch"), F.col("next_sketch"), k).alias("near_next")))

"""Threshold-scaled sketches: every shingle hash below a fixed fraction.

A text's shingles (five lower-cased words; fewer words: the whole sequence)
are hashed to 64 bits; the sketch keeps all distinct hashes whose unsigned
value lies under ``fraction`` of the range, and always the smallest one, so
that a short text has a sketch too.  The same hashes survive in every text,
so sketches of parts merge by union (the smallest of all parts is again the
smallest), sizes estimate set sizes, and overlaps estimate Jaccard
similarity and the containment of a short text in a very long one.

Everything is DataFrame expressions: no Python runs on the executors.

Cases: NULL and empty texts and texts without words have the empty sketch;
two empty sketches have likeness 1, an empty and another one 0; equal texts
have equal sketches; repeated rows are rows; an empty table gives an empty
result; further columns are ignored.  In the order of the edits, rows are
taken by ascending id (NULL first), then by text hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.llm.store import Scratch


def sketch(text: Column, fraction: float = 0.125, k: int = 5) -> Column:
    """Sorted array of the retained hashes (signed 64-bit, order of the signed value)."""
    words = F.filter(F.split(F.lower(text), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    at = lambda w, i, j: F.get(w, i + j)
    hashes = lambda w: F.transform(
        F.sequence(F.lit(0), F.greatest(F.size(w) - k, F.lit(0))), lambda i: F.xxhash64(*[at(w, i, j) for j in range(k)]))
    # signed values from the least one up are unsigned ones shifted by half the range
    limit = int(-(1 << 63) + fraction * (1 << 64))
    low = lambda h: F.array_union(F.filter(h, lambda x: x < F.lit(limit)), F.array(F.array_min(h)))
    kept = F.transform(F.transform(F.array(words), hashes), low)[0]
    return F.when(text.isNotNull() & (F.size(words) > 0), F.sort_array(kept)).otherwise(F.array().cast("array<bigint>"))


def merge(a: Column, b: Column, fraction: float = 0.125) -> Column:
    """Sketch of two parts' joint shingles."""
    limit = int(-(1 << 63) + fraction * (1 << 64))
    both = F.array_union(a, b)
    return F.sort_array(F.filter(both, lambda x: (x < F.lit(limit)) | (x == F.array_min(both))))


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity of the texts of two sketches."""
    shared = F.size(F.array_intersect(a, b))
    union = F.size(a) + F.size(b) - shared
    return F.when(union == 0, F.lit(1.0)).otherwise(shared / union)


def containment(a: Column, b: Column) -> Column:
    """Estimated share of a's shingles that b holds too."""
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / F.size(a))


def as_text(s: Column) -> Column:
    """Fixed-width hexadecimal digits of the hashes, in order."""
    return F.array_join(F.transform(s, lambda x: F.lpad(F.lower(F.hex(x)), 16, "0")), "")


def neighbours(ids: DataFrame, scratch: Scratch) -> DataFrame:
    """For distinct ordered keys ``o`` with payload ``n``: rows (o, prev,
    prev_n), where prev is the key before (the last one for the first).

    Keys are range-partitioned and numbered by their partition; within a
    partition the key before is one window step, and only the last key of
    each partition is carried over."""
    ranged = ids.repartitionByRange("o").withColumn("p", F.spark_partition_id())
    ranged = scratch.save(ranged, "ranged")
    order = Window.partitionBy("p").orderBy("o")
    inner = ranged.withColumns({"prev": F.lag(F.struct("o", "n")).over(order), "rn": F.row_number().over(order)})
    edge = ranged.groupBy("p").agg(F.max_by(F.struct("o", "n"), "o").alias("last"))       # one row a partition
    by = Window.orderBy("p")
    edge = edge.withColumn("carry", F.coalesce(F.lag("last").over(by), F.last("last").over(by.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))))
    edge = edge.select(F.col("p").alias("ep"), "carry")
    # an edge row for each partition: bounded by the number of partitions
    firsts = inner.where("rn = 1").join(F.broadcast(edge), F.col("p") == F.col("ep")).select("o", F.col("carry").alias("prev"))
    return inner.where("rn > 1").select("o", "prev").unionByName(firsts).select("o", F.col("prev.o").alias("prev"), F.col("prev.n").alias("prev_n"))


def half_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fraction: float = 0.125, k: int = 5) -> DataFrame:
    """Rows (id, n_chars, edited, sketch, edited_sketch, next_sketch): the
    edited text has its last floor(n/2) code points replaced by the first as
    many (or all) of the next document's."""
    scratch = Scratch(docs.sparkSession, "sketch")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    d = docs.select(F.col(id_col).cast("long").alias("id"), text.alias("text"))
    d = d.select(F.struct(F.col("id"), F.xxhash64("text").alias("h")).alias("o"), "text", F.length("text").alias("n"))
    order = scratch.save(neighbours(d.select("o", "n").distinct(), scratch), "order")
    own = d.withColumn("s", sketch(F.col("text"), fraction, k))
    # Both readings of this join need the same columns of the documents, so
    # that Spark shuffles their texts once and reuses the exchange.
    known = F.coalesce(F.col("n") + F.col("prev_n") + F.size("s"), F.lit(0)) >= 0
    by_prev = order.withColumnRenamed("o", "of")
    placed = own.join(by_prev, (F.col("o") == F.col("of")) & known).drop("of")
    # each document hands its head and sketch to the one before it
    heads = placed.select(F.col("prev").alias("before"), F.expr("substring(text, 1, cast(floor(prev_n / 2) as int))").alias("head"),
                          F.col("s").alias("next_sketch"), "n")
    heads = heads.groupBy("before").agg(F.first(F.struct("head", "next_sketch")).alias("next"))
    own = placed.join(heads, F.col("o") == F.col("before")).select("o", "text", "n", "s", F.col("next.head").alias("head"), F.col("next.next_sketch").alias("next_sketch"))
    edited = F.concat(F.expr("substring(text, 1, n - cast(floor(n / 2) as int))"), "head")
    return (own.withColumn("edited", edited)
            .select(F.col("o.id").alias("id"), F.col("n").cast("long").alias("n_chars"), "edited", F.col("s").alias("sketch"),
                    sketch(F.col("edited"), fraction, k).alias("edited_sketch"), "next_sketch"))

"""Near-copy components of texts: word shingles, MinHash bands, exact checks.

Equal texts are one class.  Classes whose signatures agree in a band meet in
a bucket; every pair of a bucket is decided: its link is checked exactly on
the shingle sets, unless both are in one component already.  A bucket's
smallest member is held against all others first, which settles a group of
near copies at the price of one check a member; what lies in other
components then is held against eight times as many members in each
round.  Pairs whose sizes and sketches (places of the hashes, as bits) show
that they cannot link are not compared; the sketches rule out no link.

With the default 20 bands of 3 hashes a pair at the threshold of 0.8 shares
no bucket with a probability of 6 in 10 million.

Cases: NULL texts and texts without words are in no component but their
own; texts with fewer words than a shingle are one shingle; NULL ids are
left out; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from marquee.operators.graph import connected_components
from marquee.session import checkpoint_dir

#: Places of a set's sketch, 64 in a column.
BITS = 512
_BIT_NAMES = [f"b{i}" for i in range(BITS // 64)]


def shingle_set(text: Column, words: int) -> Column:
    """Distinct hashed shingles of a text's lower-cased words."""
    def grams(w: Column) -> Column:
        whole = F.transform(F.sequence(F.lit(1), F.size(w) - words + 1), lambda i: F.xxhash64(F.slice(w, i, words)))
        return F.when(F.size(w) == 0, F.array().cast("array<long>")).when(F.size(w) < words, F.array(F.xxhash64(w))).otherwise(F.array_distinct(whole))
    # the words are bound once, not split anew for each shingle
    return F.transform(F.array(F.filter(F.split(F.lower(text), r"\s+"), lambda x: x != "")), grams)[0]


def signatures(sets: DataFrame, bands: int, rows: int) -> DataFrame:
    """Rows (rep, n, bits, keys): a set's size, which of ``BITS`` places its
    hashes fall into, and the buckets of its MinHash signature.  The size is
    NULL where several texts share a rep."""
    h = sets.select("rep", "class", F.size("sh").alias("n"), F.explode("sh").alias("h"))
    mins = [F.min(F.xxhash64("h", F.lit(j))).alias(f"m{j}") for j in range(bands * rows)]
    bit = F.expr("shiftleft(1L, CAST(shiftright(h, 8) & 63 AS INT))")
    bits = [F.bit_or(F.when(F.pmod("h", F.lit(BITS // 64)) == i, bit).otherwise(0)).alias(f"b{i}") for i in range(BITS // 64)]
    size = F.when(F.min("class") == F.max("class"), F.max("n")).alias("n")
    keys = F.array(*[F.xxhash64(F.lit(b), *[F.col(f"m{b * rows + j}") for j in range(rows)]) for b in range(bands)])
    return h.groupBy("rep").agg(size, *bits, *mins).select("rep", "n", *_BIT_NAMES, keys.alias("keys"))


def _may_link(percent: int) -> Column:
    """Whether the sets of rows ``f`` and ``r`` can be similar enough, as far
    as sizes and places tell; exact: a place that only one of them fills is a
    hash the other lacks."""
    a, b = F.col("f.n"), F.col("r.n")

    def own(x: str, y: str) -> Column:
        return sum((F.bit_count(F.col(f"{x}.{c}").bitwiseAND(F.bitwise_not(f"{y}.{c}"))) for c in _BIT_NAMES), F.lit(0))
    shared = F.least(a - own("f", "r"), b - own("r", "f"))
    return a.isNull() | b.isNull() | (100 * shared >= percent * (a + b - shared))


def near_components(docs: DataFrame, id_col: str, text_col: str, words: int = 5, percent: int = 80, bands: int = 20, rows: int = 3) -> DataFrame:
    """Rows (id, component, class_rows): the smallest id reachable by links
    of Jaccard similarity >= ``percent``, and the rows with the same text.

    Texts are shuffled once, to their ids, and what is made of them stays
    there: the signatures and the checks of all rounds move ids and, for
    pairs that sizes and places leave open, one of the two sets."""
    spark = docs.sparkSession
    checkpoint_dir(spark)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    d = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).where("id is not null")
    d = d.withColumn("h", F.coalesce(F.sha2("text", 256), F.concat(F.lit("null "), F.col("id").cast("string"))))
    classes = d.groupBy("h").agg(F.min("id").alias("rep"), F.count("*").alias("class_rows")).checkpoint()
    # an equality of h would be a second key, by which the texts were shuffled again
    first_ = classes.select("rep", F.col("h").alias("rh"))
    texts = d.where("text is not null").repartition(parts, "id").dropDuplicates(["id", "h"])
    texts = texts.join(first_, (F.col("id") == F.col("rep")) & F.col("h").between(F.col("rh"), F.col("rh")), "left_semi")
    sets = texts.select(F.col("id").alias("rep"), F.xxhash64("h").alias("class"), shingle_set("text", words).alias("sh"))
    # kept on disk with their partitions, which a checkpoint forgets
    kept = sets.persist(StorageLevel.DISK_ONLY)
    sets = kept.where(F.size("sh") > 0)
    signed = signatures(sets, bands, rows).persist(StorageLevel.DISK_ONLY)
    sketch = signed.drop("keys")
    keys = signed.select("rep", F.explode("keys").alias("key"))
    big = keys.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    members = keys.join(big, "key").select("key", "rep").checkpoint()
    label = members.select("rep").distinct().withColumn("comp", F.col("rep")).checkpoint()
    links = done = None
    pivots = 1
    while True:
        # members of buckets that still hold several components, in order
        held = members.join(label, "rep").join(sketch, "rep").repartition(parts, "key").persist(StorageLevel.DISK_ONLY)
        open_ = held.groupBy("key").agg(F.min("comp").alias("c0"), F.max("comp").alias("c1")).where("c0 < c1").select("key")
        m = held.join(open_, "key").withColumn("at", F.row_number().over(Window.partitionBy("key").orderBy("rep")))
        if open_.isEmpty():
            held.unpersist()
            break
        # the pivots are on the right: only they are held in memory
        pairs = (m.alias("r").join(m.where(F.col("at") <= pivots).alias("f"), F.col("r.key") == F.col("f.key"))
                 .where((F.col("f.at") < F.col("r.at")) & (F.col("f.comp") != F.col("r.comp")) & _may_link(percent))
                 .select(F.col("f.rep").alias("a"), F.col("r.rep").alias("b")).distinct())
        if done is not None:
            pairs = pairs.join(done, ["a", "b"], "left_anti")
        checked = (pairs.join(sets.select(F.col("rep").alias("a"), F.col("sh").alias("x")), "a").join(sets.select(F.col("rep").alias("b"), F.col("sh").alias("y")), "b")
                   .withColumn("shared", F.size(F.array_intersect("x", "y")))
                   .select("a", "b", (100 * F.col("shared") >= percent * (F.size("x") + F.size("y") - F.col("shared"))).alias("near"))).checkpoint()
        found = checked.where("near").select(F.col("a").alias("src"), F.col("b").alias("dst"))
        links = found if links is None else links.unionByName(found)
        done = checked.select("a", "b") if done is None else done.unionByName(checked.select("a", "b"))
        # a pivot has met all others of its bucket
        members = m.where(F.col("at") > pivots).select("key", "rep").checkpoint()
        held.unpersist()
        if not found.isEmpty():
            comp = connected_components(links).select(F.col("id").alias("rep"), F.col("label").alias("now"))
            label = label.join(comp, "rep", "left").select("rep", F.coalesce("now", "comp").alias("comp")).checkpoint()
        pivots *= 8
    signed.unpersist()
    kept.unpersist()
    final = classes.join(label, "rep", "left").select("h", "class_rows", F.coalesce("comp", "rep").alias("component"))
    return d.select("id", "h").join(final, "h").select("id", "component", "class_rows")

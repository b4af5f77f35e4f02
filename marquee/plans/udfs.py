"""Python function surface (§2.9): UDF, registered UDF, pandas UDFs
(scalar, iterator, struct, grouped aggregate), grouped / cogrouped map,
mapInPandas / mapInArrow, UDTF, batch prediction.

Built-in expressions remain the default everywhere else; these queries
exist to exercise the Arrow paths.  Per-group pandas work is either on
groups bounded by the data model (lines of one order) or two-level
(salted partials merged by a built-in aggregate).
"""

# no ``from __future__ import annotations``: pandas UDF type hints must
# stay real types.
from typing import Iterator, Tuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf, udf

from marquee.functions.pyhelpers import minutes_py
from marquee.operators.relational import key_bucket, salt
from marquee.plans.catalog import duration_sql
from marquee.plans.registry import query

_DUR_TEXT_SQL = """CASE WHEN event_type = 'error' THEN CAST(minute(ts) AS VARCHAR) || 'm'
  ELSE CAST(hour(ts) AS VARCHAR) || 'h ' || CAST(minute(ts) AS VARCHAR) || 'm' END"""


def _dur_text(t):
    h, m = F.hour("ts").cast("string"), F.minute("ts").cast("string")
    d = F.when(F.col("event_type") == "error", F.concat(m, F.lit("m"))).otherwise(F.concat(h, F.lit("h "), m, F.lit("m")))
    return t.events.select("event_id", d.alias("d"))


@query("udf_scalar", oracle=f"SELECT event_id, {duration_sql('d')} AS minutes FROM (SELECT event_id, {_DUR_TEXT_SQL} AS d FROM events)")
def udf_scalar(t):
    """Row-at-a-time Python UDF (the slow path; the native form is
    ``functions.text.duration_minutes``)."""
    minutes = udf(minutes_py, T.IntegerType())
    return _dur_text(t).select("event_id", minutes("d").alias("minutes"))


@query("udf_sql", oracle=f"SELECT event_id, {duration_sql('d')} AS minutes, {duration_sql('d')} AS again FROM (SELECT event_id, {_DUR_TEXT_SQL} AS d FROM events)")
def udf_sql(t):
    spark = t.spark
    spark.udf.register("marquee_minutes", minutes_py, T.IntegerType())
    _dur_text(t).createOrReplaceTempView("marquee_durations")
    sql = spark.sql("SELECT event_id, d, marquee_minutes(d) AS minutes FROM marquee_durations")
    return sql.select("event_id", "minutes", F.call_udf("marquee_minutes", F.col("d")).alias("again"))


@query("pandas_scalar", oracle="SELECT event_id, value * 2 + 1 AS scaled FROM events")
def pandas_scalar(t):
    @pandas_udf("double")
    def scaled(v: pd.Series) -> pd.Series:
        return v * 2 + 1

    return t.events.select("event_id", scaled("value").alias("scaled"))


@query("pandas_iter", oracle="SELECT l_orderkey, l_linenumber, l_partkey, l_quantity + 10 AS plus10, l_quantity * l_discount AS qd FROM lineitem")
def pandas_iter(t):
    @pandas_udf("double")
    def plus(it: Iterator[pd.Series]) -> Iterator[pd.Series]:
        offset = 10.0  # set-up runs once per partition, not per batch
        for v in it:
            yield v + offset

    @pandas_udf("double")
    def mul(it: Iterator[Tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for a, b in it:
            yield a * b

    li = t.lineitem
    return li.select("l_orderkey", "l_linenumber", "l_partkey", plus("l_quantity").alias("plus10"),
                     mul("l_quantity", "l_discount").alias("qd"))


@query("pandas_struct", oracle="""
SELECT p_partkey, split_part(p_name, ' ', 1) AS first,
  CASE WHEN instr(p_name, ' ') > 0 THEN substring(p_name, instr(p_name, ' ') + 1) END AS rest FROM part
""")
def pandas_struct(t):
    @pandas_udf("first string, rest string")
    def split_name(s: pd.Series) -> pd.DataFrame:
        parts = s.str.split(" ", n=1, expand=True)
        return pd.DataFrame({"first": parts[0], "rest": parts[1] if 1 in parts else None})

    return t.part.select("p_partkey", split_name("p_name").alias("s")).select("p_partkey", "s.first", "s.rest")


@query("pandas_agg", oracle="SELECT event_type, round(sum(value), 2) AS total, count(value) AS n, round(sum(value) / count(value), 4) AS mean FROM events GROUP BY event_type")
def pandas_agg(t):
    """Grouped-aggregate pandas UDFs, two-level: partial sums/counts per
    (key, salt) group, then a built-in merge — a hot key is split over
    the salts instead of landing in one Python worker."""
    @pandas_udf("double")
    def psum(v: pd.Series) -> float:
        return float(v.sum())

    @pandas_udf("long")
    def pcount(v: pd.Series) -> int:
        return int(v.count())

    ev = t.events.select("event_type", "value", "event_id").withColumn("_salt", salt("event_id", 16))
    part = ev.groupBy("event_type", "_salt").agg(psum("value").alias("s"), pcount("value").alias("n"))
    out = part.groupBy("event_type").agg(F.sum("s").alias("s"), F.sum("n").alias("n"))
    return out.select("event_type", F.round("s", 2).alias("total"), "n", F.round(F.col("s") / F.col("n"), 4).alias("mean"))


@query("grouped_map", oracle="""
SELECT l_orderkey, l_linenumber, l_partkey, round(l_extendedprice / sum(l_extendedprice) OVER (PARTITION BY l_orderkey), 6) AS share
FROM lineitem
""")
def grouped_map(t):
    """applyInPandas: each line's share of its order value.  A call takes a
    bucket of orders, whose number follows the counted lines."""
    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")

    def share(pdf: pd.DataFrame) -> pd.DataFrame:
        total = pdf.groupby("l_orderkey", dropna=False)["l_extendedprice"].transform("sum")
        out = pdf.assign(share=(pdf["l_extendedprice"] / total).round(6))
        return out[["l_orderkey", "l_linenumber", "l_partkey", "share"]]

    return li.groupBy(key_bucket("l_orderkey", li.count()).alias("bucket")).applyInPandas(
        share, "l_orderkey long, l_linenumber int, l_partkey long, share double")


@query("map_in_pandas", oracle="SELECT o_orderkey, o_totalprice / 1000 AS k_price FROM orders WHERE o_orderstatus = 'F'")
def map_in_pandas(t):
    def fn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            b = b[b.o_orderstatus == "F"]
            yield pd.DataFrame({"o_orderkey": b.o_orderkey, "k_price": b.o_totalprice / 1000})

    return t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice").mapInPandas(fn, "o_orderkey long, k_price double")


@query("map_in_arrow", oracle="SELECT o_orderkey, o_totalprice > 200000 AS big FROM orders")
def map_in_arrow(t):
    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            big = pc.greater(b.column("o_totalprice"), 200000.0)
            yield pa.RecordBatch.from_arrays([b.column("o_orderkey"), big], names=["o_orderkey", "big"])

    return t.orders.select("o_orderkey", "o_totalprice").mapInArrow(fn, "o_orderkey long, big boolean")


@query("udtf_split", oracle="""
SELECT p_partkey, CAST(pos - 1 AS INTEGER) AS pos, word FROM (
  SELECT p_partkey, unnest(string_split(p_name, ' ')) AS word, generate_subscripts(string_split(p_name, ' '), 1) AS pos FROM part)
""")
def udtf_split(t):
    """Python UDTF (one row in, many rows out) called with LATERAL."""
    from pyspark.sql.functions import udtf

    @udtf(returnType="pos int, word string")
    class SplitWords:
        def eval(self, text: str):
            for i, w in enumerate((text or "").split(" ")):
                yield i, w

    t.spark.udtf.register("marquee_split_words", SplitWords)
    t.part.createOrReplaceTempView("marquee_part")
    return t.spark.sql("SELECT p_partkey, w.pos, w.word FROM marquee_part, LATERAL marquee_split_words(p_name) w")


# fixed values: words excluded from the exclude-list word count
EXCLUDED_WORDS = ["a", "the", "and", "of", "to"]


@query("exclude_words", oracle=r"""
SELECT word, count(*) AS n FROM (SELECT unnest(string_split_regex(lower(text), '[^a-z]+')) AS word FROM benchmark)
WHERE word <> '' AND word NOT IN ('a', 'the', 'and', 'of', 'to') GROUP BY word
""")
def exclude_words(t):
    """Word count with an exclude list (broadcast anti join) and a side
    metric counting the dropped words (``Observation``)."""
    words = (t.benchmark.select(F.explode(F.split(F.lower("text"), "[^a-z]+")).alias("word")).where(F.col("word") != ""))
    excl = t.spark.createDataFrame([(w,) for w in EXCLUDED_WORDS], "word string")
    flagged = words.join(F.broadcast(excl.withColumn("hit", F.lit(True))), "word", "left")
    # named observation: metrics reach query listeners; no per-session Observation object is left behind
    flagged = flagged.observe("excluded_words", F.count(F.when(F.col("hit"), 1)).alias("dropped"))
    kept = flagged.where(F.col("hit").isNull())
    return kept.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


@query("predict_batch")
def predict_batch(t):
    """``predict_batch_udf``: a linear model of the label, fitted on the
    table, loaded once per Python worker and applied to fixed-size batches
    of embedding vectors."""
    from pyspark.ml.functions import array_to_vector, predict_batch_udf
    from pyspark.ml.regression import LinearRegression

    d = t.embeddings.select("vec_id", F.col("label").cast("double").alias("label"), array_to_vector("embedding").alias("features"))
    m = LinearRegression(regParam=0.1, solver="normal").fit(d.where("label is not null"))
    weights, bias = np.array(m.coefficients.toArray()), float(m.intercept)

    def make_predict_fn():
        def predict(x: np.ndarray) -> np.ndarray:
            return x @ weights + bias

        return predict

    score = predict_batch_udf(make_predict_fn, return_type=T.DoubleType(), batch_size=256, input_tensor_shapes=[[len(weights)]])
    return t.embeddings.select("vec_id", score("embedding").alias("score"))

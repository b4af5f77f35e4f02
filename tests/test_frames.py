"""Matrices, neighbours, experiments, labelled frames, categories, stored
data: against numpy, pandas, brute force and planted faults."""

import math
import os

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from marquee.operators import abtest, categories, frames, linalg, neighbours
from marquee.sources import infer, replace
from marquee.sources.files import read_sound
from marquee.streaming.abtest import StreamingABTest
from marquee.streaming.models import StreamingLogisticRegression


@pytest.fixture(scope="module")
def vectors(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet").repartition(7)


@pytest.fixture(scope="module")
def matrix(vectors):
    rows = sorted(vectors.collect(), key=lambda r: r.vec_id)
    return np.array([r.embedding for r in rows], float), [r.vec_id for r in rows]


# ---------------------------------------------------------------- matrices
def test_svd_against_numpy(vectors, matrix):
    x, ids = matrix
    f = linalg.svd(vectors, "embedding")
    want = np.linalg.svd(x, compute_uv=False)
    assert np.allclose(f.s, want)
    u = {r.vec_id: r.u for r in f.u.collect()}
    u = np.array([u[i] for i in ids])
    assert np.allclose(u.T @ u, np.eye(len(f.s)), atol=1e-8)
    assert np.allclose(u * f.s @ f.v.T, x, atol=1e-8)
    few = linalg.svd(vectors, "embedding", k=3, compute_u=False)
    assert few.u is None and np.allclose(few.s, want[:3]) and few.v.shape == (x.shape[1], 3)


def test_svd_odd_rows(spark):
    rows = [(1, [3.0, 0.0]), (2, [0.0, 4.0]), (3, None), (4, [1.0, None]), (5, [6.0, 0.0])]
    df = spark.createDataFrame(rows, "id long, v array<double>")
    f = linalg.svd(df, "v")
    assert np.allclose(f.s, [math.sqrt(45), 4])
    got = {r.id: r.u for r in f.u.collect()}
    assert got[3] is None and got[4] is None and len(got[1]) == 2
    # a column that follows from the other has no singular value of its own
    flat = linalg.svd(spark.createDataFrame([(1, [1.0, 2.0]), (2, [2.0, 4.0])], "id long, v array<double>"), "v")
    assert len(flat.s) == 1
    none = linalg.svd(df.where("id < 0"), "v")
    assert none.s.size == 0 and none.u.count() == 0
    assert linalg.column_similarities(df.where("id < 0"), "v").count() == 0


def test_ragged_vectors_are_an_error(spark):
    df = spark.createDataFrame([(1, [1.0]), (2, [1.0, 2.0])], "id long, v array<double>").coalesce(1)
    with pytest.raises(Exception, match="different lengths|broadcast|dimension"):
        linalg.gram(df, "v")


def test_r_gram_and_pca(vectors, matrix):
    x, _ = matrix
    r = linalg.tsqr(vectors, "embedding")
    assert np.allclose(r.T @ r, x.T @ x) and (np.diag(r) > 0).all()
    assert np.allclose(linalg.gram(vectors, "embedding"), x.T @ x)
    p = linalg.pca(vectors, "embedding", 4)
    values = np.linalg.eigvalsh(np.cov(x.T))[::-1]
    assert np.allclose(p.variance, values[:4]) and np.allclose(p.mean, x.mean(axis=0)) and np.allclose(p.ratio, values[:4] / values.sum())


# ---------------------------------------------------------------- neighbours
def _exact(x, ids, k):
    out = {}
    for i, q in enumerate(ids):
        if q % 50 == 0:
            d = ((x - x[i]) ** 2).sum(axis=1)
            order = sorted((v, j) for v, j in zip(d, ids) if j != q)
            out[q] = order[:k]
    return out


def test_neighbours_recall(vectors, matrix):
    x, ids = matrix
    got = neighbours.nearest(vectors, vectors.where("vec_id % 50 = 0"), "vec_id", "embedding", k=10, bucket=16).collect()
    want = _exact(x, ids, 10)
    by = {}
    for r in got:
        by.setdefault(r.query, []).append(r)
    assert set(by) == set(want) and all(len(v) == 10 for v in by.values())
    hits = sum(len({r.id for r in by[q]} & {j for _, j in want[q]}) for q in want)
    assert hits >= 0.9 * 10 * len(want)
    for q, rows in by.items():
        rows.sort(key=lambda r: r.rank)
        assert [r.rank for r in rows] == list(range(1, 11)) and [r.dist for r in rows] == sorted(r.dist for r in rows)
        assert all(math.isclose(r.dist ** 2, ((x[ids.index(r.id)] - x[ids.index(q)]) ** 2).sum(), rel_tol=1e-6) for r in rows)


def test_neighbours_of_copies(spark):
    rows = [(i, [1.0, 2.0, 3.0]) for i in range(300)] + [(1000 + i, [float(i), 0.5, -1.0]) for i in range(40)] + [(5000, None), (None, [1.0, 1.0, 1.0])]
    df = spark.createDataFrame(rows, "id long, v array<double>")
    got = neighbours.nearest(df, df.where("id in (0, 7, 5000)"), "id", "v", k=3).collect()
    assert {(r.query, r.rank, r.id, r.dist) for r in got} == {(0, 1, 1, 0.0), (0, 2, 2, 0.0), (0, 3, 3, 0.0), (7, 1, 0, 0.0), (7, 2, 1, 0.0), (7, 3, 2, 0.0)}
    assert neighbours.nearest(df.where("id < 0"), df, "id", "v").count() == 0


# ---------------------------------------------------------------- experiments
def test_t_probabilities():
    # known values: df 1 is 1 - 2 atan(t) / pi; df 2 has a closed form; large df is normal
    t = np.array([0.0, 0.5, 1.0, 3.0, 12.0])
    assert np.allclose(abtest.t_two_sided(t, np.ones(5)), 1 - 2 * np.arctan(t) / np.pi)
    assert np.allclose(abtest.t_two_sided(t, np.full(5, 2.0)), 1 - t / np.sqrt(2 + t * t))
    assert np.allclose(abtest.t_two_sided(t, np.full(5, 1e7)), [math.erfc(v / math.sqrt(2)) for v in t], atol=1e-6)


def test_peace_window_and_odd_periods(spark):
    rows = [(p, g, float(v + (3 if g else 0))) for p in range(6) for g in (False, True) for v in range(4 + p)] + [(1, None, 1.0), (2, True, None), (9, True, 5.0)]
    df = spark.createDataFrame(rows, "p int, g boolean, v double")
    m = abtest.moments(df, F.col("p"), F.col("g"), F.col("v"))
    got = {r.period: r for r in abtest.test(m, peace=2, window=2).collect()}
    assert sorted(got) == [2, 3, 4, 5, 9]
    data = pd.DataFrame(rows, columns=["p", "g", "v"]).dropna()
    for last, span in ((2, [2]), (3, [2, 3]), (5, [4, 5]), (9, [5, 9])):
        a, b = (data[data.p.isin(span) & (data.g == flag)].v for flag in (False, True))
        err = a.var() / len(a) + b.var() / len(b)
        assert got[last].n_control == len(a) and got[last].n_experiment == len(b)
        assert math.isclose(got[last].statistic, (b.mean() - a.mean()) / math.sqrt(err))
    pooled = {r.period: r for r in abtest.test(m, method="student").collect()}
    assert pooled[0].df == 6 and math.isclose(pooled[0].statistic, 3 / math.sqrt(5 / 3 * 2 / 4))
    one = abtest.test(abtest.moments(df.where("g"), F.col("p"), F.col("g"), F.col("v"))).collect()
    assert all(r.statistic is None and r.p_value is None for r in one)


def test_streaming_ab_test(spark, scratch):
    src = os.path.join(scratch, "in")
    for i in range(4):
        rows = [(j % 2 == 1, float((j * 7 + i) % 13 + (2 if j % 2 else 0))) for j in range(60)]
        spark.createDataFrame(rows, "g boolean, v double").coalesce(1).write.mode("append").parquet(src)
    ab = StreamingABTest(spark, os.path.join(scratch, "state"), peace=1, window=2)
    run = ab.foreach_batch(F.col("g"), F.col("v"))
    stream = spark.readStream.schema("g boolean, v double").option("maxFilesPerTrigger", 1).parquet(src)
    q = stream.writeStream.foreachBatch(run).option("checkpointLocation", os.path.join(scratch, "ck")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    first = sorted(ab.results().collect())
    assert [r.period for r in first] == [1, 2, 3] and all(0 <= r.p_value <= 1 for r in first)
    assert [r.n_control for r in first] == [30, 60, 60]
    # a replayed batch counts once
    run(ab.spark.createDataFrame([(False, 1.0), (True, 2.0)], "g boolean, v double"), 3)
    run(ab.spark.createDataFrame([(False, 1.0), (True, 2.0)], "g boolean, v double"), 3)
    assert [r.n_control for r in sorted(ab.results().collect())] == [30, 60, 31]


def test_streaming_logistic_regression(spark):
    rng = np.random.RandomState(3)
    x = rng.normal(size=(600, 2))
    y = (x[:, 0] * 2 - x[:, 1] + 0.5 > 0).astype(float)
    df = spark.createDataFrame([(float(a), float(b), float(c)) for (a, b), c in zip(x, y)] + [(None, 1.0, 1.0)], "a double, b double, y double")
    m = StreamingLogisticRegression(2, step=2.0, rounds=25)
    run = m.foreach_batch(["a", "b"], "y")
    for i in range(3):
        run(df, i)
    run(df.where("a > 1e9"), 4)
    right = df.na.drop().where((m.probability(["a", "b"]) >= 0.5) == (F.col("y") == 1)).count()
    assert right >= 0.95 * 600 and m.w[0] > 0 > m.w[1]


# ---------------------------------------------------------------- labelled frames
def test_align_like_pandas(spark):
    a = pd.DataFrame({"k": ["x", "y", None, "z"], "n": [1.0, 2.0, 3.0, np.nan], "only": [1, 2, 3, 4]})
    b = pd.DataFrame({"k": ["y", None, "w"], "n": [5.0, 6.0, 7.0], "more": ["p", "q", "r"]})
    left, right = spark.createDataFrame(a.where(a.notna(), None)), spark.createDataFrame(b.where(b.notna(), None))
    left = left.withColumn("n", F.when(~F.isnan("n"), F.col("n")))
    for how in ("outer", "inner", "left", "right"):
        got = {r.k: r for r in frames.align(left, right, "k", how).collect()}
        pa_, pb = a.set_index("k").align(b.set_index("k"), join=how, axis=0)
        labels = [None if isinstance(i, float) else i for i in pa_.index]
        assert set(got) == set(labels)
        for i, label in enumerate(labels):
            x, y = pa_.n.iloc[i], pb.n.iloc[i]
            assert got[label].n_left == (None if np.isnan(x) else x) and got[label].n_right == (None if np.isnan(y) else y)
            assert got[label].only_right is None and got[label].more_left is None
    filled = {r.k: r.n_right for r in frames.align(left, right, "k", fill=0).select("k", "n_right").collect()}
    assert filled == {"x": 0.0, "y": 5.0, None: 6.0, "z": 0.0, "w": 7.0}
    twice = right.unionAll(right.limit(1))
    with pytest.raises(Exception, match="repeated label"):
        frames.align(left, twice, "k").select("n_left").collect()
    assert frames.align(left, twice, "k", check=False).count() == 6


def test_compare(spark):
    a = spark.createDataFrame([(1, "a", 1.0, "s"), (2, "b", None, "s"), (3, None, 3.0, "s")], "k int, x string, y double, same string")
    b = spark.createDataFrame([(1, "a", 1.5, "s"), (2, "b", None, "s"), (3, "c", 3.0, "s")], "k int, x string, y double, same string")
    got = frames.compare(a, b, "k")
    assert got.columns == ["k", "x_self", "x_other", "y_self", "y_other"]
    assert sorted(map(tuple, got.collect())) == [(1, None, None, 1.0, 1.5), (3, None, "c", None, None)]
    assert frames.compare(a, b, "k", keep_shape=True).count() == 3 and "same_self" in frames.compare(a, b, "k", keep_shape=True).columns
    assert (1, "a", "a", 1.0, 1.5) in list(map(tuple, frames.compare(a, b, "k", keep_equal=True).collect()))
    assert frames.compare(a, a, "k").collect() == [] and frames.compare(a, a, "k").columns == ["k"]
    with pytest.raises(Exception, match="different labels"):
        frames.compare(a, b.where("k < 3"), "k").collect()
    with pytest.raises(ValueError, match="different columns"):
        frames.compare(a, b.drop("x"), "k")


def test_products(spark):
    left = spark.createDataFrame([("p", 1.0, 2.0, 3.0), ("q", 0.0, None, 1.0), (None, 4.0, 5.0, 6.0)], "i string, a double, b double, c double")
    right = spark.createDataFrame([("c", 1.0, 0.5), ("a", 2.0, 0.0), ("b", 3.0, -1.0)], "l string, u double, v double")
    got = {r.i: (r.u, r.v) for r in frames.frame_dot(left, right, "i", "l").collect()}
    assert got == {"p": (11.0, -0.5), "q": (None, None), None: (29.0, -2.0)}
    for lacking in (right.where("l <> 'b'"), right.unionAll(spark.createDataFrame([("zz", 1.0, 1.0)], right.schema))):
        with pytest.raises(ValueError, match="aligned"):
            frames.frame_dot(left, lacking, "i", "l")
    part = {r.i: r.u for r in frames.frame_dot(left, right.where("l <> 'b'"), "i", "l", missing="zero").collect()}
    assert part == {"p": 5.0, "q": 1.0, None: 14.0}
    s = spark.createDataFrame([("a", 2.0), (None, 3.0)], "k string, x double")
    assert frames.series_dot(s, s, "k", "x", "x").first().dot == 13.0
    with pytest.raises(Exception, match="aligned"):
        frames.series_dot(s, s.where("k is not null"), "k", "x", "x").collect()
    assert frames.series_dot(s, s.where("k is not null"), "k", "x", "x", missing="zero").first().dot == 4.0


# ---------------------------------------------------------------- categories
def test_categories(spark):
    d = spark.createDataFrame([("lo",), ("hi",), ("mid",), (None,), ("odd",)], "c string")
    e = categories.encode(d, "c", ["lo", "mid", "hi"], ordered=True)
    assert [r.c for r in e.collect()] == [0, 2, 1, -1, -1] and categories.dictionary(e, "c") == (["lo", "mid", "hi"], True)
    more = categories.add(e, "c", ["top"])
    assert [r.c for r in more.collect()] == [0, 2, 1, -1, -1]
    assert categories.dictionary(categories.remove_unused(more, "c"), "c")[0] == ["lo", "mid", "hi"]
    turned = categories.reorder(more, "c", ["top", "hi", "mid", "lo"])
    assert [r.c for r in turned.collect()] == [3, 1, 2, -1, -1]
    named = categories.rename(turned, "c", {"hi": "HIGH"})
    assert [r.c for r in categories.decode(named, "c").collect()] == ["lo", "HIGH", "mid", None, None]
    assert [r.c for r in categories.remove(e, "c", ["lo"]).collect()] == [-1, 1, 0, -1, -1]
    assert e.where(categories.below(e, "c", "hi")).count() == 2
    joined = e.join(e.groupBy("c").count(), "c").select("c", "count")
    assert categories.dictionary(joined, "c")[0] == ["lo", "mid", "hi"]
    assert categories.dictionary(categories.encode(d, "c"), "c") == (["hi", "lo", "mid", "odd"], False)
    for wrong in (lambda: categories.add(e, "c", ["lo"]), lambda: categories.remove(e, "c", ["?"]), lambda: categories.reorder(e, "c", ["lo"]),
                  lambda: categories.rename(e, "c", ["a"]), lambda: categories.rename(e, "c", {"lo": "hi"})):
        with pytest.raises(ValueError):
            wrong()
    with pytest.raises(TypeError):
        categories.below(categories.encode(d, "c"), "c", "hi")
    with pytest.raises(TypeError):
        categories.dictionary(d, "c")


# ---------------------------------------------------------------- types of text columns
def test_types_from_all_rows(spark):
    rows = [(str(i), str(i), f"{i}.5" if i == 4_999 else str(i), "x" if i == 3_000 else "1", "true", "2020-01-02", None, "", "99999999999") for i in range(5_000)]
    rows.append(("-7", "3000000000", "1e3", "2", "FALSE", "2020-01-02T03:04:05", None, "  ", None))
    cols = ["whole", "long", "number", "mixed", "flag", "moment", "nulls", "blank", "big"]
    s = infer.schema(spark.createDataFrame(rows, ", ".join(f"{c} string" for c in cols)))
    assert [f.dataType.simpleString() for f in s.fields] == ["int", "bigint", "double", "string", "boolean", "timestamp", "string", "string", "bigint"]
    assert infer.schema(spark.createDataFrame([("2020-02-30",), ("2020-02-28",)], "d string"))["d"].dataType.simpleString() == "string"
    assert infer.schema(spark.createDataFrame([("2020-02-28",)], "d string"))["d"].dataType.simpleString() == "date"
    t = infer.typed(spark.createDataFrame([(" 7 ", "a b"), ("", "")], "n string, s string")).collect()
    assert t[0].n == 7 and t[1].n is None and t[1].s == ""


# ---------------------------------------------------------------- stored data
def _files(path):
    return {os.path.relpath(os.path.join(d, f), path) for d, _, names in os.walk(path) for f in names if f.startswith("part-")}


@pytest.fixture()
def stored(spark, scratch):
    path = os.path.join(scratch, "data")
    rows = [(i, ["a", "b:c", None][i % 3], i % 2) for i in range(30)]
    df = spark.createDataFrame(rows, "v int, p string, q int")
    df.write.partitionBy("p", "q").parquet(path)
    return path, df


def test_only_touched_partitions_are_replaced(spark, stored):
    path, df = stored
    before = _files(path)
    new = spark.createDataFrame([(100, "b:c", 1), (101, "new", 0), (102, None, 0)], df.schema)
    replace.overwrite_partitions(new, path, ["p", "q"])
    got = sorted((r.v for r in spark.read.parquet(path).collect()))
    gone = {i for i in range(30) if (i % 3 == 1 and i % 2 == 1) or (i % 3 == 2 and i % 2 == 0)}
    assert got == sorted(set(range(30)) - gone | {100, 101, 102})
    kept = {f for f in before if f.startswith("p=a/") or ("p=b" in f and "q=0" in f)}
    assert kept <= _files(path) and not [n for n in os.listdir(path) if n.startswith("_replace")]


def test_conditional_overwrite(spark, stored):
    path, df = stored
    before = _files(path)
    replace.overwrite_where(spark.createDataFrame([(200, "a", 0)], df.schema), path, ["p", "q"], "p = 'b:c' and v < 10 or p is null and q = 1")
    got = sorted(r.v for r in spark.read.parquet(path).collect())
    gone = {i for i in range(30) if (i % 3 == 1 and i < 10) or (i % 3 == 2 and i % 2 == 1)}
    assert got == sorted(set(range(30)) - gone | {200})
    untouched = {f for f in before if f.startswith("p=a/q=1") or ("HIVE_DEFAULT" in f and "q=0" in f)}
    assert untouched and untouched <= _files(path)


def test_failed_write_changes_nothing(spark, stored):
    path, df = stored
    before = _files(path)
    bad = df.withColumn("v", F.raise_error(F.lit("broken")).cast("int"))
    for run in (lambda: replace.overwrite_partitions(bad, path, ["p", "q"]), lambda: replace.overwrite_where(bad, path, ["p", "q"], "q = 1")):
        with pytest.raises(Exception, match="broken"):
            run()
        assert _files(path) >= before and spark.read.parquet(path).count() == 30
    replace.recover(spark, path)
    assert _files(path) == before


def test_recovery_after_the_journal(spark, stored, monkeypatch):
    path, df = stored
    real, calls = replace.Folder.move, []

    def move(self, a, b):
        if "/old/" in b or "/new/" in a:
            calls.append(a)
            if len(calls) == 2:
                raise OSError("lost")
        return real(self, a, b)
    monkeypatch.setattr(replace.Folder, "move", move)
    with pytest.raises(OSError, match="lost"):
        replace.overwrite_partitions(spark.createDataFrame([(7, "a", 0), (8, "a", 1)], df.schema), path, ["p", "q"])
    monkeypatch.setattr(replace.Folder, "move", real)
    replace.recover(spark, path)
    assert sorted(r.v for r in spark.read.parquet(path).where("p = 'a'").collect()) == [7, 8] and spark.read.parquet(path).count() == 22
    assert not [n for n in os.listdir(path) if n.startswith("_replace")]


def test_create_or_replace(spark, scratch):
    name, location = "marquee_t_" + os.path.basename(scratch).replace("-", "_"), os.path.join(scratch, "table")
    replace.create_or_replace(spark.range(5).toDF("a"), name, location)
    replace.create_or_replace(spark.range(7).toDF("a"), name, location)
    assert spark.table(name).count() == 7 and len(os.listdir(location)) == 1
    with pytest.raises(Exception, match="broken"):
        replace.create_or_replace(spark.range(3).select(F.raise_error(F.lit("broken")).cast("long").alias("a")), name, location)
    assert spark.table(name).count() == 7
    replace.create_or_replace(spark.range(6).selectExpr("id % 2 as p", "id as v"), name, location, by=["p"])
    assert spark.table(name).where("p = 1").count() == 3
    spark.sql(f"DROP TABLE {name}")


@pytest.mark.parametrize("fmt", ["parquet", "orc"])
def test_broken_files_cost_their_own_rows(spark, scratch, fmt):
    path = os.path.join(scratch, fmt)
    spark.range(0, 4_000, 1, 4).selectExpr("id", "repeat('x', 50) as s").write.format(fmt).save(path)
    parts = sorted(f for f in os.listdir(path) if f.startswith("part-"))
    lost = spark.read.format(fmt).load(os.path.join(path, parts[1])).count()
    with open(os.path.join(path, parts[1]), "r+b") as f:
        f.seek(0)
        f.write(b"\0" * 200)
        f.truncate(max(300, os.path.getsize(os.path.join(path, parts[1])) // 2))
    os.remove(os.path.join(path, f".{parts[1]}.crc"))
    rows, report = read_sound(spark, path, fmt, "id long, s string")
    assert rows.count() == 4_000 - lost
    bad = report.where("fault is not null").collect()
    assert [os.path.basename(r.path) for r in bad] == [parts[1]]


def test_truncated_gzip_is_reported(spark, scratch):
    path = os.path.join(scratch, "text")
    spark.range(0, 2_000, 1, 2).selectExpr("cast(id as string) as value").write.option("compression", "gzip").text(path)
    part = sorted(f for f in os.listdir(path) if f.startswith("part-"))[0]
    size = os.path.getsize(os.path.join(path, part))
    with open(os.path.join(path, part), "r+b") as f:
        f.truncate(size - 20)
    os.remove(os.path.join(path, f".{part}.crc"))
    rows, report = read_sound(spark, path, "text", "value string")
    assert rows.count() == 1_000 and report.where("fault is not null").count() == 1


def _scanned(df):
    """Rows that the file scan of an executed frame gave out."""
    df.collect()
    plan, todo = df._jdf.queryExecution().executedPlan(), []
    todo.append(plan)
    while todo:
        node = todo.pop()
        name = node.nodeName()
        if name.startswith("Scan"):
            return node.metrics().get("numOutputRows").get().value()
        if name.startswith("AdaptiveSparkPlan"):
            todo.append(node.executedPlan())
        children = node.children()
        todo.extend(children.apply(i) for i in range(children.size()))
    return None


def test_orc_bloom_filter_skips_row_groups(spark, scratch):
    d = spark.range(0, 40_000, 1, 1).selectExpr("(id * 7919) % 40000 * 2 as k", "id")
    found = {}
    for name, options in (("plain", {}), ("bloom", {"orc.bloom.filter.columns": "k", "orc.bloom.filter.fpp": "0.001"})):
        path = os.path.join(scratch, name)
        d.write.options(**{"orc.row.index.stride": "1000", **options}).orc(path)
        back = spark.read.orc(path).where("k = 39998")
        found[name] = (_scanned(back), back.count())
    assert found["plain"][1] == found["bloom"][1] == 1
    assert found["bloom"][0] < found["plain"][0] / 4


def test_nondeterministic_function_runs_once(spark):
    import random
    ticket = F.udf(lambda i: random.random(), "double").asNondeterministic()  # noqa: S311
    d = spark.range(50).select("id", ticket("id").alias("x")).select("id", (F.col("x") + 1).alias("a"), (F.col("x") + 2).alias("b")).where("a > 0")
    plan = d._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("<lambda>(") == 1
    assert all(math.isclose(r.b - r.a, 1) for r in d.collect())
    steady = F.udf(lambda i: 1.0, "double")
    assert not ticket.deterministic and steady.deterministic

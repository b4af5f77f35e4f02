"""Row counts of the estimators and the near-copy search against brute force."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from marquee.operators import near
from marquee.plans import registry


def _q(spark, sf_dir, name):
    return registry.queries()[name](spark, sf_dir)


def test_ann_join_counts_every_link(spark, scratch, monkeypatch):
    """Against brute force: copies, vectors without values, several blocks."""
    from marquee.operators import neighbours
    monkeypatch.setattr(neighbours, "BLOCK", 40)
    rng = np.random.RandomState(3)
    v = rng.normal(size=(300, 8)) * 1.5
    v[200:220] = v[0]
    rows = [(i, [float(x) for x in v[i]], 0) for i in range(300)] + [(900, None, 0)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(f"{scratch}/embeddings.parquet")
    v = v.astype(np.float32).astype(float)
    near = np.sqrt(((v[:, None] - v[None]) ** 2).sum(axis=2)) < 3.0
    got = {r.vec_id: r for r in _q(spark, scratch, "ann_join").collect()}
    assert {i: got[i].n_links for i in range(300)} == {i: int(near[i].sum()) - 1 for i in range(300)}
    assert len(got) == 301 and got[900].n_links == 0 and got[210].class_id == 0 and got[0].class_rows == 21


def test_select_takes_any_number_of_values(spark, scratch):
    """More distinct lengths than the chi-square test takes as categories."""
    n = 10_500
    docs = spark.range(n).select(F.col("id").alias("doc_id"), F.concat(F.lit("w "), F.col("id").cast("string")).alias("text"),
                                 F.lit("en").alias("lang"), F.lit("s").alias("source"), F.col("id").alias("n_chars"))
    docs.write.parquet(f"{scratch}/documents.parquet")
    docs.select("doc_id", (F.col("doc_id") > n // 2).cast("int").alias("quality"), F.lit(0).alias("toxic")).write.parquet(f"{scratch}/labels.parquet")
    rows = _q(spark, scratch, "ml_select").collect()
    assert len(rows) == n
    # the length decides the label, so it is chosen, with its own values
    assert all(abs(r.chi[0] - np.log1p(r.doc_id)) < 1e-9 for r in rows)


def test_estimators_do_not_read_texts_again(spark, sf_dir):
    """What estimators go over is kept rows, without texts or files."""
    from marquee.plans import ml
    from marquee.sources.tables import Tables
    for d in ml._doc_features(Tables(spark, sf_dir)):
        assert "text" not in d.columns and not d.inputFiles() and "FileScan" not in d._jdf.queryExecution().toString()


def test_word_vectors_are_trained_in_parts(spark, sf_dir, monkeypatch):
    from marquee.plans import ml
    seen, words = [], {}
    fit = ml.FT.Word2Vec.fit
    monkeypatch.setattr(ml.FT.Word2Vec, "fit", lambda self, d: seen.append(self.getNumPartitions()) or fit(self, d))
    for part in (10 ** 9, 1_000):
        monkeypatch.setattr(ml, "WORD2VEC_PART", part)
        words[part] = {r.word for r in _q(spark, sf_dir, "ml_word2vec").select("word").collect()}
    assert seen[0] == 1 and seen[1] > 1 and words[10 ** 9] == words[1_000]


@pytest.mark.parametrize("name", ["ml_logreg", "ml_svm", "ml_trees", "ml_bayes", "ml_fm", "ml_pipeline", "ml_select"])
def test_every_document_is_scored(spark, sf_dir, name):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    ids = sorted(r.doc_id for r in _q(spark, sf_dir, name).select("doc_id").collect())
    assert ids == sorted(r.doc_id for r in docs.select("doc_id").collect())


def test_clustered_graph_is_dealt_over_a_grid(spark, sf_dir, monkeypatch):
    """A vertex has edges in a row and a column of the parts only, both
    directions of an edge lie together, and no edge is lost; what fits one
    part of lines is left as it is."""
    from marquee.plans import ml
    seen, assign = [], ml.K.PowerIterationClustering.assignClusters
    monkeypatch.setattr(ml.K.PowerIterationClustering, "assignClusters", lambda self, d: seen.append(d) or assign(self, d))
    ids = []
    for lines in (10 ** 9, 400):
        monkeypatch.setattr(ml, "PIC_LINES", lines)
        ids.append({r.id for r in _q(spark, sf_dir, "ml_pic").collect()})
    assert ids[0] == ids[1] and "RepartitionById" not in seen[0]._jdf.queryExecution().toString()
    n = spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
    side = math.ceil(math.sqrt(n / 400))
    assert side > 2 and seen[1].rdd.getNumPartitions() == side * side
    rows = seen[1].withColumn("part", F.spark_partition_id()).collect()
    assert sorted((r.src, r.dst, r.weight) for r in rows) == sorted((r.src, r.dst, r.weight) for r in seen[0].collect())
    parts, pairs = {}, {}
    for r in rows:
        parts.setdefault(r.src, set()).add(r.part)
        parts.setdefault(r.dst, set()).add(r.part)
        pairs.setdefault(frozenset((r.src, r.dst)), set()).add(r.part)
    assert max(map(len, parts.values())) <= 2 * side - 1 and max(map(len, pairs.values())) == 1


def test_tree_regressors_keep_one_row_a_line(spark, sf_dir):
    r = _q(spark, sf_dir, "ml_tree_reg")
    assert r.count() == spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
    # a tree or forest predicts means of prices, so never outside their range
    y = spark.read.parquet(f"{sf_dir}/lineitem.parquet").agg(F.min("l_extendedprice").alias("lo"), F.max("l_extendedprice").alias("hi")).first()
    p = r.agg(F.min(F.least("dt", "rf")).alias("lo"), F.max(F.greatest("dt", "rf")).alias("hi")).first()
    assert y.lo <= p.lo <= p.hi <= y.hi


def test_tree_regressors_are_fitted_one_after_the_other(spark, sf_dir, monkeypatch):
    """Each keeps a copy of all rows while it is fitted: one copy at a time,
    made of rows that are read once."""
    from marquee.plans import ml
    running, seen = [], []
    for kind in (ml.R.DecisionTreeRegressor, ml.R.RandomForestRegressor, ml.R.GBTRegressor, ml.R.FMRegressor):
        def fit(self, d, name=kind.__name__, fit=kind.fit):
            running.append(name)
            seen.append((list(running), d))
            try:
                return fit(self, d)
            finally:
                running.remove(name)
        monkeypatch.setattr(kind, "fit", fit)
    r = _q(spark, sf_dir, "ml_tree_reg")
    assert [x for x, _ in seen] == [["DecisionTreeRegressor"], ["RandomForestRegressor"], ["GBTRegressor"], ["FMRegressor"]]
    assert all(not d.inputFiles() for _, d in seen) and {"dt", "rf", "gbt", "fm"} < set(r.columns)


def _near_components(texts, words=5):
    """Components by brute force over all pairs."""
    def shingles(text):
        w = (text or "").lower().split()
        return {tuple(w[i:i + words]) for i in range(len(w) - words + 1)} if len(w) >= words else {tuple(w)} if w else set()
    sets, up = {i: shingles(x) for i, x in texts.items()}, {i: i for i in texts}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i
    for a in texts:
        for b in texts:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                up[max(x, y)] = min(x, y)
    return {i: root(i) for i in texts}


def test_near_duplicates_lose_no_link(spark):
    """Every pair of a bucket counts, whichever documents lie between."""
    rng = random.Random(12)
    base = [f"w{rng.randrange(400)}" for _ in range(60)]
    other = [f"v{rng.randrange(400)}" for _ in range(60)]

    def changed(words, n):
        w = list(words)
        for _ in range(n):
            w[rng.randrange(len(w))] = f"x{rng.randrange(10_000)}"
        return " ".join(w)
    texts = {}
    for i in range(0, 80, 2):
        texts[i], texts[i + 1] = changed(base, rng.randrange(3)), changed(other, rng.randrange(3))
    texts |= {100 + i: " ".join(base[:30 + i]) for i in range(30)}           # a chain of ever longer texts
    texts |= {200: None, 201: "", 202: "  ", 203: "One two", 204: "one  TWO", 205: "one two three"}
    df = spark.createDataFrame(list(texts.items()) + [(None, " ".join(base))], "id long, text string").repartition(4)
    got = {r.id: r.component for r in near.near_components(df, "id", "text").collect()}
    assert got == _near_components(texts)
    assert near.near_components(df.where("id < 0"), "id", "text").count() == 0


def test_star_round_settles_a_group_of_copies(spark):
    words = [f"w{i}" for i in range(200)]
    rows = [(i, " ".join(words) + f" tail{i}") for i in range(300)]
    got = {r.component for r in near.near_components(spark.createDataFrame(rows, "id long, text string"), "id", "text").collect()}
    assert got == {0}


def _exchanges(node) -> int:
    """Shuffles of a plan, without those of tables that it finds kept."""
    kids = node.children()
    return (node.nodeName() == "Exchange") + sum(_exchanges(kids.apply(i)) for i in range(kids.size()))


def test_near_rounds_do_not_shuffle_all_sets(spark, monkeypatch):
    """The checks of a round move pairs and one set a pair, not every set."""
    class Seen(Exception):
        pass

    plans, plain = [], type(spark.range(0)).checkpoint

    def watch(df, *args):
        if "near" in df.columns:
            plans.append(df._jdf.queryExecution().executedPlan().initialPlan())
            raise Seen
        return plain(df, *args)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    monkeypatch.setattr(type(spark.range(0)), "checkpoint", watch)
    try:
        with pytest.raises(Seen):
            near.near_components(spark.createDataFrame([(i, f"{'a b c d e f g h ' * 5}{i}") for i in range(20)], "id long, text string"), "id", "text")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.catalog.clearCache()
    # distinct pairs, pairs to the first set, these to the second
    assert _exchanges(plans[0]) == 3


def test_sketches_never_rule_out_a_link(spark):
    rng = random.Random(3)
    sets = []
    for i in range(60):
        if i % 4:
            own = sets[-1][:]
            for _ in range(rng.randrange(len(own) // 6 + 2)):
                own[rng.randrange(len(own))] = rng.getrandbits(63) - 2 ** 62
        else:
            own = [rng.getrandbits(63) - 2 ** 62 for _ in range(rng.choice([1, 3, 10, 80, 600]))]
        sets.append(own)
    # a rep that stands for two texts is never ruled out
    df = spark.createDataFrame([(i, i, s) for i, s in enumerate(sets)] + [(0, 100, [5])], "rep long, class long, sh array<long>")
    sig = near.signatures(df, 1, 1).drop("keys")
    may = {(r.a, r.b) for r in sig.alias("f").crossJoin(sig.alias("r")).where(near._may_link(80)).selectExpr("f.rep a", "r.rep b").collect()}
    links = {(a, b) for a in range(60) for b in range(60) if 100 * len(set(sets[a]) & set(sets[b])) >= 80 * len(set(sets[a]) | set(sets[b]))}
    assert links <= may and all((0, b) in may for b in range(60)) and len(may) < 1_000

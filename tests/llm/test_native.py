"""Threshold sketches and license scans against brute force."""

import hashlib
import math
import random
import re

import pytest
from helpers import ODD_ROWS, alnum, empty_docs, odd_docs
from pyspark.sql import functions as F

from marquee.llm import license_join, queries, threshold_sketch


@pytest.mark.parametrize("extra", [False, True])
def test_half_edits(spark, extra):
    got = {r.id: r for r in threshold_sketch.half_edits(odd_docs(spark, extra).repartition(5)).collect()}
    texts = [r[1] or "" for r in sorted(ODD_ROWS)]
    assert len(got) == len(ODD_ROWS)
    for i, (doc_id, t) in enumerate(zip(sorted(r[0] for r in ODD_ROWS), texts)):
        following, half = texts[(i + 1) % len(texts)], len(t) // 2
        assert (got[doc_id].edited, got[doc_id].n_chars) == (t[:len(t) - half] + following[:half], len(t)), doc_id
        after = sorted(r[0] for r in ODD_ROWS)[(i + 1) % len(texts)]
        assert got[doc_id].next_sketch == got[after].sketch
    assert got[1].sketch == got[2].sketch == got[3].sketch == [] and got[7].sketch == got[8].sketch


def test_half_edits_small_tables(spark):
    assert threshold_sketch.half_edits(empty_docs(spark)).count() == 0
    one = threshold_sketch.half_edits(odd_docs(spark).where("doc_id = 16")).collect()
    t = [r[1] for r in ODD_ROWS if r[0] == 16][0]
    assert [r.edited for r in one] == [t[:len(t) - len(t) // 2] + t[:len(t) // 2]]
    twice = odd_docs(spark).unionByName(odd_docs(spark))
    assert threshold_sketch.half_edits(twice).count() == 2 * len(ODD_ROWS)


def test_threshold_merge_and_containment(spark):
    rng = random.Random(7)
    words = [f"w{rng.randrange(100_000)}" for _ in range(6_000)]
    short, long_, other = " ".join(words[1000:2000]), " ".join(words), " ".join(f"x{i}" for i in range(3_000))
    df = spark.createDataFrame([(short, long_, other)], "a string, b string, c string").select(
        *[threshold_sketch.sketch(F.col(c)).alias(c) for c in "abc"])
    r = df.select(
        threshold_sketch.containment(F.col("a"), F.col("b")).alias("inside"), threshold_sketch.containment(F.col("a"), F.col("c")).alias("outside"),
        threshold_sketch.likeness(F.col("a"), F.col("b")).alias("like"), F.size("b").alias("n"),
        (threshold_sketch.merge(F.col("b"), F.col("c")) == threshold_sketch.merge(F.col("c"), F.col("b"))).alias("same"),
        F.size(threshold_sketch.merge(F.col("b"), F.col("c"))).alias("both"), F.size("c").alias("m")).first()
    assert r.inside == 1.0 and r.outside < 0.05 and abs(r.like - 1 / 6) < 0.05
    assert abs(r.n / 5996 - 0.125) < 0.02 and r.same and r.n + r.m - 2 <= r.both <= r.n + r.m


def test_sketch_query_columns(spark, sf_dir):
    r = queries.op6_sketch(spark, sf_dir)
    row = r.orderBy("doc_id").first()
    assert len(row.edited_sha256) == 64 and 0 <= row.near_edited <= 1 and 0 <= row.near_next <= 1
    sample = r.orderBy("doc_id").limit(2).collect()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").limit(2).collect()
    t, u = docs[0].text, docs[1].text
    assert sample[0].edited_sha256 == hashlib.sha256((t[:len(t) - len(t) // 2] + u[:len(t) // 2]).encode()).hexdigest()


def brute_places(text):
    w = alnum(text)
    places, labels = [], set()
    for phrase, label in license_join.PHRASES.items():
        q = phrase.split()
        at = [i for i in range(len(w) - len(q) + 1) if w[i:i + len(q)] == q]
        places += at
        labels |= {label} if at else set()
    return len(w), sorted(places), sorted(labels)


LICENSED = [
    (1, "Released under the MIT License.\nText. CC BY-NC cc by nc cc by nc"), (2, "under the MIT licence"), (3, None), (4, ""),
    (5, "This work is licensed under the GNU General Public License, version 3."), (6, "licensed under the Apache-License (version 2)"),
    (7, "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License"),
    (8, "the license of this work. under version 2 the mit"), (9, "under under the mit license the mit license version 2 apache license version 2"),
    (10, "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation"),
    (11, "x " * 5000 + "under the mit license"), (12, "This work is licensed under the Creative Commons Attribution License"),
    (1, "Released under the MIT License.\nText. CC BY-NC cc by nc cc by nc"), (13, "İ under the mİt license K"),
]


def test_license_places_and_templates(spark):
    df = spark.createDataFrame([(*r, "clash", "clash") for r in LICENSED], "doc_id long, text string, labels string, row string")
    rows = license_join.scan(df).collect()
    assert len(rows) == len(LICENSED)
    texts = dict(LICENSED)
    for r in rows:
        assert (r.n_words, sorted(r.places), r.base_labels) == brute_places(texts[r.id]), r.id
        assert set(r.base_labels) <= set(r.labels) and 0 <= r.score <= 1
    labels = {r.id: r.labels for r in rows}
    assert labels[5] == ["gpl-3"] and labels[7] == ["gpl", "lgpl"] and labels[10] == ["mit"] and labels[12] == ["cc-by"]
    assert labels[8] == labels[3] == labels[4] == []
    assert license_join.scan(df.limit(0)).count() == 0


def brute_labels(text, percent=80):
    """Labels of every block at the threshold; of relatives the best."""
    templates = [(t.split(), set(t.split()), label, set(tells.split())) for t, (label, tells) in license_join.TEMPLATES.items()]
    blocks = [(alnum(b), False) for b in re.split(r"\n|[.!?;]\s", text or "")]
    blocks += [(alnum(b), True) for b in re.split(r"\n\s*\n|[.!?;]\s", text or "") if "\n" in b]
    out = set()
    for w, windows in blocks:
        hits = []
        for i, (seq, t, label, tells) in enumerate(templates):
            reach = math.ceil(len(seq) / (percent / 100))
            places = [set(w[k:k + reach]) for k in range(max(1, len(w) - reach + 1))] if windows else [set(w)]
            shared = max(len(t & p) for p in places)
            if 100 * shared >= percent * len(t):
                hits.append((i, shared / len(t), tells <= set(w), label))
        out |= {h[3] for h in hits if not any(
            100 * len(templates[g[0]][1] & templates[h[0]][1]) >= percent * len(templates[h[0]][1]) and g[1:3] > h[1:3] for g in hits if g[0] != h[0])}
    return sorted(out | set(brute_places(text)[2]))


def test_license_join_is_exact(spark):
    """Template hits equal a plain containment test of every block."""
    rng = random.Random(11)
    words = sorted({w for t in license_join.TEMPLATES for w in t.split()}) + ["lorem", "ipsum"]
    rows = []
    for i in range(400):
        t = rng.choice(list(license_join.TEMPLATES)).split()
        t = [w for w in t if rng.random() > 0.15] + rng.sample(words, rng.randrange(4))
        if rng.random() < 0.5:
            rng.shuffle(t)
        if rng.random() < 0.5 and len(t) > 2:
            t.insert(rng.randrange(1, len(t)), "\n")
        rows.append((i, " ".join(t) + rng.choice([".\n", "! ", "\n", "\n\n"]) + " ".join(rng.sample(words, 5))))
    got = {r.id: r.labels for r in license_join.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, text in rows:
        assert got[i] == brute_labels(text), text


CHANGED = [
    (1, ["mit"], "permission is hereby given free of charge to any person obtaining a copy of this software and associated documentation files"),
    (2, ["bsd"], "distribute and use in source and binary forms with or without modification are permitted"),
    (3, ["isc"], "for any purpose permission is granted to use copy modify or distribute this software with or without fee"),
    (4, ["isc"], "for any purpose permission is granted\nto use copy modify or distribute\nthis software with or without fee"),
    (5, ["gpl"], "you can redistribute it and or modify it under the terms of the gnu general public license"),
]


def test_changed_and_reordered_notices(spark, tmp_path):
    """Changed words and order are no reason to drop a block, and the SQL twin
    knows the same blocks."""
    import duckdb
    rows = [(i, t) for i, _, t in CHANGED] + [(100 + i, t) for i, _, t in WRAPPED] + [(200 + i, t) for i, t in LICENSED[:-2]]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.id: r.labels for r in license_join.scan(df).collect()}
    for i, labels, _ in CHANGED:
        assert got[i] == labels, i
    for i, text in rows:
        assert got[i] == brute_labels(text), text
    df.write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.sql(f"create view documents as select * from read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    rel = con.sql(queries.oracle_sql()["op7_licenses"])
    want = sorted(rel.fetchall(), key=repr)
    assert sorted((tuple(r[c] for c in rel.columns) for r in queries.op7_licenses(spark, str(tmp_path)).collect()), key=repr) == want


WRAPPED = [
    (1, ["mit"], "MIT License\n\nPermission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files "
     "(the \"Software\"), to deal\nin the Software without restriction, including without limitation the rights"),
    (2, ["bsd"], "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions are met:"),
    (3, ["gpl"], "# This program is free software: you can redistribute it and/or modify\n# it under the terms of the GNU General Public License as published by\n# the Free Software Foundation"),
    (4, ["isc"], "Permission to use, copy, modify, and/or distribute this software for any\r\npurpose with or without fee is hereby granted, provided that the above"),
    (5, ["agpl", "gpl"], "x" * 9 + " y" * 3000 + "\nyou can redistribute it\nand/or modify it under the terms of the\nGNU Affero General Public\nLicense"),
    (6, ["bsd"], "modification permitted forms or are with without\nand binary source in use and redistribution"),      # the order is free
    (7, [], "Redistribution and use in source and binary forms, with or without\n\nmodification, are permitted"),    # two paragraphs
    (8, [], "Redistribution and use in source and binary forms.\nWith or without modification, are permitted"),         # two sentences
    (9, [], "redistribution\n" + "and " * 40 + "use in source and binary\n" + "lorem " * 40 + "forms with or without modification are permitted"),
    (10, ["lgpl", "gpl"], " * modify it under\n * you can redistribute it and/or modify it\n * under the terms of the GNU Lesser General\n * Public License"),
]


def test_wrapped_notices(spark):
    """Notices over several lines are found, words strewn over lines are not."""
    rows = [(i, t) for i, _, t in WRAPPED] + [(100 + i, "Lead in.\n\n" + "lorem ipsum\n" * 50 + t + "\nlorem ipsum") for i, _, t in WRAPPED]
    got = {r.id: r for r in license_join.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert len(got) == len(rows)
    for i, labels, _ in WRAPPED:
        assert got[i].labels == sorted(labels) and got[100 + i].labels == sorted(labels), i
        assert (got[i].score >= 0.8) == bool(labels)

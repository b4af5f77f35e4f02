"""The registered queries: columns of their contracts, SQL twins, empty tables."""

import math

import duckdb
import pytest

from marquee.llm import queries

COLUMNS = {
    "op1_extract": ["page_id", "url", "text", "n_chars"],
    "op2_lattice_lm": ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
    "op3_language_id": ["doc_id", "held_out", "lang_pred", "score"],
    "op4_jaccard_join": ["doc_id", "n_shingles", "component_id"],
    "op5_toxicity": ["doc_id", "held_out", "score", "predicted"],
    "op6_sketch": ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
    "op7_licenses": ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"],
    "op8_mix": ["doc_id", "domain", "lang", "source", "n_tokens", "epoch"],
    "op9_shards": ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"],
    "op11_quality": ["doc_id", "held_out", "score", "predicted"],
    "op12_prefix_trie": ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"],
    "op13_search": ["item_id", "rank", "doc_id", "score"],
    "op10_decontaminate": ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
}


def test_one_query_for_each_operator():
    assert set(queries.queries()) == set(COLUMNS)


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_rows_and_columns(spark, sf_dir, name):
    df = queries.queries()[name](spark, sf_dir)
    assert df.columns[:len(COLUMNS[name])] == COLUMNS[name]
    table = "pages" if name == "op1_extract" else "documents"
    if name not in ("op8_mix", "op12_prefix_trie", "op13_search"):
        assert df.count() == spark.read.parquet(f"{sf_dir}/{table}.parquet").count()


def _plain(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return None
    return round(float(v), 6) if isinstance(v, (int, float)) and not isinstance(v, bool) else v


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_sql_twins(spark, sf_dir, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations"):
        con.sql(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    rel = con.sql(queries.oracle_sql()[name])
    cols = sorted(rel.columns)
    want = sorted((tuple(_plain(dict(zip(rel.columns, r))[c]) for c in cols) for r in rel.fetchall()), key=repr)
    df = queries.queries()[name](spark, sf_dir)
    assert sorted(df.columns) == cols
    assert sorted((tuple(_plain(r[c]) for c in cols) for r in df.collect()), key=repr) == want

"""The corpus pipeline over ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and reread as the next stage's ``docs``.  All but the
last return the columns of ``documents``.

Cases, alike in all stages: an empty table gives an empty result; NULL and
empty texts are not toxic, near no other text and without benchmark words,
so they stay until mixing, where they are read with the epoch at their
place; rows with a NULL id are in no group of near copies; repeated rows
are judged alike, and of near copies (repeated ids too) one row stays;
further columns are kept as they are, whatever they are called, but for the
four that sharding adds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import functions as F

from marquee.llm import kk_shards, prefix_join, source_mix, suffix_decontam, toxic_grammar
from marquee.llm.queries import MIX_WEIGHTS, with_domain
from marquee.llm.store import Scratch, packed, unpacked
from marquee.sources.tables import table


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity grammar scores under 0.5 stay."""
    model = toxic_grammar.fit(docs, table(spark, sf_dir, "labels"))
    return toxic_grammar.keep_clean(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five words, 0.8) the document with the
    smallest doc_id stays; documents without words are in no group and stay."""
    return prefix_join.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no ten-word window of a benchmark item stay."""
    return suffix_decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Domains, languages and sources are brought to MIX_WEIGHTS within eight
    tenths of all tokens; every document is read once at most.  Columns that
    are called like those of the mix (domain, n_tokens, epoch) keep their values."""
    rows = packed(docs, doc_id=F.col("doc_id"), text=F.col("text"), lang=F.col("lang"), source=F.col("source"))
    mixed = source_mix.mix(with_domain(rows), ["domain", "lang", "source"], MIX_WEIGHTS, share=0.8, epochs=1)
    return mixed.select(*unpacked(docs.columns))


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Eight shards of near-equal bytes: documents with size, text_crc32,
    shard and slot."""
    return kk_shards.shard_by_bytes(docs, 8)


STAGES = [("toxicity", toxicity), ("near_duplicates", near_duplicates), ("decontamination", decontamination),
          ("mixing", mixing), ("sharding", sharding)]

#: The toxicity model and the differencing of shards have no SQL form; the
#: pipeline is tested stage by stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and reread."""
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = scratch.save(docs, f"{i}-{name}")
    return docs

"""Prepare a corpus for training: a chain of stages over ``documents``.

Quality classifier, exact dedup, near-duplicate join, mixing to target weights, packing. Each
stage takes all its predecessor kept, as a written table, and returns the columns of ``documents``; the last one
returns the bins. Mixing never discards: a rate is at least 1, and what a domain lacks is made up
by repeating its documents, whose copies packing then keeps out of each other's bins.

NULLs may stand in any column. A NULL or blank text is scored by its site alone, is the same text
as every other blank one, links with nothing, has rate 1 and packs as one end mark. Very long texts
go through whole. Rows repeated in full are copies of one text, of which one stays. Columns that
``documents`` has beside its own are carried up to packing, whatever their names, and an empty
table gives no bins.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerwake.llm import bin_packing, domain_mix, exact_dedup, jaccard_join, site_quality
from ledgerwake.llm.common import read_table, staged
from ledgerwake.llm.queries import RANKS, TARGETS, labelled_domains, site
from ledgerwake.llm.ship import ship

# Near duplicates: shingles of five words, likeness of 0.8 or more.
NEAR = jaccard_join.Rule(width=5, percent=80)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return site_quality.keep_good(docs, read_table(spark, sf_dir, "labels"), **site(docs))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return exact_dedup.survivors(docs, written=True)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return jaccard_join.representatives(docs, NEAR, written=True)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    labelled = labelled_domains(docs, read_table(spark, sf_dir, "labels"))
    return domain_mix.mixed_corpus(docs, labelled, TARGETS, written=True, least=1.0, cover=True,
                                   vocabulary=RANKS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return bin_packing.table(docs, RANKS)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("quality", quality), ("exact_dedup", exact), ("near_dedup", near), ("mix", mix),
    ("pack", pack)]
# A classifier, exact near-duplicate components and packing are beyond SQL; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``; each one reads what its predecessor wrote."""
    docs = read_table(spark, sf_dir, "documents")
    for position, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if position + 1 < len(STAGES):
            docs = staged(docs, name)
    return docs

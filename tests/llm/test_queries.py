"""The registered queries, the SQL of those that have it, and the pipeline as a whole."""

from __future__ import annotations

from collections import Counter

from tokenizers import Tokenizer

import corpus_pipeline
from ledgerwake.llm import queries
from tests.compare import connect, difference
from tests.llm import cases
from tests.llm.test_set_operators import expected_join
from tests.llm.test_text_operators import expected_dedup

NUMBERS = range(1, 14)


def test_one_query_for_each_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in queries.QUERIES) == list(NUMBERS)
    assert queries.ORACLE_SQL.keys() <= queries.QUERIES.keys()


def test_queries_match_their_sql(spark):
    con = connect(cases.SF_DIR)
    for name, sql in queries.ORACLE_SQL.items():
        assert difference(spark, con, queries.QUERIES[name], sql, cases.SF_DIR) is None, name


def test_pipeline_stage_by_stage(spark, tmp_path):
    docs = spark.read.parquet(f"{cases.SF_DIR}/documents.parquet")
    columns = docs.columns
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        stage(spark, docs, cases.SF_DIR).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        seen[name] = before, docs
        if name != "pack":
            assert docs.columns == columns
    before, after = seen["quality"]
    labels = {r.doc_id: r.quality for r in spark.read.parquet(
        f"{cases.SF_DIR}/labels.parquet").collect()}
    kept = {r.doc_id for r in after.collect()}
    judged = [(i in kept) == bool(q) for i, q in labels.items()]
    assert sum(judged) > 0.95 * len(judged)
    before, after = seen["exact_dedup"]
    assert Counter(r.doc_id for r in after.collect()) == Counter(
        r[0] for r in expected_dedup(cases.pairs(before)) if r[3])
    before, after = seen["near_dedup"]
    groups = expected_join(cases.pairs(before), corpus_pipeline.NEAR)
    assert {r.doc_id for r in after.collect()} == {r[2] for r in groups}
    before, after = seen["mix"]
    assert {r.doc_id for r in after.collect()} == {r.doc_id for r in before.collect()}
    before, after = seen["pack"]
    wanted, coder = Counter(), Tokenizer.from_file(queries.VOCABULARY)
    for i, t in cases.pairs(before):
        wanted[i] += len(coder.encode(t or "", add_special_tokens=False).ids) + 1
    packed = Counter()
    for r in after.collect():
        packed[r.doc_id] += r.n_tokens
    assert packed == wanted


def test_pipeline_on_odd_rows_and_clashing_columns(spark, tmp_path):
    """NULLs, blanks, long texts, ties, repeats and columns that clash with the operators' own."""
    folder = str(tmp_path / "in")
    cases.corpus(spark).write.parquet(f"{folder}/documents.parquet")
    spark.read.parquet(f"{cases.SF_DIR}/labels.parquet").write.parquet(f"{folder}/labels.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = set(cases.pairs(docs))
        stage(spark, docs, folder).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        assert docs.columns == columns
        kept[name] = set(cases.pairs(docs))
        assert kept[name] <= before
    same = [{i for i, t in cases.pairs(cases.corpus(spark)) if not "".join(cases.words_of(t))}]
    assert len({i for i, t in kept["exact_dedup"] if not cases.words_of(t)} & same[0]) == 1
    assert len(kept["exact_dedup"] & {(10_010, t) for _, t in kept["quality"]}) <= 2
    assert kept["mix"] == kept["near_dedup"]
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, folder).collect()
    assert {r.doc_id for r in packed} == {i for i, _ in kept["mix"]}


def test_pipeline_of_nothing(spark, tmp_path):
    folder = str(tmp_path / "in")
    cases.none(spark).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(
        f"{folder}/labels.parquet")
    assert corpus_pipeline.run(spark, folder).count() == 0

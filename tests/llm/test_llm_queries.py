"""The registered queries, their SQL twins and the pipeline on the smallest tables."""

import math
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from gleanery.llm import common, exact_dedup, ngram_join, quality, queries, secrets


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_matches_its_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    twin = con.execute(queries.oracle_sql()[name])
    names = [c[0] for c in twin.description]
    got = queries.queries()[name](spark, sf_dir)
    assert sorted(got.columns) == sorted(names)
    assert Counter(tuple(r) for r in got.select(*names).collect()) == Counter(twin.fetchall())


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_queries_return_a_row_for_each_document(spark, sf_dir, name):
    got = queries.queries()[name](spark, sf_dir).collect()
    docs = common.table(spark, sf_dir, "documents").count()
    if name.startswith(("op12", "op13")):  # a row for each word or phrase
        assert got
    elif name.startswith("op8"):
        assert len(got) == 10 * math.ceil(common.table(spark, sf_dir, "embeddings").count() / 100)
    elif name.startswith("op9"):
        assert len({r.doc_id for r in got}) == docs
    else:
        assert len(got) == docs


def test_pipeline(spark, sf_dir, tmp_path):
    import corpus_pipeline

    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "exact_dedup", "ngram_jaccard_join", "secret_scans", "best_fit_packing"]
    docs = common.table(spark, sf_dir, "documents")
    model = quality.fit(docs, common.table(spark, sf_dir, "labels"))
    good = {r.doc_id for r in quality.score(docs, model).where("predicted = 1").collect()}
    text = {r.doc_id: r.text for r in docs.collect()}
    last = {}
    for d in sorted(good):
        last["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text[d])] = d
    alone = set(last.values())
    from test_ngram_join import classes

    left = {d for d, _, c in classes([(d, text[d]) for d in sorted(alone)]) if c == d}
    want = {d: redacted(text[d]) for d in left}
    root = f"file://{tmp_path}/run"
    first = corpus_pipeline.run(spark, sf_dir, root)
    again = corpus_pipeline.run(spark, sf_dir)  # a run of its own, which leaves the first one's result alone
    packed = first.collect()
    assert sorted(packed) == sorted(again.collect())
    cleaned = spark.read.parquet(f"{root}/secret_scans")
    assert cleaned.columns == docs.columns
    assert {r.doc_id: r.text for r in cleaned.collect()} == want
    assert cleaned.where(F.length("text") != F.col("n_chars")).count() == 0
    assert {r.doc_id for r in packed} == left
    assert 0 < len(left) < len(alone) <= len(good) < len(text)


ODD = [
    (7, "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty and more words here"),
    (3, "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty and more words here too"),
    (7, "another text altogether that shares its number with the first one and must stay whatever becomes of that"),
    (None, "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty and more words here two"),
    (None, "alone without a number"), (8, "Same TEXT"), (8, "same text"), (9, None), (10, ""), (11, "token=abcdefghijklmnop1"),
]


def stage_after_stage(spark, docs, tmp_path, stages):
    for name, stage in stages:
        stage(spark, docs, "/root/testdata/sf0.001").write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
    return docs


def test_pipeline_on_odd_rows(spark, on_disk, tmp_path):
    """Repeated and null ids, equal texts, null texts, and columns (file, row, node, label ...) that operators use themselves."""
    import corpus_pipeline

    docs = on_disk(ODD)
    done = stage_after_stage(spark, docs, tmp_path, corpus_pipeline.STAGES[1:4])
    assert done.columns == docs.columns
    got = sorted(((r.doc_id, r.text) for r in done.collect()), key=repr)
    # null and empty texts are equal: 10 stays; of the near copies 3 does; of rows 8 one; the other row 7 is no copy
    texts = {t for _, t in got}
    assert len(got) == 6 and {d for d, _ in got} == {3, 7, None, 8, 10, 11} and ODD[2][1] in texts and "token=" not in " ".join(t or "" for t in texts)
    packed = corpus_pipeline.packed(spark, done, "").collect()
    assert len(packed) == 6


def test_pipeline_on_an_empty_table(spark, on_disk, tmp_path):
    import corpus_pipeline

    docs = on_disk([], "empty")
    done = stage_after_stage(spark, docs, tmp_path, corpus_pipeline.STAGES[:4])
    assert done.columns == docs.columns and done.count() == 0 and corpus_pipeline.packed(spark, done, "").count() == 0


def test_scratch_tables_go_with_their_scope(spark, on_disk):
    docs = on_disk([(1, "a"), (2, "A")])
    outside = exact_dedup.exact_duplicates(docs)
    with common.scratch(spark):
        assert exact_dedup.exact_duplicates(docs).count() == 2
    assert outside.count() == 2


def redacted(text):
    out, at = [], 0
    for a, _, b in secrets.scan(text)[1]:
        if a >= at:
            out += [text[at:a], "[SECRET]"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def test_nothing_else_imports_this_subpackage():
    from pathlib import Path

    top = Path(queries.__file__).parent.parent
    for p in top.rglob("*.py"):
        if p.parent.name != "llm":
            assert ".llm" not in p.read_text() and "import llm" not in p.read_text(), p

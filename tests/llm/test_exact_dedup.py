import hashlib

import pytest

from gleanery.llm import exact_dedup

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ROWS = [(1, "Same text"), (2, "same TEXT"), (3, "other"), (9, "same text"), (4, "É"), (5, "é"), (6, None), (7, ""), (8, "Straße" * 3000), (10, "STRAßE" * 3000), (11, "k"), (12, "K")]


def expected(rows):
    body = {d: (t or "").translate(LOWER) for d, t in rows}
    same = {}
    for d, b in body.items():
        same.setdefault(b, []).append(d)
    return sorted((d, max(same[b]), len(same[b]), d == max(same[b]), hashlib.sha256(b.encode()).hexdigest()) for d, b in body.items())


@pytest.mark.parametrize("digest_of", [None, lambda data: "one", lambda data: str(len(data))])
def test_groups(spark, on_disk, digest_of):
    got = exact_dedup.exact_duplicates(on_disk(ROWS), digest_of)
    assert sorted((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in got.collect()) == expected(ROWS)


def test_repeated_and_null_ids(spark, on_disk):
    got = exact_dedup.exact_duplicates(on_disk([(1, "a"), (1, "a"), (None, "A"), (None, "b"), (None, "b")])).collect()
    assert sorted((r.keep_id is None, r.group_size, r.kept) for r in got) == [(False, 3, False), (False, 3, False), (False, 3, True), (True, 2, False), (True, 2, True)]


def test_empty_table(spark, on_disk):
    assert exact_dedup.exact_duplicates(on_disk([])).collect() == []


def test_one_group_of_many(spark, on_disk):
    got = exact_dedup.exact_duplicates(on_disk([(i, "copy") for i in range(3000)], parts=9))
    assert {(r.keep_id, r.group_size) for r in got.collect()} == {(2999, 3000)} and got.where("kept").count() == 1


def test_the_state_lasts(spark, tmp_path):
    """Files are added, the state goes on: a larger doc_id in the second batch moves what stays; the first files are not digested again."""
    table, state = f"file://{tmp_path}/docs", f"file://{tmp_path}/state"
    rows = [(1, "a"), (2, "A"), (3, "b"), (4, "c")]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(2).write.parquet(table)

    def found():
        got = exact_dedup.exact_duplicates(spark.read.parquet(table), state=state, batch_files=1).collect()
        return sorted((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in got)

    assert found() == expected(rows)
    assert found() == expected(rows)  # nothing new
    more = [(9, "a"), (8, "B"), (7, "d")]
    spark.createDataFrame(more, "doc_id long, text string").repartition(1).write.mode("append").parquet(table)
    assert found() == expected(rows + more)
    log = spark.read.parquet(f"{state}/log")
    assert log.count() == 7 and log.select("doc_id").distinct().count() == 7
    assert spark.read.parquet(f"{state}/out").select("batch").distinct().count() > 1


def test_hot_digests_are_compared_in_parts(spark, on_disk):
    rows = [(i, "copy" if i % 2 else "other copy") for i in range(5000)] + [(9000 + i, f"own {i}") for i in range(100)]
    got = exact_dedup.exact_duplicates(on_disk(rows), lambda data: str(len(data)))
    assert sorted((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in got.collect()) == expected(rows)

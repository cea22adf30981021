"""The stages against brute force, each on its own input, and the whole run."""

import corpus_pipeline as C
from tests.llm import test_native, test_near_dedup, test_secret_scan, test_substring_dedup
from tests.llm.corpus import SCHEMA, rows


def test_stages_and_run(spark, tmp_path):
    data = [*rows(), *[(r[0] + 500, *r[1:]) for r in rows(8)]]
    spark.createDataFrame(data, SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    at = docs
    for k, (name, stage) in enumerate(C.STAGES):
        before = [tuple(r) for r in at.collect()]
        at = stage(spark, at, str(tmp_path))
        at.write.parquet(str(tmp_path / f"out-{k}"))
        at = spark.read.parquet(str(tmp_path / f"out-{k}"))
        after = [tuple(r) for r in at.collect()]
        if k < 4:
            assert at.columns == docs.columns
        if k == 0:
            ok = {d for d, t, *_ in before if (m := test_native.brute(t))[0] >= 50 and 100 * m[4] <= 50 * m[0]}
            assert {r[0] for r in after} <= ok and all(r in before for r in after)
        elif k == 1:
            want = test_near_dedup.brute(before)
            assert {r[0] for r in after} == {d for d, (_, c) in want.items() if d == c}
        elif k == 2:
            want = {d: (n, kept) for d, _, n, kept in test_substring_dedup.brute(before)}
            texts = {r[0]: r[1] for r in before}
            assert len(after) == len(before) and all((r[1].encode() == want[r[0]][1]) if want[r[0]][0] else r[1] == texts[r[0]] for r in after)
        elif k == 3:
            assert len(after) == len(before) and all(test_secret_scan.base(r[1]) == "" for r in after)
        else:
            assert {r[0] for r in after} == {r[0] for r in before}
            last = sorted(after)
    again = sorted(tuple(r) for r in C.run(spark, str(tmp_path)).collect())
    assert [r[:5] for r in again] == [r[:5] for r in last]


def test_empty(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    assert C.run(spark, str(tmp_path)).count() == 0

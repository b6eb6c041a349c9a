"""Versioned tables: conflicts, half-written versions, compaction."""

import pytest
from pyspark.sql import types as T

from pedalgrid.sources import snapshots

SCHEMA = T.StructType([T.StructField("k", T.LongType())])


def numbers(spark, *values):
    return spark.createDataFrame([(v,) for v in values], SCHEMA)


def held(spark, root, version=None):
    return sorted(r["k"] for r in snapshots.read(spark, root, SCHEMA, version).collect())


def test_versions_follow_each_other(spark, tmp_path):
    root = str(tmp_path / "t")
    assert held(spark, root) == [] and snapshots.versions(spark, root) == []
    assert [snapshots.commit(spark, root, SCHEMA, lambda old, n=n: old.unionByName(numbers(spark, n))) for n in (5, 6, 7)] == [1, 2, 3]
    assert held(spark, root) == [5, 6, 7] and held(spark, root, 2) == [5, 6]


def test_a_writer_that_is_overtaken_keeps_both_changes(spark, tmp_path):
    root = str(tmp_path / "t")
    seen = []

    def change(old):
        seen.append(sorted(r["k"] for r in old.collect()))
        if len(seen) < 3:
            snapshots.commit(spark, root, SCHEMA, lambda rows: rows.unionByName(numbers(spark, 10 * len(seen))))
        return old.unionByName(numbers(spark, 1))

    assert snapshots.commit(spark, root, SCHEMA, change) == 3
    assert seen == [[], [10], [10, 20]] and held(spark, root) == [1, 10, 20]
    with pytest.raises(snapshots.Conflict):
        snapshots.commit(spark, root, SCHEMA, lambda old: (snapshots.commit(spark, root, SCHEMA, lambda r: r), old)[1], attempts=2)


def test_half_written_versions_are_never_read(spark, tmp_path):
    root = str(tmp_path / "t")
    snapshots.commit(spark, root, SCHEMA, lambda old: numbers(spark, 1))
    numbers(spark, 99).write.parquet(f"{root}/rows-unfinished")
    with pytest.raises(ZeroDivisionError):
        snapshots.commit(spark, root, SCHEMA, lambda old: 1 / 0)
    (tmp_path / "t/_drafts").mkdir(exist_ok=True)
    (tmp_path / "t/_drafts/left").write_text("rows-unfinished")
    assert held(spark, root) == [1]


def test_compaction_keeps_the_newest(spark, tmp_path):
    root = str(tmp_path / "t")
    for n in range(4):
        snapshots.commit(spark, root, SCHEMA, lambda old, n=n: old.unionByName(numbers(spark, n)))
    assert snapshots.compact(spark, root, keep=2) == [1, 2]
    assert held(spark, root) == [0, 1, 2, 3] and held(spark, root, 3) == [0, 1, 2]
    assert len([p for p in (tmp_path / "t").iterdir() if p.name.startswith("rows-")]) == 2
    assert snapshots.commit(spark, root, SCHEMA, lambda old: old) == 5
    with pytest.raises(ValueError):
        snapshots.compact(spark, root, keep=0)

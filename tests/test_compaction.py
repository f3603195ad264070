import os
from datetime import date
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from helpers import fact_frame, rows
from starmill import queries
from starmill.operators import compaction, folders
from starmill.operators.compaction import compact_small_files, settle_compaction
from starmill.operators.sinks import read_table


def files_of(path):
    return {os.path.relpath(os.path.join(d, f), path): os.stat(os.path.join(d, f)).st_mtime_ns
            for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def build(spark, path):
    """Partition 1 has a large file and five small ones, 2 a single small file, 3 four small ones; null is a partition too."""
    def add(first, n, part):
        df = spark.range(first, first + n, 1, 1).select("id", F.sha2(F.col("id").cast("string"), 256).alias("text"), F.lit(part).cast("int").alias("p"))
        df.write.mode("append").partitionBy("p").parquet(path)

    add(0, 20000, 1)
    for i, part in enumerate([1, 1, 1, 1, 1, 2, 3, 3, 3, 3, None, None]):
        add(100000 + i * 10, 10, part)


def test_only_small_files_are_rewritten(spark, tmp_path):
    path = str(tmp_path / "t")
    build(spark, path)
    before, data = files_of(path), rows(read_table(spark, path), "id", "text", "p")
    replaced = compact_small_files(spark, path, ["p"], ["id"], target_bytes=1 << 20)
    after = files_of(path)
    assert rows(read_table(spark, path), "id", "text", "p") == data
    kept = {f: at for f, at in before.items() if f not in replaced}
    assert len(replaced) == 11 and len(kept) == 2 and {f: after[f] for f in kept} == kept
    assert sorted(f.split("/")[0] for f in after) == ["p=1", "p=1", "p=2", "p=3", "p=__HIVE_DEFAULT_PARTITION__"]
    assert compact_small_files(spark, path, ["p"], target_bytes=1 << 20) == [] and files_of(path) == after


@pytest.mark.parametrize("dies_in", ["write_note", "move_all", "remove"])
def test_a_compaction_that_died(spark, tmp_path, monkeypatch, dies_in):
    path = str(tmp_path / "t")
    build(spark, path)
    data, calls = rows(read_table(spark, path), "id", "text", "p"), []
    real = getattr(folders, dies_in)

    def dying(*args):
        calls.append(args)
        if dies_in != "remove" or len(calls) == 5:  # the fourth of the old files
            raise OSError("lost")
        return real(*args)

    monkeypatch.setattr(folders, dies_in, dying)
    with pytest.raises(OSError):
        compact_small_files(spark, path, ["p"], target_bytes=1 << 20)
    monkeypatch.setattr(folders, dies_in, real)
    assert rows(read_table(spark, settle_compaction(spark, path)), "id", "text", "p") == data
    compact_small_files(spark, path, ["p"], target_bytes=1 << 20)
    assert rows(read_table(spark, path), "id", "text", "p") == data and len(files_of(path)) == 5
    assert not folders.exists(spark, compaction._draft(path))


def test_a_table_without_partitions_or_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    for n in (0, 3, 0, 4):
        spark.range(n).coalesce(1).write.mode("append").parquet(path)
    compact_small_files(spark, path)
    assert rows(read_table(spark, path)) == rows(spark.range(3).union(spark.range(4)))
    assert len(files_of(path)) == 1


def test_the_loads_of_the_query_move_no_rows(spark, tmp_path, monkeypatch):
    data = [(i, 1 + i % 50, 1 + i % 4, 1 + i % 3, date(2024, 1 + i % 3, 1 + i % 20), 5 + i) for i in range(600)]
    fact_frame(spark, data).repartition(1, "month_key").write.partitionBy("month_key").parquet(str(tmp_path / "fact"))
    w = SimpleNamespace(spark=spark, star=SimpleNamespace(fact=read_table(spark, str(tmp_path / "fact"))), new_folder=lambda n: str(tmp_path / n))
    jobs, merged, write = [], [], queries.sinks.write_table

    def watched(*args, **kwargs):
        spark.sparkContext.setJobGroup(f"load {len(jobs)}", "load")
        jobs.append(f"load {len(jobs)}")
        write(*args, **kwargs)
        spark.sparkContext.setJobGroup("others", "others")

    real = compaction.compact_small_files
    monkeypatch.setattr(queries.sinks, "write_table", watched)
    monkeypatch.setattr(compaction, "compact_small_files", lambda *a: merged.extend(real(*a)))
    found = rows(queries.compact_small_files(w), "month_key", "sales")
    assert found == [(202401, 200), (202402, 200), (202403, 200)] and len(merged) == 15 and len(files_of(str(tmp_path / "small_files"))) == 3
    status = spark.sparkContext.statusTracker()
    assert [sum(len(status.getJobInfo(j).stageIds) for j in status.getJobIdsForGroup(g)) for g in jobs] == [1] * 5


def test_sizes_come_with_the_listing(spark, tmp_path):
    path = str(tmp_path / "t")
    build(spark, path)
    assert dict(folders.data_files(spark, path)) == {f: os.path.getsize(os.path.join(path, f)) for f in files_of(path)}

import os
import shutil
import time
from types import SimpleNamespace

import pytest

from kimberlite.sources.lake import GOLD, Lake
from kimberlite.sources.scratch import discard, freed_shuffles, scratch_root, stage, staging


class Settings(dict):
    def get(self, key, default=None):
        return dict.get(self, key, default)


def session(**settings):
    named = Settings({k.replace("_", "."): v for k, v in settings.items()})
    return SimpleNamespace(conf=named, sparkContext=SimpleNamespace(applicationId="app-1"))


def test_the_folder_named_by_the_cluster_is_used():
    assert scratch_root(session(spark_checkpoint_dir="s3a://shared/x/")) == "s3a://shared/x"


def test_a_cluster_without_a_shared_folder_is_refused():
    with pytest.raises(RuntimeError):
        scratch_root(session(spark_master="spark://host:7077"))


def test_local_mode_gets_one_folder_per_application():
    first = scratch_root(session(spark_master="local[2]"))
    assert os.path.isdir(first)
    assert scratch_root(session(spark_master="local[2]")) == first
    shutil.rmtree(first)


def test_staged_tables_are_read_from_files_and_removed_at_the_end(spark):
    def staged():
        folder = f"{scratch_root(spark)}/kimberlite"
        return {n for n in os.listdir(folder) if n.startswith("mine-")} if os.path.isdir(folder) else set()

    with staging(spark):
        table = stage(spark.range(5), "mine")
        assert table.count() == 5 and len(staged()) == 1
        assert "FileScan parquet" in table._jdf.queryExecution().toString()
    assert not staged()
    stage(spark.range(5), "mine")
    assert len(staged()) == 1


def test_blocks_nest_and_tables_can_be_discarded(spark):
    def there(table):
        return os.path.isdir(table._staged_at)

    with staging(spark):
        outer = stage(spark.range(3), "outer")
        with staging(spark):
            inner = stage(spark.range(3), "inner")
            assert there(inner)
        assert there(outer) and not there(inner)
        gone = stage(spark.range(3), "gone")
        discard(gone)
        assert not there(gone)
    assert not there(outer)


SETTING = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shuffled_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {n for i in range(files.size()) if (n := files.apply(i).getName()).startswith("shuffle_")}


def written(table):
    return table.repartition(3, "id").groupBy((table["id"] % 7).alias("k")).count()


@pytest.mark.parametrize("what", ["stage", "overwrite"])
def test_what_a_write_shuffled_is_gone_when_it_ends(spark, tmp_path, what):
    before = shuffled_files(spark)
    df = written(spark.range(1000))
    if what == "stage":
        rows = stage(df, "freed")
    else:
        lake = Lake(spark, str(tmp_path))
        assert lake.overwrite(df, GOLD, "freed") == 7
        rows = lake.read(GOLD, "freed")
    until = time.time() + 10  # Spark deletes them beside other work
    while shuffled_files(spark) - before and time.time() < until:
        time.sleep(0.1)
    assert not shuffled_files(spark) - before
    assert sorted(r["count"] for r in rows.collect()) == [142] * 1 + [143] * 6


def test_the_setting_of_shuffled_files_is_restored(spark):
    first, second = freed_shuffles(spark), freed_shuffles(spark)
    before = spark.conf.get(SETTING, None)
    first.__enter__()
    second.__enter__()
    first.__exit__(None, None, None)  # threads may end in any order
    assert spark.conf.get(SETTING) == "true"
    second.__exit__(None, None, None)
    assert spark.conf.get(SETTING, None) == before

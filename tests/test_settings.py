from __future__ import annotations

import pytest

from chirplake.settings import Settings, configure, new_run_folder, session_settings


def test_session_settings_are_applied(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    configure(spark, Settings(arrow_batch_rows=500, shuffle_partitions=6))
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    assert spark.conf.get("spark.sql.legacy.timeParserPolicy") == "CORRECTED"
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "500"
    assert spark.conf.get("spark.sql.shuffle.partitions") == "6"
    configure(spark, Settings(shuffle_partitions=int(before)))


def test_rate_options():
    assert Settings().rate_options() == {"maxFilesPerTrigger": "10"}
    assert Settings(bytes_per_trigger="1g").rate_options() == {"maxBytesPerTrigger": "1g"}


class Conf:
    def __init__(self, **values):
        self.values = {key.replace("_", "."): value for key, value in values.items()}

    def get(self, key, default=None):
        return self.values.get(key, default)


class Session:
    def __init__(self, **values):
        self.conf = Conf(**values)


def test_run_folders_lie_in_the_shared_folder_of_the_cluster():
    session = Session(spark_checkpoint_dir="hdfs://shared/scratch/", spark_master="yarn")
    first, second = new_run_folder(session, "x"), new_run_folder(session, "x")
    assert first != second
    assert first.startswith("hdfs://shared/scratch/x-")


def test_without_it_they_lie_in_the_warehouse():
    session = Session(spark_sql_warehouse_dir="hdfs://shared/warehouse/", spark_master="yarn")
    assert new_run_folder(session, "x").startswith("hdfs://shared/warehouse/scratch/x-")


def test_streams_leave_no_old_file_behind():
    assert Settings().source_options()["maxFileAge"] == "36500d"
    assert Settings(max_file_age="2d").source_options()["maxFileAge"] == "2d"


def test_a_folder_of_one_machine_is_no_scratch_for_a_cluster():
    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError, match="checkpoint.dir"):
            new_run_folder(Session(spark_sql_warehouse_dir="file:/home/me/warehouse", spark_master=master), "x")
    one = Session(spark_sql_warehouse_dir="file:/home/me/warehouse", spark_master="local[8]")
    assert new_run_folder(one, "x").startswith("file:/home/me/warehouse/scratch/x-")


def test_settings_that_hold_for_a_while(spark):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    spark.conf.set(key, "123")
    with pytest.raises(KeyError), session_settings(spark, {key: "5", "spark.chirplake.none": "x"}):
        assert spark.conf.get(key) == "5"
        raise KeyError
    assert spark.conf.get(key) == "123" and spark.conf.get("spark.chirplake.none", None) is None
    spark.conf.unset(key)


def test_landing_files_are_moved_only_with_an_archive():
    assert "cleanSource" not in Settings().landing_options()
    assert Settings(archive="s3a://x/done").landing_options()["sourceArchiveDir"] == "s3a://x/done"

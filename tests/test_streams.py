from __future__ import annotations

import json
import os
import shutil
import time
import uuid
from datetime import datetime

import pytest
from helpers import assert_same_rows, rows
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from __spark_entry__ import queries
from chirplake import schemas
from chirplake.functions.scoring import load_lexicon_model, model_scorer
from chirplake.operators.application import application_table
from chirplake.operators.layers import to_gold, to_silver
from chirplake.plans.posts import land, posts
from chirplake.settings import Settings
from chirplake.sources import compaction, raw, tables
from chirplake.streaming import monitor, stages
from chirplake.streaming.stages import (
    Layout,
    application_stream,
    bronze_stream,
    drain,
    fold_application,
    gold_stream,
    read_application,
    rejected_lines,
    run_layers,
    silver_stream,
)

FIVE = Settings(files_per_trigger=5, scoring_partitions=4)


@pytest.fixture()
def layout(tmp_path):
    return Layout(str(tmp_path / "lake"))


@pytest.fixture()
def landing(tmp_path):
    folder = tmp_path / "landing"
    folder.mkdir()
    return folder


def add_file(landing, *posts_or_lines) -> None:
    lines = [p if isinstance(p, str) else json.dumps(p) for p in posts_or_lines]
    (landing / f"{uuid.uuid4().hex}.json").write_text("\n".join(lines) + "\n")


def post(text="@a love it", **fields) -> dict:
    return {
        "date": "Mon Apr 06 22:19:45 PDT 2009",
        "user": "u",
        "text": text,
        "sentiment": "positive",
    } | fields


def read(spark, layout, layer):
    return tables.read_table(spark, layout.table(layer))


def test_streams_give_what_batch_gives(spark, sf_dir, layout, tmp_path):
    frame = posts(spark, sf_dir)
    landing = land(frame, str(tmp_path / "posts"), 12)
    queries = run_layers(spark, landing, layout, FIVE, model_scorer(load_lexicon_model))
    assert [q.name for q in queries] == ["bronze_stream", "silver_stream", "gold_stream"]
    assert [p["batchId"] for p in queries[0].recentProgress if p["numInputRows"]] == [0, 1, 2]

    drain(application_stream(spark, layout, FIVE))
    silver = to_silver(frame)
    gold = to_gold(silver)
    assert_same_rows(read(spark, layout, "bronze").select(*schemas.RAW.names), frame.drop("post_id"))
    assert_same_rows(read(spark, layout, "silver"), silver)
    assert_same_rows(read(spark, layout, "gold"), gold)
    assert_same_rows(read_application(spark, layout), application_table(gold))
    assert tables.newest_batch(spark, layout.checkpoint("bronze")) == 2


def test_only_new_files_are_read(spark, layout, landing):
    add_file(landing, post("@a one"))
    run_layers(spark, str(landing), layout, FIVE)
    again = run_layers(spark, str(landing), layout, FIVE)
    assert sum(p["numInputRows"] for q in again for p in q.recentProgress) == 0

    add_file(landing, post("@b two"))
    run_layers(spark, str(landing), layout, FIVE)
    assert sorted(rows(read(spark, layout, "gold"), "mention")) == [("@a",), ("@b",)]


def test_rate_limit(spark, layout, landing):
    for i in range(5):
        add_file(landing, post(f"@a {i}"))
    drain(bronze_stream(spark, str(landing), layout, Settings(files_per_trigger=2)))
    bronze = read(spark, layout, "bronze")
    sizes = bronze.groupBy("processing_time").count().orderBy("processing_time")
    assert rows(sizes, "count") == [(2,), (2,), (1,)]


def test_rate_limit_by_bytes(spark, layout, landing):
    for i in range(4):
        add_file(landing, post(f"@a {i}"))
    drain(bronze_stream(spark, str(landing), layout, Settings(bytes_per_trigger="1")))
    assert read(spark, layout, "bronze").select("processing_time").distinct().count() == 4


def test_extra_keys_do_not_reach_bronze(spark, layout, landing):
    add_file(landing, post(user=7, source_file="made up", more=1))
    drain(bronze_stream(spark, str(landing), layout, FIVE))
    stored = read(spark, layout, "bronze")
    assert stored.columns == schemas.BRONZE.names
    row = stored.first()
    assert row.user == "7"
    assert row.source_file.startswith("file:") and row.source_file.endswith(".json")


def test_a_wider_schema_is_merged(spark, layout, landing):
    add_file(landing, post("@a"))
    drain(bronze_stream(spark, str(landing), layout, FIVE))
    add_file(landing, post("@b", lang="en"))
    wider = StructType([*schemas.RAW.fields, StructField("lang", schemas.TEXT, True)])
    drain(bronze_stream(spark, str(landing), layout, FIVE, wider))
    merged = tables.read_merged(spark, layout.table("bronze"))
    assert sorted(rows(merged, "text", "lang"), key=str) == [("@a", None), ("@b", "en")]
    drain(silver_stream(spark, layout, FIVE))
    assert sorted(rows(read(spark, layout, "silver"), "mention")) == [("@a",), ("@b",)]


def test_broken_lines_are_put_aside_whole(spark, layout, landing):
    add_file(landing, post("@a"), "{bad", post("@b"), '{"text": "@c"')
    schema = raw.with_corrupt_record(schemas.RAW)
    drain(bronze_stream(spark, str(landing), layout, FIVE, schema))
    good, bad = raw.split_malformed(read(spark, layout, "bronze"))
    assert sorted(rows(good, "text")) == [("@a",), ("@b",)]
    assert sorted(rows(bad, schemas.CORRUPT_RECORD)) == [('{"text": "@c"',), ("{bad",)]


def test_the_chain_keeps_broken_lines(spark, layout, landing):
    add_file(landing, "{bad", post("@a"))
    run_layers(spark, str(landing), layout, FIVE)
    assert rows(rejected_lines(spark, layout), "line") == [("{bad",)]
    assert rows(read(spark, layout, "gold"), "mention") == [("@a",)]


def test_old_and_nested_files_are_read(spark, layout, landing):
    add_file(landing, post("@new"))
    drain(bronze_stream(spark, str(landing), layout, FIVE))
    deep = landing / "2026" / "12"
    deep.mkdir(parents=True)
    add_file(deep, post("@deep"))
    add_file(landing, post("@old"))
    late = [f for f in landing.glob("*.json") if "@old" in f.read_text()]
    long_ago = time.time() - 10 * 86_400
    os.utime(late[0], (long_ago, long_ago))
    for _ in range(2):
        drain(bronze_stream(spark, str(landing), layout, FIVE))
    found = sorted(rows(read(spark, layout, "bronze"), "text"))
    assert found == [("@deep",), ("@new",), ("@old",)]
    assert raw.count_files(spark, str(landing)).first().files == 3


def test_ten_times_the_files_give_ten_times_the_batches(spark, landing, tmp_path):
    def batches(files):
        layout = Layout(str(tmp_path / f"lake-{files}"))
        folder = landing / str(files)
        folder.mkdir()
        for i in range(files):
            add_file(folder, post(f"@a {i}"))
        drain(bronze_stream(spark, str(folder), layout, Settings(files_per_trigger=2)))
        return tables.newest_batch(spark, layout.checkpoint("bronze")) + 1

    assert (batches(2), batches(20)) == (1, 10)


def test_the_chain_applies_its_settings(spark, layout, landing):
    add_file(landing, post())
    run_layers(spark, str(landing), layout, Settings(arrow_batch_rows=77))
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "77"


def test_the_application_table_is_empty_before_its_first_batch(spark, layout):
    empty = read_application(spark, layout)
    assert empty.columns == application_table(spark.createDataFrame([], schemas.GOLD)).columns
    assert empty.isEmpty()


def test_schema_is_enforced(spark):
    frame = spark.createDataFrame([("a", "b")], "mention string, cleaned_text string")
    with pytest.raises(ValueError, match="missing"):
        schemas.enforce(frame, schemas.SILVER)
    wide = frame.withColumns({"sentiment": F.lit("x"), "timestamp": F.current_timestamp()})
    assert schemas.enforce(wide, schemas.SILVER).columns == schemas.SILVER.names
    with pytest.raises(ValueError, match="not in the schema"):
        schemas.enforce(wide.withColumn("more", F.lit(1)), schemas.SILVER)
    wrong_type = wide.withColumn("timestamp", F.array(F.lit(1)))
    with pytest.raises(Exception, match="timestamp"):
        schemas.enforce(wrong_type, schemas.SILVER).collect()


def test_a_failing_stage_raises(spark, layout, landing):
    add_file(landing, post())
    drain(bronze_stream(spark, str(landing), layout, FIVE))
    drain(silver_stream(spark, layout, FIVE))

    def no_model():
        raise RuntimeError("no such model")

    with pytest.raises(Exception, match="no such model"):
        drain(gold_stream(spark, layout, FIVE, model_scorer(no_model)))
    drain(gold_stream(spark, layout, FIVE))
    assert read(spark, layout, "gold").count() == 1


def test_a_batch_run_twice_counts_once(spark, layout, landing, tmp_path):
    earlier = tmp_path / "earlier"

    class Restored(Layout):
        """The same tables with the checkpoints as they were before the last batch."""

        def checkpoint(self, layer):
            return str(earlier / layer)

    for i in range(3):
        add_file(landing, post(f"@a {i} love"))
        run_layers(spark, str(landing), layout, FIVE)
        if i == 2:
            shutil.copytree(tmp_path / "lake" / "checkpoints", earlier)
        drain(application_stream(spark, layout, FIVE))
    once = read_application(spark, layout).collect()
    assert [(row.mention, row.positive, row.total) for row in once] == [("@a", 3, 3)]

    # As after a crash between the write of a batch and its commit.
    restored = Restored(layout.root)
    assert read_application(spark, restored).first().total == 2
    drain(application_stream(spark, restored, FIVE))
    assert read_application(spark, restored).collect() == once


def test_folding_partials_changes_no_result(spark, layout, landing):
    for i in range(4):
        add_file(landing, post(f"@a @b{i} love"))
        run_layers(spark, str(landing), layout, FIVE)
        drain(application_stream(spark, layout, FIVE))
        before = read_application(spark, layout).collect()
        if i % 2:
            assert fold_application(spark, layout) == i
            assert read_application(spark, layout).collect() == before
    gold = read(spark, layout, "gold")
    assert_same_rows(read_application(spark, layout), application_table(gold))
    assert spark.read.parquet(layout.table("application_folds")).count() == 2


def test_a_table_in_many_files_can_be_streamed(spark, sf_dir, tmp_path):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    events.repartition(3).write.parquet(str(tmp_path / "events.parquet"))
    assert_same_rows(queries()["table_streamed_directly"](spark, str(tmp_path)), events)


def test_newest_batch_of_nothing(spark, tmp_path):
    assert tables.newest_batch(spark, str(tmp_path / "none")) == -1


def test_files_are_listed_without_reading_them(spark, landing):
    add_file(landing, post(), post())
    add_file(landing, post())
    listing = raw.list_files(spark, str(landing))
    assert sorted(rows(listing, "length")) == sorted(
        (f.stat().st_size,) for f in landing.iterdir()
    )
    assert raw.count_files(spark, str(landing)).first().files == 2
    assert "content" not in listing._jdf.queryExecution().executedPlan().toString()


def test_peeks(spark, landing):
    add_file(landing, post(user=7), post(user=8))
    assert dict(raw.peek_json(spark, str(landing)).dtypes)["user"] == "bigint"
    assert raw.peek_text(spark, str(landing), 1).count() == 1
    assert raw.peek_text(spark, str(landing)).count() == 2
    assert rows(raw.raw_batch(spark, str(landing)), "user") == [("7",), ("8",)]


def test_compaction(spark, layout, landing, tmp_path):
    for i in range(20):
        add_file(landing, post(f"@a {i}"))
    drain(bronze_stream(spark, str(landing), layout, FIVE))
    path, target = layout.table("bronze"), str(tmp_path / "compacted")
    assert tables.file_profile(spark, path).first().files == 20
    compacted = tables.compact(spark, path, target, 10**9)
    assert tables.file_profile(spark, target).first().files == 1
    assert_same_rows(compacted, read(spark, layout, "bronze"))


def test_a_compacted_table_goes_on(spark, layout, landing):
    path, size = layout.table("bronze"), 10**9

    def arrive(*texts):
        for text in texts:
            add_file(landing, post(text))
        drain(bronze_stream(spark, str(landing), layout, FIVE))

    def current():
        return compaction.read_current(spark, path, schemas.BRONZE)

    arrive("@a", "@b", "@c")
    assert len(current().inputFiles()) == 3
    assert compaction.compact_table(spark, path, size, schemas.BRONZE)
    assert not compaction.compact_table(spark, path, size, schemas.BRONZE)
    assert sorted(rows(current(), "text")) == [("@a",), ("@b",), ("@c",)]
    arrive("@d", "@a")
    assert_same_rows(current(), read(spark, layout, "bronze"))
    assert compaction.compact_table(spark, path, size, schemas.BRONZE)
    arrive("@e")
    assert_same_rows(current(), read(spark, layout, "bronze"))
    merged = dict(rows(current().select("text", F.input_file_name().alias("file"))))
    assert "bronze_compacted" in merged["@d"] and "bronze_compacted" not in merged["@e"]
    # A copy without its entry, as after a crash, is not read.
    read(spark, layout, "bronze").write.parquet(f"{path}_compacted/broken-off")
    assert_same_rows(current(), read(spark, layout, "bronze"))


def test_readers_list_only_spans_after_a_fold(spark, layout, landing, monkeypatch):
    monkeypatch.setattr(stages, "BATCHES_PER_SPAN", 2)
    for i in range(5):
        add_file(landing, post(f"@a {i} love"))
        run_layers(spark, str(landing), layout, FIVE)
        drain(application_stream(spark, layout, FIVE))
        if i == 2:
            assert fold_application(spark, layout) == 2
            shutil.rmtree(f"{layout.table('application')}/span=0")
        assert read_application(spark, layout).first().total == i + 1
        if i == 3:
            assert fold_application(spark, layout) == 3
            assert read_application(spark, layout).first().total == 4


def test_what_a_fold_covers_is_retired_after_its_grace(spark, layout, landing, monkeypatch):
    monkeypatch.setattr(stages, "BATCHES_PER_SPAN", 2)
    assert stages.retire_application(spark, layout, 0) == 0
    for i in range(5):
        add_file(landing, post(f"@a {i} love"))
        run_layers(spark, str(landing), layout, FIVE)
        drain(application_stream(spark, layout, FIVE))
        if i in (1, 3):
            fold_application(spark, layout)
    spans = lambda: sorted(p for p in os.listdir(layout.table("application")) if p.startswith("span"))
    assert stages.retire_application(spark, layout, 3600) == 0 and spans() == ["span=0", "span=1", "span=2"]
    time.sleep(0.05)
    assert stages.retire_application(spark, layout, 0) == 3 and spans() == ["span=2"]
    assert read_application(spark, layout).first().total == 5
    assert len(os.listdir(layout.table("application_folded"))) == 1


def test_progress_table(spark, layout, landing, tmp_path):
    for i in range(3):
        add_file(landing, post(f"@a @b {i}"))
    path, one = str(tmp_path / "progress"), Settings(files_per_trigger=1)
    with monitor.ProgressLog(spark, path, buffer_rows=2) as log:
        for query in run_layers(spark, str(landing), layout, one):
            log.await_end(query)
    progress = spark.read.parquet(path)
    assert progress.schema == schemas.STREAM_PROGRESS
    assert sorted(rows(monitor.rows_per_stream(progress))) == [
        ("bronze_stream", 3),
        ("gold_stream", 6),
        ("silver_stream", 3),
    ]
    by_stream = progress.groupBy("stream").agg(F.countDistinct("batch_id").alias("batches"))
    assert dict(rows(by_stream))["bronze_stream"] >= 3


def test_progress_can_be_read_while_streams_run(spark, tmp_path):
    path = str(tmp_path / "progress")
    with monitor.ProgressLog(spark, path, seconds=0.5) as log:
        with log._changed:
            log._rows.append((datetime(2026, 1, 1), "s", 0, 5, 100))
        until = time.time() + 30
        while not (tmp_path / "progress" / "_SUCCESS").exists():
            assert time.time() < until
            time.sleep(0.2)
        assert spark.read.parquet(path).count() == 1


def test_progress_outlives_a_failed_write(spark, tmp_path):
    blocked = tmp_path / "file"
    blocked.write_text("")
    log = monitor.ProgressLog(spark, str(blocked / "progress"))
    log._rows.append((datetime(2026, 1, 1), "s", 0, 5, 100))
    with pytest.raises(Exception):  # noqa: B017
        log.flush()
    log.path = str(tmp_path / "progress")
    log.flush()
    assert spark.read.parquet(log.path).count() == 1


def test_throughput_leaves_missing_times_out(spark):
    progress = spark.createDataFrame(
        [("00:00:01", "s", 0, 5, 100), ("00:00:09", "s", 1, 7, None), ("00:00:10", "s", 2, 1, 40)],
        "at string, stream string, batch_id bigint, rows bigint, duration_ms bigint",
    ).withColumn("observed_at", F.to_timestamp(F.concat(F.lit("2024-01-01 "), "at")))
    found = monitor.throughput(progress).orderBy("slot_start")
    assert rows(found, "rows", "mean_duration_ms") == [(12, 100.0), (1, 40.0)]


def test_live_throughput_gives_a_slot_once_and_counts_late_rows(spark, tmp_path):
    path, out, check = (str(tmp_path / name) for name in ("progress", "out", "checkpoint"))

    def arrive(*seconds):
        moments = [(datetime(2026, 1, 1, 0, s // 60, s % 60), "s", 0, s, 10 * s) for s in seconds]
        table = spark.createDataFrame(moments, schemas.STREAM_PROGRESS)
        table.coalesce(1).write.mode("append").parquet(path)
        stream = tables.stream_table(spark, path, schemas.STREAM_PROGRESS, Settings())
        live = monitor.live_throughput(stream, late="20 seconds")
        query = drain(stages.append_stream(live, out, check, "throughput_stream"))
        given = tables.read_table(spark, out).orderBy("slot_start")
        return monitor.late_rows(query.recentProgress), rows(given, "rows", "mean_duration_ms")

    assert arrive(1, 2, 12) == (0, [])
    assert arrive(31) == (0, [(3, 15.0)])
    assert arrive(9, 13) == (1, [(3, 15.0)])
    assert arrive(55) == (0, [(3, 15.0), (25, 125.0)])
    monitor.closing_row(spark, datetime(2026, 1, 2)).coalesce(1).write.mode("append").parquet(path)
    assert arrive() == (0, [(3, 15.0), (25, 125.0), (31, 310.0), (55, 550.0)])

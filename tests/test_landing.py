from __future__ import annotations

import json
import os
import time
from dataclasses import replace

import pytest
from helpers import rows

from chirplake import schemas
from chirplake.settings import Settings
from chirplake.sources import raw, tables
from chirplake.streaming import landing as landings
from chirplake.streaming.stages import Layout, bronze_stream, drain


@pytest.fixture()
def lake(tmp_path):
    (tmp_path / "landing" / "2026").mkdir(parents=True)
    layout = Layout(str(tmp_path / "lake"))
    settings = Settings(files_per_trigger=2, archive=str(tmp_path / "archive"))
    return tmp_path / "landing", layout, settings


def add(landing, name, text, age=0):
    line = {"date": None, "user": "u", "text": text, "sentiment": "positive"}
    (landing / name).write_text(json.dumps(line) + "\n")
    if age:
        os.utime(landing / name, (time.time() - age,) * 2)


def names(folder):
    return sorted(path.name for path in folder.rglob("*.json"))


def texts(spark, layout):
    return sorted(rows(tables.read_table(spark, layout.table("bronze")), "text"))


def test_a_listing_finds_only_what_is_new(spark, lake, tmp_path):
    landing, layout, settings = lake
    arrivals = [["a.json", "b c.json", "2026/d+e%20f.json"], ["g.json"], [], ["h.json", "2026/i.json"]]
    seen = []
    for arrival in arrivals:
        for name in arrival:
            add(landing, name, f"@{name}")
        assert raw.list_files(spark, str(landing)).count() == len(arrival)
        assert landings.ingest_and_archive(spark, str(landing), layout, settings) == 0
        seen += arrival
        assert names(landing) == []
        assert texts(spark, layout) == sorted((f"@{name}",) for name in seen)
    assert names(tmp_path / "archive") == sorted(name.rpartition("/")[2] for name in seen)


def test_files_too_old_for_the_source_are_read_all_the_same(spark, lake):
    landing, layout, settings = lake
    settings = replace(settings, archive_age="1h")
    add(landing, "new.json", "@new")
    assert landings.ingest_and_archive(spark, str(landing), layout, settings) == 0
    add(landing, "old.json", "@old", age=100_000)
    add(landing, "newer.json", "@newer")
    assert landings.ingest_and_archive(spark, str(landing), layout, settings) == 0
    assert texts(spark, layout) == [("@new",), ("@newer",), ("@old",)]


def test_files_of_a_run_that_broke_off_move_later(spark, lake, tmp_path):
    """Ingested by a stream that was not followed by a move."""
    landing, layout, settings = lake
    for i in range(5):
        add(landing, f"{i}.json", f"@{i}")
    drain(bronze_stream(spark, str(landing), layout, settings))
    assert names(landing)
    add(landing, "later.json", "@later")
    assert landings.archive_ingested(spark, str(landing), layout.checkpoint("bronze"), settings.archive) > 0
    assert names(landing) == ["later.json"]
    landings.ingest_and_archive(spark, str(landing), layout, settings)
    assert texts(spark, layout) == sorted([(f"@{i}",) for i in range(5)] + [("@later",)])


def test_nothing_ingested_yet(spark, lake):
    landing, layout, settings = lake
    add(landing, "a.json", "@a")
    assert landings.archive_ingested(spark, str(landing), layout.checkpoint("bronze"), settings.archive) == 0


def test_an_archive_must_lie_apart(spark, lake):
    landing, layout, settings = lake
    for archive in (str(landing), f"{landing}/done", str(landing.parent), "hdfs://other/archive"):
        with pytest.raises(Exception, match="archive|UnknownHost|other"):
            raw.raw_stream(spark, str(landing), replace(settings, archive=archive))


def test_sessions_keep_their_own_setting(spark, lake):
    landing, layout, settings = lake
    before = spark.conf.get(landings.CLEANER_THREADS, None)
    add(landing, "a.json", "@a")
    landings.ingest_and_archive(spark, str(landing), layout, settings)
    assert spark.conf.get(landings.CLEANER_THREADS, None) == before
    assert tables.read_table(spark, layout.table("bronze")).columns == schemas.BRONZE.names

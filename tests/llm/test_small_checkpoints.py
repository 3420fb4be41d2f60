"""Frames that are small beside the input are stored in few files, however many partitions they come in."""

from __future__ import annotations

from pathlib import Path

import pytest

from chirplake.llm import decontaminate, host_rules, simhash, url_filter
from chirplake.llm import queries as q
from chirplake.llm.common import FEW_FILES, checkpoint_small
from chirplake.llm.components import components

PARTITIONS = 90


@pytest.fixture
def stored(spark):
    """The number of files of each checkpoint written since, with many partitions after each shuffle."""
    checkpoint_small(spark.range(1))
    folder = Path(spark.sparkContext.getCheckpointDir().removeprefix("file:"))
    before = set(folder.glob("rdd-*"))
    wanted = {
        "spark.sql.shuffle.partitions": str(PARTITIONS),
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    kept = {key: spark.conf.get(key) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    yield lambda: [len(list(path.glob("part-*"))) for path in set(folder.glob("rdd-*")) - before]
    for key, value in kept.items():
        spark.conf.set(key, value)


def documents(spark):
    rows = [(i, f"host{i % 7}", " ".join(f"word{i * j % 31}" for j in range(1, 15))) for i in range(60)]
    return spark.createDataFrame(rows, "doc_id long, source string, text string").coalesce(3)


def test_rows_stay(spark, stored):
    kept = checkpoint_small(spark.range(500).repartition(PARTITIONS, "id"))
    assert sorted(row.id for row in kept.collect()) == list(range(500))
    assert max(stored()) <= FEW_FILES


def test_windows(spark, stored):
    items = spark.createDataFrame(
        [(f"i{i}", " ".join(f"word{i * j % 31}" for j in range(1, 13))) for i in range(40)] + [("none", None)],
        "item_id string, text string",
    )
    found = decontaminate.find_hits(documents(spark), items).where("size(hits) > 0")
    assert found.count() >= 40
    assert max(stored()) <= FEW_FILES


def test_pages(spark, stored):
    rows = [(i, f"http://www{i % 9}.city{i}.org/en/{i}", f"<p>www city word{i}</p>") for i in range(200)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(PARTITIONS)
    judged = url_filter.judge(pages, q.URL_RULES)
    assert judged.count() == 200
    files = stored()
    assert len(files) == 2 and max(files) <= FEW_FILES


def test_hosts(spark, stored):
    assert host_rules.keep_good(documents(spark)).count() > 0
    assert max(stored()) <= FEW_FILES


def test_links(spark, stored):
    links = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 160)]
    found = components(spark.createDataFrame(links, "a long, b long").repartition(PARTITIONS))
    assert sorted(map(tuple, found.collect())) == sorted(
        [(i, 0) for i in range(1, 61)] + [(i, 100) for i in range(101, 160)]
    )
    groups = simhash.near_groups(documents(spark)).select("doc_id", "component")
    assert groups.count() == 60
    assert max(stored()) <= FEW_FILES

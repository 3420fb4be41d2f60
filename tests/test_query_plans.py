"""Shapes the plans must keep: what is read, how often rows move, and no cross joins."""

from __future__ import annotations

import re

import pytest
from helpers import plan_of

from chirplake.plans.catalog import QUERIES
from chirplake.operators import application as app
from chirplake.operators import profiling
from chirplake.operators.layers import bronze_to_gold, to_gold, to_silver
from chirplake.plans.posts import posts

FROM_STREAMS = (
    "stream incremental schema_merge malformed compacted source_file batches rerun evaluation_run "
    "json_inferred text_line ml_scored file_size layer_row"
).split()
BATCH = sorted(name for name in QUERIES if not any(part in name for part in FROM_STREAMS))


@pytest.fixture(scope="module")
def stored(spark, sf_dir, tmp_path_factory):
    """Posts as a stored table, the way bronze is read."""
    path = str(tmp_path_factory.mktemp("plans") / "posts")
    posts(spark, sf_dir).write.parquet(path)
    return spark.read.parquet(path)


def exchanges(df) -> int:
    return len(re.findall(r"Exchange (?:hash|range|Single|RoundRobin)", plan_of(df)))


# Queries about joins; what they broadcast is small by the planner's own measure or has a bound.
JOINING = ("heavy_mentions", "salted_join_counts", "gold_memo_scored", "gold_memo_stream")


@pytest.mark.parametrize("name", BATCH)
def test_no_query_joins_or_broadcasts(spark, sf_dir, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    for operator in ("CartesianProduct", "NestedLoopJoin", "BroadcastExchange", "BatchEvalPython"):
        assert operator not in plan or (operator == "BroadcastExchange" and name in JOINING)


def test_layers_do_not_shuffle(stored):
    assert exchanges(to_gold(to_silver(stored))) == 0
    assert exchanges(bronze_to_gold(stored)) == 0
    assert exchanges(to_gold(to_silver(stored), partitions=4)) == 1


def test_application_shuffles_once_for_the_groups_and_once_for_the_order(stored):
    gold = bronze_to_gold(stored)
    assert exchanges(app.application_partials(gold)) == 1
    assert exchanges(app.application_table(gold)) == 2
    assert exchanges(app.top_mentions(gold, "positive")) == 1
    assert "TakeOrderedAndProject" in plan_of(app.top_mentions(gold, "positive"))
    assert "TakeOrderedAndProject" in plan_of(profiling.top_users(stored))


def test_only_needed_columns_are_read(stored):
    def read_schema(df):
        return re.search(r"ReadSchema: struct<(.*?)>", plan_of(df)).group(1)

    gold = bronze_to_gold(stored)
    assert read_schema(app.application_table(gold)) == "date:string,text:string"
    assert read_schema(app.mention_pivot(gold)) == "text:string"
    assert read_schema(app.mention_total(gold)) == "text:string"
    assert read_schema(profiling.posts_per_user(stored)) == "user:string"


def test_the_at_sign_test_reaches_the_scan(stored):
    assert "StringContains(text,@)" in plan_of(to_silver(stored))


def test_the_matcher_runs_once_per_post(stored):
    assert plan_of(to_silver(stored)).count("regexp_extract_all") == 1

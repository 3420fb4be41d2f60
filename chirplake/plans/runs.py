"""Streamed runs over all posts, for the queries that look at tables and streams."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from chirplake.functions.scoring import load_lexicon_model, model_scorer
from chirplake.plans.posts import land_all
from chirplake.schemas import BRONZE, GOLD, SILVER, STREAM_PROGRESS
from chirplake.settings import Settings, configure, new_run_folder, session_settings
from chirplake.sources.tables import read_table
from chirplake.streaming.monitor import ProgressLog
from chirplake.streaming.stages import (
    Layout,
    application_stream,
    bronze_stream,
    drain,
    gold_stream,
    read_application,
    silver_stream,
)


class StreamedPosts:
    """One pass of all posts through the stages, each run when it is first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir
        self.layout = Layout(new_run_folder(spark, "streamed"))

    @cached_property
    def _landed(self) -> tuple[str, int]:
        return land_all(self.spark, self.sf_dir)

    @property
    def landing(self) -> str:
        return self._landed[0]

    @cached_property
    def settings(self) -> Settings:
        """The library's defaults: a fixed number of files per trigger, whatever the total."""
        configure(self.spark)
        return Settings()

    @property
    def _progress_path(self) -> str:
        return self.layout.table("stream_progress")

    def _watched(self, start, *args) -> None:
        with (
            session_settings(self.spark, self.settings.session_options()),
            ProgressLog(self.spark, self._progress_path) as log,
        ):
            log.await_end(drain(start(self.spark, *args)))

    @cached_property
    def bronze(self) -> DataFrame:
        self._watched(bronze_stream, self.landing, self.layout, self.settings)
        return read_table(self.spark, self.layout.table("bronze"), BRONZE)

    @cached_property
    def silver(self) -> DataFrame:
        self.bronze  # noqa: B018
        self._watched(silver_stream, self.layout, self.settings)
        return read_table(self.spark, self.layout.table("silver"), SILVER)

    @cached_property
    def gold(self) -> DataFrame:
        self.silver  # noqa: B018
        scorer = model_scorer(load_lexicon_model)
        self._watched(gold_stream, self.layout, self.settings, scorer)
        return read_table(self.spark, self.layout.table("gold"), GOLD)

    @cached_property
    def application(self) -> DataFrame:
        self.gold  # noqa: B018
        self._watched(application_stream, self.layout, self.settings)
        return read_application(self.spark, self.layout)

    @property
    def progress(self) -> DataFrame:
        self.application  # noqa: B018
        return read_table(self.spark, self._progress_path, STREAM_PROGRESS)


_runs: dict[tuple[str, str], StreamedPosts] = {}


def streamed_posts(spark: SparkSession, sf_dir: str) -> StreamedPosts:
    """The run over ``sf_dir`` of this Spark application, shared by all queries that only read it."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _runs:
        _runs[key] = StreamedPosts(spark, sf_dir)
    return _runs[key]


def forget_runs() -> None:
    """Let the next query start from the landing files again."""
    _runs.clear()

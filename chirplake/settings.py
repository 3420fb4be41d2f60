"""Run options, session settings and the shared scratch folder."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from urllib.parse import urlsplit

from pyspark.sql import SparkSession

# Times are kept and shown in UTC, and dates are parsed by the strict parser,
# so that results do not depend on the machine.
SESSION_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.legacy.timeParserPolicy": "CORRECTED",
}


@dataclass(frozen=True)
class Settings:
    """Options of one run.

    ``files_per_trigger`` limits a micro-batch by file count and
    ``bytes_per_trigger`` by volume; the latter wins when set, and is the one to
    use where file sizes vary. ``scoring_partitions`` spreads rows before a
    model is applied; None keeps the partitions of the scan and needs no shuffle.
    ``arrow_batch_rows`` is the number of rows per batch handed to a Python model.
    ``shuffle_partitions`` is where a shuffle starts out before adaptive execution
    joins small partitions; None leaves it to the session. ``max_file_age`` is how much older
    than the newest file seen a landing file may be and still be read; the default drops none.
    ``archive`` is a folder that landing files move to once they are ingested, so that a listing finds
    new files only; see ``streaming.landing``. Files then need to be known for ``archive_age`` only, and
    up to ``cached_files`` listed files are kept for the next batches.
    """

    files_per_trigger: int = 10
    max_file_age: str = "36500d"
    bytes_per_trigger: str | None = None
    scoring_partitions: int | None = None
    arrow_batch_rows: int = 1000
    shuffle_partitions: int | None = None
    salts: int = 16
    target_file_bytes: int = 256 * 1024 * 1024
    archive: str | None = None
    archive_age: str = "7d"
    cached_files: int = 10_000

    def rate_options(self) -> dict[str, str]:
        if self.bytes_per_trigger is not None:
            return {"maxBytesPerTrigger": self.bytes_per_trigger}
        return {"maxFilesPerTrigger": str(self.files_per_trigger)}

    def source_options(self) -> dict[str, str]:
        """Options of a stream over files: its rate, and no file left behind for its age."""
        return self.rate_options() | {"maxFileAge": self.max_file_age}


    def landing_options(self) -> dict[str, str]:
        """Options of the stream over landing files, which may be moved away behind it."""
        if self.archive is None:
            return self.source_options()
        return self.rate_options() | {
            "maxFileAge": self.archive_age,
            "maxCachedFiles": str(self.cached_files),
            "cleanSource": "archive",
            "sourceArchiveDir": self.archive,
        }


    def session_options(self) -> dict[str, str]:
        """What a run sets in its session."""
        wanted = {"spark.sql.execution.arrow.maxRecordsPerBatch": str(self.arrow_batch_rows)}
        if self.shuffle_partitions is not None:
            wanted["spark.sql.shuffle.partitions"] = str(self.shuffle_partitions)
        return wanted


def configure(spark: SparkSession, settings: Settings | None = None) -> SparkSession:
    """Apply the session settings the results rely on."""
    wanted = SESSION_SETTINGS | ({} if settings is None else settings.session_options())
    for key, value in wanted.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


@contextmanager
def session_settings(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Settings that hold for a while; the session has its own again afterwards."""
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def new_run_folder(spark: SparkSession, purpose: str) -> str:
    """A folder name never used before, below the folder the cluster shares.

    Tables, stream checkpoints and models written there are reachable from every
    executor. The folder is the one in ``spark.checkpoint.dir``; a session without that setting
    uses a folder of the warehouse, ``spark.sql.warehouse.dir``, which is shared as well, unless it is
    a folder of the driver's machine and the executors run on others: that is an error.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
        on_one_machine = re.fullmatch(r"local(\[[^\]]*\])?", spark.conf.get("spark.master", "local"))
        if urlsplit(warehouse).scheme in ("", "file") and not on_one_machine:
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        shared = f"{warehouse}/scratch"
    return f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"

"""Quality rules by host: hosts whose documents often fail the rules are rejected as a whole.

Rule failures are added up per host, the failure rate is shrunk towards the corpus by a beta
prior fitted to the rates of all hosts, and the verdict on a host is joined back to its documents.
"""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import LongType, StructField, StructType

from chirplake.llm.common import checkpoint, checkpoint_small, free_name

WINDOW = 5
MIN_WORDS = 10
MAX_REPEATED_PERCENT = 20
SYMBOLS = b"#*$%&|<>"
# The prior counts for one document at least, so that a single one does not condemn its host.
MIN_PRIOR_DOCS = 1.0

METRICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class HostPolicy:
    """When a host is rejected.

    Its shrunk failure rate is above ``max_rate``: most of its documents are bad, and so many of
    them that the prior does not pull the rate below it. ``broadcast_hosts`` bounds the list of
    rejected hosts that is sent to all tasks; a longer one is joined by a shuffle.
    """

    max_rate: float = 0.8
    broadcast_hosts: int = 10_000


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a window of five found at least twice in the text."""
    n = len(words)
    if n <= WINDOW:
        return 0
    joined = b" ".join(words)
    ends, at = [], -1
    for word in words:
        at += len(word) + 1
        ends.append(at)
    starts = [0, *[end + 1 for end in ends[:-1]]]
    first: dict[bytes, int] = {}
    seen = first.setdefault
    again = [
        (i, earlier)
        for i, (a, b) in enumerate(zip(starts, ends[WINDOW - 1 :], strict=False))
        if (earlier := seen(joined[a:b], i)) != i
    ]
    if not again:
        return 0
    hit = bytearray(n)
    mark = b"\x01" * WINDOW
    for i, earlier in again:
        hit[i : i + WINDOW] = mark
        hit[earlier : earlier + WINDOW] = mark
    return hit.count(1)


def text_metrics(text: str) -> tuple[int, int, int, int, int]:
    """The five numbers of one whole text; words are runs without ASCII white space."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    chars = len(text) - sum(text.count(space) for space in " \t\n\x0b\x0c\r")
    symbols = len(raw) - len(raw.translate(None, SYMBOLS))
    lines = [line for line in raw.split(b"\n") if line.split(None, 1)] if b"\n" in raw else []
    return len(words), chars, symbols, len(lines) - len(set(lines)), repeated_words(words)


@arrow_udf(StructType([StructField(name, LongType()) for name in METRICS]))
def _measure(texts: pa.Array) -> pa.Array:
    rows = [text_metrics(text or "") for text in texts.to_pylist()]
    columns = zip(*rows, strict=True) if rows else [[] for _ in METRICS]
    return pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], names=METRICS)


def base_failed(n_words: Column, n_repeat_words: Column) -> Column:
    return (n_words < MIN_WORDS) | (100 * n_repeat_words > MAX_REPEATED_PERCENT * n_words)


def host_verdicts(flags: DataFrame, policy: HostPolicy = HostPolicy()) -> DataFrame:
    """(source, n, failed, rate, shrunk, rejected) per host, from rows of (source, base_failed).

    The beta prior has the mean of all documents and a weight from the spread of the hosts'
    rates beyond what chance gives (method of moments, hosts weighted by documents). Without any
    spread beyond chance the prior outweighs all: every host then has the mean rate. A null
    source is a host of its own.
    """
    hosts = flags.groupBy("source").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("base_failed").cast("long")).alias("failed")
    )
    hosts = checkpoint_small(hosts.withColumn("rate", F.col("failed") / F.col("n")))
    sums = hosts.agg(
        F.count(F.lit(1)).alias("hosts"),
        F.sum("n").alias("n"),
        F.sum("failed").alias("failed"),
        F.sum(F.col("n") * F.col("n")).alias("squares"),
    ).first()
    if not sums["n"]:
        mean, weight = 0.0, None
    else:
        mean = sums["failed"] / sums["n"]
        spread = hosts.agg(F.sum(F.col("n") * (F.col("rate") - F.lit(mean)) ** 2)).first()[0]
        weight = _prior_weight(mean, spread, sums["hosts"], sums["n"], sums["squares"])
    if weight is None:
        shrunk = F.lit(mean)
    else:
        shrunk = (F.col("failed") + F.lit(mean * weight)) / (F.col("n") + F.lit(weight))
    return hosts.withColumn("shrunk", shrunk).withColumn(
        "rejected", F.col("shrunk") > F.lit(policy.max_rate)
    )


def _prior_weight(mean: float, spread: float, hosts: int, n: int, squares: int) -> float | None:
    """Documents the prior counts for; None if the hosts do not differ beyond chance."""
    chance = mean * (1 - mean)
    freedom = n - squares / n
    if hosts < 2 or chance <= 0 or freedom <= 0:
        return None
    between = (spread - (hosts - 1) * chance) / freedom
    if between <= 0:
        return None
    return max(chance / between - 1, MIN_PRIOR_DOCS)


def judge(docs: DataFrame, policy: HostPolicy = HostPolicy()) -> DataFrame:
    """Per document: id, source, the five numbers, ``base_failed``, ``host_rejected``, ``kept``.

    A null text has no words and fails. Every row gets a row, repeated ones too; an empty table gives none.
    Long texts are measured whole. Hosts of equal rates have equal verdicts.
    """
    measured = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        _measure(F.col("text").cast("string")).alias("m"),
    ).select("doc_id", "source", "m.*")
    failed = base_failed(F.col("n_words"), F.col("n_repeat_words"))
    measured = checkpoint(measured.withColumn("base_failed", failed))
    verdicts = host_verdicts(measured.select("source", "base_failed"), policy)
    return _with_rejection(measured, verdicts, policy, "host_rejected").withColumn(
        "kept", ~F.col("base_failed") & ~F.col("host_rejected")
    )


def _with_rejection(
    docs: DataFrame, verdicts: DataFrame, policy: HostPolicy, flag: str
) -> DataFrame:
    rejected = verdicts.where("rejected").select(F.col("source").alias("_host"), F.lit(True).alias(flag))
    if verdicts.where("rejected").limit(policy.broadcast_hosts + 1).count() <= policy.broadcast_hosts:
        rejected = F.broadcast(rejected)
    matched = docs["source"].cast("string").eqNullSafe(F.col("_host"))
    joined = docs.join(rejected, matched, "left")
    return joined.drop("_host").withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))


def keep_good(docs: DataFrame, policy: HostPolicy = HostPolicy()) -> DataFrame:
    """The rows of ``docs`` that pass the rules and come from no rejected host, columns unchanged.

    The texts are measured twice, once for the hosts and once to filter, which costs less than
    carrying them through a shuffle.
    """
    name = free_name(docs, "_metrics")
    measured = docs.withColumn(name, _measure(F.col("text").cast("string")))
    failed = base_failed(F.col(f"{name}.n_words"), F.col(f"{name}.n_repeat_words"))
    slim = docs.select(F.col("source").cast("string").alias("source"), "text")
    slim = slim.withColumn("m", _measure(F.col("text").cast("string"))).select(
        "source", base_failed(F.col("m.n_words"), F.col("m.n_repeat_words")).alias("base_failed")
    )
    verdicts = host_verdicts(slim, policy)
    flag = free_name(docs, "_rejected")
    kept = _with_rejection(measured.where(~failed), verdicts, policy, flag).where(~F.col(flag))
    return kept.select(*[F.col(f"`{column}`") for column in docs.columns])

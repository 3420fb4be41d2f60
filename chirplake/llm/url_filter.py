"""URL filters: rules for hosts and paths, and a word model for the urls no rule fits.

Host names run words together. A unigram model of the words on all pages splits them: the
cheapest way through a name (Viterbi) gives its words. A multinomial naive Bayes model, fitted
to the urls the rules decide, then scores the words of host and path.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from chirplake.llm.common import checkpoint_small, lower_ascii, whole_text

# A label of a host name has no more characters, so no longer word can be a part of one.
LONGEST_WORD = 63
# Hashed token buckets: the model is this large, however many tokens there are.
BUCKETS = 1 << 16
SMOOTHING = 1.0
# A character outside every known word costs this much more than the rarest word.
UNKNOWN_COST = 3.0
WORD_RUN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


class Rule(NamedTuple):
    verdict: str
    rule: str

    @property
    def host(self) -> str:
        return self.rule.split("/", 1)[0]

    @property
    def path(self) -> str:
        return "/" + self.rule.split("/", 1)[1]


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host, lower-cased in ASCII, and path; both empty if the url is null or has no ``://``."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    after = F.substring(rest, F.length(host) + 1, F.length(rest) + 1)
    return lower_ascii(host), F.regexp_extract(after, r"^[^?#]*", 0)


def matching_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The longest rule whose host is the url's or a parent of it and whose path begins the url's."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda rule: (len(rule.rule), rule.rule)):
        fits = ((host == rule.host) | host.endswith(f".{rule.host}")) & path.startswith(rule.path)
        found = F.when(fits, F.lit(rule.rule)).otherwise(found)
    return found


def word_counts(pages: DataFrame, longest: int = LONGEST_WORD) -> DataFrame:
    """(word, n) over the visible text of all pages; longer words cannot be part of a split."""
    text = F.regexp_replace(
        whole_text(F.col("html")), r"(?s)<script.*?</script>|<style.*?</style>|<[^>]*>|&[#\w]+;", " "
    )
    words = pages.select(
        F.explode(F.regexp_extract_all(lower_ascii(text), F.lit(WORD_RUN), F.lit(0))).alias("word")
    )
    return words.where(F.char_length("word") <= longest).groupBy("word").agg(
        F.count(F.lit(1)).alias("n")
    )


def split_words(label: str, cost: dict[str, float], unknown: float, longest: int) -> list[str]:
    """The cheapest way to cut a name into words; characters outside words stay together."""
    best, came = [0.0] + [math.inf] * len(label), [0] * (len(label) + 1)
    for stop in range(1, len(label) + 1):
        best[stop], came[stop] = best[stop - 1] + unknown, stop - 1
        for start in range(max(0, stop - longest), stop):
            price = cost.get(label[start:stop])
            if price is not None and best[start] + price < best[stop]:
                best[stop], came[stop] = best[start] + price, start
    words, stop = [], len(label)
    while stop:
        words.append(label[came[stop] : stop])
        stop = came[stop]
    words.reverse()
    joined: list[str] = []
    loose = False
    for word in words:
        known = word in cost
        if not known and loose:
            joined[-1] += word
        else:
            joined.append(word)
        loose = not known
    return joined


def host_words(hosts: DataFrame, counts: DataFrame, longest: int = LONGEST_WORD) -> DataFrame:
    """(host, words): the words of all labels of each different host.

    Only the pieces of names meet the word counts, in a join: no vocabulary is sent around, and
    a host's own pieces are all that a task holds for it.
    """
    labels = hosts.select("host").distinct()
    pieces = labels.select("host", F.explode(F.split("host", r"[.:@_-]")).alias("label")).where(
        F.col("label") != ""
    )
    size = F.char_length("label")
    pieces = pieces.select(
        "host",
        "label",
        F.explode(F.sequence(F.lit(1), size)).alias("start"),
    ).select(
        "host",
        F.explode(
            F.transform(
                F.sequence(F.lit(1), F.least(F.lit(longest), F.char_length("label") - F.col("start") + 1)),
                lambda n: F.substring(F.col("label"), F.col("start"), n),
            )
        ).alias("word"),
    )
    total = counts.agg(F.sum("n").alias("total"), F.min("n").alias("least")).first()
    all_words, least = total["total"] or 1, total["least"] or 1
    known = pieces.distinct().join(counts, "word").groupBy("host").agg(
        F.collect_list(F.struct("word", "n")).alias("known")
    )
    unknown = -math.log(least / all_words) + UNKNOWN_COST

    @arrow_udf("array<string>")
    def segmented(names: pa.Array, known: pa.Array) -> pa.Array:
        found = []
        for host, words in zip(names.to_pylist(), known.to_pylist(), strict=True):
            cost = {word["word"]: -math.log(word["n"] / all_words) for word in words or ()}
            found.append(
                [
                    word
                    for label in re.split(r"[.:@_-]", host)
                    if label
                    for word in split_words(label, cost, unknown, longest)
                ]
            )
        return pa.array(found, pa.list_(pa.string()))

    return labels.join(known, "host", "left").select("host", segmented("host", "known").alias("words"))


@dataclass(frozen=True)
class UrlModel:
    """Log odds of block against allow: the prior, and one for each token bucket."""

    prior: float
    weights: np.ndarray


def bucket(token: str) -> int:
    return xxhash.xxh64_intdigest(token.encode("utf-8", "surrogatepass"), 0) % BUCKETS


def _ruled_out(rules: Sequence[Rule]) -> list[str]:
    """Words the rules are made of; they tell the rule and nothing about other urls."""
    return sorted({part for rule in rules for part in re.split(r"[./]", rule.rule) if part})


def _tokens(words: Column, path: Column, rules: Sequence[Rule]) -> Column:
    in_path = F.regexp_extract_all(lower_ascii(path), F.lit(WORD_RUN), F.lit(0))
    named = F.array(*[F.lit(word) for word in _ruled_out(rules)]).cast("array<string>")
    host = F.transform(F.array_except(F.coalesce(words, F.array().cast("array<string>")), named), lambda w: F.concat(F.lit("h:"), w))
    return F.concat(host, F.transform(F.filter(in_path, lambda w: ~F.array_contains(named, w)), lambda w: F.concat(F.lit("p:"), w)))


def fit(tokenised: DataFrame, verdict: Column) -> UrlModel:
    """Counts of token buckets over all rows with a verdict; the buckets bound what comes back."""

    def buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, BUCKETS + 1), np.int64)
        memory: dict[str, int] = {}
        for batch in batches:
            pairs = zip(batch.column("tokens").to_pylist(), batch.column("block").to_pylist(), strict=True)
            for tokens, block in pairs:
                side = counts[int(block)]
                side[BUCKETS] += 1
                for token in tokens:
                    if (at := memory.get(token)) is None:
                        at = bucket(token)
                        if len(memory) < 1_000_000:
                            memory[token] = at
                    side[at] += 1
        used = np.flatnonzero(counts.any(0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(used.astype(np.int32)), pa.array(counts[1, used]), pa.array(counts[0, used])],
            names=["bucket", "block", "allow"],
        )

    judged = tokenised.select("tokens", (verdict == "block").alias("block")).where(
        F.col("block").isNotNull()
    )
    sums = (
        judged.mapInArrow(buckets, "bucket int, block long, allow long")
        .groupBy("bucket")
        .agg(F.sum("block").alias("block"), F.sum("allow").alias("allow"))
        .collect()
    )
    counts = np.zeros((2, BUCKETS + 1))
    for row in sums:
        counts[:, row["bucket"]] = row["allow"], row["block"]
    rows, tokens = counts[:, BUCKETS], counts[:, :BUCKETS] + SMOOTHING
    shares = np.log(tokens / tokens.sum(1, keepdims=True))
    return UrlModel(float(np.log((rows[1] + 1) / (rows[0] + 1))), shares[1] - shares[0])


def judge(pages: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(page_id, host, path, rule, verdict, score, tokens) of every page.

    A rule decides where one fits. Elsewhere the model does: block if the log odds ``score`` are
    above 0, which without any token they are only if the rules block most pages. ``score`` comes
    for all pages. Repeated rows stay repeated; a null url has an empty host and path. A null or empty
    ``html`` adds no words, long ones are read whole, and an empty table gives no rows. Equally cheap
    ways to split a name go to the one with the longest last word.
    """
    host, path = url_parts(F.col("url"))
    urls = pages.select(F.col("page_id"), host.alias("host"), path.alias("path"))
    urls = urls.withColumn("rule", matching_rule(F.col("host"), F.col("path"), rules))
    verdicts = F.lit(None).cast("string")
    for rule in rules:
        verdicts = F.when(F.col("rule") == rule.rule, F.lit(rule.verdict)).otherwise(verdicts)

    counts = checkpoint_small(word_counts(pages))
    words = checkpoint_small(host_words(urls, counts))
    # Read by the fit and by the verdicts: tokens are sooner made of the urls again than stored for all pages.
    tokenised = urls.join(words, "host", "left").withColumn(
        "tokens", _tokens(F.col("words"), F.col("path"), rules)
    )
    model = fit(tokenised, verdicts)
    prior, weights = model.prior, model.weights

    @arrow_udf("double")
    def scored(arrays: pa.Array) -> pa.Array:
        sums = [
            prior + sum(float(weights[bucket(token)]) for token in tokens)
            for tokens in arrays.to_pylist()
        ]
        return pa.array(sums, pa.float64())

    judged = tokenised.withColumn("score", scored("tokens"))
    learnt = F.when(F.col("score") > 0, F.lit("block")).otherwise(F.lit("allow"))
    return judged.withColumn("verdict", F.coalesce(verdicts, learnt)).select(
        "page_id", "host", "path", "rule", "verdict", "score", "tokens"
    )

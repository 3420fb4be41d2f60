from __future__ import annotations

import re
from datetime import datetime, timezone

import pytest
from helpers import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from chirplake.functions.text import (
    at_sign_flag,
    has_at_sign,
    has_mention,
    is_mention,
    mentions,
    parse_post_date,
    strip_mentions,
    token_text,
    tokens,
)

GOLDEN = [
    ("@a hi @b", ["@a", "@b"], " hi "),
    ("@a @a", ["@a", "@a"], " "),
    ("@a@b", ["@a@b"], ""),
    ("@@bob", [], "@"),
    ("foo@bar.com", [], "foo.com"),
    ("a @ b", [], "a @ b"),
    ("", [], ""),
    (None, None, None),
    ("(@x), @Y!", ["@x", "@Y"], "(), !"),
    ("x.@dot_1", ["@dot_1"], "x."),
    ("@José x", ["@Jos"], "é x"),
    ("@@a @b", ["@b"], "@ "),
    ("a@@b@c @d@@e@", ["@d@@e@"], "a@ @@"),
    ("line one\n@two\r\n@three", ["@two", "@three"], "line one\n\r\n"),
    ("😀@smile😀", ["@smile"], "😀😀"),
]


def test_golden_mentions(spark):
    frame = spark.createDataFrame(GOLDEN, "text string, want array<string>, want_clean string")
    text = F.col("text")
    for given_text, found, want, clean, want_clean in rows(
        frame.select("text", mentions(text), "want", strip_mentions(text), "want_clean")
    ):
        assert (found, clean) == (want, want_clean), given_text


def test_token_route_gives_the_same_mentions(spark):
    frame = spark.createDataFrame([(text,) for text, _, _ in GOLDEN], "text string")
    text = F.col("text")
    long_way = F.filter(tokens(text), is_mention)
    assert frame.filter(~long_way.eqNullSafe(mentions(text))).count() == 0


def test_token_text_and_tokens(spark):
    frame = spark.createDataFrame([("a, @b!é",), (None,)], "text string")
    assert rows(frame.select(token_text(F.col("text")), tokens(F.col("text")))) == [
        ("a  @b  ", ["a", "", "@b", "", ""]),
        (None, None),
    ]


def test_at_sign_and_mention_tests(spark):
    texts = ["@a", "mail a@b.c", "a @ b", "none", "", None]
    frame = spark.createDataFrame([(text,) for text in texts], "text string")
    text = F.col("text")
    assert rows(frame.select(has_at_sign(text), has_mention(text), at_sign_flag(text))) == [
        (True, True, 1),
        (True, False, 1),
        (True, False, 1),
        (False, False, 0),
        (False, False, 0),
        (None, None, 0),
    ]


def utc(*parts) -> datetime:
    return datetime(*parts, tzinfo=timezone.utc)


@pytest.mark.parametrize(
    ("date", "instant"),
    [
        ("Mon Apr 06 22:19:45 PDT 2009", utc(2009, 4, 7, 5, 19, 45)),
        ("Mon Apr 6 22:19:45 PDT 2009", utc(2009, 4, 7, 5, 19, 45)),
        ("Tue Apr 06 22:19:45 PDT 2009", utc(2009, 4, 7, 5, 19, 45)),
        ("Mon Jan 01 00:00:07 UTC 2024", utc(2024, 1, 1, 0, 0, 7)),
        ("Thu Apr 31 10:00:00 UTC 2009", None),
        ("Mon Apr 06 25:00:00 UTC 2009", None),
        ("garbage", None),
        ("", None),
        (None, None),
    ],
)
def test_dates(spark, date, instant):
    frame = spark.createDataFrame([(date,)], "date string")
    seconds = frame.select(F.unix_timestamp(parse_post_date(F.col("date")))).first()[0]
    assert seconds == (None if instant is None else int(instant.timestamp()))


def expected_mentions(text: str) -> list[str]:
    return [
        token
        for token in re.sub(r"[^@A-Za-z0-9_]", " ", text).split(" ")
        if re.match(r"@[A-Za-z0-9_]", token)
    ]


POST_TEXT = st.text(alphabet=st.sampled_from("@@@ab_1 .,é\n😀"), max_size=30) | st.text(
    alphabet=st.characters(exclude_categories=["Cs"], exclude_characters="\0"), max_size=30
)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(texts=st.lists(POST_TEXT, min_size=40, max_size=80))
def test_any_text(spark, texts):
    frame = spark.createDataFrame([(text,) for text in texts], "text string")
    text = F.col("text")
    for given_text, found, clean, present in rows(
        frame.select("text", mentions(text), strip_mentions(text), has_mention(text))
    ):
        want = expected_mentions(given_text)
        assert found == want
        assert present == bool(want)
        assert clean == re.sub(r"@[A-Za-z0-9_]+", "", given_text)

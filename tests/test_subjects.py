import re

import pytest
from helpers import log_of, message
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from subjectlog.functions.subjects import (
    is_literal,
    literal_prefix,
    literal_subject,
    pattern_key,
    pattern_regex,
    shape_of,
    subject_matches,
)
from subjectlog.operators.match import match
from subjectlog.operators.subscriptions import invalid_targets

TOKENS = st.sampled_from(["a", "b", "a-b", "x$", "ü", "(", "A"])
SUBJECTS = st.lists(TOKENS, min_size=1, max_size=4).map(".".join)


@st.composite
def patterns(draw):
    tokens = draw(st.lists(st.one_of(TOKENS, st.just("*")), min_size=0, max_size=4))
    if not tokens or draw(st.booleans()):
        tokens.append(">")
    return ".".join(tokens)


def by_tokens(subject, pattern):
    s, p = subject.split("."), pattern.split(".")
    if "" in s:
        return s == p
    if p[-1] == ">":
        return len(s) >= len(p) and all(b in ("*", a) for a, b in zip(s, p[:-1]))
    return len(s) == len(p) and all(b in ("*", a) for a, b in zip(s, p))


@settings(max_examples=500, deadline=None)
@given(SUBJECTS, patterns())
def test_regex_and_prefix(subject, pattern):
    body = pattern_regex(pattern).removeprefix(r"\A").removesuffix(r"\z")
    hit = re.fullmatch(body, subject, re.S) is not None
    assert hit == by_tokens(subject, pattern)
    if hit:
        assert subject.startswith(literal_prefix(pattern))


def grammar_cases():
    subjects = ["a", "a.b", "a.b.c", "a.b.c.d", "b.a", "b.b.b", "a..b", ".a", "a.", "", "a.*", "a.>", "ü.x$", "a.b\n"]
    patterns = ["a", "a.b", "*", ">", "a.*", "a.>", "*.b", "*.*.c", "a.*.>", "*.>", "b.b.b", "ü.*", "a.b.c.d.>", "*.*"]
    return subjects, patterns


def test_predicates_agree_with_the_grammar(spark):
    subjects, patterns = grammar_cases()
    df = spark.createDataFrame([(s,) for s in subjects], "subject string")
    for pattern in patterns:
        key = pattern_key(F.col("subject"), shape_of(pattern))
        got = df.select("subject", subject_matches(F.col("subject"), pattern).alias("m"), (key == pattern).alias("k"))
        for subject, m, k in got.collect():
            want = by_tokens(subject, pattern)
            assert m == want, (subject, pattern)
            if not is_literal(pattern):
                assert bool(k) == want, (subject, pattern)


@pytest.mark.parametrize("limit", [None, 0])
def test_match_by_broadcast_and_by_shuffle(spark, limit):
    subjects, patterns = grammar_cases()
    log = log_of(spark, [message("s", s, i + 1) for i, s in enumerate(subjects)])
    other = log_of(spark, [message("t", "a.b", 1)])
    subs = spark.createDataFrame([("s", p, p) for p in patterns], "stream string, subject string, split_id string")
    got = {(r["subject"], r["split_id"]) for r in match(log.unionByName(other), subs, limit).collect()}
    want = {(s, p) for s in subjects for p in patterns if by_tokens(s, p)}
    assert got == want
    assert match(log, subs, limit).count() == len(want)


def test_no_subscription_matches_nothing(spark):
    subs = spark.createDataFrame([], "stream string, subject string, split_id string")
    assert match(log_of(spark, [message("s", "a", 1)]), subs).count() == 0


def test_wildcard_targets_are_refused_when_run(spark):
    df = spark.createDataFrame([("a.b",), ("a.*",), ("a.>",), ("a*b.c",), ("a..b",), ("",)], "subject string")
    assert sorted(r[0] for r in invalid_targets(df).collect()) == ["", "a.*", "a..b", "a.>"]
    ok = df.where("subject in ('a.b', 'a*b.c')").select(literal_subject(F.col("subject")))
    assert ok.count() == 2
    with pytest.raises(Exception, match="wildcard"):
        df.select(literal_subject(F.col("subject"))).collect()

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from brute import WORD

from subjectlog.llm import prefix_trie

TURN = "conv_id bigint, turn bigint, role string, text string, depth string, print string, part string"


def plain(rows):
    """The trie as nested dictionaries of whole rebuilt texts."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", hashlib.sha256((text or "").encode()).hexdigest(), text or ""))
    own = {c: [(t[2], t[4]) for t in sorted(turns)] for c, turns in own.items()}
    base = lambda c: c - (c % 20 if c >= 0 else -(-c % 20))
    head = lambda c: zlib.crc32(str(c).encode()) % 4
    whole = {c: tuple(own.get(base(c), [])[: head(c)] + own[c][head(c) :]) for c in own}
    members = defaultdict(list)
    for c in sorted(whole):
        for d in range(len(whole[c]) + 1):
            members[whole[c][:d]].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        below = children[node]
        leaves[node] = sum(leaves[b] for b in below) if below else 1
        words = len(WORD.findall(node[-1][1])) if node else 0
        saved[node] = (len(members[node]) - 1) * words + sum(saved[b] for b in below)
    out = []
    for node, convs in members.items():
        ends = ",".join(str(c) for c in convs if whole[c] == node)
        up = members[node[:-1]][0] if node else None
        digest = hashlib.sha256(ends.encode()).hexdigest()
        out.append((convs[0], len(node), up, len(convs), len(children[node]), leaves[node], saved[node], digest))
    return sorted(out, key=repr)


def found(spark, rows):
    df = spark.createDataFrame([(*r, "d", "p", "x") for r in rows], TURN)
    got = prefix_trie.trie(df)
    assert got.columns[-1] == "ref"
    return sorted((tuple(r)[:-1] for r in got.collect()), key=repr)


def conversations(seed, n, words=3, longest=6):
    draw = random.Random(seed)
    return [
        (c, t, draw.choice(["user", "assistant"]), " ".join(draw.choice("ab") for _ in range(draw.randrange(words))))
        for c in draw.sample(range(400), n)
        for t in range(draw.randrange(1, longest))
    ]


@pytest.mark.parametrize("seed", range(2))
def test_like_plain(spark, seed):
    rows = conversations(seed, 150, words=2 + seed)
    assert found(spark, rows) == plain(rows)


def test_odd_rows(spark):
    rows = conversations(7, 60)
    rows += [(40, None, "user", "first"), (40, None, None, None), (40, 2, "user", "tie"), (40, 2, "user", "tied"), (40, 2, "user", "tie")]
    rows += [(None, 1, "user", "nobody's"), (-3, 0, None, "x"), (-40, 0, "user", "minus"), (-45, 5, "user", "y" * 300_000)]
    rows += [(10**15 + k, 0, "user", "far") for k in range(45)]
    rows += [rows[0]] * 3
    assert found(spark, rows) == plain(rows)
    assert found(spark, []) == []


def test_one_conversation_with_most_turns(spark):
    """Twice a conversation that spans partitions, and many copies of a short one."""
    rows = [(c, t, "user", f"turn {t % 7}") for c in (500, 511) for t in range(1500)]
    rows += [(600 + k, 0, "user", "hello there") for k in range(400)]
    assert found(spark, rows) == plain(rows)
    n = spark.conf.get("spark.sql.shuffle.partitions")
    assert int(n) > 1


def test_carries_and_buckets(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "DEPTH_BUCKET", 4)
    monkeypatch.setattr(prefix_trie, "CHUNK", 3)
    rows = [(c, t, "user", f"a {t}") for c in range(0, 60, 20) for t in range(25)] + conversations(3, 80)
    assert found(spark, rows) == plain(rows)


def test_collisions_are_not_passed_over(spark):
    held = "ref long, conv_id long, turn long, role string, text string, a long, b long, words long, tie string"
    turns = spark.createDataFrame([(0, 1, 0, "u", "x", 5, 5, 1, ""), (1, 2, 0, "u", "y", 5, 5, 1, "")], held)
    with pytest.raises(RuntimeError):
        prefix_trie._verify_turns(turns)

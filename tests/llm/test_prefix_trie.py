"""The prefix trie against a plain dictionary of paths."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from stratalake.llm import prefix_trie as trie
from stratalake.llm.prefix_trie import describe_turns, prefix_trie, share_heads
from stratalake.sources.scratch import stage
from tests.llm.conftest import CLASHING

COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def by_hand(paths):
    """Rows as COLUMNS from ``{conv_id: [(role, text), ...]}``."""
    members = defaultdict(list)
    for c in sorted(paths):
        for d in range(len(paths[c]) + 1):
            members[tuple(paths[c][:d])].append(c)
    children = defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]].append(p)
    below = {}
    for p in sorted(members, key=len, reverse=True):
        own = (len(members[p]) - 1) * (len(p[-1][1].encode()) if p else 0)
        below[p] = (
            own + sum(below[q][0] for q in children[p]),
            sum(below[q][1] for q in children[p]) or 1,
        )
    out = []
    for p, m in members.items():
        ends = ",".join(str(c) for c in m if len(paths[c]) == len(p))
        out.append(
            (m[0], len(p), members[p[:-1]][0] if p else None, len(m), len(children[p]), below[p][1], below[p][0])
            + (hashlib.sha256(ends.encode()).hexdigest(),)
        )
    return sorted(out, key=repr)


def ordered(turns):
    """Paths by conversation from rows of (conv_id, turn, role, text)."""
    told = defaultdict(list)
    for c, turn, role, text in turns:
        if c is not None:
            role, text = role or "", text or ""
            tie = hashlib.md5(f"{len(role.encode())} {role}{text}".encode()).digest()
            told[c].append(((turn is not None, turn or 0), tie, (role, text)))
    return {c: [t[2] for t in sorted(rows)] for c, rows in told.items()}


def rebuilt(paths):
    def cut(c):
        first, h = c - (abs(c) % 5 if c >= 0 else -(abs(c) % 5)), zlib.crc32(str(c).encode()) % 9
        return paths.get(first, [])[:h] + paths[c][h:]

    return {c: cut(c) for c in paths}


def rows(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=repr)


@pytest.fixture
def turns(spark):
    def make(data):
        extra = ", ".join(f"{c} string" for c in CLASHING if c not in ("id", "turn"))
        width = len([c for c in CLASHING if c not in ("id", "turn")])
        schema = f"conv_id long, turn long, role string, text string, {extra}, place string, digest string, depth string, path string"
        return spark.createDataFrame([tuple(r) + ("x",) * (width + 4) for r in data], schema)

    return make


ODD_TURNS = [
    (1, 0, "user", "Hallo"),
    (1, 1, "assistant", None),
    (1, None, None, "comes first"),
    (2, 0, "user", "Hallo"),
    (2, 1, "assistant", ""),
    (3, 0, "user", "Hallo"),
    (3, 0, "user", "Hallo"),
    (3, 0, "assistant", "tie"),
    (-4, 5, "user", "grüße 😀"),
    (-6, 5, "user", "grüße 😀"),
    (7, 0, "", ""),
    (9_000_000_000_000, 0, "user", "long " * 20_000),
    (None, 0, "user", "belongs to nobody"),
]


def test_odd_rows(turns):
    assert rows(prefix_trie(describe_turns(turns(ODD_TURNS)))) == by_hand(ordered(ODD_TURNS))


def test_empty_table_has_no_node(turns):
    assert rows(prefix_trie(describe_turns(turns([])))) == []
    assert rows(prefix_trie(share_heads(stage(describe_turns(turns([])), "t")))) == []


def random_turns(seed, n, words=3, longest=6):
    pick = random.Random(seed)
    return [
        (c, t, ("user", "assistant")[t % 2], f"w{pick.randrange(words)}")
        for c in range(n)
        for t in range(pick.randrange(1, longest))
    ]


@pytest.mark.parametrize("shard", [1, 7, 4096])
def test_shards_do_not_matter(spark, turns, shard, monkeypatch):
    data = random_turns(5, 300) + [(c, t, "user", "same") for c in range(1000, 1100) for t in range(3)]
    described = stage(describe_turns(turns(data)), "described").repartition(5)
    if shard != 4096:
        # Executors run code of their own, so the shards are made here.
        paths = ordered(data)
        found = []
        now = trie.Shard()
        for c in sorted(paths):
            for role, text in paths[c]:
                now.add(c, hashlib.md5(f"{len(role)} {role}{text}".encode()).digest(), len(text))
            if len(now.ids) == shard:
                found += list(now.nodes())
                now = trie.Shard()
        found += list(now.nodes())
        members = defaultdict(int)
        for key, _, depth, _, n, *_ in found:
            if key is not None:
                members[key, depth] += n
        wanted = sorted((r[1], r[3]) for r in by_hand(paths))
        assert sorted((d, n) for (_, d), n in members.items()) == wanted
    else:
        assert rows(prefix_trie(described)) == by_hand(ordered(data))


def test_shared_heads_and_turnless_conversations(spark, turns):
    data = random_turns(11, 400, words=2, longest=9)
    data = [r for r in data if r[0] % 35 or r[0] == 0]  # some groups lack their first conversation
    data += [(-c, t, role, text) for c, t, role, text in random_turns(12, 60) if c]
    expected = rebuilt(ordered(data))
    assert any(not p for p in expected.values())
    found = prefix_trie(share_heads(stage(describe_turns(turns(data)), "described")))
    assert rows(found) == by_hand(expected)


def test_a_deep_conversation_and_many_equal_ones(turns):
    data = [(1, t, "user", f"t{t}") for t in range(3000)] + [(c, t, "user", f"t{t}") for c in range(2, 5000) for t in range(2)]
    assert rows(prefix_trie(describe_turns(turns(data)))) == by_hand(ordered(data))

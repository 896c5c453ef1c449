"""Tries against sets of prefixes; nodes against SQL and a slow version; odd tables."""

import hashlib
import zlib
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.oracle import compare, connect
from tidemark.llm import prefix_trie, queries
from tidemark.llm.prefix_trie import ROOT, ZFastTrie, fattest

SCHEMA = "conv_id long, turn long, role string, text string"


def path_of(symbols):
    out = [ROOT]
    for s in symbols:
        out.append(hashlib.blake2b(out[-1] + bytes([s]), digest_size=16).digest())
    return out


def test_fattest():
    for low in range(40):
        for high in range(low + 1, 41):
            assert fattest(low, high) == max(range(low + 1, high + 1), key=lambda x: x & -x)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 2), max_size=20), st.integers(1, 3))))
def test_trie_holds_every_prefix(inserted):
    trie, want = ZFastTrie(), defaultdict(lambda: [0, 10**9])
    for number, (symbols, members) in enumerate(inserted):
        path = path_of(symbols)
        trie.insert(path, members, number)
        for depth, key in enumerate(path):
            want[key, path[depth - 1] if depth else None, depth][0] += members
            want[key, path[depth - 1] if depth else None, depth][1] = min(number, want[key, path[depth - 1] if depth else None, depth][1])
    assert {(k, p, d): [n, least] for k, p, d, n, least in trie.expand()} == dict(want)
    # Each node is found at its handle, and its edge is as long as can be: it parts or ends something.
    for node in trie.nodes()[1:]:
        assert trie.handles[node.path[fattest(node.low, node.high)]] is node
        assert node.ends or len(node.children) > 1
    assert len(trie.handles) == len(trie.nodes()) - 1


def slow_nodes(rows):
    """Nodes of rebuilt conversations, from lists of all prefixes."""
    def digest(role, text):
        return hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()

    lists = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            lists[conv].append(((turn is not None, turn or 0), digest(role or "", text or ""), role or "", text or ""))
    lists = {c: tuple((r, t) for _, _, r, t in sorted(v)) for c, v in lists.items()}
    whole = {}
    for c, own in lists.items():
        h = zlib.crc32(str(c).encode()) % 6
        giver = lists.get(c - (abs(c) % 100 if c >= 0 else -(abs(c) % 100)), ())
        whole[c] = giver[:h] + own[h:]
    members = defaultdict(list)
    for c, path in whole.items():
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
    out = []
    for p, cs in members.items():
        below = [q for q in members if q[:len(p)] == p]
        leaves = [q for q in below if not any(len(x) == len(q) + 1 and x[:len(q)] == q for x in members)]
        ends = sorted(c for c in cs if whole[c] == p)
        out.append((min(cs), len(p), min(members[p[:-1]]) if p else None, len(cs),
                    sum(len(x) == len(p) + 1 and x[:len(p)] == p for x in members), len(leaves),
                    sum((len(members[q]) - 1) * len(q[-1][1]) for q in below if q), hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(out, key=str)


def nodes(df, **given):
    got = prefix_trie.prefix_trie(prefix_trie.rebuilt(prefix_trie.turn_lists(df)), **given).drop("key")
    return sorted(map(tuple, got.collect()), key=str)


def test_same_as_sql(spark):
    got = queries.QUERIES["op13_fast_trie"](spark, "/root/testdata/sf0.01").toArrow()
    assert compare(got, connect("/root/testdata/sf0.01").sql(queries.SQL["op13_fast_trie"]).to_arrow_table()) is None


@pytest.mark.parametrize("trie_nodes", [1, 5, 200_000])
def test_odd_rows_same_as_slow(spark, trie_nodes):
    rows = [(c, t, r, f"text {c % k} {t}") for k in (2, 3) for c in range(95, 108) for t, r in ((0, "user"), (1, "assistant"), (2, "user"))]
    # Ties, repeated rows, nulls, role and text that only differ in where they part, no giver, negative ids.
    rows += [(300, 0, "user", "hi")] * 3 + [(301, 1, "b", "x"), (301, 1, "a", "y"), (301, None, "z", None), (302, None, None, None)]
    rows += [(-5, 0, "us", "er hi"), (-6, 0, "user ", "hi"), (-100, 0, "user", "far"), (-100, 1, "bot", "ät"), (None, 0, "user", "lost")]
    rows += [(400, t, "user", f"long {t}") for t in range(300)] + [(401, t, "user", f"long {t}") for t in range(300)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], f"{SCHEMA}, turns string, key int")
    assert nodes(df, trie_nodes=trie_nodes) == slow_nodes(rows)


def test_many_members_and_none(spark):
    rows = [(c, 0, "user", "same") for c in range(2_500)] + [(c, 1, "bot", "same") for c in range(1_300)]
    df = spark.createDataFrame(rows, SCHEMA)
    lists = prefix_trie.turn_lists(df)
    got = {r["depth"]: r for r in prefix_trie.prefix_trie(lists).collect()}
    digest = hashlib.sha256(",".join(map(str, range(1_300, 2_500))).encode()).hexdigest()
    assert (got[1]["n_convs"], got[1]["n_leaves"], got[1]["saved_tokens"], got[1]["ends_sha256"]) == (2_500, 1, 4 * (2_499 + 1_299), digest)
    assert prefix_trie.prefix_trie(prefix_trie.turn_lists(df.limit(0))).count() == 0

"""Fingerprints from the definition; links against comparing all pairs; odd tables."""

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tidemark.llm import simhash_trie as st


def slow_print(text):
    words = [w for w in __import__("re").findall(r"[^\x20\x09-\x0D]+", "".join(
        c.lower() if "A" <= c <= "Z" else c for c in text))]
    shingles = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(x >> k & 1 for x in h) > len(h))


@pytest.mark.parametrize("text", ["", " \n", "One", "a b c", "a b c d", "a b c d e", "É À Ünd THE the\x0bx y", "x " * 500, "a b \x1c c d e f"])
def test_fingerprint(spark, text):
    assert st.fingerprint(text) == slow_print(text)
    row = spark.createDataFrame([(1, text)], "doc_id long, text string")
    got = st.fingerprints(row).first()["print"]
    assert got % (1 << 64) == slow_print(text)


def test_hash_is_that_of_the_sql_function(spark):
    got = spark.range(1).select(F.xxhash64(F.lit("a b c"))).first()[0]
    assert got % (1 << 64) == st.fingerprint("A b C")


def slow_components(prints, budget):
    label = {p: p for p in prints}

    def root(p):
        while label[p] != p:
            p = label[p]
        return p

    for a in prints:
        for b in prints:
            if a < b and (a ^ b).bit_count() <= budget:
                x, y = sorted((root(a), root(b)))
                label[y] = x
    groups = {}
    for p in prints:
        groups.setdefault(root(p), set()).add(p)
    return sorted(map(sorted, groups.values()))


@pytest.mark.parametrize("group_rows", [20_000, 30])
@pytest.mark.parametrize("budget", [1, 4])
def test_links(spark, budget, group_rows):
    draw = np.random.default_rng(3)
    base = [int(x) for x in draw.integers(0, 1 << 63, 40)]
    prints = set(base) | {0, (1 << 64) - 1}
    for b in base[:15]:
        for _ in range(12):
            x = b
            for k in draw.integers(0, 64, int(draw.integers(1, 9))):
                x ^= 1 << int(k)
            prints.add(x)
    # A dense ball and a chain whose ends are far apart.
    for k in range(64):
        prints |= {base[20] ^ (1 << k), base[20] ^ (3 << k) % (1 << 64), base[21] ^ ((1 << k) - 1)}
    signed = [p - (1 << 64) if p >= 1 << 63 else p for p in prints]
    rows = [(p, p, p) for p in signed]
    links = st.link_fingerprints(spark.createDataFrame(rows, "print long, check long, node long"), budget, 64, group_rows).collect()
    label = {p: p for p in prints}

    def root(p):
        while label[p] != p:
            p = label[p]
        return p

    for a, b in links:
        x, y = sorted((root(a % (1 << 64)), root(b % (1 << 64))))
        label[y] = x
    groups = {}
    for p in prints:
        groups.setdefault(root(p), set()).add(p)
    assert sorted(map(sorted, groups.values())) == slow_components(prints, budget)


def test_the_check_decides(spark):
    rows = [(0, 0, 1), (1, 0, 2), (3, 255, 3), (3, 0, 4), (1 << 62, 7, 5)]
    df = spark.createDataFrame(rows, "print long, check long, node long")
    links = {tuple(sorted(r)) for r in st.link_fingerprints(df, 2, 3).collect()}
    assert {n for link in links for n in link} == {1, 2, 4, 5}


def test_near_copies_by_shingles(spark):
    draw = np.random.default_rng(5)
    words = [f"w{k}" for k in range(4000)]
    rows = []
    for base in range(40):
        text = [words[k] for k in draw.integers(0, 4000, 400)]
        rows.append((100 * base, " ".join(text)))
        for copy in range(3):
            changed = list(text)
            for k in draw.integers(0, 400, 5):
                changed[k] = words[int(draw.integers(0, 4000))]
            rows.append((100 * base + 1 + copy, " ".join(changed)))
    kept = {r["doc_id"] for r in st.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert kept >= {100 * b for b in range(40)} and len(kept) <= 42


def test_given_documents(spark):
    """All documents of the smallest tables against comparing all fingerprints."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    prints = {r["doc_id"]: slow_print(r["text"] or "") for r in docs.collect()}
    least = {}
    for group in slow_components(set(prints.values()), 4):
        ids = [d for d, p in prints.items() if p in group]
        least.update(dict.fromkeys(ids, min(ids)))
    got = {r["doc_id"]: (r["print"] % (1 << 64), r["component_id"]) for r in st.group_near_copies(docs).collect()}
    assert got == {d: (prints[d], least[d]) for d in prints}


def test_tables(spark):
    text = " ".join(f"w{i}" for i in range(300))
    rows = [(5, text, "a"), (3, text.upper(), "b"), (9, text + " tail", "c"), (1, None, "d"), (2, "", "e"), (None, text, "f"), (7, "other", "g"),
            (7, "other", "g"), (None, "alone here", "h")]
    df = spark.createDataFrame(rows, "doc_id long, text string, print string")
    got = sorted((r["doc_id"] or 0, r["component_id"] or 0) for r in st.group_near_copies(df).collect())
    assert got == [(0, 0), (0, 3), (1, 1), (2, 1), (3, 3), (5, 3), (7, 7), (7, 7), (9, 3)]
    kept = st.keep_one(df)
    assert kept.columns == df.columns
    assert sorted((r["doc_id"] or 0) for r in kept.collect()) == [0, 1, 3, 7]
    assert st.group_near_copies(df.limit(0)).count() == 0


def test_rows_are_told_apart_by_id_and_text(spark):
    text = " ".join(f"w{i}" for i in range(300))
    rows = [(1, text), (None, text), (None, "alone here"), (None, "another one alone"), (2, text), (2, "own words of two"), (2, "own words of two"),
            (None, "alone here")]
    kept = st.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"] or 0, r["text"][:11]) for r in kept) == [(0, "alone here"), (0, "another one"), (1, text[:11]), (2, "own words o")]


def slow_jaccard(a, b):
    x, y = ({tuple(t.split()[i:i + 5]) for i in range(max(1, len(t.split()) - 4))} for t in (a, b))
    return len(x & y) / len(x | y)


def test_groups_of_two_by_exact_similarity(spark):
    """Appended, truncated and edited copies at 0.8 and more are one group; edited texts near 0.5 are two."""
    draw = np.random.default_rng(11)
    p = 1 / np.arange(1, 5001)
    new = lambda n: [f"w{k}" for k in draw.choice(5000, n, p=p / p.sum())]
    rows, same = [], {}
    for k in range(240):
        n, kind = (60, 200, 600)[k % 3], k // 3 % 4
        text = new(n)
        other = list(text)
        if kind == 0:
            other += new(int(0.22 * n))
        elif kind == 1:
            other = text[:int(0.82 * n)]
        else:
            for at in draw.choice(n, max(1, int((0.02, 0.065)[kind - 2] * n)), replace=False):
                other[at] = f"v{at}"
        a, b = " ".join(text), " ".join(other)
        rows += [(2 * k, a), (2 * k + 1, b)]
        same[k] = slow_jaccard(a, b) >= 0.8
    assert 150 < sum(same.values()) < 200
    kept = {r["doc_id"] for r in st.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert kept == {2 * k for k in same} | {2 * k + 1 for k, s in same.items() if not s}


def similar_pairs(sets, jaccard):
    """All pairs of at least this similarity, found by comparing all."""
    ids = sorted(sets)
    return {(a, b) for i, a in enumerate(ids) for b in ids[i + 1:] if len(sets[a] & sets[b]) >= jaccard * len(sets[a] | sets[b]) - 1e-9}


def linked_nodes(spark, sets, rounds):
    """Components that ``link_sets`` gives for sets whose prefixes are in order of their numbers."""
    nodes = [(n, len(s), sorted(s)[:st.prefix_length(len(s), 0.8)]) for n, s in sets.items()]
    table = spark.createDataFrame(nodes, "node long, size int, tokens array<long>")
    rows = st.shared_places(table, 0.8)
    made = spark.createDataFrame([(n, sorted(s)) for n, s in sets.items()], "node long, shingles array<long>")
    return {r["member"]: r["component"] for r in st.link_sets(
        rows, table.select("node", table.tokens.alias("shingles")), lambda ends: made.join(ends, "node", "left_semi"), 0.8, rounds).collect()}


@pytest.mark.parametrize("rounds", [0, 2])
def test_all_pairs_of_a_brute_force_count(spark, rounds):
    """Families of sets at all similarities: the same components as from all pairs of 0.8 and more."""
    draw = np.random.default_rng(8)
    sets, n = {}, 0
    for _ in range(30):
        base = draw.choice(10_000, int(draw.integers(4, 60)), replace=False)
        for _ in range(int(draw.integers(1, 9))):
            own = set(base.tolist())
            for _ in range(int(draw.integers(0, max(1, len(base) // 10) + 1))):
                own.discard(int(draw.choice(base)))
                own.add(int(draw.integers(0, 10_000)))
            n += 1
            sets[n] = own
    want = {}
    for group in slow_groups(sets, similar_pairs(sets, 0.8)):
        want.update(dict.fromkeys(group, min(group)))
    assert len(want) > 80
    assert linked_nodes(spark, sets, rounds) == want


def test_tables_that_grow_with_the_texts_are_not_sent_whole(spark, monkeypatch):
    """Every join by token or node has a bound of its own, and beyond it gives the same components."""
    draw = np.random.default_rng(9)
    sets = {n: set(draw.choice(300, 30, replace=False).tolist()) for n in range(20)}
    sets |= {20 + n: (s | {1_000 + n}) - {min(s)} for n, s in sets.items()} | {40 + n: {*range(2_000, 2_030), 3_000 + n} for n in range(20)}
    want = linked_nodes(spark, sets, 2)
    assert len(set(want.values())) >= 10
    bounds, joined = [], st.salted_join
    monkeypatch.setattr(st, "BROADCAST_BYTES", -1)
    monkeypatch.setattr(st, "salted_join", lambda facts, keyed, on, how="inner", spread=(), broadcast_bytes=None, counts=None: (
        bounds.append(broadcast_bytes) or joined(facts, keyed, on, how, spread, broadcast_bytes, counts)))
    assert linked_nodes(spark, sets, 2) == want
    assert len(bounds) >= 8 and set(bounds) == {-1}


def slow_groups(ids, pairs):
    parent = {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    groups = {}
    for i in ids:
        groups.setdefault(root(i), set()).add(i)
    return [g for g in groups.values() if len(g) > 1]


def test_a_family_of_unlike_texts_compares_few_pairs(spark):
    """2,000 texts that share 80 of 120 words (0.46) and some of 0.7: hardly any pair is compared."""
    draw = np.random.default_rng(2)
    shared = [f"s{k}" for k in range(80)]
    rows = [(n, " ".join([*shared, *(f"x{k}" for k in draw.integers(0, 10**6, 40 if n % 2 else 16))])) for n in range(2_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    made = st.prefixes(docs, 5, 0.8, st.frequencies(docs, 5))
    fitting = st.shared_places(made.select("node", "size", "tokens"), 0.8)
    pairs = fitting.groupBy("token").count().selectExpr("sum(count * (count - 1) / 2)").first()[0] or 0
    assert pairs < 4_000, pairs
    assert st.keep_one(docs).count() == 2_000


def test_recall_on_given_documents(spark):
    """Every pair of five-word similarity 0.8 or more of the smallest tables is in one component."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    sets = {r["doc_id"]: set(st.shingle_set(r["text"] or "").tolist()) for r in docs.collect()}
    pairs = similar_pairs({d: s for d, s in sets.items() if s}, 0.8)
    got = {r["doc_id"]: r["component"] for r in st._placed(docs, 5, 0.8).collect()}
    assert len(pairs) > 5 and all(got[a] == got[b] for a, b in pairs)
    groups = slow_groups([d for d, s in sets.items() if s], pairs)
    assert len({got[d] for g in groups for d in g}) == len(groups)


def test_keep_one_goes_through_the_trie_walk(spark, monkeypatch):
    """The walk proposes links between near copies and the sets decide; what it links is not looked for again."""
    draw = np.random.default_rng(3)
    text = [f"w{k}" for k in draw.integers(0, 4000, 400)]
    copies = [" ".join([*text[:at], f"new{at}", *text[at + 1:]]) for at in (50, 150, 250)]
    far = " ".join(f"u{k}" for k in draw.integers(0, 4000, 400))
    docs = spark.createDataFrame([(n, t) for n, t in enumerate([" ".join(text), *copies, far])], "doc_id long, text string")
    made = st.materialize(st.prefixes(docs, 5, 0.8, st.frequencies(docs, 5)), "made")
    # A print that wrongly agrees with others is no link.
    nodes = made.withColumn("print", F.when(F.col("doc_id") == 4, 13).otherwise(12).cast("long"))
    sets_of = lambda ends: st.shingle_sets(docs, 5).join(ends, "node", "left_semi")
    node = {r["doc_id"]: r["node"] for r in made.collect()}
    found = {frozenset(r) for r in st.walked_pairs(nodes, sets_of, 0.8).collect()}
    assert found and all(node[4] not in pair for pair in found) and {n for pair in found for n in pair} <= {node[k] for k in range(4)}
    walked, linked = [], st.walked_pairs
    monkeypatch.setattr(st, "walked_pairs", lambda *a, **kw: walked.append(linked(*a, **kw)) or walked[-1])
    assert sorted(r["doc_id"] for r in st.keep_one(docs).collect()) == [0, 4] and len(walked) == 1
    # Without any shared shingle offered to the prefix join, known links are components still.
    none = spark.createDataFrame([], "token long, node long, size int, place int")
    known = spark.createDataFrame([(7, 9), (9, 11)], "a long, b long")
    shingles = spark.createDataFrame([(n, [n]) for n in (7, 9, 11)], "node long, shingles array<long>")
    got = st.link_sets(none, shingles, lambda ends: shingles.join(ends, "node", "left_semi"), 0.8, known=known)
    assert {r["member"]: r["component"] for r in got.collect()} == {7: 7, 9: 7, 11: 7}

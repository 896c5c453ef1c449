"""URL aliases, chat layouts, template leaks: hand cases, odd tables, SQL."""

import json
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.oracle import compare, connect
from tidemark.llm import chat_layout, queries, template_leaks, url_alias
from tidemark.llm.shared import components

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_same_as_sql(spark, name):
    got = queries.QUERIES[name](spark, SF_DIR).toArrow()
    assert compare(got, connect(SF_DIR).sql(queries.SQL[name]).to_arrow_table()) is None


def test_components(spark):
    draw = np.random.default_rng(0)
    edges = [(int(a), int(b)) for a, b in draw.integers(0, 400, (260, 2))]
    edges += [(1000 + k, 1001 + k) for k in range(70)] + [(5000, 5001 + k) for k in range(300)] + [(7, 7), (None, 3)]
    label = {}

    def root(x):
        while label.setdefault(x, x) != x:
            x = label[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            x, y = sorted((root(a), root(b)))
            label[y] = x
    got = components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()
    assert sorted(map(tuple, got)) == sorted((n, root(n)) for n in label)
    assert components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


RULES = (("com", "/", "allow"), ("bad.com", "/x/", "block"), ("good.bad.com", "/x/", "allow"), ("org", "/x/", "block"))


def test_the_same_page_under_other_spellings(spark):
    rows = [page("http://a.net", "http://bad.com:80/x/../x/1"), page("http://A.net:80/"), page("https://b.org:443/y"), page("http://c.net/", "https://B.org/./y"),
            page("https://b.org/y", "http://bad.com/x/1"), page("http://a.net:8080/")]
    df = spark.createDataFrame([(i, u, h) for i, (u, h) in enumerate(rows)], "page_id long, url string, html string")
    got = {r["page_id"]: r["verdict"] for r in url_alias.judge_urls(df, url_alias.rules_table(spark, RULES)).collect()}
    assert got == {0: "block", 1: "block", 2: "block", 3: "block", 4: "block", 5: "allow"}


def page(url, canonical=None, refresh=None):
    head = f'<LINK data-x=1 rel="canonical" href="{canonical}">' if canonical else ""
    head += f"<meta http-equiv='refresh' content='0; url={refresh}'>" if refresh else ""
    return url, f"<html><head><link rel=stylesheet href=/a.css>{head}</head></html>"


def test_aliases(spark):
    rows = [
        page("http://bad.com/x/1"), page("https://GOOD.bad.com/x/1?q#f"), page("http://notbad.com/x/"), page("http://a.net/1", "https://b.org/x/9"),
        page("http://c.net/2", refresh="/3"), page("http://c.net/3", "http://a.net/1"), page("http://d.net/", "http://e.net/"),
        page("http://f.net/", refresh="http://d.net/"), page("http://e.net/", "http://www.bad.com/y"), page("http://e.net/", "http://z.org/x/1"),
        page("http://lone.net/x"), (None, None), ("no scheme", "<link rel=canonical href=http://q.org/x/>"), ("http://bad.com/x/1", None)]
    df = spark.createDataFrame([(i, u, h, "keep") for i, (u, h) in enumerate(rows)], "page_id long, url string, html string, host string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in
           url_alias.judge_urls(df, url_alias.rules_table(spark, RULES)).collect()}
    assert got[0] == ("bad.com", "/x/1", "bad.com/x/", "block") == got[13]
    assert got[1] == ("good.bad.com", "/x/1", "good.bad.com/x/", "allow")
    assert got[2] == ("notbad.com", "/x/", "com/", "allow")
    # Aliases of a blocked address, over two links.
    assert [got[k][3] for k in (3, 4, 5)] == ["block"] * 3 and got[3][2] is None
    # One alias is explicitly allowed, another blocked: allowed.
    assert [got[k][3] for k in (6, 7, 8, 9)] == ["allow"] * 4
    assert got[10][3] == "allow" and got[11] == ("", "", None, "allow") == got[12]
    redirects = spark.createDataFrame([("http://lone.net/x", "http://k.org/x/")], "source string, target string")
    again = url_alias.judge_urls(df, url_alias.rules_table(spark, RULES), redirects).where("page_id = 10").first()
    assert again["verdict"] == "block" and again["alias_verdict"] == "block"
    assert url_alias.judge_urls(df.limit(0), url_alias.rules_table(spark, RULES)).count() == 0
    assert {r["verdict"] for r in url_alias.judge_urls(df, url_alias.rules_table(spark, RULES).limit(0)).collect()} == {"allow"}


LAYOUTS = [
    ({"prompt": "p", "completion": "c"}, [("user", "p"), ("assistant", "c")]),
    ({"response": "c", "prompt": "p"}, [("user", "p"), ("assistant", "c")]),
    ({"instruction": "i", "input": "", "output": "o"}, [("user", "i"), ("assistant", "o")]),
    ({"instruction": "i", "input": "x", "output": "o"}, [("user", "i\nx"), ("assistant", "o")]),
    ({"messages": [{"role": "user", "content": "a"}, {"role": "assistant", "content": None}]}, [("user", "a"), ("assistant", "")]),
    ({"system": "s", "messages": [{"content": "a", "role": "user"}]}, [("system", "s"), ("user", "a")]),
    ({"conversations": [{"from": "human", "value": "h"}, {"from": "gpt", "value": 5}]}, [("user", "h"), ("assistant", "5")]),
    ({"question": "q", "answer": "a"}, [("user", "q"), ("assistant", "a")]),
    ({"role": "user", "text": None, "turn": 3}, [("user", "")]),
    ({"unknown": {"deep": [1]}}, None),
]


def test_layouts(spark):
    df = spark.createDataFrame([(k, json.dumps(r), 1) for k, (r, _) in enumerate(LAYOUTS)] + [(99, None, 1)], "id int, j string, turns int")
    got = {r["id"]: r for r in chat_layout.canonical_turns(df, F.parse_json("j")).collect()}
    for k, (_, want) in enumerate(LAYOUTS):
        turns = got[k]["turns"]
        assert (turns if turns is None else [tuple(t) for t in turns]) == want, k
    assert got[99]["turns"] is None
    assert got[0]["fingerprint"] != got[1]["fingerprint"] and len(got[9]["fingerprint"]) > 8


def test_formatting_is_reversible(spark):
    hard = ["", "<|end|>", "<|turn|>user<|text|>", "<⁠|x", "[INST] <<SYS>> a <</SYS>> [/INST]", "<s></s>", "<⁠⁠/s>", "plain \\ $1 🙂", "<<|end|>",
            "[/INST", "\n<|", "<"]
    rows = [(1, k, "assistant" if k % 2 else "user", t) for k, t in enumerate(hard)]
    rows += [(2, 0, "<|text|>", "x"), (2, None, None, None), (None, 0, "assistant", "n"), (1, 3, "assistant", hard[3])]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    made = chat_layout.format_conversations(df)
    got = {r["conv_id"]: r for r in chat_layout.read_conversations(made).collect()}
    want = sorted([(k, "assistant" if k % 2 else "user", t) for k, t in enumerate(hard)] + [(3, "assistant", hard[3])])
    assert [tuple(t) for t in got[1]["turns"]] == [w[1:] for w in want]
    assert got[1]["loss_text"] == "".join(t for _, r, t in want if r == "assistant")
    assert [tuple(t) for t in got[2]["turns"]] == [("", ""), ("<|text|>", "x")] and got[2]["loss_text"] == ""
    assert got[None]["loss_text"] == "n"
    # No control string of a text stands in the output as it was.
    assert got[1]["formatted"].count("<|end|>") == len(want) and "</s>" not in got[1]["formatted"] and "[INST]" not in got[1]["formatted"]
    assert chat_layout.format_conversations(df.limit(0)).count() == 0


ITEMS = [
    (1, "A train leaves with 40 km to go, and Anna Smith waits for 5 hours before 40 km pass by slowly."),
    (2, "short item here"), (3, None), (4, ""), (2, "short item here"), (5, "the river bends toward the old stone mill near our quiet little town today"),
]


def leaks(spark, texts):
    docs = spark.createDataFrame([(k, t, "x") for k, t in enumerate(texts)], "doc_id long, text string, item_id string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    return {(r["doc_id"], r["item_id"]): (r["n_windows"], r["n_consistent"]) for r in template_leaks.find_leaks(docs, items).collect()}


def test_templates(spark):
    same = "before it all. " + ITEMS[0][1] + " after"
    other_values = same.replace("40", "70").replace("Anna Smith", "Bob Green").replace("5", "12")
    broken = other_values.replace("before 70", "before 71")
    texts = [same, other_values, broken, "A short item here!", "nothing", None, "", "THE RIVER bends toward the old stone mill near our",
             "the river bends toward the old stone mill near our quiet little town today " * 3, "the " * 3000]
    got = leaks(spark, texts)
    assert got[0, 1][0] == got[0, 1][1] and got[1, 1] == got[0, 1]
    # 40 stands for 70 and for 71: windows with either do not count.
    assert (2, 1) not in got or got[2, 1][1] < got[2, 1][0]
    assert (3, 2) in got and got[8, 5] == (7, 7)
    assert {d for d, _ in got} - {2} == {0, 1, 3, 8}


def test_dropping_keeps_the_rest(spark):
    rows = [(1, "A short item here!", "en"), (1, "clean words only", "en"), (None, "short item here", "de"), (None, "clean", None), (3, None, None), (4, "", "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    kept = template_leaks.drop_leaks(docs, items)
    assert kept.columns == docs.columns
    assert sorted(((r["text"] or "-") for r in kept.collect())) == ["", "-", "clean", "clean words only"] or {
        r["text"] for r in kept.collect()} == {None, "", "clean", "clean words only"}
    assert template_leaks.drop_leaks(docs.limit(0), items).count() == 0
    assert template_leaks.drop_leaks(docs, items.limit(0)).count() == len(rows)


def test_templates_in_any_context(spark):
    """Other names at sentence starts; short items after a colon or comma; copies wrapped anew."""
    items = [(1, "Tom has 3 red apples. Mary gives 4 more. Tom then eats 2 of them. How many are left?"), (2, "Which planet is the largest one?"),
             (3, "Every river here runs down to a wide sea."), (4, "Which old city did King Alfred defend near 40 km of wall and water?"),
             (5, "Anna, Bob, Carl, Dora, Emil, Fred, Gus, Hans, Ida, Jan, Karl, Lena")]
    texts = ["Bob has 5 red apples. Anna gives 6 more. Bob then eats 3 of them. How many are left?", "Question: Which planet is the largest one?",
             "so, Every river here runs down to a wide sea.", "Which old\ncity did\n  King\tAlfred defend\nnear 40\n km of wall and\nwater?",
             "Bob has 5 red apples. Anna gives 6 more. Carl then eats 3 of them. How many are left?",
             "Rita, Sam, Theo, Ulf, Vera, Willi, Xaver, Yann, Zoe, Otto, Paul, Quin", "WHICH PLANET IS THE LARGEST ONE", "Which planet is the smallest one?"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = template_leaks.find_leaks(docs, spark.createDataFrame(items, "item_id long, text string")).collect()
    got = {(r["doc_id"], r["item_id"]) for r in found}
    assert got - {(4, 1), (5, 5)} == {(0, 1), (1, 2), (2, 3), (3, 4), (6, 2)}
    # Tom stands for Bob and for Carl: fewer windows than in document 0.
    n = {(r["doc_id"], r["item_id"]): r["n_consistent"] for r in found}
    assert n.get((4, 1), 0) < n[0, 1]


def test_long_list_of_values_takes_no_power_of_its_length(spark):
    values = [str(100 + k) for k in range(64)]
    items = spark.createDataFrame([(1, " ".join(values))], "item_id long, text string")
    texts = ["so " + " ".join(str(900 + k) for k in range(64)), "so " + " ".join(["900"] + [str(900 + k) for k in range(63)])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    began = time.monotonic()
    got = {r["doc_id"]: (r["n_windows"], r["n_consistent"]) for r in template_leaks.find_leaks(docs, items).collect()}
    # 900 would stand for the first two values; one place further on all values differ.
    assert got == {0: (57, 57), 1: (56, 56)}
    assert time.monotonic() - began < 30


def test_relative_targets(spark):
    base = "http://h.net/d/e/p?q=1#f"
    want = {"page2.html": "/d/e/page2.html", "../a": "/d/a", "./x": "/d/e/x", "?id=3": "/d/e/p?id=3", "../../../a/./b?u=../v": "/a/b?u=../v", "/r/../s": "/s",
            "..": "/d/", "mailto:a@b.net": None, "#top": None, "//k.net/z": "//k.net/z"}
    rows = [(base, page(base, t)[1]) for t in want] + [page("http://bare.net", refresh="x")]
    links = url_alias.page_links(spark.createDataFrame(rows, "url string, html string")).collect()
    urls = {"http:" + w if w.startswith("//") else "http://h.net" + w for w in want.values() if w}
    assert {r["b"] for r in links} == urls | {"http://bare.net/x"}


def test_all_readings_share_the_looks_at_a_text(spark, monkeypatch):
    plans, store = {}, template_leaks.materialize

    def kept(df, label):
        plans[label] = df._jdf.queryExecution().optimizedPlan().toString()
        return store(df, label)

    monkeypatch.setattr(template_leaks, "materialize", kept)
    items = spark.createDataFrame([(1, "How many apples does Anna have if she buys 3 bags of 12 apples each day?")], "item_id long, text string")
    docs = spark.createDataFrame(
        [(1, "First.  How many apples does Bob have if she buys 5 bags of 20 apples each day?"), (2, None), (3, "no such thing")],
        "doc_id long, text string")
    assert [r["doc_id"] for r in template_leaks.find_leaks(docs, items).collect()] == [1]
    assert plans["aligned"].count(template_leaks.BLANKS) == 1
    assert plans["aligned"].count(f", {template_leaks.DIGIT})") == 1


def test_long_runs_fit_the_stack_of_a_task(spark):
    """Runs of names and of numbers far beyond what one stack frame for each would allow; an item after each."""
    names, numbers = "Alpha " * 20_000, "1" + ",22" * 20_000
    texts = [f"we saw {names}and then {ITEMS[5][1]}", f"we saw {numbers} and then {ITEMS[5][1]}", f"{names}{numbers} km", ITEMS[5][1]]
    got = leaks(spark, texts)
    assert got == {(0, 5): (7, 7), (1, 5): (7, 7), (3, 5): (7, 7)}
    words = spark.createDataFrame([(texts[2],)], "text string").select(
        *(F.size(template_leaks.template_tokens(F.col("text"), r)) for r in template_leaks.READINGS)).first()
    # The number and its unit come last. Inside sentences the first name of the text is a word.
    assert tuple(words) == (4, 20_002, 3)


def test_kept_runs_match_what_the_patterns_match(spark):
    draw, t = np.random.default_rng(5), template_leaks
    parts = ["Alpha ", "Beta", "GammaX ", "Delta9", "A ", "a", "so ", " ", "  ", "\n", ",", ".", "kg", " kg ", "%", "5", "12 ", "1.5", "3,4 ", "7.", "1,2,3 km ", "\u0662", "\u00c9a "]
    rows = [("".join(draw.choice(parts, draw.integers(1, 15))),) for _ in range(5_000)]
    pairs = [(t.NAME_RUN, t.NAMES_KEPT), (t.CAPITALS, t.CAPITALS_KEPT), (t.NUMBER_UNIT, t.UNIT_KEPT), (t.NUMBER_ONLY, t.NUMBER_KEPT)]
    same = [F.regexp_replace("text", a, "<$1|$2>") == F.regexp_replace("text", b, "<$1|$2>") for a, b in pairs]
    found = [F.sum(F.col("text").rlike(a).cast("int")) for a, _ in pairs]
    got = spark.createDataFrame(rows, "text string").select(*(F.min(s) for s in same), *found).first()
    assert all(got[:4]) and min(got[4:]) > 500

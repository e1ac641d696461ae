"""The training-data operators on hand-made rows and against brute force."""

from __future__ import annotations

import hashlib
import itertools
import json
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from lakegauge.llm import (
    bpe,
    chat,
    common,
    components,
    decontaminate,
    html,
    language,
    linededup,
    ngramjoin,
    pii,
    quality,
    queries,
    rans,
    shingles,
)
from lakegauge.llm.boosting import boost
from lakegauge.llm.shingles import exact_set, hashed_sets

SCHEMA = "doc_id bigint, text string, kept string, n bigint, words string, key int"
LONG = "alpha beta gamma delta epsilon zeta eta theta. " * 3000
ODD = [
    (1, None),
    (2, ""),
    (3, " \t\n"),
    (4, "Tie."),
    (4, "Tie."),
    (None, "A row without an id, but with some words in it."),
    (5, LONG),
    (6, "one\ntwo\n\nthree 漢字 é́ <|endoftext|> x"),
]


@pytest.fixture
def odd(spark):
    """Nulls, empty and long texts, repeated rows, columns of clashing names."""
    return spark.createDataFrame([(i, t, "k", 1, "w", 2) for i, t in ODD], SCHEMA)


@pytest.fixture
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def docs_of(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")


def rows(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


# 1 quality


def brute_quality(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
    repeated = {
        k + d for k, w in enumerate(windows) if windows.count(w) > 1 for d in range(3)
    }
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    dups = sum(x in lines[:k] for k, x in enumerate(lines))
    return len(words), sum(map(len, words)), dups, len(repeated)


@given(st.text("ab \n\t|é\x1c", max_size=60))
def test_quality_figures(text):
    got = quality.judge(text, quality.Limits(), True)
    assert (got[0], got[1], got[3], got[4]) == brute_quality(text)


def test_quality_rules(spark, odd, none):
    good = " ".join(f"A{k} sentence{k} that{k} reads{k} and ends{k}." for k in range(20))
    menu = "\n".join(f"home{k} | about{k} | news{k} | shop{k} |" for k in range(40))
    loud = " ".join(f"WORD{k}!!" for k in range(80))
    texts = [good, good + "\n" + menu, menu, loud]
    table = quality.clean_lines(docs_of(spark, texts)).orderBy("doc_id").collect()
    assert [r.kept for r in table] == [True, False, False, False]
    assert table[1].clean_text == good
    assert quality.clean_lines(odd).count() == len(ODD)
    assert quality.clean_lines(none).count() == 0


# 2 n-gram join


def brute_components(texts):
    sets = [exact_set(t) for t in texts]
    label = list(range(len(texts)))
    for _ in texts:
        for a, x in enumerate(sets):
            for b, y in enumerate(sets):
                k = len(x & y)
                if k and 100 * k >= 75 * (len(x) + len(y) - k):
                    label[a] = label[b] = min(label[a], label[b])
    return label


def near_copies(seed, n=40):
    rnd = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(300)]
    bases = [[rnd.choice(vocabulary) for _ in range(rnd.randrange(3, 60))] for _ in range(6)]
    texts = []
    for _ in range(n):
        words = list(rnd.choice(bases))
        for _ in range(rnd.randrange(0, 4)):
            words[rnd.randrange(len(words))] = rnd.choice(vocabulary)
        texts.append(" ".join(words))
    return texts + ["", "Same Words", "same words", texts[0]]


@pytest.mark.parametrize("seed", [1, 2])
def test_join_equals_brute_force(spark, seed):
    texts = near_copies(seed)
    table = ngramjoin.ngram_join(docs_of(spark, texts)).orderBy("doc_id").collect()
    assert [r.n_shingles for r in table] == [len(exact_set(t)) for t in texts]
    assert [r.component_id for r in table] == brute_components(texts)


def test_join_odd_rows(spark, odd, none):
    table = ngramjoin.ngram_join(odd)
    got = {(r.doc_id, r.n_shingles, r.component_id) for r in table.collect()}
    assert table.count() == len(ODD)
    assert {(1, 0, 1), (2, 0, 2), (4, 1, 4), (None, 7, None)} <= got
    assert ngramjoin.ngram_join(none).count() == 0
    assert ngramjoin.one_of_each(odd).columns == odd.columns


def test_join_in_small_chunks(spark, monkeypatch):
    texts = near_copies(3)
    chunk = ngramjoin._Chunk
    monkeypatch.setattr(chunk, "full", lambda self: len(self.members) >= 7)
    table = ngramjoin.ngram_join(docs_of(spark, texts)).orderBy("doc_id").collect()
    assert [r.component_id for r in table] == brute_components(texts)


@given(st.lists(st.text("aB \n", max_size=30) | st.none(), max_size=6))
def test_hashed_sets_have_the_exact_sizes(texts):
    sizes = [len(exact_set(t)) for t in texts]
    assert [len(s) for s in hashed_sets(texts)] == sizes


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(40)], "a bigint, b bigint")
    assert {r.component for r in components.components(links).collect()} == {0}


# 3 html

PAGE = """<html><head><title>t</title></head><body><nav><a href=x>Home</a></nav>
<div class="cookie-notice">We use cookies.</div><article><header><h1>T &amp; x</h1>
</header><p>Real  text, of a<br>story. &eacute;<p><b>Second one.</b></p>
<div class="ad">Buy</div><ul><li>one item.<li>two</ul><form>Name</form></article>
<script>var t="</p>";</script><div id="comments"><p>Nice.</p></div>
<footer>(c)</footer></body></html>"""
TEXT = "T & x\nReal text, of a story. é\nSecond one.\none item.\ntwo"


def test_html_blocks(spark):
    pages = spark.createDataFrame(
        [(1, "u", PAGE), (1, "u", PAGE), (2, None, None), (None, "v", "<p>a<p"), (3, "w", "")],
        "page_id bigint, url string, html string",
    )
    got = rows(html.main_text(pages, html.fit(pages)))
    assert got.count((1, "u", TEXT, len(TEXT))) == 2
    assert (2, None, "", 0) in got and (3, "w", "", 0) in got and len(got) == 5
    none = pages.where("false")
    assert html.main_text(none, html.fit(none)).count() == 0


def test_html_messages_give_exact_marginals():
    nodes = html.parse("<div><p>Some text.</p><p>More</p></div>")
    model = html.fit_pages([PAGE])
    odds = html.features(nodes) @ model.weights
    weight = np.zeros(len(nodes))
    total = 0.0
    for state in np.ndindex(*[2] * len(nodes)):
        value = sum(o * s for o, s in zip(odds, state))
        value += sum(
            model.together[state[n.parent], s] for n, s in zip(nodes[1:], state[1:])
        )
        total += np.exp(value)
        weight += np.exp(value) * np.array(state)
    assert np.allclose(html.marginals(nodes, model), weight / total)


def test_html_without_marks(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    texts = [r.html for r in pages.collect()]
    model = html.fit_pages(texts[:100])
    right = 0
    for text in texts[100:]:
        bare = re.sub(r"<(/?)(article|nav|footer)>", r"<\1div>", text)
        bare = bare.replace('class="ad"', "")
        right += html.extract(bare, model) == html.extract(text, model)
    assert right >= 0.95 * len(texts[100:])


# 4 line dedup


def test_line_dedup(spark, odd, none):
    texts = [f"own {k}\n  SHARED line \n\nShared Line" for k in range(10)] + ["x\n", None]
    got = linededup.line_dedup(docs_of(spark, texts)).orderBy("doc_id").collect()
    assert [(r.kept, r.n_lines, r.n_dropped) for r in got] == [
        *[(f"own {k}\n", 4, 2) for k in range(10)],
        ("x\n", 2, 0),
        ("", 1, 0),
    ]
    assert got[0].bits == [0b1010]
    assert linededup.line_dedup(odd).count() == len(ODD)
    # Repeated rows count one by one.
    assert {r.kept for r in linededup.line_dedup(odd, min_docs=2).collect() if r.doc_id == 4} == {""}
    assert linededup.line_dedup(none).count() == 0


def test_line_dedup_of_many_lines(spark):
    rnd = random.Random(5)
    texts = ["\n".join(str(rnd.randrange(300)) for _ in range(150)) for _ in range(30)]
    got = linededup.line_dedup(docs_of(spark, texts)).orderBy("doc_id").collect()
    having = {str(k): sum(str(k) in t.split("\n") for t in texts) for k in range(300)}
    for row, text in zip(got, texts):
        assert row.kept == "\n".join(x for x in text.split("\n") if having[x] < 10)


# 5 BPE

BYTE_BPE = queries.vocabulary_path("byte_bpe_50k.json")
WORD_BPE = queries.vocabulary_path("word_bpe_49k.json")
MIXED = st.text("abcdeth  \n\t'sDÉé1²9!…\x1c 　漢😀", max_size=40)


@pytest.fixture(scope="module")
def byte_bpe():
    with open(BYTE_BPE, encoding="utf-8") as file:
        vocabulary = file.read()
    return bpe.Cache(bpe.TrieEncoder(vocabulary)), Tokenizer.from_str(vocabulary)


@settings(max_examples=300, deadline=None)
@given(st.lists(MIXED | st.text(max_size=20), max_size=5))
def test_bpe_equals_the_library(byte_bpe, texts):
    cache, library = byte_bpe
    texts = [t + "<|endoftext|> the" * (len(t) % 3 == 1) for t in texts]
    for text, got in zip(texts, bpe.round_trip(cache, texts, True)):
        ids = library.encode(text, add_special_tokens=False).ids
        assert got[3] == ids and got[0] == len(ids)
        assert got[4] == library.decode(ids, skip_special_tokens=False)


def test_bpe_table(odd, none):
    table = bpe.encode_and_decode(odd, BYTE_BPE).collect()
    assert len(table) == len(ODD)
    for row in table:
        assert row.decoded_sha256 == hashlib.sha256(row.decoded.encode()).hexdigest()
    assert {r.decoded for r in table} == {t or "" for _, t in ODD}
    assert bpe.encode_and_decode(none, BYTE_BPE).count() == 0


# 6 personal data


@given(st.text("ab@.+ 0123456789()-\n", max_size=50))
def test_strict_spans(text):
    kinds = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+",
        "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    }

    def good(kind, span):
        digits = re.sub("[^0-9]", "", span)
        if kind == "ip":
            return all(int(p) <= 255 for p in span.split("."))
        if kind == "card":
            doubled = [int(d) * (1 + k % 2) for k, d in enumerate(digits[::-1])]
            total = sum(d - 9 * (d > 9) for d in doubled)
            return 13 <= len(digits) <= 19 and total % 10 == 0
        return kind == "email" or 9 <= len(digits) <= 15

    assert pii.strict_spans(text) == {
        kind: [m.span() for m in re.finditer(p, text) if good(kind, m.group())]
        for kind, p in kinds.items()
    }


def test_personal_data(spark, odd, none):
    docs = queries.documents(spark, "/root/testdata/sf0.01")
    model = pii.fit(docs)
    assert model.booster is not None and model.threshold >= 0.5
    text = "Write to a.b@c.org or call (743) 555-3824, card 4111 1111 1111 1111."
    found = pii.find(text, model)
    assert [text[s:e] for s, e, _ in found["email"]] == ["a.b@c.org"]
    assert [text[s:e] for s, e, _ in found["card"]] == ["4111 1111 1111 1111"]
    assert "a.b@c.org" not in pii.redact(text, found)
    clean = "Version 2.0 of 1999, part 12 of 40, 3.14 or 1,000,000 at the end."
    assert not any(pii.find(clean, model).values())
    assert pii.find_personal_data(odd, model).count() == len(ODD)
    assert pii.find_personal_data(none, pii.fit(none)).count() == 0


def test_trees_learn_a_border():
    x = np.random.default_rng(1).normal(size=(2000, 3))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(float)
    model = boost(x[:1000], y[:1000])
    assert ((model.probability(x[1000:]) > 0.5) == y[1000:]).mean() > 0.95


# 7 language


def test_language_held_out_accuracy(spark):
    docs = queries.documents(spark, "/root/testdata/sf0.01")
    found = queries.op7_language_id(spark, "/root/testdata/sf0.01")
    both = found.join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in both)
    assert np.mean([r.lang == r.lang_pred for r in both]) > 0.97


def test_language_mixture():
    texts = {"x": "aba bab abba baab", "y": "cdc dcd cddc dccd"}
    counts = np.full((language.BUCKETS, 2), 0.3)
    for k, text in enumerate(texts.values()):
        counts[:, k] += np.bincount(
            language.trigrams(text.encode())[0], minlength=language.BUCKETS
        )
    scores = np.log(counts / counts.sum(axis=0)).astype(np.float32)
    model = language.Model(tuple(texts), scores)
    got = language.infer(model, ["aba bab aba bab cdc " * 20, None, "12 -", "cdc"])
    assert got[0][0] == "x" and abs(got[0][1] - 0.8) < 0.05
    assert got[1] == got[2] == ("und", 0.0)
    assert got[3] == ("y", 1.0)
    tied = language.Model(("x", "y"), np.zeros((language.BUCKETS, 2), np.float32))
    assert language.infer(tied, ["abc"])[0][0] == "x"  # the first in order


def test_language_mixture_of_more_than_three():
    texts = {"u": "aba bab", "v": "cdc dcd", "w": "efe fef", "x": "ghg hgh"}
    # Two near copies of x take their part of it only if all six are allowed.
    texts |= {"y": texts["x"], "z": texts["x"]}
    counts = np.full((language.BUCKETS, 6), 0.3)
    for k, text in enumerate(texts.values()):
        seen = np.bincount(language.trigrams(text.encode())[0], minlength=language.BUCKETS)
        counts[:, k] += seen * (0.999 if k > 3 else 1)
    model = language.Model(
        tuple(texts), np.log(counts / counts.sum(axis=0)).astype(np.float32)
    )
    four = "aba bab cdc dcd efe fef ghg hgh ghg hgh " * 20
    got = language.infer(model, ["aba bab " * 9, four, "cdc dcd"])
    assert [lang for lang, _ in got] == ["u", "x", "v"]
    assert abs(got[1][1] - 0.4) < 0.02 and got[0][1] == got[2][1] == 1.0


def test_language_odd_rows(odd, none):
    labelled = odd.selectExpr("*", "if(doc_id = 4, NULL, 'en') AS lang")
    table = language.identify_held_out(labelled)
    assert table.count() == len(ODD)
    assert language.identify_held_out(none.selectExpr("*", "'x' AS lang")).count() == 0


# 8 chat

TOOLS = {
    "add": {
        "type": "object",
        "required": ["a"],
        "properties": {"a": {"type": "integer", "minimum": 0}, "b": {"type": "number"}},
        "additionalProperties": False,
    }
}


def call(call_id, arguments, name="add"):
    return {"id": call_id, "name": name, "arguments": arguments}


def test_chat_links(spark):
    turns = [
        (0, "user", "Hi"),
        (1, "tool", json.dumps({"tool_call_id": "c1", "content": 3})),
        (2, "assistant", json.dumps({"content": "é", "tool_calls": [
            call("c2", {"a": {"$ref": "c1"}}), call("c1", {"b": 1.5, "a": 1})]})),
        (3, "tool", json.dumps({"tool_call_id": "zz", "content": "?"})),
        (4, "assistant", json.dumps({"tool_calls": [
            call("c3", {"a": -1}), call("c4", {"a": True}), call("c5", {}, "gone"),
            call("c6", {"a": {"$ref": "c7"}}), call("c7", {"a": {"$ref": "c6"}}),
            call("c1", {"a": 1})]})),
        (5, None, None),
        (6, "assistant", "{not json"),
    ]
    table = spark.createDataFrame(
        [(1, *t) for t in turns] + [(None, 0, "user", "x"), (1, 0, "user", "Hi")],
        "conv_id bigint, turn bigint, role string, text string",
    )
    got = chat.link_tool_calls(table, TOOLS).collect()
    place = {(r.kind, r.call_id, r.turn): (r.status, r.order_turn, r.level) for r in got}
    assert place["result", "c1", 1] == ("ok", 2, 1)
    assert place["call", "c1", 2] == ("ok", 2, 0)
    assert place["call", "c2", 2] == ("unanswered", 2, 2)
    assert place["result", "zz", 3][0] == "orphan"
    statuses = {c: place["call", c, 4][0] for c in ("c1", "c3", "c4", "c5", "c6", "c7")}
    assert statuses == {
        "c1": "duplicate", "c3": "bad_arguments", "c4": "bad_arguments",
        "c5": "unknown_tool", "c6": "cycle", "c7": "cycle",
    }
    texts = [r.message for r in got]
    assert texts.count('{"content":"Hi","role":"user"}') == 2
    assert '{"content":"","role":"unknown"}' in texts
    add = '{"role":"assistant","tool_call":{"arguments":{"a":1,"b":1.5},"id":"c1","name":"add"}}'
    assert add in texts
    assert chat.link_tool_calls(table.where("false"), TOOLS).count() == 0


def test_chat_order_across_turns(spark):
    ref = lambda k: {"a": {"$ref": k}}
    turns = [
        (1, json.dumps({"tool_call_id": "early", "content": 0})),
        (2, json.dumps({"tool_calls": [call("late", ref("first")), call("early", ref("late"))]})),
        (3, json.dumps({"tool_call_id": "late", "content": 2})),
        (4, json.dumps({"tool_calls": [call("first", {"a": 1}), call("own", ref("late"))]})),
        (6, json.dumps({"tool_call_id": "first", "content": 1})),
        (7, json.dumps({"tool_call_id": "own", "content": 3})),
    ]
    table = spark.createDataFrame(
        [(1, t, "tool", text) for t, text in turns],
        "conv_id bigint, turn bigint, role string, text string",
    )
    got = chat.link_tool_calls(table, TOOLS).collect()
    place = {(r.kind, r.call_id): (r.order_turn, r.level, r.part) for r in got}
    assert all(r.status == "ok" for r in got)
    for before, after in (("first", "late"), ("late", "early"), ("late", "own")):
        assert place["call", before] < place["result", before] < place["call", after]
    assert place["call", "early"] < place["result", "early"]
    assert place["call", "own"] < place["result", "own"]
    assert place["call", "first"] == (4, 0, 0)


def test_chat_schemas_come_from_the_data(spark, tmp_path):
    def tools(*listed):
        return json.dumps({"tools": listed})

    def calls(*made):
        return json.dumps({"tool_calls": made})

    def answer(call_id):
        return json.dumps({"tool_call_id": call_id, "content": 1})

    text = {"type": "object", "properties": {"a": {"type": "string"}}}
    add = {"name": "add", "parameters": TOOLS["add"]}
    rows_ = [
        (1, 0, "system", tools(add, {"name": "bare"},
                               {"name": "odd", "parameters": {"type": "thing"}})),
        (1, 1, "assistant", calls(
            call("a", {"a": 1}), call("b", {"a": "x"}), call("c", {}, "gone"),
            call("d", {}, "bare"), call("e", {}, "odd"), call(None, {"a": -1}))),
        (1, 2, "system", tools(add)),
        (1, 3, "developer", tools({"type": "function", "function": {
            "name": "add", "parameters": text}})),
        (1, 4, "assistant", calls(call("f", {"a": 1}), call("g", {"a": "x"}))),
        *[(1, 5, "tool", answer(k)) for k in "abcdefg"],
        (2, 0, "user", tools(add)),  # no declaration
        (2, 1, "assistant", calls(call("a", {"a": 1}))),
        (2, 2, "tool", answer("a")),
        (3, 0, "assistant", calls(call("a", {"a": 1}), call("z", {"a": 1}, "gone"))),
        (3, 1, "system", tools(add)),
        (3, 2, "tool", answer("a")),
        (None, 0, "system", tools(add)),
        (None, 1, "assistant", calls(call("a", {"a": 1}))),
    ]
    schema = "conv_id bigint, turn bigint, role string, text string"
    spark.createDataFrame(rows_, schema).write.parquet(f"{tmp_path}/conversations.parquet")
    got = queries.op8_chat(spark, str(tmp_path)).collect()
    statuses = {(r.conv_id, r.call_id): r.status for r in got if r.kind == "call"}
    assert statuses == {
        (1, "a"): "ok", (1, "b"): "bad_arguments", (1, "c"): "unknown_tool",
        (1, "d"): "no_schema", (1, "e"): "bad_schema", (1, None): "bad_arguments",
        (1, "f"): "bad_arguments", (1, "g"): "ok", (2, "a"): "no_schema",
        (3, "a"): "ok", (3, "z"): "unknown_tool", (None, "a"): "no_schema",
    }
    assert len(got) == len(rows_) + 7  # a message each, and one more per further call


def test_chat_whole_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    want = sorted(
        (r.conv_id, r.turn, chat.canonical({"role": r.role, "content": r.text}))
        for r in table.collect()
    )
    got = queries.op8_chat(spark, "/root/testdata/sf0.001")
    assert sorted((r.conv_id, r.turn, r.message) for r in got.collect()) == want


# 9 decontamination


def test_decontamination(spark, odd, none):
    rnd = random.Random(9)
    item = [f"q{k}" for k in range(40)]
    changed = [w if k % 8 else "other" for k, w in enumerate(item)]
    filler = [f"f{rnd.randrange(50)}" for _ in range(100)]
    texts = [
        " ".join(filler + item + filler),
        " ".join(filler + changed).upper(),
        " ".join(filler + item[10:25] + filler),
        " ".join(filler + item[10:17] + filler),
        " ".join(filler),
        "",
        None,
    ]
    benchmark = spark.createDataFrame(
        [(7, " ".join(item)), (8, "too short an item"), (None, None), (9, "")],
        "item_id bigint, text string",
    )
    docs = docs_of(spark, texts)
    got = decontaminate.contaminated(docs, benchmark).orderBy("doc_id").collect()
    assert [r.contaminated for r in got] == [True, True, True, False, False, False, False]
    left = decontaminate.remove_contaminated(docs, benchmark)
    assert sorted(r.doc_id for r in left.collect()) == [3, 4, 5, 6]
    assert decontaminate.contaminated(odd, benchmark).count() == len(ODD)
    assert decontaminate.contaminated(none, benchmark).count() == 0
    assert decontaminate.contaminated(odd, benchmark.where("false")).where("contaminated").count() == 0


@pytest.mark.parametrize("long", range(1, decontaminate.WINDOW + 1))
def test_masks_hit_every_accepted_window(long):
    differ = long - -(-decontaminate.MIN_EQUAL * long // 100)
    masks = decontaminate.masks_of(long)
    placed = [
        {start + k for k in m} for m in masks for start in range(long - m[-1])
    ]
    for places in itertools.combinations(range(long), differ):
        assert any(not seed & set(places) for seed in placed)


def brute_matches(docs, items):
    """Seedless: every alignment, every window."""
    found = {}
    for d, doc in enumerate(docs):
        doc = doc.split()
        for i, item in enumerate(items):
            item = item.split()
            long = min(decontaminate.WINDOW, len(item))
            best = 0
            for shift in range(1 - len(item), len(doc)):
                equal = [
                    0 <= shift + k < len(doc) and doc[shift + k] == w
                    for k, w in enumerate(item)
                ]
                best = max(
                    [best] + [sum(equal[k : k + long]) for k in range(len(item) - long + 1)]
                )
            if 100 * best >= decontaminate.MIN_EQUAL * long:
                found[d, i] = 100.0 * best / long
    return found


def test_decontamination_equals_brute_force(spark, monkeypatch):
    rnd = random.Random(13)
    items = [" ".join(f"i{n}x{k}" for k in range(n)) for n in [*range(1, 16), 30]]
    items.append("a b a c a b b a c c a b a")
    docs = ["", "a b", items[8][:-5], " ".join(rnd.choices("abc", k=200))]
    for item in items:
        words = item.split()
        docs.append(" ".join(w if k % 4 != 3 else "other" for k, w in enumerate(words)))
        for differ in (0, 1, 2, 3, 3, 4):
            changed = list(words)
            for k in rnd.sample(range(len(words)), min(differ, len(words))):
                changed[k] = "other"
            around = rnd.choices(["f", "g", "h"], k=rnd.randrange(4))
            docs.append(" ".join([*around, *changed, *reversed(around)]))
        docs.append(" ".join(words[len(words) // 5 :]))  # the item hangs over the start
    benchmark = spark.createDataFrame(
        list(enumerate(items)), "item_id bigint, text string"
    )
    want = brute_matches(docs, items)
    for limit in (decontaminate.MAX_BROADCAST_SEEDS, 0):
        monkeypatch.setattr(decontaminate, "MAX_BROADCAST_SEEDS", limit)
        got = decontaminate.matches(docs_of(spark, docs), benchmark).collect()
        assert {(r.doc_id, r.item_id): r.equal_pct for r in got} == pytest.approx(want)
        assert len(got) == len(want)


def test_large_benchmarks_are_not_broadcast(spark, monkeypatch):
    sf = "/root/testdata/sf0.001"
    small = rows(queries.op9_decontamination(spark, sf))
    monkeypatch.setattr(decontaminate, "MAX_BROADCAST_SEEDS", 0)
    assert rows(queries.op9_decontamination(spark, sf)) == small


# 10 token files


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 49407), min_size=1, max_size=400), st.integers(1, 700))
def test_blocks_round_trip(ids, times):
    ids = np.array(ids * times, np.uint16)[:200_000]
    table = rans.Table.of(ids)
    block = rans.encode_block(ids, rans.Table.from_bytes(table.to_bytes()))
    assert (rans.decode_block(block, table) == ids).all()


def test_a_part_of_a_block_decodes_alone():
    ids = np.random.default_rng(3).geometric(0.01, 900_000).astype(np.uint16)
    table = rans.Table.of(ids)
    block = rans.encode_block(ids, table)
    step = rans.LANES * rans.ROWS_PER_CHECKPOINT
    assert (rans.decode_part(block, 2, table) == ids[2 * step : 3 * step]).all()
    half = len(block) // 2
    damaged = block[:half] + bytes([block[half] ^ 1]) + block[half + 1 :]
    with pytest.raises(ValueError):
        rans.decode_block(damaged, table)


@settings(max_examples=200, deadline=None)
@given(st.lists(MIXED | st.text(max_size=20), max_size=5))
def test_words_equal_the_library(texts):
    with open(WORD_BPE, encoding="utf-8") as file:
        vocabulary = file.read()
    library = rans._tokenizer(vocabulary)._library
    for text, got in zip(texts, rans._tokenizer(vocabulary).encode(texts)):
        ids = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(got, "<u2").tolist() == ids


def test_token_files(spark, odd, none, tmp_path):
    with open(WORD_BPE, encoding="utf-8") as file:
        library = Tokenizer.from_str(file.read())
    for name, table in (("odd", odd), ("none", none)):
        root = str(tmp_path / name)
        rans.write_token_files(table, WORD_BPE, root)
        got = rans.read_token_files(spark, root).collect()
        texts = sorted(table.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0))
        start = 0
        for row, found in zip(texts, sorted(got, key=lambda r: r.start), strict=True):
            ids = library.encode(row.text or "", add_special_tokens=False).ids + [2]
            crc = zlib.crc32(np.array(ids, "<u4").tobytes())
            assert tuple(found) == (row.doc_id, start, len(ids), crc)
            start += len(ids)


def test_word_hashes_do_not_depend_on_blocks(monkeypatch):
    data = b" ".join([b"ab", b"c" * 40, b"\n", b"ab", b"de f"] * 9)
    whole, starts = shingles.word_hashes(data)
    monkeypatch.setattr(shingles, "BLOCK_BYTES", 16)
    cut, places = shingles.word_hashes(data)
    assert cut.tolist() == whole.tolist() and places.tolist() == starts.tolist()
    assert len(set(whole.tolist())) == len(set(data.split()))


def test_columns_are_read_in_slices(monkeypatch):
    monkeypatch.setattr(common, "SLICE_ROWS", 2)
    column = pa.array(["a", None, "bb", "", "c"])
    assert list(common.texts_of(column)) == column.to_pylist()
    assert list(common.groups(common.texts_of(column), 2)) == [
        ["a", None, "bb"], ["", "c"],
    ]
    assert list(common.texts_of(column.slice(0, 0))) == []

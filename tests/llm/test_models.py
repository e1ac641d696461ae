"""Learned operators beyond their fixed rules, and odd conversations and items."""

from __future__ import annotations

import itertools
import json
import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from lakegauge.llm import chat, decontaminate, html, language, pii, queries
from tests.llm.test_operators import ODD, docs_of, none, odd  # noqa: F401

SF = "/root/testdata/sf0.001"


# 3 html


def fixed_rule(page):
    """Text inside an article's mark, or anywhere without one, that no tag or
    class word calls something else."""
    nodes = html.parse(page)
    inside = html._below(nodes, lambda n: n.tag in html.ARTICLE_TAGS)
    others = html.other_flags(nodes)
    return "\n".join(
        n.text
        for n, i, o in zip(nodes, inside, others)
        if n.text and (i or not any(inside)) and not o
    )


def f1(got, wanted):
    one, other = Counter(got.split()), Counter(wanted.split())
    both = sum((one & other).values())
    return 2 * both / max(1, sum(one.values()) + sum(other.values()))


def test_model_beats_the_rule_without_marks(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").orderBy("page_id")
    texts = [row.html for row in pages.collect()]
    model = html.fit_pages(texts[:150])
    held_out = texts[150:]
    wanted = [fixed_rule(page) for page in held_out]
    assert [html.extract(page, model) for page in held_out] == wanted
    bare = [
        re.sub(r"<(/?)(article|nav|footer)>", r"<\1div>", page).replace(' class="ad"', "")
        for page in held_out
    ]
    learned = [f1(html.extract(page, model), text) for page, text in zip(bare, wanted)]
    ruled = [f1(fixed_rule(page), text) for page, text in zip(bare, wanted)]
    assert sum(learned) / len(learned) > 0.99 > 0.95 > sum(ruled) / len(ruled)


def test_hints_do_not_decide_alone(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    model = html.fit(pages)
    long = "The share of the market grew, as the figures of the year show, and stayed high."
    page = (
        "<nav><a href=x>Home</a></nav><article><h1>News of the year</h1>"
        f'<p>{long}</p><div class="market share"><p>{long}</p></div>'
        "<p>So <math><mi>E</mi><mo>=</mo><mi>m</mi></math> holds, in all of the cases.</p>"
        f'<section id="comments"><p>{long}</p></section></article><footer>c</footer>'
    )
    assert html.extract(page, model) == (
        f"News of the year\n{long}\n{long}\nSo E=m holds, in all of the cases."
    )


def test_pages_of_odd_shape(spark):
    deep = "<div>" * 3000 + "<p>deep down</p>"
    long = "<article>" + "<p>A sentence of a long page, one of many.</p>" * 5000
    pages = spark.createDataFrame(
        [(1, "u", deep, "x", 7), (1, "u", deep, "x", 7), (2, "u", long, "x", 7), (3, None, "", "", 0)],
        "page_id bigint, url string, html string, text string, n_chars int",
    )
    got = {r.page_id: r for r in html.main_text(pages, html.fit(pages)).collect()}
    assert got[2].text.count("\n") == 4999 and got[3].text == ""


def test_fit_is_bounded_and_without_copies(spark):
    page = "<article><p>{}. And some more words of it.</p></article><footer>c</footer>"
    copies = [(k, page.format("same")) for k in range(300)]
    others = [(k, page.format(f"page {k}")) for k in range(300, 320)]
    pages = spark.createDataFrame(copies + others, "page_id bigint, html string")
    one = html.fit(pages)
    two = html.fit(pages.dropDuplicates(["html"]))
    assert (one.weights == two.weights).all() and (one.together == two.together).all()


# 6 personal data


@pytest.fixture(scope="module")
def model(spark):
    return pii.fit(queries.documents(spark, "/root/testdata/sf0.01"))


@pytest.mark.parametrize(
    "text, kind, span",
    [
        ("Call me on (743) 555-3824 today", "phone", "(743) 555-3824"),
        ("Call me on 743-555-3824, please", "phone", "743-555-3824"),
        ("mail jo.doe at mail3 dot example dot com now", "email", "jo.doe at mail3 dot example dot com"),
        ("mail jo.doe [at] example.org now", "email", "jo.doe [at] example.org"),
        ("host 10[.]20[.]30[.]40 is down", "ip", "10[.]20[.]30[.]40"),
        ("paid with 9807915762804490 today", "card", "9807915762804490"),
        ('so token = "2abc3ff2ca8fb1e4c565a0eb63815530a948bdde" it is', "secret",
         'token = "2abc3ff2ca8fb1e4c565a0eb63815530a948bdde"'),
    ],
)
def test_spans_that_trees_add(model, text, kind, span):
    at = text.index(span)
    assert not any((at, at + len(span)) in own for own in pii.strict_spans(text).values())
    assert (at, at + len(span), False) in pii.find(text, model)[kind]
    assert span not in pii.redact(text, pii.find(text, model))


@pytest.mark.parametrize(
    "text",
    [
        "from 1998-2007 120 cars were sold, 14.5 per cent",
        "a ratio of 0.1234567890123456 was found",
        "we meet at noon dot and then leave",
        "password: required, and lang=english",
        "order 20240115123045123 of 12345678901234567890123",
        "pages 101-202 and sums of 120 340 5600 780",
        "see https://example.org/path/a-page-of-2020.html",
    ],
)
def test_look_alikes_stay(model, text):
    assert not any(pii.find(text, model).values())


def test_added_spans_on_held_out_texts(spark, model):
    """Texts of another table: what was planted is found, plain words are not."""
    forms = re.compile(
        r'(?i)token = "[0-9a-f]{40}"|(?<![0-9A-Za-z])[0-9]{16}(?![0-9A-Za-z])'
        r"|\+1 \([0-9]{3}\) 555-[0-9]{4}|[^\s]+@mail[0-9]\.example\.com"
    )
    planted = found = wrong = 0
    for row in spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("text").collect():
        text = row.text or ""
        spans = [s for own in pii.find(text, model).values() for s in own]
        for match in forms.finditer(text):
            planted += 1
            found += any(s <= match.start() and match.end() <= e for s, e, _ in spans)
        wrong += sum(
            not given and not forms.search(text[max(0, s - 1) : e + 1]) for s, e, given in spans
        )
    assert planted > 500 and found >= 0.97 * planted and wrong <= 0.01 * planted


def test_sample_of_personal_data_has_no_copies(spark):
    text = "Write to ab.{}@mail1.example.com or +1 (555) 555-12{} of it."
    rows = [(1, text.format(20, 20))] * 50 + [(k, text.format(k, k)) for k in range(10, 40)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    one, two = pii.fit(docs), pii.fit(docs.dropDuplicates(["text"]))
    assert one.thresholds == two.thresholds


# 7 language


def brute_mixture(model, text):
    """Proportions by expectation maximisation, word by word, for every set of
    the most probable languages."""
    n = len(model.languages)
    words = []
    for word in re.findall(rb"[^ \t-\r]+", text.lower().encode()):
        buckets = language.trigrams(b" " + word + b" ")[0]
        if len(buckets):
            total = model.scores[buckets].astype(np.float64).sum(axis=0)
            words.append(np.exp(np.maximum(total - total.max(), -60)))

    def shares_of(allowed):
        shares = allowed / allowed.sum()
        for _ in range(language.ROUNDS):
            parts = [w * shares / (w * shares).sum() for w in words]
            shares = sum(parts) / len(parts)
        return shares, sum(math.log((w * shares).sum()) for w in words)

    price = language.PENALTY * 0.5 * math.log(len(words) + 1)
    full, likelihood = shares_of(np.ones(n))
    ranked = sorted(range(n), key=lambda k: (-full[k], k))
    best, value = full, likelihood - n * price
    for size in range(1, n):
        allowed = np.array([float(k in ranked[:size]) for k in range(n)])
        own, likelihood = shares_of(allowed)
        if likelihood - size * price >= value:
            best, value = own, likelihood - size * price
    return model.languages[int(np.argmax(best))], float(best.max())


def test_mixtures_equal_word_by_word():
    rng = np.random.default_rng(7)
    rnd = random.Random(7)
    model = language.Model(
        tuple("abcde"), np.log(rng.dirichlet(np.ones(5) * 0.3, language.BUCKETS) + 1e-4)
        .astype(np.float32),
    )
    texts = [
        " ".join("".join(rnd.choices("abcdefgé", k=rnd.randint(1, 7))) for _ in range(n))
        for n in [1, 2, 5, 9, 20, 40, 60] * 6
    ]
    for text, (lang, score) in zip(texts, language.infer(model, texts)):
        wanted, share = brute_mixture(model, text)
        assert lang == wanted and abs(score - share) < 0.01


def test_neighbours_do_not_matter(spark):
    docs = queries.documents(spark, SF)
    fitted = language.fit(docs.select("text", "lang"))
    texts = [r.text for r in docs.collect()]
    alone = [language.infer(fitted, [text])[0] for text in texts]
    for (lang, score), (other, near) in zip(alone, language.infer(fitted, texts)):
        assert lang == other and abs(score - near) < 1e-5


def test_letters_are_letters():
    assert [language.has_letter(t) for t in ("²", "½ ①", "a²", "漢", None, "", "ª")] == [
        False, False, True, True, False, False, True,
    ]


# 8 chat


def turn(**body):
    return json.dumps(body)


def linked(spark, texts, role="assistant", schemas=None):
    rows = [(1, k, role, text) for k, text in enumerate(texts)]
    table = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    return chat.link_tool_calls(table, schemas).orderBy("turn", "part").collect()


def test_texts_that_are_not_quite_json(spark):
    deep = "[" * 2000 + "]" * 2000
    texts = [
        '{"tool_call_id":"c","content":"\\ud800"}',
        '{"tool_calls":[{"id":"a","name":"t","arguments":' + deep + "}]}",
        '{"tool_calls":[{"id":"a","name":"t","arguments":{"x":NaN}}]}',
        '{"tool_calls":[{"id":"a","name":"t","arguments":{"x":1e400}}]}',
        '{"tool_calls":[{"id":"a","id":"b","name":"t","arguments":{}}]}',
        '{"tool_call_id":"c","content":"' + "x" * 3_000_000 + '"}',
        '{"tool_calls":[{"id":"\\udc00","name":"t","arguments":"{}"}]}',
    ]
    got = linked(spark, texts, schemas={"t": {"type": "object"}})
    assert [(r.kind, r.status) for r in got] == [
        ("result", "orphan"), ("text", "ok"), ("text", "ok"), ("text", "ok"),
        ("text", "ok"), ("result", "orphan"), ("call", "unanswered"),
    ]
    assert "\\ud800" in got[0].message and got[6].call_id == "\\udc00"
    for row in got:
        json.loads(row.message)
    assert got[1].message == chat.canonical({"content": texts[1], "role": "assistant"})


@pytest.mark.parametrize(
    "value, schema, status",
    [
        ({"a": "xx"}, {"properties": {"a": {"minLength": 3}}}, "bad_arguments"),
        ({"a": "xx"}, {"properties": {"a": {"pattern": "^x+$"}}}, "ok"),
        ({"a": "xy"}, {"properties": {"a": {"pattern": "^x+$"}}}, "bad_arguments"),
        ({"a": 1}, {"properties": {"a": {"anyOf": [{"type": "string"}, {"minimum": 1}]}}}, "ok"),
        ({"a": 0}, {"properties": {"a": {"anyOf": [{"type": "string"}, {"minimum": 1}]}}},
         "bad_arguments"),
        ({"a": 2.0}, {"properties": {"a": {"type": "integer", "multipleOf": 2}}}, "ok"),
        ({"a": True}, {"properties": {"a": {"enum": [1]}}}, "bad_arguments"),
        ({"a": [1, 2]}, {"properties": {"a": {"maxItems": 1}}}, "bad_arguments"),
        ({"a": 1}, {"properties": {"a": {"$ref": "#/x"}}}, "unchecked"),
        ({"a": 1}, {"if": {}, "type": "object"}, "unchecked"),
        ({"a": 1}, {"type": "strange"}, "bad_schema"),
        ({"a": "x"}, {"properties": {"a": {"pattern": "("}}}, "bad_schema"),
        ({}, True, "ok"),
        ({"a": {"$ref": "c"}}, {"properties": {"a": {"type": "string"}}}, "ok"),
    ],
)
def test_schema_words(value, schema, status):
    assert chat.call_status(chat.canonical(value), chat.canonical(schema)) == status


def brute_links(turns):
    """(turn, part) -> (status, order_turn, level) of calls and results, by
    walking the conversation."""
    calls, results, places = {}, {}, {}
    for number, messages in enumerate(turns):
        for part, (kind, name, needs) in enumerate(messages):
            places[number, part] = (kind, name, needs)
            if kind == "call" and name not in calls:
                calls[name] = (number, part)
            if kind == "result":
                results.setdefault(name, []).append(number)
    solved = {}
    while True:
        fresh = {}
        for name, at in calls.items():
            needed = [n for n in places[at][2] if n in calls]
            if name in solved or any(n not in solved for n in needed):
                continue
            after = max([at[0], *(solved[n][1] for n in needed)])
            level = max([-1, *(solved[n][2] for n in needed)]) + 1
            fresh[name] = (after, max([after, *results.get(name, [])]), level)
        if not fresh:
            break
        solved |= fresh
    found = {}
    for at, (kind, name, _) in places.items():
        if kind == "call" and calls[name] != at:
            found[at] = ("duplicate", at[0], None)
        elif kind == "call" and name not in solved:
            found[at] = ("cycle", at[0], 0)
        elif kind == "call":
            status = "ok" if name in results else "unanswered"
            found[at] = (status, solved[name][0], 2 * solved[name][2])
        elif name not in calls:
            found[at] = ("orphan", at[0], 0)
        elif name in solved:
            found[at] = ("ok", max(at[0], solved[name][0]), 2 * solved[name][2] + 1)
        else:
            found[at] = ("ok", max(at[0], calls[name][0]), 1)
    return found


def test_links_equal_a_walk(spark):
    rnd = random.Random(8)
    rows, wanted = [], {}
    for conv in range(40):
        names = [f"c{k}" for k in range(rnd.randint(1, 6))]
        turns = []
        for _ in range(rnd.randint(1, 8)):
            if rnd.random() < 0.5:
                needs = [
                    sorted(set(rnd.choices([*names, "gone"], k=rnd.choice([0, 0, 1, 2]))))
                    for _ in range(rnd.randint(1, 3))
                ]
                turns.append([("call", rnd.choice(names), n) for n in needs])
            else:
                turns.append([("result", rnd.choice([*names, "gone"]), [])])
        for number, messages in enumerate(turns):
            if messages[0][0] == "result":
                text = turn(tool_call_id=messages[0][1], content="x")
            else:
                text = turn(
                    tool_calls=[
                        {"id": name, "name": "t", "arguments": {
                            str(k): {"$ref": n} for k, n in enumerate(needs)}}
                        for _, name, needs in messages
                    ]
                )
            rows.append((conv, number, "tool", text))
        wanted |= {(conv, *at): value for at, value in brute_links(turns).items()}
    table = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    got = {
        (r.conv_id, r.turn, r.part): (r.status, r.order_turn, r.level)
        for r in chat.link_tool_calls(table, {"t": {"type": "object"}}).collect()
    }
    assert got.keys() == wanted.keys()
    for at, (status, order_turn, level) in wanted.items():
        assert got[at][:2] == (status, order_turn), at
        assert level is None or got[at][2] == level, at
    assert len({status for status, _, _ in wanted.values()}) == 5


# 9 decontamination


def test_long_and_repeated_items(spark):
    rnd = random.Random(4)
    words = ["the", "of", "a", "to"] + [f"w{k}" for k in range(2000)]
    item = rnd.choices(words, k=2000)
    changed = [w if k % 4 else "other" for k, w in enumerate(item)]
    docs = docs_of(spark, ["x " + " ".join(item) + " y", " ".join(changed), "x y"] * 2)
    benchmark = spark.createDataFrame(
        [(k, " ".join(item)) for k in (1, 2, 2)] + [(None, "x y")],
        "item_id bigint, text string",
    )
    got = decontaminate.contaminated(docs, benchmark).orderBy("doc_id").collect()
    assert [(r.contaminated, r.n_items) for r in got] == [(True, 2), (True, 2), (True, 1)] * 2


def test_rows_of_one_id_are_not_mixed(spark):
    """Two texts under one id have half a passage each: neither is a copy."""
    item = [f"i{k}" for k in range(13)]
    half = [" ".join(item[:7] + ["x"] * 6), " ".join(["x"] * 7 + item[7:])]
    docs = spark.createDataFrame(
        [(1, half[0]), (1, half[1]), (2, " ".join(item)), (2, " ".join(item))],
        "doc_id bigint, text string",
    )
    benchmark = spark.createDataFrame([(1, " ".join(item))], "item_id bigint, text string")
    got = decontaminate.contaminated(docs, benchmark).collect()
    assert sorted((r.doc_id, r.contaminated) for r in got) == [
        (1, False), (1, False), (2, True), (2, True),
    ]


def test_odd_rows_of_changed_operators(spark, odd, none, model):  # noqa: F811
    assert pii.find_personal_data(odd, model).count() == len(ODD)
    assert pii.find_personal_data(none, model).count() == 0
    assert list(itertools.chain(*pii.find(None, model).values())) == []

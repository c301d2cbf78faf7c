import base64
import gzip
import hashlib
import json
import random
import time
from pathlib import Path

import pytest

from tallyport.llm import tool_calls as T
from tallyport.llm import warc as W

CALLS = "conv_id long, call_id string, turn long, name string, arguments string"
RESULTS = "conv_id long, call_id string, turn long, content string"
TOOLS = {"f": {"type": "object", "required": ["x"], "properties": {"x": {"type": "integer", "minimum": 0}}, "additionalProperties": False},
         "g": {"type": "object"}}


def ref(*ids):
    return json.dumps({"in": [{"$ref": i} for i in ids]})


def linked(spark, calls, results):
    rows = T.link(spark.createDataFrame(calls, CALLS), spark.createDataFrame(results, RESULTS), TOOLS).collect()
    return {(r.conv_id, r.call_id): r for r in rows}


def test_links_levels_and_errors(spark):
    calls = [
        (1, "c", 3, "g", ref("a", "b")), (1, "b", 2, "g", ref("a")), (1, "a", 1, "f", '{"x": 1.0}'), (1, "d", 4, "f", '{"x": -1, "y": 2}'),
        (1, "e", 5, "f", "nope"), (1, "h", 6, "nothing", "{}"), (1, "lost", 7, "g", ref("zz")),
        (2, "p", 1, "g", ref("q")), (2, "q", 2, "g", ref("p")), (2, "r", 3, "g", ref("q")), (2, "s", 4, "g", ref("s")),
        (1, "a", 9, "f", '{"x": 5}'), (None, "n", 1, "g", "{}"), (3, "a", 1, "g", None),
    ]
    results = [(1, "a", 2, "first"), (1, "a", 3, "second"), (1, "orphan", 4, None), (2, "p", 5, ""), (None, "n", 2, "z")]
    got = linked(spark, calls, results)
    assert {k: r.level for k, r in got.items() if k[0] == 1} == {
        (1, "a"): 0, (1, "b"): 1, (1, "c"): 2, (1, "d"): 0, (1, "e"): 0, (1, "h"): 0, (1, "lost"): 0, (1, "orphan"): None,
    }
    a = got[1, "a"]
    assert (a.arguments, a.content, a.status, a.n_calls, a.n_results, a.errors) == ('{"x":1}', "first", "linked", 2, 2, [])
    assert got[1, "d"].errors == ["x: below 0", "arguments: y is unknown"]
    assert got[1, "e"].errors == ["arguments: no JSON"] and got[1, "h"].errors == ["name: no such tool"]
    assert got[1, "lost"].errors == ["refers to no call: zz"]
    assert got[1, "orphan"].status == "no_call" and got[2, "p"].content == ""
    for name in "pqrs":
        assert got[2, name].level is None and got[2, name].errors == ["refers in a cycle"]
    assert got[3, "a"].errors == ["arguments: no JSON"]


def test_long_chain_and_empty(spark):
    calls = [(1, f"c{i}", i, "g", ref(f"c{i - 1}") if i else "{}") for i in range(9)]
    assert [linked(spark, calls, [])[1, f"c{i}"].level for i in range(9)] == list(range(9))
    empty = T.link(spark.createDataFrame([], CALLS), spark.createDataFrame([], RESULTS), TOOLS)
    assert T.serialise(empty).count() == 0


@pytest.mark.parametrize("value,text", [
    ({"b": 1.0, "a": [True, None, 1.5]}, '{"a":[true,null,1.5],"b":1}'), ({"é": "ü\n"}, '{"é":"ü\\n"}'), ({}, "{}"), (1e300, "1e+300"),
])
def test_canonical(value, text):
    assert T.canonical(value) == text
    assert json.loads(text) == value


def test_objections():
    schema = {"type": "object", "properties": {"n": {"type": ["integer", "null"]}, "t": {"type": "string", "minLength": 2, "maxLength": 3},
              "l": {"type": "array", "items": {"enum": [1, 2]}}}}
    assert T.objections({"n": None, "t": "ab", "l": [1, 2], "z": 0}, schema) == []
    assert T.objections({"n": True, "t": "a", "l": [3]}, schema) == [
        "l[0]: not one of [1,2]", "n: not integer or null", "t: too short",
    ]
    assert T.objections([], schema) == ["arguments: not object"]


def test_conversations(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    rows = {(r.conv_id, r.turn): r for r in table.collect()}
    got = T.digest(table.withColumn("level", table.turn)).collect()
    assert len(got) == sum(r.role == "user" for r in rows.values()) + sum(
        r.role == "assistant" and rows.get((r.conv_id, r.turn - 1), r).role != "user" for r in rows.values()
    )
    for r in got:
        call, made = rows[r.conv_id, r.turn], json.loads(r.json)
        assert made["call_id"] == r.call_id and (made["arguments"].get("query") or made["arguments"]["text"]) == call.text
        answer = rows.get((r.conv_id, r.turn + 1))
        assert made["result"] == (answer.text if answer and answer.role == "assistant" else None)
        assert r.json == T.canonical(made)


def brute_levels(refs):
    """Longest path of every call, None on or after a cycle; refs: call -> calls of its conversation."""
    known, level = {c: [r for r in rs if r in refs] for c, rs in refs.items()}, {}
    while True:
        ready = [c for c in known if c not in level and all(r in level for r in known[c])]
        if not ready:
            return {c: level.get(c) for c in refs}
        level.update({c: max((level[r] + 1 for r in known[c]), default=0) for c in ready})


def test_levels_against_brute_force(spark):
    rng = random.Random(1)
    graphs = {}
    for conv in range(9):
        n = 120 if conv == 0 else rng.randrange(1, 25)  # one conversation holds a large part of all rows
        back = lambda i: [f"c{rng.randrange(max(0, i - 9), i)}" for _ in range(rng.randrange(4))] if i else []
        graphs[conv] = {f"c{i}": back(i) + ["gone"] * (rng.random() < 0.05) for i in range(n)}
        if conv % 3 == 1:  # references forward and in circles
            for _ in range(3):
                graphs[conv][f"c{rng.randrange(n)}"].append(f"c{rng.randrange(n)}")
    rows = [(conv, c, rng.randrange(9) if conv % 2 else int(c[1:]), "g", ref(*rs)) for conv, g in graphs.items() for c, rs in g.items()]
    got = {k: r.level for k, r in linked(spark, rows, []).items()}
    assert got == {(conv, c): level for conv, g in graphs.items() for c, level in brute_levels(g).items()}
    assert max(filter(None, got.values())) > 9


def test_many_calls_refer_to_one(spark):
    """A hot target, a long chain and references to the two calls before: rounds stay few."""
    calls = [(1, f"c{i}", i, "g", ref(*(f"c{j}" for j in (i - 2, i - 1, 0) if 0 <= j < i))) for i in range(200)]
    got = linked(spark, calls, [])
    assert [got[1, f"c{i}"].level for i in range(200)] == list(range(200))


def test_arguments_of_any_depth_and_odd_numbers(spark):
    deep = '{"in":' * 5000 + '[{"$ref":"a"}]' + "}" * 5000
    lists = '{"x":' + "[" * 5000 + "]" * 5000 + "}"
    calls = [(1, "a", 1, "g", deep), (1, "b", 2, "g", lists), (1, "c", 3, "g", '{"x":' * 200_000), (1, "d", 4, "g", '{"x":' * 200_000 + "1" + "}" * 200_000)]
    calls += [(1, f"n{i}", 5, "g", f'{{"x":{n}}}') for i, n in enumerate(("NaN", "Infinity", "-Infinity", "1e999", "1" * 5000))]
    calls += [(1, "half", 6, "g", '{"x":"\\ud800","\\udfff":1,"in":{"$ref":"\\ud83d"}}')]
    got = {k[1]: r for k, r in linked(spark, calls, []).items()}
    assert got["a"].arguments == deep and got["a"].errors == ["refers in a cycle"]
    assert got["b"].arguments == lists and got["b"].errors == []
    assert {got["c"].errors[0], got["d"].errors[0]} <= {"arguments: no JSON", "arguments: nested too deep"}
    for i in range(5):
        assert (got[f"n{i}"].arguments, got[f"n{i}"].errors) == ("{}", ["arguments: no JSON"])
    assert json.loads(got["half"].arguments) == {"x": "\ud800", "\udfff": 1, "in": {"$ref": "\ud83d"}}
    assert got["half"].errors == ["refers to no call: \\ud83d"]


def test_lone_calls_and_true_is_not_one(spark):
    calls = [(None, "a", 1, "g", ref("b")), (5, None, 1, "g", ref("p", "q")), (5, None, 1, "g", ref("p")), (5, "p", 1, "g", "{}")]
    rows = T.link(spark.createDataFrame(calls, CALLS), spark.createDataFrame([], RESULTS), TOOLS).collect()
    assert sorted((str(r.call_id), r.level, r.errors) for r in rows) == [
        ("None", 0, []), ("None", 0, ["refers to no call: q"]), ("a", 0, ["refers to no call: b"]), ("p", 0, []),
    ]
    schema = {"enum": [1, "1", [1.0]]}
    assert [T.objections(v, schema) == [] for v in (1, 1.0, "1", [1], True, [True], None)] == [True] * 4 + [False] * 3


PAGE = (
    '<html lang="de"><head><title>A &amp; B</title><style>p{}</style></head><body><!-- no --><p>One <b>two</b></p>'
    "<script>var x='<p>';</script><p>drei&nbsp;vier<br>5 &lt; 6</p><a href='/x?a=1&amp;b=2'>l</a><a href=/x?a=1&b=2>m</a></body></html>"
)


def response(spark, rows):
    return spark.createDataFrame(rows, "record_id string, target_uri string, date string, headers map<string,string>, message binary")


def test_derivatives(spark):
    message = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=iso-8859-1\r\nX: y\r\n\r\n" + PAGE.replace("drei", "drü").encode("latin-1")
    rows = [("<urn:uuid:1>", "http://a/", "2024-01-01T00:00:00Z", {"K": "v"}, bytearray(message)), ("<urn:uuid:2>", None, None, None, None)]
    got = {(r.refers_to, r.record_type): r for r in W.derive(response(spark, rows).selectExpr("*", "1 AS block")).collect()}
    assert len(got) == 4
    text, meta = got["<urn:uuid:1>", "conversion"], got["<urn:uuid:1>", "metadata"]
    assert bytes(text.block).decode() == "One two\ndrü vier\n5 < 6\nlm"
    assert bytes(meta.block).decode() == (
        "title: A & B\r\nlanguage: de\r\nhttp-content-type: text/html; charset=iso-8859-1\r\nhttp-x: y\r\noutlink: /x?a=1&b=2\r\n"
    )
    body = message.partition(b"\r\n\r\n")[2]
    sha = lambda b: "sha1:" + base64.b32encode(hashlib.sha1(b).digest()).decode()
    for r in (text, meta):
        assert r.headers["WARC-Refers-To"] == "<urn:uuid:1>" and r.headers["WARC-Target-URI"] == "http://a/"
        assert r.headers["X-Source-K"] == "v" and r.headers["X-Source-Payload-Digest"] == sha(body)
        assert r.headers["WARC-Block-Digest"] == sha(bytes(r.block)) and r.headers["Content-Length"] == str(len(r.block))
        assert r.record_id == r.headers["WARC-Record-ID"] and r.record_id != "<urn:uuid:1>"
    assert text.record_id != meta.record_id
    bare = got["<urn:uuid:2>", "metadata"]
    assert bytes(bare.block) == b"" and "WARC-Target-URI" not in bare.headers
    assert W.derive(response(spark, rows).limit(0)).count() == 0


def test_files_read_back(spark, sf_dir, folder):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    records = W.derive(W.responses_of(pages))
    W.write_warc(records, f"{folder}/warc")
    want = {r.record_id: bytes(r.block) for r in records.collect()}
    found = {}
    for file in Path(f"{folder}/warc".removeprefix("file:")).glob("*.gz"):
        data = gzip.open(file).read()
        while data:
            head, _, rest = data.partition(b"\r\n\r\n")
            lines = head.decode().split("\r\n")
            fields = dict(line.split(": ", 1) for line in lines[1:])
            size = int(fields["Content-Length"])
            assert lines[0] == "WARC/1.1" and rest[size : size + 4] == b"\r\n\r\n"
            found[fields["WARC-Record-ID"]] = rest[:size]
            data = rest[size + 4 :]
    assert found == want and len(want) == 2 * pages.count()


def test_odd_pages(spark):
    pages = spark.createDataFrame([(1, None, None), (1, None, None), (2, "u", "<p>" + "x " * 60_000), (None, "u", "t")], "page_id long, url string, html string")
    got = W.digest(pages.selectExpr("*", "1 AS record_id")).collect()
    assert len(got) == 8
    assert {r.block_bytes for r in got if r.page_id == 2 and r.record_type == "conversion"} == {119_999}
    assert len({r.record_id for r in got if r.page_id == 1}) == 2


def test_unclosed_markup_takes_no_longer_than_it_is_long():
    """Eight times the page may not take anything like 64 times as long."""
    for piece in ("<script>", "<!--", "<", "<a href='", '<a href="x', "<title>", "<html ", "</script", "<head><!--<style>"):
        spent = []
        for n in (20_000, 160_000):
            page, started = piece * n, time.perf_counter()
            W.plain_text(page), W.links(page), W.title_of(page), W.language_of(page)
            spent.append(time.perf_counter() - started)
        assert spent[1] < 24 * spent[0] + 0.2, piece
    assert W.plain_text("a<script>b<p>c") == "ab\nc" and W.plain_text("a<!-- b") == "a<!-- b"


def test_tags_and_links():
    page = "<HTML\nclass=x lang='de-AT'><p\nclass='y'>one<a\nhref = \"a>b\">two</a> <!-- <p> --><TITLE >t &lt;<b>u</b></TITLE >"
    # A tag ends with its first >, also inside quotes; the value of a link does not.
    assert W.plain_text(page) == 'oneb">two t <u' and W.links(page) == ["a>b"]
    assert W.title_of(page) == "t <u" and W.language_of(page) == "de-AT"
    assert W.links("<a name=x><a href=''><a href=y z><a href='p\n q'><abbr href=no><a href=y>") == ["y", "pq"]
    assert W.title_of("<title>open") is None and W.language_of("<html>") is None


def test_no_header_ends_a_record(spark, folder):
    evil = "x\r\n\r\nWARC/1.0\r\nevil: 1"
    message = b"HTTP/1.1 200 OK\r\nA: b\r\n\r\n<title>t</title>"
    rows = [("<urn:uuid:1>", evil, evil, {f"K{evil}": evil}, bytearray(message)), (None, "u", "d", None, bytearray(message)), (None, "v", "d", None, bytearray(message))]
    got = W.derive(response(spark, rows)).collect()
    for r in got:
        assert not any("\r" in x or "\n" in x for pair in r.headers.items() for x in pair if x)
    assert len({r.record_id for r in got}) == 6
    assert all("WARC-Refers-To" not in r.headers for r in got if r.refers_to is None)
    for r in W.warc_text(W.derive(response(spark, rows))).collect():
        head = r.value.partition("\r\n\r\n")[0].split("\r\n")
        assert [line for line in head if line.startswith("WARC/")] == head[:1] and not any(line.startswith("evil") for line in head)

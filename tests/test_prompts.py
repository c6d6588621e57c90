import json

import pytest
from pyspark.sql import functions as F

from passages.functions.text import (
    display_token, drop_empty_lines, format_size, source_name, strip_line_end,
)
from passages.operators import chat, metrics, points, prompts


def _value(spark, column):
    return spark.range(1).select(column).first()[0]


def _text(spark, function, text):
    return spark.createDataFrame([(text,)], "t string").select(function("t")).first()[0]


@pytest.mark.parametrize("text,expected", [
    ("a\n\nb\r\n\r\n c\n", "a\nb\n c"), ("", ""), ("\n\n", ""), (" \n\t\n", " \n\t"),
    ("a\r\r\nb\r", "a\r\nb\r"), (None, None),
])
def test_drop_empty_lines(spark, text, expected):
    assert _text(spark, drop_empty_lines, text) == expected


@pytest.mark.parametrize("path,expected", [
    ("/x/y.tar.gz", "y.tar"), ("a.txt", "a"), (".hidden", ".hidden"), (".a.b", ".a"),
    ("/d.e/plain", "plain"), ("name.", "name"), ("/dir/", None), ("", None),
])
def test_source_name(spark, path, expected):
    assert _text(spark, source_name, path) == expected


def test_small_text_functions(spark):
    assert _text(spark, strip_line_end, "a\n\r\n") == "a\n"
    assert _text(spark, strip_line_end, "a\r") == "a\r"
    assert _text(spark, display_token, "▁a<0x0A>▁") == " a\n "


@pytest.mark.parametrize("size,expected", [
    (0, "0B"), (999, "999B"), (1000, "1.00KB"), (1234, "1.23KB"), (1236, "1.24KB"),
    (999_999, "1000.00KB"), (1_000_000, "1.00MB"), (2_505_100, "2.51MB"),
    (999_999_999, "1000.00MB"), (1_000_000_000, "1.00GB"), (12_345_678_901_234, "12345.68GB"),
])
def test_format_size(spark, size, expected):
    assert _value(spark, format_size(F.lit(size))) == expected


def test_total_size_divides_per_item(spark):
    df = spark.createDataFrame([("a", 3), ("a", 3), ("b", 4000)], "s string, n long")
    rows = {r.s: (r.items, r.bytes, r.size) for r in metrics.total_size(df, "s", "n", 3, 2).collect()}
    assert rows == {"a": (2, 8, "8B"), "b": (1, 6000, "6.00KB")}


def test_throughput_of_one_event(spark):
    df = spark.sql("select 'a' k, timestamp'2024-01-01 00:00:00' ts union all select 'b', "
                   "timestamp'2024-01-01 00:00:00' union all select 'b', timestamp'2024-01-01 00:00:04'")
    rows = {r.k: (r.seconds, r.per_second) for r in metrics.throughput(df, "k").collect()}
    assert rows == {"a": (0.0, None), "b": (4.0, 0.5)}


def test_fill_template(spark):
    context = F.array_join(F.array(*map(F.lit, ["one", "two", "three"])), "\n")
    lines = F.lit("excerpts:\n{{payloads}}\nPlease")
    filled = "excerpts:\none\ntwo\nthree\nPlease"
    assert _value(spark, prompts.fill_template(lines, context, legacy=True)) == filled
    assert _value(spark, prompts.fill_template(lines, context, "{{payloads}}")) == filled
    short = F.lit("x:{{payload}}Please")
    assert _value(spark, prompts.fill_template(short, F.lit("C"))) == "x:CPlease"
    assert _value(spark, prompts.fill_template(short, F.lit("C"), legacy=True)) == "x:Clease"
    assert _value(spark, prompts.fill_template(F.lit("none"), F.lit("C"))) is None


def test_messages_and_request(spark):
    messages = prompts.rag_messages(F.lit("q"), F.lit("ctx"))
    body = json.loads(_value(spark, prompts.chat_request(messages)))
    assert list(body) == [
        "messages", "model", "temperature", "max_tokens", "top_p", "stop", "stream"]
    assert [m["role"] for m in body["messages"]] == ["system", "user", "system"]
    assert body["stop"] is None and body["stream"] is False and body["top_p"] == 1
    assert "excerpts:ctxPlease" in body["messages"][2]["content"]
    raw = F.array(*[prompts.message(r, F.lit(t)) for r, t in
                    (("system", "s"), ("user", "old"), ("system", "a{{payload}}b"))])
    changed = prompts.fill_context_message(prompts.set_user_message(raw, F.lit("new")), F.lit("-"))
    assert [m.content for m in _value(spark, changed)] == ["s", "new", "a-b"]


def test_context_keeps_rank_order_and_queries_without_hits(spark):
    asked = spark.createDataFrame([(1,), (2,)], "query_id long")
    hits = spark.createDataFrame(
        [(1, 10, "j"), (1, 2, "b"), (1, 1, "a"), (1, 3, None)],
        "query_id long, rank int, text string")
    rows = {r.query_id: r.context for r in prompts.context_text(asked, hits).collect()}
    assert rows == {1: "a\nb\nj", 2: ""}


def test_chat_response(spark):
    bodies = [
        '{"choices":[{"message":{"content":"a"}},{"message":{"content":"b\\n"}}]}',
        '{"choices":[{"message":{"content":5}},{"message":"x"},{},null,{"message":{"content":"c"}}]}',
        '{"choices":{}}', "{}", "[]", "not json",
    ]
    df = spark.createDataFrame(list(enumerate(bodies)), "n long, body string")
    rows = sorted(tuple(r) for r in prompts.chat_response(df, keep=("n",)).collect() if r.content)
    assert rows == [(0, 0, "a", None), (0, 1, "b\n", None), (1, 4, "c", None)]
    bad = [tuple(r) for r in prompts.chat_response(df, keep=("n",)).collect() if r.bad_json]
    assert bad == [(5, None, None, "not json")]
    with pytest.raises(Exception, match="MALFORMED"):
        prompts.chat_response(df, fail_on_bad=True).collect()


def test_stream_deltas(spark):
    def chunk(delta):
        return json.dumps({"choices": [{"delta": delta}, {"delta": {"content": "other"}}]})

    parts = [{"role": "assistant"}, {"content": "a "}, {}, {"content": "b"}, {"content": 5}]
    df = spark.createDataFrame([(1, n, chunk(d)) for n, d in reversed(list(enumerate(parts)))],
                               "seq long, pos long, body string")
    assert prompts.stream_deltas(df, "seq", "pos").first().text == "a b"


@pytest.mark.parametrize("answer,valid", [
    ('{"content":"x"}', True), ('{"content":""}', True), ('{"content":1}', False), ("{}", False),
    ('["content"]', False), ('"content"', False), ("nothing", False), (None, False),
])
def test_validate_structured(spark, answer, valid):
    assert _text(spark, prompts.is_valid_answer, answer) is valid


def test_json_map_values(spark):
    def values(*bodies):
        df = spark.createDataFrame([(b,) for b in bodies], "body string")
        return sorted(r.value for r in prompts.json_map_values(df).collect())

    assert values('{"weight_map":{"a":"f1","b":"f2","c":"f1","d":3,"e":null,"f":["x"]}}',
                  '{"weight_map":{"a":"f3"}}') == ["f1", "f2", "f3"]
    assert values('{"weight_map":{}}') == []
    for bad in ("{}", '{"weight_map":"x"}', '{"weight_map":[1]}', "no json"):
        with pytest.raises(Exception):
            values(bad)


def test_wrap_payload(spark):
    def wrap(raw, **options):
        return _value(spark, points.wrap_payload(F.lit(raw), F.lit("s"), **options))

    wrapped = lambda raw: {"txt_chunk": raw, "source": "s"}
    assert wrap('{"a":"b"}') == wrapped('{"a":"b"}')
    assert wrap('{"a":"b"}', parse_json=True) == {"a": "b"}
    for raw in ("text", "[1]", "{broken", '"quoted"'):
        assert wrap(raw, parse_json=True) == wrapped(raw)


def test_project_hits(spark):
    df = spark.createDataFrame([("1", 0.5, "p"), ("x-1", 0.4, "p"), (None, 0.3, "p")],
                               "raw_id string, score double, payload string")
    assert [tuple(r) for r in points.project_hits(df).collect()] == [(1, 0.5, "p")]


def test_point_ids(spark):
    df = spark.createDataFrame([(3, 5)], "doc_id long, chunk_no int")
    point = points.point_id()
    row = df.select(point.alias("id")).select(
        "id", points.point_doc("id").alias("d"), points.point_chunk("id").alias("c")).first()
    assert (row.d, row.c) == (3, 5)
    with pytest.raises(Exception, match="out of range"):
        spark.createDataFrame([(3, 1 << 20)], "doc_id long, chunk_no int").select(point).collect()


def test_upsert(spark):
    def table(*rows):
        return spark.createDataFrame(rows, "id long, v string")

    old, new = table((1, "a"), (2, "b")), table((2, "c"), (3, "d"))
    once = points.upsert_points(old, new)
    expected = [(1, "a"), (2, "c"), (3, "d")]
    assert sorted(map(tuple, once.collect())) == expected
    assert sorted(map(tuple, points.upsert_points(once, new).collect())) == expected


def test_chat_turn_formats(spark):
    rows = [(m, 1, t, f"hi{t}\r\n") for m in
            ("7b-open-chat-3.5", "7b-zephyr-a", "mixtral", "7b-leo") for t in (3, 5)]
    df = spark.createDataFrame(rows, "model string, x int, turn long, text string").withColumn(
        "conv_id", F.xxhash64("model"))

    def prompts_of(mode):
        found = chat.format_chat_turn(df, mode).collect()
        return {(r.model, r.turn): r.prompt for r in found}

    first = "<|system|>\n</s>\n"
    user = "<|user|>\nhi{}</s>\n<|assistant|>"
    talk = prompts_of("chat")
    assert talk["7b-open-chat-3.5", 5] == (
        "GPT4 Correct User: hi5<|end_of_turn|>GPT4 Correct Assistant:")
    assert talk["7b-zephyr-a", 3] == first + user.format(3)
    assert talk["7b-zephyr-a", 5] == user.format(5)
    assert talk["mixtral", 3] == "[INST] hi3 [/INST]" and talk["7b-leo", 3] == "hi3"
    assert prompts_of("interactive")["7b-zephyr-a", 5] == first + user.format(5)
    assert prompts_of("one")["mixtral", 3] == "hi3\r\n"
    assert _value(spark, chat.eos_token(F.lit("gemma"))) == "<eos>"


def test_chat_messages(spark):
    df = spark.createDataFrame([(1, 2, "user", "b {role}"), (1, 1, "system", "a")],
                               "conv_id long, turn long, role string, text string")
    found = chat.chat_messages(df, "<{role}>{content}</{role}>", "<assistant>").first().prompt
    assert found == "<system>a</system><user>b {role}</user><assistant>"


@pytest.mark.parametrize("budget,segment", [(5, 5), (5, 65_536), (1, 3), (1000, 1000), (7, 20)])
def test_chat_history(spark, budget, segment):
    import random

    rng, rows, expected = random.Random(budget), [], {}
    for conv in range(6):
        past, turn = [], 0
        for _ in range(25 if conv else 120):
            turn += rng.randint(1, 4)
            ids = [rng.randint(0, 99) for _ in range(rng.choice([0, 1, 2, 5, 12]))]
            past += ids
            rows.append((conv, turn, ids))
            expected[conv, turn] = past[-budget:]
    df = spark.createDataFrame(rows, "conv_id long, turn long, ids array<int>").repartition(4)
    found = chat.chat_history(df, budget, segment_tokens=segment).collect()
    assert {(r.conv_id, r.turn): r.history for r in found} == expected
    assert len(found) == len(rows)

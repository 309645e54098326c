"""Linked rows of exports against a plain recursive walk."""

import json
from datetime import datetime

from paperloom.operators.nested import KINDS, export_objects, typed_objects, unwrapped

T0, T1 = datetime(2024, 1, 1), datetime(2024, 1, 2)


def walk(payload):
    """The rows of a payload from a parser and a plain recursive walk."""
    out, root = [], None
    try:
        level = [json.loads((payload or "").lstrip("\ufeff \t\r\n"))]
    except ValueError:
        return []
    while isinstance(level[0], str):
        level = [json.loads(level[0])]
    while level and root is None:
        root = next((x for x in level if isinstance(x, dict) and any(isinstance(x.get(k), (dict, list)) for k in ("items", "layout", "tables"))), None)
        level = [v for x in level for v in (x.values() if isinstance(x, dict) else x) if isinstance(v, (dict, list))]

    def go(o, path, holder):
        for k, h in KINDS:
            v = o.get(k) if h == holder else None
            for i, c in enumerate([v] if isinstance(v, dict) else v if isinstance(v, list) else []):
                if isinstance(c, dict):
                    here = f"{path}/{k}/{i}".lstrip("/")
                    out.append((here, path))
                    go(c, here, k)

    if root is not None:
        go(root, "", "")
    return out


def rows(spark, payloads, **more):
    df = spark.createDataFrame([(i, p, T0, "clash") for i, p in enumerate(payloads)], "export_id long, payload string, received_at timestamp, path string")
    return export_objects(df, **more)


def test_data(spark, data):
    df = spark.read.parquet(f"{data}/ocr_exports.parquet")
    want = {(r.export_id, *x) for r in df.collect() for x in walk(r.payload)}
    got = [(r.export_id, r.path, r.parent_path) for r in export_objects(df, values=False).collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_wrappers_nulls_and_odd_texts(spark):
    word = {"value": 'a "quoted\\" {[,:]} \\\\', "geometry": {"ymax": 0.4, "xmin": 0.1, "ymin": 0.2, "xmax": 0.3}, "confidence": "0.5"}
    page = {"name": "ü{", "layout": {"type": "Text", "geometry": "0.1 0.2 0.3 0.4"}, "tables": [None, {"cells": [None, {"value": None, "row_start": 2}]}], "items": [None, {"blocks": {"lines": [{"words": [None, word]}, None]}}], "extra": {"layout": [{}]}}
    text = json.dumps(page)
    payloads = [text, json.dumps([page], indent=1), "﻿" + text, json.dumps(text), json.dumps({"result": [None, page]}), text[:-9], "", None, "null", "[]", "{}", "502 closed", '"x"', text + "x", json.dumps(page, ensure_ascii=False), "[" * 5000 + "]" * 5000, '{"items": []}', json.dumps({"result": [1, text]})]
    got = {}
    for r in rows(spark, payloads, values=False).collect():
        got.setdefault(r.export_id, set()).add((r.path, r.parent_path))
    whole = {("layout/0", ""), ("tables/1", ""), ("tables/1/cells/1", "tables/1"), ("items/1", ""), ("items/1/blocks/0", "items/1"), ("items/1/blocks/0/lines/0", "items/1/blocks/0"), ("items/1/blocks/0/lines/0/words/1", "items/1/blocks/0/lines/0")}
    assert got == {i: whole for i in (0, 1, 2, 3, 4, 14, 17)}
    assert set(walk(text)) == whole

    values = {r.path: r for r in typed_objects(rows(spark, [text])).collect()}
    w = values["items/1/blocks/0/lines/0/words/1"]
    assert (w.value, w.confidence, w.geometry) == (word["value"], 0.5, [0.1, 0.2, 0.3, 0.4])
    assert values["layout/0"].geometry == [0.1, 0.2, 0.3, 0.4] and values["layout/0"].type == "Text"
    assert (values["tables/1/cells/1"].value, values["tables/1/cells/1"].row_start) == (None, 2)


def test_deliveries_and_empty(spark):
    a, b = '{"layout": [{}]}', '{"layout": [{}, {}]}'
    df = spark.createDataFrame([(1, b, T1), (1, a, T0), (1, a, T0), (None, a, T0), (2, a, None)], "export_id long, payload string, received_at timestamp")
    assert sorted((r.export_id, r.path) for r in export_objects(df).collect()) == [(1, "layout/0"), (2, "layout/0")]
    assert export_objects(df.limit(0)).collect() == []


def test_huge_payload(spark):
    big = json.dumps({"items": [{"blocks": [{"lines": [{"words": [{"value": "x" * 50}] * 40000}]}]}]})
    assert rows(spark, [big], values=False).count() == 40003


def test_no_caps(spark):
    """Any number of wrappers and levels, escaped and nearly equal keys, repeated keys."""
    one = '{"layout": [{}]}'
    nine = one
    for _ in range(9):
        nine = json.dumps(nine)
    deep = "[" * 20000 + "]" * 20000
    payloads = [
        nine, '{"extra": %s, "layout": [{"x": %s}]}' % (deep, deep), '{"l\\u0061yout": [{}]}', '{"layouT": [{}]}', '{"layout": [1, {}], "layout": [{}]}', '{"a": ' * 3000 + one + "}" * 3000,
        json.dumps({"body": json.dumps({"result": json.dumps(json.loads(one))})}), json.dumps(["{broken", one]),
    ]
    got = sorted((r.export_id, r.path) for r in rows(spark, payloads, values=False).collect())
    assert got == [(i, "layout/0") for i in (0, 1, 2, 4, 5, 6, 7)]
    near = '{"layout": [{"confidenTE": 0.1, "confidence": 0.2, "geometry_": 1, "v\\u0061lue": "x"}]}'
    r = typed_objects(rows(spark, [near])).first()
    assert (r.confidence, r.value, r.geometry) == (0.2, "x", None)


BROKEN = [
    '{"layout": [{}]', '{"layout": [{}]}}', '{"layout": [{]}}', '{"layout": [{},]}', '{"layout": [,{}]}', '{"layout" [{}]}', '{"layout": [{}] "x": 1}', '{layout: [{}]}', '{"layout": [{}], }', '{"layout": [{"a": 01}]}', '{"layout": [{"a": tru}]}',
    '{"layout": [{"a": "\\x"}]}', '{"layout": [{"a": "\\u12g4"}]}', '{"layout": [{"a": "\n"}]}', '{"layout": [{"a": 1 2}]}', '{"layout": [{"a"}]}', '{"layout": [{"a": }]}', '{"layout": [{1: 2}]}', '{"layout": [{"a": "b" "c"}]}', '{"layout": [{}]} {}', '["layout": [{}]]',
    '{"layout": [{}]} x', "{'layout': [{}]}", '{"layout": [{"a": .5}]}', '{"layout": [{"a": 1.}]}', '{"layout": [{"a": -}]}', '{"layout": ["a":1, {}]}', '{"layout": [{"a": "b]}', '\\"{"layout": [{}]}', '{"layout": [{}]}\\', ':{"layout": [{}]}', '{"layout": [{}{}]}', '{"a","layout": [{}]}', '{"a":"b":"c","layout": [{}]}',
]


def test_validity_as_a_parser(spark):
    """Broken texts beside whole ones: exactly those that a parser refuses give no rows."""
    good = ['{"layout": [{"a": -0.5e+3, "b": [true, false, null, "\\"\\\\", "\\ud83d"]}]}', ' {"layout" : [ { } ] } ', '{"layout": [{}], "x": {}, "y": [], "z": ""}', '{"layout": [{"a": "{[:,]}"}, {}]}', '{"layout":{}}']
    texts = [x for pair in zip(BROKEN, good * 7) for x in pair]
    for t in texts:
        try:
            json.loads(t)
            assert t in good
        except ValueError:
            assert t in BROKEN
    got = {}
    for r in rows(spark, texts, values=False).collect():
        got.setdefault(r.export_id, set()).add((r.path, r.parent_path))
    assert got == {i: set(walk(t)) for i, t in enumerate(texts) if t in good}

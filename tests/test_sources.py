"""Label files, generators, page files and streams."""

import json
from datetime import datetime, timedelta

import pytest

from paperloom.sources import files as S
from paperloom.sources import labels as A
from paperloom.streaming import recognition as R

QUAD = [[1, 2], [9, 2], [9, 5], [1, 5]]


def put(path, content):
    path.write_text(content if isinstance(content, str) else json.dumps(content), encoding="utf-8")
    return str(path)


def rows(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


def test_json_labels(spark, tmp_path):
    p = put(tmp_path / "ocr.json", {"a.png": {"typed_words": [{"value": "x", "geometry": [1, 2, 3, 4, 0]}]}, "b.png": {"typed_words": []}})
    got = A.ocr_labels(spark, p).orderBy("image").collect()
    assert [(r.image, r.value, r.xmax) for r in got] == [("a.png", "x", 3.0), ("b.png", None, None)]
    p = put(tmp_path / "det.json", {"a": {"polygons": [QUAD]}, "b": {"polygons": {"w": [QUAD, QUAD], "e": []}}})
    assert rows(A.detection_labels(spark, p), "image", "class", "idx", "xmin", "ymax") == [("a", "words", 0, 1.0, 5.0), ("b", "w", 0, 1.0, 5.0), ("b", "w", 1, 1.0, 5.0)]
    p = put(tmp_path / "lay.json", {"a": {"polygons": [QUAD], "classes": ["Title"]}})
    assert rows(A.layout_labels(spark, p), "image", "class", "xmax") == [("a", "Title", 9.0)]
    p = put(tmp_path / "bad.json", {"a": {"polygons": [QUAD], "classes": []}})
    with pytest.raises(Exception, match="differ"):
        A.layout_labels(spark, p).collect()
    p = put(tmp_path / "tab.json", {"a": {"cells": [QUAD, QUAD], "logic": [[0, 1, 2, 3], [4, 4, 5, 5]]}})
    assert rows(A.table_labels(spark, p), "col_start", "col_end", "row_start", "row_end") == [(0, 1, 2, 3), (4, 4, 5, 5)]
    p = put(tmp_path / "rec.json", {"a.png": "word"})
    one = A.recognition_labels(spark, p)
    assert rows(A.merged(("/x/", one), ("/y", one)), "image", "value") == [("/x/a.png", "word"), ("/y/a.png", "word")]
    p = put(tmp_path / "art.json", {"a": [{"geometry": [0, 0, 1, 1], "label": "logo"}]})
    assert rows(A.artefact_labels(spark, p), "image", "class") == [("a", 3)]


def test_dataset_labels(spark, tmp_path):
    p = put(tmp_path / "f1.json", {"form": [{"label": "q", "words": [{"box": [1, 2, 3, 4], "text": "a–b"}, {"box": [0, 0, 1, 1], "text": ""}, {"box": [0, 0, 1, 1], "text": "☐"}]}]})
    assert rows(A.funsd_labels(spark, p), "image", "value") == [("f1", "a–b"), ("f1", "☐")]
    assert rows(A.funsd_labels(spark, p, recognition=True), "value", "ymax") == [("a-b", 4.0)]
    quad = dict(zip("x1 y1 x2 y2 x3 y3 x4 y4".split(), (-1, 0, 5, 0, 5, 4, 0, 4)))
    p = put(tmp_path / "c1.json", {"valid_line": [{"words": [{"quad": quad, "text": "t"}], "category": "menu"}]})
    assert rows(A.cord_labels(spark, p), "image", "class", "value", "xmin", "xmax") == [("c1", "menu", "t", 0.0, 5.0)]
    p = put(tmp_path / "s1.txt", "1,2,9,2,9,5,1,5,one, two\n")
    assert rows(A.sroie_labels(spark, p), "image", "value", "xmin", "ymax") == [("s1", "one, two", 1.0, 5.0)]
    p = put(tmp_path / "gt_i1.txt", "1, 2, 3, 4, 'it'\n")
    assert rows(A.ic13_labels(spark, p), "image", "value", "ymax") == [("i1", "it", 4.0)]
    p = put(tmp_path / "v.xml", '<t><image><imageName>i.jpg</imageName><taggedRectangles><taggedRectangle x="1" y="2" width="3" height="4"><tag>w</tag></taggedRectangle></taggedRectangles></image></t>')
    assert rows(A.tagged_rectangles(spark, p), "image", "value", "xmax", "ymax") == [("i.jpg", "w", 4.0, 6.0)]
    p = put(tmp_path / "im.json", {"index_id": {"1": {"image_path": "a.jpg"}}, "index_to_ann_map": {"1": ["1_0", "1_1"]}, "ann_id": {"1_0": {"word": "hi", "bounding_box": "[10, 10, 4, 2, 0]"}, "1_1": {"word": ".", "bounding_box": "[0,0,0,0,0]"}}})
    assert rows(A.imgur_labels(spark, p), "image", "value", "xmin", "ymax") == [("a.jpg", "hi", 8.0, 11.0)]
    p = put(tmp_path / "co.json", {"imgs": {"1": {"id": 1, "set": "train", "file_name": "a"}, "2": {"id": 2, "set": "val", "file_name": "b"}}, "anns": {"7": {"image_id": 1, "bbox": [1, 2, 3, 4], "utf8_string": "x", "legibility": "legible"}, "8": {"image_id": 1, "bbox": [1, 2, 3, 4], "utf8_string": "y", "legibility": "illegible"}}})
    assert rows(A.coco_text_labels(spark, p), "image", "value", "xmax") == [("a", "x", 4.0)]
    p = put(tmp_path / "mj.txt", "./1/1_word_2.jpg\n./1/2_bad_3.jpg\n")
    black = spark.createDataFrame([("./1/2_bad_3.jpg",)], "value string")
    assert rows(A.path_labels(spark, p, black), "value") == [("word",)]
    p = put(tmp_path / "hw.txt", "a.png label 0 0\n")
    assert rows(A.listed_labels(spark, p), "image", "value") == [("a.png", "label")]
    p = put(tmp_path / "wr.txt", json.dumps({"file_name": "a", "height": 1, "width": 1, "annotations": [{"box": [1, 2, 9, 2, 9, 5, 1, 5], "text": "t", "label": 3}]}))
    assert rows(A.receipt_labels(spark, p), "value", "class", "xmax", "ymax") == [("t", 3, 9.0, 5.0)]


def test_generators_and_files(spark, tmp_path):
    words = rows(A.generated_words(spark, 200, "abc", 2, 4, seed=1), "id", "value")
    assert words == rows(A.generated_words(spark, 200, "abc", 2, 4, seed=1).repartition(7), "id", "value")
    assert all(2 <= len(w) <= 4 and set(w) <= set("abc") for _, w in words)
    a, b = A.positional_split(spark.range(100), "id")
    assert 85 <= a.count() <= 95 and a.count() + b.count() == 100
    (tmp_path / "x.bin").write_bytes(b"ab")
    decoder = lambda content: iter([(1, 2, content[:1]), (1, 2, content[1:])])
    assert rows(S.page_files(spark, str(tmp_path / "x.bin"), decoder), "page_idx", "width") == [(0, 2), (1, 2)]
    assert S.page_files(spark, str(tmp_path / "x.bin")).count() == 1 and A.orientation_labels(spark, str(tmp_path / "x.bin")).first().target == 0
    with pytest.raises(Exception, match="cannot decode"):
        S.page_files(spark, str(tmp_path / "x.bin"), lambda c: 1 / 0).collect()
    S.write_documents(spark.createDataFrame([("d1", "a\nb")], "name string, text string"), str(tmp_path / "out"), "name")
    assert spark.read.text(str(tmp_path / "out")).count() == 2
    assert S.checked(b"", "e3b0c442")


def test_streams(spark, tmp_path):
    t = datetime(2024, 1, 1)
    data = [(1, t, "a", 7), (2, t + timedelta(minutes=20), "a", 7), (3, t + timedelta(hours=2), "b", 7)]
    events = spark.createDataFrame(data, "event_id long, ts timestamp, event_type string, user_id long")
    events.write.parquet(str(tmp_path / "e"))
    stream = R.word_stream(spark, str(tmp_path / "e"), events.schema)

    def drained(df, name, mode):
        q = df.writeStream.outputMode(mode).format("memory").queryName(name).option("checkpointLocation", str(tmp_path / name)).start()
        q.processAllAvailable()
        q.stop()
        return spark.table(name).collect()

    assert {(r.event_type, r.n) for r in drained(R.event_windows(stream, "1 hour"), "w1", "complete")} == {("a", 2), ("b", 1)}
    assert sorted(r.n for r in R.event_sessions(events).collect()) == [1, 2]
    words = spark.createDataFrame([(1, 5, t, 0.5), (1, 5, t + timedelta(hours=1), 0.5), (2, 5, t, 1.0)], "word_id long, feed_id long, received_at timestamp, confidence double")
    words.write.parquet(str(tmp_path / "w"))
    stream = R.word_stream(spark, str(tmp_path / "w"), words.schema)
    assert len(drained(R.delivered_once(stream), "w2", "append")) == 2
    assert [(r.n_words, r.confidence) for r in R.confidence_by_feed(words, "1 day").collect()] == [(3, 2 / 3)]
    pairs = spark.createDataFrame([("a", "a"), ("a", "A")], "truth string, predicted string")
    assert tuple(R.running_text_match(pairs).first()) == (2, 1, 2, 1, 2)

import json

from foreglass.functions import loosejson
from foreglass.operators.shred import Repeated, element_keys, flat_table, shred
from foreglass.queries.nested import MARKETS, PROBABILITIES, SOURCES

VALUE = {"rationale": "it's \"so\"", "probabilities": [{"market": "A", "probability": 0.5, "evidence": [{"source_id": 1, "weight": 0.1}, {"source_id": 2}]}, {"market": "B", "probability": None}]}


def test_notations_of_the_same_value():
    plain = json.dumps(VALUE)
    for text in (plain, json.dumps(plain), "```json\n" + json.dumps(VALUE, indent=1) + "\n```", plain[:-1] + ",}", repr(VALUE), "﻿ " + plain, repr(VALUE).replace("None", "null")):
        assert loosejson.read(text) == VALUE, text


def test_what_is_not_whole_gives_nothing():
    plain = json.dumps(VALUE)
    for cut in range(1, len(plain)):
        assert loosejson.read(plain[:cut]) is None, plain[:cut]
    for text in (None, "", "  ", "null", "no json", "{", "}", '"', "[1, 2", "```json\n{\n```"):
        assert loosejson.read(text) is None, text


def test_commas_and_words_inside_strings_stay():
    assert loosejson.read('{"a": "x,}", "b": [1,],}') == {"a": "x,}", "b": [1]}
    assert loosejson.read("{'a': 'true, null', 'b': True, 'c': None}") == {"a": "true, null", "b": True, "c": None}


def table(spark, texts, shape, part, keep=None):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, text string")
    return sorted(map(tuple, flat_table(shred(df, "id", "text", shape, keep), part).collect()))


def test_tables_keep_their_links(spark):
    texts = [json.dumps(VALUE), json.dumps({"meta": 1, "prediction": VALUE}), json.dumps({"probabilities": {"A": 0.3, "B": 0.7}}), json.dumps({"rationale": "none"}), json.dumps({"probabilities": []}), None, "{"]
    children = table(spark, texts, PROBABILITIES, PROBABILITIES)
    assert children == [("0", 0, -1, None, "A", "0.5"), ("0", 1, -1, None, "B", None), ("1", 0, -1, None, "A", "0.5"), ("1", 1, -1, None, "B", None), ("2", 0, -1, None, "A", "0.3"), ("2", 1, -1, None, "B", "0.7")]
    grandchildren = table(spark, texts, PROBABILITIES, PROBABILITIES.children[0])
    assert grandchildren == [("0", 0, 0, "A", "1", "0.1"), ("0", 1, 0, "A", "2", None), ("1", 0, 0, "A", "1", "0.1"), ("1", 1, 0, "A", "2", None)]


def test_objects_and_arrays_of_markets_and_dotted_leaves(spark):
    levels = [{"price": 5, "size": 1}, {"price": 6.5}]
    texts = [json.dumps({"A": {"yes_ask": 1, "levels": levels}, "B": {"yes_ask": 2}}), json.dumps([{"market": "A", "yes_ask": 1, "levels": levels}, {"market": "B", "yes_ask": 2}])]
    first, second = ([r[1:] for r in table(spark, texts, MARKETS, MARKETS.children[0]) if r[0] == str(i)] for i in (0, 1))
    assert first == second == [(0, 0, "A", "5", "1"), (1, 0, "A", "6.5", None)]
    related = table(spark, [json.dumps({"sources": [{"source_id": 7, "related": [{"source_id": 8, "score": {"text": 0.5, "time": 1}}]}]})], SOURCES, SOURCES.children[0])
    assert related == [("0", 0, 0, "7", "8", "0.5", "1")]


def test_keys_once_and_without_nulls(spark):
    doubled = json.dumps({"probabilities": [{"market": "A"}, {"market": "A", "evidence": [{"source_id": 1}]}, {"probability": 1}]})
    df = spark.createDataFrame([("r", doubled, 1), ("r", doubled, 2), (None, doubled, 3)], "id string, text string, root_id int")
    assert sorted(map(tuple, element_keys(shred(df, "id", "text", PROBABILITIES, []), PROBABILITIES).collect())) == [("r", "A", ""), ("r", "A", "1")]
    assert shred(df.limit(0), "id", "text", PROBABILITIES).count() == 0


def test_round_trip_of_deep_records(spark):
    shape = Repeated("a", "a", "k", None, ("v",), (Repeated("b", "b", "k", None, (), (Repeated("c", "c", "k", None, ("v",)),)),))
    value = {"a": [{"k": "1", "v": "x", "b": [{"k": "2", "c": [{"k": "3", "v": "y"}, {"k": "4"}]}, {"k": "5"}]}, {"k": "6"}, {"k": "7", "b": [{"k": "8", "c": [{"k": "9"}]}]}]}
    rows = {p.name: table(spark, [json.dumps(value)], shape, p) for p in (shape, shape.children[0], shape.children[0].children[0])}
    rebuilt = []
    for a in rows["a"]:
        own = {"k": a[4]} | ({"v": a[5]} if a[5] is not None else {})
        if bs := [b for b in rows["b"] if b[2] == a[1]]:
            own["b"] = [{"k": b[4]} | ({"c": [{"k": c[4]} | ({"v": c[5]} if c[5] is not None else {}) for c in cs]} if (cs := [c for c in rows["c"] if c[2] == b[1]]) else {}) for b in bs]
        rebuilt.append(own)
    assert rebuilt == value["a"]


def test_very_long_record(spark):
    text = json.dumps({"probabilities": {f"m{i}": 0.1 for i in range(20_000)}})
    assert len(table(spark, [text], PROBABILITIES, PROBABILITIES)) == 20_000

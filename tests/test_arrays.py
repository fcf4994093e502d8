"""Array files cut at any byte, against Spark's own reader of whole files."""

import json
import random

import pytest

from starmill.sources.arrays import NoArray, array_elements, read_array
from starmill.sources.tables import read_records

SCHEMA = "i bigint, s string, o struct<a:array<struct<b:string>>>, l array<string>"
BITS = ['"', "\\", "}", "{", "]", "[", ",", ":", "é", "ش", "😀", "x", " ", "\n", "\\\"", "}}", "\u2028"]


def record(rng, i):
    text = "".join(rng.choices(BITS, k=rng.choice([0, 1, 5, 40])))
    return {
        "i": i, "s": text, "o": rng.choice([None, {}, {"a": [{"b": text}, {"b": "}"}]}]), "l": rng.choice([None, [], ["[", text]]),
    }


def rows(df):
    return sorted(map(repr, df.collect()))


@pytest.mark.parametrize("split_bytes", [48, 500, 1 << 20])
def test_equals_whole_file_reading(spark, tmp_path, split_bytes):
    rng = random.Random(split_bytes)
    for name, n, shape in [("a", 60, {}), ("b", 30, {"indent": 1, "ensure_ascii": False}), ("c", 0, {}), ("d", 1, {})]:
        records = [record(rng, i) for i in range(n)]
        (tmp_path / f"{name}.json").write_text(f" {json.dumps(records, **shape)}\n", encoding="utf-8")
    (tmp_path / "e.json").write_text("")
    whole = read_records(spark, str(tmp_path), SCHEMA, array_file=True).where("i IS NOT NULL")
    assert rows(read_array(spark, str(tmp_path), SCHEMA, split_bytes)) == rows(whole)
    assert whole.count() == 91
    elements = array_elements(spark, str(tmp_path), split_bytes).where("file LIKE '%a.json'").orderBy("block", "n").collect()
    assert [json.loads(e.json)["i"] for e in elements] == list(range(60))
    assert (len({e.block for e in elements}) > 5) == (split_bytes < 1000)


def test_one_element_over_many_splits(spark, tmp_path):
    records = [{"i": 0, "s": "}" * 3000 + "\\" * 2001}, {"i": 1, "s": "x" * 5000}, {"i": 2, "s": '"{' * 900}]
    (tmp_path / "a.json").write_text(json.dumps(records))
    got = read_array(spark, str(tmp_path), "i bigint, s string", 100).orderBy("i").collect()
    assert [r.asDict() for r in got] == records


@pytest.mark.parametrize(
    "text", ['[{"i": 1}', '{"i": 1}', "[1, 2]", '["a"]', "[[]]", '[{"i": 1} x]', '[{"i": "}]', '[{"i": 1}]]', "x"]
)
def test_other_files_raise(spark, tmp_path, text):
    (tmp_path / "a.json").write_text(text)
    with pytest.raises(Exception, match="whole JSON array|no objects|between its elements") as raised:
        array_elements(spark, str(tmp_path), 100).collect()
    assert isinstance(raised.value, NoArray) or "NoArray" in str(raised.value)


def test_many_small_splits_take_few_tasks(spark, tmp_path):
    records = [{"i": i, "s": '}"{' * (i % 5)} for i in range(3000)]
    for name in "ab":
        (tmp_path / f"{name}.json").write_text(json.dumps(records))
    elements = array_elements(spark, str(tmp_path), 400)
    assert elements.select("block").distinct().count() > 100
    assert len(elements.inputFiles()) <= spark.sparkContext.defaultParallelism
    got = elements.where("file LIKE '%b.json'").orderBy("block", "n").collect()
    assert [json.loads(e.json) for e in got] == records

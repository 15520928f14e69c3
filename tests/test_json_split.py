"""JSON-array files read by byte ranges: equal to parsing each file whole, however it is split."""

from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from tidemark.sources import pages
from tidemark.sources.json_split import read_array_elements


def parsed(df):
    return sorted((json.loads(r["payload"]) for r in df.collect()), key=lambda x: json.dumps(x, sort_keys=True))


NASTY = [
    {"a": 'brace } in "text", [and] {more', "b": "\\", "c": "\\\\\"}", "d": {"e": [{"f": "}"}, [], {}]}},
    {},
    {"k": "ends with backslash \\"},
    {"deep": [[[{"x": {"y": {"z": "]}{["}}}]]], "n": -1.5e3, "t": True, "u": None, "é東😀": "\u0000\n\t"},
    {"long": "}" * 300 + '"' * 30},
]


@pytest.mark.parametrize("split_bytes", [7, 64, 1 << 20])
@pytest.mark.parametrize("indent", [None, 2])
def test_nasty_elements_equal_whole_parsing(spark, scratch, split_bytes, indent):
    rng = random.Random(3)
    elements = [{"i": i, **rng.choice(NASTY)} for i in range(40)]
    path = f"{scratch}/a.json"
    with open(path, "w") as f:
        json.dump(elements, f, indent=indent, ensure_ascii=bool(indent))
    got = parsed(read_array_elements(spark, path, split_bytes))
    assert got == sorted(elements, key=lambda x: json.dumps(x, sort_keys=True))


def test_many_files_empty_arrays_and_white_space(spark, scratch):
    for name, text in {"e": "[]", "w": " [ \n ] \n", "o": ' \n[ {"a": 1} \n]\n\n', "t": '[{"a": 2},{"a": 3}]'}.items():
        with open(f"{scratch}/{name}.json", "w") as f:
            f.write(text)
    assert [x["a"] for x in parsed(read_array_elements(spark, scratch, 4))] == [1, 2, 3]


@pytest.mark.parametrize("text", ['{"a": 1}', '[{"a": 1}', "[1, 2]", '[{"a": 1}, 5]', '["x", {"a": 1}]', '[{"a": 1} {"b": 2}]', '[{"a": 1}] trailing', '[{"a": [1, 2}]', '[{"a": "}', "[{}"])
def test_a_file_that_is_no_array_of_objects_fails(spark, scratch, text):
    with open(f"{scratch}/bad.json", "w") as f:
        f.write(text)
    with pytest.raises(Exception, match="not an array of objects"):
        read_array_elements(spark, f"{scratch}/bad.json", 5).collect()


def test_one_file_over_eight_tasks_and_no_row_holds_it(spark, scratch):
    elements = [{"i": i, "text": f"record {i} }} " * 5} for i in range(2000)]
    path = f"{scratch}/big.json"
    with open(path, "w") as f:
        json.dump(elements, f)
    import os

    size = os.path.getsize(path)
    df = read_array_elements(spark, path, -(-size // 8))
    from tidemark.sources.json_split import _segments

    segments = _segments(spark, path, -(-size // 8))
    assert segments.select("block").distinct().count() == 8 and segments.rdd.getNumPartitions() == 8
    assert segments.agg(F.max(F.length("value"))).first()[0] < 200
    whole = pages.explode_json_array(pages.read_whole_files(spark, path))
    assert parsed(df) == parsed(whole) and df.count() == 2000

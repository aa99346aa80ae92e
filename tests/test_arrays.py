"""JSON arrays read by byte ranges: the same records as the multi-line reader, at every place of a border."""

from __future__ import annotations

import json
import os
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerostat.sources.arrays import read_array_elements, read_arrays

SCHEMA = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType()),
                       T.StructField("c", T.StructType([T.StructField("d", T.ArrayType(T.StringType()))]))])


@pytest.fixture()
def ranges(spark):
    """Sets how many bytes a range has."""
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {k: spark.conf.get(k) for k in keys}

    def to(n):
        for k in keys:
            spark.conf.set(k, str(n))

    yield to
    for k, v in before.items():
        spark.conf.set(k, v)


def written(workdir, text, name="data.json"):
    path = os.path.join(workdir, name)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)
    return path


leaves = st.text(alphabet=st.sampled_from('ab{}[],:"\\ \n\té日'), max_size=12)
records = st.lists(st.fixed_dictionaries({}, optional={
    "a": st.integers(0, 99), "b": leaves, "c": st.fixed_dictionaries({"d": st.lists(leaves, max_size=3)}), "x}": leaves}), max_size=9)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(records=records, size=st.integers(1, 60), indent=st.sampled_from([None, 1]), ascii_only=st.booleans())
def test_same_as_the_multi_line_reader(spark, workdir, ranges, records, size, indent, ascii_only):
    path = written(workdir, json.dumps(records, indent=indent, ensure_ascii=ascii_only) + "\n", f"{random.random()}.json")
    ranges(size)
    got = read_arrays(spark, path, SCHEMA).collect()
    want = spark.read.schema(SCHEMA).option("multiLine", True).option("mode", "FAILFAST").json(path).collect()
    assert sorted(map(str, got)) == sorted(map(str, want)) and len(got) == len(records)


def test_every_border(spark, workdir, ranges):
    text = ' [ {"a": 1, "b": "}\\\\\\"{"},\n{"a": 2, "c": {"d": ["]", "\\\\"]}} , {} ]  \n'
    for size in [*range(1, 20), len(text) - 1, len(text)]:
        ranges(size)
        got = [r.element for r in read_array_elements(spark, written(workdir, text, f"{size}.json")).collect()]
        assert sorted(json.dumps(json.loads(e)) for e in got) == sorted(json.dumps(e) for e in json.loads(text))


def test_one_array_is_read_by_several_tasks(spark, workdir, ranges):
    many = [{"a": i, "b": "}{" * (i % 7) + '"', "c": {"d": ["]"] * (i % 3)}} for i in range(40_000)]
    path = written(workdir, json.dumps(many))
    ranges(256 << 10)
    df = read_arrays(spark, path, SCHEMA)
    assert df.agg(F.count("*"), F.sum("a"), F.sum(F.length("b"))).first() == (
        40_000, sum(m["a"] for m in many), sum(len(m["b"]) for m in many))
    parts = spark.read.option("lineSep", "}").text(path).rdd.getNumPartitions()
    tasks = [n for n in read_array_elements(spark, path).rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect() if n > 500]
    assert parts > 4 and len(tasks) > 4


@pytest.mark.parametrize("text", ['[{"a": 1}', '[{"a": 1}, {"a": "', '[{"a": 1}] x', '[{"a": 1} {"a": 2}]', '[{"a": 1},]', "[1, 2]", "[null]", "[[]]",
                                  '{"a": 1}', '[{"a": 1}][{"a": 2}]', '[{"a": 1} x]', '[{"a": "q"}]', '"x"', '[,{"a": 1}]', '[{"a": 1}'])
@pytest.mark.parametrize("size", [3, 1000])
def test_bad_files_fail(spark, workdir, ranges, text, size):
    ranges(size)
    with pytest.raises(Exception):  # noqa: B017
        read_arrays(spark, written(workdir, text), SCHEMA).collect()


@pytest.mark.parametrize("text", ["", "[]", " [\n ]\n", "   "])
@pytest.mark.parametrize("size", [1, 1000])
def test_empty_arrays(spark, workdir, ranges, text, size):
    ranges(size)
    good = written(workdir, '[{"a": 5}]', "other.json")
    assert [r.a for r in read_arrays(spark, [written(workdir, text), good], SCHEMA).collect()] == [5]


def test_missing_file_and_tag(spark, workdir):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_arrays(spark, f"{workdir}/none.json", SCHEMA)
    paths = [written(workdir, json.dumps([{"a": i}] * i), f"{i}.json") for i in (1, 2, 3)]
    got = read_arrays(spark, paths, SCHEMA, F.regexp_extract("_metadata.file_name", r"(\d)", 1)).select("a", "tag").collect()
    assert sorted(map(tuple, got)) == [(1, "1"), (2, "2"), (2, "2"), (3, "3"), (3, "3"), (3, "3")]

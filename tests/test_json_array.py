"""JSON array files in byte-range splits: the same records whatever the splits, against ``json.loads``."""

from __future__ import annotations

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from encore.session import local_fs_path, scratch_path
from encore.sources.json_array import array_objects, split_pieces, write_json_array
from encore.sources.json_source import accepted, ingest, rejected


def write(spark, *texts):
    path = scratch_path(spark, "arrays")
    os.makedirs(local_fs_path(path))
    for i, text in enumerate(texts):
        with open(os.path.join(local_fs_path(path), f"{i}.json"), "w") as f:
            f.write(text)
    return path


@pytest.fixture
def split_bytes(spark):
    """Sets the size of the splits that the text reader makes."""
    name, size, cost = "spark.sql.files.maxPartitionBytes", None, spark.conf.get("spark.sql.files.openCostInBytes")
    size = spark.conf.get(name)

    def use(n):
        spark.conf.set(name, n)
        spark.conf.set("spark.sql.files.openCostInBytes", 1)
    yield use
    spark.conf.set(name, size)
    spark.conf.set("spark.sql.files.openCostInBytes", cost)


def value(rnd, depth=0):
    kinds = [lambda: rnd.randint(-5, 10**9), lambda: None, lambda: rnd.random(), lambda: True,
             lambda: "".join(rnd.choice('ab{}[]",\\:\n é🙂/') for _ in range(rnd.randint(0, 12)))]
    if depth < 3:
        kinds += [lambda: {f"k{i}": value(rnd, depth + 1) for i in range(rnd.randint(0, 3))}, lambda: [value(rnd, depth + 1) for _ in range(rnd.randint(0, 3))]]
    return rnd.choice(kinds)()


def records(rnd, n):
    return [{f"c{i}": value(rnd) for i in range(rnd.randint(0, 4))} for _ in range(n)]


def parsed(objects):
    return sorted(json.dumps(json.loads(r.value), sort_keys=True) for r in objects.collect())


@pytest.mark.parametrize("size", [40, 97, 1000, 10**6])
def test_same_records_for_any_split(spark, split_bytes, size):
    rnd = random.Random(size)
    arrays = [records(rnd, n) for n in (0, 1, 7, 40, 90)]
    path = write(spark, *[json.dumps(a, indent=(2, None, 4, 2, 0)[i], ensure_ascii=i % 2 == 0) for i, a in enumerate(arrays)], "", "[ ]\n")
    split_bytes(size)
    want = sorted(json.dumps(r, sort_keys=True) for a in arrays for r in a)
    assert parsed(array_objects(spark, path)) == want
    spark.conf.set("encore.broadcast.limit.bytes", "0")
    try:
        assert parsed(array_objects(spark, path)) == want
    finally:
        spark.conf.unset("encore.broadcast.limit.bytes")


def test_one_file_is_read_by_several_tasks_with_rejects(spark, split_bytes):
    users = [{"user_id": f"u{i}", "email": "}{ \"quoted\\", "signup_date": "2021-01-01" if i % 10 else "never"} for i in range(400)]
    users[7] = {"user_id": "u7", "is_active": None}
    text = json.dumps(users, indent=2)
    path = write(spark, text[:-2] + ',\n  17,\n  "text",\n  {"user_id": "last"}\n]\n')
    split_bytes(4096)
    pieces = split_pieces(spark, path)
    tasks = pieces.select(F.spark_partition_id().alias("task")).distinct().count()
    assert tasks >= len(text) // 4096 > 4
    got = ingest(spark, path, "stg_users", layout="array")
    assert accepted(got).count() == 400 - 40 + 1
    reasons = sorted(tuple(r._rejected) for r in rejected(got).collect())
    assert reasons == [("_record",)] * 2 + [("signup_date",)] * 40
    active = {r.user_id: r.is_active for r in accepted(got).collect()}
    assert active["u7"] is None and active["u8"] is True and active["last"] is True


@pytest.mark.parametrize("text, good, bad", [
    ('[{"a": 1}, {"b": ', ['{"a": 1}'], 1), ('[{"a": 1}, {"b": "x', ['{"a": 1}'], 1), ('[{"a": 1}', ['{"a": 1}'], 0),
    ('[{"a": 1}]  \n', ['{"a": 1}'], 0), ("[1, 2]", [], 2), ('[{"a": 1}, oops {"a": 2}]', ['{"a": 1}', '{"a": 2}'], 1)])
def test_broken_files_keep_their_whole_records(spark, text, good, bad):
    """Whole objects are kept; each other element, and what a file ends inside of, is one record to reject."""
    rows = [r.value for r in array_objects(spark, write(spark, text)).collect()]
    assert sorted(r for r in rows if r in good) == good and len(rows) == len(good) + bad


def test_written_arrays_are_json(spark, split_bytes):
    rnd = random.Random(3)
    rows = records(rnd, 50)
    path = scratch_path(spark, "written")
    write_json_array(spark.createDataFrame([(json.dumps(r),) for r in rows], "value string"), path, files=2)
    files = [f for f in os.listdir(local_fs_path(path)) if f.startswith("part-")]
    back = [r for f in files for r in json.load(open(os.path.join(local_fs_path(path), f)))]
    assert len(files) == 2 and sorted(map(json.dumps, back)) == sorted(map(json.dumps, rows))
    split_bytes(200)
    assert parsed(array_objects(spark, path)) == sorted(json.dumps(r, sort_keys=True) for r in rows)

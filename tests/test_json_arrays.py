"""Elements of JSON arrays cut out by many tasks, against the standard parser."""

from __future__ import annotations

import gzip
import json
import random

import pytest
from pyspark.sql.types import StructType

from corridor.sources import json_arrays

HARD = ['"', "\\", "}", "{", "[", "]", ",", '\\"', "}\\", "\n", "é", "漢", "﻿", " "]


def value(rng: random.Random, depth: int = 0):
    kind = rng.randrange(6 if depth < 3 else 4)
    if kind == 4:
        return [value(rng, depth + 1) for _ in range(rng.randrange(4))]
    if kind == 5:
        return {text(rng): value(rng, depth + 1) for _ in range(rng.randrange(4))}
    return [rng.randrange(1000), text(rng), None, True][kind]


def text(rng: random.Random) -> str:
    return "".join(rng.choice(HARD) for _ in range(rng.randrange(6)))


def objects(seed: int, n: int) -> list[dict]:
    rng = random.Random(seed)
    return [{"i": i, text(rng): value(rng), "last": text(rng)} for i in range(n)]


@pytest.fixture
def small_pieces(spark, monkeypatch):
    monkeypatch.setattr(json_arrays, "BLOCK_BITS", 3)
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, "700")
    yield
    spark.conf.set(name, before)


def found(spark, path) -> dict[str, list]:
    held: dict[str, dict] = {}
    for row in json_arrays.elements(spark, str(path)).collect():
        held.setdefault(row["file"].rsplit("/", 1)[1], {})[row["element"]] = row["text"]
    return {file: [json.loads(own[i]) for i in range(len(own))] for file, own in held.items()}


def test_any_layout_equals_the_standard_parser(spark, tmp_path, small_pieces):
    layouts = {"line.json": {}, "pretty.json": {"indent": 2}, "raw.json": {"ensure_ascii": False}, "packed.json.gz": {"indent": 1}}
    want = {}
    for seed, (name, how) in enumerate(layouts.items()):
        want[name] = objects(seed, 60)
        data = json.dumps(want[name], **how).encode()
        (tmp_path / name).write_bytes(gzip.compress(data) if name.endswith("gz") else data)
    assert found(spark, tmp_path) == want
    # the plain file of one line is read by several tasks
    assert spark.read.option("lineSep", "}").text(str(tmp_path / "line.json")).rdd.getNumPartitions() > 3


def test_arrays_by_line_empty_files_and_byte_order_mark(spark, tmp_path, small_pieces):
    (tmp_path / "lines.json").write_text('[{"a": "}"}, {"a": 2}]\n[]\n[{"a": {"b": 3}}]\n')
    (tmp_path / "empty.json").write_text("")
    (tmp_path / "none.json").write_text(" [ ] ")
    (tmp_path / "mark.json").write_bytes(b'\xef\xbb\xbf\n [ {}, {"a": {}} ,1, null]')
    assert found(spark, tmp_path) == {
        "lines.json": [{"a": "}"}, {"a": 2}, {"a": {"b": 3}}], "mark.json": [{}, {"a": {}}]
    }


def test_cut_off_file_and_no_array(spark, tmp_path):
    schema = StructType.fromDDL("a int, b string")
    (tmp_path / "cut.json").write_text('[{"a": 1, "b": "x"}, {"a": 2, "b": "y')
    held = json_arrays.documents(spark, str(tmp_path / "cut.json"), schema).collect()
    assert sorted(((r["a"], r["b"]) for r in held), key=str)[0] == (1, "x")
    assert len(held) == 2 and (2, "y") not in [tuple(r) for r in held]
    (tmp_path / "object.json").write_text('{"a": 1}')
    with pytest.raises(Exception, match="not a JSON array"):
        json_arrays.elements(spark, str(tmp_path / "object.json")).collect()

"""Records over line breaks and splits, against whole files parsed at once."""

import csv
import io
import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tallylake.sources import files as src

SCHEMA = "id string, txt string, sub struct<a:int,b:array<string>>"
TEXTS = st.text('ab}{][",:\\\n\r é', max_size=12)


@pytest.fixture
def small_splits(spark):
    """Files of a few hundred bytes are cut into many splits."""
    settings = {"spark.sql.files.maxPartitionBytes": "97", "spark.sql.files.openCostInBytes": "1", "spark.sql.files.minPartitionNum": "1"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key in settings:
        spark.conf.unset(key)


def objects(texts):
    return [{"id": i, "txt": t, "sub": {"a": i, "b": [t, "}"]} if i % 2 else None} for i, t in enumerate(texts)]


def rows(frame):
    return sorted(((r.id, r.txt, None if r["sub"] is None else (r["sub"].a, r["sub"].b)) for r in frame.collect()), key=str)


def wanted(items):
    return sorted(((str(o["id"]), o["txt"], None if o["sub"] is None else (o["sub"]["a"], o["sub"]["b"])) for o in items), key=str)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(TEXTS, max_size=25), st.sampled_from([None, 1]), st.booleans())
def test_json_arrays_equal_the_parser(spark, small_splits, tmp_path_factory, texts, indent, escaped):
    path = tmp_path_factory.mktemp("json")
    items = objects(texts)
    (path / "a.json").write_text(json.dumps(items, indent=indent, ensure_ascii=escaped))
    (path / "b.json").write_text(" \n" + json.dumps(items[:3], ensure_ascii=escaped) + "\n")
    assert rows(src.read_json(spark, str(path), SCHEMA, multiline=True)) == wanted(items + items[:3])


def test_one_array_file_is_read_by_many_tasks(spark, small_splits, tmp_path):
    items = objects([f'say "{{{i}}}" \\ and\n[{i}' * (40 if i == 7 else 1) for i in range(60)])
    (tmp_path / "one.json").write_text(json.dumps(items))
    frame = src.read_json(spark, str(tmp_path), SCHEMA, multiline=True)
    assert rows(frame) == wanted(items)
    assert spark.read.text(str(tmp_path), lineSep="}").rdd.getNumPartitions() > 20


def test_json_edges(spark, small_splits, tmp_path):
    files = {
        "empty": "", "none": "[]", "spaces": " [ \n ] ", "single": '{"id": 1,\n "txt": "x"}\n', "two": '{"id": 2}\n{"id": 3, "sub": {"a": 4}}',
        "cut": '[{"id": 5}, {"id": 6', "mark": '﻿[{"id": 7}]', "nested": '[{"id": "8", "sub": {"a": 1, "b": ["[", "{\\"", "\\\\"]}}]',
    }
    for name, text in files.items():
        (tmp_path / f"{name}.json").write_text(text)
    found = rows(src.read_json(spark, str(tmp_path), SCHEMA, multiline=True))
    assert found == sorted(
        [("1", "x", None), ("2", None, None), ("3", None, (4, None)), ("5", None, None), ("7", None, None), ("8", None, (1, ["[", '{"', "\\"]))], key=str
    )


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text('ab",;\n é', max_size=12), max_size=25), st.booleans(), st.sampled_from(["\n", "\r\n"]))
def test_csv_equals_the_parser(spark, small_splits, tmp_path_factory, texts, header, line_end):
    path = tmp_path_factory.mktemp("csv")
    text = io.StringIO()
    writer = csv.writer(text, delimiter=";", lineterminator=line_end, quoting=csv.QUOTE_ALL)
    if header:
        writer.writerow(["id", "txt"])
    writer.writerows(enumerate(texts))
    for name in ("a", "b"):
        (path / f"{name}.csv").write_bytes(text.getvalue().encode())
    frame = src.read_csv(spark, str(path), "id int, txt string", delimiter=";", header=header, multiline=True, null_text="\\N")
    assert sorted(map(tuple, frame.collect())) == sorted(2 * list(enumerate(texts)))


def test_csv_names_types_and_missing_values(spark, small_splits, tmp_path):
    path = str(tmp_path / "t.csv")
    (tmp_path / "t.csv").write_text('id,txt,n\n1,"a\n""b""",\n2,,7\n\n3,"x,y",8')
    how = {"header": True, "multiline": True}
    assert src.read_csv(spark, path, **how).dtypes == [("id", "string"), ("txt", "string"), ("n", "string")]
    typed = src.read_csv(spark, path, infer=True, **how)
    assert typed.dtypes == [("id", "int"), ("txt", "string"), ("n", "int")]
    assert sorted(map(tuple, typed.collect())) == [(1, 'a\n"b"', None), (2, None, 7), (3, "x,y", 8)]
    assert typed.select("n").filter("n = 8").count() == 1


def test_rejects_with_line_breaks(spark, small_splits, tmp_path):
    (tmp_path / "tx.csv").write_text('1,2.50,"o\nk"\n2,abc,"b\nad"\n3,4.00,ok\n4,1.00,too,many\n')
    frame = src.read_csv_with_rejects(spark, str(tmp_path), "id int, price decimal(10,2), note string", multiline=True)
    good, bad = src.split_rejects(frame)
    assert sorted((r.id, r.note) for r in good.collect()) == [(1, "o\nk"), (3, "ok")]
    assert sorted(r.wrong_data for r in bad.collect()) == ['2,abc,"b\nad"', "4,1.00,too,many"]
    assert good.count() == 2 and sorted(r.id for r in good.select("id").collect()) == [1, 3]
    assert bad.select("wrong_data").count() == 2

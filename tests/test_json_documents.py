"""JSON arrays, envelopes and objects in one file, cut over many tasks, against Python's reader."""

import json
import random

import pytest
from pyspark.sql import functions as F

from fieldmart.sources import feeds
from fieldmart.sources import json_documents as J


def tricky(rng, depth=0):
    text = rng.choice(["plain", "}{", '"', "\\", '\\"}', "[,]", "é中😀", "", "a\nb", '{"x": "}"}', '"}' * 3, "{{"])
    return {"id": rng.randint(0, 10**6), text[:3] or "k": text, "list": [text, 1, None, {"deep": [text]}],
            **({"inner": tricky(rng, depth + 1)} if depth < 2 and rng.random() < 0.6 else {})}


@pytest.fixture
def cut_small(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    spark.conf.set("spark.sql.files.openCostInBytes", "1k")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", before[0])
    spark.conf.set("spark.sql.files.openCostInBytes", before[1])


def found(df):
    rows = df.orderBy("number").collect()
    return [json.loads(r.document) for r in rows if r.document], [r.malformed for r in rows if r.malformed]


@pytest.mark.parametrize("indent", [None, 2])
@pytest.mark.parametrize("shape", ["list", "envelope", "objects"])
def test_one_file_over_many_tasks(spark, tmp_path, cut_small, shape, indent):
    docs = [tricky(random.Random(i)) for i in range(250)]
    dump = lambda x: json.dumps(x, ensure_ascii=False, indent=indent)
    text = {"list": lambda: f" {dump(docs)} \n", "envelope": lambda: dump({"data": docs, "count": 3, "meta": {"of": [{"x": "]"}]}}), "objects": lambda: "\n".join(map(dump, docs))}[shape]()
    (tmp_path / "f.json").write_text(text)
    assert J._pieces(spark, str(tmp_path)).rdd.getNumPartitions() > 3
    df = J.documents(spark, str(tmp_path))
    assert found(df) == (docs, [])
    assert {r.element for r in df.collect()} == {shape != "objects"}
    lines = J.land_documents(spark, str(tmp_path), str(tmp_path / "lines"))
    assert sorted(json.dumps(json.loads(r.value)) for r in lines.collect()) == sorted(map(json.dumps, docs))


@pytest.mark.parametrize("text, records, reasons", [
    ("[]", [], []), ("", [], []), (" \n ", [], []), ("[1, 2]", [], [J.NOT_AN_OBJECT] * 2), ("[{}]", [{}], []), ('{"a": "1"', [], [J.BROKEN]),
    ('[{"a": "1"}, 7, {"b": "2"}]', [{"a": "1"}, {"b": "2"}], [J.NOT_AN_OBJECT]), ('[{"a": "1"}, 7]', [{"a": "1"}], [J.NOT_AN_OBJECT]),
    ('[{"a": "1"}, {"b": "', [{"a": "1"}], [J.BROKEN]), ('{"data": [{"a": "}"}]}', [{"a": "}"}], []), ('{"data": []}', [], []),
    ('{"data": [{"a": "1"}], "n": 1}', [{"a": "1"}], []), ('{"a": "1"}', [{"a": "1"}], [])])
def test_small_files(spark, tmp_path, text, records, reasons):
    (tmp_path / "f.json").write_text(text)
    got = feeds.read_envelopes(spark, str(tmp_path)).collect()
    assert sorted(str(dict(r.record)) for r in got if r.record is not None) == sorted(map(str, records)) and sorted(r.malformed for r in got if r.malformed) == sorted(reasons)


def test_several_files_keep_apart(spark, tmp_path):
    for i in range(4):
        (tmp_path / f"{i}.json").write_text(json.dumps([{"f": str(i), "n": str(k)} for k in range(i)]))
    got = feeds.read_envelopes(spark, str(tmp_path)).collect()
    assert sorted((r.record["f"], r.record["n"]) for r in got) == sorted((str(i), str(k)) for i in range(4) for k in range(i))


def test_weather_array_equals_lines(spark, tmp_path, cut_small):
    days = [f"2026-0{1 + d // 28}-{1 + d % 28:02d}" for d in range(56)]
    docs = [{"_region_name": f"r {i} }}", "latitude": 1.0, "longitude": 2.0, "daily": {
        "time": days, **{k: [float(i)] * 56 for k in list(feeds.WEATHER_SERIES.values())[1:]}}} for i in range(30)]
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "w.json").write_text(json.dumps(docs, indent=1))
    J.land_documents(spark, str(tmp_path / "a"), str(tmp_path / "lines"))
    a, b = feeds.read_weather(spark, str(tmp_path / "a"), multiline=True), feeds.read_weather(spark, str(tmp_path / "lines"))
    assert a.exceptAll(b).count() == b.exceptAll(a).count() == 0 and a.agg(F.count("*")).first()[0] == 30 * 56

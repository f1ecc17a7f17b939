"""Messages landed by inferred columns."""

import oracle
import pytest
from pyspark.sql import functions as F

from loadkit.operators.versioned import Table
from loadkit.plans import landing, registry, stages
from loadkit.sources.formats import FileFormat, reader
from loadkit.streaming import rowstream as R

AS_OF = "2024-02-01 00:00:00"


def landed(spark, table, values):
    messages = spark.createDataFrame([("t", v) for v in values], "topic string, value string")
    table.append(R.land_inferred(messages, table), AS_OF)


def test_columns_come_from_payloads_and_widen_the_table(spark, tmp_path):
    table = Table(spark, str(tmp_path / "t"))
    landed(spark, table, ['{"id": 1, "v": 1.5, "none": null}', '{"id": 2, "v": 3, "o": {"k": "x"}}', "no json", "[1]", None])
    assert {f.name: f.dataType.simpleString() for f in table.schema()} == {
        "id": "bigint", "v": "double", "o": "struct<k:string>", "record_content": "string", "record_topic": "string"}
    landed(spark, table, ['{"id": 3, "v": 4, "more": true}'])
    landed(spark, table, [])
    rows = table.read().collect()
    assert sorted((r.id, r.v, r.more) for r in rows if r.id) == [(1, 1.5, None), (2, 3.0, None), (3, 4.0, True)]
    assert sorted(str(r.record_content) for r in rows if r.id is None) == ["None", "[1]", "no json"]


def test_a_change_of_type_stops_the_load(spark, tmp_path):
    table = Table(spark, str(tmp_path / "t"))
    landed(spark, table, ['{"id": 1}'])
    with pytest.raises(ValueError, match="id is bigint"):
        landed(spark, table, ['{"id": "a"}'])
    assert table.read().count() == 1


@pytest.mark.parametrize("order", [("stream_flatten", "copy_json_arrays"), ("copy_json_arrays", "stream_flatten")])
def test_stages_of_one_name_are_not_shared(spark, sf, monkeypatch, order):
    monkeypatch.setattr(stages, "_MADE", {})
    con = oracle.connect(sf)
    for name in order:
        assert oracle.difference(registry.all_queries()[name](spark, sf), con, registry.all_oracles()[name]) is None


def test_an_array_is_read_about_once(spark, tmp_path):
    """Number texts come as written, without going back into the file for each of them."""
    rows = [f'{{"id": {i}, "v": {i}.10}}' for i in range(20_000)]
    (tmp_path / "a.json").write_text("[" + ",\n".join(rows) + "]")
    (tmp_path / "b.json").write_text('[{"id": 7, "v": 1')
    size = (tmp_path / "a.json").stat().st_size
    read = lambda: sum(s.getBytesRead() for s in spark._jvm.org.apache.hadoop.fs.FileSystem.getAllStatistics())
    before = read()
    got = reader(spark, FileFormat.json(strip_outer_array=True), columnNameOfCorruptRecord="_c").schema("id string, v string, _c string").load(str(tmp_path))
    assert got.where("v = id || '.10'").count() == 20_000
    assert read() - before < 3 * size
    assert [r._c for r in got.where("_c is not null").collect()] == ['[{"id": 7, "v": 1']


def test_arrays_are_bounded(spark, sf):
    path = landing.array_stage(spark, sf, most=5)
    sizes = [r.n for r in reader(spark, FileFormat.json(strip_outer_array=True)).schema("event_id string").load(path).groupBy("_metadata.file_path").agg(F.count(F.lit(1)).alias("n")).collect()]
    assert sum(sizes) == spark.read.parquet(f"{sf}/events.parquet").count()
    assert max(sizes) <= 20

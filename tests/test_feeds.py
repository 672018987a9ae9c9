"""Files of outside formats, staged tables and logs, on small made inputs."""

import gzip
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from placewright.sources import readers, writers
from placewright.streaming import incremental


def test_text_lines(spark, tmp_path):
    with gzip.open(tmp_path / "a.gz", "wt") as f:
        f.write("x\ny\n")
    with zipfile.ZipFile(tmp_path / "b.zip", "w") as z:
        z.writestr("one.txt", "1\n\n2\r\n")
        z.writestr("two.txt", "3\n")
    assert [r.value for r in readers.text_lines(spark, f"{tmp_path}/a.gz").collect()] == ["x", "y"]
    assert [r.value for r in readers.text_lines(spark, f"{tmp_path}/b.zip", "one.txt").collect()] == ["1", "", "2"]
    with pytest.raises(Exception, match="2 members"):
        readers.text_lines(spark, f"{tmp_path}/b.zip").collect()


def test_staged_takes_the_latest_stage(spark, tmp_path):
    (tmp_path / "xx_extract.jsonl").write_text('{"place_id": "xx:1"}\n\n{bad\n')
    assert [r.place_id for r in readers.staged(spark, str(tmp_path), "xx", "place_id string").collect()] == ["xx:1"]
    spark.createDataFrame([("xx:2",)], "place_id string").write.parquet(f"{tmp_path}/xx_final.parquet")
    assert [r.place_id for r in readers.staged(spark, str(tmp_path), "xx").collect()] == ["xx:2"]
    with pytest.raises(FileNotFoundError):
        readers.staged(spark, str(tmp_path), "yy")


def test_lines_with_faults(spark):
    good = "\t".join(["1", "Ayr", "", "", "55.5", "-4.6", "P", "", "GB", "", "", "", "", "", "", "x", "7", "", ""])
    lines = spark.createDataFrame([(good,), ("#",), ("",), (None,), ("2\tshort",), (good.replace("55.5", "north"),)], "value string")
    (row,) = readers.geonames_places(lines).collect()
    assert (row.place_id, row.elevation, row.population, row.types[0].sourceLabel) == ("gn:1", 7, None, "P")
    assert readers.ntriples(spark.createDataFrame([("<a> <b> oops .",), (None,)], "value string")).count() == 0


def test_geojson(spark, tmp_path):
    (tmp_path / "f.geojson").write_text(json.dumps({"type": "FeatureCollection", "features": [{"id": "a", "properties": {"name": "N"}, "geometry": {"type": "Point", "coordinates": [1, 2]}}, {"id": "b", "properties": None, "geometry": None}]}))
    rows = {r.id: r for r in readers.geojson_features(spark, f"{tmp_path}/f.geojson", "name:string").collect()}
    assert (rows["a"].name, rows["a"].geometry_type, json.loads(rows["a"].geometry)["coordinates"]) == ("N", "Point", [1, 2])
    assert (rows["b"].name, rows["b"].geometry_type) == (None, None)


def test_unknown_status_raises(spark):
    rows = spark.createDataFrame([("contributed:1", "contributed", None, None)], "place_id string, namespace string, dataset_status string, dataset_id string")
    with pytest.raises(Exception, match="dataset_status of contributed:1"):
        writers.with_dataset(rows).collect()


def test_written_lists(spark, tmp_path):
    rows = spark.createDataFrame([("a", [], "x"), ("b", ["q"], "y")], "id string, items array<string>, script string")
    writers.write_staged(rows, f"{tmp_path}/t", files=1, by="script")
    assert {r.id: r["items"] for r in spark.read.parquet(f"{tmp_path}/t").collect()} == {"a": None, "b": ["q"]}


def test_log_resumes_and_last_operation_wins(spark, tmp_path):
    kinds = "a string, b string, n long, op string"
    source, log = f"{tmp_path}/in", f"{tmp_path}/log"

    def add(*rows):
        spark.createDataFrame(list(rows), kinds).coalesce(1).write.mode("append").parquet(source)
        stream = incremental.assertions(incremental.events_stream(spark, source), "a", "b").select("place_a", "place_b", "n", "op")
        return incremental.run_available(stream, log)

    first = add(("q", "p", 1, "assert"), ("p", "p", 2, "assert"), (None, "p", 3, "assert"), ("r", "p", 4, "assert"))
    assert first.count() == 2
    out = add(("p", "q", 5, "revoke"), ("p", "r", 6, "assert"))
    assert out.count() == 4
    live = incremental.live(out, ["place_a", "place_b"], "n")
    assert [(r.place_a, r.place_b, r.n) for r in live.collect()] == [("p", "r", 6)]
    batch = live.select("place_a", "place_b", F.lit(0).cast("long").alias("n"))
    assert [r.n for r in incremental.batch_first(batch, live, ["place_a", "place_b"]).collect()] == [0]


def test_wide_escapes(spark):
    text = r"\U0001F3F0 Köln \U00000041\\x"
    (row,) = readers.ntriples(spark.createDataFrame([(f'<a> <b> "{text}"@en .',)], "value string")).collect()
    assert row.object == "\U0001f3f0 Köln A\\x" and row.lang == "en"


def test_the_antimeridian_is_repaired_to_its_western_side(spark):
    given = spark.createDataFrame([("a", 180.0, 10.0), ("b", -180.0, 10.0), ("c", 181.0, 95.0), ("d", None, None)], "place_id string, lon double, lat double")
    out, changed = writers.repair_points(given)
    assert {r.place_id: (r.lon, r.lat) for r in out.where(changed).collect()} == {"a": (-180.0, 10.0), "c": (None, None)}

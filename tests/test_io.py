import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from sightline import schemas
from sightline.operators import baskets
from sightline.plans import jobs
from sightline.sources import readers, writers
from tests.conftest import sightings, values


def test_text_sightings_round_trip(spark, tmp_path):
    rows = sightings(spark, {"first_seen": 1488326400}, {"data": "a.b.com", "threat_score": 5.5})
    for header in (False, True):
        path = str(tmp_path / f"csv{header}")
        writers.write_csv(rows, path, header=header)
        back = readers.read_sightings(spark, path, header=header)
        assert back.schema == schemas.SIGHTINGS and values(back) == values(rows)
        assert len(readers.read_text_table(spark, path).columns) == 11


def test_bad_cells_become_null_and_blank_lines_vanish(spark, tmp_path):
    line = "r,d,c,IT,small,1.2.3.4,{},{},9,{},e\n"
    path = tmp_path / "in.csv"
    path.write_text(line.format("abc", "7.0", "5") + "\n" + line.format("3", "x", ""))
    got = values(readers.read_sightings(spark, str(path)), "count_seen", "first_seen", "last_seen", "threat_score")
    assert got == sorted([(None, 7, 9, 5.0), (3.0, None, 9, None)], key=repr)


def test_geo_readers(spark, tmp_path):
    (tmp_path / "loc.csv").write_text(
        "geoname_id,locale_code,continent_code,continent_name,country_iso_code,country_name\n1,en,EU,Europe,FR,France\n"
    )
    (tmp_path / "blk.csv").write_text(
        "network,geoname_id,registered_country_geoname_id,extra\n1.2.3.0/24,1,,0\n"
    )
    (tmp_path / "hosts.csv").write_text(" 1.2.3.4 ,x\nfoo.com,y\n")
    assert values(readers.read_locations(spark, str(tmp_path / "loc.csv"))) == [(1, "en", "EU", "Europe", "FR", "France")]
    blocks = readers.read_ip_blocks(spark, str(tmp_path / "blk.csv"))
    assert blocks.schema == schemas.IP_BLOCKS
    assert values(blocks, "start", "geoname_id", "registered_country_geoname_id") == [(16909056, 1, None)]
    assert values(readers.read_hosts(spark, str(tmp_path / "hosts.csv"))) == [("1.2.3.4",), ("foo.com",)]


def test_dimensions_rebuild_and_input_check(spark, tmp_path):
    frame = spark.range(3)
    for _ in range(2):
        writers.build_dimensions(frame, frame, str(tmp_path))
    assert spark.read.parquet(str(tmp_path / "ip_blocks")).count() == 3
    with pytest.raises(ValueError):
        writers.build_dimensions(frame, frame, str(tmp_path), "city")
    gone = str(tmp_path / "gone")
    assert writers.missing_paths(spark, [str(tmp_path / "ip_blocks"), gone]) == [gone]


def test_write_modes_and_report(spark, tmp_path):
    path = str(tmp_path / "p")
    writers.write_parquet(spark.range(3), path)
    writers.write_parquet(spark.range(9), path, "ignore")
    assert readers.read_parquet(spark, path).count() == 3
    with pytest.raises(AnalysisException):
        writers.write_parquet(spark.range(9), path)
    metrics = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "name string, value double")
    writers.write_report(metrics, str(tmp_path / "r"))
    assert len(list((tmp_path / "r").glob("part-*"))) == 1
    cached = writers.persist(metrics)
    assert cached.is_cached and not cached.unpersist().is_cached


def test_materialize_builds_once_and_hides_no_other_failure(spark, tmp_path):
    calls = []

    def build():
        calls.append(1)
        return spark.range(4)

    for _ in range(2):
        assert writers.materialize(spark, str(tmp_path / "m"), build).count() == 4
    assert len(calls) == 1
    (tmp_path / "broken").mkdir()
    (tmp_path / "broken" / "x.parquet").write_text("not parquet")
    with pytest.raises(Exception) as failure:
        writers.materialize(spark, str(tmp_path / "broken"), build)
    assert "PATH_NOT_FOUND" not in str(failure.value) and len(calls) == 1


def test_materialize_rebuilds_what_is_half_written_or_stale(spark, tmp_path):
    calls = []
    source, kept = str(tmp_path / "in"), tmp_path / "kept"
    spark.range(3).write.parquet(source)

    def get(settings="a"):
        def build():
            calls.append(1)
            return spark.read.parquet(source)

        return writers.materialize(spark, str(kept), build, [source], settings).count()

    assert (get(), get(), len(calls)) == (3, 3, 1)
    # A changed input, then a changed setting.
    spark.range(2).write.mode("append").parquet(source)
    assert (get(), get(), len(calls)) == (5, 5, 2)
    assert (get("b"), get("b"), len(calls)) == (5, 5, 3)
    # Stopped in the middle of a write: files, but no mark.
    for mark in [*kept.glob("_artifact-*"), *kept.glob("*_SUCCESS*")]:
        mark.unlink()
    assert (get("b"), len(calls)) == (5, 4)
    # Stopped between mark and rename: the staged files are taken as they are.
    kept.rename(tmp_path / "kept._staged")
    assert (get("b"), len(calls)) == (5, 4)
    assert not (tmp_path / "kept._staged").exists()
    # Without inputs too, a folder without the mark of success is half-written.
    half = tmp_path / "half"
    spark.range(9).write.parquet(str(half))
    (half / "_SUCCESS").unlink()
    assert writers.materialize(spark, str(half), lambda: spark.range(4)).count() == 4


def test_jobs_keep_the_graph_and_its_analyses(spark, tmp_path):
    path, folder = str(tmp_path / "sightings"), str(tmp_path / "graph")
    rows = sightings(spark, {"data": "a.com"}, {"data": "b.com"}, {"data": "a.com", "anonymous_id": "c2"})
    rows.write.parquet(path)

    def stamps():
        return {p.parent.name: p.stat().st_mtime_ns for p in (tmp_path / "graph").glob("*/_artifact-*")}

    first = jobs.analysis_job(spark, path, folder, ["triangles"])["triangles"]
    assert first.count() == 4 and set(stamps()) == {"vertices", "edges", "triangles"}
    before = stamps()
    jobs.analysis_job(spark, path, folder, ["triangles"])
    assert stamps() == before
    sightings(spark, {"data": "c.com"}).write.mode("append").parquet(path)
    assert jobs.analysis_job(spark, path, folder, ["triangles"])["triangles"].count() == 5
    assert all(stamps()[name] != at for name, at in before.items())


def test_upsert_last_write_wins(spark):
    current = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v long")
    changes = spark.createDataFrame([("b", 5, 1), ("b", 4, 2), ("c", None, 1)], "k string, v long, at int")
    assert values(writers.upsert(current, changes, "k", "at")) == sorted([("a", 1), ("b", 4), ("c", None)], key=repr)


def test_baskets_round_trip(spark, tmp_path):
    items = spark.createDataFrame([(["a", "b"],), (["c"],)], "items array<string>")
    writers.write_baskets(items, str(tmp_path / "b"))
    assert values(readers.read_baskets(spark, str(tmp_path / "b"))) == values(items)
    odd = spark.createDataFrame([(["a,b", 'say "x", y', " outer ", '"'],), (["plain", "ü,"],)], "items array<string>")
    writers.write_baskets(odd, str(tmp_path / "odd"))
    assert values(readers.read_baskets(spark, str(tmp_path / "odd"))) == values(odd)
    (tmp_path / "s.txt").write_text('a | "b|c" |d"e|"f\n')
    assert values(readers.read_baskets(spark, str(tmp_path / "s.txt"), "|")) == [(["a", "b|c", 'd"e', '"f'],)]
    (tmp_path / "t.txt").write_text("a, b,a\n\nc\n")
    assert values(readers.read_baskets(spark, str(tmp_path / "t.txt"))) == [(["a", "b"],), (["c"],)]


def test_schemas_name_every_table():
    assert schemas.SIGHTING_HEADERS[5] == "data" and len(schemas.SIGHTING_HEADERS) == 11
    assert schemas.ENRICHED.fieldNames()[-5:] == ["data", "continent", "country", "score_direction", "elapsed"]


def test_basket_from_feature_row(spark):
    frame = spark.createDataFrame(
        [("1.1.1.1", "5.9", "1", "0", "0.5"), ("2.2.2.2", "4.9", "0", "2.0", "x")],
        "ip string, lastScore string, c1 string, c2 string, c3 string",
    )
    assert dict(values(baskets.baskets_from_features(frame, ["c1", "c2", "c3"]))) == {
        "1.1.1.1": ["lastScore_greater_5_true", "c1"],
        "2.2.2.2": ["lastScore_greater_5_false", "c2"],
    }
    assert baskets.basket_sizes(frame.select(F.array("c1", "c2").alias("items"))).first()["n"] == 2

import json

from tidemark.sources import files, lookups
from tidemark.streaming.refresh import read_changes, refresh_stream


def test_incidents(spark):
    js = json.dumps([{"year": 1999, "killing_method": "beating", "victim": [{"victim_name": "A", "victim_age": "12.7"}, {"victim_name": "B"}]}, {"year": 2000, "weapon": "knife"}])
    df = spark.createDataFrame([(1, js), (2, "[{"), (3, None)], "id int, js string")
    incidents, victims = files.explode_incidents(df, "id", "js")
    assert [(r["article_id"], r["incident_idx"], r["weapon"]) for r in incidents.orderBy("incident_idx").collect()] == [(1, 0, "personal weapon"), (1, 1, "knife")]
    assert sorted(r["victim_row_id"] for r in victims.collect()) == ["1:0:0", "1:0:1"]


def test_lookup_caches_answers_and_lasting_errors(spark):
    def provider(keys):
        return [(None, "Unknown") if k == "u" else (None, "timeout") if k == "t" else (k.upper(), None) for k in keys]

    wanted = spark.createDataFrame([("a",), ("a",), ("u",), ("t",), ("c",), (None,)], "key string")
    cache = spark.createDataFrame([("c", "old")], "key string, answer string")
    answers, new, failed = lookups.cached_lookup(wanted, cache, "key", provider)
    assert {r["key"]: r["answer"] for r in new.collect()} == {"a": "A", "u": None, "c": "old"}
    assert [tuple(r) for r in failed.select("key", "error").collect()] == [("t", "timeout")]
    assert answers.count() == 6


def test_provider_failure_is_per_item(spark):
    def broken(keys):
        raise RuntimeError("no network")

    out = lookups.ask(spark.createDataFrame([("a",), ("b",)], "key string"), "key", broken).collect()
    assert {r["error"] for r in out} == {"RuntimeError: no network"}


def test_files(spark, tmp_path):
    p = tmp_path / "x.csv"
    p.write_text('a,b,_band_helper\n1,"x, ""y""",0\n2,z,1\n')
    df = files.read_csv(spark, str(p), "a int, b string, _band_helper int")
    assert [tuple(r) for r in df.orderBy("a").collect()] == [(1, 'x, "y"'), (2, "z")]
    files.export_report(df, str(tmp_path / "out"), ["a"], band="b")
    assert "band" in next((tmp_path / "out").glob("*.csv")).read_text().splitlines()[0]
    files.swap_in(df, str(tmp_path / "t"))
    files.swap_in(df.limit(1), str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).count() == 1
    geo = tmp_path / "g.json"
    geo.write_text(json.dumps({"features": [{"properties": {"boro_name": "A"}, "geometry": {"type": "Polygon", "coordinates": [[[0, 0], [1, 0], [1, 1], [0, 0]]]}}]}))
    assert files.read_polygons(spark, str(geo)).first()["region"] == "A"


def test_register(spark, tmp_path):
    p = tmp_path / "r.csv"
    p.write_text("State,Year,Month\nX,1999,March\nX,2005,May\nY,1999,June\n")
    assert [tuple(r) for r in files.read_register(spark, str(p), "X", (1990, 2000)).select("YearMonth").collect()] == [("1999-03",)]


def test_stream_refreshes_touched_keys(spark, tmp_path):
    src, target = tmp_path / "in", str(tmp_path / "t")
    schema = "k int, v int"
    derive = lambda b: b.groupBy("k").sum("v").toDF("k", "total")
    for rows in ([(1, 1), (2, 2)], [(2, 5)]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(src))
        refresh_stream(read_changes(spark, str(src), schema), target, ["k"], derive, str(tmp_path / "cp")).awaitTermination()
    assert sorted(map(tuple, spark.read.parquet(target).collect())) == [(1, 1), (2, 5)]

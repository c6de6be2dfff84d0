import json

import pytest

from oreline.operators.sampling import bernoulli_sample
from oreline.sources import readers, schemas, sinks


def post(user, text, **extra):
    return json.dumps({"text": text, "user": {"id_str": user, "name": "n"}, **extra})


LINES = [
    post("1", "hello"), post("1", "é … 😀", retweeted_status={"text": "x"}),
    post("2", "tab\there"), "  " + post("3", "spaces") + "  ",
    post("9", "cut")[:-1], post("9", "cut")[: 20], post("9", "x") + "}", post("9", "x") + post("9", "y"),
    post("9", "x") + "," + post("9", "y"), post("9", "x") + " trailing",
    "", "   ", "not json", "12", "null", "[1, 2]", "[" + post("9", "in a list") + "]",
    '{"limit": {"track": 5}}', '{"user": null, "text": "t"}', '{"user": {}, "text": "t"}',
    '{"user": {"id_str": "9"}}', "{'user': {'id_str': '9'}, 'text': 'single'}",
]


def test_only_whole_posts_survive(spark):
    df = spark.createDataFrame([(x,) for x in LINES] + [(None,)], "value string")
    got = sorted((r.user_id, r.text) for r in readers.parse_posts(df).collect())
    assert got == [("1", "hello"), ("1", "é … 😀"), ("2", "tab\there"), ("3", "spaces")]
    assert readers.rejected_lines(df).count() == len(LINES) + 1 - 4


def test_manifest(spark, tmp_path):
    for name, lines in [("a.json", LINES[:2]), ("b.json", LINES[2:])]:
        (tmp_path / name).write_text("\n".join(lines) + "\n", encoding="utf-8")
    manifest = tmp_path / "files.txt"
    manifest.write_text(f"{tmp_path}/a.json  \n{tmp_path}/b.json\t\n\n")
    assert readers.manifest_paths(spark, str(manifest)) == [f"{tmp_path}/a.json", f"{tmp_path}/b.json"]
    assert readers.read_posts(spark, str(manifest)).count() == 4
    assert readers.read_manifest(spark, str(manifest)).count() == len(LINES)


def test_paragraphs(spark, tmp_path):
    path = tmp_path / "text.txt"
    path.write_bytes("one\r\nstill one. Yes\r\n\r\ntwo\r\n\r\n".encode())
    got = [r.value for r in readers.read_paragraphs(spark, str(path)).collect()]
    assert got == ["one\r\nstill one. Yes", "two"]


def test_column_names():
    cover = schemas.expand_names(schemas.COVER_FIELDS)
    assert len(cover) == 55 and cover[10:12] == ["WA_0", "WA_1"] and cover[-2] == "ST_39"
    assert len(schemas.PARTICLE_FIELDS) == 29 and len(set(schemas.PARTICLE_FIELDS)) == 29
    assert sorted(schemas.COVER_TYPES) == [float(i) for i in range(1, 8)]


def test_csv_with_label_last_and_first(spark, tmp_path):
    path = tmp_path / "rows.csv"
    path.write_text("1, 2.5 ,3\n 4,5,6e1\n")
    last = readers.read_numeric_csv(spark, str(path), ["a", "b", "y"], "y")
    assert [tuple(r) for r in last.collect()] == [(3.0, 1.0, 2.5), (60.0, 4.0, 5.0)]
    lines = spark.read.text(str(path))
    first = readers.parse_numeric_lines(lines, ["y", "a b", "c"], "y")
    assert first.columns == ["label", "a b", "c"]
    assert [tuple(r) for r in first.collect()] == [(1.0, 2.5, 3.0), (4.0, 5.0, 60.0)]
    assert sorted(last.columns) == sorted(["label", "a", "b"])


def test_cover_and_particle_files(spark, tmp_path):
    (tmp_path / "cover").write_text("\n".join(
        ",".join(str(i + k) for i in range(54)) + f",{k + 1}" for k in range(3)))
    (tmp_path / "particles").write_text("1.0e+00," + ",".join(f"{i}.5" for i in range(28)) + "\n")
    cover = readers.read_cover_types(spark, str(tmp_path / "cover"))
    assert len(cover.columns) == 55 and [r.label for r in cover.collect()] == [1.0, 2.0, 3.0]
    assert cover.first()["ST_39"] == 53.0 and cover.first()["Elevation"] == 0.0
    row = readers.read_particles(spark, str(tmp_path / "particles")).first()
    assert row["label"] == 1.0 and row["lepton pT"] == 0.5 and row["m_wwbb"] == 27.5


def test_bad_number_is_an_error(spark, tmp_path):
    path = tmp_path / "bad.csv"
    path.write_text("1,x\n")
    with pytest.raises(Exception):
        readers.read_numeric_csv(spark, str(path), ["a", "y"], "y").collect()


def test_sampling_lines_before_parsing(spark, tmp_path):
    path = tmp_path / "many.csv"
    path.write_text("".join(f"{i % 2},{i}\n" for i in range(5000)))
    sample = bernoulli_sample(spark.read.text(str(path)), 0.1, seed=255)
    rows = readers.parse_numeric_lines(sample, ["y", "a"], "y")
    once, again = rows.count(), rows.count()
    assert once == again and 380 < once < 620


def test_nested_stations(spark):
    nested = spark.createDataFrame(
        [("s1", [("TMIN", 2000, [1.0, float("nan")]), ("TMAX", 2001, [2.0, 3.0])]), ("s2", [])],
        schemas.STATION_RECORDS)
    flat = readers.flatten_stations(nested)
    assert flat.columns == ["station", "measurement", "year", "vec"]
    assert sorted((r.station, r.measurement, r.year) for r in flat.collect()) == [
        ("s1", "TMAX", 2001), ("s1", "TMIN", 2000)]


def test_lookup_and_sinks(spark, tmp_path):
    df = spark.createDataFrame([("u1", 1, "x"), ("u2", 2, "y")], "user_id string, group_id int, z string")
    sinks.write_table(df, str(tmp_path / "t"))
    got = readers.read_lookup(spark, str(tmp_path / "t"), "user_id", "group_id")
    assert got.columns == ["user_id", "group_id"] and got.count() == 2
    sinks.write_table(df, str(tmp_path / "p"), partition_by=["z"])
    assert spark.read.parquet(str(tmp_path / "p")).where("z = 'x'").count() == 1
    assert readers.peek(df).count() == 1


def test_parser_reads_only_the_needed_fields():
    assert [f.name for f in schemas.POST.fields] == ["text", "user"]


def test_pushed_columns(spark):
    from oreline.operators.popularity import unique_users
    df = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    plan = unique_users(df)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<user_id:bigint>" in plan

import os
import random
import re
import zipfile
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from demand_engine.schemas import VERSION_DATES
from demand_engine.sources import csv_files as C
from demand_engine.sources import files, landing, stations_table, trips_table


def put(folder, name, content):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(content if isinstance(content, bytes) else content.encode())
    return path


def listed(spark, folder):
    return files.trip_files(files.list_objects(spark, str(folder)))


def root_of(spark, folder):
    return [files.qualified(spark, str(folder))]


def test_listing(spark, tmp_path):
    for name in ("b trips+1.csv", "sub/a-trips.csv", ".hidden-trips.csv", "notes.csv", "trips.txt"):
        put(tmp_path, name, "x\n1\n")
    names = [r["name"] for r in files.list_objects(spark, str(tmp_path)).orderBy("name").collect()]
    assert names == ["b trips+1.csv", "notes.csv", "sub/a-trips.csv", "trips.txt"]
    assert [r["name"] for r in listed(spark, tmp_path).collect()] == ["b trips+1.csv", "sub/a-trips.csv"]
    assert [r["name"] for r in files.list_objects(spark, str(tmp_path), "sub/").collect()] == [
        "sub/a-trips.csv"
    ]
    got = files.list_objects(spark, str(tmp_path)).where("name = 'notes.csv'").first()
    assert got["length"] == 4
    assert got["mtime"] == int(os.stat(tmp_path / "notes.csv").st_mtime)


def test_first_folder_wins(spark, tmp_path):
    put(tmp_path, "x/trips.csv", "a\n1\n")
    put(tmp_path, "y/trips.csv", "a\n22\n")
    put(tmp_path, "y/more-trips.csv", "a\n3\n")
    got = files.list_folders(spark, [str(tmp_path / "x"), str(tmp_path / "y")]).collect()
    assert {r["name"]: r["length"] for r in got} == {"trips.csv": 4, "more-trips.csv": 4}


def test_existence(spark, tmp_path):
    assert not files.exists(spark, str(tmp_path / "none"))
    assert not files.exists(spark, "")
    assert files.exists(spark, str(tmp_path))
    with pytest.raises(Exception):
        files.exists(spark, "nosuchscheme://bucket/key")


@pytest.mark.parametrize(
    ("content", "clean"),
    [
        (b"id,name\n1,foo\x00bar\n2,baz\n", b"id,name\n1,foobar\n2,baz\n"),
        (b"\x00id,\x00name\x00\n1,foo\n", b"id,name\n1,foo\n"),
        (b"col1,col2\nval1\x00\x00val2\nval3,val4\x00\n", b"col1,col2\nval1val2\nval3,val4\n"),
    ],
)
def test_nul_bytes(spark, tmp_path, content, clean):
    path = put(tmp_path, "trips.csv", content)
    header, *rows = clean.decode().splitlines()
    uri = listed(spark, tmp_path).first()["path"]
    assert C.headers(listed(spark, tmp_path)) == {header: [uri]}
    lines = C.staged_lines(spark, spark.createDataFrame([(uri, 0)], "path string, group int"))
    assert C.marks(lines) == C.Marks(frozenset(), frozenset())
    assert sorted(r["line"] for r in lines.collect()) == sorted([header, *rows])

    source, target = open(path, "rb"), open(tmp_path / "copy", "wb")
    with source, target:
        assert landing.copy_without_nul(source, target) == len(clean)
    assert (tmp_path / "copy").read_bytes() == clean


def test_header_line_inside_a_file_stays(spark, tmp_path):
    put(tmp_path, "trips.csv", "bikeid,usertype\n1,a\x00\nbikeid,usertype\nbikeid,usertype\n")
    put(tmp_path, "two-trips.csv", "bikeid,usertype\n2,b\nbikeid,usertype\n")
    got = C.read_trip_csv(listed(spark, tmp_path), root_of(spark, tmp_path))
    rows = sorted((r["source_file"], r["bike_id"], r["user_type"]) for r in got.collect())
    assert rows == [
        ("trips.csv", "1", "a"),
        ("trips.csv", "bikeid", "usertype"),
        ("trips.csv", "bikeid", "usertype"),
        ("two-trips.csv", "2", "b"),
        ("two-trips.csv", "bikeid", "usertype"),
    ]


def test_clean_and_dirty_files_parse_alike(spark, tmp_path):
    body = 'bikeid,start station name,gender\n1,"A, ""B""",\\N\n2,,1\n\n3,"",x\n'
    put(tmp_path, "clean-trips.csv", body)
    put(tmp_path, "dirty-trips.csv", body.replace('"A', '\x00"A'))
    got = C.read_trip_csv(listed(spark, tmp_path), root_of(spark, tmp_path))
    rows = {
        name: sorted(
            str((r["bike_id"], r["start_station_name"], r["gender"]))
            for r in got.where(F.col("source_file") == name).collect()
        )
        for name in ("clean-trips.csv", "dirty-trips.csv")
    }
    assert rows["clean-trips.csv"] == rows["dirty-trips.csv"]
    assert rows["clean-trips.csv"][0] == str(("1", 'A, "B"', None))
    assert len(rows["clean-trips.csv"]) == 3


def test_mixed_headers_and_types(spark, tmp_path):
    put(tmp_path, "1-trips.csv", "tripduration,starttime,postal code\n60,2015-01-01 00:05:01,02139\n")
    put(tmp_path, "2-trips.csv",
        "started_at,postal code,rideable\n2023-05-01 10:00:00.5,021XX,classic\n1/1/2023 0:05,,\n")
    got = C.read_trip_csv(listed(spark, tmp_path)).orderBy("postal_code").collect()
    assert [r["postal_code"] for r in got] == [None, "02139", "021XX"]
    assert [r["trip_duration"] for r in got] == [None, 60, None]
    assert [r["rideable"] for r in got] == [None, None, "classic"]
    assert got[0]["started_at"] is None
    assert got[2]["started_at"] == datetime(2023, 5, 1, 10, 0, 0, 500000)


def test_column_that_would_exist_twice(spark, tmp_path):
    put(tmp_path, "trips.csv", "starttime,started_at\n2015-01-01 00:05:01,x\n")
    with pytest.raises(ValueError, match="share a name"):
        C.read_trip_csv(listed(spark, tmp_path))


def archive(path, members):
    path.parent.mkdir(parents=True, exist_ok=True)
    with zipfile.ZipFile(path, "w") as z:
        for name, content in members:
            z.writestr(name, content)


def test_unpacking(spark, tmp_path):
    source, raw = tmp_path / "source", tmp_path / "raw"
    archive(source / "a.zip", [("x/1-trips.csv", b"bikeid\n1\x00\n"), ("y/1-trips.csv", "bikeid\nno\n"),
                               ("readme.txt", "no")])
    archive(source / "b.zip", [("1-trips.csv", "bikeid\nno\n"), ("2-trips.csv", "bikeid\n2\n"),
                               ("kept-trips.csv", "bikeid\nno\n")])
    put(raw, "kept-trips.csv", "bikeid\nkept\n")
    written = landing.unpack(spark, str(source), str(raw))
    assert {r["file"]: r["bytes"] for r in written.collect()} == {"1-trips.csv": 9, "2-trips.csv": 9}
    assert (raw / "1-trips.csv").read_bytes() == b"bikeid\n1\n"
    assert sorted(p.name for p in raw.iterdir()) == ["1-trips.csv", "2-trips.csv", "kept-trips.csv"]
    ids = sorted(r["bike_id"] for r in C.read_trip_csv(listed(spark, raw)).collect())
    assert ids == ["1", "2", "kept"]
    assert landing.unpack(spark, str(source), str(raw)).count() == 0


def trip_csv(*ids):
    return "bikeid,usertype\n" + "".join(f"{i},member\n" for i in ids)


def ids_in(spark, table):
    return sorted(r["bike_id"] for r in trips_table.read_trips(spark, table).collect())


def touch(path, seconds):
    stat = os.stat(path)
    os.utime(path, (stat.st_atime, stat.st_mtime + seconds))


def test_incremental_updates(spark, tmp_path):
    raw, table = tmp_path / "raw", str(tmp_path / "table")
    put(raw, "keep.txt", "")
    assert trips_table.update_trips(spark, [str(raw)], table)["loaded"] == []

    put(raw, "1-trips.csv", trip_csv(1, 2))
    put(raw, "2 trips+x.csv", trip_csv(3))
    assert trips_table.update_trips(spark, [str(raw)], table)["loaded"] == ["1-trips.csv", "2 trips+x.csv"]
    assert ids_in(spark, table) == ["1", "2", "3"]
    assert trips_table.update_trips(spark, [str(raw)], table)["loaded"] == []

    put(raw, "3-trips.csv", "bikeid,ride_type\n4,classic\n")
    (raw / "1-trips.csv").unlink()
    done = trips_table.update_trips(spark, [str(raw)], table)
    assert done == {"loaded": ["3-trips.csv"], "dropped": []}
    assert ids_in(spark, table) == ["1", "2", "3", "4"]  # rows of a removed file stay
    assert trips_table.read_trips(spark, table).where("ride_type = 'classic'").count() == 1

    changed = put(raw, "2 trips+x.csv", trip_csv(30, 31))
    touch(changed, 5)
    done = trips_table.update_trips(spark, [str(raw)], table)
    assert done == {"loaded": ["2 trips+x.csv"], "dropped": ["1-trips.csv"]}
    assert ids_in(spark, table) == ["30", "31", "4"]  # a rebuild holds present files only

    emptied = put(raw, "2 trips+x.csv", trip_csv())
    touch(emptied, 10)
    assert trips_table.update_trips(spark, [str(raw)], table)["dropped"] == ["2 trips+x.csv"]
    assert ids_in(spark, table) == ["4"]


def test_a_run_without_manifest_loads_nothing_twice(spark, tmp_path):
    raw, table = tmp_path / "raw", str(tmp_path / "table")
    put(raw, "1-trips.csv", trip_csv(1, 2))
    trips_table.update_trips(spark, [str(raw)], table)
    files.remove(spark, f"{table}/manifest")
    assert trips_table.update_trips(spark, [str(raw)], table)["loaded"] == ["1-trips.csv"]
    assert ids_in(spark, table) == ["1", "2"]


def test_classification(spark):
    listing = spark.createDataFrame(
        [("new.csv", 5), ("same.csv", 5), ("later.csv", 6)], "name string, mtime bigint"
    )
    manifest = spark.createDataFrame(
        [("same.csv", 5), ("later.csv", 5), ("gone.csv", 5)], "name string, mtime bigint"
    )
    got = trips_table.classify(listing, manifest)
    assert {r["name"]: r["status"] for r in got.collect()} == {
        "new.csv": "new", "same.csv": "unchanged", "later.csv": "changed",
    }
    assert tuple(trips_table.needs_rebuild(got).first()) == (2, True)
    assert tuple(trips_table.needs_rebuild(got.where("status = 'unchanged'")).first()) == (0, False)


def test_station_lists(spark, tmp_path):
    put(tmp_path, "City_Stations_2011_2016.csv",
        "Station,Station ID,Latitude,Longitude,Municipality,# of Docks\nA St,S1,42.1,-71.1,Boston,15\n")
    put(tmp_path, "previous_City_Stations_as_of_July_2017.csv",
        "Number,Name,Latitude,Longitude,District,Public,Total docks\nS2,B St,42.2,-71.2,Cambridge,Yes,17\n")
    put(tmp_path, "City_Stations_as_of_July_2017.csv",
        "Number,Name,Latitude,Longitude,District,Public,Total docks\nS3,C St,\\N,-71.3,Boston,Yes,19\n")
    names = ["City_Stations_2011_2016.csv", "previous_City_Stations_as_of_July_2017.csv", "City_Stations_as_of_July_2017.csv"]
    path = stations_table.update_stations(spark, [str(tmp_path)], str(tmp_path / "table"), stations_table.exact_files(names))
    rows = stations_table.read_stations(spark, path).orderBy("station_version").collect()
    assert [r["station_version"] for r in rows] == [0, 1, 2]
    assert [r["station_name"] for r in rows] == ["A St", "B St", "C St"]
    assert [r["total_docks"] for r in rows] == [15, 17, 19]
    assert [r["public"] for r in rows] == [None, "Yes", "Yes"]
    assert rows[2]["lat"] is None
    assert [r["effective_from"] for r in rows] == list(VERSION_DATES.values())


def test_a_missing_station_list_is_an_error(spark, tmp_path):
    put(tmp_path, "other.csv", "Name\nA\n")
    lists = {0: "*_Stations.csv"}
    with pytest.raises(ValueError, match="no files"):
        stations_table.read_snapshots(files.list_objects(spark, str(tmp_path)), lists)


def test_exact_names_of_station_lists(spark, tmp_path):
    names = ["one.csv", "two.csv", "three.csv"]
    for number, name in enumerate([*names, "other two.csv"]):
        put(tmp_path, name, f"Name,Total docks\nS{number},{number}\n")
    rows = stations_table.read_snapshots(files.list_objects(spark, str(tmp_path)), stations_table.exact_files(names)).collect()
    assert sorted((r["station_version"], r["station_name"]) for r in rows) == [(0, "S0"), (1, "S1"), (2, "S2")]
    with pytest.raises(ValueError, match="3 station files"):
        stations_table.exact_files(["a.csv"])


def test_line_breaks_in_quotes(spark, tmp_path):
    body = 'bikeid,start station name\n1,"Two\nLines"\n2,plain\n3,"a ""b"",\n\nc"\n'
    put(tmp_path, "trips/stations.csv", "Number,Name\n1,x\n")  # a folder's name makes no trips
    put(tmp_path, "1-trips.csv", body)
    put(tmp_path, "2-trips.csv", body.replace("Two", "T\x00wo").replace('"a', '\x00"a'))
    put(tmp_path, "3-trips.csv", "bikeid,start station name\n9,plain\n")
    got = C.read_trip_csv(listed(spark, tmp_path), root_of(spark, tmp_path)).collect()
    own = [("1", "Two\nLines"), ("2", "plain"), ("3", 'a "b",\n\nc')]
    assert sorted((r["source_file"], r["bike_id"], r["start_station_name"]) for r in got) == [
        *(("1-trips.csv", *r) for r in own), *(("2-trips.csv", *r) for r in own), ("3-trips.csv", "9", "plain")
    ]


def test_registered_rebuild_loads_changed_files_again(spark, small, monkeypatch):
    from demand_engine.queries import ingest

    done = []

    def update(*given):
        done.append(trips_table.update_trips(*given))
        return done[-1]

    monkeypatch.setattr(ingest, "update_trips", update)
    ingest.changed_file_rebuild(spark, small)
    first, second = (d["loaded"] for d in done)
    assert second and second == [n for n in first if n.startswith("old/")] and second != first


def random_csv(rng, rows):
    """Text and its records: values with quotes, commas and line breaks, some quotes inside plain values."""
    records, lines = [], []
    for k in range(rows):
        values, cells = [str(k)], [str(k)]
        for _ in range(2):
            value = "".join(rng.choice(['"', ",", "\n", "\r\n", "ab", "c d", '""', "é"]) for _ in range(rng.randint(0, 6)))
            if rng.random() < 0.5:
                value = rng.choice(["5\" pipe", "plain", "a\"b\"c", "x"])
                cells.append(value)
            else:
                cells.append('"' + value.replace('"', '""') + '"')
            values.append(value)
        records.append(tuple(values))
        lines.append(",".join(cells))
        if rng.random() < 0.1:
            lines.append("")
    return "bikeid,start station name,usertype\n" + "\n".join(lines) + "\n", records


@pytest.mark.parametrize("split", [100, 1000, 1 << 27])
def test_records_across_lines_and_splits(spark, tmp_path, monkeypatch, split):
    """Large files are split wherever it may be, inside quotes too, and records go over any number of splits."""
    rng, wanted = random.Random(split), []
    for number in range(3):
        text, records = random_csv(rng, 120)
        long = ("x" * 30 + '"",\n') * 40
        text += f'long,"{long}",y\n' + "last,a,b"
        records += [("long", long.replace('""', '"'), "y"), ("last", "a", "b")]
        put(tmp_path, f"{number}-trips.csv", text)
        wanted += [(f"{number}-trips.csv", *r) for r in records]
    stage, splits = C.staged_lines, []

    def staged(spark, listing):
        before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        spark.conf.set("spark.sql.files.openCostInBytes", 1)
        try:
            lines = stage(spark, listing)
            splits.append(lines.select("source_path", "block").distinct().count())
            return lines
        finally:
            for k, v in before.items():
                spark.conf.set(k, v)

    monkeypatch.setattr(C, "staged_lines", staged)
    got = C.read_trip_csv(listed(spark, tmp_path), root_of(spark, tmp_path))
    rows = [(r["source_file"], r["bike_id"], r["start_station_name"], r["user_type"]) for r in got.collect()]
    assert sorted(map(str, rows)) == sorted(map(str, wanted))
    assert splits[0] > 3


def test_each_file_is_read_once(spark, tmp_path):
    """Beside the first line: files and scratch are told apart by the paths that plans read."""
    put(tmp_path, "1-trips.csv", "bikeid,usertype\n" + "1,a\n" * 50)
    put(tmp_path, "2-trips.csv", 'bikeid,usertype\n2,"a\nb"\n')
    scans = []
    read = type(spark.read).text

    def text(self, paths, *more, **named):
        scans.append(list(paths))
        return read(self, paths, *more, **named)

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(type(spark.read), "text", text)
        got = C.read_trip_csv(listed(spark, tmp_path))
        assert got.count() == 51
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert len(scans) == 1 and len(scans[0]) == 2
    assert set(re.findall(r"Relation ?\[[^]]*\] (\w+)", plan)) == {"parquet"}


def test_line_ends(spark, tmp_path):
    put(tmp_path, "crlf-trips.csv", 'bikeid,usertype\r\n1,a\r\n2,"b\r\nc"\r\n3,\r\n')
    put(tmp_path, "cr-trips.csv", "bikeid,usertype\r4,d\r5,e\r")
    put(tmp_path, "bom-trips.csv", "\ufeffbikeid,usertype\n6,f\n\n7,g")
    put(tmp_path, "empty-trips.csv", "bikeid,usertype\n")
    got = C.read_trip_csv(listed(spark, tmp_path), root_of(spark, tmp_path)).collect()
    assert sorted((r["bike_id"], r["user_type"]) for r in got if r["source_file"] != "empty-trips.csv") == [
        ("1", "a"), ("2", "b\r\nc"), ("3", None), ("4", "d"), ("5", "e"), ("6", "f"), ("7", "g")
    ]
    assert len(got) == 7


def test_as_many_jobs_for_one_changed_file_as_for_fifty(spark, tmp_path):
    raw, table, counts = tmp_path / "raw", str(tmp_path / "table"), []
    paths = [put(raw, f"{k:02d}-trips.csv", trip_csv(k)) for k in range(50)]
    trips_table.update_trips(spark, [str(raw)], table)
    for round_, changed in enumerate((paths[:1], paths)):
        for path in changed:
            touch(path, 10 * (round_ + 1))
        spark.sparkContext.setJobGroup(f"update {round_}", "")
        done = trips_table.update_trips(spark, [str(raw)], table)
        counts.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"update {round_}")))
        assert len(done["loaded"]) == len(changed) and done["dropped"] == []
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert abs(counts[0] - counts[1]) <= 1
    assert len(ids_in(spark, table)) == 50

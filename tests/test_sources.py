import datetime as dt
import gzip
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nightshare.operators import quality as qa
from nightshare.plans import silver
from nightshare.sources import readers as rd
from nightshare.sources import writers as wr
from nightshare.streaming import ingest as st


def write(path, text, encoding="utf-8"):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text.encode(encoding))
    return str(path)


HEAD = "id,name,price,license,minimum_nights,neighbourhood_cleansed,has_availability,host_is_superhost,room_type"


def listings_file(folder, name, head, rows):
    folder.mkdir(parents=True, exist_ok=True)
    path = folder / name
    with gzip.open(path, "wt", encoding="utf-8") as f:
        f.write(head + "\n" + "\n".join(rows) + "\n")
    return str(path)


def test_listings_with_line_breaks_and_drift(spark, tmp_path):
    a = listings_file(
        tmp_path, "a.csv.gz", HEAD,
        ['1,"Flat ""Sea""\nview","$1,200.00",Exempt - hotel,2,Zarautz,t,f,Entire home/apt', '2,Plain,"$9,999.00",,30,Donostia-San SebastiÃ¡n,f,,Private room'],
    )
    # Another capture: columns in another order, one missing, one new.
    b = listings_file(tmp_path, "b.csv.gz", "price,id,neighbourhood_cleansed,extra,has_availability", [',3,Getxo,"x\ny",'])
    raw = rd.read_listings(spark, [a, b])
    assert raw.count() == 3 and "name" not in raw.columns
    got = {r["id"]: r for r in silver.silver_listings(raw).collect()}
    assert got[1]["price_num"] == 1200.0 and got[1]["licence_status"] == "exempt" and got[1]["exempt_type"] == "hotel"
    assert got[1]["has_availability"] is True and got[1]["host_is_superhost"] is False and got[1]["is_long_stay"] is False
    assert got[2]["price_outlier"] is True and got[2]["is_long_stay"] is True and got[2]["neighbourhood_cleansed"] == "Donostia-San Sebastián"
    assert got[2]["licence_status"] == "none" and got[2]["host_is_superhost"] is None
    assert got[3]["price_missing"] is True and got[3]["price_num"] is None and got[3]["is_long_stay"] is False
    assert "license" not in silver.silver_listings(raw).columns
    # 39 declared columns, less the licence, and six derived ones.
    assert len(silver.silver_listings(raw).columns) == 39 - 1 + 6


def test_listing_checks(spark, tmp_path):
    a = listings_file(tmp_path, "a.csv.gz", "id,latitude,longitude,availability_30,availability_365", ["1,43.2,-2.9,5,3", "2,41.4,2.2,1,9", ",43.0,-3,1,2"])
    df = silver.silver_listings(rd.read_listings(spark, a)).withColumn("city", F.when(F.col("id") == 2, "Barcelona").otherwise("Bilbao"))
    box = silver.city_box({"Bilbao": (42, 44, -4, -1), "Barcelona": (41, 42, 1, 3)}, F.col("city"), F.col("latitude"), F.col("longitude"))
    report = {r["rule"]: r["violations"] for r in qa.check_report(df, silver.listing_rules(box)).collect()}
    assert report["id"] == 1 and report["coordinates"] == 0 and report["availability_order"] == 1
    with pytest.raises(qa.BlockedByCheck):
        wr.write_checked(df, qa.check_report(df, silver.listing_rules(box)), str(tmp_path / "out"))
    assert not (tmp_path / "out").exists()


def test_calendar(spark, tmp_path):
    p = write(tmp_path / "calendar.csv", "listing_id,date,available,price,adjusted_price,minimum_nights,maximum_nights\n7,2025-09-30,t,,,2,30\n7,2025-10-01,f,,,2,30\nx,bad,,,,1,2\n")
    df = silver.silver_calendar(rd.read_calendar(spark, p))
    rows = [tuple(r) for r in df.orderBy(F.col("date").asc_nulls_last()).collect()]
    assert rows[:2] == [(7, dt.date(2025, 9, 30), True, 2, 30), (7, dt.date(2025, 10, 1), False, 2, 30)]
    report = {r["rule"]: r["violations"] for r in qa.check_report(df, silver.calendar_rules(F.lit("2025-10-01").cast("date"))).collect()}
    assert report["available"] == 1 and report["listing_id"] == 1 and report["night_not_before_capture"] == 1


def test_worklist(spark, tmp_path):
    items = [
        {"ciudad": "B", "ruta": "r", "fecha": "2025-09-29", "ruta_fichero": "data/listings.csv.gz"},
        {"ciudad": "B", "ruta": "r", "fecha": "2025-09-29", "ruta_fichero": "data/calendar.csv.gz"},
    ]
    p = write(tmp_path / "list.json", json.dumps(items))
    assert rd.read_worklist(spark, p).count() == 2
    assert rd.read_worklist(spark, p, "calendar").first()["file"] == "data/calendar.csv.gz"


def test_conform(spark):
    schema = T.StructType([T.StructField("n", T.LongType()), T.StructField("gone", T.DateType())])
    df = spark.createDataFrame([("5", "x"), ("five", "y")], "n string, other string")
    out = rd.conform(df, schema)
    assert out.schema == schema and [tuple(r) for r in out.collect()] == [(5, None), (None, None)]


def test_wide_parts(spark, tmp_path):
    a = write(tmp_path / "a.csv", '"zona","tipo","2024-01","2024-02"\n"Bilbao","Habitación","80.5",".."\n', "latin-1")
    b = write(tmp_path / "b.csv", '"zona","tipo","2024-03"\n"Bilbao","Habitación","90"\n', "latin-1")
    got = {(r["tipo"], r["period"], r["value"]) for r in rd.read_wide_series(spark, [a, b], ["zona", "tipo"]).collect()}
    assert got == {("Habitación", "2024-01", 80.5), ("Habitación", "2024-03", 90.0)}


def test_long_series_with_mark(spark, tmp_path):
    p = write(tmp_path / "l.csv", "﻿Zona;Periodo;Total\nA;2025M07;1.234,5\nB;2025M08;\nC;2025M09;..\n")
    df = rd.read_long_series(spark, p, "Total", "Periodo")
    assert {tuple(r) for r in df.collect()} == {("A", "2025-07", 1234.5), ("B", "2025-08", None), ("C", "2025-09", None)}


def test_registry(spark, tmp_path):
    rows = [{"Nregistro": "1", "Provincia": "1", "Municipio": "59", "Fecha": "03/02/2024", "Email": "a@b.eu"}, {"Nregistro": "2", "Provincia": "48", "Municipio": "20"}]
    p = write(tmp_path / "r.json", json.dumps(rows))
    df = rd.read_registry(spark, p, ["Nregistro", "Provincia", "Municipio", "Fecha", "Email"], ["Fecha"], "Provincia", "Municipio", private=["Email"])
    assert "Email" not in df.columns
    assert {(r["Nregistro"], r["Fecha"], r["municipality_code"]) for r in df.collect()} == {("1", dt.date(2024, 2, 3), "01059"), ("2", None, "48020")}


def test_landed_files_and_manifest(spark, tmp_path):
    write(tmp_path / "bronze/bilbao/2025-09-29/listings.csv", "id,name\n1,a\n2,b\n")
    write(tmp_path / "bronze/bilbao/2025-10-29/listings.csv", "id,name,extra\n1,a,z\n")
    root = str(tmp_path / "bronze")
    landed = rd.list_landed(spark, root)
    assert {(r["city"], str(r["date"]), r["file"]) for r in landed.collect()} == {("bilbao", "2025-09-29", "listings.csv"), ("bilbao", "2025-10-29", "listings.csv")}
    m = {r["path"].split("/")[-2]: r for r in rd.file_manifest(spark, root).collect()}
    import hashlib

    assert m["2025-09-29"]["rows"] == 2 and m["2025-09-29"]["header"] == "id,name" and m["2025-09-29"]["bytes"] == 16
    assert m["2025-09-29"]["sha256"] == hashlib.sha256(b"id,name\n1,a\n2,b\n").hexdigest()
    expected = spark.createDataFrame([("bilbao", "2025-09-29", "listings.csv"), ("bilbao", "2025-11-29", "listings.csv")], "city string, d string, file string")
    expected = expected.select("city", F.to_date("d").alias("date"), "file")
    status = {(str(r["date"]), r["status"]) for r in qa.reconcile_sets(expected, landed, ["city", "date", "file"]).collect()}
    assert status == {("2025-11-29", "missing"), ("2025-10-29", "surplus")}
    paths = [str(p) for p in sorted((tmp_path / "bronze").rglob("*.csv"))]
    drift = {r["column"]: (r["files"], r["in_all"]) for r in rd.schema_drift(rd.header_columns(spark, paths)).collect()}
    assert drift == {"id": (2, True), "name": (2, True), "extra": (1, False)}


def test_matches(spark, tmp_path):
    p = write(tmp_path / "m.csv", "﻿Div,Date,Time,HomeTeam,AwayTeam\nX,17/08/2025,18:30,Red,Blue\nX,03/08/2025,20:00,Green,Red\nX,10/08/2025,20:00,Other,Red\n")
    out = rd.read_matches(spark, p, {"Red": ("A", "Red Club"), "Green": ("B", "Green Club")}).collect()
    assert [(str(r["date"]), r["city"], r["home_team"], r["rival"]) for r in out] == [("2025-08-03", "B", "Green Club", "Red"), ("2025-08-17", "A", "Red Club", "Blue")]


def test_stat_api(spark, tmp_path):
    series = [{"Nombre": "Z. Total. Grado de ocupación por fin de semana", "Data": [{"Anyo": 2025, "FK_Periodo": 7, "Valor": 80.5}, {"Anyo": 2025, "FK_Periodo": 8, "Valor": None}]}, {"Nombre": "other", "Data": [{"Anyo": 2025, "FK_Periodo": 7, "Valor": 1.0}]}]
    p = write(tmp_path / "s.json", json.dumps(series, ensure_ascii=False))
    out = rd.read_stat_api_json(spark, p, {"fin de semana": "weekend", "ocupación": "occupancy"}).collect()
    assert [(r["measure"], r["period"], r["value"]) for r in out] == [("weekend", "2025-07", 80.5)]


def test_partition_reload_leaves_others(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [("A", "2025-01-01", 1), ("A", "2025-02-01", 2), ("B", "2025-01-01", 3)]
    df = spark.createDataFrame(rows, "city string, snapshot_date string, n int")
    for _ in range(2):
        wr.write_partition(df, path)
    assert spark.read.parquet(path).count() == 3
    wr.write_partition(spark.createDataFrame([("A", "2025-02-01", 9)], df.schema), path)
    assert sorted(r["n"] for r in spark.read.parquet(path).collect()) == [1, 3, 9]


def test_large_partition_is_split_when_written(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "200k")
    try:
        df = spark.range(200000).select("id", F.md5(F.col("id").cast("string")).alias("x"), F.lit("hot").alias("snapshot_id"))
        wr.write_fact(df, path)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(list((tmp_path / "t" / "snapshot_id=hot").glob("*.parquet"))) > 1
    assert spark.read.parquet(path).count() == 200000


def test_stream_archive_over_split_captures(spark, tmp_path):
    landing, root = str(tmp_path / "landing"), str(tmp_path / "root")
    schema = "id int, name string, captured date"

    def land(rows):
        spark.createDataFrame([(i, n, dt.date.fromisoformat(d)) for i, n, d in rows], schema).coalesce(1).write.mode("append").parquet(landing)

    def run():
        source = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(landing)
        st.archive_changes(source, root, str(tmp_path / "cp"), "id", ["name"]).awaitTermination()

    land([(1, "a", "2025-01-01"), (2, "b", "2025-01-01")])
    run()
    run()
    land([(1, "a2", "2025-02-01")])
    land([(3, "c", "2025-02-01")])
    run()
    got = {r["id"]: (r["name"], str(r["first_seen"]), str(r["last_seen"]), r["captures"]) for r in st.read_archive(spark, root).collect()}
    assert got == {
        1: ("a2", "2025-01-01", "2025-02-01", 2),
        2: ("b", "2025-01-01", "2025-01-01", 1),
        3: ("c", "2025-02-01", "2025-02-01", 1),
    }
    log = [(r["id"], r["field"], r["before"], r["after"]) for r in st.read_changes(spark, root).collect()]
    assert log == [(1, "name", "a", "a2")]


@pytest.mark.parametrize("runs", [[[0], [1], [2]], [[0, 1, 2]], [[0, 1], [2]]])
def test_archive_does_not_depend_on_batches(spark, tmp_path, runs):
    landing, root, schema = str(tmp_path / "landing"), str(tmp_path / "root"), "id int, name string, captured date"
    photos = [[(1, "a", "2025-01-01"), (2, "b", "2025-01-01")], [(1, "a2", "2025-02-01")], [(1, "a3", "2025-03-01"), (3, "c", "2025-03-01")]]
    for n, run in enumerate(runs):
        for i in run:
            spark.createDataFrame([(k, x, dt.date.fromisoformat(d)) for k, x, d in photos[i]], schema).coalesce(1).write.mode("append").parquet(landing)
        st.archive_changes(spark.readStream.schema(schema).parquet(landing), root, str(tmp_path / "cp"), "id", ["name"]).awaitTermination()
    got = {r["id"]: (r["name"], str(r["first_seen"]), str(r["last_seen"]), r["captures"]) for r in st.read_archive(spark, root).collect()}
    assert got == {1: ("a3", "2025-01-01", "2025-03-01", 3), 2: ("b", "2025-01-01", "2025-01-01", 1), 3: ("c", "2025-03-01", "2025-03-01", 1)}
    log = sorted((str(r["captured"]), r["id"], r["before"], r["after"]) for r in st.read_changes(spark, root).collect())
    assert log == [("2025-02-01", 1, "a", "a2"), ("2025-03-01", 1, "a2", "a3")]


def test_archive_with_a_fresh_checkpoint_goes_on(spark, tmp_path):
    root, schema = str(tmp_path / "root"), "id int, name string, captured date"
    for n, row in enumerate([(1, "a", "2025-01-01"), (2, "b", "2025-02-01")]):
        landing = str(tmp_path / f"landing{n}")
        spark.createDataFrame([(row[0], row[1], dt.date.fromisoformat(row[2]))], schema).write.parquet(landing)
        st.archive_changes(spark.readStream.schema(schema).parquet(landing), root, str(tmp_path / f"cp{n}"), "id", ["name"]).awaitTermination()
    assert sorted(r["id"] for r in st.read_archive(spark, root).collect()) == [1, 2]


def test_late_file_adds_to_its_capture(spark, tmp_path):
    landing, target, schema = str(tmp_path / "landing"), str(tmp_path / "t"), "city string, snapshot_date string, n int"
    for n in (1, 2):
        spark.createDataFrame([("A", "2025-01-01", n)], schema).coalesce(1).write.mode("append").parquet(landing)
        for _ in range(2):
            st.ingest_snapshots(spark.readStream.schema(schema).parquet(landing), lambda b: b, target, str(tmp_path / "cp")).awaitTermination()
    assert sorted(r["n"] for r in spark.read.parquet(target).collect()) == [1, 2]


def test_corrected_file_replaces_the_one_it_supersedes(spark, tmp_path):
    landing, target, schema = tmp_path / "landing", str(tmp_path / "t"), "city string, snapshot_date string, n int"

    def land(*files):
        landing.mkdir(exist_ok=True)
        for name, ns in files:
            (landing / name).write_text("".join(f"A,2025-01-01,{n}\n" for n in ns))
        for _ in range(2):
            st.ingest_snapshots(spark.readStream.schema(schema).csv(str(landing)), lambda b: b, target, str(tmp_path / "cp")).awaitTermination()
        return sorted(r["n"] for r in spark.read.parquet(target).collect())

    assert land(("a.csv", [1, 2])) == [1, 2]
    assert land(("a-v2.csv", [3]), ("b.csv", [9])) == [3, 9]
    assert land(("a-v4.csv", [5]), ("a-v3.csv", [4])) == [5, 9]
    assert land(("a-v1.csv", [7]), ("c_v2.csv", [8])) == [5, 8, 9]


def test_log_run(spark, tmp_path):
    path = str(tmp_path / "log")
    for n in (1, 2):
        st.log_run(spark, path, kind="weekly", rows=n)
    assert sorted(r["rows"] for r in spark.read.parquet(path).collect()) == [1, 2]

"""Queries that write tables derived from the given ones to the shared folder and read them back."""

from __future__ import annotations

from pyspark.sql import functions as F

from nightshare import views as v
from nightshare.catalog.analyses import captures
from nightshare.registry import query
from nightshare.session import shared_dir
from nightshare.sources import readers as rd
from nightshare.sources import writers as wr
from nightshare.streaming import ingest as st

col = F.col


@query("src01_read_listings", "SELECT CAST(doc_id AS VARCHAR) AS id, md5(text) AS text_md5, lang AS room_type FROM documents")
def _(s, d):
    """Texts with quoted line breaks and doubled quotes come back unchanged from gzipped CSV."""
    path = shared_dir(s, "src01")
    rows = v.docs(s, d).select(col("doc_id").alias("id"), col("text").alias("license"), col("lang").alias("room_type"))
    (
        rows.write.option("header", True).option("escape", '"').option("quoteAll", True).option("compression", "gzip")
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    )
    return rd.read_listings(s, path).select("id", F.md5("license").alias("text_md5"), "room_type")


@query(
    "src02_read_calendar",
    """SELECT CAST(listing_id AS VARCHAR) AS listing_id, CAST(night AS VARCHAR) AS date, CASE WHEN taken = 1 THEN 'f' ELSE 't' END AS available, CAST(lead AS VARCHAR) AS minimum_nights FROM nights""",
)
def _(s, d):
    """Older files with the two empty price columns and newer ones without them, read together."""
    path = shared_dir(s, "src02")
    n = v.nights(s, d).select(
        "city", "listing_id", col("night").alias("date"), F.when(col("taken") == 1, "f").otherwise("t").alias("available"),
        F.lit("").alias("price"), F.lit("").alias("adjusted_price"), col("lead").alias("minimum_nights"), F.lit(1125).alias("maximum_nights"),
    )
    wr.write_csv(n.where("city = 0").drop("city"), f"{path}/old")
    wr.write_csv(n.where("city <> 0").select("date", "listing_id", "available", "minimum_nights", "maximum_nights"), f"{path}/new")
    return rd.read_calendar(s, path).select("listing_id", "date", "available", "minimum_nights")


def json_arrays(s, rows, path, files=16):
    """The rows as JSON arrays in ``files`` files, dealt by the hash of the row; the last element of each array is null."""
    bucket = F.pmod(F.xxhash64(*rows.columns), F.lit(files))
    lines = rows.select(bucket.alias("bucket"), F.lit(1).alias("turn"), F.concat(F.to_json(F.struct(*rows.columns)), F.lit(",")).alias("value"))
    edges = s.range(files).select(col("id").alias("bucket"), F.explode(F.array(F.struct(F.lit(0).alias("turn"), F.lit("[").alias("value")), F.struct(F.lit(2).alias("turn"), F.lit("null]").alias("value")))).alias("e"))
    both = lines.unionByName(edges.select("bucket", "e.turn", "e.value"))
    both.repartition("bucket").sortWithinPartitions("bucket", "turn").drop("turn").write.partitionBy("bucket").text(path)


@query(
    "src03_read_worklist",
    "SELECT o_orderstatus AS city, 'r' || o_custkey AS route, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS date, 'data/' || o_orderkey || '/calendar.csv.gz' AS file FROM orders WHERE o_orderkey % 3 = 0",
)
def _(s, d):
    path = shared_dir(s, "src03")
    kind = F.when(col("o_orderkey") % 3 == 0, "calendar").otherwise("listings")
    rows = v.table(s, d, "orders").select(
        col("o_orderstatus").alias("ciudad"), F.concat(F.lit("r"), "o_custkey").alias("ruta"), F.to_date("o_orderdate").cast("string").alias("fecha"),
        F.concat(F.lit("data/"), "o_orderkey", F.lit("/"), kind, F.lit(".csv.gz")).alias("ruta_fichero"),
    )
    json_arrays(s, rows, path)
    return rd.read_worklist(s, path, "calendar")


@query(
    "src07_read_registry",
    """SELECT CAST(doc_id AS VARCHAR) AS "Nregistro", md5(text) AS text_md5, CAST(DATE '2020-01-01' + CAST(doc_id % 900 AS INT) AS DATE) AS registered, lpad(CAST(doc_id % 53 AS VARCHAR), 2, '0') || lpad(CAST(doc_id % 997 AS VARCHAR), 3, '0') AS municipality_code FROM documents""",
)
def _(s, d):
    """Texts with quotes, brackets and backslashes inside; contact fields stay behind."""
    path = shared_dir(s, "src07")
    rows = v.docs(s, d).select(
        col("doc_id").cast("string").alias("Nregistro"), col("text").alias("Nombre"), F.date_format(F.date_add(F.lit("2020-01-01").cast("date"), (col("doc_id") % 900).cast("int")), "dd/MM/yyyy").alias("registered"),
        (col("doc_id") % 53).cast("string").alias("Provincia"), (col("doc_id") % 997).cast("string").alias("Municipio"), F.lit("x@y.eu").alias("Email"),
    )
    json_arrays(s, rows, path)
    out = rd.read_registry(s, path, ["Nregistro", "Nombre", "registered", "Provincia", "Municipio", "Email"], ["registered"], "Provincia", "Municipio", private=["Email"])
    return out.select("Nregistro", F.md5("Nombre").alias("text_md5"), "registered", "municipality_code")


@query(
    "src04_conform",
    "SELECT id, TRY_CAST(replace(replace(price_text, '$', ''), ',', '') AS DOUBLE) AS price, TRY_CAST(name AS DATE) AS name, CAST(NULL AS DOUBLE) AS beds FROM parts",
)
def _(s, d):
    from pyspark.sql import types as T

    schema = T.StructType(
        [T.StructField("id", T.LongType()), T.StructField("price", T.DoubleType()), T.StructField("name", T.DateType()), T.StructField("beds", T.DoubleType())]
    )
    raw = v.parts(s, d).select(col("id").cast("string").alias("id"), F.regexp_replace("price_text", "[$,]", "").alias("price"), "name", "zone")
    return rd.conform(raw, schema)


@query("src05_wide_series", "SELECT city, period, round(adr, 6) AS value FROM monthly WHERE n > 1")
def _(s, d):
    m = v.monthly(s, d)
    periods = [f"{y}-{i:02d}" for y in range(1995, 2002) for i in range(1, 13)]
    # Cells of a single order stand for missing figures and are written as dots, like the official files do.
    cell = F.when(col("n") > 1, col("adr").cast("string")).otherwise("..")
    half = len(periods) // 2
    out = None
    for part in (periods[:half], periods[half:]):
        wide = m.where(col("period").isin(*part)).groupBy("city").pivot("period", part).agg(F.max(cell))
        long = rd.wide_to_long(wide, ["city"])
        out = long if out is None else out.unionByName(long)
    return out.select("city", "period", F.round("value", 6).alias("value"))


@query("src05_wide_files", "SELECT city, period, round(adr, 6) AS value FROM monthly WHERE n > 1")
def _(s, d):
    """Wide files, each with period columns of its own, read together."""
    path = shared_dir(s, "src05")
    m = v.monthly(s, d)
    cell = F.when(col("n") > 1, col("adr").cast("string")).otherwise("..")
    for first in (1995, 1999):
        part = [f"{y}-{i:02d}" for y in range(first, min(first + 4, 2002)) for i in range(1, 13)]
        wide = m.where(col("period").isin(*part)).groupBy("city").pivot("period", part).agg(F.max(cell))
        wide.write.option("header", True).option("encoding", "ISO-8859-1").csv(f"{path}/{first}")
    return rd.read_wide_series(s, path, ["city"]).select("city", "period", F.round("value", 6).alias("value"))


@query("src06_read_long_series", "SELECT CAST(o_orderkey AS VARCHAR) AS level, strftime(o_orderdate, '%Y-%m') AS period, o_totalprice AS value FROM orders")
def _(s, d):
    path = shared_dir(s, "src06")
    european = F.translate(F.format_number("o_totalprice", 2), ",.", ".,")
    month = F.concat(F.year("o_orderdate").cast("string"), F.lit("M"), F.date_format("o_orderdate", "MM"))
    text = v.table(s, d, "orders").select(col("o_orderkey").alias("level"), month.alias("period"), european.alias("value"))
    text.write.option("header", True).option("sep", ";").csv(path)
    return rd.read_long_series(s, path, "value", "period")


def landed(s, d, name):
    """The nights of each city as text files below <city>/<date>, the way raw files land."""
    root = shared_dir(s, name)
    n = v.nights(s, d).select("listing_id", "night", "lead", "taken", "city")
    for city in (0, 1, 2):
        wr.write_csv(n.where(col("city") == city), f"{root}/city{city}/2024-01-31")
    return root


@query("src08_list_landed", "SELECT DISTINCT 'city' || city AS city, DATE '2024-01-31' AS date FROM nights")
def _(s, d):
    files = rd.list_landed(s, landed(s, d, "src08"))
    return files.where(col("file").startswith("part-")).select("city", "date").distinct()


@query("src09_file_manifest", "SELECT 'city' || city AS city, 'listing_id,night,lead,taken,city' AS header, count(*) AS rows FROM nights GROUP BY city")
def _(s, d):
    m = rd.file_manifest(s, landed(s, d, "src09")).where(F.length("sha256") == 64)
    city = F.regexp_extract("path", r"/(city\d)/", 1).alias("city")
    return m.where("rows > 0").groupBy(city, "header").agg(F.sum("rows").alias("rows"))


@query(
    "src10_read_matches",
    """SELECT CAST(o_orderdate AS DATE) AS date, CASE o_orderpriority WHEN '1-URGENT' THEN 'A' ELSE 'B' END AS city, CASE o_orderpriority WHEN '1-URGENT' THEN 'Urgent Club' ELSE 'Low United' END AS home_team,
    CAST(o_orderkey AS VARCHAR) AS rival FROM orders WHERE o_orderpriority IN ('1-URGENT', '5-LOW')""",
)
def _(s, d):
    path = shared_dir(s, "src10")
    o = v.table(s, d, "orders")
    wr.write_csv(
        o.select(
            F.date_format("o_orderdate", "dd/MM/yyyy").alias("Date"), F.lit("20:00").alias("Time"), col("o_orderpriority").alias("HomeTeam"), col("o_orderkey").alias("AwayTeam")
        ),
        path,
    )
    teams = {"1-URGENT": ("A", "Urgent Club"), "5-LOW": ("B", "Low United")}
    return rd.read_matches(s, path, teams).select("date", "city", "home_team", "rival")


@query(
    "src11_series_rows",
    """SELECT city || ' occupancy' AS name, 'occupancy' AS measure, period, round(occ, 6) AS value FROM monthly WHERE n > 1
    UNION ALL SELECT city || ' price', 'price', period, round(adr, 6) FROM monthly""",
)
def _(s, d):
    m = v.monthly(s, d)

    def nested(label, value):
        point = F.struct(col("year").alias("Anyo"), col("month").alias("FK_Periodo"), value.alias("Valor"))
        # A point per series object: the shape of the interface without gathering a series.
        return m.select(F.concat(col("city"), F.lit(label)).alias("Nombre"), F.array(point).alias("Data"))

    both = nested(" occupancy", F.when(col("n") > 1, col("occ"))).unionByName(nested(" price", col("adr")))
    out = rd.series_rows(both, {"occupancy": "occupancy", "price": "price"})
    return out.select("name", "measure", "period", F.round("value", 6).alias("value"))


@query(
    "src11_stat_api_files",
    "SELECT city || ' occupancy' AS name, 'occupancy' AS measure, period, round(occ, 6) AS value FROM monthly WHERE n > 1",
)
def _(s, d):
    path = shared_dir(s, "src11")
    point = F.struct(col("year").alias("Anyo"), col("month").alias("FK_Periodo"), F.when(col("n") > 1, col("occ")).alias("Valor"))
    json_arrays(s, v.monthly(s, d).select(F.concat(col("city"), F.lit(" occupancy")).alias("Nombre"), F.array(point).alias("Data")), path)
    return rd.read_stat_api_json(s, path, {"occupancy": "occupancy"}).select("name", "measure", "period", F.round("value", 6).alias("value"))


@query(
    "qa13_schema_drift",
    """SELECT "column", CAST(files AS BIGINT) AS files, in_all FROM (VALUES ('id', 2, true), ('zone', 2, true), ('price_text', 1, false), ('name', 1, false)) t("column", files, in_all) WHERE (SELECT count(*) FROM parts) > 0""",
)
def _(s, d):
    root = shared_dir(s, "qa13")
    p = v.parts(s, d)
    wr.write_csv(p.select("id", "zone", "price_text"), f"{root}/a")
    wr.write_csv(p.select("id", "name", "zone"), f"{root}/b")
    cols = rd.header_columns(s, root).where(col("path").contains("part-"))
    # Spark writes a folder per table, so the folder stands for the file here.
    folder = F.regexp_extract("path", r"/([ab])/[^/]*$", 1)
    return rd.schema_drift(cols.withColumn("path", folder))


@query(
    "qa14_filled_share",
    """SELECT 'a' AS path, 'price' AS "column", 1.0 AS share UNION ALL SELECT 'a', 'name', round(count(n) * 1.0 / count(*), 6) FROM (SELECT CASE WHEN accommodates > 3 THEN name END AS n FROM parts)
    UNION ALL SELECT 'b', 'price', round(count(n) * 1.0 / count(*), 6) FROM (SELECT CASE WHEN accommodates > 6 THEN name END AS n FROM parts) UNION ALL SELECT 'b', 'name', 1.0""",
)
def _(s, d):
    root = shared_dir(s, "qa14")
    p = v.parts(s, d)
    wr.write_csv(p.select(col("price_text").alias("price"), F.when(col("accommodates") > 3, col("name")).alias("name")), f"{root}/a")
    wr.write_csv(p.select(F.when(col("accommodates") > 6, col("price_text")).alias("price"), "name"), f"{root}/b")
    df = rd.read_quoted_csv(s, [f"{root}/a", f"{root}/b"]).select(
        "price", "name", F.regexp_extract(F.col("_metadata.file_path"), r"/([ab])/[^/]*$", 1).alias("path")
    )
    return rd.filled_share(df, ["price", "name"])


@query(
    "snk01_write_partition",
    """SELECT city, snapshot, count(*) AS n, CAST(sum(taken) AS BIGINT) AS taken FROM (SELECT city, CAST(date_trunc('month', snapshot) AS DATE) AS snapshot, CASE WHEN city = 1 THEN 0 ELSE taken END AS taken FROM nights) GROUP BY ALL""",
)
def _(s, d):
    """The whole table once, then one city again with other values: only its partitions change, twice is like once."""
    path = shared_dir(s, "snk01")
    n = v.nights(s, d).withColumn("snapshot", F.to_date(F.trunc("snapshot", "month"))).select("listing_id", "night", "lead", "taken", "city", "snapshot")
    wr.write_partition(n, path, ["city", "snapshot"])
    again = n.where("city = 1").withColumn("taken", F.lit(0))
    for _i in range(2):
        wr.write_partition(again, path, ["city", "snapshot"])
    back = s.read.schema(n.schema).parquet(path)
    return back.groupBy("city", "snapshot").agg(F.count("*").alias("n"), F.sum("taken").alias("taken"))


@query("snk02_write_dim", "SELECT DISTINCT zone, grp FROM listing_snap")
def _(s, d):
    path = shared_dir(s, "snk02")
    zones = v.listing_snap(s, d).select("zone", "grp").distinct()
    wr.write_dim(zones.select("zone"), path)
    wr.write_dim(zones, path)
    return s.read.parquet(path)


@query(
    "snk03_write_fact",
    "SELECT city || '_' || strftime(snapshot_date, '%Y%m%d') AS snapshot_id, listing_id, night, lead, taken FROM fact_calendar",
)
def _(s, d):
    from nightshare.functions.cleaning import snapshot_key

    path = shared_dir(s, "snk03")
    f = v.fact_calendar(s, d).select(snapshot_key(col("city"), col("snapshot_date")).alias("snapshot_id"), "listing_id", "night", "lead", "taken")
    wr.write_fact(f, path)
    return s.read.schema(f.schema).parquet(path)


@query(
    "snk04_write_nested_json",
    """SELECT '{"' || city || '":{' || string_agg('"' || period || '":' || n, ',' ORDER BY period) || '}}' AS value FROM monthly GROUP BY city""",
)
def _(s, d):
    path = shared_dir(s, "snk04")
    wr.write_nested_json(v.monthly(s, d), path, "city", "period", "n")
    return s.read.text(path)


@query("snk05_append_log", "SELECT 'run' AS kind, count(*) AS n FROM nights UNION ALL SELECT 'run', count(*) FROM nights WHERE taken = 1")
def _(s, d):
    path = shared_dir(s, "snk05")
    n = v.nights(s, d)
    for part in (n, n.where("taken = 1")):
        wr.append_log(part.agg(F.lit("run").alias("kind"), F.count("*").alias("n")), path)
    return s.read.parquet(path)


@query("snk06_write_csv", "SELECT zone, count(*) AS n, max(list_price) AS top FROM parts GROUP BY zone")
def _(s, d):
    path = shared_dir(s, "snk06")
    wr.write_csv(v.parts(s, d).groupBy("zone").agg(F.count("*").alias("n"), F.max("list_price").alias("top")), path)
    return s.read.schema("zone string, n bigint, top double").option("header", True).csv(path)


@query(
    "str01_ingest_snapshots",
    """SELECT city, snapshot_date, count(*) AS n, CAST(sum(taken) AS BIGINT) AS taken FROM (SELECT user_id % 3 AS city, CAST(ts AS DATE) AS snapshot_date, CASE WHEN event_type IN ('purchase', 'signup') THEN 1 ELSE 0 END AS taken FROM events) GROUP BY ALL""",
)
def _(s, d):
    """A stream over the events, run to its end twice: the second run finds nothing new and changes nothing."""
    root = shared_dir(s, "str01")
    schema = v.table(s, d, "events").schema

    def clean(batch):
        return batch.select(
            "landed", "event_id", col("event_type").isin("purchase", "signup").cast("int").alias("taken"), (col("user_id") % 3).alias("city"), F.to_date("ts").alias("snapshot_date")
        )

    for _i in range(2):
        source = s.readStream.schema(schema).parquet(f"{d}/events.parquet*")
        st.ingest_snapshots(source, clean, f"{root}/table", f"{root}/checkpoint").awaitTermination()
    back = s.read.schema("event_id bigint, taken int, city bigint, snapshot_date date").parquet(f"{root}/table")
    return back.groupBy("city", "snapshot_date").agg(F.count("*").alias("n"), F.sum("taken").alias("taken"))


LANDED_SQL = """WITH o AS (SELECT o_orderkey AS id, o_orderstatus AS status, o_orderdate AS day, o_totalprice > 400000 AS dear FROM orders),
    steps AS (SELECT id, DATE '2025-01-01' AS d, status FROM o WHERE day < TIMESTAMP '2001-01-01' UNION ALL SELECT id, DATE '2025-02-01', CASE WHEN dear THEN 'X' ELSE status END FROM o WHERE day >= TIMESTAMP '1996-01-01'
      UNION ALL SELECT id, DATE '2025-01-15', CASE WHEN dear THEN 'W' ELSE status END FROM o WHERE day < TIMESTAMP '1998-01-01') """


def _landed_captures(s, d):
    """Three captures: two in turn, landed twice, and one of a day between them that lands last."""
    a, b = captures(s, d)
    o = v.table(s, d, "orders").select(col("o_orderkey").alias("id"), F.when(col("o_totalprice") > 400000, "W").otherwise(col("o_orderstatus")).alias("status"), col("o_orderdate").alias("day"))
    return ("2025-01-01", a), ("2025-02-01", b), ("2025-01-15", o.where(col("day") < F.lit("1998-01-01").cast("timestamp")))


@query(
    "str02_archive_stream",
    LANDED_SQL + "SELECT id, arg_max(status, d) AS status, min(d) AS first_seen, max(d) AS last_seen, count(*) AS captures FROM steps GROUP BY id",
)
def _(s, d):
    """Captures land in turn, again, from a new checkpoint, and late; each day counts once."""
    root = shared_dir(s, "str02")
    first, second, between = _landed_captures(s, d)
    _archive_of(s, root, [[first, second], [second]])
    _archive_of(s, root, [[first], [between]], "again")
    return st.read_archive(s, root)


def _archive_of(s, root, runs, name="first"):
    """Run the archive job once for each list of captures that landed together, under a checkpoint of that name."""
    for landed in runs:
        for when, rows in landed:
            rows.select("id", "status", F.lit(when).cast("date").alias("captured")).write.mode("append").parquet(f"{root}/landing-{name}")
        source = s.readStream.schema("id bigint, status string, captured date").parquet(f"{root}/landing-{name}")
        st.archive_changes(source, root, f"{root}/checkpoint-{name}", "id", ["status"]).awaitTermination()


@query(
    "str02_archive_change_log",
    LANDED_SQL
    + """SELECT id, captured, 'status' AS field, before, status AS after FROM
    (SELECT id, d AS captured, status, lag(status) OVER (PARTITION BY id ORDER BY d) AS before FROM steps) WHERE before IS NOT NULL AND before <> status""",
)
def _(s, d):
    """The log holds the steps over the late capture, not the one that it broke up."""
    root = shared_dir(s, "str02-log")
    first, second, between = _landed_captures(s, d)
    _archive_of(s, root, [[second, first], [between]])
    return st.read_changes(s, root)

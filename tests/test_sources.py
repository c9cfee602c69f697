import gzip

from pyspark.sql import functions as F

from webgrain.plans import jobs
from webgrain.plans.scale import fresh_path
from webgrain.sources import readers as R
from webgrain.sources import records as A
from webgrain.sources import sinks as K


def test_csv_missing_cells(spark, tmp_path):
    (tmp_path / "c.csv").write_text('id,name,n\n1,"a, ""b""",5\n2,NA,null\n3,,7\nNaN,"two\nlines",n/a\n')
    rows = R.read_csv(spark, str(tmp_path / "c.csv"), "id int, name string, n int", line_breaks=True).collect()
    assert [tuple(r) for r in rows] == [
        (1, 'a, "b"', 5), (2, None, None), (3, None, 7), (None, "two\nlines", None)]


def test_capture_scan_prunes_snapshots(spark):
    path = fresh_path(spark, "captures")
    df = spark.createDataFrame(
        [("http://example.org/a", "2023-14"), ("http://example.org/b", "1999-01"), ("http://x.com", "2023-14")],
        "url string, crawl string")
    df.write.partitionBy("crawl").parquet(path)
    found = R.scan_captures(spark, path, "http://example.org/")
    assert [r["url"] for r in found.collect()] == ["http://example.org/a"]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [crawl" in plan and "StringStartsWith(url,http://example.org/)" in plan


def record(html):
    return gzip.compress(f"WARC/1.0\r\n\r\nHTTP/1.1 200\r\n\r\n{html}".encode())


def test_records(spark):
    junk = b"xx"
    rows = [
        ("ok", junk + record("<p>é</p>") + junk, "2", str(len(record("<p>é</p>")))),
        ("two parts", gzip.compress(b"a\r\n\r\nb"), "0", "999"),
        ("bad text", gzip.compress(b"\xff\xfe"), "0", "999"),
        ("damaged", b"not gzip", "0", "8"),
        ("none", None, "0", "1"),
    ]
    df = spark.createDataFrame(rows, "urlkey string, payload binary, offset string, length string")
    got = R.read_bodies(df, offset="offset", length="length")
    assert {r["urlkey"]: r["html"] for r in got.collect()} == {
        "ok": "<p>é</p>", "two parts": "", "bad text": "", "damaged": "", "none": ""}


def test_decoded_records_are_handed_back_in_pieces(spark):
    values = [b"x" * n for n in (10, 0, 95, 7)] + [None, b"y" * 300, b"z"]
    pieces = [p.to_pylist() for p in R.in_pieces(iter(values), "binary", 100)]
    assert [len(p) for p in pieces] == [3, 3, 1] and [v for p in pieces for v in p] == values
    rows = [(k, gzip.compress(bytes([65 + k]) * 400_000)) for k in range(9)] + [(9, None), (10, b"no")]
    got = {r.k: (r.n, r.c) for r in R.decode_records(spark.createDataFrame(rows, "k int, payload binary").coalesce(1)).selectExpr(
        "k", "length(data) n", "left(data, 1) c").collect()}  # many pieces of one batch keep their rows
    assert got == {k: (400_000, chr(65 + k)) for k in range(9)} | {9: (0, ""), 10: (0, "")}


def test_places_that_no_payload_holds_give_empty_rows(spark):
    import gzip

    member = gzip.compress(b"a\r\n\r\nb\r\n\r\nbody")
    rows = [(member, "0", str(len(member))), (member, str(1 << 31), "10"), (member, str(1 << 40), "10"), (member, "x", "1"), (member, "-1", "5")]
    df = spark.createDataFrame(rows, "payload binary, offset string, length string").coalesce(1)
    assert [r.html for r in R.read_bodies(df, offset="offset", length="length").collect()] == ["body", "", "", "", ""]
    files = spark.createDataFrame([("f", bytearray(member))], "file string, payload binary")
    wanted = spark.createDataFrame([("f", i, o, n) for i, (_, o, n) in enumerate(rows)], "file string, i int, offset string, length string")
    cut = {r.i: r.payload for r in R.cut_ranges(wanted, files, "file").collect()}
    assert cut == {0: bytearray(member), 1: None, 2: None, 3: None, 4: None}


def test_listing(spark, tmp_path):
    assert R.list_files(spark, str(tmp_path / "missing")).count() == 0
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "f.txt").write_text("12345")
    (row,) = R.list_files(spark, str(tmp_path)).collect()
    assert row["path"].endswith("sub/f.txt") and row["length"] == 5 and row["mtime"] is not None


def test_snapshots_take_the_first_free_number(spark, tmp_path):
    base = str(tmp_path / "snap")
    df = spark.range(2)
    assert [K.write_snapshot(df, base) for _ in range(3)] == [f"{base}_{n}" for n in (1, 2, 3)]
    (tmp_path / "other_1").mkdir()
    assert K.next_snapshot(spark, str(tmp_path / "other")).endswith("other_2")
    files = spark.createDataFrame([("/x/data_1.zip",), ("/x/data_1.txt",), ("/data_/b.zip",)], "path string")
    assert K.exclude_snapshots(files, "data").count() == 2


def test_append_creates_then_adds(spark):
    path = fresh_path(spark, "append")
    for _ in range(2):
        K.append_table(spark.range(3), path)
    assert spark.read.parquet(path).count() == 6


def test_items_round_trip(spark):
    path = fresh_path(spark, "items")
    items = spark.createDataFrame([("u", None, "b\nc")], K.ITEM_SCHEMA)
    K.write_items(items, path)
    assert K.read_items(spark, path).collect() == items.collect()


def test_capture_job_cuts_many_records_from_one_file(spark, tmp_path):
    html = "<title>T</title><p> one <script>x</script>\n\n two</p>"
    old, new, other = record("<p>old"), record(html), record("<title>O</title>")
    file = old + new + other
    captures = spark.createDataFrame(
        [("k1", "2", "http://a.com/", "200", "f", len(old), len(new)), ("k1", "1", "http://a.com/", "200", "f", 0, len(old)),
         ("k2", "1", "http://a.com/x", "200", "f", len(old) + len(new), len(other)),
         ("k3", "1", "http://a.com/y", "200", "f", 0, len(old)), ("k3", "2", "http://a.com/y", "404", "f", 0, len(old)),
         ("k4", "1", "http://a.com/z", "200", "missing", 0, 9)],
        "urlkey string, timestamp string, url string, status string, filename string, offset long, length long"
    ).withColumns({"mime": F.lit("text/html"), "languages": F.lit("eng"), "encoding": F.lit("UTF-8")})
    files = spark.createDataFrame([("f", file), ("unused", b"x")], "filename string, payload binary")
    got = {r["urlkey"]: (r["html_parsed"], r["url_metadata"]) for r in jobs.capture_pages(captures, files, "filename").collect()}
    assert got == {"k1": ("T one\ntwo", "Home Page of the company | T"), "k2": ("O", "O")}
    (tmp_path / "f").write_bytes(file)
    from_folder = jobs.capture_pages(captures, str(tmp_path)).collect()
    assert {r["urlkey"]: (r["html_parsed"], r["url_metadata"]) for r in from_folder} == got | {"k4": ("", None)}


def test_records_beyond_two_gigabytes(spark, tmp_path):
    """A sparse file with records at its start, beyond 2^31 and at its end; ranges that are none are null."""
    far, member = (1 << 31) + 5, record("<p>far</p>")
    with open(tmp_path / "big", "wb") as f:
        f.write(b"first")
        f.seek(far)
        f.write(member)
        f.seek(3 << 30)
        f.write(b"last")
    (tmp_path / "small").write_bytes(b"0123456789")
    size = len(member)
    rows = [(0, "big", "0", "5"), (1, "big", str(far), str(size)), (2, "big", str(3 << 30), "4"), (3, "big", str(3 << 30), "5"),
            (4, "big", "-1", "3"), (5, "big", "x", "3"), (6, "big", None, "3"), (7, "absent", "0", "1"), (8, None, "0", "1"),
            (9, "small", "2", "3"), (10, "small", "3", "0"), (11, "small", "2", "3"), (12, "small", "0", "10"), (13, "small", "1", "-4")]
    wanted = spark.createDataFrame(rows, "i int, filename string, offset string, length string")
    got = {r.i: r.payload and bytes(r.payload) for r in A.fetch_records(wanted, str(tmp_path), rows_per_task=2).collect()}
    assert got == {0: b"first", 1: member, 2: b"last", 3: None, 4: None, 5: None, 6: None, 7: None, 8: None,
                   9: b"234", 10: b"", 11: b"234", 12: b"0123456789", 13: None}
    far_page = A.fetch_records(wanted.filter("i = 1"), f"file://{tmp_path}")
    assert R.read_bodies(far_page).first()["html"] == "<p>far</p>"
    assert A.fetch_records(wanted.limit(0), str(tmp_path)).count() == 0


def test_records_written_and_read_by_filters(spark, tmp_path):
    rows = [(i, f"http://h{i % 5}.org/{i}", f"2023-{i % 3}", f"f{i // 40}", None if i == 17 else bytes([i]) * i) for i in range(200)]
    df = spark.createDataFrame(rows, "i int, url string, crawl string, part string, payload binary").repartition(6)
    index = A.write_records(df, str(tmp_path / "files"), "part", "i")
    assert sorted(p.name for p in (tmp_path / "files").iterdir()) == [f"f{k}" for k in range(5)]
    assert (tmp_path / "files" / "f0").read_bytes() == b"".join(r[4] or b"" for r in rows[:40])
    path = str(tmp_path / "index")
    index.write.partitionBy("crawl").parquet(path)
    found = A.read_records(spark, path, str(tmp_path / "files"), rows_per_task=7)
    assert {r.i: bytes(r.payload) for r in found.collect()} == {r[0]: r[4] or b"" for r in rows}
    some = found.filter("crawl in ('2023-1', '2023-2') and url like 'http://h3.org/%' and i > 20 and length(payload) % 2 = 0")
    assert {r.i for r in some.collect()} == {i for i in range(21, 200) if i % 3 and i % 5 == 3 and i % 2 == 0}
    schema = found.schema
    asked = [A.D.EqualTo(("crawl",), "2023-1"), A.D.StringStartsWith(("url",), "http://h3.org/"), A.D.StringContains(("url",), "x"),
             A.D.IsNotNull(("payload",))]
    reader = A._Reader({"index": path, "root": str(tmp_path / "files")}, schema)
    assert list(reader.pushFilters(asked)) == asked[2:]
    assert {r.path.split("crawl=")[1].split("/")[0] for r in reader.partitions()} == {"2023-1"}


def test_split_extract_aggregate_writes_partitions(spark):
    out = fresh_path(spark, "agg")
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "k string, v int")
    got = jobs.split_extract_aggregate(
        df, lambda d: d.withColumn("v", F.col("v") * 10), ["k"], [F.sum("v").alias("s")], out, ["k"])
    assert {r["k"]: r["s"] for r in got.collect()} == {"a": 30, "b": 30}

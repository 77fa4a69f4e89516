import pytest
from pyspark.sql import functions as F

from voltmesh.functions import codes, geo, lists, text, times
from voltmesh.operators import notices, regions
from voltmesh.sources import feeds


@pytest.mark.parametrize(
    "bcode,level,prefix",
    [
        ("1100000000", 1, "11"),
        ("1234000000", 2, "1234"),
        ("1234500000", 2, "12345"),
        ("1234567800", 2, "12345678"),
        ("1234500000", 3, "12345"),
        ("1234567800", 3, "12345678"),
        ("1234567890", 3, "1234567890"),
        ("1234567890", 4, None),
    ],
)
def test_region_prefix(spark, bcode, level, prefix):
    row = spark.createDataFrame([(bcode, level)], "b string, l int")
    assert row.select(codes.region_prefix(F.col("b"), F.col("l"))).first()[0] == prefix


def test_region_counts(spark):
    table = spark.createDataFrame(
        [("1100000000", "a", 1), ("1110100000", "a b", 2), ("1110101200", "a b c", 3), ("9900000000", "z", 7)],
        "bcode string, arr string, level int",
    )
    chargers = spark.createDataFrame(
        [(2, "1110101201"), (2, "1110101300"), (2, "1199900000"), (3, "1110101201"), (2, "0"), (2, None)],
        "stat int, addcd string",
    )
    rows = regions.available_by_region(table, chargers).collect()
    assert {r["bcode"]: r["num"] for r in rows} == {
        "1100000000": 3, "1110100000": 2, "1110101200": 1, "9900000000": 0,
    }


def test_region_rows_of_district_file(spark, tmp_path):
    lines = "1100000000\t서울\t존재\n1111000000\t서울 종로\t폐지\n1111010100\t서울 종로 청운 동\t존재\n"
    (tmp_path / "d.txt").write_text(lines, "cp949")
    spark.conf.set("spark.sql.legacy.javaCharsets", "true")
    try:
        read = feeds.read_districts(spark, str(tmp_path / "d.txt"), "MS949")
        rows = regions.region_rows(read).orderBy("bcode").collect()
    finally:
        spark.conf.unset("spark.sql.legacy.javaCharsets")
    assert [tuple(r) for r in rows] == [
        ("1100000000", "서울", 1, "서울"), ("1111010100", "서울 종로 청운 동", 3, "동"),
    ]


def test_shifts(spark):
    ranks = spark.range(10)
    rows = ranks.select(geo.lat_shift(F.col("id")), geo.lng_shift(F.col("id"))).collect()
    d = 0.0001
    eight = [(d, 0), (-d, 0), (0, d), (0, -d), (d, d), (-d, -d), (d, -d), (-d, d)]
    assert [tuple(r) for r in rows] == eight + [eight[7]] * 2


def test_lookback_and_pages(spark):
    row = spark.range(1).select(
        times.lookback_minutes(F.lit(1000.0), F.lit(700.0)),
        times.lookback_minutes(F.lit(1059.0), F.lit(1000.0)),
        times.lookback_minutes(F.lit(900.0), F.lit(1000.0)),
        times.page_count(F.lit(75000)),
        times.page_count(F.lit(9999)),
    ).first()
    assert tuple(row) == (7, 2, 1, 8, 2)


def test_rebuild_window(spark):
    rows = spark.createDataFrame(
        [("2024-01-01 18:00:00",), ("2024-01-01 18:20:00",), ("2024-01-01 17:05:00",)], "t string"
    ).select(times.in_rebuild_window(F.col("t").cast("timestamp_ntz")))
    assert [r[0] for r in rows.collect()] == [True, False, False]


def test_list_text(spark):
    table = spark.createDataFrame(
        [("",), ('[["a \\"q\\"", "M1"], ["b", "M3333"]]',)], "t string"
    ).withColumn("rows", lists.parse_list(F.col("t"), lists.ROWS))
    ids = lists.row_ids(F.col("rows"), 1)
    out = table.select(
        lists.dump_rows(F.col("rows")).alias("text"),
        lists.index_of(ids, F.lit("M333")).alias("near"),
        lists.index_of(ids, F.lit("M3333")).alias("exact"),
    ).collect()
    assert out[0]["text"] == "[]"
    assert out[1]["text"] == '[["a \\"q\\"", "M1"], ["b", "M3333"]]'
    assert [r["near"] for r in out] == [-1, -1]
    assert [r["exact"] for r in out] == [-1, 1]


def test_drop_first(spark):
    row = spark.range(1).select(
        lists.drop_first(F.array(F.lit("a"), F.lit("b"), F.lit("a")), F.lit("a")),
        lists.drop_first(F.array(F.lit("a")), F.lit("x")),
    ).first()
    assert (row[0], row[1]) == (["b", "a"], ["a"])


@pytest.mark.parametrize(
    "start,kind",
    [
        (b"\x89PNG\r\n\x1a\n", "png"), (b"GIF87a", "gif"), (b"\xff\xd8\xff\xdb", "jpeg"),
        (b"\xff\xd8\xff\xe0\x00\x10JFIF", "jpeg"), (b"II*\x00", "tiff"), (b"BM", "bmp"),
        (b"RIFF\x00\x00\x00\x00WEBP", "webp"), (b"P6\n", "ppm"), (b"P4 ", "pbm"), (b"P2\t", "pgm"),
        (b"#define x", "xbm"), (b"none", None),
    ],
)
def test_image_type(spark, start, kind):
    row = spark.createDataFrame([(bytearray(start + b"....."),)], "b binary")
    assert row.select(text.image_type(F.col("b"))).first()[0] == kind


def test_fixed_company_names(spark):
    companies = spark.createDataFrame([("ME", "x"), ("ZZ", "own")], "busiid string, businm string")
    names = {r["busiid"]: r["businm"] for r in regions.fixed_names(companies).collect()}
    assert names == {"ME": "환경부", "ZZ": "own"}


def test_attachments_of_unknown_type_have_no_name(spark):
    report = spark.createDataFrame(
        [(1, "aGVsbG8=", "aGVsbG8=", "aGVsbG8=", 2)],
        "id int, first string, second string, third string, dist int",
    )
    rows = notices.decode_attachments(report, "id").collect()
    assert [(r["idx"], bytes(r["image"]), r["filename"]) for r in rows] == [
        (1, b"hello", None), (2, b"hello", None),
    ]

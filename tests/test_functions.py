import datetime as dt
from decimal import Decimal


from strata.functions import cleaning as c


def rows(df, *cols):
    return [tuple(r) for r in df.select(*cols).collect()]


def test_map_codes_normalises_and_defaults(spark):
    df = spark.createDataFrame([(" s ",), ("M",), ("m ",), ("",), (None,), ("X",)], "v string")
    got = [r[0] for r in df.select(c.map_codes("v", c.MARITAL_STATUS, c.NOT_SPECIFIED)).collect()]
    assert got == ["Single", "Married", "Married", "Not Specified", "Not Specified", "Not Specified"]


def test_split_product_key(spark):
    df = spark.createDataFrame([("CO-RF-FR-R92B-58",), ("AB-C",), ("CO-RF-",), (None,)], "k string")
    cat, key = c.split_product_key("k")
    assert rows(df.select(cat.alias("a"), key.alias("b")), "a", "b") == [
        ("CO_RF", "FR-R92B-58"), ("AB_C", ""), ("CO_RF", ""), (None, None)]


def test_repair_sales_three_valued_logic(spark):
    df = spark.createDataFrame(
        [(100, 2, 50), (90, 2, 50), (-5, 2, 50), (None, 2, 50), (100, 2, None), (-1, 2, None), (10, 2, -5)],
        "s int, q int, p int")
    got = [r[0] for r in df.select(c.repair_sales("s", "q", "p")).collect()]
    assert got == [Decimal("100.00"), Decimal("100.00"), Decimal("100.00"), Decimal("100.00"),
                   Decimal("100.00"), None, Decimal("10.00")]


def test_repair_price_uses_original_sales_and_rounds_half_up(spark):
    df = spark.createDataFrame(
        [(11681, 40, None), (10, 0, None), (7, 2, -3), (None, 3, 0), (-7, 4, None), (9, 3, 4)],
        "s int, q int, p int")
    got = [r[0] for r in df.select(c.repair_price("s", "q", "p")).collect()]
    # 11681/40 = 292.025 -> 292.03 (a double division gives 292.02)
    assert got == [Decimal("292.03"), None, Decimal("3.50"), None, Decimal("-1.75"), Decimal("4.00")]


def test_standardise_country(spark):
    df = spark.createDataFrame([("DE",), (" US ",), ("USA",), ("",), (None,), (" Australia",), ("de",), ("  ",)],
                               "v string")
    got = [r[0] for r in df.select(c.standardise_country("v")).collect()]
    assert got == ["Germany", "United States", "United States", "n/a", "n/a", "Australia", "de", "n/a"]


def test_strip_key_and_prefix(spark):
    df = spark.createDataFrame([("AW-00011000",), ("NASAW00011000",), ("NAS",), ("ANAS1",)], "v string")
    assert [r[0] for r in df.select(c.strip_chars("v", "-")).collect()] == [
        "AW00011000", "NASAW00011000", "NAS", "ANAS1"]
    assert [r[0] for r in df.select(c.strip_prefix("v", "NAS")).collect()] == [
        "AW-00011000", "AW00011000", "", "ANAS1"]


def test_null_if_future(spark):
    df = spark.createDataFrame([(dt.date(2025, 12, 31),), (dt.date(2026, 1, 1),), (dt.date(2026, 1, 2),), (None,)],
                               "d date")
    got = [r[0] for r in df.select(c.null_if_future("d", "2026-01-01")).collect()]
    assert got == [dt.date(2025, 12, 31), dt.date(2026, 1, 1), None, None]


def test_prefer_null_primary_falls_through(spark):
    df = spark.createDataFrame([("Male", "Female"), ("n/a", "Female"), ("n/a", None), (None, "Male"),
                                ("Not Specified", "Female")], "p string, f string")
    got = [r[0] for r in df.select(c.prefer("p", "f")).collect()]
    assert got == ["Male", "Female", "n/a", "Male", "Not Specified"]
    fixed = [r[0] for r in df.select(c.prefer("p", "f", "Not Specified")).collect()]
    assert fixed[-1] == "Female"


def test_parse_dates(spark):
    df = spark.createDataFrame([("20240131",), ("0",), ("5489",), ("2024-02-29",), ("20230229",), (None,)],
                               "v string")
    got = [r[0] for r in df.select(c.parse_yyyymmdd("v")).collect()]
    assert got == [dt.date(2024, 1, 31), None, None, dt.date(2024, 2, 29), None, None]
    dmy = spark.createDataFrame([("1/2/1990",), ("31/12/1999",), ("31/2/1990",), ("",), ("05/06/2001",)], "v string")
    assert [r[0] for r in dmy.select(c.parse_dmy("v")).collect()] == [
        dt.date(1990, 2, 1), dt.date(1999, 12, 31), None, None, dt.date(2001, 6, 5)]


def test_int_dates_by_arithmetic_match_text_parsing(spark):
    vals = [20200101, 0, None, 5489, 20230229, 20240229, 19991231, 20001301, 20000100, 99991231, 10000101,
            20200431, 20200430]
    df = spark.createDataFrame([(v,) for v in vals], "v int")
    got = [tuple(r) for r in df.select(c.int_yyyymmdd_to_date("v"), c.parse_yyyymmdd("v")).collect()]
    assert [a for a, _ in got] == [b for _, b in got]
    assert got[0][0] == dt.date(2020, 1, 1) and got[5][0] == dt.date(2024, 2, 29)
    # text parsing turns these into dates before year 1; the arithmetic form rejects them
    odd = spark.createDataFrame([(-20200101,), (123,)], "v int")
    assert [r[0] for r in odd.select(c.int_yyyymmdd_to_date("v")).collect()] == [None, None]


def test_iso_date_to_int(spark):
    df = spark.createDataFrame([("2011-01-05",), ("20110105",), ("",)], "v string")
    assert [r[0] for r in df.select(c.iso_date_to_yyyymmdd("v")).collect()] == [20110105, None, None]

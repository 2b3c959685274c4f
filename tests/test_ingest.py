import datetime as dt
import glob
import os

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from strata.session import scratch_path
from strata.sources import csv_ingest


def _write(folder, rel, text):
    path = os.path.join(folder.replace("file:", ""), rel)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", newline="") as f:
        f.write(text)


def test_crlf_quotes_short_rows_and_nulls(spark, tmp_folder):
    _write(tmp_folder, "source_crm/cust_info.csv",
           "id,key,first,last,marital,gender,created\r\n"
           '11000,AW00011000," Jon, Jr ",Yang,M,M,2025-10-06\r\n'
           "11001,AW00011001,Eugene,Huang,S,,\r\n"
           "\\N,AW00011002,Ruben,Torres,M,\\N,2025-10-06\r\n"
           "oops,AW00011003,Short\r\n")
    df = csv_ingest.read_bronze(spark, tmp_folder, "crm_cust_info")
    got = [tuple(r) for r in df.orderBy("cst_key").collect()]
    assert got == [
        (11000, "AW00011000", " Jon, Jr ", "Yang", "M", "M", dt.date(2025, 10, 6)),
        (11001, "AW00011001", "Eugene", "Huang", "S", "", None),          # empty text stays '', empty date NULL
        (None, "AW00011002", "Ruben", "Torres", "M", None, dt.date(2025, 10, 6)),  # \N is NULL
        (None, "AW00011003", "Short", None, None, None, None),             # short row: missing = NULL
    ]
    raw = csv_ingest.read_source_csv(spark, tmp_folder + "/source_crm/cust_info.csv",
                                     csv_ingest.SOURCES["crm_cust_info"][1])
    fails = {r.column_name: r.failures for r in csv_ingest.conversion_failures("crm_cust_info", raw).collect()}
    assert fails == {"cst_id": 1, "cst_create_date": 0}
    observed, obs = csv_ingest.read_bronze_observed(spark, tmp_folder, "crm_cust_info")
    assert sorted(map(str, observed.collect())) == sorted(map(str, df.collect()))
    assert obs.get["failed_values"] == 1                      # counted in the same pass
    assert obs.get["malformed_rows"] == 1


def test_quotes_line_feeds_escapes_and_ragged_rows(spark, tmp_folder):
    _write(tmp_folder, "source_erp/PX_CAT_G1V2.csv",
           'ID,CAT,SUBCAT,MAINTENANCE\r\n'
           'A,"q""x, y","a ""b"" c",Yes\r\n'
           'B,"line\nfeed",back\\\\slash\\tTab,\\N\r\n'
           'C,long,x,,surplus\r\n'
           'D,"sh,ort"\r\n'
           'E,,"",No\r\n')
    df, obs = csv_ingest.read_bronze_observed(spark, tmp_folder, "erp_px_cat_g1v2")
    assert sorted(tuple(r) for r in df.collect()) == [
        ("A", 'q"x, y', 'a "b" c', "Yes"), ("B", "line\nfeed", "back\\slash\tTab", None), ("C", "long", "x", ""),
        ("D", "sh,ort", None, None), ("E", "", "", "No")]
    assert obs.get["malformed_rows"] == 2
    one = csv_ingest.read_bronze(spark, tmp_folder, "erp_px_cat_g1v2").select("subcat").where("subcat is null")
    assert one.count() == 1                                   # also when the plan reads one column only
    _write(tmp_folder, "source_erp/LOC_A101.csv", "CID,CNTRY\nAW-1,DE\n")
    assert [tuple(r) for r in csv_ingest.read_bronze(spark, tmp_folder, "erp_loc_a101", "\n").collect()] == [("AW-1", "DE")]


def test_dmy_birthdates_and_int_dates(spark, tmp_folder):
    _write(tmp_folder, "source_erp/CUST_AZ12.csv",
           "CID,BDATE,GEN\r\n NASAW00011000,6/10/1971,Male\r\nAW00011001,31/2/1990,F\r\nAW00011002,,\r\n")
    df = csv_ingest.read_bronze(spark, tmp_folder, "erp_cust_az12")
    got = sorted(tuple(r) for r in df.collect())
    assert got == [(" NASAW00011000", dt.date(1971, 10, 6), "Male"), ("AW00011001", None, "F"),
                   ("AW00011002", None, "")]
    _write(tmp_folder, "source_crm/sales_details.csv",
           "a,b,c,d,e,f,g,h,i\r\nSO1,BK-R93R-62,21768,20101229,20110105,20110110,3578,1,3578\r\n"
           "SO2,BK-R93R-62,21768,,2011-01-05,20110110,,1,\r\n")
    s = csv_ingest.read_bronze(spark, tmp_folder, "crm_sales_details").orderBy("sls_ord_num").collect()
    assert tuple(s[0]) == ("SO1", "BK-R93R-62", 21768, 20101229, 20110105, 20110110, 3578, 1, 3578)
    assert s[1].sls_order_dt is None and s[1].sls_sales is None and s[1].sls_price is None
    assert s[1].sls_ship_dt == 20110105                      # ISO date accepted as yyyymmdd


def test_extract_roundtrip_keeps_padding_empty_and_null(spark, tmp_folder):
    rows = [(1, "AW1", "  padded ", "x", "", None, dt.date(2020, 1, 2)), (None, "AW2", 'q"uote', "a,b", "M", "F", None)]
    df = spark.createDataFrame(rows, csv_ingest.bronze_schema("crm_cust_info"))
    csv_ingest.write_source_csv(df, tmp_folder, "crm_cust_info")
    back = csv_ingest.read_bronze(spark, tmp_folder, "crm_cust_info")
    assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))

_TEXT = st.one_of(st.none(), st.text(st.sampled_from(list('ab ,"\\\'x\t;|') + ["é", "中"]), max_size=8))


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=st.lists(st.tuples(_TEXT, _TEXT), min_size=1, max_size=6))
def test_extract_roundtrip_property(spark, rows):
    """Quotes, commas, backslashes, padding, '' and NULL all survive write -> load."""
    df = spark.createDataFrame(rows, csv_ingest.bronze_schema("erp_loc_a101"))
    folder = scratch_path(spark, "prop")
    csv_ingest.write_source_csv(df, folder, "erp_loc_a101")
    back = csv_ingest.read_bronze(spark, folder, "erp_loc_a101")
    assert sorted(map(repr, back.collect())) == sorted(map(repr, df.collect()))


def test_row_ends_inside_quotes_escapes_and_null_words(spark, tmp_folder):
    _write(tmp_folder, "source_erp/PX_CAT_G1V2.csv",
           '"ID\r\nnumber",CAT,SUBCAT,MAINTENANCE\r\n'
           'A,"x\r\ny","a\\"b",NULL\r\n'
           'B,"NULL",\\N,"\r\n\r\n"\r\n'
           'C,5" pipe,"a "b" c","end\\\\"\r\n'
           'D,\\\\,"",""""\r\n'
           'E,"open\r\nto the end')
    raw = csv_ingest.read_source_csv(spark, tmp_folder + "/source_erp/PX_CAT_G1V2.csv", ["a", "b", "c", "d"])
    assert sorted(tuple(r) for r in raw.collect()) == [
        ("A", "x\r\ny", 'a"b', None, None), ("B", "NULL", None, "\r\n\r\n", None), ("C", '5" pipe', 'a "b" c', "end\\", None),
        ("D", "\\", "", '"', None), ("E", "open\r\nto the end", None, None, 'E,"open\r\nto the end')]


def _brute_rows(text):
    """Rows of a CSV text read character by character."""
    rows, start, state, i = [], 0, "start", 0
    while i < len(text):
        c = text[i]
        if state != "quoted" and text.startswith("\r\n", i):
            rows.append(text[start:i])
            start, state, i = i + 2, "start", i + 2
            continue
        if c == "\\" and i + 1 < len(text) and not text.startswith("\r\n", i + 1):
            i, state = i + 2, "quoted" if state in ("quoted", "seen") else "plain"
            continue
        if state == "start":
            state = "quoted" if c == '"' else "start" if c == "," else "plain"
        elif state == "plain":
            state = "start" if c == "," else "plain"
        elif state == "quoted":
            state = "seen" if c == '"' else "quoted"
        else:
            state = "start" if c == "," else "quoted"
        i += 1
    # a quote that never closes: the row lasts to the end, without the last row end
    return rows + [text[start:].removesuffix("\r\n")] if start < len(text) else rows


_FIELDS = st.one_of(st.text(st.sampled_from(list('ab"\\ ')), max_size=5),
                    st.lists(st.sampled_from(["a", ",", "\r\n", '""', '\\"', "\\\\", "bcdefgh"]), max_size=6).map(
                        lambda t: '"' + "".join(t) + '"'))


@settings(max_examples=25, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(_FIELDS, min_size=1, max_size=4), min_size=1, max_size=12))
def test_rows_are_the_same_however_files_are_split(spark, rows):
    """A quote-aware reading of the whole text gives the rows that splits of a few bytes give."""
    text = "head\r\n" + "".join(",".join(r) + "\r\n" for r in rows)
    folder = scratch_path(spark, "splits")
    _write(folder, "rows.csv", text)
    _write(folder, "more.csv", 'h\r\nplain,"x\r\ny"\r\n')
    expected = sorted(_brute_rows(text)[1:] + ['plain,"x\r\ny"'])
    old = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    try:
        for size in (7, 50):
            spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
            spark.conf.set("spark.sql.files.openCostInBytes", "1")
            assert sorted(r[0] for r in csv_ingest.read_rows(spark, folder).collect()) == expected
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old[0])
        spark.conf.set("spark.sql.files.openCostInBytes", old[1])


def test_rows_without_row_ends_in_quotes_are_not_read_token_by_token(spark, tmp_folder, capsys):
    """Empty quoted values, as extracts have them, need no reading from both start states and no token reader to find rows."""
    for name, rows in (("a", '1,"",x\r\n2,"y, z",\\N\r\n'), ("b", 'h,"",i\r\n3,"h,"",i"\r\nh,"",i\r\n')):
        _write(tmp_folder, f"plain/{name}.csv", 'h,"",i\r\n' + rows)
    rows = csv_ingest.read_rows(spark, tmp_folder + "/plain")
    rows.explain()
    assert "aggregate(" not in capsys.readouterr().out
    # the header goes once for each file, a data row that looks like it stays
    assert sorted(r[0] for r in rows.collect()) == sorted(
        ['1,"",x', '2,"y, z",\\N', 'h,"",i', '3,"h,"",i"', 'h,"",i'])


_ODD = st.lists(st.sampled_from(["a", ",", '"', '""', "\\N", "\\", "NULL", " ", ',"x",', ',"x,y",', "\n"]), max_size=8).map("".join)


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=st.lists(_ODD, min_size=1, max_size=30))
def test_raw_fields_are_those_of_the_token_reader(spark, rows):
    df = spark.createDataFrame([(r,) for r in rows], "row string").select(
        csv_ingest._raw_fields(F.col("row")).alias("raw"), csv_ingest._fields(F.col("row")).alias("read"), "row")
    for r in df.collect():
        if r.raw is not None:
            assert [(v[1:-1], True) if v.startswith('"') else (v, False) for v in r.raw] == [tuple(f) for f in r.read], r.row
        else:
            assert '"' in r.row or "\\" in r.row


def test_expected_header_rows_are_a_filter_without_python(spark, tmp_folder):
    """Header rows with the expected names go in a plain filter; a data row with the same text, or other headers, take the Python pass."""
    df = spark.createDataFrame([("AW1", "US"), ("AW2", None), ("a,\"b\"", ""), ("NULL", " x ")], "cid string, cntry string").repartition(3)
    expected = sorted(df.collect(), key=str)
    path = csv_ingest.write_source_csv(df, tmp_folder, "erp_loc_a101")
    raw = csv_ingest.read_source_csv(spark, path, ["cid", "cntry"])
    assert "MapInArrow" not in raw._jdf.queryExecution().executedPlan().toString()
    assert sorted(raw.select("cid", "cntry").collect(), key=str) == expected
    repeated = csv_ingest.write_source_csv(spark.createDataFrame([("cid", "cntry"), ("AW1", "US")], df.schema).coalesce(1), tmp_folder + "/r", "erp_loc_a101")
    raw = csv_ingest.read_source_csv(spark, repeated, ["cid", "cntry"])
    assert "MapInArrow" in raw._jdf.queryExecution().executedPlan().toString()
    assert sorted(raw.select("cid", "cntry").collect()) == [("AW1", "US"), ("cid", "cntry")]
    other = csv_ingest.read_source_csv(spark, path, ["key", "country"])
    assert sorted(other.select(F.col("key").alias("cid"), F.col("country").alias("cntry")).collect(), key=str) == expected


def test_compressed_extracts_are_several_files_each_with_its_header(spark, tmp_folder, monkeypatch):
    """A task's rows are dealt over files that one task each can read; they load like a plain extract."""
    monkeypatch.setattr(csv_ingest, "COMPRESSED_ROWS", 3)
    rows = [(f"AW{i}", [None, "", "US", 'a "b", c', "row\r\nend", "cid,cntry", "\\N", "NULL"][i % 8]) for i in range(26)]
    df = spark.createDataFrame(rows, csv_ingest.bronze_schema("erp_loc_a101")).repartition(2)
    path = csv_ingest.write_source_csv(df, tmp_folder, "erp_loc_a101", compressed=True)
    files = glob.glob(path.replace("file:", "") + "/part-*")
    assert len(files) >= 9 and all(f.endswith(".lz4") for f in files)
    assert sorted(map(str, csv_ingest.read_bronze(spark, tmp_folder, "erp_loc_a101").collect())) == sorted(map(str, df.collect()))
    plain = df.where(~F.contains(F.coalesce("cntry", F.lit("")), F.lit("\r")))  # no row end inside quotes: every line is a row
    csv_ingest.write_source_csv(plain, tmp_folder, "erp_loc_a101", compressed=True)
    assert sorted(map(str, csv_ingest.read_bronze(spark, tmp_folder, "erp_loc_a101").collect())) == sorted(map(str, plain.collect()))

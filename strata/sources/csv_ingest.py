"""CSV extracts -> typed bronze tables (the bronze load).

Source files are comma separated, fields optionally enclosed in ``"``, rows end
in CRLF (``line_sep`` for files with another line end), one header row is
skipped; columns are bound by position.  Field semantics follow a MySQL
``LOAD DATA`` load with an enclosing and an escape character:

* an empty field is the empty string ``''``; ``\\N`` and an unquoted ``NULL`` are NULL;
* inside quotes a comma or row end belongs to the field, and a quote is doubled,
  escaped by a backslash, or not followed by a comma or row end;
* backslash sequences are decoded everywhere;
* date, timestamp and number columns go through ``NULLIF(x, '')`` before conversion;
* the ERP birth date arrives as ``DD/MM/YYYY`` (one or two digit day/month);
* CRM sales dates stay integers ``yyyymmdd`` in bronze; an ISO ``yyyy-MM-dd``
  value is accepted and stored as the same integer;
* a value that does not convert to its column type becomes NULL; the
  conversions that failed are counted per column by ``conversion_failures``;
* fields that a short row lacks are NULL and surplus fields are dropped; both
  kinds of rows are counted (``malformed_rows``).

Files are read in splits (``spark.sql.files.maxPartitionBytes``) although a row
end may lie inside quotes.  A first pass asks whether any does; if not, every line
is a row, and header rows with the expected names are a filter.  Else another pass reports for every split in which state
it would end after either start state, these answers (two bits a split with quotes) are
combined in file order, and the last pass cuts rows knowing each split's start.
Rows are read token by token only where a quote or backslash lies inside a field.
Only rows that cross a split are shuffled.  A quote that never closes makes
the rest of its file one (malformed) row, which one task must hold.
Compressed files (``.gz``, ``.lz4``) are read as well, each by one task.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.cleaning import empty_to_null, iso_date_to_yyyymmdd, parse_dmy

NULL_TOKEN = "\\N"
CRLF = "\r\n"
NULL_WORD = "NULL"
MALFORMED = "_malformed"
# What a row is read as, and the states of the reader between two of these.
_TOKENS = r"(\\[\s\S]|[\\\",]|[^\\\",]+)"
# A row each of whose fields is plain, the NULL token, or enclosed in quotes and without any inside;
# such a row without commas inside quotes.
_SIMPLE, _SPLIT = (rf"\A{f}(?:,{f})*+\z" for f in (r'(?:"[^"\\]*+"|\\N|[^",\\]*+)', r'(?:"[^",\\]*+"|\\N|[^",\\]*+)'))
_START, _PLAIN, _QUOTED, _QUOTE_SEEN = range(4)
# Fixed value: rows of a compressed file, which one task reads whole.
COMPRESSED_ROWS = 250_000
# Escape sequences of LOAD DATA (a code that is not listed stands for itself).
ESCAPES = [("n", "\n"), ("t", "\t"), ("r", "\r"), ("0", "\0"), ("b", "\b"), ("Z", "\x1a")]

# Delivered file per bronze table and its positional column list.
SOURCES: dict[str, tuple[str, list[str]]] = {
    "crm_cust_info": ("source_crm/cust_info.csv",
                      ["cst_id", "cst_key", "cst_firstname", "cst_lastname", "cst_marital_status", "cst_gndr",
                       "cst_create_date"]),
    "crm_prd_info": ("source_crm/prd_info.csv",
                     ["prd_id", "prd_key", "prd_nm", "prd_cost", "prd_line", "prd_start_dt", "prd_end_dt"]),
    "crm_sales_details": ("source_crm/sales_details.csv",
                          ["sls_ord_num", "sls_prd_key", "sls_cust_id", "sls_order_dt", "sls_ship_dt", "sls_due_dt",
                           "sls_sales", "sls_quantity", "sls_price"]),
    "erp_loc_a101": ("source_erp/LOC_A101.csv", ["cid", "cntry"]),
    "erp_cust_az12": ("source_erp/CUST_AZ12.csv", ["cid", "bdate", "gen"]),
    "erp_px_cat_g1v2": ("source_erp/PX_CAT_G1V2.csv", ["id", "cat", "subcat", "maintenance"]),
}

# Bronze column types (columns not listed are strings).
BRONZE_TYPES: dict[str, dict[str, str]] = {
    "crm_cust_info": {"cst_id": "bigint", "cst_create_date": "date"},
    "crm_prd_info": {"prd_id": "bigint", "prd_cost": "int", "prd_start_dt": "timestamp_ntz",
                     "prd_end_dt": "timestamp_ntz"},
    "crm_sales_details": {"sls_cust_id": "bigint", "sls_order_dt": "int_date", "sls_ship_dt": "int_date",
                          "sls_due_dt": "int_date",
                          "sls_sales": "int", "sls_quantity": "int", "sls_price": "int"},
    "erp_loc_a101": {},
    "erp_cust_az12": {"bdate": "dmy_date"},
    "erp_px_cat_g1v2": {},
}


def bronze_schema(name: str) -> T.StructType:
    types = BRONZE_TYPES[name]
    mapping = {"int": T.IntegerType(), "bigint": T.LongType(), "int_date": T.IntegerType(), "date": T.DateType(),
               "timestamp_ntz": T.TimestampNTZType(), "dmy_date": T.DateType()}
    return T.StructType([T.StructField(c, mapping.get(types.get(c, ""), T.StringType()), True)
                         for c in SOURCES[name][1]])


def _unescape(value: Column) -> Column:
    """Backslash sequences as LOAD DATA decodes them (``\\n`` is a line feed, ``\\x`` any other ``x``)."""
    decode = F.create_map(*[F.lit(x) for code, char in ESCAPES for x in ("\\" + code, char)])
    parts = F.transform(F.regexp_extract_all(value, F.lit(r"(\\[\s\S]|\\|[^\\]+)"), 1), lambda t: F.when(
        t.startswith("\\") & (F.length(t) == 2), F.coalesce(F.try_element_at(decode, t), F.substring(t, 2, 1))).otherwise(t))
    return F.when(F.contains(value, F.lit("\\")), F.array_join(parts, "")).otherwise(value)


def _next_state(state: Column, token: Column) -> Column:
    """The reader's state after a token: quotes open at a field's start and close before a comma or row end."""
    quote, comma = token == '"', token == ","
    return (F.when(state == _START, F.when(quote, _QUOTED).when(comma, _START).otherwise(_PLAIN))
            .when(state == _PLAIN, F.when(comma, _START).otherwise(_PLAIN))
            .when(state == _QUOTED, F.when(quote, _QUOTE_SEEN).otherwise(_QUOTED))
            .otherwise(F.when(comma, _START).otherwise(_QUOTED)))


def _tokens(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(_TOKENS), 1)


def _ends_quoted(text: Column, start: int) -> Column:
    """Whether a quoted field is open at the end of ``text`` when it is read from state ``start``."""
    return F.aggregate(_tokens(text), F.lit(start), _next_state) == _QUOTED


def _fields(row: Column) -> Column:
    """The fields of a row: array of ``(value, quoted)``, values without their quotes, backslashes not yet decoded."""
    start = F.struct(F.array().cast("array<struct<value:string,quoted:boolean>>").alias("done"), F.lit("").alias("value"),
                     F.lit(False).alias("quoted"), F.lit(_START).alias("state"))

    def closed(acc: Column) -> Column:
        return F.concat(acc["done"], F.array(F.struct(acc["value"].alias("value"), acc["quoted"].alias("quoted"))))

    def step(acc: Column, token: Column) -> Column:
        state = acc["state"]
        after = _next_state(state, token)
        ends = (token == ",") & (after == _START)
        silent = ((state == _START) | (state == _QUOTED)) & (token == '"')  # opens or may close the field
        lone = (state == _QUOTE_SEEN) & (token != '"')                     # it did not: that quote was text
        return F.when(ends, F.struct(closed(acc).alias("done"), F.lit("").alias("value"), F.lit(False).alias("quoted"), after.alias("state"))) \
            .otherwise(F.struct(acc["done"].alias("done"),
                                F.when(silent, acc["value"]).when(lone, F.concat(acc["value"], F.lit('"'), token))
                                .otherwise(F.concat(acc["value"], token)).alias("value"),
                                (acc["quoted"] | (after == _QUOTED)).alias("quoted"), after.alias("state")))

    return F.aggregate(_tokens(row), start, step, closed)


def _raw_fields(row: Column) -> Column:
    """The fields of a simple row as they stand in it, quotes included; NULL for any other row."""
    split = F.split(row, ",")
    return F.when(~F.contains(row, F.lit('"')) & ~F.contains(row, F.lit("\\")), split).when(row.rlike(_SPLIT), split).when(
        row.rlike(_SIMPLE), F.regexp_extract_all(F.concat(F.lit(","), row), F.lit(r',("[^"]*+"|[^,]*+)'), F.lit(1)))


def _lines(spark: SparkSession, path: str, line_sep: str) -> DataFrame:
    """What lies between two row ends, quoted or not, with its split."""
    return spark.read.option("lineSep", line_sep).text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"))


def _opens() -> Column:
    """Whether a quoted field is open at the end of a piece that begins a row; simple rows need no reading for that."""
    value = F.col("value")
    return F.when(F.contains(value, F.lit('"')), F.when(value.rlike(_SIMPLE), False).otherwise(_ends_quoted(value, _START))).otherwise(False)


def _pieces(lines: DataFrame) -> DataFrame:
    """The lines with the state each ends in after either start state."""
    stays = F.when(F.contains("value", F.lit('"')), _ends_quoted(F.col("value"), _QUOTED)).otherwise(True)
    return lines.select("value", "file", "split", _opens().alias("opens"), stays.alias("stays"))


def _split_starts(pieces: DataFrame) -> dict[str, tuple[list[int], list[bool]]]:
    """Per file its splits (byte offsets) and whether each starts inside quotes.

    Every split is read from both start states at once and answers with two
    bits; one row a split reaches the driver.
    """
    turns = pieces.withColumn("at", F.monotonically_increasing_id()).groupBy("file", "split").agg(
        F.sort_array(F.collect_list(F.when(F.col("opens") | ~F.col("stays"), F.struct("at", "opens", "stays")))).alias("turns"))

    def after(start: bool) -> Column:
        return F.aggregate("turns", F.lit(start), lambda quoted, t: F.when(quoted, t["stays"]).otherwise(t["opens"]))

    starts: dict[str, tuple[list[int], list[bool]]] = {}
    quoted = False
    for r in turns.select("file", "split", after(False).alias("opens"), after(True).alias("stays")).orderBy("file", "split").collect():
        if r["file"] not in starts:
            quoted = False
        splits, states = starts.setdefault(r["file"], ([], []))
        splits.append(r["split"])
        states.append(quoted)
        quoted = r["stays"] if quoted else r["opens"]
    return starts


def _without_headers(lines: DataFrame) -> DataFrame:
    """The lines but each file's first, where every line is a row (column ``row``)."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file = None
        for batch in batches:
            rows, begun = batch["value"], batch["begun"]
            if batch.num_rows and begun.null_count < batch.num_rows and not begun[0].as_py() == begun[-1].as_py() == file:
                keep = []
                for f in begun.to_pylist():
                    keep.append(f is None or f == file)
                    file = f or file
                rows = rows.filter(pa.array(keep))
            yield pa.RecordBatch.from_arrays([rows], names=["row"])

    # ``begun`` names the file in its first split and is NULL in later ones
    return lines.select("value", F.when(F.col("split") == 0, F.col("file")).alias("begun")).mapInArrow(cut, "row string")


def _survey(lines: DataFrame, header: str | None) -> tuple[bool, bool]:
    """Whether a row end lies inside quotes, and whether in every file ``header`` is the first line and no other.

    One pass; both answers hold however the files are split later.
    """
    head = F.lit(False) if header is None else F.col("value") == header
    per_file = lines.select("file", _opens().alias("opens"), head.alias("head"), F.when(F.col("split") == 0, F.monotonically_increasing_id()).alias("at")) \
        .groupBy("file").agg(F.bool_or("opens").alias("opens"), F.count_if("head").alias("heads"), F.min("at").alias("first"),
                             F.min(F.when(F.col("head"), F.col("at"))).alias("found"))
    opens, plain = per_file.agg(F.bool_or("opens"), F.bool_and(F.coalesce((F.col("heads") == 1) & (F.col("first") == F.col("found")), F.lit(False)))).first()
    return bool(opens), bool(plain)


def read_rows(spark: SparkSession, path: str, line_sep: str = CRLF, header: str | None = None) -> DataFrame:
    """The data rows of CSV files as text (column ``row``), without each file's header row.

    ``header`` is what the header rows are likely to be; any other one is skipped as well, by a slower pass.
    """
    lines = _lines(spark, path, line_sep)
    opens, plain = _survey(lines, header)
    if not opens:
        # no row end lies inside quotes: every line is a row, whatever split it is in
        return lines.where(F.col("value") != header).select(F.col("value").alias("row")) if plain else _without_headers(lines)
    pieces = _pieces(lines)
    starts = _split_starts(pieces)
    out = T.StructType.fromDDL("row string, file string, split long, opens boolean")
    schema = pa.schema([("row", pa.string()), ("file", pa.string()), ("split", pa.int64()), ("opens", pa.bool_())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, split, quoted, held, crossed, header = None, -1, False, [], False, False

        def parts(rows: list, last: tuple | None = None) -> pa.RecordBatch:
            # whole rows carry no file; parts of rows that cross a split say whether they begin one
            rows = [(r, None, None, None) if isinstance(r, str) else r for r in [*rows, *([last] if last else [])]]
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)] if rows else
                                              [pa.array([], f.type) for f in schema], schema=schema)

        def rest() -> tuple | None:
            # what is open at the end of a split goes on in the next one (a header that does is NULL)
            return (None if header else line_sep.join(held), file, split, not crossed) if held else None

        def begin(f: str, at: int) -> None:
            nonlocal file, split, quoted, held, crossed, header
            splits, states = starts.get(f, ([], []))
            k = bisect_left(splits, at)
            if k == len(splits) or splits[k] != at:
                raise RuntimeError(f"{f} was split otherwise in the first pass; run the load again")
            file, split, quoted, held, crossed, header = f, at, states[k], [], states[k], at == 0

        for batch in batches:
            if batch.num_rows == 0:
                continue
            ends = [(batch["file"][k].as_py(), batch["split"][k].as_py()) for k in (0, batch.num_rows - 1)]
            if ends[0] == ends[1] and batch["opens"].true_count == 0:
                # one split, no row end inside quotes begins here: the pieces are the rows
                if ends[0] != (file, split):
                    if (last := rest()) is not None:
                        yield parts([], last)
                    begin(*ends[0])
                if not quoted:
                    whole = batch["value"].slice(int(header))
                    header = False
                    yield pa.RecordBatch.from_arrays([whole, *(pa.nulls(len(whole), f.type) for f in list(schema)[1:])], schema=schema)
                    continue
            rows: list = []
            for value, f, at, opens, stays in zip(*(c.to_pylist() for c in batch.columns)):
                if (f, at) != (file, split):
                    if (last := rest()) is not None:
                        rows.append(last)
                    begin(f, at)
                if quoted or opens:
                    held.append(value)
                    quoted = stays if quoted else opens
                    if quoted:
                        continue
                    value = line_sep.join(held)
                    held = []
                if crossed:
                    rows.append((value, file, split, False))
                elif not header:
                    rows.append(value)
                crossed = header = False
            yield parts(rows)
        if (last := rest()) is not None:
            yield parts([], last)

    read = pieces.mapInArrow(cut, out)
    if not any(any(states) for _, states in starts.values()):
        # no row crosses a split; one that is open at the end of its file ends there
        return read.where("row is not null").select("row")
    part = read.where("file is not null").select(
        "*", F.sum(F.col("opens").cast("long")).over(Window.partitionBy("file").orderBy("split", "opens")).alias("number"))
    # the end of the row before comes first in its split, the beginning of the next one last
    joined = part.groupBy("file", "number").agg(F.sort_array(F.collect_list(F.struct("split", "opens", "row"))).alias("p")).where(
        ~F.exists("p", lambda p: p["row"].isNull())).select(F.array_join(F.col("p.row"), line_sep).alias("row"))
    return read.where("file is null").select("row").unionByName(joined)


def read_source_csv(spark: SparkSession, path: str, columns: list[str], line_sep: str = CRLF) -> DataFrame:
    """Raw fields as strings with LOAD DATA semantics, plus ``MALFORMED``.

    Empty -> ``''``; ``\\N`` and unquoted ``NULL`` -> NULL; fields that a short row lacks -> NULL.
    ``MALFORMED`` holds the source text of rows with too few or too many fields
    (surplus fields are dropped), else NULL.
    """
    raw = read_rows(spark, path, line_sep, ",".join(columns)).select("row", _raw_fields(F.col("row")).alias("raw"))
    simple = F.col("raw").isNotNull()
    rows = raw.select("row", "raw", F.when(~simple, _fields(F.col("row"))).alias("fields"))

    def field(i: int) -> Column:
        r, f = F.get("raw", F.lit(i)), F.get("fields", F.lit(i))
        v = f["value"]
        return F.when(simple, F.when((r == NULL_TOKEN) | (r == NULL_WORD), F.lit(None)).when(
            r.startswith('"'), r.substr(F.lit(2), F.length(r) - 2)).otherwise(r)).otherwise(
            F.when((v == NULL_TOKEN) | ((v == NULL_WORD) & ~f["quoted"]), F.lit(None)).otherwise(_unescape(v)))

    n_fields = F.when(simple, F.size("raw")).otherwise(F.size("fields"))
    return rows.select(*[field(i).alias(c) for i, c in enumerate(columns)],
                       F.when(n_fields != len(columns), F.col("row")).alias(MALFORMED))


def _convert(c: str, kind: str) -> Column:
    v = F.col(c)
    if kind in ("int", "bigint"):
        return empty_to_null(v).try_cast(kind)
    if kind == "int_date":
        # yyyymmdd as delivered; an ISO yyyy-MM-dd date is accepted and stored the same way
        return F.coalesce(empty_to_null(v).try_cast("int"), iso_date_to_yyyymmdd(v))
    if kind == "date":
        return empty_to_null(v).try_cast("date")
    if kind == "timestamp_ntz":
        return empty_to_null(v).try_cast("timestamp_ntz")
    if kind == "dmy_date":
        return parse_dmy(v)
    return v


def to_bronze(name: str, raw: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Typed bronze table from the raw string fields of its extract, with the columns ``keep`` as they are."""
    types = BRONZE_TYPES[name]
    return raw.select(*[_convert(c, types.get(c, "string")).alias(c) for c in SOURCES[name][1]], *keep)


def conversion_failures(name: str, raw: DataFrame) -> DataFrame:
    """Per typed column: how many non-empty raw values did not convert (one pass)."""
    types = BRONZE_TYPES[name]
    checks = [F.count_if(F.col(c).isNotNull() & (F.col(c) != "") & _convert(c, k).isNull()).alias(c)
              for c, k in types.items()]
    if not checks:
        return raw.sparkSession.createDataFrame([], "table_name string, column_name string, failures bigint")
    counts = raw.agg(*checks)
    return counts.select(F.explode(F.array(*[
        F.struct(F.lit(name).alias("table_name"), F.lit(c).alias("column_name"), F.col(c).alias("failures"))
        for c in types])).alias("r")).select("r.*")


def read_bronze_observed(spark: SparkSession, source_dir: str, name: str, line_sep: str = CRLF) -> tuple[DataFrame, Observation]:
    """Typed bronze table plus an ``Observation`` that counts, during the same pass
    (the write), the non-empty values that did not convert (``failed_values``) and the
    rows with too few or too many fields (``malformed_rows``)."""
    rel, cols = SOURCES[name]
    raw = read_source_csv(spark, f"{source_dir.rstrip('/')}/{rel}", cols, line_sep)
    types = BRONZE_TYPES[name]
    typed = [_convert(c, types.get(c, "string")).alias(f"_t_{c}") for c in cols]
    both = raw.select(*cols, MALFORMED, *typed)
    failed = [(F.col(c).isNotNull() & (F.col(c) != "") & F.col(f"_t_{c}").isNull()).cast("int") for c in types]
    total = sum(failed[1:], failed[0]) if failed else F.lit(0)
    obs = Observation(f"ingest_{name}")
    observed = both.observe(obs, F.sum(total).cast("bigint").alias("failed_values"),
                            F.count(MALFORMED).alias("malformed_rows"))
    return observed.select(*[F.col(f"_t_{c}").alias(c) for c in cols]), obs


def read_bronze(spark: SparkSession, source_dir: str, name: str, line_sep: str = CRLF) -> DataFrame:
    rel, cols = SOURCES[name]
    return to_bronze(name, read_source_csv(spark, f"{source_dir.rstrip('/')}/{rel}", cols, line_sep))


# ---------------------------------------------------------------- extract writer
def _as_text(c: str, dtype: T.DataType, dmy: bool) -> Column:
    """A value as it is delivered, in quotes where it holds a quote, comma or row end or is empty text."""
    v = F.col(c)
    if isinstance(dtype, T.DateType):
        text = F.date_format(v, "dd/MM/yyyy" if dmy else "yyyy-MM-dd")
        return F.coalesce(text, F.lit(""))            # missing dates are delivered empty
    if isinstance(dtype, (T.TimestampNTZType, T.TimestampType)):
        return F.coalesce(F.date_format(v, "yyyy-MM-dd HH:mm:ss"), F.lit(""))
    if isinstance(dtype, T.NumericType):
        return F.coalesce(v.cast("string"), F.lit(""))  # missing numbers are delivered empty
    # NULL is written as \N, so backslashes of the text are doubled and its word NULL is escaped
    text = F.replace(v.cast("string"), F.lit("\\"), F.lit("\\\\"))
    enclosed = F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))
    special = (text == "") | F.contains(text, F.lit('"')) | F.contains(text, F.lit(",")) | F.contains(text, F.lit("\r")) | F.contains(text, F.lit("\n"))
    return F.when(v.isNull(), NULL_TOKEN).when(text == NULL_WORD, "\\" + NULL_WORD).when(special, enclosed).otherwise(text)


def write_source_csv(df: DataFrame, source_dir: str, name: str, compressed: bool = False) -> str:
    """Write a bronze-shaped table as its source system delivers it; returns the path."""
    cols, dmy = SOURCES[name][1], BRONZE_TYPES[name]
    types = {f.name: f.dataType for f in df.schema.fields}
    line = F.concat_ws(",", *[_as_text(c, types[c], dmy.get(c) == "dmy_date") for c in cols])
    return write_lines(df.select(line.alias("line")), source_dir, name, compressed)


def write_lines(lines: DataFrame, source_dir: str, name: str, compressed: bool = False) -> str:
    """Write rows that are text already (one column) as the extract of ``name``, each file with its header row.

    ``compressed`` files (LZ4) cannot be read in splits, so a task's rows go to several of them.
    """
    rel, cols = SOURCES[name]
    text = F.col(lines.columns[0])
    at = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    first = at % COMPRESSED_ROWS == 0 if compressed else at == 0
    options = {"compression": "lz4", "maxRecordsPerFile": COMPRESSED_ROWS} if compressed else {}
    path = f"{source_dir.rstrip('/')}/{rel}"
    lines.select(F.when(first, F.concat(F.lit(",".join(cols) + CRLF), text)).otherwise(text).alias("line")) \
        .write.mode("overwrite").options(lineSep=CRLF, **options).text(path)
    return path

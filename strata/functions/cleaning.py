"""Column expressions used by the silver and gold layers.

Each function takes and returns ``Column`` objects built only from
``pyspark.sql.functions``, so every rule stays inside whole-stage codegen and
can be reused on any table.  Semantics follow MySQL 8 where it differs from
Spark (see the notes on each function).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# The unknown labels and the code -> label maps of the source systems.
NA = "n/a"
NOT_SPECIFIED = "Not Specified"
MARITAL_STATUS = {"S": "Single", "M": "Married"}
CRM_GENDER = {"F": "Female", "M": "Male"}
ERP_GENDER = {"F": "Female", "M": "Male"}
PRODUCT_LINE = {"M": "Mountain", "R": "Road", "S": "Other Sales", "T": "Touring"}
COUNTRY_ALIASES = {"DE": "Germany", "US": "United States", "USA": "United States"}


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalise_code(c: Column | str) -> Column:
    """``UPPER(TRIM(c))``: the form every code is compared in."""
    return F.upper(F.trim(_col(c)))


def map_codes(c: Column | str, mapping: Mapping[str, str], default: str | None,
              normalise: bool = True) -> Column:
    """Searched CASE over a code map; unmatched and NULL codes give ``default``."""
    key = normalise_code(c) if normalise else _col(c)
    expr = None
    for code, label in mapping.items():
        expr = F.when(key == F.lit(code), F.lit(label)) if expr is None else expr.when(key == F.lit(code), F.lit(label))
    return expr.otherwise(F.lit(default))


def split_product_key(c: Column | str) -> tuple[Column, Column]:
    """Composite product key -> (category id, product key).

    The category id is the first five characters with ``-`` replaced by ``_``;
    the product key starts at character 7 (1-based), past the end gives ``''``.
    """
    k = _col(c)
    cat_id = F.replace(F.substring(k, 1, 5), F.lit("-"), F.lit("_"))
    prd_key = k.substr(F.lit(7), F.length(k))
    return cat_id, prd_key


def repair_sales(sales: Column | str, qty: Column | str, price: Column | str) -> Column:
    """Sales = qty * |price| when the stored value is missing, non-positive or wrong.

    A NULL price makes the inequality NULL, so such a row keeps a positive
    stored value and otherwise gets NULL (three-valued logic as in SQL).
    Computed in DECIMAL so large quantities cannot overflow an INT; an amount
    that DECIMAL(10,2) cannot hold becomes NULL, it does not stop the load.
    """
    return _sales(_col(sales), _col(qty), _col(price)).try_cast("decimal(10,2)")


def _sales(s: Column, q: Column, p: Column) -> Column:
    expected = q.cast("decimal(12,0)") * F.abs(p.cast("decimal(12,0)"))
    bad = (s.cast("decimal(12,0)") != expected) | (s <= 0) | s.isNull()
    return F.when(bad, expected).otherwise(s)


def repair_price(sales: Column | str, qty: Column | str, price: Column | str) -> Column:
    """Price = original sales / qty (NULL for qty 0) when missing or non-positive.

    The division is exact decimal division rounded half-up to cents, which is
    what a DECIMAL(10,2) column receives; double division would misround
    half-cent ties.
    """
    return _price(_col(sales), _col(qty), _col(price)).try_cast("decimal(10,2)")


def _price(s: Column, q: Column, p: Column) -> Column:
    derived = s.cast("decimal(12,0)") / F.nullif(q, F.lit(0)).cast("decimal(12,0)")
    return F.when((p <= 0) | p.isNull(), derived).otherwise(p)


def lost_amounts(sales: Column | str, qty: Column | str, price: Column | str) -> Column:
    """How many of a row's repaired sales and price DECIMAL(10,2) cannot hold (0 to 2)."""
    own = _col(sales), _col(qty), _col(price)
    lost = [v.isNotNull() & v.try_cast("decimal(10,2)").isNull() for v in (_sales(*own), _price(*own))]
    return lost[0].cast("int") + lost[1].cast("int")


def standardise_country(c: Column | str, aliases: Mapping[str, str] = COUNTRY_ALIASES,
                        unknown: str = NA) -> Column:
    """Trimmed alias codes -> country names; empty or NULL -> ``unknown``; else trimmed."""
    t = F.trim(_col(c))
    expr = None
    for code, name in aliases.items():
        expr = F.when(t == F.lit(code), F.lit(name)) if expr is None else expr.when(t == F.lit(code), F.lit(name))
    return expr.when((t == F.lit("")) | t.isNull(), F.lit(unknown)).otherwise(t)


def strip_chars(c: Column | str, chars: str = "-") -> Column:
    """Remove every occurrence of ``chars`` (``REPLACE(c, chars, '')``)."""
    return F.replace(_col(c), F.lit(chars), F.lit(""))


def strip_prefix(c: Column | str, prefix: str) -> Column:
    """Drop a leading legacy prefix (``LIKE 'NAS%'`` then ``SUBSTRING``)."""
    k = _col(c)
    return F.when(k.startswith(prefix), k.substr(F.lit(len(prefix) + 1), F.length(k))).otherwise(k)


def null_if_future(c: Column | str, as_of: Column | str | None = None) -> Column:
    """NULL for dates after ``as_of`` (default: the current date)."""
    ref = F.current_date() if as_of is None else (F.lit(as_of).cast("date") if isinstance(as_of, str) else as_of)
    d = _col(c)
    return F.when(d > ref, F.lit(None)).otherwise(d)


def prefer(primary: Column | str, fallback: Column | str, unknown: str = NA) -> Column:
    """Primary unless it equals ``unknown``; then fallback; then ``unknown``.

    A NULL primary makes the test NULL, so it also falls through to the
    fallback, as the SQL CASE does.
    """
    p = _col(primary)
    return F.when(p != F.lit(unknown), p).otherwise(F.coalesce(_col(fallback), F.lit(unknown)))


def parse_yyyymmdd(c: Column | str) -> Column:
    """Text ``yyyyMMdd`` (or ISO ``yyyy-MM-dd``) -> DATE; anything else NULL."""
    s = _col(c).cast("string")
    return F.coalesce(F.try_to_date(s, "yyyyMMdd"), F.try_to_date(s, "yyyy-MM-dd"))


def int_yyyymmdd_to_date(c: Column | str) -> Column:
    """INT ``yyyymmdd`` -> DATE by integer arithmetic; invalid dates (0, 5489, 20230229) give NULL.

    No text formatting or parsing per row, and the column occurs only a few times: a filter on the date
    is pushed into the joins below, where Spark repeats whatever the column is made of.
    """
    v, zero = _col(c).cast("int"), F.lit(0)
    # the timestamp checks month and day and gives NULL where the date's own constructor raises under ANSI mode
    day = F.try_make_timestamp_ntz((v / 10000).cast("int"), (v % 10000 / 100).cast("int"), v % 100, zero, zero, zero)
    return F.when(v.between(10000101, 99991231), day.cast("date"))


def iso_date_to_yyyymmdd(c: Column | str) -> Column:
    """ISO ``yyyy-MM-dd`` text -> INT ``yyyymmdd`` (NULL if not such a date)."""
    t = F.try_to_date(_col(c), "yyyy-MM-dd")
    return (F.year(t) * 10000 + F.month(t) * 100 + F.dayofmonth(t)).cast("int")


def parse_dmy(c: Column | str) -> Column:
    """``STR_TO_DATE(c, '%d/%m/%Y')``: one or two digit day and month."""
    return F.try_to_date(_col(c), "d/M/yyyy")


def empty_to_null(c: Column | str) -> Column:
    """``NULLIF(c, '')``."""
    return F.nullif(_col(c), F.lit(""))

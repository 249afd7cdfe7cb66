"""Cleaning expressions and small column-level transforms."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: labels the reports use
POTATO = "Potato"
SWEET_POTATO = "Sweet Potato"
PREPARED = "Prepared Foods"
NO_CITY = "NA"


# --- numbers -------------------------------------------------------------------------------------

def to_number(text: Column, strict: bool = False) -> Column:
    """Text with thousands separators to double. Strict raises on unreadable text, else null."""
    plain = F.replace(F.trim(text.cast("string")), F.lit(","), F.lit(""))
    plain = F.nullif(plain, F.lit(""))
    return plain.cast("double") if strict else plain.try_cast("double")


def digits_number(text: Column, keep_sign: bool = True) -> Column:
    """Keep digits and the dot, then read as double.

    The sign survives unless ``keep_sign`` is off, which gives the older sign-losing reading.
    """
    digits = F.regexp_replace(text, r"[^0-9.]", "")
    number = F.nullif(digits, F.lit("")).try_cast("double")
    if not keep_sign:
        return number
    return F.when(F.ltrim(text).startswith("-"), -number).otherwise(number)


def dash_number(text: Column, keep_sign: bool = True) -> Column:
    """Numbers where a lone dash means zero. The older reading turns every dash into a zero digit."""
    plain = F.replace(F.trim(text), F.lit(","), F.lit(""))
    if keep_sign:
        plain = F.when(plain == "-", F.lit("0")).otherwise(plain)
    else:
        plain = F.replace(plain, F.lit("-"), F.lit("0"))
    return plain.try_cast("double")


def impute_weight(weight: Column, qty: Column, case_weight: Column) -> Column:
    """Case weight times quantity where the weight is zero but something was sold."""
    return F.when((weight == 0) & (qty > 0), case_weight * qty).otherwise(weight)


# --- categories and labels -----------------------------------------------------------------------

def category_equal(category: Column) -> Column:
    """Two-way category by equality; anything else, also null, is prepared food."""
    return F.when(category.isin(POTATO, SWEET_POTATO), POTATO).otherwise(PREPARED)


def category_contains(category: Column, token: str, keep_null: bool = False) -> Column:
    found = F.when(F.coalesce(category, F.lit("")).contains(token), POTATO).otherwise(PREPARED)
    return F.when(category.isNotNull(), found) if keep_null else found


def category_prefix(category: Column, prefix: str = POTATO) -> Column:
    return F.when(category.startswith(prefix), POTATO).otherwise(PREPARED)


def category_inside(category: Column, text: str = POTATO) -> Column:
    """Potato only if the category is itself a substring of ``text`` (swapped-argument search)."""
    return F.when(F.instr(F.lit(text), category) > 0, POTATO).otherwise(PREPARED)


def relabel(df: DataFrame, column: str, mapping: Mapping[str, str]) -> DataFrame:
    """Replace labels of a column; a frame without that column is returned as it is."""
    if column not in df.columns:
        return df
    return df.replace(dict(mapping), subset=[column])


def collapse_others(label: Column, keep: Sequence[str], other: str) -> Column:
    """Everything outside ``keep`` (null too) becomes ``other``."""
    return F.when(label.isin(*keep), label).otherwise(other)


# --- text ----------------------------------------------------------------------------------------

def blank_to_null(text: Column, any_space: bool = True) -> Column:
    """Blank text to null after trimming. ``any_space`` also treats tabs and the like as blank."""
    if any_space:
        return F.when(~F.trim(text).rlike(r"^\s*$"), F.trim(text))
    return F.nullif(F.trim(text), F.lit(""))


def clean_city(city: Column, cities: Sequence[str] = ()) -> Column:
    """Trimmed upper-case city reduced to the listed name it starts with, else ``NA``."""
    plain = F.upper(F.trim(city))
    found = F.lit(NO_CITY)
    for name in reversed(cities):
        found = F.when(plain.startswith(name), F.lit(name)).otherwise(found)
    return found


def with_clean_city(df: DataFrame, cities: Sequence[str] = (), column: str = "city") -> DataFrame:
    if column not in df.columns:
        return df.withColumn(column, F.lit(NO_CITY))
    return df.withColumn(column, clean_city(F.col(column), cities))


def strip_decimal(value: Column) -> Column:
    """Id text without a trailing ``.0``."""
    return F.regexp_replace(value.cast("string"), r"\.0$", "")


def strip_zeros(value: Column) -> Column:
    """Id text without leading zeros."""
    return F.ltrim(value.cast("string"), F.lit("0"))


def last_chars(value: Column, n: int) -> Column:
    return F.right(value, F.lit(n))


def trim_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.trim(F.col(c)) for c in columns})


def upper_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.upper(F.col(c)) for c in columns})


def split_pack(df: DataFrame, pack: str = "pack", size: str = "size") -> DataFrame:
    """Split ``pack/size`` at the first slash; values without a slash keep both columns."""
    parts = F.split(F.col(pack), "/", 2)
    has_size = F.size(parts) == 2
    return df.withColumns({
        pack: F.when(has_size, F.get(parts, 0)).otherwise(F.col(pack)),
        size: F.when(has_size, F.get(parts, 1)).otherwise(F.col(size)),
    })


# --- rows and headers ----------------------------------------------------------------------------

def drop_containing(df: DataFrame, column: str, token: str = "-") -> DataFrame:
    """Drop rows whose text contains the token; rows with null text stay."""
    return df.filter(F.col(column).isNull() | ~F.col(column).contains(token))


def drop_prefix(df: DataFrame, column: str, prefix: str) -> DataFrame:
    """Drop rows whose text starts with the prefix; rows with null text stay."""
    return df.filter(F.col(column).isNull() | ~F.col(column).startswith(prefix))


def lower_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def plain_headers(df: DataFrame, prefix: str) -> DataFrame:
    """Lower-case headers without a vendor prefix."""
    return df.toDF(*[c.replace(prefix, "").lower() for c in df.columns])


def set_columns(df: DataFrame, columns: Sequence[str], value: str = NO_CITY) -> DataFrame:
    """Overwrite columns with one literal (blanking out geography before an analysis)."""
    return df.withColumns({c: F.lit(value) for c in columns})


def default_column(df: DataFrame, column: str, value: str) -> DataFrame:
    """Add a literal column if it is missing."""
    return df if column in df.columns else df.withColumn(column, F.lit(value))

"""Readers of the weekly deliveries: delimited files, folders of files, wide sheets, JSON, tables."""

from __future__ import annotations

import csv
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from weekmart.functions.clean import to_number
from weekmart.operators.history import stack
from weekmart.session import staged
from weekmart.sources.records import FILE, LATIN_CONTROLS, WINDOWS, WINDOWS_CHARACTERS, plain_path, records_with_header
from weekmart.sources.schemas import snake, text

DAY = r"(\d{4}-\d{2}-\d{2})"
DAY_MONTH_YEAR = r"(\d{2} (?:Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec) \d{4})"


def read_delimited(
    spark: SparkSession, path: str | Sequence[str], schema: StructType, header: bool = True, sep: str = ",",
    null_value: str | None = None, encoding: str = "UTF-8", recursive: bool = False, name_glob: str | None = None,
    name_pattern: str | None = None,
) -> DataFrame:
    """Delimited files with a declared schema; gzip is recognized by the file name.

    ``recursive`` walks all folders below the path, ``name_glob`` selects by file name, ``name_pattern`` by a regular
    expression found in it: files with other names are listed but not read. Spark reads no
    ``cp1252``; such files are read as Latin-1, and the few characters that differ are translated.
    """
    windows = encoding.lower() in WINDOWS
    encoding = "ISO-8859-1" if windows else encoding
    options = {"header": str(header).lower(), "sep": sep, "encoding": encoding, "enforceSchema": "true"}
    if null_value is not None:
        options["nullValue"] = null_value
    if recursive:
        options["recursiveFileLookup"] = "true"
    if name_glob:
        options["pathGlobFilter"] = name_glob
    df = spark.read.options(**options).schema(schema).csv(path if isinstance(path, str) else list(path))
    if name_pattern:
        df = df.filter(F.col("_metadata.file_name").rlike(name_pattern))
    if windows:
        texts = [f.name for f in schema if f.dataType.simpleString() == "string"]
        df = df.withColumns({c: F.translate(F.col(f"`{c}`"), LATIN_CONTROLS, WINDOWS_CHARACTERS) for c in texts})
    return df


def snake_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*[snake(c) for c in df.columns])


def without_totals(df: DataFrame, column: str = "branch", label: str = "Total") -> DataFrame:
    """Drop the subtotal rows of a report; rows without a label stay."""
    return df.filter(F.col(column).isNull() | (F.col(column) != label))


def read_regional(spark: SparkSession, path, schema: StructType) -> DataFrame:
    """Regional report: blank text means null, subtotal rows dropped, pounds with thousands commas."""
    raw = without_totals(snake_headers(read_delimited(spark, path, schema, null_value=" ")))
    raw = raw.withColumns({c: F.nullif(F.col(c), F.lit("")) for c in raw.columns})
    return raw.withColumn("lbs", to_number(F.col("lbs")))


def read_sections(spark: SparkSession, first: str, others: Sequence[str], schema: StructType) -> DataFrame:
    """Report sections that share their column positions; only the first one has a header.

    The unnamed last column of the first section holds the pounds and is named by the schema.
    """
    head = read_delimited(spark, first, schema, header=True)
    rest = [read_delimited(spark, path, schema, header=False) for path in others]
    return snake_headers(stack(head, *rest))


def read_weekly(spark: SparkSession, path, schema: StructType, encoding: str | None = None) -> DataFrame:
    """National weekly report: columns by header name, ids stay text, week and pounds renamed."""
    raw = snake_headers(read_by_header(spark, path, schema.fieldNames(), encoding=encoding).drop(FILE))
    raw = raw.withColumnsRenamed({"year_week": "calendar_week", "lb_current": "lbs"})
    return raw.withColumns({"calendar_week": F.col("calendar_week").try_cast("int"), "lbs": to_number(F.col("lbs"))})


def wide_to_long(df: DataFrame, ids: Sequence[str], week: str = "calendar_week", value: str = "lbs") -> DataFrame:
    """Week columns to rows: the blank column goes, a dash means no value."""
    weeks = [c for c in df.columns if c not in ids and c.strip()]
    long = df.select(*ids, *[F.col(f"`{w}`").cast("string").alias(w) for w in weeks]).unpivot(list(ids), weeks, week, value)
    return long.withColumns({
        week: F.col(week).cast("int"),
        value: to_number(F.nullif(F.trim(value), F.lit("-"))),
    })


def file_path() -> Column:
    """Path of the file a row comes from, with blanks restored."""
    return F.replace(F.col("_metadata.file_path"), F.lit("%20"), F.lit(" "))


def file_name() -> Column:
    return F.replace(F.col("_metadata.file_name"), F.lit("%20"), F.lit(" "))


def date_in(text: Column, pattern: str = DAY, fmt: str = "yyyy-MM-dd") -> Column:
    """First date in a text; null if there is none."""
    return F.try_to_timestamp(F.nullif(F.regexp_extract(text, pattern, 1), F.lit("")), F.lit(fmt)).cast("date")


def dates_in(text: Column, pattern: str = DAY) -> Column:
    """All dates in a text, in order."""
    return F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(1)), lambda t: t.cast("date"))


def with_file_date(df: DataFrame, name: str, pattern: str = DAY, fmt: str = "yyyy-MM-dd") -> DataFrame:
    """Add the date found in the path (file or folder name) of each row's file."""
    return df.withColumn(name, date_in(file_path(), pattern, fmt))


def last_part(path: Column) -> Column:
    """The file name at the end of a path."""
    return F.element_at(F.split(path, "/"), -1)


def cells(count: int, value: str = "value") -> Column:
    """The fields c0, c1, ... of a record; a doubled quote in a quoted field is one, a backslash is a sign like others."""
    schema = ", ".join(f"c{k} string" for k in range(count))
    return F.from_csv(value, schema, {"escape": '"'})


def read_by_header(
    spark: SparkSession, path: str | Sequence[str], columns: Sequence[str] | None = None, name_glob: str | None = None, lower: bool = False,
    encoding: str | None = None,
) -> DataFrame:
    """Comma-separated files by the names in each file's own header, as text, with the path in FILE.

    Files may order their columns differently and have further ones. With ``columns`` a file that lacks one is an error;
    without, all names of all files are returned (in lower case on request), null where a file lacks them. Quoted fields,
    names too, may hold line breaks; without an ``encoding`` each file's own is found. The driver sees the different headers,
    not the files.
    """
    records, headers = records_with_header(spark, path, name_glob, encoding)
    found = sorted(row[0] for row in headers.select("header").distinct().collect())
    layouts = [[c.lower() if lower else c for c in next(csv.reader([h]))] for h in found]
    for header, layout in zip(found, layouts):
        missing = [c for c in columns or () if c not in layout]
        if missing:
            raise ValueError(f"columns {missing} are missing in the header {header!r}")
    names = list(columns or dict.fromkeys(c for layout in layouts for c in layout))
    number = F.array_position(F.array(*map(F.lit, found)), F.col("header")) if found else F.lit(0)
    parsed = records.select(FILE, number.alias("_layout"), cells(max(map(len, layouts), default=1)).alias("_cells"))
    def cell(name: str) -> Column:
        here = [(k, layout.index(name)) for k, layout in enumerate(layouts, 1) if name in layout]
        return F.coalesce(*[F.when(F.col("_layout") == k, F.col(f"_cells.c{at}")) for k, at in here], F.lit(None).cast("string"))
    return parsed.select(*[cell(c).alias(c) for c in names], FILE)


def read_shared(
    spark: SparkSession, path, schema: StructType, day: str = "week_beginning_date", encoding: str | None = None, keep: Sequence[str] = (),
) -> DataFrame:
    """Deliveries whose last header holds the week date, e.g. ``2024-03-24 11``.

    A file whose header has other names before that, or no date, is an error that names the file. Fields and encodings as in
    ``read_by_header``. ``keep`` may name FILE, the path each row comes from.
    """
    records, headers = records_with_header(spark, path, encoding=encoding)
    names = schema.fieldNames()

    def dated(file: Column) -> Column:
        head = cells(len(names), "header")
        expected = F.lit(True)
        for k, name in enumerate(names[:-1]):
            expected = expected & head[f"c{k}"].eqNullSafe(F.lit(name))
        wrong = F.raise_error(F.concat(F.lit("no week date or other columns in the header of "), file)).cast("date")
        return F.coalesce(F.when(expected, date_in(head[f"c{len(names) - 1}"])), wrong)

    # every header is checked, those of files without rows too; the rows then take the date of their own header
    layouts = staged(headers.groupBy("header").agg(F.min(FILE).alias(FILE)).select("header", dated(F.col(FILE)).alias(day)), "dates")
    rows = records.join(layouts, "header")
    cell = F.col("_cells")
    out = snake_headers(rows.select(cells(len(names)).alias("_cells"), day, FILE).select(
        *[cell[f"c{k}"].alias(name) for k, name in enumerate(names)], F.col(day).alias("day"), F.col(FILE).alias("file")))
    return out.withColumnsRenamed({"day": day, "file": FILE}).select(*out.columns[:-2], day, *keep)


def read_matching(
    spark: SparkSession, folder: str, token: str, repairs: Mapping[str, str] | None = None, encoding: str | None = None,
) -> DataFrame:
    """All delimited files whose name contains a token, headers lower-cased, stacked by name."""
    out = read_by_header(spark, folder, name_glob=f"*{token}*", lower=True, encoding=encoding).drop(FILE)
    if repairs and "consolidated category" in out.columns:
        out = out.replace(dict(repairs), subset=["consolidated category"])
    return out


def read_releases(spark: SparkSession, path: str, schema: StructType, contains: str | None = None) -> DataFrame:
    """JSON documents with an array of records to rows, optionally only names with a token."""
    rows = spark.read.schema(schema).option("multiLine", "true").json(path).select(F.inline("releases"))
    return rows.filter(F.col("name").contains(contains)) if contains else rows


def read_table(spark: SparkSession, kind: str, location: str | None = None, **options: str) -> DataFrame:
    """A stored table: ``parquet``, ``orc``, ``csv``, ``json``, ``jdbc`` or a catalog ``table``.

    Connection settings are the caller's; none are kept here.
    """
    if kind == "table":
        return spark.read.table(location)
    reader = spark.read.format(kind).options(**options)
    return reader.load(location) if location else reader.load()


def stored_sellout(table: DataFrame, keys: Sequence[str], day: str = "week_beginning_date", city: str | None = None) -> DataFrame:
    """Stored sell-out summed to its raw grain.

    ``city`` overwrites the shown city while the real one still separates the sums, as the stored
    query did.
    """
    out = table.groupBy(*keys, F.col(day).cast("date").alias(day)).agg(F.sum("lbs").alias("lbs"))
    return out.withColumn("city", F.lit(city)) if city is not None else out


def warehouse_sellout(
    fact: DataFrame, account: DataFrame, product: DataFrame, provider: DataFrame,
    provider_name: str | None = None, account_join: str = "left",
) -> DataFrame:
    """Warehouse sell-out by period, operator segment and category.

    Product ids lose their leading zeros before they are matched. With a provider name only that
    provider's rows remain.
    """
    product_id = F.ltrim(F.col("product_id"), F.lit("0"))
    joined = (
        fact.join(account, "operator_id", account_join)
        .join(product.withColumnRenamed("product_id", "product_code"), product_id == F.col("product_code"), "left")
        .join(provider, "provider_id", "left")
    )
    if provider_name is not None:
        joined = joined.filter(F.col("provider_name") == provider_name)
    return joined.groupBy(
        "period_start", "period_end", "sector", F.trim("segment").alias("segment"),
        F.trim("subsegment").alias("subsegment"), F.trim("category").alias("category"),
    ).agg(F.sum("sales_lbs").alias("lbs"), F.sum("sales_cases").alias("cases"))


def product_dimension(products: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Selected and renamed product columns."""
    return products.select([F.col(f"`{old}`").alias(new) for old, new in columns.items()])


def read_back(table: DataFrame, column: str, excluded: Sequence[str]) -> DataFrame:
    """Rows of a stored report outside some labels (rows without a label are left out, as in SQL)."""
    return table.filter(~F.col(column).isin(*excluded))


def weeks_in(table: DataFrame, week: str) -> DataFrame:
    """Distinct weeks a table holds."""
    return table.select(week).filter(F.col(week).isNotNull()).distinct()

"""Text inputs: CSV tables, ASCII grids, crop calendars, flat files with footnotes, and their resolution."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gridprep.functions.geo import GridSpec


def read_csv(spark: SparkSession, path: str, schema: StructType | str, **options: str) -> DataFrame:
    """A CSV table with a given schema; `...` is null, and `NA` is a text (Namibia's code)."""
    reader = spark.read.option("header", "true").option("nullValue", "...").option("mode", "FAILFAST").options(**options)
    return reader.schema(schema).csv(path)


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).option("header", "true").option("nullValue", "...").csv(path)


def year_of_name(path: Column) -> Column:
    """The year in a file's name: `1700AD` or `3000BC` (negative), else four digits."""
    name = F.element_at(F.split(path, "/"), -1)
    era = F.regexp_extract(name, r"(\d{1,5})(AD|BC)", 2)
    n = F.regexp_extract(name, r"(\d{1,5})(?:AD|BC)", 1)
    plain = F.regexp_extract(name, r"(?<!\d)(\d{4})(?!\d)", 1)
    return F.when(era == "BC", -n.try_cast("int")).when(era == "AD", n.try_cast("int")).otherwise(plain.try_cast("int"))


def read_ascii_grids(spark: SparkSession, path: str, spec: GridSpec, nodata: float = -9999.0) -> DataFrame:
    """year, gcol, grow, value from ASCII grids, one file for each year, with or without header; NODATA is null.

    Each file is one record (a grid is a bounded file); one that hasn't as many values as the lattice is an error.
    """
    files = spark.read.text(path, wholetext=True).select(year_of_name(F.col("_metadata.file_path")).alias("year"), F.col("_metadata.file_path").alias("file"), "value")
    body = F.regexp_replace("value", r"(?im)^\s*[a-z_]+\s+[-+0-9.eE]+\s*$", " ")
    own = F.regexp_extract("value", r"(?i)nodata_value\s+([-+0-9.eE]+)", 1).try_cast("double")
    numbers = files.select("year", "file", F.coalesce(own, F.lit(nodata)).alias("nodata"), F.split(F.trim(F.regexp_replace(body, r"\s+", " ")), " ").alias("v"))
    n = spec.ncol * spec.nrow
    bad = F.raise_error(F.concat(F.col("file"), F.lit(" has "), F.size("v").cast("string"), F.lit(f" values, not {n}"))).cast("array<string>")
    cells = numbers.withColumn("v", F.when(F.size("v") == n, F.col("v")).otherwise(bad)).select("year", "nodata", F.posexplode("v").alias("i", "x"))
    value = F.col("x").cast("double")
    return cells.select("year", (F.col("i") % spec.ncol).alias("gcol"), F.floor(F.col("i") / spec.ncol).cast("int").alias("grow"), F.when(value != F.col("nodata"), value).alias("value"))


def read_calendar(spark: SparkSession, path: str, crops: DataFrame) -> DataFrame:
    """unit, crop, area from lines `unit crop-index n  area start end  area start end ...`; other lines are skipped.

    The area is the sum over the line's seasons; ``crops``: idx, crop.
    """
    v = F.split(F.trim("value"), r"\s+")
    lines = spark.read.text(path).filter(F.col("value").rlike(r"^\s*\d+(\s+[-+0-9.eE]+)+\s*$")).select(v.alias("v")).filter(F.size("v") >= 3)
    areas = F.filter("v", lambda x, i: (i >= 3) & ((i - 3) % 3 == 0))
    total = F.aggregate(areas, F.lit(0.0), lambda a, x: a + x.cast("double"))
    return lines.select(F.col("v")[0].cast("int").alias("unit"), F.col("v")[1].cast("int").alias("idx"), total.alias("area")).join(crops, "idx").select("unit", "crop", "area")


def split_footnotes(df: DataFrame, first: list[str], note: str) -> tuple[DataFrame, DataFrame]:
    """Data rows (their first columns all filled) and footnote rows (number, text) of one flat file.

    A footnote row starts with `[n]` in column ``note`` and holds its text after it.
    """
    full = F.lit(True)
    for c in first:
        full &= F.col(c).isNotNull()
    notes = df.filter(~full & F.col(note).rlike(r"^\[[0-9]+\]"))
    return df.filter(full), notes.select(F.regexp_extract(note, r"^\[([0-9]+)\]", 1).cast("int").alias("number"), F.trim(F.regexp_replace(note, r"^\[[0-9]+\]", "")).alias("note"))


#: What happens by default to a row whose footnote is of this kind.
DEFAULT_ACTIONS = {"reference area": "drop", "reference period": "keep", "observation": "keep", "component": "keep", "accuracy": "keep", "adjust": "keep", "comparison": "keep", "other": "keep"}


def apply_footnote_rules(data: DataFrame, notes: DataFrame, rules: DataFrame | None = None, ids: tuple[str, ...] = ("id",), marks: str = "marks") -> DataFrame:
    """Data rows that no footnote drops, renamed where a rule says so.

    ``marks`` holds `[3,7]`; a note's text is `kind | text`; ``rules`` (kind, text, action, crop; text null: any) go before
    the defaults of the kinds. One note that drops a row is enough. ``crop`` of a rule replaces the row's.
    """
    spark = data.sparkSession
    kind = F.lower(F.trim(F.element_at(F.split("note", r"\|"), 1)))
    text = F.trim(F.element_at(F.split(F.concat(F.col("note"), F.lit("|")), r"\|"), 2))
    default = F.create_map(*(F.lit(x) for kv in DEFAULT_ACTIONS.items() for x in kv))
    typed = notes.select("number", kind.alias("kind"), text.alias("text"))
    if rules is None:
        rules = spark.createDataFrame([], "kind string, text string, action string, crop string")
    r = rules.select(F.col("kind").alias("rk"), F.col("text").alias("rt"), F.col("action").alias("ra"), F.col("crop").alias("rc"))
    ruled = typed.join(r, (F.col("kind") == F.col("rk")) & (F.col("rt").isNull() | (F.col("rt") == F.col("text"))), "left")
    ruled = ruled.groupBy("number", "kind").agg(F.max_by(F.struct("ra", "rc"), F.col("rt").isNotNull()).alias("r"))
    ruled = ruled.select("number", F.coalesce("r.ra", default[F.col("kind")], F.lit("keep")).alias("action"), F.col("r.rc").alias("new_crop"))
    numbers = F.transform(F.regexp_extract_all(F.col(marks), F.lit(r"([0-9]+)"), 1), lambda x: x.cast("int"))
    told = data.select(*ids, F.explode(numbers).alias("number")).join(ruled, "number")
    verdict = told.groupBy(*ids).agg(F.bool_or(F.col("action") == "drop").alias("__drop"), F.max("new_crop").alias("__crop"))
    out = data.join(verdict, [*ids], "left").filter(~F.coalesce("__drop", F.lit(False)))
    return (out.withColumn("crop", F.coalesce("__crop", "crop")) if "crop" in data.columns else out).drop("__drop", "__crop")


def choose_integer(df: DataFrame, value: str, na: int = -99) -> str:
    """byte, short, int or long: the narrowest that holds the values and the mark of missing ones."""
    one = df.agg(F.min(value).alias("lo"), F.max(value).alias("hi")).first()
    lo, hi = min(na, one["lo"] if one["lo"] is not None else na), max(na, one["hi"] if one["hi"] is not None else na)
    return next(k for k, bits in (("byte", 8), ("short", 16), ("int", 32), ("long", 64)) if -(1 << bits - 1) <= lo and hi < 1 << bits - 1)


def write_raster_table(df: DataFrame, path: str, value: str, na: int = -99, mode: str = "errorifexists") -> str:
    """Parquet with the narrowest integer type, missing values as ``na``; returns the type."""
    kind = choose_integer(df, value, na)
    df.withColumn(value, F.coalesce(F.col(value), F.lit(na)).cast(kind)).write.mode(mode).parquet(path)
    return kind


def append_years(df: DataFrame, path: str) -> None:
    """Writes years as partitions; a year that is there already is replaced as a whole."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("year").parquet(path)


def pending_years(spark: SparkSession, path: str, wanted: DataFrame) -> DataFrame:
    """Those of ``wanted`` (year) that have no partition yet."""
    from pyspark.errors import AnalysisException

    try:
        done = spark.read.parquet(path).select(F.col("year").cast("int").alias("year")).distinct()
    except AnalysisException:  # nothing has been written
        return wanted
    return wanted.join(done, "year", "left_anti")

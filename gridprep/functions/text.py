"""Clean-up of names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Letters and what stands for them in ASCII.
SINGLE = ("ÀÁÂÃÄÅÇÈÉÊËÌÍÎÏÑÒÓÔÕÖØÙÚÛÜÝàáâãäåçèéêëìíîïñòóôõöøùúûüýÿ‘’“”–—", "AAAAAACEEEEIIIINOOOOOOUUUUYaaaaaaceeeeiiiinoooooouuuuyy''\"\"--")
SEVERAL = {"ß": "ss", "æ": "ae", "Æ": "AE", "œ": "oe", "Œ": "OE", "ð": "d", "Ð": "D", "þ": "th", "Þ": "Th"}


def ascii_text(x: Column | str) -> Column:
    """Latin letters without marks; anything else outside ASCII becomes a question mark."""
    x = F.col(x) if isinstance(x, str) else x
    for a, b in SEVERAL.items():
        x = F.replace(x, F.lit(a), F.lit(b))
    return F.regexp_replace(F.translate(x, *SINGLE), r"[^\x00-\x7F]", "?")


def to_ascii(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """All string columns, or ``cols``, in ASCII."""
    names = cols if cols is not None else [c for c, t in df.dtypes if t == "string"]
    return df.withColumns({c: ascii_text(c) for c in names})


def dedupe_names(df: DataFrame, name: str = "name") -> DataFrame:
    """Adds crop, marker (temporary or permanent) and label: the crop, with the marker only where the crop repeats."""
    from pyspark.sql import Window

    crop = F.trim(F.regexp_replace(F.col(name), r"(?i)\b(temporary|permanent)\b", ""))
    crop = F.regexp_extract(crop, r"([^ ]+(?: [^ ]+)?)$", 1)
    marker = F.lower(F.regexp_extract(F.col(name), r"(?i)\b(temporary|permanent)\b", 1))
    df = df.withColumn("crop", crop).withColumn("marker", F.when(marker != "", marker))
    n = F.count(F.lit(1)).over(Window.partitionBy("crop"))
    return df.withColumn("label", F.when((n > 1) & F.col("marker").isNotNull(), F.concat_ws(" ", "crop", "marker")).otherwise(F.col("crop")))

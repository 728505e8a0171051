"""Text formats of grids and point tables, read line by line with expressions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fixed_width_values(lines: DataFrame, width: int = 14, row_length: int | None = None, per_line: int = 5, keys: list[str] | None = None) -> DataFrame:
    """``row, col, value`` of numbered ``lines(line, value)`` of fixed-width numbers (of several grids by ``keys``); grid rows fill whole lines, the last one padded."""
    keys = keys or []
    cells = lines.select(*keys, "line", F.posexplode(F.regexp_extract_all("value", F.lit(f"(.{{{width}}})"), F.lit(1))).alias("k", "text"))
    numbers = cells.select(*keys, (F.col("line") * per_line + F.col("k")).alias("at"), F.trim("text").cast("double").alias("value"))
    if row_length is None:
        return numbers
    padded = -(-row_length // per_line) * per_line
    return numbers.select(*keys, F.floor(F.col("at") / padded).cast("int").alias("row"), (F.col("at") % padded).cast("int").alias("col"), "value").filter(F.col("col") < row_length)


def inventory(lines: DataFrame) -> DataFrame:
    """``file, line, name, lat, lon, mean, deepest, problem`` of tables in ``lines(file, line, value)``: words and bars apart by blanks.

    A row begins with a letter and has name and country, then a number, place, mean and greatest depth and a reference; one that goes on from the row above has place and reference only, and no
    depths. Rules, prose and headings are passed over; a row with other fields is a problem; a numbered list of references ends a file's table.
    """
    trimmed = lines.select("file", "line", F.trim("value").alias("value"))
    stops = trimmed.filter(F.regexp_like("value", F.lit(r"^\d+\.\s"))).groupBy("file").agg(F.min("line").alias("_stop"))
    rows = trimmed.join(stops, "file", "left").filter(F.col("_stop").isNull() | (F.col("line") < F.col("_stop")))
    words = F.filter(F.split(F.translate("value", "|", " "), r"\s+"), lambda w: w != "")
    rows = rows.filter(F.regexp_like("value", F.lit(r"^\p{L}"))).select("file", "line", F.get(words, F.lit(0)).alias("name"), F.slice(words, 3, F.greatest(F.size(words), F.lit(1))).alias("f"))
    rows = rows.filter(F.regexp_like(F.get("f", F.lit(0)), F.lit(r"^\d")))
    at = lambda full, short: F.when(F.size("f") == 6, F.get("f", F.lit(full)).try_cast("double")).when(F.size("f") == 3, F.get("f", F.lit(short)).try_cast("double") if short is not None else None)
    return rows.select("file", "line", "name", at(1, 0).alias("lat"), at(2, 1).alias("lon"), at(3, None).alias("mean"), at(4, None).alias("deepest"), F.when(~F.size("f").isin(3, 6), "fields").alias("problem"))


def points(lines: DataFrame, comment: str = "#") -> DataFrame:
    """``lon, lat, value`` of white-space or comma separated lines; comments and rows of zeros are dropped."""
    f = F.split(F.trim("value"), r"[\s,]+")
    rows = lines.filter((F.trim("value") != "") & ~F.startswith(F.trim("value"), F.lit(comment))).select(*(F.try_element_at(f, F.lit(i + 1)).try_cast("double").alias(n) for i, n in enumerate(("lon", "lat", "value"))))
    return rows.filter("lon is not null and lat is not null and not (lon = 0 and lat = 0 and value = 0)")

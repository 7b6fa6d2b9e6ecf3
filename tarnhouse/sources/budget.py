"""Budget sheets: a cross-tab CSV with title rows and three stacked header rows."""

from __future__ import annotations

import csv

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Layout of the sheet, counted in lines from the top.
TITLE_LINES = 3
HEADER_LINES = 3
LABEL_COLUMNS = 2

# windows-1252 and iso-8859-1 differ only in the bytes 0x80 to 0x9f. Spark's CSV
# reader takes iso-8859-1 by default, so those bytes are mapped afterwards.
_HIGH_BYTES = [b for b in range(0x80, 0xA0) if b not in (0x81, 0x8D, 0x8F, 0x90, 0x9D)]
_LATIN1 = bytes(_HIGH_BYTES).decode("latin-1")
_CP1252 = bytes(_HIGH_BYTES).decode("cp1252")


def join_path(folder: str, file: str) -> str:
    """Folder and file joined with the separator the folder calls for."""
    slash = "\\" if "\\" in folder and "/" not in folder else "/"
    return folder + ("" if folder.endswith(slash) else slash) + file


def _header(spark: SparkSession, path: str) -> list[list[str]]:
    """The title and header lines. They open the sheet, so they lie in its first block."""
    lines = (
        spark.read.option("encoding", "ISO-8859-1").text(path).head(TITLE_LINES + HEADER_LINES)
    )
    return list(csv.reader(row["value"] for row in lines))


def scan_budget(spark: SparkSession, folder: str, file: str) -> DataFrame:
    """The raw sheet, one string column per sheet column and no header promoted."""
    path = join_path(folder, file)
    width = len(_header(spark, path)[-1])
    names = [f"Column{i}" for i in range(1, width + 1)]
    sheet = (
        spark.read.schema(", ".join(f"{n} string" for n in names))
        .option("encoding", "ISO-8859-1")
        .csv(path)
    )
    return sheet.select(*[F.translate(n, _LATIN1, _CP1252).alias(n) for n in names])


def unpivot_budget(spark: SparkSession, folder: str, file: str) -> DataFrame:
    """The sheet in long form: Category, Segment, Scenario, Year, Month, Amount.

    Blank cells yield no row. The three header values travel in the unpivoted
    label, so no join back to a header table is needed.
    """
    header = _header(spark, join_path(folder, file))
    scenarios, years, months = header[TITLE_LINES : TITLE_LINES + HEADER_LINES]
    sheet = scan_budget(spark, folder, file)
    labels, values = sheet.columns[:LABEL_COLUMNS], sheet.columns[LABEL_COLUMNS:]
    names = {
        c: "|".join(part)
        for c, *part in zip(values, scenarios[2:], years[2:], months[2:], strict=True)
    }
    # Header lines have no category, the last one repeats its own label, and the title
    # line has no amounts.
    category = F.col(labels[0])
    body = sheet.filter(category.isNotNull() & (category != months[0]))
    long = (
        body.select(
            F.col(labels[0]).alias("Category"),
            F.col(labels[1]).alias("Segment"),
            *[F.col(c).cast("double").alias(name) for c, name in names.items()],
        )
        .unpivot(["Category", "Segment"], list(names.values()), "label", "Amount")
        .filter(F.col("Amount").isNotNull())
    )
    part = F.split("label", r"\|")
    return long.select(
        "Category",
        "Segment",
        part[0].alias("Scenario"),
        part[1].cast("int").alias("Year"),
        part[2].alias("Month"),
        "Amount",
    )

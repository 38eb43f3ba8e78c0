"""A1 / A2 / A6 — raw all-string CSV scan, structure check, table sinks.

Records are read as the format defines them: a quoted field may hold separators
and line ends (``multiLine``), and a record that is longer or shorter than the
header is kept as it is and reported, never cut.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

REPLACEMENT_CHAR = "�"
RECORD = "__record"


def _cp1252_translation() -> tuple[str, str]:
    """ISO-8859-1 → windows-1252: the two differ only in bytes 0x80–0x9F (table from Python's codec)."""
    src, dst = [], []
    for b in range(0x80, 0xA0):
        try:
            ch = bytes([b]).decode("cp1252")
        except UnicodeDecodeError:
            continue
        src.append(chr(b))
        dst.append(ch)
    return "".join(src), "".join(dst)


def _reader(spark: SparkSession, encoding: str, sep: str):
    return (spark.read.option("multiLine", True).option("inferSchema", False).option("encoding", encoding).option("sep", sep)
            .option("quote", '"').option("escape", '"').option("mode", "PERMISSIVE").option("enforceSchema", True))


def raw_header(spark: SparkSession, path: str, encoding: str = "UTF-8", sep: str = ",") -> list[str]:
    """The names of the first record as they stand, blanks and repeats included."""
    first = _reader(spark, encoding, sep).option("header", False).csv(path).limit(1).collect()  # one record
    if not first:
        raise ValueError(f"CSV is empty: {path}")
    return [(v or "").removeprefix("\ufeff") for v in first[0]]


def column_names(header: list[str]) -> list[str]:
    """One column name per header field: blank and repeated names get their position."""
    return [h if h.strip() and header.count(h) == 1 else f"{h.strip() or 'column'}_{i + 1}" for i, h in enumerate(header)]


def record_values(record: Column, sep: str = ",") -> Column:
    """The fields of one raw record, quotes taken off."""
    s = "\\" + sep if sep in "|.^$*+?()[]{}\\" else sep
    fields = F.regexp_extract_all(F.concat(record, F.lit(sep)), F.lit(f'("(?:[^"]|"")*"|[^{s}"]*){s}'), 1)
    return F.transform(fields, lambda v: F.when(v.startswith('"'), F.replace(F.substring(v, F.lit(2), F.length(v) - 2), F.lit('""'), F.lit('"')))
                       .otherwise(v))


def _records(spark: SparkSession, path: str, encoding: str, sep: str, width: int) -> DataFrame:
    """``_0 … _n`` and ``RECORD``: the raw text of the records whose width isn't the header's."""
    schema = StructType([StructField(f"_{i}", StringType()) for i in range(width)] + [StructField(RECORD, StringType())])
    return _reader(spark, encoding, sep).option("header", True).option("columnNameOfCorruptRecord", RECORD).schema(schema).csv(path)


def read_raw_csv(spark: SparkSession, path: str, fallback_encoding: str = "windows-1252", sep: str = ",",
                 extra_col: str | None = None) -> DataFrame:
    """A1: header + rows as raw strings; blanks stay '' (NULL ≡ blank), no type inference.

    Short records are filled with ''. Fields beyond the header go to ``extra_col``
    (array<string>, empty where there are none); without it such a record raises,
    since leaving them out would lose data. Blank and repeated header names get
    their position (``column_names``; ``header_issues`` reports them).

    UTF-8 first (a BOM is stripped by the reader); if any value holds U+FFFD the
    file was not UTF-8 and is re-read as windows-1252 (one count action). Spark's
    CSV source accepts ISO-8859-1 but not windows-1252, so the file is read as
    ISO-8859-1 and the 0x80–0x9F block is translated. An empty file is an error.
    """
    src, dst = _cp1252_translation()

    def scan(encoding: str) -> DataFrame:
        cp1252 = encoding.lower() in ("windows-1252", "cp1252")
        enc = "ISO-8859-1" if cp1252 else encoding
        header = raw_header(spark, path, enc, sep)
        names = column_names([h.translate(str.maketrans(src, dst)) if cp1252 else h for h in header])
        rows = _records(spark, path, enc, sep, len(header)).withColumn(
            "__odd", F.when(F.col(RECORD).isNotNull(), record_values(F.col(RECORD), sep)))
        fix = (lambda v: F.translate(v, src, dst)) if cp1252 else (lambda v: v)
        out = []
        for i, name in enumerate(names):
            v = F.coalesce(F.when(F.col("__odd").isNotNull(), F.get("__odd", F.lit(i))).otherwise(F.col(f"_{i}")), F.lit(""))
            out.append(fix(v).alias(name))
        extra = F.when(F.size("__odd") > len(names), F.slice("__odd", len(names) + 1, F.size("__odd")))
        if extra_col:
            out.append(F.coalesce(F.transform(extra, fix), F.array().cast("array<string>")).alias(extra_col))
        else:
            out[0] = F.when(extra.isNotNull(), F.raise_error(F.concat(F.lit("record is longer than the header: "), F.col(RECORD)))) \
                .otherwise(out[0]).alias(names[0])
        return rows.select(*out)

    df = scan("UTF-8")
    bad = None
    for c in df.columns:
        if c != extra_col:
            cond = F.col(f"`{c}`").contains(REPLACEMENT_CHAR)
            bad = cond if bad is None else (bad | cond)
    if df.filter(bad).limit(1).count() > 0:
        df = scan(fallback_encoding)
    return df


def csv_structure(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """A2: histogram of record widths; the header record isn't counted, equal data records are."""
    n = len(raw_header(spark, path, sep=sep))
    rows = _records(spark, path, "UTF-8", sep, n)
    width = F.when(F.col(RECORD).isNull(), F.lit(n)).otherwise(F.size(record_values(F.col(RECORD), sep)))
    # the raw text can only be asked for beside a data column
    parts = rows.groupBy(width.alias("width"), F.col("_0").isNull().alias("blank")).agg(F.count(F.lit(1)).alias("n"))
    return parts.groupBy("width").agg(F.sum("n").alias("rows"))


def header_issues(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """A2 header part: (position, name, issue) of blank and repeated names in the first record."""
    header = raw_header(spark, path, sep=sep)
    rows = [(i + 1, h, "blank") for i, h in enumerate(header) if not h.strip()]
    rows += [(i + 1, h, "duplicate") for i, h in enumerate(header) if h.strip() and h in header[:i]]
    return spark.createDataFrame(rows, "position int, name string, issue string")


def write_table(df: DataFrame, path: str, fmt: str = "csv", allow_empty: bool = False,
                mode: str = "overwrite") -> str:
    """Table sink (csv/json/parquet/xml). An empty table raises unless ``allow_empty``."""
    if not allow_empty and df.isEmpty():
        raise ValueError(f"refusing to write an empty table to {path}")
    w = df.write.mode(mode)
    if fmt == "csv":
        w.option("header", True).csv(path)
    elif fmt == "json":
        w.json(path)
    elif fmt == "parquet":
        w.parquet(path)
    else:
        w.format(fmt).save(path)
    return path

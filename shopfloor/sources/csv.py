"""CSV sources.

* Every field is read as text; the pandas NA tokens become NULL; then one
  aggregate pass decides which columns are wholly numeric (integral ->
  bigint, else double).  Time columns are parsed later by the extract step.
* File order: each row keeps its file, its split start and its sequence
  inside the split (``_metadata`` + ``monotonically_increasing_id``).  A
  split is a natural bucket of the order, so the ordered pass needs no
  range bucketing here (``csv_order``).
* Encoding: Spark never fails on bad UTF-8, so the text of each file is probed with
  ``is_valid_utf8``; files that are not UTF-8 are read as ISO-8859-1, the others of
  the same folder as UTF-8.
* Quoting follows RFC 4180: quotes are doubled inside quotes, and a quoted field
  may hold line breaks.  Such a file cannot be split, so the probe looks for lines
  with an odd number of quotes and reads those files whole, one task each;
  ``multi_line`` declares it instead.
* A file that cannot be split (compressed, or with line breaks in quotes) comes out
  of its scan in one task.  Its rows are staged once, as many small files, and
  numbered chunks of them take the place of the splits as buckets of the order.  Of a
  compressed file the lines are staged as they are: that task unpacks and does no
  more, the probe and the parser run over the staged lines.
* Rows with fewer or more fields than the header are kept (missing fields NULL, extra
  ones dropped) or, with ``malformed='quarantine'``, carried with their text in a
  column of their own, which ``split_malformed`` sets aside with the reason.
* A number is a number by its text (sign, digits, point, exponent), not by what a
  cast accepts: ``1D`` stays an identifier.
* Cost at scale: inference reads the input once more, the probe of encoding and
  quotes once.  Production jobs pass ``schema=`` (declared types, applied with
  ``try_cast``), ``encoding=`` and ``multi_line=`` and skip both.
* A missing path gives ``None`` (the caller decides: the sensor source
  stops the run, the quality source means 'not_checked').
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import session
from ..operators.ordered import RowOrder
from ..schemas import NA_TOKENS

# How a number is written.
NUMBER = r"^[+-]?((\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?|(?i:inf|infinity))$"

FILE_COL, BLOCK_COL, CHUNK_COL, SEQ_COL = "_src_file", "_src_block", "_src_chunk", "_src_seq"
ORDER_COLS = (FILE_COL, BLOCK_COL, CHUNK_COL, SEQ_COL)
MALFORMED_COL = "_src_malformed"
CHUNK_ROWS = 1 << 20             # rows of a bucket of a file that cannot be split
# Suffixes of the compressions that Spark cannot split.
UNSPLITTABLE = (".gz", ".gzip", ".zst", ".deflate", ".snappy", ".lz4")


def csv_order(df: DataFrame | None = None) -> RowOrder:
    """Row order of a frame from ``read_csv``: (file, split start, chunk where the
    file was staged) buckets, sequence inside the split."""
    chunked = df is not None and CHUNK_COL in df.columns
    return RowOrder.explicit([FILE_COL, BLOCK_COL, *[CHUNK_COL] * chunked], SEQ_COL)


def probe_files(spark: SparkSession, path) -> list:
    """By file: ``file``, ``encoding`` and whether a quoted field spans lines
    (``spans``), from one scan of the text.  One small row for each file, as the
    planner of the read that follows holds them."""
    return _probed(spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file")))


def _probed(text: DataFrame, *aggs: Column) -> list:
    line = F.col("value")
    quotes = F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))
    return text.groupBy("file").agg(
        F.when(F.count_if(~F.is_valid_utf8(line)) == 0, "UTF-8").otherwise("ISO-8859-1").alias("encoding"),
        (F.count_if(quotes % 2 == 1) > 0).alias("spans"), *aggs).collect()


def probe(spark: SparkSession, path) -> tuple[str, bool]:
    """(the one encoding that reads every file, whether a quoted field spans lines in any)."""
    found = probe_files(spark, path)
    return ("ISO-8859-1" if any(f.encoding != "UTF-8" for f in found) else "UTF-8"), any(f.spans for f in found)


def detect_encoding(spark: SparkSession, path) -> str:
    return probe(spark, path)[0]


# How fields are written: for the reader of files and for the parser of staged lines.
FORMAT = {"mode": "PERMISSIVE", "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "false",
          "ignoreTrailingWhiteSpace": "false", "nullValue": ""}


def _na_to_null(column: Column, name: str) -> Column:
    return F.when(column.isin(*NA_TOKENS), F.lit(None)).otherwise(column).alias(name)


def _scan_packed(spark: SparkSession, path, encoding: str | None, multi_line: bool | None, malformed: str) -> DataFrame | None:
    """``_scan`` and ``spread`` of compressed files, by their staged lines; None where
    the files are others, or fields hold line breaks."""
    if multi_line or encoding not in (None, "UTF-8", "ISO-8859-1"):
        return None
    text = spark.read.text(path)
    if not all(f.lower().endswith(UNSPLITTABLE) for f in text.inputFiles()):
        return None
    lines = spread(text.select("value", F.col("_metadata.file_path").alias(FILE_COL),
                               F.col("_metadata.file_block_start").alias(BLOCK_COL),
                               F.monotonically_increasing_id().alias(SEQ_COL)))
    filled = F.col("value").rlike(r"[^\x00-\x20]")              # the others are no records
    found = _probed(lines.withColumnRenamed(FILE_COL, "file"), F.min(F.when(filled, F.col(SEQ_COL))).alias("header"))
    if multi_line is None and any(f.spans for f in found):
        return None
    first: dict[str, str] = {}                                   # of the files of one encoding
    for f in sorted(found, key=lambda f: f.file):
        first.setdefault(encoding or f.encoding, f.file)
    heads = [spark.read.options(**FORMAT).option("header", True).option("encoding", e).csv(f).columns for e, f in first.items()]
    if not heads or any(h != heads[0] for h in heads):
        return None
    names = heads[0]
    latin = [f.file for f in found if (encoding or f.encoding) == "ISO-8859-1"]
    record = F.when(F.col(FILE_COL).isin(*latin), F.decode(F.col("value").cast("binary"), "ISO-8859-1")) \
        .otherwise(F.col("value")) if latin else F.col("value")
    fields = [*names, *[MALFORMED_COL] * (malformed == "quarantine")]
    schema = ", ".join(f"`{c.replace('`', '``')}` STRING" for c in fields)
    options = FORMAT | ({"columnNameOfCorruptRecord": MALFORMED_COL} if malformed == "quarantine" else {})
    rows = lines.where(filled & ~F.col(SEQ_COL).isin(*[f.header for f in found if f.header is not None])).select(
        F.from_csv(record, schema, options).alias("__row"), *ORDER_COLS)
    cols = [_na_to_null(F.col("__row").getField(c), c) for c in names]
    if malformed == "quarantine":
        cols.append(F.col("__row").getField(MALFORMED_COL).alias(MALFORMED_COL))
    # parsed once: inference and the steps that follow read columns
    parsed = rows.select(*cols, *ORDER_COLS)
    path = session.scratch_path(spark, f"shopfloor-parsed-{uuid.uuid4().hex}")
    parsed.write.option("maxRecordsPerFile", CHUNK_ROWS).parquet(path)
    return spark.read.schema(parsed.schema).parquet(path)


def _scan(spark: SparkSession, path, encoding: str, multi_line: bool, keep_order: bool, malformed: str,
          names: list[str] | None = None) -> DataFrame:
    """One read of files alike: text columns, NA tokens NULL, then the order columns."""
    reader = (spark.read.option("header", True).option("inferSchema", False)
              .option("encoding", encoding).option("mode", "PERMISSIVE")
              .option("quote", '"').option("escape", '"').option("multiLine", multi_line)
              .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
              .option("nullValue", ""))
    raw = reader.csv(path)
    names = raw.columns if names is None else names
    if malformed == "quarantine":
        schema = T.StructType([T.StructField(c, T.StringType()) for c in [*raw.columns, MALFORMED_COL]])
        # all fields are parsed, whatever is read of them: else their number would go unnoticed
        raw = (reader.schema(schema).option("columnNameOfCorruptRecord", MALFORMED_COL).option("columnPruning", False)
               .csv(path))
    if sorted(names) != sorted(c for c in raw.columns if c != MALFORMED_COL):
        raise ValueError(f"files of one source differ in their columns: {names} and {raw.columns}")
    cols = [F.when(F.col(f"`{c}`").isin(*NA_TOKENS), F.lit(None)).otherwise(F.col(f"`{c}`")).alias(c) for c in names]
    if malformed == "quarantine":
        # Spark refuses a query of that column alone: a data column is read with it
        read = F.length(F.concat_ws("", F.col(f"`{names[0]}`"))) >= 0
        cols.append(F.when(read, F.col(MALFORMED_COL)).alias(MALFORMED_COL))
    if keep_order:
        cols += [F.col("_metadata.file_path").alias(FILE_COL),
                 F.col("_metadata.file_block_start").alias(BLOCK_COL),
                 F.monotonically_increasing_id().alias(SEQ_COL)]
    return raw.select(*cols)


def spread(df: DataFrame, rows: int | None = None) -> DataFrame:
    """Rows of files that Spark cannot split, staged once (the task that reads such a
    file writes many small ones) and cut into chunks of ``rows``: the steps that
    follow run over chunks, not files."""
    rows = rows or CHUNK_ROWS
    path = session.scratch_path(df.sparkSession, f"shopfloor-spread-{uuid.uuid4().hex}")
    df.write.option("maxRecordsPerFile", rows).parquet(path)
    staged = df.sparkSession.read.schema(df.schema).parquet(path)
    in_task = F.col(SEQ_COL).bitwiseAND((1 << 33) - 1)       # the sequence counts up from 0 in the low 33 bits
    return staged.withColumn(CHUNK_COL, F.floor(in_task / F.lit(rows)).cast("long"))


def read_csv(spark: SparkSession, path, encoding: str | None = "UTF-8",
             infer_numeric: bool = True, keep_order: bool = True,
             schema: dict[str, str] | None = None, multi_line: bool | None = None,
             malformed: str = "keep") -> DataFrame:
    """Read CSV text with header.  ``encoding=None`` and ``multi_line=None`` probe the
    text, file by file, and files that differ are read apart and united by column
    name.  ``schema`` (column -> Spark type name) replaces inference; a value that
    does not fit its type becomes NULL.  ``malformed``: see the module."""
    if malformed not in ("keep", "quarantine"):
        raise ValueError("malformed must be 'keep' or 'quarantine'")
    packed = _scan_packed(spark, path, encoding, multi_line, malformed) if keep_order else None
    if packed is not None:
        return _typed(packed, schema, infer_numeric)
    kinds: dict[tuple[str, bool], list[str]] = {}
    if encoding is None or multi_line is None:
        for f in probe_files(spark, path):
            kind = (encoding or f.encoding, f.spans if multi_line is None else multi_line)
            kinds.setdefault(kind, []).append(f.file)
    if len(kinds) > 1:
        parts = [_scan(spark, sorted(files), *kind, keep_order, malformed) for kind, files in sorted(kinds.items())]
        df = parts[0]
        for p in parts[1:]:
            if sorted(p.columns) != sorted(df.columns):
                raise ValueError(f"files of one source differ in their columns: {df.columns} and {p.columns}")
            df = df.unionByName(p)
    else:
        encoding, multi_line = next(iter(kinds), (encoding or "UTF-8", bool(multi_line)))
        df = _scan(spark, path, encoding, multi_line, keep_order, malformed)
    whole = multi_line or any(spans for _, spans in kinds) or any(f.lower().endswith(UNSPLITTABLE) for f in df.inputFiles())
    if keep_order and whole:
        df = spread(df)
    return _typed(df, schema, infer_numeric)


def _typed(df: DataFrame, schema: dict[str, str] | None, infer_numeric: bool) -> DataFrame:
    names = [c for c in df.columns if c not in (*ORDER_COLS, MALFORMED_COL)]
    if schema:
        return df.select(*[F.col(f"`{c}`").try_cast(schema[c]).alias(c) if c in schema
                           else F.col(f"`{c}`") for c in df.columns])
    return infer_numeric_columns(df, names) if infer_numeric else df


def split_malformed(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows, quarantine) of a frame read with ``malformed='quarantine'``.  The
    quarantine has each such row's first field as read, its text, its place in the
    source, the number of its fields and the ``reason``: 'quote' (a quote that does
    not close), 'short' or 'long'."""
    names = [c for c in df.columns if c not in (*ORDER_COLS, MALFORMED_COL)]
    text = F.col(MALFORMED_COL)
    bare = F.regexp_replace(text, '"([^"]|"")*"', "")              # quoted fields hold no separators
    fields = F.size(F.split(bare, ",", -1))
    reason = F.when(F.contains(bare, F.lit('"')), "quote").when(fields < len(names), "short").otherwise("long")
    bad = df.where(text.isNotNull()).select(
        F.col(f"`{names[0]}`").cast("string").alias("first_field"), text.alias("record"),
        fields.alias("fields"), reason.alias("reason"), *[c for c in ORDER_COLS if c in df.columns])
    return df.where(text.isNull()).drop(MALFORMED_COL), bad


def malformed_counts(df: DataFrame) -> DataFrame:
    """Rows in quarantine per reason."""
    return split_malformed(df)[1].groupBy("reason").agg(F.count(F.lit(1)).alias("rows"))


def infer_numeric_columns(df: DataFrame, names: list[str]) -> DataFrame:
    """One aggregate job: a column whose non-null values all parse as
    numbers becomes bigint (all integral) or double.  Rows for the quarantine have
    no say, and are read with ``try_cast``."""
    if not names:
        return df
    aggs = []
    for i, c in enumerate(names):
        v = F.col(f"`{c}`")
        d = F.when(F.trim(v).rlike(NUMBER), v.try_cast("double"))
        aggs += [F.count_if(v.isNotNull() & d.isNull()).alias(f"nonnum_{i}"),
                 F.count_if(d.isNotNull() & (v.try_cast("long").isNull())).alias(f"nonint_{i}"),
                 F.count(v).alias(f"n_{i}")]
    told = df.where(F.col(MALFORMED_COL).isNull()) if MALFORMED_COL in df.columns else df
    stats = told.agg(*aggs).first()
    out = []
    for i, c in enumerate(names):
        v = F.col(f"`{c}`")
        if stats[f"n_{i}"] == 0 or stats[f"nonnum_{i}"] > 0:
            out.append(v.alias(c))
        elif stats[f"nonint_{i}"] == 0:
            out.append(v.try_cast("long").alias(c))
        else:
            out.append(v.try_cast("double").alias(c))
    rest = [F.col(c) for c in df.columns if c not in names]
    return df.select(*out, *rest)


def read_csv_tolerant(spark: SparkSession, path: str, encoding: str | None = "UTF-8",
                      **kw) -> DataFrame | None:
    """A missing path gives None instead of an error."""
    try:
        return read_csv(spark, path, encoding=encoding, **kw)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def scan_sensor_csv(spark: SparkSession, path: str, schema: dict[str, str] | None = None,
                    multi_line: bool | None = None, malformed: str = "keep") -> DataFrame | None:
    """A1: sensor CSV, UTF-8."""
    return read_csv_tolerant(spark, path, encoding="UTF-8", schema=schema, multi_line=multi_line, malformed=malformed)


def scan_quality_csv(spark: SparkSession, path: str, encoding: str | None = None,
                     schema: dict[str, str] | None = None, multi_line: bool | None = None,
                     malformed: str = "keep") -> DataFrame | None:
    """A2: quality CSV, each file UTF-8 or else ISO-8859-1 (probed unless given)."""
    return read_csv_tolerant(spark, path, encoding=encoding, schema=schema, multi_line=multi_line, malformed=malformed)


def drop_order_columns(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in ORDER_COLS if c in df.columns])


def write_csv(df: DataFrame, path: str, order_by: str | None = None,
              encoding: str = "UTF-8", compression: str = "none", one_file: bool = False) -> str:
    """Write a frame as headed CSV whose file order follows ``order_by``."""
    if order_by is not None:
        # one file: its rows are made by many tasks, one sorts and writes them
        df = df.repartition(1).sortWithinPartitions(order_by) if one_file else df.orderBy(order_by)
    (df.write.option("compression", compression).mode("overwrite").option("header", True).option("encoding", encoding)
     .option("quote", '"').option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS")
     .option("nullValue", "").csv(path))
    return path


# --- registered queries (CSV round trip of the fixture views) -----------

def _register():
    from ..plans import pipeline
    from ..plans.catalog import register
    from ..plans.oracle import summary_rounded
    from ..plans.reports import round_doubles
    from . import extract, fixtures

    def staged(spark, sf_dir, which: str, encoding: str) -> str:
        session.configure(spark)
        src = fixtures.sensor_raw(spark, sf_dir) if which == "sensor" else fixtures.quality_raw(spark, sf_dir)
        path = session.scratch_path(spark, f"shopfloor-csv-{which}-{uuid.uuid4().hex}")
        return write_csv(src, path, order_by="row_no", encoding=encoding)

    @register("scan_sensor_csv", "SELECT * FROM sensor_raw")
    def q_scan_sensor_csv(spark, sf_dir):
        df = scan_sensor_csv(spark, staged(spark, sf_dir, "sensor", "UTF-8"))
        df, _ = extract.parse_first_time_column(df)
        return drop_order_columns(df)

    @register("scan_quality_csv", "SELECT * FROM quality_raw")
    def q_scan_quality_csv(spark, sf_dir):
        df = scan_quality_csv(spark, staged(spark, sf_dir, "quality", "ISO-8859-1"))
        df, _ = extract.parse_first_time_column(df)
        return drop_order_columns(df)

    @register("parse_mixed_times", """
SELECT event_id, CASE WHEN event_id % 8 IN (5, 6) THEN date_trunc('minute', ts)
                      WHEN event_id % 8 = 7 THEN CAST(CAST(ts AS DATE) AS TIMESTAMP) ELSE ts END AS parsed
FROM events""")
    def q_parse_mixed_times(spark, sf_dir):
        """Every event's time written in one of eight layouts and parsed back."""
        from ..functions.scalars import parse_event_time
        from .tables import read_table
        ts = F.col("ts")
        text = lambda fmt, t=ts: F.date_format(t, fmt)
        written = F.array(
            F.concat(text("yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z")),
            F.concat(text("yyyy-MM-dd HH:mm:ss.SSSSSS", ts + F.expr("INTERVAL '5:30' HOUR TO MINUTE")), F.lit("+05:30")),
            F.concat(text("yyyy/M/d H:mm:ss.SSSSSS"), F.lit("000")),
            text("d-MMM-yyyy HH:mm:ss.SSSSSS"),
            text("MMMM d, yyyy hh:mm:ss.SSSSSS a"),
            text("M/d/yyyy H:mm"),
            F.when(F.dayofmonth(ts) > 12, text("dd.MM.yyyy HH:mm")).otherwise(text("MM.dd.yyyy HH:mm")),
            text("yyyy-MM-dd"))
        events = read_table(spark, sf_dir, "events").select("event_id", written[F.col("event_id") % 8].alias("time"))
        return events.select("event_id", parse_event_time(F.col("time")).alias("parsed"))

    @register("scan_mixed_charsets", """
SELECT row_no, replace(defect_type, 'defect', 'défaut') AS defect_type, result || ' – ß' AS result FROM quality_raw""")
    def q_scan_mixed_charsets(spark, sf_dir):
        """One folder with files in UTF-8 and files in ISO-8859-1: each row's text as written."""
        session.configure(spark)
        rows = fixtures.quality_raw(spark, sf_dir).select(
            "row_no", F.replace("defect_type", F.lit("defect"), F.lit("défaut")).alias("defect_type"),
            F.concat("result", F.lit(" – ß")).alias("result"))
        path = session.scratch_path(spark, f"shopfloor-csv-mixed-{uuid.uuid4().hex}")
        odd = F.col("row_no") % 2 == 1
        latin = rows.where(odd).withColumn("result", F.replace("result", F.lit("–"), F.lit("-")))   # has no such dash
        folders = [write_csv(rows.where(~odd), f"{path}/utf8"), write_csv(latin, f"{path}/latin", encoding="ISO-8859-1")]
        found = read_csv(spark, folders, encoding=None)
        dash = F.when(odd, F.replace("result", F.lit("-"), F.lit("–"))).otherwise(F.col("result"))
        return drop_order_columns(found).withColumn("result", dash)

    @register("scan_compressed_csv", "SELECT * FROM sensor_std")
    def q_scan_compressed_csv(spark, sf_dir):
        """Readings from one compressed file, cleaned and numbered over bounded chunks of it."""
        from ..operators.clean import clean_sensor_data
        from ..operators.standardize import POSITION_COL, standardize_data

        session.configure(spark)
        path = session.scratch_path(spark, f"shopfloor-csv-gzip-{uuid.uuid4().hex}")
        write_csv(fixtures.sensor_raw(spark, sf_dir), path, order_by="row_no", compression="gzip", one_file=True)
        raw = extract.extract_sensor(scan_sensor_csv(spark, path))
        order = csv_order(raw)
        return drop_order_columns(standardize_data(clean_sensor_data(raw, order, position_col=POSITION_COL), order))

    @register("quarantine_malformed", """
SELECT row_no, CASE WHEN row_no % 37 = 0 THEN 'long' WHEN row_no % 41 = 0 THEN 'short' ELSE 'read' END AS reason,
       CASE WHEN row_no % 37 <> 0 AND row_no % 41 <> 0 THEN line_id END AS line_id
FROM sensor_raw""")
    def q_quarantine_malformed(spark, sf_dir):
        """Lines with a field too many or too few set aside with the reason, the others read."""
        session.configure(spark)
        rows = fixtures.sensor_raw(spark, sf_dir)
        names = [c for c in rows.columns if c != "row_no"]
        line = F.concat_ws(",", "row_no", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in names])
        damaged = F.when(F.col("row_no") % 37 == 0, F.concat(line, F.lit(",more"))) \
            .when(F.col("row_no") % 41 == 0, F.substring_index(line, ",", len(names))).otherwise(line)
        path = session.scratch_path(spark, f"shopfloor-csv-malformed-{uuid.uuid4().hex}")
        head = spark.range(4).select(F.col("id").alias("part"), F.lit(",".join(["row_no", *names])).alias("value"), F.lit(-1).alias("at"))
        lines = rows.select((F.col("row_no") % 4).alias("part"), damaged.alias("value"), F.col("row_no").alias("at"))
        (lines.unionByName(head).repartition("part").sortWithinPartitions("part", "at").drop("at")
         .write.partitionBy("part").text(path))
        found = read_csv(spark, [f"{path}/part={k}" for k in range(4)], malformed="quarantine")
        good, bad = split_malformed(found)
        return good.select(F.col("row_no").cast("long"), F.lit("read").alias("reason"), "line_id").unionByName(
            bad.select(F.col("first_field").cast("long").alias("row_no"), "reason", F.lit(None).cast("string").alias("line_id")))

    @register("tolerant_source",
              "SELECT 'not_checked' AS quality_status, count(*) AS count FROM sensor_raw")
    def q_tolerant_source(spark, sf_dir):
        missing = session.scratch_path(spark, f"shopfloor-missing-{uuid.uuid4().hex}")
        quality = scan_quality_csv(spark, missing)
        p = pipeline.build(fixtures.sensor_raw(spark, sf_dir), quality)
        return p.joined.groupBy("quality_status").agg(F.count(F.lit(1)).alias("count"))

    @register("csv_pipeline_summary", f"SELECT {summary_rounded()} FROM summary")
    def q_csv_pipeline_summary(spark, sf_dir):
        """The whole job from CSV files, file order from the scan (not row_no)."""
        sensor = scan_sensor_csv(spark, staged(spark, sf_dir, "sensor", "UTF-8"))
        quality = scan_quality_csv(spark, staged(spark, sf_dir, "quality", "ISO-8859-1"))
        p = pipeline.build(sensor, quality, sensor_order=csv_order(), quality_order=csv_order())
        return round_doubles(p.hourly)


_register()

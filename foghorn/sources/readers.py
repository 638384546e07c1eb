"""File readers: declared schemas, back-fill, aliases, header sniffing, recursive scans."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from foghorn import vocab
from foghorn.functions import dates as dx, text as tx
from foghorn.plans.events import canonical_events, filter_universe, normalise_members
from foghorn.operators.rows import seeded_head
from foghorn.schemas import EVENT, UNIVERSE, UNIVERSE_COLUMNS


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists on whatever file system its scheme names."""
    jvm = spark.sparkContext._jvm
    location = jvm.org.apache.hadoop.fs.Path(path)
    fs = location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(location)


def first_existing(spark: SparkSession, paths: Sequence[str]) -> str | None:
    return next((p for p in paths if exists(spark, p)), None)


def read_any(
    spark: SparkSession, path: str, schema: T.StructType | None = None, line_breaks: bool = True
) -> DataFrame:
    """Parquet or header CSV by extension; CSV columns are matched by header name."""
    if path.rstrip("/").endswith((".csv", ".csv.gz", ".tsv")):
        separator = "\t" if ".tsv" in path else ","
        return all_strings(spark, path, separator, line_breaks)
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def all_strings(spark: SparkSession, path: str, sep: str = ",", line_breaks: bool = True) -> DataFrame:
    """Every CSV column as text, quotes and line breaks inside cells allowed.

    A file whose cells hold no line breaks is cut among tasks with ``line_breaks=False``.
    """
    return (
        spark.read.option("header", True)
        .option("sep", sep)
        .option("multiLine", line_breaks)
        .option("escape", '"')
        .option("mode", "PERMISSIVE")
        .csv(path)
    )


def require(df: DataFrame, columns: Sequence[str], what: str) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{what} lacks columns: {missing}")
    return df


def read_universe(
    spark: SparkSession,
    path: str,
    countries: Sequence[str] = (),
    industries: Sequence[str] = (),
    size_bins: Sequence[str] = (),
    max_companies: int = 0,
    seed: int = 42,
) -> DataFrame:
    """Universe table, filtered, in seeded order when a maximum is asked for."""
    if not exists(spark, path):
        raise FileNotFoundError(path)
    raw = require(read_any(spark, path), ["company_id", "company_name"], path)
    typed = raw.select(
        *[
            (F.col(f.name) if f.name in raw.columns else F.lit(None)).try_cast(f.dataType).alias(f.name)
            for f in UNIVERSE.fields
        ]
    )
    typed = typed.withColumn("company_id", tx.clean_id("company_id"))
    kept = filter_universe(typed, countries, industries, size_bins).select(*UNIVERSE_COLUMNS)
    return seeded_head(kept, "company_id", seed, max_companies) if max_companies else kept


def read_events(spark: SparkSession, path: str) -> DataFrame:
    """Event table with every column; an empty typed table when there is none.

    A folder with a manifest is read at its latest state.
    """
    from foghorn.sources import event_table

    if not exists(spark, path):
        return spark.createDataFrame([], EVENT)
    if event_table.latest(spark, path):
        return event_table.read(spark, path)
    return read_plain_events(spark, path)


def read_plain_events(spark: SparkSession, path: str, line_breaks: bool = True) -> DataFrame:
    """Events from files of any of the formats, without a manifest."""
    raw = read_any(spark, path, line_breaks=line_breaks)
    if dict(raw.dtypes).get("ts") == "string":
        raw = raw.withColumn("ts", dx.parse_ts(F.col("ts")))
    for name in ("signal_strength", "climate_score", "sentiment_score"):
        if dict(raw.dtypes).get(name) == "string":
            raw = raw.withColumn(name, F.col(name).try_cast("double"))
    return canonical_events(raw, strength=0.0)


def read_with_aliases(
    spark: SparkSession,
    path: str,
    required: Sequence[str],
    aliases: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """Required columns filled from the first alias present; empty when the file is absent."""
    if not exists(spark, path):
        return spark.createDataFrame([], T.StructType([T.StructField(c, T.StringType()) for c in required]))
    df = read_any(spark, path)
    for column in required:
        if column not in df.columns:
            other = next((a for a in (aliases or {}).get(column, ()) if a in df.columns), None)
            if other:
                df = df.withColumn(column, F.col(other))
    return require(df, required, path)


# Member files. (signal_type, default source, required columns)
MEMBER_FILES = {
    "sbti": ("sbti", "memberships", ["member_name", "url", "ts"]),
    "re100": ("re100", "memberships", ["member_name", "url", "ts"]),
    "bcorp": ("bcorp", "memberships", ["member_name", "url", "ts"]),
    "ungc": ("ungc", "memberships", ["member_name", "url", "ts"]),
    "linkedin": ("linkedin_membership", "linkedin", ["member_name", "url"]),
}


def read_members(spark: SparkSession, kind: str, path: str, as_of: str) -> DataFrame:
    """One of the five member files, normalised."""
    signal_type, source, required = MEMBER_FILES[kind]
    raw = read_with_aliases(spark, path, required, {"member_name": ["company_name"]})
    return normalise_members(raw, signal_type, source, as_of)


def pick_column(columns: Sequence[str], priorities: Sequence[str], default: str | None = None) -> str | None:
    """Actual spelling of the first priority present, ignoring case."""
    lower = {}
    for c in columns:
        lower[c.lower()] = c
    return next((lower[p] for p in priorities if p in lower), default)


def member_list(
    df: DataFrame, url: str, kind: str, headers: Mapping[str, Sequence[str]] = vocab.LIST_HEADERS
) -> DataFrame:
    """Member rows of a list with unknown headers; the first column is the name by default."""
    name = pick_column(df.columns, headers["member_name"], df.columns[0])

    def optional(role: str) -> Column:
        column = pick_column(df.columns, headers[role])
        return tx.text_or_blank(F.col(f"`{column}`")) if column else F.lit("")

    return df.select(
        F.trim(tx.text_or_blank(F.col(f"`{name}`"))).alias("member_name"),
        F.lit(url).alias("url"),
        optional("ts").alias("ts"),
        F.lit("memberships").alias("source"),
        F.lit(kind).alias("signal_type"),
        optional("country").alias("country"),
        optional("sector").alias("sector"),
    ).filter("member_name <> ''")


_CELL = r',(?:"[^"]*+(?:""[^"]*+)*+"|[^,]*+)'


def _cells(record: Column) -> Column:
    """Cells of a CSV record: quotes removed, doubled ones halved, an empty bare cell null."""
    found = F.regexp_extract_all(F.concat(F.lit(","), F.rtrim(record, F.lit("\r"))), F.lit(_CELL), F.lit(0))

    def plain(cell: Column) -> Column:
        body = F.substring(cell, F.lit(2), F.length(cell))
        closed = body.endswith('"') & (F.length(body) > 1)
        inner = F.substring(body, F.lit(2), F.length(body) - F.when(closed, 2).otherwise(1))
        return F.when(body.startswith('"'), F.replace(inner, F.lit('""'), F.lit('"'))).otherwise(F.nullif(body, F.lit("")))

    return F.transform(found, plain)


def _csv_records(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    """``_file, _record, record`` of all matching files: a record is one line, or several joined by open quotes.

    Files are cut into blocks and blocks into lines, so no task holds a file. Whether a line starts
    inside quotes follows from the quotes before it: those of the file's earlier blocks, summed per
    block, and those of its own block's earlier lines.
    """
    lines = (
        spark.read.option("lineSep", "\n").option("recursiveFileLookup", True).option("pathGlobFilter", pattern)
        .text(folder)
        .select(
            F.col("_metadata.file_path").alias("_file"),
            F.col("_metadata.file_block_start").alias("_block"),
            F.monotonically_increasing_id().alias("_line"),
            "value",
            F.regexp_count("value", F.lit('"')).cast("bigint").alias("_quotes"),
        )
    )
    block, numbers = ["_file", "_block"], ("_upto", "_at", "_even", "_odd")
    own = Window.partitionBy(*block).orderBy("_line").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    none = F.lit(0).cast("bigint")
    # the last line so far that opens a record: _even if an even number of quotes lies before the block, else _odd
    lines = lines.withColumns({"_upto": F.sum("_quotes").over(own), "_at": F.count(F.lit(1)).over(own)})
    inside = (F.col("_upto") - F.col("_quotes")) % 2
    lines = lines.withColumns(
        {n: F.coalesce(F.max(F.when(inside == i, F.col("_at"))).over(own), none) for i, n in enumerate(("_even", "_odd"))}
    )
    opened = F.when(F.col("_quotes_before") % 2 == 0, F.col("_even")).otherwise(F.col("_odd"))
    start = F.when(opened > 0, F.col("_lines_before") + opened)
    blocks = lines.groupBy(*block).agg(*[F.max(n).alias(n) for n in numbers]).withColumns(
        {
            "_quotes_before": F.coalesce(F.sum("_upto").over(earlier), none),
            "_lines_before": F.coalesce(F.sum("_at").over(earlier), none),
        }
    )
    blocks = blocks.withColumn("_open_before", F.max(start).over(earlier)).drop(*numbers)
    number = F.col("_lines_before") + F.col("_at")
    placed = lines.join(blocks, block).select(
        "_file",
        number.alias("_line"),
        F.coalesce(start, "_open_before").alias("_record"),
        F.when(number == 1, F.ltrim("value", F.lit("\ufeff"))).otherwise(F.col("value")).alias("value"),
        ((F.col("_quotes_before") + F.col("_upto")) % 2 == 0).alias("_closed"),
    )
    whole = (F.col("_line") == F.col("_record")) & F.col("_closed")
    several = placed.filter(~whole).groupBy("_file", "_record").agg(
        F.array_sort(F.collect_list(F.struct("_line", "value"))).alias("_parts")
    )
    records = placed.filter(whole).select("_file", "_record", F.col("value").alias("record")).unionByName(
        several.select("_file", "_record", F.array_join("_parts.value", "\n").alias("record"))
    )
    return records.filter(F.trim(F.rtrim("record", F.lit("\r"))) != "")


def read_recursive(spark: SparkSession, folder: str, pattern: str = "*.csv") -> DataFrame:
    """All matching files below a folder as canonical events; empty when there is none.

    Files are cut into records and each record is read by its own file's header, so any
    number and size of files and layouts meets in one scan, and neither paths nor layouts
    come to the driver. Columns that a file lacks, cells that a short record lacks
    and unreadable ones are null or take the defaults; blank lines are skipped, a
    header alone gives no rows. Of a repeated column name the first counts.
    """
    if not exists(spark, folder):
        return spark.createDataFrame([], EVENT)
    records = _csv_records(spark, folder, pattern)
    headers = records.groupBy("_file").agg(F.min(F.struct("_record", "record")).alias("_first")).select(
        "_file", F.col("_first._record").alias("_header"), _cells(F.col("_first.record")).alias("header")
    )
    # the place of every column is found once per file
    places = headers.withColumn("header", F.transform("header", lambda h: F.trim(h))).select(
        "_file",
        "_header",
        *[F.coalesce(F.array_position("header", f.name), F.lit(0)).cast("int").alias(f"_at_{f.name}") for f in EVENT.fields],
    )
    lines = records.join(places, "_file").filter("_record > _header").withColumn("cells", _cells(F.col("record")))
    named = lines.select(*[F.get("cells", F.col(f"_at_{f.name}") - 1).alias(f.name) for f in EVENT.fields])
    typed = named.select(
        *[
            dx.parse_ts(F.col(f.name)).alias(f.name) if f.dataType == T.TimestampType()
            else F.col(f.name).try_cast(f.dataType).alias(f.name)
            for f in EVENT.fields
        ]
    )
    return canonical_events(typed, strength=0.0, default_climate=0.0)

"""Raw payment files -> Bronze rows.

Files land under ``<landing>/competencia=YYYYMM/`` (one folder per requested
month, any number of files). The reader is Spark's distributed CSV scan:
``;`` separator, header, ``"`` quote and escape, Latin-1 decoding, no type
inference (every column a string). The folder name carries the period, so
``ano``/``mes`` of a Bronze row are the period it was delivered for (as in a
per-month download), and asking for some months prunes the file listing.

Every landed file is bound by its own header. One Spark job over the files' lines
finds each file's first line and whether a quoted value of it holds a line break; only the
distinct headers (and, for a faulty one, the name of one file) come to the
driver. Names are canonicalised (strip + upper); a file that lacks a required column is
refused by name. Files of several layouts are read in one scan by position, and a column is
taken from where its file has it. Extra columns are kept (NULL in files without them).
Files with line breaks inside quoted values are read by ``quoted.read_records``, which keeps
them splittable; the others by the CSV scan.
"""

from __future__ import annotations

import csv
import datetime as _dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions import canonical_header
from ledgerline.schemas import RAW_COLUMNS
from ledgerline.sources import quoted as Q
from ledgerline.sources.digest import tree_digests

PERIOD_DIR = "competencia"
FILE_PATH = "__file_path"  # path of the file a raw row came from
# Files whose facts (path, layout) a broadcast may hold, about 200 bytes each.
BROADCAST_FILES = 100_000


def csv_options(encoding: str = "ISO-8859-1", multi_line: bool = False) -> dict[str, str]:
    """Reader options of the payment file. ``multi_line=True`` accepts quoted
    newlines and makes each file one task."""
    return {
        "sep": ";",
        "header": "true",
        "quote": '"',
        "escape": '"',
        "encoding": encoding,
        "inferSchema": "false",
        "multiLine": "true" if multi_line else "false",
        "mode": "PERMISSIVE",
    }


def writer_options(encoding: str = "ISO-8859-1") -> dict[str, str]:
    """Options that write a file the reader above returns unchanged."""
    return {
        "sep": ";",
        "header": "true",
        "quote": '"',
        "escape": '"',
        "encoding": encoding,
        "ignoreLeadingWhiteSpace": "false",
        "ignoreTrailingWhiteSpace": "false",
        "nullValue": "",
        "emptyValue": '""',
    }


def check_header(columns: list[str], required: list[str] | None = None, file: str = "raw file") -> list[str]:
    """Canonical names of ``columns``; ``ValueError`` naming the file and what is missing or doubled."""
    canon = [canonical_header(c) for c in columns]
    missing = [c for c in (required or RAW_COLUMNS) if c not in canon]
    if missing:
        raise ValueError(f"{file} lacks expected columns: {missing}")
    if len(set(canon)) < len(canon):
        raise ValueError(f"{file} has a column twice: {canon}")
    return canon


def header_names(line: str, file: str) -> list[str]:
    """Canonical column names of a header line."""
    row = next(csv.reader([line.lstrip("\ufeff").rstrip("\r")], delimiter=";", quotechar='"'), [])
    return check_header(row, file=file)


def file_facts(lines: DataFrame, encoding: str, breaks: bool) -> DataFrame:
    """(path, header, spans) of every file with a line: its first line, and (with ``breaks``) whether a quoted
    value of it goes on in another line. One pass; a row per file and task is shuffled."""
    text = F.decode(Q.LINE, encoding).alias("line")
    first = F.when(F.col(Q.START) == 0, F.col("at"))
    # the set makes Spark aggregate rows in a hash table of objects; strings alone would be sorted
    spans = F.collect_set(F.when(Q.ends_inside(F.rtrim("line", F.lit("\r"))) if breaks else F.lit(False), F.lit(True)))
    return (
        lines.select(FILE_PATH, Q.START, text, F.monotonically_increasing_id().alias("at"))
        .groupBy(F.col(FILE_PATH).alias("path"))
        .agg(F.min_by("line", first).alias("header"), (F.size(spans) > 0).alias("spans"))
    )


def layouts(facts: DataFrame) -> dict[str, list[str]]:
    """Header line -> canonical column names, of the distinct header lines of ``facts``."""
    found = facts.groupBy("header").agg(F.min("path").alias("path")).orderBy("path").collect()
    return {r["header"]: header_names(r["header"] or "", r["path"]) for r in found}


def period_filter(periods: list[tuple[int, int]] | None):
    if not periods:
        return None
    return F.col(PERIOD_DIR).isin(sorted({y * 100 + m for y, m in periods}))


def read_raw(
    spark: SparkSession,
    path: str | list[str],
    *,
    encoding: str = "ISO-8859-1",
    multi_line: bool | None = None,
    base: str | None = None,
) -> DataFrame:
    """All-string rows of the files in the folders ``path`` with canonical names.

    ``multi_line``: None (default) finds out which files have line breaks inside quoted
    values and reads those in ranges too (``quoted``); True reads every file in one task; False
    takes every line for a record, for files known to have none (a broken value then costs rows).
    ``encoding``: one in which a line feed, a quote and a semicolon are single bytes.

    The month folder (``competencia=...``) below ``base`` comes back as the last
    column, from the file's path. Columns: the contract's, then any extra ones
    by name.
    """
    dirs = [path] if isinstance(path, str) else path
    month = T.StructField(PERIOD_DIR, T.IntegerType())
    tail = [PERIOD_DIR, FILE_PATH] if base is not None else [FILE_PATH]
    if not dirs:
        fields = [T.StructField(c, T.StringType()) for c in RAW_COLUMNS] + ([month] if base is not None else [])
        return spark.createDataFrame([], T.StructType([*fields, T.StructField(FILE_PATH, T.StringType())]))
    lines = Q.read_lines(spark, dirs, FILE_PATH, base, month)
    facts = _written(file_facts(lines, encoding, breaks=multi_line is None))
    by_header = layouts(facts)
    names = [*RAW_COLUMNS, *sorted({c for n in by_header.values() for c in n} - set(RAW_COLUMNS))]
    width = max(map(len, by_header.values()), default=len(RAW_COLUMNS))
    n_files, n_spans = facts.agg(F.count("*"), F.coalesce(F.sum(F.col("spans").cast("int")), F.lit(0))).first()
    kinds = sorted(set(map(tuple, by_header.values())))
    short = facts if n_files > BROADCAST_FILES else F.broadcast(facts)
    kind = F.coalesce(*(F.when(F.col("header") == h, F.lit(kinds.index(tuple(n)))) for h, n in by_header.items())) if by_header else F.lit(0)
    place = short.select(F.col("path").alias(FILE_PATH), "spans", kind.alias("__kind"))

    positions = [f"__c{i}" for i in range(width)]
    ddl = ", ".join(f"{c} string" for c in positions)

    def bound(rows: DataFrame, mixed: bool) -> DataFrame:
        """Columns by name, from the position each row's layout (``__kind``) has them at."""
        out = []
        for c in names:
            at = [(k, n.index(c)) for k, n in enumerate(kinds) if c in n]
            value = F.lit(None).cast("string")
            for k, i in at:
                value = F.when(F.col("__kind") == k, F.col(positions[i])).otherwise(value) if mixed else F.col(positions[i])
            out.append(value.alias(c))
        return rows.select(*out, *tail)

    reader = spark.read.options(**csv_options(encoding, bool(multi_line)))
    if base is not None:
        reader = reader.option("basePath", base)
    plain = reader.schema(f"{ddl}, {PERIOD_DIR} int" if base is not None else ddl).csv(dirs)
    plain = plain.select(*positions, *tail[:-1], F.col("_metadata.file_path").alias(FILE_PATH))
    mixed = len(kinds) > 1
    if mixed or n_spans:
        plain = plain.join(place, FILE_PATH)
    if not n_spans:
        return bound(plain, mixed)
    broken = F.broadcast(place.where("spans").select(FILE_PATH)) if n_files <= BROADCAST_FILES else place.where("spans").select(FILE_PATH)
    records = Q.read_records(lines.join(broken, FILE_PATH, "left_semi"), FILE_PATH, encoding)
    parsed = F.from_csv(Q.LINE, ddl, csv_options(encoding))
    records = records.select(parsed.alias("r"), *tail).select("r.*", *tail).join(place, FILE_PATH)
    return bound(plain.where("NOT spans"), mixed).unionByName(bound(records, mixed))


def _written(facts: DataFrame) -> DataFrame:
    """``facts`` as a table in the shared folder: a row per file, used by several plans."""
    from ledgerline.settings import work_dir

    path = work_dir(facts.sparkSession, f"files-{uuid.uuid4().hex[:12]}")
    schema = facts.schema
    facts.write.mode("overwrite").parquet(path)
    return facts.sparkSession.read.schema(schema).parquet(path)


def landed_periods(spark: SparkSession, landing: str) -> list[tuple[int, int]]:
    """Months present in the landing area, from its folder names (one
    listing of the landing root; no file is read)."""
    from ledgerline.sinks.tables import child_dirs

    out = []
    for name in child_dirs(spark, landing):
        key, _, value = name.partition("=")
        if key == PERIOD_DIR and value.isdigit() and len(value) == 6:
            out.append((int(value) // 100, int(value) % 100))
    return sorted(out)


def split_landed(
    spark: SparkSession, landing: str, periods: list[tuple[int, int]]
) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """The requested months that have a landing folder, and those that have none."""
    there = set(landed_periods(spark, landing))
    wanted = sorted(set(periods))
    return [p for p in wanted if p in there], [p for p in wanted if p not in there]


def month_dirs(spark: SparkSession, landing: str, periods: list[tuple[int, int]] | None) -> list[str]:
    """``competencia=YYYYMM`` folders of the requested months (all landed ones for
    None); ``ValueError`` naming the months that have none."""
    found, absent = split_landed(spark, landing, periods) if periods else (landed_periods(spark, landing), [])
    if absent:
        raise ValueError(f"nothing landed for {absent} under {landing}")
    return [f"{landing.rstrip('/')}/{PERIOD_DIR}={y * 100 + m}" for y, m in found]


def read_landing(
    spark: SparkSession,
    landing: str,
    periods: list[tuple[int, int]] | None = None,
    *,
    encoding: str = "ISO-8859-1",
    multi_line: bool | None = None,
) -> DataFrame:
    """Raw rows of the requested months (all months when ``periods`` is None),
    with the file's period and path as the last two columns."""
    dirs = month_dirs(spark, landing, periods)
    df = read_raw(spark, dirs, encoding=encoding, multi_line=multi_line, base=landing)
    cond = period_filter(periods)
    return df if cond is None else df.filter(cond)


def file_hashes(spark: SparkSession, landing: str, periods: list[tuple[int, int]] | None) -> DataFrame:
    """``(path, md5)`` of each landed file: MD5 of the original bytes.

    Same file set as the CSV reader (Spark skips ``_``/``.`` files). Each
    file is read whole into one row, so this suits monthly files below 2 GB;
    the modes ``"rows"`` and ``"tree"`` of ``with_bronze_audit`` have no such bound.
    """
    files = spark.read.format("binaryFile").option("basePath", landing).load(month_dirs(spark, landing, periods))
    return files.select(F.col("_metadata.file_path").alias("_hash_path"), F.md5("content").alias("_file_hash"))


def row_fingerprints(raw: DataFrame) -> DataFrame:
    """``(path, fingerprint)`` per file from its rows, computed in parallel.

    The fingerprint is the exact (decimal) sum of a 64-bit hash of every row
    (the contract's columns, NULL-aware, and extra ones where they have a value, so it does not
    depend on the files read along) plus the row count: independent of row order and
    split boundaries, so a very large file is hashed by many tasks with a
    map-side partial sum. It identifies content, but it is not an MD5.
    """
    extra = sorted(c for c in raw.columns if c not in (*RAW_COLUMNS, PERIOD_DIR, FILE_PATH))
    # a NULL leaves xxhash64 as it is
    named = [F.concat(F.lit(f"{c}\u0000"), F.col(f"`{c}`")) for c in extra]
    h = F.xxhash64(*[F.coalesce(F.col(c), F.lit("\u0000")) for c in RAW_COLUMNS], *named)
    return (
        raw.select(F.col(FILE_PATH).alias("_hash_path"), h.alias("_h"))
        .groupBy("_hash_path")
        .agg(F.sum(F.col("_h").cast("decimal(20,0)")).alias("_s"), F.count(F.lit(1)).alias("_n"))
        .select(
            "_hash_path",
            F.concat_ws(":", F.lit("rows"), F.col("_s").cast("string"), F.col("_n").cast("string")).alias(
                "_file_hash"
            ),
        )
    )


def decoded(path: F.Column) -> F.Column:
    """A file path or name as it was given: Spark reports them URL-encoded (a plus sign is not)."""
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def with_bronze_audit(
    spark: SparkSession,
    raw: DataFrame,
    landing: str,
    periods: list[tuple[int, int]] | None,
    *,
    run_ts: _dt.datetime | None = None,
    source_label: str | None = None,
    file_hash: str | bool | None = "rows",
) -> DataFrame:
    """Add ``_source``, ``_file_name``, ``_ingested_at``, ``_file_hash``,
    ``ano``, ``mes``; drop the folder column.

    ``file_hash``: ``"rows"`` (parallel row fingerprint, any file size, see
    ``row_fingerprints``), ``"tree"`` (SHA-256 tree of the original bytes and their
    number, any file size, see ``digest``), ``"md5"`` (MD5 of the original bytes; each
    file is read whole by one task, so files must stay below 2 GB) or None.
    """
    mode = "md5" if file_hash is True else (None if file_hash is False else file_hash)
    ts = run_ts or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    path = F.col(FILE_PATH)
    df = raw.withColumns(
        {
            "_source": F.lit(source_label) if source_label else decoded(path),
            "_file_name": decoded(F.substring_index(path, "/", -1)),
            "_ingested_at": F.lit(ts.isoformat()),
            "ano": F.expr(f"CAST({PERIOD_DIR} AS INT) DIV 100").cast("int"),
            "mes": F.expr(f"CAST({PERIOD_DIR} AS INT) % 100").cast("int"),
        }
    )
    if mode in ("md5", "rows", "tree"):
        # one short row per file; AQE picks the join from its measured size
        if mode == "tree":
            hashes = tree_digests(spark, month_dirs(spark, landing, periods)).select(
                F.col("path").alias("_hash_path"), F.concat(F.lit("tree:"), "digest", F.lit(":"), "size").alias("_file_hash")
            )
        else:
            hashes = file_hashes(spark, landing, periods) if mode == "md5" else row_fingerprints(raw)
        df = df.join(hashes, df[FILE_PATH] == hashes["_hash_path"], "left").drop("_hash_path")
    elif mode is None:
        df = df.withColumn("_file_hash", F.lit(None).cast("string"))
    else:
        raise ValueError(f"unknown file_hash mode {file_hash!r}")
    extra = [c for c in raw.columns if c not in RAW_COLUMNS and c not in (PERIOD_DIR, FILE_PATH)]
    return df.select(
        *RAW_COLUMNS, *extra, "_source", "_file_name", "_ingested_at", "_file_hash", "ano", "mes"
    )


def write_landing(
    df: DataFrame,
    landing: str,
    encoding: str = "ISO-8859-1",
    *,
    columns: list[str] | None = None,
    mode: str = "overwrite",
) -> None:
    """Land raw rows as payment files, one folder per ``MES_COMPETENCIA``, with
    ``columns`` (the contract's by default) in that order.

    Used to stage test feeds. No repartition by month (that would send a
    whole month to one task): each task writes its rows into the month
    folders it holds.
    """
    (
        df.select(*(columns or RAW_COLUMNS), F.col("MES_COMPETENCIA").alias(PERIOD_DIR))
        .write.mode(mode)
        .options(**writer_options(encoding))
        .partitionBy(PERIOD_DIR)
        .csv(landing)
    )

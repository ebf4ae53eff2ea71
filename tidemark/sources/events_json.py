"""Hourly JSON-lines event files.

One gzip file per hour is one unsplittable read task, so parallelism comes
from many hours at once. The declared schema lists only the kept leaves;
heavy payload bodies are skipped by the parser and never materialised.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.silver import utc_naive
from tidemark.schemas import BRONZE_COLUMNS, RAW_EVENT
from tidemark.sources.capped_lines import read_capped_lines


def _instant(c: Column, session_tz: str, strict: bool) -> Column:
    """ISO-8601 instant text (``Z`` or an offset) -> naive UTC timestamp. Text
    that is no instant fails the load if ``strict``, and is null otherwise."""
    parsed = F.try_to_timestamp(c)
    if strict:
        parsed = F.when(c.isNotNull() & parsed.isNull(), F.raise_error(
            F.concat(F.lit("not an instant: "), c)).cast("timestamp")).otherwise(parsed)
    return utc_naive(parsed, T.TimestampType(), session_tz)


def flatten_events(raw: DataFrame, strict: bool = True) -> DataFrame:
    """Nested event -> flat columns; a missing or null struct gives nulls.

    ``_source_file`` (S3) is the file's own name, taken from the scan's
    ``_metadata`` column, as is the file time used by streaming loads.
    """
    tz = raw.sparkSession.conf.get("spark.sql.session.timeZone")
    return raw.select(
        F.col("id").alias("event_id"),
        F.col("type").alias("event_type"),
        F.col("actor.id").alias("actor_id"),
        F.col("actor.login").alias("actor_login"),
        F.col("repo.id").alias("repo_id"),
        F.col("repo.name").alias("repo_name"),
        _instant(F.col("created_at"), tz, strict).alias("created_at"),
        F.col("payload.action").alias("payload_action"),
        F.col("_metadata.file_name").alias("_source_file"),
        F.col("_metadata.file_modification_time").cast("timestamp_ntz").alias("_file_time"),
    )


def stamp_lineage(flat: DataFrame, loaded_at: datetime | str | None = None) -> DataFrame:
    """S3: one ``_loaded_at`` instant for the whole batch.

    ``None`` stamps the driver's clock once, as a literal, so every task of
    the batch writes the same value; ``"file_time"`` uses each file's
    modification time (the streaming load).
    """
    if loaded_at == "file_time":
        stamp = F.col("_file_time")
    else:
        when = loaded_at or datetime.now(timezone.utc).replace(tzinfo=None)
        stamp = F.lit(when).cast("timestamp_ntz")
    return flat.withColumn("_loaded_at", stamp).select(*BRONZE_COLUMNS)


def read_event_files(spark: SparkSession, paths: str | list[str], max_events: int = 0,
                     loaded_at: datetime | str | None = None, mode: str = "FAILFAST") -> DataFrame:
    """Scan hour files into bronze rows.

    ``mode="FAILFAST"`` fails the load on a malformed line, as the studied
    loader does; ``PERMISSIVE`` turns such a line into a null row instead. With
    ``max_events`` only the first lines of every file path are read, parsed and
    checked; the same hour name delivered twice is two files.
    """
    if max_events:
        event = F.from_json("value", RAW_EVENT, {"mode": mode}).alias("event")
        source = F.struct("file_name", "file_modification_time").alias("_metadata")
        raw = read_capped_lines(spark, paths, max_events).select(event, source).select("event.*", "_metadata")
    else:
        raw = spark.read.schema(RAW_EVENT).option("mode", mode).json(paths)
    return stamp_lineage(flatten_events(raw, strict=mode == "FAILFAST"), loaded_at)


# ----------------------------------------------------------------- writing

def raw_documents(bronze_rows: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Bronze-shaped rows back into raw event documents (plus the hour file)."""
    def nested(**fields):
        return F.struct(*[F.col(src).alias(dst) for dst, src in fields.items()])

    return bronze_rows.select(
        F.col("event_id").alias("id"),
        F.col("event_type").alias("type"),
        nested(id="actor_id", login="actor_login").alias("actor"),
        nested(id="repo_id", name="repo_name").alias("repo"),
        nested(action="payload_action").alias("payload"),
        F.date_format("created_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("created_at"),
        "_source_file", *keep,
    )


def _fs(spark: SparkSession, path: str):
    sc = spark.sparkContext
    Path = sc._jvm.org.apache.hadoop.fs.Path
    return Path, Path(path).getFileSystem(sc._jsc.hadoopConfiguration())


def write_hour_files(rows: DataFrame, landing_dir: str) -> list[str]:
    """Write bronze-shaped rows as a landing area of hour files.

    Each delivery (one ``_loaded_at`` instant) becomes a folder
    ``{landing_dir}/{yyyyMMdd-HHmmss}/`` holding one gzip JSON-lines file
    per hour, named like the feed (``2024-01-15-5.json.gz``), whose
    modification time is set to the delivery instant. Rows are
    hash-partitioned by (delivery, hour) so each file is written by one
    task; the output files are then renamed into place (metadata moves).
    Returns the file paths.
    """
    spark = rows.sparkSession
    staging = f"{landing_dir}/_staging"
    docs = raw_documents(
        rows.withColumn("_delivery", F.date_format("_loaded_at", "yyyyMMdd-HHmmss")), ("_delivery",))
    (docs.repartition("_delivery", "_source_file")
     .write.partitionBy("_delivery", "_source_file").option("compression", "gzip").json(staging))
    Path, fs = _fs(spark, staging)
    out = []
    for d in fs.listStatus(Path(staging)):
        dname = d.getPath().getName()
        if not dname.startswith("_delivery="):
            continue
        delivery = dname.split("=", 1)[1]
        mtime = int(datetime.strptime(delivery, "%Y%m%d-%H%M%S")
                    .replace(tzinfo=timezone.utc).timestamp() * 1000)
        fs.mkdirs(Path(f"{landing_dir}/{delivery}"))
        for st in fs.listStatus(d.getPath()):
            name = st.getPath().getName()
            if not name.startswith("_source_file="):
                continue
            target = name.split("=", 1)[1]
            parts = [p.getPath() for p in fs.listStatus(st.getPath())
                     if p.getPath().getName().startswith("part-")]
            if len(parts) != 1:
                raise RuntimeError(f"expected one file for {delivery}/{target}, got {len(parts)}")
            dest = Path(f"{landing_dir}/{delivery}/{target}")
            fs.rename(parts[0], dest)
            fs.setTimes(dest, mtime, -1)
            out.append(str(dest))
    return out

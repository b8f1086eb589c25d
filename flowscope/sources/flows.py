"""Network flows: typed view from ``events``, text lines (S16), parser
and streaming sources (S3 socket, file)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from flowscope.functions.parse import FLOW_LINE_PATTERN, FLOW_TIME_FORMAT, flow_timestamp, ip_of_user
from flowscope.session import fresh_path
from flowscope.sources.tables import derived, derived_path, table

# version of the rendered lines; stored lines of another version are not reused
FLOW_VERSION = 2


def flow_view(events: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """``events`` as flows: ts -> datetime, event_type -> protocol, user -> source
    quad ``10.a.b.c``, ``event_id % 200`` -> destination ``10.1.0.x``,
    ``round(value*100)`` -> integer packet size."""
    return events.select(
        *keep,
        F.col("ts").alias("datetime"),
        F.col("event_type").alias("protocol"),
        ip_of_user(F.col("user_id")).alias("source_ip"),
        F.concat(F.lit("10.1.0."), F.pmod(F.col("event_id"), F.lit(200)).cast("string")).alias("destination_ip"),
        F.round(F.col("value") * 100).try_cast("int").alias("packet_size"))


def flows(spark: SparkSession, sf_dir: str, keep: tuple[str, ...] = ()) -> DataFrame:
    return flow_view(table(spark, sf_dir, "events"), keep)


def flow_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flow feed of a table folder as text lines ``value``, rendered from
    ``events`` once and stored in the shared folder (``tables.derived``)."""
    return derived(spark, sf_dir, f"flow-lines-v{FLOW_VERSION}", "events", lambda ev: format_flow_lines(flow_view(ev)))


def flow_text_path(spark: SparkSession, sf_dir: str) -> str:
    """Folder of the same flow feed as plain text files, one line each."""
    return derived_path(spark, sf_dir, f"flow-text-v{FLOW_VERSION}", "events",
                        lambda ev: format_flow_lines(flow_view(ev)), "text")


def format_flow_lines(fl: DataFrame) -> DataFrame:
    """``yyyy-MM-dd_HH:mm:ss.SSS PROTO SRC DST SIZE`` (milliseconds)."""
    return fl.select(F.concat_ws(" ", F.date_format("datetime", FLOW_TIME_FORMAT), "protocol",
                                 "source_ip", "destination_ip",
                                 F.col("packet_size").cast("string")).alias("value"))


def flow_parse_rejects(lines: DataFrame) -> DataFrame:
    """One row: lines read, lines without a time in the format, lines whose size is no int."""
    parsed = parse_flow_lines(lines, drop_bad=False)
    return parsed.agg(F.count(F.lit(1)).alias("n_lines"), F.count_if(F.col("datetime").isNull()).alias("n_bad_time"),
                      F.count_if(F.col("datetime").isNotNull() & F.col("packet_size").isNull()).alias("n_bad_size"))


_SEP = "\u0001"


def parse_flow_lines(lines: DataFrame, drop_bad: bool = True, zone: str | None = None) -> DataFrame:
    """X4 + X5: the five groups of ``FLOW_LINE_PATTERN``, then typed columns.

    One anchored ``regexp_replace`` evaluates the pattern once per line and
    lays the groups out separated by ``\\u0001`` (a control character that
    does not occur in flow lines); a line that does not match keeps a ``#``
    prefix, so all its groups become ``''`` as with ``regexp_extract``, and
    its timestamp cast fails. The timestamp group is cast to
    ``timestamp_ntz`` (time-zone independent, null on junk); a feed written in
    the wall clock of a ``zone`` (``America/New_York``) is taken to UTC. Rows with a null
    datetime are dropped unless ``drop_bad`` is false.
    """
    body = FLOW_LINE_PATTERN[1:]  # pattern without its leading ^
    laid = F.regexp_replace(F.concat(F.lit("#"), F.col("value")), "^#" + body,
                            _SEP.join(f"${i}" for i in range(1, 6)))
    g = lines.select(F.split(laid, _SEP).alias("_g"))
    ok = ~F.try_element_at("_g", F.lit(1)).startswith("#")

    def grp(i):
        return F.when(ok, F.try_element_at("_g", F.lit(i))).otherwise(F.lit(""))

    at = flow_timestamp(F.try_element_at("_g", F.lit(1)))
    if zone is not None:
        at = F.convert_timezone(F.lit(zone), F.lit("UTC"), at)
    out = g.select(at.alias("datetime"),
                   grp(2).alias("protocol"), grp(3).alias("source_ip"), grp(4).alias("destination_ip"),
                   F.when(ok, F.try_element_at("_g", F.lit(5))).try_cast("int").alias("packet_size"))
    return out.where(F.col("datetime").isNotNull()) if drop_bad else out


def read_flow_text(spark: SparkSession, path: str, streaming: bool = False,
                   max_files_per_trigger: int | None = None) -> DataFrame:
    """Flow lines from text files, as a table or as a file stream."""
    if not streaming:
        return spark.read.text(path)
    reader = spark.readStream.schema(StructType([StructField("value", StringType())]))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.text(path)


def read_flow_socket(spark: SparkSession, host: str, port: int) -> DataFrame:
    """S3: socket stream of flow lines (column ``value``); not fault tolerant,
    kept for parity with a live feed."""
    return spark.readStream.format("socket").option("host", host).option("port", port).load()


# ---- a feed that arrives in drops ----------------------------------------------
DROPS = 4
# one flow in ten is held up by 1 to 100 hours
_HELD_UP = "CASE WHEN event_id % 10 = 3 THEN (event_id * 37) % 100 + 1 ELSE 0 END"


def flow_drops(spark: SparkSession, sf_dir: str, drops: int = DROPS, stragglers: bool = True,
               keep: tuple[str, ...] = ()) -> list[DataFrame]:
    """The flows of a folder as a feed: split by arrival time, which with ``stragglers`` lags behind
    ``datetime`` for some, into ``drops`` spans of equal length, in the order of arrival. The
    flows are stored once, by drop (with the columns ``keep`` of ``events``); each frame reads its own."""
    fl = table(spark, sf_dir, "events")
    fl = fl.withColumn("_arrival", F.expr(f"unix_micros(CAST(ts AS timestamp)) + ({_HELD_UP if stragglers else 0}) * 3600000000"))
    b = fl.agg(F.struct(F.min("_arrival").alias("lo"), F.max("_arrival").alias("hi"))).scalar()
    part = F.floor((F.col("_arrival") - b.getField("lo")) * drops / (b.getField("hi") - b.getField("lo") + 1)).cast("int")
    rows = flow_view(fl.withColumn("_drop", part), keep=("_drop", *keep))
    path = fresh_path(spark, "flow-drops")
    rows.withColumn("datetime", F.col("datetime").cast("timestamp")).write.partitionBy("_drop").parquet(path)
    stored = spark.read.parquet(path)
    return [stored.where(F.col("_drop") == i).drop("_drop") for i in range(drops)]

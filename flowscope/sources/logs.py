"""Access-log lines: text scan (S1), a log view rendered from ``events``, and
the parser that turns lines into ``(ip, datetime, bytes)`` (S2, P5, P6, X1-X3).

Line format: ``host [DD:HH:MM:SS] "GET /path HTTP/1.0" status bytes``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowscope.functions.parse import (
    LOG_TIME_FORMAT, bytes_present, field, ip_of_user, is_ipv4_host, last_field, log_timestamp,
)
from flowscope.sources.tables import derived, derived_path

# Year-month of the rendered view: the events tables cover January 2024.
EVENTS_YEAR_MONTH = "2024-01"


# version of the rendered lines; stored lines of another version are not reused
LOG_VERSION = 2


def read_log_text(spark: SparkSession, path: str) -> DataFrame:
    """One row per line, column ``value`` (splittable, partitioned by file blocks)."""
    return spark.read.text(path)


def render_log_lines(events: DataFrame) -> DataFrame:
    """Render ``events`` as access-log lines ``(event_id, value)``.

    host: ``host<uid>.example.com`` when ``user_id % 10 = 0`` (no quad: dropped
    by the parser), ``gw<uid>-<ip>`` when ``user_id % 10 = 5`` (contains a quad:
    kept by the unanchored test), else the dotted quad of the user.
    ``error`` events are 302 with ``-`` bytes; bytes are ``round(value*100)``.
    """
    uid = F.col("user_id")
    ip = ip_of_user(uid)
    host = (F.when(F.pmod(uid, F.lit(10)) == 0, F.concat(F.lit("host"), uid.cast("string"), F.lit(".example.com")))
            .when(F.pmod(uid, F.lit(10)) == 5, F.concat(F.lit("gw"), uid.cast("string"), F.lit("-"), ip))
            .otherwise(ip))
    is_err = F.col("event_type") == "error"
    status = F.when(is_err, F.lit("302")).otherwise(F.lit("200"))
    nbytes = F.when(is_err, F.lit("-")).otherwise(
        F.round(F.col("value") * 100).cast("bigint").cast("string"))
    stamp = F.concat(F.lit("["), F.date_format("ts", LOG_TIME_FORMAT), F.lit("]"))
    line = F.concat_ws(" ", host, stamp,
                       F.concat(F.lit('"GET /'), F.col("event_type"), F.lit(' HTTP/1.0"')),
                       status, nbytes)
    return events.select("event_id", line.alias("value"))


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The access log of a table folder: ``(event_id, value)``, rendered from
    ``events`` once and stored in the shared folder (``tables.derived``)."""
    return derived(spark, sf_dir, f"access-log-v{LOG_VERSION}", "events", render_log_lines)


def log_lines_path(spark: SparkSession, sf_dir: str) -> str:
    """Folder of the stored access log (a file-stream source for log streams)."""
    return derived_path(spark, sf_dir, f"access-log-v{LOG_VERSION}", "events", render_log_lines)


def log_text_path(spark: SparkSession, sf_dir: str) -> str:
    """Folder of the same access log as plain text files, one line each."""
    return derived_path(spark, sf_dir, f"access-log-text-v{LOG_VERSION}", "events",
                        lambda ev: render_log_lines(ev).select("value"), "text")


def valid_log_lines(lines: DataFrame, strict: bool = False) -> DataFrame:
    """P5 + P6: host contains a dotted quad and bytes are present."""
    return lines.where(is_ipv4_host(field("value", 0), strict) & bytes_present("value"))


def parse_log_lines(lines: DataFrame, year_month: str = "2020-01", strict: bool = False,
                    keep: tuple[str, ...] = ()) -> DataFrame:
    """Valid lines -> ``(ip, datetime, bytes)`` (+ ``keep`` columns).

    The line is split once; host, stamp and the last field are projected
    first so that later expressions reuse them instead of re-splitting.
    Junk that passes the line filters but does not parse (bad time or bytes)
    gives nulls and is dropped here; ``log_parse_rejects`` counts it.
    """
    parts = lines.select(*keep, F.split("value", " ").alias("_f"))
    fields = parts.select(*keep, F.try_element_at("_f", F.lit(1)).alias("ip"), F.try_element_at("_f", F.lit(2)).alias("_stamp"),
                          F.try_element_at("_f", F.lit(-1)).alias("_last"))
    valid = fields.where(is_ipv4_host("ip", strict) & (F.col("_last") != "-"))
    parsed = valid.select(*keep, "ip", log_timestamp("_stamp", year_month).alias("datetime"),
                          F.col("_last").try_cast("bigint").alias("bytes"))
    return parsed.where(F.col("datetime").isNotNull() & F.col("bytes").isNotNull())


def log_parse_rejects(lines: DataFrame, year_month: str = "2020-01") -> DataFrame:
    """One row: lines read, lines failing the filters, valid lines that did not parse."""
    host_ok = is_ipv4_host(field("value", 0))
    valid = host_ok & bytes_present("value")
    parsed_ok = (log_timestamp(field("value", 1), year_month).isNotNull()
                 & last_field("value").try_cast("bigint").isNotNull())
    return lines.agg(F.count(F.lit(1)).alias("n_lines"),
                     F.count_if(~valid).alias("n_filtered"),
                     F.count_if(valid & ~parsed_ok).alias("n_unparsed"))


def parsed_log(spark: SparkSession, sf_dir: str, keep: tuple[str, ...] = ()) -> DataFrame:
    return parse_log_lines(log_lines(spark, sf_dir), EVENTS_YEAR_MONTH, keep=keep)

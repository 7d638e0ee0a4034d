"""Application log lines -> structured audit events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.functions.once import once
from touchline.operators.validation import audit_header
from touchline.vocabulary import AUDIT_APP_LOG, EVENT_APP_LOG, LEVEL_UNPARSED, LOGGER_UNKNOWN

# Fixed value: the line format "YYYY-MM-DD HH:MM:SS [LEVEL] logger: message", up
# to the message. The time stamp is 19 characters.
_PREFIX = (
    r"^\p{Nd}{4}-\p{Nd}{2}-\p{Nd}{2} \p{Nd}{2}:\p{Nd}{2}:\p{Nd}{2} "
    r"\[[\p{L}\p{N}_]+\] [\p{L}\p{N}_.]+: "
)
_TS_LENGTH = 19

# Anything that is not Unicode white space or an ASCII separator control.
_VISIBLE = r"(?U)[^\s\x1C-\x1F]"


def drop_blank_lines(lines: DataFrame, line: str = "value") -> DataFrame:
    return lines.where(F.col(line).rlike(_VISIBLE))


def parse_app_logs(lines: DataFrame, line: str = "value") -> DataFrame:
    """Add ``type, ts, level, logger, message`` and a typed ``event_time``.

    One regex finds the line prefix; the parts are cut from that short prefix.
    Other lines (stack traces) keep their text under level ``UNPARSED`` and the
    current time.
    """
    staged = lines.withColumn("_line", F.rtrim(F.col(line), F.lit("\n")))
    single = ~F.col("_line").contains("\n")
    prefix = F.when(single, F.regexp_extract("_line", _PREFIX, 0)).otherwise(F.lit(""))
    staged = once(staged, _prefix=prefix)

    parsed = F.col("_prefix") != ""
    text = F.col("_line")
    # "] " ends the level and ": " the logger; neither occurs inside them.
    bracketed = F.substring("_prefix", _TS_LENGTH + 3, 1 << 30)
    level = F.substring_index(bracketed, "] ", 1)
    logger = F.rtrim(F.substring_index(bracketed, "] ", -1), F.lit(": "))
    now = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
    message = F.substring(text, F.length("_prefix") + 1, F.length(text))
    return (
        staged.withColumns(
            {
                "type": F.lit(EVENT_APP_LOG),
                "ts": F.when(parsed, F.substring("_prefix", 1, _TS_LENGTH)).otherwise(now),
                "level": F.when(parsed, level).otherwise(F.lit(LEVEL_UNPARSED)),
                "logger": F.when(parsed, logger).otherwise(F.lit(LOGGER_UNKNOWN)),
                "message": F.when(parsed, message).otherwise(text),
            }
        )
        .withColumn("event_time", F.try_to_timestamp(F.col("ts")))
        .drop("_line", "_prefix")
    )


def to_log_event(parsed: DataFrame) -> DataFrame:
    """Parsed lines as audit messages ``(value, headers)``; they carry no key."""
    value = F.to_json(F.struct("type", "ts", "level", "logger", "message"))
    return parsed.select(value.alias("value"), audit_header(AUDIT_APP_LOG).alias("headers"))


def audit_by_level(parsed: DataFrame) -> DataFrame:
    return parsed.groupBy("type", "level").agg(F.count("*").alias("n"))

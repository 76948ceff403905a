"""Rejected-record reports: match ordinals quoted in an error text back to the
records of the submitted batch."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferrum.functions.text import ORDINAL_PATTERN


def error_lines(responses: DataFrame, batch_cols: list[str], text_col: str = "error_text",
                strip: str = "Description:") -> DataFrame:
    """One row per error line: ``(*batch_cols, ordinal, error_message)``.

    ``strip`` is removed first, the text is split on new lines, the ordinal is
    the number between slashes (``/12/``) and the message is the line without it.
    A line without an ordinal is an error of the whole batch: its ordinal is NULL (empty lines
    say nothing and are left out).
    """
    cleaned = F.regexp_replace(F.col(text_col), strip, "") if strip else F.col(text_col)
    lines = responses.select(*batch_cols, F.explode(F.split(cleaned, "\n")).alias("line"))
    ordinal = F.regexp_extract(F.col("line"), ORDINAL_PATTERN, 1)
    return (lines.filter(F.trim("line") != "")
            .select(*batch_cols, F.when(ordinal != "", ordinal).cast("int").alias("ordinal"),
                    F.trim(F.regexp_replace(F.col("line"), ORDINAL_PATTERN, "")).alias("error_message")))


def rejected_records(records: DataFrame, responses: DataFrame, batch_cols: list[str],
                     ordinal_col: str = "ordinal", text_col: str = "error_text") -> DataFrame:
    """Records named by the error text of their batch (inner join on batch + ordinal)."""
    errs = error_lines(responses, batch_cols, text_col)
    return records.join(errs, [*batch_cols, ordinal_col], "inner")

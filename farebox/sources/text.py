"""Raw text lines of a trip file: header removal and lenient parsing."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from farebox.functions.parse import PARSERS, fields

KEPT = "kept"


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per line, column ``value``."""
    return spark.read.text(path)


def first_line(lines: DataFrame) -> str | None:
    """First line of a file: the first row of a split that starts at byte 0.

    (``lines.first()`` alone can return a line from the middle of a file when
    the first partition is not the start of a file.)
    """
    row = lines.where(F.input_file_block_start() == 0).select("value").first()
    return None if row is None else row[0]


def strip_header(lines: DataFrame, header: str | None = None) -> DataFrame:
    """Drop **every** line equal to the header, so each part file's header and
    a header repeated mid-file both go."""
    if header is None:
        header = first_line(lines)
    if header is None:
        return lines
    return lines.where(F.col("value") != F.lit(header))


def parse_lines(lines: DataFrame, spec: list[tuple[int, str, str]], keep: list[str] | None = None,
                seen: Observation | None = None) -> DataFrame:
    """Typed columns from ``spec``; a row with any missing or unparsable field drops.

    Each line is split once and each field parsed once: the parsed row is
    produced by a one-row ``inline`` generator, which the optimizer does not
    look through.  After a plain projection, the not-null filter (and any
    later filter) would be pushed below it by substituting the parse
    expressions into every reference -- re-splitting and re-parsing the line
    a dozen times or more.

    ``seen`` counts, in the same pass, the lines kept and those dropped by
    reason (see ``line_counts``); it is filled by the first action.
    """
    split = lines.select(fields("value").alias("_fields"))
    typed = [PARSERS[kind](F.get(F.col("_fields"), idx)).alias(name) for idx, name, kind in spec]
    width = [F.size("_fields").alias("_width")] if seen is not None else []
    parsed = split.select(F.inline(F.array(F.struct(*typed, *width))))
    names = [name for _, name, _ in spec]
    complete = F.lit(True)
    metrics = []
    for idx, name, kind in spec:
        bad = complete & F.col(name).isNull()
        if seen is not None:
            short = F.col("_width") <= idx
            metrics += [F.count_if(bad & short).alias(f"{name}: missing"),
                        F.count_if(bad & ~short).alias(f"{name}: no {kind}")]
        complete = complete & F.col(name).isNotNull()
    if seen is not None:
        parsed = parsed.observe(seen, F.count_if(complete).alias(KEPT), *metrics)
    return parsed.where(complete).select(*(keep or names))


def line_counts(seen: Observation) -> list[tuple[str, int]]:
    """(reason, lines): ``kept``, and why the others were dropped, by the first
    field of the spec that is missing (short line) or does not parse.  Waits
    for the first action on the parsed lines."""
    return [(reason, n) for reason, n in seen.get.items() if n or reason == KEPT]

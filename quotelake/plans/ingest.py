"""Vendor files to raw and stage tables, new dates only."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from quotelake.operators import conform
from quotelake.plans import feeds
from quotelake.plans.jobs import FileFeedJob
from quotelake.sources.files import (
    read_csv_by_header,
    read_envelope_rows,
    read_header_rows,
    read_json_envelope,
    read_json_strings,
    with_dense_row_id,
    with_row_id,
)
from quotelake.sources.schemas import string_schema

# The vendor CSV feeds of the raw zone.
RAW_FEEDS = ["darkpool", "hotchains", "oichanges", "optiontrades", "optionscreener"]


def build_raw(
    spark: SparkSession,
    paths: str | Sequence[str],
    target: str,
    rerun: Sequence[str] = (),
    multiline: bool = False,
    follow_changes: bool = False,
) -> list[str]:
    """CSV to text Parquet with a unique row id, one partition per file date.

    ``follow_changes`` takes dates again whose files came late or were corrected.
    """

    def read(spark: SparkSession, files: Sequence[str]) -> DataFrame:
        return read_csv_by_header(spark, files, multiline=multiline)

    return FileFeedJob({"rows": (paths, read)}, lambda rows: with_row_id(rows), target, follow_changes=follow_changes).run(spark, rerun)


def build_raw_feeds(spark: SparkSession, landing: str, raw: str, rerun: Sequence[str] = ()) -> dict[str, list[str]]:
    """Every vendor feed below ``landing`` to its table below ``raw``."""
    return {feed: build_raw(spark, f"{landing}/{feed}", f"{raw}/{feed}", rerun) for feed in RAW_FEEDS}


def stage_csv(
    spark: SparkSession,
    paths: str | Sequence[str],
    target: str,
    renames: Mapping[str, str],
    rerun: Sequence[str] = (),
    multiline: bool = False,
) -> list[str]:
    """CSV to renamed text Parquet; absent fields are ''."""

    def read(spark: SparkSession, files: Sequence[str]) -> DataFrame:
        return read_csv_by_header(spark, files, null_as_empty=True, multiline=multiline)

    return FileFeedJob({"rows": (paths, read)}, lambda rows: conform(rows, rename=renames), target).run(spark, rerun)


def stage_json(
    spark: SparkSession,
    paths: str | Sequence[str],
    target: str,
    fields: Sequence[str | Mapping[str, object]],
    rerun: Sequence[str] = (),
) -> list[str]:
    """JSON to text Parquet in the declared schema, numbered per file.

    Only files of pending dates are read, so the numbering sees no others.
    """

    def read(spark: SparkSession, files: Sequence[str]) -> DataFrame:
        return with_dense_row_id(read_json_strings(spark, files, string_schema(fields)), "autonum")

    return FileFeedJob({"rows": (paths, read)}, lambda rows: rows, target).run(spark, rerun)


def stage_earnings(
    spark: SparkSession, reported: str | Sequence[str], upcoming: str | Sequence[str], target: str, rerun: Sequence[str] = ()
) -> list[str]:
    """Reported and upcoming earnings files of a date to one table; either may be missing, or come later."""

    def read(names: Sequence[str]):
        return lambda spark, files: read_envelope_rows(spark, files, "earningsDates", string_schema(names))

    def merge(left: DataFrame | None, right: DataFrame | None) -> DataFrame:
        if left is None:
            none = string_schema([*feeds.REPORTED_EARNINGS, feeds.DAY])
            left = right.sparkSession.createDataFrame([], none)
        if right is None:
            right = left.select("Symbol", feeds.DAY).limit(0)
        return feeds.earnings_calendar(left, right)

    sources = {
        "left": (reported, read(feeds.REPORTED_EARNINGS)),
        "right": (upcoming, read(list(feeds.UPCOMING_EARNINGS))),
    }
    return FileFeedJob(sources, merge, target, follow_changes=True).run(spark, rerun)


def stage_analyst_scores(
    spark: SparkSession, consensus: str | Sequence[str], research: str | Sequence[str], target: str, rerun: Sequence[str] = ()
) -> list[str]:
    """Analyst consensus and research scores; a date without research waits for it."""

    def read(schema):
        return lambda spark, files: read_json_envelope(spark, files, schema, feeds.DAY)

    sources = {"left": (consensus, read(feeds.ANALYST_SCHEMA)), "right": (research, read(feeds.RESEARCH_SCHEMA))}
    job = FileFeedJob(sources, lambda left, right: feeds.analyst_scores(left, right), target, required=["right"])
    return job.run(spark, rerun)


def stage_technical_rank(
    spark: SparkSession, paths: Mapping[str, str | Sequence[str]], target: str, rerun: Sequence[str] = ()
) -> list[str]:
    """Header-plus-rows files of each capitalisation class (``largecap``, ...); some may be missing, or come later."""
    row = string_schema([c for c in feeds.TECHNICAL_COLUMNS if c not in ("date", "marketcaptype", feeds.DAY)])

    def read(spark: SparkSession, files: Sequence[str]) -> DataFrame:
        return read_header_rows(spark, files, row)

    def stack(**frames: DataFrame | None) -> DataFrame:
        return feeds.technical_rank({name: f for name, f in frames.items() if f is not None})

    return FileFeedJob({name: (p, read) for name, p in paths.items()}, stack, target, follow_changes=True).run(spark, rerun)


def stage_bars(spark: SparkSession, paths: str | Sequence[str], target: str, rerun: Sequence[str] = ()) -> list[str]:
    """Price bars inside ``results`` envelopes."""
    bar = feeds.BARS_SCHEMA["results"].dataType.elementType

    def read(spark: SparkSession, files: Sequence[str]) -> DataFrame:
        return read_envelope_rows(spark, files, "results", bar)

    return FileFeedJob(
        {"rows": (paths, read)}, lambda rows: feeds.intraday_bars(rows, keep=[feeds.DAY]), target
    ).run(spark, rerun)

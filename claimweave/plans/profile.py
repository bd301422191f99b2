"""The corpus profile job: four reports from one pass over the articles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimweave.operators import profiling
from claimweave.scale import materialize
from claimweave.sources.tables import write_reports


def reports(articles: DataFrame, expected_rows: int | None = None) -> dict[str, DataFrame]:
    """Report tables. The texts are read once: everything derives from a stored record per label.

    A row count other than ``expected_rows`` is an error; it comes from the same record.
    """
    record = materialize(profiling.label_record(articles), "profile")
    if expected_rows is not None:
        profiling.check_rows(record.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0], expected_rows)
    return profiling.reports_of(record)


def profile(articles: DataFrame, directory: str, expected_rows: int | None = None) -> None:
    write_reports(reports(articles, expected_rows), directory)

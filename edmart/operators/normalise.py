"""Derived columns that are stored with their table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from edmart.functions import text


def normalise_sources(sources: DataFrame) -> DataFrame:
    """(Re)compute ``cleaned_name`` and ``src_host``."""
    return sources.withColumns(
        {"cleaned_name": text.cleaned_name("source_name"), "src_host": text.src_host("source_base_url")}
    )


def normalise_universities(universities: DataFrame) -> DataFrame:
    """(Re)compute ``uni_host``."""
    return universities.withColumns({"uni_host": text.uni_host("webaddr")})

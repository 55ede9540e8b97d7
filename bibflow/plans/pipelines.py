"""Pipelines O01-O03: JSON text -> record-level relation -> keyed table.

Each takes a DataFrame with a JSON text column (from any source: the file
readers, a stream micro-batch, or derived data) and returns a lazy
DataFrame; nothing is collected.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame

from bibflow import schemas
from bibflow.functions.json import parse_once
from bibflow.operators.flatten import (
    cross_explode,
    filter_records,
    flatten_nested,
    flatten_scraped,
    render_elements,
    to_table_rows,
)
from bibflow.operators.upsert import merge_feeds, upsert_records


def nested_relation(df: DataFrame, text_col: str = "record", keep: Sequence[str] = ()) -> DataFrame:
    """Nested JSON text -> typed record-level relation (S13 + P01..P13)."""
    return flatten_nested(parse_once(df, text_col, schemas.NESTED_RECORD, "rec", keep), "rec", keep=keep)


def scraped_relation(df: DataFrame, text_col: str = "record", keep: Sequence[str] = ()) -> DataFrame:
    """Scraped JSON text -> the same typed record-level relation."""
    return flatten_scraped(parse_once(df, text_col, schemas.SCRAPED_RECORD, "rec", keep), "rec", keep=keep)


def exploded_rows(records: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Filter, then the author x subject fan-out in table form (K05 rows)."""
    return to_table_rows(cross_explode(render_elements(filter_records(records))), keep=keep, rendered=True)


def nested_pipeline(df: DataFrame, order: Sequence[str | Column] = ("seq",),
                    text_col: str = "record") -> DataFrame:
    """Nested feed -> one row per DOI."""
    keep = [o for o in order if isinstance(o, str)]
    return upsert_records(filter_records(nested_relation(df, text_col, keep)), order)


def scraped_pipeline(df: DataFrame, order: Sequence[str | Column] = ("seq",),
                     text_col: str = "record") -> DataFrame:
    """Scraped feed -> one row per DOI."""
    keep = [o for o in order if isinstance(o, str)]
    return upsert_records(filter_records(scraped_relation(df, text_col, keep)), order)


def merged_pipeline(nested: DataFrame, scraped: DataFrame, order: Sequence[str] = ("seq",),
                    text_col: str = "record", fill_nulls: bool = False) -> DataFrame:
    """Both feeds into one keyed table; the scraped feed wins a shared DOI
    (per column with ``fill_nulls``: its NULLs keep the nested feed's values)."""
    feeds = [filter_records(nested_relation(nested, text_col, order)),
             filter_records(scraped_relation(scraped, text_col, order))]
    return merge_feeds(feeds, order=list(order), fill_nulls=fill_nulls)

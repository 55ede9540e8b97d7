"""Keyed latest-record maintenance (K01) and feed merging.

A keyed table keeps one row per key: the row that is greatest under a
*total* order (arrival order first, then tie-breakers).  This is expressed
as ``groupBy(key).agg(max_by(struct(row), struct(order)))`` rather than a
``row_number`` window: the aggregate is split into a map-side partial step,
so a key that holds a third of all rows is reduced inside every map task
before the shuffle, and no task ever sorts a whole hot key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bibflow.operators.flatten import RECORD_LEVEL_NAMES, to_table_rows
from bibflow.schemas import RECORD_NAMES

_ROW, _RANK = "__row", "__rank"


def _cols(cols: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def latest_per_key(df: DataFrame, key: str | Sequence[str], order: Sequence[str | Column],
                   columns: Sequence[str] | None = None,
                   fill_nulls: Sequence[str] | None = None) -> DataFrame:
    """One row per key: the row with the greatest ``order``.

    ``order`` must be a total order within a key (add tie-breakers until it
    is), otherwise the survivor is arbitrary.  NULLs order first, so a row
    with a NULL order field loses to any row that has a value there.

    ``fill_nulls`` names columns that are *not* replaced by a NULL: each takes
    its value from the latest row where it is not NULL.  Other columns follow
    the latest row as a whole.  Every column then needs the order, which may
    hold whole JSON texts: the rows are shuffled once, ranked within their key
    and compared by that number, so that the order is not repeated per column.
    """
    keys = [key] if isinstance(key, str) else list(key)
    payload = [c for c in (columns or df.columns) if c not in keys]
    order_struct = F.struct(*_cols(order))
    filled = [c for c in payload if fill_nulls and c in fill_nulls]
    whole = [c for c in payload if c not in filled]
    if filled:
        df = df.withColumn(_RANK, F.row_number().over(Window.partitionBy(*keys).orderBy(order_struct)))
        order_struct = F.col(_RANK)
    aggs = [F.max_by(F.struct(*[F.col(c) for c in whole]), order_struct).alias(_ROW)]
    aggs += [F.max_by(F.col(c), F.when(F.col(c).isNotNull(), order_struct)).alias(c) for c in filled]
    out = df.groupBy(*keys).agg(*aggs)
    return out.select(*[F.col(k) for k in keys],
                      *[F.col(_ROW).getField(c).alias(c) if c in whole else F.col(c) for c in payload])


def pick_max_elements(df: DataFrame, subjects: str = "subject_areas", authors: str = "authors",
                      subject: str = "subject", author: str = "author") -> DataFrame:
    """Reduce a record's fan-out to the one row K01 would keep.

    Among the ``#subjects x #authors`` rows of one record, the greatest
    under (subject, author) order is (greatest subject, greatest author), so
    it is computed from the arrays directly and the fan-out is never built.
    ``array_max`` skips NULL elements and yields NULL for an empty array, as
    ``explode_outer`` yields one NULL row.
    """
    return (df.withColumn(subject, F.array_max(subjects))
              .withColumn(author, F.array_max(authors))
              .drop(subjects, authors))


ORDER_COL = "__order"


def keyed_rows(records: DataFrame, order: Sequence[str | Column], key: str = "doi",
               fill_nulls: bool = False) -> DataFrame:
    """Typed record-level relation -> one table row per key, plus ``__order``.

    ``order`` is the arrival order of records (feed rank, position, ...);
    within one record the surviving author/subject is the greatest, which
    makes the whole order total.  The row is picked before anything is
    rendered, so JSON text is built for survivors only.
    """
    picked = pick_max_elements(records).withColumn(
        ORDER_COL, F.struct(*_cols(order), F.col("subject"), F.col("author")))
    if fill_nulls:
        # Per table column: the latest non-NULL value.  Columns are compared
        # in table form, so e.g. a record without subjects does not blank the
        # subject columns another record filled.
        rendered = to_table_rows(picked, keep=[ORDER_COL])
        cols = [c for c in RECORD_NAMES if c != key]
        return latest_per_key(rendered, key, [F.col(ORDER_COL)], columns=[*cols, ORDER_COL],
                              fill_nulls=cols)
    # The order holds subject and author, so the row is moved without another copy of them.
    payload = [c for c in RECORD_LEVEL_NAMES if c not in ("subject_areas", "authors")]
    latest = latest_per_key(picked.drop("subject", "author"), key, order=[F.col(ORDER_COL)], columns=[*payload, ORDER_COL])
    latest = latest.withColumns({c: F.col(ORDER_COL).getField(c) for c in ("subject", "author")})
    return to_table_rows(latest, keep=[ORDER_COL])


def upsert_records(records: DataFrame, order: Sequence[str | Column],
                   key: str = "doi", fill_nulls: bool = False) -> DataFrame:
    """Typed record-level relation -> keyed table rows (one per DOI).

    ``fill_nulls=True``: a later record does not overwrite a value with NULL;
    each table column keeps its latest non-NULL value.
    """
    return keyed_rows(records, order, key, fill_nulls).drop(ORDER_COL)


def with_feed_rank(df: DataFrame, rank: int, name: str = "feed_rank") -> DataFrame:
    return df.withColumn(name, F.lit(rank))


def merge_feeds(feeds: Sequence[DataFrame], order: Sequence[str | Column] = (),
                key: str = "doi", rank_col: str = "feed_rank", fill_nulls: bool = False) -> DataFrame:
    """Several record-level feeds into one keyed table.

    Feeds are ranked by position (later wins on a shared key, as a later
    load overwrites an earlier one) and unioned by name.
    """
    ranked = [with_feed_rank(f, i + 1, rank_col) for i, f in enumerate(feeds)]
    union = ranked[0]
    for other in ranked[1:]:
        union = union.unionByName(other, allowMissingColumns=True)
    return upsert_records(union, order=[F.col(rank_col), *_cols(order)], key=key, fill_nulls=fill_nulls)

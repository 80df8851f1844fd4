"""From delivered pages to the revisions that count: filters, the latest N per page, the character budget.

Throughout, a revision delivered several times counts once: (page_id, rev_id) names it.
Null texts are kept and give no tokens; a null ts is before all others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexmill import config
from lexmill.functions import columns as C


def special_pages(df: DataFrame, ids: DataFrame | list[int] | None, key: str = "page_id") -> DataFrame:
    """Rows of the listed pages; no or an empty list keeps all. A table of ids is joined, Spark choosing how."""
    if ids is None or ids == []:
        return df
    if isinstance(ids, list):
        return df.where(F.col(key).isin(ids))
    return df.join(ids.select(F.col(ids.columns[0]).alias(key)).where(F.col(key).isNotNull()), key, "left_semi")


def time_range(df: DataFrame, start: str | None = None, end: str | None = None, ts: str = "ts") -> DataFrame:
    """Rows strictly after ``start`` and before ``end`` (yyyy-MM-ddTHH:mm). An empty start is open; an empty end is a day from now."""
    if not start and not end:
        return df
    if start:
        df = df.where(F.col(ts) > C.parse_time(F.lit(start)))
    return df.where(F.col(ts) < (C.parse_time(F.lit(end)) if end else F.current_timestamp() + F.expr("INTERVAL 24 HOURS")))


def where_all(df: DataFrame, *predicates: Column) -> DataFrame:
    """Rows for which every predicate is true: the seam for a caller's own page and revision filters."""
    for p in predicates:
        df = df.where(p)
    return df


def latest_revisions(revs: DataFrame, n: int, page: str = "page_id", ts: str = "ts", tie: str = "rev_id", many_copies: bool = False) -> DataFrame:
    """The latest n revisions of each page; equal times: the higher ``tie``.

    Ranked with copies sharing a rank, so each task keeps at most n revisions of a page, with their copies, before anything
    is sent: a page with a third of all revisions is no hot key.  Where one revision may be delivered very many times,
    ``many_copies`` lets each task drop its copies first, for one more exchange.
    """
    if many_copies:
        revs = revs.dropDuplicates([page, tie])
    order = Window.partitionBy(page).orderBy(F.col(ts).desc_nulls_last(), F.col(tie).desc())
    top = revs.withColumn("_lexmill_rank", F.dense_rank().over(order)).where(F.col("_lexmill_rank") <= n).drop("_lexmill_rank")
    return top.dropDuplicates([page, tie])


def latest_by_arrival(revs: DataFrame, n: int, page: str = "page_id", ts: str = "ts", seq: str = "seq") -> DataFrame:
    """The n revisions that a heap keeps which always replaces its oldest element, even by an older newcomer.

    Equal to ``latest_revisions`` for ascending arrival.  With arrivals in order of ``seq``, the heap's first n
    are all kept; afterwards every newcomer stays until it is the oldest itself.  Needs a page's
    revisions in order: for compatibility tests only, the state is n rows per page.
    """
    import pandas as pd

    def keep(pdf: pd.DataFrame) -> pd.DataFrame:
        held: list[int] = []
        pdf = pdf.sort_values(seq, kind="stable").reset_index(drop=True)
        for i, t in enumerate(pdf[ts]):
            if len(held) == n:
                held.remove(min(held, key=lambda k: pdf[ts][k]))
            held.append(i)
        return pdf.iloc[sorted(held)]

    return revs.groupBy(page).applyInPandas(keep, revs.schema)


def char_budget(revs: DataFrame, budget: int = config.CHAR_BUDGET, page: str = "page_id") -> DataFrame:
    """``text`` of each page's revisions in order of time while their running length is within the budget; null from the first overflow on."""
    order = Window.partitionBy(page).orderBy(F.col("ts").asc_nulls_first(), "rev_id").rowsBetween(Window.unboundedPreceding, 0)
    used = F.sum(F.coalesce(F.length("text"), F.lit(0))).over(order)
    return revs.withColumn("text", F.when(used <= budget, F.col("text")))

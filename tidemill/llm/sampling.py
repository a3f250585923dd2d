"""Bounded samples of labelled rows for fitting classifiers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm.common import hash_share

MAX_GROUPS = 1000


def bounded_sample(rows: DataFrame, id_col: str, group_col: str, per_group: int, seed: int) -> DataFrame:
    """Rows of ``rows`` whose ids hash into the first ``per_group / n`` of a group of ``n`` rows.

    About ``per_group`` rows of each group, all if it has no more. Counting combines inside tasks and
    the choice is a filter, so no group meets in one task, whatever its size. Of more than
    ``MAX_GROUPS`` groups the largest are taken. Rows without an id or group are left out.
    """
    known = rows.where(F.col(id_col).isNotNull() & F.col(group_col).isNotNull())
    counts = known.groupBy(group_col).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), group_col).limit(MAX_GROUPS).collect()
    share = hash_share(F.lit(seed), F.col(id_col))
    wanted = F.lit(False)
    if counts:
        pairs = [x for r in counts for x in (F.lit(str(r[0])), F.lit(per_group / r["n"]))]
        wanted = share < F.element_at(F.create_map(*pairs), F.col(group_col).cast("string"))
    return known.where(F.coalesce(wanted, F.lit(False)))

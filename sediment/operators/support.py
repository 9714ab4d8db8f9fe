"""Rows that need each other: which of them are left without what they need."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sediment.operators.lookup import Sized, hot_keys, lookup
from sediment.operators.remap import ROW
from sediment.staging import Staging

# Which table a row is of; the group of rows it stands in for; the table and the group it needs.
KIND, GROUP, WANT_KIND, WANT = "kind", "group", "want_kind", "want"


def unsupported(members: DataFrame, wants: DataFrame, staging: Staging, limit: int | None = None) -> DataFrame:
    """`kind` and ROW of the rows that cannot stay.

    members  `kind`, ROW, `group`: every row; a null group is one nothing can need.
    wants    the same columns with `want_kind`, `want`: a row for each group a row needs, null if there is no such group.

    A row cannot stay if one of its groups has no row that stays. Rows that need nothing but each other stay. Only rows
    that fall are followed: a round looks at the groups the last one took rows from, so there are as
    many rounds as the longest chain of rows that fall, and none of them reads rows that nothing happens to but for one join.
    """
    row = [KIND, *ROW]
    sizes = staging.write("sizes", members.where(F.col(GROUP).isNotNull()).groupBy(KIND, GROUP).agg(F.count(F.lit(1)).alias("n")))
    wants = staging.write("wants", wants)
    last = staging.write("fallen/0", wants.where(F.col(WANT).isNull()).select(*row, GROUP).distinct())
    # One scan over the rounds so far, however many there are.
    rounds = staging.spark.read.schema(last.schema).option("recursiveFileLookup", "true")
    hot, n = None, 0
    while not last.isEmpty():
        n += 1
        fallen = rounds.parquet(f"{staging.root}/fallen")
        touched = last.select(KIND, GROUP).distinct()
        counted = fallen.join(touched, [GROUP, KIND], "left_semi").groupBy(KIND, GROUP).agg(F.count(F.lit(1)).alias("n"))
        emptied = counted.join(sizes, [GROUP, KIND, "n"], "left_semi")
        emptied = Sized.of(staging.write(f"emptied/{n}", emptied.select(KIND, GROUP, F.lit(n).alias("round"))))
        on = {WANT: GROUP, WANT_KIND: KIND}
        if hot is None and not emptied.fits(limit):
            # Every round joins the same rows.
            hot = hot_keys(wants, list(on))
        hit = lookup(wants, emptied, on, {"round": "_round"}, "inner", row, limit, hot=hot)
        more = hit.select(*row, GROUP).distinct().join(fallen.select(*row), row[::-1], "left_anti").select(*row, GROUP)
        last = staging.write(f"fallen/{n}", more)
    return rounds.parquet(f"{staging.root}/fallen").select(*row)

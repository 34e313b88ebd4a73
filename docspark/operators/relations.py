"""Existence filters between a child set and its parent set.

Both return a Column that composes under `&`, `|` and `none_of`. Catalyst plans a
left semi join when the filter stands alone or under `&`, a left anti join under
negation, and an existence join inside `|`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from docspark.operators.mutate import content_hash
from docspark.operators.predicates import all_of, none_of

#: A key that more than this share of the rows have is joined apart.
HEAVY = 0.01
_KEY, _COUNT, _SALT = "_related_key", "_related_count", "_related_salt"


def has_child(
    children: DataFrame,
    parent_id: str,
    child_fk: str,
    where: Column | None = None,
    min_children: int | None = None,
    max_children: int | None = None,
) -> Column:
    """Rows whose matching children number at least 1, or lie within the bounds.

    Children are reduced to one row per parent before the join, with partial
    aggregation, so a parent that owns a large share of them costs one row per
    task in the shuffle. Without a bound of 0 a row needs at least one child.
    """
    low, high = _bound("min_children", min_children), _bound("max_children", max_children)
    if low is not None and high is not None and low > high:
        raise ValueError("min_children must not be greater than max_children")
    matching = children if where is None else children.where(where)
    keys = matching.select(F.col(child_fk).alias(_KEY))
    if (low is None or low <= 1) and high is None:
        return F.lit(True) if low == 0 else _exists(keys.distinct(), parent_id)
    counts = keys.where(F.col(_KEY).isNotNull()).groupBy(_KEY).agg(F.count(F.lit(1)).alias(_COUNT))
    if low == 0:
        return none_of(_exists(counts.where(F.col(_COUNT) > high), parent_id))
    kept = counts.where(F.col(_COUNT) >= (1 if low is None else low))
    if high is not None:
        kept = kept.where(F.col(_COUNT) <= high)
    return _exists(kept, parent_id)


def heavy_keys(rows: DataFrame, key: str, share: float = HEAVY) -> list:
    """The values of a column that more than a share of the rows have, at most 1 / share of them.

    One count by value, summed in each task before the shuffle.
    """
    if not 0 < share <= 1:
        raise ValueError("the share must be above 0 and at most 1")
    counts = rows.groupBy(F.col(key).alias(_KEY)).agg(F.count(F.lit(1)).alias(_COUNT)).where(F.col(_KEY).isNotNull())
    enough = F.col(_COUNT) > share * rows.agg(F.count(F.lit(1))).scalar()
    return [r[0] for r in counts.where(enough).select(_KEY).collect()]


def has_parent(
    parents: DataFrame,
    child_fk: str,
    parent_id: str,
    where: Column | None = None,
    salt: int = 1,
    salt_by: str | None = None,
    rows: DataFrame | None = None,
    share: float = HEAVY,
) -> Column:
    """Rows whose parent matches.

    Alone, under `&` or negated, adaptive execution splits the partition of a
    parent that owns a large share of the rows. It does not split the existence
    join that `|` plans, nor a join whose rows come from another relation. Give the
    filtered frame in `rows` there: its keys are counted, and where some own more than `share` of
    the rows, those rows are spread over as many tasks as a shuffle has, by their
    content, and the ids of those parents alone are repeated for each. All other rows are
    joined as before. `salt` with `salt_by` spreads the rows of every parent, uncounted.
    """
    keys = (parents if where is None else parents.where(where)).select(F.col(parent_id).alias(_KEY))
    if rows is not None:
        heavy = heavy_keys(rows, child_fk, share)
        if not heavy:
            return _exists(keys, child_fk)
        spread = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        every, one = F.sequence(F.lit(0), F.lit(spread - 1)), F.array(F.lit(0))
        salted = keys.withColumn(_SALT, F.explode(F.when(F.col(_KEY).isin(heavy), every).otherwise(one)))
        own = F.when(F.col(child_fk).isin(heavy), F.pmod(content_hash(rows), F.lit(spread)).cast("int")).otherwise(F.lit(0))
        return _exists(salted, child_fk, F.col(_SALT) == own.outer())
    if salt <= 1:
        return _exists(keys, child_fk)
    if salt_by is None:
        raise ValueError("salt needs salt_by")
    salted = keys.withColumn(_SALT, F.explode(F.sequence(F.lit(0), F.lit(salt - 1))))
    row_salt = F.pmod(F.xxhash64(F.col(salt_by)), F.lit(salt)).cast("int")
    return _exists(salted, child_fk, F.col(_SALT) == row_salt.outer())


def _exists(keys: DataFrame, outer_key: str, *also: Column) -> Column:
    # A name is looked up in the inner query first, and past a projection too. The
    # alias ends that search, so only the key columns can be taken for outer ones.
    return keys.alias("_related").where(all_of(F.col(_KEY) == F.col(outer_key).outer(), *also)).exists()


def _bound(name: str, value) -> int | None:
    if value is None:
        return None
    try:
        bound = int(value)
    except (TypeError, ValueError):
        raise ValueError(f"{name} must be a number") from None
    if bound < 0:
        raise ValueError(f"{name} must not be negative")
    return bound

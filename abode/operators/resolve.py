"""One row per key: latest / first observation, group sizes, source unions.

"First" and "latest" are defined by an explicit total order (date, source
rank, landing sequence), never by arrival order, so results do not depend
on partitioning and are recomputed identically after an executor loss.

The default pick is ``row_number() = 1`` over the key, which Spark 3.5+
plans as a *partial* ``WindowGroupLimit`` before the shuffle and a final
one after: every map task keeps at most one row per key, so a key holding
a third of all rows is reduced before it moves and no task ever holds a
whole hot group. ``method="aggregate"`` gives the same rows with
``min_by(struct(payload), struct(order))`` (partial + final aggregate);
measured slower at high key cardinality, equal at low.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

Order = Sequence[tuple[str, str]]  # (column, "asc" | "desc"); NULLs always last


def _negate(df: DataFrame, name: str) -> Column:
    dtype = df.schema[name].dataType
    c = F.col(name)
    if isinstance(dtype, T.DateType):
        return -F.unix_date(c)
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return -F.unix_micros(c.cast("timestamp"))
    if isinstance(dtype, T.NumericType):
        return -c
    if isinstance(dtype, T.BooleanType):
        return ~c
    raise TypeError(f"descending order on {dtype} is not supported for {name}")


def order_struct(df: DataFrame, order: Order) -> Column:
    """Struct whose natural ascending order is ``order`` with NULLs last."""
    fields = []
    for i, (name, direction) in enumerate(order):
        fields.append(F.isnull(F.col(name)).alias(f"n{i}"))
        value = _negate(df, name) if direction == "desc" else F.col(name)
        fields.append(value.alias(f"v{i}"))
    return F.struct(*fields)


def _sort_exprs(order: Order) -> list[Column]:
    return [F.col(n).desc_nulls_last() if d == "desc" else F.col(n).asc_nulls_last() for n, d in order]


def pick_per_key(
    df: DataFrame, keys: str | Sequence[str], order: Order, method: str = "window"
) -> DataFrame:
    """Keep the first row of each key group under ``order``.

    ``order`` must be total within a group (end it with a unique sequence
    column) for a deterministic result.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    payload = [c for c in df.columns if c not in keys]
    if not payload:
        return df.distinct()
    if method == "window":
        w = Window.partitionBy(*keys).orderBy(*_sort_exprs(order))
        return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")
    picked = F.min_by(F.struct(*payload), order_struct(df, order)).alias("_pick")
    return df.groupBy(*keys).agg(picked).select(*keys, "_pick.*").select(*df.columns)


def latest_per_key(
    df: DataFrame, key: str | Sequence[str], ts: str, tie_breakers: Sequence[str] = ()
) -> DataFrame:
    """Newest ``ts`` per key (missing dates last), ties by ``tie_breakers`` ascending."""
    return pick_per_key(df, key, [(ts, "desc")] + [(c, "asc") for c in tie_breakers])


def first_per_key(df: DataFrame, key: str | Sequence[str], order_cols: Sequence[str]) -> DataFrame:
    """First row per key in the given ascending order (arrival order = rank, seq)."""
    return pick_per_key(df, key, [(c, "asc") for c in order_cols])


def group_sizes(df: DataFrame, keys: str | Sequence[str], name: str = "n") -> DataFrame:
    """(keys..., n): partial-aggregated counts; NULL keys form one group."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def with_group_size(df: DataFrame, keys: str | Sequence[str], name: str = "n") -> DataFrame:
    """Attach the size of each row's key group to every row.

    Counts are aggregated (map-side combine) and joined back null-safely; a
    hot key is one count row, and AQE splits the skewed join partition.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    sizes = group_sizes(df, keys, name)
    renamed = sizes.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], name)
    cond = None
    for i, k in enumerate(keys):
        c = df[k].eqNullSafe(renamed[f"_k{i}"])
        cond = c if cond is None else cond & c
    return df.join(renamed, cond, "inner").drop(*[f"_k{i}" for i in range(len(keys))])


def duplicated_rows(df: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Every row whose key occurs more than once (both directions)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return with_group_size(df, keys, "_n").where("_n > 1").drop("_n")


def union_sources(
    frames: Sequence[tuple[str, DataFrame]],
    source_col: str = "SOURCE",
    rank_col: str = "source_rank",
) -> DataFrame:
    """UNION ALL by name (missing columns NULL), tagging source and precedence.

    The list order is the precedence used to break ties on equal dates.
    """
    out = None
    for rank, (name, df) in enumerate(frames):
        tagged = df
        if source_col not in df.columns:
            tagged = tagged.withColumn(source_col, F.lit(name))
        tagged = tagged.withColumn(rank_col, F.lit(rank))
        out = tagged if out is None else out.unionByName(tagged, allowMissingColumns=True)
    return out


def _exclude(df: DataFrame, value: str, exclude: Sequence) -> DataFrame:
    cond = F.col(value).isNotNull()
    if exclude:
        cond = cond & ~F.col(value).isin(list(exclude))
    return df.where(cond)


def resolve_latest(
    obs: DataFrame,
    key: str,
    value: str,
    ts: str,
    exclude: Sequence = (),
    rank: str = "source_rank",
    seq: str = "seq",
) -> DataFrame:
    """Latest usable observation per key.

    Drops missing keys and values and the attribute's "unknown" values, then
    keeps the newest date per key; equal dates go to the higher-precedence
    source, then the earlier landed row.
    """
    kept = _exclude(obs.where(F.col(key).isNotNull()), value, exclude)
    return latest_per_key(kept, key, ts, [rank, seq])


def resolve_latest_numeric(
    df: DataFrame,
    key: str,
    ts: str,
    post: str,
    pre: str,
    out: str,
    rank: str = "source_rank",
    seq: str = "seq",
) -> DataFrame:
    """Latest non-missing of coalesce(post, pre) per key."""
    filled = df.withColumn(out, F.coalesce(F.col(post), F.col(pre)))
    kept = filled.where(F.col(out).isNotNull() & F.col(key).isNotNull()).drop(post, pre)
    return latest_per_key(kept, key, ts, [rank, seq])


def resolve_first(
    obs: DataFrame,
    key: str,
    value: str,
    exclude: Sequence = (),
    rank: str = "source_rank",
    seq: str = "seq",
) -> DataFrame:
    """First usable observation per key in arrival order (source, then row)."""
    kept = _exclude(obs.where(F.col(key).isNotNull()), value, exclude)
    return first_per_key(kept, key, [rank, seq])

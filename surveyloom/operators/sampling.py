"""Deterministic samples and splits by hash of the row key.

Membership depends on md5(seed:key) alone, so it does not change with
partitioning, ordering or retries.  Exact sizes come from an exact rank of the
hash, never from sorting the table or a class in one task.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveyloom.functions import hash52, ident, local_table, quote
from surveyloom.functions.columns import HASH52_RANGE
from surveyloom.operators.features import class_counts
from surveyloom.operators.ranks import DISTINCT_LIMIT, group_sizes, rank_select


def sample_n(df: DataFrame, key: str, n: int, *, seed: int = 42) -> DataFrame:
    """Exactly min(n, rows) rows without replacement: the n smallest key hashes.

    A uniform hash says where the n-th smallest must lie, so all but about n
    candidates are filtered out before the top-n; if that bound ever misses, the
    bound is lifted, so the size is always exact.
    """
    total = df.count()
    if total <= n:
        return df
    h = hash52(key, seed)
    bound = min(1.0, (n + 8.0 * math.sqrt(n) + 16.0) / total)
    near = df.where(f"{h} < {int(bound * HASH52_RANGE)}")
    if bound < 1.0 and near.limit(n).count() < n:
        near = df
    return near.orderBy(F.expr(h), quote(key)).limit(n)


def _allocate(counts: list[tuple], draws: int) -> dict:
    """Largest-remainder allocation of ``draws`` over the classes."""
    total = sum(n for _, n in counts)
    shares = [(c, n * draws / total) for c, n in counts]
    given = {c: math.floor(x) for c, x in shares}
    left = draws - sum(given.values())
    for c, x in sorted(shares, key=lambda cx: -(cx[1] - math.floor(cx[1])))[:left]:
        given[c] += 1
    return given


def split_quotas(counts: list[tuple], *, test: float = 0.2, validation: float = 0.25) -> dict:
    """{class: (train, validation, test)} rows; 20 % test, then 25 % of the rest."""
    total = sum(n for _, n in counts)
    rest = total - math.ceil(test * total)
    rest_of = _allocate(counts, rest)
    train_of = _allocate([(c, rest_of[c]) for c, _ in counts], rest - math.ceil(validation * rest))
    return {c: (train_of[c], rest_of[c] - train_of[c], n - rest_of[c]) for c, n in counts}


def _cuts(df: DataFrame, key: str, seed: int, wanted: dict, by: str) -> dict:
    """Hash values at the given ranks per group."""
    values = df.selectExpr(ident(by), f"cast({hash52(key, seed)} as double) as value")
    return rank_select(values, wanted, by=[by], sizes=group_sizes(values, [by]), limit=DISTINCT_LIMIT)


def stratified_split(
    df: DataFrame,
    label: str,
    key: str,
    *,
    test: float = 0.2,
    validation: float = 0.25,
    seed: int = 42,
    out: str = "split",
) -> DataFrame:
    """Add train / validation / test, each class split in the same proportions.

    Each class's cut points are exact ranks of the key hash; the rows themselves
    are labelled by a comparison, without any shuffle.  Rows without a label are
    left out, as they have no stratum.
    """
    labelled = df.where(quote(label).isNotNull())
    quotas = split_quotas(class_counts(labelled, label), test=test, validation=validation)
    wanted = {}
    for c, (n_train, n_val, _) in quotas.items():
        wanted[(c,)] = sorted({r for r in (n_train - 1, n_train + n_val - 1) if r >= 0})
    cuts = _cuts(labelled, key, seed, wanted, label)
    # (label, train cut, validation cut); an empty part has a cut below every hash.
    rows = []
    for c, (n_train, n_val, _) in quotas.items():
        at = lambda r: int(cuts[(c,)][r]) if r >= 0 else -1
        rows.append((c, at(n_train - 1), at(n_train + n_val - 1)))
    kind = df.schema[label].dataType.simpleString()
    table = local_table(df.sparkSession, rows, f"{ident(label)} {kind}, train_ long, validation_ long")
    return (
        labelled.withColumn("hash_", F.expr(hash52(key, seed)))
        .join(F.broadcast(table), label)
        .withColumn(out, F.expr("case when hash_ <= train_ then 'train' when hash_ <= validation_ then 'validation' else 'test' end"))
        .select(*[quote(c) for c in df.columns], out)
    )


def random_split(
    df: DataFrame, key: str, *, test: float = 0.3, seed: int = 0, exact: bool = True, out: str = "split"
) -> DataFrame:
    """Unstratified train / test split; ceil(test·n) test rows when ``exact``.

    With ``exact=False`` the cut is the hash range itself: one projection, no
    pass over the data, sizes right in expectation.
    """
    h = hash52(key, seed)
    if not exact:
        return df.withColumn(out, F.expr(f"if({h} < {int((1.0 - test) * HASH52_RANGE)}, 'train', 'test')"))
    total = df.count()
    n_train = total - math.ceil(test * total)
    if n_train == 0:
        return df.withColumn(out, F.lit("test"))
    one = df.select(quote(key), F.lit(0).alias("all_"))
    cut = _cuts(one, key, seed, {(0,): [n_train - 1]}, "all_")[(0,)][n_train - 1]
    return df.withColumn(out, F.expr(f"if({h} <= {int(cut)}, 'train', 'test')"))

"""Isolation forest over a feature table (Liu, Ting and Zhou, ICDM 2008), scored natively.

All chance comes from md5 of the seed with a row, tree or node, so any engine that has md5
grows the same forest. Fitting: a row's number, run through one linear function per tree,
says whether it is in that tree's sample; about `trees * size` rows are shuffled, by tree,
whatever the size of the table, and each tree grows in its own task. Trees are heaps: node k
has the children 2k and 2k+1, and a leaf above the last level lets everything pass to 2k, so
a walk takes the same number of steps everywhere. Scoring: the forest, at most
`trees * 2 * size` numbers, is one value that every task gets, and rows are scored where
they lie.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from marketlens.functions.columns import round_even
from marketlens.operators.selection import exact_quantile
from marketlens.session import stored

# Features, number of trees, rows per tree, share of outliers, seed.
FEATURES = ["revenue", "orders", "aov", "sla_breach_rate"]
TREES = 200
SAMPLE_SIZE = 256
CONTAMINATION = 0.08
SEED = 42
MIN_ROWS = 10

# linear functions modulo this prime deal rows to trees
PRIME = (1 << 31) - 1
# path lengths are whole numbers of this part, so that their sum is exact
LENGTH_UNIT = 1_000_000_000
SCORE_DIGITS = 10
EULER = 0.5772156649015329
_SERIES = "_series"


def number(*parts: Column | str | int) -> Column:
    """52 bits from the md5 of the parts, joined by a bar; null parts count as empty."""
    texts = [F.coalesce((p if isinstance(p, Column) else F.lit(str(p))).cast("string"), F.lit("")) for p in parts]
    return F.conv(F.substring(F.md5(F.concat_ws("|", *texts).cast("binary")), 1, 13), 16, 10).cast("bigint")


def levels_of(size: int) -> int:
    return max(1, math.ceil(math.log2(max(size, 2))))


def _vector(features: Sequence[str]) -> Column:
    """Features as numbers; null and NaN count as 0."""
    return F.array(*[F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(0.0)), F.lit(0.0)) for c in features])


def tree_samples(
    rows: DataFrame, features: Sequence[str], id_columns: Sequence[str], trees: int, size: int, seed: int
) -> DataFrame:
    """Rows `(tree, x)`: for each tree `size` rows without replacement, or all if there are fewer.

    A tree first takes somewhat more than `size` rows by their draw, so that few are moved;
    the margin makes a shortfall improbable. Equal draws go by id.
    """
    margin = size + 8.0 * math.sqrt(size)
    n = rows.agg(F.count(F.lit(1)).cast("double")).scalar()
    limit = F.ceil(F.least(F.lit(1.0), F.try_divide(F.lit(margin), n)) * PRIME)
    family = rows.sparkSession.range(trees).select(
        F.col("id").alias("tree"),
        (number(seed, "a", F.col("id")) % (PRIME - 1) + 1).alias("a"),
        (number(seed, "b", F.col("id")) % PRIME).alias("b"),
    )
    family = family.agg(F.sort_array(F.collect_list(F.struct("tree", "a", "b")))).scalar()
    ids = [F.col(c).cast("string").alias(f"_id{i}") for i, c in enumerate(id_columns)]
    numbered = rows.select(*ids, _vector(features).alias("x"), family.alias("_family"), limit.alias("_limit"))
    numbered = numbered.withColumn("_number", number(seed, "row", *[F.col(f"_id{i}") for i in range(len(ids))]) % PRIME)
    draws = f"transform(_family, f -> struct(f.tree as tree, (f.a * _number + f.b) % {PRIME} as draw))"
    dealt = numbered.select("x", *[f"_id{i}" for i in range(len(ids))], F.expr(f"inline(filter({draws}, d -> d.draw < _limit))"))
    order = W.partitionBy("tree").orderBy("draw", *[f"_id{i}" for i in range(len(ids))], "x")
    ranked = dealt.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= size)
    return ranked.select("tree", "x")


def fit(
    rows: DataFrame,
    features: Sequence[str] = FEATURES,
    id_columns: Sequence[str] = ("day",),
    trees: int = TREES,
    size: int = SAMPLE_SIZE,
    seed: int = SEED,
) -> DataFrame:
    """The forest as a table of nodes, see `_NODES`. Nothing runs until it is used; each tree
    is grown from its `size` rows by one call, wherever these meet."""
    last = levels_of(size)

    def grow(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        tree = int(key[0])
        return pd.DataFrame(_grow(np.stack(part["x"]), tree, seed, last), columns=_NODES.replace(",", "").split()[::2])

    sample = tree_samples(rows, features, id_columns, trees, size, seed)
    return sample.groupBy("tree").applyInPandas(grow, _NODES)


# feature -1: a leaf, on the last level, of `size` rows after `depth` splits
_NODES = "tree bigint, node bigint, feature int, threshold double, depth int, size bigint"


def _grow(sample: np.ndarray, tree: int, seed: int, last: int) -> list[tuple]:
    """A node is split at a random place between the least and the greatest value of a random
    feature that varies in it, while it holds several rows and lies above the depth at which
    the sample would be halved to one."""

    def drawn(kind: str, node: int) -> int:
        return int(hashlib.md5(f"{seed}|{kind}|{tree}|{node}".encode()).hexdigest()[:13], 16)

    most = math.ceil(math.log2(max(len(sample), 2)))
    nodes: list[tuple] = []
    pending = [(sample, 1, 0, 0)]
    while pending:
        part, node, level, depth = pending.pop()
        if level == last:
            nodes.append((tree, node, -1, 0.0, depth, len(part)))
            continue
        low, high = part.min(axis=0), part.max(axis=0)
        varying = np.flatnonzero(high > low)
        if len(part) < 2 or level >= most or not len(varying):
            pending.append((part, 2 * node, level + 1, depth))
            continue
        feature = int(varying[drawn("feature", node) % len(varying)])
        lo, hi = float(low[feature]), float(high[feature])
        cut = lo + drawn("threshold", node) / float(1 << 52) * (hi - lo)
        # rounding may reach the greatest value, which would leave nothing on the right
        cut = lo if cut >= hi else cut
        nodes.append((tree, node, feature, cut, depth, len(part)))
        left = part[:, feature] <= cut
        pending += [(part[left], 2 * node, level + 1, depth + 1), (part[~left], 2 * node + 1, level + 1, depth + 1)]
    return nodes


def mean_path(size: Column | str) -> Column:
    """Mean path length of an unsuccessful search in a binary tree of `size` leaves."""
    n = (F.col(size) if isinstance(size, str) else size).cast("double")
    deep = F.lit(2.0) * (F.log(n - 1.0) + F.lit(EULER)) - F.lit(2.0) * (n - 1.0) / n
    return F.when(n > 2, deep).when(n == 2, F.lit(1.0)).otherwise(F.lit(0.0))


def _heaps(forest: DataFrame, size: int) -> DataFrame:
    """Per tree `feature` and `threshold` by node and `length` by place on the last level. A
    node without a split lets everything pass to the left."""
    width = 1 << levels_of(size)
    split = f"transform(sequence(1L, {width - 1}L), k -> try_element_at(_splits, k)"
    inner, length = F.col("feature") >= 0, (F.col("depth") + mean_path("size")) * LENGTH_UNIT
    mapped = forest.groupBy("tree").agg(
        F.map_from_entries(F.collect_list(F.when(inner, F.struct("node", F.struct("feature", "threshold"))))).alias("_splits"),
        F.map_from_entries(F.collect_list(F.when(~inner, F.struct("node", F.rint(length).cast("bigint"))))).alias("_leaves"),
    )
    return mapped.select(
        "tree",
        F.expr(f"{split}.feature)").alias("_features"),
        F.expr(f"{split}.threshold)").alias("_thresholds"),
        F.expr(f"transform(sequence({width}L, {2 * width - 1}L), k -> try_element_at(_leaves, k))").alias("length"),
    ).select(
        "tree",
        F.expr("transform(_features, f -> coalesce(f, 0))").alias("feature"),
        F.expr("transform(_thresholds, t -> coalesce(t, double('Infinity')))").alias("threshold"),
        "length",
    )


def score(
    rows: DataFrame, forest: DataFrame, features: Sequence[str] = FEATURES, trees: int = TREES, size: int = SAMPLE_SIZE
) -> DataFrame:
    """Adds `raw_score` in [-1, 0): the lower, the easier a row is to isolate. Ten decimals,
    so that it does not depend on how a machine computes powers. Nothing runs until used."""
    level = levels_of(size)
    heaps = _heaps(forest, size).agg(F.collect_list(F.struct("feature", "threshold", "length"))).scalar()
    steps = F.sequence(F.lit(1), F.lit(level))

    def length(x: Column, tree: Column) -> Column:
        def step(at: Column, _: Column) -> Column:
            here = F.get(x, F.get(tree["feature"], at - 1))
            return at * 2 + F.when(here <= F.get(tree["threshold"], at - 1), 0).otherwise(1)

        return F.get(tree["length"], F.reduce(steps, F.lit(1), step) - (1 << level))

    # a lambda's argument is computed once, a column inside it at every step
    total = F.transform(
        F.array(_vector(features)),
        lambda x: F.reduce("_forest", F.lit(0).cast("bigint"), lambda sum_, tree: sum_ + length(x, tree)),
    )[0]
    typical = rows.agg(mean_path(F.least(F.count(F.lit(1)), F.lit(size)))).scalar()
    mean = total / F.lit(float(LENGTH_UNIT)) / F.lit(float(trees))
    raw = -F.pow(F.lit(2.0), -F.try_divide(mean, typical))
    ready = rows.withColumn("_forest", heaps)
    return ready.withColumn("raw_score", round_even(raw, SCORE_DIGITS)).drop("_forest")


def flag(scored: DataFrame, contamination: float, by: Sequence[str]) -> DataFrame:
    """`iforest_score`, the raw score less its exact `contamination` quantile per series, and
    `is_anomaly_iforest` where it is negative. A series of fewer than ten rows gets 0 and no
    flags."""
    cut = exact_quantile(scored, "raw_score", contamination, by)
    joined = scored.join(cut.withColumnsRenamed({"n": "_n", "quantile": "_cut"}), list(by), "left")
    own = F.when(F.col("_n") >= MIN_ROWS, F.col("raw_score") - F.col("_cut")).otherwise(F.lit(0.0))
    return (
        joined.withColumn("iforest_score", own)
        .withColumn("is_anomaly_iforest", F.col("iforest_score") < 0)
        .drop("raw_score", "_n", "_cut")
    )


def isolation_forest(
    panel: DataFrame,
    contamination: float = CONTAMINATION,
    features: Sequence[str] = FEATURES,
    id_columns: Sequence[str] = ("day",),
    trees: int = TREES,
    size: int = SAMPLE_SIZE,
    seed: int = SEED,
) -> DataFrame:
    """Adds `iforest_score` (negative for outliers) and `is_anomaly_iforest`.

    The panel and its raw scores are stored once each, since fitting, scoring and the cut-off
    all read them; forest and cut-off are part of the plan and come to no driver code.
    """
    base = stored(panel.withColumn(_SERIES, F.lit(0)), "iforest-panel")
    forest = fit(base, features, id_columns, trees, size, seed)
    scored = stored(score(base, forest, features, trees, size), "iforest-scores")
    return flag(scored, contamination, [_SERIES]).drop(_SERIES)

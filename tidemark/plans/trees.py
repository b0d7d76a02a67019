"""Forests and penalised boosting on one binned table that all fits share.

A fit (``Fit``) names its features, target and the column that says which rows train it; all fits read
the same rows, whose features are cut into ``BINS`` bins once. A tree grows level by level: for each open node the
count and sum of the target in every bin of the features drawn for it, then the best cut of each node.

* A table of at most ``TABLE_BYTES`` is broadcast in bins, and tasks grow whole trees, each some of a forest.
* A larger one stays where it is: every task sends its rows' sums for each tree, these are added up by tree, and only
  cuts reach the driver. Trees are grown a few at a time, so that sums in flight are bounded.

Both give the same trees. Which rows and features a tree draws follows from the seed, the tree's number, the row's
key and the node alone, and targets are rounded to 22 bits of their range, so sums do not depend on the order of rows.
Trees nest: the first 200 of 500 are a forest of 200, and a tree cut off at depth 3 is the one grown to depth 3.

Leaves are those of second-order boosting with squared loss: -T(G) / (n + l2), T shrinking the sum G by l1. Without
penalties that is the mean, which is what forests use.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import asdict, dataclass
from math import log2

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import settle

BINS = 32
#: Bytes of the binned table up to which it is broadcast.
TABLE_BYTES = 64 << 20
#: Bytes of sums that one job adds up, where the table is not broadcast.
SUM_BYTES = 256 << 20
#: Trees of a forest that one task grows.
TREES_A_TASK = 25
#: Bits of the target's range that are kept.
BITS = 22
MODEL = "fit string, tree int, feature binary, cut binary, value binary, gain binary, start double"
_POISSON = np.cumsum(np.exp(-1.0) / np.cumprod([1.0, *range(1, 12)]))


@dataclass(frozen=True)
class Fit:
    """``step`` None: a forest, else boosting. ``rows`` None: as many rows as there are, drawn with replacement, else this share of them."""

    name: str
    features: tuple[str, ...]
    target: str
    role: str
    trees: int = 400
    depth: int = 6
    min_rows: int = 30
    share: float = 1.0
    by_node: bool = True
    rows: float | None = None
    step: float | None = None
    l1: float = 0.0
    l2: float = 0.0
    seed: int = 42

    @property
    def drawn(self) -> int:
        return max(1, int(self.share * len(self.features) + 1e-9))


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _key(*parts: int) -> np.uint64:
    out = np.zeros(1, np.uint64)
    for part in parts:
        out = _mix(out + np.uint64(0x9E3779B97F4A7C15) + np.uint64(part))
    return out[0]


def _weights(fit: Fit, tree: int, rows: np.ndarray) -> np.ndarray:
    """How often each row is drawn."""
    part = (_mix(rows ^ _key(fit.seed, tree, 1)) >> np.uint64(11)).astype(np.float64) / float(1 << 53)
    return np.searchsorted(_POISSON, part, side="right").astype(np.float64) if fit.rows is None else (part < fit.rows).astype(np.float64)


def _features(fit: Fit, tree: int, nodes: np.ndarray) -> np.ndarray:
    """Numbers of the features drawn for each node."""
    of = nodes if fit.by_node else np.zeros_like(nodes)
    mixed = _mix(_mix(of.astype(np.uint64)[:, None] + _key(fit.seed, tree, 2)) + np.arange(len(fit.features), dtype=np.uint64))
    return np.sort(np.argsort(mixed, axis=1, kind="stable")[:, : fit.drawn], axis=1)


class Tree:
    """Nodes in heap order: the children of i are 2 i + 1 and 2 i + 2; a leaf has feature -1."""

    def __init__(self, depth: int):
        n = (2 << depth) - 1
        self.feature, self.bin = np.full(n, -1, np.int16), np.zeros(n, np.uint8)
        self.value, self.gain = np.zeros(n), np.zeros(n)
        self.open = np.zeros(n, bool)
        self.open[0] = True

    def places(self, x: np.ndarray, depth: int) -> np.ndarray:
        """The node of each row of bins after at most ``depth`` steps."""
        at, own = np.zeros(len(x), np.int64), np.arange(len(x))
        for _ in range(depth):
            feature = self.feature[at]
            right = x[own, np.maximum(feature, 0)] > self.bin[at]
            at = np.where(feature < 0, at, 2 * at + 1 + right)
        return at

    def level(self, depth: int) -> np.ndarray:
        nodes = np.arange((1 << depth) - 1, (2 << depth) - 1)
        return nodes[self.open[nodes]]

    def grow(self, fit: Fit, nodes: np.ndarray, drawn: np.ndarray, sums: np.ndarray, last: bool) -> None:
        """Cut ``nodes`` where that gains most. ``sums``: (node, feature, bin, count and sum of the target)."""
        total = sums[:, 0].sum(axis=1)
        if nodes[0] == 0:
            self.value[0] = leaf(fit, total[:, 1], total[:, 0])[0]
        left = np.cumsum(sums, axis=2)[:, :, :-1]
        n_left, s_left = left[..., 0], left[..., 1]
        n_right, s_right = total[:, 0][:, None, None] - n_left, total[:, 1][:, None, None] - s_left
        gain = _score(fit, s_left, n_left) + _score(fit, s_right, n_right) - _score(fit, total[:, 1], total[:, 0])[:, None, None]
        gain[(n_left < fit.min_rows) | (n_right < fit.min_rows)] = -np.inf
        flat = gain.reshape(len(nodes), -1)
        best = flat.argmax(axis=1)
        for k in np.flatnonzero(flat[np.arange(len(nodes)), best] > 1e-12).tolist():
            node, (feature, cut) = int(nodes[k]), divmod(int(best[k]), left.shape[2])
            self.feature[node], self.bin[node], self.gain[node] = drawn[k, feature], cut, flat[k, best[k]]
            for child, s, n in ((2 * node + 1, s_left, n_left), (2 * node + 2, s_right, n_right)):
                self.value[child] = leaf(fit, s[k, feature, cut], n[k, feature, cut])
                self.open[child] = not last and n[k, feature, cut] >= 2 * fit.min_rows


def _shrunk(fit: Fit, s):
    return np.sign(s) * np.maximum(np.abs(s) - fit.l1, 0.0) if fit.l1 else s


def _score(fit: Fit, s, n):
    return _shrunk(fit, s) ** 2 / np.maximum(n + fit.l2, 1e-9)


def leaf(fit: Fit, s, n):
    return _shrunk(fit, s) / np.maximum(n + fit.l2, 1e-9) * (1.0 if fit.step is None else fit.step)


def _sums(x: np.ndarray, y: np.ndarray, w: np.ndarray, at: np.ndarray, nodes: np.ndarray, drawn: np.ndarray) -> np.ndarray:
    """(node, drawn feature, bin, count and sum of y) of the rows that are in one of ``nodes``."""
    k, width = drawn.shape[1], x.shape[1]
    number = np.full(int(nodes[-1]) + 1, -1, np.int64)
    number[nodes] = np.arange(len(nodes))
    own = np.flatnonzero((w > 0) & (at <= nodes[-1]) & (at >= nodes[0]))
    own = own[number[at[own]] >= 0]
    of = number[at[own]]
    bins = np.take(x.ravel(), (own * width)[:, None] + drawn[of])
    cell = ((of * k * BINS)[:, None] + np.arange(k) * BINS + bins).ravel()
    size = len(nodes) * k * BINS
    weight = np.repeat(w[own], k)
    counted, summed = np.bincount(cell, weight, size), np.bincount(cell, weight * np.repeat(y[own], k), size)
    return np.stack([counted, summed], axis=-1).reshape(len(nodes), k, BINS, 2)


class Rows:
    """Rows in bins: ``x`` (row, column), ``y`` by target, ``train`` by role, ``key`` of each row."""

    def __init__(self, columns: Sequence[str], x: np.ndarray, y: Mapping[str, np.ndarray], train: Mapping[str, np.ndarray], key: np.ndarray):
        self.columns, self.x, self.y, self.train, self.key = list(columns), x, y, train, key

    def of(self, fit: Fit) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(bins, target, key) of the rows that train a fit."""
        own = np.flatnonzero(self.train[fit.role])
        columns = [self.columns.index(f) for f in fit.features]
        return np.ascontiguousarray(self.x[own][:, columns]), self.y[fit.target][own], self.key[own]


def _rounded(y: np.ndarray, unit: float) -> np.ndarray:
    return np.rint(y / unit) * unit


def _slope(fit: Fit, y: np.ndarray, margin: np.ndarray, unit: float) -> np.ndarray:
    """What a tree is fitted to: the target, or what boosting has left of it."""
    return y if fit.step is None else _rounded(y - margin, unit)


def _whole_trees(fit: Fit, rows: Rows, first: int, behind: int, start: float, unit: float) -> Iterator[tuple[int, Tree]]:
    """Trees of these numbers, all rows at hand."""
    x, y, key = rows.of(fit)
    margin = np.full(len(y), start)
    for number in range(first, behind):
        tree, w = Tree(fit.depth), _weights(fit, number, key)
        own = np.flatnonzero(w) if fit.rows is None else np.arange(len(y))
        xs, ys, ws, at = x[own], _slope(fit, y, margin, unit)[own], w[own], np.zeros(len(own), np.int64)
        for depth in range(fit.depth):
            nodes = tree.level(depth)
            if not len(nodes):
                break
            drawn = _features(fit, number, nodes)
            tree.grow(fit, nodes, drawn, _sums(xs, ys, ws, at, nodes, drawn), depth + 1 == fit.depth)
            feature = tree.feature[at]
            right = xs[np.arange(len(own)), np.maximum(feature, 0)] > tree.bin[at]
            at = np.where((feature < 0) | (at < nodes[0]), at, 2 * at + 1 + right)
        if fit.step is not None:
            margin += tree.value[at]
        yield number, tree


def _stored(fit: Fit, number: int, tree: Tree, edges: Mapping[str, np.ndarray], start: float) -> tuple:
    """A row of the model: cuts as values of the feature, so that it can be used without the bins."""
    cut = np.zeros(len(tree.feature))
    for node in np.flatnonzero(tree.feature >= 0).tolist():
        cut[node] = edges[fit.features[tree.feature[node]]][tree.bin[node]]
    return fit.name, number, tree.feature.tobytes(), cut.tobytes(), tree.value.tobytes(), tree.gain.tobytes(), start


def bin_edges(df: DataFrame, columns: Sequence[str], bins: int = BINS) -> dict[str, np.ndarray]:
    """Values at which each column is cut: at most ``bins`` - 1, by quantiles (exact up to 10,000 different values)."""
    shares = F.array(*[F.lit(k / bins) for k in range(1, bins)])
    found = df.agg(*[F.percentile_approx(F.col(f"`{c}`").cast("double"), shares, 10_000).alias(c) for c in columns]).first()
    return {c: np.unique(np.array(found[c] or [0.0])) for c in columns}


def _binned(df: DataFrame, edges: Mapping[str, np.ndarray], targets: Sequence[str], roles: Sequence[str], key: Sequence[str]) -> DataFrame:
    """(x, y, train, key) of whole batches of rows as bytes."""
    columns = list(edges)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                value = lambda c: np.nan_to_num(batch.column(c).to_numpy(zero_copy_only=False).astype(np.float64))
                x = np.stack([np.searchsorted(edges[c], value(c), side="left") for c in columns], axis=1).astype(np.uint8)
                y = np.stack([value(t) for t in targets], axis=1)
                train = np.stack([batch.column(r).to_numpy(zero_copy_only=False) == "train" for r in roles], axis=1)
                blobs = [x.tobytes(), y.tobytes(), train.tobytes(), batch.column("key_").to_numpy().tobytes()]
                yield pa.RecordBatch.from_arrays([pa.array([b], pa.binary()) for b in blobs], names=["x", "y", "train", "key"])

    wanted = df.select(*[F.col(f"`{c}`").cast("double") for c in [*columns, *targets]], *roles, F.xxhash64(*key).alias("key_"))
    return wanted.mapInArrow(run, "x binary, y binary, train binary, key binary")


def _rows_of(columns: Sequence[str], targets: Sequence[str], roles: Sequence[str], units: Mapping[str, float], blobs: Sequence) -> Rows:
    """Rows of (x, y, train, key) as bytes."""
    x, y, train, key = (b"".join(b[k] for b in blobs) for k in range(4))
    y, train = np.frombuffer(y, np.float64).reshape(-1, len(targets)), np.frombuffer(train, bool).reshape(-1, len(roles))
    by_target = {t: _rounded(y[:, k], units[t]) for k, t in enumerate(targets)}
    x = np.frombuffer(x, np.uint8).reshape(-1, len(columns))
    return Rows(columns, x, by_target, {r: train[:, k] for k, r in enumerate(roles)}, np.frombuffer(key, np.int64).view(np.uint64))


def _means(training: DataFrame, fits: Sequence[Fit], units: Mapping[str, float]) -> list[float]:
    """Where boosting begins: the mean of the rounded target, from sums of whole numbers."""
    whole = lambda f: F.when(F.col(f.role) == "train", F.rint(F.col(f.target) / units[f.target]).cast("long"))
    sums = [x for k, f in enumerate(fits) for x in (F.sum(whole(f)).alias(f"s{k}"), F.count(whole(f)).alias(f"n{k}"))]
    row = training.agg(*sums).first()
    return [0.0 if f.step is None or not row[f"n{k}"] else row[f"s{k}"] / row[f"n{k}"] * units[f.target] for k, f in enumerate(fits)]


def fit_trees(df: DataFrame, fits: Sequence[Fit], key: Sequence[str], table_bytes: int = TABLE_BYTES) -> DataFrame:
    """The trees of all fits (``MODEL``), written to the shared folder.

    ``df`` should be settled; rows of a fit are those whose ``role`` is "train", with neither features nor target missing.
    ``key`` identifies a row. A fit without rows has trees of one leaf with the value 0.
    """
    spark = df.sparkSession
    columns = sorted({f for fit in fits for f in fit.features})
    targets, roles = sorted({f.target for f in fits}), sorted({f.role for f in fits})
    training = df.where(" or ".join(f"`{r}` = 'train'" for r in roles))
    edges = bin_edges(training, columns)
    span = training.agg(F.count(F.lit(1)).alias("n"), *[F.max(F.abs(F.col(t))).alias(t) for t in targets]).first()
    units = {t: 2.0 ** (int(log2(span[t] or 1.0)) + 1 - BITS) for t in targets}
    start = _means(training, fits, units)
    table = settle(_binned(training, edges, targets, roles, key), "binned")
    if span["n"] * (len(columns) + 9 * len(targets) + len(roles) + 8) > table_bytes:
        return _spread(table, fits, columns, targets, roles, units, edges, start)
    shared = spark.sparkContext.broadcast(_rows_of(columns, targets, roles, units, table.collect()))  # at most ``table_bytes``
    given = spark.sparkContext.broadcast((list(fits), edges, start, units))
    jobs = [
        (k, first, min(first + (TREES_A_TASK if f.step is None else f.trees), f.trees))
        for k, f in enumerate(fits) for first in range(0, f.trees, TREES_A_TASK if f.step is None else f.trees)
    ]
    jobs.sort(key=lambda j: j[1] - j[2])  # boosting, which takes longest, begins first

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fits, edges, start, units = given.value
        for batch in batches:
            for k, first, behind in zip(*(batch.column(c).to_pylist() for c in range(3))):
                fit = fits[k]
                made = _whole_trees(fit, shared.value, first, behind, start[k], units[fit.target])
                rows = [_stored(fit, number, tree, edges, start[k]) for number, tree in made]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=[f.split()[0] for f in MODEL.split(", ")]).cast(_MODEL)

    tasks = spark.createDataFrame(spark.sparkContext.parallelize(jobs, max(1, len(jobs))), "fit int, first int, behind int")
    return settle(tasks.mapInArrow(run, MODEL), "trees")


_MODEL = pa.schema([
    ("fit", pa.string()), ("tree", pa.int32()), ("feature", pa.binary()), ("cut", pa.binary()), ("value", pa.binary()), ("gain", pa.binary()),
    ("start", pa.float64()),
])


def _spread(
    table: DataFrame, fits: Sequence[Fit], columns: Sequence[str], targets: Sequence[str], roles: Sequence[str], units: Mapping[str, float],
    edges: Mapping[str, np.ndarray], start: Sequence[float],
) -> DataFrame:
    """The same trees from a table that stays spread: one job for each level of some trees, whose sums are added up by tree."""
    spark = table.sparkSession

    def level(depth: int, trees: dict[tuple[int, int], Tree], before: dict[int, list[Tree]]) -> None:
        shared = spark.sparkContext.broadcast((list(fits), trees, before))

        def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            fits, trees, before = shared.value
            blobs = [tuple(row.values()) for batch in batches for row in batch.to_pylist()]
            if not blobs:
                return
            rows, margins = _rows_of(columns, targets, roles, units, blobs), {}
            for (k, number), tree in trees.items():
                fit, nodes = fits[k], tree.level(depth)
                x, y, key = rows.of(fit)
                if k not in margins:
                    margins[k] = sum((t.value[t.places(x, fit.depth)] for t in before[k]), np.full(len(y), start[k]))
                w, at = _weights(fit, number, key), tree.places(x, depth)
                sums = _sums(x, _slope(fit, y, margins[k], units[fit.target]), w, at, nodes, _features(fit, number, nodes))
                yield pa.RecordBatch.from_arrays([pa.array([k]), pa.array([number]), pa.array([sums.tobytes()], pa.binary())], names=["fit", "tree", "sums"])

        def added(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = 0.0
            for batch in batches:
                for blob in batch.column("sums"):
                    total = total + np.frombuffer(blob.as_buffer(), np.float64)
            yield pa.RecordBatch.from_arrays([*(pa.array([k.as_py()]) for k in key), pa.array([total.tobytes()], pa.binary())], names=["fit", "tree", "sums"])

        sums = table.mapInArrow(summed, "fit long, tree long, sums binary").groupBy("fit", "tree").applyInArrow(added, "fit long, tree long, sums binary")
        for row in sums.collect():  # at most ``SUM_BYTES``
            fit, tree = fits[row.fit], trees[row.fit, row.tree]
            nodes = tree.level(depth)
            drawn = _features(fit, row.tree, nodes)
            tree.grow(fit, nodes, drawn, np.frombuffer(bytes(row.sums), np.float64).reshape(len(nodes), drawn.shape[1], BINS, 2), depth + 1 == fit.depth)

    def grown(trees: dict[tuple[int, int], Tree], before: dict[int, list[Tree]]) -> None:
        for depth in range(max(f.depth for f in fits)):
            left = {k: t for k, t in trees.items() if depth < fits[k[0]].depth and len(t.level(depth))}
            while left:
                now, size = {}, 0
                while left and (not now or size < SUM_BYTES):
                    k, tree = left.popitem()
                    now[k] = tree
                    size += len(tree.level(depth)) * fits[k[0]].drawn * BINS * 16
                level(depth, now, {k: before.get(k, []) for k, _ in now})

    done: list[tuple] = []
    forests = {(k, n): Tree(f.depth) for k, f in enumerate(fits) if f.step is None for n in range(f.trees)}
    if forests:
        grown(forests, {})
    done += [_stored(fits[k], n, tree, edges, start[k]) for (k, n), tree in forests.items()]
    boosted: dict[int, list[Tree]] = {k: [] for k, f in enumerate(fits) if f.step is not None}
    for number in range(max((fits[k].trees for k in boosted), default=0)):
        trees = {(k, number): Tree(fits[k].depth) for k in boosted if number < fits[k].trees}
        grown(trees, boosted)
        for (k, _), tree in trees.items():
            boosted[k].append(tree)
            done.append(_stored(fits[k], number, tree, edges, start[k]))
    return settle(spark.createDataFrame(done, MODEL), "trees")


class Scorer:
    """Trees of one fit, ready for rows of values."""

    def __init__(self, rows: Sequence):
        rows = sorted(rows, key=lambda r: r.tree)
        read = lambda name, kind: np.array([np.frombuffer(bytes(r[name]), kind) for r in rows])
        self.feature, self.cut, self.value, self.gain = read("feature", np.int16), read("cut", float), read("value", float), read("gain", float)
        self.start = rows[0].start

    def nodes(self, x: np.ndarray, tree: int) -> Iterator[np.ndarray]:
        """The node of each row at the root, after one step, and so on to the leaves."""
        feature, cut, at, own = self.feature[tree], self.cut[tree], np.zeros(len(x), np.int64), np.arange(len(x))
        yield at
        for _ in range(len(feature).bit_length() - 1):
            f = feature[at]
            at = np.where(f < 0, at, 2 * at + 1 + (x[own, np.maximum(f, 0)] > cut[at]))
            yield at

    def each(self, x: np.ndarray, tree: int) -> np.ndarray:
        """The tree's value for each row."""
        *_, leaves = self.nodes(x, tree)
        return self.value[tree][leaves]

    def predict(self, x: np.ndarray, boosted: bool) -> np.ndarray:
        total = sum((self.each(x, t) for t in range(len(self.feature))), np.zeros(len(x)))
        return self.start + total if boosted else total / len(self.feature)


def scorers(model: DataFrame, fits: Sequence[Fit]) -> dict[str, Scorer]:
    """The trees of these fits: as many rows as they have trees."""
    found: dict[str, list] = {}
    for row in model.where(F.col("fit").isin([f.name for f in fits])).collect():
        found.setdefault(row.fit, []).append(row)
    return {name: Scorer(rows) for name, rows in found.items()}


def predict(df: DataFrame, fits: Sequence[Fit], model: DataFrame, keep: Sequence[str]) -> DataFrame:
    """(fit, split, y_true, y_pred, *keep): a row for each fit and row of ``df`` whose ``role`` for it is not NULL."""
    spark = df.sparkSession
    shared = spark.sparkContext.broadcast((list(fits), scorers(model, fits)))
    columns = list(dict.fromkeys([*keep, *(f.role for f in fits), *(f.target for f in fits), *(c for f in fits for c in f.features)]))
    kinds = dict(df.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fits, made = shared.value
        for batch in batches:
            value = {c: batch.column(c).to_numpy(zero_copy_only=False).astype(np.float64) for f in fits for c in f.features} if batch.num_rows else {}
            for fit in fits if batch.num_rows else ():
                own = batch.filter(batch.column(fit.role).is_valid())
                here = batch.column(fit.role).is_valid().to_numpy(zero_copy_only=False)
                x = np.stack([value[c][here] for c in fit.features], axis=1)
                y = made[fit.name].predict(x, fit.step is not None)
                arrays = [pa.array([fit.name] * len(x), pa.string()), own.column(fit.role), own.column(fit.target), pa.array(y), *(own.column(c) for c in keep)]
                yield pa.RecordBatch.from_arrays(arrays, names=["fit", "split", "y_true", "y_pred", *keep])

    wanted = df.select(*[F.col(f"`{c}`").cast("double").alias(c) if any(c in (f.target, *f.features) for f in fits) else F.col(f"`{c}`") for c in columns])
    out = ", ".join(f"`{c}` {kinds[c]}" for c in keep)
    return wanted.mapInArrow(run, f"fit string, split string, y_true double, y_pred double, {out}")


def staged_r2(
    df: DataFrame, fits: Sequence[Fit], model: DataFrame, counts: Sequence[int], depths: Sequence[int], splits: Sequence[str] = ("train", "test")
) -> dict[tuple, float | None]:
    """R² by (fit, split, trees, depth): forests of the first trees, cut off at these depths. Sums leave the tasks, no predictions."""
    shared = df.sparkSession.sparkContext.broadcast((list(fits), scorers(model, fits)))
    columns = list(dict.fromkeys([*(f.role for f in fits), *(f.target for f in fits), *(c for f in fits for c in f.features)]))
    names = ["fit", "split", "trees", "depth", "n", "s", "ss", "err"]

    def scored(fit: Fit, made: Scorer, split: str, rows: pa.RecordBatch) -> pa.RecordBatch:
        x = np.stack([rows.column(c).to_numpy(zero_copy_only=False).astype(np.float64) for c in fit.features], axis=1)
        y, out = rows.column(fit.target).to_numpy(zero_copy_only=False).astype(np.float64), []
        total = {d: np.zeros(len(y)) for d in depths}
        for tree in range(max(counts)):
            for depth, at in enumerate(made.nodes(x, tree)):
                if depth in total:
                    total[depth] += made.value[tree][at]
            if tree + 1 in counts:
                for depth in depths:
                    error = float(((total[depth] / (tree + 1) - y) ** 2).sum())
                    out.append((fit.name, split, tree + 1, depth, len(y), float(y.sum()), float((y * y).sum()), error))
        return pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fits, made = shared.value
        for batch in batches:
            for fit in fits:
                for split in splits:
                    rows = batch.filter(pc.fill_null(pc.equal(batch.column(fit.role), split), False))
                    if rows.num_rows:
                        yield scored(fit, made[fit.name], split, rows)

    sums = df.select(*[f"`{c}`" for c in columns]).mapInArrow(run, "fit string, split string, trees long, depth long, n long, s double, ss double, err double")
    added = sums.groupBy(*names[:4]).agg(*[F.sum(c).alias(c) for c in names[4:]])
    out = {}
    for r in added.collect():  # a row for each fit, split, number of trees and depth
        spread = r.ss - r.s * r.s / r.n
        out[r.fit, r.split, r.trees, r.depth] = 1 - r.err / spread if spread > 0 else None
    return out


def importances(fit: Fit, model: DataFrame) -> dict[str, float]:
    """Share of each feature in the gains of all cuts, every tree weighing the same."""
    made = scorers(model, [fit]).get(fit.name)
    total = np.zeros(len(fit.features))
    for feature, gain in zip(made.feature, made.gain) if made else ():
        if gain.sum() > 0:
            np.add.at(total, feature[feature >= 0], gain[feature >= 0] / gain.sum())
    return dict(zip(fit.features, (total / total.sum() if total.sum() > 0 else total).tolist()))


def store(fits: Sequence[Fit], model: DataFrame, path: str) -> None:
    """Write fitted trees with what they were fitted to, features and their order included."""
    model.write.parquet(f"{path}/trees")
    model.sparkSession.createDataFrame([(json.dumps(asdict(f)),) for f in fits], "fit string").write.json(f"{path}/fits")


def load(spark: SparkSession, path: str) -> tuple[list[Fit], DataFrame]:
    """What ``store`` has written."""
    found = [json.loads(r.fit) for r in spark.read.schema("fit string").json(f"{path}/fits").collect()]
    return [Fit(**{**f, "features": tuple(f["features"])}) for f in found], spark.read.parquet(f"{path}/trees")

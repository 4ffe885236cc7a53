"""Approximate nearest neighbours by cosine, from a forest of random-projection trees.

The forest is fitted on a bounded sample: each node splits its part at the
median of a random projection. Every vector then goes to one leaf per tree. A
query walks all trees through one priority queue: the branch it missed by the
smallest margin is opened next, whichever tree it is in, until the leaves hold
enough of the sample. The margin it ends with is the query's bound.

Where the table is larger than the sample, a leaf's own rows grow its tree on
in the task that holds them. There a query opens every branch that it missed by
no more than its bound, which is what the queue would have opened next, so no
task needs to know another's trees. All vectors of opened leaves are ranked.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tillsight.workspace import cut_lineage

TREES = 16
LEAF_ROWS = 128
#: Numbers in the sample that the forest is fitted on, at most: 65,536 vectors of 64.
SAMPLE_VALUES = 1 << 22
#: Rows of the sample that a query's leaves hold at least before it stops opening more.
LEAST_CANDIDATES = 3_000
#: How many more it collects is measured: the share of the sample after which
#: this part of the true neighbours of some sample vectors has turned up.
TARGET_RECALL = 0.97
PROBES = 128
#: Levels of the sample's trees that tell what further levels take.
LEVELS = 3
#: Rows of one group of leaves, about, and queries that are held against it at a time.
GROUP_ROWS = 20_000
GROUP_QUERIES = 20_000
#: Queries of one task that opens leaves.
SEARCH_ROWS = 4_096
#: Cosines that a task has at once, and answers it gathers before it keeps the best.
RANKED_AT_ONCE = 1 << 22
KEPT_AT_ONCE = 1 << 20


def matrix(column: pa.Array, width: int | None = None) -> np.ndarray:
    """Vectors as rows; shorter ones end in zeros, and components beyond ``width`` are left out.

    Each is scaled by a power of two to a largest component of about one. That
    changes no cosine and no digit of one, and keeps squares in range.
    """
    lengths = pc.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    size = int(lengths.max(initial=0)) if width is None else width
    if len(lengths) and (lengths == size).all():
        return _scaled(values.reshape(len(lengths), size))
    rows = np.zeros((len(lengths), size))
    at = np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    row = np.repeat(np.arange(len(lengths)), lengths)
    fits = at < size
    rows[row[fits], at[fits]] = values[fits]
    return _scaled(rows)


def _scaled(rows: np.ndarray) -> np.ndarray:
    largest = np.abs(rows).max(axis=1, initial=0, keepdims=True)
    return np.ldexp(rows, -np.frexp(largest)[1])


def cosines(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Row by row; the same two vectors always give the same number."""
    dots = (left * right).sum(axis=1)
    return dots / (np.sqrt((left * left).sum(axis=1)) * np.sqrt((right * right).sum(axis=1)))


class Tree:
    """Nodes in arrays; ``below`` has the two children, or -1 - leaf number."""

    def __init__(self, directions, cuts, below, leaves):
        self.directions, self.cuts, self.below, self.leaves = directions, cuts, below, leaves

    @classmethod
    def fit(cls, rows: np.ndarray, leaf_rows: int, random: np.random.Generator) -> Tree:
        directions, cuts, below, leaves = [], [], [], []

        def grow(members: np.ndarray) -> int:
            if len(members) > leaf_rows:
                direction = random.standard_normal(rows.shape[1]).astype(np.float32)
                shadow = rows[members] @ direction
                cut = float(np.median(shadow))
                left = shadow < cut
                if left.any():
                    node = len(cuts)
                    directions.append(direction)
                    cuts.append(cut)
                    below.append([0, 0])
                    below[node] = [grow(members[left]), grow(members[~left])]
                    return node
            leaves.append(len(members))
            return -len(leaves)

        root = grow(np.arange(len(rows)))
        width = rows.shape[1]
        return cls(
            np.array(directions, np.float32).reshape(-1, width), np.array(cuts),
            np.array(below, np.int32).reshape(-1, 2), np.array(leaves),
        ) if root == 0 else cls(np.zeros((0, width), np.float32), np.zeros(0), np.zeros((0, 2), np.int32), np.array(leaves))

    def leaf_of(self, rows: np.ndarray) -> np.ndarray:
        at = np.full(len(rows), 0 if len(self.cuts) else -1)
        while (inner := np.flatnonzero(at >= 0)).size:
            nodes = at[inner]
            right = np.einsum("ij,ij->i", rows[inner], self.directions[nodes]) >= self.cuts[nodes]
            at[inner] = self.below[nodes, right.astype(int)]
        return -1 - at

    def misses(self, query: np.ndarray, row: np.ndarray, levels: int) -> np.ndarray:
        """The margin that the query misses the row's leaf by, and with 1, 2, ... of its lowest levels left out."""
        path, node = [0.0] * levels, 0 if len(self.cuts) else -1
        while node >= 0:
            margin = float(query @ self.directions[node] - self.cuts[node])
            right = bool(row @ self.directions[node] >= self.cuts[node])
            path.append(path[-1] if (margin >= 0) == right else max(path[-1], abs(margin)))
            node = int(self.below[node, int(right)])
        return np.array(path[: -levels - 1 : -1])

    def within(self, rows: np.ndarray, missed: np.ndarray, bounds: np.ndarray):
        """(leaf, rows that open it): all that a row misses by its bound or less, and its own."""
        margins = rows @ self.directions.T - self.cuts
        open_nodes = [(0 if len(self.cuts) else -1, np.arange(len(rows)), missed)]
        while open_nodes:
            node, asked, missed = open_nodes.pop()
            if node < 0:
                yield -1 - node, asked
                continue
            margin = margins[asked, node]
            further = np.maximum(missed, np.abs(margin))
            for side, here in zip(self.below[node].tolist(), (margin < 0, margin >= 0)):
                enters = here | (further <= bounds[asked])
                if enters.any():
                    open_nodes.append((side, asked[enters], np.where(here, missed, further)[enters]))


class Forest:
    def __init__(self, trees: list[Tree], width: int):
        self.trees, self.width = trees, width
        #: Leaves are numbered through all trees; this is each tree's first.
        self.first_leaf = np.cumsum([0, *(len(tree.leaves) for tree in trees)])

    @classmethod
    def fit(cls, rows: np.ndarray, trees: int, leaf_rows: int, seed: int = 5) -> Forest:
        random = np.random.default_rng(seed)
        return cls([Tree.fit(_unit(rows), leaf_rows, random) for _ in range(trees)], rows.shape[1])

    def leaves(self, rows: np.ndarray) -> np.ndarray:
        """The leaf of each row in each tree."""
        unit = _unit(rows)
        return np.stack([tree.leaf_of(unit) for tree in self.trees], axis=1)

    def search(
        self, rows: np.ndarray, candidates: float, wider: float = 0.0
    ) -> list[tuple[list[tuple[int, int, float]], float]]:
        """The (tree, leaf, margin it was missed by) that each row opens, nearest branches of all trees first.

        And the row's bound: ``wider`` than the margin at which it had ``candidates``.
        """
        unit = _unit(rows)
        margins = [unit @ tree.directions.T - tree.cuts for tree in self.trees]
        return [self._open([m[i] for m in margins], candidates, wider) for i in range(len(rows))]

    def _open(self, margins: list[np.ndarray], candidates: float, wider: float):
        """Leaves are opened until they hold ``candidates`` rows of the sample, those in several trees counted again."""
        queue = [(0.0, t, 0 if len(tree.cuts) else -1) for t, tree in enumerate(self.trees)]
        opened, found, bound = [], 0.0, math.inf
        while queue and queue[0][0] <= bound:
            missed, t, node = heapq.heappop(queue)
            tree, margin = self.trees[t], margins[t]
            while node >= 0:
                side = margin[node]
                near, far = tree.below[node][::-1] if side >= 0 else tree.below[node]
                heapq.heappush(queue, (max(missed, abs(float(side))), t, int(far)))
                node = int(near)
            opened.append((t, -1 - node, missed))
            found += tree.leaves[-1 - node]
            if found >= candidates and bound == math.inf:
                bound = missed + wider
        return opened, bound

    def needed(self, sample: np.ndarray, k: int) -> int:
        """Rows of the sample to open to find most true neighbours of some of them.

        Rows in leaves of several trees count again, so this can be up to the
        number of trees times the sample, which is all of it.
        """
        if len(sample) <= k:
            return len(sample) * len(self.trees)
        probes, truth = _true_neighbours(sample, k)
        leaves = self.leaves(sample)
        reached = []
        for (opened, _), wanted in zip(self.search(sample[probes], np.inf), truth):
            sizes = np.cumsum([self.trees[t].leaves[leaf] for t, leaf, _ in opened])
            at = {(t, leaf): size for (t, leaf, _), size in zip(opened, sizes)}
            for row in wanted:
                reached.append(min(at[t, leaf] for t, leaf in enumerate(leaves[row].tolist())))
        return int(np.quantile(reached, TARGET_RECALL, method="higher"))

    def widening(self, sample: np.ndarray, k: int) -> float:
        """How much more margin each further level of the trees takes to find as many.

        Measured on the lowest levels of the sample's trees: the one that takes
        most. Neighbours get nearer as the table grows, so further levels take
        hardly more.
        """
        if len(sample) <= k:
            return 0.0
        probes, truth = _true_neighbours(sample, k)
        unit = _unit(sample)
        # the margin that reaches a neighbour in the best tree, with 0, 1, ... of the lowest levels left out
        taken = np.array([
            np.min([tree.misses(unit[probe], unit[row], LEVELS + 1) for tree in self.trees], axis=0)
            for probe, wanted in zip(probes, truth) for row in wanted
        ])
        most = np.quantile(taken, TARGET_RECALL, axis=0, method="higher")
        return float(max(0.0, (most[:-1] - most[1:]).max()))


def _true_neighbours(sample: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Some rows of the sample, and the ``k`` nearest of each."""
    unit = _unit(sample)
    probes = np.arange(0, len(sample), max(1, len(sample) // PROBES))
    near = unit[probes] @ unit.T
    near[np.arange(len(probes)), probes] = -np.inf
    return probes, np.argpartition(-near, k - 1, axis=1)[:, :k]


def _unit(rows: np.ndarray) -> np.ndarray:
    return (rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))).astype(np.float32)


class Layout:
    """Which cells a leaf's rows and its queries go to.

    Leaves that are side by side share a group until it is full; a leaf of more
    rows (as near copies make, or a table far beyond the sample) has a group for
    each part of them. A group with many queries has a cell for each chunk of
    the queries, and its rows are in each. So no cell grows with the table.
    """

    def __init__(self, rows: np.ndarray, queries: np.ndarray):
        self.parts = np.maximum(1, -(-rows // GROUP_ROWS))
        self.chunks = np.ones_like(self.parts)
        self.first = np.zeros_like(self.parts)
        cells, leaf = 0, 0
        while leaf < len(rows):
            end, held = leaf + 1, rows[leaf]
            while end < len(rows) and held + rows[end] <= GROUP_ROWS:
                held += rows[end]
                end += 1
            chunks = max(1, -(-int(queries[leaf:end].sum()) // GROUP_QUERIES))
            self.first[leaf:end], self.chunks[leaf:end] = cells, chunks
            cells += int(self.parts[leaf]) * chunks
            leaf = end
        self.cells = cells

    def of_rows(self, leaves: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number of the row, cell), a row once for each chunk."""
        part = _dealt(ids) % self.parts[leaves]
        return _counted_on(self.first[leaves] + part * self.chunks[leaves], self.chunks[leaves], 1)

    def of_queries(self, leaves: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number of the query, cell), a query once for each part."""
        chunk = _dealt(keys) % self.chunks[leaves]
        return _counted_on(self.first[leaves] + chunk, self.parts[leaves], self.chunks[leaves])


def _dealt(numbers: np.ndarray) -> np.ndarray:
    """Numbers that are spread whatever the ids are."""
    mixed = numbers.astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (mixed >> np.uint64(33)).astype(np.int64)


def _counted_on(first: np.ndarray, times: np.ndarray, step) -> tuple[np.ndarray, np.ndarray]:
    """(place, first + n * step) for n from 0 to ``times`` - 1 of each place."""
    again = np.repeat(np.arange(len(first)), times)
    nth = np.arange(len(again)) - np.repeat(np.cumsum(times) - times, times)
    return again, first[again] + nth * (step if np.isscalar(step) else step[again])


def _usable(vectors: DataFrame) -> DataFrame:
    """Rows that take part, with two hashes that equal vectors share."""
    rows = vectors.select(
        F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector")
    ).filter("vec_id is not null and vector is not null")
    sound = F.forall(
        "vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    ) & F.exists("vector", lambda x: x != 0)
    return rows.filter(sound).select(
        "*", F.xxhash64("vector").alias("key"), F.xxhash64(F.lit(1), "vector").alias("key2")
    )


def fit_forest(
    rows: DataFrame, k: int, trees: int, leaf_rows: int, sample_values: int
) -> tuple[Forest, int, float] | None:
    """From the vectors with the smallest hashes: the forest, the rows of the sample to open, and how much wider.

    None if there are no vectors.
    """
    size = rows.agg(F.count("*").alias("rows"), F.max(F.size("vector")).alias("width")).first()
    if not size["rows"]:
        return None
    limit = max(1, sample_values // size["width"])
    sample = rows.select("vector", "key", "key2", "vec_id").orderBy("key", "key2", "vec_id").limit(limit)
    columns = sample.select("vector").toArrow()["vector"].combine_chunks()
    known = matrix(columns, size["width"])
    forest = Forest.fit(known, trees, leaf_rows)
    further = math.log2(max(1.0, size["rows"] / len(known)))
    wider = further * forest.widening(known, k) if further else 0.0
    return forest, max(LEAST_CANDIDATES, forest.needed(known, k)), wider


def _counted(forest):
    """Rows of each leaf in a batch."""

    def run(batches):
        trees = forest.value
        for batch in batches:
            leaves = trees.leaves(matrix(batch["vector"], trees.width)) + trees.first_leaf[:-1]
            leaf, rows = np.unique(leaves, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(leaf, pa.int64()), pa.array(rows, pa.int64())], names=["leaf", "rows"])

    return run


def _by_leaf(counts: DataFrame, leaves: int) -> np.ndarray:
    """Counts added up; the driver gets one number for each leaf of the forest, as many as the sample's bound allows."""
    found = counts.groupBy("leaf").agg(F.sum("rows").alias("rows")).toArrow()
    result = np.zeros(leaves, np.int64)
    result[found["leaf"].to_numpy()] = found["rows"].to_numpy()
    return result


def _assigned(forest, layout):
    """Each row in its cells, with the leaf, once for each tree."""

    def run(batches):
        trees, cells = forest.value, layout.value
        for batch in batches:
            leaves = (trees.leaves(matrix(batch["vector"], trees.width)) + trees.first_leaf[:-1]).ravel()
            row = np.repeat(np.arange(batch.num_rows), len(trees.trees))
            again, cell = cells.of_rows(leaves, batch["vec_id"].to_numpy()[row])
            taken = pa.array(row[again])
            yield pa.RecordBatch.from_arrays(
                [pa.array(cell, pa.int64()), pa.array(leaves[again], pa.int32()),
                 batch["vec_id"].take(taken), batch["vector"].take(taken)],
                names=["cell", "leaf", "vec_id", "vector"],
            )

    return run


def _searched(forest, candidates: int, wider: float):
    """Each query with the leaves it opens, the margins it missed them by, and its bound."""

    def run(batches):
        trees = forest.value
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                opened = trees.search(matrix(batch["vector"], trees.width), candidates, wider)
                leaves = [[int(trees.first_leaf[t]) + leaf for t, leaf, _ in x] for x, _ in opened]
                missed = [[m for _, _, m in x] for x, _ in opened]
                bounds = [bound for _, bound in opened]
                yield pa.RecordBatch.from_arrays(
                    [*(batch[name] for name in ("key", "key2", "vector")), pa.array(leaves, pa.list_(pa.int32())),
                     pa.array(missed, pa.list_(pa.float64())), pa.array(bounds, pa.float64())],
                    names=["key", "key2", "vector", "leaves", "missed", "bound"],
                )

    return run


def _sent(layout):
    """Each query once for each cell it goes to, with the leaves it opens there."""

    def run(batches):
        cells = layout.value
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                leaves = batch["leaves"].flatten().to_numpy()
                missed = batch["missed"].flatten().to_numpy()
                query = np.repeat(np.arange(batch.num_rows), pc.list_value_length(batch["leaves"]).to_numpy())
                again, cell = cells.of_queries(leaves, batch["key"].to_numpy()[query])
                order = np.lexsort((cell, query[again]))
                again, cell = again[order], cell[order]
                query = query[again]
                opens = np.ones(len(cell), bool)
                opens[1:] = (cell[1:] != cell[:-1]) | (query[1:] != query[:-1])
                start = np.flatnonzero(opens)
                edges = pa.array(np.append(start, len(cell)), pa.int32())
                taken = pa.array(query[start])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cell[start], pa.int64()),
                     *(batch[name].take(taken) for name in ("key", "key2", "vector", "bound")),
                     pa.ListArray.from_arrays(edges, pa.array(leaves[again], pa.int32())),
                     pa.ListArray.from_arrays(edges, pa.array(missed[again], pa.float64()))],
                    names=["cell", "key", "key2", "vector", "bound", "leaves", "missed"],
                )

    return run


def _ranked(keep: int, leaf_rows: int):
    """The ``keep`` nearest rows for each query, in the leaves of a cell that it opened."""
    kinds = {"key": np.int64, "key2": np.int64, "vec_id": np.int64, "score": np.float64}

    def run(rows: pa.Table, queries: pa.Table) -> pa.Table:
        empty = {name: np.empty(0, kind) for name, kind in kinds.items()}
        if not (rows.num_rows and queries.num_rows):
            return pa.table(empty)
        rows = rows.sort_by("vec_id")
        width = max(_width(rows), _width(queries))
        vectors, wanted = (matrix(t["vector"].combine_chunks(), width) for t in (rows, queries))
        lengths = np.sqrt((vectors * vectors).sum(axis=1))
        ids, key, key2 = rows["vec_id"].to_numpy(), queries["key"].to_numpy(), queries["key2"].to_numpy()
        found, waiting = [empty], 0
        for members, asked in _opened(rows, queries, _unit(vectors), _unit(wanted), leaf_rows):
            step = max(1, RANKED_AT_ONCE // len(members))
            for at in range(0, len(asked), step):
                some = asked[at : at + step]
                near = np.round(wanted[some] @ vectors[members].T / lengths[members], 12)
                best = np.argsort(-near, axis=1, kind="stable")[:, :keep]
                query, member = np.repeat(some, best.shape[1]), members[best.ravel()]
                found.append({
                    "key": key[query], "key2": key2[query], "vec_id": ids[member],
                    "score": cosines(wanted[query], vectors[member]),
                })
                waiting += len(query)
                if waiting > KEPT_AT_ONCE:
                    found, waiting = [_best(_joined(found), keep)], 0
        return pa.table(_best(_joined(found), keep))

    return run


def _opened(rows: pa.Table, queries: pa.Table, unit: np.ndarray, asks: np.ndarray, leaf_rows: int):
    """(rows, queries that rank them) of each opened leaf; those of many rows are grown on."""
    of_rows = rows["leaf"].to_numpy()
    by_leaf = np.argsort(of_rows, kind="stable")
    lists = queries["leaves"].combine_chunks()
    of_queries = lists.flatten().to_numpy()
    missed = queries["missed"].combine_chunks().flatten().to_numpy()
    query = np.repeat(np.arange(len(asks)), pc.list_value_length(lists).to_numpy())
    bounds = queries["bound"].to_numpy()
    order = np.argsort(of_queries, kind="stable")
    leaves, begin = np.unique(of_queries[order], return_index=True)
    low = np.searchsorted(of_rows[by_leaf], leaves, side="left")
    high = np.searchsorted(of_rows[by_leaf], leaves, side="right")
    for leaf, entries, a, b in zip(leaves.tolist(), np.split(order, begin[1:]), low, high):
        members, asked = by_leaf[a:b], query[entries]
        if b - a <= 2 * leaf_rows:
            if a < b:
                yield members, asked
            continue
        tree = Tree.fit(unit[members], leaf_rows, np.random.default_rng(leaf))
        grown = tree.leaf_of(unit[members])
        by_grown = np.argsort(grown, kind="stable")
        edges = np.searchsorted(grown[by_grown], np.arange(len(tree.leaves) + 1))
        for inner, some in tree.within(asks[asked], missed[entries], bounds[asked]):
            here = by_grown[edges[inner] : edges[inner + 1]]
            if len(here):
                yield members[here], asked[some]


def _joined(found: list[dict[str, np.ndarray]]) -> dict[str, np.ndarray]:
    return {name: np.concatenate([part[name] for part in found]) for name in found[0]}


def _best(near: dict[str, np.ndarray], keep: int) -> dict[str, np.ndarray]:
    """Of a cell's many leaves only the ``keep`` nearest of each query, each row once."""
    order = np.lexsort((near["vec_id"], -near["score"], near["key2"], near["key"]))
    near = {name: values[order] for name, values in near.items()}
    differs = {name: np.concatenate([[True], v[1:] != v[:-1]])[: len(v)] for name, v in near.items()}
    another = differs["key"] | differs["key2"]
    once = another | differs["vec_id"] | differs["score"]
    near, another = {name: values[once] for name, values in near.items()}, another[once]
    at = np.arange(len(another))
    place = at - np.maximum.accumulate(np.where(another, at, 0)) if len(at) else at
    return {name: values[place < keep] for name, values in near.items()}


def _width(table: pa.Table) -> int:
    return pc.max(pc.list_value_length(table["vector"])).as_py()


def nearest(
    vectors: DataFrame, queries: DataFrame, k: int = 5, trees: int = TREES, leaf_rows: int = LEAF_ROWS,
    sample_values: int = SAMPLE_VALUES,
) -> DataFrame:
    """The ``k`` nearest found of ``vectors`` for each of ``queries``, both (vec_id, embedding).

    A query's own id is no answer to it. Vectors that are null, zero or hold a
    null or non-finite component take no part, nor do rows without an id. Ties
    go to the smaller id. Vectors of different length are compared as if the
    shorter one ended in zeros. Of equal vectors only the ``k + 1`` smallest
    ids can be answers, so only they are searched, and queries with equal
    vectors are searched once. An empty table gives an empty one.
    """
    spark = vectors.sparkSession
    first = Window.partitionBy("key", "key2").orderBy("vec_id")
    rows = cut_lineage(
        _usable(vectors).withColumn("_n", F.dense_rank().over(first)).filter(F.col("_n") <= k + 1).drop("_n"),
        "vectors",
    )
    asked = cut_lineage(_usable(queries), "vector-queries")
    result = "query_id bigint, rank int, vec_id bigint, score double"
    fitted = fit_forest(rows, k, trees, leaf_rows, sample_values)
    if fitted is None:
        return spark.createDataFrame([], result)
    forest, candidates, wider = fitted
    leaves = int(forest.first_leaf[-1])
    known = spark.sparkContext.broadcast(forest)
    unique = asked.withColumn("_n", F.row_number().over(first)).filter("_n = 1")
    tasks = max(spark.sparkContext.defaultParallelism, math.ceil(asked.count() / SEARCH_ROWS))
    opened = cut_lineage(
        unique.select("key", "key2", "vector").repartition(tasks, "key").mapInArrow(
            _searched(known, candidates, wider),
            "key bigint, key2 bigint, vector array<double>, leaves array<int>, missed array<double>, bound double",
        ),
        "vector-leaves",
    )
    layout = spark.sparkContext.broadcast(Layout(
        _by_leaf(rows.select("vector").mapInArrow(_counted(known), "leaf bigint, rows bigint"), leaves),
        _by_leaf(opened.select(F.explode("leaves").alias("leaf"), F.lit(1).alias("rows")), leaves),
    ))
    placed = rows.select("vec_id", "vector").mapInArrow(
        _assigned(known, layout), "cell bigint, leaf int, vec_id bigint, vector array<double>"
    )
    sent = opened.mapInArrow(
        _sent(layout),
        "cell bigint, key bigint, key2 bigint, vector array<double>, bound double, leaves array<int>, missed array<double>",
    )
    near = placed.groupBy("cell").cogroup(sent.groupBy("cell")).applyInArrow(
        _ranked(k + 1, leaf_rows), "key bigint, key2 bigint, vec_id bigint, score double"
    )
    order = Window.partitionBy("key", "key2").orderBy(F.desc("score"), "vec_id")
    best = near.distinct().withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= k + 1)
    answers = asked.select(F.col("vec_id").alias("query_id"), "key", "key2").distinct().join(
        best.drop("_n"), ["key", "key2"]
    ).filter("query_id <> vec_id")
    final = Window.partitionBy("query_id", "key", "key2").orderBy(F.desc("score"), "vec_id")
    return (
        answers.withColumn("rank", F.row_number().over(final))
        .filter(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )

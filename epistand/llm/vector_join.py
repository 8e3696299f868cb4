"""Near-duplicate vectors by an exact metric range join.

Vectors are scaled to length 1, where cosine >= c is a distance of at most r = sqrt(2 - 2c). Pivots
(farthest-first on a bounded sample) cut the space: a vector's home is the cell of its nearest
pivot. Each pair of cells is decided in one of the two (a fixed tournament), and a vector is copied
to such another cell only if a vector of that cell can be near enough: it must lie within r of the
border plane between the pivots and, by the triangle inequality, within r plus the cell's radius
of its pivot. Both bounds are exact, so nothing is missed; pivots only change the work.

Cells are joined independently, a large cell in blocks of its own vectors; what is compared with a
block streams past it. A block counts links and keeps a spanning forest of them, so its output is
linear in its input however many pairs link. Equal vectors are one entry with a multiplicity.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from epistand.llm.common import connected_components, mix64, shared_table

_SLACK = 1e-6  # keeps rounding from losing a pair at a bound
_SINGLE = 1e-4  # single-precision products within this of the threshold are decided in double


def _matrix(column: pa.Array) -> np.ndarray:
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)
    # scaled by the largest component first: squares of extreme values would leave the range
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def farthest_first(sample: np.ndarray, k: int) -> np.ndarray:
    """Up to ``k`` rows of ``sample``, each the one farthest from those before."""
    if not len(sample):
        return sample
    chosen = [0]
    near = sample @ sample[0]
    while len(chosen) < min(k, len(sample)):
        i = int(near.argmin())
        if near[i] > 1 - 1e-9:
            break
        chosen.append(i)
        near = np.maximum(near, sample @ sample[i])
    return sample[chosen]


def _merge_labels(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Give linked entries their smallest common label, in place."""
    while True:
        differ = label[a] != label[b]
        if not differ.any():
            return
        a, b = a[differ], b[differ]
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        while (jump := label[label]).tobytes() != label.tobytes():
            label[:] = jump


class _Block:
    """Own vectors of one block, the links counted so far, and a forest over the own vectors."""

    def __init__(self, threshold: float):
        self.threshold, self.ids, self.mult, self.vectors = threshold, [], [], []

    def add(self, ids, mult, vectors):
        self.ids.append(ids)
        self.mult.append(mult)
        self.vectors.append(vectors)

    def close(self):
        self.ids, self.mult = np.concatenate(self.ids), np.concatenate(self.mult)
        self.vectors = np.concatenate(self.vectors)
        self.single = self.vectors.astype(np.float32)
        self.links, self.label = np.zeros(len(self.ids), np.int64), np.arange(len(self.ids))
        for lo in range(0, len(self.ids), 1024):
            i, j = self._near(self.vectors[lo:lo + 1024], lo + 1)
            i = i + lo
            np.add.at(self.links, i, self.mult[j])
            np.add.at(self.links, j, self.mult[i])
            _merge_labels(self.label, i, j)

    def _near(self, probe: np.ndarray, after: int | None = None):
        """(probe row, own row) of all pairs at the threshold; own rows from ``after`` + row on."""
        product = probe.astype(np.float32) @ self.single.T
        i, j = np.nonzero(product >= self.threshold - _SINGLE)
        if after is not None:
            keep = j >= i + after
            i, j = i[keep], j[keep]
        hard = np.flatnonzero(product[i, j] < self.threshold + _SINGLE)
        bad = hard[np.einsum("ij,ij->i", probe[i[hard]], self.vectors[j[hard]]) < self.threshold]
        return np.delete(i, bad), np.delete(j, bad)

    def probe(self, ids, mult, vectors):
        """Links of the probes and one edge for each probe that has any."""
        out = []
        for lo in range(0, len(ids), 1024):
            i, j = self._near(vectors[lo:lo + 1024])
            if not len(i):
                continue
            np.add.at(self.links, j, mult[lo + i])
            row, first = np.unique(i, return_index=True)
            leader = np.zeros(int(i.max()) + 1, np.int64)
            leader[row] = j[first]
            _merge_labels(self.label, leader[i], j)
            count = np.bincount(i, weights=self.mult[j], minlength=len(leader)).astype(np.int64)[row]
            out.append((ids[lo + row], count, self.ids[j[first]]))
        return out

    def finish(self):
        some = self.links > 0
        return [(self.ids[some], self.links[some], self.ids[self.label[some]])]


def link_vectors(vectors: DataFrame, key: str = "vec_id", embedding: str = "embedding", cosine: float = 0.9,
                 cell_rows: int = 2000, max_pivots: int = 512, sample_rows: int = 4096, block_rows: int = 4096) -> DataFrame:
    """One row per input row: ``vec_id, n_links, component_id, kept``.

    Two vectors link when their cosine in double precision is at least ``cosine``; n_links counts
    other rows linked directly (equal vectors and repeated rows included), component_id is the
    smallest key reachable, kept marks the row whose key that is. NULL or zero vectors and those
    with NULL or non-finite components link with nothing, and vectors of different lengths never
    link. A row with a NULL key counts as a link of others and has component_id NULL if alone.
    Extra columns are ignored; an empty table gives no rows.

    The pivots come from a bounded sample of ``sample_rows`` distinct vectors by hash; every vector
    is joined, and the result doesn't depend on the sample."""
    x = vectors.select(vectors[key].cast("long").alias("id"), vectors[embedding].alias("e"))
    good = (F.col("e").isNotNull() & ~F.exists("e", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
            & F.exists("e", lambda v: v != 0))
    x = x.withColumn("good", F.coalesce(good, F.lit(False)))
    x = x.select("id", "good", F.when(F.col("good"), F.col("e")).alias("e"))
    x = shared_table(x.select("*", F.xxhash64("e").alias("h1"), F.xxhash64(F.lit(1), "e").alias("h2"),
                              F.monotonically_increasing_id().alias("rid")), "vectors")
    equal = x.where("good").select("h1", "h2", "e", "rid", "id")
    classes = (equal.groupBy("h1", "h2", "e").agg(F.min("rid").alias("rep"), F.count(F.lit(1)).alias("mult"),
                                                  F.min("id").alias("low")))
    classes = shared_table(classes.withColumn("dim", F.size("e")), "classes")
    # a length of few vectors is one cell, all of them in one job; a longer one has cells of its own
    large = [r["dim"] for r in classes.groupBy("dim").count().where(F.col("count") > block_rows).select("dim").collect()]
    found = _join_lengths(classes.where(~F.col("dim").isin(large)) if large else classes, cosine)
    for dim in sorted(large):
        found = found.union(_join_cells(classes.where(F.col("dim") == dim), cosine, cell_rows, max_pivots, sample_rows, block_rows))
    found = shared_table(found, "links")
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    component = connected_components(found.where("rep <> other"), "rep", "other")
    lowest = (classes.select("rep", "low").join(component.withColumnRenamed("id", "rep"), "rep")
              .groupBy("component_id").agg(F.min("low").alias("lowest")))
    component = component.join(lowest, "component_id").select(F.col("id").alias("rep"), "lowest")
    per_class = (classes.join(links, "rep", "left").join(component, "rep", "left")
                 .select("h1", "h2", (F.coalesce("links", F.lit(0)) + F.col("mult") - 1).alias("n_links"),
                         F.coalesce("lowest", "low").alias("component_id")))
    matched = x.where("good").select("id", "h1", "h2").join(per_class, ["h1", "h2"]).select("id", "n_links", "component_id")
    alone = x.where("not good").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return matched.union(alone).select(F.col("id").alias("vec_id"), F.col("n_links").cast("long").alias("n_links"), "component_id",
                                       F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"))


def _joiner(cosine: float):
    """Joins the rows (task, role, rep, mult, e) of sorted tasks: own vectors (role 0), then copies."""

    def join(batches):
        task, block, closed = None, None, False

        def emit(parts):
            for rep, links, other in parts:
                yield pa.RecordBatch.from_arrays([pa.array(rep), pa.array(links), pa.array(other)], ["rep", "links", "other"])

        for batch in batches:
            if not batch.num_rows:
                continue
            t, role = batch["task"].to_numpy(), batch["role"].to_numpy()
            cuts = np.flatnonzero(np.diff(t * 2 + role)) + 1
            rep, mult = batch["rep"].to_numpy(), batch["mult"].to_numpy()
            for a, b in zip([0, *cuts], [*cuts, len(t)], strict=True):
                if t[a] != task:
                    if block is not None and (closed or block.ids):
                        if not closed:
                            block.close()
                        yield from emit(block.finish())
                    task, block, closed = t[a], _Block(cosine), False
                x = _matrix(batch["e"].slice(a, b - a))  # vectors of one length
                if role[a] == 0:
                    block.add(rep[a:b], mult[a:b], x)
                else:
                    if not closed and block.ids:
                        block.close()
                        closed = True
                    if closed:
                        yield from emit(block.probe(rep[a:b], mult[a:b], x))
        if block is not None and (closed or block.ids):
            if not closed:
                block.close()
            yield from emit(block.finish())

    return join


def _join_lengths(classes: DataFrame, cosine: float) -> DataFrame:
    """``_join_cells`` of lengths with at most a block of vectors each: the length is the cell."""
    dealt = classes.select(F.col("dim").cast("long").alias("task"), F.lit(0).alias("role"), "rep", "mult", "e")
    return dealt.repartition("task").sortWithinPartitions("task").mapInArrow(_joiner(cosine), "rep long, links long, other long")


def _join_cells(classes: DataFrame, cosine: float, cell_rows: int, max_pivots: int, sample_rows: int,
                block_rows: int) -> DataFrame:
    """(rep, links, other): partial link counts of classes, and edges of a spanning forest."""
    n = classes.count()
    sc = classes.sparkSession.sparkContext
    dice = F.pmod(F.xxhash64("h1"), F.lit(1_000_000))
    sample = classes.where(dice <= min(1.0, sample_rows / n) * 1_000_000).orderBy("h1", "h2").limit(2 * sample_rows)
    sample = sample.select("e").toArrow()["e"].combine_chunks()
    pivots = farthest_first(_matrix(sample), max(1, min(max_pivots, n // cell_rows))) if len(sample) else None
    if pivots is None:  # no sampled row: any fixed direction is a pivot
        first = classes.select("e").limit(1).toArrow()["e"].combine_chunks()
        pivots = _matrix(first)
    reach = float(np.sqrt(2 - 2 * cosine)) + _SLACK
    shared = sc.broadcast(pivots)  # at most max_pivots vectors

    def homes(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            dot = _matrix(batch["e"]) @ shared.value.T
            home = dot.argmax(1)
            far = np.sqrt(np.maximum(0, 2 - 2 * dot[np.arange(len(home)), home]))
            yield pa.RecordBatch.from_arrays([batch["rep"], pa.array(home.astype(np.int32)), pa.array(far)], ["rep", "cell", "far"])

    cells = (classes.select("rep", "e").mapInArrow(homes, "rep long, cell int, far double")
             .groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("far").alias("radius")).collect())
    k = len(pivots)
    radius, blocks = np.full(k, -1.0), np.zeros(k, np.int64)
    for r in cells:
        radius[r["cell"]], blocks[r["cell"]] = r["radius"], -(-r["n"] // block_rows)
    first_task = np.cumsum(blocks) - blocks
    plan = sc.broadcast((radius, blocks, first_task))

    def deal(batches):
        radius, blocks, first_task = plan.value
        pivots = shared.value
        between = np.sqrt(np.maximum(0, 2 - 2 * pivots @ pivots.T))
        i, j = np.meshgrid(np.arange(k), np.arange(k), indexing="ij")
        meets = ((i < j) == ((i + j) % 2 == 0)) & (i != j)  # vectors of cell i are copied to cell j
        for batch in batches:
            if not batch.num_rows:
                continue
            reps, mult = batch["rep"].to_numpy(), batch["mult"].to_numpy()
            dot = _matrix(batch["e"]) @ pivots.T
            home = dot.argmax(1)
            own = dot[np.arange(len(home)), home][:, None]
            copy = meets[home] & (blocks > 0) & (own - dot <= reach * between[home] + _SLACK)
            copy &= np.sqrt(np.maximum(0, 2 - 2 * dot)) <= radius + reach + _SLACK
            # by a hash: neighbouring copies of vectors would leave blocks empty
            block = (mix64(reps.view(np.uint64)) % np.maximum(blocks[home], 1).astype(np.uint64)).astype(np.int64)
            rows, tasks, roles = [np.arange(len(home))], [first_task[home] + block], [np.zeros(len(home), np.int32)]
            for cell in range(k):
                there = np.flatnonzero(copy[:, cell])
                for b in range(blocks[cell]):
                    rows.append(there)
                    tasks.append(np.full(len(there), first_task[cell] + b))
                for b in range(blocks[cell] - 1):  # later blocks of the same cell pass this one
                    later = np.flatnonzero((home == cell) & (block > b))
                    rows.append(later)
                    tasks.append(np.full(len(later), first_task[cell] + b))
            rows, tasks = np.concatenate(rows), np.concatenate(tasks)
            roles = np.concatenate([roles[0], np.ones(len(rows) - len(home), np.int32)])
            for lo in range(0, len(rows), 4096):
                s = slice(lo, lo + 4096)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(tasks[s].astype(np.int64)), pa.array(roles[s]), pa.array(reps[rows[s]]), pa.array(mult[rows[s]]),
                     batch["e"].take(pa.array(rows[s]))], ["task", "role", "rep", "mult", "e"])

    kind = classes.schema["e"].dataType.simpleString()
    dealt = classes.select("rep", "mult", "e").mapInArrow(deal, f"task long, role int, rep long, mult long, e {kind}")
    spread = max(int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(int(blocks.sum()), 20_000))
    return (dealt.repartition(spread, "task").sortWithinPartitions("task", "role")
            .mapInArrow(_joiner(cosine), "rep long, links long, other long"))

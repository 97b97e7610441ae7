"""Hard negatives of anchor vectors, by bounds along a spanning tree of the anchors.

Scores are inner products, so a candidate's score with an anchor differs from that with the anchor's parent in the tree
by no more than the length of the edge times the candidate's norm. Going down the tree, each candidate carries an
interval for its score; only where the interval meets the window that an anchor asks for, the score is computed,
and the interval shrinks to it for the anchors below.

Anchors are a stated set of queries against all rows, in blocks: near anchors share a block, each block has a tree, and a pass over
the rows takes as many blocks as ``PASS_BYTES`` hold. Tasks keep the best few rows of each anchor and hand on no others.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brookmart.llm.common import Scratch, importable

#: Anchors in a block, candidates bounded at a time, and bytes of anchors that a pass over the rows takes. They change no result.
BLOCK, ROWS, PASS_BYTES = 1024, 1024, 32 << 20
#: Whole numbers below this are exact as doubles.
EXACT = float(2**53)
ANCHORS = "block long, ids binary, labels binary, vectors binary, parents binary, edges binary"

#: ``pair`` numbers an anchor's positives.
PAIRS = "anchor_id long, pair long, positive_id long, positive_score long, negative_id long, negative_score long"


def usable(id_col: Column, vector: Column, label: Column) -> Column:
    """Rows that take part: identifier, label and vector there, and every component a finite number."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return id_col.isNotNull() & label.isNotNull() & vector.isNotNull() & ~F.coalesce(bad, F.lit(True))


def whole_numbers(vectors: pa.ListArray, scale: float, width: int) -> np.ndarray:
    """floor(scale * x) of each component as doubles, filled up with zeros to ``width``."""
    sizes = np.diff(vectors.offsets.to_numpy())
    values = np.floor(vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * scale)
    out = np.zeros((len(vectors), width))
    out[np.arange(width) < sizes[:, None]] = values
    return out


def products(rows: np.ndarray, vector: np.ndarray) -> np.ndarray:
    """Exact inner products: by doubles where these are exact, else by Python's integers."""
    if rows.size == 0:
        return np.zeros(len(rows))
    if np.abs(rows).max() * np.abs(vector).max() * len(vector) < EXACT:
        return rows @ vector
    return np.array([sum(int(a) * int(b) for a, b in zip(r, vector)) for r in rows], object)


def spanning_tree(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A minimum spanning tree by growing it from the first vector: the order, and each one's parent and edge in that order."""
    n = len(vectors)
    near = np.sqrt(((vectors - vectors[0]) ** 2).sum(axis=1))
    parent, order, out = np.zeros(n, np.int64), [0], np.zeros(n, bool)
    out[0] = True
    for _ in range(n - 1):
        k = int(np.argmin(np.where(out, np.inf, near)))
        out[k] = True
        order.append(k)
        d = np.sqrt(((vectors - vectors[k]) ** 2).sum(axis=1))
        closer = ~out & (d < near)
        near[closer], parent[closer] = d[closer], k
    order = np.array(order)
    at = np.empty(n, np.int64)
    at[order] = np.arange(n)
    return order, at[parent[order]], near[order]


class Block:
    """Anchors in the order of their tree, and the best rows of each so far."""

    def __init__(self, ids, labels, vectors, parents, edges):
        self.ids, self.labels, self.vectors, self.parents, self.edges = ids, labels, vectors, parents, edges
        self.slack = 1e-9 * np.sqrt((vectors**2).sum(axis=1).max(initial=0))  # far above what roots and large scores lose as doubles

    def intervals(self, rows: np.ndarray, norms: np.ndarray, wanted, found) -> int:
        """Go down the tree. ``wanted(k, low, high)`` tells the rows whose scores are to be computed, ``found(k, which, scores)`` takes them."""
        low, high = np.empty((len(self.ids), len(rows))), np.empty((len(self.ids), len(rows)))
        computed = 0
        for k, (parent, edge) in enumerate(zip(self.parents.tolist(), self.edges.tolist())):
            if k:
                reach = norms * (edge + self.slack)
                low[k], high[k] = low[parent] - reach, high[parent] + reach
                which = np.flatnonzero(wanted(k, low[k], high[k]))
            else:
                which = np.arange(len(rows))
            if len(which):
                scores = products(rows[which], self.vectors[k])
                low[k, which] = high[k, which] = scores.astype(np.float64)
                computed += len(which)
                found(k, which, scores)
        return computed


class Best:
    """The first ``most`` of (score falling, identifier rising) met so far, for each of some numbered lists."""

    def __init__(self, lists: int, most: int):
        self.most = most
        self.kept: list[list[tuple]] = [[] for _ in range(lists)]
        self.least = np.full(lists, -np.inf)  # scores below it no longer count

    def add(self, k: int, scores: np.ndarray, ids: np.ndarray) -> None:
        hope = scores >= self.least[k]
        if hope.any():
            scores, ids = scores[hope], ids[hope]
            if len(ids) > 8 * self.most and scores.dtype != object:
                order = np.lexsort((ids, -scores))[: self.most]
                scores, ids = scores[order], ids[order]
            self.kept[k] = sorted([*self.kept[k], *zip((-int(x) for x in scores), ids.tolist())])[: self.most]
            if len(self.kept[k]) == self.most:
                self.least[k] = np.nextafter(float(-self.kept[k][-1][0]), -np.inf)


def _blocks(width: int, scale: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A partition's anchors, which lie near to each other in its order, block by block with their trees."""
        from pyspark import TaskContext

        number, waiting = TaskContext.get().partitionId() << 32, []

        def block(rows: list) -> pa.RecordBatch:
            ids, labels, vectors = (np.concatenate(x) for x in zip(*rows))
            order, parents, edges = spanning_tree(vectors)
            parts = (ids[order], labels[order], vectors[order], parents, edges)
            return pa.record_batch([pa.array([number]), *(pa.array([x.tobytes()], pa.binary()) for x in parts)], names=[f.split()[0] for f in ANCHORS.split(", ")])

        for batch in batches:
            ids, labels = (batch.column(c).to_numpy() for c in ("vec_id", "label"))
            vectors = whole_numbers(batch.column("vector"), scale, width)
            for at in range(0, len(ids), BLOCK):
                cut = slice(at, at + BLOCK)
                waiting.append((ids[cut], labels[cut], vectors[cut]))
                if sum(len(w[0]) for w in waiting) >= BLOCK:
                    yield block(waiting)
                    waiting, number = [], number + 1
        if waiting:
            yield block(waiting)

    return run


def _read(row, width: int) -> Block:
    a = np.frombuffer
    return Block(a(row["ids"], np.int64), a(row["labels"], np.int64), a(row["vectors"], np.float64).reshape(-1, width), a(row["parents"], np.int64), a(row["edges"], np.float64))


def _candidates(batches: Iterator[pa.RecordBatch], width: int, scale: float):
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            piece = batch.slice(at, ROWS)
            vectors = whole_numbers(piece.column("vector"), scale, width)
            yield piece.column("vec_id").to_numpy(), piece.column("label").to_numpy(), vectors, np.sqrt((vectors**2).sum(axis=1))


def _positives(shared, width: int, scale: float, most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The best rows of an anchor's own label, of those that this task sees."""
        blocks = [_read(r, width) for r in shared.value]
        best = [Best(len(b.ids), most) for b in blocks]
        for ids, labels, vectors, norms in _candidates(batches, width, scale):
            for b, top in zip(blocks, best):
                def own(k):
                    return (labels == b.labels[k]) & (ids != b.ids[k])

                def found(k, which, scores):
                    mine = own(k)[which]
                    top.add(k, scores[mine], ids[which[mine]])

                b.intervals(vectors, norms, lambda k, low, high: own(k) & (high >= top.least[k]), found)
        for b, top in zip(blocks, best):
            rows = [(int(a), i, -s) for a, kept in zip(b.ids, top.kept) for s, i in kept]
            yield _rows("anchor_id long, positive_id long, positive_score long", rows)

    return run


def _negatives(shared, width: int, scale: float, most: int, shares: tuple[int, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """For each anchor and positive, the best rows of other labels in the positive's window, of those that this task sees."""
        blocks = [_read(r, width) for r, _ in shared.value]
        given = [[windows.get(i, []) for i in b.ids.tolist()] for b, (_, windows) in zip(blocks, shared.value)]
        tops = []
        for positives in given:
            first = np.cumsum([0, *(len(p) for p in positives)])
            tops.append((first, Best(int(first[-1]), most)))
        for ids, labels, vectors, norms in _candidates(batches, width, scale):
            for b, positives, (first, top) in zip(blocks, given, tops):
                def wanted(k, low, high):
                    windows = positives[k]
                    if not windows:
                        return np.zeros(len(ids), bool)
                    lists = range(first[k], first[k + 1])
                    bottom = min(max(-(-shares[0] * s // shares[1]), top.least[j]) for j, (_, s) in zip(lists, windows))
                    return (labels != b.labels[k]) & (high >= bottom) & (low <= max(s for _, s in windows))

                def found(k, which, scores):
                    other = labels[which] != b.labels[k]
                    which, scores = which[other], scores[other]
                    for j, (_, s) in enumerate(positives[k]):
                        inside = (scores >= -(-shares[0] * s // shares[1])) & (scores <= s)
                        top.add(first[k] + j, scores[inside], ids[which[inside]])

                b.intervals(vectors, norms, wanted, found)
        for b, positives, (first, top) in zip(blocks, given, tops):
            rows = [(a, j, p, s, i, -t) for k, a in enumerate(b.ids.tolist()) for j, (p, s) in enumerate(positives[k]) for t, i in top.kept[first[k] + j]]
            yield _rows(PAIRS, rows)

    return run


def _rows(schema: str, rows: list) -> pa.RecordBatch:
    names = [f.split()[0] for f in schema.split(", ")]
    return pa.record_batch([pa.array(c, pa.int64()) for c in (zip(*rows) if rows else [[]] * len(names))], names=names)


def _near(vector: Column, width: int) -> Column:
    """A number that near vectors tend to share: the signs of some of the first components. It only orders anchors into blocks."""
    bits = [F.when(F.coalesce(F.try_element_at(vector, F.lit(i + 1)), F.lit(0.0)) > 0, 1 << i).otherwise(0) for i in range(min(width, 12))]
    out = F.lit(0)
    for b in bits:
        out = out + b
    return out


def hard_negatives(rows: DataFrame, anchors: Column, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                   scale: float = 256.0, positives: int = 5, negatives: int = 5, shares: tuple[int, int] = (80, 100)) -> DataFrame:
    """Negatives that score nearly as high as a positive: anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Components become floor(``scale`` * x), a score is the inner product with the anchor, higher scores come first, and of equal ones the smaller
    identifier. The first ``positives`` other rows of an anchor's label are its positives (rows with the anchor's own identifier are not other rows). For each
    one, the first ``negatives`` rows of other labels with shares[0] * positive <= shares[1] * negative <= shares[1] * positive are returned.

    ``anchors`` is a condition on rows. Rows with a null identifier, label, vector or component, or a component that is not finite, take no part; shorter
    vectors are filled up with zeros. Repeated rows count each as positives and negatives; of anchors with the same identifier the one with the
    smallest label and vector counts. Scores are exact; one beyond 64 bits fails. An empty table, or one without anchors, gives no rows. Other columns are not read.
    """
    spark = rows.sparkSession
    importable(spark)
    scratch = Scratch(spark, "negatives")
    part = usable(F.col(id_col), F.col(vector_col), F.col(label_col))
    taken = rows.where(part).select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("long").alias("label"),
                                    F.col(vector_col).cast("array<double>").alias("vector"), F.coalesce(anchors, F.lit(False)).alias("is_anchor"))
    chosen = taken.where("is_anchor").groupBy("vec_id").agg(F.min(F.struct("label", "vector")).alias("a")).select("vec_id", "a.*")
    found = taken.agg(F.max(F.size("vector")), F.count_if("is_anchor")).first()
    out = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if not found[1]:
        return spark.createDataFrame([], out)
    width = max(found[0], 1)
    placed = scratch.keep(chosen.withColumn("near", _near(F.col("vector"), width)), "anchors")
    ordered = placed.repartitionByRange(max(1, found[1] // (64 * BLOCK)), "near", "vec_id").sortWithinPartitions("near", "vec_id").drop("near")
    blocks = scratch.keep(ordered.mapInArrow(_blocks(width, scale), ANCHORS), "blocks")
    numbers = sorted(r["block"] for r in blocks.select("block").collect())  # one for each BLOCK anchors or partition
    at_once = max(1, PASS_BYTES // (BLOCK * (width + 4) * 8))
    lines = taken.select("vec_id", "label", "vector")
    by_anchor = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    by_pair = Window.partitionBy("anchor_id", "pair").orderBy(F.desc("negative_score"), "negative_id")
    done = None
    for n, at in enumerate(range(0, len(numbers), at_once)):
        mine = blocks.where(F.col("block").isin(numbers[at:at + at_once])).collect()  # at most PASS_BYTES
        shared = spark.sparkContext.broadcast(mine)
        seen = lines.mapInArrow(_positives(shared, width, scale, positives), "anchor_id long, positive_id long, positive_score long")
        first = scratch.keep(seen.withColumn("n", F.row_number().over(by_anchor)).where(F.col("n") <= positives).drop("n"), f"positives-{n}")
        windows: dict[int, list[tuple[int, int]]] = {}
        for r in first.collect():  # at most ``positives`` for each anchor of the pass
            windows.setdefault(r["anchor_id"], []).append((r["positive_id"], r["positive_score"]))
        given = spark.sparkContext.broadcast([(b, {i: sorted(windows[i], key=lambda x: (-x[1], x[0])) for i in np.frombuffer(b["ids"], np.int64).tolist() if i in windows}) for b in mine])
        hard = lines.mapInArrow(_negatives(given, width, scale, negatives, shares), PAIRS)
        hard = hard.withColumn("rank", F.row_number().over(by_pair)).where(F.col("rank") <= negatives)
        done = scratch.keep(hard, f"negatives-{n}") if done is None else done.unionByName(scratch.keep(hard, f"negatives-{n}"))
    return done.select(*(f.split()[0] for f in out.split(", ")))

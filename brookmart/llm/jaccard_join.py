"""Exact n-gram Jaccard join in the metric space of shingle sets.

Jaccard distance is a metric, and two documents link when theirs is at most DELTA. The join works on distinct sets:

1. Anchor regions. Every linked pair shares a shingle among the first n - ceil(t n) + 1 of each set in one
   global order (rare shingles first). So each set is replicated into the regions of these anchors. Within a region, pairs are
   excluded by size and by profiles: shingles counted by hash; the sum of the smaller counts is at least the number of
   common shingles. In a region too large for one task, sets are tied to the next larger one if their sizes allow a link at all. Sets tied
   together form a group; no link leaves its group.
2. Voronoi recursion. A group that fits a task is joined there. A larger one is divided by pivots: every set goes to the cell of its
   nearest pivot and, as a boundary set, into each cell whose pivot is no further than 2 DELTA beyond that; by the triangle
   inequality every linked pair meets in a cell. Distances to pivots are links themselves, so cells whose sets are all connected
   already are finished, and a dense cloud of near copies needs no pairs of its own.
3. Cells that are not finished after ROUNDS are joined exactly by pairs of blocks: the sets outside the largest component of a
   cell meet all sets of the cell.

Pure Voronoi regions over all documents would not do: unrelated documents have distance 1 to each other and to every pivot,
so triangle windows would copy all documents into all regions. The anchor regions are what separates these.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brookmart.llm.common import Scratch, whole
from brookmart.llm.components import components

WORDS, PERCENT = 4, 85
#: Sets and shingles that one task joins; sets per task when distances to pivots are taken; pivots per cell and round.
LEAF, LEAF_SHINGLES, CHUNK, PIVOTS, ROUNDS = 4000, 1_000_000, 256, 16, 2
#: The order of anchors is learned from about so many documents: shingles in COMMON or more of them come last, by count.
#: Any order gives the same links; this one keeps frequent passages from being anchors.
ORDER_DOCS, COMMON, COMMON_MOST = 8_000, 3, 400_000
#: Rows of a region whose pairs are tried in one task; fewest and most counters of a profile; bits of the filters for what is read again.
REGION, PROFILE, PROFILE_MOST, FILTER_BITS = 4096, 64, 8192, 1 << 22

_MIX = np.uint64(0x9E3779B97F4A7C15)
_BASE = np.uint64(0x100000001B3)
_WORD_STEPS = np.array([0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3],
                       dtype=np.uint64)


def _scramble(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _WORD_STEPS[0]
    h = (h ^ (h >> np.uint64(27))) * _WORD_STEPS[1]
    return h ^ (h >> np.uint64(31))


def _powers(n: int, base: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def shingle_set(text: str, size: int = WORDS) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct word shingles; of the whole sequence if it has fewer words; empty without words.

    Words are runs of other than the six ASCII white spaces, with A-Z in lower case. A word's hash is a polynomial over its bytes,
    taken for all words at once from running sums.
    """
    data = np.frombuffer(text.encode("utf-8", "surrogatepass").lower(), np.uint8)
    blank = (data == 32) | ((data >= 9) & (data <= 13))
    edges = np.flatnonzero(np.diff(np.concatenate([[True], blank, [True]]).astype(np.int8)))
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return np.empty(0, np.uint64)
    with np.errstate(over="ignore"):
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers(len(data), int(_BASE)))])
        words = (sums[ends] - sums[starts]) * _powers(len(data) + 1, pow(int(_BASE), -1, 2**64))[starts]
        words = _scramble(words + (ends - starts).astype(np.uint64) * _MIX)
        k = min(size, len(words))
        h = np.zeros(len(words) - k + 1, np.uint64)
        for i in range(k):
            h = _scramble(h * _WORD_STEPS[2] + words[i:len(words) - k + 1 + i] + _MIX)
        # A short sequence is told from a shingle by its length.
        return np.unique(h + np.uint64(k != size) * np.uint64(k) * _WORD_STEPS[3])


def linked(common: int, a: int, b: int, percent: int = PERCENT) -> bool:
    return 100 * common >= percent * (a + b - common)


def anchors_of(shingles: np.ndarray, common: np.ndarray, counts: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """The first n - ceil(t n) + 1 shingles in the global order: rare ones by hash, then common ones by count and hash."""
    n = len(shingles)
    want = n + (-percent * n // 100) + 1 if n else 0
    if not len(common):
        return shingles[:want]
    at = np.minimum(np.searchsorted(common, shingles), len(common) - 1)
    is_common = common[at] == shingles
    rare = shingles[~is_common]
    if len(rare) >= want:
        return rare[:want]
    late, often = shingles[is_common], counts[at[is_common]]
    return np.concatenate([rare, late[np.lexsort((late, often))][: want - len(rare)]])


class _Forest:
    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> None:
        self.up[self.root(i)] = self.root(j)


def join_cell(sets: list[np.ndarray], percent: int = PERCENT) -> list[int]:
    """A root for each set (sorted distinct numbers), so that sets connected by links (among these sets) have the same root.

    Recursive: cells of the pivots with 2 DELTA windows until they are small or stop shrinking; then pairs, skipping those that are
    connected, too different in size, or too far apart by their distances to the pivots. Shingles of two or more sets
    become bits, so that a set is compared with many at once.
    """
    forest, delta = _Forest(len(sets)), 1 - percent / 100 + 1e-12
    sizes = np.array([len(s) for s in sets])
    values, place, often = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    column = np.cumsum(often > 1) - 1
    marks = np.zeros((len(sets), max(1, -(-int((often > 1).sum()) // 64)) * 64 // 8), np.uint8)
    owner, shared = np.repeat(np.arange(len(sets)), sizes), often[place] > 1
    at = column[place[shared]]
    np.bitwise_or.at(marks, (owner[shared], at >> 3), (1 << (at & 7)).astype(np.uint8))
    bits = marks.view(np.uint64)

    def common(i: int, others: np.ndarray) -> np.ndarray:
        return np.concatenate([np.bitwise_count(bits[i] & bits[others[k:k + 512]]).sum(axis=1, dtype=np.int64)
                               for k in range(0, len(others), 512)] or [np.empty(0, np.int64)])

    def link(i: int, others: np.ndarray, counts: np.ndarray) -> None:
        for j in others[(100 * counts >= percent * (sizes[i] + sizes[others] - counts)) & (others != i)]:
            forest.join(i, int(j))

    def pairs(members: np.ndarray, to_pivots: np.ndarray | None) -> None:
        """Pairs of a set outside the largest component with any other; the rest are connected already."""
        roots = np.array([forest.root(i) for i in members])
        names, many = np.unique(roots, return_counts=True)
        for k in np.flatnonzero(roots != names[many.argmax()]):
            i = members[k]
            close = 100 * np.minimum(sizes[members], sizes[i]) >= percent * np.maximum(sizes[members], sizes[i])
            close &= roots != roots[k]
            if to_pivots is not None:
                close &= np.abs(to_pivots - to_pivots[k]).max(axis=1) <= delta
            others = members[close]
            link(i, others, common(i, others))

    def divide(members: np.ndarray) -> None:
        if len({forest.root(i) for i in members}) < 2:
            return
        if len(members) <= 16:
            return pairs(members, None)
        pivots = members[:: max(1, len(members) // 6)][:6]
        distances = []
        for p in pivots:
            counts = common(p, members)
            link(p, members, counts)
            distances.append(1 - counts / (sizes[members] + sizes[p] - counts))
        d = np.array(distances).T
        near = d <= d.min(axis=1, keepdims=True) + 2 * delta
        if near.sum() > 2 * len(members) or near.sum(axis=0).max() == len(members):
            return pairs(members, d)
        for j in range(len(pivots)):
            divide(members[near[:, j]])

    divide(np.arange(len(sets)))
    return [forest.root(i) for i in range(len(sets))]


def _unpack(data: bytes) -> frozenset:
    return frozenset(np.frombuffer(data, np.uint64).tolist())


def _local_links(percent: int):
    def run(f: pd.DataFrame) -> pd.DataFrame:
        f = f.drop_duplicates("key").sort_values("key")
        keys = f["key"].tolist()
        roots = join_cell([np.frombuffer(x, np.uint64) for x in f["set"]], percent)
        found = [(keys[i], keys[r]) for i, r in enumerate(roots) if i != r]
        return pd.DataFrame(found, columns=["a", "b"])
    return run


def _pivot_distances(percent: int):
    """Distances of the sets of one chunk to the pivots of its cell, and which of them are links."""
    def run(f: pd.DataFrame) -> pd.DataFrame:
        pivots = [(k, _unpack(s)) for k, s in f.loc[f["is_pivot"], ["key", "set"]].drop_duplicates("key").sort_values("key").itertuples(index=False)]
        rows = []
        for cell, key, data in f.loc[~f["is_pivot"], ["cell", "key", "set"]].drop_duplicates("key").itertuples(index=False):
            s = _unpack(data)
            d, links = [], []
            for k, p in pivots:
                c = len(s & p)
                d.append(1 - c / max(1, len(s) + len(p) - c))
                if k != key and linked(c, len(s), len(p), percent):
                    links.append(k)
            rows.append((cell, key, d, links))
        return pd.DataFrame(rows, columns=["cell", "key", "d", "links"])
    return run


def _consensus(f: pd.DataFrame) -> pd.DataFrame:
    """A set of the shingles that most of the drawn sets of a cell have: a pivot that need not be a document."""
    drawn = [np.frombuffer(x, np.uint64) for x in f["set"]]
    values, counts = np.unique(np.concatenate(drawn), return_counts=True)
    core = values[counts * 2 > len(drawn)]
    if not len(core):
        core = drawn[0]
    return pd.DataFrame({"cell": f["cell"].iloc[:1], "key": [b"consensus"], "set": [core.tobytes()]})


def _distances(cells: DataFrame, pivots: DataFrame, percent: int) -> DataFrame:
    """(cell, key, d, links) for every set of a cell; chunks of bounded size each get the pivots of their cell."""
    chunks = cells.select("cell", "chunk").distinct()
    sent = pivots.join(chunks, "cell").select("cell", "chunk", "key", "set", F.lit(True).alias("is_pivot"))
    rows = cells.select("cell", "chunk", "key", "set", F.lit(False).alias("is_pivot")).union(sent)
    return rows.groupBy("cell", "chunk").applyInPandas(
        _pivot_distances(percent), "cell long, key binary, d array<double>, links array<binary>")


def _sized(cells: DataFrame, *more) -> DataFrame:
    return cells.groupBy("cell").agg(F.count(F.lit(1)).alias("m"), F.sum("n").alias("shingles"), *more)


def _fits() -> Column:
    return (F.col("m") <= LEAF) & (F.col("shingles") <= LEAF_SHINGLES)


def group_links(sets: DataFrame, scratch: Scratch, percent: int = PERCENT, rounds: int = ROUNDS) -> DataFrame:
    """Links that connect the sets of each group as all links do: (cell, key, n, set) to (a, b). See the notes above."""
    delta = 1 - percent / 100 + 1e-12
    edge = "a binary, b binary"
    found: list[DataFrame] = []
    cells = sets
    for number in range(rounds + 1):
        sizes = scratch.keep(_sized(cells).where("m > 1"), "sizes")
        small = cells.join(sizes.where(_fits()), "cell").select("cell", "key", "set")
        found.append(scratch.keep(small.groupBy("cell").applyInPandas(_local_links(percent), edge), "links"))
        large = sizes.where(~_fits())
        if large.isEmpty():
            break
        cells = scratch.keep(cells.join(large, "cell").withColumn(
            "chunk", F.pmod(F.xxhash64("key"), F.ceil(F.greatest(F.col("m") / CHUNK, F.col("shingles") / LEAF_SHINGLES)))), "cells")
        if number == rounds:
            found.append(scratch.keep(_block_links(cells, components(_all(found), scratch), percent), "links"))
            break

        # The middle of each cell, from about 64 drawn sets; the sets nearest to it are the best pivots.
        drawn = cells.where((F.xxhash64("key", F.lit(number)) / 2.0**64 + 0.5) * F.col("m") < 64)
        middle = scratch.keep(drawn.groupBy("cell").applyInPandas(_consensus, "cell long, key binary, set binary"), "middle")
        reach = _distances(cells, middle, percent).select("cell", "key", F.coalesce(F.col("d")[0], F.lit(1.0)).alias("d0"))
        labels = components(_all(found), scratch)
        known = scratch.keep(
            cells.select("cell", "key", "n", "chunk").join(reach, ["cell", "key"]).join(labels.withColumnRenamed("node", "key"), "key", "left")
            .withColumn("label", F.coalesce("label", "key")), "known")
        # Pivots from small components first, so that sets still apart are settled; each map task keeps its first few of a cell.
        common = known.groupBy("cell", "label").agg(F.count(F.lit(1)).alias("alike"))
        best = Window.partitionBy("cell").orderBy("alike", "d0", "key")
        pivots = known.join(common, ["cell", "label"]).select("cell", "key", "alike", "d0").withColumn("k", F.row_number().over(best))
        pivots = scratch.keep(pivots.where(F.col("k") <= PIVOTS).join(cells.select("cell", "key", "set"), ["cell", "key"]).select("cell", "key", "set"), "pivots")
        seen = scratch.keep(_distances(cells, pivots, percent), "seen")
        found.append(scratch.keep(seen.select(F.col("key").alias("a"), F.explode("links").alias("b")), "links"))

        # A pivot knows all its links now and need not go on. The others go to their cell and, by the window, to neighbouring ones.
        labels = components(_all(found), scratch)
        homes = seen.join(pivots.select("cell", "key"), ["cell", "key"], "left_anti").select(
            "cell", "key", F.posexplode(F.transform("d", lambda x: x <= F.array_min("d") + 2 * delta)).alias("j", "near")).where("near")
        homes = scratch.keep(
            homes.join(labels.withColumnRenamed("node", "key"), "key", "left")
            .select("cell", "key", F.xxhash64("cell", "j", F.lit(number)).alias("inner"), F.coalesce("label", "key").alias("label")), "homes")
        inner = homes.groupBy("cell", "inner").agg(
            F.count(F.lit(1)).alias("size"), F.min("label").alias("lo"), F.max("label").alias("hi"))
        parents = inner.groupBy("cell").agg(F.sum("size").alias("total"), F.max("size").alias("largest"))
        fate = inner.join(parents, "cell").join(large.select("cell", "m"), "cell").select(
            "cell", "inner", ((F.col("total") <= 2 * F.col("m")) & (F.col("largest") < F.col("m") - PIVOTS)).alias("split"), (F.col("lo") != F.col("hi")).alias("open"))
        placed = homes.join(fate.where("open"), ["cell", "inner"]).select(
            "cell", "key", F.when(F.col("split"), F.col("inner")).otherwise(F.col("cell")).alias("to")).distinct()
        cells = scratch.keep(placed.join(cells.select("cell", "key", "n", "set"), ["cell", "key"]).select(
            F.col("to").alias("cell"), "key", "n", "set"), "cells")
    return _all(found)


def _all(links: list[DataFrame]) -> DataFrame:
    out = links[0]
    for more in links[1:]:
        out = out.union(more)
    return out


def _block_links(cells: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """Links between sets outside the largest component of their cell and all sets of the cell.

    Sets of one component need no comparison, so these are all that can join components. Blocks are of bounded size, and each pair of blocks is a task.
    """
    named = cells.join(labels.withColumnRenamed("node", "key"), "key", "left").withColumn("label", F.coalesce("label", "key"))
    largest = named.groupBy("cell", "label").agg(F.count(F.lit(1)).alias("alike")).groupBy("cell").agg(F.max_by("label", "alike").alias("most"))
    named = named.join(largest, "cell").withColumn("apart", F.col("label") != F.col("most"))
    blocks = named.select("cell", "chunk", "apart").distinct()
    apart = blocks.where("apart").select("cell", F.col("chunk").alias("i"))
    tasks = blocks.select("cell", "chunk").distinct().join(apart, "cell")
    rows = cells.select("cell", "chunk", "key", "set")
    first = rows.join(tasks, ["cell", "chunk"]).select("cell", "chunk", "i", "key", "set")
    second = named.where("apart").select("cell", F.col("chunk").alias("i"), "key", "set").join(tasks, ["cell", "i"]).select("cell", "chunk", "i", "key", "set")
    return first.union(second).groupBy("cell", "chunk", "i").applyInPandas(_local_links(percent), "a binary, b binary")


def profile(shingles: np.ndarray) -> np.ndarray:
    """Shingles counted by hash, about eight to a counter; their number is a power of two, so a longer profile folds to a shorter one.

    Empty if a counter overflows, which excludes nothing.
    """
    width = min(PROFILE_MOST, max(PROFILE, 1 << (len(shingles) // 8).bit_length()))
    counts = np.bincount((shingles % np.uint64(width)).astype(np.int64), minlength=width)
    return counts.astype(np.uint16) if counts.max(initial=0) < 1 << 16 else np.empty(0, np.uint16)


def possible_links(nodes: np.ndarray, sizes: np.ndarray, profiles: list[np.ndarray], percent: int = PERCENT) -> list[tuple[int, int]]:
    """Pairs (positions) of sets of one region whose sizes and profiles leave a link possible; of these, enough to connect what all would.

    An empty profile excludes nothing.
    """
    order = np.argsort(sizes, kind="stable")
    widths = np.array([len(p) for p in profiles])
    folded: dict[int, np.ndarray] = {}
    group, found = np.arange(len(nodes)), []
    for at, i in enumerate(order[:-1]):
        later = order[at + 1:]
        later = later[: np.searchsorted(percent * sizes[later], 100 * sizes[i], side="right")]
        later = later[group[later] != group[i]]
        if (w := widths[i]) and len(later):
            if w not in folded:
                folded[w] = np.array([p.reshape(-1, w).sum(axis=0) if len(p) >= w else np.zeros(w, np.uint64) for p in profiles], np.uint32)
            most = np.minimum(folded[w][i], folded[w][later]).sum(axis=1, dtype=np.int64)
            later = later[(most * (100 + percent) >= percent * (sizes[i] + sizes[later])) | (widths[later] < w)]
        joined = np.unique(group[later], return_index=True)
        found += [(i, later[k]) for k in joined[1]]
        group[np.isin(group, joined[0])] = group[i]
    return found


def _region_pairs(percent: int):
    """Possible links in the regions of a partition; rows come sorted by region."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            rest = pa.Table.from_batches([batch] if rest is None else [*rest.to_batches(), batch])
            anchors = rest.column("anchor").to_numpy()
            whole_regions = np.searchsorted(anchors, anchors[-1]) if len(anchors) else 0
            yield pairs(rest.slice(0, whole_regions))
            rest = rest.slice(whole_regions)
        if rest is not None:
            yield pairs(rest)

    def pairs(rows: pa.Table) -> pa.RecordBatch:
        anchors, nodes, sizes = (rows.column(c).to_numpy() for c in ("anchor", "node", "n"))
        profiles = [np.frombuffer(p or b"", np.uint16) for p in rows.column("profile").to_pylist()]
        edges = np.flatnonzero(np.diff(anchors, prepend=anchors[:1] - 1 if len(anchors) else 0, append=anchors[-1:] + 1 if len(anchors) else 0))
        found = np.array([
            (nodes[start + i], nodes[start + j]) for start, end in zip(edges[:-1], edges[1:], strict=True)
            for i, j in possible_links(nodes[start:end], sizes[start:end], profiles[start:end], percent)
        ], np.int64).reshape(-1, 2)
        return pa.record_batch([pa.array(found[:, 0]), pa.array(found[:, 1])], names=["a", "b"])

    return run


def _place(key: bytes, doc_id: int | None) -> int:
    return zlib.crc32(key + (b"" if doc_id is None else str(doc_id).encode())) % FILTER_BITS


def _sieve(places: DataFrame) -> bytes:
    """A byte for each of FILTER_BITS places, 1 for those in the column ``at``. Other rows may share a place, so a join must follow."""
    filled = places.selectExpr("CAST(at DIV 32 AS INT) AS i", "SHIFTLEFT(1, CAST(at % 32 AS INT)) AS bit").groupBy("i").agg(
        F.bit_or("bit").alias("bits")).collect()
    wanted = np.zeros(FILTER_BITS // 32, np.uint32)
    for r in filled:  # at most FILTER_BITS / 32 rows
        wanted[r["i"]] = r["bits"] & 0xFFFFFFFF
    return np.unpackbits(wanted.view(np.uint8), bitorder="little").tobytes()


def _key(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def anchor_order(docs: DataFrame, text_col: str, words: int) -> tuple[bytes, bytes]:
    """Common shingles (sorted) and their counts in a bounded sample of documents, as bytes of arrays."""
    n = max(1, docs.count())
    drawn = docs.where(F.xxhash64(F.col(text_col)) / 2.0**64 + 0.5 < ORDER_DOCS / n).select(whole(F.col(text_col)).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text in batch.column(0):
                yield pa.record_batch([pa.array(shingle_set(text.as_py(), words).view(np.int64))], names=["h"])

    counts = (
        drawn.distinct().mapInArrow(run, "h long").groupBy("h").count().where(F.col("count") >= COMMON)
        .orderBy(F.desc("count"), "h").limit(COMMON_MOST).toPandas()
    )
    h, c = counts["h"].to_numpy(np.int64).view(np.uint64), counts["count"].to_numpy(np.int64)
    order = np.argsort(h)
    return h[order].tobytes(), c[order].tobytes()


def regions_of(placed: DataFrame) -> DataFrame:
    """Regions of anchors with two sets or more, and their rows ``m``; of regions with the same sets the first anchor is enough.

    Exact copies have the same anchors, so a set has as many rows in each of its regions. Sums of both halves of its hash over the
    rows therefore tell regions apart; unlike exclusive ors, they do not cancel where a set comes an even number of times.
    """
    regions = placed.groupBy("anchor").agg(
        F.min("node").alias("a"), F.max("node").alias("b"), F.sum(F.shiftright("node", 32)).alias("high"),
        F.sum(F.col("node").bitwiseAND(0xFFFFFFFF)).alias("low"), F.count(F.lit(1)).alias("m")).where("a <> b")
    return regions.groupBy("a", "b", "high", "low", "m").agg(F.min("anchor").alias("anchor"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT,
                    keep: list[str] | None = None) -> DataFrame:
    """Components of documents whose sets of word shingles have a Jaccard similarity of at least ``percent`` / 100.

    Returns one row per row of ``docs``: doc_id, n_shingles and component_id, the smallest identifier that links reach. Links
    are exact. Null and empty texts and texts of white space have no shingles and stand alone. Rows with equal sets are one set
    in the join. Null identifiers are carried; a component of these alone has a null component_id. No rows give no rows. Other columns are not read.

    With ``keep``, two more columns: ``row`` (a struct of these columns of ``docs``) and ``stays``, true for one row of each component: the
    one with the smallest identifier (null last), and of equal ones the first written.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "jaccard")
    order = spark.sparkContext.broadcast(anchor_order(docs, text_col, words))  # at most COMMON_MOST numbers twice

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common, counts = np.frombuffer(order.value[0], np.uint64), np.frombuffer(order.value[1], np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                piece = batch.slice(at, 500)
                sets = [shingle_set(t.as_py(), words) for t in piece.column(1)]
                yield pa.record_batch([
                    piece.column(0), *piece.columns[2:], pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([_key(s) if len(s) else None for s in sets], pa.binary()),
                    pa.array([anchors_of(s, common, counts, percent).view(np.int64) for s in sets], pa.list_(pa.int64())),
                    pa.array([profile(s).tobytes() for s in sets], pa.binary()),
                ], names=["doc_id", *(["row"] if keep else []), "n", "key", "anchors", "profile"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), whole(F.col(text_col)).alias("text"))
    carried = docs.select(*(F.col(f"`{c}`") for c in keep)).schema.simpleString() if keep else ""
    schema = f"doc_id long, {f'row {carried}, ' if keep else ''}n long, key binary, anchors array<long>, profile binary"
    wide = docs.select(F.col(id_col).cast("long").alias("doc_id"), whole(F.col(text_col)).alias("text"),
                       *([F.struct(*(F.col(f"`{c}`") for c in keep)).alias("row")] if keep else []))
    described = wide.mapInArrow(describe, schema).withColumn("node", F.xxhash64("key")).withColumn("at", F.monotonically_increasing_id())
    described = scratch.keep(described, "described")

    shown = described.where("n > 0")
    placed = shown.select("node", "n", F.explode("anchors").alias("anchor"))
    regions = scratch.keep(regions_of(placed), "regions")
    met = spark.sparkContext.broadcast(_sieve(regions.select(F.pmod("anchor", F.lit(FILTER_BITS)).alias("at"))))

    def in_regions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The anchors that pass the filter, each in a row."""
        passes = np.frombuffer(met.value, np.uint8)
        for batch in batches:
            lists = batch.column(2)
            anchors, owner = lists.flatten().to_numpy(), np.repeat(np.arange(batch.num_rows), pa.compute.list_value_length(lists).to_numpy())
            take = np.flatnonzero(passes[anchors % FILTER_BITS])
            yield pa.record_batch([batch.column(0).take(pa.array(owner[take])), batch.column(1).take(pa.array(owner[take])), pa.array(anchors[take])],
                                  names=["node", "n", "anchor"])

    few = shown.select("node", "n", "anchors").mapInArrow(in_regions, "node long, n long, anchor long")
    inside = scratch.keep(few.join(regions.select("anchor", "m"), "anchor").distinct(), "inside")
    nodes = shown.groupBy("node").agg(F.when(F.min("key") == F.max("key"), F.first("profile")).alias("profile"))
    small = inside.where(F.col("m") <= REGION).join(nodes, "node").select("anchor", "node", "n", "profile")
    tried = small.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(_region_pairs(percent), "a long, b long")
    by_size = inside.where(F.col("m") > REGION).groupBy("anchor", "n").agg(F.min("node").alias("a"))
    alike = inside.join(by_size, ["anchor", "n"]).select("a", F.col("node").alias("b"))
    smaller = Window.partitionBy("anchor").orderBy("n")
    chained = by_size.withColumn("b", F.lag("a").over(smaller)).withColumn("before", F.lag("n").over(smaller)).where(
        100 * F.col("before") >= percent * F.col("n")).select("a", "b")
    touching = scratch.keep(tried.union(alike).union(chained).where("a <> b").distinct(), "touching")
    scratch.drop(inside)
    groups = components(touching, scratch)

    # Sets of the documents in groups, one document per set. Texts are read again; a filter of fixed size lets these pass, and few others.
    members = shown.join(groups, "node").groupBy("key").agg(F.min("doc_id").alias("id"), F.first("label").alias("cell"), F.first("n").alias("n"))
    members = scratch.keep(members, "members")
    at = F.pmod(F.crc32(F.concat("key", F.coalesce(F.col("id").cast("string"), F.lit("")).cast("binary"))), F.lit(FILTER_BITS))
    sieve = spark.sparkContext.broadcast(_sieve(members.select(at.alias("at"))))

    def sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 500):
                found = []
                for i, t in zip(*(c.to_pylist() for c in batch.slice(begin, 500).columns), strict=True):
                    s = shingle_set(t, words)
                    if len(s) and sieve.value[_place(k := _key(s), i)]:
                        found.append((k, s.tobytes()))
                yield pa.record_batch([pa.array([k for k, _ in found], pa.binary()), pa.array([s for _, s in found], pa.binary())], names=["key", "set"])

    sets = scratch.keep(rows.mapInArrow(sets_of, "key binary, set binary").join(members, "key").select("cell", "key", "n", "set"), "sets")
    labels = components(group_links(sets, scratch, percent), scratch)

    rest = ["row", "at"] if keep else []
    named = described.select("doc_id", "n", "key", *rest).join(labels.withColumnRenamed("node", "key"), "key", "left").withColumn(
        "label", F.coalesce("label", "key"))
    first = F.struct(F.col("doc_id").isNull(), "doc_id", *rest[1:])
    smallest = named.where("label IS NOT NULL").groupBy("label").agg(F.min("doc_id").alias("first_id"), F.min(first).alias("first"))
    out = named.join(scratch.keep(smallest, "smallest"), "label", "left")
    more = [F.col("row"), (F.col("label").isNull() | (F.col("first.at") == F.col("at"))).alias("stays")] if keep else []
    return out.select("doc_id", F.col("n").alias("n_shingles"),
                      F.when(F.col("label").isNull(), F.col("doc_id")).otherwise(F.col("first_id")).alias("component_id"), *more)

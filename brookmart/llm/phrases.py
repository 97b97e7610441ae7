"""Phrases of words that stand together more often than their parts would, by weighted acyclic automata.

A state of the automaton is a phrase, an arc leads to the phrase one word longer, and its weight is how often that one
occurs. It grows by one level, that is one word, at a time:

* every shard (some megabytes of text in one language) sorts its phrases of the next length and builds their count
  transducer; a phrase is tried only where it is frequent without its last word and without its first, as no other can be;
* the transducers are cut into prefix ranges of about equal weight (of the first words' hashes, so that they are even); a
  task unites those of one range from all shards, sums the weights, and lets arcs below the wanted count go;
* it tells each shard which of its own arcs stayed, and the shard goes on from there.

An arc is named by the states of its phrase without the last and without the first word. So the counts of all first parts
lie on the way to a state, and those of all rests on the way along the second states: composing these gives every part.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import count
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from brookmart.llm.common import Scratch, importable, whole

#: Bytes of text in a shard, and occurrences in a prefix range. Both bound a task's memory and change no result.
SHARD_BYTES, RANGE_WEIGHT = 4 << 20, 1 << 20
#: Ranges of prefixes too frequent for one range have numbers from here on; state numbers are range << 24 | place.
OF_HOT = 1 << 38
#: Full stop, comma, semicolon, colon, exclamation and question mark, and the line ends, all become a line feed; a tab becomes a space.
BORDERS = bytes.maketrans(b".,;:!?\x0a\x0b\x0c\x0d\x09", b"\n" * 10 + b" ")
BREAK = 0

SHARD = "shard long, lang string, tokens long, words binary, counts binary, stream binary"
WORDS = "slot long, shard long, lang string, words binary, local binary, n binary"
SLICE = "slot long, shard long, p binary, s binary, n binary"
STATE = "shard long, at binary, arc binary, p binary, s binary, n binary, slot binary"
#: Rows of a united range: its states (without shard), and for each shard the arcs (a, b) that stayed, with their state, range and split as prefixes.
UNITED = "q long, p long, s long, n long, lang string, word string, shard long, level long, a binary, b binary, qs binary, slots binary, splits binary"


def _array(value: pa.Scalar, kind=np.int64) -> np.ndarray:
    return np.frombuffer(value.as_buffer(), kind)


def _batch(schema: str, *columns) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary(), "boolean": pa.bool_()}
    fields = [f.split() for f in schema.split(", ")]
    return pa.record_batch([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields, strict=True)], names=[n for n, _ in fields])


def _part() -> int:
    from pyspark import TaskContext

    return TaskContext.get().partitionId()


# ---- shards ------------------------------------------------------------------------------------

def shard_row(shard: int, lang: str, texts: list[bytes]) -> pa.RecordBatch:
    """The words of some texts as numbers in the order of their first occurrence from 1 on; 0 is a border of pieces."""
    words = b"\n".join(texts).lower().translate(BORDERS).replace(b"\n", b" \n ").split(b" ")
    numbers: defaultdict[bytes, int] = defaultdict(count(2).__next__)
    numbers[b"\n"], numbers[b""] = BREAK, 1
    stream = np.fromiter(map(numbers.__getitem__, words), np.int32, len(words))
    stream = stream[stream != 1]
    stream -= stream > 1
    del numbers[b"\n"], numbers[b""]
    counts = np.bincount(stream, minlength=len(numbers) + 1)[1:].astype(np.int32)
    return _batch(SHARD, [shard], [lang], [int(counts.sum())], [b"\n".join(numbers)], [counts.tobytes()], [stream.tobytes()])


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts are gathered by language; the fullest gathering becomes a shard whenever all together pass a bound."""
    waiting: dict[str, list[bytes]] = {}
    sizes: dict[str, int] = {}
    total, number = 0, _part() << 32

    def close(lang: str) -> pa.RecordBatch:
        nonlocal total, number
        total -= sizes.pop(lang)
        number += 1
        return shard_row(number, lang, waiting.pop(lang))

    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            raw = text.as_buffer().to_pybytes()
            waiting.setdefault(lang, []).append(raw)
            sizes[lang] = sizes.get(lang, 0) + len(raw)
            total += len(raw)
            if sizes[lang] >= SHARD_BYTES:
                yield close(lang)
            elif total >= 4 * SHARD_BYTES:
                yield close(max(sizes, key=sizes.__getitem__))
    for lang in list(waiting):
        yield close(lang)


def _words(ranges: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The words of a shard, a row for each range of their hashes."""
        for batch in batches:
            for shard, lang, words, counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if not counts:
                    continue
                n, seed, words = np.frombuffer(counts, np.int32), crc32(lang.encode()), words.split(b"\n")
                slot = np.array([crc32(w, seed) for w in words], np.int64) * ranges >> 32
                order = np.argsort(slot, kind="stable")
                cuts = np.flatnonzero(np.diff(slot[order], prepend=-1))
                pieces = np.split(order, cuts[1:])
                yield _batch(WORDS, slot[order][cuts], [shard] * len(cuts), [lang] * len(cuts), [b"\n".join([words[i] for i in x.tolist()]) for x in pieces],
                             [(x + 1).tobytes() for x in pieces], [n[x].astype(np.int64).tobytes() for x in pieces])

    return run


# ---- count transducers of one level ------------------------------------------------------------

def salted(label: np.ndarray, split: np.ndarray) -> np.ndarray:
    """Which of ``split`` parts a label falls in: a prefix too frequent for one range is cut by its next words."""
    mixed = (label.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
    return (mixed % split.astype(np.uint64)).astype(np.int64)


def find_arcs(p: np.ndarray, s: np.ndarray, kept_p: np.ndarray, kept_s: np.ndarray) -> np.ndarray:
    """The place of each arc among the distinct kept ones, or -1."""
    if not len(kept_p):
        return np.full(len(p), -1)
    up, us = np.unique(kept_p), np.unique(kept_s)

    def key(a, b):
        i, j = np.minimum(np.searchsorted(up, a), len(up) - 1), np.minimum(np.searchsorted(us, b), len(us) - 1)
        return np.where((up[i] == a) & (us[j] == b), i * len(us) + j, -1)

    kept = key(kept_p, kept_s)
    order = np.argsort(kept)
    wanted = key(p, s)
    at = np.minimum(np.searchsorted(kept[order], wanted), len(kept) - 1)
    return np.where(kept[order][at] == wanted, order[at], -1)


class Level:
    """A shard's phrases of one length: where they begin, and their count transducer as sorted arcs (p, s) with weights n."""

    def __init__(self, at: np.ndarray, state: np.ndarray, q: np.ndarray, slot: np.ndarray, split: np.ndarray):
        """From the frequent phrases one word shorter: the places where they begin, in order, and their numbers in ``q``, ``slot`` and ``split``."""
        next_to = at[1:] == at[:-1] + 1
        self.at = at[:-1][next_to]
        arcs, self.arc, self.n = np.unique(state[:-1][next_to].astype(np.int64) * len(q) + state[1:][next_to], return_inverse=True, return_counts=True)
        i, j = np.divmod(arcs, max(len(q), 1))
        self.p, self.s = q[i], q[j]
        self.slot = slot[i] + salted(self.s, split[i])

    def go_on(self, kept_p: np.ndarray, kept_s: np.ndarray, *of_kept: np.ndarray) -> Level:
        return _go_on(self.at, self.arc, self.p, self.s, kept_p, kept_s, *of_kept)

    def row(self, shard: int) -> pa.RecordBatch:
        parts = (self.at.astype(np.int32), self.arc.astype(np.int32), self.p, self.s, self.n.astype(np.int64), self.slot)
        return _batch(STATE, [shard], *([x.tobytes()] for x in parts))


def _go_on(at, arc, p, s, kept_p, kept_s, *of_kept) -> Level:
    state = find_arcs(p, s, kept_p, kept_s)[arc]
    lives = state >= 0
    return Level(at[lives], state[lives], *of_kept)


def slices(shard: int, p: np.ndarray, s: np.ndarray, n: np.ndarray, slot: np.ndarray) -> pa.RecordBatch:
    """A shard's transducer, cut by prefix ranges: a row for each range."""
    order = np.lexsort((s, p, slot))
    p, s, n, slot = p[order], s[order], n[order].astype(np.int64), slot[order]
    cuts = np.flatnonzero(np.diff(slot, prepend=-1))
    ends = [*cuts[1:].tolist(), len(slot)]
    pieces = [(p[a:b].tobytes(), s[a:b].tobytes(), n[a:b].tobytes()) for a, b in zip(cuts.tolist(), ends)]
    return _batch(SLICE, slot[cuts], np.full(len(cuts), shard), *zip(*pieces)) if pieces else _batch(SLICE, *[[]] * 5)


def _prefixes(q: np.ndarray, n: np.ndarray, slot: int) -> tuple[np.ndarray, np.ndarray]:
    """Ranges of the longer phrases that begin with the states q. They weigh no more than these, so they stay in their range, unless one is too frequent."""
    split = 1 + n // RANGE_WEIGHT
    own = OF_HOT + salted(q, np.full(len(q), OF_HOT // 2))
    return np.where(split > 1, own, slot), split


def _united(states: list, feeds: list) -> pa.Table:
    return pa.Table.from_batches([_batch(UNITED, *zip(*(x + (None,) * 7 for x in states), *((None,) * 6 + x for x in feeds)))
                                  if states else _batch(UNITED, *[[]] * 13)])


def _unite_words(least: int):
    def run(group: pa.Table) -> pa.Table:
        """The frequent words of one range, and which of them each shard has."""
        sums: dict[str, Counter] = defaultdict(Counter)
        slot = group.column("slot")[0].as_py()
        shards = [(r["shard"], r["lang"], r["words"].split(b"\n"), np.frombuffer(r["local"], np.int64), np.frombuffer(r["n"], np.int64)) for r in group.to_pylist()]
        for _, lang, words, _, n in shards:
            sum_of = sums[lang]
            for w, k in zip(words, n.tolist(), strict=True):
                sum_of[w] += k
        kept = sorted((lang, w) for lang, sum_of in sums.items() for w, k in sum_of.items() if k >= least)
        place = {x: i for i, x in enumerate(kept)}
        q = np.arange(len(kept)) + (slot << 24)
        n = np.array([sums[lang][w] for lang, w in kept], np.int64)
        slots, splits = _prefixes(q, n, slot)
        states = [(a, None, None, b, lang, w.decode()) for a, b, (lang, w) in zip(q.tolist(), n.tolist(), kept, strict=True)]
        feeds = []
        for shard, lang, words, local, _ in shards:
            at = np.array([place.get((lang, w), -1) for w in words], np.int64)
            has, at = at >= 0, at[at >= 0]
            if len(at):
                feeds.append((shard, 1, *(x.tobytes() for x in (local[has], at * 0, q[at], slots[at], splits[at]))))
        return _united(states, feeds)

    return run


def unite(slot: int, level: int, shards: list[int], p: list[np.ndarray], s: list[np.ndarray], n: list[np.ndarray], least: int) -> pa.Table:
    """The union of transducers of one prefix range: weights summed, arcs below ``least`` dropped, the others numbered; and which of them each shard has."""
    owner = np.repeat(np.arange(len(shards)), [len(x) for x in p])
    p, s, n = np.concatenate(p), np.concatenate(s), np.concatenate(n)
    order = np.lexsort((s, p))
    p, s, n, owner = p[order], s[order], n[order], owner[order]
    new = np.concatenate([[True], (p[1:] != p[:-1]) | (s[1:] != s[:-1])])
    first, run = np.flatnonzero(new), np.cumsum(new) - 1
    sums = np.add.reduceat(n, first)
    kept = np.flatnonzero(sums >= least)
    p, s, n, q = p[first][kept], s[first][kept], sums[kept], np.arange(len(kept)) + (slot << 24)
    slots, splits = _prefixes(q, n, slot)
    states = [(*x, None, None) for x in zip(*(x.tolist() for x in (q, p, s, n)), strict=True)]
    place = np.full(len(first), -1)
    place[kept] = np.arange(len(kept))
    at = place[run]
    owner, at = owner[at >= 0], at[at >= 0]
    order = np.argsort(owner, kind="stable")
    owner, at = owner[order], at[order]
    cuts = np.flatnonzero(np.diff(owner, prepend=-1))
    feeds = [(shards[owner[c]], level, *(x[own].tobytes() for x in (p, s, q, slots, splits))) for c, own in zip(cuts, np.split(at, cuts[1:]))]
    return _united(states, feeds)


def _unite(level: int, least: int):
    def run(group: pa.Table) -> pa.Table:
        arrays = [[_array(x) for x in group.column(name)] for name in ("p", "s", "n")]
        return unite(group.column("slot")[0].as_py(), level, group.column("shard").to_pylist(), *arrays, least)

    return run


# ---- steps of a shard --------------------------------------------------------------------------

def _fed(feed: pa.Table, level: int) -> list[np.ndarray]:
    """The kept arcs (a, b) of a shard, and their numbers, ranges and splits."""
    mine = feed.filter(pa.compute.equal(feed.column("level"), level))
    return [np.concatenate([np.empty(0, np.int64), *map(_array, mine.column(c))]) for c in ("a", "b", "qs", "slots", "splits")]


def _pairs(shard: pa.Table, feed: pa.Table) -> Level:
    stream = _array(shard.column("stream")[0], np.int32)
    local, _, q, slot, split = _fed(feed, 1)
    number = np.full(int(stream.max(initial=0)) + 1, -1, np.int64)
    number[local] = np.arange(len(local))
    state = number[stream]
    at = np.flatnonzero(state >= 0)
    return Level(at, state[at], q, slot, split)


def _second(key, shard: pa.Table, feed: pa.Table) -> pa.Table:
    if not shard.num_rows or not feed.num_rows:
        return pa.Table.from_batches([_batch(SLICE, *[[]] * 5)])
    two = _pairs(shard, feed)
    return pa.Table.from_batches([slices(key[0].as_py(), two.p, two.s, two.n, two.slot)])


def _third(key, shard: pa.Table, feed: pa.Table) -> pa.Table:
    if not shard.num_rows or not feed.num_rows:
        return pa.Table.from_batches([_batch(STATE, *[[]] * 7)])
    return pa.Table.from_batches([_pairs(shard, feed).go_on(*_fed(feed, 2)).row(key[0].as_py())])


def _later(level: int):
    def run(key, before: pa.Table, feed: pa.Table) -> pa.Table:
        if not before.num_rows or not feed.num_rows:
            return pa.Table.from_batches([_batch(STATE, *[[]] * 7)])
        at, arc = (_array(before.column(c)[0], np.int32) for c in ("at", "arc"))
        p, s = (_array(before.column(c)[0]) for c in ("p", "s"))
        return pa.Table.from_batches([_go_on(at, arc, p, s, *_fed(feed, level)).row(key[0].as_py())])

    return run


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for shard, *arrays in zip(*batch.columns, strict=True):
            yield slices(shard.as_py(), *map(_array, arrays))


# ---- the operator ------------------------------------------------------------------------------

class _Automaton:
    """The united automaton, level by level, as written tables."""

    def __init__(self, docs: DataFrame, text_col: str, lang_col: str, least: int, longest: int):
        self.scratch = Scratch(docs.sparkSession, "phrases")
        keep, self.least = self.scratch.keep, least
        lang = F.coalesce(F.col(lang_col).cast("string"), F.lit("und"))
        texts = docs.select(lang.alias("lang"), whole(F.col(text_col).cast("string")).cast("binary").alias("text"))
        shards = keep(texts.mapInArrow(_shards, SHARD), "shards")
        self.totals = keep(shards.groupBy("lang").agg(F.sum("tokens").alias("total")), "totals")
        ranges = 1 + (self.totals.agg(F.sum("total")).first()[0] or 0) // RANGE_WEIGHT
        cut = shards.select("shard", "lang", "words", "counts").mapInArrow(_words(ranges), WORDS)
        united = keep(cut.groupBy("slot").applyInArrow(_unite_words(least), UNITED), "united")
        none = F.array().cast("array<bigint>")
        #: By length: q, lang, phrase, its last word, count, and the counts of first parts and rests, by cut.
        self.levels = [united.where("shard IS NULL").select("q", "lang", F.col("word").alias("phrase"), F.col("word").alias("last"), "n", none.alias("ls"), none.alias("rs"))]
        feed, state = self._feed(united), shards.select("shard", "stream")
        for length in range(2, longest + 1):
            step = {2: _second, 3: _third}.get(length, _later(length - 1))
            both = state.groupBy("shard").cogroup(feed.groupBy("shard"))
            if length == 2:
                cut = both.applyInArrow(step, SLICE)
            else:
                state = keep(both.applyInArrow(step, STATE), "state")
                cut = state.select("shard", "p", "s", "n", "slot").mapInArrow(_slices, SLICE)
            united = keep(cut.groupBy("slot").applyInArrow(_unite(length, least), UNITED), "united")
            arcs = united.where("shard IS NULL").select("q", "p", "s", "n")
            if arcs.isEmpty():
                break
            self.levels.append(keep(self._compose(arcs), f"length-{length}"))
            feed = self._feed(united).unionByName(feed) if length == 2 else self._feed(united)

    @staticmethod
    def _feed(united: DataFrame) -> DataFrame:
        return united.where("shard IS NOT NULL").select("shard", "level", "a", "b", "qs", "slots", "splits")

    def _compose(self, arcs: DataFrame) -> DataFrame:
        """What the states of a new level are, from the two states one word shorter that each is made of."""
        shorter = self.levels[-1]
        front = shorter.select(F.col("q").alias("p"), "lang", F.col("phrase").alias("front"), F.col("n").alias("l"), "ls")
        rest = shorter.select(F.col("q").alias("s"), "last", F.col("n").alias("r"), "rs")
        return arcs.join(front, "p").join(rest, "s").select(
            "q", "p", "s", "lang", F.concat_ws(" ", "front", "last").alias("phrase"), "last", "n",
            F.concat("ls", F.array("l")).alias("ls"), F.concat(F.array("r"), "rs").alias("rs"))


def mine_phrases(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", longest: int = 5, least: int = 100, top: int = 2000) -> DataFrame:
    """The best phrases of 2 to ``longest`` words of each language: lang, rank, phrase, a, l, r, n, score.

    Words are split and counted in the lower case of A to Z, within pieces between marks and line ends. A phrase needs ``least``
    occurrences (a); n counts all words of its language, and the cut with the least floor(1000 a n / (l r)) gives its parts' counts l and
    r and its score; of equal ones the cut after the fewest words. Phrases that never stand outside one longer phrase with ``least`` occurrences go.
    ``top`` is the length of the report for each language, ordered by score, a (both falling) and phrase (by bytes).

    Null languages are ``und``; null and empty texts count no words, repeated rows count each. A very long text is a shard of its own, so a
    task holds the words of one text or SHARD_BYTES. An empty table gives no rows. Other columns are not read. Counts and scores are exact: no
    hashes stand for words, and scores are computed in decimals of 38 digits.
    """
    importable(docs.sparkSession)
    automaton = _Automaton(docs, text_col, lang_col, least, longest)
    left = None
    for level, longer in zip(automaton.levels[1:], [*automaton.levels[2:], None]):
        if longer is not None:  # a phrase within one two words longer is within one between them, of the same count
            always = longer.select(F.col("p").alias("q"), "n").union(longer.select(F.col("s").alias("q"), "n"))
            level = level.join(always, ["q", "n"], "left_anti")
        level = level.select("lang", "phrase", F.col("n").alias("a"), "ls", "rs")
        left = level if left is None else left.unionByName(level)
    if left is None:
        left = automaton.levels[0].where("false").select("lang", "phrase", F.col("n").alias("a"), "ls", "rs")
    cuts = """array_min(transform(arrays_zip(ls, rs), (x, k) -> named_struct(
        'score', (cast(1000 as decimal(4, 0)) * cast(a as decimal(15, 0)) * cast(total as decimal(17, 0))) div (cast(x.ls as decimal(19, 0)) * cast(x.rs as decimal(19, 0))),
        'k', k, 'l', x.ls, 'r', x.rs)))"""
    scored = left.join(automaton.totals, "lang").select("lang", "phrase", "a", F.col("total").alias("n"), F.expr(cuts).alias("cut"))
    best = Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), "phrase")
    ranked = scored.withColumn("rank", F.row_number().over(best).cast("long")).where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")

"""Find benchmark items in documents by latent semantic retrieval, then check word order and answers.

Items are cut into passages; a randomised SVD of their TF-IDF matrix (inverse document frequencies over all documents) gives a
latent space. Windows of every document are projected into it, and those near a passage by cosine are candidates. So are places that hold
the rarest words of a passage as closely as a leak must, which finds items far shorter than a window. A candidate is a leak
if the longest common subsequence with the item holds most of its words, or half of them together with its answer; of an item of
several passages also if it holds most of the words of one passage.
Items are taken in blocks of bounded size, each block against all documents.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import chain, pairwise, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brookmart.llm.common import Scratch, importable, in_worker, whole

#: ASCII characters other than letters and digits end a word, and so do spaces and general punctuation beyond ASCII.
_MARKS = bytes(c if c > 127 or chr(c).isalnum() else 32 for c in range(256))
_WIDE_MARKS = re.compile("[\u00a0-\u00bf\u2000-\u206f\u3000-\u303f]")
#: Words of a window, of its step, items of a block, dimensions of the latent space and its oversampling. Items have little in
#: common, so the space needs about as many dimensions as a block has passages: with a third of them a third of the leaks is missed.
WINDOW, STEP, BLOCK, RANK, MORE, SEED = 32, 16, 250, 512, 16, 5
#: Cosine of a candidate in the latent space; share of a window's TF-IDF mass that must be in the items' vocabulary; shares of an
#: item's words in order for a leak, and for one with the answer; fewest words for a fuzzy match.
NEAR, MASS, SHARE, SHARE_WITH_ANSWER, FEWEST = 0.55, 0.35, 0.7, 0.5, 8
#: Of a passage's rarest words, so many must stand within the region of a leak; up to half of FEWEST, any number finds the same.
RARE = 4
#: Words of the texts that are searched together.
GROUP = 1 << 15
LEAK = "item_id long, cosine double, share double, answer boolean, start_word int, end_word int"
_LEAK = pa.struct([("item_id", pa.int64()), ("cosine", pa.float64()), ("share", pa.float64()), ("answer", pa.bool_()),
                   ("start_word", pa.int32()), ("end_word", pa.int32())])


def words_of(text: str) -> list[bytes]:
    """Words in lower case without punctuation, in UTF-8."""
    if not text.isascii():
        text = _WIDE_MARKS.sub(" ", text)
    return text.lower().encode("utf-8", "surrogatepass").translate(_MARKS).split()


def answer_of(text: str) -> list[bytes]:
    """Words of the last sentence, what an item is taken to ask for when the benchmark names no answer."""
    parts = [p for p in map(words_of, re.split(r"(?<=[.!?])\s+", text.strip())) if p]
    return parts[-1] if parts else []


def passages_of(words: list[bytes]) -> list[list[bytes]]:
    """Overlapping passages of WINDOW words; a shorter item is one passage."""
    last = max(0, len(words) - WINDOW)
    return [words[s:s + WINDOW] for s in [*range(0, last, STEP), last]]


def common_subsequence(item: list[bytes], region: list[bytes]) -> int:
    """Length of the longest common subsequence, with the item's positions as the bits of one number."""
    where: dict[bytes, int] = {}
    for i, w in enumerate(item):
        where[w] = where.get(w, 0) | 1 << i
    full = (1 << len(item)) - 1
    row = full
    for w in region:
        if hit := row & where.get(w, 0):
            row = ((row + hit) | (row - hit)) & full
    return len(item) - row.bit_count()


def contains(region: list[bytes], part: list[bytes]) -> bool:
    return bool(part) and b" %s " % b" ".join(part) in b" %s " % b" ".join(region)


def shares(region: list, bag: Counter, least: float) -> bool:
    """Whether the region and the bag have so many words in common, repeats counted; few regions need the exact count."""
    hits = list(filter(bag.__contains__, region))
    if len(hits) < least:
        return False
    return len(set(hits)) >= least or sum(min(n, bag[w]) for w, n in Counter(hits).items()) >= least


def expand(first: np.ndarray, many: np.ndarray) -> np.ndarray:
    """The numbers of all ranges that begin at ``first`` and have ``many`` members, range by range."""
    ends = many.cumsum()
    return np.arange(many.sum()) + (first - ends + many).repeat(many)


class Rare:
    """Where texts may hold a share of one of some rows of words within one and a half times its length.

    Such a place holds at least RARE of the row's rarest words, counting as many of these as may be missing and RARE more.
    """

    def __init__(self, rows: list[list[int]], share: float, idf: np.ndarray):
        pairs = {(w, r) for r, ids in enumerate(rows)
                 for w in sorted(ids, key=lambda w: (-idf[w], w))[: len(ids) - int(np.ceil(share * len(ids) - 1e-9)) + RARE]}
        rare = np.array(sorted(pairs), np.int64).reshape(-1, 2)
        self.begin = np.searchsorted(rare[:, 0], np.arange(len(idf) + 2))
        self.many = np.diff(self.begin)
        self.rows = rare[:, 1].astype(np.uint16 if len(rows) <= 2**16 else np.int64)  # of 16 bits they are sorted faster
        self.spans = np.array([len(r) + len(r) // 2 for r in rows], np.int64)

    def __call__(self, ids: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows, and places, where RARE of a row's rarest words stand within its span, the first of them at the place.

        The words of several texts stand in ``ids``, and the numbers of their texts in ``text``; all must be of one text.
        """
        many = self.many[ids]
        at = many.nonzero()[0]
        if len(at) < RARE:
            return at[:0], at[:0]
        many = many[at]
        row = self.rows[expand(self.begin[ids[at]], many)]
        order = row.argsort(kind="stable")
        row, place = row[order], at.repeat(many)[order]
        hit = (row[RARE - 1:] == row[:len(row) - RARE + 1]).nonzero()[0]
        row, place, last = row[hit], place[hit], place[hit + RARE - 1]
        hit = (last - place < self.spans[row]) & (text[last] == text[place])
        return row[hit].astype(np.int64), place[hit]


class Index:
    """The latent space of one block of items and its passages."""

    def __init__(self, items: list[tuple[int, str, str | None]], df: dict[bytes, int], n_docs: int, basis: np.ndarray | None = None):
        self.items = [(i, words_of(t), words_of(a) if a else answer_of(t)) for i, t, a in items]
        self.vocabulary = vocabulary(items)
        self.idf = np.array([np.log((1 + n_docs) / (1 + df.get(w, 0))) + 1 for w in self.vocabulary], np.float32)
        self.unknown = float(np.median(self.idf)) if len(self.idf) else 1.0
        self.short = [k for k, (_, w, _) in enumerate(self.items) if 0 < len(w) < FEWEST]
        self.owner, rows = [], []
        for k, (_, words, _) in enumerate(self.items):
            if len(words) >= FEWEST:
                for p in passages_of(words):
                    self.owner.append(k)
                    rows.append([self.vocabulary[w] for w in p])
        self.passages = rows
        self.masses = np.append(self.idf, np.float32(self.unknown)) ** 2
        self.inside = np.append(self.masses[:-1], np.float32(0))
        self.bags = [Counter(words) for _, words, _ in self.items]
        self.passage_bags = [Counter(ids) for ids in rows]
        # A leak holds SHARE of the words of a passage ...
        self.close = Rare(rows, SHARE, self.idf)
        # ... or SHARE_WITH_ANSWER of those of the item, and the answer word for word, which is looked for at its rarest word, or by a
        # scan if it has words of its own.
        self.half = Rare([[self.vocabulary[w] for w in words] if len(words) >= FEWEST else [] for _, words, _ in self.items], SHARE_WITH_ANSWER, self.idf)
        asked, self.scanned = [], []
        for k, (_, words, answer) in enumerate(self.items):
            if len(words) >= FEWEST and answer:
                if all(w in self.vocabulary for w in answer):
                    i = max(range(len(answer)), key=lambda i: self.idf[self.vocabulary[answer[i]]])
                    asked.append((self.vocabulary[answer[i]], k, i))
                else:
                    self.scanned.append(k)
        self.asked = np.array(sorted(asked), np.int64).reshape(-1, 3)
        self.asked_from = np.searchsorted(self.asked[:, 0], np.arange(len(self.vocabulary) + 2))
        self.asks = np.diff(self.asked_from)
        if basis is not None:
            self.latent = (basis * self.idf[:, None]).astype(np.float32)
            q = np.array([self.latent[r].sum(axis=0) for r in rows], np.float32).reshape(len(rows), basis.shape[1])
            self.queries = q / np.maximum(np.linalg.norm(q, axis=1, keepdims=True), 1e-9)

    def numbers(self, words: Iterable[bytes], many: int) -> np.ndarray:
        """Places of the words in the vocabulary; one place behind it for all others."""
        return np.fromiter(map(self.vocabulary.get, words, repeat(len(self.vocabulary))), np.int32, many)

    def answered(self, ids: np.ndarray, text: np.ndarray, begin: np.ndarray, texts: list[list[bytes]]) -> Iterator[tuple[int, int, int]]:
        """(text, item, place) where the answer of an item stands word for word, near half of the item's words."""
        spans = self.half.spans
        item, place = self.half(ids, text)
        if not len(item):
            return
        # Places are told apart by stretches of the item's span; those with such a place and their neighbours count.
        stretches = int(np.diff(begin).max()) // FEWEST + 3
        stretch = lambda t, k, local: (t * len(self.items) + k) * stretches + local // spans[k] + 1
        t = text[place]
        near = np.unique(stretch(t, item, place - begin[t])[:, None] + (-1, 0, 1))
        at = self.asks[ids].nonzero()[0]
        many = self.asks[ids[at]]
        _, k, i = self.asked[expand(self.asked_from[ids[at]], many)].T
        t, at = text[at].repeat(many), at.repeat(many)
        local = at - i - begin[t]
        ok = (local >= 0) & np.isin(stretch(t, k, local), near)
        for x in zip(t[ok].tolist(), k[ok].tolist(), local[ok].tolist(), strict=True):
            answer = self.items[x[1]][2]
            if texts[x[0]][x[2]:x[2] + len(answer)] == answer:
                yield x
        if self.scanned:
            known = set(near.tolist())
            for t in np.unique(text[place]).tolist():
                joined = b" %s " % b" ".join(texts[t])
                for k in self.scanned:
                    part = b" %s " % b" ".join(self.items[k][2])
                    at = joined.find(part)
                    while at >= 0:
                        local = joined.count(b" ", 0, at + 1) - 1
                        if int(stretch(t, k, local)) in known:
                            yield t, k, local
                        at = joined.find(part, at + 1)

    def candidates(self, ids: np.ndarray, sizes: np.ndarray) -> list[dict[int, tuple[float, set[int]]]]:
        """For each text the items near one of its windows: the best cosine, and the starts of the windows."""
        none = len(self.vocabulary)
        found: list[dict[int, tuple[float, set[int]]]] = [{} for _ in sizes]
        steps = -(-sizes // STEP)
        text = np.arange(len(sizes)).repeat(steps)
        nth = expand(np.zeros_like(steps), steps)
        cuts = (sizes.cumsum() - sizes)[text] + nth * STEP
        many = np.diff(cuts, append=len(ids))
        # A window is a step and the one behind it, or the only step of its text.
        last = nth == steps[text] - 1
        window = (~last | (nth == 0)).nonzero()[0]
        pair = lambda x: np.where(last[window], x[window], x[window] + x[np.minimum(window + 1, len(cuts) - 1)])
        hopeful = window[pair(np.add.reduceat(self.inside[ids], cuts)) >= MASS * pair(np.add.reduceat(self.masses[ids], cuts))]
        for at in range(0, len(hopeful), 4096):
            some = hopeful[at:at + 4096]
            behind = np.where(last[some], some, some + 1)
            both = np.union1d(some, behind)
            near = ids[expand(cuts[both], many[both])]
            used = (near != none).nonzero()[0]
            step, first = np.unique(np.arange(len(both)).repeat(many[both])[used], return_index=True)
            sums = np.zeros((len(both), self.latent.shape[1]), np.float32)
            sums[step] = np.add.reduceat(self.latent[near[used]], first)
            x = sums[np.searchsorted(both, some)]
            two = (behind > some).nonzero()[0]
            x[two] += sums[np.searchsorted(both, behind[two])]
            cosine = (x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)) @ self.queries.T
            w, p = (cosine >= NEAR).nonzero()
            for t, start, passage, c in zip(text[some[w]].tolist(), (nth[some[w]] * STEP).tolist(), p.tolist(), cosine[w, p].tolist(), strict=True):
                k = self.owner[passage]
                best, starts = found[t].get(k, (0.0, set()))
                found[t][k] = max(best, c), starts | {start}
        return found

    def leaks(self, text: str) -> list[tuple]:
        return next(self.leaks_of([text]))

    def leaks_of(self, texts: Iterable[str]) -> Iterator[list[tuple]]:
        """The leaks of each text. Texts are taken together until they have GROUP words, as much of the work is short calls."""
        group, many = [], 0
        for t in texts:
            group.append(words_of(t))
            many += len(group[-1])
            if many >= GROUP:
                yield from self._leaks_of(group, many)
                group, many = [], 0
        yield from self._leaks_of(group, many)

    def _leaks_of(self, texts: list[list[bytes]], many: int) -> Iterator[list[tuple]]:
        if not many or not self.passages:
            yield from map(self._short, texts)
            return
        ids = self.numbers(chain.from_iterable(texts), many)
        sizes = np.array([len(w) for w in texts], np.int64)
        begin, text = np.append(0, sizes.cumsum()), np.arange(len(texts)).repeat(sizes)
        of = [ids[a:b] for a, b in pairwise(begin.tolist())]
        near = self.candidates(ids, sizes)
        best = [{k: self._check(words, k, starts) for k, (_, starts) in found.items()} for words, found in zip(texts, near, strict=True)]
        tried: list[set[tuple[int, int]]] = [set() for _ in texts]
        p, place = self.close(ids, text)
        t = text[place]
        for p, t, place in zip(p.tolist(), t.tolist(), (place - begin[t]).tolist(), strict=True):
            k = self.owner[p]
            hit = self._check_passage(of[t], texts[t], p, place, tried[t])
            if hit and (best[t].get(k) is None or hit[0] > best[t][k][0]):
                best[t][k] = hit
        for t, k, place in self.answered(ids, text, begin, texts):
            n = len(self.items[k][1])
            if best[t].get(k) is None:
                best[t][k] = self._check(texts[t], k, {max(0, at) for at in range(place - n, place + 1, WINDOW)})
        for t, words in enumerate(texts):
            found = self._short(words)
            hits = {k: hit for k, hit in best[t].items() if hit}
            # Products of several texts are rounded otherwise; what is told is the cosine in the text alone.
            alone = self.candidates(of[t], sizes[t:t + 1])[0] if len(texts) > 1 and hits.keys() & near[t].keys() else near[t]
            for k, hit in hits.items():
                cosine = alone[k][0] if k in alone else self._cosine(of[t][hit[2]:hit[3]], k)
                found.append((self.items[k][0], min(1.0, cosine), *hit))
            yield sorted(found, key=lambda x: (x[0] is None, x[0] or 0, x[1:]))

    def _short(self, words: list[bytes]) -> list[tuple]:
        """Items of fewer than FEWEST words, which must stand there word for word."""
        found = []
        if self.short:
            joined = b" %s " % b" ".join(words)
            for k in self.short:
                i, item, _ = self.items[k]
                at = joined.find(b" %s " % b" ".join(item))
                if at >= 0:
                    start = joined.count(b" ", 0, at + 1) - 1
                    found.append((i, 1.0, 1.0, True, start, start + len(item)))
        return sorted(found, key=lambda x: (x[0] is None, x[0] or 0, x[1:]))

    def _cosine(self, ids: np.ndarray, k: int) -> float:
        """The best cosine of a region of the text with a passage of the item."""
        x = self.latent[ids[ids < len(self.vocabulary)]].sum(axis=0)
        own = self.queries[[p for p, owner in enumerate(self.owner) if owner == k]]
        return float((own @ x).max() / max(float(np.linalg.norm(x)), 1e-9))

    def _check(self, words: list[bytes], k: int, starts: set[int]) -> tuple | None:
        """The best region around the windows: share of the item's words in order, answer found, bounds."""
        _, item, answer = self.items[k]
        n, bag = len(item), self.bags[k]
        best = None
        tried = set()
        for s in starts:
            for at in range(max(0, s - n), min(len(words), s + WINDOW), max(1, n // 4)):
                if at in tried:
                    continue
                tried.add(at)
                region = words[at:at + n + n // 2]
                if not shares(region, bag, SHARE_WITH_ANSWER * n):
                    continue
                share = common_subsequence(item, region) / n
                if share >= SHARE or (share >= SHARE_WITH_ANSWER and contains(region, answer)):
                    if best is None or share > best[0]:
                        best = share, contains(region, answer), at, at + len(region)
        return best

    def _check_passage(self, ids: np.ndarray, words: list[bytes], p: int, place: int, tried: set[tuple[int, int]]) -> tuple | None:
        """The same for the regions that hold one place: of a whole item that is one passage, or else of the passage itself."""
        k, passage = self.owner[p], self.passages[p]
        _, item, answer = self.items[k]
        n, step = len(passage), max(1, len(passage) // 4)
        best, bag = None, self.passage_bags[p]
        for at in range(max(0, place - n - n // 2 + 1) // step * step, place + 1, step):
            if (p, at) in tried:
                continue
            tried.add((p, at))
            region = ids[at:at + n + n // 2].tolist()
            if not shares(region, bag, SHARE * n):
                continue
            share = common_subsequence(passage, region) / n
            if share >= SHARE and (best is None or share > best[0]):
                best = share, contains(words[at:at + len(region)], answer), at, at + len(region)
        if n < len(item) and (-1 - k, place // WINDOW) not in tried:
            tried.add((-1 - k, place // WINDOW))
            if hit := self._check(words, k, {place}):
                best = max(best or hit, hit)
        return best


def vocabulary(items: list[tuple[int, str, str | None]]) -> dict[bytes, int]:
    return {w: i for i, w in enumerate(sorted({w for _, t, _ in items for w in words_of(t)}))}


def _index(items: tuple, df: tuple, n_docs: int, basis: bytes, rank: int) -> Index:
    return Index(list(items), dict(df), n_docs, np.frombuffer(basis, np.float64).reshape(-1, rank))


def document_frequencies(docs: DataFrame, text_col: str, words: set[bytes]) -> dict[bytes, int]:
    """In how many of all documents each of the words stands."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(words)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, seen = shared.value, Counter()
        for batch in batches:
            for text in batch.column(0):
                seen.update(wanted.intersection(words_of(text.as_py())))
        yield pa.record_batch([pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())], names=["word", "n"])

    rows = docs.select(whole(F.col(text_col)).alias("text")).mapInArrow(count, "word binary, n long")
    return {bytes(r["word"]): r["n"] for r in rows.groupBy("word").agg(F.sum("n").alias("n")).collect()}  # at most the words of a block


def randomised_svd(rows: DataFrame, idf: np.ndarray, rank: int) -> np.ndarray:
    """Right singular vectors of the TF-IDF matrix whose rows are lists of word numbers (column ``ids``).

    Two passes: the range of the matrix is found with random vectors and one power step, then a small matrix in that range is decomposed.
    Every partition sums its products; Spark adds them up by word.
    """
    width = min(len(idf), rank + MORE)

    def products(test: np.ndarray, gram: bool):
        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            z = np.zeros((width if gram else len(idf), test.shape[1]))
            for f in frames:
                for ids in f["ids"]:
                    y = (test[ids] * idf[ids, None]).sum(axis=0)
                    if gram:
                        z += np.outer(y, y)
                    else:
                        np.add.at(z, ids, idf[ids, None] * y)
            at = np.flatnonzero(np.abs(z).sum(axis=1))
            yield pd.DataFrame({"i": at, "v": list(z[at])})

        def add(f: pd.DataFrame) -> pd.DataFrame:
            return pd.DataFrame({"i": f["i"].iloc[:1], "v": [np.sum(np.stack(f["v"].tolist()), axis=0)]})

        out = np.zeros((width if gram else len(idf), test.shape[1]))
        for r in rows.mapInPandas(run, "i int, v array<double>").groupBy("i").applyInPandas(add, "i int, v array<double>").collect():
            out[r["i"]] = r["v"]
        return out

    q = np.random.default_rng(SEED).normal(size=(len(idf), width))
    for _ in range(2):
        q, _ = np.linalg.qr(products(q, False))
    values, vectors = np.linalg.eigh(products(q, True))
    return q @ vectors[:, np.argsort(-values)[:rank]]


def find_leaks(docs: DataFrame, benchmark: DataFrame, keep: list[str], text_col: str = "text", item_col: str = "item_id",
               item_text_col: str = "text", answer_col: str | None = None) -> DataFrame:
    """The columns ``keep`` of every row of ``docs``, and ``leaks``: an array of the benchmark items found in its text.

    A leak has item_id, cosine, share (of the item's words, or of the words of one of its passages of WINDOW words, in order, in a region of the text),
    answer (whether the answer stands there: ``answer_col``, or else the item's last sentence), start_word and end_word of the region. Items of fewer than FEWEST words must stand there word for
    word. Null and empty texts have no leaks; null and empty items are found nowhere; items with equal texts are all told. Words are
    compared in lower case without punctuation. Whole texts are searched. A column of ``docs`` may be called anything but leaks.
    """
    spark = docs.sparkSession
    importable(spark)
    scratch = Scratch(spark, "leaks")
    items = benchmark.where(F.col(item_text_col).isNotNull()).select(
        F.col(item_col).cast("long").alias("item_id"), F.col(item_text_col).alias("text"),
        (F.col(answer_col).cast("string") if answer_col else F.lit(None).cast("string")).alias("answer"))
    blocks = -(-items.count() // BLOCK)
    n_docs = docs.count()
    out = docs.select(F.col(text_col).alias("t"), *(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(keep)),
                      F.array().cast(f"array<struct<{LEAK.replace(' ', ':').replace(',:', ',')}>>").alias("leaks"))
    for b in range(blocks):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b)
        block = tuple(sorted((tuple(r) for r in part.collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1])))  # about BLOCK items
        words = vocabulary(list(block))
        if not words:
            continue
        df = document_frequencies(docs, text_col, set(words))
        plain = Index(list(block), df, n_docs)
        passages = spark.createDataFrame(pd.DataFrame({"ids": plain.passages or [[0]]}), "ids array<int>")
        rank = min(RANK, len(words), max(1, len(plain.passages)))
        basis = randomised_svd(scratch.keep(passages.repartition(8), "passages"), plain.idf.astype(np.float64), rank)
        shared = spark.sparkContext.broadcast((block, tuple(sorted(df.items())), n_docs, basis.tobytes(), basis.shape[1]))
        out = out.mapInArrow(_search(shared), out.schema)
    return out.select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(keep)), "leaks")


def _search(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = in_worker(_index, *shared.value)
        names = _LEAK.names if hasattr(_LEAK, "names") else [f.name for f in _LEAK]
        for batch in batches:
            texts = (x.as_py() or "" for x in batch.column(0))
            found = []
            for leaks, before in zip(index.leaks_of(texts), batch.column(batch.num_columns - 1), strict=True):
                found.append((before.as_py() or []) + [dict(zip(names, x, strict=True)) for x in leaks])
            yield pa.record_batch([*batch.columns[:-1], pa.array(found, pa.list_(_LEAK))], names=batch.schema.names)
    return run


def leak_rows(found: DataFrame) -> DataFrame:
    """One row per leak instead of an array."""
    rest = [c for c in found.columns if c != "leaks"]
    return found.select(*rest, F.explode("leaks").alias("leak")).select(*rest, "leak.*")


def clean(leaks: Column) -> Column:
    return F.size(leaks) == 0

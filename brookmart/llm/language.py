"""Language identification by cross-parsing entropy.

For each language a suffix automaton holds sample text. A text is parsed from left to right into the longest
phrases that occur in the sample; the language that needs the fewest phrases per character wins. The texts of
a batch step through an automaton side by side; when few long ones are left, each goes on alone, from the state it is in.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brookmart.llm.common import importable, in_worker

#: Bounds of the learned sample of each language: documents and characters.
SAMPLE_DOCS, SAMPLE_CHARS = 200, 24_000
#: Columns of a language's table: its most frequent characters have one each, its others are looked up by search, and one is for unknown ones.
#: With more than TABLES languages tables are narrower, so that they fit in memory.
COLUMNS, FEWEST_COLUMNS, TABLES = 64, 8, 64
SCORE_POWER = 8.0
#: Texts step side by side for BLOCK characters at a time, while at least NARROW of them go on. Neither changes a result.
BLOCK, NARROW = 512, 48
#: Rows and bytes of texts that step through the automata side by side. They bound memory and change no result.
TEXT_ROWS, TEXT_BYTES = 4000, 8 << 20


class SuffixAutomaton:
    """All substrings of a sequence of numbers, as a table of transitions by numbers below ``width`` (0 is the start, -1 is none).

    Transitions by others are in ``more``: sorted (state << 32 | number), and the next states.
    """

    def __init__(self, symbols: list[int], width: int):
        size = 2 * len(symbols) + 2
        table = np.full((size, width), -1, np.int32)
        go: list[dict[int, int]] = [{}]
        link, length, last = [-1], [0], 0
        for c in symbols:
            cur = len(go)
            go.append({})
            length.append(length[last] + 1)
            link.append(0)
            p = last
            while p != -1 and c not in go[p]:
                go[p][c] = cur
                p = link[p]
            if p != -1:
                q = go[p][c]
                if length[p] + 1 == length[q]:
                    link[cur] = q
                else:
                    clone = len(go)
                    go.append(dict(go[q]))
                    length.append(length[p] + 1)
                    link.append(link[q])
                    while p != -1 and go[p].get(c) == q:
                        go[p][c] = clone
                        p = link[p]
                    link[q] = link[cur] = clone
            last = cur
        more = []
        for state, moves in enumerate(go):
            for c, to in moves.items():
                if c < width:
                    table[state, c] = to
                else:
                    more.append((state << 32 | c, to))
        self.more = np.array(sorted(more), np.int64).reshape(-1, 2).T.copy()
        self.table = table[: len(go)]

    def parser(self) -> np.ndarray:
        """Next state times two for (state, symbol), plus one if a phrase starts with the symbol.

        The last state stands before the first symbol and behind unknown ones: whatever comes next starts a phrase.
        """
        between = len(self.table)
        start = np.where(self.table[0] >= 0, self.table[0], between)
        steps = np.where(self.table >= 0, self.table * 2, start * 2 + 1)
        return np.vstack([steps, start * 2 + 1]).astype(np.int32)


class Language:
    """The automaton of one sample over all its characters, given as numbers of ``symbols`` different ones; others are unknown."""

    def __init__(self, sample: np.ndarray, symbols: int, columns: int):
        counts = np.bincount(sample, minlength=symbols)
        order = np.argsort(-counts, kind="stable")[: np.count_nonzero(counts)]
        self.width, frequent = columns, columns - 2
        own = np.full(symbols + 1, columns - 1, np.int64)
        own[order[:frequent]] = np.arange(len(order[:frequent]))
        own[order[frequent:]] = columns + np.arange(len(order[frequent:]))  # beyond the table
        self.rare, self.own = columns - 2, own
        self.column = np.where(own >= columns, self.rare, own).astype(np.uint8)
        automaton = SuffixAutomaton(own[sample].tolist(), columns)
        self.steps = automaton.parser().ravel()
        self.keys, self.next = automaton.more

    def moves(self, states: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        """What the table of steps says of the others, for characters without a column."""
        own = self.own[symbols]
        key = states.astype(np.int64) << 32 | own
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        start = self.next[np.searchsorted(self.keys, own)]  # by the start's own keys, as its number is 0
        return np.where(self.keys[at] == key, self.next[at] * 2, start * 2 + 1)

    def follow(self, symbols: np.ndarray, state: int) -> int:
        """Phrases that start in one text from ``state`` on."""
        columns, width, count, at = self.column[symbols], self.width, 0, 0
        steps, keys, following = memoryview(self.steps), memoryview(self.keys), memoryview(self.next)
        row = columns.tolist()
        for stop in [*np.flatnonzero(columns == self.rare).tolist(), len(row)]:
            for c in row[at:stop]:
                step = steps[state * width + c]
                count += step & 1
                state = step >> 1
            if stop < len(row):
                own = int(self.own[symbols[stop]])
                k = bisect_left(keys, state << 32 | own)
                if k < len(keys) and keys[k] == state << 32 | own:
                    state = following[k]
                else:
                    state, count = following[bisect_left(keys, own)], count + 1
            at = stop + 1
        return count


class Model:
    """Automata of the sampled languages, each over its own characters."""

    def __init__(self, samples: dict[str, str]):
        self.names = sorted(samples)
        alphabet = sorted(set().union(*samples.values()))
        self.codes = np.full(0x110000, len(alphabet), np.uint16 if len(alphabet) < 1 << 16 else np.int32)
        self.codes[[ord(c) for c in alphabet]] = np.arange(len(alphabet))
        columns = COLUMNS
        while columns > FEWEST_COLUMNS and columns * len(samples) > COLUMNS * TABLES:
            columns //= 2
        self.languages = [Language(self.encode(samples[n]), len(alphabet), columns) for n in self.names]

    def encode(self, text: str) -> np.ndarray:
        return self.codes[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]

    def phrases(self, texts: list[str]) -> np.ndarray:
        """Phrases per character, by text and language."""
        symbols = sorted(((i, self.encode(t)) for i, t in enumerate(texts)), key=lambda x: -len(x[1]))
        order, lengths = np.array([i for i, _ in symbols], np.int64), np.array([len(x) for _, x in symbols], np.int64)
        counts = np.zeros((len(self.names), len(texts)), np.int64)
        states = [np.full(len(texts), len(lang.steps) // lang.width - 1, np.int32) for lang in self.languages]
        done = 0
        while (going := int(np.searchsorted(-lengths, -done, side="left"))) >= NARROW:
            grid = np.zeros((BLOCK, going), self.codes.dtype)
            for k in range(going):
                piece = symbols[k][1][done:done + BLOCK]
                grid[: len(piece), k] = piece
            active = np.searchsorted(-lengths, -np.arange(done + 1, done + BLOCK + 1), side="right")
            for lang, state, count in zip(self.languages, states, counts, strict=True):
                steps, width = lang.steps, lang.width
                columns = lang.column[grid]
                seldom = (columns == lang.rare).any(axis=1)
                for t in range(BLOCK):
                    n = active[t]
                    if n == 0:
                        break
                    nxt = steps[state[:n] * width + columns[t, :n]]
                    if seldom[t]:
                        at = np.flatnonzero(columns[t, :n] == lang.rare)
                        nxt[at] = lang.moves(state[at], grid[t, at])
                    count[:n] += nxt & 1
                    state[:n] = nxt >> 1
            done += BLOCK
        for lang, state, count in zip(self.languages, states, counts, strict=True):
            for k in range(going):
                count[k] += lang.follow(symbols[k][1][done:], int(state[k]))
        out = np.empty((len(texts), len(self.names)))
        out[order] = counts.T / np.maximum(lengths, 1)[:, None]
        return out

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        names, scores = ["und"] * len(texts), [0.0] * len(texts)
        # Characters without case or letters still count as symbols, but a text needs a letter.
        known = [i for i, t in enumerate(texts) if t and any(map(str.isalpha, t))]
        if known and self.names:
            costs = self.phrases([simple(texts[i]) for i in known])
            share = np.maximum(costs, 1e-9) ** -SCORE_POWER
            share /= share.sum(axis=1, keepdims=True)
            best = costs.argmin(axis=1)
            for k, i in enumerate(known):
                names[i], scores[i] = self.names[best[k]], float(share[k, best[k]])
        return names, scores


def simple(text: str) -> str:
    """Lower case; what isn't a letter is left as it is, so marks count alike for every language."""
    return text.lower()


def model_of(samples: tuple[tuple[str, str], ...]) -> Model:
    return Model(dict(samples))


def blocks(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Pieces of a batch of at most TEXT_ROWS rows and TEXT_BYTES in its first column, or one row."""
    sizes = np.cumsum(pa.compute.fill_null(pa.compute.binary_length(batch.column(0)), 0).to_numpy())
    at = 0
    while at < batch.num_rows:
        before = sizes[at - 1] if at else 0
        to = min(at + TEXT_ROWS, max(at + 1, int(np.searchsorted(sizes, before + TEXT_BYTES, side="right"))))
        yield batch.slice(at, to - at)
        at = to


def held_out(id_col: Column, parts: int, part: int) -> Column:
    """Whether the checksum of the identifier falls into one part; null identifiers do not."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % parts == part, F.lit(False))


def learn(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id") -> tuple[tuple[str, str], ...]:
    """Sample text of each language from labelled documents: (language, text) pairs.

    Takes, per language, whole documents in the order of a hash until SAMPLE_CHARS characters, at most
    SAMPLE_DOCS documents; the last one is cut at the bound. Every language is learned.
    """
    labelled = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & F.col(id_col).isNotNull())
    lang = F.col(lang_col).cast("string").alias("lang")
    counts = labelled.groupBy(lang).count()
    # A threshold on the hash lets about twice the wanted number of documents pass, however many there are.
    drawn = labelled.select(
        lang, F.xxhash64(id_col, text_col).alias("h"), F.col(id_col).alias("id"), F.substring(F.col(text_col), 1, SAMPLE_CHARS).alias("text"),
    ).join(F.broadcast(counts), "lang").where((F.col("h") / 2.0**64 + 0.5) * F.col("count") < 2 * SAMPLE_DOCS)
    first = Window.partitionBy("lang").orderBy("h", "id", "text")
    picked = (
        drawn.withColumn("n", F.row_number().over(first)).where(F.col("n") <= SAMPLE_DOCS)
        .withColumn("before", F.sum(F.length("text")).over(first) - F.length("text")).where(F.col("before") < SAMPLE_CHARS)
        .select("lang", "n", "text").collect()
    )
    texts: dict[str, list[tuple[int, str]]] = {}
    for r in picked:
        texts.setdefault(r["lang"], []).append((r["n"], r["text"]))
    return tuple((lang, "\n".join(simple(t) for _, t in sorted(texts[lang]))[:SAMPLE_CHARS]) for lang in sorted(texts))


def identify(docs: DataFrame, samples: tuple[tuple[str, str], ...], id_col: str = "doc_id", text_col: str = "text",
             keep: list[str] | None = None) -> DataFrame:
    """Predicted language of every text: the columns in ``keep`` (the identifier by default), lang_pred and score.

    ``und`` with score 0 for texts that are null or have no letter, and for all if nothing was learned. Ties go to the language first by
    code point. Whole texts are parsed, however long. ``score`` is the share of the winner among phrases per character to the power of -8. One row per row of ``docs``.
    """
    importable(docs.sparkSession)
    keep = keep or [id_col]
    others = [c for c in keep if c != text_col]  # the text comes and goes once
    shared = docs.sparkSession.sparkContext.broadcast(samples)  # at most SAMPLE_CHARS characters a language

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = in_worker(model_of, shared.value)
        for batch in batches:
            for piece in blocks(batch):
                names, scores = model.predict(piece.column(0).to_pylist())
                kept = [piece.column(0 if c == text_col else 1 + others.index(c)) for c in keep]
                yield pa.record_batch([*kept, pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                                      names=[*(f"c{i}" for i in range(len(keep))), "lang_pred", "score"])

    rows = docs.select(F.col(text_col), *(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(others)))
    kinds = [f"c{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(keep)]
    out = rows.mapInArrow(run, ", ".join([*kinds, "lang_pred string, score double"]))
    return out.select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(keep)), "lang_pred", "score")

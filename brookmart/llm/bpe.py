"""Byte-pair encoding by a trie of distinct words, and decoding.

The distinct words of a block of texts form a trie. A walk through it, depth first, gives every node the last
token of its prefix's encoding, from the tokens that end there and the last tokens of the nodes above. The prefix
in front of that token ends at such a node too, so an encoding is read off backwards, and what words share at
their beginnings is encoded once.

Why the last token of a prefix tells all: byte-pair encoding never looks back over a border that it keeps. The
tokens of a text are the one way to cut it so that encoding any two neighbours together gives these two again.
"""

from __future__ import annotations

import functools
import json
import os
import re
from collections import deque
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brookmart.llm.common import importable, whole

#: Characters of texts handled at a time in a task, and words remembered between such blocks. They bound memory and change no result.
BLOCK_CHARS, KNOWN_WORDS, KNOWN_LENGTH = 1 << 21, 200_000, 64
#: Printable text of one byte a character: its lower case, pieces and byte names are those of the general way.
PLAIN = re.compile(r"[!-~]*")


class Merges:
    """The merges of a byte-pair vocabulary: which tokens may stand side by side, and which may end a prefix."""

    def __init__(self, model: dict):
        for option in ("dropout", "byte_fallback", "ignore_merges", "continuing_subword_prefix", "unk_token"):
            if model.get(option):
                raise ValueError(f"byte-pair models with {option} are not supported")
        suffix = model.get("end_of_word_suffix") or ""
        self.ids: dict[str, int] = model["vocab"]
        self.size = max(self.ids.values()) + 1
        self.made = [-1] * self.size  # the rank of the merge that makes a token; single symbols have none
        self.left, self.right = [-1] * self.size, [-1] * self.size
        self.rank: dict[int, int] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = (self.ids[x] for x in (pair if isinstance(pair, list) else pair.split(" ")))
            token = self.ids["".join(pair) if isinstance(pair, list) else pair.replace(" ", "")]
            if self.made[token] >= 0:
                raise ValueError("a token must have one merge")
            self.made[token], self.left[token], self.right[token] = rank, a, b
            self.rank[a * self.size + b] = rank
        self._beside: dict[int, bool] = {}
        usable = [True] * self.size
        for token in sorted(range(self.size), key=self.made.__getitem__):
            if self.made[token] >= 0:
                a, b = self.left[token], self.right[token]
                if max(self.made[a], self.made[b]) > self.made[token]:
                    raise ValueError("a token's merge must come after those of its parts")
                usable[token] = usable[a] and usable[b] and self._apart(a, b, self.made[token])
        inner = {t: i for t, i in self.ids.items() if usable[i] and not (suffix and t.endswith(suffix))}
        final = {t[: -len(suffix)]: i for t, i in self.ids.items() if usable[i] and t.endswith(suffix)} if suffix else inner
        self._index(inner, final)

    def _apart(self, a: int, b: int, before: float = float("inf")) -> bool:
        """Whether merging keeps the border between two tokens, looking at merges earlier than ``before`` only.

        Merges are undone from the last one back. What then stands on both sides of the border stood there when
        the undone merge came, so a merge of these two must not have come first. Of equal merges the left one comes first.
        """
        while True:
            if self.rank.get(a * self.size + b, before) < before:
                return False
            of_a, of_b = self.made[a], self.made[b]
            if of_a < 0 and of_b < 0:
                return True
            if of_a > of_b:
                before, a = of_a, self.right[a]
            else:
                before, b = of_b + 1, self.left[b]

    def beside(self, a: int, b: int) -> bool:
        """Whether encoding the two tokens' text gives these two tokens."""
        key = a * self.size + b
        found = self._beside.get(key)
        if found is None:
            if len(self._beside) > 4_000_000:  # of memory, not of the result
                self._beside.clear()
            found = self._beside[key] = self._apart(a, b)
        return found

    def _index(self, inner: dict[str, int], final: dict[str, int]) -> None:
        """An automaton over symbols. In each state: the tokens that end there, longest first, inside and at the end of a word."""
        go: list[dict[str, int]] = [{}]
        own: list[list[int]] = [[-1, -1]]
        for kind, tokens in enumerate((inner, final)):
            for text, token in tokens.items():
                state = 0
                for c in text:
                    to = go[state].get(c)
                    if to is None:
                        to = go[state][c] = len(go)
                        go.append({})
                        own.append([-1, -1])
                    state = to
                own[state][kind] = token
        fail, depth = [0] * len(go), [0] * len(go)
        ends: list[list[tuple]] = [[()] * len(go), [()] * len(go)]
        queue = deque([0])
        while queue:
            state = queue.popleft()
            for c, to in go[state].items():
                back = fail[state]
                while state and back and c not in go[back]:
                    back = fail[back]
                fail[to] = go[back].get(c, 0) if state else 0
                depth[to] = depth[state] + 1
                for kind in (0, 1):
                    shorter = ends[kind][fail[to]]
                    ends[kind][to] = ((own[to][kind], depth[to]), *shorter) if own[to][kind] >= 0 else shorter
                queue.append(to)
        self.go, self.fail, self.inner, self.final = go, fail, ends[0], ends[1]

    def step(self, state: int, symbol: str) -> int:
        """The longest end of the text so far, with ``symbol``, that some token starts with."""
        go, fail = self.go, self.fail
        to = go[state].get(symbol)
        while to is None and state:
            state = fail[state]
            to = go[state].get(symbol)
        return to or 0


class Trie:
    """Distinct words as a trie in depth-first order: sorted, each with the depth to which it goes along with the one before.

    The last symbol of a word is a leaf of its own, as it may carry the mark of the word's end.
    """

    def __init__(self, words: Iterable[str]):
        self.words = sorted(set(words))
        self.shared = []
        before = ""
        for word in self.words:
            limit, depth = min(len(before), len(word)) - 1, 0
            while depth < limit and before[depth] == word[depth]:
                depth += 1
            self.shared.append(depth)
            before = word

    def encode(self, merges: Merges) -> dict[str, list[int]]:
        """The tokens of each word. Only the path from the root to the current node is kept."""
        out: dict[str, list[int]] = {}
        states, last, length = [0], [-1], [0]  # by depth: the automaton's state, the last token and its length
        step, beside, inner, final = merges.step, merges.beside, merges.inner, merges.final
        for word, shared in zip(self.words, self.shared, strict=True):
            n = len(word)
            if not n:
                out[word] = []
                continue
            del states[shared + 1:], last[shared + 1:], length[shared + 1:]
            state = states[shared]
            for depth in range(shared + 1, n):
                state = step(state, word[depth - 1])
                for token, size in inner[state]:
                    in_front = last[depth - size]
                    if in_front < 0 or beside(in_front, token):
                        break
                else:
                    raise ValueError(f"no token ends {word[:depth]!r}")
                states.append(state)
                last.append(token)
                length.append(size)
            for token, size in final[step(state, word[-1])]:
                in_front = last[n - size]
                if in_front < 0 or beside(in_front, token):
                    break
            else:
                raise ValueError(f"no token ends {word!r}")
            tokens, at = [token], n - size
            while at:
                tokens.append(last[at])
                at -= length[at]
            tokens.reverse()
            out[word] = tokens
        return out


class TrieEncoder:
    """Ids of whole texts as a byte-level byte-pair tokenizer file gives them, by the trie of their words.

    A text is cut at spaces, line feeds, tabs and returns, over which no piece reaches. The file's own normaliser and
    splitter cut such words into pieces; the trie is over pieces. Special tokens in a text are told as the file says.
    """

    def __init__(self, tokenizer_file: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        with open(tokenizer_file, encoding="utf-8") as f:
            layout = json.load(f)
        self.merges = Merges(layout["model"])
        tokenizer = Tokenizer.from_file(tokenizer_file)
        self.normalizer, self.splitter = tokenizer.normalizer, tokenizer.pre_tokenizer
        special = layout.get("added_tokens") or []
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] or re.search(r"\s", t["content"]) for t in special):
            raise ValueError("special tokens that take in what stands around them are not supported")
        self.special = {t["content"]: t["id"] for t in special}
        self.cut = re.compile("(" + "|".join(re.escape(t) for t in sorted(self.special, key=len, reverse=True)) + ")") if special else None
        self.plain = _plain_pieces(layout)
        self.known: dict[str, bytes] = {}

    def pieces(self, word: str) -> list[str | int]:
        """What the splitter makes of a word, as byte names; special tokens as their ids."""
        if self.cut and "<" in word and self.cut.search(word):
            out: list[str | int] = []
            for part in self.cut.split(word):
                out += [self.special[part]] if part in self.special else self.pieces(part) if part else []
            return out
        if self.plain and PLAIN.fullmatch(word):
            return self.plain.findall(word.lower())
        if self.normalizer:
            word = self.normalizer.normalize_str(word)
        return [p for p, _ in self.splitter.pre_tokenize_str(word)]

    def learn(self, words: set[str]) -> dict[str, bytes]:
        """Little-endian ids of each word."""
        cut = {w: self.pieces(w) for w in words}
        tokens = Trie(p for pieces in cut.values() for p in pieces if isinstance(p, str)).encode(self.merges)
        out = {}
        for word, pieces in cut.items():
            ids: list[int] = []
            for p in pieces:
                ids += tokens[p] if isinstance(p, str) else [p]
            out[word] = np.array(ids, "<u4").tobytes()
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        split = [t.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ") for t in texts]
        words = set().union(*split)
        if len(self.known) > KNOWN_WORDS:
            self.known.clear()
        new = self.learn(words - self.known.keys())
        self.known.update((w, ids) for w, ids in new.items() if len(w) <= KNOWN_LENGTH)
        get = {**self.known, **new}.__getitem__ if any(len(w) > KNOWN_LENGTH for w in new) else self.known.__getitem__
        return [b"".join(map(get, w)) for w in split]


def _plain_pieces(layout: dict) -> re.Pattern | None:
    """The splitter's pattern for printable ASCII words without spaces, if it is one that may be read so."""
    normal = layout.get("normalizer") or {}
    lower = any(n["type"] == "Lowercase" for n in normal.get("normalizers", [normal]) if n)
    harmless = all(n["type"] in ("NFC", "Lowercase") or n.get("pattern") == {"Regex": r"\s+"} for n in normal.get("normalizers", [normal]) if n)
    parts = (layout.get("pre_tokenizer") or {}).get("pretokenizers", [])
    if not (lower and harmless and len(parts) == 2 and parts[0]["type"] == "Split" and parts[1]["type"] == "ByteLevel"):
        return None
    split, names = parts
    if split["behavior"] != "Removed" or not split["invert"] or names["use_regex"] or names["add_prefix_space"]:
        return None
    pattern = split["pattern"].get("Regex", "")
    plain = pattern.replace(r"[\p{L}]", "[a-z]").replace(r"[\p{N}]", "[0-9]").replace(r"\s\p{L}\p{N}", "a-z0-9")
    return None if "\\" in plain else re.compile(plain)


class Decoder:
    """Texts of ids as the tokenizer file's own decoder gives them, special tokens included; unknown ids are left out."""

    def __init__(self, tokenizer_file: str):
        with open(tokenizer_file, encoding="utf-8") as f:
            layout = json.load(f)
        kind = (layout.get("decoder") or {}).get("type")
        if kind not in (None, "ByteLevel"):
            raise ValueError(f"decoder {kind} is not supported")
        names = {i: t for t, i in layout["model"]["vocab"].items()} | {t["id"]: t["content"] for t in layout.get("added_tokens") or []}
        self.between = " " if kind is None else ""
        self.table: list[str | None] = [names.get(i) for i in range(max(names) + 1)]
        self.whole = None not in self.table
        # A byte's name is its own character if that prints, else one of those from U+0100 on, in order.
        prints = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        hidden = [b for b in range(256) if b not in prints]
        self.bytes = {chr(b): b for b in prints} | {chr(0x100 + k): b for k, b in enumerate(hidden)} if kind else None

    def decode(self, ids: bytes) -> str:
        numbers = np.frombuffer(ids, "<u4")
        if not self.whole or (len(numbers) and int(numbers.max()) >= len(self.table)):
            tokens = [t for i in numbers.tolist() if i < len(self.table) and (t := self.table[i]) is not None]
        else:
            tokens = map(self.table.__getitem__, numbers.tolist())
        if self.bytes is None:
            return self.between.join(tokens)
        raw = b"".join(bytes(map(self.bytes.__getitem__, t)) if all(c in self.bytes for c in t) else t.encode() for t in tokens)
        return raw.decode("utf-8", "replace")


@functools.lru_cache(maxsize=1)
def _encoder(tokenizer_file: str) -> TrieEncoder:
    return TrieEncoder(tokenizer_file)


def _blocks(batches: Iterator[pa.RecordBatch], most: int, per_byte: int) -> Iterator[pa.RecordBatch]:
    """Pieces of batches whose first column has at most ``most / per_byte`` bytes, or one row."""
    for batch in batches:
        sizes = np.frombuffer(batch.column(0).buffers()[1], np.int32)[batch.column(0).offset:][: batch.num_rows + 1].astype(np.int64) * per_byte
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(sizes, sizes[at] + most, side="right")) - 1)
            yield batch.slice(at, to - at)
            at = to


def _mapped(rows: DataFrame, keep: list[str], first, work, out: str, kind: pa.DataType, most: int, per_byte: int = 1) -> DataFrame:
    """``work(list of the values of the column first)`` in tasks, block by block, as a column ``out`` next to the columns in ``keep``."""
    taken = rows.select(first, *(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(keep)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in _blocks(batches, most, per_byte):
            yield pa.record_batch([*piece.columns[1:], pa.array(work(piece.column(0).to_pylist()), kind)], names=[*(f"c{i}" for i in range(len(keep))), "out"])

    kinds = [f"c{i} {rows.schema[c].dataType.simpleString()}" for i, c in enumerate(keep)]
    done = taken.mapInArrow(run, ", ".join([*kinds, f"out {'string' if kind == pa.string() else 'binary'}"]))
    return done.select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(keep)), F.col("out").alias(out))


def encode_texts(docs: DataFrame, tokenizer_file: str, text_col: str = "text", keep: list[str] | None = None, ids_col: str = "ids") -> DataFrame:
    """The ids of every whole text, without special tokens added, as little-endian unsigned 32-bit integers in a binary column.

    Returns the columns in ``keep`` (doc_id by default; other columns are not read) and ``ids_col``, a row for each row. Null
    and empty texts give no ids; repeated rows are encoded each. Very long texts and words take time and memory in proportion
    to their length. No rows are shuffled. ``tokenizer_file`` must be at the same place on every executor.
    """
    importable(docs.sparkSession)

    def work(texts: list[str]) -> list[bytes]:
        return _encoder(tokenizer_file).encode(texts)

    return _mapped(docs, keep or ["doc_id"], whole(F.col(text_col)), work, ids_col, pa.binary(), BLOCK_CHARS)


def decode_ids(rows: DataFrame, tokenizer_file: str, ids_col: str = "ids", keep: list[str] | None = None, text_col: str = "text") -> DataFrame:
    """The text of every row's ids (as ``encode_texts`` writes them), special tokens included: the columns in ``keep`` and ``text_col``.

    Null ids give the empty text, as no ids do. Ids that the vocabulary lacks are left out.
    """
    importable(rows.sparkSession)

    def work(ids: list[bytes]) -> list[str]:
        return [*map(_decoder(tokenizer_file).decode, ids)]

    # An id of four bytes may become a token of many; blocks are smaller for it.
    return _mapped(rows, keep or ["doc_id"], F.coalesce(F.col(ids_col), F.lit(b"")), work, text_col, pa.string(), BLOCK_CHARS, 2)


@functools.lru_cache(maxsize=1)
def _decoder(tokenizer_file: str) -> Decoder:
    return Decoder(tokenizer_file)

"""Token ids in Arrow files of equal-length sequences with masks.

A shard is an Arrow IPC file whose batches hold two fixed-size-list columns: ``ids`` (documents end to
end, cut into sequences of equal length) and ``mask`` (true for ids, false for the padding behind the
last one). Value buffers are plain, so a memory-mapped shard gives any sequence without a copy.
A second Arrow file beside it lists doc_id, start and n_tokens of its documents.

Shards are written by tasks, each under a name of its own; a manifest table lists those of the attempts
that Spark has committed, so a lost or repeated task leaves at most an unlisted file.
"""

from __future__ import annotations

import codecs
import os
import re
import uuid
import zlib
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
import pyarrow.ipc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from brookmart.llm.common import Scratch, in_worker, whole

SEQUENCE, BATCH = 2048, 64
CACHED_WORDS = 500_000
#: Bytes of the texts, about, whose words are looked up together.
BLOCK = 4 << 20
#: Below this character, lower case does not depend on what stands around.
LATIN = "\u0250"
#: Characters that end a piece behind a letter; words are remembered without them.
MARKS = frozenset(".,")
#: The one letter below it whose lower case does not end in a letter.
DOTTED = "\u0130"
#: A byte's name in byte-level vocabularies is its own character if that prints, else one of those from U+0100 on, in order.
PRINTS = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
HIDDEN = [b for b in range(0x100) if b not in PRINTS]
BYTE_NAMES = "".join(chr(b if b in PRINTS else 0x100 + HIDDEN.index(b)) for b in range(0x100))
#: Letters and numbers below LATIN; words of visible characters below it; the splitter's pieces of these.
LETTERS, NUMBERS = "a-zA-Z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f", "0-9\u00b2\u00b3\u00b9\u00bc-\u00be"
PLAIN = re.compile("[!-&(-~\u00a1-\u024f]+")
PIECE = re.compile(f"[{LETTERS}]+|[{NUMBERS}]|[^{LETTERS}{NUMBERS}]+")
MANIFEST = "part int, path string, n_docs long, n_tokens long"
INDEX = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])


def _storage(path: str) -> tuple[pa.fs.FileSystem, str]:
    return pa.fs.FileSystem.from_uri(path)


def _words(tokenizer_file: str, dtype: str) -> WordEncoder:
    return WordEncoder(tokenizer_file, dtype, special_tokens=True)


class WordEncoder:
    """Ids of whole texts, with the ids of words remembered.

    The tokenizer's pieces never reach over a space or a line feed, nor over the border between a letter
    and the full stop or comma behind it, and its normaliser lower-cases each character by itself. So a
    text's ids are those of its words end to end, and a word's are those of its lower-case stem and its mark.
    A capital I with a dot keeps its mark, for its lower case ends in a combining dot, which is no letter.
    With ``special_tokens``, as in files, the tokenizer's special tokens in a text are told, as encoding the whole text does; words with one
    are left as they are, as their case counts. The normaliser leaves lower-case Latin stems alone, so the file's model gets the
    pieces of those without an apostrophe at once, by the names of their bytes. Of ``CACHED_WORDS``, half are the newest; when
    there are more, the half before them is forgotten, but for words met since. That changes nothing but speed.
    """

    def __init__(self, tokenizer_file: str, dtype: str, special_tokens: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        self.model = self.tokenizer.model
        self.tokenizer.encode_special_tokens = not special_tokens
        self.special = [t.content.lower() for t in self.tokenizer.get_added_tokens_decoder().values()] if special_tokens else []
        self.dtype = dtype
        self.known: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}

    def _learn(self, words: list[str]) -> None:
        known, single, new = self.known, set(), set()
        later, lows, marks = [], [], []
        joined = "\n".join(words).lower() if self.special else ""
        special = [t for t in self.special if t in joined]
        if not special:
            # Nearly all words are letters of ASCII with a mark or without; these need none of the tests below.
            rest = []
            for w in words:
                mark = ""
                if not w.isascii():
                    rest.append(w)
                    continue
                if w.isalpha():
                    low = w.lower()
                elif w[-1:] in MARKS and w[:-1].isalpha():
                    low, mark = w[:-1].lower(), w[-1]
                    if mark not in known:
                        new.add(mark)
                else:
                    rest.append(w)
                    continue
                if low not in known:
                    single.add(low)
                if low != w:
                    later.append(w)
                    lows.append(low)
                    marks.append(mark)
            words = rest
        for w in words:
            latin = w.isascii() or max(w) < LATIN
            stem, mark = w, ""
            if not w.isalpha():
                if w[-1:] in MARKS and w[-2:-1] < LATIN and w[-2:-1].isalpha() and w[-2] != DOTTED:
                    stem, mark = w[:-1], w[-1]
                    latin = latin or max(stem) < LATIN
            if special and any(t in w.lower() for t in special):
                stem, mark, latin = w, "", False
            low = stem.lower() if latin else stem
            if low not in known:
                # Lower case of a Latin letter may be a letter of another block, or a letter with a combining mark.
                (single if latin and PLAIN.fullmatch(low) else new).add(low)
            if low is not w and low != w:
                later.append(w)
                lows.append(low)
                marks.append(mark)
                if mark and mark not in known:
                    new.add(mark)
        todo = list(new)
        ids, ends = [], []
        tokenize = self.model.tokenize
        for x in single:
            for piece in (x,) if x.isalpha() else PIECE.findall(x):
                ids += [t.id for t in tokenize(piece if piece.isascii() else codecs.charmap_decode(piece.encode(), "strict", BYTE_NAMES)[0])]
            ends.append(len(ids))
        for got in self.tokenizer.encode_batch_fast(todo, add_special_tokens=False):
            ids += got.ids
            ends.append(len(ids))
        flat, size, at = np.array(ids, dtype=self.dtype).tobytes(), np.dtype(self.dtype).itemsize, 0
        for x, end in zip([*single, *todo], ends, strict=True):
            known[x] = flat[at * size:end * size]
            at = end
        for w, low, mark in zip(later, lows, marks, strict=True):
            known[w] = known[low] + known[mark] if mark else known[low]

    def encode(self, texts: list[str] | pa.Array) -> list[np.ndarray]:
        """The ids of each text. Arrow cuts and numbers the words, so only the different ones of a block are looked up."""
        if isinstance(texts, list):
            texts = pa.array(texts, pa.large_string())
        split = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        coded = split.flatten().dictionary_encode()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()  # many times faster than to_pylist
        if len(self.known) > CACHED_WORDS // 2:
            self.before, self.known = self.known, {}
        found = list(map(self.known.get, distinct))
        if missing := [i for i, x in enumerate(found) if x is None]:
            words = [distinct[i] for i in missing]
            again = list(map(self.before.get, words))
            self.known.update((w, x) for w, x in zip(words, again, strict=True) if x is not None)
            self._learn([w for w, x in zip(words, again, strict=True) if x is None])
            for i, w in zip(missing, words, strict=True):
                found[i] = self.known[w]
        flat = np.frombuffer(b"".join(found), dtype=self.dtype)
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // flat.itemsize
        word = coded.indices.to_numpy()
        many = sizes[word]
        ends = many.cumsum()
        # Each word's place in the ids of the different ones, less its place in those of the texts.
        shift = (sizes.cumsum() - sizes)[word] - ends + many
        ids = flat[np.arange(many.sum()) + shift.repeat(many)]
        borders = split.offsets.to_numpy() - split.offsets[0].as_py()
        return [ids[a:b] for a, b in pairwise(np.append(0, ends)[borders].tolist())]


def _write_shard(folder: str, part: int, batches, tokenizer_file: str, dtype: str, end_id: int, length: int) -> pa.RecordBatch:
    fs, root = _storage(folder)
    name = f"shard-{part:06d}-{uuid.uuid4().hex}"
    fs.create_dir(root, recursive=True)
    kind = pa.from_numpy_dtype(np.dtype(dtype))
    schema = pa.schema([("ids", pa.list_(kind, length)), ("mask", pa.list_(pa.bool_(), length))])
    end = np.array([end_id], dtype=dtype)
    encoder = in_worker(_words, tokenizer_file, dtype)
    n_docs = n_tokens = waiting = 0
    queue: list[np.ndarray] = []
    with fs.open_output_stream(f"{root}/{name}.arrow") as f, pa.ipc.new_file(f, schema) as out, \
            fs.open_output_stream(f"{root}/{name}.docs.arrow") as g, pa.ipc.new_file(g, INDEX) as index:

        def flush(last: bool) -> None:
            nonlocal queue, waiting
            flat = np.concatenate(queue) if queue else np.empty(0, dtype)
            used = len(flat) if last else len(flat) // (BATCH * length) * BATCH * length  # whole batches, so a number tells its batch
            mask = np.ones(used, bool)
            if pad := -used % length:
                flat, mask = np.append(flat, np.zeros(pad, dtype)), np.append(mask, np.zeros(pad, bool))
            queue, waiting = ([] if last else [flat[used:]]), (0 if last else len(flat) - used)
            flat = flat[: len(mask)]
            for at in range(0, len(mask), BATCH * length):
                cut = slice(at, at + BATCH * length)
                out.write_batch(pa.record_batch([
                    pa.FixedSizeListArray.from_arrays(pa.array(flat[cut]), length),
                    pa.FixedSizeListArray.from_arrays(pa.array(mask[cut]), length),
                ], schema=schema))

        for batch in batches:
            rows_at_once = max(1, batch.num_rows * BLOCK // max(1, batch.nbytes))
            for at in range(0, batch.num_rows, rows_at_once):
                piece = batch.slice(at, rows_at_once)
                rows = []
                for ids in encoder.encode(piece.column(1)):
                    queue += [ids, end]
                    rows.append(len(ids) + 1)
                sizes = np.array(rows, np.int64)
                starts = n_tokens + np.cumsum(sizes) - sizes
                index.write_batch(pa.record_batch([piece.column(0), pa.array(starts), pa.array(sizes)], schema=INDEX))
                n_docs += len(rows)
                n_tokens += int(sizes.sum())
                waiting += int(sizes.sum())
                if waiting >= BATCH * length:
                    flush(False)
        flush(True)
    return pa.record_batch([[part], [f"{folder}/{name}"], [n_docs], [n_tokens]],
                           schema=pa.schema([("part", pa.int32()), ("path", pa.string()), ("n_docs", pa.int64()), ("n_tokens", pa.int64())]))


def write_tokens(docs: DataFrame, folder: str, tokenizer_file: str, id_col: str = "doc_id", text_col: str = "text",
                 end_id: int = 1, length: int = SEQUENCE) -> DataFrame:
    """Encode every text and write the shards in ascending order of identifiers; returns the manifest table.

    Null identifiers come last; rows with equal ones are ordered by a hash of the text, in one task. Null texts are empty and
    give the end id alone. A table without rows gives no shards. Only the two columns named are read.
    ``tokenizer_file`` must be at the same place on every executor, as installed packages are.
    """
    from tokenizers import Tokenizer

    dtype = "<u2" if Tokenizer.from_file(tokenizer_file).get_vocab_size() <= 2**16 else "<u4"
    by_id = F.col("doc_id").asc_nulls_last()
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), whole(F.col(text_col)).alias("text"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        first = next(batches, None)
        if first is None:
            return

        def all_batches():
            yield first
            yield from batches

        yield _write_shard(f"{folder}/shards", TaskContext.get().partitionId(), all_batches(), tokenizer_file, dtype, end_id, length)

    shards = (
        # Ranges of identifiers alone, so that finding their borders reads no texts.
        rows.repartitionByRange(by_id).sortWithinPartitions(by_id, F.xxhash64("text")).mapInArrow(write, MANIFEST)
    )
    shards.write.mode("overwrite").parquet(f"{folder}/manifest")
    return docs.sparkSession.read.schema(MANIFEST).parquet(f"{folder}/manifest")


def sequence(shard: str, number: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids (a view of the mapped file) and mask of one sequence of a shard."""
    _, path = _storage(f"{shard}.arrow")
    reader = pa.ipc.open_file(pa.memory_map(path))
    batch = reader.get_batch(number // BATCH)
    ids, mask = batch.column(0), batch.column(1)
    at, length = number % BATCH, ids.type.list_size
    return (ids.values.to_numpy(zero_copy_only=True)[at * length:(at + 1) * length],
            mask.values.to_numpy(zero_copy_only=False)[at * length:(at + 1) * length])


def _documents(shard: str) -> Iterator[tuple[int | None, int, int, list[np.ndarray]]]:
    """doc_id, start, n_tokens and the pieces of ids of each document of a shard, batch by batch."""
    fs, path = _storage(shard)
    with fs.open_input_file(f"{path}.arrow") as f, fs.open_input_file(f"{path}.docs.arrow") as g:
        data, index = pa.ipc.open_file(f), pa.ipc.open_file(g)
        number, have, at = 0, np.empty(0), 0
        for i in range(index.num_record_batches):
            b = index.get_batch(i)
            for doc_id, start, n in zip(*(c.to_pylist() for c in b.columns), strict=True):
                pieces, need = [], n
                while need:
                    if at == len(have):
                        batch = data.get_batch(number)
                        have = batch.column(0).values.to_numpy()[batch.column(1).values.to_numpy(zero_copy_only=False)]
                        number, at = number + 1, 0
                    pieces.append(have[at:at + need])
                    at += len(pieces[-1])
                    need -= len(pieces[-1])
                yield doc_id, start, n, pieces


def read_tokens(spark: SparkSession, manifest: DataFrame, with_ids: bool = False) -> DataFrame:
    """One row per document, from the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32.

    ``with_ids`` adds the ids themselves. One task reads one shard.
    """
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    placed = manifest.withColumn("offset", F.coalesce(F.sum("n_tokens").over(earlier), F.lit(0))).select("path", "offset")
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            kinds = [pa.int64()] * 4 + [pa.list_(pa.int32())] * with_ids
            return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
                                   names=["doc_id", "start", "n_tokens", "ids_crc32", "ids"][:len(kinds)])

        for batch in batches:
            for path, offset in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                rows: list[tuple] = []
                for doc_id, start, n, pieces in _documents(path):
                    crc = 0
                    for p in pieces:
                        crc = zlib.crc32(p.astype("<u4").tobytes(), crc)
                    rows.append((doc_id, offset + start, n, crc, *([np.concatenate(pieces).astype(np.int32)] if with_ids else [])))
                    if len(rows) == 2000:
                        yield batch_of(rows)
                        rows = []
                if rows:
                    yield batch_of(rows)

    return placed.repartition(max(1, manifest.count())).mapInArrow(read, schema)


def tokenise(docs: DataFrame, tokenizer_file: str, **options) -> DataFrame:
    """Write the documents' ids to fresh files below the shared folder and read them back; see the two functions above."""
    spark = docs.sparkSession
    return read_tokens(spark, write_tokens(docs, Scratch(spark, "tokens").folder, tokenizer_file, **options))

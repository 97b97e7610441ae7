"""The trie encoder against the tokenizers library, and the merge rule against plain merging."""

import hashlib
import json
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from brookmart.llm.bpe import Decoder, Merges, Trie, TrieEncoder, decode_ids, encode_texts
from brookmart.llm.queries import op13_bpe_trie
from tests.llm.data import no_docs, odd_docs, odd_rows, prose

FILE = public_tokenizers.path("word_bpe_49k.json")
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(FILE)
    t.no_truncation()
    t.no_padding()
    return t


@pytest.fixture(scope="module")
def encoder():
    return TrieEncoder(FILE)


def same(encoder, library, texts):
    decoder = Decoder(FILE)
    for text, got, want in zip(texts, encoder.encode(texts), library.encode_batch(texts, add_special_tokens=False), strict=True):
        assert np.frombuffer(got, "<u4").tolist() == want.ids, text
        assert decoder.decode(got) == library.decode(want.ids, skip_special_tokens=False), text


def test_odd_texts(encoder, library):
    r = random.Random(3)
    pool = [*map(chr, range(1, 0x180)), *" \t\n\r\x0b\x0c\x1c\x85\xa0 ​̇́İΣσẞﬁकि中\U0001f600Å가", "'ll", "'re", "12",
            "<|endoftext|>", "<|startoftext|>", "<|EndOfText|>"]
    same(encoder, library, ["".join(r.choice(pool) for _ in range(r.randint(0, 40))) for _ in range(5000)])


def test_words_that_share_beginnings(encoder, library):
    r = random.Random(4)
    same(encoder, library, [" ".join("".join(r.choice("abcdeinth") for _ in range(r.randint(1, 12))) for _ in range(60)) for _ in range(400)])


def test_long_words_and_runs(encoder, library):
    same(encoder, library, ["a" * n for n in range(150)] + ["ab" * 5000, "x" * 60_000, "!" * 3000, "1" * 3000, prose(1, 20_000), ""])


def test_known_words_are_bounded(encoder, library, monkeypatch):
    monkeypatch.setattr("brookmart.llm.bpe.KNOWN_WORDS", 10)
    for seed in range(4):
        same(encoder, library, [prose(seed, 50), prose(seed + 1, 50)])


def plain_merging(merges: list, word: str) -> list[str]:
    ranks, parts = {tuple(m): i for i, m in enumerate(merges)}, list(word)
    while pairs := [(ranks[p], i) for i, p in enumerate(zip(parts, parts[1:])) if p in ranks]:
        _, i = min(pairs)
        parts[i:i + 2] = ["".join(parts[i:i + 2])]
    return parts


@pytest.mark.parametrize("seed", range(30))
def test_random_merges_against_plain_merging(seed):
    r = random.Random(seed)
    tokens, merges = list("abc"), []
    while len(merges) < 14:
        pair = [r.choice(tokens), r.choice(tokens)]
        if "".join(pair) not in tokens:
            merges.append(pair)
            tokens.append("".join(pair))
    model = Merges({"vocab": {t: i for i, t in enumerate(tokens)}, "merges": merges})
    words = ["".join(r.choice("abc") for _ in range(r.randint(1, 14))) for _ in range(300)]
    for word, ids in Trie(words).encode(model).items():
        assert [tokens[i] for i in ids] == plain_merging(merges, word)


def test_the_trie_takes_shared_beginnings_once():
    trie = Trie(["walking", "walk", "walked", "talk", "walk"])
    assert list(zip(trie.words, trie.shared)) == [("talk", 0), ("walk", 0), ("walked", 3), ("walking", 4)]


def test_models_that_do_not_fit_are_refused(tmp_path):
    with pytest.raises(ValueError, match="dropout"):
        Merges({"vocab": {"a": 0}, "merges": [], "dropout": 0.1})
    with pytest.raises(ValueError, match="one merge"):
        Merges({"vocab": {"a": 0, "aa": 1, "aaa": 2}, "merges": [["a", "a"], ["aa", "a"], ["a", "aa"]]})
    with pytest.raises(ValueError, match="after those"):
        Merges({"vocab": {"a": 0, "aa": 1, "aaa": 2}, "merges": [["a", "aa"], ["a", "a"]]})


def test_a_byte_level_decoder():
    file = public_tokenizers.path("byte_bpe_50k.json")
    with open(file, encoding="utf-8") as f:
        assert json.load(f)["decoder"]["type"] == "ByteLevel"
    t, d, r = Tokenizer.from_file(file), Decoder(file), random.Random(1)
    for _ in range(300):
        ids = [r.randrange(50_257) for _ in range(20)]
        assert d.decode(np.array(ids, "<u4").tobytes()) == t.decode(ids, skip_special_tokens=False)


def test_unknown_ids_are_left_out():
    d = Decoder(FILE)
    assert d.decode(np.array([0, 4_000_000, 1], "<u4").tobytes()) == '! "'


def test_odd_rows(spark, library):
    got = encode_texts(odd_docs(spark), FILE, keep=["doc_id", "text", "row", "key"]).collect()
    assert len(got) == len(odd_rows())
    for r in got:
        assert np.frombuffer(r["ids"], "<u4").tolist() == library.encode(r["text"] or "", add_special_tokens=False).ids
    assert encode_texts(no_docs(spark), FILE).collect() == []
    nulls = spark.createDataFrame([(1, None), (2, bytearray())], "doc_id long, ids binary")
    assert sorted(map(tuple, decode_ids(nulls, FILE).collect())) == [(1, ""), (2, "")]


def test_query_against_the_library(spark, library):
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = op13_bpe_trie(spark, SF).collect()
    assert len(got) == len(docs)
    for r in got:
        ids = library.encode(docs[r["doc_id"]], add_special_tokens=False).ids
        raw = np.array(ids, "<u4").tobytes()
        text = library.decode(ids, skip_special_tokens=False)
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (
            len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256(text.encode()).hexdigest())

"""Exact dedup, token files and archives: round trips, forced collisions, restarts and odd rows."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from brookmart.llm import token_files, warc
from brookmart.llm.exact_dedup import exact_dedup
from tests.llm.data import no_docs, odd_docs, odd_rows, stored

TOKENIZER = "word_bpe_49k.json"


def tokenizer_file() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


@pytest.mark.parametrize("weak", [False, True])
def test_dedup_of_odd_rows(spark, tmp_path, weak):
    path = stored(odd_docs(spark), tmp_path)
    options = {"digest": lambda t: F.substring(F.sha2(t, 256), 1, 1)} if weak else {}
    rows = exact_dedup(spark, path, maxFilesPerTrigger="1", **options).collect()
    groups = defaultdict(list)
    for r in odd_rows():
        text = r[1] or ""
        for c in "\t\n\x0b\x0c\r":
            text = text.replace(c, " ")
        while "  " in text:
            text = text.replace("  ", " ")
        groups[text].append(r[0])
    want = sorted((i is None, i or 0, min((x for x in ids if x is not None), default=None) or 0, len(ids)) for ids in groups.values() for i in ids)
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["keep_id"] or 0, r["group_size"]) for r in rows) == want
    assert sum(r["kept"] for r in rows) == len(groups) and len({r["text_sha256"] for r in rows}) == len(groups)
    assert all(r["doc_id"] == r["keep_id"] for r in rows if r["kept"])


def test_dedup_of_no_rows(spark, tmp_path):
    assert exact_dedup(spark, stored(no_docs(spark), tmp_path)).collect() == []


def test_word_encoder_equals_the_tokenizer():
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(tokenizer_file())
    plain.encode_special_tokens = True
    encoder = token_files.WordEncoder(tokenizer_file(), "<u2")
    r = random.Random(2)
    pieces = ["don't", "It's", "ÉTÉ", "İstanbul", "ΟΔΟΣ", "é", "a,b.", "...", "x.,", "'s", " ", "\n", "\t", " ", " ", "漢字", "\U0001f600", "<|endoftext|>", "A1.", "ǅ.", "1,", "12a\u00b2,", "\u00d7a\u00f7", "B\u00e9##.", "a\u00a0b", "a\x1cb", "x\x85y", "a_b-C\u00ad", "\u0130x!", "STRA\u00dfE.", "\u00aa\u00ba", "\u023aB,", "\u00c6\u00d8x", "caf\u00e9", "\u0141\u00f3d\u017a"]
    for _ in range(600):
        text = "".join(r.choice(pieces) + r.choice(["", " ", "\n", "  "]) for _ in range(r.randint(0, 12)))
        assert encoder.encode([text])[0].tolist() == plain.encode(text, add_special_tokens=False).ids


def test_files_hold_the_ids_of_whole_texts():
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(tokenizer_file())
    encoder = token_files._words(tokenizer_file(), "<u2")
    r = random.Random(3)
    pieces = ["BELED\u0130YES\u0130.", "\u0130,", "\u0130", "a\u0130.", "<|endoftext|>", "<|ENDOFTEXT|>", "<|startoftext|>", "x<|endoftext|>Y.", "X<|EndOfText|>.", "A.", "b,", " ", "\n"]
    texts = [*pieces, *("".join(r.choice(pieces) for _ in range(r.randint(1, 9))) for _ in range(400))]
    for text, ids in zip(texts, encoder.encode(texts), strict=True):
        assert ids.tolist() == plain.encode(text, add_special_tokens=False).ids
    assert encoder.encode(["<|endoftext|>"])[0].tolist() == [49407]


def test_words_are_looked_up_once_a_block(monkeypatch):
    from tokenizers import Tokenizer

    monkeypatch.setattr(token_files, "CACHED_WORDS", 60)
    r, plain = random.Random(3), Tokenizer.from_file(tokenizer_file())
    encoder = token_files._words(tokenizer_file(), "<u2")
    looked = []

    class Counted(dict):
        def get(self, word, default=None):
            looked.append(word)
            return super().get(word, default)

    stems = ["".join(r.choice("abe\u00f1\u0130\u00c9K0'\u0416") for _ in range(r.randint(1, 5))) for _ in range(40)] + ["", ".", ",", "...", "a.b", "\t", "[CLS]"]
    for k in range(40):
        texts = [r.choice(["", "\n", " "]).join(r.choice([" ", "\n", "  "]) + r.choice(stems) + r.choice(["", "", ".", ",", ".,"]) for _ in range(r.randint(0, 90))) for _ in range(r.randint(1, 8))]
        encoder.known, encoder.before = Counted(encoder.known), dict(encoder.before)
        looked.clear()
        got = encoder.encode(pa.array(["cut off", *texts]).slice(1))
        want = [plain.encode(t, add_special_tokens=False).ids for t in texts]
        assert [x.tolist() for x in got] == want
        words = {w for t in texts for w in t.replace("\n", " ").split(" ")}
        assert len(looked) == len(words) and words <= encoder.known.keys()
    assert token_files.WordEncoder(tokenizer_file(), "<u2").encode([]) == []


def test_token_files_round_trip(spark, tmp_path, monkeypatch):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(tokenizer_file())
    folder = f"file://{tmp_path}/out"
    manifest = token_files.write_tokens(odd_docs(spark), folder, tokenizer_file(), length=16)
    rows = sorted(token_files.read_tokens(spark, manifest, with_ids=True).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in rows] == sorted((r[0] for r in odd_rows()), key=lambda i: (i is None, i))
    at, texts = 0, defaultdict(list)
    for r in odd_rows():
        texts[r[0]].append([*plain.encode(r[1] or "", add_special_tokens=False).ids, 1])
    for r in rows:
        assert r["start"] == at and r["n_tokens"] == len(r["ids"]) and r["ids"] in texts[r["doc_id"]]
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
        at += r["n_tokens"]
    flat = [i for r in rows for i in r["ids"]]
    again = []
    for shard in manifest.orderBy("part").collect():
        for n in range(-(-shard["n_tokens"] // 16)):
            ids, mask = token_files.sequence(shard["path"], n)
            assert len(ids) == len(mask) == 16 and ids.base is not None
            again += ids[mask].tolist()
    assert again == flat


def test_token_files_of_no_rows(spark):
    assert token_files.tokenise(no_docs(spark), tokenizer_file()).collect() == []


PAGES = "page_id long, url string, html string, digest string, type int"


def odd_pages(spark):
    big = "<p>" + "é" * 40_000
    return spark.createDataFrame([
        (3, "u3", "<p>same", "d", 1), (2, "u\r\n2", "<p>same", "d", 1), (2, "u2", "<p>same", "d", 1), (4, None, None, None, None), (5, "u5", "", "d", 1),
        (6, "u6", big, "d", 1), (7, "u7", big, "d", 1), (None, "n", "<p>same", "d", 1), (8, "u8", "\r\n\r\n0\r\n\r\n", "d", 1),
    ], PAGES).repartition(2)


def test_archive_round_trip(spark, tmp_path):
    path = stored(odd_pages(spark), tmp_path)
    rows = warc.archive(spark, path, segment=1000, with_payload=False) if False else warc.read_warc(
        spark, warc.write_warc(spark, path, f"file://{tmp_path}/w", segment=1000), with_payload=True)
    rows = rows.collect()
    pages = odd_pages(spark).collect()
    assert len(rows) == len(pages) and all(r["error"] is None for r in rows)
    first = {}
    for p in sorted(pages, key=lambda p: (p["page_id"] is None, p["page_id"])):
        first.setdefault((p["html"] or ""), p["page_id"])
    want = sorted((str(p["page_id"]), len((p["html"] or "").encode()), warc.base32_sha1((p["html"] or "").encode())) for p in pages)
    assert sorted((str(r["page_id"]), r["payload_bytes"], r["payload_digest"]) for r in rows) == want
    assert sorted(r["page_id"] for r in rows if r["record_type"] == "response") == sorted(first.values())
    texts = {p["page_id"]: (p["html"] or "") for p in pages}
    for r in rows:
        assert r["refers_to"] == (first[texts[r["page_id"]]] if r["record_type"] == "revisit" else None)
        assert r["payload"] is None if r["record_type"] == "revisit" else r["payload"].decode() == texts[r["page_id"]]


def test_small_payloads_are_responses(spark, tmp_path):
    path = stored(odd_pages(spark), tmp_path)
    kinds = warc.archive(spark, path, revisit_bytes=100).groupBy("record_type").count().collect()
    assert {r["record_type"]: r["count"] for r in kinds} == {"response": 8, "revisit": 1}


def test_archive_of_no_rows(spark, tmp_path):
    assert warc.archive(spark, stored(odd_pages(spark).limit(0), tmp_path)).collect() == []


def test_segments_in_any_file_and_order(spark, tmp_path):
    records = list(warc.records_of(1, "u", b"x" * 5000, 5000, warc.base32_sha1(b"x" * 5000), None, False, segment=700))
    parts = {"shuffled": records[::-1], "missing": records[:-1], "repeated": [*records, records[-1]], "gap": [records[0], *records[2:]]}
    for name, own in parts.items():
        paths = []
        for i, r in enumerate(own):
            zipped = zlib.compressobj(1, zlib.DEFLATED, 31)
            data = r if i % 2 else zipped.compress(r) + zipped.flush()  # plain files and gzip members alike
            (tmp_path / f"{name}-{i}").write_bytes(data)
            paths.append((f"file://{tmp_path}/{name}-{i}", 1))
        got = warc.read_warc(spark, spark.createDataFrame(paths, warc.MANIFEST)).collect()
        assert len(got) == 1 and got[0]["payload_bytes"] == (5000 if name == "shuffled" else None)
        assert (got[0]["error"] is None) == (name == "shuffled")


def test_chunks():
    for n in (0, 1, 8192, 20_000):
        assert warc.unchunked(warc.chunked(b"a" * n)) == b"a" * n
    assert warc.unchunked(b"3;x=y\r\nabc\r\n0\r\nTrailer: 1\r\n\r\n") == b"abc"
    for bad in (b"", b"5\r\nabc", b"zz\r\n", b"3\r\nabc\r\n"):
        with pytest.raises(ValueError):
            warc.unchunked(bad)

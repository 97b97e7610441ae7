"""Mixing, quality, secrets, language and extraction: odd rows, brute force and held-out accuracy."""

import base64
import html
import itertools
import json
import random
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from brookmart.llm.extraction import blocks_of, costs, extract_text, graph, main_text, minimum_cut
from brookmart.llm.language import SuffixAutomaton, held_out, identify, learn
from brookmart.llm.mixing import mix_sources, targets
from brookmart.llm.quality import isotonic, score_quality, statistics
from brookmart.llm.secret_scan import base_spans, confirmed_spans, der_elements, is_der_key, pem_blocks, scan_secrets
from tests.llm.data import no_docs, odd_docs, odd_rows

SF = "/root/testdata/sf0.01"


# Mixing

def reshared(sizes: list[int], weights: list[float], budget: float, most: float) -> list[float]:
    """Shares by weight; what is above a limit is cut off and shared again until none is above."""
    out, open_ = [0.0] * len(sizes), set(range(len(sizes)))
    rest = budget * sum(sizes)
    while open_:
        w = sum(weights[i] for i in open_)
        over = {i for i in open_ if rest * weights[i] / w > most * sizes[i]}
        if not over:
            for i in open_:
                out[i] = rest * weights[i] / w
            break
        for i in over:
            out[i] = most * sizes[i]
            rest -= out[i]
        open_ -= over
    return out


def test_targets_are_those_of_repeated_sharing(spark):
    r = random.Random(3)
    for _ in range(4):
        names = [*(f"s{i:02d}" for i in range(r.randint(1, 12))), None]
        sizes = [r.choice([0, 1, 50, 5000, r.randint(1, 1000)]) for _ in names]
        want = reshared(sizes, [(5.0, 2.0, 1.0)[i % 3] for i in range(len(names))], 1.5, 2.0)
        rows = targets(spark.createDataFrame(list(zip(names, sizes)), "source string, source_size long")).collect()
        got = {x["source"]: x["target"] for x in rows}
        assert [got[n] for n in names] == pytest.approx(want)


def test_mix_of_odd_rows(spark):
    m = mix_sources(odd_docs(spark)).collect()
    assert len(m) == len(odd_rows())
    for source in {r["row"]["source"] for r in m}:
        own = [r for r in m if r["row"]["source"] == source]
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= 0.5
        assert sum(r["size"] for r in own) == own[0]["source_size"]
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in m)
    key = lambda r: (str(r["row"]), r["taken"])
    assert sorted(map(key, mix_sources(odd_docs(spark)).collect())) == sorted(map(key, m))
    assert mix_sources(no_docs(spark)).collect() == []


def test_mix_prefers_weight(spark):
    docs = spark.range(4000).selectExpr("id AS doc_id", "'a b c d' AS text", "'s' AS source", "IF(id < 2000, 1.0D, 0.25D) AS w")
    m = mix_sources(docs, weight="w", budget=0.5, most=2.0).groupBy(F.col("row.w")).agg(F.sum("taken").alias("t")).collect()
    taken = {r["w"]: r["t"] for r in m}
    assert taken[1.0] > 2 * taken[0.25]


# Quality

def test_isotonic_is_the_nearest_monotone_fit():
    r = np.random.default_rng(0)
    for _ in range(30):
        y, w = r.random(6), r.integers(1, 5, 6).astype(float)
        got = isotonic(y, w)
        assert (np.diff(got) >= -1e-12).all()
        # Brute force over all ways to cut into blocks of equal value.
        best = min(
            ((np.concatenate([np.full(b - a, np.average(y[a:b], weights=w[a:b])) for a, b in itertools.pairwise([0, *cuts, 6])]))
             for k in range(6) for cuts in itertools.combinations(range(1, 6), k)),
            key=lambda f: ((f - y) ** 2 * w).sum() if (np.diff(f) >= -1e-12).all() else np.inf)
        assert got == pytest.approx(best)


def test_statistics_are_finite():
    for t in ["", " ", "a", "\ud800", "漢" * 5000, "A" * 100_000, "\n" * 50]:
        assert np.isfinite(statistics(t)).all()


def test_quality_of_held_out_documents(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    got = score_quality(spark.read.parquet(f"{SF}/documents.parquet"), labels)
    rows = got.join(labels, "doc_id").where("held_out").collect()
    assert len(rows) > 30 and all(0 <= r["score"] <= 1 for r in rows)
    assert sum(r["predicted"] == r["quality"] for r in rows) >= 0.95 * len(rows)


def test_quality_of_odd_rows(spark):
    labels = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (8, None), (9, 0), (7, 1)], "doc_id long, quality int")
    rows = score_quality(odd_docs(spark), labels).collect()
    assert len(rows) == len(odd_rows())
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)
    unlabelled = score_quality(odd_docs(spark), labels.limit(0)).collect()
    assert {r["score"] for r in unlabelled} == {0.5}
    assert score_quality(no_docs(spark), labels).collect() == []


# Secrets

def der(tag: int, *parts: bytes) -> bytes:
    body = b"".join(parts)
    n = len(body)
    size = bytes([n]) if n < 128 else bytes([0x82]) + n.to_bytes(2, "big")
    return bytes([tag]) + size + body


ALGORITHM = der(0x30, der(0x06, b"\x2a\x86\x48\x86\xf7\x0d\x01\x01\x01"), der(0x05))
PRIVATE = der(0x30, der(0x02, b"\x00"), ALGORITHM, der(0x04, bytes(range(200))))


def test_base_patterns_follow_the_definition():
    texts = [
        "password=hunter2hunter2 token = 'abc' API-KEY:xx api_key: \"ABCDEFGHIJ\"", "secret=token:abcdefghij", "AKIA" + "A" * 12, "AKIA" + "A" * 11,
        "xAKIAAKIA0123456789", "a" * 31 + "g" + "f" * 32, "PASSWORD =abcdefgh", "paſſword=abcdefgh", "apikey  :  zzzzzzzz", "passwd\":\"12345678",
    ]
    assign = re.compile(r"(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])"
                        r"[\"']? *[:=] *[\"']?([A-Za-z0-9+/_.=-]+)")
    for t in texts:
        want = [(m.start(), 0, m.end()) for m in assign.finditer(t) if len(m[1]) >= 8]
        want += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 16]
        want += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 32]
        assert base_spans(t) == want


def test_structure_is_confirmed():
    b64 = base64.b64encode(PRIVATE).decode()
    header = base64.urlsafe_b64encode(json.dumps({"alg": "HS256", "typ": "JWT"}).encode()).decode().rstrip("=")
    other = base64.urlsafe_b64encode(json.dumps({"kid": "none at all"}).encode()).decode().rstrip("=")
    ssh = base64.b64encode(b"\0\0\0\x0bssh-ed25519\0\0\0\x20" + bytes(32)).decode()
    assert is_der_key(PRIVATE) and not is_der_key(PRIVATE[:-1]) and not is_der_key(PRIVATE + b"\0")
    assert der_elements(b"\x30\x84\xff\xff\xff\xff", 0, 6) is None
    kinds = lambda t: {k for _, k, _ in confirmed_spans(t)}
    assert kinds(f"-----BEGIN PRIVATE KEY-----\n{b64}\n-----END PRIVATE KEY-----") == {3}
    assert kinds(f"-----BEGIN PRIVATE KEY-----\n{b64[:-8]}\n-----END PRIVATE KEY-----") == set()
    assert kinds(f"key {b64} end") == {4} and kinds(f"key {b64[:-4]} end") == set() and kinds(f"k {ssh}") == {4}
    assert kinds(f"hex {PRIVATE.hex()}") == {5} and kinds(f"hex {PRIVATE.hex()[:-2]}") == set()
    assert kinds(f"bearer {header}.e30.c2ln") == {6} and kinds(f"bearer {other}.e30.c2ln") == set()
    assert kinds("x" * 100_000 + "." + "ey" * 50_000) == set()


def test_key_blocks_are_those_of_one_pattern_in_linear_time():
    pattern = re.compile(r"-----BEGIN ([A-Z0-9 ]*)-----([A-Za-z0-9+/=\s:,-]*?)-----END \1-----")
    pieces = ["-----BEGIN A-----", "-----END A-----", "-----BEGIN B-----", "-----END B-----", "BEGIN A-----", "END A-----", "-----END -----", "-----BEGIN -----",
              "-----", "-", "x", "\n", ".", " "]
    r = random.Random(4)
    for _ in range(20_000):
        text = "".join(r.choice(pieces) for _ in range(r.randint(1, 12)))
        assert list(pem_blocks(text)) == [(m.start(), m.end(), m[2]) for m in pattern.finditer(text)]
    assert confirmed_spans("-----BEGIN X-----" * 100_000) == []  # takes hours if each mark looks to the end of the text
    key = f"-----BEGIN PRIVATE KEY-----\n{base64.b64encode(PRIVATE).decode()}\n-----END PRIVATE KEY-----\n"
    assert len(confirmed_spans(key * 2_000)) == 2_000


def test_secrets_of_odd_rows(spark):
    rows = scan_secrets(odd_docs(spark)).collect()
    assert len(rows) == len(odd_rows()) and all(r["spans"] == "" and r["n_hex"] == 0 for r in rows)
    assert scan_secrets(no_docs(spark)).collect() == []


# Language

def test_automaton_accepts_exactly_the_substrings():
    r = random.Random(1)
    text = [r.randrange(3) for _ in range(40)]
    table = SuffixAutomaton(text, 4).table
    for n in range(1, 5):
        for s in itertools.product(range(3), repeat=n):
            state = 0
            for c in s:
                state = table[state, c] if state >= 0 else -1
            assert (state >= 0) == any(text[i:i + n] == list(s) for i in range(len(text)))


def test_phrases_are_those_of_a_plain_parse():
    from brookmart.llm.language import BLOCK, NARROW, Model

    samples = {"a": "the cat sat on the mat and the dog", "b": "le chat est sur la table et le chien"}
    model = Model(samples)

    def plain(text: str, sample: str) -> int:
        n = i = 0
        while i < len(text):
            k = 1
            while i + k < len(text) and text[i:i + k + 1] in sample:
                k += 1
            i, n = i + k, n + 1
        return n

    r = random.Random(6)
    texts = ["the cat", "le chien est la", "that chat " * 200, "x", "zzz the zzz", ""]
    # Phrases reach over borders of blocks, side by side and alone; one text is longer than all others.
    texts += [" ".join(r.choice(" ".join(samples.values()).split()) for _ in range(r.randint(50, 400))) for _ in range(2 * NARROW)]
    texts += ["the cat sat on the mat " * 3 * BLOCK]
    got = model.phrases(texts)
    for i, t in enumerate(texts):
        for j, name in enumerate(model.names):
            if set(t) <= set("".join(samples.values())):  # others are one symbol together
                assert round(got[i, j] * len(t)) == plain(t, samples[name])


SCRIPTS = [(0x61, 26), (0x3B1, 25), (0x430, 32), (0x5D0, 27), (0x627, 36), (0x905, 50), (0xE01, 46), (0x4E00, 900)]


def invented(seed: int, script: int, n: int) -> str:
    """Words of a language of its own, in the letters of a script."""
    first, letters = SCRIPTS[script]
    r = random.Random(seed)
    words = ["".join(chr(first + r.randrange(letters)) for _ in range(r.randint(2, 5))) for _ in range(60)]
    r = random.Random(f"{seed} {n}")
    return " ".join(r.choice(words) for _ in range(n))


def test_every_character_of_several_scripts_counts():
    from brookmart.llm.language import Model

    samples = {f"{k}-{script}": invented(10 * script + k, script, 500) for script in range(len(SCRIPTS)) for k in range(2)}
    model = Model(samples)
    texts = [invented(10 * script + k, script, 40) for script in range(len(SCRIPTS)) for k in range(2)]
    names, _ = model.predict(texts)
    assert names == [f"{k}-{script}" for script in range(len(SCRIPTS)) for k in range(2)]
    assert np.array_equal(np.tile(model.phrases(texts), (4, 1)), model.phrases(texts * 4))  # alone, and side by side
    got = model.phrases([*texts, "\u4e00\u4e01 unknown"])
    for i, t in enumerate([*texts, "\u4e00\u4e01 unknown"]):
        for j, name in enumerate(model.names):
            n = at = 0
            while at < len(t):
                k = 1
                while at + k < len(t) and t[at:at + k + 1] in samples[name]:
                    k += 1
                at, n = at + k, n + 1
            assert round(got[i, j] * len(t)) == n


def test_more_than_64_languages(spark):
    names = [f"l{k:02d}" for k in range(70)]
    docs = spark.createDataFrame([(k, invented(k, k % len(SCRIPTS), 200), n) for k, n in enumerate(names)], "doc_id long, text string, lang string")
    new = spark.createDataFrame([(k, invented(k, k % len(SCRIPTS), 30), n) for k, n in enumerate(names)], "doc_id long, text string, lang string")
    assert all(r["lang"] == r["lang_pred"] for r in identify(new, learn(docs), keep=["doc_id", "lang"]).collect())


def test_held_out_languages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = held_out(F.col("doc_id"), 3, 1)
    rows = identify(docs.where(out), learn(docs.where(~out)), keep=["doc_id", "lang"]).collect()
    assert len(rows) > 250 and sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.97 * len(rows)


def test_languages_of_odd_rows(spark):
    docs = odd_docs(spark)
    rows = identify(docs, learn(docs), keep=["doc_id", "text", "row"]).collect()
    assert len(rows) == len(odd_rows())
    for r in rows:
        assert (r["lang_pred"] == "und") == (not any(c.isalpha() for c in r["text"] or "")) and 0 <= r["score"] <= 1
    assert {r["lang_pred"] for r in identify(docs, ()).collect()} == {"und"}
    assert learn(no_docs(spark)) == () and identify(no_docs(spark), ()).collect() == []


# Extraction

def test_cut_is_minimal():
    r = random.Random(5)
    for _ in range(60):
        n = r.randint(1, 7)
        terminals = [(r.randint(0, 9), r.randint(0, 9)) for _ in range(n)]
        edges = [(i, j, r.randint(0, 6)) for i in range(n) for j in range(i + 1, n) if r.random() < 0.5]

        def cost(labels):
            return sum(b if k else a for k, (a, b) in zip(labels, terminals)) + sum(c for i, j, c in edges if labels[i] != labels[j])

        assert cost(minimum_cut(terminals, edges)) == min(map(cost, itertools.product([False, True], repeat=n)))


def test_main_text():
    page = (
        "<html><head><title>T</title><style>p{}</style></head><body class='has-sidebar'><header><h2>Site name</h2></header><nav><ul><li><a href=/>Home</a>"
        "<li><a href=/x>More</a></ul></nav><div class=cookie-notice>We use cookies, please agree to all of them now.</div><main><article><header><h1>Head&nbsp;line</h1>"
        "</header><p>First &amp; best\n\n  <b>bold</b> text of the story.<br>Next line<p>Short.<script>var t='</p>';</script><aside>Read also this other long story."
        "</aside><form>Name <input></form><div class=ad>Buy now!</div><p>&lt;End&gt;</p></article><section id=comments><p>I liked this article very much, thanks.</p>"
        "</section></main><!-- <p>no</p> --><footer>&copy; all rights</footer>"
    )
    assert main_text(page) == "Head\xa0line\nFirst & best bold text of the story. Next line\nShort.\n<End>"
    for odd in ["", "plain", "<", "<p", "<!--", "<script>", "<a href='", "</p></p>", "<p>&am", "<" * 3000, "<div>" * 3000]:
        assert isinstance(main_text(odd), str)
    assert main_text("<article><p>" + "word " * 50_000 + "</p>") == ("word " * 50_000).strip()


LONG = "This is a long paragraph of neutral prose, which has many words and ends as sentences end, with a stop."


def test_main_text_without_names():
    """Containers that no word list knows: paragraphs tell what theirs is, and short blocks learn it from there."""
    links = "".join(f"<p><a href=/{n}>Another link</a></p>" for n in range(4))
    page = f"<body><div class=c1>{links}</div><div class=c2><h1>Title</h1><p>{LONG}</p><p>Short.</p><p>{LONG}</p></div><div class=rail>{links}</div><div>(c) me</div></body>"
    text = f"Title\n{LONG}\nShort.\n{LONG}"
    assert main_text(page) == text
    assert main_text(page.replace("<body>", "<body><div id=wrap>").replace("</body>", "</div></body>")) == text
    parts = blocks_of(page)
    alone = [b.text for b in parts.blocks if costs(b)[0] > costs(b)[1]]
    assert alone == [LONG, LONG]  # the cut brings the title and the short paragraph
    assert main_text(f"<body><article class='search-result'><p>{LONG}</p><p>Ok.</p></article>") == f"{LONG}\nOk."
    assert main_text("<body><article id='news-related-post'><p>A</p></article>") == "A"
    assert main_text(f"<body><form id=aspnetForm><div class=content><p>{LONG}</p><p>Ok</p></div><p>{LONG}</p></form>") == f"{LONG}\nOk"
    assert main_text(f"<div class='layout has-sidebar'><div class=post><p>{LONG}</p></div><div class=sidebar><p>{LONG}</p></div></div>") == LONG
    menu = "<ul>" + "".join(f"<li><a href=/{n}>Menu {n}</a>" for n in range(5)) + "</ul>"
    animals = "<ul><li>ape<li>bear<li>cat</ul>"
    assert main_text(f"<article><p>{LONG}</p>{menu}<p><a href=/>Read it here</a></p>{animals}</article>") == f"{LONG}\nRead it here\nape\nbear\ncat"
    advert = f"<div class=ad><p>{LONG}</p><p>{LONG}</p></div>"
    assert main_text(f"<article>{advert}<p><a href=/>A</a></p>{advert}<aside>{LONG}</aside><p>B</p></article>") == "A\nB"


def test_cut_of_long_pages_is_fast():
    started = time.monotonic()
    for page in ("<ul>" + "<li>item one</li>" * 30_000 + "</ul>", f"<div><p>a <a>b c d</a></p><p>{LONG}</p></div>" * 10_000,
                 f"<article>{'<div>' * 300}" + f"<p>a b</p><p>{LONG}</p>" * 10_000):
        main_text(page)
    assert time.monotonic() - started < 60  # one search per path takes minutes


def test_articles_of_all_pages_are_extracted(spark):
    """Every page of the given table: its <article>, which has block tags inside, and nothing else."""
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    changed = 0
    for page_id, page in ((r["page_id"], r["html"]) for r in pages.collect()):
        article = re.search(r"<article>(.*)</article>", page, re.DOTALL)[1]
        pieces = (re.sub(r"[\x20\x09-\x0D]+", " ", html.unescape(re.sub(r"<[^>]*>", "", re.sub("<br>", " ", x)))).strip(" ")
                  for x in re.split(r"</?(?:p|h[1-6]|div|ul|ol|li|table|tr|td|th|blockquote|pre|section)(?: [^>]*)?>", article))
        assert main_text(page) == "\n".join(filter(None, pieces)), page_id
        parts = blocks_of(page)
        labels = minimum_cut(*graph(parts))
        changed += sum((costs(b)[0] > costs(b)[1]) != label for b, label in zip(parts.blocks, labels))
    assert changed > 0


def test_pages_of_odd_rows(spark):
    pages = spark.createDataFrame([(1, "u", "<article><p>A</p><p>B</p></article>", 1), (1, None, None, 2), (None, "u", "", 3)],
                                  "page_id long, url string, html string, text int")
    rows = {(r["page_id"], r["url"]): (r["text"], r["n_chars"]) for r in extract_text(pages).collect()}
    assert rows == {(1, "u"): ("A\nB", 3), (1, None): ("", 0), (None, "u"): ("", 0)}
    assert extract_text(pages.limit(0)).collect() == []

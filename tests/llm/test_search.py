"""Jaccard join, decontamination and the pipeline, against brute force."""

import random
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from brookmart.llm import decontamination as dec
from brookmart.llm import jaccard_join as jac
from brookmart.llm.components import components
from brookmart.llm.common import Scratch
from tests.llm.data import no_docs, odd_docs, odd_rows, prose

SF = "/root/testdata/sf0.001"


def sets_of(rows, words):
    out = []
    for i, t in rows:
        w = (t or "").encode().lower().split()
        out.append((i, frozenset(tuple(w[k:k + words]) for k in range(len(w) - words + 1)) if len(w) >= words else frozenset([tuple(w)] if w else [])))
    return out


def brute(rows, words=4, percent=85, count=False):
    """(doc_id, n, component) of each row by comparing all pairs; or the number of components."""
    sets = sets_of(rows, words)
    up = list(range(len(sets)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, (_, a) in enumerate(sets):
        for j, (_, b) in enumerate(sets[:i]):
            c = len(a & b)
            if c and 100 * c >= percent * (len(a) + len(b) - c):
                up[root(i)] = root(j)
    if count:
        return len({root(i) for i in range(len(sets))})
    ids = {}
    for i, (d, _) in enumerate(sets):
        ids.setdefault(root(i), []).append(d)
    return sorted(((d, len(s), min((x for x in ids[root(i)] if x is not None), default=None)) for i, (d, s) in enumerate(sets)), key=str)


def chain(seed: int, n: int) -> list[str]:
    """Copies of copies of one text, each with one more word changed."""
    r, words, out = random.Random(seed), prose(seed, 120).split(), []
    for i in range(n):
        words = list(words)
        words[r.randrange(120)] = f"w{i}"
        out.append(" ".join(words))
    return out


@pytest.fixture
def small_cells(monkeypatch):
    for name, value in {"LEAF": 3, "CHUNK": 4, "PIVOTS": 2, "ROUNDS": 3}.items():
        monkeypatch.setattr(jac, name, value)


def test_join_of_odd_rows(spark):
    got = jac.near_duplicates(odd_docs(spark), keep=["row", "doc_id", "text"]).collect()
    want = brute([(r[0], r[1]) for r in odd_rows()])
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got), key=str) == want
    texts = [r["row"]["text"] for r in got if r["stays"]]
    assert len(texts) == brute([(r[0], r[1]) for r in odd_rows()], count=True)
    assert jac.near_duplicates(no_docs(spark)).collect() == []


def test_recursion_and_blocks(spark, small_cells):
    rows = [(i, t) for i, t in enumerate(chain(1, 25) + chain(2, 3) + [prose(9, 50), "a b", "A  B", "b a"])]
    got = jac.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got), key=str) == brute(rows)


def test_local_join_equals_all_pairs():
    r = random.Random(4)
    for seed in range(6):
        texts = [t for k in range(4) for t in chain(10 * seed + k, r.randint(1, 30))]
        sets = [jac.shingle_set(t) for t in texts]
        roots = jac.join_cell(sets)
        want = {d: c for d, _, c in brute(list(enumerate(texts)))}
        for i in range(len(sets)):
            for j in range(i):
                assert (roots[i] == roots[j]) == (want[i] == want[j])


def test_shingle_hashes_tell_sets_apart():
    for text, words in (("a b c d e", 4), ("A b C d e", 4), ("a b", 4), ("", 4), (" \n ", 4), ("x y é z w", 3), ("a b a b a b", 2)):
        assert len(jac.shingle_set(text, words)) == len(sets_of([(0, text)], words)[0][1])
    assert (jac.shingle_set("A b\tc  D") == jac.shingle_set("a b c d")).all()
    assert jac.shingle_set("a b c")[0] != jac.shingle_set("a b c d")[0] and jac.shingle_set("ab c")[0] != jac.shingle_set("a bc")[0]


def test_anchors_of_linked_sets_meet():
    r = np.random.default_rng(0)
    common = np.sort(r.integers(0, 2**63, 30).astype(np.uint64))
    counts = r.integers(6, 90, 30)
    for _ in range(200):
        base = np.concatenate([r.integers(0, 2**63, 40).astype(np.uint64), r.choice(common, 10, replace=False)])
        a, b = np.unique(base), np.unique(np.concatenate([base[: 50 - r.integers(0, 5)], r.integers(0, 2**63, r.integers(0, 5)).astype(np.uint64)]))
        c = len(np.intersect1d(a, b))
        if jac.linked(c, len(a), len(b)):
            assert len(np.intersect1d(jac.anchors_of(a, common, counts), jac.anchors_of(b, common, counts)))


def test_regions_with_exact_copies_stay_apart(spark):
    members = {1: [-9, 5, 5, 9], 2: [-9, 6, 6, 9], 3: [-9, 6, 6, 9], 4: [-9, -9, 7, 7, 2**40, 2**40], 5: [-9, -9, 2**39, 2**39, 2**40, 2**40], 6: [5, 5]}
    rows = [(n, 4, anchor) for anchor, nodes in members.items() for n in nodes]
    got = jac.regions_of(spark.createDataFrame(rows, "node long, n long, anchor long")).collect()
    assert sorted((r["anchor"], r["m"]) for r in got) == [(1, 4), (2, 4), (4, 6), (5, 6)]


def test_components_of_paths_and_stars(spark):
    r = random.Random(0)
    names = [r.randrange(10**9) for _ in range(60)]
    edges = [*zip(names[:20], names[1:20]), *((names[20], x) for x in names[21:40]), (names[41], names[41])]
    got = {x["node"]: x["label"] for x in components(spark.createDataFrame(edges, "a long, b long"), Scratch(spark, "cc")).collect()}
    assert got == {**{n: min(names[:20]) for n in names[:20]}, **{n: min(names[20:40]) for n in names[20:40]}}


ITEMS = [(1, "Which river runs through the old town of Brindle? The name of the river is the Sarn and it has two bridges."), (2, "short item"),
         (3, None), (4, ""), (None, " ".join(f"word{i}" for i in range(80))), (5, "Which river runs through the old town of Brindle? The name of the river is the Sarn and it has two bridges.")]


def leaks(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    items = spark.createDataFrame([(*x, "q", 0) for x in ITEMS], "item_id long, text string, leak string, doc_id int")
    return {(r["doc_id"], r["item_id"]) for r in dec.leak_rows(dec.find_leaks(docs, items, ["doc_id"])).collect()}


def test_leaks(spark):
    first = ITEMS[0][1]
    changed = first.replace("old town", "ancient city").replace("two", "three")
    answer = "Tell me, what is the river in the town of Brindle? The name of the river is the Sarn and it has two bridges."
    got = leaks(spark, [first.upper(), prose(1, 300) + " " + first + " " + prose(2, 300), changed, answer, prose(3, 500), None, "", "a short ITEM, really",
                        "shorter items", ITEMS[4][1] + "!", " ".join(sorted(first.split())), first[:30]])
    assert got == {(0, 1), (0, 5), (1, 1), (1, 5), (2, 1), (2, 5), (3, 1), (3, 5), (7, 2), (9, None)}


def test_common_subsequence():
    def plain(a, b):
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i in range(len(a)):
            for j in range(len(b)):
                best[i + 1][j + 1] = best[i][j] + 1 if a[i] == b[j] else max(best[i][j + 1], best[i + 1][j])
        return best[-1][-1]

    r = random.Random(0)
    for _ in range(200):
        a, b = ([r.choice([b"a", b"b", b"c"]) for _ in range(r.randint(0, 80))] for _ in range(2))
        assert dec.common_subsequence(a, b) == plain(a, b)


def test_randomised_svd_finds_the_space(spark):
    r = np.random.default_rng(1)
    rows = [[int(x) for x in r.integers(0, 12, 5)] for _ in range(40)]
    idf = r.random(12) + 0.5
    a = np.zeros((40, 12))
    for k, ids in enumerate(rows):
        np.add.at(a[k], ids, idf[ids])
    basis = dec.randomised_svd(spark.createDataFrame([(x,) for x in rows], "ids array<int>"), idf, 4)
    _, _, want = np.linalg.svd(a)
    assert basis.shape == (12, 4) and np.abs(np.linalg.svd(want[:4] @ basis)[1] - 1).max() < 1e-6


def full_index(items, texts):
    """An index in the whole space of its items."""
    seen = [set(dec.words_of(t)) for t in texts]
    words = dec.vocabulary(items)
    return dec.Index(items, {w: sum(w in x for x in seen) for w in words}, len(texts), np.eye(len(words)))


def lexicon(r, n):
    return ["".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6)) for _ in range(n)]


def test_short_items_in_long_documents():
    r = random.Random(7)
    frequent, rare = lexicon(r, 150), lexicon(r, 6000)
    items = [(m, " ".join(r.sample(frequent, m)), None) for m in (8, 9, 10, 11, 12, 14, 16, 20)]
    ordinary = [" ".join(r.choice(frequent if r.random() < 0.3 else rare) for _ in range(400)) for _ in range(40)]
    texts = []
    for m, item, _ in items:
        for _ in range(10):
            words = r.sample(rare, 300)
            at = r.randrange(300)
            texts.append((m, " ".join([*words[:at], item, *words[at:]])))
    index = full_index(items, [*ordinary, *(t for _, t in texts)])
    for m, text in texts:
        assert m in {x[0] for x in index.leaks(text)}
    assert sum(len(index.leaks(t)) for t in ordinary) == 0
    changed = items[6][1].split()
    for i in (2, 6, 10, 14):
        changed[i] = rare[i]
    assert [x[0] for x in index.leaks(" ".join([*rare[100:300], *changed, *rare[300:500]]))] == [16]


def test_passages_of_long_items():
    r = random.Random(8)
    item, other = lexicon(r, 200), lexicon(r, 2000)
    index = full_index([(1, " ".join(item), None)], [" ".join(other)])
    for at in range(0, 140, 7):
        found = index.leaks(" ".join([*other[:150], *item[at:at + 60], *other[150:300]]))
        assert [x[0] for x in found] == [1] and found[0][2] >= dec.SHARE and found[0][4] < 210 and found[0][5] > 150
    assert index.leaks(" ".join([*other[:150], *item[50:62], *other[150:300]])) == []


def test_texts_searched_together(monkeypatch):
    r = random.Random(9)
    words, other = lexicon(r, 120), lexicon(r, 3000)
    items = [(m, " ".join([*r.sample(words, m), ". " + r.choice(words)]), None) for m in (9, 20, 40, 90)]
    items += [(200, " ".join(r.sample(words, 5)), None), (201, items[1][1], None), (202, " ".join(r.sample(words, 30)), "never seen " + other[0])]
    texts = ["", " .,", other[0]]
    for i in range(60):
        item = items[i % len(items)][1].split()
        changed = [other[i] if r.random() < i / 100 else w for w in item]
        # Halves of an item end one text and begin the next: no leak of either.
        texts += [" ".join([*r.sample(other, 30 * (i % 4)), *changed, "never seen " + other[0], *r.sample(other, 10 * (i % 3))]),
                  " ".join([*r.sample(other, 40), *item[:len(item) // 3]]), " ".join([*item[len(item) // 3:len(item) // 2], *r.sample(words, i)])]
    texts.insert(90, " ".join([*r.choices(other, k=3000), items[2][1], *r.choices(words, k=500)]))
    index = full_index(items, texts)
    calls = []
    close = index.close
    index.close = lambda ids, text: calls.append(len(ids)) or close(ids, text)
    alone = [index.leaks(t) for t in texts]
    for group in (1, 100, 1000, 10**6):
        monkeypatch.setattr(dec, "GROUP", group)
        calls.clear()
        together = list(index.leaks_of(iter(texts)))
        assert together == alone
    assert calls == [sum(len(dec.words_of(t)) for t in texts)]
    assert {x[0] for found in alone for x in found} == {i for i, *_ in items}


def test_words_shared_with_a_bag():
    r = random.Random(10)
    for _ in range(500):
        region, bag = r.choices("abcdef", k=r.randint(0, 12)), Counter(r.choices("abcdefgh", k=r.randint(0, 12)))
        n = sum((Counter(region) & bag).values())
        assert all(dec.shares(region, bag, least) == (n >= least) for least in (0, n - 0.5, n, n + 0.5, n + 1))


def test_leaks_of_odd_rows(spark):
    benchmark = spark.createDataFrame(ITEMS, "item_id long, text string")
    found = dec.find_leaks(odd_docs(spark), benchmark, ["doc_id", "row", "text"])
    assert found.count() == len(odd_rows()) and found.where("size(leaks) > 0").count() == 0
    assert dec.find_leaks(no_docs(spark), benchmark, ["doc_id"]).collect() == []
    assert dec.find_leaks(odd_docs(spark), benchmark.limit(0), ["doc_id"]).where("size(leaks) > 0").count() == 0


def test_leaks_equal_whole_text_search(spark):
    docs, items = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet").collect()
    want = {(d["doc_id"], i["item_id"]) for d in docs.collect() for i in items if i["text"] in (d["text"] or "")}
    got = {(r["doc_id"], r["item_id"]) for r in dec.leak_rows(dec.find_leaks(docs, spark.read.parquet(f"{SF}/benchmark.parquet"), ["doc_id"])).collect()}
    assert want and want <= got and len(got) <= len(want) + 2


def test_pipeline_stages(spark, tmp_path):
    docs, columns = odd_docs(spark), odd_docs(spark).columns
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(f"{tmp_path}/{k}")
        before, docs = docs, spark.read.parquet(f"{tmp_path}/{k}")
        if k < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns
        rows = docs.collect()
        if name == "language":
            assert len(rows) == sum(any(c.isalpha() for c in r[1] or "") for r in odd_rows())
        if name == "near copies":
            kept = [(r["doc_id"], r["text"]) for r in rows]
            assert len({c for _, _, c in brute(kept, 5, 80)}) == len(kept) < before.count()
        if name == "decontamination":
            assert len(rows) == before.count()
    assert docs.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and docs.count() > 0
    empty = no_docs(spark)
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, empty, SF).write.parquet(f"{tmp_path}/e{k}")
        empty = spark.read.parquet(f"{tmp_path}/e{k}")
        assert empty.count() == 0

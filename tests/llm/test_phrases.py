"""Phrase mining against counting every phrase."""

import random
import re
from collections import Counter

import numpy as np
import pytest

import brookmart.llm.phrases as phrases
from brookmart.llm.phrases import find_arcs, mine_phrases, salted, unite
from tests.llm.data import no_docs, odd_docs, odd_rows

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, longest, least, top):
    counts, totals = {}, Counter()
    for text, lang in rows:
        f = counts.setdefault(lang or "und", Counter())
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = tuple(re.findall(r"[^\x20\x09]+", piece))
            totals[lang or "und"] += len(w)
            f.update(w[i:i + k] for k in range(1, longest + 1) for i in range(len(w) - k + 1))
    out = set()
    for lang, f in counts.items():
        found = {p: a for p, a in f.items() if len(p) >= 2 and a >= least}
        inside = {(p[i:j], a) for p, a in found.items() for i in range(len(p)) for j in range(i + 2, len(p) + 1) if j - i < len(p)}
        scored = []
        for p, a in found.items():
            if any((p, b) in inside for b in [a]):
                continue
            score, k = min((1000 * a * totals[lang] // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(scored)[:top], 1):
            out.add((lang, rank, phrase.decode(), -a, l, r, totals[lang], -score))
    return out


def texts(seed, n):
    r = random.Random(seed)
    words = [*"abcdefgh", "É", "e\xa0f", "I", "i"]
    rows = []
    for i in range(n):
        text = " ".join(r.choice(words[: 3 + i % 10]) + r.choice(["", "", "", ".", "\n", "\t", "!?"]) for _ in range(r.randint(0, 60)))
        rows.append((text, r.choice(["en", "en", "en", "de", None, "und"])))
    return rows + [("the same line of words", "en")] * 40 + [(None, "en"), ("", None), ("x " * 300, "fr")]


@pytest.mark.parametrize("seed, shard, weight", [(1, 4 << 20, 1 << 20), (2, 200, 50), (3, 1500, 7)])
def test_against_brute_force(spark, monkeypatch, seed, shard, weight):
    # Tasks import the module anew, so small bounds must reach them by value.
    monkeypatch.setattr(phrases, "_prefixes", bounded(phrases._prefixes, weight))
    monkeypatch.setattr(phrases, "_shards", bounded_shards(shard))
    rows = texts(seed, 120)
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(4)
    for longest, least, top in ((5, 5, 2000), (3, 12, 7)):
        got = mine_phrases(docs, longest=longest, least=least, top=top).collect()
        assert len(got) == len(set(got)) > 5
        assert set(map(tuple, got)) == brute(rows, longest, least, top)


def bounded(real, weight):
    def prefixes(*args):
        import brookmart.llm.phrases as there

        there.RANGE_WEIGHT = weight
        return real(*args)

    return prefixes


def bounded_shards(size):
    real = phrases._shards

    def run(batches):
        import brookmart.llm.phrases as there

        there.SHARD_BYTES = size
        yield from real(batches)

    return run


def test_union_sums_and_tells_all_shards():
    a = np.array
    got = unite(3, 2, [7, 9], [a([1, 1, 2]), a([1, 2])], [a([4, 5, 4]), a([5, 4])], [a([2, 3, 1]), a([4, 1])], 3).to_pylist()
    assert [tuple(r.values())[:4] for r in got if r["shard"] is None] == [(3 << 24, 1, 5, 7)]
    told = [(r["shard"], r["level"], *(np.frombuffer(r[c], np.int64).tolist() for c in ("a", "b", "qs", "slots", "splits"))) for r in got if r["shard"]]
    assert told == [(7, 2, [1], [5], [3 << 24], [3], [1]), (9, 2, [1], [5], [3 << 24], [3], [1])]


def test_longer_phrases_stay_in_the_range_of_their_prefix_unless_it_is_hot():
    slot, split = phrases._prefixes(np.array([5, 6]), np.array([10, 5 * phrases.RANGE_WEIGHT]), 3)
    assert slot[0] == 3 and slot[1] >= phrases.OF_HOT and split.tolist() == [1, 6]


def test_arcs_are_found_among_the_kept():
    a = np.array
    assert find_arcs(a([5, 5, 6, 9]), a([1, 2, 1, 1]), a([6, 5]), a([1, 2])).tolist() == [-1, 1, 0, -1]
    assert find_arcs(a([5]), a([1]), a([], np.int64), a([], np.int64)).tolist() == [-1]


def test_a_hot_prefix_is_cut_by_the_next_word():
    parts = salted(np.arange(10_000), np.full(10_000, 8))
    assert min(Counter(parts.tolist()).values()) > 900
    assert not salted(np.arange(5), np.ones(5, np.int64)).any()


def test_odd_rows(spark):
    got = mine_phrases(odd_docs(spark), least=3).collect()
    assert set(map(tuple, got)) == brute([(r[1], r[2]) for r in odd_rows()], 5, 3, 2000)
    assert mine_phrases(no_docs(spark)).collect() == []
    assert mine_phrases(odd_docs(spark), least=10**9).collect() == []

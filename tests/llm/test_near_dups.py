from __future__ import annotations

import random
import re

import numpy as np
import pytest

from spendspark.llm import near_dups, textscan
from spendspark.llm.components import components

SCHEMA = "doc_id bigint, text string, key string, n bigint, rep string"


def words_of(text):
    return re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def shingle_set(text, k):
    w = words_of(text)
    if len(w) < k:
        return {tuple(w)} if w else set()
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}


def closure(ids, links):
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def brute(rows, k, percent):
    sets = {i: shingle_set(t, k) for i, t in rows}
    ids = sorted(sets)
    links = [
        (a, b) for x, a in enumerate(ids) for b in ids[x + 1 :]
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]
    component = closure(ids, links)
    return {i: (i, len(sets[i]), component[i], component[i] == i) for i in ids}


def run(spark, rows, **options):
    docs = spark.createDataFrame([(i, t, "x", 1, "y") for i, t in rows], SCHEMA)
    return near_dups.near_duplicates(docs, **options)


def corpus(seed, n_groups=25, singles=60):
    """Originals, edited copies at several distances, chains and short texts."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    texts = []
    for _ in range(n_groups):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([3, 8, 30, 120]))]
        for _ in range(rng.randint(1, 6)):
            copy = list(base)
            for _ in range(rng.randint(0, 3)):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            texts.append(" ".join(copy))
            if rng.random() < 0.5:
                base = copy
    texts += [" ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 40))) for _ in range(singles)]
    rng.shuffle(texts)
    return list(enumerate(texts, start=5))


@pytest.mark.parametrize(("k", "percent"), [(4, 80), (5, 80), (2, 60)])
def test_all_links_are_found(spark, k, percent):
    rows = corpus(k)
    found = {r["doc_id"]: tuple(r) for r in run(spark, rows, k=k, percent=percent).collect()}
    assert found == brute(rows, k, percent)


def test_a_large_group_of_near_copies_in_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(near_dups, "BLOCK", 16)
    rng = random.Random(3)
    base = [f"v{i}" for i in range(60)]
    texts = []
    for _ in range(150):
        copy = list(base)
        for _ in range(rng.randint(0, 3)):
            copy[rng.randrange(60)] = f"z{rng.random()}"
        texts.append(" ".join(copy))
    rows = list(enumerate(texts))
    found = {r["doc_id"]: tuple(r) for r in run(spark, rows, k=4, percent=80).collect()}
    assert found == brute(rows, 4, 80)


def test_nulls_empties_repeats_and_case(spark):
    rows = [
        (1, None), (2, ""), (3, " \n\t "), (4, "One two THREE four five"), (5, "one TWO three four five"), (6, "one two"),
        (7, "ONE  two"), (8, "É a b c d"), (9, "é a b c d"), (4, "One two THREE four five"), (None, "one two"), (None, None),
    ]
    out = run(spark, rows, k=4)
    assert out.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    found = sorted((tuple(r) for r in out.collect()), key=str)
    expected = [
        (1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (4, 2, 4, True), (4, 2, 4, True), (5, 2, 4, False),
        (6, 1, 6, True), (7, 1, 6, False), (8, 2, 8, True), (9, 2, 9, True), (None, 1, None, True), (None, 0, None, True),
    ]
    assert found == sorted(expected, key=str)


def test_an_id_with_an_empty_and_a_full_text(spark):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(1, ""), (1, text), (1, None), (2, text + " a"), (3, text + " b"), (4, " \n"), (4, "c " + text), (5, "alone")]
    found = {(r["doc_id"], r["component_id"]) for r in run(spark, rows, k=4).collect()}
    assert found == {(1, 1), (2, 1), (3, 1), (4, 1), (4, 4), (5, 5)}


def test_a_very_long_text_and_an_empty_table(spark):
    long = " ".join(f"x{i}" for i in range(300_000))
    found = [tuple(r) for r in run(spark, [(1, long), (2, long + " end")], k=5).orderBy("doc_id").collect()]
    assert found == [(1, 299_996, 1, True), (2, 299_997, 1, False)]
    assert run(spark, [], k=4).count() == 0


def test_sketches_fill_every_coordinate_and_agree_like_jaccard():
    rng = np.random.default_rng(1)
    shared, own = rng.integers(0, 2**63, 800, np.uint64), rng.integers(0, 2**63, 200, np.uint64)
    docs = np.concatenate([np.zeros(900, int), np.ones(900, int), [2]])
    values = np.concatenate([shared, own[:100], shared, own[100:], [np.uint64(7)]])
    s = near_dups.sketch(docs, values, 4, 1024)
    assert (s[:3] != near_dups.EMPTY).all() and (s[3] == near_dups.EMPTY).all()
    assert abs((s[0] == s[1]).mean() - 0.8) < 0.05


def test_scanned_words_and_windows_match_plain_python():
    import pyarrow as pa

    texts = ["", None, "a", " a  b ", "x\ny z\x0b", "é É ÀB", "word " * 50, "   ", "end"]
    data, offsets = textscan.text_bytes(pa.array(texts))
    runs = textscan.Runs(data, offsets, ~textscan.IS_SPACE)
    assert runs.count.tolist() == [len(words_of(t)) for t in texts]
    found = [bytes(data[a:b]).decode() for a, b in zip(runs.start, runs.end, strict=True)]
    assert [w.lower() if w.isascii() else w for w in found] == [
        w.lower() if w.isascii() else v for t in texts for w, v in zip(words_of(t), re.findall("[^\x20\x09-\x0d]+", t or ""), strict=True)
    ]
    hashes = runs.hashes()
    same = {}
    for t, h in zip((w for t in texts for w in words_of(t)), hashes.tolist(), strict=True):
        assert same.setdefault(t, h) == h
    assert len(set(same.values())) == len(same)


def test_components_of_chains_stars_and_cycles(spark):
    rng = random.Random(5)
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(1000, i) for i in range(900, 960)]
    loose = [(rng.randint(0, 80), rng.randint(0, 80)) for _ in range(50)]
    links = chain + star + loose + [(7, 7), (None, 3), (3, None)]
    rng.shuffle(links)
    found = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    real = [(a, b) for a, b in links if a is not None and b is not None and a != b]
    nodes = sorted({x for pair in real for x in pair})
    assert found == closure(nodes, real)
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0

"""Centroid clustering, closed syncmers and spelling variants against plain Python, and their edge cases."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from spendspark.llm import centroids, spelling, syncmers

# ---- centroid clustering -------------------------------------------------------------------


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int, cells int, cluster string")


def plain_clusters(rows, k, rounds, dims):
    kept = [(i, [int(np.floor(256 * v)) for v in e]) for i, e in rows if e and len(e) == dims and all(v is not None and np.isfinite(v) for v in e)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(), r[1]))
    centers = [c for _, c in order[:k]]

    def nearest(x):
        distances = [sum((a - b) ** 2 for a, b in zip(x, c)) for c in centers]
        return min((d, j) for j, d in enumerate(distances))

    for _ in range(rounds):
        groups = {}
        for _, x in kept:
            groups.setdefault(nearest(x)[1], []).append(x)
        for j, members in groups.items():
            centers[j] = [sum(c) // len(members) for c in zip(*members)]
    return sorted((str(i), *nearest(x)[::-1]) for i, x in kept), centers


@pytest.mark.parametrize("partitions", [1, 7])
def test_clusters_equal_brute_force(spark, partitions):
    rng = random.Random(3)
    heads = [[rng.uniform(-1, 1) for _ in range(6)] for _ in range(5)]
    rows = [(i, [h + rng.gauss(0, 0.2) for h in rng.choice(heads)]) for i in range(300)]
    rows += [(i, list(rows[0][1])) for i in range(300, 500)]  # a large group of copies
    rows += [(7, rows[3][1]), (None, rows[5][1]), (501, None), (502, [1.0] * 5), (503, [float("nan")] * 6), (504, [None] * 6), (505, [])]
    df = vectors(spark, [(i, e, None, 1, "x") for i, e in rows]).repartition(partitions)
    found = centroids.cluster(df, k=9, rounds=4, dims=6)
    want, centers = plain_clusters(rows, 9, 4, 6)
    got = sorted((str(r["id"]), r["cluster"], r["distance"]) for r in found.assigned.collect())
    assert got == want
    assert found.centroids.tolist() == centers
    out = centroids.with_inertia(found).collect()
    assert {r["inertia"] for r in out} == {sum(d for _, _, d in want)}
    assert all(r["centroid_sha256"] == hashlib.sha256(",".join(map(str, centers[r["cluster"]])).encode()).hexdigest() for r in out)


def test_few_no_and_too_large_vectors(spark):
    two = vectors(spark, [(1, [0.5, 0.0], None, 1, "x"), (2, [-0.5, 0.0], None, 1, "x")])
    found = centroids.cluster(two, k=40, rounds=2, dims=2)
    assert sorted(r["distance"] for r in found.assigned.collect()) == [0, 0]
    none = centroids.with_inertia(centroids.cluster(two.where("vec_id > 2"), dims=2))
    assert none.count() == 0 and "centroid_sha256" in none.columns
    with pytest.raises(ValueError, match="beyond"):
        centroids.cluster(vectors(spark, [(1, [1e30, 0.0], None, 1, "x")]), dims=2)


def test_large_components_stay_exact(spark):
    rows = [(i, [(1 << 18) + i / 256.0, -(1 << 18) + i * i / 256.0]) for i in range(50)]
    found = centroids.cluster(vectors(spark, [(i, e, None, 1, "x") for i, e in rows]), k=3, rounds=3, dims=2)
    want, _ = plain_clusters(rows, 3, 3, 2)
    assert sorted((str(r["id"]), r["cluster"], r["distance"]) for r in found.assigned.collect()) == want


# ---- closed syncmers -----------------------------------------------------------------------


def plain_anchors(text):
    p, words = syncmers.PRIME, [zlib.crc32(w.encode()) for w in re.findall(syncmers.WORD, text)]
    inner = [(a * syncmers.FACTOR + b) % p for a, b in zip(words, words[1:])]
    out = []
    for at in range(len(words) - 4):
        window = inner[at : at + 4]
        if min(window) in (window[0], window[-1]):
            value = words[at]
            for w in words[at + 1 : at + 5]:
                value = (value * syncmers.SPREAD + w) % p
            out.append((at, value))
    return out


def documents(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, text string, range int, guest boolean, found string")


def texts():
    rng = random.Random(5)
    words = ["ab", "cd", "é", "😀x", "w" * 40, "the", "of", "x1"]
    return [" ".join(rng.choice(words) for _ in range(n)) for n in [0, 1, 3, 4, 5, 6, 30, 200, 3000]] + ["a" * 100_000, "\n\t \n"]


def test_anchors_equal_brute_force(spark):
    rows = [(i, t, 1, True, "x") for i, t in enumerate(texts())] + [(50, None, 1, True, "x")]
    got = {r["id"]: r for r in syncmers.fingerprints(documents(spark, rows)).collect()}
    for i, text, *_ in rows:
        want = plain_anchors(text or "")
        assert [(a["at"], a["anchor"]) for a in got[i]["anchors"]] == want
        values = [v for _, v in want] or ([zlib.crc32(text.encode())] if text else [])
        assert got[i]["fingerprint"] == "".join(f"{v + (1 << 32):X}" for v in values)


def plain_edits(rows):
    rows = sorted(((i, t or "") for i, t, *_ in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    likeness = lambda a, b: 1.0 if not a | b else 2 * len(a & b) / (len(a) + len(b))
    values = lambda t: {v for _, v in plain_anchors(t)} or ({zlib.crc32(t.encode())} if t else set())
    out = []
    for n, (i, text) in enumerate(rows):
        following = rows[(n + 1) % len(rows)][1]
        lost = len(text) // 4
        edited = text[: len(text) - lost] + following[:lost]
        near = likeness(values(text), values(edited)), likeness(values(text), values(following))
        out.append((str(i), len(text), hashlib.sha256(edited.encode()).hexdigest(), *near))
    return sorted(out)


@pytest.mark.parametrize("ids", ["distinct", "sparse", "shared", "missing"])
def test_edits_and_neighbours_equal_brute_force(spark, ids):
    make = {"distinct": lambda i: i, "sparse": lambda i: -(i**5), "shared": lambda i: i // 4, "missing": lambda i: i if i % 3 else None}[ids]
    rows = [(make(i), t, 1, True, "x") for i, t in enumerate(texts() * 3)]
    rows = [(i, t + f" {n}", *rest) if ids == "distinct" else (i, t, *rest) for n, (i, t, *rest) in enumerate(rows)]
    out = syncmers.against_edits(documents(spark, rows).repartition(3)).collect()
    got = sorted((str(r["id"]), r["n_chars"], r["edited_sha256"], r["near_edited"], r["near_next"]) for r in out)
    assert got == plain_edits(rows)


def test_one_and_no_documents(spark):
    one = syncmers.against_edits(documents(spark, [(1, "a b c d e f g h", 1, True, "x")])).collect()
    assert [(r["id"], r["near_next"]) for r in one] == [(1, 1.0)]
    assert syncmers.against_edits(documents(spark, [])).count() == 0


def test_places_of_shared_passages(spark):
    rng = random.Random(9)
    made = lambda n: " ".join(str(rng.randrange(10**6)) for _ in range(n))
    passage = made(60)
    left = syncmers.fingerprints(documents(spark, [(1, f"{made(30)} {passage}", 1, True, "x")]))
    right = syncmers.fingerprints(documents(spark, [(2, f"{made(10)} {passage} {made(9)}", 1, True, "x")]))
    found = syncmers.matches(left, right).collect()
    assert [(r["left_id"], r["right_id"], r["shift"]) for r in found] == [(1, 2, -20)] and found[0]["n"] > 15


def test_fingerprints_need_no_python(spark):
    plan = syncmers.against_edits(documents(spark, [(1, "a", 1, True, "x")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


# ---- spelling variants ---------------------------------------------------------------------


def is_near(a, b):
    """One inserted, deleted or replaced code point, by trying them."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) == len(short) + 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def plain_groups(rows, least=5):
    lower = str.maketrans(spelling.UPPER, spelling.LOWER)
    counts = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(lower)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            counts[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 199 == 0 else run] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= 6 and n >= least}
    form, near = {}, {}
    for w, n in counts.items():
        others = sorted((-counts[o], o) for o in counts if is_near(w, o))
        near[w] = len(others)
        form[w] = others[0][1] if others and -others[0][0] >= 5 * n else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return sorted((w, str(form[w]), root(w), n, near[w], str(counts.get(form[w]))) for w, n in counts.items())


def test_groups_equal_brute_force(spark):
    rng = random.Random(11)
    stems = ["".join(rng.choice("abé") for _ in range(n)) for n in (6, 6, 7, 7, 8, 9, 12, 13) for _ in range(4)]
    words = []
    for stem in stems:
        word, n = stem, rng.choice([600, 40, 5])
        while n >= 1 and len(word) >= 5:
            words += [word.title() if rng.random() < 0.2 else word] * n
            at, kind = rng.randrange(len(word)), rng.randrange(3)
            word = word[:at] + ("" if kind == 0 else rng.choice("abcÿ")) + word[at + (kind < 2) :]
            n //= rng.choice([1, 5, 6])
    rng.shuffle(words)
    rows = [(i if i % 9 else None, " ".join(words[i::40])) for i in range(40)] + [(41, None), (42, ""), (42, "short 12")]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id bigint, text string, word string, n int")
    out = spelling.group_variants(df)
    got = sorted((r["word"], str(r["form"]), r["root"], r["n"], r["n_near"], str(r["form_n"])) for r in out.collect())
    want = plain_groups(rows)
    assert got == want
    assert any(r[1] != r[2] and r[1] != "None" for r in want), "no chain of two forms in the fixture"


def test_every_single_edit_is_found(spark):
    base = ["abcdef", "aaaaaa", "abababab", "abcdefghijklm"]
    words = set(base)
    for w in base:
        for i in range(len(w) + 1):
            words |= {w[:i] + c + w[i:] for c in "az"} | ({w[:i] + w[i + 1 :], w[:i] + "z" + w[i + 1 :]} if i < len(w) else set())
    words = sorted(words)
    pairs = spelling.near_pairs(spark.createDataFrame([(w, i) for i, w in enumerate(words)], "word string, n bigint"))
    got = {frozenset((r["a"], r["b"])) for r in pairs.collect()}
    assert got == {frozenset((a, b)) for a in words for b in words if a < b and is_near(a, b)}
    assert pairs.count() == len(got)


def test_chains_of_many_forms(spark):
    words = ["aaaaaa", "baaaaa", "bbaaaa", "bbbaaa", "bbbbaa", "bbbbba"]
    table = spark.createDataFrame([(w, 5 * 5**i) for i, w in enumerate(words)], "word string, n bigint")
    rooted = spelling.with_roots(spelling.forms(table))
    assert {r["root"] for r in rooted.collect()} == {"bbbbba"}


def test_no_words_and_short_words(spark):
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert spelling.group_variants(empty).count() == 0
    assert spelling.group_variants(empty.select("doc_id", F.lit("ab cd").alias("text"))).count() == 0
    with pytest.raises(ValueError, match="four"):
        spelling.group_variants(empty, least_length=3)

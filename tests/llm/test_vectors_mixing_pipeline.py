from __future__ import annotations

import math
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from spendspark.llm import embeddings, mixing

VECTORS = "vec_id bigint, embedding array<float>, label int, grp string, links string"


def vectors(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], g, "g", "l") for i, v, g in rows], VECTORS)


def brute(rows, threshold):
    ok = [
        (i, np.float32(v).astype(float), g) for i, v, g in rows
        if i is not None and g is not None and v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)
    ]
    links = {i: [] for i, _, _ in rows}
    for a in range(len(ok)):
        for b in range(len(ok)):
            (i, u, g), (j, v, h) = ok[a], ok[b]
            if a != b and g == h and len(u) == len(v) and u @ v / math.sqrt((u @ u) * (v @ v)) >= threshold:
                links[i].append(j)
    root = {i: i for i in links}
    changed = True
    while changed:
        changed = False
        for i, others in links.items():
            best = min([root[i], *(root[j] for j in others)]) if i is not None else None
            if best != root[i]:
                root[i], changed = best, True
    return sorted(((i, len(links[i]), root[i], i is None or root[i] == i) for i, _, _ in rows), key=str)


def run(spark, rows, **options):
    out = embeddings.near_vectors(vectors(spark, rows), **options)
    return sorted((tuple(r) for r in out.collect()), key=str)


@pytest.mark.parametrize(("dim", "block"), [(4, 16), (24, 1024)])
def test_all_pairs_within_range_are_found(spark, monkeypatch, dim, block):
    monkeypatch.setattr(embeddings, "BLOCK", block)
    rng = np.random.default_rng(dim)
    rows, i = [], 10
    for g in (0, 1):
        for _ in range(30):
            center = rng.normal(size=dim)
            for _ in range(rng.integers(1, 6)):
                rows.append((i, list(center + rng.normal(size=dim) * rng.choice([0.0, 0.05, 0.12])), g))
                i += 1
    assert run(spark, rows, threshold=0.98) == brute(rows, 0.98)


def test_odd_vectors_link_with_nothing(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1, 0], 5), (2, [2, 0], 5), (3, [1, 0], 5), (4, [1, 0], 6), (5, [1, 0], None), (6, [0, 0], 5), (7, None, 5), (8, [nan, 1], 5),
        (9, [inf, 1], 5), (10, [None, 1], 5), (11, [], 5), (12, [1, 0, 0], 5), (13, [-1, 0], 5), (14, [1, -0.0], 5), (None, [1, 0], 5),
        (15, [1e-30, 0], 5),
    ]
    assert run(spark, rows) == brute(rows, 0.98)
    assert run(spark, []) == []
    assert run(spark, [(1, None, 1)]) == [(1, 0, 1, True)]


def test_copies_go_wherever_a_near_vector_may_be():
    rng = np.random.default_rng(9)
    x = embeddings.unit(rng.normal(size=(600, 3)))
    pivots = embeddings.spread_pivots(x[:100], 12)
    home, needed = embeddings.cells(x, pivots, 0.2)
    near = np.sqrt(np.maximum(2 - 2 * x @ x.T, 0)) <= 0.2
    for i, j in zip(*np.nonzero(near), strict=True):
        assert needed[j, home[i]]
    assert needed.mean() < 0.7


def docs_frame(spark, rows):
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, mix_copy string, doc string"
    return spark.createDataFrame([(i, t, "en", s, len(t or ""), "m", "d") for i, t, s in rows], schema)


def shares_of(spark, tokens):
    rows = [(f"s{i}", t, t / sum(tokens)) for i, t in enumerate(tokens)]
    return spark.createDataFrame(rows, "source string, tokens bigint, share double")


def test_the_exponent_meets_an_entropy(spark):
    tokens = [1000, 300, 50, 10]
    a = mixing.find_exponent(shares_of(spark, tokens), entropy_share=0.9)
    w = np.array(tokens, float) ** a
    w /= w.sum()
    assert -(w * np.log(w)).sum() / math.log(4) == pytest.approx(0.9, abs=1e-6)
    assert mixing.find_exponent(shares_of(spark, tokens), entropy_share=1.0) == pytest.approx(0.0, abs=1e-4)
    assert mixing.find_exponent(shares_of(spark, tokens), entropy_share=0.1) == 1.0
    assert mixing.find_exponent(shares_of(spark, [5, 5]), entropy_share=1.0) == 1.0
    assert mixing.find_exponent(shares_of(spark, [5]), entropy_share=0.5) == 1.0


def test_the_exponent_keeps_a_repetition_limit(spark):
    tokens = [1000, 300, 50, 10]
    share = np.array(tokens) / sum(tokens)
    a = mixing.find_exponent(shares_of(spark, tokens), max_repeats=3.0)
    assert (100.0) ** (1 - a) == pytest.approx(3.0, rel=1e-6)
    a = mixing.find_exponent(shares_of(spark, tokens), max_repeats=2.0, budget_share=0.5)
    w = share**a / (share**a).sum()
    assert (0.5 * w / share).max() == pytest.approx(2.0, rel=1e-6)


@pytest.mark.parametrize(("blocks", "budget"), [(4, None), (64, 0.7), (1, 1.3)])
def test_mixed_sources_reach_their_quotas(spark, blocks, budget):
    rng = np.random.default_rng(blocks)
    sizes = {"big": 300, "mid": 60, "low": 20}
    rows = [(i, " ".join(["w"] * int(rng.integers(1, 30))), s) for i, s in enumerate(s for s, n in sizes.items() for _ in range(n))]
    docs = docs_frame(spark, rows)
    options = {"max_repeats": 2.5, "budget_share": budget}
    out = mixing.mixed_rows(docs, blocks=blocks, **options).select("doc.*", F.col("mix_copy").alias("copy"), "mix_order").collect()
    tokens = {s: sum(len(t.split()) for _, t, x in rows if x == s) for s in sizes}
    shares = shares_of(spark, list(tokens.values()))
    quota = {r["tokens"]: r["quota"] for r in mixing.quotas(shares, mixing.find_exponent(shares, **options), budget).collect()}
    for s in sizes:
        used = [r for r in out if r["source"] == s]
        total = sum(len(r["text"].split()) for r in used)
        assert quota[tokens[s]] <= total < quota[tokens[s]] + 30
        counts = {}
        for r in used:
            counts.setdefault(r["doc_id"], []).append(r["copy"])
        every = [len(counts.get(i, [])) for i, _, x in rows if x == s]
        assert max(every) - min(every) <= 1 and all(sorted(c) == list(range(len(c))) for c in counts.values())
    assert all(0 <= r["mix_order"] <= 1 for r in out)


def test_mixing_keeps_odd_rows(spark):
    rows = [(1, None, None), (2, "", "a"), (2, "", "a"), (None, "one two", "a"), (3, "x " * 5000, "b"), (4, "none", "none")]
    out = mixing.mix(docs_frame(spark, rows), max_repeats=1.0)
    assert sorted(((r["doc_id"], r["source"]) for r in out.collect()), key=str) == sorted(((i, s) for i, _, s in rows), key=str)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "doc", "mix_copy", "mix_order"]
    assert mixing.mix(docs_frame(spark, []), max_repeats=2.0).count() == 0


def test_stages_of_the_pipeline(spark):
    from .test_lines_and_files import brute_lines, check_packing
    from .test_near_dups import brute as brute_copies

    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(os.path.join(folder, "documents.parquet"))
    seen, last = {}, docs
    for name, stage in corpus_pipeline.STAGES:
        given = last
        last = _stored(stage(spark, given, folder))
        seen[name] = (given, last)
        if name != "packing":
            assert last.columns == docs.columns
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language", "line_dedup", "near_dups", "mixing", "packing"]
    rows = lambda df, *c: [tuple(r) for r in df.select(*c).collect()]

    given, out = seen["language"]
    gone = set(rows(given, "doc_id", "text")) - set(rows(out, "doc_id", "text"))
    assert len(gone) <= 0.02 * given.count()
    given, out = seen["line_dedup"]
    assert sorted(rows(out, "doc_id", "text")) == sorted((i, t) for i, _, _, t in brute_lines(rows(given, "doc_id", "text"), 40, 5))
    assert out.where(F.col("n_chars") != F.char_length("text")).isEmpty()
    given, out = seen["near_dups"]
    kept = {i for i, _, _, stays in brute_copies(rows(given, "doc_id", "text"), 5, 80).values() if stays}
    assert sorted(rows(out, "doc_id")) == sorted((i,) for i in kept)
    given, out = seen["mixing"]
    assert set(rows(out, "doc_id", "text")) == set(rows(given, "doc_id", "text"))
    given, out = seen["packing"]
    bins, least = check_packing(rows(given, "doc_id", "text"), out, 4096)
    assert bins <= 1.02 * least + 1


def _stored(df):
    from spendspark.session import materialise

    return materialise(df, "stage-under-test")


def test_the_pipeline_bears_odd_rows(spark, tmp_path):
    rows = [(1, None, None), (2, "", "a"), (None, "plain words of a text", "a"), (3, "same words here now " * 30, "b"),
            (4, "same words here now " * 30, "b"), (4, "same words here now " * 30, "b"), (5, "12 34", None)]
    for name, data in (("odd", rows), ("none", [])):
        docs_frame(spark, data).write.parquet(str(tmp_path / name / "documents.parquet"))
        out = corpus_pipeline.run(spark, str(tmp_path / name))
        assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
        ids = {r["doc_id"] for r in out.collect()}
        assert ids == ({None, 3} if data else set())

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from spendspark.llm import line_dedup, packing, token_files

SCHEMA = "doc_id bigint, text string, drop string, line int, ids string"
BYTE, WORD = (public_tokenizers.path(x) for x in ("byte_bpe_50k.json", "word_bpe_49k.json"))


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "d", 1, "x") for i, t in rows], SCHEMA)


def key_of(line):
    return re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(" \t\n\x0b\x0c\r"))


def brute_lines(rows, min_chars, min_docs):
    holders = {}
    for i, text in rows:
        for line in (text or "").split("\n"):
            if i is not None and len(key_of(line)) >= min_chars:
                holders.setdefault(key_of(line), set()).add(i)
    last = {k: max(ids) for k, ids in holders.items() if len(ids) >= min_docs}
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        stay = [x for x in lines if i is None or last.get(key_of(x), i) == i]
        out.append((i, len(lines), len(lines) - len(stay), "\n".join(stay)))
    return sorted(out, key=str)


def dedup(spark, rows, **options):
    out = line_dedup.dedup_lines(frame(spark, rows), **options)
    assert out.columns == ["doc_id", "n_lines", "n_dropped", "kept_text"]
    return sorted((tuple(r) for r in out.collect()), key=str)


def test_shared_lines_go_from_all_but_the_last_document(spark):
    rng = random.Random(2)
    pool = [f"Shared Line {i} " + "é" * (i % 3) + "x" * 10 for i in range(12)] + ["short"]
    rows = []
    for i in range(60):
        lines = [rng.choice(pool) if rng.random() < 0.5 else f"own line {rng.random()}" for _ in range(rng.randint(0, 6))]
        lines = [rng.choice(["", " ", "\t", "\r"]) + (x.upper() if rng.random() < 0.3 else x) + rng.choice(["", "  "]) for x in lines]
        rows.append((i, "\n".join(lines)))
    assert dedup(spark, rows, min_chars=10, min_docs=5) == brute_lines(rows, 10, 5)


def test_line_edges(spark):
    long = "y" * 40
    rows = [
        (1, None), (2, ""), (3, "\n"), (4, f"{long}\n{long}"), (5, f" {long.upper()}\n\nkeep"), (5, f" {long.upper()}\n\nkeep"),
        (5, f"other\n{long}"), (6, long), (7, f"{long}\r"), (8, f"a\n{long}\x0b\nb\n{long}"), (None, long), (None, None),
        (9, "É" + "a" * 39), (10, "é" + "a" * 39),
    ]
    assert dedup(spark, rows) == brute_lines(rows, 40, 5)
    assert dedup(spark, []) == []


def test_a_document_of_very_many_shared_lines(spark):
    lines = "\n".join(f"{i:040d}" for i in range(20_000))
    rows = [(i, lines) for i in range(5)]
    assert [r[1:3] for r in dedup(spark, rows)] == [(20_000, 20_000)] * 4 + [(20_000, 0)]


def texts(seed, n=80):
    rng = random.Random(seed)
    pool = ["alpha", "Beta", "gamma,", "don't", "ÉCOLE", "日本", "x1", "…", "\n", "  "]
    rows = [(i * 3, " ".join(rng.choice(pool) for _ in range(rng.randint(0, 400)))) for i in range(n)]
    rows += [(1, None), (2, ""), (4, " "), (5, "word " * 9000)]
    rng.shuffle(rows)
    return rows


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    rows, path = texts(1), str(tmp_path_factory.mktemp("orc") / "ids")
    token_files.write_token_files(frame(spark, rows), path, BYTE, end_id=2)
    return rows, path


def test_files_give_back_the_ids_in_order(spark, stored):
    rows, path = stored
    files = token_files.read_token_files(spark, path)
    back = token_files.with_positions(files.drop("ids")).join(files.select("doc_id", "ids", token_files.ids_crc32("ids").alias("crc")), "doc_id")
    tokenizer, start = Tokenizer.from_file(BYTE), 0
    found = {r["doc_id"]: r for r in back.collect()}
    assert len(found) == len(rows)
    for i, text in sorted(rows):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        r = found[i]
        assert (r["start"], r["n_tokens"], r["ids"]) == (start, len(ids), ids)
        assert r["crc"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)


def test_files_hold_ascending_ranges_indexes_and_bloom_filters(spark, stored):
    _, path = stored
    files = token_files.read_token_files(spark, path)
    spans = files.groupBy("part").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b")).orderBy("part").collect()
    assert len(spans) > 1 and all(x["b"] < y["a"] for x, y in zip(spans, spans[1:], strict=False))
    plan = token_files.read_token_files(spark, path, F.col("doc_id").isin(3, 6))._jdf.queryExecution().toString()
    assert "PushedFilters: [In(doc_id, [3,6])]" in plan
    assert [r["doc_id"] for r in token_files.read_token_files(spark, path, F.col("doc_id") == 6).collect()] == [6]
    jvm = spark._jvm
    name = files.inputFiles()[0]
    conf = spark._jsc.hadoopConfiguration()
    orc = jvm.org.apache.orc.OrcFile
    reader = orc.createReader(jvm.org.apache.hadoop.fs.Path(name), orc.readerOptions(conf))
    assert reader.getRowIndexStride() == 1000
    kinds = {
        s.getKind().toString()
        for s in reader.rows().readStripeFooter(reader.getStripes()[0]).getStreamsList()
    }
    assert "ROW_INDEX" in kinds and "BLOOM_FILTER_UTF8" in kinds


def test_ids_that_repeat_are_missing_or_whole_tables_that_are_empty(spark, tmp_path):
    rows = [(None, "b"), (1, "c"), (1, "a"), (None, None)]
    token_files.write_token_files(frame(spark, rows), str(tmp_path / "a"), BYTE, end_id=2)
    back = token_files.with_positions(token_files.read_token_files(spark, str(tmp_path / "a")).drop("ids"))
    assert [tuple(r) for r in back.orderBy("start").select("doc_id", "start", "n_tokens").collect()] == [
        (None, 0, 1), (None, 1, 2), (1, 3, 2), (1, 5, 2),
    ]
    token_files.write_token_files(frame(spark, []), str(tmp_path / "b"), BYTE, end_id=2)
    assert token_files.read_token_files(spark, str(tmp_path / "b")).count() == 0


def check_packing(rows, out, capacity, tokenizer=None):
    tokenizer = tokenizer or Tokenizer.from_file(WORD)
    expected = []
    for i, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        for p in range(0, len(ids), capacity):
            part = ids[p : p + capacity]
            expected.append((i, p // capacity, p, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    found = out.select("doc_id", "piece", "start", "length", "ids_crc32").collect()
    assert sorted(map(tuple, found), key=str) == sorted(expected, key=str)
    bins = {}
    for r in out.collect():
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins), -(-sum(x[3] for x in expected) // capacity)


def test_packing_places_every_piece_once(spark):
    rows = texts(2, 300)
    out = packing.pack_documents(frame(spark, rows), WORD, end_id=1, capacity=4096)
    bins, least = check_packing(rows, out, 4096)
    assert bins <= least + 1


def test_rounds_of_residual_packing_come_close_to_the_bound(spark):
    rows = [(i, t) for i, t in texts(3, 300)]
    rows += [(1, None), (None, "a b"), (None, "a b"), (1, "twice")]
    out = packing.pack_documents(frame(spark, rows), WORD, end_id=1, capacity=700, group_items=100, fan_in=2)
    bins, least = check_packing(rows, out, 700)
    sizes = np.array([r["length"] for r in out.collect()])
    at_once = packing.best_fit(sizes, 700)[0].max() + 1
    assert least <= bins <= 1.06 * at_once + 1
    assert packing.pack_documents(frame(spark, []), WORD, end_id=1).count() == 0


def test_items_that_share_no_bin_do_not_gather_in_one_group(spark, monkeypatch):
    sizes = []
    round_task = packing._round_task

    def counted(capacity, level):
        sizes.append(level)
        return round_task(capacity, level)

    monkeypatch.setattr(packing, "_round_task", counted)
    large = spark.range(1000).select(F.col("id").alias("item"), F.lit(60).cast("bigint").alias("length"))
    out = packing.pack(large, 100, group_items=50, fan_in=8)
    assert out.agg(F.count_distinct("sequence_id"), F.max("offset")).first() == (1000, 0)
    assert sizes == [0]
    # Items that fill bins go on until few are left.
    sizes.clear()
    small = spark.range(2000).select(F.col("id").alias("item"), (F.col("id") % 37 + 1).alias("length"))
    out = packing.pack(small, 100, group_items=50, fan_in=8)
    assert out.count() == 2000 and len(sizes) > 1
    assert out.select("sequence_id").distinct().count() <= 1.03 * -(-small.agg(F.sum("length")).first()[0] // 100)


def test_best_fit_takes_the_fullest_bin():
    bins, offset = packing.best_fit(np.array([4, 7, 3, 6]), 10)
    assert bins.tolist() == [1, 0, 0, 1] and offset.tolist() == [6, 0, 7, 0]


def test_digest_of_kept_text(spark):
    from spendspark.llm.queries import op10_line_dedup

    out = op10_line_dedup(spark, "/root/testdata/sf0.001")
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    expected = {i: (n, d, hashlib.sha256(t.encode()).hexdigest()) for i, n, d, t in brute_lines([tuple(r) for r in docs], 40, 5)}
    assert {r["doc_id"]: tuple(r)[1:] for r in out.collect()} == expected

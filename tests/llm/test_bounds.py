"""Words made to collide, samples of fixed size, and limits that must not drop anything silently."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from spendspark.llm import language, near_dups, textscan
from spendspark.llm.sampling import smallest_hashes


def thue_morse(n, letters):
    return "".join(letters[bin(i).count("1") % 2] for i in range(n))


def test_words_made_to_collide_are_told_apart(spark):
    a, b = thue_morse(1024, "ab"), thue_morse(1024, "ba")
    runs = textscan.Runs(*textscan.text_bytes(pa.array([f"{a} {b} {a.upper()}"])), ~textscan.IS_SPACE)
    first, second, third = runs.strong_hashes()
    assert first == third != second
    docs = spark.createDataFrame([(1, a), (2, b), (3, a)], "doc_id bigint, text string")
    found = {r["doc_id"]: r["component_id"] for r in near_dups.near_duplicates(docs, k=4, percent=80).collect()}
    assert found == {1: 1, 2: 2, 3: 1}


def test_every_place_and_byte_counts():
    rng = np.random.default_rng(2)
    words = {"".join(rng.choice(list("abé"), n)) for n in (1, 2, 31, 32, 33, 64, 200) for _ in range(200)}
    words |= {"x" * n for n in range(1, 300)} | {"x" * n + "y" + "x" * (300 - n) for n in range(300)}
    words = sorted(words)
    runs = textscan.Runs(*textscan.text_bytes(pa.array([" ".join(words), words[0]])), ~textscan.IS_SPACE)
    hashes = runs.strong_hashes()
    assert len(set(hashes[:-1].tolist())) == len(words) and hashes[-1] == hashes[0]


def test_a_hash_does_not_depend_on_the_words_beside_it(spark):
    long, text = "x" * 40, " ".join(f"w{i}" for i in range(30))
    alone = textscan.Runs(*textscan.text_bytes(pa.array([text])), ~textscan.IS_SPACE).strong_hashes()
    beside = textscan.Runs(*textscan.text_bytes(pa.array([text, long])), ~textscan.IS_SPACE).strong_hashes()
    assert (alone == beside[:-1]).all()
    rows = [(1, text), (2, text + " " * textscan.SLICE_BYTES), (3, long)]  # slices of their own
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1)
    found = {r["doc_id"]: r["component_id"] for r in near_dups.near_duplicates(docs, k=4, percent=80).collect()}
    assert found == {1: 1, 2: 1, 3: 3}


@pytest.mark.parametrize("n", [0, 1, 100, 4999, 5000, 9000])
def test_samples_are_the_smallest_hashes_for_any_partitioning(spark, n):
    rows = spark.range(5000).select("id", (F.col("id") % 7).alias("label"))
    draw = F.xxhash64(F.lit(3), "id")
    got = [r["id"] for r in smallest_hashes(rows.repartition(9), n, draw, "id").collect()]
    hashed = rows.select("id", F.pmod(draw, F.lit(1 << 62)).alias("h")).collect()
    assert sorted(got) == sorted(r["id"] for r in sorted(hashed, key=lambda r: r["h"])[:n])


def test_repeated_hashes_do_not_shorten_a_sample(spark):
    rows = spark.range(20_000).select((F.col("id") % 3).alias("id"), F.col("id").alias("n"))
    assert smallest_hashes(rows, 500, F.xxhash64(F.lit(3), "id"), "id", "n").count() == 500


def test_too_many_languages_raise(spark, monkeypatch):
    docs = spark.range(60).select(F.col("id").alias("doc_id"), F.lit("some words").alias("text"), F.concat(F.lit("l"), "id").alias("lang"))
    assert len(language.fit(docs, F.lit(True)).languages) == 60
    monkeypatch.setattr(language, "MOST_LANGUAGES", 59)
    with pytest.raises(ValueError, match="59"):
        language.fit(docs, F.lit(True))

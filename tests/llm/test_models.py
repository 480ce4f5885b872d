"""Language, quality, toxicity and certified rules."""

from __future__ import annotations

import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from spendspark.llm import language, quality_gam, quality_rules, toxicity

SMALL = "/root/testdata/sf0.01"
SCHEMA = "doc_id bigint, text string, lang string, source string, score string, id string"
WORDS = {
    "aa": "kol tra mun beda siru watan lika poro".split(),
    "bb": "ghest vroth clamp drint spelk thwag brin jorst".split(),
    "cc": "üöl äxi zéna çora ñiva ôlen".split(),
}


def frame(spark, rows):
    return spark.createDataFrame([(*r, "s", "x", "y") for r in rows], SCHEMA)


def say(rng, lang, n):
    return " ".join(rng.choice(WORDS[lang]) for _ in range(n))


@pytest.fixture(scope="module")
def model(spark):
    rng = random.Random(1)
    rows = [(i, say(rng, lang, 60), lang) for i, lang in enumerate(["aa", "bb", "cc"] * 20)]
    rows += [(1000, say(rng, "aa", 60), None), (None, say(rng, "bb", 60), "bb")]
    return language.fit(frame(spark, rows), F.lit(True))


def predict(spark, model, texts):
    out = language.predict(frame(spark, [(i, t, None) for i, t in texts]), model)
    assert out.columns == ["doc_id", "lang_pred", "score", "mixture"]
    return {r["doc_id"]: r for r in out.collect()}


def test_mixtures_are_found_with_their_proportions(spark, model):
    rng = random.Random(2)
    texts = [(1, say(rng, "aa", 80)), (2, say(rng, "bb", 70) + "\n" + say(rng, "cc", 30)), (3, say(rng, "cc", 1))]
    found = predict(spark, model, texts)
    assert model.languages == ["aa", "bb", "cc"]
    assert (found[1]["lang_pred"], found[1]["score"]) == ("aa", 1.0)
    shares = {m["lang"]: m["share"] for m in found[2]["mixture"]}
    assert shares.keys() == {"bb", "cc"} and abs(shares["bb"] - 0.7) < 0.05 and found[2]["lang_pred"] == "bb"
    assert found[3]["lang_pred"] == "cc"


def test_texts_without_letters_are_unknown(spark, model):
    texts = [(1, None), (2, ""), (3, " 12 !? 🙂\n"), (4, "日本"), (5, "KOL TRA"), (None, "ghest vroth"), (6, "kol " * 200_000)]
    found = predict(spark, model, texts)
    assert [found[i]["lang_pred"] for i in (1, 2, 3)] == ["und"] * 3 and found[1]["score"] == 0.0
    assert found[4]["lang_pred"] in model.languages
    assert (found[5]["lang_pred"], found[None]["lang_pred"], found[6]["lang_pred"]) == ("aa", "bb", "aa")
    assert predict(spark, model, []) == {}


def test_a_model_of_no_rows_knows_nothing(spark):
    empty = language.fit(frame(spark, [(1, "text", None)]), F.lit(True))
    assert empty.languages == [] and predict(spark, empty, [(1, "text")])[1]["lang_pred"] == "und"


def test_em_reaches_the_likeliest_proportions():
    rng = np.random.default_rng(3)
    scores = np.log(rng.dirichlet([1, 1, 1], size=400))
    share, loglik = language.proportions(scores, np.array([0]), np.array([400]), np.ones((1, 3), bool))
    steps = [np.exp(scores) @ p for p in rng.dirichlet([1, 1, 1], size=3000)]
    assert loglik[0] >= max(np.log(s).sum() for s in steps) - 0.5
    assert abs(share.sum() - 1) < 1e-9


def held_out_accuracy(spark, query, label, fold, column="predicted"):
    from spendspark.llm.queries import QUERIES

    rows = QUERIES[query](spark, SMALL)
    assert rows.count() == 1000
    truth = spark.read.parquet(f"{SMALL}/{'documents' if label == 'lang' else 'labels'}.parquet").select("doc_id", F.col(label).alias("truth"))
    held = rows.join(truth, "doc_id").where("held_out")
    assert held.where(F.crc32(F.col("doc_id").cast("string")) % fold[0] != fold[1]).isEmpty()
    assert rows.where(~F.col("score").between(0, 1) | F.col("score").isNull()).isEmpty()
    return held.agg(F.avg((F.col(column) == F.col("truth")).cast("int"))).first()[0]


def test_held_out_languages(spark):
    assert held_out_accuracy(spark, "op2_language", "lang", (4, 2), "lang_pred") > 0.98


def test_held_out_quality(spark):
    assert held_out_accuracy(spark, "op1_quality_gam", "quality", (4, 2)) > 0.95


def test_held_out_toxicity(spark):
    assert held_out_accuracy(spark, "op8_toxicity", "toxic", (3, 1)) > 0.85


def test_gam_finds_steps_and_interactions():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(4000, len(quality_gam.FEATURES)))
    label = ((x[:, 0] > 0.5) | (x[:, 1] * x[:, 2] > 0)).astype(float)
    model = quality_gam.train(x[:3000], label[:3000], rounds=60)
    hit = ((model.probability(x[3000:]) > 0.5) == label[3000:]).mean()
    assert hit > 0.9 and (2, 1) in model.pairs
    flat = quality_gam.train(x[:10], np.ones(10))
    assert np.ptp(flat.probability(x)) == 0 and quality_gam.train(x[:0], label[:0]).probability(x[:1]).shape == (1,)


def brute_features(text):
    words = re.findall("[^\x20\x09-\x0d]+", text)
    grams = [tuple(w.lower() if w.isascii() else w for w in words[i : i + 5]) for i in range(len(words) - 4)]
    chars = sum(len(w.encode()) for w in words)
    return {
        "log_words": math.log1p(len(words)),
        "symbol_share": sum(text.count(c) for c in "#*$%&<>") / max(chars, 1),
        "mean_word": chars / max(len(words), 1),
        "repeated_shingles": (len(grams) - len(set(grams))) / max(len(grams), 1),
    }


def test_features_of_texts(spark):
    texts = ["", None, " \n", "One two* three", "a b c d e " * 7, "É!! b|c\nline\nline", "x" * 100_000]
    rows = quality_gam.text_features(frame(spark, [(i, t, None) for i, t in enumerate(texts)])).collect()
    assert len(rows) == len(texts)
    for r in rows:
        text = texts[r["id"]] or ""
        for name, value in brute_features(text).items():
            assert r[name] == pytest.approx(0.0 if not text.strip() else value), (text[:20], name)
    assert quality_gam.text_features(frame(spark, [])).count() == 0


def test_toxic_words_disguises_and_constants(spark):
    rng = random.Random(5)
    rows, labels = [], []
    for i in range(400):
        words = say(rng, "aa", 30).split()
        if i % 4 == 0:
            words[rng.randrange(30)] = rng.choice(["idiot", "Idiot!", "zorgul", "zorgulen"])
        rows.append((i, " ".join(words), None))
        labels.append((i, int(i % 4 == 0)))
    docs = frame(spark, rows)
    marks = spark.createDataFrame([*labels, (7, None), (None, 1), (9999, 1)], "doc_id bigint, toxic int")
    model = toxicity.fit(docs, marks, F.lit(True))
    texts = [(1, "kol zorgul mun tra beda lika"), (2, "kol tra mun beda"), (3, None), (None, ""), (4, "kol you idiot " * 50)]
    out = {r["id"]: r["score"] for r in toxicity.score_documents(frame(spark, [(i, t, None) for i, t in texts]), model).collect()}
    assert out[1] > 0.7 and out[4] > 0.7 and out[2] < 0.3 and out[3] == out[None] < 0.7
    assert toxicity.score_documents(frame(spark, []), model).count() == 0
    constant = toxicity.fit(docs, marks.where("toxic = 0"), F.lit(True))
    assert {r["score"] for r in toxicity.score_documents(docs, constant).collect()} == {1 / 302}


def test_disguised_words_count():
    import pyarrow as pa

    from spendspark.llm import textscan

    data, offsets = textscan.text_bytes(pa.array(["an 1d!ot here", "plain words 10", "sooo loud", "you moron"]))
    none = np.zeros(0, np.uint64)
    x = dict(zip(toxicity.FEATURES, toxicity.features(data, offsets, none, none).T, strict=True))
    assert (x["obfuscated_per_word"] > 0).tolist() == [True, False, False, False]
    assert (x["stretched_per_word"] > 0).tolist() == [False, False, True, False]
    assert (x["near_second_person"] > 0).tolist() == [False, False, False, True]


def brute_measures(text):
    words = re.findall("[^\x20\x09-\x0d]+", text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    places = {}
    for i, w in enumerate(windows):
        places.setdefault(w, []).append(i)
    covered = {j for at in places.values() if len(at) > 1 for i in at for j in range(i, i + 5)}
    lines = [x for x in text.split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    return (
        len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered),
    )


def test_rule_measures_match_brute_force(spark):
    rng = random.Random(6)
    texts = ["", None, " \n\n ", "a b c d", "a b c d e f a b c d e", "x " * 500, "line\nline\n line\n\nline", "é#| *** <b>"]
    texts += ["\n".join(" ".join(rng.choice("ab é#".split()) for _ in range(rng.randint(0, 12))) for _ in range(rng.randint(0, 9))) for _ in range(60)]
    docs = frame(spark, [(i, t, None) for i, t in enumerate(texts)])
    found = quality_rules.measures(docs, [F.col("doc_id")]).collect()
    names = ["n_words", "word_chars", "n_dup_lines", "n_repeat_words"]
    for r in found:
        words, chars, symbols, lines, repeats = brute_measures(texts[r["doc_id"]] or "")
        assert [r[n] for n in names] == [words, chars, lines, repeats], texts[r["doc_id"]]
        assert r["n_symbols"] == symbols and r["repeat_rate"] == 1000 * repeats // max(words, 1)


def test_binomial_tails_are_exact(spark):
    cases = [(50, 0, 0.02), (200, 3, 0.02), (1000, 30, 0.05), (7, 7, 0.3)]
    for n, k, p in cases:
        got = spark.range(1).select(quality_rules.binomial_tail_log(F.lit(n).cast("bigint"), F.lit(k).cast("bigint"), p)).first()[0]
        assert math.exp(got) == pytest.approx(sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1)), rel=1e-9)


def test_cutoffs_stop_at_the_first_that_fails(spark):
    # 2000 good documents of stratum a, one in 500 with a high rate; stratum b is too small to certify.
    rows = [("a", 30 if i % 500 == 0 else i % 5) for i in range(2000)] + [("b", 0)] * 20
    good = spark.createDataFrame(rows, "stratum string, rate bigint")
    cut = quality_rules.certified_cutoffs(good, 0.01, 0.95, {"rate": [40, 20, 3, 10]})
    assert [tuple(r) for r in cut.collect()] == [("a", "rate", 20)]


def test_cutoffs_of_all_rules_share_the_allowed_rate(spark):
    # 217 rows without a rejection are the fewest that two strata need: 0.98 ** 217 < 0.05 / 2 < 0.98 ** 182.
    rows = [(s, 0, 3 if s == "b" and i < 20 else 0) for s in "ab" for i in range(217)] + [("c", 0, 0)] * 100
    good = spark.createDataFrame(rows, "stratum string, x bigint, y bigint")
    cut = quality_rules.certified_cutoffs(good, 0.02, 0.95, {"x": [9, 8, 1], "y": [9, 4, 2]})
    assert sorted(map(tuple, cut.collect())) == [("a", "x", 1), ("a", "y", 2), ("b", "x", 8), ("b", "y", 4)]
    with pytest.raises(ValueError):
        quality_rules.certified_cutoffs(good, cutoffs={"x": [1], "y": [2, 1]})


def test_no_stratum_of_many_gets_a_cutoff_that_rejects_too_many(spark):
    # Of each stratum a vector rejects 0.5, 1, 2.1 and 4 % in truth; 2 % is allowed.
    good = spark.range(0, 600_000, 1, 4).select((F.col("id") % 300).alias("stratum"), F.floor(1000 * F.rand(7)).alias("rate"))
    cut = quality_rules.certified_cutoffs(good, 0.02, 0.95, {"rate": [994, 989, 978, 959]}).collect()
    assert len(cut) >= 290 and {r["cutoff"] for r in cut} <= {994, 989}


def test_verdicts_match_brute_force(spark):
    rng = random.Random(11)
    words = "alpha beta Gamma DELTA eps# zeta eta theta iota kappa lambda mu nu xi".split()

    def text(bad):
        lines = [" ".join(rng.choice(words[: 14 if bad else 12]) + ("$$" if rng.random() < bad else "") for _ in range(6)) for _ in range(4)]
        return "\n".join(lines + lines[:1] * (rng.random() < bad))

    rows = [(i, text(rng.choice([0, 0, 0, 0.3]) if i % 7 else 0.6), ("aa", "bb", None)[i % 3]) for i in range(1800)]
    quality = {i: int(rng.random() < 0.9) for i, t, _ in rows if "$$" not in t or rng.random() < 0.02}
    labels = spark.createDataFrame(list(quality.items()), "doc_id bigint, quality int")

    def rates(t):
        n, chars, symbols, dup_lines, repeats = brute_measures(t)
        lines, upper = t.count("\n") + 1, len(re.findall("[A-Z]", t))
        return n < 10 or 100 * repeats > 20 * n, [
            1000 * symbols // chars, 1000 * dup_lines // lines, 1000 * repeats // n, 1000 * upper // chars,
        ]

    judged = {i: (lang, *rates(t)) for i, t, lang in rows}
    vectors = list(zip(*[quality_rules.CUTOFFS[r] for r in ("symbol_rate", "dup_line_rate", "repeat_rate", "upper_rate")], strict=True))
    good = {lang: [x for i, (at, failed, x) in judged.items() if at == lang and not failed and quality.get(i) == 1] for lang in ("aa", "bb", None)}
    good = {lang: xs for lang, xs in good.items() if 0.98 ** len(xs) <= 0.05}
    limits = {}
    for lang, xs in good.items():
        for vector in vectors:
            k = sum(any(a > b for a, b in zip(x, vector, strict=True)) for x in xs)
            if sum(math.comb(len(xs), i) * 0.02**i * 0.98 ** (len(xs) - i) for i in range(k + 1)) > 0.05 / len(good):
                break
            limits[lang] = vector
    expected = {
        i: not failed and not any(a > b for a, b in zip(x, limits.get(lang, [1000] * 4), strict=True)) for i, (lang, failed, x) in judged.items()
    }
    assert limits and 0 < sum(1 for i, k in expected.items() if not k and not judged[i][1])
    out = quality_rules.apply_rules(frame(spark, rows), labels).collect()
    assert {r["doc_id"]: r["kept"] for r in out} == expected


def test_rules_keep_clean_rows_and_cover_all(spark):
    good = [(i, f"clean words number {i} that go on for a while and never repeat at all", "aa") for i in range(1500)]
    bad = [(2000 + i, f"odd### {i}*** words%%% that&&& carry$$$ signs### on*** all&&& of%%% them$$$ now###", "aa") for i in range(20)]
    odd = [(3000, None, None), (3001, "", "aa"), (None, good[0][1], "aa"), (0, good[0][1], "aa")]
    labels = spark.createDataFrame([(i, 1) for i in range(1500)] + [(2000, 0), (None, 1), (9, None)], "doc_id bigint, quality int")
    out = quality_rules.apply_rules(frame(spark, good + bad + odd), labels).collect()
    kept = {r["doc_id"]: r["kept"] for r in out if r["doc_id"] is not None}
    assert len(out) == 1524 and all(kept[i] for i in range(1500))
    assert not any(kept[2000 + i] for i in range(20)) and not kept[3000] and not kept[3001]
    assert quality_rules.apply_rules(frame(spark, []), labels).count() == 0
    assert quality_rules.apply_rules(frame(spark, good), labels.where("false")).where("kept").count() == 1500

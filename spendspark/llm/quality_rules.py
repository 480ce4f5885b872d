"""Quality rules whose thresholds are certified by labelled holdouts; DataFrame functions only.

Rules reject documents with a measure beyond a cutoff. All rules tighten together, through a fixed
sequence of vectors with one cutoff per rule, from the one that rejects least. On labelled good
documents of a stratum, a vector is certified if the exact binomial (Clopper-Pearson) upper bound
of the share that any of its rules rejects stays below the allowed rate. Testing stops at the first
vector that fails, so one error level serves the whole sequence, and no rate or level is divided
among rules. The level is divided among the strata that are tested (Bonferroni); those with so few
good documents that nothing could be certified are not tested. So the rules reject at most the
allowed share of good documents in every stratum at once, with the stated confidence.

Measures are taken row by row with array functions, so no text is shuffled.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendspark.operators.lookup import left_lookup
from spendspark.session import materialise

# What a word is, and the characters that count as symbols.
WORD = r"[^\x20\x09-\x0D]+"
NOT_SYMBOLS = r"[^#*$%&|<>]+"
WINDOW = 5
LEAST_WORDS = 10
MOST_REPEATED_PERCENT = 20

# Allowed share of rejected good documents per stratum, and the confidence in it.
FALSE_REJECTIONS = 0.02
CONFIDENCE = 0.95
# Cutoffs per rule in thousandths; the n-th ones of all rules are the n-th vector that is tested.
CUTOFFS = {
    "symbol_rate": [400, 300, 250, 200, 150, 120, 100, 80, 60, 50, 40, 30, 20, 15, 10, 5],
    "dup_line_rate": [800, 700, 600, 550, 500, 450, 400, 350, 300, 250, 200, 180, 150, 120, 100, 50],
    "repeat_rate": [200, 190, 180, 170, 160, 150, 140, 130, 120, 110, 100, 90, 80, 60, 40, 20],
    "upper_rate": [900, 850, 800, 750, 700, 650, 600, 550, 500, 450, 400, 350, 300, 250, 225, 200],
}


def measures(docs: DataFrame, keep: list[Column], text_col: str = "text") -> DataFrame:
    """``keep`` and the measures of each row's text, null as empty.

    n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, and the rates that rules use, in
    whole thousandths: symbols and capitals per character of words, repeated lines per line with a
    word, repeated words per word.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        *keep,
        F.regexp_extract_all(text, F.lit(WORD), F.lit(0)).alias("_words"),
        F.filter(F.split(text, "\n", -1), lambda line: line.rlike(WORD)).alias("_lines"),
        F.char_length(F.regexp_replace(text, NOT_SYMBOLS, "")).cast("bigint").alias("n_symbols"),
        F.char_length(F.regexp_replace(text, "[^A-Z]+", "")).cast("bigint").alias("_upper"),
    )
    names = [c for c in rows.columns if not c.startswith("_")]
    # Hashes of all windows; expr lets one array be used twice without being made twice.
    windows = rows.select(
        *names, "_upper",
        F.size("_words").cast("bigint").alias("n_words"),
        F.aggregate("_words", F.lit(0).cast("bigint"), lambda n, w: n + F.char_length(w)).alias("word_chars"),
        F.size("_lines").cast("bigint").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint").alias("n_dup_lines"),
        F.expr(
            f"""CASE WHEN size(_words) < {WINDOW} THEN array() ELSE
            transform(array(transform(_words, w -> xxhash64(w))), h ->
              transform(sequence(0, size(h) - {WINDOW}), i -> xxhash64(h[i], h[i + 1], h[i + 2], h[i + 3], h[i + 4])))[0]
            END"""
        ).alias("_windows"),
    )
    # Windows that occur again, by sorting (hash, place) pairs, only where there are any. A window
    # covers its first word and the next four; words that the window before it covers do not count again.
    counted = windows.withColumn(
        "n_repeat_words",
        F.expr(
            f"""CASE WHEN size(array_distinct(_windows)) = size(_windows) THEN 0L ELSE
            aggregate(
              array_sort(transform(
                transform(array(sort_array(transform(_windows, (h, i) -> struct(h AS h, i AS i)))), s ->
                  filter(s, (x, j) -> (j > 0 AND s[j - 1].h = x.h) OR (j < size(s) - 1 AND s[j + 1].h = x.h)))[0],
                x -> x.i)),
              struct(0L AS n, -{WINDOW} AS last),
              (a, i) -> struct(a.n + least({WINDOW}, i - a.last) AS n, i AS last),
              a -> a.n) END"""
        ),
    )
    chars, words = F.greatest("word_chars", F.lit(1)), F.greatest("n_words", F.lit(1))

    def rate(part: str, whole: Column) -> Column:
        return F.floor(1000 * F.col(part) / whole).cast("bigint")

    return counted.select(
        *names, "n_words", "word_chars", "n_dup_lines", "n_repeat_words",
        rate("n_symbols", chars).alias("symbol_rate"),
        rate("n_dup_lines", F.greatest("n_lines", F.lit(1))).alias("dup_line_rate"),
        rate("n_repeat_words", words).alias("repeat_rate"),
        rate("_upper", chars).alias("upper_rate"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words"))


def binomial_tail_log(n: Column, k: Column, p: float) -> Column:
    """ln P(X <= k) of X ~ Binomial(n, p), term by term in logarithms; needs k <= n.

    The Clopper-Pearson upper bound of a rate after k of n is below p just if this probability is
    below the error level.
    """
    first = n * F.log1p(F.lit(-p))
    start = F.struct(first.alias("term"), first.alias("total"))

    odds = F.ln(F.lit(p)) - F.log1p(F.lit(-p))

    def step(state: Column, i: Column) -> Column:
        term = state["term"] + F.ln((n - i + 1).cast("double")) - F.ln(i.cast("double")) + odds
        high, low = F.greatest(state["total"], term), F.least(state["total"], term)
        return F.struct(term.alias("term"), (high + F.log1p(F.exp(low - high))).alias("total"))

    terms = F.when(k > 0, F.sequence(F.lit(1).cast("bigint"), k)).otherwise(F.expr("cast(array() as array<bigint>)"))
    return F.aggregate(terms, start, step, lambda s: s["total"])


def certified_cutoffs(
    good: DataFrame, false_rejections: float = FALSE_REJECTIONS, confidence: float = CONFIDENCE,
    cutoffs: dict[str, list[int]] | None = None,
) -> DataFrame:
    """(stratum, rule, cutoff): the last certified vector of each stratum, none if none is.

    ``good`` has a row per labelled good document that the base rules keep: stratum and the rates.
    Rejections by any rule are counted per stratum and vector, with partial sums before they are
    shuffled; what is left is a row per stratum. A null rate rejects nothing.
    """
    cutoffs = cutoffs or CUTOFFS
    if len(set(map(len, cutoffs.values()))) != 1:
        raise ValueError("every rule needs as many cutoffs as there are vectors")
    vectors = list(zip(*cutoffs.values(), strict=True))
    rejected = [
        F.count_if(F.greatest(F.lit(False), *[F.col(rule) > at for rule, at in zip(cutoffs, vector, strict=True)]))
        for vector in vectors
    ]
    counts = good.groupBy("stratum").agg(F.count("*").alias("n"), F.array(*rejected).alias("rejected"))
    # With fewer rows not even a vector that rejects none could pass at the whole level.
    fewest = math.ceil(math.log(1.0 - confidence) / math.log1p(-false_rejections))
    tested = materialise(counts.where(F.col("n") >= fewest), "quality-counts")
    level = (1.0 - confidence) / max(1, tested.count())
    each = tested.select("stratum", "n", F.posexplode("rejected").alias("step", "k"))
    # More rejections than the allowed rate expects can never be certified.
    hopeless = F.col("k") > F.col("n") * F.lit(false_rejections)
    tail = binomial_tail_log(F.col("n"), F.col("k"), false_rejections)
    passed = F.when(hopeless, F.lit(False)).otherwise(tail <= F.ln(F.lit(level)))
    # Fixed order: everything before the first failure counts.
    first_failure = F.min(F.when(~passed, F.col("step")))
    last = each.groupBy("stratum").agg((F.coalesce(first_failure, F.lit(len(vectors))) - 1).alias("last")).where("last >= 0")
    of_rules = [
        F.struct(F.lit(rule).alias("rule"), F.get(F.array(*map(F.lit, steps)), F.col("last")).alias("cutoff"))
        for rule, steps in cutoffs.items()
    ]
    return last.select("stratum", F.explode(F.array(*of_rules)).alias("at")).select("stratum", "at.*")


def apply_rules(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang",
    label_col: str = "quality", false_rejections: float = FALSE_REJECTIONS, confidence: float = CONFIDENCE,
) -> DataFrame:
    """Measures of every document, base_failed and kept.

    kept is false if the base rules fail (fewer than 10 words, or over a fifth of the words in
    repeated windows of five) or a measure exceeds the cutoff certified for the document's stratum.

    A null or empty text has no words and fails the base rules. Rows without a stratum are a
    stratum of their own; strata without enough labelled good documents have base rules only. Labels
    that are null, or of unknown ids, are not used; a row without an id has no label. Repeated rows
    are judged alike. An empty table gives an empty result. Other columns are not read.
    """
    keep = [
        F.col(id_col).alias("id"),
        F.coalesce(F.concat(F.lit("="), F.col(stratum_col).cast("string")), F.lit("none")).alias("stratum"),
    ]
    measured = materialise(measures(docs, keep, text_col).withColumn("base_failed", base_failed()), "quality-measures")
    good = labels.where(F.col(label_col) == 1).select(F.col(id_col).alias("id")).distinct()
    held = measured.where(~F.col("base_failed")).join(good, "id", "left_semi")
    cut = certified_cutoffs(held, false_rejections, confidence)
    limits = materialise(
        cut.groupBy("stratum").agg(
            *[F.max(F.when(F.col("rule") == rule, F.col("cutoff"))).alias(f"max_{rule}") for rule in CUTOFFS]
        ),
        "quality-cutoffs",
    )
    judged = left_lookup(measured, limits, "stratum", ["id"], broadcast_rows=100_000)
    beyond = F.lit(False)
    for rule in CUTOFFS:
        beyond = beyond | F.coalesce(F.col(rule) > F.col(f"max_{rule}"), F.lit(False))
    return judged.withColumn("kept", ~F.col("base_failed") & ~beyond).withColumnRenamed("id", id_col)

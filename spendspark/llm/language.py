"""Languages of documents as a mixture: proportions by expectation-maximisation, set by penalised likelihood.

Every language has probabilities of byte trigrams, counted within words and their edges. A word's
likelihood in a language is the product over its trigrams. A document is a mixture of languages
that emit words; EM estimates their proportions. Then languages are taken out, the smallest first,
as long as that lowers the Bayesian information criterion, and the largest of the remaining
proportions is the document's language. The criterion keeps a language only if its words pay for
the extra parameter.

Trigrams hash into 65,536 places, so a model has that many numbers per language however large the
corpus is.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spendspark.llm import textscan

cloudpickle.register_pickle_by_value(sys.modules[__name__])

UNKNOWN = "und"
PLACES = 1 << 16
SMOOTHING = 0.5
# Labelled documents per language that a model learns from, about.
DOCS_PER_LANGUAGE = 4_000
# A model holds half a megabyte for each language; more languages than this raise an error.
MOST_LANGUAGES = 1_000
ROUNDS = 30
TOLERANCE = 1e-3

_PLAIN = np.where(textscan.IS_LETTER, np.arange(256), 32).astype(np.uint8)
_PLAIN[65:91] += 32
_PARTS = [textscan.mix(np.arange(256, dtype=np.uint64) + c).astype(np.uint16) for c in textscan.constants(3, 53)]


def trigrams(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The place of the trigram around every byte; beyond a document's edge there is a blank."""
    plain = _PLAIN[data]
    before, after = np.full(len(data), 32, np.uint8), np.full(len(data), 32, np.uint8)
    before[1:], after[:-1] = plain[:-1], plain[1:]
    inner = offsets[(offsets > 0) & (offsets < len(data))]
    before[inner], after[inner - 1] = 32, 32
    return _PARTS[0][before] + _PARTS[1][plain] + _PARTS[2][after]


@dataclass
class Model:
    """Learnt languages in ascending order and the log-probabilities of trigram places."""

    languages: list[str]
    log_p: np.ndarray


def _count_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[str, np.ndarray] = {}
    for batch in batches:
        languages = batch.column(1)
        for language in pc.unique(languages).to_pylist():
            texts = batch.column(0).filter(pc.equal(languages, language))
            data, offsets = textscan.text_bytes(texts)
            total = counts.setdefault(language, np.zeros(PLACES, dtype=np.int64))
            for lo, hi in textscan.slices(offsets):
                at = offsets[lo : hi + 1]
                part = data[at[0] : at[-1]]
                total += np.bincount(trigrams(part, at - at[0])[textscan.IS_LETTER[part]], minlength=PLACES)
    for language, total in counts.items():
        place = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array([language] * len(place), pa.string()), pa.array(place.astype(np.int32)), pa.array(total[place])],
            ["language", "place", "n"],
        )


def fit(docs: DataFrame, learn: Column, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id",
        docs_per_language: int = DOCS_PER_LANGUAGE) -> Model:
    """Trigram probabilities from the rows where ``learn`` holds and the language is not null.

    Of each language about ``docs_per_language`` documents are used, chosen by a hash of their id,
    with their whole texts. Without such rows the model knows no language. All languages are learnt, or,
    beyond ``MOST_LANGUAGES``, none and the fit raises: such a column hardly holds languages.
    """
    rows = docs.where(learn & F.col(lang_col).isNotNull())
    sizes = rows.groupBy(F.col(lang_col).alias("language")).agg(F.count("*").alias("n"))
    found = sizes.limit(MOST_LANGUAGES + 1).collect()
    if len(found) > MOST_LANGUAGES:
        raise ValueError(f"{lang_col} has more than {MOST_LANGUAGES} values to learn")
    if not found:
        return Model([], np.zeros((0, PLACES)))
    share = F.create_map(*[F.lit(x) for r in found for x in (r["language"], min(1.0, docs_per_language / r["n"]))])
    draw = F.pmod(F.xxhash64(F.lit(7), id_col), F.lit(1 << 30)) / F.lit(float(1 << 30))
    chosen = rows.where(draw < F.element_at(share, F.col(lang_col))).select(
        F.col(text_col).alias("text"), F.col(lang_col).alias("language")
    )
    counted = chosen.mapInArrow(_count_task, "language string, place int, n bigint")
    total = counted.groupBy("language", "place").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(r["language"] for r in found)
    counts = np.full((len(languages), PLACES), SMOOTHING)
    at = {x: i for i, x in enumerate(languages)}
    np.add.at(counts, (total["language"].map(at).to_numpy(dtype=np.int64), total["place"].to_numpy(dtype=np.int64)), total["n"].to_numpy(dtype=float))
    return Model(languages, np.log(counts / counts.sum(axis=1, keepdims=True)))


def proportions(scores: np.ndarray, first: np.ndarray, count: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """EM for many documents: (proportions, log-likelihood) given the words' log-likelihoods.

    ``scores`` is (words, languages), document d has words first[d] to first[d] + count[d], and
    ``allowed`` (documents, languages) says which languages its mixture may use.
    """
    n_docs = len(count)
    share = allowed / np.maximum(allowed.sum(axis=1, keepdims=True), 1)
    loglik = np.zeros(n_docs)
    active = np.flatnonzero(count > 0)
    peak = scores.max(axis=1) if len(scores) else np.zeros(0)
    relative = np.exp(scores - peak[:, None])
    for _ in range(ROUNDS):
        if not len(active):
            break
        size = count[active]
        ends = np.cumsum(size)
        words = np.arange(ends[-1]) - np.repeat(ends - size - first[active], size)
        owner = np.repeat(np.arange(len(active)), size)
        joint = relative[words] * share[active][owner]
        total = joint.sum(axis=1)
        # A word that no allowed language can emit tells nothing.
        known = total > 1e-300
        joint /= np.where(known, total, 1.0)[:, None]
        starts = ends - size
        loglik[active] = np.add.reduceat(np.log(np.where(known, total, 1e-300)) + peak[words], starts)
        new = np.add.reduceat(joint, starts, axis=0)
        weight = new.sum(axis=1, keepdims=True)
        new = np.where(weight > 0, new / np.where(weight > 0, weight, 1.0), share[active])
        moved = np.abs(new - share[active]).max(axis=1)
        share[active] = new
        active = active[moved > TOLERANCE]
    return share, loglik


def choose(scores: np.ndarray, first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """(documents, languages) proportions over the language set that the criterion selects."""
    n_languages = scores.shape[1]
    allowed = np.ones((len(count), n_languages), dtype=bool)
    share, loglik = proportions(scores, first, count, allowed)
    price = 0.5 * np.log(np.maximum(count, 2))
    trying = np.flatnonzero(count > 0)
    # First all languages without even one word's weight, then the smallest one each time.
    drop = share * count[:, None] < 0.5
    for step in range(n_languages):
        if not len(trying):
            break
        if step:
            drop = np.zeros_like(allowed)
            masked = np.where(allowed, share, np.inf)
            drop[np.arange(len(count)), masked.argmin(axis=1)] = True
        fewer = allowed & ~drop
        able = fewer.any(axis=1) & (fewer != allowed).any(axis=1)
        pending = trying[able[trying]]
        idle = trying[~able[trying]] if step == 0 else trying[:0]
        if len(pending):
            s, ll = proportions(scores, first[pending], count[pending], fewer[pending])
            saved = price[pending] * (allowed[pending].sum(axis=1) - fewer[pending].sum(axis=1))
            better = ll + saved >= loglik[pending]
            won = pending[better]
            allowed[won], share[won], loglik[won] = fewer[won], s[better], ll[better]
            pending = won if step else pending
        trying = np.sort(np.concatenate([pending, idle])).astype(np.int64)
    return share


def _judged(texts: pa.Array, known: Model) -> Iterator[pa.StructArray]:
    """Language, share and mixture of each text, a slice of the rows at a time."""
    data, offsets = textscan.text_bytes(texts)
    n_languages = len(known.languages)
    names_of = np.array([*known.languages, UNKNOWN], dtype=object)
    for lo, hi in textscan.slices(offsets, textscan.SLICE_BYTES // 2):
        at = offsets[lo : hi + 1]
        part, inner = data[at[0] : at[-1]], at - at[0]
        lettered = _lettered(part, inner, texts, lo)
        names, best = np.full(hi - lo, UNKNOWN, dtype=object), np.zeros(hi - lo)
        shares = np.zeros((hi - lo, n_languages))
        if n_languages:
            runs = textscan.Runs(part, inner, textscan.IS_LETTER)
            places, sums = trigrams(part, inner), np.zeros(len(part) + 1)
            scores = np.empty((len(runs.start), n_languages))
            for i in range(n_languages):
                np.cumsum(known.log_p[i][places], out=sums[1:])
                scores[:, i] = sums[runs.end] - sums[runs.start]
            shares = choose(scores, runs.first[:-1], runs.count)
            shares[~lettered] = 0.0
            top = shares.argmax(axis=1)
            names[lettered] = names_of[top[lettered]]
            best[lettered] = shares[np.arange(hi - lo), top][lettered]
        kept = shares > 0
        mixture = pa.ListArray.from_arrays(
            pa.array(np.append(0, np.cumsum(kept.sum(axis=1))).astype(np.int32)),
            pa.StructArray.from_arrays(
                [pa.array(names_of[np.nonzero(kept)[1]], pa.string()), pa.array(shares[kept])], ["lang", "share"]
            ),
        )
        yield pa.StructArray.from_arrays(
            [pa.array(names, pa.string()), pa.array(np.clip(best, 0.0, 1.0)), mixture], ["lang_pred", "score", "mixture"]
        )


RESULT = "lang_pred string, score double, mixture array<struct<lang: string, share: double>>"


def language_of(text: Column, model: Model) -> Column:
    """A struct of lang_pred, score and mixture."""
    sent = SparkSession.getActiveSession().sparkContext.broadcast((model.languages, model.log_p))

    @F.arrow_udf(RESULT)
    def judge(texts: pa.Array) -> pa.Array:
        known, empty = Model(*sent.value), pa.StructArray.from_arrays(
            [pa.array([], pa.string()), pa.array([], pa.float64()),
             pa.array([], pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())])))],
            ["lang_pred", "score", "mixture"],
        )
        return pa.concat_arrays([empty, *_judged(texts, known)])

    return judge(text)


def _lettered(data: np.ndarray, offsets: np.ndarray, texts: pa.Array, lo: int) -> np.ndarray:
    """Which documents have a letter of any alphabet."""
    has = textscan.class_counts(data, offsets, textscan.IS_UPPER | textscan.IS_LOWER) > 0
    for row in np.flatnonzero(~has & (np.diff(offsets) > 0)):
        has[row] = any(c.isalpha() for c in texts[lo + int(row)].as_py())
    return has


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score, mixture) per row: the main language, its share, and all shares over 0.

    A text that is null or without letters, and any text if the model knows no language, is ``und``
    with score 0. Letters of other alphabets get the likeliest of the learnt languages. Equal
    shares go to the language first in the alphabet. Whole texts are used, a bounded slice of rows
    at a time. An empty table gives an empty result. Other columns are not read.
    """
    judged = docs.select(F.col(id_col), language_of(F.col(text_col), model).alias("judged"))
    return judged.select(id_col, "judged.lang_pred", "judged.score", "judged.mixture")

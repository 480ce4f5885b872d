"""Toxicity of documents: boosted trees over dense features, with isotonic calibration.

The features are densities: words of a fixed lexicon and of one learnt from labelled rows, such
words near a second person, capitals, marks, and obfuscated spellings. The learnt lexicon holds
words and word beginnings that are far more frequent in toxic documents; both are compared by hash.
MLlib grows the trees on a bounded sample of labelled rows; their scores on the part of the
sample that the trees have not seen are calibrated by isotonic regression.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendspark.llm import textscan
from spendspark.llm.sampling import smallest_hashes
from spendspark.session import materialise

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Insults of several languages, lower case, and words for the second person.
INSULTS = (
    "idiot idiots moron morons stupid dumb scum trash garbage worthless pathetic disgusting loser losers clown "
    "clowns fool imbecile vermin filth filthy bastard bitch asshole shit fuck fucking crap damn hate kill die "
    "ugly freak creep pig pigs rat rats sucks jerk retard subhuman "
    "connard conne salope imbécile débile merde pute ordure crétin abruti "
    "arschloch scheiße scheisse dumm dummkopf trottel abschaum hurensohn wichser versager "
    "estúpido estúpida idiota imbécil mierda puta cabrón pendejo basura asqueroso"
).split()
SECOND_PERSON = "you your you're youre u ur yourself tu te toi ton ta vous votre du dich dir dein deine ihr euch usted tú ti su vos".split()

FEATURES = [
    "insults_per_word",
    "insults_log",
    "learnt_per_word",
    "learnt_log",
    "learnt_beginnings_per_word",
    "learnt_beginnings_log",
    "near_second_person",
    "second_person_per_word",
    "upper_share",
    "shouted_words",
    "exclamation_per_word",
    "marks_per_word",
    "obfuscated_per_word",
    "stretched_per_word",
    "log_words",
]
# Labelled rows that are learnt from, at most, and the part of them that trees are grown on.
SAMPLE_ROWS = 30_000
GROW_FOLDS, FOLDS = 3, 4
# Learnt lexicon: entries of either kind, documents that hold an entry, and odds against the rest.
LEXICON = 2_000
LEAST_DOCS = 5
LEAST_ODDS = 4.0
# Bytes of a word's beginning.
BEGINNING = 5
# Words between an insult and a second person.
NEAR = 3
TREES, DEPTH, RATE = 20, 4, 0.3

_LETTERS = textscan.IS_LETTER
_MARKS = textscan.byte_table("!?*#@$%&")
_STAND_INS = textscan.byte_table("@$*013457!")
# What stands for which letter in disguised spellings.
_PLAIN = np.arange(256, dtype=np.uint8)
for _from, _to in zip(b"@$013457!", b"asoieasti", strict=True):
    _PLAIN[_from] = _to


def _hash_words(words: list[str]) -> np.ndarray:
    data, offsets = textscan.text_bytes(pa.array(words, pa.string()))
    return np.unique(textscan.Runs(data, offsets, ~textscan.IS_SPACE).hashes())


def _within(values: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Which values are in a sorted table."""
    if not len(table):
        return np.zeros(len(values), dtype=bool)
    at = np.minimum(np.searchsorted(table, values), len(table) - 1)
    return table[at] == values


def _letter_runs(data: np.ndarray, offsets: np.ndarray):
    """Words of letters only, their hashes, and the hashes of the beginnings of longer ones."""
    runs = textscan.Runs(data, offsets, _LETTERS)
    hashes = runs.hashes()
    head = textscan.Runs(data, offsets, _LETTERS)
    head.end = np.minimum(head.end, head.start + BEGINNING)
    # A beginning is never equal to a whole word, so that both can share one table.
    return runs, hashes, textscan.mix(head.hashes() + np.uint64(1))


def features(data: np.ndarray, offsets: np.ndarray, lexicon: np.ndarray, beginnings: np.ndarray) -> np.ndarray:
    """(documents, features) of whole texts; all zeros for a text without words."""
    runs, hashes, heads = _letter_runs(data, offsets)
    tokens = textscan.Runs(data, offsets, ~textscan.IS_SPACE)
    words = np.maximum(tokens.count, 1)
    insult = _within(hashes, _INSULT_HASHES)
    learnt, begun = _within(hashes, lexicon), _within(heads, beginnings)
    second = _within(hashes, _SECOND_HASHES)
    near = np.zeros(len(hashes), dtype=bool)
    for gap in range(1, NEAR + 1):
        same = runs.doc[gap:] == runs.doc[:-gap]
        near[gap:] |= same & second[:-gap]
        near[:-gap] |= same & second[gap:]
    near &= insult | learnt

    letters = np.maximum(textscan.class_counts(data, offsets, _LETTERS), 1)
    upper = textscan.range_counts(textscan.IS_UPPER[data], runs.start, runs.end)
    shouted = (upper == runs.end - runs.start) & (upper > 2)
    # A token with stand-ins between letters is obfuscated if it is an insult once they are replaced.
    lettered = textscan.range_counts(_LETTERS[data], tokens.start, tokens.end)
    standing = textscan.range_counts(_STAND_INS[data], tokens.start, tokens.end)
    disguised = (standing > 0) & (lettered > standing)
    plain = textscan.Runs(_PLAIN[data], offsets, _LETTERS)
    plain_hit = _within(plain.hashes(), _INSULT_HASHES)
    hits = np.append(0, np.cumsum(plain_hit))
    first, last = np.searchsorted(plain.start, tokens.start), np.searchsorted(plain.start, tokens.end)
    disguised &= hits[last] > hits[first]
    # Letters three times in a row.
    triple = np.zeros(len(data), dtype=bool)
    if len(data) > 2:
        triple[2:] = (data[2:] == data[1:-1]) & (data[1:-1] == data[:-2]) & _LETTERS[data[2:]]
    stretched = textscan.range_counts(triple, runs.start, runs.end) > 0

    def count(flags: np.ndarray, of: textscan.Runs = runs) -> np.ndarray:
        return of.sums(flags.astype(float))

    marks = textscan.class_counts(data, offsets, _MARKS)
    exclamations = textscan.class_counts(data, offsets, textscan.byte_table("!"))
    insults, learnts, begins = count(insult), count(learnt), count(begun)
    out = np.column_stack(
        [
            insults / words,
            np.log1p(insults),
            learnts / words,
            np.log1p(learnts),
            begins / words,
            np.log1p(begins),
            count(near) / words,
            count(second) / words,
            textscan.class_counts(data, offsets, textscan.IS_UPPER) / letters,
            count(shouted) / words,
            exclamations / words,
            marks / words,
            count(disguised, tokens) / words,
            count(stretched) / words,
            np.log1p(tokens.count),
        ]
    )
    out[tokens.count == 0] = 0.0
    return out


_INSULT_HASHES, _SECOND_HASHES = _hash_words(INSULTS), _hash_words(SECOND_PERSON)


def _entry_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct words (kind 0) and beginnings (kind 1) of a batch's documents, with document counts by label."""
    for batch in batches:
        label = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
        data, offsets = textscan.text_bytes(batch.column(0))
        for lo, hi in textscan.slices(offsets):
            at = offsets[lo : hi + 1]
            runs, hashes, heads = _letter_runs(data[at[0] : at[-1]], at - at[0])
            for kind, values in enumerate((hashes, heads)):
                docs, values = textscan.distinct(runs.doc, values)
                entry, back = np.unique(values, return_inverse=True)
                toxic = np.bincount(back, weights=label[lo + docs], minlength=len(entry)).astype(np.int64)
                total = np.bincount(back, minlength=len(entry)).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(entry), kind, np.int32)), pa.array(entry.view(np.int64)), pa.array(toxic), pa.array(total)],
                    ["kind", "entry", "toxic", "total"],
                )


@dataclass
class Lexicon:
    """Sorted hashes of learnt words and word beginnings."""

    words: np.ndarray
    beginnings: np.ndarray


def learn_lexicon(texts: DataFrame) -> Lexicon:
    """Entries that are far more frequent in toxic rows of (text, label), strongest first."""
    sizes = texts.agg(F.sum("label").alias("toxic"), F.count("*").alias("total")).first()
    toxic, clean = float(sizes["toxic"] or 0), float(sizes["total"] - (sizes["toxic"] or 0))
    if not toxic or not clean:
        return Lexicon(*[np.zeros(0, np.uint64)] * 2)
    entries = texts.mapInArrow(_entry_task, "kind int, entry bigint, toxic bigint, total bigint")
    counted = entries.groupBy("kind", "entry").agg(F.sum("toxic").alias("toxic"), F.sum("total").alias("total"))
    odds = ((F.col("toxic") + 0.5) / F.lit(toxic + 1)) / ((F.col("total") - F.col("toxic") + 0.5) / F.lit(clean + 1))
    strong = counted.withColumn("odds", odds).where((F.col("toxic") >= LEAST_DOCS) & (F.col("odds") >= LEAST_ODDS))
    best = strong.orderBy(F.desc(F.ln("odds") * F.col("toxic")), "kind", "entry").limit(LEXICON).collect()
    pick = lambda kind: np.sort(np.array([r["entry"] for r in best if r["kind"] == kind], np.int64).view(np.uint64))
    return Lexicon(pick(0), pick(1))


def _feature_task(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, beginnings = sent.value
        for batch in batches:
            data, offsets = textscan.text_bytes(batch.column(1))
            for lo, hi in textscan.slices(offsets):
                at = offsets[lo : hi + 1]
                x = features(data[at[0] : at[-1]], at - at[0], words, beginnings)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), *map(pa.array, np.ascontiguousarray(x.T))], ["id", *FEATURES]
                )

    return run


def text_features(docs: DataFrame, lexicon: Lexicon, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of features per document: id and the columns in FEATURES."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    sent = docs.sparkSession.sparkContext.broadcast((lexicon.words, lexicon.beginnings))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(_feature_task(sent), f"id {kind}, " + ", ".join(f"{c} double" for c in FEATURES))


@dataclass
class Model:
    """Lexicon, trees and calibration; without trees every score is ``constant``."""

    lexicon: Lexicon
    trees: GBTClassificationModel | None
    calibration: IsotonicRegressionModel | None
    constant: float

    def score(self, feats: DataFrame) -> DataFrame:
        """(id, score) per row of features: the calibrated probability of label 1."""
        if self.trees is None:
            return feats.select("id", F.lit(self.constant).alias("score"))
        raw = self.trees.transform(_assembled(feats)).withColumn("raw", vector_to_array("probability")[1])
        if self.calibration is None:
            return raw.select("id", F.col("raw").alias("score"))
        done = self.calibration.transform(raw.drop("prediction"))
        # Steps keep their order inside: a little of the raw score is mixed in.
        mixed = 0.98 * F.col("prediction") + 0.02 * F.col("raw")
        return done.select("id", F.greatest(F.lit(0.0), F.least(F.lit(1.0), mixed)).alias("score"))


def _assembled(feats: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=FEATURES, outputCol="vector").transform(feats)


def fit(
    docs: DataFrame, labels: DataFrame, learn: Column, label_col: str = "toxic", id_col: str = "doc_id",
    text_col: str = "text", sample_rows: int = SAMPLE_ROWS,
) -> Model:
    """Learn from at most ``sample_rows`` labelled rows where ``learn`` (over ``id``) holds.

    Those with the smallest hashes of their id are used; rows without a label or id are not. The
    lexicon and the trees see three quarters of them, the calibration the rest. With one class only,
    or no rows, the score is a constant.
    """
    marked = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label"))
    usable = marked.where("id is not null and label is not null").where(learn)
    drawn = materialise(smallest_hashes(usable, sample_rows, F.xxhash64(F.lit(9), "id"), "id", "label"), "toxic-sample")
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(drawn, "id")
    in_fold = F.pmod(F.xxhash64(F.lit(10), "id"), F.lit(FOLDS)) < GROW_FOLDS
    lexicon = learn_lexicon(texts.where(in_fold).select("text", "label"))
    sample = materialise(text_features(texts, lexicon, "id", "text").join(drawn, "id"), "toxic-features")
    sizes = sample.agg(
        F.count("*").alias("rows"), F.coalesce(F.sum("label"), F.lit(0)).alias("toxic"),
        F.count_if(in_fold).alias("grown"), F.count_if(in_fold & (F.col("label") == 1)).alias("grown_toxic"),
    ).first()
    if sizes["grown_toxic"] in (0, sizes["grown"]):
        return Model(lexicon, None, None, (sizes["toxic"] + 1.0) / (sizes["rows"] + 2.0))
    assembled = _assembled(sample).coalesce(4)
    trees = GBTClassifier(
        featuresCol="vector", labelCol="label", maxIter=TREES, maxDepth=DEPTH, stepSize=RATE, maxBins=64,
        minInstancesPerNode=5, maxMemoryInMB=256, seed=3,
    ).fit(assembled.where(in_fold))
    rest = trees.transform(assembled.where(~in_fold)).withColumn("raw", vector_to_array("probability")[1])
    rest = rest.select("raw", F.col("label").cast("double").alias("label"))
    if rest.select("label").distinct().count() < 2:
        return Model(lexicon, trees, None, 0.0)
    calibration = IsotonicRegression(featuresCol="raw", labelCol="label").fit(rest)
    return Model(lexicon, trees, calibration, 0.0)


def score_documents(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) per row of ``docs``: the probability of being toxic, from whole texts.

    A null, empty or blank text has all features 0 and gets the score of that. Repeated rows score
    alike. An empty table gives an empty result. Other columns are not read.
    """
    return model.score(text_features(docs, model.lexicon, id_col, text_col))

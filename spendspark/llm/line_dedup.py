"""Lines that many documents share are dropped from all but one of them; DataFrame functions only.

Lines are exploded into rows of two 64-bit hashes of their key, so the text of a line is never
shuffled. A line's documents are counted after a first grouping by line and document, which
combines on the map side: a line that every document holds costs one row per document there, and
one row per task in the count. Texts meet only the positions to drop.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendspark.session import materialise

# Characters stripped from a line, and letters that are lower-cased.
BLANKS = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
MIN_CHARS = 40
MIN_DOCS = 5


def line_key(line: Column) -> Column:
    """The line without blanks at its ends, A-Z lower-cased."""
    bare = F.trim(line, F.lit(BLANKS))
    # lower() agrees with A-Z folding on ASCII text and is much cheaper there.
    ascii_only = F.octet_length(bare) == F.char_length(bare)
    return F.when(ascii_only, F.lower(bare)).otherwise(F.translate(bare, UPPER, LOWER))


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def dropped_positions(
    docs: DataFrame, id_col: str, text_col: str, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS
) -> DataFrame:
    """(id, text_hash, drop): the positions that a document loses, where it loses any."""
    rows = docs.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("id"), text_hash(F.col(text_col)).alias("text_hash"), lines_of(F.col(text_col)).alias("line")
    )
    each = rows.select("id", "text_hash", F.posexplode("line").alias("position", "line"))
    keyed = each.select("id", "text_hash", "position", line_key(F.col("line")).alias("k")).where(
        F.char_length("k") >= min_chars
    )
    lines = materialise(
        keyed.select("id", "text_hash", "position", F.xxhash64("k").alias("h1"), F.xxhash64(F.lit(1), "k").alias("h2")),
        "lines",
    )
    shared = (
        lines.groupBy("h1", "h2", "id").agg(F.lit(1).alias("one"))
        .groupBy("h1", "h2").agg(F.count("*").alias("documents"), F.max("id").alias("last"))
        .where(F.col("documents") >= min_docs).select("h1", "h2", "last")
    )
    gone = lines.join(shared, ["h1", "h2"]).where("id <> last")
    return gone.groupBy("id", "text_hash").agg(F.collect_set("position").alias("drop"))


def text_hash(text: Column) -> Column:
    """Tells rows with the same id but another text apart."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def without_shared_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_chars: int = MIN_CHARS,
    min_docs: int = MIN_DOCS,
) -> DataFrame:
    """(doc, n_lines, n_dropped, kept_text) per row; ``doc`` is the whole row as a struct.

    A line whose key has at least ``min_chars`` code points and is found in at least ``min_docs``
    documents stays only in the document with the largest id that holds it, there as often as it
    stands. Documents are told apart by id, so repeated rows count once and all fare alike.

    A null or empty text is one empty line. A row without an id is not counted and loses nothing.
    An empty table gives an empty result. Other columns are carried along, whatever their names.
    """
    drops = dropped_positions(docs, id_col, text_col, min_chars, min_docs)
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.col(id_col).alias("id"),
        text_hash(F.col(text_col)).alias("text_hash"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    lines = F.split("text", "\n", -1)
    stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("drop"))
    picked = F.expr("transform(array(split(text, '\\n', -1)), l -> array_join(transform(stay, i -> l[i]), '\\n'))[0]")
    return (
        rows.join(drops, ["id", "text_hash"], "left")
        .withColumn("stay", F.when(F.col("drop").isNotNull(), stay))
        .select(
            "doc",
            F.size(lines).cast("long").alias("n_lines"),
            F.coalesce(F.size("drop"), F.lit(0)).cast("long").alias("n_dropped"),
            F.when(F.col("drop").isNull(), F.col("text")).otherwise(picked).alias("kept_text"),
        )
    )


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS,
                min_docs: int = MIN_DOCS) -> DataFrame:
    """(id, n_lines, n_dropped, kept_text) per row, as ``without_shared_lines`` has them."""
    rows = without_shared_lines(docs.select(id_col, text_col), id_col, text_col, min_chars, min_docs)
    return rows.select(F.col("doc").getField(id_col).alias(id_col), "n_lines", "n_dropped", "kept_text")

"""Document fingerprints of closed syncmers, in DataFrame functions only.

A text is a sequence of words, and a k-mer is k words in a row. It is a closed syncmer if the smallest
of its inner s-mers, by hash, is its first or its last one (Edgar 2021). That depends on the k-mer
alone and not on what stands around it, so an anchor survives every edit outside its own words, and
any k - s neighbouring k-mers have at least one. A fingerprint is the text's anchors in their order;
anchors with positions match two texts place by place.

Words are runs of at most 32 characters between white space, so that a long unbroken text has anchors,
too. A task holds the words of one text at a time, about 100 bytes each, however long the text is.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

K, S = 5, 2
WORD = r"[^\x20\x09-\x0D]{1,32}"
# A prime below 2**31, and multipliers that keep products within 64 bits.
PRIME, FACTOR, SPREAD = (1 << 31) - 1, 1_000_003, 48_271
# Ranges of ids for each shuffle partition.
RANGES = 4


def _rolled(values: Column, at: Column, n: int, factor: int) -> Column:
    """A hash of n values from a place on; null if there are fewer."""
    out = F.get(values, at)
    for i in range(1, n):
        out = (out * factor + F.get(values, at + i)) % PRIME
    return out


def _closed(first: Column, at: Column, inner: Column) -> Column:
    """Whether the first or the last inner hash of the k-mer at a place is its smallest; null beyond the last k-mer."""
    last, between = F.get(inner, at + (K - S)), range(1, K - S)

    def smallest(value: Column) -> Column:
        return reduce(and_, [value <= F.get(inner, at + i) for i in between])

    return F.when(first <= last, smallest(first)).otherwise(smallest(last))


def with_anchors(df: DataFrame, text_col: str, out: str) -> DataFrame:
    """Adds (at, anchor) of every closed syncmer of a whole text, in order; none below k words.

    ``at`` counts words from 0. Each step is a column of its own, so that it is computed once.
    """
    words, inner = f"{out}_words", f"{out}_inner"

    def found(first: Column, at: Column) -> Column:
        anchor = _rolled(F.col(words), at, K, SPREAD)
        return F.when(_closed(first, at, F.col(inner)), F.struct(at.alias("at"), anchor.alias("anchor")))

    numbers = F.transform(F.regexp_extract_all(text_col, F.lit(WORD), F.lit(0)), F.crc32)
    hashed = F.transform(F.col(words), lambda w, at: _rolled(F.col(words), at, S, FACTOR))
    made = df.withColumn(words, numbers).withColumn(inner, hashed)
    return made.withColumn(out, F.array_compact(F.transform(F.col(inner), found))).drop(words, inner)


def anchor_values(text: Column, found: Column) -> Column:
    """The anchors as numbers, in the order of the text.

    A text too short for one has a hash of itself as its only anchor; an empty text has none.
    """
    none = F.array().cast("array<bigint>")
    short = F.when(F.char_length(text) > 0, F.array(F.crc32(text))).otherwise(none)
    return F.when(F.size(found) > 0, F.transform(found, lambda a: a["anchor"])).otherwise(short)


def printed(values: Column) -> Column:
    """A fingerprint: anchors in their order, nine hexadecimal digits each, of which the first is 1."""
    return F.array_join(F.transform(values, lambda v: F.hex(v + (1 << 32))), "")


def likeness(a: Column, b: Column) -> Column:
    """Twice the shared part of all different anchors, from 0 to 1; two empty texts are alike."""
    total = F.size(a) + F.size(b)
    return F.when(total == 0, 1.0).otherwise(2.0 * F.size(F.array_intersect(a, b)) / total)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, anchors with positions, fingerprint) of every row; nothing is shuffled.

    A null text counts as empty. Equal texts have equal fingerprints. Rows without an id or with the
    same id are rows of their own. Other columns are not read.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    found = with_anchors(rows, "text", "anchors")
    return found.select("id", "anchors", printed(anchor_values(F.col("text"), F.col("anchors"))).alias("fingerprint"))


def matches(left: DataFrame, right: DataFrame) -> DataFrame:
    """(left_id, right_id, shift, n) of two outputs of ``fingerprints``: places that match at one shift.

    The join is on anchors; it finds every shared passage of at least 2k - s - 1 words, and
    its size is that of the matches. Passages that many texts share should be dropped before.
    """
    def places(found: DataFrame, side: str) -> DataFrame:
        each = found.select(F.col("id").alias(f"{side}_id"), F.explode("anchors").alias("a"))
        return each.select(f"{side}_id", F.col("a.at").alias(f"{side}_at"), F.col("a.anchor").alias("anchor"))

    met = places(left, "left").join(places(right, "right"), "anchor")
    shift = (F.col("right_at") - F.col("left_at")).alias("shift")
    return met.groupBy("left_id", "right_id", shift).agg(F.count(F.lit(1)).alias("n"))


def _range_edges(rows: DataFrame, partitions: int) -> list:
    """At most ``partitions`` - 1 ids that cut the rows into ranges of about equal size."""
    if partitions < 2:
        return []
    shares = [i / partitions for i in range(1, partitions)]
    found = rows.agg(F.percentile_approx("id", shares, max(10_000, 20 * partitions))).first()[0]
    return sorted(set(found or []))


def _range_number(edges: list) -> Column:
    """How many edges an id reaches, found in two steps of about the square root of their number; -1 without an id."""
    if not edges:
        return F.when(F.col("id").isNull(), -1).otherwise(0)
    width = max(1, round(len(edges) ** 0.5))
    blocks = [edges[i : i + width] for i in range(0, len(edges), width)]

    def reached(values: Column) -> Column:
        return F.size(F.filter(values, lambda e: e <= F.col("id")))

    block = reached(F.lit([b[0] for b in blocks])) - 1
    inside = reached(F.lit([b + [None] * (width - len(b)) for b in blocks])[block])
    number = F.when(block < 0, 0).otherwise(block * width + inside)
    return F.when(F.col("id").isNull(), -1).otherwise(number)


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, W]:
    """Rows in ranges of ascending ids, with a guest at the end of each range, and the window over a range.

    The guest is the first row of the next range (after the last: of the first), so that a row finds
    the next one within its range; one guest a range. Drop rows with ``guest`` in the end. Texts are
    shuffled once. Rows that share an id are in the order of their texts, those without an id come first;
    either lie in one range, so ids should mostly be their rows' own.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    # Ranges are dealt to partitions by hash; a few for each even that out.
    partitions = RANGES * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = rows.withColumn("range", _range_number(_range_edges(rows, partitions)))
    # One row a range: its number and first id.
    firsts = sorted(ranged.groupBy("range").agg(F.min("id").alias("id")).collect(), key=lambda r: r["range"])
    homes = [(first["id"], first["range"], firsts[i - 1]["range"]) for i, first in enumerate(firsts)]
    kind = rows.schema["id"].dataType.simpleString()
    homes = docs.sparkSession.createDataFrame(homes, f"id {kind}, range int, home int")
    first_rows = ranged.join(F.broadcast(homes.withColumnsRenamed({"id": "first_id", "range": "first_range"})),
        (F.col("range") == F.col("first_range")) & F.col("id").eqNullSafe(F.col("first_id")))
    guests = first_rows.groupBy("home", "id").agg(F.min("text").alias("text"))
    both = ranged.withColumn("guest", F.lit(False)).unionByName(
        guests.select("id", "text", F.col("home").alias("range"), F.lit(True).alias("guest"))
    )
    return both, W.partitionBy("range").orderBy("guest", F.col("id").asc_nulls_first(), "text")


def against_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each row's fingerprint beside that of its edited text and of the next row.

    The last quarter of the code points (rounded down) is replaced by the first as many of the next row's
    text, or by all of it. Extra columns are not read; an empty table gives no rows.
    """
    rows, place = with_next(docs, id_col, text_col)
    next_text = F.lead("text").over(place)
    sized = rows.withColumns({"next_text": next_text, "n_chars": F.char_length("text")}).withColumn(
        "kept", (F.col("n_chars") - F.floor(F.col("n_chars") / 4)).cast("int")
    )
    new = F.when(~F.col("guest"), F.substr("next_text", F.lit(1), F.col("n_chars") - F.col("kept"))).otherwise("")
    edited = F.concat(F.substr("text", F.lit(1), F.col("kept")), new).alias("edited")
    edits = sized.select("range", "id", "guest", "text", "n_chars", edited)
    found = with_anchors(with_anchors(edits, "text", "found"), "edited", "edited_found")
    values = found.withColumns({
        "own": anchor_values(F.col("text"), F.col("found")),
        "changed": anchor_values(F.col("edited"), F.col("edited_found")),
    }).withColumns({"set": F.array_distinct("own"), "changed_set": F.array_distinct("changed")})
    compared = values.select("range", "id", "guest", "text", "n_chars", "edited", "own", "changed", "set", "changed_set")
    return compared.withColumn("next_set", F.lead("set").over(place)).where(~F.col("guest")).select(
        "id",
        F.col("n_chars").cast("bigint").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        printed(F.col("own")).alias("fingerprint"),
        printed(F.col("changed")).alias("edited_fingerprint"),
        likeness(F.col("set"), F.col("changed_set")).alias("near_edited"),
        likeness(F.col("set"), F.col("next_set")).alias("near_next"),
    )

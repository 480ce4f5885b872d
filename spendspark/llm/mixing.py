"""Mixing sources to target weights by temperature, realised as budgeted block permutations.

A source's weight is its share of all tokens to the power a, normalised. At a = 1 sources keep
their shares, at a = 0 all weigh the same. The exponent is found by bisection: either the weights
have a wanted entropy, or no source is repeated more often than a limit allows. One pass over the
table of sources evaluates many exponents, so a pass does several bisection steps, and only sums
reach the driver however many sources there are.

Each source then gets its weight's part of the token budget. Its documents are dealt into blocks
by a hash; an epoch is a permutation of the blocks, seeded by the epoch's number. Whole epochs take
every document. The last, partial one takes the blocks up to the budget in the epoch's order, and in
the one block where the budget ends the documents up to it. So only sums per block, and the
documents of one block per source, are ever put in order, and no text is shuffled for the rest.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from spendspark.operators.lookup import left_lookup
from spendspark.session import materialise

# Blocks a source's documents are dealt into.
BLOCKS = 1024
SEED = 17
# Exponents that one pass evaluates between its ends, and passes: together about 2**-36.
GRID = 15
PASSES = 9
# Rows of a table per source that is broadcast; beyond that the join is salted.
BROADCAST_SOURCES = 100_000
WORD = r"[^\x20\x09-\x0D]+"


def token_count(text: Column) -> Column:
    """Words of a text, at least 1, so that every document takes room."""
    return F.greatest(F.lit(1), F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0))).cast("bigint")


def source_shares(sized: DataFrame) -> DataFrame:
    """(source, tokens, share) of rows with columns source and tokens."""
    sizes = sized.groupBy("source").agg(F.sum("tokens").alias("tokens"))
    total = sized.agg(F.sum("tokens")).first()[0] or 1
    return sizes.withColumn("share", F.col("tokens") / F.lit(float(total)))


def _sums(shares: DataFrame, exponents: list[float]) -> list[dict[str, float]]:
    """What the targets need to know about each exponent, in one pass over the sources."""
    parts = []
    for k, a in enumerate(exponents):
        power = F.pow("share", F.lit(a))
        parts += [
            F.sum(power).alias(f"z{k}"),
            F.sum(power * F.lit(a) * F.ln("share")).alias(f"e{k}"),
            F.max(F.pow("share", F.lit(a - 1.0))).alias(f"gain{k}"),
            F.max(F.pow("share", F.lit(1.0 - a))).alias(f"cover{k}"),
        ]
    row = shares.agg(*parts).first()
    return [{name: row[f"{name}{k}"] for name in ("z", "e", "gain", "cover")} for k in range(len(exponents))]


def entropy_of(at: dict[str, float]) -> float:
    """Entropy of the normalised weights."""
    return math.log(at["z"]) - at["e"] / at["z"]


def repeats_of(at: dict[str, float], budget_share: float | None) -> float:
    """How often the most repeated source is used; without a budget, by the one that uses all once."""
    return at["gain"] * at["cover"] if budget_share is None else budget_share * at["gain"] / at["z"]


def _bisect(shares: DataFrame, holds: Callable[[dict[str, float]], bool]) -> tuple[float, float]:
    """Neighbouring exponents between which ``holds`` turns from true to false, searched in [0, 1]."""
    low, high = 0.0, 1.0
    for _ in range(PASSES):
        grid = [low + (high - low) * i / (GRID + 1) for i in range(GRID + 2)]
        true = [holds(at) for at in _sums(shares, grid)]
        if not true[0]:
            return low, low
        if true[-1]:
            return high, high
        k = true.index(False)
        low, high = grid[k - 1], grid[k]
    return low, high


def find_exponent(
    shares: DataFrame, entropy_share: float | None = None, max_repeats: float | None = None, budget_share: float | None = None
) -> float:
    """The largest exponent that reaches the entropy, or the smallest that keeps the repetition limit.

    ``entropy_share`` is the wanted entropy over the largest possible one, the logarithm of the
    number of sources. ``max_repeats`` limits how often a source is used within a budget of
    ``budget_share`` times all tokens; without that, within the smallest budget that uses every token.
    With both targets the limit comes first. A target that no exponent in [0, 1] meets gives the end
    that comes closest; fewer than two sources give 1.
    """
    n = shares.count()
    if n < 2:
        return 1.0
    exponent = 0.0
    if entropy_share is not None:
        # A little below the goal counts as reached, so that rounding cannot miss the ends.
        goal = entropy_share * math.log(n) - 1e-12
        exponent = _bisect(shares, lambda at: entropy_of(at) >= goal)[0]
    if max_repeats is not None:
        limit = max_repeats + 1e-12
        exponent = max(exponent, _bisect(shares, lambda at: repeats_of(at, budget_share) > limit)[1])
    return exponent


def quotas(shares: DataFrame, exponent: float, budget_share: float | None) -> DataFrame:
    """(source, tokens, weight, quota): the weights and each source's part of the budget in tokens."""
    at = _sums(shares, [exponent])[0]
    if at["z"] is None:
        return shares.select("source", "tokens", F.col("share").alias("weight"), F.col("tokens").alias("quota"))
    # In units of all tokens, the smallest budget that uses everything is z * cover.
    budget = at["z"] * at["cover"] if budget_share is None else budget_share
    weight = F.pow("share", F.lit(exponent)) / F.lit(at["z"])
    quota = F.round(weight * F.lit(budget) * F.col("tokens") / F.col("share")).cast("bigint")
    return shares.select("source", "tokens", weight.alias("weight"), quota.alias("quota"))


def _place(epoch: Column, block: Column) -> Column:
    """A block's place in an epoch's permutation."""
    return F.struct(F.xxhash64(F.lit(SEED), epoch, block).alias("h"), block.alias("b"))


def _block(blocks: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(SEED + 1), "row"), F.lit(blocks)).cast("int")


def partial_epochs(sized: DataFrame, quota: DataFrame, blocks: int) -> tuple[DataFrame, DataFrame]:
    """What the budget takes of each source.

    The first table has one row per source: its whole epochs, the place of the last block that the
    partial epoch takes whole, and the block in which the budget ends. The second one says for the
    documents of those blocks whether they are taken: those that begin before the budget ends are.
    """
    whole = quota.select(
        "source",
        F.floor(F.col("quota") / F.col("tokens")).cast("bigint").alias("epochs"),
        (F.col("quota") % F.col("tokens")).alias("rest"),
        (F.col("quota") / F.col("tokens")).alias("length"),
    )
    sums = sized.groupBy("source", _block(blocks).alias("block")).agg(F.sum("tokens").alias("size")).join(whole, "source")
    sums = sums.withColumn("place", _place(F.col("epochs"), F.col("block")))
    earlier = W.partitionBy("source").orderBy("place").rowsBetween(W.unboundedPreceding, -1)
    placed = sums.withColumn("start", F.coalesce(F.sum("size").over(earlier), F.lit(0)))
    ends_inside = (F.col("start") < F.col("rest")) & (F.col("rest") < F.col("start") + F.col("size"))
    plan = materialise(
        placed.groupBy("source", "epochs", "rest", "length").agg(
            F.max(F.when(F.col("start") + F.col("size") <= F.col("rest"), F.col("place"))).alias("last"),
            F.max(F.when(ends_inside, F.col("block"))).alias("cut_block"),
            F.max(F.when(ends_inside, F.col("start"))).alias("cut_start"),
        ),
        "mixing-plan",
    )
    inside = left_lookup(sized.withColumn("block", _block(blocks)), plan, "source", ["row"], BROADCAST_SOURCES).where(
        "block = cut_block"
    )
    order = W.partitionBy("source").orderBy(F.xxhash64(F.lit(SEED), "epochs", "row"), "row")
    before = F.coalesce(F.sum("tokens").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    ended = inside.withColumn("taken", F.col("cut_start") + before < F.col("rest"))
    return plan, materialise(ended.groupBy("row", "source").agg(F.max("taken").alias("cut_taken")), "mixing-cut")


def mixed_rows(
    docs: DataFrame,
    entropy_share: float | None = None,
    max_repeats: float | None = None,
    budget_share: float | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    blocks: int = BLOCKS,
) -> DataFrame:
    """(doc, mix_copy, mix_order): each row as a struct, once for each time it is used.

    mix_copy counts the uses of a document from 0. Sorted by mix_order, from 0 to 1, the copies of a
    source follow its block permutations, and every stretch holds the sources at about their weights.
    A source's tokens reach its part of the budget within one document. Tokens are counted in words.

    Rows without a source are a source of their own. Rows that share an id and a text are used
    equally often; an id may be null. A document without words counts as one token. An empty table
    gives an empty result. Other columns are carried along, whatever their names.
    """
    source = F.col(source_col).cast("string")
    keyed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"),
        F.xxhash64(F.col(id_col), F.coalesce(F.col(text_col), F.lit(""))).alias("row"),
        F.when(source.isNull(), F.lit("none")).otherwise(F.concat(F.lit("source "), source)).alias("source"),
        token_count(F.col(text_col)).alias("tokens"),
    )
    sized = materialise(keyed.select("row", "source", "tokens"), "mixing-rows")
    shares = materialise(source_shares(sized), "mixing-shares")
    quota = quotas(shares, find_exponent(shares, entropy_share, max_repeats, budget_share), budget_share)
    plan, cut = partial_epochs(sized, quota, blocks)
    dealt = left_lookup(
        keyed.select("doc", "row", "source").withColumn("block", _block(blocks)), plan, "source", ["row"], BROADCAST_SOURCES
    )
    in_cut = F.coalesce(F.col("block") == F.col("cut_block"), F.lit(False))
    before_cut = F.coalesce(_place(F.col("epochs"), F.col("block")) <= F.col("last"), F.lit(False))
    outside = dealt.where(~in_cut).withColumn("taken", before_cut)
    inside = dealt.where(in_cut).join(cut, ["row", "source"]).withColumnRenamed("cut_taken", "taken")
    columns = ["doc", "block", "length", (F.col("epochs") + F.col("taken").cast("bigint")).alias("copies")]
    used = outside.select(*columns).union(inside.select(*columns)).where("copies > 0")
    copies = used.withColumn("mix_copy", F.explode(F.sequence(F.lit(0), F.col("copies").cast("int") - 1)))
    share = _place(F.col("mix_copy").cast("bigint"), F.col("block")).getField("h") / F.lit(2.0**64) + F.lit(0.5)
    return copies.select(
        "doc",
        "mix_copy",
        F.least(F.lit(1.0), (F.col("mix_copy") + share) / F.col("length")).alias("mix_order"),
    )


def mix(docs: DataFrame, **options) -> DataFrame:
    """The columns of ``docs`` with mix_copy and mix_order, as ``mixed_rows`` has them.

    Columns of these two names that ``docs`` has itself are replaced.
    """
    rows, own = mixed_rows(docs, **options), ("mix_copy", "mix_order")
    return rows.select(*[F.col("doc").getField(c).alias(c) for c in docs.columns if c not in own], *own)

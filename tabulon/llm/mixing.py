"""Temperature mixing of sources, realised as budgeted block permutations.

The weight of a source is its share of all tokens to the power of an exponent,
normalised. At exponent 1 the sources keep their shares, at 0 all weigh the same.
The exponent is found by bisection: as small as the limits allow.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabulon.llm.common import stored, words_of

STEPS = 50
#: Halvings that are worked out in one job.
AT_ONCE = 5


def source_totals(docs: DataFrame, source: str, tokens: Column) -> DataFrame:
    return (
        docs.select(F.coalesce(F.col(source).cast("string"), F.lit("")).alias("source"), tokens.cast("long").alias("n"))
        .groupBy("source")
        .agg(F.sum("n").alias("tokens"))
        .where(F.col("tokens") > 0)
    )


def _at(totals: DataFrame, all_tokens: int, exponents: list[float]) -> list[tuple[float, float]]:
    """For each exponent the entropy of the weights, and the most repeated source's rate over the least repeated one's."""
    share = F.col("tokens") / F.lit(float(all_tokens))
    tried = F.posexplode(F.array(*[F.lit(e) for e in exponents])).alias("place", "exponent")
    weights = totals.select(share.alias("p"), tried).withColumn("w", F.pow("p", "exponent"))
    rows = weights.groupBy("place").agg(
        F.sum("w").alias("z"),
        F.sum(F.col("w") * F.log("w")).alias("wlogw"),
        F.max(F.col("w") / F.col("p")).alias("most"),
        F.min(F.col("w") / F.col("p")).alias("least"),
    ).collect()
    found = {r["place"]: (math.log(r["z"]) - r["wlogw"] / r["z"], r["most"] / r["least"]) for r in rows}
    return [found[k] for k in range(len(exponents))]


def find_exponent(totals: DataFrame, all_tokens: int, entropy_gain: float | None, max_repetition: float | None) -> float:
    """The smallest exponent in [0, 1] that keeps within both limits, by ``STEPS`` halvings.

    ``entropy_gain``: the target entropy, as the part of the way from that of the
    natural shares (0) to that of equal weights (1). ``max_repetition``: how often
    the most repeated source may be seen while the least repeated one is seen once.
    Each job is one aggregation over one row per source, for all middles that the
    next ``AT_ONCE`` halvings may come to.
    """
    (natural, _), (equal, _) = _at(totals, all_tokens, [1.0, 0.0])
    target = math.inf if entropy_gain is None else natural + entropy_gain * (equal - natural)
    limit = math.inf if max_repetition is None else max_repetition
    low, high = 0.0, 1.0
    for done in range(0, STEPS, AT_ONCE):
        steps = min(AT_ONCE, STEPS - done)
        ahead = [(low, high)]
        for _ in range(steps - 1):
            ahead += [half for a, b in ahead[len(ahead) // 2 :] for half in ((a, (a + b) / 2), ((a + b) / 2, b))]
        middles = [(a + b) / 2 for a, b in ahead]
        known = dict(zip(middles, _at(totals, all_tokens, middles)))
        for _ in range(steps):
            middle = (low + high) / 2
            entropy, repetition = known[middle]
            if entropy > target or repetition > limit:
                low = middle
            else:
                high = middle
    return high


def mix_sources(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    source_col: str = "source",
    tokens: Column | None = None,
    entropy_gain: float | None = 0.5,
    max_repetition: float | None = 2.0,
    budget: float | None = None,
    seed: int = 17,
    blocks: int = 16**3,
) -> DataFrame:
    """Repeat documents so that their sources get the mixing weights.

    Returns all columns of ``docs`` and, per appearance of a document, epoch (from
    1), block and mix_key (columns of these names are replaced): read in the order
    of epoch and mix_key, the blocks of a source come in a new permutation each epoch.
    ``budget`` is the number of tokens of the mix; without one it is the smallest at
    which every source is seen in full at least once, so that no document is lost.

    A source's part of the budget is spent on whole epochs and then on a part of one more: its
    documents are put in the order of a hash of seed and id, cut into ``blocks``
    blocks by the first digits of the hash, and taken as long as their tokens fit.
    Only totals of blocks are summed up; single documents are summed up in the one
    block per source where the budget ends. Repeated rows share a hash and are taken
    together.

    Tokens are words unless given. A null source is a source of its own; a null or
    empty text has no tokens and costs nothing; a source without any tokens has no weight
    and is seen once.
    A null id counts as the empty one. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    digits = round(math.log(blocks, 16))
    tokens = F.size(words_of("text")) if tokens is None else tokens
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))))
    source = F.coalesce(F.col(source_col).cast("string"), F.lit(""))
    sized = stored(docs.select(source.alias("source"), key.alias("key"), tokens.cast("long").alias("n")), "sizes")
    by_block = stored(
        sized.groupBy("source", F.substring("key", 1, digits).alias("block")).agg(F.sum("n").alias("n")), "block-sizes"
    )
    totals = stored(source_totals(by_block, "source", F.col("n")), "source-sizes")
    all_tokens = totals.agg(F.sum("tokens")).first()[0] or 0
    if all_tokens:
        exponent = find_exponent(totals, all_tokens, entropy_gain, max_repetition)
    else:
        exponent = 1.0
    weighed = totals.withColumn("w", F.pow(F.col("tokens") / F.lit(float(max(1, all_tokens))), F.lit(exponent)))
    sums = weighed.agg(F.sum("w").alias("z"), F.max(F.col("tokens") / F.col("w")).alias("scale")).first()
    if budget is None:
        need = F.greatest(F.col("w") * F.lit(sums["scale"] or 0.0), F.col("tokens").cast("double"))
    else:
        need = F.col("w") / F.lit(sums["z"] or 1.0) * F.lit(float(budget))
    plan = weighed.withColumn("need", need).select(
        "source",
        F.floor(F.col("need") / F.col("tokens")).alias("epochs"),
        (F.col("need") - F.floor(F.col("need") / F.col("tokens")) * F.col("tokens")).alias("left"),
    )
    # Where the last, partial epoch ends: first by block, then by document in that block.
    upto = Window.partitionBy("source").orderBy("block")
    placed = by_block.join(plan, "source").withColumn("before", F.sum("n").over(upto) - F.col("n"))
    last = (
        placed.where((F.col("before") <= F.col("left")) & (F.col("before") + F.col("n") > F.col("left")))
        .groupBy("source")
        .agg(F.min(F.struct("block", "before", "left")).alias("at"))
    )
    # Joined by block as well: of a hot source only the rows of that one block move on.
    in_block = sized.withColumn("block", F.substring("key", 1, digits))
    inside = in_block.join(last.select("source", "at.*"), ["source", "block"])
    taken = (
        inside.withColumn("sum", F.sum("n").over(Window.partitionBy("source").orderBy("key")) + F.col("before"))
        .where(F.col("sum") <= F.col("left"))
        .groupBy("source")
        .agg(F.max("key").alias("last_key"))
    )
    ends = stored(
        plan.join(last.select("source", F.col("at.block").alias("last_block")), "source", "left")
        .join(taken, "source", "left")
        .select("source", "epochs", F.coalesce("last_key", "last_block").alias("until")),
        "mix",
    )
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    ours = ("epoch", "block", "mix_key")
    times = F.col("epochs") + F.coalesce(F.col("key") <= F.col("until"), F.lit(False)).cast("long")
    mixed = (
        docs.select(row, source.alias("source"), key.alias("key"))
        .join(ends, "source", "left")
        .select("_row", "key", "source", F.coalesce(times, F.lit(1).cast("long")).alias("times"))
        .where(F.col("times") > 0)
        .select("*", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))).alias("epoch"))
    )
    block = F.substring("key", 1, digits)
    return mixed.select(
        *[F.col("_row")[c].alias(c) for c in docs.columns if c not in ours],
        "epoch",
        block.alias("block"),
        F.concat(F.md5(F.concat_ws(":", F.lit(str(seed)), "epoch", "source", block)), "key").alias("mix_key"),
    )

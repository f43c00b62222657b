"""Mixing sources to target weights.

A source with the share p of all tokens gets the weight p ** a, normalised.
The exponent a in [0, 1] (0: all alike, 1: as they come) is bisected until the
weights' entropy meets a share of the highest possible one; it is raised again
as far as a limit on repetitions asks for, which also holds where a budget asks
for more. Every pass over the table of
shares tests ``POINTS`` exponents at once, five halvings in one.

The weights then become a sequence of blocks. Each pass through a source
(epoch) is a permutation of its documents by hash; prefix sums of tokens place
each document at its share of the source's tokens, and so in a block. Each
block holds every source by its weight. A copy whose place is behind the
source's last token is left out, which is what a budget means; without one,
the sequence is long enough for every document to come at least once.

Prefix sums are taken in buckets of about ``BUCKET`` documents and moved up by
the buckets before, so a source with most of the rows is no single task.

Defined results: a NULL source is a source of its own; a document without
words counts as one token; repeated rows are documents of their own; an empty
table gives no rows. Columns of the input are kept; ``_mix`` is replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from envstream.llm.common import table
from envstream.session import materialise

POINTS = 33
PASSES = 4
BUCKET = 2048
BLOCK_TOKENS = 1 << 20
ENTROPY = 0.95
MAX_REPEATS = 2.0
#: The table of weights is sent to all tasks up to this many bytes.
SMALL = 4 << 20


def n_tokens(text: Column) -> Column:
    words = F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"))
    return F.greatest(words, F.lit(1)).cast("long")


def shares(df: DataFrame, source: str, tokens: str) -> DataFrame:
    """source, n_docs, n_tokens; written once, since the search reads it again and again."""
    counted = df.groupBy(F.col(source).alias("source")).agg(
        F.count("*").alias("n_docs"), F.sum(tokens).alias("n_tokens"))
    return materialise(counted)


def _measures(found: DataFrame, total: int, points, budget):
    """(entropy, most repetitions) of the weights at each exponent, in one pass. The
    exponents are rows: as parts of expressions, each pass would be a program of its own
    that the driver compiles and keeps."""
    tried = found.select(
        F.ln(F.col("n_tokens") / F.lit(float(total))).alias("p"),
        F.posexplode(F.lit([float(a) for a in points])).alias("i", "a"))
    part = F.exp(F.col("p") * F.col("a"))
    ratio = F.col("p") * (F.col("a") - 1)
    rows = tried.groupBy("i").agg(
        F.sum(part).alias("z"), F.sum(part * F.col("p") * F.col("a")).alias("s"),
        F.max(ratio).alias("high"), F.min(ratio).alias("low")).collect()
    out = []
    for row in sorted(rows, key=lambda row: row["i"]):
        entropy = math.log(row["z"]) - row["s"] / row["z"]
        if budget is None:  # the least repeated source comes once
            repeats = math.exp(row["high"] - row["low"])
        else:
            repeats = math.exp(row["high"]) / row["z"] * budget / total
        out.append((entropy, repeats))
    return out


def _bisect(holds_below, measure, passes=PASSES, points=POINTS):
    """The last exponent in [0, 1] tried for which ``holds_below`` is true (monotone),
    and the first one for which it is not."""
    low, high = 0.0, 1.0
    if holds_below(*measure([1.0])[0]):
        return 1.0, 1.0
    for _ in range(passes):
        grid = [low + (high - low) * k / (points - 1) for k in range(points - 1)] + [high]
        fits = [holds_below(*m) for m in measure(grid)]
        if not fits[0]:
            return low, low
        last = max(k for k in range(points) if all(fits[: k + 1]))
        low, high = grid[last], grid[last + 1]
    return low, high


def exponent(found: DataFrame, total: int, n_sources: int, entropy=ENTROPY,
             max_repeats=MAX_REPEATS, budget=None) -> float:
    """Entropy falls and repetitions fall as the exponent grows."""
    target = entropy * math.log(n_sources) if n_sources > 1 else 0.0

    def measure(points):
        return _measures(found, total, points, budget)

    flat = 0.0 if entropy is None else _bisect(lambda h, _: h >= target - 1e-12, measure)[0]
    if max_repeats is None:
        return flat
    if measure([flat])[0][1] <= max_repeats:
        return flat
    # The end that keeps the limit, not the one that still breaks it.
    return _bisect(lambda _, r: r > max_repeats, measure)[1]


def weights(found: DataFrame, entropy=ENTROPY, max_repeats=MAX_REPEATS, budget=None) -> DataFrame:
    """source, n_docs, n_tokens, weight, target (tokens of the sequence)."""
    row = found.agg(F.sum("n_tokens"), F.count("*")).first()
    total, n_sources = row[0] or 0, row[1]
    if not n_sources:
        return found.select(
            "*", F.lit(0.0).alias("weight"), F.lit(0).cast("long").alias("target"),
            F.lit(0).cast("long").alias("n_blocks"))
    a = exponent(found, total, n_sources, entropy, max_repeats, budget)
    p = F.ln(F.col("n_tokens") / F.lit(float(total)))
    z, rare = found.agg(F.sum(F.exp(p * a)), F.max(p * (1 - a))).first()
    length = budget if budget is not None else math.exp(rare) * z * total
    weight = F.exp(p * a) / F.lit(z)
    target = F.round(weight * F.lit(float(length)))
    if max_repeats is not None:  # nor may rounding bring one more copy
        target = F.least(target, F.floor(F.col("n_tokens") * F.lit(float(max_repeats))))
    if budget is None:  # rounding must not cost a document
        target = F.greatest(target, F.col("n_tokens"))
    return found.select(
        "*", weight.alias("weight"), target.cast("long").alias("target"),
        F.lit(max(1, math.ceil(length / BLOCK_TOKENS))).cast("long").alias("n_blocks"))


def mixed(df: DataFrame, text="text", doc_id="doc_id", source="source", entropy=ENTROPY,
          max_repeats=MAX_REPEATS, budget=None, seed=17, tokens=None) -> DataFrame:
    """The copies that make up the sequence: the rows' columns and a struct ``_mix``
    (epoch, n_tokens, block, key): read blocks in order, inside by key."""
    # The rows travel in one column, so that no name of theirs clashes.
    counted = df.select(
        F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("row"),
        F.col(doc_id).alias("id"), F.col(source).alias("s"),
        (F.col(tokens) if tokens else n_tokens(F.col(text))).alias("n"))
    found = shares(counted, "s", "n")
    weighed = weights(found, entropy, max_repeats, budget)
    size = found.agg(F.sum(F.length(F.coalesce("source", F.lit(""))) * 4 + 48)).first()[0] or 0
    weighed = weighed.select(
        F.col("source").alias("w_s"), F.struct("n_docs", "n_tokens", "target", "n_blocks")
        .alias("w"))
    if size <= SMALL:
        weighed = F.broadcast(weighed)
    rows = counted.join(weighed, F.col("s").eqNullSafe(F.col("w_s"))).where("w.target > 0")
    last = F.ceil(F.col("w.target") / F.col("w.n_tokens")) - 1
    rows = rows.withColumn(
        "epoch", F.explode(F.sequence(F.lit(0).cast("long"), last.cast("long"))))
    rows = rows.withColumn("key", F.xxhash64(F.lit(seed), "epoch", "id", "n")).withColumn(
        "bucket", F.pmod("key", F.ceil(F.col("w.n_docs") / BUCKET).cast("long")))
    # Without NULL in them these also are the keys of the join, which then finds the rows
    # where the window has left them.
    rows = rows.withColumn("named", F.coalesce("s", F.lit(""))).withColumn(
        "unnamed", F.col("s").isNull())
    bucket = ["named", "unnamed", "epoch", "bucket"]
    sums = rows.groupBy(*bucket).agg(F.sum("n").alias("n"))
    before = Window.partitionBy(*bucket[:3]).orderBy("bucket").rowsBetween(
        Window.unboundedPreceding, -1)
    offsets = sums.select(
        *(F.col(c).alias("o_" + c) for c in bucket),
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy(*bucket).orderBy("key", "id").rowsBetween(
        Window.unboundedPreceding, -1)
    placed = rows.withColumn("inside", F.coalesce(F.sum("n").over(inside), F.lit(0)))
    placed = placed.join(offsets, [F.col(c) == F.col("o_" + c) for c in bucket])
    place = F.col("epoch") * F.col("w.n_tokens") + F.col("offset") + F.col("inside")
    placed = placed.withColumn("place", place).where("place < w.target")
    # Exact for any size: the place is cut into blocks by the quotient of decimals.
    block = F.floor(F.col("place").cast("decimal(38,0)") * F.col("w.n_blocks")
                    / F.col("w.target")).cast("long")
    return placed.select(
        *(F.col(f"row.`{c}`") for c in df.columns if c != "_mix"), F.struct(
            "epoch", F.col("n").alias("n_tokens"), block.alias("block"), "key").alias("_mix"))


def op1_source_mixing(spark, sf_dir):
    """Every copy in the sequence: epoch, n_tokens, block and place in the block."""
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "source", n_tokens(F.col("text")).alias("n"))
    rows = mixed(docs, tokens="n")
    place = F.row_number().over(Window.partitionBy("_mix.block").orderBy("_mix.key", "doc_id"))
    return rows.select(
        "doc_id", "source", "_mix.epoch", "_mix.n_tokens", "_mix.block",
        place.cast("long").alias("place"))

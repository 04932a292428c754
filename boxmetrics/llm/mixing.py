"""Mixing sources to target weights with a temperature.

The token shares p of the sources are raised to an exponent and normalised:
q = p^a / sum(p^a). The exponent is found by bisection so that q meets a target
entropy, or so that no source is repeated more often than a limit; the sums it
needs are taken by Spark, however many sources there are. The weights
are then realised from a budget of tokens. The documents of a source are dealt
into blocks by hash; each epoch takes the source's blocks in an order of its
own, whole epochs first, then blocks until the budget is used. Within a block
documents follow a hash order. A row's ``at`` is the part of its source's
tokens before its block; sorted by it, all sources run out together.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import staged, table

BLOCK_TOKENS = 1 << 20
WORDS = r"[^\x20\x09-\x0D]+"


def weights_at(shares: list[float], exponent: float) -> list[float]:
    """Normalised p^exponent; a source without tokens gets no weight."""
    top = max(shares, default=0.0)
    raw = [math.exp(exponent * math.log(p / top)) if p > 0 else 0.0 for p in shares]
    total = sum(raw)
    return [r / total for r in raw] if total else raw


def entropy(weights: list[float]) -> float:
    return -sum(w * math.log(w) for w in weights if w > 0)


class Curve:
    """Sums over the sources at many exponents at once, by Spark: the sources themselves stay where they are."""

    def __init__(self, sources: DataFrame):
        """``sources`` has a row a source with its ``share`` of all tokens."""
        self.shares = sources.where("share > 0").groupBy("share").agg(F.count("*").alias("n"))
        low, high = self.shares.agg(F.min("share"), F.max("share")).first()
        self.low, self.high = low, high

    def at(self, exponents: list[float]) -> list[tuple[float, float]]:
        """(log of sum p^a relative to the largest, entropy of p^a / sum p^a) for each exponent a."""
        log = F.log(F.col("share") / F.lit(self.high))
        sums = []
        for i, a in enumerate(exponents):
            raised = F.col("n") * F.exp(a * log)
            sums += [F.sum(raised).alias(f"z{i}"), F.sum(raised * log).alias(f"l{i}")]
        r = self.shares.agg(*sums).first()
        return [(math.log(r[f"z{i}"]), math.log(r[f"z{i}"]) - a * r[f"l{i}"] / r[f"z{i}"]) for i, a in enumerate(exponents)]

    def log_ratio(self, share: float, exponent: float, log_sum: float) -> float:
        """log(q / p) of a source with this share."""
        return exponent * math.log(share / self.high) - log_sum - math.log(share)

    def most_repeated(self, exponent: float, log_sum: float, budget_share: float | None) -> float:
        """Epochs of the most repeated source. Without a budget: when the least repeated is taken once."""
        ends = [self.log_ratio(p, exponent, log_sum) for p in (self.low, self.high)]
        return math.exp(max(ends)) * budget_share if budget_share is not None else math.exp(max(ends) - min(ends))


SECTIONS = 32  # of an interval, tried in one pass over the sources
PASSES = 11


def solve_exponent(curve: Curve, target_entropy: float | None = None, repetition_limit: float | None = None, budget_share: float | None = None) -> float:
    """The exponent, by bisection; each pass over the sources does five halvings at once.

    1 keeps the shares, 0 makes all sources equal, more than 1 favours the large
    ones. Entropy falls as the exponent rises: the exponent is the largest that
    reaches ``target_entropy``. Repetition falls as it rises to 1: the exponent
    is the smallest within ``repetition_limit``. A target out of reach gives the
    nearest weights there are: equal ones, those of the shares, or for an
    entropy below all that can be had, the largest exponent tried.
    """
    if (target_entropy is None) == (repetition_limit is None):
        raise ValueError("state target_entropy or repetition_limit")
    if curve.low is None:
        return 0.0

    def holds(exponents: list[float]) -> list[bool]:
        """Whether the exponent is on the lower side of the one looked for."""
        found = zip(exponents, curve.at(exponents), strict=True)
        if target_entropy is not None:
            return [h >= target_entropy for _, (_, h) in found]
        return [curve.most_repeated(a, z, budget_share) > repetition_limit for a, (z, _) in found]

    lo, hi = 0.0, 1.0
    if not holds([0.0])[0]:
        return 0.0
    if target_entropy is not None:
        powers = [2.0**i for i in range(1, 16)]
        above = [hi] + [p for p, ok in zip(powers, holds([1.0, *powers]), strict=False) if ok]  # the power before holds: look up to this one
        hi = above[-1]
    if holds([hi])[0]:
        return hi
    for _ in range(PASSES):
        inner = [lo + (hi - lo) * i / SECTIONS for i in range(1, SECTIONS)]
        edges = [lo, *[x for x, ok in zip(inner, holds(inner), strict=True) if ok]]
        lo, hi = edges[-1], min([x for x in inner if x > edges[-1]], default=hi)
    return lo if target_entropy is not None else hi


def mix(
    docs: DataFrame,
    target_entropy: float | None = None,
    repetition_limit: float | None = None,
    budget: int | None = None,
    block_tokens: int = BLOCK_TOKENS,
    seed: int = 7,
    carry: tuple[str, ...] = (),
    name: str | None = None,
) -> DataFrame:
    """One row per use of a document: (doc_id, source, tokens, epoch, block, at, within), and the columns ``carry``.

    Without ``budget`` the tokens are as many as let the least repeated source
    be used exactly once, so every document is used. With one, the document that
    crosses a source's budget is still used and later ones are not. Tokens are
    words. A null source counts as the source named "". Documents without words
    are used with their block. A row is named by its id, source and the SHA-256
    of its text (or the column ``name``), repeated ones by their number too, so
    null and repeated ids lose and multiply nothing, repeated rows are used
    each, and the mixture does not depend on how the rows lie. The names in
    ``carry`` must differ from those above. An empty table gives no rows.
    """
    words = F.regexp_count(F.coalesce(F.col("text").cast("string"), F.lit("")), F.lit(WORDS)).cast("long")
    named = (F.sha2(F.coalesce(F.col("text").cast("string"), F.lit("")), 256) if name is None else F.col(name)).alias("_name")
    own = docs.select("doc_id", F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"), words.alias("tokens"), named, *carry)
    equal = Window.partitionBy("doc_id", "source", "_name").orderBy(*(carry or ["tokens"]))
    own = staged(own.withColumn("_n", F.row_number().over(equal)), "mixing")
    found = own.groupBy("source").agg(F.sum("tokens").alias("all"))
    total = found.agg(F.sum("all")).first()[0] or 0
    found = staged(found.withColumn("share", F.col("all") / F.lit(float(total or 1))), "mixing-sources")
    curve = Curve(found)
    share = budget / total if budget is not None and total else None
    exponent = solve_exponent(curve, target_entropy, repetition_limit, share)
    sources = _plan(found, curve, exponent, total, budget, block_tokens)
    # Catalyst sends the sources to the rows where their table is small, and joins by sorting where it is not
    placed = own.join(sources, "source").withColumn("block", F.pmod(F.xxhash64(F.lit(seed), "doc_id", "_name", "_n"), "blocks"))
    uses = _realised(placed.groupBy("source", "block").agg(F.sum("tokens").alias("block_tokens"), *[F.first(c).alias(c) for c in ("whole", "rest", "epochs")]), seed)
    rows = placed.select("doc_id", "_name", "_n", "source", "tokens", "block", *carry).join(uses, ["source", "block"]).withColumn("within", F.xxhash64(F.lit(seed), "epoch", "doc_id", "_name", "_n"))
    out = ["doc_id", "source", "tokens", "epoch", "block", "at", "within", *carry]
    # only the block that crosses a source's budget is cut, document by document
    upto = Window.partitionBy("source", "block", "epoch").orderBy("within", "doc_id", "_name", "_n").rowsBetween(Window.unboundedPreceding, -1)
    cut = rows.where("partial").withColumn("used", F.coalesce(F.sum("tokens").over(upto), F.lit(0))).where(F.col("used") < F.col("left"))
    return rows.where("NOT partial").select(*out).union(cut.select(*out))


def _plan(found: DataFrame, curve: Curve, exponent: float, total: int, budget: int | None, block_tokens: int) -> DataFrame:
    """Per source: blocks, whole epochs, tokens beyond them, and epochs in all."""
    if curve.low is None:
        weight, tokens = F.lit(0.0), 0.0
    else:
        log_sum = curve.at([exponent])[0][0]
        weight = F.when(F.col("share") > 0, F.exp(exponent * F.log(F.when(F.col("share") > 0, F.col("share")) / F.lit(curve.high)) - F.lit(log_sum))).otherwise(0.0)
        least = min(curve.log_ratio(p, exponent, log_sum) for p in (curve.low, curve.high))
        tokens = float(budget) if budget is not None else total / math.exp(least)
    want = weight * F.lit(tokens)
    epochs = F.when(F.col("all") > 0, want / F.col("all")).otherwise(1.0)
    rows = found.select("source", "all", want.alias("want"), epochs.alias("epochs"), F.floor(epochs + 1e-9).cast("int").alias("whole"))
    rest = F.when(F.col("all") > 0, F.greatest(F.lit(0.0), F.col("want") - F.col("whole") * F.col("all"))).otherwise(0.0)
    return rows.select("source", F.greatest(F.lit(1), F.ceil(F.col("all") / F.lit(block_tokens))).alias("blocks"), "whole", rest.alias("rest"), F.greatest("epochs", F.lit(1e-12)).alias("epochs"))


PILES = 1024  # of a source's blocks in an epoch; the order of blocks is that of their piles, then within


def _realised(blocks: DataFrame, seed: int) -> DataFrame:
    """Uses of blocks (source, block, epoch, at, left, partial): each epoch orders them by a hash of its own.

    The running sum over a source's blocks is taken in two steps, over piles of
    blocks and within each, so the blocks of one source need not meet in a task.
    """
    uses = blocks.select("*", F.explode(F.sequence(F.lit(0), "whole")).alias("epoch")).withColumn("order", F.xxhash64(F.lit(seed), "epoch", "block"))
    uses = uses.withColumn("pile", F.shiftrightunsigned("order", 64 - (PILES - 1).bit_length()))
    upto = lambda w: F.coalesce(F.sum("size").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    piles = uses.groupBy("source", "epoch", "pile").agg(F.sum("block_tokens").alias("size"))
    by_epoch = Window.partitionBy("source", "epoch")
    piles = piles.select("source", "epoch", "pile", upto(by_epoch.orderBy("pile")).alias("earlier"), F.sum("size").over(by_epoch).alias("full"))
    uses = uses.withColumn("size", F.col("block_tokens")).withColumn("inside", upto(Window.partitionBy("source", "epoch", "pile").orderBy("order", "block"))).drop("size")
    uses = uses.join(piles, ["source", "epoch", "pile"]).withColumn("before", F.col("earlier") + F.col("inside"))
    uses = uses.withColumn("left", F.when(F.col("epoch") < F.col("whole"), F.lit(None)).otherwise(F.col("rest") - F.col("before")))
    uses = uses.where("left IS NULL OR left > 0.5")
    whole = F.col("before") / F.greatest("full", F.lit(1))
    part = F.col("before") / F.greatest("rest", F.lit(1.0)) * (F.col("epochs") - F.col("whole"))
    uses = uses.withColumn("at", (F.col("epoch") + F.when(F.col("epoch") < F.col("whole"), whole).otherwise(part)) / F.col("epochs"))
    uses = uses.withColumn("partial", F.coalesce(F.col("left") < F.col("block_tokens"), F.lit(False)))
    return uses.select("source", "block", "epoch", "at", "left", "partial")


def op7_temperature_mix(spark, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"), repetition_limit=2.0)

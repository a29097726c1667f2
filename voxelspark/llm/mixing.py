"""Mixing sources to target weights. DataFrame functions only.

A source's share of all tokens is raised to an exponent between 0 and 1 (a temperature) and normalised to its weight. The
exponent is found by bisection: for a target entropy, the one whose weights have it; for a repetition limit, the least one
at which no source is read more often than the limit. With both, the larger of the two. The bisection takes several steps
in one pass: an aggregate over the table of sources tests ``CUTS`` exponents at once, so no task ever holds all sources.

The budget of tokens is dealt to the sources by weight, and within a source to blocks of about ``block_rows`` documents in
proportion to their tokens. A block is read in passes: each pass is a permutation of its own, all passes but the last are
whole, and the last one stops at the document with which the block's budget is best met. So every block is independent of
all others, and a source of any size is dealt to many tasks.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from .common import materialize

SPACE = r"[\x20\x09-\x0D]+"
#: Exponents that are tested in one pass, and passes: 32 ** 7 parts of the unit interval.
CUTS, PASSES = 31, 7
#: Rows of the table of sources up to which it is broadcast (some 10 MB); beyond, the join is shuffled and AQE splits it.
MANY_SOURCES = 100_000


@dataclass(frozen=True)
class Target:
    """entropy: as a share of the entropy of equal weights, or None. repeats: the most passes over a source, or None.
    budget: tokens of the mixture; None: as many as there are. seed: of the permutations."""

    entropy: float | None = 0.9
    repeats: float | None = 4.0
    budget: int | None = None
    seed: int = 1
    block_rows: int = 4096


def count_tokens(text: Column) -> Column:
    """Words between white space; 0 for null."""
    words = F.size(F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != ""))
    return words.cast("long")


def digest_number(*parts: Column) -> Column:
    """The first 60 bits of an MD5 as a long: the same in any SQL engine."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *(F.coalesce(p.cast("string"), F.lit("")) for p in parts)).cast("binary")), 1, 15), 16, 10).cast("long")


def least_exponents(shares: DataFrame, tests: list[Callable[[Row], bool]]) -> list[float]:
    """For each test the least exponent of 0 to 1 at which it holds, as the upper end of the last interval; it is false below
    and true above. A test gets the exponent m, and over all shares p of shares(p) their number n, the sums z of p^m and e
    of p^m ln p, and the largest p^(m-1), r."""
    ends = [(0.0, 1.0)] * len(tests)
    for _ in range(PASSES):
        tried = [[low + (high - low) * (k + 1) / (CUTS + 1) for k in range(CUTS)] for low, high in ends]
        each = shares.select("p", F.explode(F.lit(sorted({m for t in tried for m in t}))).alias("m"))
        found = each.groupBy("m").agg(F.count(F.lit(1)).alias("n"), F.sum(F.pow("p", "m")).alias("z"), F.sum(F.pow("p", "m") * F.ln("p")).alias("e"), F.max(F.pow("p", F.col("m") - 1)).alias("r"))
        rows = {row["m"]: row for row in found.collect()}  # one for each exponent
        for i, (test, (low, high)) in enumerate(zip(tests, ends)):
            good = next((m for m in tried[i] if test(rows[m])), high)
            ends[i] = max([m for m in tried[i] if m < good], default=low), good
    return [high for _, high in ends]


def source_weights(counts: DataFrame, target: Target) -> DataFrame:
    """(source, n_docs, n_tokens, exponent, weight, budget) of every source of counts(source, tokens).

    The exponent is rounded to 6 places and weights to 9, so that budgets don't hang on the last bits of a power.
    """
    sources = materialize(counts.groupBy("source").agg(F.count(F.lit(1)).alias("n_docs"), F.sum("tokens").alias("n_tokens")), "sources")
    used = sources.where("n_tokens > 0")
    row = used.agg(F.coalesce(F.sum("n_tokens"), F.lit(0)).alias("tokens"), F.count(F.lit(1)).alias("n")).first()
    budget = target.budget if target.budget is not None else row["tokens"]
    exponent, z = 1.0, 1.0
    if row["n"]:
        shares = used.select((F.col("n_tokens") / F.lit(row["tokens"])).alias("p"))
        tests: list[Callable[[Row], bool]] = []
        if target.entropy is not None:
            tests.append(lambda t: math.log(t["z"]) - t["m"] * t["e"] / t["z"] <= target.entropy * math.log(t["n"]))
        if target.repeats is not None:
            tests.append(lambda t: t["r"] / t["z"] * budget / row["tokens"] <= target.repeats)
        exponent = round(max(least_exponents(shares, tests)), 6) if tests else 1.0
        z = shares.agg(F.sum(F.pow("p", F.lit(exponent))).alias("z")).first()["z"]
    share = F.when(F.col("n_tokens") == 0, 0.0).otherwise(F.round(F.pow(F.col("n_tokens") / F.lit(max(row["tokens"], 1)), F.lit(exponent)) / F.lit(z), 9))
    weighed = sources.withColumns({"exponent": F.lit(exponent), "weight": share})
    return weighed.select("source", "n_docs", "n_tokens", "exponent", "weight", F.floor(F.col("weight") * F.lit(budget)).cast("long").alias("budget"))


def row_digest(doc_id: Column, text: Column) -> Column:
    """What deals and orders a row: of its id and its text, so that rows that share an id, or have none, are dealt too."""
    return F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), F.coalesce(text, F.lit(""))).cast("binary"))


def deal(rows: DataFrame, target: Target) -> DataFrame:
    """rows(digest, source, tokens, ...) with their block, the block's tokens and budget, and the number of its whole
    passes and the tokens of the last one. A null source is the source of the empty name."""
    rows = rows.withColumn("source", F.coalesce("source", F.lit("")))
    weights = source_weights(rows.select("source", "tokens"), target)
    n_blocks = F.ceil(F.col("n_docs") / F.lit(target.block_rows)).cast("long")
    block = F.pmod(digest_number(F.lit(target.seed), F.lit("block"), F.col("digest")), n_blocks).cast("int")
    # a hot source would land in one task of a shuffled join; few sources are sent to all tasks instead
    if weights.count() <= MANY_SOURCES:
        weights = F.broadcast(weights)
    placed = rows.join(weights, "source").withColumn("block", block)
    sums = placed.groupBy("source", "block").agg(F.sum("tokens").alias("block_tokens"))
    placed = placed.join(sums, ["source", "block"])
    share = F.when(F.col("n_tokens") > 0, F.floor(F.col("budget").cast("decimal(38,0)") * F.col("block_tokens") / F.col("n_tokens"))).otherwise(0).cast("long")
    placed = placed.withColumn("block_budget", share)
    whole = F.when(F.col("block_tokens") > 0, F.expr("block_budget div block_tokens")).otherwise(F.lit(0)).cast("long")
    return placed.withColumn("whole", whole).withColumn("rest", F.col("block_budget") - F.col("whole") * F.col("block_tokens"))


def _order(target: Target, epoch: Column) -> list[Column]:
    return [digest_number(F.lit(target.seed), epoch, F.col("digest")), F.col("digest")]


def _before(target: Target, epoch: Column, *keys: str) -> Column:
    ahead = Window.partitionBy("source", "block", *keys).orderBy(*_order(target, epoch)).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum("tokens").over(ahead), F.lit(0))


def permutations(rows: DataFrame, target: Target = Target()) -> DataFrame:
    """(doc_id, source, tokens, epoch, block, place, mix_key, weight, exponent): every reading of a document in the mixture.

    ``epoch`` is the pass, ``place`` the place in the block's permutation of that pass. ``mix_key`` rises from 0 to 1 over
    a block's readings, so that ordering by it interleaves all blocks of all sources evenly. Documents of no token cost
    nothing and stay in every pass that reaches them.
    """
    dealt = deal(rows, target).withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), "whole")))
    ahead = _before(target, F.col("epoch"), "epoch")
    place = F.row_number().over(Window.partitionBy("source", "block", "epoch").orderBy(*_order(target, F.col("epoch"))))
    read = dealt.withColumn("before", ahead).withColumn("place", place)
    read = read.where((F.col("epoch") < F.col("whole")) | (2 * F.col("before") + F.col("tokens") <= 2 * F.col("rest")))
    key = F.when(F.col("block_budget") > 0, F.round((F.col("epoch") * F.col("block_tokens") + F.col("before")) / F.col("block_budget"), 9)).otherwise(0.0)
    return read.select("doc_id", "source", "tokens", "epoch", "block", "place", key.alias("mix_key"), "weight", "exponent")


def mixed_rows(docs: DataFrame, target: Target = Target()) -> DataFrame:
    """The mixture's readings as rows of docs(doc_id, source, text, ...), with all its columns as they are: each row as often
    as ``permutations`` reads it. A null text has no tokens; a null source is the source of the empty name, and stays null
    in the rows; an empty table gives an empty result."""
    rows = docs.select(row_digest(F.col("doc_id"), F.col("text")).alias("digest"), "source", count_tokens(F.col("text")).alias("tokens"), F.struct(*docs.columns).alias("kept"))
    dealt = deal(rows, target)
    last = (2 * F.col("before") + F.col("tokens") <= 2 * F.col("rest")).cast("long")
    times = dealt.withColumn("before", _before(target, F.col("whole"))).withColumn("times", F.col("whole") + last)
    return times.where("times > 0").select("kept", F.explode(F.sequence(F.lit(1).cast("long"), "times"))).select("kept.*")


def mixture(docs: DataFrame, target: Target = Target()) -> DataFrame:
    """The readings of docs(doc_id, source, text), see ``permutations``; tokens are counted once and kept without the texts.
    A null text has no tokens, a null source is the source of the empty name. Rows are dealt and ordered by their id and
    text: wholly equal rows are alike, rows that share an id or have none are not. An empty table gives an empty result."""
    rows = docs.select("doc_id", "source", count_tokens(F.col("text")).alias("tokens"), row_digest(F.col("doc_id"), F.col("text")).alias("digest"))
    return permutations(materialize(rows, "token-counts"), target)

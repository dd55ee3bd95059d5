"""Temperature mixing of sources, with built-in column expressions only.

A source's weight is its token share to a power, normalised. The exponent is
bisected to meet a target entropy, and raised again if a source would be
repeated more often than a limit allows; each pass over the source totals
settles four bits of it. A source's quota is its weight times the budget. The
budget is a share of all tokens, or the least one at which every source's quota
is at least its own tokens: then no document goes, and smaller sources repeat.

Quotas are realised by block permutations. A document's hash gives its block,
its sub-block and its place there. All documents of a source are taken as often
as the quota holds its tokens; of the last, partial round, blocks are taken in
an order hashed from source and round, up to the block that the quota cuts,
then sub-blocks, then documents. Block totals are sums that combine before the
shuffle, and only documents of a cut sub-block, a millionth of a source, are
ordered one by one, so a source with a third of all rows is never in one task.
What decides is a row per source, joined to the documents.

Defined cases: tokens are runs without white space; null text has none. Null is
a source of its own. A source without tokens has weight and copies 0, or copies
1 under the least budget. Rows that repeat id and source are taken or left together. One source alone has weight 1.
An empty table gives an empty result. ``target`` outside what exponents from 0
to ``MOST`` can reach gives the nearest of both. Other columns do not matter.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crownlake.llm.common import stored

BLOCKS = 1024
HASH_HEX = 15
MOST = 1.0
BITS_A_PASS, PASSES = 4, 8
WORD = r"[^\x20\x09-\x0D]+"


def tokens(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def hash_of(*parts: Column) -> Column:
    """Sixty bits of the MD5 of the parts' text."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, HASH_HEX), 16, 10).cast("long")


def measure(docs: DataFrame) -> DataFrame:
    """``doc_id, source, tokens, place, block, sub`` of every row, stored."""
    place = hash_of(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", tokens(F.col("text")).alias("tokens"), place.alias("place"))
    return stored(rows.withColumns({"block": F.col("place") % BLOCKS, "sub": F.floor(F.col("place") / BLOCKS) % BLOCKS}), "mix-rows")


def source_totals(rows: DataFrame) -> DataFrame:
    return stored(rows.groupBy("source").agg(F.sum("tokens").alias("total"), F.count(F.lit(1)).alias("documents")), "mix-sources")


def figures(shares: DataFrame, exponents: list[float]) -> list[tuple[float, float, float]]:
    """(entropy, most repeats per budget token, least whole budget) of the weights at each exponent, in one pass over (share, total)."""
    log = F.log("share")
    columns = []
    for i, a in enumerate(exponents):
        power = F.exp(log * a)
        columns += [F.sum(power).alias(f"z{i}"), F.sum(power * log).alias(f"s{i}"), F.max(power / F.col("total")).alias(f"m{i}")]
        columns.append(F.max(F.col("total") / power).alias(f"l{i}"))
    row = shares.agg(*columns).first()
    return [
        (math.log(row[f"z{i}"]) - a * row[f"s{i}"] / row[f"z{i}"], row[f"m{i}"] / row[f"z{i}"], row[f"l{i}"] * row[f"z{i}"])
        for i, a in enumerate(exponents)
    ]


def bisect(shares: DataFrame, low: float, high: float, above) -> float:
    """Least exponent, to 32 bits of the interval, at which ``above(entropy, repeats, least)`` no longer holds; it holds first, if at all."""
    for _ in range(PASSES):
        step = (high - low) / (1 << BITS_A_PASS)
        inner = [low + step * i for i in range(1, 1 << BITS_A_PASS)]
        held = sum(1 for f in figures(shares, inner) if above(*f))
        low, high = low + step * held, low + step * (held + 1)
    return high


def exponent(totals: DataFrame, budget: int | None, target: float | None, limit: float | None) -> float:
    """The exponent whose weights have ``target`` times the highest entropy, raised until no source repeats over ``limit`` times."""
    summed = totals.where("total > 0").agg(F.sum("total").alias("t"), F.count(F.lit(1)).alias("n")).first()
    if not summed["n"]:
        return 1.0
    shares = totals.where("total > 0").withColumn("share", F.col("total") / F.lit(float(summed["t"])))
    power = 0.0
    if target is not None:
        power = bisect(shares, 0.0, MOST, lambda entropy, *_: entropy > target * math.log(summed["n"]))

    def over(entropy: float, repeats: float, least: float) -> bool:
        return repeats * (least if budget is None else budget) > limit

    if limit is not None and power < 1.0 and over(*figures(shares, [power])[0]):
        power = bisect(shares, power, 1.0, over)
    return power


def plan(totals: DataFrame, budget: int | None, power: float) -> DataFrame:
    """``totals`` with ``weight``, ``quota`` in tokens, ``rounds`` (whole ones) and ``rest`` of the quota; no budget: the least whole one."""
    raised = F.when(F.col("total") > 0, F.exp(F.log("total") * power)).otherwise(0.0)
    sums = totals.agg(F.sum(raised).alias("z"), F.max(F.col("total") / F.nullif(raised, F.lit(0.0))).alias("l")).first()
    norm = sums["z"] or 1.0
    most = (sums["l"] or 0.0) * norm if budget is None else budget
    quota = F.round(F.col("weight") * F.lit(most)).cast("long")
    quota = F.greatest(quota, F.col("total")) if budget is None else quota
    quotas = totals.withColumn("weight", raised / F.lit(float(norm))).withColumn("quota", quota)
    whole = F.when(F.col("total") > 0, F.floor(F.col("quota") / F.col("total"))).otherwise(int(budget is None)).cast("long")
    return quotas.withColumn("rounds", whole).withColumn("rest", F.col("quota") - F.col("rounds") * F.col("total"))


def turn(block: Column, rounds: Column, source: Column) -> Column:
    """Place of a block in the order of the last round of its source."""
    return hash_of(rounds.cast("string"), block.cast("string"), F.coalesce(source, F.lit("\x00")))


def _cut(sums: DataFrame, by: list[str], rest: str) -> DataFrame:
    """Of each source: the first key in order at which the running sum exceeds ``rest``, and what is left before it."""
    running = Window.partitionBy("source").orderBy(*by)
    ran = sums.withColumn("__end", F.sum("size").over(running)).where(F.col("__end") > F.col(rest))
    first = ran.groupBy("source").agg(F.min(F.struct(*by, (F.col(rest) - F.col("__end") + F.col("size")).alias("left"))).alias("cut"))
    return first.select("source", *[F.col("cut")[c].alias(f"cut_{c}") for c in by], F.col("cut")["left"].alias("left"))


def cuts(rows: DataFrame, planned: DataFrame) -> DataFrame:
    """A row per source: its plan, and where its last round ends (block turn, sub-block, then place and id)."""

    def at(left: DataFrame, right: DataFrame) -> DataFrame:
        return left.join(right.withColumnRenamed("source", "__source"), F.col("source").eqNullSafe(F.col("__source"))).drop("__source")

    blocks = rows.groupBy("source", "block").agg(F.sum("tokens").alias("size"))
    blocks = at(blocks, planned.select("source", "rounds", "rest")).withColumn("turn", turn(F.col("block"), F.col("rounds"), F.col("source")))
    first = _cut(blocks, ["turn", "block"], "rest")
    inside = at(rows, first.select("source", "cut_block", F.col("left").alias("rest1"))).where("block = cut_block")
    subs = inside.groupBy("source", "sub", "rest1").agg(F.sum("tokens").alias("size"))
    second = _cut(subs, ["sub"], "rest1")
    inmost = at(inside, second.select("source", "cut_sub", F.col("left").alias("rest2"))).where("sub = cut_sub")
    each = inmost.groupBy("source", "place", "doc_id", "rest2").agg(F.sum("tokens").alias("size"))
    third = _cut(each, ["place", "doc_id"], "rest2")
    out = planned
    for found, names in ((first, ["cut_turn", "cut_block"]), (second, ["cut_sub"]), (third, ["cut_place", "cut_doc_id"])):
        side = found.select(F.col("source").alias("__source"), *names)
        out = out.join(side, F.col("source").eqNullSafe(F.col("__source")), "left").drop("__source")
    return out


def copies(place: Column, block: Column, sub: Column, doc_id: Column, source: Column) -> Column:
    """How often a document is taken, given the columns of its source's row of ``cuts``."""
    t = turn(block, F.col("rounds"), source)
    before = F.struct(t, block, sub, place, F.coalesce(doc_id, F.lit(-(1 << 63)))) < F.struct(
        F.col("cut_turn"), F.col("cut_block"), F.col("cut_sub"), F.col("cut_place"), F.coalesce(F.col("cut_doc_id"), F.lit(-(1 << 63)))
    )
    return F.col("rounds") + F.when(F.col("total") > 0, F.coalesce(before, F.lit(False)).cast("long")).otherwise(0)


def _planned(docs: DataFrame, target: float | None, limit: float | None, budget_share: float | None) -> tuple[DataFrame, DataFrame]:
    rows = measure(docs)
    totals = source_totals(rows)
    budget = None if budget_share is None else int(budget_share * (totals.agg(F.sum("total").alias("t")).first()["t"] or 0))
    return rows, stored(cuts(rows, plan(totals, budget, exponent(totals, budget, target, limit))), "mix-cuts")


def mixture(docs: DataFrame, target: float | None = None, limit: float | None = None, budget_share: float | None = 1.0) -> DataFrame:
    """``doc_id, source, tokens, weight, quota, block, copies`` of every row.

    ``target``: share of the highest entropy; ``limit``: most repeats of a source; ``budget_share``: budget by all tokens;
    None: the least budget that takes every document, with ``limit`` from 1 on.
    """
    rows, decided = _planned(docs, target, limit, budget_share)
    joined = rows.join(decided.withColumnRenamed("source", "__source"), F.col("source").eqNullSafe(F.col("__source")))
    taken = copies(F.col("place"), F.col("block"), F.col("sub"), F.col("doc_id"), F.col("source"))
    return joined.select("doc_id", "source", "tokens", "weight", "quota", "block", taken.alias("copies"))


def mixed(docs: DataFrame, target: float | None = None, limit: float | None = None, budget_share: float | None = 1.0) -> DataFrame:
    """The rows of ``docs``, all columns, each as often as it is taken. Texts are not shuffled."""
    _, decided = _planned(docs, target, limit, budget_share)
    place = hash_of(F.coalesce(F.col("__id").cast("string"), F.lit("")))
    rows = docs.select(F.struct(*docs.columns).alias("__row")).select(
        "__row", F.col("__row.doc_id").cast("long").alias("__id"), F.col("__row.source").alias("__of")
    )
    keyed = rows.withColumn("__place", place).join(decided, F.col("__of").eqNullSafe(F.col("source")))
    taken = copies(F.col("__place"), F.col("__place") % BLOCKS, F.floor(F.col("__place") / BLOCKS) % BLOCKS, F.col("__id"), F.col("__of"))
    chosen = keyed.select("__row", taken.cast("int").alias("__copies")).where("__copies > 0")
    return chosen.select("__row", F.explode(F.sequence(F.lit(1), F.col("__copies"))).alias("__copy")).select(
        *[F.col("__row")[c].alias(c) for c in docs.columns]
    )

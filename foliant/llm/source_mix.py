"""Mixing sources to target weights by temperature.

Token shares of the sources are raised to an exponent between 0 (uniform) and 1 (as they are). The exponent is found
by bisection, to meet a target entropy or a limit on repetition. The weights are then realised within a token budget:
each source is laid out epoch after epoch as a permutation of blocks, permuted inside, and cut where its budget ends. What
comes out is that layout: every copy of a document with its epoch, its block, the block's turn and its first token.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import WS_CLASS, small, stored, table, text_of

#: No source is repeated more often than this, on average over its documents.
REPEATS = 2.0
#: Tokens of a block, about; a source has at most so many blocks, larger ones beyond that, since its blocks are put in a row together.
BLOCK_TOKENS, MOST_BLOCKS = 1_000_000, 100_000
#: The exponent is found to within 1 / PER_ROUND ** ROUNDS.
PER_ROUND, ROUNDS = 64, 4
SEED = 17
#: Rows (sources or blocks; documents) that may be broadcast; beyond it joins shuffle.
BROADCAST_ROWS = 100_000
BROADCAST_DOCS = 300_000


def tokens_of(text: Column) -> Column:
    """White-space separated words and one end."""
    return (F.size(F.array_remove(F.split(text, f"[{WS_CLASS}]+"), "")) + 1).cast("long")


def _entropy(shares: DataFrame, at: list[float]) -> DataFrame:
    """For each exponent `a` of `at`: the entropy of the tempered shares and the largest number of repetitions.

    The budget is the one at which the least repeated source is used once, so nothing is lost to mixing.
    """
    x = shares.select("share", F.explode(F.array(*[F.lit(a) for a in at])).alias("a"))  # a row per source and candidate
    power = F.exp(F.col("a") * F.log("share"))
    x = x.select("a", "share", power.alias("w"))
    x = x.groupBy("a").agg(F.sum("w").alias("z"), F.sum(F.col("w") * F.log("w")).alias("wl"), F.max(F.col("w") / F.col("share")).alias("hi"), F.min(F.col("w") / F.col("share")).alias("lo"))
    return x.select("a", (F.log("z") - F.col("wl") / F.col("z")).alias("entropy"), (F.col("hi") / F.col("lo")).alias("repeats"))


def exponent(shares: DataFrame, repeats: float | None = REPEATS, entropy: float | None = None) -> float:
    """The smallest exponent, the flattest mix, that keeps repetition within `repeats`; or the largest that reaches `entropy` (nats).

    Both grow monotonically as the exponent falls, so an interval that holds the answer is cut, PER_ROUND ways at
    once, in aggregations over the table of shares. Shares are never collected.
    """
    lo, hi = 0.0, 1.0
    for _ in range(ROUNDS):
        step = (hi - lo) / PER_ROUND
        rows = sorted(_entropy(shares, [lo + i * step for i in range(PER_ROUND + 1)]).collect(), key=lambda r: r["a"])
        if not rows:
            return 1.0
        if entropy is not None:  # falls with the exponent
            fits = [r["a"] for r in rows if r["entropy"] >= entropy - 1e-12]
            lo = fits[-1] if fits else 0.0
            hi = min(hi, lo + step)
            if not fits:
                return 0.0
        else:
            fits = [r["a"] for r in rows if r["repeats"] <= repeats + 1e-12]
            hi = fits[0] if fits else 1.0
            lo = max(lo, hi - step)
            if not fits:
                return 1.0
    return lo if entropy is not None else hi


def weights(sizes: DataFrame, repeats: float | None = REPEATS, entropy: float | None = None, budget: int | None = None) -> DataFrame:
    """sizes: source, docs, tokens. Adds share, exponent, weight (tempered, sums to 1) and tokens_due (whole tokens of the budget).

    Without a budget the mix is as large as it takes to use the least repeated source once.
    """
    total = sizes.agg(F.sum("tokens").alias("total")).first()["total"] or 1
    shares = stored(sizes.select("source", "docs", "tokens", (F.col("tokens") / F.lit(total)).alias("share")), "shares")
    a = exponent(shares, repeats, entropy)
    x = shares.withColumn("w", F.exp(F.lit(a) * F.log("share")))
    norm = x.agg(F.sum("w").alias("z"), F.min(F.col("w") / F.col("tokens")).alias("least")).first()
    z, least = F.lit(norm["z"] or 1.0), F.lit(norm["least"] or 1.0)
    due = F.col("w") / least if budget is None else F.lit(float(budget)) * F.col("w") / z
    return x.select("source", "docs", "tokens", "share", F.lit(a).alias("exponent"), (F.col("w") / z).alias("weight"), F.round(due).cast("long").alias("tokens_due"))


def copies(docs: DataFrame, repeats: float | None = REPEATS, entropy: float | None = None, budget: int | None = None, block_tokens: int = BLOCK_TOKENS, seed: int = SEED) -> DataFrame:
    """The layout: doc_id, text_key, source, rows, tokens, epoch, block, turn, start, share, exponent, weight, tokens_due.

    rows is how many rows repeat doc_id, text and source; they lie next to each other and count as one here, of `tokens`
    tokens together. A source's rows are dealt to blocks by hash. Every epoch has a permutation of the blocks (turn, from
    0) and one of the rows inside each; start is how many tokens of the source's mix lie before the row. The last epoch
    ends with the row that reaches the budget. Running totals are taken over blocks first and then inside each block,
    so no source is ever sorted in one task.
    """
    key = F.xxhash64(text_of())
    rows = docs.select("doc_id", key.alias("text_key"), "source", tokens_of(text_of()).alias("tokens"))
    rows = stored(rows.groupBy("doc_id", "text_key", "source").agg(F.count("*").alias("rows"), F.sum("tokens").alias("tokens")), "tokens")
    sizes = rows.groupBy("source").agg(F.sum("rows").alias("docs"), F.sum("tokens").alias("tokens"))
    w = stored(weights(sizes, repeats, entropy, budget), "weights")
    n = F.least(F.greatest(F.lit(1), F.ceil(F.col("tokens") / block_tokens)), F.lit(MOST_BLOCKS)).cast("long")
    w = w.select("source", n.alias("blocks"), F.col("tokens").alias("all"), F.expr("tokens_due div tokens").alias("epochs"), F.expr("tokens_due % tokens").alias("rest"), "share", "exponent", "weight", "tokens_due")
    w = small(w, BROADCAST_ROWS).alias("w")
    x = rows.alias("r").join(w, F.col("r.source").eqNullSafe(F.col("w.source")))
    x = x.select("r.*", F.pmod(F.xxhash64("doc_id", "text_key", F.lit(seed)), "blocks").alias("block"))
    block = stored(x.groupBy("source", "block").agg(F.sum("tokens").alias("size")), "blocks")
    turns = block.alias("b").join(w, F.col("b.source").eqNullSafe(F.col("w.source")))
    turns = turns.select("b.*", "all", "epochs", "rest", "share", "exponent", "weight", "tokens_due", F.explode(F.expr("sequence(0L, epochs)")).alias("epoch"))
    order = Window.partitionBy("source", "epoch").orderBy(F.xxhash64("source", "block", "epoch", F.lit(seed)), "block")
    before = F.coalesce(F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    turns = turns.withColumns({"before": before, "turn": F.row_number().over(order) - 1}).where("epoch < epochs or before < rest")
    turns = turns.withColumnsRenamed({"source": "b_source", "block": "b_block"})
    x = x.join(small(stored(turns, "turns"), BROADCAST_ROWS), F.col("source").eqNullSafe(F.col("b_source")) & (F.col("block") == F.col("b_block")))
    inside = Window.partitionBy("source", "epoch", "block").orderBy(F.xxhash64("doc_id", "text_key", "epoch", F.lit(seed + 1)), "doc_id", "text_key")
    run = F.coalesce(F.sum("tokens").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    x = x.withColumn("at", F.col("before") + run).where("epoch < epochs or at < rest")
    return x.select("doc_id", "text_key", "source", "rows", "tokens", "epoch", "block", "turn", (F.col("epoch") * F.col("all") + F.col("at")).alias("start"), "share", "exponent", "weight", "tokens_due")


def mix_report(docs: DataFrame, **how) -> DataFrame:
    """One row per document and epoch in which the mix has it: doc_id, source, rows, tokens, epoch, block, turn, start, share, exponent, weight.

    The columns are those of `copies`. Documents without a source form a source of their own; null texts count as empty
    (one token, the end). Rows that repeat doc_id, text and source are one row here, `rows` tells how many. A document
    that the budget of its source leaves out has no row; with the default budget every document has one at least. An
    empty table gives an empty result. Columns other than doc_id, text and source are ignored. **how goes to `copies`.
    """
    return copies(docs, **how).select("doc_id", "source", "rows", "tokens", "epoch", "block", "turn", "start", "share", "exponent", "weight")


def mix(docs: DataFrame, **how) -> DataFrame:
    """The rows of docs, each as often as the mix has it, with all their columns, laid out in the order of the mix.

    Sources advance in proportion: a copy's place is the share of its source's budget that lies before it. Rows are
    dealt to partitions by ranges of that place and sorted inside, so partitions in their order are the mix. A row that
    the budget of its source leaves out goes; with the default budget every row is there at least once. Nulls, empty
    texts, repeated rows and empty tables are treated as in `mix_report`.
    """
    n = copies(docs, **how).groupBy("doc_id", "text_key", "source").agg(F.collect_list(F.col("start") / F.col("tokens_due")).alias("places"))
    n = stored(n.withColumnsRenamed({"doc_id": "n_id", "text_key": "n_key", "source": "n_source"}), "copies")
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    x = row.withColumn("key", F.xxhash64(F.coalesce("row.text", F.lit(""))))
    same = F.col("row.doc_id").eqNullSafe(F.col("n_id")) & (F.col("key") == F.col("n_key")) & F.col("row.source").eqNullSafe(F.col("n_source"))
    x = x.join(small(n, BROADCAST_DOCS), same).select("row", "key", F.explode("places").alias("place"))
    return x.repartitionByRange("place", "key").sortWithinPartitions("place", "key").select("row.*")


def op4_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_report(table(spark, sf_dir, "documents"))

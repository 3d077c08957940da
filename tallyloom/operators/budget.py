"""Planning of model calls: token estimates, batches, the cost gate and samples."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fixed_values as fv
from ..functions.numeric import n_rows
from ..functions.ordered import hex_block, running_total

# Functions that run in Python workers travel with their code; executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Costs are whole units of 1e-8 USD, so sums are exact in any order.
UNITS_PER_USD = 100_000_000


def estimate_tokens(raw: Column) -> Column:
    return F.greatest(F.floor(F.length(raw) / 4) + 1, F.lit(1)).cast("bigint")


def _cost_units(tier: str, input_tokens: Column, output_tokens: Column) -> Column:
    price = {k: round(v * UNITS_PER_USD / 1_000_000) for k, v in fv.PRICE_PER_MILLION[tier].items()}
    return input_tokens * price["input"] + output_tokens * price["output"]


def _next_batch(upto: np.ndarray, budget: int) -> np.ndarray:
    """For each item that opens a batch, the item that closes it; ``upto`` sums the tokens up to each item."""
    before = np.concatenate([[0], upto[:-1]])
    return np.maximum(np.searchsorted(upto, before + budget, side="right"), np.arange(1, len(upto) + 1))


def _outcome(block: str, tokens: np.ndarray, budget: int) -> tuple:
    """What one block of items does to the batch that is open when the block begins.

    The open batch holds some number of tokens. That number only decides at which item the batch
    closes; from there on all is fixed. So the state at the end of the block (open tokens, closed
    batches) for each possible closing item describes the block for every number. Their batches are
    followed together, one batch of each at a time.
    """
    upto = np.cumsum(tokens)
    before = upto - tokens
    after = _next_batch(upto, budget)
    starts = np.flatnonzero(before < budget)
    at, closed = np.append(starts, 0), np.append(np.ones(len(starts), np.int64), 0)
    while (open_ := after[at] < len(upto)).any():
        at = np.where(open_, after[at], at)
        closed = closed + open_
    left = upto[-1] - before[at]
    return (
        block, (budget - upto[starts]).tolist(), left[:-1].tolist(), closed[:-1].tolist(), int(upto[-1]),
        int(left[-1]), int(closed[-1]),
    )


def _whole_blocks(frames: Iterator[pd.DataFrame]) -> Iterator[tuple[pd.DataFrame, np.ndarray]]:
    """Frames that end where a block ends, and the borders of the blocks in them.

    Blocks are small ranges of the key order and most have few rows, so a frame holds many of them.
    """
    held: list[pd.DataFrame] = []  # the block that is not known to be whole
    for pdf in frames:
        if not len(pdf):
            continue
        block = pdf["block"].to_numpy()
        cuts = np.flatnonzero(block[1:] != block[:-1]) + 1
        if held and held[0]["block"].iloc[0] != block[0]:
            cuts = np.concatenate([[0], cuts])
        if not len(cuts):
            held.append(pdf)
            continue
        before = sum(map(len, held))
        whole = pd.concat([*held, pdf.iloc[: cuts[-1]]]) if held else pdf.iloc[: cuts[-1]]
        yield whole, np.concatenate([[0], cuts + before])
        held = [pdf.iloc[cuts[-1] :]]
    if held:
        rows = pd.concat(held)
        yield rows, np.array([0, len(rows)])


OUTCOME = "block string, limits array<bigint>, open array<bigint>, closed array<bigint>, total bigint, fresh_open bigint, fresh_closed bigint"
ENTRY = "block string, carry bigint, first_batch bigint"


def _block_outcomes(budget: int):
    names = [c.split()[0] for c in OUTCOME.split(", ")]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows, borders in _whole_blocks(frames):
            block, tokens = rows["block"].to_numpy(), rows["tokens"].to_numpy()
            found = [_outcome(block[i], tokens[i:j], budget) for i, j in zip(borders, borders[1:], strict=False)]
            yield pd.DataFrame(found, columns=names)

    return run


def _block_entries(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Chain the blocks: tokens in the open batch and its number where each block begins."""
    carry, batch = 0, 0
    for pdf in frames:
        entries = []
        for o in pdf.itertuples(index=False):
            entries.append((o.block, carry, batch))
            if carry == 0:
                carry, batch = o.fresh_open, batch + o.fresh_closed
                continue
            closing = next((i for i, limit in enumerate(o.limits) if carry > limit), None)
            if closing is None:
                carry += o.total
            else:
                carry, batch = o.open[closing], batch + o.closed[closing]
        yield pd.DataFrame(entries, columns=["block", "carry", "first_batch"])


def _assign(budget: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows, borders in _whole_blocks(frames):
            tokens, carries, firsts = (rows[c].to_numpy() for c in ("tokens", "carry", "first_batch"))
            opens, batch = np.zeros(len(tokens), np.int64), np.empty(len(tokens), np.int64)
            for i, j in zip(borders, borders[1:], strict=False):
                carry = int(carries[i])
                if j - i == 1:
                    # An empty batch takes the item, an open one if it fits.
                    batch[i] = firsts[i] + (carry > 0 and carry + int(tokens[i]) > budget)
                    continue
                upto = np.cumsum(tokens[i:j])
                after = _next_batch(upto, budget)
                # The batch that is open at the start closes where it would overflow; an empty one takes the first item.
                at = int(np.searchsorted(upto, budget - carry, side="right")) if carry else int(after[0])
                while at < j - i:
                    opens[i + at] = 1
                    at = int(after[at])
                batch[i:j] = firsts[i] + np.cumsum(opens[i:j])
            yield rows[["dedup_key", "tokens"]].assign(batch_id=batch)

    return run


def pack_batches(items: DataFrame, budget: int = fv.BATCH_TOKEN_BUDGET, digits: int = 4) -> DataFrame:
    """Fill batches greedily in key order up to a token budget: ``dedup_key, tokens, batch_id``.

    A batch closes when the next item would overflow it. The result is that of one pass over all
    items, computed in parallel: each range of the key order is summed up for any batch that may be
    open at its start, the at most 16**digits summaries are chained in one task, and every range is
    then numbered from its known start.
    """
    placed = items.select("dedup_key", "tokens", hex_block(F.col("dedup_key"), digits).alias("block"))
    ranges = placed.repartition("block").sortWithinPartitions("block", "dedup_key")
    outcomes = ranges.mapInPandas(_block_outcomes(budget), OUTCOME)
    entries = (
        outcomes.repartition(1).sortWithinPartitions("block").mapInPandas(_block_entries, ENTRY)
    )
    return (
        placed.join(F.broadcast(entries), "block")
        .repartition("block")
        .sortWithinPartitions("block", "dedup_key")
        .mapInPandas(_assign(budget), "dedup_key string, tokens bigint, batch_id bigint")
    )


def small_items(routed: DataFrame) -> DataFrame:
    tokens = estimate_tokens(F.col("raw_text")) + fv.SMALL_ITEM_OVERHEAD_TOKENS
    return routed.where(F.col("route") == fv.ROUTE_SMALL).select("dedup_key", tokens.alias("tokens"))


def batch_calls(batches: DataFrame) -> DataFrame:
    """One call per batch, known by the first key in it."""
    calls = batches.groupBy("batch_id").agg(
        F.min("dedup_key").alias("call_key"),
        n_rows().alias("items"),
        F.sum("tokens").alias("input_tokens"),
    )
    output = F.greatest(
        F.lit(fv.SMALL_MIN_OUTPUT_TOKENS), F.col("items") * fv.SMALL_ITEM_OUTPUT_TOKENS
    ).cast("bigint")
    return calls.select(
        F.lit(1).alias("phase"), "call_key", "batch_id", "items", "input_tokens", output.alias("output_tokens")
    ).withColumn("cost", _cost_units("small", F.col("input_tokens"), F.col("output_tokens")))


def single_calls(texts: DataFrame, phase: int) -> DataFrame:
    """One large-model call per text."""
    return texts.select(
        F.lit(phase).alias("phase"),
        F.col("dedup_key").alias("call_key"),
        F.lit(None).cast("bigint").alias("batch_id"),
        F.lit(1).cast("bigint").alias("items"),
        (estimate_tokens(F.col("raw_text")) + fv.LARGE_OVERHEAD_TOKENS).alias("input_tokens"),
        F.lit(fv.LARGE_OUTPUT_TOKENS).cast("bigint").alias("output_tokens"),
    ).withColumn("cost", _cost_units("large", F.col("input_tokens"), F.col("output_tokens")))


def budget_gate(
    calls: DataFrame, cap_usd: float | None = fv.DEFAULT_COST_CAP_USD, spent: Column | None = None
) -> DataFrame:
    """Calls in order with their running cost; accepted until the cap is first exceeded.

    Costs are positive, so a call after the first overflow is over the cap as well.
    """
    placed = calls.withColumn("block", hex_block(F.col("call_key")))
    total = running_total(placed, ["phase", "block"], ["call_key"], "cost", "running")
    if spent is not None:
        total = total.withColumn("running", F.col("running") + spent)
    accepted = F.lit(True) if cap_usd is None else F.col("running") <= round(cap_usd * UNITS_PER_USD)
    return total.drop("block").withColumn("accepted", accepted)


def call_plan(routed: DataFrame, cap_usd: float | None = fv.DEFAULT_COST_CAP_USD) -> DataFrame:
    """All first calls behind the gate: batches in order, then single texts in order."""
    batches = pack_batches(small_items(routed))
    large = routed.where(F.col("route") == fv.ROUTE_LARGE)
    return budget_gate(batch_calls(batches).unionByName(single_calls(large, 2)), cap_usd)


def in_usd(units: Column) -> Column:
    return units.cast("double") / float(UNITS_PER_USD)


def gate_summary(plan: DataFrame) -> DataFrame:
    """Accepted and rejected calls per phase with tokens and cost."""
    return plan.groupBy("phase", "accepted").agg(
        n_rows().alias("calls"),
        F.sum("items").alias("items"),
        F.sum("input_tokens").alias("input_tokens"),
        F.sum("output_tokens").alias("output_tokens"),
        in_usd(F.sum("cost")).alias("cost_usd"),
    )


def route_sample(routed: DataFrame, size: int) -> DataFrame:
    """A third of the sample from each route, then the next texts in order until it is full."""
    if size < 0:
        raise ValueError("sample size must not be negative")
    if size == 0:
        return routed
    head = max(1, size // 3)
    # A top list per route, whatever its size: each map task keeps its first ``head`` rows only.
    lists = [
        routed.where(F.col("route") == route).orderBy("dedup_key").limit(head)
        for route in (fv.ROUTE_RULE, fv.ROUTE_SMALL, fv.ROUTE_LARGE)
    ]
    heads = lists[0].unionByName(lists[1]).unionByName(lists[2])
    # At most ``size`` of the first ``2 * size`` texts are heads, so the fill is among them.
    first = routed.orderBy("dedup_key").limit(2 * size)
    spare = first.join(heads.select("dedup_key"), "dedup_key", "left_anti")
    chosen = heads.agg(n_rows().alias("n")).scalar()
    # At most 2 * size rows, a number that the caller sets, are ranked in one place.
    order = F.row_number().over(Window.orderBy("dedup_key"))
    fill = spare.withColumn("rank", order).where(F.col("rank") <= F.lit(size) - chosen).drop("rank")
    return heads.unionByName(fill.select(heads.columns))

"""Mixing to target weights by iterative proportional fitting.

Token weights are summed per cell (source, language, topic). Raking keeps one
multiplier per category and fits each marginal in turn to its target share
until nothing changes. A cell's factor is the product of its multipliers.
Factors become sampling probabilities by dividing by the largest, so expected
token shares are exactly the raked ones, and a document is kept when a uniform
hash of its id falls below its probability.

Only cells, and the multipliers (a row per category), are shuffled.

Targets that are given are rated over the categories that documents have. A
category they lack, or give no positive share, has probability 0: its documents
stay in the result, none is ``kept``, and the other targets are fitted on the
rest. Targets that contradict one another are fitted for MAX_CYCLES rounds; a
warning then says by how much the last round still moved.

Null categories are the category ''. Null or empty texts have no tokens and
take their cell's probability; a cell without tokens weighs one. Documents of
null id hash as the empty text. Repeated rows of an id are kept or dropped
together. Empty tables give no rows. Columns of documents are kept, except
those that are called like a result.
"""

from __future__ import annotations

import warnings
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.llm.common import free_name, key_bits, land

MAX_CYCLES = 100
TOLERANCE = 1e-6
UNIFORM_BITS = 52


def token_count(text: Column) -> Column:
    """Words between white space."""
    return F.size(F.filter(F.split(F.coalesce(text, F.lit("")), r"[ \t-\r]+"), lambda w: w != "")).cast("long")


def tempered_targets(cells: DataFrame, dimension: str, alpha: float) -> DataFrame:
    """Shares in proportion to a marginal's tokens to the power ``alpha``; below 1 it lifts small categories."""
    sums = land(cells.groupBy(dimension).agg(F.pow(F.sum("w"), F.lit(alpha)).alias("t")), "targets")
    total = sums.agg(F.sum("t")).first()[0]
    return sums.select(dimension, (F.col("t") / F.lit(total)).alias("share"))


def rake(cells: DataFrame, targets: dict[str, DataFrame]) -> DataFrame:
    """``cells`` (dimensions and weight ``w``) with ``factor``; its weighted marginals have the target shares."""
    dims = list(targets)
    multipliers = {d: t.select(d, "share", F.lit(1.0).alias(f"m_{d}")) for d, t in targets.items()}

    def weighted(skip: str | None = None) -> DataFrame:
        out = cells
        for d in dims:
            if d != skip:
                out = out.join(multipliers[d].drop("share", "moved"), d)
        return out

    def product(skip: str | None = None) -> Column:
        out = F.lit(1.0)
        for d in dims:
            if d != skip:
                out = out * F.col(f"m_{d}")
        return out

    for _ in range(MAX_CYCLES):
        for d in dims:
            sums = weighted(d).groupBy(d).agg(F.sum(F.col("w") * product(d)).alias("sum"))
            new = multipliers[d].drop("moved").join(sums, d).select(
                d, "share", (F.col("share") / F.col("sum")).alias(f"m_{d}"), F.abs(F.col("share") / F.col("sum") / F.col(f"m_{d}") - 1).alias("moved")
            )
            multipliers[d] = land(new, "multipliers")
        # The last one is fitted by construction; the first shows what the others have moved.
        moved = multipliers[dims[0]].agg(F.max("moved")).first()[0] or 0
        if moved < TOLERANCE:
            break
    else:
        warnings.warn(f"targets not reached: after {MAX_CYCLES} rounds a multiplier still moves by {moved:.2g} of itself", stacklevel=2)
    return weighted().withColumn("factor", product())


def positive_targets(targets: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """One row per category with a positive share; null categories are ''."""
    return {
        d: land(t.groupBy(F.coalesce(F.col(d), F.lit("")).alias(d)).agg(F.sum("share").alias("share")).where("share > 0"), "given")
        for d, t in targets.items()
    }


def rated(cells: DataFrame, dimension: str, target: DataFrame) -> DataFrame:
    """A target's shares over the categories that cells have; they add up to one."""
    present = target.join(cells.select(dimension).distinct(), dimension, "left_semi")
    total = present.agg(F.sum("share")).first()[0] or 1.0
    return present.select(dimension, (F.col("share") / F.lit(total)).alias("share"))


def sample_to_targets(
    docs: DataFrame,
    dimensions: Sequence[str],
    tokens: Column,
    alpha: float = 0.9,
    targets: dict[str, DataFrame] | None = None,
    key: str = "doc_id",
    seed: str = "mix",
) -> DataFrame:
    """``docs`` with ``n_tokens``, ``probability`` and ``kept``. Targets not given are tempered by ``alpha``."""
    own = [c for c in docs.columns if c.lower() not in ("n_tokens", "probability", "kept")]
    clean = [F.coalesce(F.col(d), F.lit("")).alias(d) for d in dimensions]
    cells = docs.select(*clean, tokens.alias("n")).groupBy(*dimensions).agg(F.greatest(F.sum("n"), F.lit(1)).cast("double").alias("w"))
    cells = land(cells, "cells")
    given = positive_targets(targets or {})
    for d, target in given.items():
        cells = cells.join(target.select(d), d, "left_semi")
    targets = {d: rated(cells, d, given[d]) if d in given else tempered_targets(cells, d, alpha) for d in dimensions}
    raked = land(rake(cells, targets), "raked")
    most = raked.agg(F.max("factor")).first()[0] or 1.0
    names = {d: f"cell_{i}" for i, d in enumerate(dimensions)}
    chance = free_name(docs, "chance")
    table = raked.select(*(F.col(d).alias(names[d]) for d in dimensions), (F.col("factor") / F.lit(most)).alias(chance))
    match = [F.coalesce(docs[d], F.lit("")) == table[names[d]] for d in dimensions]
    uniform = key_bits(F.concat(F.coalesce(F.col(key).cast("string"), F.lit("")), F.lit(":" + seed)), UNIFORM_BITS) / F.lit(float(2**UNIFORM_BITS))
    chance_of = F.coalesce(F.col(chance), F.lit(0.0))
    return docs.join(table, match, "left").select(
        *(docs[c] for c in own),
        tokens.alias("n_tokens"),
        chance_of.alias("probability"),
        (uniform < chance_of).alias("kept"),
    )

"""Mixing sources to target weights by hierarchical budgets.

The tree is domain, language, source. A token budget is split from the root down: every node's children
share its budget in proportion to their weights, no child gets more than its subtree can supply, and what
a child cannot use goes to its siblings. A subtree therefore fills its own shortages from within, and only what
it lacks as a whole reaches the siblings of its root. Each leaf takes whole epochs of its documents, then a prefix
of one more epoch in an order set by the seed.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyproof.llm.common import settled

WORD = r"[^\\x20\\x09-\\x0D]+"
LEVELS = ("domain", "lang", "source")


def weight_of(level: str, weights: Mapping[str, int], otherwise: int) -> Column:
    """The weight of a node by its name; ``otherwise`` for names that are not listed."""
    out = F.lit(otherwise).cast("long")
    for name, weight in sorted(weights.items()):
        out = F.when(F.col(level) == name, F.lit(weight).cast("long")).otherwise(out)
    return out


def share_out(nodes: DataFrame, parent: list[str], name: str) -> DataFrame:
    """``nodes`` with ``given``: their part of the ``budget`` of their parent, from ``weight`` and ``cap``.

    Children in the order of cap per weight: as long as the next child's cap is within its share of what is left, it
    is filled; the rest share what remains by weight, rounded down to whole tokens. Weight 0 gets nothing.
    """
    over = f"PARTITION BY {', '.join(parent)}" if parent else "PARTITION BY 1"
    order = f"{over} ORDER BY CASE WHEN weight > 0 THEN 0 ELSE 1 END, cap / greatest(weight, 1), {name}"
    ranked = nodes.selectExpr(
        "*",
        f"coalesce(sum(cap) OVER ({order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS _before",
        f"sum(weight) OVER ({order} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS _weights",
    ).selectExpr("*", "weight > 0 AND cap * _weights <= weight * (budget - _before) AS _full")
    rest = ranked.selectExpr(
        "*",
        f"budget - sum(CASE WHEN _full THEN cap ELSE 0 END) OVER ({over}) AS _left",
        f"sum(CASE WHEN _full THEN 0 ELSE weight END) OVER ({over}) AS _open",
    )
    given = "CASE WHEN _full THEN cap WHEN weight = 0 OR _left <= 0 THEN 0 ELSE least(cap, (weight * _left) div _open) END"
    return rest.withColumn("given", F.expr(given).cast("long")).drop("_before", "_weights", "_full", "_left", "_open")


def leaf_budgets(leaves: DataFrame, budget: int, max_epochs: int, weights: Mapping[str, Mapping[str, int]], otherwise: int = 1) -> DataFrame:
    """(domain, lang, source, tokens, given) from the tokens of every leaf."""
    nodes = leaves.withColumn("cap", F.col("tokens") * max_epochs)
    given = None
    for depth, level in enumerate(LEVELS):
        path = list(LEVELS[: depth + 1])
        own = nodes.groupBy(*path).agg(F.sum("cap").alias("cap"), F.sum("tokens").alias("tokens"))
        own = own.withColumn("weight", weight_of(level, weights.get(level, {}), otherwise))
        if given is None:
            own = own.withColumn("budget", F.lit(budget).cast("long"))
        else:
            own = own.join(given.withColumnRenamed("given", "budget"), path[:-1])
        given = share_out(own, path[:-1], level).select(*path, "given", *(["tokens"] if depth == 2 else []))
    return given


def mix(docs: DataFrame, domain: Column, weights: Mapping[str, Mapping[str, int]], budget_share: tuple[int, int] = (3, 5), max_epochs: int = 2, seed: int = 7, otherwise: int = 1, keys: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, ``keys``, domain, lang, source, n_tokens, copies): how often each document is taken, one row per row.

    ``budget_share`` is the budget as a fraction of all tokens; ``max_epochs`` bounds repetition. NULL domains, languages and
    sources are leaves named "". Tokens are words. A document is taken once more than the leaf's whole epochs if the
    tokens before it, in the order of the seed, are less than the leaf's remaining tokens; so a leaf exceeds its
    budget by part of one document at most. Documents without words are never taken; equal rows are equally ordered
    and taken together. A hot leaf is ordered in ranges of its hash, and only the range that holds the end of the
    prefix is sorted by document.
    """
    text = "coalesce(text, '')"
    named = [F.coalesce(c, F.lit("")).alias(n) for n, c in (("domain", domain), ("lang", F.col("lang")), ("source", F.col("source")))]
    rows = settled(docs.select("doc_id", *keys, *named, F.expr(f"cast(regexp_count({text}, '{WORD}') as long)").alias("n_tokens")))
    leaves = rows.where("n_tokens > 0").groupBy(*LEVELS).agg(F.sum("n_tokens").alias("tokens"))
    total = leaves.agg(F.sum("tokens")).first()[0] or 0
    budgets = leaf_budgets(leaves, total * budget_share[0] // budget_share[1], max_epochs, weights, otherwise)
    epochs = budgets.selectExpr(*LEVELS, "given div tokens AS whole", "given % tokens AS more")
    key = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("whole").cast("string"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    ordered = rows.where("n_tokens > 0").join(epochs, list(LEVELS)).withColumn("_key", key).withColumn("_range", F.substring("_key", 1, 4))
    ranges = ordered.groupBy(*LEVELS, "_range").agg(F.sum("n_tokens").alias("_sum"))
    running = f"sum(_sum) OVER (PARTITION BY {', '.join(LEVELS)} ORDER BY _range ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    placed = ordered.join(ranges.selectExpr(*LEVELS, "_range", "_sum", f"{running} - _sum AS _before"), [*LEVELS, "_range"])
    ending = "more > _before AND more < _before + _sum"
    clear = placed.where(f"NOT ({ending})").selectExpr("doc_id", *keys, *LEVELS, "n_tokens", "whole + CASE WHEN more > _before THEN 1 ELSE 0 END AS copies")
    within = f"coalesce(sum(n_tokens) OVER (PARTITION BY {', '.join(LEVELS)} ORDER BY _key RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0)"
    same = f"sum(n_tokens) OVER (PARTITION BY {', '.join(LEVELS)}, _key)"
    last = placed.where(ending).selectExpr("*", f"_before + {within} - {same} AS _ahead")
    last = last.selectExpr("doc_id", *keys, *LEVELS, "n_tokens", "whole + CASE WHEN more > _ahead THEN 1 ELSE 0 END AS copies")
    wordless = rows.where("n_tokens = 0").selectExpr("doc_id", *keys, *LEVELS, "n_tokens", "0L AS copies")
    return clear.unionByName(last).unionByName(wordless).withColumn("copies", F.col("copies").cast("long"))

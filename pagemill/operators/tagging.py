"""Part-of-speech tags in context: a bigram tagger learned from tagged sentences.

Costs are whole numbers (negative logarithms in millionths), so sums are exact and
every engine finds the same best path."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, StringType

from pagemill.functions.arrays import few_at_once
from pagemill.session import BROADCAST_ROWS, fits, frequent_part, numbered, settle

UNIT = 1_000_000
MOST_TAGS = 1_000


@dataclass(frozen=True)
class TagModel:
    """tags in order; cost of starting with and of moving between them; costs of known
    tokens by tag, table (token, costs), and of an unknown one."""

    tags: list[str]
    start: np.ndarray
    step: np.ndarray
    table: DataFrame
    unknown: list[int]


def _cost(share):
    return F.round(-F.log(share) * UNIT).cast("bigint")


def learn_tagger(tagged: DataFrame, tokens: str = "tokens", tags: str = "tags") -> TagModel:
    """From rows with an array of tokens and one of their tags. Every count has one
    added: P(tag | tag before) over all tags, P(token | tag) over all tokens and an
    unknown one. Tag sets above MOST_TAGS are refused."""
    places = tagged.where(F.size(tokens) > 0).select(F.explode(F.transform(
        F.sequence(F.lit(0), F.size(tokens) - 1),
        lambda i: F.struct(F.when(i > 0, F.get(tags, i - 1)).alias("before"), F.get(tags, i).alias("tag"), F.get(tokens, i).alias("token")),
    )).alias("p")).select("p.*")
    pairs = settle(places.groupBy("before", "tag").agg(F.count("*").alias("n")), "tag-pairs")
    names = [r["tag"] for r in pairs.select("tag").distinct().orderBy("tag").limit(MOST_TAGS + 1).collect()]
    if len(names) > MOST_TAGS:
        raise ValueError(f"more than {MOST_TAGS} tags")
    counts = settle(places.groupBy("token", "tag").agg(F.count("*").alias("n")), "token-tags")
    known = counts.select("token").distinct().count()
    of_tag = pairs.groupBy("tag").agg(F.sum("n").alias("total"))
    at = {t: i for i, t in enumerate(names)}
    moves = np.zeros((len(names) + 1, len(names)), np.int64)
    for r in pairs.collect():  # at most (MOST_TAGS + 1) * MOST_TAGS rows
        moves[len(names) if r["before"] is None else at[r["before"]], at[r["tag"]]] = r["n"]
    if not names:
        none = np.zeros(0, np.int64)
        return TagModel([], none, none, counts.select("token", F.expr("CAST(array() AS ARRAY<BIGINT>)").alias("costs")), [])
    share = (moves + 1) / (moves.sum(axis=1, keepdims=True) + max(len(names), 1))
    costs = np.rint(-np.log(share) * UNIT).astype(np.int64)
    totals = {r["tag"]: r["total"] for r in of_tag.collect()}
    wide = counts.groupBy("token").agg(*[F.sum(F.when(F.col("tag") == t, F.col("n")).otherwise(0)).alias(f"_{i}") for i, t in enumerate(names)])
    table = settle(wide.select(
        "token", F.array(*[_cost((F.col(f"_{i}") + 1) / F.lit(totals[t] + known + 1)) for i, t in enumerate(names)]).cast("array<bigint>").alias("costs")
    ), "token-costs")
    unknown = [int(np.rint(-np.log(1 / (totals[t] + known + 1)) * UNIT)) for t in names]
    return TagModel(names, costs[-1], costs[:-1], table, unknown)


def best_path(costs: np.ndarray, start: np.ndarray, step: np.ndarray) -> list[int]:
    """The cheapest sequence of tags for costs (place, tag). Of equally cheap ones the
    last place takes the first tag, then the one before it, and so on."""
    if not len(costs):
        return []
    total, back = start + costs[0], []
    for own in costs[1:]:
        ways = total[:, None] + step
        back.append(ways.argmin(axis=0))
        total = ways.min(axis=0) + own
    path = [int(total.argmin())]
    for links in reversed(back):
        path.append(int(links[path[-1]]))
    return path[::-1]


def tag_in_context(df: DataFrame, model: TagModel, tokens: str = "tokens", out: str = "tags", limit: int = BROADCAST_ROWS) -> DataFrame:
    """`df` with the tags of each token array. Token costs go to the tasks while their
    size allows; beyond it those of the commonest tokens do, and only places of other
    tokens are joined by token. Null arrays give null."""
    start, step, names, unknown = model.start, model.step, model.tags, model.unknown
    if not names:
        return df.withColumn(out, F.transform(tokens, lambda t: F.lit(None).cast("string")))
    small = fits(model.table, limit)
    keyed = df if small else numbered(df, "tag-arrays")
    common = model.table if small else frequent_part(keyed.select(F.explode(tokens).alias("token")), model.table, "token", limit)
    rows = [(r["token"], r["costs"]) for r in common.toLocalIterator()]
    known = {t: i for i, (t, _) in enumerate(rows)}
    held = df.sparkSession.sparkContext.broadcast((known, np.array([c for _, c in rows] + [unknown], np.int64).reshape(-1, len(names))))

    def tags_of(ts, rare) -> list[str] | None:
        if ts is None:
            return None
        known, table = held.value
        costs = table[[known.get(t, -1) for t in ts]] if len(ts) else table[:0]
        for r in () if rare is None else rare:
            costs[r["at"]] = r["costs"]
        return [names[i] for i in best_path(costs, start, step)]

    @F.arrow_udf(ArrayType(StringType()))
    def tag(column: pa.Array) -> pa.Array:
        return pa.array((tags_of(ts, None) for ts in few_at_once(column)), pa.list_(pa.string()))

    @F.arrow_udf(ArrayType(StringType()))
    def tag_with(column: pa.Array, rare: pa.Array) -> pa.Array:
        return pa.array((tags_of(*x) for x in zip(few_at_once(column), few_at_once(rare))), pa.list_(pa.string()))

    @F.arrow_udf(BooleanType())
    def is_whole(column: pa.Array) -> pa.Array:
        known = held.value[0]
        return pa.array((ts is None or all(t in known for t in ts) for ts in few_at_once(column)), pa.bool_())

    if small:
        return df.withColumn(out, tag(F.col(tokens)))
    # Arrays of common tokens stay where they are.
    whole = keyed.where(is_whole(F.col(tokens))).withColumn(out, tag(F.col(tokens)))
    others = keyed.where(~is_whole(F.col(tokens)))
    places = keyed.select("_row", F.posexplode(tokens).alias("at", "token")).join(F.broadcast(common.select("token")), "token", "left_anti")
    per_row = places.join(model.table, "token").groupBy("_row").agg(F.collect_list(F.struct("at", "costs")).alias("_rare"))
    found = others.join(per_row, "_row", "left").withColumn(out, tag_with(F.col(tokens), F.col("_rare")))
    return whole.unionByName(found.select(*whole.columns)).drop("_row")

"""Mixing sources to target weights by min-cost flow.

Documents are counted by membership pattern, the set of sources a document belongs to. Each
pattern's words flow to the quotas of its sources; a further pass over a pattern costs more than the
one before (convex repetition costs), so repetition is spread before it deepens. A pattern is
then taken in whole passes, plus a seeded selection that fills the rest of its flow.

Only one row per pattern and per source reaches the driver. The selection is a bucket threshold, an order
threshold inside the one bucket where the flow ends, and a few documents around that threshold
whose sizes fill the rest. A bucket holds about sixteen times the square root of a pattern's documents.

Null sources are a source of their own, null texts have size 0, and documents without words or
without a target are never taken. Rows that agree in id and text are taken together. An
empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections import deque
from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourwatt.llm.common import WORD, fresh, handed_over

EPOCHS = 3
SWAP = 16  # documents on either side of the edge that are chosen anew
COSTS = (0, 1, 4)  # of the first, second and third pass over a document


def words_in(text: Column) -> Column:
    """Words of a text, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def weighted_targets(sizes: dict[str | None, int], weights: Sequence[float] = (5, 2, 1), most: int = EPOCHS) -> dict:
    """Targets that share all words by weight, none above ``most`` times its source.

    Sources are ordered by code point, null last, and get the weights in turn. What a full source
    cannot take is shared by weight among the others until none is above its limit.
    """
    order = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    out, free, left = {}, list(order), float(sum(sizes.values()))
    while free:
        whole = sum(weight[s] for s in free)
        full = [s for s in free if left * weight[s] / whole > most * sizes[s]]
        if not full:
            out |= {s: left * weight[s] / whole for s in free}
            break
        for s in full:
            out[s] = float(most * sizes[s])
        left -= sum(out[s] for s in full)
        free = [s for s in free if s not in out]
    return out


def route(capacity: dict[tuple, int], quota: dict, costs: Sequence[int] = COSTS) -> dict[tuple, dict]:
    """Words each pattern gives each source: a maximal flow of least repetition cost.

    Successive cheapest augmenting paths over a graph with a node per pattern and per source.
    """
    arcs: list[list] = []  # to, free capacity, cost
    out: dict[object, list[int]] = {}

    def arc(u, v, free: int, cost: int) -> None:
        for a, b, f, c in ((u, v, free, cost), (v, u, 0, -cost)):
            out.setdefault(a, []).append(len(arcs))
            arcs.append([b, f, c])

    for pattern, words in capacity.items():
        for cost in costs:
            arc("in", ("pattern", pattern), words, cost)
        for source in pattern:
            if source in quota:
                arc(("pattern", pattern), ("source", source), sum(capacity.values()) * len(costs), 0)
    for source, words in quota.items():
        arc(("source", source), "out", words, 0)
    while True:
        best, via, queue = {"in": 0}, {}, deque(["in"])
        while queue:
            u = queue.popleft()
            for k in out.get(u, ()):
                v, free, cost = arcs[k]
                if free > 0 and best[u] + cost < best.get(v, math.inf):
                    best[v], via[v] = best[u] + cost, k
                    queue.append(v)
        if "out" not in best:
            break
        path, v = [], "out"
        while v != "in":
            path.append(via[v])
            v = arcs[via[v] ^ 1][0]
        step = min(arcs[k][1] for k in path)
        for k in path:
            arcs[k][1] -= step
            arcs[k ^ 1][1] += step
    flow: dict[tuple, dict] = {pattern: {} for pattern in capacity}
    for u, ks in out.items():
        if isinstance(u, tuple) and u[0] == "pattern":
            for k in ks:
                v = arcs[k][0]
                if k % 2 == 0 and arcs[k ^ 1][1]:
                    flow[u[1]][v[1]] = arcs[k ^ 1][1]
    return flow


def fill(rows: list[tuple[int, int]], room: int) -> tuple[int | None, list[int]]:
    """Of (order, words) pairs: the last order taken without a gap, and single ones taken after it.

    Documents are taken in order while they fit. Then the last ``SWAP`` taken and the next ``SWAP``
    are chosen anew, so that together they come as near to the room as they can.
    """
    rows = sorted(rows)
    taken = total = 0
    while taken < len(rows) and total + rows[taken][1] <= room:
        total += rows[taken][1]
        taken += 1
    sure = taken if taken == len(rows) else max(0, taken - SWAP)
    last = rows[sure - 1][0] if sure else None
    room -= sum(words for _, words in rows[:sure])
    open_ = rows[sure : taken + SWAP]
    reach, steps = 1, []  # bit n: some choice of the documents so far has n words
    for _, words in open_:
        steps.append(reach)
        reach = (reach | reach << words) & ((2 << room) - 1)
    left, chosen = reach.bit_length() - 1, []
    for (order, words), before in zip(reversed(open_), reversed(steps)):
        if not before >> left & 1:
            chosen.append(order)
            left -= words
    return last, sorted(chosen)


def measured(docs: DataFrame, sources: Column, size: Column, identity: Sequence[str], seed: int) -> tuple[DataFrame, tuple[str, str, str]]:
    """``docs`` with their membership pattern, size and seeded order, and the names of these columns."""
    names = tuple(fresh(docs, x) for x in ("pattern", "words", "order"))
    values = (F.sort_array(F.array_distinct(F.coalesce(sources, F.array().cast("array<string>")))), size.cast("long"), F.xxhash64(F.lit(seed), *identity))
    return docs.withColumns(dict(zip(names, values))), names


def mixed_passes(
    docs: DataFrame, sources: Column, size: Column, targets: dict[str, float] | Callable[[dict[tuple, int]], dict[str, float]],
    out: str, identity: Sequence[str] = ("doc_id", "text"), costs: Sequence[int] = COSTS, seed: int = 17,
) -> DataFrame:
    """``docs`` with the column ``out``: how often the mix takes each document.

    ``sources`` is an array of source names, ``targets`` the words wanted of each source, or a
    function that makes them from the words of each pattern.
    """
    spark = docs.sparkSession
    df, (pat, words, order) = measured(docs, sources, size, identity, seed)
    bucket = fresh(df, "bucket")
    sized = handed_over(df.select(pat, words, order), "sizes")  # texts are measured once
    totals = sized.groupBy(pat).agg(F.sum(words), F.count("*")).collect()
    capacity = {tuple(p): int(w or 0) for p, w, _ in totals}
    rows_of = {tuple(p): n for p, _, n in totals}
    if callable(targets):
        targets = targets(capacity)
    flow = route({p: w for p, w in capacity.items() if w}, {s: round(t) for s, t in targets.items()}, costs)
    plan = {}
    for p, w in capacity.items():
        given = sum(flow.get(p, {}).values())
        plan[p] = (*divmod(given, w), max(1, math.isqrt(rows_of[p]) // 16)) if w else (0, 0, 1)

    def lookup(values: dict, kind: str) -> DataFrame:
        return spark.createDataFrame([(list(p), *v) for p, v in values.items()], f"p array<string>, {kind}")

    steps = lookup(plan, "passes long, rest long, buckets long")
    small = sized.join(F.broadcast(steps), F.col(pat) == F.col("p"))
    small = small.where("rest > 0").select("p", "rest", words, order, F.pmod(order, F.col("buckets")).alias(bucket))
    sums = small.groupBy("p", bucket).agg(F.sum(words).alias("n"), F.max("rest").alias("rest"))

    def edge(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("bucket")
        below = group.n.cumsum() - group.n
        hit = int((below <= group.rest).sum()) - 1
        return pd.DataFrame(
            {"p": [group.p.iloc[0]], "bucket": [group.bucket.iloc[hit]], "room": [group.rest.iloc[hit] - below.iloc[hit]]}
        )

    found = sums.withColumnRenamed(bucket, "bucket").groupBy("p").applyInPandas(
        edge, "p array<string>, bucket long, room long"
    ).collect()
    before = {tuple(p): (b, room) for p, b, room in found}

    def choose(group: pd.DataFrame) -> pd.DataFrame:
        both = group.groupby("o").n.sum()
        last, later = fill(list(zip(both.index.tolist(), both.tolist())), int(group.room.iloc[0]))
        return pd.DataFrame({"p": [group.p.iloc[0]], "last": pd.Series([last], dtype="Int64"), "later": [later]})

    edges = lookup(before, "bucket long, room long")
    ends = (
        small.withColumnRenamed(bucket, "bucket").join(F.broadcast(edges), ["p", "bucket"])
        .select("p", "room", F.col(order).alias("o"), F.col(words).alias("n"))
        .groupBy("p").applyInPandas(choose, "p array<string>, last long, later array<long>").collect()
    )
    cut = {tuple(p): (last, later) for p, last, later in ends}
    whole = {
        p: (k, b, before.get(p, (-1, 0))[0], *cut.get(p, (None, []))) for p, (k, _, b) in plan.items()
    }
    rule = lookup(whole, "passes long, buckets long, edge long, last long, later array<long>")
    rule = rule.select([F.col(c).alias(fresh(df, f"mix_{c}")) for c in rule.columns])
    p, passes, buckets, edge_, last, later = (F.col(c) for c in rule.columns)
    slot = F.pmod(F.col(order), buckets)
    in_edge = F.coalesce(F.col(order) <= last, F.lit(False)) | F.array_contains(later, F.col(order))
    chosen = (F.col(words) > 0) & ((slot < edge_) | ((slot == edge_) & in_edge))
    joined = df.join(F.broadcast(rule), F.col(pat) == p)
    count = F.when(F.col(words) > 0, passes).otherwise(0) + chosen.cast("long")
    return joined.withColumn(out, count).select(*docs.columns, out)


def source_key(source: Column) -> Column:
    """A name for the source that keeps null apart from every text."""
    return F.when(source.isNull(), F.lit("null")).otherwise(F.concat(F.lit("="), source))


def mix_by_weight(docs: DataFrame, out: str, source: str = "source", text: str = "text", **settings) -> tuple[DataFrame, dict, dict]:
    """``docs`` with passes by weighted targets; also the sizes and the targets of the sources."""
    sizes: dict[str | None, int] = {}
    targets: dict[str | None, float] = {}

    def weigh(capacity: dict[tuple, int]) -> dict[str, float]:
        sizes.update({None if p == ("null",) else p[0][1:]: n for p, n in capacity.items()})
        targets.update(weighted_targets(sizes))
        return {("null" if s is None else f"={s}"): t for s, t in targets.items()}

    key = F.array(source_key(F.col(source)))
    df = mixed_passes(docs, key, words_in(F.col(text)), weigh, out, ("doc_id", text), **settings)
    return df, sizes, targets

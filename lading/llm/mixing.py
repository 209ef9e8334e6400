"""Mixing overlapping sources to target weights as a minimum-cost flow.

Documents are first aggregated by membership pattern, the set of sources they may be counted for;
patterns are few, documents are many. Every pattern supplies its words once at no cost, a second
time at cost 1, a third at cost 2 (convex in the repetitions, up to ``epochs``), every source
takes in its quota. As all patterns pay the same price for the same repetition, the cheapest flow
is found by raising the supplies one repetition after the other and augmenting along shortest
paths, earlier flow being rerouted where that helps. The flow out of a pattern is a number of
words: every document is taken ``flow // supply`` times, and the rest is filled in the order of a
seeded hash; the one document that crosses the line gives the words that are still missing.

That line is found from sums over 4,096 ranges of the hash, and then inside the one range it lies
in, range by range, so that no source has to meet in one task, however large it is.

Defined results: a null or blank text has size 0 and gives nothing. A null source is a source of
its own, the last in order. Without words every target and take is 0. Repeated rows are documents
of their own that share one place in the order; both are taken alike up to that place, and the
words missing at the line are given by their number. Other columns are handed through or left out.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import stored

PATTERN_LIMIT = 200_000
RANGE_BITS = 12
LEVELS = 5
BLANKS = r"[ \t\n\u000B\f\r]+"


def word_count(text: str = "text") -> Column:
    """Number of words; blanks are the six ASCII ones."""
    return F.coalesce(
        F.size(F.array_remove(F.split(F.col(text), BLANKS), "")), F.lit(0)).cast("long")


def targets(
    sizes: Sequence[tuple[str | None, int]], weights: Sequence[float] = (3, 1, 2),
    share: float = 1.5, most: float = 2.0,
) -> dict[str | None, float]:
    """Words wanted of each source.

    Sources in code-point order, null last, weigh ``weights`` in turn and share ``share`` times
    all words; no target exceeds ``most`` times its source, the excess going to the others by
    weight, until none is above.
    """
    ordered = sorted(sizes, key=lambda s: (s[0] is None, s[0] or ""))
    weight = {name: float(weights[k % len(weights)]) for k, (name, _) in enumerate(ordered)}
    limit = {name: most * size for name, size in ordered}
    want: dict[str | None, float] = {}
    rest = share * sum(size for _, size in ordered)
    free = list(weight)
    while free:
        total = sum(weight[name] for name in free)
        above = [n for n in free if rest * weight[n] / total > limit[n]]
        if not above:
            want |= {name: rest * weight[name] / total for name in free}
            break
        for name in above:
            want[name] = limit[name]
        rest -= sum(limit[name] for name in above)
        free = [name for name in free if name not in above]
    return want


def cheapest_flow(
    supply: dict[int, int], members: dict[int, tuple], quota: dict, epochs: int
) -> dict[tuple[int, object], int]:
    """Words from every pattern to every source. ``supply``: words per pattern and repetition."""
    flow: dict[tuple[int, object], int] = {(p, s): 0 for p in supply for s in members[p]}
    of_source: dict[object, list[int]] = {}
    for p, s in flow:
        of_source.setdefault(s, []).append(p)
    given = dict.fromkeys(supply, 0)
    need = dict(quota)
    for epoch in range(1, epochs + 1):
        # What a pattern alone can give its sources needs no search.
        for p in supply:
            for s in members[p]:
                step = min(supply[p] * epoch - given[p], need.get(s, 0))
                if step > 0:
                    flow[p, s] += step
                    given[p] += step
                    need[s] -= step
        for s in need:
            while need[s] > 0:
                # Backwards from the source: a pattern with words left, or one whose flow to
                # another source can be replaced there.
                came: dict = {("s", s): None}
                queue = deque([("s", s)])
                end = None
                while queue and end is None:
                    kind, x = queue.popleft()
                    if kind == "s":
                        for p in of_source.get(x, ()):
                            if ("p", p) not in came:
                                came["p", p] = (kind, x)
                                if given[p] < supply[p] * epoch:
                                    end = ("p", p)
                                    break
                                queue.append(("p", p))
                    else:
                        for other in members[x]:
                            if flow[x, other] > 0 and ("s", other) not in came:
                                came["s", other] = (kind, x)
                                queue.append(("s", other))
                if end is None:
                    break
                path = [end]
                while came[path[-1]] is not None:
                    path.append(came[path[-1]])
                step = min(need[s], supply[end[1]] * epoch - given[end[1]])
                for (k, x), (_, y) in zip(path, path[1:]):
                    if k == "s":
                        step = min(step, flow[y, x])
                for (k, x), (_, y) in zip(path, path[1:]):
                    if k == "p":
                        flow[x, y] += step
                    else:
                        flow[y, x] -= step
                given[end[1]] += step
                need[s] -= step
    return flow


def _line(measured: DataFrame, wanted: DataFrame) -> DataFrame:
    """Per pattern the hash at which its seeded order reaches the wanted words, and the words
    that are missing there: (pattern, full, line, missing, rows at the line)."""
    state = wanted.select(
        "pattern", "full", F.lit(0).cast("long").alias("line"), F.col("rest").alias("missing"))
    for level in range(LEVELS):
        shift = (LEVELS - 1 - level) * RANGE_BITS
        inside = measured.join(F.broadcast(state), "pattern").filter(
            F.expr(f"shiftright(place, {shift + RANGE_BITS})") == F.col("line"))
        sums = inside.groupBy("pattern", F.shiftright("place", shift).alias("range")).agg(
            F.sum("size").alias("words"), F.first("full").alias("full"),
            F.first("missing").alias("missing"))
        before = F.coalesce(F.sum("words").over(
            Window.partitionBy("pattern").orderBy("range")
            .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        state = sums.withColumn("before", before).filter(
            (F.col("before") < F.col("missing"))
            & (F.col("before") + F.col("words") >= F.col("missing"))
        ).select(
            "pattern", "full", F.col("range").alias("line"),
            (F.col("missing") - F.col("before")).alias("missing"))
        state = stored(state, "line")
    return state


def mix(
    docs: DataFrame, seed: int = 7, epochs: int = 2, id_column: str = "doc_id",
    text: str = "text", source: str = "source", memberships: Column | None = None,
    weights: Sequence[float] = (3, 1, 2), share: float = 1.5,
) -> DataFrame:
    """``docs`` with ``size``, ``source_size``, ``target`` and ``taken`` added.

    ``memberships`` are the sources a document may count for (an array; by default its source
    alone). ``taken`` counts its words in the mix, repeats included; ``epochs`` bounds the repeats.
    ``source_size`` and ``target`` are those of the document's own source.
    """
    names = docs.columns
    of = {name: f"c{k}" for k, name in enumerate(names)}
    own = F.col(of[source])
    keyed = docs.withColumn("_members", memberships if memberships is not None else F.array(source))
    keyed = keyed.toDF(*of.values(), "_members").withColumns({
        "_size": word_count(of[text]),
        "_pattern": F.xxhash64(F.transform(
            F.sort_array(F.array_distinct("_members")), lambda m: F.coalesce(F.concat(F.lit("="), m), F.lit("")))),
        "_place": F.shiftrightunsigned(
            F.xxhash64(F.lit(seed), of[id_column], of[text]), 64 - LEVELS * RANGE_BITS),
    })
    slim = stored(keyed.select(
        F.col("_pattern").alias("pattern"), "_members", own.alias("source"),
        F.col("_size").alias("size"), F.col("_place").alias("place")), "mixing")
    by_source = slim.groupBy("source").agg(F.sum("size").alias("words")).limit(PATTERN_LIMIT + 1)
    by_pattern = slim.groupBy("pattern").agg(
        F.first("_members").alias("members"), F.sum("size").alias("words")).limit(PATTERN_LIMIT + 1)
    sizes = {r.source: r.words for r in by_source.collect()}
    patterns = by_pattern.collect()
    if max(len(sizes), len(patterns)) > PATTERN_LIMIT:
        raise ValueError(f"more than {PATTERN_LIMIT} sources or membership patterns")
    want = targets(list(sizes.items()), weights, share)
    supply = {r.pattern: r.words for r in patterns}
    flow = cheapest_flow(
        supply, {r.pattern: tuple(r.members) for r in patterns},
        {name: round(words) for name, words in want.items()}, epochs)
    out: dict[int, int] = dict.fromkeys(supply, 0)
    for (p, _), words in flow.items():
        out[p] += words
    spark = docs.sparkSession
    wanted = spark.createDataFrame(
        [(p, w // max(supply[p], 1), w % max(supply[p], 1)) for p, w in out.items()],
        "pattern long, full long, rest long")
    lines = _line(slim.filter("size > 0"), wanted.filter("rest > 0"))
    # Rows that share the place at the line share the missing words in turn.
    at_line = slim.join(
        F.broadcast(lines.select("pattern", "line")), "pattern"
    ).filter("place = line").groupBy("pattern").agg(F.sum("size").alias("tied"))
    plan = wanted.join(lines.select("pattern", "line", "missing"), "pattern", "left").join(
        at_line, "pattern", "left").withColumnsRenamed({"pattern": "_planned"})
    quota = spark.createDataFrame(
        [(name, name is None, words, want[name]) for name, words in sizes.items()],
        "_source string, _none boolean, source_size long, target double")
    # Both sides hold one row per pattern or source, of which there are at most PATTERN_LIMIT.
    marked = keyed.join(
        F.broadcast(plan), F.col("_pattern") == F.col("_planned"), "left"
    ).join(F.broadcast(quota), own.eqNullSafe(F.col("_source")), "left")
    part = (
        F.when(F.col("_place") < F.col("line"), F.col("_size"))
        .when(F.col("_place") == F.col("line"),
              F.floor(F.col("_size") * F.col("missing") / F.greatest(F.col("tied"), F.lit(1))))
        .otherwise(0))
    taken = F.coalesce(F.col("full"), F.lit(0)) * F.col("_size") + F.coalesce(part, F.lit(0))
    return marked.select(
        *of.values(), F.col("_size").alias("size"), "source_size", "target",
        taken.cast("long").alias("taken")).toDF(*names, "size", "source_size", "target", "taken")


def realised(mixed: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The rows of the mix, with ``columns``: whole texts as often as taken. A document of which a part is
    taken is one time more in the mix if that part is half of it or more."""
    times = F.when(
        F.col("size") > 0, F.floor(F.col("taken") / F.col("size") + 0.5)).otherwise(0).cast("int")
    spread = mixed.withColumn("_times", F.explode(F.array_repeat(F.lit(0), times)))
    return spread.select(*columns)

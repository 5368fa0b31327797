"""Mixing overlapping sources to target weights by min-cost flow.

Documents are aggregated by membership pattern (the set of sources they belong to). A
small flow network then routes the words of each pattern to the quotas of its sources;
the k-th repetition of a pattern costs ``k - 1`` a word, so the cost is convex and nothing
is repeated while words that were not used yet can fill a quota. The driver sees one
number per pattern, at most ``MAX_PATTERNS`` of them (more is an error, never a cut).

What a pattern gives is turned into a rule on the document: so many whole repetitions,
and one more for documents whose seeded hash lies below a cut. The cut comes from a
histogram over 4,096 hash ranges and from the documents of the one range it falls in.
Every document decides for itself, so reruns agree and no text is shuffled.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tidemark.llm.common import staged, word_count, text_or_empty

MAX_PATTERNS = 100_000
WEIGHTS = (3, 1, 2)
SHARE = Fraction(3, 2)
REPEATS = 2
SEED = "mix-1"

Sources = tuple  # of str or None


def seeded(id_col: str, seed: str = SEED) -> Column:
    """16 hexadecimal digits that order documents at random, the same in every run."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    return F.substring(F.md5(name.cast("binary")), 1, 16)


def targets_of(
    sizes: dict, weights=WEIGHTS, share: Fraction = SHARE, repeats: int = REPEATS, total: int | None = None
) -> dict:
    """Words wanted from each source: its share by weight, at most ``repeats`` x its size.

    ``total`` is the words of all documents, where sources overlap; ``share`` of them is
    shared. Sources are in order of their code points, null last, and weights repeat along them.
    What lies above a limit is shared out again by weight until no source is above.
    """
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {name: weights[i % len(weights)] for i, name in enumerate(names)}
    limit = {name: repeats * sizes[name] for name in names}
    rest = share * (sum(sizes.values()) if total is None else total)
    open_, wanted = set(names), {}
    while open_:
        heft = sum(weight[n] for n in open_)
        full = {n for n in open_ if rest * weight[n] > limit[n] * heft}
        if not full:
            wanted |= {n: float(rest) * weight[n] / heft for n in open_}
            break
        wanted |= {n: float(limit[n]) for n in full}
        rest -= sum(limit[n] for n in full)
        open_ -= full
    return wanted


def route(capacity: dict[Sources, int], quotas: dict, repeats: int = REPEATS) -> dict[Sources, int]:
    """Words that each pattern gives: a min-cost flow by successive shortest paths.

    Edges run from a pattern to its sources. A pattern's next word costs 0 during its
    first repetition, 1 during the second, and so on. Fills the quotas as far as any
    routing can; among such routings the sum of repetition costs is smallest.
    """
    given = {p: 0 for p in capacity}
    open_ = {s: q for s, q in quotas.items() if q > 0}
    flow: dict[tuple, int] = {}
    members: dict = {}
    for pattern in capacity:
        for source in pattern:
            members.setdefault(source, []).append(pattern)

    def path(start: Sources) -> list | None:
        """From a pattern to an open quota, by way of flow that can be re-routed."""
        seen, queue = {start: None}, [start]
        for pattern in queue:
            for source in pattern:
                if source in open_:
                    steps, at = [(pattern, source)], pattern
                    while seen[at] is not None:
                        came = seen[at]
                        steps.append((came[0], came[1]))
                        at = came[0]
                    return steps[::-1]
                for other in members[source]:
                    if flow.get((other, source), 0) > 0 and other not in seen:
                        seen[other] = (pattern, source)
                        queue.append(other)
        return None

    # Costs depend on the pattern alone, and re-routing keeps what a pattern gives, so
    # the cheapest path starts at the cheapest pattern that still reaches an open quota.
    for tier in range(1, repeats + 1):
        for pattern in sorted(capacity, key=str):
            while given[pattern] < tier * capacity[pattern] and (steps := path(pattern)):
                room = min(tier * capacity[pattern] - given[pattern], open_[steps[-1][1]])
                for (_, source), (other, _) in zip(steps, steps[1:]):
                    room = min(room, flow[(other, source)])
                for i, (at, source) in enumerate(steps):
                    flow[(at, source)] = flow.get((at, source), 0) + room
                    if i + 1 < len(steps):
                        flow[(steps[i + 1][0], source)] -= room
                given[pattern] += room
                open_[steps[-1][1]] -= room
                if not open_[steps[-1][1]]:
                    del open_[steps[-1][1]]
    return given


def _cuts(sized: DataFrame, need: DataFrame) -> DataFrame:
    """For each pattern the hash below which a document is taken once more.

    ``need`` has the words that whole repetitions leave over. A document on the edge is
    taken if that comes nearer to the need.
    """
    sized = sized.join(F.broadcast(need), F.expr("pattern <=> need_pattern")).filter("need > 0")
    ranges = sized.groupBy("pattern", "need", F.substring("h", 1, 3).alias("range")).agg(
        F.sum("size").alias("words")
    )
    along = Window.partitionBy("pattern").orderBy("range")
    edge = (
        ranges.withColumn("before", F.sum("words").over(along) - F.col("words"))
        .filter("before <= need AND need <= before + words")
        .groupBy("pattern", "need")
        .agg(F.min_by(F.struct("range", "before"), "range").alias("edge"))
        .select(F.col("pattern").alias("edge_pattern"), "edge.range", "edge.before")
    )
    inside = sized.join(
        F.broadcast(edge), F.expr("pattern <=> edge_pattern AND substring(h, 1, 3) = range")
    )
    by_hash = inside.groupBy("pattern", "need", "range", "before", "h").agg(F.sum("size").alias("words"))
    up_to = Window.partitionBy("pattern").orderBy("h")
    taken = by_hash.withColumn("sum", F.col("before") + F.sum("words").over(up_to)).filter(
        "2 * sum - words < 2 * need"
    )
    # Without a document on this side of the edge, the cut is the start of the range.
    return (
        edge.join(taken.groupBy("pattern").agg(F.max("h").alias("last")), F.expr("pattern <=> edge_pattern"), "left")
        .select(F.col("edge_pattern").alias("pattern"), F.coalesce("last", "range").alias("cut"))
    )


def mix(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    weights=WEIGHTS, share: Fraction = SHARE, repeats: int = REPEATS, seed: str = SEED,
) -> DataFrame:
    """One row per document: id, size, source_size, target (of its source), taken.

    ``source_col`` holds a source or, for overlapping sources, an array of them. For an
    array, source_size and target are the sums over its sources.

    A null text has size 0 and is never taken; a null source is a source of its own, and
    so is an empty name. Documents with equal ids are taken or left together; null ids
    share one place in the order. An empty table gives no rows. Other columns are not read.
    """
    plan, rows = decide(docs, id_col, text_col, source_col, weights, share, repeats, seed)
    return rows.join(F.broadcast(plan), F.expr("pattern <=> plan_pattern")).select(
        F.col("id").alias(id_col), "size", "source_size", "target", _taken().alias("taken")
    )


def _taken() -> Column:
    return F.col("size") * (F.col("whole") + F.coalesce((F.col("h") <= F.col("cut")).cast("long"), F.lit(0)))


def decide(docs, id_col, text_col, source_col, weights, share, repeats, seed) -> tuple[DataFrame, DataFrame]:
    """The rule of every pattern (a small table), and the documents' sizes and hashes."""
    spark = docs.sparkSession
    rows = staged(
        docs.select(
            F.col(id_col).alias("id"), _pattern(docs, source_col).alias("pattern"),
            word_count(text_or_empty(text_col)).alias("size"), seeded(id_col, seed).alias("h"),
        ),
        "sizes",
    )
    totals = rows.groupBy("pattern").agg(F.sum("size").alias("size")).limit(MAX_PATTERNS + 1).collect()
    if len(totals) > MAX_PATTERNS:
        raise ValueError(f"more than {MAX_PATTERNS} membership patterns")
    capacity = {tuple(r["pattern"]): int(r["size"]) for r in totals}
    sizes: dict = {}
    for pattern, words in capacity.items():
        for source in pattern:
            sizes[source] = sizes.get(source, 0) + words
    wanted = targets_of(sizes, weights, share, repeats, sum(capacity.values()))
    given = route(capacity, {s: int(t + 0.5) for s, t in wanted.items()}, repeats)
    rules = [
        (list(p), sum(sizes[s] for s in p), float(sum(wanted[s] for s in p)),
         given[p] // words if words else 0, given[p] % words if words else 0)
        for p, words in capacity.items()
    ]
    plan = spark.createDataFrame(
        rules, "plan_pattern array<string>, source_size long, target double, whole long, need long"
    )
    cuts = _cuts(rows, plan.select(F.col("plan_pattern").alias("need_pattern"), "need"))
    found = [(list(r["pattern"]), r["cut"]) for r in cuts.collect()]  # one per pattern at most
    cut = spark.createDataFrame(found, "cut_pattern array<string>, cut string")
    return plan.join(F.broadcast(cut), F.expr("plan_pattern <=> cut_pattern"), "left").drop("cut_pattern"), rows


def _pattern(docs: DataFrame, source_col: str) -> Column:
    if isinstance(docs.schema[source_col].dataType, T.ArrayType):
        sources = F.array_distinct(F.col(source_col).cast("array<string>"))
        names = F.array_sort(F.array_compact(sources))
        whole = F.when(F.exists(sources, lambda s: s.isNull()), F.concat(names, F.array(F.lit(None).cast("string"))))
        alone = F.array(F.lit(None).cast("string"))
        return F.when(F.coalesce(F.size(sources), F.lit(0)) <= 0, alone).otherwise(F.coalesce(whole, names))
    return F.array(F.col(source_col).cast("string"))


def mixed(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    weights=WEIGHTS, share: Fraction = SHARE, repeats: int = REPEATS, seed: str = SEED,
) -> DataFrame:
    """The documents that the mix takes, with all their columns, once for each repetition."""
    plan, _ = decide(docs, id_col, text_col, source_col, weights, share, repeats, seed)
    own = docs.select(F.struct(*docs.columns).alias("doc"), *docs.columns).select(
        "doc", _pattern(docs, source_col).alias("pattern"), seeded(id_col, seed).alias("h"),
        word_count(text_or_empty(text_col)).alias("size"),
    )
    times = F.when(F.col("size") > 0, F.expr("whole + coalesce(int(h <= cut), 0)")).otherwise(F.lit(0))
    return (
        own.join(F.broadcast(plan), F.expr("pattern <=> plan_pattern"))
        .withColumn("times", times.cast("int"))
        .filter("times > 0")
        .select("doc", F.explode(F.sequence(F.lit(1), F.col("times"))).alias("n"))
        .select("doc.*")
    )

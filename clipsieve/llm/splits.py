"""Splits that keep related records together (problem 1).

Rows that share a speaker or a sentence, directly or through a chain of other rows, form a component. Components come
from a distributed connected-components run on the graph of speakers (two speakers are joined by a sentence both read).
Components of the same size and label profile are bundled, and only the bundles reach the driver. There a min-cost flow
fills the splits' quotas, and the members of a bundle are assigned by the rank of their hash.

The profile has all labels of a component: the rows of each, or beyond EXACT rows its share in tenths. Components beyond
EXACT rows are of the same size if it is the same to an eighth of a doubling, except those of more than a LARGE-th of all
rows, which are bundles of their own. So the bundles have a bound that grows with the logarithm of the rows only: LARGE
of the large components, below 3,003 profiles (tenths over LABELS labels) for each of 8 sizes to a doubling of the
others, and the exact ones; a corpus of clips has some hundreds.

Defined cases: a null or blank speaker is no speaker, a null sentence or one without letters and digits is no
sentence; a row with neither is a component of its own (rows without a row_id share one). An empty table gives an empty result.
"""

from __future__ import annotations

import heapq
from collections import defaultdict

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clipsieve.llm.base import Sorted, free, join_counted, key_of, small, stored, table
from clipsieve.llm.textform import corpus_form, in_form

PROPORTIONS = {"train": 0.8, "dev": 0.1, "test": 0.1}
#: Labels told apart: the most frequent ones, the others together, and none.
LABELS = 6
EXACT = 20
LARGE = 10_000
#: Parts of a component whose pairs are made by different tasks.
PARTS = 8


def connected(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the undirected ``edges`` (a, b): root is the least node of its component.

    Each round hooks every node, and the root it has, on the least root among its neighbours, then shortens the paths
    (FastSV): the number of rounds grows with the logarithm of the longest path. Rounds are cut by stored tables.
    """
    both = stored(edges.filter("a <> b").select("a", "b").union(edges.filter("a <> b").select("b", "a")).distinct())
    roots = stored(both.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("root")))
    while True:
        around = both.join(roots.select(F.col("node").alias("b"), "root"), "b").groupBy(F.col("a").alias("node")).agg(F.min("root").alias("near"))
        own = roots.join(around, "node")
        offers = own.select("node", F.least("root", "near").alias("to")).union(own.select(F.col("root").alias("node"), F.least("root", "near").alias("to")))
        hooked = offers.groupBy("node").agg(F.min("to").alias("to"))
        jumped = hooked.join(hooked.select(F.col("node").alias("to"), F.col("to").alias("root")), "to").select("node", "root")
        after = stored(jumped)
        changed = after.join(roots.withColumnRenamed("root", "was"), "node").filter("root <> was").limit(1).count()
        free(roots)
        roots = after
        if not changed:
            return roots


def _readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """row_id, speaker, sentence (in the form of problem 7, null where it joins nobody) and label (the gender, null as 'none')."""
    cv = table(spark, sf_dir, "common_voice")
    form = corpus_form(spark, sf_dir)
    kept = cv.select("row_id", key_of(F.col("client_id")).alias("speaker"), "sentence", F.coalesce(key_of(F.col("gender")), F.lit("none")).alias("label"))
    return in_form(kept, "sentence", form, "sentence").withColumn("sentence", F.when(F.col("sentence").rlike(r"[\p{L}\p{N}]"), F.col("sentence")))


def told_apart(rows: DataFrame, labels: int = LABELS) -> DataFrame:
    """``rows`` with label 'other' for all but the most frequent labels."""
    counts = rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "label")
    kept = [x.label for x in counts.limit(labels - 1).collect()]
    return rows.withColumn("label", F.when(F.col("label").isin(kept), F.col("label")).otherwise(F.lit("other")))


def speaker_roots(readings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(speaker, root) of all speakers joined with others, and (sentence, first): the least speaker of a sentence."""
    pairs = stored(readings.filter("speaker is not null and sentence is not null").select("sentence", "speaker").distinct())
    first = pairs.groupBy("sentence").agg(F.min("speaker").alias("first"), F.count(F.lit(1)).alias("speakers"))
    edges = pairs.join(first.filter("speakers > 1"), "sentence").select(F.col("speaker").alias("a"), F.col("first").alias("b")).distinct()
    roots = connected(edges)
    return roots.select(F.col("node").alias("speaker"), "root"), first.select("sentence", "first")


def components(readings: DataFrame) -> DataFrame:
    """row_id, label, component. A component is named by its least speaker, or its sentence, or its only row."""
    roots, first = speaker_roots(readings)
    total = readings.count()
    # a speaker or a sentence may have a third of the rows
    spoken, silent = readings.filter("speaker is not null"), readings.filter("speaker is null")
    speakers = spoken.groupBy("speaker").agg(F.count(F.lit(1)).alias("_n")).join(roots, "speaker", "left").select("speaker", "_n", F.concat(F.lit("k:"), F.coalesce("root", "speaker")).alias("component"))
    # rows of nobody hang on their sentence's component; a row without a sentence is alone
    read = silent.filter("sentence is not null")
    through = read.groupBy("sentence").agg(F.count(F.lit(1)).alias("_n")).join(first, "sentence", "left").join(roots.withColumnRenamed("speaker", "first"), "first", "left")
    sentences = through.select("sentence", "_n", F.coalesce(F.concat(F.lit("k:"), F.coalesce("root", "first")), F.concat(F.lit("s:"), F.md5("sentence"))).alias("component"))
    alone = silent.filter("sentence is null")
    named = [join_counted(rows.select("row_id", "label", key), stored(groups), key, "_n", total).select("row_id", "label", "component") for rows, groups, key in ((spoken, speakers, "speaker"), (read, sentences, "sentence"))]
    return named[0].union(named[1]).union(alone.select("row_id", "label", F.concat(F.lit("r:"), F.coalesce(F.col("row_id").cast("string"), F.lit("")))))


def min_cost_flow(items: list[tuple[int, list[float]]], quotas: list[int]) -> list[list[int]]:
    """Units of each item (size, cost in each split) that flow to each split, at least cost within the quotas.

    Successive shortest paths on the transport network. Its residual graph is contracted to the splits: an arc from one
    split to another is the cheapest item that could move, kept in a heap, so an augmentation takes time for the number
    of splits, not of items.
    """
    k = len(quotas)
    flow = [[0] * k for _ in items]
    left = list(quotas)
    heaps: dict[tuple[int, int], list[tuple[float, int]]] = defaultdict(list)

    def cheapest(a: int, b: int) -> tuple[float, int] | None:
        heap = heaps[a, b]
        while heap and not flow[heap[0][1]][a]:
            heapq.heappop(heap)
        return heap[0] if heap else None

    def put(item: int, split: int, units: int) -> None:
        if not flow[item][split] and units > 0:
            for b in range(k):
                if b != split:
                    heapq.heappush(heaps[split, b], (items[item][1][b] - items[item][1][split], item))
        flow[item][split] += units

    for i, (size, cost) in enumerate(items):
        need = size
        while need:
            far, came, moved = list(cost), [-1] * k, [-1] * k
            for _ in range(k):
                for a in range(k):
                    for b in range(k):
                        if a != b and (arc := cheapest(a, b)) and far[a] + arc[0] < far[b] - 1e-12:
                            far[b], came[b], moved[b] = far[a] + arc[0], a, arc[1]
            open_ = [b for b in range(k) if left[b]]
            if not open_:  # rounding of the quotas; give the rest where it costs least
                put(i, min(range(k), key=lambda b: cost[b]), need)
                break
            end = min(open_, key=lambda b: far[b])
            path, b, seen = [], end, set()
            while came[b] >= 0 and b not in seen:
                seen.add(b)
                path.append((came[b], b, moved[b]))
                b = came[b]
            units = min([need, left[end], *(flow[m][a] for a, _, m in path)])
            for a, to, m in path:
                flow[m][a] -= units
                put(m, to, units)
            put(i, b, units)
            left[end] -= units
            need -= units
    return flow


def allocate(bundles: list[tuple[int, str, int]], proportions: dict[str, float]) -> dict[tuple[int, str], list[int]]:
    """How many components of each bundle (size, label, count) go to each split.

    Rows flow from the bundles to the splits' quotas of rows. The whole part of a bundle's proportional number of
    components flows to its split at no cost and elsewhere at cost 1, the deviation from the proportion. The remaining
    components (of a bundle fewer than there are splits) are gone through by profile: rows owed to each split add up
    over like profiles, and a component costs what a split is owed less than the one that is owed most. Both cost more
    for large components. So without large components every size and label is divided in proportion, and with them the
    others make room. Flows are then rounded to whole components, the largest first, each to the split with most of its
    flow that has room.
    """
    k, total = len(proportions), sum(size * n for size, _, n in bundles)
    weight = sum(proportions.values())
    share = [p / weight for p in proportions.values()]
    quota = [int(total * p) for p in share]
    quota[max(range(k), key=lambda b: share[b])] += total - sum(quota)
    parts: list[tuple[int, str, int, list[float]]] = []
    owed = [0.0] * k
    for size, label, n in sorted(bundles, key=lambda x: (str(x[1]).rpartition("/")[2], -x[0], str(x[1]))):
        base = [int(n * p + 1e-9) for p in share]
        # a deviation costs more for a large component, which is hard to place whole: small ones make room
        large = 1 + 10 * size / total
        parts += [(size, label, c, [0.0 if b == own else large for b in range(k)]) for own, c in enumerate(base) if c]
        # what the whole parts leave of the bundle's proportions
        owed = [x + size * (n * p - b) for x, p, b in zip(owed, share, base, strict=True)]
        for _ in range(n - sum(base)):
            parts.append((size, label, 1, [min(1.0, (max(owed) - x) / size) * large for x in owed]))
            owed[max(range(k), key=lambda b: owed[b])] -= size
    parts.sort(key=lambda x: -x[0])
    flow = min_cost_flow([(size * c, cost) for size, _, c, cost in parts], quota)
    made = {(size, label): [0] * k for size, label, _ in bundles}
    room = list(quota)
    for (size, label, c, _), f in zip(parts, flow, strict=True):
        whole = [x // size for x in f]
        rest = [x - w * size for x, w in zip(f, whole, strict=True)]
        room = [r - w * size for r, w in zip(room, whole, strict=True)]
        for _ in range(c - sum(whole)):
            b = max(range(k), key=lambda b: (min(rest[b], room[b]), room[b]))
            whole[b] += 1
            rest[b] -= size
            room[b] -= size
        made[size, label] = [a + w for a, w in zip(made[size, label], whole, strict=True)]
    return made


def profiled(rows: DataFrame, total: int) -> DataFrame:
    """(component, size, bundle) of rows(component, label): components of one bundle may take each other's place."""
    each = rows.groupBy("component", "label").agg(F.count(F.lit(1)).alias("n"))
    # as many structures as labels
    groups = each.groupBy("component").agg(F.sum("n").alias("size"), F.array_sort(F.collect_list(F.struct("label", "n"))).alias("_labels"))
    part = F.when(F.col("size") <= EXACT, F.lit(1.0)).otherwise(F.lit(10.0) / F.col("size"))
    profile = F.concat_ws(",", F.filter(F.transform("_labels", lambda x: F.when(F.round(x["n"] * part) > 0, F.concat_ws(":", x["label"], F.round(x["n"] * part).cast("int")))), lambda x: x.isNotNull()))
    size = F.when(F.col("size") <= EXACT, F.col("size").cast("string")).otherwise(F.concat(F.lit("~"), F.floor(F.log2("size") * 8).cast("string")))
    own = (F.col("size") > EXACT) & (F.col("size") * LARGE > total)
    return groups.select("component", "size", F.concat_ws("/", F.when(own, F.concat(F.lit("="), F.col("component"))).otherwise(size), profile).alias("bundle"))


def _assigned(spark: SparkSession, sf_dir: str, proportions: dict[str, float]) -> DataFrame:
    """row_id, label and new_split of each row."""
    rows = stored(components(told_apart(stored(_readings(spark, sf_dir)))))
    total = rows.count()
    groups = stored(profiled(rows, total))
    bundles = groups.groupBy("bundle").agg(F.round(F.avg("size")).cast("long").alias("mean"), F.count(F.lit(1)).alias("n")).collect()
    made = allocate([(r.mean, r.bundle, r.n) for r in bundles], proportions)
    names = list(proportions)
    cuts = []
    for (_, bundle), counts in made.items():
        at = 0
        for name, n in zip(names, counts, strict=True):
            if n:
                cuts.append((bundle, at, at + n, name))
            at += n
    cut = spark.createDataFrame(cuts, "bundle string, low long, high long, new_split string")
    ranked = Sorted(groups.withColumn("_h", F.xxhash64("component")), ["bundle"], [F.col("_h"), F.col("component")]).ranked("_rank")
    placed = ranked.join(small(cut), "bundle").filter("_rank > low and _rank <= high").select("component", "size", "new_split")
    return join_counted(rows, stored(placed), "component", "size", total).select("row_id", "label", "new_split")


def p1_split(spark: SparkSession, sf_dir: str, proportions: dict[str, float] | None = None) -> DataFrame:
    """row_id and its new split: train, dev or test in the given proportions, related rows together."""
    return _assigned(spark, sf_dir, proportions or PROPORTIONS).select("row_id", "new_split")


def p1_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each new split and label, the split's share of all rows, and the label's share of the split's rows."""
    n = _assigned(spark, sf_dir, PROPORTIONS).groupBy("new_split", "label").agg(F.count(F.lit(1)).alias("n_rows"))
    # one row for each split and label
    every, own = Window.partitionBy(F.lit(1)), Window.partitionBy("new_split")
    return n.withColumns({"share": F.sum("n_rows").over(own) / F.sum("n_rows").over(every), "label_share": F.col("n_rows") / F.sum("n_rows").over(own)})


def p1_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What must hold, counted: rows, and speakers and sentences in more than one split, and splits off by over a hundredth."""
    cv = table(spark, sf_dir, "common_voice").select("row_id", key_of(F.col("client_id")).alias("speaker"), "sentence")
    placed = stored(cv.join(p1_split(spark, sf_dir), "row_id"))
    read = F.when(F.col("sentence").rlike(r"[\p{L}\p{N}]"), F.col("sentence"))
    parted = lambda key: placed.groupBy(key.alias("_key")).agg((F.min("new_split") != F.max("new_split")).alias("_parted")).agg(F.count_if(F.col("_key").isNotNull() & F.col("_parted")))
    sizes = {r.new_split: r.n for r in placed.groupBy("new_split").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(sizes.values())
    off = sum(abs(sizes.get(name, 0) - p * total) > 0.01 * total for name, p in PROPORTIONS.items())
    row = (total, parted(F.col("speaker")).first()[0], parted(read).first()[0], off)
    return spark.createDataFrame([row], "n_rows long, parted_speakers long, parted_sentences long, splits_off long")


def p1_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(client_id, component): speakers who are joined with others, and the least speaker they are joined with."""
    roots, _ = speaker_roots(_readings(spark, sf_dir))
    return roots.select(F.col("speaker").alias("client_id"), F.col("root").alias("component"))


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of different speakers who must share a split, the smaller first.

    A component may have a third of all speakers: its left sides are spread over PARTS tasks.
    """
    roots, _ = speaker_roots(_readings(spark, sf_dir))
    a = roots.select(F.col("speaker").alias("client_id_a"), "root", F.pmod(F.xxhash64("speaker"), F.lit(PARTS)).alias("part"))
    b = roots.select(F.col("speaker").alias("client_id_b"), "root", F.explode(F.array(*(F.lit(i).cast("long") for i in range(PARTS)))).alias("part"))
    return a.join(b.hint("merge"), ["root", "part"]).filter("client_id_a < client_id_b").select("client_id_a", "client_id_b")

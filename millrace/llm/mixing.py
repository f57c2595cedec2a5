"""Mixing sources to target weights, in built-in expressions only.

A source's words, document after document in a pseudorandom order, are cut into blocks of a fixed
length. The mix is a sequence of slots in shards. Each shard draws how many of its slots go to which
source: a multinomial draw with one uniform number in each of its equal strata. Independent numbers would put the
slots of a source with mean m off by about the root of m; by strata a shard is off by one at most. The k-th slot of a source takes the block to which a pseudorandom
permutation of the source's blocks sends k; past the last block a new permutation begins. Blocks and
slots are joined by their number. Everything random is a hash, so reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import SPACE, WORD, let, words, written

BLOCK = 64  # words
SHARD = 4096  # slots
STEPS = 64  # of a walk back into a permutation's domain, see ``permuted``
WEIGHTS = (3, 1, 2)
SHARE = 1.5
LIMIT = 2
SEED = 42
BUCKET_ROWS = 2_000  # documents of a bucket, on average
STRETCH = 1024  # shards whose draws of one source are numbered in one task
TASK_SLOTS = 100_000  # slots that one task makes


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, limit: int = LIMIT) -> DataFrame:
    """Target words of each source: ``sizes`` has ``source``, ``source_size``.

    Sources in order of code points, null last, weigh ``weights`` in turn. They share ``share`` times
    all words; none gets more than ``limit`` times its own, and the excess goes to the others by
    weight until all stay below. Sorted by size per weight, the sources that stop come first, so one
    running sum finds them: source i stops if its limit is below what it would get of that which
    those before it leave. One row per source goes through a window; sources without words get 0.
    """
    every = Window.orderBy(F.col("source").isNull(), F.encode(F.col("source"), "UTF-8"))
    turn = (F.row_number().over(every) - 1) % len(weights)
    table = sizes.select(
        "source",
        "source_size",
        F.get(F.array(*[F.lit(float(w)) for w in weights]), turn).alias("weight"),
        (F.col("source_size") * float(limit)).alias("most"),
    )
    by_ratio = Window.orderBy(F.col("most") / F.col("weight"), F.encode(F.coalesce("source", F.lit("")), "UTF-8"), F.col("source").isNull())
    whole = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    summed = table.select(
        "*",
        F.row_number().over(by_ratio).alias("rank"),
        (F.sum("source_size").over(whole) * share - F.coalesce(F.sum("most").over(before), F.lit(0.0))).alias("left"),
        (F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))).alias("weights"),
    )
    level = F.col("left") / F.col("weights")  # per weight, if this source and all after it do not stop
    goes_on = F.struct("rank", level.alias("level"))
    # The first that does not stop sets the level of itself and all after it.
    first = F.min(F.when(F.col("most") > level * F.col("weight"), goes_on)).over(whole)
    marked = summed.withColumn("first", first)
    stops = F.col("first").isNull() | (F.col("rank") < F.col("first.rank"))
    return marked.select(
        "source",
        "source_size",
        F.when(stops, F.col("most")).otherwise(F.col("first.level") * F.col("weight")).alias("target"),
    )


def permuted(k: Column, n: Column, *keys: Column) -> Column:
    """Where a keyed pseudorandom permutation of 0 .. n-1 sends k.

    A four-round Feistel network over a grid of a x b >= n cells, where a and b are about the root of
    n. A cell past n is sent on until it comes inside. Fewer than a + 1 cells lie outside, and no cell
    is met twice on the way, so ``STEPS`` suffice for certain up to n = 3,900; beyond that each step
    goes outside with a chance below 1 in 60, and a walk that is not home after all steps, which one
    in 60^64 is not, fails the query and breaks no permutation.
    """
    a = F.ceil(F.sqrt(n.cast("double")))
    b = F.ceil(n / a)

    def rounds(x: Column) -> Column:
        left, right = F.floor(x / b), x % b
        for r in range(2):
            left = (left + F.pmod(F.xxhash64(right, F.lit(2 * r), *keys), a)) % a
            right = (right + F.pmod(F.xxhash64(left, F.lit(2 * r + 1), *keys), b)) % b
        return (left * b + right).cast("bigint")

    def home(x: Column) -> Column:
        """``x``, or where the walk from it comes inside; few set out on it."""
        steps = F.sequence(F.lit(1), F.lit(STEPS))
        return F.when(x < n, x).otherwise(F.aggregate(steps, x, lambda y, _: F.when(y < n, y).otherwise(rounds(y))))

    return let(rounds(k.cast("bigint")), home)


def _sized(docs: DataFrame, id: str, text: str, source: str) -> DataFrame:
    """One row per document: id, source, size, and a hash of the text for ties."""
    return docs.select(
        F.col(id).alias("doc_id"),
        F.col(source).alias("source"),
        F.size(words(F.col(text))).cast("bigint").alias("size"),
        F.xxhash64(F.col(text)).alias("tie"),
    )


def plan(docs: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source", block: int = BLOCK, seed: int = SEED):
    """What the mix takes of each document.

    Returns two frames: ``sized``, one row per input row with ``doc_id, source, size, tie, start``
    (the place of its first word in its source), its source's ``source_size`` and ``target``, and
    ``taken``, one row per run of a document in a block that the mix takes: ``doc_id, source, tie,
    start, lo, hi`` (words of the document) and ``times``.
    """
    sized = written(_sized(docs, id, text, source))
    # Order in a source: bucket, then hash and id. The buckets keep any source's order in many tasks.
    buckets = max(1, -(-sized.count() // BUCKET_ROWS))
    spread = F.xxhash64(F.col("doc_id"), F.lit(seed))
    sized = sized.withColumns({"spread": spread, "bucket": F.pmod(spread, F.lit(buckets))})
    per_bucket = sized.groupBy("source", "bucket").agg(F.sum("size").alias("n"))
    offsets = _summed_before(per_bucket, "bucket").select("source", "bucket", F.col("before").alias("first"))
    inside = (
        Window.partitionBy("source", "bucket")
        .orderBy("spread", "doc_id", "tie", "size")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    local = sized.withColumn("start", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    same = F.col("l.source").eqNullSafe(F.col("r.source"))
    placed = local.alias("l").join(offsets.alias("r"), same & (F.col("l.bucket") == F.col("r.bucket"))).select(
        "l.doc_id", "l.source", "l.size", "l.tie", (F.col("l.start") + F.col("r.first")).alias("start")
    )
    goals = targets(per_bucket.groupBy("source").agg(F.sum("n").alias("source_size")))
    placed = (
        placed.alias("l")
        .join(goals.alias("r"), same)
        .select("l.doc_id", "l.source", "l.size", "l.tie", "l.start", "r.source_size", "r.target")
    )
    placed = written(placed)
    blocks = F.ceil(F.col("source_size") / block)
    table = written(
        goals.where("source_size > 0").select("source", blocks.alias("blocks"), (F.col("target") * blocks / F.col("source_size")).alias("mean"))
    )
    taken = _slots(table, seed)
    runs = placed.where("size > 0").select(
        "doc_id", "tie", "start", "source", "size",
        F.explode(F.sequence(F.floor(F.col("start") / block), F.floor((F.col("start") + F.col("size") - 1) / block))).alias("block"),
    )
    lo = F.greatest(F.col("block") * block - F.col("start"), F.lit(0))
    hi = F.least((F.col("block") + 1) * block - F.col("start"), F.col("size"))
    runs = runs.select("doc_id", "tie", "start", "source", "block", lo.alias("lo"), hi.alias("hi"))
    # Joined by source and number of the block: a hot source is spread over its blocks.
    hit = F.col("l.source").eqNullSafe(F.col("r.source")) & (F.col("l.block") == F.col("r.block"))
    # Taken blocks grow with the table and look small before they are made, so they are not broadcast.
    taken = runs.alias("l").join(taken.alias("r").hint("shuffle_merge"), hit).select(
        "l.doc_id", "l.source", "l.tie", "l.start", "l.lo", "l.hi", "r.times"
    )
    return placed, taken


def _summed_before(counts: DataFrame, place: str) -> DataFrame:
    """``counts`` with ``before``: the sum of ``n`` over its source's rows of a smaller ``place``.

    Summed by stretches of places and then inside each, so no source is one task.
    """
    stretch = F.floor(F.col(place) / STRETCH)
    dealt = counts.withColumn("stretch", stretch)
    earlier = Window.partitionBy("source").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    sums = dealt.groupBy("source", "stretch").agg(F.sum("n").alias("n"))
    sums = sums.select("source", "stretch", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("first"))
    inside = Window.partitionBy("source", "stretch").orderBy(place).rowsBetween(Window.unboundedPreceding, -1)
    local = dealt.withColumn("before", F.coalesce(F.sum("n").over(inside), F.lit(0)))
    same = F.col("l.source").eqNullSafe(F.col("r.source")) & (F.col("l.stretch") == F.col("r.stretch"))
    return local.alias("l").join(sums.alias("r"), same).select(
        *[F.col(f"l.{c}") for c in counts.columns], (F.col("l.before") + F.col("r.first")).alias("before")
    )


def _slots(table: DataFrame, seed: int) -> DataFrame:
    """``source, block, times`` for every block that some slot takes.

    ``table`` has a row per source: its number of ``blocks`` and the ``mean`` number of its slots.
    """
    whole = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    order = Window.orderBy(F.col("source").isNull(), F.encode(F.col("source"), "UTF-8"))
    shares = table.select(
        "*",
        F.sum("mean").over(whole).alias("slots"),
        F.coalesce(F.sum("mean").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)).alias("low"),
        F.sum("mean").over(order.rowsBetween(Window.unboundedPreceding, 0)).alias("high"),
    )
    shares = written(shares.select("source", "blocks", (F.col("low") / F.col("slots")).alias("low"), (F.col("high") / F.col("slots")).alias("high"), "slots"))
    state = shares.agg(F.max("slots"), F.count("*")).first()
    total, sources = state[0] or 0.0, state[1]
    # With many sources shards are larger, so rows of source and shard stay far fewer than slots.
    shards = max(1, -(-round(total) // max(SHARD, 16 * sources)))
    size = -(-round(total) // shards)
    # Each source's strata in a shard are an interval, so its count in a shard is the number of
    # strata inside it plus at most one draw at each end: no row per slot is made for the draw.
    stretches = F.explode(F.sequence(F.lit(0), F.lit((shards - 1) // STRETCH)))
    dealt = shares.withColumn("stretch", stretches).repartition(max(1, -(-shards * sources // TASK_SLOTS)), "source", "stretch")
    last = F.least(F.col("stretch") * STRETCH + STRETCH - 1, F.lit(shards - 1))
    drawn = dealt.withColumn("shard", F.explode(F.sequence(F.col("stretch") * STRETCH, last))).drop("stretch")

    def strata_below(edge: Column) -> Column:
        # How many of a shard's draws fall below an edge: all strata under it, and the draw of the
        # stratum that holds it if that is below.
        at = edge * size
        stratum = F.least(F.floor(at), F.lit(size))
        uniform = F.pmod(F.xxhash64(F.lit(seed), F.col("shard"), stratum), F.lit(1 << 40)) / float(1 << 40)
        return stratum + F.when((stratum < size) & (uniform < at - stratum), 1).otherwise(0)

    edge_high = F.when(F.col("high") > 1 - 1e-12, F.lit(float(1))).otherwise(F.col("high"))
    counts = drawn.select("source", "blocks", "shard", (strata_below(edge_high) - strata_below(F.col("low"))).alias("n"))
    numbered = _summed_before(counts, "shard").where("n > 0")
    # Slots are dealt to tasks before they are made: their number, not that of the rows here, says to how many.
    dealt = numbered.repartition(max(1, -(-round(total) // TASK_SLOTS)), "source", "shard")
    slots = dealt.select(
        "source", "blocks", F.explode(F.sequence(F.col("before"), F.col("before") + F.col("n") - 1)).alias("k")
    ).where(F.col("k") < F.col("blocks") * LIMIT)  # no block more often than the limit
    epoch = F.floor(F.col("k") / F.col("blocks"))
    block = permuted(F.col("k") % F.col("blocks"), F.col("blocks"), F.coalesce("source", F.lit("\u0000")), epoch, F.lit(seed))
    checked = F.when(block < F.col("blocks"), block).otherwise(F.raise_error(F.lit("permutation left its domain")))
    return slots.select("source", checked.alias("block")).groupBy("source", "block").agg(F.count("*").alias("times"))


def _same_document() -> Column:
    """``l`` and ``r`` speak of one document: in a source, no two documents with words start at one place."""
    keys = [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in ("doc_id", "source", "tie", "start")]
    return keys[0] & keys[1] & keys[2] & keys[3]


def digest(docs: DataFrame) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` of every row of the documents.

    A null text has size 0. Rows without words are returned with nothing taken. Rows that repeat an
    id count as documents of their own; identical ones take turns. An empty table gives no rows.
    """
    placed, taken = plan(docs)
    sums = taken.groupBy("doc_id", "source", "tie", "start").agg(
        F.sum((F.col("hi") - F.col("lo")) * F.col("times")).alias("taken")
    )
    same = _same_document()
    return placed.alias("l").join(sums.alias("r"), same, "left").select(
        "l.doc_id", "l.size", "l.source_size", "l.target", F.coalesce("r.taken", F.lit(0)).cast("bigint").alias("taken")
    )


def mix(docs: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The mix itself: the documents' rows, each as often as the mix takes some of it, at most ``LIMIT`` times.

    A row's text is what that round takes of the document, its words with the white space after them;
    a document that is taken whole keeps its text as it is. Other columns stay. Rows of which nothing
    is taken go, so null texts and those without words do. Rows alike in id, source and text take turns in
    the order of their other columns, as JSON; an empty table stays empty.
    """
    placed, taken = plan(docs.select(F.col(id).alias(id), F.col(text).alias(text), F.col(source).alias(source)), id, text, source)
    runs = taken.groupBy("doc_id", "source", "tie", "start").agg(
        F.sort_array(F.collect_list(F.struct("lo", "hi", "times"))).alias("runs")  # of one document
    )
    # Rows that are alike in all of id, source and text are told apart by their number.
    alike = Window.partitionBy("doc_id", "source", "tie").orderBy("start")
    numbered = placed.where("size > 0").select("doc_id", "source", "tie", "start", "size", F.row_number().over(alike).alias("nth"))
    chosen = numbered.alias("l").join(runs.alias("r"), _same_document()).select(
        F.col("l.doc_id").alias("__id"), F.col("l.source").alias("__source"), F.col("l.tie").alias("__tie"),
        F.col("l.nth").alias("__nth"), F.col("l.size").alias("__size"), F.col("r.runs").alias("__runs"),
    )
    keyed = docs.withColumns({"__key": F.xxhash64(text)})
    # Rows alike in all three are put in order by their other columns, so that a rerun takes the same.
    others = [c for c in docs.columns if c not in (id, text, source)]
    place = F.to_json(F.struct(*others)) if others else F.lit(0)
    keyed = keyed.withColumn("__row", F.row_number().over(Window.partitionBy(id, source, "__key").orderBy(place)))
    same = (
        keyed[id].eqNullSafe(F.col("__id")) & keyed[source].eqNullSafe(F.col("__source"))
        & (F.col("__key") == F.col("__tie")) & (F.col("__row") == F.col("__nth"))
    )
    most = F.array_max(F.transform("__runs", lambda r: r["times"])).cast("int")
    joined = keyed.join(chosen, same).withColumn("__round", F.explode(F.sequence(F.lit(1), most)))
    joined = joined.withColumn("__mine", F.filter("__runs", lambda r: r["times"] >= F.col("__round")))
    count = F.aggregate("__mine", F.lit(0).cast("bigint"), lambda total, r: total + r["hi"] - r["lo"])
    pieces = F.regexp_extract_all(F.col(text), F.lit(f"{WORD}{SPACE}*"), F.lit(0))
    def cut(words):
        return F.flatten(F.transform("__mine", lambda r: F.slice(words, (r["lo"] + 1).cast("int"), (r["hi"] - r["lo"]).cast("int"))))

    new = F.when(count == F.col("__size"), F.col(text)).otherwise(F.array_join(let(pieces, cut), ""))
    return joined.select(*[new.alias(c) if c == text else F.col(c) for c in docs.columns])

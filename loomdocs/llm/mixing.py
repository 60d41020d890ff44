"""Mixing sources to target weights by Pfair scheduling (operator 5, DataFrame functions only)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._spark import materialize, tasks_for

#: Share of the given weights that a source without a weight of its own gets.
LEAST_SHARE = 0.001
#: Shares are whole numbers of this unit; a lower share than FLOOR_SHARE counts as that, so that no block's window is longer than its inverse.
UNIT, FLOOR_SHARE = 10**15, 1e-6
#: Rows of a source that are ranked together.
RANK_ROWS = 2_000
#: Slots of a segment of the schedule at least, and slots whose picks are gathered at once.
SEGMENT_SLOTS, GATHERED = 2_048, 256
#: Blocks of a source that one row gives rise to.
BLOCKS_A_ROW = 10_000
#: Columns of the result; input columns of these names give way.
ADDED = ["block", "release", "deadline", "mix_slot", "mix_place"]


def _source_key(c):
    return F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("null"))


def _let(value, body):
    """body(value), with value evaluated once."""
    return F.transform(F.array(value), body)[0]


def source_table(docs: DataFrame, weights: DataFrame | None, block_rows: int, power: float) -> DataFrame:
    """One row per source: source_key, source_no, blocks, and its weight as a whole number of share units."""
    counts = docs.groupBy("source_key").agg(F.count("*").alias("n"))
    if weights is None:
        asked = counts.select("source_key", F.pow(F.col("n"), F.lit(power)).alias("weight"))
    else:
        asked = weights.select(_source_key("source").alias("source_key"), F.col("weight").cast("double").alias("weight")).groupBy("source_key").agg(F.sum("weight").alias("weight"))
    usable = (F.col("weight") > 0) & (F.col("weight") < float("inf"))  # NaN is above infinity
    every = Window.partitionBy(F.lit(0))  # a row per source
    named = counts.join(asked, "source_key", "left").withColumn("given", F.when(usable, F.col("weight")))
    largest = F.max("given").over(every)
    share = F.col("given") / largest / F.sum(F.col("given") / largest).over(every)  # no overflow
    share = F.greatest(F.coalesce(share, F.lit(LEAST_SHARE)), F.lit(FLOOR_SHARE))
    numbered = named.select("source_key", F.ceil(F.col("n") / block_rows).alias("blocks"), F.round(share * UNIT).cast("decimal(18,0)").alias("w"))
    return numbered.withColumn("source_no", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("source_key")))


def block_windows(sources: DataFrame) -> DataFrame:
    """source_no, block, release and deadline of every block.

    With every source served at its weight until its last block, S(v) slots
    have passed when a source of weight w has had v w blocks: the sum of
    min(w v, blocks) over all sources. Block j is released at floor(S(j / w))
    and due at ceil(S((j + 1) / w)), both in whole numbers.
    """
    # one row: two numbers for each source
    all_sources = sources.agg(F.collect_list(F.struct(F.col("blocks").cast("decimal(14,0)").alias("n"), "w")).alias("all_sources"))
    parts = sources.withColumn("part", F.explode(F.expr(f"sequence(0L, blocks - 1, {BLOCKS_A_ROW}L)"))).repartition(tasks_for(sources.sparkSession), "source_no", "part")
    blocks = parts.select("source_no", "w", F.explode(F.expr(f"sequence(part, least(part + {BLOCKS_A_ROW}, blocks) - 1)")).alias("block")).crossJoin(F.broadcast(all_sources))
    # those at their end by j / w count whole, the others at their weight
    passed = """aggregate(all_sources, named_struct('ended', 0BD, 'active', 0BD), (a, s) -> if(s.n * w <= {j} * s.w,
        named_struct('ended', cast(a.ended + s.n AS decimal(24,0)), 'active', a.active), named_struct('ended', a.ended, 'active', cast(a.active + s.w AS decimal(24,0)))))"""
    passed = passed.replace("0BD", "cast(0 AS decimal(24,0))")
    spans = blocks.withColumns({x: F.expr(passed.format(j=f"cast({j} AS decimal(14,0))")) for x, j in (("a", "block"), ("b", "(block + 1)"))})
    release = "cast(a.ended AS long) + (a.active * cast(block AS decimal(14,0))) div w"
    due = "(b.active * cast(block + 1 AS decimal(14,0)))"
    deadline = f"cast(b.ended AS long) + {due} div w + if({due} % w > 0, 1L, 0L)"
    return spans.select("source_no", "block", F.expr(release).alias("release"), F.expr(deadline).alias("deadline"))


def _edf(first, last, begin, blocks, ready):
    """Picks of the slots begin..last: earliest deadline first among the released blocks.

    `blocks` are sorted by release; the first `first` of them are released before
    `begin`, and `ready` are those of them that wait.
    """

    def slot(state, t):
        new = F.filter(F.slice(blocks, state["at"] + 1, state["most"]), lambda x: x["release"] <= t)

        def pick(came):
            waiting = F.concat(state["ready"], F.transform(came, lambda x: F.struct(x["deadline"], x["source_no"], x["block"], x["release"])))
            return _let(waiting, lambda held: _let(F.array_min(held), lambda x: F.struct((state["at"] + F.size(came)).alias("at"), state["most"].alias("most"), F.array_remove(held, x).alias("ready"), F.concat(state["picks"], F.array(x)).alias("picks"))))

        return _let(new, pick)

    none = F.slice(ready, 1, 0)

    def gather(state, g):
        start = F.struct(state["at"].alias("at"), state["most"].alias("most"), state["ready"].alias("ready"), none.alias("picks"))
        made = F.aggregate(F.sequence(g, F.least(g + GATHERED - 1, last)), start, slot)
        return _let(made, lambda m: F.struct(m["at"].alias("at"), m["most"].alias("most"), m["ready"].alias("ready"), F.concat(state["picks"], m["picks"]).alias("picks")))

    state = F.struct(first.alias("at"), F.col("most").alias("most"), ready.alias("ready"), none.alias("picks"))
    return F.aggregate(F.sequence(begin, last, F.lit(GATHERED).cast("long")), state, gather)["picks"]


def block_schedule(windows: DataFrame) -> DataFrame:
    """source_no, block, release, deadline and mix_slot of every block, from their windows (a written table).

    Each slot takes, of the released blocks, the one due first (ties: by
    source), which meets all deadlines, as serving every source by its share in
    every slot would. The schedule is made in segments, side by side: which
    blocks are done at a slot depends on earlier ones only through those whose
    windows reach that slot. So with segments as long as the longest window, a
    segment begun one segment early, with the right number of blocks done,
    whichever they are, has come to the one schedule when its own slots begin.
    """
    total, longest, most = windows.agg(F.count("*"), F.max(F.col("deadline") - F.col("release")), F.max("source_no")).first()
    if not total:
        return windows.withColumn("mix_slot", F.lit(0).cast("long"))
    t, last = max(SEGMENT_SLOTS, longest), total - 1
    segments = last // t
    # a segment's candidates: windows that reach into it or the one before
    dealt = windows.withColumn("segment", F.explode(F.expr(f"sequence(release div {t}, least((deadline + {t - 1}) div {t}, {segments}L))")))
    held = dealt.groupBy("segment").agg(F.sort_array(F.collect_list(F.struct("release", "deadline", "source_no", "block"))).alias("blocks"))
    # number of blocks due by the start of the segment before
    due = windows.groupBy(F.expr(f"(deadline - 1) div {t} + 2").alias("segment")).agg(F.count("*").alias("n"))
    due = held.select("segment").join(due, "segment", "full").select("segment", F.coalesce(F.sum("n").over(Window.partitionBy(F.lit(0)).orderBy("segment")), F.lit(0)).alias("due"))  # a row per segment
    begun = held.join(due, "segment").withColumns({"begin": F.greatest(F.col("segment") - 1, F.lit(0)) * t, "own": F.col("segment") * t, "last": F.least((F.col("segment") + 1) * t - 1, F.lit(last)), "most": F.lit(most)})
    begun = begun.withColumn("first", F.expr("size(filter(blocks, x -> x.release < begin))"))
    waiting = "array_sort(transform(filter(slice(blocks, 1, first), x -> x.deadline > begin), x -> named_struct('deadline', x.deadline, 'source_no', x.source_no, 'block', x.block, 'release', x.release)))"
    begun = begun.withColumn("waiting", F.expr(waiting)).withColumn("ready", F.expr("slice(waiting, cast(begin - due + 1 AS int), size(waiting))"))
    picks = begun.withColumn("picks", _edf(F.col("first"), F.col("last"), F.col("begin"), F.col("blocks"), F.col("ready")))
    picks = picks.select("own", F.posexplode(F.expr("slice(picks, cast(own - begin + 1 AS int), size(picks))")).alias("place", "x"))
    return picks.select("x.source_no", "x.block", "x.release", "x.deadline", (F.col("own") + F.col("place")).alias("mix_slot"))


def mix_sources(docs: DataFrame, weights: DataFrame | None = None, block_rows: int = 32, power: float = 0.5, id_col: str = "doc_id", source_col: str = "source") -> DataFrame:
    """Interleave the sources' blocks of rows so that each keeps to its target weight.

    `weights` has (source, weight), relative; without it a source's weight is
    its number of rows to `power`. A source's rows, in an order set by a hash of
    their id, form blocks of `block_rows` (the last may be shorter). Blocks get
    release times and deadlines from the weight and are taken earliest deadline
    first: after every slot, each active source has had its weighted share to
    within less than one block, however long the mix. Shares are whole numbers
    of 1e-15, and 1e-6 at least. When a source has no blocks left, the others go
    on with their weights among themselves, so every row has its place.

    Adds block, release and deadline (in slots of the whole mix), mix_slot (the
    block's place in the mix, gapless from 0), mix_place (row in the block) to
    the columns of docs; input columns with these names give way. Rank buckets
    have about RANK_ROWS rows whatever the source, so a source with most of the
    rows is spread over many tasks.

    Null sources form a source of their own; sources missing in `weights`, or
    with a weight of 0, null, NaN, infinite or less than 0, get LEAST_SHARE of
    the others' sum. Null ids and repeated rows are ranked like others, ties by a
    hash of the row; a text may be of any length, as rows are moved but not read.
    An empty table gives no rows. Any number of sources goes; a slot's work grows
    with it.
    """
    kept = [c for c in docs.columns if c not in ADDED]
    made = docs.select(F.struct(*docs.columns).alias("mixed_row"), _source_key(source_col).alias("source_key"), F.xxhash64(F.col(id_col)).alias("id_hash"), F.xxhash64(*docs.columns).alias("row_hash"))
    total = made.count()
    buckets = max(1, -(-total // RANK_ROWS))
    # rows with a null id share a hash: theirs is that of the row
    made = made.withColumn("id_hash", F.when(F.col("mixed_row")[id_col].isNull(), F.col("row_hash")).otherwise(F.col("id_hash"))).withColumn("rank_bucket", F.pmod(F.col("id_hash"), F.lit(buckets)))
    per = made.groupBy("source_key", "rank_bucket").agg(F.count("*").alias("rows"))
    ahead = Window.partitionBy("source_key").orderBy("rank_bucket").rowsBetween(Window.unboundedPreceding, -1)
    per = per.withColumn("rows_before", F.coalesce(F.sum("rows").over(ahead), F.lit(0)))
    sources = materialize(source_table(made, weights, block_rows, power), "sources")
    windows = materialize(block_windows(sources), "windows")
    schedule = materialize(block_schedule(windows), "slots").join(sources.select("source_no", "source_key"), "source_no")
    # A rank bucket gets the slots of its blocks as one array, so rows move only once.
    held = per.withColumn("block", F.explode(F.expr(f"sequence(rows_before div {block_rows}, (rows_before + rows - 1) div {block_rows})")))
    held = held.join(schedule, ["source_key", "block"]).groupBy("source_key", "rank_bucket").agg(F.first("rows_before").alias("rows_before"), F.sort_array(F.collect_list(F.struct("block", "release", "deadline", "mix_slot"))).alias("held"))
    inside = Window.partitionBy("source_key", "rank_bucket").orderBy("id_hash", F.col("mixed_row")[id_col], "row_hash")
    ranked = made.withColumn("own", F.row_number().over(inside)).join(held, ["source_key", "rank_bucket"]).withColumn("rank", F.col("rows_before") + F.col("own") - 1)
    ranked = ranked.withColumn("x", F.expr(f"held[cast(rank div {block_rows} - held[0].block as int)]")).withColumn("mix_place", F.col("rank") % block_rows)
    return ranked.select(*[F.col("mixed_row")[c].alias(c) for c in kept], "x.block", "x.release", "x.deadline", "x.mix_slot", "mix_place")


def in_mix_order(mixed: DataFrame) -> DataFrame:
    """The rows in the order of the mix: files written from it follow each other in that order."""
    return mixed.repartitionByRange(tasks_for(mixed.sparkSession), "mix_slot", "mix_place").sortWithinPartitions("mix_slot", "mix_place")

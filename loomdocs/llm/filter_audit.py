"""Audit of filters applied in every order, by Lehmer-rank difference arrays (operator 11)."""

from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Filters whose orders can be audited: 7 have 5,040 orders.
MOST_FILTERS = 7
#: White space between words, and what keeps only A-Z.
_SPACE, _NOT_UPPER, _SIGNS = r"[\x20\x09-\x0D]+", "[^A-Z]+", "[#$%&*|]"
#: What is counted of the documents of a part and mask.
COUNTS = ["n", "good", "toxic"]


def removal_intervals(n_filters: int) -> list[tuple[int, int, int, int, int]]:
    """(mask, step, filter, first, end): in orders ranked first to end - 1 a document that fails `mask` goes at `step` by `filter`.

    Orders are ranked lexicographically, by their Lehmer code. The orders that
    begin with some filters outside the mask and then one of the mask have
    neighbouring ranks, one for each order of the rest.
    """
    weights = [factorial(n_filters - 1 - i) for i in range(n_filters)]

    def rank(prefix: tuple[int, ...]) -> int:
        return sum((x - sum(y < x for y in prefix[:i])) * weights[i] for i, x in enumerate(prefix))

    out = []
    for step in range(1, n_filters + 1):
        for prefix in permutations(range(n_filters), step):
            passed, last = sum(1 << x for x in prefix[:-1]), prefix[-1]
            first = rank(prefix)
            out += [(mask, step, last, first, first + weights[step - 1]) for mask in range(1 << n_filters) if not mask & passed and mask >> last & 1]
    return out


def audit_orders(cells: DataFrame, letters: str = "ABCDE") -> DataFrame:
    """What every filter removes at every step of every order, from counts by part and mask of failed filters.

    cells: part, mask (bit i: fails letter i), n, good, toxic; several rows of a
    part and mask add up. Returns part, filter_order, step, kept, removed,
    redundant, unique_fails, good_lost, toxic_lost, shapley; a row for each
    part, order and step, zeros included.

    A cell's counts are added where an interval of orders begins and taken off
    where it ends; a running sum over the ranks gives each order's removals. So
    a cell makes two rows per interval, however many orders that holds. Sums
    run within a part and step over the ranks, and within a part and order over
    the steps: windows of a fixed size. No parts give no rows.
    """
    k = len(letters)
    if not 1 <= k <= MOST_FILTERS or len(set(letters)) != k or letters != "".join(sorted(letters)):
        raise ValueError(f"letters: 1 to {MOST_FILTERS} different letters in ascending order")
    spark = cells.sparkSession
    orders = factorial(k)
    cells = cells.groupBy("part", "mask").agg(*[F.sum(c).alias(c) for c in COUNTS])
    # fixed tables: their size depends on the number of filters only
    intervals = spark.createDataFrame(removal_intervals(k), "mask int, step int, letter int, first int, end int")
    names = spark.createDataFrame(list(enumerate("".join(p) for p in permutations(letters))), "rank int, filter_order string")

    ends = F.explode(F.array(F.struct(F.col("first").alias("rank"), F.lit(1).alias("sign")), F.struct(F.col("end").alias("rank"), F.lit(-1).alias("sign"))))
    deltas = cells.join(F.broadcast(intervals), "mask").select("part", "step", *COUNTS, ends.alias("edge")).where(F.col("edge.rank") < orders)
    deltas = deltas.select("part", "step", "edge.rank", *[(F.col(c) * F.col("edge.sign")).alias(c) for c in COUNTS])
    parts = cells.groupBy("part").agg(
        F.sum("n").alias("total"),
        F.array([F.sum(F.when(F.col("mask").bitwiseAND(1 << i) != 0, F.col("n")).otherwise(0)) for i in range(k)]).alias("fails"),
        F.array([F.sum(F.when(F.col("mask") == 1 << i, F.col("n")).otherwise(0)) for i in range(k)]).alias("alone"),
    )
    every = parts.select("part", F.explode(F.sequence(F.lit(1), F.lit(k))).alias("step")).select("part", "step", F.explode(F.sequence(F.lit(0), F.lit(orders - 1))).alias("rank"), *[F.lit(0).cast("long").alias(c) for c in COUNTS])
    edges = deltas.unionByName(every).groupBy("part", "step", "rank").agg(*[F.sum(c).alias(c) for c in COUNTS])
    ranks = Window.partitionBy("part", "step").orderBy("rank")
    gone = edges.select("part", "step", "rank", *[F.sum(c).over(ranks).alias(c) for c in COUNTS])

    steps = Window.partitionBy("part", "rank").orderBy("step")
    named = gone.withColumn("so_far", F.sum("n").over(steps)).join(F.broadcast(names), "rank").join(parts, "part")
    letter = F.expr(f"instr('{letters}', substring(filter_order, step, 1))")
    named = named.withColumn("letter", letter)
    return named.select(
        "part",
        "filter_order",
        "step",
        (F.col("total") - F.col("so_far")).alias("kept"),
        F.col("n").alias("removed"),
        (F.element_at("fails", F.col("letter")) - F.col("n")).alias("redundant"),
        F.element_at("alone", F.col("letter")).alias("unique_fails"),
        F.col("good").alias("good_lost"),
        F.col("toxic").alias("toxic_lost"),
        F.sum("n").over(Window.partitionBy("part", "letter")).alias("shapley"),
    )


def text_filters(text: Column) -> list[Column]:
    """Conditions A to D of a text's words and characters, as columns over `words` (array) and the text."""
    n_words, chars = F.size("words"), F.length(text)
    return [
        n_words < 100,
        100 * F.size(F.array_distinct("words")) < 80 * n_words,
        100 * F.length(F.regexp_replace(text, _NOT_UPPER, "")) > 10 * chars,
        text.rlike(_SIGNS),
    ]


def document_cells(docs: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """part, mask, n, good, toxic: documents counted by part, failed filters and labels.

    Filters, as bits from 0: A under 100 words; B fewer than 80 distinct of 100
    words; C more than 10 % of the code points are A-Z; D a sign of #$%&*|; E the
    text equals that of a smaller doc_id, in the whole table.

    Each text is read once and gives four bits and a SHA-256; texts aren't
    shuffled. Equal texts are counted by part, bits and labels, with the least
    id and its number of rows, before they meet: a frequent text is a few rows
    then, and all but the rows of its least id fail E.

    Null texts are empty, and equal to empty ones; null parts are the empty
    string. A null doc_id is above all others: such a row fails E if a row with
    an id has its text. Rows that repeat a doc_id are documents of their own,
    and don't fail E for each other. Labels of one doc_id are taken together; a
    null label is 0, and rows without a doc_id have none. A very long text is split as a whole in its task. Other
    columns are ignored.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), text.alias("text"))
    rows = rows.withColumn("words", F.array_remove(F.split("text", _SPACE), ""))
    bits = sum((F.when(c, 1 << i).otherwise(0) for i, c in enumerate(text_filters(F.col("text")))), F.lit(0))
    rows = rows.select("doc_id", "part", bits.alias("bits"), F.unhex(F.sha2("text", 256)).alias("text_key"))
    one = lambda c: F.max(F.when(F.col(c) == 1, 1).otherwise(0))
    judged = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(one("quality").alias("good"), one("toxic").alias("toxic"))
    kinds = ["text_key", "part", "bits", "good", "toxic"]
    rows = rows.join(judged, "doc_id", "left").fillna(0, ["good", "toxic"]).groupBy(*kinds, "doc_id").agg(F.count("*").alias("n"))
    equal = rows.groupBy(*kinds).agg(F.sum("n").alias("n"), F.min("doc_id").alias("least"), F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n"))).getField("n").alias("n_least"))
    first = F.min("least").over(Window.partitionBy("text_key"))
    equal = equal.withColumn("first", first)
    # rows of the least id of all equal texts pass E; all rows do if no id is given
    passing = F.when(F.col("first").isNull(), F.col("n")).when(F.col("least") == F.col("first"), F.col("n_least")).otherwise(0)
    two = F.explode(F.array(F.struct(F.col("bits").alias("mask"), passing.alias("count")), F.struct((F.col("bits") + 16).alias("mask"), (F.col("n") - passing).alias("count"))))
    split = equal.select("part", "good", "toxic", two.alias("x")).where("x.count > 0").select("part", F.col("x.mask").alias("mask"), F.col("x.count").alias("n"), "good", "toxic")
    return split.groupBy("part", "mask").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("good")).alias("good"), F.sum(F.col("n") * F.col("toxic")).alias("toxic"))


def filter_audit(docs: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """audit_orders of the five filters of document_cells; an empty table gives no rows."""
    return audit_orders(document_cells(docs, labels, part))

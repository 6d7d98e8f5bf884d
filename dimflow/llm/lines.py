"""Repeated runs of lines, found with suffix ranks by prefix doubling and deleted but for their first copy.

Only DataFrame operations. The lines of all documents form one sequence of line ids. Suffixes are ranked by their first
line, then by their first 2, 4, 8, ... lines: two ranks of one round make the rank of the next, and a suffix leaves as soon
as its prefix is there once only. Equal ranks of prefixes of m lines are an interval of the suffix array in which the longest
common prefix is at least m. A run counts from ``min_words`` words on, so the intervals asked for are those of the shortest
stretches of so many words from each line on and up to each line: every run that counts is covered by such stretches, and
they are its only part that needs looking up. The first stretch of an interval stays, the lines of the others go.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dimflow.llm.common import attach, stored

MIN_WORDS = 10
BUCKETS = 1024


def _split(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def _running(classes: DataFrame, group: str, order: str, bucket: Column) -> DataFrame:
    """``classes`` with ``_before``: the rows ``n`` of the classes before each in its group, by ``order``.

    Sums run inside buckets of the order and over the buckets, so no task holds a large group.
    """
    classes = classes.withColumn("_bucket", bucket)
    before = (Window.unboundedPreceding, -1)
    inside = F.sum("n").over(Window.partitionBy(group, "_bucket").orderBy(order).rowsBetween(*before))
    sums = classes.groupBy(group, "_bucket").agg(F.sum("n").alias("_n"))
    above = F.sum("_n").over(Window.partitionBy(group).orderBy("_bucket").rowsBetween(*before))
    sums = sums.select(group, "_bucket", F.coalesce(above, F.lit(0)).alias("_above"))
    return (classes.withColumn("_inside", F.coalesce(inside, F.lit(0))).join(sums, [group, "_bucket"])
            .withColumn("_before", F.col("_above") + F.col("_inside")).drop("_bucket", "_inside", "_above"))


def _positions(docs: DataFrame) -> DataFrame:
    """Stored lines that are not blank: doc_id, th, n (place in the text), p (place among all lines), line, words.

    ``p`` ascends with doc_id and is gapless inside a document. Of rows alike in doc_id and text one is taken.
    """
    raw = stored(docs.select("doc_id", "text", F.xxhash64("text").alias("th"), F.monotonically_increasing_id().alias("u"))
                 .select("doc_id", "th", "u", F.posexplode(_split(F.col("text"))).alias("n", "_line"))
                 .filter(F.trim("_line") != "")
                 .select("doc_id", "th", "u", "n", F.unhex(F.md5("_line")).alias("line"),
                         (F.length("_line") - F.length(F.replace("_line", F.lit(" "), F.lit(""))) + 1).alias("words")),
                 "lines-raw")
    twice = raw.groupBy("doc_id", "th").agg(F.min("u").alias("_u"), F.max("u").alias("_v")).filter("_u < _v")
    twice = stored(twice.select(F.col("doc_id").alias("_d"), F.col("th").alias("_t"), "_u"), "lines-twice")
    if not twice.isEmpty():
        later = F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("th") == F.col("_t")) & (F.col("u") > F.col("_u"))
        raw = raw.join(twice, later, "left_anti")
    return stored(raw.repartitionByRange("doc_id", "th").sortWithinPartitions("doc_id", "th", "n")
                  .select("doc_id", "th", "n", F.monotonically_increasing_id().alias("p"), "line", "words"), "lines")


def _first_ranks(lines: DataFrame) -> DataFrame | None:
    """Lines that occur more than once: p, run, words, r. A run is a gapless stretch of such lines in a document."""
    repeated = stored(lines.groupBy("line").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "lines-repeated")
    if repeated.isEmpty():
        return None
    bucket = F.conv(F.hex(F.substring("line", 1, 2)), 16, 10).cast("int") % BUCKETS
    # ordered by bucket and then by line id: any fixed order of the ids will do
    ranks = stored(_running(repeated.withColumn("_all", F.lit(0)), "_all", "line", bucket)
                   .select("line", F.col("n").alias("_copies"), (F.col("_before") + 1).alias("r")), "lines-ranks")
    there = attach(lines, ranks, "line", "_copies")
    place = F.row_number().over(Window.partitionBy("doc_id", "th").orderBy("p"))
    return stored(there.select("p", "words", "r", (F.col("p") - place).alias("_gap"), "doc_id", "th")
                  .withColumn("run", F.min("p").over(Window.partitionBy("doc_id", "th", "_gap")))
                  .select("p", "run", "words", "r"), "lines-rank0")


def _stretches(lines: DataFrame, min_words: int) -> DataFrame:
    """p, m: the shortest stretches of ``m`` lines with ``min_words`` words from each line on, and up to each line."""
    total = F.sum("words").over(Window.partitionBy("run").orderBy("p").rowsBetween(Window.unboundedPreceding, 0))
    sums = lines.select("run", "p", "words", total.alias("c"))
    # line b ends a stretch that a begins if the words before a, and min_words more, are no more than those up to b
    events = sums.select("run", "p", F.explode(F.array(
        F.struct((F.col("c") - F.col("words") + min_words).alias("key"), F.lit(0).alias("end")),
        F.struct(F.col("c").alias("key"), F.lit(1).alias("end")))).alias("e")).select("run", "p", "e.key", "e.end")
    up = Window.partitionBy("run").orderBy("key", "end", "p")
    down = Window.partitionBy("run").orderBy(F.desc("key"), F.desc("end"), F.desc("p"))
    found = events.select("p", "end", F.max(F.when(F.col("end") == 0, F.col("p"))).over(up).alias("_a"),
                          F.min(F.when(F.col("end") == 1, F.col("p"))).over(down).alias("_b"))
    begin = F.when(F.col("end") == 0, F.col("p")).otherwise(F.col("_a"))
    last = F.when(F.col("end") == 0, F.col("_b")).otherwise(F.col("p"))
    return (found.select(begin.alias("p"), (last - begin + 1).cast("int").alias("m")).filter("p IS NOT NULL AND m IS NOT NULL")
            .distinct())


def _doubled(ranks: DataFrame, length: int, top: int) -> DataFrame:
    """Ranks of prefixes of 2 x ``length`` lines from those of ``length``; ``top`` is above all ranks."""
    ahead = ranks.select((F.col("p") - length).alias("p"), "run", F.col("r").alias("r2"))
    pairs = stored(ranks.join(ahead, ["p", "run"]).select("p", "run", F.struct("r", "r2").alias("pair")), "lines-pairs")
    classes = pairs.groupBy("pair").agg(F.count(F.lit(1)).alias("n")).select("pair", "pair.r", "pair.r2", "n")
    width = max(1, top // BUCKETS)
    ranked = stored(_running(classes, "r", "r2", F.floor(F.col("r2") / width)).filter("n > 1")
                    .select("pair", "n", (F.col("r") + F.col("_before")).alias("r")), "lines-classes")
    return stored(attach(pairs, ranked, "pair", "n").select("p", "run", "r"), "lines-rank")


def repeated_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame | None:
    """doc_id, th, n of the lines to delete: those in a run of ``min_words`` words or more that also begins earlier."""
    lines = _positions(docs)
    ranks = _first_ranks(lines)
    if ranks is None:
        return None
    wanted = stored(_stretches(ranks, min_words), "lines-stretches")
    longest, top = wanted.agg(F.max("m")).first()[0], (ranks.agg(F.max("r")).first()[0] or 0) + 1
    if longest is None:
        return None
    ranks, length, gone = ranks.select("p", "run", "r"), 1, None
    while True:
        own = wanted.filter((F.col("m") >= length) & (F.col("m") < 2 * length))
        head = ranks.select("p", F.col("r").alias("_head"))
        tail = ranks.select(F.col("p").alias("_q"), F.col("r").alias("_tail"))
        # a stretch of m lines is named by the ranks of its first and of its last 2^k lines
        named = stored(own.join(head, "p").withColumn("_q", F.col("p") + F.col("m") - length).join(tail, "_q")
                       .select("p", "m", F.struct("m", "_head", "_tail").alias("name")), "lines-named")
        first = stored(named.groupBy("name").agg(F.min("p").alias("_first"), F.count(F.lit(1)).alias("n")).filter("n > 1"),
                       "lines-intervals")
        later = attach(named, first, "name", "n").filter("p > _first").select(
            F.explode(F.sequence("p", F.col("p") + F.col("m") - 1)).alias("p"))
        gone = later if gone is None else gone.unionByName(later)
        if 2 * length > longest:
            break
        ranks, length = _doubled(ranks, length, top), 2 * length
    return lines.join(gone.distinct(), "p", "left_semi").select("doc_id", "th", "n")


def without_repeated_runs(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with repeated runs of lines deleted from ``text``, and ``n_lines`` and ``n_removed`` added.

    A line goes if it lies in a run of lines of one document with at least ``min_words`` words (a line's spaces and one)
    that also occurs, line by line the same, at an earlier place: in a document with a smaller doc_id (NULL first), or
    further up. So every line keeps its first copy. Blank lines are passed over and stay. NULL text stays NULL with no
    lines; rows alike in doc_id and text count once and come out alike. Columns of the result's own names are replaced.
    """
    docs = docs.drop("n_lines", "n_removed")
    found = repeated_lines(docs, min_words)
    lines = F.when(F.col("text").isNotNull(), F.size(_split(F.col("text")))).otherwise(0).cast("long")
    if found is None:
        return docs.withColumn("n_lines", lines).withColumn("n_removed", F.lit(0).cast("long"))
    place = F.row_number().over(Window.partitionBy("doc_id", "th").orderBy("n"))
    ranges = (found.withColumn("_gap", F.col("n") - place).groupBy("doc_id", "th", "_gap")
              .agg(F.min("n").alias("lo"), F.max("n").alias("hi"))
              .groupBy(F.col("doc_id").alias("_d"), F.col("th").alias("_t"))
              .agg(F.collect_list(F.struct("lo", "hi")).alias("_ranges"), F.sum(F.col("hi") - F.col("lo") + 1).alias("_n")))
    ranges = stored(ranges, "lines-ranges")
    left = F.filter(_split(F.col("text")), lambda line, i: ~F.exists("_ranges", lambda r: (i >= r["lo"]) & (i <= r["hi"])))
    text = F.when(F.col("_ranges").isNull(), F.col("text")).otherwise(F.array_join(left, "\n"))
    joined = docs.join(ranges, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.xxhash64("text") == F.col("_t")), "left")
    return joined.select(*[text.alias("text") if c == "text" else F.col(f"`{c}`") for c in docs.columns],
                         lines.alias("n_lines"), F.coalesce("_n", F.lit(0)).cast("long").alias("n_removed"))

"""Mixing sources to target weights by Pareto order sampling (DataFrame functions only).

A source's target over its size is the number of copies that each of its documents should have. The whole part
is certain; the fraction is the inclusion probability of one copy more. Documents are ranked by their
random odds over their inclusion odds, and the extra copies go down that rank until the source's
words are full: a sample of fixed size, counted in words. The document at the end of the sample
gives only the words that are still missing.

Nothing is ranked as a whole: a source's rank values are counted in ``BUCKETS`` ranges, the range
that holds the end is counted in as many again, and only documents of that small range are
ordered. So a source with a third of all documents costs each task what others cost.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from touchline.llm.tables import stored, whole

WORD = r"[^\x20\x09-\x0D]+"
BUCKETS = 4096
SALTS = 16
SMALL = 32 << 20  # bytes of a source table that may be broadcast


def odds(p: Column) -> Column:
    return p / (F.lit(1.0) - p)


def sized(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """doc_id, source, key (tells equal rows), size, u (its random number in (0, 1)) and row."""
    text = whole(text_col)
    digest = F.md5(F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit("|"), F.md5(text)))
    number = F.conv(F.substring("key", 1, 13), 16, 10).cast("long")
    return (docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), digest.alias("key"),
                        F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"))
            .withColumn("u", (number + F.lit(0.5)) / F.lit(float(1 << 52)))
            .withColumn("part", F.spark_partition_id())
            .withColumn("row", F.monotonically_increasing_id()))


def numbered(sources: DataFrame) -> DataFrame:
    """Sources with their place (from 0) by code point, null last.

    The order is spread over partitions: a row's place is its place in its partition behind the
    rows of the partitions before it.
    """
    ordered = stored(sources.orderBy(F.col("source").asc_nulls_last())
                     .withColumn("at", F.monotonically_increasing_id()), "mix-sources")
    part = F.shiftright("at", 33)
    before = (ordered.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"))
              .withColumn("before", F.coalesce(F.sum("n").over(
                  Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
              .drop("n"))
    return (ordered.withColumn("part", part).join(before, "part")
            .withColumn("place", F.col("at") - F.shiftleft(F.col("part"), 33) + F.col("before"))
            .drop("part", "at", "before"))


def targets(sources: DataFrame, weights: tuple[int, ...], share: float, most: float) -> DataFrame:
    """Sources (source, words) with place, weight and target: ``share`` of all words by weight, at most
    ``most`` times a source's own, the excess shared again among the others until none is above."""
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int"))
    rows = stored(numbered(sources).withColumn("weight", weight), "mix-weights")
    cap = F.col("words") * F.lit(most)
    level, stopped = 0.0, -1
    while True:
        above = F.lit(level) * F.col("weight") > cap if stopped >= 0 else F.lit(False)
        # One row: the words of stopped sources, the weight of the others, all words.
        r = rows.agg(F.sum(F.when(above, cap)).alias("held"), F.sum(F.when(~above, F.col("weight"))).alias("open"),
                     F.count(F.when(above, 1)).alias("stopped"), F.sum("words").alias("words")).first()
        if r["stopped"] == stopped or not r["open"]:
            break
        stopped = r["stopped"]
        level = (share * r["words"] - (r["held"] or 0.0)) / r["open"]
    return rows.withColumn("target", F.least(F.lit(level) * F.col("weight"), cap))


def looked_up(rows: DataFrame, table: DataFrame, name: str) -> DataFrame:
    """``rows`` with the columns of ``table``, at most one row per source in it, joined by source (null
    meets null). A table of at most ``SMALL`` bytes is broadcast; otherwise both sides are salted."""
    table = stored(table.withColumnRenamed("source", "its_source"), name)
    match = F.col("source").eqNullSafe(F.col("its_source"))
    n = table.agg(F.sum(F.coalesce(F.octet_length("its_source"), F.lit(0)) + 16 * len(table.columns))).first()[0]
    if (n or 0) <= SMALL:
        return rows.join(F.broadcast(table), match, "left").drop("its_source")
    salt = F.pmod(F.xxhash64("row"), F.lit(SALTS)).cast("int")
    spread = table.withColumn("its_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return (rows.withColumn("salt", salt).join(spread, match & (F.col("salt") == F.col("its_salt")), "left")
            .drop("salt", "its_salt", "its_source"))


def end_of(counts: DataFrame, order: list[str], left: str, measure: str) -> DataFrame:
    """Per source the first of its rows, in ``order``, with which ``measure`` exceeds ``left`` in sum:
    its columns, and ``left`` without what the rows before it use."""
    up_to = F.sum(measure).over(Window.partitionBy("source").orderBy(*order)
                                .rowsBetween(Window.unboundedPreceding, 0))
    found = counts.withColumn("up_to", up_to).where(F.col("up_to") > F.col(left))
    names = [c for c in found.columns if c != "source"]
    return (found.groupBy("source").agg(F.min(F.struct(*order, *[c for c in names if c not in order])).alias("e"))
            .select("source", *[F.col(f"e.{c}").alias(c) for c in names])
            .withColumn(left, F.col(left) - (F.col("up_to") - F.col(measure))).drop("up_to"))


def mix(docs: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0,
        id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """Per row of ``docs``: doc_id, size, source_size, target, taken (and source).

    Defined cases: a null text has size 0 and a null source is a source of its own, after all
    others; a null id draws its random number from the text alone. Rows that repeat id, text and
    source share one rank: where the sample ends among them, some take the extra copy, one a part.
    Documents without words, and sources without, take 0 (target 0). An empty table gives no rows.
    The random numbers come from a digest of id and text, so every run takes the same words.
    """
    rows = stored(sized(docs, id_col, text_col, source_col), "mix-sizes")
    sources = targets(rows.groupBy("source").agg(F.sum("size").alias("words")), weights, share, most)
    certain = F.when(F.col("words") > 0, F.floor(F.col("target") / F.col("words"))).otherwise(F.lit(0)).cast("long")
    sources = (sources.withColumn("certain", certain)
               .withColumn("fraction", F.when(F.col("words") > 0, F.col("target") / F.col("words") - certain)
                           .otherwise(F.lit(0.0)))
               .withColumn("left", F.round("target").cast("long") - F.col("certain") * F.col("words")))
    per_source = sources.select("source", F.col("words").alias("source_size"), "target", "certain", "fraction", "left")
    drawn = looked_up(rows, per_source, "mix-targets")
    # Random odds over inclusion odds, brought to (0, 1) by a rising map with most documents evenly spread.
    ratio = odds(F.col("u")) / odds(F.col("fraction"))
    even = ratio * odds(F.col("fraction"))
    ranked = stored(drawn.withColumn("rank", F.when((F.col("fraction") > 0) & (F.col("size") > 0), ratio))
                    .withColumn("at", F.when(F.col("rank").isNotNull(), even / (1 + even)) * F.lit(float(BUCKETS)))
                    .withColumn("b1", F.least(F.floor("at"), F.lit(BUCKETS - 1)).cast("int"))
                    .withColumn("b2", F.least(F.floor((F.col("at") - F.col("b1")) * F.lit(float(BUCKETS))),
                                              F.lit(BUCKETS - 1)).cast("int")), "mix-ranked")
    some = ranked.where(F.col("rank").isNotNull())
    first = end_of(some.groupBy("source", "b1").agg(F.sum("size").alias("n"), F.first("left").alias("left")),
                   ["b1"], "left", "n").select("source", F.col("b1").alias("e1"), F.col("left").alias("l1"))
    inside = looked_up(some, first, "mix-ends-1").where("b1 = e1")
    second = end_of(inside.groupBy("source", "b2").agg(F.sum("size").alias("n"), F.first("l1").alias("left"),
                                                       F.first("e1").alias("e1")),
                    ["b2"], "left", "n").select("source", "e1", F.col("b2").alias("e2"), F.col("left").alias("l2"))
    inside = looked_up(some, second, "mix-ends-2").where("b1 = e1 and b2 = e2")
    last = end_of(inside.groupBy("source", "rank", "key").agg(
        F.sum("size").alias("n"), F.first("l2").alias("left"), F.first("e1").alias("e1"), F.first("e2").alias("e2"),
        F.count(F.lit(1)).alias("equal")), ["rank", "key"], "left", "n").select(
        "source", "e1", "e2", F.col("rank").alias("e3"), F.col("key").alias("end_key"),
        F.col("left").alias("end_left"), "equal")
    marked = looked_up(ranked, last, "mix-ends")
    here, end = (F.struct(*c) for c in (("b1", "b2", "rank", "key"), ("e1", "e2", "e3", "end_key")))
    # Without an end the whole source fits; rows without rank take no extra copy.
    extra = (F.when(F.col("rank").isNull(), F.lit(0)).when(F.col("e1").isNull() | (here < end), F.col("size"))
             .when(here > end, F.lit(0)))
    marked = marked.withColumn("extra", extra).withColumn("nth", F.lit(0).cast("long"))
    alone = F.coalesce(F.col("equal") == 1, F.lit(True)) | F.col("extra").isNotNull()
    rest = marked.where(~alone)
    rest = _nth_equal(rest)
    both = marked.where(alone).unionByName(rest)
    partial = F.greatest(F.lit(0), F.least(F.col("size"), F.col("end_left") - F.col("nth") * F.col("size")))
    return both.select("doc_id", "source", "size", "source_size", "target",
                       (F.col("certain") * F.col("size") + F.coalesce("extra", partial)).alias("taken"))


def _nth_equal(rows: DataFrame) -> DataFrame:
    """Number (nth, from 0) the rows of a source that are equal, first within the parts of the stored
    table, so that no task sees all of them."""
    inner = F.row_number().over(Window.partitionBy("source", "part").orderBy("row")) - 1
    before = (rows.groupBy("source", "part").agg(F.count(F.lit(1)).alias("n"))
              .withColumn("before", F.coalesce(F.sum("n").over(Window.partitionBy("source").orderBy("part").rowsBetween(
                  Window.unboundedPreceding, -1)), F.lit(0)))
              .select(F.col("source").alias("s"), F.col("part").alias("p"), "before"))
    return (rows.withColumn("nth", inner).join(before, F.col("source").eqNullSafe(F.col("s"))
                                               & (F.col("part") == F.col("p")))
            .withColumn("nth", F.col("nth") + F.col("before")).drop("s", "p", "before"))


ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5(coalesce(doc_id::VARCHAR, '') || '|' || md5(coalesce(text, ''))) AS key FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS words FROM d GROUP BY source),
w AS (SELECT source, words, 2.0::DOUBLE * words AS cap,
             [3, 1, 2][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight FROM s),
-- the level at which sources stop: those with the smallest cap per weight stop first
c AS (SELECT *, coalesce(sum(cap) OVER before, 0) AS held, sum(weight) OVER after AS open,
             1.5::DOUBLE * sum(words) OVER () AS total FROM w
      WINDOW before AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
             after AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
l AS (SELECT max((total - held) / open) AS level FROM c WHERE (total - held) / open * weight <= cap),
t AS (SELECT source, words, least(level * weight, cap) AS target FROM w, l),
f AS (SELECT *, CASE WHEN words > 0 THEN floor(target / words) ELSE 0 END AS certain,
             CASE WHEN words > 0 THEN target / words - floor(target / words) ELSE 0 END AS fraction FROM t),
q AS (SELECT d.doc_id, d.source, d.size, d.key, words AS source_size, target, certain::BIGINT AS certain,
             round(target)::BIGINT - certain::BIGINT * words AS "left",
             CASE WHEN fraction > 0 AND d.size > 0 THEN (u / (1 - u)) / (fraction / (1 - fraction)) END AS rank
      FROM (SELECT *, (('0x' || substr(key, 1, 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496::DOUBLE AS u FROM d) d
      JOIN f ON d.source IS NOT DISTINCT FROM f.source),
b AS (SELECT *, CASE WHEN rank IS NULL THEN 0 ELSE coalesce(sum(size) OVER (
        PARTITION BY source, rank IS NULL ORDER BY rank, key, doc_id
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) END AS before FROM q)
SELECT doc_id, source, size, source_size, target,
       (certain * size + CASE WHEN rank IS NULL THEN 0
                              ELSE greatest(0, least(size, "left" - before)) END)::BIGINT AS taken
FROM b
"""

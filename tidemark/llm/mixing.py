"""Mix sources to target weights: hash-random order, distributed prefix sums, exact budgets.

Everything here is DataFrame and SQL functions. Each document gets a key that looks random and
never changes; the documents of a source are dealt to ranges of that key, the sizes are summed
per range, running sums over the ranges give each range its offset, and a running sum inside
each range finishes the prefix sums. A source with a third of all rows is many ranges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import fresh, stage, text_or_empty, word_count

#: Documents in a key range, on average.
RANGE_DOCUMENTS = 1024
#: No document and no source is taken more often.
MOST_EPOCHS = 3
#: Weights of the sources in code-point order, repeating; a null source comes last.
WEIGHTS = (1, 2, 3)

_KEY = "md5(concat(coalesce(cast(doc_id AS string), ''), '/mix'))"


def source_targets(sizes: DataFrame) -> DataFrame:
    """One row per source: ``source, source_docs, source_size, target``.

    Targets share the total size by weight. A target stops at ``MOST_EPOCHS`` times the size of
    its source, and what is over is shared again by weight until none is above. In the order of
    size per weight, a source is capped exactly when its cap is below its share of what the
    sources before it have left, so running sums over the sources find all caps at once.
    """
    by_source = sizes.groupBy("source").agg(
        F.count(F.lit(1)).alias("source_docs"), F.sum("size").alias("source_size")
    )
    in_order = Window.orderBy(F.col("source").asc_nulls_last())
    everything = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    position = (F.row_number().over(in_order) - 1) % len(WEIGHTS)
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (position + 1).cast("int")).cast("long")
    weighted = by_source.select(
        "*",
        weight.alias("weight"),
        (F.col("source_size") * MOST_EPOCHS).alias("cap"),
        F.sum("source_size").over(everything).alias("total"),
    )
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    left = F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0))
    from_here = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    judged = weighted.select(
        "*", left.alias("left"), F.sum("weight").over(from_here).alias("weight_left")
    ).withColumn("capped", F.col("cap") * F.col("weight_left") < F.col("weight") * F.col("left"))
    open_left = F.col("total") - F.coalesce(F.sum(F.when(F.col("capped"), F.col("cap"))).over(everything), F.lit(0))
    open_weight = F.sum(F.when(~F.col("capped"), F.col("weight"))).over(everything)
    share = (open_left * F.col("weight")).cast("double") / open_weight
    target = F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(share)
    return judged.select("source", "source_docs", "source_size", F.coalesce(target, F.lit(0.0)).alias("target"))


def mix(docs: DataFrame, *, text: str = "text") -> DataFrame:
    """``doc_id, source, size, source_size, target, taken`` for every document.

    ``size`` is the number of words of the whole text (null: 0). ``taken`` counts the words the
    mix takes of a document, repeats included: the whole epochs of its source, and of the last
    epoch what lies below the source's budget in the order of the keys, so each source takes its
    target rounded down, and a document at the cut is taken in part. Documents are told apart by
    ``doc_id``; a repeated row is one more document at the same place of the order and takes its own share.
    An empty table gives an empty result; a source without words has target 0. Columns other
    than ``doc_id``, ``source`` and the text are not read.
    """
    sizes = stage(_sized(docs, text), "sizes")
    return _taken(sizes, sizes).select("doc_id", "source", "size", "source_size", "target", "taken")


def _sized(docs: DataFrame, text: str, *carried: Column) -> DataFrame:
    return docs.select(
        "doc_id",
        "source",
        word_count(F.col(text)).alias("size"),
        F.expr(_KEY).alias("key"),
        F.xxhash64(text_or_empty(text)).alias("hash"),
        *carried,
    )


def _taken(rows: DataFrame, sizes: DataFrame) -> DataFrame:
    """``rows`` with ``source_size``, ``target`` and ``taken``; ``sizes`` are the same rows, staged."""
    targets = stage(source_targets(sizes), "targets")
    # No hint here: Spark broadcasts the source table where it measures it as small, and AQE splits
    # a hot source where not.
    ranges = F.ceil(F.col("source_docs") / RANGE_DOCUMENTS)
    place = F.conv(F.substring("key", 1, 8), 16, 10).cast("long")

    def in_ranges(part: DataFrame) -> DataFrame:
        named = targets.withColumnRenamed("source", "t_source")
        joined = part.join(named, part["source"].eqNullSafe(named["t_source"]))
        return joined.withColumn("range", F.shiftright(place * ranges, 32)).drop("t_source", "source_docs")

    ranged = in_ranges(rows)
    sums = in_ranges(sizes).groupBy("source", "range").agg(F.sum("size").alias("range_size"))
    to_here = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        F.col("source").alias("o_source"),
        F.col("range").alias("o_range"),
        F.coalesce(F.sum("range_size").over(to_here), F.lit(0)).alias("offset"),
    )
    inside = (
        Window.partitionBy("source", "range").orderBy("key", "doc_id", "size", "hash").rowsBetween(Window.unboundedPreceding, -1)
    )
    placed = ranged.join(
        offsets, ranged["source"].eqNullSafe(offsets["o_source"]) & (ranged["range"] == offsets["o_range"])
    ).withColumn("start", F.col("offset") + F.coalesce(F.sum("size").over(inside), F.lit(0)))
    budget = F.floor("target").cast("long")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    rest = budget - epochs * F.col("source_size")
    part = F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), rest - F.col("start")))
    return placed.withColumn("taken", epochs * F.col("size") + part)


def mixed_documents(docs: DataFrame, *, text: str = "text") -> DataFrame:
    """The mix itself: each taken copy of a document as a row, ``copy`` from 1, with its ``words``.

    The rows keep the columns of ``docs`` (one named ``copy`` or ``words`` as ``copy_`` or ``words_``,
    more underscores if those are taken too). ``words`` is the document's size, but for the copy at
    the budget's cut, of which the mix takes the first ``words`` words; its text stays whole.
    Documents that the mix does not take have no row. Each row carries its own share, so rows
    with one id, or without one, are told apart.
    """
    sizes = stage(_sized(docs, text), "sizes")
    whole = F.struct(*(docs[c] for c in docs.columns)).alias("whole")
    taken = _taken(_sized(docs, text, whole), sizes).where("taken > 0")
    n = F.ceil(F.col("taken") / F.greatest(F.col("size"), F.lit(1)))
    copies = taken.select("whole", "size", "taken", F.explode(F.sequence(F.lit(1).cast("long"), n)).alias("copy"))
    words = F.least(F.col("size"), F.col("taken") - (F.col("copy") - 1) * F.col("size"))
    # A document's own columns named copy or words keep their values under a name with "_" added.
    own = [F.col("whole").getField(c).alias(c if c.lower() not in ("copy", "words") else fresh(docs.select(*docs.columns, F.lit(0).alias("copy"), F.lit(0).alias("words")), c)) for c in docs.columns]
    return copies.select(*own, "copy", words.alias("words"))


#: The same rows of :func:`mix` in DuckDB.
SQL = """
WITH sizes AS (
  SELECT doc_id, source, md5(concat(coalesce(cast(doc_id AS varchar), ''), '/mix')) AS key,
   CASE WHEN text IS NULL THEN 0 ELSE len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) END::BIGINT AS size
  FROM documents),
by_source AS (
  SELECT source, sum(size)::BIGINT AS source_size, 3 * sum(size)::BIGINT AS cap,
   1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS weight
  FROM sizes GROUP BY source),
judged AS (
  SELECT *, sum(source_size) OVER ()::BIGINT AS total, cap * sum(weight) OVER later
   < weight * (sum(source_size) OVER () - coalesce(sum(cap) OVER earlier, 0)) AS capped
  FROM by_source
  WINDOW earlier AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
   later AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
targets AS (
  SELECT source, source_size, coalesce(CASE WHEN capped THEN cap::DOUBLE ELSE
   ((total - coalesce(sum(cap) FILTER (WHERE capped) OVER (), 0)::BIGINT) * weight)::DOUBLE
    / (sum(weight) FILTER (WHERE NOT capped) OVER ())::BIGINT END, 0.0) AS target
  FROM judged),
placed AS (
  SELECT s.doc_id, s.source, s.size, t.source_size, t.target, floor(t.target)::BIGINT AS budget,
   coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.key, s.doc_id, s.size
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
  FROM sizes s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
cut AS (SELECT *, CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END AS epochs FROM placed)
SELECT doc_id, source, size, source_size, target,
 epochs * size + greatest(0, least(size, budget - epochs * source_size - start)) AS taken FROM cut
"""

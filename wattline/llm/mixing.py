"""Mixes sources to target weights by exponential keys and word budgets.

Every source gets a target: the words of all sources, shared by weight; a target stops at
``cap`` times the words of its source and the excess is shared by weight among the others.
A source is taken in whole epochs first. What is left of its target goes to the documents
with the smallest keys ``-ln(u) / weight`` (Efraimidis and Spirakis), in key order, as far as
the budget reaches.

The order within a source is never built in one task. Keys fall into buckets that keep their
order and stay small for any weights; bucket sums say in which bucket the budget of a source ends, and only rows of that
bucket are sorted. ``u`` comes from the document id and the text, so reruns agree. Rows of equal
id and text tie; where a budget ends among them, as many are taken as it reaches, counted per
piece of the table first, so that no task numbers a large group of them.

Defined cases: a null text has no words, null is a source of its own and comes last, rows that
share an id or have none are told apart by their texts, documents without words are taken with 0
words, and an input column named like an output column is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattline.llm.common import n_words, others, stored

OUTPUTS = ("size", "source_size", "target", "copies", "taken")
# buckets for a factor of e between keys
BUCKETS = 2048


def word_length_weight(text: Column, size: Column) -> Column:
    """Quality weight between 0 and 1: falls as the mean word strays from six characters."""
    mean = F.length(text) / F.greatest(size, F.lit(1))
    return F.coalesce(1 / (1 + F.abs(mean - 6)), F.lit(0.1))


def sample_key(doc_id: Column, text: Column, weight: Column, seed: int) -> Column:
    """Exponential key; 52 bits of a digest stand for the uniform number."""
    parts = (F.coalesce(part.cast("string"), F.lit("")) for part in (doc_id, text))
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), *parts))
    bits = F.conv(F.substring(digest, 1, 13), 16, 10).cast("double")
    return -F.log((bits + 1) / F.lit(float(2**52 + 1))) / weight


def _bucket(key: Column) -> Column:
    """Equal steps of ln(key). A weight only shifts ln(key), so whatever the weights, a bucket
    holds no more than 1 / (e * BUCKETS) of a source on average."""
    return F.floor(F.log(F.greatest(key, F.lit(1e-300))) * BUCKETS).cast("int")


def targets(sources: DataFrame, shares: tuple[int, ...], cap: int) -> DataFrame:
    """Target of each source; ``sources`` has one row per source (source, source_size).

    The level is the words per unit of weight of all sources below their cap.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_ratio = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    after = by_ratio.rowsBetween(0, Window.unboundedFollowing)
    whole = Window.partitionBy()
    weighed = sources.withColumn(
        "weight",
        F.element_at(
            F.array(*map(F.lit, shares)),
            ((F.row_number().over(by_name) - 1) % len(shares) + 1).cast("int"),
        ).cast("long"),
    ).withColumn("most", F.col("source_size") * cap)
    levels = (
        weighed.withColumn("ratio", F.col("most") / F.col("weight"))
        .withColumn("total", F.sum("source_size").over(whole))
        .withColumn(
            "level",
            (F.col("total") - F.coalesce(F.sum("most").over(before), F.lit(0)))
            / F.sum("weight").over(after),
        )
        .withColumn("fits", F.when(F.col("level") <= F.col("ratio"), F.col("level")))
        .withColumn(
            "level",
            F.first("fits", ignorenulls=True).over(
                by_ratio.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
            ),
        )
    )
    return levels.select(
        "source",
        "source_size",
        F.least(F.col("most").cast("double"), F.col("level") * F.col("weight")).alias("target"),
    )


def _plan(narrow: DataFrame, shares: tuple[int, ...], cap: int) -> DataFrame:
    """Per source: whole epochs, and where its fractional selection ends."""
    sources = narrow.groupBy("source").agg(F.sum("size").alias("source_size"))
    goals = (
        targets(sources, shares, cap)
        .withColumn(
            "epochs",
            F.when(
                F.col("source_size") > 0,
                F.least(F.floor(F.col("target") / F.col("source_size")), F.lit(cap)),
            ).otherwise(0),
        )
        .withColumn("budget", F.col("target") - F.col("epochs") * F.col("source_size"))
    )
    goals = stored(goals, "mix-goals")
    g = goals.select(F.col("source").alias("g_source"), "budget")
    sums = narrow.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
    upto = Window.partitionBy("source").orderBy("bucket")
    edges = (
        sums.withColumn("upto", F.sum("words").over(upto))
        .join(g, F.col("source").eqNullSafe(F.col("g_source")))
        .where((F.col("upto") - F.col("words") <= F.col("budget")) & (F.col("upto") > F.col("budget")))
        .select(
            F.col("source").alias("e_source"), F.col("bucket").alias("edge"),
            (F.col("upto") - F.col("words")).alias("before"), "budget",
        )
    )
    edges = stored(edges, "mix-edges")
    order = Window.partitionBy("source").orderBy("key", "tie")
    cut = (
        narrow.join(
            edges,
            F.col("source").eqNullSafe(F.col("e_source")) & (F.col("bucket") == F.col("edge")),
        )
        .groupBy("source", "key", "tie", "size", "before", "budget").agg(F.count("*").alias("n"))
        .withColumn("words", F.col("size") * F.col("n"))
        .withColumn("left", F.col("budget") - F.col("before") - F.sum("words").over(order) + F.col("words"))
        # how many of equal rows come before the budget's end by at least half of their words
        .withColumn("reached", F.when(F.col("size") == 0, F.col("n")).otherwise(
            F.least(F.col("n"), F.floor(F.col("left") / F.greatest(F.col("size"), F.lit(1)) + 0.5))
        ))
        .where((F.col("left") >= 0) & (F.col("reached") > 0))
        .groupBy(F.col("source").alias("c_source"))
        .agg(
            F.max(F.struct("key", "tie")).alias("cut"),
            F.max_by(F.struct("reached", "n"), F.struct("key", "tie")).alias("at_cut"),
        )
    )
    return (
        goals.join(edges.select("e_source", "edge"), F.col("source").eqNullSafe(F.col("e_source")), "left")
        .join(cut, F.col("source").eqNullSafe(F.col("c_source")), "left")
        .select(
            F.col("source").alias("p_source"), "source_size", "target", "epochs", "edge", "cut",
            F.col("at_cut.reached").alias("reached"),
            (F.col("at_cut.reached") < F.col("at_cut.n")).alias("divided"),
        )
    )


def _numbered(rows: DataFrame) -> DataFrame:
    """Rows with ``_nth``, from 1 within a source: pieces of the table are counted first."""
    here = F.col("p_source").alias("n_source")
    placed = stored(
        rows.withColumn("_at", F.monotonically_increasing_id())
        .withColumn("_piece", F.shiftright("_at", 33)),
        "mix-divided",
    )
    counted = placed.groupBy(here, F.col("_piece").alias("n_piece")).agg(F.count("*").alias("n"))
    before = Window.partitionBy("n_source").orderBy("n_piece").rowsBetween(Window.unboundedPreceding, -1)
    starts = counted.withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0)))
    within = Window.partitionBy("p_source", "_piece").orderBy("_at")
    return (
        placed.withColumn("_k", F.row_number().over(within))
        .join(starts, F.col("p_source").eqNullSafe(F.col("n_source")) & (F.col("_piece") == F.col("n_piece")))
        .withColumn("_nth", F.col("start") + F.col("_k"))
        .drop("_at", "_piece", "_k", "n_source", "n_piece", "n", "start")
    )


def mix(
    docs: DataFrame,
    text: str = "text",
    source: str = "source",
    doc_id: str = "doc_id",
    shares: tuple[int, ...] = (1, 2, 3),
    cap: int = 3,
    seed: int = 17,
    weight=word_length_weight,
) -> DataFrame:
    """Input rows with ``size``, ``source_size``, ``target``, ``copies`` and ``taken``.

    ``copies`` says how often the mix holds the row, ``taken`` how many words that makes.
    Sources weigh ``shares`` in turn, in code-point order. ``weight`` makes a positive
    quality weight from the text column and its number of words.
    """
    columns = others(docs, OUTPUTS)
    size = n_words(F.col(text))
    keyed = docs.select(
        F.struct(*columns).alias("_row"), F.col(source).alias("_source"), size.alias("size"),
        F.coalesce(F.col(doc_id).cast("long"), F.lit(-(2**63))).alias("_tie"),
        sample_key(F.col(doc_id), F.col(text), weight(F.col(text), size), seed).alias("_key"),
    ).withColumn("_bucket", _bucket(F.col("_key")))
    narrow = stored(
        keyed.select(
            F.col("_source").alias("source"), "size", F.col("_tie").alias("tie"),
            F.col("_key").alias("key"), F.col("_bucket").alias("bucket"),
        ),
        "mix-keys",
    )
    plan = stored(_plan(narrow, shares, cap), "mix-plan")
    here = F.struct(F.col("_key").alias("key"), F.col("_tie").alias("tie"))
    within = (F.col("_bucket") < F.col("edge")) | (
        (F.col("_bucket") == F.col("edge")) & (here <= F.col("cut"))
    )
    planned = keyed.join(plan, F.col("_source").eqNullSafe(F.col("p_source")))
    if plan.where("divided").isEmpty():
        chosen = planned.withColumn("_more", within)
    else:
        # only here rows need a number: those of the tied rows among which a budget ends
        tied = F.col("divided") & (F.col("_bucket") == F.col("edge")) & (here == F.col("cut"))
        tied = F.coalesce(tied, F.lit(False))
        chosen = planned.where(~tied).withColumn("_more", within).unionByName(
            _numbered(planned.where(tied)).withColumn("_more", F.col("_nth") <= F.col("reached")).drop("_nth")
        )
    copies = F.least(F.col("epochs") + F.coalesce(F.col("_more").cast("long"), F.lit(0)), F.lit(cap))
    return (
        chosen.withColumn("copies", copies)
        .select(
            "_row.*", "size", "source_size", "target", "copies",
            (F.col("size") * F.col("copies")).alias("taken"),
        )
    )


def op9_mixing(spark, sf_dir):
    from wattline.llm.common import table

    mixed = mix(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


OP9_SQL = r"""
with d as (
  select doc_id, source,
    cast(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) as bigint) as size,
    length(text) as chars,
    (cast('0x' || substr(md5('17:' || coalesce(cast(doc_id as varchar), '') || ':' || coalesce(text, '')), 1, 13) as bigint) + 1)
      / (power(2, 52) + 1) as u
  from documents),
keyed as (
  select doc_id, source, size,
    -ln(u) / coalesce(1 / (1 + abs(chars / greatest(size, 1) - 6)), 0.1) as key
  from d),
s as (select source, cast(sum(size) as bigint) as source_size from keyed group by source),
w as (
  select *, [1, 2, 3][1 + (row_number() over (order by source nulls last) - 1) % 3] as weight,
    3 * source_size as most
  from s),
levels as (
  select *, most / weight as ratio,
    ((sum(source_size) over ()) - coalesce(sum(most) over (
        order by most / weight, source nulls last rows between unbounded preceding and 1 preceding), 0))
      / sum(weight) over (
        order by most / weight, source nulls last rows between current row and unbounded following) as level
  from w),
goals as (
  select source, source_size,
    least(cast(most as double), weight * (
      select arg_min(level, (ratio, coalesce(source, chr(1114111)))) from levels where level <= ratio)) as target
  from levels),
budgets as (
  select *, case when source_size > 0 then least(floor(target / source_size), 3) else 0 end as epochs from goals),
placed as (
  select k.doc_id, k.size, b.source_size, b.target, b.epochs,
    sum(k.size) over (
      partition by k.source order by k.key, k.doc_id rows between unbounded preceding and current row) as reached
  from keyed k join budgets b on k.source is not distinct from b.source)
select doc_id, size, source_size, target,
  cast(size * least(3, epochs
    + case when reached - size / 2 <= target - epochs * source_size then 1 else 0 end) as bigint) as taken
from placed
"""

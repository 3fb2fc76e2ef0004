"""Mixing sources to target weights by Pareto order sampling (DataFrame functions only).

Targets: sources in code-point order (null last) weigh 3, 1, 2, repeating, and share
``share`` times all sizes.  No target passes ``most`` times its source's size; the
excess goes to the others by weight.  That fixed point is min(cap, weight * level)
with one common level, found from running sums over the sources sorted by cap/weight.

Documents: a source's expected copies are c = target / size.  floor(c) copies of every
document are certain.  For the rest each document draws u from a hash of its id, its text and
its number among rows that repeat both (and the source), and documents are ranked by random odds u/(1-u) over inclusion odds f/(1-f), f = c - floor(c)
(Pareto order sampling).  The sample is of fixed size in words: documents are taken in
rank order until the words still missing are reached, the last one if it brings the
total nearer.  Documents of over 1/``LARGE`` of their source (at most ``LARGE`` of them)
are decided first, so that the others can still meet the target.

No source is sorted in one task: a histogram of the rank key (``BUCKETS`` per source,
summed before the shuffle) finds the bucket where the sample ends, and only that
bucket's documents are ranked.  Sources are one row each in a small table; documents
meet it in a join that Spark broadcasts by its size or splits where a source is hot.

Draws are hashes, so reruns agree.  Null text counts 0 words and a null source is a source
of its own.  A null id draws like the empty one, together with the text, so rows without ids
draw apart; rows that repeat everything are numbered 1, 2, ... and draw apart too (which of
them bears which number makes no difference).  A source without words has target 0; empty tables give empty
results.  Input columns named like output columns are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.hashing import hex32_uniform
from ..session import materialize

WEIGHTS = (3, 1, 2)
SHARE, MOST = 1.5, 2.0
BUCKETS = 4096
LARGE = 100
SEED = "mix-1"


def word_count(text: Column) -> Column:
    """Number of runs without white space (space and \\x09-\\x0D); null counts 0."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint")


def source_targets(sized: DataFrame, source_col: str = "source", size_col: str = "size", weights=WEIGHTS,
                   share: float = SHARE, most: float = MOST) -> DataFrame:
    """One row per source: source_size, target."""
    per = sized.groupBy(F.col(source_col).alias("__source")).agg(F.sum(size_col).alias("source_size"))
    # one row per source from here on
    place = F.row_number().over(Window.orderBy(F.col("__source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights) + 1).cast("int"))
    per = per.withColumn("weight", weight).withColumn("cap", F.col("source_size") * F.lit(float(most)))
    everything, ahead = Window.partitionBy(), Window.orderBy(F.col("cap") / F.col("weight"), F.col("__source")).rowsBetween(
        Window.unboundedPreceding, -1)
    total = F.sum("source_size").over(everything) * F.lit(float(share))
    left = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(ahead), F.lit(0.0))
    level = (total - F.coalesce(F.sum("cap").over(ahead), F.lit(0.0))) / left
    per = per.withColumn("level", level).withColumn("level", F.max("level").over(everything))
    return per.select("__source", "source_size", F.least("cap", F.col("weight") * F.col("level")).alias("target"))


def numbered(rows: DataFrame, keys: list[str], at: str = "__at", number: str = "__number") -> DataFrame:
    """``rows`` with 1, 2, ... among rows that agree in ``keys`` (null agrees with null).

    ``at`` is the task that wrote the row.  Counts per key and task give each task its first
    number, so rows of one key are numbered in many tasks; only rows that repeat are ranked.
    """
    counts = rows.groupBy(*keys, at).agg(F.count(F.lit(1)).alias("__n"))
    per = Window.partitionBy(*keys)
    ahead = per.orderBy(at).rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumns({"__before": F.coalesce(F.sum("__n").over(ahead), F.lit(0)),
                                 "__total": F.sum("__n").over(per)}).where("__total > 1")
    names = [*keys, at]
    counts = counts.select("__before", *[F.col(c).alias(f"__same_{i}") for i, c in enumerate(names)])
    same = [F.col(c).eqNullSafe(F.col(f"__same_{i}")) for i, c in enumerate(names)]
    found = rows.join(counts, same, "left").drop(*[f"__same_{i}" for i in range(len(names))])
    rank = F.row_number().over(Window.partitionBy(*names).orderBy(F.lit(1)))
    once = found.where(F.col("__before").isNull()).withColumn(number, F.lit(1).cast("bigint"))
    again = found.where(F.col("__before").isNotNull()).withColumn(number, F.col("__before") + rank)
    return once.unionByName(again).drop("__before")


def mix_sources(sized: DataFrame, id_col: str = "doc_id", source_col: str = "source", size_col: str = "size",
                weights=WEIGHTS, share: float = SHARE, most: float = MOST, seed: str = SEED,
                text_hash: Column | None = None) -> DataFrame:
    """``sized`` with source_size, target, copies and taken (= copies * size) for every row.

    ``text_hash`` tells texts apart (default: md5 of ``text``, or of the size without one).
    """
    added = ("source_size", "target", "copies", "taken")
    kept = [c for c in sized.columns if c.lower() not in added]
    if text_hash is None:
        text_hash = F.md5(F.coalesce(F.col("text" if "text" in sized.columns else size_col).cast("string"), F.lit("")))
    first = materialize(sized.select(*kept, text_hash.alias("__text"), F.spark_partition_id().alias("__at")), "mix-input")
    draw = hex32_uniform(F.substring(F.md5(F.concat_ws(
        "|", F.coalesce(F.col(id_col).cast("string"), F.lit("")), "__text", F.col("__number").cast("string"), F.lit(seed))), 1, 8))
    rows = numbered(first, [id_col, source_col, "__text"]).select(*kept, draw.alias("__u"))
    copies = F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(float(most)))
                    ).otherwise(0.0)
    sources = source_targets(rows, source_col, size_col, weights, share, most).withColumn("__whole", F.floor(copies))
    sources = sources.withColumns({"__part": copies - F.col("__whole"),
                                   "__missing": F.col("target") - F.col("__whole") * F.col("source_size")})
    sources = materialize(sources, "mix-sources")

    odds = F.try_divide(F.col("__u") * (1 - F.col("__part")), (1 - F.col("__u")) * F.col("__part"))
    key = F.when(F.col("__part") > 0, odds / (1 + odds))
    ranked = _meet(rows, sources, source_col).withColumns({
        "__key": key, "__bucket": F.floor(key * BUCKETS),
        "__large": F.col(size_col) * LARGE > F.col("source_size")})
    order = [F.col("__key"), F.col(id_col), F.col(size_col)]
    run = Window.partitionBy(source_col).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)

    large = ranked.where("__large").withColumn(
        "__need", F.col("__part") * F.sum(size_col).over(Window.partitionBy(source_col)))
    large = large.withColumn("__in", _reached(F.sum(size_col).over(run), F.col(size_col), F.col("__need")))
    small = ranked.where("not __large")
    words = large.where("__in").groupBy(F.col(source_col).alias("__source")).agg(F.sum(size_col).alias("in_large"))
    bars = small.where(F.col("__key").isNotNull()).groupBy(F.col(source_col).alias("__source"), "__bucket").agg(
        F.sum(size_col).alias("bar"))
    bars = bars.withColumn("upto", F.sum("bar").over(Window.partitionBy("__source").orderBy("__bucket").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)))
    needs = _meet(sources, words, "__source", "left").select(
        "__source", (F.col("__missing") - F.coalesce("in_large", F.lit(0))).alias("need"))
    end = _meet(bars, needs, "__source").where(
        (F.col("upto") - F.col("bar") < F.col("need")) & (F.col("upto") >= F.col("need")))
    end = end.select("__source", F.col("__bucket").alias("last"), (F.col("upto") - F.col("bar")).alias("before"))
    # without an end bucket either nothing is missing or everything is taken
    plan = _meet(needs, end, "__source", "left").select(
        "__source", (F.col("need") - F.coalesce("before", F.lit(0))).alias("__need"),
        F.coalesce("last", F.when(F.col("need") > 0, BUCKETS + 1).otherwise(-1)).alias("__last"))
    plan = materialize(plan, "mix-plan")

    small = _meet(small, plan, source_col)
    ends = small.where("__bucket = __last")
    ends = ends.withColumn("__in", _reached(F.sum(size_col).over(run), F.col(size_col), F.col("__need")))
    rest = small.where("__bucket is null or __bucket <> __last").withColumn(
        "__in", F.coalesce(F.col("__bucket") < F.col("__last"), F.lit(False)))
    cols = [*kept, "source_size", "target", "__whole", "__in"]
    out = rest.select(*cols).unionByName(ends.select(*cols)).unionByName(
        large.withColumn("__in", F.coalesce("__in", F.lit(False))).select(*cols))
    out = out.withColumn("copies", (F.col("__whole") + F.col("__in").cast("int")).cast("bigint"))
    return out.select(*kept, "source_size", "target", "copies", (F.col("copies") * F.col(size_col)).alias("taken"))


def _meet(rows: DataFrame, per_source: DataFrame, source_col: str, how: str = "inner") -> DataFrame:
    """Rows with their source's values; null is a source like any other."""
    named = per_source.withColumnRenamed("__source", "__of")
    return rows.join(named, F.col(source_col).eqNullSafe(F.col("__of")), how).drop("__of")


def _reached(upto: Column, size: Column, need: Column) -> Column:
    """Taken in rank order while words are missing; the row that passes ``need`` if that is nearer."""
    return (upto <= need) | ((upto - size < need) & (upto - need <= need - (upto - size)))


def mix_report(docs: DataFrame) -> DataFrame:
    """Contract columns for every document."""
    sized = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"),
                        F.md5(F.coalesce(F.col("text"), F.lit(""))).alias("__md5"))
    return mix_sources(sized, text_hash=F.col("__md5")).select("doc_id", "size", "source_size", "target", "taken", "source")

"""Confounder encoding.

The session mart becomes a model frame with integer treatment/outcome and
categorical confounders.  Countries outside the top N by frequency (and NULL)
become ``other_country``; NULL device becomes ``unknown``.

Scale: the top-N table has at most N rows, so broadcasting it is bounded by
the parameter, not by the data.  One-hot columns are only materialised on
request (``one_hot``); the estimators work on the categorical form.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the encoding.
TOP_N_COUNTRIES = 10
OTHER_COUNTRY = "other_country"
UNKNOWN_DEVICE = "unknown"
CONFOUNDERS = ("is_new_user", "device", "geo")
NULL_POLICIES = ("error", "control", "drop")


def top_levels(df: DataFrame, col: str, n: int = TOP_N_COUNTRIES,
               count_name: str = "sessions") -> DataFrame:
    """K2: the ``n`` most frequent non-NULL values, ties broken by value."""
    return (df.where(F.col(col).isNotNull())
            .groupBy(col).agg(F.count(F.lit(1)).alias(count_name))
            .orderBy(F.desc(count_name), F.asc(col))
            .limit(n))


def as_int(c: str, policy: str = "error") -> Column:
    """Boolean -> 0/1 with a NULL policy.

    ``error`` fails the task on NULL (as the reference's integer cast does),
    ``control`` maps NULL to 0; ``drop`` rows are removed by ``model_frame``.
    """
    if policy not in NULL_POLICIES:
        raise ValueError(f"null policy must be one of {NULL_POLICIES}")
    col = F.col(c)
    if policy == "control":
        return F.coalesce(col, F.lit(False)).cast("int")
    return F.when(col.isNull(), F.raise_error(F.lit(f"NULL in {c}; choose a null policy")).cast("int")
                  ).otherwise(col.cast("int"))


def model_frame(sessions: DataFrame, top_n: int = TOP_N_COUNTRIES,
                null_treatment: str = "error", treatment: str = "is_paid",
                outcome: str = "converted") -> DataFrame:
    """Session rows -> (session_key, session_date, treatment, outcome, confounders)."""
    if null_treatment == "drop":
        sessions = sessions.where(F.col(treatment).isNotNull())
    top = top_levels(sessions, "geo_country", top_n).select(F.col("geo_country").alias("_top"))
    joined = sessions.join(F.broadcast(top), F.col("geo_country") == F.col("_top"), "left")
    return joined.select(
        "session_key", "session_date",
        as_int(treatment, "control" if null_treatment == "control" else "error").alias("treatment"),
        as_int(outcome).alias("outcome"),
        as_int("is_new_user").alias("is_new_user"),
        F.coalesce(F.col("device_category"), F.lit(UNKNOWN_DEVICE)).alias("device"),
        F.when(F.col("_top").isNotNull(), F.col("geo_country")).otherwise(F.lit(OTHER_COUNTRY)).alias("geo"),
    )


MAX_LEVELS = 10_000   # levels per confounder that a wide frame may have


def level_name(prefix: str, level: Column) -> Column:
    """Column name of a one-hot level; geo names drop '<', '>' and spaces."""
    name = F.concat(F.lit(f"{prefix}_"), level)
    return F.translate(F.replace(name, F.lit(" "), F.lit("_")), "<>", "") if prefix == "geo" else name


def confounder_levels(frame: DataFrame, columns=("device", "geo"),
                      max_levels: int = MAX_LEVELS) -> dict[str, list[tuple[str, str]]]:
    """Sorted (level, column name) pairs per categorical confounder.

    At most ``max_levels`` of each reach the driver; more raise, as no wide frame can hold them.
    """
    out = {}
    for c in columns:
        rows = frame.select(F.col(c).alias("v"), level_name(c, F.col(c)).alias("name")).distinct().limit(max_levels + 1).collect()
        if len(rows) > max_levels:
            raise ValueError(f"more than {max_levels} levels of {c!r}")
        out[c] = sorted((r.v, r.name) for r in rows)
    return out


def confounder_names(levels: dict[str, list[tuple[str, str]]]) -> list[str]:
    """``is_new_user`` + device dummies + geo dummies, in the reference's order."""
    geo = [name for _, name in levels["geo"]]
    if len(set(geo)) != len(geo):
        raise ValueError(f"country columns collide after cleanup: {geo}")
    return ["is_new_user", *[name for _, name in levels["device"]], *geo]


def one_hot(frame: DataFrame, levels: dict[str, list[tuple[str, str]]] | None = None) -> DataFrame:
    """The wide 0/1 frame (all levels kept, sorted) next to treatment/outcome."""
    levels = levels or confounder_levels(frame)
    names = confounder_names(levels)
    cols = [F.col("is_new_user")]
    cols += [(F.col(c) == F.lit(v)).cast("int") for c in ("device", "geo") for v, _ in levels[c]]
    return frame.select("session_key", "treatment", "outcome",
                        *[c.alias(n) for c, n in zip(cols, names)])


def sparse_frame(frame: DataFrame, levels: dict[str, list[tuple[str, str]]] | None = None,
                 vector: str = "features") -> DataFrame:
    """U2 for any number of levels: the wide frame's confounders as one sparse ``ml`` vector column.

    Component i is column i of ``confounder_names(levels)``.  The plan has one index lookup and
    one encoding per confounder, whatever the number of levels, and a row holds its ones only.
    The index comes from ``levels``, so nothing is fitted on the frame's rows.  A value that is
    not among ``levels`` fails the task; in ``one_hot`` it would have a row of zeros.
    """
    from pyspark.ml.feature import OneHotEncoder, StringIndexerModel, VectorAssembler
    levels = levels or confounder_levels(frame)
    confounder_names(levels)      # colliding names raise here as in the wide frame
    kept = frame.select("session_key", "treatment", "outcome", "is_new_user", "device", "geo")
    # an encoder of no level at all does not exist; without levels there are no rows either
    cols = [c for c in ("device", "geo") if levels[c]]
    at, ones = [f"__{c}_at" for c in cols], [f"__{c}_ones" for c in cols]
    for c, to in zip(cols, at):
        kept = StringIndexerModel.from_labels([v for v, _ in levels[c]], c, to, handleInvalid="error").transform(kept)
    if cols:
        # the encoder's size is in the index's column metadata: fitting reads no rows
        kept = OneHotEncoder(inputCols=at, outputCols=ones, dropLast=False).fit(kept).transform(kept)
    wide = VectorAssembler(inputCols=["is_new_user", *ones], outputCol=vector).transform(kept)
    return wide.select("session_key", "treatment", "outcome", vector)


def vector_ones(vector: str = "features") -> Column:
    """Positions of a 0/1 vector's ones, ascending, from its stored form."""
    v = F.unwrap_udt(F.col(vector))
    places = F.when(v["type"] == 0, v["indices"]).otherwise(F.sequence(F.lit(0), F.size(v["values"]) - 1))
    pairs = F.arrays_zip(places.alias("at"), v["values"].alias("value"))
    return F.transform(F.filter(pairs, lambda p: p["value"] != 0), lambda p: p["at"])


def confounder_columns(frame: DataFrame) -> DataFrame:
    """Long summary of the one-hot encoding: per dummy column, sessions with 1 and
    treated sessions with 1 (checks names and counts without a wide collect)."""
    aggs = [F.count(F.lit(1)).alias("n_ones"), F.sum("treatment").cast("bigint").alias("n_treated")]
    dummies = F.explode(F.array(level_name("device", F.col("device")), level_name("geo", F.col("geo")),
                                F.when(F.col("is_new_user") == 1, F.lit("is_new_user"))))
    long = frame.select("treatment", dummies.alias("confounder")).where(F.col("confounder").isNotNull())
    return long.groupBy("confounder").agg(*aggs)


def encoded_cells(sessions: DataFrame, keys=(), top_n: int = TOP_N_COUNTRIES,
                  null_treatment: str = "error", treatment: str = "is_paid",
                  outcome: str = "converted") -> DataFrame:
    """Confounder cells straight from sessions in one pass over them.

    Equal to ``build_cells(model_frame(sessions))`` (with ``keys``), but the
    top-N countries are taken from raw (new user, device, country) cells
    instead of a second pass over the sessions: the raw cells are written once
    (at most 2 x devices x countries rows per key), the top-N list is ranked
    from them, and the raw cells are re-aggregated to top-N + other.
    """
    from liftlens.operators.causal.cells import build_cells, merge_cells
    from liftlens.session import materialize
    if null_treatment == "drop":
        sessions = sessions.where(F.col(treatment).isNotNull())
    raw = sessions.select(
        *keys,
        as_int(treatment, "control" if null_treatment == "control" else "error").alias("treatment"),
        as_int(outcome).alias("outcome"),
        as_int("is_new_user").alias("is_new_user"),
        F.coalesce(F.col("device_category"), F.lit(UNKNOWN_DEVICE)).alias("device"),
        F.col("geo_country").alias("_country"))
    raw_cells = materialize(build_cells(raw, ("is_new_user", "device", "_country"), keys=keys), "raw-cells")
    top = (raw_cells.where(F.col("_country").isNotNull())
           .groupBy("_country").agg(F.sum("n").alias("_sessions"))
           .orderBy(F.desc("_sessions"), F.asc("_country")).limit(top_n)
           .select(F.col("_country").alias("_top")))
    mapped = (raw_cells.join(F.broadcast(top), F.col("_country") == F.col("_top"), "left")
              .withColumn("geo", F.when(F.col("_top").isNotNull(), F.col("_country"))
                          .otherwise(F.lit(OTHER_COUNTRY))))
    return merge_cells(mapped, CONFOUNDERS, keys)

"""A click model with a closed form: smoothed log odds per category, summed, with pairwise interactions.

No optimizer runs: one unpivot and one aggregate fit it, so its results are the same everywhere
and can be repeated in SQL.  All it learns from are weighted sums of positives and negatives per category
(``click_counts``).  Such sums of separate days add up, so a model of many days can be put together
from the stored sums of each (see ``operators.refit``).

An interaction is the category of two features at once.  Its part is what its own log odds add to the sum of the two
features' parts, smoothed towards nothing: a combination that was never seen falls back to its two features.

Without interactions the logit is a sum of one part per feature, so items are ordered alike for every user.
Shapley values are exact with and without them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinary.operators.learning import clicked
from affinary.operators.metrics import auc
from affinary.roles import Roles
from affinary.sources.scratch import Stage, materialize

Cross = tuple[str, str]
ALL_ROWS = ""  # the feature under which the sums of all rows stand


def cross_name(cross: Cross) -> str:
    return "*".join(cross)


def _free(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {name.lower() for name in df.columns}
    while stem.lower() in taken:
        stem += "_"
    return stem


def _look_up(df: DataFrame, table: DataFrame, keys: Mapping[str, str], values: Mapping[str, str]) -> DataFrame:
    """Left join of category values: ``keys`` maps columns of ``df`` to those of ``table``, ``values`` new columns to those of
    ``table``.  Categories that the table lacks give 0."""
    own = {name: _free(df, f"_key{number}") for number, name in enumerate(keys)}
    told = table.select(*[F.col(key).alias(own[name]) for name, key in keys.items()], *[F.col(v).alias(n) for n, v in values.items()])
    condition = [F.col(f"`{name}`").cast("string") == F.col(own[name]) for name in keys]
    joined = df.join(told, condition, "left").drop(*own.values())
    return joined.withColumns({name: F.coalesce(name, F.lit(0.0)) for name in values})


@dataclass(frozen=True)
class AdditiveModel:
    """``parts`` holds (feature, value, part), one row per category; ``base`` is the log odds of all rows.

    ``cross_parts`` holds (feature, value, other, part) of the pairs of features in ``crosses``.
    """

    features: tuple[str, ...]
    base: float
    parts: DataFrame
    crosses: tuple[Cross, ...] = ()
    cross_parts: DataFrame | None = None

    def _with_parts(self, df: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, dict[str | Cross, str]]:
        """The rows with a column per feature and per interaction whose features are all among ``columns``."""
        added: dict[str | Cross, str] = {}
        for name in dict.fromkeys(name for name in columns if name in self.features):
            added[name] = _free(df, f"_part{len(added)}")
            table = self.parts.filter(F.col("feature") == name)
            df = _look_up(df, table, {name: "value"}, {added[name]: "part"})
        for cross in self.crosses:
            if set(cross) <= set(columns):
                added[cross] = _free(df, f"_part{len(added)}")
                table = self.cross_parts.filter(F.col("feature") == cross_name(cross))
                df = _look_up(df, table, {cross[0]: "value", cross[1]: "other"}, {added[cross]: "part"})
        return df, added

    def part(self, df: DataFrame, columns: Sequence[str], out: str) -> DataFrame:
        """Add the share of the logit that comes from some of the features; unknown categories have none."""
        with_parts, added = self._with_parts(df, columns)
        total: Column = F.lit(0.0)
        for name in added.values():
            total = total + F.col(name)
        return with_parts.withColumn(out, total).drop(*added.values())

    def score(self, df: DataFrame, out: str = "prediction", logit: str = "logit") -> DataFrame:
        """Add the click probability and its logit; rows with a missing feature are dropped first."""
        complete = self.part(df.dropna("any", subset=list(self.features)), self.features, logit)
        with_base = complete.withColumn(logit, F.lit(self.base) + F.col(logit))
        return with_base.withColumn(out, 1 / (1 + F.exp(-F.col(logit))))

    def importance(self, df: DataFrame) -> DataFrame:
        """Mean absolute Shapley value of every feature over all rows, greatest first; the rows are their own background.

        A feature's own part counts less its mean.  Of an interaction h(a, b), feature a gets half of
        (mean of h(a, .) - mean of h) + (h(a, b) - mean of h(., b)); the means over the
        other feature's categories come from counts per category.
        """
        complete = df.select(*self.features).dropna("any")
        if not self.crosses:
            counts = _unpivoted(complete, self.features).groupBy("feature", "value").agg(F.count(F.lit(1)).alias("_n"))
            known = counts.join(self.parts, ["feature", "value"], "left").withColumn("_part", F.coalesce("part", F.lit(0.0)))
            means = known.groupBy("feature").agg((F.sum(F.col("_part") * F.col("_n")) / F.sum("_n")).alias("_mean"))
            away = F.sum(F.abs(F.col("_part") - F.col("_mean")) * F.col("_n")) / F.sum("_n")
            result = known.join(means, "feature").groupBy("feature").agg(away.alias("importance"))
            return result.orderBy(F.desc("importance"), "feature")
        rows, columns = self._with_parts(complete, self.features)
        shares = _unpivoted(complete, self.features).groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))
        n_rows = shares.filter(F.col("feature") == self.features[0]).agg(F.sum("n").alias("n")).first()["n"]
        totals = [F.avg(column).alias(column) for column in columns.values()]
        sides: dict[tuple[Cross, int], str] = {}
        for number, cross in enumerate(self.crosses):
            table = self.cross_parts.filter(F.col("feature") == cross_name(cross)).drop("feature")
            for side, (key, other) in enumerate((("value", "other"), ("other", "value"))):
                weights = shares.filter(F.col("feature") == cross[1 - side]).select(F.col("value").alias(other), "n")
                means = table.join(weights, other).groupBy(key).agg(F.sum(F.col("part") * F.col("n")).alias("s"))
                means = means.select(key, (F.col("s") / F.lit(n_rows)).alias("mean"))
                sides[cross, side] = _free(rows, f"_side{number}{side}")
                rows = _look_up(rows, means, {cross[side]: key}, {sides[cross, side]: "mean"})
        mean_of = rows.agg(*totals).first().asDict()
        values = []
        for name in self.features:
            share = F.col(columns[name]) - F.lit(mean_of[columns[name]])
            for cross in self.crosses:
                if name in cross:
                    mine, others = (F.col(sides[cross, side]) for side in (cross.index(name), 1 - cross.index(name)))
                    share = share + (mine - F.lit(mean_of[columns[cross]]) + F.col(columns[cross]) - others) / 2
            values.append(F.struct(F.lit(name).alias("feature"), F.avg(F.abs(share)).alias("importance")))
        return rows.agg(F.array(*values).alias("v")).select(F.inline("v")).orderBy(F.desc("importance"), "feature")


def _unpivoted(df: DataFrame, features: Sequence[str], *others: str, crosses: Sequence[Cross] = ()) -> DataFrame:
    """(others, feature, value, other), one row per row and feature or pair of features."""
    complete = df.dropna("any", subset=list(features))

    def named(name: str, value: Column, other: Column) -> Column:
        return F.struct(F.lit(name).alias("feature"), value.cast("string").alias("value"), other.cast("string").alias("other"))

    entries = [named(name, F.col(f"`{name}`"), F.lit(None)) for name in features]
    entries += [named(cross_name((a, b)), F.col(f"`{a}`"), F.col(f"`{b}`")) for a, b in crosses]
    return complete.select(*others, F.explode(F.array(*entries)).alias("_f")).select(*others, "_f.*")


def click_counts(
    df: DataFrame, features: Sequence[str], roles: Roles = Roles(), crosses: Sequence[Cross] = (), by: Sequence[str] = ()
) -> DataFrame:
    """Weighted sums (by, feature, value, other, pos, neg) per category, per pair of categories and of all rows.

    Rows with a missing feature, label or weight do not count.  Sums of two tables add up.
    """
    weight = F.col(roles.weight).cast("double")
    unknown = set(name for cross in crosses for name in cross) - set(features)
    if unknown:
        raise ValueError(f"interactions need their features in the model: {sorted(unknown)}")
    rows = df.select(
        *by,
        *features,
        F.when(clicked(roles), weight).when(F.col(roles.label).isNotNull(), 0.0).alias("_pos"),
        F.when(clicked(roles), 0.0).when(F.col(roles.label).isNotNull(), weight).alias("_neg"),
    ).dropna("any", subset=[*features, "_pos", "_neg"])
    rows = rows.withColumn("_all", F.lit(""))
    counted = _unpivoted(rows, [*features, "_all"], *by, "_pos", "_neg", crosses=crosses)
    sums = counted.groupBy(*by, "feature", "value", "other").agg(F.sum("_pos").alias("pos"), F.sum("_neg").alias("neg"))
    return sums.withColumn("feature", F.when(F.col("feature") == "_all", ALL_ROWS).otherwise(F.col("feature")))


def _log_odds(pos: Column, neg: Column, smoothing: float, share: Column | float = 1.0, rest: Column | float = 1.0) -> Column:
    return F.log((pos + F.lit(smoothing) * share) / (neg + F.lit(smoothing) * rest))


def model_from_counts(
    counts: DataFrame,
    features: Sequence[str],
    crosses: Sequence[Cross] = (),
    smoothing: float = 1.0,
    cross_smoothing: float = 10.0,
    stage: Stage = materialize,
) -> AdditiveModel:
    """The model of sums per category, one row for each; the driver reads the sums of all rows."""
    counts = stage(counts, "counts") if crosses else counts
    odds = _log_odds(F.col("pos"), F.col("neg"), smoothing)
    whole = counts.filter(F.col("feature") == ALL_ROWS).select(odds.alias("b")).first()
    base = 0.0 if whole is None else whole["b"]
    single = counts.filter((F.col("feature") != ALL_ROWS) & F.col("feature").isin(*features))
    parts = stage(single.select("feature", "value", (odds - F.lit(base)).alias("part")), "parts")
    if not crosses:
        return AdditiveModel(tuple(features), base, parts)
    tables = []
    for a, b in crosses:
        pair = counts.filter(F.col("feature") == cross_name((a, b)))
        pair = _look_up(pair, parts.filter(F.col("feature") == a), {"value": "value"}, {"_a": "part"})
        pair = _look_up(pair, parts.filter(F.col("feature") == b), {"other": "value"}, {"_b": "part"})
        expected = F.lit(base) + F.col("_a") + F.col("_b")
        chance = 1 / (1 + F.exp(-expected))
        added = _log_odds(F.col("pos"), F.col("neg"), cross_smoothing, chance, 1 - chance) - expected
        tables.append(pair.select("feature", "value", "other", added.alias("part")))
    together = tables[0]
    for table in tables[1:]:
        together = together.unionByName(table)
    return AdditiveModel(tuple(features), base, parts, tuple(map(tuple, crosses)), stage(together, "cross-parts"))


def fit_additive_model(
    df: DataFrame,
    features: Sequence[str],
    roles: Roles = Roles(),
    smoothing: float = 1.0,
    crosses: Sequence[Cross] = (),
    cross_smoothing: float = 10.0,
    stage: Stage = materialize,
) -> AdditiveModel:
    """Fit on rows with label, weight and features; weights count as rows."""
    counts = stage(click_counts(df, features, roles, crosses), "counts")
    return model_from_counts(counts, features, crosses, smoothing, cross_smoothing, stage)


def search_smoothing(
    train: DataFrame, validation: DataFrame, features: Sequence[str], smoothings: Sequence[float], roles: Roles = Roles(), digits: int = 9, stage: Stage = materialize
) -> DataFrame:
    """(trial, smoothing, auc) of every smoothing on the validation rows.

    All trials share one scan of the training rows and one of the validation rows: a category's parts and a row's logits are
    arrays with a place per trial, so the number of jobs does not grow with the trials.  Logits are
    rounded, since sums in another order differ in the last bits, which would break ties.
    """
    counts = stage(click_counts(train, features, roles), "counts")

    def odds() -> Column:
        return F.array(*[_log_odds(F.col("pos"), F.col("neg"), smoothing) for smoothing in smoothings])

    parts = counts.filter(F.col("feature") != ALL_ROWS).select("feature", "value", odds().alias("odds"))
    whole = counts.filter(F.col("feature") == ALL_ROWS).select(odds().alias("whole")).first()
    base = [0.0] * len(smoothings) if whole is None else whole["whole"]
    bases = F.array(*[F.lit(value) for value in base])
    nothing = F.array(*[F.lit(0.0)] * len(smoothings))
    rows = validation.dropna("any", subset=list(features)).select(*features, clicked(roles).alias("_hit"))
    rows = rows.withColumn("_logits", bases)
    for name in features:
        table = parts.filter(F.col("feature") == name).select(F.col("value").alias("_value"), F.zip_with("odds", bases, lambda x, b: x - b).alias("_own"))
        rows = rows.join(table, F.col(f"`{name}`").cast("string") == F.col("_value"), "left")
        rows = rows.withColumn("_logits", F.zip_with("_logits", F.coalesce("_own", nothing), lambda total, x: total + x)).drop("_value", "_own")
    scored = rows.select("_hit", F.posexplode("_logits").alias("trial", "logit")).withColumn("logit", F.round("logit", digits))
    areas = auc(scored, "logit", F.col("_hit"), by=["trial"], stage=stage)
    named = F.element_at(F.array(*[F.lit(float(s)) for s in smoothings]), F.col("trial") + 1)
    return areas.select("trial", named.alias("smoothing"), "auc")

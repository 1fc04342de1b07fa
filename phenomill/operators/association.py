"""Association tests: null models, score tests, saddlepoint p-values, gene burden.

Genotypes are sparse long rows ``chrom, pos, marker_id, s, dosage``: a sample without a row has
dosage 0, NULL is a missing call (set to the mean). The null model is one row per sample and trait.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GeneralizedLinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from phenomill.functions import saddlepoint
from phenomill.functions.ranks import ordered_prefix
from phenomill.functions.nulls import join_null_safe
from phenomill.functions.stats import normal_quantile
from phenomill.operators.genotypes import VARIANT
from phenomill.session import broadcast_checked, write_intermediate

# Covariates of the null model, minimum minor allele count, score (in standard
# deviations) from which the saddlepoint p-value is used, frequency limits of gene tests.
NULL_COVARIATES = ["age", "age2", "age_sex", "age2_sex", "sex", *[f"PC{i}" for i in range(1, 21)]]
MIN_MAC = 0.5
MIN_MAC_VARIANT = 4
SPA_CUTOFF = 0.5
MAX_MAFS = [0.0001, 0.001, 0.01]
#: Carriers of a variant in one row, on average at most.
CARRIERS = 1024


def rank_inverse_normal(df: DataFrame, keys: list[str], value: str, out: str) -> DataFrame:
    """Normal quantile of (average rank - 0.5) / n within each trait; missing stays missing.

    Ranks come from the ordered distinct values, so a trait is never sorted in one task.
    """
    counts = (
        df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("__n"))
    )
    ranked = ordered_prefix(counts, keys, [value], "__n")
    average_rank = F.col("__before") + (F.col("__n") + 1) / 2
    scores = ranked.withColumn(out, normal_quantile((average_rank - 0.5) / F.col("__total"))).select(
        *keys, value, out
    )
    return join_null_safe(df, scores, [*keys, value], "left")


def null_model(
    df: DataFrame,
    trait: str,
    outcome: str,
    covariates: list[str] = NULL_COVARIATES,
    trait_type: str = "binary",
    inverse_normal: bool = False,
    sample: str = "person_id",
) -> DataFrame:
    """Fixed-effects null model of one trait: s, trait, is_case, mu, residual, weight, x.

    ``residual`` and ``weight`` are scaled so that the score is sum(g * residual) and its variance
    sum(weight * g^2) after taking out the covariates ``x`` (with 1 in front). Constant
    covariates are left out.
    """
    if trait_type not in ("binary", "quantitative"):
        raise ValueError(f"trait_type is 'binary' or 'quantitative', not {trait_type!r}")
    binary = trait_type == "binary"
    rows = df.select(
        F.col(sample).alias("s"),
        F.col(outcome).cast("double").alias("y"),
        *[F.col(c).cast("double").alias(c) for c in covariates],
    ).na.drop()
    if inverse_normal and not binary:
        rows = rank_inverse_normal(rows.withColumn("__t", F.lit(trait)), ["__t"], "y", "__y")
        rows = rows.withColumn("y", F.col("__y")).drop("__y", "__t")
    moments = rows.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.avg(c).alias(f"m_{c}") for c in covariates],
        *[F.stddev_samp(c).alias(f"s_{c}") for c in covariates],
    ).first()
    varying = [c for c in covariates if moments[f"s_{c}"]]
    # Standardized covariates span the same space and keep the fit well conditioned.
    rows = rows.select(
        "s", "y", *[((F.col(c) - moments[f"m_{c}"]) / moments[f"s_{c}"]).alias(c) for c in varying]
    )
    # The fit reads the rows once per iteration.
    rows = write_intermediate(rows, "null-model")
    if varying:
        features = VectorAssembler(inputCols=varying, outputCol="features").transform(rows)
        glm = GeneralizedLinearRegression(
            family="binomial" if binary else "gaussian", labelCol="y", predictionCol="mu", tol=1e-8, maxIter=50
        )
        fitted = glm.fit(features).transform(features).drop("features")
    else:
        fitted = rows.withColumn("mu", rows.agg(F.avg("y")).scalar())
    mu, y = F.col("mu"), F.col("y")
    if binary:
        residual, weight = y - mu, mu * (1 - mu)
    else:
        sigma2 = fitted.agg(
            F.sum((y - mu) * (y - mu)) / (F.count(F.lit(1)) - len(varying) - 1)
        ).first()[0]
        residual, weight = (y - mu) / sigma2, F.lit(1.0 / sigma2)
    return fitted.select(
        "s",
        F.lit(trait).alias("trait"),
        (y if binary else F.lit(None).cast("double")).alias("is_case"),
        "mu",
        residual.alias("residual"),
        weight.alias("weight"),
        F.array(F.lit(1.0), *[F.col(c) for c in varying]).alias("x"),
    )


def _weighted_sums(rows: DataFrame, keys: list[str], width: int) -> DataFrame:
    """Per group one array: the upper triangle of sum(w x x'), sum(x (y - mu)), sum((y - mu)^2) and the number of rows.

    ``rows`` has x, y, beta and binary. Tasks add up matrices for each of their groups, so only those are shuffled.
    """
    upper = np.triu_indices(width)
    size = len(upper[0]) + width + 2

    def partial(batches):
        held: dict[tuple, np.ndarray] = {}
        for pdf in batches:
            for key, part in pdf.groupby(keys, sort=False, dropna=False):
                x, y = np.stack(part["x"].to_numpy()), part["y"].to_numpy(dtype=float)
                mu = x @ part["beta"].iloc[0]
                weight = np.ones(len(y))
                if part["binary"].iloc[0]:
                    mu = 1.0 / (1.0 + np.exp(-np.clip(mu, -700.0, 700.0)))
                    weight = mu * (1.0 - mu)
                off = y - mu
                sums = np.concatenate([(x.T @ (weight[:, None] * x))[upper], x.T @ off, [off @ off, len(y)]])
                held[key] = held[key] + sums if key in held else sums
            if len(held) > 20_000:
                yield pd.DataFrame([(*k, v) for k, v in held.items()], columns=[*keys, "sums"])
                held = {}
        if held:
            yield pd.DataFrame([(*k, v) for k, v in held.items()], columns=[*keys, "sums"])

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        return pdf.iloc[:1][keys].assign(sums=[np.sum(np.stack(pdf["sums"].to_numpy()), axis=0)])

    types = dict(rows.dtypes)
    schema = ", ".join(f"{k} {types[k]}" for k in keys) + ", sums array<double>"
    parts = rows.select(*keys, "x", "y", "beta", "binary").mapInPandas(partial, schema)
    # One row per task and group.
    return parts.groupBy(*keys).applyInPandas(add, schema)


def null_models(
    people: DataFrame,
    runs: DataFrame,
    outcomes: dict[str, str],
    covariates: list[str] = NULL_COVARIATES,
    keys: list[str] = ["ancestry", "trait"],  # noqa: B006
    inverse_normal: bool = False,
    sample: str = "person_id",
    max_iterations: int = 50,
) -> DataFrame:
    """Null models of all groups (ancestry, trait) at once: the group's keys and the columns of ``null_model``.

    ``people``: one row per sample with its ancestry, covariates and an outcome column for each trait. ``outcomes``: the kind of each
    trait, 'binary' or 'quantitative'; a trait's name is its column. ``runs``: the groups to fit, as ``cohort.run_grid`` gives them (more
    columns and repeats don't matter). All groups take a step of iteratively reweighted least squares together, with
    one aggregate of matrices per group; settled groups leave. The equations of a group are solved in a task. Constant covariates of
    a group are 0 in its ``x``.
    """
    if bad := set(outcomes.values()) - {"binary", "quantitative"}:
        raise ValueError(f"kinds of traits are 'binary' or 'quantitative', not {sorted(bad)}")
    by_person = [k for k in keys if k != "trait"]
    choices = [F.struct(F.lit(t).alias("trait"), F.lit(k == "binary").alias("binary"), F.col(t).cast("double").alias("y")) for t, k in outcomes.items()]
    wide = people.select(
        F.col(sample).alias("s"), *by_person, F.array(*[F.col(c).cast("double") for c in covariates]).cast("array<double>").alias("c"), F.inline(F.array(*choices))
    )
    wanted = write_intermediate(runs.select(*keys).distinct(), "runs")
    rows = wide.where(F.col("y").isNotNull() & ~F.exists("c", lambda v: v.isNull())).join(broadcast_checked(wanted, 100), keys)
    if inverse_normal:
        scored = rank_inverse_normal(rows, keys, "y", "__y")
        rows = scored.withColumn("y", F.when(F.col("binary"), F.col("y")).otherwise(F.col("__y"))).drop("__y")
    n = len(covariates)
    moments = rows.groupBy(*keys).agg(
        F.array(*[F.avg(F.col("c")[i]) for i in range(n)]).cast("array<double>").alias("means"),
        F.array(*[F.stddev_samp(F.col("c")[i]) for i in range(n)]).cast("array<double>").alias("spreads"),
    )
    moments = write_intermediate(moments, "moments")
    scaled = F.transform(
        F.arrays_zip("c", "means", "spreads"),
        lambda v: F.when(v["spreads"] > 0, (v["c"] - v["means"]) / v["spreads"]).otherwise(0.0),
    )
    width = n + 1
    rows = rows.join(broadcast_checked(moments, 16 * n + 100), keys).select(
        "s", *keys, "binary", "y", F.concat(F.array(F.lit(1.0)), scaled).alias("x"),
        (1 + F.size(F.filter("spreads", lambda v: v > 0))).alias("rank"),
    )
    rows = write_intermediate(rows, "null-rows")
    start = rows.groupBy(*keys).agg(F.first("binary").alias("binary"), F.max("rank").alias("rank"), F.count("*").alias("n"))
    zero = F.array_repeat(F.lit(0.0), width).alias("beta")
    state = write_intermediate(start.select(*keys, "binary", "rank", "n", zero, F.lit(False).alias("settled")), "null-state")
    types = dict(state.dtypes)
    schema = ", ".join(f"{c} {types[c]}" for c in state.columns)
    upper = np.triu_indices(width)

    def solve(batches):
        for pdf in batches:
            betas, settled = [], []
            for beta, sums, binary in zip(pdf["beta"], pdf["sums"], pdf["binary"]):
                gram = np.zeros((width, width))
                gram[upper] = sums[: len(upper[0])]
                gram = gram + np.triu(gram, 1).T
                step = np.linalg.pinv(gram, rcond=1e-12, hermitian=True) @ sums[len(upper[0]) : len(upper[0]) + width]
                betas.append(beta + step)
                settled.append(not binary or bool(np.abs(step).max() <= 1e-10 * (1.0 + np.abs(beta).max())))
            yield pdf.drop(columns="sums").assign(beta=betas, settled=settled)[state_columns]

    state_columns = state.columns
    for _ in range(max_iterations):
        open_ = state.where("NOT settled").select(*keys, "beta")
        if open_.isEmpty():
            break
        sums = _weighted_sums(rows.join(broadcast_checked(open_, 8 * width + 100), keys), keys, width)
        moved = state.where("NOT settled").join(sums, keys).mapInPandas(solve, schema)
        state = write_intermediate(state.where("settled").unionByName(moved), "null-state")
    fitted = rows.join(broadcast_checked(state.select(*keys, "beta"), 8 * width + 100), keys)
    linear = F.aggregate(F.zip_with("x", "beta", lambda a, b: a * b), F.lit(0.0), lambda t, e: t + e)
    fitted = fitted.withColumn("mu", F.when(F.col("binary"), 1.0 / (1.0 + F.exp(-linear))).otherwise(linear))
    off = F.col("y") - F.col("mu")
    spread = fitted.where("NOT binary").groupBy(*keys).agg((F.sum(off * off) / (F.count("*") - F.max("rank"))).alias("sigma2"))
    fitted = fitted.join(broadcast_checked(write_intermediate(spread, "null-spread"), 100), keys, "left")
    binary = F.col("binary")
    return fitted.select(
        "s",
        *keys,
        F.when(binary, F.col("y")).alias("is_case"),
        "mu",
        F.when(binary, off).otherwise(off / F.col("sigma2")).alias("residual"),
        F.when(binary, F.col("mu") * (1 - F.col("mu"))).otherwise(1.0 / F.col("sigma2")).alias("weight"),
        "x",
    )


def group_keys(null: DataFrame) -> list[str]:
    """What tells the null models of a table apart."""
    return [c for c in ("ancestry", "trait") if c in null.columns]


def _design_totals(null: DataFrame, width: int) -> dict:
    """Per group: sample and case counts and the inverse of sum(weight * x x')."""
    keys = group_keys(null)
    w = F.col("weight")
    cells = [(a, b) for a in range(width) for b in range(a, width)]
    totals = null.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("is_case").alias("cases"),
        F.array(
            *[
                F.sum(w * F.coalesce(F.get("x", F.lit(a)), F.lit(0.0)) * F.coalesce(F.get("x", F.lit(b)), F.lit(0.0)))
                for a, b in cells
            ]
        ).alias("xwx"),
    )
    out = {}
    for row in totals.collect():  # one row per group
        full = np.zeros((width, width))
        for (a, b), value in zip(cells, row["xwx"]):
            full[a, b] = full[b, a] = value
        out[tuple(row[k] for k in keys)] = (row["n"], row["cases"], np.linalg.pinv(full))
    return out


def score_sums(genotypes: DataFrame, null: DataFrame, width: int) -> DataFrame:
    """Sums per variant and group over carriers and missing calls only."""
    carriers = genotypes.where(F.col("dosage").isNull() | (F.col("dosage") != 0))
    joined = carriers.join(null, "s")
    g, w, r = F.col("dosage").cast("double"), F.col("weight"), F.col("residual")
    gap = F.col("dosage").isNull()

    def x(i):
        return F.coalesce(F.get("x", F.lit(i)), F.lit(0.0))

    return joined.groupBy(*VARIANT, *group_keys(null)).agg(
        F.sum(g).alias("g"),
        F.sum(g * F.col("is_case")).alias("g_case"),
        F.sum(g * r).alias("gr"),
        F.sum(w * g * g).alias("wgg"),
        F.count_if(gap).alias("n_missing"),
        F.sum(F.when(gap, r).otherwise(0.0)).alias("mr"),
        F.sum(F.when(gap, w).otherwise(0.0)).alias("mw"),
        F.array(*[F.sum(w * g * x(i)) for i in range(width)]).alias("wgx"),
        F.array(*[F.sum(F.when(gap, w * x(i)).otherwise(0.0)) for i in range(width)]).alias("mwx"),
    )


def _erfc(values: np.ndarray) -> np.ndarray:
    return np.frompyfunc(math.erfc, 1, 1)(values).astype(float)


def _filled(values: pd.Series) -> np.ndarray:
    return values.fillna(0.0).to_numpy(dtype=float)


def _filled_rows(values: pd.Series) -> np.ndarray:
    return np.nan_to_num(np.array([[np.nan if e is None else e for e in row] for row in values], dtype=float))


def assoc_scan(genotypes: DataFrame, null: DataFrame, min_mac: float = MIN_MAC, burden: bool = False) -> DataFrame:
    """Covariate-adjusted score test of every variant and trait, or ancestry and trait if the null models have both.

    Non-carriers add nothing to the sums, so only carrier rows are joined, with a broadcast null
    model while its counted rows fit, and the partial sums combine before the shuffle.

    ``min_mac`` is a limit on the minor allele count. The dosages of a ``burden`` are not bounded by 2, so it has no other
    allele: there the limit is on the count itself. A variant that can't be tested (no called sample, or no variance
    left by the covariates) keeps its row with NULL statistics.
    """
    null = write_intermediate(null, "null-model")
    keys = group_keys(null)
    width = null.agg(F.max(F.size("x"))).first()[0]
    totals = _design_totals(null, width)
    null = broadcast_checked(null, 8 * width + 80)
    chrom_type = dict(genotypes.dtypes)["chrom"]
    pos_type = dict(genotypes.dtypes)["pos"]

    def test(batches):
        for pdf in batches:
            for group, rows in pdf.groupby(keys, sort=False):
                n, cases, inverse = totals[group]
                alt = _filled(rows["g"])
                called = n - rows["n_missing"].to_numpy(dtype=float)
                af = np.divide(alt, 2.0 * called, out=np.full(len(alt), np.nan), where=called > 0)
                mean = 2.0 * af
                ac = alt + rows["n_missing"].to_numpy() * mean
                count = ac if burden else np.minimum(ac, 2.0 * n - ac)
                mw, mr = _filled(rows["mw"]), _filled(rows["mr"])
                score = _filled(rows["gr"]) + mean * mr
                wgx = _filled_rows(rows["wgx"]) + mean[:, None] * _filled_rows(rows["mwx"])
                effect = wgx @ inverse
                total = _filled(rows["wgg"]) + mean * mean * mw
                var = total - np.einsum("ij,ij->i", wgx, effect)
                tested = var > 1e-10 * total  # below that only rounding is left
                score, var = np.where(tested, score, np.nan), np.where(tested, var, np.nan)
                out = pd.DataFrame(
                    {
                        "chrom": rows["chrom"], "pos": rows["pos"], "MarkerID": rows["marker_id"], **dict(zip(keys, group)),
                        "AC_Allele2": ac, "AF_Allele2": af, "BETA": score / var, "SE": 1.0 / np.sqrt(var), "Tstat": score, "var": var,
                        "p.value": _erfc(np.sqrt(score * score / var / 2.0)), "N": n,
                        "N_case": cases, "N_ctrl": None if cases is None else n - cases, "mean_dosage": mean,
                        "covariate_effect": [e.tolist() if t else None for e, t in zip(effect, tested)],
                    }
                )
                yield out[~(count < min_mac)].astype({"N_case": float, "N_ctrl": float})

    schema = (
        f"chrom {chrom_type}, pos {pos_type}, MarkerID string, {', '.join(f'{k} string' for k in keys)}, AC_Allele2 double, "
        "AF_Allele2 double, BETA double, SE double, Tstat double, var double, `p.value` double, "
        "N bigint, N_case double, N_ctrl double, mean_dosage double, covariate_effect array<double>"
    )
    return score_sums(genotypes, null, width).mapInPandas(test, schema)


def _solved(key: list[str]):
    """p-values of variants whose carriers are all in one row."""

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                q, var, carrier_var, top, bottom = (part.column(c).to_numpy() for c in ("q", "var", "carrier_var", "top", "bottom"))
                g, mu = (part.column(c).flatten().to_numpy() for c in ("g", "mu"))
                row = np.repeat(np.arange(part.num_rows), part.column("g").value_lengths().to_numpy())
                rest = np.maximum(var - carrier_var, 0.0)
                sides = [saddlepoint.solve(g, mu, row, x, var, rest, saddlepoint.reached(x, rest, top, bottom)) for x in (q, -q)]
                p = pa.array(sides[0] + sides[1], from_pandas=True)
                yield pa.RecordBatch.from_arrays([*(part.column(k) for k in key), p], [*key, "__spa"])

    return run


def _piece_cumulants(key: list[str]):
    """The cumulants of each piece at the t of its variant and side."""

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                g, mu = (part.column(c).flatten().to_numpy() for c in ("g", "mu"))
                row = np.repeat(np.arange(part.num_rows), part.column("g").value_lengths().to_numpy())
                sums = saddlepoint.cumulants(g, mu, row, part.column("t").to_numpy())
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in [*key, "side"]), *map(pa.array, sums)], [*key, "side", "s0", "s1", "s2"])

    return run


def _advanced(batches):
    """One step of the variants that are still open."""
    for pdf in batches:
        open_ = ~pdf["done"].to_numpy(dtype=bool)
        own = pdf[open_]
        values = [own[c].to_numpy(dtype=float) for c in ("t", "low", "high", "q", "rest", "s1", "s2")]
        number = own["number"].to_numpy() + 1
        t, low, high, done = saddlepoint.step(number, *values)
        columns = {"t": t, "low": low, "high": high, "done": done, "number": number, "k0": own["s0"], "k1": own["s1"], "k2": own["s2"]}
        for name, column in columns.items():
            pdf.loc[open_, name] = np.asarray(column)
        yield pdf.drop(columns=["s0", "s1", "s2"])


def _side_tails(key: list[str]):
    def run(batches):
        for pdf in batches:
            tail = saddlepoint.tails(*(pdf[c].to_numpy(dtype=float) for c in ("t", "q", "rest", "var", "k0", "k1", "k2")))
            yield pdf[key].assign(tail=tail)

    return run


def _common_pvalues(pieces: DataFrame, key: list[str]) -> DataFrame:
    """p-values of variants whose carriers are in several rows: the pieces' sums are added up, one aggregate per round.

    Only the state of a variant, two rows, is rewritten; pieces are read where they are, by the variants that are open.
    """
    total = {c: F.sum(c).alias(c) for c in ("carrier_var", "top", "bottom")}
    q, var, rest = F.col("q"), F.col("var"), F.col("rest")
    state = (
        pieces.groupBy(*key, "q", "var")
        .agg(*total.values())
        .withColumn("rest", F.greatest(var - F.col("carrier_var"), F.lit(0.0)))
        .withColumn("side", F.explode(F.array(F.lit(1), F.lit(-1))))
        .withColumn("q", q * F.col("side"))
        .where((rest > 0) | (q < F.col("top")) & (q > F.col("bottom")))
        .select(*key, "side", "q", "var", "rest", (q / var).alias("t"), F.when(q > 0, 0.0).otherwise(-saddlepoint.FAR).alias("low"))
        .withColumns({"high": F.when(q > 0, saddlepoint.FAR).otherwise(0.0), "number": F.lit(0), "done": F.lit(False)})
        .withColumns({c: F.lit(0.0) for c in ("k0", "k1", "k2")})
    )
    types = dict(state.dtypes)
    keys = ", ".join(f"{k} {types[k]}" for k in key)
    schema = ", ".join(f"{c} {types[c]}" for c in state.columns)
    while True:
        state = write_intermediate(state, "saddlepoint")
        open_ = state.where("NOT done")
        if open_.isEmpty():
            break
        at = broadcast_checked(open_.select(*key, "side", "t"), 200)
        sums = pieces.select(*key, "g", "mu").join(at, key).mapInArrow(_piece_cumulants(key), f"{keys}, side int, s0 double, s1 double, s2 double")
        sums = sums.groupBy(*key, "side").agg(*(F.sum(c).alias(c) for c in ("s0", "s1", "s2")))
        state = state.join(sums, [*key, "side"], "left").select(*state.columns, "s0", "s1", "s2").mapInPandas(_advanced, schema)
    sides = state.mapInPandas(_side_tails(key), f"{keys}, tail double")
    both = F.when(F.count("tail") == 2, F.sum("tail"))
    return sides.groupBy(*key).agg(both.alias("__spa"))


def spa_pvalue(
    scan: DataFrame, genotypes: DataFrame, null: DataFrame, cutoff: float = SPA_CUTOFF, piece: int = CARRIERS
) -> DataFrame:
    """Saddlepoint p-value of binary traits for scores beyond ``cutoff`` standard deviations.

    Carriers enter the cumulant function exactly, all others by their normal part. The carriers of a variant are stored as
    arrays, in pieces of about ``piece`` by a hash of the sample. A variant of one piece, as nearly all are, is solved where its
    row is read; a common one takes one sum over its pieces per round, so its carriers don't have to meet in one task.
    Steps go on until each root is found or its bracket can't shrink. ``Is.SPA`` tells where the p-value was used;
    ``SPA.Converged`` is FALSE where it was wanted but no root was found (a score at the edge of what its carriers allow).
    """
    groups = group_keys(null)
    key = [*VARIANT, *groups]
    beyond = (F.abs("Tstat") > cutoff * F.sqrt("var")) & F.col("N_case").isNotNull()
    scan = write_intermediate(scan, "scan")
    carried = genotypes.where(F.col("dosage").isNull() | (F.col("dosage") != 0)).select(*VARIANT, "s", "dosage")
    counted = carried.groupBy(*VARIANT).agg(F.ceil(F.count(F.lit(1)) / piece).cast("int").alias("pieces"))
    wanted = scan.where(beyond).select(
        "chrom", "pos", F.col("MarkerID").alias("marker_id"), *groups, F.abs("Tstat").alias("q"), "var", "mean_dosage", "covariate_effect"
    )
    wanted = write_intermediate(wanted.join(counted, VARIANT), "beyond")
    rows = write_intermediate(null.select("s", *groups, "mu", "weight", "x"), "null-model")
    width = rows.agg(F.max(F.size("x"))).first()[0]
    adjusted = F.coalesce(F.col("dosage").cast("double"), F.col("mean_dosage")) - F.aggregate(
        F.zip_with("x", "covariate_effect", lambda a, b: F.coalesce(a * b, F.lit(0.0))),
        F.lit(0.0),
        lambda total, e: total + e,
    )
    g, mu = F.col("g"), F.col("mu")
    # As t grows without bound the slope of the carriers' part tends to ``top``, in the other direction to ``bottom``.
    pieces = (
        carried.join(broadcast_checked(rows, 8 * width + 60), "s")
        .join(wanted, key)
        .select(*key, "pieces", "q", "var", "mu", "weight", adjusted.alias("g"), F.pmod(F.xxhash64("s"), "pieces").alias("piece"))
        .groupBy(*key, "pieces", "q", "var", "piece")
        .agg(
            F.sum(F.col("weight") * g * g).alias("carrier_var"),
            F.sum(F.when(g > 0, g * (1.0 - mu)).otherwise(-g * mu)).alias("top"),
            F.sum(F.when(g > 0, -g * mu).otherwise(g * (1.0 - mu))).alias("bottom"),
            F.collect_list(F.struct("g", "mu")).alias("carriers"),
        )
        .select(*key, "pieces", "q", "var", "carrier_var", "top", "bottom", F.col("carriers.g").alias("g"), F.col("carriers.mu").alias("mu"))
    )
    pieces = write_intermediate(pieces, "carriers")
    types = dict(pieces.dtypes)
    schema = ", ".join(f"{k} {types[k]}" for k in key) + ", __spa double"
    rare = pieces.where("pieces = 1").mapInArrow(_solved(key), schema)
    p = rare.unionByName(_common_pvalues(pieces.where("pieces > 1"), key)).withColumnRenamed("marker_id", "MarkerID")
    use = F.col("__spa").isNotNull()
    return (
        scan.join(p, ["chrom", "pos", "MarkerID", *groups], "left")
        .withColumn("p.value.NA", F.col("`p.value`"))
        .withColumn("p.value", F.when(use, F.least("__spa", F.lit(1.0))).otherwise(F.col("`p.value`")))
        .withColumn("Is.SPA", use)
        .withColumn("SPA.Converged", F.when(F.coalesce(beyond, F.lit(False)), use))
        .select(*(f"`{c}`" for c in scan.columns), "`p.value.NA`", "`Is.SPA`", "`SPA.Converged`")
    )


def gene_burden(
    genotypes: DataFrame,
    frequencies: DataFrame,
    groups: DataFrame,
    masks: dict[str, list[str]],
    max_mafs: list[float] = MAX_MAFS,
    samples: DataFrame | None = None,
) -> DataFrame:
    """Collapsed minor allele copies per (gene, mask, frequency limit, sample) in genotype form.

    ``groups``: (gene, annotation, marker_id); ``masks``: mask name to its annotations; ``frequencies``: (marker_id, af).
    Where the alternate allele is the common one, a sample's copies are 2 - dosage. A sample without a row
    then has two; these are found with ``samples`` (s), which may be left out if every sample has rows of
    such variants. Missing calls count as none. The result can go to ``assoc_scan`` with ``burden=True``.
    """
    mask_rows = F.array(
        *[
            F.struct(F.lit(name).alias("mask"), F.lit(annotation).alias("annotation"))
            for name, annotations in masks.items()
            for annotation in annotations
        ]
    )
    limits = F.array(*[F.lit(float(v)) for v in max_mafs])
    af = F.col("af")
    rated = frequencies.select("marker_id", F.least(af, 1 - af).alias("maf"), (af > 0.5).alias("flipped"))
    members = (
        groups.join(rated, "marker_id")
        .withColumn("__m", F.explode(F.filter(mask_rows, lambda m: m["annotation"] == F.col("annotation"))))
        .withColumn("max_maf", F.explode(F.filter(limits, lambda v: F.col("maf") <= v)))
        .select("gene", "marker_id", F.col("__m.mask").alias("mask"), "max_maf", "flipped")
        .distinct()
    )
    rows = genotypes.select("marker_id", "s", "dosage", "chrom", "pos")
    if samples is not None:
        # A row of two copies for each sample without one; as many as the burden itself has rows.
        place = genotypes.groupBy("marker_id").agg(F.min("chrom").alias("chrom"), F.min("pos").alias("pos"))
        common = members.where("flipped").select("marker_id").distinct().join(place, "marker_id")
        every = common.join(samples.select("s").distinct()).join(rows.select("marker_id", "s"), ["marker_id", "s"], "left_anti")
        rows = rows.unionByName(every.withColumn("dosage", F.lit(0)), allowMissingColumns=True)
    copies = F.when(F.col("flipped"), 2 - F.col("dosage")).otherwise(F.col("dosage"))
    return (
        rows.join(members, "marker_id")
        .withColumn("dosage", copies)
        .where("dosage > 0")
        .groupBy("gene", "mask", "max_maf", "s")
        .agg(F.sum("dosage").alias("dosage"), F.min("chrom").alias("chrom"), F.min("pos").alias("pos"))
    )


def burden_markers(burden: DataFrame) -> DataFrame:
    """Burden rows as markers named gene:mask:limit, placed at position 0 of the gene."""
    return burden.select(
        "chrom",
        F.lit(0).cast("bigint").alias("pos"),
        F.concat_ws(":", "gene", "mask", F.col("max_maf").cast("string")).alias("marker_id"),
        "s",
        "dosage",
    )

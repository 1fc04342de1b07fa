from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from phenomill.functions import quantiles, ranks, scalar, stats
from phenomill.plans.registry import rounded


@pytest.mark.parametrize("limits", [{}, {"max_group_rows": 50}, {"max_group_rows": 50, "max_map_values": 10}])
def test_percentiles_of_every_tier(frame, limits):
    rng = random.Random(1)
    groups = {"hot": [rng.gauss(0, 1) for _ in range(4000)], "ties": [1.0] * 300 + [2.0] * 300, "one": [3.5], None: [1.0, 2.0, 4.0]}
    df = frame("k string, v double", *[(k, v) for k, vs in groups.items() for v in vs], ("empty", None))
    probs = [0.01, 0.25, 0.5, 0.99, 1.0]
    out = {r.k: r.pctl for r in quantiles.exact_percentiles(df, ["k"], "v", probs, **limits).collect()}
    for k, values in groups.items():
        assert out[k] == pytest.approx(np.quantile(values, probs).tolist(), abs=1e-12)
    assert out["empty"] is None


def test_ordered_prefix_over_many_partitions(frame):
    rows = [("a", i, 1 + i % 3) for i in range(500)] + [("b", 7, 2), ("c", 1, 1), ("c", 2, 5)]
    random.Random(2).shuffle(rows)
    df = frame("k string, v int, n int", *rows)
    out = ranks.ordered_prefix(df, ["k"], ["v"], "n", partitions=6).collect()
    assert len(out) == len(rows)
    seen = {}
    for r in sorted(out, key=lambda r: (r.k, r.v)):
        assert r["__before"] == seen.get(r.k, 0)
        seen[r.k] = r["__before"] + r.n
    assert {r.k: r["__total"] for r in out} == seen


def test_expand_counts(frame):
    df = frame("k string, n bigint", ("a", 7), ("b", 1))
    out = sorted((r.k, r.i) for r in ranks.expand_counts(df, "n", "i", chunk=3).collect())
    assert out == [("a", i) for i in range(7)] + [("b", 0)]


def test_top_n_per_group(frame):
    df = frame("k string, v int, id int", *[("a", (i * 7) % 100, i) for i in range(300)], ("b", 1, 1))
    out = ranks.top_n_per_group(df, ["k"], [F.col("v"), F.col("id")], 5, ["id"]).collect()
    best = sorted(((i * 7) % 100, i) for i in range(300))[:5]
    assert sorted((r.v, r.id) for r in out if r.k == "a") == best
    assert sum(r.k == "b" for r in out) == 1


def test_age_groups(frame):
    ages = [0, 29, 30, 89, 90, 200, 201, None, -1]
    df = frame("i int, a int", *enumerate(ages)).withColumn("g", scalar.age_group(F.col("a")))
    assert [r.g for r in df.orderBy("i").collect()] == ["18-29", "18-29", "30-39", "80-89", "90+", "90+", None, None, None]


def test_scalar_helpers(frame):
    df = frame("t string", ("495",), ("427.21",), ("phe_495",), ("RE_475",), (" 12 ",), (None,))
    out = df.select(scalar.prefix_numeric_code(F.col("t")).alias("p"), scalar.normalize_person_id(F.col("t")).alias("i")).collect()
    assert [r.p for r in out] == ["phe_495", "phe_427.21", "phe_495", "RE_475", " 12 ", None]
    assert [r.i for r in out] == [495, None, None, None, 12, None]
    lists = frame("t string", ("phe_495, RE_475",), ("4134857",), ("NaN",), ("a,, b",), (None,))
    assert [r[0] for r in lists.select(scalar.prefix_code_list(F.col("t"))).collect()] == [
        ["phe_495", "RE_475"], ["phe_4134857"], [], ["a", "b"], None,
    ]
    flags = frame("t string", (" Female ",), ("MALE",), ("",), (None,))
    assert [r[0] for r in flags.select(scalar.sex_flag(F.col("t"))).collect()] == ["female", "male", "FALSE", "FALSE"]
    names = frame("c string", ("3045440, 3023939",))
    assert names.select(scalar.notebook_name("lab", F.col("c"))).first()[0] == "measurement_3045440_3023939.ipynb"
    asked = frame("c string", ("Including yourself, who in your family has had Gout? Select all that apply.",))
    assert asked.select(scalar.survey_short_name(F.col("c"))).first()[0] == " gout? "


def test_pearson_p():
    # closed form for n = 4: the t distribution with two degrees of freedom
    for r in (0.1, 0.5, -0.9):
        t = abs(r) * math.sqrt(2 / (1 - r * r))
        assert stats.pearson_p(r, 4) == pytest.approx(1 - t / math.sqrt(2 + t * t), rel=1e-10)
    assert stats.pearson_p(1.0, 10) == 0.0
    assert math.isnan(stats.pearson_p(0.5, 2))


def brute_hwe(a, h, b):
    n, rare = a + h + b, 2 * min(a, b) + h

    def p(het):
        hom = (rare - het) // 2
        other = n - het - hom
        return math.exp(
            het * math.log(2) + math.lgamma(n + 1) - math.lgamma(hom + 1) - math.lgamma(het + 1) - math.lgamma(other + 1)
        )

    hets = range(rare % 2, rare + 1, 2)
    total, seen = sum(map(p, hets)), p(h)
    return sum(p(x) for x in hets if p(x) <= seen * (1 + 1e-9)) / total


def test_hwe_exact():
    for counts in [(57, 14, 50), (5, 10, 2), (0, 0, 9), (3, 0, 0), (1, 1, 1), (50, 0, 50), (90, 10, 0), (2, 30, 2)]:
        assert stats.hwe_exact(*counts) == pytest.approx(brute_hwe(*counts), rel=1e-9)
    assert stats.hwe_exact(5000, 0, 5000) < 1e-50


def test_scratch_is_removed(spark):
    import os

    from phenomill.session import remove_scratch, scratch_root, write_intermediate

    write_intermediate(spark.range(3), "gone")
    own = f"{scratch_root(spark)}/{spark.sparkContext.applicationId}"
    assert os.path.isdir(own)
    remove_scratch(spark)
    assert not os.path.exists(own)


def test_rounding_many_rows_gives_the_same_values(spark):
    rng = np.random.default_rng(5)
    ties = np.arange(-2000, 2000) / 1e6 + 5e-7
    odd = [0.0, -0.0, -1e-9, 4.9999999e-7, 5e-7, -5e-7, 0.0500005, 1e5 + 5e-7, 123456.7890125, 1e15 / 7, 1e300, math.inf, -math.inf, math.nan, None]
    values = [*rng.normal(size=3000), *(rng.normal(size=3000) * 1e4), *ties, *np.nextafter(ties, 1), *np.nextafter(ties, -1)]
    df = spark.createDataFrame([(None if v is None else float(v),) for v in [*values, *odd]], "x double").coalesce(1)
    both = rounded(rounded(df.withColumn("y", F.col("x")), "x"), "y", many=True).collect()
    assert len(both) == len(values) + len(odd)
    assert [repr(r.x) for r in both] == [repr(r.y) for r in both]

"""Distribution helpers and the experiment-design formulas."""

import math

import pytest

from reachlens.functions import numerics as N
from reachlens.operators import experiments as EX


def test_t_and_f_tails_against_known_values():
    assert N.t_sf_two_sided(2.0, 10) == pytest.approx(0.07338803, abs=1e-7)
    assert N.t_sf_two_sided(0.0, 5) == pytest.approx(1.0)
    assert N.t_cdf(1.812461, 10) == pytest.approx(0.95, abs=1e-6)
    assert N.t_ppf(0.975, 30) == pytest.approx(2.042272, abs=1e-5)
    assert N.f_sf(4.0, 1, 20) == pytest.approx(0.05926, abs=1e-4)
    # F(1, d) is the square of t(d)
    assert N.f_sf(2.5 ** 2, 1, 17) == pytest.approx(N.t_sf_two_sided(2.5, 17), abs=1e-10)
    assert N.norm_ppf(0.975) == pytest.approx(1.959964, abs=1e-6)


def test_power_grid_formula_and_monotonicity(spark):
    df = spark.createDataFrame([(1.2 + 0.8 * ((-1) ** i),) for i in range(200)], "x double")
    g = EX.power_grid(df, "x", None, mde_pcts=(0.05, 0.10, 0.30)).orderBy("mde_pct").collect()
    n = [r["n_per_group"] for r in g]
    assert n[0] > n[1] > n[2]
    assert all(r["total_n"] == 2 * r["n_per_group"] for r in g)
    # the reference defaults (baseline 1.2, mde 10 %, std 0.8) need 699 per group
    z_a, z_p = N.norm_ppf(0.975), N.norm_ppf(0.8)
    assert math.ceil(2 * ((z_a + z_p) / 0.15) ** 2 + z_a ** 2 / 4) == 699


def test_two_way_anova_detects_main_effects(spark):
    rows = []
    for a in (0, 1):
        for b in (0, 1):
            for i in range(60 + 10 * a):                    # unbalanced cells
                rows.append((a, b, 5000 + 800 * a + 600 * b + 400 * a * b + ((i * 37) % 101 - 50) * 30.0))
    df = spark.createDataFrame(rows, "a int, b int, y double")
    t = {r["term"]: r for r in EX.two_way_anova(df, "a", "b", "y").collect()}
    assert t["a"]["p_value"] < 0.05 and t["b"]["p_value"] < 0.05
    assert t["Residual"]["df"] == len(rows) - 4
    cm = EX.cell_means(df, "a", "b", "y").collect()
    assert len(cm) == 2 and len(cm[0]) == 3

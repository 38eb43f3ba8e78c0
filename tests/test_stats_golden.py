"""Golden values published with the reference (statistics phase) and invariants."""

import math

import pytest
from pyspark.sql import functions as F

from pyspark.sql import functions as F

from tabulon.functions.tails import chi2_sf, normal_two_sided
from tabulon.operators import stats as S

# Published observed counts (category → (y=0, y=1)) and test results
GOLDEN = {
    "gender": ({"Female": (329, 335), "Male": (185, 202)},
               0.29779934944166475, 1, 0.5852653313383369, 0.0),
    "education": ({"Primary education or less": (177, 109), "Secondary education": (317, 351),
                   "Tertiary education or more": (15, 72)},
                  54.76176546285046, 2, 1.2842031182025602e-12, 0.22523468778615663),
    "income_quintile": ({"Income quintile 1": (114, 69), "Income quintile 2": (98, 69),
                         "Income quintile 3": (105, 62), "Income quintile 4": (106, 117),
                         "Income quintile 5": (91, 220)},
                        80.75934365278002, 4, 1.2025922113229167e-16, 0.2703711800444604),
}


def _rows(counts):
    rows = []
    for cat, (n0, n1) in counts.items():
        rows += [(cat, 0, 1.0)] * n0 + [(cat, 1, 1.0)] * n1
    return rows


@pytest.mark.parametrize("dim", sorted(GOLDEN))
def test_chi_square_p_and_v_golden(spark, dim):
    counts, chi, dof, p, v = GOLDEN[dim]
    df = spark.createDataFrame(_rows(counts), "cat string, y int, w double")
    dims = [(dim, "cat", dim, tuple(counts))]
    tests = S.with_chi_p(S.chi_square_tests(S.contingency(df, {"y": "y"}, dims, "w"))).collect()
    assert len(tests) == 1
    t = tests[0]
    assert t.chi_square == pytest.approx(chi, rel=1e-10)
    assert t.degrees_freedom == dof
    assert t.p_value == pytest.approx(p, rel=1e-8)
    assert t.effect_size == pytest.approx(v, abs=1e-10)


def test_contingency_reconciles(spark):
    counts = GOLDEN["income_quintile"][0]
    df = spark.createDataFrame(_rows(counts), "cat string, y int, w double")
    cells = S.contingency(df, {"y": "y"}, [("inc", "cat", "inc", tuple(counts))], "w").collect()
    assert sum(c.observed_count for c in cells) == 1051
    assert sum(c.expected_count for c in cells) == pytest.approx(1051)


def test_bh_known_vector(spark):
    df = spark.createDataFrame([(i, "f", p) for i, p in enumerate([0.01, 0.04, 0.03, 0.002])],
                               "i int, fam string, p double")
    out = {r.i: r.adjusted_p_value for r in S.bh_adjust(df, ["fam"], "p").collect()}
    assert [round(out[i], 12) for i in range(4)] == [0.02, 0.04, 0.04, 0.008]


def test_bh_rejects_nan(spark):
    df = spark.createDataFrame([(1, "f", float("nan"))], "i int, fam string, p double")
    with pytest.raises(Exception):
        S.bh_adjust(df, ["fam"], "p").collect()


def test_tails(spark):
    """χ² and normal tails against closed forms and erfc, small p included."""
    rows = [(2.0, 2, math.exp(-1.0)), (3.841458820694124, 1, 0.05), (11.070497693516351, 5, 0.05), (0.0, 3, 1.0),
            (80.7593436528, 4, math.exp(-40.3796718264) * 41.3796718264), (900.0, 1, math.erfc(math.sqrt(450.0)))]
    df = spark.createDataFrame(rows, "x double, k int, p double")
    for r in df.select("p", chi2_sf(F.col("x"), F.col("k")).alias("q")).collect():
        assert r.q == pytest.approx(r.p, rel=1e-9)
    zs = [0.0, 0.3, -1.959963984540054, 3.5, 3.6, -9.0, 20.0]
    df = spark.createDataFrame([(z, math.erfc(abs(z) / math.sqrt(2))) for z in zs], "z double, p double")
    for r in df.select("p", normal_two_sided(F.col("z")).alias("q")).collect():
        assert r.q == pytest.approx(r.p, rel=1e-10)
    empty = spark.createDataFrame([(None, 1), (2.0, None), (2.0, 0)], "x double, k int")
    assert all(r[0] is None for r in empty.select(chi2_sf(F.col("x"), F.col("k"))).collect())


def test_mann_whitney_matches_brute_force(spark):
    import random
    rnd = random.Random(7)
    rows = [(rnd.randint(15, 30), rnd.random() < 0.5) for _ in range(300)]
    df = spark.createDataFrame([(float(a), int(y)) for a, y in rows], "age double, y int")
    r = S.mann_whitney(df, {"y": "y"}, "age").collect()[0]
    pos = [a for a, y in rows if y]
    neg = [a for a, y in rows if not y]
    u = sum((1.0 if a > b else 0.5 if a == b else 0.0) for a in pos for b in neg)
    assert r.u_statistic == pytest.approx(u)
    assert r.effect_size == pytest.approx(2 * u / (len(pos) * len(neg)) - 1)


def test_rank_biserial_published():
    assert 2 * 166023 / (537 * 514) - 1 == pytest.approx(0.2029867617329304, abs=1e-12)


def test_zero_margin_gives_null_statistic(spark):
    df = spark.createDataFrame([("a", 0, 1.0), ("b", 0, 1.0), ("b", 0, 1.0)], "cat string, y int, w double")
    t = S.chi_square_tests(S.contingency(df, {"y": "y"}, [("d", "cat", "d", ("a", "b"))], "w")).collect()[0]
    assert t.chi_square is None


def test_partition_count_invariance(spark):
    counts = GOLDEN["education"][0]
    df = spark.createDataFrame(_rows(counts), "cat string, y int, w double")
    dims = [("e", "cat", "e", tuple(counts))]
    a = S.chi_square_tests(S.contingency(df.repartition(1), {"y": "y"}, dims, "w")).collect()[0]
    b = S.chi_square_tests(S.contingency(df.repartition(7), {"y": "y"}, dims, "w")).collect()[0]
    assert a.chi_square == pytest.approx(b.chi_square, rel=1e-12)

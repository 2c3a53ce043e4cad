from pyspark.sql import functions as F

from foldwise.functions.stats import chi2_sf, kolmogorov_sf


def test_chi_square_tail_at_critical_values(spark):
    # 5 % critical values of the chi-square distribution for 1..4 degrees of freedom
    rows = [(3.841458820694124, 1), (5.991464547107979, 2), (7.814727903251178, 3), (9.487729036781154, 4)]
    df = spark.createDataFrame(rows, "x double, dof int")
    got = [r[0] for r in df.select(chi2_sf(F.col("x"), F.col("dof"))).collect()]
    assert all(abs(p - 0.05) < 1e-6 for p in got), got
    import math

    def true(x, k):  # finite sums, for whole dof
        h, odd = x / 2, k % 2
        return (math.erfc(math.sqrt(h)) if odd else 0.0) + sum(math.exp((j - odd / 2) * math.log(h) - h - math.lgamma(j - odd / 2 + 1)) for j in range(odd, (k + odd) // 2))
    many = [(x * k, k) for k in (1, 2, 30, 341, 342, 343, 400, 2000, 5000) for x in (0.65, 0.9, 1.0, 1.05, 1.25)] + [(1300.0, 2000), (500.0, 500)]
    got = [r[0] for r in spark.createDataFrame(many, "x double, dof int").select(chi2_sf(F.col("x"), F.col("dof"))).collect()]
    assert all(abs(p - true(x, k)) < 1e-9 for p, (x, k) in zip(got, many)), [(m, p, true(*m)) for p, m in zip(got, many) if abs(p - true(*m)) >= 1e-9]
    exact = [(2.0 * h, 2 * n, math.exp(-h) * sum(h**i / math.factorial(i) for i in range(n))) for h in (0.5, 3.0, 20.0, 60.0) for n in (1, 2, 10, 60)]
    got = [r[0] for r in spark.createDataFrame([e[:2] for e in exact], "x double, dof int").select(chi2_sf(F.col("x"), F.col("dof"))).collect()]
    assert all(abs(p - e[2]) < 1e-10 for p, e in zip(got, exact))
    edge = spark.createDataFrame([(0.0, 3), (2000.0, 2)], "x double, dof int")
    assert [r[0] for r in edge.select(chi2_sf(F.col("x"), F.col("dof"))).collect()] == [1.0, 0.0]


def test_kolmogorov_tail(spark):
    # Q(1.3581) ≈ 0.05 (the asymptotic 5 % point); Q(0) = 1
    df = spark.createDataFrame([(1.3580986393225505,), (0.0,), (0.001,), (0.005,), (0.3,), (1.1799999,), (1.1800001,), (3.0,)], "x double")
    got = [r[0] for r in df.select(kolmogorov_sf(F.col("x"))).collect()]
    assert abs(got[0] - 0.05) < 1e-6 and got[1:4] == [1.0, 1.0, 1.0]
    assert abs(got[4] - 0.99999069) < 1e-7 and abs(got[5] - got[6]) < 1e-6 and abs(got[7] - 2 * 2.718281828459045 ** -18) < 1e-12

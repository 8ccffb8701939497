import math
from decimal import Decimal

import pytest
from conftest import plan, tuples
from pyspark.sql import functions as F

from rushcart.operators import versions


def test_missing_and_zero_baselines_give_null(samples):
    rows = [
        ("V1", 1, 0, 0.0, False),
        ("V2", 1, 1, 5.0, False),
        ("V2", 2, 2, 5.0, False),
        ("V1", 3, 3, 2.0, True),
        ("V2", 3, 4, 3.0, False),
        ("V2", None, 5, 1.0, False),
    ]
    got = versions.version_compare(samples(rows), "V1")
    assert tuples(got.where("version = 'V2'"), "route", "p95", "base_p95", "p95_ratio") == [
        (1, 5.0, 0.0, None),
        (2, 5.0, None, None),
        (3, 3.0, 2.0, 1.5),
        (None, 1.0, None, None),
    ]
    # From 0 to 5 ms is a regression, too, although there is no ratio.
    assert tuples(versions.regressions(got, 0.4, 1), "version", "route") == [("V2", 1), ("V2", 3)]
    assert tuples(versions.regressions(got, 0.6, 1), "version", "route") == [("V2", 1)]
    assert versions.regressions(got, 0.4, 2).count() == 0


def test_one_row_has_no_rate_and_no_variance(samples):
    rows = [("V1", 1, 0, 1.0, False), ("V2", 1, 0, 2.0, False), ("V2", 1, 1, 4.0, True)]
    got = versions.version_summary(samples(rows))
    assert tuples(got, "version", "requests_per_s", "error_rate") == [("V1", None, 0.0), ("V2", 2.0, 0.5)]
    assert tuples(versions.welch(samples(rows), "V1", "V2"), "t", "dof") == [(None, None)]


def test_welch_by_hand(samples):
    rows = [("V1", 1, i, v, False) for i, v in enumerate([1.0, 2.0, 3.0])]
    rows += [("V2", 1, i, v, False) for i, v in enumerate([2.0, 4.0, 6.0, 8.0])]
    got = versions.welch(samples(rows), "V1", "V2", ["route"]).first()
    e1, e2 = 1 / 3, (20 / 3) / 4
    assert abs(got["t"] - (2 - 5) / (e1 + e2) ** 0.5) < 1e-12
    assert abs(got["dof"] - (e1 + e2) ** 2 / (e1**2 / 2 + e2**2 / 3)) < 1e-9


def test_welch_sees_differences_of_microseconds_and_far_from_zero(samples):
    def t(shift):
        rows = [("V1", 1, i, shift + v / 1000, False) for i, v in enumerate([1, 2, 3, 2, 1, 3])]
        rows += [("V2", 1, i, shift + v / 1000, False) for i, v in enumerate([4, 5, 4, 5, 4, 5])]
        return versions.welch(samples(rows), "V1", "V2").first()["t"]

    e1, e2 = 0.8 / 6, 0.3 / 6
    assert abs(t(0.0) - (2 - 4.5) / (e1 + e2) ** 0.5) < 1e-9
    assert abs(t(90_000.0) - t(0.0)) < 1e-6


def test_steps_follow_the_declared_order(samples):
    rows = [("V2", 1, 0, 8.0, False), ("V1", 1, 0, 4.0, False), ("V9", 1, 0, 4.0, False)]
    got = versions.version_steps(versions.version_summary(samples(rows)), ["V2", "V1"])
    assert tuples(got, "step", "from_version", "to_version", "p95_ratio") == [
        (1, None, "V2", None),
        (2, "V2", "V1", 0.5),
        (None, None, "V9", None),
    ]


def test_pivot_holds_the_long_form(samples):
    rows = [("V1", 1, 0, 8.0, False), ("V2", 1, 0, 4.0, False), ("V2", 2, 0, 3.0, False)]
    cells = versions.version_compare(samples(rows), "V1")
    got = versions.version_pivot(cells, ["V1", "V2"], ["p95"])
    assert tuples(got, "route", "V1", "V2") == [(1, 8.0, 4.0), (2, None, 3.0)]


def test_route_diff_equals_the_set_operations(samples):
    data = samples([("V1", 1, 0, 1.0, False), ("V1", 2, 0, 1.0, False), ("V2", 2, 0, 1.0, False), ("V2", 3, 0, 1.0, False)] * 2)
    a, b = (data.where(f"version = '{v}'").select("route") for v in ("V1", "V2"))
    got = versions.route_diff(data, "V1", "V2")
    for found, want in (("V1", a.subtract(b)), ("V2", b.subtract(a)), ("both", a.intersect(b))):
        assert tuples(got.where(f"found_in = '{found}'"), "route") == tuples(want, "route")


def test_runs_with_different_columns_stack(samples):
    data = samples([("V1", 1, 0, 1.0, True)])
    got = versions.combine_runs(data.drop("is_error"), data, data.drop("route"))
    assert tuples(got, "route", "is_error") == [(1, None), (1, True), (None, True)]


def exact_welch(one, other):
    from fractions import Fraction

    def side(values):
        x = [Fraction(math.floor(v * 1e9 + 0.5)) for v in values]
        mean = sum(x) / len(x)
        return mean, sum((v - mean) ** 2 for v in x) / (len(x) - 1) / len(x)

    (m1, e1), (m2, e2) = side(one), side(other)
    t = float(m1 - m2) / math.sqrt(float(e1 + e2))
    return t, float(e1 + e2) ** 2 / float(e1**2 / (len(one) - 1) + e2**2 / (len(other) - 1))


@pytest.mark.parametrize(
    "one, other",
    [
        ([i * 1e8 for i in range(1, 45)], [i * 1e8 + 5e7 for i in range(1, 45)]),
        ([i % 90 * 1e8 for i in range(2000)], [i % 90 * 1e8 + 3e6 for i in range(2000)]),
        ([4.294967295, 4.294967297, 4.294967296], [2.147483647, 2.147483649, 2.147483648]),
        ([0.000000001, 9e9, 4.5e9], [-3.5, 2.25, -1e9, 1e9]),
        ([10 + i * 1e-6 for i in range(50)], [10 + i * 2e-6 for i in range(50)]),
    ],
    ids=["far apart", "above 38 digits", "at limb borders", "signs", "close together"],
)
def test_welch_of_any_size(samples, one, other):
    rows = [("V1", 1, i, v, False) for i, v in enumerate(one)] + [("V2", 1, i, v, False) for i, v in enumerate(other)]
    got = versions.welch(samples(rows), "V1", "V2").first()
    t, dof = exact_welch(one, other)
    assert abs(got["t"] - t) <= 1e-9 * abs(t) and abs(got["dof"] - dof) <= 1e-9 * dof


def test_sums_beyond_38_digits_go_on_in_doubles(spark):
    """What 10^13 requests would add up to."""
    n, x = 10**13, 9 * 10**18
    high = (x + (1 << 31)) >> 32
    low = x - (high << 32)
    sums = [n // 2 * v for v in (high, low, high * high, high * low, low * low)]
    df = spark.createDataFrame([tuple(map(Decimal, sums))], ", ".join(f"{c} decimal(38,0)" for c in "abcde"))
    n_, low_ = F.lit(n).cast("decimal(20,0)"), F.lit(0).cast("long")
    r, q = versions._around(low_, n_, [F.col("a"), F.col("b")], [F.col("c"), F.col("d"), F.col("e")])
    got = df.select(r.alias("r"), q.alias("q")).first()
    assert abs(got["r"] / (n // 2 * x) - 1) < 1e-12 and abs(got["q"] / (n // 2 * x * x) - 1) < 1e-12


def test_welch_reads_its_rows_once(samples):
    text = plan(versions.welch(samples([("V1", 1, 0, 1.0, False)]), "V1", "V2", ["route"]))
    assert text.count("Scan") == 1 and "Join" not in text

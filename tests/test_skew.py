"""The distributed paths for large groups against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from habispark.operators import aggregates, numbering
from habispark.operators.quantiles import grouped_quantiles, segment_of
from habispark.operators.skew import slot_of


def skewed_rows(seed=7, n=4000):
    """One group holds a third of the rows, one has a NULL key, one a single repeated value."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        key = "hot" if i % 3 == 0 else rng.choice([None, "same", "a", "b", "c", "d"])
        value = 7.5 if key == "same" else round(rng.lognormvariate(5, 1), 2)
        rows.append((key, None if rng.random() < 0.05 else value, rng.choice([1, 1, 2, 5])))
    return rows


def expected(rows, p, weighted):
    groups = {}
    for key, value, weight in rows:
        groups.setdefault(key, []).extend([] if value is None else [value] * (weight if weighted else 1))
    return {k: float(np.percentile(v, 100 * p)) if v else None for k, v in groups.items()}


@pytest.mark.parametrize("weighted", [False, True])
def test_quantiles_of_hot_groups_are_exact(spark, weighted):
    rows = skewed_rows()
    df = spark.createDataFrame(rows, "k string, v double, w int")
    wanted = {"q1": ("v", 0.25), "q2": ("v", 0.5), "q3": ("v", 0.75), "least": ("v", 0.0), "most": ("v", 1.0)}
    result = grouped_quantiles(
        df, ["k"], wanted, {"n": (F.sum, F.lit(1))}, "w" if weighted else None
    ).collect()
    assert sorted(str(r.k) for r in result) == sorted({str(r[0]) for r in rows})
    for name, (_, p) in wanted.items():
        right = expected(rows, p, weighted)
        for r in result:
            assert r[name] == pytest.approx(right[r.k], rel=1e-12), (name, r.k)
    for r in result:
        assert r.n == sum(1 for x in rows if x[0] == r.k)


@pytest.mark.parametrize("segments", [1, 64, 4096])
def test_quantiles_have_the_bits_of_the_built_in(spark, monkeypatch, segments):
    from habispark.operators import quantiles

    monkeypatch.setattr(quantiles, "SEGMENTS", segments)
    rows = skewed_rows(3) + [("edge", v, 1) for v in (-3.5, -0.0, 0.0, 5e-324, 1e300, -1e300, float("inf"), 2.0)]
    df = spark.createDataFrame(rows, "k string, v double, w int").repartition(5)
    for weight in (None, "w"):
        wanted = {"a": ("v", 0.1), "b": ("v", 0.5), "c": ("v", 0.9)}
        mine = grouped_quantiles(df, ["k"], wanted, weight=weight).collect()
        frequency = F.lit(1) if weight is None else F.col("w")
        built_in = df.groupBy("k").agg(*[F.percentile("v", F.lit(p), frequency).alias(n) for n, (_, p) in wanted.items()]).collect()
        assert sorted(map(str, mine)) == sorted(map(str, built_in))


def test_segments_follow_the_order_of_values(spark):
    rng = random.Random(8)
    values = [0.0, -0.0, 5e-324, -5e-324, 1.7e308, -1.7e308, float("inf"), float("-inf")]
    values += [rng.choice([-1, 1]) * 2.0 ** rng.uniform(-1000, 1000) for _ in range(3000)]
    values += [x for v in (1.0, 2.0, 3.5, 1024.0) for x in (v, np.nextafter(v, 0), np.nextafter(v, 9e9))]
    df = spark.createDataFrame([(float(v),) for v in values] + [(float("nan"),)], "v double")
    ordered = [r.s for r in df.select("v", segment_of(F.col("v"), 64).alias("s")).orderBy("v", "s").collect()]
    assert ordered == sorted(ordered) and len(set(ordered)) > 1000


def test_rows_are_read_once_for_all_quantiles(spark):
    """The counted values are stored; ranks, values and extras come from there."""
    df = spark.createDataFrame(skewed_rows(), "k string, v double, w int")
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    table = grouped_quantiles(
        df.mapInArrow(count, df.schema), ["k"], {"a": ("v", 0.5), "b": ("w", 0.25)}, {"n": (F.sum, F.lit(1))}
    )
    assert table.count() == 7 and seen.value == df.count()


def test_group_without_values_keeps_its_row(spark):
    df = spark.createDataFrame([("x", None), ("x", None), ("y", 1.0)], "k string, v double")
    result = grouped_quantiles(df, ["k"], {"m": ("v", 0.5)}, {"n": (F.sum, F.lit(1))})
    assert sorted(tuple(r) for r in result.select("k", "n", "m").fillna(-1.0).collect()) == [
        ("x", 2, -1.0),
        ("y", 1, 1.0),
    ]


@pytest.mark.parametrize("slices", [1, 16, 4096])
def test_numbering_of_hot_groups(spark, monkeypatch, slices):
    monkeypatch.setattr(numbering, "SLICES", slices)
    rng = random.Random(5)
    order = list(range(5000))
    rng.shuffle(order)
    rows = [("hot" if i % 3 == 0 else rng.choice([None, "a", "b"]), i * i) for i in order]
    df = spark.createDataFrame(rows, "k string, o long").repartition(7)
    result = numbering.numbered(df, "k", [F.col("o")], F.col("o"), "n").collect()
    seen = {}
    right = {}
    for key, o in sorted(rows, key=lambda r: r[1]):
        right[o] = seen.get(key, 0)
        seen[key] = right[o] + 1
    assert {r.o: r.n for r in result} == right


def test_numbering_with_equal_positions(spark):
    """Positions only say where to cut, so many equal ones put all rows into one slice."""
    df = spark.range(2000).select(F.lit("k").alias("k"), F.col("id").alias("o"))
    result = numbering.numbered(df, "k", [F.col("o")], F.lit(1), "n")
    assert result.filter("n <> o").count() == 0 and result.count() == 2000


def test_prices_by_energy_class_with_repeated_certificates(spark):
    """Weighted rows must give what a plain join gives, for ordinary and for hot groups."""
    rng = random.Random(1)
    sales = [
        ("c", rng.choice(["Maison", "Appartement"]), float(rng.randint(50, 500)), 10.0, "n1" if i % 3 == 0 else f"n{i % 40}")
        for i in range(600)
    ]
    certificates = [(f"n{rng.choice([1, 1, 2, 3, 5, 8])}", rng.choice("ABGN")) for _ in range(200)]
    sold = spark.createDataFrame(
        sales, "code_commune string, type_local string, valeur_fonciere double, surface_reelle_bati double, dpe_numero string"
    )
    certified = spark.createDataFrame(certificates, "numero_dpe string, classe_dpe string")
    groups = {}
    for code, kind, price, surface, number in sales:
        for n, c in certificates:
            if n == number and c in "ABCDEFG":
                groups.setdefault((code, kind, c), []).append(price / surface)
    right = {k: (len(v), int(np.rint(np.percentile(v, 50)))) for k, v in groups.items()}
    rows = aggregates.prices_by_energy_class(sold, certified).collect()
    found = {(r.code_insee, r.type_local, r.classe_dpe): (r.nb_observations, r.prix_m2_median) for r in rows}
    assert found == right


def test_frequent_certificate_is_split_by_the_join(spark, small_skew_limits):
    hot = F.col("id") % 3 == 0
    sold = spark.range(0, 120_000, 1, 16).select(
        F.concat(F.lit("c"), F.col("id") % 50).alias("code_commune"),
        F.lit("Maison").alias("type_local"),
        (F.rand(2) * 1000 + 1).alias("valeur_fonciere"),
        F.lit(10.0).alias("surface_reelle_bati"),
        F.when(hot, -1).otherwise(F.col("id")).alias("dpe_numero"),
    )
    # The frequent certificate is repeated as often as it is used: 40,000 times 40,000 pairs.
    certified = spark.range(0, 120_000, 1, 16).select(
        F.when(hot, -1).otherwise(F.col("id")).alias("numero_dpe"), F.lit("A").alias("classe_dpe")
    )
    rows = aggregates.prices_by_energy_class(sold, certified).collect()
    assert sum(r.nb_observations for r in rows) == 40_000 * 40_000 + 80_000
    matched = aggregates.matched_prices(sold, certified)
    matched.collect()
    assert "skew=true" in matched._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("slots", [2, 8, 64])
def test_slots_by_binary_search(spark, slots):
    rng = random.Random(slots)
    edges = sorted(float(rng.randint(0, 40)) for _ in range(slots - 1))
    values = [float(v) for v in range(-2, 44)]
    df = spark.createDataFrame([(edges, v) for v in values], "edges array<double>, v double")
    found = [r.s for r in df.select(slot_of("edges", "v", slots).alias("s")).collect()]
    assert found == [int(x) for x in np.searchsorted(edges, values, side="left")]


def shuffled_rows(df):
    """Rows that the shuffles of a frame write when it is computed."""
    df.collect()
    plans, rows = [df._jdf.queryExecution().executedPlan()], 0
    while plans:
        plan = plans.pop()
        kind = plan.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            plans.append(plan.executedPlan())
        elif kind.endswith("QueryStageExec"):
            plans.append(plan.plan())
        elif kind != "ReusedExchangeExec":
            if kind == "ShuffleExchangeExec":
                rows += plan.metrics().apply("shuffleRecordsWritten").value()
            plans += [plan.children().apply(i) for i in range(plan.children().size())]
    return rows


def test_values_of_small_groups_are_shuffled_twice(spark, monkeypatch):
    """Once to count them by segment and once to rank the segments; before, each of them went five times."""
    from habispark.operators import quantiles

    shuffled, store = [], quantiles.written
    monkeypatch.setattr(quantiles, "written", lambda df, label: shuffled.append(shuffled_rows(df)) or store(df, label))
    df = spark.range(0, 12_000, 1, 8).select(
        (F.col("id") % 3000).alias("k"), (F.rand(4) * 1000 + 1).alias("a"), (F.rand(5) * 1000 + 1).alias("b"), F.rand(6).alias("c")
    )
    wanted = {"q1": ("a", 0.5), "q2": ("b", 0.25), "q3": ("b", 0.5), "q4": ("c", 0.5)}
    table = grouped_quantiles(df, ["k"], wanted, {"n": (F.sum, F.lit(1))})
    values = 3 * 12_000
    assert sum(shuffled) + shuffled_rows(table) < 2.2 * values
    built_in = df.groupBy("k").agg(F.count(F.lit(1)).alias("n"), *[F.percentile(v, F.lit(p)).alias(name) for name, (v, p) in wanted.items()])
    assert sorted(map(str, table.collect())) == sorted(map(str, built_in.collect()))


@pytest.mark.parametrize("segments", [1, 64, 1024])
def test_groups_of_all_sizes_and_kinds_of_values(spark, monkeypatch, segments):
    """Groups of 1 to 600 rows, close values, several keys that may be NULL, NaN and zeros of both signs."""
    from habispark.operators import quantiles

    monkeypatch.setattr(quantiles, "SEGMENTS", segments)
    rng = random.Random(segments)
    odd = [0.0, -0.0, float("nan"), float("inf"), float("-inf"), None]
    rows = []
    for g, size in enumerate([1, 1, 2, 3, 4, 5, 8, 13, 40, 200, 600]):
        for _ in range(size):
            close = 1000 + rng.randint(0, 3 * size) / 64
            rows.append((rng.choice([None, "x"]), None if g == 3 else g, close, rng.choice([*odd, close, -close]), rng.choice([None, 1, 7])))
    df = spark.createDataFrame(rows, "k string, g int, v double, u double, extra int").repartition(6)
    wanted = {"v": ("v", 0.5), "v3": ("v", 0.75), "u": ("u", 0.5), "u1": ("u", 0.1)}
    mine = grouped_quantiles(df, ["g", "k"], wanted, {"s": (F.sum, F.col("extra")), "m": (F.max, F.col("extra"))})
    built_in = df.groupBy("g", "k").agg(
        F.sum("extra").alias("s"), F.max("extra").alias("m"), *[F.percentile(v, F.lit(p)).alias(n) for n, (v, p) in wanted.items()]
    )
    # Equal values are one here, so a zero has no sign.
    assert sorted(map(str, mine.collect())) == sorted(str(r).replace("=-0.0", "=0.0") for r in built_in.collect())


def test_frequent_group_is_split_when_its_values_are_looked_up(spark, small_skew_limits):
    """A third of the rows are one group, with several values in each segment."""
    df = spark.range(0, 240_000, 1, 16).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id") % 20_000).alias("k"), (F.rand(2) * 1000 + 1).alias("v")
    )
    table = grouped_quantiles(df, ["k"], {"m": ("v", 0.5)})
    rows = {r.k: r.m for r in table.collect()}
    assert rows == {r.k: r.m for r in df.groupBy("k").agg(F.percentile("v", F.lit(0.5)).alias("m")).collect()}
    assert "skew=true" in table._jdf.queryExecution().executedPlan().toString()

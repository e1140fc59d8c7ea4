"""Group statistics whose ties and gaps matter, and inference over score rows."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import kernels as K


def modal(rows: DataFrame, keys: list[str], value: str, *ties: Column | str) -> DataFrame:
    """The most frequent value of each key; equals are settled by the tie columns, ascending, which see value, n and first_at.

    An aggregate of aggregates: a key with any number of distinct values costs a row a task.
    """
    counted = rows.groupBy(*keys, value).agg(F.count("*").alias("n"), *([F.min("position").alias("first_at")] if "position" in rows.columns else []))
    own = [c for c in counted.columns if c not in keys]
    best = F.min_by(F.struct(*own), F.struct(-F.col("n"), *(ties or (F.col(value),))))
    return counted.groupBy(*keys).agg(best.alias("_best")).select(*keys, *[F.col(f"_best.{c}").alias(c) for c in own])


def entropy(rows: DataFrame, key: str, value: str) -> DataFrame:
    """Distinct values, modal share, entropy in nats and over its largest possible value."""
    counted = rows.groupBy(key, value).agg(F.count("*").alias("n"))
    p = F.col("n") / F.sum("n").over(Window.partitionBy(key))
    out = counted.withColumn("p", p).groupBy(key).agg(F.sum("n").alias("n"), F.count("*").alias("n_distinct"), F.max("p").alias("modal_share"), (-F.sum(F.col("p") * F.log("p"))).alias("entropy"))
    return out.withColumn("entropy_norm", F.when(F.col("n") > 1, F.col("entropy") / F.log("n")).otherwise(0.0))


def _bin(value: str, low: str, high: str, n: int) -> Column:
    """One of n equal ranges of [low, high], so that a sort is split into as many tasks."""
    share = F.try_divide(F.col(value) - F.col(low), F.col(high) - F.col(low))
    return F.least(F.lit(n - 1), F.floor(F.coalesce(share, F.lit(0.0)) * n)).cast("int")


def rank_p90(rows: DataFrame, key: str, value: str, bins: int = 4096) -> DataFrame:
    """The element of rank int(0.9 n) (at least 1) of the sorted values, without interpolation.

    Counts of value ranges tell in which one the rank lies; only its rows are sorted.
    """
    x = rows.where(F.col(value).isNotNull()).select(key, F.col(value).alias("_v"))
    ends = x.groupBy(key).agg(F.min("_v").alias("_lo"), F.max("_v").alias("_hi"), F.count("*").alias("_n"))
    x = x.join(ends, key).select(key, "_v", "_n", _bin("_v", "_lo", "_hi", bins).alias("_b"))
    w = Window.partitionBy(key).orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)  # a key's ranges: `bins` at most
    upto = x.groupBy(key, "_b").agg(F.count("*").alias("_c"), F.max("_n").alias("_n")).withColumn("_upto", F.sum("_c").over(w))
    want = F.greatest(F.lit(1), F.floor(F.col("_n") * 9 / 10))
    target = upto.select(key, "_b", (want - (F.col("_upto") - F.col("_c"))).alias("_want"), "_c").where("_want BETWEEN 1 AND _c")
    inside = x.select(key, "_v", "_b").join(target, [key, "_b"]).withColumn("_r", F.row_number().over(Window.partitionBy(key).orderBy("_v")))
    return inside.where("_r = _want").select(key, F.col("_v").alias("p90"))


def macro_mean(rows: DataFrame, outer: list[str], inner: str, value: str) -> DataFrame:
    """Mean over `inner` groups of their means."""
    return rows.groupBy(*outer, inner).agg(F.avg(value).alias("m")).groupBy(*outer).agg(F.avg("m").alias("macro_mean"), F.count("*").alias("n_groups"))


def variance_components(rows: DataFrame, family: str, component: str, value: str) -> DataFrame:
    """Unbalanced two-fold nested analysis of variance as one row: mean squares, coefficients, components, ICCs."""
    x = rows.where(F.col(value).isNotNull() & ~F.isnan(value)).select(F.col(family).alias("f"), F.col(component).alias("c"), F.col(value).cast("double").alias("x"))
    comp = x.groupBy("f", "c").agg(F.count("*").cast("double").alias("n"), F.avg("x").alias("m"), (F.var_pop("x") * F.count("*")).alias("ss"))
    fam = comp.groupBy("f").agg(F.sum("n").alias("nf"), (F.sum(F.col("n") * F.col("m")) / F.sum("n")).alias("mf"), F.count("*").alias("cf"), F.sum("ss").alias("ss"), F.sum(F.col("n") * F.col("n")).alias("n2"), F.sum(F.col("n") * F.col("m") * F.col("m")).alias("nm2"))
    one = fam.agg(
        F.count("*").alias("a"), F.sum("cf").alias("b"), F.sum("nf").alias("n"), F.sum("ss").alias("ss_unit"),
        F.sum(F.col("nm2") - F.col("nf") * F.col("mf") * F.col("mf")).alias("ss_comp"),
        (F.sum(F.col("nf") * F.col("mf") * F.col("mf")) - F.pow(F.sum(F.col("nf") * F.col("mf")), F.lit(2)) / F.sum("nf")).alias("ss_fam"),
        F.sum(F.col("n2") / F.col("nf")).alias("s1"), F.sum("n2").alias("s2"), F.sum(F.col("nf") * F.col("nf")).alias("s3"),
    )
    k1 = (F.col("n") - F.col("s1")) / (F.col("b") - F.col("a"))
    k2 = (F.col("s1") - F.col("s2") / F.col("n")) / (F.col("a") - 1)
    k3 = (F.col("n") - F.col("s3") / F.col("n")) / (F.col("a") - 1)
    one = one.withColumns({"ms_family": F.col("ss_fam") / (F.col("a") - 1), "ms_component": F.col("ss_comp") / (F.col("b") - F.col("a")), "ms_unit": F.col("ss_unit") / (F.col("n") - F.col("b")), "k1": k1, "k2": k2, "k3": k3})
    unit = F.col("ms_unit")
    comp_v = F.greatest((F.col("ms_component") - unit) / F.col("k1"), F.lit(0.0))
    one = one.withColumns({"var_unit": unit, "var_component": comp_v})
    one = one.withColumn("var_family", F.greatest((F.col("ms_family") - unit - F.col("k2") * F.col("var_component")) / F.col("k3"), F.lit(0.0)))
    total = F.col("var_unit") + F.col("var_component") + F.col("var_family")
    return one.select("a", "b", F.col("n").cast("long").alias("n"), "ms_family", "ms_component", "ms_unit", "k1", "k2", "k3", "var_family", "var_component", "var_unit", F.try_divide("var_family", total).alias("icc_family"), F.try_divide(F.col("var_family") + F.col("var_component"), total).alias("icc_component"))


def paired(scores: DataFrame, keys: list[str], arm: str, value: str, a: str, b: str) -> DataFrame:
    """Keys that both arms have, with the means a, b and delta a - b."""
    own = lambda x: F.avg(F.when(F.col(arm) == x, F.col(value)))
    out = scores.where(F.col(arm).isin(a, b)).groupBy(*keys).agg(own(a).alias("a"), own(b).alias("b")).where("a IS NOT NULL AND b IS NOT NULL")
    return out.withColumn("delta", F.col("a") - F.col("b"))


def holm(tests: DataFrame, p: str = "p", order: str = "test") -> DataFrame:
    """Holm's step-down: (n - rank + 1) p, at most 1, never below the one before. A NaN p stays NaN and isn't counted."""
    real = tests.where(F.col(p).isNotNull() & ~F.isnan(p))
    w = Window.orderBy(p, order)  # one family: some dozens of tests
    stepped = real.withColumn("_n", F.count("*").over(Window.partitionBy())).withColumn("_s", F.least(F.lit(1.0), (F.col("_n") - F.row_number().over(w) + 1) * F.col(p)))
    out = stepped.withColumn("p_holm", F.max("_s").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_n", "_s")
    return out.unionByName(tests.where(F.isnan(p)).withColumn("p_holm", F.lit(float("nan"))))


def kappa(rows: DataFrame, a: str, b: str) -> DataFrame:
    """Agreement, chance agreement and Cohen's kappa of two 0/1 raters; null where chance agreement is 1."""
    n = F.count("*")
    po, pa, pb = F.avg((F.col(a) == F.col(b)).cast("double")), F.avg(F.col(a).cast("double")), F.avg(F.col(b).cast("double"))
    out = rows.where(F.col(a).isNotNull() & F.col(b).isNotNull()).agg(n.alias("n"), po.alias("po"), (pa * pb + (1 - pa) * (1 - pb)).alias("pe"))
    return out.withColumn("kappa", F.when(F.col("pe") < 1, (F.col("po") - F.col("pe")) / (1 - F.col("pe"))))


def threshold_sweep(pairs: DataFrame, score: str, positive: str, thresholds: list[float]) -> DataFrame:
    """Counts and rates at each threshold; one pass over the pairs, each row adding to every threshold's sums."""
    rows = pairs.select(F.explode(F.array(*[F.lit(float(t)) for t in thresholds])).alias("threshold"), score, positive)
    hit = F.col(score) >= F.col("threshold")
    out = rows.groupBy("threshold").agg(F.count_if(hit & F.col(positive)).alias("tp"), F.count_if(hit & ~F.col(positive)).alias("fp"), F.count_if(~hit & ~F.col(positive)).alias("tn"), F.count_if(~hit & F.col(positive)).alias("fn"))
    out = out.withColumns({"tpr": F.try_divide(F.col("tp").cast("double"), F.col("tp") + F.col("fn")), "tnr": F.try_divide(F.col("tn").cast("double"), F.col("tn") + F.col("fp"))})
    return out.withColumn("balanced", (F.col("tpr") + F.col("tnr")) / 2)


def inversions(pairs: DataFrame, score: str, positive: str, bins: int = 4096) -> DataFrame:
    """How many (positive, negative) pairs are in the wrong order, or tied, by cumulative counts rather than pairs.

    Scores are cut into equal ranges: negatives above a score are those of higher ranges and those above it in its own.
    """
    at = pairs.groupBy(F.col(score).alias("_s")).agg(F.count_if(positive).alias("p"), F.count_if(~F.col(positive)).alias("n"))
    ends = at.agg(F.min("_s").alias("_lo"), F.max("_s").alias("_hi"))
    at = at.join(F.broadcast(ends)).withColumn("_b", _bin("_s", "_lo", "_hi", bins))  # ends is one row
    w = Window.orderBy(F.desc("_b")).rowsBetween(Window.unboundedPreceding, -1)  # `bins` rows at most
    higher = at.groupBy("_b").agg(F.sum("n").alias("_c")).select("_b", F.coalesce(F.sum("_c").over(w), F.lit(0)).alias("_higher"))
    own = F.coalesce(F.sum("n").over(Window.partitionBy("_b").orderBy(F.desc("_s")).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    above = at.withColumn("_own", own).join(F.broadcast(higher), "_b").withColumn("_n", F.col("_own") + F.col("_higher"))
    out = above.agg(F.sum(F.col("p") * F.col("_n")).alias("inverted"), F.sum(F.col("p") * F.col("n")).alias("tied"), (F.sum("p") * F.sum("n")).alias("n_pairs"))
    return out.withColumn("separability", 1 - (F.col("inverted") + F.col("tied") / 2) / F.col("n_pairs"))


def noise_pairs(rows: DataFrame, cluster: str, unit: str, repeat: str, value: str) -> DataFrame:
    """Units that every repeat of their cluster has, with the mean absolute difference over pairs of repeats."""
    one = rows.groupBy(cluster, unit, repeat).agg(F.avg(value).alias("v"))
    need = one.groupBy(cluster).agg(F.count_distinct(repeat).alias("need"))
    full = one.groupBy(cluster, unit).agg(F.count("*").alias("have"), F.sort_array(F.collect_list("v")).alias("v")).join(need, cluster).where("have = need AND have > 1")
    # over sorted values the sum over pairs is linear: sum of (2k - n + 1) v_k
    total = F.aggregate(F.transform("v", lambda x, k: (2 * k - F.size("v") + 1) * x), F.lit(0.0), lambda s, x: s + x)
    return full.select(cluster, unit, F.col("have").alias("n_repeats"), (total / (F.col("have") * (F.col("have") - 1) / 2)).alias("noise"))


def _rows(df: DataFrame, fn: Callable, schema: str) -> DataFrame:
    """The rows that fn(row) yields as tuples, in Arrow batches."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    kind = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                out = list(fn(row))
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], f.type) for k, f in enumerate(kind)], schema=kind)

    return df.mapInArrow(run, schema)


def cluster_bootstrap(scores: DataFrame, arm: str, cluster: str, value: str, n_boot: int = 10_000, seed: int = 17, level: float = 0.95, part_rows: int = 4096, draws: int = 50) -> DataFrame:
    """(arm, point, low, high): mean of cluster means and a bias-corrected percentile interval of a two-stage resample.

    Each block of `draws` draws has seeds of its own, so blocks spread over tasks. In a draw, how often
    a cluster is picked, how many of its rows then come from each of its parts (of about part_rows rows), and
    the rows in a part are drawn in turn, each from the count before, so that a task needs one part only. A part
    meets all its counts at once, and what parts of one task add to an arm's draws is added up there.
    """
    x = scores.where(F.col(value).isNotNull()).select(F.col(arm).alias("arm"), F.col(cluster).alias("cluster"), F.col(value).cast("double").alias("x"))
    w = Window.partitionBy("arm")
    clusters = x.groupBy("arm", "cluster").agg(F.count("*").alias("n"), F.avg("x").alias("m")).withColumn("i", F.row_number().over(w.orderBy("cluster")) - 1)
    arms = clusters.groupBy("arm").agg(F.count("*").alias("k"), F.avg("m").alias("point"))
    arms = arms.withColumn("a", F.row_number().over(Window.orderBy("arm")))  # some arms, one row each
    numbers = clusters.alias("c").join(arms.alias("r"), F.expr("c.arm <=> r.arm")).select("c.arm", "cluster", "n", "i", "a")
    # equal values lie in one part with their count, so that parts depend on the values only
    own = x.groupBy("arm", "cluster", "x").agg(F.count("*").alias("c")).alias("x").join(numbers.alias("c"), F.expr("x.arm <=> c.arm AND x.cluster <=> c.cluster"))
    own = own.withColumn("part", F.pmod(F.xxhash64("x.x"), F.ceil(F.col("n") / part_rows)).cast("int"))
    parts = own.groupBy("a", "i", "n", "part").agg(F.sum("c").alias("size"), F.sort_array(F.collect_list(F.struct(F.col("x.x").alias("x"), "c"))).alias("v"))
    sizes = parts.groupBy("a", "i", "n").agg(F.sort_array(F.collect_list(F.struct("part", "size"))).alias("sizes"))

    def block(row) -> int:
        return min(draws, n_boot - row["block"] * draws)

    def pick(row):
        k, size = row["k"], block(row)
        got = np.random.default_rng([seed, 1, row["block"]]).integers(0, k, (size, k)) + np.arange(size)[:, None] * k
        times = np.bincount(got.ravel(), minlength=size * k).reshape(size, k)
        for i in np.flatnonzero(times.any(0)).tolist():
            yield row["a"], k, row["block"], i, times[:, i]

    def deal(row):
        size = np.array([s["size"] for s in row["sizes"]], np.int64)
        took = np.random.default_rng([seed, 2, row["block"], row["i"]]).multinomial(np.array(row["times"]) * row["n"], size / size.sum())
        for j, s in enumerate(row["sizes"]):
            yield row["a"], row["i"], s["part"], row["block"], row["n"] * row["k"], took[:, j]

    def draw(own: pa.Table, counts: pa.Table) -> pa.Table:
        sums = np.zeros(n_boot)
        if own.num_rows and counts.num_rows:
            took, v = np.zeros(n_boot, np.int64), own["v"].combine_chunks().flatten()
            for at, n in zip(counts["block"].to_pylist(), counts["took"].to_pylist(), strict=True):
                took[at * draws : at * draws + len(n)] = n
            rng = np.random.default_rng([seed, 3, own["i"][0].as_py(), own["part"][0].as_py()])
            sums = K.resampled_sums(v.field("x").to_numpy(zero_copy_only=False), v.field("c").to_numpy(zero_copy_only=False), took, rng) / counts["share"][0].as_py()
        return pa.table({"a": own["a"][:1].cast(pa.int32()), "sums": pa.array([sums.tolist()] * min(own.num_rows, 1), pa.list_(pa.float64()))})

    def total(batches):
        sums: dict[int, np.ndarray] = {}

        def flush():
            out = pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([x.tolist() for x in sums.values()], pa.list_(pa.float64()))], ["a", "sums"])
            sums.clear()
            return out

        for batch in batches:
            for a, x in zip(batch["a"].to_pylist(), batch["sums"], strict=True):
                sums[a] = sums.get(a, 0.0) + x.values.to_numpy()
                if len(sums) > 64:
                    yield flush()
        yield flush()

    blocks = arms.select("a", "k", F.explode(F.sequence(F.lit(0), F.lit((n_boot - 1) // draws))).alias("block"))
    spread = scores.sparkSession.conf.get("spark.sql.shuffle.partitions")
    picked = _rows(blocks.repartition(int(spread), "a", "block"), pick, "a int, k long, block int, i int, times array<long>")
    dealt = _rows(picked.join(sizes, ["a", "i"]), deal, "a int, i int, part int, block int, share long, took array<long>")
    key = ["a", "i", "part"]
    # a set number, as the runtime would join small exchanges into one task
    split = lambda x: x.repartition(int(spread), *key).groupBy(*key)
    drawn = split(parts.select(*key, "v")).cogroup(split(dealt)).applyInArrow(draw, "a int, sums array<double>").mapInArrow(total, "a int, sums array<double>")
    means = drawn.select("a", F.posexplode("sums").alias("nth", "s")).groupBy("a", "nth").agg(F.sum("s").alias("mean"))
    # n_boot numbers an arm
    all_draws = means.groupBy("a").agg(F.sort_array(F.collect_list("mean")).alias("draws")).join(arms, "a")

    def interval(row):
        yield (row["a"], row["point"], *(K._bias_corrected(row["point"], row["draws"], level) if row["point"] == row["point"] else (row["point"],) * 2))

    ends = _rows(all_draws.select("a", "point", "draws"), interval, "a int, point double, low double, high double")
    return ends.join(arms.select("a", F.col("arm").alias(arm)), "a").select(arm, "point", "low", "high")

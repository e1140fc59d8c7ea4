"""Deterministic choices: subsets, seeds, top-k across groups, latest and first wins, renumbering."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def even_split(rows: DataFrame, keys: list[str], order: list[str], k: int) -> DataFrame:
    """k evenly spaced rows of each group: those of rank floor(i n / k); all where k >= n."""
    w = Window.partitionBy(*keys)
    r, n = F.row_number().over(w.orderBy(*order)) - 1, F.count("*").over(w)
    ranked = rows.withColumns({"_r": r, "_n": n})
    # rank r is floor(i n / k) for i = ceil(r k / n)
    i = F.ceil(F.col("_r") * k / F.col("_n"))
    return ranked.where((F.col("_n") <= k) | ((i < k) & (F.floor(i * F.col("_n") / k) == F.col("_r")))).drop("_r", "_n")


def hash_seeds(rows: DataFrame, keys: list[str], parts: list[Column], k: int, seed: int = 1729) -> DataFrame:
    """The k rows of each group whose SHA-256 of 'seed:part:part' sorts first."""
    h = F.sha2(F.concat_ws(":", F.lit(str(seed)), *[p.cast("string") for p in parts]), 256)
    ranked = rows.withColumn("seed_hash", h).withColumn("seed_rank", F.row_number().over(Window.partitionBy(*keys).orderBy("seed_hash")))
    return ranked.where(F.col("seed_rank") <= k)


def round_robin(rows: DataFrame, group: str, order: list, k: int) -> DataFrame:
    """The best of each group, then the second best of each, until k rows are taken."""
    turn = F.row_number().over(Window.partitionBy(group).orderBy(*order))
    # each group's turns beyond k can't be among the first k
    ranked = rows.withColumn("turn", turn).where(F.col("turn") <= k)
    return ranked.orderBy("turn", group).limit(k)


def nearest_median(rows: DataFrame, key: str, name: str, value: str) -> DataFrame:
    """For each key the row whose value is nearest to the median, the smaller name of equals."""
    mid = rows.groupBy(key).agg(F.median(value).alias("mid"))
    best = F.min(F.struct(F.abs(F.col(value) - F.col("mid")).alias("gap"), F.col(name).alias("name")))
    return rows.join(mid, key).groupBy(key).agg(best.alias("b"), F.count("*").alias("n")).select(key, F.col("b.name").alias(name), F.col("b.gap").alias("gap"), "n")


def latest_wins(rows: DataFrame, keys: list[str], line: str, failed: Column) -> DataFrame:
    """The last row of each key, but an error never replaces a success."""
    w = Window.partitionBy(*keys).orderBy(failed.asc(), F.desc(line))
    return rows.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def first_wins(rows: DataFrame, keys: list[str], line: str) -> DataFrame:
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(line))).where("_n = 1").drop("_n")


def renumber(rows: DataFrame, old: str, new: str = "new_id") -> DataFrame:
    """(old, new): ranks of the distinct ids from 0, without a single-task sort.

    Ids are range-partitioned; each partition numbers its own and adds what the ones before hold.
    """
    ids = rows.select(old).distinct().repartitionByRange(old).sortWithinPartitions(old).withColumn("_p", F.spark_partition_id())
    sizes = ids.groupBy("_p").count()
    before = F.coalesce(F.sum("count").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # a row a partition
    at = F.row_number().over(Window.partitionBy("_p").orderBy(old)) - 1
    return ids.join(F.broadcast(sizes.select("_p", before.alias("_b"))), "_p").select(old, (F.col("_b") + at).cast("long").alias(new))


def translate(rows: DataFrame, index: DataFrame, local: str, original: str) -> tuple[DataFrame, DataFrame]:
    """rows with `original` instead of `local`, and the rows whose local id the index lacks."""
    return rows.join(index, local).drop(local), rows.join(index, local, "left_anti")


def injective(index: DataFrame, a: str, b: str) -> DataFrame:
    """One row: how many pairs, whether a determines b and b determines a."""
    pairs = index.select(a, b).distinct()
    n = F.count("*")
    return pairs.agg(n.alias("n_pairs"), (F.count_distinct(a) == n).alias("a_unique"), (F.count_distinct(b) == n).alias("b_unique"))


def slices(rows: DataFrame, keys: list[str], order: list, ends: int, middle: int) -> DataFrame:
    """The first `ends` (worst), the last `ends` (best) and the middle `middle` rows of each key, with a `slice` column."""
    w = Window.partitionBy(*keys)
    ranked = rows.withColumns({"_k": F.row_number().over(w.orderBy(*order)), "_n": F.count("*").over(w)})
    first = F.floor((F.col("_n") + 1 - middle) / 2)
    inside = (F.col("_k") > first) & (F.col("_k") <= first + middle) if middle > 1 else F.col("_k") == F.floor((F.col("_n") + 1) / 2)
    return ranked.withColumn("slice", F.when(F.col("_k") <= ends, "worst").when(F.col("_k") > F.col("_n") - ends, "best").when(inside, "median")).where("slice IS NOT NULL").drop("_k", "_n")


def seed_split(rows: DataFrame, keys: list[str], episode: str, seeds: int, evals: int) -> DataFrame:
    """The lowest ids of each key as seeds, the next ones as evaluation, with a `split` column."""
    k = F.row_number().over(Window.partitionBy(*keys).orderBy(episode))
    return rows.withColumn("_k", k).where(F.col("_k") <= seeds + evals).withColumn("split", F.when(F.col("_k") <= seeds, "seed").otherwise("eval")).drop("_k")


def length_quantiles(rows: DataFrame, keys: list[str], order: list, n: int) -> DataFrame:
    """The rows at ranks i / (n - 1) of each key, ends included, each once."""
    w = Window.partitionBy(*keys)
    ranked = rows.withColumns({"_k": F.row_number().over(w.orderBy(*order)) - 1, "_n": F.count("*").over(w)})
    wanted = F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.rint(i * (F.col("_n") - 1) / max(n - 1, 1)).cast("int"))
    return ranked.where(F.array_contains(wanted, F.col("_k"))).drop("_k", "_n")

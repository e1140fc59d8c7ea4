"""Mixing sources to target weights by Poisson replication, in native columns.

A source's target share of the budget over its own size gives the mean number of
times each of its documents should be seen. A document's count is the inverse of
the Poisson distribution of that mean at a uniform number hashed from the seed
and its doc_id: the same on every run, whatever the partitioning. Each document
is repeated by its count and all copies are put in one global order by a hash.

A mean above `step` is split into equal parts of at most `step`, each with a
hashed number of its own (a sum of Poisson counts is Poisson), so distribution
tables stay short and exp(-mean) never underflows.

Sizes are summed partially before the shuffle, so a source with a third of all
rows costs a row a task; the table of means has one row a source. It is broadcast
when it has at most `broadcast_rows` rows (about half a KB each); beyond that only the
means of frequent sources are (spread_join), and the rest is joined by a shuffle. Copies
go to partitions by the first bits of their hash, which is uniform, and are
sorted in them: one pass gives the global order, and it has no hot range.

Defined cases: a null size counts 0; a null source is a source of its own; sources without
a weight, or with weight 0, contribute nothing, and where weights is None every
source gets the same; rows that repeat a doc_id repeat alike; a null doc_id hashes as 'null'; an empty table
gives no rows; the columns of docs stay, whatever their names: where one is called
`copy` or `mix_key`, the new column's name gets underscores until it is free.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .rounds import numbered, spread_join, written

_SCALE = float(1 << 52)


def uniform(seed: int, *parts: Column) -> Column:
    """A number in [0, 1) from the first 52 bits of an MD5 hash."""
    text = F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts])
    return _bits(F.md5(text))


def poisson_table(mean: Column, length: int) -> Column:
    """P(count <= k) for k = 0 .. length - 1."""
    start = F.struct(F.exp(-mean).alias("p"), F.exp(-mean).alias("c"), F.array(F.exp(-mean)).alias("t"))
    grown = F.aggregate(
        F.sequence(F.lit(1), F.lit(length - 1)),
        start,
        lambda a, k: F.struct((a["p"] * mean / k).alias("p"), (a["c"] + a["p"] * mean / k).alias("c"), F.concat(a["t"], F.array(a["c"] + a["p"] * mean / k)).alias("t")),
    )
    return grown["t"]


def _bits(key: Column) -> Column:
    """The first 52 bits of a hexadecimal hash, as a number in [0, 1)."""
    return F.conv(F.substring(key, 1, 13), 16, 10).cast("double") / _SCALE


def repetition_means(docs: DataFrame, source_col: str, size: Column, weights: dict[str, float] | None, budget: float) -> DataFrame:
    """(source, mean, all_size): budget times the size of all sources, shared out by weight, over the source's size."""
    sizes = docs.groupBy(docs[source_col].alias("source")).agg(F.sum(F.coalesce(size, F.lit(0)).cast("long")).alias("size"))
    if weights is None:
        sizes = sizes.withColumn("weight", F.lit(1.0))
    else:
        known = F.create_map(*[F.lit(x) for kv in weights.items() for x in kv]) if weights else F.create_map().cast("map<string,double>")
        sizes = sizes.withColumn("weight", F.coalesce(F.try_element_at(known, F.coalesce("source", F.lit(""))), F.lit(0.0)).cast("double"))
    total = sizes.agg(F.sum("size").alias("all_size"), F.sum(F.when(F.col("size") > 0, F.col("weight")).otherwise(0.0)).alias("all_weight"))
    mean = F.try_divide(F.col("weight") / F.col("all_weight") * F.col("all_size") * float(budget), F.col("size"))
    # total is one row by construction
    return sizes.join(F.broadcast(total)).where("size > 0 AND all_weight > 0").select("source", mean.alias("mean"), "all_size").where("mean > 0")


def mix_sources(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", size_col: str = "n_chars", weights: dict[str, float] | None = None, budget: float = 1.0, seed: int = 17, step: float = 8.0, broadcast_rows: int = 20_000, part_size: int = 64 << 20) -> DataFrame:
    """docs with each row repeated, in a global order; columns of docs, then `copy` (from 1) and `mix_key`."""
    docs_, i, s, n = numbered(docs, id_col, source_col, size_col)
    names = docs_.columns
    length = math.ceil(step + 12 * math.sqrt(step) + 20)
    means = repetition_means(docs_, s, docs_[n], weights, budget)
    parts = F.greatest(F.lit(1), F.ceil(F.col("mean") / step)).cast("int")
    # a null source joins as one more value
    tag = lambda c: F.concat(F.lit("="), c.cast("string"))
    means = written(means.select(F.coalesce(tag(F.col("source")), F.lit("null")).alias("tag"), parts.alias("parts"), poisson_table(F.col("mean") / parts, length).alias("table"), "all_size"))
    rows = docs_.withColumn("tag", F.coalesce(tag(docs_[s]), F.lit("null")))
    if means.count() <= broadcast_rows:  # a checked bound
        rows = rows.join(F.broadcast(means), "tag")
    else:
        rows = spread_join(rows, means, "tag")
    count = F.aggregate(
        F.sequence(F.lit(1), F.col("parts")),
        F.lit(0),
        lambda a, k: a + F.size(F.filter("table", lambda c: c <= uniform(seed, F.col(i), k))),
    )
    rows = rows.withColumn("n", count).where("n > 0")
    copies = rows.select(*names, F.explode(F.sequence(F.lit(1), F.col("n"))).alias("copy"))
    copies = copies.withColumn("key", F.md5(F.concat_ws(":", F.lit(str(seed + 1)), F.coalesce(F.col(i).cast("string"), F.lit("null")), F.col("copy").cast("string"))))
    all_size = means.agg(F.max("all_size")).first()[0] or 0
    n_parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(all_size * budget / part_size))
    dealt = copies.repartitionById(n_parts, F.floor(_bits(F.col("key")) * n_parts).cast("int")).sortWithinPartitions("key")
    free = []
    for name in ("copy", "mix_key"):
        while name.lower() in {c.lower() for c in docs.columns}:
            name += "_"
        free.append(name)
    return dealt.toDF(*docs.columns, *free)

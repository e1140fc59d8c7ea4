"""Arms, contrasts, vocabularies and pairs of a study: joins on what was declared, and inference over its rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.labels import EXACT, normalise_label, pair_id
from .spans import pack


def family_of(component: Column) -> Column:
    """The name before the first part (but not the very first) that is all digits; the whole name where there is none."""
    found = F.regexp_extract(component, r"^([^-]*(?:-(?!\d+(?:-|$))[^-]*)*)-\d+(?:-.*)?$", 1)
    return F.when(found == "", component).otherwise(found)


def strip_quotes(text: Column) -> Column:
    """Outer white space, then double quotes, then single quotes taken off both ends."""
    return F.btrim(F.btrim(F.trim(text), F.lit('"')), F.lit("'"))


def metric_tag(tolerance: float) -> str:
    """A number as part of a metric's name: 0.5 is 0p5."""
    return f"{tolerance:g}".replace(".", "p")


def parse_clips(text: Column) -> Column:
    """'[[0,89],[90,131]]' as an array of pairs; null where it is none."""
    return F.from_json(text, "array<array<int>>")


def fingerprint(text: Column) -> Column:
    """SHA-256 of a flat JSON object written with sorted keys and without spaces."""
    entries = F.array_sort(F.map_entries(F.from_json(text, "map<string,string>")))
    return F.sha2(F.to_json(F.map_from_entries(entries)), 256)


def centred_grid(anchor: Column, window: float, n: int, t0: Column, t1: Column) -> Column:
    """n times over a window around an anchor, held in the episode, without repeats."""
    if n <= 1:
        return F.array(F.least(F.greatest(anchor, t0), t1))
    at = F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.least(F.greatest(anchor - window / 2 + i * (window / (n - 1)), t0), t1))
    return F.array_distinct(at)


# ---- arms ----------------------------------------------------------------------------------------


def counterparts(arms: DataFrame, flag: str) -> DataFrame:
    """(arm, counterpart): for each arm with the flag, the first other one of its tool whose flags are equal without it.

    arms: (position, arm, tool, flags map). Arms are some dozens; the join is on (tool, flags as sorted text).
    """
    key = lambda m: F.to_json(F.map_from_entries(F.array_sort(F.map_entries(m))))
    a = arms.where(F.map_contains_key("flags", flag)).select("arm", "tool", key(F.map_filter("flags", lambda k, _: k != flag)).alias("key"))
    b = arms.select(F.col("arm").alias("counterpart"), "tool", "position", key(F.col("flags")).alias("key"))
    return a.join(b, ["tool", "key"]).where("arm <> counterpart").groupBy("arm").agg(F.min_by("counterpart", "position").alias("counterpart"))


def cell_baselines(rows: DataFrame, tool: str, baseline: str, cell: list[str], value: str) -> DataFrame:
    """Each row's value less that of the baseline tool in its cell; cells without a baseline don't come."""
    base = rows.where(F.col(tool) == baseline).groupBy(*cell).agg(F.avg(value).alias("baseline"))
    own = rows.where(F.col(tool) != baseline).groupBy(*cell, tool).agg(F.avg(value).alias("value"))
    return own.join(base, cell).withColumn("delta", F.col("value") - F.col("baseline"))


def shared_keys(rows: DataFrame, keys: list[str], arm: str, a: str, b: str) -> DataFrame:
    """One row: how many keys both arms have, only a, only b."""
    has = lambda x: F.max((F.col(arm) == x).cast("int")) == 1
    sides = rows.where(F.col(arm).isin(a, b)).groupBy(*keys).agg(has(a).alias("a"), has(b).alias("b"))
    return sides.agg(F.count_if(F.expr("a AND b")).alias("shared"), F.count_if(F.expr("a AND NOT b")).alias("a_only"), F.count_if(F.expr("b AND NOT a")).alias("b_only"))


def contrast_family(rows: DataFrame, keys: list[str], arm: str, metrics: dict[str, bool], contrasts: list[tuple[str, str]]) -> DataFrame:
    """A row for each contrast (a, b) and metric (True where larger is better): pairs, means, wins and losses of a, sign test p.

    Rows are unpivoted once and every contrast is one group of the same pass. A metric without pairs
    comes with a reason. wins count in the metric's own direction.
    """
    wide = rows.groupBy(*keys, arm).agg(*[F.avg(m).alias(m) for m in metrics])
    long = wide.unpivot([*keys, arm], list(metrics), "metric", "value").where("value IS NOT NULL AND NOT isnan(value)")
    sides = F.array(*[F.struct(F.lit(f"{a} - {b}").alias("contrast"), F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in contrasts])
    tried = long.select("*", F.explode(sides).alias("c")).where(F.col(arm).isin(*{x for c in contrasts for x in c}) & ((F.col(arm) == F.col("c.a")) | (F.col(arm) == F.col("c.b"))))
    side = lambda s: F.max(F.when(F.col(arm) == F.col(f"c.{s}"), F.col("value")))
    pairs = tried.groupBy("c.contrast", "metric", *keys).agg(side("a").alias("a"), side("b").alias("b")).where("a IS NOT NULL AND b IS NOT NULL")
    up = F.create_map(*[F.lit(x) for m, better in metrics.items() for x in (m, 1.0 if better else -1.0)])
    d = (F.col("a") - F.col("b")) * F.element_at(up, F.col("metric"))
    out = pairs.groupBy("contrast", "metric").agg(F.count("*").alias("n"), F.avg("a").alias("mean_a"), F.avg("b").alias("mean_b"), F.avg(F.col("a") - F.col("b")).alias("delta"), F.count_if(d > 0).alias("wins"), F.count_if(d < 0).alias("losses"))
    spark = rows.sparkSession
    asked = spark.createDataFrame([(f"{a} - {b}", m) for a, b in contrasts for m in metrics], "contrast string, metric string")
    done = asked.join(out, ["contrast", "metric"], "left")
    return done.withColumn("p", sign_p(F.coalesce("wins", F.lit(0)), F.coalesce("losses", F.lit(0)))).withColumn("unavailable", F.when(F.col("n").isNull(), "no paired rows"))


def sign_p(wins: Column, losses: Column) -> Column:
    """Exact two-sided sign test: twice the binomial tail of the smaller count at one half, 1 at most."""
    n, k = (wins + losses).cast("double"), F.least(wins, losses)
    # log of n choose i as a running sum, so that no factor overflows
    start = F.struct(F.lit(0.0).alias("c"), F.exp(-n * F.log(F.lit(2.0))).alias("sum"))
    step = lambda a, i: F.struct((a["c"] + F.log((n - i + 1) / i)).alias("c"), (a["sum"] + F.exp(a["c"] + F.log((n - i + 1) / i) - n * F.log(F.lit(2.0)))).alias("sum"))
    tail = F.aggregate(F.filter(F.sequence(F.lit(0), k.cast("int")), lambda i: i > 0), start, step)["sum"]
    return F.when(n == 0, 1.0).otherwise(F.least(F.lit(1.0), 2 * tail))


def percentile_bootstrap(deltas: DataFrame, family: str, unit: str, value: str, n_boot: int = 2000, seed: int = 17, level: float = 0.95) -> DataFrame:
    """(family, delta, low, high, n): mean of units' deltas, percentile interval of redrawn units.

    Draw b of a family takes, in each of its n places, the unit whose number is a hash of
    (seed, b, place) modulo n, so all families of the same units share their draws. Units are
    tasks, some dozens; places times draws are rows of a join, summed by draw.
    """
    own = deltas.groupBy(family, unit).agg(F.avg(value).alias("d"))
    w = Window.partitionBy(family)
    own = own.withColumns({"k": F.row_number().over(w.orderBy(unit)) - 1, "n": F.count("*").over(w)})
    places = own.select(family, "n", F.col("k").alias("place"), F.explode(F.sequence(F.lit(1), F.lit(n_boot))).alias("b"))
    drawn = places.withColumn("k", F.pmod(F.xxhash64(F.lit(seed), "b", "place"), F.col("n")).cast("int")).drop("n")
    means = drawn.join(own.select(family, "k", "d"), [family, "k"]).groupBy(family, "b").agg(F.avg("d").alias("m"))
    tail = (1 - level) / 2
    cut = means.groupBy(family).agg(F.percentile("m", tail).alias("low"), F.percentile("m", 1 - tail).alias("high"))
    return own.groupBy(family).agg(F.avg("d").alias("delta"), F.count("*").alias("n")).join(cut, family)


def spearman(rows: DataFrame, key: str, a: str, b: str) -> DataFrame:
    """(key, n, rho): correlation of average ranks, null where a side is constant."""
    both = rows.where(F.col(a).isNotNull() & F.col(b).isNotNull())
    rank = lambda c: F.rank().over(Window.partitionBy(key).orderBy(c)) + (F.count("*").over(Window.partitionBy(key, c)) - 1) / 2
    ranked = both.select(key, rank(a).alias("x"), rank(b).alias("y"))
    return ranked.groupBy(key).agg(F.count("*").alias("n"), F.when((F.var_pop("x") > 0) & (F.var_pop("y") > 0), F.corr("x", "y")).alias("rho"))


def seam_share(boundaries: DataFrame, seams: DataFrame, arm: str, tolerance: float) -> DataFrame:
    """(arm, boundaries, on_seam, seam_share) of boundaries (arm, episode, at) in episodes that have seams (episode, at)."""
    s = seams.groupBy("episode").agg(F.array_sort(F.collect_set("at")).alias("seams"))
    near = F.exists("seams", lambda x: F.abs(x - F.col("at")) <= tolerance)
    return boundaries.join(s, "episode").groupBy(arm).agg(F.count("*").alias("boundaries"), F.count_if(near).alias("on_seam"), F.avg(near.cast("double")).alias("seam_share"))


# ---- vocabularies and label pairs -----------------------------------------------------------------


def vocabulary(spans: DataFrame, *keys: str) -> DataFrame:
    """Segments, distinct normal forms, their ratio and entropy (nats), by key."""
    counted = spans.groupBy(*keys, normalise_label(F.col("text")).alias("label")).agg(F.count("*").alias("n"))
    total = counted.groupBy(*keys).agg(F.sum("n").alias("n_segments"), F.count("*").alias("n_distinct"), F.sum(F.col("n") * F.log("n")).alias("_s"))
    return total.withColumns({"per_segment": F.col("n_distinct") / F.col("n_segments"), "entropy": F.log("n_segments") - F.col("_s") / F.col("n_segments")}).drop("_s")


def sequence_diversity(spans: DataFrame) -> DataFrame:
    """One row: episodes, distinct label sequences, share of the most frequent one, entropy."""
    seq = pack(spans).select(F.transform("spans", lambda s: normalise_label(s["text"])).alias("s"))
    n = seq.groupBy("s").agg(F.count("*").alias("n"))
    out = n.agg(F.sum("n").alias("n_episodes"), F.count("*").alias("n_distinct_sequences"), F.max("n").alias("_m"), F.sum(F.col("n") * F.log("n")).alias("_s"))
    return out.select("n_episodes", "n_distinct_sequences", (F.col("_m") / F.col("n_episodes")).alias("modal_fraction"), (F.log("n_episodes") - F.col("_s") / F.col("n_episodes")).alias("sequence_entropy"))


def consistency_gap(pred: DataFrame, ref: DataFrame) -> DataFrame:
    """One row: sequence diversity, modal share, vocabulary and entropy of both sides, and predicted minus reference."""

    def side(x, p):
        a = sequence_diversity(x).crossJoin(F.broadcast(vocabulary(x).select("n_distinct")))  # one row each
        return a.select(*[F.col(c).alias(p + c) for c in ("n_distinct_sequences", "modal_fraction", "n_distinct", "sequence_entropy")])

    both = side(pred, "pred_").crossJoin(F.broadcast(side(ref, "true_")))  # one row each
    return both.select("*", *[(F.col("pred_" + c) - F.col("true_" + c)).alias("gap_" + c) for c in ("n_distinct_sequences", "modal_fraction", "n_distinct", "sequence_entropy")])


def project(labels: DataFrame, words: DataFrame, matcher=EXACT, threshold: float = 0.8, broadcast_rows: int = 10_000) -> DataFrame:
    """(label, word, similarity): the most similar word of a vocabulary (position, word), the first of equals; null below the threshold.

    A vocabulary of at most broadcast_rows words is broadcast against distinct labels; a larger one is an error.
    """
    if words.count() > broadcast_rows:
        raise ValueError("vocabulary too large to compare with every label")
    both = matcher.prepare(labels.select("label").distinct().crossJoin(F.broadcast(words.select("position", "word"))), "label", "word")
    best = both.withColumn("s", matcher.similarity("label", "word")).groupBy("label").agg(F.max(F.struct("s", -F.col("position"), "word")).alias("b"))
    return best.select("label", F.when(F.col("b.s") >= threshold, F.col("b.word")).alias("word"), F.col("b.s").alias("similarity"))


def label_contexts(pred: DataFrame, ref: DataFrame) -> DataFrame:
    """(pair, left, right, n_episodes): distinct normal forms of predicted and reference labels that meet in an episode."""
    own = lambda x, n: x.select("episode", normalise_label(F.col("text")).alias(n)).distinct()
    both = own(pred, "p").join(own(ref, "r"), "episode").where("p <> r").select("episode", F.least("p", "r").alias("left"), F.greatest("p", "r").alias("right")).distinct()
    return both.groupBy("left", "right").agg(F.count("*").alias("n_episodes")).select(pair_id(F.col("left"), F.col("right")).alias("pair"), "left", "right", "n_episodes")


def combinations(rows: DataFrame, group: str, label: str, most: int = 2000) -> DataFrame:
    """All unordered pairs of distinct labels of a group (a dataset's vocabulary, at most `most` labels, else an error)."""
    labels = rows.select(group, normalise_label(F.col(label)).alias("a")).distinct()
    many = labels.groupBy(group).count().where(F.col("count") > most).limit(1).collect()
    if many:
        raise ValueError(f"{many[0][0]}: too many labels to pair")
    return labels.join(labels.withColumnRenamed("a", "b"), group).where("a < b")


def harvest(pairs: DataFrame, least_iou: float = 0.0) -> tuple[DataFrame, DataFrame]:
    """(pairs to review, reasons skipped) from matched spans (arm, dataset, order, p_text, r_text, iou).

    A reviewed pair keeps the wording of its first occurrence, its number of occurrences, arms and datasets and largest IoU.
    """
    p, r = normalise_label(F.col("p_text")), normalise_label(F.col("r_text"))
    reason = F.when(F.col("iou") <= least_iou, "pair_below_min_iou").when((p == "") | (r == ""), "empty_label").when(p == r, "identical_after_normalisation")
    rows = pairs.withColumn("reason", reason)
    kept = rows.where("reason IS NULL").groupBy(pair_id(F.col("p_text"), F.col("r_text")).alias("pair"))
    out = kept.agg(F.min_by("p_text", "order").alias("model_label"), F.min_by("r_text", "order").alias("human_label"), F.count("*").alias("occurrences"), F.count_distinct("arm").alias("n_arms"), F.count_distinct("dataset").alias("n_datasets"), F.max("iou").alias("max_iou"))
    return out, rows.where("reason IS NOT NULL").groupBy("reason").agg(F.count("*").alias("n"))


def stratify(pairs: DataFrame, similarity: str, threshold: float, near: float = 0.05) -> DataFrame:
    """Strata of pairs by their similarity: near the threshold, else accepted or rejected; and a blind flip by the id."""
    s = F.col(similarity)
    stratum = F.when(F.abs(s - threshold) <= near, "near").when(s >= threshold, "accepted").otherwise("rejected")
    return pairs.withColumns({"stratum": stratum, "flipped": blind_flip(F.col("pair"))})


def blind_flip(identifier: Column) -> Column:
    """Whether the first 8 hex digits of an id are odd."""
    return F.conv(F.substring(identifier, 1, 8), 16, 10).cast("long") % 2 == 1


def stratum_agreement(reviews: DataFrame, threshold: float) -> DataFrame:
    """(stratum, n, agree, false_match, false_split) of reviews (stratum, similarity, verdict); unsure ones (null) don't count."""
    said, hit = F.col("verdict"), F.col("similarity") >= threshold
    return reviews.where("verdict IS NOT NULL").groupBy("stratum").agg(F.count("*").alias("n"), F.avg((said == hit).cast("double")).alias("agree"), F.count_if(hit & ~said).alias("false_match"), F.count_if(~hit & said).alias("false_split"))


# ---- cohorts --------------------------------------------------------------------------------------


def cohorts(episodes: DataFrame, least: int) -> DataFrame:
    """(task, n_segments, n, usable): seeds by task and number of segments, usable from `least` on."""
    return episodes.groupBy("task", "n_segments").agg(F.count("*").alias("n")).withColumn("usable", F.col("n") >= least)


def column_stats(rows: DataFrame, columns: list[str]) -> DataFrame:
    """(column, min, max, mean, std, count), each but the name in an array of one."""
    one = rows.agg(*[F.struct(F.array(F.min(c).cast("double")).alias("min"), F.array(F.max(c).cast("double")).alias("max"), F.array(F.avg(c)).alias("mean"), F.array(F.stddev_pop(c)).alias("std"), F.array(F.count(c)).alias("count")).alias(c) for c in columns])
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("s")) for c in columns])
    return one.select(F.explode(rows).alias("r")).select("r.column", "r.s.*")


def missing_census(requested: DataFrame, have: DataFrame, dataset: str, arm: str, key: str) -> DataFrame:
    """(dataset, arm, total, missing): requested keys of a dataset that an arm has no row of."""
    arms = have.select(arm).distinct()
    want = requested.select(dataset, key).distinct()
    got = want.join(have.select(dataset, key, arm).distinct(), [dataset, key]).groupBy(dataset, arm).agg(F.count("*").alias("got"))
    total = want.groupBy(dataset).agg(F.count("*").alias("total"))
    grid = total.crossJoin(F.broadcast(arms))  # datasets by arms, some dozens each
    return grid.join(got, [dataset, arm], "left").select(dataset, arm, "total", (F.col("total") - F.coalesce("got", F.lit(0))).alias("missing"))


def boundary_regularity(boundaries: DataFrame, keys: list[str], value: str, least: int = 8) -> DataFrame:
    """One row: slots with `least` rows or more, and the median of their population deviations."""
    sd = boundaries.groupBy(*keys).agg(F.count("*").alias("n"), F.stddev_pop(value).alias("sd")).where(F.col("n") >= least)
    return sd.agg(F.count("*").alias("n_slots"), F.median("sd").alias("boundary_sd"))


def cross_view(views: DataFrame, tolerance: float = 1.0, least: int = 3) -> DataFrame:
    """One row: deviations of views' boundaries from their trajectory's median, over views near its median duration.

    views: (trajectory, view, duration, boundaries array). Trajectories whose views have different numbers of boundaries are left out.
    """
    w = Window.partitionBy("trajectory")
    rows = views.withColumns({"_lo": F.min(F.size("boundaries")).over(w), "_hi": F.max(F.size("boundaries")).over(w)}).where("_lo = _hi AND _lo > 0")
    middle = rows.groupBy("trajectory").agg(F.median("duration").alias("_m"))
    rows = rows.join(middle, "trajectory").where(F.abs(F.col("duration") - F.col("_m")) <= tolerance).withColumn("_n", F.count("*").over(w)).where(F.col("_n") >= least)
    each = rows.select("trajectory", F.posexplode("boundaries").alias("i", "x"))
    centre = each.groupBy("trajectory", "i").agg(F.median("x").alias("c"))
    d = each.join(centre, ["trajectory", "i"]).select("trajectory", F.abs(F.col("x") - F.col("c")).alias("d"))
    return d.agg(F.count_distinct("trajectory").alias("trajectories"), F.count("*").alias("pairs"), F.avg("d").alias("mean"), F.median("d").alias("median"), F.avg((F.col("d") <= 1.0).cast("double")).alias("within_1"))


def reference_arms(extent: DataFrame, truth: DataFrame, seeds: DataFrame) -> DataFrame:
    """Spans (arm, episode, idx, text, start, end) of arms without a model: single, uniform_true, uniform_modal, script_prior.

    seeds are spans of seed episodes. The modal number and the modal sequence are the most frequent ones, the first seen of equals;
    the script's cuts are the mean relative boundaries of the seeds that have that sequence, in order. These are one row, broadcast.
    """
    packed = pack(seeds)
    length = F.element_at("spans", -1)["end"] - F.col("spans")[0]["start"]
    seq = packed.select("episode", F.transform("spans", lambda s: s["text"]).alias("labels"), F.size("spans").alias("n"), F.transform(F.slice("spans", 2, F.size("spans")), lambda s: (s["start"] - F.col("spans")[0]["start"]) / length).alias("cuts"))
    best = lambda c: seq.groupBy(c).agg(F.count("*").alias("k"), F.min("episode").alias("e")).agg(F.min_by(c, F.struct(-F.col("k"), "e")).alias("modal"))
    script = best("labels").join(seq, F.col("labels") == F.col("modal")).select("modal", F.posexplode("cuts").alias("i", "x")).groupBy("modal", "i").agg(F.avg("x").alias("x")).groupBy("modal").agg(F.array_sort(F.collect_list("x")).alias("cuts"))
    n_true = truth.groupBy("episode").agg(F.count("*").cast("int").alias("k"))
    base = extent.select("episode", "t0", "t_last")

    def equal(rows, arm):
        at = lambda i: F.col("t0") + (F.col("t_last") - F.col("t0")) * i / F.col("k")
        out = rows.where("k > 0").select("*", F.explode(F.sequence(F.lit(0), F.col("k") - 1)).alias("i"))
        return out.select(F.lit(arm).alias("arm"), "episode", F.col("i").cast("long").alias("idx"), F.concat(F.lit("segment "), (F.col("i") + 1).cast("string")).alias("text"), at(F.col("i")).alias("start"), at(F.col("i") + 1).alias("end"))

    single = base.select(F.lit("single").alias("arm"), "episode", F.lit(0).cast("long").alias("idx"), F.lit("perform the task").alias("text"), F.col("t0").alias("start"), F.col("t_last").alias("end"))
    modal = base.crossJoin(F.broadcast(best("n").select(F.col("modal").cast("int").alias("k"))))
    edges = F.concat(F.array(F.lit(0.0)), F.col("cuts"), F.array(F.lit(1.0)))
    at = lambda i: F.col("t0") + (F.col("t_last") - F.col("t0")) * F.get(F.col("edges"), i)
    prior = base.crossJoin(F.broadcast(script)).withColumn("edges", edges).select("*", F.posexplode("modal").alias("i", "text"))
    prior = prior.select(F.lit("script_prior").alias("arm"), "episode", F.col("i").cast("long").alias("idx"), "text", at(F.col("i")).alias("start"), at(F.col("i") + 1).alias("end"))
    return single.unionByName(equal(base.join(n_true, "episode"), "uniform_true")).unionByName(equal(modal, "uniform_modal")).unionByName(prior)


# ---- declarations and gates -----------------------------------------------------------------------


def emission_ticks(frames: DataFrame, hz: float, k: int) -> DataFrame:
    """(episode, frame, t): k frames in a row from the one nearest to each tick, every 1/hz s from the first frame on, each once."""
    from .spans import episode_extent, snap_to_frame

    if hz <= 0 or k <= 0:
        return frames.select("episode", F.lit(0).alias("frame"), "t").limit(0)
    ext = episode_extent(frames)
    ticks = ext.select("episode", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("t_last") - F.col("t0") + 1e-9) * hz).cast("long"))).alias("id"), "t0").select("episode", "id", (F.col("t0") + F.col("id") / hz).alias("at"))
    number = frames.select("episode", "t").distinct().withColumn("frame", F.row_number().over(Window.partitionBy("episode").orderBy("t")) - 1)
    first = snap_to_frame(ticks, frames).join(number.withColumnRenamed("t", "frame_t"), ["episode", "frame_t"]).select("episode", F.explode(F.sequence(F.col("frame"), F.col("frame") + k - 1)).alias("frame")).distinct()
    return first.join(number, ["episode", "frame"])


def plan_at(points: DataFrame, spans: DataFrame) -> DataFrame:
    """(episode, id, at, plan): at each point, the numbered list of the spans that haven't ended; empty where all have."""
    packed = pack(spans)
    todo = F.filter("spans", lambda s: s["end"] > F.col("at"))
    text = F.array_join(F.transform(todo, lambda s, i: F.concat((i + 1).cast("string"), F.lit(". "), s["text"])), "\n")
    return points.join(packed, "episode", "left").select("episode", "id", "at", F.coalesce(text, F.lit("")).alias("plan"))


def memory_chain(spans: DataFrame) -> DataFrame:
    """(episode, idx, start, memory): at each span after the first, the texts of the spans done, in order."""
    w = Window.partitionBy("episode").orderBy("start", "idx")
    done = F.collect_list("text").over(w.rowsBetween(Window.unboundedPreceding, -1))
    return spans.select("episode", "idx", "start", F.array_join(done, "; ").alias("memory"), (F.row_number().over(w) > 1).alias("_later")).where("_later").drop("_later")


def row_status(job_ok: Column, n_spans: Column, error: Column) -> Column:
    """(ok, error) of a score row: the scorer's own error first, then an empty answer; a failed job has no answer."""
    given = F.when(F.coalesce(job_ok, F.lit(True)), n_spans).otherwise(0)
    said = F.when(error.isNotNull(), error).when(F.coalesce(given, F.lit(0)) == 0, "arm produced no spans for this episode")
    return F.struct(said.isNull().alias("ok"), said.alias("error"))


def calibration_status(job_ok: Column, n_spans: Column, applied: Column, reason: Column, configured: Column) -> Column:
    """(applied, reason, source) of an episode: the delivery first, then what the run said, then the configuration.

    Applied without a calibration, and a calibrated answer without a decision, are errors.
    """
    no_output = ~F.coalesce(job_ok, F.lit(False)) | (F.coalesce(n_spans, F.lit(0)) == 0)
    state = lambda a, r, s: F.struct(a.alias("applied"), r.alias("reason"), F.lit(s).alias("source"))
    wrong = F.when(F.coalesce(applied, F.lit(False)) & ~configured, "calibration applied without a calibration file").when(~no_output & applied.isNull() & configured, "calibrated output has no runtime decision")
    ladder = (
        F.when(wrong.isNotNull(), state(F.lit(None).cast("boolean"), F.concat(F.lit("error: "), wrong), "error"))
        .when(no_output, state(F.lit(False), F.when(~F.coalesce(job_ok, F.lit(False)), "job_failed").otherwise("no_output"), "delivery"))
        .when(applied.isNotNull(), state(applied, reason, "runtime"))
        .otherwise(state(F.lit(False), F.lit("not_configured"), "configuration"))
    )
    return ladder


def baseline_expectation(declared: Column, is_declared: Column, base_arm: Column, profile: Column, camera: Column, default: str, standalone: tuple[str, ...] = ("", "none", "standalone")) -> Column:
    """(kind, baseline): the declared counterpart, none where it is declared so, else the one of the arm's own cell."""
    alone = F.struct(F.lit("standalone").alias("kind"), F.lit(None).cast("string").alias("baseline"))
    return (
        F.when(is_declared & (declared.isNull() | F.lower(F.trim(declared)).isin(*standalone)), alone)
        .when(is_declared, F.struct(F.lit("declared").alias("kind"), declared.alias("baseline")))
        .when(F.coalesce(base_arm == default, F.lit(False)), alone)
        .when(F.coalesce(profile, F.lit("")) == "", F.struct(F.lit("undeclared").alias("kind"), F.lit(None).cast("string").alias("baseline")))
        .otherwise(F.struct(F.lit("inferred").alias("kind"), F.concat(F.lit(default + "__"), profile, F.lit("__"), F.coalesce(camera, F.lit("None"))).alias("baseline")))
    )


def pairing_problems(arms: DataFrame) -> DataFrame:
    """(arm, problem) of arms (arm, baseline): paired with themselves, or with an arm that isn't there."""
    known = arms.select(F.col("arm").alias("baseline"), F.lit(True).alias("_there"))
    rows = arms.where("baseline IS NOT NULL").join(known, "baseline", "left")
    problem = F.when(F.col("arm") == F.col("baseline"), "paired with itself").when(F.col("_there").isNull(), "baseline missing")
    return rows.select("arm", problem.alias("problem")).where("problem IS NOT NULL")


def contrast_policy(contrasts: DataFrame, arms: DataFrame, allow_unequalised: bool = False, allow_reference: bool = False) -> DataFrame:
    """(a, b, refusal, note) of contrasts (a, b): why one isn't drawn, judged for a, then b, then both.

    arms: (arm, supervision, tool, quarantined, equalised). A contrast with a model-free reference may be allowed with a note.
    """
    meta = lambda s: arms.select(F.col("arm").alias(s), *[F.col(c).alias(f"{s}_{c}") for c in ("supervision", "tool", "quarantined", "equalised")])
    rows = contrasts.join(meta("a"), "a", "left").join(meta("b"), "b", "left")

    def own(s):
        blank = lambda c: F.coalesce(F.col(f"{s}_{c}"), F.lit("")) == ""
        out = F.when(blank("supervision") | blank("tool"), F.concat(F.lit("missing metadata: "), F.col(s))).when(F.coalesce(f"{s}_quarantined", F.lit(False)), F.concat(F.lit("quarantined: "), F.col(s)))
        return out if allow_unequalised else out.when(F.col(f"{s}_equalised") == F.lit(False), F.concat(F.lit("not equalised: "), F.col(s)))

    differ = F.col("a_supervision") != F.col("b_supervision")
    reference = F.lit(allow_reference) & ((F.col("a_tool") == "reference") | (F.col("b_tool") == "reference"))
    sides = F.concat(F.col("a_supervision"), F.lit(" / "), F.col("b_supervision"))
    refusal = F.coalesce(own("a"), own("b"), F.when(differ & ~reference, F.concat(F.lit("supervision mismatch: "), sides)))
    note = F.when(refusal.isNull() & differ, F.concat(F.lit("supervision asymmetry: "), sides))
    return rows.select("a", "b", refusal.alias("refusal"), note.alias("note"))


def attrition_gate(rows: DataFrame, arm: str, baseline: str, most_failed: float = 0.2, most_gap: float = 0.1) -> DataFrame:
    """One row: failure rates of both arms, their gap, and whether they withhold a verdict."""
    rate = lambda x: F.coalesce(F.avg(F.when(F.col("arm") == x, (~F.coalesce("ok", F.lit(False))).cast("double"))), F.lit(0.0))
    out = rows.agg(rate(arm).alias("arm_failed"), rate(baseline).alias("baseline_failed"))
    gap = F.abs(F.col("arm_failed") - F.col("baseline_failed"))
    return out.select("*", gap.alias("gap"), ((F.greatest("arm_failed", "baseline_failed") > most_failed) | (gap > most_gap)).alias("blocked"))


def source_problems(rows: DataFrame, current: dict[str, str]) -> DataFrame:
    """(field, problem, n) of provenance fields: rows without a value, several values, or another one than the current."""
    out = None
    for name, want in current.items():
        x = rows.agg(F.count_if(F.col(name).isNull()).alias("n_null"), F.count_distinct(name).alias("n_values"), F.min(name).alias("value"))
        problem = F.when(F.col("n_null") > 0, "no value").when(F.col("n_values") > 1, "mixed values").when(F.col("value") != want, "produced with another value")
        one = x.select(F.lit(name).alias("field"), problem.alias("problem"), F.when(F.col("n_null") > 0, F.col("n_null")).otherwise(F.col("n_values")).alias("n"))
        out = one if out is None else out.unionByName(one)
    return out.where("problem IS NOT NULL")


def factorial_contrasts(rows: DataFrame, factors: list[str], factor: str, reference, keys: list[str], value: str) -> DataFrame:
    """For each cell of the other factors and each other level of one factor: number of shared keys, mean difference from the reference level, wins and losses."""
    others = [f for f in factors if f != factor]
    own = rows.groupBy(*factors, *keys).agg(F.avg(value).alias("v"))
    base = own.where(F.col(factor) == reference).select(*others, *keys, F.col("v").alias("base"))
    d = F.col("v") - F.col("base")
    return own.where(F.col(factor) != reference).join(base, [*others, *keys]).groupBy(*others, factor).agg(F.count("*").alias("n"), F.avg(d).alias("delta"), F.count_if(d > 0).alias("wins"), F.count_if(d < 0).alias("losses"))


def union_scores(keys: list[str], *parts: DataFrame) -> DataFrame:
    """Score rows of several files as one; a key that comes twice is an error."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    twice = out.groupBy(*keys).count().where("count > 1").limit(1).collect()
    if twice:
        raise ValueError(f"score rows come twice: {twice[0].asDict()}")
    return out


def merge_predictions(parts: DataFrame, index: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(predictions under original ids, problems) of component predictions (component, local, ...) and an index (component, local, original).

    Problems: predictions without an entry, and originals that two components claim.
    """
    rows = parts.join(index, ["component", "local"], "left")
    lost = rows.where("original IS NULL").groupBy("component").agg(F.count("*").alias("n")).select(F.lit("not in the index").alias("problem"), F.col("component").cast("string").alias("where"), "n")
    twice = index.groupBy("original").agg(F.count_distinct("component").alias("n")).where("n > 1").select(F.lit("claimed twice").alias("problem"), F.col("original").cast("string").alias("where"), "n")
    return rows.where("original IS NOT NULL"), lost.unionByName(twice)


def matcher_pairs(vocabularies: DataFrame, antonyms: DataFrame, most: int = 2000) -> DataFrame:
    """(left, right, positive) of a matcher's test: variants of format and labels of several datasets as positives, pairs within a dataset and antonyms as negatives."""
    labels = vocabularies.select("dataset", "label").distinct()
    one = labels.groupBy("label").agg(F.count("*").alias("n"))
    same = one.where("n > 1").select(F.col("label").alias("left"), F.col("label").alias("right"))
    variants = one.select(F.col("label").alias("left"), F.explode(F.array(F.concat("label", F.lit(".")), F.replace("label", F.lit(" the "), F.lit(" ")))).alias("right"))
    positives = same.unionByName(variants).where("left <> '' AND right <> ''").withColumn("positive", F.lit(True))
    many = labels.groupBy("dataset").count().where(F.col("count") > most).limit(1).collect()
    if many:
        raise ValueError(f"{many[0][0]}: too many labels to pair")
    within = labels.select("dataset", F.col("label").alias("left")).join(labels.select("dataset", F.col("label").alias("right")), "dataset").where("left < right").select("left", "right")
    negatives = within.unionByName(antonyms.select("left", "right")).where(normalise_label(F.col("left")) != normalise_label(F.col("right"))).withColumn("positive", F.lit(False))
    return positives.unionByName(negatives)


def worst_false_positives(pairs: DataFrame, score: str, positive: str, threshold: float, k: int = 15) -> DataFrame:
    """The k negatives of the highest score at or above the threshold."""
    return pairs.where(~F.col(positive) & (F.col(score) >= threshold)).orderBy(F.desc(score), *[c for c in pairs.columns if c not in (score, positive)]).limit(k)


def export_consensus(reviews: DataFrame, controls: bool = False) -> DataFrame:
    """(pair, positive) that raters agree on, of pairs (pair, stratum, consensus) near the threshold, and of controls if asked."""
    keep = F.col("stratum") == "near"
    return reviews.where((keep | (F.col("stratum") == "control")) if controls else keep).where("consensus IS NOT NULL").select("pair", F.col("consensus").alias("positive"))


def cohort_diagnostics(seeds: DataFrame, evals: DataFrame) -> DataFrame:
    """(cohort, ...): how far the median boundaries of seeds lie from those of the evaluated episodes, of relative boundaries (cohort, episode, i, x)."""
    prior = seeds.groupBy("cohort", "i").agg(F.median("x").alias("prior"))
    target = evals.groupBy("cohort", "i").agg(F.median("x").alias("mid"))
    rows = evals.join(prior, ["cohort", "i"]).join(target, ["cohort", "i"])
    size = seeds.groupBy("cohort").agg(F.count_distinct("episode").alias("n_seeds"))
    out = rows.groupBy("cohort").agg(
        F.count_distinct("episode").alias("n_eval"), F.avg(F.abs(F.col("x") - F.col("prior"))).alias("prior_error"),
        F.avg(F.abs(F.col("x") - F.col("mid"))).alias("dispersion"),
    )
    shift = prior.join(target, ["cohort", "i"]).groupBy("cohort").agg(F.avg(F.abs(F.col("prior") - F.col("mid"))).alias("median_shift"))
    return out.join(shift, "cohort").join(size, "cohort")


def sign_reversed(offsets: DataFrame, errors: DataFrame, least: float = 0.02) -> DataFrame:
    """(cohort, nontrivial, reversed): fitted offsets of at least `least`, and those whose evaluated median error has the other sign."""
    mid = errors.groupBy("cohort", "i").agg(F.median("e").alias("mid"))
    rows = offsets.join(mid, ["cohort", "i"], "left").where(F.abs("offset") >= least)
    return rows.groupBy("cohort").agg(F.count("*").alias("nontrivial"), F.count_if(F.col("mid") * F.col("offset") < 0).alias("reversed"))

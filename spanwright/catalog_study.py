"""Queries of eligibility, repair, arms, vocabularies and pairs over the driver's tables, and their DuckDB text.

Roles as in catalog.py; nations are datasets, order priorities are arms, customers are episodes of a study.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from .catalog import _BOTH, _EXT, _FRAMES, _NORM, _PAIRS, _REF, coarse_spans, frames, pred_spans, query, r6, ref_spans, table
from .functions import labels as L
from .operators import eligibility as E
from .operators import metrics as M
from .operators import spans as S
from .operators import studies as U

# ---- eligibility and repair ------------------------------------------------------------------------

#: Spans with every kind of fault, by episode.
_FAULTY = """bad AS (SELECT episode, idx, CASE WHEN episode % 9 = 1 AND idx = 3 THEN ' ' ELSE text END AS text, CASE WHEN episode % 9 = 2 AND idx = 2 THEN 'nan'::DOUBLE WHEN episode % 9 = 3 AND idx = 1 THEN start + 1e6 WHEN episode % 9 = 4 AND idx = 0 THEN -1.0 ELSE start END AS start,
  CASE WHEN episode % 9 = 5 AND idx = 4 THEN start WHEN episode % 9 = 6 AND idx = 2 THEN "end" + 0.5 ELSE "end" END AS "end" FROM ref)"""


def faulty(spark, d):
    e, i = F.col("episode") % 9, F.col("idx")
    text = F.when((e == 1) & (i == 3), " ").otherwise(F.col("text"))
    start = F.when((e == 2) & (i == 2), float("nan")).when((e == 3) & (i == 1), F.col("start") + 1e6).when((e == 4) & (i == 0), -1.0).otherwise(F.col("start"))
    end = F.when((e == 5) & (i == 4), F.col("start")).when((e == 6) & (i == 2), F.col("end") + 0.5).otherwise(F.col("end"))
    return ref_spans(spark, d).select("episode", "idx", text.alias("text"), start.alias("start"), end.alias("end"))


_FIRST = "CASE {} END AS reason"


@query(f"""{_REF}, {_FAULTY}, n AS (SELECT *, lead(start) OVER (PARTITION BY episode ORDER BY idx) AS nx FROM bad)
SELECT episode, CASE WHEN bool_or(isnan(start) OR isnan("end")) THEN 'nonfinite_timestamp' WHEN bool_or("end" <= start) THEN 'nonpositive_span' WHEN bool_or(nx <= start) THEN 'nonincreasing_starts' WHEN bool_or("end" > nx) THEN 'overlapping_spans' END AS reason FROM n GROUP BY episode""")
def timing_reason(spark, d):
    return E.timing_reason(faulty(spark, d))


@query(f"""{_REF}, {_FAULTY}, n AS (SELECT *, lag("end") OVER (PARTITION BY episode ORDER BY idx) AS pv FROM bad)
SELECT episode, CASE WHEN bool_or(text IS NULL) THEN 'label missing' WHEN bool_or(isnan(start) OR isnan("end")) THEN 'time not finite' WHEN bool_or(start < 0) THEN 'start before 0' WHEN bool_or("end" <= start) THEN 'no duration' WHEN bool_or(start < pv) THEN 'starts before the previous end' END AS reason FROM n GROUP BY episode""")
def truth_reason(spark, d):
    return E.truth_reason(faulty(spark, d))


def _side_sql(src: str, name: str) -> str:
    return f"""(SELECT episode, count(*) AS n, list(text ORDER BY idx) AS labels, CASE WHEN bool_or(trim(text) = '') THEN '{name} contains an empty or invalid label' WHEN bool_or(isnan(start) OR isnan("end")) THEN '{name} contains nonfinite timestamps'
  WHEN bool_or(t1 <= t0) THEN '{name} has zero or negative episode duration' WHEN bool_or("end" <= start) THEN '{name} contains a zero or negative segment duration' WHEN bool_or(nx <= start) THEN '{name} has non-increasing boundaries' END AS reason
  FROM (SELECT *, lead(start) OVER (PARTITION BY episode ORDER BY idx) AS nx, arg_min(start, idx) OVER (PARTITION BY episode) AS t0, arg_max("end", idx) OVER (PARTITION BY episode) AS t1 FROM {src}) GROUP BY episode)"""


@query(f"""{_REF}, {_FAULTY}, other AS (SELECT episode, idx, CASE WHEN episode % 9 = 8 AND idx = 1 THEN 'else' ELSE text END AS text, start, "end" FROM ref WHERE episode % 9 <> 7 OR idx > 0), r AS {_side_sql('bad', 'ground truth')}, p AS {_side_sql('other', 'prediction')}
SELECT r.episode, CASE WHEN r.n < 2 THEN 'ground truth needs at least two segments' WHEN coalesce(p.n, 0) <> r.n THEN 'prediction is incomplete or has a different segment count'
  ELSE coalesce(r.reason, p.reason, CASE WHEN r.labels <> p.labels THEN 'prediction labels do not exactly match its ground truth in order' END) END AS reason FROM r LEFT JOIN p USING (episode)""")
def seed_reason(spark, d):
    other = ref_spans(spark, d).where("episode % 9 <> 7 OR idx > 0").withColumn("text", F.when((F.col("episode") % 9 == 8) & (F.col("idx") == 1), "else").otherwise(F.col("text")))
    return E.seed_reason(other, faulty(spark, d))


@query(f"""{_REF}, {_FAULTY} SELECT episode, coalesce(max(abs(nx - "end")) <= 1e-6, true) AS tiled FROM (SELECT *, lead(start) OVER (PARTITION BY episode ORDER BY idx) AS nx FROM bad WHERE NOT isnan(start)) GROUP BY episode""")
def tiled(spark, d):
    return E.tiles(faulty(spark, d).where("NOT isnan(start)"))


@query(f"""{_REF}, moved AS (SELECT episode, idx, CASE WHEN episode % 5 = 1 AND idx = 1 THEN 'else' ELSE text END AS text, CASE WHEN episode % 5 = 2 AND idx = 0 THEN start - 1 WHEN episode % 5 = 3 AND idx = 2 THEN start + 0.001 ELSE start END AS start, "end" FROM ref WHERE episode % 5 <> 4 OR idx > 0),
a AS (SELECT episode, list(text ORDER BY idx) AS l, count(*) AS n, arg_min(start, idx) AS s, arg_max("end", idx) AS e FROM ref GROUP BY 1), b AS (SELECT episode, list(text ORDER BY idx) AS l, count(*) AS n, arg_min(start, idx) AS s, arg_max("end", idx) AS e,
  bool_or("end" < start OR nx < start) AS disorder, bool_or(abs("end" - nx) > 1e-6) AS holes FROM (SELECT *, lead(start) OVER (PARTITION BY episode ORDER BY idx) AS nx FROM moved) GROUP BY 1)
SELECT a.episode, CASE WHEN b.n IS NULL OR a.n <> b.n THEN 'number of spans changed' WHEN a.l <> b.l THEN 'labels changed' WHEN abs(a.s - b.s) > 1e-6 OR abs(a.e - b.e) > 1e-6 THEN 'episode endpoints changed' WHEN disorder THEN 'out of order' WHEN holes THEN 'not contiguous' END AS reason FROM a LEFT JOIN b USING (episode)""")
def timing_only(spark, d):
    e, i = F.col("episode") % 5, F.col("idx")
    moved = ref_spans(spark, d).where("episode % 5 <> 4 OR idx > 0").withColumns({"text": F.when((e == 1) & (i == 1), "else").otherwise(F.col("text")), "start": F.when((e == 2) & (i == 0), F.col("start") - 1).when((e == 3) & (i == 2), F.col("start") + 0.001).otherwise(F.col("start"))})
    return E.timing_only(ref_spans(spark, d), moved)


_ROWS = """rows_ AS (SELECT o_orderkey AS episode, o_orderpriority AS arm, o_totalprice > 150000 AS ok, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_totalprice > 100000 END AS scored, CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_orderkey % 4 - 1 END AS repeat,
  CASE WHEN o_orderkey % 2 = 0 THEN 'exact' ELSE 'token_f1' END AS matcher, o_totalprice > 50000 AS eligible, o_totalprice AS value, o_custkey FROM orders)"""


def score_rows(spark, d):
    k, v = F.col("o_orderkey"), F.col("o_totalprice")
    return table(spark, d, "orders").select(
        k.alias("episode"), F.col("o_orderpriority").alias("arm"), (v > 150000).alias("ok"), F.when(k % 3 != 0, v > 100000).alias("scored"), F.when(k % 4 != 0, k % 4 - 1).alias("repeat"),
        F.when(k % 2 == 0, "exact").otherwise("token_f1").alias("matcher"), (v > 50000).alias("eligible"), v.alias("value"), "o_custkey",
    )


@query(f"WITH {_ROWS} SELECT arm, count(*) AS n, count(*) FILTER (coalesce(scored, ok, false)) AS all_scored, count(*) FILTER (ok AND scored IS NOT FALSE) AS successful, count(*) FILTER (eligible) AS eligible FROM rows_ GROUP BY arm")
def usable_scores(spark, d):
    rows = score_rows(spark, d)
    kept = E.population(rows, ["eligible"]).groupBy("arm").agg(F.count("*").alias("eligible"))
    return rows.groupBy("arm").agg(F.count("*").alias("n"), F.count_if(E.usable_score()).alias("all_scored"), F.count_if(E.usable_score("successful")).alias("successful")).join(kept, "arm")


@query(f"WITH {_ROWS} SELECT matcher, arm, count(*) AS n, round(avg(value), 3) AS value FROM rows_ WHERE matcher = 'exact' AND coalesce(repeat, 0) = 0 AND (arm LIKE '%HIGH%' OR arm LIKE '%LOW%') AND NOT arm LIKE '%3%' GROUP BY ALL")
def one_run(spark, d):
    rows = E.one_run(score_rows(spark, d), "exact", 0).where(E.named("arm", ["HIGH", "LOW"], ["3"]))
    return rows.groupBy("matcher", "arm").agg(F.count("*").alias("n"), F.round(F.avg("value"), 3).alias("value"))


@query("SELECT c_nationkey, count(DISTINCT c_mktsegment) AS n FROM customer WHERE c_custkey % 400 < 2 GROUP BY 1 HAVING count(DISTINCT c_mktsegment) > 1")
def mixed_configs(spark, d):
    return E.mixed_configs(table(spark, d, "customer").where("c_custkey % 400 < 2"), "c_nationkey", "c_mktsegment")


@query("SELECT p_partkey, (trim(p_name) = '' OR len(string_split_regex(trim(p_name), '\\s+')) < 2 OR lower(trim(p_type)) IN ('promo', 'economy')) AS bad FROM part")
def bad_task(spark, d):
    return table(spark, d, "part").select("p_partkey", (E.bad_task(F.col("p_name"), 2, ()) | E.bad_task(F.col("p_type"), 1, ("promo", "economy"))).alias("bad"))


@query("SELECT event_type, count(*) FILTER (isnan(x) OR isinf(x)) AS n_dropped, round(avg(x) FILTER (NOT isnan(x) AND NOT isinf(x)), 6) AS mean FROM (SELECT event_type, CASE WHEN event_id % 11 = 0 THEN 'nan'::DOUBLE WHEN event_id % 13 = 0 THEN 'inf'::DOUBLE ELSE value END AS x FROM events) GROUP BY 1")
def finite_rows(spark, d):
    x = F.when(F.col("event_id") % 11 == 0, float("nan")).when(F.col("event_id") % 13 == 0, float("inf")).otherwise(F.col("value"))
    kept, dropped = E.finite_rows(table(spark, d, "events").withColumn("x", x), "x", ["event_type"])
    return r6(dropped.join(kept.groupBy("event_type").agg(F.avg("x").alias("mean")), "event_type"))


@query("SELECT c_custkey, CASE WHEN list_contains(['BUILDING', 'MACHINERY'], c_mktsegment) THEN [c_mktsegment] ELSE ['front'] END AS cameras FROM customer")
def cameras(spark, d):
    return table(spark, d, "customer").select("c_custkey", E.cameras(F.array(F.lit("MACHINERY"), F.lit("BUILDING")), F.array("c_mktsegment"), 1, F.lit("front")).alias("cameras"))


@query(f"""{_REF}, {_EXT}, o AS (SELECT r.episode, idx, '  ' || text AS text, start - 50000.0 * (idx % 3) AS start, "end" FROM ref r), c AS (SELECT o.episode, idx, trim(text) AS text, least(greatest(start, t0), t1) AS a, least(greatest("end", t0), t1) AS b FROM o JOIN ext USING (episode)),
e AS (SELECT episode, row_number() OVER (PARTITION BY episode ORDER BY least(a, b), idx) - 1 AS idx, text, least(a, b) AS start, greatest(a, b) AS "end" FROM c)
SELECT episode, idx::BIGINT AS idx, text, round(start, 6) AS start, round("end", 6) AS "end" FROM e""")
def clean_spans(spark, d):
    rough = ref_spans(spark, d).select("episode", "idx", F.concat(F.lit("  "), "text").alias("text"), (F.col("start") - 50000.0 * (F.col("idx") % 3)).alias("start"), "end")
    return r6(E.clean_spans(rough, S.episode_extent(frames(spark, d))))


@query(f"""{_REF}, o AS (SELECT episode, idx, text, start - 50000.0 * (idx % 3) AS p, "end" FROM ref), num AS (SELECT episode, t, row_number() OVER (PARTITION BY episode ORDER BY t) AS f FROM (SELECT DISTINCT episode, t FROM frames)),
snap AS (SELECT * FROM (SELECT o.*, n.f, row_number() OVER (PARTITION BY o.episode, o.idx ORDER BY abs(n.t - o.p), n.t) AS k FROM o JOIN num n USING (episode)) WHERE k = 1),
s AS (SELECT *, row_number() OVER (PARTITION BY episode ORDER BY p, idx) AS i FROM snap), g AS (SELECT *, i + max(f - i) OVER (PARTITION BY episode ORDER BY i ROWS UNBOUNDED PRECEDING) AS h FROM s)
SELECT g.episode, idx, text, round(n.t, 6) AS start, round(greatest("end", n.t), 6) AS "end" FROM g JOIN num n ON n.episode = g.episode AND n.f = g.h""")
def distinct_frames(spark, d):
    late = ref_spans(spark, d).withColumn("start", F.col("start") - 50000.0 * (F.col("idx") % 3))
    return r6(E.distinct_frames(late, frames(spark, d)))


@query(f"""{_BOTH}, a AS (SELECT episode, list(text ORDER BY idx) AS l FROM ref GROUP BY 1), c AS (SELECT episode, idx, CASE WHEN episode % 2 = 0 THEN text ELSE 'x' || text END AS text, start + 1 AS start, "end" FROM ref), b AS (SELECT episode, list(text ORDER BY idx) AS l FROM c GROUP BY 1),
s AS (SELECT a.episode, coalesce(a.l = b.l, false) AS realigned FROM a LEFT JOIN b USING (episode))
SELECT episode, realigned, count(*) AS n, round(min(start), 6) AS first FROM (SELECT c.episode, start, realigned FROM c JOIN s USING (episode) WHERE realigned UNION ALL SELECT r.episode, start, realigned FROM ref r JOIN s USING (episode) WHERE NOT realigned) GROUP BY ALL""")
def accept_realigned(spark, d):
    ref = ref_spans(spark, d)
    moved = ref.withColumns({"text": F.when(F.col("episode") % 2 == 0, F.col("text")).otherwise(F.concat(F.lit("x"), "text")), "start": F.col("start") + 1})
    return r6(E.accept_realigned(ref, moved).groupBy("episode", "realigned").agg(F.count("*").alias("n"), F.min("start").alias("first")))


@query(f"""{_REF}, l AS (SELECT episode, max(idx) AS m FROM ref GROUP BY 1) SELECT r.episode, r.idx, count(f.t) AS n FROM ref r JOIN l USING (episode) LEFT JOIN frames f ON f.episode = r.episode AND f.t >= r.start AND (f.t < r."end" OR (r.idx = m AND f.t = r."end")) GROUP BY ALL""")
def samples_per_segment(spark, d):
    return E.samples_per_segment(frames(spark, d).select("episode", F.col("t").alias("at")), ref_spans(spark, d))


@query("""WITH c AS (SELECT o_custkey AS episode, o_orderkey AS first, o_orderkey + 3 AS last FROM orders), s AS (SELECT episode, first - lag(last) OVER (PARTITION BY episode ORDER BY first) AS d FROM c)
SELECT episode, coalesce(sum(CASE WHEN d > 1 THEN d - 1 END), 0)::BIGINT AS gap FROM s GROUP BY episode""")
def gap_frames(spark, d):
    clips = table(spark, d, "orders").select(F.col("o_custkey").alias("episode"), F.col("o_orderkey").alias("first"), (F.col("o_orderkey") + 3).alias("last"))
    return E.gap_frames(clips)


@query(f"""{_REF}, p AS (SELECT episode, idx, text, CASE WHEN episode % 4 = 1 THEN NULL WHEN episode % 4 = 2 AND idx = 1 THEN NULL WHEN episode % 4 = 3 AND idx = 2 THEN 1 ELSE idx END AS li FROM ref),
j AS (SELECT p.*, r.text AS want, lag(li) OVER (PARTITION BY p.episode ORDER BY p.idx) AS pv FROM p LEFT JOIN ref r ON r.episode = p.episode AND r.idx = p.li)
SELECT episode, CASE WHEN count(li) = 0 THEN 'none' WHEN count(li) < count(*) THEN 'some spans carry a label index and others do not' WHEN bool_or(li IS NOT NULL AND want IS NULL) THEN 'label index out of range' WHEN bool_or(li <= pv) THEN 'label indices are not strictly increasing' WHEN bool_or(text <> want) THEN 'span carries another text' END AS reason FROM j GROUP BY episode""")
def explicit_indices(spark, d):
    e, i = F.col("episode") % 4, F.col("idx")
    own = F.when(e == 1, None).when((e == 2) & (i == 1), None).when((e == 3) & (i == 2), 1).otherwise(i)
    return E.explicit_indices(ref_spans(spark, d).withColumn("label_index", own), ref_spans(spark, d))


# ---- matchers ---------------------------------------------------------------------------------------


def _matched(name: str, same: str, sim: str) -> str:
    return f"""{_PAIRS.replace('p.text AS pt', "CASE WHEN p.text IN ('view', 'click') THEN 'Browse' WHEN p.text = 'error' THEN 'the browse' ELSE p.text END AS pt").replace('r.text AS rt', "CASE WHEN r.text IN ('view', 'click') THEN 'Browse' WHEN r.text = 'error' THEN 'the browse' ELSE r.text END AS rt")},
m AS (SELECT *, {_NORM.format('pt')} AS a, {_NORM.format('rt')} AS b FROM pairs), g AS (SELECT episode, ri AS idx, sum(ov) FILTER ({same}) AS o, max(CASE WHEN iou >= 0.3 THEN {sim} ELSE 0 END) AS h3 FROM m GROUP BY ALL)
SELECT r.episode, round(coalesce(sum(least(coalesce(o, 0), "end" - start)) / nullif(sum("end" - start), 0), 0), 6) AS label_accuracy, round(avg(coalesce(h3, 0)), 6) AS recall_3 FROM ref r LEFT JOIN g USING (episode, idx) GROUP BY r.episode"""


def _by_matcher(spark, d, matcher):
    p, r = coarse_spans(pred_spans(spark, d)), coarse_spans(ref_spans(spark, d))
    return r6(M.label_accuracy(p, r, matcher).join(M.dense_caption(p, r, (0.3,), matcher).select("episode", "recall_3"), "episode"))


@query(_matched("exact", "a = b", "(a = b)::INT"))
def labels_by_exact_matcher(spark, d):
    return _by_matcher(spark, d, L.EXACT)


@query(_matched("embedding", "a[1] = b[1]", "(a[1] = b[1])::INT"))
def labels_by_embedding_matcher(spark, d):
    """Vectors that agree where labels begin with the same letter."""
    words = spark.createDataFrame([(w,) for w in ("browse", "purchase", "signup")], "label string")
    vector = F.transform(F.sequence(F.lit(97), F.lit(122)), lambda k: F.when(F.ascii("label") == k, 1.0).otherwise(0.0))
    return _by_matcher(spark, d, L.Embedding(words.select("label", vector.alias("vector"))))


_SIDES = "[" + ", ".join("MAP {" + ", ".join(f"'{w}': '{s}'" for w, s in g.items()) + "}" for g in L.CONTRASTS) + "]"


@query(f"""WITH p AS (SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN 'left ' WHEN 1 THEN 'open the ' WHEN 2 THEN 'into top ' WHEN 3 THEN 'first ' ELSE 'left right ' END || p_name AS a, CASE p_partkey % 4 WHEN 0 THEN 'Right ' WHEN 1 THEN 'shut ' WHEN 2 THEN 'onto bottom ' ELSE 'opening third ' END || p_name AS b FROM part),
t AS (SELECT p_partkey, string_split({_NORM.format('a')}, ' ') AS a, string_split({_NORM.format('b')}, ' ') AS b FROM p),
g AS (SELECT p_partkey, list_distinct(list_filter(list_transform(a, lambda w: m[w]), lambda s: s IS NOT NULL)) AS x, list_distinct(list_filter(list_transform(b, lambda w: m[w]), lambda s: s IS NOT NULL)) AS y FROM t, (SELECT unnest({_SIDES}) AS m))
SELECT p_partkey, bool_or(len(x) = 1 AND len(y) = 1 AND x[1] <> y[1]) AS conflict FROM g GROUP BY 1""")
def contrast_conflicts(spark, d):
    k = F.col("p_partkey")
    a = F.when(k % 5 == 0, "left ").when(k % 5 == 1, "open the ").when(k % 5 == 2, "into top ").when(k % 5 == 3, "first ").otherwise("left right ")
    b = F.when(k % 4 == 0, "Right ").when(k % 4 == 1, "shut ").when(k % 4 == 2, "onto bottom ").otherwise("opening third ")
    return table(spark, d, "part").select("p_partkey", L.contrast_conflict(F.concat(a, "p_name"), F.concat(b, "p_name")).alias("conflict"))


_F1 = "CASE WHEN len(list_filter(a, lambda w: w <> '')) = 0 AND len(list_filter(b, lambda w: w <> '')) = 0 THEN 1.0 ELSE coalesce(2.0 * len(list_filter(list_intersect(a, b), lambda w: w <> '')) / nullif(len(list_filter(a, lambda w: w <> '')) + len(list_filter(b, lambda w: w <> '')), 0), 0) END"


@query(f"""WITH w AS (SELECT p_partkey AS position, p_type AS word FROM part WHERE p_partkey <= 40), l AS (SELECT DISTINCT p_type AS label FROM part),
s AS (SELECT label, word, position, list_distinct(string_split({_NORM.format('label')}, ' ')) AS a, list_distinct(string_split({_NORM.format('word')}, ' ')) AS b FROM l, w), q AS (SELECT label, word, {_F1} AS s, row_number() OVER (PARTITION BY label ORDER BY {_F1} DESC, position) AS k FROM s)
SELECT label, CASE WHEN s >= 0.5 THEN word END AS word, round(s, 6) AS similarity FROM q WHERE k = 1""")
def vocabulary_projection(spark, d):
    part = table(spark, d, "part")
    words = part.where("p_partkey <= 40").select(F.col("p_partkey").alias("position"), F.col("p_type").alias("word"))
    return r6(U.project(part.select(F.col("p_type").alias("label")), words, L.TokenF1(), 0.5))


@query(f"""{_BOTH}, p AS (SELECT DISTINCT episode, text AS p FROM pred), r AS (SELECT DISTINCT episode, text AS r FROM ref), b AS (SELECT DISTINCT episode, least(p, r) AS "left", greatest(p, r) AS "right" FROM p JOIN r USING (episode) WHERE p <> r)
SELECT substr(sha256("left" || chr(0) || "right"), 1, 12) AS pair, "left", "right", count(*) AS n_episodes FROM b GROUP BY "left", "right" """)
def label_contexts(spark, d):
    return U.label_contexts(pred_spans(spark, d), ref_spans(spark, d))


@query(f"""WITH l AS (SELECT DISTINCT p_brand, {_NORM.format('p_type')} AS a FROM part) SELECT x.p_brand, x.a, y.a AS b FROM l x JOIN l y ON x.p_brand = y.p_brand AND x.a < y.a""")
def label_combinations(spark, d):
    return U.combinations(table(spark, d, "part"), "p_brand", "p_type")


@query(f"""{_PAIRS}, m AS (SELECT *, {_NORM.format('pt')} AS a, {_NORM.format('rt')} AS b, (episode % 3)::VARCHAR AS arm, episode % 7 AS dataset, episode * 100000000 + pi * 10000 + ri AS o FROM pairs WHERE abs(pi - ri) <= 1),
q AS (SELECT *, CASE WHEN iou <= 0.1 THEN 'pair_below_min_iou' WHEN a = '' OR b = '' THEN 'empty_label' WHEN a = b THEN 'identical_after_normalisation' END AS reason FROM m)
SELECT substr(sha256(least(a, b) || chr(0) || greatest(a, b)), 1, 12) AS pair, arg_min(pt, o) AS model_label, arg_min(rt, o) AS human_label, count(*) AS occurrences, count(DISTINCT arm) AS n_arms, count(DISTINCT dataset) AS n_datasets, round(max(iou), 6) AS max_iou FROM q WHERE reason IS NULL GROUP BY 1""")
def pair_harvest(spark, d):
    return r6(U.harvest(_near_pairs(spark, d), 0.1)[0])


@query(f"""{_PAIRS}, q AS (SELECT CASE WHEN iou <= 0.1 THEN 'pair_below_min_iou' WHEN pt = '' OR rt = '' THEN 'empty_label' WHEN pt = rt THEN 'identical_after_normalisation' END AS reason FROM pairs WHERE abs(pi - ri) <= 1) SELECT reason, count(*) AS n FROM q WHERE reason IS NOT NULL GROUP BY 1""")
def pair_skips(spark, d):
    return U.harvest(_near_pairs(spark, d), 0.1)[1]


def _near_pairs(spark, d):
    both = M.pairs(pred_spans(spark, d), ref_spans(spark, d)).where("abs(p_idx - r_idx) <= 1")
    return both.select("p_text", "r_text", "iou", (F.col("episode") % 3).cast("string").alias("arm"), (F.col("episode") % 7).alias("dataset"), (F.col("episode") * 100000000 + F.col("p_idx") * 10000 + F.col("r_idx")).alias("order"))


_REVIEWS = f"""rv AS (SELECT p_partkey, substr(sha256(least({_NORM.format('p_name')}, {_NORM.format('p_type')}) || chr(0) || greatest({_NORM.format('p_name')}, {_NORM.format('p_type')})), 1, 12) AS pair, (p_size % 50) / 50.0 AS similarity, CASE WHEN p_size % 7 = 0 THEN NULL ELSE p_size % 3 = 0 END AS verdict FROM part),
st AS (SELECT *, CASE WHEN abs(similarity - 0.5) <= 0.1000001 THEN 'near' WHEN similarity >= 0.5 THEN 'accepted' ELSE 'rejected' END AS stratum, ('0x' || substr(pair, 1, 8))::BIGINT % 2 = 1 AS flipped FROM rv)"""


def _reviews(spark, d):
    rows = table(spark, d, "part").select("p_partkey", L.pair_id(F.col("p_name"), F.col("p_type")).alias("pair"), (F.col("p_size") % 50 / 50.0).alias("similarity"), F.when(F.col("p_size") % 7 != 0, F.col("p_size") % 3 == 0).alias("verdict"))
    return U.stratify(rows, "similarity", 0.5, 0.1000001)


@query(f"WITH {_REVIEWS} SELECT stratum, flipped, count(*) AS n FROM st GROUP BY ALL")
def pair_strata(spark, d):
    return _reviews(spark, d).groupBy("stratum", "flipped").agg(F.count("*").alias("n"))


@query(f"WITH {_REVIEWS} SELECT stratum, count(*) AS n, round(avg((verdict = (similarity >= 0.5))::INT), 6) AS agree, count(*) FILTER (similarity >= 0.5 AND NOT verdict) AS false_match, count(*) FILTER (similarity < 0.5 AND verdict) AS false_split FROM st WHERE verdict IS NOT NULL GROUP BY 1")
def stratum_agreement(spark, d):
    return r6(U.stratum_agreement(_reviews(spark, d), 0.5))


# ---- consistency, cohorts, arms -----------------------------------------------------------------------


@query(f"""WITH c AS (SELECT p_brand, {_NORM.format('p_type')} AS label, count(*) AS n FROM part GROUP BY ALL)
SELECT p_brand, sum(n)::BIGINT AS n_segments, count(*) AS n_distinct, round(count(*) / sum(n), 6) AS per_segment, round(ln(sum(n)) - sum(n * ln(n)) / sum(n), 6) AS entropy FROM c GROUP BY p_brand""")
def vocabulary_stability(spark, d):
    return r6(U.vocabulary(table(spark, d, "part").withColumnRenamed("p_type", "text"), "p_brand"))


def _gap(c: str) -> str:
    return f"round(p_{c}, 6) AS pred_{c}, round(t_{c}, 6) AS true_{c}, round(p_{c} - t_{c}, 6) AS gap_{c}"


def _diverse(src: str, p: str) -> str:
    return f"""(SELECT count(*) AS {p}_n_distinct_sequences, max(n) / sum(n) AS {p}_modal_fraction, ln(sum(n)) - sum(n * ln(n)) / sum(n) AS {p}_sequence_entropy, any_value(v) AS {p}_n_distinct FROM (SELECT s, count(*) AS n FROM (SELECT episode, list(text ORDER BY idx) AS s FROM {src} GROUP BY 1) GROUP BY 1), (SELECT count(DISTINCT text) AS v FROM {src}))"""


@query(f"{_BOTH} SELECT {', '.join(map(_gap, ('n_distinct_sequences', 'modal_fraction', 'n_distinct', 'sequence_entropy')))} FROM {_diverse('pred', 'p')}, {_diverse('ref', 't')}")
def consistency_gap(spark, d):
    out = U.consistency_gap(pred_spans(spark, d), ref_spans(spark, d))
    return r6(out)


@query("SELECT c_nationkey AS task, c_mktsegment AS n_segments, count(*) AS n, count(*) >= 12 AS usable FROM customer GROUP BY ALL")
def seed_cohorts(spark, d):
    return U.cohorts(table(spark, d, "customer").select(F.col("c_nationkey").alias("task"), F.col("c_mktsegment").alias("n_segments")), 12)


@query("""SELECT 'p_size' AS "column", [min(p_size)::DOUBLE] AS min, [max(p_size)::DOUBLE] AS max, [avg(p_size)] AS mean, [round(stddev_pop(p_size), 6)] AS std, [count(p_size)] AS count FROM part""")
def column_stats(spark, d):
    out = U.column_stats(table(spark, d, "part"), ["p_size"])
    return out.withColumn("std", F.transform("std", lambda x: F.round(x, 6)))


@query("""WITH h AS (SELECT DISTINCT c_nationkey, c_custkey, o_orderpriority FROM orders JOIN customer ON o_custkey = c_custkey), t AS (SELECT c_nationkey, count(*) AS total FROM customer GROUP BY 1), g AS (SELECT c_nationkey, o_orderpriority, count(*) AS got FROM h GROUP BY ALL)
SELECT t.c_nationkey, a.o_orderpriority, total, total - coalesce(got, 0) AS missing FROM t, (SELECT DISTINCT o_orderpriority FROM orders) a LEFT JOIN g ON g.c_nationkey = t.c_nationkey AND g.o_orderpriority = a.o_orderpriority""")
def missing_census(spark, d):
    c = table(spark, d, "customer")
    have = table(spark, d, "orders").join(c, F.col("o_custkey") == F.col("c_custkey"))
    return U.missing_census(c, have, "c_nationkey", "o_orderpriority", "c_custkey")


@query(f"""{_REF}, {_EXT}, s AS (SELECT n_frames % 3 AS task, idx, (start - t0) / (t1 - t0) AS x FROM ref JOIN ext USING (episode) WHERE idx > 0 AND t1 > t0), g AS (SELECT task, idx, count(*) AS n, stddev_pop(x) AS sd FROM s GROUP BY ALL HAVING count(*) >= 8)
SELECT count(*) AS n_slots, round(median(sd), 6) AS boundary_sd FROM g""")
def boundary_regularity(spark, d):
    rows = ref_spans(spark, d).join(S.episode_extent(frames(spark, d)), "episode").where("idx > 0 AND t_last > t0")
    return r6(U.boundary_regularity(rows.select((F.col("n_frames") % 3).alias("task"), "idx", ((F.col("start") - F.col("t0")) / (F.col("t_last") - F.col("t0"))).alias("x")), ["task", "idx"], "x"))


@query("""WITH v AS (SELECT c_nationkey AS tr, c_custkey, c_acctbal AS du, [c_acctbal, c_custkey::DOUBLE] AS b FROM customer), m AS (SELECT tr, median(du) AS m FROM v GROUP BY 1), k AS (SELECT v.*, count(*) OVER (PARTITION BY v.tr) AS n FROM v JOIN m USING (tr) WHERE abs(du - m) <= 2000),
e AS (SELECT tr, i, b[i] AS x FROM k, (SELECT unnest([1, 2]) AS i) WHERE n >= 3), c AS (SELECT tr, i, median(x) AS c FROM e GROUP BY ALL), z AS (SELECT tr, abs(x - c) AS dv FROM e JOIN c USING (tr, i))
SELECT count(DISTINCT tr) AS trajectories, count(*) AS pairs, round(avg(dv), 6) AS mean, round(median(dv), 6) AS median, round(avg((dv <= 1)::INT), 6) AS within_1 FROM z""")
def cross_view(spark, d):
    views = table(spark, d, "customer").select(F.col("c_nationkey").alias("trajectory"), F.col("c_custkey").alias("view"), F.col("c_acctbal").alias("duration"), F.array("c_acctbal", F.col("c_custkey").cast("double")).alias("boundaries"))
    return r6(U.cross_view(views, 2000.0))


@query("""WITH a(position, arm, tool, flags) AS (SELECT n_nationkey, n_name, n_regionkey, CASE WHEN n_nationkey % 2 = 0 THEN 'cal' ELSE '' END || (n_nationkey % 3)::VARCHAR FROM nation)
SELECT x.arm, arg_min(y.arm, y.position) AS counterpart FROM a x JOIN a y ON x.tool = y.tool AND x.arm <> y.arm AND x.flags LIKE 'cal%' AND y.flags = substr(x.flags, 4) GROUP BY x.arm""")
def counterpart_arms(spark, d):
    k = F.col("n_nationkey")
    own = F.create_map(F.lit("mode"), (k % 3).cast("string"))
    arms = table(spark, d, "nation").select(k.alias("position"), F.col("n_name").alias("arm"), F.col("n_regionkey").alias("tool"), F.when(k % 2 == 0, F.map_concat(own, F.create_map(F.lit("cal"), F.lit("x")))).otherwise(own).alias("flags"))
    return U.counterparts(arms, "cal")


@query("""WITH b AS (SELECT c_nationkey, avg(o_totalprice) AS baseline FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderstatus = 'P' GROUP BY 1), v AS (SELECT c_nationkey, o_orderstatus, avg(o_totalprice) AS value FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderstatus <> 'P' GROUP BY ALL)
SELECT c_nationkey, o_orderstatus, round(value, 3) AS value, round(baseline, 3) AS baseline, round(value - baseline, 3) AS delta FROM v JOIN b USING (c_nationkey)""")
def cell_baselines(spark, d):
    rows = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    out = U.cell_baselines(rows, "o_orderstatus", "P", ["c_nationkey"], "o_totalprice")
    return out.select("c_nationkey", "o_orderstatus", *[F.round(c, 3).alias(c) for c in ("value", "baseline", "delta")])


@query("""WITH s AS (SELECT o_custkey, bool_or(o_orderstatus = 'F') AS a, bool_or(o_orderstatus = 'P') AS b FROM orders WHERE o_orderstatus IN ('F', 'P') GROUP BY 1) SELECT count(*) FILTER (a AND b) AS shared, count(*) FILTER (a AND NOT b) AS a_only, count(*) FILTER (b AND NOT a) AS b_only FROM s""")
def shared_keys(spark, d):
    return U.shared_keys(table(spark, d, "orders"), ["o_custkey"], "o_orderstatus", "F", "P")


@query("""WITH w AS (SELECT c_nationkey, o_orderstatus AS arm, avg(o_totalprice) AS price, avg(o_custkey) AS cust FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL), l AS (SELECT c_nationkey, arm, 'price' AS metric, price AS v, 1 AS up FROM w UNION ALL SELECT c_nationkey, arm, 'cust', cust, -1 FROM w),
q AS (SELECT a.arm || ' - ' || b.arm AS contrast, a.metric, a.v AS a, b.v AS b, (a.v - b.v) * a.up AS d FROM l a JOIN l b USING (c_nationkey, metric) WHERE (a.arm, b.arm) IN (('F', 'O'), ('F', 'P'))),
s AS (SELECT contrast, metric, count(*) AS n, avg(a) AS mean_a, avg(b) AS mean_b, avg(a - b) AS delta, count(*) FILTER (d > 0) AS wins, count(*) FILTER (d < 0) AS losses FROM q GROUP BY ALL),
k AS (SELECT x.contrast, x.metric, s.* EXCLUDE (contrast, metric) FROM (SELECT unnest(['F - O', 'F - P', 'F - X']) AS contrast, unnest([['price', 'cust'], ['price', 'cust'], ['price', 'cust']]) AS ms) z, LATERAL (SELECT z.contrast, unnest(z.ms) AS metric) x LEFT JOIN s ON s.contrast = x.contrast AND s.metric = x.metric)
SELECT contrast, metric, n, round(mean_a, 3) AS mean_a, round(mean_b, 3) AS mean_b, round(delta, 3) AS delta, wins, losses, round(coalesce(least(1.0, 2 * (SELECT sum(exp(lgamma(wins + losses + 1) - lgamma(i + 1) - lgamma(wins + losses - i + 1) - (wins + losses) * ln(2))) FROM range(0, 100) t(i) WHERE i <= least(wins, losses))), 1.0), 6) AS p,
  CASE WHEN n IS NULL THEN 'no paired rows' END AS unavailable FROM k""")
def contrast_family(spark, d):
    rows = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey")).select("c_nationkey", F.col("o_orderstatus").alias("arm"), F.col("o_totalprice").alias("price"), F.col("o_custkey").cast("double").alias("cust"))
    out = U.contrast_family(rows, ["c_nationkey"], "arm", {"price": True, "cust": False}, [("F", "O"), ("F", "P"), ("F", "X")])
    return out.select("contrast", "metric", "n", *[F.round(c, 3).alias(c) for c in ("mean_a", "mean_b", "delta")], "wins", "losses", F.round("p", 6).alias("p"), "unavailable")


@query()
def percentile_bootstrap(spark, d):
    """Totals of finished orders less those of open ones by nation, in each market segment."""
    rows = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    side = lambda x: F.avg(F.when(F.col("o_orderstatus") == x, F.col("o_totalprice")))
    deltas = rows.groupBy("c_mktsegment", "c_nationkey").agg((side("F") - side("O")).alias("delta")).where("delta IS NOT NULL")
    return U.percentile_bootstrap(deltas, "c_mktsegment", "c_nationkey", "delta")


@query("""WITH r AS (SELECT p_brand, rank() OVER (PARTITION BY p_brand ORDER BY p_size) + (count(*) OVER (PARTITION BY p_brand, p_size) - 1) / 2.0 AS x, rank() OVER (PARTITION BY p_brand ORDER BY p_retailprice) + (count(*) OVER (PARTITION BY p_brand, p_retailprice) - 1) / 2.0 AS y FROM part)
SELECT p_brand, count(*) AS n, round(CASE WHEN var_pop(x) > 0 AND var_pop(y) > 0 THEN corr(x, y) END, 6) AS rho FROM r GROUP BY 1""")
def spearman(spark, d):
    return r6(U.spearman(table(spark, d, "part"), "p_brand", "p_size", "p_retailprice"))


@query(f"""{_BOTH}, {_EXT}, s AS (SELECT episode, t0 + i * 86400.0 AS x FROM (SELECT *, unnest(range(1, greatest(1, ceil((t1 - t0) / 86400.0)::INT))) AS i FROM ext)),
b AS (SELECT 'pred' AS arm, episode, idx, start AS a FROM pred WHERE idx > 0 UNION ALL SELECT 'ref', episode, idx, start FROM ref WHERE idx > 0), k AS (SELECT b.arm, b.episode, b.idx, min(abs(x - a)) <= 7200 AS near FROM b JOIN s USING (episode) GROUP BY ALL)
SELECT arm, count(*) AS boundaries, count(*) FILTER (near) AS on_seam, round(avg(near::INT), 6) AS seam_share FROM k GROUP BY arm""")
def seam_share(spark, d):
    seams = S.fixed_windows(S.episode_extent(frames(spark, d)), 86400.0).where("idx > 0").select("episode", F.col("start").alias("at"))
    side = lambda x, arm: x.where("idx > 0").select(F.lit(arm).alias("arm"), "episode", F.col("start").alias("at"))
    return r6(U.seam_share(side(pred_spans(spark, d), "pred").unionByName(side(ref_spans(spark, d), "ref")), seams, "arm", 7200.0))


@query(f"""WITH {_FRAMES}, {_EXT}, turns AS (SELECT conv_id AS episode, turn AS idx, role AS text, turn::DOUBLE AS start, turn + 1.0 AS "end" FROM conversations),
sq AS (SELECT episode, list(text ORDER BY idx) AS l, count(*) AS n, min(start) AS s, max("end") AS e FROM turns GROUP BY 1), mn AS (SELECT n AS k FROM sq GROUP BY n ORDER BY count(*) DESC, min(episode) LIMIT 1), ml AS (SELECT l FROM sq GROUP BY l ORDER BY count(*) DESC, min(episode) LIMIT 1),
cu AS (SELECT t.idx, avg((t.start - sq.s) / (sq.e - sq.s)) AS x FROM turns t JOIN sq USING (episode) JOIN ml USING (l) WHERE t.idx > 0 GROUP BY t.idx), ed AS (SELECT [0.0] || list(x ORDER BY x) || [1.0] AS ed FROM cu), nt AS (SELECT episode, count(*) AS k FROM turns GROUP BY 1),
un AS (SELECT 'single' AS arm, episode, 0 AS idx, 'perform the task' AS text, t0 AS start, t1 AS "end" FROM ext UNION ALL
  SELECT 'uniform_true', episode, i, 'segment ' || (i + 1), t0 + (t1 - t0) * i / k, t0 + (t1 - t0) * (i + 1) / k FROM (SELECT ext.*, k, unnest(range(0, k)) AS i FROM ext JOIN nt USING (episode)) UNION ALL
  SELECT 'uniform_modal', episode, i, 'segment ' || (i + 1), t0 + (t1 - t0) * i / k, t0 + (t1 - t0) * (i + 1) / k FROM (SELECT ext.*, k, unnest(range(0, k)) AS i FROM ext, mn) UNION ALL
  SELECT 'script_prior', episode, i - 1, l[i], t0 + (t1 - t0) * ed[i], t0 + (t1 - t0) * ed[i + 1] FROM (SELECT ext.*, l, ed, unnest(range(1, len(l) + 1)) AS i FROM ext, ml, ed))
SELECT arm, episode, idx::BIGINT AS idx, text, round(start, 3) AS start, round("end", 3) AS "end" FROM un""")
def reference_arms(spark, d):
    turns = table(spark, d, "conversations").select(F.col("conv_id").alias("episode"), F.col("turn").alias("idx"), F.col("role").alias("text"), F.col("turn").cast("double").alias("start"), (F.col("turn") + 1.0).alias("end"))
    out = U.reference_arms(S.episode_extent(frames(spark, d)), turns, turns)
    return out.withColumns({c: F.round(c, 3) for c in ("start", "end")})


@query()
def leave_one_out(spark, d):
    """Episodes of one number of spans, squeezed to a minute; the prediction starts late by a share that differs by boundary."""
    from .operators.calibration import leave_one_out as op

    ext = S.episode_extent(frames(spark, d)).where("t_last > t0")
    at = lambda c: (F.col(c) - F.col("t0")) * 60.0 / (F.col("t_last") - F.col("t0"))
    ref = ref_spans(spark, d).join(ext, "episode").select("episode", "idx", "text", at("start").alias("start"), at("end").alias("end")).where("start < end")
    ref = ref.withColumn("idx", (F.row_number().over(Window.partitionBy("episode").orderBy("start")) - 1).cast("long"))
    w = Window.partitionBy("episode").orderBy("idx")
    late = ref.withColumn("start", F.when(F.col("idx") > 0, F.col("start") + 0.3 * (F.col("end") - F.col("start"))).otherwise(F.col("start")))
    pred = late.withColumn("end", F.coalesce(F.lead("start").over(w), F.col("end")))
    cohort = ref.groupBy("episode").agg(F.count("*").alias("cohort"))
    return op(pred, ref, cohort)


@query("""WITH t AS (SELECT conv_id AS e, turn, turn + 1.0 + (conv_id % 5) * turn / 10.0 AS s, count(*) OVER (PARTITION BY conv_id) AS n, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS i FROM conversations), x AS (SELECT *, arg_min(s, turn) OVER (PARTITION BY e) AS t0, max(s + 1) OVER (PARTITION BY e) AS t1 FROM t),
m AS (SELECT n, i, count(*) AS k, median((s - t0) / (t1 - t0)) AS m FROM x WHERE i > 0 GROUP BY ALL HAVING count(*) >= 3)
SELECT n AS n_segments, i::INT AS i, round(least(1.0, greatest(0.0, max(m) OVER (PARTITION BY n ORDER BY i))), 6) AS position FROM m""")
def count_positions(spark, d):
    from .operators.calibration import count_positions as op

    return r6(op(_turn_spans(spark, d)))


def _turn_spans(spark, d):
    start = F.col("turn") + 1.0 + (F.col("conv_id") % 5) * F.col("turn") / 10.0
    return table(spark, d, "conversations").select(F.col("conv_id").alias("episode"), F.col("turn").alias("idx"), F.col("role").alias("text"), start.alias("start"), (start + 1).alias("end"))


@query("""WITH t AS (SELECT conv_id AS e, turn, turn + 1.0 + (conv_id % 5) * turn / 10.0 AS s, count(*) OVER (PARTITION BY conv_id) AS n, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS i FROM conversations), x AS (SELECT *, arg_min(s, turn) OVER (PARTITION BY e) AS t0, max(s + 1) OVER (PARTITION BY e) AS t1 FROM t),
m AS (SELECT round(i / n, 9) AS x, median((s - t0) / (t1 - t0)) AS m FROM x WHERE i > 0 GROUP BY 1 UNION ALL SELECT 0.0, 0.0 UNION ALL SELECT 1.0, 1.0)
SELECT round(x, 6) AS x, round(least(1.0, max(m) OVER (ORDER BY x)), 6) AS y FROM m""")
def progress_curve(spark, d):
    from .operators.calibration import progress_curve as op

    return r6(op(_turn_spans(spark, d)))


# ---- text, selection, splits --------------------------------------------------------------------------


@query("""SELECT p_partkey, CASE WHEN f = '' THEN c ELSE f END AS family FROM (SELECT *, regexp_extract(c, '^(.*?)-[0-9]+(?:-.*)?$', 1) AS f FROM (SELECT p_partkey, replace(lower(p_name), ' ', '-') || '-' || p_size || '-b' || p_partkey AS c FROM part))""")
def component_family(spark, d):
    c = F.concat(F.replace(F.lower("p_name"), F.lit(" "), F.lit("-")), F.lit("-"), F.col("p_size").cast("string"), F.lit("-b"), F.col("p_partkey").cast("string"))
    return table(spark, d, "part").select("p_partkey", U.family_of(c).alias("family"))


@query("""SELECT p_partkey, trim(trim(trim('"' || '''' || p_name || '" '), '"'), '''') AS name FROM part""")
def quotes_stripped(spark, d):
    return table(spark, d, "part").select("p_partkey", U.strip_quotes(F.concat(F.lit("\"'"), "p_name", F.lit('" '))).alias("name"))


@query("""SELECT event_id, sha256('{"k":"' || (props::JSON ->> 'k') || '"}') AS fingerprint FROM events""")
def json_fingerprint(spark, d):
    return table(spark, d, "events").select("event_id", U.fingerprint(F.col("props")).alias("fingerprint"))


@query("""SELECT o_orderkey, [[0, o_custkey], [o_custkey + 1, o_custkey + 9]] AS clips FROM orders""")
def clip_lists(spark, d):
    k = F.col("o_custkey")
    text = F.concat(F.lit("[[0,"), k.cast("string"), F.lit("],["), (k + 1).cast("string"), F.lit(","), (k + 9).cast("string"), F.lit("]]"))
    return table(spark, d, "orders").select("o_orderkey", F.transform(U.parse_clips(text), lambda x: x.cast("array<bigint>")).alias("clips"))


@query("""WITH r AS (SELECT c_nationkey, c_custkey, c_acctbal, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal, c_custkey) AS k, count(*) OVER (PARTITION BY c_nationkey) AS n FROM customer)
SELECT c_nationkey, c_custkey, CASE WHEN k <= 2 THEN 'worst' WHEN k > n - 2 THEN 'best' ELSE 'median' END AS slice FROM r WHERE k <= 2 OR k > n - 2 OR k = (n + 1) // 2""")
def slices(spark, d):
    from .operators.selection import slices as op

    return op(table(spark, d, "customer"), ["c_nationkey"], ["c_acctbal", "c_custkey"], 2, 1).select("c_nationkey", "c_custkey", "slice")


@query("""WITH r AS (SELECT c_nationkey, c_custkey, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS k FROM customer) SELECT c_nationkey, c_custkey, CASE WHEN k <= 10 THEN 'seed' ELSE 'eval' END AS split FROM r WHERE k <= 25""")
def seed_split(spark, d):
    from .operators.selection import seed_split as op

    return op(table(spark, d, "customer"), ["c_nationkey"], "c_custkey", 10, 15).select("c_nationkey", "c_custkey", "split")


@query("""WITH r AS (SELECT c_nationkey, c_custkey, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal, c_custkey) - 1 AS k, count(*) OVER (PARTITION BY c_nationkey) AS n FROM customer) SELECT DISTINCT c_nationkey, c_custkey FROM r, (SELECT unnest(range(0, 5)) AS i) WHERE k = round_even(i * (n - 1) / 4.0, 0)""")
def length_quantiles(spark, d):
    from .operators.selection import length_quantiles as op

    return op(table(spark, d, "customer"), ["c_nationkey"], ["c_acctbal", "c_custkey"], 5).select("c_nationkey", "c_custkey")


_SPLITS = "sp AS (SELECT c_nationkey AS task, c_custkey % 300 AS episode, CASE WHEN c_custkey % 9 = 0 THEN 'seed' ELSE 'eval' END AS role, c_acctbal > 0 AS has_truth FROM customer)"


@query(f"""WITH {_SPLITS}, a AS (SELECT task, count(*) AS n FROM sp WHERE role = 'seed' GROUP BY 1 HAVING count(*) > 6), b AS (SELECT task, role, episode FROM sp GROUP BY ALL HAVING count(*) > 1), c AS (SELECT episode FROM sp GROUP BY 1 HAVING count(DISTINCT task) > 1 OR count(DISTINCT role) > 1), e AS (SELECT DISTINCT task, episode FROM sp WHERE role = 'seed' AND NOT has_truth)
SELECT 'too many seeds' AS problem, count(*) AS n FROM a UNION ALL SELECT 'repeated', count(*) FROM b UNION ALL SELECT 'shared', count(*) FROM c UNION ALL SELECT 'seed without truth', count(*) FROM e""")
def split_problems(spark, d):
    from .operators.validation import split_problems as op

    c = F.col("c_custkey")
    rows = table(spark, d, "customer").select(F.col("c_nationkey").alias("task"), (c % 300).alias("episode"), F.when(c % 9 == 0, "seed").otherwise("eval").alias("role"), (F.col("c_acctbal") > 0).alias("has_truth"))
    return op(rows, 6)


@query("""SELECT p_partkey, trim(p_name || CASE WHEN p_partkey % 3 = 0 THEN ' ' ELSE '' END) = '' AS empty, true AS unstripped FROM part WHERE p_partkey % 3 = 0""")
def label_problems(spark, d):
    from .operators.validation import label_problems as op

    return op(table(spark, d, "part").select("p_partkey", F.concat("p_name", F.when(F.col("p_partkey") % 3 == 0, " ").otherwise("")).alias("label")), "label").select("p_partkey", "empty", "unstripped")


@query("""WITH g AS (SELECT DISTINCT c_nationkey, c_custkey FROM customer WHERE c_custkey % 10 <> 0), w AS (SELECT DISTINCT c_nationkey, c_custkey FROM customer WHERE c_custkey % 11 <> 0)
SELECT coalesce(g.c_nationkey, w.c_nationkey) AS c_nationkey, count(*) FILTER (g.c_custkey IS NULL) AS missing, count(*) FILTER (w.c_custkey IS NULL) AS unexpected FROM g FULL JOIN w USING (c_nationkey, c_custkey) GROUP BY 1 HAVING count(*) FILTER (g.c_custkey IS NULL) + count(*) FILTER (w.c_custkey IS NULL) > 0""")
def coverage_difference(spark, d):
    from .operators.validation import coverage_difference as op

    c = table(spark, d, "customer").select("c_nationkey", "c_custkey")
    return op(c.where("c_custkey % 10 <> 0"), c.where("c_custkey % 11 <> 0"), "c_nationkey", "c_custkey")


@query(f"{_BOTH} SELECT r.episode, coalesce(p.l = r.l, false) AS same FROM (SELECT episode, list(text ORDER BY idx) AS l FROM ref GROUP BY 1) r LEFT JOIN (SELECT episode, list(text ORDER BY idx) AS l FROM pred GROUP BY 1) p USING (episode)")
def supplied_labels(spark, d):
    from .operators.validation import same_labels

    return same_labels(pred_spans(spark, d), ref_spans(spark, d))


@query("""SELECT conv_id AS episode, turn, CASE WHEN style IN ('vqa', 'trace') AND camera IS NULL THEN 'camera missing' WHEN style IN ('vqa', 'trace') AND camera NOT IN ('front', 'wrist') THEN 'unknown camera' WHEN style NOT IN ('vqa', 'trace') AND camera IS NOT NULL THEN 'camera given' END AS problem
FROM (SELECT conv_id, turn, CASE WHEN role = 'assistant' THEN 'vqa' ELSE 'plan' END AS style, CASE turn % 3 WHEN 0 THEN 'front' WHEN 1 THEN 'rear' END AS camera FROM conversations)
WHERE problem IS NOT NULL""")
def camera_problems(spark, d):
    from .operators.validation import camera_problems as op

    rows = table(spark, d, "conversations").select(F.col("conv_id").alias("episode"), "turn", F.when(F.col("role") == "assistant", "vqa").otherwise("plan").alias("style"), F.when(F.col("turn") % 3 == 0, "front").when(F.col("turn") % 3 == 1, "rear").alias("camera"))
    return op(rows, ["front", "wrist"]).select("episode", "turn", "problem")


# ---- declarations and gates -----------------------------------------------------------------------------


@query(f"""WITH {_FRAMES}, {_EXT}, k AS (SELECT episode, i, t0 + i * 43200.0 AS p FROM (SELECT *, unnest(range(0, floor((t1 - t0 + 1e-9) / 43200.0)::INT + 1)) AS i FROM ext)), num AS (SELECT episode, t, row_number() OVER (PARTITION BY episode ORDER BY t) - 1 AS f FROM (SELECT DISTINCT episode, t FROM frames)),
n AS (SELECT * FROM (SELECT k.episode, f, row_number() OVER (PARTITION BY k.episode, i ORDER BY abs(t - p), t) AS r FROM k JOIN num USING (episode)) WHERE r = 1), e AS (SELECT DISTINCT episode, f + o AS f FROM n, (SELECT unnest([0, 1]) AS o))
SELECT episode, f::INT AS frame, round(t, 6) AS t FROM e JOIN num USING (episode, f)""")
def emission_ticks(spark, d):
    return r6(U.emission_ticks(frames(spark, d), 1 / 43200.0, 2))


@query(f"""{_REF}, p AS (SELECT episode, event_id AS id, t AS x FROM frames WHERE label = 'error'), l AS (SELECT p.id, string_agg(k || '. ' || text, chr(10) ORDER BY k) AS plan FROM (SELECT p.id, s.text, row_number() OVER (PARTITION BY p.id ORDER BY s.idx) AS k FROM p JOIN ref s ON s.episode = p.episode AND s."end" > p.x) p GROUP BY p.id)
SELECT episode, id, round(x, 6) AS "at", coalesce(plan, '') AS plan FROM p LEFT JOIN l USING (id)""")
def plan_refresh(spark, d):
    points = frames(spark, d).where("label = 'error'").select("episode", F.col("event_id").alias("id"), F.col("t").alias("at"))
    return r6(U.plan_at(points, ref_spans(spark, d)))


@query(f"""{_REF}, m AS (SELECT episode, idx, start, array_to_string(list(text) OVER (PARTITION BY episode ORDER BY start, idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '; ') AS memory FROM ref) SELECT episode, idx, round(start, 6) AS start, memory FROM m WHERE idx > 0""")
def memory_chain(spark, d):
    return r6(U.memory_chain(ref_spans(spark, d)))


@query("""SELECT o_orderkey, s IS NULL AS ok, s AS error FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN 'ambiguous' WHEN CASE WHEN o_orderstatus = 'F' THEN 0 ELSE o_custkey % 3 END = 0 THEN 'arm produced no spans for this episode' END AS s FROM orders)""")
def row_status(spark, d):
    k = F.col("o_orderkey")
    s = U.row_status(F.col("o_orderstatus") != "F", F.col("o_custkey") % 3, F.when(k % 5 == 0, "ambiguous"))
    return table(spark, d, "orders").select("o_orderkey", s.alias("s")).select("o_orderkey", "s.ok", "s.error")


_STATUS = """x AS (SELECT o_orderkey, o_orderstatus <> 'F' AS job_ok, o_custkey % 3 AS n, CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_orderkey % 4 = 1 END AS applied, o_custkey % 2 = 0 AS configured FROM orders),
w AS (SELECT *, CASE WHEN coalesce(applied, false) AND NOT configured THEN 'calibration applied without a calibration file' WHEN job_ok AND n > 0 AND applied IS NULL AND configured THEN 'calibrated output has no runtime decision' END AS wrong FROM x)"""


@query(f"""WITH {_STATUS} SELECT o_orderkey, CASE WHEN wrong IS NOT NULL THEN NULL WHEN NOT job_ok OR n = 0 THEN false ELSE coalesce(applied, false) END AS applied,
CASE WHEN wrong IS NOT NULL THEN 'error: ' || wrong WHEN NOT job_ok THEN 'job_failed' WHEN n = 0 THEN 'no_output' WHEN applied IS NOT NULL THEN 'said' ELSE 'not_configured' END AS reason,
CASE WHEN wrong IS NOT NULL THEN 'error' WHEN NOT job_ok OR n = 0 THEN 'delivery' WHEN applied IS NOT NULL THEN 'runtime' ELSE 'configuration' END AS source FROM w""")
def calibration_status(spark, d):
    k = F.col("o_orderkey") % 4
    s = U.calibration_status(F.col("o_orderstatus") != "F", F.col("o_custkey") % 3, F.when(k != 0, k == 1), F.lit("said"), F.col("o_custkey") % 2 == 0)
    return table(spark, d, "orders").select("o_orderkey", s.alias("s")).select("o_orderkey", "s.applied", "s.reason", "s.source")


@query("""SELECT n_nationkey, CASE n_nationkey % 5 WHEN 0 THEN 'declared' WHEN 1 THEN 'standalone' WHEN 2 THEN 'standalone' WHEN 3 THEN 'undeclared' ELSE 'inferred' END AS kind, CASE n_nationkey % 5 WHEN 0 THEN n_name WHEN 4 THEN 'base__' || n_name || '__wrist' END AS baseline FROM nation""")
def baseline_expectation(spark, d):
    k = F.col("n_nationkey") % 5
    e = U.baseline_expectation(F.when(k == 0, F.col("n_name")).when(k == 1, " None "), k < 2, F.when(k == 2, "base"), F.when(k != 3, F.col("n_name")), F.lit("wrist"), "base")
    return table(spark, d, "nation").select("n_nationkey", e.alias("e")).select("n_nationkey", "e.kind", "e.baseline")


@query("""WITH a AS (SELECT n_name AS arm, CASE n_nationkey % 3 WHEN 0 THEN n_name WHEN 1 THEN 'NOWHERE' WHEN 2 THEN 'FRANCE' END AS b FROM nation) SELECT arm, CASE WHEN arm = b THEN 'paired with itself' ELSE 'baseline missing' END AS problem FROM a WHERE arm = b OR b NOT IN (SELECT arm FROM a)""")
def pairing_problems(spark, d):
    k = F.col("n_nationkey") % 3
    return U.pairing_problems(table(spark, d, "nation").select(F.col("n_name").alias("arm"), F.when(k == 0, F.col("n_name")).when(k == 1, "NOWHERE").otherwise("FRANCE").alias("baseline")))


@query("""WITH m AS (SELECT n_name AS arm, CASE WHEN n_nationkey % 7 = 0 THEN '' ELSE 's' || n_nationkey % 2 END AS sup, CASE WHEN n_nationkey % 6 = 1 THEN 'reference' ELSE 'tool' END AS tool, n_nationkey % 8 = 3 AS q, CASE WHEN n_nationkey % 9 = 4 THEN false END AS eq FROM nation),
c AS (SELECT a.n_name AS a, b.n_name AS b FROM nation a JOIN nation b ON b.n_nationkey = (a.n_nationkey + 5) % 25),
j AS (SELECT c.a, c.b, x.sup AS sa, y.sup AS sb, x.tool = 'reference' OR y.tool = 'reference' AS ref, CASE WHEN x.sup = '' THEN 'missing metadata: ' || c.a WHEN x.q THEN 'quarantined: ' || c.a WHEN x.eq = false THEN 'not equalised: ' || c.a END AS ra, CASE WHEN y.sup = '' THEN 'missing metadata: ' || c.b WHEN y.q THEN 'quarantined: ' || c.b WHEN y.eq = false THEN 'not equalised: ' || c.b END AS rb FROM c JOIN m x ON x.arm = c.a JOIN m y ON y.arm = c.b),
r AS (SELECT *, coalesce(ra, rb, CASE WHEN sa <> sb AND NOT ref THEN 'supervision mismatch: ' || sa || ' / ' || sb END) AS refusal FROM j)
SELECT a, b, refusal, CASE WHEN refusal IS NULL AND sa <> sb THEN 'supervision asymmetry: ' || sa || ' / ' || sb END AS note FROM r""")
def contrast_policy(spark, d):
    k, n = F.col("n_nationkey"), table(spark, d, "nation")
    arms = n.select(F.col("n_name").alias("arm"), F.when(k % 7 == 0, "").otherwise(F.concat(F.lit("s"), (k % 2).cast("string"))).alias("supervision"), F.when(k % 6 == 1, "reference").otherwise("tool").alias("tool"), (k % 8 == 3).alias("quarantined"), F.when(k % 9 == 4, False).alias("equalised"))
    pairs = n.select(F.col("n_name").alias("a"), ((k + 5) % 25).alias("k")).join(n.select(F.col("n_name").alias("b"), k.alias("k")), "k").select("a", "b")
    return U.contrast_policy(pairs, arms, allow_reference=True)


@query(f"WITH {_ROWS}, r AS (SELECT coalesce(avg((NOT ok)::INT) FILTER (arm = '1-URGENT'), 0) AS x, coalesce(avg((NOT ok)::INT) FILTER (arm = '5-LOW'), 0) AS y FROM rows_) SELECT round(x, 6) AS arm_failed, round(y, 6) AS baseline_failed, round(abs(x - y), 6) AS gap, greatest(x, y) > 0.2 OR abs(x - y) > 0.1 AS blocked FROM r")
def attrition_gate(spark, d):
    return r6(U.attrition_gate(score_rows(spark, d), "1-URGENT", "5-LOW"))


@query("""WITH c AS (SELECT c_nationkey % 3 AS profile, c_mktsegment AS segment, c_nationkey, o_orderstatus AS st, avg(o_totalprice) AS v FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL), d AS (SELECT x.segment, x.st, x.profile, x.v - y.v AS d FROM c x JOIN c y USING (segment, c_nationkey, profile) WHERE y.st = 'F' AND x.st <> 'F')
SELECT profile, segment, st AS status, count(*) AS n, round(avg(d), 3) AS delta, count(*) FILTER (d > 0) AS wins, count(*) FILTER (d < 0) AS losses FROM d GROUP BY ALL""")
def factorial_contrasts(spark, d):
    rows = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    rows = rows.select((F.col("c_nationkey") % 3).alias("profile"), F.col("c_mktsegment").alias("segment"), F.col("o_orderstatus").alias("status"), "c_nationkey", "o_totalprice")
    out = U.factorial_contrasts(rows, ["profile", "segment", "status"], "status", "F", ["c_nationkey"], "o_totalprice")
    return out.withColumn("delta", F.round("delta", 3))


@query("""WITH p AS (SELECT o_custkey % 10 AS component, o_orderkey % 100 AS local, count(*) AS n FROM orders GROUP BY ALL), i AS (SELECT DISTINCT c_custkey % 10 AS component, c_custkey % 90 AS local, (c_custkey % 10) * 1000 + c_custkey % 90 AS original FROM customer)
SELECT original, n FROM p JOIN i USING (component, local)""")
def merged_predictions(spark, d):
    parts = table(spark, d, "orders").groupBy((F.col("o_custkey") % 10).alias("component"), (F.col("o_orderkey") % 100).alias("local")).agg(F.count("*").alias("n"))
    c = F.col("c_custkey")
    index = table(spark, d, "customer").select((c % 10).alias("component"), (c % 90).alias("local"), (c % 10 * 1000 + c % 90).alias("original")).distinct()
    return U.merge_predictions(parts, index)[0].select("original", "n")


@query(f"""WITH l AS (SELECT DISTINCT p_brand AS ds, p_type AS label FROM part), o AS (SELECT label, count(*) AS n FROM l GROUP BY 1),
p AS (SELECT label AS "left", label AS "right" FROM o WHERE n > 1 UNION ALL SELECT label, label || '.' FROM o UNION ALL SELECT label, replace(label, ' the ', ' ') FROM o),
g AS (SELECT x.label AS "left", y.label AS "right" FROM l x JOIN l y ON x.ds = y.ds AND x.label < y.label UNION ALL SELECT 'open', 'close')
SELECT "left", "right", true AS positive FROM p UNION ALL SELECT "left", "right", false FROM g WHERE {_NORM.format('"left"')} <> {_NORM.format('"right"')}""")
def matcher_pairs(spark, d):
    antonyms = spark.createDataFrame([("open", "close")], "left string, right string")
    return U.matcher_pairs(table(spark, d, "part").select(F.col("p_brand").alias("dataset"), F.col("p_type").alias("label")), antonyms)


@query("""SELECT p_partkey, p_retailprice FROM part WHERE p_size % 3 <> 0 AND p_retailprice >= 100 ORDER BY p_retailprice DESC, p_partkey LIMIT 15""")
def worst_false_positives(spark, d):
    rows = table(spark, d, "part").select("p_partkey", "p_retailprice", (F.col("p_size") % 3 == 0).alias("same"))
    return U.worst_false_positives(rows, "p_retailprice", "same", 100.0).select("p_partkey", "p_retailprice")


_COHORT_X = "x AS (SELECT c_mktsegment AS cohort, c_custkey AS episode, i, ((c_custkey * i * 37) % 101) / 101.0 AS x, c_custkey % 4 = 0 AS seed FROM customer, (SELECT unnest([1, 2, 3]) AS i))"


@query(f"""WITH {_COHORT_X}, p AS (SELECT cohort, i, median(x) AS prior FROM x WHERE seed GROUP BY ALL), t AS (SELECT cohort, i, median(x) AS mid FROM x WHERE NOT seed GROUP BY ALL),
o AS (SELECT cohort, count(DISTINCT episode) AS n_eval, avg(abs(x - prior)) AS pe, avg(abs(x - mid)) AS dp FROM x JOIN p USING (cohort, i) JOIN t USING (cohort, i) WHERE NOT seed GROUP BY 1), s AS (SELECT cohort, avg(abs(prior - mid)) AS ms FROM p JOIN t USING (cohort, i) GROUP BY 1), z AS (SELECT cohort, count(DISTINCT episode) AS n_seeds FROM x WHERE seed GROUP BY 1)
SELECT cohort, n_eval, round(pe, 6) AS prior_error, round(dp, 6) AS dispersion, round(ms, 6) AS median_shift, n_seeds FROM o JOIN s USING (cohort) JOIN z USING (cohort)""")
def cohort_diagnostics(spark, d):
    c = F.col("c_custkey")
    x = table(spark, d, "customer").select(F.col("c_mktsegment").alias("cohort"), c.alias("episode"), F.explode(F.array(F.lit(1), F.lit(2), F.lit(3))).alias("i")).withColumn("x", (F.col("episode") * F.col("i") * 37) % 101 / 101.0)
    return r6(U.cohort_diagnostics(x.where("episode % 4 = 0"), x.where("episode % 4 <> 0")))


@query("""WITH e AS (SELECT c_nationkey % 5 AS task, c_nationkey % 3 AS n_segments, c_mktsegment AS arm, c_custkey AS episode FROM customer), f AS (SELECT DISTINCT task, n_segments, arm FROM e WHERE task <> 2)
SELECT episode, CASE WHEN f.task IS NULL THEN 'plain' ELSE e.arm END AS route, CASE WHEN f.task IS NULL THEN 'no fit for task and count' END AS reason FROM e LEFT JOIN f USING (task, n_segments, arm)""")
def calibration_route(spark, d):
    from .operators.calibration import route

    e = table(spark, d, "customer").select((F.col("c_nationkey") % 5).alias("task"), (F.col("c_nationkey") % 3).alias("n_segments"), F.col("c_mktsegment").alias("arm"), F.col("c_custkey").alias("episode"), F.lit("plain").alias("counterpart"))
    fits = e.where("task <> 2").select("task", "n_segments", "arm").distinct().withColumn("fit", F.lit("fit"))
    return route(e, fits).select("episode", "route", "reason")


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN 'not_configured' WHEN o_custkey % 5 = 0 THEN 'empty_prediction' WHEN o_orderkey % 3 = 0 AND o_custkey % 2 = 0 THEN 'generated_requires_exact_labels' WHEN o_custkey % 2 = 0 AND 2 <> o_orderkey % 4 THEN 'segment_count_mismatch' WHEN o_custkey % 2 = 1 AND o_orderstatus <> 'F' THEN 'label_mismatch' ELSE 'applied' END AS reason FROM orders""")
def runtime_reasons(spark, d):
    from .operators.calibration import runtime_reason

    k, c = F.col("o_orderkey"), F.col("o_custkey")
    reason = runtime_reason(k % 7 != 0, c % 5, F.when(c % 2 == 0, "segment_count").otherwise("exact"), k % 3 == 0, F.array(F.lit("a"), F.col("o_orderstatus")), F.array(F.lit("a"), F.lit("F")), k % 4)
    return table(spark, d, "orders").select("o_orderkey", reason.alias("reason"))

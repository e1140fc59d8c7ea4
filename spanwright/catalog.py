"""Queries over the driver's tables, each an operator of this library, and their DuckDB text.

Roles: events are frames (episode user_id, time ts, label event_type, signal value),
conversations are language rows, regions, nations and customers are families,
components and units, labels are two raters, embeddings are label vectors.
Floats are rounded to six digits in both, as sums run in another order.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .operators import metrics as M
from .operators import spans as S
from .operators import stats as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLE_SQL[fn.__name__] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def frames(spark: SparkSession, d: str) -> DataFrame:
    coarse = F.when(F.col("event_type").isin("view", "click"), "browse").when(F.col("event_type").isin("signup", "purchase"), "convert").otherwise(F.col("event_type"))
    return table(spark, d, "events").select(F.col("user_id").alias("episode"), "event_id", (F.unix_micros(F.col("ts").cast("timestamp")) / 1e6).alias("t"), F.col("event_type").alias("label"), coarse.alias("coarse"), "value", "props")


def ref_spans(spark, d):
    return S.run_length_spans(frames(spark, d))


def guessed(spark, d) -> DataFrame:
    """Frames with the label of the frame before, and errors taken for views: a prediction that lags and mistakes."""
    before = F.coalesce(F.lag("label").over(Window.partitionBy("episode").orderBy("t", "event_id")), F.col("label"))
    return frames(spark, d).withColumn("label", before).withColumn("label", F.when(F.col("label") == "error", "view").otherwise(F.col("label")))


def pred_spans(spark, d):
    return S.run_length_spans(guessed(spark, d))


def coarse_spans(spans: DataFrame) -> DataFrame:
    """The same spans under coarser labels, so that neighbours may share one."""
    return spans.withColumn("text", F.when(F.col("text").isin("view", "click"), "Browse").when(F.col("text") == "error", "the browse").otherwise(F.col("text")))


def r6(df: DataFrame) -> DataFrame:
    return df.select(*[F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def rle(name: str, src: str, label: str = "label") -> str:
    return f"""
{name}_m AS (SELECT episode, t, event_id, {label} AS text, CASE WHEN lag({label}) OVER w IS NOT DISTINCT FROM {label} AND row_number() OVER w > 1 THEN 0 ELSE 1 END AS nw FROM {src} WINDOW w AS (PARTITION BY episode ORDER BY t, event_id)),
{name}_g AS (SELECT *, sum(nw) OVER (PARTITION BY episode ORDER BY t, event_id ROWS UNBOUNDED PRECEDING)::BIGINT AS g FROM {name}_m),
{name} AS (SELECT episode, g - 1 AS idx, text, s AS start, coalesce(lead(s) OVER (PARTITION BY episode ORDER BY g), l) AS "end" FROM (SELECT episode, g, min(text) AS text, min(t) AS s, max(t) AS l FROM {name}_g GROUP BY ALL))"""


_FRAMES = """frames AS (SELECT user_id AS episode, event_id, epoch_us(ts) / 1e6 AS t, event_type AS label,
  CASE WHEN event_type IN ('view', 'click') THEN 'browse' WHEN event_type IN ('signup', 'purchase') THEN 'convert' ELSE event_type END AS coarse, value, props FROM events)"""
_EXT = "ext AS (SELECT episode, min(t) AS t0, max(t) AS t1, count(*) AS n_frames FROM frames GROUP BY episode)"
_REF = f"WITH {_FRAMES},{rle('ref', 'frames')}"
_BOTH = f"""{_REF}, part AS (SELECT episode, t, event_id, CASE WHEN x = 'error' THEN 'view' ELSE x END AS label FROM
  (SELECT *, coalesce(lag(label) OVER (PARTITION BY episode ORDER BY t, event_id), label) AS x FROM frames)),{rle('pred', 'part')}"""
_PAIRS = f"""{_BOTH},
pairs0 AS (SELECT p.episode, p.idx AS pi, p.text AS pt, r.idx AS ri, r.text AS rt, greatest(p."end", r."end") - least(p.start, r.start) AS hull,
  greatest(least(p."end", r."end") - greatest(p.start, r.start), 0) AS ov, p.start = r.start AND p."end" = r."end" AS eq FROM pred p JOIN ref r USING (episode)),
pairs AS (SELECT *, CASE WHEN hull > 0 THEN ov / hull WHEN eq THEN 1.0 ELSE 0.0 END AS iou FROM pairs0)"""


@query(f"{_REF} SELECT episode, idx, text, round(start, 6) AS start, round(\"end\", 6) AS \"end\" FROM ref")
def rle_spans(spark, d):
    return r6(ref_spans(spark, d))


@query(f"""{_REF}, {_EXT}, st AS (SELECT episode, idx, text, start + 3600.0 AS start FROM ref),
n AS (SELECT episode, idx, text, start, row_number() OVER w AS k, lead(start) OVER w AS nx, t0, t1 FROM st JOIN ext USING (episode) WINDOW w AS (PARTITION BY episode ORDER BY start, idx)),
o AS (SELECT episode, idx, text, CASE WHEN k = 1 THEN t0 ELSE start END AS start, nx, t1 FROM n)
SELECT episode, idx, text, round(start, 6) AS start, round(greatest(coalesce(nx, t1), start), 6) AS "end" FROM o""")
def stitched_cover(spark, d):
    late = ref_spans(spark, d).withColumn("start", F.col("start") + 3600.0)
    return r6(S.stitch(late, S.episode_extent(frames(spark, d))))


@query(f"""{_REF}, {_EXT}, st AS (SELECT episode, idx, text, start FROM ref)
SELECT episode, idx, text, round(start, 6) AS start, round(coalesce(lead(start) OVER (PARTITION BY episode ORDER BY start, idx), greatest(start, t1)), 6) AS "end" FROM st LEFT JOIN ext USING (episode)""")
def spans_from_start_rows(spark, d):
    return r6(S.spans_from_starts(ref_spans(spark, d).select("episode", "idx", "text", "start"), S.episode_extent(frames(spark, d))))


@query(f"""WITH {_FRAMES}, {rle('fine', 'frames').strip()},
c AS (SELECT episode, idx, CASE WHEN text IN ('view', 'click') THEN 'browse' ELSE text END AS text, start, "end" FROM fine),
m AS (SELECT *, CASE WHEN lag(text) OVER w IS NOT DISTINCT FROM text AND row_number() OVER w > 1 AND lag("end") OVER w = start THEN 0 ELSE 1 END AS nw FROM c WINDOW w AS (PARTITION BY episode ORDER BY idx)),
g AS (SELECT *, sum(nw) OVER (PARTITION BY episode ORDER BY idx ROWS UNBOUNDED PRECEDING)::BIGINT AS g FROM m)
SELECT episode, g - 1 AS idx, min(text) AS text, round(min(start), 6) AS start, round(max("end"), 6) AS "end" FROM g GROUP BY episode, g""")
def collapsed_spans(spark, d):
    fine = ref_spans(spark, d).withColumn("text", F.when(F.col("text").isin("view", "click"), "browse").otherwise(F.col("text")))
    return r6(S.collapse(fine))


_POINTS = "pts AS (SELECT episode, event_id AS id, t + 3600.0 AS \"at\" FROM frames WHERE label = 'error')"


def error_points(spark, d):
    return frames(spark, d).where("label = 'error'").select("episode", F.col("event_id").alias("id"), (F.col("t") + 3600.0).alias("at"))


@query(f"""WITH {_FRAMES}, {_POINTS}, k AS (SELECT p.*, f.t, row_number() OVER (PARTITION BY p.id ORDER BY abs(f.t - p."at"), f.t) AS n FROM pts p JOIN frames f USING (episode))
SELECT episode, id, round("at", 6) AS "at", round(t, 6) AS frame_t FROM k WHERE n = 1""")
def snap_to_frame(spark, d):
    return r6(S.snap_to_frame(error_points(spark, d), frames(spark, d)))


@query(f"""{_BOTH}, {_POINTS}, h AS (SELECT p.id, arg_min(s.text, s.idx) AS text FROM pts p JOIN pred s ON p.episode = s.episode AND p."at" >= s.start AND p."at" < s."end" GROUP BY p.id)
SELECT p.episode, p.id, round(p."at", 6) AS "at", h.text FROM pts p LEFT JOIN h USING (id)""")
def label_at_time(spark, d):
    return r6(S.label_at(error_points(spark, d), pred_spans(spark, d)))


@query(f"""{_BOTH}, g AS (SELECT episode, event_id AS id, t AS "at", label AS r FROM frames),
h AS (SELECT g.id, arg_min(s.text, s.idx) AS p FROM g JOIN pred s ON g.episode = s.episode AND g."at" >= s.start AND g."at" < s."end" GROUP BY g.id),
q AS (SELECT g.id, arg_min(s.text, s.idx) AS r FROM g JOIN ref s ON g.episode = s.episode AND g."at" >= s.start AND g."at" < s."end" GROUP BY g.id)
SELECT g.episode, round(avg(CASE WHEN h.p = q.r THEN 1.0 ELSE 0.0 END), 6) AS mof FROM g LEFT JOIN h USING (id) LEFT JOIN q USING (id) GROUP BY g.episode""")
def frame_accuracy(spark, d):
    points = frames(spark, d).select("episode", F.col("event_id").alias("id"), F.col("t").alias("at"))
    return r6(M.frame_accuracy(pred_spans(spark, d), ref_spans(spark, d), points))


@query(f"""{_BOTH}, e AS (SELECT episode, arg_min(start, idx) AS t0, arg_max("end", idx) AS t1 FROM ref GROUP BY episode),
g AS (SELECT episode, i, t0 + (i + 0.5) * least(3600.0, t1 - t0) AS "at" FROM (SELECT *, unnest(range(0, CASE WHEN t1 > t0 THEN greatest(1, floor((t1 - t0) / 3600.0)::BIGINT) ELSE 0 END)) AS i FROM e)),
a AS (SELECT g.episode, i, arg_min(s.text, s.idx) AS p FROM g JOIN pred s ON g.episode = s.episode AND g."at" >= s.start AND g."at" < s."end" GROUP BY ALL),
b AS (SELECT g.episode, i, arg_min(s.text, s.idx) AS r FROM g JOIN ref s ON g.episode = s.episode AND g."at" >= s.start AND g."at" < s."end" GROUP BY ALL),
m AS (SELECT g.episode, avg(CASE WHEN p = r THEN 1.0 ELSE 0.0 END) AS mof, count(*) AS n FROM g LEFT JOIN a USING (episode, i) LEFT JOIN b USING (episode, i) GROUP BY g.episode)
SELECT e.episode, round(coalesce(mof, 0), 6) AS mof, coalesce(n, 0) AS n_samples FROM e LEFT JOIN m USING (episode)""")
def mean_over_frames(spark, d):
    return r6(M.mof(pred_spans(spark, d), ref_spans(spark, d), 3600.0))


@query(f"""{_REF} SELECT a.episode, a.idx, round(a.start, 6) AS start,
(SELECT string_agg(k || '. ' || text, chr(10) ORDER BY k) FROM (SELECT b.text, b.idx - a.idx + 1 AS k FROM ref b WHERE b.episode = a.episode AND b.idx >= a.idx)) AS plan FROM ref a""")
def remaining_plan(spark, d):
    return r6(S.remaining_plan(ref_spans(spark, d)))


@query(f"""{_REF} SELECT episode, idx, text, lag(text) OVER w AS prev_text, lead(text) OVER w AS next_text, (row_number() OVER w - 1)::BIGINT AS n_done, (count(*) OVER (PARTITION BY episode) - row_number() OVER w)::BIGINT AS n_left FROM ref WINDOW w AS (PARTITION BY episode ORDER BY idx)""")
def span_context(spark, d):
    return S.neighbours(ref_spans(spark, d))


@query(f"""{_REF}, k AS (SELECT episode, idx, text, start + CASE WHEN idx % 5 = 0 THEN 400000.0 ELSE 0.0 END AS start, "end" FROM ref),
m AS (SELECT *, max(start) OVER (PARTITION BY episode ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS top FROM k)
SELECT episode, idx, text, round(start, 6) AS start, round("end", 6) AS "end" FROM m WHERE top IS NULL OR start > top""")
def increasing_starts(spark, d):
    late = ref_spans(spark, d).withColumn("start", F.col("start") + F.when(F.col("idx") % 5 == 0, 400000.0).otherwise(0.0))
    kept = S.pack(late).select("episode", F.explode(S.keep_increasing(F.col("spans"))).alias("s"))
    return r6(kept.select("episode", "s.idx", "s.text", "s.start", "s.end"))


@query(f"""{_REF}, {_EXT}, s AS (SELECT r.episode, idx, text, CASE WHEN idx = 0 THEN start ELSE least(greatest(start - 60.0 * (idx % 3), t0), t1) END AS b, "end" FROM ref r JOIN ext USING (episode))
SELECT episode, idx, text, round(b, 6) AS start, round(coalesce(lead(b) OVER (PARTITION BY episode ORDER BY idx), "end"), 6) AS "end" FROM s""")
def offset_spans(spark, d):
    rows = S.pack(ref_spans(spark, d)).join(S.episode_extent(frames(spark, d)), "episode")
    offsets = F.transform(F.slice("spans", 2, F.greatest(F.size("spans") - 1, F.lit(0))), lambda s: 60.0 * (s["idx"] % 3))
    out = rows.select("episode", F.explode(S.shift_starts(F.col("spans"), offsets, F.col("t0"), F.col("t_last"))).alias("s"))
    return r6(out.select("episode", "s.idx", "s.text", "s.start", "s.end"))


@query(f"""WITH {_FRAMES}, {_EXT}, k AS (SELECT *, 1 + n_frames % 4 AS k FROM ext)
SELECT episode, i::BIGINT AS idx, 'segment ' || (i + 1) AS text, round(t0 + (t1 - t0) * i / k, 1) AS start, round(t0 + (t1 - t0) * (i + 1) / k, 1) AS "end" FROM (SELECT *, unnest(range(0, k)) AS i FROM k)""")
def floor_uniform(spark, d):
    out = S.equal_split(S.episode_extent(frames(spark, d)), 1 + F.col("n_frames") % 4)
    return out.withColumns({c: F.round(c, 1) for c in ("start", "end")})


_WINDOWS = """n AS (SELECT *, greatest(1, round_even((t1 - t0) / 3600.0, 0)::BIGINT) AS n FROM ext WHERE t1 > t0), k AS (SELECT *, ceil(n / 59.0)::BIGINT AS k FROM n),
f AS (SELECT *, greatest(k - 2, 0) AS full_, t0 + greatest(k - 2, 0) * 59 * 3600.0 AS from_, n - greatest(k - 2, 0) * 59 AS left_ FROM k),
m AS (SELECT *, from_ + (t1 - from_) * floor(left_ / 2) / left_ AS middle FROM f), i AS (SELECT *, unnest(range(0, k)) AS idx FROM m)"""
_EDGE = "CASE WHEN {0} = 0 THEN t0 WHEN {0} = k THEN t1 WHEN {0} <= full_ THEN t0 + {0} * 59 * 3600.0 ELSE middle END"


@query(f"""WITH {_FRAMES}, {_EXT}, {_WINDOWS}
SELECT episode, idx::BIGINT AS idx, round({_EDGE.format('idx')}, 3) AS start, round({_EDGE.format('(idx + 1)')}, 3) AS "end" FROM i""")
def generation_windows(spark, d):
    out = S.generation_windows(S.episode_extent(frames(spark, d)), 1 / 3600.0, 60)
    return out.withColumns({c: F.round(c, 3) for c in ("start", "end")})


@query(f"""WITH {_FRAMES}, {_EXT}, k AS (SELECT *, greatest(1, ceil((t1 - t0) / 86400.0)::INT) AS k FROM ext WHERE t1 > t0)
SELECT episode, i::BIGINT AS idx, round(t0 + (t1 - t0) * i / k, 3) AS start, round(t0 + (t1 - t0) * (i + 1) / k, 3) AS "end" FROM (SELECT *, unnest(range(0, k)) AS i FROM k)""")
def generation_windows_of_one_frame(spark, d):
    out = S.generation_windows(S.episode_extent(frames(spark, d)), 1 / 86400.0, 1)
    return out.withColumns({c: F.round(c, 3) for c in ("start", "end")})


@query(f"""WITH {_FRAMES}, {_EXT} SELECT episode, i::BIGINT AS idx, round(t0 + i * 86400.0, 6) AS start, round(least(t0 + (i + 1) * 86400.0, t1), 6) AS "end"
FROM (SELECT *, unnest(range(0, greatest(1, ceil((t1 - t0) / 86400.0)::INT))) AS i FROM ext)""")
def fixed_windows(spark, d):
    return r6(S.fixed_windows(S.episode_extent(frames(spark, d)), 86400.0))


@query(f"""WITH {_FRAMES}, {_EXT}, n AS (SELECT *, greatest(1, least(round_even((t1 - t0) * 1e-4, 0)::INT + 1, 60)) AS n FROM ext)
SELECT episode, i::BIGINT AS idx, round(t0 + i * CASE WHEN n > 1 THEN (t1 - t0) / (n - 1) ELSE 0 END, 3) AS "at" FROM (SELECT *, unnest(range(0, n)) AS i FROM n)""")
def uniform_grid(spark, d):
    return S.uniform_grid(S.episode_extent(frames(spark, d)), 1e-4, 60).withColumn("at", F.round("at", 3))


def _cover(a: str, b: str, name: str, own: str) -> str:
    return f"""{name} AS (SELECT a.episode, sum((a."end" - a.start) * coalesce(m, 0)) / sum(a."end" - a.start) AS c FROM {a} a LEFT JOIN (SELECT episode, {own} AS i, max(iou) AS m FROM pairs GROUP BY ALL) b ON a.episode = b.episode AND a.idx = b.i GROUP BY a.episode)"""


@query(f"""{_PAIRS}, {_cover('ref', 'pred', 'c1', 'ri')}, {_cover('pred', 'ref', 'c2', 'pi')}
SELECT episode, round(c1.c, 6) AS covering, round(c2.c, 6) AS covering_pred, round(CASE WHEN c1.c + c2.c > 0 THEN 2 * c1.c * c2.c / (c1.c + c2.c) ELSE 0 END, 6) AS covering_f FROM c1 FULL JOIN c2 USING (episode)""")
def covering(spark, d):
    return r6(M.covering(pred_spans(spark, d), ref_spans(spark, d)))


@query(f"""{_BOTH}, b AS (SELECT p.episode, p.idx AS i, r.idx AS j, abs(p.start - r.start) AS d FROM pred p JOIN ref r USING (episode) WHERE p.idx > 0 AND r.idx > 0),
x AS (SELECT episode, avg(m) AS a FROM (SELECT episode, i, min(d) AS m FROM b GROUP BY ALL) GROUP BY episode), y AS (SELECT episode, avg(m) AS a FROM (SELECT episode, j, min(d) AS m FROM b GROUP BY ALL) GROUP BY episode),
e AS (SELECT episode FROM pred UNION SELECT episode FROM ref)
SELECT episode, round(x.a, 6) AS pred_to_ref, round(y.a, 6) AS ref_to_pred, round((x.a + y.a) / 2, 6) AS chamfer FROM e LEFT JOIN x USING (episode) LEFT JOIN y USING (episode)""")
def chamfer(spark, d):
    return r6(M.chamfer(pred_spans(spark, d), ref_spans(spark, d)))


_COUNTS = """p AS (SELECT episode, count(*) AS a FROM pred GROUP BY 1), r AS (SELECT episode, count(*) AS b FROM ref GROUP BY 1),
n AS (SELECT episode, coalesce(a, 0) AS n_pred, coalesce(b, 0) AS n_ref FROM p FULL JOIN r USING (episode))"""


@query(f"""{_BOTH}, {_COUNTS} SELECT *, n_pred - n_ref AS count_error, abs(n_pred - n_ref) AS abs_count_error, round(n_pred / nullif(n_ref, 0), 6) AS count_ratio, round(CASE WHEN n_pred > 0 AND n_ref > 0 THEN ln(n_pred / n_ref) ELSE 'nan'::DOUBLE END, 6) AS log_count_ratio FROM n""")
def segment_counts(spark, d):
    return r6(M.segment_counts(pred_spans(spark, d), ref_spans(spark, d)))


_MERGED = f"""{_BOTH}, {", ".join(f'''
{x}_norm AS (SELECT *, CASE WHEN text IN ('view', 'click', 'error') THEN 'browse' ELSE text END AS key FROM {x}),
{x}_mark AS (SELECT *, CASE WHEN lag(key) OVER w = key AND lag("end") OVER w = start THEN 0 ELSE 1 END AS nw FROM {x}_norm WINDOW w AS (PARTITION BY episode ORDER BY idx)),
{x}_r AS (SELECT *, sum(nw) OVER (PARTITION BY episode ORDER BY idx ROWS UNBOUNDED PRECEDING) AS g FROM {x}_mark),
{x}_c AS (SELECT episode, g - 1 AS idx, min(key) AS text, arg_min(start, idx) AS start, arg_max("end", idx) AS "end" FROM {x}_r GROUP BY episode, g)''' for x in ("ref", "pred"))}"""


@query(f"""{_MERGED}, p0 AS (SELECT p.episode, p.idx AS pi, r.idx AS ri, greatest(p."end", r."end") - least(p.start, r.start) AS hull, greatest(least(p."end", r."end") - greatest(p.start, r.start), 0) AS ov, p.start = r.start AND p."end" = r."end" AS eq FROM pred_c p JOIN ref_c r ON p.episode = r.episode AND p.text = r.text),
best AS (SELECT episode, pi, iou, ri FROM (SELECT *, row_number() OVER (PARTITION BY episode, pi ORDER BY iou DESC, ri) AS k FROM (SELECT *, CASE WHEN hull > 0 THEN ov / hull WHEN eq THEN 1.0 ELSE 0.0 END AS iou FROM p0)) WHERE k = 1),
t AS (SELECT episode, t, count(DISTINCT ri) AS tp FROM best, (SELECT unnest([0.10, 0.25, 0.50]) AS t) WHERE iou >= t GROUP BY ALL),
p AS (SELECT episode, count(*) AS a FROM pred_c GROUP BY 1), r AS (SELECT episode, count(*) AS b FROM ref_c GROUP BY 1), n AS (SELECT episode, coalesce(a, 0) AS a, coalesce(b, 0) AS b FROM p FULL JOIN r USING (episode)),
x AS (SELECT n.*, {", ".join(f"coalesce((SELECT tp FROM t WHERE t.episode = n.episode AND t.t = {x}), 0) AS tp_{round(x * 100)}" for x in (0.10, 0.25, 0.50))} FROM n)
SELECT episode, {", ".join(f"round(coalesce(2.0 * tp_{k} / nullif(a + b, 0), 0), 6) AS f1_{k}, round(coalesce(tp_{k} / nullif(a, 0), 0), 6) AS precision_{k}, round(coalesce(tp_{k} / nullif(b, 0), 0), 6) AS recall_{k}" for k in (10, 25, 50))} FROM x""")
def f1_at_iou(spark, d):
    """Spans under coarse labels in several spellings, not merged before."""
    return r6(M.f1_at_iou(coarse_spans(pred_spans(spark, d)), coarse_spans(ref_spans(spark, d))))


@query(f"""{_PAIRS}, b AS (SELECT episode, ri AS idx, max(CASE WHEN pt = rt THEN iou ELSE -1 END) AS m FROM pairs GROUP BY ALL),
o AS (SELECT r.episode, {", ".join(f"avg(CASE WHEN m >= {x} THEN 1.0 ELSE 0.0 END) AS h{round(x * 10)}" for x in (0.3, 0.5, 0.7, 0.9))} FROM ref r LEFT JOIN b USING (episode, idx) GROUP BY r.episode)
SELECT episode, {", ".join(f"round(h{k}, 6) AS recall_{k}" for k in (3, 5, 7, 9))}, round((h3 + h5 + h7 + h9) / 4, 6) AS recall_mean FROM o""")
def dense_caption(spark, d):
    return r6(M.dense_caption(pred_spans(spark, d), ref_spans(spark, d)))


@query(f"""{_PAIRS}, g AS (SELECT episode, ri AS idx, sum(ov) AS o FROM pairs WHERE pt = rt GROUP BY ALL)
SELECT r.episode, round(sum(least(coalesce(o, 0), "end" - start)) / nullif(sum("end" - start), 0), 6) AS label_accuracy FROM ref r LEFT JOIN g USING (episode, idx) GROUP BY r.episode""")
def cw_label_accuracy(spark, d):
    return r6(M.label_accuracy(pred_spans(spark, d), ref_spans(spark, d)))


_GREEDY = f"""{_BOTH.replace("WITH ", "WITH RECURSIVE ", 1)}, most AS (SELECT max(idx) AS n FROM ref),
m AS (SELECT episode, (-1)::BIGINT AS idx, (-1)::BIGINT AS last, NULL::BIGINT AS p FROM (SELECT DISTINCT episode FROM ref)
  UNION ALL SELECT episode, idx, coalesce(p, last), p FROM (SELECT m.episode, r.idx, any_value(m.last) AS last, min(q.idx) AS p FROM m JOIN ref r ON r.episode = m.episode AND r.idx = m.idx + 1 LEFT JOIN pred q ON q.episode = r.episode AND q.text = r.text AND q.idx > m.last GROUP BY m.episode, r.idx)),
took AS (SELECT m.episode, m.idx, m.p, q.start AS ps, q."end" AS pe FROM m LEFT JOIN pred q ON q.episode = m.episode AND q.idx = m.p WHERE m.idx >= 0)"""


@query(f"{_GREEDY} SELECT episode, idx, p AS p_idx, round(ps, 6) AS p_start, round(pe, 6) AS p_end FROM took")
def ordered_matches(spark, d):
    return r6(M.ordered_matches(pred_spans(spark, d), ref_spans(spark, d)))


@query(f"""{_GREEDY}, j AS (SELECT r.episode, r.idx, t.p IS NOT NULL AS placed, ps, pe, r.start AS rs, r."end" AS re, arg_min(r.start, r.idx) OVER e AS f, arg_max(r."end", r.idx) OVER e AS l FROM ref r JOIN took t USING (episode, idx) WINDOW e AS (PARTITION BY r.episode)),
k AS (SELECT episode, idx, placed, CASE WHEN NOT placed THEN 0.0 WHEN greatest(pe, re) - least(ps, rs) > 0 THEN greatest(least(pe, re) - greatest(ps, rs), 0) / (greatest(pe, re) - least(ps, rs)) WHEN ps = rs AND pe = re THEN 1.0 ELSE 0.0 END AS iou,
  CASE WHEN placed THEN abs(ps - rs) END AS e, greatest(abs(rs - f), abs(l - rs)) AS w FROM j)
SELECT episode, round(avg(placed::INT), 6) AS placed_fraction, round(avg(iou), 6) AS tiou, round(avg(e) FILTER (idx > 0), 6) AS mae_placed, round(avg(coalesce(e, w)) FILTER (idx > 0), 6) AS mae, round(quantile_cont(coalesce(e, w), 0.5) FILTER (idx > 0), 6) AS median_error, round(quantile_cont(coalesce(e, w), 0.9) FILTER (idx > 0), 6) AS p90_error,
  {", ".join(f"round(coalesce(avg(CASE WHEN e <= {h} THEN 1.0 ELSE 0.0 END) FILTER (idx > 0), 1.0), 6) AS hit_{h}" for h in (1, 3, 5))} FROM k GROUP BY episode""")
def fixed_label_alignment(spark, d):
    return r6(M.fixed_label(pred_spans(spark, d), ref_spans(spark, d)))


@query(f"""{_BOTH}, p AS (SELECT episode, text, count(*) AS a FROM pred GROUP BY ALL), r AS (SELECT episode, text, count(*) AS b FROM ref GROUP BY ALL),
n AS (SELECT episode, sum(least(coalesce(a, 0), coalesce(b, 0)))::BIGINT AS m, sum(coalesce(a, 0))::BIGINT AS a, sum(coalesce(b, 0))::BIGINT AS b FROM p FULL JOIN r USING (episode, text) GROUP BY episode)
SELECT episode, round(m / a, 6) AS label_precision, round(m / b, 6) AS label_recall, round(2 * m / (a + b), 6) AS label_f1, b - m AS missed, a - m AS hallucinated FROM n""")
def label_agreement(spark, d):
    return r6(M.label_sets(pred_spans(spark, d), ref_spans(spark, d)))


@query(f"""{_REF}, v AS (SELECT episode, coalesce("end" >= start AND (lag("end") OVER (PARTITION BY episode ORDER BY idx) IS NULL OR lag("end") OVER (PARTITION BY episode ORDER BY idx) - 1e-6 <= start), false) AS ok FROM ref)
SELECT episode, bool_and(ok) AS valid, count(*) AS n_spans FROM v GROUP BY episode""")
def sequence_valid(spark, d):
    return M.sequence_valid(ref_spans(spark, d))


# ---- statistics, ties, inference -------------------------------------------------------------------------------

from .functions import kernels as K  # noqa: E402
from .functions import labels as L  # noqa: E402

_SEQ = "WITH seq AS (SELECT conv_id AS i, list(role ORDER BY turn) AS s, arg_min(role, turn) AS task FROM conversations GROUP BY conv_id), n AS (SELECT task, s, count(*) AS n, min(i) AS first_at FROM seq GROUP BY ALL)"


def sequences(spark, d):
    """The whole sequence of roles of each conversation; its task is the first one."""
    turns = table(spark, d, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role"))).alias("x"))
    return turns.select(F.col("conv_id").alias("position"), F.transform("x", lambda t: t["role"]).alias("labels"), F.col("x")[0]["role"].alias("task"))


@query(f"""{_SEQ} SELECT task, s AS labels, n FROM (SELECT *, row_number() OVER (PARTITION BY task ORDER BY n DESC, s) AS k FROM n) WHERE k = 1""")
def modal_sequence(spark, d):
    return T.modal(sequences(spark, d).drop("position"), ["task"], "labels")


@query(f"""{_SEQ} SELECT task, s AS labels, n, first_at FROM (SELECT *, row_number() OVER (PARTITION BY task ORDER BY n DESC, first_at) AS k FROM n) WHERE k = 1""")
def modal_first_seen(spark, d):
    return T.modal(sequences(spark, d), ["task"], "labels", "first_at")


@query(f"""{_SEQ} SELECT task, s AS labels, n, first_at FROM (SELECT *, row_number() OVER (PARTITION BY task ORDER BY n DESC, len(s) DESC, first_at) AS k FROM n) WHERE k = 1""")
def modal_longest(spark, d):
    return T.modal(sequences(spark, d), ["task"], "labels", -F.size("labels"), "first_at")


@query("""WITH c AS (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY ALL), p AS (SELECT *, n / sum(n) OVER (PARTITION BY user_id) AS p FROM c)
SELECT user_id, sum(n)::BIGINT AS n, count(*) AS n_distinct, round(max(p), 6) AS modal_share, round(-sum(p * ln(p)), 6) AS entropy, round(CASE WHEN sum(n) > 1 THEN -sum(p * ln(p)) / ln(sum(n)) ELSE 0 END, 6) AS entropy_norm FROM p GROUP BY user_id""")
def label_entropy(spark, d):
    return r6(T.entropy(table(spark, d, "events"), "user_id", "event_type"))


@query(f"""{_REF}, n AS (SELECT episode, count(*) AS n FROM ref GROUP BY 1) SELECT round(avg(n), 6) AS mean, round(stddev_pop(n), 6) AS sd, round(stddev_pop(n) / avg(n), 6) AS cv, min(n) AS least, max(n) AS most FROM n""")
def count_stability(spark, d):
    n = ref_spans(spark, d).groupBy("episode").agg(F.count("*").alias("n"))
    return r6(n.agg(F.avg("n").alias("mean"), F.stddev_pop("n").alias("sd"), (F.stddev_pop("n") / F.avg("n")).alias("cv"), F.min("n").alias("least"), F.max("n").alias("most")))


_REL = f"{_REF}, {_EXT}, rel AS (SELECT r.episode, idx, (start - t0) / (t1 - t0) AS x FROM ref r JOIN ext USING (episode) WHERE idx > 0 AND t1 > t0)"


def relative(spark, d, spans):
    return spans.join(S.episode_extent(frames(spark, d)), "episode").where("idx > 0 AND t_last > t0").select("episode", "idx", ((F.col("start") - F.col("t0")) / (F.col("t_last") - F.col("t0"))).alias("x"))


@query(f"{_REL} SELECT idx, count(*) AS n, round(median(x), 6) AS median, round(avg(x), 6) AS mean, round(stddev_pop(x), 6) AS sd FROM rel GROUP BY idx")
def median_relative_boundaries(spark, d):
    return r6(relative(spark, d, ref_spans(spark, d)).groupBy("idx").agg(F.count("*").alias("n"), F.median("x").alias("median"), F.avg("x").alias("mean"), F.stddev_pop("x").alias("sd")))


_FIT = f"""{_BOTH}, {_EXT}, diff AS (SELECT r.episode, r.idx, (p.start - r.start) / (t1 - t0) AS e FROM ref r JOIN pred p ON r.episode = p.episode AND r.idx = p.idx JOIN ext ON r.episode = ext.episode WHERE r.idx > 0 AND t1 > t0),
off AS (SELECT idx, median(e) AS o, count(*) AS n FROM diff GROUP BY idx)"""


@query(f"{_FIT} SELECT idx, n, round(o, 6) AS \"offset\" FROM off")
def fit_offsets(spark, d):
    from .operators.calibration import boundary_errors, fit_offsets

    return r6(fit_offsets(boundary_errors(pred_spans(spark, d), ref_spans(spark, d), S.episode_extent(frames(spark, d)))))


@query(f"{_FIT} SELECT round(greatest(1e-3, stddev_pop(e - o)), 6) AS residual_scale, count(*) AS n FROM diff JOIN off USING (idx)")
def pooled_residual_scale(spark, d):
    from .operators.calibration import boundary_errors, residual_scale

    return r6(residual_scale(boundary_errors(pred_spans(spark, d), ref_spans(spark, d), S.episode_extent(frames(spark, d)))))


@query(f"""{_FIT}, g AS (SELECT r.idx, median((r."end" - r.start) / (t1 - t0)) AS f FROM ref r JOIN ext USING (episode) WHERE t1 > t0 GROUP BY r.idx),
c AS (SELECT idx, sum(f) OVER (ORDER BY idx) / sum(f) OVER () AS c FROM g) SELECT idx, round(c, 6) AS cumulative FROM c""")
def floor_cumulative(spark, d):
    from .operators.calibration import cumulative_prior

    return r6(cumulative_prior(ref_spans(spark, d), S.episode_extent(frames(spark, d))))


@query("""WITH x AS (SELECT n_regionkey AS f, c_nationkey AS c, c_acctbal AS x FROM customer JOIN nation ON c_nationkey = n_nationkey),
c AS (SELECT f, c, count(*)::DOUBLE AS n, avg(x) AS m, var_pop(x) * count(*) AS ss FROM x GROUP BY ALL),
f AS (SELECT f, sum(n) AS nf, sum(n * m) / sum(n) AS mf, count(*) AS cf, sum(ss) AS ss, sum(n * n) AS n2, sum(n * m * m) AS nm2 FROM c GROUP BY f),
o AS (SELECT count(*) AS a, sum(cf)::BIGINT AS b, sum(nf) AS n, sum(ss) AS su, sum(nm2 - nf * mf * mf) AS sc, sum(nf * mf * mf) - sum(nf * mf) ^ 2 / sum(nf) AS sf, sum(n2 / nf) AS s1, sum(n2) AS s2, sum(nf * nf) AS s3 FROM f),
m AS (SELECT *, sf / (a - 1) AS msf, sc / (b - a) AS msc, su / (n - b) AS msu, (n - s1) / (b - a) AS k1, (s1 - s2 / n) / (a - 1) AS k2, (n - s3 / n) / (a - 1) AS k3 FROM o),
v AS (SELECT *, greatest((msc - msu) / k1, 0) AS vc FROM m), w AS (SELECT *, greatest((msf - msu - k2 * vc) / k3, 0) AS vf FROM v)
SELECT a, b, n::BIGINT AS n, round(msf, 1) AS ms_family, round(msc, 1) AS ms_component, round(msu, 1) AS ms_unit, round(k1, 6) AS k1, round(k2, 6) AS k2, round(k3, 6) AS k3, round(vf, 1) AS var_family, round(vc, 1) AS var_component, round(msu, 1) AS var_unit,
  round(vf / (vf + vc + msu), 6) AS icc_family, round((vf + vc) / (vf + vc + msu), 6) AS icc_component FROM w""")
def variance_components(spark, d):
    rows = table(spark, d, "customer").join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    out = T.variance_components(rows, "n_regionkey", "c_nationkey", "c_acctbal")
    return out.select(*[F.round(c, 1 if c.startswith(("ms_", "var_")) else 6).alias(c) if t == "double" else c for c, t in out.dtypes])


_PAIRED = """sc AS (SELECT c_nationkey AS k, avg(o_totalprice) FILTER (o_orderstatus = 'F') AS a, avg(o_totalprice) FILTER (o_orderstatus = 'O') AS b FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1),
pr AS (SELECT k, a, b, a - b AS delta FROM sc WHERE a IS NOT NULL AND b IS NOT NULL)"""


def order_scores(spark, d):
    return table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))


def order_pairs(spark, d):
    return T.paired(order_scores(spark, d), ["c_nationkey"], "o_orderstatus", "o_totalprice", "F", "O")


@query(f"WITH {_PAIRED} SELECT k AS c_nationkey, round(a, 3) AS a, round(b, 3) AS b, round(delta, 3) AS delta FROM pr")
def paired_contrast(spark, d):
    return order_pairs(spark, d).select("c_nationkey", *[F.round(c, 3).alias(c) for c in ("a", "b", "delta")])


@query(f"WITH {_PAIRED} SELECT count(*) FILTER (delta > 0) AS wins, count(*) FILTER (delta < 0) AS losses, count(*) FILTER (delta = 0) AS ties, round(avg(delta), 3) AS mean_delta, round(median(delta), 3) AS median_delta FROM pr")
def sign_wins(spark, d):
    x = F.col("delta")
    return order_pairs(spark, d).agg(F.count_if(x > 0).alias("wins"), F.count_if(x < 0).alias("losses"), F.count_if(x == 0).alias("ties"), F.round(F.avg(x), 3).alias("mean_delta"), F.round(F.median(x), 3).alias("median_delta"))


_TESTS = """t AS (SELECT n_nationkey::BIGINT AS test, round(abs(sin(n_nationkey + 1)) / 20, 9) AS p FROM nation)"""


@query(f"""WITH {_TESTS}, s AS (SELECT test, p, least(1.0, (count(*) OVER () - row_number() OVER w + 1) * p) AS s FROM t WINDOW w AS (ORDER BY p, test))
SELECT test, p, round(max(s) OVER (ORDER BY p, test), 9) AS p_holm FROM s""")
def holm(spark, d):
    tests = table(spark, d, "nation").select(F.col("n_nationkey").cast("long").alias("test"), F.round(F.abs(F.sin(F.col("n_nationkey") + 1)) / 20, 9).alias("p"))
    return T.holm(tests).withColumn("p_holm", F.round("p_holm", 9))


@query("""WITH o AS (SELECT l_returnflag AS c, l_orderkey % 500 AS u, l_linenumber AS r, avg(l_quantity) AS v FROM lineitem GROUP BY ALL), need AS (SELECT c, count(DISTINCT r) AS need FROM o GROUP BY c),
f AS (SELECT c, u, count(*) AS n FROM o GROUP BY ALL), ok AS (SELECT f.c, u, n FROM f JOIN need ON f.c = need.c AND n = need WHERE n > 1)
SELECT a.c AS l_returnflag, a.u AS unit, any_value(n) AS n_repeats, round(avg(abs(a.v - b.v)), 6) AS noise FROM o a JOIN o b ON a.c = b.c AND a.u = b.u AND a.r < b.r JOIN ok ON ok.c = a.c AND ok.u = a.u GROUP BY ALL""")
def noise_band_pairs(spark, d):
    rows = table(spark, d, "lineitem").withColumn("unit", F.col("l_orderkey") % 500)
    return r6(T.noise_pairs(rows, "l_returnflag", "unit", "l_linenumber", "l_quantity"))


@query("SELECT count(*) AS n, round(avg((quality = toxic)::INT), 6) AS po, round(avg(quality) * avg(toxic) + (1 - avg(quality)) * (1 - avg(toxic)), 6) AS pe, round((avg((quality = toxic)::INT) - (avg(quality) * avg(toxic) + (1 - avg(quality)) * (1 - avg(toxic)))) / (1 - (avg(quality) * avg(toxic) + (1 - avg(quality)) * (1 - avg(toxic)))), 6) AS kappa FROM labels WHERE quality IS NOT NULL AND toxic IS NOT NULL")
def kappa(spark, d):
    return r6(T.kappa(table(spark, d, "labels"), "quality", "toxic"))


@query("SELECT doc_id, CASE WHEN min(v) = max(v) THEN min(v) END AS consensus, count(DISTINCT v) > 1 AS conflict FROM (SELECT doc_id, quality AS v FROM labels UNION ALL SELECT doc_id, toxic FROM labels) WHERE v IS NOT NULL GROUP BY doc_id")
def consensus(spark, d):
    rows = table(spark, d, "labels")
    votes = rows.select("doc_id", F.explode(F.array("quality", "toxic")).alias("v")).where("v IS NOT NULL")
    return votes.groupBy("doc_id").agg(F.when(F.min("v") == F.max("v"), F.min("v")).alias("consensus"), (F.count_distinct("v") > 1).alias("conflict"))


@query("SELECT event_type, round(quantile_cont(value, 0.25), 6) AS q25, round(quantile_cont(value, 0.5), 6) AS q50, round(quantile_cont(value, 0.9), 6) AS q90 FROM events GROUP BY event_type")
def interp_percentile(spark, d):
    e = table(spark, d, "events")
    return r6(e.groupBy("event_type").agg(*[F.percentile("value", q).alias(f"q{round(q * 100)}") for q in (0.25, 0.5, 0.9)]))


@query("SELECT event_type, round(v, 6) AS p90 FROM (SELECT event_type, value AS v, row_number() OVER (PARTITION BY event_type ORDER BY value) AS r, count(*) OVER (PARTITION BY event_type) AS n FROM events WHERE value IS NOT NULL) WHERE r = greatest(1, floor(n * 9 / 10)::BIGINT)")
def rank_p90(spark, d):
    return r6(T.rank_p90(table(spark, d, "events"), "event_type", "value"))


@query("""SELECT o_orderstatus, o_orderpriority, grouping(o_orderstatus, o_orderpriority)::BIGINT AS level, count(*) AS n, round(sum(o_totalprice) / sum(o_custkey + 1), 6) AS ratio_of_sums, round(avg(o_totalprice / (o_custkey + 1)), 6) AS mean_ratio, round(median(o_totalprice / (o_custkey + 1)), 6) AS median_ratio
FROM orders GROUP BY GROUPING SETS ((), (o_orderstatus), (o_orderstatus, o_orderpriority))""")
def grouped_census(spark, d):
    o = table(spark, d, "orders")
    ratio = F.col("o_totalprice") / (F.col("o_custkey") + 1)
    out = o.groupingSets([[], ["o_orderstatus"], ["o_orderstatus", "o_orderpriority"]], "o_orderstatus", "o_orderpriority").agg(F.grouping_id().cast("long").alias("level"), F.count("*").alias("n"), (F.sum("o_totalprice") / F.sum(F.col("o_custkey") + 1)).alias("ratio_of_sums"), F.avg(ratio).alias("mean_ratio"), F.median(ratio).alias("median_ratio"))
    return r6(out)


@query("SELECT o_orderpriority, round(avg(m), 3) AS macro_mean, count(*) AS n_groups FROM (SELECT o_orderpriority, c_nationkey, avg(o_totalprice) AS m FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL) GROUP BY 1")
def macro_mean(spark, d):
    out = T.macro_mean(order_scores(spark, d), ["o_orderpriority"], "c_nationkey", "o_totalprice")
    return out.withColumn("macro_mean", F.round("macro_mean", 3))


_COS = """e AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings), c AS (SELECT label, min(vec_id) AS vec_id FROM e GROUP BY label),
h AS (SELECT e.* FROM e JOIN c USING (vec_id)),
q AS (SELECT a.vec_id, h.label AS head, a.label = h.label AS pos, round(least(greatest(list_dot_product(a.v, h.v) / sqrt(list_dot_product(a.v, a.v)) / sqrt(list_dot_product(h.v, h.v)), 0), 1), 6) AS sim FROM e a JOIN h ON a.vec_id <> h.vec_id)"""


def head_pairs(spark, d):
    """Each vector against the first vector of each label (one a label; broadcast while their number is small)."""
    e = table(spark, d, "embeddings")
    heads = e.groupBy("label").agg(F.min_by("embedding", "vec_id").alias("hv"), F.min("vec_id").alias("hid")).select(F.col("label").alias("head"), "hv", "hid")
    both = e.join(heads, F.col("vec_id") != F.col("hid"))
    return both.select("vec_id", "head", (F.col("label") == F.col("head")).alias("pos"), F.round(L.cosine(F.col("embedding"), F.col("hv")), 6).alias("sim"))


@query(f"WITH {_COS} SELECT vec_id, head, pos, sim FROM q")
def cosine_pairs(spark, d):
    return head_pairs(spark, d)


_SWEEP = [0.1, 0.2, 0.3, 0.5, 0.7]


@query(f"""WITH {_COS}, s AS (SELECT t AS threshold, count(*) FILTER (sim >= t AND pos) AS tp, count(*) FILTER (sim >= t AND NOT pos) AS fp, count(*) FILTER (sim < t AND NOT pos) AS tn, count(*) FILTER (sim < t AND pos) AS fn FROM q, (SELECT unnest({_SWEEP}::DOUBLE[]) AS t) GROUP BY t)
SELECT threshold, tp, fp, tn, fn, round(tp / (tp + fn), 6) AS tpr, round(tn / (tn + fp), 6) AS tnr, round((tp / (tp + fn) + tn / (tn + fp)) / 2, 6) AS balanced FROM s""")
def threshold_sweep(spark, d):
    return r6(T.threshold_sweep(head_pairs(spark, d), "sim", "pos", _SWEEP))


@query(f"""WITH {_COS}, a AS (SELECT sim, count(*) FILTER (pos) AS p, count(*) FILTER (NOT pos) AS n FROM q GROUP BY sim), b AS (SELECT *, coalesce(sum(n) OVER (ORDER BY sim DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS above FROM a)
SELECT sum(p * above)::BIGINT AS inverted, sum(p * n)::BIGINT AS tied, (sum(p) * sum(n))::BIGINT AS n_pairs, round(1 - (sum(p * above) + sum(p * n) / 2) / (sum(p) * sum(n)), 6) AS separability FROM b""")
def inversions(spark, d):
    return r6(T.inversions(head_pairs(spark, d), "sim", "pos"))


_NORM = r"array_to_string(list_filter(string_split(regexp_replace(lower({0}), '[^a-z0-9_]+', ' ', 'g'), ' '), lambda w: w NOT IN ('', 'the', 'a', 'an')), ' ')"


@query(f"SELECT p_partkey, {_NORM.format('p_name')} AS name, {_NORM.format('p_type')} AS type FROM part")
def normalised_label(spark, d):
    return table(spark, d, "part").select("p_partkey", L.normalise_label(F.col("p_name")).alias("name"), L.normalise_label(F.col("p_type")).alias("type"))


@query(f"""WITH s AS (SELECT p_partkey, list_distinct(string_split({_NORM.format('p_name')}, ' ')) AS a, list_distinct(string_split({_NORM.format('p_type')}, ' ')) AS b FROM part)
SELECT p_partkey, round(CASE WHEN len(list_filter(a, lambda w: w <> '')) = 0 AND len(list_filter(b, lambda w: w <> '')) = 0 THEN 1.0 ELSE 2.0 * len(list_filter(list_intersect(a, b), lambda w: w <> '')) / (len(list_filter(a, lambda w: w <> '')) + len(list_filter(b, lambda w: w <> ''))) END, 6) AS f1 FROM s""")
def token_f1(spark, d):
    return r6(table(spark, d, "part").select("p_partkey", L.token_f1(F.col("p_name"), F.col("p_type")).alias("f1")))


@query(f"""SELECT p_partkey, substr(sha256(least({_NORM.format('p_name')}, {_NORM.format('p_type')}) || chr(0) || greatest({_NORM.format('p_name')}, {_NORM.format('p_type')})), 1, 12) AS pair FROM part""")
def pair_ids(spark, d):
    return table(spark, d, "part").select("p_partkey", L.pair_id(F.col("p_name"), F.col("p_type")).alias("pair"))


# ---- language rows, validation, selection, sets ------------------------------------------------------------------

from .operators import language as G  # noqa: E402
from .operators import selection as C  # noqa: E402
from .operators import validation as V  # noqa: E402


def language(spark, d):
    """Conversation rows as language rows: system turns are plans, user turns subtasks or interjections, assistant turns vqa (the text as a label, the turn as a count) or speech."""
    style = F.when(F.col("role") == "system", "plan").when(F.col("role") == "user", F.when(F.col("turn") % 4 == 0, "subtask").otherwise("interjection")).when(F.col("turn") % 4 == 1, "vqa")
    return table(spark, d, "conversations").withColumn("_style", style).select(F.col("conv_id").alias("episode"), F.col("turn").cast("double").alias("t"), "role", F.when(F.col("_style") == "vqa", F.to_json(F.struct(F.col("text").alias("label"), F.col("turn").alias("count")))).otherwise(F.col("text")).alias("content"), F.col("_style").alias("style"), F.lit(None).cast("string").alias("camera"), F.col("turn").alias("position"))


_LANG = """lang AS (SELECT episode, t, role, CASE WHEN style = 'vqa' THEN json_object('label', text, 'count', position)::VARCHAR ELSE text END AS content, position, style FROM (SELECT conv_id AS episode, turn::DOUBLE AS t, role, text, turn AS position,
  CASE WHEN role = 'system' THEN 'plan' WHEN role = 'user' THEN CASE WHEN turn % 4 = 0 THEN 'subtask' ELSE 'interjection' END WHEN turn % 4 = 1 THEN 'vqa' END AS style FROM conversations))"""
_STYLE = "CASE WHEN style IS NULL OR style IN ('interjection', 'vqa') THEN 'events' WHEN style IN ('subtask', 'plan', 'memory', 'task_aug') THEN 'persistent' END"


def turn_frames(spark, d):
    return table(spark, d, "conversations").select(F.col("conv_id").alias("episode"), F.col("turn").cast("double").alias("t"))


@query(f"""WITH {_LANG}, p AS (SELECT episode, string_agg(style || ':' || content, '|' ORDER BY t, style, role, position) AS s, count(*) AS n FROM lang WHERE {_STYLE} = 'persistent' GROUP BY episode),
f AS (SELECT conv_id AS episode, turn::DOUBLE AS t FROM conversations)
SELECT f.episode, f.t, coalesce(n, 0) AS n_persistent, coalesce(s, '') AS persistent FROM f LEFT JOIN p USING (episode)""")
def persistent_broadcast(spark, d):
    out = G.language_columns(turn_frames(spark, d), language(spark, d))
    x = F.col("language_persistent")
    return out.select("episode", "t", F.size(x).cast("long").alias("n_persistent"), F.array_join(F.transform(x, lambda r: F.concat(r["style"], F.lit(":"), r["content"])), "|").alias("persistent"))


@query(f"""WITH {_LANG}, e AS (SELECT episode, t, string_agg(coalesce(style, 'speech') || ':' || content, '|' ORDER BY coalesce(style, ''), coalesce(role, ''), position) AS s, count(*) AS n FROM lang WHERE {_STYLE} = 'events' GROUP BY ALL),
f AS (SELECT conv_id AS episode, turn::DOUBLE AS t FROM conversations)
SELECT f.episode, f.t, coalesce(n, 0) AS n_events, coalesce(s, '') AS events FROM f LEFT JOIN e USING (episode, t)""")
def event_bucket(spark, d):
    out = G.language_columns(turn_frames(spark, d), language(spark, d))
    x = F.col("language_events")
    return out.select("episode", "t", F.size(x).cast("long").alias("n_events"), F.array_join(F.transform(x, lambda r: F.concat(F.coalesce(r["style"], F.lit("speech")), F.lit(":"), r["content"])), "|").alias("events"))


@query(f"""WITH {_LANG}, s AS (SELECT episode, row_number() OVER (PARTITION BY episode ORDER BY t, role, position) - 1 AS idx, content AS text, t AS start FROM lang WHERE style = 'subtask'),
f AS (SELECT DISTINCT conv_id AS episode FROM conversations) SELECT s.episode, idx::BIGINT AS idx, text, start FROM s JOIN f USING (episode)""")
def subtask_readback(spark, d):
    return G.subtask_rows(G.language_columns(turn_frames(spark, d), language(spark, d)))


_F3 = "f3 AS (SELECT conv_id AS episode, turn::DOUBLE AS t FROM conversations)"
_VIOLATIONS = f"""WITH {_LANG}, {_F3}, v AS (
SELECT episode, 'routing' AS "check" FROM lang WHERE {_STYLE} IS NULL
UNION ALL SELECT episode, 'off_frame' FROM lang l WHERE {_STYLE} = 'events' AND NOT EXISTS (SELECT 1 FROM f3 WHERE f3.episode = l.episode AND f3.t = l.t)
UNION ALL SELECT episode, 'orphan_interjection' FROM lang l WHERE style = 'interjection' AND NOT EXISTS (SELECT 1 FROM lang s WHERE s.style IS NULL AND s.episode = l.episode AND s.t = l.t)
UNION ALL SELECT episode, 'plan_missing' FROM lang l WHERE style = 'interjection' AND NOT EXISTS (SELECT 1 FROM lang s WHERE s.style = 'plan' AND s.episode = l.episode AND s.t = l.t)
UNION ALL SELECT episode, 'memory_off_subtask' FROM lang l WHERE style = 'memory' AND NOT EXISTS (SELECT 1 FROM lang s WHERE s.style = 'subtask' AND s.episode = l.episode AND s.t = l.t)
UNION ALL SELECT episode, 'vqa_repeated' FROM lang WHERE style = 'vqa' GROUP BY episode, t, role HAVING count(*) > 1
UNION ALL SELECT episode, 'plan_incomplete' FROM lang GROUP BY episode, t HAVING count(*) FILTER (style = 'subtask') > count(*) FILTER (style = 'plan')
UNION ALL SELECT episode, 'content' FROM lang WHERE (content IS NULL AND style IS NOT NULL) OR (style = 'vqa' AND role = 'assistant' AND NOT coalesce(CASE WHEN json_valid(content) THEN json_type(content::JSON) = 'OBJECT' END, false)))"""


@query(f"{_VIOLATIONS} SELECT episode, \"check\", count(*) AS n FROM v GROUP BY ALL")
def violations(spark, d):
    return V.all_violations(language(spark, d), turn_frames(spark, d)).groupBy("episode", "check").agg(F.count("*").alias("n"))


@query(f"""{_VIOLATIONS}, sk AS (SELECT DISTINCT episode FROM v WHERE "check" = 'plan_incomplete'), h AS (SELECT count(*) AS n_errors FROM v WHERE "check" IN ('routing', 'off_frame', 'orphan_interjection', 'plan_missing', 'vqa_repeated', 'content') AND episode NOT IN (SELECT episode FROM sk))
SELECT (SELECT count(DISTINCT episode) FROM lang) AS n, (SELECT count(*) FROM sk) AS n_skipped, n_errors, n_errors = 0 AND (SELECT count(*) FROM sk) <= 0.5 * (SELECT count(DISTINCT episode) FROM lang) AS publish FROM h""")
def publish_gate(spark, d):
    rows = language(spark, d)
    return V.publish_gate(V.all_violations(rows, turn_frames(spark, d)), rows)


@query("SELECT event_id, json_keys(props)[1] AS first_key, CASE WHEN list_contains(json_keys(props), 'detections') THEN 'bbox' END AS shape, (props::JSON ->> 'k')::BIGINT AS k FROM events")
def json_shape(spark, d):
    return table(spark, d, "events").select("event_id", F.json_object_keys("props")[0].alias("first_key"), L.json_shape(F.col("props")).alias("shape"), F.get_json_object("props", "$.k").cast("long").alias("k"))


@query(f"""WITH {_FRAMES}, f AS (SELECT episode, t, CASE WHEN event_id % 50 = 0 THEN NULL WHEN event_id % 51 = 0 THEN -1.0 WHEN event_id % 52 = 0 THEN t - 1e7 ELSE t END AS u, event_id FROM frames),
r AS (SELECT episode, event_id AS frame, CASE WHEN u IS NULL THEN 'not finite' WHEN u < 0 THEN 'negative' WHEN lag(u) OVER (PARTITION BY episode ORDER BY t, event_id) >= u THEN 'not increasing' END AS reason, t FROM f)
SELECT episode, reason, count(*) AS n FROM r WHERE reason IS NOT NULL GROUP BY ALL""")
def bad_times(spark, d):
    f = frames(spark, d)
    bad = F.when(F.col("event_id") % 50 == 0, None).when(F.col("event_id") % 51 == 0, -1.0).when(F.col("event_id") % 52 == 0, F.col("t") - 1e7).otherwise(F.col("t"))
    return V.bad_times(f.select("episode", F.struct("t", "event_id").alias("frame"), bad.alias("t"))).groupBy("episode", "reason").agg(F.count("*").alias("n"))


@query("""WITH e AS (SELECT user_id, event_type, ts, event_id FROM events), k AS (SELECT *, row_number() OVER (PARTITION BY user_id, (event_id % 3) ORDER BY (event_type = 'error')::INT, event_id DESC) AS n FROM e)
SELECT user_id, event_id % 3 AS fmt, event_id, event_type FROM k WHERE n = 1""")
def latest_wins(spark, d):
    e = table(spark, d, "events").withColumn("fmt", F.col("event_id") % 3)
    return C.latest_wins(e, ["user_id", "fmt"], "event_id", F.col("event_type") == "error").select("user_id", "fmt", "event_id", "event_type")


@query("SELECT user_id, event_type, min(event_id) AS event_id FROM events GROUP BY ALL")
def first_wins(spark, d):
    return C.first_wins(table(spark, d, "events"), ["user_id", "event_type"], "event_id").select("user_id", "event_type", "event_id")


@query("""WITH r AS (SELECT c_nationkey, c_custkey, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1 AS r, count(*) OVER (PARTITION BY c_nationkey) AS n FROM customer)
SELECT c_nationkey, c_custkey FROM r WHERE n <= 7 OR r IN (SELECT unnest(list_transform(range(0, 7), lambda i: i * n // 7)))""")
def even_split(spark, d):
    return C.even_split(table(spark, d, "customer"), ["c_nationkey"], ["c_custkey"], 7).select("c_nationkey", "c_custkey")


@query("""SELECT c_nationkey, c_custkey, seed_rank FROM (SELECT c_nationkey, c_custkey, row_number() OVER (PARTITION BY c_nationkey ORDER BY sha256('1729:' || c_nationkey || ':' || c_custkey)) AS seed_rank FROM customer) WHERE seed_rank <= 10""")
def hash_seeds(spark, d):
    out = C.hash_seeds(table(spark, d, "customer"), ["c_nationkey"], [F.col("c_nationkey"), F.col("c_custkey")], 10)
    return out.select("c_nationkey", "c_custkey", F.col("seed_rank").cast("long").alias("seed_rank"))


@query("""SELECT p_brand, p_partkey, turn FROM (SELECT p_brand, p_partkey, row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey) AS turn FROM part) ORDER BY turn, p_brand LIMIT 40""")
def round_robin_topk(spark, d):
    out = C.round_robin(table(spark, d, "part"), "p_brand", [F.desc("p_retailprice"), "p_partkey"], 40)
    return out.select("p_brand", "p_partkey", F.col("turn").cast("long").alias("turn"))


@query("""WITH m AS (SELECT s_nationkey, median(s_acctbal) AS mid, count(*) AS n FROM supplier GROUP BY 1), k AS (SELECT s.s_nationkey, s_name, abs(s_acctbal - mid) AS gap, n, row_number() OVER (PARTITION BY s.s_nationkey ORDER BY abs(s_acctbal - mid), s_name) AS r FROM supplier s JOIN m USING (s_nationkey))
SELECT s_nationkey, s_name, round(gap, 6) AS gap, n FROM k WHERE r = 1""")
def view_nearest_median(spark, d):
    return r6(C.nearest_median(table(spark, d, "supplier"), "s_nationkey", "s_name", "s_acctbal"))


@query("""WITH i AS (SELECT o_orderkey, dense_rank() OVER (ORDER BY o_orderkey) - 1 AS new_id FROM (SELECT DISTINCT o_orderkey FROM orders))
SELECT new_id, count(*) AS n_lines, round(sum(l_quantity), 3) AS quantity FROM lineitem JOIN i ON l_orderkey = o_orderkey GROUP BY new_id""")
def index_translation(spark, d):
    index = C.renumber(table(spark, d, "orders"), "o_orderkey")
    good, _ = C.translate(table(spark, d, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey"), index, "o_orderkey", "new_id")
    return good.groupBy("new_id").agg(F.count("*").alias("n_lines"), F.round(F.sum("l_quantity"), 3).alias("quantity"))


@query("""SELECT count(*) AS n_pairs, count(DISTINCT l_orderkey) = count(*) AS a_unique, count(DISTINCT l_suppkey) = count(*) AS b_unique FROM (SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem)""")
def index_injective(spark, d):
    return C.injective(table(spark, d, "lineitem"), "l_orderkey", "l_suppkey")


@query("""SELECT user_id, event_type FROM (SELECT DISTINCT user_id FROM events), (SELECT DISTINCT event_type FROM events) EXCEPT SELECT user_id, event_type FROM events WHERE value > 60""")
def missing_cells(spark, d):
    e = table(spark, d, "events")
    return V.missing_cells(e.where("value > 60").select("user_id", "event_type").distinct(), e.select("user_id").distinct(), e.select("event_type").distinct())


@query("""SELECT user_id, event_type, greatest(a - b, 0)::BIGINT AS short, least(a, b)::BIGINT AS shared FROM (SELECT user_id, event_type, count(*) FILTER (event_id % 2 = 0) AS a, count(*) FILTER (event_id % 2 = 1) AS b FROM events GROUP BY ALL)""")
def completeness_multiset(spark, d):
    n = lambda k: F.count_if(F.col("event_id") % 2 == k)
    out = table(spark, d, "events").groupBy("user_id", "event_type").agg(n(0).alias("a"), n(1).alias("b"))
    return out.select("user_id", "event_type", F.greatest(F.col("a") - F.col("b"), F.lit(0)).cast("long").alias("short"), F.least("a", "b").alias("shared"))


# ---- kernels: dynamic programs and resampling; tested against plain versions -------------------------------------


def packed(spark, d) -> DataFrame:
    return S.pack(ref_spans(spark, d), "ref").join(S.pack(pred_spans(spark, d), "pred"), "episode", "full")


def _kernel(df: DataFrame, fn, schema: str) -> DataFrame:
    """fn(row) -> tuple for each row, in Arrow batches."""
    import pyarrow as pa

    def run(batches):
        for batch in batches:
            rows = [fn(r) for r in batch.to_pylist()]
            yield pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in rows], schema=kind)

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    names = StructType.fromDDL(schema).names
    kind = to_arrow_schema(StructType.fromDDL(schema))
    return df.mapInArrow(run, schema)


@query()
def boundary_f1(spark, d):
    """Internal boundaries at five tolerances, in hours."""
    starts = lambda spans: [s["start"] for s in (spans or [])[1:]]
    fn = lambda r: (r["episode"], *(x for tol in (0.5, 1.0, 2.0, 3.0, 5.0) for x in K.boundary_f1(starts(r["pred"]), starts(r["ref"]), tol * 3600)))
    return _kernel(packed(spark, d), fn, "episode long, " + ", ".join(f"{x}_{tag} double" for tag in ("0p5", "1", "2", "3", "5") for x in ("precision", "recall", "f1")))


@query()
def macro_iou(spark, d):
    ends = lambda spans: [(s["start"], s["end"]) for s in spans or []]
    return _kernel(packed(spark, d), lambda r: (r["episode"], K.macro_iou(ends(r["pred"]), ends(r["ref"]))), "episode long, macro_iou double")


@query()
def edit_score(spark, d):
    texts = lambda spans: [s["text"] for s in spans or []]
    return _kernel(packed(spark, d), lambda r: (r["episode"], K.edit_score(texts(r["pred"]), texts(r["ref"]))), "episode long, edit_score double")


@query()
def index_recovery(spark, d):
    texts = lambda spans: [s["text"] for s in spans or []]
    return _kernel(packed(spark, d), lambda r: (r["episode"], *K.index_recovery(texts(r["pred"]), texts(r["ref"]))), "episode long, matched int, ways int, indices array<int>")


@query()
def dp_boundaries(spark, d):
    """Episodes rescaled to a minute; all internal boundaries of the model shifted, the prior equal shares."""
    rows = S.pack(ref_spans(spark, d)).join(S.episode_extent(frames(spark, d)), "episode").where("t_last > t0")

    def fn(r):
        scale = 60.0 / (r["t_last"] - r["t0"])
        model = sorted((s["start"] - r["t0"]) * scale for s in r["spans"][1:])
        return r["episode"], model, K.solve_boundaries(model, 0.0, 60.0, [1 / (len(model) + 1)] * (len(model) + 1)) or model

    return _kernel(rows, fn, "episode long, model array<double>, solved array<double>")


@query()
def cluster_bootstrap(spark, d):
    """Total price by order status: clusters are nations."""
    return T.cluster_bootstrap(order_scores(spark, d), "o_orderstatus", "c_nationkey", "o_totalprice")


@query()
def motion_sampling(spark, d):
    rows = frames(spark, d).groupBy("episode").agg(F.array_sort(F.collect_list(F.struct("t", "event_id", "value"))).alias("f"))
    fn = lambda r: (r["episode"], K.motion_times([x["t"] for x in r["f"]], [[[x["value"]] for x in r["f"]]], 12))
    return _kernel(rows, fn, "episode long, times array<double>")


@query()
def study_scores(spark, d):
    """The whole score row of every episode, with those that have no prediction."""
    from .plans.study import scores

    f = frames(spark, d)
    return scores(f.select("episode").distinct(), pred_spans(spark, d), ref_spans(spark, d), step=3600.0, tolerances=(1800.0, 3600.0, 7200.0, 10800.0, 18000.0))


@query()
def annotated_frames(spark, d):
    """Frames with their language columns, from run-length spans through stitching and plans."""
    from .plans.study import annotate

    out, _ = annotate(frames(spark, d), ref_spans(spark, d))
    return out.select("episode", "t", "event_id", F.size("language_persistent").alias("n_persistent"), F.size("language_events").alias("n_events"))

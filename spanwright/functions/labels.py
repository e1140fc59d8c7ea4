"""Label text functions as native columns, and the full Unicode form as an Arrow-batched UDF."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Dropped articles, and groups of opposed words, each word with its side.
ARTICLES = ("the", "a", "an")
CONTRASTS = (
    {"left": "L", "leftmost": "L", "right": "R", "rightmost": "R"},
    {"open": "O", "opens": "O", "opening": "O", "opened": "O", "close": "C", "closes": "C", "closing": "C", "closed": "C", "shut": "C"},
    {"up": "U", "upward": "U", "upwards": "U", "down": "D", "downward": "D", "downwards": "D"},
    {"in": "I", "into": "I", "inside": "I", "on": "N", "onto": "N", "atop": "N"},
    {"push": "P", "pushes": "P", "pushing": "P", "pull": "L", "pulls": "L", "pulling": "L"},
    {"first": "1", "second": "2", "third": "3", "fourth": "4"},
    {"top": "T", "bottom": "B", "upper": "T", "lower": "B"},
    {"front": "F", "back": "K", "rear": "K"},
)


def normalise_label(text: Column) -> Column:
    """Lower case, non-words to spaces, articles dropped, single spaces. For text whose NFKC and case folding is lower()."""
    words = F.split(F.regexp_replace(F.lower(text), "[^a-z0-9_]+", " "), " ")
    return F.array_join(F.filter(words, lambda w: (w != "") & ~w.isin(*ARTICLES)), " ")


@F.pandas_udf(StringType())
def normalise_label_unicode(text: pd.Series) -> pd.Series:
    """normalise_label for any text: NFKC, case folding, Unicode word characters."""
    folded = text.map(lambda s: None if s is None else unicodedata.normalize("NFKC", s).casefold())
    spaced = folded.str.replace(r"[^\w]+", " ", regex=True)
    return spaced.map(lambda s: None if s is None else " ".join(w for w in s.split() if w not in ARTICLES))


def token_set(text: Column) -> Column:
    return F.array_distinct(F.filter(F.split(normalise_label(text), " "), lambda w: w != ""))


def token_f1(a: Column, b: Column) -> Column:
    """F1 of token sets: 1 where both are empty, 0 where one is."""
    x, y = token_set(a), token_set(b)
    return F.when((F.size(x) == 0) & (F.size(y) == 0), 1.0).otherwise(F.coalesce(F.try_divide(2.0 * F.size(F.array_intersect(x, y)), F.size(x) + F.size(y)), F.lit(0.0)))


def contrast_conflict(a: Column, b: Column) -> Column:
    """Whether some group of opposed words has exactly one side in each label, and not the same."""
    groups = F.array(*[F.create_map(*[F.lit(v) for pair in g.items() for v in pair]) for g in CONTRASTS])

    def sides(words: Column, group: Column) -> Column:
        return F.array_distinct(F.filter(F.transform(words, lambda w: F.try_element_at(group, w)), lambda v: v.isNotNull()))

    def differ(p: Column, q: Column) -> Column:
        return (F.size(p) == 1) & (F.size(q) == 1) & (F.get(p, F.lit(0)) != F.get(q, F.lit(0)))

    # the words are split once and the groups are one expression, not a copy each
    both = F.transform(F.array(F.struct(token_set(a).alias("x"), token_set(b).alias("y"))), lambda t: F.exists(groups, lambda g: differ(sides(t["x"], g), sides(t["y"], g))))
    return F.get(both, F.lit(0))


class Exact:
    """Labels are the same when their normal forms are."""

    name, threshold = "exact", 1.0
    #: Whether similarity costs enough to be computed once a pair of labels instead of once a pair of spans.
    once = False

    def prepare(self, pairs: DataFrame, a: str, b: str) -> DataFrame:
        """pairs with whatever similarity() needs of the label columns a and b."""
        return pairs

    def similarity(self, a: str, b: str) -> Column:
        return F.when(normalise_label(F.col(a)) == normalise_label(F.col(b)), 1.0).otherwise(0.0)

    def scored(self, pairs: DataFrame, a: str, b: str) -> DataFrame:
        """pairs with `sim` and `same`; a missing label is similar to nothing. Distinct label pairs are joined back, which the runtime broadcasts where they are few."""
        if not self.once:
            out = self.prepare(pairs, a, b).withColumn("sim", self.similarity(a, b))
        else:
            known = self.prepare(pairs.select(a, b).distinct(), a, b).select(F.col(a).alias("_a"), F.col(b).alias("_b"), self.similarity(a, b).alias("sim"))
            out = pairs.join(known, (pairs[a] == known["_a"]) & (pairs[b] == known["_b"]), "left").drop("_a", "_b")
        out = out.withColumn("sim", F.when(F.col(a).isNull() | F.col(b).isNull(), 0.0).otherwise(F.coalesce("sim", F.lit(0.0))))
        return out.withColumn("same", F.col("sim") >= self.threshold)


class TokenF1(Exact):
    """F1 of the words; a diagnostic, as opposites share most of their words."""

    name, once = "token_f1", True

    def __init__(self, threshold: float = 0.8):
        self.threshold = threshold

    def similarity(self, a: str, b: str) -> Column:
        return token_f1(F.col(a), F.col(b))


class Embedding(Exact):
    """Cosine of label vectors, 0 where the labels take different sides of a contrast.

    vectors has one row a normal form: (label, vector). It is looked up twice; a vocabulary of at
    most broadcast_rows labels is broadcast. A label without a vector is similar to nothing.
    """

    name, once = "embedding", True

    def __init__(self, vectors: DataFrame, threshold: float = 0.93, guard: bool = True, broadcast_rows: int = 100_000):
        self.vectors, self.threshold, self.guard = vectors.select("label", "vector"), threshold, guard
        self.small = vectors.count() <= broadcast_rows

    def prepare(self, pairs: DataFrame, a: str, b: str) -> DataFrame:
        for c in (a, b):
            v = self.vectors.select(F.col("label").alias(f"{c}__key"), F.col("vector").alias(f"{c}__vector"))
            pairs = pairs.withColumn(f"{c}__key", normalise_label(F.col(c))).join(F.broadcast(v) if self.small else v, f"{c}__key", "left").drop(f"{c}__key")
        return pairs

    def similarity(self, a: str, b: str) -> Column:
        near = F.when(F.col(f"{a}__vector").isNull() | F.col(f"{b}__vector").isNull(), 0.0).otherwise(cosine(F.col(f"{a}__vector"), F.col(f"{b}__vector")))
        return F.when(contrast_conflict(F.col(a), F.col(b)), 0.0).otherwise(near) if self.guard else near


class Judged(Exact):
    """Verdicts that were given before, by the order-independent id of the pair; equal normal forms need none.

    cache has one row a pair: (pair, verdict). A pair without a verdict is taken as different; misses() lists them.
    """

    name, once = "judge", True

    def __init__(self, cache: DataFrame):
        self.cache = cache.select("pair", "verdict").dropDuplicates(["pair"])

    def prepare(self, pairs: DataFrame, a: str, b: str) -> DataFrame:
        return pairs.withColumn("pair", pair_id(F.col(a), F.col(b))).join(self.cache, "pair", "left").withColumnsRenamed({"pair": f"{a}__pair", "verdict": f"{a}__verdict"})

    def similarity(self, a: str, b: str) -> Column:
        same = normalise_label(F.col(a)) == normalise_label(F.col(b))
        return F.when(same, 1.0).when(contrast_conflict(F.col(a), F.col(b)), 0.0).otherwise(F.when(F.coalesce(f"{a}__verdict", F.lit(False)), 1.0).otherwise(0.0))

    def misses(self, pairs: DataFrame, a: str, b: str) -> DataFrame:
        """(pair, left, right) of label pairs that neither equality nor the guard nor the cache decides, each once."""
        x, y = normalise_label(F.col(a)), normalise_label(F.col(b))
        rows = pairs.where((x != y) & ~contrast_conflict(F.col(a), F.col(b))).select(pair_id(F.col(a), F.col(b)).alias("pair"), F.least(x, y).alias("left"), F.greatest(x, y).alias("right"))
        return rows.dropDuplicates(["pair"]).join(self.cache, "pair", "left_anti")


EXACT = Exact()


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity held in [0, 1]."""
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)
    return F.least(F.greatest(F.coalesce(F.try_divide(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))), F.lit(0.0)), F.lit(0.0)), F.lit(1.0))


def pair_id(a: Column, b: Column) -> Column:
    """Order-independent id of a label pair: 12 hex digits."""
    x, y = normalise_label(a), normalise_label(b)
    return F.substring(F.sha2(F.concat(F.least(x, y), F.lit("\0"), F.greatest(x, y)), 256), 1, 12)


def clock_seconds(text: Column) -> Column:
    """Seconds of '50.04s', 'MM:SS.ss' or 'H:MM:SS.ss'; null where it is none of them or minutes or seconds are 60 or more."""
    t = F.trim(text)
    h, m, s = (F.try_to_number(F.regexp_extract(t, r"^(?:(\d+):)?(\d{1,2}):(\d{1,2}(?:\.\d+)?)$", k), F.lit("999999999.999999")).cast("double") for k in (1, 2, 3))
    plain = F.regexp_extract(t, r"^(\d+(?:\.\d+)?)s?$", 1)
    clock = F.when((m < 60) & (s < 60), F.coalesce(h, F.lit(0.0)) * 3600 + m * 60 + s)
    return F.when(plain != "", plain.try_cast("double")).otherwise(clock)


def json_shape(text: Column) -> Column:
    """Which of the five answer shapes a JSON object has, the first whose keys are all there; null where none or no JSON."""
    keys = F.json_object_keys(text)
    has = lambda *names: F.size(F.array_intersect(keys, F.array(*[F.lit(n) for n in names]))) == len(names)
    return F.when(has("detections"), "bbox").when(has("label", "point_format", "point"), "keypoint").when(has("label", "count"), "count").when(has("label", "attribute", "value"), "attribute").when(has("subject", "relation", "object"), "spatial")

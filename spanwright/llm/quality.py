"""Quality rules: a document's own failures, and its host's, as native column expressions.

A document fails by itself when it has fewer than `min_words` words or more than
half of its words lie in three-word windows that the text repeats. Hosts are
judged by five rules (RULES): those two, symbols, word length and repeated
lines. For each rule, failures are summed by host, and a beta prior is fitted
to the rates of all hosts by moments: with m their mean and v their variance, its
weight is m(1-m)/v - 1, held between 1 and 1000 documents (1000 where rates don't
differ). A host's rate is shrunk towards m by that weight: a host of few
documents keeps close to the prior, a large one to its own rate. The rule's
limit comes from the same distribution: `spreads` standard deviations of the prior
above m, but not under `least_limit` nor over `most_limit`. Documents of a host
over the limit of any rule go too.

The sums are partial before the shuffle, so a host with a third of all rows is
one row a task. Verdicts go back by spread_join, which looks frequent hosts up in a
broadcast of counted size, so no task gets all rows of a host.

Defined cases: null and blank texts have no words and fail; rows with a null
host are judged by themselves alone; repeated rows each count; texts of any length
are judged whole; on empty tables the result is empty; other columns don't matter
and may have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .rounds import numbered, spread_join, written

#: Characters that count as symbols.
SYMBOLS = "#*$%&|<>"
_WHITE = " \t\n\x0b\x0c\r"


def let(value: Column, body) -> Column:
    """body(value) with the value computed once."""
    return F.transform(F.array(value), body)[0]


def repeated_words(words: Column) -> Column:
    """How many words lie in a three-word window found twice or more.

    Windows are hashed and sorted with their places; those equal to a neighbour
    repeat. Sorting keeps the cost of a text of any length near-linear.
    """
    keys = F.transform(F.sequence(F.lit(1), F.greatest(F.size(words) - 2, F.lit(1))), lambda i: F.struct(F.xxhash64(F.get(words, i - 1), F.get(words, i), F.get(words, i + 1)).alias("h"), i.alias("i")))
    at = let(
        F.sort_array(keys),
        lambda s: F.transform(s, lambda x, k: F.when((F.get(s, k - 1)["h"] == x["h"]) | (F.get(s, k + 1)["h"] == x["h"]), x["i"])),
    )
    places = F.flatten(F.transform(F.array_compact(at), lambda i: F.array(i, i + 1, i + 2)))
    return F.when(F.size(words) < 4, F.lit(0)).otherwise(F.size(F.array_distinct(places))).cast("long")


def base_columns(text: Column) -> dict[str, Column]:
    """The per-document counts. Words are runs of characters that aren't ASCII white space.

    The words are bound once inside `words`, so that a filter on what comes of
    them can be pushed down without computing them again for each element.
    """
    text = F.coalesce(text, F.lit(""))
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return {
        "words": let(words, lambda w: F.struct(F.size(w).cast("long").alias("n"), repeated_words(w).alias("repeated"))),
        "word_chars": F.length(F.translate(text, _WHITE, "")).cast("long"),
        "n_symbols": (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long"),
        "lines": let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("again"))),
    }


#: A document fails a rule where its condition holds.
RULES = {
    "few_words": "n_words < {min_words}",
    "repeats": "100 * n_repeat_words > 50 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "word_length": "word_chars < 3 * n_words OR word_chars > 10 * n_words",
    "lines": "10 * n_dup_lines > 3 * n_lines",
}
_COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_lines", "n_repeat_words"]


def with_base(rows: DataFrame, text_col: str, min_words: int = 50) -> DataFrame:
    """rows and the counts, fails (an array of one boolean a rule) and base_failed."""
    out = rows.withColumns(base_columns(rows[text_col]))
    out = out.withColumns({"n_words": F.col("words.n"), "n_repeat_words": F.col("words.repeated"), "n_lines": F.col("lines.n"), "n_dup_lines": F.col("lines.again")})
    out = out.withColumn("fails", F.array(*[F.expr(c.format(min_words=min_words)) for c in RULES.values()]))
    return out.withColumn("base_failed", F.col("fails")[0] | F.col("fails")[1]).select(*rows.columns, *_COUNTS, "fails", "base_failed")


def host_verdicts(rows: DataFrame, least_limit: float = 0.2, most_limit: float = 0.5, spreads: float = 3.0) -> DataFrame:
    """(host, host_docs, host_rates and host_limits in the order of RULES, host_failed) from (host, fails)."""
    k = range(len(RULES))
    hosts = rows.where(F.col("host").isNotNull()).groupBy("host").agg(F.count("*").alias("host_docs"), *[F.count_if(F.col("fails")[i]).alias(f"f{i}") for i in k])
    rate = [F.col(f"f{i}") / F.col("host_docs") for i in k]
    prior = hosts.agg(*[F.avg(rate[i]).alias(f"m{i}") for i in k], *[F.coalesce(F.var_pop(rate[i]), F.lit(0.0)).alias(f"v{i}") for i in k])
    weight = lambda m, v: F.when(v < 1e-12, 1000.0).otherwise(F.least(F.lit(1000.0), F.greatest(F.lit(1.0), F.try_divide(m * (1 - m), v) - 1)))
    prior = prior.select("*", *[weight(F.col(f"m{i}"), F.col(f"v{i}")).alias(f"w{i}") for i in k])
    limit = [F.least(F.lit(most_limit), F.greatest(F.lit(least_limit), F.col(f"m{i}") + spreads * F.sqrt(F.col(f"m{i}") * (1 - F.col(f"m{i}")) / (F.col(f"w{i}") + 1)))) for i in k]
    prior = prior.select("*", F.array(*limit).alias("host_limits"))
    shrunk = F.array(*[(F.col(f"f{i}") + F.col(f"m{i}") * F.col(f"w{i}")) / (F.col("host_docs") + F.col(f"w{i}")) for i in k])
    # the prior is one row by construction
    out = hosts.join(F.broadcast(prior)).select("host", "host_docs", shrunk.alias("host_rates"), "host_limits")
    return out.withColumn("host_failed", F.exists(F.arrays_zip("host_rates", "host_limits"), lambda x: x["host_rates"] > x["host_limits"]))


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", min_words: int = 50, least_limit: float = 0.2, most_limit: float = 0.5, spreads: float = 3.0) -> DataFrame:
    """One row a document: doc_id, host, the counts, fails, base_failed, the host's verdict, kept."""
    rows, i, h, t = numbered(docs, id_col, host_col, text_col)
    rows = rows.select(rows[i].alias("doc_id"), rows[h].alias("host"), rows[t].alias("text"))
    rows = written(with_base(rows, "text", min_words).drop("text"))
    verdicts = written(host_verdicts(rows, least_limit, most_limit, spreads))
    out = spread_join(rows, verdicts, "host", "left")
    return out.withColumn("kept", ~F.col("base_failed") & ~F.coalesce("host_failed", F.lit(False)))


def quality_filter(docs: DataFrame, text_col: str = "text", host_col: str = "source", min_words: int = 50, least_limit: float = 0.2, most_limit: float = 0.5, spreads: float = 3.0) -> DataFrame:
    """The rows of docs that the rules keep, with the columns they had.

    One pass computes the rules and writes each row with its failures, the columns
    of rows that fail by themselves as null; hosts are summed from the table.
    """
    rows, h, t = numbered(docs, host_col, text_col)
    names = rows.columns
    judged = with_base(rows, t, min_words)
    judged = judged.select(*[F.when(~F.col("base_failed"), F.col(c)).alias(c) for c in names], F.col(h).alias("host"), "fails", "base_failed")
    judged = written(judged)
    bad = written(host_verdicts(judged, least_limit, most_limit, spreads).where("host_failed").select("host", "host_failed"))
    kept = spread_join(judged.where(~F.col("base_failed")).select(*names, "host"), bad, "host", "left").where("host_failed IS NULL")
    return kept.select(*names).toDF(*docs.columns)

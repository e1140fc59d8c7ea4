"""Model calls as a plug-in: a function from a batch of prompts to JSON objects, run over prompt rows in Arrow batches."""

from __future__ import annotations

import json
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.kernels import extract_json

Model = Callable[[list[str]], list[str]]


def canned(replies: dict[str, object], default: object | None = None) -> Model:
    """A stub model: the reply of the first marker that a prompt holds."""

    def run(prompts: list[str]) -> list[str]:
        return [json.dumps(next((v for k, v in replies.items() if k in p), default)) for p in prompts]

    return run


def generate_json(prompts: DataFrame, model: Model, prompt: str = "prompt", reply: str = "reply") -> DataFrame:
    """prompts with the reply's JSON object as text, asked once more where it wasn't one, else null.

    Distinct prompts are asked once each; rows that share one are joined back.
    """
    asked = prompts.select(F.col(prompt).alias("_q")).where("_q IS NOT NULL").distinct()

    def run(batches):
        for batch in batches:
            texts = batch["_q"].to_pylist()
            out = [extract_json(x or "") for x in model(texts)]
            again = [i for i, x in enumerate(out) if x is None]
            if again:
                for i, x in zip(again, model([texts[i] for i in again]), strict=True):
                    out[i] = extract_json(x or "")
            yield pa.RecordBatch.from_arrays([batch["_q"], pa.array([None if x is None else json.dumps(x, sort_keys=True) for x in out], pa.string())], ["_q", reply])

    return prompts.join(asked.mapInArrow(run, f"_q string, {reply} string"), F.col(prompt) == F.col("_q"), "left").drop("_q")


def reply_spans(replies: DataFrame, reply: str = "reply") -> DataFrame:
    """(episode, idx, text, start, end) of replies {"spans": [{"index"?, "text", "start", "end"}]}.

    The index defaults to the place in the list; of one index the first entry wins; ends before starts are swapped.
    """
    entry = "struct<index:bigint,text:string,start:double,end:double>"
    rows = replies.select("episode", F.posexplode(F.from_json(reply, f"struct<spans:array<{entry}>>")["spans"]).alias("at", "s")).where("s.start IS NOT NULL AND s.end IS NOT NULL")
    one = rows.groupBy("episode", F.coalesce("s.index", F.col("at").cast("long")).alias("idx")).agg(F.min_by("s", "at").alias("s"))
    return one.select("episode", "idx", F.trim("s.text").alias("text"), F.least("s.start", "s.end").alias("start"), F.greatest("s.start", "s.end").alias("end"))

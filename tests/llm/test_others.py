import random
import re
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from spanwright.llm import textbytes as tb
from spanwright.llm.chat import as_events, chat_format, escape, read_turns, unescape
from spanwright.llm.decontaminate import clean_rows, decontaminate
from spanwright.llm.mixing import mix_sources
from spanwright.llm.quality import quality_filter, quality_rules
from spanwright.llm.tokens import token_counts
from spanwright.llm.toxicity import Model, fit_texts, fit_toxicity, held_out, score_toxicity

from . import helpers as H


def alnum(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", H.lower(text))


def test_decontaminate_is_brute_force(spark):
    texts = H.sample(7)
    items = [(1, texts[20][1]), (2, "One, TWO"), (3, None), (4, "..."), (None, "a a a"), (2, " ".join(alnum(texts[30][1])[3:15])), (50, "naïve 日本語")]
    docs = [*texts, (2000, "x one;two y"), (2001, "one  two"), (2002, "none two"), (2003, "NAÏVE"), (2004, "se naïve\n日本語!")]
    windows = {}
    for i, t in items:
        w = alnum(t)
        if i is not None and w:
            for k in range(max(1, len(w) - 9)):
                windows.setdefault(tuple(w[k : k + 10]), set()).add(str(i))
    want = {}
    for i, t in docs:
        w, hit, found = alnum(t), set(), set()
        for key, ids in windows.items():
            for k in range(len(w) - len(key) + 1):
                if tuple(w[k : k + len(key)]) == key:
                    hit |= set(range(k, k + len(key)))
                    found |= ids
        want[i] = (len(w), len(hit), sorted(found))
    bench = spark.createDataFrame(items, "item_id long, text string")
    for size in (4 << 20, 40):  # one shard, several shards
        out = decontaminate(H.docs(spark, docs), bench, shard_bytes=size).collect()
        assert {r.doc_id: (r.n_words, r.n_hit, r["items"]) for r in out} == want
        assert all(sum(s.words for s in r.hit_spans) == r.n_hit for r in out)
    kept = clean_rows(H.docs(spark, docs), bench)
    assert {r.doc_id for r in kept.collect()} == {i for i, x in want.items() if not x[1]}
    assert decontaminate(H.docs(spark, docs), bench.limit(0)).where("n_hit > 0").count() == 0
    assert decontaminate(H.docs(spark, []), bench).count() == 0


def quality_of(text):
    w = H.split(text)
    grams = [tuple(w[k : k + 3]) for k in range(len(w) - 2)]
    times = Counter(grams)
    rep = {k + j for k, g in enumerate(grams) if times[g] > 1 for j in range(3)}
    lines = [x for x in (text or "").split("\n") if x.encode().split()]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(lines), len(rep))


def judged(texts):
    """{id: (counts, base_failed, kept)} with hosts s0, s1, s2 by id."""
    counts, hosts, out = {i: quality_of(t) for i, t in texts}, {}, {}
    fails = {i: (n < 50, 100 * r > 50 * n, 10 * s > n, c < 3 * n or c > 10 * n, 10 * d > 3 * k) for i, (n, c, s, d, k, r) in counts.items()}
    for i, _ in texts:
        hosts.setdefault((i or 0) % 3, []).append(fails[i])
    bad = set()
    for rule in range(5):
        rate = {h: sum(f[rule] for f in x) / len(x) for h, x in hosts.items()}
        m = sum(rate.values()) / len(rate)
        v = sum((x - m) ** 2 for x in rate.values()) / len(rate)
        w = 1000.0 if v < 1e-12 else min(1000.0, max(1.0, m * (1 - m) / v - 1))
        limit = min(0.5, max(0.2, m + 3 * (m * (1 - m) / (w + 1)) ** 0.5))
        bad |= {h for h, x in hosts.items() if (rate[h] * len(x) + m * w) / (len(x) + w) > limit}
    for i, _ in texts:
        base = fails[i][0] or fails[i][1]
        out[i] = (counts[i], base, not base and (i or 0) % 3 not in bad)
    return out, bad


def test_quality_is_brute_force(spark):
    texts = H.sample(9) + [(3000, "# <b> | & %\x0b$ *" * 3), (3001, "a b c a b c x")]
    texts += [(6000 + 3 * k, " ".join(f"w{k}x{j}" for j in range(60))) for k in range(300)]
    table = H.docs(spark, texts)
    rows = {r.doc_id: r for r in quality_rules(table).collect()}
    want, bad = judged(texts)
    assert {i: ((r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_lines, r.n_repeat_words), r.base_failed, r.kept) for i, r in rows.items()} == want
    assert 0 < len(bad) < 3
    out = quality_filter(table.withColumnsRenamed({"p": "a.b", "block": "_quality_n_words", "label": "host"}))
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "a.b", "_quality_n_words", "host"]
    assert {r.doc_id: r["_quality_n_words"] for r in out.collect()} == {i: 8 for i, x in want.items() if x[2]}
    assert quality_rules(H.docs(spark, [])).count() == 0 == quality_filter(H.docs(spark, [])).count()


def test_quality_judges_hosts(spark):
    good = " ".join(f"word{k}" for k in range(60))
    noisy = " ".join(f"w{k}##" for k in range(60))  # fails no rule that drops a document by itself
    rows = [(i, good if i % 10 == 0 else "bad", "en", "spam", 0, 0, 0, "") for i in range(200)] + [(1000 + i, good, "en", "fine", 0, 0, 0, "") for i in range(200)] + [(5000, good, "en", None, 0, 0, 0, "")]
    rows += [(2000 + i, noisy if i % 10 else good, "en", "noise", 0, 0, 0, "") for i in range(200)] + [(10000 + 10 * h + i, good, "en", f"h{h}", 0, 0, 0, "") for h in range(30) for i in range(10)]
    out = {r.doc_id for r in quality_filter(spark.createDataFrame(rows, H.SCHEMA)).collect()}
    assert out == {1000 + i for i in range(200)} | {5000} | {10000 + 10 * h + i for h in range(30) for i in range(10)}


def test_mixing_weights_and_order(spark):
    rows = [(i, "t", "en", "big" if i % 10 else "small", 100, 0, 0, "") for i in range(4000)] + [(9000, "t", "en", None, 100, 0, 0, ""), (None, "t", "en", "big", None, 0, 0, "")]
    table = spark.createDataFrame(rows, H.SCHEMA).where("source IS NOT NULL OR doc_id IS NULL")
    out = mix_sources(table, weights={"big": 0.5, "small": 0.5}).select("doc_id", "source", "copy", "mix_key").collect()
    n = {s: sum(1 for r in out if r.source == s) for s in ("big", "small")}
    assert abs(n["big"] - 2000) < 200 and abs(n["small"] - 2000) < 200
    assert [r.mix_key for r in out] == sorted(r.mix_key for r in out)
    again = mix_sources(table.repartition(7), weights={"big": 0.5, "small": 0.5}).select("doc_id", "source", "copy", "mix_key").collect()
    assert sorted(map(str, out)) == sorted(map(str, again))
    assert mix_sources(table, weights={"big": 1.0}).where("source = 'small'").count() == 0
    few = mix_sources(spark.createDataFrame(rows, H.SCHEMA)).where("source IS NULL").agg(F.count("*")).first()[0]
    assert 1100 < few < 1600  # one document of a third of the weight: a mean far above a table's step
    assert mix_sources(table.limit(0)).count() == 0
    odd = mix_sources(table.withColumnsRenamed({"p": "copy", "block": "Mix_Key", "lang": "a.b"}))
    assert odd.columns == [*["doc_id", "text", "a.b", "source", "n_chars", "copy", "Mix_Key", "label"], "copy_", "mix_key_"] and odd.where("copy = 0").count() == odd.count() > 0
    spread = mix_sources(table, weights={"big": 0.5, "small": 0.5}, broadcast_rows=0).select("doc_id", "source", "copy", "mix_key").collect()
    assert sorted(map(str, out)) == sorted(map(str, spread))


def test_chat_escapes_are_reversible(spark):
    r = random.Random(4)
    bits = ["\\", "|", "<", ">", "\n", "n", "<|im_end|>", "<|im_start|>", "a", "\\n", "é"]
    texts = ["".join(r.choice(bits) for _ in range(r.randint(0, 12))) for _ in range(500)]
    out = spark.createDataFrame([(t,) for t in texts], "t string").select("t", unescape(escape(F.col("t"))).alias("a"), unescape(escape(F.col("t"), True), True).alias("b"), escape(F.col("t")).alias("e"))
    for x in out.collect():
        assert x.a == x.t == x.b and "<|" not in x.e


def test_chat_folds_events(spark):
    log = [
        ("c", 0, 0, "message", "user", "hi <|im_end|>"), ("c", 1, 1, "message", "assistant", ""), ("c", 1, 2, "delta", None, "wro"), ("c", 1, 3, "delta", None, "ng"),
        ("c", 1, 4, "regenerate", None, None), ("c", 1, 5, "delta", None, "rig"), ("c", 1, 6, "delta", None, "ht"), ("c", 0, 7, "edit", None, "hello"),
        ("d", 0, 0, "delta", "user\n", "x"), (None, 0, 0, "message", None, None),
    ]
    events = spark.createDataFrame(log, "conv_id string, turn int, seq int, kind string, role string, text string").repartition(5)
    out = {r.conv_id: r for r in chat_format(events, seq="seq", kind="kind").withColumn("turns", read_turns(F.col("formatted"))).collect()}
    assert [(t.role, t.text) for t in out["c"].turns] == [("user", "hello"), ("assistant", "right")]
    assert [(t.role, t.text) for t in out["d"].turns] == [("user\n", "x")]
    assert [(t.role, t.text) for t in out[None].turns] == [("", "")]
    assert [s.piece for s in out["c"].segments if s.loss] == ["right"]
    assert "".join(s.piece for s in out["c"].segments) == out["c"].formatted
    assert chat_format(events.limit(0), seq="seq", kind="kind").count() == 0


def test_chat_ties_and_repeats(spark):
    log = [("c", 0, 0, "delta", None, "b"), ("c", 0, 0, "message", "user", "a"), ("c", 0, 1, "other", "x", "y"), ("c", 1, 5, "message", "u", "1"), ("c", 1, 5, "message", "u", "1"), ("c", 2, 0, "edit", "late", "e"), ("c", 2, 1, "message", "m", "n"), ("c", 2, 2, "regenerate", None, "zzz")]
    events = spark.createDataFrame(log, "conv_id string, turn int, seq int, kind string, role string, text string").withColumn("rank", F.lit(9)).withColumn("a.b", F.lit(1))
    row = chat_format(events, seq="seq", kind="kind").withColumn("turns", read_turns(F.col("formatted"))).first()
    assert [(t.role, t.text) for t in row.turns] == [("user", "ab"), ("u", "1"), ("u", "1"), ("late", "")]


def test_chat_log_folds_back_to_its_rows(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "a longer answer"), (1, 1, "assistant", "a longer answer"), (1, 1, "assistant", None), (1, 2, None, ""), (2, 0, "assistant", "x"), (2, 1, "system", "é\n")]
    table = spark.createDataFrame(rows, "conv_id int, turn int, role string, text string")
    out = chat_format(as_events(table.repartition(3)), turn=["turn", "nth"], seq="seq", kind="kind").withColumn("turns", read_turns(F.col("formatted")))
    got = {r.conv_id: [(t.role, t.text) for t in r.turns] for r in out.collect()}
    want = {c: [(r or "", t or "") for _, r, t in sorted(((n, r or "", t or "") for d, n, r, t in rows if d == c))] for c in (1, 2)}
    assert got == want


def test_tokens_are_the_librarys(spark):
    P = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    texts = [*H.sample(11), (4000, "it's <|endoftext|> I'LL ſ İΣ"), (4001, "don't\xa0stop é 123")]
    got = {r.doc_id: (r.n_bytes, r.n_tokens) for r in token_counts(H.docs(spark, texts), P.path("word_bpe_49k.json"), table_size=20, cache_size=10).collect()}
    assert got == {i: (len((x or "").encode()), len(t.encode(x or "", add_special_tokens=False).ids)) for i, x in texts}
    assert token_counts(H.docs(spark, []), P.path("word_bpe_49k.json")).count() == 0


def test_toxicity_learns_held_out(spark):
    r = random.Random(6)
    plain, rude = [f"word{k}" for k in range(200)], ["vileness", "loathsome", "wretchling"]
    texts, labels = [], []
    for i in range(600):
        toxic = i % 4 == 0
        w = [r.choice(plain) for _ in range(r.randint(20, 120))]
        for _ in range(3 * toxic):
            w[r.randrange(len(w))] = r.choice(rude)
        texts.append((i, " ".join(w)))
        labels.append((i, int(toxic)))
    table = H.docs(spark, [*texts, (7000, None), (7001, "")])
    model = fit_toxicity(table, spark.createDataFrame([*labels, (None, 1), (7000, None)], "doc_id long, toxic int"))
    rows = {x.doc_id: x for x in score_toxicity(table, model).select("*", held_out(F.col("doc_id")).alias("h")).collect()}
    held = [(rows[i].score >= 0.5, bool(t)) for i, t in labels if rows[i].h]
    assert len(held) > 80 and sum(a == b for a, b in held) / len(held) > 0.95
    assert 0 <= rows[7000].score < 0.5 and rows[7000].n_windows == 0 == rows[7001].n_windows
    assert fit_texts([], []).rate == 0 and fit_texts(["a"], [1]).score(__import__("numpy").zeros((1, 13)))[0] == 1
    assert score_toxicity(H.docs(spark, []), Model()).count() == 0


def test_packed_integers_round_trip():
    import numpy as np

    r = np.random.default_rng(1)
    for n in (0, 1, 1000):
        x = r.integers(0, 1 << 63, n, dtype=np.uint64)
        assert (tb.unpack(tb.pack(x)) == x).all() and (tb.unpack_sorted(tb.pack_sorted(np.sort(x))) == np.sort(x)).all()
    assert [b.num_rows for b in tb.slices(pa.RecordBatch.from_pydict({"t": ["a" * 50, None, "b" * 500, "c"]}), "t", 100)] == [2, 1, 1]


def test_pipeline_is_brute_force(spark, tmp_path):
    pipeline = pytest.importorskip("corpus_pipeline")
    texts = H.sample(13)
    H.docs(spark, texts).select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"{tmp_path}/documents.parquet")
    item = " ".join(alnum(texts[30][1])[:12])
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    own = {i: t for i, t in texts}
    want = []
    want.append({i: own[i] for i, x in judged(texts)[0].items() if x[2]})
    cut = H.lines_removed(list(want[-1].items()), words=50)
    want.append({i: x[3] for i, x in cut.items() if x[1] < x[0]})
    near = H.near(list(want[-1].items()), 5, 80)
    want.append({i: t for i, t in want[-1].items() if near[i][1] == i})
    windows = {tuple(alnum(item)[k : k + 10]) for k in range(3)}
    want.append({i: t for i, t in want[-1].items() if not any(tuple(alnum(t)[k : k + 10]) in windows for k in range(len(alnum(t))))})
    for (name, stage), rows in zip(pipeline.STAGES[:-1], want, strict=True):
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns, name
        assert {r.doc_id: (r.text, r.n_chars) for r in out.collect()} == {i: (t, len(t)) for i, t in rows.items()}, name
        docs = pipeline.written(out)
    assert len(want[0]) > len(want[2]) > 5
    mixed = pipeline.run(spark, str(tmp_path))
    assert mixed.columns == [*docs.columns, "copy", "mix_key"]
    got = mixed.collect()
    assert got and {r.doc_id for r in got} <= set(want[-1]) and all(r.text == want[-1][r.doc_id] for r in got)
    again = mix_sources(docs).select("doc_id", "copy", "mix_key").collect()
    assert [(r.doc_id, r.copy, r.mix_key) for r in got] == [tuple(r) for r in again]


def test_pipeline_on_an_empty_table(spark, tmp_path):
    pipeline = pytest.importorskip("corpus_pipeline")
    H.docs(spark, []).select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, "a b")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert pipeline.run(spark, str(tmp_path)).count() == 0


def test_toxicity_on_held_out_documents():
    """Held-out AUC and recall on the 0.1 test tables, fitted as the query is."""
    import glob
    import zlib

    import numpy as np
    import pyarrow.parquet as pq

    from spanwright.llm.toxicity import Gains, features

    if not glob.glob("/root/testdata/sf0.1/labels.parquet"):
        pytest.skip("no test tables")
    label = {r["doc_id"]: r["toxic"] for r in pq.read_table("/root/testdata/sf0.1/labels.parquet").to_pylist() if r["toxic"] is not None}
    rows = [(r["doc_id"], r["text"]) for r in pq.read_table("/root/testdata/sf0.1/documents.parquet").to_pylist() if r["doc_id"] in label and r["text"]]
    held = lambda i: zlib.crc32(str(i).encode()) % 5 == 0
    train, test = [x for x in rows if not held(x[0])], [x for x in rows if held(x[0])]
    model = fit_texts([t for _, t in train], [label[i] for i, _ in train])
    gains, scores = Gains(model.base, model.toxic, model.window), []
    for i in range(0, len(test), 200):
        part = [t for _, t in test[i : i + 200]]
        scores.append(model.score(features(*gains(*tb.column_bytes(pa.array(part))), len(part), model.cuts)[0]))
    s, y = np.concatenate(scores), np.array([label[i] for i, _ in test])
    pairs = s[y == 1][:, None] - s[y == 0][None, :]
    assert ((pairs > 0) + 0.5 * (pairs == 0)).mean() > 0.88
    assert (s[y == 1] >= 0.5).mean() > 0.57 and (s[y == 0] >= 0.5).mean() < 0.03


def test_toxicity_fits_on_up_to_2000_and_6000_texts(spark, monkeypatch):
    from spanwright.llm import toxicity

    monkeypatch.setattr(toxicity, "fit_texts", lambda texts, toxic, window: (len(texts), sum(toxic)))
    docs = spark.range(11000).selectExpr("id AS doc_id", "concat('text ', id) AS text")
    labels = spark.range(11000).selectExpr("id AS doc_id", "CAST(id % 11 < 3 AS int) AS toxic")
    assert toxicity.fit_toxicity(docs, labels) == (8000, 2000)

import random

import numpy as np
import pyarrow as pa
import pytest

from spanwright.llm import suffix_dedup as sd
from spanwright.llm import textbytes as tb
from spanwright.llm.line_dedup import line_dedup, line_dedup_rows
from spanwright.llm.near_dedup import components, near_dedup, near_dedup_rows
from spanwright.llm.rounds import growth, spread_join
from spanwright.llm.substring_dedup import _distinct, substring_dedup
from spanwright.llm.suffix_dedup import Windows, suffix_dedup, suffix_order

from . import helpers as H


@pytest.mark.parametrize("seed", [1, 2])
def test_substring_dedup_is_brute_force(spark, seed):
    texts = H.sample(seed)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_text) for r in substring_dedup(H.docs(spark, texts)).collect()}
    assert got == H.words_removed(texts)
    assert sum(x[1] for x in got.values()) > 100


@pytest.mark.parametrize("checks", [1, 3])
def test_distinct_windows_with_their_rows(checks):
    """One sort gives each window's first row and each row's window, also where checks differ under one key."""
    rng = np.random.default_rng(checks)
    key, check = rng.integers(0, 50, 300).astype(np.uint64), rng.integers(0, checks, 300).astype(np.uint64)
    ids = np.sort(rng.integers(0, 100, 300))
    rows, several, which = _distinct(ids, key, check)
    same = lambda r: np.flatnonzero((key == key[r]) & (check == check[r]))
    assert rows.tolist() == [same(r)[0] for r in rows] and len(rows) == len(set(zip(key.tolist(), check.tolist(), strict=True)))
    assert several.tolist() == [len(set(ids[same(r)])) > 1 for r in rows]
    assert rows[which].tolist() == [same(r)[0] for r in range(300)]


@pytest.mark.parametrize("seed", [1, 2])
def test_suffix_dedup_is_brute_force(spark, seed):
    texts = H.sample(seed)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in suffix_dedup(H.docs(spark, texts)).collect()}
    assert got == H.bytes_removed(texts)


def test_suffix_dedup_spreads_busy_anchors(spark):
    texts = H.sample(3)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in suffix_dedup(H.docs(spark, texts), hot=1).collect()}
    assert got == H.bytes_removed(texts)


@pytest.mark.parametrize(("seed", "hot", "key_bits"), [(1, 4096, 64), (2, 4096, 64), (2, 1, 64), (1, 1, 2)])
def test_line_dedup_is_brute_force(spark, seed, hot, key_bits):
    """Also where every fingerprint counts as busy, and where many stretches share a key."""
    texts = H.sample(seed)
    got = {r.doc_id: (r.n_lines, r.n_removed, r.n_runs, r.kept_text) for r in line_dedup(H.docs(spark, texts), hot=hot, key_bits=key_bits).collect()}
    assert got == H.lines_removed(texts)
    assert sum(x[1] for x in got.values()) > 10


def test_equal_keys_are_told_apart_by_their_checks(spark):
    """With 2 bits of key, each key stands for far more than four windows."""
    texts = H.sample(5, 40)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_text) for r in substring_dedup(H.docs(spark, texts), key_bits=2).collect()}
    assert got == H.words_removed(texts)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in suffix_dedup(H.docs(spark, texts), key_bits=2).collect()}
    assert got == H.bytes_removed(texts)


def test_suffix_dedup_keeps_windows_whose_hashes_agree_in_35_bits(spark):
    """Two windows with one check and the same first 3 bits of key are still different."""
    text = np.random.default_rng(3).integers(97, 123, 1 << 20, np.uint8).tobytes().decode()
    at = np.arange(len(text) - 100)
    key, check = Windows(pa.table({"doc_id": pa.array([1], pa.int64()), "text": [text]}), 100, 48).keys(at, np.ones_like(at), 3)
    order = np.lexsort((check, key))
    i = int(np.flatnonzero((key[order][1:] == key[order][:-1]) & (check[order][1:] == check[order][:-1]))[0])
    a, b = (text[k : k + 100] for k in order[i : i + 2].tolist())
    assert a != b
    texts = [(1, a), (2, a), (3, b), (4, b), (5, "x" * 900), (6, None), (7, a + b), (8, "x" * 1200)]
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in suffix_dedup(H.docs(spark, texts)).collect()}
    assert got == H.bytes_removed(texts)


def test_suffix_dedup_of_rows_without_an_id(spark):
    """Such a row is a document of its own: an earlier start in it counts, other rows don't."""
    text = H.sample(6)[-3][1].encode("ascii", "ignore").decode()[:700]
    out = suffix_dedup(H.docs(spark, [(None, "x" * 900), (None, text + text), (None, text), (1, text), (2, "x" * 900), (None, "y" * 100), (None, None)])).collect()
    assert sorted((r.n_bytes, r.n_removed, r.n_spans) for r in out if r.doc_id is None) == sorted([(900, 899, 1), (2 * len(text), len(text), 1), (len(text), 0, 0), (100, 0, 0), (0, 0, 0)])
    assert {r.doc_id: r.n_removed for r in out if r.doc_id} == {1: 0, 2: 899}


def test_located_searches_a_run_to_its_end():
    keys, checks = np.array([3, 3, 3, 3, 3, 3, 7], np.uint64), np.array([1, 2, 3, 4, 5, 6, 1], np.uint32)
    found = tb.located(keys, checks, np.array([3, 3, 3, 7, 9, 0], np.uint64), np.array([6, 9, 1, 1, 1, 1], np.uint32))
    assert found.tolist() == [5, -1, 0, 6, -1, -1]


def test_bytes_that_are_not_utf8(spark):
    texts = spark.createDataFrame([(1, b"\xffA b\nc d\ne f"), (2, b"\xffA b\nc d\ne f")], "doc_id long, b binary").selectExpr("doc_id", "CAST(b AS string) AS text")
    got = {r.doc_id: (r.n_removed, bytes(r.k)) for r in line_dedup(texts).selectExpr("doc_id", "n_removed", "CAST(kept_text AS binary) AS k").collect()}
    assert got == {1: (0, b"\xffA b\nc d\ne f"), 2: (3, b"")}
    assert substring_dedup(texts, window=2).where("n_removed = 6").count() == 1


def test_messages_grow_with_the_input():
    """Messages of a round a byte of input: the same from 16 GB to 4 TB, then at most in proportion to keys."""
    def messages(size, keys_a_byte=0.25):
        g = growth(size)
        return size / ((4 << 20) * g) * size * keys_a_byte / ((1 << 21) * g)

    rate = [messages(x) / x for x in (32 << 30, 1 << 40, 4 << 40)]
    assert max(rate) < 1.01 * min(rate)
    assert messages(100 << 40) < (100 << 40) * 0.25 / 10


@pytest.mark.parametrize(("seed", "width", "percent"), [(1, 3, 85), (2, 5, 80), (3, 3, 60)])
def test_near_dedup_is_brute_force(spark, seed, width, percent):
    texts = H.sample(seed, 90)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_dedup(H.docs(spark, texts), shingle=width, percent=percent).collect()}
    assert got == {i: (n, c, i == c) for i, (n, c) in H.near(texts, width, percent).items()}


def test_near_dedup_dense_region_loses_no_link(spark):
    """More alike texts than a region's neighbours: chains of changes, so that not all pairs link."""
    r = random.Random(5)
    base, texts = [f"v{k}" for k in range(120)], []
    for i in range(70):
        base = list(base)
        base[r.randrange(120)] = f"n{i}"
        texts.append((i, " ".join(base)))
    want = H.near(texts, 3, 85)
    got = {x.doc_id: x.component_id for x in near_dedup(H.docs(spark, texts), shingle=3, percent=85, near=2).collect()}
    assert got == {i: c for i, (_, c) in want.items()}


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(1, 40)] + [(100, 101), (101, 100), (7, 7)], "a long, b long")
    for bound in (0, 1000):  # by stars, in one task
        got = {r.node: r.component for r in components(edges, bound).collect()}
        assert got == {**{i: 1 for i in range(1, 41)}, 100: 100, 101: 100}


@pytest.mark.parametrize("run", [substring_dedup, suffix_dedup, line_dedup, near_dedup])
def test_empty_table(spark, run):
    assert run(H.docs(spark, [])).count() == 0


@pytest.mark.parametrize("run", [substring_dedup, suffix_dedup, line_dedup, near_dedup])
def test_null_ids_and_repeated_rows(spark, run):
    long = " ".join(f"t{k}" for k in range(60)) + "\nl1\nl2\nl3\nl4"
    out = run(H.docs(spark, [(None, long), (None, long), (5, long), (5, long), (9, long)])).collect()
    assert len(out) == 5
    gone = {}
    for r in out:
        gone.setdefault(r.doc_id, set()).add(r["n_removed"] if "n_removed" in r else not r["kept"])
    assert gone[None] in ({0}, {False}) and gone[5] in ({0}, {False})
    assert gone[9] not in ({0}, {False})


def test_spread_join_is_a_join(spark):
    left = spark.createDataFrame([("a", i) for i in range(50)] + [("b", 1), ("c", 2), (None, 3)], "k string, v int")
    right = spark.createDataFrame([("a", "A"), ("b", "B")], "k string, w string")
    for how, n in (("inner", 51), ("left", 53)):
        out = spread_join(left, right, "k", how, parts=10)
        assert out.count() == n == left.join(right, "k", how).count() and out.columns == ["k", "v", "w"]


def test_filtering_forms_keep_columns(spark):
    texts = H.sample(4)
    table = H.docs(spark, texts).withColumnsRenamed({"p": "a.b", "block": "gone"})
    for fn in (line_dedup_rows, near_dedup_rows):
        out = fn(table)
        assert out.columns == table.columns
    near = {r.doc_id for r in near_dedup_rows(table).collect()}
    assert near == {i for i, (_, c) in H.near(texts, 5, 80).items() if i == c}
    kept = {r.doc_id: r.text for r in line_dedup_rows(table).collect()}
    want = {i: (None if t is None else w[3]) for (i, t), w in ((x, H.lines_removed(texts)[x[0]]) for x in texts) if w[1] == 0 or w[1] < w[0]}
    assert kept == want


def test_suffix_order_sorts_all_suffixes():
    r = random.Random(2)
    for _ in range(200):
        x = np.array([r.randint(1, 2) for _ in range(r.randint(0, 50))], np.int64)
        want = sorted(range(len(x)), key=lambda i: x[i:].tolist())
        assert np.argsort(suffix_order(x, 100), kind="stable").tolist() == want


def test_only_windows_that_may_repeat_are_sorted(monkeypatch):
    rng, sizes, order = np.random.default_rng(5), [], sd.suffix_order
    monkeypatch.setattr(sd, "suffix_order", lambda text, *a: sizes.append(len(text)) or order(text, *a))
    text = np.append(rng.integers(0, 256, 20_000, dtype=np.uint8), np.zeros(8, np.uint8))
    text[15_000:15_130] = text[3_000:3_130]
    at = np.arange(20_000 - 99)
    assert np.flatnonzero(sd.later_windows(text, at, np.zeros_like(at), at, 100)).tolist() == list(range(15_000, 15_031))
    assert sizes[0] == 260


@pytest.mark.parametrize("seed", [1, 2])
def test_line_dedup_takes_long_lines_and_pairs(spark, seed):
    """With words, each stretch of three lines, or of fewer lines with over 50 words, stays at its first place only."""
    r = random.Random(seed)
    say = lambda k: " ".join(f"w{r.randrange(900)}" for _ in range(k))
    line, pair, short = say(51), [say(26), say(25)], say(50)
    texts = [(1, f"{line}\n{short}"), (2, line), (3, "\n".join([say(4), *pair, say(4)])), (4, "\n".join(["", *pair, short])), (5, "\n".join([pair[0], say(3), pair[1]])), (6, None), *[(i + 7, t) for i, t in H.sample(seed)]]
    seen, want = set(), {}
    for i, t in texts:
        raw = (t or "").split("\n")
        said = [(k, x.strip(" \t\n\r\x0b\x0c")) for k, x in enumerate(raw) if x.encode().split()]
        lost = set()
        for width in (1, 2, 3):
            for k in range(len(said) - width + 1):
                key = tuple(x for _, x in said[k : k + width])
                if width == 3 or sum(len(x.encode().split()) for x in key) > 50:
                    if key in seen:
                        lost |= {n for n, _ in said[k : k + width]}
                    seen.add(key)
        want[i] = (len(said), len(lost), "\n".join(x for k, x in enumerate(raw) if k not in lost))
    got = {x.doc_id: (x.n_lines, x.n_removed, x.kept_text) for x in line_dedup(H.docs(spark, texts), words=50).collect()}
    assert got == want
    assert want[2][1] == 1 and want[4][1] == 2 and want[5][1] == 0


def test_pipeline_takes_long_lines_out(spark, tmp_path):
    import corpus_pipeline

    long = " ".join(f"w{k}" for k in range(51))
    out = corpus_pipeline.lines(spark, H.docs(spark, [(1, long), (2, f"{long}\nown words"), (3, long)]), str(tmp_path))
    assert {r.doc_id: r.text for r in out.collect()} == {1: long, 2: "own words"}


@pytest.mark.parametrize("limit", [0.8, 0.85])
def test_passed_over_pairs_are_as_rare_as_said(limit):
    from math import comb

    from spanwright.llm.near_dedup import _least_alike

    below = lambda m: sum(comb(144, k) * limit**k * (1 - limit) ** (144 - k) for k in range(m))
    least = _least_alike(144, limit)
    assert below(least) <= 3e-7 < below(least + 1)


def test_open_regions_are_kept_one_row_a_document(spark, monkeypatch):
    """No table of members has a row for each tree in which a document's region is open."""
    from spanwright.llm import near_dedup as nd

    r, texts, tables = random.Random(7), [], []
    base = [f"v{k}" for k in range(120)]
    for i in range(60):
        own = list(base)
        for k in r.sample(range(120), 4):
            own[k] = f"n{i}x{k}"
        texts.append((i, " ".join(own)))
    written = nd.written
    monkeypatch.setattr(nd, "written", lambda df: tables.append(written(df)) or tables[-1])
    monkeypatch.setattr(nd, "dropped", lambda *_: None)
    got = {x.doc_id: x.component_id for x in nd.near_dedup(H.docs(spark, texts), shingle=3, percent=85, near=2).collect()}
    assert got == {i: c for i, (_, c) in H.near(texts, 3, 85).items()}
    held = [t.count() for t in tables if "member" in t.columns]
    assert max(held) > 0 and max(held) <= len(texts)


def test_open_is_told_by_labels(spark):
    from spanwright.llm.near_dedup import _open

    r = random.Random(3)
    rows = [(i % 5, i - 20, r.choice([-(1 << 63), -7, 0, 9]), r.sample([-9, -1, 3, 4, 1 << 62, (1 << 63) - 1, -(1 << 63), 50 + i], 3)) for i in range(40)]
    rows += [(1, 100, 5, [77]), (2, 101, 5, [77])]
    labels = {}
    for _, _, label, regions in rows:
        for x in regions:
            labels.setdefault(x, set()).add(label)
    want = {m: (p, label, sorted(x for x in regions if len(labels[x]) > 1)) for p, m, label, regions in rows}
    got = _open(spark.createDataFrame(rows, "p int, member long, label long, regions array<bigint>"), 3).collect()
    assert {x.member: (x.p, x.label, sorted(x.regions)) for x in got} == {m: v for m, v in want.items() if v[2]}
    assert not {100, 101} & {x.member for x in got}

"""Nearest neighbours, chat turns, URL filter and the pipeline."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from railmart.llm import chat_turns, common, mixing, one_bit_ann, queries, url_filter

import brute


def exact(rows, queries_, k):
    out = {}
    for q, v in queries_:
        near = sorted((float(np.sqrt(((np.array(w) - np.array(v)) ** 2).sum())), i) for i, w in rows if i != q and len(w) == len(v))[:k]
        out[q] = [(i, s) for s, i in near]
    return out


def test_nearest_neighbours(spark):
    rng = np.random.default_rng(9)
    rows = [(i, rng.standard_normal(24).round(3).tolist()) for i in range(1_500)] + [(2_000 + i, [1.0] * 24) for i in range(30)]
    rows += [(3_000 + i, rng.standard_normal(5).tolist()) for i in range(4)]
    odd = [(5_000, None), (5_001, [0.0] * 24), (5_002, [float("nan")] * 24), (5_003, [None] * 24), (5_004, [float("inf")] * 24), (None, [1.0] * 24), (5_005, [])]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows + odd], "id long, v array<double>, code string")
    usable = one_bit_ann.usable(df)
    assert usable.count() == len(rows)
    index, centres = one_bit_ann.indexed(usable)
    asked = usable.filter(F.col("id") % 50 == 0)
    got = {}
    for r in one_bit_ann.nearest(index, centres, asked).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    want = exact(rows, [(r["id"], r["v"]) for r in asked.collect()], 10)
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert got.keys() == want.keys() and hits >= 0.97 * sum(map(len, want.values()))
    assert got[2_000] == want[2_000] and len(got[3_000]) == 3
    none = usable.filter("false")
    index, centres = one_bit_ann.indexed(none)
    assert one_bit_ann.nearest(index, centres, none).count() == 0


def test_repeated_query_rows(spark):
    rng = np.random.default_rng(13)
    rows = [(i, rng.standard_normal(8).round(3).tolist()) for i in range(300)]
    index, centres = one_bit_ann.indexed(spark.createDataFrame(rows, "id long, v array<double>"))
    other = rows[9][1]
    twice = spark.createDataFrame([rows[5]] * 3 + [rows[6], (6, other)], "id long, v array<double>")
    for asked in (twice, twice.repartition(5)):
        got = sorted((r["query_id"], r["rank"], r["vec_id"]) for r in one_bit_ann.nearest(index, centres, asked).collect())
        one = [[i for i, _ in exact(rows, [q], 10)[q[0]]] for q in (rows[5], rows[6], (6, other))]
        assert got == sorted((q, k + 1, i) for q, ids in zip((5, 6, 6), one) for k, i in enumerate(ids))


def test_parts_meet_groups(spark, monkeypatch):
    """Queries in several groups, vectors in several parts, both in the floats they came as; equal vectors and repeated ids among them."""
    monkeypatch.setattr(one_bit_ann, "HELD", 8_000)
    monkeypatch.setattr(one_bit_ann, "BLOCK", 100)
    monkeypatch.setattr(one_bit_ann, "PAIRS", 10_000)
    rng = np.random.default_rng(17)
    values = rng.standard_normal((2_400, 20)).astype(np.float32)
    values[300:340] = values[300]
    rows = [(i % 2_300, v.tolist()) for i, v in enumerate(values)]
    index, centres = one_bit_ann.indexed(one_bit_ann.usable(spark.createDataFrame(rows, "id long, v array<float>")))
    assert {r[0] for r in index.selectExpr("length(v)").distinct().collect()} == {80}
    asked = rows[:360]
    got = {}
    for r in one_bit_ann.nearest(index, centres, spark.createDataFrame(asked, "id long, v array<float>")).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    want = exact(rows, asked, 10)
    hits = sum(len(set(got[q]) & set(want[q])) for q in want)
    assert got.keys() == want.keys() and all(len(x) == 10 for x in got.values()) and hits >= 0.98 * 10 * len(want)
    assert got[305] == want[305]


@pytest.mark.parametrize("kind, scale", [(np.float32, 1.0), (np.float32, 1e15), (np.float64, 1.0), (np.float64, 1e-30)])
def test_batches_give_the_nearest(kind, scale):
    rng = np.random.default_rng(18)
    v = (rng.standard_normal((3_000, 48)) * scale).astype(kind)
    v[1_000:1_020], ids = v[7], rng.permutation(3_000)
    held = one_bit_ann.Held(ids[:700], ids[:700], v[:700], 10)
    centre = v[rng.permutation(3_000)[:5]].astype(np.float64)
    for at in range(0, 3_000, 600):
        held.meet(ids[at : at + 600], v[at : at + 600], *one_bit_ann.coded(v[at : at + 600].astype(np.float64), centre), centre)
    hits = 0
    for q in range(0, 700, 7):
        far = np.sqrt(((v.astype(np.float64) - v[q].astype(np.float64)) ** 2).sum(axis=1))
        far[q] = np.inf
        order = np.lexsort((ids, far))[:10]
        hits += len({*zip(ids[order], far[order])} & {*zip(held.near[q], held.score[q])})
    assert hits >= 0.99 * 1_000


def test_bounds_hold():
    rng = np.random.default_rng(10)
    rows, query = rng.standard_normal((400, 64)), rng.standard_normal((20, 64))
    centre = rows[:1] * 0.1
    _, code, length, inner = one_bit_ann.coded(rows, centre)
    middle, error = one_bit_ann.estimated(query, centre[0], code, length, inner)
    true = ((query[:, None] - rows[None]) ** 2).sum(axis=2)
    assert (np.abs(true - middle) <= error).mean() > 0.99 and np.corrcoef(true.ravel(), middle.ravel())[0, 1] > 0.8


@pytest.fixture(scope="module")
def talks(spark):
    return common.table(spark, "/root/testdata/sf0.01", "conversations")


def test_roles_on_held_out_conversations(talks):
    model = chat_turns.train(talks.filter(~common.held_out("conv_id")))
    truth = talks.filter(common.held_out("conv_id")).select("conv_id", "turn", F.col("role").alias("truth"))
    rows = chat_turns.parsed(talks.select("conv_id", "turn", "text"), model).filter("part = 0").join(truth, ["conv_id", "turn"]).collect()
    assert len(rows) == truth.count() and sum(r["role"] == r["truth"] for r in rows) >= 0.85 * len(rows)


def test_markers_split_a_transcript(spark, talks):
    model = chat_turns.train(talks)
    text = "System: be brief\nUser: what is this\nsome more of it\nAssistant: it is a test.\nUser: thanks"
    rows = chat_turns.parsed(spark.createDataFrame([(1, 0, text, 5)], "conv_id long, turn long, text string, part int"), model).orderBy("part").collect()
    assert [r["role"] for r in rows] == ["system", "user", "assistant", "user"]
    assert rows[1]["rendered"] == "<|user|>\nwhat is this\nsome more of it\n<|end|>"


def test_chunks_decode_as_one(talks, monkeypatch):
    model = chat_turns.train(talks)
    some = talks.filter("conv_id < 40")
    whole = sorted(map(tuple, chat_turns.parsed(some, model).collect()), key=repr)
    monkeypatch.setattr(chat_turns, "CHUNK", 2)
    assert sorted(map(tuple, chat_turns.parsed(some, model).collect()), key=repr) == whole


def test_odd_conversations(spark, monkeypatch):
    rows = [(1, None, "user", None), (1, 0, None, ""), (1, 0, None, ""), (None, 3, "other", "x?"), (2, 5, "user", "a\n" * 3_000)] + [(3, 1, "user", "same")] * 20
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    monkeypatch.setattr(chat_turns, "MOST_ROWS", 4)
    for train_on in (df, df.filter("false")):
        out = chat_turns.parsed(df, chat_turns.train(train_on)).collect()
        assert sum(r["part"] == 0 for r in out) == len(rows)
    assert chat_turns.parsed(df.filter("false"), chat_turns.train(df)).count() == 0


def test_crowded_turns_decode_in_order_of_text(spark, talks, monkeypatch):
    model = chat_turns.train(talks)
    texts = [r["text"] for r in talks.select("text").orderBy("conv_id", "turn").limit(300).collect()]
    rows = [(None, k % 3 or None, t) for k, t in enumerate(texts)] + [(7, 2, t) for t in texts[:90]] + [(7, 2, None), (7, 2, ""), (7, 2, texts[0]), (7, 3, "ok")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, text string")
    whole = sorted(map(tuple, chat_turns.parsed(df, model).collect()), key=repr)
    monkeypatch.setattr(chat_turns, "MOST_ROWS", 8)
    for parts in (1, 7):
        assert sorted(map(tuple, chat_turns.parsed(df.repartition(parts), model).collect()), key=repr) == whole
    cuts = chat_turns.chunked(df).groupBy("conv", "part", "at", "cut").agg(F.count("*").alias("n"), F.min("text").alias("lo"), F.max("text").alias("hi")).collect()
    assert max(r["n"] for r in cuts) <= 8
    cuts.sort(key=lambda r: (r["conv"] or 0, r["part"], r["at"], r["cut"]))
    assert all(a["hi"] <= b["lo"] for a, b in zip(cuts, cuts[1:]) if (a["conv"], a["part"], a["at"]) == (b["conv"], b["part"], b["at"]) and a["hi"])


def test_urls(spark):
    urls = [
        ("http://www.Example.COM/en/a?x=/b", "www.example.com", "/en/a", "www.example.com/en/"), ("https://m.example.com/en/a", "m.example.com", "/en/a", "example.com/en/"),
        ("http://badexample.com/en/", "badexample.com", "/en/", "com/"), ("http://a.net/es/1#t", "a.net", "/es/1", "net/es/"), ("http://a.net/de/", "a.net", "/de/", None),
        ("http://net/fr/", "net", "/fr/", "net/fr/"), ("http://x.com", "x.com", "", None), ("no scheme", "", "", None), (None, "", "", None), ("://", "", "", None),
        ("http://casino-win.example.org/en/2", "casino-win.example.org", "/en/2", None), ("http://thorin.example.org/en/3", "thorin.example.org", "/en/3", None),
        ("http://Ä.com/\n", "Ä.com", "/\n", "com/"), ("http://u.org://v.com/x", "u.org:", "//v.com/x", None),
    ]
    df = spark.createDataFrame([(k % 11, u[0], "h") for k, u in enumerate(urls)], "page_id long, url string, host string")
    got = sorted(map(tuple, url_filter.judged(df.select("page_id", "url")).collect()), key=repr)
    assert sorted([(r[1], r[2], r[3]) for r in got], key=repr) == sorted([u[1:] for u in urls], key=repr)
    says = {r[1]: r[4] for r in got}
    assert says["casino-win.example.org"] == "block" and says["thorin.example.org"] == says[""] == "allow"
    decided = {(r[1], r[2]): r[4] for r in got if r[3]}
    assert decided == {
        ("www.example.com", "/en/a"): "allow", ("m.example.com", "/en/a"): "block", ("badexample.com", "/en/"): "allow", ("a.net", "/es/1"): "block",
        ("net", "/fr/"): "block", ("Ä.com", "/\n"): "allow",
    }
    assert url_filter.judged(df.filter("false").select("page_id", "url")).count() == 0


def test_url_model_on_left_out_rows():
    labelled = url_filter.examples()
    parts = [(u.split("://")[1].split("/", 1), y) for u, y in labelled]
    right = 0
    for fold in range(6):
        on, off = [[p for k, p in enumerate(parts) if (k % 6 == fold) == held] for held in (False, True)]
        w, b = url_filter.train([p[0] for p, _ in on], ["/" + p[1] for p, _ in on], [y for _, y in on])
        z = url_filter.margins(url_filter.gram_rows([p[0] for p, _ in off], ["/" + p[1] for p, _ in off]), w, b)
        right += sum((z > 0) == [y == 1 for _, y in off])
    assert right >= 0.8 * len(parts)


def test_all_queries_are_named():
    assert {int(n[2:].split("_")[0]) for n in queries.QUERIES} == set(range(1, 14))


def test_stages_equal_plain_versions(spark):
    rng = random.Random(14)
    noise = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    base, passage = noise(150), noise(90)
    texts = [base, base + " end", base, passage + " " + noise(120), noise(130) + " " + passage + noise(9), "", None, "one two", "one two", noise(60)]
    rows = [(k, t, "en", "ab"[k % 2], len(t or "")) for k, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    groups, sizes = brute.groups(texts)
    want = [r for k, r in enumerate(rows) if not sizes[k] or k == min(groups[k])]
    left = common.stored(corpus_pipeline.one_of_each_group(spark, docs, ""), "test-one")
    assert sorted(map(tuple, left.collect()), key=repr) == sorted(want, key=repr)
    told = {r[0]: (r[2:4], w[3]) for r, w in zip(want, brute.without_repeats([r[1] for r in want], corpus_pipeline.REPEAT), strict=True)}
    assert any(hashlib.sha256((r[1] or "").encode()).hexdigest() != told[r[0]][1] for r in want)
    clean = common.stored(corpus_pipeline.without_repeats(spark, left, ""), "test-clean")
    got = clean.collect()
    assert len(got) == len(want) and {r["doc_id"]: ((r["lang"], r["source"]), hashlib.sha256((r["text"] or "").encode()).hexdigest()) for r in got} == told
    copies = {r["doc_id"]: r["copies"] for r in mixing.with_copies(clean.select("doc_id", "text", "source")).collect()}
    mix = sorted(map(tuple, corpus_pipeline.mixed(spark, clean, "").collect()), key=repr)
    assert mix == sorted((tuple(r) for r in got for _ in range(copies.get(r["doc_id"], 0))), key=repr)


def test_pipeline(spark, small_data):
    docs = common.table(spark, small_data, "documents")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "ngram_join", "suffix_dedup", "mixing", "packing"]
    out = corpus_pipeline.run(spark, small_data)
    assert out.count() > 0 and {"doc_id", "sequence_id", "offset", "ids"} <= set(out.columns)
    known = {r["doc_id"] for r in docs.select("doc_id").collect()}
    assert {r["doc_id"] for r in out.select("doc_id").distinct().collect()} < known


def test_repeated_passages_of_51_words_leave_the_corpus(spark):
    rng = random.Random(21)
    words = [f"{rng.choice('bcdfg')}{rng.choice('aeiou')}{k}" for k in range(4_000)]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    passages = [text(51) for _ in range(4)]
    assert all(corpus_pipeline.REPEAT <= len(p) < 400 for p in passages)
    rows = [(k, f"{text(70)} {passages[k % 4]} {text(60)}" if k < 24 else text(180), "en", "a", 1) for k in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    left = {r["doc_id"]: r["text"] for r in corpus_pipeline.without_repeats(spark, docs, "").collect()}
    assert all(passages[k % 4][20:-20] not in left[k] for k in range(24))
    assert all(left[k] == rows[k][1] for k in range(24, 40))

"""N-gram join, suffix dedup and induced sorting against plain versions."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from railmart.llm import induced, ngram_join, suffix_dedup

import brute


def texts_of(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def check_groups(df):
    rows = texts_of(df)
    groups, sizes = brute.groups([t for _, t in rows])
    want = [(rows[i][0], sizes[i], min((rows[j][0] for j in groups[i] if rows[j][0] is not None), default=None) if sizes[i] else rows[i][0]) for i in range(len(rows))]
    got = [(r["doc_id"], r["n_shingles"], r["component_id"]) for r in ngram_join.grouped(df).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_most_different_is_the_bound():
    for a in range(1, 40):
        for b in range(1, 40):
            most = max((a + b - 2 * i for i in range(min(a, b) + 1) if 100 * i >= 80 * (a + b - i)), default=-1)
            assert most == -1 and ngram_join.most_different(a, b) < abs(a - b) or ngram_join.most_different(a, b) >= most


def test_bit_sketch_distance_never_exceeds_the_symmetric_difference():
    rng = np.random.default_rng(3)
    for _ in range(50):
        pool = rng.integers(0, 2**63, 700).astype(np.uint64)
        a, b = (np.unique(rng.choice(pool, int(rng.integers(1, 600)))) for _ in range(2))
        bits = [np.frombuffer(ngram_join.bits_of(x), np.uint8) for x in (a, b)]
        assert ngram_join.near(*bits) <= len(np.setxor1d(a, b))


def test_groups_on_odd_rows(odd_docs, no_docs):
    check_groups(odd_docs)
    assert ngram_join.grouped(no_docs).count() == 0


def test_chains_near_copies_and_shared_passages(spark):
    rng, rows = random.Random(5), []
    words = [f"v{i}" for i in range(3_000)]
    for _ in range(12):
        text = [rng.choice(words) for _ in range(rng.choice([6, 20, 60, 200, 700]))]
        for _ in range(6):
            rows.append(" ".join(text))
            text = list(text)
            for _ in range(max(1, len(text) // 70)):
                text[rng.randrange(len(text))] = rng.choice(words)
    passage = " ".join(rng.choice(words) for _ in range(80))
    rows += [" ".join(rng.choice(words) for _ in range(60)) + " " + passage for _ in range(40)]
    check_groups(spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string"))


def test_crowded_words_keep_their_links(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "HOT_WORD", 5)
    monkeypatch.setattr(ngram_join, "BLOCK", 4)
    rng = random.Random(6)
    base, rows = [f"q{i}" for i in range(150)], []
    for _ in range(60):
        text = list(base)
        for _ in range(rng.choice([1, 2, 4])):
            text[rng.randrange(len(text))] = f"n{rng.random()}"
        rows.append(" ".join(text))
    check_groups(spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string"))


def test_crowded_words_link_copies_on_both_sides_of_a_band(spark, monkeypatch):
    """Sets of 110 shingles and more enter two bands; a crowd below them makes all words of the lower band hot."""
    monkeypatch.setattr(ngram_join, "HOT_WORD", 20)
    rng = random.Random(7)
    base, rows = [f"q{i}" for i in range(110)], []
    for _ in range(45):
        text = list(base)
        text[rng.randrange(110)] = f"n{rng.random()}"
        rows.append(" ".join(text))
    rows += [" ".join([*base, "u0", "u1", "u2", "u3", f"n{k}"]) for k in range(15)]
    sizes = [len(brute.shingles(t)) for t in rows]
    assert sum(n >= 110 for n in sizes) == 15 and min(sizes) > 91
    check_groups(spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string"))


def test_sure_words_are_equal_in_every_partner():
    rng = np.random.default_rng(12)
    for _ in range(60):
        size = int(rng.integers(9, 260))
        a = np.unique(rng.integers(0, 2**63, size).astype(np.uint64))
        b = np.unique(np.append(rng.permutation(a)[: size - int(rng.integers(0, size // 9 + 1))], rng.integers(0, 2**63, size // 9).astype(np.uint64)))
        if 100 * len(np.intersect1d(a, b)) < 80 * len(np.union1d(a, b)):
            continue
        (words, sure), (others, also) = ngram_join.words_of(a), ngram_join.words_of(b)
        equal = np.intersect1d(words, others)
        band = ngram_join.band_of(max(len(a), len(b))) & 1
        assert (equal & 1 == band).sum() >= max(sure[band], also[band])


def test_kept_leaves_one_of_each_group(odd_docs, no_docs):
    left = ngram_join.kept(odd_docs)
    assert left.columns == odd_docs.columns
    ids = sorted((r["doc_id"] for r in left.collect()), key=repr)
    assert ids == sorted([1, 4, 5, 6, 8, None, 10, 12], key=repr)
    assert ngram_join.kept(no_docs).count() == 0


@pytest.mark.parametrize("memory", [1 << 20, 64])
def test_suffix_order(memory):
    rng = np.random.default_rng(1)
    for trial in range(60):
        text = rng.integers(0, int(rng.integers(1, 5)), int(rng.integers(1, 90))).astype(np.uint8)
        text = np.tile(text[: max(1, len(text) // 4)], 5) if trial % 3 == 0 else text
        raw = bytes(text)
        order, prefix = induced.suffix_order(text, 256, 20, memory, reach=10**6)
        want = sorted(range(len(raw)), key=lambda i: raw[i:])
        assert order.tolist() == want
        for k in range(1, len(want)):
            a, b = raw[want[k - 1] :], raw[want[k] :]
            assert prefix[k] == next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b), 20)) or prefix[k] == 20


def check_repeats(df, length):
    rows = texts_of(df)
    want = sorted(((i, *w) for (i, _), w in zip(rows, brute.without_repeats([t for _, t in rows], length))), key=repr)
    out = suffix_dedup.without_repeats(df, length).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert sorted((tuple(r) for r in out.collect()), key=repr) == want


def test_repeats_on_odd_rows(odd_docs, no_docs):
    check_repeats(odd_docs, 400)
    assert suffix_dedup.without_repeats(no_docs).count() == 0


@pytest.mark.parametrize("shard, hot", [(suffix_dedup.SHARD, 0.001), (3_000, 0.02), (900, 1.0)])
def test_planted_repeats(spark, monkeypatch, shard, hot):
    """Small shards crowd the cores, so pieces are cut again; with hot shares of 0.02 and 1 some and no keys are broadcast."""
    monkeypatch.setattr(suffix_dedup, "SHARD", shard)
    monkeypatch.setattr(suffix_dedup, "HOT_SHARE", hot)
    rng, rows = random.Random(8), []
    noise = lambda n: "".join(rng.choice("abcdefgé \n") for _ in range(n))
    passages = [noise(rng.choice([399, 400, 401, 700, 1500])) for _ in range(6)]
    for k in range(50):
        rows.append(noise(rng.randrange(300)) + passages[k % 6] + noise(rng.randrange(500)) + (passages[(k * 5) % 6] if k % 3 else ""))
    rows += [passages[3], "ab" * 900, passages[4] * 2]
    check_repeats(spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string"), 400)


def test_cleaned_keeps_rows_and_columns(odd_docs):
    left = suffix_dedup.cleaned(odd_docs)
    assert left.columns == odd_docs.columns and left.count() == odd_docs.count()
    texts = {r["doc_id"]: (r["text"], r["n_chars"], r["key"]) for r in left.collect()}
    assert texts[4][0] is None and texts[1] == ("", 0, "x") and texts[2][1] is None and texts[8][1] > 100_000


def test_members_of_different_components_meet_once(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK", 3)
    rows = [(w, n, root) for w in (1, 2) for n, root in enumerate([5] * 11 + [20, 21, 21, 22, 23, 23, 23] if w == 1 else [5, 6])]
    cells = ngram_join.dealt(spark.createDataFrame(rows, "word long, node long, root long")).collect()
    met = [(a["word"], a["node"], b["node"]) for a in cells for b in cells
           if a["cell"] == b["cell"] and a["node"] < b["node"] and a["root"] != b["root"] and (a["side"] != b["side"] or a["side"] < 0)]
    want = [(w, m, n) for w, m, a in rows for v, n, b in rows if w == v and m < n and a != b]
    assert sorted(met) == sorted(want)


def test_a_dense_group_writes_spanning_links_only(spark):
    """Near copies around the threshold share many words; links within cells stay under the number of members."""
    rng = random.Random(9)
    base, rows = [f"q{i}" for i in range(120)], []
    for _ in range(150):
        text = list(base)
        for _ in range(rng.choice([1, 1, 2, 3])):
            text[rng.randrange(len(text))] = f"n{rng.random()}"
        rows.append(" ".join(text))
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    check_groups(docs)
    nodes = ngram_join.common.stored(ngram_join.sketched(docs), "test")
    facts = nodes.select("node", "n", "bits")
    met = ngram_join.meetings(nodes).select("word", "node").withColumn("root", F.col("node"))
    members = ngram_join.still_open(ngram_join.dealt(met), facts)
    once = ngram_join.still_open(members, facts, first_only=True)
    sets = ngram_join.sets_of(docs, nodes, nodes.select("node"))
    all_links, few_links = (ngram_join.joined_in_cells(m, sets).collect() for m in (members, once))
    assert once.count() < members.count() / 3
    for cells, links in ((members, all_links), (once, few_links)):
        assert len(links) < cells.count()
    sizes = [{r["root"]: r["n"] for r in ngram_join.components(spark.createDataFrame(x)).groupBy("root").agg(F.count("*").alias("n")).collect()} for x in (all_links, few_links)]
    assert sizes[0] == sizes[1]


def test_sorting_a_shard_takes_bounded_memory():
    import tracemalloc

    rng = np.random.default_rng(5)
    text = rng.integers(97, 117, 400_000).astype(np.uint8).tobytes()
    rows = [text[at : at + 430] for at in range(0, len(text) - 430, 290)]
    tracemalloc.start()
    try:
        flags = suffix_dedup.repeated_starts(rows, 120)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert all(f[:21].all() and f[290:].all() and not f[21:290].any() for f in flags[1:-1])
    assert peak < 37 * sum(map(len, rows))


@pytest.mark.parametrize("kind, symbols", [(np.uint8, 256), (np.uint8, 2), (np.int64, 3)])
def test_common_prefixes_up_to_a_bound_for_each_pair(kind, symbols):
    rng = np.random.default_rng(3)
    for n in (1, 2, 7, 8, 9, 20, 300):
        text = np.tile(rng.integers(0, symbols, max(1, n // 4)), 5)[:n].astype(kind)
        a, b = np.divmod(np.arange(len(text) ** 2)[:: max(1, n // 20)], len(text))
        a, b = a[a != b], b[a != b]
        raw, cap = text.tolist(), rng.integers(0, 70, len(a))
        plain = [next((k for k in range(c) if raw[i + k : i + k + 1] != raw[j + k : j + k + 1] or max(i, j) + k >= len(raw)), c) for i, j, c in zip(a, b, cap)]
        assert induced.common_prefix(text, a, b, cap).tolist() == plain
        assert induced.common_prefix(text, a, b, 70).tolist() >= plain


def test_sorting_compares_few_symbols_of_copies(monkeypatch):
    """Turns are named by their own symbols only, and suffixes that have no equals left are not sorted again."""
    text = np.tile(np.random.default_rng(4).integers(97, 117, 3_000).astype(np.uint8), 6)
    compared, sorted_rows, plain, argsort = [0], [0], induced.common_prefix, np.argsort

    def common_prefix(*args):
        found = plain(*args)
        compared[0] += int(found.sum())
        return found

    def counted(key, *args, **kwargs):
        sorted_rows[0] += len(key)
        return argsort(key, *args, **kwargs)

    monkeypatch.setattr(induced, "common_prefix", common_prefix)
    order, _ = induced.suffix_order(text, 256, 20)
    assert compared[0] < 12 * len(text)
    names = np.random.default_rng(6).integers(0, 5_000, 20_000)
    monkeypatch.setattr(np, "argsort", counted)
    monkeypatch.setattr(np, "lexsort", lambda keys: pytest.fail("all suffixes are sorted anew"))
    got = induced.doubled(names, 400).tolist()
    assert sorted_rows[0] < 3 * len(names)
    raw = names.tolist()
    assert got == sorted(range(len(raw)), key=lambda i: raw[i : i + 400])


def test_contexts_and_cuts_of_many_texts_at_once():
    """Texts that lie together have the contexts each has alone, and stretches of many texts leave in one batch."""
    rng = random.Random(2)
    texts = [bytes(rng.choices(b"abcde", k=n)) for n in (0, 39, 40, 41, 500, 3, 900, 40)]
    bounds = np.append(0, np.cumsum([len(t) for t in texts]))
    together = list(zip(*(c.tolist() for c in suffix_dedup.contexts(np.frombuffer(b"".join(texts), np.uint8), bounds, 40))))
    alone = []
    for k, t in enumerate(texts):
        found = suffix_dedup.contexts(np.frombuffer(t, np.uint8), np.array([0, len(t)]), 40)
        alone += [(k, *row) for _, *row in zip(*(c.tolist() for c in found))]
        assert sorted(s for _, _, _, lo, hi, _ in zip(*(c.tolist() for c in found)) for s in range(lo, hi + 1)) == list(range(len(t) - 39))
    assert together == alone
    want = [[{"anchor": k, "context": -k, "lo": 5 + k, "hi": 7 + k, "place": 1}] * (k % 3) for k in range(12)]
    columns = [pa.array([bytes([k]) for k in range(12)], pa.binary()), pa.array([bytes(range(60))] * 12, pa.binary()), pa.array([k for k in range(12)])]
    kind = pa.list_(pa.struct([(n, pa.int64()) for n in ("anchor", "context", "lo", "hi", "place")]))
    batch = pa.RecordBatch.from_arrays([*columns, pa.array(want, kind)], names=["key", "text", "at", "want"])
    got = list(suffix_dedup.cut_out(20)(iter([batch, batch.slice(4, 0), batch.slice(3, 3)])))
    rows = [(bytes([k]), bytes(range(5, 27))) for k in range(12) for _ in range(k % 3)]
    assert [(r["key"], r["data"]) for b in got for r in b.to_pylist()] == rows + [r for r in rows if 3 <= r[0][0] < 6]
    assert len(got) == 2

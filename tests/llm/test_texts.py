"""Mixing, toxicity, quality rules, packing and language identification."""

from __future__ import annotations

import struct
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from railmart.llm import common, language_id, mixing, packing, quality_rules, queries, toxicity

import brute


@pytest.fixture(scope="module")
def docs(spark):
    return common.table(spark, "/root/testdata/sf0.01", "documents")


@pytest.fixture(scope="module")
def labels(spark):
    return common.table(spark, "/root/testdata/sf0.01", "labels")


def test_mixing_equals_sql(spark, small_data):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{small_data}/documents.parquet'")
    want = con.sql(mixing.SQL)
    got = queries.QUERIES["op3_mixing"](spark, small_data).select(*want.columns)
    assert sorted(map(tuple, got.collect())) == sorted(want.fetchall())


def test_mixing_on_odd_rows(odd_docs, no_docs):
    taken = mixing.with_copies(odd_docs.select("doc_id", "text", "source")).collect()
    by = {}
    for r in taken:
        by.setdefault(r["source"], []).append(r)
        assert 0 <= r["copies"] <= 2
    total = sum(r["size"] for r in taken)
    assert abs(sum(rows[0]["target"] for rows in by.values()) - 1.5 * total) < 1e-6 * total
    assert all(rows[0]["target"] <= 2 * rows[0]["source_size"] + 1e-9 for rows in by.values())
    mix = mixing.mixed(odd_docs)
    assert mix.columns == odd_docs.columns and mix.count() == sum(r["copies"] for r in taken)
    assert mixing.mixed(no_docs).count() == 0


def test_shares_come_near_their_targets(docs):
    taken = mixing.with_copies(docs.select("doc_id", "text", "source"))
    sums = taken.groupBy("source").agg(F.sum(F.col("copies") * F.col("size")).alias("n"), F.first("target").alias("t")).collect()
    assert abs(sum(r["n"] for r in sums) / sum(r["t"] for r in sums) - 1) < 0.05


def test_toxicity_on_held_out_labels(docs, labels):
    model = toxicity.train(docs.filter(~common.held_out()), labels.filter(~common.held_out()))
    scored = toxicity.scored(docs.select("doc_id", "text"), model).join(labels, "doc_id").filter(common.held_out())
    rows = [(r["score"] >= toxicity.THRESHOLD, r["toxic"]) for r in scored.collect()]
    hits = sum(1 for p, t in rows if p and t == 1)
    assert hits >= 0.55 * sum(t for _, t in rows) and sum(1 for p, t in rows if p and t == 0) <= 0.03 * len(rows)


def test_label_model_finds_accuracies():
    rng = np.random.default_rng(2)
    truth = rng.random(3_000) < 0.3
    good = np.where(rng.random((3_000, 5)) < 0.9, truth[:, None], ~truth[:, None])
    votes = np.hstack([good, rng.random((3_000, 3)) < 0.5, good[:, :1]]).astype(float)
    gold = np.where(np.arange(3_000) < 200, truth, -1)
    posterior, rates, weight = toxicity.label_model(votes, gold)
    assert ((posterior > 0.5) == truth).mean() > 0.95
    assert abs(rates[1][0] - 0.9) < 0.08 and abs(rates[0][0] - 0.1) < 0.08 and weight[0] < 0.7 < weight[1]


def test_toxicity_on_odd_rows(spark, odd_docs, no_docs):
    marks = spark.createDataFrame([(1, 1), (1, 0), (2, None), (None, 1)], "doc_id long, toxic int")
    for train_on in (odd_docs, no_docs):
        model = toxicity.train(train_on, marks)
        left = toxicity.kept(odd_docs, model)
        assert left.columns == odd_docs.columns and left.count() <= odd_docs.count()
        assert toxicity.kept(no_docs, model).count() == 0
    empty = toxicity.scored(odd_docs.filter("text is null or text = ''").select("doc_id", "text"), toxicity.train(no_docs, marks)).collect()
    assert len({r["score"] for r in empty}) == 1 and 0 <= empty[0]["score"] < toxicity.THRESHOLD


def test_base_counts(docs, odd_docs):
    for df in (docs.limit(150), odd_docs):
        got = {}
        for r in quality_rules.judged(df).collect():
            got.setdefault(r["doc_id"], tuple(r[1:7]))
        assert all(got[r["doc_id"]] == brute.base_counts(r["text"]) for r in df.collect())


def test_distances_and_verdicts(docs, labels, odd_docs, no_docs):
    rows = quality_rules.judged(docs).join(labels, "doc_id").collect()
    good = [r["kept"] for r in rows if r["quality"] == 1 and not r["base_failed"]]
    bad = [r["kept"] for r in rows if r["quality"] == 0]
    assert sum(good) >= 0.99 * len(good) and sum(bad) <= 0.5 * len(bad)
    assert all(not r["kept"] for r in rows if r["base_failed"])
    p, q = np.array([[0.5, 0.5, 0.0]]), np.array([0.0, 0.0, 1.0])
    assert quality_rules.divergence(p, q)[0] == 1.0 and quality_rules.divergence(p, p[0])[0] == 0.0
    assert quality_rules.judged(odd_docs).count() == odd_docs.count() and quality_rules.judged(no_docs).count() == 0


def check_packing(df):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.default_tokenizer())
    pieces = [r.asDict() for r in packing.packed(df, packing.default_tokenizer()).collect()]
    assert all(zlib.crc32(p["ids"]) == p["ids_crc32"] and len(p["ids"]) == 4 * p["length"] for p in pieces)
    want = sorted(((r["doc_id"], [*tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, 1]) for r in df.collect()), key=repr)
    found, by, spare = [], {}, {}
    for p in pieces:
        by.setdefault(p["sequence_id"], []).append(p)
        spare.setdefault((p["doc_id"], p["doc_tokens"]), {}).setdefault(p["start"], []).append(p)
    for row in by.values():
        row.sort(key=lambda p: p["offset"])
        assert [p["offset"] for p in row] == [sum(q["length"] for q in row[:k]) for k in range(len(row))]
        assert sum(p["length"] for p in row) <= 2048
    for doc_id, ids in want:
        at, whole = 0, b""
        while at < len(ids):
            p = spare[doc_id, len(ids)][at].pop()
            whole += p["ids"]
            at += p["length"]
        found.append((doc_id, list(struct.unpack(f"<{len(whole) // 4}I", whole))))
    assert len({i for i, _ in want}) < len(want) or found == want
    assert not any(row for starts in spare.values() for row in starts.values())
    sizes = [sum(p["length"] for p in row) for row in by.values()]
    assert sum(s & (s - 1) > 0 for s in sizes) <= 1
    assert len({(p["sequence_id"], p["window"], p["step_group"]) for p in pieces}) == len(by)
    steps, sizes_of = {}, {}
    for row in by.values():
        steps[row[0]["step_group"]] = steps.get(row[0]["step_group"], 0) + row[0]["window"]
        sizes_of.setdefault(row[0]["step_group"], set()).add(row[0]["window"])
    assert all(len(s) == 1 for s in sizes_of.values()) and max(steps.values()) == packing.STEP_TOKENS or len(by) < 64
    assert sum(n < packing.STEP_TOKENS for n in steps.values()) <= len(packing.WINDOWS)


def test_packing(docs, odd_docs, no_docs):
    check_packing(docs.limit(200).repartition(5))
    check_packing(docs.limit(400).repartition(40))
    check_packing(odd_docs)
    assert packing.packed(no_docs, packing.default_tokenizer()).count() == 0


def test_language_on_held_out_rows(docs, odd_docs, no_docs):
    model = language_id.train(docs.filter(~common.held_out()))
    rows = language_id.identified(docs, model).join(docs.select("doc_id", "lang"), "doc_id").filter(common.held_out()).collect()
    assert sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.97 * len(rows) and all(0 <= r["score"] <= 1 for r in rows)
    odd = {r["doc_id"]: r for r in language_id.identified(odd_docs, model).collect()}
    assert all(odd[i]["lang_pred"] == "und" and odd[i]["score"] == 0 for i in (4, 5, 10)) and odd[12]["lang_pred"] != "und"
    assert language_id.train(no_docs) is None
    assert {r["lang_pred"] for r in language_id.identified(odd_docs, None).collect()} == {"und"}


def test_folded_weights_equal_the_kernel():
    rng = np.random.default_rng(4)
    texts = [rng.choice(np.frombuffer(b"abc xyz" if k % 2 else b"def uvw", np.uint8), 200) for k in range(20)]
    sets = [np.unique(language_id.grams(t)) for t in texts]
    model = language_id.fitted(sets, ["b" if k % 2 else "a" for k in range(20)])
    at = np.full(language_id.SPACE, -1, np.int32)
    at[model.codes] = np.arange(len(model.codes))
    margin = model.margins(texts, at, np.zeros(language_id.SPACE, np.int32))
    assert [model.languages[k] for k in margin.argmax(axis=1)] == ["b" if k % 2 else "a" for k in range(20)]

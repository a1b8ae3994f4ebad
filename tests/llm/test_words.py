"""Token counts, spelling variants and periodic runs against plain versions."""

from __future__ import annotations

import random
import string

import numpy as np
import pytest

from railmart.llm import common, periodic, spelling, token_counts
from railmart.llm.suffix_tree import CommonPrefixes

import brute


def sorted_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def long_texts():
    rng = random.Random(4)
    letters = "".join(rng.choice("abcdefgh ijk  lmé\n0123,.'") for _ in range(20_000))
    return [
        letters, "a" * 5_000, "word " * 900, "don't we'll it's I'd " * 200, "x<|endoftext|>y <|startoftext|> z " * 60, "日本語のテキスト" * 300,
        "é ́a ﬁ İ ΑΣ ΑΣ " * 100, "    a  b" * 200, "▁ ▁▁a b▁ c " * 100, "\n\n a b\tc  d " * 100, "", " ",
    ]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"])
@pytest.mark.parametrize("piece", [1, 50, 1 << 15])
def test_token_counts_equal_those_of_whole_texts(spark, odd_docs, name, piece):
    public_tokenizers = pytest.importorskip("public_tokenizers")
    path = public_tokenizers.path(name)
    rows = [(k, t) for k, t in enumerate(long_texts())] + [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    if name.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        length = lambda t: len(model.encode(t))
    else:
        from tokenizers import Tokenizer

        model = Tokenizer.from_file(path)
        length = lambda t: len(model.encode(t, add_special_tokens=False).ids)
    want = [(i, len((t or "").encode()), length(t or ""), length(t or "") > 2048) for i, t in rows]
    got = token_counts.counted(spark.createDataFrame(rows, "doc_id long, text string"), path, piece=piece, batch=3_000)
    assert sorted_rows(got) == sorted(want, key=repr)


def test_token_counts_of_odd_rows(odd_docs, no_docs):
    public_tokenizers = pytest.importorskip("public_tokenizers")
    path = public_tokenizers.path("word_bpe_49k.json")
    out = token_counts.counted(odd_docs, path)
    assert out.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"] and out.count() == odd_docs.count()
    by_id = {r["doc_id"]: r for r in out.collect()}
    assert by_id[4]["n_tokens"] == by_id[5]["n_tokens"] == by_id[10]["n_tokens"] == 0 and by_id[8]["over_limit"]
    assert token_counts.counted(no_docs, path).count() == 0


def test_token_counts_encode_a_word_once(monkeypatch):
    public_tokenizers = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    known, encoded = token_counts.Counter(path), []
    lengths = known.lengths
    known.lengths = lambda texts: encoded.extend(texts) or lengths(texts)
    monkeypatch.setattr(token_counts, "KEPT_WORDS", 40)  # counts must survive the change to a new table
    rng = random.Random(3)
    odd = ["a\x1cb", "a\u00a0b", "a\u3000b", "a\u2028b", "a\u0085b", "\u0301x", "don't", "<|endoftext|>x", "<|ENDOFTEXT|>", "\u0130", "x" * 200, "q\u0301\u0323"]
    words = odd + ["".join(rng.choices("abcde", k=6)) for _ in range(20)]
    texts = ["".join(w + rng.choice([" ", "\n", "\t ", "\r\n", "\x0b", "\x0c"]) for w in rng.choices(words, k=300)) for _ in range(30)]
    got = [0] * len(texts)
    for row, n in known.counts(iter(texts), piece=500, batch=2_000):
        got[row] += n
    model = Tokenizer.from_file(path)
    assert got == [len(model.encode(t, add_special_tokens=False).ids) for t in texts]
    assert sum(map(len, encoded)) < sum(map(len, texts)) / 5


@pytest.mark.parametrize("change", [
    {"normalizer": {"type": "NFKC"}}, {"pre_tokenizer": {"type": "Whitespace"}}, {"pre_tokenizer": None},
    {"added_tokens": [{"content": "a b", "single_word": False, "lstrip": False, "rstrip": False, "normalized": False}]},
])
def test_other_vocabularies_are_not_counted_by_word(change):
    public_tokenizers = pytest.importorskip("public_tokenizers")
    import json

    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
        rules = json.load(file)
    assert token_counts.drops_space(rules) and not token_counts.drops_space(rules | change)


def one_apart(x, y):
    if abs(len(x) - len(y)) > 1 or x == y:
        return False
    k = next((i for i, (a, b) in enumerate(zip(x, y)) if a != b), min(len(x), len(y)))
    return x[k + 1 :] == y[k + 1 :] if len(x) == len(y) else (x[k + 1 :] == y[k:] if len(x) > len(y) else x[k:] == y[k + 1 :])


def test_sorted_scan_finds_all_near_pairs():
    rng = random.Random(2)
    for trial in range(300):
        size = rng.randrange(1, 6)
        cores = sorted({"".join(rng.choice("abé"[: rng.randrange(1, 4)]) for _ in range(rng.choice([size, size - 1]))) for _ in range(rng.randrange(2, 40))})
        if not any(cores):
            continue
        got = {(k, int(j)) for k, others, _ in spelling.near_pairs(cores) for j in others}
        assert got == {(i, j) for i in range(len(cores)) for j in range(i + 1, len(cores)) if one_apart(cores[i], cores[j])}


def near_texts(rng, alphabet):
    stems = ["".join(rng.choice(alphabet) for _ in range(rng.choice([5, 6, 7, 9, 14]))) for _ in range(60)] + ["aaaaaa", "aaaaaaa", "ababababab"]
    texts = []
    for k in range(60):
        words = []
        for _ in range(150):
            w = rng.choice(stems[: rng.choice([8, 63])])
            if rng.random() < 0.5:
                at = rng.randrange(len(w))
                w = rng.choice([w[:at] + w[at + 1 :], w[:at] + rng.choice(alphabet) + w[at:], w[:at] + rng.choice(alphabet) + w[at + 1 :]])
            words.append(rng.choice([w, w.upper(), w.title()]) + rng.choice([" ", ", ", "日", "×", "ā"]))
        texts.append((k, "".join(words)))
    return [*texts, (60, "chained " * 6 + "chainedd " * 40 + "chaineddd " * 300)]


@pytest.mark.parametrize(("most", "alphabet"), [(512, "abc"), (4, "ab"), (1, "abcÀàÿ"), (20, "xyzé")])
def test_variants_equal_the_plain_version(spark, most, alphabet):
    rows = near_texts(random.Random(most), alphabet)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = spelling.variants(spelling.vocabulary(docs, typos=7), most=most).select("word", "form", "root", "n", "n_near", "form_n")
    want = brute.spelling(rows, 7)
    assert len(want) > 100 and any(r[1] for r in want) and any(r[1] != r[2] for r in want if r[1])
    assert sorted_rows(got) == sorted(want, key=repr)


def test_variants_of_odd_rows(spark, odd_docs, no_docs):
    words = spelling.vocabulary(odd_docs, shortest=2, rarest=1, typos=3)
    rows = [("" if r["doc_id"] is None else r["doc_id"], r["text"]) for r in odd_docs.collect()]
    got = spelling.variants(words).select("word", "form", "root", "n", "n_near", "form_n")
    assert sorted_rows(got) == sorted(brute.spelling(rows, 3, shortest=2, rarest=1), key=repr)
    assert spelling.variants(spelling.vocabulary(no_docs)).count() == 0
    long = spark.createDataFrame([(1, ("a" * 3_000 + "b" + "c" * 2_000 + " ") * 5 + ("a" * 3_000 + "c" * 2_000 + " ") * 30)], "doc_id long, text string")
    by_n = {r["n"]: r for r in spelling.variants(spelling.vocabulary(long), most=1).collect()}
    assert by_n[5]["form"] == by_n[30]["word"] and by_n[30]["n_near"] == 1


def test_vocabulary_in_portions(spark, monkeypatch):
    monkeypatch.setattr(spelling, "HELD_WORDS", 3)
    rows = near_texts(random.Random(1), "abcd")
    got = spelling.vocabulary(spark.createDataFrame(rows, "doc_id long, text string"), typos=5).select("word", "n")
    assert sorted_rows(got) == sorted(((r[0], r[3]) for r in brute.spelling(rows, 5)), key=repr)


def test_common_prefixes():
    rng = np.random.default_rng(3)
    for _ in range(80):
        s = [*rng.integers(1, int(rng.integers(2, 5)), int(rng.integers(1, 60))).tolist(), 0]
        known = CommonPrefixes(s)
        assert sorted(range(len(s)), key=lambda i: s[i:]) == np.argsort(known.rank).tolist()
        i, j = (v.ravel() for v in np.meshgrid(range(len(s)), range(len(s))))
        i, j = i[i != j], j[i != j]
        if len(i):
            want = [next(k for k in range(len(s)) if s[x + k] != s[y + k]) for x, y in zip(i.tolist(), j.tolist())]
            assert known(i, j).tolist() == want


def test_runs_of_random_and_fibonacci_sequences():
    rng = random.Random(5)
    fibonacci = ["a", "ab"]
    while len(fibonacci[-1]) < 150:
        fibonacci.append(fibonacci[-1] + fibonacci[-2])
    samples = [list(fibonacci[-1]), list("ab" * 40), list("a" * 50), list("aab" * 5 + "aabaab" * 6)]
    for _ in range(300):
        samples.append([rng.choice("abc"[: rng.randrange(1, 4)]) for _ in range(rng.randrange(1, 50))])
    for words in samples:
        numbers = {w: k for k, w in enumerate(sorted(set(words)), 1)}
        for least in (1, 12):
            assert periodic.runs_of([numbers[w] for w in words], least) == brute.runs(words, least)
        raw = " ".join(words).encode()
        hashes, _ = common.word_hashes(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
        assert periodic.runs_in([w.encode() for w in words], hashes) == brute.runs(words)


def test_run_digests_equal_the_plain_version(spark, odd_docs, no_docs):
    rng, rows = random.Random(6), []
    for k in range(250):
        words = [rng.choice(string.ascii_letters[: rng.choice([2, 9, 50])]) for _ in range(rng.choice([0, 1, 5, 30, 90, 200]))]
        for _ in range(rng.randrange(3)):
            at, q = rng.randrange(len(words) + 1), rng.randrange(1, 9)
            words[at:at] = (words[at : at + q] or ["é"]) * rng.randrange(2, 9)
        rows.append((k, rng.choice([" ", "\n", "\t \x0b"]).join(words)))
    rows += [(1_000, "para one two three four five six seven\n" * 2), (1_001, None), (None, "x y " * 20)]
    got = periodic.digest(periodic.with_runs(spark.createDataFrame(rows, "doc_id long, text string"), places=periodic.planted))
    want = [brute.run_digest(*r) for r in rows]
    assert sum(r[1] > 0 for r in want) > 50 and sum(r[1] > 1 for r in want) > 20
    assert sorted_rows(got) == sorted(want, key=repr)
    odd = [(r["doc_id"], r["text"]) for r in odd_docs.collect() if r["doc_id"] != 8]
    got = periodic.digest(periodic.with_runs(odd_docs.filter("doc_id is null or doc_id <> 8"), places=periodic.planted))
    assert sorted_rows(got) == sorted((brute.run_digest(*r) for r in odd), key=repr)
    assert periodic.with_runs(odd_docs).count() == odd_docs.count() and periodic.with_runs(no_docs).count() == 0


def test_texts_keep_their_first_period(spark):
    docs = spark.createDataFrame([(3, "start " + "la lu " * 9 + "end"), (5, "no run here")], "doc_id long, text string")
    out = {r["doc_id"]: r for r in periodic.with_runs(docs).collect()}
    assert out[3]["collapsed"] == "start la lu end" and [tuple(r) for r in out[3]["runs"]] == [(1, 18, 2)]
    assert out[5]["collapsed"] == "no run here" and out[5]["runs"] == []

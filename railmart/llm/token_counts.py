"""Token counts of whole texts by batch encoding, lengths only.

Texts are cut into pieces of about PIECE characters at places where the tokenizer's result can't change, and pieces are encoded in batches
of about BATCH bytes, so one call never holds the tokens of more than that (or of one text without a safe place). A text's count is the
sum over its pieces. No row is shuffled; a lost task counts its rows again.

Vocabularies whose rules drop white space (`drops_space`) count word by word: the words of a batch that have no count yet are encoded
together, each once, and counts are kept for KEPT_WORDS words, the frequent ones longest.

Safe places. `.json` (tokenizers): before one space between two ASCII letters, where word and byte-level rules both start a new word.
With dropped white space: any of its ASCII characters. `.model` (sentencepiece): the same space, left out, as the next piece gets it back as its leading mark; only if no entry of the vocabulary
goes on behind an inner mark, else texts stay whole.

Defined cases: a null text is empty and has no tokens; special strings in a text count as the library reads them by default; repeated rows
and null ids are rows of their own; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railmart.llm import common

PIECE = 1 << 15
BATCH = 1 << 18
LIMIT = 2048
KEPT_WORDS = 250_000
LONGEST_KEPT = 64
BETWEEN_LETTERS = re.compile(r"(?<=[A-Za-z]) (?=[A-Za-z])")
ASCII_SPACE = re.compile(r"[\t-\r ]")
WORDS_ONLY = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def drops_space(rules: dict) -> bool:
    """Whether a `.json` vocabulary surely encodes a text as its words between ASCII white space, one by one: its steps before the splitting
    look at no neighbour across a space, the splitting keeps matches without white space only, and no special string holds or takes any."""
    steps = rules.get("normalizer") or {"type": "Sequence", "normalizers": []}
    steps = steps["normalizers"] if steps["type"] == "Sequence" else [steps]
    blank = {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}
    words = {"type": "Split", "pattern": {"Regex": WORDS_ONLY}, "behavior": "Removed", "invert": True}
    split = (rules.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
    rest = all(p["type"] == "ByteLevel" and not p["add_prefix_space"] and not p["use_regex"] for p in split[1:])
    special = any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] or re.search(r"\s", t["content"]) for t in rules.get("added_tokens") or [])
    known = all(s["type"] in ("NFC", "Lowercase") or s == blank for s in steps)
    return known and split[0] == words and rest and not special and rules["model"].get("type") == "BPE" and not rules["model"].get("dropout")


class Counter:
    """Lengths of encoded texts by one vocabulary file."""

    def __init__(self, path: str):
        if path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            pieces = (model.id_to_piece(i) for i in range(model.get_piece_size()))
            self.cuts = not any("▁" in p.lstrip("▁") for p in pieces)
            self.skipped, self.by_word = 1, False
            self.lengths: Callable[[list[str]], list[int]] = lambda texts: [len(ids) for ids in model.encode(texts, num_threads=1)]
        else:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
            from tokenizers import Tokenizer

            tokenizer = Tokenizer.from_file(path)
            tokenizer.no_truncation()
            tokenizer.no_padding()
            with open(path, encoding="utf-8") as file:
                self.by_word = drops_space(json.load(file))
            self.cuts, self.skipped = True, 0
            self.lengths = lambda texts: [len(e) for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

        self.safe = ASCII_SPACE if self.by_word else BETWEEN_LETTERS
        self.known: dict[bytes, int] = {}
        self.older: dict[bytes, int] = {}

    def pieces(self, text: str, size: int) -> Iterator[str]:
        """The text in pieces that end at the first safe place after `size` characters."""
        at = 0
        while self.cuts and len(text) - at > size:
            space = self.safe.search(text, at + size)
            if space is None:
                break
            yield text[at : space.start()]
            at = space.start() + self.skipped
        yield text[at:]

    def counts(self, texts: Iterator[str], piece: int, batch: int) -> Iterator[tuple[int, int]]:
        """Row number and tokens for the pieces of all texts, each batch by itself."""
        rows: list[int] = []
        waiting: list[str] = []
        held = 0
        for row, text in enumerate(texts):
            for part in self.pieces(text, piece):
                rows.append(row)
                waiting.append(part)
                held += len(part)
                if held >= batch:
                    yield from zip(rows, self.counted(waiting), strict=True)
                    rows, waiting, held = [], [], 0
        if waiting:
            yield from zip(rows, self.counted(waiting), strict=True)

    def counted(self, texts: list[str]) -> list[int]:
        """Tokens of each text of a batch, word by word where the vocabulary allows it."""
        if not self.by_word:
            return self.lengths(texts)
        words = [t.encode().split() for t in texts]
        new = list(set().union(*words) - self.known.keys())
        missing = [w for w in new if w not in self.older]
        found = dict(zip(missing, self.lengths([w.decode() for w in missing]), strict=True))
        # Words met again move on from the older counts, so that frequent ones stay.
        self.known.update((w, found[w] if w in found else self.older[w]) for w in new)
        out = [sum(map(self.known.__getitem__, row)) for row in words]
        for w in missing:
            if len(w) > LONGEST_KEPT:
                del self.known[w]
        if len(self.known) > KEPT_WORDS:
            self.known, self.older = {}, self.known
        return out


_counters: dict[str, Counter] = {}


def counter(path: str) -> Counter:
    if path not in _counters:
        _counters[path] = Counter(path)
    return _counters[path]


def counted(docs: DataFrame, tokenizer: str, limit: int = LIMIT, piece: int = PIECE, batch: int = BATCH) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for each row. tokenizer: path of a vocabulary file that all executors have."""

    @common.trimmed
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = counter(tokenizer)
        for rows in batches:
            text = rows.column(1).fill_null("")
            tokens = np.zeros(rows.num_rows, np.int64)
            for row, n in known.counts((t.as_py() for t in text), piece, batch):
                tokens[row] += n
            sizes = pa.compute.binary_length(text).cast(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), sizes, pa.array(tokens), pa.array(tokens > limit)], names=["doc_id", "n_bytes", "n_tokens", "over_limit"]
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(count, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean")


def query(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    return counted(docs, public_tokenizers.path("word_bpe_49k.json"))

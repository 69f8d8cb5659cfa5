"""Token counts by a map-side lookup of pre-token lengths in two tiers.

A pre-token here is a run without ASCII blanks: the tokenizer's own pre-tokens
never contain white space and its normaliser doesn't join across it, so a
text's tokens are the sum over these runs, added special tokens in them
included.

Tier one is a compact hash table of the most frequent pre-tokens of the whole
corpus, broadcast to all executors: ``TABLE`` fingerprints and lengths, about
1 MB whatever the corpus.  Tier two is a bounded cache in each worker; what it
misses is encoded with the tokenizer.  Pre-tokens are never shuffled: for the
table, a task sends the ``SUMMARY`` most frequent of its own rows only.  The
table decides where a length is found, never what it is.

Defined cases: a null text counts as empty, with 0 bytes and 0 tokens; a very long text
is looked up in whole, its different pre-tokens once; every input row gives one result
row, repeated and null ids too; the columns read are picked by name, whatever further
columns there are; an empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowgate.llm.common import map_batches, map_rows, pieces, table, vocabulary, word_hashes

TOKENIZER = "word_bpe_49k.json"
#: Pre-tokens in the broadcast table, and those that a task proposes for it.
TABLE = 1 << 16
SUMMARY = 4096
#: Longest pre-token, in bytes, that a task proposes.
LONGEST = 64
#: Distinct pre-tokens that a worker holds while it counts, and in its cache.
COUNTED = 200_000
CACHE = 200_000
LIMIT = 2048


def frequent_pretokens(docs: DataFrame, size: int = TABLE, summary: int = SUMMARY) -> list[bytes]:
    """The pre-tokens of highest counts, from every row's text."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for part in pieces(batch):
                for text in part.column(0).to_pylist():
                    if text:
                        seen.update(text.encode().split())
                if len(seen) > COUNTED:  # forget the rarest
                    seen = Counter(dict(seen.most_common(COUNTED // 4)))
        top = [(w, n) for w, n in seen.most_common(summary) if len(w) <= LONGEST]
        yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in top], pa.binary()), pa.array([n for _, n in top], pa.int64())], ["word", "n"])

    rows = (map_batches(docs.select("text"), count, "word binary, n long")
            .groupBy("word").agg(F.sum("n").alias("n")).orderBy(F.col("n").desc(), "word").limit(size).collect())
    return [bytes(r["word"]) for r in rows]


class Lengths:
    """Open-addressing table from fingerprints of pre-tokens to token counts."""

    def __init__(self, words: list[bytes], counts: list[int]) -> None:
        bits = max(4, (2 * len(words)).bit_length())
        self.mask = np.uint64((1 << bits) - 1)
        self.keys = np.zeros(1 << bits, np.uint64)
        self.counts = np.zeros(1 << bits, np.uint16)
        self.reach = 1
        for h, n in zip(word_hashes(words).tolist(), counts):
            if h == 0:
                continue
            at, far = h & int(self.mask), 1
            while self.keys[at] not in (0, h):
                at, far = (at + 1) & int(self.mask), far + 1
            self.keys[at], self.counts[at] = h, n
            self.reach = max(self.reach, far)

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Counts, and which fingerprints have none here."""
        at = h & self.mask
        out = np.zeros(len(h), np.int64)
        open_ = np.arange(len(h))
        missing = []
        for _ in range(self.reach):
            key = self.keys[at]
            hit = (key == h[open_]) & (key != 0)
            out[open_[hit]] = self.counts[at[hit]]
            empty = key == 0
            missing.append(open_[empty])
            go_on = ~hit & ~empty
            open_, at = open_[go_on], (at[go_on] + np.uint64(1)) & self.mask
            if not len(open_):
                break
        return out, np.concatenate([*missing, open_])


def load_tokenizer(model: bytes):
    from tokenizers import Tokenizer

    return Tokenizer.from_str(model.decode("utf-8"))


def token_lengths(tokenizer, words: list[bytes]) -> list[int]:
    found = tokenizer.encode_batch_fast([w.decode("utf-8") for w in words], add_special_tokens=False)
    return [len(x.ids) for x in found]


#: Tokenizers and caches of this worker process, by model: they outlive a task.
_WORKERS: dict[int, tuple] = {}


def worker(model: bytes) -> tuple:
    """The tokenizer of this process and the lengths that it has found."""
    import os

    key = xxhash.xxh3_64_intdigest(model)
    if key not in _WORKERS:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _WORKERS[key] = load_tokenizer(model), {}
    return _WORKERS[key]


def count_tokens(docs: DataFrame, tokenizer: str = TOKENIZER, limit: int = LIMIT, size: int = TABLE, cache: int = CACHE) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for every row of ``docs``."""
    model = vocabulary(tokenizer)
    words = frequent_pretokens(docs, size)
    lengths = Lengths(words, token_lengths(load_tokenizer(model), words)) if words else Lengths([], [])
    sc = docs.sparkSession.sparkContext
    shared = sc.broadcast((model, lengths))

    def make():
        model, lengths = shared.value
        tok, cached = worker(model)

        def run(rows: dict[str, list]) -> dict[str, list]:
            texts = [(t or "").encode() for t in rows["text"]]
            split = [t.split() for t in texts]
            sizes = np.array([len(x) for x in split], np.int64)
            flat = [w for x in split for w in x]
            # every different pre-token is looked up once
            words = list(dict.fromkeys(flat))
            counts, missing = lengths.find(word_hashes(words))
            missed = [words[i] for i in missing.tolist()]
            new = [w for w in missed if w not in cached]
            if len(cached) + len(new) > cache:
                cached.clear()
                new = missed
            found = dict(zip(new, token_lengths(tok, new)))
            counts[missing] = [found[w] if w in found else cached[w] for w in missed]
            if len(cached) + len(found) <= cache:
                cached.update((w, n) for w, n in found.items() if len(w) <= LONGEST)
            length_of = dict(zip(words, counts.tolist()))
            counts = np.fromiter(map(length_of.__getitem__, flat), np.int64, len(flat))
            ends = np.cumsum(sizes)
            upto = np.append(0, np.cumsum(counts))
            n = (upto[ends] - upto[ends - sizes]).tolist()
            return {"doc_id": rows["doc_id"], "n_bytes": [len(t) for t in texts], "n_tokens": n, "over_limit": [x > limit for x in n]}

        return run

    return map_rows(docs.select("doc_id", "text"), make, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")


def op7_token_counts(spark, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"))

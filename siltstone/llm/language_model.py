"""Scoring by a smoothed word model kept in sharded Elias-Fano n-gram tries.

The model is p(w | v) = (c(v, w) + m p(w)) / (c(v) + m) over p(w) = (c(w) + 1/2) /
(N + (V + 1) / 2); the weight ``m`` is chosen for contexts of like frequency by
leaving one occurrence out, from ``WEIGHTS``.  It gathers the counts of all
training texts; nothing is sampled or cut.

It is never held whole anywhere.  Documents are encoded in batches of some
megabytes; a batch sends the words it has to the shards of words and gets their
numbers and counts back, then sends its word pairs to the shards of contexts.
One shard's pairs of all batches meet in one task, which counts those of the
training texts, builds the trie of its contexts and searches it for all of them;
the sums per document go back.  Everything sent is packed per batch and shard,
with each word or pair once, so a frequent word weighs no more than a rare one.

Defined results: null and blank texts are one end token; rows with a null id are
trained on; repeated rows count each; with nothing to train on every token is
unknown and both scores are those of an empty vocabulary; an empty table gives
an empty result; other columns are not read.
"""

from __future__ import annotations

import math
import uuid
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.common import arrow_batches, store
from siltstone.llm.elias_fano import Trie, quantised, restored
from siltstone.llm.blobs import by_shard, joined, packed, packed_ids, unpacked, unpacked_ids
from siltstone.llm.words import column_bytes, mix, row_chunks, word_hashes

BATCH_BYTES = 6_000_000
SHARD_TOKENS = 3_000_000
WEIGHTS = (3.0, 10.0, 30.0, 100.0, 300.0, 1e3, 3e3, 1e4, 1e5, 1e6)
END = mix(np.array([0x2545F4914F6CDD1D], dtype=np.uint64))[0]

BATCH = "batch string, n_docs int, doc_ids binary, held binary, lengths binary, tokens binary, places binary, end int, words binary, counts binary"


def encoded(docs: DataFrame) -> DataFrame:
    """Batches of documents as numbers of their own words, training counts beside them.

    Words are numbered by falling frequency, so that numbers pack well; ``places``
    has the place of each in ``words``, the sorted hashes, and ``end`` is the
    number of the end.  ``lengths`` are tokens per document, the end included.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in joined(batches, BATCH_BYTES):
            flat, offsets = column_bytes(batch.column(1))
            for low, high in row_chunks(offsets, BATCH_BYTES):
                part = offsets[low : high + 1]
                hashes, at = word_hashes(flat[part[0] : part[-1]], part - part[0])
                ends = np.insert(hashes, at[1:], END)
                words, tokens = np.unique(ends, return_inverse=True)
                lengths = np.diff(at) + 1
                held = np.asarray(batch.column(2).slice(low, high - low).to_numpy(zero_copy_only=False), dtype=bool)
                training = np.repeat(~held, lengths)
                counts = np.bincount(tokens[training], minlength=len(words))
                places = np.argsort(-np.bincount(tokens), kind="stable")
                number = np.empty(len(words), np.int64)
                number[places] = np.arange(len(words))
                end = int(number[np.searchsorted(words, END)])
                ids = batch.column(0).slice(low, high - low)
                row = [uuid.uuid4().hex, high - low, packed_ids(ids), packed(held), packed(lengths), packed(number[tokens]), packed(places), end, words.tobytes(), packed(counts)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([v], k) for v, k in zip(row, (pa.string(), pa.int32(), *[pa.binary()] * 5, pa.int32(), pa.binary(), pa.binary()))],
                    [c.split()[0] for c in BATCH.split(", ")],
                )

    arrow_batches(docs.sparkSession)
    held = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 1, F.lit(False))
    return docs.select(F.col("doc_id").cast("long"), "text", held.alias("held")).mapInArrow(run, BATCH)


def range_of(hashes: np.ndarray, shards: int) -> np.ndarray:
    """The shard of a hash by ranges: sorted hashes have sorted shards."""
    return ((hashes >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


def shard_of(hashes: np.ndarray, shards: int) -> np.ndarray:
    return (hashes >> np.uint64(40)).astype(np.int64) % shards


def word_rows(batches: DataFrame, shards: int) -> DataFrame:
    """Every batch's words and training counts, one row per shard of words."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for r in part.itertuples():
                words, counts = np.frombuffer(r.words, np.uint64), unpacked(r.counts)
                own = range_of(words, shards)
                rows = [
                    (r.batch, s, words[m].tobytes(), packed(counts[m]))
                    for s, m in by_shard(own)
                ]
                yield pd.DataFrame(rows, columns=["batch", "shard", "words", "counts"])

    return batches.select("batch", "words", "counts").mapInPandas(run, "batch string, shard int, words binary, counts binary")


def count_words(part: pd.DataFrame) -> pd.DataFrame:
    """Total training counts of one shard's words, and their numbers (0 for unknown), in the order each batch asked.

    Numbers follow falling counts within the shard; ``n_words`` and ``n_tokens`` are the shard's totals.
    """
    lists = [np.frombuffer(w, np.uint64) for w in part["words"]]
    words, where = np.unique(np.concatenate(lists), return_inverse=True)
    total = np.bincount(where, np.concatenate([unpacked(c) for c in part["counts"]])).astype(np.int64)
    order = np.argsort(-total, kind="stable")
    number = np.empty(len(words), np.int64)
    number[order] = np.arange(1, len(words) + 1)
    number[total == 0] = 0
    at = np.concatenate([[0], np.cumsum([len(x) for x in lists])])
    cuts = [where[at[i] : at[i + 1]] for i in range(len(lists))]
    return pd.DataFrame({
        "batch": part["batch"].tolist(), "shard": part["shard"].to_numpy(),
        "numbers": [packed(number[c]) for c in cuts], "counts": [packed(total[c]) for c in cuts],
        "n_words": np.int64((total > 0).sum()), "n_tokens": total.sum(),
    })


PAIRS = (
    "batch string, shard int, contexts binary, words binary, totals binary, codes binary, trained binary, "
    "times binary, docs binary"
)

def unigrams(counts: np.ndarray, n_tokens: int, n_words: int) -> np.ndarray:
    return np.log10((counts + 0.5) / (n_tokens + 0.5 * (n_words + 1)))


def looked_up(batch: pd.Series, answers: pd.DataFrame, word_shards: int) -> tuple[np.ndarray, np.ndarray]:
    """Training count and number of every word of a batch, by the batch's own numbering.

    Numbers of all words are distinct; 0 is an unknown word.
    """
    answers = answers.sort_values("shard")
    counts = np.concatenate([unpacked(c) for c in answers["counts"]]).astype(np.int64)
    number = np.concatenate([
        np.where((local := unpacked(n).astype(np.int64)) > 0, local * word_shards + shard, 0)
        for n, shard in zip(answers["numbers"], answers["shard"])
    ])
    places = unpacked(batch["places"]).astype(np.int64)
    return counts[places], number[places]


def base_sums(batch: pd.Series, counts: np.ndarray, n_tokens: int, n_words: int) -> tuple[np.ndarray, np.ndarray]:
    """Base score and known tokens of every document of a batch."""
    lengths, tokens = unpacked(batch["lengths"]).astype(np.int64), unpacked(batch["tokens"])
    doc = np.repeat(np.arange(len(lengths)), lengths)
    log10 = unigrams(counts, n_tokens, n_words)
    return np.bincount(doc, log10[tokens], len(lengths)), np.bincount(doc, counts[tokens] > 0, len(lengths)).astype(np.int64)


def pair_rows(batch: pd.DataFrame, answers: pd.DataFrame, shards: int, word_shards: int, n_tokens: int, n_words: int) -> pd.DataFrame:
    """A batch's distinct word pairs with the documents they occur in, one row per shard of contexts.

    A context is the number of the word before, 0 for an unknown one and 1 for
    the beginning (numbers of words start at ``word_shards``, 2 or more).
    """
    r = batch.iloc[0]
    counts, number = looked_up(r, answers, word_shards)
    lengths, held = unpacked(r["lengths"]).astype(np.int64), unpacked(r["held"]).astype(bool)
    tokens = unpacked(r["tokens"]).astype(np.int64)
    doc = np.repeat(np.arange(len(lengths)), lengths)
    begins = np.cumsum(lengths) - lengths
    context, total = np.empty(len(tokens), np.int64), np.empty(len(tokens), np.int64)
    context[1:], total[1:] = number[tokens[:-1]], counts[tokens[:-1]]
    context[begins], total[begins] = 1, counts[r["end"]]  # as many beginnings as ends
    width = np.int64(max(1, int(number.max(initial=0)).bit_length()))
    pair = (context << width) | number[tokens]
    order = np.argsort(pair, kind="stable")
    first = np.flatnonzero(np.diff(pair[order], prepend=-1))
    key, some = pair[order[first]], order[first]
    times = np.diff(np.append(first, len(order)))
    trained = np.add.reduceat(~held[doc[order]], first, dtype=np.int64)
    # Probabilities travel as the codes that the tries have: down to 1e-16, which no count reaches.
    codes = quantised(unigrams(counts, n_tokens, n_words)).astype(np.int64)[tokens[some]]
    totals = total[some]
    # A context with more than its share of the tokens is dealt out by the word as well.
    salts = np.maximum(1, totals * (4 * shards) // max(1, n_tokens))
    salted = (key >> width) * 4 * shards + mix((key & ((1 << width) - 1)).astype(np.uint64)).astype(np.int64) % salts
    place, docs_in_order = shard_of(mix(salted.astype(np.uint64)), shards), doc[order]
    tokens_of = dict(by_shard(np.repeat(place, times)))
    rows = [
        (
            r["batch"], s, packed(np.diff(key[m] >> width, prepend=0)), packed(key[m] & ((1 << width) - 1)), packed(totals[m]),
            packed(codes[m]), packed(trained[m]), packed(times[m]), packed(docs_in_order[tokens_of[s]]),
        )
        for s, m in by_shard(place)
    ]
    return pd.DataFrame(rows, columns=[f.split()[0] for f in PAIRS.split(", ")])


def best_weights(count: np.ndarray, total: np.ndarray, unigram: np.ndarray, sizes: int, weights: Sequence[float]) -> np.ndarray:
    """The best weight for contexts of each size (power of two), one occurrence left out of the counts."""
    size = np.log2(total).astype(np.int64)
    gain = np.empty((len(weights), sizes))
    for k, m in enumerate(weights):
        each = count * np.log10((count - 1 + m * unigram) / (total - 1 + m))
        gain[k] = np.bincount(size, each, sizes)
    return np.array(weights)[gain.argmax(axis=0)]


def trie_of(
    context: np.ndarray, word: np.ndarray, count: np.ndarray, total: np.ndarray, log10: np.ndarray, weights: Sequence[float]
) -> bytes:
    """The trie of one shard from its pairs, sorted by context and word; ``total`` counts the context, ``count`` the pair.

    A context that the training texts hold has its back-off weight here even if
    none of its pairs in this shard was trained on.
    """
    contexts, first = np.unique(context, return_index=True)
    totals = total[first].astype(np.float64)
    contexts, totals = contexts[totals > 0], totals[totals > 0]
    use = np.flatnonzero(count)
    context, word, count, each, unigram = context[use], word[use], count[use], total[use].astype(np.float64), 10.0 ** log10[use]
    if not len(use):
        return Trie.build(context, word, unigram, contexts, np.log10(weights[-1] / (totals + weights[-1])))
    best = best_weights(count, each, unigram, int(np.log2(totals.max())) + 1, weights)
    m = best[np.log2(each).astype(np.int64)]
    own = best[np.log2(totals).astype(np.int64)]
    smoothed = np.log10((count + m * unigram) / (each + m))
    return Trie.build(context, word, smoothed, contexts, np.log10(own / (totals + own)))


def score_shard(part: pd.DataFrame, weights: Sequence[float] = WEIGHTS) -> pd.DataFrame:
    """Build the trie of one shard of contexts, and sum the codes of its log probabilities per batch and document.

    Only documents that occur among the shard's pairs are answered for, with whole numbers.
    """
    def all_of(column: str) -> np.ndarray:
        return np.concatenate([unpacked(c) for c in part[column]]).astype(np.int64)

    sizes = [len(c) for c in map(unpacked, part["codes"])]
    context = np.concatenate([np.cumsum(unpacked(c).astype(np.int64)) for c in part["contexts"]])
    word = all_of("words")
    width = np.int64(max(1, int(word.max(initial=0)).bit_length()))
    pair = (context << width) | word
    order = np.argsort(pair, kind="stable")
    new = np.diff(pair[order], prepend=-1) != 0
    first = np.flatnonzero(new)
    some = order[first]
    count = np.add.reduceat(all_of("trained")[order], first)
    own = all_of("codes")[some]
    context, word, total = context[some], word[some], all_of("totals")[some]
    trie = Trie(trie_of(context, word, count, total, restored(own), weights))
    found = np.empty(len(order), np.int64)
    found[order] = trie.codes(context, word, own)[np.cumsum(new) - 1]
    rows, at = [], 0
    for r, n in zip(part.itertuples(), sizes):
        each = np.repeat(found[at : at + n], unpacked(r.times).astype(np.int64))
        docs = unpacked(r.docs).astype(np.int64)
        present = np.unique(docs)
        sums = np.bincount(docs, each)[present].astype(np.int64)  # whole numbers, exact below 2 ** 53
        rows.append((r.batch, packed(np.diff(present, prepend=0)), packed(sums)))
        at += n
    return pd.DataFrame(rows, columns=["batch", "docs", "sums"])


BASE = "batch string, doc_ids binary, held binary, lengths binary, known binary, base binary"
SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def scored(docs: DataFrame, weights: Sequence[float] = WEIGHTS) -> DataFrame:
    """The contract's columns for every row of ``docs`` (``doc_id``, ``text``)."""
    batches = store(encoded(docs), "token-batches")
    size = batches.agg(F.sum(F.octet_length("words") / 8 + F.octet_length("tokens")), F.count("*")).first()
    shards = max(4, math.ceil((size[0] or 0) / SHARD_TOKENS))
    word_shards = max(2, shards // 3)
    asked = word_rows(batches, word_shards)
    counted = asked.groupBy("shard").applyInPandas(
        count_words, "batch string, shard int, numbers binary, counts binary, n_words long, n_tokens long"
    )
    answered = store(counted, "word-counts")
    totals = answered.groupBy("shard").agg(F.max("n_words").alias("w"), F.max("n_tokens").alias("t")).agg(F.sum("t"), F.sum("w")).first()
    n_tokens, n_words = int(totals[0] or 0), int(totals[1] or 0)
    asking = batches.drop("words", "counts").groupBy("batch")
    pairs = asking.cogroup(answered.groupBy("batch")).applyInPandas(
        lambda b, a: pair_rows(b, a, shards, word_shards, n_tokens, n_words), PAIRS
    )
    parts = pairs.groupBy("shard").applyInPandas(lambda p: score_shard(p, weights), "batch string, docs binary, sums binary")

    def base(batch: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        r = batch.iloc[0]
        sums, known = base_sums(r, looked_up(r, answers, word_shards)[0], n_tokens, n_words)
        return pd.DataFrame([(*r[["batch", "doc_ids", "held", "lengths"]], packed(known), sums.tobytes())], columns=[c.split()[0] for c in BASE.split(", ")])

    def finish(batch: pd.DataFrame, sums: pd.DataFrame) -> pd.DataFrame:
        r = batch.iloc[0]
        lengths = unpacked(r["lengths"]).astype(np.int64)
        total = np.zeros(len(lengths), np.int64)
        for docs, codes in zip(sums["docs"], sums["sums"]):
            total[np.cumsum(unpacked(docs).astype(np.int64))] += unpacked(codes).astype(np.int64)
        return pd.DataFrame({
            "doc_id": unpacked_ids(r["doc_ids"]), "held_out": unpacked(r["held"]).astype(bool), "n_tokens": lengths,
            "n_known": unpacked(r["known"]).astype(np.int64), "train_tokens": np.int64(n_tokens),
            "base_score": np.frombuffer(r["base"]), "score": restored(total),
        })

    bases = asking.cogroup(answered.groupBy("batch")).applyInPandas(base, BASE)
    return bases.groupBy("batch").cogroup(parts.groupBy("batch")).applyInPandas(finish, SCORES)

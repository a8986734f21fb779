"""Alignment of two tokenizers on the same texts by products of sparse incidence matrices.

Both token sequences of a text cover the same bytes.  With the token-byte
incidence matrices A and B, an entry of A·Bᵀ is the number of bytes that a token
of the one shares with a token of the other: its nonzero places are the overlap
links.  Bytes where tokens of both end cut the tokens into groups; the product of
the group-token incidences, Gᴬᵀ·Gᴮ, has the links of tokens that share a group.
The matrices are hand-built in CSR form and multiplied row by row (Gustavson).

A single space between two other characters begins a token in both sequences, so
a text falls into segments whose alignments are independent.  A task multiplies
the matrices of the distinct segments it meets, all in one block-diagonal matrix,
and a text's links are those of its segments.  A link's corpus-wide count needs
all texts: batches of some megabytes send each distinct pair of ids once, with
its number of links, and get the counts back by a join.

Defined results: a text that is null or empty, or whose tokens' bytes are not
the space and the text (U+2581 in it, say), has no tokens and zeros; repeated
rows count each; rows with a null id are kept and count; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.blobs import joined, packed, packed_ids, unpacked, unpacked_ids
from siltstone.llm.common import arrow_batches, store
from siltstone.llm.packing import beside_blank, lone_blanks

TOKENIZER_A = "byte_bpe_50k.json"
TOKENIZER_B = "piece_bpe_32k.model"
BATCH_BYTES = 6_000_000
# Segments encoded at a time.
JOINED = 200
# Texts whose encodings, with all that the tokenizer notes of them, are held at a time.
AT_ONCE = 20
# Entries that a product expands at a time.
BLOCK = 1_000_000


@dataclass(frozen=True)
class Csr:
    """A sparse matrix by rows: the columns of row ``i`` are ``columns[begins[i]:begins[i + 1]]``, every entry one."""

    begins: np.ndarray
    columns: np.ndarray
    width: int

    def __len__(self) -> int:
        return len(self.begins) - 1

    def transposed(self) -> Csr:
        rows = np.repeat(np.arange(len(self)), np.diff(self.begins))
        order = np.argsort(self.columns, kind="stable")
        begins = np.concatenate([[0], np.cumsum(np.bincount(self.columns, minlength=self.width))])
        return Csr(begins, rows[order], len(self))


def incidence(begins: np.ndarray) -> Csr:
    """Rows that hold consecutive columns: token ``i`` holds the bytes from ``begins[i]`` to the next one's first."""
    return Csr(begins, np.arange(begins[-1]), int(begins[-1]))


def row_terms(left: Csr, right: Csr) -> np.ndarray:
    """How many terms every row of the product has, by the sizes of the rows alone (Gustavson's symbolic pass)."""
    sizes = np.diff(right.begins)[left.columns]
    total = np.concatenate([[0], np.cumsum(sizes)])
    return total[left.begins[1:]] - total[left.begins[:-1]]


def product(left: Csr, right: Csr, block: int = BLOCK) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``left · right`` as (rows, columns, values) in order, some rows at a time.

    A row is the sum of those rows of ``right`` that the left row's columns
    name.  Only ``block`` terms, or one row's, are held at a time.
    """
    terms = np.concatenate([[0], np.cumsum(row_terms(left, right))])
    low = 0
    while low < len(left):
        high = max(low + 1, int(np.searchsorted(terms, terms[low] + block, "right")) - 1)
        picked = left.columns[left.begins[low] : left.begins[high]]
        sizes = right.begins[picked + 1] - right.begins[picked]
        ends = np.cumsum(sizes)
        inside = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - sizes, sizes)
        columns = right.columns[np.repeat(right.begins[picked], sizes) + inside]
        rows = np.repeat(np.arange(low, high), terms[low + 1 : high + 1] - terms[low:high])
        key = rows * np.int64(right.width) + columns
        if len(key) and (np.diff(key) < 0).any():
            key = np.sort(key)
        first = np.flatnonzero(np.diff(key, prepend=-1))
        yield key[first] // right.width, key[first] % right.width, np.diff(np.append(first, len(key)))
        low = high


def shared_ends(a_begins: np.ndarray, b_begins: np.ndarray) -> np.ndarray:
    """Byte offsets where tokens of both sequences end, 0 first."""
    return np.intersect1d(a_begins, b_begins, assume_unique=True)


def grouped(begins: np.ndarray, bounds: np.ndarray) -> Csr:
    """The group-token incidence: tokens of every group, groups being cut at ``bounds``."""
    at = np.searchsorted(begins, bounds)
    return Csr(at, np.arange(len(begins) - 1), len(begins) - 1)


class Segments:
    """Aligned segments, one after another: counts of each, its groups as text, its links as pairs of ids."""

    def __init__(self, pair: Pair, sizes: np.ndarray, a: np.ndarray, b: np.ndarray):
        """``sizes``: bytes of the segments, their first space included; ``a`` and ``b``: the ids that cover them."""
        a_begins = np.concatenate([[0], np.cumsum(pair.a_sizes[a])])
        b_begins = np.concatenate([[0], np.cumsum(pair.b_sizes[b])])
        # Segments end where tokens of both end, so no link and no group leaves its block of the matrices.
        ends = np.concatenate([[0], np.cumsum(sizes)])
        a_first, b_first = np.searchsorted(a_begins, ends), np.searchsorted(b_begins, ends)
        linked = list(product(incidence(a_begins), incidence(b_begins).transposed()))
        rows, columns = (np.concatenate([x[k] for x in linked] or [np.zeros(0, np.int64)]) for k in range(2))
        self.links = (a[rows].astype(np.int64) << 32) | b[columns]
        link_first = np.searchsorted(rows, a_first)
        bounds = shared_ends(a_begins, b_begins)
        by_a, by_b = grouped(a_begins, bounds), grouped(b_begins, bounds)
        # Groups are apart, so every term of their product is an entry of its own and need not be formed to be counted.
        sharing = np.concatenate([[0], np.cumsum(row_terms(by_a.transposed(), by_b))])[a_first]
        group_first = np.searchsorted(bounds, ends)
        self.stats = np.diff(np.stack([a_first, b_first, group_first, link_first, sharing], axis=1), axis=0)
        # Tokens in order of group, A before B, each with the mark that follows it.
        places = np.concatenate([np.repeat(2 * np.arange(len(bounds) - 1), np.diff(by_a.begins)), np.repeat(2 * np.arange(len(bounds) - 1) + 1, np.diff(by_b.begins))])
        order = np.argsort(places, kind="stable")
        last = np.diff(places[order], append=-1) != 0
        token = np.concatenate([a, b + len(pair.a_sizes)])[order]
        text = "".join(map(pair.shown.__getitem__, (2 * token + last).tolist()))
        at = np.concatenate([[0], np.cumsum(pair.shown_sizes[2 * token + last])])[a_first + b_first].tolist()
        self.texts = [text[low : high - 1] for low, high in zip(at, at[1:])]


class Pair:
    """Two tokenizers, and how they cover the segments of texts."""

    def __init__(self, a: str, b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers
        import sentencepiece
        from tokenizers import Tokenizer

        def file(name: str) -> str:
            return name if os.sep in name else public_tokenizers.path(name)

        self.a = Tokenizer.from_file(file(a))
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=file(b))
        vocabulary = self.a.get_vocab(with_added_tokens=False)
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        letters = {chr(x): x for x in shown} | {chr(256 + i): x for i, x in enumerate(x for x in range(256) if x not in shown)}
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            if all(c in letters for c in token):
                self.a_bytes[i] = bytes(letters[c] for c in token)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.vocab_size())]
        self.b_bytes = [
            bytes([int(p[1:-1], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)
        ]
        # A piece that held a space after another character would reach over the beginning of a segment.
        self.splits = not any("▁" in p.lstrip("▁") for p in pieces)
        self.a_sizes = np.array([len(x) for x in self.a_bytes])
        self.b_sizes = np.array([len(x) for x in self.b_bytes])
        # Ids as text, before another token of their side and at the side's end.
        self.shown = [f"{i}{mark}" for i in range(len(self.a_bytes)) for mark in ",|"]
        self.shown += [f"{i}{mark}" for i in range(len(pieces)) for mark in ",;"]
        self.shown_sizes = np.array([len(x) for x in self.shown])

    def segments(self, text: str) -> list[str]:
        """The parts of ``" " + text``, each without its first space."""
        if not self.splits:
            return [text]
        # The first character follows the added space, and a space at the end begins no segment.
        single = not (text.endswith(" ") or text[0].isspace() or beside_blank(text))
        return text.split(" ") if single else lone_blanks(text)

    def covering(self, texts: list[str]) -> Iterator[tuple[bytes, np.ndarray, np.ndarray] | None]:
        """The bytes of the space and each text and the ids of both, ``None`` where their bytes are others."""
        for at in range(0, len(texts), AT_ONCE):
            part = texts[at : at + AT_ONCE]
            a_ids = self.a.encode_batch_fast([" " + t for t in part], add_special_tokens=False)
            for text, encoded, b in zip(part, a_ids, self.b.encode(part, num_threads=1)):
                plain, a = (" " + text).encode(), encoded.ids
                covered = b"".join(map(self.a_bytes.__getitem__, a)) == plain == b"".join(map(self.b_bytes.__getitem__, b))
                yield (plain, np.array(a, dtype=np.int32), np.array(b, dtype=np.int32)) if covered else None

    def aligned(self, segments: list[str]) -> tuple[Segments, np.ndarray]:
        """The alignment of those segments that the tokens cover, and every segment's place in it (-1: not covered).

        Segments without blanks at their ends are encoded many at a time, with
        the space that each begins with between them.
        """
        inner = [k for k, s in enumerate(segments) if s and not s[0].isspace() and not s[-1].isspace()] if self.splits else []
        alone = set(range(len(segments))).difference(inner)
        sizes, a, b, order = [], [], [], []
        parts = [inner[at : at + JOINED] for at in range(0, len(inner), JOINED)]
        for part, found in zip(parts, self.covering([" ".join([segments[k] for k in part]) for part in parts])):
            if found is None:
                alone.update(part)
                continue
            sizes += [len(segments[k].encode()) + 1 for k in part]
            order += part
            a.append(found[1])
            b.append(found[2])
        rest = sorted(alone)
        for k, found in zip(rest, self.covering([segments[k] for k in rest])):
            if found is not None:
                sizes.append(len(found[0]))
                order.append(k)
                a.append(found[1])
                b.append(found[2])
        places = np.full(len(segments), -1, dtype=np.int64)
        places[order] = np.arange(len(order))
        none = [np.zeros(0, np.int32)]
        return Segments(self, np.array(sizes, dtype=np.int64), np.concatenate(a or none), np.concatenate(b or none)), places

    def of_texts(self, texts: list[str | None]) -> tuple[Segments, list[np.ndarray]]:
        """The distinct segments of some texts, aligned, and every text's segments; none where the tokens do not give its bytes."""
        number: dict[str, int] = {}
        numbers = [
            np.array([number.setdefault(s, len(number)) for s in (self.segments(t) if t else ())], dtype=np.int64) for t in texts
        ]
        held, places = self.aligned(list(number))
        if (places < 0).any():
            # The whole text decides: bytes that one segment lacks could stand in another.
            whole = {t: None for t, x in zip(texts, numbers) if (places[x] < 0).any()}
            covered = {t for t, found in zip(whole, self.covering(list(whole))) if found is not None}
            for t in covered:
                number.setdefault(t, len(number))
            numbers = [
                x if not (places[x] < 0).any() else np.array([number[t]] if t in covered else [], dtype=np.int64)
                for t, x in zip(texts, numbers)
            ]
            held, places = self.aligned(list(number))
        return held, [places[x] for x in numbers]


_PAIRS: dict[tuple[str, str], Pair] = {}


def tokenizer_pair(a: str, b: str) -> Pair:
    if (a, b) not in _PAIRS:
        _PAIRS[a, b] = Pair(a, b)
    return _PAIRS[a, b]


STATS = ("n_a", "n_b", "n_groups", "n_links", "n_group_links")
BATCH = "batch string, doc_ids binary, stats binary, hashes string, doc_sizes binary, segments binary, link_sizes binary, links binary, pairs binary, times binary"


def aligned(docs: DataFrame, a: str = TOKENIZER_A, b: str = TOKENIZER_B) -> DataFrame:
    """Batches of documents: their counts, their segments by the batch's numbers, the segments' links by the numbers of its id pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = tokenizer_pair(a, b)
        for batch in joined(batches, BATCH_BYTES):
            held, split = pair.of_texts(batch.column(1).to_pylist())
            numbers = np.concatenate(split)
            each = held.stats
            doc_sizes = np.array([len(s) for s in split], dtype=np.int64)
            totals = np.concatenate([np.zeros((1, len(STATS)), np.int64), np.cumsum(each[numbers], axis=0)])
            ends = np.cumsum(doc_sizes)
            stats = totals[ends] - totals[ends - doc_sizes]
            hashes = [
                hashlib.sha256(";".join(map(held.texts.__getitem__, x.tolist())).encode()).hexdigest() if len(x) else "" for x in split
            ]
            keys, links = np.unique(held.links, return_inverse=True)
            times = np.repeat(np.bincount(numbers, minlength=len(each)), each[:, 3])
            count = np.bincount(links, times, len(keys)).astype(np.int64)  # exact below 2 ** 53
            row = [
                uuid.uuid4().hex, packed_ids(batch.column(0)), packed(stats.T.ravel()), ",".join(hashes), packed(doc_sizes),
                packed(numbers), packed(each[:, 3]), packed(links), keys.tobytes(), packed(count),
            ]
            kinds = (pa.string(), pa.binary(), pa.binary(), pa.string(), *[pa.binary()] * 6)
            yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], [c.split()[0] for c in BATCH.split(", ")])

    arrow_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, BATCH)


def pair_rows(batches: DataFrame) -> DataFrame:
    """Every batch's distinct id pairs, with its number of links and its place in the batch's list."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for r in part.itertuples():
                keys = np.frombuffer(r.pairs, np.int64)
                yield pd.DataFrame({
                    "batch": r.batch, "place": np.arange(len(keys), dtype=np.int32), "a": (keys >> 32).astype(np.int32),
                    "b": (keys & 0xFFFFFFFF).astype(np.int32), "times": unpacked(r.times).astype(np.int64),
                })

    return batches.select("batch", "pairs", "times").mapInPandas(run, "batch string, place int, a int, b int, times long")


def pair_counts(rows: DataFrame) -> DataFrame:
    """``a``, ``b``, ``n`` links in the whole corpus, and whether no other partner of ``b`` has more."""
    counts = store(rows.groupBy("a", "b").agg(F.sum("times").alias("n")), "pair-counts")
    # One row per id of the second vocabulary, whatever the corpus.
    top = F.broadcast(counts.groupBy("b").agg(F.max("n").alias("top")))
    return counts.join(top, "b").select("a", "b", "n", (F.col("n") == F.col("top")).alias("best"))


def sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Exact sums of consecutive runs."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    ends = np.cumsum(sizes)
    return total[ends] - total[ends - sizes]


ALIGNED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string, n_group_links long"


def finish(batch: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
    r = batch.iloc[0]
    places = answers["place"].to_numpy()
    counts, best = np.zeros(len(places), np.int64), np.zeros(len(places), np.int64)
    counts[places], best[places] = answers["n"], answers["best"]
    doc_sizes, links = unpacked(r["doc_sizes"]).astype(np.int64), unpacked(r["links"])
    numbers, link_sizes = unpacked(r["segments"]), unpacked(r["link_sizes"]).astype(np.int64)
    ids = unpacked_ids(r["doc_ids"])
    found = dict(zip(STATS, unpacked(r["stats"]).astype(np.int64).reshape(len(STATS), len(ids))))
    return pd.DataFrame({
        "doc_id": ids, **{c: found[c] for c in STATS[:4]},
        "n_best": sums(sums(best[links], link_sizes)[numbers], doc_sizes),
        "count_sum": sums(sums(counts[links], link_sizes)[numbers], doc_sizes),
        "groups_sha256": r["hashes"].split(","), "n_group_links": found["n_group_links"],
    })


def align(docs: DataFrame, a: str = TOKENIZER_A, b: str = TOKENIZER_B) -> DataFrame:
    """One row per row of ``docs`` (``doc_id``, ``text``): tokens, groups and links of both tokenizers."""
    batches = store(aligned(docs, a, b), "alignments")
    rows = pair_rows(batches)
    answers = rows.join(pair_counts(rows), ["a", "b"]).select("batch", "place", "n", "best")
    return batches.drop("pairs", "times").groupBy("batch").cogroup(answers.groupBy("batch")).applyInPandas(finish, ALIGNED)


LINKS = "doc_id long, a_token int, b_token int, a_id int, b_id int, n_bytes int"


def links(docs: DataFrame, a: str = TOKENIZER_A, b: str = TOKENIZER_B) -> DataFrame:
    """The overlap links themselves: which token occurrences share how many bytes of which document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = tokenizer_pair(a, b)
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = next(pair.covering([text])) if text else None
                if found is None:
                    continue
                _, x, y = found
                begins = [np.concatenate([[0], np.cumsum(size[t])]) for size, t in ((pair.a_sizes, x), (pair.b_sizes, y))]
                for rows, columns, values in product(incidence(begins[0]), incidence(begins[1]).transposed()):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([doc_id] * len(rows), pa.int64())]
                        + [pa.array(v.astype(np.int32)) for v in (rows, columns, x[rows], y[columns], values)],
                        [c.split()[0] for c in LINKS.split(", ")],
                    )

    arrow_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, LINKS)

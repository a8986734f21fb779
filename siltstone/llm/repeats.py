"""Exact removal of repeated passages by merged, sampled Burrows-Wheeler transforms.

Every byte covered by a string of ``LENGTH`` bytes that also starts elsewhere is
removed.  Suffixes are sampled where winnowing puts an anchor: of the 101 hashes
of 100-byte strings inside a window of 200 bytes, the smallest.  Equal windows
have equal anchors at equal places, so two windows are equal if the suffixes at
their anchors share enough bytes and so do the bytes before the anchors - the
transform's preceding symbols, here a whole preceding context.

Batches of documents are the shards of the transform.  Each sends the hashes of
its anchors and of the text around them, once per batch; most anchors turn out
unique or repeated as a whole.  Only where one anchor has several surroundings
are their bytes sent, and the suffix orders of all batches are merged: the
interleave starts with one block per anchor and is refined by one byte column at
a time, each batch's own order kept, and the step at which two neighbours part is
their common prefix.  Windows at distance ``d`` before an anchor repeat inside the
intervals with common prefixes of ``LENGTH - d`` and preceding contexts of ``d``.

An anchor with more than ``SURROUNDINGS`` different surroundings would make one
task large; for those alone the windows themselves are hashed and counted.

Defined results: a null text is empty; texts under 200 bytes keep all; repeated
rows count as occurrences; an empty table gives an empty result; other columns
are not read.
"""

from __future__ import annotations

import hashlib
import math
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.blobs import by_shard, from_low_bytes, joined, loosened, low_bytes, packed, packed_ids, squeezed, unpacked, unpacked_ids
from siltstone.llm.common import arrow_batches, store
from siltstone.llm.words import _BASE, _INVERSE, _powers, column_bytes, mix, row_chunks

LENGTH = 200
GRAM = 100
BATCH_BYTES = 3_000_000
SHARD_ANCHORS = 300_000
SURROUNDINGS = 4096
SLICE = 1 << 19

_INDEX = np.uint64((1 << 20) - 1)
_WINDOWS = LENGTH - GRAM + 1
ANCHOR_BYTES, AROUND_BYTES = 6, 7
WHOLE, SEND, HASH = 1, 2, 4  # codes of an anchor: repeated as a whole, bytes wanted, window hashes wanted


def prefix_sums(flat: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(flat) + 1, dtype=np.uint64)
    np.cumsum((flat.astype(np.uint64) + np.uint64(1)) * _powers(_BASE, len(flat)), out=sums[1:])
    return sums


def string_hashes(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the byte ranges, before mixing."""
    return (sums[end] - sums[start]) * _powers(_INVERSE, len(sums))[start]


def sampled(flat: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """Runs of windows with one anchor: first window, number of windows, anchor, hashes of the anchor and of all bytes touched."""
    sums = prefix_sums(flat)
    n = len(flat) - LENGTH + 1
    none = np.zeros(0, dtype=np.int64)
    if n <= 0:
        return {"first": none, "count": none, "anchor": none, "hash": none.astype(np.uint64), "around": none.astype(np.uint64), "sums": sums}
    gram = mix((sums[GRAM:] - sums[:-GRAM]) * _powers(_INVERSE, len(flat) - GRAM + 1))
    anchor = np.empty(n, dtype=np.int64)
    for low in range(0, n, SLICE):
        high = min(n, low + SLICE)
        part = gram[low : high + _WINDOWS - 1]
        least = part & ~_INDEX | np.arange(len(part), dtype=np.uint64)  # equal hashes: the leftmost
        width = 1
        while 2 * width <= _WINDOWS:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        rest = _WINDOWS - width
        if rest:
            least = np.minimum(least[: len(least) - rest], least[rest:])
        anchor[low:high] = (least & _INDEX).astype(np.int64) + low
    outside = np.zeros(len(flat) + 1, dtype=np.int32)  # windows that would leave their document
    np.add.at(outside, np.maximum(offsets[:-1], offsets[1:] - LENGTH + 1), 1)
    np.add.at(outside, offsets[1:], -1)
    inside = np.cumsum(outside)[:n] == 0
    change = np.ones(n + 1, dtype=bool)
    change[1:-1] = (anchor[1:] != anchor[:-1]) | (inside[1:] != inside[:-1])
    first = np.flatnonzero(inside & change[:-1])
    last = np.flatnonzero(inside & change[1:])
    at = anchor[first]
    around = string_hashes(sums, first, last + LENGTH) + (last - first).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    around = mix(around + (at - first).astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
    return {
        "first": first, "count": last - first + 1, "anchor": at - first,
        "hash": gram[at] >> np.uint64(64 - 8 * ANCHOR_BYTES), "around": around >> np.uint64(64 - 8 * AROUND_BYTES), "sums": sums,
    }


def grouped(anchor: np.ndarray, around: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order by (anchor, around), where each distinct pair begins in it, and the pair of every entry."""
    order = np.lexsort((around, anchor))
    new = np.ones(len(order), dtype=bool)
    new[1:] = (anchor[order][1:] != anchor[order][:-1]) | (around[order][1:] != around[order][:-1])
    pair = np.empty(len(order), dtype=np.int64)
    pair[order] = np.cumsum(new) - 1
    return order, np.flatnonzero(new), pair


def anchor_shard(anchor: np.ndarray, shards: int) -> np.ndarray:
    return (mix(anchor) >> np.uint64(40)).astype(np.int64) % shards


TEXTS = "batch string, n_docs int, doc_ids binary, lengths binary, text binary, first binary, count binary, anchor binary, entries binary"


def batched(docs: DataFrame) -> DataFrame:
    """Batches of documents with their anchors; ``entries`` are the distinct (anchor, around) hashes and whether each occurs twice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in joined(batches, BATCH_BYTES):
            flat, offsets = column_bytes(batch.column(1))
            for low, high in row_chunks(offsets, BATCH_BYTES):
                part = offsets[low : high + 1] - offsets[low]
                text = flat[offsets[low] : offsets[high]]
                s = sampled(text, part)
                order, begins, _ = grouped(s["hash"], s["around"])
                twice = np.diff(np.append(begins, len(order))) > 1
                chosen = order[begins]
                entries = low_bytes(s["hash"][chosen], ANCHOR_BYTES) + low_bytes(s["around"][chosen], AROUND_BYTES) + np.packbits(twice).tobytes()
                row = [
                    uuid.uuid4().hex, high - low, packed_ids(batch.column(0).slice(low, high - low)), packed(np.diff(part)),
                    squeezed(text.tobytes()), packed(np.diff(s["first"], prepend=0)), packed(s["count"]), packed(s["anchor"]),
                    len(chosen).to_bytes(8, "little") + entries,
                ]
                kinds = (pa.string(), pa.int32(), *[pa.binary()] * 7)
                names = [c.split()[0] for c in TEXTS.split(", ")]
                yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], names)

    arrow_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, TEXTS)


def read_entries(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n = int.from_bytes(data[:8], "little")
    a, b = 8 + n * ANCHOR_BYTES, 8 + n * (ANCHOR_BYTES + AROUND_BYTES)
    twice = np.unpackbits(np.frombuffer(data[b:], np.uint8))[:n].astype(bool)
    return from_low_bytes(data[8:a], ANCHOR_BYTES), from_low_bytes(data[a:b], AROUND_BYTES), twice


ASKED = "batch string, shard int, anchors binary, arounds binary, twice binary"


def entry_rows(texts: DataFrame, shards: int) -> DataFrame:
    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for r in part.itertuples():
                anchor, around, twice = read_entries(r.entries)
                own = anchor_shard(anchor, shards)
                rows = [
                    (r.batch, s, low_bytes(anchor[m], ANCHOR_BYTES), low_bytes(around[m], AROUND_BYTES), packed(twice[m].astype(np.uint8)))
                    for s, m in by_shard(own)
                ]
                yield pd.DataFrame(rows, columns=[c.split()[0] for c in ASKED.split(", ")])

    return texts.select("batch", "entries").mapInPandas(run, ASKED)


def judge(part: pd.DataFrame, most: int) -> pd.DataFrame:
    """The code of every anchor of one shard, in the order each batch asked."""
    anchors = [from_low_bytes(a, ANCHOR_BYTES) for a in part["anchors"]]
    anchor = np.concatenate(anchors)
    around = np.concatenate([from_low_bytes(a, AROUND_BYTES) for a in part["arounds"]])
    weight = 1 + np.concatenate([unpacked(t) for t in part["twice"]]).astype(np.int64)
    order, begins, pair = grouped(anchor, around)
    whole = np.add.reduceat(weight[order], begins) > 1
    owner = anchor[order[begins]]
    new = np.ones(len(begins), dtype=bool)
    new[1:] = owner[1:] != owner[:-1]
    number = np.cumsum(new) - 1
    surroundings = np.bincount(number)[number]
    wanted = np.where(surroundings == 1, 0, np.where(surroundings <= most, SEND, HASH))
    code = np.where(whole[pair], WHOLE, wanted[pair])
    leader = order[begins]  # one of equal surroundings sends for all
    code[leader] |= wanted
    cuts = np.cumsum([len(a) for a in anchors])[:-1]
    return pd.DataFrame({"batch": part["batch"].tolist(), "shard": part["shard"].to_numpy(), "codes": [packed(c) for c in np.split(code, cuts)]})


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
SECOND = (
    f"kind string, {RESULT}, batch string, shard int, n_docs int, doc_ids binary, lengths binary, text binary, known binary, "
    "first binary, counts binary, data binary, anchors binary, before binary, hashed binary"
)
RESULT_NAMES = [c.split()[0] for c in RESULT.split(", ")]


def cut_out(flat: np.ndarray, offsets: np.ndarray, repeated: np.ndarray, texts: bool) -> list[tuple]:
    """Sizes, spans and digest of every document, given the starts of repeated windows."""
    cover = np.zeros(len(flat) + 1, dtype=np.int32)
    np.add.at(cover, repeated, 1)
    np.add.at(cover, repeated + LENGTH, -1)
    gone = np.cumsum(cover[:-1]) > 0
    begins = gone.copy()
    begins[1:] &= ~gone[:-1]
    begins[offsets[:-1][offsets[:-1] < len(flat)]] |= gone[offsets[:-1][offsets[:-1] < len(flat)]]
    removed = np.concatenate([[0], np.cumsum(gone)])
    spans = np.concatenate([[0], np.cumsum(begins)])
    rows = []
    for low, high in zip(offsets[:-1], offsets[1:]):
        piece = flat[low:high]
        n = int(removed[high] - removed[low])
        kept = (piece[~gone[low:high]] if n else piece).tobytes()
        rows.append((int(high - low), n, int(spans[high] - spans[low]), hashlib.sha256(kept).hexdigest(), kept if texts else None))
    return rows


def run_starts(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """All windows of the given runs."""
    begin = np.cumsum(count) - count
    return np.repeat(first - begin, count) + np.arange(int(count.sum()))


def first_pass(batch: pd.DataFrame, answers: pd.DataFrame, shards: int, texts: bool) -> pd.DataFrame:
    """Finish the documents that need no comparison; of the others send what was asked for, and keep the text."""
    r = batch.iloc[0]
    name, flat, ids = r["batch"], loosened(r["text"]), unpacked_ids(r["doc_ids"])
    offsets = np.concatenate([[0], np.cumsum(unpacked(r["lengths"]).astype(np.int64))])
    entry_anchor, _, _ = read_entries(r["entries"])
    codes = np.zeros(len(entry_anchor), dtype=np.int64)
    places = dict(by_shard(anchor_shard(entry_anchor, shards)))
    for a in answers.itertuples():
        codes[places[a.shard]] = unpacked(a.codes)
    first, count = np.cumsum(unpacked(r["first"]).astype(np.int64)), unpacked(r["count"]).astype(np.int64)
    left = unpacked(r["anchor"]).astype(np.int64)
    sends, whole = np.zeros(len(first), np.int64), np.zeros(len(first), bool)
    if codes.any():
        s = sampled(flat, offsets)
        order, begins, entry = grouped(s["hash"], s["around"])
        whole = codes[entry] & WHOLE > 0
        lead = order[begins]  # of equal runs of one batch the first sends
        sends[lead] = codes & (SEND | HASH)
    waiting = (sends > 0) & ~whole
    doc = np.searchsorted(offsets, first, "right") - 1
    open_docs = np.zeros(len(ids), dtype=bool)
    open_docs[doc[waiting]] = True
    rows: list[dict] = [
        {"kind": "done", "doc_id": ids[i], **dict(zip(RESULT_NAMES[1:], row))}
        for i, row in enumerate(cut_out(flat, offsets, run_starts(first[whole], count[whole]), texts)) if not open_docs[i]
    ]
    # Open documents are closed up; their runs move with them.  0 stands for a run that waits for nothing.
    keep = np.flatnonzero(open_docs)
    lengths = np.diff(offsets)[keep]
    moved = np.zeros(len(ids), np.int64)
    moved[keep] = offsets[keep] - (np.cumsum(lengths) - lengths)
    to = np.where(waiting, first - moved[doc] + 1, 0)
    sent, hashed = [], []
    m = np.flatnonzero(sends & SEND)
    m = m[np.argsort(s["hash"][m], kind="stable")] if len(m) else m
    for shard, places in by_shard(anchor_shard(s["hash"][m], shards)) if len(m) else ():
        runs = m[places]
        rows.append({
            "kind": "bytes", "batch": name, "shard": shard, "data": squeezed(flat[run_starts(first[runs], count[runs] + LENGTH - 1)].tobytes()),
            "anchors": low_bytes(s["hash"][runs], ANCHOR_BYTES), "before": packed(left[runs]), "counts": packed(count[runs]),
        })
        sent.append(runs)
    m = np.flatnonzero(sends & HASH)
    if len(m):
        starts, of = run_starts(first[m], count[m]), np.repeat(m, count[m])
        key = mix(string_hashes(s["sums"], starts, starts + LENGTH))
        moved_to = np.where(waiting[of], starts - moved[doc[of]] + 1, 0)
        for shard, places in by_shard(anchor_shard(key, shards)):
            rows.append({
                "kind": "hashes", "batch": name, "shard": shard, "data": key[places].tobytes(),
                "anchors": low_bytes(s["hash"][of[places]], ANCHOR_BYTES),
            })
            hashed.append(moved_to[places])
    if len(keep):
        runs = np.concatenate(sent) if sent else np.zeros(0, np.int64)
        known = np.flatnonzero(whole & open_docs[doc])
        rows.append({
            "kind": "open", "batch": name, "n_docs": len(keep), "doc_ids": packed_ids(pa.array(ids[keep], pa.int64(), from_pandas=True)),
            "lengths": packed(lengths), "text": squeezed(np.concatenate([flat[offsets[i] : offsets[i + 1]] for i in keep]).tobytes()),
            "known": packed(run_starts(first[known] - moved[doc[known]], count[known])),
            "first": packed(to[runs]), "counts": packed(count[runs]), "hashed": packed(np.concatenate(hashed) if hashed else runs[:0]),
        })
    names = [c.split()[0] for c in SECOND.split(", ")]
    return pd.DataFrame({c: pd.Series([row.get(c) for row in rows], dtype=object) for c in names})


def refined(block: np.ndarray, column, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The merged order of suffixes and the common prefix of each with the one before it (-1 between blocks).

    ``column(which, t)`` gives byte ``t`` of suffixes, -1 past their end.  Every
    step splits the blocks of the interleave by one more byte, in a stable way.
    """
    order = np.argsort(block, kind="stable")
    block = block[order]
    common = np.full(len(order), depth, dtype=np.int64)
    new = np.ones(len(order), dtype=bool)
    new[1:] = block[1:] != block[:-1]
    common[new] = -1
    at = np.arange(len(order))
    number = np.cumsum(new)
    for t in range(depth):
        alone = np.ones(len(at) + 1, dtype=bool)
        alone[1:-1] = number[1:] != number[:-1]
        kept = ~(alone[:-1] & alone[1:])  # a block of one suffix is settled
        if not kept.all():
            at, number = at[kept], number[kept]
        if not len(at):
            break
        suffixes = order[at]
        key = number * 257 + (column(suffixes, t) + 1)
        if (key[1:] < key[:-1]).any():
            inner = np.argsort(key, kind="stable")
            order[at], key = suffixes[inner], key[inner]
        split = np.zeros(len(at), dtype=bool)
        split[1:] = (key[1:] != key[:-1]) & (number[1:] == number[:-1])
        common[at[split]] = t
        changed = np.ones(len(at), dtype=bool)
        changed[1:] = key[1:] != key[:-1]
        number = np.cumsum(changed)
    return order, common


REPLY = "batch string, kind string, shard int, n long, bits binary"


def replies(part: pd.DataFrame, cuts: np.ndarray, flags: np.ndarray, kind: str) -> pd.DataFrame:
    own = np.split(flags, cuts)
    return pd.DataFrame({
        "batch": part["batch"].tolist(), "kind": [kind] * len(part), "shard": part["shard"].to_numpy(),
        "n": [len(f) for f in own], "bits": [np.packbits(f).tobytes() for f in own],
    })


def merge(part: pd.DataFrame) -> pd.DataFrame:
    """Which windows of one shard's runs repeat: merged suffix orders, common prefixes and repeated intervals."""
    bodies = [loosened(d) for d in part["data"]]
    flat = np.concatenate(bodies)
    anchor = np.concatenate([from_low_bytes(a, ANCHOR_BYTES) for a in part["anchors"]])
    left = np.concatenate([unpacked(b) for b in part["before"]]).astype(np.int64)
    each = [unpacked(c).astype(np.int64) for c in part["counts"]]
    count = np.concatenate(each)
    size = count + LENGTH - 1
    begin = np.cumsum(size) - size
    at, after = begin + left, size - left

    def following(which: np.ndarray, t: int) -> np.ndarray:
        return np.where(t < after[which], flat[np.minimum(at[which] + t, len(flat) - 1)].astype(np.int64), -1)

    def preceding(which: np.ndarray, t: int) -> np.ndarray:
        return np.where(t < left[which], flat[np.maximum(at[which] - 1 - t, 0)].astype(np.int64), -1)

    order, common = refined(anchor, following, LENGTH)
    back, shared = refined(anchor, preceding, LENGTH - GRAM)
    window = np.cumsum(count) - count
    flags = np.zeros(int(count.sum()), dtype=bool)
    right_class, left_class = np.empty(len(count), np.int64), np.empty(len(count), np.int64)
    for d in range(LENGTH - GRAM + 1):
        k = left - d
        runs = np.flatnonzero((k >= 0) & (k < count))
        if len(runs) > 1:
            right_class[order] = np.cumsum(common < LENGTH - d)
            left_class[back] = np.cumsum(shared < d)
            _, where, times = np.unique(right_class[runs] * (len(count) + 1) + left_class[runs], return_inverse=True, return_counts=True)
            flags[window[runs] + k[runs]] = times[where] > 1
    return replies(part, np.cumsum([int(c.sum()) for c in each])[:-1], flags, "bytes")


def count_hashes(part: pd.DataFrame) -> pd.DataFrame:
    """Which windows of one shard of hashes occur twice."""
    lists = [np.frombuffer(d, np.uint64) for d in part["data"]]
    key = np.concatenate(lists)
    order, begins, pair = grouped(key, np.concatenate([from_low_bytes(a, ANCHOR_BYTES) for a in part["anchors"]]))
    times = np.diff(np.append(begins, len(order)))
    return replies(part, np.cumsum([len(x) for x in lists])[:-1], times[pair] > 1, "hashes")


def finish(batch: pd.DataFrame, answers: pd.DataFrame, texts: bool) -> pd.DataFrame:
    """The documents that waited."""
    r = batch.iloc[0]
    offsets = np.concatenate([[0], np.cumsum(unpacked(r["lengths"]).astype(np.int64))])
    flags = {"bytes": [np.zeros(0, bool)], "hashes": [np.zeros(0, bool)]}
    for a in answers.sort_values("shard").itertuples():
        flags[a.kind].append(np.unpackbits(np.frombuffer(a.bits, np.uint8))[: a.n].astype(bool))
    first, count = unpacked(r["first"]).astype(np.int64), unpacked(r["counts"]).astype(np.int64)
    starts = run_starts(first, count)
    starts = starts[np.concatenate(flags["bytes"]) & np.repeat(first > 0, count)] - 1
    hashed = unpacked(r["hashed"]).astype(np.int64)
    hashed = hashed[np.concatenate(flags["hashes"]) & (hashed > 0)] - 1
    repeated = np.concatenate([unpacked(r["known"]).astype(np.int64), starts, hashed])
    found = cut_out(loosened(r["text"]), offsets, repeated, texts)
    ids = unpacked_ids(r["doc_ids"])
    rows = list(zip(*[(i, *row) for i, row in zip(ids, found)]))
    return pd.DataFrame({c: pd.Series(v, dtype=object) for c, v in zip(RESULT_NAMES, rows)})


def without_repeats(docs: DataFrame, texts: bool = False, surroundings: int = SURROUNDINGS) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256`` and, if ``texts``, the ``kept`` bytes of every row."""
    stored = store(batched(docs), "texts")
    anchors = stored.agg(F.sum(F.octet_length("entries"))).first()[0] or 0
    shards = max(4, math.ceil(anchors / (ANCHOR_BYTES + AROUND_BYTES) / SHARD_ANCHORS))
    judged = entry_rows(stored, shards).groupBy("shard").applyInPandas(
        lambda part: judge(part, surroundings), "batch string, shard int, codes binary"
    )
    second = store(
        stored.groupBy("batch").cogroup(judged.groupBy("batch")).applyInPandas(
            lambda b, a: first_pass(b, a, shards, texts), SECOND
        ), "compared",
    )
    merged = second.where("kind = 'bytes'").groupBy("shard").applyInPandas(merge, REPLY)
    counted = second.where("kind = 'hashes'").groupBy("shard").applyInPandas(count_hashes, REPLY)
    waiting = second.where("kind = 'open'")
    last = waiting.groupBy("batch").cogroup(merged.unionByName(counted).groupBy("batch")).applyInPandas(
        lambda b, a: finish(b, a, texts) if len(b) else pd.DataFrame({c: pd.Series(dtype=object) for c in RESULT_NAMES}), RESULT
    )
    done = second.where("kind = 'done'").select(*RESULT_NAMES).unionByName(last)
    return done if texts else done.drop("kept")

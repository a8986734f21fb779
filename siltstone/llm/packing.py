"""Best-fit packing of documents into token sequences by bin completion.

A piece is described by its length alone, so the packing is planned on the
histogram of lengths (at most ``capacity`` numbers, whatever the corpus): a bin
is built around the largest length left, its undominated fillings are
enumerated, and the search is cut off by the waste it may still spend.  The plan
is a short list of patterns; pieces take their places by their rank among the
pieces of equal length, as a join.

Defined results: a null text is empty and becomes the end id alone; repeated
rows are packed each; an empty table gives an empty result.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.common import arrow_batches, numbered, store

CAPACITY = 1024
END_ID = 2
TOKENIZER = "byte_bpe_50k.json"
SALT_ROWS = 1_000_000  # pieces of one length that one task ranks
MIN_SALTS = 64
CACHED_WORDS = 300_000
SEARCH_NODES = 2_000

_BESIDE_BLANK = re.compile(r"\s | \s")
_RARE_BLANKS = [c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n"]
_LONE_BLANK = re.compile(r"(?<=\S) (?=\S)")
# ASCII, and blocks whose characters are letters, numbers, marks or signs in every edition of Unicode: here a pattern has one reading.
_ONE_READING = re.compile(
    "[\0-\x7f\xa1-\u01bf\u0391-\u03a1\u03a3-\u03ce\u0400-\u0481\u05d0-\u05ea\u0621-\u063a\u0641-\u064a\u2010-\u2027\u2030-\u2046"
    "\u3001-\u3003\u3041-\u3094\u30a1-\u30fa\u4e00-\u9fa5\uac00-\ud7a3]*"
)


def beside_blank(text: str) -> bool:
    """Whether a space stands next to other white space; plain lookups spare most texts the pattern."""
    if "  " in text or " \n" in text or "\n " in text:
        return True
    return any(c in text for c in _RARE_BLANKS) and bool(_BESIDE_BLANK.search(text))


def merge_encoder(described: dict, pattern: str) -> Callable[[str], list[int]] | None:
    """A faster encoder with the same vocabulary, where the described tokenizer allows it.

    It must be plain byte-level pair merging whose ids are numbered in the order
    of the merges; texts are left to it where the pattern has one reading.
    """
    model, before = described["model"], described.get("pre_tokenizer") or {}
    plain = before.get("type") == "ByteLevel" and before.get("use_regex") and not before.get("add_prefix_space")
    if not plain or described.get("normalizer") or model.get("type") != "BPE" or model.get("continuing_subword_prefix") or model.get("dropout"):
        return None
    merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    made = [model["vocab"]["".join(m)] for m in merges]
    if made != sorted(set(made)) or len(made) + 256 > len(model["vocab"]):
        return None
    import tiktoken

    # Byte-level vocabularies write printable bytes as themselves and the others from U+0100 on.
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in shown)}
    added = {t["content"] for t in described.get("added_tokens") or ()}
    ranks = {bytes(letters[c] for c in token): i for token, i in model["vocab"].items() if token not in added}
    return tiktoken.Encoding("words", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


def lone_blanks(text: str) -> list[str]:
    """``text`` cut at every space that stands between two other characters."""
    return _LONE_BLANK.split(text)


class Encoder:
    """Ids of whole texts as little-endian 32-bit bytes.

    Texts of plain characters go through a faster encoder whole.  In others a
    single space between two other characters always starts a new pretoken, so
    they are encoded word by word and words are remembered; what stands at other
    white space stays together.
    """

    def __init__(self, tokenizer: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers
        from tokenizers import Tokenizer

        file = tokenizer if os.sep in tokenizer else public_tokenizers.path(tokenizer)
        self.tokenizer = Tokenizer.from_file(file)
        self.known: dict[str, bytes] = {}
        with open(file, encoding="utf-8") as f:
            described = json.load(f)
        self.added = [t["content"] for t in described.get("added_tokens") or ()]
        self.merged = merge_encoder(described, public_tokenizers.PATTERN)

    def _plain(self, text: str) -> bool:
        """Whether the faster encoder reads ``text`` alike."""
        if not self.merged or any(t in text for t in self.added):
            return False
        return text.isascii() or bool(_ONE_READING.fullmatch(text))

    def _ids(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array("I", e.ids).tobytes() for e in found]

    def _learn(self, words: list[str]) -> None:
        """Remember the ids of new words that follow a space."""
        rest = []
        for w in words:
            if self._plain(w):
                self.known[w] = array("I", self.merged(" " + w)).tobytes()
            else:
                rest.append(w)
        for at in range(0, len(rest), 10_000):
            part = rest[at : at + 10_000]
            self.known.update(zip(part, self._ids([" " + w for w in part])))

    def encode(self, texts: list[str]) -> list[bytes]:
        plain = [self._plain(t) for t in texts]
        rest = iter(self._by_words([t for t, p in zip(texts, plain) if not p]))
        return [array("I", self.merged(t)).tobytes() if p else next(rest) for t, p in zip(texts, plain)]

    def _by_words(self, texts: list[str]) -> list[bytes]:
        split = [lone_blanks(t) if beside_blank(t) else t.split(" ") for t in texts]
        new = set()
        for words in split:
            new.update(words[1:])
        if len(self.known) > CACHED_WORDS:
            self.known.clear()
        self._learn([w for w in new if w not in self.known])
        known = self.known
        return [
            first + b"".join([known[w] for w in words[1:]])
            for first, words in zip(self._ids([words[0] for words in split]), split)
        ]


_ENCODERS: dict[str, Encoder] = {}


def encoder(tokenizer: str) -> Encoder:
    if tokenizer not in _ENCODERS:
        _ENCODERS[tokenizer] = Encoder(tokenizer)
    return _ENCODERS[tokenizer]


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """``(start, length)`` of the pieces of ``n`` ids: only the first may be shorter than ``capacity``."""
    first = n % capacity or min(n, capacity)
    return [(0, first)] + [(at, capacity) for at in range(first, n, capacity)]


PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, tokenizer: str = TOKENIZER, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """The pieces of every document: ``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32``."""
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).encode
        for batch in batches:
            rows = []
            for doc_id, ids in zip(batch.column(0).to_pylist(), encode([t or "" for t in batch.column(1).to_pylist()])):
                ids += end
                for k, (start, n) in enumerate(cut(len(ids) // 4, capacity)):
                    rows.append((doc_id, k, start, n, zlib.crc32(memoryview(ids)[4 * start : 4 * (start + n)])))
            columns = list(zip(*rows)) if rows else [()] * 5
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], ["doc_id", "piece", "start", "length", "ids_crc32"]
            )

    arrow_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, PIECES)


def lower_bound(counts: list[int], capacity: int) -> int:
    """No packing needs fewer bins: total size, or pieces that cannot share one plus what does not fit beside them."""
    total = sum(size * n for size, n in enumerate(counts))
    best = -(-total // capacity)
    for k in range(1, capacity // 2 + 1):
        alone = sum(counts[capacity - k + 1 :])
        half = sum(counts[capacity // 2 + 1 : capacity - k + 1])
        free = half * capacity - sum(s * counts[s] for s in range(capacity // 2 + 1, capacity - k + 1))
        small = sum(s * counts[s] for s in range(k, capacity // 2 + 1))
        best = max(best, alone + half + max(0, -(-(small - free) // capacity)))
    return best


def fillings(room: int, counts: list[int], sizes: list[int], width: int = 6, effort: int = 60) -> list[tuple[int, ...]]:
    """Undominated fillings of ``room``: maximal ones, least waste first, then fewest pieces."""
    found: list[tuple[int, ...]] = []
    tried = 0

    def walk(left: int, at: int, chosen: tuple[int, ...]) -> None:
        nonlocal tried
        tried += 1
        if left and counts[left] > chosen.count(left):
            found.append((*chosen, left))
            return
        grew = False
        for i in range(at, len(sizes)):
            size = sizes[i]
            if size > left or counts[size] <= chosen.count(size):
                continue
            grew = True
            walk(left - size, i, (*chosen, size))
            if tried > effort or len(found) >= 4 * width:
                return
        if not grew and chosen:
            found.append(chosen)

    walk(room, 0, ())
    kept: list[tuple[int, ...]] = []
    for f in sorted({tuple(sorted(f, reverse=True)) for f in found}, key=lambda f: (room - sum(f), len(f), [-s for s in f])):
        # dominated: another filling holds a piece at least as large for each of its pieces
        if not any(len(k) >= len(f) and all(a >= b for a, b in zip(k, f)) for k in kept):
            kept.append(f)
    return kept[:width] or [()]


Plan = list[tuple[int, tuple[int, ...]]]


def best_fit(counts: list[int], capacity: int) -> Plan:
    """Best-fit decreasing on the histogram: equal bins are built together."""
    counts = list(counts)
    plan: Plan = []
    for top in range(capacity, 0, -1):
        while counts[top]:
            bin_, left = [top], capacity - top
            size = left
            while size:
                room = counts[size] - bin_.count(size)
                take = min(left // size, room)
                if take > 0:
                    bin_ += [size] * take
                    left -= take * size
                size = min(size - 1, left)
            times = min(counts[s] // bin_.count(s) for s in set(bin_))
            for s in bin_:
                counts[s] -= times
            plan.append((times, tuple(bin_)))
    return plan


def bins(plan: Plan) -> int:
    return sum(times for times, _ in plan)


def plan_bins(counts: list[int], capacity: int, nodes: int = SEARCH_NODES) -> Plan:
    """Patterns ``(times, sizes)`` that hold ``counts[size]`` pieces of every size.

    Depth-first over the fillings around the largest size left.  A branch ends
    when its waste exceeds what a packing better than the incumbent may waste.
    The incumbent starts as best-fit; the search stops at the lower bound or
    after ``nodes`` bins tried, so the plan is always complete.  It is not
    exhaustive below that either: a bin has at most three fillings to branch on,
    one from 40 patterns on, they come from some 60 steps of enumeration or 12
    found (4 when one is taken), and a pattern is used as often as it fits.
    """
    best = best_fit(counts, capacity)
    bound = lower_bound(counts, capacity)
    total = sum(size * n for size, n in enumerate(counts))
    stack: list[tuple[list[int], Plan, int, int]] = [(list(counts), [], 0, 0)]
    while stack and nodes > 0 and bins(best) > bound:
        left, plan, used, waste = stack.pop()
        while True:
            allowed = (bins(best) - 1) * capacity - total
            if waste > allowed:
                break
            sizes = [s for s in range(capacity, 0, -1) if left[s]]
            if not sizes:
                if used < bins(best):
                    best = plan
                break
            nodes -= 1
            if nodes < 0:
                break
            top = sizes[0]
            left[top] -= 1
            options = fillings(capacity - top, left, sizes, 3 if len(plan) < 40 else 1)
            left[top] += 1
            branches = []
            for f in options:
                bin_ = (top, *f)
                times = min(left[s] // bin_.count(s) for s in set(bin_))
                branches.append((times, bin_, waste + times * (capacity - sum(bin_))))
            for times, bin_, spent in reversed(branches[1:]):
                if spent <= allowed:
                    other = list(left)
                    for s in bin_:
                        other[s] -= times
                    stack.append((other, [*plan, (times, bin_)], used + times, spent))
            times, bin_, waste = branches[0]
            for s in bin_:
                left[s] -= times
            plan = [*plan, (times, bin_)]
            used += times
    return best


def segments(plan: Plan) -> list[tuple[int, int, int, int, int, int]]:
    """``(length, first rank, end rank, first bin, pieces per bin, offset)`` for every size of every pattern."""
    rank: dict[int, int] = {}
    rows = []
    first = 0
    for times, sizes in plan:
        offset = 0
        for size in sorted(set(sizes), reverse=True):
            each = sizes.count(size)
            start = rank.get(size, 0)
            rank[size] = start + times * each
            rows.append((size, start, rank[size], first, each, offset))
            offset += each * size
        first += times
    return rows


def pack(cut_pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``cut_pieces`` with ``sequence_id`` and ``offset``, in as few sequences as the search finds."""
    spark = cut_pieces.sparkSession
    spread = F.xxhash64(F.monotonically_increasing_id()).alias("spread")
    stored = store(cut_pieces.select("*", spread), "pieces")
    counts = [0] * (capacity + 1)
    for length, n in stored.groupBy("length").count().collect():  # at most ``capacity`` rows
        counts[length] = n
    places = spark.createDataFrame(
        segments(plan_bins(counts, capacity)) or [(0, 0, 0, 0, 1, 0)],
        "length long, low long, high long, first long, each long, at long",
    )
    salts = max(MIN_SALTS, -(-max(counts) // SALT_ROWS))
    salted = stored.withColumn("salt", F.pmod("spread", F.lit(salts)).cast("int")).drop("spread")
    ranked = numbered(salted, "length", "salt", "rank")
    k = F.col("rank") - F.col("low")
    return (
        ranked.join(F.broadcast(places), "length")  # a few rows per length, bounded by the patterns
        .where("rank >= low AND rank < high")
        .select(
            "doc_id", "piece", "start", "length", "ids_crc32",
            F.expr("first + (rank - low) div each").alias("sequence_id"),
            (F.col("at") + F.pmod(k, F.col("each")) * F.col("length")).cast("long").alias("offset"),
        )
    )

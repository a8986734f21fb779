"""Language identification: the family first, then linear support vector machines between its languages.

Features are the relative frequencies of hashed byte 1- to 3-grams of the whole
lower-cased text.  A first level of one-versus-one machines picks the family; a
second level, one per pair of languages of that family, picks the language by
votes.  All machines are weight columns over the same n-grams, so a text is read
once.  Machines are fitted on a bounded, seeded sample of the labelled rows
(``SAMPLE_ROWS`` per language, ``FIT_ROWS`` in all); every text is predicted whole.

Defined results: a null text, or one without a letter, is ``und`` with score 0;
with a single learned language every other text has that one, with score 1; with
none learned all are ``und``.  Rows with null labels or ids are predicted, not
learned from.  Empty tables give empty results; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.llm.common import arrow_batches
from siltstone.llm.words import column_bytes

BUCKETS = 4096
SAMPLE_ROWS = 500
FIT_ROWS = 4000
SLICE = 400_000
UNKNOWN = "und"

# Families of the commoner language codes; any other code is a family of its own.
FAMILIES = {
    "germanic": "af da de en is lb nl no sv fy nb nn",
    "romance": "ca es fr gl it oc pt ro la",
    "slavic": "be bg bs cs hr mk pl ru sk sl sr uk",
    "baltic": "lt lv",
    "celtic": "br cy ga gd",
    "uralic": "et fi hu",
    "turkic": "az kk ky tr tk ug uz",
    "iranian": "fa ku ps tg",
    "indic": "as bn gu hi mr ne or pa sa si ur",
    "dravidian": "kn ml ta te",
    "semitic": "am ar he mt",
    "austronesian": "id jv mg ms su tl",
    "sinitic": "zh yue wuu",
}
_FAMILY = {code: family for family, codes in FAMILIES.items() for code in codes.split()}


def family(lang: str) -> str:
    """The family of a language code, whatever its region suffix."""
    return _FAMILY.get(lang.lower().replace("_", "-").split("-")[0], lang)


_MIX = tuple(np.uint32(x) for x in (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D))


def gram_buckets(flat: np.ndarray, starts: np.ndarray) -> list[np.ndarray]:
    """The bucket of the 1-, 2- and 3-gram that ends at every byte; none reaches over one of ``starts``, where texts begin."""
    shift = np.uint32(32 - 12)
    code = flat.astype(np.uint32)
    found = [(code + np.uint32(1)) * _MIX[0] >> shift]
    for n in (1, 2):
        code = code.copy()
        before = flat[:-n].astype(np.uint32) << np.uint32(8 * n)
        for k in range(n):
            foreign = starts + (k - n)
            before[foreign[(foreign >= 0) & (foreign < len(before))]] = 0
        code[n:] += before
        found.append((code * np.uint32(2) + np.uint32(n)) * _MIX[n] >> shift)
    return found


def _profile_slices(flat: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Buckets of slices of bytes, with the rows that begin or go on in each and where.

    A text is cut only if it is longer than a slice, and by its own length, so its sums do not depend on its neighbours.
    """
    low = int(offsets[0])
    while low < offsets[-1]:
        high = int(offsets[np.searchsorted(offsets, low + SLICE, "right") - 1])
        high = high if high > low else low + SLICE
        first = int(np.searchsorted(offsets, low, "right")) - 1
        last = int(np.searchsorted(offsets, high, "left"))
        rows = np.arange(first, last)
        rows = rows[offsets[rows + 1] > offsets[rows]]
        at = np.maximum(offsets[rows], low) - low
        back = min(low, 2)
        yield rows, at, [b[back:] for b in gram_buckets(flat[low - back : high], offsets[rows] - (low - back))]
        low = high


def profiles(flat: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Relative frequencies of the buckets, one row per text (zeros for an empty one)."""
    counts = np.zeros((len(offsets) - 1, BUCKETS), dtype=np.float32)
    for i in range(len(offsets) - 1):
        text = flat[offsets[i] : offsets[i + 1]]
        for low in range(0, len(text), SLICE):
            back = min(low, 2)
            for buckets in gram_buckets(text[low - back : low + SLICE], np.array([back - low])):
                counts[i] += np.bincount(buckets[back:], minlength=BUCKETS).astype(np.float32)
    return counts / np.maximum(counts.sum(axis=1, keepdims=True), 1)


def projected(flat: np.ndarray, offsets: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """``profiles @ weights`` without the profiles: weights summed over the n-grams of each text."""
    total = np.zeros((len(offsets) - 1, weights.shape[1]))
    for rows, at, buckets in _profile_slices(flat, offsets):
        if len(rows):
            each = weights[buckets[0]] + weights[buckets[1]] + weights[buckets[2]]
            total[rows] += np.add.reduceat(each, at, axis=0)
    return total / np.maximum(3 * np.diff(offsets), 1)[:, None]


def fit_machine(x: np.ndarray, y: np.ndarray, cost: float = 10.0, rounds: int = 60) -> tuple[np.ndarray, float]:
    """A linear machine (squared hinge loss, classes weighted alike) by Newton steps over its active rows.

    Each step is solved by conjugate gradients; ``x`` stays in single precision
    and is not copied.  The last weight belongs to a constant feature.
    """
    def forward(w: np.ndarray) -> np.ndarray:
        return (x @ w[:-1].astype(np.float32)).astype(np.float64) + w[-1]

    def backward(v: np.ndarray) -> np.ndarray:
        return np.append((v.astype(np.float32) @ x).astype(np.float64), v.sum())

    balance = cost * np.where(y > 0, 1 / max(1, (y > 0).sum()), 1 / max(1, (y < 0).sum())) * len(y) / 2
    w = np.zeros(x.shape[1] + 1)
    for _ in range(12):
        margin = forward(w)
        weight = np.where(y * margin < 1, balance, 0.0)
        residual = -(w + backward(weight * (margin - y)))
        step, direction, size = np.zeros_like(w), residual.copy(), residual @ residual
        if size < 1e-8:
            break
        for _ in range(rounds):
            curved = direction + backward(weight * forward(direction))
            alpha = size / (direction @ curved)
            step += alpha * direction
            residual -= alpha * curved
            new = residual @ residual
            if new < 1e-7:
                break
            direction, size = residual + new / size * direction, new
        w = w + step
    return w[:-1], float(w[-1])


@dataclass
class Model:
    """Languages, families and the machines; column ``k`` of ``weights`` decides pair ``k`` of ``pairs``."""

    languages: list[str]
    weights: np.ndarray
    bias: np.ndarray
    pairs: list[tuple[str, str]]

    def vote(self, margins: np.ndarray, classes: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Winner and mean probability of its pairs among ``classes``, by votes, then by summed margins."""
        support = np.zeros((len(margins), len(classes)))
        votes = np.zeros_like(support)
        for k, (a, b) in enumerate(self.pairs):
            if a in classes and b in classes:
                i, j = classes.index(a), classes.index(b)
                sure = 1 / (1 + np.exp(-np.clip(2 * margins[:, k], -30, 30)))
                support[:, i] += sure
                support[:, j] += 1 - sure
                votes[:, i] += margins[:, k] >= 0
                votes[:, j] += margins[:, k] < 0
        best = (votes + support / (len(classes) + 1)).argmax(axis=1)
        return best, support[np.arange(len(margins)), best] / max(1, len(classes) - 1) if len(classes) > 1 else np.ones(len(margins))

    def predict(self, flat: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The language and the score of every text."""
        margins = projected(flat, offsets, self.weights) + self.bias
        families = sorted({family(code) for code in self.languages})
        chosen, sure = self.vote(margins, [f"family {f}" for f in families])
        named = np.empty(len(margins), dtype=object)
        score = np.zeros(len(margins))
        for i, f in enumerate(families):
            rows = np.flatnonzero(chosen == i)
            codes = [code for code in self.languages if family(code) == f]
            best, inner = self.vote(margins[rows], codes)
            named[rows] = np.array(codes, dtype=object)[best]
            score[rows] = sure[rows] * inner
        return named, score


def fit(x: np.ndarray, labels: list[str]) -> Model:
    """All machines of both levels from single-precision profiles (changed in place) and their labels."""
    languages = sorted(set(labels))
    label = np.array(labels, dtype=object)
    # Rare n-grams count as much as frequent ones.
    scale = (1 / (np.sqrt(np.einsum("ij,ij->j", x, x) / max(1, len(x))) + 1e-4) / np.sqrt(BUCKETS)).astype(np.float32)
    x *= scale
    families = {f: [c for c in languages if family(c) == f] for f in sorted({family(c) for c in languages})}
    tasks = [(f"family {a}", f"family {b}", families[a], families[b]) for a, b in combinations(families, 2)]
    tasks += [(a, b, [a], [b]) for codes in families.values() for a, b in combinations(codes, 2)]
    weights, bias = np.zeros((BUCKETS, max(1, len(tasks))), dtype=np.float32), np.zeros(max(1, len(tasks)))
    for k, (_, _, one, two) in enumerate(tasks):
        rows = np.flatnonzero(np.isin(label, one + two))
        w, bias[k] = fit_machine(x[rows], np.where(np.isin(label[rows], one), 1.0, -1.0))
        weights[:, k] = w * scale
    return Model(languages, weights, bias, [(a, b) for a, b, _, _ in tasks])


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def sampled(labelled: DataFrame, rows: int = SAMPLE_ROWS, most: int = FIT_ROWS) -> DataFrame:
    """About ``rows`` labelled texts per language and at most about ``most`` in all, chosen by a hash of the id."""
    counts = {lang: n for lang, n in labelled.groupBy("lang").count().collect()}  # one row per language
    each = min(rows, max(1, most // max(1, len(counts))))
    chance = F.pmod(F.xxhash64(F.lit("language sample"), "doc_id"), F.lit(1_000_003)) / 1_000_003
    share = F.lit(0.0)
    for lang, n in counts.items():
        share = F.when(F.col("lang") == lang, F.lit(min(1.0, each / n))).otherwise(share)
    return labelled.where(chance < share)


def learn(labelled: DataFrame, rows: int = SAMPLE_ROWS, most: int = FIT_ROWS) -> Model | None:
    """Fit on a sample of ``labelled`` (``doc_id``, ``text``, ``lang``); only the machines reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = profiles(*column_bytes(batch.column(0)))
            packed = [row.astype("<f4").tobytes() for row in x]
            yield pa.RecordBatch.from_arrays([pa.array(packed, pa.binary()), batch.column(1)], ["profile", "lang"])

    arrow_batches(labelled.sparkSession)
    def machines(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["lang", "profile"])
        x = np.frombuffer(b"".join(part["profile"]), "<f4").reshape(len(part), BUCKETS).copy()
        model = fit(x, part["lang"].tolist())
        rows = [(code, None, 0.0, None) for code in model.languages]
        rows += [(a, b, model.bias[k], model.weights[:, k].tobytes()) for k, (a, b) in enumerate(model.pairs)]
        return pd.DataFrame(rows, columns=["a", "b", "bias", "weights"])

    usable = labelled.where(F.col("lang").isNotNull()).where(has_letter(F.col("text")))
    sample = sampled(usable, rows, most).select(F.lower("text").alias("text"), "lang")
    profiled = sample.mapInArrow(run, "profile binary, lang string")
    # The sample is bounded, so one task fits all machines.
    found = profiled.withColumn("all", F.lit(0)).groupBy("all").applyInPandas(machines, "a string, b string, bias double, weights binary").collect()
    pairs = [r for r in found if r.b is not None]
    if not found:
        return None
    weights = np.stack([np.frombuffer(r.weights, np.float32) for r in pairs], axis=1) if pairs else np.zeros((BUCKETS, 1), np.float32)
    bias = np.array([r.bias for r in pairs]) if pairs else np.zeros(1)
    return Model([r.a for r in found if r.b is None], weights, bias, [(r.a, r.b) for r in pairs])


def predicted(docs: DataFrame, model: Model | None, *keep: str) -> DataFrame:
    """``keep`` columns with ``lang_pred`` and ``score`` for every row of ``docs``."""
    kept = [F.col(c) for c in keep]
    if model is None:
        return docs.select(*kept, F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            named, score = model.predict(*column_bytes(batch.column(len(keep))))
            none = ~np.asarray(batch.column(len(keep) + 1).to_numpy(zero_copy_only=False), dtype=bool)
            named[none], score[none] = UNKNOWN, 0.0
            columns = [*batch.columns[: len(keep)], pa.array(named, pa.string()), pa.array(np.clip(score, 0.0, 1.0))]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names[: len(keep)], "lang_pred", "score"])

    arrow_batches(docs.sparkSession)
    given = docs.select(*kept, F.lower("text").alias("_text"), has_letter(F.col("text")).alias("_letter"))
    schema = given.select(*keep, F.lit("").alias("lang_pred"), F.lit(0.0).alias("score")).schema
    for field in schema:
        field.nullable = True
    return given.mapInArrow(run, schema)


def fold(doc_id: Column, folds: int) -> Column:
    """The remainder of the CRC of the id as text; null for a null id."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(folds))


def identify(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``held_out``, ``lang_pred``, ``score``: learned from two folds of three, predicted for all."""
    held = F.coalesce(fold(F.col("doc_id"), 3) == 1, F.lit(False)).alias("held_out")
    marked = docs.select("doc_id", "text", "lang", held)
    model = learn(marked.where("NOT held_out"))
    return predicted(marked, model, "doc_id", "held_out")

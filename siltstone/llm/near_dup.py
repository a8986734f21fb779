"""Near-duplicate documents: SuperMinHash signatures, banding, verification, connected components.

Signatures (Ertl, "SuperMinHash", 2017): each element of a set walks through a
random permutation of the signature's places, the value at step ``j`` lies in
``[j, j+1)``, and the walk of a whole set stops once every place holds a value
below the step.  Places of one set are thus never hit independently, which
lowers the variance, and large sets stop after two or three steps.

With 38 bands of five values a pair of similarity 0.85 shares no band with
probability 2e-10, and one of 0.8 with 3e-7.  Sets that share a band are candidates.  Bands chain
half-similar sets into groups that can grow with the corpus, so groups beyond one
block are first divided by the signatures' own estimate: members of a band are
compared on a byte per place, and pairs far below the threshold part (an estimate
seven standard deviations low, 2e-10 at 0.85).  What stays together is compared on
whole sets, in blocks bounded by rows and shingles, and only a spanning forest of
the links leaves a task.  Documents with equal sets are represented by one of
them throughout.

Defined results: null, empty and blank texts have an empty set and link with
nothing; a text of fewer than five words has one shingle, its whole sequence;
rows repeated with the same doc_id share one component; empty tables give empty
results; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.llm.common import arrow_batches, connected_components, if_small, store
from siltstone.llm.words import column_bytes, mix, row_chunks, shingle_sets

BANDS = 38
ROWS = 5
THRESHOLD = 85  # 100 * intersection >= 85 * union
ELEMENTS = 30_000  # elements whose permutations are held at once
BLOCK = 256  # documents compared with each other at once
BLOCK_SHINGLES = 2_000_000  # and their shingles; a larger document meets others in blocks of its own
MARKS = 1024  # signatures compared with each other at once

_STEP = np.uint64(0x9E3779B97F4A7C15)


def super_minhash(elements: np.ndarray, owner: np.ndarray, sets: int, places: int) -> np.ndarray:
    """Signatures (``sets`` x ``places``) of sets given as element hashes and the set each belongs to."""
    signature = np.full((sets, places), np.inf)
    flat = signature.ravel()
    permutation = np.tile(np.arange(places, dtype=np.uint8), (len(elements), 1))
    state = mix(elements + np.uint64(0xA5A5A5A5A5A5A5A5))
    at = np.arange(len(elements))
    for step in range(places):
        state = state + _STEP
        bits = mix(state)
        rank = (bits >> np.uint64(32)).astype(np.float64) * 2.0**-32 + step
        other = step + ((bits & np.uint64(0xFFFFFFFF)) * np.uint64(places - step) >> np.uint64(32)).astype(np.int64)
        place = permutation[at, other]
        permutation[at, other] = permutation[at, step]
        np.minimum.at(flat, owner * places + place, rank)
        # A set is settled once its largest value lies below the next step.
        open_ = signature.max(axis=1) > step + 1
        if not open_.any():
            break
        keep = open_[owner]
        if not keep.all():
            at, owner, state = at[keep], owner[keep], state[keep]
    return signature


def signatures(sets: list[np.ndarray], places: int = BANDS * ROWS) -> np.ndarray:
    """Signatures of many sets; those of similar size are walked together, large ones in parts."""
    found = np.full((len(sets), places), np.inf)
    order = sorted(range(len(sets)), key=lambda i: len(sets[i]))
    at = 0
    while at < len(order):
        end, held = at, 0
        while end < len(order) and (end == at or held + len(sets[order[end]]) <= ELEMENTS):
            held += len(sets[order[end]])
            end += 1
        group = order[at:end]
        if held:
            elements = np.concatenate([sets[i] for i in group])
            owner = np.repeat(np.arange(len(group)), [len(sets[i]) for i in group])
            for part in range(0, held, ELEMENTS):  # more than one only for a single large set
                some = super_minhash(elements[part : part + ELEMENTS], owner[part : part + ELEMENTS], len(group), places)
                found[group] = np.minimum(found[group], some)
        at = end
    return found


def band_hashes(signature: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """One 64-bit hash per set and band, the band's number included."""
    bits = signature.view(np.uint64).reshape(len(signature), bands, rows)
    total = np.broadcast_to(np.arange(bands, dtype=np.uint64), bits.shape[:2]).copy()
    for k in range(rows):
        total = mix(total * _STEP + bits[:, :, k])
    return total


def place_marks(signature: np.ndarray) -> np.ndarray:
    """One byte per place of each signature; equal values have equal bytes, others with probability 1/256."""
    return (mix(signature.view(np.uint64)) >> np.uint64(56)).astype(np.uint8)


def set_keys(sets: list[np.ndarray]) -> tuple[list[int], list[int]]:
    """Two 64-bit digests of each whole set."""
    with np.errstate(over="ignore"):
        first = [int(mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64).astype(np.int64)) for s in sets]
        second = [int(np.bitwise_xor.reduce(mix(s + np.uint64(0x14057B7EF767814F)), initial=np.uint64(0)).astype(np.int64)) for s in sets]
    return first, second


SKETCH = "doc_id long, n_shingles long, key_a long, key_b long, bands array<long>, marks binary"


def sketches(docs: DataFrame) -> DataFrame:
    """Size, digest, band hashes and marks of every document's shingle set (no bands for an empty one)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat, offsets = column_bytes(batch.column(1))
            for low, high in row_chunks(offsets):
                part = offsets[low : high + 1]
                sets = shingle_sets(flat[part[0] : part[-1]], part - part[0])
                signature = signatures(sets)
                bands = band_hashes(signature).astype(np.int64)
                filled = np.array([len(s) > 0 for s in sets])
                at = np.concatenate([[0], np.cumsum(filled * BANDS)]).astype(np.int32)
                first, second = set_keys(sets)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(low, high - low),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(first, pa.int64()),
                        pa.array(second, pa.int64()),
                        pa.ListArray.from_arrays(pa.array(at), pa.array(bands[filled].ravel())),
                        pa.array([m.tobytes() for m in place_marks(signature)], pa.binary()),
                    ],
                    ["doc_id", "n_shingles", "key_a", "key_b", "bands", "marks"],
                )

    arrow_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, SKETCH)


def spanning_forest(linked: np.ndarray) -> list[tuple[int, int]]:
    """Pairs of a symmetric 0/1 matrix that connect all it connects: the first row of a component with every other one."""
    linked = linked.astype(bool)
    n = len(linked)
    first = np.arange(n)
    while True:
        near = np.minimum(first, np.where(linked, first[None, :], n).min(axis=1, initial=n))
        near = np.minimum(near, near[near])
        if (near == first).all():
            break
        first = near
    return [(a, b) for a, b in zip(first.tolist(), range(n)) if a != b]


def links_within(sets: list[np.ndarray], threshold: int) -> list[tuple[int, int]]:
    """A spanning forest of the pairs at or above ``threshold``, all pairs compared on whole sets.

    Intersections are counted as products of 0/1 matrices over the shingles that
    occur more than once, some columns at a time.
    """
    n = len(sets)
    sizes = np.array([len(s) for s in sets], dtype=np.float64)
    values, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(n), [len(s) for s in sets])
    number = np.cumsum(count > 1) - 1
    shared = count[column] > 1
    row, column = row[shared], number[column[shared]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    common = np.zeros((n, n), dtype=np.float32)
    width = 8192
    for low in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        a, b = np.searchsorted(column, [low, low + width])
        matrix = np.zeros((n, width), dtype=np.float32)
        matrix[row[a:b], column[a:b] - low] = 1
        common += matrix @ matrix.T
    linked = 100 * common.astype(np.float64) >= threshold * (sizes[:, None] + sizes[None, :] - common)
    linked &= common > 0
    return spanning_forest(linked)


def least_alike(threshold: int, places: int = BANDS * ROWS) -> int:
    """Equal places below which a pair is not of ``threshold`` (percent): seven standard deviations under it."""
    share = threshold / 100
    return int(places * (share - 7 * (share * (1 - share) / places) ** 0.5))


def alike(marks: np.ndarray, least: int) -> list[tuple[int, int]]:
    """A spanning forest of the pairs of rows of ``marks`` that are equal at ``least`` places or more."""
    same = np.zeros((len(marks), len(marks)), dtype=np.uint8)
    for place in marks.T:
        same += place[:, None] == place[None, :]
    return spanning_forest(same >= least)


def meetings(
    members: DataFrame, rows: int, weight: int, compare: Callable[[DataFrame], DataFrame], purpose: str
) -> DataFrame:
    """``id`` and ``component`` of the members that ``compare`` links within a ``group`` of ``members``.

    ``members`` has ``id``, ``group``, ``weight``; ``compare`` takes ``id`` and
    ``block`` and gives a spanning forest of the links of each block.  Groups of up
    to ``rows`` members and ``weight`` are packed together.  A larger one is dealt
    into chunks that all hold its lightest member, so that most of a group is
    connected when each member has been sent once.  Only members not connected to
    the lightest one by then meet the rest: two members that are connected
    already need not meet.
    """

    def halves(n: str, total: str) -> Column:
        return F.ceil(F.greatest(2 * F.col(n) / rows, 2 * F.col(total) / weight)).cast("int")

    sizes = members.groupBy("group").agg(
        F.count("*").alias("n"), F.sum("weight").alias("total"), F.min(F.struct("weight", "id"))["id"].alias("hub")
    )
    fits = (F.col("n") <= rows) & (F.col("total") <= weight)
    sizes = sizes.withColumn("chunks", F.when(fits, 1).otherwise(halves("n", "total")))
    dealt = members.join(sizes.where("n > 1"), "group").withColumn("chunk", F.pmod(F.xxhash64("id"), "chunks").cast("int"))
    dealt = store(dealt, purpose + "-dealt")
    few, small, wide = dealt.agg(
        F.count_if(F.col("chunks") == 1), F.sum(F.when(F.col("chunks") == 1, F.col("weight"))), F.count_if(F.col("chunks") > 1)
    ).first()
    packs = max(1, few // rows, (small or 0) // weight)
    pack = F.array(F.pmod(F.xxhash64("group"), F.lit(packs)))
    everywhere = F.transform(F.sequence(F.lit(0), F.col("chunks") - 1), lambda c: F.xxhash64("group", c))
    own = F.array(F.xxhash64("group", "chunk"))
    keys = F.when(F.col("chunks") == 1, pack).when(F.col("id") == F.col("hub"), everywhere).otherwise(own)
    links = store(compare(store(dealt.select("id", F.explode(keys).alias("block")).distinct(), purpose + "-blocks")), purpose)
    found = connected_components(links)
    if not wide:
        return found
    labels = found.select("id", F.col("component").alias("label"))
    named = dealt.where("chunks > 1").join(labels, "id", "left").withColumn("label", F.coalesce("label", "id"))
    named = store(named, purpose + "-named")
    centre = named.where("id = hub").select("group", F.col("label").alias("centre"))
    named = named.join(centre, "group").withColumn("loose", F.col("label") != F.col("centre"))
    rest = named.where("loose").groupBy("group").agg(F.count("*").alias("left"), F.sum("weight").alias("left_total"))
    rest = store(rest, purpose + "-rest")
    if not rest.count():
        return found
    named = named.join(rest.withColumn("lots", halves("left", "left_total")), "group")
    lot = F.pmod(F.xxhash64("id", F.lit("lot")), "lots").cast("int")
    of_chunk = F.transform(F.sequence(F.lit(0), F.col("lots") - 1), lambda k: F.xxhash64("group", k, "chunk"))
    of_lot = F.transform(F.sequence(F.lit(0), F.col("chunks") - 1), lambda c: F.xxhash64("group", lot, c))
    keys = F.when(F.col("loose"), F.array_union(of_chunk, of_lot)).otherwise(of_chunk)
    blocks = store(named.select("id", F.explode(keys).alias("block")), purpose + "-blocks")
    stars = found.select(F.col("id").alias("a"), F.col("component").alias("b"))
    return connected_components(stars.unionByName(compare(blocks)))


def divided(wide: DataFrame, threshold: int) -> DataFrame:
    """``id`` and ``component`` of the candidates in groups beyond a block, divided by the signatures' estimate.

    ``wide`` has ``id``, ``bands`` and ``marks``; members are compared within
    their shared bands only, on ``marks``.
    """
    least = least_alike(threshold)

    def compare(blocks: DataFrame) -> DataFrame:
        def run(part: pd.DataFrame) -> pd.DataFrame:
            part = part.sort_values("id")
            ids = part["id"].to_numpy()
            marks = np.frombuffer(b"".join(part["marks"]), np.uint8).reshape(len(ids), -1)
            forest = alike(marks, least)
            return pd.DataFrame({"a": [ids[i] for i, _ in forest], "b": [ids[j] for _, j in forest]}, dtype="int64")

        return wide.select("id", "marks").join(blocks, "id").groupBy("block").applyInPandas(run, "a long, b long")

    # Sets that share a band are in one group, so bands are shared among ``wide`` alone.
    members = wide.select("id", F.explode("bands").alias("group"), F.lit(1).cast("long").alias("weight"))
    return meetings(members, MARKS, MARKS, compare, "alike")


def near_duplicates(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id``, ``kept`` of every row of ``docs`` (``doc_id``, ``text``)."""
    sketch = store(sketches(docs), "sketches")
    filled = sketch.where("n_shingles > 0")
    keys = ["n_shingles", "key_a", "key_b"]
    groups = store(
        filled.groupBy(*keys).agg(F.min("doc_id").alias("rep"), F.min("bands").alias("bands"), F.min("marks").alias("marks")),
        "groups",
    )
    hits = groups.select("rep", F.explode("bands").alias("band"))
    hubs = hits.groupBy("band").agg(F.min("rep").alias("hub"), F.count("*").alias("n")).where("n > 1")
    # At most a hub per band; the lowest one connects them all.
    shared = hits.join(hubs.drop("n"), "band").where("rep <> hub").groupBy("rep").agg(F.collect_set("hub").alias("hubs"))
    ends = F.array_except(F.array_append("hubs", F.col("rep")), F.array(F.array_min("hubs")))
    stars = shared.select(F.explode(ends).alias("a"), F.array_min("hubs").alias("b"))
    candidates = connected_components(stars).join(groups.select(F.col("rep").alias("id"), "n_shingles"), "id")
    candidates = store(candidates, "candidates")
    size = candidates.groupBy("component").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("total"))
    large = store(size.where((F.col("n") > BLOCK) | (F.col("total") > BLOCK_SHINGLES)).select("component"), "large")
    members = candidates
    if large.count():
        wide = candidates.join(large, "component", "left_semi").select("id", "n_shingles")
        wide = store(groups.select(F.col("rep").alias("id"), "bands", "marks").join(wide, "id"), "wide")
        parts = divided(wide, threshold).join(wide.select("id", "n_shingles"), "id")
        members = candidates.join(large, "component", "left_anti").unionByName(parts)
    members = members.select("id", F.col("component").alias("group"), F.col("n_shingles").alias("weight"))

    def compare(blocks: DataFrame) -> DataFrame:
        def run(part: pd.DataFrame) -> pd.DataFrame:
            part = part.drop_duplicates("id").sort_values("id")
            flat, offsets = column_bytes(pa.array(part["text"], pa.large_string()))
            ids = part["id"].to_numpy()
            forest = links_within(shingle_sets(flat, offsets), threshold)
            return pd.DataFrame({"a": [ids[i] for i, _ in forest], "b": [ids[j] for _, j in forest]}, dtype="int64")

        wanted = docs.select(F.col("doc_id").cast("long").alias("id"), "text").join(if_small(blocks), "id")
        return wanted.groupBy("block").applyInPandas(run, "a long, b long")

    components = meetings(members, BLOCK, BLOCK_SHINGLES, compare, "links")
    labelled = groups.select(*keys, "rep").join(components, F.col("rep") == F.col("id"), "left")
    labelled = labelled.select(*keys, F.coalesce("component", "rep").alias("component_id"))
    named = filled.select("doc_id", *keys).join(labelled, keys).select("doc_id", "n_shingles", "component_id")
    alone = sketch.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return named.unionByName(alone).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))

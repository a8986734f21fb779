"""Near-duplicate vectors: spherical k-means cells, blocked cosine products, connected components.

Vectors are compared only within their label.  A label's cells are fitted on a
bounded sample (``SAMPLE_ROWS`` vectors), but no link is lost by that: every
vector lives in its nearest cell, and meets all cells that can hold a link of
it, by the cell's angular radius and by the plane between the cell and its own.
Neighbouring cells are bundled to about ``HOMES`` vectors, so that a vector
travels once per bundle, and of two bundles one visits the other.  Labels of up
to ``SMALL`` vectors are one bundle.  Where vectors of a label lie close together
few bundles are met; scattered ones meet about half of all, and cost grows with
the square of the label.  Products are in double precision, block by block, and
a block returns counts and a spanning forest, not pairs.

Defined results: a vector that is null, empty, zero or holds a null or
non-finite component, or whose label is null, links with nothing; vectors of
different lengths never link; equal vectors of a label link with each other;
repeated ids share one component; vectors without an id link like others but
name no component, unless no other vector is in theirs.  Empty tables give empty
results, other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.common import arrow_batches, connected_components, store

THRESHOLD = 0.93
SAMPLE_ROWS = 8192
SMALL = 2048
ROUNDS = 8
HOMES = 2048
QUERIES = 4096
DEAL = 4096
ROUNDING = 1e-6  # in angles and sines, far above what double precision loses


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length one in double precision, first by their largest component so that nothing overflows."""
    vectors = vectors.astype(np.float64)
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


def spherical_kmeans(vectors: np.ndarray, cells: int, rounds: int = ROUNDS) -> np.ndarray:
    """Unit centres of ``cells`` cells; an empty cell takes the vector that its own centre fits worst."""
    centres = vectors[np.linspace(0, len(vectors) - 1, cells).astype(int)].copy()
    for _ in range(rounds):
        cosine = vectors @ centres.T
        home = cosine.argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, home, vectors)
        length = np.sqrt((sums * sums).sum(axis=1, keepdims=True))
        empty = np.flatnonzero(length[:, 0] < 1e-9)
        sums[empty] = vectors[np.argsort(cosine.max(axis=1), kind="stable")[: len(empty)]]
        length[empty] = 1
        centres = sums / length
    return centres


def cell_count(n: int) -> int:
    """Cells of a label of ``n`` vectors: the square root, so that cells and lists of centres grow alike."""
    return 1 if n <= SMALL else int(np.ceil(np.sqrt(n) / 2))


def representatives(vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Usable vectors with a digest, and one row per distinct (label, length, vector)."""
    sound = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    usable = (
        F.col("label").isNotNull()
        & F.col("embedding").isNotNull()
        & ~F.coalesce(sound, F.lit(True))
        & F.exists("embedding", lambda x: x != 0)
    )
    text = F.col("embedding").cast("string")
    marked = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.when(usable, F.concat_ws("|", F.col("label").cast("string"), F.size("embedding"), F.md5(text))).alias("digest"),
        F.concat_ws("|", F.col("label").cast("string"), F.size("embedding")).alias("group"),
        F.col("embedding").cast("array<double>").alias("embedding"),
    )
    grouped = marked.where("digest IS NOT NULL").groupBy("digest").agg(
        F.min("vec_id").alias("low"), F.count("*").alias("copies"), F.min("group").alias("group"), F.min("embedding").alias("embedding")
    )
    # Vectors are told apart by a number of their own, so that those without an id are compared as well.
    return marked.select("vec_id", "digest"), grouped.withColumn("id", F.monotonically_increasing_id())


def bundles(centres: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The bundle of every cell: a chain of nearest centres, cut before ``HOMES`` vectors are passed."""
    left = np.ones(len(centres), dtype=bool)
    found = np.zeros(len(centres), dtype=np.int64)
    at, bundle, held = 0, 0, 0
    for _ in range(len(centres)):
        left[at] = False
        if held and held + sizes[at] > HOMES:
            bundle, held = bundle + 1, 0
        found[at], held = bundle, held + sizes[at]
        at = int(np.where(left, centres @ centres[at], -np.inf).argmax())
    return found


def reachable(vectors: np.ndarray, home: np.ndarray, centres: np.ndarray, radius: np.ndarray, threshold: float) -> np.ndarray:
    """Which cells (columns) can hold a vector of cosine ``threshold`` to each of ``vectors``.

    Such a vector is within the threshold angle, hence at most that farther from
    the centre than the cell's ``radius``; and as it is nearer to that centre
    than to the one of ``home``, so nearly is its partner.
    """
    angle = float(np.arccos(np.clip(threshold, -1, 1)))
    cosine = vectors @ centres.T
    near = np.arccos(np.clip(cosine, -1, 1)) <= radius + angle + ROUNDING
    apart = np.sqrt(np.maximum(2 - 2 * (centres @ centres.T), 0))
    ahead = cosine[np.arange(len(home)), home][:, None] - cosine
    return near & (ahead <= apart[home] * np.sin(min(angle, np.pi / 2)) + ROUNDING)


def visits(home: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Whether the vectors of bundle ``home`` go to ``other``; of two bundles exactly one visits the other."""
    return (home == other) | ((home < other) == ((home + other) % 2 == 0))


def assigned(reps: DataFrame, threshold: float) -> DataFrame:
    """``reps`` with the bundles they go to in ``probes``, their own first."""
    sizes = reps.groupBy("group").agg(F.count("*").alias("n"))
    share = F.least(F.lit(1.0), F.lit(float(SAMPLE_ROWS)) / F.col("n"))
    dealt = reps.join(sizes, "group")
    chance = F.pmod(F.xxhash64("digest"), F.lit(1 << 20)) / float(1 << 20)
    # About SAMPLE_ROWS vectors of a label reach the task that fits its cells.
    sample = dealt.where(F.col("n") > SMALL).where(chance < share).select("group", "n", "embedding", "id")

    def fit(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("id")
        cells = min(cell_count(int(part["n"].iloc[0])), len(part))
        centres = spherical_kmeans(unit(np.vstack(part["embedding"])), cells)
        return pd.DataFrame({"group": [part["group"].iloc[0]], "centres": [centres.ravel().tolist()]})

    centres = store(sample.groupBy("group").applyInPandas(fit, "group string, centres array<double>"), "centres")
    deals = F.ceil(F.col("n") / DEAL).cast("int")
    salt = F.explode(F.sequence(F.lit(0), deals - 1)).alias("salt")
    salted = centres.join(sizes, "group").select("group", "centres", salt)
    large = dealt.where(F.col("n") > SMALL).withColumn("salt", F.pmod(F.xxhash64("id"), deals).cast("int"))

    def house(part: pd.DataFrame, fitted: pd.DataFrame) -> pd.DataFrame:
        if part.empty:
            return pd.DataFrame({c: [] for c in ("id", "copies", "group", "salt", "embedding", "cell", "angle")})
        vectors = unit(np.vstack(part["embedding"]))
        # A sample may, by a rare chance, be empty: the label is then one cell.
        middle = np.asarray(fitted["centres"].iloc[0]).reshape(-1, vectors.shape[1]) if len(fitted) else unit(vectors[:1] * 0 + 1)
        cosine = vectors @ middle.T
        part = part[["id", "copies", "group", "salt"]].copy()
        part["embedding"] = list(vectors)
        part["cell"] = cosine.argmax(axis=1)
        part["angle"] = np.arccos(np.clip(cosine.max(axis=1), -1, 1))
        return part

    schema = "id long, copies long, group string, salt int, embedding array<double>, cell int, angle double"
    housed = store(large.groupBy("group", "salt").cogroup(salted.groupBy("group", "salt")).applyInPandas(house, schema), "homes")
    held = housed.groupBy("group", "cell").agg(F.count("*").alias("n"), F.max("angle").alias("radius"))

    def bundle(part: pd.DataFrame, fitted: pd.DataFrame) -> pd.DataFrame:
        if part.empty or fitted.empty:
            return pd.DataFrame({c: [] for c in ("group", "centres", "radius", "bundle")})
        count = int(fitted["cells"].iloc[0])
        middle = np.asarray(fitted["centres"].iloc[0]).reshape(count, -1)
        radius, rows = np.full(count, -np.inf), np.zeros(count, dtype=np.int64)  # an empty cell is never met
        radius[part["cell"]], rows[part["cell"]] = part["radius"], part["n"]
        return pd.DataFrame({
            "group": [part["group"].iloc[0]], "centres": [middle.ravel().tolist()],
            "radius": [radius.tolist()], "bundle": [bundles(middle, rows).tolist()],
        })

    wide = F.element_at(F.split("group", r"\|"), -1).cast("int")
    counted = centres.withColumn("cells", (F.size("centres") / wide).cast("int"))
    laid = store(
        held.groupBy("group").cogroup(counted.groupBy("group")).applyInPandas(
            bundle, "group string, centres array<double>, radius array<double>, bundle array<int>"
        ), "bundles",
    )

    def probe(part: pd.DataFrame, fitted: pd.DataFrame) -> pd.DataFrame:
        if part.empty:
            return pd.DataFrame({c: [] for c in ("id", "copies", "group", "embedding", "probes")})
        vectors = np.vstack(part["embedding"])
        kept = part[["id", "copies", "group", "embedding"]].copy()
        if not len(fitted):
            kept["probes"] = [[0]] * len(part)
            return kept
        middle = np.asarray(fitted["centres"].iloc[0]).reshape(-1, vectors.shape[1])
        of_cell, cell = np.asarray(fitted["bundle"].iloc[0]), part["cell"].to_numpy()
        met = reachable(vectors, cell, middle, np.asarray(fitted["radius"].iloc[0]), threshold)
        order = np.argsort(of_cell, kind="stable")
        names, starts = np.unique(of_cell[order], return_index=True)
        met = np.logical_or.reduceat(met[:, order], starts, axis=1)
        own = of_cell[cell]
        met &= visits(own[:, None], names[None, :]) & (names[None, :] != own[:, None])
        kept["probes"] = [[int(o), *names[m].tolist()] for o, m in zip(own, met)]
        return kept

    schema = "id long, copies long, group string, embedding array<double>, probes array<int>"
    salted = laid.join(sizes, "group").select("group", "centres", "radius", "bundle", salt)
    placed = housed.groupBy("group", "salt").cogroup(salted.groupBy("group", "salt")).applyInPandas(probe, schema)

    def scale(batches):
        for part in batches:
            if len(part):
                part["embedding"] = list(unit(np.vstack(part["embedding"]))) if part["embedding"].map(len).nunique() == 1 else [
                    unit(np.asarray(v)[None, :])[0] for v in part["embedding"]
                ]
            yield part

    small = dealt.where(F.col("n") <= SMALL).select("id", "copies", "group", "embedding", F.array(F.lit(0)).alias("probes"))
    return placed.unionByName(small.mapInPandas(scale, schema))


def forest(hit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the components of rows and columns of a table of links; every row and column is read once."""
    rows, columns = np.full(hit.shape[0], -1), np.full(hit.shape[1], -1)
    turned = np.ascontiguousarray(hit.T)
    for start in np.flatnonzero(hit.any(axis=1)):
        if rows[start] >= 0:
            continue
        rows[start], front = start, np.array([start])
        while len(front):
            side = np.flatnonzero(hit[front].any(axis=0) & (columns < 0))
            columns[side] = start
            front = np.flatnonzero(turned[side].any(axis=0) & (rows < 0)) if len(side) else side
            rows[front] = start
    return rows, columns


def compare_block(part: pd.DataFrame, threshold: float = THRESHOLD) -> pd.DataFrame:
    """Links between the homes and the queries of one block: counts for both, and a spanning forest.

    Bundles visit each other one way; a pair of one bundle is counted from its smaller id.
    """
    homes, queries = part[part["is_home"]], part[~part["is_home"]]
    if homes.empty or queries.empty:
        return pd.DataFrame({"id": [], "links": [], "hub": []}, dtype="int64")
    hit = np.vstack(queries["embedding"]) @ np.vstack(homes["embedding"]).T >= threshold
    qid, hid = queries["id"].to_numpy(), homes["id"].to_numpy()
    same = (queries["home"] == queries["cell"]).to_numpy()
    hit &= np.where(same[:, None], qid[:, None] < hid[None, :], qid[:, None] != hid[None, :])
    linked, others = np.flatnonzero(hit.any(axis=1)), np.flatnonzero(hit.any(axis=0))
    hit, qid, hid = hit[np.ix_(linked, others)], qid[linked], hid[others]
    qn, hn = queries["copies"].to_numpy()[linked], homes["copies"].to_numpy()[others]
    rows, columns = forest(hit)
    ids, component = np.concatenate([qid, hid]), np.concatenate([rows, columns])
    hub = np.full(len(qid), np.iinfo(np.int64).max)
    np.minimum.at(hub, component, ids)
    links = np.concatenate([hit @ hn, qn @ hit])
    return pd.DataFrame({"id": ids, "links": links, "hub": hub[component]}, dtype="int64")


def near_duplicate_vectors(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id``, ``kept`` of every row of ``vectors`` (``vec_id``, ``embedding``, ``label``)."""
    arrow_batches(vectors.sparkSession)
    marked, grouped = representatives(vectors)
    marked = store(marked, "digests")
    reps = store(grouped, "vectors")
    placed = store(assigned(reps, threshold).withColumn("home", F.col("probes")[0]), "probes")
    columns = ["group", "id", "copies", "embedding", "home"]
    homes = placed.select(*columns, F.col("home").alias("cell"))
    queries = placed.select(*columns, F.explode("probes").alias("cell"))
    # Chunks of a bundle: every chunk of homes meets every chunk of queries, each in a block of bounded size.
    sizes = store(
        queries.groupBy("group", "cell").agg(
            F.count("*").alias("n_query"), F.count_if(F.col("home") == F.col("cell")).alias("n_home")
        ), "cells",
    ).select(
        "group", "cell",
        F.greatest(F.lit(1), F.ceil(F.col("n_query") / QUERIES)).cast("int").alias("q_chunks"),
        F.greatest(F.lit(1), F.ceil(F.col("n_home") / HOMES)).cast("int").alias("h_chunks"),
    )
    spread = F.xxhash64("id")

    def rows(side: DataFrame, own: str, other: str, is_home: bool) -> DataFrame:
        sized = side.join(sizes, ["group", "cell"])
        mine = F.pmod(spread, F.col(own)).cast("int")
        return sized.select(
            *columns, "cell", F.lit(is_home).alias("is_home"),
            mine.alias("mine"), F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias("theirs"),
        ).select(
            *columns, "cell", "is_home",
            (F.col("mine") if is_home else F.col("theirs")).alias("h"),
            (F.col("theirs") if is_home else F.col("mine")).alias("q"),
        )

    blocks = rows(homes, "h_chunks", "q_chunks", True).unionByName(rows(queries, "q_chunks", "h_chunks", False))
    found = store(
        blocks.groupBy("group", "cell", "h", "q").applyInPandas(
            lambda part: compare_block(part, threshold), "id long, links long, hub long"
        ), "vector-links",
    )
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    components = connected_components(found.select(F.col("id").alias("a"), F.col("hub").alias("b")))
    labelled = store(
        reps.select("digest", "id", "low", "copies").join(links, "id", "left").join(components, "id", "left").select(
            "digest", "low",
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component", "id").alias("root"),
        ), "components",
    )
    lowest = labelled.groupBy("root").agg(F.min("low").alias("component_id"))
    named = marked.join(labelled.join(lowest, "root"), "digest", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        # Nothing but a vector that links with nothing has no digest.
        F.when(F.col("n_links").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"),
    )
    return named.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))

"""Benchmark decontamination: size-partitioned MinHash containment search, verified exactly.

An item is contained in a document if at least ``THRESHOLD`` percent of its
distinct word shingles occur in it.  Long documents make the Jaccard similarity
tiny, so containment is searched directly: items are partitioned by the size of
their shingle set, and each partition fixes how many of an item's smallest
shingle hashes (its bottom-k MinHash sketch) are looked up in the documents.
With ``k`` above the share of an item that may be missing, an item contained in
a document has a sketch hash there: nothing is lost.  Documents with a hit are
then compared on whole shingle sets.

Only DataFrame functions are used.  Document shingles are never shuffled as
such: sketches, and the shingles of items, are joined to them, as a broadcast
side if a count shows them to be small and as a shuffled one if not.

Defined results: words are the runs of letters and digits of the lower-cased
text; a text of fewer than five words has its whole sequence as one shingle, one
without words (or null) has none and matches nothing; repeated documents or items
give a row for each distinct pair of ids; a null id is an id of its own; empty
tables give empty results, other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.llm.common import if_small, store

SHINGLE = 5
THRESHOLD = 80
#: Items are partitioned by size at powers of this.
SIZE_STEP = 1.5


def words(text: Column) -> Column:
    """Lower-cased runs of letters and digits."""
    found = F.split(F.lower(text), r"[^\p{L}\p{N}]+")
    return F.filter(found, lambda w: w != "")


def shingles(texts: DataFrame, key: str, width: int = SHINGLE) -> DataFrame:
    """``key`` and ``shingle`` (a 64-bit hash) of every position of every text; not yet distinct."""
    listed = texts.select(key, words(F.col("text")).alias("w")).where("size(w) > 0")
    n = F.size("w")
    # Column k holds the words from the k-th on; rows that run over the end are nulls and go.
    tails = [F.slice("w", k + 1, F.greatest(n - (width - 1), F.lit(1))).alias(f"w{k}") for k in range(width)]
    rows = listed.select(key, n.alias("n"), F.inline(F.arrays_zip(*tails)))
    whole = F.when(F.col("n") < width, F.lit(True)).otherwise(F.col(f"w{width - 1}").isNotNull())
    return rows.where(whole).select(key, F.xxhash64(*[f"w{k}" for k in range(width)]).alias("shingle"))


def item_shingles(items: DataFrame) -> DataFrame:
    """``item_id``, ``shingle``, ``size`` (distinct shingles of the item), ``place`` (0 for the smallest hash)."""
    sets = shingles(items, "item_id").groupBy("item_id").agg(F.array_sort(F.collect_set("shingle")).alias("hashes"))
    return sets.select("item_id", F.size("hashes").alias("size"), F.posexplode("hashes").alias("place", "shingle"))


def sketch_length(size: Column, threshold: int = THRESHOLD) -> Column:
    """Sketch hashes per item of a size partition: one more than the largest item in it may miss."""
    step = F.lit(SIZE_STEP)
    largest = F.floor(F.pow(step, F.ceil(F.log(size) / F.log(step)) + 0.001))
    return F.floor(F.greatest(largest, size) * (100 - threshold) / 100) + 1


def contained_items(docs: DataFrame, items: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """``doc_id``, ``item_id``, ``n_shared``, ``n_item``, ``containment`` of every contained item."""
    known = store(item_shingles(items), "item-shingles")
    sketch = known.where(F.col("place") < sketch_length(F.col("size"), threshold)).select("shingle", "item_id")
    hits = shingles(docs, "doc_id").join(if_small(sketch.select("shingle").distinct()), "shingle", "left_semi").distinct()
    pairs = store(hits.join(if_small(sketch), "shingle").select("doc_id", "item_id").distinct(), "sketch-hits")
    found = docs.join(if_small(pairs.select(F.col("doc_id").alias("hit")).distinct()), F.col("doc_id").eqNullSafe(F.col("hit")), "left_semi")
    rows = shingles(found, "doc_id").join(if_small(known.select("shingle").distinct()), "shingle", "left_semi").distinct()
    shared = rows.join(if_small(known.select("shingle", "item_id", "size")), "shingle")
    same = shared["doc_id"].eqNullSafe(F.col("hit_doc")) & shared["item_id"].eqNullSafe(F.col("hit_item"))
    wanted = pairs.select(F.col("doc_id").alias("hit_doc"), F.col("item_id").alias("hit_item"))
    counted = shared.join(wanted, same, "left_semi").groupBy("doc_id", "item_id").agg(
        F.count("*").alias("n_shared"), F.max("size").cast("long").alias("n_item")
    )
    return counted.where(F.col("n_shared") * 100 >= F.col("n_item") * threshold).withColumn(
        "containment", F.col("n_shared") / F.col("n_item")
    )


def clean_documents(docs: DataFrame, items: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """``docs`` without those that contain an item."""
    bad = contained_items(docs, items, threshold).select(F.col("doc_id").alias("bad_id")).distinct()
    bad = store(bad, "contaminated")
    return docs.join(if_small(bad), F.col("doc_id").eqNullSafe(F.col("bad_id")), "left_anti")


ORACLE_SQL = r"""
WITH texts AS (
    SELECT 'd' AS kind, doc_id AS id, text FROM documents UNION ALL SELECT 'i', item_id, text FROM benchmark
), words AS (
    SELECT kind, id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w
    FROM texts WHERE text IS NOT NULL
), shingles AS (
    SELECT DISTINCT kind, id, unnest(
        CASE WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
             ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s
    FROM words WHERE len(w) > 0
), items AS (
    SELECT id AS item_id, s, count(*) OVER (PARTITION BY id) AS n_item FROM shingles WHERE kind = 'i'
)
SELECT d.id AS doc_id, item_id, count(*) AS n_shared, any_value(n_item) AS n_item, count(*) / any_value(n_item) AS containment
FROM (SELECT id, s FROM shingles WHERE kind = 'd') d JOIN items USING (s)
GROUP BY d.id, item_id
HAVING count(*) * 100 >= any_value(n_item) * 80
"""

"""Phrase collocations by dynamic itemset counting over cyclic scans of corpus shards.

The corpus is cut into shards that are scanned in turn, round and round.  Words
are counted from the first scan on; a longer phrase is counted from the scan
after both its subphrases (all words but the last, all but the first) have
reached the threshold, and for exactly one full cycle, wherever it began: its
count is then that of the whole corpus.  So phrases of all lengths are counted in
the same scans, and it ends when a whole cycle has brought nothing new.

Which phrases have reached the threshold, and after which scan, is known to the
tasks through a table of fixed size: a phrase has two cells, each holds the first
scan after which a phrase of that cell reached the threshold, and the later of
the two is taken.  A cell never changes once it is set, so a phrase's beginning
is the same for every task and every scan, and two phrases that share cells only
begin early: their counts cover a full cycle all the same.  The size of the table
decides how many phrases are counted in vain, never a result.

Defined results: a null or empty text has no words; a null language is ``und``;
repeated rows and rows with a null id count each; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siltstone.llm.blobs import joined, loosened, packed, squeezed, unpacked
from siltstone.llm.common import arrow_batches, if_small, store
from siltstone.llm.words import column_bytes, mix, row_chunks, word_hashes
from siltstone.session import scratch_dir

LONGEST = 5
LEAST = 100
TOP = 2000
UNKNOWN = "und"
SHARDS = 2
BATCH_BYTES = 16_000_000
# Cells of the table of phrases that have reached the threshold: one byte each.
CELLS = 1 << 24
NEVER = 255

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
# What ends a piece, and what lies between words.
_CLASS = np.zeros(256, dtype=np.uint8)
_CLASS[[0x20, 0x09]] = 1
_CLASS[[*b".,;:!?", 0x0A, 0x0B, 0x0C, 0x0D]] = 2

ENCODED = "lang string, n long, words binary, sizes binary, ids binary, breaks binary, shard int"


def words_of(flat: np.ndarray, offsets: np.ndarray) -> tuple[pa.DictionaryArray, np.ndarray]:
    """The words of some texts by numbers of their own, and where a word begins a piece."""
    kind = _CLASS[flat]
    edge = np.zeros(len(flat) + 1, dtype=bool)
    edge[offsets] = True
    solid = kind == 0
    starts, ends = solid.copy(), solid.copy()
    starts[1:] &= ~solid[:-1] | edge[1:-1]
    ends[:-1] &= ~solid[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    letters = _LOWER[flat[solid]]
    at = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(at), pa.py_buffer(letters)])
    # A word begins a piece if a mark or a text's beginning lies between it and the word before.
    cuts = np.cumsum((kind == 2) | edge[:-1]) if len(flat) else np.zeros(0, np.int64)
    return words.dictionary_encode(), np.diff(cuts[starts], prepend=-1) != 0


def encoded(docs: DataFrame, shards: int) -> DataFrame:
    """Batches of documents of one language as numbers of their own words, dealt to the shards in turn."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = TaskContext.get().partitionId()
        for batch in joined(batches, BATCH_BYTES):
            langs = batch.column(1).dictionary_encode()
            texts, which = batch.column(0), np.asarray(langs.indices)
            for k, lang in enumerate(langs.dictionary.to_pylist()):
                own = texts.take(pa.array(np.flatnonzero(which == k)))
                flat, offsets = column_bytes(own)
                for low, high in row_chunks(offsets, BATCH_BYTES):
                    part = offsets[low : high + 1]
                    words, breaks = words_of(flat[part[0] : part[-1]], part - part[0])
                    if not len(words):
                        continue
                    turn += 1
                    letters, at = column_bytes(words.dictionary)
                    row = [
                        lang, len(words), squeezed(letters.tobytes()), packed(np.diff(at)), packed(np.asarray(words.indices)),
                        squeezed(np.packbits(breaks).tobytes()), turn % shards,
                    ]
                    kinds = (pa.string(), pa.int64(), *[pa.binary()] * 4, pa.int32())
                    yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, kinds)], [c.split()[0] for c in ENCODED.split(", ")])

    arrow_batches(docs.sparkSession)
    return docs.select(F.coalesce("text", F.lit("")), F.coalesce("lang", F.lit(UNKNOWN))).mapInArrow(run, ENCODED)


_STEP = np.uint64(0x9E3779B97F4A7C15)


def extended(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hashes of phrases that are one word longer."""
    return mix(before * _STEP ^ word)


def of_lang(lang: str) -> np.uint64:
    return np.uint64(int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little"))


def cells_of(hashes: np.ndarray, cells: int) -> tuple[np.ndarray, np.ndarray]:
    return (hashes & np.uint64(cells - 1)).astype(np.int64), (hashes >> np.uint64(32) & np.uint64(cells - 1)).astype(np.int64)


# A key is the language, a line break, which no word holds, and the phrase.
COUNTS = "key string, start int, n long"


def counted(rows: DataFrame, step: int, shards: int, reached: np.ndarray, longest: int) -> DataFrame:
    """The phrases that are counted in scan ``step`` and how often each batch of the shard has them.

    ``reached`` has each cell's scan; phrases of up to ``longest`` words are looked for.
    """
    cells, sent = len(reached), squeezed(reached.tobytes())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = loosened(sent)
        for batch in batches:
            for r in batch.to_pylist():
                yield from of_batch(r, table)

    def of_batch(r: dict, table: np.ndarray) -> Iterator[pa.RecordBatch]:
        ids = unpacked(r["ids"]).astype(np.int64)
        at = np.concatenate([[0], np.cumsum(unpacked(r["sizes"]).astype(np.int64))])
        letters = loosened(r["words"])
        words = pa.LargeStringArray.from_buffers(len(at) - 1, pa.py_buffer(at), pa.py_buffer(letters))

        def counts(phrases: pa.Array, start: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
            keys = pc.binary_join_element_wise(pa.scalar(r["lang"], pa.large_string()), phrases, pa.scalar("\n", pa.large_string()))
            columns = [keys.cast(pa.string()), pa.array(start.astype(np.int32)), pa.array(n.astype(np.int64))]
            return pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in COUNTS.split(", ")])

        if step < shards:
            yield counts(words, np.zeros(len(words)), np.bincount(ids, minlength=len(words)))
        piece = np.cumsum(np.unpackbits(loosened(r["breaks"]), count=len(ids)))
        hashes = word_hashes(letters, at)[0]
        phrase = extended(np.full(len(ids), of_lang(r["lang"])), hashes[ids])
        for size in range(2, longest + 1):
            # When the phrases of one word less reached the threshold, at each place.
            first, second = cells_of(phrase, cells)
            when = np.maximum(table[first], table[second])
            start = np.maximum(when[:-1], when[1:])[: max(0, len(ids) - size + 1)].astype(np.int16) + 1
            whole = piece[: len(start)] == piece[size - 1 :]
            place = np.flatnonzero(whole & (start <= step) & (start > step - shards))
            if len(place):
                number = ids[place]
                for k in range(1, size):
                    _, some, number = np.unique(number << 32 | ids[place + k], return_index=True, return_inverse=True)
                parts = [words.take(pa.array(ids[place[some] + k])) for k in range(size)]
                yield counts(pc.binary_join_element_wise(*parts, pa.scalar(" ", pa.large_string())), start[place[some]], np.bincount(number))
            if len(ids) < size:
                break
            phrase = extended(phrase[:-1], hashes[ids[size - 1 :]])

    arrow_batches(rows.sparkSession, 4)
    return rows.where(F.col("shard") == step % shards).mapInArrow(run, COUNTS)


def cells_reached(phrases: DataFrame, reached: np.ndarray) -> np.ndarray:
    """The cells that some phrases are the first to set: no more than there are cells."""
    cells, sent = len(reached), squeezed(reached.tobytes())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = loosened(sent)
        for batch in batches:
            hashes, at = word_hashes(*column_bytes(batch.column(1)))
            salts = {lang: of_lang(lang) for lang in batch.column(0).unique().to_pylist()}
            found = np.array([salts[lang] for lang in batch.column(0).to_pylist()], dtype=np.uint64)
            sizes = np.diff(at)
            for k in range(int(sizes.max(initial=0))):
                longer = np.flatnonzero(sizes > k)
                found[longer] = extended(found[longer], hashes[at[:-1][longer] + k])
            cell = np.unique(np.concatenate(cells_of(found, cells)))
            yield pa.RecordBatch.from_arrays([pa.array(cell[table[cell] == NEVER])], ["cell"])

    arrow_batches(phrases.sparkSession, 100_000)
    return np.array([r.cell for r in phrases.select("lang", "phrase").mapInArrow(run, "cell long").distinct().collect()], dtype=np.int64)


def opened(counts: DataFrame) -> DataFrame:
    """Keys as language, phrase and number of words."""
    phrase = F.substring_index("key", "\n", -1)
    lang = F.expr("substring(key, 1, length(key) - length(substring_index(key, '\n', -1)) - 1)")
    words = F.length(phrase) - F.length(F.replace(phrase, F.lit(" "), F.lit(""))) + 1
    return counts.select(lang.alias("lang"), words.alias("words"), phrase.alias("phrase"), "start", "n")


def frequent_phrases(
    docs: DataFrame, least: int = LEAST, longest: int = LONGEST, shards: int = SHARDS, cells: int = CELLS
) -> tuple[DataFrame, DataFrame]:
    """All phrases of up to ``longest`` words that occur ``least`` times or more in a language, and the words of each language.

    ``lang``, ``words`` (of the phrase), ``phrase``, ``n``; ``lang``, ``n``.
    """
    spark = docs.sparkSession
    path = scratch_dir(spark, "word-batches")
    encoded(docs, shards).write.partitionBy("shard").parquet(path)
    rows = spark.read.schema(ENCODED).parquet(path)
    totals = store(rows.groupBy("lang").agg(F.sum("n").alias("n")), "language-words")
    reached = np.full(cells, NEVER, dtype=np.uint8)
    recent: list[bool] = []  # whether a scan has set a cell
    whole: list[DataFrame] = []
    state = None
    step = 0
    while step < shards or any(recent[-shards:]):
        fresh = counted(rows, step, shards, reached, longest if any(recent[-shards:]) else 1)
        if state is not None:
            # What has been counted for a full cycle is whole and goes no further.
            fresh = fresh.unionByName(state.where(F.col("start") > step - shards))
        summed = fresh.groupBy("key", "start").agg(F.sum("n").alias("n"))
        state = store(summed.where((F.col("start") > step - shards + 1) | (F.col("n") >= least)), "phrase-counts")
        frequent = opened(state.where(F.col("n") >= least))
        whole.append(frequent.where(F.col("start") == step - shards + 1))
        found = cells_reached(frequent.where(F.col("words") < longest), reached)
        reached[found] = step
        recent.append(len(found) > 0)
        step += 1
    arrow_batches(spark)
    frequent = whole[0]
    for more in whole[1:]:
        frequent = frequent.unionByName(more)
    return store(frequent.drop("start"), "frequent-phrases"), totals


def best_cuts(frequent: DataFrame, totals: DataFrame) -> DataFrame:
    """Every phrase of two words or more with its lowest-scoring cut: ``a``, ``l``, ``r``, ``n``, ``score``, all exact."""
    phrases = frequent.where("words > 1").join(if_small(totals.withColumnRenamed("n", "total")), "lang")
    cuts = phrases.select(
        "lang", "words", "phrase", F.col("n").alias("a"), F.col("total").alias("n"), F.explode(F.expr("sequence(1, words - 1)")).alias("k")
    ).select("*", F.expr("substring_index(phrase, ' ', k)").alias("left"), F.expr("substring_index(phrase, ' ', k - words)").alias("right"))
    left = frequent.select("lang", F.col("phrase").alias("left"), F.col("n").alias("l"))
    right = frequent.select("lang", F.col("phrase").alias("right"), F.col("n").alias("r"))
    wide = {c: f"CAST({x} AS DECIMAL(19, 0))" for c, x in (("a", "1000 * a"), ("n", "n"), ("l", "l"), ("r", "r"))}
    score = F.expr(f"({wide['a']} * {wide['n']}) div ({wide['l']} * {wide['r']})")
    scored = cuts.join(left, ["lang", "left"]).join(right, ["lang", "right"]).withColumn("score", score)
    least = scored.groupBy("lang", "words", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    return least.select("lang", "words", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, **counting) -> DataFrame:
    """The ``top`` phrases of each language: ``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``.

    A phrase goes if a longer one that holds it is as frequent; it is enough to
    look at those of one word more, since what lies between is as frequent too.
    """
    frequent, totals = frequent_phrases(docs, least, **counting)
    found = store(best_cuts(frequent, totals), "collocations")
    longer = found.where("words > 2").select(
        "lang", F.explode(F.expr("array(substring_index(phrase, ' ', words - 1), substring_index(phrase, ' ', 1 - words))")).alias("phrase"), "a"
    )
    holding = longer.groupBy("lang", "phrase").agg(F.max("a").alias("most"))
    kept = found.join(holding, ["lang", "phrase"], "left").where("most IS NULL OR most < a")
    place = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(place).cast("long")).where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


ORACLE_SQL = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\n-\r]')) AS piece
    FROM documents
), split AS (
    SELECT lang, list_filter(string_split_regex(piece, '[ \t]+'), lambda w: w <> '') AS w FROM pieces
), totals AS (
    SELECT lang, sum(len(w))::BIGINT AS n FROM split GROUP BY lang
), places AS (
    SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM split
), runs AS (
    SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase FROM places, range(1, 6) AS sizes(k) WHERE i + k - 1 <= len(w)
), f AS (
    SELECT lang, k, phrase, count(*) AS f FROM runs GROUP BY lang, k, phrase HAVING count(*) >= 100
), cuts AS (
    SELECT lang, k, phrase, f, unnest(range(1, k)) AS c, string_split(phrase, ' ') AS w FROM f WHERE k > 1
), scored AS (
    SELECT c.lang, c.k, c.phrase, c.f AS a, x.f AS l, y.f AS r, t.n, c.c,
           ((1000::HUGEINT * c.f * t.n) // (x.f::HUGEINT * y.f))::BIGINT AS score
    FROM cuts c JOIN totals t USING (lang)
    JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:c.c], ' ')
    JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[c.c + 1:], ' ')
), best AS (
    SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1
), parts AS (
    SELECT lang, a, string_split(phrase, ' ') AS w, unnest(range(2, k)) AS size, k FROM best WHERE k > 2
), held AS (
    SELECT lang, phrase, max(a) AS most FROM (
        SELECT lang, a, array_to_string(w[s:s + size - 1], ' ') AS phrase
        FROM (SELECT *, unnest(range(1, k - size + 2)) AS s FROM parts)
    ) GROUP BY lang, phrase
), kept AS (
    SELECT best.* FROM best LEFT JOIN held USING (lang, phrase) WHERE most IS NULL OR 100 * most < 100 * a
)
SELECT lang, rank, phrase, a, l, r, n, score FROM (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept
) WHERE rank <= 2000
"""

"""Benchmark decontamination by greedy string tiling.

Documents and benchmark items that share a seed, a run of ``least`` words, are
joined. For each such pair the longest match of unmarked words is marked again
and again, down to ``least`` words; a running Karp-Rabin hash finds the matches.
The share of an item's words under tiles is its coverage, which does not depend
on the order of its parts in the document.
"""

from __future__ import annotations

import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spindlewatch.llm.common import keep, query, slices, small, table, texts_of
from spindlewatch.llm.hashing import Words, sequences

LEAST = 5
SHORTEST = 3
COVERAGE = 0.6
FILTER_BITS = 1 << 22  # size of the seed filter that tasks get, whatever the benchmark's size
# ASCII other than letters, digits and space becomes a space, A-Z lower case; other bytes stay.
_PLAIN = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))
# Characters of scripts without spaces (CJK and its neighbours, Thai, Lao, Burmese, Khmer), each a word of its own.
_APART = re.compile(
    rb"[\xe3-\xe9][\x80-\xbf]{2}|\xe0[\xb8-\xbb][\x80-\xbf]|\xe1[\x80-\x82\x9e\x9f][\x80-\xbf]|\xf0[\x80-\xbf]{3}"
)


def plain(text: bytes) -> bytes:
    """``text`` with its words between spaces."""
    return _APART.sub(rb" \g<0> ", text).translate(_PLAIN)


def word_hashes(text: bytes) -> np.ndarray:
    return Words([plain(text)]).hashes()


def tiles(item: np.ndarray, text: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """Non-overlapping matches (place in item, place in text, length), longest first, none under ``least`` words."""
    free_item, free_text = np.ones(len(item), bool), np.ones(len(text), bool)
    out: list[tuple[int, int, int]] = []
    length = max(least, min(len(item), 32))
    while True:
        found = _matches(item, text, free_item, free_text, length)
        longest = max((n for _, _, n in found), default=0)
        if longest > 2 * length:
            length = longest  # start again from the longest match
            continue
        again = False
        for i, j, n in sorted(found, key=lambda m: (-m[2], m[0], m[1])):
            if free_item[i : i + n].all() and free_text[j : j + n].all():
                free_item[i : i + n] = free_text[j : j + n] = False
                out.append((i, j, n))
            else:
                again = True  # what a longer tile left of this match may still be long enough
        if again:
            continue
        if length == least:
            return out
        length = max(least, length // 2)


def _matches(item, text, free_item, free_text, length):
    """Maximal matches of unmarked words of at least ``length``."""
    own, other = _free_runs(item, free_item, length), _free_runs(text, free_text, length)
    common = other[1][np.isin(other[0], own[0])]
    if not len(common):
        return []
    by_hash = defaultdict(list)
    for h, i in zip(own[0].tolist(), own[1].tolist()):
        by_hash[h].append(i)
    place = dict(zip(other[1].tolist(), other[0].tolist()))
    out = []
    for j in common.tolist():
        for i in by_hash[place[j]]:
            if i and j and item[i - 1] == text[j - 1] and free_item[i - 1] and free_text[j - 1]:
                continue  # begins earlier
            most = min(len(item) - i, len(text) - j)
            same = (item[i : i + most] == text[j : j + most]) & free_item[i : i + most] & free_text[j : j + most]
            n = most if same.all() else int(same.argmin())
            if n >= length:
                out.append((i, j, n))
    return out


def _free_runs(words, free, length):
    hashed = sequences(words, length)
    marked = np.concatenate(([0], np.cumsum(~free)))
    at = np.flatnonzero(marked[length:] == marked[: len(marked) - length])[: len(hashed)] if len(hashed) else np.zeros(0, int)
    return hashed[at], at


def contaminated(
    docs: DataFrame, benchmark: DataFrame, least: int = LEAST, coverage: float = COVERAGE, shortest: int = SHORTEST
) -> DataFrame:
    """(doc_id, item_id, coverage, tiles) of the documents that hold at least that share of an item's words.

    Words are runs of letters and digits, without case in ASCII; in scripts
    without spaces every character is a word. An item of fewer than ``least``
    words is its own seed and has to be there whole, in one run. Items of fewer
    than ``shortest`` words, which chance alone puts into many texts, match
    nothing, as do null or empty texts and rows without an id. Repeated rows count
    once. Of rows with one id and different texts, the smallest text is taken;
    of items likewise.

    Seeds of all documents pass a filter of fixed size before they are joined
    with the benchmark's, so only few of them are shuffled, and neither side has
    to fit anywhere. Words under shared seeds bound the coverage from above, so
    texts are fetched only for the pairs that can reach it.
    """
    items = benchmark.where("item_id is not null").select(F.col("item_id").cast("long").alias("item_id"), "text")
    items = items.groupBy("item_id").agg(F.min("text").alias("text"))
    seeds = keep(items.mapInArrow(_item_seeds(least, shortest), "item_id long, n int, seed long, place int"), "seeds")
    lengths = [r.n for r in seeds.where(F.col("n") < least).select("n").distinct().collect()]  # fewer than ``least``
    slot = F.pmod("seed", F.lit(FILTER_BITS)) + 1  # bitmaps count from 1
    chunks = (
        seeds.groupBy(F.bitmap_bucket_number(slot).alias("no"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("bits"))
        .collect()  # FILTER_BITS bits at most
    )
    rows = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    shared = rows.mapInArrow(_doc_seeds([*sorted(lengths), least], {c.no: bytes(c.bits) for c in chunks}), "doc_id long, seed long")
    under = F.array_distinct(F.flatten(F.transform("places", lambda p: F.sequence(p, p + F.least(F.lit(least), F.col("n")) - 1))))
    pairs = keep(
        shared.join(seeds, "seed")
        .groupBy("doc_id", "item_id")
        .agg(F.collect_set("place").alias("places"), F.max("n").alias("n"))
        .where(F.size(under) >= F.col("n") * coverage)
        .select("doc_id", "item_id"),
        "pairs",
    )
    held = rows.join(pairs.select("doc_id").distinct(), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"))
    texts = pairs.join(held, "doc_id").join(items.withColumnRenamed("text", "item"), "item_id")
    return texts.mapInArrow(_tiled(least), "doc_id long, item_id long, coverage double, tiles int").where(F.col("coverage") >= coverage)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Rows of ``docs`` that hold no benchmark item; rows without an id stay."""
    found = keep(contaminated(docs, benchmark).select("doc_id").distinct(), "contaminated")
    return docs.join(found, "doc_id", "left_anti").select(*docs.columns)


def _item_seeds(least: int, shortest: int):
    def run(batches):
        for batch in small(batches):
            for item, text in zip(batch.column("item_id").to_pylist(), texts_of(batch)):
                words = word_hashes(text)
                if len(words) < shortest:
                    continue
                runs = sequences(words, min(least, len(words)))
                n = len(runs)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([item] * n, pa.int64()), pa.array([len(words)] * n, pa.int32()), pa.array(runs.view(np.int64)), pa.array(range(n), pa.int32())],
                    ["item_id", "n", "seed", "place"],
                )

    return run


def _doc_seeds(lengths: list[int], chunks: dict[int, bytes]):
    def run(batches):
        bits = np.zeros(FILTER_BITS, bool)
        for no, chunk in chunks.items():  # each holds 32,768 positions
            bits[(no - 1) * 32768 : no * 32768] = np.unpackbits(np.frombuffer(chunk, np.uint8), bitorder="little")
        for batch in small(batches):
            texts = texts_of(batch)
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            for low, high in slices([len(t) for t in texts], 1 << 20):
                words = Words([plain(t) for t in texts[low:high]])
                hashes, text = words.hashes(), words.of_text()
                for length in lengths:
                    runs = sequences(hashes, length).view(np.int64)
                    inside = text[: len(runs)] == text[length - 1 :] if len(runs) else np.zeros(0, bool)
                    hit = np.flatnonzero(inside & bits[runs % FILTER_BITS])
                    if len(hit):
                        yield pa.RecordBatch.from_arrays([pa.array(ids[low + text[hit]]), pa.array(runs[hit])], ["doc_id", "seed"])

    return run


def _tiled(least: int):
    def run(batches):
        for batch in small(batches):
            share, count = [], []
            for item, text in zip(texts_of(batch, "item"), texts_of(batch)):
                words = word_hashes(item)
                found = tiles(words, word_hashes(text), min(least, len(words)))
                share.append(sum(n for _, _, n in found) / len(words) if len(words) else 0.0)
                count.append(len(found))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("item_id"), pa.array(share, pa.float64()), pa.array(count, pa.int32())],
                ["doc_id", "item_id", "coverage", "tiles"],
            )

    return run


@query
def op10_benchmark_decontamination(spark, sf_dir):
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))

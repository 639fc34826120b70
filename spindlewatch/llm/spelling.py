"""Spelling variants: words one edit apart, by an index of variable-length grams.

1. The words are counted. Gram counts over the words give a dictionary that is
   pruned by frequency: a gram stays short unless it is frequent, and a frequent
   one grows by a character, up to ``LONGEST``.
2. At every place of a word one gram starts, of the length that the dictionary
   asks for. One edit changes only grams that hold the edited character, so a
   word keeps all grams but at most its own bound of affected grams. In a fixed
   order of all grams, the first one that two near words keep is therefore among
   the first ``bound + 1`` grams of each: only those lists are merged.
3. Beside a kept gram the edit lies either behind or before it. So a list is
   split twice: by all that stands before the gram, and by all that stands
   behind it. One of the two parts holds both words, whatever the edit is, and
   very common grams don't make long lists.
4. Words that meet in a part are verified with Spark's edit distance.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spindlewatch.llm.common import keep, query, small, table, texts_of

LETTERS = "A-Za-zÀ-ÿ"
TO_LOWER = {code: code + 32 for code in range(65, 91)}
SHORTEST, LONGEST = 2, 4  # characters of a gram
GRAMS = 50_000  # the dictionary holds fewer frequent grams than this, whatever the input
LEAST = 16  # a gram of no more occurrences than this is not frequent
ROWS = 1 << 12  # words of a batch


def dropped_letters(doc_id: object, words: Counter[str], every: int) -> Counter[str]:
    """The words with one letter lost where ``every`` divides the checksum of id and word."""
    out: Counter[str] = Counter()
    start = zlib.crc32(f"{doc_id}:".encode())
    for word, n in words.items():
        h = zlib.crc32(word.encode(), start)
        if h % every == 0:
            at = h % len(word)
            word = word[:at] + word[at + 1 :]
        out[word] += n
    return out


def word_counts(
    docs: DataFrame, shortest: int, least: int, every: int | None, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """(word, n) for the lower-cased letter runs of all texts; every map task adds up its batches first."""
    run = re.compile(f"[{LETTERS}]{{{shortest},}}")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()
        held = 0
        for batch in small(batches):
            for doc_id, raw in zip(batch.column("id").to_pylist(), texts_of(batch)):
                words = Counter(run.findall(raw.decode(errors="replace").translate(TO_LOWER)))
                if every and doc_id is not None:
                    words = dropped_letters(doc_id, words, every)
                total.update(words)
                held += len(raw)
            # A bound in bytes of text, so long words can't fill the task's memory.
            if held > 1 << 25:
                yield from _rows(total)
                total, held = Counter(), 0
        yield from _rows(total)

    def _rows(total: Counter[str]) -> Iterator[pa.RecordBatch]:
        kept = [word for word in total if len(word) >= shortest]
        counts = [total[word] for word in kept]
        for at in range(0, len(kept), ROWS):
            yield pa.RecordBatch.from_arrays(
                [pa.array(kept[at : at + ROWS], pa.string()), pa.array(counts[at : at + ROWS], pa.int64())], ["word", "n"]
            )

    rows = docs.select(F.col(id_column).cast("string").alias("id"), F.col(text_column).cast("string").alias("text"))
    found = rows.mapInArrow(counted, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return found.where(F.col("n") >= least)


def frequent_grams(words: DataFrame) -> dict[str, int]:
    """Grams that occur often enough to be grown, with their counts.

    A gram counts as frequent above 1 / ``GRAMS`` of all occurrences, so there
    are fewer than ``GRAMS`` of them at any size of the input: a bounded collect.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: Counter[str] = Counter()
            for word in batch.column("word").to_pylist():
                for length in range(SHORTEST, LONGEST + 1):
                    found.update([word[i : i + length] for i in range(len(word) - length + 1)])
            yield pa.RecordBatch.from_arrays(
                [pa.array(found.keys(), pa.string()), pa.array(found.values(), pa.int64())], ["gram", "n"]
            )

    grams = words.select("word").mapInArrow(counted, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    grams = keep(grams, "grams")
    total = grams.agg(F.sum("n")).first()[0] or 0
    frequent = grams.where(F.col("n") > max(LEAST, total // GRAMS))
    return dict(zip(*[column.to_pylist() for column in frequent.toArrow().columns]))


def decomposed(word: str, frequent: dict[str, int]) -> list[tuple[int, int]]:
    """(start, end) of the gram that begins at each place: the shortest that is not frequent, or the longest there is."""
    out = []
    for start in range(len(word) - SHORTEST + 1):
        end = start + SHORTEST
        while end < len(word) and end - start < LONGEST and word[start:end] in frequent:
            end += 1
        out.append((start, end))
    return out


def affected(size: int, grams: list[tuple[int, int]]) -> int:
    """Most grams of a word of this size that one edit can change: those over one character.

    A character put between two others changes no more, and one put behind the
    end changes only grams over the last character.
    """
    change = [0] * (size + 1)
    for start, end in grams:
        change[start] += 1
        change[end] -= 1
    over = most = 0
    for step in change:
        over += step
        most = max(most, over)
    return most


def list_entries(word: str, frequent: dict[str, int]) -> set[str]:
    """Keys of the parts of lists that ``word`` has to be in."""
    grams = decomposed(word, frequent)
    bound = affected(len(word), grams)
    rarest = sorted(grams, key=lambda g: (frequent.get(word[g[0] : g[1]], 0), word[g[0] : g[1]], g[0]))[: bound + 1]
    keys = set()
    for start, end in rarest:
        keys.add(f"<{start}:{word[:end]}")
        keys.add(f">{len(word) - end}:{word[start:]}")
    return keys


def near_pairs(words: DataFrame) -> DataFrame:
    """(a, b), both ways, for words that differ by exactly one inserted, deleted or replaced code point."""
    frequent = words.sparkSession.sparkContext.broadcast(frequent_grams(words))

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, held = [], []
            for word in batch.column("word").to_pylist():
                found = list_entries(word, frequent.value)
                keys += found
                held += [word] * len(found)
            for at in range(0, len(keys), ROWS):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[at : at + ROWS], pa.string()), pa.array(held[at : at + ROWS], pa.string())], ["key", "word"]
                )

    lists = words.select("word").mapInArrow(entries, "key string, word string")
    # Hashes of keys are enough, as all that meets is verified.
    listed = keep(lists.select(F.xxhash64("key").alias("key"), F.length("word").alias("size"), "word"), "lists")
    longer = F.explode(F.array(F.col("size"), F.col("size") + 1))
    probes = listed.select("key", longer.alias("size"), F.col("size").alias("own"), F.col("word").alias("a"))
    met = probes.join(listed.withColumnRenamed("word", "b"), ["key", "size"]).where(
        ((F.col("size") > F.col("own")) | (F.col("a") < F.col("b"))) & (F.levenshtein("a", "b", 1) == 1)
    )
    pairs = keep(met.select("a", "b").distinct(), "pairs")
    return pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))


def spelling_variants(
    docs: DataFrame,
    shortest: int = 6,
    least: int = 5,
    factor: int = 5,
    every: int | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per word: ``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n``.

    Words are the lower-cased letter runs of all texts with ``shortest`` code
    points and ``least`` occurrences at least. A word's ``form`` is the near word
    with the most occurrences (ties: the smallest), if it has ``factor`` times as
    many as the word; ``root`` is the last word on the way from form to form.
    With ``every``, a letter of some runs is dropped first, by a checksum of id
    and run, which plants known misspellings.

    Null and empty texts and texts without letters have no words, and an empty
    table has no rows. In rows with a null id no letter is dropped. Repeated
    rows count as often as they are there. A word may have any length.
    """
    if shortest < LONGEST + 2:
        raise ValueError(f"a word of fewer than {LONGEST + 2} characters may keep no gram")
    if factor < 2:
        raise ValueError("forms have to gain occurrences, or they could go round in a circle")
    words = keep(word_counts(docs, shortest, least, every, id_column, text_column), "words")
    pairs = near_pairs(words)
    sized = pairs.join(words.select(F.col("word").alias("b"), F.col("n").alias("b_n")), "b")
    best = sized.groupBy("a").agg(F.count("*").alias("n_near"), F.min(F.struct(-F.col("b_n"), "b")).alias("best"))
    joined = words.join(best.withColumnRenamed("a", "word"), "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.col("best.b").alias("near"), (-F.col("best.col1")).alias("near_n")
    )
    enough = F.col("near_n") >= factor * F.col("n")
    formed = keep(
        joined.select("word", "n", "n_near", F.when(enough, F.col("near")).alias("form"), F.when(enough, F.col("near_n")).alias("form_n")),
        "forms",
    )

    # Each step multiplies occurrences by the factor, which bounds the length of a chain; each round doubles what is known.
    most = formed.agg(F.max("n")).first()[0] or 0
    chain, n = 0, least
    while n * factor <= most:
        chain, n = chain + 1, n * factor
    links = formed.where("form is not null").select("word", F.col("form").alias("to"))
    for _ in range(max(0, chain - 1).bit_length()):
        further = links.select(F.col("word").alias("to"), F.col("to").alias("end"))
        links = keep(links.join(further, "to", "left").select("word", F.coalesce("end", "to").alias("to")), "roots")
    return formed.join(links, "word", "left").select(
        "word", "form", F.coalesce("to", "word").alias("root"), "n", "n_near", "form_n"
    )


@query
def op13_spelling_variants(spark, sf_dir):
    return spelling_variants(table(spark, sf_dir, "documents"), every=199)

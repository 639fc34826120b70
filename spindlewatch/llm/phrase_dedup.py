"""Removal of repeated passages with sharded phrase automata.

A window of words that starts earlier too is a repeated phrase. Recurring
passages are confirmed by counting content-defined blocks of windows (see
``blocks``). Copies of whole equal blocks, which are most copies, are found by a
join on the block's digest and meet no automaton. Where an anchor has several
different blocks, one of each is dealt to a shard by the hash of the anchor; the
shard finds the phrases that recur in its passages, compiles them into an
Aho-Corasick automaton and runs it over the same passages. A passage goes to one
shard only, so the work grows with the corpus and not with documents times shards.
"""

from __future__ import annotations

import hashlib

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spindlewatch.llm.blocks import PIECE, Blocks, parts_of, pieces
from spindlewatch.llm.common import keep, query, slices, small, table, texts_of
from spindlewatch.llm.hashing import SPACES, Words, sequences
from spindlewatch.llm.suffix_dedup import digests, with_digest

# Bytes of passages that one automaton is compiled from.
SHARD_BYTES = 1 << 20


def blocks_in(texts: list[bytes], width: int, gram: int):
    """(words, blocks, text number of each, first word of each) for slices of the texts and pieces of long ones."""
    for low, high in slices([len(t) for t in texts], PIECE):
        if high - low == 1 and len(texts[low]) > PIECE:
            text = texts[low]
            begins = word_starts(text)
            for at, end in pieces(len(begins), width):
                words = Words([text[begins[at] : begins[end] if end < len(begins) else len(text)]])
                blocks = Blocks.of(sequences(words.hashes(), gram), gram, width, words.of_text())
                yield words, blocks, np.full(len(blocks.start), low), blocks.start + at
            continue
        words = Words(texts[low:high])
        text_of = words.of_text()
        blocks = Blocks.of(sequences(words.hashes(), gram), gram, width, text_of)
        own = text_of[blocks.start]
        yield words, blocks, own + low, blocks.start - words.first[own]


def word_starts(text: bytes) -> np.ndarray:
    """Byte at which each word of a text begins."""
    space = SPACES[np.frombuffer(text, np.uint8)]
    begins = ~space
    begins[1:] &= space[:-1]
    return np.flatnonzero(begins)


def remove_repeated_passages(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", width: int = 20, gram: int = 4
) -> DataFrame:
    """Per row of ``docs``: ``id_column``, ``n_words``, ``n_removed``, ``kept_text``, the kept words joined by a space.

    Words are runs of bytes other than space and U+0009 to U+000D. Removes each
    word covered by a window of ``width`` words whose sequence also starts
    earlier: under a smaller id, or earlier in the same text. Windows are judged
    on the input. Null, empty and blank texts have no words. A row with a null id
    is returned with all its words and isn't compared. Rows that repeat an id
    with its text start at the same places and lose nothing to each other. Of
    rows with one id and different texts, that with the smaller digest is the
    earlier one, and each loses its own words. A text may have any length.

    1. Anchor hashes that occur once are found by a count and drop out.
    2. Equal blocks are collapsed by digest; all but the first go as a whole.
    3. Of anchors with several different blocks, the first of each goes through
       the automaton of its shard, which tells where each phrase starts first.
       An anchor with very many blocks is split by the place of the window and
       beyond that by its content, so that no shard grows with the corpus.
    """
    rows = with_digest(docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).cast("string").alias("text")))
    known = rows.where("id is not null")
    counted = known.mapInArrow(_keys(width, gram), "key long").groupBy("key").agg(F.count("*").alias("times"))
    # Kept, because Spark splits a hot key of a join only if no aggregate shares the join's stage.
    repeated = keep(counted.where("times > 1").select("key"), "repeated-keys")
    blocks = known.mapInArrow(_blocks(width, gram), "id long, own long, key long, digest long, check long, start int, windows int, anchor int")
    again = keep(blocks.join(repeated, "key"), "repeated-anchors")
    different = keep(
        again.groupBy("key", "digest", "check").agg(F.count("*").alias("times"), F.min(F.struct("id", "own", "start", "windows", "anchor")).alias("r")),
        "different-blocks",
    )
    several = different.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    compared = keep(
        different.join(keep(several, "several"), "key")
        .select("key", "n", "r.*")
        .groupBy("id", "own")
        .agg(F.collect_list(F.struct("key", "n", "start", "windows", "anchor")).alias("blocks")),
        "compared-blocks",
    )
    passages = keep(
        known.dropDuplicates(["id", "own"])
        .join(compared, ["id", "own"])
        .mapInArrow(_cut(width, gram), "key long, id long, own long, start int, windows int, bytes binary"),
        "passages",
    )
    total = passages.agg(F.sum(F.length("bytes"))).first()[0] or 0
    shards = max(1, -(-int(total) // SHARD_BYTES))
    located = passages.groupBy(F.pmod(F.col("key"), F.lit(shards)).alias("shard")).applyInPandas(
        _locator(width), "id long, own long, low int, high int"
    )
    end = F.col("start") + F.col("windows") + F.lit(width - 1)
    # Kept like the keys above: an aggregate in the join's stage would leave a hot digest in one task.
    doubled = different.where("times > 1").select("key", "digest", "check", F.struct("r.id", "r.own", "r.start").alias("first"))
    later = (
        again.join(keep(doubled, "doubled"), ["key", "digest", "check"])
        .where(F.struct("id", "own", "start") != F.col("first"))
        .select("id", "own", F.col("start").alias("low"), end.cast("int").alias("high"))
    )
    spans = keep(later.unionByName(located).groupBy("id", "own").agg(F.collect_set(F.struct("low", "high")).alias("spans")), "spans")
    return rows.join(spans, ["id", "own"], "left").mapInArrow(
        _removed(), "id long, n_words long, n_removed long, kept_text binary"
    ).withColumnRenamed("id", id_column)


def _keys(width: int, gram: int):
    def run(batches):
        for batch in small(batches):
            for _, blocks, _, _ in blocks_in(texts_of(batch), width, gram):
                yield pa.RecordBatch.from_arrays([pa.array(blocks.key.view(np.int64))], ["key"])

    return run


def _blocks(width: int, gram: int):
    def run(batches):
        for batch in small(batches):
            ids, own = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("id", "own"))
            for words, blocks, text, start in blocks_in(texts_of(batch), width, gram):
                last = blocks.start + blocks.windows + width - 2
                digest, check = digests(words.data, words.start[blocks.start], words.end[last])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids[text]),
                        pa.array(own[text]),
                        pa.array(blocks.key.view(np.int64)),
                        pa.array(digest),
                        pa.array(check),
                        pa.array(start.astype(np.int32)),
                        pa.array(blocks.windows.astype(np.int32)),
                        pa.array(blocks.anchor.astype(np.int32)),
                    ],
                    ["id", "own", "key", "digest", "check", "start", "windows", "anchor"],
                )

    return run


def _cut(width: int, gram: int):
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]

    def packed(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["key", "id", "own", "start", "windows", "bytes"])

    def run(batches):
        for batch in small(batches):
            out, held = [], 0
            columns = (batch.column(c).to_pylist() for c in ("id", "own", "blocks"))
            for identity, own, blocks, text in zip(*columns, texts_of(batch)):
                words = Words([text])
                whole, begin, end = words.data.tobytes(), words.start, words.end
                for b in blocks:
                    by_place, by_content = parts_of(b["n"], width - gram + 1)
                    step = 1 if by_content > 1 else max(1, width // by_place)
                    at = 0
                    while at < b["windows"]:
                        distance = b["anchor"] - at
                        count = min(b["windows"] - at, distance % step + 1 if by_place > 1 else b["windows"])
                        start = b["start"] + at
                        piece = whole[begin[start] : end[start + count + width - 2]]
                        label = b["key"].to_bytes(8, "little", signed=True) + (distance // step if by_place > 1 else 0).to_bytes(8, "little")
                        if by_content > 1:
                            label += (_hash(piece) % by_content).to_bytes(8, "little")
                        out.append((_hash(label) >> 1, identity, own, start, count, piece))
                        held += len(piece)
                        at += count
                if held > 4 << 20:
                    yield packed(out)
                    out, held = [], 0
            if out:
                yield packed(out)

    return run


def _hash(data: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(data, digest_size=8).digest(), "little")


def recurring_phrases(passages: list[bytes], width: int) -> list[bytes]:
    """Windows of ``width`` words that the passages hold more than once, each between spaces."""
    seen: set[bytes] = set()
    again: set[bytes] = set()
    for passage in passages:
        words = passage.split(b" ")
        for i in range(len(words) - width + 1):
            phrase = b" " + b" ".join(words[i : i + width]) + b" "
            (again if phrase in seen else seen).add(phrase)
    return sorted(again)


def phrase_automaton(phrases: list[bytes]) -> ahocorasick.Automaton:
    """Finds phrases of bytes; every byte stands for the character of its number."""
    automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
    for number, phrase in enumerate(phrases):
        automaton.add_word(phrase.decode("latin-1"), number)
    automaton.make_automaton()
    return automaton


def _locator(width: int):
    """Spans of a shard's passages whose phrases start earlier in another of its passages."""

    def run(shard: pd.DataFrame) -> pd.DataFrame:
        texts = shard["bytes"].tolist()
        phrases = recurring_phrases(texts, width)
        out: list[tuple[int, int, int, int]] = []
        if phrases:
            automaton = phrase_automaton(phrases)
            first: dict[int, tuple[int, int, int]] = {}
            found: list[tuple[tuple[int, int, int], int]] = []
            for identity, own, start, text in zip(*(shard[c].tolist() for c in ("id", "own", "start")), texts):
                padded = b" " + text + b" "
                # The first space of a match is the one before its first word.
                before = np.cumsum(np.frombuffer(padded, np.uint8) == 32)
                for end, number in automaton.iter(padded.decode("latin-1")):
                    at = (identity, own, start + int(before[end]) - 1 - width)
                    found.append((at, number))
                    if number not in first or at < first[number]:
                        first[number] = at
            out = sorted({(*at, at[2] + width) for at, n in found if first[n] != at})
        return pd.DataFrame(out, columns=["id", "own", "low", "high"]).astype(
            {"id": "int64", "own": "int64", "low": "int32", "high": "int32"}
        )

    return run


def _removed():
    def run(batches):
        for batch in small(batches):
            totals, removed, kept = [], [], []
            for text, own in zip(texts_of(batch), batch.column("spans").to_pylist()):
                words = Words([text])
                n = int(words.count[0])
                at, cut, left = 0, 0, []
                for low, high in sorted((s["low"], s["high"]) for s in own or ()):
                    if low > at:
                        left.append((at, low))
                    cut += max(0, high - max(at, low))
                    at = max(at, high)
                if at < n:
                    left.append((at, n))
                whole = words.data.tobytes()
                totals.append(n)
                removed.append(cut)
                kept.append(b" ".join(whole[words.start[low] : words.end[high - 1]] for low, high in left))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(totals, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.binary())],
                ["id", "n_words", "n_removed", "kept_text"],
            )

    return run


@query
def op9_phrase_dedup(spark, sf_dir):
    found = remove_repeated_passages(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))

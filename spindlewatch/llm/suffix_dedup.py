"""Removal of repeated byte strings by a hash-compared suffix sort.

Two suffixes are compared by their longest common extension, which a binary
search over prefix polynomial hashes finds in a logarithmic number of steps; a
mergesort uses that comparison. Neighbours in suffix order with a common
extension of a whole window hold a repeated string, and their bytes are compared
once more, so that no collision of these hashes removes anything. Whole equal
blocks, which are most copies, are told by digests of 128 bits before the sort.

Suffixes are brought together by content: all windows that may be equal lie in
blocks with one anchor hash (see ``blocks``), and only suffixes at the same place
before the anchor are sorted against each other.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spindlewatch.llm.blocks import PIECE, Blocks, parts_of, pieces
from spindlewatch.llm.common import keep, query, slices, small, table, texts_of
from spindlewatch.llm.hashing import Prefix

GROUP_BYTES = 8 << 20


def blocks_in(texts: list[bytes], width: int, gram: int):
    """(text number, bytes of a piece's buffer, blocks, their text numbers, offset) for pieces of all texts."""
    for low, high in slices([len(t) for t in texts], PIECE):
        if high - low == 1 and len(texts[low]) > PIECE:
            for at, end in pieces(len(texts[low]), width):
                data = np.frombuffer(texts[low][at:end], np.uint8)
                found = Blocks.of(Prefix(data).grams(gram), gram, width, np.zeros(len(data), np.int32))
                yield data, found, np.full(len(found.start), low), found.start + at
            continue
        data = np.frombuffer(b"".join(texts[low:high]), np.uint8)
        sizes = [len(t) for t in texts[low:high]]
        text = np.repeat(np.arange(high - low, dtype=np.int32), sizes)
        found = Blocks.of(Prefix(data).grams(gram), gram, width, text)
        offsets = np.cumsum([0, *sizes])
        yield data, found, text[found.start] + low, found.start - offsets[text[found.start]]


def digests(data: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Digests of 128 bits of ranges of bytes, as two columns of numbers."""
    whole = memoryview(data)
    joined = b"".join(hashlib.blake2b(whole[s:e], digest_size=16).digest() for s, e in zip(low.tolist(), high.tolist()))
    return np.frombuffer(joined, np.int64).reshape(-1, 2).T


def common_extension(prefix: Prefix, x: np.ndarray, y: np.ndarray, most: int) -> np.ndarray:
    """Length of the common beginning, ``most`` at most, of the suffixes at x and at y."""
    low, high = np.zeros(len(x), np.int64), np.full(len(x), most, np.int64)
    for _ in range(most.bit_length()):
        middle = (low + high + 1) >> 1
        same = prefix.of(x, x + middle) == prefix.of(y, y + middle)
        low = np.where(same, middle, low)
        high = np.where(same, high, middle - 1)
    return low


def suffix_order(data: np.ndarray, prefix: Prefix, place: np.ndarray, segment: np.ndarray, width: int) -> np.ndarray:
    """Items sorted by (segment, first ``width`` bytes of the suffix), ties by item number; ``segment`` ascends.

    A bottom-up mergesort of all segments at a time: every item finds its place
    in the neighbouring run by binary search.
    """
    order = np.arange(len(place))
    begin = np.searchsorted(segment, segment, "left")
    end = np.searchsorted(segment, segment, "right")
    longest = int((end - begin).max(initial=1))
    slot = order - begin
    span = 1
    while span < longest:
        run = slot // span
        low = np.minimum(begin + (run ^ 1) * span, end)
        high = np.minimum(low + span, end)
        base, own, after = low.copy(), slot % span, run & 1
        while True:
            open_ = np.flatnonzero(low < high)
            if not len(open_):
                break
            middle = (low[open_] + high[open_]) >> 1
            x, y = place[order[open_]], place[order[middle]]
            extension = common_extension(prefix, x, y, width)
            last = np.minimum(extension, width - 1)
            a, b = data[x + last], data[y + last]
            # Equal ones of the left run go first.
            up = (b < a) | ((extension == width) & (after[open_] == 1))
            low[open_] = np.where(up, middle + 1, low[open_])
            high[open_] = np.where(up, high[open_], middle)
        target = begin + (run >> 1) * 2 * span + own + (low - base)
        moved = np.empty_like(order)
        moved[target] = order
        order = moved
        span *= 2
    return order


def repeated_suffixes(
    data: np.ndarray, place: np.ndarray, segment: np.ndarray, width: int, spare_first: bool = False
) -> np.ndarray:
    """True for each item whose first ``width`` bytes another item of its segment has too.

    With ``spare_first`` the first of equal items stays False.
    """
    out = np.zeros(len(place), bool)
    by_segment = np.argsort(segment, kind="stable")
    ordered = segment[by_segment]
    alone = np.ones(len(ordered), bool)
    same = ordered[1:] == ordered[:-1]
    alone[1:] &= ~same
    alone[:-1] &= ~same
    items = by_segment[~alone]
    if not len(items):
        return out
    prefix = Prefix(data)
    items = items[suffix_order(data, prefix, place[items], segment[items], width)]
    x, y = place[items[:-1]], place[items[1:]]
    near = np.flatnonzero((segment[items[:-1]] == segment[items[1:]]) & (common_extension(prefix, x, y, width) == width))
    equal = np.ones(len(near), bool)
    for i in range(width):
        equal &= data[x[near] + i] == data[y[near] + i]
    out[items[near[equal] + 1]] = True
    if not spare_first:
        out[items[near[equal]]] = True
    for s in np.unique(segment[items[near[~equal]]]):  # a collision: the bytes decide for this segment
        own = np.flatnonzero(segment == s)
        content = pd.Series([data[p : p + width].tobytes() for p in place[own]])
        out[own] = content.duplicated("first" if spare_first else False)
    return out


def remove_repeats(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", width: int = 400, gram: int | None = None
) -> DataFrame:
    """Per row of ``docs``: ``id_column``, ``n_bytes``, ``n_removed``, ``n_spans`` and ``kept``, the remaining bytes.

    Removes every byte that a string of ``width`` bytes covers which starts at
    another place too, in the same or another text. Overlapping strings count
    and all are judged on the input. Null and empty texts have 0 bytes. A row
    with a null id is returned unchanged and isn't compared. A row repeated with
    its id counts as another place, so both lose what they share. Rows with one
    id and different texts are different places too, and each loses its own spans.
    """
    rows = with_digest(docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).cast("string").alias("text")))
    spans = repeated_spans(rows, width, gram)
    return rows.join(spans, ["id", "own"], "left").mapInArrow(
        _removed(), "id long, n_bytes long, n_removed long, n_spans long, kept binary"
    ).withColumnRenamed("id", id_column)


def cut_repeats(docs: DataFrame, width: int = 400, gram: int | None = None) -> DataFrame:
    """``docs`` without repeated strings of ``width`` bytes, but for the first place of each.

    The first place is that with the smallest ``doc_id`` and then the smallest
    offset. Characters are removed whole or stay. ``n_chars`` is counted anew, if
    there. A row that loses its whole text goes; texts that were empty or null
    stay, as do rows with a null id. Of rows with one id and different texts,
    that with the smaller digest is the earlier one, and each is cut by its own
    spans. Other columns may have any name.
    """
    rows = with_digest(docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text")))
    spans = repeated_spans(rows, width, gram, spare_first=True)
    names = docs.columns
    # The row travels as a struct, so that no column of it can clash with those of the join.
    whole = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), F.col("doc_id").cast("long").alias("id"), F.xxhash64(F.col("text").cast("string")).alias("own")
    )
    joined = whole.join(spans, ["id", "own"], "left").select(*[F.col("row").getField(c).alias(f"{i}") for i, c in enumerate(names)], "spans")
    text_at = str(names.index("text"))

    def run(batches):
        for batch in small(batches, text_at):
            texts, kept, out = batch.column(text_at).to_pylist(), [], []
            for text, spans in zip(batch.column(text_at).cast(pa.binary()).to_pylist(), batch.column("spans").to_pylist()):
                rest = text if text is None or not spans else whole_characters_left(text, [(s["low"], s["high"]) for s in spans])
                kept.append(not text or bool(rest))
                out.append(rest)
            columns = {c: batch.column(str(i)) for i, c in enumerate(names)}
            columns["text"] = pa.array(out, pa.binary()).cast(batch.schema.field(text_at).type)
            if "n_chars" in columns:
                counts = [n if a == b else len(b) for n, a, b in zip(columns["n_chars"].to_pylist(), texts, columns["text"].to_pylist())]
                columns["n_chars"] = pa.array(counts, columns["n_chars"].type)
            yield pa.RecordBatch.from_arrays(list(columns.values()), names).filter(pa.array(kept, pa.bool_()))

    return joined.mapInArrow(run, docs.schema)


def whole_characters_left(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """UTF-8 ``text`` without the characters that lie wholly in the spans' union."""
    out, at = [], 0
    for low, high in union(spans):
        while low < high and text[low] & 0xC0 == 0x80:
            low += 1
        while low < high < len(text) and text[high] & 0xC0 == 0x80:
            high -= 1
        out.append(text[at:low])
        at = max(low, high)
    out.append(text[at:])
    return b"".join(out)


def union(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans that touch or overlap joined, in order."""
    out: list[tuple[int, int]] = []
    for low, high in sorted(spans):
        if out and low <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], high))
        else:
            out.append((low, high))
    return out


def with_digest(rows: DataFrame) -> DataFrame:
    """(id, own, text): ``own`` tells rows with one id and different texts apart."""
    return rows.select("id", F.xxhash64("text").alias("own"), "text")


def repeated_spans(rows: DataFrame, width: int, gram: int | None = None, spare_first: bool = False) -> DataFrame:
    """(id, own, spans): the byte spans of each of ``rows`` (id, own, text) that repeated strings cover.

    1. Anchor hashes that occur once are found by a count and drop out with
       their blocks, which leaves the repeated part of the corpus.
    2. Equal blocks are collapsed by a digest of 128 bits, which stands for their
       bytes; each occurrence is removed whole.
    3. Of anchors with several different blocks, one of each goes through the
       suffix sort. An anchor with very many blocks is split by the place of
       the window, beyond that by the window's content, so that no group grows
       with the corpus.

    A text that repeats one byte has a block per byte; otherwise a block stands
    for about half a window of bytes.
    """
    gram = gram or max(1, width // 8)
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
    cut = keep(
        known.dropDuplicates(["id", "own"])
        .join(compared, ["id", "own"])
        .mapInArrow(_cut(width, gram), "key long, id long, own long, start int, windows int, anchor int, bytes binary"),
        "block-bytes",
    )
    total = cut.agg(F.sum(F.length("bytes") + 64 * F.col("windows"))).first()[0] or 0
    groups = max(1, -(-int(total) // GROUP_BYTES))
    sorted_ = cut.groupBy(F.pmod(F.col("key"), F.lit(groups)).alias("group")).applyInPandas(
        _sorter(width, spare_first), "id long, own long, low long, high long"
    )
    doubled = different.where("times > 1").select("key", "digest", "check", F.struct("r.id", "r.own", "r.start").alias("first"))
    equal = again.join(keep(doubled, "doubled"), ["key", "digest", "check"])
    if spare_first:
        equal = equal.where(F.struct("id", "own", "start") != F.col("first"))
    equal = equal.select("id", "own", F.col("start").cast("long").alias("low"), (F.col("start") + F.col("windows") + F.lit(width - 1)).cast("long").alias("high"))
    return keep(equal.unionByName(sorted_).groupBy("id", "own").agg(F.collect_set(F.struct("low", "high")).alias("spans")), "spans")


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
            for data, blocks, text, start in blocks_in(texts_of(batch), width, gram):
                digest, check = digests(data, blocks.start, blocks.start + blocks.windows + width - 1)
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
    names = ["key", "id", "own", "start", "windows", "anchor", "bytes"]

    def run(batches):
        for batch in small(batches):
            out, held = [], 0
            columns = (batch.column(c).to_pylist() for c in ("id", "own", "blocks"))
            for identity, own, blocks, text in zip(*columns, texts_of(batch)):
                for b in blocks:
                    by_place, by_content = parts_of(b["n"], width - gram + 1)
                    # Windows whose anchor lies equally far behind their start share a part.
                    step = 1 if by_content > 1 else max(1, width // by_place)
                    at = 0
                    while at < b["windows"]:
                        distance = b["anchor"] - at
                        count = min(b["windows"] - at, distance % step + 1 if by_place > 1 else b["windows"])
                        start = b["start"] + at
                        piece = text[start : start + count + width - 1]
                        part = distance // step if by_place > 1 else 0
                        label = b["key"].to_bytes(8, "little", signed=True) + part.to_bytes(8, "little")
                        if by_content > 1:
                            label += (hash_of(piece) % by_content).to_bytes(8, "little")
                        out.append((hash_of(label) >> 1, identity, own, start, count, distance, piece))
                        held += len(piece)
                        at += count
                if held > 4 << 20:
                    yield _rows(out, names)
                    out, held = [], 0
            if out:
                yield _rows(out, names)

    return run


def hash_of(data: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(data, digest_size=8).digest(), "little")


def _rows(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


def _sorter(width: int, spare_first: bool):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["id", "own", "start"], ignore_index=True)
        pieces_ = group["bytes"].tolist()
        data = np.frombuffer(b"".join(pieces_), np.uint8)
        base = np.cumsum([0, *map(len, pieces_[:-1])])
        windows = group["windows"].to_numpy(np.int64)
        item = np.repeat(np.arange(len(group)), windows)
        nth = np.arange(len(item)) - np.repeat(np.cumsum(windows) - windows, windows)
        _, key = np.unique(group["key"].to_numpy(), return_inverse=True)
        segment = key[item] * (width + 1) + (group["anchor"].to_numpy(np.int64)[item] - nth)
        hit = np.flatnonzero(repeated_suffixes(data, base[item] + nth, segment, width, spare_first))
        # Runs of neighbouring windows make one span.
        new = np.ones(len(hit), bool)
        new[1:] = (np.diff(hit) > 1) | (np.diff(item[hit]) != 0)
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(hit)) - 1
        start = group["start"].to_numpy(np.int64)[item[hit]] + nth[hit]
        at = item[hit[first]]
        spans = {"id": group["id"].to_numpy()[at], "own": group["own"].to_numpy()[at], "low": start[first], "high": start[last] + width}
        return pd.DataFrame(spans).astype("int64")

    return run


def _removed():
    names = ["id", "n_bytes", "n_removed", "n_spans", "kept"]

    def run(batches):
        for batch in small(batches):
            texts = texts_of(batch)
            found = batch.column("spans").to_pylist()
            sizes, removed, spans, kept = [], [], [], []
            for text, own in zip(texts, found):
                gone = union([(s["low"], s["high"]) for s in own or ()])
                ends = [0, *(high for _, high in gone)]
                rest = b"".join(text[at:low] for at, low in zip(ends, [*(low for low, _ in gone), len(text)]))
                sizes.append(len(text))
                removed.append(len(text) - len(rest))
                spans.append(len(gone))
                kept.append(rest)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), *(pa.array(c, pa.int64()) for c in (sizes, removed, spans)), pa.array(kept, pa.binary())], names
            )

    return run


@query
def op7_suffix_array_dedup(spark, sf_dir):
    found = remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))

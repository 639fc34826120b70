"""Deduplication operators against brute force, with odd rows."""

from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from spindlewatch.llm import phrase_dedup
from spindlewatch.llm.blocks import HOT_BLOCKS, Blocks, parts_of, pieces
from spindlewatch.llm.common import components
from spindlewatch.llm.minhash_dedup import near_duplicates
from spindlewatch.llm.phrase_dedup import phrase_automaton, remove_repeated_passages
from spindlewatch.llm.suffix_dedup import cut_repeats, remove_repeats, repeated_suffixes, whole_characters_left

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def corpus(seed=4, n=60):
    random.seed(seed)
    words = ["alpha", "beta", "Gamma", "dé", "e", "zeta,", "eta"]
    shared = [" ".join(random.choice(words) for _ in range(30)) for _ in range(4)]
    rows = []
    for i in range(n):
        own = " ".join(random.choice(words) + str(random.randrange(400)) for _ in range(random.randrange(60)))
        rows.append((i, own + random.choice(["", " ", "\n\t"]) + random.choice(shared) + (" tail" + str(i)) * (i % 3)))
    rows += [(n, None), (n + 1, ""), (n + 2, " \n\t "), (n + 3, "a" * 700), (n + 4, rows[0][1]), (n + 5, rows[0][1]), (n + 6, "one two")]
    return rows


def covered(size, starts, width):
    out = [False] * size
    for s in starts:
        out[s : s + width] = [True] * width
    return out


def test_suffix_sort_against_brute_force(documents):
    rows, width = corpus(), 40
    texts = {i: (t or "").encode() for i, t in rows}
    seen = {}
    for t in texts.values():
        for p in range(len(t) - width + 1):
            seen[t[p : p + width]] = seen.get(t[p : p + width], 0) + 1
    found = {r.doc_id: r for r in remove_repeats(documents(rows), width=width).collect()}
    assert set(found) == set(texts)
    for i, t in texts.items():
        gone = covered(len(t), [p for p in range(len(t) - width + 1) if seen[t[p : p + width]] > 1], width)
        assert bytes(found[i].kept) == bytes(b for b, g in zip(t, gone) if not g)
        assert found[i].n_removed == sum(gone)
        assert found[i].n_spans == sum(g and not (p and gone[p - 1]) for p, g in enumerate(gone))


def test_cut_spares_the_first_place(documents):
    rows, width = corpus(), 40
    seen, wanted = set(), {}
    for i, t in rows:
        data = (t or "").encode()
        starts = []
        for p in range(len(data) - width + 1):
            if data[p : p + width] in seen:
                starts.append(p)
            seen.add(data[p : p + width])
        gone = covered(len(data), starts, width)
        spans = [(p, p + 1) for p, g in enumerate(gone) if g]
        rest = whole_characters_left(data, spans).decode()
        if not t or rest:
            wanted[i] = None if t is None else rest
    docs = documents(rows)
    out = cut_repeats(docs, width)
    assert out.columns == docs.columns
    found = out.collect()
    assert {r.doc_id: r.text for r in found} == wanted
    assert all(r.n_chars == len(r.text) for r in found if r.text is not None)


@pytest.mark.parametrize("spare", [False, True])
def test_suffix_sort_with_many_equal_strings(spare):
    data = np.frombuffer(b"abcabcabcabdabcabc", np.uint8)
    place = np.arange(len(data) - 3)
    found = repeated_suffixes(data, place, np.zeros(len(place), int), 4, spare)
    text = data.tobytes()
    grams = [text[p : p + 4] for p in place]
    assert found.tolist() == [grams.index(g) < p if spare else grams.count(g) > 1 for p, g in enumerate(grams)]


def test_phrases_against_brute_force(documents):
    rows, width = corpus(), 8
    found = {r.doc_id: r for r in remove_repeated_passages(documents(rows), width=width, gram=3).collect()}
    seen = set()
    for i, t in rows:
        words = WORD.findall((t or "").encode())
        starts = []
        for p in range(len(words) - width + 1):
            phrase = tuple(words[p : p + width])
            if phrase in seen:
                starts.append(p)
            seen.add(phrase)
        gone = covered(len(words), starts, width)
        assert bytes(found[i].kept_text) == b" ".join(w for w, g in zip(words, gone) if not g)
        assert (found[i].n_words, found[i].n_removed) == (len(words), sum(gone))


def test_automaton_finds_overlapping_phrases():
    found = list(phrase_automaton([b" a b ", b" b a "]).iter(" a b a b "))
    assert [n for _, n in found] == [0, 1, 0]


def test_near_duplicates_against_brute_force(documents):
    random.seed(2)
    rows = []
    for g in range(6):
        base = [f"w{random.randrange(5000)}" for _ in range(80)]
        for c in range(5):
            words = list(base)
            for _ in range(random.randrange(4)):
                words[random.randrange(80)] = f"x{random.randrange(5000)}"
            rows.append((g * 10 + c, " ".join(words)))
    rows += [(100, None), (101, ""), (102, "A b"), (103, "a  B"), (104, rows[0][1].upper()), (105, " ")]
    sets = {}
    for i, t in rows:
        w = WORD.findall((t or "").lower().encode())
        sets[i] = {tuple(w[p : p + 5]) for p in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    component = {i: i for i in sets}
    for _ in sets:
        for a in sets:
            for b in sets:
                if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                    component[a] = min(component[a], component[b])
    found = near_duplicates(documents(rows)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in found} == {
        i: (len(s), component[i], component[i] == i) for i, s in sets.items()
    }


def test_repeated_and_unnamed_rows(documents):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(1, text), (1, text), (None, text), (2, text)]
    near = sorted((r.doc_id or 0, r.component_id, r.kept) for r in near_duplicates(documents(rows)).collect())
    assert near == [(0, None, True), (1, 1, True), (1, 1, True), (2, 1, False)]
    bytes_ = sorted((r.doc_id or 0, r.n_removed > 0) for r in remove_repeats(documents(rows), width=50).collect())
    assert bytes_ == [(0, False), (1, True), (1, True), (2, True)]
    words = sorted((r.doc_id or 0, r.n_removed) for r in remove_repeated_passages(documents(rows)).collect())
    assert words == [(0, 0), (1, 0), (1, 0), (2, 60)]


def test_empty_tables(documents):
    empty = documents([]).where("false")
    for run in (near_duplicates, remove_repeats, remove_repeated_passages, cut_repeats):
        assert run(empty).count() == 0


def test_components_of_a_long_chain(spark):
    links = spark.range(40).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert {r.component for r in components(links).collect()} == {0}


def test_blocks_hold_each_window_once():
    text = np.repeat([0, 1, 2], [50, 3, 400])
    grams = np.random.default_rng(0).integers(0, 1 << 63, 449, dtype=np.uint64)
    found = Blocks.of(grams, 5, 20, text)
    starts = [s + i for s, n in zip(found.start, found.windows) for i in range(n)]
    assert starts == [*range(31), *range(53, 53 + 381)]
    assert (found.anchor >= 0).all() and (found.anchor <= 15).all()


def test_long_texts_and_hot_keys_are_split():
    cut = pieces((1 << 20) * 2 + 5, 400)
    assert sum(e - s - 399 for s, e in cut) == (1 << 20) * 2 + 5 - 399
    assert parts_of(10) == (1, 1) and parts_of(9_000) == (3, 1) and parts_of(10_000_000)[1] > 1


def test_hot_keys_are_split_by_content_beyond_their_anchor_places():
    for blocks, places in ((100_000, 17), (1_000_000, 17), (4_000_000, 351), (50_000, 1)):
        by_place, by_content = parts_of(blocks, places)
        assert by_place <= max(2, places) and by_content > 1 and by_place * by_content * HOT_BLOCKS >= blocks
    # Equal windows of two texts meet in one part, and each window is in one.
    common = [f"w{i}" for i in range(24)]
    texts = [" ".join(["a", *common, "b"]), " ".join(["c", "d", *common, "e"])]
    block = lambda first: [{"key": 7, "n": 1_000_000, "start": first, "windows": 5, "anchor": 14}]
    batch = pa.RecordBatch.from_pylist([{"id": i, "own": 0, "text": t, "blocks": block(i + 1)} for i, t in enumerate(texts)])
    rows = [r for out in phrase_dedup._cut(20, 4)(iter([batch])) for r in out.to_pylist()]
    parts = [[(r["key"], r["bytes"]) for r in rows if r["id"] == i] for i in (0, 1)]
    assert len(parts[0]) == 5 and parts[0] == parts[1] and all(r["windows"] == 1 for r in rows)


def test_rows_with_one_id_and_different_texts_lose_their_own_spans(spark, documents):
    """Brute force over places (id, digest, offset): each row is cut by its own spans and by no other's."""
    shared = " ".join(f"w{i}" for i in range(40))
    other = " ".join(f"x{i}" for i in range(61))
    part = " ".join(shared.split()[:28])
    rows = [(3, f"{shared} one"), (3, other), (3, "short"), (5, f"two {shared}"), (7, None), (7, part)]
    docs = documents(rows)
    data = [(i, (t or "").encode()) for i, t in rows]
    width, places = 60, {}
    for n, (_, text) in enumerate(data):
        for p in range(len(text) - width + 1):
            places.setdefault(text[p : p + width], []).append((n, p))
    wanted = []
    for n, (i, text) in enumerate(data):
        gone = covered(len(text), [p for at in places.values() if len(at) > 1 for m, p in at if m == n], width)
        spans = sum(g and not before for g, before in zip(gone, [False, *gone]))
        wanted.append((i, len(text), sum(gone), spans, bytes(b for b, g in zip(text, gone) if not g)))
    found = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in remove_repeats(docs, width=width).collect()]
    assert sorted(found) == sorted(wanted)

    words = {(r.doc_id, r.n_words): r.n_removed for r in remove_repeated_passages(docs).collect()}
    assert words == {(3, 41): 0, (3, 61): 0, (3, 1): 0, (5, 41): 40, (7, 0): 0, (7, 28): 28}

    cut = sorted((r.doc_id, r.text or "") for r in cut_repeats(docs, width).collect())
    assert cut == [(3, "short"), (3, f"{shared} one"), (3, other), (5, "two "), (7, "")]


def test_columns_of_any_name_stay(documents):
    docs = documents([(1, "a" * 90), (2, "a" * 90)]).selectExpr("*", "'q' as _cut_id", "1 as spans2", "'z' as own", "7 as `row.x`")
    out = cut_repeats(docs, 50)
    assert out.columns == docs.columns
    assert [(r.doc_id, r._cut_id, r.own, r["row.x"]) for r in out.collect()] == [(1, "q", "z", 7)]


def test_phrases_of_long_texts_are_found_by_pieces(documents, monkeypatch):
    from spindlewatch.llm import blocks

    monkeypatch.setattr(phrase_dedup, "PIECE", 600)
    monkeypatch.setattr(blocks, "PIECE", 100)
    rows, width = corpus(), 8
    long = [b" ".join([t.encode() for _, t in rows if t])]
    cut = {(int(s), int(n)) for _, b, _, starts in phrase_dedup.blocks_in(long, width, 3) for s, n in zip(starts, b.windows)}
    count = len(WORD.findall(long[0]))
    assert sorted(s + k for s, n in cut for k in range(n)) == list(range(count - width + 1))
    found = {r.doc_id: r for r in remove_repeated_passages(documents([(1, "new " + long[0].decode()), (2, long[0].decode())]), width=width, gram=3).collect()}
    assert (found[2].n_words, found[2].n_removed) == (count, count) and found[1].n_words == count + 1

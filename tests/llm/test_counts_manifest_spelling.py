"""Token counts, Merkle manifest and spelling variants against brute force, with odd rows."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from spindlewatch.llm import merkle, spelling, token_counts
from spindlewatch.llm.merkle import manifest
from spindlewatch.llm.spelling import affected, decomposed, list_entries, near_pairs, spelling_variants
from spindlewatch.llm.token_counts import MODEL, Shortcut


def rows_of(df):
    return [tuple(row) for row in df.collect()]


# Token counts


@pytest.fixture(scope="module")
def shortcut():
    with open(MODEL, "rb") as file:
        return Shortcut(file.read())


def by_library(shortcut, texts):
    return [len(shortcut.library.encode(text)) for text in texts]


ODD = [
    b"", b" ", b"\n", b"  x  ", b"a\0b", b"\xff\xfe broken", "▁a b▁▁".encode(), b"<s></s><unk><0x0A>", b"\t\r\n",
    ("a" * 3000).encode(), (" " * 5000).encode(), "日本語 テスト 😀😀 ﷽".encode(), "é".encode() * 4000,
]


def test_odd_texts_count_as_in_the_library(shortcut):
    assert shortcut.count(ODD) == by_library(shortcut, ODD)
    assert shortcut.count([]) == []


def test_parts_end_at_cuts(shortcut, monkeypatch):
    monkeypatch.setattr(token_counts, "PART", 7)
    assert shortcut.count(ODD) == by_library(shortcut, ODD)
    monkeypatch.setattr(token_counts, "REMEMBERED", 3)
    assert shortcut.count(ODD) == by_library(shortcut, ODD)


@settings(max_examples=200, deadline=None)
@given(texts=st.lists(st.text(alphabet="abtheing \n▁.,é日<>0'", max_size=60), max_size=4))
def test_any_text_counts_as_in_the_library(shortcut, texts):
    raw = [text.encode() for text in texts]
    assert shortcut.count(raw) == by_library(shortcut, raw)


def test_pieces_that_stand_alone_are_one_token(shortcut):
    library = shortcut.library
    for piece in random.Random(3).sample(sorted(shortcut.alone), 300):
        assert len(library.encode("\n" + piece.replace("▁", " "))) == 3


def test_token_table(spark, documents, shortcut):
    long = "word " * 200_000 + "x" * 300_000
    texts = [(1, "a b"), (1, "a b"), (2, None), (None, "null id"), (3, ""), (4, long)]
    found = token_counts.token_counts(documents(texts), limit=2)
    assert found.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    raw = [(t or "").encode() for _, t in texts]
    wanted = [(i, len(r), n, n > 2) for (i, _), r, n in zip(texts, raw, by_library(shortcut, raw))]
    assert Counter(rows_of(found)) == Counter(wanted)
    assert rows_of(token_counts.token_counts(documents([]))) == []


def test_token_query_counts_every_document(spark, tables, shortcut):
    docs = spark.read.parquet(f"{tables}/documents.parquet").select("doc_id", "text").collect()
    wanted = {i: n for (i, _), n in zip(docs, by_library(shortcut, [t.encode() for _, t in docs]))}
    assert {r["doc_id"]: r["n_tokens"] for r in token_counts.op11_token_counts(spark, tables).collect()} == wanted


# Merkle manifest


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def levels_over(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([sha(*levels[-1][i : i + 3]) for i in range(0, len(levels[-1]), 3)])
    return levels


def beside(levels, at):
    out = []
    for level in levels[:-1]:
        low = at // 3 * 3
        out.append(("".join(level[low:at]), "".join(level[at + 1 : low + 3])))
        at //= 3
    return out


def brute_manifest(rows):
    """Rows are (doc_id, source, lang, n_chars, text)."""
    groups = {}
    for row in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r))):
        groups.setdefault(row[1], []).append(row)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: levels_over([leaf_of(r) for r in groups[s]]) for s in order}
    over = levels_over([trees[s][-1][0] for s in order])
    for at, source in enumerate(order):
        for i, row in enumerate(groups[source]):
            path = beside(trees[source], i) + beside(over, at)
            shown = row
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0 and row[4] is not None:
                shown = (*row[:4], row[4].replace("\n", ""))
            node = leaf_of(shown)
            for before, after in path:
                node = sha(before, node, after)
            root = over[-1][0]
            yield (row[0], leaf_of(row), trees[source][-1][0], root, sha(*[x for p in path for x in p]), node, node == root)


def checked(df):
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    return manifest(df, tampered={"text": F.replace("text", F.lit("\n"), F.lit(""))}, touched=even)


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def made(n, seed=1):
    draw = random.Random(seed)
    sources = [None, "", "a", "é", "b", "hot", "hot", "hot", "one"]
    rows = [(i, draw.choice(sources[:-1]), draw.choice(["en", None]), draw.choice([None, i]), f"t{i}\n" * (i % 3)) for i in range(n)]
    odd = [(None, "a", None, None, None), (None, "a", None, None, "x\n"), (3, "hot", "en", 1, "again"), (n, "one", "en", 1, "\n" * 9)]
    return rows + odd + [rows[5]] * 4


@pytest.mark.parametrize("depth", [1, 2, 4])
def test_manifest_is_that_of_brute_force(spark, monkeypatch, depth):
    """Low blocks make the roots recurse several times."""
    monkeypatch.setattr(merkle, "DEPTH", depth)
    monkeypatch.setattr(merkle, "BLOCK", 3**depth)
    rows = made(150)
    found = checked(spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' as id", "1 as node", "2 as grp", "3 as tag", "4 as path"))
    assert found.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert Counter(rows_of(found)) == Counter(brute_manifest(rows))


@pytest.mark.parametrize("n", [1, 2, 3, 4, 81, 82])
def test_small_tables(spark, n):
    rows = [(i, "s", "en", 1, "t\n") for i in range(n)]
    assert Counter(rows_of(checked(spark.createDataFrame(rows, SCHEMA)))) == Counter(brute_manifest(rows))


def test_empty_table_has_no_rows(spark):
    assert rows_of(checked(spark.createDataFrame([], SCHEMA))) == []


def test_a_very_long_text_is_a_leaf(spark):
    rows = [(0, "s", None, 1, "line\n" * 1_000_000), (1, "s", None, 1, "x")]
    assert Counter(rows_of(checked(spark.createDataFrame(rows, SCHEMA)))) == Counter(brute_manifest(rows))


def test_manifest_runs_without_python(spark, tables):
    plan = merkle.op12_merkle_manifest(spark, tables)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "InArrow" not in plan and "CartesianProduct" not in plan


# Spelling variants


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def brute_words(rows, every):
    found = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            if every and doc_id is not None:
                h = zlib.crc32(f"{doc_id}:{run}".encode())
                if h % every == 0:
                    run = run[: h % len(run)] + run[h % len(run) + 1 :]
            found[run] += 1
    return found


def brute_variants(rows, every=None, shortest=6, least=5, factor=5):
    words = {w: n for w, n in brute_words(rows, every).items() if len(w) >= shortest and n >= least}
    near = {w: [x for x in words if one_edit(w, x)] for w in words}
    form = {}
    for word, others in near.items():
        if others:
            best = min(others, key=lambda x: (-words[x], x))
            if words[best] >= factor * words[word]:
                form[word] = best
    for word, n in words.items():
        root = word
        while root in form:
            root = form[root]
        yield (word, form.get(word), root, n, len(near[word]), words[form[word]] if word in form else None)


def spelt(seed=2):
    draw = random.Random(seed)
    stems = ["banana", "bananas", "ananas", "Étudier", "étudieraient", "aaaaaa", "aaaaaaa", "abcdefgh", "abcdxfgh", "chainé"]
    rows = []
    for i in range(300):
        words = []
        for _ in range(20):
            word = draw.choice(stems)
            if draw.random() < 0.2:
                at = draw.randrange(len(word))
                word = word[:at] + draw.choice(["", "x", "é", "A"]) + word[at + draw.randrange(2) :]
            words.append(word)
        rows.append((i, draw.choice([" ", "-", "×"]).join(words)))
    # A chain of forms: each with at least five times the occurrences of the one before.
    rows += [(1000 + k, " ".join(["chainab"] * 5 + ["chainac"] * 25 + ["chaincc"] * 125 + ["chaindcc"] * 625)) for k in range(1)]
    odd = [(None, "banana " * 3), (5, None), (6, ""), (7, "123 ..."), (8, "q" * 50_000), (9, "z" * 30 + " "), rows[3], rows[3]]
    return rows + odd + [(2000 + k, "longlonglong" * 500) for k in range(5)] + [(3000 + k, "longlonglong" * 500 + "s") for k in range(5)]


@pytest.mark.parametrize("every", [None, 3, 199])
def test_variants_are_those_of_brute_force(documents, every):
    rows = spelt()
    found = spelling_variants(documents(rows), every=every)
    assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert Counter(rows_of(found)) == Counter(brute_variants(rows, every))


def test_a_chain_of_forms_ends_at_one_root(documents):
    found = {row["word"]: row["root"] for row in spelling_variants(documents(spelt())).collect()}
    assert found["chainab"] == found["chainac"] == found["chaincc"] == "chaindcc"


def test_no_words(documents):
    assert rows_of(spelling_variants(documents([]))) == []
    assert rows_of(spelling_variants(documents([(1, None), (2, "a b 1")]))) == []


def test_settings_that_could_lose_pairs_are_refused(documents):
    with pytest.raises(ValueError):
        spelling_variants(documents([]), shortest=5)
    with pytest.raises(ValueError):
        spelling_variants(documents([]), factor=1)


@settings(max_examples=400, deadline=None)
@given(
    word=st.text(alphabet="abé", min_size=6, max_size=12),
    at=st.integers(0, 12),
    new=st.sampled_from("abéx"),
    kind=st.sampled_from(["insert", "replace", "delete"]),
    frequent=st.sets(st.text(alphabet="abéx", min_size=2, max_size=4), max_size=40),
)
def test_words_one_edit_apart_meet_in_a_list(word, at, new, kind, frequent):
    """Whatever the dictionary is."""
    at %= len(word) + (kind == "insert")
    other = word[:at] + ("" if kind == "delete" else new) + word[at + (kind != "insert") :]
    if other == word or len(other) < 6:
        return
    counts = {gram: i for i, gram in enumerate(sorted(frequent), 1)}
    assert list_entries(word, counts) & list_entries(other, counts)


def test_the_bound_of_affected_grams(spark):
    grams = decomposed("abcdefgh", {"ab": 9, "abc": 9, "gh": 9})
    assert grams == [(0, 4), (1, 3), (2, 4), (3, 5), (4, 6), (5, 7), (6, 8)]
    assert affected(8, grams) == 3


def test_common_grams_make_no_long_lists(spark):
    """Words that all share their ending and their beginning, but not both with one middle."""
    words = [f"pre{a}{b}{c}{d}tion" for a in "abcd" for b in "efgh" for c in "ijkl" for d in "mnop"]
    table = spark.createDataFrame([(w, 5) for w in words], "word string, n long")
    frequent = spelling.frequent_grams(table)
    sizes = Counter(key for w in words for key in list_entries(w, frequent))
    assert max(sizes.values()) <= 64 < len(words)
    pairs = {(r["a"], r["b"]) for r in near_pairs(table).collect()}
    assert pairs == {(a, b) for a in words for b in words if one_edit(a, b)}

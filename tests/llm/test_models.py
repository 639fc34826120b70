"""Search, tiling, calibration, archives and the network in small, against plain ways."""

from __future__ import annotations

import gzip
import io
import random

import numpy as np
from pyspark.sql import types as T

from spindlewatch.llm.calibration import calibrated, isotonic
from spindlewatch.llm.decontamination import contaminated, tiles, word_hashes
from spindlewatch.llm.language import Network
from spindlewatch.llm.mixing import mixed, rake, sample
from spindlewatch.llm.topk_search import DualSearch, top_k
from spindlewatch.llm.toxicity import NEAREST, BlockMaxIndex, score_toxicity, terms_of
from spindlewatch.llm.warc import RecordParser, deflated, inflated, normalise, read_records, write_archives


def test_dual_search_is_exact_with_ties():
    r = np.random.default_rng(1)
    centers = r.integers(-50, 50, (6, 8))
    data = (centers[r.integers(0, 6, 900)] + r.integers(-2, 3, (900, 8))).astype(float)
    data[5] = data[6]
    ids = np.arange(900)
    search = DualSearch(data[::9], ids[::9], data, ids, 5)
    for q, best in zip(range(0, 900, 9), search.best):
        scores = data @ data[q]
        wanted = sorted((-scores[i], i) for i in ids if i != q)[:5]
        assert best == wanted
    assert search.pruned


def test_top_k_leaves_out_odd_vectors(spark):
    kind = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("lot", T.StringType())])
    rows = [(0, [1.0, 0.5]), (1, [1.0, 0.5]), (2, None), (3, [float("nan"), 1.0]), (4, [None, 1.0]), (5, [float("inf"), 1.0]), (None, [1.0, 1.0]), (6, [0.5, 0.5]), (7, [1.0])]
    found = top_k(spark.createDataFrame([(*r, "x") for r in rows], kind)).collect()
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in found) == [(0, 1, 1, 256 * 256 + 128 * 128), (0, 2, 6, 128 * 256 + 128 * 128)]
    assert top_k(spark.createDataFrame([], kind)).count() == 0


def test_tiles_catch_reordered_parts():
    item = "a1 b2 c3 d4 e5 f6 g7 h8 i9 j0 k1 l2".split()
    text = item[6:] + ["zz"] * 5 + item[:6]
    words = lambda w: word_hashes(" ".join(w).encode())
    found = tiles(words(item), words(text), 5)
    assert sorted(found) == [(0, 11, 6), (6, 0, 6)]
    assert tiles(words(item), words(["q"] * 30), 5) == []


def test_contaminated_documents(spark, documents):
    item = " ".join(f"w{i}" for i in range(30))
    parts = item.split(" ")
    bench = spark.createDataFrame([(1, item), (2, "few words"), (3, None), (None, item)], "item_id long, text string")
    moved = " ".join(["x"] * 40 + parts[15:] + ["y"] * 3 + parts[:15]).upper().replace(" ", ", ")
    docs = documents([(1, "start " + item), (2, moved), (3, " ".join(parts[:10])), (4, None), (5, ""), (None, item)])
    assert {(r.doc_id, r.item_id, r.coverage) for r in contaminated(docs, bench).collect()} == {(1, 1, 1.0), (2, 1, 1.0)}


def test_isotonic_is_monotone():
    x, y = np.array([0, 1, 1, 2, 3.0]), np.array([0, 1, 0, 0.2, 1.0])
    knots = isotonic(x, y, np.ones(5))
    assert (np.diff(calibrated(np.linspace(-1, 4, 50), knots)) >= 0).all()
    assert abs(calibrated(np.array([1.0]), knots)[0] - 0.4) < 1e-12


def test_gradients_by_finite_differences():
    net = Network(3, hidden=3)
    net.weights = {k: v.astype(np.float64) for k, v in net.weights.items()}
    data, labels = np.random.default_rng(0).integers(0, 256, (7, 4)), np.array([0, 1, 2, 1])
    _, grads = net.gradients(data, labels)
    for name in ("hf", "hb", "out", "cf"):
        weights, at = net.weights[name], (0,) * net.weights[name].ndim
        old = weights[at]
        losses = []
        for step in (1e-2, -1e-2):
            weights[at] = old + step
            losses.append(net.gradients(data, labels)[0])
        weights[at] = old
        assert abs((losses[0] - losses[1]) / 2e-2 - grads[name][at]) < 1e-3


def test_byte_gradients_by_finite_differences():
    net = Network(3, hidden=3)
    net.weights = {k: v.astype(np.float64) for k, v in net.weights.items()}
    data, labels = np.random.default_rng(0).integers(0, 5, (7, 4)), np.array([0, 1, 2, 1])
    _, grads = net.gradients(data, labels)
    for name in ("xf", "xb"):
        weights, at = net.weights[name], (data[3, 2], 4)
        old = weights[at]
        losses = []
        for step in (1e-2, -1e-2):
            weights[at] = old + step
            losses.append(net.gradients(data, labels)[0])
        weights[at] = old
        assert abs((losses[0] - losses[1]) / 2e-2 - grads[name][at]) < 1e-3


def test_pooled_probabilities_match_the_training_pass():
    net, texts = Network(3), [b"", b"abc", bytes(range(256)) * 3, b"x" * 128]
    total, seen = net.pooled(texts)
    for text, row, own in zip(texts, total, seen):
        assert own.sum() == len(text)
        if text:
            padded = np.frombuffer(text + b"\0" * (-len(text) % 128), np.uint8).reshape(-1, 128).T
            states = np.concatenate([net.states(padded, side) for side in "fb"], axis=2)
            p = net._softmax(states).transpose(1, 0, 2).reshape(-1, 3)[: len(text)]
            assert np.allclose(row, p.mean(axis=0), atol=1e-5)
            assert own.tolist() == np.bincount(p.argmax(axis=1), minlength=3).tolist()


def test_nearest_examples_are_exact():
    random.seed(0)
    terms = [f"t{i}" for i in range(30)]
    counts = [{random.choice(terms): random.randrange(1, 4) for _ in range(6)} for _ in range(300)]
    index = BlockMaxIndex.of(list(range(300)), counts, [i % 2 for i in range(300)], terms, [sum(t in c for c in counts) for t in terms])
    dense = np.zeros((300, 30))
    for i, c in enumerate(counts):
        at, weight = index.vector(c)
        dense[i, at] = weight
    for i in range(0, 300, 20):
        cosines = np.round(dense @ dense[i], 9)
        wanted = sorted((-s, n) for n, s in enumerate(cosines) if s > 0)[:15]
        assert [(-s, n) for s, n in index.nearest(counts[i])] == wanted


def test_toxicity_without_labels(spark, documents):
    labels = spark.createDataFrame([], "doc_id long, toxic int, quality int")
    assert [r.score for r in score_toxicity(documents([(1, "x"), (2, None)]), labels).collect()] == [0.0, 0.0]


def test_toxicity_indexes_every_term_of_few_examples(spark, documents):
    # 60 examples: chi square of a term cannot reach 30 in a corpus where it marks a third of the toxic ones.
    def text(i):
        return f"common words about garden {'rose' if i % 2 else 'tulip'} plot{chr(97 + i % 26)} " + (f"vile{chr(97 + i % 3)} insult" if i % 5 == 0 else "lovely day")

    rows = [(i, text(i)) for i in range(60)]
    labels = spark.createDataFrame([(i, int(i % 5 == 0), 1) for i in range(60)], "doc_id long, toxic int, quality int")
    new = [(1000, "a vileb insult in the garden"), (1001, "lovely tulip day in the garden"), (1002, None), (1003, ""), (1004, "xyzzy qwert")]
    found = {r.id: r for r in score_toxicity(documents(rows + new), labels).collect()}
    assert len(found) == 65
    # A clean text has neighbours too, and they are clean.
    assert len(found[1001].neighbours) == NEAREST and all(n % 5 for n in found[1001].neighbours)
    assert found[1000].score >= 0.5 > found[1001].score
    assert found[1000].evidence and not found[1001].evidence
    for i in (1002, 1003, 1004):
        assert found[i].neighbours == [] and found[i].score < 0.5


def test_rare_and_common_terms_give_exact_neighbours():
    r = np.random.default_rng(4)
    names = [f"t{i}" for i in range(4000)]
    counts = [{names[min(3999, int(z))]: int(r.integers(1, 4)) for z in r.zipf(1.3, 60)} for _ in range(500)]
    texts_with = [sum(t in c for c in counts) for t in names]
    index = BlockMaxIndex.of(list(range(500)), counts, [i % 2 for i in range(500)], names, texts_with, 0.05 + r.random(4000))
    assert (index.common >= 0).any() and len(index.numbers)
    dense = np.zeros((500, 4000))
    for i, c in enumerate(counts):
        at, weight = index.vector(c)
        dense[i, at] = weight
    for i in range(0, 500, 25):
        for without in (-1, i):
            query = np.zeros(4000)
            at, weight = index.vector(counts[i], 1 if without < 0 else 2)
            query[at] = weight
            wanted = sorted((-s, n) for n, s in enumerate(np.round(dense @ query, 9)) if s > 0 and n != without)[:15]
            assert [(-s, n) for s, n in index.nearest(counts[i], without=without)] == wanted


def test_mixing_keeps_rows_and_totals(spark, documents):
    docs = documents([(1, "a b c"), (2, None), (3, ""), (4, "d " * 50), (4, "d " * 50)])
    found = mixed(docs).collect()
    assert sorted(r.n_tokens for r in found) == [0, 0, 3, 50, 50]
    kept = sample(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in found if r.kept)
    assert mixed(docs.where("false")).count() == 0
    cells = spark.createDataFrame([("a", "x", "p", 90), ("a", "y", "q", 10), ("b", "x", "q", 30)], "source_cell string, lang_cell string, topic_cell string, tokens long")
    assert abs(sum(r.weight for r in rake(cells).collect()) - 130) < 1e-6


def test_archives_round_trip(spark, tmp_path):
    rows = [(1, "u", "<a>é\r\n\r\nWARC/1.1\r\n</a>"), (2, None, ""), (3, "u", None), (4, "u\r\nx", "<a>é\r\n\r\nWARC/1.1\r\n</a>"), (5, "u", "z" * 3_000_000), (None, "u", "n")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    write_archives(pages, f"file://{tmp_path}/whole")
    index = normalise(spark, f"file://{tmp_path}/whole", f"file://{tmp_path}/normal")
    found = {r.page_id: r for r in read_records(index, f"file://{tmp_path}/normal").collect()}
    assert {i: (r.record_type, r.refers_to) for i, r in found.items()} == {
        1: ("response", None), 2: ("response", None), 3: ("revisit", 2), 4: ("revisit", 1), 5: ("response", None)
    }
    assert bytes(found[1].payload).decode() == rows[0][2] and found[5].payload_bytes == 3_000_000
    for row in index.collect():
        data = (tmp_path / "normal" / row.archive).read_bytes()
        assert gzip.decompress(data[row.offset : row.offset + row.length]).startswith(b"WARC/1.1\r\n")


def test_streams_of_many_members():
    record = b"WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    stream = io.BytesIO(deflated(record) + deflated(record))
    parser = RecordParser()
    assert [r.payload for data in inflated(stream) for r in parser.feed(data)] == [b"abc", b"abc"]


def test_terms_of_a_text_are_numbered_as_their_counts_are():
    examples = ["Nasty nastier words", "plain words, plainly", "élan abcd abcde abcdef", ""]
    counts = [terms_of(text) for text in examples]
    terms = sorted(set().union(*counts))
    index = BlockMaxIndex.of([7, 3, 9, 5], counts, [1, 0, 0, 1], terms, [sum(t in c for c in counts) for t in terms])
    texts = [None, "", "12 --", "nastiest abcdefgh words wordy", "PLAIN plain unseen", "x" * 10_000, *examples]
    for text in texts:
        wanted, found = index.numbered(terms_of(text)), index.numbered_text(text)
        assert [list(a) for a in found] == [list(a) for a in wanted]


def test_equal_cosines_go_to_the_smaller_id_wherever_it_lies():
    counts = [terms_of("same text")] * 70 + [terms_of("another")]
    terms = sorted(set().union(*counts))
    ids = [*range(170, 100, -1), 1]
    index = BlockMaxIndex.of(ids, counts, [0] * 71, terms, [sum(t in c for c in counts) for t in terms])
    assert [ids[n] for _, n in index.nearest(counts[0], 5)] == [101, 102, 103, 104, 105]

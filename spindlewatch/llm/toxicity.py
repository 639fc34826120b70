"""Toxicity by the nearest labelled examples: exact TF-IDF cosine over a block-max inverted index.

Every term of the examples is indexed. Its weight is its idf among the examples,
times ``FLOOR`` plus its squared correlation with the label (chi square over the
number of examples), so that a marking word outweighs the words around it and no
term weighs nothing. Terms that no example holds are no axes of the space.

Examples are numbered by label and heaviest term and lie in blocks of numbers, so
that like ones share a block and its bounds are close. A common term, in more than
one of ``DENSE`` examples, has a row of weights in every block and the largest
weight of each block; any other term has a list of postings. A text takes the
postings of its rare terms in full, which with the block maxima of its common
terms bounds what each block can reach. It visits blocks in falling order of
that bound and stops once no block left can reach the worst of the k scores it
has. Blocks are scored for many texts at a time in single precision; all
examples that its error could put among the k are scored again in double
precision, so the k nearest are exact. Their votes, weighted by distance,
become a probability by isotonic regression over the examples themselves, each
one scored without its own vote and without the terms that only it holds, as a
new text has none of them.
"""

from __future__ import annotations

import itertools
import pickle
import re
from collections import Counter
from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spindlewatch.llm.calibration import calibrated, isotonic
from spindlewatch.llm.common import fold, keep, plain_uri, query, small, table
from spindlewatch.storage import scratch_folder

EXAMPLES = 1_500  # labelled texts of each class that are indexed, at most
FLOOR = 0.01  # added to a term's squared correlation with the label
EVIDENT = 3.84  # chi square (5 % level) from which a term is named as evidence; it takes part in the score at any
NEAREST = 15
BLOCK = 64
DENSE = 16
VISIT = 6  # blocks a text visits before what is left is bounded again; twice as many each time after
TEXTS = 128  # texts that are scored at a time
STEMS = (4, 5)
_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> Counter:
    """Counts of the words, in lower case."""
    return Counter(_WORD.findall((text or "").lower()))


def terms_of(text: str | None) -> Counter:
    """Counts of the words and, as ``word-``, of the beginnings of longer ones, all in lower case."""
    words = words_of(text)
    known = words.get
    for word, n in list(words.items()):
        size = len(word)
        for stem in STEMS:
            if size > stem:
                start = word[:stem] + "-"
                words[start] = known(start, 0) + n
    return words


def idf(texts_with: np.ndarray, texts: int) -> np.ndarray:
    return np.log(1 + texts / (1 + texts_with))


@dataclass
class BlockMaxIndex:
    """TF-IDF unit vectors of the examples: common terms by block, the others as postings."""

    vocabulary: dict[str, int]
    starts: np.ndarray  # of a term that is a word: the terms of its beginnings, -1 where it is shorter
    weight: np.ndarray  # of each term
    texts_with: np.ndarray
    common: np.ndarray  # a term's row in maxima and dense, -1 of a rare one
    maxima: np.ndarray  # common term x block
    dense: np.ndarray  # block x common term x place, in single precision
    begin: np.ndarray  # of an example's common terms, and one more
    rows: np.ndarray  # common term of each of them
    exact: np.ndarray  # and its weight
    first: np.ndarray  # of a term's postings, and one more
    numbers: np.ndarray  # example of each posting
    weights: np.ndarray
    ids: np.ndarray
    labels: np.ndarray

    @staticmethod
    def of(
        ids: list[int], counts: Iterable[dict[str, int]], labels: list[int], terms: list[str], texts_with: list[int], telling: np.ndarray | float = 1.0
    ) -> BlockMaxIndex:
        """``texts_with``: how many of the examples hold each of the terms; ``telling``: what its idf is multiplied with."""
        n = np.array(texts_with, np.int64)
        blocks = -(-len(ids) // BLOCK)
        common = np.where(n * DENSE > len(ids), 0, -1)
        common[common == 0] = np.arange((common == 0).sum())
        rows = int((common >= 0).sum())
        none = np.zeros(0, np.int64)
        maxima = np.zeros((rows, blocks))
        dense = np.zeros((blocks, rows, BLOCK), np.float32)
        vocabulary = {t: i for i, t in enumerate(terms)}
        begins = (vocabulary.get(t[:stem] + "-", -1) if len(t) > stem and t[-1] != "-" else -1 for t in terms for stem in STEMS)
        starts = np.fromiter(begins, np.int32, len(terms) * len(STEMS)).reshape(-1, len(STEMS))
        made = BlockMaxIndex(
            vocabulary, starts, idf(n, len(ids)) * telling, n, common, maxima, dense, none, none, none, none, none, none, np.array(ids, np.int64), np.array(labels)
        )
        found, held = [], []
        for number, own in enumerate(counts):
            at, weights = made.vector(own)
            row = common[at]
            shared = row[row >= 0]
            block, place = divmod(number, BLOCK)
            dense[block, shared, place] = weights[row >= 0]
            maxima[shared, block] = np.maximum(maxima[shared, block], weights[row >= 0])
            held.append((shared.astype(np.int32), weights[row >= 0]))
            found.append((at[row < 0], np.full((row < 0).sum(), number), weights[row < 0]))
        made.begin = np.cumsum([0, *(len(shared) for shared, _ in held)])
        made.rows, made.exact = (np.concatenate(c) for c in zip(*held)) if held else (none, np.zeros(0))
        at, numbers, weights = (np.concatenate(c) for c in zip(*found)) if found else (none, none, np.zeros(0))
        order = np.argsort(at, kind="stable")
        made.first = np.searchsorted(at[order], np.arange(len(terms) + 1))
        made.numbers, made.weights = numbers[order].astype(np.int32), weights[order]
        return made

    def numbered(self, counts: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of the terms that examples hold, in order, and their counts."""
        terms = np.fromiter(map(self.vocabulary.get, counts, itertools.repeat(-1)), np.int64, len(counts))
        times = np.fromiter(counts.values(), float, len(counts))
        held = np.flatnonzero(terms >= 0)
        held = held[np.argsort(terms[held])]
        return terms[held], times[held]

    def numbered_text(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """``numbered(terms_of(text))``, but the beginnings of a word that an example holds are looked up by its number."""
        words = words_of(text)
        find = self.vocabulary.get
        terms = np.fromiter(map(find, words, itertools.repeat(-1)), np.int64, len(words))
        times = np.fromiter(words.values(), float, len(words))
        known = terms >= 0
        others = [
            (number, n)
            for word, n in itertools.compress(words.items(), ~known)
            for stem in STEMS
            if len(word) > stem and (number := find(word[:stem] + "-", -1)) >= 0
        ]
        terms, times = terms[known], times[known]
        starts = self.starts[terms].ravel()
        more, n = np.array(others, np.int64).reshape(-1, 2).T
        at = np.concatenate([terms, starts[starts >= 0], more])
        counts = np.concatenate([times, np.repeat(times, len(STEMS))[starts >= 0], n])
        found, place = np.unique(at, return_inverse=True)
        return found, np.bincount(place, counts, len(found))

    def vector(self, counts: dict[str, int], least: int = 1) -> tuple[np.ndarray, np.ndarray]:
        return self.weighed(self.numbered(counts), least)

    def weighed(self, numbered: tuple[np.ndarray, np.ndarray], least: int = 1) -> tuple[np.ndarray, np.ndarray]:
        """Terms that ``least`` examples hold at least, and their weights, of length 1 together."""
        terms, times = numbered
        if least > 1:
            held = self.texts_with[terms] >= least
            terms, times = terms[held], times[held]
        weights = (1 + np.log(times)) * self.weight[terms]
        return terms, weights / np.sqrt((weights**2).sum()) if len(terms) else weights

    def nearest(self, counts: dict[str, int], k: int = NEAREST, without: int = -1) -> list[tuple[float, int]]:
        """The k examples of the highest cosine above 0, ties to the smaller id: (cosine, number)."""
        return self.near([counts], k, [without])[0]

    def near(self, texts: list[dict[str, int]], k: int = NEAREST, without: list[int] | None = None) -> list[list[tuple[float, int]]]:
        """``nearest`` of each text."""
        return self.near_numbered([self.numbered(counts) for counts in texts], k, without)

    def near_numbered(self, texts: list[tuple[np.ndarray, np.ndarray]], k: int = NEAREST, without: list[int] | None = None) -> list[list[tuple[float, int]]]:
        own = [-1] * len(texts) if without is None else without
        return [best for at in range(0, len(texts), TEXTS) for best in self._near(texts[at : at + TEXTS], k, own[at : at + TEXTS])]

    def _near(self, texts: list[tuple[np.ndarray, np.ndarray]], k: int, without: list[int]) -> list[list[tuple[float, int]]]:
        blocks, rows = self.dense.shape[:2]
        query, rare = np.zeros((len(texts), rows)), np.zeros((len(texts), blocks * BLOCK))
        for i, (numbered, left_out) in enumerate(zip(texts, without)):
            terms, weights = self.weighed(numbered, 1 if left_out < 0 else 2)
            row = self.common[terms]
            query[i, row[row >= 0]] = weights[row >= 0]
            rare[i] = self._rare(terms[row < 0], weights[row < 0])
        by_block = rare.reshape(len(texts), blocks, BLOCK)
        bounds = by_block.max(2) + query @ self.maxima
        single = query.astype(np.float32)
        margin = (rows + 8) * 2.0**-22  # above twice the error of a score in single precision
        # Of a text: what an example must reach; 0 is no neighbour.
        least = np.full(len(texts), 1e-12)
        scores = np.full((len(texts), blocks, BLOCK), -1, np.float32)
        rank = np.argsort(np.argsort(-bounds, axis=1, kind="stable"), axis=1)
        done, more = 0, VISIT
        while done < blocks:
            # Of each text: the next blocks of its own order, as far as they can still reach what is needed.
            wanted = (rank >= done) & (rank < done + more) & (bounds >= least[:, None])
            for block in np.flatnonzero(wanted.any(axis=0)):
                visit = np.flatnonzero(wanted[:, block])
                scores[visit, block] = single[visit] @ self.dense[block] + by_block[visit, block]
            least = np.maximum(least, self._worst(scores, k, without) - margin)
            done, more = done + more, 2 * more
        flat, out = scores.reshape(len(texts), -1), []
        for i, left_out in enumerate(without):
            numbers = np.flatnonzero(flat[i] >= least[i])
            numbers = numbers[numbers != left_out]
            exact = np.round(rare[i, numbers] + self._common(numbers, query[i]), 9)
            numbers, exact = numbers[exact > 0], exact[exact > 0]
            top = np.lexsort((self.ids[numbers], -exact))[:k]
            out.append(list(zip(exact[top].tolist(), numbers[top].tolist())))
        return out

    @staticmethod
    def _worst(scores: np.ndarray, k: int, without: list[int]) -> np.ndarray:
        """Of each text: the score of rank k so far, with a rank more where an example is left out."""
        flat = scores.reshape(len(scores), -1)
        rank = k + int(max(without) >= 0)
        return np.partition(flat, -rank, axis=1)[:, -rank] if flat.shape[1] >= rank else np.full(len(flat), -1.0)

    def _common(self, numbers: np.ndarray, query: np.ndarray) -> np.ndarray:
        """What common terms add to the score of these examples, in double precision."""
        low = self.begin[numbers]
        long = self.begin[numbers + 1] - low
        ends = np.cumsum(long)
        if not len(ends) or not ends[-1]:
            return np.zeros(len(numbers))
        at = np.arange(ends[-1]) + np.repeat(low - ends + long, long)
        return np.bincount(np.repeat(np.arange(len(numbers)), long), query[self.rows[at]] * self.exact[at], len(numbers))

    def _rare(self, terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """What rare terms add to the score of each example, padded to whole blocks."""
        size = self.dense.shape[0] * BLOCK
        low = self.first[terms]
        long = self.first[terms + 1] - low
        ends = np.cumsum(long)
        if not len(ends) or not ends[-1]:
            return np.zeros(size)
        at = np.arange(ends[-1]) + np.repeat(low - ends + long, long)
        return np.bincount(self.numbers[at], np.repeat(weights, long) * self.weights[at], size)

    def vote(self, near: list[tuple[float, int]]) -> float:
        """Share of the votes for label 1, each weighted by 1 / (distance + 0.05); 0 without neighbours."""
        if not near:
            return 0.0
        weights = np.array([1 / (1 - cosine + 0.05) for cosine, _ in near])
        return float((weights * self.labels[[n for _, n in near]]).sum() / weights.sum())


def examples(docs: DataFrame, labels: DataFrame, label: str, most: int = EXAMPLES) -> DataFrame:
    """(id, text, label): at most ``most`` labelled rows of each class, drawn by a hash of the id.

    Rows of fold 0 of 5 and rows with a null or other label are never drawn. The
    draw is made on ids, so texts are not shuffled: the drawn ids are broadcast,
    of which there are twice ``most`` at most.
    """
    known = labels.where(f"doc_id is not null and {label} in (0, 1)").where(fold("doc_id", 5) != 0)
    known = known.groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
    drawn = [known.where(F.col("label") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most) for c in (0, 1)]
    ids = drawn[0].unionByName(drawn[1]).select(F.col("doc_id").alias("id"), "label")
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), "text")
    return texts.join(F.broadcast(ids), "id").groupBy("id").agg(F.min("text").alias("text"), F.max("label").alias("label"))


def correlation(texts_with: np.ndarray, hits: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Squared correlation of each term's presence with the label; ``hits``: examples of label 1 that hold it."""
    total, toxic = len(labels), int(labels.sum())
    if not 0 < toxic < total:
        return np.zeros(len(texts_with))
    share = texts_with / total
    spread = share * (1 - share) * toxic * (total - toxic)
    return np.divide((hits - share * toxic) ** 2, spread, out=np.zeros(len(spread)), where=spread > 0)


@dataclass
class Model:
    """The index of the drawn examples, the calibration of its votes, and the terms that are evidence of label 1."""

    index: BlockMaxIndex
    knots: tuple[np.ndarray, np.ndarray]
    evident: frozenset[str]

    @staticmethod
    def of(rows: pa.Table, share: dict[int, int]) -> Model:
        """From the rows (id, label, terms) of the examples; ``share``: labelled rows of each class, drawn or not."""
        kinds, own = rows["label"].to_numpy(), rows["terms"].combine_chunks()
        codes = own.keys.dictionary_encode()
        terms, codes, times, first = codes.dictionary.to_pylist(), codes.indices.to_numpy(), own.items.to_numpy(), own.offsets.to_numpy()
        texts_with = np.bincount(codes, minlength=len(terms))
        hits = np.bincount(codes, np.repeat(kinds, np.diff(first)), len(terms))
        telling = correlation(texts_with, hits, kinds)

        heavy = (1 + np.log(times)) * (idf(texts_with, len(kinds)) * (FLOOR + telling))[codes]
        heaviest = [codes[low + np.argmax(heavy[low:high])] if high > low else -1 for low, high in zip(first, first[1:])]
        order = np.lexsort((rows["id"].to_numpy(), heaviest, kinds)) if len(kinds) else np.zeros(0, np.int64)

        def counts(low: int = 0, high: int = len(kinds)):
            for at in order[low:high]:
                own_codes = codes[first[at] : first[at + 1]].tolist()
                yield {terms[c]: n for c, n in zip(own_codes, times[first[at] : first[at + 1]].tolist())}

        index = BlockMaxIndex.of(rows["id"].to_numpy()[order], counts(), kinds[order], terms, texts_with, FLOOR + telling)
        evident = (telling * len(kinds) >= EVIDENT) & (hits * len(kinds) > texts_with * kinds.sum())
        named = frozenset(terms[i] for i in np.flatnonzero(evident).tolist())
        if not len(kinds):
            return Model(index, (np.zeros(1), np.zeros(1)), named)
        raw = []
        for at in range(0, len(kinds), TEXTS):
            some = range(at, min(at + TEXTS, len(kinds)))
            raw += [index.vote(near) for near in index.near(list(counts(some.start, some.stop)), without=list(some))]
        # Every class counts as it does among all labelled rows, not as drawn.
        drawn = np.bincount(index.labels, minlength=2)
        weight = np.array([share.get(c, 0) / max(1, drawn[c]) for c in (0, 1)])[index.labels]
        return Model(index, isotonic(np.array(raw), index.labels.astype(float), weight), named)


MODEL = "part int, data binary"
MODEL_PART = 8 << 20


def fitted(docs: DataFrame, labels: DataFrame) -> str:
    """Fits the model in one task, which holds no more than the drawn examples, and returns the folder it is kept in.

    The driver never holds it: every task that scores reads it from the shared folder.
    """
    counted = keep(examples(docs, labels, "toxic").mapInArrow(_counted, COUNTED), "examples")
    learn = labels.where("toxic in (0, 1)").where(fold("doc_id", 5) != 0)
    share = dict(learn.groupBy("toxic").count().collect())
    empty = pa.schema([("id", pa.int64()), ("label", pa.int32()), ("terms", pa.map_(pa.string(), pa.int32()))])

    def fit(batches):
        held = list(batches)
        data = pickle.dumps(Model.of(pa.Table.from_batches(held) if held else empty.empty_table(), share), protocol=5)
        for part, at in enumerate(range(0, len(data), MODEL_PART)):
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([data[at : at + MODEL_PART]])], ["part", "data"])

    uri = scratch_folder(docs.sparkSession, "toxicity-model")
    counted.repartition(1).sortWithinPartitions("id").mapInArrow(fit, MODEL).write.parquet(uri)
    return uri


def loaded(uri: str) -> Model:
    """The model in the folder ``uri``. Each task reads it and lets go of it: Python processes serve later stages too."""
    system, folder = fs.FileSystem.from_uri(plain_uri(uri))
    parts: dict[int, bytes] = {}
    for file in system.get_file_info(fs.FileSelector(folder)):
        if file.base_name.endswith(".parquet"):
            with system.open_input_file(file.path) as source:
                for row in pq.read_table(source).to_pylist():
                    parts[row["part"]] = row["data"]
    if not parts:  # Spark leaves out the fit of no examples
        return Model(BlockMaxIndex.of([], [], [], [], []), (np.zeros(1), np.zeros(1)), frozenset())
    return pickle.loads(b"".join(parts[part] for part in sorted(parts)))


COUNTED = "id long, label int, terms map<string,int>"


def _counted(batches):
    for batch in small(batches):
        counts = [list(terms_of(t).items()) for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), batch.column("label"), pa.array(counts, pa.map_(pa.string(), pa.int32()))], ["id", "label", "terms"]
        )


SCORED = "id long, score double, neighbours array<long>, evidence array<string>"


def score_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` as (id, score, neighbours, evidence), a row for a row; id, language and source are not inputs.

    Null, empty and other texts without a term of an example have no neighbours
    and the score of that. ``evidence`` names the text's terms that are surely
    more frequent in toxic examples. Without labelled examples every score is 0. Labels of one id
    that differ count as toxic. The index holds ``EXAMPLES`` texts of each class
    at most and lies in the shared folder; every text is scored whole.
    """
    model = fitted(docs, labels)

    def run(batches):
        index, knots = (fit := loaded(model)).index, fit.knots
        telltale = np.zeros(len(index.vocabulary), bool)
        telltale[[index.vocabulary[term] for term in fit.evident]] = True
        named = {index.vocabulary[term]: term for term in fit.evident}
        for batch in small(batches):
            numbered = [index.numbered_text(t) for t in batch.column("text").to_pylist()]
            found = index.near_numbered(numbered)
            scores = calibrated(np.array([index.vote(near) for near in found]), knots)
            near_ids = [[int(index.ids[n]) for _, n in near] for near in found]
            evidence = [sorted(named[term] for term in terms[telltale[terms]].tolist()) for terms, _ in numbered]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(scores, pa.float64()), pa.array(near_ids, pa.list_(pa.int64())), pa.array(evidence, pa.list_(pa.string()))],
                ["id", "score", "neighbours", "evidence"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text")).mapInArrow(run, SCORED)


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Rows of ``docs`` that score below the threshold, with their columns. One pass, no shuffle."""
    model = fitted(docs, labels)

    def run(batches):
        index, knots = (fit := loaded(model)).index, fit.knots
        for batch in small(batches):
            numbered = [index.numbered_text(t) for t in batch.column("text").to_pylist()]
            votes = np.array([index.vote(near) for near in index.near_numbered(numbered)])
            yield batch.filter(pa.array(calibrated(votes, knots) < threshold))

    return docs.mapInArrow(run, docs.schema)


@query
def op8_toxicity_neighbours(spark, sf_dir):
    scored = score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select(
        F.col("id").alias("doc_id"),
        (fold("id", 5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "neighbours",
    )

"""Tokens of whole texts by the whole-token shortcut.

Two things are proved once, from the vocabulary alone, before any text is read:

* Which neighbouring characters can ever share a token. A merge makes a piece of
  the vocabulary, so where no piece holds the characters ``ab`` in a row, no
  token reaches over that place, and the text can be cut there: into pre-tokens.
* Which pieces are one token when they stand alone between such cuts.

A pre-token that is such a piece counts one, without merging. The library merges
only the others, each distinct one once for a batch of texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property
from pathlib import Path

import numpy as np
import pyarrow as pa
import public_tokenizers
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spindlewatch.llm.common import query, small, table, texts_of

MODEL = public_tokenizers.path("piece_bpe_32k.model")
LIMIT = 4096
SPACE = "▁"  # fixed value: how the library writes a blank
GUARD = "\n"  # stands between texts and before a pre-token that is merged alone
PART = 1 << 20  # characters cut at a time
REMEMBERED = 1 << 17  # merged pre-tokens a task keeps, of at most 64 characters each


class Shortcut:
    """What is proved of a vocabulary, and the counts it allows. Its size is bounded by the vocabulary."""

    def __init__(self, model: bytes):
        self.model = model
        library = self.library
        pieces = [
            library.id_to_piece(i)
            for i in range(library.get_piece_size())
            if not (library.is_control(i) or library.is_unknown(i) or library.is_byte(i) or library.is_unused(i))
        ]
        if sum(library.is_byte(i) for i in range(library.get_piece_size())) != 256:
            raise ValueError("without byte pieces unknown characters run together, and texts can't be cut")
        pairs = {a + b for piece in pieces for a, b in zip(piece, piece[1:])}
        if any(GUARD in pair for pair in pairs) or library.normalize(f"a {GUARD} b") != f"{SPACE}a{SPACE}{GUARD}{SPACE}b":
            raise ValueError("the model normalizes texts, or a piece holds a line feed")
        letters = sorted(set("".join(pairs)))
        self.place = np.zeros(0x110000, np.uint16)  # 0: never beside another character in a piece
        self.place[[ord(c) for c in letters]] = np.arange(1, len(letters) + 1)
        self.glued = np.zeros((len(letters) + 1, len(letters) + 1), bool)
        for a, b in pairs:
            self.glued[self.place[ord(a)], self.place[ord(b)]] = True
        self.alone = {piece: 1 for piece, count in zip(pieces, self._merge(pieces)) if count == 1}
        self.merged: dict[str, int] = {}

    def __getstate__(self):
        return {"model": self.model, "place": self.place, "glued": self.glued, "alone": self.alone, "merged": {}}

    @cached_property
    def library(self) -> sentencepiece.SentencePieceProcessor:
        return sentencepiece.SentencePieceProcessor(model_proto=self.model)

    def _merge(self, cut: list[str]) -> list[int]:
        """Tokens of each pre-token, merged by the library behind a guard, which is one token after the leading blank."""
        found = self.library.encode([GUARD + text.replace(SPACE, " ") for text in cut], num_threads=1)
        return [len(ids) - 2 for ids in found]

    def _cuts(self, text: str) -> np.ndarray:
        """Places in ``text`` that no token reaches over, its ends left out."""
        places = self.place[np.frombuffer(text.encode("utf-32-le"), np.uint32)]
        return np.flatnonzero(~self.glued[places[:-1], places[1:]]) + 1

    def pretokens(self, text: str) -> Iterator[tuple[str, list[int]]]:
        """``text``, with blanks as the library writes them, in parts with the places where each is cut, both ends included.

        A part ends at a cut, so a text of any length takes memory for one part
        or for its longest pre-token.
        """
        start, size = 0, PART
        while start < len(text):
            part = text[start : start + size]
            cuts = [0, *self._cuts(part).tolist()]
            if start + size < len(text):
                if len(cuts) == 1:
                    size *= 2
                    continue
                part = part[: cuts[-1]]
            else:
                cuts.append(len(part))
            yield part, cuts
            start, size = start + len(part), PART

    def _sizes(self, cut: list[str]) -> np.ndarray:
        counts = [self.alone.get(text) or self.merged.get(text) for text in cut]
        missing = {text for text, count in zip(cut, counts) if count is None}
        if missing:
            rest = sorted(missing)
            found = dict(zip(rest, self._merge(rest)))
            if len(self.merged) + len(found) > REMEMBERED:
                self.merged.clear()
            self.merged.update((text, count) for text, count in list(found.items())[:REMEMBERED] if len(text) <= 64)
            counts = [found[text] if count is None else count for text, count in zip(cut, counts)]
        return np.array(counts, np.int64)

    def count(self, texts: list[bytes]) -> list[int]:
        """Tokens of each text. Bytes that are no UTF-8 go to the library as they are."""
        out = [0] * len(texts)
        joined, members = [], []
        for i, raw in enumerate(texts):
            if not raw:
                continue
            try:
                joined.append(SPACE + raw.decode().replace(" ", SPACE) + GUARD)
                members.append(i)
            except UnicodeDecodeError:
                out[i] = len(self.library.encode(raw))
        # Every text ends with a guard, which is a pre-token and a token.
        ends = np.cumsum([len(text) for text in joined])
        totals = np.zeros(len(joined), np.int64)
        at = 0
        for part, cuts in self.pretokens("".join(joined)):
            sizes = self._sizes([part[a:b] for a, b in zip(cuts, cuts[1:])])
            owner = np.searchsorted(ends, np.array(cuts[:-1]) + at, side="right")
            totals += np.bincount(owner, sizes, len(joined)).astype(np.int64)
            at += len(part)
        for i, total in zip(members, totals.tolist()):
            out[i] = total - 1
        return out


def token_counts(
    docs: DataFrame,
    model: str | bytes = MODEL,
    limit: int = LIMIT,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: ``id_column``, ``n_bytes``, ``n_tokens``, ``over_limit``.

    ``model`` is a sentencepiece file, read once on the driver, or its bytes.
    Counts are those of the library for the whole text, without special tokens.
    One pass over the texts, no shuffle. A null text counts as an empty one,
    which has no token; a null id is kept; repeated rows are counted each; other
    columns of ``docs`` are not looked at.
    """
    proved = Shortcut(Path(model).read_bytes() if isinstance(model, str) else model)
    shared = docs.sparkSession.sparkContext.broadcast(proved)  # bounded by the vocabulary

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shortcut = shared.value
        for batch in small(batches):
            texts = texts_of(batch)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    pa.array([len(text) for text in texts], pa.int64()),
                    pa.array(shortcut.count(texts), pa.int64()),
                ],
                ["id", "n_bytes", "n_tokens"],
            )

    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    counts = rows.mapInArrow(counted, f"id {rows.schema['id'].dataType.simpleString()}, n_bytes long, n_tokens long")
    return counts.select(F.col("id").alias(id_column), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


@query
def op11_token_counts(spark, sf_dir):
    return token_counts(table(spark, sf_dir, "documents"))

"""Exact token counts of texts of any length, by overlap resynchronisation.

A huge text is encoded in overlapping chunks. Two neighbours are spliced at a position
in their overlap where both have a token boundary and where the vocabulary proves that
no token can cross; without one, the overlap is widened, in the end to the whole rest.
"""

from __future__ import annotations

import functools
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tokenizers_by_path import sentencepiece_model

#: Code points of a chunk and of the overlap tried first.
CHUNK, OVERLAP = 32_768, 512
_SPACE = "▁"


@functools.cache
def crossing_free(path: str) -> bool:
    """Whether no piece of the vocabulary holds a space after another character.

    Then merges never join a character with the space that follows it, and the pieces
    before and after such a place don't depend on each other.
    """
    model = sentencepiece_model(path)
    pieces = (model.id_to_piece(i) for i in range(model.get_piece_size()))
    keeps_spaces = model.encode("a  a", out_type=str) == model.encode("a", out_type=str) + [
        _SPACE
    ] + model.encode("a", out_type=str)
    return keeps_spaces and not any(
        second == _SPACE and first != _SPACE for piece in pieces for first, second in zip(piece, piece[1:])
    )


def _starts(model, text: str, begin: int) -> list[int]:
    """Where in the whole text each token of a chunk begins, in code points."""
    return [begin + token[0] for token in model.encode(text, return_type="offset_mapping")["offsets"]]


class _Stable:
    """Places of a text that no token crosses, whatever surrounds them: proven from the vocabulary.

    Pieces grow by joining neighbours into longer pieces of the vocabulary. Where no piece has
    the two characters around a place side by side, none ever lies across it. Both must come
    through the model's normalisation as they are, so that they meet as in the vocabulary.
    """

    def __init__(self, model):
        self._model = model
        self._sides = {p[i : i + 2] for p in map(model.id_to_piece, range(model.get_piece_size())) for i in range(len(p) - 1)}
        # Without pieces for bytes, unknown characters side by side become one token.
        self._bytes = any(model.is_byte(i) for i in range(model.get_piece_size()))
        self._known: dict[str, bool] = {}

    def __call__(self, text: str, place: int) -> bool:
        pair = text[place - 1 : place + 1]
        if pair[1] == " ":
            return pair[0] != " "
        if pair[0] == " " or not self._bytes:
            return False
        found = self._known.get(pair)
        if found is None:
            if len(self._known) > 100_000:
                self._known.clear()
            same = self._model.normalize(pair).lstrip(_SPACE) == pair
            found = self._known[pair] = same and pair not in self._sides
        return found

    def after(self, text: str, place: int) -> int:
        """The first such place from here on, or the end."""
        return next((p for p in range(place, len(text)) if self(text, p)), len(text))


@functools.cache
def _stable_places(path: str) -> _Stable:
    return _Stable(sentencepiece_model(path))


def _chunk(model, text: str, begin: int, end: int) -> list[int]:
    """Token starts of ``text[begin:end]``.

    The encoder puts a space before what it gets. A chunk that begins with a space goes
    without it; one that does not, gets wrong tokens up to its first stable place only.
    """
    if begin and text[begin] == " ":
        inside = _starts(model, text[begin + 1 : end], begin + 1)
        return [begin, *inside[1:]] if inside else [begin]
    return _starts(model, text[begin:end], begin)


def count_long(model, text: str, chunk: int = CHUNK, overlap: int = OVERLAP, stable=None) -> int:
    """Tokens of one text, encoding about a chunk at a time where it can be spliced.

    Neighbours whose overlap has no stable place in common get one that reaches beyond the
    next such place of the text, however far that is; a chunk is encoded again at most once
    for that, so the work grows with the length of the text.
    """
    stable = stable or _Stable(model)
    total, begin, kept_from = 0, 0, 0
    end = min(chunk, len(text))
    starts = _chunk(model, text, begin, end)
    while end < len(text):
        following = max(end - overlap, begin + 1)
        limit = min(following + max(chunk, 2 * overlap), len(text))
        ahead = _chunk(model, text, following, limit)
        lap = set(starts[bisect_right(starts, max(kept_from, following)) : bisect_left(starts, end)])
        shared = (p for p in reversed(ahead[: bisect_left(ahead, end)]) if p in lap)
        splice = next((p for p in shared if stable(text, p)), None)
        if splice is None:
            place = stable.after(text, max(end, begin + overlap + 1))
            end = min(place + overlap // 2 + 1, len(text)) if place < len(text) else len(text)
            starts = _chunk(model, text, begin, end)
            continue
        total += bisect_left(starts, splice) - bisect_left(starts, kept_from)
        begin, kept_from, end, starts = following, splice, limit, ahead
    return total + len(starts) - bisect_left(starts, kept_from)


def counter(path: str, chunk: int = CHUNK, overlap: int = OVERLAP):
    """A Pandas UDF: text to number of tokens, NULL as the empty text."""

    @F.pandas_udf("long")
    def n_tokens(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = sentencepiece_model(path)
        splice = crossing_free(path)
        for texts in batches:
            texts = texts.fillna("")
            counts = pd.Series(0, index=texts.index, dtype="int64")
            long = (texts.str.len() > chunk) if splice else texts.isna()
            short = texts[~long]
            for at in range(0, len(short), 64):
                part = short.iloc[at : at + 64]
                counts[part.index] = [len(ids) for ids in model.encode(part.tolist(), num_threads=1)]
            for row, text in texts[long].items():
                counts[row] = count_long(model, text, chunk, overlap, _stable_places(path))
            yield counts

    return n_tokens.asNondeterministic()  # else a filter on the count counts twice


def with_token_counts(
    docs: DataFrame, path: str, text: str = "text", *, chunk: int = CHUNK, overlap: int = OVERLAP
) -> DataFrame:
    """All rows and columns of ``docs`` and ``n_tokens`` (replaced if it exists).

    NULL counts as the empty text (0 tokens); repeated rows are counted each; an empty
    table gives an empty one. Special strings inside a text are ordinary text.
    """
    return docs.withColumn("n_tokens", counter(path, chunk, overlap)(F.col(text)))


def over(limit: int) -> Column:
    return F.col("n_tokens") > limit

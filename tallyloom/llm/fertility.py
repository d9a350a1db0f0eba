"""Quality rules on how well public vocabularies split a text."""

from __future__ import annotations

import functools
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tallyloom.llm.tokens import encoder, vocabulary_path
from tallyloom.llm.words import (
    blocks,
    prefix_sums,
    range_hash,
    window_hashes,
    word_bounds,
)

MIN_WORDS = 20
REPEAT_WINDOW = 8
MAX_REPEAT_PERCENT = 30
SYMBOLS = b"#*$%&|<>"
ENTROPY_IDS = 512
LOT_CHARS = 8 << 20  # whose distinct parts are held at a time, one text at least
LOT_PARTS = 4096  # encoded in one call

#: Fixed values: (least, most) characters per token, most share of byte fallback, and
#: (least, most) entropy of the tokens as a share of its largest value, by language;
#: a script where the language is unknown; "" where both are.
BANDS: dict[str, tuple[float, float, float, float, float]] = {
    "en": (2.25, 8.0, 0.10, 0.60, 1.0),
    "de": (2.10, 8.0, 0.10, 0.60, 1.0),
    "fr": (1.90, 8.0, 0.10, 0.60, 1.0),
    "es": (1.85, 8.0, 0.10, 0.60, 1.0),
    "latin": (1.70, 8.0, 0.15, 0.45, 1.0),
    "greek": (0.4, 6.0, 0.30, 0.40, 1.0),
    "cyrillic": (0.4, 6.0, 0.10, 0.40, 1.0),
    "cjk": (0.2, 4.0, 0.60, 0.40, 1.0),
    "": (0.2, 8.0, 0.80, 0.40, 1.0),
}
#: First and end code point of the letters that tell a script.
SCRIPTS = {
    "latin": ((0x41, 0x5B), (0x61, 0x7B), (0xC0, 0x250)),
    "greek": ((0x370, 0x400),),
    "cyrillic": ((0x400, 0x530),),
    "cjk": ((0x3040, 0x3100), (0x3400, 0xA000), (0xAC00, 0xD7B0)),
}


def script(text: str) -> str:
    """The script of most letters of a text; "" if none is known."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    found = {
        name: sum(int(((points >= a) & (points < b)).sum()) for a, b in ranges)
        for name, ranges in SCRIPTS.items()
    }
    best = max(found, key=lambda name: found[name])
    return best if found[best] else ""


class PieceCounts:
    """Tokens and byte tokens of texts in the vocabulary of pieces with byte fallback.

    No piece reaches over a single blank between two other characters, so texts are split
    there, and each distinct part of a lot of :data:`LOT_CHARS` characters is encoded once.
    Texts with blanks in a row or at an end, and all texts where the vocabulary has a piece
    with a blank inside, are encoded whole.
    """

    def __init__(self, path: str | None = None):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(
            model_file=path or vocabulary_path("piece_bpe_32k.model")
        )
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.splits = not any("▁" in piece.lstrip("▁") for piece in pieces)
        # A blank is written as a sign that is a piece.
        self.known = frozenset([" ", *(piece for piece in pieces if len(piece) == 1)])

    def _parts(self, text: str) -> list[str]:
        whole = not self.splits or "  " in text or "▁" in text or text[:1] == " " or text[-1:] == " "
        return [text] if whole else text.split(" ")

    def tokens(self, texts: Sequence[str]) -> np.ndarray:
        """The number of tokens of each text."""
        totals, start = np.zeros(len(texts), np.int64), 0
        while start < len(texts):
            numbers: dict[str, int] = {}
            own: list[list[int]] = []
            left = LOT_CHARS
            for text in texts[start:]:
                own.append([numbers.setdefault(p, len(numbers)) for p in self._parts(text)])
                left -= len(text)
                if left < 0:
                    break
            parts = list(numbers)
            lengths = np.zeros(len(parts), np.int64)
            for k in range(0, len(parts), LOT_PARTS):
                found = self.model.encode(parts[k : k + LOT_PARTS], num_threads=1)
                lengths[k : k + LOT_PARTS] = [len(ids) for ids in found]
            totals[start : start + len(own)] = [lengths[p].sum() for p in own]
            start += len(own)
        return totals

    def raw(self, text: str) -> int:
        """Byte tokens: a character that is no piece is a token for each of its bytes."""
        return sum(text.count(c) * len(c.encode()) for c in set(text) - self.known)

    def of(self, text: str) -> tuple[int, int]:
        """(tokens, byte tokens) of one text."""
        return int(self.tokens([text])[0]), self.raw(text)


@functools.lru_cache(maxsize=2)
def piece_counts(path: str | None) -> PieceCounts:
    """One for each Python worker."""
    return PieceCounts(path)


def entropy_share(ids: np.ndarray) -> float:
    """The entropy of the ids over its largest value for so many; 1 for fewer than two.

    From :data:`ENTROPY_IDS` on the largest value stays, since the ids that a long
    text uses grow slowly.
    """
    if len(ids) < 2:
        return 1.0
    counts = np.unique(ids, return_counts=True)[1]
    shares = counts / len(ids)
    return float(-(shares * np.log2(shares)).sum() / np.log2(min(len(ids), ENTROPY_IDS)))


def _base(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and characters of each row."""

    def per_row(mask: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(mask)])
        return sums[offsets[1:]] - sums[offsets[:-1]]

    starts, ends, first = word_bounds(data, offsets)
    sums = prefix_sums(data)
    windows = window_hashes(range_hash(sums, starts, ends), REPEAT_WINDOW)
    heads = (data & 0xC0) != 0x80
    chars = per_row(heads)
    inside = np.zeros(len(data) + 1, np.int8)
    inside[starts] += 1
    np.subtract.at(inside, ends, 1)
    word_chars = per_row(heads & (np.cumsum(inside[:-1]) > 0))
    repeats, lines = np.zeros(len(first) - 1, np.int64), np.zeros(len(first) - 1, np.int64)
    for r in range(len(first) - 1):
        a, b = int(first[r]), int(first[r + 1])
        if b - a > REPEAT_WINDOW:
            own = windows[a : b - REPEAT_WINDOW + 1]
            order = np.argsort(own, kind="stable")
            same = own[order[1:]] == own[order[:-1]]
            if same.any():
                hit = np.unique(np.concatenate([order[1:][same], order[:-1][same]]))
                cover = np.zeros(b - a + 1, np.int64)
                cover[hit] += 1
                cover[hit + REPEAT_WINDOW] -= 1
                repeats[r] = (np.cumsum(cover[:-1]) > 0).sum()
        if b > a:
            split = data[offsets[r] : offsets[r + 1]].tobytes().split(b"\n")
            worded = [line for line in split if line and not line.isspace()]
            lines[r] = len(worded) - len(set(worded))
    symbols = per_row(np.isin(data, np.frombuffer(SYMBOLS, np.uint8)))
    return [np.diff(first), word_chars, symbols, lines, repeats, chars]


SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
    "n_repeat_words long, base_failed boolean, kept boolean, chars_per_token double, "
    "fallback_share double, entropy_share double, band string"
)


def fertility_rules(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str | None = "lang",
    bands: dict[str, tuple[float, float, float, float, float]] | None = None,
    tokenizer: tuple[str | None, str | None] = (None, None),
    fallback_model: str | None = None,
) -> DataFrame:
    """One row per document with its counts, the vocabularies' measures and the verdict.

    Characters per token and the entropy of the tokens come from a byte-level
    vocabulary. The share of byte fallback is that of the tokens of a vocabulary of pieces
    that stand for a single byte, line feeds among them. A document that passes
    the word and repetition rules is kept if all three lie in the band of its
    language; where the language is NULL or has no band, in that of its script.

    A NULL or empty text has zero counts and fails the base rules; its measures are
    0, 0 and 1. Repeated rows give repeated results, an empty table gives none, other
    columns are not read. Words are the runs of ``[^\\x20\\x09-\\x0D]``; repeated
    windows are found by 64-bit hashes within the text.
    """
    chosen = BANDS if bands is None else bands

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, split = encoder(*tokenizer), piece_counts(fallback_model)
        names = [part.split()[0] for part in SCHEMA.split(", ")]
        for batch in batches:
            counts = [[], [], [], [], [], []]
            for _, data, offsets in blocks(batch.column(1)):
                for column, values in zip(counts, _base(data, offsets), strict=True):
                    column.append(values)
            counts = [np.concatenate(c) if c else np.zeros(0, np.int64) for c in counts]
            n_words, _, _, _, repeats, chars = counts
            failed = (n_words < MIN_WORDS) | (100 * repeats > MAX_REPEAT_PERCENT * n_words)
            measures, kept, used = [], [], []
            langs = batch.column(2).to_pylist() if lang_col else [None] * len(chars)
            texts = [text or "" for text in batch.column(1).to_pylist()]
            pieces = split.tokens(texts)
            for r, text in enumerate(texts):
                ids = np.array(encode(text), np.int64)
                tokens, raw = int(pieces[r]), split.raw(text)
                per_token = float(chars[r]) / max(1, len(ids))
                fallback, entropy = raw / max(1, tokens), entropy_share(ids)
                band = langs[r] if langs[r] in chosen else script(text)
                low, high, most, least, top = chosen.get(band, chosen[""])
                fits = low <= per_token <= high and fallback <= most and least <= entropy <= top
                measures.append((per_token, fallback, entropy))
                kept.append(bool(fits and not failed[r]))
                used.append(band)
            columns = list(zip(*measures, strict=True)) or [[]] * 3
            arrays = [batch.column(0)]
            arrays += [pa.array(c.astype(np.int64)) for c in counts[:5]]
            arrays += [pa.array(failed), pa.array(kept, pa.bool_())]
            arrays += [pa.array(c, pa.float64()) for c in columns]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(used, pa.string())], names)

    columns = [docs[id_col].cast("long"), docs[text_col]]
    return docs.select(*columns, *([lang_col] if lang_col else [])).mapInArrow(rows, SCHEMA)

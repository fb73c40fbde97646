"""Quality rules: counts over words and lines, and compression bands.

A text whose zstandard ratio lies outside the band of its length is rejected: above the
band it repeats itself, below it is noise.  The same bands judge fixed chunks, so that a
bad stretch inside a long text counts too; a text is rejected when the bad chunks hold
more than ``BAD_SHARE`` of its bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from .textkit import blocks

LEVEL = 3
CHUNK = 4096
BAD_SHARE = 0.3
#: (bytes from, least ratio, greatest ratio); shorter texts than the first entry are not judged.
BANDS = ((128, 0.90, 3.0), (256, 1.10, 3.0), (512, 1.25, 3.2), (1024, 1.40, 3.5), (4096, 1.50, 4.0), (16384, 1.60, 5.0))
SYMBOLS = b"#*$%&|<>"
WHITE = b" \t\n\x0b\x0c\r"


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a 3-word window found twice or more, the first find included."""
    if len(words) < 4:
        return 0
    known: dict[bytes, int] = {}
    ids = np.array([known.setdefault(w, len(known)) for w in words], dtype=np.int64)
    _, pair = np.unique(ids[:-1] * len(known) + ids[1:], return_inverse=True)
    _, window, count = np.unique(pair[:-1] * len(known) + ids[2:], return_inverse=True, return_counts=True)
    again = count[window] > 1
    inside = np.zeros(len(words), dtype=bool)
    for shift in range(3):
        inside[shift:len(again) + shift] |= again
    return int(inside.sum())


def base_counts(text: bytes) -> tuple[int, int, int, int, int, bool]:
    words = text.split()
    n = len(words)
    chars = len(text.translate(None, WHITE + bytes(range(0x80, 0xC0))))
    symbols = len(text) - len(text.translate(None, SYMBOLS))
    lines = [line for line in text.split(b"\n") if line.strip()]
    repeated = repeated_words(words)
    return n, chars, symbols, len(lines) - len(set(lines)), repeated, n < 50 or 100 * repeated > 50 * n


def in_band(size: int, ratio: float) -> bool:
    fits = True
    for least, low, high in BANDS:
        if size >= least:
            fits = low <= ratio <= high
    return fits


def compression(text: bytes, press: zstandard.ZstdCompressor) -> tuple[float, float]:
    """Ratio of the whole text, and the share of its bytes in chunks outside their band."""
    if not text:
        return 0.0, 0.0
    whole = len(text) / len(press.compress(text))
    if len(text) <= CHUNK:
        return whole, 0.0
    bad = 0
    for at in range(0, len(text), CHUNK):
        chunk = text[at:at + CHUNK]
        if not in_band(len(chunk), len(chunk) / len(press.compress(chunk))):
            bad += len(chunk)
    return whole, bad / len(text)


def judge(docs: DataFrame, extra: list[str] | None = None) -> DataFrame:
    """Counts and verdict for every whole text, one row for each row of ``docs``.

    Returns ``doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept, ratio, bad_share``.  A NULL text has no words, like an empty one: both
    fail the base rule.  Repeated rows and missing ids are judged like any others.  Columns
    named in ``extra`` are passed through ahead of these under their own names.
    """
    extra = extra or []
    fields = {f.name: f for f in docs.schema.fields}
    schema = [f"`{c}` {fields[c].dataType.simpleString()}" for c in extra] + [
        "doc_id long", "n_words long", "word_chars long", "n_symbols long", "n_dup_lines long", "n_repeat_words long",
        "base_failed boolean", "kept boolean", "ratio double", "bad_share double"]
    names = [*extra, "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
             "ratio", "bad_share"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=LEVEL)
        for batch in batches:
            for block in blocks(batch.column(1)):
                out = []
                for i in range(len(block.start) - 1):
                    text = block.text(i)
                    counts = base_counts(text)
                    ratio, bad = compression(text, press)
                    kept = not counts[-1] and in_band(len(text), ratio) and bad <= BAD_SHARE
                    out.append((*counts, kept, ratio, bad))
                kinds = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.float64()] * 2
                made = [pa.array(column, kind) for column, kind in zip(zip(*out), kinds)]
                given = [batch.column(2 + i)[block.rows] for i in range(len(extra))]
                yield pa.RecordBatch.from_arrays([*given, batch.column(0)[block.rows], *made], names)

    given = [docs[c].alias(f"x{i}") for i, c in enumerate(extra)]
    return docs.select(docs["doc_id"], docs["text"], *given).mapInArrow(run, ", ".join(schema))

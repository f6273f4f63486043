"""Quality rules with compression bands: zstandard ratios of the whole text and of fixed chunks.

A ratio (bytes before / after) above the upper limit means repetition, below the lower one means that there is no language in it. Limits
depend on the length, since short texts compress little. One scan, no shuffle; counts and ratios come from whole texts.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from clusterloom.llm import textkit
from clusterloom.llm.common import pieces, small_batches, text_bytes

CHUNK = 4096
LEVEL = 3
RUN = 8
SYMBOLS = b"#*$%&|<>"


class Band(NamedTuple):
    """Allowed ratios of a text of at least ``size`` bytes."""

    size: int
    low: float
    high: float


#: Chosen outside the range of ordinary prose, with room on both sides.
BANDS = (Band(0, 0.0, 3.0), Band(256, 1.05, 3.0), Band(1024, 1.2, 3.2), Band(4096, 1.35, 3.6), Band(32768, 1.5, 4.2))
#: Allowed ratios of each full chunk, and the share of bad chunks that a text may have.
CHUNK_BAND = (1.2, 4.0)
BAD_CHUNKS = 0.5

_IS_SYMBOL = np.zeros(256, bool)
_IS_SYMBOL[list(SYMBOLS)] = True
_OF_WORD = np.array([b not in textkit.SPACE and b & 0xC0 != 0x80 for b in range(256)])


def _per_text(flags: np.ndarray, offset: np.ndarray) -> np.ndarray:
    sums = np.concatenate(([0], np.cumsum(flags)))
    return sums[offset[1:]] - sums[offset[:-1]]


def _repeat_words(w: textkit.Words) -> np.ndarray:
    """For each text the words that stand in a run of ``RUN`` words found twice or more in it."""
    texts, n = len(w.first) - 1, len(w.hash)
    doc = np.repeat(np.arange(texts), np.diff(w.first))
    g = textkit.windows(w.hash, RUN)
    if not len(g):
        return np.zeros(texts, np.int64)
    inside = np.flatnonzero(doc[: n - RUN + 1] == doc[RUN - 1 :])
    key = textkit.mix(g[inside] ^ textkit.mix(doc[inside].astype(np.uint64) + np.uint64(1)))
    _, where, count = np.unique(key, return_inverse=True, return_counts=True)
    first = inside[count[where] > 1]
    cover = np.zeros(n + 1, np.int64)
    np.add.at(cover, first, 1)
    np.add.at(cover, first + RUN, -1)
    return np.bincount(doc[np.cumsum(cover[:-1]) > 0], minlength=texts)


def _dup_lines(text: bytes) -> int:
    if b"\n" not in text:
        return 0
    lines = [x for x in text.split(b"\n") if x.strip(textkit.SPACE)]
    return len(lines) - len(set(lines))


def ratios(text: bytes, press) -> tuple[float, list[float]]:
    """(ratio of the whole text, ratios of its full chunks)."""
    if not text:
        return 0.0, []
    full = [len(text[k : k + CHUNK]) / len(press.compress(text[k : k + CHUNK])) for k in range(0, len(text) - CHUNK + 1, CHUNK)]
    return len(text) / len(press.compress(text)), full


def within(size: int, whole: float, chunks: list[float]) -> bool:
    band = [b for b in BANDS if b.size <= size][-1]
    bad = sum(not CHUNK_BAND[0] <= r <= CHUNK_BAND[1] for r in chunks)
    return band.low <= whole <= band.high and bad <= BAD_CHUNKS * len(chunks)


_COLUMNS = {"n_words": pa.int64(), "word_chars": pa.int64(), "n_symbols": pa.int64(), "n_dup_lines": pa.int64(), "n_repeat_words": pa.int64(), "base_failed": pa.bool_(), "kept": pa.bool_(), "ratio": pa.float64(), "least_chunk_ratio": pa.float64(), "most_chunk_ratio": pa.float64()}


def _scan(batches):
    press = zstandard.ZstdCompressor(level=LEVEL)
    for batch in batches:
        for first, texts in pieces(batch.column("text")):
            w = textkit.hash_words(texts, lower=False)
            arr = np.frombuffer(w.buffer, np.uint8)
            n = np.diff(w.first)
            repeat = _repeat_words(w)
            failed = (n < 20) | (100 * repeat > 30 * n)
            measured = [ratios(t, press) for t in texts]
            kept = [not f and within(len(t), *m) for f, t, m in zip(failed.tolist(), texts, measured)]
            values = [n, _per_text(_OF_WORD[arr], w.offset), _per_text(_IS_SYMBOL[arr], w.offset), [_dup_lines(t) for t in texts], repeat, failed, kept, [m[0] for m in measured], [min(m[1], default=None) for m in measured], [max(m[1], default=None) for m in measured]]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(first, len(texts)), *(pa.array(v, t) for v, t in zip(values, _COLUMNS.values()))], ["doc_id", *_COLUMNS])


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: word, symbol, line and repetition counts, base_failed, kept, and the ratios (chunk ratios null for texts
    below ``CHUNK`` bytes).

    Null and empty texts have no words and fail. Equal rows get equal results; other columns are ignored.
    """
    small_batches(docs.sparkSession)
    schema = "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, kept boolean, ratio double, least_chunk_ratio double, most_chunk_ratio double"
    return text_bytes(docs, id_col, text_col).mapInArrow(_scan, schema)

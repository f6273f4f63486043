"""Fill-in-middle transformation by repeated-capture matching.

One ``fullmatch`` of ``(unit)*`` with the regex library keeps every repetition of the group, so ``ends(1)`` gives the number of units and
the place of every possible cut at once; no text is split and no unit is looped over. The draws hash the document's id, so a
document is cut alike on every cluster and in every order.

Nulls and odd rows: a null text is empty; empty texts, and those that already contain a sentinel, stay plain. A null id draws as an empty
one, equal ids draw alike, rows are neither merged nor dropped, and columns other than id and text are ignored. Bytes that
are no UTF-8 count one code point each and come back unchanged.

Scale: one scan without a shuffle; a task holds one Arrow batch and the match of one text.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from clusterloom.llm.common import small_batches

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: A line with its line feed, or what follows the last one. Possessive: a text is walked once.
LINES = r"[^\n]*+\n|[^\n]++"


def draws(doc_id, seed: int) -> list[int]:
    """Four numbers below 2**32 for a document."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]


def _decoded(raw: bytes | None) -> str:
    return (raw or b"").decode("utf-8", "surrogateescape")


def _encoded(text: str) -> bytes:
    return text.encode("utf-8", "surrogateescape")


def cut(text: str, numbers: list[int], units, percent: int, spm_percent: int):
    """(n, form, prefix, middle, suffix) of one text; ``units`` is the compiled ``(unit)*``."""
    match = units.fullmatch(text)
    if match is None:
        raise ValueError("the unit pattern does not cover every text")
    ends = match.ends(1)
    n = len(ends)
    if not text or PREFIX in text or SUFFIX in text or MIDDLE in text or numbers[2] % 100 >= percent:
        return n, "plain", text, None, None
    at = [0, *ends]
    a, b = sorted((at[numbers[0] % (n + 1)], at[numbers[1] % (n + 1)]))
    return n, "spm" if numbers[3] % 100 < spm_percent else "psm", text[:a], text[a:b], text[b:]


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", unit: str = LINES, percent: int = 100, spm_percent: int = 50, seed: int = 7) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output): ``percent`` of the texts cut in three at unit borders.

    ``psm`` is ``<P>`` prefix ``<S>`` suffix ``<M>`` middle, ``spm`` (``spm_percent`` of the cut ones) is ``<S>`` suffix ``<P>`` prefix ``<M>``
    middle, ``plain`` the text itself. ``output`` is binary (UTF-8). ``unit`` must cover every text when repeated.
    """
    small_batches(docs.sparkSession)
    id_type = docs.schema[id_col].dataType.simpleString()

    def scan(batches):
        units = regex.compile(f"({unit})*+")
        for batch in batches:
            out = []
            for doc, raw in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                n, form, prefix, middle, suffix = cut(_decoded(raw.as_py()), draws(doc, seed), units, percent, spm_percent)
                whole = {"plain": [prefix], "psm": [PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle], "spm": [SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle]}[form]
                sizes = (None, None) if form == "plain" else (len(prefix), len(middle))
                out.append((n, form, *sizes, _encoded("".join(whole))))
            cols = list(zip(*out)) if out else [[]] * 5
            types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, t) for c, t in zip(cols, types))], ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    return texts.mapInArrow(scan, f"doc_id {id_type}, n bigint, form string, prefix_chars bigint, middle_chars bigint, output binary")


def rebuilt(output: str, form: str) -> str:
    """The text behind an output. Sentinels are found from the left: no part holds one, and none can arise where two parts meet."""
    if form == "plain":
        return output
    first, second = (PREFIX, SUFFIX) if form == "psm" else (SUFFIX, PREFIX)
    one, rest = output[len(first) :].split(second, 1)
    other, middle = rest.split(MIDDLE, 1)
    return one + middle + other if form == "psm" else other + middle + one


def restore(cuts: DataFrame) -> DataFrame:
    """``cuts`` (any columns; ``output`` binary and ``form`` string among them) with ``restored``, the text as binary."""
    small_batches(cuts.sparkSession)
    cuts = cuts.drop("restored")

    def scan(batches):
        for batch in batches:
            pairs = zip(batch.column("output"), batch.column("form").to_pylist())
            texts = [_encoded(rebuilt(_decoded(raw.as_py()), form)) for raw, form in pairs]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.binary())], [*batch.schema.names, "restored"])

    return cuts.mapInArrow(scan, StructType([*cuts.schema.fields, StructField("restored", BinaryType())]))


def report(docs: DataFrame) -> DataFrame:
    """The transformation and its way back, with digests in place of the texts."""
    both = restore(fill_in_middle(docs))
    return both.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"))

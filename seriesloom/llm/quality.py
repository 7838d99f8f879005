"""Quality rules by repetition coverage.

A numpy pass over each text rolls hashes of several n-gram lengths and measures which share of the word
characters lies inside n-grams that repeat an earlier one, and which share of the lines and of their characters
repeats an earlier line. Thresholds are those published for the Gopher corpus; the share of lines is judged from the
second repeated line on, since one line of three or four says little.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesloom.llm.common import Aside, WordHashes, covered, repeated, repeats, rolled, slices

#: n-gram length -> largest share of word characters inside n-grams of that length that repeat.
MAX_COVERAGE = {5: 0.15, 6: 0.14, 7: 0.13, 8: 0.12, 9: 0.11, 10: 0.10}
MAX_LINE_SHARE = 0.30
MAX_LINE_CHARS = 0.20
MIN_DUP_LINES = 2
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SYMBOLS = b"#*$%&|<>"

LONGS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
SHARES = ("dup_line_share", "dup_line_chars", *(f"dup_{n}gram_chars" for n in MAX_COVERAGE))
SIGNALS = (*LONGS, *SHARES, "base_failed", "kept")


def _code_points(data: bytes) -> int:
    return int(np.count_nonzero((np.frombuffer(data, np.uint8) & 0xC0) != 0x80))


def measure(data: bytes, hashes: WordHashes) -> tuple:
    """The signals of one UTF-8 text, in the order of ``SIGNALS``."""
    words = data.split()
    n = len(words)
    chars = _code_points(b"".join(words))
    symbols = len(data) - len(data.translate(None, SYMBOLS))
    lines = [x for x in data.split(b"\n") if x.strip()]
    seen: set[bytes] = set()
    dup_lines = dup_bytes = 0
    for x in lines:
        if x in seen:
            dup_lines += 1
            dup_bytes += len(x)
        seen.add(x)
    ids = hashes.of(words)
    in_repeats = int(covered(repeated(rolled(ids, 3)), 3, n).sum()) if n >= 3 else 0
    base_failed = n < MIN_WORDS or 100 * in_repeats > MAX_REPEAT_PERCENT * n
    coverage = dict.fromkeys(MAX_COVERAGE, 0.0)
    if in_repeats:
        widths = None
        for length in coverage:
            again = repeats(rolled(ids, length))
            if not again.any():
                break  # longer n-grams cannot repeat either
            if widths is None:
                widths = np.fromiter(map(_code_points, words), np.int64, n)
            coverage[length] = float(widths[covered(again, length, n)].sum() / chars)
    share = dup_lines / len(lines) if lines else 0.0
    line_chars = dup_bytes / sum(map(len, lines)) if lines else 0.0
    good = (
        (share <= MAX_LINE_SHARE or dup_lines < MIN_DUP_LINES)
        and line_chars <= MAX_LINE_CHARS
        and all(coverage[k] <= most for k, most in MAX_COVERAGE.items())
    )
    return n, chars, symbols, dup_lines, in_repeats, share, line_chars, *coverage.values(), base_failed, good and not base_failed


def with_signals(docs: DataFrame, text: str = "text", keep: Sequence[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``keep``) with the columns ``SIGNALS``, one output row per input row.

    Null texts count as empty: no words, so ``base_failed``. Columns that already bear a signal's name are replaced;
    all others pass through untouched. Ties cannot arise: every row is judged by itself, repeated rows alike. Texts
    may be of any length; an empty table gives an empty one.
    """
    aside = Aside(docs)
    docs, text, keep = aside.docs, aside[text], aside.kept(SIGNALS, keep)
    schema = docs.select(*keep).schema
    for name in LONGS:
        schema = schema.add(name, "long")
    for name in SHARES:
        schema = schema.add(name, "double")
    schema = schema.add("base_failed", "boolean").add("kept", "boolean")
    kinds = [pa.int64()] * len(LONGS) + [pa.float64()] * len(SHARES) + [pa.bool_()] * 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in slices(batches, "_data"):
            at = batch.schema.get_field_index("_data")
            rows = [measure(x or b"", hashes) for x in batch.column(at).to_pylist()]
            columns = [batch.column(i) for i in range(batch.num_columns) if i != at]
            found = [pa.array(values, kind) for values, kind in zip(zip(*rows, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([*columns, *found], [*keep, *SIGNALS])

    return aside.back(docs.select(*keep, F.col(text).cast("binary").alias("_data")).mapInArrow(run, schema), SIGNALS)


def passing(docs: DataFrame, text: str = "text") -> DataFrame:
    """Rows of ``docs`` that the rules keep, with the columns they came with.

    A column of ``docs`` that bears a signal's name is not judged or lost: it is set aside under another name.
    """
    aside = Aside(docs)
    return aside.back(with_signals(aside.docs, aside[text]).where("kept"))

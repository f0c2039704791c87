"""Documents rearranged for training a model to fill in the middle of a text.

A text is cut at two of its code-point boundaries into prefix, middle and suffix, and written anew
with a marker before each part: prefix, suffix, middle (form ``psm``) or suffix, prefix, middle
(``spm``). A share of the documents stays as it is (``plain``), and so do empty texts and those that
hold a marker. All draws come from a checksum of seed and doc_id, so reruns and lost tasks agree.

The cuts are numbers of code points, the text is bytes: a set of the byte offsets at which code points
begin (see ``boundaries``) gives both offsets, and the parts are slices of bytes.

Nulls, ties and odd input: a null text counts as empty, a null doc_id as an empty one; equal cuts give
an empty middle; rows with the same doc_id are cut by the same draws; an empty table gives an empty
result; other columns are not carried. Texts are handled whole, a bounded number of bytes at a time
(a longer text by itself).
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .arrowmap import map_arrow
from .boundaries import BoundarySet
from .textarrays import byte_chunks

#: Before the prefix, the suffix and the middle.
MARKERS = ("<P>", "<S>", "<M>")


def _check_markers(markers: tuple[str, str, str]) -> None:
    """Markers must not run into each other, or outputs could be read in two ways."""
    for i, a in enumerate(markers):
        for j, b in enumerate(markers):
            overlap = any(a.endswith(b[:n]) for n in range(1, min(len(a), len(b) + (i != j))))
            if not a or overlap or (i != j and a in b):
                raise ValueError(f"markers {markers} can overlap")


def _draws(seed: int) -> list[Column]:
    """Four whole numbers below 2^32 for each document."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    digest = F.sha2(text, 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("bigint") for i in range(4)]


def _cut(data: bytes, first: int, second: int, form: str, marks: list[bytes]) -> tuple[int, int, int, int, int, bytes]:
    """Code points, the two cuts in code points and in bytes, and the text in its new order."""
    points = BoundarySet.of_text(np.frombuffer(data, np.uint8))
    n = len(points) - 1
    low, high = sorted((first % (n + 1), second % (n + 1)))
    a, b = points.select(low), points.select(high)
    prefix, middle, suffix = marks[0] + data[:a], marks[2] + data[a:b], marks[1] + data[b:]
    out = {"plain": [data], "psm": [prefix, suffix, middle], "spm": [suffix, prefix, middle]}[form]
    return n, low, high, a, b, b"".join(out)


def fill_in_middle(
    docs: DataFrame,
    seed: int = 1,
    changed_percent: int = 90,
    spm_percent: int = 20,
    markers: tuple[str, str, str] = MARKERS,
) -> DataFrame:
    """Per document row: doc_id, n, form, prefix_chars, middle_chars, prefix_bytes, middle_bytes, output.

    ``n`` and the ``_chars`` count code points; lengths are null in the form ``plain``.
    """
    _check_markers(markers)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    h1, h2, h3, h4 = _draws(seed)
    held = F.lit(False)
    for marker in markers:
        held = held | F.contains(text, F.lit(marker))
    plain = (text == "") | held | (h3 % 100 >= changed_percent)
    form = F.when(plain, "plain").when(h4 % 100 < spm_percent, "spm").otherwise("psm")
    rows = docs.select("doc_id", text.alias("text"), h1.alias("first"), h2.alias("second"), form.alias("form"))
    marks = [m.encode() for m in markers]
    names = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "prefix_bytes", "middle_bytes", "output"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, data, offsets in byte_chunks(batch.column(1)):
                ids, _, first, second, forms = batch.slice(at, len(offsets) - 1).columns
                edges = zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)
                texts = [data[lo:hi].tobytes() for lo, hi in edges]
                draws = zip(texts, first.to_pylist(), second.to_pylist(), forms.to_pylist(), strict=True)
                n, low, high, a, b, out = zip(*(_cut(*d, marks) for d in draws), strict=True)
                plain = np.array([f == "plain" for f in forms.to_pylist()])
                low, high, a, b = (np.array(x, np.int64) for x in (low, high, a, b))
                lengths = [pa.array(x, mask=plain) for x in (low, high - low, a, b - a)]
                output = pa.array(out, pa.binary()).view(pa.string())
                yield pa.RecordBatch.from_arrays([ids, pa.array(n, pa.int64()), forms, *lengths, output], names)

    doc_id = docs.schema["doc_id"].dataType.simpleString()
    numbers = ", ".join(f"{c} long" for c in names[3:7])
    return map_arrow(rows, run, f"doc_id {doc_id}, n long, form string, {numbers}, output string")


def restore(output: Column, form: Column, markers: tuple[str, str, str] = MARKERS) -> Column:
    """The text that ``output`` was made from, read from its markers."""
    parts = F.split(output, "|".join(re.escape(m) for m in markers))
    part = [F.element_at(parts, i) for i in range(1, 5)]
    return (
        F.when(form == "plain", output)
        .when(form == "psm", F.concat(part[1], part[3], part[2]))
        .otherwise(F.concat(part[2], part[3], part[1]))
    )

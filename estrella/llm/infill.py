"""Fill-in-middle transformation on an indexable skip list.

A text is a sequence of units (code points, words or lines). The bottom lane of the list
has a link for each unit; every higher lane skips a random number of links of the lane
below. A link carries how many units and how many code points it passes, so descending
from the top lane while the passed units do not exceed a rank reaches that rank exactly
and knows its code-point position. Both cuts of a text are found in this way.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from estrella.llm.common import map_batches

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
MARKS = (PREFIX, SUFFIX, MIDDLE)
SKIP = 8  # links of a lane that one link of the lane above passes, on average
_gaps = np.random.Generator(np.random.PCG64(31)).geometric(1.0 / SKIP, 1 << 14)


def char_widths(text: str) -> np.ndarray:
    """Code points of each unit where a unit is one code point."""
    return np.ones(len(text), np.uint8)


def _pattern_widths(pattern: str) -> Callable[[str], np.ndarray]:
    found = re.compile(pattern, re.DOTALL)
    return lambda text: np.fromiter((m.end() - m.start() for m in found.finditer(text)), np.int64)


# A word has the white space before it; white space at the end is a unit of its own.
UNITS: dict[str, Callable[[str], np.ndarray]] = {
    "char": char_widths,
    "word": _pattern_widths(r"\s*\S+|\s+"),
    "line": _pattern_widths(r"[^\n]*\n|[^\n]+"),
}


class SkipList:
    """Lanes over units of given code-point widths; lane 0 has a link for each unit."""

    def __init__(self, widths: np.ndarray):
        self.units = len(widths)
        # of each lane: unit width and code-point width of its links, first link below each
        self.lanes: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        passed, points = np.ones(len(widths), np.uint8), widths
        below = np.zeros(0, np.int64)
        self.lanes.append((passed, points, below))
        while len(points) > SKIP:
            turn = 997 * len(self.lanes)
            size = 2 * len(points) // SKIP + SKIP
            gaps = np.resize(np.roll(_gaps, turn), size)
            while gaps.sum() < len(points):
                gaps = np.concatenate([gaps, gaps])
            below = np.concatenate([[0], np.cumsum(gaps)])
            below = below[: np.searchsorted(below, len(points))]
            passed = np.add.reduceat(passed, below, dtype=np.int64)
            points = np.add.reduceat(points, below, dtype=np.int64)
            self.lanes.append((passed, points, below))

    def seek(self, rank: int) -> int:
        """Code points before the unit of a rank (0 to the number of units)."""
        units = points = at = 0
        for depth in range(len(self.lanes) - 1, -1, -1):
            passes, widths, below = self.lanes[depth]
            while at < len(passes) and units + int(passes[at]) <= rank:
                units += int(passes[at])
                points += int(widths[at])
                at += 1
            if depth:
                at = int(below[at]) if at < len(below) else len(self.lanes[depth - 1][0])
        return points


def draws(seed: int, doc_id: int | None) -> list[int]:
    """Four 32-bit numbers of a document: groups of the sha256 of ``seed:doc_id``."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return [int.from_bytes(digest[4 * i : 4 * i + 4], "big") for i in range(4)]


def rearrange(
    text: str, doc_id: int | None, unit: str = "char", seed: int = 1, plain_percent: int = 10, spm_percent: int = 20
) -> tuple[int, str, int | None, int | None, str]:
    """(units, form, code points of prefix and of middle, output) of one text."""
    widths = UNITS[unit](text)
    n = len(widths)
    h = draws(seed, doc_id)
    if not text or any(m in text for m in MARKS) or h[2] % 100 >= 100 - plain_percent:
        return n, "plain", None, None, text
    lanes = SkipList(widths)
    first, second = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    a, b = lanes.seek(first), lanes.seek(second)
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h[3] % 100 < spm_percent:
        return n, "spm", a, b - a, SUFFIX + suffix + PREFIX + prefix + MIDDLE + middle
    return n, "psm", a, b - a, PREFIX + prefix + SUFFIX + suffix + MIDDLE + middle


def fill_in_middle(
    docs: DataFrame, unit: str = "char", seed: int = 1, plain_percent: int = 10, spm_percent: int = 20
) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars and output of every ``docs(doc_id, text)``.

    The text is cut before two drawn ranks of its ``n`` units (``char``, ``word`` or
    ``line``) into prefix, middle and suffix. ``plain`` texts (empty, holding a mark, or
    drawn) are their own output and have null lengths; ``psm`` is prefix, suffix, middle
    and ``spm`` suffix, prefix, middle, each after its mark. The draws depend on seed and
    doc_id alone. A null text is an empty one; a null doc_id draws as an empty id; repeated
    rows give repeated rows; no rows give no rows; other columns are not read.
    """
    if unit not in UNITS:
        raise ValueError(f"unit must be one of {sorted(UNITS)}")

    def run(batches):
        for batch in batches:
            rows = [
                rearrange(text or "", doc, unit, seed, plain_percent, spm_percent)
                for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            ]
            n, form, prefix, middle, output = zip(*rows) if rows else ((),) * 5
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(n, pa.int64()),
                    pa.array(form, pa.string()),
                    pa.array(prefix, pa.int64()),
                    pa.array(middle, pa.int64()),
                    pa.array(output, pa.string()),
                ],
                ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
            )

    schema = "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").transform(map_batches, run, schema)


def restored(output: str = "output", form: str = "form") -> Column:
    """The exact text, from an output and its form.

    A text that holds a mark is plain, and no mark can arise across a border of two parts
    (marks begin with ``<`` and have none elsewhere), so an output splits in one way.
    """
    part = F.split(F.col(output), "|".join(MARKS))
    piece = lambda i: F.element_at(part, i)
    return (
        F.when(F.col(form) == "psm", F.concat(piece(2), piece(4), piece(3)))
        .when(F.col(form) == "spm", F.concat(piece(3), piece(4), piece(2)))
        .otherwise(F.col(output))
    )


def digests(arranged: DataFrame) -> DataFrame:
    """``fill_in_middle``'s rows with output_sha256 and restored_sha256 in place of the output."""
    return arranged.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(), 256).alias("restored_sha256"),
    )


# The same rule in DuckDB SQL, cutting by substring.
SQL = """
with t as (
  select doc_id, coalesce(text, '') x, length(coalesce(text, '')) n,
    sha256('1:' || coalesce(doc_id::varchar, '')) h from documents),
d as (
  select doc_id, x, n, ('0x' || substr(h, 1, 8))::bigint % (n + 1) a, ('0x' || substr(h, 9, 8))::bigint % (n + 1) b,
    ('0x' || substr(h, 17, 8))::bigint % 100 p, ('0x' || substr(h, 25, 8))::bigint % 100 q from t),
f as (
  select doc_id, x, n, least(a, b) c1, greatest(a, b) c2,
    case when x = '' or contains(x, '<P>') or contains(x, '<S>') or contains(x, '<M>') or p >= 90 then 'plain'
         when q < 20 then 'spm' else 'psm' end form from d),
g as (
  select *, substr(x, 1, c1) pre, substr(x, c1 + 1, c2 - c1) mid, substr(x, c2 + 1) suf from f)
select doc_id, n::bigint n, form,
  case when form <> 'plain' then c1 end::bigint prefix_chars, case when form <> 'plain' then c2 - c1 end::bigint middle_chars,
  sha256(case form when 'plain' then x when 'psm' then '<P>' || pre || '<S>' || suf || '<M>' || mid
    else '<S>' || suf || '<P>' || pre || '<M>' || mid end) output_sha256,
  sha256(x) restored_sha256
from g
"""

"""Fill-in-the-middle transformation over a sparse index of multibyte characters.

Texts stay UTF-8 bytes. Of a batch only the characters of more than one byte
are recorded, by their position and the bytes they have beyond the first. A
place in code points and the same place in bytes differ by the excess bytes
before it, which a binary search in that list finds; between two recorded
characters, and so in all ASCII text, the difference is constant.

Whether and how a document is cut depends on its id alone, so reruns and
other partitionings agree.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerostat.llm.common import WHITE, sliced, small_batches, utf8, word_spans

SENTINELS = ("<P>", "<S>", "<M>")  # before prefix, suffix and middle
PLAIN, PSM, SPM = "plain", "psm", "spm"


class ExceptionIndex:
    """Positions and excess bytes of the multibyte characters of a UTF-8 buffer, and nothing of the others."""

    def __init__(self, data: np.ndarray):
        self.at = np.flatnonzero(data >= 0xC0)  # lead bytes
        lead = data[self.at]
        excess = 1 + (lead >= 0xE0).astype(np.int64) + (lead >= 0xF0)
        self.before = np.concatenate([[0], np.cumsum(excess)])  # excess bytes of the first k exceptions
        self.point = self.at - self.before[:-1]  # the exceptions' places in code points

    def to_points(self, at: np.ndarray) -> np.ndarray:
        """Code points before each byte position; the positions are borders of characters."""
        return at - self.before[np.searchsorted(self.at, at)]

    def to_bytes(self, point: np.ndarray) -> np.ndarray:
        """Byte position after so many code points."""
        return point + self.before[np.searchsorted(self.point, point)]


class _Tokens:
    """Cuts between tokens: a token is a word with the white space before it, or the white space at the end."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, index: ExceptionIndex):
        _, self.ends, row = word_spans(data, offsets)
        rows = len(offsets) - 1
        self.offsets, self.first = offsets, np.searchsorted(row, np.arange(rows + 1))
        filled = offsets[1:] > offsets[:-1]
        tail = np.zeros(rows, bool)
        tail[filled] = WHITE[data[offsets[1:][filled] - 1]]
        self.words = np.diff(self.first)
        self.n = self.words + tail

    def cut(self, k: np.ndarray) -> np.ndarray:
        """Byte position after ``k`` tokens of each row."""
        out = np.where(k > self.words, self.offsets[1:], self.offsets[:-1])
        inside = np.flatnonzero((k > 0) & (k <= self.words))
        out[inside] = self.ends[self.first[inside] + k[inside] - 1]
        return out


class _Characters:
    """Cuts between code points."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, index: ExceptionIndex):
        self.index, self.points = index, index.to_points(offsets)
        self.n = np.diff(self.points)

    def cut(self, k: np.ndarray) -> np.ndarray:
        return self.index.to_bytes(self.points[:-1] + k)


UNITS = {"token": _Tokens, "character": _Characters}


def _draws(doc_id: Column, seed: int) -> list[Column]:
    """The first four 32-bit numbers of the digest of seed and id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long").alias(f"h{i + 1}") for i in range(4)]


def fill_in_middle(docs: DataFrame, unit: str = "token", rate: int = 50, spm_rate: int = 80, seed: int = 42,
                   sentinels: Sequence[str] = SENTINELS, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Every document with its middle moved to the end, or as it is.

    A text of n units (``token`` or ``character``) is cut after two drawn
    numbers of units, 0 to n, into prefix, middle and suffix. ``rate`` per
    cent of the documents are transformed, ``spm_rate`` per cent of these
    with the suffix first (``spm``), else the prefix first (``psm``).

    Returns ``doc_id``, ``n``, ``form``, ``prefix_chars`` and
    ``middle_chars`` (code points, null if plain) and ``output``.

    Null texts count as empty. Empty texts, and those that hold a sentinel,
    stay plain. Null ids draw as an empty id; rows that repeat an id are cut
    alike; an empty table gives no rows. Texts of any length are cut whole
    (a long one alone in its step); other columns are ignored. Nothing is
    shuffled.
    """
    small_batches(docs.sparkSession)
    prefix, suffix, middle = (s.encode() for s in sentinels)
    found = re.compile(b"|".join(re.escape(s.encode()) for s in sentinels))
    cuts = UNITS[unit]
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), *_draws(F.col(doc_id), seed))
    schema = T.StructType([
        T.StructField("doc_id", rows.schema["doc_id"].dataType), T.StructField("n", T.LongType()),
        T.StructField("form", T.StringType()), T.StructField("prefix_chars", T.LongType()),
        T.StructField("middle_chars", T.LongType()), T.StructField("output", T.StringType())])

    def transform(b: pa.RecordBatch) -> pa.RecordBatch:
        data, offsets = utf8(b.column("text"))
        view = memoryview(np.ascontiguousarray(data))
        index = ExceptionIndex(data)
        units = cuts(data, offsets, index)
        h1, h2, h3, h4 = (b.column(f"h{i}").to_numpy() for i in (1, 2, 3, 4))
        one, two = h1 % (units.n + 1), h2 % (units.n + 1)
        low, high = units.cut(np.minimum(one, two)), units.cut(np.maximum(one, two))
        drawn = (h3 % 100 < rate) & (offsets[1:] > offsets[:-1])
        form, out = [], []
        for row, (s, a, z, e, taken, first) in enumerate(zip(
                offsets[:-1].tolist(), low.tolist(), high.tolist(), offsets[1:].tolist(), drawn.tolist(),
                (h4 % 100 < spm_rate).tolist())):
            if not taken or found.search(view[s:e]):
                drawn[row] = False
                form.append(PLAIN)
                out.append(view[s:e].tobytes())
            elif first:
                form.append(SPM)
                out.append(b"".join((suffix, view[z:e], prefix, view[s:a], middle, view[a:z])))
            else:
                form.append(PSM)
                out.append(b"".join((prefix, view[s:a], suffix, view[z:e], middle, view[a:z])))
        start, left, right = (index.to_points(x) for x in (offsets[:-1], low, high))
        return pa.RecordBatch.from_arrays([
            b.column("doc_id"), pa.array(units.n.astype(np.int64)), pa.array(form, pa.string()),
            pa.array(left - start, pa.int64(), mask=~drawn), pa.array(right - left, pa.int64(), mask=~drawn),
            pa.array(out, pa.binary()).cast(pa.string())], schema.names)

    def run(batches):
        for b in sliced(batches):
            yield transform(b)

    return rows.mapInArrow(run, schema)


def restored(rows: DataFrame, sentinels: Sequence[str] = SENTINELS) -> DataFrame:
    """``rows`` with the text rebuilt from ``output`` and ``form`` as ``restored``.

    Exact: a transformed text holds none of the sentinels, and no piece of
    it can form one together with the sentinel that follows or precedes it.
    """
    border = "|".join("\\Q" + s + "\\E" for s in sentinels)
    parts = F.split("output", border, 4)  # empty, the two that come first, the middle
    prefix, suffix = (F.when(F.col("form") == PSM, parts[i]).otherwise(parts[3 - i]) for i in (1, 2))
    whole = F.when(F.col("form") == PLAIN, F.col("output")).otherwise(F.concat(prefix, parts[3], suffix))
    return rows.withColumn("restored", whole)


FIM_SQL = r"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
         regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS tokens
  FROM documents),
drawn AS (
  SELECT *, len(tokens) AS n, CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
         CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4
  FROM t),
formed AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 50
              THEN 'plain' WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM drawn),
cut AS (
  SELECT *, coalesce(array_to_string(tokens[1:a], ''), '') AS p, coalesce(array_to_string(tokens[a + 1:b], ''), '') AS m,
         coalesce(array_to_string(tokens[b + 1:n], ''), '') AS s
  FROM formed)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM cut
"""

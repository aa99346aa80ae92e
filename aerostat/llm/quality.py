"""Quality rules on repetition coverage.

Measures, per document, how many characters stand inside repeated word
n-grams of several lengths and inside repeated lines. Words, lines and
n-grams are numpy hashes over the text bytes of a whole slice of documents;
an n-gram of length n + 1 can only repeat where its first n words do, so
each longer length looks at the places that are left. A document is scored
where it is read: no shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from aerostat.llm.common import mix, range_hashes, sliced, small_batches, utf8, word_spans

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_STEP = np.uint64(0x9FB21C651E98DF25)


@dataclass(frozen=True)
class RepetitionRules:
    """Limits of the published heuristics for web text.

    ``ngram_chars`` maps a length in words to the largest share of word
    characters inside repeats of such n-grams, ``line_chars`` is the same
    for characters of lines, ``symbols`` the most symbols a word.
    """

    ngram_chars: dict[int, float] = field(
        default_factory=lambda: {5: 0.15, 6: 0.14, 7: 0.13, 8: 0.12, 9: 0.11, 10: 0.10})
    line_chars: float = 0.20
    symbols: float = 0.10
    least_words: int = 50
    most_repeat_words: float = 0.50
    window: int = 3


def repeats(keys: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places whose key occurs more than once in their row: all, and which come first."""
    order = np.argsort(mix(keys + rows.astype(np.uint64) * _STEP))
    k, r = keys[order], rows[order]
    same = (k[1:] == k[:-1]) & (r[1:] == r[:-1])
    if not same.any():
        return np.zeros(0, np.int64), np.zeros(0, bool)
    member = np.zeros(len(k), dtype=bool)
    member[1:] |= same
    member[:-1] |= same
    at = np.flatnonzero(member)
    opens = np.ones(len(at), dtype=bool)
    opens[1:] = ~same[at[1:] - 1]
    place = order[at]
    first = np.minimum.reduceat(place, np.flatnonzero(opens))[np.cumsum(opens) - 1]
    by_place = np.argsort(place)
    return place[by_place], (place == first)[by_place]


def _covered(n: int, starts: np.ndarray, length: int) -> np.ndarray:
    edge = np.zeros(n + 1, dtype=np.int32)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + length, -1)
    return np.cumsum(edge[:-1], dtype=np.int32) > 0


def _counted(mask: np.ndarray) -> np.ndarray:
    """Number of set places before each place."""
    out = np.zeros(len(mask) + 1, np.int32)  # a batch is shorter than 2**31 bytes
    np.cumsum(mask, dtype=np.int32, out=out[1:])
    return out


def _per_row(values: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(rows, weights=values, minlength=n).astype(np.int64)


def measure(data: np.ndarray, offsets: np.ndarray, rules: RepetitionRules) -> dict[str, np.ndarray]:
    """All measures of the texts in ``data``; one entry per text."""
    n = len(offsets) - 1
    start, end, row = word_spans(data, offsets)
    row = row.astype(np.int32)
    symbols = _counted(_SYMBOL[data])[offsets]
    opens_char = _counted((data & 0xC0) != 0x80)
    chars = opens_char[end] - opens_char[start]
    words = np.bincount(row, minlength=n).astype(np.int64)
    word_chars = _per_row(chars, row, n)
    out = {"n_words": words, "word_chars": word_chars, "n_symbols": np.diff(symbols).astype(np.int64)}

    # n-grams
    word = range_hashes(data, start, end)
    alive, gram, length = np.arange(len(word)), word, 1
    lengths = sorted({rules.window, *rules.ngram_chars})
    for want in lengths:
        stay = alive + want <= len(word)
        alive, gram = alive[stay], gram[stay]
        stay = row[alive + want - 1] == row[alive]
        alive, gram = alive[stay], gram[stay]
        for k in range(length, want):
            gram = mix(gram * _STEP + word[alive + k])
        length = want
        place, first = repeats(gram, row[alive])
        at = alive[place]
        if want == rules.window:
            out["n_repeat_words"] = _per_row(_covered(len(word), at, want), row, n)
        if want in rules.ngram_chars:
            later = _covered(len(word), at[~first], want)
            out[f"chars_{want}"] = _per_row(chars * later, row, n)
        alive, gram = at, gram[place]

    # lines that hold a word
    breaks = np.flatnonzero(data == 0x0A)
    line_start = np.unique(np.concatenate([offsets[:-1], breaks + 1]))
    line_start = line_start[line_start < len(data)]
    line_end = np.concatenate([line_start[1:], [len(data)]])[:len(line_start)]
    line_end = line_end - (data[line_end - 1] == 0x0A) if len(line_end) else line_end
    has_word = np.searchsorted(start, line_end, side="left") > np.searchsorted(start, line_start, side="left")
    line_start, line_end = line_start[has_word], line_end[has_word]
    line_row = np.searchsorted(offsets, line_start, side="right") - 1
    line_chars = opens_char[line_end] - opens_char[line_start]
    place, first = repeats(range_hashes(data, line_start, line_end), line_row)
    later = np.zeros(len(line_start), dtype=bool)
    later[place[~first]] = True
    out["n_dup_lines"] = _per_row(later, line_row, n)
    out["n_lines"] = np.bincount(line_row, minlength=n).astype(np.int64)
    out["dup_line_chars"] = _per_row(later * line_chars, line_row, n)
    out["line_chars"] = _per_row(line_chars, line_row, n)

    base_failed = (words < rules.least_words) | (out["n_repeat_words"] > rules.most_repeat_words * words)
    failed = (out["n_symbols"] > rules.symbols * words) | (
        out["dup_line_chars"] > rules.line_chars * out["line_chars"])
    for length, limit in rules.ngram_chars.items():
        failed |= out[f"chars_{length}"] > limit * word_chars
    out["base_failed"] = base_failed
    out["kept"] = ~base_failed & ~failed
    return out


def repetition_quality(docs: DataFrame, rules: RepetitionRules = RepetitionRules(), text: str = "text",
                       doc_id: str = "doc_id") -> DataFrame:
    """Repetition measures and verdict of every document.

    Returns ``doc_id``, ``n_words``, ``word_chars``, ``n_symbols``,
    ``n_dup_lines``, ``n_repeat_words``, ``base_failed``, ``kept``; then
    ``n_lines``, ``line_chars``, ``dup_line_chars`` and one
    ``chars_<n>`` per n-gram length: characters of words inside n-grams
    that stood earlier in the text.

    Null and empty texts have no words and fail. Every row is judged by
    itself, so repeated rows and null ids each get a row; texts of any
    length are measured whole, one at a time if need be; an empty table
    gives no rows; other columns are ignored.
    """
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
             "n_lines", "line_chars", "dup_line_chars", *[f"chars_{k}" for k in sorted(rules.ngram_chars)]]
    kinds = {"base_failed": "boolean", "kept": "boolean"}
    schema = "doc_id long, " + ", ".join(f"{c} {kinds.get(c, 'long')}" for c in names)

    def run(batches):
        for piece in sliced(batches):
            got = measure(*utf8(piece.column(1)), rules)
            yield pa.RecordBatch.from_arrays([piece.column(0), *[pa.array(got[c]) for c in names]], ["doc_id", *names])

    small_batches(docs.sparkSession)
    return docs.selectExpr(f"CAST(`{doc_id}` AS BIGINT) AS doc_id", f"`{text}` AS text").mapInArrow(run, schema)


def _gram_sql(n: int) -> str:
    """Flags of the words of window ``n``: later repeats of an n-gram start here; any repeat starts here."""
    gram = " || ' ' || ".join(["w"] + [f"lead(w, {k}) OVER o" for k in range(1, n)])
    return f"""g{n} AS (SELECT id, p, c, {gram} AS g FROM words WINDOW o AS (PARTITION BY id ORDER BY p)),
r{n} AS (
  SELECT id, p, c, g IS NOT NULL AND row_number() OVER (PARTITION BY id, g ORDER BY p) > 1 AS again,
         g IS NOT NULL AND count(*) OVER (PARTITION BY id, g) > 1 AS twice FROM g{n}),
c{n} AS (
  SELECT id, CAST(sum(CASE WHEN inside THEN c ELSE 0 END) AS BIGINT) AS later_chars,
         CAST(sum(CASE WHEN any_inside THEN 1 ELSE 0 END) AS BIGINT) AS any_words
  FROM (SELECT id, c, bool_or(again) OVER o AS inside, bool_or(twice) OVER o AS any_inside FROM r{n}
        WINDOW o AS (PARTITION BY id ORDER BY p ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW))
  GROUP BY id)"""


def quality_sql(rules: RepetitionRules = RepetitionRules()) -> str:
    """``repetition_quality`` of ``documents`` in DuckDB's SQL."""
    lengths = sorted(rules.ngram_chars)
    grams = ",\n".join(_gram_sql(n) for n in [rules.window, *lengths])
    chars = ", ".join(f"coalesce(c{n}.later_chars, 0) AS chars_{n}" for n in lengths)
    joins = " ".join(f"LEFT JOIN c{n} ON c{n}.id = d.id" for n in [rules.window, *lengths])
    limits = " AND ".join(f"chars_{n} <= {limit} * word_chars" for n, limit in sorted(rules.ngram_chars.items()))
    word = r"[^\x20\x09-\x0D]+"
    return f"""
WITH d AS (SELECT row_number() OVER () AS id, doc_id, coalesce(text, '') AS text FROM documents),
found AS (SELECT id, regexp_extract_all(text, '{word}') AS ws FROM d),
words AS (SELECT id, p, ws[p] AS w, length(ws[p]) AS c FROM (SELECT id, ws, unnest(range(1, len(ws) + 1)) AS p FROM found)),
{grams},
split AS (SELECT id, string_split(text, chr(10)) AS ls FROM d),
lines AS (
  SELECT id, length(l) AS c, row_number() OVER (PARTITION BY id, l ORDER BY p) > 1 AS again
  FROM (SELECT id, p, ls[p] AS l FROM (SELECT id, ls, unnest(range(1, len(ls) + 1)) AS p FROM split))
  WHERE regexp_matches(l, '{word}')),
line_sums AS (
  SELECT id, count(*) AS n_lines, CAST(sum(c) AS BIGINT) AS line_chars, CAST(sum(CASE WHEN again THEN 1 ELSE 0 END) AS BIGINT) AS n_dup_lines,
         CAST(sum(CASE WHEN again THEN c ELSE 0 END) AS BIGINT) AS dup_line_chars
  FROM lines GROUP BY id),
word_sums AS (SELECT id, count(*) AS n_words, CAST(sum(c) AS BIGINT) AS word_chars FROM words GROUP BY id),
measured AS (
  SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0) AS word_chars,
         CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
         coalesce(c{rules.window}.any_words, 0) AS n_repeat_words, coalesce(n_lines, 0) AS n_lines,
         coalesce(line_chars, 0) AS line_chars, coalesce(dup_line_chars, 0) AS dup_line_chars, {chars}
  FROM d LEFT JOIN word_sums ON word_sums.id = d.id LEFT JOIN line_sums ON line_sums.id = d.id {joins}),
judged AS (
  SELECT *, n_words < {rules.least_words} OR n_repeat_words > {rules.most_repeat_words} * n_words AS base_failed FROM measured)
SELECT *, NOT base_failed AND n_symbols <= {rules.symbols} * n_words AND dup_line_chars <= {rules.line_chars} * line_chars
  AND {limits} AS kept
FROM judged
"""

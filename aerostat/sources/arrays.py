"""Large landed JSON arrays, each read by several tasks.

Spark reads a multi-line JSON file in one task. Here a file is read by byte
ranges, as lines that end at what stands between its first two elements (or
at ``}``); a line may end anywhere, that only decides how many there are.
The borders of the elements are found by a scan of quotes, escapes and
nesting:

1. every range reports its quotes, and how far it changes the nesting if it
   begins outside or inside a string (one row a range);
2. running sums of these tell where each range begins: the number of quotes
   before it is odd inside a string, and the nesting follows;
3. every range is cut at the commas between elements. Whole elements go on;
   the pieces at its two ends meet their neighbours, at most two a range.

Elements are parsed by ``from_json``. Only the scan is Python, on Arrow
batches; a task holds a batch and the element that is open.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUOTE, BACKSLASH = 0x22, 0x5C
_DELTA = np.zeros(256, np.int64)
_DELTA[[0x7B, 0x5B]] = 1  # { [
_DELTA[[0x7D, 0x5D]] = -1  # } ]
_MARK = _DELTA != 0
_MARK[0x2C] = True  # ,
_WHITE = b" \t\r\n"

RANGE = ["file", "start"]  # a byte range: digest of the path, first byte


def quotes(data: np.ndarray) -> np.ndarray:
    """Positions of the quotes that open or close a string: those after an even number of backslashes."""
    at = np.flatnonzero(data == QUOTE)
    escaped = np.zeros(len(at), bool)
    alive, before = np.arange(len(at)), at - 1
    while len(alive):
        on = (before >= 0) & (data[before] == BACKSLASH)
        alive, before = alive[on], before[on] - 1
        escaped[alive] ^= True
    return at[~escaped]


def marks(data: np.ndarray, real: np.ndarray, inside: int) -> np.ndarray:
    """Positions of brackets, braces and commas outside of strings; ``inside``: the data begin in a string."""
    at = np.flatnonzero(_MARK[data])
    return at[(np.searchsorted(real, at) + inside) % 2 == 0]


def _ranges(batches, *more: str) -> Iterator[tuple[tuple, np.ndarray]]:
    """The bytes of each range, a batch at a time, with its key and further columns."""
    for b in batches:
        if not b.num_rows:
            continue
        file, start = (b.column(c).to_numpy() for c in RANGE)
        cut = np.flatnonzero((np.diff(file) != 0) | (np.diff(start) != 0)) + 1
        text = b.column("text").cast(pa.large_binary())
        ends = np.frombuffer(text.buffers()[1], np.int64)[text.offset:text.offset + len(text) + 1]
        data = np.frombuffer(text.buffers()[2], np.uint8)
        for s, e in zip([0, *cut], [*cut, b.num_rows]):
            yield (int(file[s]), int(start[s]), *[b.column(c)[int(s)].as_py() for c in more]), data[ends[s]:ends[e]]


def _summaries(batches):
    schema = pa.schema([("file", pa.int64()), ("start", pa.int64()), ("quotes", pa.int64()), ("outside", pa.int64()), ("inside", pa.int64())])
    here, seen, change = None, 0, [0, 0]
    for key, data in _ranges(batches):
        if here not in (None, key):
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, (*here, seen, *change)))], schema)
            seen, change = 0, [0, 0]
        here, real = key, quotes(data)
        for begins in (0, 1):
            change[begins] += int(_DELTA[data[marks(data, real, (begins + seen) % 2)]].sum())
        seen += len(real)
    if here is not None:
        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, (*here, seen, *change)))], schema)


PIECES = "file long, start long, nth long, tag string, opens boolean, alone_from boolean, alone_to boolean, values int, element string"
WHOLE = "tag string, alone boolean, values int, element string"


class _Cutter:
    """Elements and pieces of elements in one range. ``depth`` is 1 between the elements of an array."""

    def __init__(self, key: tuple, separator: bytes):
        self.file, self.start, self.tag, self.inside, self.depth = key
        self.separator = separator  # the last line of a file has got one too many
        self.opens, self.bracket, self.closed = False, False, False  # how what is being read has begun
        self.nth, self.values, self.parts = 0, 0, []
        self.whole: list[tuple] = []
        self.pieces: list[tuple] = []

    def read(self, data: np.ndarray) -> None:
        real = quotes(data)
        at = marks(data, real, self.inside)
        kind, change = data[at], _DELTA[data[at]]
        depth = self.depth + np.cumsum(change)
        begins = (depth == 1) & (change > 0)
        ends = (depth == 0) & (change < 0)
        values = np.cumsum((depth == 1) & (change < 0))  # values of the array that have ended
        raw, done, base = data.tobytes(), 0, 0
        for i in np.flatnonzero(begins | ends | (depth == 1) & (change == 0)).tolist():
            place, upto = int(at[i]), int(values[i])
            self.parts.append(raw[done:place])
            self.values += upto - base
            done, base = place + 1, upto
            if begins[i]:
                if kind[i] != 0x5B or self.closed or self.start or self._text().strip(_WHITE):
                    raise ValueError("a file holds something else than one JSON array")
                self.opens = self.bracket = True
                self.parts, self.values = [], 0
            else:
                self._row(True, bool(ends[i]))
                self.opens, self.bracket, self.closed = True, False, self.closed or bool(ends[i])
        self.parts.append(raw[done:])
        self.values += (int(values[-1]) if len(values) else 0) - base
        self.inside = (self.inside + len(real)) % 2
        self.depth = int(depth[-1]) if len(depth) else self.depth

    def _text(self) -> bytes:
        return b"".join(self.parts)

    def _row(self, closes: bool, last: bool) -> None:
        text = self._text()
        if self.opens and closes:
            self.whole.append((self.tag, self.bracket and last, self.values, text))
        else:
            self.pieces.append((self.file, self.start, self.nth, self.tag, self.opens, self.bracket, last, self.values, text))
        self.nth, self.values, self.parts = self.nth + 1, 0, []

    def end(self) -> None:
        """The range is over."""
        if self.depth > 0:
            self._row(False, False)
        elif self._text().removesuffix(self.separator).strip(_WHITE):
            raise ValueError("a file holds something else than one JSON array")


def _cut(which: str, columns: str, separator: str):
    types = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_()}
    schema = pa.schema([(name, types[kind]) for name, kind in (c.split() for c in columns.split(", "))])

    def run(batches):
        here = None

        def out():
            rows = getattr(here, which)
            for at in range(0, len(rows), 10_000):
                some = zip(*rows[at:at + 10_000])
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(some, schema)], schema=schema)
            here.whole, here.pieces = [], []

        for key, data in _ranges(batches, "tag", "begins_inside", "begins_depth"):
            if here is None or (here.file, here.start) != key[:2]:
                if here:
                    here.end()
                    yield from out()
                here = _Cutter(key, separator.encode())
            here.read(data)
            yield from out()
        if here:
            here.end()
            yield from out()

    return run


PEEK_FILES, PEEK_LINES = 64, 50


def _between(text: bytes) -> str | None:
    """What stands between the first two elements of an array of objects, from brace to brace."""
    data = np.frombuffer(text, np.uint8)
    at = marks(data, quotes(data), 0)
    depth = np.cumsum(_DELTA[data[at]])
    comma = np.flatnonzero((depth == 1) & (data[at] == 0x2C))
    if not len(comma):
        return None
    place = int(at[comma[0]])
    end = text.find(b"{", place)
    found = text[text.rfind(b"}", 0, place):end + 1]
    return found.decode() if end > 0 and not found[1:-1].replace(b",", b"", 1).strip(_WHITE) else None


def _separator(spark: SparkSession, paths: list[str]) -> str:
    """The line end to read files by: what is between their elements if that is the same in all, else a brace.

    The driver looks at the first lines of up to 64 files; where there are
    more, they are many tasks anyway.
    """
    files = spark.read.option("lineSep", "}").text(paths).inputFiles()
    if not 0 < len(files) <= PEEK_FILES:
        return "}"
    heads = [spark.read.option("lineSep", "}").text(f).where(F.col("_metadata.file_block_start") == 0).limit(PEEK_LINES).select(
        F.lit(i).alias("file"), F.substring("value", 1, 4096).alias("value")) for i, f in enumerate(files)]
    seen: dict[int, list[str]] = {}
    for r in reduce(DataFrame.unionAll, heads).collect():
        seen.setdefault(r["file"], []).append(r["value"])
    found = {_between("".join(v + "}" for v in lines).encode()) for lines in seen.values()}
    one = found.pop() if len(found) == 1 else None
    return one or "}"


def _begins(ranges: DataFrame, separator: str) -> DataFrame:
    """Per range whether it begins in a string and how deep; one row a range, so a file's ranges are few."""
    summary = ranges.mapInArrow(_summaries, "file long, start long, quotes long, outside long, inside long")
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    last = Window.partitionBy("file").orderBy(F.desc("start"))
    begun = summary.withColumn("begins_inside", (F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2).cast("int")).withColumn(
        "change", F.when(F.col("begins_inside") == 1, F.col("inside")).otherwise(F.col("outside"))).withColumn(
        "begins_depth", F.coalesce(F.sum("change").over(before), F.lit(0))).withColumn("from_last", F.row_number().over(last))
    # the last line has no separator of its own, so a whole file ends off its beginning by that
    off = separator.count("{") - separator.count("}")
    whole = ((F.col("begins_inside") + F.col("quotes")) % 2 == 0) & (F.col("begins_depth") + F.col("change") == off)
    broken = (F.col("from_last") == 1) & ~whole
    depth = F.when(broken, F.raise_error(F.lit("a JSON array is cut off"))).otherwise(F.col("begins_depth"))
    return begun.select(*RANGE, "begins_inside", depth.cast("int").alias("begins_depth"))


def read_array_elements(spark: SparkSession, paths: str | Sequence[str], tag: Column | None = None) -> DataFrame:
    """``element`` texts of the JSON arrays in files, and a ``tag`` made from ``_metadata`` columns.

    A file holds one array of objects, or only white space. One that is cut
    off or holds anything else fails the job. Ranges are as long as Spark
    splits files (``spark.sql.files.maxPartitionBytes``); a compressed file
    is one range. The files are read three times: for the borders, for the
    elements within a range and for those that cross one.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    separator = _separator(spark, paths)
    lines = spark.read.option("lineSep", separator).text(paths).select(
        F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.concat("value", F.lit(separator)).alias("text"), (F.lit(None) if tag is None else tag).cast("string").alias("tag"))
    begins = F.broadcast(_begins(lines.select(*RANGE, "text"), separator))  # 24 bytes per range
    known = lines.join(begins, RANGE).select(*RANGE, "tag", "begins_inside", "begins_depth", "text")
    order = Window.partitionBy("file").orderBy("start", "nth")  # two pieces a range at most
    stitched = known.mapInArrow(_cut("pieces", PIECES, separator), PIECES).withColumn(
        "element_no", F.sum(F.col("opens").cast("int")).over(order)).groupBy("file", "element_no").agg(
        F.sort_array(F.collect_list(F.struct("start", "nth", "element"))).alias("parts"), F.first("tag").alias("tag"),
        F.sum("values").cast("int").alias("values"), (F.max("alone_from") & F.max("alone_to")).alias("alone"))
    stitched = stitched.select("tag", "alone", "values", F.concat_ws("", "parts.element").alias("element"))
    every = known.mapInArrow(_cut("whole", WHOLE, separator), WHOLE).unionByName(stitched)
    text = F.btrim("element", F.lit(" \t\r\n"))
    fine = (F.col("values") == 1) & text.startswith("{") & text.endswith("}")
    empty = F.col("alone") & (text == "")  # an array without elements
    return every.select("tag", F.when(fine, F.col("element")).when(empty, F.lit(None)).otherwise(
        F.raise_error(F.lit("an element of a JSON array is no object"))).alias("element")).where("element IS NOT NULL")


def read_arrays(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType, tag: Column | None = None) -> DataFrame:
    """Records of JSON arrays with a fixed schema, as the multi-line reader gives them, and ``tag`` if one is asked for."""
    elements = read_array_elements(spark, paths, tag)
    record = F.from_json("element", schema, {"mode": "FAILFAST"}).alias("record")
    rows = elements.select("tag", record)
    return rows.select("record.*", *["tag"] * (tag is not None))

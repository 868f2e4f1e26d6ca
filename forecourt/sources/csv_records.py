"""Quoted CSV as delivered, read in splits.

Spark deals physical lines; a line may lie inside a quoted field, so where a
record starts depends on everything before it.  But a line does only one of
four things to "inside quotes": it keeps it, opens it, closes it or swaps it.
Tasks find which for a batch of lines at a time (``kind``, two bits: whether a line ends inside if it
starts outside, and if it starts inside).  Pass one composes that over the lines of each split, and a prefix
composition over the splits of each file tells in which state a split starts.  Pass two reads
the splits again, each by itself: it returns the records that lie inside a split
(Arrow's reader has the same rules; what it cannot take goes record by record), and, only where some split starts inside quotes, the pieces of the records that
cross a border, which are put together by file.

Fields are returned as received: doubled quotes undone, commas, quotes, blanks
and newlines kept, a quote inside an unquoted field literal.  An unquoted empty
field is null, a quoted one is empty.  Empty lines are no records.  A record with too few
or too many fields, with a quote that is never closed or with bytes that are no
UTF-8 keeps its text in ``_rescued``; missing fields are null, surplus ones are there only.

The driver holds one state a split, as it already holds the list of splits.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.csv as pacsv
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

RESCUED = "_rescued"
#: A field and what ends it: quoted (with what follows the closing quote) or not.
_QUOTED = r'"([^"]*+(?:""[^"]*+)*+)"([^,]*+)'
FIELD = re.compile(rf"(?:{_QUOTED}|([^,]*+))(,|\Z)", re.S)
#: A text that ends outside quotes if it started there.
_ANY = rf"(?:{_QUOTED}|(?!\")[^,]*+)".replace("([", "(?:[")
CLOSED = re.compile(rf"{_ANY}(?:,{_ANY})*+\Z", re.S)
_CLOSED_JAVA = rf"(?s)\A{_ANY}(?:,{_ANY})*+\z"
#: The kind of a line that changes nothing.
KEEPS = 2
#: Lines with more quotes are matched with the pattern.
MANY = 64


def fields(record: str) -> list[str | None]:
    """The fields of a record whose quotes are closed."""
    if '"' not in record:
        return [x or None for x in record.split(",")]
    found, at = [], 0
    while True:
        m = FIELD.match(record, at)
        quoted, rest, plain, end = m.groups()
        found.append(plain or None if quoted is None else quoted.replace('""', '"') + rest)
        if not end:
            return found
        at = m.end()


def ends_inside(line: str, inside: bool) -> bool:
    """Whether a line ends inside quotes, by how it starts."""
    return not CLOSED.match('"' + line if inside else line)


def _lines(spark: SparkSession, path: str) -> DataFrame:
    source = spark.read.option("lineSep", "\n").text(path)
    inside = lambda text: (~text.rlike(_CLOSED_JAVA)).cast("int")
    value = F.col("value")
    kind = F.when(F.contains(value, F.lit('"')), inside(value) + inside(F.concat(F.lit('"'), value)) * 2).otherwise(KEEPS)
    return source.select(value.cast("binary").alias("line"), kind.cast("tinyint").alias("kind"),
                         F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"))


def line_kinds(lines: pa.Array) -> np.ndarray:
    """``kind`` of ``_lines`` for the lines of a batch: their first quotes together, then the second, and so on."""
    kind = np.full(len(lines), KEEPS, np.int8)
    lines = lines.cast(pa.large_binary())
    _, offsets, data = lines.buffers()
    offsets = np.frombuffer(offsets, np.int64)[lines.offset:lines.offset + len(lines) + 1] if len(lines) else np.zeros(1, np.int64)
    data = np.frombuffer(data or b"", np.uint8)
    quote = np.flatnonzero(data[offsets[0]:offsets[-1]] == ord('"')) + offsets[0]
    if not len(quote):
        return kind
    line = np.searchsorted(offsets, quote, side="right") - 1
    opens = (quote == offsets[line]) | (data[quote - 1] == ord(","))
    doubled = np.append((np.diff(quote) == 1) & (np.diff(line) == 0), False)
    first = np.flatnonzero(np.append(True, line[1:] != line[:-1]))
    has, count = line[first], np.diff(np.append(first, len(line)))
    ends = np.zeros((2, len(has)), np.int8)
    ends[1] = 1  # 0 outside, 1 inside, 2 between doubled quotes
    for j in range(min(int(count.max()), MANY)):
        live = np.flatnonzero(count > j)
        at = first[live] + j
        for state in ends:
            now = state[live]
            state[live] = np.where(now == 0, opens[at], np.where(now == 1, doubled[at] * 2, 1))
    for k in np.flatnonzero(count > MANY):
        text = lines[int(has[k])].as_py().decode("latin-1")
        ends[:, k] = [ends_inside(text, x) for x in (False, True)]
    kind[has] = (ends[0] > 0) + 2 * (ends[1] > 0)
    return kind


def _decoded(raw: bytes) -> tuple[str, bool]:
    try:
        return raw.decode(), True
    except UnicodeDecodeError:
        return raw.decode("utf-8", "replace"), False


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple[int, int], slice]]:
    """Where the lines of each split are in a batch, in order."""
    file, at = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("file", "at"))
    cuts = [0, *(np.flatnonzero((np.diff(file) != 0) | (np.diff(at) != 0)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        if b > a:
            yield (int(file[a]), int(at[a])), slice(a, b)


def inside_after(kind: np.ndarray, start: bool) -> np.ndarray:
    """Whether each line ends inside quotes, by the kinds of the lines and the state before the first."""
    out, ins = (kind & 1).astype(bool), (kind & 2).astype(bool)
    # the last line whose end does not depend on its start, and the swaps since
    last = np.maximum.accumulate(np.where(out == ins, np.arange(len(kind)), -1))
    swaps = np.cumsum(out & ~ins)
    known = last >= 0
    return np.where(known, out[last], start) ^ ((swaps - np.where(known, swaps[last], 0)) % 2 == 1)


# ---------------------------------------------------------------- pass one
def split_states(spark: SparkSession, path: str) -> DataFrame:
    """(file, at, from_outside, from_inside): the state at the end of each split, by that at its start."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        states = {}
        for batch in batches:
            kind = line_kinds(batch.column("line"))
            for key, run in _runs(batch):
                ends = [bool(inside_after(kind[run], x)[-1]) for x in (False, True)]
                states[key] = tuple(ends[x] for x in states.get(key, (False, True)))
        yield pa.RecordBatch.from_pylist(
            [{"file": k[0], "at": k[1], "from_outside": a, "from_inside": b} for k, (a, b) in states.items()],
            schema=pa.schema([("file", pa.int64()), ("at", pa.int64()), ("from_outside", pa.bool_()), ("from_inside", pa.bool_())]))

    return _lines(spark, path).drop("kind").mapInArrow(
        run, "file long, at long, from_outside boolean, from_inside boolean")


def open_splits(spark: SparkSession, path: str) -> tuple[set[tuple[int, int]], bool]:
    """The splits that start inside quotes, and whether any file ends so."""
    found, inside, last, unclosed = set(), False, None, False
    # one row a split, put in order here: a sort in Spark reads its input once more for its ranges
    for r in sorted(split_states(spark, path).collect(), key=lambda r: (r.file, r.at)):
        if r.file != last:
            unclosed, inside, last = unclosed or inside, False, r.file
        if inside:
            found.add((r.file, r.at))
        inside = r.from_inside if inside else r.from_outside
    return found, unclosed or inside


# ---------------------------------------------------------------- pass two
class _Split:
    """The records of one split, run by run."""

    def __init__(self, starts_inside: bool, first_of_file: bool):
        self.inside, self.head, self.header, self.held = starts_inside, starts_inside, first_of_file, []

    def take(self, lines: pa.Array, kind: np.ndarray) -> tuple[pa.Array, np.ndarray, list[bytes]]:
        """The lines of the records that end here, the places after those that end one, and the
        end of a record that started in a split before."""
        after = inside_after(kind, self.inside)
        self.inside = bool(after[-1])
        ends, heads, before = np.flatnonzero(~after) + 1, [], sum(map(len, self.held))
        if not len(ends):
            self.held.append(lines)
            return lines.slice(0, 0), ends, heads
        cut = int(ends[-1])
        whole = pa.concat_arrays([*self.held, lines.slice(0, cut)])
        self.held, ends = [lines.slice(cut)] if cut < len(lines) else [], ends + before
        if self.head:
            first, self.head = int(ends[0]), False
            heads, whole, ends = [_text(whole.slice(0, first))], whole.slice(first), ends[1:] - first
        return whole, ends, heads

    def without_header(self, whole: pa.Array, ends: np.ndarray) -> tuple[bytes | None, pa.Array, np.ndarray]:
        """The file's first record, and what comes after it."""
        at = 0
        for end in ends.tolist():
            record, at = _text(whole.slice(at, end - at)), end
            if record not in BLANK:
                self.header = False
                return record, whole.slice(end), ends[ends > end] - end
        return None, whole.slice(at), ends[:0]


BLANK = (b"", b"\r")


def _text(lines: pa.Array) -> bytes:
    """Lines as they were, joined again."""
    lists = pa.ListArray.from_arrays(pa.array([0, len(lines)], pa.int32()), lines)
    return pc.binary_join(lists, pa.scalar(b"\n", lines.type))[0].as_py()


def _records(whole: pa.Array, ends: np.ndarray) -> list[bytes]:
    lines, found = whole.to_pylist(), []
    for a, b in zip([0, *ends.tolist()], ends.tolist()):
        found.append(lines[a] if b == a + 1 else b"\n".join(lines[a:b]))
    return [x for x in found if x not in BLANK]


def _columns(whole: pa.Array, width: int) -> tuple[pa.Table, list[bytes]] | None:
    """Columns of the records that have ``width`` fields, and the other records; None if these
    lines have to go record by record (bytes that are no UTF-8, single carriage returns)."""
    data = _text(whole) + b"\n"
    if data.startswith(b"\xef\xbb\xbf") or data.count(b"\r") != data.count(b"\r\n"):
        return None
    names, other = [str(k) for k in range(width)], []

    def keep(row: pacsv.InvalidRow) -> str:
        other.append(row.text.encode())
        return "skip"

    try:
        table = pacsv.read_csv(
            pa.py_buffer(data), pacsv.ReadOptions(use_threads=False, block_size=len(data) + 1, column_names=names),
            pacsv.ParseOptions(newlines_in_values=True, invalid_row_handler=keep),
            pacsv.ConvertOptions(column_types={n: pa.string() for n in names}, null_values=[""], strings_can_be_null=True,
                                 quoted_strings_can_be_null=False))
    except pa.ArrowInvalid:
        return None
    return table, other


def parsed(records: list[tuple[bytes, bool]], names: list[str]) -> pa.RecordBatch:
    """Columns and ``_rescued`` of records, each with whether its quotes are closed."""
    width, rows = len(names) - 1, []
    for raw, closed in records:
        text, good = _decoded(raw)
        text = text[:-1] if text.endswith("\r") else text
        found = fields(text if closed else text + '"')
        bad = not good or not closed or len(found) != width
        rows.append((*(found + [None] * width)[:width], text if bad else None))
    columns = list(zip(*rows)) if rows else [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in columns], names=names)


def header_fields(raw: bytes) -> list[str]:
    found = fields(_decoded(raw)[0].removeprefix("\ufeff").removesuffix("\r"))
    return [x or f"_c{k}" for k, x in enumerate(found)]


def header_of(spark: SparkSession, path: str) -> list[str]:
    """The column names, from the first record of one file."""
    for n in (1, 100, 100_000):
        rows = _lines(spark, path).where("at = 0").limit(n).collect()
        rows = [r for r in rows if r.file == rows[0].file]
        if rows:
            split = _Split(False, True)
            whole, ends, _ = split.take(pa.array([bytes(r.line) for r in rows], pa.binary()), np.array([r.kind for r in rows], np.int8))
            record = split.without_header(whole, ends)[0]
            if record is not None:
                return header_fields(record)
    return []


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """A CSV file, or a folder of them with equal headers, as text columns and ``_rescued``."""
    names = header_of(spark, path)
    opened, unclosed = open_splits(spark, path)
    columns, width = [*names, RESCUED], len(names)
    schema = ", ".join(f"`{c.replace('`', '``')}` string" for c in columns)

    def check_header(raw: bytes) -> None:
        if header_fields(raw) != names:
            raise ValueError(f"a file's header {raw!r} is not {names}")

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splits: dict[tuple, _Split] = {}
        for batch in batches:
            kind = line_kinds(batch.column("line"))
            for key, run in _runs(batch):
                split = splits.setdefault(key, _Split(key in opened, key[1] == 0))
                lines, ends, _ = split.take(batch.column("line")[run], kind[run])
                if split.header:
                    header, lines, ends = split.without_header(lines, ends)
                    if header is not None:
                        check_header(header)
                if not len(lines):
                    continue
                found = _columns(lines, width)
                if found is None:
                    rest = _records(lines, ends)
                else:
                    table, rest = found
                    for part in table.to_batches():
                        yield pa.RecordBatch.from_arrays([*part.columns, pa.nulls(len(part), pa.string())], names=columns)
                if rest:
                    yield parsed([(x, True) for x in rest], columns)

    if not names:
        return spark.createDataFrame([], f"{RESCUED} string")
    records = _lines(spark, path).drop("kind").mapInArrow(whole, schema)
    if not opened and not unclosed:
        return records

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            todo = []
            for raw, first, closed in zip(*(batch.column(c).to_pylist() for c in ("raw", "first", "closed"))):
                if first:
                    check_header(raw)
                else:
                    todo.append((raw, closed))
            yield parsed(todo, columns)

    return records.unionByName(crossing(spark, path, opened).mapInArrow(join, schema))


def crossing(spark: SparkSession, path: str, opened: set[tuple[int, int]]) -> DataFrame:
    """(raw, first, closed): the records that cross a border between splits or are never closed."""
    kinds = pa.schema([("file", pa.int64()), ("at", pa.int64()), ("opens", pa.bool_()), ("raw", pa.binary()),
                       ("first", pa.bool_()), ("closes", pa.bool_())])

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splits, rows = {}, []
        for batch in batches:
            kind = line_kinds(batch.column("line"))
            for key, run in _runs(batch):
                split = splits.setdefault(key, _Split(key in opened, key[1] == 0))
                whole, ends, heads = split.take(batch.column("line")[run], kind[run])
                rows += [(*key, False, x, False, True) for x in heads]
                if split.header:
                    split.without_header(whole, ends)
        for key, split in splits.items():
            if split.held:  # a record that goes on, from here or from before
                rows.append((*key, not split.head, _text(pa.concat_arrays(split.held)), split.header, False))
        yield pa.RecordBatch.from_pylist([dict(zip(kinds.names, r)) for r in rows], schema=kinds)

    found = _lines(spark, path).drop("kind").mapInArrow(pieces, "file long, at long, opens boolean, raw binary, first boolean, closes boolean")
    order = Window.partitionBy("file").orderBy("at", "opens").rowsBetween(Window.unboundedPreceding, 0)
    found = found.withColumn("nth", F.sum(F.col("opens").cast("long")).over(order))
    whole = found.groupBy("file", "nth").agg(F.array_sort(F.collect_list(F.struct("at", "opens", "raw"))).alias("parts"),
                                             F.bool_or("first").alias("first"), F.bool_or("closes").alias("closed"))
    text = F.expr("aggregate(slice(parts, 2, size(parts)), parts[0].raw, (a, x) -> concat(a, X'0A', x.raw))")
    return whole.select(text.alias("raw"), "first", "closed")

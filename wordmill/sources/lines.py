"""Lines of text files with exact numbers, and many tasks for one file, also a gzipped one.

:func:`build_index` cuts files into stretches of about ``STRETCH`` bytes and finds out where each one begins: for a gzipped file the bit of a
block and the window before it (see :mod:`.inflate`), and for all files the number of its first line. Files are taken in order of
their names, so a line's number depends on nothing else. The index is a small Parquet table (some 33 KB a stretch of gzipped text,
100 bytes of others), written once for files that don't change.

:class:`NumberedLines` is a data source over it, ``spark.read.format("numbered_lines")``: a partition for each stretch, read by a task that opens the
file at its place; ``firstLine`` leaves out the stretches before a line, so a scan that was cut off goes on from there without reading what it had.

Lines end at ``\\n``, ``\\r\\n`` or ``\\r``, as Spark's own text reader has it; bytes that are no UTF-8 become marks. Members of a gzipped file follow
each other. A file in which no block can be found (of very few blocks, or stored ones) has one stretch. Checksums of all members are compared when
the index is built; a file that doesn't agree is indexed again as one stretch, and if it still doesn't, it is broken, and that is an error.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from . import inflate as Z
from .files import filesystem, list_files

STRETCH = 1 << 25
#: Stretches whose windows one task composes.
BLOCK = 64

_STRETCHES = "file string, file_no int, size long, gzipped boolean, stretch int, begin long"
#: Bytes of a row group of the index, which is what a task reads of it; a hundred rows at least, as Parquet's writer counts.
GROUP = 1 << 20
INDEX = "file string, file_no int, stretch int, gzipped boolean, start_bit long, end_bit long, last boolean, window binary, first_line long, n_lines long"


def _reader(path: str):
    fs, at = filesystem(path)
    source = fs.open_input_file(at)

    def read(offset: int, length: int) -> bytes:
        source.seek(offset)
        return source.read(length)

    return read


def _pieces(read, row: dict, beyond: bool = False) -> Iterator[bytes | Z.Member | None]:
    """What a stretch holds; with ``beyond`` then None, and what follows it in the file."""
    decoder = Z.Inflater(row["window"]) if row["gzipped"] else None
    at, end = row["start_bit"] // 8, -(-row["end_bit"] // 8)
    first = row["start_bit"] % 8
    while data := read(at, min(Z.PIECE, end - at)):
        at += len(data)
        if decoder is None:
            yield data
        else:
            yield from decoder.feed(Z.lead_in(first, data[0]) + data[1:] if first else data)
        first = 0
        if at == end:
            if not beyond:
                return
            yield None
            end = 1 << 62


class _Lines:
    """Lines that begin in a stretch; ``before``: the byte before it, None at the start of a file."""

    def __init__(self, before: int | None):
        self.inside, self.after_return, self.held = before not in (None, 10, 13), before == 13, b""

    def feed(self, data: bytes) -> list[bytes]:
        if self.after_return and data:  # the line end before this stretch was its first half
            data, self.after_return = data.removeprefix(b"\n"), False
        found = (self.held + data).splitlines(keepends=True)
        # the last one may go on, and a return may be half of a line end
        self.held = found.pop() if found and (found[-1][-1:] not in (b"\n", b"\r") or found[-1].endswith(b"\r")) else b""
        if self.inside and found:
            self.inside = False
            del found[0]
        return found

    def open_line(self) -> bytes:
        """What is there of a line that isn't ended yet."""
        if self.inside:
            return b""
        return self.held


def _text(line: bytes) -> str:
    return line.removesuffix(b"\n").removesuffix(b"\r").decode("utf-8", "replace")


def whole_file(path: str) -> Iterator[str]:
    """Lines of a file, plain or gzipped, one after the other."""
    read, lines, gzipped = _reader(path), _Lines(None), path.endswith(".gz")
    decoder, at = Z.Inflater(None), 0
    decoder.state = "header"
    while data := read(at, Z.PIECE):
        at += len(data)
        for piece in decoder.feed(data) if gzipped else [data]:
            if isinstance(piece, bytes):
                yield from map(_text, lines.feed(piece))
    if gzipped and at and (decoder.state != "header" or decoder.rest.strip(b"\0")):
        raise EOFError(f"{path}: ends inside a member")
    if lines.open_line():
        yield _text(lines.open_line())


def _before(read, row: dict) -> int | None:
    if not row["stretch"]:
        return None
    return row["window"][-1] if row["gzipped"] else read(row["start_bit"] // 8 - 1, 1)[0]


# ------------------------------------------------------------ index


def _starts(batches):
    for batch in batches:
        rows, bits = batch.to_pylist(), []
        for r in rows:
            read = _reader(r["file"])
            if not r["gzipped"]:
                bits.append(8 * r["begin"])
            elif r["begin"] == 0:
                end, n = None, 1 << 10
                while end is None:
                    head = read(0, n)
                    end = Z.header_end(head)
                    if end is None and len(head) < n:
                        raise ValueError(f"{r['file']}: ends inside its header")
                    n *= 8
                bits.append(8 * end)
            else:
                bits.append(Z.find_block(read, r["begin"], min(r["size"], r["begin"] + r["wide"]), r["size"]))
        yield pa.RecordBatch.from_arrays([batch.column(c) for c in ("file", "file_no", "size", "gzipped", "stretch")] + [pa.array(bits, pa.int64())], ["file", "file_no", "size", "gzipped", "stretch", "start_bit"])


_MAP = "known binary, place binary"


def _packed(rows: list[tuple], names: list[str], maps: list[tuple[np.ndarray, np.ndarray]]) -> pa.Table:
    columns = {n: [r[i] for r in rows] for i, n in enumerate(names)}
    return pa.table(columns | {"known": [m[0].tobytes() for m in maps], "place": [m[1].tobytes() for m in maps]}, pa.schema([*((n, pa.int32()) for n in names), ("known", pa.binary()), ("place", pa.binary())]))


def _unpacked(known: bytes, place: bytes) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(known, np.uint8), np.frombuffer(place, np.int32)


def _maps(batches):
    for batch in batches:
        for r in batch.select(["file", "file_no", "stretch", "start_bit", "end_bit"]).to_pylist():
            known = Z.last_window(_reader(r["file"]), r["start_bit"], r["end_bit"])
            yield from _packed([(r["file_no"], r["stretch"], r["stretch"] // BLOCK)], ["file_no", "stretch", "block"], [known]).to_batches()


def _in_order(table: pa.Table, by: str):
    for r in table.sort_by(by).to_pylist():
        yield r, _unpacked(r["known"], r["place"])


def _fold(table: pa.Table) -> pa.Table:
    """The window after a block of stretches, by the one before it."""
    whole, row = Z.NOTHING, None
    for row, part in _in_order(table, "stretch"):
        whole = part if whole is Z.NOTHING else Z.composed(whole, part)
    return _packed([(row["file_no"], row["block"])], ["file_no", "block"], [whole])


def _carry(table: pa.Table) -> pa.Table:
    """The window before each block of a file."""
    window, rows, maps = Z.NOTHING, [], []
    for r, part in _in_order(table, "block"):
        rows.append((r["file_no"], r["block"]))
        maps.append(window)
        window = Z.composed(window, part)
    return _packed(rows, ["file_no", "block"], maps)


def _windows(key: tuple, stretches: pa.Table, carried: pa.Table) -> pa.Table:
    """The window before each stretch of a block."""
    window, out = _unpacked(*(carried.column(c)[0].as_py() for c in ("known", "place"))), []
    for r, part in _in_order(stretches, "stretch"):
        out.append((r["file_no"], r["stretch"], window[0].tobytes()))
        window = Z.composed(window, part)
    return pa.table({n: [o[i] for o in out] for i, n in enumerate(("file_no", "stretch", "window"))}, pa.schema([("file_no", pa.int32()), ("stretch", pa.int32()), ("window", pa.binary())]))


_COUNTED = "file_no int, stretch int, n_lines long, parts array<struct<crc:long,length:long,want:long,want_size:long>>"


def _count(batches):
    """Lines that begin in each stretch, and the checksums of its parts of members."""
    for batch in batches:
        for r in batch.to_pylist():
            read = _reader(r["file"])
            lines, n, parts, crc, length = _Lines(_before(read, r)), 0, [], 0, 0
            for piece in _pieces(read, r):
                if isinstance(piece, Z.Member):
                    parts.append({"crc": crc, "length": length, "want": piece.crc, "want_size": piece.size})
                    crc = length = 0
                else:
                    n += len(lines.feed(piece))
                    crc, length = zlib.crc32(piece, crc), length + len(piece)
            if length:
                parts.append({"crc": crc, "length": length, "want": None, "want_size": None})
            n += bool(lines.open_line())
            kind = pa.struct([(c, pa.int64()) for c in ("crc", "length", "want", "want_size")])
            yield pa.RecordBatch.from_arrays([pa.array([r["file_no"]], pa.int32()), pa.array([r["stretch"]], pa.int32()), pa.array([n], pa.int64()), pa.array([parts if r["gzipped"] else []], pa.list_(kind))], ["file_no", "stretch", "n_lines", "parts"])


def _agree(table: pa.Table) -> pa.Table:
    """Files whose checksums don't agree."""
    rows = table.sort_by("stretch").to_pylist()
    good = Z.check_members([(p["crc"], p["length"], p["want"], p["want_size"]) for p in r["parts"]] for r in rows)
    return pa.table({"file_no": [] if good else [rows[0]["file_no"]]}, pa.schema([("file_no", pa.int32())]))


def _tasks(df: DataFrame, *by: str) -> DataFrame:
    """A task for each stretch, as far as there are cores to run them."""
    return df.repartition(max(1, min(df.count(), 4 * df.sparkSession.sparkContext.defaultParallelism)), *by)


def _one_pass(spark: SparkSession, files: DataFrame, folder: str, stretch: int, whole: list[int]) -> DataFrame:
    """Stretches with windows and lines; files whose numbers are in ``whole`` have one."""

    def keep(df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{folder}/{name}")
        return spark.read.schema(df.schema).parquet(f"{folder}/{name}")

    # no window is needed where no gzipped file has a second stretch
    several = files.where(F.col("gzipped") & (F.col("size") > stretch) & ~F.col("file_no").isin(whole)).limit(1).count() > 0
    one = F.col("gzipped") & F.col("file_no").isin(whole) if whole else F.lit(False)
    wide = F.when(one, F.greatest("size", F.lit(1))).otherwise(F.lit(stretch)).cast("long")
    cut = files.withColumn("wide", wide).select("*", F.explode(F.sequence(F.lit(0), F.expr("cast((size - 1) div wide as int)"))).alias("stretch")).withColumn("begin", F.col("stretch") * F.col("wide"))
    cut = cut.where("size > 0")
    starts = keep(_tasks(cut, "file_no", "stretch").mapInArrow(_starts, "file string, file_no int, size long, gzipped boolean, stretch int, start_bit long"), "starts").where("start_bit is not null")
    following = Window.partitionBy("file_no").orderBy("stretch")
    rows = keep(starts.withColumn("end_bit", F.coalesce(F.lead("start_bit").over(following), 8 * F.col("size"))).withColumn("last", F.lead("stretch").over(following).isNull()).drop("size"), "stretches")
    if not several:
        rows = rows.withColumn("window", F.lit(None).cast("binary"))
        return rows.join(keep(_tasks(rows, "file_no", "stretch").mapInArrow(_count, _COUNTED), "counted"), ["file_no", "stretch"])
    zipped = rows.where("gzipped")
    maps = keep(_tasks(zipped, "file_no", "stretch").mapInArrow(_maps, f"file_no int, stretch int, block int, {_MAP}"), "maps")
    blocks = maps.groupBy("file_no", "block").applyInArrow(_fold, f"file_no int, block int, {_MAP}")
    carried = keep(blocks.groupBy("file_no").applyInArrow(_carry, f"file_no int, block int, {_MAP}"), "carried")
    windows = maps.groupBy("file_no", "block").cogroup(carried.groupBy("file_no", "block")).applyInArrow(_windows, "file_no int, stretch int, window binary")
    rows = keep(rows.join(windows, ["file_no", "stretch"], "left"), "windows")
    counted = keep(_tasks(rows, "file_no", "stretch").mapInArrow(_count, _COUNTED), "counted")
    return rows.join(counted, ["file_no", "stretch"])


def build_index(spark: SparkSession, path: str, folder: str, stretch: int = STRETCH) -> DataFrame:
    """Write the index of the files that ``path`` names to ``folder``; returns it (:data:`INDEX`)."""
    listed = list_files(spark, path)
    rows = [(name, i, size, name.endswith(".gz")) for i, (name, size) in enumerate(listed)]
    files = spark.createDataFrame(rows, "file string, file_no int, size long, gzipped boolean")
    whole: list[int] = []
    while True:
        found = _one_pass(spark, files, f"{folder}/work", stretch, whole)
        wrong = [r["file_no"] for r in found.where("gzipped").select("file_no", "stretch", "parts").groupBy("file_no").applyInArrow(_agree, "file_no int").collect()]
        if not wrong:
            break
        if set(wrong) & set(whole):
            raise ValueError(f"checksums don't agree: {[listed[i][0] for i in wrong]}")
        whole = sorted({*whole, *wrong})
    # prefix sums in two levels: the lines of a file, then those of files before it
    per_file = found.groupBy("file_no").agg(F.sum("n_lines").alias("file_lines"))
    before = Window.orderBy("file_no").rowsBetween(Window.unboundedPreceding, -1)  # one row a file
    per_file = per_file.select("file_no", F.coalesce(F.sum("file_lines").over(before), F.lit(0)).alias("file_first"))
    inside = Window.partitionBy("file_no").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    numbered = found.withColumn("inside", F.coalesce(F.sum("n_lines").over(inside), F.lit(0))).join(per_file, "file_no")
    names = [c.split()[0] for c in INDEX.split(", ")]
    numbered.withColumn("first_line", F.col("file_first") + F.col("inside")).select(*names).write.mode("overwrite").option("parquet.block.size", GROUP).parquet(f"{folder}/index")
    for name in ("starts", "stretches", "maps", "carried", "windows", "counted"):
        at = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/work/{name}")
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
    return spark.read.schema(INDEX).parquet(f"{folder}/index")


# ------------------------------------------------------------ data source


def _index_row(f, place: int) -> dict:
    """A row of a file of the index, without the groups of rows before and after its own."""
    table = pq.ParquetFile(f)
    for group in range(table.num_row_groups):
        n = table.metadata.row_group(group).num_rows
        if place < n:
            return table.read_row_group(group).slice(place, 1).to_pylist()[0]
        place -= n
    raise IndexError(place)


class Stretch(InputPartition):
    """A row of the index, by its file of the table and place there; the window is read by the task."""

    def __init__(self, part: str, row: int, first_line: int):
        self.part, self.row, self.first_line = part, row, first_line


class _LinesReader(DataSourceReader):
    def __init__(self, folder: str, first_line: int):
        self.folder, self.first_line = folder, first_line

    def partitions(self) -> list[Stretch]:
        fs, at = filesystem(f"{self.folder}/index")
        import pyarrow.fs as pafs

        found = []
        for info in fs.get_file_info(pafs.FileSelector(at)):
            if info.path.endswith(".parquet"):
                with fs.open_input_file(info.path) as f:
                    table = pq.read_table(f, columns=["first_line", "n_lines"])
                found += [(a, info.path, k, n) for k, (a, n) in enumerate(zip(table["first_line"].to_pylist(), table["n_lines"].to_pylist()))]
        kept = [Stretch(part, k, a) for a, part, k, n in sorted(found) if n and a + n > self.first_line]
        return kept or [Stretch("", 0, 0)]

    def read(self, partition: Stretch) -> Iterator[pa.RecordBatch]:
        if not partition.part:
            return
        fs, _ = filesystem(f"{self.folder}/index")
        with fs.open_input_file(partition.part) as f:
            row = _index_row(f, partition.row)
        read = _reader(row["file"])
        lines, number, left = _Lines(_before(read, row)), row["first_line"], row["n_lines"]

        def batches(found: list[bytes]):
            nonlocal number, left
            found = found[:left]
            for i in range(0, len(found), 4096):
                some = found[i : i + 4096]
                numbers = range(number + i, number + i + len(some))
                skip = max(0, self.first_line - numbers[0])
                if skip < len(some):
                    values = list(map(_text, some[skip:]))
                    yield pa.RecordBatch.from_arrays([pa.array(numbers[skip:], pa.int64()), pa.array(values, pa.string())], ["line_no", "value"])
            number, left = number + len(found), left - len(found)

        # the last line may end in a later stretch
        for piece in _pieces(read, row, beyond=not row["last"]):
            if isinstance(piece, bytes):
                yield from batches(lines.feed(piece))
            if not left or piece is None and lines.held.endswith(b"\r"):
                break
        if left:
            yield from batches([lines.open_line()])


class NumberedLines(DataSource):
    """``index``: the folder of :func:`build_index`; ``firstLine``: lines before it are left out."""

    @classmethod
    def name(cls) -> str:
        return "numbered_lines"

    def schema(self) -> str:
        return "line_no long, value string"

    def reader(self, schema) -> DataSourceReader:
        return _LinesReader(self.options["index"], int(self.options.get("firstline", self.options.get("firstLine", 0))))


def read_numbered(spark: SparkSession, folder: str, first_line: int = 0) -> DataFrame:
    """line_no, value over the index in ``folder``, from a line on."""
    spark.dataSource.register(NumberedLines)
    return spark.read.format("numbered_lines").option("index", folder).option("firstLine", first_line).load()

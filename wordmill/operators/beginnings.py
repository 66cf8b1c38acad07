"""Texts that begin with other texts of their group, found in sorted order: all that begin with a text follow it at once.

Rows are dealt over ranges and sorted, which is the only time that texts are shuffled; what goes on is each one's length and what it has in
common with the one before. A stack of these numbers holds the beginnings that are open. A range starts with those that earlier ranges
leave open, which are told by one row a range.
"""

from __future__ import annotations

import os

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .lineage import Scratch

#: Pairs that a task gathers before it hands them on.
_PAIRS = 1 << 16
#: Characters by which texts are dealt over ranges, and rows, and characters of these rows, that may have the same ones and be sorted by one task.
HEAD, HEAD_ROWS, HEAD_CHARS = 64, 1 << 16, 1 << 25
_AT = ["range_no", "range_place"]


def beginnings(texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(pairs, members) of ``texts`` (group, text, key, whole_length): members are (group, key, class, length, whole_length), where rows of equal
    group and text have one class, and pairs (base, extended) are the classes whose texts the texts of other classes begin with. A
    class is paired with itself if one of its rows has a whole_length above its length. Texts aren't empty and no column is null."""
    work = Scratch(texts.sparkSession, "beginnings")
    kind = texts.schema["key"].dataType.simpleString()
    sorted_ = _sorted(texts.select("group", "text", "key", "whole_length"), work)
    schema = f"group string, key {kind}, length int, common int, whole_length int, range_no int, range_place long, border string"
    steps = work.keep(sorted_.mapInArrow(_steps, schema), "steps")
    # one row a range: its first text and its last, and what the first has in common with the last of the range before
    ends = steps.where("border is not null").groupBy("range_no").agg(*[f(F.struct("group", F.col("border").alias("text")), "range_place").alias(n) for f, n in ((F.min_by, "first"), (F.max_by, "last"))])
    ends = ends.withColumn("before", F.lag("last").over(Window.orderBy("range_no")))
    met = work.keep(ends.select("range_no", F.col("before.group").alias("g"), F.col("before.text").alias("t"), F.col("first.group").alias("group"), F.col("first.text").alias("text")).mapInArrow(_met, "range_no int, met int"), "met")
    rows = steps.where("length is not null").drop("border").join(met, "range_no").withColumn("common", F.coalesce("common", "met")).drop("met")
    left = work.keep(_by_range(rows.select("length", "common", *_AT)).mapInArrow(_left_open, "range_no int, outlasts int, lengths array<int>, classes array<long>"), "left")
    carried = left.coalesce(1).sortWithinPartitions("range_no").mapInArrow(_carry, "range_no int, lengths array<int>, classes array<long>")
    opened = carried.select("range_no", F.posexplode(F.arrays_zip("lengths", "classes")).alias("at", "open"))
    opened = opened.select("range_no", (F.col("at").cast("long") - (1 << 40)).alias("range_place"), F.col("open.lengths").alias("length"), F.col("open.classes").alias("class"))
    found = _by_range(rows.withColumn("class", F.lit(None).cast("long")).unionByName(opened, allowMissingColumns=True))
    found = work.keep(found.mapInArrow(_paired, f"group string, key {kind}, class long, length int, whole_length int, base long, extended long"), "found")
    return found.where("base is not null").select("base", "extended").distinct(), found.where("base is null").select("group", "key", "class", "length", "whole_length")


def _sorted(texts: DataFrame, work: Scratch) -> DataFrame:
    """Rows in ranges of (group, text, key), sorted. Spark samples what it deals by and brings that to the driver, so that's the first characters;
    only texts whose first characters very many rows or very long ones have, by count, are dealt by all of them and their key, as copies are."""
    head = texts.withColumn("head", F.left("text", F.lit(HEAD)))
    counts = head.groupBy("group", "head").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).alias("chars")).where((F.col("n") > HEAD_ROWS) | (F.col("chars") > HEAD_CHARS))
    common = work.keep(counts.select("group", "head", F.lit(True).alias("is_common")), "heads")
    if common.isEmpty():
        dealt = head.repartitionByRange("group", "head")
    else:
        told = head.join(common, ["group", "head"], "left")
        dealt = told.repartitionByRange(F.col("group"), F.col("head"), F.when(F.col("is_common"), F.col("text")), F.when(F.col("is_common"), F.col("key")))
    return dealt.select(*texts.columns).sortWithinPartitions("group", "text", "key")


def _by_range(rows: DataFrame) -> DataFrame:
    """A task for each range, in order of place."""
    n = rows.agg(F.max("range_no")).first()[0]
    return rows.repartitionById((n or 0) + 1, "range_no").sortWithinPartitions(*_AT)


def _class(range_no: int, place: int) -> int:
    """A class is named by the place of its first row."""
    return range_no << 33 | place


def _steps(batches):
    """Each text's length and what it has in common with the one before (null for a range's first; -1 where a group begins); the texts themselves
    only of the first row, and of the last one in a row of its own without a length."""
    at, place, group, text, schema = TaskContext.get().partitionId(), 0, None, None, None
    names = ["group", "key", "length", "common", "whole_length", "range_no", "range_place", "border"]
    for batch in batches:
        n = len(batch)
        if not n:
            continue
        lengths, common, border = [], [], [None] * n
        for i, (g, t) in enumerate(zip(batch["group"].to_pylist(), batch["text"].to_pylist())):
            if text is None:
                common.append(None)
                border[i] = t
            else:
                common.append(len(os.path.commonprefix((text, t))) if g == group else -1)
            lengths.append(len(t))
            group, text = g, t
        columns = [batch["group"], batch["key"], pa.array(lengths, pa.int32()), pa.array(common, pa.int32()), batch["whole_length"], pa.array([at] * n, pa.int32()), pa.array(range(place, place + n), pa.int64()), pa.array(border, pa.string())]
        out = pa.RecordBatch.from_arrays(columns, names)
        schema, place = out.schema, place + n
        yield out
    if schema is not None:
        last = {"group": group, "range_no": at, "range_place": place, "border": text}
        yield pa.RecordBatch.from_arrays([pa.array([last.get(f.name)], f.type) for f in schema], schema=schema)


def _met(batches):
    for batch in batches:
        both = zip(*(batch[c].to_pylist() for c in ("g", "t", "group", "text")))
        met = [len(os.path.commonprefix((t, text))) if g == group and t is not None else -1 for g, t, group, text in both]
        yield pa.RecordBatch.from_arrays([batch["range_no"], pa.array(met, pa.int32())], ["range_no", "met"])


def _step(stack: list[tuple[int, int]], length: int, common: int, name: int) -> bool:
    """Close what the text doesn't begin with and open the text itself, unless the one before was the same; is it new?"""
    while stack and stack[-1][0] > common:
        stack.pop()
    if stack and stack[-1][0] == length:
        return False
    stack.append((length, name))
    return True


def _left_open(batches):
    """A row a range: the beginnings that its last text leaves open, and the least that a text has in common with the one before."""
    at, outlasts, stack = None, None, []

    def row():
        columns = [pa.array([at], pa.int32()), pa.array([outlasts], pa.int32()), pa.array([[n for n, _ in stack]], pa.list_(pa.int32())), pa.array([[c for _, c in stack]], pa.list_(pa.int64()))]
        return pa.RecordBatch.from_arrays(columns, ["range_no", "outlasts", "lengths", "classes"])

    for batch in batches:
        for no, place, length, common in zip(*(batch[c].to_pylist() for c in (*_AT, "length", "common"))):
            if no != at:
                if at is not None:
                    yield row()
                at, outlasts, stack = no, common, []
            outlasts = min(outlasts, common)
            _step(stack, length, common, _class(no, place))
    if at is not None:
        yield row()


def _carry(batches):
    """What each range finds open, by ranges in their order: of what the range before found, all that its texts have in common outlasts it, and what
    it leaves open of its own comes on top. A text that a range found open and has again isn't opened twice: the first class of its length counts."""
    found: list[tuple[int, int]] = []
    for batch in batches:
        opened = []
        for no, outlasts, lengths, classes in zip(*(batch[c].to_pylist() for c in ("range_no", "outlasts", "lengths", "classes"))):
            opened.append((no, found))
            found = [(n, c) for n, c in found if n <= outlasts]
            known = {n for n, _ in found}  # open texts are beginnings of one text, so equal lengths are equal texts
            found = sorted(found + [(n, c) for n, c in zip(lengths, classes) if n not in known])
        columns = [pa.array([no for no, _ in opened], pa.int32()), pa.array([[n for n, _ in f] for _, f in opened], pa.list_(pa.int32())), pa.array([[c for _, c in f] for _, f in opened], pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, ["range_no", "lengths", "classes"])


def _paired(batches):
    """Rows with their class, and rows of pairs (base, extended) that have nothing else."""
    at, stack, own = None, [], None
    names = ["group", "key", "class", "length", "whole_length", "base", "extended"]
    for batch in batches:
        keep, classes, pairs = [], [], []
        kinds = {"group": pa.string(), "key": batch["key"].type, "length": pa.int32(), "whole_length": pa.int32()}

        def told(pairs=pairs, kinds=kinds):
            columns = [pa.nulls(len(pairs), kinds.get(c, pa.int64())) for c in names[:5]]
            return pa.RecordBatch.from_arrays([*columns, pa.array([b for b, _ in pairs], pa.int64()), pa.array([e for _, e in pairs], pa.int64())], names)

        for no, place, length, common, whole, name in zip(*(batch[c].to_pylist() for c in (*_AT, "length", "common", "whole_length", "class"))):
            if no != at:
                at, stack, own = no, [], None
            keep.append(place >= 0)
            if place < 0:
                stack.append((length, name))
                classes.append(None)
                continue
            if _step(stack, length, common, _class(no, place)):
                pairs += [(base, stack[-1][1]) for _, base in stack[:-1]]
            this = stack[-1][1]
            classes.append(this)
            if whole > length and own != this:
                pairs.append((this, this))
                own = this
            if len(pairs) >= _PAIRS:
                yield told()
                pairs.clear()
        none = pa.nulls(len(batch), pa.int64())
        columns = [batch["group"], batch["key"], pa.array(classes, pa.int64()), batch["length"], batch["whole_length"], none, none]
        yield pa.RecordBatch.from_arrays(columns, names).filter(pa.array(keep, pa.bool_()))
        if pairs:
            yield told()

"""Rows next to equal ones in a global sort, whatever the size of a run."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.llm.common import small_batches, store
from ledgerloom.llm.spread import salts

FLAGS = [T.StructField("alike", T.BooleanType()), T.StructField("same", T.BooleanType()), T.StructField("head", T.BooleanType())]
PLACE = [T.StructField("part", T.IntegerType()), T.StructField("place", T.IntegerType())]
FIRST, LAST = 1, 2


def marked(df: DataFrame, outer: list[str], inner: list[str], tie: list[str], name: str) -> DataFrame:
    """The rows of ``df`` (no nulls in the sort columns) that share their ``outer`` columns with another row, with

    ``same``   another row has the same ``outer`` and ``inner`` columns;
    ``head``   it is the first of these.

    The rows are sorted over the cluster by outer, inner and ``tie`` columns, so a run of equal rows may go
    over many partitions and none of them is larger for it; every row is compared with its neighbours.  The
    first and last rows of the partitions, at most two each, are compared on the driver.  The result is stored.
    """
    small_batches(df.sparkSession)
    columns, spark = df.columns, df.sparkSession
    at1, at2 = [columns.index(c) for c in outer], [columns.index(c) for c in inner]
    schema = T.StructType([*df.schema.fields, *FLAGS, *PLACE])
    names = schema.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        # The row that waits for its successor, whether it equals its predecessor, and whether it has one.
        last, before, begun = None, (False, False), False

        def out(rows: pa.Table, left1: list, left2: list, right1: list, right2: list, ends: bool) -> pa.RecordBatch | None:
            nonlocal begun
            n = rows.num_rows
            place = [0] * n
            if not begun:
                place[0] += FIRST
                begun = True
            if ends:
                place[-1] += LAST
            alike = [x or y for x, y in zip(left1, right1)]
            keep = [i for i in range(n) if alike[i] or place[i]]
            if not keep:
                return None
            take = lambda x: [x[i] for i in keep]
            table = rows.take(pa.array(keep)).combine_chunks()
            extra = [pa.array(take(alike)), pa.array(take([x or y for x, y in zip(left2, right2)])), pa.array([not left2[i] for i in keep]),
                     pa.array([part] * len(keep), pa.int32()), pa.array(take(place), pa.int32())]
            arrays = [c.chunk(0) if c.num_chunks else pa.array([], c.type) for c in table.columns]
            return pa.RecordBatch.from_arrays([*arrays, *extra], names=names)

        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch])
            if last is not None:
                rows = pa.concat_tables([last, rows])
            n = rows.num_rows
            if n > 1:
                equal = lambda at: [pc.equal(rows.column(i).slice(0, n - 1), rows.column(i).slice(1)) for i in at]
                merged = equal(at1)
                step1 = merged[0]
                for x in merged[1:]:
                    step1 = pc.and_(step1, x)
                step2 = step1
                for x in equal(at2):
                    step2 = pc.and_(step2, x)
                step1, step2 = step1.to_pylist(), step2.to_pylist()
                done = out(rows.slice(0, n - 1), [before[0], *step1[:-1]], [before[1], *step2[:-1]], step1, step2, False)
                if done is not None:
                    yield done
                before = (step1[-1], step2[-1])
            last = rows.slice(n - 1)
        if last is not None:
            yield out(last, [before[0]], [before[1]], [False], [False], True)

    order = [*outer, *inner, *tie]
    sorted_rows = df.repartitionByRange(salts(df), *order).sortWithinPartitions(*order)
    rows = store(sorted_rows.mapInArrow(run, schema), name)
    edges = rows.filter("place > 0").select("part", "place", "alike", "same", "head", *outer, *inner).orderBy("part", "place").collect()
    # Partition numbers ascend in the order of the sort; place ascends from the first row to the last.
    patches: dict[tuple[int, int], list] = {(e.part, e.place): [e.alike, e.same, e.head] for e in edges}
    for a, b in zip(edges, edges[1:]):
        if a.part == b.part:
            continue
        if all(a[c] == b[c] for c in outer):
            patches[a.part, a.place][0] = patches[b.part, b.place][0] = True
            if all(a[c] == b[c] for c in inner):
                patches[a.part, a.place][1] = patches[b.part, b.place][1] = True
                patches[b.part, b.place][2] = False
    fixed = spark.createDataFrame([(*k, *v) for k, v in patches.items()], "part int, place int, alike2 boolean, same2 boolean, head2 boolean")
    # At most two rows per partition of the sort.
    both = rows.join(F.broadcast(fixed), ["part", "place"], "left")
    flags = {c: F.coalesce(f"{c}2", c) for c in ("alike", "same", "head")}
    return both.select(*columns, *[x.alias(c) for c, x in flags.items()]).filter("alike").drop("alike")

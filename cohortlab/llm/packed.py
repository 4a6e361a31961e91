"""Find values that several nodes have, shuffling packed arrays instead of rows.

Signature tables are many times longer than the documents.  Each task sorts its
batch's ``(value, node, tag)`` by value range and sends one row of packed arrays
per range; the receiving task sees every value of its range and passes on those
that two or more different nodes have.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from pyspark.sql import DataFrame

SCHEMA = "part int, value binary, node binary, tag binary"
SHARED = "bucket long, node long, tag int, cost long"
_u = np.uint64


def deal(value: np.ndarray, node: np.ndarray, tag: np.ndarray, parts: int, short: bool = False) -> pa.RecordBatch:
    """One batch's rows; ``value`` uint64, ``node`` int64, ``tag`` uint8.
    ``short`` sends half of each value: within a range a few different values
    then meet, which is for callers that verify what meets."""
    part = ((value >> _u(32)) * _u(parts) >> _u(32)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    value, node, tag, part = value[order], node[order], tag[order], part[order]
    if short:
        value = value.astype(np.uint32)
    edges = np.searchsorted(part, np.arange(parts + 1))
    keep = [(p, edges[p], edges[p + 1]) for p in range(parts) if edges[p] < edges[p + 1]]
    return pa.RecordBatch.from_arrays(
        [pa.array([p for p, _, _ in keep], pa.int32())]
        + [pa.array([x[a:z].tobytes() for _, a, z in keep], pa.binary()) for x in (value, node, tag)],
        names=["part", "value", "node", "tag"])


def _repeated(v: np.ndarray) -> np.ndarray:
    """Places, ascending, of the values that occur twice or more: most do not,
    and need no sort by node."""
    order = np.argsort(v)
    same = v[order[1:]] == v[order[:-1]]
    several = np.zeros(len(v), bool)
    several[order[1:][same]] = True
    several[order[:-1][same]] = True
    return np.flatnonzero(several)


def _gather(batches):
    got = [[], [], []]
    for b in batches:
        for i, dtype in ((2, np.int64), (3, np.uint8)):
            got[i - 1] += [np.frombuffer(x.as_py(), dtype) for x in b.column(i)]
        for part, x, node in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), got[1][len(got[0]):]):
            got[0].append(np.frombuffer(x, np.uint64) if len(x) == 8 * len(node)
                          else np.frombuffer(x, np.uint32).astype(np.uint64) | _u(part << 32))
    if not got[0]:
        return
    v, node, tag = (np.concatenate(x) for x in got)
    got.clear()
    pick = _repeated(v)
    v, node, tag = v[pick], node[pick], tag[pick]
    if not len(v):
        return
    order = np.lexsort((node, v))
    v, node, tag = v[order], node[order], tag[order]
    fresh = np.concatenate(([True], (v[1:] != v[:-1]) | (node[1:] != node[:-1])))
    v, node, tag = v[fresh], node[fresh], tag[fresh]
    first = np.flatnonzero(np.concatenate(([True], v[1:] != v[:-1])))
    count = np.diff(np.concatenate((first, [len(v)])))
    cost = np.repeat(count, count)
    many = np.flatnonzero(cost > 1)
    for at in range(0, len(many), 1 << 16):
        pick = many[at:at + (1 << 16)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(v[pick].view(np.int64)), pa.array(node[pick]), pa.array(tag[pick].astype(np.int32)),
             pa.array(cost[pick].astype(np.int64))], names=["bucket", "node", "tag", "cost"])


def shared(dealt: DataFrame, partitions: int) -> DataFrame:
    """``bucket, node, tag, cost``: values of two or more nodes, with their number."""
    return dealt.repartition(partitions, "part").mapInArrow(_gather, SHARED)

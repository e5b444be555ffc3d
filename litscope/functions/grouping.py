"""Group the terms of each document, inside its row."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

POSTINGS = T.ArrayType(
    T.StructType(
        [
            T.StructField("term", T.StringType()),
            T.StructField("tf", T.IntegerType()),
            T.StructField("positions", T.ArrayType(T.IntegerType())),
        ]
    )
)

# Terms grouped at once: what a worker holds beside its batch does not grow with the batch.
AT_ONCE = 500_000


@F.arrow_udf(POSTINGS)
def group_terms(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """array<struct<term, pos>> -> one (term, tf, positions) per distinct term.

    A document's own terms never need a shuffle; sorting their dictionary codes
    groups many documents of an Arrow batch at once.
    """
    for documents in batches:
        ends = documents.offsets.to_numpy()
        start = 0
        while start < len(documents):
            # At least one document, else as many as have up to ``AT_ONCE`` terms.
            stop = int(np.searchsorted(ends, int(ends[start]) + AT_ONCE, side="right")) - 1
            stop = min(max(start + 1, stop), len(documents))
            yield _grouped(documents[start:stop])
            start = stop


def _grouped(documents: pa.Array) -> pa.Array:
    sizes = np.diff(documents.offsets.to_numpy())
    flat = documents.flatten()
    coded = flat.field("term").dictionary_encode()
    codes = coded.indices.to_numpy().astype(np.int64)
    positions = flat.field("pos").to_numpy()
    row = np.repeat(np.arange(len(documents), dtype=np.int64), sizes)

    group = row * max(1, len(coded.dictionary)) + codes
    order = np.argsort(group, kind="stable")
    starts = np.flatnonzero(np.diff(group[order], prepend=-1))
    bounds = np.append(starts, len(order)).astype(np.int32)
    heads = order[starts]
    structs = pa.StructArray.from_arrays(
        [
            coded.dictionary.take(pa.array(codes[heads])),
            pa.array(np.diff(bounds), pa.int32()),
            pa.ListArray.from_arrays(pa.array(bounds), pa.array(positions[order], pa.int32())),
        ],
        fields=[pa.field(f.name, t) for f, t in zip(POSTINGS.elementType.fields, (pa.string(), pa.int32(), pa.list_(pa.int32())))],
    )
    per_row = np.bincount(row[heads], minlength=len(documents))
    offsets = np.append(0, np.cumsum(per_row)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), structs)

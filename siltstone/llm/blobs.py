"""Arrays packed into binary columns, and Arrow batches gathered to a useful size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa

_codec = pa.Codec("zstd", compression_level=1)


def packed(array: np.ndarray) -> bytes:
    """An integer array in as few bytes as its largest value needs, high and low bytes apart, compressed."""
    top = int(array.max()) if len(array) else 0
    width = next(k for k in (1, 2, 4, 8) if top < 1 << 8 * k)
    planes = np.ascontiguousarray(array.astype(f"<u{width}").view(np.uint8).reshape(-1, width).T)
    return bytes([width]) + planes.size.to_bytes(8, "little") + _codec.compress(planes, asbytes=True)


def unpacked(data: bytes) -> np.ndarray:
    width, size = data[0], int.from_bytes(data[1:9], "little")
    raw = _codec.decompress(data[9:], decompressed_size=size, asbytes=True) if size else b""
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(width, -1).T).view(f"<u{width}").ravel()


def squeezed(data: bytes) -> bytes:
    """Bytes compressed, their length first."""
    return len(data).to_bytes(8, "little") + _codec.compress(data, asbytes=True)


def loosened(data: bytes) -> np.ndarray:
    size = int.from_bytes(data[:8], "little")
    return np.frombuffer(_codec.decompress(data[8:], decompressed_size=size, asbytes=True) if size else b"", np.uint8)


def low_bytes(values: np.ndarray, width: int) -> bytes:
    """The low ``width`` bytes of 64-bit values."""
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def from_low_bytes(data: bytes, width: int) -> np.ndarray:
    wide = np.zeros((len(data) // width, 8), np.uint8)
    wide[:, :width] = np.frombuffer(data, np.uint8).reshape(-1, width)
    return wide.view("<u8").ravel()


def packed_ids(ids: pa.Array) -> bytes:
    """A nullable integer column."""
    with pa.BufferOutputStream() as sink:
        with pa.ipc.new_stream(sink, pa.schema([("id", pa.int64())])) as writer:
            writer.write_batch(pa.RecordBatch.from_arrays([ids], ["id"]))
        return sink.getvalue().to_pybytes()


def unpacked_ids(data: bytes) -> pd.Series:
    column = pa.ipc.open_stream(data).read_all().column(0)
    return pd.Series(column.to_pylist(), dtype="Int64")


def joined(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    """Arrow batches gathered to some megabytes of text."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= limit:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, size = [], 0
    if held and sum(b.num_rows for b in held):
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def by_shard(own: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Every shard that occurs in ``own``, with its places in order."""
    order = np.argsort(own, kind="stable")
    begins = np.flatnonzero(np.diff(own[order], prepend=-1))
    for low, high in zip(begins, np.append(begins[1:], len(order))):
        yield int(own[order[low]]), order[low:high]

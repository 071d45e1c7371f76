"""Task-side NumPy helpers: dense blocks to bytes and back.

A block holds numbers, booleans, times (epoch integers of a unit) or text. Text is
an object array in memory; stored, it is the byte length of each value as a
little-endian int32, then all values as UTF-8.
"""

import zlib

import numpy as np
import pyarrow as pa

TEXT = "str"


def held_as(dtype: str) -> np.dtype:
    """NumPy dtype of a block of ``dtype`` in memory."""
    return np.dtype(object) if dtype == TEXT else np.dtype(dtype)


def _byte_shuffle(raw: bytes, item: int) -> bytes:
    return np.frombuffer(raw, np.uint8).reshape(-1, item).T.tobytes()


def _byte_unshuffle(raw: bytes, item: int) -> bytes:
    return np.frombuffer(raw, np.uint8).reshape(item, -1).T.tobytes()


def compress(raw: bytes, codec: str, level: int) -> bytes:
    if codec == "zlib":
        return zlib.compress(raw, level)
    if codec == "zstd":
        return pa.Codec("zstd", compression_level=level).compress(raw, asbytes=True)
    if codec == "none":
        return raw
    raise ValueError(f"unknown codec {codec}")


def decompress(payload: bytes, codec: str, size: int) -> bytes:
    if codec == "zlib":
        return zlib.decompress(payload)
    if codec == "zstd":
        return pa.Codec("zstd").decompress(payload, size, asbytes=True)
    if codec == "none":
        return payload
    raise ValueError(f"unknown codec {codec}")


def text_bytes(values) -> tuple[bytes, bytes]:
    """Lengths and content of text values."""
    parts = [v.encode("utf-8", "surrogatepass") for v in values]
    return np.array([len(p) for p in parts], "<i4").tobytes(), b"".join(parts)


def texts_of(raw, count: int) -> np.ndarray:
    """Text values from their lengths, followed by their content."""
    lengths = np.frombuffer(raw, "<i4", count)
    content = memoryview(raw)[4 * count :]
    ends = np.cumsum(lengths).tolist()
    out = np.empty(count, object)
    for k, (end, length) in enumerate(zip(ends, lengths.tolist())):
        out[k] = str(content[end - length : end], "utf-8", "surrogatepass")
    return out


def raw_size(block: np.ndarray) -> int:
    """Bytes of a block before compression."""
    if block.dtype == object:
        return sum(len(part) for part in text_bytes(block.reshape(-1)))
    return block.nbytes


def encode(block: np.ndarray, codec: str, level: int, shuffle: bool) -> bytes:
    if block.dtype == object:
        lengths, content = text_bytes(block.reshape(-1))
        raw = (_byte_shuffle(lengths, 4) if shuffle else lengths) + content
    else:
        raw = np.ascontiguousarray(block).tobytes()
        if shuffle:
            raw = _byte_shuffle(raw, block.dtype.itemsize)
    return compress(raw, codec, level)


def decode(
    payload: bytes, dtype: str, codec: str, shuffle: bool, count: int, size: int | None = None
) -> np.ndarray:
    """Values of a block, flat. ``size``, its bytes before compression, is needed
    for text."""
    if dtype == TEXT:
        raw = bytes(decompress(payload, codec, size))
        if shuffle:
            raw = _byte_unshuffle(raw[: 4 * count], 4) + raw[4 * count :]
        return texts_of(raw, count)
    item = np.dtype(dtype).itemsize
    raw = decompress(payload, codec, count * item)
    if shuffle:
        raw = _byte_unshuffle(raw, item)
    return np.frombuffer(raw, dtype)


def encode_valid(valid: np.ndarray) -> bytes | None:
    """Which positions of a block are present, as compressed bits; nothing when
    all of them are."""
    if valid.all():
        return None
    return zlib.compress(np.packbits(valid).tobytes(), 6)


def decode_valid(bits: bytes | None, count: int) -> np.ndarray:
    if bits is None:
        return np.ones(count, bool)
    return np.unpackbits(np.frombuffer(zlib.decompress(bits), np.uint8), count=count).view(bool)


def zone(values: np.ndarray) -> tuple[float | None, float | None, int | None]:
    """Smallest and largest of the present values, as doubles that never lie
    inside the true range, and how many are NaN or no time. Text has none of it."""
    if values.dtype == object:
        return None, None, None
    tests = {"M": np.isnat, "f": np.isnan}
    n_gone = 0
    if values.dtype.kind in tests:
        gone = tests[values.dtype.kind](values)
        if n_gone := int(np.count_nonzero(gone)):
            values = values[~gone]
    if not len(values):
        return None, None, n_gone
    low, high = values.min(), values.max()
    if values.dtype.kind == "M":
        low, high = low.astype(np.int64), high.astype(np.int64)
    ends = []
    for value, to in ((low, -np.inf), (high, np.inf)):
        exact = value.item()
        end = float(exact)
        if end != exact or isinstance(exact, int) and abs(exact) > 1 << 53:
            end = float(np.nextafter(end, to))  # whole numbers a double rounds
        ends.append(end)
    return *ends, n_gone


def equals_fill(block: np.ndarray, fill) -> np.ndarray:
    if block.dtype.kind == "M":
        return np.isnat(block) if np.isnat(fill) else block == fill
    if fill != fill:
        return np.isnan(block) if block.dtype.kind == "f" else np.zeros(block.shape, bool)
    if block.dtype == object:
        return (block == fill).astype(bool)
    return block == np.asarray(fill, block.dtype)


def convert(values: np.ndarray, dtype: str) -> np.ndarray:
    """Values as ``dtype``. A number that an integer dtype cannot hold is an error,
    and so is a finite one that would become infinite, or one that is neither 0
    nor 1 for a boolean."""
    target = held_as(dtype)
    if values.dtype == target or not values.size:
        return values.astype(target, copy=False)
    if values.dtype == object or target == object or "M" in (values.dtype.kind, target.kind):
        if values.dtype.kind == "M" and target.kind == "M":
            return values.astype(target)
        raise ValueError(f"{values.dtype} values are no {dtype}")
    if target.kind in "iu":
        limits = np.iinfo(target)
        low, high = values.min(), values.max()
        if not (low >= limits.min and high <= limits.max):
            raise ValueError(f"value out of range for {dtype}")
    if target.kind == "b" and not np.isin(values, (0, 1)).all():
        raise ValueError(f"value out of range for {dtype}")
    if target.kind == "f" and values.dtype.kind == "f" and target.itemsize < values.itemsize:
        with np.errstate(over="ignore"):
            out = values.astype(target)
        if (np.isinf(out) & np.isfinite(values)).any():
            raise ValueError(f"value out of range for {dtype}")
        return out
    return values.astype(target, copy=False)


def scatter(box, inside, dtype: str, fill, pieces) -> tuple[np.ndarray, np.ndarray, int]:
    """Dense array of a box, clipped to ``inside``, from pieces of ``(positions,
    values, valid)``; where it has values; and how many positions were named. A
    position given twice or beyond the clip is an error. ``valid`` is None when all
    values of a piece are there; null ones leave the fill."""
    dense = np.full(int(np.prod(box)), fill, held_as(dtype))
    seen = np.zeros(dense.size, bool)
    valid = seen if all(ok is None for _, _, ok in pieces) else np.zeros(dense.size, bool)
    cells = 0
    for pos, values, ok in pieces:
        seen[pos] = True
        cells += len(pos)
        if ok is not None:
            pos, values = pos[ok], values[ok]
        dense[pos] = convert(values, dtype)
        valid[pos] = True
    if np.count_nonzero(seen) != cells:
        raise ValueError("duplicate cells")
    if np.count_nonzero(seen.reshape(box)[inside]) != cells:
        raise ValueError("cells beyond the size of the array")
    return dense.reshape(box)[inside], valid.reshape(box)[inside], cells


def runs(owner: np.ndarray, cell: np.ndarray, box_elements: int) -> tuple[np.ndarray, np.ndarray]:
    """Row order that sorts cells within each owner, and where each box starts."""
    span = int(cell.max()) + 1
    if int(owner.max()) * span < 2**62:
        key = owner * span + cell
        ordered = (key[1:] >= key[:-1]).all()
        order = np.arange(len(key)) if ordered else np.argsort(key)
    else:
        order = np.lexsort((cell, owner))
    box, owner = cell[order] // box_elements, owner[order]
    starts = np.ones(len(order), bool)
    starts[1:] = (box[1:] != box[:-1]) | (owner[1:] != owner[:-1])
    return order, np.flatnonzero(starts)

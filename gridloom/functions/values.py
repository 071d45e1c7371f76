"""Value expressions: decoding packed numbers, typed fill values, sizes."""

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

from gridloom.model import ITEM_SIZES

# Short dtype names, and what they stand for.
_ALIASES = {"int": "int64", "float": "float64"}
_FLOATS = {"float32": "float", "float64": "double"}
_WHOLE = {f"{sign}int{bits}": bits for sign in ("", "u") for bits in (8, 16, 32, 64)}


def nan() -> Column:
    return F.lit(float("nan"))


def cf_decode(raw: Column, fill, scale: float, offset: float, decode: bool = True) -> Column:
    """Packed integer to float: mask the fill first, then scale and shift."""
    if not decode:
        return raw
    return F.when(raw == F.lit(fill), nan()).otherwise(raw * F.lit(scale) + F.lit(offset))


def _whole(value, target: np.dtype):
    if isinstance(value, bool):
        raise TypeError(f"{value} is no whole number")
    limits = np.iinfo(target)
    try:  # text such as 9223372036854775807 must not go through a double
        number = int(value)
        exact = isinstance(value, str) or number == value
    except (ValueError, OverflowError):
        number, exact = None, False
    if number is None and isinstance(value, str) and float(value).is_integer():
        number, exact = int(float(value)), True
    if not exact:
        raise ValueError(f"{value} is no whole number")
    if not limits.min <= number <= limits.max:
        raise OverflowError(f"{value} does not fit {target}")
    return target.type(number)


def _real(value, target: np.dtype):
    given = float(value)
    with np.errstate(over="ignore"):
        held = target.type(given)
    if np.isinf(held) and not np.isinf(given):
        raise OverflowError(f"{value} does not fit {target}")
    return held


def _text(value, target: np.dtype):
    if not isinstance(value, str):
        raise TypeError(f"only text can fill a text variable, not {value!r}")
    return value


def _flag(value, target: np.dtype):
    known = {"true": True, "1": True, "false": False, "0": False}
    text = str(value).lower()
    if text not in known or isinstance(value, float):
        raise ValueError(f"{value!r} is neither true nor false")
    return np.bool_(known[text])


def _moment(value, target: np.dtype):
    """ISO text, a date or time of Python or NumPy, or NaT, which NaN stands for."""
    if isinstance(value, float) and value != value or str(value).lower() in ("nan", "nat"):
        value = "NaT"
    if isinstance(value, (int, float)):
        raise TypeError(f"{value!r} is no time")
    held = np.datetime64(value)
    unit = np.datetime_data(target)[0]
    if not np.isnat(held) and held.astype(target).astype(held.dtype) != held:
        raise ValueError(f"{value} is no whole number of {unit}")
    return held.astype(target)


# What a fill becomes, by NumPy's letter for the family of the dtype.
_FILLS = {
    "f": _real,
    "i": _whole,
    "u": _whole,
    "b": _flag,
    "M": _moment,
    "U": _text,
    "S": _text,
    "O": _text,
}


def resolve_fill(value, dtype: str):
    """Fill value of a contract in its dtype. A fill the dtype cannot hold, such
    as NaN or a fraction for whole numbers, or a number beyond its range, is an
    error, and so is a dtype without a rule."""
    target = np.dtype(_ALIASES.get(dtype, dtype))
    if target.kind not in _FILLS:
        raise ValueError(f"no rule for a fill of {dtype}")
    return _FILLS[target.kind](value, target)


def _whole_column(text: Column, bits: int, signed: bool) -> Column:
    """Text as a whole number of a range; unsigned 64 bits need a decimal."""
    low, high = (-(1 << bits - 1), (1 << bits - 1) - 1) if signed else (0, (1 << bits) - 1)
    given, wide = text.try_cast("decimal(38,10)"), "decimal(38,10)"
    inside = given.between(F.lit(str(low)).cast(wide), F.lit(str(high)).cast(wide))
    held = "bigint" if signed or bits < 64 else "decimal(20,0)"
    kind = {8: "tinyint", 16: "smallint", 32: "int"}.get(bits, held) if signed else held
    wrong = F.raise_error(F.concat(text, F.lit(f" is no whole number of {bits} bits")))
    return F.when((given == F.floor(given)) & inside, given.cast(kind)).when(
        text.isNotNull(), wrong.cast(kind)
    )


def resolve_fill_column(text: Column, dtype: str, is_text: Column | None = None) -> Column:
    """The same rules on a column of contract text; a null stays null.

    ``is_text`` marks values that were text in the contract; anything else is
    refused for a string dtype instead of being turned into text. Unsigned whole
    numbers come as bigint, of 64 bits as decimal(20, 0).
    """
    dtype = _ALIASES.get(dtype, dtype)
    if dtype == "str":
        if is_text is None:
            return text
        return F.when(is_text, text).otherwise(
            F.raise_error(F.lit("fill for str must be text"))
        )
    if dtype in _WHOLE:
        return _whole_column(text, _WHOLE[dtype], not dtype.startswith("u"))
    wrong = F.concat(F.lit(f"{dtype} cannot be "), text)
    if dtype in _FLOATS:
        kind = _FLOATS[dtype]
        given = text.try_cast("double")
        held = given.cast(kind)
        lost = F.abs(held) == F.lit(float("inf")).cast(kind)
        lost = given.isNull() | (lost & (F.abs(given) < F.lit(float("inf"))))
        return F.when(text.isNull(), None).when(lost, F.raise_error(wrong).cast(kind)).otherwise(held)
    if dtype == "bool":
        low = F.lower(text)
        known = F.when(low.isin("true", "1"), True).when(low.isin("false", "0"), False)
        return F.when(text.isNull(), None).otherwise(F.coalesce(known, F.raise_error(wrong).cast("boolean")))
    if dtype in ("datetime64[us]", "datetime64[D]"):
        kind = "date" if dtype.endswith("[D]") else "timestamp_ntz"
        held = F.coalesce(text.try_cast(kind), F.raise_error(wrong).cast(kind))
        return F.when(text.isNull() | F.lower(text).isin("nan", "nat"), None).otherwise(held)
    raise ValueError(f"no rule for a fill of {dtype}")


def item_size(dtype: Column) -> Column:
    """Bytes per element; an unknown dtype fails the query."""
    sizes = F.create_map(*[F.lit(x) for kv in ITEM_SIZES.items() for x in kv])
    return F.coalesce(
        F.try_element_at(sizes, dtype).cast("bigint"),
        F.raise_error(F.concat(F.lit("unknown dtype "), dtype)).cast("bigint"),
    )


def element_count(lengths: Column) -> Column:
    return F.aggregate(lengths, F.lit(1).cast("bigint"), lambda a, n: a * n)

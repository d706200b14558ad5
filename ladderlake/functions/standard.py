"""Standard functions and function blocks of control programs as column expressions and windows.

SIGNATURES has every name by family with the least and most arguments (None: no bound). `call` gives a function's column;
conversions are named X_TO_Y. The blocks with a memory run over events in order: `blocks` adds their outputs as windows, a key's
events being one instance's calls.
"""

from __future__ import annotations

import functools
import operator

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Names and numbers of arguments.
SIGNATURES = {
    "numeric": {"ABS": (1, 1), "SQRT": (1, 1), "LN": (1, 1), "LOG": (1, 1), "EXP": (1, 1), "SIN": (1, 1), "COS": (1, 1), "TAN": (1, 1), "ASIN": (1, 1), "ACOS": (1, 1), "ATAN": (1, 1)},
    "arithmetic": {"ADD": (2, None), "MUL": (2, None), "SUB": (2, 2), "DIV": (2, 2), "MOD": (2, 2), "EXPT": (2, 2), "MOVE": (1, 1)},
    "bit": {"SHL": (2, 2), "SHR": (2, 2), "ROR": (2, 2), "ROL": (2, 2), "AND": (2, None), "OR": (2, None), "XOR": (2, None), "NOT": (1, 1)},
    "selection": {"SEL": (3, 3), "MAX": (2, None), "MIN": (2, None), "LIMIT": (3, 3), "MUX": (3, None)},
    "comparison": {"GT": (2, None), "GE": (2, None), "EQ": (2, None), "LT": (2, None), "LE": (2, None), "NE": (2, 2)},
    "string": {"LEN": (1, 1), "LEFT": (2, 2), "RIGHT": (2, 2), "MID": (3, 3), "CONCAT": (2, None), "INSERT": (3, 3), "DELETE": (3, 3), "REPLACE": (4, 4), "FIND": (2, 2)},
    "time": {"ADD_TIME": (2, 2), "SUB_TIME": (2, 2), "MULTIME": (2, 2), "DIVTIME": (2, 2), "ADD_DT_TIME": (2, 2), "SUB_DT_TIME": (2, 2), "SUB_DT_DT": (2, 2), "SUB_DATE_DATE": (2, 2), "CONCAT_DATE_TOD": (2, 2)},
    "blocks": {"R_TRIG": (1, 1), "F_TRIG": (1, 1), "SR": (2, 2), "RS": (2, 2), "CTU": (3, 3), "CTD": (3, 3), "CTUD": (5, 5), "TP": (2, 2), "TON": (2, 2), "TOF": (2, 2)},
}
#: Types of values as Spark has them; unsigned ones have room in the next signed one.
TYPES = {
    "BOOL": "boolean", "SINT": "tinyint", "INT": "smallint", "DINT": "int", "LINT": "bigint", "USINT": "smallint", "UINT": "int", "UDINT": "bigint", "ULINT": "decimal(20,0)",
    "BYTE": "smallint", "WORD": "int", "DWORD": "bigint", "REAL": "float", "LREAL": "double", "STRING": "string", "DATE": "date", "DT": "timestamp",
}
_WHOLE = {"SINT", "INT", "DINT", "LINT", "USINT", "UINT", "UDINT", "ULINT", "BYTE", "WORD", "DWORD"}
_REAL = {"REAL", "LREAL"}


def signatures() -> dict[str, tuple[int, int | None]]:
    """Every name, the conversions among them."""
    out = {name: n for family in SIGNATURES.values() for name, n in family.items()}
    return out | {f"{a}_TO_{b}": (1, 1) for a in TYPES for b in TYPES if a != b} | {f"{a}_TRUNC_{b}": (1, 1) for a in sorted(_REAL) for b in sorted(_WHOLE)} | {"TRUNC": (1, 1)}


def convert(x: Column, source: str, target: str) -> Column:
    """X_TO_Y: null where the value has no place in the target. Reals are rounded to the nearest whole number, halves to the even one."""
    if source in _REAL and target in _WHOLE:
        x = F.rint(x)
    if target == "BOOL" and source in _WHOLE | _REAL:
        return x != 0
    if source == "BOOL" and target in _WHOLE | _REAL:
        x = x.cast("int")
    return x.try_cast(TYPES[target])


def _chain(args: tuple[Column, ...], compare) -> Column:
    """Whether each argument compares to the next."""
    return functools.reduce(operator.and_, (compare(a, b) for a, b in zip(args, args[1:])))


def _rotated(x: Column, n: Column, bits: int) -> Column:
    """x, a word of that many bits, turned left."""
    n = F.pmod(n, F.lit(bits)).cast("int")
    word = x.cast("bigint")
    turn = lambda a, k: F.call_function("shiftleft", a, k)
    return turn(word, n).bitwiseOR(F.call_function("shiftrightunsigned", word, F.lit(bits) - n)).bitwiseAND(F.lit((1 << bits) - 1))


def call(name: str, *args: Column, bits: int = 32, whole: bool = False) -> Column:
    """The column of a standard function. bits: width of the words that are shifted or turned (up to 32); whole: DIV cuts the fraction off."""
    name = name.upper()
    low, high = signatures()[name]
    if len(args) < low or (high is not None and len(args) > high):
        raise ValueError(f"{name} takes {low}{'' if high == low else ' or more' if high is None else f' to {high}'} arguments, not {len(args)}")
    if name in SIGNATURES["blocks"]:
        raise ValueError(f"{name} has a memory: see blocks()")
    a, b, c = (*args, None, None, None)[:3]
    if "_TRUNC_" in name:
        return F.when(a < 0, F.ceil(a)).otherwise(F.floor(a)).try_cast(TYPES[name.split("_TRUNC_")[1]])
    if "_TO_" in name:
        return convert(a, *name.split("_TO_"))
    one = {"ABS": F.abs, "SQRT": F.sqrt, "LN": F.ln, "LOG": F.log10, "EXP": F.exp, "SIN": F.sin, "COS": F.cos, "TAN": F.tan, "ASIN": F.asin, "ACOS": F.acos, "ATAN": F.atan}
    if name in one:
        return one[name](a)
    folds = {"ADD": operator.add, "MUL": operator.mul, "AND": lambda x, y: x.bitwiseAND(y), "OR": lambda x, y: x.bitwiseOR(y), "XOR": lambda x, y: x.bitwiseXOR(y)}
    if name in folds:
        return functools.reduce(folds[name], args)
    compares = {"GT": operator.gt, "GE": operator.ge, "EQ": operator.eq, "LT": operator.lt, "LE": operator.le, "NE": operator.ne}
    if name in compares:
        return _chain(args, compares[name])
    mask = F.lit((1 << bits) - 1)
    more = {
        "TRUNC": lambda: F.when(a < 0, F.ceil(a)).otherwise(F.floor(a)).cast("bigint"),
        "SUB": lambda: a - b,
        "DIV": lambda: F.when(b != 0, F.when((a < 0) != (b < 0), -F.floor(F.abs(a) / F.abs(b))).otherwise(F.floor(F.abs(a) / F.abs(b)))) if whole else F.try_divide(a, b),
        "MOD": lambda: F.when(b == 0, 0).otherwise(a % F.when(b != 0, b)),
        "EXPT": lambda: F.pow(a, b),
        "MOVE": lambda: a,
        "SHL": lambda: F.call_function("shiftleft", a.cast("bigint"), b.cast("int")).bitwiseAND(mask),
        "SHR": lambda: F.call_function("shiftrightunsigned", a.cast("bigint").bitwiseAND(mask), b.cast("int")),
        "ROL": lambda: _rotated(a, b, bits),
        "ROR": lambda: _rotated(a, -b, bits),
        "NOT": lambda: F.bitwise_not(a.cast("bigint")).bitwiseAND(mask),
        "SEL": lambda: F.when(a, c).otherwise(b),
        "MAX": lambda: F.greatest(*args),
        "MIN": lambda: F.least(*args),
        "LIMIT": lambda: F.least(F.greatest(a, b), c),
        "MUX": lambda: F.try_element_at(F.array(*args[1:]), (a + 1).cast("int")),
        "LEN": lambda: F.length(a),
        "LEFT": lambda: F.left(a, b.cast("int")),
        "RIGHT": lambda: F.right(a, b.cast("int")),
        "MID": lambda: a.substr(c.cast("int"), b.cast("int")),
        "CONCAT": lambda: F.concat(*args),
        "INSERT": lambda: F.overlay(a, b, (c + 1).cast("int"), F.lit(0)),
        "DELETE": lambda: F.overlay(a, F.lit(""), c.cast("int"), b.cast("int")),
        "REPLACE": lambda: F.overlay(a, b, args[3].cast("int"), c.cast("int")),
        "FIND": lambda: F.locate(b, a) if isinstance(b, str) else F.position(b, a),
        "ADD_TIME": lambda: a + b,
        "SUB_TIME": lambda: a - b,
        "MULTIME": lambda: a * b,
        "DIVTIME": lambda: F.when(b != 0, a / b),
        "ADD_DT_TIME": lambda: a + b,
        "SUB_DT_TIME": lambda: a - b,
        "SUB_DT_DT": lambda: a - b,
        "SUB_DATE_DATE": lambda: F.make_dt_interval(F.date_diff(a, b)),
        "CONCAT_DATE_TOD": lambda: a.cast("timestamp_ntz") + b,
    }
    return more[name]()


def _edge(signal: Column, w) -> Column:
    """Whether the signal is true and wasn't at the call before; at the first call it counts as having been false."""
    return signal & ~F.lag(signal, 1, False).over(w)


def blocks(df: DataFrame, key: list[str], order: str, name: str, **inputs: Column) -> DataFrame:
    """df with the outputs of a block of this name, whose calls are each key's rows in order.

    R_TRIG, F_TRIG (clk): q. SR (s1, r), RS (s, r1): q1. CTU (cu, r, pv), CTD (cd, ld, pv; pv is one value a key): q, cv.
    TON, TOF (signal; pt, an interval; order is a time): q, et. A key's rows meet in one window.
    """
    w = W.partitionBy(*key).orderBy(order)
    total = w.rowsBetween(W.unboundedPreceding, W.currentRow)
    x = {k: F.coalesce(v, F.lit(False)) if k in ("clk", "s1", "r", "s", "r1", "cu", "cd", "ld", "signal") else v for k, v in inputs.items()}
    if name == "R_TRIG":
        return df.withColumn("q", _edge(x["clk"], w))
    if name == "F_TRIG":
        return df.withColumn("q", _edge(~x["clk"], w))
    if name in ("SR", "RS"):
        told = F.when(x["s1"], True).when(x["r"], False) if name == "SR" else F.when(x["r1"], False).when(x["s"], True)
        return df.withColumn("q1", F.coalesce(F.last(told, ignorenulls=True).over(total), F.lit(False)))
    if name in ("CTU", "CTD"):
        signal, reset = (x["cu"], x["r"]) if name == "CTU" else (x["cd"], x["ld"])
        marked = df.withColumn("_edge", _edge(signal, w) & ~reset).withColumn("_segment", F.sum(reset.cast("long")).over(total))
        n = F.sum(F.col("_edge").cast("long")).over(W.partitionBy(*key, "_segment").orderBy(order))
        up = F.least(n, x["pv"])
        down = F.when(F.col("_segment") > 0, F.greatest(x["pv"] - n, F.lit(0).cast("long"))).otherwise(0)
        cv = (up if name == "CTU" else down).cast("long")
        return marked.withColumn("cv", cv).withColumn("q", F.col("cv") >= x["pv"] if name == "CTU" else F.col("cv") <= 0).drop("_edge", "_segment")
    if name in ("TON", "TOF"):
        runs = x["signal"] if name == "TON" else ~x["signal"]
        began = F.last(F.when(_edge(runs, w), F.col(order)), ignorenulls=True).over(total)
        ran = F.when(runs, F.least(F.col(order) - began, x["pt"])).otherwise(F.expr("INTERVAL '0' SECOND"))
        ever = F.max(x["signal"]).over(total)
        out = df.withColumn("et", ran if name == "TON" else F.when(ever, ran).otherwise(F.expr("INTERVAL '0' SECOND")))
        return out.withColumn("q", runs & (F.col("et") >= x["pt"]) if name == "TON" else ever & (~runs | (F.col("et") < x["pt"])))
    raise ValueError(f"{name} has no window form")

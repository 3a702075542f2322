"""The user's filter language: data-frame query expressions as Columns.

``child_sex in ['F', 'M'] and 3 < age <= 20 & ~name.str.contains('x')``: Python's
expression grammar, read by Python's own parser, with the usual changes of query
expressions: ``&`` and ``|`` bind like ``and`` and ``or``, names in backticks may hold any character,
``@name`` is a value given by the caller, ``column == [..]`` means ``in``.

Missing values follow the data-frame rules, not SQL's: a comparison with a missing value is false,
``!=`` and ``not in`` are true, so every test is either true or false and ``~`` turns one into the other.
NaN counts as missing. Kinds are checked while the expression is translated: text never equals a number, and ordering
the two, an unknown name or method, or a bad pattern raises ``FilterError`` there. What is left cannot
fail on a row, in ANSI mode either: whole-number overflow gives a missing value.

A test that stands outside a negation is left as the plain comparison (in a filter, unknown drops the row
like false does), so that it reaches the scan as a pushed filter.
"""

from __future__ import annotations

import ast
import datetime
import re
from collections.abc import Callable, Mapping
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


class FilterError(ValueError):
    """The expression is not one that this language has, or does not fit the table."""


@dataclass
class Value:
    """``kind``: number, text, bool, date, time, test (a bool in which unknown means false), list, none, or other."""
    kind: str
    col: Column | None = None
    const: Any = None          # of literals, and the items of a list
    whole: bool = False        # a number without a fraction
    literal: bool = False


_KINDS = ((T.BooleanType, "bool"), (T.StringType, "text"), (T.VarcharType, "text"), (T.CharType, "text"), (T.DateType, "date"),
          (T.TimestampType, "time"), (T.TimestampNTZType, "time"), (T.NumericType, "number"), (T.NullType, "none"))
_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)

# The mathematical functions of query expressions, by their names there and in Spark.
_MATH = {"sin": "sin", "cos": "cos", "tan": "tan", "exp": "exp", "log": "log", "expm1": "expm1", "log1p": "log1p", "sqrt": "sqrt",
         "sinh": "sinh", "cosh": "cosh", "tanh": "tanh", "arcsin": "asin", "arccos": "acos", "arctan": "atan", "arcsinh": "asinh",
         "arccosh": "acosh", "arctanh": "atanh", "abs": "abs", "log10": "log10", "floor": "floor", "ceil": "ceil"}

_ORDER = {ast.Lt: "__lt__", ast.LtE: "__le__", ast.Gt: "__gt__", ast.GtE: "__ge__"}
_MIRROR = {"lt": ast.Lt, "le": ast.LtE, "gt": ast.Gt, "ge": ast.GtE, "eq": ast.Eq, "ne": ast.NotEq}

_LEX = re.compile(r"""("(?:\\.|[^"\\])*"|'(?:\\.|[^'\\])*')|`([^`]*)`|@([A-Za-z_]\w*)|([&|])""", re.S)


def translate(df: DataFrame, text: str, given: Mapping[str, Any] | None = None) -> Column:
    """The test that ``text`` stands for, over the columns of ``df``."""
    quoted: list[str] = []

    def lex(m: re.Match) -> str:
        string, name, local, op = m.groups()
        if string is not None:
            return string
        if name is not None:
            quoted.append(name)
            return f" __column_{len(quoted) - 1} "
        if local is not None:
            return f" __given_{local} "
        return " and " if op == "&" else " or "

    try:
        tree = ast.parse(_LEX.sub(lex, text).strip(), mode="eval").body
    except (SyntaxError, ValueError, RecursionError, MemoryError) as e:
        raise FilterError(f"cannot read the filter expression {text!r}: {e}") from e
    return _Reader(df, quoted, given or {}).test(tree)


class _Reader:
    def __init__(self, df: DataFrame, quoted: list[str], given: Mapping[str, Any]):
        self.fields = {f.name: f.dataType for f in df.schema.fields}
        self.spark, self.quoted, self.given = df.sparkSession, quoted, given

    # --- tests ---------------------------------------------------------------------

    def test(self, node: ast.expr) -> Column:
        v = self.value(node)
        if v.kind not in ("test", "bool"):
            raise FilterError(f"{ast.unparse(node)} is not a test")
        return v.col

    def certain(self, v: Value) -> Value:
        """A test as a bool that is never unknown."""
        return Value("bool", F.coalesce(v.col, F.lit(False))) if v.kind == "test" else v

    def compare(self, left: Value, op: ast.cmpop, right: Value) -> Column:
        left, right = self.certain(left), self.certain(right)
        if isinstance(op, (ast.In, ast.NotIn)) or "list" in (left.kind, right.kind) and isinstance(op, (ast.Eq, ast.NotEq)):
            if left.kind == "list" and right.kind != "list":
                left, right = right, left
            found = self.within(left, right)
            return found if isinstance(op, (ast.In, ast.Eq)) else ~F.coalesce(found, F.lit(False))
        if "none" in (left.kind, right.kind):
            if isinstance(op, (ast.Eq, ast.NotEq)):
                return F.lit(isinstance(op, ast.NotEq))
            raise FilterError("a missing value has no order")
        pair = self.alike(left, right)
        if isinstance(op, ast.Eq):
            return pair[0] == pair[1] if pair else F.lit(False)
        if isinstance(op, ast.NotEq):
            if not pair:
                return F.lit(True)
            missing = [v.col.isNull() for v in (left, right) if not v.literal]
            out = pair[0] != pair[1]
            for m in missing:
                out = out | m
            return out
        name = _ORDER.get(type(op))
        if not name:
            raise FilterError(f"no such comparison: {type(op).__name__}")
        if not pair:
            raise FilterError(f"a {left.kind} and a {right.kind} have no order")
        return getattr(pair[0], name)(pair[1])

    def alike(self, a: Value, b: Value) -> tuple[Column, Column] | None:
        """Both as Columns that compare without a cast that can fail; None where no value of one equals one of the other."""
        if {a.kind, b.kind} <= {"number", "bool"}:
            return tuple(v.col.cast("int") if v.kind == "bool" and a.kind != b.kind else v.col for v in (a, b))
        if a.kind == b.kind and a.kind in ("text", "date", "time"):
            return a.col, b.col
        if {a.kind, b.kind} == {"date", "time"}:
            return tuple(v.col.cast("timestamp") for v in (a, b))
        for v, other, turn in ((a, b, False), (b, a, True)):
            if v.kind in ("date", "time") and other.kind == "text" and other.literal:
                at = self.moment(other.const, v.kind)
                return (at, v.col) if turn else (v.col, at)
        if "other" in (a.kind, b.kind):
            raise FilterError("columns of this type cannot be compared")
        if {a.kind, b.kind} & {"date", "time"} and "text" in (a.kind, b.kind):
            raise FilterError("a date can be compared with a date or with its text")
        return None

    @staticmethod
    def moment(text: str, kind: str) -> Column:
        try:
            at = datetime.datetime.fromisoformat(text)
        except ValueError as e:
            raise FilterError(f"{text!r} is no date") from e
        return F.lit(at.date()) if kind == "date" and at.time() == datetime.time() else F.lit(at)

    def within(self, v: Value, items: Value) -> Column:
        if items.kind != "list" or v.kind == "list":
            raise FilterError("'in' needs a list of values on its right")
        if v.kind == "other":
            raise FilterError("columns of this type cannot be compared")
        pairs = [self.alike(v, x) for x in items.const if x.kind != "none"]
        pairs = [p for p in pairs if p]
        out = pairs[0][0].isin(*[p[1] for p in pairs]) if pairs else F.lit(False)
        if any(x.kind == "none" for x in items.const):
            out = F.coalesce(out, F.lit(False)) | v.col.isNull()
        return out

    # --- values --------------------------------------------------------------------

    def value(self, node: ast.expr) -> Value:
        read = getattr(self, "_" + type(node).__name__, None)
        if read is None:
            raise FilterError(f"{ast.unparse(node)} is not part of the filter language")
        return read(node)

    def literal(self, x: Any) -> Value:
        if x is None or x != x:
            return Value("none", F.lit(None), None, literal=True)
        if isinstance(x, bool):
            return Value("bool", F.lit(x), x, literal=True)
        if isinstance(x, int):
            if not -(1 << 63) <= x < 1 << 63:
                raise FilterError(f"{x} is too large")
            return Value("number", F.lit(x), x, whole=True, literal=True)
        if isinstance(x, float):
            return Value("number", F.lit(x), x, literal=True)
        if isinstance(x, str):
            return Value("text", F.lit(x), x, literal=True)
        if isinstance(x, datetime.datetime):
            return Value("time", F.lit(x), x, literal=True)
        if isinstance(x, datetime.date):
            return Value("date", F.lit(x), x, literal=True)
        if isinstance(x, (list, tuple, set, frozenset)):
            return Value("list", const=[self.literal(y) for y in x])
        raise FilterError(f"a value of type {type(x).__name__} cannot be used")

    def _Constant(self, node: ast.Constant) -> Value:
        return self.literal(node.value)

    def _List(self, node) -> Value:
        items = [self.value(x) for x in node.elts]
        if any(not x.literal for x in items):
            raise FilterError("a list holds literal values only")
        return Value("list", const=items)

    _Tuple = _Set = _List

    def _Name(self, node: ast.Name) -> Value:
        name = node.id
        if name.startswith("__given_"):
            name = name[len("__given_"):]
            if name not in self.given:
                raise FilterError(f"no value is given for @{name}")
            return self.literal(self.given[name])
        if name.startswith("__column_"):
            name = self.quoted[int(name[len("__column_"):])]
        if name not in self.fields:
            raise FilterError(f"no column {name!r}")
        kind = next((k for t, k in _KINDS if isinstance(self.fields[name], t)), "other")
        col = F.col("`" + name.replace("`", "``") + "`")
        if isinstance(self.fields[name], (T.FloatType, T.DoubleType)):
            col = F.nanvl(col, F.lit(None).cast("double"))
        return Value(kind, col, whole=isinstance(self.fields[name], _WHOLE))

    def _BoolOp(self, node: ast.BoolOp) -> Value:
        out = self.test(node.values[0])
        for x in node.values[1:]:
            out = out & self.test(x) if isinstance(node.op, ast.And) else out | self.test(x)
        return Value("test", out)

    def _Compare(self, node: ast.Compare) -> Value:
        out, left = None, self.value(node.left)
        for op, x in zip(node.ops, node.comparators):
            right = self.value(x)
            one = self.compare(left, op, right)
            out, left = one if out is None else out & one, right
        return Value("test", out)

    def _UnaryOp(self, node: ast.UnaryOp) -> Value:
        if isinstance(node.op, (ast.Not, ast.Invert)):
            return Value("test", ~F.coalesce(self.test(node.operand), F.lit(False)))
        v = self.value(node.operand)
        if v.kind != "number":
            raise FilterError(f"{ast.unparse(node.operand)} is not a number")
        if isinstance(node.op, ast.UAdd):
            return v
        if v.literal:
            return self.literal(-v.const)
        return Value("number", F.try_subtract(F.lit(0), v.col) if v.whole else -v.col, whole=v.whole)

    def number(self, v: Value, what: str) -> Value:
        if v.kind == "bool":
            return Value("number", v.col.cast("int"), whole=True)
        if v.kind != "number":
            raise FilterError(f"{what} needs numbers")
        return v

    def _BinOp(self, node: ast.BinOp) -> Value:
        a, b = (self.certain(self.value(x)) for x in (node.left, node.right))
        if isinstance(node.op, ast.Add) and a.kind == b.kind == "text":
            return Value("text", F.concat(a.col, b.col))
        a, b = (self.number(v, ast.unparse(node)) for v in (a, b))
        whole = a.whole and b.whole
        x, y = (v.col.cast("bigint" if whole else "double") for v in (a, b))
        if isinstance(node.op, (ast.Add, ast.Sub, ast.Mult)):
            if whole:
                out = {ast.Add: F.try_add, ast.Sub: F.try_subtract, ast.Mult: F.try_multiply}[type(node.op)](x, y)
            else:
                out = x + y if isinstance(node.op, ast.Add) else x - y if isinstance(node.op, ast.Sub) else x * y
            return self.known(out, whole)
        x, y = x.cast("double"), y.cast("double")
        zero = F.when(x > 0, F.lit(float("inf"))).when(x < 0, F.lit(float("-inf")))     # 0 / 0 is missing
        ratio = F.when(y == 0, zero).otherwise(x / F.nullif(y, F.lit(0.0)))
        if isinstance(node.op, ast.Div):
            return self.known(ratio)
        if isinstance(node.op, ast.FloorDiv):
            down = F.when(F.abs(ratio) < 2.0 ** 62, F.floor(ratio).cast("double")).otherwise(ratio)
            return self.known(down)
        if isinstance(node.op, ast.Mod):
            rest = F.try_mod(x, y)
            return self.known(F.when((rest != 0) & ((rest < 0) != (y < 0)), rest + y).otherwise(rest))
        if isinstance(node.op, ast.Pow):
            return self.known(F.pow(x, y))
        raise FilterError(f"{ast.unparse(node)} is not part of the filter language")

    @staticmethod
    def known(col: Column, whole: bool = False) -> Value:
        return Value("number", col if whole else F.nanvl(col.cast("double"), F.lit(None).cast("double")), whole=whole)

    # --- attributes and calls -------------------------------------------------------

    def _Attribute(self, node: ast.Attribute) -> Value:
        """``column.dt.year`` and its like; methods are read in ``_Call``."""
        if isinstance(node.value, ast.Attribute) and node.value.attr == "dt":
            v = self.value(node.value.value)
            if v.kind in ("date", "time") and node.attr in ("year", "month", "day", "hour", "minute", "second"):
                return Value("number", getattr(F, node.attr)(v.col), whole=True)
        raise FilterError(f"{ast.unparse(node)} is not part of the filter language")

    def _Subscript(self, node: ast.Subscript) -> Value:
        """``column.str[i]`` and ``column.str[i:j]``, from the start."""
        if not (isinstance(node.value, ast.Attribute) and node.value.attr == "str"):
            raise FilterError(f"{ast.unparse(node)} is not part of the filter language")
        v = self.text(node.value.value)
        if isinstance(node.slice, ast.Slice):
            at = [None if x is None else self.plain(x, int) for x in (node.slice.lower, node.slice.upper, node.slice.step)]
            low, high = at[0] or 0, at[1]
            if low < 0 or (high is not None and high < 0) or at[2] not in (None, 1):
                raise FilterError("parts of a text are counted from its start")
            return Value("text", F.substring(v, low + 1, (1 << 31) - 1 - low if high is None else max(0, high - low)))
        at = self.plain(node.slice, int)
        if at < 0:
            raise FilterError("parts of a text are counted from its start")
        return Value("text", F.nullif(F.substring(v, at + 1, 1), F.lit("")))

    def text(self, node: ast.expr) -> Column:
        v = self.value(node)
        if v.kind != "text":
            raise FilterError(f"{ast.unparse(node)} is not text")
        return v.col

    def plain(self, node: ast.expr, kind: type | tuple[type, ...]):
        v = self.value(node)
        if not (v.literal and isinstance(v.const, kind)):
            raise FilterError(f"{ast.unparse(node)} must be a literal value")
        return v.const

    def _Call(self, node: ast.Call) -> Value:
        if isinstance(node.func, ast.Name) and node.func.id in _MATH:
            args = self.arguments(node, "x")
            v = self.number(self.certain(self.value(args["x"])), node.func.id)
            out = getattr(F, _MATH[node.func.id])(v.col.cast("double"))
            return self.known(out)
        if not isinstance(node.func, ast.Attribute):
            raise FilterError(f"{ast.unparse(node)} is not part of the filter language")
        name, of = node.func.attr, node.func.value
        if isinstance(of, ast.Attribute) and of.attr == "str":
            return self.text_method(node, name, self.text(of.value))
        v = self.certain(self.value(of))
        if v.kind == "list":
            raise FilterError(f"a list has no {name}")
        if name in ("isnull", "isna", "notnull", "notna"):
            self.arguments(node)
            return Value("test", v.col.isNull() if name.startswith("is") else v.col.isNotNull())
        if name == "isin":
            return Value("test", self.within(v, self.value(self.arguments(node, "values")["values"])))
        if name in _MIRROR:
            return Value("test", self.compare(v, _MIRROR[name](), self.value(self.arguments(node, "other")["other"])))
        if name == "between":
            args = self.arguments(node, "left", "right", inclusive="both")
            side = args["inclusive"] if isinstance(args["inclusive"], str) else self.plain(args["inclusive"], str)
            if side not in ("both", "left", "right", "neither"):
                raise FilterError("inclusive is both, left, right or neither")
            low = self.compare(v, ast.GtE() if side in ("both", "left") else ast.Gt(), self.value(args["left"]))
            return Value("test", low & self.compare(v, ast.LtE() if side in ("both", "right") else ast.Lt(), self.value(args["right"])))
        if name == "abs":
            self.arguments(node)
            n = self.number(v, "abs")
            return Value("number", F.greatest(n.col, F.try_subtract(F.lit(0), n.col)) if n.whole else F.abs(n.col), whole=n.whole)
        if name == "fillna":
            other = self.value(self.arguments(node, "value")["value"])
            pair = self.alike(v, other)
            if not pair or not other.literal:
                raise FilterError("fillna needs a literal value of the column's kind")
            return Value(v.kind, F.coalesce(*pair), whole=v.whole and other.whole)
        raise FilterError(f"no method {name!r}")

    def arguments(self, node: ast.Call, *names: str, **defaults) -> dict[str, Any]:
        """Arguments by name; the ones without a default must be there."""
        order = [*names, *defaults]
        if len(node.args) > len(order) or any(isinstance(x, ast.Starred) for x in node.args) or any(k.arg not in order for k in node.keywords):
            raise FilterError(f"wrong arguments in {ast.unparse(node)}")
        got = {**defaults, **dict(zip(order, node.args)), **{k.arg: k.value for k in node.keywords}}
        if any(n not in got for n in names):
            raise FilterError(f"missing arguments in {ast.unparse(node)}")
        return got

    def pattern(self, text: str) -> str:
        """``text`` as a pattern of the engine, refused here if it is none there."""
        text = re.sub(r"\(\?P<(\w+)>", r"(?<\1>", text)
        text = re.sub(r"\(\?P=(\w+)\)", r"\\k<\1>", text)
        try:
            self.spark._jvm.java.util.regex.Pattern.compile(text)
        except Exception as e:
            raise FilterError(f"{text!r} is no pattern") from e
        return text

    def text_method(self, node: ast.Call, name: str, v: Column) -> Value:
        simple: dict[str, Callable[[Column], Column]] = {
            "lower": F.lower, "upper": F.upper, "len": F.length,
            "strip": lambda c: F.regexp_replace(c, r"^\s+|\s+\z", ""), "lstrip": lambda c: F.regexp_replace(c, r"^\s+", ""),
            "rstrip": lambda c: F.regexp_replace(c, r"\s+\z", "")}
        if name in simple:
            self.arguments(node)
            return Value("number" if name == "len" else "text", simple[name](v), whole=name == "len")
        if name in ("startswith", "endswith"):
            args = self.arguments(node, "pat", na=None)
            ends = self.value(args["pat"])
            ends = [x.const for x in ends.const] if ends.kind == "list" else [ends.const]
            if not all(isinstance(x, str) for x in ends):
                raise FilterError(f"{name} needs text")
            out = F.lit(False)
            for x in ends:
                out = out | getattr(v, name)(x)
            return Value("test", self.missing(out, v, args["na"]))
        if name in ("contains", "match", "fullmatch"):
            args = self.arguments(node, "pat", case=True, flags=0, na=None, **({"regex": True} if name == "contains" else {}))
            case, flags, regex = (args.get(k, True) if not isinstance(args.get(k), ast.expr) else self.plain(args[k], (bool, int))
                                  for k in ("case", "flags", "regex"))
            if flags:
                raise FilterError("flags are written inside the pattern")
            pat = self.plain(args["pat"], str)
            if not regex:
                out = v.contains(pat) if case else F.contains(F.lower(v), F.lower(F.lit(pat)))
            else:
                body = {"contains": pat, "match": rf"\A(?:{pat})", "fullmatch": rf"\A(?:{pat})\z"}[name]
                self.pattern(pat)
                out = v.rlike(self.pattern(body if case else "(?iu)" + body))
            return Value("test", self.missing(out, v, args["na"]))
        raise FilterError(f"no method 'str.{name}'")

    def missing(self, out: Column, v: Column, na) -> Column:
        """``na``: what a missing text gives, false by default."""
        return out | v.isNull() if isinstance(na, ast.expr) and self.value(na).const is True else out

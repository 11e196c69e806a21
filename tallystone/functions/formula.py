"""Formula strings become Spark columns; only arithmetic over known columns is accepted."""

from __future__ import annotations

import ast
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def signed_divide(a: Column, b: Column) -> Column:
    """IEEE division that ANSI mode cannot stop: x/0 is ±Inf, 0/0 is missing."""
    inf = F.lit(float("inf"))
    return F.coalesce(F.try_divide(a, b), F.when(b == 0, F.when(a > 0, inf).when(a < 0, -inf)))


_BINARY = {
    ast.Add: lambda a, b: a + b,
    ast.Sub: lambda a, b: a - b,
    ast.Mult: lambda a, b: a * b,
    ast.Pow: lambda a, b: F.pow(a, b),
}
# a logarithm or root outside its domain is missing
_CALLS = {
    "abs": (1, F.abs),
    "sqrt": (1, lambda a: F.when(a >= 0, F.sqrt(a))),
    "log": (1, lambda a: F.when(a > 0, F.ln(a))),
    "log1p": (1, lambda a: F.when(a > -1, F.log1p(a))),
    "exp": (1, F.exp),
    "min": (2, F.least),
    "max": (2, F.greatest),
}
_COMPARE = {
    ast.Gt: lambda a, b: a > b,
    ast.GtE: lambda a, b: a >= b,
    ast.Lt: lambda a, b: a < b,
    ast.LtE: lambda a, b: a <= b,
    ast.Eq: lambda a, b: a == b,
    ast.NotEq: lambda a, b: a != b,
}


def formula_column(formula: str, columns: Mapping[str, Column]) -> Column:
    """Build the column for ``formula``; names resolve through ``columns`` (already double).

    A quotient by zero is missing, which the caller turns into 0 like any value
    that is not finite. Only inside a comparison does it keep its infinite value.
    """

    def build(node: ast.AST, divide) -> Column:
        match node:
            case ast.Expression(body=body):
                return build(body, divide)
            case ast.Constant(value=int() | float() as v) if not isinstance(v, bool):
                return F.lit(float(v))
            case ast.Name(id=name) if name in columns:
                return columns[name]
            case ast.BinOp(left=a, op=ast.Div(), right=b):
                return divide(build(a, divide), build(b, divide))
            case ast.BinOp(left=a, op=op, right=b) if type(op) in _BINARY:
                return _BINARY[type(op)](build(a, divide), build(b, divide))
            case ast.UnaryOp(op=ast.USub(), operand=a):
                return -build(a, divide)
            case ast.Compare(left=a, ops=[op], comparators=[b]) if type(op) in _COMPARE:
                left, right = build(a, signed_divide), build(b, signed_divide)
                return _COMPARE[type(op)](left, right).cast("double")
            case ast.Call(func=ast.Name(id=name), args=args, keywords=[]) if name in _CALLS:
                least, call = _CALLS[name]
                if len(args) == least or len(args) > least > 1:
                    return call(*[build(a, divide) for a in args])
        raise ValueError(f"not allowed in a formula: {ast.unparse(node)!r}")

    return build(ast.parse(formula, mode="eval"), F.try_divide)

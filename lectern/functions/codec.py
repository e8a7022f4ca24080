"""Verified byte values and text decoding."""

from __future__ import annotations

import base64
import codecs
import hashlib
import json
import re

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

BYTES = "struct<base64:string,encoding:string,sha256:string,size:bigint,utf8:string>"
#: The members of a byte value, of which utf8 need not be there.
MEMBERS = ["base64", "encoding", "sha256", "size", "utf8"]
STRICT = r"^(?:[A-Za-z0-9+/]{4})*(?:[A-Za-z0-9+/]{2}==|[A-Za-z0-9+/]{3}=)?$"


def decoded(value: Column) -> Column:
    """A byte value's bytes; null if its base64 isn't strict."""
    text = value["base64"]
    return F.when(text.rlike(STRICT), F.try_to_binary(text, F.lit("base64")))


def byte_value_rule(value: Column) -> Column:
    """Which rule a byte value breaks, null if none: members, encoding, base64, size, sha256, utf8 (which need not be
    there, but if it is, the bytes are such text and equal it)."""
    data = decoded(value)
    text = F.when(F.is_valid_utf8(data.cast("string")), data.cast("string"))
    return (
        F.when(value.isNull(), "missing")
        .when(value["base64"].isNull() | value["encoding"].isNull() | value["sha256"].isNull() | value["size"].isNull(), "members")
        .when(value["encoding"] != "base64", "encoding")
        .when(data.isNull(), "base64")
        .when(F.length(data) != value["size"], "size")
        .when(F.sha2(data, 256) != value["sha256"], "sha256")
        .when(value["utf8"].isNotNull() & ~value["utf8"].eqNullSafe(text), "utf8")
    )


def unknown_members(json: Column) -> Column:
    """Members of a byte value, as JSON text, beyond those it may have; null if it is no object."""
    return F.array_sort(F.array_except(F.json_object_keys(json), F.array(*[F.lit(m) for m in MEMBERS])))


@F.pandas_udf(T.ArrayType(T.StructType([T.StructField("at", T.StringType()), T.StructField("rule", T.StringType())])))
def envelope_faults(lines: pd.Series) -> pd.Series:
    """Where in a line of JSON a byte value breaks which rule, at any depth: objects with the encoding base64, or with
    all members that must be there. Nothing within a byte value is looked at for its own sake."""

    def broken(x: dict) -> str | None:
        must = set(MEMBERS) - {"utf8"}
        if not must <= x.keys() or x.keys() - set(MEMBERS):
            return "members"
        if x["encoding"] != "base64":
            return "encoding"
        if not isinstance(x["base64"], str) or not re.fullmatch(STRICT[1:-1], x["base64"]):
            return "base64"
        data = base64.b64decode(x["base64"])
        if isinstance(x["size"], bool) or x["size"] != len(data):
            return "size"
        if x["sha256"] != hashlib.sha256(data).hexdigest():
            return "sha256"
        return "utf8" if "utf8" in x and data.decode("utf-8", "surrogateescape") != x["utf8"] else None

    def faults(line: str | None) -> list[dict]:
        try:
            todo, out = [("$", json.loads(line or "null"))], []
        except ValueError:
            return []
        while todo:
            at, x = todo.pop()
            if isinstance(x, dict) and (x.get("encoding") == "base64" or set(MEMBERS) - {"utf8"} <= x.keys()):
                out += [{"at": at, "rule": rule}] if (rule := broken(x)) else []
            elif isinstance(x, dict | list):
                todo += [(f"{at}.{k}" if isinstance(x, dict) else f"{at}[{k}]", v) for k, v in (x.items() if isinstance(x, dict) else enumerate(x))]
        return sorted(out, key=lambda f: f["at"])

    return lines.map(faults)


def utf8(value: Column) -> Column:
    """A byte value as text, null if it isn't UTF-8."""
    data = decoded(value)
    return F.when(F.is_valid_utf8(data.cast("string")), data.cast("string"))


def _odd_byte(e: UnicodeDecodeError) -> tuple[str, int]:
    byte = e.object[e.start : e.start + 1]
    try:
        return byte.decode("cp1252"), e.start + 1
    except UnicodeDecodeError:
        return byte.decode("latin-1"), e.start + 1


def mixed_text(data: bytes) -> str:
    """Valid UTF-8 as it is; each other byte as Windows-1252 has it, else as Latin-1."""
    try:
        return data.decode()
    except UnicodeDecodeError:
        codecs.register_error("lectern-mixed", _odd_byte)
        return data.decode("utf-8", "lectern-mixed")


def _mixed(data: pa.Array) -> pa.Array:
    try:
        return data.cast(pa.string())  # all of a batch at once, where all of it is UTF-8
    except pa.ArrowInvalid:
        return pa.array([None if x is None else mixed_text(x) for x in data.to_pylist()], pa.string())


def mixed_decode(data: Column) -> Column:
    """mixed_text of binary values; Spark's decoders know no Windows-1252."""
    return F.arrow_udf(_mixed, T.StringType())(data.cast("binary"))


def display_text(stripped: Column, raw: Column, rendered: Column, kind: Column, plain) -> Column:  # noqa: ANN001
    """The text to show: stripped if it is UTF-8; else, for marked-up sources, the plain text of raw, then of
    rendered (an empty one ends the search); else stripped with its other bytes mapped one by one. All three are
    binary; plain turns a text column into its plain text. Only what is needed goes to Python."""
    text = lambda b: F.when(F.is_valid_utf8(b.cast("string")), b.cast("string"))
    odd, marked = text(stripped).isNull(), F.lower(kind) == "osis"
    shown = lambda b: plain(F.when(odd & marked, text(b)))
    return F.coalesce(text(stripped), F.when(marked, F.coalesce(shown(raw), shown(rendered))), mixed_decode(F.when(odd, stripped)))


def token_markup(raw: Column, rendered: Column, kind: Column) -> Column:
    """The markup to read tokens from: the first of raw and rendered that is UTF-8 and not empty."""
    text = lambda b: F.nullif(F.when(F.is_valid_utf8(b.cast("string")), b.cast("string")), F.lit(""))
    return F.when(F.lower(kind) == "osis", F.coalesce(text(raw), text(rendered)))

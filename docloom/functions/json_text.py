"""JSON text: canonical artifacts, event fields and stripping of embedded binary."""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from docloom.functions.columns import col
from docloom.schemas import BINARY_KEYS


def canonical_json(**fields: Column) -> Column:
    """Compact JSON object with sorted keys and explicit nulls. Nested structs must be sorted."""
    ordered = [fields[name].alias(name) for name in sorted(fields)]
    return F.to_json(F.struct(*ordered), {"ignoreNullFields": "false"})


def json_scalar(value: Column) -> Column:
    """JSON text of one scalar; null becomes ``null``."""
    wrapped = F.to_json(F.struct(value.alias("v")), {"ignoreNullFields": "false"})
    return F.regexp_extract(wrapped, "(?s)^.{5}(.*).$", 1)


def spaced_json(pairs: list[tuple[str, Column, Column | None]]) -> Column:
    """JSON object text with ``", "`` and ``": "`` separators, members in the given order.

    Each member is (name, value, keep); a member whose ``keep`` is false is left out.
    """
    members = []
    for name, value, keep in pairs:
        member = F.concat(F.lit(json.dumps(name) + ": "), json_scalar(value))
        members.append(member if keep is None else F.when(keep, member))
    return F.concat(F.lit("{"), F.concat_ws(", ", *members), F.lit("}"))


_LONE = re.compile("[\ud800-\udfff]")  # no text holds these unescaped


def _prune(value):
    if isinstance(value, dict):
        return {k: _prune(v) for k, v in value.items() if k.lower() not in BINARY_KEYS}
    if isinstance(value, list):
        return [_prune(v) for v in value]
    return value


def _prune_texts(texts: pd.Series) -> pd.Series:
    def one(text):
        try:
            tree = json.loads(text, parse_constant=lambda _: None)  # JSON has no NaN or infinity
            made = json.dumps(_prune(tree), ensure_ascii=False, separators=(",", ":"))
        except (TypeError, ValueError, RecursionError):
            return None
        return _LONE.sub(lambda m: f"\\u{ord(m[0]):04x}", made)

    return texts.map(one)


def strip_binary(document: str | Column) -> Column:
    """Drop binary-carrying members at any depth of a JSON text; null when it is not JSON, or
    nested too deep to read. NaN and infinity become null, lone surrogates stay escaped.

    The depth is open, so no fixed struct can express it and the work goes to Arrow batches.
    """
    return F.pandas_udf(_prune_texts, "string")(col(document))

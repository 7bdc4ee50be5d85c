"""Content hashes, bundle checksums, deterministic ids and versions."""

from __future__ import annotations

import datetime
import decimal
import hashlib
import json
import math
import re
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from provlake.functions.text import col

URL_NAMESPACE = "6ba7b8119dad11d180b400c04fd430c8"  # fixed value: the UUID namespace of URLs
HASH_FIELD = "content_hash"


def canonical_struct_json(fields: Sequence[str]) -> Column:
    """Compact JSON with sorted keys and nulls; the hash field is left out.  For strings, integers and booleans."""
    return F.to_json(F.struct(*[F.col(f) for f in sorted(fields) if f != HASH_FIELD]), {"ignoreNullFields": "false"})


def content_hash(fields: Sequence[str]) -> Column:
    return F.sha2(canonical_struct_json(fields), 256)


def canonical_json(value: object) -> str:
    """Any JSON-like value: the hash field goes at every depth, keys are sorted, numbers that are no numbers refused."""

    def plain(v: object) -> object:
        if isinstance(v, dict):
            return {str(k): plain(x) for k, x in v.items() if k != HASH_FIELD}
        if isinstance(v, list | tuple):
            return [plain(x) for x in v]
        if isinstance(v, datetime.datetime | datetime.date):
            return v.isoformat()
        if isinstance(v, decimal.Decimal):
            return format(v, "f")
        if isinstance(v, bytes):
            return v.hex()
        if isinstance(v, float) and not math.isfinite(v):
            raise ValueError("not a finite number")
        return v

    return json.dumps(plain(value), ensure_ascii=False, sort_keys=True, separators=(",", ":"), allow_nan=False)


_CANONICAL = json.JSONEncoder(ensure_ascii=False, sort_keys=True, separators=(",", ":"), allow_nan=False)


def _unsealed(v: dict) -> dict:
    v.pop(HASH_FIELD, None)
    return v


def _canonical_pieces(value: dict) -> Iterator[str]:
    """The canonical text of an object in pieces: its fields, and the elements of those that are lists, so a long list is never one text."""
    for i, (k, v) in enumerate(sorted(value.items())):
        yield f"{',' if i else '{'}{_CANONICAL.encode(k)}:"
        if isinstance(v, list) and v:
            for j, x in enumerate(v):
                yield ("," if j else "[") + _CANONICAL.encode(x)
            yield "]"
        else:
            yield _CANONICAL.encode(v)
    yield "}" if value else "{}"


#: Characters from which a text is read value by value.
LONG = 1 << 20
_SPACE = re.compile(r"[ \t\n\r]*")
_DECODER = json.JSONDecoder(object_hook=_unsealed)


def _canonical_fields(text: str) -> dict[str, bytes]:
    """The canonical text of each field of an object, of a list element by element, so that no tree of the whole is built.

    ValueError for text that is no object, and for what may be right still: a field that comes twice, a value that another hides.
    """
    after = lambda i: _SPACE.match(text, i).end()
    encoded = lambda v: _CANONICAL.encode(v).encode()

    def items(i: int, end: str, one: Callable[[int], int]) -> int:
        """Reads what stands between commas from i on with one; the place after the end."""
        i = after(i)
        if text[i : i + 1] == end:
            return i + 1
        while True:
            i = after(one(i))
            if text[i : i + 1] == end:
                return i + 1
            if text[i : i + 1] != ",":
                raise ValueError("neither a comma nor the end")
            i = after(i + 1)

    def value(i: int) -> tuple[object, int]:
        try:
            return _DECODER.raw_decode(text, i)
        except RecursionError as e:
            raise ValueError("too deep") from e

    fields: dict[str, bytes] = {}

    def field(i: int) -> int:
        if text[i : i + 1] != '"':
            raise ValueError("no key")
        key, i = json.decoder.scanstring(text, i + 1, True)
        i = after(i)
        if text[i : i + 1] != ":" or key in fields:
            raise ValueError("no value, or two")
        i = after(i + 1)
        if text[i : i + 1] != "[":
            v, i = value(i)
            fields[key] = encoded(v)
            return i
        out = bytearray(b"[")

        def element(i: int) -> int:
            v, i = value(i)
            out.extend(b"," if len(out) > 1 else b"")
            out.extend(encoded(v))
            return i

        i = items(i + 1, "]", element)
        out.extend(b"]")
        fields[key] = out
        return i

    i = after(0)
    if text[i : i + 1] != "{" or after(items(i + 1, "}", field)) != len(text):
        raise ValueError("no object")
    fields.pop(HASH_FIELD, None)
    return fields


def _open_hash(text: str | None) -> str | None:
    """The hash of one JSON text without the hash fields; null where it is no object."""
    digest = hashlib.sha256()
    if text and len(text) >= LONG:
        try:
            fields = _canonical_fields(text)
            for i, k in enumerate(sorted(fields)):
                digest.update(f"{',' if i else '{'}{_CANONICAL.encode(k)}:".encode())
                digest.update(fields[k])
            digest.update(b"}" if fields else b"{}")
            return digest.hexdigest()
        except ValueError:
            digest = hashlib.sha256()  # read as a whole below
    try:
        value = json.loads(text, object_hook=_unsealed) if text else None
        if not isinstance(value, dict):
            return None
        for piece in _canonical_pieces(value):
            digest.update(piece.encode())
        return digest.hexdigest()
    except ValueError:
        return None


def open_content_hash(payload: str | Column) -> Column:
    """The hash of JSON text of any schema; null where it is no JSON object."""

    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(_open_hash)

    return run(col(payload))


def bundle_checksum(files: DataFrame, keys: Sequence[str], name: str = "name", digest: str = "sha256") -> DataFrame:
    """One SHA-256 for each group: name, NUL, hex digest and a line feed for each file in order of name."""
    nul = F.decode(F.unhex(F.lit("00")), "UTF-8")
    lines = F.transform(F.array_sort(F.collect_list(F.struct(F.col(name).alias("n"), F.col(digest).alias("d")))),
        lambda v: F.concat(v["n"], nul, v["d"], F.lit("\n")))
    return files.groupBy(*keys).agg(F.sha2(F.array_join(lines, ""), 256).alias("bundle_checksum"))


def uuid5(name: str | Column, namespace: str = URL_NAMESPACE) -> Column:
    """The version-5 UUID of a name."""
    h = F.sha1(F.concat(F.unhex(F.lit(namespace)), F.encode(col(name), "UTF-8")))
    digit = F.substring(F.lit("89ab"), F.conv(F.substring(h, 17, 1), 16, 10).cast("int") % 4 + 1, F.lit(1))
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.concat(F.lit("5"), F.substring(h, 14, 3)),
        F.concat(digit, F.substring(h, 18, 3)), F.substring(h, 21, 12))


def artifact_id(run_id: str | Column, logical_name: str | Column, checksum: str | Column) -> Column:
    return uuid5(F.concat_ws(":", col(run_id), col(logical_name), col(checksum)))


def intake_run_id(batch_id: str | Column, digest: str | Column) -> Column:
    return F.concat_ws(":", F.lit("collection-intake"), col(batch_id), F.left(col(digest), F.lit(16)))


def source_record_id(site: str | Column, pid: str | Column, digest: str | Column, short: bool = True) -> Column:
    d = F.left(col(digest), F.lit(12)) if short else col(digest)
    return F.concat_ws(":", col(site), col(pid), F.nullif(d, F.lit("")))


def schema_version(x: str | Column) -> Column:
    """struct(major, minor, patch); missing parts are 0; null where a part is no number."""
    parts = [F.coalesce(F.nullif(F.split_part(col(x), F.lit("."), F.lit(i)), F.lit("")), F.lit("0")).try_cast("int") for i in (1, 2, 3)]
    return F.when(parts[0].isNotNull() & parts[1].isNotNull() & parts[2].isNotNull() & (F.trim(col(x)) != ""),
        F.struct(*[p.alias(n) for p, n in zip(parts, ("major", "minor", "patch"), strict=True)]))


def version_issue(x: str | Column, supported: Sequence[int] = (1,)) -> Column:
    v = schema_version(x)
    return F.when(F.coalesce(F.trim(col(x)), F.lit("")) == "", "MISSING_SCHEMA_VERSION").when(v.isNull(),
        "INVALID_SCHEMA_VERSION").when(~v["major"].isin(*supported), "UNSUPPORTED_SCHEMA_VERSION")


def json_path(parts: Column) -> Column:
    """array of keys and numbers (as text) -> $.a[0].b"""
    return F.concat(F.lit("$"), F.array_join(F.transform(parts,
        lambda p: F.when(p.rlike("^[0-9]+$"), F.concat(F.lit("["), p, F.lit("]"))).otherwise(F.concat(F.lit("."), p))), ""))

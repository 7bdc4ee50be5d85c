"""The contract compiler against a plain validator, over payloads broken in every way."""

import copy
import json
import random
import re

import pytest
from pyspark.sql import functions as F

from provlake.functions.hashing import canonical_json
from provlake.operators import documents, schemas

rnd = random.Random(3)
DOCS = documents.documents("shopx", "office")
KINDS = {"null": type(None), "boolean": bool, "object": dict, "array": list, "string": str}


def is_type(x, t):
    if t in ("number", "integer"):
        return isinstance(x, int | float) and not isinstance(x, bool) and (t == "number" or float(x).is_integer())
    return isinstance(x, KINDS[t])


def equal(a, b):
    if isinstance(a, bool) or isinstance(b, bool):
        return a is b
    return a == b


def plain(schema, x, root, path="$"):
    if "$ref" in schema:
        schema = root["$defs"][schema["$ref"].rsplit("/", 1)[1]]
    out, number = [], is_type(x, "number")
    tests = {
        "type": lambda v: not any(is_type(x, t) for t in (v if isinstance(v, list) else [v])),
        "const": lambda v: not equal(x, v), "enum": lambda v: not any(equal(x, e) for e in v),
        "pattern": lambda v: isinstance(x, str) and not re.search(v, x), "minLength": lambda v: isinstance(x, str) and len(x) < v, "maxLength": lambda v: isinstance(x, str) and len(x) > v,
        "minimum": lambda v: number and x < v, "maximum": lambda v: number and x > v,
        "minItems": lambda v: isinstance(x, list) and len(x) < v, "maxItems": lambda v: isinstance(x, list) and len(x) > v,
    }
    out += [(path, k) for k, broken in tests.items() if k in schema and broken(schema[k])]
    if isinstance(x, dict):
        out += [(path, "required") for r in schema.get("required", []) if r not in x]
        if schema.get("additionalProperties", True) is False and set(x) - set(schema.get("properties", {})):
            out.append((path, "additionalProperties"))
        for k, s in schema.get("properties", {}).items():
            if k in x:
                out += plain(s, x[k], root, f"{path}.{k}")
    if isinstance(x, list) and "items" in schema:
        for i, e in enumerate(x):
            out += plain(schema["items"], e, root, f"{path}[{i}]")
    return out


def example(schema, root):
    """A valid value."""
    if "$ref" in schema:
        schema = root["$defs"][schema["$ref"].rsplit("/", 1)[1]]
    if "const" in schema:
        return schema["const"]
    if "enum" in schema:
        return rnd.choice(schema["enum"])
    kind = schema.get("type", "string")
    kind = rnd.choice(kind) if isinstance(kind, list) else kind
    if kind == "object":
        return {k: example(s, root) for k, s in schema["properties"].items() if k in schema["required"] or rnd.random() < 0.6}
    if kind == "array":
        return [example(schema.get("items", {}), root) for _ in range(rnd.randrange(3))]
    return {"null": None, "string": "a" * 64, "integer": rnd.choice([1, 4.0, 1e3]), "number": rnd.choice([0, 0.5, 1])}[kind]


def places(x):
    yield x
    for v in x.values() if isinstance(x, dict) else x if isinstance(x, list) else ():
        if isinstance(v, dict | list):
            yield from places(v)


def broken(doc):
    x = example(doc, doc)
    for _ in range(rnd.randrange(4)):
        spot = rnd.choice([p for p in places(x) if p] or [x])
        key = rnd.choice(list(spot)) if isinstance(spot, dict) else rnd.randrange(len(spot))
        match rnd.randrange(4):
            case 0 if isinstance(spot, dict):
                del spot[key]
                if not x:
                    return x
            case 1 if isinstance(spot, dict):
                spot[rnd.choice(["shade", "é k", 'q"t'])] = 1
            case _:
                spot[key] = copy.deepcopy(rnd.choice([None, "", "é", 0, -1, -2, -0.5, 1.5, 7.0, 10**20, True, False, [], {}, [None], {"a": 1}, ["x"], "UNKNOWN", "GOLD"]))
    return x


def test_compiled_contracts_equal_the_plain_validator(spark):
    rows, want = [], {}
    nodes = {n: schemas.compile_document(d) for n, d in DOCS.items()}
    for n, d in DOCS.items():
        for _ in range(240):
            x = broken(d)
            want[len(rows)] = sorted(plain(d, x, d))
            rows.append((len(rows), n, json.dumps(x, ensure_ascii=rnd.random() < 0.5)))
    df = spark.createDataFrame(rows, "id int, contract string, payload string").repartition(4)
    df = df.withColumn("v", F.try_parse_json("payload"))
    issues = F.coalesce(*[F.when(F.col("contract") == n, schemas.schema_issues(node, "v")) for n, node in nodes.items()])
    got = {r.id: sorted((i.path, i.keyword) for i in r.issues) for r in df.select("id", issues.alias("issues")).collect()}
    assert got == want
    found = {k for w in want.values() for _, k in w}
    assert found == {"type", "const", "enum", "pattern", "minLength", "minimum", "maximum", "required", "additionalProperties"}
    assert sum(not w for w in want.values()) > 100


def sealed(x):
    import hashlib

    return {**x, "content_hash": hashlib.sha256(canonical_json(x).encode()).hexdigest()}


def test_versions_hashes_and_unknown_contracts(spark):
    d = DOCS["gold_freshness"]
    good = sealed({k: v for k, v in example(d, d).items() if k != "content_hash"})
    cases = {
        "good": (good, []), "hash": ({**good, "product_name": "other"}, [("CHECKSUM_MISMATCH", "$.content_hash")]), "null hash": ({**good, "content_hash": None}, [("SCHEMA_VALIDATION_FAILED", "$.content_hash"), ("CHECKSUM_MISMATCH", "$.content_hash")]),
        "major": (sealed({**good, "schema_version": "2.0.0", "confidence": 7}), [("UNSUPPORTED_SCHEMA_VERSION", "$.schema_version")]),
        "no version": (sealed({k: v for k, v in good.items() if k != "schema_version"}), [("MISSING_SCHEMA_VERSION", "$.schema_version"), ("SCHEMA_VALIDATION_FAILED", "$")]),
        "bad version": (sealed({**good, "schema_version": "x"}), [("INVALID_SCHEMA_VERSION", "$.schema_version"), ("SCHEMA_VALIDATION_FAILED", "$.schema_version")]),
        "number version": (sealed({**good, "schema_version": 1}), [("MISSING_SCHEMA_VERSION", "$.schema_version"), ("SCHEMA_VALIDATION_FAILED", "$.schema_version")]),
        "minor": (sealed({**good, "schema_version": "1.1.0"}), [("SCHEMA_VALIDATION_FAILED", "$.schema_version")]),
    }
    rows = [(k, "gold_freshness", json.dumps(x)) for k, (x, _) in cases.items()] + [("text", "gold_freshness", "nothing"), ("null", "gold_freshness", None), ("list", "gold_freshness", "[1]"), ("who", "nobody", "{}"), ("none", None, "{}")]
    df = spark.createDataFrame(rows, "id string, contract string, payload string")
    got = {r.id: [(i.code, i.path) for i in r.issues] for r in schemas.tag_payloads(df, {"gold_freshness": schemas.compile_document(d)}).collect()}
    invalid = {k: [("INVALID_PAYLOAD", "$")] for k in ("text", "null", "list")} | {k: [("UNKNOWN_CONTRACT", "$")] for k in ("who", "none")}
    assert got == {k: w for k, (_, w) in cases.items()} | invalid


def test_documents_as_files(spark, tmp_path):
    names = documents.write_documents(spark, str(tmp_path), site="shopx", agency="office")
    assert len(names) == 7
    assert schemas.read_documents(spark, str(tmp_path)) == {n: schemas.compile_document(d) for n, d in DOCS.items()}


@pytest.mark.parametrize(
    "bad",
    [
        {"$ref": "#/$defs/a", "$defs": {"a": {"properties": {"x": {"$ref": "#/$defs/a"}}}}}, {"$ref": "#/$defs/none"}, {"$ref": "http://else.where/x"}, {"oneOf": []}, {"type": "text"},
        {"additionalProperties": {"type": "string"}}, {"properties": {"a": 3}},
    ],
)
def test_documents_that_do_not_compile(bad):
    with pytest.raises(schemas.SchemaError):
        schemas.compile_document(bad)


def test_refs_nest_and_escape(spark):
    doc = {"items": {"$ref": "#/$defs/a~1b"}, "$defs": {"a/b": {"items": {"$ref": "#/$defs/n", "minimum": 5}}, "n": {"type": "integer", "minimum": 2, "maxItems": 1}}}
    df = spark.createDataFrame([("[[5, 4, 6.5], 3]",)], "p string")
    issues = schemas.schema_issues(schemas.compile_document(doc), "parse_json(p)")
    assert [(i.path, i.keyword) for i in df.select(issues).first()[0]] == [("$[0][1]", "minimum"), ("$[0][2]", "type")]

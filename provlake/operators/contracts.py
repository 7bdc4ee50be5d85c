"""Row contracts: declarative rules that compile to columns, issues as rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _is(c: Column, kind: str) -> Column:
    """Whether text reads as a value of a JSON type."""
    t = c.cast("string")
    return {"integer": t.rlike("^-?[0-9]+$"), "number": t.rlike(r"^-?[0-9]+(\.[0-9]+)?([eE][-+]?[0-9]+)?$"),
        "boolean": t.isin("true", "false")}.get(kind, F.lit(True))


@dataclass(frozen=True)
class Rule:
    """One field of a contract.  Keywords mean what they mean in JSON Schema; formats are not enforced."""

    name: str
    required: bool = True
    nullable: bool = False
    const: object = None
    enum: Sequence[object] = ()
    pattern: str | None = None
    min_length: int | None = None
    max_bytes: int | None = None
    minimum: float | None = None
    maximum: float | None = None
    type: str | None = None  # of a text column that holds JSON-like values: string, integer, number or boolean
    items: Rule | None = None  # of every element of an array column
    fields: Sequence[Rule] = ()  # of a struct column

    def issues_at(self, c: Column, path: Column) -> list[Column]:
        """Structs (path, code), null where the rule holds, or arrays of them for elements; a rule used by name nests as any other."""
        found = [F.when(broken, F.array(F.struct(path.alias("path"), F.lit(code).alias("code")))) for code, broken in self.checks(c)]
        for f in self.fields:
            found += f.issues_at(c.getField(f.name), F.concat(path, F.lit(f".{f.name}")))
        if self.items is not None:
            none = F.array().cast("array<struct<path:string,code:string>>")
            each = lambda x, i: F.flatten(F.array(*[F.coalesce(y, none)
                for y in self.items.issues_at(x, F.concat(path, F.lit("["), i.cast("string"), F.lit("]")))]))
            found.append(F.flatten(F.transform(c, each)))
        return found

    def checks(self, c: Column | None = None) -> list[tuple[str, Column]]:
        """(code, condition under which the value breaks the rule)."""
        c = F.col(self.name) if c is None else c
        out: list[tuple[str, Column]] = []
        if self.required and not self.nullable:
            out.append(("REQUIRED", c.isNull()))
        for code, broken in (
            ("TYPE", None if self.type is None else c.isNotNull() & ~_is(c, self.type)),
            ("CONST", None if self.const is None else c != F.lit(self.const)),
            ("ENUM", ~c.isin(*self.enum) if self.enum else None),
            ("PATTERN", None if self.pattern is None else ~c.rlike(self.pattern)),
            ("MIN_LENGTH", None if self.min_length is None else F.length(c) < self.min_length),
            ("MAX_BYTES", None if self.max_bytes is None else F.octet_length(c) > self.max_bytes),
            ("MINIMUM", None if self.minimum is None else c < self.minimum),
            ("MAXIMUM", None if self.maximum is None else c > self.maximum),
        ):
            if broken is not None:
                out.append((code, F.coalesce(broken, F.lit(False))))
        return out


@dataclass(frozen=True)
class Contract:
    name: str
    rules: Sequence[Rule]
    closed: bool = True
    across: Mapping[str, Column] = field(default_factory=dict)  # code -> condition that breaks a rule of the whole row

    def issues(self) -> Column:
        """array<struct(path, code)> of a row, in order of path."""
        found = [x for r in self.rules for x in r.issues_at(F.col(r.name), F.lit(f"$.{r.name}"))]
        found += [F.when(F.coalesce(b, F.lit(False)), F.array(F.struct(F.lit("$").alias("path"), F.lit(code).alias("code")))) for code,
            b in self.across.items()]
        none = F.array().cast("array<struct<path:string,code:string>>")
        return F.array_sort(F.flatten(F.array(none, *[F.coalesce(x, none) for x in found])))


def tag(df: DataFrame, contract: Contract, name: str = "issues") -> DataFrame:
    """df with its issues; nothing is dropped.  A closed contract also names columns it does not know."""
    issues = contract.issues()
    if contract.closed:
        unknown = [c for c in df.columns if c not in {r.name for r in contract.rules}]
        if unknown:
            issues = F.concat(issues, F.array(*[F.struct(F.lit(f"$.{c}").alias("path"), F.lit("ADDITIONAL").alias("code")) for c in unknown]))
    return df.withColumn(name, issues)


def issue_rows(df: DataFrame, contract: Contract, keys: Sequence[str]) -> DataFrame:
    """One row for each issue: keys, path, code."""
    return tag(df, contract, "_issues").select(*keys, F.explode("_issues").alias("i")).select(*keys, "i.path", "i.code")


def split(df: DataFrame, contract: Contract) -> tuple[DataFrame, DataFrame]:
    """(valid rows, invalid rows with their issues): from one tagged table, so no row is lost."""
    tagged = tag(df, contract)
    return tagged.where(F.size("issues") == 0).drop("issues"), tagged.where(F.size("issues") > 0)


def meta_rules() -> list[Rule]:
    """The ten fields that all contracts share."""
    text = [Rule(n, min_length=1) for n in ("run_id", "batch_id", "record_id", "source", "source_record_id", "parser_version")]
    return [Rule("schema_version", const="1.0.0"), *text, Rule("source_uri", nullable=True), Rule("content_hash", pattern="^[0-9a-f]{64}$"),
        Rule("created_at", min_length=1)]


# Enums of the normalized, reconciled and published rows.
STORAGE = ("ROOM", "REFRIGERATED", "FROZEN", "UNKNOWN")
UNITS = ("HOUR", "DAY", "WEEK", "MONTH", "YEAR")
BASES = ("MANUFACTURE", "PACKAGING", "RECEIPT", "UNKNOWN")
REVIEW = ("AUTO_APPROVED", "REVIEW_REQUIRED", "REJECTED")

REGISTRY = {
    "submitted_product": Contract("submitted_product",
        [*meta_rules(), Rule("original_product_id", min_length=1), Rule("product_name_raw", min_length=1), Rule("product_url", min_length=1)], closed=False),
    "normalized_freshness": Contract("normalized_freshness",
        [*meta_rules(), Rule("food_name_normalized", min_length=1), Rule("storage_type", enum=STORAGE),
        Rule("expiration_value", nullable=True, minimum=0), Rule("expiration_unit", nullable=True, enum=UNITS),
        Rule("expiration_basis", nullable=True, enum=BASES), Rule("expiration_text", nullable=True)]),
    "gold_freshness": Contract("gold_freshness",
        [Rule("dataset_version", min_length=1), Rule("external_product_id", min_length=1), Rule("product_name", min_length=1),
        Rule("storage_type", enum=STORAGE), Rule("expiration_value", nullable=True, minimum=0), Rule("confidence", minimum=0, maximum=1),
        Rule("review_status", enum=("AUTO_APPROVED", "APPROVED"))]),
}


def contract(name: str) -> Contract:
    if name not in REGISTRY:
        raise KeyError(f"no contract named {name}")
    return REGISTRY[name]

"""Per-source contracts, declared as field rules and evaluated as column expressions.

A contract checks only what the marts depend on. Unknown fields pass; a record that breaks a rule
is set aside with the reasons, never dropped.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelist import fixed_values as fixed
from tidelist.functions.dates import ISO_PATTERN
from tidelist.functions.payload import canonical_json
from tidelist.functions.text import sql_text


@dataclass(frozen=True)
class Field:
    path: str
    kind: str
    required: bool = False
    nullable: bool = True


@dataclass(frozen=True)
class Contract:
    """Where the items are in a response, and what each item must look like."""

    items_path: str
    fields: tuple[Field, ...]


# ---- Fixed values: what each provider must deliver -------------------------------------------
CONTRACTS = {
    "greenhouse": Contract(
        "$.jobs",
        (
            Field("id", "int", required=True, nullable=False),
            Field("title", "title", required=True, nullable=False),
            Field("updated_at", "datetime", required=True, nullable=False),
            Field("absolute_url", "nonempty", required=True, nullable=False),
            Field("location", "object"),
            Field("location.name", "text"),
            Field("content", "text"),
            Field("first_published", "datetime"),
        ),
    ),
    "lever": Contract(
        "$",
        (
            Field("id", "nonempty", required=True, nullable=False),
            Field("text", "title", required=True, nullable=False),
            Field("createdAt", "int", required=True, nullable=False),
            Field("hostedUrl", "nonempty", required=True, nullable=False),
            Field("categories", "object", nullable=False),
            Field("categories.location", "text"),
            Field("categories.commitment", "text"),
            Field("categories.team", "text"),
            Field("categories.department", "text"),
            Field("workplaceType", "text"),
        ),
    ),
    "ashby": Contract(
        "$.jobs",
        (
            Field("id", "nonempty", required=True, nullable=False),
            Field("title", "title", required=True, nullable=False),
            Field("location", "text"),
            Field("publishedAt", "datetime", required=True, nullable=False),
            Field("jobUrl", "nonempty", required=True, nullable=False),
            Field("isListed", "bool", nullable=False),
            Field("isRemote", "bool"),
            Field("workplaceType", "text"),
            Field("employmentType", "text"),
        ),
    ),
}

# Texts and numbers that are read as a boolean.
BOOLEAN_WORDS = ["0", "1", "f", "t", "n", "y", "no", "yes", "off", "on", "false", "true"]


_NUMBERS = "({kind} LIKE 'BIGINT%' OR {kind} LIKE 'DECIMAL%' OR {kind} IN ('DOUBLE', 'FLOAT'))"

# Per kind: (condition of a failing value, message), tried in order. ``kind`` is the variant type
# of a value that is neither missing nor null, ``text`` its value as text.
_KIND_RULES = {
    "int": [
        (
            f"NOT (({_NUMBERS} OR {{kind}} = 'STRING')"
            r" AND {text} RLIKE r'^\s*[+-]?\d+(\.0*)?([eE]\+?\d+)?\s*$' OR {kind} = 'BOOLEAN')",
            "must be an integer",
        )
    ],
    "bool": [
        (
            f"NOT ({{kind}} = 'BOOLEAN' OR ({_NUMBERS} OR {{kind}} = 'STRING')"
            f" AND lower({{text}}) IN ({', '.join(map(sql_text, BOOLEAN_WORDS))}))",
            "must be a boolean",
        )
    ],
    "datetime": [
        (
            f"NOT ({_NUMBERS} OR {{kind}} = 'STRING' AND {{text}} RLIKE {sql_text(ISO_PATTERN)}"
            " AND try_cast(upper(trim({text})) AS timestamp) IS NOT NULL)",
            "must be an ISO-8601 date and time",
        )
    ],
    "object": [("{kind} NOT LIKE 'OBJECT%'", "must be an object")],
    "text": [("{kind} <> 'STRING'", "must be a text")],
}
_KIND_RULES["nonempty"] = [*_KIND_RULES["text"], ("{text} = ''", "must not be empty")]
_KIND_RULES["title"] = [
    *_KIND_RULES["nonempty"],
    (f"translate({{text}}, {sql_text(fixed.BLANKS)}, '') = ''", "must not be blank"),
]


def field_error(field: Field, kind: str, text: str) -> str:
    """SQL for the error of one field, or NULL.

    ``kind`` and ``text`` name the columns with its variant type (NULL where the field is
    missing, VOID where it is null) and its value.
    """
    missing = "field required" if field.required else None
    null = None if field.nullable else "must not be null"
    rules = [
        (f"{kind} IS NULL", missing),
        (f"{kind} = 'VOID'", null),
        *[
            (condition.replace("{kind}", kind).replace("{text}", text), message)
            for condition, message in _KIND_RULES[field.kind]
        ],
    ]
    branches = [
        f"WHEN {condition} THEN "
        + ("NULL" if message is None else sql_text(f"{field.path}: {message}"))
        for condition, message in rules
    ]
    return f"CASE {' '.join(branches)} END"


# Kinds whose check looks at the value, not only at its type.
_VALUE_KINDS = ("int", "bool", "datetime", "nonempty", "title")


def with_item_errors(items: DataFrame) -> DataFrame:
    """Add ``error``: all contract errors of an item as one text, NULL for a valid one.

    Type and text of the n-th field of each contract share a column, and are read from the item
    once; the rules then work on plain strings. The expressions are generated as SQL text, which
    Spark parses at once.
    """
    probes, errors = {"_type": "schema_of_variant(item)"}, []
    for n in range(max(len(c.fields) for c in CONTRACTS.values())):
        kinds, texts, problems = [], [], []
        for name, contract in CONTRACTS.items():
            if n < len(contract.fields):
                field = contract.fields[n]
                here, path = f"WHEN source = {sql_text(name)} THEN", sql_text(f"$.{field.path}")
                value = f"try_variant_get(item, {path}, 'variant')"
                kinds.append(f"{here} schema_of_variant({value})")
                if field.kind in _VALUE_KINDS:
                    texts.append(f"{here} try_variant_get(item, {path}, 'string')")
                problems.append(f"{here} {field_error(field, f'_kind{n}', f'_text{n}')}")
        case = lambda branches: f"CASE {' '.join(branches)} END"
        probes[f"_kind{n}"] = case(kinds)
        probes[f"_text{n}"] = case(texts) if texts else "CAST(NULL AS string)"
        errors.append(case(problems))
    return items.selectExpr("*", *[f"{sql} AS {name}" for name, sql in probes.items()]).selectExpr(
        *items.columns,
        f"""CASE WHEN item_index IS NULL THEN NULL
          WHEN coalesce(_type, '') NOT LIKE 'OBJECT%' THEN '<root>: must be an object'
          ELSE nullif(concat_ws('; ', {', '.join(errors)}), '') END AS error""",
    )


def _by_source(source: Column, build) -> Column:
    chain = None
    for name, contract in CONTRACTS.items():
        chain = (F if chain is None else chain).when(source == name, build(contract))
    return chain


def parse_responses(responses: DataFrame) -> DataFrame:
    """Explode responses into items and judge each item: one JSON parse, no shuffle.

    A response without items (failed request, unusable envelope, empty list) keeps one row with
    ``item_index`` NULL, so that every response is accounted for by a single pass downstream.
    ``response_error`` names an unusable response, whose body is then kept as evidence.
    """
    source = F.col("source")
    decoded = responses.withColumn("document", F.try_parse_json("body"))
    enveloped = decoded.withColumn(
        "list",
        _by_source(
            source, lambda c: F.try_variant_get("document", c.items_path, "array<variant>")
        ),
    )
    failed = (F.col("http_status") < 200) | (F.col("http_status") > 299)
    response_error = (
        F.when(failed, F.concat(F.lit("HTTP "), F.col("http_status").cast("string")))
        .when(
            F.col("document").isNull(), F.concat(source, F.lit(": response is not JSON"))
        )
        .when(F.col("list").isNull(), F.concat(source, F.lit(": unexpected envelope")))
    )
    kept = [c for c in responses.columns if c != "body"]
    exploded = enveloped.withColumn("response_error", response_error).select(
        *kept,
        "response_error",
        F.when(F.col("response_error").isNotNull(), F.col("body")).alias("body"),
        F.posexplode_outer(F.when(F.col("response_error").isNull(), F.col("list"))).alias(
            "item_index", "item"
        ),
    )
    item = F.col("item")
    has_item = F.col("item_index").isNotNull()
    return with_item_errors(exploded).select(
        *kept,
        F.concat("source", F.lit(":"), "board").alias("company_key"),
        "response_error",
        "body",
        "item_index",
        F.try_variant_get(item, "$.id", "string").alias("posting_id"),
        "error",
        F.when(has_item, canonical_json(item)).alias("payload"),
    )


def valid_items(items: DataFrame) -> DataFrame:
    """Items that keep the contract; duplicates within a response stay."""
    return items.where(F.col("item_index").isNotNull() & F.col("error").isNull())


def rejected_items(items: DataFrame) -> DataFrame:
    """Items that break the contract, with the reasons."""
    return items.where(F.col("error").isNotNull())

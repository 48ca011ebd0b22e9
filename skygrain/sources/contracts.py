"""Contract checks: split records into valid ones and a quarantine with the reason."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, functions as F, types as T

from skygrain.sources.schemas import CONTRACTS, DEFAULTED, UNIT_DEFAULTS, nullable

CORRUPT = "_corrupt"
REASON = "reject_reason"
# A JSON parser writes a value that is no text, read as text, as one of these lines: list, object, quoted special number,
# number or boolean. ``[`` also stands for a null in a list of texts.
MAYBE_NO_TEXT = r"(?m)^(?:[\[{\"].*|[-+.0-9eE]+|[-+]?(?:NaN|INF|Infinity)|true|false)$"


def _walk(schema: T.StructType, prefix: str = "", always: bool = True) -> Iterator[tuple[str, T.StructField, bool]]:
    """(path, field, parent is always present)."""
    for f in schema.fields:
        path = f"{prefix}{f.name}"
        yield path, f, always
        if isinstance(f.dataType, T.StructType):
            yield from _walk(f.dataType, f"{path}.", always and not f.nullable)


def required_present(schema: T.StructType, root: str = "", optional: tuple[str, ...] = (), variants: bool = False,
                     given: T.StructType | None = None) -> Column:
    """True when every required field is there: not null wherever its parent record is not null.

    With ``variants`` text fields are still in the form of ``_strict``, where a JSON null is a value. Lists that hold no
    null by ``given``, the type of the rows, are not searched for one.
    """
    ok = F.lit(True)
    full = [p for p, f, _ in _walk(given or T.StructType()) if isinstance(f.dataType, T.ArrayType) and not f.dataType.containsNull]
    for path, field, _ in _walk(schema):
        col = F.col(f"{root}{path}")
        parent = path.rpartition(".")[0]
        here = F.lit(True) if not parent else F.col(f"{root}{parent}").isNotNull()
        present = col.isNotNull()
        if variants and isinstance(field.dataType, T.StringType):
            present = present & ~F.is_variant_null(col)
        if not field.nullable and path not in optional:
            ok = ok & (~here | present)
        if isinstance(field.dataType, T.ArrayType) and not field.dataType.containsNull and not variants and path not in full:
            ok = ok & ~F.coalesce(F.exists(col, lambda x: x.isNull()), F.lit(False))
    return ok


def _strict(dtype: T.DataType, path: str, defaulted: tuple[str, ...]) -> T.DataType:
    """The type to parse with: a JSON parser turns any value into text, so text is parsed as a typed variant."""
    if isinstance(dtype, T.StructType):
        at = f"{path}." if path else ""
        return T.StructType([T.StructField(f.name, _strict(f.dataType, f"{at}{f.name}", defaulted)) for f in dtype.fields])
    if path in defaulted or isinstance(dtype, T.StringType):
        return T.VariantType()
    if isinstance(dtype, T.ArrayType):
        return T.ArrayType(_strict(dtype.elementType, f"{path}[]", defaulted))
    return dtype


def _typed(dtype: T.DataType, col: Column) -> Column:
    """A strictly parsed column as its contract type."""
    return F.try_variant_get(col, "$", dtype.simpleString())


def _well_typed(schema: T.StructType, root: str, defaulted: tuple[str, ...], texts: bool = True) -> Column:
    """Text is text, and a field with a default is absent or a list of numbers (an explicit null is invalid).

    Without ``texts`` only the fields with a default are looked at.
    """
    ok = F.lit(True)
    for path, field, _ in _walk(schema):
        col = F.col(f"{root}.{path}")
        if path in defaulted:
            ok = ok & F.coalesce(F.schema_of_variant(col).rlike(r"^ARRAY<(DOUBLE|BIGINT|DECIMAL.*|VOID)>$"), F.lit(True))
        elif texts and isinstance(field.dataType, T.StringType):
            ok = ok & F.coalesce(F.schema_of_variant(col).isin("STRING", "VOID"), F.lit(True))
        elif texts and isinstance(field.dataType, T.ArrayType) and isinstance(field.dataType.elementType, T.StringType):
            all_text = F.forall(col, lambda x: F.coalesce(F.schema_of_variant(x) == "STRING", F.lit(False)))
            ok = ok & F.coalesce(all_text, F.lit(True))
    return ok


def _maybe_no_text(schema: T.StructType, root: str) -> Column:
    """True when the source of a text, parsed as such, may be no text; false only where each of them was text or null."""
    texts = []
    for path, field, _ in _walk(schema):
        col = F.col(f"{root}.{path}")
        if isinstance(field.dataType, T.StringType):
            texts.append(col)
        elif isinstance(field.dataType, T.ArrayType) and isinstance(field.dataType.elementType, T.StringType):
            texts.append(F.array_join(col, "\n", "["))
    return F.concat_ws("\n", *texts).rlike(MAYBE_NO_TEXT)


def _plain(dtype: T.DataType, path: str, defaulted: tuple[str, ...]) -> T.DataType:
    """The contract type as parsers return it; only a field with a default stays a variant, which tells null from absent."""
    if isinstance(dtype, T.StructType):
        at = f"{path}." if path else ""
        return T.StructType([T.StructField(f.name, _plain(f.dataType, f"{at}{f.name}", defaulted)) for f in dtype.fields])
    return T.VariantType() if path in defaulted else nullable(dtype)


def _record(contract: str, root: str, variants: bool = True) -> Column:
    """The parsed record in contract types, defaults filled. ``variants``: it was parsed strictly, else plainly."""
    defaulted = DEFAULTED.get(contract, ())

    def field(path: str, f: T.StructField) -> Column:
        col = F.col(f"{root}.{path}")
        if isinstance(f.dataType, T.StructType):
            inner = F.struct(*[field(f"{path}.{g.name}", g) for g in f.dataType.fields])
            return F.when(col.isNotNull(), inner).alias(f.name)
        if path in defaulted:
            parent = F.col(f"{root}.{path.rpartition('.')[0]}")
            filled = F.coalesce(_typed(f.dataType, col), F.array().cast(f.dataType))
            return F.when(parent.isNotNull(), filled).alias(f.name)
        if isinstance(f.dataType, T.StringType):
            text = _typed(f.dataType, col) if variants else col
            if contract == "raw" and path.startswith("current_units."):
                text = F.coalesce(text, F.lit(UNIT_DEFAULTS[f.name]))
            return text.alias(f.name)
        if variants and isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, T.StringType):
            return F.transform(col, lambda x: _typed(T.StringType(), x)).alias(f.name)
        return col.alias(f.name)

    return F.struct(*[field(f.name, f) for f in CONTRACTS[contract].fields])


def check_contract(df: DataFrame, contract: str, value: str = "value") -> DataFrame:
    """Add ``record`` (parsed), and ``reject_reason`` (null when valid) to keyed JSON rows.

    Extra fields are allowed, defaults are filled, whole numbers are accepted for doubles, and a fraction is not
    accepted for an integer.

    Most messages are plainly right: they parse in the contract's types without an error, miss nothing, and no text of
    theirs could be anything else. Only the others are parsed strictly, with texts as variants, which tells why.
    """
    schema, defaulted = CONTRACTS[contract], DEFAULTED.get(contract, ())
    out = parse_plain(df, "_p", _plain(schema, "", defaulted), value)
    lists = _well_typed(schema, "_p", defaulted, texts=False)
    complete = required_present(schema, "_p.", defaulted)
    plain = parsed_plainly("_p") & lists & complete & ~_maybe_no_text(schema, "_p")
    out = out.withColumn("_ok", F.coalesce(plain, F.lit(False)))
    out = parse_once(out, F.when(~F.col("_ok"), _from_json(value, _strict(schema, "", defaulted))).alias("_r"))
    corrupt = F.col(f"_r.{CORRUPT}")
    # Only a rejected record is parsed again, to tell broken JSON from a value of the wrong type.
    reason = (
        F.when(F.col("_ok"), F.lit(None))
        .when(F.col("_r").isNull() | (corrupt.isNotNull() & F.try_parse_json(value).isNull()), "not json")
        .when(corrupt.isNotNull() | ~_well_typed(schema, "_r", defaulted), "wrong type")
        .when(~required_present(schema, "_r.", defaulted, variants=True), "missing field")
    )
    record = F.when(F.col("_ok"), _record(contract, "_p", variants=False)).otherwise(_record(contract, "_r"))
    return out.withColumns({REASON: reason, "record": record}).drop("_p", "_ok", "_r")


def _from_json(value: str, schema: T.StructType) -> Column:
    """``value`` parsed by ``schema``; where it does not fit, what does fit and the text in a further field."""
    parse = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    return F.from_json(value, parse, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})


def parse_plain(df: DataFrame, name: str, schema: T.StructType, value: str = "value") -> DataFrame:
    """Add ``name``, the JSON text ``value`` read by ``schema``; ``parsed_plainly`` tells where it fits."""
    return parse_once(df, _from_json(value, schema).alias(name))


def parsed_plainly(name: str) -> Column:
    """True when ``parse_plain`` found valid JSON with no value of another type."""
    return F.col(name).isNotNull() & F.col(f"{name}.{CORRUPT}").isNull()


def parse_once(df: DataFrame, *columns: Column) -> DataFrame:
    """Add parsed columns through a one-row generator.

    The optimizer would otherwise copy the parser into every later expression that reads one of its fields.
    """
    return df.select("*", F.inline(F.array(F.struct(*columns))))


def validate_contract(df: DataFrame, contract: str, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """(valid rows with ``record``, rejected rows with ``reject_reason``)."""
    checked = check_contract(df, contract, value)
    return (
        checked.filter(F.col(REASON).isNull()).drop(REASON),
        checked.filter(F.col(REASON).isNotNull()).drop("record"),
    )


def conforms(df: DataFrame, contract: str) -> DataFrame:
    """Keep typed rows whose required fields are all present; types are already those of the columns."""
    return df.filter(required_present(CONTRACTS[contract], given=df.schema))

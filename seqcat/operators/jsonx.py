"""JSON text columns: schema inference, parsing, flattening, exploding."""

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seqcat import config as C

# Timestamps in JSON text keep microseconds (Spark's default text form stops at milliseconds).
JSON_OPTIONS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


# A field name (quoted or plain, before a colon) or one of the type names that JSON parsing does not take.
_DDL_TOKEN = re.compile(r"(?P<name>`(?:[^`]|``)*`|\w+)(?=\s*:)|OBJECT(?=<)|DECIMAL\(\d+,\s*\d+\)|\bVARIANT\b|\bVOID\b")


def _ddl_from_variant_schema(s: str) -> str:
    def token(m):
        if m["name"] is not None:
            return m["name"] if m["name"].startswith("`") else f"`{m['name']}`"
        if m[0] == "OBJECT":
            return "STRUCT"
        return "DOUBLE" if m[0].startswith("DECIMAL") else "STRING"
    return _DDL_TOKEN.sub(token, s)


def infer_json_schema(df: DataFrame, col: str) -> str:
    """Merged schema (DDL text) of every JSON document in ``col`` (one distributed aggregate).

    Fields seen in any document are kept; fractional numbers become double.
    For files prefer a declared schema or ``spark.read.json(paths).schema``.
    """
    ddl = df.agg(F.schema_of_variant_agg(F.try_parse_json(F.col(col)))).first()[0]
    return "STRUCT<>" if ddl is None else _ddl_from_variant_schema(ddl)


def parse_json(df: DataFrame, col: str, schema=None, out: str | None = None, options: dict | None = None) -> DataFrame:
    """Parse a JSON text column (``schema`` inferred over all rows when not given)."""
    schema = infer_json_schema(df, col) if schema is None else schema
    return df.withColumn(out or col, F.from_json(F.col(col), schema, options or {}))


def expand_json(df: DataFrame, col: str, *nested, schema=None, keep_source: bool = True) -> DataFrame:
    """Parse ``col`` and lift its top-level fields (and those of ``nested`` struct fields) to columns.

    Raises ``ValueError`` up front when a lifted name clashes with an existing column.
    """
    parsed = parse_json(df, col, schema, out="_json")
    st = parsed.schema["_json"].dataType
    if not isinstance(st, T.StructType):
        raise ValueError(f"{col} does not hold JSON objects")
    names = list(df.columns)
    lifted = [f.name for f in st.fields]
    for n in nested:
        if n in lifted and isinstance(st[n].dataType, T.StructType):
            lifted.remove(n)
            lifted += [f.name for f in st[n].dataType.fields]
    clash = (set(names) & set(lifted)) | {n for n in lifted if lifted.count(n) > 1}
    if clash:
        raise ValueError(f"expanding {col} would duplicate columns {sorted(clash)}")
    out = parsed.select("*", "_json.*").drop("_json")
    for n in nested:
        if n in out.columns and isinstance(out.schema[n].dataType, T.StructType):
            out = out.select("*", f"{n}.*").drop(n)
    return out if keep_source else out.drop(col)


def to_json_cols(df: DataFrame, cols=None) -> DataFrame:
    """Serialise struct/array/map columns (all of them by default) to JSON text."""
    if cols is None:
        cols = [f.name for f in df.schema.fields
                if isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType))]
    return df.withColumns({c: F.to_json(F.col(c)) for c in cols}) if cols else df


def explode_array(df: DataFrame, col: str, out: str | None = None, *, outer: bool = False,
                  position: str | None = None) -> DataFrame:
    """One row per array element; empty/null arrays drop the row unless ``outer``."""
    out = out or col
    if position:
        fn = F.posexplode_outer if outer else F.posexplode
        rest = [c for c in df.columns if c != col]
        return df.select(*rest, fn(F.col(col)).alias(position, out))
    fn = F.explode_outer if outer else F.explode
    return df.withColumn(out, fn(F.col(col)))


def explode_frames(df: DataFrame, col: str = "src_json", schema=None, *, outer: bool = False) -> DataFrame:
    """Telemetry document (JSON array of frame objects) -> one row per frame in ``col``."""
    parsed = parse_json(df, col, schema)
    if not isinstance(parsed.schema[col].dataType, T.ArrayType):
        raise ValueError(f"{col} does not hold a JSON array")
    return explode_array(parsed, col, outer=outer)


# A string of a JSON text, or what lies between two; and a bare NaN or infinity, which JSON does not have but the documents use.
_PIECE = r'("[^"\\]*+(?:\\.[^"\\]*+)*+"|[^"]++)'
_BARE = r"[-+]?\b(?:NaN|Infinity|INF)\b"


def document_variant(col: str = "src_json"):
    """The document as a variant, which keeps every digit of its numbers (up to 38); bare NaN and infinities become
    text.  Null if the text is no JSON."""
    pieces = F.regexp_extract_all(col, F.lit(_PIECE), F.lit(1))
    quoted = F.array_join(F.transform(pieces, lambda p: F.when(p.startswith('"'), p).otherwise(
        F.regexp_replace(p, _BARE, '"$0"'))), "")
    return F.coalesce(F.try_parse_json(col), F.try_parse_json(quoted))


def is_object(v):
    """True for a variant that holds a JSON object (never null)."""
    return F.try_variant_get(v, "$", "map<string,variant>").isNotNull()


def document_elements(v):
    """The frames of a document variant (an array's elements, or the one object); null if it is neither."""
    return F.coalesce(F.try_variant_get(v, "$", "array<variant>"), F.when(is_object(v), F.array(v)))


NO_JSON, NO_FRAMES, NO_OBJECT = "no JSON", "neither array nor object", "element is no object"


def tagged_frames(docs: DataFrame, col: str = "src_json") -> DataFrame:
    """One row per element of each telemetry document, parsed once: ``frame`` (a variant) where it is a frame, else ``reason`` and
    ``rejected`` (its text).  A document without any element to tell (no JSON, neither array nor object) is one
    rejected row; an empty array gives none."""
    entry = lambda reason, frame, text: F.struct(
        reason.cast("string").alias("reason"), frame.cast("variant").alias("frame"), text.cast("string").alias("rejected"))
    nothing = F.lit(None)
    parsed = docs.withColumn("_doc", document_variant(col))
    elements = document_elements(F.col("_doc"))
    per_element = F.transform(elements, lambda e: F.when(is_object(e), entry(nothing, e, nothing)).otherwise(
        entry(F.lit(NO_OBJECT), nothing, F.to_json(e))))
    reason = F.when(F.col("_doc").isNull(), F.lit(NO_JSON)).otherwise(F.lit(NO_FRAMES))
    whole = F.array(entry(reason, nothing, F.col(col)))
    out = parsed.withColumn("_entry", F.explode(F.coalesce(per_element, whole)))
    return out.select(*docs.columns, "_entry.*")


def typed_variant(v, dtype: T.DataType, path: str = "$"):
    """Columns of ``dtype`` out of a variant: a number written as text is a number, text takes numbers as they are written."""
    if isinstance(dtype, T.StructType):
        return F.struct(*[typed_variant(v, f.dataType, f"{path}[{_quoted(f.name)}]").alias(f.name) for f in dtype.fields])
    return F.try_variant_get(v, path, dtype.simpleString())


def _quoted(name: str) -> str:
    return "'" + name + "'" if "'" not in name else '"' + name + '"'


def _is_object(col: str):
    """True for the text of a JSON object (bare NaN allowed)."""
    return F.from_json(col, "map<string,string>").isNotNull()


def malformed_documents(docs: DataFrame, col: str = "src_json", *, array: bool = False) -> DataFrame:
    """Documents whose text is null, no JSON, or neither an object nor (with ``array``) an array: exploding them
    gives no row, so count these next to the result."""
    return docs.where(document_elements(document_variant(col)).isNull() if array else ~_is_object(col))


def open_frame_schema(frames: DataFrame, declared: T.StructType, col: str = "src_json",
                      parts=("feed", "platform")) -> T.StructType:
    """``declared`` with every further field of ``parts`` that any frame text in ``col`` has (one aggregate over all
    frames).  Declared types stay; of names that differ in case only, the first stays."""
    # a number that is not finite stands as text: for the types alone, null takes its place
    plain = F.regexp_replace(col, r'([:\[,])"?[-+]?(?:NaN|Infinity|INF)"?(?=[,}\]])', "$1null")
    texts = frames.select(plain.alias(col))
    seen = T.DataType.fromDDL(infer_json_schema(texts, col))
    fields = []
    for f in declared.fields:
        extra = _field(seen, f.name) if f.name in parts else None
        names = {x.lower() for x in f.dataType.fieldNames()} if f.name in parts else set()
        more = []
        for x in extra.fields if isinstance(extra, T.StructType) else []:
            if x.name.lower() not in names:
                names.add(x.name.lower())
                more.append(x)
        fields.append(T.StructField(f.name, T.StructType([*f.dataType.fields, *more])) if more else f)
    return T.StructType(fields)


def _field(schema: T.DataType, path: str):
    for part in path.split("."):
        if not isinstance(schema, T.StructType) or part not in schema.fieldNames():
            return None
        schema = schema[part].dataType
    return schema


def flatten_frame(df: DataFrame, col: str = "src_json", *, lift=("feed", "platform"), drop=("id",)) -> DataFrame:
    """Flatten one frame struct: ``sequence_frame`` (int), ``all_fields`` (kept nested), every field
    of ``feed``/``platform``, the telemetry fields of ``FRAME_DEEP_FIELDS`` and a null ``area_code``.

    Paths missing from the schema give null columns instead of analysis errors.  A lifted field whose name is taken
    gets its parent's name as a prefix; a dot or backtick in a name becomes ``_``.
    """
    st = df.schema[col].dataType
    taken = {c.lower() for c in (*df.columns, "sequence_frame", "all_fields", "area_code", *C.FRAME_DEEP_FIELDS)}
    sel = [F.col("*")]
    sel.append((F.col(f"{col}.seq_frame").try_cast("int") if _field(st, "seq_frame") is not None
                else F.lit(None).cast("int")).alias("sequence_frame"))
    if _field(st, "all_fields") is not None:
        sel.append(F.col(f"{col}.all_fields").alias("all_fields"))
    for s in lift:
        part = _field(st, s)
        for f in part.fieldNames() if isinstance(part, T.StructType) else []:
            if f in drop:
                continue
            name = re.sub(r"[.`]", "_", f)
            while name.lower() in taken:
                name = f"{s}_{name}"
            taken.add(name.lower())
            sel.append(F.col(f"{col}.{s}").getField(f).alias(name))
    for name, (path, cast) in C.FRAME_DEEP_FIELDS.items():
        c = F.col(f"{col}.{path}") if _field(st, path) is not None else F.lit(None)
        sel.append((c.cast(cast) if cast else c).alias(name))
    sel.append(F.lit(None).cast("string").alias("area_code"))
    return df.select(*sel).drop(*drop)

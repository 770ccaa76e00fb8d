"""Collections of documents as DataFrames.

A *document frame* has ``doc`` (VARIANT), ``_seq`` (LONG, newest highest) and
``_keys`` (field names in the order they were written).  A typed table can be
turned into one, or used as it is: operators that take a typed frame read only
the columns the map asks for, so pruning reaches the scan.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from docsync.functions.naming import KEY_SOURCE, id_text, ref

DOC = "doc"
SEQ = "_seq"
KEYS = "_keys"
# The text itself, where it is no JSON.
UNPARSED = "_unparsed"

# How many documents a type check looks at unless told otherwise.
DEFAULT_SAMPLE = 100

# Values of one list that Spark hands to Parquet as equalities
# (spark.sql.parquet.pushdown.inFilterThreshold); of more it tells only least and greatest.
PUSHED_KEYS = 10

# Control characters cannot occur unescaped in JSON, so they are free as marks.
_BACKSLASH, _QUOTE, _MARK = "\x02", "\x03", "\x01"


def nan_to_null(json_text: Column) -> Column:
    """Replace bare ``NaN`` values by ``null``; text inside strings is kept.

    Escapes are hidden first so that a string literal is simply ``"[^"]*"``;
    then every literal and every NaN gets a mark behind it, and only a mark
    that does not follow a quote stands for a NaN.
    """
    hidden = F.replace(F.replace(json_text, F.lit("\\\\"), F.lit(_BACKSLASH)), F.lit('\\"'), F.lit(_QUOTE))
    marked = F.regexp_replace(hidden, '("[^"]*+")|NaN', "$1" + _MARK)
    nulled = F.replace(F.regexp_replace(marked, f'(?<!"){_MARK}', "null"), F.lit(_MARK), F.lit(""))
    return F.replace(F.replace(nulled, F.lit(_QUOTE), F.lit('\\"')), F.lit(_BACKSLASH), F.lit("\\\\"))


def parse_document(json_text: Column) -> Column:
    """JSON text -> VARIANT, null when it is not JSON."""
    strict = F.try_parse_json(json_text)
    repaired = F.when(F.contains(json_text, F.lit("NaN")), F.try_parse_json(nan_to_null(json_text)))
    return F.coalesce(strict, repaired)


def from_json(df: DataFrame, text: str, seq: str | Column) -> DataFrame:
    """Document frame from a column of JSON texts; see :func:`unparsable`."""
    raw = ref(text)
    order = ref(seq) if isinstance(seq, str) else seq
    clean = F.when(F.contains(raw, F.lit("NaN")), nan_to_null(raw)).otherwise(raw)
    return df.select(
        parse_document(raw).alias(DOC),
        order.cast("long").alias(SEQ),
        F.array_distinct(F.json_object_keys(clean)).alias(KEYS),
        raw.alias(UNPARSED),
    ).withColumn(UNPARSED, F.when(F.col(DOC).isNull(), F.col(UNPARSED)))


def unparsable(df: DataFrame, text: str, seq: str | Column) -> DataFrame:
    """The texts ``from_json`` turns into null documents: ``(_seq, document)``."""
    return unparsed(from_json(df, text, seq))


def unparsed(docs: DataFrame) -> DataFrame:
    """The same of a document frame."""
    return docs.where(ref(UNPARSED).isNotNull()).select(SEQ, ref(UNPARSED).alias("document"))


def from_table(
    df: DataFrame, seq: str | Column, fields: dict[str, Column] | None = None
) -> DataFrame:
    """Document frame from a typed table; null fields stay present as null.

    ``fields`` names the document's fields in order and gives their values;
    by default every column of ``df`` is a field.
    """
    fields = fields or {c: ref(c) for c in df.columns}
    order = ref(seq) if isinstance(seq, str) else seq
    return df.select(
        F.to_variant_object(F.struct(*[v.alias(k) for k, v in fields.items()])).alias(DOC),
        order.cast("long").alias(SEQ),
        F.array(*[F.lit(k) for k in fields]).alias(KEYS),
    )


def read_json_documents(spark: SparkSession, path: str | list[str], seq_field: str) -> DataFrame:
    """Document frame from files holding one JSON document per line.

    ``_seq`` is the whole-number field ``seq_field`` of each document.
    """
    text = spark.read.text(path)
    seq = F.try_variant_get(parse_document(F.col("value")), f'$["{seq_field}"]', "long")
    return from_json(text, "value", seq)


def is_document_frame(df: DataFrame) -> bool:
    return DOC in df.columns and isinstance(df.schema[DOC].dataType, T.VariantType)


def newest(df: DataFrame, n: int = DEFAULT_SAMPLE, seq: str = SEQ) -> DataFrame:
    """The ``n`` newest rows; a distributed top-n, never a full sort."""
    return df.orderBy(ref(seq).desc()).limit(n)


def newest_by_cutoff(df: DataFrame, n: int = DEFAULT_SAMPLE, seq: str = SEQ) -> DataFrame:
    """The same rows, found in two steps.

    First only the ordering column is read, for the position the ``n`` newest
    begin at; with that one number as a filter the scan can leave out nearly
    all documents, and those left out are never parsed.
    """
    order = ref(seq)
    top = df.select(order.alias("_at")).where("_at IS NOT NULL").orderBy(F.desc("_at")).limit(n)
    found = top.agg(F.min("_at").alias("cutoff"), F.count("_at").alias("n")).first()
    if found["n"] < n:
        return newest(df, n, seq)
    return newest(df.where(order >= found["cutoff"]), n, seq)


def projected(df: DataFrame, fields: Iterable[str], newest_first_by: str | None = None) -> DataFrame:
    """Only the named top-level fields.

    Order means nothing to a load, so nothing is sorted unless asked for.
    """
    out = df.select(*[ref(f) for f in fields])
    if newest_first_by is None:
        return out
    if newest_first_by in out.columns:
        return out.orderBy(ref(newest_first_by).desc())
    keep = out.columns
    return (
        df.select(*[ref(f) for f in keep], ref(newest_first_by))
        .orderBy(ref(newest_first_by).desc())
        .select(*[ref(f) for f in keep])
    )


def lookup(df: DataFrame, key: object, key_column: str = KEY_SOURCE) -> DataFrame:
    """The document with this id.

    On a typed frame the comparison keeps the column's own type, so it is
    pushed into the scan; on a document frame ids compare as text.
    """
    if is_document_frame(df) and key_column not in df.columns:
        field = F.try_variant_get(F.col(DOC), f'$["{key_column}"]', "string")
        return df.where(field == id_text(F.lit(key))).limit(1)
    typed = F.lit(key).cast(df.schema[key_column].dataType)
    return df.where(ref(key_column) == typed).limit(1)


def with_keys(df: DataFrame, keys: Iterable[object], key_column: str) -> DataFrame:
    """Rows with one of these keys, each compared in the column's own type.

    Parquet skips row groups by equality, for which Spark pushes lists of at
    most ten values; longer ones are made of several.  Nulls match nothing.
    """
    kind = df.schema[key_column].dataType
    wanted = [F.lit(k).cast(kind) for k in dict.fromkeys(keys) if k is not None]
    found = F.lit(False)
    for at in range(0, len(wanted), PUSHED_KEYS):
        some = ref(key_column).isin(*wanted[at : at + PUSHED_KEYS])
        found = found | some if at else some
    return df.where(found)


def count_documents(collections: dict[str, DataFrame]) -> DataFrame:
    """``(collection_name, n_documents)``; each count is partial per task."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("n_documents")).select(
            F.lit(name).alias("collection_name"), "n_documents"
        )
        for name, df in sorted(collections.items())
    ]
    out = counts[0]
    for other in counts[1:]:
        out = out.unionByName(other)
    return out

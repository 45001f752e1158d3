"""Validation of raw records and their typed rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.functions.text import id_verified, is_blank

# Field names, first name first, and allowed source types.
ALIASES = {
    "publisher_name": ("company", "publisher_name"),
    "url": ("link", "url"),
    "content": ("article", "content"),
    "author": ("reporter", "author"),
    "published_at": ("published", "published_at"),
}
FIELDS = ("schema_version", "article_id", "publisher_id", "publisher_name", "source_type", "url", "title", "content", "author", "category", "category_str", "thumbnail_url", "language", "published_at")
OPTIONAL = ("author", "category_str", "thumbnail_url")
SOURCE_TYPES = ("DATASET", "RSS", "HTML")
#: Date and time with an offset.
AWARE = r"\A\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(:\d{2}(\.\d+)?)?\s*(Z|z|[+-]\d{2}:?\d{2})\z"


def _field(raw: Column, name: str) -> tuple[Column, Column]:
    """(value, whether a key was found) of a map of raw values: the first alias present wins, even with a null."""
    names = ALIASES.get(name, (name,))
    present = [F.map_contains_key(raw, n) for n in names]
    value = F.lit(None).cast("variant")
    for n, p in reversed(list(zip(names, present, strict=True))):
        value = F.when(p, F.element_at(raw, n)).otherwise(value)
    has = present[0]
    for p in present[1:]:
        has = has | p
    return value, has


def validate(records: DataFrame, record: str = "record") -> DataFrame:
    """``records`` with one text column a field, ``published_at`` in UTC, and ``error`` (null when valid).

    Errors are ``field: message``, joined by '; ' in field order. Texts are kept as they are, blank optional ones
    become null, timestamps need an offset."""
    # one parse a record, one look-up, one type and one text a field, each a projection of its own so that none is worked out twice;
    # a map of raw values tells a missing key from a null
    out = records.withColumn("_raw", F.from_json(record, "map<string,variant>"))
    found = {name: _field(F.col("_raw"), name) for name in FIELDS}
    out = out.withColumns({f"_v_{n}": v for n, (v, _) in found.items()} | {f"_h_{n}": h for n, (_, h) in found.items()})
    out = out.withColumns({f"_k_{n}": F.schema_of_variant(f"_v_{n}") for n in FIELDS} | {f"_t_{n}": F.variant_get(f"_v_{n}", "$", "string") for n in FIELDS})
    errors, texts = [], {}
    for name in FIELDS:
        has, text, kind = F.col(f"_h_{name}"), F.col(f"_t_{name}"), F.col(f"_k_{name}")
        is_text, is_null = kind == "STRING", kind.isNull() | (kind == "VOID")
        if name in OPTIONAL:
            bad = F.when(has & ~is_null & ~is_text, "must be a string or null")
            shown = F.when(is_text & ~is_blank(text), text)
        elif name == "published_at":
            bad = F.when(~has, "field required").when(~F.coalesce(is_text & text.rlike(AWARE), F.lit(False)), "must have a timezone").when(F.try_to_timestamp(text).isNull(), "invalid datetime")
            shown = text
        elif name == "source_type":
            bad = F.when(~has, "field required").when(~F.coalesce(is_text & text.isin(*SOURCE_TYPES), F.lit(False)), "must be one of " + ", ".join(SOURCE_TYPES))
            shown = text
        else:
            bad = F.when(~has, "field required").when(~F.coalesce(is_text, F.lit(False)), "must be a string").when(is_blank(text), "must not be empty")
            shown = text
        texts[f"_{name}"] = F.when(has, shown)
        errors.append(F.when(bad.isNotNull(), F.concat(F.lit(f"{name}: "), bad)))
    out = out.withColumns(texts)
    found = F.array_join(F.filter(F.array(*errors), lambda e: e.isNotNull()), "; ")
    out = out.withColumn("error", F.when(found != "", found))
    keep = [c for c in records.columns if c not in FIELDS and c != "error"]
    return out.select(*keep, *[F.try_to_timestamp(F.col("_published_at")).alias(n) if n == "published_at" else F.col(f"_{n}").alias(n) for n in FIELDS], "error")


#: Order of records: files by name, then places in a file by number.
SOURCE_ORDER = ("source_file", "source_place", "source_ref")


def first_in_batch(rows: DataFrame, order: tuple[str, ...] = SOURCE_ORDER, key: str = "article_id") -> DataFrame:
    """Of rows of one id the first by ``order``, as a pre-aggregated minimum: no window holds an id with very many rows."""
    row = F.struct(*rows.columns)
    return rows.groupBy(F.col(key).alias("_key")).agg(F.min_by(row, F.struct(*order)).alias("_row")).select("_row.*")


def gold_rows(valid: DataFrame) -> DataFrame:
    """Rows of the articles table."""
    return valid.withColumn("published_date", F.date_format("published_at", "yyyy-MM-dd")).withColumn("content_len", F.length("content")).withColumn("article_id_verified", id_verified(F.col("article_id"), F.col("publisher_id"), F.col("url"))).withColumn("ingested_at", F.current_timestamp())


def ingest_stats(checked: DataFrame, existing: DataFrame) -> DataFrame:
    """One row: read, rejected, valid, repeated in the batch, known already, to write."""
    # records are checked once: those with errors are one group, without an id
    valid = F.col("error").isNull()
    ids = checked.groupBy(F.when(valid, F.col("article_id")).alias("article_id")).agg(F.count("*").alias("n"), F.count("error").alias("bad"))
    both = ids.join(existing.select("article_id").distinct().withColumn("known", F.lit(1)), "article_id", "left").withColumn("good", F.col("n") - F.col("bad"))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    own = F.col("article_id").isNotNull()
    return both.agg(
        total("n").alias("read"), total("bad").alias("rejected"), total("good").alias("valid"), total(F.when(own, F.col("good") - 1)).alias("batch_duplicates"),
        F.count("known").alias("skipped"), F.count(F.when(own & F.col("known").isNull(), 1)).alias("written"),
    )

"""Document preparation: clean, chunk, describe, filter."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.functions.splitter import split_recursive
from tidewell.functions.text import guess_section, sanitize_document


def sanitize_documents(docs: DataFrame, text: str = "text") -> DataFrame:
    """Cleaned text; documents left empty are dropped.

    A generator drops them, because a filter on the result would make the optimizer clean every text twice.
    """
    return docs.withColumn(text, F.explode(F.filter(F.array(sanitize_document(text)), lambda t: t != "")))


def chunk_documents(docs: DataFrame, text: str = "text", size: int = 1000, overlap: int = 150) -> DataFrame:
    """One row per chunk (`idx`, `content`) next to the document's other columns, split at natural boundaries.

    Splitting is sequential inside a document, so rows stream through Arrow batches of one narrow stage: no
    shuffle, and chunks are handed on in small frames however long a document is.
    """
    keep = [f for f in docs.schema.fields if f.name != text]
    schema = T.StructType([*keep, T.StructField("idx", T.LongType()), T.StructField("content", T.StringType())])
    names, flush = [f.name for f in keep], 2000

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows: list[tuple] = []
        for batch in batches:
            others = list(zip(*[batch[n] for n in names])) if names else [()] * len(batch)
            for meta, body in zip(others, batch[text]):
                for idx, chunk in enumerate(split_recursive(body or "", size, overlap)):
                    rows.append((*meta, idx, chunk))
                    if len(rows) >= flush:
                        yield pd.DataFrame(rows, columns=schema.fieldNames())
                        rows = []
        if rows:
            yield pd.DataFrame(rows, columns=schema.fieldNames())

    return docs.select(*names, text).mapInPandas(split, schema)


def chunk_fixed(docs: DataFrame, text: str = "text", size: int = 1000, overlap: int = 150) -> DataFrame:
    """Windows of fixed size and overlap, as plain columns; the windows cover the whole text."""
    step = size - overlap
    last = F.greatest(F.ceil((F.length(text) - overlap) / F.lit(float(step))) - 1, F.lit(0)).cast("int")
    idx = F.explode(F.when(F.length(text) > 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>")))
    numbered = docs.withColumn("idx", idx)
    content = F.substr(F.col(text), F.col("idx") * step + 1, F.lit(size))
    return numbered.withColumns({"content": content, "idx": F.col("idx").cast("long")}).drop(text)


def chunk_metadata(chunks: DataFrame, name: str = "name", page0: int = 0) -> DataFrame:
    """Source, page, owner, confidentiality, section and the id source:page:index (page counted from 0 there)."""
    return chunks.select(
        F.concat_ws(":", name, F.lit(str(page0)), F.col("idx").cast("string")).alias("chunk_id"),
        F.col(name).alias("source"), F.lit(page0 + 1).alias("page"), "owner", "confidentiality", guess_section("content").alias("section"), "content",
    )


def chunk_preview(chunks: DataFrame, rows: int = 200, width: int = 500) -> DataFrame:
    """The first chunks by id, content shortened for reading."""
    return chunks.withColumn("content", F.substring("content", 1, width)).orderBy("chunk_id").limit(rows)


def metadata_filter(chunks: DataFrame, owner: str | None = None, confidentiality: str | None = None, allowed: Iterable[str] | None = None) -> DataFrame:
    out = chunks
    if owner:
        out = out.where(F.col("owner") == owner)
    if confidentiality:
        out = out.where(F.col("confidentiality") == confidentiality)
    return out if allowed is None else out.where(F.col("confidentiality").isin(*allowed))

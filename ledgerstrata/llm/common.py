"""Small helpers that the operators of this package share."""

from __future__ import annotations

import re
import string
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ledgerstrata.storage import shared_root

# Word separators of every text contract here: space, tab, line feed, vertical
# tab, form feed, carriage return. ``bytes.split()`` splits at the same six.
SPACES = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(name: str) -> str:
    """Path of an installed public vocabulary file, the same on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder on the storage that all executors share."""
    return f"{shared_root(spark)}/llm/{name}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, name: str, compression: str = "zstd") -> DataFrame:
    """Write ``df`` to shared storage and read it back.

    This cuts the lineage: a later stage that loses an executor rereads a file
    instead of repeating the work, and non-deterministic columns keep the value
    they were written with.
    """
    path = new_folder(df.sparkSession, name)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def lower_ascii(text: Column) -> Column:
    """``text`` with A-Z lower-cased and nothing else changed; NULL is empty.

    ``lower`` also changes other letters, so it is only used where every
    character is one byte long.
    """
    text = F.coalesce(text, F.lit(""))
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    )


def remainder_of_id(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``; NULL ids count as the empty text."""
    return (F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % n).cast("int")


def give_back() -> None:
    """Return memory that a task has freed to the system.

    Python workers live on beside the JVM, and what their allocators hold counts
    against the executor although no task uses it.
    """
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def map_texts(docs: DataFrame, text_col: str, start, fields: dict[str, str]) -> DataFrame:
    """``docs`` with columns computed from whole texts, every other column passed through.

    ``start()`` is called once per task and returns a function from a text (bytes,
    never NULL) to one tuple with the values of ``fields`` (name to Spark type).
    """
    names = list(fields)

    def run(batches):
        import pyarrow as pa

        compute = start()
        for batch in batches:
            texts = batch.column(at).cast(pa.binary())
            rows = [compute(text.as_py() or b"") for text in texts]
            added = [pa.array([row[i] for row in rows], kinds[i]) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *added], names=[*batch.schema.names, *names]
            )
        give_back()

    from pyspark.sql.pandas.types import to_arrow_type
    from pyspark.sql.types import StructType

    if docs.schema[text_col].dataType != StringType():
        docs = docs.withColumn(text_col, F.col(text_col).cast("string"))
    at = docs.columns.index(text_col)
    extra = StructType.fromDDL(", ".join(f"{name} {kind}" for name, kind in fields.items()))
    kinds = [to_arrow_type(field.dataType) for field in extra]
    return docs.mapInArrow(run, StructType(docs.schema.fields + extra.fields))


def spare_name(df: DataFrame, name: str) -> str:
    """``name``, or a longer one where ``df`` already has a column of that name."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def only_rows(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row of ``docs`` for each ``(doc_id, text_key)`` of ``wanted``.

    ``text_key`` is the 64-bit hash of the text as it is, so rows that repeat an
    id are told apart; of fully repeated rows one stays.
    """
    key, place = spare_name(docs, "text_key"), spare_name(docs, "place")
    left = docs.withColumn(key, F.xxhash64(F.col(text_col)))
    right = wanted.select(F.col("doc_id").alias("_doc_id"), F.col("text_key").alias("_text_key")).distinct()
    same = left[id_col].eqNullSafe(right["_doc_id"]) & (left[key] == right["_text_key"])
    order = Window.partitionBy(id_col, key).orderBy(F.lit(0))
    return (
        left.join(right, same, "left_semi")
        .withColumn(place, F.row_number().over(order))
        .where(F.col(place) == 1)
        .select(*docs.columns)
    )


def word_blocks(text: bytes, size: int = 4 << 20):
    """The words of ``text`` as lists, cut at spaces about every ``size`` bytes."""
    if len(text) <= size:
        yield text.split()
        return
    start = 0
    for gap in _GAP.finditer(text):
        if gap.start() - start >= size:
            yield text[start : gap.start()].split()
            start = gap.end()
    yield text[start:].split()


_GAP = re.compile(rb"[\x20\x09-\x0D]+")

"""What the operators of this subpackage share."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.session import checkpoint_dir, local_checkpoint_dir

#: The characters that separate words: space, tab, line feed, vertical tab, form feed, return.
SPACES = r"\x20\x09-\x0D"
WORD = f"[^{SPACES}]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """This application's folder below ``spark.checkpoint.dir``. A machine-local folder
    is set only where the session names none and runs in one process, as in tests."""
    root = checkpoint_dir(spark) or local_checkpoint_dir(spark)
    return f"{root.rstrip('/')}/logtide_llm/{spark.sparkContext.applicationId}"


def stored(df: DataFrame) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it again: one
    computation, a cut lineage, and nothing that dies with an executor. The table stays
    until :func:`clear_stored`, since the returned frame reads it lazily."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def clear_stored(spark: SparkSession) -> None:
    """Delete the tables of :func:`stored` once the results that read them are written."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(shared_folder(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def free_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` doesn't have."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


def word_count(text: Column) -> Column:
    """Number of words of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def text_slices(batch: pa.RecordBatch, column: str, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """``batch`` in slices of about ``limit`` bytes of text, a row at least."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    begin, held = 0, 0
    for i, n in enumerate(sizes.tolist()):
        held += n
        if held >= limit:
            yield batch.slice(begin, i + 1 - begin)
            begin, held = i + 1, 0
    if begin < batch.num_rows:
        yield batch.slice(begin)


def map_texts(df: DataFrame, column: str, keep: list[str], added: str, make) -> DataFrame:
    """The columns ``keep`` of ``df`` and ``added`` (a DDL string), which ``make(texts)``
    returns as a list of Arrow arrays for a list of texts (null: empty). A kept column that
    an added one has the name of is replaced."""
    new = T.StructType.fromDDL(added)
    names = {f.name.lower() for f in new}
    keep = [c for c in keep if c.lower() not in names]
    schema = T.StructType([df.schema[c] for c in keep] + list(new))
    text = column if column in keep else free_name(df, "_text")
    sent = df.select(*keep) if column in keep else df.select(*keep, F.col(column).alias(text))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, text):
                texts = [t or "" for t in part.column(text).to_pylist()]
                yield pa.RecordBatch.from_arrays([*(part.column(i) for i in range(len(keep))), *make(texts)],
                                                 names=schema.names)

    return sent.mapInArrow(run, schema)


def labelled_sample(docs: DataFrame, labels: DataFrame, most: int) -> DataFrame:
    """(doc_id, text, label) of the documents whose label is known: of ``labels`` (doc_id,
    label) the ``most`` first by hash of the id, joined to whole texts by broadcast and
    stored. Repeated labels count as the largest, repeated texts once, with their smallest id."""
    known = (labels.filter("doc_id is not null and label is not null").groupBy("doc_id").agg(F.max("label").alias("label"))
             .orderBy(F.xxhash64("doc_id"), "doc_id").limit(most))
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(known), "doc_id")
    return stored(texts.groupBy("text").agg(F.min("doc_id").alias("doc_id"), F.max("label").alias("label"))
                  .select("doc_id", "text", F.col("label").cast("int").alias("label")))


def in_fold(doc_id: Column, parts: int, part: int) -> Column:
    """Whether crc32 of the id as text leaves ``part`` modulo ``parts``; a null id is the empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(parts)) == part

"""What several operators of this subpackage share."""

from __future__ import annotations

import os
import tempfile
from collections.abc import Callable, Iterator
from uuid import uuid4

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word: a run without ASCII white space. `bytes.split()` cuts UTF-8 at the same characters.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the data set in `sf_dir`."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpoint_folder(spark: SparkSession) -> str:
    """The reliable checkpoint folder of the session.

    A cluster names a shared folder in spark.checkpoint.dir. Where none is set, a local session takes a temporary folder, as in
    tests, and any other a folder in the warehouse, which its machines share."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and context.master.startswith("local"):
            folder = tempfile.mkdtemp(prefix="spark-checkpoint-")
        context.setCheckpointDir(folder or f"{spark.conf.get('spark.sql.warehouse.dir')}/checkpoints")
    return context.getCheckpointDir()


def checkpointed(df: DataFrame) -> DataFrame:
    """`df`, computed once and written to the checkpoint folder."""
    checkpoint_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def tasks_for(rows: int, each: int = 100_000, least: int = 8) -> int:
    """Tasks for so many small rows."""
    return max(least, -(-rows // each))


def compact(df: DataFrame) -> DataFrame:
    """`df`, checkpointed and in no more partitions than its rows need: the many steps over a small table then shuffle few files."""
    df = checkpointed(df)
    return df.coalesce(tasks_for(df.count()))


def store(df: DataFrame) -> str:
    """Place of a Parquet table with the rows of `df`, in the shared checkpoint folder."""
    path = f"{checkpoint_folder(df.sparkSession)}/tidemark-{uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return path


def stored(df: DataFrame) -> DataFrame:
    """`df`, written as Parquet in the shared checkpoint folder and read from there."""
    return df.sparkSession.read.parquet(store(df))


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a stored table that no later job reads."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def _from_top(df: DataFrame, column: str, room: int) -> tuple[list[int], int | None, int]:
    """The highest values of a column whose rows all fit, the first whose rows do not, and the room that is left for those."""
    whole = []
    for r in sorted(df.groupBy(column).count().collect(), key=lambda r: -r[column]):
        if r["count"] > room:
            return whole, r[column], room
        whole.append(r[column])
        room -= r["count"]
    return whole, None, room


def largest(df: DataFrame, measure: Column, most: int, key: str, steps: int = 16, slots: int = 4096) -> DataFrame:
    """The rows of largest positive measure, `most` of them if there are as many: whole classes of a logarithmic histogram from the
    top, and of the first class that does not fit as many as there is room for, by the hash of their `key`.

    Only two histograms go to the driver, whatever the number of rows and partitions; rows are only ordered within one slot of hashes."""
    place = F.floor(F.log2(F.greatest(measure, F.lit(1e-12))) * steps)
    df = df.withColumns({"__place": place, "__slot": F.pmod(F.xxhash64(key), F.lit(slots))})
    whole, split, room = _from_top(df, "__place", most)
    out = df.where(F.col("__place").isin(whole))
    if split is not None and room:
        inside = df.where(F.col("__place") == split)
        fit, last, room = _from_top(inside, "__slot", room)
        out = out.unionByName(inside.where(F.col("__slot").isin(fit)))
        if room:
            out = out.unionByName(inside.where(F.col("__slot") == last).orderBy(measure.desc(), key).limit(room))
    return out.drop("__place", "__slot")


def in_fold(doc_id: Column, modulus: int, remainder: int) -> Column:
    """True where crc32 of the id as text has this remainder; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus == remainder


def pieces(batches: Iterator[pa.RecordBatch], text: str = "text", most: int = 1_000_000) -> Iterator[pa.RecordBatch]:
    """The rows of `batches` in slices of about `most` bytes of text, one row at least."""
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text))
        if not len(column):
            continue
        sizes = pc.binary_length(column).fill_null(0).to_pylist()
        start = total = 0
        for i, n in enumerate(sizes):
            if i > start and total + n > most:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += n
        yield batch.slice(start)


def map_arrow(df: DataFrame, function: Callable, schema: str) -> DataFrame:
    """mapInArrow over slices of bounded size. `function` takes a RecordBatch with a `text` column and
    gives back the columns of `schema`, in its order, as a list of Arrow arrays."""
    names = [x.name for x in _schema(df.sparkSession, schema)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            yield pa.RecordBatch.from_arrays(function(batch), names=names)

    return df.mapInArrow(run, schema)


def _schema(spark: SparkSession, ddl: str):
    from pyspark.sql.types import StructType

    return StructType.fromDDL(ddl)


def texts(df: DataFrame, *keep: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Columns doc_id and text (null: empty), and those to keep; whatever else the rows have goes."""
    return df.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), *[F.col(c) for c in keep])


def tokenizer_path(name: str) -> str:
    """Place of a public tokenizer's file."""
    import public_tokenizers

    return os.fspath(public_tokenizers.path(name))

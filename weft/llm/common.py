"""What the operators of this subpackage share: reading, shared scratch space, tokens.

Scratch files go only below the folder named by ``spark.checkpoint.dir`` (all
executors and the driver see it). Where it is unset, as in local tests, a
temporary folder is set as the session's checkpoint folder; a session that is not local
raises instead, as its executors would not see that folder.
"""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import gc
import sys
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space of the word pattern [^\x20\x09-\x0D]+ in Java's regex syntax.
SPACE_CLASS = r"[\x20\x09-\x0D]"
#: Bytes that end a word of [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ become a space, A-Z become a-z.
ALNUM_TABLE = bytes(
    c + 32 if 65 <= c <= 90 else 32 if c < 0x30 or 0x3A <= c <= 0x60 or 0x7B <= c <= 0x7F else c for c in range(256)
)
#: Rows and bytes of an Arrow batch; texts may be long, so batches are kept short.
BATCH_ROWS = 512
BATCH_BYTES = 8 << 20

_scratch: list[tuple[SparkSession, str]] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The Parquet table ``name`` below ``sf_dir``, by Spark's reader."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """A new folder below the cluster's shared checkpoint folder."""
    top = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not top:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir is unset: it must name a folder that all executors share")
        top = "file://" + tempfile.mkdtemp(prefix="weft-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(top)
    if not _scratch:
        atexit.register(drop_scratch)
    path = f"{top.rstrip('/')}/weft-{uuid.uuid4().hex}"
    _scratch.append((spark, path))
    return path


def drop_scratch() -> None:
    """Deletes the folders that ``shared_dir`` gave out, as far as the session still runs."""
    while _scratch:
        spark, path = _scratch.pop()
        sc = spark.sparkContext
        if sc._jsc is not None and not sc._jsc.sc().isStopped():
            p = sc._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(sc._jsc.hadoopConfiguration()).delete(p, True)


def written(df: DataFrame, partition_by: list[str] | None = None) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: lineage ends here and lost executors cost nothing."""
    spark, path = df.sparkSession, shared_dir(df.sparkSession)
    writer = df.write.partitionBy(*partition_by) if partition_by else df.write
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path) if not partition_by else spark.read.parquet(path)


def dropped(df: DataFrame) -> None:
    """Deletes the table that ``written`` gave, once nothing reads it any more."""
    files = df.inputFiles()
    for spark, path in [m for m in _scratch if any(m[1].rpartition("/")[2] in f for f in files)]:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
        _scratch.remove((spark, path))


def short_batches(spark: SparkSession) -> None:
    """Keeps the session's Arrow batches to ``BATCH_ROWS`` rows and ``BATCH_BYTES`` bytes, here and in later queries."""
    for key, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS), ("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)):
        now = spark.conf.get(key).rstrip("b")
        if not now.isdigit() or not 0 < int(now) <= most:
            spark.conf.set(key, str(most))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names of columns that ``df`` does not have, in any spelling, made from ``names``."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        c = f"__{name}"
        while c.lower() in taken:
            c += "_"
        taken.add(c.lower())
        out.append(c)
    return out


def columns(names: list[str]) -> list[Column]:
    """Columns by their names, whatever characters these have."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in names]


def sheltered(docs: DataFrame, taken: list[str], fn) -> DataFrame:
    """The rows of ``fn(docs)`` with the columns of ``docs``; those named as in ``taken`` have other names meanwhile."""
    away = {c: f"__own_{i}" for i, c in enumerate(docs.columns) if c in taken}
    out = fn(docs.withColumnsRenamed(away))
    return out.select(*[x.alias(c) for c, x in zip(docs.columns, columns([away.get(c, c) for c in docs.columns]), strict=True)])


_owner = ""


def hold(owner: str) -> None:
    """Called in a task by the module that works in it: what others keep in this worker goes, so that memos of several operators never add up.

    Modules of this subpackage with such memos have a function ``forget``.
    """
    global _owner
    if owner == _owner:
        return
    _owner = owner
    for name, module in list(sys.modules.items()):
        if name.startswith(f"{__package__}.") and name != owner and hasattr(module, "forget"):
            module.forget()
    gc.collect()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)  # glibc keeps freed memory otherwise


def digest_mod(key: Column, mod: int) -> Column:
    """crc32 of the key as text, modulo ``mod``; a null key counts as the empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % mod


def alnum_words(text: str | None) -> list[bytes]:
    """Words [^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+ of the text with A-Z lower-cased, as UTF-8."""
    return text.encode("utf-8", "surrogatepass").translate(ALNUM_TABLE).split() if text else []


def space_words(text: str | None) -> list[bytes]:
    """Words [^\\x20\\x09-\\x0D]+ of the text with A-Z lower-cased, as UTF-8."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def map_text(df: DataFrame, make, added: str, inputs: list[str]) -> DataFrame:
    """Adds the columns of the DDL string ``added``, computed batch by batch in Python.

    ``make`` is called once in each task and gives a function from the lists of the
    ``inputs`` columns to the added columns as lists or Arrow arrays. The other
    columns pass through as they are; input columns that bear an added name are replaced.
    """
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_type
    from pyspark.sql.types import StructField, StructType

    new = StructType.fromDDL(added)
    keep = [f for f in df.schema.fields if f.name not in new.names]
    kinds = [to_arrow_type(f.dataType) for f in new.fields]
    names = [f.name for f in keep] + new.names
    need = list(dict.fromkeys([f.name for f in keep] + inputs))
    plain = {c: f"c{i}" for i, c in enumerate(need)}  # Spark's mapInArrow takes no dots in names
    through = [plain[f.name] for f in keep]
    short_batches(df.sparkSession)
    owner = make.__module__

    def run(batches):
        hold(owner)
        fn = make()
        for b in batches:
            got = fn(*[b.column(plain[c]).to_pylist() for c in inputs])
            cols = [c if isinstance(c, pa.Array) else pa.array(c, k) for c, k in zip(got, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(c) for c in through] + cols, names=through + new.names)

    out = StructType([StructField(plain[f.name], f.dataType, f.nullable) for f in keep] + new.fields)
    return df.select(*[c.alias(plain[n]) for c, n in zip(columns(need), need, strict=True)]).mapInArrow(run, out).toDF(*names)

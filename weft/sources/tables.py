"""Scans and sinks: JSON lines, delimited and marked-up text, sectioned files; explicit schemas, nothing inferred."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

_made: list[tuple[SparkSession, str]] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _drop() -> None:
    while _made:
        spark, path = _made.pop()
        sc = spark.sparkContext
        if sc._jsc is not None and not sc._jsc.sc().isStopped():
            p = sc._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(sc._jsc.hadoopConfiguration()).delete(p, True)


def scratch(spark: SparkSession) -> str:
    """A new folder's path below the one that the cluster shares; it goes when Python ends."""
    top = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not top:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir is unset: it must name a folder that all executors share")
        top = "file://" + tempfile.mkdtemp(prefix="weft-")
        spark.sparkContext.setCheckpointDir(top)
    if not _made:
        atexit.register(_drop)
    path = f"{top.rstrip('/')}/weft-table-{uuid.uuid4().hex}"
    _made.append((spark, path))
    return path


def kept(df: DataFrame) -> DataFrame:
    """``df`` written to the folder that the cluster shares and read back: lineage ends, lost executors cost nothing."""
    spark, path = df.sparkSession, scratch(df.sparkSession)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Rows that one task sorts or groups, about, whatever the table's size: some hundred MB.
TASK_ROWS = 500_000


def in_tasks(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """``df`` of about ``rows`` rows dealt by ``keys`` over as many tasks as these need, and as the session's shuffles have at least.

    The number is fixed, so small parts are not put together again: a task's memory does not grow with the table, only their number does.
    """
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(max(least, -(-rows // TASK_ROWS)), *keys)


def _fs(spark: SparkSession, path: str):
    """The file system of a path, and the path in it."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def dropped(df: DataFrame) -> None:
    """Deletes the table that ``kept`` gave, once nothing reads it any more."""
    files = set(df.inputFiles())
    for spark, path in [m for m in _made if any(m[1].rpartition("/")[2] in f for f in files)]:
        _delete(spark, path)
        _made.remove((spark, path))


@contextlib.contextmanager
def scratch_scope():
    """Tables that ``kept`` writes within go at its end, but for those that were there before."""
    before = len(_made)
    yield
    for spark, path in _made[before:]:
        _delete(spark, path)
    del _made[before:]


def done(spark: SparkSession, path: str) -> bool:
    """Whether a table was written to ``path`` to its end."""
    return _exists(spark, f"{path.rstrip('/')}/_SUCCESS")


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(p) is not None and len(p.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(p)) > 0


def read_jsonl(spark: SparkSession, path: str, schema: str | StructType, mode: str = "strict", missing_ok: bool = False) -> DataFrame:
    """JSON lines. ``strict`` fails on a bad line, ``permissive`` drops it; a missing file fails unless it may be missing."""
    kind = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    if missing_ok and not _exists(spark, path):
        return spark.createDataFrame([], kind)
    return spark.read.schema(kind).option("mode", {"strict": "FAILFAST", "permissive": "DROPMALFORMED"}[mode]).json(path)


def read_document(spark: SparkSession, path: str, schema: str | StructType, fallback: DataFrame | None = None) -> DataFrame:
    """One JSON value over many lines; the fallback where the file is missing."""
    if fallback is not None and not _exists(spark, path):
        return fallback
    return spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(path)


def read_records(spark: SparkSession, path: str | list[str], sep: str = "\n") -> DataFrame:
    """(file, pos, value, closed) of text files whose records end with ``sep``: read by many tasks, whatever a file's size.

    A record's place in its file is that in its part of the file and the records of the parts before, which are counted first; so the
    text is read twice and not shuffled. ``closed`` is false for what stands after a file's last separator.
    """
    own = spark.read.option("lineSep", sep).text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("_at"), F.col("_metadata.file_size").alias("_size"), "value", F.monotonically_increasing_id().alias("_id")
    )
    width = len(sep.encode())
    parts = own.groupBy("file", "_at").agg(F.min("_id").alias("_first"), F.count("*").alias("_n"), F.sum(F.octet_length("value") + width).alias("_bytes"), F.max("_size").alias("_of"))
    w = Window.partitionBy("file")
    before = F.coalesce(F.sum("_n").over(w.orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = parts.select("file", "_at", (before - F.col("_first")).alias("_shift"), (F.sum("_n").over(w) - 1).alias("_last"), (F.sum("_bytes").over(w) == F.col("_of")).alias("_ended"))
    pos = F.col("_id") + F.col("_shift")
    return own.join(starts, ["file", "_at"]).select("file", pos.alias("pos"), "value", ((pos < F.col("_last")) | F.col("_ended")).alias("closed"))


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, pos, line) of text files, without empty lines, which count in ``pos``; carriage returns go. Files of any size: see ``read_records``."""
    return read_records(spark, path).select("file", "pos", F.regexp_replace("value", "\r", "").alias("line")).filter("line <> ''")


def listed(spark: SparkSession, folder: str, names: str = ".*") -> list[str]:
    """Paths of the folder's files whose name matches the regular expression, in order of their names; hidden files and folders are left out."""
    import re

    p = spark._jvm.org.apache.hadoop.fs.Path(folder)
    found = p.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(p)
    own = [(s.getPath().getName(), s.getPath().toString()) for s in found if s.isFile()]
    return [path for name, path in sorted(own) if not name.startswith(".") and re.search(names, name)]


def read_files(spark: SparkSession, folder: str, names: str = ".*") -> DataFrame:
    """(file, file_no, pos, line) of the files that ``listed`` gives; ``file_no`` is their place, from 0."""
    paths = listed(spark, folder, names)
    if not paths:
        return spark.createDataFrame([], "file string, file_no int, pos long, line string")
    stem = lambda c: F.element_at(F.split(c, "/"), -1)
    order = spark.createDataFrame([(i, p.rpartition("/")[2]) for i, p in enumerate(paths)], "file_no int, _name string")
    lines = read_lines(spark, paths)
    return lines.join(F.broadcast(order), stem("file") == F.col("_name")).select("file", "file_no", "pos", "line")  # a row a file


def read_captured(spark: SparkSession, path: str, row: str, source: str, n_rows: int | None = None, title: str = ".*") -> DataFrame:
    """Rows of one JSON capture {source_id, count, rows}; raises unless its shape is right.

    The source is the expected one, the count is that of the rows (and ``n_rows`` if given), each title matches, and no row comes twice.
    ``row`` is the DDL of a row's struct with ``title``.
    """
    c = read_document(spark, path, f"source_id string, count long, rows array<struct<{row}>>")
    head = c.select("source_id", "count", F.size("rows").cast("long").alias("n")).first()
    if head is None or head.source_id != source or head["count"] != head.n or (n_rows is not None and head.n != n_rows):
        raise ValueError(f"not a whole capture of {source}: {head}")
    rows = c.select(F.explode("rows").alias("r")).select("r.*")
    if bad := rows.filter(~F.coalesce(F.col("title").rlike(title), F.lit(False))).first():
        raise ValueError(f"a row of another kind: {bad.title!r}")
    if twice := rows.groupBy(*rows.columns).count().filter("count > 1").first():
        raise ValueError(f"a row twice: {twice.title!r}")
    return rows


def verse_texts(lines: DataFrame, books: Column, ref: Column | None = None) -> DataFrame:
    """(book, chapter, verse, passage, text) of lines ``reference TAB text``; the book is told by the file's name, which ``books`` maps.

    References are ``chapter:verse`` at the end of what stands before the tab. Of several lines of a verse the last counts.
    """
    from weft.functions.text import folded

    stem = F.regexp_extract("file", r"([^/]+?)\.[^./]*$", 1)
    head = F.regexp_extract("line", r"^\x{FEFF}?([^\t]*)\t", 1) if ref is None else ref
    part = lambda k: F.regexp_extract(head, r"(\d+):(\d+)\s*$", k).try_cast("int")
    rows = lines.filter(F.contains("line", F.lit("\t"))).select(
        "file", "pos", F.element_at(books, stem).alias("book"), part(1).alias("chapter"), part(2).alias("verse"), folded(F.regexp_extract("line", r"^[^\t]*\t(.*)$", 1)).alias("text")
    )
    rows = rows.filter("book IS NOT NULL AND chapter IS NOT NULL AND verse > 0")
    one = rows.groupBy("book", "chapter", "verse").agg(F.max_by("text", F.struct("file", "pos")).alias("text"))
    return one.withColumn("passage", F.concat(F.col("book"), F.lit(" "), F.col("chapter").cast("string"), F.lit(":"), F.col("verse").cast("string")))


def marked_names(passages: DataFrame, text: str = "text") -> DataFrame:
    r"""Adds ``names``, the marked names (``\pn ..\pn*``, nested marks too) of a passage, in order and distinct, and takes the marks from the text."""
    found = F.regexp_extract_all(text, F.lit(r"\\\+?pn\s+(.+?)\\\+?pn\*"), 1)
    plain = F.trim(F.regexp_replace(F.regexp_replace(text, r"\\\+?pn(?:\*|\s+)", ""), r"\s+", " "))
    return passages.withColumns({"names": F.array_distinct(F.transform(found, lambda x: F.trim(x))), text: plain})


def name_lemmas(lines: DataFrame, books: Column) -> DataFrame:
    """(passage, lemmas) of tagged lines ``Book.c.v#...``: the sorted consonants of lemmas ``{H0001=lemma=...}`` on lines tagged as proper names (``HNp``).

    ``books`` maps upper-case codes to those wanted; codes that it lacks stay.
    """
    from weft.functions.text import skeleton

    form = r"^([1-3]?[A-Za-z]{2,4})\.(\d+)\.(\d+)#"
    own = F.upper(F.regexp_extract("line", form, 1))
    passage = F.concat(F.coalesce(F.element_at(books, own), own), F.lit(" "), F.regexp_extract("line", form, 2), F.lit(":"), F.regexp_extract("line", form, 3))
    rows = lines.filter(F.col("line").rlike(r"(?i)\bHNp[a-z]*") & F.col("line").rlike(form))
    one = rows.select(passage.alias("passage"), F.explode_outer(F.regexp_extract_all("line", F.lit(r"\{H\d{4}[A-Z]?=([^=}]+)="), 1)).alias("l"))
    one = one.withColumn("l", F.nullif(skeleton(F.col("l")), F.lit("")))
    return one.groupBy("passage").agg(F.array_sort(F.collect_set("l")).alias("lemmas"))


def code_lines(lines: DataFrame, books: Column, pattern: str = r"\b([GH][0-9]{4}[A-Z]?)\b") -> DataFrame:
    """(file, pos, codes, refs) of lines with codes: the distinct codes, and the passages they name; rules of equals signs are no lines."""
    found = F.array_distinct(F.transform(F.regexp_extract_all("line", F.lit(pattern), 1), F.upper))
    plain = F.regexp_replace("line", r"[\x{200b}-\x{200d}]", "")
    form = r"\b([1-3]?[A-Za-z]{2,4})\.([0-9]{1,3})[.\-]([0-9]{1,3})"
    raw = F.regexp_extract_all(plain, F.lit(form), 0)
    part = lambda x, k: F.regexp_extract(x, form, k)

    def passage(x: Column) -> Column:
        book = F.element_at(books, F.lower(part(x, 1)))
        return F.concat(book, F.lit(" "), part(x, 2).cast("int").cast("string"), F.lit(":"), part(x, 3).cast("int").cast("string"))

    rows = lines.filter(~F.col("line").rlike(r"^=+$")).select("file", "pos", found.alias("codes"), F.array_distinct(F.array_compact(F.transform(raw, passage))).alias("refs"))
    return rows.filter(F.size("codes") > 0)


def code_inventory(parsed: DataFrame, files: DataFrame) -> DataFrame:
    """``files`` (as ``file_inventory`` gives) with ``data_lines``, ``n_refs`` and ``books`` of the code lines."""
    n = parsed.groupBy("file").agg(F.count("*").alias("data_lines"))
    refs = parsed.select("file", F.explode("refs").alias("r")).distinct()
    r = refs.groupBy("file").agg(F.count("*").alias("n_refs"), F.array_sort(F.collect_set(F.element_at(F.split("r", " "), 1))).alias("books"))
    name = lambda d: d.withColumn("_name", F.element_at(F.split("file", "/"), -1)).drop("file")
    out = files.withColumn("_name", F.element_at(F.split("file", "/"), -1)).join(name(n), "_name", "left").join(name(r), "_name", "left").drop("_name")
    return out.withColumns({"data_lines": F.coalesce("data_lines", F.lit(0)), "n_refs": F.coalesce("n_refs", F.lit(0)), "books": F.coalesce("books", F.array().cast("array<string>"))})


def file_inventory(spark: SparkSession, path: str) -> DataFrame:
    """(file, bytes, sha256, lines) of each file."""
    b = spark.read.format("binaryFile").load(path)
    newlines = F.length(F.col("content").cast("string")) - F.length(F.replace(F.col("content").cast("string"), F.lit("\n"), F.lit("")))
    return b.select(F.col("path").alias("file"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"), newlines.cast("long").alias("lines"))


def lock_violations(inventory: DataFrame, registry: DataFrame) -> DataFrame:
    """Registered files that are missing or whose bytes, hash or lines differ; files that are not registered."""
    i = inventory.select(F.element_at(F.split("file", "/"), -1).alias("name"), "bytes", "sha256", "lines")
    r = registry.select("name", *[F.col(c).alias(f"want_{c}") for c in ("bytes", "sha256", "lines")])
    both = i.join(r, "name", "full")
    fault = (
        F.when(F.col("sha256").isNull(), "missing").when(F.col("want_sha256").isNull(), "unregistered").when(F.col("sha256") != F.col("want_sha256"), "hash")
        .when(F.col("bytes") != F.col("want_bytes"), "bytes").when(F.col("lines") != F.col("want_lines"), "lines")
    )
    return both.withColumn("fault", fault).filter("fault IS NOT NULL").select("name", "fault")


def child_references(children: DataFrame, books: Column, old: list[str], new: list[str]) -> DataFrame:
    """One row for each reference of child rows (``child_rows``): passage, testament (ot, nt or null) and whether it is of the Greek version alone."""
    from weft.functions.text import reference, testament

    # the mark of the Greek version stands before the reference it is for
    one = children.select("*", F.explode(F.regexp_extract_all("raw_refs", F.lit(r"(?i)(?:LXX\s*)?[1-3]?[A-Za-z]+\.\d+\.\d+[a-z]?(?:-\S+)?"), 0)).alias("_raw"))
    one = one.withColumn("_ref", reference(F.col("_raw"), books)).filter("_ref IS NOT NULL")
    return one.select(*children.columns, F.col("_ref.passage").alias("passage"), testament(F.col("_ref.book"), old, new).alias("testament"), F.col("_ref.lxx").alias("lxx"))


def sectioned(lines: DataFrame, opens: Column, closes: Column, header: Column, child: Column) -> DataFrame:
    """Records of a sectioned file: lines between an opening and a closing marker, each child under the last header.

    ``lines`` has file, pos and line. A header that is later skipped still takes its own
    children, so they never fall to the record before it.
    """
    from weft.operators.scans import running, segment_of

    at = segment_of("pos")
    marked = running(lines, ["file"], ["pos"], {"_open": F.when(opens, 1).when(closes, 0)}, segment=at).filter(F.col("_open") == 1).filter(~(opens | closes)).drop("_open")
    kind = F.when(child, "child").when(header, "header")
    marked = marked.withColumn("kind", kind).filter("kind IS NOT NULL")
    return running(marked, ["file"], ["pos"], counts={"record": F.col("kind") == "header"}, segment=at).filter("record > 0")


def usfm_passages(lines: DataFrame) -> DataFrame:
    r"""(file, book, chapter, verse, text) of ``\id``, ``\c`` and ``\v`` markup; continuation lines are appended."""
    from weft.operators.scans import running, segment_of

    marked = running(lines, ["file"], ["pos"], {
        "book": F.nullif(F.regexp_extract("line", r"^\\id\s+(\S+)", 1), F.lit("")),
        "chapter": F.nullif(F.regexp_extract("line", r"\\c\s+(\d+)", 1), F.lit("")),
    }, segment=segment_of("pos")).withColumn("chapter", F.col("chapter").cast("int"))
    body = marked.filter(~F.col("line").rlike(r"^\\(id|c)\s"))
    # what stands before the first mark of a line goes on with the verse before it
    pieces = body.select("file", "pos", "book", "chapter", F.posexplode(F.split("line", r"(?=\\v\s+\d)")).alias("k", "piece")).filter("piece <> ''")
    number = F.nullif(F.regexp_extract("piece", r"^\\v\s+(\d+)", 1), F.lit("")).cast("int")
    last = F.nullif(F.regexp_extract("piece", r"^\\v\s+\d+-(\d+)", 1), F.lit("")).cast("int")
    pieces = running(pieces.withColumn("own", number), ["file", "book", "chapter"], ["pos", "k"], {"verse": number, "last": F.when(number.isNotNull(), F.coalesce(last, number))}, segment=segment_of("pos"))
    text = F.trim(F.regexp_replace("piece", r"^\\v\s+\d+(?:-\d+)?\s*", ""))
    parts = pieces.filter("verse IS NOT NULL").select("file", "book", "chapter", "verse", "last", F.struct("pos", "k", text.alias("t")).alias("p"))
    whole = parts.groupBy("file", "book", "chapter", "verse", "last").agg(F.array_join(F.transform(F.sort_array(F.collect_list("p")), lambda p: p["t"]), " ").alias("text"))
    return whole.withColumn("verse", F.explode(F.sequence("verse", F.greatest("verse", "last")))).drop("last")


def write_jsonl(df: DataFrame, path: str, one_file: bool = False) -> None:
    (df.coalesce(1) if one_file else df).write.mode("overwrite").option("ignoreNullFields", False).json(path)


def write_report(rows: DataFrame, path: str, most: int = 1000) -> None:
    """At most ``most`` rows, a report's, as indented JSON with sorted keys: one row as an object, several as a list. Raises beyond that."""
    import json

    found = rows.limit(most + 1).toJSON().collect()
    if len(found) > most:
        raise ValueError(f"a report has at most {most} rows")
    values = [json.loads(x) for x in found]
    _put(rows.sparkSession, path, json.dumps(values[0] if len(values) == 1 else values, indent=2, sort_keys=True, ensure_ascii=False) + "\n")


def _put(spark: SparkSession, path: str, text: str) -> None:
    """One small file, written beside its place and renamed."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    to = jvm.org.apache.hadoop.fs.Path(path)
    fs = to.getFileSystem(conf)
    tmp = jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.tmp")
    out = fs.create(tmp, True)
    out.write(bytearray(text.encode()))
    out.close()
    _swap(fs, tmp, to)


def _swap(fs, tmp, to) -> None:
    old = None
    if fs.exists(to):
        old = to.suffix(f".{uuid.uuid4().hex}.old")
        if not fs.rename(to, old):
            raise OSError(f"cannot move {to.toString()}")
    if not fs.rename(tmp, to):
        if old is not None:
            fs.rename(old, to)
        raise OSError(f"cannot move {tmp.toString()} to {to.toString()}")
    if old is not None:
        fs.delete(old, True)


def write_atomic(df: DataFrame, path: str, write=None) -> None:
    """Writes beside ``path`` and swaps when the job is done: a job that fails leaves what was there.

    ``write`` takes (df, path); Parquet by default. The rows may come from ``path`` itself.
    """
    spark = df.sparkSession
    tmp = f"{path.rstrip('/')}.{uuid.uuid4().hex}.tmp"
    try:
        (write or (lambda d, p: d.write.parquet(p)))(df, tmp)
        p = spark._jvm.org.apache.hadoop.fs.Path(tmp)
        _swap(p.getFileSystem(spark._jsc.hadoopConfiguration()), p, spark._jvm.org.apache.hadoop.fs.Path(path.rstrip("/")))
    finally:
        p = spark._jvm.org.apache.hadoop.fs.Path(tmp)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def write_csv(df: DataFrame, path: str) -> None:
    """All values quoted, null as the empty text, with a header."""
    df.select([F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in df.columns]).write.mode("overwrite").option("header", True).option("quoteAll", True).option("escape", '"').option("emptyValue", "").csv(path)


def write_if_small(df: DataFrame, path: str, most: int = 200_000) -> bool:
    """Writes unless there are more than ``most`` rows; then removes what an earlier run left. True if written."""
    spark = df.sparkSession
    small = df.limit(most + 1).count() <= most
    if small:
        df.write.mode("overwrite").parquet(path)
    elif _exists(spark, path):
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
    return small


def child_rows(lines: DataFrame, line: str = "line") -> DataFrame:
    """Parts of tab-separated child rows: significance, text, language, scope, status and references.

    Fields are significance, raw name, form, translation, an unused one, references; without
    references the status is pending. The language is told by the script.
    """
    part = lambda i: F.trim(F.coalesce(F.get(F.split(line, "\t"), F.lit(i)), F.lit("")))
    text = part(2)
    language = F.when(text.rlike(r"\p{IsGreek}"), "grc").when(text.rlike(r"\p{IsHebrew}"), "hbo").otherwise("latn")
    refs = F.filter(F.transform(F.split(part(5), r"[;,\s]+"), lambda x: F.trim(x)), lambda x: x != "")
    significance = F.regexp_replace(part(0), r"^[–\-]\s*", "")
    return lines.select(
        "*", part(5).alias("raw_refs"), significance.alias("significance"), text.alias("text"), language.alias("language"), F.when(significance.rlike("(?i)^name"), "canonical").otherwise("variant").alias("scope"),
        F.when(F.size(refs) > 0, "accepted").otherwise("pending").alias("status"), refs.alias("refs"),
    )


def xml_passages(spark: SparkSession, path: str) -> DataFrame:
    """(file, ref, text) of ``<verse ref="...">`` elements; repeated references are joined in order. A file is split at closing tags, so it may have any size."""
    found = read_records(spark, path, "</verse>").filter("closed").select("file", "pos", F.regexp_extract(F.concat("value", F.lit("</verse>")), r"(?s)<verse\b[^>]*>.*", 0).alias("x")).filter("x <> ''")
    body = F.trim(F.regexp_replace(F.regexp_replace("x", r"<[^>]*>", " "), r"\s+", " "))
    one = found.select("file", F.regexp_extract("x", r"""\bref\s*=\s*["']([^"']*)["']""", 1).alias("ref"), "pos", body.alias("t"))
    return one.groupBy("file", "ref").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("pos", "t"))), lambda s: s["t"]), " ").alias("text"))


def token_counts(passages: DataFrame, text: str, pattern: str, *keys: str) -> DataFrame:
    """(keys, token, n): how often each match of the pattern occurs in a passage."""
    return passages.select(*keys, F.explode(F.regexp_extract_all(text, F.lit(pattern), 0)).alias("token")).groupBy(*keys, "token").agg(F.count("*").alias("n"))


def tagged_codes(lines: DataFrame, pattern: str = r"[GH]\d{4}[A-Z]?") -> DataFrame:
    """(ref, codes) of lines that begin with a reference and a tab: the set of codes of all lines of a reference."""
    ref = F.regexp_extract("line", r"^(\S+)\t", 1)
    hit = lines.select(ref.alias("ref"), F.regexp_extract_all("line", F.lit(pattern), 0).alias("c")).filter("ref <> ''")
    return hit.groupBy("ref").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("c")))).alias("codes"))

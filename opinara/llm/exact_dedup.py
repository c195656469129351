"""Which documents are copies of each other, decided by a stream with keyed state.

Every document becomes a small record: digest of its normalised text, doc_id and content locator (file and row).
A Structured Streaming query keeps, per digest, the record to stay and the number of copies. Its state lives in
RocksDB on disk and never expires, so a copy is found however late it comes; a restart goes on from the checkpoint.
Records are reduced per task before they are shuffled, so a digest with very many copies is no burden for one task.

A digest is no proof: the texts of every hit are fetched by their locators and compared byte by byte. Texts that
share only the digest would be grouped by their full text.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opinara.llm.common import likely_members, split_by, stored, unused_name
from opinara.session import shared_dir

#: Micro-batches that the records of a table are read in.
BATCHES = 3
STATE = "spark.sql.streaming.stateStore."
#: State on disk; no file space reserved ahead in every partition; only changes are written per batch.
STATE_STORE = {STATE + "providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
               STATE + "rocksdb.allowFAllocate": "false", STATE + "rocksdb.changelogCheckpointing.enabled": "true"}


def normalised(text: Column) -> Column:
    """Runs of ASCII white space become one space; null is empty."""
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), "[\\x20\\x09-\\x0D]+", " ")


def located(docs: DataFrame) -> DataFrame:
    """doc_id, text and the locator of the row (file, row); documents that are not plain file scans are stored first."""
    locator = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")]
    try:
        return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *locator)
    except AnalysisException:
        return stored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")).select("doc_id", "text", *locator)


def records(rows: DataFrame) -> DataFrame:
    """One small record per document: digest, doc_id, file, row."""
    return rows.select(F.sha2(normalised(F.col("text")), 256).alias("digest"), "doc_id", "file", "row")


def keepers(stream: DataFrame) -> DataFrame:
    """The stateful part: per digest the record with the smallest doc_id (then file, row) and the number of records."""
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "file", "row")
    return stream.groupBy("digest").agg(F.min(order).alias("first"), F.count("*").alias("copies"))


def drain(spark: SparkSession, path: str, schema, root: str, files_per_batch: int | None = None) -> DataFrame:
    """Run the stream over all records under `path`; returns the last state of every digest.

    State and results are under `root`. Running it again with the same root takes only new records.
    """
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)

    def keep(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("version", F.lit(batch_id)).write.mode("overwrite").parquet(f"{root}/states/batch={batch_id}")

    before = {k: spark.conf.get(k, None) for k in STATE_STORE}
    for k, v in STATE_STORE.items():
        spark.conf.set(k, v)
    try:
        (keepers(reader.parquet(path)).writeStream.outputMode("update").option("checkpointLocation", f"{root}/checkpoint")
         .foreachBatch(keep).trigger(availableNow=True).start().awaitTermination())
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    empty = spark.createDataFrame([], "digest string, first struct<none:boolean,doc_id:long,file:string,row:long>, "
                                      "copies long, version long")
    try:
        states = spark.read.schema(empty.schema).parquet(f"{root}/states/*")
    except AnalysisException:  # no record at all, so no batch
        states = empty
    return states.groupBy("digest").agg(F.max_by("first", "version").alias("first"),
                                        F.max_by("copies", "version").alias("copies"))


def copies(docs: DataFrame, files_per_batch: int | None = None, batches: int = BATCHES) -> DataFrame:
    """Every row of `docs` with the document that stays for it.

    The records go through the stream in about `batches` micro-batches, or with so many files in each, so that later ones
    meet the state that earlier ones left on disk.

    docs: doc_id, text; other columns are ignored. Returns doc_id, keep_id (smallest doc_id with the same normalised
    text), group_size, kept, text_sha256 and the locator (file, row) of the row. Of rows that repeat the smallest
    doc_id with the same text, the first by locator is kept. A null text counts as empty. A null doc_id sorts last;
    it is kept only if no copy has an id. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    rows = located(docs)
    root = f"{shared_dir(spark)}/dedup-{uuid.uuid4().hex}"
    known = records(rows)
    known.write.parquet(f"{root}/records")
    known = spark.read.schema(known.schema).parquet(f"{root}/records")
    per_batch = files_per_batch or max(1, -(-len(known.inputFiles()) // batches))
    state = stored(drain(spark, f"{root}/records", known.schema, root, per_batch))

    matched = known.join(state, "digest")
    hit = matched.where("copies > 1")
    same = stored(_compared(rows, hit))
    if same.where("not same").isEmpty():
        groups = matched.select("digest", "doc_id", "file", "row", "first", "copies")
    else:
        groups = _regrouped(rows, matched, same)
    return groups.select(
        "doc_id", F.col("first.doc_id").alias("keep_id"), F.col("copies").alias("group_size"),
        ((F.col("file") == F.col("first.file")) & (F.col("row") == F.col("first.row"))).alias("kept"),
        F.col("digest").alias("text_sha256"), "file", "row")


def without_copies(docs: DataFrame) -> DataFrame:
    """Rows of `docs` that stay, all columns unchanged: one of each group of equal texts.

    Null texts count as empty, a null doc_id stays only if no copy has an id, of repeated rows one stays, an empty table
    stays empty. What is not a plain file scan is stored first, so that its rows have places.
    """
    try:
        docs.select("_metadata.row_index")
    except AnalysisException:
        docs = stored(docs)
    gone = stored(copies(docs).where("not kept").select("doc_id", "file", "row"))
    file, row = unused_name(docs, "file"), unused_name(docs, "row")
    rows = docs.select("*", F.col("_metadata.file_path").alias(file), F.col("_metadata.row_index").alias(row))
    maybe, others = split_by(rows, gone.select("doc_id"))
    both = gone.select(F.col("file").alias(file), F.col("row").alias(row))
    if not gone.where("doc_id is null").isEmpty():  # cannot be told by id
        maybe, others = rows, rows.limit(0)
    return maybe.join(both, [file, row], "left_anti").select(rows.columns).union(others).drop(file, row)


def _compared(rows: DataFrame, hits: DataFrame) -> DataFrame:
    """file, row and whether the bytes of the row equal those of the record its digest keeps."""
    wanted = hits.select(F.coalesce("doc_id", F.lit(0)).alias("id")).distinct()
    near = likely_members(rows.select(F.coalesce("doc_id", F.lit(0)).alias("doc_id"), "text", "file", "row"), wanted)
    texts = stored(near.join(hits.select("file", "row", "digest", "first"), ["file", "row"])
                   .select("file", "row", "digest", "first", normalised(F.col("text")).alias("body")))
    is_first = (F.col("file") == F.col("first.file")) & (F.col("row") == F.col("first.row"))
    heads = texts.where(is_first).select("digest", F.col("body").alias("head"))
    return texts.where(~is_first).join(heads, "digest").select("file", "row", (F.col("body") == F.col("head")).alias("same"))


def _regrouped(rows: DataFrame, matched: DataFrame, same: DataFrame) -> DataFrame:
    """Groups where some texts share only a digest: those texts are grouped by themselves."""
    flagged = matched.join(same, ["file", "row"], "left").withColumn("same", F.coalesce("same", F.lit(True)))
    odd = (rows.select("file", "row", normalised(F.col("text")).alias("body"))
           .join(flagged.where("not same").drop("first", "copies"), ["file", "row"]))
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "file", "row")
    by_text = odd.groupBy("digest", "body").agg(F.min(order).alias("first"), F.count("*").alias("copies"))
    even = flagged.where("same")
    sizes = even.groupBy("digest").agg(F.count("*").alias("copies"))
    columns = ["digest", "doc_id", "file", "row", "first", "copies"]
    return (even.drop("copies").join(sizes, "digest").select(columns)
            .union(odd.join(by_text, ["digest", "body"]).select(columns)))

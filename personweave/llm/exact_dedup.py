"""Exact deduplication by an exchange of Golomb-coded fingerprints.

1. Every scan task cuts its rows into senders of bounded size, fingerprints each text, and writes the rows once, bucketed
   by sender. Beside them it writes, for each owner of a fingerprint range, its distinct fingerprints sorted and coded.
2. An owner decodes what all senders sent it and answers each with a bitmap: which of them another sender has as well.
3. The bitmaps go back to the senders' buckets; the rows are not shuffled for it. A row is a suspect if its bit is set or
   if its own sender has the fingerprint twice.
4. Only suspects' texts are shuffled, after equal ones of a task are collapsed, and compared byte by byte.

A frequent text costs one fingerprint per sender and one aggregated row per task, so a hot group loads no single task.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from personweave.llm import golomb
from personweave.sources.scratch import scratch_root, scratch_table

WHITE_SPACE = r"[\x20\x09-\x0D]+"
FINGERPRINT_BITS = 60  # 15 hex digits of the digest, a non-negative long
SENDER_ROWS = 1 << 17
SENDER_BYTES = 32 << 20
MAX_BUCKETS = 50_000
OWNER_ROWS = 1 << 21


def normalised(text: Column) -> Column:
    return F.regexp_replace(text, WHITE_SPACE, "")


def _with_sender(table: pa.Table, sender: int, shift: int) -> Iterator[pa.RecordBatch]:
    """The rows of one sender with their place in its bitmap, then one row per owner with the coded fingerprints."""
    values, inverse, counts = np.unique(table["fp"].to_numpy(), return_inverse=True, return_counts=True)
    owners, starts, sizes = np.unique(values >> shift, return_index=True, return_counts=True)
    first_byte = np.cumsum((sizes + 7) // 8) - (sizes + 7) // 8
    slot = np.arange(len(values)) - np.repeat(starts, sizes) + 8 * np.repeat(first_byte, sizes)
    n = table.num_rows
    columns = {name: table[name] for name in ("doc_id", "record", "n_chars", "text_sha256")} | {
        "sender": pa.array(np.full(n, sender, np.int64)), "seq": pa.array(np.arange(n, dtype=np.int64)),
        "slot": pa.array(slot[inverse].astype(np.int64)), "repeated": pa.array(counts[inverse] > 1)}
    codes = [golomb.encode(values[a:a + k] - (int(o) << shift)) for o, a, k in zip(owners, starts, sizes)]
    sent = {"sender": pa.array(np.full(len(owners), sender, np.int64)), "owner": pa.array(owners.astype(np.int64)),
            "code": pa.array(codes, pa.binary())}
    both = columns | sent
    for part, rows in ((columns, n), (sent, len(owners))):
        yield from pa.table({name: part.get(name, pa.nulls(rows, kind.type)) for name, kind in both.items()}
                            ).to_batches(max_chunksize=4096)


def _senders(shift: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, held, rows, size = TaskContext.get().partitionId() << 20, [], 0, 0
        for batch in batches:
            held.append(batch)
            rows, size = rows + batch.num_rows, size + batch.nbytes
            if rows >= SENDER_ROWS or size >= SENDER_BYTES:
                yield from _with_sender(pa.Table.from_batches(held), first, shift)
                first, held, rows, size = first + 1, [], 0, 0
        if rows:
            yield from _with_sender(pa.Table.from_batches(held), first, shift)
    return run


def _answers(group: pa.Table) -> pa.Table:
    """One owner: for each sender the bitmap of its fingerprints that another sender sent, too."""
    lists = [golomb.decode(code.as_py()) for code in group["code"]]
    values, inverse, counts = np.unique(np.concatenate(lists), return_inverse=True, return_counts=True)
    shared = np.split(counts[inverse] > 1, np.cumsum([len(x) for x in lists])[:-1])
    return pa.table({"sender": group["sender"], "owner": group["owner"],
                     "bitmap": pa.array([np.packbits(x).tobytes() for x in shared], pa.binary())})


def _exchange(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The stored rows, and for each sender one bitmap over all owners."""
    spark = rows.sparkSession
    # Enough owners to keep all tasks busy, and as many more as keep an owner's fingerprints few, however many the rows.
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    owners = max(16, 4 * partitions, rows.count() // OWNER_ROWS)
    shift = FINGERPRINT_BITS - (owners - 1).bit_length()
    stored = T.StructType([
        *(T.StructField(name, rows.schema[name].dataType) for name in ("doc_id", "record", "n_chars", "text_sha256")),
        *(T.StructField(name, T.LongType()) for name in ("sender", "seq", "slot")), T.StructField("repeated", T.BooleanType()),
        T.StructField("owner", T.LongType()), T.StructField("code", T.BinaryType())])
    sent = rows.mapInArrow(_senders(shift), stored)
    name = f"exact_dedup_{uuid.uuid4().hex}"
    path = f"{scratch_root(spark)}/{spark.sparkContext.applicationId}/{name}"
    (sent.write.bucketBy(min(MAX_BUCKETS, max(1, rows.rdd.getNumPartitions())), "sender")
     .option("path", path).saveAsTable(name))
    table = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # the catalog forgets it, the files stay for the plans below
    answers = (table.where(F.col("owner").isNotNull()).select("sender", "owner", "code")
               .groupBy("owner").applyInArrow(_answers, "sender long, owner long, bitmap binary"))
    bitmaps = answers.groupBy("sender").agg(F.expr("listagg(bitmap) WITHIN GROUP (ORDER BY owner)").alias("bitmap"))
    return table.where(F.col("owner").isNull()), scratch_table(bitmaps, "bitmaps")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: bool = False) -> DataFrame:
    """`doc_id`, `keep_id`, `group_size`, `kept`, `text_sha256` for every row of `docs`; with `carry` also `record`, a
    struct of all columns of `docs`.

    Texts are equal if they agree after deleting the six ASCII white-space characters. Of equal texts, the row with the
    most code points stays, then the one with the smallest id.

    Null texts count as empty, and all empty texts are equal. A row without an id loses every tie; a group of such rows
    only has a null `keep_id`. Of repeated rows (same id and text) exactly one is `kept`. An empty table gives an empty
    result. Other columns are carried inside `record`, so their names cannot clash.
    """
    record = F.struct(*[docs[f"`{c}`"] for c in (docs.columns if carry else [text_col])])
    # The digest is computed once, in the scan; the text itself is read again for suspects only.
    text = F.coalesce(F.col("record").getField(text_col), F.lit(""))
    rows = (docs.select(docs[f"`{id_col}`"].cast("long").alias("doc_id"), record.alias("record"))
            .withColumns({"n_chars": F.char_length(text).cast("long"), "text_sha256": F.sha2(normalised(text), 256)})
            .withColumn("fp", F.conv(F.substring("text_sha256", 1, FINGERPRINT_BITS // 4), 16, 10).cast("long")))
    stored, bitmaps = _exchange(rows)
    place = F.col("slot")
    byte = F.conv(F.hex(F.expr("substring(bitmap, cast(slot div 8 as int) + 1, 1)")), 16, 10).cast("int")
    bit = F.floor(byte / F.pow(F.lit(2), 7 - place % 8)).cast("int") % 2
    flagged = (stored.join(bitmaps.hint("shuffle_hash"), "sender")
               .withColumn("suspect", F.col("repeated") | (bit == 1)))

    # Group by the bytes themselves: equal texts of a task become one row before the shuffle.
    best = F.max(F.struct("n_chars", F.bitwise_not("doc_id").alias("id"), F.bitwise_not("sender").alias("sender"),
                          F.bitwise_not("seq").alias("seq")))
    groups = (flagged.where("suspect")
              .select("text_sha256", "n_chars", "doc_id", "sender", "seq", normalised(text).alias("normal"))
              .groupBy("text_sha256", "normal").agg(F.count("*").alias("group_size"), best.alias("best"))
              .where(F.col("group_size") > 1)
              .select("text_sha256", "group_size", F.bitwise_not("best.id").alias("keep_id"),
                      F.bitwise_not("best.sender").alias("keep_sender"), F.bitwise_not("best.seq").alias("keep_seq")))
    # Only suspects are joined with their groups: the other rows stay where they are.
    columns = ["doc_id", "keep_id", "group_size", "kept", "text_sha256", *(["record"] if carry else [])]
    single = {"keep_id": F.col("doc_id"), "group_size": F.lit(1).cast("long"), "kept": F.lit(True)}
    alone = flagged.where(~F.col("suspect")).withColumns(single).select(*columns)
    found = F.col("group_size").isNotNull()
    member = {"keep_id": F.when(found, F.col("keep_id")).otherwise(F.col("doc_id")),
              "kept": ~found | ((F.col("sender") == F.col("keep_sender")) & (F.col("seq") == F.col("keep_seq"))),
              "group_size": F.coalesce("group_size", F.lit(1).cast("long"))}
    grouped = flagged.where("suspect").join(groups, "text_sha256", "left").withColumns(member).select(*columns)
    return alone.unionByName(grouped)

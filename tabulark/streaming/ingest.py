"""File-stream ingest: landed files -> dedupe -> upsert, exactly once.

The reference polls its sources on a schedule with a saved cursor.  Here
landed files are read by a Structured Streaming file source with
``trigger(availableNow=True)``: every run takes all files not yet seen
(the stream checkpoint plays the bookmark's part) and stops.  Each
micro-batch goes through ``foreachBatch`` into the same set-based upsert
as the batch loads, published with the stream's id and the micro-batch's number, so
one that is run again after a crash writes nothing a second time.  Lines that do
not parse, or lack a key, are kept beside the table, each once.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.quarantine import CORRUPT
from ..sources.sinks import Table


def _stream_id(spark: SparkSession, checkpoint: str) -> str:
    """Id that Spark gave the stream when its checkpoint was new."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]


def ingest_landed(spark: SparkSession, landing_glob: str, schema: T.StructType,
                  table: Table, keys: list[str], order_by: list[str],
                  checkpoint: str, fmt: str = "json", files_per_batch: int | None = None,
                  id_col: str | None = None, options: dict | None = None,
                  rejected: Table | None = None) -> DataFrame:
    """Load every landed file not yet processed into ``table``; return its rows.

    With ``rejected``, lines that do not parse and rows with a null key go there as
    (body, reason); without, they are treated as the format's options say."""
    if rejected is not None:
        schema = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
        options = {**(options or {}), "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    reader = spark.readStream.schema(schema).format(fmt).options(**(options or {}))
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", str(files_per_batch))
    stream = reader.load(landing_glob)

    def upsert_batch(batch: DataFrame, epoch_id: int) -> None:
        stream_id = _stream_id(spark, checkpoint)
        done = table.bookmark() or {}
        if done.get("stream_id") == stream_id and done["stream_epoch"] >= epoch_id:
            return
        batch.persist()  # read for the rejected rows, then for the others
        try:
            table.upsert(batch if rejected is None else apart(batch), keys, order_by, id_col,
                         bookmark={"stream_id": stream_id, "stream_epoch": int(epoch_id)})
        finally:
            batch.unpersist()

    def apart(batch: DataFrame) -> DataFrame:
        """The good rows, after the others are stored."""
        reason = F.when(F.col(CORRUPT).isNotNull(), F.lit("not parsed"))
        for k in keys:
            reason = reason.when(F.col(k).isNull(), F.lit(f"null {k}"))
        rest = [c for c in batch.columns if c != CORRUPT]
        body = F.coalesce(F.col(CORRUPT), F.to_json(F.struct(*rest)))
        bad = batch.select(body.alias("body"), reason.alias("reason")).filter(F.col("reason").isNotNull())
        rejected.insert_ignore(bad, ["body", "reason"])
        return batch.filter(reason.isNull()).drop(CORRUPT)

    query = (stream.writeStream.foreachBatch(upsert_batch)
             .option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()
    return table.read()

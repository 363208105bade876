"""Structured Streaming into tables: each micro-batch is appended once."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter

from tidewell.operators.mapping import by_order
from tidewell.options import Options
from tidewell.sources.store import Store
from tidewell.sources.writer import table_schema


def append_batch(df: DataFrame, batch_id: int, stream: str, options: dict) -> None:
    """Append a micro-batch unless the manifest has it already: the batch's number is committed with
    its rows, so a batch that is run again after a failure changes nothing."""
    o = Options.parse(options)
    store = Store(df.sparkSession, o.get("warehouse_dir"))
    folder, load = store.folder(o.source[1], o["sfschema"]), f"{stream}:{batch_id}"
    now = store.manifest(folder) or store.create(folder, table_schema(df.schema, o["keep_column_case"]))
    # Of each stream only the last batch is kept in mind, as batches come in order.
    last = [int(x.rpartition(":")[2]) for x in now.loaded if x.rpartition(":")[0] == stream]
    if last and max(last) >= batch_id:
        return
    version, n = store.write_version(folder, by_order(df, now.struct))
    others = tuple(x for x in now.loaded if x.rpartition(":")[0] != stream)
    store.commit(folder, replace(now, number=now.number + 1, versions=(*now.versions, version), rows=now.rows + n, loaded=(*others, load)))


def stream_to(df: DataFrame, stream: str, **options: object) -> DataStreamWriter:
    """A stream writer that appends to the table of ``dbtable``; give it a checkpointLocation."""
    return df.writeStream.foreachBatch(lambda batch, number: append_batch(batch, number, stream, options))

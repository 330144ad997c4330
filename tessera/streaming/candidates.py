"""New query entities as a stream, matched with a pool that stays."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tessera.operators import blocking
from tessera.sources.shared import stored
from tessera.sources.tables import ENTITY


def stream_candidates(pool: DataFrame, folder: str, out: str, checkpoint: str, k: int = blocking.K, **trigger: object) -> StreamingQuery:
    """Writes the candidates of the entities in each new Parquet file of folder to out, a folder for each batch.

    The pool's index is built once, when the stream starts. A batch that is run again after a failure replaces its own folder. trigger: as of writeStream.trigger.
    """
    tokens, idf, members = blocking.token_index(pool)
    idf = stored(idf, "idf")
    stream = pool.sparkSession.readStream.schema(ENTITY).parquet(folder)

    def block(batch: DataFrame, number: int) -> None:
        blocking.index_topk(batch, tokens, idf, members, k).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return stream.writeStream.foreachBatch(block).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()

"""Feed landing as a file stream.

New envelope files only tell which dates have changed; each batch then lands these dates again from
all their files. Late or repeated files therefore end in the same table as one batch run, and a
restart after a crash repeats at most the last batch. The file log of the checkpoint takes the place
of a row offset.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from callops.plans.flows import Run, land_feed
from callops.sources import envelope


def land_stream(run: Run, table: str, incoming: str, checkpoint: str, one_per_line: bool = False) -> StreamingQuery:
    """Land everything that has arrived under ``incoming/date=…`` since the last call, then stop.

    Each batch writes the audit rows of its dates, as a batch load does.
    """
    files = (
        run.spark.readStream.schema(envelope.ENVELOPE + ", date date")
        .option("multiLine", not one_per_line).option("basePath", incoming).json(incoming)
    )

    def land(batch: DataFrame, _: int) -> None:
        dates = batch.select("date").distinct()
        envelopes = envelope.read_envelopes(batch.sparkSession, incoming, one_per_line)
        at = batch.sparkSession.sql("select current_timestamp()").first()[0]
        land_feed(run, table, envelopes.join(dates, "date", "left_semi"), at)

    return (
        files.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )

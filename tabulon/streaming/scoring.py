"""L6 — stateless streaming scoring: file stream → validate → score → two sinks.

Each micro-batch is validated and scored with the same DataFrame operators as
the batch path (``foreachBatch``); accepted rows go to one Parquet sink,
rejected rows with their error list to another. A batch overwrites the folder
of its own epoch in each sink, so a batch that is run again after a failure
between the two writes replaces what it had written: exactly once in both.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def run_stream(spark: SparkSession, source_dir: str, schema: str, out_dir: str,
               validate: Callable[[DataFrame], tuple[DataFrame, DataFrame]],
               score: Callable[[DataFrame], DataFrame], max_files_per_trigger: int | None = None, read_once: bool = False) -> tuple[str, str]:
    """Process everything available now (``availableNow``) and return (accepted, rejected) sink paths.

    ``read_once``: ``validate`` writes what it has checked, so the files need not be kept for the second sink.
    """
    accepted, rejected, ckpt = f"{out_dir}/accepted", f"{out_dir}/rejected", f"{out_dir}/_checkpoint"

    def batch(df: DataFrame, epoch: int) -> None:
        if not read_once:
            df.persist()  # the micro-batch feeds two sinks: read the files once
        try:
            ok, bad = validate(df)
            score(ok).write.mode("overwrite").parquet(f"{accepted}/epoch={epoch}")
            bad.write.mode("overwrite").parquet(f"{rejected}/epoch={epoch}")
        finally:
            df.unpersist()

    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:  # a limit on the size of a micro-batch; none by default
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    q = (reader.parquet(source_dir)
         .writeStream.foreachBatch(batch).option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    q.awaitTermination()
    return accepted, rejected

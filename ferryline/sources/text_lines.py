"""Raw line scan of delimited text files."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# monotonically_increasing_id = task index * 2**33 + row number within the task
_TASK_ROWS = 1 << 33


def raw_lines(spark: SparkSession, path: str, header: bool = True, keep_blank_lines: bool = True) -> DataFrame:
    """Each line of the file(s) as one ``value`` string, line 1 of every
    file dropped when ``header``. Lines are whole: quotes, backslashes,
    control characters and outer blanks stay as they are.

    The header is known by its place alone: whatever the first line of a
    file holds (blank, unlike other files' headers) is dropped, and a line
    that equals it anywhere else is data. The result does not depend on how
    files are cut into splits or packed into tasks.

    Blank and whitespace-only lines are values too (each becomes a message
    with an empty or blank key and value); ``keep_blank_lines=False`` skips
    them. Files are cut into splits by ``spark.sql.files.maxPartitionBytes``
    (compressed ones are not), so a large file is read by many tasks.
    """
    lines = spark.read.text(path)
    if header:
        placed = lines.select(
            "value",
            F.col("_metadata.file_path").alias("path"),
            F.col("_metadata.file_block_start").alias("block"),
        )
        lines = placed.mapInArrow(_line_dropper(), "value string")
    if not keep_blank_lines:
        lines = lines.where(F.trim("value") != "")
    return lines


def _line_dropper() -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Drops line 1 of every file, batch by batch. (An inner function, so it
    travels to the executors with the job.)"""

    def without_first_lines(batches):
        # a task reads its splits one after the other, each from its start;
        # the first row of a split that begins at byte 0 is line 1 of a file
        path = block = None
        for batch in batches:
            if not batch.num_rows:
                continue
            paths, blocks = batch.column("path"), batch.column("block")
            fresh = pc.or_(pc.not_equal(paths[1:], paths[:-1]), pc.not_equal(blocks[1:], blocks[:-1]))
            opens = paths[0].as_py() != path or blocks[0].as_py() != block
            first = pa.concat_arrays([pa.array([opens], pa.bool_()), fresh])
            path, block = paths[-1].as_py(), blocks[-1].as_py()
            yield batch.select(["value"]).filter(pc.invert(pc.and_(first, pc.equal(blocks, 0))))

    return without_first_lines


def write_lines(
    df: DataFrame,
    path: str,
    header: str | None = None,
    line_col: str = "value",
    compression: str = "none",
    lines_per_file: int = 0,
) -> None:
    """Write one text line per row, verbatim (empty and blank lines too);
    ``header`` (if given) opens every file.

    Each write task writes one file, or rolls to its next one after
    ``lines_per_file`` rows, so the header goes before the rows whose
    ``monotonically_increasing_id`` has such a row number within its task.
    ``compression`` is a codec of Spark's text writer; most make files that
    one task reads whole, so give ``lines_per_file`` with it.
    """
    line = F.col(line_col)
    if header is not None:
        row = F.monotonically_increasing_id() % F.lit(_TASK_ROWS)
        opens = (row % F.lit(lines_per_file) if lines_per_file else row) == 0
        line = F.when(opens, F.concat(F.lit(header + "\n"), F.coalesce(line, F.lit("")))).otherwise(line)
    writer = df.select(line.alias("value")).write.mode("overwrite").option("compression", compression)
    writer.option("maxRecordsPerFile", lines_per_file).text(path)

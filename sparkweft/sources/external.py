"""What external programs do, as hooks: building code property graphs, exporting them, drawing images.

The engine doesn't emulate these programs. A hook is a command that reads and writes files on an executor; `run_tool`
calls it for every row, tries again as often as asked, and reports what happened in columns instead of failing the job.
Without a command configured the hooks raise ToolMissing.
"""

from __future__ import annotations

import os
import shutil
import subprocess
import tempfile
import time
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class ToolMissing(RuntimeError):
    pass


@dataclass(frozen=True)
class Tool:
    """A command with {input} and {output} for paths; the output counts if it has at least `least` bytes."""

    command: Sequence[str]
    suffix_in: str
    suffix_out: str
    least: int = 1
    tries: int = 3
    pause: float = 0.5
    seconds: float = 600.0
    #: The output's size has to stay the same so often, looked at every poll seconds, for settle seconds at most.
    same: int = 3
    poll: float = 0.1
    settle: float = 5.0

    def checked(self) -> Tool:
        if not self.command or shutil.which(self.command[0]) is None:
            raise ToolMissing(f"{self.command[0] if self.command else 'no command'} is not installed; configure an external tool")
        return self

    def settled(self, path: str) -> bool:
        """Whether the file is there, large enough, and no longer growing: the command may leave a process that still writes."""
        until, last, count = time.monotonic() + self.settle, -1, 0
        while time.monotonic() < until:
            size = os.path.getsize(path) if os.path.exists(path) else -1
            count = count + 1 if size == last and size >= self.least else 0
            if count >= self.same:
                return True
            last = size
            time.sleep(self.poll)
        return False

    def run(self, content: bytes) -> tuple[bytes | None, str]:
        """The output, or None and the last error."""
        error = ""
        for attempt in range(1, self.tries + 1):
            with tempfile.TemporaryDirectory() as folder:
                source, target = f"{folder}/in{self.suffix_in}", f"{folder}/out{self.suffix_out}"
                with open(source, "wb") as f:
                    f.write(content)
                try:
                    done = subprocess.run([x.format(input=source, output=target) for x in self.command], capture_output=True, text=True, timeout=self.seconds, check=False)
                    if done.returncode == 0 and os.path.exists(target) and self.settled(target):
                        with open(target, "rb") as f:
                            return f.read(), ""
                    error = done.stderr[-2000:] or "output missing or too small"
                except (OSError, subprocess.TimeoutExpired) as e:
                    error = str(e)
            if attempt < self.tries:
                time.sleep(self.pause * attempt)
        return None, error


def run_tool(rows: DataFrame, key: str, content: str, tool: Tool, slots: int | None = None, checked: bool = True) -> DataFrame:
    """(key, output, error): the tool over the content of every row; slots bounds how many run at once. Unless checked, a missing program is an error of each row."""
    kind = rows.schema[key].dataType.simpleString()

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if checked:
            tool.checked()
        missing = shutil.which(tool.command[0]) is None
        for batch in batches:
            made = [(None, f"{tool.command[0]} is not installed") if missing else tool.run((x or "").encode() if isinstance(x, str) or x is None else x) for x in batch.column(content).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(key), pa.array([m[0] for m in made], pa.binary()), pa.array([m[1] for m in made], pa.string())], names=[key, "output", "error"])

    chosen = rows.select(F.col(key), F.col(content))
    return (chosen.repartition(slots) if slots else chosen).mapInArrow(go, f"{key} {kind}, output binary, error string")


def documents(units: DataFrame, build: Tool, export: Tool, slots: int | None = None) -> DataFrame:
    """(graph_id, cpg, cpg_bytes, dot) of units (sample_id, text): the graph that build makes of a unit, and the document that export makes of the graph. What failed is null."""
    from ..tables import written

    built = written(run_tool(units, "sample_id", "text", build, slots), "tool-graphs")
    made = written(run_tool(built.where("output is not null"), "sample_id", "output", export, slots), "tool-documents")
    dots = made.select(F.col("sample_id").alias("_id"), F.decode("output", "utf-8").alias("dot"))
    rows = built.join(dots, F.col("sample_id") == F.col("_id"), "left")
    return rows.select(F.col("sample_id").alias("graph_id"), F.col("output").alias("cpg"), F.length("output").cast("long").alias("cpg_bytes"), "dot")


#: Draws a document as PNG; best effort, so the caller looks at `error`.
PNG = Tool(("dot", "-Tpng", "{input}", "-o", "{output}"), ".dot", ".png")

"""Writing results: distributed tables, and the two JSON arrays of a run."""

from __future__ import annotations

import json
import textwrap
from pathlib import Path

from pyspark.sql import DataFrame

from tenderlake.operators.normalize import OPPORTUNITY, opportunities, review_queue


def write_jsonl(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_tables(rows: DataFrame, path: str) -> None:
    """The scalable form: two Parquet tables."""
    opportunities(rows).write.mode("overwrite").parquet(f"{path}/opportunities")
    review_queue(rows).write.mode("overwrite").parquet(f"{path}/review_queue")


def export_json(rows: DataFrame, folder: Path) -> tuple[int, int]:
    """opportunities.json and review_queue.json as indented ASCII arrays in the order of files and positions, written row by row.

    rows is a stored table; one partition of it is in memory at a time, so any number will do.  Where single files are no
    use, write_tables() writes in parallel.
    """
    folder.mkdir(parents=True, exist_ok=True)
    counts = []
    for name, part in (("opportunities", opportunities(rows)), ("review_queue", review_queue(rows))):
        n = 0
        with (folder / f"{name}.json").open("w") as file:
            for r in part.orderBy("file", "pos").toLocalIterator():
                if name == "opportunities":
                    said = {c: r[c] for c in OPPORTUNITY}
                else:
                    try:
                        record = json.loads(r["record"])
                    except ValueError:
                        record = r["record"]
                    said = {"record": record, "error": r["error"]}
                file.write(("[\n" if n == 0 else ",\n") + textwrap.indent(json.dumps(said, indent=2), "  "))
                n += 1
            file.write("\n]\n" if n else "[]\n")
        counts.append(n)
    return counts[0], counts[1]
